"""Composed plans and the demo queries on the driver tables."""

import importlib

_MODULES = (
    "credal.plans.demo_features",
    "credal.plans.demo_credit",
    "credal.plans.demo_preprocess",
    "credal.plans.demo_evaluate",
    "credal.plans.demo_monitor",
    "credal.plans.demo_profile",
    "credal.plans.demo_clean",
    "credal.plans.demo_agg",
    "credal.plans.demo_train",
    "credal.plans.demo_sources",
    "credal.plans.demo_stream",
)


def load_all() -> None:
    """Import every demo module so its queries register themselves."""
    for m in _MODULES:
        importlib.import_module(m)
