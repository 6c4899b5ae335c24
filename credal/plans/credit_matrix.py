"""Feature matrix of the credit view stack: registry-driven preprocessing.

The column lists come from the registry (E01: by transform / encoding /
type, present in the view), are de-duplicated by transformer priority (E02),
fitted on the training split only and applied unchanged to every row.
Aggregate and engineered columns that the registry does not describe are
standardised (the numeric default), identifiers / target / split are carried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credal.functions.clean import repair_matrix
from credal.operators import preprocess as P
from credal.registry import FeatureRegistry

CARRY = ("sk_id_curr", "target", "split")


def spec_from_registry(view: DataFrame, registry: FeatureRegistry, table: str = "application") -> P.PreprocessSpec:
    cols = view.columns
    described = set(registry.columns(table=table))
    extra_numeric = [f.name for f in view.schema.fields
                     if f.name not in described and f.name not in CARRY
                     and f.dataType.typeName() in ("double", "long", "integer")]
    return P.PreprocessSpec(
        log=registry.columns(table=table, type="numerical", transform="log", present_in=cols),
        robust=registry.columns(table=table, type="numerical", transform="robust", present_in=cols),
        standard=registry.columns(table=table, type="numerical", transform="standard", present_in=cols) + extra_numeric,
        one_hot=registry.columns(table=table, type="categorical", encoding="one_hot", present_in=cols),
        ordinal=registry.columns(table=table, type="categorical", encoding="ordinal", present_in=cols),
        target_enc=registry.columns(table=table, type="categorical", encoding="target", present_in=cols),
        binary=[c for c in registry.columns(table=table, type="binary", present_in=cols) if c not in CARRY],
        ordinal_categories={s.name: list(s.value_map.values()) for s in registry
                            if s.source_table == table and s.encoding == "ordinal" and s.value_map},
        target="target")


def feature_matrix(view: DataFrame, registry: FeatureRegistry, materialize: bool = True) -> tuple[DataFrame, P.Params]:
    """Fit on ``split = 'train'``, transform all rows; ±inf/NaN repaired.

    With ``materialize`` the view (one row per client, built from every
    history table) is written once to the shared checkpoint folder, so each fit
    job reads its columns of it instead of re-running the view stack, and a lost
    executor recomputes from there, not from the raw histories."""
    from credal.session import written
    if materialize:
        view = written(view, "view")
    spec = spec_from_registry(view, registry)
    params = P.fit(view.where(F.col("split") == "train"), spec)
    return repair_matrix(P.transform(view, params, keep=list(CARRY)), keep=list(CARRY)), params
