"""Score, decide, log (the third entry point) as one batch or streaming job.

requests → field alignment (C30: renames, years → −365·days, fitted column
order, absent fields 0.0) → the fitted preprocessing transform → model →
P(default) → approve / refuse (C29) → JSON Lines log (S11). Works unchanged
on a streaming DataFrame of requests.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from credal.functions.clean import repair_matrix
from credal.operators import monitor as D
from credal.operators import preprocess as P
from credal.operators import train as TR


def fitted_inputs(params: P.Params) -> tuple[list[str], list[str]]:
    """Input columns a fitted transform reads: (numeric, categorical)."""
    s = params.spec
    numeric = [c for c in s["log"] + s["standard"] + s["robust"] + s["binary"] if c not in params.dropped]
    categorical = s["one_hot"] + s["ordinal"] + s["target_enc"]
    return numeric, categorical


def score_requests(requests: DataFrame, params: P.Params, model: PipelineModel, threshold: float, key: str,
                   renames: Mapping[str, str] | None = None, day_fields: Sequence[str] = ()) -> DataFrame:
    """One select for the alignment, one for the transform, the model's
    transform, the decision rule — no shuffle."""
    numeric, categorical = fitted_inputs(params)
    aligned = D.align_population(requests, dict(renames or {}), day_to_years=day_fields,
                                 columns=numeric + categorical, keep=[key], categorical=categorical)
    x = repair_matrix(P.transform(aligned, params, keep=[key]), keep=[key])
    return TR.score(x, model, threshold, keep=[key])
