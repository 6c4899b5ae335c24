"""Exact quantiles with bounded memory (linear interpolation, as numpy and
SQL ``quantile_cont``).

Spark's exact ``percentile`` keeps a value → count map per column and merges
the maps in one task, which does not survive high-cardinality columns at
scale. Here the exact order statistics are found by selection instead, in the
same way for every number of rows and distinct values:

1. one aggregate gives, per column, the non-null count and pivots around every
   wanted rank (``percentile_approx`` at p and p ± 2/accuracy);
2. one aggregate counts the rows below and at every pivot. A rank that falls on
   a pivot is found; any other lies strictly between two pivots;
3. the rows strictly between them give the next pivots, and step 2 follows.

A pivot is a value of the rows it was drawn from and leaves them for good, so
every round gets closer, and a round leaves about 4/accuracy of the rows. All
jobs are aggregates without a grouping key; a job returns a few numbers per
wanted rank, whatever the data. Infinities are values like any other.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credal.session import written


def _literal(v: float) -> str:
    """A double as SQL text."""
    return f"{v!r}D" if math.isfinite(v) else f"double('{'-' if v < 0 else ''}Infinity')"


def _between(lo: float, hi: float, frac: float) -> float:
    """Linear interpolation; an infinite neighbour wins over a finite one."""
    if frac == 0 or lo == hi:
        return lo
    if math.isinf(lo) or math.isinf(hi):
        return lo * (1 - frac) + hi * frac
    return lo + (hi - lo) * frac


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                    accuracy: int = 10000) -> dict[str, list[float | None]]:
    """Exact linear-interpolated quantiles of every column (NULL and NaN
    ignored; None for a column without a value). Between −inf and +inf the
    interpolated value is NaN."""
    cols = list(columns)
    if not cols or not probs:
        return {c: [] for c in cols}
    # values as SQL text (one parse each; wide inputs build hundreds of these)
    x = ["nullif(CAST(`{0}` AS DOUBLE), double('NaN'))".format(c.replace("`", "``")) for c in cols]
    eps = 2.0 / accuracy

    def sketch(value: str, ps: Sequence[float]):
        ps = sorted({min(1.0, max(0.0, p + d)) for p in ps for d in (-eps, 0.0, eps)})
        return F.expr(f"percentile_approx({value}, array({', '.join(_literal(p) for p in ps)}), {accuracy})")

    row = df.agg(*[F.expr(f"count({v})") for v in x], *[sketch(v, probs) for v in x]).first()
    size = row[:len(cols)]
    # per (column, 0-based rank): its next pivots, and (lo, hi, rows up to lo, rows below hi)
    pivots: dict[tuple[int, int], list[float]] = {}
    span: dict[tuple[int, int], tuple[float | None, float | None, int, int]] = {}
    for i, n in enumerate(size):
        for p in probs if n else ():
            k = math.floor(p * (n - 1))
            for rank in (k, min(k + 1, n - 1)):
                pivots[i, rank], span[i, rank] = row[len(cols) + i], (None, None, 0, n)
    found: dict[tuple[int, int], float] = {}
    while pivots:
        wanted = sorted({(i, v) for (i, _), vs in pivots.items() for v in vs})
        counts = df.agg(*[F.expr(f"count_if({x[i]} {op} {_literal(v)})")
                          for i, v in wanted for op in ("<", "<=")]).first()
        under = {at: (counts[2 * t], counts[2 * t + 1]) for t, at in enumerate(wanted)}
        exprs, open_ = [], []
        for (i, rank), vs in pivots.items():
            lo, hi, first, last = span[i, rank]
            for v in sorted(set(vs)):
                lt, le = under[i, v]
                if lt <= rank < le:
                    found[i, rank] = v
                    break
                if rank < lt:
                    hi, last = v, lt
                    break
                lo, first = v, le
            if (i, rank) in found:
                continue
            span[i, rank] = (lo, hi, first, last)
            limits = [f"{x[i]} {op} {_literal(v)}" for op, v in ((">", lo), ("<", hi)) if v is not None]
            open_.append((i, rank))
            exprs.append(sketch(f"CASE WHEN {' AND '.join(limits)} THEN {x[i]} END", [(rank - first + 0.5) / (last - first)]))
        pivots = dict(zip(open_, df.agg(*exprs).first())) if open_ else {}
    result: dict[str, list[float | None]] = {}
    for i, (c, n) in enumerate(zip(cols, size)):
        result[c] = []
        for p in probs:
            pos = p * (n - 1) if n else 0.0
            k = math.floor(pos)
            result[c].append(_between(found[i, k], found[i, min(k + 1, n - 1)], pos - k) if n else None)
    return result


def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], method: str = "exact",
              accuracy: int = 10000) -> dict[str, list[float | None]]:
    """Quantiles of several columns by ``method``:

    * ``exact``      — selection above (bounded memory, a few jobs; the default);
    * ``percentile`` — Spark's exact ``percentile`` in one job (holds a
      value → count map per column: small or low-cardinality data only);
    * ``approx``     — ``percentile_approx`` (returns an element, no
      interpolation).
    """
    cols = list(columns)
    if not cols:
        return {}
    if method == "exact":
        return exact_quantiles(df, cols, probs, accuracy=accuracy)
    arr = F.array(*[F.lit(float(p)) for p in probs])
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        x = F.when(~F.isnan(x), x)
        aggs.append((F.percentile(x, arr) if method == "percentile" else F.percentile_approx(x, arr, accuracy)).alias(c))
    row = df.agg(*aggs).first()
    return {c: (list(row[c]) if row[c] is not None else [None] * len(probs)) for c in cols}


def grouped_exact_quantiles(df: DataFrame, keys: Sequence[str], column: str, probs: Sequence[float],
                            names: Sequence[str] | None = None, buckets: int | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles of ``column`` per group, fully
    distributed (no per-group value map, nothing per group on the driver):

    counts per (group, value) → running counts per group through bucketed
    windows (:func:`credal.operators.cumulative.cumulative_sums`) → for every
    wanted rank k of a group, the smallest value whose running count exceeds
    k (a grouped ``min``). A hot group is spread over its buckets.
    """
    x = F.col(column).cast("double")
    counts = df.where(x.isNotNull() & ~F.isnan(x)).groupBy(*keys, x.alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
    return quantiles_of_counts(counts, keys, "__v", "__c", probs, names, buckets)


def quantiles_of_counts(counts: DataFrame, keys: Sequence[str], value: str, count: str, probs: Sequence[float],
                        names: Sequence[str] | None = None, buckets: int | None = None) -> DataFrame:
    """The second half of :func:`grouped_exact_quantiles`, for counts kept elsewhere:
    one row per (group, value) with how often it occurs; null values and counts
    below one are left out."""
    from credal.operators.cumulative import bucket_count, cumulative_sums
    keys = list(keys)
    names = list(names or [f"p{int(round(p * 100))}" for p in probs])
    counts = counts.where(F.col(value).isNotNull() & (F.col(count) > 0)) \
        .select(*keys, F.col(value).cast("double").alias("__v"), F.col(count).alias("__c"))
    if buckets is None:
        counts = written(counts, "values")
        buckets = bucket_count(counts.count())
    sizes = counts.groupBy(*keys).agg(F.sum("__c").alias("__n"))
    from credal.operators.assemble import join_on_keys
    cum = join_on_keys(cumulative_sums(counts, "__v", ["__c"], partition=keys, buckets=buckets), sizes, keys)
    exprs = []
    for j, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("__n") - 1)
        k = F.floor(pos)
        # k-th and (k+1)-th order statistics (0-based): first value whose running count exceeds the rank
        exprs += [F.min(F.when(F.col("cum___c") > k, F.col("__v"))).alias(f"__lo{j}"),
                  F.min(F.when(F.col("cum___c") > k + 1, F.col("__v"))).alias(f"__hi{j}"),
                  F.first(pos - k).alias(f"__f{j}")]
    per = cum.groupBy(*keys).agg(*exprs)
    out = [F.col(k_) for k_ in keys]
    for j, n in enumerate(names):
        lo, hi, fr = F.col(f"__lo{j}"), F.coalesce(F.col(f"__hi{j}"), F.col(f"__lo{j}")), F.col(f"__f{j}")
        out.append(F.when(fr > 0, lo + (hi - lo) * fr).otherwise(lo).alias(n))
    return per.select(*out)
