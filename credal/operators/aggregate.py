"""Aggregation operators.

All aggregates are expressed as one ``groupBy(...).agg(*exprs)`` so Spark runs
a partial (map-side) aggregate before the shuffle: a key holding a third of
the rows is reduced to one partial row per input partition before it moves.
``count_distinct`` (the ``nunique`` spec) is planned as a first exchange on
(key, value) and a second on the key (checked with ``explain``), so a hot
key's distinct values are spread over tasks. Exact percentiles never use a
per-group value map (see :mod:`credal.operators.quantiles`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Aggregation names accepted by the spec builder, pandas-style.
_AGG_FUNCS = {
    "min": lambda c: F.min(c),
    "max": lambda c: F.max(c),
    "mean": lambda c: F.avg(c),
    "sum": lambda c: F.sum(c),
    "var": lambda c: F.var_samp(c),
    "std": lambda c: F.stddev_samp(c),
    "nunique": lambda c: F.count_distinct(c),
    "count": lambda c: F.count(c),
    "size": lambda c: F.count(F.lit(1)),
}
# (per-group medians are not a spec function: they come from
#  credal.operators.quantiles.grouped_exact_quantiles, which needs no value map)


def agg_expr(func: str, c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    try:
        return _AGG_FUNCS[func](col)
    except KeyError:  # pragma: no cover - guarded by callers
        raise ValueError(f"unknown aggregation {func!r}; known: {sorted(_AGG_FUNCS)}") from None


def spec_exprs(spec: Mapping[str, Sequence[str]], prefix: str = "", upper: bool = True,
               condition: Column | None = None, null_if_empty: bool = False) -> list[Column]:
    """``{column: [funcs]}`` → aliased aggregate expressions named
    ``PREFIX_COLUMN_FUNC``.

    With ``condition`` every input is restricted to matching rows (A08): the
    value is wrapped in ``when(condition, value)`` so min/max/mean/sum ignore
    the others; counts become ``count_if``. With ``null_if_empty`` a group
    without any matching row gets NULL for every output, which is what a left
    join of a separately filtered aggregate would give.
    """
    out = []
    matched = F.count_if(condition) if condition is not None else None
    for column, funcs in spec.items():
        for func in funcs:
            name = f"{prefix}{column}_{func}"
            name = name.upper() if upper else name
            if condition is None:
                e = agg_expr(func, column)
            elif func == "size":
                e = F.count_if(condition)
            else:
                e = agg_expr(func, F.when(condition, F.col(column)))
            if condition is not None and null_if_empty:
                e = F.when(matched > 0, e)
            out.append(e.alias(name))
    return out


def spec_aggregate(df: DataFrame, keys: str | Sequence[str], spec: Mapping[str, Sequence[str]],
                   prefix: str = "", upper: bool = True, extra: Sequence[Column] = ()) -> DataFrame:
    """Aggregates from a ``{column: [min,max,mean,var,sum,nunique,size]}`` spec.

    One ``nunique`` column is part of the one ``agg``. Several of them in one
    aggregate would copy every row once per column, so each is then a count of
    its own of the distinct (keys, value), reading these columns only, joined
    on the keys (null keys are groups)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    exprs = spec_exprs(spec, prefix, upper)
    several = [c for c, funcs in spec.items() if "nunique" in funcs]
    if len(several) < 2 or not keys:
        return df.groupBy(*keys).agg(*exprs, *extra)
    plain = {c: [f for f in funcs if f != "nunique"] for c, funcs in spec.items()}
    given = [F.col(f"`{k}`") for k in keys]
    # a group per key, also where the spec asks for nothing else
    out = df.groupBy(*given).agg(F.count(F.lit(1)).alias("__rows"), *spec_exprs(plain, prefix, upper), *extra)
    for i, c in enumerate(several):
        name = f"{prefix}{c}_nunique"
        ours = [f"__k{i}_{n}" for n in range(len(keys))]
        counts = df.select(*[k.alias(o) for k, o in zip(given, ours)], F.col(f"`{c}`").alias("__v")).distinct() \
            .groupBy(*ours).agg(F.count("__v").alias(name.upper() if upper else name))
        same = [k.eqNullSafe(F.col(o)) for k, o in zip(given, ours)]
        out = out.join(counts, reduce(lambda a, b: a & b, same)).drop(*ours)
    order = [f"{prefix}{c}_{f}".upper() if upper else f"{prefix}{c}_{f}" for c, funcs in spec.items() for f in funcs]
    rest = [c for c in out.columns if c not in {*keys, *order, "__rows"}]
    return out.select(*[F.col(f"`{c}`") for c in [*keys, *order, *rest]])


def all_columns_spec(df: DataFrame, keys: Sequence[str], funcs: Sequence[str] = ("min", "max", "mean", "sum", "var")
                     ) -> dict[str, list[str]]:
    """A06 "all columns × five functions" form over the numeric columns."""
    numeric = {"double", "float", "integer", "long", "short", "byte", "decimal"}
    return {f.name: list(funcs) for f in df.schema.fields
            if f.name not in keys and f.dataType.typeName() in numeric}


def category_share_exprs(column: str, categories: Sequence[str], prefix: str = "",
                         include_missing: bool = True) -> list[Column]:
    """Mean of each one-hot indicator per group, without materialising the
    one-hot table. ``categories`` come from a fit (bounded distinct set)."""
    out = []
    for v in categories:
        out.append(F.avg(F.when(F.col(column) == F.lit(v), 1.0).otherwise(0.0)).alias(f"{prefix}{column}_{v}_mean"))
    if include_missing:
        out.append(F.avg(F.when(F.col(column).isNull(), 1.0).otherwise(0.0)).alias(f"{prefix}{column}_nan_mean"))
    return out


def category_shares(df: DataFrame, keys: str | Sequence[str], column: str, categories: Sequence[str] | None = None,
                    prefix: str = "", include_missing: bool = True) -> DataFrame:
    """A07 as an operator, a column per category (learned by one job when not
    given): the categories are the output's schema. A column with very many
    values is better served by :func:`category_shares_long`."""
    if categories is None:
        categories = distinct_values(df, column)
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(*category_share_exprs(column, categories, prefix, include_missing))


def category_shares_long(df: DataFrame, keys: str | Sequence[str], column: str) -> DataFrame:
    """A07 in long form, for any number of values: ``(keys, column, share)`` with
    a row per group and value that occurs (NULL included)."""
    from credal.operators.assemble import join_on_keys
    keys = [keys] if isinstance(keys, str) else list(keys)
    counts = df.groupBy(*keys, column).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.groupBy(*keys).agg(F.sum("__n").alias("__t"))
    return join_on_keys(counts, total, keys).select(*keys, column, (F.col("__n") / F.col("__t")).alias("share"))


def distinct_values(df: DataFrame, column: str) -> list:
    """Sorted distinct non-null values, for outputs with a column per value:
    the list is as long as that output is wide. Other uses take
    :func:`index_table`."""
    return [r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column).collect()]


def index_table(df: DataFrame, column: str) -> DataFrame:
    """``(column, index)``: the 1-based position of every distinct non-null value
    in sorted order. Values go to ranges by sampled bounds; the written ranges'
    sizes give the offsets, so no task holds more than a range."""
    from credal.sources.io import scratch_dir
    spark = df.sparkSession
    path = scratch_dir(spark, "index")
    df.select(F.col(column).alias("v")).where("v is not null").distinct().repartitionByRange("v") \
        .withColumn("part", F.spark_partition_id()).write.parquet(path)
    values = spark.read.parquet(path)
    sizes = values.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)     # one row per range
    start = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy("v"))
    return values.withColumn("i", inside).join(start, "part") \
        .select(F.col("v").alias(column), (F.col("start") + F.col("i")).alias("index"))


def filtered_aggregate(df: DataFrame, keys: str | Sequence[str], spec: Mapping[str, Sequence[str]],
                       condition: Column, prefix: str, upper: bool = True) -> DataFrame:
    """The spec restricted to rows matching ``condition``; NULL outputs for
    a group without such rows."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(*spec_exprs(spec, prefix, upper, condition=condition, null_if_empty=True))


def multi_filtered_aggregate(df: DataFrame, keys: str | Sequence[str], spec: Mapping[str, Sequence[str]],
                             prefix: str, subsets: Mapping[str, Column], upper: bool = True) -> DataFrame:
    """J03 re-aimed: overall + per-status sub-aggregates side by side in ONE
    aggregate (one shuffle) instead of separate aggregates joined back."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    exprs = spec_exprs(spec, prefix, upper)
    for sub_prefix, cond in subsets.items():
        exprs += spec_exprs(spec, sub_prefix, upper, condition=cond, null_if_empty=True)
    return df.groupBy(*keys).agg(*exprs)


def two_level_aggregate(df: DataFrame, child_key: str, parent_key: str, child_spec: Mapping[str, Sequence[str]],
                        parent_spec: Mapping[str, Sequence[str]] | None = None, child_prefix: str = "",
                        parent_prefix: str = "", upper: bool = True) -> DataFrame:
    """History → parent (``child_spec`` per ``child_key``) → customer
    (``parent_spec`` over the first-level outputs, default ``mean``)."""
    first = df.groupBy(child_key, parent_key).agg(*spec_exprs(child_spec, child_prefix, upper))
    cols = [c for c in first.columns if c not in (child_key, parent_key)]
    parent_spec = parent_spec or {c: ["mean"] for c in cols}
    return first.groupBy(parent_key).agg(*spec_exprs(parent_spec, parent_prefix, upper))


def guarded_rate(condition: Column) -> Column:
    """A10: ``CASE WHEN COUNT(*)>0 THEN SUM(cond)/COUNT(*)`` == mean of the 0/1 flag."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def value_distribution(df: DataFrame, column: str, total: int | None = None) -> DataFrame:
    """Normalised value counts (share of each value, missing included).

    The row total is one scalar (a count job) so no global window moves the
    per-value rows to one partition.
    """
    if total is None:
        total = df.count()
    return (df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
            .withColumn("share", F.col("count") / F.lit(float(max(total, 1)))))


def dominant_share(df: DataFrame, column: str) -> DataFrame:
    """Share of the most frequent value (ties → smallest value)."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max("n").alias("top_count"), F.sum("n").alias("total")).select(
        (F.col("top_count") / F.col("total")).alias("dominant_share"))


def group_target_stats(df: DataFrame, category: str, target: str) -> DataFrame:
    """Mean, std and count of a target per category, sorted by mean."""
    return (df.groupBy(category)
            .agg(F.avg(target).alias("target_mean"), F.stddev_samp(target).alias("target_std"),
                 F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("target_mean").desc(), F.col(category)))


def hourly_counts(df: DataFrame, ts: str, label: str) -> DataFrame:
    """Rows per (hour, label)."""
    return (df.groupBy(F.date_trunc("hour", F.col(ts)).alias("hour"), F.col(label))
            .agg(F.count(F.lit(1)).alias("n")))


def percentiles(df: DataFrame, column: str, probs: Sequence[float] = (0.5, 0.75, 0.95, 0.99),
                keys: Sequence[str] = (), exact: bool = True, accuracy: int = 10000,
                names: Sequence[str] | None = None) -> DataFrame:
    """Linear-interpolated percentiles plus the max.

    Without keys the exact values come from bounded-memory selection; per
    key from distributed running counts (:mod:`credal.operators.quantiles`);
    ``exact=False`` uses the ``percentile_approx`` sketch.
    """
    names = list(names or [f"p{int(round(p * 100))}" for p in probs])
    if not keys:
        from credal.operators.quantiles import quantiles
        q = quantiles(df, [column], probs, "exact" if exact else "approx", accuracy)[column]
        mx = df.agg(F.max(column).alias("max"))
        return mx.select(*[F.lit(v).cast("double").alias(n) for v, n in zip(q, names)], "max")
    if exact:
        from credal.operators.quantiles import grouped_exact_quantiles
        q = grouped_exact_quantiles(df, keys, column, probs, names)
        from credal.operators.assemble import join_on_keys
        return join_on_keys(q, df.groupBy(*keys).agg(F.max(column).alias("max")), list(keys))
    arr = F.array(*[F.lit(float(p)) for p in probs])
    res = df.groupBy(*keys).agg(F.percentile_approx(F.col(column), arr, accuracy).alias("_q"),
                                F.max(column).alias("max"))
    return res.select(*keys, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)], "max")


def histogram(df: DataFrame, column: str, bins: int = 50, by: str | None = None,
              lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Equal-width bins (numpy convention: last bin closed) per ``by``.

    Bounds are one small aggregate when not given.
    """
    if lo is None or hi is None:
        row = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
        lo = row["lo"] if lo is None else lo
        hi = row["hi"] if hi is None else hi
    width = (hi - lo) / bins if hi is not None and lo is not None and hi > lo else 1.0
    b = F.least(F.floor((F.col(column) - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(bins - 1))
    keys = [b.alias("bin")] + ([F.col(by)] if by else [])
    out = df.where(F.col(column).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return (out.withColumn("bin_lo", F.lit(lo) + F.col("bin") * F.lit(width))
            .withColumn("bin_hi", F.lit(lo) + (F.col("bin") + 1) * F.lit(width)))


def importance_average(df: DataFrame, feature: str = "feature", importance: str = "importance",
                       top: int = 40) -> DataFrame:
    """Mean importance per feature over folds, top ``top`` (the limit is
    the feature: a top-k report)."""
    return (df.groupBy(feature).agg(F.avg(importance).alias("importance_mean"))
            .orderBy(F.col("importance_mean").desc(), F.col(feature)).limit(top))


def first_per_group(df: DataFrame, group: str, order: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The row with the smallest ``order`` value of every group.

    ``min_by`` is a partial aggregate (one candidate row per group and input
    partition), so a group holding most of the rows never sits in one task
    as a window partition would."""
    cols = [c for c in (columns or df.columns) if c != group]
    best = F.min_by(F.struct(*[F.col(c) for c in cols]), F.struct(F.col(order), *[F.col(c) for c in cols]))
    return df.groupBy(group).agg(best.alias("_r")).select(group, *[F.col(f"_r.{c}").alias(c) for c in cols])


def last_n(df: DataFrame, ts: str, n: int, tie: Sequence[str] = ()) -> DataFrame:
    """The ``n`` newest rows, newest first (top-n: each task keeps n)."""
    return df.orderBy(F.col(ts).desc(), *[F.col(c).desc() for c in tie]).limit(n)


def column_modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent non-null value of every column (smallest on
    ties, compared as text) with its count — ``(column, mode, count)``.

    Long format ``(column, value)`` reduced by a partial aggregate, then one
    row per column by ``max_by`` over (count, −value order): the shuffle
    carries distinct (column, value) pairs only, never a per-column value map
    in one task, so a high-cardinality column stays distributed.
    """
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    counts = (df.select(F.explode(arr).alias("kv")).select("kv.column", "kv.value")
              .where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    # rank inside a column: highest count first, then the smallest value
    best = counts.groupBy("column").agg(
        F.max("n").alias("count"),
        F.min_by("value", F.struct((-F.col("n")).alias("neg_n"), F.col("value"))).alias("mode"))
    return best.select("column", "mode", "count")
