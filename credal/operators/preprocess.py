"""Fit / transform preprocessing.

``fit(df, spec)`` learns every parameter with a fixed, small number of
aggregate jobs over the training rows (one wide aggregate for moments,
exact medians and robust
quartiles by bounded-memory selection (:mod:`credal.operators.quantiles`),
one grouped count for the one-hot categories, a sorted index per learned ordinal
column, one grouped aggregate per target-encoded column) and returns a
JSON-serialisable ``Params``. ``transform(df, params)`` is a single ``select`` of Catalyst
expressions, which streams through whole-stage codegen at scan speed and
applies unchanged to train, test or a stream. A target-encoded column of any
number of categories fits: beyond a few dozen its (category → value) table is
written to the shared folder, named in ``Params`` and joined, by broadcast up to
``BROADCAST_BYTES``, beyond that as Spark sees fit. The same holds for the learned
positions of an ordinal column. One-hot categories are output columns and so
driver metadata.

Semantics follow the fitted column transformer of the reference:
  one-hot   : impute "unknown", sorted categories, unseen → all zeros   ohe__c_v
  ordinal   : impute "unknown", sorted categories, unseen → −1          ordinal__c
  log       : impute 0, log1p(max(x, 0)), standardise                   log__c
  standard  : impute median, + missing indicators, standardise all      standard__c,
                                                                         standard__missingindicator_c
  robust    : impute median, (x − median) / IQR of the imputed values   robust__c
  binary    : coerce to number, missing → 0                             binary__c
  target    : smoothed mean (n·mean + k·global)/(n + k), unseen → global target_enc__c
Standardisation uses the population σ (σ = 0 → 1), as the reference does.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credal.operators.quantiles import quantiles
from credal.session import checkpoint_path

UNKNOWN = "unknown"


@dataclass
class PreprocessSpec:
    one_hot: list[str] = field(default_factory=list)
    ordinal: list[str] = field(default_factory=list)
    log: list[str] = field(default_factory=list)
    standard: list[str] = field(default_factory=list)
    robust: list[str] = field(default_factory=list)
    binary: list[str] = field(default_factory=list)
    target_enc: list[str] = field(default_factory=list)
    passthrough: list[str] = field(default_factory=list)
    target: str | None = None
    ordinal_categories: dict[str, list[str]] = field(default_factory=dict)  # from value maps
    smoothing: float = 1.0
    quantile_method: str = "exact"       # exact (bounded-memory selection) | percentile | approx
    quantile_accuracy: int = 10000

    def deduplicated(self) -> PreprocessSpec:
        """One column, one transformer (log > robust > standard > binary >
        one-hot > ordinal > target)."""
        from credal.registry import dedupe_by_priority
        d = dedupe_by_priority({"log": self.log, "robust": self.robust, "standard": self.standard,
                                "binary": self.binary, "one_hot": self.one_hot, "ordinal": self.ordinal,
                                "target": self.target_enc})
        kw = asdict(self)
        kw.update(log=d["log"], robust=d["robust"], standard=d["standard"], binary=d["binary"],
                  one_hot=d["one_hot"], ordinal=d["ordinal"], target_enc=d["target"])
        return PreprocessSpec(**kw)


@dataclass
class Params:
    spec: dict
    medians: dict[str, float | None] = field(default_factory=dict)
    indicators: list[str] = field(default_factory=list)
    means: dict[str, float] = field(default_factory=dict)
    scales: dict[str, float] = field(default_factory=dict)
    log_means: dict[str, float] = field(default_factory=dict)
    log_scales: dict[str, float] = field(default_factory=dict)
    robust_centers: dict[str, float] = field(default_factory=dict)
    robust_scales: dict[str, float] = field(default_factory=dict)
    categories: dict[str, list[str]] = field(default_factory=dict)
    ordinal_categories: dict[str, list[str]] = field(default_factory=dict)  # few categories: in place
    ordinal_tables: dict[str, str] = field(default_factory=dict)           # more: Parquet (category, value)
    te_maps: dict[str, dict[str, float]] = field(default_factory=dict)     # few categories: in place
    te_tables: dict[str, str] = field(default_factory=dict)                # more: Parquet (category, value)
    small_tables: list[str] = field(default_factory=list)                  # those of the two that every task can hold
    te_global: float | None = None
    dropped: list[str] = field(default_factory=list)
    feature_names: list[str] = field(default_factory=list)
    sources: dict[str, str] = field(default_factory=dict)                  # output column → input column

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> Params:
        return cls(**json.loads(text))


# The per-column expressions are written as SQL text: one parse per expression
# instead of a dozen driver round trips each, which matters for wide matrices.
def _q(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def _num_sql(c: str) -> str:
    """C08 as SQL: try_cast to double, NaN → NULL."""
    return f"nullif(try_cast({_q(c)} AS DOUBLE), double('NaN'))"


def _num(c: str) -> Column:
    return F.expr(_num_sql(c))


def _cat(c: str) -> Column:
    return F.expr(f"coalesce(CAST({_q(c)} AS STRING), '{UNKNOWN}')")


def _log_expr(c: str) -> Column:
    """Impute 0 then log1p(max(x, 0))."""
    return F.expr(f"log1p(greatest(coalesce({_num_sql(c)}, 0D), 0D))")


def _safe_scale(s: float | None) -> float:
    return 1.0 if s is None or s == 0 or (isinstance(s, float) and math.isnan(s)) else float(s)


# E04–E20 ---------------------------------------------------------------------------
def fit(df: DataFrame, spec: PreprocessSpec) -> Params:
    """Learn all parameters on the training rows."""
    spec = spec.deduplicated()
    p = Params(spec=asdict(spec))
    present = set(df.columns)
    median_cols = [c for c in spec.standard + spec.robust if c in present]

    # job 1: moments of present values, log moments
    exprs: list[Column] = [F.count(F.lit(1)).alias("__n")]
    for c in median_cols:
        exprs += [F.count(_num(c)).alias(f"cnt__{c}"),
                  F.avg(_num(c)).alias(f"avg__{c}"),
                  F.var_pop(_num(c)).alias(f"var__{c}")]
    for c in spec.log:
        if c in present:
            exprs += [F.avg(_log_expr(c)).alias(f"lavg__{c}"), F.stddev_pop(_log_expr(c)).alias(f"lstd__{c}")]
    te = [c for c in spec.target_enc if c in present] if spec.target and spec.target in present else []
    if te:
        exprs.append(F.avg(F.col(spec.target).cast("double")).alias("__target"))
    # Ordinal categories come from the value maps only when every ordinal column
    # has one; otherwise all of them are learned from the data
    ordinal_present = [c for c in spec.ordinal if c in present]
    use_maps = bool(ordinal_present) and all(c in spec.ordinal_categories for c in ordinal_present)
    row = df.agg(*exprs).first().asDict()
    n = row["__n"]
    # medians: exact selection (bounded memory) unless another method is asked for
    med = quantiles(df.select(*[_num(c).alias(c) for c in median_cols]), median_cols, [0.5],
                    spec.quantile_method, spec.quantile_accuracy)
    for c in median_cols:
        row[f"med__{c}"] = med[c][0]

    for c in median_cols:
        med, cnt, mu, var = row[f"med__{c}"], row[f"cnt__{c}"], row[f"avg__{c}"], row[f"var__{c}"]
        if cnt == 0:  # no observed value: the median imputer drops the column
            p.dropped.append(c)
            continue
        p.medians[c] = float(med)
        m = n - cnt
        if c in spec.standard:
            if m > 0:
                p.indicators.append(c)
            # moments of the imputed column: present values ∪ m copies of the median
            mean_all = (cnt * mu + m * med) / n
            m2 = var * cnt + (med - mu) ** 2 * cnt * m / n
            p.means[c] = mean_all
            p.scales[c] = _safe_scale(math.sqrt(max(m2 / n, 0.0)))
    for c in p.indicators:
        share = (n - row[f"cnt__{c}"]) / n
        p.means[f"__ind__{c}"] = share
        p.scales[f"__ind__{c}"] = _safe_scale(math.sqrt(share * (1 - share)))
    for c in spec.log:
        if c in present:
            p.log_means[c] = float(row[f"lavg__{c}"] or 0.0)
            p.log_scales[c] = _safe_scale(row[f"lstd__{c}"])
    p.categories = _one_hot_categories(df, [c for c in spec.one_hot if c in present])
    for c in ordinal_present:
        if use_maps:
            p.ordinal_categories[c] = sorted(spec.ordinal_categories[c])
        else:
            few, path = _ordinal_positions(df, c)
            if path is None:
                p.ordinal_categories[c] = few
            else:
                p.ordinal_tables[c] = path

    # job 2: robust quartiles of the median-imputed values
    rob = [c for c in spec.robust if c in p.medians]
    if rob:
        imputed = df.select(*[F.coalesce(_num(c), F.lit(p.medians[c])).alias(c) for c in rob])
        q = quantiles(imputed, rob, [0.25, 0.75], spec.quantile_method, spec.quantile_accuracy)
        for c in rob:
            q25, q75 = q[c]
            p.robust_centers[c] = p.medians[c]
            p.robust_scales[c] = _safe_scale(q75 - q25)

    # job 3+: smoothed target encoding (one grouped aggregate per column)
    if te:
        k = 1.0 / spec.smoothing
        glob = p.te_global = row["__target"]
        for c in te:
            # rows without a category do not shape the map (they get the global mean)
            stats = (df.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("category"))
                     .agg(F.avg(F.col(spec.target).cast("double")).alias("m"), F.count(F.lit(1)).alias("n")))
            value = (F.col("n") * F.col("m") + F.lit(k * glob)) / (F.col("n") + F.lit(k))
            path = checkpoint_path(df.sparkSession, f"target-encoding-{uuid.uuid4().hex[:12]}")
            stats.select("category", value.alias("value")).write.parquet(path)
            few = df.sparkSession.read.parquet(path).limit(LITERAL_MAP_MAX + 1).collect()
            if len(few) <= LITERAL_MAP_MAX:      # as literals: same values, no join
                p.te_maps[c] = {r["category"]: r["value"] for r in few}
            else:
                p.te_tables[c] = path
    p.small_tables = [path for path in [*p.te_tables.values(), *p.ordinal_tables.values()] if _is_small(df.sparkSession.read.parquet(path))]
    names = _output_names(p)
    p.feature_names = [name for name, _ in names]
    p.sources = dict(names)
    return p


def _one_hot_categories(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted categories of the one-hot columns, one output column each: a grouped
    count of (column, value) with map-side combining, then one row per output."""
    out: dict[str, list[str]] = {c: [] for c in columns}
    if columns:
        pairs = F.array(*[F.struct(F.lit(c).alias("column"), _cat(c).alias("value")) for c in columns])
        for r in df.select(F.explode(pairs).alias("p")).select("p.*").distinct().collect():
            out[r["column"]].append(r["value"])
    return {c: sorted(v, key=lambda x: x.encode()) for c, v in out.items()}


def _ordinal_positions(df: DataFrame, column: str) -> tuple[list[str], str | None]:
    """The sorted categories, or where their (category, value) table is
    written if they are more than a literal should hold."""
    from credal.operators.aggregate import index_table
    path = checkpoint_path(df.sparkSession, f"ordinal-{uuid.uuid4().hex[:12]}")
    index = index_table(df.select(_cat(column).alias("category")), "category")
    index.select("category", (F.col("index") - 1).cast("double").alias("value")).write.parquet(path)
    few = df.sparkSession.read.parquet(path).limit(LITERAL_MAP_MAX + 1).collect()
    if len(few) > LITERAL_MAP_MAX:
        return [], path
    return [r["category"] for r in sorted(few, key=lambda r: r["value"])], None


def _output_names(p: Params) -> list[tuple[str, str]]:
    """(output column, input column) in transform order (no expressions built)."""
    s = p.spec
    names = [(f"ohe__{c}_{v}", c) for c in s["one_hot"] for v in p.categories.get(c, [])]
    names += [(f"ordinal__{c}", c) for c in s["ordinal"] if c in p.ordinal_tables or p.ordinal_categories.get(c) is not None]
    names += [(f"log__{c}", c) for c in s["log"] if c in p.log_means]
    names += [(f"standard__{c}", c) for c in s["standard"] if c in p.means]
    names += [(f"standard__missingindicator_{c}", c) for c in p.indicators]
    names += [(f"robust__{c}", c) for c in s["robust"] if c in p.robust_centers]
    names += [(f"binary__{c}", c) for c in s["binary"]]
    names += [(f"target_enc__{c}", c) for c in s["target_enc"] if c in p.te_maps or c in p.te_tables]
    return names


def _output_exprs(p: Params) -> list[tuple[str, Column]]:
    s = p.spec
    out: list[tuple[str, Column]] = []
    for c in s["one_hot"]:
        cats = p.categories.get(c, [])
        # position of the value in the sorted category list, computed once per row (CSE);
        # each indicator is then an integer comparison
        pos = F.array_position(F.array(*[F.lit(v) for v in cats]), _cat(c)) if cats else None
        for i, v in enumerate(cats):
            out.append((f"ohe__{c}_{v}", F.when(pos == F.lit(i + 1), 1.0).otherwise(0.0)))
    for c in s["ordinal"]:
        if c in p.ordinal_tables:  # the column is filled from the join
            out.append((f"ordinal__{c}", F.coalesce(F.col(f"`__ord_{c}`"), F.lit(-1.0))))
            continue
        cats = p.ordinal_categories.get(c)
        if cats is None:
            continue
        idx = F.array_position(F.array(*[F.lit(v) for v in cats]), _cat(c))
        out.append((f"ordinal__{c}", F.when(idx > 0, (idx - 1).cast("double")).otherwise(F.lit(-1.0))))
    for c in s["log"]:
        if c in p.log_means:
            out.append((f"log__{c}", (_log_expr(c) - F.lit(p.log_means[c])) / F.lit(p.log_scales[c])))
    for c in s["standard"]:
        if c in p.means:
            imp = F.coalesce(_num(c), F.lit(p.medians[c]))
            out.append((f"standard__{c}", (imp - F.lit(p.means[c])) / F.lit(p.scales[c])))
    for c in p.indicators:
        ind = F.when(_num(c).isNull(), 1.0).otherwise(0.0)
        out.append((f"standard__missingindicator_{c}",
                    (ind - F.lit(p.means[f"__ind__{c}"])) / F.lit(p.scales[f"__ind__{c}"])))
    for c in s["robust"]:
        if c in p.robust_centers:
            imp = F.coalesce(_num(c), F.lit(p.medians[c]))
            out.append((f"robust__{c}", (imp - F.lit(p.robust_centers[c])) / F.lit(p.robust_scales[c])))
    for c in s["binary"]:
        out.append((f"binary__{c}", F.coalesce(_num(c), F.lit(0.0))))
    for c in s["target_enc"]:
        if c in p.te_maps:
            mp = p.te_maps[c]
            value = F.try_element_at(F.create_map(*[F.lit(x) for kv in sorted(mp.items()) for x in kv]), _cat(c)) \
                if mp else F.lit(None).cast("double")
            out.append((f"target_enc__{c}", F.coalesce(value, F.lit(p.te_global))))
        elif c in p.te_tables:  # the column is filled from the join
            out.append((f"target_enc__{c}", F.coalesce(F.col(f"`__te_{c}`"), F.lit(p.te_global))))
    return out


# A literal map is searched linearly per row; past this size the encoding is a join. Same values.
LITERAL_MAP_MAX = 32


# Tables up to this size (characters and 64 bytes a row) are broadcast: every row of the
# matrix would otherwise be shuffled and sorted for one column.
BROADCAST_BYTES = 64_000_000


def _is_small(table: DataFrame) -> bool:
    n, length = table.agg(F.count(F.lit(1)), F.sum(F.octet_length("category"))).first()
    return 64 * n + (length or 0) <= BROADCAST_BYTES


def _with_tables(df: DataFrame, p: Params) -> DataFrame:
    """Attach ``__te_<c>`` and ``__ord_<c>`` for encodings kept as tables."""
    for prefix, tables in (("__te_", p.te_tables), ("__ord_", p.ordinal_tables)):
        for c, path in tables.items():
            table = df.sparkSession.read.parquet(path).toDF(f"__k_{c}", f"{prefix}{c}")
            table = F.broadcast(table) if path in p.small_tables else table
            df = df.join(table, _cat(c) == F.col(f"`__k_{c}`"), "left").drop(f"__k_{c}")
    return df


def transform(df: DataFrame, p: Params, keep: Sequence[str] = ()) -> DataFrame:
    """Apply fitted parameters: one ``select``; ``keep`` columns (ids, target,
    split) are carried in front, then ``spec.passthrough`` columns."""
    base = _with_tables(df, p)
    cols = [F.col(k) for k in keep]
    cols += [e.alias(name) for name, e in _output_exprs(p)]
    cols += [F.col(c) for c in p.spec.get("passthrough", []) if c in df.columns]
    return base.select(*cols)


def fit_transform(df: DataFrame, spec: PreprocessSpec, keep: Sequence[str] = ()) -> tuple[DataFrame, Params]:
    p = fit(df, spec)
    return transform(df, p, keep), p


def get_x_y(df: DataFrame, p: Params, key: str, target: str) -> DataFrame:
    """E20 ``get_X_y``: key, features and label (cast to int) of every row in
    one ``select``; nothing is aligned by position or joined."""
    out = transform(df, p, keep=[key, target])
    return out.withColumn(target, F.col(target).cast("int")).select(key, *p.feature_names, target)


# E04 / E05 (toolkit variants) ----------------------------------------------------------
def fit_imputation(df: DataFrame, numeric: Sequence[str] = (), categorical: Sequence[str] = (),
                   overrides: dict[str, object] | None = None, method: str = "exact") -> dict[str, object]:
    """Medians of numeric columns (exact, bounded memory) and modes of
    categorical columns (most frequent, smallest on ties); per-column
    overrides win (a constant such as 0 or "INCONNU")."""
    from credal.operators.aggregate import column_modes
    values: dict[str, object] = {}
    if numeric:
        med = quantiles(df, list(numeric), [0.5], method)
        values.update({c: med[c][0] for c in numeric})
    if categorical:
        values.update({r["column"]: r["mode"] for r in column_modes(df, list(categorical)).collect()})
    values.update(overrides or {})
    return values


def impute_exprs(df: DataFrame, values: dict[str, object]) -> list[Column]:
    """``coalesce(c, value)`` for the imputed columns, others unchanged."""
    return [F.coalesce(F.col(c), F.lit(values[c]).cast(df.schema[c].dataType)).alias(c) if c in values
            else F.col(c) for c in df.columns]


def missing_indicator_exprs(df: DataFrame, min_share: float = 0.0, columns: Sequence[str] | None = None,
                            suffix: str = "_Manquant") -> list[Column]:
    """E06 (toolkit): a 0/1 ``<c>_Manquant`` column for every column whose
    missing share exceeds ``min_share`` (one aggregate decides which)."""
    cols = list(columns or df.columns)
    row = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first().asDict()
    n = max(row["__n"], 1)
    return [F.col(c).isNull().cast("int").alias(f"{c}{suffix}") for c in cols if row[c] / n > min_share]


def fit_standard(df: DataFrame, columns: Sequence[str], ddof: int = 1) -> dict[str, tuple[float, float]]:
    """E09 (toolkit): mean and sample (ddof=1) or population (ddof=0) σ in one
    aggregate; σ = 0 or undefined → 1."""
    sd = F.stddev_samp if ddof == 1 else F.stddev_pop
    row = df.agg(*[e for c in columns for e in (F.avg(c).alias(f"{c}__m"), sd(c).alias(f"{c}__s"))]).first()
    return {c: (row[f"{c}__m"], _safe_scale(row[f"{c}__s"])) for c in columns}


def standardize_exprs(params: dict[str, tuple[float, float]], suffix: str = "") -> list[Column]:
    """``(x − μ) / σ`` for the fitted columns."""
    return [((F.col(c) - F.lit(m)) / F.lit(s)).alias(f"{c}{suffix}") for c, (m, s) in params.items()]


def factorize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every column replaced by the position of its value among its sorted
    distinct values (0, 1, …); NULL stays NULL. The positions are a table joined
    back, so a column may have any number of values."""
    from credal.operators.aggregate import index_table
    out = df
    for c in columns:
        index = index_table(df, c).select(F.col(c).alias("__v"), (F.col("index") - 1).cast("int").alias("__i"))
        out = out.join(index, F.col(c) == F.col("__v"), "left").withColumn(c, F.col("__i")).drop("__v", "__i")
    return out.select(*df.columns)


# E08 / E11 / E13 / E17 / E18 (toolkit variants) --------------------------------------
def fit_log_shift(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """shift = |min| + 1 when min < 0 else 0 (one aggregate)."""
    row = df.agg(*[F.min(c).alias(c) for c in columns]).first().asDict()
    return {c: (abs(row[c]) + 1.0 if row[c] is not None and row[c] < 0 else 0.0) for c in columns}


def log_shift_exprs(shifts: dict[str, float], suffix: str = "_log", missing_to_zero: bool = False) -> list[Column]:
    """``log1p(x + shift)`` as a new column beside the original."""
    out = []
    for c, s in shifts.items():
        e = F.log1p(F.col(c) + F.lit(s))
        out.append((F.coalesce(e, F.lit(0.0)) if missing_to_zero else e).alias(f"{c}{suffix}"))
    return out


def fit_winsor_bounds(df: DataFrame, columns: Sequence[str], lower: float = 0.01, upper: float = 0.99,
                      method: str = "exact", accuracy: int = 10000) -> dict[str, tuple[float, float]]:
    """Learn the 1 % / 99 % bounds (linear interpolation when exact)."""
    q = quantiles(df, columns, [lower, upper], method, accuracy)
    return {c: (q[c][0], q[c][1]) for c in columns if q[c][0] is not None}


def winsorize_exprs(bounds: dict[str, tuple[float, float]], suffix: str | None = None) -> list[Column]:
    """Clip to the learned bounds; NULL stays NULL; in place or ``_wins``."""
    out = []
    for c, (lo, hi) in bounds.items():
        e = F.when(F.col(c).isNull(), F.lit(None)).otherwise(F.greatest(F.lit(lo), F.least(F.lit(hi), F.col(c))))
        out.append(e.alias(c if suffix is None else f"{c}{suffix}"))
    return out


def one_hot_drop_first_exprs(categories: dict[str, list[str]]) -> list[Column]:
    """Dummies without the first sorted category."""
    out = []
    for c, cats in categories.items():
        for v in sorted(cats)[1:]:
            out.append(F.when(F.col(c) == F.lit(v), 1).otherwise(0).alias(f"{c}_{v}"))
    return out


def fit_target_additive(df: DataFrame, column: str, target: str, smoothing: float = 10.0) -> DataFrame:
    """Per category ``(n·mean + s·global)/(n + s)`` as a DataFrame
    ``(column, encoded)`` of any size, joined back by :func:`apply_target_map`. Null categories get no entry (→ global)."""
    glob = df.agg(F.avg(F.col(target).cast("double"))).first()[0]
    stats = df.where(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col(target).cast("double")).alias("m"))
    return stats.select(column, ((F.col("n") * F.col("m") + F.lit(smoothing * glob)) /
                                 (F.col("n") + F.lit(smoothing))).alias("encoded"),
                        F.lit(glob).alias("global_mean"))


def apply_target_map(df: DataFrame, mapping: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """E17 transform: encoded value or the global mean for unseen categories;
    the original column is replaced by ``<col>_Encoded``."""
    out = out or f"{column}_Encoded"
    glob_row = mapping.select("global_mean").first()
    glob = glob_row[0] if glob_row else None
    m = mapping.select(column, F.col("encoded").alias(out))
    return df.join(m, column, "left").withColumn(out, F.coalesce(F.col(out), F.lit(glob))).drop(column)


def out_of_fold_target_encoding(df: DataFrame, column: str, target: str, fold_col: str,
                                out: str | None = None) -> DataFrame:
    """Every row encoded with the target mean of its category in the
    *other* folds; no loop over folds:

        oof = (Σ_cat − Σ_cat,fold) / (n_cat − n_cat,fold)

    One aggregate per (category, fold), totals per category by a window over
    that small table, one join back on (category, fold). A category absent
    from the other folds (denominator 0) and a NULL category get the global
    mean. A category holding a third of the rows is still one row per fold
    after the partial aggregate, so the skew never reaches the join.
    """
    from pyspark.sql import Window
    out = out or f"{column}_oof"
    y = F.col(target).cast("double")
    glob = df.agg(F.avg(y)).first()[0]
    per_fold = df.where(F.col(column).isNotNull()).groupBy(column, fold_col).agg(
        F.sum(y).alias("_s"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(column)
    enc = per_fold.select(
        column, fold_col,
        F.when(F.sum("_n").over(w) - F.col("_n") > 0,
               (F.sum("_s").over(w) - F.col("_s")) / (F.sum("_n").over(w) - F.col("_n"))).alias(out))
    # (category, fold) rows: broadcast by their measured size; beyond it a hot category's
    # partition of the big side is split by the skew join
    res = df.join(enc, [column, fold_col], "left")
    return res.withColumn(out, F.coalesce(F.col(out), F.lit(glob)))


# E21 / E22 -----------------------------------------------------------------------------
def matrix_quality(df: DataFrame, columns: Sequence[str], target: str | None = None,
                   imbalance_threshold: float = 0.05) -> DataFrame:
    """Null total, constant and infinite columns, class rate — one wide
    aggregate, unpivoted to ``(column, nulls, infinite, distinct_le1)``; the
    class-rate row carries the imbalance flag."""
    exprs = []
    for c in columns:
        col = F.col(c)
        exprs += [F.count_if(col.isNull() | F.isnan(col)).alias(f"{c}__nulls"),
                  F.count_if(F.abs(col) == F.lit(float("inf"))).alias(f"{c}__inf"),
                  (F.min(col).eqNullSafe(F.max(col))).alias(f"{c}__const")]
    if target:
        exprs.append(F.avg(F.col(target).cast("double")).alias("__class_rate"))
    wide = df.agg(*exprs)
    stack = ", ".join(f"'{c}', `{c}__nulls`, `{c}__inf`, `{c}__const`" for c in columns)
    long = wide.selectExpr(f"stack({len(columns)}, {stack}) AS (column, nulls, infinite, constant)",
                           *(["__class_rate"] if target else []))
    if target:
        long = long.withColumn("imbalanced", F.col("__class_rate") < F.lit(imbalance_threshold)) \
                   .withColumnRenamed("__class_rate", "class_rate")
    return long


def final_audit(train: DataFrame, test: DataFrame, columns: Sequence[str], tol: float = 0.1) -> DataFrame:
    """Identical ordered columns, no nulls, share of columns with
    mean ≈ 0 and σ ≈ 1 (± tol) on train."""
    exprs = []
    for c in columns:
        exprs += [F.avg(c).alias(f"{c}__m"), F.stddev_pop(c).alias(f"{c}__s"), F.count_if(F.col(c).isNull()).alias(f"{c}__n")]
    stack = ", ".join(f"'{c}', `{c}__m`, `{c}__s`, `{c}__n`" for c in columns)
    per_col = train.agg(*exprs).selectExpr(f"stack({len(columns)}, {stack}) AS (column, mean, std, nulls)")
    scaled = F.avg(F.when((F.abs(F.col("mean")) <= tol) & (F.abs(F.col("std") - 1) <= tol), 1.0).otherwise(0.0))
    return per_col.agg(
        F.lit(list(train.columns) == list(test.columns)).alias("same_columns"),
        (F.sum("nulls") == 0).alias("no_nulls"),
        scaled.alias("scaled_share"),
        F.count(F.lit(1)).alias("n_columns"))
