"""Scalar Column builders for cleaning, recoding and engineered features.

Each function returns a ``Column``; nothing here triggers a job. All of them
are Catalyst expressions, so they stay inside whole-stage codegen.
ANSI mode is on in Spark 4.x: casts that can fail use ``try_cast``, divisions
are guarded.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed values -----------------------------------------------------------------
# Strings treated as missing by the pipeline scrub, and the toolkit variant
# (compared after trim + upper).
NULL_TOKENS = ("None", "nan", "NULL")
NULL_TOKENS_STRICT = ("NAN", "NONE", "NULL", "")
# Day offset meaning "not applicable".
DAYS_SENTINEL = 365243
# Two-value label pairs mapped to 1/0 (positive first).
BINARY_PAIRS = (
    ("Oui", "Non"), ("Yes", "No"), ("Y", "N"), ("True", "False"), ("Homme", "Femme"), ("Male", "Female"),
)
# Flags that are numbers already.
NUMERIC_PAIRS = (("1", "0"), ("1.0", "0.0"))


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# C02 / C03 / C05 / C06 ------------------------------------------------------------
def identifier(c: ColumnOrName) -> Column:
    """Identifiers as 64-bit integers (never overflows like INTEGER)."""
    return _c(c).try_cast("bigint")


def target_for_split(c: ColumnOrName, is_test: bool) -> Column:
    """The target passes through for train and is NULL for test."""
    return F.lit(None).cast("int") if is_test else _c(c).try_cast("int")


def normalize_category(c: ColumnOrName) -> Column:
    """``lower(trim(cast(x as string)))``."""
    return F.lower(F.trim(_c(c).cast("string")))


def source_tag(value: str) -> Column:
    """Literal split tag."""
    return F.lit(value)


# C04 / C24 --------------------------------------------------------------------------
def value_map_recode(c: ColumnOrName, mapping: Mapping[str, str], unknown: str | None = None) -> Column:
    """Recode by an exact match on ``upper(trim(x))``; anything else → ``unknown``.

    The map is a literal ``create_map`` evaluated inside codegen; a NULL input
    also yields ``unknown`` (the CASE of the reference has no NULL branch).
    """
    if not mapping:
        return F.lit(unknown).cast("string")
    m = F.create_map(*[F.lit(x) for kv in ((k.strip().upper(), v) for k, v in mapping.items()) for x in kv])
    key = F.upper(F.trim(_c(c).cast("string")))
    return F.coalesce(F.try_element_at(m, key), F.lit(unknown).cast("string"))


def dictionary_encode(c: ColumnOrName, business_to_code: Mapping[str, str]) -> Column:
    """C24 ``to_technique``: business value → code; unknown values pass through."""
    m = F.create_map(*[F.lit(x) for kv in business_to_code.items() for x in kv])
    return F.coalesce(F.try_element_at(m, _c(c)), _c(c))


def dictionary_decode(c: ColumnOrName, business_to_code: Mapping[str, str]) -> Column:
    """C24 ``to_metier``: code → business value; unknown codes → NULL."""
    m = F.create_map(*[F.lit(x) for kv in business_to_code.items() for x in reversed(kv)])
    return F.try_element_at(m, _c(c))


def dictionary_is_valid(c: ColumnOrName, business_to_code: Mapping[str, str]) -> Column:
    """C24 ``is_valid``: the value is a known business value or code."""
    vals = sorted(set(business_to_code) | set(business_to_code.values()))
    return _c(c).isin(vals)


# C07 / C08 / C09 / C10 -------------------------------------------------------------
def scrub_null_tokens(c: ColumnOrName, tokens: Iterable[str] = NULL_TOKENS, strict: bool = False) -> Column:
    """Textual null tokens → NULL.

    ``strict`` is the toolkit variant: compare ``upper(trim(x))`` with
    NAN/NONE/NULL/empty and return the trimmed, upper-cased value otherwise.
    """
    col = _c(c)
    if strict:
        norm = F.upper(F.trim(col.cast("string")))
        return F.when(norm.isin(list(NULL_TOKENS_STRICT)), F.lit(None).cast("string")).otherwise(norm)
    return F.when(col.isin(list(tokens)), F.lit(None)).otherwise(col)


def coerce_numeric(c: ColumnOrName) -> Column:
    """``to_numeric(errors='coerce')`` — unparsable → NULL, NaN → NULL."""
    d = _c(c).try_cast("double")
    return F.when(F.isnan(d), F.lit(None).cast("double")).otherwise(d)


def nan_to_null(c: ColumnOrName) -> Column:
    """NaN → NULL once at ingest (Spark keeps NaN and NULL apart)."""
    col = _c(c)
    return F.when(F.isnan(col), F.lit(None).cast("double")).otherwise(col)


def percent_to_fraction(c: ColumnOrName) -> Column:
    """Strip ``%`` and blanks, comma → dot, parse, divide by 100."""
    s = F.regexp_replace(F.regexp_replace(_c(c).cast("string"), r"[%\s]", ""), ",", ".")
    return s.try_cast("double") / F.lit(100.0)


def percent_leading_digit(c: ColumnOrName) -> Column:
    """C09, SQL variant: keep values whose text starts with a digit, else 0."""
    s = F.regexp_replace(_c(c).cast("string"), "%", "")
    return F.when(s.rlike("^[0-9]"), s.try_cast("double") / F.lit(100.0)).otherwise(F.lit(0.0))


def sentinel_to_null(c: ColumnOrName, sentinel: float = DAYS_SENTINEL) -> Column:
    """The 365243-day sentinel means "not applicable"."""
    col = _c(c)
    return F.when(col == F.lit(sentinel), F.lit(None)).otherwise(col)


# C11 – C19 ---------------------------------------------------------------------------
def guarded_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """C11: ``num/den`` when ``den > 0`` else NULL."""
    d = _c(den)
    return F.when(d > 0, _c(num).cast("double") / d)


def difference(a: ColumnOrName, b: ColumnOrName) -> Column:
    """``a − b`` (payment delay = entry − due; shortfall = due − paid)."""
    return _c(a) - _c(b)


def clip_at_zero(c: ColumnOrName) -> Column:
    """``x if x > 0 else 0``; the row lambda maps a missing value to 0 too."""
    col = _c(c)
    return F.when(col > 0, col).otherwise(F.lit(0))


def employment_share(days_employed: ColumnOrName, days_birth: ColumnOrName) -> Column:
    """C14: employed/birth only when birth ≠ 0 and employed < 0."""
    e, b = _c(days_employed), _c(days_birth)
    return F.when((b != 0) & (e < 0), e.cast("double") / b)


def age_years(days_birth: ColumnOrName) -> Column:
    """``abs(days_birth)/365.25``."""
    return F.abs(_c(days_birth)) / F.lit(365.25)


def mean_of_available(*cols: ColumnOrName) -> Column:
    """Sum of present values / NULLIF(number present, 0)."""
    total = sum((F.coalesce(_c(c).cast("double"), F.lit(0.0)) for c in cols), F.lit(0.0))
    n = sum((F.when(_c(c).isNotNull(), 1).otherwise(0) for c in cols), F.lit(0))
    return F.when(n > 0, total / n)


def row_min(*cols: ColumnOrName) -> Column:
    """C17: ``LEAST`` skipping NULLs."""
    return F.least(*[_c(c) for c in cols])


def rate_with_default(count: ColumnOrName, total: ColumnOrName, default: float = 0.0) -> Column:
    """count/total, ``default`` when there is no history."""
    n = F.coalesce(_c(total), F.lit(0))
    return F.when(n > 0, F.coalesce(_c(count), F.lit(0)).cast("double") / n).otherwise(F.lit(default))


def composite_score(score2: ColumnOrName, score3: ColumnOrName, overdue: ColumnOrName,
                    credits: ColumnOrName) -> Column:
    """Mean of three coalesced risk terms (defaults 0.5, 0.5, 0.0)."""
    t1 = F.coalesce(F.lit(1.0) - _c(score2), F.lit(0.5))
    t2 = F.coalesce(F.lit(1.0) - _c(score3), F.lit(0.5))
    t3 = F.coalesce(F.coalesce(_c(overdue), F.lit(0)).cast("double") / F.when(_c(credits) != 0, _c(credits)),
                    F.lit(0.0))
    return (t1 + t2 + t3) / F.lit(3.0)


def plus_one_ratio(num: ColumnOrName, den: ColumnOrName, digits: int = 4) -> Column:
    """C20: ``round(num / NULLIF(den + 1, 0), digits)``."""
    d = _c(den) + F.lit(1)
    return F.round(_c(num).cast("double") / F.when(d != 0, d), digits)


def years_over(age: ColumnOrName, floor_age: int = 18) -> Column:
    """C20: ``GREATEST(age − 18, 1)``."""
    return F.greatest(_c(age) - F.lit(floor_age), F.lit(1))


# C21 – C23 ---------------------------------------------------------------------------
def normalize_key(c: ColumnOrName, prefix: str = "E_") -> Column:
    """Strip a prefix, then leading zeros (a lone 0 stays 0)."""
    s = F.regexp_replace(F.trim(_c(c).cast("string")), "^" + prefix, "")
    stripped = F.regexp_replace(s, "^0+", "")
    return F.when((stripped == "") & (s != ""), F.lit("0")).otherwise(stripped)


def normalize_header(name: str) -> str:
    """Header cleanup — strip and lower-case."""
    return name.strip().lower()


def bucketize(c: ColumnOrName, edges: Sequence[float], labels: Sequence[str] | None = None,
              include_lowest: bool = False) -> Column:
    """Right-closed bins ``(e[i], e[i+1]]``.

    Returns the bin index (0-based) or the label. With ``include_lowest`` the
    first bin is closed on the left too. Values outside all bins are NULL.
    (``ml.Bucketizer`` is left-closed, so it is not used.)
    """
    col = _c(c)
    expr = None
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        cond = (col > lo) & (col <= hi)
        if include_lowest and i == 0:
            cond = (col >= lo) & (col <= hi)
        val = F.lit(labels[i]) if labels is not None else F.lit(i)
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr


def binary_label_map(c: ColumnOrName, pairs: Sequence[tuple[str, str]] = BINARY_PAIRS) -> Column:
    """A known positive/negative label → 1/0, anything else → NULL."""
    col = F.trim(_c(c).cast("string"))
    pos = sorted({p for p, _ in pairs})
    neg = sorted({n for _, n in pairs})
    return F.when(col.isin(pos), F.lit(1)).when(col.isin(neg), F.lit(0))


def map_binary_columns(df: DataFrame, columns: Sequence[str],
                       pairs: Sequence[tuple[str, str]] = BINARY_PAIRS) -> DataFrame:
    """C23 on whole columns: a column whose non-null values are exactly the two
    labels of one pair becomes 1/0, any other stays as it is. One aggregate."""
    def counts(c, p):
        v = F.trim(F.col(c).cast("string"))
        return F.struct(F.count_if(v == p[0]).alias("pos"), F.count_if(v == p[1]).alias("neg"))

    seen = df.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(columns)],
                  *[counts(c, p).alias(f"p{i}_{j}") for i, c in enumerate(columns) for j, p in enumerate(pairs)]).first()
    found = {c: [p] for i, c in enumerate(columns) for j, p in enumerate(pairs)
             if min(seen[f"p{i}_{j}"]) > 0 and sum(seen[f"p{i}_{j}"]) == seen[f"n{i}"]}
    return df.withColumns({c: binary_label_map(c, p) for c, p in found.items()})


# C27 / C32 ---------------------------------------------------------------------------
def inf_to_null(c: ColumnOrName) -> Column:
    """±inf and NaN → NULL."""
    col = _c(c)
    return F.when(F.isnan(col) | (F.abs(col) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(col)


def inf_to_zero(c: ColumnOrName) -> Column:
    """C27 (training input): ±inf, NaN and NULL → 0."""
    return F.coalesce(inf_to_null(c), F.lit(0.0))


def narrow_doubles(df: DataFrame) -> DataFrame:
    """Every double column → float (storage only)."""
    return df.select(*[F.col(f.name).cast("float").alias(f.name) if f.dataType.typeName() == "double"
                       else F.col(f.name) for f in df.schema.fields])


def repair_matrix(df: DataFrame, to_zero: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """C27 on a whole table: ±inf/NaN repaired in every numeric column and, for
    the training input, string columns dropped and missing → 0. ``keep``
    columns (ids, target, split) pass through untouched."""
    out = [F.col(k) for k in keep]
    for f in df.schema.fields:
        if f.name in keep:
            continue
        t = f.dataType.typeName()
        if t in ("double", "float"):
            out.append((inf_to_zero(f.name) if to_zero else inf_to_null(f.name)).alias(f.name))
        elif t == "string":
            if not to_zero:
                out.append(F.col(f.name))
        elif to_zero and t in ("integer", "long", "short", "byte", "decimal"):
            out.append(F.coalesce(F.col(f.name), F.lit(0)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


# C29 / C33 -----------------------------------------------------------------------------
APPROVED = "approved"
REFUSED = "refused"


def decision(p: ColumnOrName, threshold: float) -> Column:
    """``p < t`` → approved, else refused; probability outside [0,1] → NULL."""
    col = _c(p)
    return (F.when((col < 0) | (col > 1) | col.isNull(), F.lit(None).cast("string"))
            .when(col < F.lit(threshold), F.lit(APPROVED)).otherwise(F.lit(REFUSED)))


def direction_label(impact: ColumnOrName, eps: float = 0.001) -> Column:
    """|impact| < eps → neutral; > 0 → raises risk; else lowers."""
    col = F.round(_c(impact), 5)
    return (F.when(F.abs(col) < eps, F.lit("neutral"))
            .when(col > 0, F.lit("raises_risk")).otherwise(F.lit("lowers_risk")))


# C28 -------------------------------------------------------------------------------------
def add_feature(df: DataFrame, name: str, fn, dtype: str = "double") -> DataFrame:
    """Add a user-defined feature; no-op if the name exists.

    ``fn`` receives the DataFrame and returns a Column expression.
    """
    if name in df.columns:
        return df
    return df.withColumn(name, fn(df).cast(dtype))
