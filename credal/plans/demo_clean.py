"""Demo queries: cleaning and recoding column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from credal.functions import clean as C
from credal.plans.catalog import register, rounded, table
from credal.sources.io import quarantine_split, rule_violations

TOKENS_SQL = """
WITH t AS (
  SELECT l_orderkey, l_linenumber,
         CASE l_linenumber WHEN 1 THEN 'None' WHEN 2 THEN 'nan' WHEN 3 THEN 'NULL' WHEN 4 THEN ' null '
              WHEN 5 THEN 'inf' WHEN 6 THEN '-inf' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS raw
  FROM lineitem),
u AS (SELECT *, CASE WHEN raw IN ('None', 'nan', 'NULL') THEN NULL ELSE raw END AS scrubbed,
             CASE WHEN upper(trim(raw)) IN ('NAN', 'NONE', 'NULL', '') THEN NULL ELSE upper(trim(raw)) END AS scrubbed_strict
      FROM t),
v AS (SELECT *, CASE WHEN isnan(TRY_CAST(scrubbed AS DOUBLE)) THEN NULL ELSE TRY_CAST(scrubbed AS DOUBLE) END AS num FROM u)
SELECT l_orderkey, l_linenumber, raw, scrubbed, scrubbed_strict, num,
       CASE WHEN isnan(num) OR abs(num) = 'inf'::DOUBLE THEN NULL ELSE num END AS finite,
       coalesce(CASE WHEN isnan(num) OR abs(num) = 'inf'::DOUBLE THEN NULL ELSE num END, 0.0) AS finite_or_zero
FROM v
"""


@register("clean_null_tokens", "C07,C08,C27", TOKENS_SQL)
def q_tokens(spark, sf_dir):
    """Null-token scrub (both variants), numeric coercion, ±inf repair."""
    li = table(spark, sf_dir, "lineitem")
    ln = F.col("l_linenumber")
    raw = (F.when(ln == 1, "None").when(ln == 2, "nan").when(ln == 3, "NULL").when(ln == 4, " null ")
           .when(ln == 5, "inf").when(ln == 6, "-inf").otherwise(F.col("l_quantity").cast("bigint").cast("string")))
    t = li.select("l_orderkey", "l_linenumber", raw.alias("raw"))
    t = t.select("*", C.scrub_null_tokens("raw").alias("scrubbed"),
                 C.scrub_null_tokens("raw", strict=True).alias("scrubbed_strict"))
    t = t.withColumn("num", C.coerce_numeric("scrubbed"))
    return t.select("*", C.inf_to_null("num").alias("finite"), C.inf_to_zero("num").alias("finite_or_zero"))


PERCENT_SQL = """
WITH t AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_linenumber = 7 THEN 'n/a'
              WHEN l_linenumber = 1 THEN CAST(CAST(round(l_tax * 100) AS BIGINT) AS VARCHAR) || ',5%'
              ELSE CAST(CAST(round(l_discount * 100) AS BIGINT) AS VARCHAR) || ' %' END AS pct
  FROM lineitem)
SELECT l_orderkey, l_linenumber, pct,
       round(TRY_CAST(replace(regexp_replace(pct, '[%\\s]', '', 'g'), ',', '.') AS DOUBLE) / 100.0, 6) AS fraction,
       round(CASE WHEN regexp_matches(replace(pct, '%', ''), '^[0-9]')
                  THEN TRY_CAST(replace(pct, '%', '') AS DOUBLE) / 100.0 ELSE 0.0 END, 6) AS fraction_sql
FROM t
"""


@register("clean_percent", "C09", PERCENT_SQL)
def q_percent(spark, sf_dir):
    """Percent text → fraction (comma decimals, blanks) and the leading-digit SQL variant."""
    li = table(spark, sf_dir, "lineitem")
    ln = F.col("l_linenumber")
    pct = (F.when(ln == 7, "n/a")
           .when(ln == 1, F.concat(F.round(F.col("l_tax") * 100).cast("bigint").cast("string"), F.lit(",5%")))
           .otherwise(F.concat(F.round(F.col("l_discount") * 100).cast("bigint").cast("string"), F.lit(" %"))))
    t = li.select("l_orderkey", "l_linenumber", pct.alias("pct"))
    return rounded(t.select("*", C.percent_to_fraction("pct").alias("fraction"),
                            C.percent_leading_digit("pct").alias("fraction_sql")))


SENTINEL_SQL = """
WITH t AS (
  SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN 365243
                          ELSE date_diff('day', DATE '2002-01-01', CAST(o_orderdate AS DATE)) END AS days_employed,
         o_totalprice - 250000.0 AS balance, o_totalprice AS due, o_totalprice * 0.9 AS paid
  FROM orders)
SELECT o_orderkey, CASE WHEN days_employed = 365243 THEN NULL ELSE days_employed END AS days_employed,
       round(CASE WHEN balance > 0 THEN balance ELSE 0 END, 6) AS balance_pos,
       round(due - paid, 6) AS shortfall
FROM t
"""


@register("clean_sentinel_clip", "C10,C12,C13,U03", SENTINEL_SQL)
def q_sentinel(spark, sf_dir):
    """365243-day sentinel → NULL, clip at zero (missing → 0), due − paid."""
    o = table(spark, sf_dir, "orders")
    t = o.select("o_orderkey",
                 F.when(F.col("o_orderpriority") == "5-LOW", F.lit(365243))
                 .otherwise(F.datediff(F.col("o_orderdate"), F.lit("2002-01-01"))).alias("days_employed"),
                 (F.col("o_totalprice") - 250000.0).alias("balance"), F.col("o_totalprice").alias("due"),
                 (F.col("o_totalprice") * 0.9).alias("paid"))
    return rounded(t.select("o_orderkey", C.sentinel_to_null("days_employed").alias("days_employed"),
                            C.clip_at_zero("balance").alias("balance_pos"),
                            C.difference("due", "paid").alias("shortfall")))


HR_SQL = """
SELECT c_custkey,
       CAST(round(CAST(CAST(c_acctbal / nullif(c_nationkey + 1, 0) AS VARCHAR) AS DECIMAL(38, 17)), 4) AS DOUBLE) AS fe1_balance_per_nation,
       greatest(c_nationkey + 10 - 18, 1) AS fe2_years_over_18,
       CAST(round(CAST(CAST((c_acctbal / nullif(c_nationkey + 1, 0)) * greatest(c_nationkey + 10 - 18, 1) AS VARCHAR)
                            AS DECIMAL(38, 17)), 4)
            AS DOUBLE) AS fe3_product,
       CAST(round(CAST(CAST((c_nationkey + greatest(c_nationkey + 10 - 18, 1)) / 2.0 AS VARCHAR) AS DECIMAL(38, 17)), 4)
            AS DOUBLE) AS fe4_mean
FROM customer
"""
# ROUND here is the decimal half-up rounding of the reference's database. Spark rounds
# the shortest decimal text of a double; the oracle does the same (double → text →
# decimal → round) instead of rounding the binary value.


@register("clean_ratio_features", "C20", HR_SQL)
def q_hr(spark, sf_dir):
    """Rounded NULLIF(x+1,0) ratios, GREATEST(age−18,1), products and means."""
    c = table(spark, sf_dir, "customer")
    age = F.col("c_nationkey") + 10
    ratio = C.plus_one_ratio("c_acctbal", "c_nationkey")
    yrs = C.years_over(age)
    return c.select("c_custkey", ratio.alias("fe1_balance_per_nation"), yrs.alias("fe2_years_over_18"),
                    F.round((F.col("c_acctbal") / F.when(F.col("c_nationkey") + 1 != 0, F.col("c_nationkey") + 1)) * yrs,
                            4).alias("fe3_product"),
                    F.round((F.col("c_nationkey") + yrs) / 2.0, 4).alias("fe4_mean"))


KEY_SQL = """
WITH t AS (SELECT c_custkey, 'E_' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS raw_key FROM customer)
SELECT c_custkey, raw_key,
       CASE WHEN regexp_replace(regexp_replace(trim(raw_key), '^E_', ''), '^0+', '') = ''
                 AND regexp_replace(trim(raw_key), '^E_', '') <> '' THEN '0'
            ELSE regexp_replace(regexp_replace(trim(raw_key), '^E_', ''), '^0+', '') END AS key
FROM t
"""


@register("clean_key_normalise", "C21,S03", KEY_SQL)
def q_key(spark, sf_dir):
    """Strip the E_ prefix and leading zeros of a text key (a lone zero stays 0)."""
    c = table(spark, sf_dir, "customer")
    t = c.select("c_custkey", F.concat(F.lit("E_"), F.lpad(F.col("c_custkey").cast("string"), 6, "0")).alias("raw_key"))
    return t.select("*", C.normalize_key("raw_key").alias("key"))


BUCKET_SQL = """
SELECT c_custkey,
       CASE WHEN c_acctbal > -1000 AND c_acctbal <= 0 THEN 0 WHEN c_acctbal > 0 AND c_acctbal <= 2500 THEN 1
            WHEN c_acctbal > 2500 AND c_acctbal <= 5000 THEN 2 WHEN c_acctbal > 5000 AND c_acctbal <= 10000 THEN 3 END AS bin,
       CASE WHEN c_acctbal >= -1000 AND c_acctbal <= 0 THEN 'negative' WHEN c_acctbal > 0 AND c_acctbal <= 2500 THEN 'low'
            WHEN c_acctbal > 2500 AND c_acctbal <= 5000 THEN 'mid' WHEN c_acctbal > 5000 AND c_acctbal <= 10000 THEN 'high'
       END AS band
FROM customer
"""


@register("clean_bucketize", "C22", BUCKET_SQL)
def q_bucket(spark, sf_dir):
    """Right-closed bins as index, and as labels with the lowest edge included."""
    c = table(spark, sf_dir, "customer")
    edges = [-1000.0, 0.0, 2500.0, 5000.0, 10000.0]
    return c.select("c_custkey", C.bucketize("c_acctbal", edges).alias("bin"),
                    C.bucketize("c_acctbal", edges, ["negative", "low", "mid", "high"], include_lowest=True).alias("band"))


BINARY_SQL = """
WITH t AS (
  SELECT c_custkey,
         CASE WHEN c_mktsegment = 'BUILDING' THEN (CASE WHEN c_acctbal < 0 THEN 'Oui' ELSE 'Non' END)
              WHEN c_mktsegment = 'MACHINERY' THEN (CASE WHEN c_acctbal < 0 THEN 'Y' ELSE 'N' END)
              WHEN c_mktsegment = 'HOUSEHOLD' THEN (CASE WHEN c_acctbal < 0 THEN 'True' ELSE 'False' END)
              WHEN c_mktsegment = 'FURNITURE' THEN (CASE WHEN c_acctbal < 0 THEN 'Femme' ELSE 'Homme' END)
              ELSE 'maybe' END AS flag
  FROM customer)
SELECT c_custkey, flag,
       CASE WHEN trim(flag) IN ('Oui', 'Yes', 'Y', 'True', 'Homme', 'Male') THEN 1
            WHEN trim(flag) IN ('Non', 'No', 'N', 'False', 'Femme', 'Female') THEN 0 END AS flag01
FROM t
"""


@register("clean_binary_labels", "C23", BINARY_SQL)
def q_binary(spark, sf_dir):
    """Known two-value label pairs (Oui/Non, Y/N, True/False, Homme/Femme) → 1/0."""
    c = table(spark, sf_dir, "customer")
    neg = F.col("c_acctbal") < 0
    seg = F.col("c_mktsegment")
    flag = (F.when(seg == "BUILDING", F.when(neg, "Oui").otherwise("Non"))
            .when(seg == "MACHINERY", F.when(neg, "Y").otherwise("N"))
            .when(seg == "HOUSEHOLD", F.when(neg, "True").otherwise("False"))
            .when(seg == "FURNITURE", F.when(neg, "Femme").otherwise("Homme")).otherwise("maybe"))
    t = c.select("c_custkey", flag.alias("flag"))
    return t.select("*", C.binary_label_map("flag").alias("flag01"))


# A business ↔ code dictionary for the market segment (MACHINERY left out on purpose).
SEGMENT_CODES = {"AUTOMOBILE": "auto", "BUILDING": "build", "FURNITURE": "furn", "HOUSEHOLD": "house"}

DICT_SQL = """
WITH d AS (SELECT * FROM (VALUES ('AUTOMOBILE', 'auto'), ('BUILDING', 'build'), ('FURNITURE', 'furn'),
                                 ('HOUSEHOLD', 'house')) v(business, code))
SELECT c.c_custkey, c.c_mktsegment, coalesce(d1.code, c.c_mktsegment) AS code, d2.business AS decoded,
       (d1.code IS NOT NULL OR d2.business IS NOT NULL) AS is_valid
FROM customer c LEFT JOIN d d1 ON c.c_mktsegment = d1.business
LEFT JOIN d d2 ON coalesce(d1.code, c.c_mktsegment) = d2.code
"""


@register("clean_dictionary", "C24", DICT_SQL)
def q_dict(spark, sf_dir):
    """Dictionary encode (unknown passes through), decode (unknown → NULL), validate."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    enc = c.withColumn("code", C.dictionary_encode("c_mktsegment", SEGMENT_CODES))
    return enc.select("*", C.dictionary_decode("code", SEGMENT_CODES).alias("decoded"),
                      (C.dictionary_is_valid("c_mktsegment", SEGMENT_CODES)).alias("is_valid"))


INVALID_SQL = """
WITH d AS (SELECT * FROM (VALUES ('AUTOMOBILE'), ('BUILDING'), ('FURNITURE'), ('HOUSEHOLD')) v(business))
SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment NOT IN (SELECT business FROM d)
"""


@register("clean_dictionary_invalid", "C24,J06", INVALID_SQL)
def q_invalid(spark, sf_dir):
    """Rows whose value is not in the dictionary, by anti join to the dictionary table."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    d = spark.createDataFrame([(k,) for k in SEGMENT_CODES], "c_mktsegment string")
    return c.join(F.broadcast(d), "c_mktsegment", "left_anti").select("c_custkey", "c_mktsegment")  # 4-row dictionary


FILTER_SQL = """
SELECT c_custkey, c_nationkey, c_acctbal FROM (
  SELECT c_custkey, c_nationkey, c_acctbal,
         CASE WHEN c_nationkey < 12 THEN 'F' WHEN c_nationkey < 24 THEN 'M' ELSE 'XNA' END AS gender,
         CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END END AS target
  FROM customer)
WHERE gender <> 'XNA' AND target IS NOT NULL
"""


@register("clean_row_filter", "C25", FILTER_SQL)
def q_filter(spark, sf_dir):
    """Drop gender XNA and rows without a target."""
    c = table(spark, sf_dir, "customer")
    nat = F.col("c_nationkey")
    t = c.select("c_custkey", "c_nationkey", "c_acctbal",
                 F.when(nat < 12, "F").when(nat < 24, "M").otherwise("XNA").alias("gender"),
                 F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None))
                 .otherwise(F.when(F.col("c_acctbal") < 0, 1).otherwise(0)).alias("target"))
    return t.where(F.col("gender") != "XNA").dropna(subset=["target"]).select("c_custkey", "c_nationkey", "c_acctbal")


USERFEAT_SQL = """
SELECT c_custkey, c_acctbal, round(c_acctbal * 2.0 + c_nationkey, 6) AS balance_score FROM customer
"""


@register("clean_user_feature", "C28,U01,U02", USERFEAT_SQL)
def q_userfeat(spark, sf_dir):
    """A user-defined feature from a callable returning a Column (no-op if it exists)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    fn = lambda df: df["c_acctbal"] * 2.0 + df["c_nationkey"]
    out = C.add_feature(c, "balance_score", fn)
    out = C.add_feature(out, "balance_score", lambda df: F.lit(0.0))  # already present: unchanged
    return rounded(out.drop("c_nationkey"))


# Request bounds of the scoring input (field → (min, max) or allowed values).
REQUEST_RULES = {
    "ext_source_1": (0.01, 0.96),
    "age": (18, 70),
    "region_rating": (1, 3),
    "code_gender": ["M", "F", "XNA"],
}

RULES_SQL = """
WITH r AS (
  SELECT c_custkey, (c_acctbal + 1000.0) / 11000.0 AS ext_source_1, c_nationkey + 10 AS age,
         c_nationkey % 4 AS region_rating,
         CASE WHEN c_nationkey < 12 THEN 'F' WHEN c_nationkey < 20 THEN 'M' WHEN c_nationkey < 24 THEN 'XNA' ELSE '?' END AS code_gender
  FROM customer),
v AS (SELECT *, NOT (ext_source_1 BETWEEN 0.01 AND 0.96) AS bad_ext, NOT (age BETWEEN 18 AND 70) AS bad_age,
             NOT (region_rating BETWEEN 1 AND 3) AS bad_region, NOT (code_gender IN ('M', 'F', 'XNA')) AS bad_gender FROM r)
SELECT 'ext_source_1' AS rule, count(*) FILTER (WHERE bad_ext) AS violations FROM v
UNION ALL SELECT 'age', count(*) FILTER (WHERE bad_age) FROM v
UNION ALL SELECT 'region_rating', count(*) FILTER (WHERE bad_region) FROM v
UNION ALL SELECT 'code_gender', count(*) FILTER (WHERE bad_gender) FROM v
UNION ALL SELECT '__valid_rows', count(*) FILTER (WHERE NOT (bad_ext OR bad_age OR bad_region OR bad_gender)) FROM v
"""


def _requests(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    nat = F.col("c_nationkey")
    return c.select("c_custkey", ((F.col("c_acctbal") + 1000.0) / 11000.0).alias("ext_source_1"),
                    (nat + 10).alias("age"), (nat % 4).alias("region_rating"),
                    F.when(nat < 12, "F").when(nat < 20, "M").when(nat < 24, "XNA").otherwise("?")
                    .alias("code_gender"))


@register("clean_rule_checks", "C31", RULES_SQL)
def q_rules(spark, sf_dir):
    """Range/domain rules → violation counts per rule and the number of valid rows."""
    req = _requests(spark, sf_dir)
    valid, _ = quarantine_split(req, REQUEST_RULES)
    counts = rule_violations(req, REQUEST_RULES)
    return counts.unionByName(spark.createDataFrame([("__valid_rows", valid.count())], "rule string, violations long"))


NARROW_SQL = """
SELECT o_orderkey, CAST(o_totalprice AS FLOAT) AS o_totalprice, o_orderstatus FROM orders
"""


@register("clean_narrow_doubles", "C32", NARROW_SQL)
def q_narrow(spark, sf_dir):
    """Every double column narrowed to float (storage only)."""
    return C.narrow_doubles(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus"))


DIRECTION_SQL = """
SELECT c_custkey, CASE WHEN abs(round(c_acctbal / 10000.0 - 0.45, 5)) < 0.001 THEN 'neutral'
                       WHEN round(c_acctbal / 10000.0 - 0.45, 5) > 0 THEN 'raises_risk' ELSE 'lowers_risk' END AS direction
FROM customer
"""


@register("clean_direction_label", "C33", DIRECTION_SQL)
def q_direction(spark, sf_dir):
    """Impact → neutral (|x| < 0.001), raises or lowers risk."""
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", C.direction_label(F.col("c_acctbal") / 10000.0 - 0.45).alias("direction"))
