"""Sources and sinks (S01–S16) and request rule checks.

Everything reads and writes through Spark's distributed readers and
writers; paths may be local, HDFS or object-store URIs. Scratch output of the
demo jobs goes under the cluster's shared checkpoint folder, never to a
machine-local temporary folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credal.functions.clean import normalize_header
from credal.session import checkpoint_path

CORRUPT = "_corrupt_record"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return checkpoint_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def _exists(spark: SparkSession, path: str) -> bool:
    """Path existence through the Hadoop filesystem of the session (works for
    local, HDFS and object stores)."""
    try:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(conf).exists(p)
    except Exception:  # no JVM handle (remote session): let the reader decide
        try:
            spark.read.format("binaryFile").load(path).limit(1).count()
            return True
        except Exception:
            return False


# S01 / S03 ------------------------------------------------------------------------
def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, header: bool = True,
             sep: str = ",", keep_corrupt: bool = False) -> DataFrame:
    """CSV scan with an explicit schema (no inference pass). With
    ``keep_corrupt`` malformed rows are marked in ``_corrupt_record`` (Spark
    refuses a raw scan whose query needs only that column — select it together
    with a data column); otherwise :func:`split_malformed` takes them out. Every
    read parses whole rows, so the rows do not depend on the columns in use."""
    r = spark.read.option("header", header).option("sep", sep)
    if schema is not None:
        full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)])
        df = r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).schema(full).csv(path)
        return df if keep_corrupt else split_malformed(df)[0]
    return r.option("inferSchema", True).csv(path)


def split_malformed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(well-formed rows without the mark, quarantined rows with it) of a
    ``read_csv(keep_corrupt=True)`` table. The test names every data column
    beside the mark: Spark marks a row by the columns a query converts."""
    data = [F.col(f"`{c}`").cast("string") for c in df.columns if c != CORRUPT]
    mark = F.concat(F.col(CORRUPT), F.concat_ws("", *data))
    return df.where(mark.isNull()).drop(CORRUPT), df.where(mark.isNotNull())


def normalize_headers(df: DataFrame, rename: Mapping[str, str] | None = None) -> DataFrame:
    """Raw → technical names from the registry, then strip + lower-case."""
    if rename:
        df = df.withColumnsRenamed({k: v for k, v in rename.items() if k in df.columns})
    return df.toDF(*[normalize_header(c) for c in df.columns])


# S02 ------------------------------------------------------------------------------
def ingest_all(spark: SparkSession, files: Mapping[str, str], schemas: Mapping[str, T.StructType] | None = None,
               renames: Mapping[str, Mapping[str, str]] | None = None, out_dir: str | None = None
               ) -> tuple[dict[str, DataFrame], DataFrame]:
    """Read every table of ``files`` (table → path); a missing file is
    skipped with status ``missing`` rather than failing. When ``out_dir`` is
    given each table is written as parquet (S04) and malformed rows go to
    ``<out_dir>/_malformed/<table>``. Returns the tables and a per-table report
    (table, path, status, rows, columns, malformed); ``malformed`` is the number
    of rows taken out (0 without a schema: every row is text then)."""
    tables, report = {}, []
    for name, path in files.items():
        if not _exists(spark, path):
            report.append((name, path, "missing", None, None, None))
            continue
        schema, malformed = (schemas or {}).get(name), 0
        df = read_csv(spark, path, schema, keep_corrupt=True)
        if schema is not None:
            df, bad = split_malformed(df)
            malformed = bad.count()
            if out_dir and malformed:
                write_table(bad, f"{out_dir.rstrip('/')}/_malformed/{name}")
        df = normalize_headers(df, (renames or {}).get(name))
        if out_dir:
            target = f"{out_dir.rstrip('/')}/{name}"
            write_table(df, target)
            df = spark.read.parquet(target)
        tables[name] = df
        report.append((name, path, "loaded", df.count(), len(df.columns), malformed))
    rep = spark.createDataFrame(report, "table string, path string, status string, rows long, columns int, malformed long")
    return tables, rep


# S04 / S07 / S08 / S15 / S16 ----------------------------------------------------------
def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = (), options: Mapping[str, str] | None = None) -> str:
    """Distributed overwrite (or append) — every task writes its own
    files, so there is no chunk loop and no single writer."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.save(path)
    return path


def export_delimited(df: DataFrame, base: str, name: str) -> str:
    """CSV export whose folder name carries the shape (rows × columns);
    the row count is one count job."""
    path = f"{base.rstrip('/')}/{name}_{df.count()}x{len(df.columns)}"
    write_table(df, path, fmt="csv", options={"header": "true"})
    return path


def write_splits(df: DataFrame, path: str, split_col: str = "split") -> str:
    """One table with a split column, partitioned by it, so a reader of
    one split prunes the other partitions."""
    return write_table(df, path, partition_by=[split_col])


def export_scores(df: DataFrame, path: str, key: str, score: str) -> str:
    """Two-column id + score export."""
    return write_table(df.select(key, score), path, fmt="csv", options={"header": "true"})


# S05 / S06 / S09 -------------------------------------------------------------------
def load_split(df: DataFrame, split: str | None = None, limit: int | None = None, split_col: str = "split") -> DataFrame:
    """Read with a split predicate (pushed to the scan / partition
    pruning) and an optional row limit for debugging."""
    if split is not None:
        df = df.where(F.col(split_col) == F.lit(split))
    if limit is not None:
        df = df.limit(limit)
    return df


def catalog_listing(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Tables and views of the catalog as a DataFrame."""
    rows = [(t.name, t.tableType, bool(t.isTemporary)) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, "name string, table_type string, is_temporary boolean")


def table_columns(spark: SparkSession, name: str) -> list[str]:
    """Lower-cased column names of a table; empty when it does not exist."""
    if not spark.catalog.tableExists(name):
        return []
    return [c.name.lower() for c in spark.catalog.listColumns(name)]


def parquet_cache(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Read the parquet table if it was written to its end (its ``_SUCCESS``
    mark is there), else build it, write it and read it back (later reads start
    from the written files)."""
    if not _exists(spark, f"{path.rstrip('/')}/_SUCCESS"):
        write_table(build(), path)
    return spark.read.parquet(path)


# S10 / S11 -------------------------------------------------------------------------
def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, ts_col: str | None = None,
               ts_format: str | None = None) -> tuple[DataFrame, DataFrame]:
    """JSON Lines with an explicit schema. Unparsable lines land in
    ``_corrupt_record`` (blank lines are skipped by the reader); returns
    (good rows, corrupt rows) so dropped lines are countable. The timestamp
    column is parsed as UTC."""
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)])
    # parse the text lines with from_json: the rows and the corrupt-line count can then be
    # queried in any shape (a JSON file scan refuses queries that need only the
    # corrupt-record column, e.g. a count of the good rows)
    lines = spark.read.text(path).where(F.trim(F.col("value")) != "")
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = lines.select(F.from_json(F.col("value"), full, opts).alias("j")).select("j.*")
    good = parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = parsed.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)
    if ts_col and dict((f.name, f.dataType) for f in schema.fields).get(ts_col) == T.StringType():
        good = good.withColumn(ts_col, F.to_timestamp(F.col(ts_col), ts_format) if ts_format
                               else F.to_timestamp(F.col(ts_col)))
    return good, bad


def append_jsonl(df: DataFrame, path: str, probability: str | None = None) -> str:
    """Append one JSON object per row (probability rounded to 6 decimals)."""
    if probability:
        df = df.withColumn(probability, F.round(F.col(probability), 6))
    (df.write.mode("append").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
     .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path))  # keep microseconds
    return path


# S12 -------------------------------------------------------------------------------
def reference_sample(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """``min(n, rows)`` rows chosen by a seeded hash of the key — the
    same rows on any partitioning (top-n by hash: each task keeps n rows)."""
    return df.orderBy(F.xxhash64(F.lit(seed), *[F.col(k) for k in key]), *[F.col(k) for k in key]).limit(n)


# S14 -------------------------------------------------------------------------------
def save_json_params(spark: SparkSession, params_json: str, path: str) -> str:
    """Learned parameters as one JSON text file through Spark's writer
    (works on any shared filesystem)."""
    spark.createDataFrame([(params_json,)], "params string").coalesce(1).write.mode("overwrite").text(path)
    return path


def load_json_params(spark: SparkSession, path: str) -> str:
    """The saved JSON text back."""
    return "".join(r[0] for r in spark.read.text(path).collect())


# C31 -------------------------------------------------------------------------------
def _rule_ok(field: str, rule) -> Column:
    c = F.col(field)
    if isinstance(rule, (list, tuple, set)) and not (isinstance(rule, tuple) and len(rule) == 2
                                                     and all(isinstance(x, (int, float)) for x in rule)):
        return c.isin(list(rule))
    lo, hi = rule
    return c.between(lo, hi)


def rule_flags(df: DataFrame, rules: Mapping[str, object]) -> DataFrame:
    """One boolean ``ok_<field>`` column per rule (NULL fails)."""
    return df.select("*", *[F.coalesce(_rule_ok(f, r), F.lit(False)).alias(f"ok_{f}") for f, r in rules.items()])


def rule_violations(df: DataFrame, rules: Mapping[str, object]) -> DataFrame:
    """Violation count per rule, one aggregate."""
    flagged = rule_flags(df, rules)
    wide = flagged.agg(*[F.count_if(~F.col(f"ok_{f}")).alias(f) for f in rules])
    stack = ", ".join(f"'{f}', `{f}`" for f in rules)
    return wide.selectExpr(f"stack({len(rules)}, {stack}) AS (rule, violations)")


def quarantine_split(df: DataFrame, rules: Mapping[str, object]) -> tuple[DataFrame, DataFrame]:
    """Rows passing every rule, and the quarantined rest with the
    list of failed rules."""
    flagged = rule_flags(df, rules)
    ok_all = None
    for f in rules:
        ok_all = F.col(f"ok_{f}") if ok_all is None else ok_all & F.col(f"ok_{f}")
    failed = F.filter(F.array(*[F.when(~F.col(f"ok_{f}"), F.lit(f)) for f in rules]), lambda x: x.isNotNull())
    drop = [f"ok_{f}" for f in rules]
    valid = flagged.where(ok_all).drop(*drop)
    quarantine = flagged.where(~ok_all).withColumn("failed_rules", failed).drop(*drop)
    return valid, quarantine


def to_json_text(values: Mapping) -> str:
    return json.dumps(dict(values), sort_keys=True)
