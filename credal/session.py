"""Session helpers: a configured SparkSession and the shared checkpoint folder."""

from __future__ import annotations

import math
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on. Shuffle partitions is sized for local runs;
# on a cluster it is left to the deployment (AQE coalesces small partitions).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # spark.sql.codegen.maxFields stays at its default (100): measured on the
    # 113-column transform, expression-level codegen beats one fused whole-stage
    # method (whose compile time dominates) by 2-3x.
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "credal",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _local_scratch(master: str) -> str:
    """A scratch folder of this machine; only where driver and executors are
    one process. On a cluster the folder must be a shared one."""
    if not re.match(r"local(\[|$)", master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="credal-ckpt-")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` is used as is; only when the
    session has none is a fresh scratch folder set, and only on a local master.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Spark Connect) session: the folder comes from the conf
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
        if conf_dir:
            return conf_dir
        return _local_scratch(spark.conf.get("spark.master", ""))
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    sc.setCheckpointDir(_local_scratch(sc.master))
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives the loss
    of an executor, unlike a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: computed once
    for all later jobs, with column pruning and statistics."""
    path = checkpoint_path(df.sparkSession, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


ROWS_PER_PART = 100_000       # fewer rows are not worth a task
PARTS_OF_ROWS = 4_000_000     # parts of more rows come from a table of enough files


def part_count(rows: int, cores: int) -> int | None:
    """Parts for a table that is scanned again and again; None: as it is read."""
    if rows <= ROWS_PER_PART or rows > cores * PARTS_OF_ROWS:
        return None
    return min(cores, math.ceil(rows / ROWS_PER_PART))


def dealt(df: DataFrame, name: str) -> DataFrame:
    """``df``, a written table, in even parts for all cores. Training scans its rows
    hundreds of times, and a table of a few files or row groups has as few tasks."""
    spark = df.sparkSession
    try:
        cores = spark.sparkContext.defaultParallelism
    except Exception:  # a remote (Spark Connect) session
        cores = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = part_count(df.count(), cores)
    return df if parts is None else written(df.repartition(parts), name)


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name) if "://" not in base else base.rstrip("/") + "/" + name
