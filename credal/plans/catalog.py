"""Registry of the demo queries run on the driver tables.

Each query is a callable ``(spark, sf_dir) -> DataFrame`` that reads the
given parquet tables, maps them to the schema an operator expects (renames
and simple derived columns only) and runs the library operator. The optional
``sql`` is the equivalent DuckDB statement used as the correctness oracle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    operators: tuple[str, ...]
    doc: str


QUERIES: dict[str, Query] = {}


def register(name: str, operators: str, sql: str | None = None):
    """Decorator: register ``fn`` under ``name`` with its oracle SQL and the
    SURVEY operator ids it exercises."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, fn, sql, tuple(o.strip() for o in operators.split(",") if o.strip()),
                              (fn.__doc__ or "").strip())
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def r(c, digits: int = 6):
    """Round a computed double for the cross-engine comparison."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


def _round_double(name: str, digits: int) -> Column:
    """``round`` of a double column, which goes through a decimal text per value; away from
    ties the nearest multiple is the same number. -0.0 becomes 0.0, as in ``round``."""
    x, scale = F.col(name), float(10 ** digits)
    near = F.rint(x * F.lit(scale))
    plain = (F.abs(x * F.lit(scale) - near) < F.lit(0.499)) & (F.abs(x) < F.lit(1e12 / scale))
    return F.when(plain, near / F.lit(scale) + F.lit(0.0)).otherwise(F.round(x, digits))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double/float column (oracle comparisons hash exact values)."""
    how = {"double": _round_double, "float": lambda c, d: F.round(F.col(c), d)}
    return df.select(*[how[f.dataType.typeName()](f.name, digits).alias(f.name) if f.dataType.typeName() in how
                       else F.col(f.name) for f in df.schema.fields])


def sround(expr: str, digits: int = 6) -> str:
    """Oracle-side rounding that matches Spark's ``round`` on doubles: Spark
    rounds the shortest decimal text of the double half-up, so the SQL goes
    double → text → decimal → round instead of rounding the binary value."""
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38, 15)), {digits}) AS DOUBLE)"
