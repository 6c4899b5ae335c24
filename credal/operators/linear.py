"""A linear scoring model as data.

A model is a table of ``(position, feature, source, coefficient, mean)`` rows, one
per input column of the matrix and one with a null feature for the intercept. It is
written to a shared folder like any table and applied as generated expressions: no
Python worker, no ML vector, no shuffle, the same on a batch and on a stream. Only
the model (a row per matrix column) reaches the driver, never data rows.

Edge cases: a null or NaN input gives a null probability and decision; a feature the
rows lack is an error, as is a model without intercept row; a model of no features
scores every row by its intercept; other columns of the rows are left alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from credal.functions import clean as C

MODEL_SCHEMA = "position int, feature string, source string, coefficient double, mean double"


@dataclass(frozen=True)
class Term:
    feature: str
    source: str
    coefficient: float
    mean: float = 0.0


@dataclass(frozen=True)
class LinearModel:
    intercept: float
    terms: tuple[Term, ...]

    def to_dataframe(self, spark: SparkSession) -> DataFrame:
        rows = [(-1, None, None, float(self.intercept), None)]
        rows += [(i, t.feature, t.source, float(t.coefficient), float(t.mean)) for i, t in enumerate(self.terms)]
        return spark.createDataFrame(rows, MODEL_SCHEMA)

    @staticmethod
    def from_dataframe(df: DataFrame) -> LinearModel:
        rows = sorted(df.select("position", "feature", "source", "coefficient", "mean").collect(), key=lambda r: r.position)
        intercepts = [r.coefficient for r in rows if r.feature is None]
        if len(intercepts) != 1:
            raise ValueError(f"a scoring model has one intercept row, this table has {len(intercepts)}")
        return LinearModel(intercepts[0], tuple(Term(r.feature, r.source, r.coefficient, r.mean)
                                                for r in rows if r.feature is not None))

    def save(self, spark: SparkSession, path: str) -> str:
        self.to_dataframe(spark).coalesce(1).write.mode("overwrite").parquet(path)
        return path

    @staticmethod
    def load(spark: SparkSession, path: str) -> LinearModel:
        return LinearModel.from_dataframe(spark.read.parquet(path))

    def margin(self) -> Column:
        """Intercept + Σ coefficient · input."""
        return reduce(lambda a, t: a + F.lit(t.coefficient) * F.col(f"`{t.feature}`"), self.terms, F.lit(float(self.intercept)))

    def probability(self) -> Column:
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-self.margin()))
        return F.when(~F.isnan(p), p)


def from_pipeline(model: PipelineModel, features: Sequence[str], sources: Mapping[str, str],
                  means: Mapping[str, float] | None = None) -> LinearModel:
    """The last stage of a fitted logistic pipeline as a model table."""
    last = model.stages[-1]
    means = means or {}
    return LinearModel(float(last.intercept), tuple(
        Term(f, sources.get(f, f), float(c), float(means.get(f, 0.0))) for f, c in zip(features, last.coefficients.toArray())))


def score(df: DataFrame, model: LinearModel, threshold: float, keep: Sequence[str] = ()) -> DataFrame:
    """P(default) and decision, one select over a batch or a stream."""
    p = model.probability()
    return df.select(*keep, p.alias("probability")).withColumn("decision", C.decision(F.col("probability"), threshold))


def source_impacts(model: LinearModel) -> dict[str, Column]:
    """Per input column, Σ coefficient · (input − mean) over its matrix columns."""
    out: dict[str, Column] = {}
    for t in model.terms:
        term = F.lit(t.coefficient) * (F.col(f"`{t.feature}`") - F.lit(t.mean))
        out[t.source] = out[t.source] + term if t.source in out else term
    return dict(sorted(out.items()))


def mean_impacts(df: DataFrame, model: LinearModel) -> DataFrame:
    """``(source, mean_abs_impact)``, one aggregate over all rows."""
    impacts = source_impacts(model)
    wide = df.agg(*[F.avg(F.abs(c)).alias(f"m{i}") for i, c in enumerate(impacts.values())])
    rows = F.array(*[F.struct(F.lit(s).alias("source"), F.col(f"m{i}").alias("mean_abs_impact"))
                     for i, s in enumerate(impacts)])
    return wide.select(F.inline(rows))


def top_impacts(df: DataFrame, model: LinearModel, keys: Sequence[str], top: int = 3) -> DataFrame:
    """The ``top`` sources of every row by |impact| (name breaks ties), with
    rank and direction; ranked inside the row, no shuffle."""
    found = F.array(*[F.struct((-F.abs(c)).alias("order"), F.lit(s).alias("source"), c.alias("impact"))
                      for s, c in source_impacts(model).items()])
    ranked = F.slice(F.array_sort(found), 1, top)
    return (df.select(*keys, F.posexplode(ranked).alias("pos", "t"))
            .select(*keys, (F.col("pos") + 1).alias("rank"), "t.source", "t.impact")
            .withColumn("direction", C.direction_label("impact")))
