"""A corpus pipeline: language ID, near-dedup, decontamination, mixing, tokens.

``STAGES`` lists (name, function); a function takes ``(spark, docs, sf_dir)`` and
returns a DataFrame. ``run`` writes each stage's rows as Parquet to the shared
folder and hands the reread table to the next stage. All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credal.llm.common import stored
from credal.llm.decontam import decontaminate
from credal.llm.langid import fit_prototypes, in_learned_language, predict_language, score_floor
from credal.llm.minhash import deduplicated
from credal.llm.mixing import mix
from credal.llm.queries import held_out, table, tokenizer_path
from credal.llm.tokens_out import token_output

def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter and, of those of 100 characters or more, the
    ones unlike every learned language; the bound is learned from the rows that
    the languages are learned from (:func:`score_floor`).

    Null and empty texts go; shorter ones with a letter stay, very long ones are
    read whole. Rows don't depend on each other, so repeated rows, null ids and
    ties stay as they are; without labelled rows every text goes. Extra columns
    are carried, whatever their names; no rows give none."""
    train = docs.where(~F.coalesce(held_out(), F.lit(True))).select("text", "lang")
    prototypes = fit_prototypes(train)
    floor = score_floor(train, prototypes)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.length("text").alias("length"), "text")
    kept = predict_language(whole, prototypes).where(in_learned_language(F.col("length"), floor))
    return kept.select(*[F.col(f"doc.`{c}`") for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that of the smallest id.

    Groups are of rows, so rows that repeat an id with other texts are judged by
    their texts; of rows with equal id and text one stays. Texts without words
    and rows with a null id have no near duplicates. Ties go to the smaller text
    hash; texts are compared whole; extra columns are carried; no rows give none."""
    return deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Null, empty and wordless texts hold none and stay, as does everything when
    the benchmark is empty; repeated rows go or stay together; null ids are ids;
    whole texts are searched; extra columns are carried; no rows give none."""
    return decontaminate(docs, table(sf_dir, spark, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them.

    A null source is a source, the last; texts without words have no size and are
    not taken; repeated rows are documents of their own, ties in finish time go
    by hash; a long text is taken whole or not; extra columns are carried; no
    rows give none."""
    return mix(docs)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-id shards of the mix; a row for every document read back.

    Null and empty texts are the end id alone; null and repeated ids are
    documents of their own, in id order; long texts are never split; other
    columns are ignored; no rows give no shards and no rows."""
    return token_output(docs, tokenizer_path("word_bpe_49k.json"), end_id=1)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("mixing", mixing), ("token_shards", token_shards)]

#: Trained prototypes, sketches and a tokenizer: not expressible in SQL; tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``."""
    docs = table(sf_dir, spark, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
