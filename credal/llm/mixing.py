"""Mixing sources to target weights by weighted fair queueing.

The documents of every source are put in a shuffled order (by an md5 of a seed
and the id), up to ``max_epochs`` times over. A copy's virtual finish time is
its source's running size up to and including it, divided by the source's
target. All copies are then ordered by finish time and cut where the running
total passes the budget, so that at any moment every source has been served in
proportion to its target.

Both running sums are exact without a single-task window: rows are cut into
ranges of the shuffle key (or of the finish time, which fair queueing spreads
evenly), the totals per range give each range's offset, and windows run inside
one range only. A source that holds most rows is spread over many ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from credal.llm.common import pieces, stored

WORD = r"[^\x20\x09-\x0D]+"
RANGE_ROWS = 5_000


def source_targets(sources: DataFrame, weights: Sequence[int], max_epochs: int,
                   budget: int | None = None) -> DataFrame:
    """``sources(source, source_size)``, one row per source → ``target`` added.

    Sources in code-point order, null last, weigh ``weights`` repeating and
    share the budget (default: all sizes). A target stops at ``max_epochs``
    times its source's size and the excess goes to the others by weight: with
    sources ordered by cap over weight, those before the first one that needs
    no cap are capped, the rest share what is left. The windows hold one row
    per source; sources are a dimension, not data.
    """
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]),
                     ((F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
                      % len(weights) + 1).cast("int"))
    every = Window.partitionBy()
    before = Window.orderBy("__ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    df = sources.withColumn("__w", w).withColumn("__cap", F.col("source_size") * max_epochs)
    df = df.withColumn("__ratio", F.col("__cap") / F.col("__w"))
    total = F.sum("source_size").over(every) if budget is None else F.lit(int(budget))
    left = total - F.coalesce(F.sum("__cap").over(before), F.lit(0))
    weight = F.sum("__w").over(every) - F.coalesce(F.sum("__w").over(before), F.lit(0))
    df = df.withColumn("__left", left).withColumn("__weight", weight)
    df = df.withColumn("__share", F.col("__left") / F.col("__weight"))
    free = F.col("__ratio") >= F.col("__share")
    first = F.min(F.when(free, F.struct("__ratio", "__left", "__weight"))).over(every)
    df = df.withColumn("__f", first)
    target = F.when(F.col("__f").isNull() | (F.col("__ratio") < F.col("__f.__ratio")), F.col("__cap").cast("double")) \
        .otherwise(F.col("__f.__left") * F.col("__w") / F.col("__f.__weight"))
    return df.select("source", "source_size", target.alias("target"))


def mix_plan(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), max_epochs: int = 3,
             budget: int | None = None, seed: str = "mix") -> DataFrame:
    """One row per document: ``doc_id, text_hash, size, source, source_size,
    target, copies, taken``; ``taken = copies * size`` words are in the mix.

    ``size`` counts the words ``[^\\x20\\x09-\\x0D]+`` of the whole text. A null
    or wordless text has size 0 and is not taken; a null source is a source of
    its own; null or repeated ids are rows like any other (their order among
    each other follows size, equal rows are interchangeable); an empty table
    gives no rows. Reruns agree: nothing depends on partitions.
    """
    base = stored(docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), F.xxhash64("text").alias("text_hash"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))).alias("h"))
        .withColumn("row", F.monotonically_increasing_id()), "mix")
    n = base.count()
    parts = pieces(n, RANGE_ROWS)
    base = base.withColumn("part", F.shiftright(F.conv(F.substring("h", 1, 8), 16, 10).cast("long") * parts, 32))

    # running size within a source
    ranges = base.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    targets = source_targets(ranges.groupBy("source").agg(F.sum("part_size").alias("source_size")),
                             weights, max_epochs, budget)
    up_to = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("source", "part", F.coalesce(F.sum("part_size").over(up_to), F.lit(0)).alias("base_size"))
    ranges = ranges.alias("r").join(targets.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source"))) \
        .select(F.col("r.source").alias("source"), "part", "base_size", "source_size", "target")
    in_part = Window.partitionBy("source", "part").orderBy("h", "size", "text_hash", "row") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = base.alias("b").join(
        ranges.alias("r"), F.col("b.source").eqNullSafe(F.col("r.source")) & (F.col("b.part") == F.col("r.part"))) \
        .select("b.*", "base_size", "source_size", "target") \
        .withColumn("upto", F.col("base_size") + F.sum("size").over(in_part))
    placed = stored(placed.select("row", "doc_id", "text_hash", "source", "size", "h", "source_size", "target", "upto"),
                    "placed")

    # one row per copy that starts before its source is served in full
    epochs = F.array(*[F.lit(e).cast("long") for e in range(max_epochs)])
    copies = placed.where("size > 0 and target > 0").select("*", F.explode(epochs).alias("epoch")) \
        .withColumn("finish", F.col("epoch") * F.col("source_size") + F.col("upto")) \
        .where("finish - size < target").withColumn("vft", F.col("finish") / F.col("target"))
    slots = pieces(n * max_epochs, RANGE_ROWS)
    copies = copies.withColumn("slot", F.least(F.floor(F.col("vft") * slots), F.lit(slots)).cast("long"))
    sums = copies.groupBy("slot").agg(F.sum("size").alias("slot_size"))
    sums = sums.select("slot", F.coalesce(F.sum("slot_size").over(
        Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("slot_base"))
    in_slot = Window.partitionBy("slot").orderBy("vft", "h", "size", "text_hash", "row", "epoch") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = F.lit(int(budget)) if budget is not None else None
    kept = copies.join(sums, "slot").withColumn("total", F.col("slot_base") + F.sum("size").over(in_slot))
    if cut is None:
        # all sizes: read off the stored rows, one number
        cut = F.lit(int(placed.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]))
    kept = kept.where(F.col("total") <= cut)
    keys = ["row", "doc_id", "text_hash", "size", "source", "source_size", "target"]
    out = placed.select(*keys, F.lit(0).alias("n")).union(kept.select(*keys, F.lit(1).alias("n"))) \
        .groupBy(*keys).agg(F.sum("n").alias("copies"))
    return out.select("doc_id", "text_hash", "size", "source", "source_size", "target", "copies",
                      (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: ``docs`` with every row as often as the plan takes it.
    All columns are kept; rows with equal id and text are told apart by their
    number among each other."""
    same = Window.partitionBy("__id", "__th").orderBy(F.lit(1))
    plan = mix_plan(docs, **options).select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__th"), "copies") \
        .withColumn("__n", F.row_number().over(Window.partitionBy("__id", "__th").orderBy(F.desc("copies")))) \
        .where("copies > 0").select(F.col("__id").alias("__pid"), F.col("__th").alias("__pth"),
                                    F.col("__n").alias("__pn"), F.col("copies").alias("__copies"))
    rows = docs.select("*", F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__th"))
    rows = rows.withColumn("__n", F.row_number().over(same))
    out = rows.join(plan, F.col("__id").eqNullSafe(F.col("__pid")) & (F.col("__th") == F.col("__pth"))
                    & (F.col("__n") == F.col("__pn")))
    return out.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))) \
        .select(*[F.col(f"`{c}`") for c in docs.columns])
