"""Benchmark decontamination with SimHash, DataFrame functions only.

A window of a document is as long as the benchmark item it is compared with.
Its SimHash is the bitwise majority of its k-word shingle hashes, repeats
counted. Fingerprints meet items of the same length through multi-index
Hamming blocks: 64 bits in ``radius + 1`` blocks, so that two fingerprints
within ``radius`` agree in at least one block whole. Candidates within the
radius are then verified by the exact weighted similarity of their shingles,
``Σ min(count) / Σ max(count)``.

Windows need not all be fingerprinted. With similarity ``s``, a window of
``w`` shingles shares at least ``s (w + n) / (1 + s)`` with an item of ``n``, so
only windows with that many shingles that occur anywhere in the benchmark are
kept; this count knows nothing of which item a shingle is from and loses no
window. Most documents share no shingle and end there.

Counters of 64 bits are summed as 32 long columns, each with two counters in
its halves, so that SimHash is a plain aggregation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credal.llm.common import stored

BITS, RADIUS = 64, 20
BROADCAST_ROWS = 1_000_000         # counted rows of one or two longs; beyond it, a shuffled join does the same
_HALVES = 0x0000000100000001


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def shingles_of(words: Column, k: int) -> Column:
    """Hashes of all k-word shingles, in order; fewer words give none."""
    n = F.size(words)
    return F.when(n >= k, F.transform(F.sequence(F.lit(1), F.greatest(n - k + 1, F.lit(1))),
                                      lambda i: F.xxhash64(F.slice(words, i, k)))) \
        .otherwise(F.array().cast("array<bigint>"))


def simhash_sums(h: str = "h") -> list[Column]:
    """32 sums, each of bits j and j + 32 in its halves."""
    return [F.sum(F.shiftrightunsigned(F.col(h), j).bitwiseAND(F.lit(_HALVES))).alias(f"__c{j}") for j in range(32)]


def simhash_of(n: str) -> Column:
    """The fingerprint from the sums: a bit is set if more than half of ``n`` shingles have it."""
    half = F.col(n)
    bits = []
    for j in range(32):
        low = F.col(f"__c{j}").bitwiseAND(F.lit(0xFFFFFFFF)) * 2 > half
        high = F.shiftrightunsigned(F.col(f"__c{j}"), 32) * 2 > half
        bits += [F.when(low, F.lit(1 << j)).otherwise(F.lit(0)).cast("long"),
                 F.when(high, F.lit((1 << (j + 32)) - ((1 << 64) if j == 31 else 0))).otherwise(F.lit(0)).cast("long")]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def blocks_of(fingerprint: str, radius: int) -> Column:
    """``radius + 1`` (block, bits) keys as longs; equal keys are equal blocks."""
    n = radius + 1
    cuts = [BITS * i // n for i in range(n + 1)]
    return F.array(*[F.shiftrightunsigned(F.col(fingerprint), a).bitwiseAND(F.lit((1 << (b - a)) - 1)) * n + i
                     for i, (a, b) in enumerate(zip(cuts, cuts[1:]))])


def _matches(docs: DataFrame, items: DataFrame, k: int, similarity: float, radius: int) -> DataFrame:
    """Matches of the items whose shingles have ``k`` words."""
    item_rows = stored(items.select("item", "m", F.explode(shingles_of(F.col("words"), k)).alias("h")), "items")
    bags = item_rows.groupBy("item", "m", "h").agg(F.count(F.lit(1)).alias("c"))
    known = item_rows.groupBy("h").agg(F.collect_set("m").alias("ms"))
    n_known = item_rows.select("h").distinct().count()

    # positions of documents that hold a shingle of the benchmark
    # the words are a column of their own, or each shingle would split the text anew
    at = docs.select("doc_id", "th", words_of(F.col("text")).alias("words")) \
        .select("doc_id", "th", F.posexplode(shingles_of(F.col("words"), k)).alias("pos", "h"))
    keys = item_rows.select("h").distinct()
    hits = stored(at.join(F.broadcast(keys) if n_known <= BROADCAST_ROWS else keys, "h", "left_semi").distinct(), "hits")

    # all shingles of those documents, few beside all; the texts stay where they are if the ids are few
    found = stored(hits.select(F.col("doc_id").alias("fid"), F.col("th").alias("fth")).distinct(), "found")
    again = docs.select("doc_id", "text", "th").join(
        F.broadcast(found) if found.count() <= BROADCAST_ROWS else found,
        F.col("doc_id").eqNullSafe(F.col("fid")) & (F.col("th") == F.col("fth")), "left_semi").dropDuplicates(["doc_id", "th"])
    texts = stored(again.select("doc_id", "th", words_of(F.col("text")).alias("words"))
                   .select("doc_id", "th", shingles_of(F.col("words"), k).alias("hs")), "texts")
    local = texts.select("doc_id", "th", F.size("hs").alias("nd"), F.posexplode("hs").alias("pos", "h"))

    # window starts whose count of benchmark shingles can reach the similarity
    n = F.col("m") - (k - 1)
    sized = hits.join(known, "h").select("doc_id", "th", "pos", F.explode("ms").alias("m")).distinct() \
        .alias("a").join(texts.select("doc_id", "th", F.size("hs").alias("nd")).alias("t"),
                         F.col("a.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("a.th") == F.col("t.th"))) \
        .select("a.*", "nd")
    last = F.greatest(F.col("nd") - n, F.lit(0))
    starts = sized.select("doc_id", "th", "m", "nd", F.explode(F.sequence(
        F.least(F.greatest(F.col("pos") - n + 1, F.lit(0)), last), F.least(F.col("pos"), last))).alias("start")) \
        .groupBy("doc_id", "th", "m", "nd", "start").agg(F.count(F.lit(1)).alias("shared"))
    width = F.least(n, F.col("nd"))
    windows = starts.withColumn("width", width) \
        .where(F.col("shared") * (1 + similarity) >= similarity * (n + F.col("width")) - 1e-9)
    spread = windows.select("doc_id", "th", "m", "start", "width", F.explode(F.sequence(
        F.col("start"), F.col("start") + F.col("width") - 1)).alias("pos"))
    content = stored(spread.alias("w").join(
        local.alias("l"), F.col("w.doc_id").eqNullSafe(F.col("l.doc_id")) & (F.col("w.th") == F.col("l.th"))
        & (F.col("w.pos") == F.col("l.pos"))).select("w.doc_id", "w.th", "w.m", "w.start", "w.width", "l.h"), "windows")

    # fingerprints, blocks, radius
    key = ["doc_id", "th", "m", "start", "width"]
    prints = content.groupBy(*key).agg(*simhash_sums()).select(*key, simhash_of("width").alias("f"))
    item_prints = item_rows.groupBy("item", "m").agg(F.count(F.lit(1)).alias("n"), *simhash_sums()) \
        .select("item", "m", "n", simhash_of("n").alias("g"))
    left = prints.select("*", F.explode(blocks_of("f", radius)).alias("block"))
    right = item_prints.select("*", F.explode(blocks_of("g", radius)).alias("block"))
    pairs = left.join(right, ["m", "block"]).where(F.bit_count(F.col("f").bitwiseXOR(F.col("g"))) <= radius) \
        .select(*key, "item", "n").distinct()

    # exact similarity of the shingle bags
    bag = content.groupBy(*key, "h").agg(F.count(F.lit(1)).alias("cw"))
    p, b = pairs.alias("p"), bag.alias("b")
    joined = p.join(b, F.col("p.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("p.th") == F.col("b.th"))
                    & (F.col("p.m") == F.col("b.m")) & (F.col("p.start") == F.col("b.start"))) \
        .select("p.*", "b.h", "b.cw")
    both = joined.join(bags.drop("m"), ["item", "h"]).groupBy(*key, "item", "n") \
        .agg(F.sum(F.least("cw", "c")).alias("both"))
    scored = both.withColumn("similarity", F.col("both") / (F.col("width") + F.col("n") - F.col("both")))
    return scored.where(F.col("similarity") >= similarity).select("doc_id", "th", "item", "start", "similarity")


def contaminated(docs: DataFrame, benchmark: DataFrame, k: int = 5, similarity: float = 0.8,
                 radius: int = RADIUS) -> DataFrame:
    """``docs(doc_id, text)``, ``benchmark(item_id, text)`` → a row for every
    document and item it holds: ``doc_id, text_hash, item_id, similarity`` (best
    window), ``start_word`` (the first such window's), ``n_windows``.

    Words are lower-cased runs of letters and digits. An item of fewer than
    ``k`` words is compared by shingles of its own length; a null or wordless
    item is skipped. A document shorter than an item is one window. Null and
    wordless texts match nothing; null ids are an id; rows with equal id and
    text give one result; empty tables give no rows.
    """
    items = stored(benchmark.select(F.col("item_id").alias("item"), words_of(F.col("text")).alias("words"))
                   .where("size(words) > 0").select("*", F.size("words").alias("m"),
                                                    F.least(F.size("words"), F.lit(k)).alias("k"))
                   .withColumn("item", F.struct("item", F.xxhash64("words").alias("w"))).dropDuplicates(["item"]), "bench")
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("th"))
    parts = [_matches(rows, items.where(F.col("k") == r[0]).drop("k"), r[0], similarity, radius)
             for r in items.select("k").distinct().orderBy("k").collect()]     # at most k rows
    if not parts:
        parts = [rows.where("false").select("doc_id", "th", F.lit(None).cast(
            items.schema["item"].dataType).alias("item"), F.lit(0).alias("start"), F.lit(0.0).alias("similarity"))]
    found = reduce(DataFrame.union, parts)
    return found.groupBy("doc_id", "th", F.col("item.item").alias("item_id")).agg(
        F.max("similarity").alias("similarity"), F.min(F.struct(-F.col("similarity"), F.col("start"))).alias("best"),
        F.count(F.lit(1)).alias("n_windows")) \
        .select("doc_id", F.col("th").alias("text_hash"), "item_id", "similarity",
                F.col("best.start").alias("start_word"), "n_windows")


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns kept."""
    bad = contaminated(docs, benchmark, **options).select(F.col("doc_id").alias("__bid"),
                                                          F.col("text_hash").alias("__bth")).distinct()
    rows = docs.select("*", F.xxhash64("text").alias("__th"))
    return rows.join(bad, F.col("doc_id").eqNullSafe(F.col("__bid")) & (F.col("__th") == F.col("__bth")), "left_anti") \
        .select(*[F.col(f"`{c}`") for c in docs.columns])
