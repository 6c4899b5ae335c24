"""MinHash near-dedup with fast similarity sketching.

Sketch: every shingle is thrown into one of ``T`` bins per round and each bin
keeps its smallest value; a later round's values rank behind all earlier
ones'. Rounds ``0..T-1`` throw at random, round ``T + i`` throws every shingle
into bin ``i``, so all coordinates are filled after ``2T`` rounds at the
latest and usually after two or three. Bands of ``R`` coordinates are hashed
into buckets; documents meet in a bucket, and every link is confirmed on the
full shingle sets.

The job, in which no step emits all pairs of a bucket:

1. documents with equal sets are one class (aggregated before anything else);
2. a bucket's classes are compared with its smallest class (hub); the hub's
   set streams past its members, hubs with many members are dealt to many
   tasks; links give components;
3. classes of a bucket that are not yet connected are compared exactly, in
   blocks of bounded size, each block pair a task's group; only a spanning
   forest of the links found leaves the group;
4. components of both are merged.

Two classes that share a bucket therefore end up connected by links already
found, or are compared exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credal.llm.common import (mix64, row_slices, shingle_hashes, small_batches, sorted_groups, stored, text_bytes,
                               word_hashes)
from credal.llm.components import connected_components

T, R = 128, 4
BANDS = T // R
SLICE_BYTES = 1 << 20
HUB_MEMBERS = 500
BLOCK_ROWS = 512
BLOCK_SHINGLES = 400_000

_EMPTY = np.uint64((1 << 64) - 1)
_LOW = np.uint64((1 << 40) - 1)


def sketches(flat: np.ndarray, offsets: np.ndarray, t: int = T) -> np.ndarray:
    """(n, t) sketch of every set of distinct hashes ``flat[offsets[i]:offsets[i+1]]``;
    empty sets keep the filler."""
    sizes = np.diff(offsets)
    out = np.full((len(sizes), t), _EMPTY)
    table = out.reshape(-1)
    row = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
    items = flat
    for i in range(2 * t):
        if len(items) == 0:
            break
        x = mix64(items, 1000 + i)
        bins = (x >> np.uint64(40)) * np.uint64(t) >> np.uint64(24) if i < t else np.full(len(x), i - t, np.uint64)
        np.minimum.at(table, row * t + bins.astype(np.int64), (np.uint64(i) << np.uint64(40)) | (x & _LOW))
        open_rows = (out == _EMPTY).any(axis=1)
        left = open_rows[row]
        if not left.all():
            items, row = items[left], row[left]
    return out


def band_keys(sketch: np.ndarray, r: int = R) -> np.ndarray:
    """(n, bands) 64-bit bucket keys, a band's number mixed in."""
    n, t = sketch.shape
    parts = sketch.reshape(n, t // r, r)
    key = np.zeros((n, t // r), np.uint64)
    for j in range(r):
        key = mix64(key ^ parts[:, :, j], 5000 + j)
    return mix64(key + np.arange(t // r, dtype=np.uint64), 77).view(np.int64)


def _set_key(flat: np.ndarray, offsets: np.ndarray, seed: int) -> np.ndarray:
    total = np.concatenate([[np.uint64(0)], np.cumsum(mix64(flat, seed), dtype=np.uint64)])
    return (total[offsets[1:]] - total[offsets[:-1]]).view(np.int64)


def _each_slice(batch: pa.RecordBatch, k: int):
    """Shingle sets of a batch's last column (text), some rows at a time."""
    text = batch.column(batch.num_columns - 1)
    data, offsets = text_bytes(text)
    for a, b in row_slices(np.diff(offsets), SLICE_BYTES):
        words, at = word_hashes(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
        yield a, b, *shingle_hashes(words, at, k)


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """``docs(doc_id, text)`` → ``doc_id, th, n_shingles, s1, s2, bands``: the text's
    hash, set size, a 128-bit key of the set and the bucket keys."""
    def sign(batches):
        for batch in batches:
            for a, b, flat, at in _each_slice(batch, k):
                keys = band_keys(sketches(flat, at))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a),
                    pa.array(np.diff(at)), pa.array(_set_key(flat, at, 21)),
                    pa.array(_set_key(flat, at, 22)),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, (b - a + 1) * BANDS, BANDS, dtype=np.int32)),
                                             pa.array(keys.reshape(-1)))],
                    ["doc_id", "th", "n_shingles", "s1", "s2", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"),
                       F.col("text").cast("string").alias("text")) \
        .mapInArrow(sign, "doc_id long, th long, n_shingles long, s1 long, s2 long, bands array<long>")


def _sets(docs: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """``(cid, shingles)`` of the classes, from the text of the smallest id ``least``.
    Rows that repeat that id with another text are told apart by the set key."""
    def build(batches):
        for batch in batches:
            s1, s2 = np.asarray(batch.column(1)), np.asarray(batch.column(2))
            for a, b, flat, at in _each_slice(batch, k):
                same = (_set_key(flat, at, 21) == s1[a:b]) & (_set_key(flat, at, 22) == s2[a:b])
                raw = flat.astype("<u8").tobytes()
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a).filter(pa.array(same)),
                    pa.array([raw[8 * at[i]: 8 * at[i + 1]] for i in np.flatnonzero(same)], pa.binary())],
                    ["cid", "shingles"])

    rows = docs.select(F.col("doc_id").cast("long").alias("least"), F.col("text").cast("string").alias("text")) \
        .join(classes.select("least", "cid", "s1", "s2"), "least").select("cid", "s1", "s2", "text")
    return rows.mapInArrow(build, "cid long, shingles binary").dropDuplicates(["cid"])


def _hub_links(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Confirmed ``(u, v)`` of candidate ``pairs(hub, cid)``."""
    deal = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / HUB_MEMBERS).cast("int").alias("parts"))
    dealt = pairs.join(deal, "hub").withColumn("part", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int"))
    members = dealt.join(sets, "cid").select("hub", "part", F.lit(1).alias("role"), "cid", "shingles")
    hubs = deal.join(sets.withColumnRenamed("cid", "hub"), "hub") \
        .select("hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"),
                F.col("hub").alias("cid"), "shingles")
    rows = members.union(hubs).repartition("hub", "part").sortWithinPartitions("hub", "part", "role")

    def check(batches):
        hub = None
        for batch in batches:
            u, v = [], []
            roles, cids, sets_ = batch.column(2), batch.column(3).to_pylist(), batch.column(4)
            for i, role in enumerate(roles.to_pylist()):
                s = np.frombuffer(sets_[i].as_buffer(), "<u8")
                if role == 0:
                    hub, hub_id = s, cids[i]
                    continue
                at = np.searchsorted(hub, s)
                both = int((hub[np.minimum(at, len(hub) - 1)] == s).sum())
                if den * both >= num * (len(hub) + len(s) - both):
                    u.append(hub_id)
                    v.append(cids[i])
            yield pa.RecordBatch.from_pydict({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return rows.mapInArrow(check, "u long, v long")


def linked_pairs(sets: list[np.ndarray], comp: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """Indices (i, j) of linked sets of different components in a bounded group,
    reduced to a spanning forest over the components. Members of the largest
    component are not compared with each other."""
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, col, n = np.unique(flat, return_inverse=True, return_counts=True)
    shared = n[col] > 1                       # a shingle of one set only adds to no intersection
    col, owner = col[shared], owner[shared]
    main = np.bincount(comp).argmax()
    probe = np.flatnonzero(comp != main)
    place = np.full(len(sets), -1)
    place[probe] = np.arange(len(probe))
    both = np.zeros((len(probe), len(sets)), np.float32)
    order = np.argsort(col, kind="stable")
    col, owner = col[order], owner[order]
    step = max(1, (1 << 22) // max(1, len(sets)))
    ids = np.unique(col)
    for a in range(0, len(ids), step):        # dense blocks of bounded size
        lo, hi = np.searchsorted(col, ids[a]), np.searchsorted(col, ids[min(a + step, len(ids)) - 1], side="right")
        m = np.zeros((len(sets), min(step, len(ids) - a)), np.float32)
        m[owner[lo:hi], np.searchsorted(ids, col[lo:hi]) - a] = 1
        both += m[probe] @ m.T
    union = sizes[probe][:, None] + sizes[None, :] - both
    i, j = np.nonzero((den * both.astype(np.float64) >= num * union) & (comp[probe][:, None] != comp[None, :]))
    parent: dict[int, int] = {}

    def root(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    out = []
    for a, b in zip(probe[i].tolist(), j.tolist()):
        x, y = root(int(comp[a])), root(int(comp[b]))
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def _block_links(members: DataFrame, comps: DataFrame, sizes: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links between components inside buckets that hold several."""
    rows = members.join(comps, "cid").join(sizes, "cid")
    open_ = rows.groupBy("key").agg(F.min("comp").alias("a"), F.max("comp").alias("b"), F.count(F.lit(1)).alias("n"),
                                    F.sum("n_shingles").alias("s")).where("a <> b") \
        .select("key", F.ceil(F.greatest(F.col("n") / BLOCK_ROWS, F.col("s") / BLOCK_SHINGLES)).cast("int").alias("nb"))
    rows = rows.join(open_, "key").withColumn("block", F.pmod(F.xxhash64("cid"), F.col("nb")).cast("int"))
    rows = rows.select("key", "cid", "comp", F.col("block"),
                       F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("other"))
    rows = rows.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "cid", "comp")
    rows = rows.join(sets, "cid").select("key", "i", "j", "cid", "comp", "shingles") \
        .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "cid")

    def compare(batches):
        for group in sorted_groups(batches, ["key", "i", "j"]):
            comp = np.unique(group.column("comp").to_numpy(), return_inverse=True)[1]
            if comp.max(initial=0) == 0:
                continue
            col = group.column("shingles")
            found = linked_pairs([np.frombuffer(x.as_buffer(), "<u8") for x in col], comp, num, den)
            names = group.column("comp").to_numpy()
            yield pa.RecordBatch.from_pydict({"u": pa.array([int(names[a]) for a, _ in found], pa.int64()),
                                              "v": pa.array([int(names[b]) for _, b in found], pa.int64())})

    return rows.mapInArrow(compare, "u long, v long")


def grouped(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """A row per row of ``docs``: ``doc_id, th, n_shingles, grp, component_id``.
    ``grp`` is the number of its group, null for a row that stays alone."""
    small_batches(docs.sparkSession)
    rows = stored(signatures(docs, k), "signatures")
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    keyed = rows.where(~alone)
    # a class has a number of its own: rows of one id may be in several classes
    classes = stored(keyed.groupBy("s1", "s2", "n_shingles").agg(F.min("doc_id").alias("least"), F.first("bands").alias("bands"))
                     .withColumn("cid", F.monotonically_increasing_id()), "classes")
    # a bucket key names its band; buckets of one class are dropped before any join
    members = classes.select("cid", F.explode("bands").alias("key"))
    shared = members.groupBy("key").agg(F.min("cid").alias("hub"), F.max("cid").alias("last")).where("hub <> last")
    members = stored(members.join(shared.select("key", "hub"), "key"), "members")
    busy = members.select("cid").distinct().join(classes.select("cid", "least", "s1", "s2", "n_shingles"), "cid")
    sets = stored(_sets(docs, busy, k), "sets")
    pairs = members.where("cid <> hub").select("hub", "cid").distinct()
    comps = stored(connected_components(_hub_links(pairs, sets, num, den)), "stars")
    labels = stored(busy.select("cid", "n_shingles").join(comps, F.col("cid") == F.col("node"), "left")
                    .select("cid", "n_shingles", F.coalesce("component", "cid").alias("comp")), "labels")
    more = connected_components(_block_links(members.select("key", "cid"), labels.select("cid", "comp"),
                                             labels.select("cid", "n_shingles"), sets, num, den))
    final = stored(labels.join(more, F.col("comp") == F.col("node"), "left")
                   .select("cid", F.coalesce("component", "comp").alias("comp"))
                   .join(classes.select("cid", "least"), "cid"), "components")
    final = final.join(final.groupBy("comp").agg(F.min("least").alias("component_id")), "comp").select("cid", "comp", "component_id")
    linked = classes.select("s1", "s2", "n_shingles", "cid", "least").join(final, "cid", "left") \
        .select("s1", "s2", "n_shingles", F.coalesce("comp", "cid").alias("grp"), F.coalesce("component_id", "least").alias("component_id"))
    return keyed.select("doc_id", "th", "n_shingles", "s1", "s2").join(linked, ["s1", "s2", "n_shingles"]) \
        .select("doc_id", "th", "n_shingles", "grp", "component_id") \
        .union(rows.where(alone).select("doc_id", "th", "n_shingles", F.lit(None).cast("long"), "doc_id"))


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs(doc_id, text)`` → one row per document: ``doc_id, n_shingles,
    component_id, kept``. Documents are linked when ``den * |A ∩ B| >= num * |A ∪
    B|`` for their sets of distinct k-word shingles (words ``[^\\x20\\x09-\\x0D]+``,
    A-Z lower-cased); a component's id is its smallest document id.

    A text of fewer than ``k`` words has its whole word sequence as its only
    shingle; a null, empty or wordless text has an empty set and stays alone.
    A row with a null id stays alone, too (null component, kept). Rows that
    repeat an id are rows of their own and share its id. An empty table gives
    no rows; texts are used whole. Similar pairs can only be missed when they
    share no bucket: (1 - J^4)^32, under 1e-6 at J = 0.8.
    """
    out = grouped(docs, k, num, den).select("doc_id", "n_shingles", "component_id")
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicated(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row of each group of near duplicates, all columns kept: of those with
    the smallest id, one with the smallest text hash. Rows of one id and different
    groups stay. A wordless text or a null id is a group of its own; of rows with
    equal id and text one stays. No rows give none."""
    rows = stored(grouped(docs, k, num, den).select("doc_id", "th", "grp"), "groups")
    first = rows.where("grp is not null").groupBy("grp").agg(F.min(F.struct("doc_id", "th")).alias("r")).select("r.*")
    keep = first.union(rows.where("grp is null").select("doc_id", "th")).distinct() \
        .select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"))
    marked = docs.select("*", F.xxhash64("text").alias("__h"))
    kept = marked.join(keep, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__th")), "left_semi")
    return kept.dropDuplicates(["doc_id", "text"]).select(*[F.col(f"`{c}`") for c in docs.columns])
