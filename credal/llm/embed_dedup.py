"""Near-dedup of embeddings with a pivot-permutation index.

Reference points (pivots) are a bounded sample of the vectors, taken by a hash
of the id, without those that lie close to an earlier one: a large group of near
copies would else own many pivots, and its members, nearest to different ones of
them, would not meet. Each vector is described by its ``NEAREST`` nearest pivots in order.
The inverted lists are kept per pair of pivots: a vector stands in the list of
every pair among its nearest, so that two vectors meet in a list exactly when
they share at least two pivots. In a list the shared pivots are counted per
pair, the count selects candidates, and each candidate is verified by the
cosine in double precision; a pair that meets in several lists counts in that
of its two smallest shared pivots.

Lists are cut into blocks of bounded size and each pair of blocks is one group,
so a list of any length is spread over tasks. Only link counts and a spanning
forest of the links leave a group, never the pairs. Equal vectors are one
class before the index and are counted by multiplicity.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credal.llm.common import sorted_groups, stored
from credal.llm.components import connected_components

NEAREST, SHARED = 6, 2
MIN_PIVOTS, MAX_PIVOTS = 64, 4096
BLOCK_ROWS = 1024
SPACING = 0.15          # pivots' cosines stay this far below the threshold


def pivot_count(n: int) -> int:
    """About twice the square root of the rows, within bounds: lists of pivot
    pairs then hold a few vectors each while a vector's description stays cheap."""
    return int(min(MAX_PIVOTS, max(MIN_PIVOTS, 2 * math.sqrt(n))))


def spaced(vectors: np.ndarray, limit: float, k: int) -> np.ndarray:
    """The first ``k`` unit vectors that lie below cosine ``limit`` of all taken before."""
    free, taken = np.ones(len(vectors), bool), []
    for i in range(len(vectors)):
        if free[i] and len(taken) < k:
            taken.append(i)
            free &= vectors @ vectors[i] < limit
    return vectors[taken]


def describe(vectors: np.ndarray, pivots: np.ndarray, nearest: int = NEAREST) -> np.ndarray:
    """(n, nearest) pivot numbers by falling cosine, ties by number."""
    near = min(nearest, len(pivots))
    sim = vectors @ pivots.T
    return np.argsort(-sim, axis=1, kind="stable")[:, :near].astype(np.int32)


def block_links(ids, vectors, weights, lists, block, i, j, key, threshold):
    """Links of one block pair: ``(counts by row, forest edges)``."""
    a = np.flatnonzero(block == i)
    b = np.flatnonzero(block == j)
    counts = np.zeros(len(ids), np.int64)
    parent = np.arange(len(ids))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges = []
    sim = vectors[a] @ vectors[b].T
    x, y = np.nonzero(sim >= threshold)
    x, y = a[x], b[y]
    ok = x < y if i == j else np.ones(len(x), bool)
    x, y = x[ok], y[ok]
    low, high = key
    for s in range(0, len(x), 1 << 16):
        p, q = x[s: s + (1 << 16)], y[s: s + (1 << 16)]
        same = lists[p][:, :, None] == lists[q][:, None, :]
        hit = same.any(axis=2)
        # counted in the list of the two smallest shared pivots only
        first = (hit.sum(axis=1) >= SHARED) & ~(hit & (lists[p] < high) & (lists[p] != low)).any(axis=1)
        p, q = p[first], q[first]
        np.add.at(counts, p, weights[q])
        np.add.at(counts, q, weights[p])
        for u, v in zip(p.tolist(), q.tolist()):
            u, v = root(u), root(v)
            if u != v:
                parent[max(u, v)] = min(u, v)
                edges.append((ids[max(u, v)], ids[min(u, v)]))
    return counts, edges


def embedding_duplicates(rows: DataFrame, threshold: float = 0.95) -> DataFrame:
    """``rows(vec_id, embedding)`` → one row per vector: ``vec_id, n_links,
    component_id, kept``.

    Vectors are linked when the index finds them and their cosine, in double
    precision, is at least ``threshold``. A vector that is null, empty, zero or
    holds a null or non-finite component links with nothing (0 links, its own
    component); so does a row with a null id (null component, kept). Vectors
    of different lengths never link. Rows that repeat an id are rows of their
    own. An empty table gives no rows.
    """
    spark = rows.sparkSession
    base = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    ok = F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) \
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) \
        & F.exists("v", lambda x: x != 0.0)
    base = base.withColumn("ok", F.coalesce(ok, F.lit(False)))
    good = base.where("ok").select("vec_id", "v")
    classes = stored(good.groupBy("v").agg(F.min("vec_id").alias("cid"), F.count(F.lit(1)).alias("copies")), "vectors")
    n = classes.count()
    k = pivot_count(n)
    sample = classes.orderBy(F.xxhash64("cid"), "cid").limit(2 * k).select("v").collect()     # at most 2 * MAX_PIVOTS rows
    by_dim: dict[int, list] = {}
    for (v,) in sample:
        by_dim.setdefault(len(v), []).append(v)
    pivots = {d: spaced(_unit(np.array(v, np.float64)), threshold - SPACING, k) for d, v in by_dim.items()}

    def index(batches):
        for batch in batches:
            vectors, ids, copies = batch.column("v"), batch.column("cid").to_pylist(), batch.column("copies").to_pylist()
            values = vectors.values.to_numpy(zero_copy_only=False)
            offsets = vectors.offsets.to_numpy()
            dims = np.diff(offsets)
            for d in np.unique(dims).tolist():
                at = np.flatnonzero(dims == d)
                x = _unit(np.stack([values[offsets[r]: offsets[r + 1]] for r in at]))
                p = pivots.get(d, np.eye(1, d))
                lists = describe(x, p)
                if lists.shape[1] < SHARED:       # a length with one pivot or none: its vectors share one list
                    lists = np.tile(np.array([0, 1], np.int32), (len(at), 1))
                yield pa.RecordBatch.from_arrays([
                    pa.array([ids[r] for r in at], pa.int64()), pa.array([copies[r] for r in at], pa.int64()),
                    pa.array([d] * len(at), pa.int32()), pa.array([r.tobytes() for r in x], pa.binary()),
                    pa.array(list(lists), pa.list_(pa.int32()))], ["cid", "copies", "dim", "vector", "lists"])

    table = stored(classes.mapInArrow(index, "cid long, copies long, dim int, vector binary, lists array<int>"), "pivots")
    pairs = F.flatten(F.transform("lists", lambda x: F.transform(F.filter("lists", lambda y: y > x),
                                                                 lambda y: x.cast("long") * (1 << 20) + y)))
    entries = table.select("cid", "dim", F.explode(pairs).alias("key"))
    lists = entries.groupBy("dim", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1") \
        .select("dim", "key", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("nb"))
    placed = entries.join(lists, ["dim", "key"]).withColumn("block", F.pmod(F.xxhash64("cid"), F.col("nb")).cast("int")) \
        .select("cid", "dim", "key", "block", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("other"))
    placed = placed.select("cid", "dim", "key", "block", F.least("block", "other").alias("i"),
                           F.greatest("block", "other").alias("j"))
    groups = placed.join(table.drop("dim"), "cid").repartition("dim", "key", "i", "j") \
        .sortWithinPartitions("dim", "key", "i", "j", "cid") \
        .select("dim", "key", "i", "j", "block", "cid", "copies", "vector", "lists")

    def verify(batches):
        for g in sorted_groups(batches, ["dim", "key", "i", "j"]):
            ids = g.column("cid").to_numpy()
            x = np.frombuffer(b"".join(g.column("vector").to_pylist()), np.float64).reshape(len(ids), -1)
            ls = np.stack(g.column("lists").combine_chunks().to_numpy(zero_copy_only=False)) if len(ids) else None
            key = g.column("key")[0].as_py()
            counts, edges = block_links(ids, x, g.column("copies").to_numpy(), ls, g.column("block").to_numpy(),
                                        g.column("i")[0].as_py(), g.column("j")[0].as_py(),
                                        (key >> 20, key & ((1 << 20) - 1)), threshold)
            at = np.flatnonzero(counts)
            u = [*ids[at].tolist(), *[int(e[0]) for e in edges]]
            v = [None] * len(at) + [int(e[1]) for e in edges]
            yield pa.RecordBatch.from_pydict({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64()),
                                              "n": pa.array([*counts[at].tolist(), *[0] * len(edges)], pa.int64())})

    found = stored(groups.mapInArrow(verify, "u long, v long, n long"), "links")
    links = found.where("v is null").groupBy(F.col("u").alias("cid")).agg(F.sum("n").alias("links"))
    comps = connected_components(found.where("v is not null").select("u", "v"))
    final = classes.join(links, "cid", "left").join(comps, F.col("cid") == F.col("node"), "left") \
        .select("v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("component", "cid").alias("component_id"))
    out = good.join(final, "v").select("vec_id", "n_links", "component_id") \
        .union(base.where("not ok").select("vec_id", F.lit(0).cast("long"), "vec_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)      # no overflow of squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))
