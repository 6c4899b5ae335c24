"""Radius counts on the globe (J08): reference points within some metres of a point.

Latitude and longitude become unit vectors, where a distance on the sphere is a chord;
the date line and the poles need no case of their own. References are counted per
location. Locations are sorted along a curve through the vectors and cut into blocks of
near ones; groups of 8 blocks, of 64 and so on have a count and a box each. A block of
points goes down the groups of references only where a circle cuts between the boxes:
what is wholly inside adds its count, what is wholly outside is left. Pairs of blocks
that are left are measured together, again through small boxes within them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credal.operators.assemble import _rname, haversine_m
from credal.session import written

EARTH_M = 6371008.8
LEAF_LOCATIONS = 64     # locations of a small box, measured together
BLOCK_LEAVES = 8        # small boxes of a block
SORTED_LOCATIONS = 1 << 16   # neighbours on the curve that are cut into blocks at once
GROUP_BLOCKS = 64       # reference blocks that a block of points is measured against at once
ROOTS = 64              # a block of points starts from about so many groups
PART = 20               # bits of a block's number within its partition
MEASURED = 1 << 18      # distances held at once
SLACK = 1e-12           # chord rounding, about 6 micrometres: nearer to a circle is measured

AXES = ("x", "y", "z")
BOX = [f"{a}{b}" for b in "01" for a in AXES]


def _located(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """``(lat, lon)`` of rows on the globe, as doubles."""
    a, o = F.col(lat).cast("double"), F.col(lon).cast("double")
    real = a.between(-90.0, 90.0) & (F.abs(o) < float("inf"))      # null and NaN are neither
    # the same place has one pair of numbers: -0.0 is 0.0
    return df.where(real & ~F.isnan(o)).select((a + F.lit(0.0)).alias("lat"), (o + F.lit(0.0)).alias("lon"))


def _along_curve() -> Column:
    """The place on a Morton curve: 21 bits of each axis, some metres, interleaved."""
    a, o = F.radians("lat"), F.radians("lon")

    def spread(v: Column) -> Column:
        v = F.floor((v + F.lit(1.0)) * F.lit(float((1 << 20) - 1))).cast("long")
        for by, mask in ((32, 0x1F00000000FFFF), (16, 0x1F0000FF0000FF), (8, 0x100F00F00F00F00F),
                         (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249)):
            v = v.bitwiseOR(F.shiftleft(v, by)).bitwiseAND(F.lit(mask))
        return v

    x, y, z = spread(F.cos(a) * F.cos(o)), spread(F.cos(a) * F.sin(o)), spread(F.sin(a))
    return x.bitwiseOR(F.shiftleft(y, 1)).bitwiseOR(F.shiftleft(z, 2))


def _vectors():
    """Unit vectors of arrays. A function within this one goes to the tasks whole."""
    def vectors(lat, lon):
        import numpy as np
        a, o = np.radians(lat), np.radians(lon)
        return np.stack([np.cos(a) * np.cos(o), np.cos(a) * np.sin(o), np.sin(a)], axis=1)
    return vectors


def _near_order(leaf: int, size: int):
    """An order of rows in which whole blocks, and whole leaves in them, are near rows:
    halved at the middle of the widest axis again and again."""
    def near_order(x):
        import numpy as np
        parts, todo = [], [np.arange(len(x))]
        while todo:
            at = todo.pop()
            if len(at) <= leaf:
                parts.append(at)
                continue
            unit = size if len(at) > size else leaf
            k = unit * (-(-len(at) // unit) // 2)
            at = at[np.argpartition(x[at, np.ptp(x[at], axis=0).argmax()], k)]
            todo += [at[k:], at[:k]]
        return np.concatenate(parts)
    return near_order


def _cut(leaf: int):
    """Locations in the curve's order → one row per block."""
    size = leaf * BLOCK_LEAVES
    vectors, near_order = _vectors(), _near_order(leaf, size)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        first = TaskContext.get().partitionId() << PART

        def blocks(rows, done):
            lat, lon, cnt = (np.concatenate(c) for c in zip(*rows))
            x = vectors(lat, lon)
            order = near_order(x)
            lat, lon, cnt, x = lat[order], lon[order], cnt[order], x[order]
            starts = np.arange(0, len(lat), size)
            ends = pa.array(np.append(starts, len(lat)).astype(np.int32))
            box = [f.reduceat(x, starts, axis=0)[:, i] for f in (np.minimum, np.maximum) for i in range(3)]
            return pa.RecordBatch.from_arrays(
                [pa.array(first + done + np.arange(len(starts))), pa.array(np.add.reduceat(cnt, starts)),
                 *[pa.ListArray.from_arrays(ends, pa.array(v)) for v in (lat, lon, cnt)], *[pa.array(b) for b in box]],
                ["block", "total", "lat", "lon", "cnt", *BOX])

        rows, held, done = [], 0, 0
        for batch in batches:
            rows.append(tuple(batch.column(c).to_numpy() for c in ("lat", "lon", "cnt")))
            held += batch.num_rows
            if held >= SORTED_LOCATIONS:
                out = blocks(rows, done)
                rows, held, done = [], 0, done + out.num_rows
                yield out
        if held:
            yield blocks(rows, done)
    return run


def _blocks(locations: DataFrame, leaf: int, name: str) -> DataFrame:
    """``block, total, lat, lon, cnt`` (arrays) and its box, of ``lat, lon, cnt``."""
    locations = written(locations, f"{name}-locations")
    parts = max(1, math.ceil(locations.count() / SORTED_LOCATIONS))
    placed = locations.withColumn("code", _along_curve()).repartitionByRange(parts, "code", "lat", "lon") \
        .sortWithinPartitions("code", "lat", "lon").select("lat", "lon", "cnt")
    return written(placed.mapInArrow(
        _cut(leaf), "block long, total long, lat array<double>, lon array<double>, cnt array<long>, "
        + ", ".join(f"{b} double" for b in BOX)), f"{name}-blocks")


def _shifts(blocks: DataFrame) -> list[int]:
    """By how many bits a block's number is shifted for its groups, up to the roots."""
    top = blocks.agg(F.max(F.col("block").bitwiseAND((1 << PART) - 1)).alias("n"), F.max(F.shiftright("block", PART)).alias("p")).first()
    n, p = top.n or 0, top.p or 0
    shifts = [0]
    while (s := shifts[-1]) < 62 and (((n >> s) + 1) * (p + 1) if s < PART else (p >> s - PART) + 1) > ROOTS:
        shifts.append(s + 3 if s >= PART or n >> s else PART + 3)
    return shifts


def _groups(blocks: DataFrame, shift: int) -> DataFrame:
    return blocks.groupBy(F.shiftright("block", shift).alias("node")).agg(
        F.sum("total").alias("total"), *[(F.min if b.endswith("0") else F.max)(b).alias(f"r{b}") for b in BOX])


def _rank(value: Column, bounds: Sequence[float]) -> Column:
    """How many of the bounds are smaller than ``value``."""
    return reduce(lambda a, r: a + F.when(value > F.lit(r), 1).otherwise(0), bounds, F.lit(0))


def _to_box(front: DataFrame, chords: Sequence[float]) -> DataFrame:
    """Splits circles ``lo .. hi - 1`` of each (block of points, group): from ``inside`` on
    the group is wholly inside for all points, below ``outside`` wholly outside."""
    box = [[F.col(f"{p}{c}{b}") for p in ("", "r") for b in "01"] for c in AXES]
    near = [F.greatest(r0 - p1, F.lit(0.0), p0 - r1) for p0, p1, r0, r1 in box]
    far = [F.greatest(F.abs(r1 - p0), F.abs(p1 - r0)) for p0, p1, r0, r1 in box]
    length = lambda v: F.sqrt(v[0] * v[0] + v[1] * v[1] + v[2] * v[2])
    return front.withColumn("outside", F.greatest("lo", _rank(length(near) - F.lit(SLACK), chords))) \
        .withColumn("inside", F.least("hi", F.greatest("lo", _rank(length(far) + F.lit(SLACK), chords)))) \
        .where("outside < hi")


def _measured(chords: Sequence[float], leaf: int):
    """A block of points and the reference blocks that its circles cut → counts per location,
    and a row with a reference for each pair too near to a circle to tell."""
    names = [f"n{j}" for j in range(len(chords))]
    vectors = _vectors()

    def run(left, right):
        import numpy as np
        import pyarrow as pa

        def flat(table, name):
            return table.column(name).combine_chunks().flatten().to_numpy()

        lat, lon = flat(left, "lat"), flat(left, "lon")
        rlat, rlon, cnt = flat(right, "lat"), flat(right, "lon"), flat(right, "cnt")
        sizes = right.column("lat").combine_chunks().value_lengths().to_numpy()
        ends = np.cumsum(sizes)
        starts = np.concatenate([np.arange(e - n, e, leaf) for n, e in zip(sizes, ends)])
        leaves = -(-sizes // leaf)
        lo, hi = (np.repeat(right.column(c).to_numpy(), leaves) for c in ("lo", "hi"))
        lengths = np.diff(np.append(starts, len(cnt)))

        # seen from the middle of the points: differences are small and lose no digits, and
        # the boxes lie along the surface
        x, r = vectors(lat, lon), vectors(rlat, rlon)
        middle = x.mean(axis=0)
        frame = np.linalg.qr(np.c_[middle, np.eye(3)])[0]
        x, r = (x - middle) @ frame, (r - middle) @ frame
        r0, r1 = np.minimum.reduceat(r, starts), np.maximum.reduceat(r, starts)
        totals = np.add.reduceat(cnt, starts)
        x2, r2 = (x * x).sum(axis=1), (r * r).sum(axis=1)
        rounding = 64 * np.finfo(float).eps * (x2.max() + r2.max())
        columns = np.stack([*(-2 * r.T), np.ones(len(r)), r2])      # [x, x2, 1] @ columns: squared chords
        counts = np.zeros((len(lat), len(chords)), np.int64)
        close = []                                                  # point, reference, circle

        def measure(i, k, at, first, last):
            """Counts of circles ``first .. last - 1`` of points ``i .. k - 1`` over the references ``at``."""
            squares = np.c_[x[i:k], x2[i:k], np.ones(k - i)] @ columns[:, at]
            more = np.flatnonzero(cnt[at] > 1)
            for j in range(first, last):
                c = chords[j]
                slack = 2 * c * SLACK + rounding
                hit = squares <= c * c - slack
                edge = squares <= c * c + slack
                if np.count_nonzero(edge) != np.count_nonzero(hit):
                    p, q = np.nonzero(edge & ~hit)
                    close.append(np.stack([i + p, at[q], np.full(len(p), j)]))
                counts[i:k, j] += np.count_nonzero(hit, axis=1)
                if len(more):
                    counts[i:k, j] += hit[:, more] @ (cnt[at[more]] - 1)

        for i in range(0, len(x), leaf):
            k = min(i + leaf, len(x))
            p0, p1 = x[i:k].min(axis=0), x[i:k].max(axis=0)
            near = np.sqrt((np.maximum(0, np.maximum(r0 - p1, p0 - r1)) ** 2).sum(axis=1)) - SLACK
            far = np.sqrt((np.maximum(np.abs(r1 - p0), np.abs(p1 - r0)) ** 2).sum(axis=1)) + SLACK
            outside = np.maximum(lo, np.searchsorted(chords, near))
            inside = np.minimum(hi, np.maximum(lo, np.searchsorted(chords, far)))
            for j in range(len(chords)):
                counts[i:k, j] += totals[(inside <= j) & (j < hi)].sum()
            for first, last in sorted(set(zip(outside.tolist(), inside.tolist()))):
                if first < last:
                    at = np.flatnonzero(np.repeat((outside == first) & (inside == last), lengths))
                    step = max(1, MEASURED // (k - i))
                    for s in range(0, len(at), step):
                        measure(i, k, at[s:s + step], first, last)
        p, q, j = np.concatenate(close, axis=1) if close else np.zeros((3, 0), np.int64)
        without = np.arange(len(lat) + len(p)) < len(lat)           # rows of counts have no reference
        pad = lambda v: pa.array(np.concatenate([np.zeros(len(lat), v.dtype), v]), mask=without)
        counts = np.concatenate([counts, np.zeros((len(p), len(chords)), np.int64)])
        return pa.table([pa.array(np.concatenate([v, v[p]])) for v in (lat, lon)]
                        + [pa.array(np.ascontiguousarray(c)) for c in counts.T]
                        + [pad(v) for v in (rlat[q], rlon[q], cnt[q], j)],
                        ["lat", "lon", *names, "rlat", "rlon", "cnt", "circle"])
    return run


def sphere_neighbour_counts(points: DataFrame, refs: DataFrame, radii_m: Sequence[float], id_col: str = "id",
                            lat: str = "lat", lon: str = "lon", ref_lat: str = "lat", ref_lon: str = "lon",
                            leaf: int = LEAF_LOCATIONS) -> DataFrame:
    """Per row of ``points``: ``id_col`` and, per radius, ``n_within_<radius>``, the number
    of reference rows at most so many metres away on the great circle (the point itself
    counts where it is a reference).

    Copies of a location are one row with a count on both sides, so a hot location makes
    no pairs; a dense area is paired only along the circles, block by block. Null,
    non-finite and impossible coordinates are near nothing: such a point counts 0, such a
    reference is counted nowhere. Longitudes may leave -180..180. Repeated ids are rows of
    their own, other columns are left alone, an empty table gives no rows or zeros.
    """
    radii = sorted({float(r) for r in radii_m})
    if not radii or radii[0] < 0:
        raise ValueError("radii are metres, none negative, at least one")
    chords = [2 * math.sin(min(r / (2 * EARTH_M), math.pi / 2)) for r in radii]
    own = _blocks(_located(points, lat, lon).distinct().withColumn("cnt", F.lit(1).cast("long")), leaf, "sphere-points")
    known = _blocks(_located(refs, ref_lat, ref_lon).groupBy("lat", "lon").agg(F.count(F.lit(1)).alias("cnt")), leaf, "sphere-refs")

    front = own.select(F.col("block").alias("a"), *BOX, F.lit(0).alias("lo"), F.lit(len(radii)).alias("hi"))
    shifts, found = _shifts(known), []
    front = front.crossJoin(_groups(known, shifts[-1]))      # some ROOTS rows
    for here, below in zip(reversed(shifts), [*reversed(shifts[:-1]), None]):
        front = written(_to_box(front, chords), "sphere-front")
        found.append(front.where("inside < hi").select("a", F.col("inside").alias("lo"), "hi", "total"))
        cut = front.where("outside < inside").select(
            "a", *BOX, F.col("outside").alias("lo"), F.col("inside").alias("hi"), "node")
        if below is not None:
            down = _groups(known, below).withColumn("parent", F.shiftright("node", here - below))
            front = cut.withColumnRenamed("node", "parent").join(down, "parent").drop("parent")

    names = [f"n_within_{_rname(r)}" for r in radii]
    sums = [f"n{j}" for j in range(len(radii))]
    whole = reduce(DataFrame.union, found).groupBy("a").agg(*[
        F.sum(F.when((F.col("lo") <= j) & (F.col("hi") > j), F.col("total")).otherwise(0)).alias(n) for j, n in enumerate(sums)])
    whole = own.select(F.col("block").alias("a"), F.explode(F.arrays_zip("lat", "lon")).alias("p")).join(whole, "a") \
        .select("p.lat", "p.lon", *sums)
    pairs = cut.select("a", F.col("node").alias("b"), "lo", "hi").withColumn("part", F.floor(F.col("b") / GROUP_BLOCKS))
    some = pairs.select(F.col("a").alias("block"), F.col("part").alias("piece")).distinct() \
        .join(own.select("block", "lat", "lon"), "block")
    against = pairs.join(known.select(F.col("block").alias("b"), "lat", "lon", "cnt"), "b")
    measured = some.groupBy("block", "piece").cogroup(against.groupBy("a", "part")).applyInArrow(
        _measured(chords, leaf), "lat double, lon double, " + ", ".join(f"{n} long" for n in sums)
        + ", rlat double, rlon double, cnt long, circle long")
    metres = haversine_m(F.col("lat"), F.col("lon"), F.col("rlat"), F.col("rlon"))
    measured = measured.select("lat", "lon", *[
        (F.col(n) + F.when((F.col("circle") == j) & (metres <= F.lit(radii[j])), F.col("cnt")).otherwise(0)).alias(n)
        for j, n in enumerate(sums)])
    counted = whole.union(measured).groupBy("lat", "lon").agg(*[F.sum(s).alias(n) for s, n in zip(sums, names)])
    base = points.select(F.col(id_col), (F.col(lat).cast("double") + F.lit(0.0)).alias("__lat"),
                         (F.col(lon).cast("double") + F.lit(0.0)).alias("__lon"))
    counted = counted.withColumnsRenamed({"lat": "__a", "lon": "__o"})
    return base.join(counted, (F.col("__lat") == F.col("__a")) & (F.col("__lon") == F.col("__o")), "left") \
        .select(id_col, *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in names])
