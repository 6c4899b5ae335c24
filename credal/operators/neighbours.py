"""Nearest neighbours within a table by space-filling curves over random projections.

Rows are projected on a few random directions; the quantised projections'
interleaved bits order the rows along a curve on which near rows mostly stand
near one another. Each of ``CURVES`` curves is a range sort of the table, and a
row is compared with the ``REACH`` rows before and after it. So the work is a
fixed number of comparisons per row: no bucket holds all pairs of its rows, and
equal rows, however many, are spread over tasks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credal.session import written

CURVES, DIRECTIONS, BITS, REACH = 6, 4, 15, 24


def _arrays(width: int):
    """Arrow columns of lists as matrices of ``width`` columns, and back."""
    def matrix(lists):
        return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), width)

    def lists(m):
        import numpy as np
        import pyarrow as pa
        ends = np.arange(len(m) + 1, dtype=np.int32) * np.int32(m.shape[1])
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(m).ravel()))
    return matrix, lists


def _projected(width: int, seed: int):
    matrix, lists = _arrays(width)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        axes = np.random.default_rng(seed).standard_normal((width, CURVES * DIRECTIONS))
        for batch in batches:
            p = lists(matrix(batch.column(1)) @ axes)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), p], ["id", "x", "p"])
    return run


def _nearest(width: int, k: int):
    """Rows in the curve's order → per row the nearest ``k`` of the rows around it."""
    matrix, lists = _arrays(width)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def block(ids, x, lo, hi):
            # one offset at a time: the row itself moves along the others, nothing is gathered
            offsets = np.array([*range(-REACH, 0), *range(1, REACH + 1)])
            columns = np.ascontiguousarray(x.T)
            d = np.full((hi - lo, len(offsets)), np.inf)
            for j, o in enumerate(offsets):
                a, b = max(lo, -o), min(hi, len(ids) - o)
                if a < b:
                    s = sum((c[a + o:b + o] - c[a:b]) ** 2 for c in columns)
                    d[a - lo:b - lo, j] = np.where(ids[a + o:b + o] != ids[a:b], s, np.inf)
            best = np.argsort(d, axis=1, kind="stable")[:, :k]
            there = np.isfinite(np.take_along_axis(d, best, 1))
            row, col = np.nonzero(there)
            pick = best[row, col]
            other = lo + row + offsets[pick]
            ends = np.concatenate([[0], np.cumsum(there.sum(axis=1))]).astype(np.int32)
            near = pa.StructArray.from_arrays([pa.array(d[row, pick]), pa.array(ids[other]), lists(x[other])],
                                              ["distance", "other", "x"])
            return pa.RecordBatch.from_arrays([pa.array(ids[lo:hi]), pa.ListArray.from_arrays(pa.array(ends), near)], ["id", "near"])

        ids, x, done = np.empty(0, np.int64), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            new = matrix(batch.column(1))
            ids = np.concatenate([ids, batch.column(0).to_numpy()])
            x = new if x is None else np.concatenate([x, new])
            ready = len(ids) - REACH
            if ready > done:
                yield block(ids, x, done, ready)
                cut = max(0, ready - REACH)
                ids, x, done = ids[cut:], x[cut:], ready - cut
        if len(ids) > done:
            yield block(ids, x, done, len(ids))
    return run


def nearest_neighbours(df: DataFrame, row_id: str, columns: Sequence[str], k: int = 5, seed: int = 42) -> DataFrame:
    """``id, near``: of every row with another near it on a curve, up to ``k``
    ``(distance, other, x)`` by squared Euclidean distance over ``columns``, the
    nearest first (ties by the other's id). ``x`` holds the other's values.

    ``row_id`` is a long; rows that repeat one are not neighbours of each other.
    A null, NaN or infinite value counts as the column's mean. The curves are an
    approximation: recall against brute force is in the tests."""
    sound = [F.when(F.abs(F.col(f"`{c}`").cast("double")) < F.lit(math.inf), F.col(f"`{c}`").cast("double")) for c in columns]
    means = df.agg(*[F.avg(s).alias(f"m{i}") for i, s in enumerate(sound)]).first()
    x = F.array(*[F.coalesce(s, F.lit(m or 0.0)) for s, m in zip(sound, means)])
    rows = df.select(F.col(row_id).cast("long").alias("id"), x.alias("x")).where("id is not null")
    rows = written(rows.mapInArrow(_projected(len(columns), seed), "id long, x array<double>, p array<double>"), "projected")
    n = CURVES * DIRECTIONS
    stats = rows.agg(*[F.avg(F.col("p")[i]).alias(f"m{i}") for i in range(n)],
                     *[F.stddev_pop(F.col("p")[i]).alias(f"s{i}") for i in range(n)]).first()
    found = []
    for curve in range(CURVES):
        bits = []
        for j in range(DIRECTIONS):
            i = curve * DIRECTIONS + j
            # the arc tangent keeps far values apart without letting them widen every cell
            level = F.floor((F.atan((F.col("p")[i] - F.lit(stats[f"m{i}"] or 0.0)) / F.lit(stats[f"s{i}"] or 1.0)) / F.lit(math.pi)
                             + 0.5) * F.lit(float(2 ** BITS - 1)))
            bits += [F.shiftleft(F.shiftright(level, b).bitwiseAND(F.lit(1)), b * DIRECTIONS + j) for b in range(BITS)]
        z = reduce(lambda a, b: a.bitwiseOR(b), bits)
        ordered = rows.select("id", "x", z.alias("z")).repartitionByRange("z", "id").sortWithinPartitions("z", "id")
        found.append(ordered.select("id", "x").mapInArrow(
            _nearest(len(columns), k), "id long, near array<struct<distance: double, other: long, x: array<double>>>"))
    # a row per curve, k neighbours in it at most
    near = F.array_sort(F.array_distinct(F.flatten(F.collect_list("near"))))
    return reduce(DataFrame.unionAll, found).where(F.size("near") > 0).groupBy("id").agg(F.slice(near, 1, k).alias("near"))
