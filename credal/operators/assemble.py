"""Joins, unions and column alignment.

Broadcasts are decided by size: Spark's own estimate (file statistics at
planning, or the measured size with AQE) against
``spark.sql.autoBroadcastJoinThreshold``; only a side whose few rows are known
beforehand is marked.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KNOWN_SMALL_ROWS = 10_000


def broadcast_if_small(df: DataFrame, n_rows: int | None = None) -> DataFrame:
    """Mark ``df`` for broadcast when the caller knows that it has a few short
    rows; otherwise leave the choice to the size Spark measures."""
    return F.broadcast(df) if n_rows is not None and n_rows <= KNOWN_SMALL_ROWS else df


def master_join(base: DataFrame, aggregates: Sequence[DataFrame], key: str) -> DataFrame:
    """Base ⟕ one-row-per-key aggregates on one key.

    Every aggregate is hash-partitioned on ``key`` by its own groupBy, so the
    chain of sort-merge joins re-shuffles only the base side once; a side
    whose estimated or (with AQE) measured size is under the broadcast
    threshold is broadcast instead.
    """
    out = base
    for agg in aggregates:
        out = out.join(agg, on=key, how="left")
    return out


def inner_join_chain(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Inner joins of several cleaned sources on one key."""
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f, on=key, how="inner")
    return out


def semi_join_sample(df: DataFrame, ids: DataFrame, key: str, n: int) -> DataFrame:
    """Rows whose key is among the first ``n`` ids (by id order, so the
    sample is repeatable) — ``WHERE id IN (SELECT id ... LIMIT n)``."""
    first = ids.select(key).distinct().orderBy(key).limit(n)
    return df.join(F.broadcast(first), on=key, how="left_semi")  # n rows: bounded by the caller's n


def map_lookup(df: DataFrame, mapping: DataFrame, key: str, value: str, out: str,
               fallback: Column | float | None = None) -> DataFrame:
    """Value by category with a fallback for unseen categories.

    ``mapping`` has one row per ``key``.
    """
    res = df.join(mapping.select(key, F.col(value).alias(out)), on=key, how="left")
    if fallback is not None:
        fb = fallback if isinstance(fallback, Column) else F.lit(fallback)
        res = res.withColumn(out, F.coalesce(F.col(out), fb))
    return res


def union_aligned(frames: Sequence[DataFrame], fill: float | None = None) -> DataFrame:
    """``UNION ALL`` by name; missing columns are NULL (or ``fill``)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    if fill is not None:
        out = out.fillna(fill)
    return out


def align_columns(df: DataFrame, reference_columns: Sequence[str], fill: float = 0.0) -> DataFrame:
    """Columns missing in ``df`` added as ``fill``, extra ones dropped,
    order copied from the reference (train) column list."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(fill).cast("double").alias(c) for c in reference_columns])


def radius_neighbour_counts(points: DataFrame, refs: DataFrame, radii: Sequence[float],
                            id_col: str = "id", x: str = "x", y: str = "y",
                            ref_x: str = "x", ref_y: str = "y", cells_per_radius: int = 4) -> DataFrame:
    """For every point, the number of reference points within each radius.

    Exact and without emitting all pairs of a dense area: the plane is cut
    into square cells of side ``s = R / cells_per_radius`` (``R`` the largest
    radius), the reference side is pre-aggregated to ``(cell, count)``, and
    reference points are paired with a query point only in the cells that
    cross one of its circles. For a point and radius ``r`` a neighbour cell is

      * fully inside the disk (the farthest corner of the bounding box of
        its points within ``r``): its whole pre-aggregated count is added —
        no pair is formed;
      * fully outside (the box's nearest point beyond ``r``): skipped;
      * crossing the circle: its reference points are compared exactly.

    Using the points' bounding box rather than the grid square means a cell
    of copies of one location (any number of them) never forms pairs.

    Only the thin ring of crossing cells produces point pairs, so a hot area
    costs ``O(points × ring cells)`` cell lookups instead of all pairs.
    """
    radii = sorted(float(r) for r in radii)
    R = radii[-1]
    s = R / cells_per_radius
    reach = int(math.ceil(R / s))
    offsets = [(i, j) for i in range(-reach, reach + 1) for j in range(-reach, reach + 1)]

    cell_x = F.floor(F.col(ref_x) / F.lit(s)).cast("long")
    cell_y = F.floor(F.col(ref_y) / F.lit(s)).cast("long")
    ref_cells = refs.select(cell_x.alias("cx"), cell_y.alias("cy"), F.col(ref_x).alias("rx"), F.col(ref_y).alias("ry"))
    # per cell: count and the bounding box of its points (a cell of copies of one
    # point has a zero-size box, so it is always wholly inside or outside a circle)
    cell_counts = ref_cells.groupBy("cx", "cy").agg(
        F.count(F.lit(1)).alias("cnt"), F.min("rx").alias("bx0"), F.max("rx").alias("bx1"),
        F.min("ry").alias("by0"), F.max("ry").alias("by1"))

    off = F.array(*[F.struct(F.lit(i).alias("di"), F.lit(j).alias("dj")) for i, j in offsets])
    probe = (points.select(F.col(id_col).alias("pid"), F.col(x).alias("px"), F.col(y).alias("py"))
             .withColumn("pcx", F.floor(F.col("px") / F.lit(s)).cast("long"))
             .withColumn("pcy", F.floor(F.col("py") / F.lit(s)).cast("long"))
             .withColumn("o", F.explode(off))
             .withColumn("cx", F.col("pcx") + F.col("o.di"))
             .withColumn("cy", F.col("pcy") + F.col("o.dj")))
    # the grid rectangle prunes neighbour cells before the join
    x0, x1 = F.col("cx") * F.lit(s), (F.col("cx") + 1) * F.lit(s)
    y0, y1 = F.col("cy") * F.lit(s), (F.col("cy") + 1) * F.lit(s)
    gx = F.greatest(x0 - F.col("px"), F.lit(0.0), F.col("px") - x1)
    gy = F.greatest(y0 - F.col("py"), F.lit(0.0), F.col("py") - y1)
    probe = (probe.where(F.sqrt(gx * gx + gy * gy) <= F.lit(R)).select("pid", "px", "py", "cx", "cy")
             .join(cell_counts, ["cx", "cy"], "inner"))
    # nearest and farthest distance from the point to the cell's bounding box
    dx_near = F.greatest(F.col("bx0") - F.col("px"), F.lit(0.0), F.col("px") - F.col("bx1"))
    dy_near = F.greatest(F.col("by0") - F.col("py"), F.lit(0.0), F.col("py") - F.col("by1"))
    dx_far = F.greatest(F.abs(F.col("px") - F.col("bx0")), F.abs(F.col("px") - F.col("bx1")))
    dy_far = F.greatest(F.abs(F.col("py") - F.col("by0")), F.abs(F.col("py") - F.col("by1")))
    probe = (probe.withColumn("near", F.sqrt(dx_near * dx_near + dy_near * dy_near))
             .withColumn("far", F.sqrt(dx_far * dx_far + dy_far * dy_far))
             .where(F.col("near") <= F.lit(R))
             .select("pid", "px", "py", "cx", "cy", "cnt", "near", "far"))

    # 1) whole cells inside the disk: add the pre-aggregated count
    inner = probe
    inner_exprs = [F.sum(F.when(F.col("far") <= F.lit(r), F.col("cnt")).otherwise(0)).alias(f"n_{_rname(r)}")
                   for r in radii]
    inner_counts = inner.groupBy("pid").agg(*inner_exprs)

    # 2) cells crossing some circle: exact distance per reference point
    crossing = probe.where(F.exists(F.array(*[F.lit(r) for r in radii]),
                                    lambda r: (F.col("near") <= r) & (F.col("far") > r)))
    pairs = crossing.join(ref_cells, ["cx", "cy"], "inner")
    d = F.sqrt((F.col("px") - F.col("rx")) ** 2 + (F.col("py") - F.col("ry")) ** 2)
    edge_exprs = [F.count_if((F.col("far") > F.lit(r)) & (F.col("near") <= F.lit(r)) & (d <= F.lit(r)))
                  .alias(f"e_{_rname(r)}") for r in radii]
    edge_counts = pairs.groupBy("pid").agg(*edge_exprs)

    base = points.select(F.col(id_col).alias("pid"))
    res = base.join(inner_counts, "pid", "left").join(edge_counts, "pid", "left")
    return res.select(F.col("pid").alias(id_col), *[
        (F.coalesce(F.col(f"n_{_rname(r)}"), F.lit(0)) + F.coalesce(F.col(f"e_{_rname(r)}"), F.lit(0)))
        .cast("long").alias(f"n_within_{_rname(r)}") for r in radii])


def _rname(r: float) -> str:
    return str(int(r)) if float(r).is_integer() else str(r).replace(".", "_")


def distance_to_point(x: str, y: str, px: float, py: float) -> Column:
    """J08 helper: distance to a fixed point is a plain expression."""
    return F.sqrt((F.col(x) - F.lit(px)) ** 2 + (F.col(y) - F.lit(py)) ** 2)


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres (for geographic radius counts)."""
    r = 6371008.8
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dp, dl = p2 - p1, F.radians(lon2) - F.radians(lon1)
    a = F.sin(dp / 2) ** 2 + F.cos(p1) * F.cos(p2) * F.sin(dl / 2) ** 2
    return F.lit(2 * r) * F.asin(F.sqrt(a))


def align_by_key(features: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """J05 re-aimed: features and labels aligned by key (an inner join), not by
    row position. Both sides are one row per key, so the join cannot fan out."""
    return features.join(labels, on=key, how="inner")


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (a NULL group is a group),
    keeping one copy of each key column."""
    if not keys:
        raise ValueError("join_on_keys needs at least one key")
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"__r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"__r_{k}" for k in keys])
