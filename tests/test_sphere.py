"""Radius counts on the globe against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from credal.operators import sphere
from credal.operators.sphere import EARTH_M, sphere_neighbour_counts

RADII = [500, 1000, 1500, 2000]


def _brute(points, refs, radii):
    ok = [r for r in refs if None not in r and all(math.isfinite(v) for v in r) and abs(r[0]) <= 90]
    a, o = np.radians(np.array(ok, float).reshape(-1, 2)).T
    out = {}
    for i, la, lo in points:
        if la is None or lo is None or not math.isfinite(la) or not math.isfinite(lo) or abs(la) > 90:
            out[i] = [0] * len(radii)
            continue
        p, q = math.radians(la), math.radians(lo)
        h = np.sin((a - p) / 2) ** 2 + np.cos(a) * math.cos(p) * np.sin((o - q) / 2) ** 2
        d = 2 * EARTH_M * np.arcsin(np.sqrt(np.clip(h, 0, 1)))
        out[i] = [int((d <= r).sum()) for r in radii]
    return out


def _check(spark, points, refs, radii=RADII, **kw):
    p = spark.createDataFrame(points, "id long, lat double, lon double")
    r = spark.createDataFrame(refs, "lat double, lon double")
    got = sphere_neighbour_counts(p, r, radii, **kw).collect()
    assert len(got) == len(points)
    want = _brute(points, refs, radii)
    for row in got:
        assert [row[f"n_within_{x}"] for x in radii] == want[row.id], row
    return want


def test_city_date_line_pole_and_a_hot_location(spark):
    rng = random.Random(5)
    places = [(48.85, 2.35, 0.02), (-17.0, 180.0, 0.02), (89.995, 10.0, 0.01)]
    refs = [(min(90.0, la + rng.gauss(0, s)), lo + rng.gauss(0, s) * (1000 if la > 89 else 1)) for la, lo, s in places for _ in range(300)]
    refs = [(la, (lo + 180) % 360 - 180) for la, lo in refs] + [(48.85, 2.35)] * 400
    points = [(i, la, lo) for i, (la, lo) in enumerate(refs[::6])]
    want = _check(spark, points, refs, leaf=4)
    assert max(v[-1] for v in want.values()) > 400


def test_dense_area_is_measured_along_the_circles_only(spark):
    """4,000 locations within some hundred metres: exact with several levels of cubes."""
    rng = random.Random(6)
    refs = [(10 + rng.random() * 0.01, 20 + rng.random() * 0.01) for _ in range(4000)]
    _check(spark, [(i, *refs[i]) for i in range(0, 4000, 200)], refs, [50, 100, 500], leaf=8)


def test_nulls_impossible_places_empty_tables_and_other_columns(spark):
    bad = [(None, 1.0), (1.0, None), (float("nan"), 1.0), (1.0, float("inf")), (91.0, 0.0)]
    refs = [(1.0, 361.0), (1.0, 1.0), *bad]
    points = [(i, *p) for i, p in enumerate([*bad, (1.0, 1.0), (1.0, 361.0)])]
    _check(spark, points, refs)
    p = spark.createDataFrame(points, "id long, lat double, lon double")
    r = spark.createDataFrame(refs, "lat double, lon double")
    assert {x.n_within_500 for x in sphere_neighbour_counts(p, r.limit(0), [500]).collect()} == {0}
    assert sphere_neighbour_counts(p.limit(0), r, [500]).count() == 0
    more = p.withColumn("cnt", F.lit(9)).withColumn("x", F.lit("a")).withColumn("lo", F.lit(1))
    assert sphere_neighbour_counts(more.union(more), r.withColumn("cnt", F.lit(5)), [500]).count() == 14
    with pytest.raises(ValueError, match="radii"):
        sphere_neighbour_counts(p, r, [])


def test_work_grows_with_blocks_of_points_not_with_points(spark, monkeypatch):
    """A town of 6,000 places: what is looked up, level by level, is some rows per block."""
    looked_up = []

    def counted(df, name, written=sphere.written):
        out = written(df, name)
        if name == "sphere-front":
            looked_up.append(out.count())
        return out
    monkeypatch.setattr(sphere, "written", counted)
    rng = random.Random(7)
    refs = [(48.85 + rng.gauss(0, 0.025), 2.35 + rng.gauss(0, 0.038)) for _ in range(6000)]
    _check(spark, [(i, *r) for i, r in enumerate(refs)], refs)
    assert looked_up and sum(looked_up) < len(refs)


def test_groups_of_blocks_copies_and_pairs_on_a_circle(spark):
    """Blocks of 8 in groups of two levels and several parts, some locations many times;
    micrometres from a circle the exact distance decides."""
    rng = random.Random(8)
    refs = [(50 + rng.gauss(0, 0.02), 8 + rng.gauss(0, 0.03)) for _ in range(1500)]
    refs += refs[:50] * 3
    a, b = (50.0, 8.0), (50.004, 8.003)
    p, q, u, v = map(math.radians, (a[0], b[0], a[1], b[1]))
    d = 2 * EARTH_M * math.asin(math.sqrt(math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin((v - u) / 2) ** 2))
    points = [(i, *r) for i, r in enumerate(refs[::10])]
    _check(spark, points, refs, [0, *RADII], leaf=1)
    frame = spark.createDataFrame([(1, *a)], "id long, lat double, lon double")
    got = sphere_neighbour_counts(frame, spark.createDataFrame([b, b], "lat double, lon double"), [d - 1e-6, d + 1e-6]).first()
    assert list(got) == [1, 0, 2]
