"""Rings of regions: known shapes, holes, saddles, borders, long rings."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from galeforge import plans
from galeforge.operators import contours as N
from galeforge.sources.scratch import written

FIELD = "k int, r int, c int, lat double, lon double, value double"


def field(spark, rows, k=1):
    """Rows of numbers as a field; None is a missing node, a string a null or NaN one."""
    odd = {"null": None, "nan": float("nan")}
    cells = [(k, r, c, 10.0 - r, 20.0 + c, odd.get(x, x) if isinstance(x, str) else float(x)) for r, row in enumerate(rows) for c, x in enumerate(row) if x is not None]
    return spark.createDataFrame(cells, FIELD)


def found(df, t=0.5):
    points = N.ring_points(df, ["k"], {1: t})
    return sorted((r.n_points, round(r.area, 6), r.hole) for r in N.rings(points, ["k"]).collect())


def test_one_node_inside_is_a_diamond(spark):
    points = N.ring_points(field(spark, [[0, 0, 0], [0, 1, 0], [0, 0, 0]]), ["k"], {1: 0.5})
    (r,) = N.rings(points, ["k"]).collect()
    assert (r.n_points, r.area, r.hole, r.lon_min, r.lon_max, r.lat_min, r.lat_max) == (4, 0.5, False, 20.5, 21.5, 8.5, 9.5)
    (t,) = N.ring_texts(points, ["k"]).collect()
    assert t.region == "POLYGON ((21 9.5, 20.5 9, 21 8.5, 21.5 9, 21 9.5))"  # anticlockwise, from the northern crossing
    (e,) = N.ring_envelopes(N.rings(points, ["k"]), ["k"]).collect()
    assert (e.n_outer, e.n_holes, e.area_km2) == (1, 0, 0.5 * 111 * 104)


def test_crossings_are_interpolated(spark):
    (r,) = N.rings(N.ring_points(field(spark, [[0, 0, 0], [0, 4, 0], [0, 0, 0]]), ["k"], {1: 1.0}), ["k"]).collect()
    assert (r.lon_min, r.lon_max) == (20.25, 21.75)


def test_a_hole_is_a_ring_of_its_own(spark):
    ring = [[0] * 7, *[[0, *([1] * 5), 0] for _ in range(5)], [0] * 7]
    ring[3][3] = 0
    assert found(field(spark, ring)) == [(4, -0.5, True), (20, 24.5, False)]


@pytest.mark.parametrize(("corner", "want"), [(1.0, [(4, 0.5, False), (4, 0.5, False)]), (4.0, [(8, 0.0, False)])])
def test_saddles_join_by_the_mean(spark, corner, want):
    """Two inside nodes across a square: apart if the mean of the corners is below the threshold, else one ring."""
    rows = [[0, 0, 0, 0], [0, corner, 0, 0], [0, 0, corner, 0], [0, 0, 0, 0]]
    got = found(field(spark, rows), 0.51 if corner == 1.0 else 0.5)
    assert len(got) == len(want) and [x[0] for x in got] == [x[0] for x in want] and not any(x[2] for x in got)


def test_rings_follow_the_border_and_gaps(spark):
    assert found(field(spark, [[1, 1], [1, 1]])) == [(8, 1.0, False)]
    assert found(field(spark, [[1, 1, 1], [1, None, 1], [1, 1, 1]])) == [(4, -2.0, True), (12, 4.0, False)]  # the gap's ring runs through the four nodes around it
    assert found(field(spark, [[1, "nan"], ["null", 0]])) == [(4, 0.0, False)]


def test_thresholds_and_keys_are_apart(spark):
    df = field(spark, [[0, 0, 0], [0, 9, 0], [0, 0, 0]]).union(field(spark, [[0, 0, 0], [0, 2, 0], [0, 0, 0]], k=2))
    got = N.rings(N.ring_points(df, ["k"], {1: 1.0, 5: 5.0}), ["k"]).collect()
    assert sorted((r.k, r.threshold) for r in got) == [(1, 1), (1, 5), (2, 1)]


def test_a_long_winding_ring_closes(spark):
    """A comb: one ring of thousands of crossings, in its order."""
    rows = [[0] * 42] + [[0] + [1 if r == 0 or c % 2 == 0 else 0 for c in range(40)] + [0] for r in range(30)] + [[0] * 42]
    points = N.ring_points(field(spark, rows), ["k"], {1: 0.5})
    (r,) = N.rings(points, ["k"]).collect()
    walk = points.orderBy("ahead").collect()
    assert r.n_points == len(walk) > 1000 and [p.ahead for p in walk] == list(range(len(walk)))
    assert all(p.n == walk[i - 1].v for i, p in enumerate(walk) if i)  # each step leads one nearer to the start
    (t,) = N.ring_texts(points, ["k"]).collect()
    xy = [tuple(map(float, x.split())) for x in t.region[10:-2].split(", ")]
    assert xy[0] == xy[-1] and len(xy) == r.n_points + 1
    assert all(math.dist(a, b) <= 1.0 for a, b in zip(xy, xy[1:], strict=False))
    assert sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(xy, xy[1:], strict=False)) / 2 == pytest.approx(r.area)


def test_nothing_inside(spark):
    assert found(field(spark, [[0, 0], [0, 0]])) == []
    assert found(field(spark, [[0]]).limit(0)) == []


def test_a_rings_area_is_summed_along_it(spark):
    """The order of rows changes neither the last bit of an area nor, by its sign, what is a hole."""
    parts = [1e16, 1.0, 1.0, -1e16, -1.0]  # along the ring: 1e16 takes in both ones, so -1 is left
    rows = [(1, 1, 7, (5 - k) % 5, 0.0, 2 * x, 1.0, 0.0) for k, x in enumerate(parts)]
    cells = "k int, threshold int, ring long, ahead long, lon2 double, lon double, lat2 double, lat double"
    for some in (rows, rows[::-1], [rows[i] for i in (3, 0, 4, 1, 2)]):
        (r,) = N.rings(spark.createDataFrame(some, cells).coalesce(1), ["k"]).collect()
        assert (r.n_points, r.area, r.hole) == (5, -1.0, True)


@pytest.mark.parametrize("name", ["e10_contour_rings", "e14_ring_envelopes"])
def test_what_lies_within_a_tile_is_not_written_as_segments(spark, monkeypatch, name):
    """A query's own tables have a row for each tile and for each stretch that leaves one, not for each segment and round."""
    rows = []

    def counted(df, label, path=None):
        out = written(df, label, path)
        rows.append(out.count())
        return out

    monkeypatch.setattr(N, "written", counted)
    assert plans.queries()[name](spark, "/root/testdata/sf0.001").count() and sum(rows) < 500  # of about 6,000 nodes


def test_tiles_of_any_size_have_the_same_rings(spark):
    """Rings that wind through tiles, with gaps, saddles and values at the threshold, to the last bit of their areas."""
    rng = np.random.default_rng(7)
    noise = [[None if x == 4 else "nan" if x == 5 else x for x in row] for row in rng.integers(0, 6, (12, 17)).tolist()]
    comb = [[0] * 22] + [[0] + [1 if r == 0 or c % 2 == 0 else 0 for c in range(20)] + [0] for r in range(14)] + [[0] * 22]
    df = field(spark, noise).union(field(spark, comb, k=2)).withColumns({"lat": F.col("lat") / 3, "lon": F.col("lon") / 7})
    got = []
    for bits in (0, 2, 8):
        points = N.ring_points(df, ["k"], {1: 0.5, 2: 1.0}, bits=bits)
        found = N.field_rings(df, ["k"], {1: 0.5, 2: 1.0}, bits=bits)
        got.append([sorted(map(tuple, d.select(sorted(d.columns)).collect())) for d in (points, found, N.rings(points, ["k"]))])
    assert got[0] == got[1] == got[2] and got[0][1] == got[0][2]
    assert max(r.n_points for r in found.collect()) > 200


def test_measures_add_up_along_the_ring():
    """As test_a_rings_area_is_summed_along_it, within a tile: no pairs of numbers are added first."""
    parts = np.array([3.0, 1e16, 1.0, 1.0, -1e16, -1.0, 0.25, 0.5, *([1.0] * 9 + [1e16] + [1.0] * 9 + [-1e16])])
    size = np.array([1, 5, 2, 20])
    assert N._sums(parts, size).tolist() == [3.0, -1.0, 0.75, 8.0]
