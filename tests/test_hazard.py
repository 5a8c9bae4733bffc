"""Cases with known results: identities, the golden track row, geometry at the date line, masks, upserts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from galeforge.functions import geo, identity
from galeforge.operators import envelopes as E
from galeforge.operators import messages as M
from galeforge.operators import rain as P
from galeforge.operators import rivers as R
from galeforge.operators import serving as Q
from galeforge.operators import tracks as T
from galeforge.operators import warehouse as H
from galeforge.schemas import RAW_SCHEMA, TRACK_COLUMNS
from galeforge.sources import adapters, tables
from galeforge.sources import catalog as C

DAY = dt.datetime(2024, 7, 1)


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def golden(spark, **change):
    rows = []
    for q in (1, 2, 3, 4):
        row = dict(storm_id="BERYL", storm_identifier="007", long_storm_name="BERYL", ensemble_member=1, step=0, datetime=DAY, latitude=15.0, longitude=-55.0, pressure=99000.0, wlatitude=15.1, wlongitude=-55.1, wind=30.0, wind_threshold=18, quadrant=q, bearing_start=0.0, bearing_end=90.0, wind_radius=40000.0)
        rows.append(row | change)
    return spark.createDataFrame([tuple(r[x.split()[0]] for x in RAW_SCHEMA.split(", ")) for r in rows], RAW_SCHEMA)


def test_golden_row(spark):
    out = T.transform(golden(spark))
    assert out.columns == TRACK_COLUMNS
    (r,) = out.collect()
    assert r.pressure_hpa == 990.0 and round(r.wind_speed_knots, 6) == 58.32
    assert r.radius_of_maximum_winds_km == pytest.approx(15.45799622485502)
    assert [r[f"radius_34_knot_winds_{q}_km"] for q in ("ne", "se", "sw", "nw")] == [40.0] * 4
    assert r.radius_50_knot_winds_ne_km is None and r.radius_64_knot_winds_ne_km == 0.0
    w, s, e, n = "-55.37307249744507", "14.63963963963964", "-54.62692750255493", "15.36036036036036"
    assert r.wind_field_polygon_34kt == f"POLYGON (({w} {s}, {e} {s}, {e} {n}, {w} {n}, {w} {s}))"
    assert r.wind_field_polygon_50kt is None and r.wind_field_polygon_64kt is None
    assert r.forecast_time == DAY and r.storm_identifier == "007"


def test_impossible_radius_cleared(spark):
    r = T.transform(golden(spark, wind=29.9 / 1.944, wind_radius=272000.0)).first()
    assert r.radius_34_knot_winds_ne_km == 0.0 and r.wind_field_polygon_34kt is None


def test_transform_of_nothing(spark):
    assert T.transform(golden(spark).limit(0)).count() == 0


def test_missing_column_named(spark):
    with pytest.raises(ValueError, match="wlatitude"):
        T.validate_tracks(golden(spark).drop("wlatitude"))


def test_tracks_without_radii(spark):
    raw = golden(spark).drop("wind_radius", "wind_threshold", "quadrant", "bearing_start", "bearing_end")
    assert [(r.n_rows, r.valid) for r in T.validate_tracks(raw).collect()] == [(4, True)]
    (r,) = T.transform(raw).collect()
    assert r.pressure_hpa == 990.0 and r.forecast_time == DAY and r.radius_of_maximum_winds_km == pytest.approx(15.45799622485502)
    assert all(r[c] is None for c in TRACK_COLUMNS if c.startswith(("radius_34", "radius_50", "radius_64", "wind_field")))
    assert [x.track_id for x in T.transform(golden(spark), track_id="OTHER").collect()] == ["OTHER"]


def test_several_points_share_their_radii(spark):
    raw = golden(spark).union(golden(spark, latitude=16.0, wind_radius=50000.0))
    got = sorted((r.latitude, r.radius_34_knot_winds_ne_km) for r in T.transform(raw).collect())
    assert got == [(15.0, 50.0), (16.0, 50.0)]


def test_a_large_message_is_flattened_in_pieces(spark):
    """Thousands of members times periods; no column of all radii reaches the last explode."""
    n_m, n_p = 60, 50
    schema = "storm_identifier string, long_storm_name string, base_time timestamp_ntz, members array<int>, periods array<struct<hours:array<int>,lat:array<double>,lon:array<double>,pressure:array<double>,wlat:array<double>,wlon:array<double>,wind:array<double>>>, thresholds array<double>, bearings array<double>, radii array<double>"
    periods = [([6 * p], [10.0 + k for k in range(n_m)], [20.0], [1e5], [1e100], [1.0], [30.0]) for p in range(n_p)]
    radii = [float(x) for x in range(n_m * n_p * 12)]
    out = M.flatten_messages(spark.createDataFrame([("01L", "ANA", DAY, list(range(1, n_m + 1)), periods, [18.0, 26.0, 33.0], [0.0, 90.0], radii)], schema))
    rows = out.where("ensemble_member = 7 and step = 12").orderBy("wind_threshold", "quadrant").collect()
    assert [r.wind_radius for r in rows] == [float(6 * n_p * 12 + 2 * 12 + j) for j in range(12)] and rows[0].latitude == 16.0 and rows[0].wlatitude is None
    assert out.count() == n_m * n_p * 12
    lines = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    below = lines[next(i for i, x in enumerate(lines) if "Generate" in x) + 1]  # what the last explode takes along
    assert "_m#" in below and " radii#" not in below and "periods#" not in below


@pytest.mark.parametrize(("raw", "name", "want"), [("  raw-id  ", "  Beryl  ", "Beryl"), ("07L", "   ", "07L")])
def test_storm_identity(spark, raw, name, want):
    assert one(spark, identity.storm_identity(F.lit(raw), F.lit(name)).alias("x")).x == want


@pytest.mark.parametrize(("raw", "want"), [("  ０7-l  ", "07-L"), ("al09", "AL09"), (None, None), ("", None), ("  ", None), ("José", None), ("AL\n09", None), ("AL 09", None), ("-AL09", None), ("AL09-", None), ("AL--09", None), ("AL_09", None)])
def test_normalize(spark, raw, want):
    value, error = identity.normalize_identifier(F.lit(raw).cast("string"))
    r = one(spark, value.alias("v"), error.alias("e"))
    assert r.v == want and (r.e is None) == (want is not None)


@pytest.mark.parametrize(("basin", "season", "ok"), [("AL", 2000, True), ("EP", 9999, True), ("CP", 2024, True), ("AL", 1999, False), ("AL", 10000, False), ("WP", 2024, False)])
def test_episode_key(spark, basin, season, ok):
    r = one(spark, identity.episode_key("ecmwf", F.lit(basin), F.lit(season), F.lit("07l")).alias("k")).k
    assert (r is not None) == ok and (not ok or tuple(r) == ("ecmwf", basin, season, "07L"))


def test_csv_keeps_identity_text(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text("storm_id,storm_identifier,step,datetime,wind\n007,  07-L  ,6,2024-07-01 06:00:00,3.5\n００7,,12,,\n")
    a, b = C.read_raw_tracks(spark, str(p)).collect()
    assert (a.storm_id, a.storm_identifier, a.step, a.wind, a.long_storm_name) == ("007", "  07-L  ", 6, 3.5, None)
    assert (b.storm_id, b.storm_identifier, b.wind) == ("００7", "", None)


def test_box_over_the_date_line(spark):
    box = geo.quadrant_box(F.lit(0.0), F.lit(177.6), *map(F.lit, (610.5, 0.0, 0.0, 0.0)))
    parts = one(spark, geo.antimeridian_split(box).alias("p")).p
    assert [(round(p.lon_min, 6), round(p.lon_max, 6)) for p in parts] == [(177.6, 180.0), (-180.0, -176.9)]
    both = geo.quadrant_box(F.lit(0.0), F.lit(0.0), *map(F.lit, (30000.0, 0.0, 30000.0, 0.0)))
    assert one(spark, geo.antimeridian_split(both).alias("p")).p is None


def test_unwrap_and_reconcile(spark):
    rows = spark.createDataFrame([("a", 1, 0, 179.1), ("a", 1, 6, -179.5), ("a", 2, 0, -178.0)], "s string, m int, t int, longitude double")
    out = {(r.m, r.t): r.unwrapped for r in E.unwrap_longitude(rows, ["s", "m"], "t").collect()}
    assert out[(1, 6)] == pytest.approx(180.5) and out[(2, 0)] == -178.0
    rec = sorted(r.reconciled for r in E.reconcile_longitudes(rows, "s").collect())
    assert rec == pytest.approx([179.1, 180.5, 182.0])


def test_one_node_grid(spark):
    g = E.grid_descriptor(spark.createDataFrame([(0, 0, 10.0, 20.0)], "r int, c int, lat double, lon double")).first()
    assert (g.west, g.east, g.south, g.north) == (19.875, 20.125, 9.875, 10.125)


def test_nan_exceeds_nothing(spark):
    f = spark.createDataFrame([(float("nan"),), (None,), (99.0,)], "value double")
    assert E.threshold_cells(f, {34: 17.49}).count() == 1


def test_bitmask_round_trip(spark):
    ex = spark.createDataFrame([(10, 1, 24, m) for m in (1, 51, 64, 64)], "rp int, cell_id long, step_h int, member int")
    masks = R.member_bitmask(ex)
    assert masks.first().m024 == (1 | 1 << 50) - (1 << 63)
    back = R.expand_bitmask(masks)
    assert sorted(r.member for r in back.collect()) == [1, 51, 64]
    with pytest.raises(Exception, match="1..64"):
        R.member_bitmask(ex.withColumn("member", F.lit(65))).collect()


def test_morton(spark):
    assert one(spark, geo.interleave(F.lit(0b1011)).alias("x")).x == 0b1000101


def test_strict_mean_and_pct(spark):
    f = spark.createDataFrame([(1, 9, 0, 0, 4.0), (2, 9, 0, 0, None)], "member int, step int, r int, c int, value double")
    assert P.ensemble_mean_at(f, 9).first()["mean"] is None
    assert P.exceedance_pct(f, 1.0).first().pct == 50.0
    with pytest.raises(ValueError, match="no step 12"):
        P.step_lookup(f, 12)


def test_upsert_rules(spark):
    t = spark.createDataFrame([(1, "a", "t0"), (2, "b", "t0"), (None, "n", "t0")], "k int, region string, loaded_at string")
    s = spark.createDataFrame([(1, "A"), (2, None), (3, None), (None, "m"), (1, None)], "k int, region string")
    out = H.upsert_if_region(t, s, ["k"], F.lit("t1"))
    assert sorted(((r.k or 0, r.region or "", r.loaded_at) for r in out.collect())) == [(0, "m", "t1"), (0, "n", "t0"), (1, "A", "t1"), (2, "b", "t0"), (3, "", "t1")]


def test_safe_region(spark):
    ok = "POLYGON ((0 0, 1 0, 1 1, 0 0))"
    rows = {ok: True, "POLYGON ((0 0, 1 0, 1 1, 0 1))": False, "POLYGON ((0 0, 181 0, 1 1, 0 0))": False, "hello": False, "": False}
    for x, want in rows.items():
        assert (one(spark, H.safe_region(F.lit(x)).alias("x")).x is not None) == want


def test_null_wind_has_no_class(spark):
    rows = spark.createDataFrame([("a", 0, 1, None), ("a", 0, 2, 140.0)], "track_id string, lead_time int, ensemble_member int, wind_speed_knots double")
    r = Q.intensity_counts(rows).first()
    assert r.cat5 == 1 and r.td == 0


def test_storm_names_from_paths(spark):
    names = {"a/x_storm_AB-1_y.csv": "AB-1", "tropical_cyclone_track_JERRY_-63p7degW_transformed.csv": "JERRY", "b/zeta_transformed.csv": "zeta"}
    for path, want in names.items():
        assert one(spark, C.storm_from_path(F.lit(path)).alias("x")).x == want


def test_files_of_many_headers_in_one_scan(spark, tmp_path):
    """Fifty files, each with its own order of columns, quotes, and some columns missing or unknown."""
    import csv
    import random

    r, names, want = random.Random(4), ["storm_id", "storm_identifier", "ensemble_member", "step", "latitude", "wind", "note"], []
    for k in range(50):
        own = r.sample(names, r.randrange(3, 8))
        with (tmp_path / f"f{k}.csv").open("w", newline="") as f:
            w = csv.writer(f, quoting=r.choice([csv.QUOTE_ALL, csv.QUOTE_MINIMAL]), lineterminator="\n")
            w.writerow(own)
            for i in range(3):
                row = {"storm_id": f"S{k}", "storm_identifier": " 007 ", "ensemble_member": i, "step": 6 * i, "latitude": f" {k}.5 ", "wind": "" if i else "12.25", "note": 'a "b", c'}
                w.writerow([row[c] for c in own])
                has = lambda c: row[c] if c in own else None  # noqa: B023, E731
                want.append((has("storm_id"), has("storm_identifier"), has("ensemble_member"), has("step"), k + 0.5 if "latitude" in own else None, None if i or "wind" not in own else 12.25))
    out = C.read_raw_tracks(spark, str(tmp_path)).select("storm_id", "storm_identifier", "ensemble_member", "step", "latitude", "wind")
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation [") <= 2  # the lines, and their files' headers


def test_cells_that_share_a_grid_node_keep_their_own(spark):
    """Two cells at one node: what names its cell meets that cell only, what does not meets both."""
    cells = spark.createDataFrame([(1, 10.025, 20.025, 900.0), (7201, 10.025, 20.025, 100.0)], "cell_id long, cell_lat double, cell_lon double, uparea_km2 double")
    pixels = spark.createDataFrame([(1, 10.03, 20.03, 0.5, 0), (7201, 10.02, 20.02, 0.5, 0)], "cell_id long, pixel_lat double, pixel_lon double, depth double, water int")
    ex = spark.createDataFrame([(1, 2, 24, 1), (7201, 2, 24, 2)], "cell_id long, rp int, step_h int, member int")
    masks = R.member_bitmask(ex)
    got = sorted((r.pixel_lat, r.m024, r.below_min_basin) for r in R.extent_rows(pixels, masks, cells).collect())
    assert got == [(10.02, 2, True), (10.03, 1, False)]
    assert R.extent_rows(pixels.drop("cell_id"), masks, cells).count() == 4
    prob = spark.createDataFrame([(1, 2, 24, 0.5), (7201, 2, 24, 0.25)], "cell_id long, rp int, step_h int, probability double")
    painted = R.masked_probability(pixels, prob, cells)
    assert sorted((r.pixel_lat, r.probability) for r in painted.collect()) == [(10.02, 0.25), (10.03, 0.5)]
    layer = R.pixel_cell_key(cells, "cell_lat", "cell_lon").select("row", "col", "cell_id", (F.col("uparea_km2") * 1e6).alias("uparea_m2"))
    tagged = R.tag_upstream_area(cells.drop("uparea_km2"), layer)
    assert sorted((r.cell_id, r.uparea_km2) for r in tagged.collect()) == [(1, 900.0), (7201, 100.0)]


def test_negatives_that_round_to_zero_keep_their_sign(spark):
    """As the SQL twin's printf writes them."""
    got = one(spark, *[geo.number_text(F.lit(x), 6).alias(f"c{k}") for k, x in enumerate((-1e-8, 1e-8, 0.0, -1e-6, -2.5, 12.3456785))])
    assert list(got) == ["-0", "0", "0", "-0.000001", "-2.5", "12.345679"]
    box = F.struct(F.lit(1.0).alias("lon_min"), F.lit(-1e-9).alias("lat_min"), F.lit(2.0).alias("lon_max"), F.lit(1.0).alias("lat_max"))
    assert one(spark, geo.boxes_to_wkt(F.array(box), 6).alias("w")).w == "POLYGON ((1 -0, 2 -0, 2 1, 1 1, 1 -0))"
    assert one(spark, geo.number_text(F.lit(-1e-14)).alias("t")).t == "0"


def test_parts_grow_with_the_table(spark, monkeypatch):
    """Points and nodes are dealt in parts of so many rows of their table, whatever their bytes in the shuffle; radii take one aggregate, without a group for each threshold and quadrant."""
    folder = "/root/testdata/sf0.01"
    monkeypatch.setattr(tables, "ROWS_A_TASK", 5_000)
    for df in (adapters.track_points(spark, folder), adapters.grid_field(spark, folder)):
        assert df.rdd.getNumPartitions() == 12  # 60,000 rows
    raw = adapters.raw_tracks(spark, folder)
    wide = T.radii_to_wide(raw)
    assert wide._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == raw._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") + 1
