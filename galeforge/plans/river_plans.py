"""Queries of rivers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rivers as R
from ..operators.envelopes import grid_descriptor
from ..schemas import STEPS_H
from ..sources import adapters as A
from ..sources.tables import read
from .base import A3, A4, A5, A6, A7, plan, with_
from .track_plans import text  # noqa: F401

EX = "ex as (select d.*, t.rp, t.threshold from discharge d join cell_thresholds t on d.cell_id = t.cell_id where t.threshold > 0 and d.value > t.threshold)"
ROW = lambda x: f"cast(greatest(least(round_even((({x}) - 59.975e0) / -0.05e0, 0), 2399), 0) as int)"
COL = lambda x: f"cast(greatest(least(round_even((({x}) + 179.975e0) / 0.05e0, 0), 7199), 0) as int)"
CELL = "cell as (select distinct cell_id, cell_lat, cell_lon, case when cell_id % 5 = 0 then null else (cell_id * 13 % 1200) * 1e0 end as uparea_km2 from discharge)"
PROB = "prob as (select t.rp, d.step_h, d.cell_id, count(*) filter (t.threshold > 0 and d.value > t.threshold) / 51e0 as probability from discharge d join cell_thresholds t on d.cell_id = t.cell_id group by 1, 2, 3)"
WET = "wet as (select * from pixels where depth > 0.1 and water <> 1)"
MASKS = "masks as (select rp, cell_id, " + ", ".join(f"coalesce(bit_or(case when step_h = {h} then 1::bigint << cast(member - 1 as int) end), 0) as m{h:03d}" for h in STEPS_H) + " from ex group by rp, cell_id)"


def D(spark, d):
    return A.discharge(spark, d)


def T(spark, d):
    return A.cell_thresholds(spark, d)


def cells(spark, d):
    return D(spark, d).select("cell_id", "cell_lat", "cell_lon").distinct().withColumn("uparea_km2", F.when(F.col("cell_id") % 5 != 0, (F.col("cell_id") * 13 % 1200).cast("double")))


def ex(spark, d):
    return R.exceedances(D(spark, d), T(spark, d))


def prob(spark, d):
    return R.tier_probability(D(spark, d), T(spark, d))


def extent(spark, d):
    return R.extent_rows(A.pixels(spark, d), R.member_bitmask(ex(spark, d)), cells(spark, d))


@plan("r1_combine_control", with_(A4) + "select cell_id, member, step_h, value from discharge")
def r1(spark, d):
    x = D(spark, d)
    return R.combine_control(x.where("member < 51"), x.where("member = 51")).select("cell_id", "member", "step_h", "value")


@plan("r2_nonpositive_to_null", with_(A5) + "select cell_id, rp, case when threshold > 0 then threshold end as threshold from cell_thresholds")
def r2(spark, d):
    return T(spark, d).select("cell_id", "rp", R.positive_or_null(F.col("threshold")).alias("threshold"))


@plan("r3_sparse_filter", with_(A4, A5) + "select cell_id, member, step_h, value from (select d.*, bool_or(t.threshold > 0 and d.value > t.threshold) over (partition by d.cell_id) as keep from discharge d join cell_thresholds t on d.cell_id = t.cell_id and t.rp = 2) where keep")
def r3(spark, d):
    return R.sparse_filter(D(spark, d), T(spark, d)).select("cell_id", "member", "step_h", "value")


@plan("r4_nearest_grid_lookup", with_(A4, A6) + f", layer as (select {ROW('cell_lat')} as r, {COL('cell_lon')} as c, min(cell_id) as layer_id from discharge group by 1, 2) select pixel_id, layer_id from pixels left join layer on {ROW('pixel_lat + 0.02')} = r and {COL('pixel_lon')} = c")
def r4(spark, d):
    layer = D(spark, d).groupBy(R.cell_row(F.col("cell_lat")).alias("row"), R.cell_col(F.col("cell_lon")).alias("col")).agg(F.min("cell_id").alias("layer_id"))
    p = A.pixels(spark, d).withColumn("pixel_lat", F.col("pixel_lat") + 0.02)
    return R.nearest_grid_lookup(p, layer, "pixel_lat", "pixel_lon").select("pixel_id", "layer_id")


@plan("r5_tag_upstream_area", with_(A4) + "select distinct cell_id, case when (cell_id % 7 - 1) * 1e9 > 0 then (cell_id % 7 - 1) * 1e9 / 1e6 end as uparea_km2 from discharge")
def r5(spark, d):
    c = cells(spark, d).drop("uparea_km2")
    layer = c.select("cell_id", R.cell_row(F.col("cell_lat")).alias("row"), R.cell_col(F.col("cell_lon")).alias("col"), ((F.col("cell_id") % 7 - 1) * 1e9).alias("uparea_m2"))
    return R.tag_upstream_area(c, layer).select("cell_id", "uparea_km2")


@plan("r6_sparse_stats", with_(A4, A5, EX, CELL) + ", k as materialized (select distinct cell_id from ex where rp = 2) select (select count(distinct cell_id) from discharge) as total_cells, (select count(*) from k) as kept_cells, (select max(value) from discharge where cell_id in (from k)) as max_discharge, (select count(*) from cell where uparea_km2 < 500 and cell_id in (from k)) as small_basins, 100e0 * (select count(*) from k) / (select count(distinct cell_id) from discharge) as kept_pct")
def r6(spark, d):
    return R.sparse_stats(D(spark, d), R.sparse_filter(D(spark, d), T(spark, d)), cells(spark, d))


@plan("r7_tier_exceedance", with_(A4, A5, EX) + "select rp, member, step_h, cell_id from ex")
def r7(spark, d):
    return ex(spark, d).select("rp", "member", "step_h", "cell_id")


@plan("r8_tier_probability", with_(A4, A5, PROB) + "select * from prob")
def r8(spark, d):
    return prob(spark, d)


@plan("r8_tier_counts", with_(A4, A5, PROB) + "select rp, step_h, count(*) filter (probability > 0) as cells, max(probability) as highest from prob group by rp, step_h")
def r8_counts(spark, d):
    return R.tier_counts(prob(spark, d))


@plan("r9_tier_source", with_(A5) + "select cell_id, rp, case when rp < 10 then 10 else rp end as source_rp, rp < 10 as is_standin from cell_thresholds")
def r9(spark, d):
    return T(spark, d).join(F.broadcast(R.tier_source(spark)), "rp").select("cell_id", "rp", "source_rp", "is_standin")


@plan("r10_tier_keep_cells", with_(A4, A5, EX) + "select distinct rp, cell_id from ex")
def r10(spark, d):
    return R.tier_keep_cells(ex(spark, d))


@plan("r11_below_min_basin", with_(A4, CELL) + "select cell_id, coalesce(uparea_km2 < 500, false) as below_min_basin from cell")
def r11(spark, d):
    return cells(spark, d).select("cell_id", R.below_min_basin(F.col("uparea_km2")).alias("below_min_basin"))


@plan("r12_pixel_cell_key", with_(A4, A6) + ", c as (select distinct cell_id, cell_lat, cell_lon from discharge) select p.pixel_id, p.cell_id as owner from pixels p join c on c.cell_id = p.cell_id")
def r12(spark, d):
    c = R.pixel_cell_key(cells(spark, d), "cell_lat", "cell_lon").select("row", "col", "cell_id")
    p = R.pixel_cell_key(A.pixels(spark, d))
    return p.join(c, R.cell_keys(p, c)).select("pixel_id", F.col("cell_id").alias("owner"))


@plan("r13_flood_pixels", with_(A6, WET) + "select pixel_id, depth from wet")
def r13(spark, d):
    return R.flood_pixels(A.pixels(spark, d)).select("pixel_id", "depth")


@plan("r14_member_bitmask", with_(A4, A5, EX, MASKS) + "select * from masks")
def r14(spark, d):
    return R.member_bitmask(ex(spark, d))


_MASK = ", ".join(R.MASK_COLUMNS)


@plan("r15_extent_rows", with_(A4, A5, A6, EX, MASKS, WET, CELL) + f"select rp, pixel_lat, pixel_lon, {_MASK}, coalesce(uparea_km2 < 500, false) as below_min_basin from wet join masks using (cell_id) join cell using (cell_id)")
def r15(spark, d):
    return extent(spark, d)


_BITS = lambda x: "(" + " + ".join(f"((({x} >> {k}) & 1) << {2 * k})" for k in range(16)) + ")"


@plan("r16_morton_order", with_(A4, CELL) + f"select cell_id, (({_BITS('i')} << 1) | {_BITS('j')}) as morton from (select cell_id, cast(floor((cell_lat + 90e0) / 0.05e0) as bigint) as i, cast(floor((cell_lon + 180e0) / 0.05e0) as bigint) as j from cell)")
def r16(spark, d):
    return R.with_morton(cells(spark, d), "cell_lat", "cell_lon").select("cell_id", "morton")


@plan("r17_expand_bitmask", with_(A4, A5, A6, EX, WET) + "select rp, pixel_lat, pixel_lon, step_h, member from wet join (select distinct cell_id, rp, step_h, member from ex) using (cell_id)")
def r17(spark, d):
    return R.expand_bitmask(extent(spark, d)).select("rp", "pixel_lat", "pixel_lon", "step_h", "member")


@plan("r18_rank_members_by_extent", with_(A4, A5, A6, EX, WET) + "select member, count(*) as pixels from wet join (select distinct cell_id, step_h, member from ex where rp = 10 and step_h = 72) using (cell_id) group by member order by pixels desc, member limit 10")
def r18(spark, d):
    return R.rank_members_by_extent(R.expand_bitmask(extent(spark, d).where("rp = 10"), [72]), 10)


@plan("r18_counts_from_masks", with_(A4, A5, A6, EX, WET) + "select member, count(*) as pixels from wet join (select distinct cell_id, rp, step_h, member from ex) using (cell_id) group by member")
def r18_counts(spark, d):
    return R.member_extent_counts(extent(spark, d))


@plan("r19_masked_probability", with_(A4, A5, A6, PROB, WET) + "select rp, step_h, pixel_lat, pixel_lon, probability from wet join prob using (cell_id) where probability > 0")
def r19(spark, d):
    return R.masked_probability(A.pixels(spark, d), prob(spark, d), cells(spark, d))


@plan("r19_painted_counts", with_(A4, A5, A6, PROB, WET) + "select rp, step_h, count(*) as pixels from wet join prob using (cell_id) where probability > 0 group by rp, step_h")
def r19_counts(spark, d):
    return R.painted_counts(R.masked_probability(A.pixels(spark, d), prob(spark, d), cells(spark, d)))


@plan("r20_naive_vs_masked", with_(A4, A5, A6, PROB, WET) + ", w as (select cell_id, count(*) as k from wet group by cell_id) select rp, step_h, count(*) as cells, cast(sum(coalesce(k, 0)) as bigint) as pixels from prob left join w using (cell_id) where probability > 0 group by rp, step_h")
def r20(spark, d):
    p = prob(spark, d)
    return R.naive_vs_masked(p, R.masked_probability(A.pixels(spark, d), p, cells(spark, d)))


@plan("r21_prefilter_to_layer", with_(A4, A6, CELL) + "select cell_id, cell_lat, cell_lon from (select cell_id, cell_lat + 20 as cell_lat, cell_lon from cell), (select min(pixel_lat) - 0.05 as s, max(pixel_lat) + 0.05 as n, min(pixel_lon) - 0.05 as w, max(pixel_lon) + 0.05 as e from pixels) where cell_lat between s and n and cell_lon between w and e")
def r21(spark, d):
    return R.prefilter_to_layer(cells(spark, d).withColumn("cell_lat", F.col("cell_lat") + 20), A.pixels(spark, d)).select("cell_id", "cell_lat", "cell_lon")


PCT = "pct as (select d.cell_id, d.cell_lat, d.cell_lon, 100e0 * count(*) filter (t.threshold > 0 and d.value > t.threshold) / count(*) as pct from discharge d join cell_thresholds t on d.cell_id = t.cell_id and t.rp = 2 where d.step_h = 72 group by 1, 2, 3)"


@plan("r22_hotspot_box", with_(A4, A5, PCT) + "select n, \"by\", bx, lon_min, lon_max, lat_min, lat_max from (select cast(round_even(cell_lat / 2, 0) as int) as \"by\", cast(round_even(cell_lon / 2, 0) as int) as bx, count(*) as n, min(cell_lon) - 12 as lon_min, max(cell_lon) + 12 as lon_max, min(cell_lat) - 12 as lat_min, max(cell_lat) + 12 as lat_max from pct where pct > (select case when max(pct) > 50 then 50 else 0 end from pct) group by 1, 2) order by n desc, \"by\", bx limit 1")
def r22(spark, d):
    return R.hotspot_box(R.discharge_exceedance(D(spark, d), T(spark, d), 2, 72))


@plan("r23_most_active_cell", with_(A4) + "select cell_id, cell_lat, cell_lon, max(case when step_h = 168 then value end) - max(case when step_h = 24 then value end) as rise from discharge group by 1, 2, 3 order by rise desc, cell_id limit 1")
def r23(spark, d):
    return R.most_active_cell(D(spark, d), 24, 168)


@plan("r24_gauge_hydrograph", with_(A4, CELL) + "select cell_id, step_h, median(value) as median, min(value) as low, max(value) as high from discharge where cell_id = (select cell_id from cell order by (cell_lat - 12.3) * (cell_lat - 12.3) + (cell_lon + 45.6) * (cell_lon + 45.6), cell_id limit 1) group by cell_id, step_h")
def r24(spark, d):
    return R.gauge_hydrograph(D(spark, d), 12.3, -45.6)


_AT = "(select cell_id from cell order by (cell_lat - 12.3) * (cell_lat - 12.3) + (cell_lon + 45.6) * (cell_lon + 45.6), cell_id limit 1)"


@plan("r24_gauge_members", with_(A4, CELL) + f"select cell_id, step_h, member, value from discharge where cell_id = {_AT}")
def r24_members(spark, d):
    return R.gauge_members(D(spark, d), 12.3, -45.6)


@plan("r24_gauge_thresholds", with_(A4, A5, CELL) + f"select cell_id, rp, case when threshold > 0 then threshold end as threshold from cell_thresholds where cell_id = {_AT}")
def r24_thresholds(spark, d):
    return R.gauge_thresholds(D(spark, d), T(spark, d), 12.3, -45.6)


#: A gauge for every customer, anywhere between 60 degrees south and north.
_GAUGES = "gauges as (select c_custkey as gauge_id, ((c_custkey * 7919) % 12000) / 1e2 - 60e0 as lat, ((c_custkey * 104729) % 36000) / 1e2 - 180e0 as lon from customer)"
_NEAR = "near as (select gauge_id, cell_id, sqrt(d2) as distance from (select gauge_id, cell_id, d2, row_number() over (partition by gauge_id order by d2, cell_id) as k from (select gauge_id, cell_id, (cell_lat - lat) * (cell_lat - lat) + (cell_lon - lon) * (cell_lon - lon) as d2 from gauges cross join cell)) where k = 1)"


def gauges(spark, d):
    return read(spark, d, "customer").selectExpr("c_custkey as gauge_id", "((c_custkey * 7919) % 12000) / 1e2 - 60e0 as lat", "((c_custkey * 104729) % 36000) / 1e2 - 180e0 as lon")


@plan("r24_nearest_cells", with_(A4, CELL, _GAUGES, _NEAR) + "select * from near")
def r24_nearest(spark, d):
    return R.nearest_cells(gauges(spark, d), cells(spark, d))


@plan("r24_gauge_hydrographs", with_(A4, A5, CELL, _GAUGES, _NEAR) + """, h as (select cell_id, step_h, median(value) as median, min(value) as low, max(value) as high from discharge group by cell_id, step_h)
  select gauge_id, cell_id, step_h, median, low, high, (select min(rp) from cell_thresholds t where t.cell_id = h.cell_id and t.threshold > 0 and h.median > t.threshold) as first_rp from near join h using (cell_id)""")
def r24_hydrographs(spark, d):
    return R.gauge_hydrographs(D(spark, d), T(spark, d), gauges(spark, d))


@plan("r25_discharge_mean_max", with_(A4) + "select cell_id, step_h, avg(value) as mean, max(value) as max from discharge where step_h in (24, 72, 120, 168) group by cell_id, step_h")
def r25(spark, d):
    return R.discharge_mean_max(D(spark, d))


@plan("r26_discharge_exceedance", with_(A4, A5, PCT) + "select cell_id, pct, pct > 50 as likely from pct")
def r26(spark, d):
    return R.discharge_exceedance(D(spark, d), T(spark, d), 2, 72).select("cell_id", "pct", (F.col("pct") > 50).alias("likely"))


@plan("r27_dense_index", with_(A4, CELL) + ", i as (select cell_id, cast(round_even((59.975e0 - cell_lat) / 0.05e0, 0) as int) as r, cast(round_even((cell_lon + 179.975e0) / 0.05e0, 0) as int) as c from cell) select a.r as row, b.c as col, cell_id from range(100, 141) as a(r) cross join range(200, 401) as b(c) left join i on i.r = a.r and i.c = b.c")
def r27(spark, d):
    return R.dense_crop(cells(spark, d), (100, 140), (200, 400)).select("row", "col", "cell_id")


@plan("r28_tiles_in_box", with_(A4, CELL) + "select cell_id from cell where cell_lon - 5 < -20 and cell_lon + 5 > -100 and cell_lat - 5 < 10 and cell_lat + 5 > -30")
def r28(spark, d):
    tiles = cells(spark, d).select("cell_id", F.array(F.col("cell_lon") - 5, F.col("cell_lon") + 5).alias("lons"), F.array(F.col("cell_lat") + 5, F.col("cell_lat") - 5).alias("lats"))
    return R.tiles_in_box(tiles, -100.0, -30.0, -20.0, 10.0).select("cell_id")


@plan("r29_mosaic_tiles", with_(A3) + "select r as row, c as col, coalesce(max_by(value, step * 10 + member) filter (value <> 1.5), 0) as value from grid_field group by r, c")
def r29(spark, d):
    tiles = A.grid_field(spark, d).select(F.col("r").alias("row"), F.col("c").alias("col"), "value", (F.col("step") * 10 + F.col("member")).alias("tile_order"))
    return R.mosaic_tiles(tiles, 1.5, 0.0)


#: Each member's field as a tile of 0.25 degrees, half a degree farther north and east than the one before; the grid has cells of 0.4 degrees.
_TILES = """, px as (select member as o, r as prow, c as pcol, max(value) as value from grid_field group by 1, 2, 3),
t as (select o, 20.125e0 + 0.5e0 * o as n, -60.125e0 + 0.5e0 * o as w, max(prow) + 1 as h, max(pcol) + 1 as wd from px group by o),
g as (select o, n, w, unnest(range(cast(ceil((25e0 - n) / 0.4e0 - 0.5e0) as int), cast(ceil((25e0 - n + h * 0.25e0) / 0.4e0 - 0.5e0) as int))) as "row", wd from t),
x as (select o, n, w, "row", unnest(range(cast(ceil((w + 65e0) / 0.4e0 - 0.5e0) as int), cast(ceil((w + wd * 0.25e0 + 65e0) / 0.4e0 - 0.5e0) as int))) as col from g)
select x."row", x.col, coalesce(max_by(px.value, px.o) filter (px.value <> 1.5), 0) as value from x join px on px.o = x.o and px.prow = cast(floor((n - (25e0 - 0.4e0 * ("row" + 0.5e0))) / 0.25e0) as int) and px.pcol = cast(floor((-65e0 + 0.4e0 * (col + 0.5e0) - w) / 0.25e0) as int) group by 1, 2"""


@plan("r29_resample_tiles", with_(A3) + _TILES)
def r29_resample(spark, d):
    px = A.grid_field(spark, d).groupBy(F.col("member").alias("tile_order"), F.col("r").alias("prow"), F.col("c").alias("pcol")).agg(F.max("value").alias("value"))
    t = px.groupBy("tile_order").agg((F.max("prow") + 1).alias("height"), (F.max("pcol") + 1).alias("width"))
    t = t.withColumns({"t_north": 20.125 + 0.5 * F.col("tile_order"), "t_west": -60.125 + 0.5 * F.col("tile_order"), "t_deg": F.lit(0.25)})
    return R.mosaic_tiles(R.resample_tiles(t, px, 25.0, -65.0, 0.4), 1.5, 0.0)


@plan("r29_water_or_zero", with_(A3) + "select member, step, r, c, case when value is null or value = 1.5 then 0 else value end as water from grid_field")
def r29_water(spark, d):
    f = A.grid_field(spark, d).withColumn("value", F.when((F.col("r") + F.col("c")) % 2 == 0, F.when(F.col("value") == 1.5, float("nan")).otherwise(F.col("value"))).otherwise(F.col("value")))
    return f.select("member", "step", "r", "c", R.water_or_zero(F.col("value"), 1.5).alias("water"))


@plan("r30_coregistered", with_(A3) + "select count(distinct concat(w, '|', s, '|', e, '|', n)) = 1 as coregistered from (select member, min(lon) as w, min(lat) as s, max(lon) as e, max(lat) as n from grid_field group by member)")
def r30(spark, d):
    return R.coregistered(grid_descriptor(A.grid_field(spark, d), ["member"]))


_DAY = "cast(regexp_extract(file_name, '_ens_([0-9-]+)_r', 1) as date)"


@plan("r31_latest_available", with_(A7) + f"select cast(max(day) as varchar) as day from (select {_DAY} as day from field_files where {_DAY} between date '1997-03-01' - 40 and date '1997-03-01' group by 1 having count(distinct substr(file_name, 1, 4)) = 2)")
def r31(spark, d):
    f = A.field_files(spark, d).select(F.regexp_extract("file_name", "_ens_([0-9-]+)_r", 1).cast("date").alias("day"), F.substring("file_name", 1, 4).alias("product"))
    return R.latest_available(f, "1997-03-01", 40, ["wind", "gust"]).select(F.col("day").cast("string").alias("day"))


@plan("r32_tiers_complete", "select cast(o_orderdate as varchar)[:10] as day, 6 - count(distinct o_orderkey % 7) filter (o_orderkey % 7 < 6) as missing, count(distinct o_orderkey % 7) filter (o_orderkey % 7 < 6) = 6 as complete from orders group by 1")
def r32(spark, d):
    tiers = R.tier_source(spark)
    rp = F.element_at(F.array(*[F.lit(x) for x in (2, 5, 10, 20, 50, 100, 500)]), (1 + F.col("o_orderkey") % 7).cast("int"))
    out = read(spark, d, "orders").select(F.substring(F.col("o_orderdate").cast("string"), 1, 10).alias("day"), rp.alias("rp"))
    return R.tiers_complete(out, tiers)
