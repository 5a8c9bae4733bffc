"""Queries of the warehouse, serving, catalogue, sink and stream operators."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..operators import serving as Q
from ..operators import warehouse as H
from ..operators.envelopes import combined_envelopes, individual_envelopes
from ..sources import adapters as A
from ..sources import catalog as C
from ..sources import sinks as S
from ..sources.keyed import KeyedTable
from ..sources.scratch import scratch
from ..sources.tables import dealt, read
from ..streaming.ingest import file_stream_ingest
from .base import A1, A3, A4, A7, F3, plan, with_
from .field_plans import CELLS, cells
from .river_plans import EX, MASKS, A5, A6, CELL, WET, extent
from .track_plans import TIME, text, tracks

KEY = ["storm_id", "ensemble_member", "step"]


# Warehouse: of every three steps the target has the first two, the source the last two; all rows are in one or both.
_TARGET, _SOURCE = "step % 18 < 12", "step % 18 > 0"
_REGION = "case when (ensemble_member + step) % 5 = 0 then null else concat('R', wind) end"


def target(spark, d):
    return A.track_points(spark, d).where(_TARGET).select(*KEY, "wind", F.lit("old").alias("region"), F.lit(0).alias("valid_time"), F.lit("first").alias("loaded_at"))


def source(spark, d):
    return A.track_points(spark, d).where(_SOURCE).select(*KEY, (F.col("wind") * 2).alias("wind"), F.expr(_REGION).alias("region"), F.lit(1).alias("valid_time"), F.lit("unset").alias("loaded_at"))


_T = f"t as (select storm_id, ensemble_member, step, wind, 'old' as region, 0 as valid_time, 'first' as loaded_at from track_points where {_TARGET})"
_S = f"s as (select storm_id, ensemble_member, step, wind * 2 as wind, {_REGION} as region, 1 as valid_time, 'second' as loaded_at from track_points where {_SOURCE})"


@plan(
    "w1_prepare_rows",
    f"""select o_orderkey as "O_ORDERKEY", case o_orderkey % 3 when 0 then strftime(cast(o_orderdate as timestamp), '{TIME}') when 1 then concat(cast(o_orderdate as varchar)[:10], ' 06:00:00') end as "VALID_TIME",
    case when o_orderkey % 4 = 0 then null else round(o_totalprice / 7e0, 6) end as "PRICE", case o_orderkey % 5 when 0 then null when 1 then null when 2 then null else 'POLYGON' end as "REGION" from orders""",
)
def w1(spark, d):
    day = F.substring(F.col("o_orderdate").cast("string"), 1, 10)
    when = F.when(F.col("o_orderkey") % 3 == 0, day).when(F.col("o_orderkey") % 3 == 1, F.concat(day, F.lit("T06:00:00"))).otherwise("not a time")
    region = F.element_at(F.array(*map(F.lit, (" ", "None", "null", "POLYGON ", " POLYGON"))), (1 + F.col("o_orderkey") % 5).cast("int"))
    price = F.when(F.col("o_orderkey") % 4 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice").cast("double") / 7)
    rows = read(spark, d, "orders").select("o_orderkey", when.alias("valid_time"), price.alias("price"), region.alias("region"))
    return H.prepare_rows(rows, ["valid_time"], "region")


@plan("w2_insert_missing", with_(A1, _T, _S) + "select storm_id, ensemble_member, step, wind, region from t union all select storm_id, ensemble_member, step, wind, region from s where not exists (select 1 from t where t.storm_id = s.storm_id and t.ensemble_member = s.ensemble_member and t.step = s.step)")
def w2(spark, d):
    src = source(spark, d)
    return H.insert_missing(target(spark, d), src.union(src), KEY, ["wind"]).select(*KEY, "wind", "region")


_UPSERT = """select coalesce(t.storm_id, s.storm_id) as storm_id, coalesce(t.ensemble_member, s.ensemble_member) as ensemble_member, coalesce(t.step, s.step) as step, coalesce(t.wind, s.wind) as wind,
  case when t.storm_id is null or s.region is not null then s.region else t.region end as region, case when t.storm_id is null or s.region is not null then s.valid_time else t.valid_time end as valid_time,
  case when t.storm_id is null or s.region is not null then s.loaded_at else t.loaded_at end as loaded_at
  from t full join s on t.storm_id = s.storm_id and t.ensemble_member = s.ensemble_member and t.step = s.step"""


@plan("w3_upsert_if_region", with_(A1, _T, _S) + _UPSERT)
def w3(spark, d):
    return H.upsert_if_region(target(spark, d), source(spark, d), KEY, F.lit("second"))


def keyed(spark, d, rows, key=KEY, buckets=8):
    return KeyedTable.create(rows, scratch(spark, "keyed"), key, buckets)


@plan("w2_bucketed_insert", with_(A1, _T, _S) + "select storm_id, ensemble_member, step, wind, region from t union all select storm_id, ensemble_member, step, wind, region from s where not exists (select 1 from t where t.storm_id = s.storm_id and t.ensemble_member = s.ensemble_member and t.step = s.step)")
def w2_bucketed(spark, d):
    table = keyed(spark, d, target(spark, d).select(*KEY, "wind", "region"))
    table.insert_missing(source(spark, d).select(*KEY, "wind", "region"), ["wind"])
    return table.read()


@plan("w3_bucketed_upsert", with_(A1, _T, _S) + _UPSERT)
def w3_bucketed(spark, d):
    table = keyed(spark, d, target(spark, d))
    rows = source(spark, d).withColumn("loaded_at", F.lit("second"))
    table.upsert(rows, ["region", "valid_time", "loaded_at"], F.col("s_region").isNotNull(), [F.col("region").isNull(), "region"])
    return table.read()


_COMBINED = """, tc as (select storm_id, ensemble_member, 34 as threshold, 'old' as region, '0-12' as lead_range, 0 as lead_range_start, 'first' as loaded_at from t group by 1, 2),
  sc as (select storm_id, ensemble_member, case when ensemble_member % 2 = 0 then 34 else 50 end as threshold, max(region) as region, concat(min(step), '-', max(step)) as lead_range, min(step) as lead_range_start, 'second' as loaded_at from s group by 1, 2)
  select coalesce(tc.storm_id, sc.storm_id) as storm_id, coalesce(tc.ensemble_member, sc.ensemble_member) as ensemble_member, coalesce(tc.threshold, sc.threshold) as threshold,
  case when tc.storm_id is null or sc.region is not null then sc.region else tc.region end as region, case when tc.storm_id is null or sc.region is not null then sc.lead_range_start else tc.lead_range_start end as lead_range_start
  from tc full join sc on tc.storm_id = sc.storm_id and tc.ensemble_member = sc.ensemble_member and tc.threshold = sc.threshold"""


@plan("w4_upsert_combined", with_(A1, _T, _S) + _COMBINED)
def w4(spark, d):
    t = target(spark, d).select("storm_id", "ensemble_member", F.lit(34).alias("threshold"), "region", F.lit("0-12").alias("lead_range"), F.lit(0).alias("lead_range_start"), "loaded_at").distinct()
    s = source(spark, d).groupBy("storm_id", "ensemble_member").agg(F.max("region").alias("region"), F.concat_ws("-", F.min("step").cast("string"), F.max("step").cast("string")).alias("lead_range"))
    s = s.withColumns({"threshold": F.when(F.col("ensemble_member") % 2 == 0, 34).otherwise(50)})
    out = H.upsert_combined(t, s, ["storm_id", "ensemble_member", "threshold"], F.lit("second"))
    return out.select("storm_id", "ensemble_member", "threshold", "region", "lead_range_start")


@plan("w5_lead_range_start", "select o_orderkey, cast(o_orderkey % 49 as int) as start_h from orders")
def w5(spark, d):
    k = (F.col("o_orderkey") % 49).cast("string")
    x = F.when(F.col("o_orderkey") % 2 == 0, k).otherwise(F.concat(k, F.lit("-"), (F.col("o_orderkey") % 49 + 48).cast("string")))
    return read(spark, d, "orders").select("o_orderkey", H.lead_range_start(x).alias("start_h"))


@plan("w6_safe_region", with_(A4, CELL) + "select cell_id, (cell_id % 4 <> 3 and cell_lon + 10 <= 180 and cell_id % 6 <> 5) as safe from cell")
def w6(spark, d):
    from .river_plans import cells as river_cells

    c = river_cells(spark, d)
    at = lambda x, y: F.concat((F.col("cell_lon") + x).cast("string"), F.lit(" "), (F.col("cell_lat") + y).cast("string"))
    ring = F.concat_ws(", ", at(0, 0), at(10, 0), at(10, 5), F.when(F.col("cell_id") % 6 == 5, at(1, 1)).otherwise(at(0, 0)))
    wkt = F.when(F.col("cell_id") % 4 == 3, "POLYGON EMPTY?").otherwise(F.concat(F.lit("POLYGON (("), ring, F.lit("))")))
    return c.select("cell_id", H.safe_region(wkt).isNotNull().alias("safe"))


@plan("w7_upsert_pointer", "select coalesce(t.run, s.run) as run, coalesce(t.param, s.param) as param, coalesce(s.path, t.path) as path from (select o_orderkey % 50 as run, 'tp' as param, 'old' as path from orders where o_orderkey % 50 < 30 group by 1) t full join (select o_orderkey % 50 as run, 'tp' as param, max(concat('new', o_custkey)) as path from orders where o_orderkey % 50 > 20 group by 1) s on t.run = s.run and t.param = s.param")
def w7(spark, d):
    o = read(spark, d, "orders").withColumns({"run": F.col("o_orderkey") % 50, "param": F.lit("tp")})
    t = o.where("run < 30").select("run", "param", F.lit("old").alias("path")).distinct()
    s = o.where("run > 20").select("run", "param", F.concat(F.lit("new"), F.col("o_custkey").cast("string")).alias("path"))
    return H.upsert_pointer(t, s, ["run", "param"], [F.desc("path")])


@plan("w7_bucketed_pointer", "select coalesce(t.run, s.run) as run, coalesce(t.param, s.param) as param, coalesce(s.path, t.path) as path from (select o_orderkey as run, 'tp' as param, 'old' as path from orders where o_orderkey % 2 = 0) t full join (select o_orderkey as run, 'tp' as param, concat('new', o_custkey) as path from orders where o_custkey % 2 = 0) s on t.run = s.run and t.param = s.param")
def w7_bucketed(spark, d):
    o = read(spark, d, "orders").withColumn("param", F.lit("tp"))
    pointer = lambda rows, path: rows.select(F.col("o_orderkey").alias("run"), "param", path.alias("path"))
    table = keyed(spark, d, pointer(o.where("o_orderkey % 2 = 0"), F.lit("old")), ["run", "param"])
    table.upsert(pointer(o.where("o_custkey % 2 = 0"), F.concat(F.lit("new"), F.col("o_custkey").cast("string"))), ["path"], F.lit(True), [F.desc("path")])
    return table.read()


@plan("w8_append_rows", with_(A1) + "select storm_id, ensemble_member, step, wind, count(*) as n from (select * from track_points union all select * from track_points where storm_id = 'STORM1') group by 1, 2, 3, 4")
def w8(spark, d):
    path, t = scratch(spark, "append"), A.track_points(spark, d)
    S.append_rows(t, path)
    return S.append_rows(t.where("storm_id = 'STORM1'"), path).groupBy(*KEY, "wind").agg(F.count("*").alias("n"))


@plan("w9_evolve_schema", with_(A1, _T, _S) + "select storm_id, ensemble_member, step, cast(null as varchar) as is_standin from t union all select storm_id, ensemble_member, step, 'true' from s")
def w9(spark, d):
    old = H.evolve_schema(target(spark, d).select(*KEY), "is_standin", "boolean")
    return H.append_evolved(old, source(spark, d).select(*KEY, F.lit(True).alias("is_standin"))).withColumn("is_standin", F.col("is_standin").cast("string"))


@plan("w10_drop_identity", with_(F3) + "select track_id, ensemble_member, lead_time, latitude, longitude, pressure_hpa from tracks")
def w10(spark, d):
    out = H.drop_identity(tracks(spark, d))
    return out.select(*[c for c in out.columns if c in ("track_id", "storm_identifier", "ensemble_member", "lead_time", "latitude", "longitude", "pressure_hpa")])


@plan("w11_table_counts", "select 'orders' as table_name, count(*) as n, true as available from orders union all select 'customer', count(*), true from customer union all select 'rivers', null, false")
def w11(spark, d):
    return H.table_counts(spark, {"orders": read(spark, d, "orders"), "customer": read(spark, d, "customer"), "rivers": None})


_FILES = "files as (select o_orderkey as id, concat(case o_orderkey % 4 when 0 then 'tracks/' when 1 then 'envelopes/' when 2 then 'envelopes/' else 'other/' end, 'STORM', o_custkey, case o_orderkey % 5 when 0 then '_gust_envelopes_individual' when 1 then '_gust_envelopes_combined' when 2 then '_individual' when 3 then '_combined' else '_misc' end, '.csv') as path from orders)"
_ROUTE = "case when path like 'tracks/%' then 'TC_TRACKS' when path like 'envelopes/%' then case when path like '%gust\\_envelopes\\_individual%' escape '\\' then 'TC_GUST_ENVELOPES_INDIVIDUAL' when path like '%gust\\_envelopes\\_combined%' escape '\\' then 'TC_GUST_ENVELOPES_COMBINED' when path like '%individual%' then 'TC_ENVELOPES_INDIVIDUAL' when path like '%combined%' then 'TC_ENVELOPES_COMBINED' end end"


def files(spark, d):
    pick = lambda n, *v: F.element_at(F.array(*map(F.lit, v)), (1 + F.col("o_orderkey") % n).cast("int"))
    path = F.concat(pick(4, "tracks/", "envelopes/", "envelopes/", "other/"), F.lit("STORM"), F.col("o_custkey").cast("string"), pick(5, "_gust_envelopes_individual", "_gust_envelopes_combined", "_individual", "_combined", "_misc"), F.lit(".csv"))
    return read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), path.alias("path"))


@plan("w12_load_plan", with_(_FILES) + f"select target, recognised, count(*) as n from (select {_ROUTE} as target, {_ROUTE} is not null as recognised from files) group by 1, 2")
def w12(spark, d):
    return H.load_plan(files(spark, d)).groupBy("target", "recognised").agg(F.count("*").alias("n"))


# Serving.
@plan("q1_forecast_catalog", with_(F3) + f"select track_id, strftime(forecast_time, '{TIME}') as forecast_time, count(distinct ensemble_member) as n_members, max(lead_time) as max_lead from tracks group by 1, 2")
def q1(spark, d):
    return Q.forecast_catalog(tracks(spark, d)).select("track_id", text("forecast_time"), "n_members", "max_lead")


_RUN_TIME = "2024-07-01 00:00:00"


@plan("q2_storm_tracks", with_(F3) + f"select ensemble_member, lead_time, latitude, longitude, wind_speed_knots from tracks where track_id = 'STORM2' and forecast_time = timestamp '{_RUN_TIME}'")
def q2(spark, d):
    return Q.storm_tracks(tracks(spark, d), "STORM2", datetime(2024, 7, 1)).select("ensemble_member", "lead_time", "latitude", "longitude", "wind_speed_knots")


def envelopes(spark, d):
    return individual_envelopes(cells(spark, d), ["member", "step", "threshold"])


def storm_of(rows):
    """The fields' members as three storms, odd and even steps as two runs."""
    run = F.when(F.col("step") % 2 == 0, F.expr(A.RUN)).otherwise(F.expr("timestamp_ntz'2024-06-30 12:00:00'"))
    return rows.withColumns({"track_id": F.concat(F.lit("STORM"), (F.col("member") % 3).cast("string")), "forecast_time": run})


_EV = "env as (select member, step, threshold, count(*) as n_cells, min(lon) - 0.125e0 as lon_min, max(lon) + 0.125e0 as lon_max, min(lat) - 0.125e0 as lat_min, max(lat) + 0.125e0 as lat_max from cells group by 1, 2, 3)"


@plan("q3_storm_envelopes", with_(A3, CELLS, _EV) + "select member, step, threshold, n_cells from env where member % 3 = 1 and step % 2 = 0")
def q3(spark, d):
    return Q.storm_envelopes(storm_of(envelopes(spark, d)), "STORM1", datetime(2024, 7, 1)).select("member", "step", "threshold", "n_cells")


@plan("q4_latest_run", with_(F3) + f"select strftime(max(valid_time), '{TIME}') as forecast_time from tracks where track_id = 'STORM3' and strftime(valid_time, '{TIME}') like '2024-07-03%'")
def q4(spark, d):
    runs = tracks(spark, d).withColumn("forecast_time", F.col("valid_time"))  # each valid time as a run, so there are several
    return Q.latest_run(runs, "STORM3", "2024-07-03").select(text("forecast_time"))


@plan("q5_option_lists", with_(F3) + "select distinct strftime(valid_time, '%Y-%m-%d') as day, strftime(valid_time, '%H:%M') as time, track_id from tracks")
def q5(spark, d):
    return Q.option_lists(tracks(spark, d).withColumn("forecast_time", F.col("valid_time")))


@plan("q5_envelope_options", with_(A3, CELLS) + ", o as (select member, threshold from cells where member % 3 = 1 and step % 2 = 0) select 'member' as option, cast(member as int) as value from o union select 'threshold', cast(threshold as int) from o")
def q5_options(spark, d):
    return Q.envelope_options(storm_of(envelopes(spark, d)), "STORM1", datetime(2024, 7, 1))


@plan("q6_mean_by_lead", with_(F3) + "select track_id, lead_time, avg(wind_speed_knots) as mean_wind, avg(pressure_hpa) as mean_pressure from tracks group by 1, 2")
def q6(spark, d):
    return Q.mean_by_lead(tracks(spark, d))


_CLASS_SQL = ", ".join(f"count(distinct ensemble_member) filter (wind_speed_knots >= {lo} and wind_speed_knots < {hi}) as {n}" for n, lo, hi in (("td", -1, 34), ("ts", 34, 64), ("cat1", 64, 83), ("cat2", 83, 96), ("cat3", 96, 113), ("cat4", 113, 137), ("cat5", 137, 9999)))


@plan("q7_intensity_counts", with_(F3) + f"select track_id, lead_time, {_CLASS_SQL} from tracks group by 1, 2")
def q7(spark, d):
    return Q.intensity_counts(tracks(spark, d))


@plan("q8_dateline_segments", with_(F3) + "select track_id, ensemble_member, lead_time, cast(sum(j) over (partition by track_id, ensemble_member order by lead_time rows unbounded preceding) as bigint) as segment from (select *, case when abs(longitude - lag(longitude) over (partition by track_id, ensemble_member order by lead_time)) > 180 then 1 else 0 end as j from tracks)")
def q8(spark, d):
    return Q.dateline_segments(tracks(spark, d)).select("track_id", "ensemble_member", "lead_time", "segment")


@plan("q9_progressive_frames", with_(F3) + "select track_id, ensemble_member, lead_time, frame from tracks join (values (48), (96), (240)) as f(frame) on lead_time <= frame")
def q9(spark, d):
    return Q.progressive_frames(tracks(spark, d), [48, 96, 240]).select("track_id", "ensemble_member", "lead_time", "frame")


@plan("q10_frame_envelopes", with_(A3, CELLS, _EV) + "select member, step, threshold, n_cells from env where step = 9 and member in (1, 3) and threshold in (34, 64)")
def q10(spark, d):
    return Q.frame_envelopes(envelopes(spark, d), 9, [1, 3], [34, 64]).select("member", "step", "threshold", "n_cells")


@plan("q11_map_centre", with_(F3) + "select track_id, avg(latitude) as lat, avg(longitude) as lon from tracks group by 1")
def q11(spark, d):
    return Q.map_centre(tracks(spark, d), ["track_id"])


@plan("q12_track_endpoints", with_(F3) + "select track_id, ensemble_member, min_by(latitude, lead_time) as first_latitude, min_by(longitude, lead_time) as first_longitude, max_by(latitude, lead_time) as last_latitude, max_by(longitude, lead_time) as last_longitude from tracks group by 1, 2")
def q12(spark, d):
    return Q.track_endpoints(tracks(spark, d))


@plan("q13_label_points", with_(F3) + "select track_id, ensemble_member, lead_time, latitude, longitude from tracks where lead_time % 48 = 0")
def q13(spark, d):
    return Q.label_points(tracks(spark, d)).select("track_id", "ensemble_member", "lead_time", "latitude", "longitude")


@plan("q14_envelope_extent", with_(A3, CELLS, _EV) + "select threshold, min(lon_min) - 1 as lon_min, max(lon_max) + 1 as lon_max, min(lat_min) - 1 as lat_min, max(lat_max) + 1 as lat_max from env group by 1")
def q14(spark, d):
    return Q.envelope_extent(envelopes(spark, d), ["threshold"], 1.0)


@plan("q15_member_steps", with_(A3, CELLS) + "select member, step, string_agg(threshold, ',' order by threshold) as thresholds from (select distinct member, step, threshold from cells where member = 1) group by 1, 2")
def q15(spark, d):
    return Q.member_steps(envelopes(spark, d), 77)  # not there, so the lowest member


@plan("q16_member_threshold_span", with_(A3, CELLS) + "select member, min(threshold) as lowest, max(threshold) as highest, count(*) as n from (select distinct member, threshold from cells) group by 1 order by 1 limit 4")
def q16(spark, d):
    return Q.member_threshold_span(combined_envelopes(cells(spark, d), ["member", "threshold"]), 4)


# Catalogues.
_RAWKEY = "storm_id, ensemble_member, step"


@plan("s1_read_raw_tracks", with_(A1) + "select storm_id, '007' as storm_identifier, concat('  ', storm_id, ' ') as long_storm_name, ensemble_member, step, latitude, wind from track_points")
def s1(spark, d):
    path = scratch(spark, "rawtracks")
    rows = A.track_points(spark, d).select("storm_id", F.lit("007").alias("storm_identifier"), F.concat(F.lit("  "), "storm_id", F.lit(" ")).alias("long_storm_name"), "ensemble_member", "step", "latitude", "longitude", "pressure", "wind")
    rows.write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return C.read_raw_tracks(spark, path).select("storm_id", "storm_identifier", "long_storm_name", "ensemble_member", "step", "latitude", "wind")


@plan("s1_many_headers", with_(A1) + "select storm_id, ensemble_member, step, case when substr(storm_id, 6)::int % 4 < 2 then latitude end as latitude, wind, count(*) as n from track_points group by all")
def s1_headers(spark, d):
    path = scratch(spark, "headers")
    k = F.substring("storm_id", 6, 12).cast("int") % 4
    for n, columns in enumerate((["storm_id", "ensemble_member", "step", "latitude", "wind"], ["wind", "latitude", "step", "extra", "ensemble_member", "storm_id"], ["step", "storm_id", "wind", "ensemble_member"], ["ensemble_member", "wind", "storm_id", "step"])):
        rows = A.track_points(spark, d).where(k == n).withColumn("extra", F.lit('said "so", twice'))
        rows.select(*columns).write.mode("append").option("header", True).option("quoteAll", n % 2 == 1).option("escape", "\"").csv(path)
    rows = dealt(C.read_raw_tracks(spark, path), read(spark, d, "lineitem").count(), "storm_id", "ensemble_member", "step")  # no more rows than lines that they were made of
    return rows.groupBy("storm_id", "ensemble_member", "step", "latitude", "wind").agg(F.count("*").alias("n"))


_PATHS = "paths as (select c_custkey, case c_custkey % 3 when 0 then concat('x/raw_storm_AB', c_custkey, '_z.csv') when 1 then concat('y/A_tropical_cyclone_track_N', c_custkey, '_1degW_transformed.csv') else concat(c_custkey, '_transformed.csv') end as path from customer)"


@plan("s2_storm_from_path", with_(_PATHS) + "select c_custkey, case c_custkey % 3 when 0 then concat('AB', c_custkey) when 1 then concat('N', c_custkey) else cast(c_custkey as varchar) end as storm from paths")
def s2(spark, d):
    k = F.col("c_custkey").cast("string")
    path = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("x/raw_storm_AB"), k, F.lit("_z.csv"))).when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("y/A_tropical_cyclone_track_N"), k, F.lit("_1degW_transformed.csv"))).otherwise(F.concat(k, F.lit("_transformed.csv")))
    return read(spark, d, "customer").select("c_custkey", C.storm_from_path(path).alias("storm"))


_FRUN = "strptime(concat(regexp_extract(file_name, '_ens_([0-9-]+)_r', 1), ' ', regexp_extract(file_name, '_r([0-9]{2})_f', 1)), '%Y-%m-%d %H')"
_FLEAD = "cast(regexp_extract(file_name, '_f([0-9]{3})h_', 1) as int)"


@plan("s3_run_from_path", with_(A7) + f"select file_id, strftime({_FRUN}, '{TIME}') as run from field_files")
def s3(spark, d):
    return A.field_files(spark, d).select("file_id", C.run_from_path(F.col("file_name")).alias("run")).select("file_id", text("run"))


@plan("s4_write_per_storm", with_(A1) + f"select lpad(substr(storm_id, 6), 4, '0') as storm_id, ensemble_member, step, wind from track_points")
def s4(spark, d):
    return S.write_per_storm(A.track_points(spark, d).withColumn("storm_id", F.lpad(F.substring("storm_id", 6, 12), 4, "0")), scratch(spark, "storms")).select(*KEY, "wind")


@plan("s5_field_file_catalog", with_(A7) + f"select file_id, substr(file_name, 1, 4) as kind, strftime({_FRUN}, '{TIME}') as run, {_FLEAD} as lead, regexp_extract(file_name, 'h_(pf|cf)', 1) as member_type from field_files")
def s5(spark, d):
    return C.field_file_catalog(A.field_files(spark, d)).select("file_id", "kind", text("run"), "lead", "member_type")


_MATCH = f"f as (select file_id, substr(file_name, 1, 4) as kind, {_FRUN} as run, {_FLEAD} as lead, regexp_extract(file_name, 'h_(pf|cf)', 1) as member_type from field_files), k as (select distinct run, lead, m as ensemble_member from f cross join (values (1), (51)) as t(m) where kind = 'gust')"


@plan("s5_match_files", with_(A7, _MATCH) + f"select strftime(k.run, '{TIME}') as run, k.lead, k.ensemble_member, count(f.file_id) as files, min(f.file_id) as first_file from k left join f on f.kind = 'wind' and f.run = k.run and f.lead = k.lead and f.member_type = case when k.ensemble_member = 51 then 'cf' else 'pf' end group by 1, 2, 3")
def s5_match(spark, d):
    c = C.field_file_catalog(A.field_files(spark, d))
    rows = c.where("kind = 'gust'").select("run", "lead", F.explode(F.array(F.lit(1), F.lit(51))).alias("ensemble_member")).distinct()
    out = C.match_files(rows, c.where("kind = 'wind'"))
    return out.groupBy(text("run"), "lead", "ensemble_member").agg(F.count("file_id").alias("files"), F.min("file_id").alias("first_file"))


@plan("s6_lead_times_for_run", with_(A7) + f"select distinct {_FLEAD} as lead from field_files where file_name like 'wind%' and {_FRUN} = (select max({_FRUN}) from field_files where file_name like 'wind%')")
def s6(spark, d):
    c = C.field_file_catalog(A.field_files(spark, d))
    return C.lead_times_for_run(c, "wind")


@plan("s7_modified_since", f"select file_id, strftime(modified, '{TIME}') as modified from (select o_orderkey as file_id, cast(o_orderdate as timestamp) + to_hours(cast(o_orderkey % 24 as int)) as modified from orders) where modified >= timestamp '1997-06-01 12:00:00'")
def s7(spark, d):
    f = read(spark, d, "orders").select(F.col("o_orderkey").alias("file_id"), (F.col("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))).alias("modified"))
    return C.modified_since(f, F.expr("timestamp_ntz'1997-06-01 12:00:00'")).select("file_id", text("modified"))


@plan("s7_list_files", "select concat('part=', o_orderkey % 5) as folder, true as found from orders group by 1")
def s7_listing(spark, d):
    path = scratch(spark, "listing")
    read(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 5).alias("part")).write.mode("overwrite").partitionBy("part").parquet(path)
    listed = C.modified_since(C.list_files(spark, path), F.expr("current_timestamp() - interval 1 day"))
    data = listed.where((F.col("length") > 0) & C.base_name(F.col("path")).startswith("part-"))
    return data.groupBy(F.regexp_extract("path", "(part=[0-9]+)", 1).alias("folder")).agg((F.count("*") > 0).alias("found"))


@plan("s8_route_to_table", with_(_FILES) + f"select id, {_ROUTE} as target from files")
def s8(spark, d):
    return files(spark, d).select("id", C.route_to_table(F.col("path")).alias("target"))


@plan(
    "s9_river_pointer_rows",
    """with f as (select distinct o_custkey % 8 as k, cast(o_orderdate as varchar)[:10] as day from orders)
    select '1997-03-01' as forecast_time, case k when 6 then 'dis24' else concat('extent_bymask_rp', [2, 5, 10, 20, 50, 100][1 + k]) end as param, case when k < 6 then cast(k < 2 as varchar) end as is_standin from f where day = '1997-03-01' and k < 7""",
)
def s9(spark, d):
    f = read(spark, d, "orders").select((F.col("o_custkey") % 8).alias("k"), F.substring(F.col("o_orderdate").cast("string"), 1, 10).alias("day")).distinct()
    rp = F.element_at(F.array(*map(F.lit, ("2", "5.0", "10", "20", "50", "100"))), (1 + F.col("k") % 6).cast("int"))
    name = F.when(F.col("k") < 6, F.concat(F.lit("river/river_extent_rp"), rp, F.lit("_bymask_"), "day", F.lit(".parquet"))).when(F.col("k") == 6, F.concat(F.lit("river/river_"), "day", F.lit(".zarr.zip"))).otherwise("river/notes.txt")
    return C.river_pointer_rows(f.select(name.alias("path")), "1997-03-01").select("forecast_time", "param", F.col("is_standin").cast("string").alias("is_standin"))


@plan("s10_write_sparse_discharge", with_(A4) + "select '2024-07-01' as forecast_date, cell_id, member, step_h, value from discharge")
def s10(spark, d):
    rows = S.stamp(A.discharge(spark, d), forecast_date="2024-07-01")
    return S.write_sparse_discharge(rows, scratch(spark, "discharge")).select(F.col("forecast_date").cast("string").alias("forecast_date"), "cell_id", "member", "step_h", "value")


@plan("s11_write_accumulated", with_(A3) + "select '2024-07-01' as forecast_time, 'tp' as param, member, step, r, c, value from grid_field")
def s11(spark, d):
    rows = S.stamp(A.grid_field(spark, d), forecast_time="2024-07-01", param="tp")
    return S.write_accumulated(rows, scratch(spark, "rain")).select(F.col("forecast_time").cast("string").alias("forecast_time"), "param", "member", "step", "r", "c", "value")


@plan("s12_write_extent", with_(A4, A5, A6, EX, MASKS, WET, CELL) + "select rp, pixel_lat, pixel_lon, m024, m072, coalesce(uparea_km2 < 500, false) as below_min_basin from wet join masks using (cell_id) join cell using (cell_id)")
def s12(spark, d):
    return S.write_extent(extent(spark, d), scratch(spark, "extent")).select("rp", "pixel_lat", "pixel_lon", "m024", "m072", "below_min_basin")


@plan("s12_extent_box", with_(A4, A5, A6, EX, MASKS, WET) + "select rp, pixel_lat, pixel_lon, m024, m072 from wet join masks using (cell_id) where pixel_lat between -31.3 and 14.2 and pixel_lon between -75.5 and 60.1")
def s12_box(spark, d):
    return S.read_extent_box(S.write_extent(extent(spark, d), scratch(spark, "extent")), -31.3, 14.2, -75.5, 60.1).select("rp", "pixel_lat", "pixel_lon", "m024", "m072")


@plan(
    "s11_block_crop",
    with_(A3) + """, held as (select distinct member, step, r // 16 as br, c // 64 as bc from grid_field), crop as (select member, step, x.r, y.c from range(3, 15) as x(r) cross join range(10, 151) as y(c) join held on br = x.r // 16 and bc = y.c // 64)
    select crop.member, crop.step, cast(crop.r as int) as row, cast(crop.c as int) as col, value from crop left join grid_field g on g.member = crop.member and g.step = crop.step and g.r = crop.r and g.c = crop.c""",
)
def s11_crop(spark, d):
    keys, size = ["member", "step"], (16, 64)
    blocks = S.write_blocks(A.grid_field(spark, d).withColumnsRenamed({"r": "row", "c": "col"}), scratch(spark, "blocks"), keys, size=size)
    return S.read_block_crop(blocks, keys, (3, 14), (10, 150), size)


@plan("s13_file_stream_ingest", with_(A1, _T, _S) + "select storm_id, ensemble_member, step, wind from t union all select storm_id, ensemble_member, step, wind from s where not exists (select 1 from t where t.storm_id = s.storm_id and t.ensemble_member = s.ensemble_member and t.step = s.step)")
def s13(spark, d):
    base = scratch(spark, "ingest")
    out = None
    for part in (target(spark, d), source(spark, d), target(spark, d)):  # the third brings nothing new
        part.select(*KEY, "wind").write.mode("append").parquet(f"{base}/landing")
        out = file_stream_ingest(spark, f"{base}/landing", "storm_id string, ensemble_member int, step int, wind double", f"{base}/table", f"{base}/state", KEY)
    return out
