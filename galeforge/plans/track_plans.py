"""Queries of messages and tracks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo, identity
from ..operators import messages as M
from ..operators import tracks as T
from ..schemas import POLYGON_COLUMNS, RADIUS_COLUMNS
from ..sources import adapters as A
from ..sources.tables import read
from .base import A1, A2, F3, plan, with_

KEY = "storm_id, ensemble_member, step"
TIME = "%Y-%m-%d %H:%M:%S"


def text(c: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


def tracks(spark, d):
    return T.transform(A.raw_tracks(spark, d), digits=6)


@plan("m1_flatten_messages", with_(A2) + f"select {KEY}, strftime(datetime, '{TIME}') as datetime, latitude, longitude, pressure, wind, wind_threshold, quadrant, bearing_start, wind_radius from raw_tracks")
def m1(spark, d):
    """Times are written once for each point, before its twelve rows."""
    out = M.radius_rows(M.message_points(A.messages(spark, d)).withColumn("datetime", text("datetime")))
    return out.select("storm_id", "ensemble_member", "step", "datetime", "latitude", "longitude", "pressure", "wind", "wind_threshold", "quadrant", "bearing_start", "wind_radius")


@plan("m2_per_member_or_scalar", "select vec_id, cast(embedding[1 + vec_id % 64] as double) as own, cast(embedding[1] as double) as shared from embeddings")
def m2(spark, d):
    e = read(spark, d, "embeddings")
    k = (F.col("vec_id") % 64).cast("int")
    one = F.slice("embedding", 1, 1)
    return e.select("vec_id", M.per_member_or_scalar(F.col("embedding"), F.lit(64), k).cast("double").alias("own"), M.per_member_or_scalar(one, F.lit(64), k).cast("double").alias("shared"))


@plan("m3_first_non_missing", "select l_orderkey, l_linenumber, case when l_partkey % 3 > 0 then l_partkey when l_suppkey % 2 > 0 then l_suppkey end as first_value from lineitem")
def m3(spark, d):
    a = F.array(F.when(F.col("l_partkey") % 3 > 0, F.col("l_partkey").cast("double")).otherwise(1e100), F.when(F.col("l_suppkey") % 2 > 0, F.col("l_suppkey").cast("double")))
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", M.first_non_missing(a).cast("long").alias("first_value"))


@plan("m4_radius_offset", "select vec_id, cast(case when vec_id % 100 < 64 then embedding[1 + vec_id % 100] end as double) as radius from embeddings")
def m4(spark, d):
    k = F.col("vec_id") % 100
    return read(spark, d, "embeddings").select("vec_id", M.radius_offset(F.col("embedding"), F.lit(0), F.floor(k / 12), F.lit(9), F.floor(k % 12 / 4), k % 4).cast("double").alias("radius"))


@plan("m5_null_sentinels", with_(A1) + f"select {KEY}, case when step % 12 <> 0 then pressure end as pressure, wind from track_points where ensemble_member % 10 <> 0")
def m5(spark, d):
    p = A.track_points(spark, d).withColumns({"latitude": F.when(F.col("ensemble_member") % 10 != 0, F.col("latitude")).otherwise(1e100), "pressure": F.when(F.col("step") % 12 != 0, F.col("pressure")).otherwise(-1e100)})
    return p.where(M.null_sentinel(F.col("latitude")).isNotNull()).select("storm_id", "ensemble_member", "step", M.null_sentinel(F.col("pressure")).alias("pressure"), "wind")


@plan("m6_valid_time", f"select o_orderkey, strftime(cast(o_orderdate as timestamp) + to_hours(cast(3 * (o_orderkey % 49) as int)), '{TIME}') as valid_time from orders")
def m6(spark, d):
    return read(spark, d, "orders").select("o_orderkey", M.valid_time(F.col("o_orderdate").cast("timestamp_ntz"), (3 * (F.col("o_orderkey") % 49)).cast("int")).alias("valid_time")).select("o_orderkey", text("valid_time"))


@plan("m7_drop_deterministic_member", with_(A1) + "select storm_id, ensemble_member + 1 as ensemble_member, step, wind from track_points where ensemble_member <> 51")
def m7(spark, d):
    return M.drop_deterministic_member(A.track_points(spark, d).withColumn("ensemble_member", F.col("ensemble_member") + 1)).select("storm_id", "ensemble_member", "step", "wind")


_ID = "case when c_custkey % 4 = 0 then right(c_name, 2) when c_custkey % 4 = 1 then concat(right(c_name, 2), 'L') when c_custkey % 4 = 2 then concat('  ', right(c_name, 4), ' ') else '   ' end"


def customers(spark, d):
    return read(spark, d, "customer").select("c_custkey", "c_name", F.expr(_ID).alias("storm"))


@plan("m8_named_storms", f"select * from (select c_custkey, {_ID} as storm from customer) where length(trim(storm)) > 2 and not regexp_matches(trim(storm), '^[0-9]{{2}}[A-Za-z]$')")
def m8(spark, d):
    return customers(spark, d).where(identity.is_named_storm(F.col("storm"))).select("c_custkey", "storm")


@plan("m9_storm_identity", f"select c_custkey, coalesce(nullif(trim({_ID}), ''), trim(c_name)) as storm_id from customer")
def m9(spark, d):
    return customers(spark, d).select("c_custkey", identity.storm_identity(F.col("c_name"), F.col("storm")).alias("storm_id"))


_RAW = "case when p_partkey % 5 = 0 then concat(' ', lower(p_brand), ' ') when p_partkey % 5 = 1 then replace(p_brand, '#', '-') when p_partkey % 5 = 2 then concat(replace(p_brand, '#', '-'), ' x') when p_partkey % 5 = 3 then lower(concat(' ', replace(p_brand, '#', ''))) else '  ' end"


@plan(
    "m10_normalize_identifier",
    f"select p_partkey, case when error is null then upper(trim(raw)) end as value, error from (select *, case when trim(raw) = '' then 'empty' when not regexp_matches(upper(trim(raw)), '^[A-Z0-9]+(-[A-Z0-9]+)*$') then 'bad pattern' end as error from (select p_partkey, {_RAW} as raw from part))",
)
def m10(spark, d):
    value, error = identity.normalize_identifier(F.expr(_RAW))
    return read(spark, d, "part").select("p_partkey", value.alias("value"), error.alias("error"))


@plan(
    "m11_episode_key",
    f"select p_partkey, p_size + 1980 as season, case when basin in ('AL', 'EP', 'CP') and p_size + 1980 between 2000 and 9999 and regexp_matches(upper(trim(raw)), '^[A-Z0-9]+(-[A-Z0-9]+)*$') then concat_ws('|', 'ecmwf', basin, p_size + 1980, upper(trim(raw))) end as episode from (select p_partkey, p_size, {_RAW} as raw, ['AL', 'EP', 'CP', 'WP'][1 + p_partkey % 4] as basin from part)",
)
def m11(spark, d):
    p = read(spark, d, "part").withColumns({"season": F.col("p_size") + 1980, "basin": F.element_at(F.array(*map(F.lit, ("AL", "EP", "CP", "WP"))), (1 + F.col("p_partkey") % 4).cast("int"))})
    key = identity.episode_key("ecmwf", F.col("basin"), F.col("season"), F.expr(_RAW))
    return p.select("p_partkey", "season", F.when(key.isNotNull(), F.concat_ws("|", key["producer"], key["basin"], key["season"].cast("string"), key["identifier"])).alias("episode"))


@plan("m12_run_info", with_(A2) + "select storm_id, '2024-07-01' as run_date, 0 as run_hour from track_points group by storm_id")
def m12(spark, d):
    return M.run_info(A.raw_tracks(spark, d), "storm_id").select("storm_id", "run_date", "run_hour")


@plan("t1_validate_tracks", with_(A2) + "select storm_id, count(*) as n_rows, count(latitude) as n_latitude, count(wlongitude) as n_wlongitude, count(*) > 0 as valid from raw_tracks group by storm_id")
def t1(spark, d):
    return T.validate_tracks(A.raw_tracks(spark, d)).select("storm_id", "n_rows", "n_latitude", "n_wlongitude", "valid")


@plan("t1_without_radii", with_(F3) + f"select track_id, ensemble_member, lead_time, strftime(forecast_time, '{TIME}') as forecast_time, latitude, longitude, pressure_hpa, wind_speed_knots, radius_of_maximum_winds_km, true as no_radii from tracks")
def t1_bare(spark, d):
    bare = A.track_points(spark, d).withColumns({"datetime": F.expr(f"{A.RUN} + make_dt_interval(0, step)"), "wlatitude": F.col("latitude") + 0.2, "wlongitude": F.col("longitude") - 0.3})
    radii = [*RADIUS_COLUMNS, *POLYGON_COLUMNS]
    out = T.transform(bare).withColumn("no_radii", F.forall(F.array(*[F.col(c).cast("string") for c in radii]), lambda x: x.isNull()))
    return out.select("track_id", "ensemble_member", "lead_time", text("forecast_time"), "latitude", "longitude", "pressure_hpa", "wind_speed_knots", "radius_of_maximum_winds_km", "no_radii")


@plan(
    "t2_forecast_time",
    with_(A2) + f"select storm_id, step, strftime(coalesce(min(case when step = 0 then datetime end) over (partition by storm_id), min(datetime - to_hours(step)) over (partition by storm_id)), '{TIME}') as forecast_time, count(*) as n from raw_tracks group by storm_id, step, datetime",
)
def t2(spark, d):
    """Times are written once for each group, not for each row."""
    raw = A.raw_tracks(spark, d)
    return T.with_forecast_time(raw).groupBy("storm_id", "step", "forecast_time").agg(F.count("*").alias("n")).select("storm_id", "step", text("forecast_time"), "n")


@plan("t3_distinct_points", with_(A2) + f"select distinct {KEY}, latitude, longitude, pressure, wind from raw_tracks")
def t3(spark, d):
    return T.distinct_points(A.raw_tracks(spark, d)).select("storm_id", "ensemble_member", "step", "latitude", "longitude", "pressure", "wind")


@plan("t4_drop_null_radii", with_(A2) + f"select {KEY}, wind_threshold, quadrant, wind_radius from raw_tracks where wind_radius is not null")
def t4(spark, d):
    return T.drop_null_radii(A.raw_tracks(spark, d)).select("storm_id", "ensemble_member", "step", "wind_threshold", "quadrant", "wind_radius")


_WIDE = ", ".join(f"max(case when wind_threshold = {ms} and quadrant = {q} then wind_radius / 1000 end) as radius_{kt}_knot_winds_{n}_km" for ms, kt in ((18, 34), (26, 50), (33, 64)) for q, n in ((1, "ne"), (2, "se"), (3, "sw"), (4, "nw")))


@plan("t5_radii_to_wide", with_(A2) + f"select {KEY}, {_WIDE} from raw_tracks group by {KEY}")
def t5(spark, d):
    return T.radii_to_wide(A.raw_tracks(spark, d))


@plan("t6_attach_radii", with_(A2) + f", wide as (select {KEY}, {_WIDE} from raw_tracks group by {KEY}) select p.storm_id, p.ensemble_member, p.step, p.latitude, w.radius_34_knot_winds_se_km, w.radius_64_knot_winds_nw_km from track_points p left join wide w on p.storm_id = w.storm_id and p.ensemble_member = w.ensemble_member and p.step = w.step")
def t6(spark, d):
    raw = A.raw_tracks(spark, d)
    out = T.attach_radii(A.track_points(spark, d), T.radii_to_wide(raw))
    return out.select("storm_id", "ensemble_member", "step", "latitude", "radius_34_knot_winds_se_km", "radius_64_knot_winds_nw_km")


@plan("t7_standard_names", with_(A1) + "select storm_id as track_id, ensemble_member, step as lead_time, pressure as pressure_hpa, wind as wind_speed_knots, latitude, longitude from track_points")
def t7(spark, d):
    return T.standard_names(A.track_points(spark, d)).select("track_id", "ensemble_member", "lead_time", "pressure_hpa", "wind_speed_knots", "latitude", "longitude")


@plan("t8_pressure_to_hpa", with_(A1) + f"select {KEY}, case when avg(p) over (partition by storm_id) > 10000 then p / 100 else p end as pressure from (select *, case when storm_id < 'STORM4' then pressure else pressure / 100 end as p from track_points)")
def t8(spark, d):
    p = A.track_points(spark, d).withColumn("pressure", F.when(F.col("storm_id") < "STORM4", F.col("pressure")).otherwise(F.col("pressure") / 100))
    return T.pressure_to_hpa(p, "storm_id", "pressure").select("storm_id", "ensemble_member", "step", "pressure")


@plan("t9_wind_to_knots", with_(A1) + f"select {KEY}, wind * 1.944e0 as knots from track_points")
def t9(spark, d):
    return T.wind_to_knots(A.track_points(spark, d), "wind").select("storm_id", "ensemble_member", "step", F.col("wind").alias("knots"))


@plan("t10_clear_impossible_radii", with_(F3) + f"select track_id, ensemble_member, lead_time, {', '.join(RADIUS_COLUMNS)} from tracks")
def t10(spark, d):
    return tracks(spark, d).select("track_id", "ensemble_member", "lead_time", *RADIUS_COLUMNS)


@plan("t11_radius_of_max_wind", with_(F3) + "select track_id, ensemble_member, lead_time, radius_of_maximum_winds_km from tracks")
def t11(spark, d):
    return tracks(spark, d).select("track_id", "ensemble_member", "lead_time", "radius_of_maximum_winds_km")


_BOX = """, boxes as (
  select *, longitude - greatest(sw, nw) * k as lon_min, longitude + greatest(ne, se) * k as lon_max, latitude - greatest(sw, se) / 111 as lat_min, latitude + greatest(ne, nw) / 111 as lat_max
  from (select *, 1 / (111 * cos(radians(latitude))) as k, coalesce(radius_34_knot_winds_ne_km, 0) as ne, coalesce(radius_34_knot_winds_se_km, 0) as se, coalesce(radius_34_knot_winds_sw_km, 0) as sw, coalesce(radius_34_knot_winds_nw_km, 0) as nw from tracks)
  where greatest(ne, se, sw, nw) > 0
)"""


@plan("t12_quadrant_box", with_(F3) + _BOX + " select track_id, ensemble_member, lead_time, lon_min, lat_min, lon_max, lat_max from boxes")
def t12(spark, d):
    box = geo.quadrant_box(F.col("latitude"), F.col("longitude"), *[F.col(f"radius_34_knot_winds_{q}_km") for q in ("ne", "se", "sw", "nw")])
    return tracks(spark, d).withColumn("b", box).where("b is not null").select("track_id", "ensemble_member", "lead_time", "b.lon_min", "b.lat_min", "b.lon_max", "b.lat_max")


_SPLIT = """, parts as (
  select track_id, ensemble_member, lead_time, lat_min, lat_max, unnest(case when lon_max > 180 then [0, 1] when lon_min < -180 then [2, 3] else [4] end) as part, lon_min as l, lon_max as h from boxes where not (lon_max > 180 and lon_min < -180)
), split as (
  select *, case part when 1 then -180 when 2 then -180 when 3 then l + 360 else l end as lon_min, case part when 0 then 180 when 1 then h - 360 when 3 then 180 else h end as lon_max from parts
)"""


@plan("t13_antimeridian_split", with_(F3) + _BOX + _SPLIT + " select track_id, ensemble_member, lead_time, lon_min, lat_min, lon_max, lat_max from split")
def t13(spark, d):
    out = tracks(spark, d).select("track_id", "ensemble_member", "lead_time", F.explode(T.radii_boxes(34)).alias("b"))
    return out.select("track_id", "ensemble_member", "lead_time", "b.lon_min", "b.lat_min", "b.lon_max", "b.lat_max")


@plan("t14_nudge_antimeridian", with_(F3) + _BOX + _SPLIT + ", x as (select track_id, ensemble_member, lead_time, unnest([lon_min, lon_max]) as x from split) select track_id, ensemble_member, lead_time, case when x <= -180 then -180 + 1e-7 when x >= 180 then 180 - 1e-7 else x end as lon from x")
def t14(spark, d):
    out = tracks(spark, d).select("track_id", "ensemble_member", "lead_time", F.explode(T.radii_boxes(34)).alias("b"))
    return out.select("track_id", "ensemble_member", "lead_time", F.explode(F.array("b.lon_min", "b.lon_max")).alias("x")).select("track_id", "ensemble_member", "lead_time", geo.nudge_antimeridian(F.col("x")).alias("lon"))


_N = lambda x: f"regexp_replace(regexp_replace(printf('%.6f', round({x}, 6)), '0+$', ''), '\\.$', '')"
_X = lambda x: _N(f"case when {x} <= -180 then -180 + 1e-7 when {x} >= 180 then 180 - 1e-7 else {x} end")
_RING = f"concat({_X('lon_min')}, ' ', {_N('lat_min')}, ', ', {_X('lon_max')}, ' ', {_N('lat_min')}, ', ', {_X('lon_max')}, ' ', {_N('lat_max')}, ', ', {_X('lon_min')}, ' ', {_N('lat_max')}, ', ', {_X('lon_min')}, ' ', {_N('lat_min')})"


_WKT = with_(F3) + _BOX + _SPLIT + f" select track_id, ensemble_member, lead_time, case when count(*) = 1 then concat('POLYGON ((', max({_RING}), '))') else concat('MULTIPOLYGON (((', string_agg({_RING}, ')), ((' order by part), ')))') end as wkt from split group by track_id, ensemble_member, lead_time"


@plan("t15_boxes_to_wkt", _WKT)
def t15(spark, d):
    return _polygons(spark, d, 34)


@plan("t15_boxes_to_wkt_50", _WKT.replace("coalesce(radius_34", "coalesce(radius_50"))
def t15_50(spark, d):
    return _polygons(spark, d, 50)


@plan("t15_boxes_to_wkt_64", _WKT.replace("coalesce(radius_34", "coalesce(radius_64"))
def t15_64(spark, d):
    return _polygons(spark, d, 64)


def _polygons(spark, d, kt):
    """Rows with a polygon are those with boxes: asked of the text, the filter would go below it and write each polygon twice."""
    return tracks(spark, d).where(T.radii_boxes(kt).isNotNull()).select("track_id", "ensemble_member", "lead_time", F.col(f"wind_field_polygon_{kt}kt").alias("wkt"))


@plan("t16_standard_tracks_schema", with_(F3) + f"select strftime(forecast_time, '{TIME}') as forecast_time, track_id, substr(track_id, 5, 12) as storm_identifier, track_id as long_storm_name, ensemble_member, strftime(valid_time, '{TIME}') as valid_time, lead_time, latitude, longitude, pressure_hpa, wind_speed_knots, radius_of_maximum_winds_km, {', '.join(RADIUS_COLUMNS)} from tracks")
def t16(spark, d):
    return tracks(spark, d).select(text("forecast_time"), "track_id", "storm_identifier", "long_storm_name", "ensemble_member", text("valid_time"), "lead_time", "latitude", "longitude", "pressure_hpa", "wind_speed_knots", "radius_of_maximum_winds_km", *RADIUS_COLUMNS)


@plan("t17_track_quality_summary", with_(F3) + f"select 12 * count(*) as rows_in, count(*) as rows_out, count(distinct track_id) as n_storms, count(distinct ensemble_member) as n_members, count(distinct lead_time) as n_leads, strftime(min(valid_time), '{TIME}') as first_time, strftime(max(valid_time), '{TIME}') as last_time, count(*) filter (pressure_hpa is null) as null_pressure_hpa from tracks")
def t17(spark, d):
    raw = A.raw_tracks(spark, d)
    out = T.quality_summary(raw, T.transform(raw))
    return out.select("rows_in", "rows_out", "n_storms", "n_members", "n_leads", text("first_time"), text("last_time"), "null_pressure_hpa")
