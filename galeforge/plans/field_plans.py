"""Queries of envelopes and rain."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import contours as N
from ..operators import envelopes as E
from ..operators import rain as P
from ..schemas import GUST_THRESHOLDS, WIND_THRESHOLDS
from ..sources import adapters as A
from ..sources.tables import read
from .base import A1, A3, A7, plan, with_
from .track_plans import TIME, text

NODE = "member, step, r, c"
FT = "strptime(regexp_extract(file_name, '_ens_([0-9-]+)_r', 1), '%Y-%m-%d')"
LEAD = "cast(regexp_extract(file_name, '_f([0-9]{3})h_', 1) as int)"


def values_sql(th: dict) -> str:
    return ", ".join(f"({k}, {v}e0)" for k, v in th.items())


CELLS = f"cells as (select g.*, t.threshold from grid_field g cross join (values {values_sql(WIND_THRESHOLDS)}) as t(threshold, v) where g.value > t.v)"
GUSTS = f"gusts as (select g.*, t.threshold from grid_field g cross join (values {values_sql(GUST_THRESHOLDS)}) as t(threshold, v) where g.value * 0.6e0 > t.v)"
ACC = "acc as (select member, step, r, c, lat, lon, max(value) over (partition by member, r, c order by step rows unbounded preceding) as value from grid_field)"


def cells(spark, d):
    return E.threshold_cells(A.grid_field(spark, d), WIND_THRESHOLDS)


def gusts(spark, d):
    return E.threshold_cells(A.grid_field(spark, d).withColumn("value", F.col("value") * 0.6), GUST_THRESHOLDS)


def acc(spark, d):
    from pyspark.sql import Window as W

    f = A.grid_field(spark, d)
    return f.withColumn("value", F.max("value").over(W.partitionBy("member", "r", "c").orderBy("step").rowsBetween(W.unboundedPreceding, 0)))


@plan("e1_wind_speed", with_(A3) + f"select {NODE}, sqrt(value * value + (0.5e0 * value + member) * (0.5e0 * value + member)) as speed from grid_field")
def e1(spark, d):
    f = A.grid_field(spark, d)
    long = f.select("member", "step", "r", "c", F.explode(F.array(F.struct(F.lit("u10").alias("param"), "value"), F.struct(F.lit("v10").alias("param"), (0.5 * F.col("value") + F.col("member")).alias("value")))).alias("p")).select("member", "step", "r", "c", "p.*")
    return E.wind_speed(long, ["member", "step", "r", "c"])


@plan("e2_gust_param", with_(A7) + f"select file_id, lead, case when lead > 90 then '10fg3' else '10fg' end as param from (select file_id, {LEAD} as lead from field_files where file_name like 'gust%') where lead <> 0")
def e2(spark, d):
    f = A.field_files(spark, d).where("file_name like 'gust%'").withColumn("lead", F.regexp_extract("file_name", "_f([0-9]{3})h_", 1).cast("int"))
    return f.select("file_id", "lead", E.gust_param(F.col("lead")).alias("param")).where("param is not null")


@plan(
    "e3_unwrap_longitude",
    with_(A1) + """, x as (select *, longitude - lag(longitude) over (partition by storm_id, ensemble_member order by step) as d from track_points),
    y as (select *, (d + 180) - 360 * floor((d + 180) / 360) - 180 as m from x),
    z as (select *, case when d is null or abs(d) < 180 then 0 else (case when m = -180 and d > 0 then 180 else m end) - d end as t from y)
    select storm_id, ensemble_member, step, longitude + sum(t) over (partition by storm_id, ensemble_member order by step rows unbounded preceding) as unwrapped from z""",
)
def e3(spark, d):
    return E.unwrap_longitude(A.track_points(spark, d), ["storm_id", "ensemble_member"], "step").select("storm_id", "ensemble_member", "step", "unwrapped")


_NEAR = "case when 170 + (longitude + 180) / 18 > 180 then 170 + (longitude + 180) / 18 - 360 else 170 + (longitude + 180) / 18 end"


@plan(
    "e4_reconcile_longitudes",
    with_(A1) + f""", p as (select *, {_NEAR} as x from track_points where storm_id <> 'STORM1' union all select *, longitude as x from track_points where storm_id = 'STORM1'),
    u as (select distinct storm_id, x from p), g as (select *, lead(x) over (partition by storm_id order by x) as nx from u),
    w as (select storm_id, min(x) as lo, max(x) as hi from u group by storm_id),
    b as (select * from (select *, row_number() over (partition by storm_id order by nx - x desc, x) as k from g where nx is not null) where k = 1),
    c as (select w.storm_id, case when b.nx - b.x > lo + 360 - hi and b.x + 360 - b.nx <= 90 then b.x end as cut from w left join b on w.storm_id = b.storm_id)
    select p.storm_id, ensemble_member, step, case when x <= cut then x + 360 else x end as reconciled from p join c on p.storm_id = c.storm_id""",
)
def e4(spark, d):
    near = 170 + (F.col("longitude") + 180) / 18
    x = F.when(F.col("storm_id") == "STORM1", F.col("longitude")).when(near > 180, near - 360).otherwise(near)
    return E.reconcile_longitudes(A.track_points(spark, d).withColumn("longitude", x), "storm_id").select("storm_id", "ensemble_member", "step", "reconciled")


_R = "(500 / 111e0 + 500 / (111e0 * cos(radians(latitude)))) / 2"
_BOXES = f"boxes as (select storm_id, min(longitude - {_R}) - 2 as lon_min, max(longitude + {_R}) + 2 as lon_max, min(latitude - {_R}) - 2 as lat_min, max(latitude + {_R}) + 2 as lat_max from track_points group by storm_id)"


def boxes(spark, d):
    return E.track_search_box(A.track_points(spark, d), "storm_id", 500, 2.0)


@plan("e5_track_search_box", with_(A1, _BOXES) + "select * from boxes")
def e5(spark, d):
    return boxes(spark, d)


_WINDOWS = """shifted as (select storm_id, lat_min, lat_max, lon_min * 1.0 as a, lon_max * 1.0 as b from boxes),
windows as (select storm_id, lat_min, lat_max, w as "window",
  case when b > 180 and a < -180 then -180 when b > 180 then case w when 0 then greatest(a, -180) else -180 end when a < -180 then case w when 0 then a + 360 else -180 end else a end as lon_min,
  case when b > 180 and a < -180 then 180 when b > 180 then case w when 0 then 180 else b - 360 end when a < -180 then case w when 0 then 180 else least(b, 180) end else b end as lon_max
  from (select *, unnest(case when (b > 180) <> (a < -180) then [0, 1] else [0] end) as w from shifted))"""


@plan("e6_longitude_windows", with_(A1, _BOXES, _WINDOWS) + 'select storm_id, "window", lon_min, lon_max from windows')
def e6(spark, d):
    return E.longitude_windows(boxes(spark, d)).select("storm_id", "window", "lon_min", "lon_max")


@plan("e7_crop_grid", with_(A1, A3, _BOXES, _WINDOWS) + 'select storm_id, "window", member, step, r, c, value from grid_field join windows on lat between lat_min and lat_max and lon between lon_min and lon_max')
def e7(spark, d):
    return E.crop_grid(A.grid_field(spark, d), E.longitude_windows(boxes(spark, d))).select("storm_id", "window", "member", "step", "r", "c", "value")


@plan("e8_control_as_51", with_(A3) + "select case when number is null or number = 0 then 51 else number end as member, step, count(*) as n from (select case member when 5 then 0 when 4 then null else member end as number, step from grid_field) group by 1, 2")
def e8(spark, d):
    number = F.when(F.col("member") == 5, 0).when(F.col("member") == 4, None).otherwise(F.col("member"))
    return A.grid_field(spark, d).groupBy(E.control_as_51(number).alias("member"), "step").agg(F.count("*").alias("n"))


@plan("e9_threshold_cells", with_(A3, CELLS) + f"select {NODE}, threshold from cells")
def e9(spark, d):
    return cells(spark, d).select("member", "step", "r", "c", "threshold")


@plan(
    "e10_contour_crossings",
    with_(A3) + f""", e as (
      select a.member, a.step, a.lat, a.lon, a.value, b.lat as lat2, b.lon as lon2, b.value as v2 from grid_field a join grid_field b
      on a.member = b.member and a.step = b.step and ((a.r = b.r and b.c = a.c + 1) or (a.c = b.c and b.r = a.r + 1)))
    select member, step, threshold, lat + (v - value) / (v2 - value) * (lat2 - lat) as lat, lon + (v - value) / (v2 - value) * (lon2 - lon) as lon
    from e cross join (values {values_sql(WIND_THRESHOLDS)}) as t(threshold, v) where (value > v) <> (v2 > v)""",
)
def e10(spark, d):
    return E.contour_crossings(A.grid_field(spark, d), ["member", "step"], WIND_THRESHOLDS)


RING_KEYS, RING_THRESHOLDS = ["member", "step"], {k: v for k, v in WIND_THRESHOLDS.items() if k in (34, 64, 113)}
#: Squares by their corners, the sixteen ways a line crosses one (two of them by the mean of the corners), and walks from each ring's least crossing.
_SQUARES = f"""sq as (select distinct member, step, r - a as r, c - b as c from grid_field cross join (values (0), (1)) as x(a) cross join (values (0), (1)) as y(b)),
  corners as (select sq.*, p.value as v0, p.lat as y0, p.lon as x0, q.value as v1, q.lat as y1, q.lon as x1, s.value as v2, s.lat as y2, s.lon as x2, u.value as v3, u.lat as y3, u.lon as x3 from sq
    left join grid_field p on p.member = sq.member and p.step = sq.step and p.r = sq.r and p.c = sq.c left join grid_field q on q.member = sq.member and q.step = sq.step and q.r = sq.r and q.c = sq.c + 1
    left join grid_field s on s.member = sq.member and s.step = sq.step and s.r = sq.r + 1 and s.c = sq.c + 1 left join grid_field u on u.member = sq.member and u.step = sq.step and u.r = sq.r + 1 and u.c = sq.c),
  ways(code, joined, a, b) as (values (1, 0, 3, 0), (2, 0, 0, 1), (3, 0, 3, 1), (4, 0, 1, 2), (5, 0, 3, 0), (5, 0, 1, 2), (5, 1, 1, 0), (5, 1, 3, 2), (6, 0, 0, 2), (7, 0, 3, 2), (8, 0, 2, 3), (9, 0, 2, 0), (10, 0, 0, 1), (10, 0, 2, 3), (10, 1, 0, 3), (10, 1, 2, 1), (11, 0, 2, 1), (12, 0, 1, 3), (13, 0, 1, 0), (14, 0, 0, 3)),
  coded as (select *, case when code in (5, 10) and (v0 + v1 + v2 + v3) / 4 > t then 1 else 0 end as joined from (select *, cast(coalesce(v0 > t, false) as int) + 2 * cast(coalesce(v1 > t, false) as int) + 4 * cast(coalesce(v2 > t, false) as int) + 8 * cast(coalesce(v3 > t, false) as int) as code
    from corners cross join (values {values_sql(RING_THRESHOLDS)}) as th(threshold, t)) where code between 1 and 14 or code = 15 and (v0 is null or v1 is null or v2 is null or v3 is null)),
  placed as (select member, step, threshold, code, joined, e, (r + (e = 2)::int + 1) * 8589934592 + (c + (e = 1)::int + 1) * 2 + (e % 2) as v,
    case when va is null then yb when vb is null then ya else ya + (t - va) / (vb - va) * (yb - ya) end as lat, case when va is null then xb when vb is null then xa else xa + (t - va) / (vb - va) * (xb - xa) end as lon, r, c
    from (select *, [v0, v1, v3, v0][e + 1] as va, [v1, v2, v2, v3][e + 1] as vb, [y0, y1, y3, y0][e + 1] as ya, [y1, y2, y2, y3][e + 1] as yb, [x0, x1, x3, x0][e + 1] as xa, [x1, x2, x2, x3][e + 1] as xb from coded cross join (values (0), (1), (2), (3)) as ed(e))),
  seg as (select p.member, p.step, p.threshold, p.v as a, q.v as b, p.lat, p.lon, q.lat as lat2, q.lon as lon2 from placed p join ways w on w.code = p.code and w.joined = p.joined and w.a = p.e join placed q on q.member = p.member and q.step = p.step and q.threshold = p.threshold and q.r = p.r and q.c = p.c and q.e = w.b)"""
_RINGS = """walk(member, step, threshold, ring, here, n_points, area, lon_min, lon_max, lat_min, lat_max) as (
    select member, step, threshold, a, b, 1, (lon * lat2 - lon2 * lat) / 2, lon, lon, lat, lat from seg
    union all select w.member, w.step, w.threshold, w.ring, s.b, w.n_points + 1, w.area + (s.lon * s.lat2 - s.lon2 * s.lat) / 2, least(w.lon_min, s.lon), greatest(w.lon_max, s.lon), least(w.lat_min, s.lat), greatest(w.lat_max, s.lat)
    from walk w join seg s on s.member = w.member and s.step = w.step and s.threshold = w.threshold and s.a = w.here where w.here > w.ring),
  found as (select *, area < 0 as hole from walk where here = ring)"""


def field_rings(spark, d):
    return N.field_rings(A.grid_field(spark, d), RING_KEYS, RING_THRESHOLDS, read(spark, d, "lineitem").count())


@plan("e10_contour_rings", with_(A3, _SQUARES, _RINGS, recursive=True) + "select member, step, threshold, ring, cast(n_points as bigint) as n_points, round(area, 6) as area, hole, lon_min, lon_max, lat_min, lat_max from found")
def e10_rings(spark, d):
    return field_rings(spark, d).withColumn("area", F.round("area", 6))


@plan(
    "e14_ring_envelopes",
    with_(A3, _SQUARES, _RINGS, recursive=True) + "select member, step, threshold, count(*) filter (where not hole) as n_outer, count(*) filter (where hole) as n_holes, round(sum(area) * 11544, 3) as area_km2, min(lon_min) as lon_min, max(lon_max) as lon_max, min(lat_min) as lat_min, max(lat_max) as lat_max from found group by member, step, threshold",
)
def e14_rings(spark, d):
    return N.ring_envelopes(field_rings(spark, d), RING_KEYS).withColumn("area_km2", F.round("area_km2", 3))


@plan("e11_merge_windows", with_(A3, CELLS) + f"select distinct {NODE}, threshold from cells where c <= 12 or c >= 8")
def e11(spark, d):
    x = cells(spark, d)
    return E.merge_windows([x.where("c <= 12"), x.where("c >= 8")], ["member", "step", "threshold"]).select("member", "step", "r", "c", "threshold")


@plan("e12_synth_rows", with_(A3) + f"select lead_time, ensemble_member, strftime(timestamp '2024-07-01' + to_hours(lead_time), '{TIME}') as valid_time from (select distinct step as lead_time from grid_field) cross join (select distinct member as ensemble_member from grid_field)")
def e12(spark, d):
    f = A.grid_field(spark, d)
    return E.synth_rows(f.select(F.col("step").alias("lead_time")), f.select(F.col("member").alias("ensemble_member")), F.expr(A.RUN)).select("lead_time", "ensemble_member", text("valid_time"))


@plan("e13_resolve_run_time", with_(A1) + f"select storm_id, case when storm_id < 'STORM4' then '2024-06-30 12:00:00' else '2024-07-01 00:00:00' end as run_time from track_points group by storm_id")
def e13(spark, d):
    p = A.raw_tracks(spark, d).withColumnsRenamed({"datetime": "valid_time", "step": "lead_time"})
    p = p.withColumn("forecast_time", F.when((F.col("storm_id") < "STORM4") & (F.col("ensemble_member") > 20), F.expr("timestamp_ntz'2024-06-30 12:00:00'")))
    return E.resolve_run_time(p, "storm_id").select("storm_id", text("run_time"))


_ENV = "count(*) as n_cells, count(*) * (0.25e0 * 0.25e0 * 111 * 104) as area_km2, min(lon) - 0.125e0 as lon_min, max(lon) + 0.125e0 as lon_max, min(lat) - 0.125e0 as lat_min, max(lat) + 0.125e0 as lat_max"


_RUNS = """i as (select *, c - row_number() over (partition by member, step, threshold, r order by c) as i from cells),
  runs as (select member, step, threshold, r, min(c) as c0, max(c) as c1 from i group by member, step, threshold, r, i),
  grown(member, step, threshold, r0, r, c0, c1) as (
    select member, step, threshold, r, r, c0, c1 from runs x where not exists (select 1 from runs y where y.member = x.member and y.step = x.step and y.threshold = x.threshold and y.r = x.r - 1 and y.c0 = x.c0 and y.c1 = x.c1)
    union all select g.member, g.step, g.threshold, g.r0, y.r, g.c0, g.c1 from grown g join runs y on y.member = g.member and y.step = g.step and y.threshold = g.threshold and y.r = g.r + 1 and y.c0 = g.c0 and y.c1 = g.c1),
  boxes as (select member, step, threshold, r0, max(r) as r1, c0, c1 from grown group by member, step, threshold, r0, c0, c1)"""


@plan("e14_region_boxes", with_(A3, CELLS, _RUNS, recursive=True) + "select * from boxes")
def e14_boxes(spark, d):
    return E.region_boxes(cells(spark, d), ["member", "step", "threshold"]).select("member", "step", "threshold", "r0", "r1", "c0", "c1")


@plan("e14_region_texts", with_(A3, CELLS, _RUNS, recursive=True) + ", numbered as (select *, row_number() over (partition by member, step, threshold order by r0, c0) - 1 as k from boxes) select member, step, threshold, cast(k // 20 as int) as part, count(*) as n_polygons from numbered group by member, step, threshold, k // 20")
def e14_texts(spark, d):
    out = E.region_texts(E.region_boxes(cells(spark, d), ["member", "step", "threshold"]), ["member", "step", "threshold"], 20)
    return out.withColumn("n_polygons", F.regexp_count("region", F.lit("POLYGON")).cast("long")).drop("region")


@plan("e14_individual_envelopes", with_(A3, CELLS, _RUNS, recursive=True) + f""", n as (select member, step, threshold, count(*) as n_boxes from boxes group by 1, 2, 3)
  select * from (select member, step, threshold, {_ENV} from cells group by member, step, threshold) join n using (member, step, threshold)""")
def e14(spark, d):
    return E.individual_envelopes(cells(spark, d), ["member", "step", "threshold"]).drop("region")


@plan("e15_combined_envelopes", with_(A3, CELLS) + f"select member, threshold, {_ENV}, any_value(lead_range) as lead_range from (select distinct member, threshold, r, c, lat, lon, concat(min(step) over (partition by member, threshold), '-', max(step) over (partition by member, threshold)) as lead_range from cells) group by member, threshold")
def e15(spark, d):
    return E.combined_envelopes(cells(spark, d), ["member", "threshold"]).drop("region", "n_boxes")


@plan("e16_region_area", with_(A3, CELLS) + "select member, step, threshold, count(*) * (0.25e0 * 0.25e0 * 111 * 104) as area_km2 from cells group by member, step, threshold")
def e16(spark, d):
    return cells(spark, d).groupBy("member", "step", "threshold").agg(E.region_area(F.count("*")).alias("area_km2"))


@plan("e17_required_hours", with_(A1) + "select hours, unnest(range(3, hours + 1, 3)) as lead_time from (select cast(coalesce(least(ceil(max(step) / 6e0) * 6 + 12, 144), 144) as int) as hours from track_points)")
def e17(spark, d):
    return E.required_hours(A.track_points(spark, d), first=3, column="step")


@plan("e18_cap_members", with_(A1) + "select storm_id, ensemble_member, step from (select *, dense_rank() over (partition by storm_id order by ensemble_member) as k from track_points) where k <= 7")
def e18(spark, d):
    return E.cap_members(A.track_points(spark, d), 7, "storm_id").select("storm_id", "ensemble_member", "step")


@plan("e19_member_completeness", with_(A1) + "select storm_id, step, count(distinct ensemble_member) as present, 51 as expected, greatest(51 - count(distinct ensemble_member), 0) as missing from track_points group by storm_id, step")
def e19(spark, d):
    return E.member_completeness(A.track_points(spark, d), ["storm_id", "step"], 51)


@plan("e20_best_comparison_member", with_(A3, CELLS, GUSTS) + "select member, count(distinct step) as n_leads from cells where threshold = 34 and member in (select member from gusts where threshold = 17) group by member order by n_leads desc, member limit 1")
def e20(spark, d):
    return E.best_comparison_member(cells(spark, d), gusts(spark, d))


@plan("e21_wind_gust_overlap", with_(A3, CELLS, GUSTS) + "select member, step from (select *, row_number() over (partition by member order by step desc) as k from (select distinct member, step from cells where threshold = 83 intersect select distinct member, step from gusts where threshold = 43)) where k <= 3")
def e21(spark, d):
    return E.wind_gust_overlap(cells(spark, d).where("threshold = 83"), gusts(spark, d).where("threshold = 43"), 3)


@plan("e21_member_fallback", with_(A3, CELLS, GUSTS) + ", w as (select distinct member, step from cells where threshold = 83), g as (select distinct member, step from gusts where threshold = 43), m as (select min(member) as member from w where member in (select member from g)) select member, step from (select *, row_number() over (order by step desc) as k from (select * from w intersect select * from g) where member = (select member from m)) where k <= 3")
def e21_fallback(spark, d):
    return E.wind_gust_overlap(cells(spark, d).where("threshold = 83"), gusts(spark, d).where("threshold = 43"), 3, member=77)  # in neither, so the lowest that is in both


@plan("e22_grid_descriptor", with_(A3) + "select member, min(lon) - 0.125e0 as west, min(lat) - 0.125e0 as south, max(lon) + 0.125e0 as east, max(lat) + 0.125e0 as north, count(distinct lat) as height, count(distinct lon) as width, true as north_up from grid_field group by member")
def e22(spark, d):
    return E.grid_descriptor(A.grid_field(spark, d), ["member"])


PERIODS = [(3, 9), (9, 15), (3, 21)]
_AMOUNTS = "amounts as (select a.member, a.r, a.c, p.s as start_h, p.e as end_h, b.value - a.value as amount from (values (3, 9), (9, 15), (3, 21)) as p(s, e) join (select distinct member, r, c from acc where step in (3, 9, 15, 21)) k on true left join acc a on a.step = p.s and a.member = k.member and a.r = k.r and a.c = k.c left join acc b on b.step = p.e and b.member = k.member and b.r = k.r and b.c = k.c)".replace("select a.member, a.r, a.c", "select k.member, k.r, k.c")


def amounts(spark, d):
    return P.period_accumulation(acc(spark, d), PERIODS)


@plan("p1_met_to_mm", with_(A3) + f"select {NODE}, value * 1000 as value from grid_field where lat + 42 between -60 and 60")
def p1(spark, d):
    return P.met_to_mm(A.grid_field(spark, d).withColumn("lat", F.col("lat") + 42)).select("member", "step", "r", "c", "value")


@plan("p2_stack_members", with_(A3) + ", k as (select distinct step, r, c from grid_field), m as (select unnest([1, 2, 3, 4, 51]) as member) select m.member, k.step, k.r, k.c, g.value from k cross join m left join grid_field g on g.step = k.step and g.r = k.r and g.c = k.c and (case g.member when 5 then 51 else g.member end) = m.member")
def p2(spark, d):
    f = A.grid_field(spark, d)
    return P.stack_members(f.where("member < 5"), f.where("member = 5"), 4)


@plan("p3_grid_match", with_(A3) + "select count(*) filter (a and b) as matched, count(*) filter (b is null) as only_first, count(*) filter (a is null) as only_second from (select distinct round(lat, 4) as lat, round(lon, 4) as lon, true as a from grid_field where (r + c) % 3 < 2) full join (select distinct round(lat + 1e-6, 4) as lat, round(lon, 4) as lon, true as b from grid_field where (r + c) % 3 > 0) using (lat, lon)")
def p3(spark, d):
    f = A.grid_field(spark, d)
    return P.grid_match(f.where("(r + c) % 3 < 2"), f.where("(r + c) % 3 > 0").withColumn("lat", F.col("lat") + 1e-6))


@plan("p4_period_accumulation", with_(A3, ACC, _AMOUNTS) + "select * from amounts")
def p4(spark, d):
    return amounts(spark, d)


@plan("p5_ensemble_mean_at", with_(A3) + "select r, c, case when count(v) = count(*) then avg(v) end as mean from (select r, c, case when member = 3 and r = c then null else value end as v from grid_field where step = 9) group by r, c")
def p5(spark, d):
    f = A.grid_field(spark, d).withColumn("value", F.when((F.col("member") == 3) & (F.col("r") == F.col("c")), None).otherwise(F.col("value")))
    return P.ensemble_mean_at(f, 9)


@plan("p4_step_accumulation", with_(A3, ACC) + "select member, step, r, c, value - lag(value) over (partition by member, r, c order by step) as amount from acc")
def p4_steps(spark, d):
    return P.step_accumulation(acc(spark, d)).select("member", "step", "r", "c", "amount")


@plan("p6_period_maximum", with_(A3, ACC, _AMOUNTS) + "select start_h, end_h, max(mean) as period_max from (select r, c, start_h, end_h, case when count(amount) = count(*) then avg(amount) end as mean from amounts group by r, c, start_h, end_h) group by start_h, end_h")
def p6_maximum(spark, d):
    return P.period_maximum(amounts(spark, d))


@plan("p6_period_mean", with_(A3, ACC, _AMOUNTS) + "select *, max(mean) over (partition by start_h, end_h) as period_max from (select r, c, start_h, end_h, case when count(amount) = count(*) then avg(amount) end as mean from amounts group by r, c, start_h, end_h)")
def p6(spark, d):
    return P.period_mean(amounts(spark, d))


@plan("p7_exceedance_pct", with_(A3, ACC, _AMOUNTS) + "select r, c, start_h, 100e0 * count(*) filter (amount > 12) / count(*) as pct, 100e0 * count(*) filter (amount > 12) / count(*) > 50 as likely from amounts where end_h - start_h = 6 group by r, c, start_h")
def p7(spark, d):
    out = P.exceedance_pct(amounts(spark, d).where("end_h - start_h = 6"), 12.0, ("r", "c", "start_h"), "amount")
    return out.withColumn("likely", F.col("pct") > 50)


@plan("p8_crop_to_bounds", with_(A1, A3) + f"select {NODE}, value from grid_field, (select min(latitude) - 0.5 as s, max(latitude) + 0.5 as n, min(longitude) - 0.5 as w, max(longitude) + 0.5 as e from track_points where latitude between 12 and 22 and longitude between -75 and -45) where lat between s and n and lon between w and e")
def p8(spark, d):
    near = A.track_points(spark, d).where("latitude between 12 and 22 and longitude between -75 and -45")
    return P.crop_to_bounds(A.grid_field(spark, d), near, 0.5).select("member", "step", "r", "c", "value")


@plan("p9_map_p99", with_(A3) + "select step, greatest(quantile_cont(value, 0.99), 1) as p99 from grid_field group by step")
def p9(spark, d):
    return P.map_p99(A.grid_field(spark, d), "value", ["step"])


@plan("p9_exact_percentile", with_(A3) + "select step, member, round(quantile_cont(value * 0.7e0 + r * 0.013e0 + c * 0.00017e0, 0.99), 4) as percentile from grid_field group by step, member")
def p9_exact(spark, d):
    f = A.grid_field(spark, d).withColumn("value", F.col("value") * 0.7 + F.col("r") * 0.013 + F.col("c") * 0.00017)
    return P.exact_percentile(f, "value", 0.99, ["step", "member"]).withColumn("percentile", F.round("percentile", 4))


@plan("p10_accumulation_monotonic", with_(A3) + "select member, r, c, bool_and(ok) as monotonic from (select member, r, c, coalesce(value >= lag(value) over (partition by member, r, c order by step) - 0.01, true) as ok from grid_field) group by member, r, c")
def p10(spark, d):
    return P.accumulation_monotonic(A.grid_field(spark, d))


@plan("p11_tracks_in_period", with_(A1) + "select storm_id, ensemble_member, step as lead_time, s as start_h, e as end_h from track_points join (values (3, 9), (9, 15), (3, 21)) as p(s, e) on step between s and e")
def p11(spark, d):
    t = A.track_points(spark, d).select("storm_id", "ensemble_member", F.col("step").alias("lead_time"))
    return P.tracks_in_period(t, PERIODS)


@plan("p12_step_lookup", with_(A3) + "select member, r, c, value from grid_field where step = 12")
def p12(spark, d):
    return P.step_lookup(A.grid_field(spark, d), 12).select("member", "r", "c", "value")
