"""The register of queries, and the hazard tables in DuckDB's SQL."""

from __future__ import annotations

QUERIES: dict = {}
SQL: dict[str, str] = {}


def plan(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return keep


A1 = """track_points as (
  select concat('STORM', l_suppkey) as storm_id, cast(1 + l_partkey % 51 as int) as ensemble_member, cast(6 * (l_orderkey % 41) as int) as step,
    min(((l_suppkey * 137) % 4500) / 1e2 - 25e0 + 2e-2 * (6 * (l_orderkey % 41)) + 1e-2 * (l_partkey % 51)) as latitude, min(case when ((l_suppkey * 3571) % 36000) / 1e2 - 180e0 + 15e-2 * (6 * (l_orderkey % 41)) + 2e-2 * (l_partkey % 51) >= 180 then ((l_suppkey * 3571) % 36000) / 1e2 - 180e0 + 15e-2 * (6 * (l_orderkey % 41)) + 2e-2 * (l_partkey % 51) - 360 else ((l_suppkey * 3571) % 36000) / 1e2 - 180e0 + 15e-2 * (6 * (l_orderkey % 41)) + 2e-2 * (l_partkey % 51) end) as longitude,
    cast(100000e0 - 200e0 * min(l_quantity) as double) as pressure, cast(15e-1 * min(l_quantity) as double) as wind from lineitem group by 1, 2, 3)"""
A2 = A1 + """, raw_tracks as (
  select p.*, substr(storm_id, 5, 12) as storm_identifier, storm_id as long_storm_name, timestamp '2024-07-01 00:00:00' + to_hours(step) as datetime,
    latitude + 0.2 as wlatitude, longitude - 0.3 as wlongitude, t.thr as wind_threshold, q.quad as quadrant, (quad - 1) * 90e0 as bearing_start, quad * 90e0 as bearing_end,
    case when (p.ensemble_member + q.quad) % 7 = 0 then null else p.wind * 1e3 + t.thr * 5e2 + q.quad * 25e2 end as wind_radius
  from track_points p cross join (values (18), (26), (33)) as t(thr) cross join (values (1), (2), (3), (4)) as q(quad))"""
A3 = """grid_field as (
  select *, 20e0 - 0.25e0 * r as lat, -60e0 + 0.25e0 * c as lon from (
  select cast(l_orderkey % 20 as int) as r, cast(floor(l_partkey / 10e0) as int) as c, cast(1 + l_suppkey % 5 as int) as member,
    cast(3 * l_linenumber as int) as step, cast(15e-1 * min(l_quantity) as double) as value from lineitem group by 1, 2, 3, 4))"""
A4 = """discharge as (
  select e.vec_id as cell_id, a.m as member, 24 * b.s as step_h, 6e1 - 5e-2 + 25e-3 - 5e-2 * ((e.vec_id * 37) % 2400) as cell_lat,
    25e-3 - 18e1 + 5e-2 * ((e.vec_id * 101) % 7200) as cell_lon, 1e2 + 4e2 * cast(list_extract(e.embedding, cast(1 + (a.m * 7 + b.s) % 64 as int)) as double) as value
  from embeddings e cross join range(1, 52) as a(m) cross join range(1, 8) as b(s))"""
A5 = """cell_thresholds as (
  select e.vec_id as cell_id, t.rp, case when e.vec_id % 11 = 0 then -1e0 else t.base + 2e0 * e.label end as threshold
  from embeddings e cross join (values (2, 120e0), (5, 140e0), (10, 160e0), (20, 180e0), (50, 200e0), (100, 220e0)) as t(rp, base))"""
A6 = """pixels as (
  select e.vec_id as cell_id, e.vec_id * 16 + p.k as pixel_id,
    6e1 - 5e-2 + 25e-3 - 5e-2 * ((e.vec_id * 37) % 2400) + 125e-4 * (floor(p.k / 4e0) - 15e-1) as pixel_lat,
    25e-3 - 18e1 + 5e-2 * ((e.vec_id * 101) % 7200) + 125e-4 * (p.k % 4 - 15e-1) as pixel_lon, ((e.vec_id * 5 + p.k * 3) % 7) / 1e1 as depth,
    case when (e.vec_id + p.k) % 9 = 0 then 1 else 0 end as water from embeddings e cross join range(0, 16) as p(k))"""
A7 = """field_files as (
  select concat(case when o_custkey % 2 = 0 then 'wind' else 'gust' end, '_ens_', substring(cast(o_orderdate as varchar), 1, 10), '_r',
    lpad(cast(6 * (o_orderkey % 4) as varchar), 2, '0'), '_f', lpad(cast(3 * (o_orderkey % 49) as varchar), 3, '0'),
    case when o_custkey % 3 = 0 then 'h_cf' else 'h_pf' end, '.grib2') as file_name, o_orderkey as file_id from orders)"""
#: Transformed tracks, up to the polygons.
F3 = (
    A1
    + """, t0 as (
  select storm_id as track_id, ensemble_member, step as lead_time, latitude, longitude, pressure, wind * 1.944e0 as wind_speed_knots, wind,
    latitude + 0.2 as wlat, longitude - 0.3 as wlon, timestamp '2024-07-01 00:00:00' + to_hours(step) as valid_time,
    case when avg(pressure) over (partition by storm_id) > 10000 then pressure / 100 else pressure end as pressure_hpa,
    min(case when step = 0 then timestamp '2024-07-01 00:00:00' end) over (partition by storm_id) as ft0 from track_points
), tracks as (
  select *, coalesce(ft0, timestamp '2024-07-01 00:00:00') as forecast_time, """
    + ", ".join(
        f"case when wind_speed_knots < {kt} then 0e0 when (ensemble_member + {q}) % 7 = 0 then null else (wind * 1e3 + {ms} * 5e2 + {q} * 25e2) / 1000 end as radius_{kt}_knot_winds_{name}_km"
        for ms, kt in ((18, 34), (26, 50), (33, 64))
        for q, name in ((1, "ne"), (2, "se"), (3, "sw"), (4, "nw"))
    )
    + """,
    2 * 6371 * atan2(sqrt(h), sqrt(1 - h)) as radius_of_maximum_winds_km
  from (select *, pow(sin(radians(wlat - latitude) / 2), 2) + cos(radians(latitude)) * cos(radians(wlat)) * pow(sin(radians(wlon - longitude) / 2), 2) as h from t0))"""
)


def with_(*parts: str, recursive: bool = False) -> str:
    return ("with recursive " if recursive else "with ") + ", ".join(parts) + " "
