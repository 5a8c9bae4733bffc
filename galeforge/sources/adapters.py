"""The general tables as hazard tables: track points, raw tracks, messages, fields, discharge, pixels, file names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import MISSING
from .tables import dealt, read

RUN = "timestamp_ntz'2024-07-01 00:00:00'"


def track_points(spark: SparkSession, folder: str) -> DataFrame:
    """A storm for every supplier, with 51 members and 41 leads at most; some cross the antimeridian.

    Rows of a storm, of which there are few thousand points at most, are dealt to one task, in as many parts as the table needs; places follow from the key, so they are reckoned after the aggregate.
    """
    lines = read(spark, folder, "lineitem")
    own = lines.selectExpr("concat('STORM', l_suppkey) as storm_id", "cast(1 + l_partkey % 51 as int) as ensemble_member", "cast(6 * (l_orderkey % 41) as int) as step", "l_suppkey", "l_quantity")
    points = dealt(own, lines.count(), "storm_id").groupBy("storm_id", "ensemble_member", "step").agg(F.min("l_suppkey").alias("s"), F.min("l_quantity").alias("q"))
    points = points.selectExpr("storm_id", "ensemble_member", "step", "s", "q", "((s * 3571) % 36000) / 1e2 - 180e0 + 15e-2 * step + 2e-2 * (ensemble_member - 1) as x")
    return points.selectExpr(
        "storm_id", "ensemble_member", "step", "((s * 137) % 4500) / 1e2 - 25e0 + 2e-2 * step + 1e-2 * (ensemble_member - 1) as latitude", "case when x >= 180 then x - 360 else x end as longitude",
        "cast(100000e0 - 200e0 * q as double) as pressure", "cast(15e-1 * q as double) as wind",
    )


def raw_tracks(spark: SparkSession, folder: str) -> DataFrame:
    """Track points by threshold and quadrant, with times, the place of the maximum wind and some missing radii."""
    p = track_points(spark, folder).withColumns(
        {
            "storm_identifier": F.substring("storm_id", 5, 12),
            "long_storm_name": F.col("storm_id"),
            "datetime": F.expr(f"{RUN} + make_dt_interval(0, step)"),
            "wlatitude": F.col("latitude") + 0.2,
            "wlongitude": F.col("longitude") - 0.3,
        }
    )
    p = p.withColumn("wind_threshold", F.explode(F.array(F.lit(18), F.lit(26), F.lit(33)))).withColumn("quadrant", F.explode(F.array(*map(F.lit, (1, 2, 3, 4)))))
    radius = F.when((F.col("ensemble_member") + F.col("quadrant")) % 7 == 0, None).otherwise(F.col("wind") * 1e3 + F.col("wind_threshold") * 5e2 + F.col("quadrant") * 25e2)
    return p.withColumns({"bearing_start": (F.col("quadrant") - 1) * 90.0, "bearing_end": F.col("quadrant") * 90.0, "wind_radius": radius})


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """Track points as decoded messages: one row for each storm with arrays by period and member, 1e100 where there is no value. Radii follow from the wind, so they are laid out last."""
    p, missing = track_points(spark, folder), F.lit(MISSING)
    members, steps = F.sequence(F.lit(1), F.lit(51)), F.sequence(F.lit(0), F.lit(240), F.lit(6))
    radii = lambda wind, k: F.array(*[F.when((k + q) % 7 != 0, wind * 1e3 + t * 5e2 + q * 25e2).otherwise(missing) for t in (18, 26, 33) for q in (1, 2, 3, 4)])
    twelve = lambda wind, k: F.when(wind < MISSING, radii(wind, k)).otherwise(F.array(*[missing] * 12))
    values = {"lat": F.col("latitude"), "lon": F.col("longitude"), "pressure": F.col("pressure"), "wlat": F.col("latitude") + 0.2, "wlon": F.col("longitude") - 0.3, "wind": F.col("wind")}
    cell = F.struct(*[F.coalesce(v, missing).alias(c) for c, v in values.items()])
    gone = F.struct(*[missing.alias(c) for c in values])
    by_step = p.groupBy("storm_id", "step").agg(F.map_from_entries(F.collect_list(F.struct("ensemble_member", cell))).alias("m"))
    by_step = by_step.withColumn("m", F.transform(members, lambda k: F.coalesce(F.try_element_at("m", k), gone)))
    take = lambda name: F.transform("m", lambda x: x[name])
    period = F.struct(F.array("step").alias("hours"), *[take(c).alias(c) for c in values])
    empty = lambda s: F.struct(F.array(s).alias("hours"), *[F.array_repeat(missing, 51).alias(c) for c in values])
    m = by_step.groupBy("storm_id").agg(F.map_from_entries(F.collect_list(F.struct("step", period))).alias("p"))
    m = m.withColumn("periods", F.transform(steps, lambda s: F.coalesce(F.try_element_at("p", s), empty(s))))
    m = m.withColumn("radii", F.flatten(F.flatten(F.transform(members, lambda k: F.transform("periods", lambda p: twelve(F.element_at(p["wind"], k), k))))))
    return m.select(
        F.substring("storm_id", 5, 12).alias("storm_identifier"), F.col("storm_id").alias("long_storm_name"), F.expr(RUN).alias("base_time"), members.alias("members"),
        "periods", F.array(*map(F.lit, (18.0, 26.0, 33.0))).alias("thresholds"), F.array(*map(F.lit, (0.0, 90.0, 180.0, 270.0))).alias("bearings"), "radii",
    )


def grid_field(spark: SparkSession, folder: str) -> DataFrame:
    """A field of 20 rows and a column for every ten parts, 5 members, 7 steps: r, c, member, step, lat, lon, value. Nodes are dealt by all of their key, in as many parts as the table needs."""
    lines = read(spark, folder, "lineitem")
    own = lines.selectExpr("cast(l_orderkey % 20 as int) as r", "cast(floor(l_partkey / 10e0) as int) as c", "cast(1 + l_suppkey % 5 as int) as member", "cast(3 * l_linenumber as int) as step", "l_quantity")
    out = dealt(own, lines.count(), "r", "c", "member", "step").groupBy("r", "c", "member", "step").agg((1.5 * F.min("l_quantity")).alias("value"))
    return out.withColumns({"value": F.col("value").cast("double"), "lat": 20 - 0.25 * F.col("r"), "lon": -60 + 0.25 * F.col("c")})


def discharge(spark: SparkSession, folder: str) -> DataFrame:
    out = spark.sql(
        """select e.vec_id as cell_id, a.m as member, 24 * b.s as step_h, 6e1 - 5e-2 + 25e-3 - 5e-2 * ((e.vec_id * 37) % 2400) as cell_lat,
             25e-3 - 18e1 + 5e-2 * ((e.vec_id * 101) % 7200) as cell_lon, 1e2 + 4e2 * cast(element_at(e.embedding, cast(1 + (a.m * 7 + b.s) % 64 as int)) as double) as value
           from {embeddings} e cross join range(1, 52) as a(m) cross join range(1, 8) as b(s)""",
        embeddings=read(spark, folder, "embeddings"),
    )
    return out


def cell_thresholds(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(
        """select e.vec_id as cell_id, t.rp, case when e.vec_id % 11 = 0 then -1e0 else t.base + 2e0 * e.label end as threshold
           from {embeddings} e cross join (values (2, 120e0), (5, 140e0), (10, 160e0), (20, 180e0), (50, 200e0), (100, 220e0)) as t(rp, base)""",
        embeddings=read(spark, folder, "embeddings"),
    )


def pixels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(
        """select e.vec_id as cell_id, e.vec_id * 16 + p.k as pixel_id,
             6e1 - 5e-2 + 25e-3 - 5e-2 * ((e.vec_id * 37) % 2400) + 125e-4 * (floor(p.k / 4e0) - 15e-1) as pixel_lat,
             25e-3 - 18e1 + 5e-2 * ((e.vec_id * 101) % 7200) + 125e-4 * (p.k % 4 - 15e-1) as pixel_lon, ((e.vec_id * 5 + p.k * 3) % 7) / 1e1 as depth,
             case when (e.vec_id + p.k) % 9 = 0 then 1 else 0 end as water from {embeddings} e cross join range(0, 16) as p(k)""",
        embeddings=read(spark, folder, "embeddings"),
    )


def field_files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(
        """select concat(case when o_custkey % 2 = 0 then 'wind' else 'gust' end, '_ens_', substring(cast(o_orderdate as string), 1, 10), '_r',
             lpad(cast(6 * (o_orderkey % 4) as string), 2, '0'), '_f', lpad(cast(3 * (o_orderkey % 49) as string), 3, '0'),
             case when o_custkey % 3 = 0 then 'h_cf' else 'h_pf' end, '.grib2') as file_name, o_orderkey as file_id from {orders}""",
        orders=read(spark, folder, "orders"),
    )
