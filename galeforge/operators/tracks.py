"""Raw track rows to one row for each storm, member and step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.geo import antimeridian_split, boxes_to_wkt, haversine_km, quadrant_box
from ..schemas import POLYGON_COLUMNS, QUADRANTS, RADIUS_COLUMNS, RADIUS_KNOTS, RAW_RADII, RAW_REQUIRED, TRACK_COLUMNS

POINT = ["storm_id", "storm_identifier", "long_storm_name", "ensemble_member", "step", "datetime", "latitude", "longitude", "pressure", "wlatitude", "wlongitude", "wind"]
COORDINATES = ["latitude", "longitude", "wlatitude", "wlongitude"]


def validate_tracks(rows: DataFrame) -> DataFrame:
    """For each storm its rows, coordinate rows and whether it is usable; an error if a required column is missing. Wind radii are not required."""
    if missing := [c for c in RAW_REQUIRED if c not in rows.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    out = rows.groupBy("storm_id").agg(F.count("*").alias("n_rows"), *[F.count(c).alias(f"n_{c}") for c in COORDINATES])
    return out.withColumn("valid", F.greatest(*[F.col(f"n_{c}") for c in COORDINATES]) > 0)


def with_group_values(rows: DataFrame, by: tuple[str, ...], **values) -> DataFrame:
    """Adds aggregates of each group to its rows: a map-side combined aggregate and a join with its few rows, so a large storm is no single task."""
    keys = [F.col(c).alias(f"_by{i}") for i, c in enumerate(by)]
    stats = rows.groupBy(*keys).agg(*[v.alias(k) for k, v in values.items()])
    same = [F.col(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate(by)]
    return rows.join(stats, same, "left").drop(*[f"_by{i}" for i in range(len(by))])


def with_forecast_time(rows: DataFrame, by: tuple[str, ...] = ("storm_id",)) -> DataFrame:
    """Adds forecast_time: a storm's earliest time at step 0, else its first step's time less the step."""
    back = F.min_by(F.col("datetime") - F.make_dt_interval(hours=F.col("step")), F.struct("step", "datetime"))
    return with_group_values(rows, by, forecast_time=F.coalesce(F.min(F.when(F.col("step") == 0, F.col("datetime"))), back))


def distinct_points(rows: DataFrame) -> DataFrame:
    return rows.select([c for c in POINT if c in rows.columns]).dropDuplicates()


def drop_null_radii(rows: DataFrame) -> DataFrame:
    return rows.dropna(subset=["wind_radius"])


def _widest() -> list:
    """The twelve radii in km as aggregates; of several of one threshold and quadrant the largest."""
    tier = {(ms, q): f"radius_{kt}_knot_winds_{name}_km" for ms, kt in RADIUS_KNOTS.items() for q, name in QUADRANTS.items()}
    return [F.max(F.when((F.col("wind_threshold") == ms) & (F.col("quadrant") == q), F.col("wind_radius") / 1000)).alias(c) for (ms, q), c in tier.items()]


def radii_to_wide(rows: DataFrame) -> DataFrame:
    """One row for each storm, member and step with twelve radii in km. One aggregate whose buffer is the row; a pivot would first hold a group for each threshold and quadrant."""
    return rows.groupBy("storm_id", "ensemble_member", "step").agg(*_widest())


def attach_radii(points: DataFrame, wide: DataFrame) -> DataFrame:
    return points.join(wide, ["storm_id", "ensemble_member", "step"], "left")


def standard_names(points: DataFrame, track_id: str | None = None) -> DataFrame:
    names = {"storm_id": "track_id", "step": "lead_time", "datetime": "valid_time", "pressure": "pressure_hpa", "wind": "wind_speed_knots"}
    out = points.withColumnsRenamed(names)
    return out if track_id is None else out.withColumn("track_id", F.lit(track_id))


def pressure_to_hpa(rows: DataFrame, by: str = "track_id", column: str = "pressure_hpa") -> DataFrame:
    """Pascals to hectopascals for the storms whose mean is above 10000."""
    out = with_group_values(rows, (by,), _mean=F.avg(column))
    return out.withColumn(column, F.when(F.col("_mean") > 10000, F.col(column) / 100).otherwise(F.col(column))).drop("_mean")


def wind_to_knots(rows: DataFrame, column: str = "wind_speed_knots") -> DataFrame:
    return rows.withColumn(column, F.col(column) * 1.944)


def clear_impossible_radii(rows: DataFrame) -> DataFrame:
    """All radii of a threshold to 0, nulls too, where the wind is below it; storms without any radius stay as they are."""
    return _cleared(with_group_values(rows, ("track_id",), _some=F.max(F.coalesce(*RADIUS_COLUMNS).isNotNull()))).drop("_some")


def _cleared(rows: DataFrame) -> DataFrame:
    new = {c: F.when(F.col("_some") & (F.col("wind_speed_knots") < int(c.split("_")[1])), 0.0).otherwise(F.col(c)) for c in RADIUS_COLUMNS}
    return rows.withColumns(new)


def radius_of_max_wind(rows: DataFrame) -> DataFrame:
    return rows.withColumn("radius_of_maximum_winds_km", haversine_km(*map(F.col, ("latitude", "longitude", "wlatitude", "wlongitude"))))


def radii_boxes(kt: int):
    """The antimeridian-split boxes of a threshold's four radii."""
    return antimeridian_split(quadrant_box(F.col("latitude"), F.col("longitude"), *[F.col(f"radius_{kt}_knot_winds_{q}_km") for q in ("ne", "se", "sw", "nw")]))


def with_polygons(rows: DataFrame, digits: int | None = None) -> DataFrame:
    """The three polygon columns. Boxes and their parts are columns of their own first, so no expression holds them twice."""
    radii = lambda kt: [F.col(f"radius_{kt}_knot_winds_{q}_km") for q in ("ne", "se", "sw", "nw")]
    kts = list(RADIUS_KNOTS.values())
    rows = rows.withColumns({f"_box{kt}": quadrant_box(F.col("latitude"), F.col("longitude"), *radii(kt)) for kt in kts})
    rows = rows.withColumns({f"_parts{kt}": antimeridian_split(F.col(f"_box{kt}")) for kt in kts})
    return rows.withColumns({c: boxes_to_wkt(F.col(f"_parts{kt}"), digits) for c, kt in zip(POLYGON_COLUMNS, kts, strict=True)}).drop(*[f"_{x}{kt}" for kt in kts for x in ("box", "parts")])


def standard_schema(rows: DataFrame) -> DataFrame:
    """The fixed columns in order, null where absent."""
    return rows.select(*[F.col(c) if c in rows.columns else F.lit(None).alias(c) for c in TRACK_COLUMNS])


def with_radii(raw: DataFrame) -> DataFrame:
    """Rows with the three columns of wind radii; where one is absent no row has a radius."""
    if all(c in raw.columns for c in RAW_RADII):
        return raw
    kinds = dict(zip(RAW_RADII, ("int", "int", "double"), strict=True))
    return raw.withColumns({c: F.lit(None).cast(k) for c, k in kinds.items()})


def keyed_points(raw: DataFrame) -> DataFrame:
    """The distinct points of each storm, member and step beside the twelve radii in km of all of them.

    Points are the keys of a hash aggregate with map-side combine; a window over the few points of a key brings their radii together.
    """
    points = with_radii(raw).groupBy(*[c for c in POINT if c in raw.columns]).agg(*_widest())
    same = W.partitionBy("storm_id", "ensemble_member", "step")
    return points.select(*[c for c in POINT if c in raw.columns], *[F.max(c).over(same).alias(c) for c in RADIUS_COLUMNS])


def with_storm_values(points: DataFrame) -> DataFrame:
    """Adds what all points of a storm share: forecast_time, the mean pressure and whether any radius is there. A window in the order that ``keyed_points`` leaves, so raw rows are not read again; it spills beyond a few thousand rows of a storm."""
    own = W.partitionBy("storm_id")
    back = F.min_by(F.col("datetime") - F.make_dt_interval(hours=F.col("step")), F.struct("step", "datetime"))
    some = F.greatest(*[F.col(c).isNotNull() for c in RADIUS_COLUMNS])
    return points.withColumns({"forecast_time": F.coalesce(F.min(F.when(F.col("step") == 0, F.col("datetime"))).over(own), back.over(own)), "_mean": F.avg("pressure").over(own), "_some": F.max(some).over(own)})


def transform(raw: DataFrame, digits: int | None = None, track_id: str | None = None) -> DataFrame:
    """Raw rows to standard tracks: points with their radii and with what all points of a storm share. Files without radii have null radii and no polygons; ``track_id`` replaces the storms' own."""
    rows = wind_to_knots(standard_names(with_storm_values(keyed_points(raw)), track_id))
    rows = rows.withColumn("pressure_hpa", F.when(F.col("_mean") > 10000, F.col("pressure_hpa") / 100).otherwise(F.col("pressure_hpa")))
    return standard_schema(with_polygons(radius_of_max_wind(_cleared(rows)), digits))


def quality_summary(rows_in: DataFrame, out: DataFrame) -> DataFrame:
    """One row: rows in and out, distinct storms, members and leads, time range, nulls in critical columns."""
    critical = ("latitude", "longitude", "pressure_hpa", "wind_speed_knots")
    own = out.agg(
        F.count("*").alias("rows_out"), F.countDistinct("track_id").alias("n_storms"), F.countDistinct("ensemble_member").alias("n_members"), F.countDistinct("lead_time").alias("n_leads"),
        F.min("valid_time").alias("first_time"), F.max("valid_time").alias("last_time"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in critical],
    )
    return rows_in.agg(F.count("*").alias("rows_in")).crossJoin(own)
