"""The questions a dashboard asks of tracks and envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Intensity classes and the knots each ends below. Fixed values.
CLASSES = {"TD": 34, "TS": 64, "Cat 1": 83, "Cat 2": 96, "Cat 3": 113, "Cat 4": 137, "Cat 5": None}


def forecast_catalog(tracks: DataFrame) -> DataFrame:
    out = tracks.groupBy("track_id", "forecast_time").agg(F.countDistinct("ensemble_member").alias("n_members"), F.max("lead_time").alias("max_lead"))
    return out.orderBy(F.desc("forecast_time"), "track_id")


def storm_tracks(tracks: DataFrame, track_id: str, forecast_time) -> DataFrame:
    """One storm's run. Storm and time are compared as values, never pasted into text, and reach the scan as filters."""
    return tracks.where((F.col("track_id") == F.lit(track_id)) & (F.col("forecast_time") == F.lit(forecast_time))).orderBy("ensemble_member", "lead_time")


def storm_envelopes(envelopes: DataFrame, track_id: str, forecast_time, threshold: int | None = None) -> DataFrame:
    """Regions of one run of a storm, by values that reach the scan as filters."""
    own = envelopes.where((F.col("track_id") == F.lit(track_id)) & (F.col("forecast_time") == F.lit(forecast_time)))
    return (own if threshold is None else own.where(F.col("threshold") == threshold)).orderBy("threshold", "member", *[c for c in ("step",) if c in envelopes.columns])


def latest_run(tracks: DataFrame, track_id: str, prefix: str = "") -> DataFrame:
    """The newest run of a storm whose time begins with a prefix."""
    own = tracks.where((F.col("track_id") == F.lit(track_id)) & F.date_format("forecast_time", "yyyy-MM-dd HH:mm:ss").startswith(prefix))
    return own.agg(F.max("forecast_time").alias("forecast_time"))


def option_lists(tracks: DataFrame) -> DataFrame:
    """Distinct (day, time, storm), newest day first."""
    return tracks.select(F.date_format("forecast_time", "yyyy-MM-dd").alias("day"), F.date_format("forecast_time", "HH:mm").alias("time"), "track_id").distinct().orderBy(F.desc("day"), "time", "track_id")


def envelope_options(envelopes: DataFrame, track_id: str, forecast_time) -> DataFrame:
    """The members and thresholds that a run of a storm has regions for: (option, value), in order."""
    own = envelopes.where((F.col("track_id") == F.lit(track_id)) & (F.col("forecast_time") == F.lit(forecast_time)))
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("option"), F.col(c).cast("int").alias("value")) for c in ("member", "threshold")]))
    return own.select(pairs.alias("x")).select("x.*").distinct().orderBy("option", "value")


def mean_by_lead(tracks: DataFrame) -> DataFrame:
    return tracks.groupBy("track_id", "lead_time").agg(F.avg("wind_speed_knots").alias("mean_wind"), F.avg("pressure_hpa").alias("mean_pressure"))


def intensity_class(knots: Column) -> Column:
    """The class of a wind; null for a null wind."""
    out = F.when(knots.isNull(), None)
    for name, below in CLASSES.items():
        out = out.when(knots < below, name) if below else out.otherwise(name)
    return out


def intensity_counts(tracks: DataFrame) -> DataFrame:
    """Members of each class by storm and lead, all classes in order, 0 where there are none."""
    rows = tracks.withColumn("_class", intensity_class(F.col("wind_speed_knots"))).where("_class is not null")
    out = rows.groupBy("track_id", "lead_time").pivot("_class", list(CLASSES)).agg(F.countDistinct("ensemble_member")).na.fill(0)
    return out.withColumnsRenamed({c: c.lower().replace(" ", "") for c in CLASSES})


def dateline_segments(tracks: DataFrame) -> DataFrame:
    """Adds ``segment``: a member's path is cut where consecutive longitudes differ by over 180."""
    w = W.partitionBy("track_id", "ensemble_member").orderBy("lead_time")
    jump = F.when(F.abs(F.col("longitude") - F.lag("longitude").over(w)) > 180, 1).otherwise(0)
    return tracks.withColumn("_j", jump).withColumn("segment", F.sum("_j").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("_j")


def progressive_frames(tracks: DataFrame, leads: list[int]) -> DataFrame:
    """For each of a few frame leads all points up to it; frames are literals, so nothing is joined."""
    frames = F.filter(F.array(*map(F.lit, leads)), lambda h: h >= F.col("lead_time"))
    return tracks.withColumn("frame", F.explode(frames))


def frame_envelopes(envelopes: DataFrame, step: int | None, members: list[int], thresholds: list[int]) -> DataFrame:
    own = envelopes.where(F.col("member").isin(members) & F.col("threshold").isin(thresholds))
    return (own if step is None else own.where(F.col("step") == step)).orderBy("threshold", "member")


def map_centre(points: DataFrame, by: list[str] | None = None) -> DataFrame:
    return points.groupBy(*(by or [])).agg(F.avg("latitude").alias("lat"), F.avg("longitude").alias("lon"))


def track_endpoints(tracks: DataFrame) -> DataFrame:
    at = lambda f, c: f(c, "lead_time").alias(("first_" if f is F.min_by else "last_") + c)
    return tracks.groupBy("track_id", "ensemble_member").agg(*[at(f, c) for f in (F.min_by, F.max_by) for c in ("latitude", "longitude")])


def label_points(tracks: DataFrame, every: int = 48) -> DataFrame:
    return tracks.where(F.col("lead_time") % every == 0)


def envelope_extent(envelopes: DataFrame, by: list[str], pad: float) -> DataFrame:
    return envelopes.groupBy(*by).agg((F.min("lon_min") - pad).alias("lon_min"), (F.max("lon_max") + pad).alias("lon_max"), (F.min("lat_min") - pad).alias("lat_min"), (F.max("lat_max") + pad).alias("lat_max"))


def member_steps(envelopes: DataFrame, member: int) -> DataFrame:
    """Thresholds by lead of a member's regions; those of the lowest member there is when it has none."""
    there = envelopes.agg(F.coalesce(F.max(F.when(F.col("member") == member, F.col("member"))), F.min("member")).alias("_m"))
    own = envelopes.join(F.broadcast(there), F.col("member") == F.col("_m"))
    return own.groupBy("member", "step").agg(F.array_join(F.sort_array(F.collect_set("threshold")), ",").alias("thresholds"))


def member_threshold_span(combined: DataFrame, n: int) -> DataFrame:
    out = combined.groupBy("member").agg(F.min("threshold").alias("lowest"), F.max("threshold").alias("highest"), F.count("*").alias("n"))
    return out.orderBy("member").limit(n)
