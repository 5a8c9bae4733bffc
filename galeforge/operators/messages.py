"""Decoded track messages to long rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identity import storm_identity
from ..schemas import MISSING


def per_member_or_scalar(values: Column, n_members: Column, k: Column) -> Column:
    """Entry k of an array with one entry for each member, else its first."""
    return F.when(F.size(values) == n_members, F.try_element_at(values, k + 1)).otherwise(F.try_element_at(values, F.lit(1)))


def first_non_missing(values: Column) -> Column:
    """The first entry that is neither null nor the missing sentinel; null if there is none."""
    return F.try_element_at(F.filter(values, lambda x: x.isNotNull() & (x.cast("double") < MISSING)), F.lit(1))


def radius_offset(radii: Column, member: Column, period: Column, n_periods: Column, threshold: Column, quadrant: Column) -> Column:
    """The radius at member * periods * 12 + period * 12 + threshold * 4 + quadrant (all from 0); null beyond the array."""
    return F.try_element_at(radii, (member * n_periods * 12 + period * 12 + threshold * 4 + quadrant + 1).cast("int"))


def null_sentinel(x: Column, above: float = 1e10) -> Column:
    return F.when(F.abs(x) <= above, x)


def valid_time(base: Column, hours: Column) -> Column:
    return base + F.make_dt_interval(hours=hours)


def flatten_messages(messages: DataFrame) -> DataFrame:
    """Message x member x period x threshold x quadrant to rows; a quadrant's row is there even without a radius."""
    return radius_rows(message_points(messages))


def message_points(messages: DataFrame) -> DataFrame:
    """Message x member x period to rows with the thresholds and, as ``_m``, the radii that lie below them.

    Periods without hours are skipped, rows without a centre dropped; sentinels become null, those of the maximum wind's place too.
    Each explode takes along only what lies below it: a period its members' radii, a member its own, so the work grows as the message does. Names and times are made before members are laid out.
    """
    n, n_periods, width = F.size("members"), F.size("periods"), 4 * F.size("thresholds")
    names = {"lat": "latitude", "lon": "longitude", "pressure": "pressure", "wlat": "wlatitude", "wlon": "wlongitude", "wind": "wind"}
    identity = ["storm_id", "storm_identifier", "long_storm_name"]
    own = lambda i: F.transform("members", lambda _, k: F.slice("radii", (k * n_periods * 12 + i * 12 + 1).cast("int"), width))
    m = messages.withColumn("storm_id", storm_identity(F.col("storm_identifier"), F.col("long_storm_name")))
    m = m.select(*identity, "base_time", "thresholds", "members", n.alias("_n"), F.explode(F.transform("periods", lambda p, i: F.struct(p.alias("period"), own(i).alias("radii")))).alias("_p"))
    m = m.withColumn("step", first_non_missing(F.col("_p.period.hours")).cast("int")).where("step is not null").withColumn("datetime", valid_time(F.col("base_time"), F.col("step")))
    m = m.select(*identity, "step", "datetime", "thresholds", "_n", "_p", F.posexplode("members").alias("_k", "ensemble_member"))
    value = lambda c: null_sentinel(per_member_or_scalar(F.col(f"_p.period.{c}"), F.col("_n"), F.col("_k")))
    m = m.where(value("lat").isNotNull() & value("lon").isNotNull())
    return m.select(*identity, "ensemble_member", "step", "datetime", *[value(c).alias(name) for c, name in names.items()], "thresholds", F.try_element_at(F.col("_p.radii"), F.col("_k") + 1).alias("_m"))


def radius_rows(points: DataFrame) -> DataFrame:
    """Message points to a row for each threshold and quadrant. What a point has once is best made before this, as each becomes twelve rows."""
    m = points.withColumn("_j", F.explode(F.sequence(F.lit(0), 4 * F.size("thresholds") - 1, F.lit(1))))
    bearing = (F.col("_j") % 4) * 90.0
    return m.select(
        *[c for c in points.columns if c not in ("thresholds", "_m")], F.try_element_at("thresholds", F.floor(F.col("_j") / 4).cast("int") + 1).cast("int").alias("wind_threshold"), (F.col("_j") % 4 + 1).alias("quadrant"),
        bearing.alias("bearing_start"), (bearing + 90).alias("bearing_end"), null_sentinel(F.try_element_at("_m", F.col("_j") + 1)).alias("wind_radius"),
    )


def drop_deterministic_member(rows: DataFrame, member: int = 52) -> DataFrame:
    return rows.where(F.col("ensemble_member") != member)


def run_info(rows: DataFrame, by: str) -> DataFrame:
    """Issue time of each group's rows (valid time less step, of its first step), with its date and hour."""
    issue = F.min_by(F.col("datetime") - F.make_dt_interval(hours=F.col("step")), F.struct("step", "datetime"))
    out = rows.groupBy(by).agg(issue.alias("issue_time"))
    return out.withColumns({"run_date": F.date_format("issue_time", "yyyy-MM-dd"), "run_hour": F.hour("issue_time")})
