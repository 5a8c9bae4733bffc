"""Rain and runoff: accumulated ensemble fields by node, member and step."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.scratch import written
from .envelopes import control_as_51


def met_to_mm(field: DataFrame, most_lat: float = 60.0) -> DataFrame:
    """Metres to millimetres, latitudes beyond the limit cut off."""
    return field.where(F.col("lat").between(-most_lat, most_lat)).withColumn("value", F.col("value") * 1000)


def stack_members(perturbed: DataFrame, control: DataFrame, n: int) -> DataFrame:
    """Every node and step with members 1..n and the control as 51; null where a member has no value."""
    both = perturbed.select("member", "step", "r", "c", "value").unionByName(control.select(control_as_51(F.lit(None).cast("int")).alias("member"), "step", "r", "c", "value"))
    members = F.explode(F.array(*[F.lit(k) for k in [*range(1, n + 1), 51]])).alias("member")
    return both.select("step", "r", "c").distinct().select("*", members).join(both, ["member", "step", "r", "c"], "left")


def grid_match(a: DataFrame, b: DataFrame, digits: int = 4) -> DataFrame:
    """How many nodes agree to so many digits, and how many only one side has."""
    key = lambda df: df.select(F.round("lat", digits).alias("lat"), F.round("lon", digits).alias("lon")).distinct()
    j = key(a).withColumn("_a", F.lit(True)).join(key(b).withColumn("_b", F.lit(True)), ["lat", "lon"], "full")
    return j.agg(F.count_if(F.col("_a") & F.col("_b")).alias("matched"), F.count_if(F.col("_b").isNull()).alias("only_first"), F.count_if(F.col("_a").isNull()).alias("only_second"))


def period_accumulation(acc: DataFrame, periods: list[tuple[int, int]], keys: tuple[str, ...] = ("member", "r", "c")) -> DataFrame:
    """value(end) - value(start) for each period, key by key; null if either end is missing. One aggregate for all periods."""
    at = lambda h: F.max(F.when(F.col("step") == h, F.col("value")))
    hours = sorted({h for p in periods for h in p})
    wide = acc.where(F.col("step").isin(hours)).groupBy(*keys).agg(*[at(h).alias(f"_{h}") for h in hours])
    rows = F.explode(F.array(*[F.struct(F.lit(a).alias("start_h"), F.lit(b).alias("end_h"), (F.col(f"_{b}") - F.col(f"_{a}")).alias("amount")) for a, b in periods]))
    return wide.select(*keys, rows.alias("_p")).select(*keys, "_p.*")


def step_accumulation(acc: DataFrame, keys: tuple[str, ...] = ("member", "r", "c")) -> DataFrame:
    """What each step adds to the one before it; null for the first."""
    return acc.withColumn("amount", F.col("value") - F.lag("value").over(W.partitionBy(*keys).orderBy("step")))


def strict_mean(value: Column) -> Column:
    """The mean, null if any value is null."""
    return F.when(F.count(value) == F.count("*"), F.avg(value))


def ensemble_mean_at(field: DataFrame, step: int) -> DataFrame:
    return step_lookup(field, step).groupBy("r", "c").agg(strict_mean(F.col("value")).alias("mean"))


def period_mean(amounts: DataFrame) -> DataFrame:
    """Member mean of each period and node, with the period's largest."""
    m = amounts.groupBy("r", "c", "start_h", "end_h").agg(strict_mean(F.col("amount")).alias("mean"))
    return m.join(m.groupBy("start_h", "end_h").agg(F.max("mean").alias("period_max")), ["start_h", "end_h"])


def period_maximum(amounts: DataFrame) -> DataFrame:
    m = amounts.groupBy("r", "c", "start_h", "end_h").agg(strict_mean(F.col("amount")).alias("mean"))
    return m.groupBy("start_h", "end_h").agg(F.max("mean").alias("period_max"))


def exceedance_pct(values: DataFrame, above: float, keys: tuple[str, ...] = ("r", "c"), column: str = "value") -> DataFrame:
    """Percent of members above; null counts as a member that isn't."""
    return values.groupBy(*keys).agg((100.0 * F.count_if(F.coalesce(F.col(column) > above, F.lit(False))) / F.count("*")).alias("pct"))


def crop_to_bounds(field: DataFrame, points: DataFrame, pad: float) -> DataFrame:
    """Nodes inside the padded bounds of the points: scalar subqueries, so the filter is one of the scan and nothing is joined. No points, no nodes."""
    b = points.agg((F.min("latitude") - pad).alias("s"), (F.max("latitude") + pad).alias("n"), (F.min("longitude") - pad).alias("w"), (F.max("longitude") + pad).alias("e"))
    one = lambda c: b.select(c).scalar()
    return field.where(F.col("lat").between(one("s"), one("n")) & F.col("lon").between(one("w"), one("e")))


def map_p99(values: DataFrame, column: str, by: list[str] | None = None) -> DataFrame:
    """The 99th percentile, interpolated, at least 1. Holds a group's different values; ``exact_percentile`` is for fields of any size."""
    return values.groupBy(*(by or [])).agg(F.greatest(F.percentile(column, 0.99), F.lit(1.0)).alias("p99"))


def exact_percentile(values: DataFrame, column: str, q: float, by: list[str] | None = None, bins: int = 1024) -> DataFrame:
    """(by, percentile): the exact percentile, linear between its two neighbours, of a field of any size; null, NaN and infinite values count for nothing, groups without values have no row.

    Selection by rounds: the range that holds a rank is cut into equal bins, counted with map-side combine, and the bin with the rank becomes the next range, until it is the first or last of its bin or the bin holds
    one value. Memory is a group's bins, whatever the number of values or of different ones; no values are brought together. Key columns may be null.
    """
    by = by or []
    v = values.where(~F.isnan(column) & (F.abs(column) < float("inf"))).select(F.struct(*by, F.lit(0).alias("_")).alias("g"), F.col(column).cast("double").alias("v"))
    v = written(v, "values")
    at = q * (F.col("n") - 1)
    ends = v.groupBy("g").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    wanted = written(ends.withColumn("rank", F.explode(F.array_distinct(F.array(F.floor(at), F.ceil(at))))).withColumn("below", F.lit(0).cast("long")), "ranks")
    found = []
    while not wanted.isEmpty():
        open_ = wanted.select(F.col("g").alias("_g"), "rank", "lo", "hi", "below", "n")
        near = v.join(open_, (F.col("g") == F.col("_g")) & F.col("v").between(F.col("lo"), F.col("hi")))
        width = F.col("hi") / bins - F.col("lo") / bins
        cut = F.when(width > 0, F.least(F.floor(F.try_divide(F.col("v") / bins - F.col("lo") / bins, width) * bins), F.lit(bins - 1))).otherwise(F.when(F.col("v") > F.col("lo"), 1).otherwise(0))
        held = near.groupBy("g", "rank", "n", "below", cut.cast("int").alias("bin")).agg(F.count("*").alias("own"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        before = F.col("below") + F.coalesce(F.sum("own").over(W.partitionBy("g", "rank").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        hit = held.withColumn("before", before).where((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("own")))
        value = F.when((F.col("lo") == F.col("hi")) | (F.col("rank") == F.col("before")), F.col("lo")).when(F.col("rank") == F.col("before") + F.col("own") - 1, F.col("hi"))
        now = written(hit.select("g", "n", "lo", "hi", "rank", F.col("before").alias("below"), value.alias("value")), "ranks")
        found.append(now.where("value is not null").select("g", "n", "rank", "value"))
        wanted = now.where("value is null").drop("value")
    every = reduce(DataFrame.union, found) if found else wanted.select("g", "n", "rank", F.col("lo").alias("value"))
    low, high = F.min_by("value", "rank"), F.max_by("value", "rank")
    part = F.first(at) - F.floor(F.first(at))
    return every.groupBy("g").agg((low + part * (high - low)).alias("percentile")).select(*[F.col("g")[c].alias(c) for c in by], "percentile")


def accumulation_monotonic(acc: DataFrame, keys: tuple[str, ...] = ("member", "r", "c"), slack: float = 0.01) -> DataFrame:
    rows = acc.withColumn("_ok", F.coalesce(F.col("value") >= F.lag("value").over(W.partitionBy(*keys).orderBy("step")) - slack, F.lit(True)))
    return rows.groupBy(*keys).agg(F.bool_and("_ok").alias("monotonic"))


def tracks_in_period(tracks: DataFrame, periods: list[tuple[int, int]]) -> DataFrame:
    """Track rows with each period they fall in, ends inclusive. Periods are literals, so no join is needed."""
    hit = F.array_compact(F.array(*[F.when(F.col("lead_time").between(a, b), F.struct(F.lit(a).alias("start_h"), F.lit(b).alias("end_h"))) for a, b in periods]))
    return tracks.withColumn("_p", F.explode(hit)).select(*tracks.columns, "_p.*")


def step_lookup(field: DataFrame, step: int) -> DataFrame:
    """The rows of a step; an error when it isn't there."""
    rows = field.where(F.col("step") == step)
    if rows.limit(1).isEmpty():
        raise ValueError(f"no step {step}")
    return rows
