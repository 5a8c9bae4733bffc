"""Wind and gust envelopes as sets of grid nodes above a threshold.

A region is its nodes: eyes stay open, union is distinct, area counts nodes. Contour vertices are there through contour_crossings.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.geo import KM_PER_DEGREE, number_text

GRID = 0.25
#: Kilometres a degree by latitude and by longitude that areas are reckoned with.
AREA_KM = (111, 104)


def wind_speed(field: DataFrame, keys: list[str]) -> DataFrame:
    """u10 and v10 rows of a node to its speed, null unless both are there. One shuffle, no self join."""
    pick = lambda p: F.max(F.when(F.col("param") == p, F.col("value")))
    return field.where(F.col("param").isin("u10", "v10")).groupBy(*keys).agg(F.sqrt(pick("u10") * pick("u10") + pick("v10") * pick("v10")).alias("speed"))


def gust_param(step: Column) -> Column:
    """The gust parameter of a lead: the 3-hour one beyond 90 h; null at lead 0, which has none."""
    return F.when(step == 0, None).when(step > 90, "10fg3").otherwise("10fg")


def unwrap_longitude(points: DataFrame, by: list[str], order: str, column: str = "longitude") -> DataFrame:
    """Adds ``unwrapped``: along each track, in order, jumps of half a turn or more are taken back by full turns."""
    w = W.partitionBy(*by).orderBy(order)
    d = F.col(column) - F.lag(column).over(w)
    m = F.pmod(F.col("_d") + 180.0, F.lit(360.0)) - 180.0
    turn = F.when(F.abs("_d") < 180, 0.0).otherwise(F.when((m == -180) & (F.col("_d") > 0), 180.0).otherwise(m) - F.col("_d"))
    out = points.withColumn("_d", d).withColumn("_t", F.coalesce(turn, F.lit(0.0)))
    return out.withColumn("unwrapped", F.col(column) + F.sum("_t").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("_d", "_t")


def reconcile_longitudes(points: DataFrame, by: str, column: str = "longitude", most_span: float = 90.0) -> DataFrame:
    """Adds ``reconciled``: if a storm's widest circular gap lies inside its longitudes, those up to it move east by a turn.

    Unchanged if the gap across the date line is as wide, or if the moved ones would span over ``most_span`` degrees. Ties go to the
    westernmost gap. Works on distinct longitudes by storm.
    """
    lons = points.where(F.col(column).isNotNull()).select(by, F.col(column).alias("_x")).distinct()
    gaps = lons.withColumn("_next", F.lead("_x").over(W.partitionBy(by).orderBy("_x")))
    widest = F.max_by(F.struct((F.col("_next") - F.col("_x")).alias("gap"), F.col("_x").alias("cut"), F.col("_next").alias("after")), F.struct((F.col("_next") - F.col("_x")).alias("g"), (-F.col("_x")).alias("w")))
    g = gaps.groupBy(by).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"), widest.alias("_g"))
    inside = (F.col("_g.gap") > F.col("_lo") + 360 - F.col("_hi")) & (F.col("_g.cut") + 360 - F.col("_g.after") <= most_span)
    g = g.select(by, F.when(inside, F.col("_g.cut")).alias("_cut"))
    return points.join(g, by, "left").withColumn("reconciled", F.when(F.col(column) <= F.col("_cut"), F.col(column) + 360).otherwise(F.col(column))).drop("_cut")


def track_search_box(points: DataFrame, by: str, radius_km: float, margin: float, longitude: str = "longitude") -> DataFrame:
    """The box of all points' circles (radius in degrees, mean of both axes) and a margin, for each storm."""
    r = (radius_km / KM_PER_DEGREE + radius_km / (KM_PER_DEGREE * F.cos(F.radians("latitude")))) / 2
    lon, lat = F.col(longitude), F.col("latitude")
    return points.groupBy(by).agg(
        (F.min(lon - r) - margin).alias("lon_min"), (F.max(lon + r) + margin).alias("lon_max"), (F.min(lat - r) - margin).alias("lat_min"), (F.max(lat + r) + margin).alias("lat_max")
    )


def longitude_windows(boxes: DataFrame) -> DataFrame:
    """Boxes to windows within +-180: one, two where the date line is crossed, the full range where it is crossed on both sides."""
    lo, hi = F.col("lon_min"), F.col("lon_max")
    w = lambda a, b: F.struct(a.alias("lon_min"), b.alias("lon_max"))
    e, o = F.lit(180.0), F.lit(-180.0)
    windows = (
        F.when((hi > 180) & (lo < -180), F.array(w(o, e)))
        .when(hi > 180, F.array(w(F.greatest(lo, o), e), w(o, hi - 360)))
        .when(lo < -180, F.array(w(lo + 360, e), w(o, F.least(hi, e))))
        .otherwise(F.array(w(lo, hi)))
    )
    rest = [c for c in boxes.columns if c not in ("lon_min", "lon_max")]
    return boxes.select(*rest, F.posexplode(windows).alias("window", "_w")).select(*rest, "window", "_w.lon_min", "_w.lon_max")


def crop_grid(field: DataFrame, windows: DataFrame, tile: float = 5.0) -> DataFrame:
    """Nodes inside a window, bounds inclusive, once for each window.

    Windows are laid out over tiles, so this is an equi-join on the tile and a filter, not a nested loop.
    """
    cut = lambda c: F.floor(c / tile).cast("int")
    w = windows.withColumn("_ty", F.explode(F.sequence(cut(F.col("lat_min")), cut(F.col("lat_max"))))).withColumn("_tx", F.explode(F.sequence(cut(F.col("lon_min")), cut(F.col("lon_max")))))
    f = field.withColumns({"_ty": cut(F.col("lat")), "_tx": cut(F.col("lon"))})
    return f.join(w, ["_ty", "_tx"]).where("lat between lat_min and lat_max and lon between lon_min and lon_max").drop("_ty", "_tx", "lat_min", "lat_max", "lon_min", "lon_max")


def control_as_51(number: Column) -> Column:
    return F.when(number.isNull() | (number == 0), 51).otherwise(number)


def threshold_cells(field: DataFrame, thresholds: dict[int, float], value: str = "value") -> DataFrame:
    """A row for each node and threshold that its value is above; null and NaN are above none. The thresholds are literals, so nothing is joined."""
    above = F.array(*[F.when(F.col(value) > v, F.lit(name)) for name, v in thresholds.items()])
    real = F.when(~F.isnan(value), F.array_compact(above)).otherwise(F.array().cast("array<int>"))
    return field.withColumn("threshold", F.explode(real))


def contour_crossings(field: DataFrame, keys: list[str], thresholds: dict[int, float]) -> DataFrame:
    """Where a threshold crosses an edge between neighbouring nodes: keys, threshold, lat, lon by linear interpolation."""

    def along(line: str, pos: str):
        w = W.partitionBy(*keys, line).orderBy(pos)
        nxt = [F.lead(c).over(w).alias(f"_{c}") for c in (pos, "lat", "lon", "value")]
        e = field.select(*keys, pos, "lat", "lon", "value", *nxt).where(F.col(f"_{pos}") == F.col(pos) + 1)
        hit = F.array_compact(F.array(*[F.when((F.col("value") > v) != (F.col("_value") > v), F.struct(F.lit(k).alias("threshold"), F.lit(v).alias("v"))) for k, v in thresholds.items()]))
        e = e.withColumn("_h", F.explode(hit)).withColumn("_f", (F.col("_h.v") - F.col("value")) / (F.col("_value") - F.col("value")))
        return e.select(*keys, "_h.threshold", (F.col("lat") + F.col("_f") * (F.col("_lat") - F.col("lat"))).alias("lat"), (F.col("lon") + F.col("_f") * (F.col("_lon") - F.col("lon"))).alias("lon"))

    return along("r", "c").union(along("c", "r"))


def merge_windows(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Regions of several windows as one: nodes that both have count once."""
    return reduce(DataFrame.unionByName, parts).dropDuplicates([*keys, "r", "c"])


def synth_rows(leads: DataFrame, members: DataFrame, run: Column) -> DataFrame:
    """Every lead with every member and its valid time; the members, a short list by nature, are one value that each lead lays out."""
    every = members.agg(F.array_sort(F.collect_set("ensemble_member"))).scalar()
    return leads.select("lead_time").distinct().withColumn("ensemble_member", F.explode(every)).withColumn("valid_time", run + F.make_dt_interval(hours=F.col("lead_time")))


def resolve_run_time(rows: DataFrame, by: str) -> DataFrame:
    back = F.min_by(F.col("valid_time") - F.make_dt_interval(hours=F.col("lead_time")), "lead_time")
    return rows.groupBy(by).agg(F.coalesce(F.min("forecast_time"), back).alias("run_time"))


def region_area(n: Column) -> Column:
    return n * (GRID * GRID * AREA_KM[0] * AREA_KM[1])


def row_boxes(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Runs of neighbouring nodes of each row: keys, r, first and last column, lat, west, east."""
    island = F.col("c") - F.row_number().over(W.partitionBy(*keys, "r").orderBy("c"))
    return cells.withColumn("_i", island).groupBy(*keys, "r", "_i").agg(F.min("c").alias("c0"), F.max("c").alias("c1"), F.min("lat").alias("lat"), F.min("lon").alias("west"), F.max("lon").alias("east")).drop("_i")


def region_boxes(cells: DataFrame, keys: list[str]) -> DataFrame:
    """A region as few rectangles: runs of a row, and below each other as one where they have the same columns. (keys, r0, r1, c0, c1, south, north, west, east), edges half a cell out; each node lies in exactly one."""
    half = GRID / 2
    runs = row_boxes(cells, keys).withColumn("_i", F.col("r") - F.row_number().over(W.partitionBy("c0", "c1", *keys).orderBy("r")))  # columns first: sorting compares the first key fastest, and they have most values
    return runs.groupBy(*keys, "c0", "c1", "_i").agg(
        F.min("r").alias("r0"), F.max("r").alias("r1"), (F.min("lat") - half).alias("south"), (F.max("lat") + half).alias("north"), (F.min("west") - half).alias("west"), (F.max("east") + half).alias("east")
    ).drop("_i")


def region_texts(boxes: DataFrame, keys: list[str], most: int = 500) -> DataFrame:
    """(keys, part, region): each region's rectangles as geometry text, at most ``most`` a row, so that no row grows with its region."""
    corner = lambda x, y: F.concat(f"_{x}", F.lit(" "), f"_{y}")
    ring = F.concat_ws(", ", *[corner(x, y) for x, y in (("west", "south"), ("east", "south"), ("east", "north"), ("west", "north"), ("west", "south"))])
    k = F.row_number().over(W.partitionBy(*keys).orderBy("r0", "c0"))
    texts = boxes.select(*keys, "r0", "c0", F.floor((k - 1) / most).cast("int").alias("part"), *[number_text(F.col(x)).alias(f"_{x}") for x in ("west", "south", "east", "north")])
    parts = texts.select(*keys, "part", F.struct("r0", "c0", F.concat(F.lit("POLYGON (("), ring, F.lit("))")).alias("t")).alias("_b"))
    text = F.array_join(F.sort_array(F.collect_list("_b")).getField("t"), ", ")
    return parts.groupBy(*keys, "part").agg(F.concat(F.lit("GEOMETRYCOLLECTION ("), text, F.lit(")")).alias("region"))


def individual_envelopes(cells: DataFrame, keys: list[str]) -> DataFrame:
    """One record for each key with a node: n_cells, area_km2, bounds, n_boxes, and region, a collection of its rectangles. The text is made only where it is selected; ``region_texts`` has it in bounded rows."""
    boxes = region_boxes(cells, keys)
    corner = lambda x, y: F.concat(number_text(F.col(x)), F.lit(" "), number_text(F.col(y)))
    box = F.concat(F.lit("POLYGON (("), F.concat_ws(", ", *[corner(x, y) for x, y in (("west", "south"), ("east", "south"), ("east", "north"), ("west", "north"), ("west", "south"))]), F.lit("))"))
    size = F.sum((F.col("r1") - F.col("r0") + 1) * (F.col("c1") - F.col("c0") + 1))
    return boxes.withColumn("_b", F.struct("r0", "c0", box.alias("t"))).groupBy(*keys).agg(
        size.alias("n_cells"), region_area(size).alias("area_km2"), F.min("west").alias("lon_min"), F.max("east").alias("lon_max"), F.min("south").alias("lat_min"), F.max("north").alias("lat_max"), F.count("*").alias("n_boxes"),
        F.concat(F.lit("GEOMETRYCOLLECTION ("), F.array_join(F.sort_array(F.collect_list("_b")).getField("t"), ", "), F.lit(")")).alias("region"),
    )


def combined_envelopes(cells: DataFrame, keys: list[str], lead: str = "step") -> DataFrame:
    """The union over leads for each key, with the leads it spans as 'min-max'."""
    nodes = cells.groupBy(*keys, "r", "c").agg(F.min("lat").alias("lat"), F.min("lon").alias("lon"), F.min(lead).alias("_a"), F.max(lead).alias("_b"))
    span = nodes.groupBy(*keys).agg(F.concat_ws("-", F.min("_a").cast("string"), F.max("_b").cast("string")).alias("lead_range"))
    return individual_envelopes(nodes, keys).join(span, keys)


def required_hours(rows: DataFrame, first: int = 0, column: str = "lead_time") -> DataFrame:
    """The 3-hourly leads that tracks need: their longest lead, up to a multiple of 6, and 12 more, 144 at most; 144 when unknown."""
    top = F.coalesce(F.least(F.ceil(F.max(column) / 6) * 6 + 12, F.lit(144)), F.lit(144)).cast("int")
    return rows.agg(top.alias("hours")).select("hours", F.explode(F.sequence(F.lit(first), F.col("hours"), F.lit(3))).alias("lead_time"))


def cap_members(rows: DataFrame, n: int, by: str) -> DataFrame:
    """Rows of the first n members of each storm, in order. Only the distinct pairs are ranked."""
    pairs = rows.select(by, "ensemble_member").distinct()
    first = pairs.withColumn("_k", F.row_number().over(W.partitionBy(by).orderBy("ensemble_member"))).where(F.col("_k") <= n)
    return rows.join(first.drop("_k"), [by, "ensemble_member"], "left_semi")


def member_completeness(rows: DataFrame, by: list[str], expected: int | None) -> DataFrame:
    out = rows.groupBy(*by).agg(F.countDistinct("ensemble_member").alias("present"))
    want = F.lit(expected).cast("long")
    return out.withColumns({"expected": want, "missing": F.when(want.isNotNull(), F.greatest(want - F.col("present"), F.lit(0)))})


def best_comparison_member(wind: DataFrame, gust: DataFrame, wind_threshold: int = 34, gust_threshold: int = 17) -> DataFrame:
    """The member with most leads of wind regions that has gust regions too; the lowest on ties."""
    have = gust.where(F.col("threshold") == gust_threshold).select("member").distinct()
    n = wind.where(F.col("threshold") == wind_threshold).join(have, "member", "left_semi").groupBy("member").agg(F.countDistinct("step").alias("n_leads"))
    return n.orderBy(F.desc("n_leads"), "member").limit(1)


def comparison_member(wind: DataFrame, gust: DataFrame, member: int) -> DataFrame:
    """The member to compare, one row: the wanted one if it is in both products, else the lowest that is; if none is, the wanted one if it is in either, else the lowest of the gusts, or of the winds."""
    there = wind.select("member", F.lit(True).alias("w"), F.lit(False).alias("g")).union(gust.select("member", F.lit(False), F.lit(True))).groupBy("member").agg(F.max("w").alias("w"), F.max("g").alias("g"))
    both, wanted = F.col("w") & F.col("g"), F.col("member") == member
    rank = F.when(both & wanted, 0).when(both, 1).when(wanted, 2).when(F.col("g"), 3).otherwise(4)
    return there.agg(F.min_by("member", F.struct(rank, F.col("member"))).alias("member")).where("member is not null")


def wind_gust_overlap(wind: DataFrame, gust: DataFrame, last: int = 8, member: int | None = None) -> DataFrame:
    """For each member, or for the one that stands in for ``member``, its last leads at which both products have a region."""
    if member is not None:
        own = F.broadcast(comparison_member(wind, gust, member))
        wind, gust = wind.join(own, "member", "left_semi"), gust.join(own, "member", "left_semi")
    both = wind.select("member", "step").intersect(gust.select("member", "step"))
    return both.withColumn("_k", F.row_number().over(W.partitionBy("member").orderBy(F.desc("step")))).where(F.col("_k") <= last).drop("_k")


def grid_descriptor(field: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Bounds of a cell-centred grid, half a cell out on each side; rows count from the north. A one-node axis has cells of 0.25 degrees."""
    agg = [F.min("lat").alias("s"), F.max("lat").alias("n"), F.countDistinct("lat").alias("height"), F.min("lon").alias("w"), F.max("lon").alias("e"), F.countDistinct("lon").alias("width"), F.min_by("lat", "r").alias("top")]
    g = field.groupBy(*(by or [])).agg(*agg)
    step = lambda lo, hi, k: F.when(F.col(k) > 1, (F.col(hi) - F.col(lo)) / (F.col(k) - 1)).otherwise(GRID)
    dy, dx = step("s", "n", "height") / 2, step("w", "e", "width") / 2
    return g.select(*(by or []), (F.col("w") - dx).alias("west"), (F.col("s") - dy).alias("south"), (F.col("e") + dx).alias("east"), (F.col("n") + dy).alias("north"), "height", "width", (F.col("top") == F.col("n")).alias("north_up"))
