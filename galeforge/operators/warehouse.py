"""Cleaning rows and bringing them into keyed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TRACK_KEY = ["track_id", "ensemble_member", "forecast_time", "lead_time"]


def prepare_rows(rows: DataFrame, times: list[str], region: str | None = None) -> DataFrame:
    """Upper-case names; times parsed leniently and written one way; NaN and infinities null; floats to 6 digits; empty, 'None' and 'null' regions null, others trimmed."""
    out = []
    for f in rows.schema:
        c = F.col(f"`{f.name}`")
        if f.name in times:
            c = F.date_format(F.coalesce(*[F.try_to_timestamp(c.cast("string"), F.lit(p)) for p in ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd")]), "yyyy-MM-dd HH:mm:ss")
        elif f.name == region:
            t = F.trim(c)
            c = F.when(~t.isin("", "None", "null"), t)
        elif f.dataType.typeName() in ("double", "float"):
            c = F.when(~F.isnan(c) & (F.abs(c) < float("inf")), F.round(c, 6))
        out.append(c.alias(f.name.upper()))
    return rows.select(*out)


def null_in(key: list[str]) -> Column:
    """True where a key column is null."""
    return F.exists(F.array(*[F.col(c).isNull() for c in key]), lambda x: x)


def first_of_key(rows: DataFrame, key: list[str], order: list) -> DataFrame:
    """One row for each key, so that an update is never ambiguous; rows with a null in the key all stay, as nulls never match, and go around the shuffle."""
    k = F.row_number().over(W.partitionBy(*key).orderBy(*order))
    ranked = rows.where(~null_in(key)).withColumn("_k", k).where(F.col("_k") == 1).drop("_k")
    return ranked.unionByName(rows.where(null_in(key)))


def insert_missing(target: DataFrame, source: DataFrame, key: list[str], order: list) -> DataFrame:
    """The target, and the source rows whose key it lacks; rows that are there stay as they are."""
    return target.unionByName(first_of_key(source, key, order).join(target.select(*key), key, "left_anti").select(*target.columns))


def upsert(target: DataFrame, source: DataFrame, key: list[str], updates: list[str], when: Column, order: list) -> DataFrame:
    """The target with ``updates`` taken from the source row of the same key where ``when`` (over s_ columns) holds, and the source's other keys.

    A full outer join on the key: null keys match nothing, so they stay on either side.
    """
    s = first_of_key(source, key, order).select(*[F.col(c).alias(f"s_{c}") for c in target.columns], F.lit(True).alias("s_there"))
    t = target.withColumn("t_there", F.lit(True))
    j = t.join(s, [F.col(c) == F.col(f"s_{c}") for c in key], "full")
    new = F.col("t_there").isNull()
    take = F.col("s_there").isNotNull() & when
    return j.select(*[F.when(new | take if c in updates else new, F.col(f"s_{c}")).otherwise(F.col(c)).alias(c) for c in target.columns])


def upsert_if_region(target: DataFrame, source: DataFrame, key: list[str], load_time: Column, region: str = "region") -> DataFrame:
    """A matching key takes region, valid time and load time from the source if its region is there; new keys come in either way."""
    stamped = source.withColumn("loaded_at", load_time)
    updates = [c for c in (region, "valid_time", "lead_range_start", "loaded_at") if c in target.columns]
    return upsert(target, stamped, key, updates, F.col(f"s_{region}").isNotNull(), [F.col(region).isNull(), region])


def upsert_combined(target: DataFrame, source: DataFrame, key: list[str], load_time: Column) -> DataFrame:
    """The same keyed without a lead; the start of the lead range goes along."""
    return upsert_if_region(target, source.withColumn("lead_range_start", lead_range_start(F.col("lead_range"))), key, load_time)


def lead_range_start(x: Column) -> Column:
    return F.split_part(x, F.lit("-"), F.lit(1)).try_cast("int")


_NUMBER = r"-?[0-9]+(?:\.[0-9]+)?"
_PAIR = rf"({_NUMBER}) ({_NUMBER})"
_SHAPE = rf"^(POLYGON|MULTIPOLYGON|GEOMETRYCOLLECTION) \((?:[A-Z() ,]|{_NUMBER} {_NUMBER})+\)$"


def safe_region(x: Column) -> Column:
    """The text if it reads as geometry: known form, longitudes within +-180, latitudes within +-90, every ring of four or more points closed; else null."""
    lons, lats = F.regexp_extract_all(x, F.lit(_PAIR), 1), F.regexp_extract_all(x, F.lit(_PAIR), 2)
    rings = F.regexp_extract_all(x, F.lit(r"\(([^()]+)\)"), 1)
    within = lambda a, m: F.forall(a, lambda v: F.abs(v.cast("double")) <= m)
    points = lambda r: F.split(r, ", ?")
    closed = F.forall(rings, lambda r: (F.size(points(r)) >= 4) & (F.element_at(points(r), 1) == F.element_at(points(r), -1)))
    return F.when(x.rlike(_SHAPE) & (F.size(lons) > 0) & within(lons, 180) & within(lats, 90) & closed, x)


def upsert_pointer(target: DataFrame, source: DataFrame, key: list[str], order: list) -> DataFrame:
    """The source's path, and stand-in flag, for its keys; other pointers stay."""
    return upsert(target, source, key, [c for c in target.columns if c not in key], F.lit(True), order)


def evolve_schema(rows: DataFrame, name: str, kind: str) -> DataFrame:
    """With one more nullable column, unless it is there."""
    return rows if name in rows.columns else rows.withColumn(name, F.lit(None).cast(kind))


def append_evolved(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new, allowMissingColumns=True)


def drop_identity(rows: DataFrame) -> DataFrame:
    return rows.drop("storm_identifier", "long_storm_name")


def table_counts(spark, tables: dict[str, DataFrame | None]) -> DataFrame:
    """Rows of each table in one query; null for those that aren't available."""
    parts = [(df.agg(F.count("*").alias("n")) if df is not None else spark.range(1).select(F.lit(None).cast("long").alias("n"))).select(F.lit(name).alias("table_name"), "n", F.lit(df is not None).alias("available")) for name, df in sorted(tables.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def load_plan(files: DataFrame) -> DataFrame:
    """(path, target, recognised) of a catalogue, without loading anything."""
    from ..sources.catalog import route_to_table

    return files.select("path", route_to_table(F.col("path")).alias("target")).withColumn("recognised", F.col("target").isNotNull())
