"""Files as tables: reading raw tracks, and what file names and times say."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import MEMBERS, RAW_SCHEMA, TIER_SOURCE

#: Where files of each target table lie. Tested in order, so gust rules come before the shorter ones.
TRACKS_PREFIX, ENVELOPES_PREFIX = "tracks/", "envelopes/"
ENVELOPE_RULES = [
    ("gust_envelopes_individual", "TC_GUST_ENVELOPES_INDIVIDUAL"),
    ("gust_envelopes_combined", "TC_GUST_ENVELOPES_COMBINED"),
    ("individual", "TC_ENVELOPES_INDIVIDUAL"),
    ("combined", "TC_ENVELOPES_COMBINED"),
]


def read_raw_tracks(spark: SparkSession, path: str) -> DataFrame:
    """Raw track files, each by its own header. Identity columns stay text as written ("007", padding), empty text is not null; absent ones are null.

    One scan of lines, whatever the number of headers: a file's header, the first line of its first block, is joined to its lines, and says at which place a column's value lies. Quotes are read as CSV, doubled inside; a
    line end inside quotes is not. Lines with fewer values than the header have nulls for the rest, columns that no schema knows are left out, of repeated ones the first counts.
    """
    kinds = {x.split()[0]: x.split()[1] for x in RAW_SCHEMA.split(", ")}
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
    none = F.try_element_at(F.collect_list(F.when(F.col("at") > 0, F.col("value"))), F.lit(1))  # an aggregate with a list is kept by file in a hash map; a text alone would have all lines sorted
    first = lines.where("at = 0").groupBy("file").agg(F.coalesce(F.first("value"), none).alias("header"))
    most = first.agg(F.coalesce(F.max(F.size(F.split("header", ","))), F.lit(1)).alias("n")).first()["n"]
    fields = ", ".join(f"c{k} string" for k in range(most))
    options = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "emptyValue": "", "nullValue": "\x00", "escape": '"', "mode": "PERMISSIVE"}
    cells = lambda rows, c, name: rows.withColumn("_s", F.from_csv(c, fields, options)).withColumn(name, F.array(*[F.col(f"_s.c{k}") for k in range(most)])).drop("_s")
    headers = cells(first, "header", "names")
    place = [F.array_position("names", F.lit(c)).alias(f"at_{c}") for c in kinds]
    rows = cells(lines.join(headers.select("file", "header", *place), "file").where((F.col("value") != F.col("header")) & (F.col("value") != "")), "value", "cells")
    text = {"storm_id", "storm_identifier", "long_storm_name"}

    def value(c, k):
        own = F.when(F.col(f"at_{c}") > 0, F.element_at("cells", F.greatest(F.col(f"at_{c}"), F.lit(1)).cast("int")))
        return (F.when(F.col(f"at_{c}") > 0, F.coalesce(own, F.lit(""))) if c in text else F.nullif(F.trim(own), F.lit("")).try_cast(k)).alias(c)

    return rows.select(*[value(c, k) for c, k in kinds.items()])


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def storm_from_path(path: Column) -> Column:
    """The storm of a track file's name: after _storm_, after tropical_cyclone_track_, else the stem without _transformed."""
    name = base_name(path)
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    marked = F.regexp_extract(name, "_storm_([A-Z0-9-]+)_", 1)
    return (
        F.when(name.contains("_storm_"), F.when(marked != "", marked).otherwise(stem))
        .when(name.contains("tropical_cyclone_track_"), F.substring_index(F.split_part(name, F.lit("tropical_cyclone_track_"), F.lit(2)), "_", 1))
        .otherwise(F.replace(stem, F.lit("_transformed"), F.lit("")))
    )


def run_from_path(path: Column) -> Column:
    """Forecast date and hour of YYYY-MM-DD_rHH in a name; null without it."""
    day, hour = (F.regexp_extract(path, r"(\d{4}-\d{2}-\d{2})_r(\d{2})", k) for k in (1, 2))
    return F.when(day != "", F.try_to_timestamp(F.concat(day, F.lit(" "), hour), F.lit("yyyy-MM-dd HH"))).cast("timestamp_ntz")


def field_file_catalog(files: DataFrame, column: str = "file_name") -> DataFrame:
    """Names like wind_ens_DATE_rHH_fLLLh_pf.grib2 as kind, run, lead, member_type; other names are left out."""
    pattern = r"^(wind|gust)_ens_(\d{4}-\d{2}-\d{2})_r(\d{2})_f(\d{3})h_(pf|cf)\.grib2$"
    part = lambda k: F.regexp_extract(base_name(F.col(column)), pattern, k)
    out = files.withColumns({"kind": part(1), "run": run_from_path(F.col(column)), "lead": part(4).try_cast("int"), "member_type": part(5)})
    return out.where("kind <> ''")


def match_files(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    """Rows of (run, lead, ensemble_member) with the file that has them: the control's for member 51, the perturbed members' else. Runs must agree."""
    typed = rows.withColumn("member_type", F.when(F.col("ensemble_member") == MEMBERS, "cf").otherwise("pf"))
    return typed.join(catalog, ["run", "lead", "member_type"], "left")


def lead_times_for_run(catalog: DataFrame, kind: str, run: Column | None = None) -> DataFrame:
    """Leads of a run's files of a kind; of the newest run if none is given."""
    own = catalog.where(F.col("kind") == kind)
    own = own.where(F.col("run") == run) if run is not None else own.join(F.broadcast(own.agg(F.max("run").alias("run"))), "run", "left_semi")
    return own.select("lead").distinct().orderBy("lead")


def modified_since(files: DataFrame, cutoff: Column, column: str = "modified") -> DataFrame:
    return files.where(F.col(column) >= cutoff)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and time of files, without reading them."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", F.col("modificationTime").alias("modified"))


def route_to_table(path: Column) -> Column:
    """The table that a file's prefix and name say it belongs to; null for others."""
    name = base_name(path)
    rules = F.when(name.contains(ENVELOPE_RULES[0][0]), ENVELOPE_RULES[0][1])
    for part, table in ENVELOPE_RULES[1:]:
        rules = rules.when(name.contains(part), table)
    return F.when(path.startswith(TRACKS_PREFIX), "TC_TRACKS").when(path.startswith(ENVELOPES_PREFIX), rules)


def river_pointer_rows(files: DataFrame, day: str) -> DataFrame:
    """Pointer rows of one day's river files: discharge, and one for each tier with its stand-in flag; other names are left out."""
    name = base_name(F.col("path"))
    rp = F.regexp_extract(name, rf"^river_extent_rp(\d+(?:\.\d+)?)_bymask_{day}\.parquet$", 1)
    stands = F.create_map(*[F.lit(x) for rp_, src in TIER_SOURCE.items() for x in (rp_, rp_ != src)])
    tier = F.floor(rp.try_cast("double")).cast("int")
    param = F.when(name == f"river_{day}.zarr.zip", "dis24").when(rp != "", F.concat(F.lit("extent_bymask_rp"), tier.cast("string")))
    return files.select(F.lit(day).alias("forecast_time"), param.alias("param"), F.col("path").alias("stage_path"), F.when(rp != "", F.try_element_at(stands, tier)).alias("is_standin")).where("param is not null")
