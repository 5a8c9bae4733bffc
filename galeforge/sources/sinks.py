"""Writing hazard tables; each returns the table read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import box_ranges, in_ranges, interleave, morton_ranges
from ..operators.rivers import with_morton
from ..schemas import CELL_DEG


def _back(df: DataFrame, path: str) -> DataFrame:
    """With the types that were written: partition values such as "007" or a day would else be guessed from their text."""
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_per_storm(rows: DataFrame, path: str, storm: str = "storm_id") -> DataFrame:
    """One folder for each storm. Rows of a storm are brought together first, so there are few files; adaptive execution splits a storm of very many rows over several tasks."""
    rows.hint("rebalance", storm).write.mode("overwrite").partitionBy(storm).parquet(path)
    return _back(rows, path)


def write_partitioned(rows: DataFrame, path: str, *by: str) -> DataFrame:
    """Rows by partition columns; only the partitions that the rows have are replaced."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    return _back(rows, path)


def write_sparse_discharge(rows: DataFrame, path: str) -> DataFrame:
    return write_partitioned(rows, path, "forecast_date")


def write_accumulated(rows: DataFrame, path: str) -> DataFrame:
    return write_partitioned(rows, path, "forecast_time", "param")


def write_extent(rows: DataFrame, path: str, lat: str = "pixel_lat", lon: str = "pixel_lon", group_bytes: int = 16 << 20) -> DataFrame:
    """Pixels in Morton order by zstd files of bounded row groups, so a box reads few of them; their key stays as ``morton``. Nothing is there until the job commits."""
    keyed = with_morton(rows, lat, lon)
    keyed.repartitionByRange("rp", "morton").sortWithinPartitions("rp", "morton", lat, lon).write.mode("overwrite").option("compression", "zstd").option("parquet.block.size", group_bytes).parquet(path)
    return _back(keyed, path)


def read_extent_box(extent: DataFrame, lat_min: float, lat_max: float, lon_min: float, lon_max: float, lat: str = "pixel_lat", lon: str = "pixel_lon", most: int = 16) -> DataFrame:
    """Pixels of a written extent inside a box, ends inclusive: a few intervals of the Morton key reach the scan, which skips row groups and pages by them; the exact bounds follow."""
    near = extent.where(in_ranges(F.col("morton"), box_ranges(lat_min, lat_max, lon_min, lon_max, CELL_DEG, most)))
    return near.where(F.col(lat).between(lat_min, lat_max) & F.col(lon).between(lon_min, lon_max)).drop("morton")


def blocks_of(cells: DataFrame, keys: list[str], value: str = "value", size: tuple[int, int] = (64, 64)) -> DataFrame:
    """(keys, block_row, block_col, values): grid cells (row, col) as packed blocks, one array of size[0] x size[1] in row order for each, null where there is no cell.

    A block is bounded, so is what meets in a task; of several cells at one place the largest stays. Cells lie in order of place with nulls between them, so a block takes time by its size, not by its square.
    """
    place = (F.pmod("row", F.lit(size[0])) * size[1] + F.pmod("col", F.lit(size[1]))).cast("int")
    at = cells.where(F.col("row").isNotNull() & F.col("col").isNotNull()).groupBy(*keys, F.floor(F.col("row") / size[0]).cast("int").alias("block_row"), F.floor(F.col("col") / size[1]).cast("int").alias("block_col"), place.alias("_p")).agg(F.max(value).alias("_v"))
    held = at.groupBy(*keys, "block_row", "block_col").agg(F.array_sort(F.collect_list(F.struct("_p", "_v"))).alias("_e"))
    gap = lambda n: F.array_repeat(F.lit(None).cast(at.schema["_v"].dataType), n)
    after = lambda x, k: F.concat(gap(x["_p"] - F.coalesce(F.get(F.col("_e"), k - 1)["_p"], F.lit(-1)) - 1), F.array(x["_v"]))
    end = gap(size[0] * size[1] - 1 - F.try_element_at("_e", F.lit(-1))["_p"])
    return held.select(*keys, "block_row", "block_col", F.concat(F.flatten(F.transform("_e", after)), end).alias("values"))


def write_blocks(cells: DataFrame, path: str, keys: list[str], value: str = "value", size: tuple[int, int] = (64, 64), group_bytes: int = 16 << 20) -> DataFrame:
    """Packed blocks, neighbours in Z-order together, in files of bounded row groups."""
    out = blocks_of(cells, keys, value, size).withColumn("block", F.shiftleft(interleave(F.col("block_row")), 1).bitwiseOR(interleave(F.col("block_col"))))
    out.repartitionByRange("block", *keys).sortWithinPartitions("block", *keys).write.mode("overwrite").option("compression", "zstd").option("parquet.block.size", group_bytes).parquet(path)
    return _back(out, path)


def read_block_crop(blocks: DataFrame, keys: list[str], rows: tuple[int, int], cols: tuple[int, int], size: tuple[int, int] = (64, 64), most: int = 16) -> DataFrame:
    """(keys, row, col, value) of every grid node of a crop, ends inclusive, null where a stored block has no cell. Only the blocks that the crop touches are read; filters on keys go along."""
    span = lambda x, n: (x[0] // n, x[1] // n)
    (r0, r1), (c0, c1) = span(rows, size[0]), span(cols, size[1])
    near = blocks.where(in_ranges(F.col("block"), morton_ranges((r0, r1), (c0, c1), most)) & F.col("block_row").between(r0, r1) & F.col("block_col").between(c0, c1))
    cells = near.select(*keys, "block_row", "block_col", F.posexplode("values").alias("_p", "value"))
    out = cells.select(*keys, (F.col("block_row") * size[0] + F.floor(F.col("_p") / size[1])).cast("int").alias("row"), (F.col("block_col") * size[1] + F.col("_p") % size[1]).cast("int").alias("col"), "value")
    return out.where(F.col("row").between(*rows) & F.col("col").between(*cols))


def append_rows(rows: DataFrame, path: str) -> DataFrame:
    """Plain append, repeated rows and all."""
    rows.write.mode("append").parquet(path)
    return _back(rows, path)


def stamp(rows: DataFrame, **values) -> DataFrame:
    return rows.withColumns({k: F.lit(v) for k, v in values.items()})
