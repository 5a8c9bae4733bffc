"""Reading the tables a query is given."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


#: Rows of a table that a task takes when they are dealt by a key.
ROWS_A_TASK = 250_000


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def dealt(rows: DataFrame, n_rows: int, *keys: str) -> DataFrame:
    """Rows by key, in so many parts that each has about ``ROWS_A_TASK`` of ``n_rows`` and no task grows with the table.

    Left to adaptive execution, parts are joined by their bytes in the shuffle, which says little where rows are laid out twelvefold after it; a number that is asked for stays. Aggregates and joins by the keys, or by more, follow without a shuffle.
    """
    return rows.repartition(max(8, -(-n_rows // ROWS_A_TASK)), *keys)
