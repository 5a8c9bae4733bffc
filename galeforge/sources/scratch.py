"""Tables that a job writes for itself: in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Spark's limit on the bytes of an Arrow batch, and what it is set to where the session leaves it open.
BATCH_LIMIT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "8m"


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share; a temporary one where it is unset, in local mode only."""
    if shared := spark.conf.get("spark.checkpoint.dir", None):
        return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix=f"spark-{label}-")


def written(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """df written and read again, which cuts its lineage and survives lost executors."""
    path = path or scratch(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession) -> None:
    """From here on Arrow batches of this session end by their bytes, unless it has a limit of its own: else they have 10,000 rows, however long these are."""
    if spark.conf.get(BATCH_LIMIT, None) is None:
        spark.conf.set(BATCH_LIMIT, BATCH_BYTES)
