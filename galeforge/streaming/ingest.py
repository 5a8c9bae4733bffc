"""Idempotent loading of newly landed files."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Keys seen so far live in a store on the executors' disks, with its changes kept beside the checkpoint; memory doesn't hold them.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """The session with these settings for a while."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def file_stream_ingest(spark: SparkSession, landing: str, schema: str, target: str, checkpoint: str, keys: list[str], most_files: int = 1000, event_time: str | None = None, lateness: str | None = None) -> DataFrame:
    """Bring all files that landed since the last call into ``target`` and return it: the first row of each key that ever came.

    A file stream with a checkpoint sees each file once. Keys that came before are looked up in the stream's state, so a batch costs what it holds, however much came earlier; the target's own log says which files
    count, so a batch that runs twice after a failure counts once. With ``event_time`` and ``lateness`` keys are forgotten once the watermark has passed them by that much, which bounds the state. Of several rows of a
    key in one batch one stays, and it is open which. Rows with equal keys count nulls as equal.
    """
    with settings(spark, STATE):
        rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", most_files).parquet(landing)
        if event_time:
            fresh = rows.withWatermark(event_time, lateness or "0 seconds").dropDuplicatesWithinWatermark(keys)
        else:
            fresh = rows.dropDuplicates(keys)
        fresh.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return ingested(spark, schema, target)


def ingested(spark: SparkSession, schema: str, target: str) -> DataFrame:
    """The rows of all batches that are complete."""
    return spark.read.schema(schema).parquet(target)
