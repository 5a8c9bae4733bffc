"""A keyed table in buckets of its key: a merge reads and rewrites the buckets that its source touches, and no others."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.warehouse import first_of_key, null_in, upsert

BUCKET = "key_bucket"


@dataclass
class KeyedTable:
    """Parquet below ``path``, a folder for each of ``buckets`` hashes of ``key``; ``schema`` has the table's own columns.

    With buckets of about a file each, a source of k keys touches at most k of them. Rows with a null in the key match nothing; they are spread over all buckets by all their columns. Merges replace whole bucket folders when
    the job commits, so one writer at a time; a merge that fails before that leaves the table as it was, and one that is repeated changes nothing more.
    """

    spark: SparkSession
    path: str
    schema: str
    key: list[str]
    buckets: int

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        own = F.when(null_in(self.key), F.xxhash64(*rows.columns)).otherwise(F.xxhash64(*self.key))
        return rows.withColumn(BUCKET, F.pmod(own, F.lit(self.buckets)).cast("int"))

    def _write(self, rows: DataFrame, mode: str) -> None:
        """Rows by bucket, each bucket's by one task; ``overwrite`` replaces only the buckets that the rows have."""
        out = rows.repartition(BUCKET).sortWithinPartitions(BUCKET, *self.key)
        out.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path)

    def _all(self) -> DataFrame:
        return self.spark.read.schema(f"{self.schema}, {BUCKET} int").parquet(self.path)

    @classmethod
    def create(cls, rows: DataFrame, path: str, key: list[str], buckets: int) -> KeyedTable:
        out = cls(rows.sparkSession, path, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), key, buckets)
        out._write(out._bucketed(rows), "overwrite")
        return out

    def read(self) -> DataFrame:
        return self._all().drop(BUCKET)

    def touched(self, source: DataFrame) -> list[int]:
        """The buckets that the source's keys lie in: as many numbers as there are buckets, at most."""
        keyed = source.where(~null_in(self.key))
        return sorted(r[0] for r in self._bucketed(keyed).select(BUCKET).distinct().collect())

    def part(self, buckets: list[int]) -> DataFrame:
        """The rows of some buckets; the others' files are not listed for the scan (partition filter)."""
        return self._all().where(F.col(BUCKET).isin(buckets) if buckets else F.lit(False))

    def upsert(self, source: DataFrame, updates: list[str], when: Column, order: list) -> list[int]:
        """Bring the source in by ``warehouse.upsert``; returns the rewritten buckets."""
        some = self.touched(source)
        rows = source.select(*self.read().columns)
        if some:
            merged = upsert(self.part(some).drop(BUCKET), rows.where(~null_in(self.key)), self.key, updates, when, order)
            self._write(self._bucketed(merged), "overwrite")
        loose = rows.where(null_in(self.key))
        if not loose.isEmpty():
            self._write(self._bucketed(loose), "append")
        return some

    def insert_missing(self, source: DataFrame, order: list) -> list[int]:
        """Append the source rows whose key is not there; keys are read of the touched buckets only, and no file is rewritten."""
        some = self.touched(source)
        rows = self._bucketed(first_of_key(source.select(*self.read().columns), self.key, order))
        self._write(rows.join(self.part(some).select(BUCKET, *self.key), [BUCKET, *self.key], "left_anti").select(*rows.columns), "append")
        return some
