"""Shared helpers: the shared folder, written tables that cut lineage, word splitting."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than space, tab, LF, VT, FF and CR. ``bytes.split()`` cuts UTF-8 at exactly these.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

#: Bytes of Arrow data that become Python values at once; a longer row is one by itself.
SLICE_BYTES = 4_000_000

#: Spark's limit on the bytes of an Arrow batch, and what it is set to where the session leaves it open.
BATCH_LIMIT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "8m"

_local: dict[str, str] = {}

#: Paths given out by shared_path and not removed by tidy, in order.
_given: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which driver and executors share.

    Where it is unset a temporary folder is made, in local mode only: on a cluster a folder of one
    machine would lose files, so that is an error.
    """
    if given := spark.conf.get("spark.checkpoint.dir", None):
        return given.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _local:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        _local[app] = "file://" + tempfile.mkdtemp(prefix="spark-llm-")
    return _local[app]


def shared_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that is not used yet."""
    _given.append(f"{shared_dir(spark)}/llm/{label}-{uuid.uuid4().hex}")
    return _given[-1]


def bound_batches(spark: SparkSession) -> None:
    """From here on Arrow batches of this session end by their bytes, unless it has a limit of its own.

    Else they have 10,000 rows whatever their length, and what an executor's JVM once took for them outside its heap stays with it.
    """
    if spark.conf.get(BATCH_LIMIT, None) is None:
        spark.conf.set(BATCH_LIMIT, BATCH_BYTES)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it again: later steps neither recompute it nor lose it with an executor. Bounds the session's Arrow batches."""
    spark = df.sparkSession
    bound_batches(spark)
    path = shared_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table written by this library that nothing reads any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def mark() -> int:
    """Where the list of intermediate tables stands now, for ``tidy``."""
    return len(_given)


def tidy(spark: SparkSession, since: int, keep: int = 1) -> None:
    """Delete the intermediate tables that were begun since a mark, but the last ``keep``: for when what was made of the others is written and nothing reads them any more."""
    end = len(_given) - keep
    for path in _given[since:end]:
        remove(spark, path)
    del _given[since:end]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id"):
    """True where crc32 of the id as text leaves remainder 1 by 3; null ids count as held out, so nothing is learnt from them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def share_of(column: str, fraction: float):
    """True for a repeatable share of the keys, chosen by their hash."""
    return F.pmod(F.xxhash64(F.lit("share"), F.col(column)), F.lit(1 << 30)) < F.lit(int(min(1.0, fraction) * (1 << 30)))


#: Words of 64 bits in the table that split_by broadcasts, at most.
SPLIT_WORDS = 1 << 18


def split_by(rows: DataFrame, key, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows in two parts: the first has every row whose key (a long) is in the one column of ``members``, and a few others.

    What is broadcast is a bitmap of fixed size, 4 MB at most whatever the members: with very many of them the first part
    gets more of the other rows, so it must still be joined. The second part needs no shuffle.
    """
    place = lambda k: F.pmod(F.shiftrightunsigned(k, 6), F.lit(SPLIT_WORDS)).cast("int")
    bit = lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), k.bitwiseAND(F.lit(63)).cast("int"))
    m = F.col(members.columns[0])
    words = members.select(place(m).alias("w"), bit(m).alias("b")).groupBy("w").agg(F.bit_or("b").alias("bits"))
    k, w, bits = private("k", rows), private("w", rows), private("bits", rows)
    words = words.select(F.col("w").alias(w), F.col("bits").alias(bits))
    marked = rows.withColumn(k, key).withColumn(w, place(F.col(k))).join(F.broadcast(words), w, "left")
    inside = F.coalesce(F.col(bits).bitwiseAND(bit(F.col(k))) != 0, F.lit(False))
    return marked.where(inside).select(*rows.columns), marked.where(~inside).select(*rows.columns)


def shards_for(rows: int, per_shard: int, most: int = 50_000) -> int:
    """Partitions for so many rows; beyond ``most`` they grow larger instead, and are worked through in blocks."""
    return max(1, min(most, -(-rows // per_shard)))


def private(name: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has, whatever the case of its letters."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def sliced(batches, columns=None, most: int = SLICE_BYTES):
    """The same rows in Arrow batches of at most about ``most`` bytes in these columns (all, if None), whatever the size of the given batches."""
    for batch in batches:
        size = np.full(batch.num_rows, 8, np.int64)
        for i in range(batch.num_columns) if columns is None else columns:
            x = batch.column(i)
            if pa.types.is_string(x.type) or pa.types.is_binary(x.type) or pa.types.is_large_string(x.type) or pa.types.is_large_binary(x.type):
                size += pc.fill_null(pc.binary_length(x), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (np.cumsum(size) - 1) // most
        cut = np.r_[0, np.flatnonzero(part[1:] != part[:-1]) + 1, batch.num_rows] if batch.num_rows else [0, 0]
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            yield batch.slice(int(a), int(b - a))


def release() -> None:
    """Give memory that this Python worker no longer uses back to the system; what one stage needed would otherwise stay beside what the next one needs."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def per_row(docs: DataFrame, inputs: list[str], start, outputs: dict[str, str], keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns as they are, and new ones made in Arrow batches of whole rows, of about SLICE_BYTES each.

    ``start()`` is called once in each task and returns a function from {input: list of values} to {output: values}, row
    for row. Kept columns never become Python values, so long ids stay exact beside nulls. A kept column may not have the
    name of an output.
    """
    types = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    names = list(keep)
    if clash := {c.lower() for c in names} & {c.lower() for c in outputs}:
        raise ValueError(f"columns {sorted(clash)} are kept and made")
    kinds = {f.name: f.dataType.simpleString() for f in docs.select(*names).schema}

    def run(batches):
        make = start()
        for batch in sliced(batches):
            new = make({c: batch.column(batch.schema.get_field_index(c)).to_pylist() for c in inputs})
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in names] + [pa.array(new[c], types[k]) for c, k in outputs.items()], names=[*names, *outputs]
            )
        del make
        release()

    schema = ", ".join(f"`{c}` {k}" for c, k in (kinds | outputs).items())
    return docs.select(*dict.fromkeys([*names, *inputs])).mapInArrow(run, schema)
