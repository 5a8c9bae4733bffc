"""Token-id shards with a minimal perfect hash index: raw ids, and constant-time access by document key."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shards_for, shared_path, sliced, table
from .tokens import default_path, encoder

END_ID = 2
#: Bytes of the texts of one shard, about; what a document counts beside its text; bytes of ids that are returned at once.
SHARD_BYTES, ROW_BYTES, PART_BYTES = 12_000_000, 64, 4_000_000
#: Index file: magic, then bytes of an id (2 or 4, as the vocabulary needs), counts of keys, records and hash levels as little-endian 64-bit numbers.
MAGIC = b"TOKMPH01"
#: Positions for each key that is left, at every level of the hash.
GAMMA = 2.0
#: The key that documents with a null id are stored under.
NULL_KEY = -(1 << 63)
MANIFEST = "shard int, first_key long, last_key long, docs long, tokens long, ids_file string, index_file string"


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mixing hash of int64 keys (two rounds of multiply and shift)."""
    x = keys.view(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Distinct keys to 0 .. n-1: at each level a key that alone hits a position owns it, the others go on to the next; a key's number is the rank of its position."""

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.rank = np.cumsum(bits, dtype=np.int64) - bits

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, bits, left = [], [], keys
        while len(left):
            m = max(64, int(GAMMA * len(left)))
            at = (mix(left, len(sizes)) % np.uint64(m)).astype(np.int64)
            alone = np.bincount(at, minlength=m) == 1
            sizes.append(m)
            bits.append(alone)
            left = left[~alone[at]]
        return cls(sizes, np.concatenate(bits).astype(np.uint8) if bits else np.zeros(0, np.uint8))

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 for one that no level owns. A strange key may get any number: fingerprints tell."""
        out, open_, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, m in enumerate(self.sizes):
            at = base + (mix(keys[open_], level) % np.uint64(m)).astype(np.int64)
            hit = self.bits[at] == 1
            out[open_[hit]] = self.rank[at[hit]]
            open_, base = open_[~hit], base + m
        return out


def print_of(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 977) >> np.uint64(32)).astype(np.uint32)


def index_bytes(keys: np.ndarray, offsets: np.ndarray, width: int) -> bytes:
    """The index file of a shard whose records (sorted keys, equal ones together) begin at these token offsets; offsets has one more."""
    distinct, first, count = np.unique(keys, return_index=True, return_counts=True)
    h = PerfectHash.build(distinct)
    slot = h.lookup(distinct)
    prints, records, counts = np.zeros(len(distinct), "<u4"), np.zeros(len(distinct), "<u4"), np.zeros(len(distinct), "<u4")
    prints[slot], records[slot], counts[slot] = print_of(distinct), first, count
    head = MAGIC + struct.pack("<4q", width, len(distinct), len(keys), len(h.sizes)) + np.array(h.sizes, "<i8").tobytes()
    return head + np.packbits(h.bits).tobytes() + prints.tobytes() + records.tobytes() + counts.tobytes() + offsets.astype("<i8").tobytes()


class ShardIndex:
    def __init__(self, raw: bytes):
        if raw[:8] != MAGIC:
            raise ValueError("not a token index file")
        self.width, n, records, levels = struct.unpack_from("<4q", raw, 8)
        at = 40

        def take(kind: str, k: int) -> np.ndarray:
            nonlocal at
            x = np.frombuffer(raw, kind, k, at)
            at += x.nbytes
            return x

        sizes = take("<i8", levels).tolist()
        bits = np.unpackbits(take("u1", -(-sum(sizes) // 8)), count=sum(sizes))
        self.hash = PerfectHash(sizes, bits)
        self.prints, self.records, self.counts = take("<u4", n), take("<u4", n), take("<u4", n)
        self.offsets = take("<i8", records + 1)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First record of each key and how many it has; 0 records where its fingerprint isn't the stored one."""
        slot = self.hash.lookup(keys)
        if not len(self.prints):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        ok = (slot >= 0) & (self.prints[np.maximum(slot, 0)] == print_of(keys))
        return self.records[np.maximum(slot, 0)].astype(np.int64), np.where(ok, self.counts[np.maximum(slot, 0)], 0).astype(np.int64)


def _open(path: str):
    return pafs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1) if path.startswith("file:") else path)


def write_token_store(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Encode every row's text, append end_id, write ids in ascending doc_id order to files below ``path``; returns the manifest.

    Rows are dealt by ranges of doc_id; a task streams its shard's ids to ``ids-*.bin`` and then writes ``index-*.mph``.
    File names have the attempt, and the manifest (a table in path/manifest, one row for each shard) names those of the tasks
    that counted, so retried tasks leave nothing that is read. Null texts are empty; null ids come first, under
    NULL_KEY; equal ids are neighbours, ordered by text. An empty table gives an empty manifest.
    """
    spark, tok = docs.sparkSession, tokenizer or default_path()
    keyed = docs.select(F.coalesce("doc_id", F.lit(NULL_KEY)).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    size = keyed.agg(F.sum(F.octet_length("text") + ROW_BYTES)).first()[0] or 0
    dealt = keyed.repartitionByRange(shards_for(size, SHARD_BYTES), "key").sortWithinPartitions("key", "text")

    def run(batches):
        task = TaskContext.get()
        name = f"{task.partitionId():06d}-{task.taskAttemptId()}"
        fs, base = _open(path)
        fs.create_dir(base, recursive=True)
        coder, keys, sizes = encoder(tok), [], []
        width = 2 if max(coder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        with fs.open_output_stream(f"{base}/ids-{name}.bin") as out:
            for batch in sliced(batches):
                keys.append(batch.column(0).to_numpy().copy())
                rows = [np.append(x, np.uint32(end_id)) for x in coder.encode(batch.column(1).to_pylist())]
                sizes += map(len, rows)
                out.write(np.concatenate(rows).astype(f"<u{width}").tobytes())
        if not sizes:
            fs.delete_file(f"{base}/ids-{name}.bin")
            return
        own = np.concatenate(keys)
        with fs.open_output_stream(f"{base}/index-{name}.mph") as out:
            out.write(index_bytes(own, np.concatenate([[0], np.cumsum(sizes)]), width))
        row = [task.partitionId(), int(own[0]), int(own[-1]), len(own), sum(sizes), f"ids-{name}.bin", f"index-{name}.mph"]
        yield pa.RecordBatch.from_pydict({f.split()[0]: pa.array([v], {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[f.split()[1]]) for f, v in zip(MANIFEST.split(", "), row, strict=True)})

    dealt.mapInArrow(run, MANIFEST).write.parquet(f"{path}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def read_token_store(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids as little-endian unsigned 32-bit) of every stored document whose doc_id is in the one column of ``keys``, from the files.

    A key goes to the shard with its range (the manifest has one row for each shard, and is what the driver reads), there through the
    hash to its record and, if the fingerprint agrees, to its ids. ``start`` counts the ids of all documents before it in the store.
    Keys that aren't stored give no row, a null key the documents without an id; keys that repeat are asked once.
    """
    shards = spark.read.schema(MANIFEST).parquet(f"{path}/manifest").orderBy("shard").collect()
    first = np.array([r["first_key"] for r in shards], np.int64)
    base_of = np.concatenate([[0], np.cumsum([r["tokens"] for r in shards])]).astype(np.int64)
    files = [(r["ids_file"], r["index_file"]) for r in shards]

    def place(batches):
        for batch in batches:
            k = batch.column(0).to_numpy()
            at = np.searchsorted(first, k, side="right") - 1
            ok = at >= 0
            yield pa.RecordBatch.from_arrays([pa.array(k[ok]), pa.array(at[ok].astype(np.int32))], names=["key", "shard"])

    def fetch(batches):
        at, index, ids = -1, None, None
        fs, base = _open(path)
        for batch in batches:
            shard_of = batch.column(1).to_numpy()
            cut = np.r_[0, np.flatnonzero(shard_of[1:] != shard_of[:-1]) + 1, len(shard_of)] if len(shard_of) else [0]
            for i, j in zip(cut[:-1], cut[1:], strict=True):  # keys of one shard stand together
                if at != shard_of[i]:
                    at = int(shard_of[i])
                    with fs.open_input_stream(f"{base}/{files[at][1]}") as f:
                        index = ShardIndex(f.read())
                    if ids is not None:
                        ids.close()
                    ids = fs.open_input_file(f"{base}/{files[at][0]}")
                k = batch.column(0).to_numpy()[i:j]
                record, count = index.find(k)
                k, record, count = k[count > 0], record[count > 0], count[count > 0]
                place = np.repeat(record, count) + np.concatenate([np.arange(c) for c in count] or [np.zeros(0, int)])
                k, begin, end = np.repeat(k, count), index.offsets[place], index.offsets[place + 1]
                part = (np.cumsum(end - begin) - 1) * 4 // PART_BYTES if len(k) else begin
                for some in np.split(np.arange(len(k)), np.flatnonzero(part[1:] != part[:-1]) + 1):
                    if len(some):
                        yield read(ids, index.width, k[some], begin[some], end[some], base_of[at])
        if ids is not None:
            ids.close()

    def read(f, width, k, begin, end, base):
        out = []
        for a, b in zip(begin.tolist(), end.tolist(), strict=True):
            f.seek(width * a)
            out.append(np.frombuffer(f.read(width * (b - a)), f"<u{width}").astype("<u4").tobytes())
        return pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(begin + base, pa.int64()), pa.array(end - begin, pa.int64()), pa.array(out, pa.binary())], names=["key", "start", "n_tokens", "ids"])

    asked = keys.select(F.coalesce(F.col(keys.columns[0]), F.lit(NULL_KEY)).cast("long").alias("key")).distinct()
    placed = asked.mapInArrow(place, "key long, shard int").repartition(max(1, min(len(shards), 10_000)), "shard")  # keys are small, what they fetch isn't
    found = placed.sortWithinPartitions("shard", "key").mapInArrow(fetch, "key long, start long, n_tokens long, ids binary")
    return found.select(F.when(F.col("key") != NULL_KEY, F.col("key")).alias("doc_id"), "start", "n_tokens", "ids")


def op10_tokenids(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = shared_path(spark, "tokens")
    write_token_store(docs, path)
    return read_token_store(spark, path, docs.select("doc_id")).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
