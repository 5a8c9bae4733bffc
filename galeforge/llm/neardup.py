"""One document of each group of near-duplicates: SimHash tables propose pairs, MinHash bands those beyond their radius, whole sets decide."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, private, sliced, split_by
from .components import connected_components, spanning
from .simhash import fingerprint_of, hashes, linked_fingerprints

#: Words of a shingle. Texts are alike from a similarity of 4 / 5.
SHINGLE, OVER, UNDER = 5, 4, 5
#: Bands, and least hashes in each: two sets of similarity 0.8 share no band in three of a million cases.
BANDS, ROWS, SEED = 24, 4, 15
#: Sets, and hashes in them, of a block; a task compares two. Owners of a value up to which pairs of them are listed; columns of a matrix.
BLOCK, BLOCK_HASHES, RARE, COLUMNS = 1024, 500_000, 16, 1024
#: Hashes whose values under all functions are made at once.
STEP = 4096

_RANDOM = np.random.default_rng(SEED)
_XOR, _TIMES = (_RANDOM.integers(0, 1 << 64, (BANDS * ROWS, 1), np.uint64) | np.uint64(k) for k in (0, 1))
_FOLD = _RANDOM.integers(0, 1 << 64, (BANDS, ROWS), np.uint64) | np.uint64(1)


def shingle_set(blocks: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *blocks]))


def bands(own: np.ndarray) -> np.ndarray:
    """The key of each band of a set's least hashes; none for a set too small to be like any but itself."""
    if len(own) < OVER:
        return np.zeros(0, np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for i in range(0, len(own), STEP):
        x = (own[None, i : i + STEP] ^ _XOR) * _TIMES
        x ^= x >> np.uint64(31)
        least = np.minimum(least, x.min(axis=1))
    key = (least.reshape(BANDS, ROWS) * _FOLD).sum(axis=1, dtype=np.uint64)
    return ((key ^ (key >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]), pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *parts]), pa.int64()))


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, cls, n, fp, bands) of every row; equal cls, a hash of the whole set, means equal sets; n is its size."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in sliced(batches):
            cls, n, fp, keys = [], [], [], []
            for text in batch.column(1).to_pylist():
                blocks = list(hashes(text, SHINGLE))
                own = shingle_set(blocks)
                cls.append(xxhash.xxh64_intdigest(own.tobytes(), 42))
                n.append(len(own))
                fp.append(fingerprint_of(blocks))
                keys.append(bands(own))
            signed = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), signed(cls), pa.array(n, pa.int64()), signed(fp), _lists(keys)], names=["doc_id", "text_hash", "cls", "n", "fp", "bands"])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(run, f"doc_id {kind}, text_hash long, cls long, n long, fp long, bands array<long>")


def _key(doc_id, text_hash):
    """One text for a row's id and text."""
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("-")), text_hash.cast("string"))


def _sizes_fit(n, m):
    return F.least(n, m) * UNDER >= F.greatest(n, m) * OVER


def _pairs(rows: DataFrame, a: str, b: str) -> DataFrame:
    return rows.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))


def _with_hub(entries: DataFrame) -> DataFrame:
    """(h, cls, n, lead, lead_n): the members of buckets of two or more, and each bucket's hub, the member that meets most others in all its buckets.

    Of copies that were each made from one text, that text shares most with all others, so one round of pairs with it links what would else take all pairs.
    """
    count = materialize(entries.groupBy("h").agg(F.count("*").alias("c")).where("c > 1"), "buckets")
    x = materialize(entries.join(count, "h"), "shared")
    x = x.join(x.groupBy("cls").agg(F.sum("c").alias("met")), "cls")
    hub = materialize(x.groupBy("h").agg(F.max(F.struct("met", "cls", "n")).alias("l")).select("h", F.col("l.cls").alias("lead"), F.col("l.n").alias("lead_n")), "hubs")
    return x.select("h", "cls", "n").join(hub, "h")


def _within_radius(classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes that connect what operator 5's tables link; of one fingerprint's classes the least is linked with the others."""
    own = classes.where(F.col("n") >= OVER).select("cls", "fp")
    lead = materialize(own.groupBy("fp").agg(F.min("cls").alias("lead")), "fingerprints")
    edges = linked_fingerprints(lead.select("fp")).toDF("x", "y")
    of = lambda c, to: lead.select(F.col("fp").alias(c), F.col("lead").alias(to))
    return _pairs(edges.join(of("x", "p"), "x").join(of("y", "q"), "y"), "p", "q").union(_pairs(own.join(lead, "fp"), "cls", "lead"))


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many values each set of the one list shares with each of the other: common values by a product of 0-1 matrices, rare ones by their few owners."""
    values, n = np.concatenate([*left, *right]), len(left)
    owner = np.repeat(np.arange(n + len(right)), [len(x) for x in [*left, *right]])
    by = np.argsort(values, kind="stable")
    values, owner = values[by], owner[by]
    number = np.cumsum(np.r_[False, values[1:] != values[:-1]]) if len(values) else values
    count = np.bincount(number)[number] if len(values) else values
    out = np.zeros((n, len(right)), np.float32)
    some = count > RARE
    col, rows = np.unique(number[some], return_inverse=True)[1], owner[some]
    for k in range(0, int(col.max(initial=-1)) + 1, COLUMNS):
        now = (col >= k) & (col < k + COLUMNS)
        m = np.zeros((n + len(right), COLUMNS), np.float32)
        m[rows[now], col[now] - k] = 1
        out += m[:n] @ m[n:].T
    number, owner = number[~some], owner[~some]
    for shift in range(1, RARE):
        same = np.flatnonzero(number[shift:] == number[:-shift])
        x, y = owner[same], owner[same + shift]  # owners of a value stand in order, so those of the left list first
        across = (x < n) & (y >= n)
        np.add.at(out, (x[across], y[across] - n), 1)
    return out


def _apart(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between members of different components that have a bucket's hub in common; of those, what connects the same.

    The members of a hub are dealt to blocks of at most BLOCK sets and BLOCK_HASHES hashes, about, and a task decides a pair of blocks by whole sets: neither a
    bucket nor its pairs are ever in one place.
    """
    of = members.select("lead", "cls", "n", "root").distinct()
    size = of.groupBy("lead").agg((F.min("root") != F.max("root")).alias("apart"), F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_HASHES)).cast("int").alias("k"))
    x = of.join(materialize(size.where("apart").select("lead", "k"), "apart"), "lead").withColumn("block", F.pmod(F.xxhash64("cls"), F.col("k")).cast("int"))
    x = x.join(sets, "cls").select("lead", "cls", "root", "hashes", "block", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other"))
    x = x.select("lead", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "cls", "root", "hashes")

    def compare(key, rows):
        own = key[1].as_py() == key[2].as_py()
        rows = rows.sort_by("cls")
        cls, root, first = rows.column("cls").to_numpy(), rows.column("root").to_numpy(), rows.column("block").to_numpy() == key[1].as_py()
        lists = rows.column("hashes").combine_chunks()
        value, end = lists.values.to_numpy(), lists.offsets.to_numpy()
        whole = [value[a:b] for a, b in zip(end[:-1].tolist(), end[1:].tolist(), strict=True)]
        at, to = np.flatnonzero(first), np.flatnonzero(first if own else ~first)
        a = b = np.zeros(0, np.int64)
        if len(at) and len(to) and root.min() != root.max():
            n = np.array([len(x) for x in whole])
            alike = overlaps([whole[k] for k in at], [whole[k] for k in to]) * (OVER + UNDER) >= (n[at][:, None] + n[to][None]) * OVER
            i, j = np.nonzero(alike & (root[at][:, None] != root[to][None]))
            a, b = spanning(cls[at[i]], cls[to[j]])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return x.groupBy("lead", "i", "j").applyInArrow(compare, "a long, b long")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, hashes) of the classes in wanted (cls, key), from the row with that key."""

    def run(batches):
        for batch in sliced(batches):
            found = [shingle_set(list(hashes(t, SHINGLE))).view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(found)], names=["cls", "hashes"])

    rows = docs.select("text", _key(F.col("doc_id"), F.xxhash64("text")).alias("key"))
    some, _ = split_by(rows, F.xxhash64("key"), wanted.select(F.xxhash64("key")))
    return some.join(wanted, "key").dropDuplicates(["key"]).select("cls", "text").mapInArrow(run, "cls long, hashes array<long>")


def _alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs whose whole sets have the similarity."""
    x = pairs.join(sets.select(F.col("cls").alias("a"), F.col("hashes").alias("x")), "a").join(sets.select(F.col("cls").alias("b"), F.col("hashes").alias("y")), "b")
    return x.where(F.size(F.array_intersect("x", "y")) * (OVER + UNDER) >= (F.size("x") + F.size("y")) * OVER).select("a", "b")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs without near-duplicates: of every group the row with the smallest id (then the least text hash), once.

    Rows link when the Jaccard similarity of their sets of five-word shingles is 0.8 or more, by their whole sets (of 64-bit hashes), and groups
    are what links connect. Pairs come from operator 5's covering tables over five-word fingerprints, which find all within three bits, and
    from BANDS bands of MinHash, as most pairs of such a similarity are farther apart: a pair of 0.8 is in one with all but
    three millionths of probability, one more alike with less. In each bucket all members are first compared with its hub, then those still apart
    with each other, so a group of near copies does not make all its pairs. Equal sets, repeated rows among them, are one class
    before anything is compared; null and wordless texts are one class; a set of under four shingles is like equal ones only.
    A row with null id stays only where no other of its group has one. Columns beyond doc_id and text are kept as they are, whatever their names. An empty
    table gives an empty one. Rows in no group are passed on without a shuffle.
    """
    own = materialize(sketches(docs), "sketches")
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    classes = materialize(own.groupBy("cls").agg(F.min(row).alias("first"), F.count("*").alias("copies"), F.first("n").alias("n"), F.min("fp").alias("fp"), F.first("bands").alias("bands")), "classes")
    entries = classes.select("cls", "n", F.explode("bands").alias("h"))
    members = materialize(_with_hub(entries), "members")
    near = _pairs(members.where(_sizes_fit(F.col("n"), F.col("lead_n"))), "cls", "lead").union(_within_radius(classes))
    first_pairs = materialize(near.distinct(), "pairs")
    wanted = members.select("cls").union(first_pairs.select("a")).union(first_pairs.select("b")).distinct()
    sets = materialize(_sets(docs, wanted.join(classes, "cls").select("cls", _key(F.col("first.doc_id"), F.col("first.text_hash")).alias("key"))), "sets")
    links = materialize(_alike(first_pairs, sets), "links")
    roots = connected_components(links)
    rooted = members.join(roots.withColumnRenamed("node", "cls"), "cls", "left").select("lead", "cls", "n", F.coalesce("root", "cls").alias("root"))
    roots = connected_components(links.union(materialize(_apart(rooted, sets), "links")))

    led = classes.join(roots, F.col("cls") == F.col("node"), "left").select("cls", "first", "copies", F.coalesce("root", "cls").alias("root"))
    groups = led.groupBy("root").agg(F.min("first").alias("least"), F.sum("copies").alias("rows")).where("rows > 1")
    grouped = own.join(led.select("cls", "root"), "cls").join(groups, "root")
    least = F.col("least.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("least.text_hash") == F.col("text_hash"))
    marked = materialize(grouped.select(_key(F.col("doc_id"), F.col("text_hash")).alias("key"), least.alias("stays")).distinct(), "grouped")
    key = private("key", docs)
    some, others = split_by(docs.withColumn(key, _key(F.col("doc_id"), F.xxhash64("text"))), F.xxhash64(F.col(key)), marked.select(F.xxhash64("key")))
    kept = some.join(marked.where("not stays").select(F.col("key").alias(key)), key, "left_anti").dropDuplicates([key])
    return kept.select(*docs.columns).union(others.select(*docs.columns))
