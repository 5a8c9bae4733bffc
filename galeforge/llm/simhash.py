"""SimHash near-duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, per_row, private, table
from .components import connected_components, spanning

RADIUS = 3
BITS = 64
#: Distinct fingerprints in one bucket beyond which it is dealt anew by the bits that its mask leaves out.
HOT_BUCKET = 4096
#: Rows compared with each other at once inside a bucket.
BLOCK = 1024
#: Words hashed at once, so a long text's bits stay within some MB.
STEP = 65_536


def hashes(text: str | None, shingle: int = 3):
    """The XXH64 hashes, seed 42, of every run of ``shingle`` words of a whole text, repeats included, in blocks of up to STEP.

    A-Z are lower-cased, words are cut at ASCII white space. A text with fewer words has one run, its whole
    sequence; null and texts without words have none.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    a, b, h = starts[: len(words) - k + 1], ends[k - 1 :], xxhash.xxh64_intdigest
    for i in range(0, len(a), STEP):
        yield np.array([h(joined[x:y], 42) for x, y in zip(a[i : i + STEP].tolist(), b[i : i + STEP].tolist(), strict=True)], np.uint64)


def fingerprint_of(blocks) -> int:
    """The 64-bit fingerprint of these hashes, as an unsigned number: a bit is set if it is set in over half of them; 0 for none."""
    ones, n = np.zeros(BITS, np.int64), 0
    for part in blocks:
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
        n += len(part)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprint(text: str | None, shingle: int = 3) -> int:
    return fingerprint_of(hashes(text, shingle))


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp): the fingerprint of every row as a signed long, and a hash that tells rows of one id apart."""

    def start():
        return lambda x: {"fp": np.array([fingerprint(t, shingle) for t in x["text"]], np.uint64).view(np.int64)}

    return per_row(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")), ["text"], start, {"fp": "long"}, ("doc_id", "text_hash"))


def masks(bits: list[int], radius: int = RADIUS) -> list[int]:
    """2**(radius + 1) - 1 masks over these bit positions, of which one avoids any ``radius`` of them.

    Every position gets a nonzero vector of radius + 1 bits, in turn; mask v has the positions whose vector has an
    odd product with v. The vectors of ``radius`` differing positions span at most ``radius`` dimensions, so some
    nonzero v is orthogonal to all, and its mask holds none of them: both fingerprints agree there.
    """
    n = (1 << (radius + 1)) - 1
    return [sum(1 << p for i, p in enumerate(bits) if ((i % n + 1) & v).bit_count() & 1) for v in range(1, n + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _close_pairs(fp: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of fingerprints in the same run (equal numbers stand together) within the radius; of those, what connects all of them."""
    n = len(fp)
    last = np.searchsorted(run, run, side="right")
    found = []
    size = last - np.arange(n)
    small = size <= BLOCK
    for shift in range(1, int(size[small].max(initial=1))):  # all small runs at once, by distance in the order
        i = np.flatnonzero(small & (size > shift))
        i = i[np.bitwise_count(fp[i] ^ fp[i + shift]) <= RADIUS]
        found.append((i, i + shift))
    begins = np.flatnonzero(np.r_[True, run[1:] != run[:-1]]) if n else np.zeros(0, int)
    for s in begins[~small[begins]]:
        e = last[s]
        for x in range(s, e, BLOCK):
            for y in range(x, e, BLOCK):
                i, j = np.nonzero(np.bitwise_count(fp[x : min(x + BLOCK, e), None] ^ fp[None, y : min(y + BLOCK, e)]) <= RADIUS)
                found.append(spanning(i + x, j + y))
            if len(found) > 64:
                found = [spanning(*map(np.concatenate, zip(*found, strict=True)))]
    if not found:
        return np.zeros(0, int), np.zeros(0, int)
    a, b = map(np.concatenate, zip(*found, strict=True))
    return spanning(a[a != b], b[a != b])


def linked_fingerprints(distinct: DataFrame, hot: int = HOT_BUCKET) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) that connect all that differ in at most RADIUS bits.

    Each fingerprint goes to one bucket in each of 15 tables, by its bits under that table's mask. Buckets with
    over ``hot`` fingerprints are dealt anew by 15 masks over the bits that the first one left out: the pair's
    differing bits are all among those, so the guarantee holds again. A task compares what shares a bucket
    and returns links that connect all of its links, less than one for each fingerprint and bucket.
    """
    first = masks(list(range(BITS)))
    second = [[_signed(m) for m in masks([p for p in range(BITS) if not mask >> p & 1])] for mask in first]
    put = lambda v, key: F.struct(F.lit(v).alias("v"), key.alias("key"))
    keyed = distinct.select("fp", F.explode(F.array(*[put(v, F.col("fp").bitwiseAND(F.lit(_signed(m)))) for v, m in enumerate(first)])).alias("x")).select("fp", "x.v", "x.key")
    large = keyed.groupBy("v", "key").count().where(F.col("count") > hot).select("v", "key", F.lit(True).alias("hot"))
    sub = F.element_at(F.array(*[F.array(*map(F.lit, row)) for row in second]), F.col("v") + 1)
    anew = F.transform(sub, lambda m, i: F.struct((i + 1).alias("w"), F.col("fp").bitwiseAND(m).alias("sub")))
    none = F.array(F.struct(F.lit(0).alias("w"), F.lit(0).cast("long").alias("sub")))
    dealt = keyed.join(large, ["v", "key"], "left").select("fp", "v", "key", F.explode(F.when(F.col("hot"), anew).otherwise(none)).alias("y"))
    dealt = dealt.select("fp", F.xxhash64("v", "key", "y.w", "y.sub").alias("bucket")).repartition("bucket").sortWithinPartitions("bucket", "fp")

    def compare(batches):
        fp, bucket = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for pdf in batches:
            fp = np.concatenate([fp, pdf["fp"].to_numpy(np.int64).view(np.uint64)])
            bucket = np.concatenate([bucket, pdf["bucket"].to_numpy(np.int64)])
            done = np.searchsorted(bucket, bucket[-1]) if len(bucket) else 0  # the last bucket may go on
            if done:
                yield edges(fp[:done], bucket[:done])
                fp, bucket = fp[done:], bucket[done:]
        if len(fp):
            yield edges(fp, bucket)

    def edges(fp, bucket):
        a, b = _close_pairs(fp, bucket)
        return pd.DataFrame({"a": fp[a].view(np.int64), "b": fp[b].view(np.int64)})

    return dealt.mapInPandas(compare, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp, component_id, first) for every row of docs.

    Rows link when their fingerprints differ in at most three bits; component_id is the smallest doc_id reachable and ``first`` is true
    for the row (or equal rows) of that id with the least hash. Equal fingerprints, repeated rows among them, are one class before anything is
    compared. Null and wordless texts have fingerprint 0 and link like any other. Rows with a null doc_id take part and get their
    component's smallest id, null if it has none. An empty table gives an empty result.
    """
    own = materialize(fingerprints(docs, shingle), "fingerprints")
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    classes = materialize(own.groupBy("fp").agg(F.min(row).alias("first")), "classes")
    links = materialize(linked_fingerprints(classes.select("fp")), "links")  # used more than once, and made in Python
    roots = connected_components(links)
    led = materialize(classes.join(roots, classes.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "first"), "led")
    least = led.groupBy("root").agg(F.min("first").alias("least"))
    named = led.join(least, "root").select("fp", "least")
    first = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("text_hash") == F.col("least.text_hash"))
    return own.join(named, "fp").select("doc_id", "text_hash", "fp", F.col("least.doc_id").alias("component_id"), first.alias("first"))


def one_of_each(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """The rows of docs without near-duplicates by fingerprints alone: of every component the first, once.

    Rows are found by one text key of id and hash, so the join and the removal of repeated rows share a shuffle and an order.
    """
    key = lambda h: F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), h.cast("string"))
    name = private("key", docs)
    stay = near_duplicates(docs, shingle).where("first").select(key(F.col("text_hash")).alias(name))
    kept = docs.withColumn(name, key(F.xxhash64("text"))).join(stay, name, "left_semi")
    return kept.dropDuplicates([name]).select(*docs.columns)


def op5_simhash(spark, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
