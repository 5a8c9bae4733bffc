"""Phrase collocations by SON partitioning: shards mined completely at lowered support, then all candidates counted exactly."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize, release, sliced, table

#: Shards of the corpus, whatever its size; a phrase's least count; words of a phrase at most; what a null language is called.
SHARDS, SUPPORT, LONGEST, UNKNOWN = 10, 30, 4, "und"
#: Share of an inner phrase's count from which a longer one takes its place, in percent; phrases returned for a language.
COVERED, TOP = 80, 2000
#: Words that a task counts at once; hashes of a bucket, about; words of 64 bits in a bitmap of hashes (8 MB).
FLUSH_WORDS, BUCKET_HASHES, BITMAP_WORDS = 3_000_000, 1_000_000, 1 << 20

#: Bytes as the splitting sees them: tab is a space, what ends a piece is 0xFF, which no UTF-8 text holds.
_BREAK = b"\xff"
_BYTES = bytes(0xFF if i in b".,;:!?\x0a\x0b\x0c\x0d" else 0x20 if i == 0x09 else i for i in range(256))
_WORDS = r"[^\x20\x09.,;:!?\x0A-\x0D]+"


def tokens(text: str | None) -> list[bytes]:
    """The words of a text, A-Z lower-cased, with _BREAK where a piece ends."""
    return (text or "").encode().lower().translate(_BYTES).replace(_BREAK, b" \xff ").split()


class Stream:
    """Words of many documents as numbers, documents of one key after another; word 0 is a break."""

    def __init__(self):
        self.number: defaultdict[bytes, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.number[_BREAK]
        self.held: dict[tuple, list[np.ndarray]] = {}
        self.size = 0

    def add(self, key: tuple, text: str | None) -> None:
        found = tokens(text)
        if found:
            found.append(_BREAK)
            self.held.setdefault(key, []).append(np.fromiter(map(self.number.__getitem__, found), np.int32, len(found)))
            self.size += len(found)

    def words(self) -> list[bytes]:
        return list(self.number)

    def hashes(self) -> np.ndarray:
        return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self.number), np.uint64, len(self.number))


def grams(ids: np.ndarray, hashes: np.ndarray, longest: int = LONGEST) -> list[np.ndarray]:
    """For m from 1: the hash of the m words from each place on, and 0 where a break is among them or the end is near."""
    h, own, out = np.zeros(len(ids), np.uint64), hashes[ids], []
    inside = np.ones(len(ids), bool)
    for m in range(longest):
        if m >= len(ids):
            out.append(np.zeros(len(ids), np.uint64))
            continue
        inside[len(ids) - m :] = False
        inside[: len(ids) - m] &= ids[m:] != 0
        h[: len(ids) - m] = (h[: len(ids) - m] ^ own[m:]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
        out.append(np.where(inside, h | np.uint64(1), np.uint64(0)))
    return out


def salt(*key) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest("\x00".join(map(str, key))))


def bitmap_place(hashes: np.ndarray, key: np.uint64) -> np.ndarray:
    """The bit of each hash under a key, among those of a bitmap."""
    x = (hashes ^ key) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - (BITMAP_WORDS * 64).bit_length() + 1)


def marked(bits: np.ndarray, hashes: np.ndarray, key: np.uint64) -> np.ndarray:
    """Whether each hash's bit is set; never false for one that was put in."""
    place = bitmap_place(hashes, key)
    return (hashes != 0) & ((bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1)).astype(bool)


def bitmap(places: DataFrame) -> np.ndarray:
    """The bits of a column ``place``: BITMAP_WORDS words of 64 bits reach the driver at most, however many rows there are."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place").bitwiseAND(F.lit(63)).cast("int"))
    words = places.groupBy(F.shiftrightunsigned("place", 6).alias("w")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(BITMAP_WORDS, np.int64)
    out[words.column("w").to_numpy()] = words.column("bits").to_numpy()
    return out.view(np.uint64)


def local_counts(docs: DataFrame, sizes: tuple[int, ...], buckets: int, most: int, pruned=None) -> DataFrame:
    """(shard, lang, m, bucket, hashes, counts): a task's counts of the phrases of m words in its part of each shard, packed; counts stop at ``most``.

    ``pruned`` is the bitmap of the pairs that are frequent in their shard: a longer phrase counts only where all its pairs are. Hashes are 64-bit; phrases that share one
    count together, so a count is never too small.
    """
    kind = np.dtype("<u1" if most < 256 else "<u4")
    names = ["shard", "lang", "m", "bucket", "hashes", "counts"]

    def run(batches):
        stream = Stream()

        def count():
            nonlocal stream
            hashes = stream.hashes()
            for (shard, lang), parts in stream.held.items():
                all_m = grams(np.concatenate(parts), hashes, max(sizes))
                parts.clear()
                if pruned is not None:
                    pairs = marked(pruned.value, all_m[1], salt(shard, lang))
                for m in sizes:
                    h = all_m[m - 1]
                    if pruned is not None:
                        keep = pairs.copy()
                        for k in range(1, m - 1):
                            keep[:-k] &= pairs[k:]
                        h = h[keep]
                    h, n = np.unique(h[h != 0], return_counts=True)
                    n = np.minimum(n, most).astype(kind)
                    cut = np.searchsorted(h, np.arange(1, buckets, dtype=np.uint64) * np.uint64((1 << 64) // buckets)) if buckets > 1 else []
                    ends = [0, *map(int, cut), len(h)]
                    full = [b for b in range(buckets) if ends[b] < ends[b + 1]]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([shard] * len(full), pa.int32()), pa.array([lang] * len(full), pa.string()), pa.array([m] * len(full), pa.int32()), pa.array(full, pa.int32()),
                        pa.array([h[ends[b] : ends[b + 1]].tobytes() for b in full], pa.binary()), pa.array([n[ends[b] : ends[b + 1]].tobytes() for b in full], pa.binary()),
                    ], names=names)
            stream = Stream()

        for batch in sliced(batches):
            for shard, lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                stream.add((shard, lang), text)
                if stream.size >= FLUSH_WORDS:
                    yield from count()
        yield from count()
        del stream
        release()

    return docs.select("shard", "lang", "text").mapInArrow(run, "shard int, lang string, m int, bucket int, hashes binary, counts binary")


def locally_frequent(docs: DataFrame, totals: DataFrame, sizes: tuple[int, ...], buckets: int, support: int, pruned=None) -> DataFrame:
    """(shard, lang, m, hash, own, every) of the phrases that reach their shard's support: its share, by words of the language, of the whole, rounded up; own and every are their places in the bitmaps by shard and by language."""
    kind = np.dtype("<u1" if support < 256 else "<u4")
    counts = local_counts(docs, sizes, buckets, 255 if support < 256 else support, pruned).join(totals.select("shard", "lang", "least"), ["shard", "lang"])

    def mine(group: pa.Table) -> pa.Table:
        shard, lang, m, least = (group.column(c)[0].as_py() for c in ("shard", "lang", "m", "least"))
        h = np.concatenate([np.frombuffer(x, "<u8") for x in group.column("hashes").to_pylist()])
        n = np.concatenate([np.frombuffer(x, kind) for x in group.column("counts").to_pylist()])
        by = np.argsort(h, kind="stable")
        h, n = h[by], n[by]
        first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        h = h[first][np.add.reduceat(n.astype(np.int64), first) >= least]
        own, every = bitmap_place(h, salt(shard, lang)), bitmap_place(h, salt(m, lang))
        same = [pa.array([x] * len(h), t) for x, t in ((shard, pa.int32()), (lang, pa.string()), (m, pa.int32()))]
        return pa.table([*same, *(pa.array(x.astype(np.int64)) for x in (own, every))], names=["shard", "lang", "m", "own", "every"])

    return counts.groupBy("shard", "lang", "m", "bucket").applyInArrow(mine, "shard int, lang string, m int, own long, every long")


def count_phrases(docs: DataFrame, chosen, longest: int = LONGEST) -> DataFrame:
    """(lang, m, phrase, n): a task's exact counts of the phrases whose bit is set, by their words, not their hashes."""

    def run(batches):
        stream = Stream()

        def count():
            nonlocal stream
            hashes, words = stream.hashes(), stream.words()
            for (lang,), parts in stream.held.items():
                ids = np.concatenate(parts)
                parts.clear()
                code = np.zeros(len(ids), np.int64)  # the number of the first m words from each place on, exact
                for m, h in enumerate(grams(ids, hashes, longest), 1):
                    at = np.flatnonzero(marked(chosen.value, h, salt(m, lang)))
                    whole = np.flatnonzero(h != 0) if m < longest else at
                    key = code[whole] * len(words) + ids[whole + m - 1]
                    if m < longest:
                        distinct, key = np.unique(key, return_inverse=True)  # numbers stay below the places of the stream
                        code[whole] = key
                        key = code[at]
                    _, first, n = np.unique(key, return_index=True, return_counts=True)
                    first = at[first].tolist()
                    for a in range(0, len(first), 50_000):
                        part = first[a : a + 50_000]
                        said = [b" ".join([words[w] for w in ids[i : i + m].tolist()]).decode() for i in part]
                        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.string()), pa.array([m] * len(part), pa.int32()), pa.array(said, pa.string()), pa.array(n[a : a + 50_000], pa.int64())], names=["lang", "m", "phrase", "n"])
            stream = Stream()

        for batch in sliced(batches):
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                stream.add((lang,), text)
                if stream.size >= FLUSH_WORDS:
                    yield from count()
        yield from count()
        del stream
        release()

    return docs.select("lang", "text").mapInArrow(run, "lang string, m int, phrase string, n long")


def frequent_phrases(docs: DataFrame, support: int = SUPPORT, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """(lang, m, phrase, f) of all phrases of one to LONGEST words with f >= support, and (lang, n): each language's words.

    A phrase with ``support`` occurrences reaches a shard's share of it, rounded up, in one shard at least, as shares add up to one; so what no shard
    mines can be left out. Shards are dealt by doc_id and mined by many tasks each: words and pairs first, then longer phrases whose pairs are all
    frequent in the shard. The union becomes a bitmap of fixed size, in which others may be too, and one more scan counts all of it exactly, by words.
    """
    given = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int").alias("shard"))
    counted = given.groupBy("shard", "lang").agg(F.sum(F.coalesce(F.regexp_count("text", F.lit(_WORDS)), F.lit(0)).cast("long")).alias("n"))
    counted = materialize(counted, "shard-words")
    whole = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    share = F.expr(f"cast(ceil(cast({support} as decimal(10, 0)) * cast(counted.n as decimal(20, 0)) / cast(whole.n as decimal(20, 0))) as long)")
    totals = counted.alias("counted").join(whole.alias("whole"), "lang").where("counted.n > 0").select("shard", "lang", F.greatest(F.lit(1), share).alias("least"))
    words = whole.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    buckets = 1 << max(0, (words // (shards * BUCKET_HASHES))).bit_length()
    context = docs.sparkSession.sparkContext
    short = materialize(locally_frequent(given, totals, (1, 2), buckets, support), "short-phrases")
    pairs = context.broadcast(bitmap(short.where("m = 2").select(F.col("own").alias("place"))))
    long = materialize(locally_frequent(given, totals, tuple(range(3, LONGEST + 1)), buckets, support, pairs), "long-phrases")
    chosen = context.broadcast(bitmap(short.select(F.col("every").alias("place")).union(long.select("every"))))
    counts = count_phrases(given, chosen).groupBy("lang", "m", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= support)
    return materialize(counts, "phrases"), whole


def _part(phrase: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), start, length), " ")


def collocations(docs: DataFrame, support: int = SUPPORT, top: int | None = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): phrases of two to LONGEST words with their lowest-scoring cut, best first; the first ``top`` of each language, all for None.

    A cut's score is floor(2000000 a / (l + r)), of equal ones the earliest counts. A phrase is left out if it lies inside a longer one with COVERED percent of its
    count or more. Products are decimals, so none overflows. A null text has no words, a null lang is UNKNOWN; rows with a null or repeated doc_id are documents each; other columns play no part; an empty table gives an empty result.
    """
    f, whole = frequent_phrases(docs, support)
    long = f.where("m > 1").withColumnRenamed("f", "a")
    cut = long.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("m") - 1)))
    cut = cut.withColumns({"first": _part(F.col("phrase"), F.lit(1), F.col("k")), "rest": _part(F.col("phrase"), F.col("k") + 1, F.col("m") - F.col("k"))})
    left, right = f.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), f.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    score = F.expr("cast(2000000 as decimal(7, 0)) * cast(a as decimal(19, 0)) div (cast(l as decimal(19, 0)) + cast(r as decimal(19, 0)))")
    scored = cut.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn("score", score)
    best = scored.groupBy("lang", "phrase", "m", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    inner = long.where("m > 2").withColumn("k", F.explode(F.sequence(F.lit(2), F.col("m") - 1))).withColumn("i", F.explode(F.sequence(F.lit(1), F.col("m") - F.col("k") + 1)))
    inside = inner.groupBy("lang", _part(F.col("phrase"), F.col("i"), F.col("k")).alias("phrase")).agg(F.max("a").alias("longer"))
    product = lambda n, c: F.expr(f"cast({n} as decimal(3, 0)) * cast({c} as decimal(19, 0))")
    kept = best.join(inside, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (product(100, "longer") < product(COVERED, "a")))
    kept = kept.select("lang", "phrase", "a", F.col("b.l").alias("l"), F.col("b.r").alias("r"), F.col("b.score").cast("long").alias("score"))
    ranked = kept.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")))  # a limit on it is kept before the shuffle
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(whole, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
with pieces as (
  select lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') as w from (
    select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents)
), g as (
  select lang, m, phrase, count(*) as f from (select lang, m, array_to_string(w[i:i + m - 1], ' ') as phrase from (select lang, m, w, unnest(range(1, len(w) - m + 2)) as i from pieces, (values (1), (2), (3), (4)) as v(m) where len(w) >= m)) group by all
), total as (
  select lang, cast(sum(f) as bigint) as n from g where m = 1 group by lang
), c as (
  select lang, m, phrase, f as a, string_split(phrase, ' ') as w from g where m > 1 and f >= 30
), cut as (
  select lang, phrase, a, k, array_to_string(w[1:k], ' ') as first, array_to_string(w[k + 1:m], ' ') as rest from (select *, unnest(range(1, m)) as k from c)
), scored as (
  select cut.*, x.f as l, y.f as r, cast((2000000::hugeint * a) // (x.f + y.f) as bigint) as score from cut join g x on x.lang = cut.lang and x.phrase = cut.first join g y on y.lang = cut.lang and y.phrase = cut.rest
), best as (
  select * from (select *, row_number() over (partition by lang, phrase order by score, k) as b from scored) where b = 1
), inside as (
  select lang, part, max(a) as longer from (select lang, a, array_to_string(w[i:i + k - 1], ' ') as part from (select *, unnest(range(1, m - k + 2)) as i from (select *, unnest(range(2, m)) as k from c where m > 2))) group by all
), ranked as (
  select best.*, row_number() over (partition by best.lang order by score desc, a desc, phrase) as rank from best left join inside on inside.lang = best.lang and inside.part = best.phrase where longer is null or 100::hugeint * longer < 80::hugeint * a
)
select ranked.lang, rank, phrase, a, l, r, n, score from ranked join total on total.lang = ranked.lang where rank <= 2000
"""
