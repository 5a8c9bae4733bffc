"""Benchmark decontamination: a positional inverted index of the corpus, asked for phrases from their rarest terms."""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize, release, shards_for, sliced, table

#: A word: ASCII digits and letters, and all characters beyond ASCII. In UTF-8 these are whole bytes, so bytes decide.
_WORD_BYTES = bytes(i if 0x30 <= i <= 0x39 or 0x61 <= i <= 0x7A or i >= 0x80 else 0x20 for i in range(256))
#: Words of a window; bytes of text that a segment of the index takes; positions in a row of it; windows that meet a segment at once.
WINDOW, SEGMENT_BYTES, ROW_POSITIONS, BLOCK_WINDOWS = 10, 16_000_000, 1 << 22, 100_000


def split_words(text: str | None) -> list[bytes]:
    """The words of a text, A-Z lower-cased; none for null."""
    return (text or "").encode().lower().translate(_WORD_BYTES).split()


@dataclass
class PositionalIndex:
    """``postings``: segment, term, part, n, positions (unsigned 32-bit, ascending); the row of a null term has where the segment's documents begin.
    ``docs``: segment, ordinal, doc_id, n_words, a row for each document, whatever its id.

    Documents of a segment follow each other with one free position between, so no run of positions goes over an end. Positions count words from the segment's start.
    """

    postings: DataFrame
    docs: DataFrame


def build_index(docs: DataFrame) -> PositionalIndex:
    """The index of all words of all rows of (doc_id, text), written once. A task makes a segment of about SEGMENT_BYTES of text after another, a longer text is one by itself; nothing is shuffled.

    A null or empty text is a document without words; rows with equal or null doc_id are documents each; other columns play no part; an empty table gives an empty index.
    """
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = f"segment long, term binary, part int, n long, positions binary, ordinal int, doc_id {kind}"

    def run(batches):
        first = TaskContext.get().partitionId() << 24
        made, held, size = 0, [], 0
        number: defaultdict[bytes, int] = defaultdict()
        number.default_factory = number.__len__
        ids, counts = [], []

        def segment():
            nonlocal made
            words, n_words = (np.concatenate(ids) if ids else np.zeros(0, np.int32)), np.array(counts, np.int64)
            starts = np.concatenate([[0], np.cumsum(n_words + 1)])[: len(n_words)]
            place = (np.arange(len(words)) + np.repeat(np.arange(len(n_words)), n_words)).astype("<u4")
            order = np.argsort(words, kind="stable")
            ends = np.cumsum(np.bincount(words, minlength=len(number))) if len(words) else np.zeros(0, np.int64)
            begins = np.concatenate([[0], ends])[: len(ends)]
            of, part, cuts = np.arange(len(ends)), np.zeros(len(ends), np.int32), begins
            if len(ends) and (ends - begins).max() > ROW_POSITIONS:
                rows = -(-(ends - begins) // ROW_POSITIONS)
                of = np.repeat(of, rows)
                part = (np.arange(len(of)) - np.repeat(np.cumsum(rows) - rows, rows)).astype(np.int32)
                cuts = begins[of] + part * ROW_POSITIONS
            bounds = np.concatenate([cuts, [len(words)]])
            place, terms = place[order], pa.array(list(number), pa.binary())
            key = first + made
            made += 1
            a = 0
            while a < len(of):  # some rows at a time, so that no array of bytes is too long
                b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + ROW_POSITIONS, side="right")) - 1)
                b = min(b, a + 20_000, len(of))
                at = ((bounds[a : b + 1] - bounds[a]) * 4).astype("<i4")
                data = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(at), pa.py_buffer(place[bounds[a] : bounds[b]])])
                yield rows_of(key, terms.take(pa.array(of[a:b])), pa.array(part[a:b]), pa.array(np.diff(bounds[a : b + 1])), data, pa.nulls(b - a, pa.int32()), pa.nulls(b - a, ids_type))
                a = b
            yield rows_of(key, pa.nulls(1, pa.binary()), pa.array([0], pa.int32()), pa.array([len(starts)], pa.int64()), pa.array([starts.astype("<u4").tobytes()], pa.binary()), pa.nulls(1, pa.int32()), pa.nulls(1, ids_type))
            at = 0
            for keys in held:
                k = len(keys)
                yield rows_of(key, pa.nulls(k, pa.binary()), pa.nulls(k, pa.int32()), pa.array(n_words[at : at + k]), pa.nulls(k, pa.binary()), pa.array(np.arange(at, at + k, dtype=np.int32)), keys)
                at += k

        def rows_of(key, *columns):
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(columns[0]), key, np.int64)), *columns], names=["segment", "term", "part", "n", "positions", "ordinal", "doc_id"])

        ids_type = None
        for batch in sliced(batches):
            ids_type = batch.schema.field(0).type
            held.append(batch.column(0))
            for text in batch.column(1).to_pylist():
                found = split_words(text)
                ids.append(np.fromiter(map(number.__getitem__, found), np.int32, len(found)))
                counts.append(len(found))
            size += batch.column(1).nbytes
            if size >= SEGMENT_BYTES:
                yield from segment()
                held, size, ids, counts = [], 0, [], []
                number.clear()
        if held:
            yield from segment()
        del ids, number
        release()

    few = docs.select("doc_id", "text").coalesce(shards_for(total, SEGMENT_BYTES))
    rows = materialize(few.mapInArrow(run, fields), "postings")
    postings = rows.where("positions is not null").select("segment", "term", "part", "n", "positions")
    return PositionalIndex(postings, rows.where("ordinal is not null").select("segment", "ordinal", "doc_id", F.col("n").alias("n_words")))


def windows_of(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item_id, terms) for every window of ``size`` words of each text; a text of fewer words, but not none, is one window. Made in pieces, so a long text is no array of arrays."""
    kind = items.schema["item_id"].dataType.simpleString()

    def run(batches):
        for batch in sliced(batches):
            for k, text in enumerate(batch.column(1).to_pylist()):
                found = split_words(text)
                n = max(1, len(found) - size + 1) if found else 0
                for a in range(0, n, 10_000):
                    part = [found[i : i + size] for i in range(a, min(n, a + 10_000))]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([k] * len(part))), pa.array(part, pa.list_(pa.binary()))], names=["item_id", "terms"])

    return items.select("item_id", "text").mapInArrow(run, f"item_id {kind}, terms array<binary>")


def _starts(terms: list[bytes], lists: dict[bytes, np.ndarray]) -> np.ndarray:
    """Where the terms stand one after another: the shortest list, moved back by its place, cut down by one list after another from short to long."""
    found = sorted(((lists[t], k) for k, t in enumerate(terms)), key=lambda x: len(x[0]))
    at = found[0][0] - found[0][1]
    for there, k in found[1:]:
        if not len(at):
            break
        want = at + k
        near = np.minimum(np.searchsorted(there, want), len(there) - 1)
        at = at[there[near] == want]
    return at[at >= 0]


def _stretches(terms: list[bytes], lists: dict[bytes, np.ndarray], width: int) -> np.ndarray:
    """The shortest stretches of at most ``width`` positions that hold every term, as often as it is asked for: rows of start and end. Only what lies near the rarest term is looked at."""
    need: dict[bytes, int] = {}
    for t in terms:
        need[t] = need.get(t, 0) + 1
    order = sorted(need, key=lambda t: len(lists[t]))
    anchor = lists[order[0]]
    place, owner = [], []
    for k, t in enumerate(order):
        x = lists[t]
        i = np.searchsorted(anchor, x)
        before, after = anchor[np.maximum(i - 1, 0)], anchor[np.minimum(i, len(anchor) - 1)]
        x = x[np.minimum(np.abs(x - before), np.abs(after - x)) < width]
        place.append(x)
        owner.append(np.full(len(x), k))
    place, owner = np.concatenate(place), np.concatenate(owner)
    by = np.argsort(place, kind="stable")
    place, owner = place[by].tolist(), owner[by].tolist()
    wanted, have, missing, low, out = [need[t] for t in order], [0] * len(order), len(terms), 0, []
    for high, k in enumerate(owner):
        missing -= have[k] < wanted[k]
        have[k] += 1
        while not missing:
            left = owner[low]
            if have[left] == wanted[left]:  # the shortest that ends here
                if place[high] - place[low] < width:
                    out.append((place[low], place[high] + 1))
                missing += 1
            have[left] -= 1
            low += 1
    return np.array(out, np.int64).reshape(-1, 2)


def _merged(item: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The intervals of each item, those that overlap or touch as one."""
    by = np.lexsort((start, item))
    item, start, end = item[by], start[by], end[by]
    far = start + (item - item.min()) * (int(end.max()) + 2)  # items apart, so one running maximum serves all
    top = np.maximum.accumulate(end + (far - start))
    new = np.r_[True, far[1:] > top[:-1]]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(item)] - 1
    return item[first], start[first], top[last] - (far - start)[last]


def find(index: PositionalIndex, items: DataFrame, size: int = WINDOW, width: int | None = None) -> DataFrame:
    """(segment, ordinal, item_id, start, end): stretches of words of documents that hold windows of items, by document and item without overlaps; end exclusive, words counted from the document's start.

    Without ``width`` a window must stand there word for word; with it, its words may stand in any order within a stretch of at most so many words (the shortest such stretches count).
    A window goes only to segments that hold its rarest term over the whole corpus; a window with a term that no document has goes nowhere. There, lists are intersected from the
    shortest on. Items of a null id are searched like others, repeated items are one, null and empty texts have no window. Many items are worked on in blocks of windows.
    """
    asked = materialize(windows_of(items, size).distinct().withColumn("w", F.monotonically_increasing_id()), "windows")
    n = asked.count()
    blocks = max(1, -(-n // BLOCK_WINDOWS))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("w"), F.lit(blocks)).cast("int"))
    words = materialize(asked.select(F.explode("terms").alias("term")).distinct(), "terms")
    heard = index.postings.join(words, "term", "left_semi")
    often = materialize(heard.groupBy("term").agg(F.sum("n").alias("often")), "frequencies")
    each = asked.select("w", "block", "item_id", F.size("terms").alias("size"), "terms", F.explode("terms").alias("term")).join(often, "term")
    rarest = each.groupBy("w").agg(F.count("*").alias("known"), F.first("size").alias("size"), F.first("block").alias("block"), F.first("item_id").alias("item_id"), F.first("terms").alias("terms"), F.min_by("term", F.struct("often", "term")).alias("term"))
    there = index.postings.where("part = 0").select(F.col("segment").alias("of"), "term")
    routed = rarest.where("known = size").join(there, "term").select("of", "block", "item_id", "terms")
    starts = index.postings.where("term is null").select("segment", "term", "part", "positions")
    lists = heard.select("segment", "term", "part", "positions").union(starts).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    kind = items.schema["item_id"].dataType.simpleString()

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["segment", "ordinal", "item_id", "start", "end"]
        none = pa.schema([("segment", pa.int64()), ("ordinal", pa.int32()), ("item_id", right.schema.field("item_id").type), ("start", pa.int64()), ("end", pa.int64())]).empty_table()
        if not right.num_rows or not left.num_rows:
            return none
        held: dict = {}
        for t, part, raw in zip(*(left.column(c).to_pylist() for c in ("term", "part", "positions")), strict=True):
            held.setdefault(t, []).append((part, np.frombuffer(raw, "<u4").astype(np.int64)))
        places = {t: x[0][1] if len(x) == 1 else np.concatenate([y for _, y in sorted(x, key=lambda y: y[0])]) for t, x in held.items()}
        begins = places.pop(None)
        keys = right.column("item_id").combine_chunks().dictionary_encode()
        keys = keys.combine_chunks() if isinstance(keys, pa.ChunkedArray) else keys
        number = keys.indices.fill_null(-1).to_pylist()
        who, start, end = [], [], []
        for k, terms in zip(number, right.column("terms").to_pylist(), strict=True):
            if not all(t in places for t in terms):
                continue
            if width is None:
                at = _starts(terms, places)
                a, b = at, at + len(terms)
            else:
                a, b = _stretches(terms, places, width).T
                inside = np.searchsorted(begins, a, side="right") == np.searchsorted(begins, b - 1, side="right")
                a, b = a[inside], b[inside]
            if len(a):
                who.append(np.full(len(a), k))
                start.append(a)
                end.append(b)
        if not who:
            return none
        who, start, end = _merged(np.concatenate(who), np.concatenate(start), np.concatenate(end))
        doc = np.searchsorted(begins, start, side="right") - 1
        ids = keys.dictionary.take(pa.array(np.where(who < 0, None, who).tolist(), pa.int64()))
        columns = [pa.array(np.full(len(doc), left.column("segment")[0].as_py(), np.int64)), pa.array(doc.astype(np.int32)), ids, pa.array(start - begins[doc]), pa.array(end - begins[doc])]
        return pa.table(columns, names=names)

    out = lists.groupBy("segment", "block").cogroup(routed.groupBy("of", "block")).applyInArrow(search, f"segment long, ordinal int, item_id {kind}, start long, end long")
    return materialize(out, "stretches")


def matches(docs: DataFrame, items: DataFrame, size: int = WINDOW, width: int | None = None) -> DataFrame:
    """(doc_id, item_id, start, end) of every stretch that ``find`` finds in the documents."""
    index = build_index(docs)
    return find(index, items, size, width).join(index.docs.select("segment", "ordinal", "doc_id"), ["segment", "ordinal"]).select("doc_id", "item_id", "start", "end")


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, contaminated) for every row of docs: words inside any window of an item, and the ids of items with such windows, sorted as strings.

    A null text has no words; rows with equal or null doc_id are judged each; a null item_id has hits but no place in ``items``; a repeated item counts once.
    No items, or none with words, find nothing; an empty table gives an empty result.
    """
    index = build_index(docs)
    found = find(index, items, size)
    order = W.partitionBy("segment", "ordinal").orderBy("start", "end")
    seen = F.coalesce(F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    new = found.withColumn("_new", F.greatest(F.col("end") - F.greatest("start", seen), F.lit(0)))
    by = new.groupBy("segment", "ordinal").agg(F.sum("_new").alias("n_hit"), F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    out = index.docs.join(by, ["segment", "ordinal"], "left")
    none = F.array().cast("array<string>")
    hit = F.coalesce("n_hit", F.lit(0))
    return out.select("doc_id", "n_words", hit.alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"), F.coalesce("items", none).alias("items"), (hit > 0).alias("contaminated"))


def op11_decontamination(spark, sf_dir: str) -> DataFrame:
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


#: Windows as joined words; a document's windows of each size that items have.
OP11_SQL = r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
), i as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark
), ig as (
  select distinct item_id, k, array_to_string(w[p:p + k - 1], ' ') as g from (select item_id, w, k, unnest(range(1, len(w) - k + 2)) as p from (select *, least(10, len(w)) as k from i where len(w) > 0))
), dg as (
  select doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') as g from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as p from d join (select distinct k from ig) on len(w) >= k)
), m as (
  select distinct doc_id, item_id, p, k from dg join ig using (k, g)
), hit as (
  select doc_id, count(*) as n_hit from (select distinct doc_id, unnest(range(p, p + k)) as at from m) group by doc_id
), it as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, cast(item_id as varchar) as item from m) group by doc_id
)
select d.doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit on hit.doc_id = d.doc_id left join it on it.doc_id = d.doc_id
"""
