"""Packing by lexical retrieval: a sharded BM25 index gives each window's seed its unused neighbours."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, release, shards_for, sliced, table
from .tokens import default_path, encoder, forget_encoders

WINDOW, END_ID = 2048, 1
K1, B = 1.2, 0.75
#: Terms by which rows are dealt to shards, their rarest; an index takes documents until it has so many, or so many ids; ids of a partition, which is worked through index by index.
ROUTE_TERMS, SHARD_DOCS, SHARD_IDS, PARTITION_IDS = 64, 1024, 2_000_000, 6_000_000
#: A term is common in a shard if one of so many of its documents holds it.
COMMON = 32
#: Term counts that one task adds up, and that the driver does; numbers before them; how ids are written in between.
FAN, HEAD, ID_TYPES = 32, 3, ("<u2", "<u4")
FIELDS = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]


@dataclass
class Corpus:
    """Documents, ids, and how many documents hold each id, over all documents."""

    id_bytes: int
    docs: int
    ids: int
    df: np.ndarray

    @property
    def idf(self) -> np.ndarray:
        return np.log1p((self.docs - self.df + 0.5) / (self.df + 0.5))


class Bm25Shard:
    """An inverted index over token ids: postings by term, weighted by the whole corpus' statistics, and each document's terms: all, or the rarest ``query_terms`` of them.

    The weight is an idf that is never negative by the usual saturated term frequency. Ids that one document of the shard holds have no postings.
    """

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean_size: float = 1.0, query_terms: int | None = None):
        n = len(docs)
        size = np.array([len(x) for x in docs])
        doc = np.repeat(np.arange(n), size)
        key, tf = np.unique(np.concatenate(docs).astype(np.int64) * n + doc, return_counts=True)
        term, doc = key // n, key % n
        first = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
        use = np.repeat(np.diff(np.r_[first, len(term)]), np.diff(np.r_[first, len(term)])) > 1
        term, self.doc, tf = term[use], doc[use], tf[use]
        self.weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[self.doc] / mean_size))
        begin = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else np.zeros(0, int)
        self.begin, self.end = begin, np.r_[begin[1:], len(term)] if len(term) else begin
        number = np.cumsum(np.r_[False, term[1:] != term[:-1]]) if len(term) else term
        often = (self.end - self.begin) * COMMON >= n  # terms of many documents: all their scores at once, as a product of matrices
        self.common = None
        if query_terms is None and often.any():
            row, some = np.cumsum(often) - 1, often[number]
            holds, weighs = np.zeros((int(often.sum()), n), np.float32), np.zeros((int(often.sum()), n), np.float32)
            holds[row[number[some]], self.doc[some]] = 1
            weighs[row[number[some]], self.doc[some]] = self.weight[some]
            self.common = holds.T @ weighs
            kept = ~some
            of, at_ = self.doc[kept], number[kept]
        else:
            of, at_ = self.doc, number
        own = np.argsort(of, kind="stable") if query_terms is None else np.lexsort((term, -idf[term], of))  # each document's terms, rarest first where only some ask
        at = np.searchsorted(of[own], np.arange(n + 1))
        self.terms = [at_[own[a : b if query_terms is None else min(b, a + query_terms)]] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        self.n = n

    def scores(self, seed: int) -> np.ndarray:
        """The score of every document of the shard for the seed's terms."""
        terms = self.terms[seed]
        size = self.end[terms] - self.begin[terms]
        after = np.cumsum(size)
        at = np.repeat(self.begin[terms] - (after - size), size) + np.arange(after[-1] if len(after) else 0)
        out = np.bincount(self.doc[at], self.weight[at], minlength=self.n)
        return out if self.common is None else out + self.common[seed]


class Packer:
    """Fills windows of ``window`` ids one after another; a piece is (document number, start, length, sequence, offset)."""

    def __init__(self, window: int, first_sequence: int):
        self.window, self.sequence = window, first_sequence
        self.filled, self.open, self.done = 0, [], []

    def place(self, doc, length: int) -> bool:
        """Append a document, cut where windows end; True if it goes on in a window that is still open."""
        start, cut = 0, False
        while start < length:
            n = min(length - start, self.window - self.filled)
            self.open.append((doc, start, n, self.filled))
            start, self.filled = start + n, self.filled + n
            if self.filled == self.window:
                self._close(self.open)
                self.open, self.filled, cut = [], 0, True
        return cut and self.filled > 0

    def _close(self, pieces: list) -> None:
        self.done += [(doc, start, n, self.sequence, offset) for doc, start, n, offset in pieces]
        self.sequence += 1

    def pack(self, docs: list, sizes: list[int], index: Bm25Shard) -> None:
        """All documents of a shard: a seed, then its unused neighbours by score until the window is full; who is cut there seeds the next."""
        used = np.zeros(len(docs), bool)
        following, seed = 0, None
        while True:
            if seed is None:
                while following < len(docs) and used[following]:
                    following += 1
                if following == len(docs):
                    return
                seed = following
                used[seed] = True
                self.place(docs[seed], sizes[seed])
                if not self.filled:
                    seed = None
                    continue
            ranked = np.where(used, -1.0, index.scores(seed))
            while True:
                near = int(ranked.argmax())
                if ranked[near] < 0:
                    return
                ranked[near], used[near] = -1.0, True
                if self.place(docs[near], sizes[near]):
                    seed = near
                    break
                if not self.filled:
                    seed = None
                    break

    def finish(self) -> None:
        """The last window's ids in sequences whose lengths are powers of two, which need no padding."""
        pieces, left = self.open, self.filled
        while left:
            room = size = 1 << (left.bit_length() - 1)
            some, rest = [], []
            for doc, start, n, _ in pieces:
                k = min(n, room)
                if k:
                    some.append((doc, start, k, size - room))
                if n > k:
                    rest.append((doc, start + k, n - k, 0))
                room -= k
            self._close(some)
            pieces, left = rest, left - size
        self.open, self.filled = [], 0


def term_hashes(size: int) -> np.ndarray:
    """A hash of each id of the vocabulary, 63 bits."""
    h = np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h >> np.uint64(1)


def route(terms: np.ndarray, hashes: np.ndarray) -> int:
    """What brings like documents into one shard: the least hash of a document's ROUTE_TERMS highest ids.

    Ids of a byte-level vocabulary rise with the merges, which go from common to rare, so these are about its rarest terms; documents
    share the least hash as often as they share such terms.
    """
    return int(hashes[terms[-ROUTE_TERMS:]].min()) if len(terms) else 0


def distinct(ids: np.ndarray) -> np.ndarray:
    """The different ids in order; those of two bytes are sorted in time linear in their number."""
    ids = np.sort(ids, kind="stable")
    return ids[np.append(True, ids[1:] != ids[:-1])] if len(ids) else ids


def encoded(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """(doc_id, ids, route, stats) for every row: little-endian ids with end_id, of ID_TYPES[0] if the vocabulary allows; and one more row for each task, all null but its stats (bytes of an id, documents, ids, documents by id)."""

    def run(batches):
        release()
        encode = encoder(path).encode
        size = max(encoder(path).tokenizer.get_vocab_size(), end_id + 1)
        kind = ID_TYPES[size > 1 << 16]
        stats, hashes = np.zeros(size + HEAD, "<i8"), term_hashes(size)
        for batch in sliced(batches):
            keys, found = batch.column(0), encode([t or "" for t in batch.column(1).to_pylist()])
            found = [x.astype(kind) for x in found]
            terms = [distinct(x) for x in found]
            routes = [route(x, hashes) for x in terms]
            ids = [x.tobytes() + np.array(end_id, kind).tobytes() for x in found]
            held = np.bincount(np.concatenate([np.zeros(0, kind), *terms]), minlength=size)
            held[end_id] = len(ids)  # each document once, also where its text holds that id
            stats[HEAD:] += held
            stats[1:HEAD] += len(ids), sum(map(len, ids)) // np.dtype(kind).itemsize
            yield pa.RecordBatch.from_arrays([keys, pa.array(ids, pa.binary()), pa.array(routes, pa.int64()), pa.nulls(len(ids), pa.binary())], names=["doc_id", "ids", "route", "stats"])
        stats[0] = np.dtype(kind).itemsize
        if stats[1]:
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64()), pa.array([stats.tobytes()], pa.binary())], names=["doc_id", "ids", "route", "stats"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids binary, route long, stats binary")


def corpus_of(stats: DataFrame) -> Corpus:
    """The sum of all tasks' statistics, FAN at a time; the driver gets FAN rows at most, each as long as the vocabulary."""

    def add(batches):
        total = 0
        for batch in sliced(batches):
            for raw in batch.column(0).to_pylist():
                one = np.frombuffer(raw, "<i8")
                total = total + one if isinstance(total, np.ndarray) else one.copy()
                total[0] = one[0]
        if isinstance(total, np.ndarray):
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["stats"])

    n = stats.count()
    while n > FAN:
        n = -(-n // FAN)
        stats = materialize(stats.repartition(n).mapInArrow(add, "stats binary"), "term-counts")
    got = [np.frombuffer(r["stats"], "<i8") for r in stats.collect()]
    total = sum(got) if got else np.zeros(HEAD, np.int64)
    return Corpus(int(got[0][0]) if got else 4, int(total[1]), int(total[2]), total[HEAD:])


def pack_documents(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID, window: int = WINDOW) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    Every row's text (null: empty) is encoded once and ends with end_id, so each has at least one piece; ids are written, and document
    frequencies and the mean length counted over all rows. Rows are dealt by ranges of ``route`` and doc_id, which no group of copies can make uneven,
    into partitions of about PARTITION_IDS ids; a task packs its rows shard by shard with an index each, and
    leaves no padding: windows are full but for its last, whose ids go into sequences of powers of two. Equal scores go by the rows' order. Rows with equal or null doc_id
    are packed each as a document; columns beyond doc_id and text play no part. An empty table gives an empty result.
    """
    path = tokenizer or default_path()
    held_ids = materialize(encoded(docs, path, end_id), "ids")
    corpus = corpus_of(held_ids.select("stats").where("stats is not null"))
    mean_size, idf = corpus.ids / max(1, corpus.docs), corpus.idf.astype(np.float32)
    n, kind = shards_for(corpus.ids, PARTITION_IDS), f"<u{corpus.id_bytes}"
    rows_of = held_ids.where("ids is not null").select("doc_id", "ids", "route")
    dealt = rows_of.repartitionByRange(n, "route", "doc_id", F.length("ids")).sortWithinPartitions("route", "doc_id", "ids").select("doc_id", "ids")

    def run(batches):
        forget_encoders()
        release()
        packer = Packer(window, TaskContext.get().partitionId() << 32)
        held: dict[int, tuple] = {}  # documents whose pieces are not all returned
        counter, ids, own = 0, [], []

        def rows(done):
            out = []
            for doc, start, k, sequence, offset in done:
                doc_id, all_ids = held[doc]
                out.append((doc_id, start, k, all_ids[start : start + k].tobytes(), len(all_ids), sequence, offset))
            done.clear()
            live = {doc for doc, *_ in packer.open}
            for doc in [d for d in held if d not in live]:
                del held[doc]
            columns = list(zip(*out, strict=True)) or [[]] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if f == "ids" else pa.int64()) for c, f in zip(columns, FIELDS, strict=True)], names=FIELDS)

        def shard():
            nonlocal counter, ids, own
            numbers = list(range(counter, counter + len(ids)))
            counter += len(ids)
            held.update(zip(numbers, zip(own, ids, strict=True), strict=True))
            packer.pack(numbers, [len(x) for x in ids], Bm25Shard(ids, idf, mean_size))
            ids, own = [], []
            return rows(packer.done)

        total = 0
        for batch in sliced(batches):
            for key, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(np.frombuffer(raw, kind).astype("<u4"))
                own.append(key)
                total += len(ids[-1])
                if len(ids) == SHARD_DOCS or total >= SHARD_IDS:
                    yield shard()
                    total = 0
        if ids:
            yield shard()
        packer.finish()
        if packer.done:
            yield rows(packer.done)

    return dealt.mapInArrow(run, ", ".join(f"{f} {'binary' if f == 'ids' else 'long'}" for f in FIELDS))


def op2_packing(spark, sf_dir: str) -> DataFrame:
    out = pack_documents(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
