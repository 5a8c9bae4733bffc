"""Hard negatives by an inverted multi-index: cells of two half-space codebooks, visited by bound until the windows are certain."""

from __future__ import annotations

from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize, share_of, shards_for, sliced, table

#: Positives of an anchor, negatives of a positive; percent of the positive's score that a negative has at least and at most.
POSITIVES, NEGATIVES, LOW, HIGH = 5, 3, 50, 95
#: Codewords of each half; vectors that they are fitted to at most, and rounds of it; vectors of a shard, anchors of a block; rows scored at once.
CODEWORDS, SAMPLE, ROUNDS, SHARD, BLOCK, BATCH = 64, 20_000, 12, 8192, 2048, 256
#: Slack on bounds, for rounding, as a share of their size.
SLACK = 1e-9


def fit_codebook(x: np.ndarray, k: int = CODEWORDS, rounds: int = ROUNDS) -> np.ndarray:
    """At most k centres of the rows of x by Lloyd's rounds from a seeded draw; the same for the same rows in any order."""
    x = np.unique(x, axis=0)
    centres = x[np.sort(np.random.default_rng(11).choice(len(x), min(k, len(x)), replace=False))] if len(x) else np.zeros((1, x.shape[1]))
    for _ in range(rounds if len(x) else 0):
        own = nearest(x, centres)
        n = np.bincount(own, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, own, x)
        centres = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centres)
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of each row, the first of equals."""
    return np.concatenate([((centres * centres).sum(1) - 2 * (x[i : i + 4096] @ centres.T)).argmin(1) for i in range(0, len(x), 4096)]) if len(x) else np.zeros(0, int)


class MultiIndex:
    """The vectors of a shard by cell: one codeword for each half. A codeword's radius is the largest distance of its vectors' halves from it."""

    def __init__(self, x: np.ndarray, codes: tuple[np.ndarray, np.ndarray], books: tuple[np.ndarray, np.ndarray]):
        self.x, self.books, half = x, books, books[0].shape[1]
        self.radius = []
        for c, book, part in zip(codes, books, (x[:, :half], x[:, half:]), strict=True):
            r = np.full(len(book), -1.0)
            np.maximum.at(r, c, np.sqrt(((part - book[c]) ** 2).sum(1)))
            self.radius.append(r)
        cell = codes[0].astype(np.int64) * len(books[1]) + codes[1]
        self.order = np.argsort(cell, kind="stable")
        names, first = np.unique(cell[self.order], return_index=True)
        ends = [*first[1:].tolist(), len(cell)]
        self.cells = dict(zip(names.tolist(), zip(first.tolist(), ends, strict=True), strict=True))

    def sides(self, q: np.ndarray) -> list[tuple[list[int], list[float], list[float]]]:
        """For each half: codewords that have vectors, by bound from high to low; their bounds; and their centres' scores."""
        out, half = [], self.books[0].shape[1]
        for book, r, part in zip(self.books, self.radius, (q[:half], q[half:]), strict=True):
            there = np.flatnonzero(r >= 0)
            centre = book[there] @ part
            bound = centre + np.sqrt((part * part).sum()) * r[there]
            by = np.argsort(-bound, kind="stable")
            out.append((there[by].tolist(), bound[by].tolist(), centre[by].tolist()))
        return out

    def visit(self, q: np.ndarray):
        """Cells that have vectors, by the sum of their halves' bounds from high to low: the most and the least that a score there may be, first and end in ``order``."""
        (a, bound_a, mid_a), (b, bound_b, mid_b) = self.sides(q)
        if not a:
            return
        heap = [(-(bound_a[0] + bound_b[0]), 0, 0)]
        while heap:
            low, i, j = heappop(heap)
            if j + 1 < len(b):
                heappush(heap, (-(bound_a[i] + bound_b[j + 1]), i, j + 1))
            if not j and i + 1 < len(a):
                heappush(heap, (-(bound_a[i + 1] + bound_b[0]), i + 1, 0))
            if span := self.cells.get(a[i] * len(self.books[1]) + b[j]):
                slack = SLACK * (1 + abs(low))
                yield -low + slack, 2 * (mid_a[i] + mid_b[j]) + low - slack, *span

    def scored(self, q: np.ndarray, enough, skip=None):
        """(rows, scores) of the cells in the order of ``visit``, BATCH rows or more at once, until ``enough(bound)`` is true of the next bound; cells whose least score ``skip`` takes are left out."""
        held, size = [], 0
        for most, least, first, end in self.visit(q):
            if enough(most):
                break
            if skip and skip(least):
                continue
            held.append(self.order[first:end])
            size += end - first
            if size >= BATCH:
                rows = np.concatenate(held)
                held, size = [], 0
                yield rows, self.x[rows] @ q
                if enough(most):
                    return
        if held:
            rows = np.concatenate(held)
            yield rows, self.x[rows] @ q


def best_positives(index: MultiIndex, q: np.ndarray, same: np.ndarray, ids: list, own: int, k: int, floor: float) -> list[tuple[float, int]]:
    """The k best (score, id) of the rows that ``same`` marks, without ``own``, none below ``floor``; equal scores by id. Cells are visited until none may hold a better one."""
    best: list[tuple[float, int]] = []
    for rows, scores in index.scored(q, lambda most: most < (max(floor, -best[k - 1][0]) if len(best) >= k else floor)):
        hit = np.flatnonzero(same[rows] & (scores >= (max(floor, -best[k - 1][0]) if len(best) >= k else floor)))
        if len(hit):
            found = [(-float(scores[h]), i) for h in hit.tolist() for i in ids[rows[h]] if i != own]
            best = sorted(best + found)[:k]
    return [(-s, i) for s, i in best]


def best_in_windows(index: MultiIndex, q: np.ndarray, other: np.ndarray, ids: list, windows: list[tuple[float, float]], k: int) -> list[list[tuple[float, int]]]:
    """For each window (least, most) the k best (score, id) within it of the rows that ``other`` marks. A window is certain when the next cell's bound lies below its k-th score, or below its end; all certain, the visit stops."""
    best: list[list[tuple[float, int]]] = [[] for _ in windows]
    top, bottom = max(w[1] for w in windows), min(w[0] for w in windows)

    def certain(most):
        return all(most < (max(low, -b[k - 1][0]) if len(b) >= k else low) for b, (low, _) in zip(best, windows, strict=True))

    for rows, scores in index.scored(q, certain, lambda least: least > top):
        mine = other[rows] & (scores >= bottom) & (scores <= top)
        rows, scores = rows[mine], scores[mine]
        for n, (low, high) in enumerate(windows):
            hit = np.flatnonzero((scores >= (max(low, -best[n][k - 1][0]) if len(best[n]) >= k else low)) & (scores <= high))
            if len(hit):
                if len(hit) > 4 * k:  # only what may be among the first k, ties and all
                    hit = hit[scores[hit] >= np.partition(scores[hit], -k)[-k]]
                best[n] = sorted(best[n] + [(-float(scores[h]), i) for h in hit.tolist() for i in ids[rows[h]]])[:k]
    return [[(-s, i) for s, i in b] for b in best]


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    """Rows of a list column, short ones filled with zeros."""
    flat = column.combine_chunks()
    flat = flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat
    n = np.diff(flat.offsets.to_numpy())
    out = np.zeros((len(n), dim))
    out[np.repeat(np.arange(len(n)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)] = flat.flatten().to_numpy()
    return out


def usable(vector: Column) -> Column:
    """True for vectors without null and non-finite components; false for null."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))


def hard_negatives(vectors: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for rows of (vec_id, label, vector), whole-numbered vectors whose products stay below 2^53.

    An anchor's positives are its best other rows of the same label by inner product; of each, the best rows of other labels are returned with a score of low to high percent of the
    positive's. Higher scores come first, ties by smaller vec_id. Rows with a null vec_id, label or vector or a null or non-finite component take no part; shorter vectors count as filled with zeros; rows that
    repeat in all three are one, a vec_id with several labels or vectors is several rows. An empty table gives an empty result.

    Of equal vectors of a label only the first few ids can be returned, so only they are kept. Codebooks are fitted to SAMPLE vectors at most; every vector lies in a cell, cells are dealt to shards in
    order. An anchor asks its own shard first, which gives the score its last positive has at least, then the others, whose cells must reach that; blocks of anchors meet all shards.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("vector").cast("array<double>").alias("vector"), anchor.alias("asks"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector")))
    rows = rows.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))  # no negative zeros, so equal vectors are equal keys
    keep = max(positives + 1, negatives)
    first = rows.withColumn("_k", F.dense_rank().over(W.partitionBy("label", "vector").orderBy("vec_id"))).where(F.col("_k") <= keep)
    classes = materialize(first.groupBy("label", "vector").agg(F.array_sort(F.collect_set("vec_id")).alias("ids")), "classes")
    size = classes.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("dim")).first()
    n, dim = size["n"], max(2, size["dim"] or 0)
    label_kind = classes.schema["label"].dataType.simpleString()
    lead = F.element_at("ids", 1)
    sample = classes.withColumn("_id", lead).where(share_of("_id", 2 * SAMPLE / max(1, n))).orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE).select("vector").toArrow()
    drawn = _matrix(sample.column("vector"), dim)
    books = tuple(fit_codebook(part) for part in (drawn[:, : dim // 2], drawn[:, dim // 2 :]))

    def place(batches):
        for batch in sliced(batches):
            x = _matrix(pa.chunked_array([batch.column(1)]), dim)
            codes = [pa.array(nearest(p, b).astype(np.int32)) for p, b in zip((x[:, : dim // 2], x[:, dim // 2 :]), books, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *codes], names=["label", "vector", "ids", "a", "b"])

    def number(batches):
        shard = TaskContext.get().partitionId()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, shard, np.int32))], names=["label", "vector", "ids", "a", "b", "shard"])

    fields = f"label {label_kind}, vector array<double>, ids array<long>, a int, b int"
    dealt = classes.select("label", "vector", "ids").mapInArrow(place, fields).repartitionByRange(shards_for(n, SHARD), "a", "b", F.element_at("ids", 1), F.xxhash64("vector"))
    placed = materialize(dealt.mapInArrow(number, fields + ", shard int"), "cells")
    asking = rows.where("asks").select("vec_id", "label", "vector").distinct().join(placed.select("label", "vector", "shard"), ["label", "vector"])
    asking = materialize(asking.withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    blocks = shards_for(asking.count(), BLOCK)
    asking = asking.withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(blocks)).cast("int"))
    cells = placed.select(F.col("shard").alias("of"), F.col("label").alias("own"), F.col("vector").alias("x"), "ids", "a", "b").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    all_shards = F.sequence(F.lit(0), F.lit(placed.agg(F.coalesce(F.max("shard"), F.lit(0)).alias("s")).first()["s"]))

    def meet(asked: DataFrame, search, schema: str) -> DataFrame:
        """``search`` for every anchor of a block in the index of a shard."""

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            names = [f.split()[0] for f in schema.split(", ")]
            found = []
            if left.num_rows and right.num_rows:
                x, codes = _matrix(left.column("x"), dim), tuple(left.column(c).to_numpy() for c in ("a", "b"))
                index, ids = MultiIndex(x, codes, books), left.column("ids").to_pylist()
                labels = left.column("own").combine_chunks().dictionary_encode()
                labels = labels.combine_chunks() if isinstance(labels, pa.ChunkedArray) else labels
                code, known = labels.indices.to_numpy(), {v: k for k, v in enumerate(labels.dictionary.to_pylist())}
                for r, q in zip(right.drop_columns("vector").to_pylist(), _matrix(right.column("vector"), dim), strict=True):
                    found += search(index, ids, code == known.get(r["label"], -1), r, q)
            columns = list(zip(*found, strict=True)) or [[]] * len(names)
            types = {"long": pa.int64(), "double": pa.float64()}
            return pa.table([pa.array(c, types[f.split()[1]]) for c, f in zip(columns, schema.split(", "), strict=True)], names=names)

        return cells.groupBy("of", "part").cogroup(asked.groupBy("shard", "block")).applyInArrow(run, schema)

    def ask_positives(index, ids, same, r, q):
        return [(r["anchor"], i, s) for s, i in best_positives(index, q, same, ids, r["vec_id"], positives, r["floor"])]

    def ask_negatives(index, ids, same, r, q):
        scores = r["scores"]
        spans = [(-(-low * p // 100), high * p // 100) for p in map(int, scores)]
        live = [k for k, (a, b) in enumerate(spans) if a <= b]
        if not live:
            return []
        got = best_in_windows(index, q, ~same, ids, [spans[k] for k in live], negatives)
        return [(r["anchor"], float(scores[k]), i, s) for k, b in zip(live, got, strict=True) for s, i in b]

    hit, best = "anchor long, positive_id long, score double", W.partitionBy("anchor").orderBy(F.desc("score"), "positive_id")
    home = materialize(meet(asking.withColumn("floor", F.lit(float("-inf"))), ask_positives, hit), "home")
    last = home.groupBy("anchor").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= positives).select("anchor", F.col("least").alias("floor"))
    bounded = asking.join(last, "anchor", "left").na.fill(float("-inf"), ["floor"])
    away = bounded.withColumn("shard", F.explode(F.filter(all_shards, lambda s: s != F.col("shard"))))
    every = home.union(meet(away, ask_positives, hit))
    chosen = materialize(every.withColumn("_k", F.row_number().over(best)).where(F.col("_k") <= positives).drop("_k"), "positives")
    wanted = chosen.groupBy("anchor").agg(F.array_sort(F.collect_set("score")).alias("scores"))
    everywhere = asking.join(wanted, "anchor").withColumn("shard", F.explode(all_shards))
    got = meet(everywhere, ask_negatives, "anchor long, score double, negative_id long, negative_score double")
    order = W.partitionBy("anchor", "score").orderBy(F.desc("negative_score"), "negative_id")
    ranked = got.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    out = chosen.join(ranked, ["anchor", "score"]).join(asking.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", F.col("score").cast("long").alias("positive_score"), F.col("negative_score").cast("long").alias("negative_score"))


def relabelled(spark, sf_dir: str) -> DataFrame:
    """Embeddings as whole numbers, floor(256 x) of each component, with the labels of every seventh vec_id moved on by one."""
    v = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform("embedding", lambda x: F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), x.cast("double")).otherwise(F.floor(x.cast("double") * 256).cast("double")))
    return v.select("vec_id", label.alias("label"), whole.alias("vector"))


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    return hard_negatives(relabelled(spark, sf_dir), F.col("vec_id") % 50 == 0)


#: All scores of anchors.
OP13_SQL = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as x
  from embeddings where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, cast(list_dot_product(a.x, b.x) as bigint) as score from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0
), p as (
  select * from (select anchor_id, vec_id as positive_id, score as positive_score, row_number() over (partition by anchor_id order by score desc, vec_id) as k from s where same) where k <= 5
), n as (
  select anchor_id, positive_id, positive_score, vec_id as negative_id, score as negative_score, row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as rank
  from p join s using (anchor_id) where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
)
select anchor_id, positive_id, cast(rank as int) as rank, negative_id, positive_score, negative_score from n where rank <= 3
"""
