"""Embedding near-duplicates: exact threshold pairs by dual traversal of cover trees."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, share_of, table
from .components import connected_components, forest

COSINE = 0.93
#: Vectors in a cell, about; and points of a node that are compared directly.
CELL, LEAF = 4096, 24
#: Slack on bounds, for the rounding of distances between unit vectors.
SLACK = 1e-6


def _distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (x @ y.T)))


class CoverTree:
    """Nested levels over unit vectors: a node's children are centres over half its level's radius apart, the first is its own.

    ``order[low[n]:high[n]]`` are the points below node n, ``centre[n]`` its point, ``radius[n]`` the largest
    distance from there to any of them, ``children[n]`` its nodes one level down (none for a leaf).
    """

    def __init__(self, x: np.ndarray):
        self.x = x
        self.order = np.arange(len(x))
        self.centre, self.low, self.high, self.radius, self.children = [], [], [], [], []
        todo = [(self._add(0, 0, len(x)), 2.0)] if len(x) else []
        while todo:
            n, level = todo.pop()
            if self.high[n] - self.low[n] <= LEAF or self.radius[n] <= SLACK:
                continue
            while level / 2 >= self.radius[n]:  # levels in which the centre covers everything have one node
                level /= 2
            self._split(n, level / 2)
            todo += [(c, level / 2) for c in self.children[n]]

    def _add(self, centre: int, low: int, high: int) -> int:
        self.centre.append(centre)
        self.low.append(low)
        self.high.append(high)
        self.radius.append(float(_distance(self.x[self.order[low:high]], self.x[centre : centre + 1]).max()) if high - low > 1 else 0.0)
        self.children.append([])
        return len(self.centre) - 1

    def _split(self, n: int, r: float) -> None:
        points = self.order[self.low[n] : self.high[n]]
        owner, centres = np.full(len(points), -1), []
        first = _distance(self.x[points], self.x[self.centre[n] : self.centre[n] + 1])[:, 0] <= r
        first |= points == self.centre[n]
        owner[first] = 0
        centres.append(self.centre[n])
        while len(left := np.flatnonzero(owner < 0)):
            block = left[:256]
            near = _distance(self.x[points[block]], self.x[points[block]]) <= r
            np.fill_diagonal(near, True)
            covered, chosen = np.zeros(len(block), bool), []
            for i in range(len(block)):
                if not covered[i]:
                    chosen.append(block[i])
                    covered |= near[i]
            d = _distance(self.x[points[left]], self.x[points[chosen]])
            best = d.argmin(axis=1)
            ok = d[np.arange(len(left)), best] <= r
            owner[left[ok]] = best[ok] + len(centres)
            owner[chosen] = np.arange(len(chosen)) + len(centres)
            centres += points[chosen].tolist()
        by = np.argsort(owner, kind="stable")
        self.order[self.low[n] : self.high[n]] = points[by]
        at = self.low[n]
        for c, size in zip(centres, np.bincount(owner, minlength=len(centres)), strict=True):
            self.children[n].append(self._add(c, at, at + size))
            at += size


def traverse(s: CoverTree, t: CoverTree, weights: tuple[np.ndarray, np.ndarray], cosine: float, offset: int):
    """Links between two trees' points (s is t: within it): weight linked to each point, and edges that connect what links.

    A node pair goes if its centres are farther apart than the threshold distance and both radii; it links whole
    if they are nearer than that distance less both; else its children are paired. Edges number points of t from ``offset``.
    """
    far = math.sqrt(2.0 - 2.0 * cosine)
    same = s is t
    links = [np.zeros(len(s.x)), np.zeros(len(t.x))]
    if same:
        links[1] = links[0]
    a_edges, b_edges, held = [], [], 0
    todo = [(0, 0)] if len(s.x) and len(t.x) else []

    def join(a, b):
        nonlocal held
        a_edges.append(a)
        b_edges.append(b + offset)
        held += len(a)
        if held > 500_000:
            x, y = forest(np.concatenate(a_edges), np.concatenate(b_edges))
            a_edges[:], b_edges[:], held = [x], [y], len(x)

    def compare(p, q):  # all points of p (in s) with all of q (in t), apart from each other
        hit = s.x[p] @ t.x[q].T >= cosine
        if hit.any():
            i, j = np.nonzero(hit)
            links[0][p] += hit @ weights[1][q]
            links[1][q] += weights[0][p] @ hit
            join(p[i], q[j])

    def within(p):
        hit = s.x[p] @ s.x[p].T >= cosine
        np.fill_diagonal(hit, True)
        links[0][p] += hit @ weights[0][p]
        i, j = np.nonzero(hit)
        join(p[i], p[j])

    def points(tree, nodes):
        return np.concatenate([tree.order[tree.low[n] : tree.high[n]] for n in nodes])

    def pair(kids, other, itself):  # nodes of s with nodes of t; of itself, each pair once
        y, ry = t.x[[t.centre[c] for c in other]], np.array([t.radius[c] for c in other])
        leaf_t, one_t = np.array([not t.children[c] for c in other]), np.array([t.high[c] - t.low[c] == 1 for c in other])
        for k in range(0, len(kids), 512):
            part = kids[k : k + 512]
            dots = s.x[[s.centre[c] for c in part]] @ y.T
            near = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * dots)) <= far + SLACK + np.array([s.radius[c] for c in part])[:, None] + ry[None]
            if itself:
                near &= np.arange(len(other))[None] > np.arange(k, k + len(part))[:, None]
            leaf_s, one_s = np.array([not s.children[c] for c in part]), np.array([s.high[c] - s.low[c] == 1 for c in part])
            i, j = np.nonzero(near & (dots >= cosine) & one_s[:, None] & one_t[None])  # single points: their centres decide
            if len(i):
                p, q = np.array([s.centre[part[x]] for x in i]), np.array([t.centre[other[x]] for x in j])
                np.add.at(links[0], p, weights[1][q])
                np.add.at(links[1], q, weights[0][p])
                join(p, q)
            for x in np.flatnonzero(leaf_s & ~one_s):  # a leaf of several points with every leaf near it, at once
                if len(js := np.flatnonzero(near[x] & leaf_t)):
                    compare(points(s, [part[x]]), points(t, [other[z] for z in js]))
            for z in np.flatnonzero(leaf_t & ~one_t):
                if len(xs := np.flatnonzero(near[:, z] & one_s)):
                    compare(points(s, [part[x] for x in xs]), points(t, [other[z]]))
            i, j = np.nonzero(near & ~(leaf_s[:, None] & leaf_t[None]))
            todo.extend((part[x], other[z]) for x, z in zip(i.tolist(), j.tolist(), strict=True))

    while todo:
        m, n = todo.pop()
        p, q = s.order[s.low[m] : s.high[m]], t.order[t.low[n] : t.high[n]]
        itself = same and m == n
        d = 0.0 if itself else float(_distance(s.x[s.centre[m]][None], t.x[t.centre[n]][None])[0, 0])
        if d + s.radius[m] + t.radius[n] <= far - SLACK:  # all pairs link
            links[0][p] += weights[1][q].sum()
            if not itself:
                links[1][q] += weights[0][p].sum()
            join(p, np.full(len(p), t.centre[n]))
            join(np.full(len(q), s.centre[m]), q)
        elif itself and not s.children[m]:
            within(p)
        elif itself:
            todo += [(c, c) for c in s.children[m]]
            pair(s.children[m], s.children[m], True)
        elif not s.children[m] and not t.children[n]:
            compare(p, q)
        else:
            pair(s.children[m] or [m], t.children[n] or [n], False)
    edges = forest(np.concatenate(a_edges), np.concatenate(b_edges)) if a_edges else (np.zeros(0, int), np.zeros(0, int))
    return links, edges


def _unit(rows) -> np.ndarray:
    x = np.array([np.asarray(v, np.float64) for v in rows])
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so squares of very large or small components stay in range
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def usable(embedding: str = "embedding"):
    """True for vectors that can link: not null, no null or non-finite component, not all zero."""
    v = F.col(embedding)
    ok = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    return F.coalesce(ok, F.lit(False))


def near_vectors(vectors: DataFrame, cosine: float = COSINE, cell: int = CELL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of (vec_id, embedding, label).

    Vectors with equal labels link at ``cosine`` or more. Equal vectors of a label are one class before anything
    is compared. Each label's classes are dealt to cells around a share of themselves (the top nodes); a vector also
    goes to every cell whose covering radius it might reach, and cells of too many vectors are split. A task
    builds a cover tree for each of two cells and traverses both; it returns a link count for each vector and its links
    as stars, never pairs. Vectors with a null label, or null, zero or non-finite, link with nothing; vectors
    of another dimension link only among themselves; rows with a null vec_id count as links, and stay alone if unusable. Repeated rows link with each other.
    """
    spark = vectors.sparkSession
    rows = materialize(vectors.select("vec_id", "label", "embedding", (usable() & F.col("label").isNotNull()).alias("ok")), "vectors")
    classes = rows.where("ok").groupBy("label", F.size("embedding").alias("dim"), "embedding").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    classes = materialize(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")  # written, so the numbers stay
    n = classes.count()
    share = 1.0 / max(cell, math.isqrt(n))  # so the pivots are at most sqrt(n), and one more for each label
    lead = classes.groupBy("label", "dim").agg(F.min("cls").alias("cls"))
    fields = ["label", "dim", "cls", "embedding"]
    pivots = classes.where(share_of("cls", share)).select(*fields).union(classes.join(lead.select("cls"), "cls", "left_semi").select(*fields)).dropDuplicates(["cls"])
    table_of: dict[tuple, list] = {}
    for r in pivots.toLocalIterator():
        table_of.setdefault((r["label"], r["dim"]), []).append((r["cls"], r["embedding"]))
    centres = {k: _unit([v for _, v in sorted(x, key=lambda y: y[0])]) for k, x in table_of.items()}

    def assign(batches):
        for pdf in batches:
            out = []
            for key, part in pdf.groupby(["label", "dim"]):
                d = _distance(_unit(part["embedding"]), centres[(key[0], key[1])])
                out.append(part.assign(cell=d.argmin(axis=1), far=d.min(axis=1)))
            if out:
                yield pd.concat(out)[["label", "dim", "cls", "copies", "embedding", "cell", "far"]]

    typed = classes.schema["label"].dataType.simpleString()
    kind = classes.schema["embedding"].dataType.simpleString()
    placed = materialize(classes.select("label", "dim", "cls", "copies", "embedding").mapInPandas(assign, f"label {typed}, dim int, cls long, copies long, embedding {kind}, cell int, far double"), "placed")
    sizes = {(r["label"], r["dim"], r["cell"]): (r["n"], r["far"]) for r in placed.groupBy("label", "dim", "cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).toLocalIterator()}
    reach = math.sqrt(2.0 - 2.0 * cosine) + SLACK
    parts = {k: -(-v[0] // (2 * cell)) for k, v in sizes.items()}  # sub-cells of a cell
    first: dict[tuple, int] = {}
    for k in sorted(parts):
        first[k] = first.get((k[0], k[1], "next"), 0)
        first[(k[0], k[1], "next")] = first[k] + parts[k]

    def route(batches):
        for pdf in batches:
            out = []
            for (label, dim, c), part in pdf.groupby(["label", "dim", "cell"]):
                key = (label, dim)
                own = first[(*key, int(c))] + (part["cls"].to_numpy() % parts[(*key, int(c))])
                d = _distance(_unit(part["embedding"]), centres[key])
                for j in range(len(centres[key])):
                    if (*key, j) not in sizes:
                        continue
                    near = d[:, j] <= sizes[(*key, j)][1] + reach if j != c else np.ones(len(part), bool)
                    for sub in range(first[(*key, j)], first[(*key, j)] + parts[(*key, j)]):
                        some = part[near]
                        mine = own[near]
                        out.append(some.assign(mine=mine, a=np.minimum(mine, sub), b=np.maximum(mine, sub)))
            if out:
                yield pd.concat(out)[["label", "dim", "cls", "copies", "embedding", "mine", "a", "b"]]

    dealt = placed.mapInPandas(route, f"label {typed}, dim int, cls long, copies long, embedding {kind}, mine int, a int, b int")

    def compare(key, pdf):
        a, b = key[2], key[3]
        pdf = pdf.sort_values("cls")
        sides = [pdf[pdf["mine"] == a]] if a == b else [pdf[pdf["mine"] == a], pdf[pdf["mine"] == b]]
        trees = [CoverTree(_unit(x["embedding"])) if len(x) else None for x in sides]
        if None in trees:
            return pd.DataFrame({"cls": [], "root": [], "links": []})
        w = [x["copies"].to_numpy(float) for x in sides]
        links, (x, root) = traverse(trees[0], trees[-1], (w[0], w[-1]), cosine, 0 if a == b else len(sides[0]))
        ids = np.concatenate([s["cls"].to_numpy() for s in sides])
        got = np.concatenate(links[: len(sides)])
        top = ids.copy()
        top[x] = ids[root]
        keep = (got > 0) | (top != ids)
        return pd.DataFrame({"cls": ids[keep], "root": top[keep], "links": np.rint(got[keep]).astype(np.int64)})

    found = materialize(dealt.groupBy("label", "dim", "a", "b").applyInPandas(compare, "cls long, root long, links long"), "links")
    stars = connected_components(found.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    total = found.groupBy("cls").agg(F.sum("links").alias("links"))
    named = classes.select("label", "dim", "embedding", "cls", "first").join(total, "cls", "left").join(stars, F.col("cls") == F.col("node"), "left")
    named = named.withColumn("root", F.coalesce("root", "cls"))
    named = materialize(named.select("label", "embedding", "root", "first", "links"), "named")
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    of_class = named.join(least, "root").select("links", "component_id", F.col("label").alias("_l"), F.col("embedding").alias("_e"))
    linked = rows.where("ok").join(of_class, (F.col("embedding") == F.col("_e")) & (F.col("label") == F.col("_l"))).select("vec_id", (F.col("links") - 1).cast("long").alias("n_links"), "component_id")
    alone = rows.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))  # without a join, however many there are
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op3_covertree(spark, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


#: Pairs of a label in DuckDB, with components by reachability; the tables of sf0.01 are small enough.
OP3_SQL = """
with recursive v as (
  select vec_id, label, cast(embedding as double[]) as e from embeddings
), p as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id
  where list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.93
), r(a, b) as (
  select vec_id, vec_id from v union select r.a, p.b from r join p on r.b = p.a
), c as (select a, min(b) as component_id from r group by a),
n as (select a, count(*) as n_links from p group by a)
select v.vec_id, coalesce(n.n_links, 0) as n_links, c.component_id, v.vec_id = c.component_id as kept
from v join c on c.a = v.vec_id left join n on n.a = v.vec_id
"""
