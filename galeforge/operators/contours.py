"""Outlines of the regions above a threshold: closed rings of edge crossings.

Nodes are (keys, r, c, lat, lon, value); rows count from the north, columns from the west. A node above a threshold is inside; a node that is missing, null or NaN is outside, and so is
what lies beyond the field. Between two nodes with values a ring crosses where linear interpolation puts the threshold; between a node and nothing it runs through the node, so every
ring is closed and follows the field's border. Where two inside nodes of a square face each other, they are joined if the mean of its four corners is above the threshold.
Rings have the inside on their left: outer ones have a positive area, holes a negative one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.geo import number_text
from ..sources.scratch import bound_batches, scratch, written
from ..sources.tables import dealt
from .envelopes import AREA_KM

#: A tile has 2^8 rows and columns of squares, where no other number is asked for.
BITS = 8
_POINT = ("v", "n", "lat", "lon", "lat2", "lon2")
_BOUNDS = ("lon_min", "lon_max", "lat_min", "lat_max")


def tiles(field: DataFrame, keys: list[str], n_rows: int | None = None, bits: int = BITS) -> DataFrame:
    """(keys, tile, nodes): the nodes by tile of squares, in order; those on the edge of a tile are in each tile that has a square of theirs. ``n_rows``, if known, is about how many nodes there are.

    A square is named by its north-western corner, from row and column -1 on, and is in one tile. Nodes without a key, a place in the grid or a value are left out.
    """
    tile = lambda r, c: F.shiftleft(F.shiftright(r + 1, bits).cast("long"), 32) + F.shiftright(c + 1, bits)
    r, c = F.col("r").cast("int"), F.col("c").cast("int")
    around = F.array_distinct(F.array(tile(r, c), tile(r, c - 1), tile(r - 1, c), tile(r - 1, c - 1)))
    whole = F.col("value").isNotNull() & ~F.isnan("value")
    for k in (*keys, "r", "c"):
        whole &= F.col(k).isNotNull()
    nodes = field.where(whole).select(*keys, F.explode(around).alias("tile"), F.struct(r.alias("r"), c.alias("c"), *[F.col(x).cast("double").alias(x) for x in ("value", "lat", "lon")]).alias("node"))
    if n_rows is not None:
        nodes = dealt(nodes, n_rows, *keys, "tile")
    return nodes.groupBy(*keys, "tile").agg(F.sort_array(F.collect_list("node")).alias("nodes"))


def _segments(tile: int, node: dict[str, np.ndarray], t: float, bits: int) -> dict[str, np.ndarray]:
    """v, n, lat, lon, lat2, lon2 of a tile's squares, by v: from crossing v straight to crossing n with the inside on the left. Every crossing is the start of one segment and the end of one, be it in another tile.

    A crossing's number is of its edge's northern or western node and of whether the edge runs south, so all squares of an edge give it the same number, and the same place.
    """
    r, c = node["r"].astype(np.int64), node["c"].astype(np.int64)
    high = (tile + (1 << 31)) >> 32
    top, left = (high << bits) - 1, (tile - (high << 32) << bits) - 1  # the tile's first square
    r0, c0 = max(top, int(r.min()) - 1), max(left, int(c.min()) - 1)
    shape = (min(top + (1 << bits), int(r.max()) + 1) - r0 + 1, min(left + (1 << bits), int(c.max()) + 1) - c0 + 1)
    v, y, x = (np.full(shape, np.nan) for _ in range(3))
    for to, name in ((v, "value"), (y, "lat"), (x, "lon")):
        to[r - r0, c - c0] = node[name]
    corners = lambda g: (g[:-1, :-1], g[:-1, 1:], g[1:, 1:], g[1:, :-1])  # noqa: E731  clockwise from north-west; edge k lies between corners k and k + 1
    b, vs = corners(v > t), corners(v)
    facing = (b[0] == b[2]) & (b[1] == b[3]) & (b[0] != b[1])
    mean = (vs[0] + vs[1] + vs[2] + vs[3]) / 4
    joined = facing & ~np.isnan(vs).any(axis=0) & ~(mean <= t)
    found = []
    for k in range(4):  # the inside corners from k on, clockwise: in over the edge before them, out over the edge after
        at = np.nonzero(b[k] & ~b[(k + 3) % 4])
        nxt, after = b[(k + 1) % 4][at], b[(k + 2) % 4][at]
        out = np.where(joined[at], (k + 2) % 4, np.where(~nxt, k, np.where(~after, (k + 1) % 4, (k + 2) % 4)))
        found.append((*at, np.full(len(out), (k + 3) % 4), out))
    i, j, into, out = (np.concatenate(z) for z in zip(*found, strict=True))

    def crossing(e):
        p, q, south = i + (e == 2), j + (e == 1), e & 1
        p2, q2 = p + south, q + 1 - south
        va, vb = v[p, q], v[p2, q2]
        share = (t - va) / (vb - va)
        between = lambda g: np.where(np.isnan(va), g[p2, q2], np.where(np.isnan(vb), g[p, q], g[p, q] + share * (g[p2, q2] - g[p, q])))
        return (p + r0 + 1) * (1 << 33) + (q + c0 + 1) * 2 + south, between(y), between(x)

    (a, lat, lon), (z, lat2, lon2) = crossing(into), crossing(out)
    by_v = np.argsort(a)
    return {name: col[by_v] for name, col in zip(_POINT, (a, z, lat, lon, lat2, lon2), strict=True)}


def _walk(v: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What each of a tile's segments, which are sorted by v, leads to, and in how many steps: the least segment of its ring or, less by their number, the last one of a line that leaves the tile. By pointer doubling."""
    m = len(v)
    ahead, step = np.zeros(m, np.int64), 1
    to = np.minimum(np.searchsorted(v, n), m - 1)
    last = v[to] != n
    own = np.arange(m)
    to, least = np.where(last, own, to), np.where(last, own - m, own)
    while True:
        beyond = least[to]
        less = beyond < least
        if not less.any():
            return least, ahead
        least, ahead = np.where(less, beyond, least), np.where(less, step + ahead[to], ahead)
        to, step = to[to], step * 2


def _lines(tile: int, node: dict[str, np.ndarray], t: float, bits: int, closed: bool) -> tuple[dict[str, np.ndarray], np.ndarray] | None:
    """A tile's segments line by line, each from its least crossing or its entry on, and the number of segments of each line; closed rings, or lines that leave the tile."""
    seg = _segments(tile, node, t, bits)
    if not len(seg["v"]):
        return None
    least, ahead = _walk(seg["v"], seg["n"])
    mine = np.nonzero((least >= 0) == closed)[0]
    if not len(mine):
        return None
    _, line, size = np.unique(least[mine], return_inverse=True, return_counts=True)
    size_of, ahead = size[line], ahead[mine]
    at = (np.cumsum(size) - size)[line] + (np.where(ahead == 0, 0, size_of - ahead) if closed else size_of - 1 - ahead)
    order = np.empty(len(mine), np.int64)
    order[at] = mine
    return {name: col[order] for name, col in seg.items()}, size


def _sums(x: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches of x, each added up from its first number on."""
    by_size = np.argsort(-size, kind="stable")
    first, n = (np.cumsum(size) - size)[by_size], size[by_size]
    left = len(size) - np.cumsum(np.bincount(size))  # stretches longer than k
    out = np.zeros(len(size))
    for k in range(n[0]):
        out[: left[k]] += x[first[: left[k]] + k]
    return _back(out, by_size)


def _back(x: np.ndarray, order: np.ndarray) -> np.ndarray:
    out = np.empty_like(x)
    out[order] = x
    return out


def _points(seg: dict, size: np.ndarray) -> dict:
    """The segments of closed rings with ring and ahead."""
    pos = np.arange(len(seg["v"])) - np.repeat(np.cumsum(size) - size, size)
    n = np.repeat(size, size)
    return seg | {"ring": np.repeat(seg["v"][np.cumsum(size) - size], size), "ahead": np.where(pos == 0, 0, n - pos)}


def _measures(seg: dict, size: np.ndarray) -> dict:
    """A row for each closed ring. As in Spark NaN is above all numbers."""
    first = np.cumsum(size) - size
    area = _sums((seg["lon"] * seg["lat2"] - seg["lon2"] * seg["lat"]) / 2, size)
    bounds = [f.reduceat(seg[c], first) for c in ("lon", "lat") for f in (np.fmin, np.maximum)]
    return {"ring": seg["v"][first], "n_points": size, "area": area} | dict(zip(_BOUNDS, bounds, strict=True))


def _stretches(seg: dict, size: np.ndarray) -> dict:
    """A row for each line that leaves its tile: from crossing v to crossing n over n_points segments, with the least crossing on it and the steps to that from v."""
    first = np.cumsum(size) - size
    ring = np.minimum.reduceat(seg["v"], first)
    least = np.nonzero(seg["v"] == np.repeat(ring, size))[0]
    points = pa.ListArray.from_arrays(pa.array(np.append(first, len(seg["v"])), pa.int32()), pa.StructArray.from_arrays([pa.array(seg[c]) for c in _POINT], list(_POINT)))
    return {"v": seg["v"][first], "n": seg["n"][first + size - 1], "ring": ring, "ahead": least - first, "n_points": size, "points": points}


_DOUBLES = "lat double, lon double, lat2 double, lon2 double"
#: What is made of a tile's lines: columns, whether of closed ones, and how.
_KINDS = {
    "points": (f"v long, n long, {_DOUBLES}, ring long, ahead long", True, _points),
    "rings": ("ring long, n_points long, area double, " + ", ".join(f"{b} double" for b in _BOUNDS), True, _measures),
    "stretches": (f"v long, n long, ring long, ahead long, n_points long, points array<struct<v: long, n: long, {_DOUBLES}>>", False, _stretches),
}


def _traced(tiled: DataFrame, keys: list[str], thresholds: dict[int, float], bits: int, kind: str) -> DataFrame:
    """(keys, threshold, the kind's columns) of the lines in each tile; a tile is worked on by itself."""
    columns, closed, of = _KINDS[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                nodes = row.column("nodes").flatten()
                node = {name: nodes.field(name).to_numpy(zero_copy_only=False) for name in ("r", "c", "value", "lat", "lon")}
                for name, t in thresholds.items():
                    with np.errstate(all="ignore"):
                        lines = _lines(row.column("tile")[0].as_py(), node, t, bits, closed)
                    if lines is None:
                        continue
                    cols = {c: pa.array(x) if isinstance(x, np.ndarray) else x for c, x in of(*lines).items()}
                    n = len(next(iter(cols.values())))
                    same = {c: pa.repeat(row.column(c)[0], n) for c in keys} | {"threshold": pa.array(np.full(n, name, np.int32))}
                    yield pa.RecordBatch.from_pydict(same | cols)

    bound_batches(tiled.sparkSession)
    typed = "".join(f"`{c}` {tiled.schema[c].dataType.simpleString()}, " for c in keys)
    return tiled.mapInArrow(run, f"{typed}threshold int, {columns}")


def _joined(stretches: DataFrame, keys: list[str]) -> DataFrame:
    """The segments of rings that cross tiles, with ``ring``, the least crossing of the ring, and ``ahead``, the steps from their start to it.

    Pointer doubling over the stretches within tiles: after round k one knows the least crossing among the 2^k from it on and points beyond them, so a ring of n stretches takes about log2 n rounds of one equi-join. Where
    the least of two is the same, or the pointer is back at its start, the ring is closed and its stretches leave; what points to one that has left is closed too. Rounds are written, which cuts lineage.
    """
    by = [*keys, "threshold"]
    spark, base = stretches.sparkSession, scratch(stretches.sparkSession, "rings")
    now, paths = stretches.select(*by, "v", "n", "ring", "ahead", F.col("n_points").alias("span"), "n_points"), []
    while True:
        beyond = now.select(*by, F.col("v").alias("n"), F.col("n").alias("n2"), F.col("ring").alias("ring2"), F.col("ahead").alias("ahead2"), F.col("span").alias("span2"))
        less = F.col("ring2") < F.col("ring")
        closed = F.col("n2").isNull() | (F.col("ring") == F.col("ring2")) | (F.col("n2") == F.col("v"))
        out = now.join(beyond, [*by, "n"], "left").select(
            *by, "v", F.col("n2").alias("n"), F.when(less, F.col("ring2")).otherwise(F.col("ring")).alias("ring"), F.when(less, F.col("span") + F.col("ahead2")).otherwise(F.col("ahead")).alias("ahead"),
            (F.col("span") + F.col("span2")).alias("span"), "n_points", closed.alias("closed"),
        )
        paths.append(f"{base}/{len(paths)}")
        now = written(out, "rings", paths[-1]).where("not closed").drop("closed")
        if now.isEmpty():
            break
    done = spark.read.schema(out.schema).parquet(*paths).where("closed").select(*by, "v", F.col("ring").alias("_ring"), F.col("ahead").alias("_ahead"), "n_points")
    whole = done.groupBy(*by, "_ring").agg(F.sum("n_points").alias("_whole"))
    found = done.drop("n_points").join(whole, [*by, "_ring"])
    points = stretches.select(*by, "v", "points").join(found, [*by, "v"]).select(*by, "_ring", "_ahead", "_whole", F.posexplode("points").alias("_pos", "_p"))
    left = F.col("_ahead") - F.col("_pos")
    return points.select(*by, "_p.*", F.col("_ring").alias("ring"), F.when(left < 0, left + F.col("_whole")).otherwise(left).alias("ahead"))


def _tiled(field: DataFrame, keys: list[str], thresholds: dict[int, float], n_rows: int | None, bits: int) -> tuple[DataFrame, DataFrame]:
    """The tiles, written, and the segments of rings that cross them."""
    tiled = written(tiles(field, keys, n_rows, bits), "tiles")
    return tiled, _joined(written(_traced(tiled, keys, thresholds, bits, "stretches"), "stretches"), keys)


def ring_points(field: DataFrame, keys: list[str], thresholds: dict[int, float], n_rows: int | None = None, bits: int = BITS) -> DataFrame:
    """(keys, threshold, v, n, lat, lon, lat2, lon2, ring, ahead): each segment from crossing v to crossing n with ``ring``, the least crossing of the ring it lies on, and ``ahead``, the steps from its start to it.

    Rings within a tile are followed there; only stretches of those that cross tiles are joined by their ends. Nodes whose key is null have no ring. ``n_rows``, if known, is about how many nodes there are.
    """
    tiled, crossing = _tiled(field, keys, thresholds, n_rows, bits)
    return _traced(tiled, keys, thresholds, bits, "points").unionByName(crossing)


def field_rings(field: DataFrame, keys: list[str], thresholds: dict[int, float], n_rows: int | None = None, bits: int = BITS) -> DataFrame:
    """``rings`` of ``ring_points``, but what lies within a tile is measured there: no segment of it leaves the task."""
    tiled, crossing = _tiled(field, keys, thresholds, n_rows, bits)
    inner = _traced(tiled, keys, thresholds, bits, "rings").withColumn("hole", F.col("area") < 0)
    return inner.unionByName(rings(crossing, keys))


def rings(points: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, threshold, ring, n_points, area, hole, lon_min, lon_max, lat_min, lat_max) of each ring; area in square degrees.

    Rings through the nodes of a border have areas of zero but for the last bit, and its sign says whether they are holes, so segments are added up in the order of the ring, from its least crossing on: a running sum
    within a ring, whose rows can spill.
    """
    by = [*keys, "threshold", "ring"]
    cross = (F.col("lon") * F.col("lat2") - F.col("lon2") * F.col("lat")) / 2
    walk = W.partitionBy(*by).orderBy(F.col("ahead") != 0, F.desc("ahead")).rowsBetween(W.unboundedPreceding, W.currentRow)
    last = F.max_by("_sum", F.struct((F.col("ahead") != 0).alias("a"), (-F.col("ahead")).alias("b")))
    g = points.withColumn("_sum", F.sum(cross).over(walk)).groupBy(*by).agg(
        F.count("*").alias("n_points"), last.alias("area"), F.min("lon").alias("lon_min"), F.max("lon").alias("lon_max"), F.min("lat").alias("lat_min"), F.max("lat").alias("lat_max")
    )
    return g.withColumn("hole", F.col("area") < 0)


def ring_texts(points: DataFrame, keys: list[str], digits: int | None = None) -> DataFrame:
    """(keys, threshold, ring, region): each ring as POLYGON text, from its least crossing on. A ring's own points meet in a task, as its text must."""
    corner = F.concat(number_text(F.col("lon"), digits), F.lit(" "), number_text(F.col("lat"), digits))
    point = F.struct((F.col("ahead") != 0).alias("a"), (-F.col("ahead")).alias("b"), corner.alias("t"))  # the ring's start, then those with most steps to it
    g = points.groupBy(*keys, "threshold", "ring").agg(F.array_sort(F.collect_list(point)).alias("p"))
    text = F.array_join(F.transform(F.concat("p", F.slice("p", 1, 1)), lambda x: x["t"]), ", ")
    return g.select(*keys, "threshold", "ring", F.concat(F.lit("POLYGON (("), text, F.lit("))")).alias("region"))


def ring_envelopes(found: DataFrame, keys: list[str]) -> DataFrame:
    """One record for each key and threshold with a region: outer rings, holes, area in km2 without the holes, bounds."""
    km2 = F.sum("area") * (AREA_KM[0] * AREA_KM[1])
    return found.groupBy(*keys, "threshold").agg(
        F.count_if(~F.col("hole")).alias("n_outer"), F.count_if("hole").alias("n_holes"), km2.alias("area_km2"),
        F.min("lon_min").alias("lon_min"), F.max("lon_max").alias("lon_max"), F.min("lat_min").alias("lat_min"), F.max("lat_max").alias("lat_max"),
    )
