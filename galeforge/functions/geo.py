"""Column arithmetic on the sphere and on regular grids."""

from __future__ import annotations

from functools import reduce
from heapq import heappop, heappush
from math import floor

from pyspark.sql import Column
from pyspark.sql import functions as F

KM_PER_DEGREE, EARTH_KM, NUDGE = 111.0, 6371.0, 1e-7


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_KM * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def quadrant_box(lat: Column, lon: Column, ne: Column, se: Column, sw: Column, nw: Column) -> Column:
    """The box (lon_min, lat_min, lon_max, lat_max) that four radii in km reach; null if none is above 0. Null radii count as 0."""
    r = [F.coalesce(x, F.lit(0.0)) for x in (ne, se, sw, nw)]
    per_lon = F.when(lat == 90.0, F.lit(1 / KM_PER_DEGREE)).otherwise(1 / (KM_PER_DEGREE * F.cos(F.radians(lat))))
    box = F.struct(
        (lon - F.greatest(r[2], r[3]) * per_lon).alias("lon_min"), (lat - F.greatest(r[2], r[1]) / KM_PER_DEGREE).alias("lat_min"),
        (lon + F.greatest(r[0], r[1]) * per_lon).alias("lon_max"), (lat + F.greatest(r[0], r[3]) / KM_PER_DEGREE).alias("lat_max"),
    )
    return F.when((F.greatest(*r) > 0) & lat.isNotNull() & lon.isNotNull(), box)


def _part(box: Column, low: Column, high: Column) -> Column:
    return F.struct(low.alias("lon_min"), box["lat_min"].alias("lat_min"), high.alias("lon_max"), box["lat_max"].alias("lat_max"))


def antimeridian_split(box: Column) -> Column:
    """One box, or two where it crosses +-180; null where it crosses both or is null. The part on the box's own side is first."""
    low, high = box["lon_min"], box["lon_max"]
    east, west = F.lit(180.0), F.lit(-180.0)
    return (
        F.when(box.isNull() | ((high > 180) & (low < -180)), None)
        .when(high > 180, F.array(_part(box, low, east), _part(box, west, high - 360)))
        .when(low < -180, F.array(_part(box, west, high), _part(box, low + 360, east)))
        .otherwise(F.array(_part(box, low, high)))
    )


def nudge_antimeridian(x: Column) -> Column:
    """Longitudes at or beyond +-180 moved just inside."""
    return F.when(x <= -180, F.lit(-180 + NUDGE)).when(x >= 180, F.lit(180 - NUDGE)).otherwise(x)


def _rounded(x: Column, digits: int | None) -> Column:
    """Rounded where digits is given; what rounds to zero keeps its sign, as in C and SQL."""
    return x if digits is None else F.when((x < 0) & (F.round(x, digits) == 0), F.lit(-0.0)).otherwise(F.round(x, digits))


def _plain(y: Column, signed_zero: bool = True) -> Column:
    """A double's text. Between 1e-3 and 1e7 Spark's own has a point and no exponent, and only whole numbers end in zeros; the others go through patterns, which cost several times as much."""
    text = F.when(F.abs(y) < 1e-3, F.regexp_replace(F.format_string("%.12f", y), "0+$", "")).otherwise(y.cast("string"))
    text = F.regexp_replace(text, r"\.0*$", "")
    text = text if signed_zero else F.regexp_replace(text, "^-0$", "0")
    short = F.when(y == F.rint(y), y.cast("long").cast("string")).otherwise(y.cast("string"))
    return F.when((F.abs(y) >= 1e-3) & (F.abs(y) < 1e7), short).otherwise(text)


def number_text(x: Column, digits: int | None = None) -> Column:
    """A double as plain text without exponent or trailing zero; rounded where digits is given, with -0 for negatives that round to zero."""
    return _plain(_rounded(x, digits), digits is not None)


def boxes_to_wkt(boxes: Column, digits: int | None = None) -> Column:
    """POLYGON of one box, MULTIPOLYGON of more, each ring SW-SE-NE-NW-SW with nudged longitudes; null stays null.

    Numbers are moved, rounded, signed and written, each step once for its number, as a transform of its own; a ring's corners only repeat the texts.
    """
    sides = lambda b: F.array(nudge_antimeridian(b["lon_min"]), b["lat_min"], nudge_antimeridian(b["lon_max"]), b["lat_max"])

    def written(x):
        if digits is None:
            return F.transform(x, lambda v: number_text(v))
        both = F.transform(x, lambda v: F.struct(v.alias("x"), F.round(v, digits).alias("y")))
        signed = F.transform(both, lambda p: F.when((p["x"] < 0) & (p["y"] == 0), F.lit(-0.0)).otherwise(p["y"]))
        return F.transform(signed, lambda y: _plain(y))

    texts = F.transform(boxes, lambda b: written(sides(b)))

    def ring(b):
        w, s, e, n = (b[k] for k in range(4))
        corner = lambda x, y: F.concat(x, F.lit(" "), y)
        return F.concat(F.lit("(("), F.concat_ws(", ", corner(w, s), corner(e, s), corner(e, n), corner(w, n), corner(w, s)), F.lit("))"))

    one = F.size(boxes) == 1
    rings = F.array_join(F.transform(texts, ring), ", ")
    return F.when(boxes.isNotNull(), F.concat(F.when(one, "POLYGON ").otherwise("MULTIPOLYGON ("), rings, F.when(one, "").otherwise(")")))


def grid_index(x: Column, first: float, step: float, n: int) -> Column:
    """The nearest index on a regular axis, halves to even, clipped to its ends."""
    return F.greatest(F.least(F.rint((x - first) / step), F.lit(float(n - 1))), F.lit(0.0)).cast("int")


def interleave(x: Column) -> Column:
    """The low 16 bits spread so that a zero stands between each two."""
    x = x.cast("long").bitwiseAND(F.lit(0xFFFF).cast("long"))
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return x


def morton_key(lat: Column, lon: Column, cell: float = 0.05) -> Column:
    """Z-order key of a position on a grid of cells, latitude's bit above longitude's."""
    return F.shiftleft(interleave(F.floor((lat + 90.0) / cell)), 1).bitwiseOR(interleave(F.floor((lon + 180.0) / cell)))


def morton_number(row: int, col: int, bits: int = 16) -> int:
    """The Z-order key of one cell, the row's bit above the column's."""
    return sum((row >> k & 1) << (2 * k + 1) | (col >> k & 1) << (2 * k) for k in range(bits))


def morton_ranges(rows: tuple[int, int], cols: tuple[int, int], most: int = 16, bits: int = 16) -> list[tuple[int, int]]:
    """At most ``most`` intervals of Z-order keys that hold every cell of a box (ends inclusive), and few others.

    The grid is quartered where the box cuts it, the largest squares first; what is cut to the end or left over counts whole. Then the intervals with the smallest gaps become one.
    """
    if rows[0] > rows[1] or cols[0] > cols[1]:
        return []
    inside, cut = [], [(-(1 << bits), 0, 0)]  # squares: size (negative, so that the largest comes first), row, column
    while cut and len(inside) + len(cut) < 4 * most:
        size, r, c = heappop(cut)
        half = -size // 2
        for y, x in ((r, c), (r, c + half), (r + half, c), (r + half, c + half)):
            if y > rows[1] or y + half - 1 < rows[0] or x > cols[1] or x + half - 1 < cols[0]:
                continue
            whole = rows[0] <= y and y + half - 1 <= rows[1] and cols[0] <= x and x + half - 1 <= cols[1]
            inside.append((-half, y, x)) if whole or half == 1 else heappush(cut, (-half, y, x))
    spans = sorted((z, z + size * size - 1) for size, r, c in inside + cut for z in [morton_number(r, c, bits)])
    out: list[list[int]] = []
    for a, b in spans:
        if out and a == out[-1][1] + 1:
            out[-1][1] = b
        else:
            out.append([a, b])
    gaps = sorted(range(1, len(out)), key=lambda k: out[k][0] - out[k - 1][1])[: max(0, len(out) - most)]
    for k in sorted(gaps, reverse=True):
        out[k - 1][1] = out.pop(k)[1]
    return [tuple(x) for x in out]


def box_ranges(lat_min: float, lat_max: float, lon_min: float, lon_max: float, cell: float = 0.05, most: int = 16) -> list[tuple[int, int]]:
    """The intervals of ``morton_key`` for a box of latitudes and longitudes, ends inclusive; a cell's rounding is allowed for by one cell more on each side."""
    at = lambda x, half: min(max(floor((x + half) / cell), 0), floor(2 * half / cell))
    if lat_min > lat_max or lon_min > lon_max:
        return []
    return morton_ranges((max(at(lat_min, 90.0) - 1, 0), at(lat_max, 90.0) + 1), (max(at(lon_min, 180.0) - 1, 0), at(lon_max, 180.0) + 1), most)


def in_ranges(key: Column, ranges: list[tuple[int, int]]) -> Column:
    """True where a key lies in one of a few intervals; a form that scans can push down."""
    return reduce(lambda x, y: x | y, [(key >= a) & (key <= b) for a, b in ranges], F.lit(False))
