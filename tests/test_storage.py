"""What reads and writes touch: boxes by Morton ranges, packed blocks, keyed tables, the stream; and searches that work by rounds."""

import os
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from galeforge.functions import geo
from galeforge.operators import envelopes as E
from galeforge.operators import rain as P
from galeforge.operators import rivers as R
from galeforge.operators import warehouse as H
from galeforge.schemas import STEPS_H
from galeforge.sources import sinks as S
from galeforge.sources.keyed import BUCKET, KeyedTable
from galeforge.streaming.ingest import file_stream_ingest, ingested


def scanned(df):
    """The rows, and how many rows and files the scan below them read."""
    rows = df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    metric = lambda name: leaf.metrics().apply(name).value()
    return rows, metric("numOutputRows"), metric("numFiles")


class Progress(StreamingQueryListener):
    """Rows read, rows put into the state and rows in it, of each batch."""

    def __init__(self, seen):
        self.seen = seen

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        self.seen.append((p.numInputRows, sum(s.numRowsUpdated for s in p.stateOperators), sum(s.numRowsTotal for s in p.stateOperators)))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


# Morton ranges.
@pytest.mark.parametrize("most", [1, 4, 16, 64])
def test_ranges_hold_every_cell_of_a_box(most):
    r = random.Random(most)
    for _ in range(40):
        rows, cols = (tuple(sorted(r.randrange(32) for _ in range(2))) for _ in range(2))
        ranges = geo.morton_ranges(rows, cols, most, bits=5)
        own = {geo.morton_number(y, x, 5) for y in range(rows[0], rows[1] + 1) for x in range(cols[0], cols[1] + 1)}
        held = {z for a, b in ranges for z in range(a, b + 1)}
        assert own <= held and 1 <= len(ranges) <= most and all(a <= b for a, b in ranges)
        assert all(x[1] + 1 < y[0] for x, y in zip(ranges, ranges[1:], strict=False))
        if most == 64:
            assert held == own or len(held) < 2 * len(own) + 32
    assert geo.morton_ranges((3, 2), (0, 1)) == []


def test_number_equals_the_key(spark):
    lat, lon = 12.34, -56.78
    key = spark.range(1).select(geo.morton_key(F.lit(lat), F.lit(lon)).alias("k")).first().k
    assert key == geo.morton_number(int((lat + 90) // 0.05), int((lon + 180) // 0.05))


def test_a_box_reads_few_rows(spark, tmp_path):
    pixels = spark.range(60_000).select((F.lit(10)).alias("rp"), (F.col("id") * 7919 % 11000 / 100.0 - 55).alias("pixel_lat"), (F.col("id") * 104729 % 35000 / 100.0 - 175).alias("pixel_lon"), F.col("id").alias("m024"))
    extent = S.write_extent(pixels.coalesce(1), str(tmp_path / "x"), group_bytes=16 << 10)
    for box in ((-5.0, 5.0, 20.0, 40.0), (10.013, 10.5, -70.2, -69.0), (50.0, 90.0, 170.0, 180.0)):
        rows, read, _ = scanned(S.read_extent_box(extent, *box))
        want = pixels.where(F.col("pixel_lat").between(box[0], box[1]) & F.col("pixel_lon").between(box[2], box[3])).collect()
        assert sorted(rows) == sorted(want) and read < 60_000 * 0.2
    assert S.read_extent_box(extent, 5.0, -5.0, 0.0, 1.0).count() == 0


# Packed blocks.
def test_blocks_hold_the_cells_and_crops_read_few(spark, tmp_path):
    r = np.random.default_rng(1)
    cells = [(k, int(y), int(x), float(k * 1000 + y * 50 + x)) for k in (1, 2) for y, x in {tuple(v) for v in r.integers(0, 100, (3000, 2)).tolist()}]
    df = spark.createDataFrame(cells, "member int, row int, col int, value double")
    blocks = S.write_blocks(df, str(tmp_path / "b"), ["member"], size=(8, 16), group_bytes=8 << 10)
    rows, read, _ = scanned(S.read_block_crop(blocks, ["member"], (20, 33), (40, 70), (8, 16)))
    held = {(k, y, x): v for k, y, x, v in cells}
    assert {(q.member, q.row, q.col): q.value for q in rows} == {(k, y, x): held.get((k, y, x)) for k in (1, 2) for y in range(20, 34) for x in range(40, 71)}
    assert read < blocks.count()
    assert S.write_blocks(df.limit(0), str(tmp_path / "none"), ["member"]).count() == 0


# Keyed tables.
TABLE = "k long, region string, n int"


def keyed(spark, path, rows, buckets=64):
    return KeyedTable.create(spark.createDataFrame(rows, TABLE), str(path), ["k"], buckets)


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def test_a_small_source_rewrites_few_buckets(spark, tmp_path):
    rows = [(k, f"r{k}", 0) for k in range(5000)] + [(None, "loose", 0)] * 3
    t = keyed(spark, tmp_path / "t", rows)
    source = spark.createDataFrame([(7, "new", 1), (7, "newer", 1), (99_999, "added", 1), (12, None, 1), (None, "loose too", 1)], TABLE)
    before = files(t.path)
    want = H.upsert(t.read(), source, ["k"], ["region"], F.col("s_region").isNotNull(), [F.desc("region")]).collect()
    changed = t.upsert(source, ["region"], F.col("s_region").isNotNull(), [F.desc("region")])
    after = files(t.path)
    assert 1 <= len(changed) <= 3
    kept = {p for p in before if int(p.split("=")[1].split("/")[0]) not in changed}
    assert len(kept) >= 60 and all(after[p] == before[p] for p in kept)
    assert {int(p.split("=")[1].split("/")[0]) for p in set(after) - set(before)} <= {*changed, *range(64)} and len(set(after) - set(before)) <= len(changed) + 1
    _, read, n_files = scanned(t.part(changed).select("k", "region", "n"))
    assert n_files <= len(changed) + 1 and read < 5000 * 0.2
    assert sorted(t.read().collect(), key=str) == sorted(want, key=str)
    assert {r.k: r.region for r in t.read().where("k in (7, 12, 99999)").collect()} == {7: "newer", 12: "r12", 99_999: "added"}


def test_a_merge_that_runs_twice_changes_nothing_more(spark, tmp_path):
    t = keyed(spark, tmp_path / "t", [(k, f"r{k}", 0) for k in range(100)], 8)
    source = spark.createDataFrame([(3, "x", 1), (200, "y", 1)], TABLE)
    for _ in range(2):
        t.upsert(source, ["region"], F.lit(True), ["n"])
        t.insert_missing(source.union(source), ["n"])
    assert t.read().count() == 101 and t.read().where("k = 3").first().region == "x"


def test_missing_rows_are_appended_and_no_file_is_rewritten(spark, tmp_path):
    t = keyed(spark, tmp_path / "t", [(k, f"r{k}", 0) for k in range(1000)])
    before = files(t.path)
    t.insert_missing(spark.createDataFrame([(5, "other", 1), (5000, "a", 2), (5000, "b", 1)], TABLE), ["n"])
    after = files(t.path)
    assert all(after[p] == before[p] for p in before) and len(after) == len(before) + 1
    assert t.read().count() == 1001 and t.read().where("k = 5000").first().region == "b" and t.read().where("k = 5").first().region == "r5"
    assert t.touched(spark.createDataFrame([], TABLE)) == [] and t.part([]).count() == 0 and BUCKET not in t.read().columns


# The stream.
ROWS = "k int, v string"


def test_ingest_goes_on_after_a_failure_between_write_and_commit(spark, tmp_path):
    landing, target, state = (str(tmp_path / x) for x in ("landing", "table", "state"))
    call = lambda: file_stream_ingest(spark, landing, ROWS, target, state, ["k"])
    land = lambda rows: spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append").parquet(landing)
    land([(1, "a"), (2, "a")])
    assert sorted(map(tuple, call().collect())) == [(1, "a"), (2, "a")]
    land([(2, "b"), (3, "b")])
    want = [(1, "a"), (2, "a"), (3, "b")]
    assert sorted(map(tuple, call().collect())) == want
    for folder in (f"{state}/commits", f"{target}/_spark_metadata"):  # as if the second batch's files were there, but neither log had it
        for name in os.listdir(folder):
            if name.strip(".").removesuffix(".crc") == "1":
                os.remove(f"{folder}/{name}")
    assert sorted(map(tuple, ingested(spark, ROWS, target).collect())) == [(1, "a"), (2, "a")]
    assert sorted(map(tuple, call().collect())) == want
    land([(1, "c"), (4, "c"), (None, "c"), (None, "d")])
    got = call().collect()
    assert sorted(r.k for r in got if r.k is not None) == [1, 2, 3, 4] and sum(r.k is None for r in got) == 1
    assert call().count() == 5  # nothing new


def test_a_batch_costs_what_it_holds(spark, tmp_path):
    """The state takes up the new keys only, and only new files are read, however many keys and files came before."""
    landing, target, state = (str(tmp_path / x) for x in ("landing", "table", "state"))
    seen = []
    spark.streams.addListener(listener := Progress(seen))
    try:
        for n, size in enumerate((5000, 50, 50)):
            spark.range(n * 10_000, n * 10_000 + size).selectExpr("cast(id as int) as k", "'v' as v").coalesce(1).write.mode("append").parquet(landing)
            file_stream_ingest(spark, landing, ROWS, target, state, ["k"])
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    finally:
        spark.streams.removeListener(listener)
    assert [x for x in seen if x[0]] == [(5000, 5000, 5000), (50, 50, 5050), (50, 50, 5100)]


# Searches by rounds.
def test_nearest_cells_equal_brute_force(spark):
    r = random.Random(8)
    cells = [(k, round(r.uniform(10, 12), 2), round(r.uniform(20, 23), 2)) for k in range(150)] + [(500, -59.0, 179.0), (501, 10.5, 20.5), (499, 10.5, 20.5)]
    gauges = [(g, r.uniform(9, 13), r.uniform(19, 24)) for g in range(60)] + [(100, 10.5, 20.5), (101, -60.0, -179.9), (102, 89.0, 0.0), (103, None, 1.0), (100, 10.5, 20.5)]
    got = R.nearest_cells(spark.createDataFrame(gauges, "gauge_id int, lat double, lon double"), spark.createDataFrame(cells, "cell_id int, cell_lat double, cell_lon double")).collect()
    want = [(g, min(((y - a) ** 2 + (x - b) ** 2, c) for c, y, x in cells)[1]) for g, a, b in gauges if a is not None]
    assert sorted((q.gauge_id, q.cell_id) for q in got) == sorted(want)
    assert next(q.distance for q in got if q.gauge_id == 100) == 0 and next(q.cell_id for q in got if q.gauge_id == 100) == 499
    none = spark.createDataFrame([], "cell_id int, cell_lat double, cell_lon double")
    assert R.nearest_cells(spark.createDataFrame(gauges[:3], "gauge_id int, lat double, lon double"), none).count() == 0


@pytest.mark.parametrize("bins", [4, 1024])
def test_exact_percentile(spark, bins):
    r = np.random.default_rng(3)
    groups = {"a": r.normal(0, 1, 3000), "b": np.repeat([1.0, 2.0, 5.0], 40), "c": np.array([7.5]), "d": np.r_[1e-300, 1e300, -1e300, r.exponential(1e-9, 50)], None: np.array([1.0, 3.0])}
    rows = [(k, float(v)) for k, x in groups.items() for v in x] + [("a", None), ("a", float("nan")), ("b", float("inf")), ("e", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    for q in (0.0, 0.5, 0.99, 1.0):
        got = {x.g: x.percentile for x in P.exact_percentile(df, "x", q, ["g"], bins).collect()}
        assert got == pytest.approx({k: float(np.percentile(x, 100 * q)) for k, x in groups.items()}, rel=1e-12)
    assert P.exact_percentile(df.where("g = 'b'"), "x", 0.5, None, bins).first().percentile == 2.0
    assert P.exact_percentile(df.limit(0), "x", 0.5, ["g"], bins).count() == 0


def test_counts_from_masks_need_no_row_for_a_bit(spark):
    r = random.Random(5)
    names = [f"m{h:03d}" for h in STEPS_H]
    rows = [(10, 1.0, float(k), *[r.getrandbits(64) - (1 << 63) if k % 3 else 0 for _ in names]) for k in range(50)]
    extent = spark.createDataFrame(rows, "rp int, pixel_lat double, pixel_lon double, " + ", ".join(f"{m} long" for m in names))
    for steps in (None, [72]):
        out = R.member_extent_counts(extent, steps)
        want = R.expand_bitmask(extent, steps).groupBy("member").agg(F.count("*").alias("pixels")).collect()
        assert sorted(map(tuple, out.collect())) == sorted((x.member, x.pixels) for x in want)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Generate") == 1 and plan.index("Generate") < plan.index("Aggregate")  # only over the one row of sums


def test_regions_are_few_rectangles_of_the_same_cells(spark):
    r = random.Random(6)
    own = {(y, x) for y in range(20) for x in range(30) if r.random() < 0.2} | {(y, x) for y in range(3, 12) for x in range(5, 18)}
    cells = spark.createDataFrame([(1, y, x, 10 - 0.25 * y, 20 + 0.25 * x) for y, x in own], "k int, r int, c int, lat double, lon double")
    boxes = E.region_boxes(cells, ["k"]).collect()
    held = [(y, x) for b in boxes for y in range(b.r0, b.r1 + 1) for x in range(b.c0, b.c1 + 1)]
    assert sorted(held) == sorted(own) and len(boxes) < E.row_boxes(cells, ["k"]).count()
    e = E.individual_envelopes(cells, ["k"]).first()
    assert e.n_cells == len(own) and e.n_boxes == len(boxes) == e.region.count("POLYGON")
    texts = E.region_texts(E.region_boxes(cells, ["k"]), ["k"], 7).orderBy("part").collect()
    assert [t.part for t in texts] == list(range(-(-len(boxes) // 7))) and all(t.region.count("POLYGON") <= 7 for t in texts)
    assert ", ".join(t.region[20:-1] for t in texts) == e.region[20:-1]
