"""What queries must not do twice or for every row, read from their plans, and texts of numbers."""

from __future__ import annotations

import pytest

from galeforge import plans
from galeforge.functions.geo import number_text
from galeforge.operators import rivers

FOLDER = "/root/testdata/sf0.001"


def plan(spark, name: str) -> list[str]:
    """The optimized plan's operators, from the result down."""
    return plans.queries()[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString().split("\n")


def holding(lines: list[str], what: str) -> list[int]:
    return [k for k, line in enumerate(lines) if what in line]


@pytest.mark.parametrize("kt", ["", "_50", "_64"])
def test_polygons_are_written_once(spark, kt):
    assert len(holding(plan(spark, f"t15_boxes_to_wkt{kt}"), "array_join")) == 1


def test_number_texts(spark):
    def texts(numbers, digits=None):
        rows = spark.createDataFrame([(x,) for x in numbers], "x double")
        return [r.t for r in rows.select(number_text(rows.x, digits).alias("t")).collect()]

    want = [(0.0, "0"), (-0.0, "0"), (12.0, "12"), (-7.0, "-7"), (100.5, "100.5"), (-0.125, "-0.125"), (1e-3, "0.001"), (5e-4, "0.0005"), (-1e-13, "0"), (1234567.0, "1234567"), (9999999.25, "9999999.25"), (1e7, "1.0E7")]
    assert texts([x for x, _ in want]) == [t for _, t in want]
    assert texts([-7.0, 100.5, -1e-9, 1e-9, 12.3456789], 6) == ["-7", "100.5", "-0", "0", "12.345679"]


@pytest.mark.parametrize("name", ["t12_quadrant_box", "t13_antimeridian_split", "t14_nudge_antimeridian"])
def test_raw_rows_are_read_once(spark, name):
    assert len(holding(plan(spark, name), "Relation [")) == 1


def test_forecast_times_are_written_after_the_aggregate(spark):
    lines = plan(spark, "t2_forecast_time")
    assert holding(lines, "date_format") == [0]


def test_message_times_are_written_before_the_twelve_rows(spark):
    lines = plan(spark, "m1_flatten_messages")
    assert holding(lines, "date_format")[0] > holding(lines, "Generate explode")[0]
    assert not holding(lines[: holding(lines, "Generate posexplode")[0]], "lambdafunction")


def test_region_texts_are_put_in_order_without_a_lambda(spark):
    assert "lambdafunction" not in plan(spark, "e14_region_texts")[0]


def test_cells_of_one_place_meet_a_gauge_once(spark, monkeypatch):
    kept = {}
    monkeypatch.setattr(rivers, "written", lambda df, label: kept.setdefault(label, df.localCheckpoint()) if label == "cells" else df.localCheckpoint())
    cells = spark.range(5, 105).selectExpr("id as cell_id", "10.0D as cell_lat", "20.0D as cell_lon")
    (got,) = rivers.nearest_cells(spark.createDataFrame([(1, 10.0, 20.5)], "gauge_id int, lat double, lon double"), cells).collect()
    assert (got.cell_id, got.distance) == (5, 0.5) and kept["cells"].count() == 1


def test_headers_are_found_without_sorting_lines(spark):
    got = plans.queries()["s1_many_headers"](spark, FOLDER)
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()
    assert holding(got._jdf.queryExecution().optimizedPlan().toString().split("\n"), "RepartitionByExpression")
