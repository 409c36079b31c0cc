"""Frames of few boxes meet without a grid, beside crowded ones that need it."""

import pandas as pd
import pytest

from framelake.operators import boxes, grid, matching
from tests.test_grid import BOX, crowd, listed


def mixed(seed):
    """A frame of hundreds of boxes among frames of a few."""
    return pd.concat([crowd(300, seed, 1, 200.0).assign(frame=-1), crowd(150, seed + 1, 12, 60.0)], ignore_index=True)


def test_boxes_of_frames_of_few_are_not_dealt_to_cells(spark):
    rows = spark.createDataFrame(crowd(300, 1, 30, 100.0))
    pairs = grid.overlapping(rows, rows, ["frame"])
    assert "Generate" not in pairs._jdf.queryExecution().optimizedPlan().toString()
    assert pairs.count() > 300


@pytest.mark.parametrize("few", [0, 20, 10**6])
def test_pairs_are_the_same_with_and_without_a_grid(spark, monkeypatch, few):
    monkeypatch.setattr(grid, "FEW", few)
    det, gt = spark.createDataFrame(mixed(1)), spark.createDataFrame(mixed(3).drop(columns="conf"))
    columns = ["frame", "cls", "d_x1", "d_y1", "d_x2", "g_x1", "g_y1", "iou"]
    got = listed(grid.candidates(det, gt, ["frame", "cls"]), columns)
    assert len(got) > 300 and got == listed(boxes.candidates(det, gt, ["frame", "cls"]), columns)


@pytest.mark.parametrize("few", [0, 1, 2])
def test_a_frame_crowded_on_one_side_only(spark, monkeypatch, few):
    monkeypatch.setattr(grid, "FEW", few)
    box = "k int, i int, x1 long, y1 long, x2 long, y2 long"
    one = spark.createDataFrame([(1, i, 10 * i, 0, 10 * i + 15, 10) for i in range(3)] + [(2, 9, 0, 0, 5, 5), (None, 7, 0, 0, 5, 5)], box)
    two = spark.createDataFrame([(1, 5, 12, 0, 14, 90), (2, 6, 0, 0, 90, 9), (2, 8, 4, 4, 9, 9), (2, 10, 5, 5, 9, 9), (None, 7, 0, 0, 5, 5)], box)
    assert {(r.a_i, r.b_i) for r in grid.overlapping(one, two, ["k"]).collect()} == {(0, 5), (1, 5), (9, 6), (9, 8)}


@pytest.mark.parametrize("few", [0, 10])
def test_odd_corners_with_and_without_a_grid(spark, monkeypatch, few):
    monkeypatch.setattr(grid, "FEW", few)
    far = [(0, -70.0, -70.0, -10.0, -10.0), (1, -20.0, -20.0, 9e5, 50.0), (2, float("nan"), 0.0, 5.0, 5.0), (3, 0.0, 0.0, float("inf"), 5.0), (4, None, 0.0, 3.0, 3.0), (5, 16.0, 16.0, 32.0, 32.0), (6, 32.0, 16.0, 48.0, 32.0)]
    d = spark.createDataFrame(far, "i int, x1 double, y1 double, x2 double, y2 double").selectExpr("0 as k", "*")
    assert {tuple(sorted((r.a_i, r.b_i))) for r in grid.overlapping(d, d, ["k"]).where("a_i <> b_i").collect()} == {(0, 1), (1, 5), (1, 6)}


def test_greedy_rules_equal_the_folds_over_mixed_frames(spark, monkeypatch):
    monkeypatch.setattr(grid, "FEW", 20)
    rows = spark.createDataFrame(mixed(5))
    columns = ["frame", *BOX]
    assert listed(grid.suppress(rows, ["frame"], 0.3), columns) == listed(matching.suppress(rows, ["frame"], 0.3), columns)
    assert listed(grid.drop_nested(rows, ["frame"], 0.6), columns) == listed(matching.drop_nested(rows, ["frame"], 0.6), columns)
    got = grid.match(rows, spark.createDataFrame(mixed(6).drop(columns="conf")), ["frame", "cls"], 0.3)
    want = matching.match(rows, spark.createDataFrame(mixed(6).drop(columns="conf")), ["frame", "cls"], (0.3,))
    assert listed(got, [*columns, "iou", "hit"]) == listed(want, [*columns, "iou", "hit"])
