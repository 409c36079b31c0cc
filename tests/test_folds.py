"""The folds over a frame's boxes do no arithmetic on pairs that lie apart."""

import pytest

from framelake.operators import matching as M
from framelake.plans import catalog
from tests.helpers import SMALL

FAR = 9 * 10**18  # distances between such boxes don't fit a whole number
NEAR = "f int, cls int, x1 long, y1 long, x2 long, y2 long, conf double, cut boolean"


def two_far_boxes(spark):
    return spark.createDataFrame([(0, 1, -FAR, 0, 5 - FAR, 5, 0.5, True), (0, 1, FAR, 0, FAR + 5, 5, 0.5, True), (0, 1, 0, FAR, 5, FAR + 5, 0.5, True)], NEAR)


@pytest.mark.parametrize("fold", [lambda r: M.suppress(r, ["f"], 0.5), lambda r: M.drop_nested(r, ["f"], 0.8)])
def test_suppression_and_nesting_spare_boxes_apart(spark, fold):
    assert fold(two_far_boxes(spark)).count() == 3


def test_merging_spares_boxes_apart_and_boxes_not_cut(spark):
    assert M.merge_contained(two_far_boxes(spark), ["f"]).count() == 3
    same = [(0, 1, 0, 0, 5, 5, 0.5, False), (0, 1, 0, 0, 5, 5, 0.7, False), (0, 1, 0, 0, 4, 5, 0.9, True), (0, 2, 0, 0, 4, 5, 0.9, True)]
    got = M.merge_contained(spark.createDataFrame(same, NEAR), ["f"]).select("cls", "x2", "conf").collect()
    assert sorted(map(tuple, got)) == [(1, 5, 0.7), (1, 5, 0.9), (2, 4, 0.9)]


def test_matching_spares_boxes_apart(spark):
    rows = two_far_boxes(spark).drop("cut")
    true = rows.select("f", "cls", "x1", "y1", "x2", "y2")
    assert [r.iou for r in M.match(rows.where(f"x1 = {FAR}"), true.where(f"x1 <> {FAR}"), ["f", "cls"]).collect()] == [0.0]


def test_decoded_boxes_take_the_same_step(spark):
    plan = catalog.QUERIES["B28_decode_best"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "x2 <= " in plan
