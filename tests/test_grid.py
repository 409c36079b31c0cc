"""Crowded frames against plain loops and against the folds over arrays."""

import numpy as np
import pandas as pd

from framelake.operators import boxes, grid, matching

BOX = ["cls", "x1", "y1", "x2", "y2", "conf"]


def crowd(n, seed, frames=1, width=1000.0, big=0.02):
    r = np.random.default_rng(seed)
    side = np.where(r.random((n, 2)) < big, r.random((n, 2)) * width, 4 + r.random((n, 2)) * 30)
    low = r.random((n, 2)) * width
    rows = pd.DataFrame({"frame": r.integers(0, frames, n), "cls": r.integers(0, 2, n), "x1": low[:, 0], "y1": low[:, 1], "x2": (low + side)[:, 0], "y2": (low + side)[:, 1], "conf": np.round(r.random(n), 2)})
    return pd.concat([rows, rows.iloc[: n // 10], rows.iloc[: n // 10].assign(x2=lambda d: d.x1)], ignore_index=True)


def listed(df, columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_pairs_equal_all_pairs(spark):
    a, b = crowd(600, 1, 2, 300.0), crowd(500, 2, 2, 300.0)
    det, gt = spark.createDataFrame(a), spark.createDataFrame(b.drop(columns="conf"))
    columns = ["frame", "cls", "d_x1", "d_y1", "d_x2", "g_x1", "g_y1", "iou"]
    got = listed(grid.candidates(det, gt, ["frame", "cls"]), columns)
    assert len(got) > 500 and got == listed(boxes.candidates(det, gt, ["frame", "cls"]), columns)


def test_negative_large_and_odd_corners(spark):
    far = [(0, -70.0, -70.0, -10.0, -10.0), (1, -20.0, -20.0, 9e5, 50.0), (2, float("nan"), 0.0, 5.0, 5.0), (3, 0.0, 0.0, float("inf"), 5.0), (4, None, 0.0, 3.0, 3.0), (5, 16.0, 16.0, 32.0, 32.0), (6, 32.0, 16.0, 48.0, 32.0)]
    d = spark.createDataFrame(far, "i int, x1 double, y1 double, x2 double, y2 double").selectExpr("0 as k", "*")
    got = {tuple(sorted((r.a_i, r.b_i))) for r in grid.overlapping(d, d, ["k"]).where("a_i <> b_i").collect()}
    assert got == {(0, 1), (1, 5), (1, 6)}  # boxes that only touch share no area
    assert grid.overlapping(d.limit(0), d, ["k"]).count() == 0


def test_suppression_and_nesting_equal_the_folds(spark):
    rows = spark.createDataFrame(crowd(900, 3, 3, 300.0))
    columns = ["frame", *BOX]
    assert listed(grid.suppress(rows, ["frame"], 0.3), columns) == listed(matching.suppress(rows, ["frame"], 0.3), columns)
    for outer in (True, False):
        assert listed(grid.drop_nested(rows, ["frame"], 0.6, outer), columns) == listed(matching.drop_nested(rows, ["frame"], 0.6, outer), columns)
    assert grid.suppress(rows.limit(0), ["frame"], 0.3).count() == 0


def test_a_chain_is_decided_link_by_link(spark):
    chain = spark.createDataFrame([(0, 10.0 * i, 0.0, 10.0 * i + 20, 10.0, 1 - i / 100) for i in range(9)], "frame int, x1 double, y1 double, x2 double, y2 double, conf double")
    assert [r.x1 for r in grid.suppress(chain, ["frame"], 0.3).orderBy("x1").collect()] == [0, 20, 40, 60, 80]


def test_matching_equals_the_fold(spark):
    det, gt = crowd(500, 5, 2, 300.0), crowd(500, 6, 2, 300.0)
    near = det.sample(300, random_state=1)[["frame", "cls", "x1", "y1", "x2", "y2"]] + [0, 0, 1, 1, 2, 2]
    gt = spark.createDataFrame(pd.concat([gt.drop(columns="conf"), near]))
    det = spark.createDataFrame(det)
    for threshold in (0.1, 0.5):
        got = grid.match(det, gt, ["frame", "cls"], threshold)
        columns = ["frame", *BOX, "iou", "hit"]
        assert listed(got, columns) == listed(matching.match(det, gt, ["frame", "cls"], (threshold,)), columns)
    assert {r.hit for r in grid.match(det, gt.limit(0), ["frame", "cls"]).collect()} == {False}


def test_twenty_thousand_boxes_in_one_frame(spark):
    rows = crowd(20_000, 7, width=4000.0, big=0)
    kept = np.zeros(len(rows), bool)
    order = rows.assign(o=-rows.conf).sort_values(["o", *BOX], kind="stable").index.to_numpy()
    x1, y1, x2, y2 = (rows[c].to_numpy() for c in BOX[1:5])
    area = (x2 - x1) * (y2 - y1)
    held = []
    for i in order:
        k = np.array(held, int)
        both = np.maximum(0, np.minimum(x2[k], x2[i]) - np.maximum(x1[k], x1[i])) * np.maximum(0, np.minimum(y2[k], y2[i]) - np.maximum(y1[k], y1[i]))
        union = area[k] + area[i] - both
        if not (both > 0.3 * union).any():
            held.append(i)
            kept[i] = True
    got = listed(grid.suppress(spark.createDataFrame(rows), ["frame"], 0.3), BOX)
    assert got == sorted(map(tuple, rows[kept][BOX].itertuples(index=False, name=None)))
