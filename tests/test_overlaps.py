"""Counts of overlaps and the highest IoU against all pairs."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from framelake.operators import grid, overlaps
from framelake.plans import catalog
from tests.helpers import SMALL
from tests.test_grid import crowd


def some(seed, n, width, whole):
    r = np.random.default_rng(seed)
    low, side = r.random((2, n)) * width, 0.01 + r.random((2, n)) * 40
    b = np.concatenate([low, low + side])
    return np.concatenate([np.floor(b[:2]), np.floor(b[2:]) + 1]) if whole else b


@pytest.mark.parametrize("whole", [True, False])
def test_counts_and_highest_iou_equal_all_pairs(monkeypatch, whole):
    monkeypatch.setattr(overlaps, "FEW", 1000)
    for seed, width in enumerate((20, 250, 3000)):
        d, g = some(seed, 700, width, whole), some(seed + 9, 800, width, whole)
        w = np.random.default_rng(seed).integers(1, 4, 800)
        met = (d[0][:, None] < g[2]) & (g[0] < d[2][:, None]) & (d[1][:, None] < g[3]) & (g[1] < d[3][:, None])
        assert overlaps.counted(d, g, w).tolist() == (met * w).sum(1).tolist()
        assert overlaps.highest(d, g).tolist() == np.where(met, overlaps._iou(d[:, :, None], g[:, None, :]), 0).max(1).tolist()


@pytest.mark.parametrize("most", [250_000, 40])
def test_all_levels_keys_and_copies_equal_the_pairs(spark, monkeypatch, most):
    monkeypatch.setattr(grid, "MOST", most)
    det = crowd(500, 1, 2, 600.0, big=0.1)
    gt = crowd(400, 2, 2, 600.0, big=0.1).drop(columns="conf")
    odd = pd.DataFrame({"frame": [0, 0, -1, 1], "cls": [0, 0, 0, 1], "x1": [-300.0, np.nan, 0.0, -9000.0], "y1": [-300.0, 0.0, 0.0, -9000.0], "x2": [700.0, 5.0, 90.0, 9000.0], "y2": [700.0, 5.0, 90.0, 9000.0]})
    det, gt = (spark.createDataFrame(pd.concat(both)).withColumn("frame", F.expr("nullif(frame, -1)")) for both in ([det, odd.assign(conf=0.5)], [gt, odd]))
    keys, columns = ["frame", "cls"], ["frame", "cls", "x1", "y1", "x2", "y2", "conf"]
    pairs = grid.candidates(det, gt, keys).withColumnsRenamed({f"d_{c}": c for c in columns})
    want = pairs.groupBy(*columns).agg({"*": "count", "iou": "max"}).selectExpr(*columns, "`count(1)` as n", "`max(iou)` as best")
    got = sorted(map(tuple, grid.overlap_counts(det, gt, keys).collect()))
    assert len(got) > 300 and got == sorted(map(tuple, want.collect()))
    assert grid.overlap_counts(det.limit(0), gt, keys).count() == grid.overlap_counts(det, gt.limit(0), keys).count() == 0


def test_crowded_candidates_lay_out_no_pairs(spark):
    plan = catalog.QUERIES["C4_crowded_candidates"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" not in plan
