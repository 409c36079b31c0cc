"""Suppression of classes in a frame's one array."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from framelake.operators import matching as M
from framelake.operators.order import top_k
from framelake.plans import catalog
from tests.helpers import SMALL
from tests.test_grid import crowd, listed


def test_decoded_boxes_are_sorted_by_one_window(spark):
    plan = catalog.QUERIES["B28_decode_best"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"\bWindow \[", plan)) == 1


@pytest.mark.parametrize("top", [5, 1000])
def test_classes_of_a_frame_are_suppressed_in_its_array(spark, top):
    rows = crowd(400, 8, 3, 120.0)
    rows = spark.createDataFrame(rows.assign(anchor=np.arange(len(rows))))
    columns = ["frame", "cls", "anchor", "conf", "x1", "y2"]
    want = top_k(M.suppress(rows, ["frame", "cls"], 0.3), ["frame"], [F.col("conf").desc(), "anchor"], top)
    got = listed(M.suppress_classes(rows, ["frame"], 0.3, top), columns)
    assert got == listed(want, columns) and (len(got) == 15 or top > 5)
