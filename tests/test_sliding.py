"""Sliding means and alerts against plain loops, and the shape of their plans."""

import random
import re

import pytest

from framelake.operators import order as O
from framelake.plans import catalog
from tests.helpers import SMALL

SCHEMA = "arrival long, key string, ts long, n long"


def some_events(seed, n):
    r = random.Random(seed)
    return [(k, r.choice(["a", "a", "b", None]), r.choice([None, *range(40)]), r.choice([None, 0, 3, 9])) for k in range(n)]


def plain_means(rows, window):
    out = {}
    for arrival, key, ts, _ in rows:
        mine = [n for _, k, t, n in rows if k == key and n is not None and ((ts is None and t is None) or (ts is not None and t is not None and ts - window <= t <= ts))]
        out[arrival] = (sum(mine) / len(mine) if mine else None, len(mine))
    return out


def test_means_of_ties_nulls_and_both_ends_equal_a_loop(spark):
    for seed in range(3):
        rows = some_events(seed, 90)
        out = O.sliding_mean(spark.createDataFrame(rows, SCHEMA), "key", "ts", "n", 5).collect()
        assert {r.arrival: (r.mean, r.n_frames) for r in out} == plain_means(rows, 5)


def test_alerts_of_one_key_equal_a_loop(spark):
    r = random.Random(5)
    rows = [(k, "a", 10 * k + r.randrange(30), r.choice([0, 4, 9])) for k in range(200)]
    means = plain_means(rows, 60)
    want, before, newest, clock = [], False, None, None
    for arrival, _, ts, _ in rows:
        crossed = means[arrival][0] > 4
        if crossed and not (before and newest is not None and ts - 20 <= newest):  # here the row's own time is the clock
            want.append(arrival)
        before, newest = crossed, ts if newest is None else max(newest, ts)
    read = O.sliding_mean(spark.createDataFrame(rows, SCHEMA), "key", "ts", "n", 60).withColumnRenamed("ts", "ts_ms").selectExpr("*", "ts_ms as clock")
    got = O.fire_once(read, "key", "arrival", 4, "ts_ms", "clock", 20).where("alert").collect()
    assert 5 < len(want) < 150 and sorted(r.arrival for r in got) == want


def test_fractions_are_refused(spark):
    with pytest.raises(ValueError):
        O.sliding_mean(spark.createDataFrame([("a", 1, 0.5)], "key string, ts long, n double"), "key", "ts", "n", 5)


@pytest.mark.parametrize("name", ["E3_sliding_mean", "E4_fire_once", "E4_fire_once_shared_clock", "I12_verdict_rates"])
def test_no_window_slides_over_the_rows_of_a_sequence(spark, name):
    plan = catalog.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "RangeFrame" not in plan and not re.search(r"windowspecdefinition\(sequence#\d+, (ts_ms|arrival)", plan)
