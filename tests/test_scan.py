"""Scans over ranges against plain loops; the alert rule on late, repeated and unordered rows against all arrivals looked at anew."""

import random

import pytest

from framelake.operators import order as O
from tests.test_streams import events, plain_alerts

ROWS = "arrival long, shard string, sequence string, frame_index long, ts_ms long, n long"


@pytest.mark.parametrize(("keys", "parts"), [(["k"], 4), (["k"], 23), ([], 7), (["k", "j"], 5)])
def test_scans_equal_plain_loops(spark, keys, parts):
    rng = random.Random(str(keys) + str(parts))
    rows = [(rng.choice(["hot"] * 9 + ["a", None]), rng.randrange(2), i, rng.choice([None, rng.randrange(100)]), rng.choice([True, True, False, None])) for i in range(400)]
    held = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        shuffled = rng.sample(rows, len(rows))
        df = spark.createDataFrame(shuffled, "k string, j int, i int, v int, c boolean")
        out = O.segmented_scan(df, keys, ["i"], total=("sum", "v"), top=("max", "v"), last=("last", "v"), before=("before", "v"), lag=("lag", "v"), run=("run", "c"))
        got = {r.i: tuple(r)[5:] for r in out.collect()}
        assert out.columns == ["k", "j", "i", "v", "c", "total", "top", "last", "before", "lag", "run"]
        assert O.segmented_scan(df.limit(0), keys, ["i"], run=("run", "c")).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)
    state, want = {}, {}
    for k, j, i, v, c in rows:
        s = state.setdefault(tuple({"k": k, "j": j}[x] for x in keys), {"sum": None, "top": None, "last": None, "lag": None, "run": 0})
        before, lag = s["last"], s["lag"]
        if v is not None:
            s.update(sum=(s["sum"] or 0) + v, top=v if s["top"] is None else max(s["top"], v), last=v)
        s.update(lag=v, run=s["run"] + 1 if c else 0)
        want[i] = s["sum"], s["top"], s["last"], before, lag, s["run"]
    assert got == want


@pytest.mark.parametrize("seed", range(4))
def test_alerts_equal_the_loop_over_all_arrivals(spark, seed):
    rows = events(seed, 150)
    rng = random.Random(seed)
    rows += [(200 + k, "one", f"s{rng.randrange(4)}", rng.randrange(60), 2500 + 40 * k - rng.choice([0, 0, 90, 101, 500]), rng.randrange(10)) for k in range(60)]
    out = O.alerts(spark.createDataFrame(rng.sample(rows, len(rows)) + [(999, "one", None, 1, 1, 1), (998, "one", "s1", 1, None, 1)], ROWS), 100, 4.5)
    at = {r[0]: r[4] for r in rows}
    assert sorted((r.sequence, r.frame_index, at[r.arrival], r.mean, r.n_frames) for r in out.collect()) == sorted(plain_alerts(rows, 100, 4.5))


def test_alerts_of_no_events(spark):
    assert O.alerts(spark.createDataFrame([], ROWS), 100, 4.5).count() == 0


def test_sessions_and_gaps(spark):
    rows = [(1, "a", 1), (2, "a", 4), (3, "b", 9), (4, "a", 5), (5, None, 1), (6, None, 2), (7, "b", 8)]
    df = spark.createDataFrame(rows, "arrival long, sequence string, frame_index long")
    assert [(r.arrival, r.session) for r in O.sessions(df, "arrival", "sequence").orderBy("arrival").collect()] == [(1, 1), (2, 1), (3, 2), (4, 3), (5, 4), (6, 4), (7, 5)]
    assert [r.gap for r in O.index_gaps(df, "sequence", "arrival", "frame_index").orderBy("arrival").collect()] == [0, 2, 0, 0, 0, 0, 0]
