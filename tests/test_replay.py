"""Streams of large micro-batches: state packed by slices, and how much of a table a micro-batch holds."""

import pytest

from framelake.plans import catalog
from framelake.streaming import pairing, replay
from framelake.streaming.stateful import WindowAlertProcessor, alert_stream
from tests.helpers import SMALL, same
from tests.test_streams import ROWS, Store, events, kept, plain_alerts

NAMES = ["shard", "arrival", "sequence", "frame_index", "ts_ms", "observed", "n_frames"]


def through(rows, size, window=100, clocks=None):
    import pandas as pd

    store, out = Store(), []
    for k in range(0, len(rows), size):
        processor = WindowAlertProcessor(window, 4.5, NAMES)
        processor.init(store)
        part = pd.DataFrame(rows[k : k + size], columns=["arrival", "shard", "sequence", "frame_index", "ts_ms", "n"])
        if clocks:
            part["clock"] = clocks[k : k + size]
        for frame in processor.handleInputRows(("one",), iter([part.sample(frac=1, random_state=k)]), None):
            out += [tuple(r) for r in frame.itertuples(index=False)]
    return out, store


def test_packed_state_equals_the_loop_over_batches():
    for seed in range(30):
        rows = events(seed, 120)
        for size in (1, 17, 120):
            got, store = through(rows, size)
            assert [r[2:] for r in got] == plain_alerts(rows, 100, 4.5)
            assert min(k[0] for k in store.maps["slices"]) >= (max(r[4] for r in rows) - 100) // 3  # nothing behind the horizon stays


def test_packed_shards_with_a_shared_clock_equal_the_loop():
    for seed in range(20):
        rows, clock, clocks = events(seed, 120), 0, []
        for r in rows:
            clocks.append(clock)
            clock = max(clock, r[4])
        got = []
        for s in ("s0", "s1", "s2"):
            mine = [(r, c) for r, c in zip(rows, clocks, strict=True) if r[2] == s]
            got += [r[2:] for r in through([r for r, _ in mine], 9, clocks=[c for _, c in mine])[0]]
        assert sorted(got) == sorted(plain_alerts(rows, 100, 4.5))


def test_a_large_batch_makes_few_calls_of_the_store():
    rows = [(i, "one", f"s{i % 7}", i, 1000 + i, 3) for i in range(5000)]
    _, store = through(rows, 1000, window=400)
    assert store.touched < 5 * 2 * 40


def test_packed_stream_with_timers_drops_silent_shards_and_keeps_the_rest(spark, tmp_path):
    rows = [(i, "a", "s", i, 1_000 + i, 9) for i in range(5)] + [(10 + i, "b", "t", i, 100_000 + 1000 * i, 9) for i in range(5)]
    for k in range(2):
        spark.createDataFrame(rows[5 * k : 5 * k + 5], ROWS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in.parquet")
    stream = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in.parquet")
    timed = stream.selectExpr("*", "timestamp_millis(ts_ms) as at").withWatermark("at", "1 second")
    out = replay.drain(alert_stream(timed, "shard", 0.1, 4.5, event_time="at", packed=True), "timed")
    assert kept(out.collect()) == [("s", 0, 1_000, 9.0, 1), ("t", 0, 100_000, 9.0, 1)]


def test_batches_grow_in_number_not_in_size(spark):
    rows = spark.range(1000)
    assert [replay.batches_of(rows, size) for size in (100, 300, 10_000)] == [10, 4, 4]


def test_pairs_of_a_batch_read_the_pending_frames_once():
    import pandas as pd

    class Pending(dict):
        calls = 0

        def iterator(self):
            return iter(list(self.items()))

        def updateValue(self, key, value):  # noqa: N802
            self.calls += 1
            self[key] = value

        def removeKey(self, key):  # noqa: N802
            self.calls += 1
            del self[key]

    store, pending = Store(), Pending()
    store.getMapState = lambda name, *_: pending
    n = 2000
    batch = pd.DataFrame({"frame_index": [k // 2 for k in range(n)], "arrival": range(n), "is_event": [k % 2 > 0 for k in range(n)], "payload": [[k] for k in range(n)], "detail": [["x"]] * n})
    for half in (batch[: n // 2], batch[n // 2 :]):
        processor = pairing.PairProcessor(8, "bigint", ["sequence", "frame_index", "arrival", "frame_arrival", "payload", "detail"])
        processor.init(store)
        assert sum(len(f) for f in processor.handleInputRows(("s",), iter([half]), None)) == n // 4
    assert pending.calls == 24 and set(pending) == {(k,) for k in range(n // 2 - 8, n // 2)}


@pytest.mark.parametrize("name", ["G2_alert_stream", "G2_alert_stream_shared_clock", "G2_alert_stream_late_frames", "C9_pending_pairs"])
def test_queries_give_their_sql_in_more_batches(spark, name, monkeypatch):
    monkeypatch.setattr(replay, "batches_of", lambda rows, *_: 6)
    same(catalog.QUERIES[name](spark, SMALL), catalog.ORACLES[name], SMALL)
