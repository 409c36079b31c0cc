import json
import random

import numpy as np

from framelake.streaming import replay
from framelake.streaming.stateful import AlertProcessor, CountWindow, HealthWindow, alert_stream

ROWS = "arrival long, shard string, sequence string, frame_index long, ts_ms long, n long"


def plain_alerts(rows, window_ms, threshold):
    """All arrivals so far, looked at anew for each event."""
    latest, clock, flags, out = {}, 0, {}, []
    for _, _, seq, frame, ts, n in rows:
        latest[seq, frame] = ts, n
        clock = max(clock, ts)
        live = {k: v for k, v in latest.items() if v[0] >= clock - window_ms}
        flags = {s: f for s, f in flags.items() if any(k[0] == s for k in live)}
        counts = [v[1] for k, v in live.items() if k[0] == seq]
        if counts:
            mean = sum(counts) / len(counts)
            if mean > threshold and not flags.get(seq):
                out.append((seq, frame, ts, mean, len(counts)))
            flags[seq] = mean > threshold
    return out


def events(seed, n):
    rng = random.Random(seed)
    return [(i, "one", f"s{rng.randrange(3)}", rng.randrange(n // 2), 1000 + 10 * i - rng.choice([0, 0, 0, 90, 300]), rng.randrange(10)) for i in range(n)]


class Store:
    """Map and value states in memory; counts what is touched."""

    def __init__(self):
        self.maps, self.touched = {}, 0

    def getMapState(self, name, *_):  # noqa: N802
        return View(self, self.maps.setdefault(name, {}))

    def getValueState(self, name, *_):  # noqa: N802
        held = self.maps.setdefault(name, {})

        class Value:
            def exists(self):
                return bool(held)

            def get(self):
                return held[0]

            def update(self, value):
                held[0] = value

        return Value()


class View:
    def __init__(self, store, held):
        self.store, self.held = store, held

    def containsKey(self, key):  # noqa: N802
        self.store.touched += 1
        return key in self.held

    def getValue(self, key):  # noqa: N802
        return self.held[key]

    def updateValue(self, key, value):  # noqa: N802
        self.store.touched += 1
        self.held[key] = value

    def removeKey(self, key):  # noqa: N802
        del self.held[key]


def batches_through(rows, size, store=None, window=100):
    import pandas as pd

    store, out = store or Store(), []
    for k in range(0, len(rows), size):
        processor = AlertProcessor(window, 4.5, ["shard", "arrival", "sequence", "frame_index", "ts_ms", "observed", "n_frames"])
        processor.init(store)
        part = pd.DataFrame(rows[k : k + size], columns=["arrival", "shard", "sequence", "frame_index", "ts_ms", "n"])
        for frame in processor.handleInputRows(("one",), iter([part.sample(frac=1, random_state=k)]), None):
            out += [tuple(r) for r in frame.itertuples(index=False)]
    return out, store


def test_alerts_with_late_and_repeated_frames_over_batches():
    for seed in range(30):
        rows = events(seed, 120)
        for size in (1, 17, 120):
            got, store = batches_through(rows, size)
            assert [r[2:] for r in got] == plain_alerts(rows, 100, 4.5)
            clock = max(r[4] for r in rows)
            latest = {(r[2], r[3]): r[4] for r in rows}
            assert set(store.maps["frames"]) == {k for k, ts in latest.items() if ts >= clock - 100}  # nothing behind the horizon stays
            assert set(store.maps["sequences"]) == {(s,) for s, _ in store.maps["frames"]}


def test_a_batch_touches_only_what_it_names():
    rows = [(i, "one", f"s{i % 7}", i, 1000 + i, 3) for i in range(5000)]
    _, store = batches_through(rows, 5000, window=100_000)
    assert len(store.maps["frames"]) == 5000
    store.touched = 0
    batches_through([(5000, "one", "s1", 5000, 6000, 3)], 1, store, window=100_000)
    assert store.touched < 12


def test_a_silent_shard_is_dropped_when_its_time_comes():
    class Timers:
        def getCurrentWatermarkInMs(self):  # noqa: N802
            return 2000

    _, store = batches_through([(i, "one", "s", i, 1000 + i, 9) for i in range(50)], 50)
    processor = AlertProcessor(100, 4.5, [])
    processor.init(store)
    list(processor.handleExpiredTimer(("one",), Timers(), None))
    assert not store.maps["frames"] and not store.maps["sequences"] and not store.maps["slices"]


def kept(rows):
    return sorted((r.sequence, r.frame_index, r.ts_ms, r.observed, r.n_frames) for r in rows)


def test_stream_in_batches_and_after_a_restart_equals_the_loop(spark, tmp_path):
    rows = events(99, 90)

    def run(k):
        spark.createDataFrame(rows[30 * k : 30 * k + 30], ROWS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in.parquet")
        stream = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in.parquet")
        job = alert_stream(stream, "shard", 0.1, 4.5).writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start(f"{tmp_path}/out")
        job.awaitTermination()

    for k in range(3):  # each time another query goes on from the checkpoint
        run(k)
    assert kept(spark.read.parquet(f"{tmp_path}/out").collect()) == sorted(plain_alerts(rows, 100, 4.5))


def test_stream_with_timers_drops_silent_shards_and_keeps_the_rest(spark, tmp_path):
    rows = [(i, "a", "s", i, 1_000 + i, 9) for i in range(5)] + [(10 + i, "b", "t", i, 100_000 + 1000 * i, 9) for i in range(5)]
    for k in range(2):
        spark.createDataFrame(rows[5 * k : 5 * k + 5], ROWS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in.parquet")
    stream = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in.parquet")
    timed = stream.selectExpr("*", "timestamp_millis(ts_ms) as at").withWatermark("at", "1 second")
    out = replay.drain(alert_stream(timed, "shard", 0.1, 4.5, event_time="at"), "timed")
    assert kept(out.collect()) == [("s", 0, 1_000, 9.0, 1), ("t", 0, 100_000, 9.0, 1)]


def test_count_windows_leave_out_what_is_not_full():
    class Sum(CountWindow):
        width = 1

        def add(self, v):
            self.state["sums"][0] += v

        def close(self):
            return self.state["window_id"], self.state["sums"][0]

    w = Sum(2, 2, None)
    assert [w.observe(i, i) for i in range(1, 10)] == [None, None, None, (0, 6.0), None, None, None, (1, 14.0), None]


def test_windows_are_the_same_however_rows_are_dealt_to_batches():
    rng = np.random.default_rng(3)
    n, conf, cls = rng.integers(0, 9, 500), rng.random(500), rng.choice(["a", "b", "c"], 500)

    def run(cuts):
        saved, out = None, []
        for a, b in zip([0, *cuts], [*cuts, 500]):
            w = HealthWindow(30, 3, saved)
            out += list(w.observe_batch([n[a:b], conf[a:b], cls[a:b]]))
            saved = json.loads(json.dumps(w.saved()))
        return out

    whole = run([])
    taken = slice(2, None, 3)
    first = n[taken][:30]
    assert len(whole) == 5 and whole[0][:3] == (0, 30, first.sum() / 30)
    assert json.loads(whole[0][4])["a"] == first[cls[taken][:30] == "a"].sum() / first.sum()
    for cuts in ([1], [89, 90, 91], [90, 180], sorted(rng.integers(0, 500, 40).tolist())):
        assert run(cuts) == whole
