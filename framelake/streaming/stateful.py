"""Stateful streams: alerts over a sliding window, drift over counted windows, prediction health.

Rows belong to shards, as the partitions of a topic belong to consumers: rows of one shard share a clock and its counted
windows, shards are independent and run in parallel. Within a micro-batch a shard's rows are put in order of
arrival; the source's rate limit (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``) bounds them. State is what the rule
still needs: live frames, each an entry of its own, or the sums of the open window.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

STATS = ("brightness", "contrast", "blur")
STRETCH = 50_000  # rows of a micro-batch that are Python objects at a time


def _stateful(rows: DataFrame, shard: str, columns: list[str], schema: str, rule: Callable) -> DataFrame:
    """``rule(saved)`` makes a machine of a shard; its ``observe_batch(columns)`` gives output rows. The first column is the order of arrival."""

    def step(key, batches, state):
        import pandas as pd

        machine = rule(json.loads(state.get[0]) if state.exists else None)
        batch = pd.concat(list(batches)).dropna(subset=columns).sort_values(columns[0], kind="stable")
        out = list(machine.observe_batch([batch[c].to_numpy() for c in columns[1:]]))
        state.update((json.dumps(machine.saved()),))
        if out:
            yield pd.DataFrame([(key[0], *r) for r in out], columns=names)

    kind = rows.schema[shard].dataType.simpleString()
    names = [shard, *[c.strip().split(" ")[0] for c in schema.split(",")]]
    return rows.select(shard, *columns).groupBy(shard).applyInPandasWithState(step, f"{shard} {kind}, {schema}", "saved string", "append", GroupStateTimeout.NoTimeout)


class Kept:
    """A map state of which a batch reads and writes only what it touches: each key is read once, and written or removed at the end."""

    def __init__(self, state):
        self.state, self.held, self.changed = state, {}, set()

    def get(self, key: tuple) -> tuple | None:
        if key not in self.held:
            self.held[key] = tuple(self.state.getValue(key)) if self.state.containsKey(key) else None
        return self.held[key]

    def put(self, key: tuple, value: tuple | None) -> None:
        self.get(key)
        self.held[key] = value
        self.changed.add(key)

    def write(self) -> None:
        for key in self.changed:
            if self.held[key] is not None:
                self.state.updateValue(key, self.held[key])
            elif self.state.containsKey(key):
                self.state.removeKey(key)


class AlertProcessor(StatefulProcessor):
    """Mean of n over a sequence's live frames; fires once when it crosses and again only after it came down or the sequence fell silent.

    State of a shard: each live frame, each live sequence (sum, frames, whether an episode is open), the frames by slice of
    time in which they fall due, and the clock. A batch touches the frames and sequences that its rows name and the slices that the
    clock passes. A repeated frame replaces itself; what the clock leaves behind by more than the window goes, and with the
    last frame of a sequence its open episode. With ``timers`` the same happens to a shard that gets no rows, when the stream's watermark
    has passed its frames.
    """

    SLICES = 32  # of a window

    def __init__(self, window_ms: int, threshold: float, names: list[str], timers: bool = False):
        self.window_ms, self.threshold, self.names, self.timers = window_ms, threshold, names, timers
        self.slice_ms = max(1, window_ms // self.SLICES)

    def init(self, handle) -> None:
        self.handle = handle
        self.frames = handle.getMapState("frames", "sequence string, frame bigint", "ts bigint, n bigint")
        self.sequences = handle.getMapState("sequences", "sequence string", "total bigint, frames bigint, open boolean")
        self.slices = handle.getMapState("slices", "slice bigint", "entries string")
        self.clock_state = handle.getValueState("clock", "clock bigint, slices string")

    def _begin(self) -> None:
        saved = self.clock_state.get() if self.clock_state.exists() else None
        self.clock, self.waiting = (saved[0], json.loads(saved[1])) if saved else (0, [])  # slices that hold frames, a window's worth
        self.live, self.totals, self.due = Kept(self.frames), Kept(self.sequences), []
        heapq.heapify(self.waiting)

    def _end(self) -> None:
        again: dict[int, list] = {}
        for ts, sequence, frame in self.due:
            if (row := self.live.get((sequence, frame))) and row[0] == ts:
                again.setdefault(ts // self.slice_ms, []).append([ts, sequence, frame])
        held = set(self.waiting)
        for k, entries in again.items():
            before = json.loads(self.slices.getValue((k,))[0]) if k in held else []
            self.slices.updateValue((k,), (json.dumps(before + entries),))
        waiting = sorted(held | set(again))
        self.live.write()
        self.totals.write()
        self.clock_state.update((self.clock, json.dumps(waiting)))
        if self.timers:
            for t in self.handle.listTimers():
                self.handle.deleteTimer(t[0] if isinstance(t, tuple) else t)
            if waiting:
                self.handle.registerTimer((waiting[0] + 1) * self.slice_ms + self.window_ms)

    def _drop(self, sequence: str, frame: int) -> None:
        if (old := self.live.get((sequence, frame))) is not None:
            total, frames, open_ = self.totals.get((sequence,))
            self.totals.put((sequence,), (total - old[1], frames - 1, open_))
            self.live.put((sequence, frame), None)

    def _advance(self, ts: int, *touched: str) -> None:
        self.clock, touched = max(self.clock, ts), set(touched)
        horizon = self.clock - self.window_ms
        while self.waiting and self.waiting[0] * self.slice_ms < horizon:
            k = heapq.heappop(self.waiting)
            for entry in json.loads(self.slices.getValue((k,))[0]):
                heapq.heappush(self.due, tuple(entry))
            self.slices.removeKey((k,))
        while self.due and self.due[0][0] < horizon:
            then, s, f = heapq.heappop(self.due)
            if (row := self.live.get((s, f))) and row[0] == then:
                self._drop(s, f)
                touched.add(s)
        for s in touched:
            if (at := self.totals.get((s,))) and not at[1]:
                self.totals.put((s,), None)

    def observe(self, arrival: int, sequence: str, frame: int, ts: int, n: int, clock: int = 0):
        """(arrival, sequence, frame, ts, mean, live frames) of an alert, else None; ``clock`` is the highest ts of earlier arrivals, for a shard that doesn't see them all."""
        self._advance(clock)
        self._drop(sequence, frame)
        total, frames, open_ = self.totals.get((sequence,)) or (0, 0, False)
        self.totals.put((sequence,), (total + n, frames + 1, open_))
        self.live.put((sequence, frame), (ts, n))
        heapq.heappush(self.due, (ts, sequence, frame))
        self._advance(ts, sequence)
        if (at := self.totals.get((sequence,))) is None:
            return None
        total, frames, open_ = at
        crossed = total / frames > self.threshold
        self.totals.put((sequence,), (total, frames, crossed))
        return (arrival, sequence, frame, ts, total / frames, frames) if crossed and not open_ else None

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803  names of the interface
        import pandas as pd

        self._begin()
        batch = pd.concat(list(rows)).sort_values("arrival", kind="stable")
        wanted, out = ["arrival", "sequence", "frame_index", "ts_ms", "n", *(["clock"] if "clock" in batch.columns else [])], []
        for k in range(0, len(batch), STRETCH):
            part = batch.iloc[k : k + STRETCH]
            out += [hit for row in zip(*(part[c].tolist() for c in wanted), strict=True) if (hit := self.observe(*row)) is not None]
        self._end()
        if out:
            yield pd.DataFrame([(key[0], *r) for r in out], columns=self.names)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
        self._begin()
        self._advance(timerValues.getCurrentWatermarkInMs())
        self._end()
        return iter(())

    def close(self) -> None:
        pass


class WindowAlertProcessor(AlertProcessor):
    """The rule of ``AlertProcessor`` for micro-batches that hold about as many rows as the window, or more.

    State of a shard: its live frames, packed by slice of time into one entry each, and the clock with the sequences whose episode is open. A
    batch reads the whole window once, walks its rows over it in memory and writes the slices that changed, where an entry for
    each frame would cost several calls of the store for each row.
    """

    def init(self, handle) -> None:
        self.handle = handle
        self.slices = handle.getMapState("slices", "slice bigint", "entries string")
        self.clock_state = handle.getValueState("clock", "clock bigint, kept string")

    def _begin(self) -> None:
        saved = self.clock_state.get() if self.clock_state.exists() else None
        self.clock, kept = (saved[0], json.loads(saved[1])) if saved else (0, {"slices": [], "open": []})
        self.texts = {k: self.slices.getValue((k,))[0] for k in kept["slices"]}
        self.live, self.totals, self.by_slice, self.due = {}, {}, {}, []
        for k, text in self.texts.items():
            entries = json.loads(text)
            self.by_slice[k] = [(ts, s, f) for ts, s, f, _ in entries]
            for ts, s, f, n in entries:
                self.live[s, f] = (ts, n)
                at = self.totals.setdefault(s, [0, 0, False])
                at[0] += n
                at[1] += 1
        for s in kept["open"]:
            self.totals[s][2] = True
        self.waiting = sorted(self.by_slice)

    def _end(self) -> None:
        slices: dict[int, list] = {}
        for (s, f), (ts, n) in self.live.items():
            slices.setdefault(ts // self.slice_ms, []).append((ts, s, f, n))
        for k, entries in slices.items():
            text = json.dumps(entries)
            if self.texts.get(k) != text:
                self.slices.updateValue((k,), (text,))
        for k in self.texts.keys() - slices.keys():
            self.slices.removeKey((k,))
        self.clock_state.update((self.clock, json.dumps({"slices": sorted(slices), "open": [s for s, at in self.totals.items() if at[2]]})))
        if self.timers:
            for t in self.handle.listTimers():
                self.handle.deleteTimer(t[0] if isinstance(t, tuple) else t)
            if slices:
                self.handle.registerTimer((min(slices) + 1) * self.slice_ms + self.window_ms)

    def _advance(self, ts: int) -> None:
        if ts <= self.clock:
            return
        self.clock = ts
        horizon = ts - self.window_ms
        while self.waiting and self.waiting[0] * self.slice_ms < horizon:
            for entry in self.by_slice.pop(heapq.heappop(self.waiting)):
                heapq.heappush(self.due, entry)
        while self.due and self.due[0][0] < horizon:
            then, s, f = heapq.heappop(self.due)
            if (row := self.live.get((s, f))) and row[0] == then:
                del self.live[s, f]
                at = self.totals[s]
                at[0] -= row[1]
                at[1] -= 1
                if not at[1]:
                    del self.totals[s]

    def _wait(self, ts: int, sequence: str, frame: int) -> None:
        k = ts // self.slice_ms
        if (entries := self.by_slice.get(k)) is not None:
            entries.append((ts, sequence, frame))
        elif k * self.slice_ms < self.clock - self.window_ms:  # the slice in which the horizon lies
            heapq.heappush(self.due, (ts, sequence, frame))
        else:
            self.by_slice[k] = [(ts, sequence, frame)]
            heapq.heappush(self.waiting, k)

    def observe(self, arrival: int, sequence: str, frame: int, ts: int, n: int, clock: int = 0):
        self._advance(clock)
        at = self.totals.setdefault(sequence, [0, 0, False])
        if (old := self.live.pop((sequence, frame), None)) is not None:
            at[0] -= old[1]
            at[1] -= 1
        if ts >= self.clock - self.window_ms:
            at[0] += n
            at[1] += 1
            self.live[sequence, frame] = (ts, n)
            self._wait(ts, sequence, frame)
            self._advance(ts)
        elif not at[1]:  # it came too late, and nothing else is live
            del self.totals[sequence]
            return None
        crossed, was = at[0] / at[1] > self.threshold, at[2]
        at[2] = crossed
        return (arrival, sequence, frame, ts, at[0] / at[1], at[1]) if crossed and not was else None


def use_rocksdb(spark) -> None:
    """Map states need this store of state; streams that are started from here on have it."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def alert_stream(events: DataFrame, shard: str, window_s: float, threshold: float, clock: str | None = None, event_time: str | None = None, packed: bool = False) -> DataFrame:
    """Alerts of events arrival, sequence, frame_index, ts_ms, n; events with a null among these are skipped.

    ``clock``: a column with the highest ts_ms of all earlier arrivals, where shards are to share one clock. ``event_time``: a
    timestamp column with a watermark; when that has passed the last frame of a silent shard by the window, its state is dropped. ``packed``: state by slices of the window, for large
    micro-batches, as a replay has them; else an entry for each frame, for small ones.
    """
    columns = ["arrival", "sequence", "frame_index", "ts_ms", "n"]
    before = [f"coalesce({clock}, 0L) as clock"] if clock else []
    before += [event_time] if event_time else []
    keyed = events.na.drop(subset=columns).withColumnRenamed("sequence", "_s").selectExpr(f"{'_s' if shard == 'sequence' else shard} as shard", "arrival", "_s as sequence", "frame_index", "ts_ms", "n", *before)
    schema = f"shard {keyed.schema['shard'].dataType.simpleString()}, arrival bigint, sequence string, frame_index bigint, ts_ms bigint, observed double, n_frames bigint"
    names = [c.split(" ")[0] for c in schema.split(", ")]
    use_rocksdb(events.sparkSession)
    processor = (WindowAlertProcessor if packed else AlertProcessor)(int(window_s * 1000), threshold, names, bool(event_time))
    return keyed.groupBy("shard").transformWithStateInPandas(processor, schema, "Append", "EventTime" if event_time else "None")


def _onto(total: float, values) -> float:
    """``total`` and ``values`` added one after the other, so that a sum doesn't depend on where a batch ends."""
    return float(np.cumsum(np.concatenate([[total], values]))[-1])


class CountWindow:
    """Every ``every``-th row goes into windows of ``size`` rows; ``close`` makes the output of a full one.

    Rows come as columns and are taken a window's stretch at a time, so Python steps once for each window, not for each row.
    """

    def __init__(self, size: int, every: int, saved: dict | None):
        self.size, self.every = size, every
        self.state = saved or {"seen": 0, "window_id": 0, "rows": 0, "sums": [0.0] * self.width, **self.extra()}

    width = 0

    def extra(self) -> dict:
        return {}

    def saved(self) -> dict:
        return self.state

    def add_many(self, columns: list) -> None:
        """A stretch of rows into the open window."""
        for row in zip(*columns, strict=True):
            self.add(*row)

    def observe_batch(self, columns: list):
        """The outputs of the windows that these rows fill."""
        st = self.state
        first = self.every - 1 - st["seen"] % self.every  # place of the first row that counts
        st["seen"] += len(columns[0])
        taken = [c[first :: self.every] for c in columns]
        at, n = 0, len(taken[0])
        while at < n:
            upto = min(n, at + self.size - st["rows"])
            self.add_many([c[at:upto] for c in taken])
            st["rows"] += upto - at
            at = upto
            if st["rows"] == self.size:
                out = self.close()
                st.update(window_id=st["window_id"] + 1, rows=0, sums=[0.0] * self.width)
                if out is not None:
                    yield out

    def observe(self, arrival, *values):
        return next(iter(list(self.observe_batch([[v] for v in values]))), None)


class DriftWindow(CountWindow):
    """Episodes: the window at which a run of drifted ones reaches ``consecutive``."""

    width = len(STATS)

    def __init__(self, size, every, saved, reference: dict, consecutive: int):
        super().__init__(size, every, saved)
        self.reference, self.consecutive = reference, consecutive

    def extra(self):
        return {"run": 0}

    def add_many(self, columns):
        self.state["sums"] = [_onto(s, c) for s, c in zip(self.state["sums"], columns, strict=True)]

    def close(self):
        means = [s / self.size for s in self.state["sums"]]
        means[2] = math.log(max(means[2], 1e-6))
        ref = self.reference
        scores = [abs(m - ref[f"centre_{c}"]) / ref[f"spread_{c}"] for m, c in zip(means, STATS)]
        drifted = any(s > ref[f"threshold_{c}"] for s, c in zip(scores, STATS))
        self.state["run"] = self.state["run"] + 1 if drifted else 0
        return (self.state["window_id"], *scores) if self.state["run"] == self.consecutive else None


def drift_stream(readings: DataFrame, reference: DataFrame, shard: str, order: str, size: int = 100, every: int = 1, consecutive: int = 2) -> DataFrame:
    """Episodes of readings brightness, contrast, blur against the one row ``reference``; incomplete windows are never judged, rows with nulls aren't counted.

    Nulls go inside the task: a filter on readings would be pushed below them and compute them twice.
    """
    ref = reference.first().asDict()  # one row
    columns = [order, *STATS]
    return _stateful(readings, shard, columns, "window_id long, score_brightness double, score_contrast double, score_blur double", lambda saved: DriftWindow(size, every, saved, ref, consecutive))


class HealthWindow(CountWindow):
    width = 3

    def extra(self):
        return {"classes": {}}

    def add_many(self, columns):
        n, conf, cls = columns
        sums, classes = self.state["sums"], self.state["classes"]
        kinds, at = np.unique(cls.astype(str), return_inverse=True)
        for c, k in zip(kinds.tolist(), np.bincount(at, n).tolist(), strict=True):
            classes[c] = classes.get(c, 0) + int(k)
        self.state["sums"] = [sums[0] + len(n), sums[1] + int(n.sum()), _onto(sums[2], conf * n)]

    def close(self):
        events, boxes, conf = self.state["sums"]
        classes = self.state["classes"]
        shares = {c: (k / boxes if boxes else 0.0) for c, k in sorted(classes.items())}
        self.state["classes"] = dict.fromkeys(classes, 0)
        return self.state["window_id"], int(events), boxes / events, conf / boxes if boxes else 0.0, json.dumps(shares)


def health_stream(events: DataFrame, shard: str, order: str, size: int, every: int = 1) -> DataFrame:
    """Per window of events n, conf, cls (n boxes of one class): boxes an event, mean conf (0 without boxes), share of each class so far seen."""
    columns = [order, "n", "conf", "cls"]
    return _stateful(events.na.drop(subset=columns), shard, columns, "window_id long, n_events long, boxes_per_event double, mean_conf double, shares string", lambda saved: HealthWindow(size, every, saved))
