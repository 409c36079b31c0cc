"""Pairs over packed rows, replays whose ranges are written once, and stores of state no more than tasks at once."""

import os
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pytest

from framelake.plans import catalog
from framelake.streaming import pairing, replay
from tests.helpers import SMALL, same
from tests.test_pairing import COLUMNS, some_rows, walked

SCHEMA = "sequence string, frame_index bigint, arrival bigint, is_event boolean, payload {}, detail {}"


def paired(spark, path, parts, kinds, cap, packed=True):
    """The parts as files that come one after the other; the stream stops after each and starts again from its checkpoint."""
    schema = SCHEMA.format(*kinds)
    spark.createDataFrame([], schema).write.parquet(f"{path}/in")
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(2).write.mode("append").parquet(f"{path}/in")
        both = spark.readStream.schema(schema).parquet(f"{path}/in")
        stream = pairing.pairs(both.where("not is_event"), both.where("is_event"), "payload", "detail", cap, packed=packed)
        stream.writeStream.format("parquet").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start(f"{path}/out").awaitTermination()
    return [tuple(r) for r in spark.read.parquet(f"{path}/out").select(*COLUMNS).collect()]


def test_packed_pairs_equal_the_walk_over_restarts(spark, tmp_path):
    rows = some_rows(400, 2, 5)
    odd = [(None, 1, 1, False, "p", None), ("a", None, 2, True, None, "x"), ("a", 1, None, False, "p", None)]
    got = sorted(paired(spark, tmp_path, [rows[:150], rows[150:160] + odd, rows[160:]], ("string", "string"), 5))
    assert len(got) > 20 and got == walked(rows, 5)


@pytest.mark.parametrize(("packed", "kind", "values"), [(False, "double", [0.5, None, float("nan")]), (True, "float", [0.5, None, float("nan")]), (True, "bigint", [2**60 + 1, None, 0]), (True, "boolean", [True, None, False]), (True, "decimal(30,2)", [Decimal("1" * 28 + ".25"), None, Decimal("0.00")]), (True, "binary", [b"\xff\x00", None, b""])])
def test_values_and_nulls_come_through_state_and_batch(spark, tmp_path, packed, kind, values):
    frames = [("s", k, k, False, v, None) for k, v in enumerate(values)]
    at_once = [("s", k, 10 + k, True, None, v) for k, v in enumerate(values)]
    later = [("s", k, 20 + k, True, None, v) for k, v in enumerate(values)]
    got = paired(spark, tmp_path, [frames + at_once, later], (kind, kind), 8, packed)
    shown = {r[2]: tuple(repr(bytes(v) if isinstance(v, bytearray) else v) for v in r[4:]) for r in got}
    assert shown == {at + k: (repr(v), repr(v)) for at in (10, 20) for k, v in enumerate(values)}


def test_packs_hold_each_row_once_by_sequence(monkeypatch):
    n = 500
    columns = {"sequence": [f"s{k % 3}" for k in range(n)], "frame_index": range(n), "arrival": range(n), "is_event": [k % 2 > 0 for k in range(n)], "valued": [True] * n, "payload": [f"{k}" for k in range(n)], "detail": range(n)}
    batch = pa.record_batch({c: pa.array(list(v)) for c, v in columns.items()})
    for limit, packs in ((pairing.PACK_BYTES, 3), (batch.nbytes // 10, 30)):
        monkeypatch.setattr(pairing, "PACK_BYTES", limit)
        got = [r for b in pairing._packs([batch, batch.slice(0, 0)]) for r in b.to_pylist()]
        assert packs <= len(got) <= packs + 3
        rows = [(r["sequence"], *x) for r in got for x in zip(*(r[c] for c in pairing.COLUMNS), strict=True)]
        assert sorted(rows) == sorted(zip(columns["sequence"], *(columns[c] for c in pairing.COLUMNS), strict=True))


def test_a_sequence_is_few_rows_to_the_tasks_of_its_state(spark, tmp_path):
    """Spark hands rows on to such a task one by one in Python, so a micro-batch must not come as its rows."""
    seen = []

    class Counted(pairing.PackedPairProcessor):
        def columns(self, rows):
            packs = list(rows)
            seen.append(sum(map(len, packs)))
            return super().columns(packs)

    rows = pa.record_batch({c: pa.array(v) for c, v in {"sequence": ["s"] * 5000, "frame_index": [k // 2 for k in range(5000)], "arrival": list(range(5000)), "is_event": [k % 2 > 0 for k in range(5000)], "valued": [True] * 5000, "payload": list(range(5000)), "detail": ["x"] * 5000}.items()})
    processor = Counted(64, "bigint", [*COLUMNS, "has_payload", "has_detail"])
    processor.pending = type("Map", (), {"iterator": lambda self: iter(()), "updateValue": lambda self, k, v: None, "removeKey": lambda self, k: None})()
    processor.ends = type("Value", (), {"exists": lambda self: False, "update": lambda self, v: None})()
    packs = (b.to_pandas() for b in pairing._packs([rows]))
    out = list(processor.handleInputRows(("s",), packs, None))
    assert seen == [1] and sum(map(len, out)) == 2500
    assert all(np.array_equal(f["arrival"], f["frame_arrival"] + 1) and f["payload"].dtype == np.int64 for f in out)


@pytest.mark.parametrize("kept", [True, False])
def test_ranges_come_in_order_whether_or_not_times_can_be_set(spark, monkeypatch, kept):
    made = []
    monkeypatch.setattr(replay, "new_path", lambda s, name, f=replay.new_path: made.append(p := f(s, name)) or p)
    if not kept:
        monkeypatch.setattr(replay, "stamped", lambda *_: False)
    rows = spark.range(1000).selectExpr("999 - id as arrival").repartition(7)
    stream = replay.in_order(rows, "arrival", 3, "ranges")
    assert len(made) == (1 if kept else 2)  # without a second copy
    files = sorted((f.getModificationTime(), f.getPath().toString()) for f in replay._files(spark, made[-1])[1])
    ends = [spark.read.parquet(f).selectExpr("min(arrival)", "max(arrival)").first() for _, f in files]
    assert len({t for t, _ in files}) == len(files) == 12
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:], strict=False)) and ends[0][0] == 0 and ends[-1][1] == 999
    ids = []
    job = stream.writeStream.foreachBatch(lambda b, k: ids.append((k, b.selectExpr("min(arrival)", "max(arrival)").first()))).option("checkpointLocation", f"{made[0]}-state").trigger(availableNow=True).start()
    job.awaitTermination()
    assert [k for k, _ in ids] == [0, 1, 2] and all(a[1] < b[0] for (_, a), (_, b) in zip(ids, ids[1:], strict=False))


def test_times_that_a_store_refuses_or_forgets_are_noticed(spark, tmp_path):
    path = f"file://{tmp_path}/parts"
    spark.range(10).repartition(3).write.parquet(path)
    assert replay.stamped(spark, path)
    found = [f.getModificationTime() for f in replay._files(spark, path)[1]]
    assert found == sorted(set(found))
    store, files = replay._files(spark, path)
    for forgets in (lambda *_: None, None):
        class Store:
            def setTimes(self, *a, forgets=forgets):  # noqa: N802
                return forgets(*a) if forgets else store.setTimes(store.getWorkingDirectory().getParent().suffix("/no-such-file"), 0, -1)

        for f in files:
            store.setTimes(f.getPath(), 1_700_000_000_000, -1)
        with pytest.MonkeyPatch.context() as m:
            m.setattr(replay, "_files", lambda s, p, f=replay._files, other=Store(): (other, f(s, p)[1]))
            assert not replay.stamped(spark, path)


def test_more_ranges_than_asked_for_lose_no_rows(spark, monkeypatch):
    """Who runs a session may deal ranges finer; micro-batches stay as many as asked for."""
    frame = type(spark.range(0))
    monkeypatch.setattr(frame, "repartitionByRange", lambda self, n, *cols, f=frame.repartitionByRange: f(self, max(n, 21), *cols))
    ids = []
    stream = replay.in_order(spark.range(1000).selectExpr("id as arrival"), "arrival", 3, "finer")
    stream.writeStream.foreachBatch(lambda b, k: ids.append(b.count())).option("checkpointLocation", replay.new_path(spark, "finer-state")).trigger(availableNow=True).start().awaitTermination()
    assert len(ids) == 3 and sum(ids) == 1000


def test_an_empty_table_is_replayed(spark):
    rows = spark.createDataFrame([], "arrival bigint")
    assert replay.drain(replay.in_order(rows, "arrival", 4, "none"), "none-out").count() == 0


@pytest.mark.parametrize("name", ["C9_pending_pairs", "G2_alert_stream"])
def test_state_is_in_no_more_stores_than_tasks_run_at_once(spark, monkeypatch, name):
    made = []
    monkeypatch.setattr(replay, "new_path", lambda s, n, f=replay.new_path: made.append(p := f(s, n)) or p)
    monkeypatch.setattr(replay, "at_once", lambda s: 2)
    same(catalog.QUERIES[name](spark, SMALL), catalog.ORACLES[name], SMALL)
    state = next(p for p in made if "-state-" in p).removeprefix("file://") + "/state/0"
    assert sorted(d for d in os.listdir(state) if d.isdigit()) == ["0", "1"]
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
