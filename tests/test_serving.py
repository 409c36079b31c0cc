"""Scoring of frame messages: poison frames, order, counters of batches that run again, streams that stop and go on."""

from framelake.sources import messages as M
from framelake.streaming import counters, serving

MESSAGE = "key binary, headers array<struct<key string, value binary>>, value binary"


def message(sequence="a", index=b"1", ts=b"5", value=b"ok"):
    headers = [(n, bytearray(v)) for n, v in (("frame_index", index), ("ts_ms", ts)) if v is not None]
    return (bytearray(sequence.encode()), headers, None if value is None else bytearray(value))


def infer(payload: bytes):
    if payload == b"bad":
        raise KeyError("no picture")
    return 200, 100, [(0, 0, 50, 50, 0.5, 1), (100, 50, 200, 100, 0.25, 9)] if payload else []


def test_poison_frames_are_told_and_the_others_scored(spark):
    big = str(2**62 + 1).encode()
    sent = [message(), message(index=b"x"), message(ts=None), message(value=None), message(value=b"bad"), message(value=b""), message(sequence=""), message(index=big)]
    rows = serving.score(spark.createDataFrame(sent, MESSAGE).coalesce(1), infer, ("m", "2"), {1: "car"}).collect()
    assert [r.error for r in rows] == [None, *["unreadable message"] * 3, "KeyError: 'no picture'", None, "unreadable message", None]
    first, empty, last = rows[0], rows[5], rows[7]
    assert (first.sequence, first.frame_index, first.ts_frame_ms, first.schema_version) == ("a", 1, 5, 1)
    assert [(b.cls, b.conf, b.xywhn) for b in first.boxes] == [("car", 0.5, [0.125, 0.25, 0.25, 0.5]), ("9", 0.25, [0.75, 0.75, 0.5, 0.5])]
    assert tuple(first.model) == ("m", "2") and first.latency_ms >= 0 and first.ts_infer_ms > 1.6e12
    assert empty.boxes == [] and last.frame_index == 2**62 + 1
    assert all(r.boxes is None and r.model is None and r.latency_ms is None for r in rows if r.error)


def test_events_are_whole_on_the_wire_and_no_rows_give_none(spark):
    sent = spark.createDataFrame([message(), message(value=b"bad")], MESSAGE)
    got = M.parse_events(serving.events(serving.score(sent, infer, ("m", "2"), {}))).collect()
    assert [(r.ok, r.sequence, r.model.version, [b.cls for b in r.boxes]) for r in got] == [(True, "a", "2", ["1", "9"])]
    assert serving.score(sent.where("false"), infer, ("m", "2"), {}).count() == 0


def test_a_batch_reported_again_counts_once():
    c = counters.BatchCounters("scored")
    for query, batch, n in (("q", 0, 5), ("q", 1, 7), ("q", 1, 8), ("q", 0, 5), ("q", 4, 1), ("p", 0, 100)):
        c.take(query, batch, {"events": n})
    assert c.totals("q") == {"events": 14} and c.totals() == {"events": 114} and c.totals("none") == {}


def test_counters_of_a_stream_that_stops_and_goes_on(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([], MESSAGE).write.parquet(source)
    listener = counters.BatchCounters(serving.COUNTERS)
    for k in range(3):
        spark.createDataFrame([message(index=str(k).encode()), message(value=b"bad")], MESSAGE).coalesce(1).write.mode("append").parquet(source)
        frames = spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", 1).parquet(source)
        scored = serving.score(frames, infer, ("m", "2"), {})
        job = scored.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start(out)
        listener.follow(job)
    rows = spark.read.parquet(out)
    fine = rows.where("error is null").count()
    assert listener.totals() == {"consumed": rows.count(), "events": fine, "skipped": rows.count() - fine} == {"consumed": 6, "events": 3, "skipped": 3}


def test_a_stream_without_rows_has_no_counts(spark, tmp_path):
    spark.createDataFrame([], MESSAGE).write.parquet(str(tmp_path / "in"))
    frames = spark.readStream.schema(MESSAGE).parquet(str(tmp_path / "in"))
    rows, totals = counters.drain_counted(serving.score(frames, infer, ("m", "2"), {}), "none", serving.COUNTERS)
    assert rows.count() == 0 and totals == {}
