"""Events and pending frames against a plain walk over rows in order of arrival."""

import random

import pandas as pd

from framelake.streaming import pairing, replay

COLUMNS = ["sequence", "frame_index", "arrival", "frame_arrival", "payload", "detail"]


def walked(rows, cap):
    """Rows (sequence, frame_index, arrival, is_event, payload, detail) in order: what each event finds."""
    pending, out = {}, []
    for sequence, index, arrival, event, payload, detail in sorted(rows, key=lambda r: (r[2], r[3])):
        queue = pending.setdefault(sequence, [])  # [index, arrival, payload], oldest first
        found = next((q for q in queue if q[0] == index), None)
        if event and found:
            out.append((sequence, index, arrival, found[1], found[2], detail))
        elif not event and found:
            found[1:] = arrival, payload
        elif not event:
            queue.append([index, arrival, payload])
            del queue[:-cap]
    return sorted(out)


def some_rows(n, seed, cap):
    r, rows = random.Random(seed), []
    for k in range(n):
        at = k // 4 - r.randrange(2 * cap)
        if r.random() < 0.5:  # a frame, now and then one that was there before
            rows.append((r.choice("ab"), k // 4 if r.random() < 0.7 else at, k, False, f"p{k}", None))
        else:  # an event of a frame that is pending, pushed out, or yet to come
            rows.append((r.choice("ab"), at if r.random() < 0.8 else at + 2 * cap, k, True, None, r.choice("xyz")))
    return rows


def run(spark, parts, cap, tmp_path, several=False):
    """The parts of the rows as files that come one after the other; with ``several`` the stream stops after each and starts again from its checkpoint."""
    schema = "sequence string, frame_index bigint, arrival bigint, is_event boolean, payload string, detail string"
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([], schema).write.parquet(source)

    def drain():
        both = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        stream = pairing.pairs(both.where("not is_event"), both.where("is_event"), "payload", "detail", cap)
        stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start(out).awaitTermination()

    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        if several:
            drain()
    if not several:
        drain()
    return sorted(tuple(r) for r in spark.read.parquet(out).select(*COLUMNS).collect())


def test_pairs_equal_the_walk_over_restarts(spark, tmp_path):
    rows = some_rows(400, 1, 5)
    want = walked(rows, 5)
    events = sum(r[3] for r in rows)
    assert 20 < len(want) < events
    odd = [(None, 1, 1, False, "p", None), ("a", None, 2, True, None, "x"), ("a", 1, None, False, "p", None)]
    assert run(spark, [rows[:150], rows[150:160] + odd, rows[160:]], 5, tmp_path, several=True) == want


def test_cases_of_one_frame(spark, tmp_path):
    rows = [
        ("s", 7, 0, True, None, "early"), ("s", 7, 1, False, "one", None), ("s", 7, 2, True, None, "hit"), ("s", 7, 3, True, None, "hit"), ("t", 7, 3, True, None, "elsewhere"),
        ("s", 8, 4, False, "two", None), ("s", 7, 5, False, "new", None), ("s", 7, 6, True, None, "replaced"), ("s", 9, 7, False, "three", None), ("s", 7, 8, True, None, "pushed out"),
        ("s", 8, 9, True, None, "still there"), ("s", 10, 11, True, None, "same time"), ("s", 10, 11, False, "four", None), ("s", 8, 12, True, None, "gone too"),
    ]
    got = run(spark, [rows], 2, tmp_path)
    assert got == walked(rows, 2) and [r[5] for r in sorted(got, key=lambda r: r[2])] == ["hit", "hit", "replaced", "still there", "same time"]


def test_large_numbers_bytes_and_nulls_come_through(spark, tmp_path):
    schema = "sequence string, frame_index bigint, arrival bigint, is_event boolean, payload binary, detail bigint"
    big = 2**60 + 1
    rows = [("s", 1, 1, False, b"\xff\x00", None), ("s", 2, 2, False, None, None), ("s", 1, 3, True, None, big), ("s", 2, 4, True, None, None), ("s", 2, 5, True, None, -big)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    both = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    out = replay.drain(pairing.pairs(both.where("not is_event"), both.where("is_event"), "payload", "detail"), "binary-pairs")
    assert sorted((r.arrival, r.payload and bytes(r.payload), r.detail) for r in out.collect()) == [(3, b"\xff\x00", big), (4, None, None), (5, None, -big)]


def test_tables_replayed_in_order(spark):
    rows = spark.createDataFrame(pd.DataFrame({"arrival": range(100)}))
    stream = replay.in_order(rows, "arrival", 3, "ordered")
    assert stream.isStreaming and sorted(r.arrival for r in replay.drain(stream, "ordered-out").collect()) == list(range(100))
