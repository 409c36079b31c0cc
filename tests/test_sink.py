"""Batches that are run again, streams that stop and go on, and counts that add up over batches."""

from framelake.operators import frames as R
from framelake.streaming import sink

FRAMES = "sequence string, reading double, ts_ms long"


def test_a_batch_run_again_adds_no_row(spark, tmp_path):
    rows = [("a", 1.0, 1000), ("a", None, 2000), ("b", None, 3000), (None, 2.0, 500)]
    one, two = spark.createDataFrame(rows, FRAMES), spark.createDataFrame([("a", 5.0, 9000), ("a", 5.0, 9000)], FRAMES)
    write = sink.batch_writer(str(tmp_path), lambda batch: R.frame_counts(batch, "reading", "ts_ms"))
    for batch, number in ((one, 0), (two, 1), (two, 1), (one, 0)):
        write(batch, number)
    kept = sink.read_batches(spark, str(tmp_path), R.FRAME_COUNTS)
    assert sorted((r.batch_id, str(r.sequence), r.n_frames, r.n_skipped, r.last_ms) for r in kept.collect()) == [(0, "None", 1, 0, 500), (0, "a", 2, 1, 1000), (0, "b", 1, 1, None), (1, "a", 2, 0, 9000)]
    now = spark.createDataFrame([(10_000,)], "now long")
    got = {r.sequence: tuple(r)[1:] for r in R.monitor_ages(kept, now).collect()}
    assert got == {"a": (4, 1, 0.25, 1.0), "b": (1, 1, 1.0, None), None: (1, 0, 0.0, 9.5)}


def test_a_stream_goes_on_and_an_empty_one_gives_nothing(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([], FRAMES).write.parquet(source)
    make = lambda batch: R.frame_counts(batch, "reading", "ts_ms")
    stream = lambda: spark.readStream.schema(FRAMES).option("maxFilesPerTrigger", 1).parquet(source)
    assert sink.drain_batches(stream().where("false"), make, R.FRAME_COUNTS, "none").count() == 0
    out = str(tmp_path / "out")
    for k in range(3):
        spark.createDataFrame([("a", float(k), 1000 * k)], FRAMES).coalesce(1).write.mode("append").parquet(source)
        job = stream().writeStream.foreachBatch(sink.batch_writer(out, make)).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        job.awaitTermination()
    kept = sink.read_batches(spark, out, R.FRAME_COUNTS)
    assert kept.groupBy().sum("n_frames").first()[0] == 3


def test_episodes_without_a_record(spark):
    opened = spark.createDataFrame([(1,), (4,), (9,)], "window_id long")
    records = spark.createDataFrame([(4, "x"), (4, "y")], "window_id long, place string")
    assert sorted(r.window_id for r in R.unrecorded(opened, records).collect()) == [1, 9]
