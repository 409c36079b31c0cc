import math
import struct

import numpy as np
import pytest

from framelake.operators import clips as C
from framelake.operators import frames as R
from framelake.operators import order as O
from framelake.operators import tracks as T
from framelake.sources import files as S
from framelake.sources import messages as M


def bmp(pixels):
    """A 24-bit bitmap of grey rows."""
    h, w = len(pixels), len(pixels[0])
    body = b"".join(bytes(v for x in row for v in (x, x, x)) + bytes(-3 * w % 4) for row in reversed(pixels))
    return struct.pack("<2sIHHI", b"BM", 54 + len(body), 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, len(body), 0, 0, 0, 0) + body


def test_annotation_files_and_sequences(spark, tmp_path):
    for name, lines in (("clipA", "1,0,9,9,5,5,1,4,0,0\n2,7,1,1,3,3,1,2,0,0\n"), ("clipB", "1,3,2,2,4,4,0,6,0,0\n\n")):
        (tmp_path / f"{name}.txt").write_text(lines)
    rows = S.annotation_lines(spark, str(tmp_path))
    assert sorted((r.sequence, r.line[:4]) for r in rows.collect()) == [("clipA", "1,0,"), ("clipA", "2,7,"), ("clipB", "1,3,")]
    assert S.sequences(rows, "x") == ["clipA", "clipB"] and S.sequences(rows, "x", ["clipB"]) == ["clipB"]
    with pytest.raises(ValueError, match="unknown"):
        S.sequences(rows, "x", ["clipC"])
    with pytest.raises(ValueError, match="no annotation file matches x"):
        S.sequences(rows.where("false"), "x")
    strict = S.strict_annotations(spark, str(tmp_path)).collect()
    assert len(strict) == 3 and {r.sequence for r in strict} == {"clipA", "clipB"}
    (tmp_path / "clipC.txt").write_text("1,x,2,2,4,4,0,6,0,0\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ|CANNOT"):
        S.strict_annotations(spark, str(tmp_path)).collect()


def test_frames_and_images(spark, tmp_path):
    for i in (1, 12, 300):
        (tmp_path / f"{i:07d}.jpg").write_bytes(bmp([[10 * (i % 9), 0], [0, 0]]))
    (tmp_path / "notes.jpg").write_bytes(b"none")
    (tmp_path / "0000004.png").write_bytes(b"none")
    assert sorted(r.frame_index for r in S.frames(spark, str(tmp_path)).collect()) == [1, 12, 300]
    good, bad = S.images(spark, str(tmp_path))
    assert sorted((r.path[-11:], r.height, r.width) for r in good.collect()) == [(f"{i:07d}.jpg", 2, 2) for i in (1, 12, 300)]
    assert sorted(r.path[-9:] for r in bad.collect()) == ["00004.png", "notes.jpg"]


def test_headed_files(spark, tmp_path):
    rows = spark.createDataFrame([("a,\"b\"", 2, 0.1, 1 / 3, 2.0)], "sequence string, n_frames long, brightness double, contrast double, blur double")
    S.write_baseline(rows, f"{tmp_path}/b")
    assert S.read_baseline(spark, f"{tmp_path}/b").collect() == rows.collect()
    S.write_csv(rows, ["sequence", "blur"], f"{tmp_path}/c")
    for read in (S.read_baseline, S.read_manifest):
        with pytest.raises(ValueError, match="unexpected header"):
            read(spark, f"{tmp_path}/c")


def test_stored_pass_tells_empty_from_absent(spark, tmp_path):
    every = spark.createDataFrame([("a", 1), ("a", 2)], "sequence string, frame_index long")
    boxes = spark.createDataFrame([("a", 1, 0.5)], "sequence string, frame_index long, conf double")
    config = {"model": "m", "conf": 0.2}
    assert S.pass_key("s", config) == S.pass_key("s", config | {"merge": 3, "imgsz": None}) != S.pass_key("s", config | {"conf": 0.3})
    S.save_detections(every, boxes, "k", str(tmp_path), ["sequence", "frame_index"])
    assert S.load_detections(every, "k", str(tmp_path), ["sequence", "frame_index"]).count() == 1
    with pytest.raises(ValueError, match="lacks frames"):
        S.load_detections(every.withColumn("frame_index", every.frame_index + 1), "k", str(tmp_path), ["sequence", "frame_index"])


def test_coco_names_must_be_unique(spark):
    sizes = spark.createDataFrame([("a", 10, 10), ("a", 10, 10)], "file_name string, width int, height int")
    boxes = spark.createDataFrame([], "file_name string, line_no int, cls int, xc double, yc double, w double, h double")
    with pytest.raises(ValueError, match="repeats"):
        S.coco_tables(sizes, boxes, {0: "x"})


def test_messages_that_are_not_ok_stay(spark):
    headers = "array<struct<key string, value binary>>"
    rows = [(b"s", [("frame_index", b"3"), ("ts_ms", b"9"), ("more", None)], b"x"), (b"", [("frame_index", b"3"), ("ts_ms", b"9")], b"x"), (None, [("frame_index", b"3"), ("ts_ms", b"9")], b"x"),
            (b"s", [("frame_index", None), ("ts_ms", b"9")], b"x"), (b"s", [("ts_ms", b"9")], b"x"), (b"s", None, b"x"), (b"s", [("frame_index", b"3"), ("ts_ms", b"9")], None)]
    out = M.parse_frames(spark.createDataFrame(rows, f"key binary, headers {headers}, value binary")).collect()
    assert [r.ok for r in out] == [True] + [False] * 6 and out[0].frame_index == 3 and out[0].ts_ms == 9
    event = '{"sequence":"s","frame_index":1,"ts_frame_ms":2,"ts_infer_ms":3,"latency_ms":1.5,"model":{"name":"m","version":"1"},"boxes":%s,"x":1}'
    box = '[{"cls":"a","conf":0.5,"xywhn":[1,2,3,4]}]'
    texts = [event % box, event % "[]", event % '[{"cls":"a","conf":0.5,"xywhn":[1,2]}]', (event % box).replace('"version":"1"', '"v":1'), "no", None, (event % box).replace("1.5", '"x"')]
    got = M.parse_events(spark.createDataFrame([(t,) for t in texts], "value string")).collect()
    assert [r.ok for r in got] == [True, True, False, False, False, False, False] and got[0].schema_version == 1
    alert = spark.createDataFrame([("s", 1, "count", "a", 5.0, 3.0, 4.5, 7, 9, 11)], M.ALERT)
    sent = alert.select(M.to_value(alert, M.ALERT).alias("value"))
    assert [tuple(r)[2:] for r in M.parse_alerts(sent).collect()] == [tuple(r) for r in alert.collect()]


def test_tracks_of_clips(spark):
    rows = [("a", f, 0, 0.9, 10.0 + f, 0.0, 30.0 + f, 20.0) for f in range(1, 8)] + [("a", f, 0, 0.5, 100.0, 0.0, 120.0, 20.0) for f in (3, 4)] + [("b", 5, 1, 0.4, 0.0, 0.0, 5.0, 5.0)]
    df = spark.createDataFrame(rows, "sequence string, frame_index long, cls int, conf double, x1 double, y1 double, x2 double, y2 double")
    got = sorted((r.sequence, r.frame_index, r.track) for r in C.key_tracks(df, ["sequence"], every=2).collect())
    assert got == [("a", 1, 1), ("a", 3, 1), ("a", 3, 2), ("a", 5, 1), ("a", 7, 1), ("b", 5, 1)]


def test_six_digits_equal_the_printf_rule(spark):
    values = [0.0, 1.0, 0.5, 0.123456789, 1e-4, 9.9999e-5, 1.5e-7, 123456.0, 1234567.0, 999999.5, 0.1 + 0.2, 1 / 3, 2e10, 12.0, 100.0, 3e-300]
    out = spark.createDataFrame([(v,) for v in values], "v double").select(T.six_digits(O.F.col("v")).alias("t")).collect()
    assert [r.t for r in out] == [f"{v:.6g}" for v in values]


def test_percentiles_equal_linear_interpolation(spark):
    rng = np.random.default_rng(2)
    rows = [(k, float(v)) for k, n in (("a", 1), ("b", 2), ("c", 777), (None, 30)) for v in rng.integers(0, 50, n)] + [("c", None)]
    out = O.percentiles(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", {"p50": 0.5, "p99": 0.99})
    for r in out.collect():
        v = [x for k, x in rows if k == r.k and x is not None]
        assert r.n == len(v) and math.isclose(r.mean, np.mean(v)) and math.isclose(r.p50, np.percentile(v, 50)) and math.isclose(r.p99, np.percentile(v, 99))
    assert out.count() == 4 and O.percentiles(spark.createDataFrame([], "k string, v double"), ["k"], "v", {"p50": 0.5}).count() == 0


def test_few_frames_are_all_kept(spark):
    rows = spark.createDataFrame([(f, s, float(f)) for f in (1, 2, 3) for s in "xy"], "frame long, stage string, ms double")
    assert {r.stage: r.n for r in R.latency(rows).collect()} == {"x": 3, "y": 3, "total": 3}
    assert {r.stage: r.n for r in R.latency(rows.unionByName(rows.withColumn("frame", rows.frame + 3))).collect()} == {"x": 3, "y": 3, "total": 3}


def test_steps_go_on_after_the_highest(spark):
    records = spark.createDataFrame([("a",), ("b",)], "k string")
    history = spark.createDataFrame([("a", 0), ("a", 7), ("z", 3)], "k string, step int")
    assert sorted(tuple(r) for r in O.next_step(records, history, "k").collect()) == [("a", 8), ("b", 0)]
