import numpy as np
import pytest
from pyspark.sql import functions as F

from framelake.functions import geometry as G
from framelake.operators import frames as R
from framelake.operators import tracks as T


def test_label_faults(spark):
    lines = ["0 0.5 0.5 0.1 0.1", "  ", "1 0.5 0.5 0.1", "1.0 0.5 0.5 0.1 0.1", "1 x 0.5 0.1 0.1", "3 0.5 0.5 0.1 0.1", "3 1.5 0.5 0.1 0.1", "2\t0.5 0.5 0 0.1", "2 nan 0.5 0.1 0.1"]
    got = [r.fault for r in T.label_faults(spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string")).orderBy("i").collect()]
    assert got == [None, "fields", "numeric", "numeric", "class", "class, range", "size", "range"]


def test_decode_best_takes_first_class_caps_and_suppresses(spark):
    rows = [(1, 0, 10.0, 10.0, 8.0, 8.0, [0.9, 0.9]), (1, 1, 10.0, 10.0, 8.0, 8.0, [0.8, 0.1]), (1, 2, 10.0, 10.0, 8.0, 8.0, [0.1, 0.7]), (1, 3, 50.0, 50.0, 8.0, 8.0, [0.2, 0.2]), (1, 4, 90.0, 90.0, 8.0, 8.0, [0.6, 0.1])]
    raw = spark.createDataFrame(rows, "f int, anchor int, xc double, yc double, w double, h double, scores array<double>")
    assert [r.anchor for r in T.decode_best(raw, 0.25, 0.45, ["f"]).orderBy("anchor").collect()] == [0, 2, 4]
    assert [r.anchor for r in T.decode_best(raw, 0.25, 0.45, ["f"], top=2).orderBy("anchor").collect()] == [0, 2]
    assert [r.anchor for r in T.decode_best(raw, 0.25, 0.45, ["f"], most=2).orderBy("anchor").collect()] == [0]  # anchor 2 never meets suppression
    assert T.decode_best(raw.limit(0), 0.25, 0.45, ["f"]).count() == 0


def test_dhash_of_solid_and_rising_frames(spark):
    rising = [float(10 * (i % 8)) for i in range(64)]
    rows = spark.createDataFrame([(0, [7.0] * 64), (1, rising)], "i int, px array<double>")
    got = [r.dhash for r in R.dhash_text(rows).orderBy("i").collect()]
    assert got == ["0" * 16, "f" * 16]


def test_shift(spark):
    rng = np.random.default_rng(3)
    px = [float(x) for x in rng.integers(0, 256, 64)]
    rows = spark.createDataFrame([(px,)], "px array<double>")
    assert np.allclose(R.shifted(rows, "brightness", 2.0).first().px, np.minimum(255, 2 * np.array(px)))
    reach, k = 6, np.exp(-np.arange(-6, 7) ** 2 / 8.0)
    wide = np.pad(np.array(px).reshape(8, 8), reach, mode="edge")
    plain = sum(k[a] * k[b] * wide[a : a + 8, b : b + 8] for a in range(13) for b in range(13)) / k.sum() ** 2
    assert np.allclose(R.shifted(rows, "defocus", 2.0).first().px, plain.ravel())
    for bad in (("brightness", 0.0), ("defocus", -1.0)):
        with pytest.raises(ValueError, match="positive"):
            R.shifted(rows, *bad)


def test_find_or_create_appends_behind_the_stored(spark):
    stored = spark.createDataFrame([("a", 5)], "h string, version long")
    wanted = spark.createDataFrame([("b", 9), ("a", 1), ("c", 2), ("b", 3), (None, 0)], "h string, o int")
    got = {(r.h, r.version, r.created) for r in T.find_or_create(stored, wanted, "h", "o").collect()}
    assert got == {("a", 5, False), ("c", 6, True), ("b", 7, True)}
    again = T.find_or_create(spark.createDataFrame([(h, v) for h, v, _ in got], "h string, version long"), wanted, "h", "o")
    assert again.where("created").count() == 0
    assert {r.version for r in T.find_or_create(stored.limit(0), wanted, "h", "o").collect()} == {1, 2, 3}


def test_window_health_keeps_absent_classes(spark):
    events = spark.createDataFrame([(0, 0), (0, 1), (1, 2), (2, 3)], "window_id int, event int")
    boxes = spark.createDataFrame([(1, "a", 0.5), (1, "b", 0.7), (3, "b", 0.9)], "event int, cls string, conf double")
    got = {(r.window_id, r.cls): (r.n_events, r.boxes_per_event, r.mean_conf, r.share) for r in R.window_health(events, boxes).collect()}
    assert got[(1, "a")] == got[(1, "b")] == (1, 0.0, 0.0, 0.0)
    assert got[(2, "a")][3] == 0.0
    assert got[(2, "b")][3] == 1.0
    assert got[(0, "a")][:2] == (2, 1.0)
    assert {r.cls for r in R.window_health(events, boxes.limit(0)).collect()} == {None}


def test_named_and_prompt_categories(spark):
    row = spark.range(1).select(G.named_class(F.lit("van")).alias("a"), G.named_class(F.lit("dog")).alias("b"), G.raw_category(F.lit(None).cast("int"), F.lit(2)).alias("c"), G.raw_category(F.lit(9), F.lit(1)).alias("d")).first()
    assert tuple(row) == (1, -1, 3, 9)


def test_tag_slugs(spark):
    tags = ["optimize.trt_fp16_640", "optimize.trt_fp16_640_fingerprint", "gate.passed", "optimize.fp16_640", None]
    rows = spark.createDataFrame(list(enumerate(tags)), "i int, t string").orderBy("i")
    assert [r.s for r in rows.select("i", T.tag_slug(F.col("t")).alias("s")).orderBy("i").collect()] == ["trt-fp16-640", None, None, None, None]
