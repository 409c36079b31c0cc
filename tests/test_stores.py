"""Documents, stores of clips and runs, and faults of datasets, on small tables with their odd cases."""

import json
from pathlib import Path

import pytest

from framelake.operators import order as O
from framelake.operators import tracks as T
from framelake.sources import exports as X
from framelake.sources import files as S
from framelake.sources import tracking as K

NAMES = {0: "person", 1: 'a "class"', 2: ",{"}
BOX = "file_name string, line_no int, cls int, xc double, yc double, w double, h double"


def document(spark, path, sizes, boxes):
    frames = spark.createDataFrame(sizes, "file_name string, width int, height int")
    X.write_document(S.coco_tables(frames, spark.createDataFrame(boxes, BOX), NAMES), path)
    return "\n".join(p.read_text() for p in sorted(Path(path).glob("part-*")))


def test_pieces_of_a_document_are_one(spark, tmp_path):
    sizes = [(f'f{k} "bbox":[1], é', 100, 50) for k in range(40)]
    boxes = [(sizes[k % 7][0], k, k % 3, 0.5, 0.5, (1 + k) / 100, 0.1) for k in range(60)]
    text = document(spark, str(tmp_path / "d"), sizes, boxes)
    doc = json.loads(text)
    assert [i["id"] for i in doc["images"]] == list(range(1, 41)) and [a["id"] for a in doc["annotations"]] == list(range(1, 61))
    assert [i["file_name"] for i in doc["images"]] == sorted(s[0] for s in sizes)
    assert [c["name"] for c in doc["categories"]] == list(NAMES.values())
    one = doc["annotations"][0]
    assert (one["image_id"], one["category_id"], one["iscrowd"]) == (1, 1, 0) and one["bbox"] == pytest.approx([49.5, 22.5, 1, 5]) and one["area"] == pytest.approx(5)
    (tmp_path / "one.json").write_text(json.dumps(doc, indent=1))
    for whole, path in ((True, "d"), (False, "one.json")):
        for name, rows in zip(X.LISTS, X.read_document(spark, str(tmp_path / path), whole), strict=True):
            assert sorted((r.asDict() for r in rows.collect()), key=lambda r: r["id"]) == doc[name]


def test_a_document_without_images_or_boxes(spark, tmp_path):
    assert json.loads(document(spark, str(tmp_path / "a"), [], []))["images"] == []
    doc = json.loads(document(spark, str(tmp_path / "b"), [("x", 4, 4)], []))
    assert len(doc["images"]) == 1 and doc["annotations"] == [] and len(doc["categories"]) == 3


def test_clips_hold_the_bytes_of_their_files(spark, tmp_path):
    kept = {}
    for seq, n in (("a", 6), ("b=1", 2)):
        (tmp_path / "in" / seq).mkdir(parents=True)
        for k in range(n):
            kept[seq, k] = bytes([k, 0, 255, 10, 13]) * k
            (tmp_path / "in" / seq / f"{k:07d}.jpg").write_bytes(kept[seq, k])
    (tmp_path / "in" / "a" / "notes.jpg").write_bytes(b"x")
    boxes = spark.createDataFrame([("a", 1, 2), ("a", 1, 1), ("a", 5, 1), ("z", 1, 1)], "sequence string, frame_index long, line_no int")
    listing = X.listed_pictures(spark, str(tmp_path / "in"))
    counts, warnings = X.write_clips(listing, boxes, 1, 4, str(tmp_path / "out"))
    rows = {(r.sequence, r.frame_index): (bytes(r.content), r.boxes and [b.line_no for b in r.boxes]) for r in X.read_clips(spark, str(tmp_path / "out")).collect()}
    assert rows == {(s, k): (v, [1, 2] if (s, k) == ("a", 1) else None) for (s, k), v in kept.items() if 1 <= k < 5}
    assert counts == {"kept": 5, "copied": 5} and warnings == []
    from pyspark.sql import functions as F

    lost = listing.withColumn("content", F.when(F.col("frame_index") != 2, F.col("content")))
    counts, warnings = X.write_clips(lost, boxes, 1, None, str(tmp_path / "lost"))
    assert counts == {"kept": 6, "copied": 5} and warnings == ["6 kept, but 5 copied"]
    assert spark.read.parquet(str(tmp_path / "lost/frames")).count() == 5


def test_a_store_of_runs_takes_the_last_of_what_is_set_again(spark, tmp_path):
    path = str(tmp_path / "s")
    rows = lambda name, *r: {name: spark.createDataFrame(list(r), K.TABLES[name])}
    assert K.described(spark, path).count() == 0 and K.resolved(spark, path, "champion").count() == 0
    K.append(spark, path, **rows("runs", (1, "a", "FINISHED"), (2, "a", "RUNNING")), **rows("metrics", (1, "m", 0, 0.5), (1, "m", 2, 0.25), (1, "m", 1, 0.9), (1, None, 3, 0.1)))
    K.append(spark, path, **rows("tags", (1, "gate", 1, "False"), (1, "other", 1, None)), **rows("versions", ("net", 1, 1), ("net", 2, 2), ("old", 1, 9)), **rows("version_tags", ("net", 2, "k", 0, "v")))
    K.append(spark, path, **rows("tags", (1, "gate", 5, "True")), **rows("aliases", ("net", "champion", 1, 1), ("net", "champion", 3, 2), ("net", "other", 4, 1), ("old", "champion", 1, 7)))
    runs = {r.run_id: r for r in K.described(spark, path).collect()}
    assert (runs[1].metrics, runs[1].tags, runs[1].params) == ({"m": 0.25}, {"gate": "True", "other": None}, {}) and (runs[2].metrics, runs[2].tags) == ({}, {})
    named = {r.model: (r.version, r.run_id, r.tags) for r in K.resolved(spark, path, "champion").collect()}
    assert named == {"net": (2, 2, {"k": "v"}), "old": (7, None, {})}


def test_all_faults_of_a_dataset(spark):
    names = lambda *r: spark.createDataFrame([("train", n) for n in r], "split string, name string")
    lines = lambda *r: spark.createDataFrame([("train", x) for x in r], "split string, line string")
    got = T.dataset_faults(names("a", "b"), names("b", "c", "d"), lines("0 .5 .5 .1 .1", "", "1 2 .5 .1 .1", "7 .5 .5 .1 .1", "1 .5", "2 x .5 .1 .1"))
    assert {(r.split, r.fault): r.n for r in got.collect()} == {
        ("train", "range"): 1, ("train", "class"): 1, ("train", "fields"): 1, ("train", "numeric"): 1, ("train", "no label"): 1, ("train", "no image"): 2,
        ("val", "no images"): 1, ("test", "no images"): 1, (None, "class 2 has no box"): 1}
    assert T.dataset_faults(names("a"), names("a"), lines("0 .5 .5 .1 .1"), ["train"], [0]).count() == 0
    none = T.dataset_faults(names("a").where("false"), names("a").where("false"), lines("").where("false"))
    assert none.count() == 6


def test_the_last_of_a_key_whatever_is_null(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 3, None), ("a", 2, "y"), ("b", None, "z"), (None, 1, "n")], "k string, t int, v string")
    assert sorted(map(str, map(tuple, O.latest(rows, ["k"], "t").collect()))) == ["('a', 3, None)", "('b', None, 'z')", "(None, 1, 'n')"]
    assert O.latest(rows.where("false"), ["k"], "t").count() == 0
