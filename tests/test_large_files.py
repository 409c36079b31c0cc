"""Files of many frames and of large sequences: how many there are, and who writes them."""

import json
from glob import glob

import pytest

from framelake.plans import catalog
from framelake.plans import files as queries
from framelake.sources import files as S
from tests.helpers import SMALL, same


def test_labels_of_many_frames_are_few_files(spark, tmp_path):
    boxes = [("b", 2, 1, 0.5, 0.25, 0.1, 0.2), ("b", 1, 0, 0.125, 0.5, 0.3, 0.4), ("a\"=/%+", 1, 2, 1.0, 1.0, 1.0, 1.0)]
    frames = [("a\"=/%+",), ("b",), ("b",), *[(f"none {k}",) for k in range(300)]]
    path = str(tmp_path / "labels")
    S.write_labels(spark.createDataFrame(boxes, "stem string, line_no int, cls int, xc double, yc double, w double, h double"), spark.createDataFrame(frames, "stem string"), path)
    written = [json.loads(line) for f in glob(f"{path}/*.txt") for line in open(f)]
    want = {f: "" for f, in frames} | {"b": "0 0.125000 0.500000 0.300000 0.400000\n1 0.500000 0.250000 0.100000 0.200000\n", "a\"=/%+": "2 1.000000 1.000000 1.000000 1.000000\n"}
    assert len(written) == len(want) and {r["stem"]: r["text"] for r in written} == want
    assert {r.stem: r.text for r in S.label_texts(spark, path).collect()} == want
    assert len(glob(f"{path}/**", recursive=True)) < 20


def test_one_sequence_is_written_by_several_tasks_in_order(spark, tmp_path):
    rows = spark.range(5000).selectExpr("'s' as sequence", "5000 - id as line_no", "if(id % 9 = 0, '', cast(5000 - id as string)) as line")
    path = str(tmp_path / "lines")
    S.write_lines(rows, "sequence", ["line_no"], path)
    assert len(glob(f"{path}/sequence=s/*.txt")) > 1
    got = S.numbered_lines(spark, path).collect()
    assert len(got) == 5000 - 556 and all(r.line == str(r.line_no) for r in got)


def test_manifest_is_not_one_file_of_one_task(spark, monkeypatch):
    seen = []
    real = S.write_csv
    monkeypatch.setattr(S, "write_csv", lambda rows, fields, path, **more: (seen.append(path), real(rows.repartition(4), fields, path, **more)))
    same(queries.A5_manifest_A6_csv(spark, SMALL), catalog.ORACLES["A5_manifest_A6_csv"], SMALL)
    assert len(glob(f"{seen[0].removeprefix('file:')}/*.csv")) == 4


@pytest.mark.parametrize("name", ["A7_label_read_A8_label_write", "A1_numbered_lines", "A1_labels_in_file_order", "A1_annotation_scan", "A11_annotation_export"])
def test_queries_of_files_give_their_sql(spark, name):
    same(catalog.QUERIES[name](spark, SMALL), catalog.ORACLES[name], SMALL)
