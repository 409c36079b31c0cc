"""Readings of pictures against loops over single pixels; numbered lines of files that are read in blocks."""

import numpy as np

from framelake.operators import pixels
from framelake.sources import files

PICTURE = "path string, height int, width int, channels int, data binary"


def plain(g):
    """Mean, deviation and variance of the filtered picture, pixel by pixel; ``g`` is a list of rows."""
    h, w = len(g), len(g[0])
    e = [[g[y][x] if y in (0, h - 1) or x in (0, w - 1) else min(255, max(0, 8 * g[y][x] - sum(g[y + j][x + i] for j in (-1, 0, 1) for i in (-1, 0, 1) if i or j))) for x in range(w)] for y in range(h)]
    flat, filtered = [v for r in g for v in r], [v for r in e for v in r]
    var = lambda v: sum(x * x for x in v) / len(v) - (sum(v) / len(v)) ** 2
    return sum(flat) / len(flat), max(0, var(flat)) ** 0.5, var(filtered)


def test_readings_of_decoded_files(spark, tmp_path):
    r = np.random.default_rng(4)
    shapes = {"color": (9, 14, 3), "flat": (5, 5, 3), "thin": (1, 6, 3), "pair": (2, 2, 3), "grey": (7, 6)}
    made = {n: r.integers(0, 256, s) if n != "flat" else np.full(s, 77) for n, s in shapes.items()}
    for name, px in made.items():
        (tmp_path / f"{name}.png").write_bytes(pixels.png(px))
    whole = pixels.png(made["color"])
    (tmp_path / "cut.png").write_bytes(whole[:40])
    (tmp_path / "none.png").write_bytes(b"none")
    (tmp_path / "lf.png").write_bytes(whole + b"\n")
    got = {row.path.rsplit("/", 1)[1][:-4]: row for row in pixels.readings(files.pictures(spark, str(tmp_path))).collect()}
    assert len(got) == 8
    for name, px in [*made.items(), ("lf", made["color"])]:
        px = px.astype(int)
        g = px if px.ndim == 2 else (19595 * px[..., 0] + 38470 * px[..., 1] + 7471 * px[..., 2] + 32768) // 65536
        row = got[name]
        assert (row.height, row.width) == px.shape[:2]
        np.testing.assert_allclose((row.brightness, row.contrast, row.blur), plain(g.tolist()), atol=1e-6)
    for name in ("cut", "none"):
        assert tuple(got[name])[1:] == (None,) * 5


def test_odd_rows_have_no_readings(spark):
    rows = [("a", 2, 2, 1, b"\x01\x02\x03"), ("b", 2, 2, 2, b"12345678"), ("c", None, 2, 1, b"12"), ("d", 0, 0, 3, b""), ("e", 1, 1, 4, b"\x0a\x14\x1e\xff"), ("e", 1, 1, 4, b"\x0a\x14\x1e\xff")]
    out = pixels.readings(spark.createDataFrame(rows, PICTURE)).orderBy("path").collect()
    grey = (19595 * 30 + 38470 * 20 + 7471 * 10 + 32768) // 65536  # bytes are blue, green, red, opacity
    assert [r.brightness for r in out] == [None] * 4 + [grey] * 2 and [r.width for r in out] == [None] * 4 + [1] * 2
    assert pixels.readings(spark.createDataFrame([], PICTURE)).count() == 0
    clash = spark.createDataFrame(rows[4:5], PICTURE).selectExpr("*", "1 as blur", "'x' as sequence")
    assert pixels.readings(clash).columns == ["path", "sequence", "width", "height", "brightness", "contrast", "blur"]


def test_size_of_a_sequence(spark):
    rows = [("a", 2, 10, 20), ("a", 1, None, None), ("a", 5, 7, 7), ("b", 1, None, None)]
    got = pixels.sequence_sizes(spark.createDataFrame(rows, "sequence string, frame_index long, width int, height int"))
    assert sorted(tuple(r) for r in got.collect()) == [("a", 10, 20), ("b", None, None)]


def test_line_numbers_go_on_across_blocks(spark, tmp_path):
    texts = {"clipA": [f"{i},{'x' * (i % 50)}" if i % 9 else "  " for i in range(1, 4000)], "clipB": ["only"], "clipC": ["", "", "third"]}
    for name, body in texts.items():
        (tmp_path / f"{name}.txt").write_text("\n".join(body) + "\n")
    for part, body in (("a", ["1", "2"]), ("b", ["3"])):
        (tmp_path / "sequence=clip D").mkdir(exist_ok=True)
        (tmp_path / "sequence=clip D" / f"{part}.txt").write_text("\n".join(body))
    (tmp_path / "empty.txt").write_text("")
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = sorted(tuple(r) for r in files.numbered_lines(spark, str(tmp_path)).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)
    want = [(n, i, line) for n, body in texts.items() for i, line in enumerate(body, 1) if line.strip()] + [("clip D", i, str(i)) for i in (1, 2, 3)]
    assert got == sorted(want)


def test_names_with_signs_come_back(spark, tmp_path):
    names = ["a/b", "a b+c", "50%", "x=y:z", "é", "%41"]
    rows = spark.createDataFrame([(n, 1, f"line of {n}") for n in names], "sequence string, line_no int, line string")
    files.write_lines(rows, "sequence", ["line_no"], str(tmp_path / "lines"))
    want = sorted((n, f"line of {n}") for n in names)
    assert sorted(tuple(r) for r in files.annotation_lines(spark, str(tmp_path / "lines")).collect()) == want
    assert sorted(tuple(r) for r in files.read_lines(spark, str(tmp_path / "lines"), "sequence").collect()) == want
    (tmp_path / "own name+1.txt").write_text("text")
    assert [tuple(r) for r in files.numbered_lines(spark, f"{tmp_path}/own name+1.txt").collect()] == [("own name+1", 1, "text")]
