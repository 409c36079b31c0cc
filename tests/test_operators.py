import random
from collections import Counter

import pytest

from framelake.operators import boxes as B
from framelake.operators import frames as R
from framelake.operators import order as O


def test_lines_are_read_or_dropped_as_a_plain_reader_does(spark):
    rng = random.Random(11)
    lines = []
    for _ in range(300):
        fields = [str(rng.randrange(1, 30)), "7", *(str(rng.randrange(-5, 40)) for _ in range(4)), rng.choice("011"), str(rng.randrange(0, 12)), "0", "0"]
        if rng.random() < 0.15:
            fields[rng.randrange(8)] = rng.choice(["", "q", "2.5"])
        lines.append(",".join(fields[: rng.choice([10, 10, 10, 3])]))
    out = B.parse_annotations(spark.createDataFrame([(x,) for x in lines], "line string"), 32, 24).collect()

    def whole(x):
        return x.removeprefix("-").isdigit()

    scored = [x.split(",") for x in lines]
    scored = [f for f in scored if len(f) >= 8 and all(whole(x) for x in f[:8]) and f[6] == "1"]
    assert 0 < len(out) <= len(scored)
    frames = Counter(int(f[0]) for f in scored)
    for r in out:
        assert frames[r.frame_index] and 0 <= r.xc - r.w / 2 and r.xc + r.w / 2 <= 1 + 1e-12 and 0 <= r.yc - r.h / 2 and r.yc + r.h / 2 <= 1 + 1e-12 and r.w > 0 and r.h > 0


def test_label_text_holds_each_box_with_six_places(spark):
    rng = random.Random(12)
    rows = [(f"f{k % 4}", k, rng.randrange(10), *(rng.random() for _ in range(4))) for k in range(40)]
    rng.shuffle(rows)
    texts = B.labels_text(spark.createDataFrame(rows, "frame string, line_no int, cls int, xc double, yc double, w double, h double"), ["frame"], "line_no").collect()
    for r in texts:
        mine = sorted((k, c, *box) for f, k, c, *box in rows if f == r.frame)
        assert r.text == "".join(f"{c} " + " ".join(f"{v:.6f}" for v in box) + "\n" for _, c, *box in mine)
    lines = spark.createDataFrame([(x,) for r in texts for x in [*r.text.splitlines(), "0 1", "? 0 0 0 0"]], "line string")
    assert B.read_labels(lines).count() == len(rows)


def test_ignored_share_equals_a_count_of_pixels(spark):
    rng = random.Random(13)
    boxes = [(f"f{k}", rng.randrange(1, 10), rng.randrange(1, 10), rng.randrange(2, 9), rng.randrange(2, 9)) for k in range(40)]
    regions = [(f"f{k}", rng.randrange(1, 14), rng.randrange(1, 14), rng.randrange(1, 9), rng.randrange(1, 9)) for k in range(40) for _ in range(rng.randrange(4))]
    got = {r.f for r in B.not_ignored(spark.createDataFrame(boxes, "f string, x long, y long, w long, h long"), spark.createDataFrame(regions, "f string, rx long, ry long, rw long, rh long"), ["f"], 100, 100).collect()}
    cells = lambda x, y, w, h: {(i, j) for i in range(x, x + w) for j in range(y, y + h)}
    covered = {f: set().union(*(cells(x - 1, y - 1, w + 1, h + 1) for g, x, y, w, h in regions if g == f)) for f, *_ in boxes}  # regions begin a pixel earlier
    share = {f: len(cells(*b) & covered[f]) / len(cells(*b)) for f, *b in boxes}
    assert {f for f, s in share.items() if s < 0.5} <= got and not {f for f, s in share.items() if s > 0.5} & got and len(got) < 40


def test_reference_rejects_margin(spark):
    with pytest.raises(ValueError):
        R.reference(spark.createDataFrame([(1.0, 1.0, 1.0)], "brightness double, contrast double, blur double"), 0)


def test_global_rank_with_ties_and_empty(spark):
    rows = spark.createDataFrame([(i // 3, i) for i in range(100)], "a long, b long")
    assert [(r.b, r["rank"]) for r in O.global_rank(rows, ["a", "b"]).orderBy("b").collect()] == [(i, i + 1) for i in range(100)]
    assert O.global_rank(rows.where("a < 0"), ["a", "b"]).count() == 0


def test_running_max_over_ranges(spark):
    rows = [(i, (i * 37) % 101 if i % 7 else None) for i in range(200)]
    out = O.running_max(spark.createDataFrame(rows, "a long, v long"), ["a"], "v", "top").orderBy("a").collect()
    want, top = [], None
    for _, v in rows:
        top = v if top is None else top if v is None else max(top, v)
        want.append(top)
    assert [r.top for r in out] == want


def test_damage_drop_until_next_key(spark):
    rows = [(0, 0, 1, True, False), (1, 1, 1, False, True), (2, 2, 1, False, False), (3, 3, 1, True, False), (4, 9, 1, False, False), (5, 10, 1, False, False), (6, 11, 1, True, False)]
    df = spark.createDataFrame([("s", *r) for r in rows], "k string, i int, pts int, duration int, is_key boolean, corrupt boolean")
    assert sorted(r.i for r in O.damage_drop(df, "k", "i").collect()) == [0, 3, 6]
