import random

from framelake.operators import matching as M

SCHEMA = "f string, cls int, x1 double, y1 double, x2 double, y2 double, conf double"


def boxes(rng, n):
    return [("f%d" % rng.randrange(3), rng.randrange(2), x := float(rng.randrange(12)), y := float(rng.randrange(12)), x + rng.randrange(1, 9), y + rng.randrange(1, 9), rng.randrange(6) / 5) for _ in range(n)]


def inter(a, b):
    return max(0, min(a[4], b[4]) - max(a[2], b[2])) * max(0, min(a[5], b[5]) - max(a[3], b[3]))


def area(a):
    return (a[4] - a[2]) * (a[5] - a[3])


def iou(a, b):
    return inter(a, b) / (area(a) + area(b) - inter(a, b))


def walk(rows, order, drop):
    kept = []
    for b in sorted(rows, key=lambda b: (order(b), b[1:])):
        if not any(k[0] == b[0] and drop(k, b) for k in kept):
            kept.append(b)
    return sorted(kept)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("f", "cls", "x1", "y1", "x2", "y2", "conf").collect())


def test_suppression_and_nested_boxes_equal_a_plain_walk(spark):
    rows = boxes(random.Random(1), 120)
    df = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(M.suppress(df, ["f"], 0.3)) == walk(rows, lambda b: -b[6], lambda k, b: iou(k, b) > 0.3)
    nested = lambda k, b: inter(k, b) / (min(area(k), area(b)) + 1e-9) >= 0.7
    assert rows_of(M.drop_nested(df, ["f"], 0.7)) == walk(rows, lambda b: -area(b), nested)
    assert rows_of(M.drop_nested(df, ["f"], 0.7, False)) == walk(rows, area, nested)


def test_contained_box_gives_its_score(spark):
    rows = [("f", 0, 0.0, 0.0, 10.0, 10.0, 0.4, False), ("f", 0, 1.0, 1.0, 4.0, 4.0, 0.9, True), ("f", 1, 1.0, 1.0, 4.0, 4.0, 0.8, True), ("f", 0, 2.0, 2.0, 4.0, 4.0, 0.7, False)]
    out = M.merge_contained(spark.createDataFrame(rows, SCHEMA + ", cut boolean"), ["f"])
    assert sorted((r.cls, r.x1, r.conf) for r in out.collect()) == [(0, 0.0, 0.9), (0, 2.0, 0.7), (1, 1.0, 0.8)]


def test_matching_equals_a_plain_loop(spark):
    rng = random.Random(2)
    det, gt = boxes(rng, 80), boxes(rng, 60)
    want = []
    for key in {(d[0], d[1]) for d in det}:
        true = sorted([g for g in gt if g[:2] == key], key=lambda g: g[2:6])
        used = set()
        for d in sorted([d for d in det if d[:2] == key], key=lambda d: (-d[6], d[2:])):
            best = max(((iou(g, d), -i) for i, g in enumerate(true) if i not in used), default=(0.0, 0))
            if best[0] >= 0.3:
                used.add(-best[1])
            want.append((*d, round(best[0], 9), best[0] >= 0.3))
    out = M.match(spark.createDataFrame(det, SCHEMA), spark.createDataFrame(gt, SCHEMA).drop("conf"), ["f", "cls"], [0.3])
    got = [(r.f, r.cls, r.x1, r.y1, r.x2, r.y2, r.conf, round(r.iou, 9), r.hit) for r in out.collect()]
    assert sorted(got) == sorted(want)


def test_truth_fed_back_scores_one_and_nothing_scores_zero(spark):
    gt = spark.createDataFrame([("a", 0, 0.0, 0.0, 10.0, 10.0), ("a", 1, 20.0, 0.0, 30.0, 10.0)], "f string, cls int, x1 double, y1 double, x2 double, y2 double")
    det = gt.selectExpr("*", "0.5D as conf")
    full = M.average_precision(M.match(det, gt, ["f", "cls"], M.COCO_THRESHOLDS), gt).collect()
    assert [(r.map50, r.map, r.precision, r.floor_recall) for r in full] == [(1.0, 1.0, 1.0, 1.0)] * 2
    none = M.average_precision(M.match(det.where("false"), gt, ["f", "cls"]), gt).collect()
    assert [(r.map50, r.recall) for r in none] == [(0.0, 0.0)] * 2
