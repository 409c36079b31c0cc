import itertools
import math
import random
from collections import Counter, defaultdict

import numpy as np

from framelake.operators import scores as S
from framelake.plans import catalog
from framelake.sources.adapters import view
from tests.helpers import SMALL

SCHEMA = "sequence string, cls int, frame_index long, id long, x1 double, y1 double, x2 double, y2 double"


def best(pairs):
    """The one-to-one subset of {(row, column): gain} of greatest gain, by trying all."""
    left, right = sorted({a for a, _ in pairs}), sorted({b for _, b in pairs})
    right += [None] * len(left)
    chosen = max(itertools.permutations(right, len(left)), key=lambda p: sum(pairs.get(x, 0) for x in zip(left, p)))
    return [x for x in zip(left, chosen) if x in pairs]


def iou(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    both = w * h if w > 0 and h > 0 else 0
    return both / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - both)


def plain(gt, tracks):
    tp, ass, id_tp, switches = Counter(), Counter(), 0, 0
    for seq in {r[0] for r in gt}:
        frames = defaultdict(dict)
        for g in gt:
            for t in tracks:
                if g[:3] == t[:3] and g[0] == seq and (v := iou(g[4:], t[4:])) > 0:
                    frames[g[2]][g[3], t[3]] = v
        n_g, n_t = (Counter(r[3] for r in rows if r[0] == seq) for rows in (gt, tracks))
        m, near, last, held, before = Counter(), Counter(), {}, defaultdict(Counter), {}
        for pairs in frames.values():
            for (g, t), v in pairs.items():
                m[g, t] += v / (sum(x for k, x in pairs.items() if k[0] == g) + sum(x for k, x in pairs.items() if k[1] == t) - v)
                near[g, t] += v >= 0.5
        for f in sorted({r[2] for r in gt if r[0] == seq} & {r[2] for r in tracks if r[0] == seq}):
            pairs = frames[f]
            for g, t in best({(g, t): v * m[g, t] / (n_g[g] + n_t[t] - m[g, t]) for (g, t), v in pairs.items()}):
                for a in S.ALPHAS:
                    held[a][g, t] += pairs[g, t] >= a
            taken = best({k: v + 1000 * (before.get(k[0]) == k[1]) for k, v in pairs.items() if v >= 0.5})
            before = dict(taken)
            for g, t in taken:
                switches += last.get(g, t) != t
                last[g] = t
        for a, c in held.items():
            tp[a] += sum(c.values())
            ass[a] += sum(n * n / (n_g[g] + n_t[t] - n) for (g, t), n in c.items())
        id_tp += sum(near[k] for k in best({k: n for k, n in near.items() if n}))
    total = len(gt) + len(tracks)
    det = [tp[a] / (total - tp[a]) for a in S.ALPHAS]
    con = [ass[a] / tp[a] if tp[a] else 0 for a in S.ALPHAS]
    mean = lambda x: sum(x) / len(S.ALPHAS)
    return mean([math.sqrt(d * c) for d, c in zip(det, con)]), mean(det), mean(con), 2 * id_tp / total, switches


def test_assignment_is_the_best_of_all():
    rng = np.random.default_rng(3)
    for _ in range(60):
        gain = rng.random((rng.integers(1, 5), rng.integers(1, 5)))
        got = S.assign(gain)
        assert len({i for i, _ in got}) == len({j for _, j in got}) == min(gain.shape)
        small = gain if gain.shape[0] <= gain.shape[1] else gain.T
        top = max(sum(small[i, j] for i, j in enumerate(p)) for p in itertools.permutations(range(small.shape[1]), small.shape[0]))
        assert abs(sum(gain[i, j] for i, j in got) - top) < 1e-9
    assert S.assign(np.zeros((0, 3))) == []


def test_scores_equal_a_plain_loop(spark):
    rng = random.Random(5)
    gt, tracks = [], []
    for seq in "ab":
        for f in range(12):
            for i in range(3):
                x, y = 9 * i + rng.random() * 4, rng.random() * 4
                gt.append((seq, 0, f, i, x, y, x + 10, y + 10))
                if rng.random() < 0.8:
                    dx = rng.random() * 6
                    tracks.append((seq, 0, f, 10 * (f // 5) + (i + f // 7) % 3, x + dx, y, x + dx + 10, y + 10))
    row = S.tracking_scores(spark.createDataFrame(gt, SCHEMA), spark.createDataFrame(tracks, SCHEMA)).collect()
    assert len(row) == 1
    want = plain(gt, tracks)
    assert all(abs(a - b) < 1e-9 for a, b in zip(row[0][1:], want, strict=True)) and want[4] > 0


def test_truth_fed_back_scores_one_and_no_track_scores_zero(spark):
    gt = spark.createDataFrame([("a", c, f, i, 20.0 * i, 0.0, 20.0 * i + 9, 9.0) for c in (0, 1) for f in range(3) for i in range(2)], SCHEMA)
    same = S.tracking_scores(gt, gt).collect()
    assert len(same) == 2 and all(abs(v - 1) < 1e-9 for r in same for v in r[1:5]) and all(r.switches == 0 for r in same)
    assert [tuple(r)[1:] for r in S.tracking_scores(gt, gt.where("false")).collect()] == [(0, 0, 0, 0, 0)] * 2
    assert S.tracking_scores(gt.where("false"), gt).count() == 0


def test_query_over_the_tables(spark):
    rows = catalog.QUERIES["D22_tracking_scores"](spark, SMALL).collect()
    assert len(rows) == 3 and all(0 < r.hota < 1 for r in rows)


def test_a_pair_of_the_frame_before_is_kept(spark):
    """Two tracks over one true box: the one that held it stays, though the other is nearer, until a frame in which nothing meets."""
    box = lambda f, i, x: ("a", 0, f, i, x, 0.0, x + 10, 10.0)
    gt = [box(f, 1, 0.0) for f in range(6)]
    tracks = [box(0, 7, 2.0), box(1, 7, 2.0), box(1, 8, 1.0), box(2, 7, 2.0), box(2, 8, 0.0), box(4, 9, 90.0), box(5, 7, 2.0), box(5, 8, 0.0)]
    a, b = spark.createDataFrame(gt, SCHEMA), spark.createDataFrame(tracks, SCHEMA)
    kept = S.kept_pairs(a, b, S.overlaps(a, b).where("iou >= 0.5")).collect()
    assert sorted((r.frame_index, r.gt_id, r.track_id) for r in kept) == [(0, 1, 7), (1, 1, 7), (2, 1, 7), (5, 1, 8)]
    assert S.tracking_scores(a, b).first().switches == 1 and plain(gt, tracks)[4] == 1
    later = b.where("frame_index <> 4")  # a frame without a track doesn't end the preference
    assert {r.track_id for r in S.kept_pairs(a, later, S.overlaps(a, later).where("iou >= 0.5")).collect()} == {7}


def test_frames_that_batches_cut(spark):
    rng = random.Random(8)
    box = lambda f, i: ("a", 0, f, i, 6.0 * (i % 40) + rng.random() * 5, 0.0, 6.0 * (i % 40) + 12, 10.0)
    gt, tracks = [box(f, i) for f in range(8) for i in range(40)], [box(f, 100 + (i + f) % 40) for f in range(8) for i in range(40)]
    a, b = spark.createDataFrame(gt, SCHEMA), spark.createDataFrame(tracks, SCHEMA)
    near = S.overlaps(a, b).where("iou >= 0.5")
    whole = sorted(map(tuple, S.kept_pairs(a, b, near).collect()))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert sorted(map(tuple, S.kept_pairs(a, b, near).collect())) == whole and len(whole) > 100
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_groups_of_a_hundred_thousand_ids_in_one_sequence(spark):
    n = 100_000
    # pairs of ids far apart, and one chain of 3,000 in which ids follow no order
    rows = spark.range(n).selectExpr("'s' as sequence", "0 as cls", "id * 7919 % 100003 as gt_id", "case when id < 3000 then id else 1000000 + id end as track_id", "1L + id % 5 as n")
    chain = spark.range(2999).selectExpr("'s' as sequence", "0 as cls", "(id + 1) * 7919 % 100003 as gt_id", "id as track_id", "9L as n")
    groups = S.id_groups(rows.union(chain)).groupBy("group").count()
    sizes = sorted(r["count"] for r in groups.collect())
    assert sizes == [1] * (n - 3000) + [5999]
    met = rows.union(chain).where("gt_id % 3 <> 0 or track_id >= 3000")
    ours = S._assigned(S.id_groups(met), [*S.TRACK, "group"], "n", "n").agg({"n": "sum"}).first()[0]
    pairs = met.toPandas()
    taken = S.sparse_pairs(pairs["gt_id"].to_numpy(), pairs["track_id"].to_numpy(), pairs["n"].to_numpy(float))
    assert ours == pairs["n"].to_numpy()[taken].sum()
    assert S.id_groups(met.where("false")).count() == 0


def test_id_groups_over_the_tables(spark):
    """Groups of the ids that meet in the tables, against joining them one pair after the other."""
    gt, det = (view(spark, SMALL, n).selectExpr("sequence", "cls", "frame_index", f"{ident} as id", "x1", "y1", "x2", "y2") for n, ident in (("gt", "x1 % 40"), ("det", "x1 % 50")))
    met = S.overlaps(gt, det).where("iou >= 0.3").groupBy(*S.PAIR).count()
    rows = S.id_groups(met).collect()
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for r in rows:
        g, t = find((r.sequence, r.cls, 0, r.gt_id)), find((r.sequence, r.cls, 1, r.track_id))
        root[max(g, t)] = min(g, t)
    assert len(rows) == met.count() > 100
    assert all(find((r.sequence, r.cls, 0, r.gt_id)) == (r.sequence, r.cls, 0, r.group) for r in rows)
