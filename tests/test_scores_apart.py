"""Pairs that share no id are taken without an assignment."""

from framelake.operators import scores as S


def test_frames_whose_pairs_do_not_compete_are_not_assigned(spark, monkeypatch):
    rows = [("s", 0, f, k, float(20 * k), 0.0, 20.0 * k + 10, 10.0) for f in range(40) for k in range(3)]
    gt = spark.createDataFrame(rows, "sequence string, cls int, frame_index long, id long, x1 double, y1 double, x2 double, y2 double")
    pairs = S.overlaps(gt, gt)
    monkeypatch.setattr(S, "sparse_pairs", None)  # tasks are given this, so an assignment would fail
    assert len(S.kept_pairs(gt, gt, pairs).collect()) == 120
    assert len(S._assigned(pairs, S.FRAME, "iou", "iou").collect()) == 120
