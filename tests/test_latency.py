"""Latency of stages: the first frames, and what is written once."""

import pytest

from framelake.operators import frames as R


@pytest.mark.parametrize("look", [1, 2, 7, 1000])
def test_first_frames_are_found_among_few_rows_or_all(spark, monkeypatch, look):
    monkeypatch.setattr(R, "LOOK", look)
    rows = spark.createDataFrame([(f, s, float(10 * f + k)) for f in range(6) for k, s in enumerate("xxy")], "frame long, stage string, ms double")
    got = {r.stage: (r.n, r.mean) for r in R.latency(rows).collect()}
    assert got == {"x": (6, 40.5), "y": (3, 42.0), "total": (3, 123.0)}
    assert {r.stage: r.n for r in R.latency(rows.where("frame < 3")).collect()} == {"x": 6, "y": 3, "total": 3}
    assert R.latency(rows.limit(0)).count() == 0


def test_timings_are_written_before_they_are_read_again(spark, monkeypatch):
    seen, real = [], R.cut
    monkeypatch.setattr(R, "cut", lambda df, name: (seen.append(name), real(df, name))[1])
    R.latency(spark.createDataFrame([(1, "x", 2.0)], "frame long, stage string, ms double")).collect()
    assert seen == ["timings", "spans"]
