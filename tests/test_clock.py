import random
from datetime import UTC, datetime, timedelta

import pytest

from framelake.plans import catalog
from tests.test_streams import plain_alerts

HOUR = 3_600_000


def written(spark, path, rows):
    """(camera, hours, persons) in order of arrival, as the events table, and as rows of the plain loop."""
    start = datetime(2026, 1, 1, tzinfo=UTC)
    table = [(k, start + timedelta(hours=h), u, 10.0 * n, "view") for k, (u, h, n) in enumerate(rows)]
    spark.createDataFrame(table, "event_id long, ts timestamp, user_id long, value double, event_type string").coalesce(1).write.parquet(f"{path}/events.parquet")
    return [(k, "one", f"cam{u}", k, int(start.timestamp() * 1000 + h * HOUR), n) for k, (u, h, n) in enumerate(rows)]


@pytest.mark.parametrize("name", ["E4_fire_once_shared_clock", "G2_alert_stream_shared_clock"])
def test_a_camera_silent_for_longer_than_the_window_fires_anew(spark, tmp_path, name):
    rng = random.Random(4)
    rows, h = [(0, 0.0, 9), (1, 1.0, 2), (1, 7.5, 2), (0, 8.0, 9), (0, 9.0, 9), (1, 14.5, 9), (0, 15.25, 9)], 30.0
    for _ in range(80):  # cameras 2 and 3 are seldom seen
        h += rng.choice([0.25, 1.0, 2.5])
        rows.append((rng.choice([0, 0, 0, 1, 1, 1, 2, 3]), h, rng.choice([3, 7, 9])))
    plain = written(spark, tmp_path, rows)
    out = catalog.QUERIES[name](spark, str(tmp_path))
    want = sorted((frame, s) for s, frame, *_ in plain_alerts(plain, 6 * HOUR, 5))
    assert {(0, "cam0"), (3, "cam0")} <= set(want)
    assert sorted((r.arrival, r.sequence) for r in out.collect()) == want
