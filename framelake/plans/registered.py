"""Where query modules register what they offer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.sources.adapters import view, with_views

QUERIES: dict = {}
ORACLES: dict = {}
KEY = ["sequence", "frame_index"]
SHARED_CLOCK_SQL = """select arrival, sequence from (select arrival, sequence, mean > 5 as crossed, coalesce(lag(mean > 5) over (partition by sequence order by arrival), false)
    and coalesce(clock - 21600000 <= max(ts_ms) over (partition by sequence order by arrival rows between unbounded preceding and 1 preceding), false) as before
  from (select *, max(ts_ms) over (order by arrival rows between unbounded preceding and 1 preceding) as clock, avg(n_person) over (partition by sequence order by ts_ms range between 21600000 preceding and current row) as mean from ev)) where crossed and not before"""


LATE = "select arrival, sequence, frame_index - arrival % 4 as frame_index, ts_ms - case when arrival % 31 = 0 then 108000000 when arrival % 7 = 0 then 18000000 else 0 end as ts_ms, n_person as n from ev"
LATE_SQL = f"""with e as (select *, lead(arrival) over (partition by sequence, frame_index order by arrival) as again, max(ts_ms) over (order by arrival) as clock,
    coalesce(max(ts_ms) over (order by arrival rows between unbounded preceding and 1 preceding), 0) as clock_before from ({LATE})),
m as (select a.arrival, any_value(a.clock_before) as clock_before, a.sequence, count(*) filter (where b.ts_ms >= a.clock - 21600000) as n_frames, sum(b.n) filter (where b.ts_ms >= a.clock - 21600000) as total, max(b.ts_ms) as newest
  from e a join e b on a.sequence = b.sequence and b.arrival <= a.arrival and (b.again is null or b.again > a.arrival) group by a.arrival, a.sequence)"""

ALERT_SQL = f"""{LATE_SQL}, p as (select *, lag(n_frames > 0 and total > 5 * n_frames) over w as was, lag(newest) over w as newest_before from m window w as (partition by sequence order by arrival))
select arrival, sequence, n_frames, round(total / n_frames, 6) as mean from p where n_frames > 0 and total > 5 * n_frames and not coalesce(was and clock_before - 21600000 <= newest_before, false)"""


def late_events(spark, sf_dir):
    """Events of which every fourth or so repeats a frame, and some come five or thirty hours late."""
    ev = view(spark, sf_dir, "ev")
    delay = F.when(F.col("arrival") % 31 == 0, 108_000_000).when(F.col("arrival") % 7 == 0, 18_000_000).otherwise(0)
    return ev.select("arrival", "sequence", (F.col("frame_index") - F.col("arrival") % 4).alias("frame_index"), (F.col("ts_ms") - delay).alias("ts_ms"), F.col("n_person").alias("n"))


def query(oracle: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = with_views(oracle)
        return f

    return put


def r6(df: DataFrame, *columns: str) -> DataFrame:
    """Doubles to six places after the last step."""
    return df.withColumns({c: F.round(c, 6) for c in columns})
