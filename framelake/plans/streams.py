"""Queries that read driver tables as streams and run them to the end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.operators import frames as R
from framelake.operators import order as O
from framelake.plans.registered import ALERT_SQL, KEY, SHARED_CLOCK_SQL, late_events, query, r6
from framelake.sources import messages as M
from framelake.sources.adapters import SPARK, table, view
from framelake.streaming import counters, pairing, replay, serving, sink, stateful


def stream_view(spark, sf_dir: str, name: str) -> DataFrame:
    base, text = SPARK[name]
    return spark.sql(text, t=replay.as_stream(spark, sf_dir, base))


def alerts_in_order(events: DataFrame, shard: str, clock: str | None = None) -> DataFrame:
    """Alerts of a table's events as a stream in order of arrival, four micro-batches or more of about a million rows."""
    columns = list(dict.fromkeys([shard, "arrival", "sequence", "frame_index", "ts_ms", "n", *([clock] if clock else [])]))
    rows = events.select(*columns)
    stream = replay.in_order(rows, "arrival", replay.batches_of(rows), "events-in-order")
    return replay.drain(stateful.alert_stream(stream, shard, 21_600, 5, clock, packed=True), "alerts", replay.at_once(events.sparkSession))


@query("select arrival, sequence from (select arrival, sequence, mean > 5 as crossed, coalesce(lag(mean > 5) over (partition by sequence order by arrival), false) as before from (select *, avg(n_person) over (partition by sequence order by ts_ms range between 21600000 preceding and current row) as mean from ev)) where crossed and not before")
def G2_alert_stream(spark, sf_dir):
    out = alerts_in_order(view(spark, sf_dir, "ev").withColumnRenamed("n_person", "n"), "sequence")
    return out.select(F.col("frame_index").alias("arrival"), "sequence")


@query(SHARED_CLOCK_SQL)
def G2_alert_stream_shared_clock(spark, sf_dir):
    """Shards are sequences; the clock that all share comes as a column, made from the table."""
    clocked = O.running_max(view(spark, sf_dir, "ev"), ["arrival"], "ts_ms", "clock", -1)
    out = alerts_in_order(clocked.withColumnRenamed("n_person", "n"), "sequence", "clock")
    return out.select(F.col("frame_index").alias("arrival"), "sequence")


@query(f"{ALERT_SQL.replace(', round(total / n_frames, 6) as mean', '')}")
def G2_alert_stream_late_frames(spark, sf_dir):
    """The alert rule in full as a stream of micro-batches in order of arrival, in one shard: late and repeated frames, silent sequences."""
    events = late_events(spark, sf_dir).withColumn("shard", F.lit("all"))
    out = alerts_in_order(events, "shard")
    return out.select("arrival", "sequence", "n_frames")


@query("""with w as (select sequence, (k // 2 - 1) // 50 as window_id, n_person as n, conf, cls from (select *, row_number() over (partition by sequence order by arrival) as k from ev) where k % 2 = 0),
f as (select sequence, window_id, count(*) as n_events, sum(n) / cast(count(*) as double) as boxes_per_event, coalesce(sum(conf * n) / nullif(sum(n), 0), 0) as mean_conf, sum(n) as boxes from w group by all having count(*) = 50),
c as (select sequence, cls, min(window_id) as since from w group by all)
select f.sequence, f.window_id, n_events, round(boxes_per_event, 6) as boxes_per_event, round(mean_conf, 6) as mean_conf, c.cls, round(coalesce((select sum(n) from w where w.sequence = f.sequence and w.window_id = f.window_id and w.cls = c.cls), 0) / cast(boxes as double), 6) as share
from f join c on c.sequence = f.sequence and c.since <= f.window_id""")
def G4_health_stream(spark, sf_dir):
    events = stream_view(spark, sf_dir, "ev").selectExpr("sequence", "arrival", "n_person as n", "conf", "cls")
    out = replay.drain(stateful.health_stream(events, "sequence", "arrival", 50, 2), "health")
    shares = out.select("sequence", "window_id", "n_events", F.round("boxes_per_event", 6).alias("boxes_per_event"), F.round("mean_conf", 6).alias("mean_conf"), F.explode(F.from_json("shares", "map<string, double>")).alias("cls", "share"))
    return shares.withColumn("share", F.round("share", 6))


EDGE = """case when i // 8 in (0, 7) or i % 8 in (0, 7) then px[i + 1] else least(255.0::double, greatest(0.0::double,
  9 * px[i + 1] - (px[i - 8] + px[i - 7] + px[i - 6] + px[i] + px[i + 1] + px[i + 2] + px[i + 8] + px[i + 9] + px[i + 10]))) end"""


@query(f"""with r as (select vec_id, label, avg(px[i + 1]) as b, stddev_pop(px[i + 1]) as c, var_pop({EDGE}) as l from fr, generate_series(0, 63) g(i) group by vec_id, label),
s as (select avg(b) as b, avg(c) as c, ln(greatest(avg(l), 1e-6)) as l from r where vec_id % 5 < 3 group by label),
m as (select avg(b) as cb, stddev_pop(b) as sb, avg(c) as cc, stddev_pop(c) as sc, avg(l) as cl, stddev_pop(l) as sl from s),
t as (select max(abs(b - cb) / sb) as tb, max(abs(c - cc) / sc) as tc, max(abs(l - cl) / sl) as tl from s, m),
w as (select label, (k - 1) // 3 as window_id, avg(b) as b, avg(c) as c, ln(greatest(avg(l), 1e-6)) as l from (select *, row_number() over (partition by label order by vec_id) as k from r where vec_id % 5 >= 3) group by all having count(*) = 3),
v as (select label, window_id, abs(b - cb) / sb as score_brightness, abs(c - cc) / sc as score_contrast, abs(l - cl) / sl as score_blur, abs(b - cb) / sb > tb or abs(c - cc) / sc > tc or abs(l - cl) / sl > tl as drifted from w, m, t)
select label, window_id, round(score_brightness, 5) as score_brightness, round(score_contrast, 5) as score_contrast, round(score_blur, 5) as score_blur from
  (select *, row_number() over (partition by label, run order by window_id) as k from (select *, sum(case when drifted then 0 else 1 end) over (partition by label order by window_id) as run from v) where drifted) where k = 2""")
def G3_drift_stream(spark, sf_dir):
    ref = R.reference(R.baseline(R.readings(view(spark, sf_dir, "fr")).where("vec_id % 5 < 3"), "label"))
    live = R.readings(stream_view(spark, sf_dir, "fr")).where("vec_id % 5 >= 3").select("label", "vec_id", *R.STATS)
    out = replay.drain(stateful.drift_stream(live, ref, "label", "vec_id", 3), "drift")
    return out.select("label", "window_id", *[F.round(f"score_{c}", 5).alias(f"score_{c}") for c in R.STATS])


@query("select vec_id, case when mean > 127 then 1 else 0 end as n_boxes, round(mean / 255, 6) as conf from (select vec_id, list_avg(px) as mean from fr where vec_id % 17 <> 0)")
def G1_score_stream(spark, sf_dir):
    """A user's function on the frames; null frames are skipped."""

    def infer(batch):
        mean = batch["image"].map(lambda px: float(sum(px)) / len(px))
        return batch[["vec_id"]].assign(n_boxes=(mean > 127).astype("int64"), conf=mean / 255)

    frames = stream_view(spark, sf_dir, "fr").select("vec_id", F.when(F.col("vec_id") % 17 != 0, F.col("px")).alias("image"))
    out = replay.drain(replay.score_stream(frames, infer, "vec_id long, n_boxes long, conf double"), "scores")
    return out.withColumn("conf", F.round("conf", 6))


def bright_box(payload: bytes):
    """A detector for frames of 8 x 8 grey bytes: the box around what is brighter than 160; other sizes can't be decoded."""
    import numpy as np

    if len(payload) != 64:
        raise ValueError(f"{len(payload)} bytes are no frame")
    grey = np.frombuffer(payload, np.uint8).reshape(8, 8)
    y, x = np.nonzero(grey > 160)
    return 8, 8, [(x.min(), y.min(), x.max() + 1, y.max() + 1, grey.max() / 255, y.min() % 4)] if len(x) else []


def frame_messages(frames: DataFrame) -> DataFrame:
    """Messages of small frames as a topic has them: of every 17th the value is missing, of every 19th the index is no number, of every 23rd the bytes are cut off."""
    index = F.when(F.col("vec_id") % 19 == 0, "x1").otherwise(F.col("vec_id").cast("string"))
    key, headers = M.pack_frame(F.concat(F.lit("scene "), F.col("label").cast("string")), index, F.col("vec_id") * 40)
    grey = F.unhex(F.array_join(F.transform("px", lambda x: F.lpad(F.hex(x.cast("bigint")), 2, "0")), ""))
    value = F.when(F.col("vec_id") % 17 != 0, F.when(F.col("vec_id") % 23 == 0, F.substring(grey, 1, 40)).otherwise(grey))
    return frames.select(key, headers, value.alias("value"))


def scored_frames(spark, sf_dir: str):
    """Scored messages of the frames as a stream, written, and the counters of its batches."""
    stream = serving.score(frame_messages(stream_view(spark, sf_dir, "fr")), bright_box, ("bright", "3"), {0: "person", 1: "vehicle", 2: "two_three_wheeler"})
    return counters.drain_counted(stream, "scored-frames", serving.COUNTERS)


SCORED_SQL = """select 'scene ' || cast(any_value(label) as varchar) as sequence, vec_id as frame_index, vec_id * 40 as ts_frame_ms, max(px[i + 1]) as top,
  min(i % 8) filter (px[i + 1] > 160) as x1, min(i // 8) filter (px[i + 1] > 160) as y1, max(i % 8) filter (px[i + 1] > 160) + 1 as x2, max(i // 8) filter (px[i + 1] > 160) + 1 as y2
  from fr, generate_series(0, 63) g(i) where vec_id % 17 <> 0 and vec_id % 19 <> 0 and vec_id % 23 <> 0 group by vec_id"""


@query(f"""select sequence, frame_index, ts_frame_ms, 'bright 3' as model, true as timed, case when x1 is null then 0 else 1 end as n_boxes, case y1 % 4 when 0 then 'person' when 1 then 'vehicle' when 2 then 'two_three_wheeler' when 3 then '3' end as cls,
  case when x1 is not null then round(top / 255, 6) end as conf, (x1 + x2) / 16.0::double as xc, (y1 + y2) / 16.0::double as yc, (x2 - x1) / 8.0::double as w, (y2 - y1) / 8.0::double as h from ({SCORED_SQL})""")
def G1_B9_scored_events(spark, sf_dir):
    """Frame messages to detection events on the wire and back, with the model that scored them, the time it took and boxes in the wire's form; poison frames are skipped."""
    scored, _ = scored_frames(spark, sf_dir)
    got = M.parse_events(serving.events(scored)).where("ok")
    box = F.get("boxes", F.lit(0))
    timed = F.expr("latency_ms >= 0 and ts_infer_ms > 1600000000000")
    sides = [F.get(box["xywhn"], F.lit(k)).alias(n) for k, n in enumerate(("xc", "yc", "w", "h"))]
    return got.select(*KEY, "ts_frame_ms", F.concat_ws(" ", "model.name", "model.version").alias("model"), timed.alias("timed"), F.size("boxes").alias("n_boxes"), box["cls"].alias("cls"), F.round(box["conf"], 6).alias("conf"), *sides)


@query("select count(*) as consumed, count(*) filter (not poison) as events, count(*) filter (poison) as skipped from (select vec_id % 17 = 0 or vec_id % 19 = 0 or vec_id % 23 = 0 as poison from fr)")
def G1_D9_stream_counters(spark, sf_dir):
    """How many messages a scoring stream consumed, scored and skipped, counted in its own pass over them."""
    _, totals = scored_frames(spark, sf_dir)
    return spark.createDataFrame([tuple(totals[n] for n in ("consumed", "events", "skipped"))], "consumed long, events long, skipped long")


@query("select event_id as frame_index, event_type as cls, user_id from events where event_id % 3 <> 0")
def C9_frame_event_pairs(spark, sf_dir):
    """A frame and the detection event that comes at most ten minutes later, both as streams with watermarks."""
    base = replay.as_stream(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    frames = base.select(F.col("event_id").alias("frame_index"), "user_id", F.col("ts").alias("frame_ts")).withWatermark("frame_ts", "1 hour")
    seen = replay.as_stream(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    seen = seen.where("event_id % 3 <> 0").select(F.col("event_id").alias("e_index"), F.col("event_type").alias("cls"), F.expr("ts + interval 1 minute").alias("event_ts")).withWatermark("event_ts", "1 hour")
    both = frames.join(seen, F.expr("frame_index = e_index and event_ts > frame_ts and event_ts <= frame_ts + interval 10 minutes"))
    return replay.drain(both.select("frame_index", "cls", "user_id"), "pairs")


@query("select event_id, event_type, user_id from events")
def G7_first_delivery(spark, sf_dir):
    """Events that all come twice, the second time a minute later: one of each is passed on."""
    base = replay.as_stream(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    twice = base.withColumn("ts", F.explode(F.array(F.col("ts"), F.expr("ts + interval 1 minute"))))
    return replay.drain(replay.first_delivery(twice, ["event_id"], "ts", "1 hour").select("event_id", "event_type", "user_id"), "deliveries")


#: events come 20 ids before to 279 after their frame; every fifth comes twice
PENDING = "select *, 2 * event_id as shown, 2 * (event_id + event_id * 37 % 300 - 20) + 1 as told from {t}"
PENDING_SQL = f"""with base as (select concat('cam', cast(user_id % 4 as varchar)) as sequence, * from ({PENDING.format(t='events')})),
told as (select sequence, event_id as frame_index, told as arrival, event_type as cls from base union all select sequence, event_id, told + 80, event_type from base where event_id % 5 = 0),
shown as (select *, row_number() over (partition by sequence order by shown) as place from base)
select e.sequence, e.frame_index, e.arrival, f.shown as frame_arrival, f.user_id, e.cls from told e join shown f on f.sequence = e.sequence and f.event_id = e.frame_index
  asof join shown n on n.sequence = e.sequence and n.shown <= e.arrival where f.shown <= e.arrival and n.place - f.place < 64"""


@query(PENDING_SQL)
def C9_pending_pairs(spark, sf_dir):
    """Events with their frames as two streams in step: of a sequence 64 frames are pending, events come before, after and too late for theirs, and again."""
    base = spark.sql(f"select concat('cam', cast(user_id % 4 as string)) as sequence, * from ({PENDING})", t=table(spark, sf_dir, "events"))
    shown = base.selectExpr("sequence", "event_id as frame_index", "shown as arrival", "false as is_event", "user_id", "cast(null as string) as cls")
    told = base.selectExpr("sequence", "event_id", "explode(if(event_id % 5 = 0, array(told, told + 80), array(told))) as arrival", "true", "cast(null as bigint)", "event_type")
    rows = shown.union(told)
    both = replay.in_order(rows, "arrival", replay.batches_of(rows), "frames-and-events")
    out = replay.drain(pairing.pairs(both.where("not is_event"), both.where("is_event"), "user_id", "cls", packed=True), "pairs", replay.at_once(spark))
    return out.withColumnsRenamed({"payload": "user_id", "detail": "cls"})


@query("""select sequence, count(*) as n_frames, count(*) filter (arrival % 17 = 0) as n_skipped, round(count(*) filter (arrival % 17 = 0) / count(*), 6) as skip_rate,
  round(((select max(ts_ms) from ev) - max(ts_ms) filter (arrival % 17 <> 0)) / 1000, 6) as age_s from ev group by sequence""")
def G10_skips_and_ages(spark, sf_dir):
    """Counts of each micro-batch, written once by its number; frames without a reading are skipped, ages are taken at the table's last time."""
    events = view(spark, sf_dir, "ev").withColumn("reading", F.when(F.col("arrival") % 17 != 0, F.col("n_person")))
    stream = replay.in_order(events, "arrival", 4, "monitored-frames")
    counts = sink.drain_batches(stream, lambda batch: R.frame_counts(batch, "reading", "ts_ms"), R.FRAME_COUNTS, "frame-counts")
    return r6(R.monitor_ages(counts, events.select("ts_ms")), "skip_rate", "age_s")
