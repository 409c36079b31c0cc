"""Queries that write files of the domain from the driver tables and read them back, and those over messages and clips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.operators import boxes as B
from framelake.operators import clips as C
from framelake.operators import frames as R
from framelake.plans.registered import KEY, query, r6
from framelake.sources import files as S
from framelake.sources import messages as M
from framelake.sources.adapters import view
from framelake.sources.scratch import cut, new_path

SPLIT_SQL = "case when sequence < 'seq12' then 'train' when sequence <= 'seq15' then 'val' else 'test' end"
STEM_SQL = "sequence || '_' || lpad(cast(frame_index as varchar), 7, '0')"
FIELDS = ["target_id", "bbox_left", "bbox_top", "bbox_width", "bbox_height", "score", "category"]
LINE_SQL = f"""case when target_id = 17 then concat_ws(',', 'x', {', '.join(FIELDS)}) when target_id = 34 then '1,2,3'
  else concat_ws(',', frame_index, {', '.join(FIELDS)}, '0', '0') end"""
NORM_SQL = """(select *, (x1 + x2) / 2 as xc, (y1 + y2) / 2 as yc, x2 - x1 as w, y2 - y1 as h,
  case when category in (1, 2) then 0 when category in (4, 5, 6, 9) then 1 else 2 end as cls
  from (select *, greatest(0.0::double, least(1.0::double, bbox_left / 1000.0::double)) as x1, greatest(0.0::double, least(1.0::double, (bbox_left + bbox_width) / 1000.0::double)) as x2,
    greatest(0.0::double, least(1.0::double, bbox_top / 600.0::double)) as y1, greatest(0.0::double, least(1.0::double, (bbox_top + bbox_height) / 600.0::double)) as y2
    from ann where category between 1 and 10) where x2 > x1 and y2 > y1)"""


def stem():
    return F.format_string("%s_%07d", "sequence", "frame_index")


def lines(spark: SparkSession, sf_dir: str, more: list[str] | None = None) -> DataFrame:
    """Annotation lines of each sequence, some damaged, with the columns ``more``."""
    ann = view(spark, sf_dir, "ann")
    rest = [F.col(c).cast("string") for c in FIELDS]
    whole = F.concat_ws(",", F.col("frame_index").cast("string"), *rest, F.lit("0"), F.lit("0"))
    line = F.when(F.col("target_id") == 17, F.concat_ws(",", F.lit("x"), *rest)).when(F.col("target_id") == 34, "1,2,3").otherwise(whole)
    return ann.select("sequence", *(more or ["line_no"]), line.alias("line"))


def written_lines(spark: SparkSession, sf_dir: str) -> str:
    path = new_path(spark, "annotations")
    S.write_lines(lines(spark, sf_dir), "sequence", ["line_no"], path)
    return path


@query(f"select sequence, {LINE_SQL} as line from ann")
def A1_annotation_scan(spark, sf_dir):
    """Files of a sequence each, written and scanned; the sequence comes from where a line stands."""
    return S.annotation_lines(spark, written_lines(spark, sf_dir))


@query("select sequence, row_number() over (order by sequence) - 1 as place from (select distinct sequence from ann)")
def A3_sequence_listing(spark, sf_dir):
    """Sorted names of the sequences that have files; their count is that of clips."""
    path = written_lines(spark, sf_dir)
    names = S.sequences(S.annotation_lines(spark, path), f"{path}/*.txt")
    return spark.createDataFrame(list(enumerate(names)), "place long, sequence string").select("sequence", "place")


MANIFEST_SQL = f"""select {SPLIT_SQL} as split, sequence, cast(frame_index as varchar) as frame_index, 'images/' || {SPLIT_SQL} || '/' || {STEM_SQL} || '.jpg' as image_relpath,
  'labels/' || {SPLIT_SQL} || '/' || {STEM_SQL} || '.txt' as label_relpath, '1000' as width, '600' as height, cast(count(*) as varchar) as n_boxes, cast(count(*) filter (cls = 0) as varchar) as n_person,
  cast(count(*) filter (cls = 1) as varchar) as n_vehicle, cast(count(*) filter (cls = 2) as varchar) as n_two_three_wheeler from {NORM_SQL} group by sequence, frame_index"""


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the manifest from parsed boxes."""
    boxes = B.normalise(view(spark, sf_dir, "ann"))
    names = ("n_person", "n_vehicle", "n_two_three_wheeler")
    by = boxes.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_boxes"), *[F.count_if(F.col("cls") == k).alias(n) for k, n in enumerate(names)])
    split = F.expr(SPLIT_SQL)
    path = lambda kind, end: F.concat(F.lit(f"{kind}/"), split, F.lit("/"), stem(), F.lit(end))
    return by.select(split.alias("split"), *KEY, path("images", ".jpg").alias("image_relpath"), path("labels", ".txt").alias("label_relpath"), F.lit(1000).alias("width"), F.lit(600).alias("height"), "n_boxes", *names)


@query(MANIFEST_SQL)
def A5_manifest_A6_csv(spark, sf_dir):
    """The manifest as headed CSV files, one of each task, read back with their headers checked; all fields are text."""
    path = new_path(spark, "manifest")
    S.write_csv(manifest(spark, sf_dir), S.MANIFEST, path, one=False)
    return S.read_manifest(spark, path)


@query(f"""select stem, cls, xc, yc, w, h from (select {STEM_SQL} as stem, cls, cast(printf('%.6f', xc) as double) as xc, cast(printf('%.6f', yc) as double) as yc,
  cast(printf('%.6f', w) as double) as w, cast(printf('%.6f', h) as double) as h from {NORM_SQL} where score <> 0)
union all select stem, null, null, null, null, null from (select distinct {STEM_SQL} as stem from ann where (sequence, frame_index) not in (select (sequence, frame_index) from {NORM_SQL} where score <> 0))""")
def A7_label_read_A8_label_write(spark, sf_dir):
    """Label texts of all frames, of those without boxes too; a frame without boxes comes back with nulls."""
    ann = view(spark, sf_dir, "ann")
    boxes = B.normalise(ann.where("score <> 0")).withColumn("stem", stem())
    every = ann.select(stem().alias("stem")).distinct()
    path = new_path(spark, "labels")
    S.write_labels(boxes, every, path)
    read = S.label_texts(spark, path)
    rows = read.select("stem", F.explode(F.split("text", "\n")).alias("line"))
    return read.select("stem").join(B.read_labels(rows).drop("line"), "stem", "left")


EDGE = """case when i // 8 in (0, 7) or i % 8 in (0, 7) then px[i + 1] else least(255.0::double, greatest(0.0::double,
  9 * px[i + 1] - (px[i - 8] + px[i - 7] + px[i - 6] + px[i] + px[i + 1] + px[i + 2] + px[i + 8] + px[i + 9] + px[i + 10]))) end"""
READ_SQL = f"(select vec_id, label, avg(px[i + 1]) as brightness, stddev_pop(px[i + 1]) as contrast, var_pop({EDGE}) as blur from fr, generate_series(0, 63) g(i) group by vec_id, label)"


@query(f"select 'scene ' || label as sequence, count(*) as n_frames, round(avg(brightness), 6) as brightness, round(avg(contrast), 6) as contrast, round(avg(blur), 4) as blur from {READ_SQL} where vec_id % 5 < 3 group by label")
def A9_baseline_file(spark, sf_dir):
    """Scenes of the drift baseline as CSV and back."""
    scenes = R.baseline(R.readings(view(spark, sf_dir, "fr")).where("vec_id % 5 < 3"), "label")
    path = new_path(spark, "baseline")
    S.write_baseline(scenes.withColumn("sequence", F.concat(F.lit("scene "), F.col("label").cast("string"))), path)
    return r6(S.read_baseline(spark, path), "brightness", "contrast").withColumn("blur", F.round("blur", 4))


PROFILE_FIELDS = "schema_version int, dataset struct<n_boxes bigint, n_duplicate_clusters bigint, n_flagged bigint, n_frames bigint>, baseline struct<n_sequences bigint, split string>, splits map<string, struct<n_frames bigint, brightness double>>"


@query(f"""with r as (select *, case when vec_id % 5 < 3 then 'train' else 'val' end as split from {READ_SQL}),
h as (select vec_id, string_agg(case when px[i + 2] > px[i + 1] then '1' else '0' end, '' order by i) as h from fr, generate_series(0, 63) g(i) where i % 8 < 7 group by vec_id)
select split, 2 as schema_version, n_frames, round(b, 6) as brightness, (select count(*) from r) as all_frames, (select count(*) from ann where category between 1 and 10) as all_boxes,
  (select count(*) from (select h from h group by h having count(*) > 1)) as clusters, (select cast(sum(cast(brightness < 20 as int) + cast(brightness > 235 as int) + cast(contrast < 10 as int) + cast(blur < 50 as int)) as bigint) from r) as flagged,
  (select count(distinct label) from r where split = 'train') as sequences
from (select split, count(*) as n_frames, avg(brightness) as b from r group by split)""")
def A10_profile_document(spark, sf_dir):
    """One JSON document of fixed sections, written, read and taken apart."""
    fr = view(spark, sf_dir, "fr")
    read = cut(R.readings(fr).select("vec_id", "label", *R.STATS, F.expr("if(vec_id % 5 < 3, 'train', 'val')").alias("split")), "profiled")
    path = new_path(spark, "profile")
    boxes = view(spark, sf_dir, "ann").where("category between 1 and 10").agg(F.count(F.lit(1)).alias("n_boxes"))
    R.profile_document(read, R.dhash(fr).select("dhash"), boxes, "train").coalesce(1).write.text(path)
    doc = spark.read.text(path).select(F.from_json("value", PROFILE_FIELDS).alias("d")).select("d.*")
    flat = doc.select("schema_version", "dataset", "baseline", F.explode("splits").alias("split", "s"))
    return flat.select("split", "schema_version", "s.n_frames", F.round("s.brightness", 6).alias("brightness"), F.col("dataset.n_frames").alias("all_frames"), F.col("dataset.n_boxes").alias("all_boxes"),
                       F.col("dataset.n_duplicate_clusters").alias("clusters"), F.col("dataset.n_flagged").alias("flagged"), F.col("baseline.n_sequences").alias("sequences"))


@query(f"select sequence, {LINE_SQL} as line from ann where category = 7 and target_id < 25 union all select distinct sequence, '' from ann where sequence not in (select sequence from ann where category = 7 and target_id < 25)")
def A11_annotation_export(spark, sf_dir):
    """Lines of each sequence in order; a sequence that has none still has its file."""
    ann = view(spark, sf_dir, "ann")
    rest = [F.col(c).cast("string") for c in FIELDS]
    whole = F.when(F.col("target_id") == 17, F.concat_ws(",", F.lit("x"), *rest)).otherwise(F.concat_ws(",", F.col("frame_index").cast("string"), *rest, F.lit("0"), F.lit("0")))
    some = ann.where("category = 7 and target_id < 25").select("sequence", "frame_index", "line_no", whole.alias("line"))
    path = new_path(spark, "export")
    S.write_lines(some, "sequence", ["frame_index", "line_no"], path, ann)
    return S.read_lines(spark, path, "sequence")


@query("select sequence, frame_index, cls, x1, y1, x2, y2, conf from det")
def A12_stored_pass(spark, sf_dir):
    """A detector's pass over all frames, stored by the hash of its settings, and loaded for all of them."""
    every = view(spark, sf_dir, "ann").select(*KEY).distinct()
    key, path = S.pass_key("all", {"model": "m", "conf": 0.25, "merge": True, "imgsz": None}), new_path(spark, "passes")
    S.save_detections(every, view(spark, sf_dir, "det"), key, path, KEY)
    out = S.load_detections(every, key, path, KEY)
    return out.select(*KEY, "cls", "x1", "y1", "x2", "y2", "conf")


@query("""select sequence || '/' || cast(frame_index as varchar) as frame, row_number() over (partition by sequence, frame_index order by conf desc, x1, y1, x2, y2, cls) - 1 as place, cast(x1 as double) as x1, cast(y2 as double) as y2,
  round(cast(cast(conf as float) as double), 6) as conf, cls from det""")
def A13_detection_dump(spark, sf_dir):
    """Float rows of each frame as JSON and back, best first."""
    path = new_path(spark, "dump")
    S.dump_detections(view(spark, sf_dir, "det"), KEY, path)
    return S.load_dump(spark, path).select("frame", "place", F.col("x1").cast("double").alias("x1"), F.col("y2").cast("double").alias("y2"), F.round(F.col("conf").cast("double"), 6).alias("conf"), F.col("cls").cast("long").alias("cls"))


@query(f"""with i as (select file_name, row_number() over (order by file_name) as image_id from (select distinct {STEM_SQL} as file_name from ann))
select row_number() over (order by image_id, line_no, cls, l, t, w, h) as id, image_id, cls + 1 as category_id, round(l, 4) as l, round(t, 4) as t, round(w, 4) as w, round(w * h, 4) as area from (
  select image_id, line_no, cls, xc * 1000 - w * 1000 / 2 as l, yc * 600 - h * 600 / 2 as t, w * 1000 as w, h * 600 as h from {NORM_SQL} n join i on i.file_name = {STEM_SQL})""")
def A14_coco_export(spark, sf_dir):
    """Images, annotations and categories with dense ids; the annotations are written as JSON and read back."""
    ann = view(spark, sf_dir, "ann")
    sizes = ann.select(stem().alias("file_name")).distinct().select("file_name", F.lit(1000).alias("width"), F.lit(600).alias("height"))
    boxes = B.normalise(ann).select(stem().alias("file_name"), "line_no", "cls", "xc", "yc", "w", "h")
    _, annotations, _ = S.coco_tables(sizes, boxes, {0: "person", 1: "vehicle", 2: "two_three_wheeler"})
    path = new_path(spark, "coco")
    annotations.write.json(path)
    out = spark.read.schema("id bigint, image_id bigint, category_id int, bbox array<double>, area double, iscrowd int").json(path)
    return out.select("id", "image_id", "category_id", *[F.round(F.get("bbox", F.lit(k)), 4).alias(c) for k, c in enumerate("ltw")], F.round("area", 4).alias("area"))


@query("""select arrival, sequence, case when arrival % 13 <> 0 then frame_index end as frame_index, case when arrival % 7 <> 0 then ts_ms end as ts_ms,
  arrival % 13 <> 0 and arrival % 7 <> 0 and arrival % 11 <> 0 as ok from ev""")
def A15_frame_messages(spark, sf_dir):
    """Frame messages packed and parsed; some lack a header, some have one that is no number, some have no value."""
    ev = view(spark, sf_dir, "ev")
    index = F.when(F.col("arrival") % 13 == 0, "x1").otherwise(F.col("frame_index").cast("string"))
    key, headers = M.pack_frame(F.col("sequence"), index, F.col("ts_ms"))
    more = F.concat(headers, F.array(F.struct(F.lit("trace").alias("key"), F.encode(F.lit("t"), "utf-8").alias("value"))))
    value = F.when(F.col("arrival") % 11 != 0, F.encode(F.lit("jpeg"), "utf-8")).alias("value")
    sent = ev.select("arrival", key, F.when(F.col("arrival") % 7 == 0, F.filter(more, lambda h: h["key"] != "ts_ms")).otherwise(more).alias("headers"), value)
    return M.parse_frames(sent).select("arrival", "sequence", "frame_index", "ts_ms", "ok")


@query("""select arrival, arrival % 9 <> 0 and arrival % 10 <> 0 as ok, case when arrival % 10 <> 0 then sequence end as sequence, case when arrival % 10 <> 0 then ts_ms end as ts_frame_ms,
  case when arrival % 10 <> 0 then n_person % 3 end as n_boxes, case when arrival % 9 <> 0 and arrival % 10 <> 0 then 'v' || cast(arrival % 4 as varchar) end as version from ev""")
def A16_event_codec(spark, sf_dir):
    """Detection events as JSON and back: unknown fields are passed over, an event without its model and one that is no JSON aren't ok."""
    box = "struct('person' as cls, conf as conf, array(0.5D, 0.5D, 0.1D, 0.2D) as xywhn)"
    ev = view(spark, sf_dir, "ev").selectExpr("arrival", "sequence", "1 as schema_version", "frame_index", "ts_ms as ts_frame_ms", "ts_ms + 40 as ts_infer_ms", "40D as latency_ms", "if(arrival % 9 = 0, null, struct('m' as name, concat('v', arrival % 4) as version)) as model",
                                              f"slice(array({box}, {box}), 1, int(n_person % 3)) as boxes", "'more' as unknown")
    value = F.to_json(F.struct(*[c for c in ev.columns if c != "arrival"]))
    sent = ev.select("arrival", F.when(F.col("arrival") % 10 == 0, F.concat(F.lit("{"), value)).otherwise(value).alias("value"))
    got = M.parse_events(sent)
    return got.select("arrival", "ok", "sequence", "ts_frame_ms", F.when(F.col("boxes").isNotNull(), F.size("boxes")).cast("long").alias("n_boxes"), F.col("model.version").alias("version"))


@query(f"select split, count(*) as n, count(distinct sequence) as n_sequences from (select {SPLIT_SQL} as split, * from ann where category between 1 and 10) group by 1")
def A17_split_view(spark, sf_dir):
    """Splits as folders of a table: each replaces what the split held, the others stay."""
    path, rows = new_path(spark, "splits"), view(spark, sf_dir, "ann").where("category between 1 and 10")
    for split in ("val", "train", "test", "val"):  # val is written anew
        S.write_split(rows.where(F.expr(SPLIT_SQL) == split).select(*KEY, "line_no", "category"), split, path)
    return spark.read.parquet(path).groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("sequence").alias("n_sequences"))


@query("""select f.sequence, f.frame_index, count(a.line_no) as n_boxes from (select distinct sequence, frame_index from ann where frame_index >= 3 and frame_index < 13) f
  left join (select * from ann where category = 1) a on a.sequence = f.sequence and a.frame_index = f.frame_index group by all""")
def A18_demo_clips(spark, sf_dir):
    """All frames of a window of each clip, those without boxes too."""
    ann = view(spark, sf_dir, "ann")
    out = S.expand_clip(ann.select(*KEY).distinct(), ann.where("category = 1").select(*KEY, "line_no", "target_id"), KEY, 3, 10)
    return out.select(*KEY, F.coalesce(F.array_size("boxes"), F.lit(0)).cast("long").alias("n_boxes"))


@query("""select run_id, status as state, round(metric, 9) as map5095, priority as gate, cast(custkey as varchar) as data from runs""")
def A19_tracking_tables(spark, sf_dir):
    """Metrics, params and tags of runs as long tables, written, and read back as maps of each run."""
    runs = view(spark, sf_dir, "runs")
    path = new_path(spark, "tracking")
    runs.select("run_id", F.lit("test/mAP50-95").alias("key"), F.lit(0).alias("step"), F.col("metric").alias("value")).write.parquet(f"{path}/metrics")
    tags = F.explode(F.create_map(F.lit("gate"), F.col("priority"), F.lit("data.version"), F.col("custkey").cast("string"))).alias("key", "value")
    runs.select("run_id", tags).write.parquet(f"{path}/tags")
    as_map = lambda t: spark.read.parquet(f"{path}/{t}").groupBy("run_id").agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias(t))
    out = runs.select("run_id", F.col("status").alias("state")).join(as_map("metrics"), "run_id").join(as_map("tags"), "run_id")
    pick = lambda m, k: F.try_element_at(F.col(m), F.lit(k))
    return out.select("run_id", "state", F.round(pick("metrics", "test/mAP50-95"), 9).alias("map5095"), pick("tags", "gate").alias("gate"), pick("tags", "data.version").alias("data"))


VERDICT_SQL = f"""r as {READ_SQL},
s as (select avg(brightness) as b, avg(contrast) as c, ln(greatest(avg(blur), 1e-6)) as l from r where vec_id % 5 < 3 group by label),
m as (select avg(b) as cb, stddev_pop(b) as sb, avg(c) as cc, stddev_pop(c) as sc, avg(l) as cl, stddev_pop(l) as sl from s),
t as (select max(abs(b - cb) / sb) as tb, max(abs(c - cc) / sc) as tc, max(abs(l - cl) / sl) as tl from s, m),
k as (select *, (row_number() over (order by vec_id) - 1) // 10 as window_id, (row_number() over (order by vec_id) - 1) % 10 as pos from r where vec_id % 5 >= 3),
w as (select window_id, avg(brightness) as b, avg(contrast) as c, ln(greatest(avg(blur), 1e-6)) as l from k group by 1 having count(*) = 10),
v as (select window_id, abs(b - cb) / sb as xb, abs(c - cc) / sc as xc, abs(l - cl) / sl as xl, tb, tc, tl, abs(b - cb) / sb > tb or abs(c - cc) / sc > tc or abs(l - cl) / sl > tl as drifted from w, m, t),
o as (select * from (select *, row_number() over (partition by run order by window_id) as nth from (select *, sum(case when drifted then 0 else 1 end) over (order by window_id) as run from v) where drifted) where nth = 2)"""


def monitored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Samples of the live windows, and the verdicts on these."""
    read = cut(R.readings(view(spark, sf_dir, "fr")).select("vec_id", "label", *R.STATS), "readings")
    ref = R.reference(R.baseline(read.where("vec_id % 5 < 3"), "label"))
    windows = cut(R.count_windows(read.where("vec_id % 5 >= 3"), ["vec_id"], 10), "windows")
    return windows, cut(R.verdicts(R.window_means(windows), ref), "verdicts")


@query(f"""with {VERDICT_SQL},
n as (select *, sum(cast(drifted as int)) over (order by window_id) as nd, sum(cast(not drifted as int)) over (order by window_id) as nk,
  sum(cast(window_id in (select window_id from o) as int)) over (order by window_id) as no from v)
select window_id, x.name as name, x.label as label, round(x.value, 5) as value from (select window_id, unnest([
  {{'name': 'drift_score', 'label': 'brightness', 'value': xb}}, {{'name': 'drift_threshold', 'label': 'brightness', 'value': tb}},
  {{'name': 'drift_score', 'label': 'contrast', 'value': xc}}, {{'name': 'drift_threshold', 'label': 'contrast', 'value': tc}},
  {{'name': 'drift_score', 'label': 'blur', 'value': xl}}, {{'name': 'drift_threshold', 'label': 'blur', 'value': tl}},
  {{'name': 'drift_windows', 'label': 'ok', 'value': nk::double}}, {{'name': 'drift_windows', 'label': 'drifted', 'value': nd::double}},
  {{'name': 'drift_episodes', 'label': '', 'value': no::double}}]) as x from n)""")
def G10_monitor_readings(spark, sf_dir):
    """What a monitor exposes after each window."""
    _, judged = monitored(spark, sf_dir)
    return R.monitor_readings(judged, R.episodes(judged)).withColumn("value", F.round("value", 5))


@query(f"""with {VERDICT_SQL},
p as (select window_id, label, min(pos) as o, 'scene ' || label || '/' || min(vec_id) || '-' || max(vec_id) as s from k where window_id in (select window_id from o) group by 1, 2),
e as (select window_id, string_agg(s, ', ' order by o) as place from p group by 1),
f as (select window_id, list(vec_id order by pos) as evidence from k where pos in (0, 5, 9) group by 1)
select window_id, row_number() over (order by window_id) - 1 as step, place, 10 as n_frames, array_to_string(evidence, ',') as evidence,
  array_to_string(list_filter([case when xb > tb then 'brightness' end, case when xc > tc then 'contrast' end, case when xl > tl then 'blur' end], lambda x: x is not null), ',') as crossed,
  round(xb, 5) as brightness, round(tb, 5) as bar from o join e using (window_id) join f using (window_id)""")
def G11_episode_evidence(spark, sf_dir):
    """A record of each episode with the footage behind it."""
    windows, judged = monitored(spark, sf_dir)
    named = windows.select("window_id", "pos", F.concat(F.lit("scene "), F.col("label").cast("string")).alias("sequence"), F.col("vec_id").alias("frame_index"))
    out = R.episode_evidence(R.episodes(judged), named)
    return out.select("window_id", "step", "place", "n_frames", F.array_join("evidence", ",").alias("evidence"), F.array_join("crossed", ",").alias("crossed"),
                      F.round("scores.brightness", 5).alias("brightness"), F.round("thresholds.brightness", 5).alias("bar"))


@query()
def E20_key_tracks(spark, sf_dir):
    """Tracks over key frames of clips of 40 frames; assignment has no SQL form."""
    det = view(spark, sf_dir, "det").where("conf >= 0.3D").withColumn("clip", F.expr("(frame_index - 1) div 40"))
    out = C.key_tracks(det, ["sequence", "clip"], every=5, new_iou=0.3, empty_frames=3)
    return out.select("sequence", "clip", "frame_index", "track", F.col("cls"), F.round("conf", 6).alias("conf"), "x1", "y1", "x2", "y2")


@query("select vec_id, case when vec_id % 17 = 0 then null else round(list_avg(px), 6) end as brightness, case when vec_id % 17 = 0 then 'no pixels' end as error from fr")
def H1_side_outputs(spark, sf_dir):
    """A user's function with rows and marked rows as its two outputs, put side by side."""

    def each(batch):
        import pandas as pd

        bad = batch["px"].isna()
        mean = batch["px"].map(lambda px: None if px is None else float(sum(px)) / len(px))
        return pd.DataFrame({"vec_id": batch["vec_id"], "brightness": mean.astype("float64"), "error": bad.map({True: "no pixels", False: None}).astype(object)})

    rows = view(spark, sf_dir, "fr").select("vec_id", F.when(F.col("vec_id") % 17 != 0, F.col("px")).alias("px"))
    good, marked = C.with_side_outputs(rows, each, "vec_id long, brightness double")
    return good.select("vec_id", F.round("brightness", 6).alias("brightness"), F.lit(None).cast("string").alias("error")).unionByName(marked_rows(marked))


def marked_rows(marked: DataFrame) -> DataFrame:
    return marked.select("vec_id", F.lit(None).cast("double").alias("brightness"), "error")


@query("select sequence, frame_index, line_no, bbox_left as x1, bbox_top as y1, bbox_left + bbox_width as x2, bbox_top + bbox_height as y2 from ann where category = 4")
def H6_detect_tiles(spark, sf_dir):
    """A detector's function over tiles of frames: what it finds in a tile comes back in the frame's pixels."""
    tiles = view(spark, sf_dir, "ann").where("category = 4").selectExpr(*KEY, "line_no", "bbox_left", "bbox_top", "bbox_width", "bbox_height", "bbox_left div 320 * 320 as x0", "bbox_top div 320 * 320 as y0")

    def detect(batch):
        x, y = batch["bbox_left"] - batch["x0"], batch["bbox_top"] - batch["y0"]
        return batch[["sequence", "frame_index", "line_no", "x0", "y0"]].assign(x1=x, y1=y, x2=x + batch["bbox_width"], y2=y + batch["bbox_height"])

    schema = "sequence string, frame_index long, line_no int, x0 long, y0 long, x1 long, y1 long, x2 long, y2 long"
    return C.detect_tiles(tiles, detect, schema).drop("x0", "y0")


@query("select sequence, clip, frame_index, n, round(sum(n) over (partition by sequence, clip order by frame_index), 6) as seen from (select sequence, (frame_index - 1) // 40 as clip, frame_index, count(*) as n from ann group by all)")
def H5_tracker_per_clip(spark, sf_dir):
    """A user's tracker over the frames of each clip in order, from a fresh start; this one counts boxes."""

    def tracker(clip):
        return clip[["sequence", "clip", "frame_index", "n"]].assign(seen=clip["n"].cumsum())

    frames = view(spark, sf_dir, "ann").groupBy("sequence", F.expr("(frame_index - 1) div 40").alias("clip"), "frame_index").agg(F.count(F.lit(1)).alias("n"))
    return C.per_clip(frames, ["sequence", "clip"], ["frame_index"], tracker, "sequence string, clip long, frame_index long, n long, seen long")
