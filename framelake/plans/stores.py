"""Queries over whole exports, stores of clips and runs, and the parts of totals, faults, routes and readings that the short forms leave out."""

from __future__ import annotations

from pyspark.sql import functions as F

from framelake.operators import boxes as B
from framelake.operators import clips as C
from framelake.operators import frames as R
from framelake.operators import order as O
from framelake.operators import tracks as T
from framelake.plans import reports
from framelake.plans.files import NORM_SQL, READ_SQL, STEM_SQL, stem
from framelake.plans.registered import KEY, LATE, late_events, query, r6
from framelake.plans.runs import STAMP_SQL, STORED_SQL, I6_skip_if_current
from framelake.sources import exports as X
from framelake.sources import files as S
from framelake.sources import tracking as K
from framelake.sources.adapters import table, view
from framelake.sources.scratch import cut, new_path

CLASSES = {0: "person", 1: "vehicle", 2: "two_three_wheeler"}


@query(f"""with i as (select file_name, row_number() over (order by file_name) as image_id from (select distinct {STEM_SQL} as file_name from ann)),
a as (select row_number() over (order by image_id, line_no, cls, l, t, w, h) as id, image_id, cls, round(l, 4) as l, round(t, 4) as t, round(w, 4) as w, round(w * h, 4) as area from (
  select image_id, line_no, cls, xc * 1000 - w * 1000 / 2 as l, yc * 600 - h * 600 / 2 as t, w * 1000 as w, h * 600 as h from {NORM_SQL} n join i on i.file_name = {STEM_SQL} where cls <> 1))
select image_id, file_name, 1000 as width, id, ['person', 'vehicle', 'two_three_wheeler'][cls + 1] as category, l, t, w, area from i left join a using (image_id)""")
def A14_coco_document(spark, sf_dir):
    """One document of images, annotations and categories, read back: an image whose boxes are all vehicles stays, without a box."""
    ann = view(spark, sf_dir, "ann")
    sizes = ann.select(stem().alias("file_name")).distinct().select("file_name", F.lit(1000).alias("width"), F.lit(600).alias("height"))
    boxes = B.normalise(ann).where("cls <> 1").select(stem().alias("file_name"), "line_no", "cls", "xc", "yc", "w", "h")
    path = new_path(spark, "coco-document")
    X.write_document(S.coco_tables(sizes, boxes, CLASSES), path)
    images, annotations, categories = X.read_document(spark, path)
    named = annotations.join(F.broadcast(categories.select(F.col("id").alias("category_id"), F.col("name").alias("category"))), "category_id")  # a row for each class
    out = images.select(F.col("id").alias("image_id"), "file_name", "width").join(named, "image_id", "left")
    return out.select("image_id", "file_name", "width", "id", "category", *[F.round(F.get("bbox", F.lit(k)), 4).alias(c) for k, c in enumerate("ltw")], F.round("area", 4).alias("area"))


WINDOW_SQL = "frame_index >= 3 and frame_index < 43"
FRAMES_SQL = f"select sequence, frame_index, count(*) as k from ann where {WINDOW_SQL} group by all"


def clip_listing(spark, sf_dir):
    """Frames with bytes; every 29th couldn't be read."""
    frames = view(spark, sf_dir, "ann").groupBy(*KEY).agg(F.count(F.lit(1)).alias("k"))
    content = F.encode(F.repeat(F.concat_ws("/", "sequence", F.col("frame_index").cast("string")), F.col("k").cast("int")), "utf-8")
    path = F.format_string("%s/%07d.jpg", "sequence", "frame_index")
    return frames.select(*KEY, path.alias("path"), F.when(F.col("frame_index") % 29 != 0, content).alias("content"))


@query(f"""select f.sequence, f.frame_index, sha256(repeat(f.sequence || '/' || cast(f.frame_index as varchar), cast(f.k as int))) as digest, b.n as n_boxes, b.places from ({FRAMES_SQL}) f
  left join (select sequence, frame_index, count(*) as n, string_agg(cast(line_no as varchar), ',' order by line_no) as places from ann where category = 1 group by all) b on b.sequence = f.sequence and b.frame_index = f.frame_index
  where f.frame_index % 29 <> 0""")
def A18_clip_store(spark, sf_dir):
    """Frames of a window of each clip with their bytes, written and read; labels stand only where there are boxes."""
    path = new_path(spark, "clips")
    boxes = view(spark, sf_dir, "ann").where("category = 1").select(*KEY, "line_no", "target_id")
    X.write_clips(clip_listing(spark, sf_dir), boxes, 3, 40, path)
    places = F.array_join(F.col("boxes.line_no").cast("array<string>"), ",")
    return X.read_clips(spark, path).select(*KEY, F.sha2("content", 256).alias("digest"), F.when(F.col("boxes").isNotNull(), F.size("boxes")).cast("long").alias("n_boxes"), places.alias("places"))


@query(f"""select count(*) as kept, count(*) filter (frame_index % 29 <> 0) as copied, case when count(*) <> count(*) filter (frame_index % 29 <> 0) then count(*) || ' kept, but ' || count(*) filter (frame_index % 29 <> 0) || ' copied' else '' end as warning from ({FRAMES_SQL})""")
def A18_D9_copy_counters(spark, sf_dir):
    """Counters of the job that writes a store of clips, from the pass that writes it."""
    counts, warnings = X.write_clips(clip_listing(spark, sf_dir), view(spark, sf_dir, "ann").where("category = 1").select(*KEY, "line_no"), 3, 40, new_path(spark, "clips"))
    return spark.createDataFrame([(counts["kept"], counts["copied"], "; ".join(warnings))], "kept long, copied long, warning string")


def tracking_store(spark, sf_dir) -> str:
    """Runs as a store: each makes a version of its model and sets one of two aliases to it, the later ones again; metrics of two steps, tags set twice."""
    path, runs = new_path(spark, "store"), view(spark, sf_dir, "runs")
    own = lambda *more: runs.selectExpr("run_id", *more)
    gate = "inline(array(struct('gate.passed' as key, 0L as set_at, 'False' as value), struct('gate.passed' as key, run_id % 2 as set_at, cast(metric > 0.3 as string) as value)))"
    K.append(spark, path, runs=own("name", "status"), params=own("'imgsz' as key", "cast(640 * (1 + custkey % 2) as string) as value"))
    K.append(spark, path, metrics=own("inline(array(struct('test/mAP50-95' as key, 1L as step, metric as value), struct('test/mAP50-95' as key, 0L as step, metric / 2 as value)))"), tags=own("'priority' as key", "0L as set_at", "priority as value"))
    K.append(spark, path, versions=runs.selectExpr("name as model", "run_id as version", "run_id"), version_tags=runs.selectExpr("name as model", "run_id as version", gate))
    K.append(spark, path, aliases=runs.selectExpr("name as model", "if(status = 'FINISHED', 'champion', 'challenger') as alias", "run_id % 100 as set_at", "run_id as version"))
    return path


@query("""with a as (select name, status, arg_max(run_id, {'s': run_id % 100, 'v': run_id}) as run_id from runs group by 1, 2)
select name as model, case when status = 'FINISHED' then 'champion' else 'challenger' end as alias, run_id as version, round(metric, 9) as map5095, priority, cast(640 * (1 + custkey % 2) as varchar) as imgsz,
  case when run_id % 2 = 1 and metric > 0.3::double then 'true' when run_id % 2 = 1 then 'false' when metric > 0.3::double then 'true' else 'false' end as passed
from a join runs using (name, status, run_id)""")
def A19_versions_by_alias(spark, sf_dir):
    """The version that an alias of each model names, with the params, last metrics and tags of its run and its own tags."""
    path = tracking_store(spark, sf_dir)
    runs = K.described(spark, path).select("run_id", "params", "metrics", F.col("tags").alias("run_tags"))
    named = None
    for alias in ("champion", "challenger"):
        one = K.resolved(spark, path, alias).withColumn("alias", F.lit(alias))
        named = one if named is None else named.unionByName(one)
    pick = lambda m, k: F.try_element_at(F.col(m), F.lit(k))
    return named.join(runs, "run_id").select(
        "model", "alias", "version", F.round(pick("metrics", "test/mAP50-95"), 9).alias("map5095"), pick("run_tags", "priority").alias("priority"), pick("params", "imgsz").alias("imgsz"), F.lower(pick("tags", "gate.passed")).alias("passed"))


@query(f"""with r as (select *, case when vec_id % 5 < 3 then 'train' else 'val' end as split from {READ_SQL}),
h as (select vec_id, string_agg(case when px[i + 2] > px[i + 1] then '1' else '0' end, '' order by i) as h from fr, generate_series(0, 63) g(i) where i % 8 < 7 group by vec_id)
select (select count(*) from r) as n_frames, (select count(*) from ann where category between 1 and 10) as n_boxes, (select count(*) from (select h from h group by h having count(*) > 1)) as n_clusters,
  (select cast(sum(cast(brightness < 20 as int) + cast(brightness > 235 as int) + cast(contrast < 10 as int) + cast(blur < 50 as int)) as bigint) from r) as n_flagged,
  (select count(distinct label) from r where split = 'train') as n_baseline_sequences""")
def D6_dataset_totals(spark, sf_dir):
    """Frames, boxes, flags, clusters of frames that look alike, and sequences of the baseline."""
    fr = view(spark, sf_dir, "fr")
    read = cut(R.readings(fr).select("vec_id", "label", *R.STATS, F.expr("if(vec_id % 5 < 3, 'train', 'val')").alias("split")), "readings")
    return R.dataset_totals(read, R.dhash(fr).select("dhash"), view(spark, sf_dir, "ann").where("category between 1 and 10"), "train")


#: of the splits one is empty, of the classes one never comes, and some frames lack an image or a label
GAPS = "sequence <= 'seq15' and category % 3 <> 2"
FAULTS_SQL = f"""with {reports.D8_CTE.replace(reports.LINES_SQL, reports.LINES_SQL + f" where {GAPS}")},
n2 as (select distinct {reports.SPLIT} as split, {STEM_SQL} as name, frame_index % 10 <> 3 as i, frame_index % 11 <> 4 as l from ann where {GAPS})
select split, fault, count(*) as n from j where fault is not null group by 1, 2
union all select split, case when i then 'no label' else 'no image' end, count(*) from n2 where i <> l group by all
union all select s, 'no images', 1 from (select unnest(['train', 'val', 'test']) as s) where s not in (select split from n2 where i)
union all select null, 'class ' || c || ' has no box', 1 from (select unnest([0, 1, 2]) as c) where c not in (select cls from j where numeric)"""


@query(FAULTS_SQL.replace("select category, target_id, (", "select sequence, category, target_id, ("))
def D8_dataset_faults(spark, sf_dir):
    """All faults of a dataset together: by line, of frames without their other half, empty splits and absent classes."""
    ann = view(spark, sf_dir, "ann").where(GAPS)
    lines = spark.sql(f"select {reports.SPLIT} as split, {reports.LINE_SQL.format(print='printf')} as line from (select category, target_id, {reports.CENTRES.format(d='D')} from {{ann}})", ann=ann)
    names = ann.select(F.expr(reports.SPLIT).alias("split"), stem().alias("name"), "frame_index").distinct()
    return T.dataset_faults(names.where("frame_index % 10 <> 3").select("split", "name"), names.where("frame_index % 11 <> 4").select("split", "name"), lines)


@query(f"select sequence, frame_index, ts_ms, n, arrival from (select *, row_number() over (partition by sequence, frame_index order by arrival desc) as k from ({LATE})) where k = 1")
def E1_latest_per_frame(spark, sf_dir):
    """Of frames that come again the last arrival."""
    return O.latest(late_events(spark, sf_dir), KEY, "arrival").select(*KEY, "ts_ms", "n", "arrival")


@query(f"select sequence, frame_index, ts_ms, n, arrival from (select *, row_number() over (partition by sequence, frame_index order by ts_ms desc, arrival desc) as k from ({LATE})) where k = 1")
def E1_latest_by_time(spark, sf_dir):
    """Of frames that come again the one with the latest time of its own, as strict readers take it."""
    return O.latest(late_events(spark, sf_dir), KEY, "ts_ms", "arrival").select(*KEY, "ts_ms", "n", "arrival")


@query("""with b as (select vec_id, i // 32 * 4 as y0, i % 8 // 4 * 4 as x0, i // 8 as y, i % 8 as x, px[i + 1] as v from fr, generate_series(0, 63) g(i) where px[i + 1] > 160)
select vec_id, min(x) as x1, min(y) as y1, max(x) + 1 as x2, max(y) + 1 as y2, round(max(v) / 255, 6) as conf from b group by vec_id, x0, y0""")
def H6_detect_pixels(spark, sf_dir):
    """A detector that finds the bright part of a tile from its pixels, over the four tiles of each frame."""
    import numpy as np
    import pandas as pd

    tiles = B.tiles(view(spark, sf_dir, "fr").where("px is not null").select("vec_id", "px", F.lit(8).alias("w"), F.lit(8).alias("h")), 4, 0.0)
    tiles = tiles.select("vec_id", "x0", "y0", F.expr("flatten(transform(sequence(0, 3), r -> slice(px, int(1 + (y0 + r) * 8 + x0), 4)))").alias("tile"))

    def detect(batch):
        grey = np.stack(batch["tile"].tolist()).reshape(-1, 4, 4) if len(batch) else np.zeros((0, 4, 4))
        bright = grey > 160
        some = bright.any(axis=(1, 2))
        columns, rows = bright.any(axis=1)[some], bright.any(axis=2)[some]
        end = lambda a: 4 - a[:, ::-1].argmax(axis=1)
        found = {"x1": columns.argmax(axis=1), "y1": rows.argmax(axis=1), "x2": end(columns), "y2": end(rows), "conf": grey[some].max(axis=(1, 2)) / 255}
        return pd.concat([batch.loc[some, ["vec_id", "x0", "y0"]].reset_index(drop=True), pd.DataFrame(found)], axis=1)

    return r6(C.detect_tiles(tiles, detect, "vec_id long, x0 long, y0 long, x1 long, y1 long, x2 long, y2 long, conf double").drop("x0", "y0"), "conf")


@query(f"""select c_custkey, n_faults, case when n_faults > 0 then 'rebuild' when coalesce(old = stamp, false) then 'validate' else 'profile' end as route
from (select o_custkey as c_custkey, count(*) filter (o_totalprice > 440000) as n_faults from orders group by 1) left join (select c_custkey, {STAMP_SQL} as stamp, {STORED_SQL} as old from customer) using (c_custkey)""")
def I11_routing_by_source(spark, sf_dir):
    """Sources with and without faults, with stamps that are current, old, unreadable and missing: all three routes."""
    faults = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count_if(F.col("o_totalprice") > 440000).alias("n_faults"))
    return T.routes(faults, I6_skip_if_current(spark, sf_dir), "c_custkey")


@query("""with k as (select ts_ms // 3600000 as hour, cls, sum(n_person) as n from ev group by all)
select hour, cls, n, round(case when t > 0 then n / cast(t as double) else 0 end, 6) as share from (select *, sum(n) over (partition by hour) as t from k)""")
def I12_class_shares(spark, sf_dir):
    """Of the boxes of each hour, how many are of each class; 0 where the hour has none."""
    by = view(spark, sf_dir, "ev").groupBy(F.expr("ts_ms div 3600000").alias("hour"), "cls").agg(F.sum("n_person").alias("n"))
    total = by.groupBy("hour").agg(F.sum("n").alias("_t"))
    return by.join(total, "hour").select("hour", "cls", "n", F.round(F.when(F.col("_t") > 0, F.col("n") / F.col("_t")).otherwise(0.0), 6).alias("share"))
