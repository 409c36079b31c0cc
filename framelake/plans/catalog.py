"""Registered queries over the driver tables, and DuckDB SQL for each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framelake.functions import geometry as G
from framelake.operators import boxes as B
from framelake.operators import frames as R
from framelake.operators import order as O
from framelake.operators import tracks as T
from framelake.plans import detections, files, inputs, reports, runs, stores, streams  # noqa: F401  they register their queries
from framelake.plans.registered import ALERT_SQL, LATE_SQL, KEY, ORACLES, QUERIES, SHARED_CLOCK_SQL, late_events, query, r6  # noqa: F401
from framelake.sources.adapters import table, view
from framelake.sources.scratch import cut

SPLIT_SQL = "case when sequence < 'seq12' then 'train' when sequence <= 'seq15' then 'val' else 'test' end"


def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotation rows as text, every 17th damaged."""
    ann = view(spark, sf_dir, "ann")
    cols = ["frame_index", "target_id", "bbox_left", "bbox_top", "bbox_width", "bbox_height", "score", "category"]
    line = F.concat_ws(",", *[F.col(c).cast("string") for c in cols], F.lit("0"), F.lit("0"))
    bad = F.when(F.col("target_id") == 17, F.concat_ws(",", F.lit("x"), *[F.col(c).cast("string") for c in cols[1:]])).when(F.col("target_id") == 34, F.lit("1,2,3")).otherwise(line)
    return ann.select("sequence", "line_no", bad.alias("line"))


NORM = """select *, (x1 + x2) / 2 as xc, (y1 + y2) / 2 as yc, x2 - x1 as w, y2 - y1 as h,
  case when category in (1, 2) then 0 when category in (4, 5, 6, 9) then 1 else 2 end as cls from (select *,
  greatest(0.0::double, least(1.0::double, bbox_left / 1000.0::double)) as x1, greatest(0.0::double, least(1.0::double, (bbox_left + bbox_width) / 1000.0::double)) as x2,
  greatest(0.0::double, least(1.0::double, bbox_top / 600.0::double)) as y1, greatest(0.0::double, least(1.0::double, (bbox_top + bbox_height) / 600.0::double)) as y2 from ann where {where})
  where x2 > x1 and y2 > y1"""
OK = "score <> 0 and category between 1 and 10"


@query(f"select sequence, cast(frame_index as int) as frame_index, cls, round(xc, 6) as xc, round(yc, 6) as yc, round(w, 6) as w, round(h, 6) as h from ({NORM.format(where=OK + ' and target_id not in (17, 34)')})")
def B1_parse_annotation(spark, sf_dir):
    return r6(B.parse_annotations(text_lines(spark, sf_dir)).select("sequence", "frame_index", "cls", "xc", "yc", "w", "h"), "xc", "yc", "w", "h")


@query(f"select sequence, frame_index, line_no, round(xc, 6) as xc, round(yc, 6) as yc, round(w, 6) as w, round(h, 6) as h from ({NORM.format(where='category between 1 and 10')})")
def B2_clip_normalise(spark, sf_dir):
    return r6(B.normalise(view(spark, sf_dir, "ann")).select(*KEY, "line_no", "xc", "yc", "w", "h"), "xc", "yc", "w", "h")


@query("select category, case when category in (1, 2) then 0 when category in (4, 5, 6, 9) then 1 when category in (3, 7, 8, 10) then 2 end as cls, count(*) as n from ann group by all")
def B3_category_merge(spark, sf_dir):
    return view(spark, sf_dir, "ann").groupBy("category", G.merged_class(F.col("category")).alias("cls")).agg(F.count(F.lit(1)).alias("n"))


B4_SQL = """select distinct split, sequence, frame_index from (select *, case when sequence < 'seq12' then 'train'
  when sequence <= 'seq15' then 'val' else 'test' end as split from ann)
  where (frame_index - 1) % (case when split = 'train' then 5 else 20 end) = 0"""


@query(B4_SQL)
def B4_frame_stride(spark, sf_dir):
    """Every 20th frame, of the train split every fifth."""
    frames = view(spark, sf_dir, "ann").select(F.expr(SPLIT_SQL).alias("split"), *KEY)
    return B.keep_stride(frames, 20, 5).distinct()


@query("select distinct sequence, frame_index from ann where frame_index >= 40 and frame_index < 65")
def B5_clip_window(spark, sf_dir):
    return B.clip_window(view(spark, sf_dir, "ann").select(*KEY), 40, 25).distinct()


@query("select distinct sequence || '_' || lpad(cast(frame_index as varchar), 7, '0') as name, 'images/train/' || sequence || '_' || lpad(cast(frame_index as varchar), 7, '0') || '.jpg' as image, 'labels/train/' || sequence || '_' || lpad(cast(frame_index as varchar), 7, '0') || '.txt' as label from ann")
def B6_addresses(spark, sf_dir):
    name = F.format_string("%s_%07d", "sequence", "frame_index")
    return view(spark, sf_dir, "ann").select(name.alias("name"), F.concat(F.lit("images/train/"), name, F.lit(".jpg")).alias("image"), F.concat(F.lit("labels/train/"), name, F.lit(".txt")).alias("label")).distinct()


@query("select sequence, frame_index, line_no, bbox_width * bbox_height as area, round(case when bbox_height > 0 then bbox_width / cast(bbox_height as double) else 0 end, 6) as aspect from ann")
def B7_box_stats(spark, sf_dir):
    aspect = F.when(F.col("bbox_height") > 0, F.col("bbox_width") / F.col("bbox_height").cast("double")).otherwise(0.0)
    return view(spark, sf_dir, "ann").select(*KEY, "line_no", F.expr("bbox_width * bbox_height").alias("area"), F.round(aspect, 6).alias("aspect"))


EDGE = """case when i // 8 in (0, 7) or i % 8 in (0, 7) then px[i + 1] else least(255.0::double, greatest(0.0::double,
  9 * px[i + 1] - (px[i - 8] + px[i - 7] + px[i - 6] + px[i] + px[i + 1] + px[i + 2] + px[i + 8] + px[i + 9] + px[i + 10]))) end"""
READ = f"select vec_id, label, avg(px[i + 1]) as brightness, stddev_pop(px[i + 1]) as contrast, var_pop({EDGE}) as blur from fr, generate_series(0, 63) g(i) group by vec_id, label"


@query(f"select vec_id, label, round(brightness, 6) as brightness, round(contrast, 6) as contrast, cast(round(blur * 4096) as bigint) as blur_4096 from ({READ})")
def B14_frame_readings(spark, sf_dir):
    return R.readings(view(spark, sf_dir, "fr")).select("vec_id", "label", F.round("brightness", 6).alias("brightness"), F.round("contrast", 6).alias("contrast"), F.round(F.col("blur") * 4096).cast("long").alias("blur_4096"))


#: frames shifted so that all four flags occur: by number, as they are, darkened, brightened, flattened, or both dark and flat
SHIFT = """case vec_id % 5 when 1 then floor(p * 0.1D) when 2 then floor(255 - (255 - p) * 0.05D) when 3 then floor(127 + (p - 127) * 0.02D)
  when 4 then floor(p * 0.01D) else p end"""
B8_SQL = f"""with shifted as (select vec_id, label, list_transform(px, lambda p: cast({SHIFT.replace('D)', '::double)')} as double)) as px from fr)
select vec_id, f.flag as flag, f.detail as detail from (select vec_id, unnest(list_filter([
  case when brightness < 20 then {{'flag': 'dark', 'detail': printf('brightness=%.2f', brightness)}} end,
  case when brightness > 235 then {{'flag': 'bright', 'detail': printf('brightness=%.2f', brightness)}} end,
  case when contrast < 10 then {{'flag': 'low_contrast', 'detail': printf('contrast=%.2f', contrast)}} end,
  case when blur < 50 then {{'flag': 'blurry', 'detail': printf('blur=%.2f', blur)}} end], lambda x: x is not null)) as f from
    (select vec_id, avg(v) as brightness, sqrt((sum(v * v) - sum(v) * sum(v) / 64) / 64) as contrast, (sum(e * e) - sum(e) * sum(e) / 64) / 64 as blur
     from (select vec_id, px[i + 1] as v, {EDGE} as e from shifted, generate_series(0, 63) g(i)) group by vec_id))"""


@query(B8_SQL)
def B8_quality_flags(spark, sf_dir):
    shifted = view(spark, sf_dir, "fr").withColumn("px", F.expr(f"transform(px, p -> cast({SHIFT} as double))"))
    return R.quality_flags(R.readings(shifted)).select("vec_id", "flag", "detail")


@query("select vec_id, string_agg(case when px[i + 2] > px[i + 1] then '1' else '0' end, '' order by i) as dhash from fr, generate_series(0, 63) g(i) where i % 8 < 7 group by vec_id")
def B15_dhash(spark, sf_dir):
    return R.dhash(view(spark, sf_dir, "fr")).select("vec_id", "dhash")


@query("select vec_id, round(avg(least(255.0::double, p * 1.5::double)), 6) as brightness from (select vec_id, unnest(px) as p from fr) group by vec_id")
def B16_brightness_shift(spark, sf_dir):
    px = F.transform("px", lambda x: F.least(F.lit(255.0), x * 1.5))
    return view(spark, sf_dir, "fr").select("vec_id", F.round(F.aggregate(px, F.lit(0.0), lambda s, x: s + x) / F.size("px"), 6).alias("brightness"))


@query("select sequence, frame_index, line_no, round((bbox_left + bbox_width / 2.0::double) / 1000, 6) as xc, round((bbox_top + bbox_height / 2.0::double) / 600, 6) as yc, round(bbox_width / 1000.0::double, 6) as w, round(bbox_height / 600.0::double, 6) as h from ann")
def B9_box_forms(spark, sf_dir):
    e = {"xc": "(bbox_left + bbox_width / 2D) / 1000", "yc": "(bbox_top + bbox_height / 2D) / 600", "w": "bbox_width / 1000D", "h": "bbox_height / 600D"}
    return view(spark, sf_dir, "ann").select(*KEY, "line_no", *[F.round(F.expr(x), 6).alias(c) for c, x in e.items()])


B10_SQL = """with s as (select w, h, gain, new_w, new_h, cast(round_even((640 - new_w) / 2.0::double - 0.1::double, 0) as bigint) as pad_x, cast(round_even((640 - new_h) / 2.0::double - 0.1::double, 0) as bigint) as pad_y
  from (select w, h, gain, cast(round_even(w * gain, 0) as bigint) as new_w, cast(round_even(h * gain, 0) as bigint) as new_h
    from (select distinct 100 + bbox_left as w, 60 + bbox_top as h, least(640 / cast(60 + bbox_top as double), 640 / cast(100 + bbox_left as double)) as gain from ann)))
select w, h, new_w, new_h, pad_x as "left", pad_y as top, round(greatest(0, least(w, (10.5::double - pad_x) / gain)), 9) as x1, round(greatest(0, least(h, (200 - pad_y) / gain)), 9) as y1,
  round(greatest(0, least(w, (500 - pad_x) / gain)), 9) as x2, round(greatest(0, least(h, (639.5::double - pad_y) / gain)), 9) as y2 from s"""


@query(B10_SQL)
def B10_letterbox(spark, sf_dir):
    """Sizes into the letterbox, and one box of it back into each source."""
    sizes = view(spark, sf_dir, "ann").selectExpr("100 + bbox_left as w", "60 + bbox_top as h").distinct()
    boxes = B.letterbox(sizes, 640, 640).selectExpr("*", "10.5D as x1", "200D as y1", "500D as x2", "639.5D as y2")
    return B.unletterbox(boxes).select("w", "h", "new_w", "new_h", "left", "top", *[F.round(c, 9).alias(c) for c in G.CORNERS])


@query("select sequence, frame_index, count(*) as n from det where conf >= 0.25::double group by all")
def B11_confidence_floor(spark, sf_dir):
    return view(spark, sf_dir, "det").where("conf >= 0.25D").groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))


INTER = "greatest(0, least(d.x2, g.x2) - greatest(d.x1, g.x1)) * greatest(0, least(d.y2, g.y2) - greatest(d.y1, g.y1))"
AREAS = "(d.x2 - d.x1) * (d.y2 - d.y1) + (g.x2 - g.x1) * (g.y2 - g.y1)"
PAIRS = f"select d.sequence, d.frame_index, d.cls, d.x1 as dx1, d.y1 as dy1, d.conf, g.x1 as gx1, g.y1 as gy1, {INTER} / cast({AREAS} - {INTER} as double) as iou, {INTER} / (cast(least((d.x2 - d.x1) * (d.y2 - d.y1), (g.x2 - g.x1) * (g.y2 - g.y1)) as double) + 1e-9::double) as ios from det d join gt g on d.sequence = g.sequence and d.frame_index = g.frame_index and d.cls = g.cls where {INTER} > 0"


@query(f"select sequence, frame_index, cls, dx1, dy1, gx1, gy1, round(iou, 6) as iou from ({PAIRS})")
def B12_iou_C4_candidates(spark, sf_dir):
    out = B.candidates(view(spark, sf_dir, "det"), view(spark, sf_dir, "gt"), [*KEY, "cls"])
    return out.selectExpr(*KEY, "cls", "d_x1 as dx1", "d_y1 as dy1", "g_x1 as gx1", "g_y1 as gy1", "round(iou, 6) as iou")


@query(f"select sequence, frame_index, cls, dx1, dy1, gx1, gy1, round(ios, 6) as ios from ({PAIRS})")
def B13_ios(spark, sf_dir):
    out = B.candidates(view(spark, sf_dir, "det"), view(spark, sf_dir, "gt"), [*KEY, "cls"]).withColumn("ios", F.round(G.ios("d_", "g_"), 6))
    return out.selectExpr(*KEY, "cls", "d_x1 as dx1", "d_y1 as dy1", "g_x1 as gx1", "g_y1 as gy1", "ios")


TILES = """select w, h, x0, y0 from (select w, h, unnest(case when w <= 400 then [0] else list_distinct(list_concat(range(0, w - 399, 320), [w - 400])) end) as x0 from (select distinct 300 + bbox_left as w, 200 + bbox_top as h from ann)) a,
  lateral (select unnest(case when h <= 400 then [0] else list_distinct(list_concat(range(0, h - 399, 320), [h - 400])) end) as y0) b"""


@query(TILES)
def B17_tile_grid(spark, sf_dir):
    sizes = view(spark, sf_dir, "ann").selectExpr("300 + bbox_left as w", "200 + bbox_top as h").distinct()
    return B.tiles(sizes, 400).select("w", "h", "x0", "y0")


@query(f"select round(avg(n + 1), 6) as passes from (select w, h, count(*) as n from ({TILES}) group by w, h)")
def D25_passes_per_frame(spark, sf_dir):
    return B17_tile_grid(spark, sf_dir).groupBy("w", "h").agg((F.count(F.lit(1)) + 1).alias("n")).agg(F.round(F.avg("n"), 6).alias("passes"))


@query("select sequence, frame_index, count(*) as n_boxes, count(*) filter (cls = 0) as n_person, count(*) filter (cls = 1) as n_vehicle, count(*) filter (cls = 2) as n_two_three_wheeler from (select *, case when category in (1, 2) then 0 when category in (4, 5, 6, 9) then 1 else 2 end as cls from ann where category between 1 and 10) group by all")
def D7_class_counts(spark, sf_dir):
    boxes = view(spark, sf_dir, "ann").withColumn("cls", G.merged_class(F.col("category"))).where("cls is not null")
    names = ("n_person", "n_vehicle", "n_two_three_wheeler")
    return boxes.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_boxes"), *[F.count_if(F.col("cls") == k).alias(n) for k, n in enumerate(names)])


@query("select source, lang, sha256(text) as hash, count(*) as n from documents group by all")
def B24_content_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("source", "lang", F.sha2("text", 256).alias("hash")).agg(F.count(F.lit(1)).alias("n"))


B25_SQL = """select sequence, frame_index, line_no, x0 as x1, y0 as y1, greatest(x0 + 1, least(1000, cast(trunc(r + pad_x) as bigint))) as x2,
    greatest(y0 + 1, least(600, cast(trunc(b + pad_y) as bigint))) as y2
  from (select *, greatest(0, cast(trunc(l - pad_x) as bigint)) as x0, greatest(0, cast(trunc(t - pad_y) as bigint)) as y0
    from (select sequence, frame_index, line_no, bbox_left::double as l, bbox_top::double as t, (bbox_left + bbox_width)::double as r, (bbox_top + bbox_height)::double as b,
        greatest(0.2::double * bbox_width, 16) as pad_x, greatest(0.2::double * bbox_height, 16) as pad_y from ann))"""


@query(B25_SQL)
def B25_crop_window(spark, sf_dir):
    boxes = view(spark, sf_dir, "ann").selectExpr(*KEY, "line_no", "double(bbox_left) as x1", "double(bbox_top) as y1", "double(bbox_left + bbox_width) as x2", "double(bbox_top + bbox_height) as y2")
    return B.crop_window(boxes, 1000, 600).selectExpr(*KEY, "line_no", "cx1 as x1", "cy1 as y1", "cx2 as x2", "cy2 as y2")


@query("select case when w >= 3840 then '3840px' when w >= 2688 then '2688px' else '1904px' end as resolution, count(*) as n from (select bbox_left * 4 as w from ann) group by 1")
def B26_resolution_group(spark, sf_dir):
    w = F.col("bbox_left") * 4
    name = F.when(w >= 3840, "3840px").when(w >= 2688, "2688px").otherwise("1904px")
    return view(spark, sf_dir, "ann").groupBy(name.alias("resolution")).agg(F.count(F.lit(1)).alias("n"))


@query("select a.sequence, a.frame_index, a.line_no, a.target_id from ann a where exists (select 1 from ann f where f.sequence = a.sequence and f.frame_index = a.frame_index and f.category = 1)")
def C1_existing_frames(spark, sf_dir):
    ann = view(spark, sf_dir, "ann")
    return ann.join(ann.where("category = 1").select(*KEY), KEY, "left_semi").select(*KEY, "line_no", "target_id")


@query("select coalesce(a.sequence, b.sequence) as sequence, coalesce(a.frame_index, b.frame_index) as frame_index, case when a.sequence is null then 'no image' else 'no label' end as fault from (select distinct sequence, frame_index from ann where category = 2) a full join (select distinct sequence, frame_index from ann where category = 3) b on a.sequence = b.sequence and a.frame_index = b.frame_index where a.sequence is null or b.sequence is null")
def C2_pairing(spark, sf_dir):
    ann = view(spark, sf_dir, "ann")
    a, b = (ann.where(f"category = {k}").select(*KEY).distinct().withColumn(n, F.lit(True)) for k, n in ((2, "image"), (3, "label")))
    return a.join(b, KEY, "full").where("image is null or label is null").select(*KEY, F.when(F.col("image").isNull(), "no image").otherwise("no label").alias("fault"))


C5_SQL = """with b as (select row_number() over () as id, sequence, frame_index, target_id, bbox_left, bbox_top, bbox_width, bbox_height, least(greatest(bbox_left, 1), 1000) as bx1, least(1000, greatest(bbox_left, 1) + greatest(bbox_width, 1)) as bx2, least(greatest(bbox_top, 1), 600) as by1, least(600, greatest(bbox_top, 1) + greatest(bbox_height, 1)) as by2 from ann where category between 1 and 10),
r as (select sequence, frame_index, greatest(bbox_left, 1) - 1 as x1, least(1000, greatest(bbox_left, 1) + greatest(bbox_width, 1)) - 0 as x2, greatest(bbox_top, 1) - 1 as y1, least(600, greatest(bbox_top, 1) + greatest(bbox_height, 1)) as y2 from ann where category = 0),
hit as (select id, greatest(x1, bx1) as a1, least(x2, bx2) as a2, greatest(y1, by1) as b1, least(y2, by2) as b2 from b join r using (sequence, frame_index)),
cells as (select id, count(*) as covered from (select distinct id, x, y from (select *, unnest(range(b1, b2)) as y from (select *, unnest(range(a1, a2)) as x from hit where a2 > a1 and b2 > b1))) group by id)
select sequence, frame_index, target_id, bbox_left, bbox_top, bbox_width, bbox_height, coalesce(covered, 0) as covered from b left join cells using (id) where coalesce(covered, 0) < 0.5 * greatest(bbox_width, 1) * greatest(bbox_height, 1)"""


@query(C5_SQL)
def C5_ignored_regions(spark, sf_dir):
    ann = view(spark, sf_dir, "ann")
    names = {"bbox_left": "x", "bbox_top": "y", "bbox_width": "w", "bbox_height": "h"}
    boxes = ann.where("category between 1 and 10").withColumnsRenamed(names).select(*KEY, "target_id", *"xywh")
    regions = ann.where("category = 0").withColumnsRenamed({k: "r" + v for k, v in names.items()})
    out = B.not_ignored(boxes, regions, KEY, 1000, 600)
    return out.withColumnsRenamed({v: k for k, v in names.items()}).select(*KEY, "target_id", *names, "covered")




@query(f"select split, n as kept, total - n as dropped from (select {SPLIT_SQL} as split, count(*) as n from (select * from c5) group by 1) join (select {SPLIT_SQL} as split, count(*) as total from ann where category between 1 and 10 group by 1) using (split)".replace("(select * from c5)", f"({C5_SQL})"))
def D24_rule_effect(spark, sf_dir):
    split = F.expr(SPLIT_SQL).alias("split")
    total = view(spark, sf_dir, "ann").where("category between 1 and 10").groupBy(split).agg(F.count(F.lit(1)).alias("total"))
    kept = C5_ignored_regions(spark, sf_dir).groupBy(split).agg(F.count(F.lit(1)).alias("kept"))
    return kept.join(total, "split").select("split", "kept", F.expr("total - kept as dropped"))


@query("select sequence, frame_index from (select distinct sequence, frame_index from gt) where (sequence, frame_index) not in (select (sequence, frame_index) from det)")
def C6_completeness(spark, sf_dir):
    return view(spark, sf_dir, "gt").select(*KEY).distinct().join(view(spark, sf_dir, "det").select(*KEY), KEY, "left_anti")


@query("select l_orderkey, l_linenumber, count(*) as n from lineitem group by all having count(*) > 1")
def C7_uniqueness(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


STATS_SQL = "count(*) as n, round(avg({c}), 6) as mean, round(stddev_pop({c}), 6) as std, min({c}) as low, max({c}) as high"


def stats(c: str):
    return [F.count(F.lit(1)).alias("n"), F.round(F.avg(c), 6).alias("mean"), F.round(F.stddev_pop(c), 6).alias("std"), F.min(c).alias("low"), F.max(c).alias("high")]


@query(f"select l_returnflag, {STATS_SQL.format(c='l_extendedprice')} from lineitem group by 1")
def D1_statistics(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(*stats("l_extendedprice"))


@query(f"select split, {STATS_SQL.format(c='b')} from (select case when vec_id % 5 < 3 then 'train' else 'live' end as split, round(brightness, 6) as b from ({READ})) group by 1")
def D2_split_statistics(spark, sf_dir):
    read = R.readings(view(spark, sf_dir, "fr")).select(F.when(F.col("vec_id") % 5 < 3, "train").otherwise("live").alias("split"), F.round("brightness", 6).alias("b"))
    return read.groupBy("split").agg(*stats("b"))


@query(f"select cls, {STATS_SQL.format(c='area')} from (select bbox_width * bbox_height as area, category % 3 as cls from ann where category between 1 and 10) group by 1")
def D3_class_statistics(spark, sf_dir):
    return view(spark, sf_dir, "ann").where("category between 1 and 10").selectExpr("bbox_width * bbox_height as area", "category % 3 as cls").groupBy("cls").agg(*stats("area"))


SCENES = f"select label, count(*) as n_frames, avg(brightness) as brightness, avg(contrast) as contrast, avg(blur) as blur from ({READ}) where vec_id % 5 < 3 group by label"
REF_SQL = f"""s as (select brightness, contrast, ln(greatest(blur, 1e-6)) as blur from ({SCENES})),
c as (select avg(brightness) as cb, stddev_pop(brightness) as sb, avg(contrast) as cc, stddev_pop(contrast) as sc, avg(blur) as cl, stddev_pop(blur) as sl from s),
ref as (select any_value(cb) as cb, any_value(sb) as sb, any_value(cc) as cc, any_value(sc) as sc, any_value(cl) as cl, any_value(sl) as sl, max(abs(brightness - cb) / sb) as tb, max(abs(contrast - cc) / sc) as tc, max(abs(blur - cl) / sl) as tl from s, c)"""
WIN_SQL = f"""w as (select (k - 1) // 10 as window_id, avg(brightness) as brightness, avg(contrast) as contrast, avg(blur) as blur, count(*) as n_frames from (select *, row_number() over (order by vec_id) as k from ({READ}) where vec_id % 5 >= 3) group by 1 having count(*) = 10),
v as (select window_id, abs(brightness - cb) / sb as score_brightness, abs(contrast - cc) / sc as score_contrast, abs(ln(greatest(blur, 1e-6)) - cl) / sl as score_blur, abs(brightness - cb) / sb > tb or abs(contrast - cc) / sc > tc or abs(ln(greatest(blur, 1e-6)) - cl) / sl > tl as drifted from w, ref)"""


def _drift(spark, sf_dir):
    read = cut(R.readings(view(spark, sf_dir, "fr")).select("vec_id", "label", *R.STATS), "readings")  # folded once
    ref = R.reference(R.baseline(read.where("vec_id % 5 < 3"), "label"))
    means = R.window_means(R.count_windows(read.where("vec_id % 5 >= 3").select("vec_id", *R.STATS), ["vec_id"], 10))
    return ref, R.verdicts(means, ref)


@query(f"select label, n_frames, round(brightness, 6) as brightness, round(contrast, 6) as contrast, round(blur, 4) as blur from ({SCENES})")
def D4_drift_baseline(spark, sf_dir):
    out = R.baseline(R.readings(view(spark, sf_dir, "fr")).where("vec_id % 5 < 3"), "label")
    return r6(out, "brightness", "contrast").withColumn("blur", F.round("blur", 4))


@query(f"with {REF_SQL} select round(cb, 5) as centre_brightness, round(sb, 5) as spread_brightness, round(tb, 5) as threshold_brightness, round(cc, 5) as centre_contrast, round(sc, 5) as spread_contrast, round(tc, 5) as threshold_contrast, round(cl, 5) as centre_blur, round(sl, 5) as spread_blur, round(tl, 5) as threshold_blur from ref")
def D12_drift_reference(spark, sf_dir):
    ref, _ = _drift(spark, sf_dir)
    return ref.withColumns({c: F.round(c, 5) for c in ref.columns})


@query(f"with {REF_SQL}, {WIN_SQL} select window_id, round(score_brightness, 5) as score_brightness, round(score_contrast, 5) as score_contrast, round(score_blur, 5) as score_blur, drifted from v")
def D13_drift_verdicts(spark, sf_dir):
    _, judged = _drift(spark, sf_dir)
    return judged.select("window_id", *[F.round(f"score_{c}", 5).alias(f"score_{c}") for c in R.STATS], "drifted")


@query(f"with {REF_SQL}, {WIN_SQL} select window_id, round(score_brightness, 5) as score_brightness, round(score_contrast, 5) as score_contrast, round(score_blur, 5) as score_blur from (select *, row_number() over (partition by run order by window_id) as k from (select *, sum(case when drifted then 0 else 1 end) over (order by window_id) as run from v) where drifted) where k = 2")
def E5_drift_episodes(spark, sf_dir):
    _, judged = _drift(spark, sf_dir)
    return R.episodes(judged).select("window_id", *[F.round(f"score_{c}", 5).alias(f"score_{c}") for c in R.STATS])


@query("select (k // 5 - 1) // 100 as window_id, count(*) as n, min(event_id) as first_id, max(event_id) as last_id from (select event_id, row_number() over (order by event_id) as k from events) where k % 5 = 0 group by 1 having count(*) = 100")
def E6_count_windows(spark, sf_dir):
    out = R.count_windows(table(spark, sf_dir, "events").select("event_id"), ["event_id"], 100, 5)
    return out.groupBy("window_id").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


@query("select window_id, pos, event_id from (select event_id, (k - 1) // 100 as window_id, (k - 1) % 100 as pos, count(*) over (partition by (k - 1) // 100) as n from (select event_id, row_number() over (order by event_id) as k from events)) where n = 100 and pos in (0, 50, 99)")
def E7_evidence_picks(spark, sf_dir):
    return R.count_windows(table(spark, sf_dir, "events").select("event_id"), ["event_id"], 100).where("pos in (0, 50, 99)").select("window_id", "pos", "event_id")


@query("select doc_id, hash, n from (select doc_id, sha256(text) as hash, count(*) over (partition by sha256(text)) as n from documents) where n > 1")
def D5_duplicate_clusters(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("hash"))
    large = docs.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return docs.join(large, "hash").select("doc_id", "hash", "n")


@query("select count(distinct sequence || frame_index) as frames, count(*) as boxes, count(distinct sequence) as sequences, count(*) filter (score = 0) as unscored from ann")
def D6_totals(spark, sf_dir):
    ann = view(spark, sf_dir, "ann")
    frames = ann.groupBy(*KEY).agg(F.count(F.lit(1)).alias("b"), F.count_if(F.col("score") == 0).alias("u"))
    return frames.agg(F.count(F.lit(1)).alias("frames"), F.sum("b").alias("boxes"), F.countDistinct("sequence").alias("sequences"), F.sum("u").alias("unscored"))


@query("select rule, count(*) as n from (select unnest(list_filter([case when category not between 1 and 10 then 'class' end, case when bbox_height <= 0 then 'height' end, case when bbox_left + bbox_width > 1000 then 'x range' end, case when bbox_top + bbox_height > 600 then 'y range' end], lambda x: x is not null)) as rule from ann) group by 1")
def D8_validation(spark, sf_dir):
    return view(spark, sf_dir, "ann").select(F.explode(B.faults()).alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


@query("select cls, count(*) as n_events, round(sum(n_person) / count(*), 6) as boxes_per_event, round(avg(conf), 6) as mean_conf, round(count(*) / cast((select count(*) from ev) as double), 6) as share from ev group by cls")
def D10_prediction_health(spark, sf_dir):
    by = view(spark, sf_dir, "ev").groupBy("cls").agg(F.count(F.lit(1)).alias("n_events"), F.round(F.sum("n_person") / F.count(F.lit(1)), 6).alias("boxes_per_event"), F.round(F.avg("conf"), 6).alias("mean_conf"))
    return by.withColumn("share", F.round(F.col("n_events") / F.sum("n_events").over(Window.partitionBy(F.lit(1))), 6))


D15_SQL = """with f as (select l_orderkey as frame, l_returnflag as stage, sum(l_extendedprice / 1000) as ms from lineitem group by all),
w as (select case when count(*) > 3 then max(frame) end as least_frame from (select distinct frame from f order by frame limit 4)),
k as (select stage, ms from f, w where frame >= coalesce(least_frame, frame) union all select 'total', sum(ms) from f, w where frame >= coalesce(least_frame, frame) group by frame)
select stage, round(quantile_cont(ms, 0.5), 8) as p50, round(quantile_cont(ms, 0.95), 8) as p95, round(quantile_cont(ms, 0.99), 8) as p99, round(avg(ms), 6) as mean, count(*) as n from k group by 1"""


@query(D15_SQL)
def D15_latency(spark, sf_dir):
    """Of each stage and of all stages of a frame together, without the first three frames."""
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("frame"), F.col("l_returnflag").alias("stage")).agg(F.sum(F.col("l_extendedprice") / 1000).alias("ms"))
    return r6(R.latency(rows), "mean").withColumns({c: F.round(c, 8) for c in ("p50", "p95", "p99")})


@query("select coalesce(a.cls, b.cls) as cls, round(coalesce(a.n, 0) / cast(b.n as double), 6) as ratio from (select cls, count(*) as n from det group by 1) a full join (select cls, count(*) as n from gt group by 1) b on a.cls = b.cls")
def D17_label_ratio(spark, sf_dir):
    a, b = (view(spark, sf_dir, v).groupBy("cls").agg(F.count(F.lit(1)).alias(v)) for v in ("det", "gt"))
    return a.join(b, "cls", "full").select("cls", F.round(F.coalesce("det", F.lit(0)) / F.col("gt"), 6).alias("ratio"))


@query("select count(*) filter (top <= 3) as within_cap, count(*) as frames, round(1 - sum(over_cap) / cast(sum(n) as double), 6) as recall_ceiling from (select sequence, frame_index, max(c) as top, sum(greatest(0, c - 3)) as over_cap, sum(c) as n from (select sequence, frame_index, category, count(*) as c from ann where category between 1 and 10 group by all) group by 1, 2)")
def D18_cap_readings(spark, sf_dir):
    cats = view(spark, sf_dir, "ann").where("category between 1 and 10").groupBy(*KEY, "category").agg(F.count(F.lit(1)).alias("c"))
    frames = cats.groupBy(*KEY).agg(F.max("c").alias("top"), F.sum(F.greatest(F.lit(0), F.col("c") - 3)).alias("o"), F.sum("c").alias("n"))
    return frames.agg(F.count_if(F.col("top") <= 3).alias("within_cap"), F.count(F.lit(1)).alias("frames"), F.round(1 - F.sum("o") / F.sum("n"), 6).alias("recall_ceiling"))


@query("select round(avg(coalesce(n, 0)), 6) as per_image from (select distinct sequence, frame_index from ann) left join (select sequence, frame_index, count(*) as n from det group by all) using (sequence, frame_index)")
def D19_boxes_per_image(spark, sf_dir):
    n = view(spark, sf_dir, "det").groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))
    return view(spark, sf_dir, "ann").select(*KEY).distinct().join(n, KEY, "left").agg(F.round(F.avg(F.coalesce("n", F.lit(0))), 6).alias("per_image"))


@query("select sequence, max(n) as peak from (select sequence, frame_index, count(distinct target_id) as n from ann group by 1, 2) group by 1")
def D26_peak_tracks(spark, sf_dir):
    return view(spark, sf_dir, "ann").groupBy(*KEY).agg(F.countDistinct("target_id").alias("n")).groupBy("sequence").agg(F.max("n").alias("peak"))


@query("select sequence, target_id, line_no, bbox_left from (select *, row_number() over (partition by sequence, target_id order by frame_index desc, line_no desc, bbox_left desc, bbox_top desc, bbox_width desc, bbox_height desc, score desc, category desc) as k from ann) where k = 1")
def E1_latest_per_key(spark, sf_dir):
    order = [F.col(c).desc() for c in ("frame_index", "line_no", "bbox_left", "bbox_top", "bbox_width", "bbox_height", "score", "category")]
    return O.top_k(view(spark, sf_dir, "ann"), ["sequence", "target_id"], order, 1).select("sequence", "target_id", "line_no", "bbox_left")


@query("select sequence, arrival, max(ts_ms) over (order by arrival) as watermark from ev")
def E2_watermark(spark, sf_dir):
    """One clock for all sequences."""
    return O.running_max(view(spark, sf_dir, "ev"), ["arrival"], "ts_ms", "watermark").select("sequence", "arrival", "watermark")


@query("select arrival, round(avg(n_person) over w, 6) as mean, count(*) over w as n_frames from ev window w as (partition by sequence order by ts_ms range between 21600000 preceding and current row)")
def E3_sliding_mean(spark, sf_dir):
    return O.sliding_mean(view(spark, sf_dir, "ev"), "sequence", "ts_ms", "n_person", 21_600_000).select("arrival", F.round("mean", 6).alias("mean"), "n_frames")


@query("select arrival, sequence from (select arrival, sequence, mean > 5 as crossed, coalesce(lag(mean > 5) over (partition by sequence order by arrival), false) as before from (select *, avg(n_person) over (partition by sequence order by ts_ms range between 21600000 preceding and current row) as mean from ev)) where crossed and not before")
def E4_fire_once(spark, sf_dir):
    read = O.sliding_mean(view(spark, sf_dir, "ev"), "sequence", "ts_ms", "n_person", 21_600_000)
    return O.fire_once(read, "sequence", "arrival", 5).where("alert").select("arrival", "sequence")


@query(SHARED_CLOCK_SQL)
def E4_fire_once_shared_clock(spark, sf_dir):
    """One clock for all sequences: one that is silent for longer than the window, while others go on, may fire anew."""
    clocked = O.running_max(view(spark, sf_dir, "ev"), ["arrival"], "ts_ms", "clock", -1)
    read = O.sliding_mean(clocked, "sequence", "ts_ms", "n_person", 21_600_000)
    return O.fire_once(read, "sequence", "arrival", 5, "ts_ms", "clock", 21_600_000).where("alert").select("arrival", "sequence")


@query(f"{LATE_SQL} select arrival, sequence, n_frames, round(total / n_frames, 6) as mean from m where n_frames > 0")
def E3_live_means(spark, sf_dir):
    """Means over live frames where frames come late, out of order and again."""
    return O.live_readings(late_events(spark, sf_dir), 21_600_000).select("arrival", "sequence", "n_frames", F.round("mean", 6).alias("mean"))


@query(ALERT_SQL)
def E4_alerts_all_arrivals(spark, sf_dir):
    """The alert rule in full: one clock, late and repeated frames, sequences that fall silent."""
    return O.alerts(late_events(spark, sf_dir), 21_600_000, 5).select("arrival", "sequence", "n_frames", F.round("mean", 6).alias("mean"))


@query("select arrival, sequence, cast(sum(case when before is null or before <> sequence then 1 else 0 end) over (order by arrival) as bigint) as session from (select *, lag(sequence) over (order by arrival) as before from ev)")
def E8_sessions(spark, sf_dir):
    return O.sessions(view(spark, sf_dir, "ev"), "arrival", "sequence").select("arrival", "sequence", "session")


@query("select sequence, cast(sum(greatest(0, coalesce(gap, 0))) as bigint) as lost, count(*) as n from (select sequence, frame_index - lag(frame_index) over (partition by sequence order by arrival) - 1 as gap from ev) group by 1")
def E8_index_gaps(spark, sf_dir):
    return O.index_gaps(view(spark, sf_dir, "ev"), "sequence", "arrival", "frame_index").groupBy("sequence").agg(F.sum("gap").alias("lost"), F.count(F.lit(1)).alias("n"))


@query("select sequence, frame_index, cls, x1, y1, conf from (select *, row_number() over (partition by sequence, frame_index order by conf desc, cls, x1, y1, x2, y2) as k from det) where k <= 3")
def E9_top_k(spark, sf_dir):
    return O.top_k(view(spark, sf_dir, "det"), KEY, [F.col("conf").desc(), "cls", "x1", "y1", "x2", "y2"], 3).select(*KEY, "cls", "x1", "y1", "conf")


@query("select sequence, frame_index, cls, x1, y1, x2, y2, max(conf) as conf from det group by all")
def E12_same_box(spark, sf_dir):
    return view(spark, sf_dir, "det").groupBy(*KEY, "cls", "x1", "y1", "x2", "y2").agg(F.max("conf").alias("conf"))


@query("select name, run_id, metric from (select *, row_number() over (partition by name order by start_time desc, run_id desc) as k from runs where status = 'FINISHED') where k = 1")
def E17_latest_run(spark, sf_dir):
    return O.top_k(view(spark, sf_dir, "runs").where("status = 'FINISHED'"), ["name"], [F.col("start_time").desc(), F.col("run_id").desc()], 1).select("name", "run_id", "metric")


E18_SQL = """select c_custkey, cast(coalesce(max(step) + 1, 0) as bigint) as next_step from customer
  left join (select o_custkey, (o_orderkey * 7) % 101 as step from orders where o_orderkey % 3 > 0) on c_custkey = o_custkey group by 1"""


@query(E18_SQL)
def E18_next_step(spark, sf_dir):
    """Steps of a record have gaps; it goes on after the highest."""
    history = table(spark, sf_dir, "orders").where("o_orderkey % 3 > 0").selectExpr("o_custkey as c_custkey", "(o_orderkey * 7) % 101 as step")
    return O.next_step(table(spark, sf_dir, "customer"), history, "c_custkey")


@query("select sequence, frame_index from ann where category = 1 union all select sequence, frame_index from ann where score = 0")
def F1_union(spark, sf_dir):
    ann = view(spark, sf_dir, "ann")
    return ann.where("category = 1").select(*KEY).unionByName(ann.where("score = 0").select(*KEY))


@query("select distinct sha256(text) as hash from documents")
def F2_distinct(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("hash")).distinct()


@query("select sequence, frame_index from ann where category = 1 except select sequence, frame_index from ann where score = 0")
def F3_except(spark, sf_dir):
    ann = view(spark, sf_dir, "ann")
    return ann.where("category = 1").select(*KEY).subtract(ann.where("score = 0").select(*KEY))


@query("select sequence, frame_index from ann where category = 1 intersect select sequence, frame_index from ann where score = 0")
def F4_intersect(spark, sf_dir):
    ann = view(spark, sf_dir, "ann")
    return ann.where("category = 1").select(*KEY).intersect(ann.where("score = 0").select(*KEY))


#: a run's four metrics, made of its total and key; a missing one is 0 in the gate
GATED = {"map5095": 0.3, "map50": 0.5, "precision": 0.2, "recall": 0.25}
METRICS_SQL = """select name, status, max(metric) as map5095, max(metric * (1 + run_id % 3) / 2) as map50, max(case when run_id % 4 > 0 then metric / 2 end) as precision,
  max(case when priority = '1-URGENT' then metric end) as recall from runs group by name, status"""
FLOORS_SQL = ", ".join(f"coalesce(c.{m}, 0) >= {v}{{d}} as {m}_ok" for m, v in GATED.items())
I1_SQL = f"""select *, {' and '.join(f'{m}_ok' for m in GATED)} and challenger_ok as passed from (
  select c.name, round(c.map5095, 6) as candidate, round(h.map5095, 6) as champion, {FLOORS_SQL.format(d='::double')}, h.map5095 is null or coalesce(c.map5095, 0) >= h.map5095 + 0.01::double as challenger_ok
  from (select * from m where status <> 'FINISHED') c left join (select * from m where status = 'FINISHED' and name <> 'trial-7') h on c.name = h.name)"""


@query(f"with m as ({METRICS_SQL}) {I1_SQL}")
def I1_promotion_gate(spark, sf_dir):
    """Four floors, where a missing metric is 0, and the champion plus a margin; a name without a champion wins."""
    m = spark.sql(METRICS_SQL.replace("from runs", "from {runs}"), runs=view(spark, sf_dir, "runs"))
    champion = m.where("status = 'FINISHED' and name <> 'trial-7'").selectExpr("name", "map5095 as champion")
    return T.gate(m.where("status <> 'FINISHED'").drop("status"), champion, GATED, "map5095", 0.01).select(
        "name", F.round("map5095", 6).alias("candidate"), F.round("champion", 6).alias("champion"), *[f"{c}_ok" for c in GATED], "challenger_ok", "passed")


@query("select name, round(max(metric) filter (priority = '1-URGENT'), 6) as urgent, round(max(metric) filter (priority = '2-HIGH'), 6) as high, round(max(metric) filter (priority = '3-MEDIUM'), 6) as medium from runs group by 1")
def I3_metric_report(spark, sf_dir):
    wide = view(spark, sf_dir, "runs").groupBy("name").pivot("priority", ["1-URGENT", "2-HIGH", "3-MEDIUM"]).agg(F.round(F.max("metric"), 6))
    return wide.toDF("name", "urgent", "high", "medium")


@query("select a.name, round(100 * (a.best - b.best), 6) as delta, abs(100 * (a.best - b.best)) <= 0.5::double as passed from (select name, max(metric) as best from runs where status = 'FINISHED' group by 1) a join (select name, max(metric) as best from runs where status <> 'FINISHED' group by 1) b using (name)")
def I5_device_gate(spark, sf_dir):
    a, b = (view(spark, sf_dir, "runs").where(f"status {op} 'FINISHED'").groupBy("name").agg(F.max("metric").alias(n)) for op, n in (("=", "device"), ("<>", "desktop")))
    delta = 100 * (F.col("device") - F.col("desktop"))
    return a.join(b, "name").select("name", F.round(delta, 6).alias("delta"), (F.abs(delta) <= 0.5).alias("passed"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings to episodes, end to end."""
    return E5_drift_episodes(spark, sf_dir)
