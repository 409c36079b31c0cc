"""Queries of readings, labels, tags and versions in full: those whose short forms in the other modules leave a part out."""

from __future__ import annotations

from pyspark.sql import functions as F

from framelake.functions import geometry as G
from framelake.operators import frames as R
from framelake.operators import order as O
from framelake.operators import tracks as T
from framelake.plans.registered import KEY, query, r6
from framelake.sources.adapters import table, view

SPLIT = "case when sequence < 'seq12' then 'train' when sequence <= 'seq15' then 'val' else 'test' end"
MERGED_SQL = "case when {c} in (1, 2) then 0 when {c} in (4, 5, 6, 9) then 1 when {c} in (3, 7, 8, 10) then 2 end"
NAME_SQL = "sequence || '_' || lpad(cast(frame_index as varchar), 7, '0')"

#: a class name for each part, some of which no list holds
NAMES = ["person", "dog", "car", "van", "motor", "people", "bus", "kite", "bicycle", "truck"]
B3_SQL = f"""select p_partkey, name, case when name in ('person', 'people') then 0 when name in ('car', 'van', 'bus', 'truck') then 1
  when name in ('motor', 'bicycle') then 2 else -1 end as cls from (select p_partkey, {NAMES!r}[1 + p_partkey % 10] as name from part)"""


@query(B3_SQL)
def B3_named_classes(spark, sf_dir):
    name = F.element_at(F.array(*map(F.lit, NAMES)), (1 + F.col("p_partkey") % 10).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", name.alias("name"), G.named_class(name).alias("cls"))


B6_SQL = """select distinct 'demo/images/' || sequence || '/' || lpad(cast(frame_index as varchar), 7, '0') || '.jpg' as image,
  'demo/labels/' || sequence || '/' || lpad(cast(frame_index as varchar), 7, '0') || '.txt' as label from ann"""


@query(B6_SQL)
def B6_demo_addresses(spark, sf_dir):
    at = [F.format_string(f"demo/{kind}/%s/%07d.{end}", "sequence", "frame_index").alias(kind[:-1]) for kind, end in (("images", "jpg"), ("labels", "txt"))]
    return view(spark, sf_dir, "ann").select(*at).distinct()


CENTRES = """sequence, frame_index, line_no, (bbox_left + bbox_width / 2.0{d}) / 1000 as xc, (bbox_top + bbox_height / 2.0{d}) / 600 as yc,
  bbox_width / 1000.0{d} as w, bbox_height / 600.0{d} as h"""
B9_SQL = f"""select sequence, frame_index, line_no, round((xc - w / 2) * 1000, 6) as x1, round((yc - h / 2) * 600, 6) as y1,
  round((xc + w / 2) * 1000, 6) as x2, round((yc + h / 2) * 600, 6) as y2 from (select {CENTRES.format(d='::double')} from ann)"""


@query(B9_SQL)
def B9_pixel_corners(spark, sf_dir):
    boxes = spark.sql(f"select {CENTRES.format(d='D')} from {{ann}}", ann=view(spark, sf_dir, "ann"))
    return r6(boxes.select(*KEY, "line_no", *[c.alias(n) for n, c in G.pixel_corners(1000, 600).items()]), *G.CORNERS)


B15_SQL = """with cells as (select vec_id, r, j, sum(px[r * 8 + c + 1] * greatest(0, least(9 * c + 9, 8 * j + 8) - greatest(9 * c, 8 * j))) as v
    from fr, range(0, 8) a(r), range(0, 9) b(j), range(0, 8) d(c) group by all),
  bits as (select x.vec_id, (x.r * 8 + x.j) // 4 as digit, sum(case when y.v > x.v then 1 << (3 - (x.r * 8 + x.j) % 4) else 0 end) as n
    from cells x join cells y on x.vec_id = y.vec_id and x.r = y.r and y.j = x.j + 1 group by all)
select vec_id, string_agg(substr('0123456789abcdef', cast(n + 1 as int), 1), '' order by digit) as dhash from bits group by 1"""


@query(B15_SQL)
def B15_dhash_resized(spark, sf_dir):
    """64 bits over 9 x 8 cells as 16 hexadecimal digits."""
    return R.dhash_text(view(spark, sf_dir, "fr")).select("vec_id", "dhash")


B16_SQL = """with t as (select d, exp(-d * d / 4.5::double) / sum(exp(-d * d / 4.5::double)) over () as k from range(-5, 6) g(d)),
  across as (select vec_id, r, c, sum(k * px[r * 8 + least(7, greatest(0, c + d)) + 1]) as v from fr, range(0, 8) a(r), range(0, 8) b(c), t group by all),
  down as (select x.vec_id, x.r, x.c, sum(k * y.v) as v from across x, t, across y where y.vec_id = x.vec_id and y.c = x.c and y.r = least(7, greatest(0, x.r + d)) group by all)
select vec_id, round(avg(v), 6) as brightness, round(stddev_pop(v), 5) as contrast from down group by 1"""


@query(B16_SQL)
def B16_defocus(spark, sf_dir):
    """Readings of frames that are blurred with radius 1.5, which leaves some of their contrast."""
    read = R.readings(R.shifted(view(spark, sf_dir, "fr"), "defocus", 1.5))
    return read.select("vec_id", F.round("brightness", 6).alias("brightness"), F.round("contrast", 5).alias("contrast"))


B20_SQL = """select p_partkey, cls, named, case when named between 1 and 11 then named else case cls when 0 then 1 when 1 then 4 else 3 end end as raw
  from (select p_partkey, p_partkey % 3 as cls, case when p_partkey % 4 > 0 then p_partkey % 14 end as named from part)"""


@query(B20_SQL)
def B20_named_category(spark, sf_dir):
    """A prompt's category: what it names, else the lowest of its merged class."""
    prompts = table(spark, sf_dir, "part").selectExpr("p_partkey", "p_partkey % 3 as cls", "case when p_partkey % 4 > 0 then p_partkey % 14 end as named")
    return prompts.withColumn("raw", G.raw_category(F.col("named"), F.col("cls")).cast("long"))


TAG_SQL = """case run_id % 5 when 0 then 'gate.passed' when 1 then 'optimize.' || replace(name, '-', '_') || '_fp16_fingerprint'
  when 2 then 'optimize.fp16_640' else 'optimize.' || replace(name, '-', '_') || '_fp16_' || cast(640 * (1 + run_id % 2) as {text}) end"""
B22_SQL = f"""select run_id, tag, slug, regexp_extract(slug, '^(.+)-([^-]+)-([0-9]+)$', 1) as runtime, regexp_extract(slug, '^(.+)-([^-]+)-([0-9]+)$', 2) as precision,
  regexp_extract(slug, '^(.+)-([^-]+)-([0-9]+)$', 3) as imgsz from (select *, case when regexp_matches(s, '^.+-[^-]+-[0-9]+$') and tag like 'optimize.%' then s end as slug
    from (select *, replace(substr(tag, 10), '_', '-') as s from (select run_id, {TAG_SQL.format(text='varchar')} as tag from runs)))"""


@query(B22_SQL)
def B22_tag_slugs(spark, sf_dir):
    """From a version's tags back to variants; null where a tag is no variant's."""
    tags = view(spark, sf_dir, "runs").select("run_id", F.expr(TAG_SQL.format(text="string")).alias("tag")).withColumn("slug", T.tag_slug(F.col("tag")))
    return tags.select("*", *T.variant_parts(F.col("slug")))


RAW_SQL = """l_orderkey as frame, l_linenumber as anchor, l_partkey % 20 + 10.0{d} as xc, l_suppkey % 10 + 10.0{d} as yc, 8.0{d} as w, 10.0{d} as h,
  {array}l_quantity / 50, l_discount * 10, (l_partkey % 100) / 100.0{d}{end} as scores"""
IOU_SQL = """greatest(0, least(q.x2, b[k + 1].x2) - greatest(q.x1, b[k + 1].x1)) * greatest(0, least(q.y2, b[k + 1].y2) - greatest(q.y1, b[k + 1].y1))"""
B28_SQL = f"""with recursive best as (select *, list_max(scores) as conf, list_position(scores, list_max(scores)) - 1 as cls from (select {RAW_SQL.format(d='::double', array='[', end=']')} from lineitem)),
  a as (select frame, cls, list({{'anchor': anchor, 'conf': conf, 'x1': xc - w / 2, 'y1': yc - h / 2, 'x2': xc + w / 2, 'y2': yc + h / 2}} order by conf desc, anchor, xc - w / 2, yc - h / 2) as b
    from best where conf > 0.25::double group by all),
  f as (select frame, cls, b, 1 as k, [b[1]] as kept from a union all select frame, cls, b, k + 1, case when len(list_filter(kept, lambda q: {IOU_SQL} / (160 - {IOU_SQL}) > 0.45::double)) > 0
    then kept else list_append(kept, b[k + 1]) end from f where k < len(b))
select frame, o.anchor as anchor, cls, round(o.conf, 6) as conf, o.x1 as x1, o.y2 as y2 from (select frame, cls, unnest(kept) as o from f where k = len(b))"""


@query(B28_SQL)
def B28_decode_best(spark, sf_dir):
    """Best class of each anchor, suppression inside a class, 300 boxes of a frame at most."""
    raw = spark.sql(f"select {RAW_SQL.format(d='D', array='array(', end=')')} from {{t}}", t=table(spark, sf_dir, "lineitem"))
    return r6(T.decode_best(raw, 0.25, 0.45, ["frame"]).select("frame", "anchor", F.col("cls").cast("long").alias("cls"), "conf", "x1", "y2"), "conf")


C2_SQL = f"""with a as (select distinct {SPLIT} as split, {NAME_SQL} as name from ann where category = 2), b as (select distinct {SPLIT} as split, {NAME_SQL} as name from ann where category = 3),
  lone as (select *, 'no label' as fault from (from a except from b) union all select *, 'no image' from (from b except from a))
select split, fault, count(*) as n, array_to_string(list_sort(list(name))[1:3], ', ') as examples from lone group by 1, 2"""


@query(C2_SQL)
def C2_pairing_report(spark, sf_dir):
    names = view(spark, sf_dir, "ann").select(F.expr(SPLIT).alias("split"), F.format_string("%s_%07d", "sequence", "frame_index").alias("name"), "category")
    images, labels = (names.where(f"category = {k}").select("split", "name") for k in (2, 3))
    return T.pairing_report(images, labels)


def stats(c: str):
    rounded = {"mean": F.avg(c), "std": F.stddev_pop(c), "low": F.min(c), "high": F.max(c)}
    return [F.round(v, 4).alias(f"{n}_{c}") for n, v in rounded.items()]


STATS_SQL = "round(avg({c}), 4) as mean_{c}, round(stddev_pop({c}), 4) as std_{c}, round(min({c}), 4) as low_{c}, round(max({c}), 4) as high_{c}"
BOXES_SQL = f"""select {SPLIT} as split, count(*) as n_frames, {STATS_SQL.format(c='boxes_per_frame')} from
  (select sequence, frame_index, count(*) filter (category between 1 and 10) as boxes_per_frame from ann group by 1, 2) group by 1"""


@query(BOXES_SQL)
def D2_boxes_per_frame(spark, sf_dir):
    """Frames without a box count with 0."""
    frames = view(spark, sf_dir, "ann").groupBy(*KEY).agg(F.count_if(F.expr("category between 1 and 10")).alias("boxes_per_frame"))
    return frames.groupBy(F.expr(SPLIT).alias("split")).agg(F.count(F.lit(1)).alias("n_frames"), *stats("boxes_per_frame"))


D3_SQL = f"""select split, cls, count(*) as n_boxes, {STATS_SQL.format(c='area')}, {STATS_SQL.format(c='aspect')} from (select {SPLIT} as split, {MERGED_SQL.format(c='category')} as cls,
  cast(bbox_width * bbox_height as double) as area, bbox_width / cast(bbox_height as double) as aspect from ann where category between 1 and 10 and bbox_height > 0) group by 1, 2"""


@query(D3_SQL)
def D3_class_shapes(spark, sf_dir):
    """Area and aspect of the boxes of each split and merged class."""
    boxes = view(spark, sf_dir, "ann").where("category between 1 and 10 and bbox_height > 0").select(
        F.expr(SPLIT).alias("split"), G.merged_class(F.col("category")).alias("cls"), F.expr("cast(bbox_width * bbox_height as double)").alias("area"), F.expr("bbox_width / cast(bbox_height as double)").alias("aspect"))
    return boxes.groupBy("split", "cls").agg(F.count(F.lit(1)).alias("n_boxes"), *stats("area"), *stats("aspect"))


#: label lines, some of them damaged, as both dialects read it
LINE_SQL = """case target_id % 23 when 3 then '  ' when 5 then {print}('%d %.6f', category % 3, xc) when 7 then {print}('%d %.6f x %.6f %.6f', category % 3, xc, w, h)
  when 9 then {print}('%d.0 %.6f %.6f %.6f %.6f', category % 3, xc, yc, w, h) else {print}('%d  %.6f %.6f %.6f %.6f', case when category = 0 then 3 else category % 3 end, xc, yc, w, h) end"""
LINES_SQL = f"select {SPLIT} as split, {LINE_SQL.format(print='printf')} as line from (select category, target_id, {CENTRES.format(d='::double')} from ann)"
D8_CTE = f"""f as (select split, string_split_regex(trim(regexp_replace(line, '\\s+', ' ', 'g')), ' ') as f from ({LINES_SQL}) where trim(line) <> ''),
  v as (select *, len(f) = 5 as five, try_cast(f[1] as int) as cls, list_transform(f[2:5], lambda x: try_cast(x as double)) as v from f),
  n as (select *, five and cls is not null and regexp_matches(f[1], '^[+-]?[0-9]+$') and len(list_filter(v, lambda x: x is null)) = 0 as numeric from v),
  j as (select split, cls, case when not five then 'fields' when not numeric then 'numeric' else nullif(concat_ws(', ', case when cls not between 0 and 2 then 'class' end,
    case when len(list_filter(v, lambda x: not x between 0 and 1)) > 0 then 'range' when v[3] <= 0 or v[4] <= 0 then 'size' end), '') end as fault, numeric from n)"""
D8_SQL = f"""with {D8_CTE}
select split, coalesce(fault, 'none') as fault, count(*) as n, count(distinct cls) filter (numeric and cls between 0 and 2) as n_classes from j group by 1, 2"""


@query(D8_SQL)
def D8_label_faults(spark, sf_dir):
    """Faults of label lines in each split, and how many of the classes occur."""
    lines = spark.sql(f"select {SPLIT} as split, {LINE_SQL.format(print='printf')} as line from (select category, target_id, {CENTRES.format(d='D')} from {{ann}})", ann=view(spark, sf_dir, "ann"))
    judged = T.label_faults(lines).withColumn("_c", F.expr("case when (fault is null or fault not in ('fields', 'numeric')) and cls between 0 and 2 then cls end"))
    return judged.groupBy("split", F.coalesce("fault", F.lit("none")).alias("fault")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("_c").alias("n_classes"))


D10_SQL = """with e as (select event_id, event_type as cls, value / 500 as conf, cast(floor(value / 10) as bigint) % 3 as boxes, (row_number() over (order by event_id) - 1) // 100 as window_id from events),
  b as (select e.*, case when window_id % 7 = 0 and cls = 'click' then null else cls end as c from e, range(0, 2) g(i) where i < boxes),
  k as (select window_id, c as cls, count(*) as n, sum(conf) as s from b where c is not null group by 1, 2),
  w as (select window_id, count(*) as n_events from e group by 1 having count(*) = 100),
  t as (select window_id, n_events, coalesce(sum(n), 0) as n, coalesce(sum(s), 0) as s from w left join k using (window_id) group by 1, 2),
  seen as (select cls, min(window_id) as first from k group by 1)
select t.window_id, seen.cls, n_events, round(t.n / n_events, 6) as boxes_per_event, round(case when t.n > 0 then t.s / t.n else 0 end, 12) as mean_conf,
  round(case when seen.cls is not null then case when t.n > 0 then coalesce(k.n, 0) / t.n else 0 end end, 6) as share
from t left join seen on first <= t.window_id left join k on k.window_id = t.window_id and k.cls = seen.cls"""


@query(D10_SQL)
def D10_window_health(spark, sf_dir):
    """Windows of 100 events with up to two boxes each; every seventh window lacks one class."""
    ev = table(spark, sf_dir, "events").selectExpr("event_id as event", "event_type as cls", "value / 500 as conf", "cast(floor(value / 10) as bigint) % 3 as boxes")
    rows = R.count_windows(ev, ["event"], 100)
    boxes = rows.where("boxes > 0 and not (window_id % 7 = 0 and cls = 'click')").select("event", "cls", "conf", F.explode(F.expr("sequence(1, boxes)")))
    # twelve places, which no mean of so few boxes ends halfway between, whatever the order of its sum
    return r6(R.window_health(rows, boxes), "boxes_per_event", "share").withColumn("mean_conf", F.round("mean_conf", 12))


D17_SQL = """select coalesce(cast(cls as varchar), 'total') as cls, round(sum(d) / cast(sum(g) as double), 6) as ratio from
  (select cls, count(*) as d, 0 as g from det group by 1 union all select cls, 0, count(*) from gt group by 1) group by rollup (cls)"""


@query(D17_SQL)
def D17_label_ratio_total(spark, sf_dir):
    """Each class and the total."""
    both = view(spark, sf_dir, "det").select("cls", F.lit(1).alias("d"), F.lit(0).alias("g")).unionByName(view(spark, sf_dir, "gt").select("cls", F.lit(0).alias("d"), F.lit(1).alias("g")))
    by = both.rollup("cls").agg(F.round(F.sum("d") / F.sum("g"), 6).alias("ratio"))
    return by.select(F.coalesce(F.col("cls").cast("string"), F.lit("total")).alias("cls"), "ratio")


D19_SQL = """select round(avg(coalesce(kept, 0)), 6) as kept, round(avg(coalesce(n, 0)), 6) as detected from (select distinct sequence, frame_index from ann)
  left join (select sequence, frame_index, count(*) as n, count(*) filter (conf >= 0.25::double) as kept from det group by all) using (sequence, frame_index)"""


@query(D19_SQL)
def D19_kept_and_detected(spark, sf_dir):
    n = view(spark, sf_dir, "det").groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.expr("conf >= 0.25D")).alias("k"))
    frames = view(spark, sf_dir, "ann").select(*KEY).distinct().join(n, KEY, "left")
    return frames.agg(*[F.round(F.avg(F.coalesce(c, F.lit(0))), 6).alias(name) for c, name in (("k", "kept"), ("n", "detected"))])


D26_SQL = """select coalesce(sequence, 'all') as sequence, max(n) as peak from (select sequence, frame_index, count(distinct target_id) as n from ann group by 1, 2) group by rollup (sequence)"""


@query(D26_SQL)
def D26_peak_overall(spark, sf_dir):
    live = view(spark, sf_dir, "ann").groupBy(*KEY).agg(F.countDistinct("target_id").alias("n"))
    return live.rollup("sequence").agg(F.max("n").alias("peak")).select(F.coalesce("sequence", F.lit("all")).alias("sequence"), "peak")


TAGS_SQL = """l_orderkey as version, case l_linenumber % 3 when 1 then 'gate.passed' when 2 then 'optimize.onnx_' || cast(640 * (1 + l_suppkey % 2) as {text})
  else 'optimize.ncnn_fp16_' || cast(640 * (1 + l_suppkey % 2) as {text}) end as tag, case when l_returnflag = 'N' then 'True' else 'False' end as value"""
I2_SQL = f"""with t as (select {TAGS_SQL.format(text='varchar')} from lineitem), v as (select o_orderkey as version, 640 * (1 + o_custkey % 2) as imgsz from orders)
select target, version from v, (values ('server', 'optimize.onnx_'), ('edge', 'optimize.ncnn_fp16_')) s(target, p)
where exists (select 1 from t where t.version = v.version and tag = 'gate.passed' and value = 'True') and exists (select 1 from t where t.version = v.version and tag = p || cast(imgsz as varchar))"""


@query(I2_SQL)
def I2_promotable_by_tags(spark, sf_dir):
    tags = spark.sql(f"select {TAGS_SQL.format(text='string')} from {{t}}", t=table(spark, sf_dir, "lineitem"))
    versions = table(spark, sf_dir, "orders").selectExpr("o_orderkey as version", "640 * (1 + o_custkey % 2) as imgsz")
    return T.promotable(versions, tags, {"server": "optimize.onnx_", "edge": "optimize.ncnn_fp16_"})


I3_SQL = """with m as (select case when status = 'FINISHED' then 'champion' else 'candidate' end as role, 'test/mAP50-95/' || name as metric, max(metric) as value from runs where name <> 'trial-3' or status = 'FINISHED' group by all
  union all select case when status = 'FINISHED' then 'champion' else 'candidate' end, 'test/' || priority, avg(metric) from runs group by all)
select role, metric, round(value, 6) as value, nullif(regexp_extract(metric, '^.*/mAP50-95/(.*)$', 1), '') as cls
from (select metric, unnest(['candidate', 'champion']) as role from (select distinct metric from m)) k left join m using (role, metric)"""


@query(I3_SQL)
def I3_report_by_role(spark, sf_dir):
    """Every metric that either role has, in both; null where one lacks it."""
    runs = view(spark, sf_dir, "runs").withColumn("role", F.expr("if(status = 'FINISHED', 'champion', 'candidate')"))
    by_class = runs.where("name <> 'trial-3' or status = 'FINISHED'").groupBy("role", F.concat(F.lit("test/mAP50-95/"), "name").alias("metric")).agg(F.max("metric").alias("value"))
    main = runs.groupBy("role", F.concat(F.lit("test/"), "priority").alias("metric")).agg(F.avg("metric").alias("value"))
    return T.report_rows(by_class.unionByName(main), "mAP50-95")


I5_SQL = """select *, case when bool_and(passed) over (partition by priority) then 'edge.passed' end as tag from (
  select priority, name, round(100 * (d - h), 6) as delta, abs(100 * (d - h)) <= 0.5::double as passed from
    (select priority, name, round(max(metric), 0) as d from runs where status = 'FINISHED' group by 1, 2) join (select priority, name, round(max(metric) - 0.4::double, 0) as h from runs where status <> 'FINISHED' group by 1, 2) using (priority, name))"""


@query(I5_SQL)
def I5_device_tag(spark, sf_dir):
    """The tag is set on a device's variants only where all of them pass."""
    side = lambda op, less, n: view(spark, sf_dir, "runs").where(f"status {op} 'FINISHED'").groupBy("priority", "name").agg(F.round(F.max("metric") - less, 0).alias(n))
    delta = 100 * (F.col("d") - F.col("h"))
    rows = side("=", 0.0, "d").join(side("<>", 0.4, "h"), ["priority", "name"]).select("priority", "name", F.round(delta, 6).alias("delta"), (F.abs(delta) <= 0.5).alias("passed"))
    every = rows.groupBy("priority").agg(F.bool_and("passed").alias("_all"))
    return rows.join(every, "priority").select("priority", "name", "delta", "passed", F.when(F.col("_all"), "edge.passed").alias("tag"))


I7_SQL = """with w as (select sha256(text) as identity, min(doc_id) as o from documents where text is not null group by 1), s as (select identity, o as version from w where o % 3 = 0)
select identity, version, false as created from s union all
select identity, coalesce((select max(version) from s), 0) + row_number() over (order by o, identity), true from w where identity not in (select identity from s)"""


@query(I7_SQL)
def I7_append_versions(spark, sf_dir):
    """A stored table holds every third version; the others are appended with the next numbers."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("identity"))
    stored = docs.where("identity is not null").groupBy("identity").agg(F.min("doc_id").alias("version")).where("version % 3 = 0")
    return T.find_or_create(stored, docs, "identity", "doc_id")


I8_SQL = """with c as (select l_orderkey as parent, min(l_linenumber) as child from lineitem where l_returnflag = 'R' group by 1)
select parent, cast(child as varchar) as child, false as created from c union all
select o_orderkey, cast(o_orderkey as varchar) || '-record', true from orders where o_orderkey not in (select parent from c)"""


@query(I8_SQL)
def I8_append_children(spark, sf_dir):
    """The child of each run with the marker, and a new one for each run that has none."""
    marked = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("parent")).agg(F.min("l_linenumber").cast("string").alias("child"))
    return T.append_children(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("parent")), marked)


I10_SQL = f"""with b as (select {MERGED_SQL.format(c='category')} as cls, {SPLIT} as g, (bbox_left * 7 + bbox_top * 13 + target_id * 31) % 1000 / 1000.0::double as v from ann where category between 1 and 10)
select 'label/AR' as metric, round(avg(v), 6) as value from b union all select 'label/AR/' || cast(cls as varchar), round(avg(v), 6) from b group by cls
union all select 'label/' || g || '/AR', round(avg(v), 6) from b group by g union all select 'label/AR@0.25', round(avg(v), 6) from b where v >= 0.25::double"""


@query(I10_SQL)
def I10_metric_keys(spark, sf_dir):
    """A reading over all, by class, by group and at a confidence floor, in long form."""
    rows = view(spark, sf_dir, "ann").where("category between 1 and 10").select(
        G.merged_class(F.col("category")).cast("string").alias("cls"), F.expr(SPLIT).alias("group"), F.expr("(bbox_left * 7 + bbox_top * 13 + target_id * 31) % 1000 / 1000D").alias("value"))
    return r6(T.metric_rows(rows, "label", "AR", 0.25), "value")


I12_SQL = """with r as (select *, mean > 5 as over_bar, lag(mean > 5) over (partition by sequence order by ts_ms, arrival) as before from (select sequence, arrival, ts_ms, n_person,
    avg(n_person) over (partition by sequence order by ts_ms range between 21600000 preceding and current row) as mean from ev))
select ts_ms // 3600000 as hour, count(*) filter (over_bar) as drifted, count(*) filter (not over_bar) as ok, count(*) filter (over_bar and not coalesce(before, false)) as episodes,
  round(count(*) filter (n_person = 0) / cast(count(*) as double), 6) as skip_rate from r group by 1"""


@query(I12_SQL)
def I12_verdict_rates(spark, sf_dir):
    """Frames by verdict in each hour, episodes that began and the share of frames without a person."""
    read = O.sliding_mean(view(spark, sf_dir, "ev"), "sequence", "ts_ms", "n_person", 21_600_000).withColumn("over_bar", F.col("mean") > 5)
    read = O.segmented_scan(read.select("sequence", "arrival", "ts_ms", "n_person", "over_bar"), ["sequence"], ["ts_ms", "arrival"], fired=("lag", "over_bar"))
    rows = read.withColumn("began", F.col("over_bar") & ~F.coalesce("fired", F.lit(False))).withColumn("hour", F.expr("ts_ms div 3600000"))
    return rows.groupBy("hour").agg(F.count_if("over_bar").alias("drifted"), F.count_if(~F.col("over_bar")).alias("ok"), F.count_if("began").alias("episodes"),
                                    F.round(F.count_if(F.col("n_person") == 0) / F.count(F.lit(1)), 6).alias("skip_rate"))
