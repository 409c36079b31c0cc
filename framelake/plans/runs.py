"""Queries of tiles, texts and stamps, and of tables of runs, versions, variants and timings."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from framelake.operators import aggregate as A
from framelake.operators import boxes as B
from framelake.operators import order as O
from framelake.operators import tracks as T
from framelake.plans.registered import KEY, query, r6
from framelake.sources.adapters import table, view

CLS = "category % 3"
TILE_SQL = """select sequence, frame_index, line_no, x0, y0, round(((cl + cr) / 2 - x0) / 400, 6) as xc, round(((ct + cb) / 2 - y0) / 400, 6) as yc, round((cr - cl) / 400, 6) as w, round((cb - ct) / 400, 6) as h from (
  select *, least(greatest(l, x0), x0 + 400) as cl, least(greatest(r, x0), x0 + 400) as cr, least(greatest(t, y0), y0 + 400) as ct, least(greatest(b, y0), y0 + 400) as cb from (
    select sequence, frame_index, line_no, (xc - w / 2) * 1000 as l, (xc + w / 2) * 1000 as r, (yc - h / 2) * 600 as t, (yc + h / 2) * 600 as b, unnest([0, 320, 600]) as x0 from (
      select *, (bbox_left + bbox_width / 2.0::double) / 1000 as xc, (bbox_top + bbox_height / 2.0::double) / 600 as yc, bbox_width / 1000.0::double as w, bbox_height / 600.0::double as h from ann where bbox_height > 0)) p, (select unnest([0, 200]) as y0) q)
  where (cr - cl) * (cb - ct) > 0 and (cr - cl) * (cb - ct) >= 0.1::double * (r - l) * (b - t)"""


@query(TILE_SQL)
def B18_tile_labels(spark, sf_dir):
    boxes = view(spark, sf_dir, "ann").where("bbox_height > 0").selectExpr(*KEY, "line_no", "(bbox_left + bbox_width / 2D) / 1000 as xc", "(bbox_top + bbox_height / 2D) / 600 as yc", "bbox_width / 1000D as w", "bbox_height / 600D as h", "1000 as fw", "600 as fh")
    sized = boxes.withColumnsRenamed({"w": "bw", "h": "bh"}).withColumnsRenamed({"fw": "w", "fh": "h"})
    tiled = B.tiles(sized, 400).drop("w", "h").withColumnsRenamed({"bw": "w", "bh": "h"})
    return r6(T.slice_labels(tiled, 1000, 600, 400).select(*KEY, "line_no", "x0", "y0", "xc", "yc", "w", "h"), "xc", "yc", "w", "h")


@query("select cls, min(category) as raw from (select *, case when category in (1, 2) then 0 when category in (4, 5, 6, 9) then 1 else 2 end as cls from ann where category between 1 and 10) group by 1")
def B20_raw_category(spark, sf_dir):
    """The lowest raw category of each merged class that occurs."""
    cats = view(spark, sf_dir, "ann").groupBy("category").count().withColumn("cls", B.G.merged_class(F.col("category")))
    return cats.where("cls is not null").groupBy("cls").agg(F.min("category").alias("raw"))


B21_SQL = """select sequence, line_no, printf('%d,%d,%.2f,%.2f,%.2f,%.2f,%.6g,%d,-1,-1', frame_index, case when target_id = 0 then -1 else target_id end,
  bbox_left::double, bbox_top::double, bbox_width::double, bbox_height::double, conf, category) as line
  from (select *, case target_id % 5 when 0 then score::double when 1 then bbox_left / 1301.0::double when 2 then bbox_left / 1.3e8::double else (bbox_left + bbox_width) / 7.0::double end as conf from ann)"""


@query(B21_SQL)
def B21_annotation_lines(spark, sf_dir):
    """Scores 0 and 1, confidences of many digits, tiny ones and numbers above 1."""
    ann = view(spark, sf_dir, "ann").withColumns({"x1": F.col("bbox_left"), "y1": F.col("bbox_top"), "x2": F.expr("bbox_left + bbox_width"), "y2": F.expr("bbox_top + bbox_height")})
    conf = F.expr("case target_id % 5 when 0 then double(score) when 1 then bbox_left / 1301D when 2 then bbox_left / 1.3e8D else (bbox_left + bbox_width) / 7D end")
    return ann.select("sequence", "line_no", T.annotation_line(conf, F.expr("nullif(target_id, 0)")).alias("line"))


@query("""select run_id, slug, case when regexp_matches(slug, '^.+-[^-]+-[0-9]+$') then regexp_extract(slug, '^(.+)-([^-]+)-([0-9]+)$', 1) end as runtime, case when regexp_matches(slug, '^.+-[^-]+-[0-9]+$') then regexp_extract(slug, '^(.+)-([^-]+)-([0-9]+)$', 2) end as precision,
  case when regexp_matches(slug, '^.+-[^-]+-[0-9]+$') then regexp_extract(slug, '^(.+)-([^-]+)-([0-9]+)$', 3) end as imgsz, 'optimize.' || replace(slug, '-', '_') as tag from (select run_id, name || '-' || lower(status) || case when run_id % 7 = 0 then '' else '-' || cast(640 * (1 + run_id % 2) as varchar) end as slug from runs)""")
def B22_variant_slugs(spark, sf_dir):
    slug = F.concat_ws("-", "name", F.lower("status"), F.when(F.col("run_id") % 7 != 0, (640 * (1 + F.col("run_id") % 2)).cast("string")))
    runs = view(spark, sf_dir, "runs").select("run_id", slug.alias("slug"))
    return runs.select("run_id", "slug", *T.variant_parts(F.col("slug")), F.concat(F.lit("optimize."), F.replace(F.col("slug"), F.lit("-"), F.lit("_"))).alias("tag"))


@query("select l_orderkey, l_linenumber, regexp_replace(uri, '[^A-Za-z0-9._-]+', '-', 'g') as slug, regexp_extract(uri, '^runs:/([^/]+)/', 1) as run_id, regexp_extract(uri, '([^/]+)[.][^./]*$', 1) as stem from (select l_orderkey, l_linenumber, 'runs:/' || cast(l_orderkey as varchar) || '/' || l_returnflag || ' ' || l_linestatus || '/best.pt' as uri from lineitem)")
def B23_uri_parts(spark, sf_dir):
    uri = F.concat(F.lit("runs:/"), F.col("l_orderkey").cast("string"), F.lit("/"), "l_returnflag", F.lit(" "), "l_linestatus", F.lit("/best.pt"))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", uri.alias("uri"))
    return rows.select("l_orderkey", "l_linenumber", T.uri_slug(F.col("uri")).alias("slug"), F.regexp_extract("uri", "^runs:/([^/]+)/", 1).alias("run_id"), F.regexp_extract("uri", "([^/]+)[.][^./]*$", 1).alias("stem"))


@query("select l_orderkey, l_linenumber, case when l_returnflag = 'N' and l_linestatus = 'O' or l_returnflag <> 'N' and l_linestatus = 'F' then l_extendedprice - l_quantity end as delta from lineitem")
def B27_memory_delta(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", "if(l_returnflag = 'N', 'O', 'F') as scope_before", "l_linestatus as scope_after", "l_quantity as before", "l_extendedprice as after")
    return rows.select("l_orderkey", "l_linenumber", T.memory_delta().alias("delta"))


@query("""select sequence, frame_index, anchor, cls, round(conf, 6) as conf, x1, y1 from (select *, row_number() over (partition by sequence, frame_index order by conf desc, anchor, cls) as k from (
  select sequence, frame_index, anchor, c as cls, scores[c + 1] as conf, xc - w / 2 as x1, yc - h / 2 as y1 from (select sequence, frame_index, arrival as anchor, n_person + 10.0::double as xc, 20.0::double as yc, 4.0::double as w, 6.0::double as h, [conf, 1 - conf, conf / 2] as scores from ev), range(0, 3) r(c)) where conf > 0.25::double) where k <= 2""")
def B28_decode_scores(spark, sf_dir):
    raw = view(spark, sf_dir, "ev").selectExpr(*KEY, "arrival as anchor", "n_person + 10D as xc", "20D as yc", "4D as w", "6D as h", "array(conf, 1 - conf, conf / 2) as scores")
    return r6(T.decode_scores(raw, 0.25, 2, KEY).select(*KEY, "anchor", F.col("cls").cast("long").alias("cls"), "conf", "x1", "y1"), "conf")


@query("select sequence, frame_index from ann where category = 4 and (frame_index - 1) % 4 = 0 intersect select sequence, frame_index from ev_frames".replace("ev_frames", "(select sequence, frame_index from ann where category = 5)"))
def C3_frames_in_subset(spark, sf_dir):
    ann = view(spark, sf_dir, "ann")
    clip = B.keep_stride(ann.where("category = 4").select(*KEY), 4)
    return clip.join(ann.where("category = 5").select(*KEY), KEY, "left_semi").distinct()


CHAMPION_SQL = "(select name, run_id, metric, custkey from (select *, row_number() over (partition by name order by start_time desc, run_id desc) as k from runs where status = 'FINISHED') where k = 1)"


def champions(spark, sf_dir):
    return O.top_k(view(spark, sf_dir, "runs").where("status = 'FINISHED'"), ["name"], [F.col("start_time").desc(), F.col("run_id").desc()], 1).select("name", "run_id", "metric", "custkey")


@query(f"select v.name, v.run_id, c.c_name as owner, n.n_name as scene, case when c.c_custkey is null then 'no owner' when n.n_name is null then 'no scene' end as fault from {CHAMPION_SQL} v left join customer c on v.custkey = c.c_custkey left join nation n on c.c_nationkey = n.n_nationkey and n.n_regionkey <> 2")
def C10_champion_chain(spark, sf_dir):
    """Alias to version to run to its scene; a hop without a row is named."""
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation").where("n_regionkey <> 2")
    hop = champions(spark, sf_dir).join(c, F.col("custkey") == F.col("c_custkey"), "left").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return hop.select("name", "run_id", F.col("c_name").alias("owner"), F.col("n_name").alias("scene"), F.expr("case when c_custkey is null then 'no owner' when n_name is null then 'no scene' end").alias("fault"))


@query("select coalesce(a.priority, b.priority) as metric, round(a.m, 6) as candidate, round(b.m, 6) as champion, round(a.m - b.m, 6) as delta from (select priority, max(metric) as m from runs where name = 'trial-1' group by 1) a full join (select priority, max(metric) as m from runs where name = 'trial-2' group by 1) b on a.priority = b.priority")
def C12_candidate_champion(spark, sf_dir):
    a, b = (view(spark, sf_dir, "runs").where(F.col("name") == n).groupBy(F.col("priority").alias("metric")).agg(F.max("metric").alias(c)) for n, c in (("trial-1", "candidate"), ("trial-2", "champion")))
    return r6(a.join(b, "metric", "full").withColumn("delta", F.expr("candidate - champion")), "candidate", "champion", "delta")


@query("select distinct name, case when name in (select name from runs where priority = '1-URGENT' and status <> 'FINISHED') then 'both' else 'desktop missing' end as state from runs where priority = '2-HIGH' and status = 'FINISHED'")
def C13_device_desktop(spark, sf_dir):
    runs = view(spark, sf_dir, "runs")
    device = runs.where("priority = '2-HIGH' and status = 'FINISHED'").select("name").distinct()
    desktop = runs.where("priority = '1-URGENT' and status <> 'FINISHED'").select("name").distinct().withColumn("there", F.lit(True))
    return device.join(desktop, "name", "left").select("name", F.when(F.col("there"), "both").otherwise("desktop missing").alias("state"))


@query("select sequence, frame_index, frame_name, cls, x1, y1, conf from det join (select distinct sequence, frame_index, sequence || '_' || lpad(cast(frame_index as varchar), 7, '0') as frame_name from ann) using (sequence, frame_index)")
def C14_attach_detections(spark, sf_dir):
    frames = view(spark, sf_dir, "ann").select(*KEY).distinct().withColumn("frame_name", F.format_string("%s_%07d", "sequence", "frame_index"))
    return view(spark, sf_dir, "det").join(frames, KEY).select(*KEY, "frame_name", "cls", "x1", "y1", "conf")


@query("select sequence, count(distinct frame_index) as frames, count(*) filter (bbox_height = 0) as corrupt, count(*) filter (bbox_height > 0) as kept, count(*) filter (bbox_height = 0) > 0 as warns from ann group by 1")
def D9_job_counters(spark, sf_dir):
    by = view(spark, sf_dir, "ann").groupBy("sequence").agg(F.countDistinct("frame_index").alias("frames"), F.count_if(F.col("bbox_height") == 0).alias("corrupt"), F.count_if(F.col("bbox_height") > 0).alias("kept"))
    return by.withColumn("warns", F.col("corrupt") > 0)


@query("select window_id, sequence, min(frame_index) as first, max(frame_index) as last, count(*) as n_frames, min(arrival) as since, sequence || '/' || cast(min(frame_index) as varchar) || '-' || cast(max(frame_index) as varchar) as span from (select *, (arrival - (select min(arrival) from ev)) // 100 as window_id from ev) group by 1, 2")
def D14_footage_spans(spark, sf_dir):
    ev = view(spark, sf_dir, "ev")
    first = ev.agg(F.min("arrival").alias("a"))  # one row
    rows = ev.crossJoin(F.broadcast(first)).withColumn("window_id", F.expr("(arrival - a) div 100"))
    return T.footage_spans(rows, "window_id")


@query("select l_returnflag, round(sum(l_extendedprice / 1000) / count(distinct l_orderkey), 6) as ms_per_frame from lineitem where l_orderkey > 5 * ceil(3 / 5.0) group by 1")
def D16_amortised_latency(spark, sf_dir):
    """Time over frames after a warm-up of 3 frames rounded up to whole cycles of 5."""
    rows = table(spark, sf_dir, "lineitem").where(F.col("l_orderkey") > 5 * -(-3 // 5))
    return rows.groupBy("l_returnflag").agg(F.round(F.sum(F.col("l_extendedprice") / 1000) / F.countDistinct("l_orderkey"), 6).alias("ms_per_frame"))


@query("select event_id, user_id from (select event_id, user_id, row_number() over (order by event_id) as k from events where event_type <> 'zzz') where (k - 1) % 7 = 0 order by event_id limit 500")
def E16_sample_limit(spark, sf_dir):
    """Every seventh row in order, the first 500 of them: limits that are the operator itself."""
    ranked = O.global_rank(table(spark, sf_dir, "events").where("event_type <> 'zzz'").select("event_id", "user_id"), ["event_id"])
    return ranked.where("(rank - 1) % 7 = 0").orderBy("event_id").limit(500).select("event_id", "user_id")


@query("""with f as (select user_id, event_id, event_id % 5 = 0 as is_key, event_id % 11 = 0 as corrupt, epoch_us(ts) // 1000 as pts from events),
b as (select *, corrupt or (coalesce(pts - lag(pts) over (partition by user_id order by event_id) > 200000000, false) and not is_key) as bad from f),
r as (select *, max(case when bad then event_id end) over w as damage, max(case when is_key and not corrupt then event_id end) over w as reset from b window w as (partition by user_id order by event_id rows unbounded preceding))
select user_id, event_id from r where damage is null or reset > damage or (reset = damage and not corrupt)""")
def E19_damage_drop(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr("user_id", "event_id", "event_id % 5 = 0 as is_key", "event_id % 11 = 0 as corrupt", "unix_millis(cast(ts as timestamp)) as pts", "200000000L as duration")
    return O.damage_drop(rows, "user_id", "event_id").select("user_id", "event_id")


@query("select 'train' as split, sequence, frame_index from ann where sequence < 'seq12' union all select 'val', sequence, frame_index from ann where sequence between 'seq12' and 'seq15' union all select 'test', sequence, frame_index from ann where sequence > 'seq15'")
def F5_union_splits(spark, sf_dir):
    split = F.when(F.col("sequence") < "seq12", "train").when(F.col("sequence") <= "seq15", "val").otherwise("test")
    return view(spark, sf_dir, "ann").select(split.alias("split"), *KEY)


@query("select name, run_id from runs where status = 'FINISHED' and exists (select 1 from runs s where s.name = runs.name and s.priority = '1-URGENT' and s.custkey % 2 = runs.custkey % 2)")
def I2_promotable(spark, sf_dir):
    """Versions whose gate passed and whose target has its served variant at the same size."""
    runs = view(spark, sf_dir, "runs").withColumn("size", F.col("custkey") % 2)
    served = runs.where("priority = '1-URGENT'").select("name", "size")
    return runs.where("status = 'FINISHED'").join(served, ["name", "size"], "left_semi").select("name", "run_id")


#: variants as slugs, and the stage of each timing
VARIANT_SQL = "lower(l_linestatus) || 'rt-' || lower(l_returnflag) || '16-' || cast(640 * (1 + l_suppkey % 2) as {text})"
STAGES_SQL = "case l_linenumber % 3 when 0 then 'decode' when 1 then 'infer' else 'encode' end"
I4_SQL = f"""select variant, regexp_extract(variant, '^(.+)-([^-]+)-([0-9]+)$', 1) as runtime, regexp_extract(variant, '^(.+)-([^-]+)-([0-9]+)$', 3) as imgsz,
  round(avg(l_discount), 6) as accuracy, round(quantile_cont(ms, 0.5), 8) as p50, round(quantile_cont(ms, 0.95), 8) as p95, round(quantile_cont(ms, 0.99), 8) as p99,
  round(avg(ms) filter (stage = 'decode'), 6) as decode, round(avg(ms) filter (stage = 'infer'), 6) as infer, round(avg(ms) filter (stage = 'encode'), 6) as encode,
  max(l_quantity) as size_mb, max(l_tax) as memory, count(distinct l_shipdate) as fingerprints, case when variant like 'ort%' then 'server' else 'edge' end as target
from (select *, {VARIANT_SQL.format(text='varchar')} as variant, {STAGES_SQL} as stage, l_extendedprice / 1000 as ms from lineitem) group by variant"""


@query(I4_SQL)
def I4_variant_table(spark, sf_dir):
    """A row for each variant: accuracy, latency and its stages, size, memory, fingerprints, and where it is served."""
    rows = table(spark, sf_dir, "lineitem").select("*", F.expr(VARIANT_SQL.format(text="string")).alias("variant"), F.expr(STAGES_SQL).alias("stage"), (F.col("l_extendedprice") / 1000).alias("ms"))
    main = rows.groupBy("variant").agg(F.round(F.avg("l_discount"), 6).alias("accuracy"), *[F.round(F.avg(F.when(F.col("stage") == c, F.col("ms"))), 6).alias(c) for c in ("decode", "infer", "encode")],
                                       F.max("l_quantity").alias("size_mb"), F.max("l_tax").alias("memory"), F.countDistinct("l_shipdate").alias("fingerprints"))
    spread = O.percentiles(rows, ["variant"], "ms", {"p50": 0.5, "p95": 0.95, "p99": 0.99}).select("variant", *[F.round(c, 8).alias(c) for c in ("p50", "p95", "p99")])
    runtime, _, imgsz = T.variant_parts(F.col("variant"))
    out = main.join(spread, "variant").select("*", runtime, imgsz, F.when(F.startswith("variant", F.lit("ort")), "server").otherwise("edge").alias("target"))
    return out.select("variant", "runtime", "imgsz", "accuracy", "p50", "p95", "p99", "decode", "infer", "encode", "size_mb", "memory", "fingerprints", "target")


STAMP_SQL = """sha256('{"params":{"side":' || cast(c_nationkey as varchar) || ',"stride":20},"source":"' || sha256(c_name) || '"}')"""


MADE_SQL = """sha256('{"params":{"side":' || cast(c_nationkey as varchar) || ',"stride":' || {stride} || '},"source":"' || sha256(c_name) || '"}')"""
STAMP_SQL = MADE_SQL.replace("{stride}", "'20'")
#: what was stored: nothing for some, what can't be read for some, and stamps made with stride 10 or 20
STORED_SQL = f"case when c_custkey % 4 = 0 then null when c_custkey % 7 = 0 then 'x' else {MADE_SQL.replace('{stride}', 'cast(10 * (1 + c_custkey % 2) as varchar)')} end"
I6_SQL = f"""select c_custkey, stamp, left(stamp, 8) as run_name, coalesce(old = stamp, false) as current from
  (select c_custkey, {STAMP_SQL} as stamp, {STORED_SQL} as old from customer)"""


@query(I6_SQL)
def I6_skip_if_current(spark, sf_dir):
    """The stamp of each source now, and whether the one stored with its table is the same: a missing, unreadable or older one isn't."""
    c = table(spark, sf_dir, "customer")
    made = lambda stride: T.stamp(F.sha2("c_name", 256), stride=stride, side=F.col("c_nationkey"))
    stored = c.where("c_custkey % 4 <> 0").select("c_custkey", F.when(F.col("c_custkey") % 7 == 0, "x").otherwise(made(10 * (1 + F.col("c_custkey") % 2))).alias("stored"))
    now = c.select("c_custkey", made(F.lit(20)).alias("stamp"))
    return T.is_current(now, stored, "c_custkey").select("c_custkey", "stamp", F.left("stamp", F.lit(8)).alias("run_name"), "current")


@query("select hash, min(doc_id) as version, count(*) as n_uses from (select doc_id, sha256(text) as hash from documents) group by 1")
def I7_find_or_create(spark, sf_dir):
    """One version for each identity, the first that had it; later ones reuse it."""
    return table(spark, sf_dir, "documents").groupBy(F.sha2("text", 256).alias("hash")).agg(F.min("doc_id").alias("version"), F.count(F.lit(1)).alias("n_uses"))


@query("select o_orderkey as parent, min(l_linenumber) filter (l_returnflag = 'R') as child, coalesce(count(*) filter (l_returnflag = 'R'), 0) = 0 as created from orders left join lineitem on l_orderkey = o_orderkey group by 1")
def I8_child_run(spark, sf_dir):
    child = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("parent")).agg(F.min("l_linenumber").alias("child"))
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("parent")).join(child, "parent", "left").withColumn("created", F.col("child").isNull())


@query("select run_id, sha256(c_name) as manifest, c_nationkey as data_version from runs join customer on custkey = c_custkey")
def I9_lineage(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), F.sha2("c_name", 256).alias("manifest"), F.col("c_nationkey").alias("data_version"))
    return view(spark, sf_dir, "runs").join(c, "custkey").select("run_id", "manifest", "data_version")


@query("select name, 'test/' || k as metric, v as value from (select name, unnest(['best', 'mean']) as k, unnest([round(max(metric), 6), round(avg(metric), 6)]) as v from runs group by name)")
def I10_metrics_long(spark, sf_dir):
    wide = view(spark, sf_dir, "runs").groupBy("name").agg(F.round(F.max("metric"), 6).alias("best"), F.round(F.avg("metric"), 6).alias("mean"))
    return wide.unpivot("name", ["best", "mean"], "k", "value").select("name", F.concat(F.lit("test/"), "k").alias("metric"), "value")


@query("""with s as (select name, status, max(metric) as best from runs group by all)
select c.name, c.best >= 0.5::double and (h.best is null or c.best >= h.best + 0.01::double) as passed,
  case when c.best >= 0.5::double and (h.best is null or c.best >= h.best + 0.01::double) then 'optimise' else 'skip' end as next
from (select * from s where status <> 'FINISHED') c left join (select * from s where status = 'FINISHED') h using (name)""")
def I11_routing(spark, sf_dir):
    """What follows the gate: a candidate that passed is optimised, the others are skipped. ``I11_routing_all_rows`` routes the data."""
    best = view(spark, sf_dir, "runs").groupBy("name", "status").agg(F.max("metric").alias("best"))
    champion = best.where("status = 'FINISHED'").selectExpr("name", "best as champion")
    judged = T.gate(best.where("status <> 'FINISHED'"), champion, {"best": 0.5}, "best", 0.01)
    return judged.select("name", "passed", F.when(F.col("passed"), "optimise").otherwise("skip").alias("next"))


@query(f"""select sequence, n_faults, case when n_faults > 0 then 'rebuild' when coalesce(old = stamp, false) then 'validate' else 'profile' end as route
  from (select sequence, count(*) filter (category not between 1 and 10 or bbox_height <= 0 or bbox_left + bbox_width > 1000 or bbox_top + bbox_height > 600) as n_faults from ann group by 1)
  left join (select 'seq' || lpad(cast(c_custkey as varchar), 2, '0') as sequence, {STAMP_SQL} as stamp, {STORED_SQL} as old from customer where c_custkey between 0 and 19) using (sequence)""")
def I11_routing_all_rows(spark, sf_dir):
    """Rebuild a sequence with a D8 fault in any row, profile one whose I6 stamp isn't current or is missing, validate the others; customer k stands for sequence k."""
    by = view(spark, sf_dir, "ann").groupBy("sequence").agg(F.count_if(F.size(B.faults()) > 0).alias("n_faults"))
    stamps = I6_skip_if_current(spark, sf_dir).where("c_custkey between 0 and 19").select(F.format_string("seq%02d", "c_custkey").alias("sequence"), "current")
    return T.routes(by, stamps, "sequence")


@query("select ts_ms // 60000 as minute, sequence, round(max(conf / 0.8), 6) as worst, count(*) filter (conf > 0.8) as crossed, round(avg(case when n_person = 0 then 1.0 else 0.0 end), 6) as empty_share from ev group by 1, 2")
def I12_dashboard(spark, sf_dir):
    ev = view(spark, sf_dir, "ev").withColumn("minute", F.expr("ts_ms div 60000"))
    return ev.groupBy("minute", "sequence").agg(F.round(F.max(F.col("conf") / 0.8), 6).alias("worst"), F.count_if(F.col("conf") > 0.8).alias("crossed"), F.round(F.avg(F.when(F.col("n_person") == 0, 1.0).otherwise(0.0)), 6).alias("empty_share"))


@query("""with b as (select category, cast(ceil(ln(bbox_width * bbox_height) / ln(1.01 / 0.99)) as bigint) as i, count(*) as k from ann where bbox_width * bbox_height > 0 group by all),
c as (select category, i, k, sum(k) over w as upto, sum(k) over (partition by category) as n from b window w as (partition by category order by i))
select category, cast(any_value(n) as bigint) as n, round(2 * pow(1.01 / 0.99, min(case when upto > floor(0.5 * (n - 1)) then i end)) / (1.01 / 0.99 + 1), 4) as p50,
  round(2 * pow(1.01 / 0.99, min(case when upto > floor(0.99 * (n - 1)) then i end)) / (1.01 / 0.99 + 1), 4) as p99 from c group by category""")
def H2_quantile_sketch(spark, sf_dir):
    """An aggregate of a user's own: areas within 1 % by a mergeable sketch."""
    areas = view(spark, sf_dir, "ann").select("category", (F.col("bbox_width") * F.col("bbox_height")).cast("double").alias("area"))
    out = A.user_aggregate(areas.where("area > 0"), ["category"], A.Quantiles("area", [0.5, 0.99]), "n bigint, p50 double, p99 double")
    return out.select("category", "n", F.round("p50", 4).alias("p50"), F.round("p99", 4).alias("p99"))


@query("""select sequence, count(*) as n_rows, cast(sum(cast(('0x' || substr(h, 1, 15)) as bigint)) as varchar) || '-' || cast(sum(cast(('0x' || substr(h, 16, 15)) as bigint)) as varchar) as table_hash
from (select sequence, sha256(concat_ws(',', length(category::varchar) || ':' || category, length(frame_index::varchar) || ':' || frame_index, length(line_no::varchar) || ':' || line_no)) as h from ann) group by sequence""")
def B24_table_hash(spark, sf_dir):
    """The hash of each sequence's annotations, whatever their order."""
    return A.table_hash(view(spark, sf_dir, "ann").select("sequence", "frame_index", "line_no", "category"), ["sequence"])
