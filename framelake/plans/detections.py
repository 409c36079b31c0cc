"""Queries of the greedy box rules, matching and average precision; their SQL walks the boxes by recursion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.operators import grid as X
from framelake.operators import matching as M
from framelake.operators import scores as S
from framelake.plans.registered import KEY, query, r6
from framelake.sources.adapters import view
from framelake.sources.scratch import cut

FRAME = "sequence, frame_index"
BOTH_SQL = "select sequence, frame_index, cls, x1, y1, x2, y2, conf from det union all select sequence, frame_index, cls, x1, y1, x2, y2, 0.5::double from gt"
BOX_TYPE = "struct(cls bigint, x1 bigint, y1 bigint, x2 bigint, y2 bigint, conf double)[]"
B_BOX = "{'cls': b.cls, 'x1': b.x1, 'y1': b.y1, 'x2': b.x2, 'y2': b.y2, 'conf': b.conf}"


def both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections and true boxes as one set, so that many overlap."""
    gt = view(spark, sf_dir, "gt").withColumn("conf", F.lit(0.5))
    return view(spark, sf_dir, "det").unionByName(gt).select(*KEY, "cls", "x1", "y1", "x2", "y2", "conf")


def duck_inter(a: str, b: str) -> str:
    return f"cast(greatest(0, least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1)) * greatest(0, least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1)) as double)"


def duck_area(a: str) -> str:
    return f"(({a}.x2 - {a}.x1) * ({a}.y2 - {a}.y1))"


def duck_iou(a: str, b: str) -> str:
    return f"coalesce({duck_inter(a, b)} / nullif({duck_area(a)} + {duck_area(b)} - {duck_inter(a, b)}, 0), 0)"


def duck_ios(a: str, b: str) -> str:
    return f"{duck_inter(a, b)} / (least({duck_area(a)}, {duck_area(b)}) + 1e-9::double)"


def duck_greedy(name: str, source: str, order: str, drop: str) -> str:
    """CTEs that end in ``name``: the boxes of ``source`` that a walk in ``order`` keeps; ``drop`` tests kept box q against b."""
    free = f"len(list_filter(s.kept, lambda q: {drop})) = 0"
    return f"""{name}_b as (select *, row_number() over (partition by {FRAME} order by {order}, cls, x1, y1, x2, y2, conf) as k from ({source})),
{name}_s as (select sequence, frame_index, 0::bigint as k, false as kept_now, []::{BOX_TYPE} as kept from (select distinct {FRAME} from {name}_b)
  union all select s.sequence, s.frame_index, b.k, {free}, case when {free} then list_append(s.kept, {B_BOX}) else s.kept end
  from {name}_s s join {name}_b b on s.sequence = b.sequence and s.frame_index = b.frame_index and b.k = s.k + 1),
{name} as (select b.* exclude (k) from {name}_b b join {name}_s s on s.sequence = b.sequence and s.frame_index = b.frame_index and s.k = b.k where s.kept_now)"""


BOX = "sequence, frame_index, cls, x1, y1, x2, y2, conf"


SUPPRESS_SQL = f"with recursive {duck_greedy('kept', BOTH_SQL, '-conf', duck_iou('q', 'b') + ' > 0.5')} select {BOX} from kept"


@query(SUPPRESS_SQL)
def E11_suppression(spark, sf_dir):
    return M.suppress(both(spark, sf_dir), KEY, 0.5)


NESTED_SQL = f"with recursive {duck_greedy('kept', BOTH_SQL, '-' + duck_area('b').replace('b.', ''), duck_ios('q', 'b') + ' >= 0.8')} select {BOX} from kept"


@query(NESTED_SQL)
def C8_nested_boxes(spark, sf_dir):
    return M.drop_nested(both(spark, sf_dir), KEY, 0.8)


CHAIN = f"select * from ({BOTH_SQL}) where least(x2 - x1, y2 - y1) >= 8 and (x2 - x1) * (y2 - y1) <= 0.001::double * 600000 and conf >= 0.1::double"


@query(f"""with recursive {duck_greedy('a', CHAIN, '-conf', duck_iou('q', 'b') + ' > 0.7')}, {duck_greedy('c', 'select * from a', duck_area('b').replace('b.', ''), duck_ios('q', 'b') + ' >= 0.9')}
select {BOX} from (select *, row_number() over (partition by {FRAME} order by conf desc, cls, x1, y1, x2, y2) as k from c) where k <= 4""")
def E13_filter_chain(spark, sf_dir):
    return M.filter_boxes(both(spark, sf_dir), KEY, 1000, 600, 8, 0.001, 0.1, 0.7, 0.9, False, 4)


TILED = f"select *, (x0 > 0 and x1 <= x0 + 60) or (y0 > 0 and y1 <= y0 + 60) or (x0 + 400 < 1000 and x2 >= x0 + 340) or (y0 + 400 < 600 and y2 >= y0 + 340) as cut from (select *, x1 // 320 * 320 as x0, y1 // 320 * 320 as y0 from ({BOTH_SQL}))"


def tiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The boxes with the tile that would have found them, and whether its inner edges cut them."""
    rows = both(spark, sf_dir).withColumns({"x0": F.expr("x1 div 320 * 320"), "y0": F.expr("y1 div 320 * 320")}).withColumns({"x1t": F.expr("x0 + 400"), "y1t": F.expr("y0 + 400")})
    return rows.withColumn("cut", M.cut_by_tile(60, 1000, 600))


@query(f"select sequence, frame_index, cls, x1 - x0 as x1, y1 - y0 as y1, conf, cut from ({TILED})")
def B19_cut_by_tile(spark, sf_dir):
    return tiled(spark, sf_dir).selectExpr(*KEY, "cls", "x1 - x0 as x1", "y1 - y0 as y1", "conf", "cut")


HOME = f"coalesce(list_position(list_transform(s.kept, lambda q: {duck_ios('q', 'b')} >= 0.85 and q.cls = b.cls), true), 0)"


@query(f"""with recursive b as (select *, row_number() over (partition by {FRAME} order by -((x2 - x1) * (y2 - y1)), cls, x1, y1, x2, y2, conf, cut) as k from ({TILED})),
s as (select sequence, frame_index, 0::bigint as k, []::{BOX_TYPE} as kept from (select distinct {FRAME} from b)
  union all select sequence, frame_index, k, case when cut and p > 0 then list_concat(kept[1:p - 1], [{{'cls': kept[p].cls, 'x1': kept[p].x1, 'y1': kept[p].y1, 'x2': kept[p].x2, 'y2': kept[p].y2, 'conf': greatest(kept[p].conf, conf)}}], kept[p + 1:]) else list_append(kept, box) end
  from (select s.sequence, s.frame_index, b.k, b.cut, b.conf, s.kept, {B_BOX} as box, {HOME} as p from s join b on s.sequence = b.sequence and s.frame_index = b.frame_index and b.k = s.k + 1)),
last as (select sequence, frame_index, unnest(kept) as q from (select *, row_number() over (partition by {FRAME} order by k desc) as r from s) where r = 1)
select sequence, frame_index, q.cls as cls, q.x1 as x1, q.y1 as y1, q.x2 as x2, q.y2 as y2, q.conf as conf from last""")
def E14_contained_merge(spark, sf_dir):
    rows = tiled(spark, sf_dir).select(*KEY, "cls", "x1", "y1", "x2", "y2", "conf", "cut")
    return M.merge_contained(rows, KEY).drop("cut")


def duck_match(thresholds: tuple, gt: str = "gt", small: bool = False) -> str:
    """CTEs that end in m: detections with t, iou, hit and ig for each threshold."""
    big = "(x2 - x1) * (y2 - y1) >= 1024" if small else "false"
    on = "s.sequence = d.sequence and s.frame_index = d.frame_index and s.cls = d.cls"
    iou = f"case when list_contains(s.used, i) then -1.0::double else {duck_iou('gts[i]', 'd')} end"
    return f"""d as (select *, row_number() over (partition by sequence, frame_index, cls order by conf desc, x1, y1, x2, y2) as k from det),
g as (select sequence, frame_index, cls, list({{'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2, 'ig': {big}}} order by x1, y1, x2, y2) as gts from {gt} group by all),
s as (select sequence, frame_index, cls, t, 0::bigint as k, []::bigint[] as used, 0.0::double as iou, false as hit, false as ig
  from (select distinct sequence, frame_index, cls from d), (select unnest([{', '.join(f'{t}::double' for t in thresholds)}]) as t)
  union all select sequence, frame_index, cls, t, k, case when best.iou >= t then list_append(used, -best.place) else used end, greatest(coalesce(best.iou, 0), 0), coalesce(best.iou >= t, false), coalesce(best.iou >= t and best.ig, false)
  from (select s.sequence, s.frame_index, s.cls, s.t, d.k, s.used, list_max(list_transform(range(1, len(coalesce(g.gts, [])) + 1), lambda i: {{'wanted': {iou} >= s.t and not gts[i].ig, 'iou': {iou}, 'place': -i, 'ig': gts[i].ig}})) as best
    from s join d on {on} and d.k = s.k + 1 left join g on g.sequence = d.sequence and g.frame_index = d.frame_index and g.cls = d.cls)),
m as (select d.*, s.t, s.iou, s.hit, s.ig or (not s.hit and {big.replace('x', 'd.x').replace('y', 'd.y')}) as ig from s join d on {on} and d.k = s.k)"""


def duck_ap(thresholds: tuple, by: str = "cls", gt: str = "gt", small: bool = False) -> str:
    """CTEs that end in ap (by, t, ap) and q (points) after ``duck_match``."""
    return f"""{duck_match(thresholds, gt, small)},
n as (select {by}, count(*) as n_gt from (select *, {GROUP_SQL} as resolution from {gt}) where {'(x2 - x1) * (y2 - y1) < 1024' if small else 'true'} group by all),
pts as (select {by}, t, conf, cast(sum(tp) over w as bigint) as tp, cast(sum(c) over w as bigint) as c from (select {by}, t, conf, count(*) filter (hit) as tp, count(*) as c from (select *, {GROUP_SQL} as resolution from m where not ig) group by all) window w as (partition by {by}, t order by conf desc)),
q as (select * from pts join n using ({by})),
ap as (select {by}, t, sum(p) / 101 as ap from (select {by}, t, r.k, max(case when 100 * tp >= r.k * n_gt then tp / c else 0 end) as p from q, range(0, 101) r(k) group by all) group by all)"""


GROUP_SQL = "case when sequence < 'seq07' then '3840px' when sequence < 'seq14' then '2688px' else '1904px' end"
ROWS = "sequence, frame_index, cls, x1, y1, conf"


MATCH_SQL = f"with recursive {duck_match((0.5,))} select {ROWS}, round(iou, 6) as iou, hit from m"


@query(MATCH_SQL)
def E10_greedy_matching(spark, sf_dir):
    out = M.match(view(spark, sf_dir, "det"), view(spark, sf_dir, "gt"), [*KEY, "cls"])
    return r6(out.select(*KEY, "cls", "x1", "y1", "conf", "iou", "hit"), "iou")


@query(f"""with recursive {duck_match((0.5,))} select * from (select 'hit' as kind, {ROWS} from m where hit order by conf, sequence, frame_index, cls, x1, y1 limit 20)
union all select * from (select 'miss' as kind, {ROWS} from m where not hit order by conf desc, sequence, frame_index, cls, x1, y1 limit 20)""")
def E15_worst_cases(spark, sf_dir):
    """A top-k report: least sure hits, most sure misses."""
    m = matched(view(spark, sf_dir, "det"), view(spark, sf_dir, "gt"), (0.5,))
    cols = ["sequence", "frame_index", "cls", "x1", "y1", "conf"]
    tie = [*KEY, "cls", "x1", "y1"]
    low = m.where("hit").select(F.lit("hit").alias("kind"), *cols).orderBy("conf", *tie).limit(20)
    return low.unionByName(m.where("not hit").select(F.lit("miss").alias("kind"), *cols).orderBy(F.col("conf").desc(), *tie).limit(20))


def matched(det: DataFrame, gt: DataFrame, thresholds=M.COCO_THRESHOLDS) -> DataFrame:
    """The matches, written once for all that is read off them."""
    return cut(M.match(det, gt, [*KEY, "cls"], thresholds), "matched")


MAPS = "round(coalesce(max(ap) filter (abs(t - 0.5) < 1e-9), 0), 6) as map50, round(coalesce(max(ap) filter (abs(t - 0.75) < 1e-9), 0), 6) as map75, round(coalesce(sum(ap), 0) / 10, 6) as map"


@query(f"""with recursive {duck_ap(M.COCO_THRESHOLDS)},
b as (select cls, max({{'f1': 2 * tp / cast(c + n_gt as double), 'conf': conf, 'p': tp / c, 'r': tp / n_gt}}) as b, max(tp) filter (conf >= 0.25) as ft, max(c) filter (conf >= 0.25) as fc, any_value(n_gt) as g from q where abs(t - 0.5) < 1e-9 group by cls)
select *, round(b.conf, 6) as conf_f1, round(b.p, 6) as precision, round(b.r, 6) as recall, round(coalesce(ft / fc, 0), 6) as floor_precision, round(coalesce(ft / g, 0), 6) as floor_recall
from (select cls, n_gt, {MAPS} from n left join ap using (cls) group by all) join b using (cls)""".replace("select *, round(b.conf", "select cls, n_gt, map50, map75, map, round(b.conf"))
def D20_average_precision(spark, sf_dir):
    det, gt = view(spark, sf_dir, "det"), view(spark, sf_dir, "gt")
    out = M.average_precision(matched(det, gt), gt, n_thresholds=len(M.COCO_THRESHOLDS))
    return r6(out, "map50", "map75", "map", "conf_f1", "precision", "recall", "floor_precision", "floor_recall")


@query(f"with recursive {duck_ap(M.COCO_THRESHOLDS, small=True)} select cls, n_gt, {MAPS} from n left join ap using (cls) group by all")
def D21_small_objects(spark, sf_dir):
    gt = M.small_ignored(view(spark, sf_dir, "gt"))
    m = M.ignore_large_misses(matched(view(spark, sf_dir, "det"), gt))
    return r6(M.average_precision(m, gt, n_thresholds=len(M.COCO_THRESHOLDS)).select("cls", "n_gt", "map50", "map75", "map"), "map50", "map75", "map")


@query(f"with recursive {duck_ap(M.COCO_THRESHOLDS, 'resolution, cls')} select resolution, cls, n_gt, {MAPS} from n left join ap using (resolution, cls) group by all")
def D23_precision_by_group(spark, sf_dir):
    group = F.expr(GROUP_SQL)
    gt = view(spark, sf_dir, "gt").withColumn("resolution", group)
    m = matched(view(spark, sf_dir, "det"), gt).withColumn("resolution", group)
    return r6(M.average_precision(m, gt, ["resolution", "cls"], n_thresholds=len(M.COCO_THRESHOLDS)).select("resolution", "cls", "n_gt", "map50", "map75", "map"), "map50", "map75", "map")


TALL = "(select * from gt where y2 - y1 >= 8)"


@query(f"""select 'all' as rule, * from (with recursive {duck_ap((0.5,))} select cls, n_gt, round(coalesce(max(ap), 0), 6) as map50 from n left join ap using (cls) group by all)
union all select 'tall', * from (with recursive {duck_ap((0.5,), gt=TALL)} select cls, n_gt, round(coalesce(max(ap), 0), 6) as map50 from n left join ap using (cls) group by all)""")
def C15_two_rules(spark, sf_dir):
    """One set of detections under two sets of true boxes."""
    det, gt = view(spark, sf_dir, "det"), view(spark, sf_dir, "gt")
    each = []
    for rule, true in (("all", gt), ("tall", gt.where("y2 - y1 >= 8"))):
        ap = M.average_precision(matched(det, true, (0.5,)), true, n_thresholds=1)
        each.append(r6(ap, "map50").select(F.lit(rule).alias("rule"), "cls", "n_gt", "map50"))
    return each[0].unionByName(each[1])


@query()
def D22_tracking_scores(spark, sf_dir):
    """Target ids as tracks, an id once a frame; no SQL form, since frames are assigned one-to-one."""
    ann = view(spark, sf_dir, "ann").where("category between 1 and 10 and bbox_height > 0").withColumn("cls", F.expr("category % 3"))
    gt, tracks = (ann.where(w).groupBy(*KEY, "cls", F.col("target_id").alias("id")).agg(F.min(F.struct(*[F.expr(e).alias(c) for c, e in (("x1", f"bbox_left + {d}"), ("y1", "bbox_top"), ("x2", f"bbox_left + bbox_width + {d}"), ("y2", "bbox_top + bbox_height"))])).alias("b")).select(*KEY, "cls", "id", "b.*") for w, d in (("line_no <= 3", 0), ("line_no between 2 and 4", "target_id % 5")))
    return r6(S.tracking_scores(gt, tracks), "hota", "det_a", "ass_a", "idf1")


@query(f"""with p as (select d.sequence, d.cls, d.frame_index, d.x1, d.y1, d.x2, d.y2, d.conf, {duck_iou('d', 'g')} as iou from det d join gt g on d.sequence = g.sequence and d.cls = g.cls
  and d.x1 < g.x2 and g.x1 < d.x2 and d.y1 < g.y2 and g.y1 < d.y2)
select {BOX}, count(*) as n, round(max(iou), 6) as best from p where iou > 0 group by all""")
def C4_crowded_candidates(spark, sf_dir):
    """All boxes of a sequence laid over each other as one crowded image, met by tiles: how many true boxes each detection overlaps, and its best."""
    true = view(spark, sf_dir, "gt").select("sequence", "cls", "x1", "y1", "x2", "y2")
    out = X.overlap_counts(view(spark, sf_dir, "det"), true, ["sequence", "cls"])
    return r6(out.select(*BOX.split(", "), "n", "best"), "best")


@query(SUPPRESS_SQL)
def E11_suppression_by_grid(spark, sf_dir):
    return X.suppress(both(spark, sf_dir), KEY, 0.5)


@query(NESTED_SQL)
def C8_nested_boxes_by_grid(spark, sf_dir):
    return X.drop_nested(both(spark, sf_dir), KEY, 0.8)


@query(MATCH_SQL)
def E10_matching_by_grid(spark, sf_dir):
    out = X.match(view(spark, sf_dir, "det"), view(spark, sf_dir, "gt"), [*KEY, "cls"])
    return r6(out.select(*KEY, "cls", "x1", "y1", "conf", "iou", "hit"), "iou")
