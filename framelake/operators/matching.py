"""Greedy rules on the boxes of one frame, and average precision over all of them.

A frame's boxes are visited in an explicit order inside a fold over their array, so the rules stay in the
JVM and frames are independent. An array holds one frame (what a detector gives for one image).
Ties in the order are broken by all remaining columns, in the order of the columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

COCO_THRESHOLDS = tuple(k / 100 for k in range(50, 100, 5))
BUCKETS = 1024


def _inter(a: str, b: str) -> str:
    side = lambda lo, hi: f"greatest(0, least({a}.{hi}, {b}.{hi}) - greatest({a}.{lo}, {b}.{lo}))"
    return f"cast({side('x1', 'x2')} * {side('y1', 'y2')} as double)"


def _area(a: str) -> str:
    return f"cast(({a}.x2 - {a}.x1) * ({a}.y2 - {a}.y1) as double)"


def iou_text(a: str, b: str) -> str:
    """IoU of two box structs; 0 for an empty union and for boxes with NaN."""
    union = f"({_area(a)} + {_area(b)} - {_inter(a, b)})"
    return f"nanvl(if({union} > 0, {_inter(a, b)} / {union}, 0D), 0D)"


def ios_text(a: str, b: str) -> str:
    return f"{_inter(a, b)} / (least({_area(a)}, {_area(b)}) + 1e-9D)"


def _apart(a: str, b: str) -> str:
    """Whether one box ends where the other begins or before: four comparisons that spare most pairs the arithmetic."""
    return f"({a}.x2 <= {b}.x1 or {b}.x2 <= {a}.x1 or {a}.y2 <= {b}.y1 or {b}.y2 <= {a}.y1)"


def _whole(rows: DataFrame) -> bool:
    """Whether corners are whole numbers, so that none is undefined."""
    return all(isinstance(rows.schema[c].dataType, T.IntegralType) for c in ("x1", "y1", "x2", "y2"))


def _fold(rows: DataFrame, keys: Sequence[str], order: str, step: str) -> DataFrame:
    """Rows that a fold in ascending ``order`` keeps; ``step`` gives the next ``kept`` from ``kept`` and box ``b``."""
    rest = [c for c in rows.columns if c not in keys]
    boxes = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.expr(order).alias("_o"), *rest))).alias("_boxes"))
    kept = F.expr(f"aggregate(_boxes, filter(_boxes, b -> false), (kept, b) -> {step})")
    return boxes.select(*keys, F.explode(kept).alias("_b")).select(*keys, *[f"_b.{c}" for c in rest])


def _unless_beaten(threshold: float) -> str:
    """The step of suppression."""
    test = f"{iou_text('k', 'b')} > {threshold}"
    if threshold >= 0:  # boxes apart have an IoU of 0, those with an undefined corner too
        test = f"if({_apart('k', 'b')}, false, {test})"
    return f"if(exists(kept, k -> {test}), kept, array_append(kept, b))"


def suppress(rows: DataFrame, keys: Sequence[str], threshold: float, score: str = "conf") -> DataFrame:
    """Non-maximum suppression by descending score: a box goes when its IoU with a kept one is above ``threshold``. Put the class into ``keys`` to keep classes apart."""
    return _fold(rows, keys, f"-{score}", _unless_beaten(threshold))


def suppress_classes(rows: DataFrame, keys: Sequence[str], threshold: float, top: int) -> DataFrame:
    """``suppress`` within each class ``cls``, then the first ``top`` of a frame by descending conf, then ``anchor``.

    All of it is done on the frame's one array: rows are gathered once, not sorted anew for the classes and for the first ones.
    """
    rest = [c for c in rows.columns if c not in keys]
    boxes = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.expr("-conf").alias("_o"), *rest))).alias("_boxes"))
    of_class = f"aggregate(filter(_boxes, b -> b.cls = c), filter(_boxes, b -> false), (kept, b) -> {_unless_beaten(threshold)})"
    kept = boxes.withColumn("_kept", F.expr(f"flatten(transform(array_distinct(_boxes.cls), c -> {of_class}))")).drop("_boxes")
    before = "case when l.conf > r.conf then -1 when l.conf < r.conf then 1 when l.anchor < r.anchor then -1 when l.anchor > r.anchor then 1 else 0 end"
    first = F.expr(f"if(size(_kept) > {top}, slice(array_sort(_kept, (l, r) -> {before}), 1, {top}), _kept)")
    return kept.select(*keys, F.explode(first).alias("_b")).select(*keys, *[f"_b.{c}" for c in rest])


def drop_nested(rows: DataFrame, keys: Sequence[str], threshold: float, keep_outer: bool = True) -> DataFrame:
    """By area, largest first (smallest first to keep the inner): a box goes when its IoS with a kept one reaches ``threshold``."""
    area = "(x2 - x1) * (y2 - y1)"
    test = f"{ios_text('k', 'b')} >= {threshold}"
    if threshold > 0 and _whole(rows):
        test = f"if({_apart('k', 'b')}, false, {test})"
    return _fold(rows, keys, f"-({area})" if keep_outer else area, f"if(exists(kept, k -> {test}), kept, array_append(kept, b))")


def merge_contained(rows: DataFrame, keys: Sequence[str], threshold: float = 0.85) -> DataFrame:
    """By area, largest first: a box with ``cut`` that lies in a kept one of its class joins the first such; that one takes the higher ``conf``."""
    rest = [c for c in rows.columns if c not in keys]
    raised = ", ".join(f"'{c}', " + ("greatest(k.conf, b.conf)" if c == "conf" else f"k.{c}") for c in ["_o", *rest])
    inside = f"{ios_text('k', 'b')} >= {threshold}"
    if threshold > 0 and _whole(rows):
        inside = f"if({_apart('k', 'b')}, false, {inside})"
    # of most boxes nothing is asked: only cut ones look for a home
    home = f"if(b.cut, array_position(transform(kept, k -> k.cls = b.cls and {inside}), true), 0L)"
    step = f"transform(array({home}), p -> if(b.cut and p > 0, transform(kept, (k, i) -> if(i = p - 1, named_struct({raised}), k)), array_append(kept, b)))[0]"
    return _fold(rows, keys, "-((x2 - x1) * (y2 - y1))", step)


def cut_by_tile(margin: int, width: int, height: int):
    """Whether a box of a tile x0, y0, x1t, y1t lies within ``margin`` of an edge inside the frame."""
    return F.expr(f"(x0 > 0 and x1 <= x0 + {margin}) or (y0 > 0 and y1 <= y0 + {margin}) or (x1t < {width} and x2 >= x1t - {margin}) or (y1t < {height} and y2 >= y1t - {margin})")


def filter_boxes(rows: DataFrame, keys: Sequence[str], width: int, height: int, min_side: float | None = 8, max_area: float | None = 0.05, min_score: float | None = None, nms_iou: float | None = None, nested_ios: float | None = None, keep_outer: bool = True, top: int | None = None) -> DataFrame:
    """Sides, area, score, suppression, nested boxes, then the first ``top`` by score; None leaves a step out."""
    tests = [f"least(x2 - x1, y2 - y1) >= {min_side}" if min_side is not None else "", f"(x2 - x1) * (y2 - y1) <= {max_area} * {width * height}" if max_area is not None else "", f"conf >= {min_score}" if min_score is not None else ""]
    out = rows
    for t in filter(None, tests):
        out = out.where(t)
    if nms_iou is not None:
        out = suppress(out, keys, nms_iou)
    if nested_ios is not None:
        out = drop_nested(out, keys, nested_ios, keep_outer)
    if top is not None:
        rest = [c for c in rows.columns if c not in keys]
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("conf").desc(), *rest))
        out = out.withColumn("_k", place).where(F.col("_k") <= top).drop("_k")
    return out


def match(det: DataFrame, gt: DataFrame, keys: Sequence[str], thresholds: Sequence[float] = (0.5,)) -> DataFrame:
    """Detections with iou_min, iou, hit and ignored: by descending conf each takes the free true box of its
    keys with the highest IoU (the first on ties), if that reaches iou_min.

    True boxes with a true column ``ignored`` are taken only where no other box reaches iou_min; their detection is ignored
    too. A detection that hits nothing reports the IoU of its best free box, 0 if none.
    """
    rest = [c for c in det.columns if c not in keys]
    flag = F.coalesce(F.col("ignored"), F.lit(False)) if "ignored" in gt.columns else F.lit(False)
    d = det.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct((-F.col("conf")).alias("_o"), *rest))).alias("_d"))
    g = gt.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("x1", "y1", "x2", "y2", flag.alias("ignored")))).alias("_g"))
    both = d.join(g, list(keys), "left")
    both = both.withColumn("_g", F.coalesce("_g", F.expr("filter(array(named_struct('x1', _d[0].x1, 'y1', _d[0].y1, 'x2', _d[0].x2, 'y2', _d[0].y2, 'ignored', false)), x -> false)")))
    # overlaps are computed once, below the generator of the thresholds; each threshold then walks the few that are above 0
    met = f"transform(filter(transform(_g, (g, i) -> named_struct('g', g, 'i', i)), c -> not coalesce({_apart('c.g', 'd')}, true)), c -> named_struct('iou', {iou_text('c.g', 'd')}, 'place', -c.i, 'ignored', c.g.ignored))"
    near = f"transform(_d, d -> filter({met}, c -> c.iou > 0))"
    both = both.withColumn("_c", F.expr(near)).drop("_g").withColumn("iou_min", F.explode(F.array(*[F.lit(float(t)) for t in thresholds])))
    best = """array_max(transform(filter(c, x -> not array_contains(s.used, x.place)), x ->
      named_struct('wanted', x.iou >= iou_min and not x.ignored, 'iou', x.iou, 'place', x.place, 'ignored', x.ignored)))"""
    step = f"""transform(array({best}), m -> named_struct(
      'used', if(m.iou >= iou_min, array_append(s.used, m.place), s.used),
      'out', array_append(s.out, named_struct('iou', coalesce(m.iou, 0D), 'hit', coalesce(m.iou >= iou_min, false), 'ignored', coalesce(m.iou >= iou_min and m.ignored, false)))))[0]"""
    start = "named_struct('used', filter(array(0), x -> false), 'out', filter(array(named_struct('iou', 0D, 'hit', false, 'ignored', false)), x -> false))"
    out = F.expr(f"aggregate(_c, {start}, (s, c) -> {step}, s -> s.out)")
    rows = both.withColumn("_r", F.explode(F.arrays_zip(F.col("_d").alias("d"), out.alias("r"))))
    return rows.select(*keys, *[f"_r.d.{c}" for c in rest], "iou_min", "_r.r.iou", "_r.r.hit", "_r.r.ignored")


def _points(matched: DataFrame, n_gt: DataFrame, by: Sequence[str]) -> DataFrame:
    """Running tp and n at each distinct conf of each curve, equal confidences entering together.

    A prefix sum in two levels: within buckets of conf, shifted by the sums of the buckets above (at most 1,024 rows a
    curve), so that no task sees a whole curve.
    """
    curve = [*by, "iou_min"]
    at = matched.where("not ignored").groupBy(*curve, "conf").agg(F.count_if("hit").alias("tp"), F.count(F.lit(1)).alias("n"))
    at = at.withColumn("_b", F.expr(f"greatest(0, least({BUCKETS - 1}, cast(floor(conf * {BUCKETS}) as int)))"))
    above = Window.partitionBy(*curve).orderBy(F.col("_b").desc()).rowsBetween(Window.unboundedPreceding, -1)
    sums = at.groupBy(*curve, "_b").agg(F.sum("tp").alias("_tp"), F.sum("n").alias("_n"))
    sums = sums.select(*curve, "_b", *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(c) for c in ("_tp", "_n")])
    inside = Window.partitionBy(*curve, "_b").orderBy(F.col("conf").desc())
    at = at.withColumns({c: F.sum(c).over(inside) for c in ("tp", "n")}).join(sums, [*curve, "_b"])
    at = at.select(*curve, "conf", (F.col("tp") + F.col("_tp")).alias("tp"), (F.col("n") + F.col("_n")).alias("n"))
    return at.join(n_gt, list(by))


def average_precision(matched: DataFrame, gt: DataFrame, by: Sequence[str] = ("cls",), floor: float = 0.25, n_thresholds: int | None = None) -> DataFrame:
    """map50, map75, map (over all thresholds matched), and at IoU 0.5 precision and recall at the highest F1 and at the conf ``floor``, for each group that has true boxes.

    AP is the mean over 101 recall points of the highest precision at that recall or above (the published COCO definition). Groups without detections get zeros.
    ``matched`` is read three times: pass what ``cut`` wrote. ``n_thresholds`` is the number matched; it is counted where not given.
    """
    wanted = gt.where("not coalesce(ignored, false)") if "ignored" in gt.columns else gt
    n_gt = wanted.groupBy(*by).agg(F.count(F.lit(1)).alias("n_gt"))
    points = _points(matched, n_gt, by)
    curve = [*by, "iou_min"]
    top = points.where("tp > 0").groupBy(*curve, F.expr("100 * tp div n_gt").alias("m")).agg(F.max(F.col("tp") / F.col("n")).alias("p"))
    down, up = Window.partitionBy(*curve).orderBy(F.col("m").desc()), Window.partitionBy(*curve).orderBy("m")
    ap = top.withColumn("p", F.max("p").over(down)).withColumn("w", F.col("m") - F.lag("m", 1, -1).over(up)).groupBy(*curve).agg((F.sum(F.col("p") * F.col("w")) / 101).alias("ap"))
    n = n_thresholds or matched.select("iou_min").distinct().count() or 1
    at = lambda t: F.max(F.when(F.abs(F.col("iou_min") - t) < 1e-9, F.col("ap")))
    maps = ap.groupBy(*by).agg(at(0.5).alias("map50"), at(0.75).alias("map75"), (F.sum("ap") / n).alias("map"))
    half = points.where("abs(iou_min - 0.5D) < 1e-9D").withColumn("f1", F.expr("2 * tp / cast(n + n_gt as double)"))
    best = F.max(F.struct("f1", "conf", (F.col("tp") / F.col("n")).alias("p"), (F.col("tp") / F.col("n_gt")).alias("r")))
    over = F.col("conf") >= floor
    pr = half.groupBy(*by).agg(best.alias("b"), F.max(F.when(over, F.col("tp"))).alias("ft"), F.max(F.when(over, F.col("n"))).alias("fn"), F.max("n_gt").alias("g"))
    pr = pr.select(*by, F.col("b.conf").alias("conf_f1"), F.col("b.p").alias("precision"), F.col("b.r").alias("recall"), (F.col("ft") / F.col("fn")).alias("floor_precision"), (F.col("ft") / F.col("g")).alias("floor_recall"))
    return n_gt.join(maps, list(by), "left").join(pr, list(by), "left").na.fill(0.0)


def small_ignored(boxes: DataFrame, side: int = 32) -> DataFrame:
    """``ignored`` for boxes of side x side pixels or more."""
    return boxes.withColumn("ignored", F.expr(f"(x2 - x1) * (y2 - y1) >= {side * side}"))


def ignore_large_misses(matched: DataFrame, side: int = 32) -> DataFrame:
    """Detections that hit nothing and aren't small don't count against small objects."""
    return matched.withColumn("ignored", F.col("ignored") | (~F.col("hit") & F.expr(f"(x2 - x1) * (y2 - y1) >= {side * side}")))
