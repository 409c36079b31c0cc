"""Annotations and boxes: parsing, clipping, merging, tiling, matching candidates, checks between tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.functions import geometry as G
from framelake.sources.scratch import cut

WIDTH, HEIGHT = 1000, 600


def parse_annotations(lines: DataFrame, width: int = WIDTH, height: int = HEIGHT) -> DataFrame:
    """Boxes of text lines ``line``: rows that don't parse, have score 0, no merged class or no area after clipping are dropped.

    A line is split once: the generators keep the optimizer from copying the split into each column and filter. A width or
    height of the image of 0 or less drops all lines.
    """
    kinds = [("frame_index", 0, "int"), ("bbox_left", 2, "double"), ("bbox_top", 3, "double"), ("bbox_width", 4, "double"), ("bbox_height", 5, "double"), ("score", 6, "double"), ("category", 7, "int")]
    if width <= 0 or height <= 0:
        lines, width, height = lines.where("false"), 1, 1
    part = lines.select("*", F.explode(F.array(F.split("line", ","))).alias("_part")).where(F.size("_part") >= 8)
    fields = F.struct(*[F.get("_part", k).try_cast(t).alias(c) for c, k, t in kinds])
    cast = part.select(*lines.columns, F.explode(F.array(fields)).alias("_f")).select(*lines.columns, "_f.*")
    return normalise(cast.na.drop(subset=[c for c, _, _ in kinds]).where("score <> 0"), width, height)


def normalise(boxes: DataFrame, width: int = WIDTH, height: int = HEIGHT) -> DataFrame:
    """cls, xc, yc, w, h of pixel boxes: corners are clipped to the image, boxes without area or class go."""
    x1, x2 = (G.clip01(F.expr(e) / float(width)) for e in ("bbox_left", "bbox_left + bbox_width"))
    y1, y2 = (G.clip01(F.expr(e) / float(height)) for e in ("bbox_top", "bbox_top + bbox_height"))
    corners = F.struct(G.merged_class(F.col("category")).alias("cls"), x1.alias("x1"), x2.alias("x2"), y1.alias("y1"), y2.alias("y2"))
    out = boxes.select("*", F.explode(F.array(corners)).alias("_c")).where("_c.cls is not null and _c.x2 > _c.x1 and _c.y2 > _c.y1")
    norm = {"cls": "_c.cls", "xc": "(_c.x1 + _c.x2) / 2", "yc": "(_c.y1 + _c.y2) / 2", "w": "_c.x2 - _c.x1", "h": "_c.y2 - _c.y1"}
    return out.withColumns({c: F.expr(e) for c, e in norm.items()}).drop("_c")


def crop_window(boxes: DataFrame, width: int, height: int) -> DataFrame:
    """cx1, cy1, cx2, cy2 around the box x1, y1, x2, y2: a fifth of the side or 16 px more on each side, corners truncated, inside the image and at least 1 px wide and high."""
    pad = {a: f"greatest(0.2D * ({a}2 - {a}1), 16D)" for a in "xy"}
    low = {a: f"greatest(0L, cast({a}1 - {pad[a]} as bigint))" for a in "xy"}
    high = {a: f"least({n}L, cast({a}2 + {pad[a]} as bigint))" for a, n in (("x", width), ("y", height))}
    return boxes.withColumns({**{f"c{a}1": F.expr(low[a]) for a in "xy"}, **{f"c{a}2": F.expr(f"greatest({low[a]} + 1, {high[a]})") for a in "xy"}})


def unletterbox(boxes: DataFrame) -> DataFrame:
    """x1, y1, x2, y2 of the letterbox back in the source: padding off, divided by gain, clipped; w, h, gain, left and top are those of ``letterbox``."""
    back = lambda c, pad, size: F.expr(f"greatest(0D, least(cast({size} as double), ({c} - {pad}) / gain))")
    return boxes.withColumns({"x1": back("x1", "left", "w"), "x2": back("x2", "left", "w"), "y1": back("y1", "top", "h"), "y2": back("y2", "top", "h")})


def keep_stride(frames: DataFrame, stride: int, train_stride: int | None = None) -> DataFrame:
    """Frames 1, 1 + stride, ..; rows whose ``split`` is train go by ``train_stride`` where that is given."""
    step = F.lit(stride) if train_stride is None else F.when(F.col("split") == "train", train_stride).otherwise(stride)
    return frames.where((F.col("frame_index") - 1) % step == 0)


def clip_window(frames: DataFrame, start: int, length: int | None) -> DataFrame:
    kept = frames.where(F.col("frame_index") >= start)
    return kept if length is None else kept.where(F.col("frame_index") < start + length)


def letterbox(sizes: DataFrame, side_w: int, side_h: int) -> DataFrame:
    """gain, new size and padding that fit w x h into a fixed frame (halves to even)."""
    gain = F.least(side_h / F.col("h").cast("double"), side_w / F.col("w").cast("double"))
    out = sizes.withColumn("gain", gain).withColumn("new_w", F.bround(F.col("w") * F.col("gain"), 0).cast("long")).withColumn("new_h", F.bround(F.col("h") * F.col("gain"), 0).cast("long"))
    pad = lambda n, new: F.bround((F.lit(n) - F.col(new)) / 2 - 0.1, 0).cast("long")
    return out.withColumn("left", pad(side_w, "new_w")).withColumn("top", pad(side_h, "new_h"))


def tiles(frames: DataFrame, side: int, overlap: float = 0.2) -> DataFrame:
    """x0, y0 of each tile over w x h: steps of side less overlap, the last one flush with the edge."""
    step = side - int(overlap * side)

    def starts(n: str):
        last = F.greatest(F.lit(0), F.col(n) - side)
        return F.when(F.col(n) <= side, F.array(F.lit(0).cast("long"))).otherwise(F.array_union(F.sequence(F.lit(0).cast("long"), last.cast("long"), F.lit(step).cast("long")), F.array(last.cast("long"))))

    return frames.withColumn("x0", F.explode(starts("w"))).withColumn("y0", F.explode(starts("h")))


def candidates(det: DataFrame, gt: DataFrame, keys: list[str]) -> DataFrame:
    """Overlapping pairs of one frame and class, with IoU; the equi keys keep it a hash or merge join."""
    both = G.prefixed(det, "d_").join(G.prefixed(gt, "g_"), keys)
    return both.withColumn("iou", G.iou("d_", "g_")).where("iou > 0")


def not_ignored(boxes: DataFrame, regions: DataFrame, keys: list[str], width: int, height: int, share: float = 0.5) -> DataFrame:
    """Boxes (x, y, w, h) less than ``share`` of whose pixels lie in the union of their frame's regions.

    Sizes are raised to 1. A region covers rows y - 1 .. min(H, y + h) - 1, likewise columns; a
    box y .. min(H, y + h) - 1. The union is exact: the regions clipped to the box are cut along all their
    edges and covered cells are summed. Boxes are numbered and written, since numbers given anew could fall to other boxes.
    """
    r = regions.select(*keys, *[F.expr(f"greatest(cast(r{c} as bigint), 1)").alias(c) for c in "xywh"])
    r = r.selectExpr(*keys, "x - 1 as rx1", f"least({width}, x + w) as rx2", "y - 1 as ry1", f"least({height}, y + h) as ry2")
    b = cut(boxes.withColumn("box_id", F.monotonically_increasing_id()), "boxes").withColumns({f"_{c}": F.expr(f"greatest(cast(floor({c} + 0.5) as bigint), 1)") for c in "xywh"})
    b = b.withColumns({"_bx1": F.expr(f"least(_x, {width})"), "_bx2": F.expr(f"least({width}, _x + _w)"), "_by1": F.expr(f"least(_y, {height})"), "_by2": F.expr(f"least({height}, _y + _h)")})
    hit = b.select(*keys, "box_id", "_bx1", "_bx2", "_by1", "_by2").join(r, keys)
    hit = hit.selectExpr("box_id", "greatest(rx1, _bx1) as a1", "least(rx2, _bx2) as a2", "greatest(ry1, _by1) as b1", "least(ry2, _by2) as b2").where("a2 > a1 and b2 > b1")
    rects = hit.groupBy("box_id").agg(F.collect_set(F.struct("a1", "a2", "b1", "b2")).alias("rects"))
    rects = rects.withColumn("xs", F.expr("array_sort(array_distinct(concat(rects.a1, rects.a2)))")).withColumn("ys", F.expr("array_sort(array_distinct(concat(rects.b1, rects.b2)))"))
    cells = """aggregate(sequence(0, size(xs) - 2), 0L, (s, i) -> s + aggregate(sequence(0, size(ys) - 2), 0L, (t, j) -> t +
      if(exists(rects, r -> r.a1 <= xs[i] and r.a2 >= xs[i + 1] and r.b1 <= ys[j] and r.b2 >= ys[j + 1]), (xs[i + 1] - xs[i]) * (ys[j + 1] - ys[j]), 0L)))"""
    covered = rects.select("box_id", F.expr(cells).alias("covered"))
    out = b.join(covered, "box_id", "left").withColumn("covered", F.coalesce("covered", F.lit(0).cast("long")))
    return out.where(F.col("covered") < share * F.col("_w") * F.col("_h")).drop("box_id", *[c for c in b.columns if c.startswith("_")])


def labels_text(boxes: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One text a frame: cls and four numbers of six decimals a line, in annotation order."""
    line = F.format_string("%d %.6f %.6f %.6f %.6f\n", "cls", "xc", "yc", "w", "h")
    rows = boxes.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("line")))).alias("rows"))
    return rows.select(*keys, F.array_join(F.col("rows.line"), "").alias("text"))


def read_labels(lines: DataFrame) -> DataFrame:
    """cls, xc, yc, w, h of label lines; lines without five fields or with a field that isn't a number are skipped."""
    part = F.split(F.trim("line"), r"\s+")
    out = lines.where(F.size(part) == 5).withColumns({c: F.get(part, k).try_cast("int" if c == "cls" else "double") for k, c in enumerate(("cls", "xc", "yc", "w", "h"))})
    return out.na.drop(subset=["cls", "xc", "yc", "w", "h"])


FAULTS = {"class": "category not between 1 and 10", "height": "bbox_height <= 0", "x range": "bbox_left + bbox_width > 1000", "y range": "bbox_top + bbox_height > 600"}


def faults():
    """Names of all validation rules that an annotation breaks."""
    return F.array_compact(F.array(*[F.when(F.expr(e), n) for n, e in FAULTS.items()]))
