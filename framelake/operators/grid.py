"""Crowded frames: overlapping boxes by a join over the cells of nested grids, and greedy suppression in rounds over the pairs.

A box belongs to the grid whose cells are as large as its longer side, so that it lies in few cells; it looks for partners
in its own grid and in the coarser ones. A frame is thereby spread over all tasks, and no box meets boxes far from it.
A pair that shares several cells is reported by one of them, the cell of the corner where its intersection begins.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.functions import geometry as G
from framelake.operators import overlaps
from framelake.operators.matching import ios_text, iou_text
from framelake.sources.scratch import cut

SIDE, LEVELS = 16, 9  # cells of 16 to 4,096; larger boxes lie in several cells of the coarsest grid
TILE, TILE_LEVELS = 256, 5  # cells whose boxes are counted together
MOST = 250_000  # boxes of a side that are counted together
FEW = 200  # boxes of a side that meet without a grid


def _leveled(boxes: DataFrame, p: str, side: int = SIDE, levels: int = LEVELS) -> DataFrame:
    """The boxes with an area, and ``_own``, the level of their grid."""
    longer = f"greatest({p}x2 - {p}x1, {p}y2 - {p}y1)"
    level = f"cast(least({levels - 1}, greatest(0, ceil(log2({longer} / {side}D)))) as int)"
    # infinite and undefined corners overlap nothing that has an area
    solid = f"{p}x2 > {p}x1 and {p}y2 > {p}y1 and abs({p}x1) < 1e15 and abs({p}x2) < 1e15 and abs({p}y1) < 1e15 and abs({p}y2) < 1e15"
    return boxes.where(solid).selectExpr("*", f"{level} as _own")


def _levels(boxes: DataFrame) -> list[int]:
    """The levels of the grids that these boxes belong to."""
    return sorted(r[0] for r in boxes.select("_own").distinct().collect())  # nine at most


def _cells(boxes: DataFrame, p: str, own: bool, coarser: bool, held: Sequence[int] = (), side: int = SIDE) -> DataFrame:
    """A row for each cell (_level, _cx, _cy) of a box in its own grid, in those of the coarser ones that are ``held`` by the other side, or in both."""
    looked = f"filter(array({', '.join(map(str, held))}), v -> v {'>=' if own else '>'} _own)" if held else "cast(array() as array<int>)"
    rows = boxes.selectExpr("*", "_own as _level" if own and not coarser else f"explode({looked}) as _level")
    span = lambda a: f"explode(sequence(cast(floor({p}{a}1 / ({side} << _level)) as bigint), cast(floor({p}{a}2 / ({side} << _level)) as bigint)))"
    return rows.selectExpr("*", f"{span('x')} as _cx").selectExpr("*", f"{span('y')} as _cy").drop("_own")


def _crowded(sides: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """The keys that hold more than ``FEW`` boxes of a side, a row each; written."""
    many = [d.groupBy(*keys).count().where(F.col("count") > FEW).select(*keys) for d in sides]
    return cut(many[0] if len(many) == 1 else many[0].union(many[1]).distinct(), "crowded")


def overlapping(left: DataFrame, right: DataFrame, keys: Sequence[str], a: str = "a_", b: str = "b_") -> DataFrame:
    """Pairs of a row of ``left`` and one of ``right``, equal in ``keys``, whose boxes share area; each pair once.

    Columns but the keys are prefixed by ``a`` and ``b``. Boxes with a null, undefined or infinite corner or without area are in no pair,
    rows with a null key neither; rows that repeat give a pair each. Keys with few boxes need no grid: there each box is moved once, not once for each cell.
    """
    keys = list(keys)
    one, two = (_leveled(G.prefixed(d, p, [c for c in d.columns if c not in keys]), p) for d, p in ((left, a), (right, b)))
    crowded = _crowded([left] if left is right else [left, right], keys)
    meets = [f"greatest({a}{c}1, {b}{c}1) < least({a}{c}2, {b}{c}2)" for c in "xy"]
    if not crowded.limit(1).count():
        return one.drop("_own").join(two.drop("_own"), keys).where(" and ".join(meets))
    few = [d.join(crowded, keys, "left_anti").drop("_own") for d in (one, two)]
    one, two = (d.join(crowded, keys, "left_semi") for d in (one, two))
    mine = _levels(one)
    held = mine if left is right else _levels(two)
    on = [*keys, "_level", "_cx", "_cy"]
    # the finer box looks in the grid of the coarser one; boxes of one grid meet in the first of the two joins
    both = _cells(one, a, True, True, held).join(_cells(two, b, True, False), on)
    both = both.unionByName(_cells(one, a, True, False).join(_cells(two, b, False, True, mine), on))
    begins = [f"floor(greatest({a}{c}1, {b}{c}1) / ({SIDE} << _level)) = _c{c}" for c in "xy"]
    both = both.where(" and ".join(begins)).drop("_level", "_cx", "_cy")
    return few[0].join(few[1], keys).unionByName(both).where(" and ".join(meets))


def candidates(det: DataFrame, gt: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Overlapping pairs of one frame and class with IoU above 0: detections d_*, true boxes g_*."""
    return overlapping(det, gt, keys, "d_", "g_").withColumn("iou", G.iou("d_", "g_")).where("iou > 0")


def overlap_counts(det: DataFrame, gt: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Detections that share area with true boxes of their ``keys``: ``n``, how many, and ``best``, the highest IoU; rows that repeat are one, their n together.

    Pairs would grow with the square of a crowded frame, so boxes of a cell of large tiles are counted together (``operators.overlaps``). A cell
    that holds more than ``MOST`` boxes of a side is dealt out, each part of one side meeting each of the other.
    """
    keys, solid = list(keys), " and ".join(f"{k} is not null" for k in keys)
    apart = lambda rows, columns: cut(_leveled(rows.where(solid).groupBy(*columns).agg(F.count(F.lit(1)).alias("_w")), "", TILE, TILE_LEVELS), "apart")
    one, two = apart(det, det.columns), apart(gt, [*keys, *G.CORNERS])
    mine, held = _levels(one), _levels(two)
    # as in ``overlapping``: first the own and coarser grids of the detections, then the coarser ones of the true boxes
    d, g = _cells(one, "", True, True, held, TILE).withColumn("_turn", F.lit(0)), _cells(two, "", True, False, (), TILE).withColumn("_turn", F.lit(0))
    if mine and held and min(held) < max(mine):
        d = d.unionByName(_cells(one, "", True, False, (), TILE).withColumn("_turn", F.lit(1)))
        g = g.unionByName(_cells(two, "", False, True, mine, TILE).withColumn("_turn", F.lit(1)))
    cell = [*keys, "_turn", "_level", "_cx", "_cy"]
    many = lambda rows, name: rows.groupBy(*cell).count().where(F.col("count") > MOST).select(*cell, F.ceil(F.col("count") / MOST).alias(name))
    large = F.broadcast(many(d, "_nd").join(many(g, "_ng"), cell, "full"))  # a row for each MOST boxes at most
    parts = int(det.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        named = rows.join(large, cell, "left").withColumns({c: F.coalesce(c, F.lit(1)) for c in ("_nd", "_ng")})
        named = named.withColumn(f"_p{own}", F.pmod(F.xxhash64(*[c for c in rows.columns if c not in cell]), f"_n{own}"))
        named = named.withColumn(f"_p{other}", F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"_n{other}") - 1))).drop("_nd", "_ng")
        return named.repartition(parts, *cell, "_pd", "_pg")

    columns = det.columns
    schema = T.StructType([*[det.schema[c] for c in columns], T.StructField("n", T.LongType()), T.StructField("best", T.DoubleType())])

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        corners = [np.stack([t.column(c).to_numpy().astype(np.float64) for c in G.CORNERS]) for t in (left, right)]
        level, cx, cy = (left.column(c)[0].as_py() if len(left) else 0 for c in ("_level", "_cx", "_cy"))
        n, best = overlaps.in_tile(*corners, right.column("_w").to_numpy(), cx * (TILE << level), cy * (TILE << level))
        out = left.select(columns).append_column("n", pa.array(n * left.column("_w").to_numpy())).append_column("best", pa.array(best))
        return out.filter(pa.array((n > 0) | (best > 0)))

    by = [*cell, "_pd", "_pg"]
    met = dealt(d, "d", "g").groupBy(*by).cogroup(dealt(g, "g", "d").groupBy(*by)).applyInArrow(count, schema)
    return met.groupBy(*columns).agg(F.sum("n").alias("n"), F.max("best").alias("best"))


def _in_order(rows: DataFrame, keys: Sequence[str], order: str, number: str) -> DataFrame:
    """``rows`` with ``number``, which grows within the keys by ``order`` and then all remaining columns; written, so that numbers are fixed.

    A number takes the place of all columns of the order in what joins and rounds move.
    """
    by = [*keys, F.expr(order), *[c for c in rows.columns if c not in keys]]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut(rows.repartitionByRange(parts, *by).sortWithinPartitions(*by).withColumn(number, F.monotonically_increasing_id()), "crowd")


def _survivors(rows: DataFrame, keys: Sequence[str], order: str, beats: str) -> DataFrame:
    """What a walk in ascending ``order`` keeps, when a box b falls to an earlier kept k that beats it.

    Ties in the order are broken by all remaining columns. A box that no undecided box can beat stays, what it beats goes, and so on
    until nothing is undecided: the same boxes as the walk's. Rounds are as many as the longest chain of boxes that decide
    each other one after the other; most boxes are decided in the first few.
    """
    numbered = _in_order(rows, keys, order, "_id")
    crowd = numbered.select(*keys, *G.CORNERS, "_id")  # nothing else goes through the join
    met = overlapping(crowd, crowd, keys, "k_", "b_").where("k__id < b__id")
    met = met.select("k__id", "b__id", *[F.struct(*[F.col(f"{p}_{c}").alias(c) for c in G.CORNERS]).alias(p) for p in "kb"])
    open_ = cut(met.where(beats).selectExpr("k__id as k", "b__id as b"), "beaten")
    gone = None
    while open_.limit(1).count():
        stays = open_.select("k").distinct().join(open_.selectExpr("b as k").distinct(), "k", "left_anti")
        falls = cut(open_.join(stays, "k", "left_semi").select("b").distinct(), "fallen")
        gone = falls if gone is None else gone.union(falls)
        open_ = cut(open_.join(falls, "b", "left_anti").join(falls.selectExpr("b as k"), "k", "left_anti").select("k", "b"), "beaten")
    kept = numbered if gone is None else numbered.join(gone.withColumnRenamed("b", "_id"), "_id", "left_anti")
    return kept.select(*rows.columns)


def suppress(rows: DataFrame, keys: Sequence[str], threshold: float, score: str = "conf") -> DataFrame:
    """Non-maximum suppression by descending score, as ``matching.suppress``, for frames of any number of boxes."""
    return _survivors(rows, keys, f"-{score}", f"{iou_text('k', 'b')} > {threshold}")


def drop_nested(rows: DataFrame, keys: Sequence[str], threshold: float, keep_outer: bool = True) -> DataFrame:
    """The rule of ``matching.drop_nested`` for a ``threshold`` above 0 and frames of any number of boxes; boxes with an undefined corner stay."""
    if threshold <= 0:
        raise ValueError("threshold must be above 0: boxes that don't meet are never compared")
    area = "(x2 - x1) * (y2 - y1)"
    return _survivors(rows, keys, f"-({area})" if keep_outer else area, f"{ios_text('k', 'b')} >= {threshold}")


def match(det: DataFrame, gt: DataFrame, keys: Sequence[str], threshold: float = 0.5) -> DataFrame:
    """Greedy matching as ``matching.match`` for one threshold, for frames of any number of boxes: iou and hit beside each detection.

    The pairs that reach ``threshold`` come by the grid. A detection whose best free box isn't wanted by an earlier undecided detection
    takes it; taken boxes leave all pairs, and the next round begins. What then hits nothing reports its best box that is free when
    its turn comes, that is one that no earlier detection took.
    """
    d = _in_order(det, keys, "-conf", "turn")
    g = _in_order(gt.select(*keys, *G.CORNERS), keys, "x1", "_g")
    near = candidates(d.select(*keys, *G.CORNERS, "turn"), g, keys)
    # of boxes with equal IoU the first, in the order of corners
    first = F.struct((-F.col("iou")).alias("_o"), F.col("g__g").alias("_g")).alias("choice")
    pairs = cut(near.select(F.col("d_turn").alias("turn"), first), "pairs")
    open_, took = pairs.where(F.expr(f"-choice._o >= {threshold}")), None
    while True:
        best = open_.groupBy("turn").agg(F.min("choice").alias("choice"))
        wanted = open_.groupBy("choice._g").agg(F.min("turn").alias("turn"))
        now = best.join(wanted.withColumnRenamed("_g", "g"), "turn").where("choice._g = g").select("turn", "choice")
        now = cut(now, "took")
        if not now.limit(1).count():
            break
        took = now if took is None else took.union(now)
        open_ = open_.join(now.select("turn"), "turn", "left_anti")
        open_ = cut(open_.join(now.select(F.col("choice._g").alias("_t")), F.expr("choice._g = _t"), "left_anti"), "open")
    if took is None:
        took = now
    taken = took.selectExpr("choice._g as _t", "turn as at")
    missed = pairs.join(took.select("turn"), "turn", "left_anti").join(taken, F.expr("choice._g = _t and at < turn"), "left_anti")
    result = took.selectExpr("turn", "-choice._o as iou", "true as hit")
    result = result.union(missed.groupBy("turn").agg((-F.min("choice")["_o"]).alias("iou")).select("turn", "iou", F.lit(False)))
    out = d.join(result, "turn", "left").select(*det.columns, F.coalesce("iou", F.lit(0.0)).alias("iou"), F.coalesce("hit", F.lit(False)).alias("hit"))
    return out
