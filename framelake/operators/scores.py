"""Tracking scores from tables of boxes with ids: HOTA, DetA, AssA, IDF1 and switches, by their published definitions.

Boxes are gt and tracks with sequence, cls, frame_index, id and corners, an id once a frame. Pairs come from a join within
a frame, counts from grouping; only one-to-one assignments run in Python, over arrays of one frame's pairs, or for IDF1
of the pairs of one connected group of ids, found by joins over all pairs of ids. So time and memory of a task follow the
pairs that really compete, not the ids of a sequence. Switches follow a sequence's frames in order, a batch of rows at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framelake.functions import geometry as G
from framelake.operators.aggregate import counted
from framelake.sources.scratch import cut, new_path

ALPHAS = tuple(k / 20 for k in range(1, 20))
TRACK = ["sequence", "cls"]
FRAME = [*TRACK, "frame_index"]
PAIR = [*TRACK, "gt_id", "track_id"]


def assign(gain: np.ndarray) -> list[tuple[int, int]]:
    """One-to-one (row, column) of greatest total gain, by shortest augmenting paths; the shorter side is paired whole."""
    if not gain.size:
        return []
    if gain.shape[0] > gain.shape[1]:
        return [(i, j) for j, i in assign(gain.T)]
    cost = gain.max() - gain
    rows, columns = cost.shape
    row_price, price, holder = np.zeros(rows), np.zeros(columns), np.full(columns, -1)
    for start in range(rows):
        least, via, done = np.full(columns, np.inf), np.full(columns, -1), np.zeros(columns, bool)
        row, column, reach = start, -1, 0.0
        while row >= 0:
            offer = reach + cost[row] - row_price[row] - price
            better = ~done & (offer < least)
            least[better], via[better] = offer[better], column
            column = int(np.argmin(np.where(done, np.inf, least)))
            reach, done[column], row = float(least[column]), True, int(holder[column])
        row_price[start] += reach
        for j in np.flatnonzero(done & (holder >= 0)):
            row_price[holder[j]] += reach - least[j]
        price[done] -= reach - least[done]
        while column >= 0:
            before = int(via[column])
            holder[column] = start if before < 0 else holder[before]
            column = before
    return [(int(holder[j]), int(j)) for j in np.flatnonzero(holder >= 0)]


def sparse_pairs(rows: np.ndarray, columns: np.ndarray, gain: np.ndarray) -> np.ndarray:
    """Which of the given (row, column) pairs a one-to-one assignment of the greatest total gain takes; gains are positive.

    Pairs fall into connected groups of rows and columns, which are assigned each for itself, so the tables that are filled are
    those of groups that really compete.
    """
    taken = np.zeros(len(rows), bool)
    if not len(rows):
        return taken
    _, r = np.unique(rows, return_inverse=True)
    _, c = np.unique(columns, return_inverse=True)
    label = np.arange(len(rows))  # of each pair: the least pair that it hangs together with
    while True:
        low = label.copy()
        for side in (r, c):
            least = np.full(side.max() + 1, len(rows))
            np.minimum.at(least, side, low)
            low = least[side]
        low = low[low]
        if (low == label).all():
            break
        label = low
    order = np.argsort(label, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(label[order])) + 1):
        if len(group) == 1:
            taken[group] = True
            continue
        _, i = np.unique(r[group], return_inverse=True)
        _, j = np.unique(c[group], return_inverse=True)
        table, at = np.zeros((i.max() + 1, j.max() + 1)), np.full((i.max() + 1, j.max() + 1), -1)
        table[i, j], at[i, j] = gain[group], group
        picked = [at[x, y] for x, y in assign(table)]
        taken[[k for k in picked if k >= 0]] = True
    return taken


def overlaps(gt: DataFrame, tracks: DataFrame) -> DataFrame:
    """Pairs of boxes of one sequence, class and frame with a common area: gt_id, track_id, iou."""
    a, b = (G.prefixed(df.select(*FRAME, F.col("id").alias(name), *G.CORNERS), p) for df, name, p in ((gt, "gt_id", "g_"), (tracks, "track_id", "t_")))
    return a.join(b, FRAME).withColumn("iou", G.iou("g_", "t_")).where("iou > 0").select(*FRAME, "gt_id", "track_id", "iou")


def _apart(rows: list, columns: list) -> bool:
    """Whether no two pairs share a row or a column, so that an assignment takes all of them."""
    return len(set(rows)) == len(rows) == len(set(columns))


def _assigned(pairs: DataFrame, keys: list[str], gain: str, value: str) -> DataFrame:
    """keys, gt_id, track_id and ``value`` of the pairs that an assignment within ``keys`` by ``gain`` takes."""
    rows = pairs.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("gt_id", "track_id", F.col(gain).cast("double").alias("gain"), F.col(value).cast("double").alias("value")))).alias("pairs"))
    kinds = rows.schema["pairs"].dataType.elementType
    schema = ", ".join([*(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keys), *(f"{c} {kinds[c].dataType.simpleString()}" for c in ("gt_id", "track_id")), f"{value} double"])

    def run(batches):
        import pandas as pd

        for b in batches:
            out = []
            for *key, met in b[[*keys, "pairs"]].itertuples(index=False, name=None):
                if _apart([p["gt_id"] for p in met], [p["track_id"] for p in met]):
                    out += [(*key, p["gt_id"], p["track_id"], p["value"]) for p in met]
                    continue
                left, right = (np.unique([p[c] for p in met], return_inverse=True)[1] for c in ("gt_id", "track_id"))
                taken = sparse_pairs(left, right, np.array([p["gain"] for p in met]))
                out += [(*key, met[k]["gt_id"], met[k]["track_id"], met[k]["value"]) for k in np.flatnonzero(taken).tolist()]
            yield pd.DataFrame(out, columns=[*keys, "gt_id", "track_id", value])

    return rows.mapInPandas(run, schema)


def id_groups(pairs: DataFrame) -> DataFrame:
    """Distinct pairs (sequence, cls, gt_id, track_id, ..) with ``group``: the least gt_id that a pair hangs together with, over ids it shares with others.

    Each round an id takes the least label that it meets over a common track, hands that on to the id whose label it had, and then takes its new label's
    own; labels are written, with a count of those that changed. Rounds grow with the logarithm of a group's length. An empty table has no groups.
    """
    spark = pairs.sparkSession
    edges = pairs.select(*PAIR)
    labels = edges.select(*TRACK, "gt_id").distinct().withColumn("label", F.col("gt_id"))
    changed = 1
    while changed:
        near = edges.join(labels, [*TRACK, "gt_id"])
        by_track = near.groupBy(*TRACK, "track_id").agg(F.min("label").alias("_m"))
        met = near.join(by_track, [*TRACK, "track_id"]).groupBy(*TRACK, "gt_id", "label").agg(F.min("_m").alias("_m"))
        hooked = met.groupBy(*TRACK, F.col("label").alias("gt_id")).agg(F.min("_m").alias("_h"))
        next_ = met.join(hooked, [*TRACK, "gt_id"], "left").select(*TRACK, "gt_id", "label", F.least("_m", F.coalesce("_h", "_m")).alias("_n"))
        up = next_.select(*TRACK, F.col("gt_id").alias("_n"), F.col("_n").alias("_up"))
        rows, seen = counted(next_.join(up, [*TRACK, "_n"]).select(*TRACK, "gt_id", "label", "_up"), changed=F.col("_up") != F.col("label"))
        path = new_path(spark, "id-groups")
        rows.select(*TRACK, "gt_id", F.col("_up").alias("label")).write.parquet(path)
        changed, labels = seen.get["changed"], spark.read.schema(labels.schema).parquet(path)
    return pairs.join(labels.withColumnRenamed("label", "group"), [*TRACK, "gt_id"])


def kept_pairs(gt: DataFrame, tracks: DataFrame, pairs: DataFrame) -> DataFrame:
    """sequence, cls, frame_index, gt_id, track_id of the ``pairs`` that each frame's assignment takes, where a pair that the frame before took goes before all others.

    The frame before is the last one that has true boxes and tracks of the class; where those don't meet, nothing is preferred in the next.
    Frames of a sequence and class pass through one task in order, in batches; it holds one frame's pairs and those taken in the frame before.
    """
    least = lambda rows, name: rows.where("id is not null").groupBy(*FRAME).agg(F.min("id").alias(name))
    shown = least(gt, "_g").join(least(tracks, "_t"), FRAME)  # frames without a pair stay, with some ids in place of it
    rows = shown.join(pairs.where("gt_id is not null and track_id is not null"), FRAME, "left")
    rows = rows.select(*FRAME, F.coalesce("gt_id", "_g").alias("gt_id"), F.coalesce("track_id", "_t").alias("track_id"), F.coalesce("iou", F.lit(0.0)).alias("iou"))
    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in (*FRAME, "gt_id", "track_id"))

    def run(batches):
        import pandas as pd

        at, before, held = None, {}, None

        def frame(key, left, right, iou):
            """Places of the pairs that one frame takes."""
            nonlocal at, before
            if key != at:
                at, before = key, {}
            if min(iou) <= 0:
                taken = []
            elif _apart(left, right):
                taken = range(len(left))
            else:
                stays = np.array([before.get(g, None) == t for g, t in zip(left, right, strict=True)])
                taken = np.flatnonzero(sparse_pairs(np.array(left), np.array(right), np.array(iou) + 1000 * stays)).tolist()
            before = {left[k]: right[k] for k in taken}
            return taken

        def frames(rows, ends):
            """The rows that the frames between ``ends`` take; frames cost a step over plain lists each."""
            keys = list(zip(*(rows[c].tolist() for c in TRACK), strict=True))
            left, right, iou = (rows[c].tolist() for c in ("gt_id", "track_id", "iou"))
            picked = [a + k for a, b in zip(ends[:-1], ends[1:], strict=True) for k in frame(keys[a], left[a:b], right[a:b], iou[a:b])]
            return rows.iloc[picked][[*FRAME, "gt_id", "track_id"]]

        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if rows.empty:
                continue
            first = np.flatnonzero((rows[FRAME] != rows[FRAME].shift()).any(axis=1).to_numpy()).tolist()
            held = rows.iloc[first[-1] :].reset_index(drop=True)  # the last frame may go on in the next batch
            yield frames(rows, first)
        if held is not None:
            yield frames(held, [0, len(held)])

    parts = int(gt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, *TRACK).sortWithinPartitions(*FRAME, "gt_id", "track_id").mapInPandas(run, schema)


def tracking_scores(gt: DataFrame, tracks: DataFrame, by: Sequence[str] = ("cls",)) -> DataFrame:
    """hota, det_a, ass_a (means over the 19 thresholds), idf1 and switches for each group ``by`` (of sequence and cls) with true boxes.

    Frames are assigned once, by IoU times how well the two ids agree over their sequence, and a pair counts at each
    threshold that its IoU reaches; counts are summed over sequences before ratios are taken. A switch is a true id whose
    track at IoU 0.5 differs from that of its last matched frame, by the assignment of ``kept_pairs``. Groups without tracks score 0; null ids and keys meet nothing.
    """
    by = list(by)
    pairs = overlaps(gt, tracks)
    n_g = gt.groupBy(*TRACK, F.col("id").alias("gt_id")).agg(F.count(F.lit(1)).alias("n_g"))
    n_t = tracks.groupBy(*TRACK, F.col("id").alias("track_id")).agg(F.count(F.lit(1)).alias("n_t"))

    def sized(rows: DataFrame) -> DataFrame:
        return rows.join(n_g, [*TRACK, "gt_id"]).join(n_t, [*TRACK, "track_id"])

    around = F.sum("iou").over(Window.partitionBy(*FRAME, "gt_id")) + F.sum("iou").over(Window.partitionBy(*FRAME, "track_id")) - F.col("iou")
    agreed = sized(pairs.withColumn("share", F.col("iou") / around).groupBy(*PAIR).agg(F.sum("share").alias("m"))).withColumn("agree", F.expr("m / (n_g + n_t - m)"))
    taken = _assigned(pairs.join(agreed.select(*PAIR, "agree"), PAIR).withColumn("gain", F.expr("iou * agree")), FRAME, "gain", "iou")
    reach = taken.withColumn("alpha", F.explode(F.array(*map(F.lit, ALPHAS)))).where("iou >= alpha - 1e-12D")
    held = sized(reach.groupBy(*PAIR, "alpha").agg(F.count(F.lit(1)).alias("c")))
    sums = held.groupBy(*by, "alpha").agg(F.sum("c").alias("tp"), F.sum(F.expr("c * c / (n_g + n_t - c)")).alias("a"))
    all_g, all_t = n_g.groupBy(*by).agg(F.sum("n_g").alias("g")), n_t.groupBy(*by).agg(F.sum("n_t").alias("t"))
    total = all_g.join(all_t, by, "left").na.fill(0, subset=["t"])
    each = sums.join(total, by).withColumns({"d": F.expr("tp / (g + t - tp)"), "s": F.expr("a / tp")})
    n = len(ALPHAS)
    main = each.groupBy(*by).agg(*[(F.sum(e) / n).alias(c) for c, e in (("hota", F.sqrt(F.col("d") * F.col("s"))), ("det_a", F.col("d")), ("ass_a", F.col("s")))])
    met = pairs.where("iou >= 0.5D").groupBy(*PAIR).agg(F.count(F.lit(1)).alias("n"))
    ids = _assigned(id_groups(cut(met, "met-ids")), [*TRACK, "group"], "n", "n").groupBy(*by).agg(F.sum("n").alias("id_tp"))
    last = F.lag("track_id").over(Window.partitionBy(*TRACK, "gt_id").orderBy("frame_index"))
    switches = kept_pairs(gt, tracks, pairs.where("iou >= 0.5D")).withColumn("last", last).groupBy(*by).agg(F.count_if(F.col("last") != F.col("track_id")).alias("switches"))
    out = total.join(main, by, "left").join(ids, by, "left").join(switches, by, "left").na.fill(0, subset=["hota", "det_a", "ass_a", "id_tp", "switches"])
    return out.select(*by, "hota", "det_a", "ass_a", F.expr("2 * id_tp / (g + t)").alias("idf1"), "switches")
