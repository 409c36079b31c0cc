"""Frame readings, quality flags, drift baseline, reference, windows, verdicts and episodes."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelake.operators.order import global_rank, percentiles, segmented_scan
from framelake.sources.scratch import cut

STATS = ("brightness", "contrast", "blur")
LOOK = 1000  # rows among which the first frames are looked for
FLAGS = (("dark", "brightness", "<", 20), ("bright", "brightness", ">", 235), ("low_contrast", "contrast", "<", 10), ("blurry", "blur", "<", 50))


def population_variance(px: Column) -> Column:
    """One pass over sums and squares; exact for whole grey values, as n * sum of squares - square of the sum is."""
    zero = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("q"))
    both = F.aggregate(px, zero, lambda a, x: F.struct((a["s"] + x).alias("s"), (a["q"] + x * x).alias("q")))
    n = F.size(px).cast("double")
    return F.transform(F.array(both), lambda a: F.greatest(F.lit(0.0), n * a["q"] - a["s"] * a["s"]) / (n * n))[0]


def readings(frames: DataFrame, side: int = 8) -> DataFrame:
    """brightness, contrast (population deviation) and blur (variance after a 3 x 3 edge filter, borders as they are) of square grey frames ``px``."""
    edge = f"""transform(px, (v, i) -> if(i < {side} or i >= {side * (side - 1)} or i % {side} = 0 or i % {side} = {side - 1}, v,
      least(255D, greatest(0D, 9 * v - (px[i - {side + 1}] + px[i - {side}] + px[i - {side - 1}] + px[i - 1] + v + px[i + 1] + px[i + {side - 1}] + px[i + {side}] + px[i + {side + 1}])))))"""
    mean = F.aggregate("px", F.lit(0.0), lambda s, x: s + x) / F.size("px")
    out = frames.withColumn("edges", F.expr(edge)).withColumn("brightness", mean).withColumn("contrast", F.sqrt(population_variance(F.col("px"))))
    return out.withColumn("blur", population_variance(F.col("edges"))).drop("edges")


def quality_flags(read: DataFrame) -> DataFrame:
    """A row for each flag of a frame, with what it read."""
    each = [F.when(F.expr(f"{c} {op} {v}"), F.struct(F.lit(n).alias("flag"), F.format_string(f"{c}=%.2f", F.bround(c, 2)).alias("detail"))) for n, c, op, v in FLAGS]
    return read.withColumn("f", F.explode(F.array_compact(F.array(*each)))).select("*", "f.flag", "f.detail").drop("f")


def dhash(frames: DataFrame, side: int = 8) -> DataFrame:
    """Bits of right pixel > left pixel, row by row, as text; solid frames are all zeros."""
    bits = f"array_join(transform(filter(sequence(0, {side * side - 1}), i -> i % {side} < {side - 1}), i -> if(px[i + 1] > px[i], '1', '0')), '')"
    return frames.withColumn("dhash", F.expr(bits))


def resized(frames: DataFrame, width: int, height: int, side: int = 8) -> DataFrame:
    """``px`` of square grey frames on a grid of ``width`` x ``height``: each cell the mean of the area that it covers."""
    span = lambda n, k: f"sequence({k} * {side} div {n}, (({k} + 1) * {side} - 1) div {n})"
    part = lambda n, k, i: f"greatest(0, least(({i} + 1) * {n}, ({k} + 1) * {side}) - greatest({i} * {n}, {k} * {side}))"
    row = f"aggregate({span(width, 'x')}, 0D, (t, c) -> t + {part(width, 'x', 'c')} * px[r * {side} + c])"
    cell = f"aggregate({span(height, 'y')}, 0D, (s, r) -> s + {part(height, 'y', 'r')} * {row}) / {side * side}"
    return frames.withColumn("px", F.expr(f"flatten(transform(sequence(0, {height - 1}), y -> transform(sequence(0, {width - 1}), x -> {cell})))"))


def dhash_text(frames: DataFrame, size: int = 8, side: int = 8) -> DataFrame:
    """``dhash``: right cell > left cell of the frame on ``size`` + 1 by ``size`` cells, row by row, as hexadecimal digits; solid frames are all zeros."""
    small = resized(frames, size + 1, size, side)
    bits = f"transform(filter(sequence(0, {size * (size + 1) - 1}), i -> i % {size + 1} < {size}), i -> if(px[i + 1] > px[i], '1', '0'))"
    digits = f"transform(sequence(0, {size * size // 4 - 1}), k -> lower(conv(array_join(slice(bits, 4 * k + 1, 4), ''), 2, 16)))"
    return small.withColumn("bits", F.expr(bits)).select("*", F.array_join(F.expr(digits), "").alias("dhash")).drop("bits", "px")


def shifted(frames: DataFrame, mode: str, amount: float | None = None, side: int = 8) -> DataFrame:
    """``px`` of square grey frames with a labelled fault: ``brightness`` times an amount (0.35), or a Gaussian blur of that radius, ``defocus`` (4).

    Borders of the blur repeat the edge. An empty table gives none; an unknown mode and an amount that isn't positive raise.
    """
    amount = {"brightness": 0.35, "defocus": 4.0}[mode] if amount is None else amount
    if amount <= 0:
        raise ValueError("the amount must be positive")
    if mode == "brightness":
        return frames.withColumn("px", F.transform("px", lambda p: F.least(F.lit(255.0), p * amount)))
    reach = math.ceil(3 * amount)
    kernel = [math.exp(-d * d / (2 * amount * amount)) for d in range(-reach, reach + 1)]
    taps = F.array(*[F.lit(k / sum(kernel)) for k in kernel])
    inside = lambda k: f"least({side - 1}, greatest(0, {k} + d - {reach}))"
    for at in (f"i div {side} * {side} + {inside(f'i % {side}')}", f"{inside(f'i div {side}')} * {side} + i % {side}"):
        frames = frames.withColumn("_taps", taps)
        blurred = f"transform(px, (v, i) -> aggregate(sequence(0, {2 * reach}), 0D, (s, d) -> s + _taps[d] * px[cast({at} as int)]))"
        frames = frames.withColumn("px", F.expr(blurred)).drop("_taps")
    return frames


def window_health(events: DataFrame, boxes: DataFrame) -> DataFrame:
    """window_id, cls, n_events, boxes_per_event, mean_conf and share of each window of ``events`` (window_id, event) with ``boxes`` (event, cls, conf).

    mean_conf is 0 where a window has no box. A class has a row from the first window on that holds it, with share 0 where it is
    absent; classes are few. Windows before any box have one row without a class.
    """
    both = events.select("window_id", "event").join(boxes.select("event", "cls", "conf"), "event", "left")
    per = both.groupBy("window_id", "cls").agg(F.count("conf").alias("n"), F.sum("conf").alias("s"))
    one = per.groupBy("window_id").agg(F.sum("n").alias("_n"), F.sum("s").alias("_s"))
    one = one.join(events.groupBy("window_id").agg(F.count(F.lit(1)).alias("n_events")), "window_id")
    seen = per.where("n > 0").groupBy("cls").agg(F.min("window_id").alias("_first")).withColumnRenamed("cls", "_cls")  # a row for each class
    grid = one.join(F.broadcast(seen), F.col("_first") <= F.col("window_id"), "left").withColumnRenamed("_cls", "cls")
    out = grid.join(per.where("n > 0").select("window_id", "cls", "n"), ["window_id", "cls"], "left")
    mean = F.when(F.col("_n") > 0, F.col("_s") / F.col("_n")).otherwise(0.0)
    share = F.when(F.col("cls").isNotNull(), F.coalesce("n", F.lit(0)) / F.col("_n"))
    share = F.when(F.col("_n") > 0, share).otherwise(F.when(F.col("cls").isNotNull(), 0.0))
    return out.select("window_id", "cls", "n_events", (F.col("_n") / F.col("n_events")).alias("boxes_per_event"), mean.alias("mean_conf"), share.alias("share"))


def baseline(read: DataFrame, scene: str) -> DataFrame:
    return read.groupBy(scene).agg(F.count(F.lit(1)).alias("n_frames"), *[F.avg(c).alias(c) for c in STATS])


def scale(c: str) -> Column:
    """Blur is judged as its logarithm."""
    return F.log(F.greatest(F.col(c), F.lit(1e-6))) if c == "blur" else F.col(c)


def reference(scenes: DataFrame, margin: float = 1.0) -> DataFrame:
    """centre, spread (population, unweighted) and threshold (largest |z| times margin) of each statistic; one row."""
    if margin <= 0:
        raise ValueError("margin must be positive")
    s = scenes.select(*[scale(c).alias(c) for c in STATS])
    one = s.agg(*[f(c).alias(f"{n}_{c}") for c in STATS for n, f in (("centre", F.avg), ("spread", F.stddev_pop))])
    z = s.crossJoin(F.broadcast(one))  # one row
    top = z.agg(*[(F.max(F.abs(F.col(c) - F.col(f"centre_{c}")) / F.col(f"spread_{c}")) * margin).alias(f"threshold_{c}") for c in STATS])
    return one.crossJoin(top)


def count_windows(rows: DataFrame, order: list[str], size: int, every: int = 1) -> DataFrame:
    """window_id and pos of every ``every``-th row in order; windows that aren't full are dropped.

    The order is global; ranks come from a range partitioning and a prefix over partition counts. Only the last
    window can be short, so the number of ranks tells which it is.
    """
    ranked = global_rank(rows, order)
    last = ranked.agg(F.expr(f"coalesce(max(rank), 0) div {every} div {size}").alias("_full"))  # one row
    kept = ranked.where(F.col("rank") % every == 0).withColumn("_r", F.expr(f"rank div {every} - 1"))
    out = kept.withColumns({"window_id": F.expr(f"_r div {size}"), "pos": F.expr(f"_r % {size}")})
    return out.crossJoin(F.broadcast(last)).where("window_id < _full").drop("rank", "_r", "_full")


def window_means(windows: DataFrame) -> DataFrame:
    return windows.groupBy("window_id").agg(F.count(F.lit(1)).alias("n_frames"), *[F.avg(c).alias(c) for c in STATS])


def verdicts(means: DataFrame, ref: DataFrame) -> DataFrame:
    """score_*, crossed_* and drifted of each window against the one reference row."""
    both = means.crossJoin(F.broadcast(ref))
    out = both.withColumns({f"score_{c}": F.abs(scale(c) - F.col(f"centre_{c}")) / F.col(f"spread_{c}") for c in STATS})
    out = out.withColumns({f"crossed_{c}": F.col(f"score_{c}") > F.col(f"threshold_{c}") for c in STATS})
    return out.withColumn("drifted", F.expr(" or ".join(f"crossed_{c}" for c in STATS)))


def episodes(judged: DataFrame, consecutive: int = 2) -> DataFrame:
    """Windows at which a run of drifted windows reaches ``consecutive``."""
    return segmented_scan(judged, [], ["window_id"], _run=("run", "drifted")).where(F.col("_run") == consecutive).drop("_run")


def latency(timings: DataFrame, warm: int = 3) -> DataFrame:
    """stage, n, mean, p50, p95, p99 of timings (frame, stage, ms), and of the sum of each frame's stages as ``total``.

    The first ``warm`` frames are left out, all are kept where there are no more. An empty table gives no row.
    What several steps read is written once, and the first frames are looked for among the first ``LOOK`` rows, in all only if these hold too few.
    """
    timings = cut(timings.select("frame", "stage", "ms"), "timings")
    low = timings.select("frame").orderBy("frame").limit(LOOK)
    frames, rows = low.groupBy("frame").count().agg(F.count(F.lit(1)), F.coalesce(F.sum("count"), F.lit(0))).first()
    if frames <= warm and rows == LOOK:
        low = timings.select("frame")
    first = low.distinct().orderBy("frame").limit(warm + 1).agg(F.when(F.count(F.lit(1)) > warm, F.max("frame")).alias("_least"))  # one row
    kept = timings.crossJoin(F.broadcast(first)).where("_least is null or frame >= _least").select("frame", "stage", "ms")
    total = kept.groupBy("frame").agg(F.sum("ms").alias("ms")).select(F.lit("total").alias("stage"), "ms")
    spans = cut(kept.select("stage", "ms").unionByName(total), "spans")
    return percentiles(spans, ["stage"], "ms", {"p50": 0.5, "p95": 0.95, "p99": 0.99})


def monitor_readings(judged: DataFrame, opened: DataFrame) -> DataFrame:
    """Metric rows (window_id, name, label, value): each window's scores beside their thresholds, and up to each window how many were ok, drifted and opened an episode.
    """
    both = judged.join(opened.select("window_id", F.lit(1).alias("_open")), "window_id", "left")
    one = lambda c: ("sum", F.when(c, 1.0).otherwise(0.0))
    counted = segmented_scan(both, [], ["window_id"], _ok=one(~F.col("drifted")), _drifted=one(F.col("drifted")), _opened=one(F.col("_open").isNotNull()))
    row = lambda name, label, value: F.struct(F.lit(name).alias("name"), F.lit(label).alias("label"), F.col(value).cast("double").alias("value"))
    each = [row(f"drift_{k}", c, f"{k}_{c}") for c in STATS for k in ("score", "threshold")]
    each += [row("drift_windows", "ok", "_ok"), row("drift_windows", "drifted", "_drifted"), row("drift_episodes", "", "_opened")]
    return counted.select("window_id", F.explode(F.array(*each)).alias("_m")).select("window_id", "_m.*")


def episode_evidence(opened: DataFrame, windows: DataFrame, first_step: int = 0) -> DataFrame:
    """A record of each episode: step, window_id, place (sequence/first-last, in order of appearance), crossed, scores, thresholds, n_frames and its evidence frames.

    ``windows`` has window_id, pos, sequence and frame_index of each sample; evidence are the first, the middle and the last one.
    """
    size = F.count(F.lit(1)).over(Window.partitionBy("window_id"))
    rows = windows.join(opened.select("window_id"), "window_id", "left_semi").withColumn("_n", size)
    spans = rows.groupBy("window_id", "sequence").agg(F.min("pos").alias("_o"), F.min("frame_index").alias("_a"), F.max("frame_index").alias("_b"))
    spans = spans.select("window_id", "_o", F.format_string("%s/%d-%d", "sequence", "_a", "_b").alias("_s"))
    where = spans.groupBy("window_id").agg(F.array_sort(F.collect_list(F.struct("_o", "_s"))).alias("_w")).select("window_id", F.array_join("_w._s", ", ").alias("place"))
    picked = rows.where("pos = 0 or pos = _n div 2 or pos = _n - 1").groupBy("window_id").agg(
        F.max("_n").alias("n_frames"), F.array_sort(F.collect_list(F.struct("pos", "frame_index"))).alias("_e")).select("window_id", "n_frames", F.col("_e.frame_index").alias("evidence"))
    opened = global_rank(opened, ["window_id"])
    step = (F.col("rank") - 1 + first_step).alias("step")
    crossed = F.array_compact(F.array(*[F.when(F.col(f"crossed_{c}"), c) for c in STATS])).alias("crossed")
    told = [F.struct(*[F.col(f"{k}_{c}").alias(c) for c in STATS]).alias(f"{k}s") for k in ("score", "threshold")]
    return opened.select("window_id", step, crossed, *told).join(where, "window_id").join(picked, "window_id")


def profile_document(read: DataFrame, hashes: DataFrame, boxes: DataFrame, baseline_split: str) -> DataFrame:
    """One row ``value``: the profile of readings (split, label and the statistics) as JSON of fixed sections.

    ``hashes`` has the dhash of each frame, ``boxes`` one row n_boxes. Only sums meet in the last task.
    """
    by = read.groupBy("split").agg(F.count(F.lit(1)).alias("n_frames"), *[F.avg(c).alias(c) for c in STATS])
    splits = by.agg(F.map_from_entries(F.collect_list(F.struct("split", F.struct("n_frames", *STATS)))).alias("splits"), F.sum("n_frames").alias("n_frames"))  # a row for each split
    flagged = quality_flags(read).agg(F.count(F.lit(1)).alias("n_flagged"))
    clusters = hashes.groupBy("dhash").count().where("count > 1").agg(F.count(F.lit(1)).alias("n_duplicate_clusters"))
    scenes = read.where(F.col("split") == baseline_split).agg(F.countDistinct("label").alias("n_sequences"))
    one = splits.crossJoin(flagged).crossJoin(clusters).crossJoin(scenes).crossJoin(boxes)  # one row each
    dataset = F.struct("n_boxes", "n_duplicate_clusters", "n_flagged", "n_frames").alias("dataset")
    return one.select(F.to_json(F.struct(F.struct("n_sequences", F.lit(baseline_split).alias("split")).alias("baseline"), dataset, F.lit(2).alias("schema_version"), "splits")).alias("value"))


def dataset_totals(read: DataFrame, hashes: DataFrame, boxes: DataFrame, baseline_split: str) -> DataFrame:
    """One row n_frames, n_boxes, n_flagged, n_clusters, n_baseline_sequences of readings (split, label and the statistics).

    ``hashes`` has the dhash of each frame, ``boxes`` a row for each box. n_flagged counts flags, of which a frame may have several; a
    cluster is a hash of two frames or more. Sums alone are shuffled, and hashes with their counts. Empty tables give zeros.
    """
    n = F.count(F.lit(1))
    frames = read.agg(n.alias("n_frames"), F.countDistinct(F.when(F.col("split") == baseline_split, F.col("label"))).alias("n_baseline_sequences"))
    rest = [boxes.agg(n.alias("n_boxes")), quality_flags(read).agg(n.alias("n_flagged")), hashes.groupBy("dhash").count().where("count > 1").agg(n.alias("n_clusters"))]
    for one in rest:
        frames = frames.crossJoin(one)  # one row each
    return frames.select("n_frames", "n_boxes", "n_flagged", "n_clusters", "n_baseline_sequences")


FRAME_COUNTS = "sequence string, n_frames bigint, n_skipped bigint, last_ms bigint"


def frame_counts(frames: DataFrame, reading: str, ts_ms: str) -> DataFrame:
    """Of each sequence: frames, those skipped because they have no ``reading``, and the time of the last one that has. Counts of parts add up by ``monitor_ages``."""
    fine = F.col(reading).isNotNull()
    return frames.groupBy("sequence").agg(F.count(F.lit(1)).alias("n_frames"), F.count_if(~fine).alias("n_skipped"), F.max(F.when(fine, F.col(ts_ms))).alias("last_ms"))


def monitor_ages(counts: DataFrame, now_ms: DataFrame) -> DataFrame:
    """(sequence, n_frames, n_skipped, skip_rate, age_s) over all parts of ``frame_counts``; ``now_ms`` is a row with the clock.

    age_s is the time since the last frame with a reading, null where there was none.
    """
    by = counts.groupBy("sequence").agg(F.sum("n_frames").alias("n_frames"), F.sum("n_skipped").alias("n_skipped"), F.max("last_ms").alias("last_ms"))
    with_clock = by.crossJoin(F.broadcast(now_ms.agg(F.max(now_ms.columns[0]).alias("_now"))))  # one row
    return with_clock.selectExpr("sequence", "n_frames", "n_skipped", "n_skipped / n_frames as skip_rate", "(_now - last_ms) / 1000 as age_s")


def unrecorded(opened: DataFrame, records: DataFrame, key: str = "window_id") -> DataFrame:
    """Episodes that opened but of which no record was kept."""
    return opened.join(records.select(key).distinct(), key, "left_anti")
