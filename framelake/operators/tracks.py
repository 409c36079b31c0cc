"""Labels of tiles, annotation text, raw scores to boxes, slugs, and tables of runs and versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelake.operators.matching import suppress_classes
from framelake.operators.order import global_rank, top_k


def slice_labels(boxes: DataFrame, width: int, height: int, side: int, least: float = 0.1) -> DataFrame:
    """Boxes (cls, xc, yc, w, h of a frame) that lie in a tile x0, y0 of ``side`` by ``least`` of their area or more, clipped to it and normalised by it."""
    px = {"_l": "(xc - w / 2) * {W}", "_r": "(xc + w / 2) * {W}", "_t": "(yc - h / 2) * {H}", "_b": "(yc + h / 2) * {H}"}
    out = boxes.withColumns({c: F.expr(e.format(W=width, H=height)) for c, e in px.items()})
    clip = {"_cl": f"least(greatest(_l, x0), x0 + {side})", "_cr": f"least(greatest(_r, x0), x0 + {side})", "_ct": f"least(greatest(_t, y0), y0 + {side})", "_cb": f"least(greatest(_b, y0), y0 + {side})"}
    out = out.withColumns({c: F.expr(e) for c, e in clip.items()}).withColumn("_in", F.expr("(_cr - _cl) * (_cb - _ct)"))
    out = out.where(f"_in > 0 and _in >= {least} * (_r - _l) * (_b - _t)")
    out = out.withColumns({"xc": F.expr(f"((_cl + _cr) / 2 - x0) / {side}"), "yc": F.expr(f"((_ct + _cb) / 2 - y0) / {side}"), "w": F.expr(f"(_cr - _cl) / {side}"), "h": F.expr(f"(_cb - _ct) / {side}")})
    return out.drop(*[c for c in out.columns if c.startswith("_")])


def six_digits(x: Column) -> Column:
    """A number in six significant digits without trailing zeros, with an exponent of two digits below 1e-4 and from 1e6 on."""
    strip = lambda s: F.regexp_replace(s, r"\.?0+$", "")

    def written(parts: Column) -> Column:
        power = parts[1].cast("int")
        plain = F.coalesce(*[F.when(power == k, F.format_string(f"%.{5 - k}f", x.cast("double"))) for k in range(-4, 6)])
        small = F.concat(strip(parts[0]), F.when(power < 0, "e-").otherwise("e+"), F.format_string("%02d", F.abs(power)))
        return F.coalesce(F.regexp_replace(plain, r"\.0+$|(?<=\.[0-9]{0,9})0+$", ""), small)  # zeros behind a point

    # inside a lambda the parts are formatted once, not in each branch
    return F.when(x == 0, "0").otherwise(F.transform(F.array(F.split(F.format_string("%.5e", x.cast("double")), "e")), written)[0])


def annotation_line(conf: Column, track: Column) -> Column:
    """frame,track,x1,y1,w,h,conf,category,-1,-1 with two decimals for pixels and six digits for the confidence; track -1 where there is none."""
    px = [F.expr(f"bround(cast({e} as double), 2)") for e in ("x1", "y1", "x2 - x1", "y2 - y1")]  # halves to even, as the rule has it
    return F.format_string("%d,%d,%.2f,%.2f,%.2f,%.2f,%s,%d,-1,-1", "frame_index", F.coalesce(track, F.lit(-1)), *px, six_digits(conf), "category")


def variant_parts(slug: Column) -> list[Column]:
    """runtime, precision and imgsz of ``<runtime>-<precision>-<imgsz>``, split from the right; null where it is no such slug."""
    ok = slug.rlike(r"^.+-[^-]+-\d+$")
    return [F.when(ok, F.regexp_extract(slug, r"^(.+)-([^-]+)-(\d+)$", k)).alias(n) for k, n in ((1, "runtime"), (2, "precision"), (3, "imgsz"))]


def tag_slug(tag: Column) -> Column:
    """The variant slug that a tag ``optimize.<slug with _>`` addresses, null for any other tag."""
    slug = F.replace(F.substring(tag, 10, 1 << 20), F.lit("_"), F.lit("-"))
    return F.when(F.startswith(tag, F.lit("optimize.")) & slug.rlike(r"^.+-[^-]+-\d+$"), slug)


def uri_slug(text: Column) -> Column:
    return F.regexp_replace(text, r"[^A-Za-z0-9._-]+", "-")


def memory_delta() -> Column:
    """after - before where both exist and their scopes are the same."""
    return F.when(F.col("scope_before") == F.col("scope_after"), F.col("after") - F.col("before"))


def decode_scores(raw: DataFrame, least: float, cap: int, keys: list[str]) -> DataFrame:
    """Anchors (xc, yc, w, h, scores) to corner boxes of every class whose score is above ``least``; the first ``cap`` of a frame by score, then anchor and class."""
    out = raw.select("*", F.posexplode("scores").alias("cls", "conf")).where(F.col("conf") > least)
    out = out.withColumns({"x1": F.expr("xc - w / 2"), "y1": F.expr("yc - h / 2"), "x2": F.expr("xc + w / 2"), "y2": F.expr("yc + h / 2")}).drop("scores", "xc", "yc", "w", "h")
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("conf").desc(), "anchor", "cls"))
    return out.withColumn("_k", place).where(F.col("_k") <= cap).drop("_k")


def decode_best(raw: DataFrame, least: float, iou: float, keys: list[str], most: int = 30_000, top: int = 300) -> DataFrame:
    """Anchors (anchor, xc, yc, w, h, scores) to corner boxes of the best class, the first of equal ones, whose score is above ``least``.

    The ``most`` best of a frame go on, of which suppression keeps those of a class whose overlap with a better one is at most ``iou``; then the first ``top`` by score.
    """
    best = raw.withColumn("conf", F.array_max("scores")).where(F.col("conf") > least).withColumn("cls", F.array_position("scores", F.col("conf")) - 1)
    boxes = best.select(*keys, "anchor", "cls", "conf", *[F.expr(f"{c} {op} {s} / 2").alias(n) for n, c, op, s in (("x1", "xc", "-", "w"), ("y1", "yc", "-", "h"), ("x2", "xc", "+", "w"), ("y2", "yc", "+", "h"))])
    order = [F.col("conf").desc(), "anchor"]
    return suppress_classes(top_k(boxes, keys, order, most), keys, iou, top)


def label_faults(lines: DataFrame) -> DataFrame:
    """Label ``lines`` (line) with ``cls`` and ``fault``; blank ones go.

    Faults, the first that holds: not five fields, a field that is no number, a class outside 0 to 2, a coordinate outside 0 to 1, a size of 0.
    A class outside its range may come with a fault of its coordinates; then both are named, as ``class, range``. No fault is null.
    """
    f = F.split(F.trim(F.regexp_replace("line", r"\s+", " ")), " ")
    out = lines.where(F.trim(F.regexp_replace("line", r"\s+", " ")) != "").withColumn("_f", f)
    out = out.withColumns({"cls": F.expr("try_cast(_f[0] as int)"), "_v": F.expr("transform(slice(_f, 2, 4), x -> try_cast(x as double))")})
    numeric = F.expr("cls is not null and _f[0] rlike '^[+-]?[0-9]+$' and not exists(_v, x -> x is null)")
    coords = F.when(F.expr("exists(_v, x -> not x between 0 and 1)"), "range").when(F.expr("_v[2] <= 0 or _v[3] <= 0"), "size")
    both = F.nullif(F.concat_ws(", ", F.when(~F.col("cls").between(0, 2), "class"), coords), F.lit(""))
    return out.withColumn("fault", F.when(F.size("_f") != 5, "fields").when(~numeric, "numeric").otherwise(both)).drop("_f", "_v")


def pairing_report(images: DataFrame, labels: DataFrame) -> DataFrame:
    """split, fault, n and the first three names of images without a label and of labels without an image; both have split and name."""
    both = images.distinct().withColumn("_i", F.lit(True)).join(labels.distinct().withColumn("_l", F.lit(True)), ["split", "name"], "full")
    lone = both.where("_i is null or _l is null").select("split", "name", F.when(F.col("_i").isNull(), "no image").otherwise("no label").alias("fault"))
    first = top_k(lone, ["split", "fault"], ["name"], 3).groupBy("split", "fault").agg(F.array_join(F.array_sort(F.collect_list("name")), ", ").alias("examples"))
    return lone.groupBy("split", "fault").agg(F.count(F.lit(1)).alias("n")).join(first, ["split", "fault"])


def promotable(versions: DataFrame, tags: DataFrame, served: dict[str, str]) -> DataFrame:
    """(target, version) of versions (version, imgsz) with tag ``gate.passed`` of value True and the served variant's tag, ``served`` of the target and the size, of any value."""
    passed = tags.where("tag = 'gate.passed' and value = 'True'").select("version").distinct()
    wanted = versions.select("version", "imgsz", F.explode(F.create_map(*[F.lit(x) for kv in served.items() for x in kv])).alias("target", "_p"))
    wanted = wanted.withColumn("tag", F.concat("_p", F.col("imgsz").cast("string")))
    return wanted.join(tags.select("version", "tag"), ["version", "tag"], "left_semi").join(passed, "version", "left_semi").select("target", "version")


def dataset_faults(images: DataFrame, labels: DataFrame, lines: DataFrame, splits=("train", "val", "test"), classes=(0, 1, 2)) -> DataFrame:
    """(split, fault, n): all that is wrong with a dataset; no row means that it is fit for use.

    ``images`` and ``labels`` have split and name, ``lines`` split and line. Faults are those of ``label_faults`` by line, images
    without a label and labels without an image, a split of ``splits`` that has no image, and, of no split, a class of ``classes`` that no readable
    line names. Empty tables have all splits empty and all classes absent.
    """
    spark = lines.sparkSession
    judged = label_faults(lines)
    by = judged.groupBy("split", "fault", F.when(F.expr("fault is null or fault not in ('fields', 'numeric')"), F.col("cls")).alias("cls")).agg(F.count(F.lit(1)).alias("n"))
    of_lines = by.where("fault is not null").groupBy("split", "fault").agg(F.sum("n").alias("n"))
    pairs = pairing_report(images, labels).select("split", "fault", "n")
    wanted = spark.createDataFrame([(s,) for s in splits], "split string").join(images.select("split").distinct(), "split", "left_anti")
    named = spark.createDataFrame([(c,) for c in classes], "cls int").join(by.select("cls").distinct(), "cls", "left_anti")
    empty = wanted.select("split", F.lit("no images").alias("fault"), F.lit(1).cast("long").alias("n"))
    absent = named.select(F.lit(None).cast("string").alias("split"), F.format_string("class %d has no box", "cls").alias("fault"), F.lit(1).cast("long").alias("n"))
    return of_lines.unionByName(pairs).unionByName(empty).unionByName(absent)


def routes(faults: DataFrame, stamps: DataFrame, key: str) -> DataFrame:
    """(key, n_faults, route) of each source of ``faults`` (key, n_faults): rebuild one that has faults, profile one whose stamp isn't current or is missing, validate the others.

    ``stamps`` has key and current, once for each source.
    """
    route = F.when(F.col("n_faults") > 0, "rebuild").when(F.coalesce("current", F.lit(False)), "validate").otherwise("profile")
    return faults.select(key, "n_faults").join(stamps.select(key, "current"), key, "left").select(key, "n_faults", route.alias("route"))


def find_or_create(stored: DataFrame, wanted: DataFrame, identity: str, order: str) -> DataFrame:
    """``stored`` (identity, version) with what ``wanted`` lacks there added, and ``created``.

    New versions go on after the highest stored one, by the least ``order`` of the identity. Rows of ``wanted`` that share an identity make
    one version; a null identity makes none. Append the created rows to the stored table.
    """
    new = wanted.where(F.col(identity).isNotNull()).join(stored.select(identity), identity, "left_anti").groupBy(identity).agg(F.min(order).alias("_o"))
    last = stored.agg(F.coalesce(F.max("version"), F.lit(0)).alias("_last"))  # one row
    made = global_rank(new, ["_o", identity]).crossJoin(F.broadcast(last)).select(identity, (F.col("_last") + F.col("rank")).alias("version"), F.lit(True).alias("created"))
    return stored.select(identity, F.col("version").cast("long").alias("version"), F.lit(False).alias("created")).unionByName(made)


def append_children(parents: DataFrame, marked: DataFrame) -> DataFrame:
    """``marked`` (parent, child) with a new child for each of ``parents`` (parent) that has none, and ``created``; a parent without a name gets none."""
    lone = parents.where("parent is not null").distinct().join(marked, "parent", "left_anti")
    made = lone.select("parent", F.concat(F.col("parent").cast("string"), F.lit("-record")).alias("child"), F.lit(True).alias("created"))
    return marked.select("parent", F.col("child").cast("string").alias("child"), F.lit(False).alias("created")).unionByName(made)


def report_rows(metrics: DataFrame, primary: str, roles: tuple[str, ...] = ("candidate", "champion")) -> DataFrame:
    """role, metric, value and cls for each of ``roles`` and every metric of ``metrics`` (role, metric, value): null where a role lacks it; cls is what follows ``/primary/``."""
    keys = metrics.select("metric").distinct().withColumn("role", F.explode(F.array(*map(F.lit, roles))))
    out = keys.join(metrics, ["role", "metric"], "left")
    cls = F.nullif(F.regexp_extract("metric", f"^.*/{primary}/(.*)$", 1), F.lit(""))
    return out.select("role", "metric", F.round("value", 6).alias("value"), cls.alias("cls"))


def metric_rows(rows: DataFrame, prefix: str, name: str, floor: float) -> DataFrame:
    """(metric, value): the mean of ``rows`` (cls, group, value) as prefix/name, by class as prefix/name/cls, by group as prefix/group/name, and of values from ``floor`` on as prefix/name@floor.

    One aggregate over small sums; an empty table gives no row, and so does a floor that nothing reaches.
    """
    key = f"{prefix}/{name}"
    at = F.when(F.col("value") >= floor, F.lit(f"{key}@{floor}"))
    keys = F.array_compact(F.array(F.lit(key), F.concat(F.lit(key + "/"), "cls"), F.concat(F.lit(prefix + "/"), "group", F.lit("/" + name)), at))
    return rows.select("value", F.explode(keys).alias("metric")).groupBy("metric").agg(F.avg("value").alias("value"))


def stamp(source_hash: Column, **params: Column) -> Column:
    """SHA-256 of the text {source hash, params} with sorted keys, as the identity of a computed table."""
    parts = [F.concat(F.lit(f'"{k}":'), v.cast("string")) for k, v in sorted(params.items())]
    return F.sha2(F.concat(F.lit('{"params":{'), F.concat_ws(",", *parts), F.lit('},"source":"'), source_hash, F.lit('"}')), 256)


def gate(candidates: DataFrame, champions: DataFrame, floors: dict[str, float], primary: str, margin: float) -> DataFrame:
    """``candidates`` (name and a column for each metric) with <metric>_ok, champion, challenger_ok and passed.

    A metric that is missing counts as 0. The challenger must reach the champion (name, champion) in ``primary`` by ``margin``; it
    wins where there is none.
    """
    both = candidates.join(champions, "name", "left")
    both = both.withColumns({f"{m}_ok": F.coalesce(F.col(m), F.lit(0.0)) >= v for m, v in floors.items()})
    both = both.withColumn("challenger_ok", F.col("champion").isNull() | (F.coalesce(F.col(primary), F.lit(0.0)) >= F.col("champion") + margin))
    return both.withColumn("passed", F.expr(" and ".join([*(f"{m}_ok" for m in floors), "challenger_ok"])))


def is_current(made: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """``made`` (key, stamp) with ``current``: whether ``stored`` (key, stored) holds the same stamp; one that is missing or null doesn't."""
    return made.join(stored, key, "left").withColumn("current", F.coalesce(F.col("stored") == F.col("stamp"), F.lit(False))).drop("stored")


def footage_spans(rows: DataFrame, window: str) -> DataFrame:
    """first, last and n_frames of each sequence in a window, and the text seq/first-last."""
    out = rows.groupBy(window, "sequence").agg(F.min("frame_index").alias("first"), F.max("frame_index").alias("last"), F.count(F.lit(1)).alias("n_frames"), F.min("arrival").alias("since"))
    return out.withColumn("span", F.format_string("%s/%d-%d", "sequence", "first", "last"))
