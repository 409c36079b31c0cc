"""Mixing sources to target weights by systematic sampling, with DataFrame operations only.

Targets fill up by weight to a cap of ``cap`` times a source's size. Within a source each
document expects target / size copies; these are summed up along a fixed order, one random offset
is added, and a document is emitted once for each whole number that its stretch of the sum
crosses. The order goes by size class, so that what is taken is spread evenly over short and long
documents and the words taken come near the target.

Scale: the running sum is taken in levels. Rows are ranked within (source, size class, hash
chunk), a chunk being a small part of a task's rows, and chunk counts are summed up within groups
of chunks, group counts within size classes and those within sources. No task sees a whole source
or all chunks of one, however large.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelake.llm._spark import cut, fresh

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = 7
CHUNK_ROWS = 20_000
WORDS = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Runs of anything but ASCII white space; null has none."""
    flat = F.translate(text, "\t\n\x0b\x0c\r", "     ")
    return F.coalesce(F.size(F.array_remove(F.split(flat, " "), "")).cast("long"), F.lit(0).cast("long"))


def _hash(c: Column) -> Column:
    return F.substring(F.md5(c), 1, 15)


def row_key(id_: Column, size: Column, spread: Column) -> Column:
    return F.concat(F.coalesce(F.concat(F.lit("="), id_.cast("string")), F.lit("")), F.lit("|"), size.cast("string"), F.lit("|"), F.coalesce(spread.cast("string"), F.lit("")))


def size_class(size: Column) -> Column:
    """Quarter octaves of a size, as text that sorts like the size."""
    b = F.bin(size)
    return F.concat(F.lpad(F.length(b).cast("string"), 2, "0"), F.rpad(F.substring(b, 1, 3), 3, "0"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, target) for (source, source_size): shares of all sizes by weight, none above cap times its own.

    One row for each source, so its windows without a key see as many rows as there are sources.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("w", pick.cast("long")).withColumn("c", cap * F.col("source_size"))
    order = Window.orderBy(F.col("c") / F.col("w"), F.col("source").asc_nulls_last())
    upto, everything = order.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy(F.lit(0))
    rows = rows.withColumn("total", F.sum("source_size").over(everything)).withColumn("all_w", F.sum("w").over(everything))
    rows = rows.withColumn("left", F.col("total") - F.sum("c").over(upto) + F.col("c")).withColumn("w_left", F.col("all_w") - F.sum("w").over(upto) + F.col("w"))
    rows = rows.withColumn("full", F.col("left") * F.col("w") >= F.col("c") * F.col("w_left"))
    free = F.col("total") - F.sum(F.when(F.col("full"), F.col("c")).otherwise(F.lit(0))).over(everything)
    rows = rows.withColumn("free", free).withColumn("free_w", F.sum(F.when(F.col("full"), F.lit(0)).otherwise(F.col("w"))).over(everything))
    target = F.when(F.col("full"), F.col("c").cast("double")).otherwise(F.col("free").cast("double") * F.col("w") / F.col("free_w"))
    return rows.select("source", "source_size", target.alias("target"))


def _before(chunks: DataFrame) -> DataFrame:
    """``chunks`` (s, c, g, k, m) with the rows of their source in earlier size classes, groups and chunks."""

    def running(rows: DataFrame, within: list[str], by: str, name: str) -> DataFrame:
        order = Window.partitionBy(*within).orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
        return rows.withColumn(name, F.sum("m").over(order) - F.col("m"))

    groups = chunks.groupBy("s", "c", "g").agg(F.sum("m").alias("m"))
    classes = groups.groupBy("s", "c").agg(F.sum("m").alias("m"))
    out = running(chunks, ["s", "c", "g"], "k", "in_group")
    out = out.join(running(groups, ["s", "c"], "g", "in_class").drop("m"), ["s", "c", "g"])
    out = out.join(running(classes, ["s"], "c", "in_source").drop("m"), ["s", "c"])
    return out.withColumn("before", F.expr("in_group + in_class + in_source")).drop("in_group", "in_class", "in_source")


def mix(docs: DataFrame, size_col: str = "size", id_col: str = "doc_id", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = SEED, spread_col: str | None = None) -> DataFrame:
    """``docs`` with source_size, target and copies (0 to cap) of each row.

    ``size_col`` holds whole numbers of 0 or more; null counts as 0, and such rows, like those of a
    source whose sizes are all 0, may get copies but add no words. A null source is a source of its
    own, named last. Rows that repeat an id each count. Equal rows may swap their copies from run
    to run, which changes no result; all else is the same in every run. An empty table gives no
    row. A new column whose name ``docs`` has takes a leading underscore.
    """
    s, c, h, k = (fresh(docs, x) for x in ("src", "cls", "hash", "chunk"))
    size = F.coalesce(F.col(size_col), F.lit(0)).cast("long")
    rows = docs.withColumn(s, F.coalesce(F.concat(F.lit("="), F.col(source_col)), F.lit(""))).withColumn(c, size_class(size)).withColumn(h, _hash(row_key(F.col(id_col), size, F.col(spread_col) if spread_col else F.lit(""))))
    found = cut(rows.groupBy(F.col(source_col).alias("source"), F.col(s).alias("s")).agg(F.sum(size).alias("source_size"), F.count(F.lit(1)).alias("n")), "mix-sources")
    total = found.agg(F.sum("n")).first()[0] or 0
    digits = max(0, math.ceil(math.log(max(1, total / CHUNK_ROWS), 16)))
    rows = rows.withColumn(k, F.substring(F.col(h), 1, digits) if digits else F.lit(""))
    goal = cut(targets(found.select("source", "source_size"), weights, cap), "mix-targets").select(F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("s"), "source_size", "target")
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.col("s"))), 1, 5), 16, 10).cast("double") / float(1 << 20)
    chunks = rows.groupBy(F.col(s).alias("s"), F.col(c).alias("c"), F.col(k).alias("k")).agg(F.count(F.lit(1)).alias("m"))
    chunks = _before(cut(chunks.withColumn("g", F.substring("k", 1, digits // 2)), "mix-chunks"))
    chunks = chunks.join(goal, "s").withColumn("offset", offset)
    size_name, target_name, copies = (fresh(docs, x) for x in ("source_size", "target", "copies"))
    b, o, r = (fresh(docs, x) for x in ("before", "offset", "rank"))
    chunks = chunks.select(F.col("s").alias(s), F.col("c").alias(c), F.col("k").alias(k), F.col("before").alias(b), F.col("source_size").alias(size_name), F.col("target").alias(target_name), F.col("offset").alias(o))
    place = F.row_number().over(Window.partitionBy(s, c, k).orderBy(h, F.col(id_col), size))
    ranked = rows.withColumn(r, place.cast("long")).join(chunks, [s, c, k])
    rate = F.when(F.col(size_name) > 0, F.least(F.lit(float(cap)), F.col(target_name) / F.col(size_name))).otherwise(F.lit(0.0))
    upto = F.col(b) + F.col(r)
    crossed = F.floor(upto.cast("double") * rate + F.col(o)) - F.floor((upto - 1).cast("double") * rate + F.col(o))
    return ranked.withColumn(copies, F.least(F.lit(cap).cast("long"), crossed.cast("long"))).select(*docs.columns, size_name, target_name, copies)


def emit(mixed: DataFrame, columns: list[str], copies: str = "copies") -> DataFrame:
    """Each row as many times as its copies, with ``columns`` only."""
    again = fresh(mixed, "copy")
    return mixed.where(F.col(copies) > 0).select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))).alias(again)).select(*columns)


ORACLE = rf"""
WITH d AS (SELECT doc_id, source, md5(coalesce(text, '')) AS th, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3] AS w, {CAP} * source_size AS c FROM s0),
s2 AS (SELECT *, sum(source_size) OVER () AS total, sum(w) OVER () - sum(w) OVER o + w AS w_left, sum(source_size) OVER () - sum(c) OVER o + c AS rest
       FROM s1 WINDOW o AS (ORDER BY c / w, source ASC NULLS LAST ROWS UNBOUNDED PRECEDING)),
s3 AS (SELECT *, rest * w >= c * w_left AS is_full FROM s2),
s4 AS (SELECT *, total - sum(CASE WHEN is_full THEN c ELSE 0 END) OVER () AS free, sum(CASE WHEN is_full THEN 0 ELSE w END) OVER () AS free_w FROM s3),
t AS (SELECT source, source_size, CASE WHEN is_full THEN CAST(c AS DOUBLE) ELSE CAST(free AS DOUBLE) * w / free_w END AS target,
        CAST(CAST('0x' || substr(md5('{SEED}|' || coalesce('=' || source, '')), 1, 5) AS BIGINT) AS DOUBLE) / 1048576 AS u FROM s4),
r AS (SELECT d.*, t.source_size, t.target, t.u, CASE WHEN t.source_size > 0 THEN least({CAP}.0, t.target / t.source_size) ELSE 0 END AS rate,
        row_number() OVER (PARTITION BY d.source ORDER BY lpad(CAST(length(bin(size)) AS VARCHAR), 2, '0') || rpad(substr(bin(size), 1, 3), 3, '0'),
          substr(md5(coalesce('=' || CAST(doc_id AS VARCHAR), '') || '|' || size || '|' || th), 1, 15), doc_id, size) AS k
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  size * least({CAP}, CAST(floor(CAST(k AS DOUBLE) * rate + u) - floor(CAST(k - 1 AS DOUBLE) * rate + u) AS BIGINT)) AS taken FROM r
"""
