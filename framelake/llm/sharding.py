"""Sharding by extendible hashing, with DataFrame operations only.

A document's key hashes to a string of bits. The directory starts as one bucket; a bucket whose
documents exceed the byte limit splits on one more bit, all others stay, until every bucket fits.
A bucket's bits are its shard's name, as in an extendible-hashing directory.

Scale: only counts of bytes at ``level_bits`` bits, at most 2**level_bits rows for each bucket
that is still too large, are shuffled to find the directory; documents are read once for those
counts and once to be named. A directory of up to ``BROADCAST`` paths goes to the executors, a larger
one is joined. A further level runs only for documents of buckets that remain too large, which
the driver learns from one count, and only those meet its directory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.llm._spark import cut, fresh

WORD = 60  # bits taken from each hash
BROADCAST = 1 << 17  # paths of a level, about 100 bytes each, that are sent to all executors
MARK = "b"  # before the bits in folder names, so that no reader takes them for numbers


def hash_bits(key: Column) -> Column:
    return F.lpad(F.conv(F.substring(F.md5(key), 1, 15), 16, 2), WORD, "0")


def shard(docs: DataFrame, limit_bytes: int = 64 << 20, id_col: str = "doc_id", text_col: str = "text", level_bits: int = 16) -> DataFrame:
    """``docs`` with shard (bits of its bucket, "" while one bucket holds all), depth, and bytes of its text.

    A null id hashes like no other id; rows that repeat an id share a shard while that fits, else
    they are written once with a number each, and a hash of that number parts them, so that no shard of two
    or more documents exceeds the limit. A single text over the limit is a shard of its own. Null texts
    have 0 bytes. An empty table gives no row. Where ``docs`` has a column named shard, depth or
    bytes, the new one takes a leading underscore.
    """
    return _shard(docs, limit_bytes, id_col, text_col, level_bits)[0]


def _shard(docs: DataFrame, limit_bytes: int, id_col: str, text_col: str, level_bits: int) -> tuple[DataFrame, int]:
    """The rows of ``shard``, and a number of paths that is no less than that of shards."""
    size, bits = fresh(docs, "bytes"), fresh(docs, "bits")
    key = F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit(""))
    named = docs.withColumn(size, F.coalesce(F.octet_length(F.col(text_col)).cast("long"), F.lit(0).cast("long"))).withColumn(bits, hash_bits(key))
    levels, full = directory(named.select(F.col(bits).alias("bits"), F.col(size).alias("bytes")), limit_bytes, level_bits)
    out, rest = _named(docs, named, levels, bits, size)
    paths = sum(n for _, _, n in levels)
    if full:  # ids that repeat beyond the limit: their rows are numbered, and written so that the numbers stay
        number = fresh(rest, "number")
        hot = cut(rest.withColumn(number, F.monotonically_increasing_id()), "shard-repeats")
        hot = hot.withColumn(bits, F.concat(F.col(bits), hash_bits(F.concat(F.col(bits), F.lit("|"), F.col(number).cast("string")))))
        levels, _ = directory(hot.select(F.col(bits).alias("bits"), F.col(size).alias("bytes")), limit_bytes, level_bits, WORD, 2 * WORD)
        more, _ = _named(docs, hot, levels, bits, size)
        out, paths = out.unionByName(more), paths + sum(n for _, _, n in levels)
    return out, paths


def _named(docs: DataFrame, named: DataFrame, levels: list, bits: str, size: str) -> tuple[DataFrame, DataFrame]:
    """The rows whose leaf is in one of the levels, and the rest; only rows without a leaf go from a level to the next."""
    at, depth = fresh(docs, "shard"), fresh(docs, "depth")
    out, rest = None, named
    for base, leaves, n in levels:
        prefix = fresh(rest, "prefix")
        leaf = leaves.select(F.col("path").alias(prefix), F.col("leaf").alias(at))
        met = rest.withColumn(prefix, F.substring(F.col(bits), 1, base)).join(F.broadcast(leaf) if n <= BROADCAST else leaf, prefix, "left")
        part = met.where(F.col(at).isNotNull()).select(*docs.columns, at, F.length(at).alias(depth), size)
        out = part if out is None else out.unionByName(part)
        rest = met.where(F.col(at).isNull()).drop(prefix, at)
    return out, rest


def directory(sized: DataFrame, limit_bytes: int, level_bits: int = 16, base: int = 0, last: int = WORD) -> tuple[list[tuple[int, DataFrame, int]], bool]:
    """For each level (bits so far, (path at that many bits, leaf), rows): the bucket in which documents of that path end; and whether a bucket is too large at ``last`` bits.

    ``sized`` has bits and bytes. Paths without a leaf go on to the next level. The table of the first level has
    2**level_bits rows at most. A bucket at 2 * WORD bits is a leaf whatever it holds.
    """
    levels, rows = [], sized
    while True:
        bottom = min(base + level_bits, last)
        counts = cut(rows.groupBy(F.substring("bits", 1, bottom).alias("path")).agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n")), "shard-counts")
        nodes = counts.select("path", "bytes", "n", F.explode(F.sequence(F.lit(base + 1 if base else 0), F.lit(bottom))).alias("d"))
        nodes = nodes.select("path", F.expr("substring(path, 1, d)").alias("node"), "d", "bytes", "n")
        sums = nodes.groupBy("node", "d").agg(F.sum("bytes").alias("b"), F.sum("n").alias("m"))
        fits = (F.col("b") <= limit_bytes) | (F.col("m") <= 1) | (F.col("d") == 2 * WORD)
        whole = sums.where(fits).select("node")
        # the shortest bucket on a path that fits is its leaf
        leaf = cut(nodes.join(whole, "node").groupBy("path").agg(F.min_by("node", "d").alias("leaf")), "shard-leaves")
        levels.append((bottom, leaf, leaf.count()))
        large = counts.where((F.col("bytes") > limit_bytes) & (F.col("n") > 1)).select("path")
        if not large.limit(1).count():
            return levels, False
        if bottom == last:
            return levels, last < 2 * WORD
        rows = rows.withColumn("path", F.substring("bits", 1, bottom)).join(large, "path", "left_semi").select("bits", "bytes")
        base = bottom


def write_shards(docs: DataFrame, path: str, limit_bytes: int = 64 << 20, id_col: str = "doc_id", text_col: str = "text", level_bits: int = 16) -> None:
    """One folder for each shard under ``path``, named MARK and its bits; rows are dealt out by shard over as many tasks as there may be shards, 100,000 at most, so a task writes few of them."""
    named, paths = _shard(docs, limit_bytes, id_col, text_col, level_bits)
    at = fresh(docs, "shard")
    parts = max(1, min(paths, 100_000))
    named.withColumn(at, F.concat(F.lit(MARK), F.col(at))).repartition(parts, F.col(at)).write.partitionBy(at).parquet(path)


def read_shards(spark: SparkSession, path: str, shard_col: str = "shard") -> DataFrame:
    """What ``write_shards`` wrote, with each shard's bits as a string; a filter on them reads only its folder."""
    return spark.read.parquet(path).withColumn(shard_col, F.expr(f"substring({shard_col}, {len(MARK) + 1})"))


def oracle(limit_bytes: int) -> str:
    """DuckDB SQL for (doc_id, shard, depth, bytes) of a table whose ids don't repeat beyond the limit."""
    return f"""
    WITH d AS (SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS bytes,
                 lpad(bin(CAST('0x' || substr(md5(coalesce('=' || CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT)), {WORD}, '0') AS bits FROM documents),
    s AS (SELECT *, substr(bits, 1, depth) AS node FROM d, generate_series(0, {WORD}) g(depth)),
    w AS (SELECT *, sum(bytes) OVER (PARTITION BY node) AS b, count(*) OVER (PARTITION BY node) AS m FROM s)
    SELECT doc_id, min_by(node, depth) AS shard, CAST(min(depth) AS INTEGER) AS depth, any_value(bytes) AS bytes FROM w WHERE b <= {limit_bytes} OR m <= 1 GROUP BY doc_id"""
