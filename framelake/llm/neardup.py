"""MinHash near-duplicate removal by fast similarity sketching, banding and exact verification.

Sketch (Dahlgaard, Knudsen and Thorup 2017): round i < t throws every shingle into a hashed bin,
round t + i throws all of them into bin i, and a bin keeps the least value of its first filled
round. So 2t rounds fill all t bins, and the share of equal bins concentrates around the Jaccard
similarity. Bands of ``rows`` bins give the buckets in which candidates meet.

Scale: equal shingle sets become one node before banding. A bucket is never expanded into all
pairs: its members first meet its centre, links found so far join nodes into components, and
only nodes outside a bucket's largest component meet the rest of the bucket, until no bucket
holds two components with an unverified pair between them. Everything between steps is written
to the shared folder. Only counters come to the driver. The nodes that stay outside meet the rest
in blocks of bounded size, whose full sets are compared inside a task; only links come out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framelake.llm import _text as T
from framelake.llm._spark import cut, fresh

U64 = np.uint64
TURNS = 2
BLOCK = 125  # sets of either side that meet in one task, on average
BLOCK_HASHES = 25_000  # and hashes in them
_SEEDS = T.mix(np.arange(1, 4097, dtype=U64) * U64(0x632BE59BD9B4E019))


def sketch(elements: np.ndarray, bins: int) -> np.ndarray:
    """Fast similarity sketch of a non-empty set of 64-bit hashes: one value for each bin."""
    low = U64((1 << 48) - 1)
    best = np.full(bins, U64(0xFFFFFFFFFFFFFFFF))
    rounds = max(1, math.ceil(1.3 * bins * (math.log(bins) + 1) / len(elements)))
    done = 0
    while done < bins:
        k = np.arange(done, min(bins, done + rounds), dtype=U64)
        h = T.mix(elements[None, :] ^ _SEEDS[k.astype(np.int64)][:, None])
        value = (h & low) | (k << U64(48))[:, None]
        np.minimum.at(best, ((h >> U64(48)) * U64(bins) >> U64(16)).astype(np.int64).ravel(), value.ravel())
        done += rounds
        if best.max() != U64(0xFFFFFFFFFFFFFFFF):
            return best
    for i in np.flatnonzero(best == U64(0xFFFFFFFFFFFFFFFF)):
        h = T.mix(elements ^ _SEEDS[(bins + int(i)) % 4096])
        best[i] = (h & low).min() | U64((bins + int(i)) << 48)
    return best


def band_keys(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    h = np.arange(bands, dtype=U64)
    for column in values[: bands * rows].reshape(bands, rows).T:
        h = T.mix((h * U64(0x9E3779B97F4A7C15)) ^ column)
    return h


def sets(array: pa.Array, ngram: int):
    """For each text of the array, the sorted distinct shingle hashes."""
    for first, last, data, offsets in T.chunks(array):
        data = T.LOWER[data]
        starts, ends = T.spans(data, offsets)
        words = T.span_hash(data, starts, ends)
        grams, text = T.shingles(words, T.of_text(starts, offsets), ngram)
        at = np.searchsorted(text, np.arange(last - first + 1))
        for i in range(last - first):
            yield np.unique(grams[at[i] : at[i + 1]])


def _signature(s: np.ndarray) -> bytes:
    """128 bits that stand for the whole set."""
    a = int(T.mix(s).sum(dtype=U64)) ^ len(s)
    b = int(T.mix(s ^ U64(0xA0761D6478BD642F)).sum(dtype=U64))
    return a.to_bytes(8, "big") + b.to_bytes(8, "big")


def _sketched(ngram: int, bands: int, rows: int):
    def run(batches):
        for b in batches:
            n, sig, keys = [], [], []
            for s in sets(b.column("text"), ngram):
                n.append(len(s))
                sig.append(_signature(s) if len(s) else None)
                keys.append(band_keys(sketch(s, bands * rows), bands, rows).view(np.int64) if len(s) else np.zeros(0, np.int64))
            counts = np.array([len(k) for k in keys])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("th"), b.column("th2"), pa.array(n, pa.int64()), pa.array(sig, pa.binary()), lists], ["id", "th", "th2", "n", "sig", "keys"])

    return run


def _full(ngram: int):
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array([s.tobytes() for s in sets(b.column("text"), ngram)], pa.binary())], ["node", "hashes"])

    return run


def _shared(batches):
    """The size of the intersection of two sets of hashes."""
    for b in batches:
        out = []
        for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist(), strict=True):
            x, y = np.frombuffer(x, U64), np.frombuffer(y, U64)
            if len(x) > len(y):
                x, y = y, x
            at = np.searchsorted(y, x)
            at[at == len(y)] = 0
            out.append(int((y[at] == x).sum()))
        yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), b.column("na"), b.column("nb"), pa.array(out, pa.int64())], ["a", "b", "na", "nb", "both"])


def _block(percent: int):
    """Links between the queries of a block and its other sets, one for each component met."""

    def run(table: pa.Table) -> pa.Table:
        query = np.array(table.column("query").to_pylist(), bool)
        node, comp = (np.array(table.column(c).to_pylist(), np.int64) for c in ("node", "comp"))
        full = [np.frombuffer(h, U64) for h in table.column("hashes").to_pylist()]
        size = np.array([len(h) for h in full])
        rest = np.flatnonzero(~query)
        a, b = [], []
        if len(rest):
            every, owner = np.concatenate([full[i] for i in rest]), np.repeat(np.arange(len(rest)), size[rest])
            order = np.argsort(every, kind="stable")
            every, owner = every[order], owner[order]
            for q in np.flatnonzero(query):
                low, high = np.searchsorted(every, full[q], "left"), np.searchsorted(every, full[q], "right")
                both = np.bincount(owner[T.ragged(low, high - low)], minlength=len(rest))
                hit = np.flatnonzero((100 * both >= percent * (size[q] + size[rest] - both)) & (comp[rest] != comp[q]))
                _, first = np.unique(comp[rest[hit]], return_index=True)
                a += [int(node[q])] * len(first)
                b += node[rest[hit[first]]].tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def components(links: DataFrame) -> DataFrame:
    """(node, comp) with the least node reachable, for the nodes of ``links`` (a, b), by alternating large and small stars."""
    edges = cut(links.where("a <> b").selectExpr("greatest(a, b) as u", "least(a, b) as v").distinct(), "edges")
    while True:
        both = edges.union(edges.selectExpr("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").selectExpr("v as u", "m as v").where("u <> v")
        large = large.union(least.where("m < u").selectExpr("u", "m as v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").selectExpr("v as u", "m as v").union(least.selectExpr("u", "m as v")).distinct()
        after = cut(small, "edges")
        # done when each node hangs on one other and that one hangs on nothing
        hangs = after.selectExpr("u as node", "1 as up", "0 as down").union(after.selectExpr("v as node", "0 as up", "1 as down"))
        open_ = hangs.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)")
        edges = after
        if not open_.limit(1).count():
            break
    return edges.selectExpr("u as node", "v as comp").union(edges.selectExpr("v as node", "v as comp").distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = 5, percent: int = 80, bands: int = 36, rows: int = 5) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id, kept, then text_hash and group_id.

    Words are runs of anything but ASCII white space after lower-casing A-Z. Two texts are linked
    when 100 * |A & B| >= percent * |A | B| over their distinct ``ngram``-word shingles; a text
    with fewer words has one shingle of all its words. Null and blank texts have no shingle and no
    link. component_id is the least id reachable over links (the row's own id where it has none);
    kept says whether the row's id is that one. Rows that repeat an id each get their row; a null
    id counts as no id, so its row's component_id is the least id it is linked to or null, and it
    is kept only where the group has no id at all. Other columns of ``docs`` are ignored.
    """
    rows_in = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("th"), F.xxhash64(F.lit(1), F.col(text_col)).alias("th2"))
    kind = rows_in.schema["id"].dataType.simpleString()
    done = cut(rows_in.mapInArrow(_sketched(ngram, bands, rows), f"id {kind}, th bigint, th2 bigint, n bigint, sig binary, keys array<bigint>"), "sketched")
    # a node for each distinct set; the number is fixed by being written
    nodes = cut(done.where("n > 0").groupBy("sig").agg(F.first("n").alias("n"), F.min(F.struct("th", "th2")).alias("t"), F.first("keys").alias("keys"), F.min("id").alias("least_id")).select("sig", "n", "t.th", "t.th2", "keys", "least_id", F.monotonically_increasing_id().alias("node")), "nodes")
    links = _links(rows_in, nodes, ngram, percent)
    comps = components(links)
    # the least id of each component, then back to rows by signature
    named = nodes.select("node", "sig", "least_id").join(comps, "node")
    least = named.groupBy("comp").agg(F.min("least_id").alias("component_id"))
    linked = named.select("sig", "comp").join(least, "comp").select("sig", F.col("component_id").alias("c"), F.col("comp").alias("group_id"))
    alone = nodes.join(comps.select("node"), "node", "left_anti").select("sig", F.col("least_id").alias("c"), F.col("node").alias("group_id"))
    by_sig = cut(linked.union(alone), "named")
    out = done.select("id", "th", "n", "sig").join(by_sig, "sig", "left")
    own = F.when(F.col("sig").isNull(), F.col("id")).otherwise(F.col("c"))
    kept = F.col("id").eqNullSafe(own).alias("kept")
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), own.alias("component_id"), kept, F.col("th").alias("text_hash"), "group_id")


def _links(rows_in: DataFrame, nodes: DataFrame, ngram: int, percent: int) -> DataFrame:
    """Verified links (a, b) that give the same components as all links would."""
    buckets = nodes.select("node", F.explode("keys").alias("key"))
    full = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    met = cut(buckets.join(full, "key").join(nodes.select("node", "n"), "node"), "met")  # members of buckets of two or more
    central = met.groupBy("node").agg(F.sum("m").alias("degree"))  # the more a node meets, the nearer it is to a group's middle
    wanted = cut(central.join(nodes.select("node", "th", "th2", "n"), "node"), "wanted")
    # copies of a text end in the map tasks: one of each goes on, by 128 bits of its hash
    found = rows_in.select("th", "th2", "text").dropDuplicates(["th", "th2"]).join(wanted.select("th", "th2", "node").hint("shuffle_hash"), ["th", "th2"]).select("node", "text")
    hashes = cut(found.mapInArrow(_full(ngram), "node bigint, hashes binary"), "hashes").join(nodes.select("node", "n"), "node")

    def fits(x: str, y: str):
        return 100 * F.least(F.col(x), F.col(y)) >= percent * F.greatest(F.col(x), F.col(y))

    def measured(pairs: DataFrame) -> DataFrame:
        left = pairs.select("a", "b").join(hashes.selectExpr("node as a", "hashes as x", "n as na"), "a")
        both = left.join(hashes.selectExpr("node as b", "hashes as y", "n as nb"), "b").select("a", "b", "x", "y", "na", "nb")
        return cut(both.mapInArrow(_shared, "a bigint, b bigint, na bigint, nb bigint, both bigint"), "measured")

    def linked(pairs: DataFrame) -> DataFrame:
        return pairs.where(100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b")

    # 1. every node meets the most central of its buckets' centres, its pivot
    centre = met.join(wanted.select("node", "degree"), "node").groupBy("key").agg(F.max(F.struct("degree", "node", "n")).alias("c"))
    star = met.join(centre, "key").where("node <> c.node").where(fits("n", "c.n"))
    first = cut(star.groupBy("node").agg(F.max("c").alias("c")).selectExpr("c.node as a", "node as b"), "pairs")
    got = measured(first)
    links, tried = linked(got), first.selectExpr("least(a, b) as a", "greatest(a, b) as b")

    def parted() -> DataFrame:
        """Members of buckets that hold more than one component, with each bucket's largest."""
        comps = components(links)
        inside = met.select("key", "node", "n").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        inside = cut(inside, "inside")
        largest = inside.groupBy("key", "comp").count().groupBy("key").agg(F.max_by("comp", F.struct("count", "comp")).alias("top"), F.count(F.lit(1)).alias("parts"))
        return cut(inside.join(largest.where("parts > 1").select("key", "top"), "key"), "parted")

    # 2. nodes outside a bucket's largest component meet a few of its members, another one each time
    for turn in range(TURNS):
        open_ = parted()
        if not open_.limit(1).count():
            return links
        some = open_.where("comp = top").groupBy("key").agg(F.max_by(F.struct("node", "n"), F.xxhash64("node", F.lit(turn))).alias("c"))
        pairs = open_.where("comp <> top").join(some, "key").where(fits("n", "c.n")).selectExpr("least(node, c.node) as a", "greatest(node, c.node) as b").distinct()
        pairs = cut(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        tried = tried.union(pairs)
        links = links.union(linked(measured(pairs)))
    # 3. what is left outside meets all that it shares such buckets with, block by block
    fam = parted().selectExpr("top as fam", "node", "n", "comp", "comp <> top as loose").distinct()
    of_loose = F.when(F.col("loose"), F.col("n"))
    sizes = fam.groupBy("fam").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("mh"), F.count_if("loose").alias("l"), F.coalesce(F.sum(of_loose), F.lit(0)).alias("lh"))
    fam = fam.join(sizes, "fam").withColumn("at", F.xxhash64("node"))
    blocks, chunks = (F.ceil(F.greatest(F.col(c) / BLOCK, F.col(h) / BLOCK_HASHES)) for c, h in (("m", "mh"), ("l", "lh")))
    one = F.pmod(F.col("at"), blocks)
    all_of = fam.select("fam", "node", "comp", F.lit(False).alias("query"), one.alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)).alias("chunk"))
    asked = fam.where("loose").select("fam", "node", "comp", F.lit(True).alias("query"), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block"), F.pmod(F.col("at"), chunks).alias("chunk"))
    cells = cut(all_of.union(asked), "cells").join(hashes, "node").select("fam", "block", "chunk", "node", "comp", "query", "hashes")
    more = cells.groupBy("fam", "block", "chunk").applyInArrow(_block(percent), "a bigint, b bigint")
    return links.union(cut(more, "links"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs``, all columns, that stand for their group of near copies: one for each group, blank texts all.

    Among rows with the same id and text, the one whose other columns hash lowest stands; rows that agree in all columns are the same.
    """
    verdict = near_duplicates(docs, id_col, text_col, **how).where("kept")
    name = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit(""))
    one = verdict.where("group_id is not null").groupBy("group_id").agg(F.min(F.struct(name.alias("k"), F.col("text_hash").alias("h"))).alias("r")).select("r.*", F.lit(False).alias("blank"))
    blank = verdict.where("group_id is null").select(name.alias("k"), F.col("text_hash").alias("h"), F.lit(True).alias("blank")).distinct()
    k, h, flag = (fresh(docs, x) for x in ("k", "h", "blank"))
    named = docs.withColumn(k, F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit(""))).withColumn(h, F.xxhash64(F.col(text_col)))
    out = named.join(one.union(blank).toDF(k, h, flag), [k, h])
    again = F.row_number().over(Window.partitionBy(k, h).orderBy(F.xxhash64(*docs.columns), F.xxhash64(F.lit(1), *docs.columns)))
    n = fresh(out, "n")
    return out.withColumn(n, again).where(F.col(flag) | (F.col(n) == 1)).select(*docs.columns)


def oracle(ngram: int, percent: int) -> str:
    """DuckDB SQL for (doc_id, n_shingles, component_id, kept) of ``documents`` by all pairs of different sets, for tables that allow that."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    gram = " || ' ' || ".join(f"w[i + {k}]" for k in range(ngram))
    return rf"""
    WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {ngram} THEN [array_to_string(w, ' ')]
            ELSE list_sort(list_distinct(list_transform(range(1, len(w) - {ngram - 2}), lambda i: {gram}))) END AS g FROM d),
    n AS (SELECT g, min(doc_id) AS a, len(g) AS size FROM s WHERE len(g) > 0 GROUP BY g),
    e AS (SELECT a, size, unnest(g) AS x FROM n),
    l AS (SELECT p.a AS a, q.a AS b FROM e p JOIN e q ON p.x = q.x AND p.a <> q.a GROUP BY p.a, q.a, p.size, q.size HAVING 100 * count(*) >= {percent} * (p.size + q.size - count(*))),
    r AS (SELECT a AS top, a AS node FROM n UNION SELECT r.top, l.b FROM r JOIN l ON l.a = r.node),
    c AS (SELECT node, min(top) AS component_id FROM r GROUP BY node)
    SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles, coalesce(c.component_id, s.doc_id) AS component_id, s.doc_id = coalesce(c.component_id, s.doc_id) AS kept
    FROM s LEFT JOIN n ON n.g = s.g LEFT JOIN c ON c.node = n.a"""
