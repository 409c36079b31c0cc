"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Two strings of length m with at most k edits share at least m + 1 - q * (k + 1) q-grams, all
within k + 1 neighbouring diagonals. Every stretch of ``PROBE`` bytes of an item counts, wherever it
starts: positions of a document whose q-gram occurs in an item are put into diagonal bands of the
item, bands of 2k + 2 diagonals overlapping by half so that no run of k + 1 falls between two, and a
band's hits in the order of their place in the item show which stretches reach the bound. Of windows that repeat within
a text only the first is looked at (they hold the same stretches), and hits are spelled out in slices of ``SLICE_HITS``
that overlap by a stretch, so that neither a repetitive text nor a repetitive item fills the memory. Stretches that reach the bound are
verified by alignment within the band: a row of it holds the band's diagonals and k more on either side. Items that
allow no edit must stand between letters and digits of their own; those of fewer than ``Q`` bytes are looked for by name.

Texts are compared after lower-casing A-Z and turning runs of ASCII white space into one space.

Scale: one pass over the documents without a shuffle where the benchmark has up to ``PASS_BLOCKS`` blocks of
``BLOCK_BYTES``, whose q-grams are sent to the executors. A larger one goes by groups of as many blocks, a job each that
writes the hits only; they meet the documents by a hash of id and text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm import _text as T

U64 = np.uint64
Q = 10
PROBE = 120
EDITS = 20  # one edit for so many characters of a stretch
BLOCK_BYTES = 4 << 20
PASS_BLOCKS = 4
TABLE_BITS = 22
SLICE_HITS = 1 << 19  # pairs of a text's and an item's q-gram that are spelled out at once
SPAN = PROBE + PROBE // EDITS + 2  # bytes of a text that tell what is found in them: a stretch, its edits and one more on each side


def normal(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    white = T.WHITE[data]
    keep = np.ones(len(data), bool)
    keep[1:] = ~(white[1:] & white[:-1])
    keep[offsets[:-1][offsets[:-1] < len(data)]] = True
    data = np.where(white, np.uint8(32), T.LOWER[data])[keep]
    return data, np.concatenate([[0], np.cumsum(keep)])[offsets]


def _one(text: str) -> bytes:
    raw = np.frombuffer(text.encode(), np.uint8)
    return normal(raw, np.array([0, len(raw)]))[0].tobytes().strip()


def grams(data: np.ndarray) -> np.ndarray:
    if len(data) < Q:
        return np.zeros(0, U64)
    starts = np.arange(len(data) - Q + 1)
    return T.span_hash(data, starts, starts + Q)


@dataclass
class Probes:
    """A block of items and their q-grams sorted by hash.

    ``text``, ``item`` and ``edits`` spell out some of the stretches that count, one for every half
    of ``PROBE`` and the last, for plain comparison; the search looks at all and doesn't make these.
    """

    body: list[bytes]
    ids: list
    length: np.ndarray  # of the item's stretches
    most: np.ndarray  # edits in a stretch
    bound: np.ndarray  # hits that a stretch needs
    key: np.ndarray
    place: np.ndarray  # of the q-gram in all items side by side, ascending within a key
    base: np.ndarray  # where each item begins there
    table: np.ndarray
    passes: list[tuple[int, int]]  # (window, least hits) that a region needs, for groups of stretch lengths
    short: list[tuple[bytes, object]]  # items of fewer than Q bytes and their ids

    @cached_property
    def _stretches(self) -> list[tuple[int, int]]:
        return [(q, a) for q, t in enumerate(self.body) for last in [max(0, len(t) - PROBE)] for a in sorted({*range(0, last + 1, PROBE // 2), last})]

    @cached_property
    def machine(self):
        import ahocorasick

        out, items = ahocorasick.Automaton(), {}
        for t, i in self.short:
            items.setdefault(t.decode("latin-1"), []).append(i)
        for t, same in items.items():
            out.add_word(t, (len(t), same))
        out.make_automaton()
        return out

    @cached_property
    def text(self) -> list[bytes]:
        return [self.body[q][a : a + PROBE] for q, a in self._stretches]

    @cached_property
    def item(self) -> list:
        return [self.ids[q] for q, _ in self._stretches]

    @cached_property
    def edits(self) -> list[int]:
        return [int(self.most[q]) for q, _ in self._stretches]


def probes(items: list[tuple]) -> Probes:
    every = [(i, t) for i, t in ((i, _one(t or "")) for i, t in items) if t]
    both, short = [x for x in every if len(x[1]) >= Q], [(t, i) for i, t in every if len(t) < Q]
    ids, body = [i for i, _ in both], [t for _, t in both]
    length = np.minimum(np.array([len(t) for t in body], np.int64), PROBE)
    most = length // EDITS
    bound = np.maximum(1, length + 1 - Q * (most + 1))
    hashes = [grams(np.frombuffer(t, np.uint8)) for t in body]
    key = np.concatenate(hashes) if hashes else np.zeros(0, U64)
    base = np.cumsum([0, *(len(t) for t in body)])
    place = np.concatenate([a + np.arange(len(h), dtype=np.int32) for a, h in zip(base[:-1].tolist(), hashes, strict=True)]) if hashes else np.zeros(0, np.int32)
    order = np.argsort(key, kind="stable")
    table = np.zeros(1 << TABLE_BITS, bool)
    table[(key >> U64(64 - TABLE_BITS)).astype(np.int64)] = True
    passes = []
    for low, high in ((Q, EDITS), (EDITS, 2 * EDITS), (2 * EDITS, 60), (60, 90), (90, PROBE), (PROBE, PROBE + 1)):
        inside = (length >= low) & (length < high)
        if inside.any():
            passes.append((int((length + most)[inside].max()) - Q + 1, int(bound[inside].min())))
    return Probes(body, ids, length, most, bound, key[order], place[order].astype(np.int32), base, table, passes, short)


@lru_cache(1 << 14)
def distance(probe: bytes, region: bytes, low: int, high: int, k: int) -> int:
    """Least edits between the probe and a stretch of the region that begins at ``low`` to ``high``; k + 1 where there are more than ``k``.

    Banded: row i of the table holds the cells i + low - k to i + high + k of the region, and no others.
    """
    width = high - low + 2 * k + 1
    cells = np.full(len(probe) + width, -1, np.int16)  # what is no byte of the region equals none of the probe
    begin, stop = max(0, low - k), min(len(region), low - k + len(cells))
    if stop > begin:
        cells[begin - low + k : stop - low + k] = np.frombuffer(region, np.uint8)[begin:stop]
    at = np.arange(width)
    row = np.where((at >= k) & (at < width - k), 0, k + 1)  # what begins elsewhere belongs to another band
    for i, c in enumerate(probe):
        new = row + (cells[i : i + width] != c)
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)
        row = np.minimum.accumulate(new - at) + at
        if row.min() > k:
            return k + 1
    return int(row.min())


_ALNUM = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


def _apart(text: bytes, start: int, end: int) -> bool:
    """Whether no letter or digit goes on over either end of the stretch."""
    return not (start > 0 and _ALNUM[text[start - 1]] and _ALNUM[text[start]]) and not (end < len(text) and _ALNUM[text[end - 1]] and _ALNUM[text[end]])


def _candidates(p: Probes, doc: np.ndarray, item: np.ndarray, diagonal: np.ndarray, place: np.ndarray):
    """(document, item, first diagonal of a band, lowest and highest start) of the item's stretches that reach the bound in the band."""
    band = diagonal // (p.most[item] + 1)
    doc, item, band, place = np.tile(doc, 2), np.tile(item, 2), np.concatenate([band, band - 1]), np.tile(place, 2)
    order = np.lexsort((place, band, item, doc))
    doc, item, band, place = doc[order], item[order], band[order], place[order]
    j = np.arange(len(doc))
    z = j + p.bound[item] - 1  # the bound's last hit, when counted from j
    j, z = j[z < len(doc)], z[z < len(doc)]
    fits = (doc[j] == doc[z]) & (item[j] == item[z]) & (band[j] == band[z]) & (place[z] - place[j] <= p.length[item[j]] - Q)
    j, z = j[fits], z[fits]
    size = np.array([len(t) for t in p.body], np.int64)[item[j]]
    low, high = np.maximum(0, place[z] + Q - p.length[item[j]]), np.minimum(place[j], size - p.length[item[j]])
    if not len(j):
        return
    doc, item, band = doc[j], item[j], band[j]
    new = np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(item) != 0) | (np.diff(band) != 0) | (low[1:] > high[:-1] + 1)])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(j)]]) - 1
    yield from zip(doc[first].tolist(), item[first].tolist(), (band * (p.most[item] + 1))[first].tolist(), low[first].tolist(), high[last].tolist(), strict=True)


def _regions(body: bytes, text: bytes, at: int, spans: list[tuple[int, int, int]], k: int) -> int:
    """How many stretches of ``body``, each after the end of the one before, ``text`` holds; it starts at ``at`` of the spans' diagonals.

    A span is (first diagonal of its band, lowest and highest start of a stretch); these are gone through by start.
    """
    spans = sorted(set(spans), key=lambda s: (s[1], s[0], s[2]))
    n = a = nxt = 0
    active: list[tuple[int, int, int]] = []
    while True:
        active = [s for s in active if s[2] >= a]
        if not active:
            if nxt == len(spans):
                return n
            a = max(a, spans[nxt][1])
        while nxt < len(spans) and spans[nxt][1] <= a:
            if spans[nxt][2] >= a:
                active.append(spans[nxt])
            nxt += 1
        held = any(_held(body[a : a + PROBE], text, begin + a - at, k) for begin in sorted({s[0] for s in active}))
        n, a = (n + 1, a + PROBE) if held else (n, a + 1)


def _held(probe: bytes, text: bytes, begin: int, k: int) -> bool:
    """Whether ``text`` holds the stretch in the band that begins at ``begin``."""
    if not k:
        return any(text[b : b + len(probe)] == probe and _apart(text, b, b + len(probe)) for b in (begin, begin + 1) if b >= 0)
    zero = max(0, begin - k)
    region = text[zero : max(0, begin + 2 * (k + 1) + len(probe) + k)]
    return probe in region or distance(probe, region, begin - zero, begin - zero + 2 * k + 1, k) <= k


def _once(covered: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """``covered`` without the bytes that lie only in windows of ``SPAN`` bytes that their text held before."""
    n = len(covered)
    total = np.concatenate([[0], np.cumsum(covered)])
    at = np.arange(n)
    starts = np.flatnonzero(total[np.minimum(at + SPAN, n)] > total[:-1])
    doc = np.searchsorted(offsets, starts, "right") - 1
    ends = np.minimum(starts + SPAN, offsets[doc + 1])
    told = T.mix(T.span_hash(data, starts, ends) + doc.astype(U64) * U64(0x9E3779B97F4A7C15))
    told[starts == offsets[doc]] ^= U64(0x5555555555555555)  # at the start of a text there is no byte before
    _, first = np.unique(told, return_index=True)
    edge = np.zeros(len(data) + 1, np.int32)
    np.add.at(edge, starts[first], 1)
    np.add.at(edge, ends[first], -1)
    return covered & (np.cumsum(edge)[:n] > 0)


def _lower_bound(values: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: int) -> np.ndarray:
    """The first index in each range low .. high - 1 of ``values``, ascending in each, that isn't below ``wanted``; high where none is."""
    low, high = low.copy(), high.copy()
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) >> 1
        below = values[middle] < wanted
        low[open_[below]] = middle[below] + 1
        high[open_[~below]] = middle[~below]
    return low


def _slices(p: Probes, at: np.ndarray, low: np.ndarray, high: np.ndarray):
    """(positions, their entries) of all hits, in slices of about ``SLICE_HITS`` that each overlap the next by a stretch, in the text or in the items."""
    total = np.concatenate([[0], np.cumsum(high - low)])
    first = 0
    while first < len(at):
        last = max(int(np.searchsorted(total, total[first] + SLICE_HITS, "right")) - 1, int(np.searchsorted(at, at[first] + 2 * SPAN)))
        last = min(last, len(at))
        yield from _places(p, at[first:last], low[first:last], high[first:last], 0, int(p.base[-1]))
        if last == len(at):
            return
        first = int(np.searchsorted(at, at[last] - SPAN))


def _places(p: Probes, at: np.ndarray, low: np.ndarray, high: np.ndarray, begin: int, end: int):
    """As ``_slices`` for entries low .. high - 1, whose places are from ``begin`` to ``end``."""
    count = high - low
    if count.sum() <= SLICE_HITS or end - begin <= 4 * PROBE:
        yield np.repeat(at, count), T.ragged(low, count)
        return
    middle = (begin + end) // 2
    yield from _places(p, at, low, _lower_bound(p.place, low, high, middle), begin, middle)
    yield from _places(p, at, _lower_bound(p.place, low, high, middle - PROBE), high, middle - PROBE, end)


def _named(data: np.ndarray, offsets: np.ndarray, p: Probes):
    """(text, item) of each place where a text holds a short item, those that overlap in an item counted once."""
    raw, free = data.tobytes(), {}
    hits = ((last, size, item) for last, (size, same) in p.machine.iter(raw.decode("latin-1")) for item in same)
    for last, size, item in hits:
        start, end = last + 1 - size, last + 1
        i = int(np.searchsorted(offsets, start, "right")) - 1
        low, high = int(offsets[i]), int(offsets[i + 1])
        if end <= high and start >= free.get((i, item), 0) and _apart(raw[max(low, start - 1) : min(high, end + 1)], start - max(low, start - 1), end - max(low, start - 1)):
            free[i, item] = end
            yield i, item


def matches(array: pa.Array, p: Probes):
    """For each text, the sorted items that it holds a region of, and how many stretches were found, those that overlap in an item counted once."""
    for first, last, data, offsets in T.chunks(array):
        data, offsets = normal(data, offsets)
        found: list[set] = [set() for _ in range(last - first)]
        regions = [0] * (last - first)
        if len(p.key) and len(data) >= Q:
            key = grams(data)
            hit = p.table[(key >> U64(64 - TABLE_BITS)).astype(np.int64)]
            total = np.concatenate([[0], np.cumsum(hit)])
            n = len(hit)
            near = np.zeros(n + 1, np.int32)
            for window, least in p.passes:
                at = np.flatnonzero(total[np.minimum(np.arange(n) + window, n)] - total[:n] >= least)
                np.add.at(near, at, 1)
                np.add.at(near, np.minimum(at + window, n), -1)
            covered = np.cumsum(near[:n]) > 0
            spans: dict[tuple[int, int], list] = {}

            def stretches(i: int, q: int) -> int:
                a = int(offsets[i])
                return _regions(p.body[q], data[a : int(offsets[i + 1])].tobytes(), a, spans[i, q], int(p.most[q]))

            if covered.any():
                at = np.flatnonzero(hit & _once(covered, data, offsets))
                at = at[at + Q <= offsets[np.searchsorted(offsets, at, "right")]]
                low, high = np.searchsorted(p.key, key[at], "left"), np.searchsorted(p.key, key[at], "right")
                done: set[tuple[int, int]] = set()  # of whose item no more stretches could be found
                for where, entry in _slices(p, at, low, high):
                    place = p.place[entry].astype(np.int64)
                    item, doc = np.searchsorted(p.base, place, "right") - 1, np.searchsorted(offsets, where, "right") - 1
                    if done:
                        code = len(p.body)
                        left = ~np.isin(doc * code + item, [i * code + q for i, q in done])
                        where, place, item, doc = where[left], place[left], item[left], doc[left]
                    place -= p.base[item]
                    fresh = set()
                    for i, q, *span in _candidates(p, doc, item, where - place, place):
                        spans.setdefault((i, q), []).append(tuple(span))
                        fresh.add((i, q))
                    if len(at) and where.size < (high - low).sum():  # more slices than this one
                        done |= {x for x in fresh if stretches(*x) >= max(1, len(p.body[x[1]]) // PROBE)}
            for i, q in spans:
                if got := stretches(i, q):
                    found[i].add(p.ids[q])
                    regions[i] += got
        if p.short and len(data):
            for i, item in _named(data, offsets, p):
                found[i].add(item)
                regions[i] += 1
        for f, k in zip(found, regions, strict=True):
            yield sorted(f), k


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", columns: list[str] | None = None) -> DataFrame:
    """``columns`` (the id) of each row of ``docs`` with items (array of item ids), n_regions and contaminated.

    A document is contaminated when it holds, with at most one edit in ``EDITS`` characters, any
    stretch of ``PROBE`` bytes of an item or the whole of a shorter one; items of fewer than
    ``EDITS`` bytes must occur unchanged and as whole words. What is missing counts as edits too, so the
    shortest unchanged excerpt of a longer item that is always caught has ``PROBE - PROBE // EDITS``
    (114) bytes; shorter ones are not looked for. n_regions counts the stretches found, without those that
    overlap one before in the same item. Null and empty texts hold nothing; items that are null or blank are
    passed over; item ids are of any type that sorts; rows, repeated or with null ids, each get their result.
    Clashing column names take a leading underscore.
    """
    from framelake.llm._spark import cut, fresh

    columns = [id_col] if columns is None else columns
    items, regions, flag = (fresh(docs.select(*columns), c) for c in ("items", "n_regions", "contaminated"))
    given = benchmark.where(F.col(item_text_col).isNotNull() & F.col(item_col).isNotNull()).select(F.col(item_col).alias("i"), F.col(item_text_col).alias("t"))
    blocks = max(1, -(-int(given.agg(F.sum(F.octet_length("t").cast("long"))).first()[0] or 0) // BLOCK_BYTES))
    if blocks <= PASS_BLOCKS:
        held = docs.select(*columns, F.col(text_col).alias(fresh(docs, "body")))
        found = _searched(held, given, range(blocks), blocks, (items, regions))
        return found.select(*columns, items, regions, (F.size(items) > 0).alias(flag))
    # too large to be sent at once: hits of each group of blocks by id and text, which fix them
    k, h, g = (fresh(docs, x) for x in ("k", "h", "g"))
    key = [F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit("")).alias(k), F.xxhash64(F.col(text_col)).alias(h), F.xxhash64(F.lit(1), F.col(text_col)).alias(g)]
    hits = None
    for first in range(0, blocks, PASS_BLOCKS):
        body = fresh(docs, "body")
        held = docs.select(*key, F.col(text_col).alias(body))
        found = _searched(held, given, range(first, min(blocks, first + PASS_BLOCKS)), blocks, (items, regions)).where(F.size(items) > 0)
        found = cut(found.groupBy(k, h, g).agg(F.first(items).alias(items), F.max(regions).alias(regions)), "hits")
        hits = found if hits is None else hits.unionByName(found)
    hits = hits.groupBy(k, h, g).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(items)))).alias(items), F.sum(regions).alias(regions))
    out = docs.select(*columns, *key).join(hits, [k, h, g], "left")
    none = F.array().cast(out.schema[items].dataType)
    return out.select(*columns, F.coalesce(items, none).alias(items), F.coalesce(regions, F.lit(0).cast("long")).alias(regions), F.col(items).isNotNull().alias(flag))


def _searched(rows: DataFrame, given: DataFrame, wanted: range, blocks: int, names: tuple[str, str]) -> DataFrame:
    """``rows``, whose last column is the text, with (items, n_regions) in place of it, of the ``wanted`` ones of ``blocks`` blocks of the benchmark."""
    from pyspark.sql.types import ArrayType, LongType, StructField, StructType

    sent = []
    for block in wanted:
        part = given.where(F.pmod(F.xxhash64("i"), F.lit(blocks)) == block) if blocks > 1 else given
        sent.append(rows.sparkSession.sparkContext.broadcast(probes([(r.i, r.t) for r in part.orderBy("i", "t").collect()])))
    kept = rows.schema.fields[:-1]
    own = StructField(names[0], ArrayType(given.schema["i"].dataType))
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(own.dataType)

    def run(batches):
        for b in batches:
            text = b.column(b.num_columns - 1)
            found, n = [[] for _ in range(b.num_rows)], [0] * b.num_rows
            for block in sent:  # a text passes all blocks of the group while it is here
                for i, (got, k) in enumerate(matches(text, block.value)):
                    if got:
                        found[i], n[i] = sorted({*found[i], *got}), n[i] + k
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(kept))), pa.array(found, kind), pa.array(n, pa.int64())], [*(f.name for f in kept), *names])

    return rows.mapInArrow(run, StructType([*kept, own, StructField(names[1], LongType())]))
