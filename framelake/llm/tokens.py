"""Token-id output in a fixed-width bit-packed format, and its reader.

File format: Parquet files of blocks, so that any store Spark writes to will do. A block holds
whole documents: their ids, where each ends, the block's place in its part and the ids packed into
``width`` = bits of the largest id, little-endian. Parts are ranges of document ids; the ids of
all documents before a block are its own ``start`` plus those of earlier parts. Any document is
read by one filter on ``start`` and unpacked by one vectorised shift and mask.

Scale: texts are dealt out once by range of id; encoding, packing and writing run in that same
pass. Only one number for each part is gathered to place the parts.
"""

from __future__ import annotations

import bisect
import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framelake.llm import _text as T
from framelake.llm._spark import new_path

U64 = np.uint64
BLOCK_IDS = 1 << 16
PART_BYTES = 64 << 20
VOCABULARY = "word_bpe_49k.json"
END = 1
BLOCK = "part int, block bigint, start bigint, n bigint, width int, doc_ids array<{kind}>, ends array<bigint>, packed binary"

# -- packing


def pack(ids: np.ndarray, width: int) -> bytes:
    """Each id in ``width`` bits, least bit first, eight spare bytes at the end for the reader's window."""
    if width % 8 == 0:
        body = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4)[:, : width // 8]).tobytes()
    else:
        bits = (ids.astype(np.uint32)[:, None] >> np.arange(width, dtype=np.uint32)) & 1
        body = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
    return body + bytes(8)


def unpack(packed: bytes, width: int, first: int, last: int) -> np.ndarray:
    """Ids first .. last - 1 of a block; only their own bytes are touched."""
    at = np.arange(first, last, dtype=np.int64) * width
    raw = np.frombuffer(packed, np.uint8)
    windows = np.lib.stride_tricks.as_strided(raw[:8].view(U64), (max(0, len(raw) - 7),), (1,))
    return ((windows[at >> 3] >> (at & 7).astype(U64)) & U64((1 << width) - 1)).astype(np.uint32)


# -- encoding

_LETTER, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[97:123] = True
_MARK[[b for b in range(0x21, 0x7F) if not chr(b).isalnum() and chr(b) != "'"]] = True


class Encoder:
    """``encode_batch`` of a tokenizer, with what it made of recent pieces kept in a hash table.

    Where the tokenizer lower-cases, splits at white space and cuts letters from punctuation (as
    its file says), a text's ids are those of its pieces side by side, so only pieces not met
    before are encoded. Other tokenizers encode whole texts. The table is emptied when full.
    """

    SLOTS = 21
    FULL = 1_200_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = False
        spec = json.loads(self.tokenizer.to_str())
        steps = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        self.pieces = steps == ["NFC", "Replace", "Lowercase"] and cuts[0].get("behavior") == "Removed" and r"[^\s\p{L}\p{N}]+" in (cuts[0].get("pattern") or {}).get("Regex", "") and spec["model"].get("end_of_word_suffix") == "</w>"
        self.width = max(1, (self.tokenizer.get_vocab_size() - 1).bit_length())
        if self.pieces:
            self.final = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
            for token, i in self.tokenizer.get_vocab().items():
                self.final[i] = token.endswith("</w>")
            self._empty()

    def _empty(self) -> None:
        n = 1 << self.SLOTS
        self.key, self.check = np.zeros(n, U64), np.zeros(n, U64)
        self.start, self.length = np.zeros(n, np.int32), np.zeros(n, np.int32)
        self.pool, self.used, self.count = np.zeros(1 << 16, np.uint32), 0, 0

    def texts(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def array(self, array: pa.Array):
        """The ids of each text of an Arrow string array, in order."""
        if not self.pieces:
            for x in array.to_pylist():
                yield self.texts([x or ""])[0]
            return
        for first, last, data, offsets in T.chunks(array):
            n = last - first
            if not len(data):
                yield from (np.zeros(0, np.uint32) for _ in range(n))
                continue
            ids, ends = self._chunk(data, offsets)
            # special tokens in a text are met before lower-casing, so such texts are encoded whole
            marks = np.flatnonzero((data[:-1] == 60) & (data[1:] == 124))
            whole = set((np.searchsorted(offsets, marks, "right") - 1).tolist())
            for i in range(n):
                if i in whole:
                    yield self.texts([data[offsets[i] : offsets[i + 1]].tobytes().decode()])[0]
                else:
                    yield ids[ends[i] : ends[i + 1]]

    def _chunk(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        data = T.LOWER[data]
        letter, mark = _LETTER[data], _MARK[data]
        cut = np.flatnonzero((letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:])) + 1
        starts, ends = T.spans(data, np.concatenate([offsets, cut]))
        key = T.span_hash(data, starts, ends)
        key[key == 0] = U64(1)
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        heads = np.lib.stride_tricks.as_strided(padded[:8].view(U64), (len(data),), (1,))[starts]
        size = np.minimum(ends - starts, 8).astype(U64)
        check = (heads << (U64(64) - U64(8) * size)) ^ (ends - starts).astype(U64)
        slot = self._find(key, check)
        new = np.flatnonzero(slot < 0)
        if len(new):
            _, at = np.unique(key[new], return_index=True)
            if self.count + len(at) > self.FULL:
                self._empty()
                new = np.arange(len(key))
                _, at = np.unique(key, return_index=True)
            at = new[at]
            self._add(key[at], check[at], [padded[a:b].tobytes().decode() for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
            slot[new] = self._find(key[new], check[new])
            if (slot < 0).any():  # two pieces of one hash: encode the second ones by themselves
                return self._slow(data, offsets)
        lengths = self.length[slot].astype(np.int64)
        ids = self.pool[T.ragged(self.start[slot].astype(np.int64), lengths)]
        total = np.concatenate([[0], np.cumsum(lengths)])
        return ids, total[T.of_text(starts, offsets)]

    def _slow(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        each = self.texts([data[a:b].tobytes().decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)])
        return np.concatenate(each), np.concatenate([[0], np.cumsum([len(x) for x in each])])

    def _find(self, key: np.ndarray, check: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where it isn't there."""
        out = np.full(len(key), -1, np.int64)
        at = (key >> U64(64 - self.SLOTS)).astype(np.int64)
        todo = np.arange(len(key))
        while len(todo):
            got = self.key[at]
            hit = got == key[todo]
            hit &= self.check[at] == check[todo]
            out[todo[hit]] = at[hit]
            more = ~hit & (got != 0)
            todo, at = todo[more], (at[more] + 1) & ((1 << self.SLOTS) - 1)
        return out

    def _add(self, key: np.ndarray, check: np.ndarray, words: list[str]) -> None:
        plain = [w.isalpha() for w in words]
        each: list = [None] * len(words)
        for group in range(0, len(words), 4096):
            one = [i for i in range(group, min(group + 4096, len(words))) if plain[i]]
            if one:  # a word of letters is one piece, and just its last token ends a word
                ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words[i] for i in one)], add_special_tokens=False)[0].ids, np.uint32)
                parts = np.flatnonzero(self.final[ids]) + 1
                if len(parts) == len(one):
                    before = 0
                    for i, end in zip(one, parts.tolist(), strict=True):
                        each[i] = ids[before:end]
                        before = end
        rest = [i for i, x in enumerate(each) if x is None]
        for i, ids in zip(rest, self.texts([words[i] for i in rest]), strict=True):
            each[i] = ids
        length = np.array([len(x) for x in each], np.int64)
        total = int(length.sum())
        while self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(len(self.pool), np.uint32)])
        self.pool[self.used : self.used + total] = np.concatenate(each)
        start = self.used + np.cumsum(length) - length
        self.used += total
        self.count += len(words)
        at, todo = (key >> U64(64 - self.SLOTS)).astype(np.int64), np.arange(len(key))
        while len(todo):
            free = np.flatnonzero(self.key[at] == 0)
            _, one = np.unique(at[free], return_index=True)
            put = free[one]
            i, slot = todo[put], at[put]
            self.key[slot], self.check[slot], self.start[slot], self.length[slot] = key[i], check[i], start[i], length[i]
            more = np.ones(len(todo), bool)
            more[put] = False
            todo, at = todo[more], (at[more] + 1) & ((1 << self.SLOTS) - 1)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each Python worker, kept over its tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


# -- files


def _blocks(path: str, end: int, kind: pa.DataType):
    def run(batches):
        from pyspark import TaskContext

        enc = encoder(path)
        part, block, start, docs, held = TaskContext.get().partitionId(), 0, 0, [], []

        def row():
            nonlocal block, start, docs, held
            ends = np.cumsum([len(x) for x in held])
            packed = pack(np.concatenate(held), enc.width)
            out = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block]), pa.array([start]), pa.array([int(ends[-1])]), pa.array([enc.width], pa.int32()), pa.array([docs], pa.list_(kind)), pa.array([ends.tolist()], pa.list_(pa.int64())), pa.array([packed], pa.binary())],
                ["part", "block", "start", "n", "width", "doc_ids", "ends", "packed"])
            block, start, docs, held = block + 1, start + int(ends[-1]), [], []
            return out

        size, last = 0, np.array([end], np.uint32)
        for b in batches:
            for i, ids in zip(b.column("id").to_pylist(), enc.array(b.column("text")), strict=True):
                docs.append(i)
                held.append(np.concatenate([ids, last]))
                size += len(ids) + 1
                if size >= BLOCK_IDS:
                    yield row()
                    size = 0
        if held:
            yield row()

    return run


def write_tokens(docs: DataFrame, path: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END) -> None:
    """Encode ``docs`` into files at ``path``, in ascending id order, ``end_id`` after each document.

    Nulls count as empty texts: such a document is its end id. A null id sorts first; rows that
    repeat an id each have their place, by the hash of their text. An empty table writes an empty
    folder. Other columns are ignored. ``end_id`` must fit the vocabulary. There are as many parts as the session has
    shuffle partitions, or one for each ``PART_BYTES`` of text where that is more.
    """
    kind = docs.schema[id_col].dataType
    key = F.xxhash64(F.col(text_col))
    total = docs.agg(F.sum(F.octet_length(F.col(text_col)).cast("long"))).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_BYTES))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), key.alias("th"))
    rows = rows.repartitionByRange(parts, F.col("id").asc_nulls_first(), F.col("th")).sortWithinPartitions(F.col("id").asc_nulls_first(), "th").select("id", "text")
    from pyspark.sql.pandas.types import to_arrow_type

    out = rows.mapInArrow(_blocks(vocabulary, end_id, to_arrow_type(kind)), BLOCK.format(kind=kind.simpleString()))
    out.write.option("compression", "none").parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with ``start`` counted over all parts."""
    blocks = spark.read.parquet(path)
    sizes = blocks.groupBy("part").agg(F.sum("n").alias("m"))  # a row for each part, that is, for each task that wrote
    before = sizes.select("part", (F.sum("m").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("m")).alias("before"))
    return blocks.join(F.broadcast(before), "part").withColumn("start", F.col("start") + F.col("before")).drop("before")


def _split(blocks, low: int | None = None, high: int | None = None):
    """(id, start, ids) of the documents of an Arrow batch of blocks; with ``low`` and ``high`` of those that start from low to high - 1, unpacking no other."""
    for packed, width, base, docs, ends in zip(*(blocks.column(c).to_pylist() for c in ("packed", "width", "start", "doc_ids", "ends")), strict=True):
        begins = [0, *ends[:-1]]
        first = 0 if low is None else bisect.bisect_left(begins, low - base)
        last = len(ends) if high is None else bisect.bisect_left(begins, high - base)
        if first >= last:
            continue
        zero = begins[first]
        flat = unpack(packed, width, zero, ends[last - 1]).astype("<u4")
        for k in range(first, last):
            yield docs[k], base + begins[k], flat[begins[k] - zero : ends[k] - zero]


def _documents(batches):
    for b in batches:
        rows = [(i, start, len(ids), zlib.crc32(ids.tobytes())) for i, start, ids in _split(b)]
        ids, start, n, crc = zip(*rows, strict=True) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(ids, b.column("doc_ids").type.value_type), pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_ids(spark: SparkSession, path: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """(doc_id, start, ids) of every document in the files, or of those that start at ``low`` to ``high`` - 1.

    With these, only blocks that overlap are read into tasks and only the bytes of the documents asked for are unpacked; ``low`` and
    ``high`` = ``low`` + 1 give the one document at a known start.
    """
    blocks = read_blocks(spark, path)
    kind = blocks.schema["doc_ids"].dataType.elementType
    if low is not None:
        blocks = blocks.where(F.col("start") + F.col("n") > low)
    if high is not None:
        blocks = blocks.where(F.col("start") < high)

    def run(batches):
        for b in batches:
            rows = list(_split(b, low, high))
            sizes = np.cumsum([0, *(len(x) for _, _, x in rows)])
            flat = pa.array(np.concatenate([x for _, _, x in rows]).astype(np.int32) if rows else np.zeros(0, np.int32))
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _, _ in rows], b.column("doc_ids").type.value_type), pa.array([s for _, s, _ in rows], pa.int64()), pa.ListArray.from_arrays(pa.array(sizes.astype(np.int32)), flat)], ["doc_id", "start", "ids"])

    return blocks.select("packed", "width", "start", "doc_ids", "ends").mapInArrow(run, f"doc_id {kind.simpleString()}, start bigint, ids array<int>")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""
    blocks = read_blocks(spark, path)
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    return blocks.select("packed", "width", "start", "doc_ids", "ends").mapInArrow(_documents, f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint")


def round_trip(docs: DataFrame, vocabulary: str, **how) -> DataFrame:
    """Write ``docs`` to files in the shared folder and read them back."""
    path = new_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, vocabulary, **how)
    return read_documents(docs.sparkSession, path)
