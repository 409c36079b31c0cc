"""Token ids of two tokenizers aligned by the bytes that they stand for.

Each text is tokenised whole by both: A, a byte-level BPE, on a space and the text; B, a sentencepiece model that adds the space
itself. Where tokens of both end at the same byte and both go on with a space-marked token, the text is split: between two
such anchors lies a window, told by its tuples of A ids and B ids. What a window gives (its groups, its links, their text) is worked
out once and kept for each tuple met before, in a table of bounded size; new windows of a chunk are aligned side by side on arrays.

Scale: the texts are tokenised in one pass, which writes for each row its figures and its distinct pairs of linked ids with how
often each occurs. How many rows hold a pair is counted with partial sums. These counts then meet the rows: sent to
all tasks while there are at most ``SENT_ROWS`` of them; beyond that the most frequent ones are sent (so no key of the join holds
many rows) and the others are joined by a shuffle. Only one row for each document and task is shuffled after that.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm import _text as T
from framelake.llm import bpe
from framelake.llm._spark import cut

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
SENT_ROWS = 1_000_000
MARK = "▁"


class Pieces:
    """A sentencepiece model whose pieces hold space marks at their beginning only, so that a text's ids are those of its words side by side."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(self.size)]
        self.by_word = not any(MARK in p.lstrip(MARK) for p in pieces)
        spelled = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.length = np.array([len(s) for s in spelled], np.int64)
        self.begin = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)
        self.words = bpe.Memo(self._encode_words)

    def _encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that each begin with the space which the model adds by itself."""
        ids = self.model.encode([w[1:].decode() for w in words], num_threads=1)
        lone = self.model.piece_to_id(MARK)
        ids = [x if w != b" " else [lone] for w, x in zip(words, ids, strict=True)]
        count = np.array([len(x) for x in ids], np.int64)
        return np.fromiter((i for x in ids for i in x), np.int64, int(count.sum())), count

    def chunk(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the texts side by side, where each begins and one more); each text begins with the space that the model adds."""
        space = data == 0x20
        start = space.copy()
        if self.by_word:
            start[1:] &= ~space[:-1]
        else:
            start[:] = False
        start[offsets[:-1]] = True
        starts = np.flatnonzero(start)
        ids, count = self.words.spans(data, starts, np.append(starts[1:], len(data)))
        return ids, np.concatenate([[0], np.cumsum(count)])[np.searchsorted(starts, offsets)]


class Windows(bpe.Memo):
    """What the windows give: for each (index of its text in ``told``, number of groups, a code for each link)."""

    def __init__(self, length_a: np.ndarray, length_b: np.ndarray):
        self.length_a, self.length_b = length_a, length_b
        most = max(len(length_a), len(length_b))
        digits = [str(i).encode() for i in range(most)]
        self.digits = np.frombuffer(b"".join(digits), np.uint8)
        self.digit_count = np.array([len(d) for d in digits], np.int64)
        self.digit_begin = np.cumsum(self.digit_count) - self.digit_count
        super().__init__(self._align, 400_000, 6_000_000)

    def _empty(self) -> None:
        super()._empty()
        self.told: list[bytes] = []

    def _align(self, windows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Windows are 32-bit integers: A ids, -1, B ids."""
        flat = np.frombuffer(b"".join(windows), np.int32).astype(np.int64)
        window = np.repeat(np.arange(len(windows)), [len(w) // 4 for w in windows])
        bar = flat < 0
        side = np.cumsum(bar) > window  # behind the bar of its own window
        is_a, is_b = ~side, side & ~bar
        a, b, wa, wb = flat[is_a], flat[is_b], window[is_a], window[is_b]
        end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        at_a, at_b = np.zeros(int(end_a[-1]) + 1, bool), np.zeros(int(end_a[-1]) + 1, bool)
        at_a[end_a] = at_b[end_b] = True
        shared = at_a & at_b
        before = np.cumsum(shared)
        group_a, group_b = before[end_a - 1], before[end_b - 1]
        ends = np.flatnonzero(at_a | at_b)  # between two neighbours lies the overlap of one pair
        first, second = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        code, of = a[first] * len(self.length_b) + b[second], wa[first]
        n_groups = np.bincount(wa[np.searchsorted(end_a, np.flatnonzero(shared))], minlength=len(windows))
        n_links = np.bincount(of, minlength=len(windows))
        self._tell(a, b, group_a, group_b, wa, wb, len(windows))
        count = n_links + 2
        begin = np.cumsum(count) - count
        out = np.zeros(int(count.sum()), np.int64)
        out[begin], out[begin + 1] = np.arange(len(self.told) - len(windows), len(self.told)), n_groups
        out[T.ragged(begin + 2, n_links)] = code
        return out, count

    def _tell(self, a, b, group_a, group_b, wa, wb, n: int) -> None:
        """The text of each window: decimal A ids and B ids of its groups, in order."""
        place_a = np.arange(len(a)) + np.searchsorted(group_b, group_a, "left")
        place_b = np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")
        total = len(a) + len(b)
        ids, sep, window = np.zeros(total, np.int64), np.full(total, ord(","), np.uint8), np.zeros(total, np.int64)
        ids[place_a], ids[place_b], window[place_a], window[place_b] = a, b, wa, wb
        sep[place_a[np.append(group_a[1:] != group_a[:-1], True)]] = ord("|")
        sep[place_b[np.append(group_b[1:] != group_b[:-1], True)]] = ord(";")
        size = self.digit_count[ids] + 1
        begin = np.cumsum(size) - size
        out = np.zeros(int(size.sum()), np.uint8)
        out[T.ragged(begin, size - 1)] = self.digits[T.ragged(self.digit_begin[ids], size - 1)]
        out[begin + size - 1] = sep
        ends = np.cumsum(np.bincount(window, size, n).astype(np.int64))
        raw = out.tobytes()
        self.told += [raw[x : y - 1] for x, y in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


class Aligner:
    def __init__(self, path_a: str, path_b: str, ranges: tuple | None = None):
        self.a, self.b = bpe.tokenizer(path_a, False, ranges), Pieces(path_b)
        self.length_a = np.diff(self.a.token_begin)
        self.windows = Windows(self.length_a, self.b.length)

    def chunk(self, data: np.ndarray, offsets: np.ndarray):
        """(n_a, n_b, n_groups, n_links, digest, codes, times) of each text."""
        sizes = np.diff(offsets)
        n = len(sizes)
        data = np.insert(data, offsets[:-1], 32)
        offsets = offsets + np.arange(n + 1)
        ids_a, at_a = self.a.chunk(data, offsets)
        ids_b, at_b = self.b.chunk(data, offsets)
        good = (sizes > 0) & self._same(ids_a, at_a, self.length_a, self.a.token_begin, self.a.token_bytes, data, offsets)
        good &= self._same(ids_b, at_b, self.b.length, self.b.begin, self.b.bytes, data, offsets)
        left = np.flatnonzero(good)
        n_a, n_b = np.where(good, np.diff(at_a), 0), np.where(good, np.diff(at_b), 0)
        if not len(left):
            return [(0, 0, 0, 0, "", [], [])] * n
        ids_a, ids_b = ids_a[T.ragged(at_a[left], n_a[left])], ids_b[T.ragged(at_b[left], n_b[left])]
        data = data[T.ragged(offsets[left], sizes[left] + 1)]
        end_a, end_b = np.cumsum(self.length_a[ids_a]), np.cumsum(self.b.length[ids_b])
        flag_a, flag_b = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
        flag_a[end_a] = flag_b[end_b] = True
        anchor = flag_a & flag_b
        anchor[:-1] &= data == 0x20  # texts begin with a space too
        anchors = np.flatnonzero(anchor)
        to_a, to_b = np.searchsorted(end_a, anchors) + 1, np.searchsorted(end_b, anchors) + 1
        in_a, in_b = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
        size = in_a + in_b + 1
        begin = np.cumsum(size) - size
        stream = np.full(int(size.sum()), -1, np.int32)
        stream[T.ragged(begin, in_a)] = ids_a
        stream[T.ragged(begin + in_a + 1, in_b)] = ids_b
        values, count = self.windows.spans(stream.view(np.uint8), begin * 4, (begin + size) * 4)
        told = self.windows.told
        where = np.cumsum(count) - count
        texts, groups = values[where].tolist(), np.concatenate([[0], np.cumsum(values[where + 1])])
        codes = values[T.ragged(where + 2, count - 2)]
        links = np.concatenate([[0], np.cumsum(count - 2)])
        bounds = np.searchsorted(anchors, np.concatenate([[0], np.cumsum(sizes[left] + 1)]), "right")  # windows before each text
        owner = np.repeat(np.arange(len(left)), np.diff(links[bounds]))
        pairs, times = np.unique(owner << 32 | codes, return_counts=True)
        cuts = np.searchsorted(pairs >> 32, np.arange(len(left) + 1))
        pairs = (pairs & 0xFFFFFFFF).astype(np.int32 if len(self.length_a) * self.b.size < 1 << 31 else np.int64)
        out = [(0, 0, 0, 0, "", [], [])] * n
        for k, i in enumerate(left.tolist()):
            x, y = int(bounds[k]), int(bounds[k + 1])
            digest = hashlib.sha256(b";".join([told[t] for t in texts[x:y]])).hexdigest()
            held = slice(int(cuts[k]), int(cuts[k + 1]))
            out[i] = int(n_a[i]), int(n_b[i]), int(groups[y] - groups[x]), int(links[y] - links[x]), digest, pairs[held], times[held]
        return out

    @staticmethod
    def _same(ids, at, length, begin, spelled, data, offsets) -> np.ndarray:
        """Which texts' tokens stand for just their bytes."""
        total = np.concatenate([[0], np.cumsum(length[ids])])
        fits = np.diff(total[at]) == np.diff(offsets)
        if fits.all():
            of = np.arange(len(fits))
        else:
            of = np.flatnonzero(fits)
            ids, data = ids[T.ragged(at[of], np.diff(at)[of])], data[T.ragged(offsets[of], np.diff(offsets)[of])]
            offsets = np.concatenate([[0], np.cumsum(np.diff(offsets)[of])])
        wrong = np.flatnonzero(spelled[T.ragged(begin[ids], length[ids])] != data)
        fits[of[np.unique(np.searchsorted(offsets, wrong, "right") - 1)]] = False
        return fits


_kept: dict[tuple, Aligner] = {}


def aligner(path_a: str, path_b: str, ranges: tuple | None = None) -> Aligner:
    """One for each Python worker, kept over its tasks."""
    if (path_a, path_b) not in _kept:
        _kept[path_a, path_b] = Aligner(path_a, path_b, ranges)
    return _kept[path_a, path_b]


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, row, n_a, n_b, n_groups, n_links, groups_sha256, and the distinct linked pairs of each row: code (A id * size of B + B id) and times.

    ``row`` numbers the rows of a written table. Rows as in ``alignment``.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"))
    kind, ranges = rows.schema["doc_id"].dataType.simpleString(), bpe.character_ranges()

    def run(batches):
        tool = aligner(path_a, path_b, ranges)
        for b in batches:
            for first, last, data, offsets in T.chunks(b.column("text")):
                out = tool.chunk(data, offsets)
                n_a, n_b, n_groups, n_links, digest, codes, times = zip(*out, strict=True)
                ends = pa.array(np.cumsum([0, *map(len, codes)]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.asarray(x, k) for x in lists]))) for lists, k in ((codes, np.int64), (times, np.int32))]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(first, last - first), b.column("row").slice(first, last - first), *(pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, n_links)), pa.array(digest, pa.string()), *lists],
                    ["doc_id", "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "codes", "times"])

    return rows.mapInArrow(run, f"doc_id {kind}, row bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, codes array<bigint>, times array<int>")


def pair_counts(found: DataFrame, size_b: int) -> DataFrame:
    """(code, held, best): how many rows hold a pair linked, and whether no other pair of its A id is held by more."""
    counts = found.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("held"))
    counts = cut(counts.withColumn("a", F.expr(f"code div {size_b}")), "pair-counts")
    most = counts.groupBy("a").agg(F.max("held").alias("most"))
    return counts.join(most, "a").select("code", "held", (F.col("held") == F.col("most")).alias("best"))


def alignment(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Groups are the stretches between bytes where tokens of both end; links are pairs of an A and a B token whose bytes overlap; a
    pair of ids counts as often as rows hold it linked. n_best is the number of links whose count is the highest of their A id, count_sum
    the sum of counts over links. groups_sha256 is of ``a1,a2|b1;a3|b2,b3``. Null and empty texts, and those whose tokens don't stand
    for just their bytes, have no tokens: zeros and an empty digest. Rows that repeat an id or a text count each; long texts are
    read whole; an empty table gives no row; other columns, whatever they are called, are ignored.
    """
    import sentencepiece

    size_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    found = cut(aligned(docs, path_a, path_b, id_col, text_col), "aligned")
    counts = cut(pair_counts(found, size_b), "pair-ranks")
    links = found.select("row", F.explode(F.arrays_zip("codes", "times")).alias("p")).select("row", F.col("p.codes").alias("code"), F.col("p.times").alias("times"))
    if counts.count() <= SENT_ROWS:
        met = links.join(F.broadcast(counts), "code")
    else:
        level = F.floor(F.log2("held")).cast("int")
        levels = {r.level: r.n for r in counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()}  # at most 63 rows
        least, sent = 64, 0
        for k in sorted(levels, reverse=True):
            if sent + levels[k] > SENT_ROWS:
                break
            least, sent = k, sent + levels[k]
        often, seldom = counts.where(level >= least), counts.where(level < least)
        known = links.join(F.broadcast(often), "code", "left")
        met = known.where("held is not null").unionByName(known.where("held is null").drop("held", "best").join(seldom, "code"))
    sums = met.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("held") * F.col("times")).alias("count_sum"))
    out = found.drop("codes", "times").join(sums, "row", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
