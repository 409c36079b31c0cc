"""Byte-level BPE by speculation and verification: greedy longest matches, a vectorised check of every adjacent pair, exact merging of what fails.

A sequence of tokens is what BPE makes of a word exactly when each two neighbours are what it makes of their bytes.
Two neighbours aren't, when a merge across their border comes up before the merges that use up its two sides; both sides
change only along the right-most parts of the left token and the left-most parts of the right one, so a pair is checked by
walking back these two spines, all pairs of a batch at once. Greedy longest matches come from a descent of the vocabulary's trie from
all positions of a batch at once. Words that fail the check are merged in order of rank, one by one.

Texts are cut into words by the pattern of the byte-level pre-tokenizer, worked out on arrays of character classes (which are
asked of the library's own pattern engine, so that its edition of Unicode decides). Words met before keep their ids in a table of bounded size.

Scale: one pass without a shuffle; a text's ids depend on nothing but the text and the vocabulary. A task holds a chunk
of whole texts (or one longer text) and arrays of a few dozen bytes for each of its bytes.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm import _text as T

U64 = np.uint64
VOCABULARY = "byte_bpe_50k.json"
NEVER = np.int64(1) << 40  # later than any merge
SHORT = 256  # bytes of a word that is merged beside others; longer ones use a heap


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes themselves, the others 256, 257, .. in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)]


# -- words

SPACE, LETTER, DIGIT, OTHER = range(4)


@lru_cache(1)
def character_ranges() -> tuple[np.ndarray, np.ndarray]:
    """(first code points, class) of all ranges of characters of one class, as the library's pattern engine has them.

    Found from the runs of each class in the row of all code points. It takes some seconds, so the driver does it once and sends
    the ranges, of which Unicode has a few thousand.
    """
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    points = np.array([c for c in range(0x110000) if not 0xD800 <= c < 0xE000])
    row = "".join(map(chr, points.tolist()))
    classes = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((SPACE, r"\s"), (LETTER, r"\p{L}"), (DIGIT, r"\p{N}")):
        for _, (a, b) in Split(Regex(f"[^{pattern}]+"), "removed").pre_tokenize_str(row):
            classes[points[a:b]] = kind
    first = np.flatnonzero(np.diff(classes.astype(np.int16), prepend=-1))
    return first, classes[first]


def character_classes(ranges: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    first, kinds = ranges
    return np.repeat(kinds, np.diff(np.append(first, 0x110000)))


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(value, first byte) of each character of UTF-8 bytes."""
    at = np.flatnonzero(T.code_points(data))
    lead = data[at].astype(np.int32)
    size = 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
    value = np.where(size == 1, lead, lead & (0x7F >> size))
    for k in range(1, 4):
        more = np.flatnonzero(size > k)
        value[more] = value[more] << 6 | (data[np.minimum(at[more] + k, len(data) - 1)] & 0x3F)
    return np.minimum(value, 0x10FFFF), at


def cut_words(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """First bytes of the words of texts: contractions, runs of letters, digits or marks with at most one blank before them, and runs of white space.

    Of a run of white space with a word behind it, the last character stands alone, or goes with the word where it is a blank.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    ascii_only = not (data & 0x80).any()
    value, at = (data, None) if ascii_only else code_points(data)
    m = len(value)
    kind = classes[value]
    edge = np.zeros(m + 1, bool)
    inner = offsets[(offsets < n)]
    edge[inner if ascii_only else np.searchsorted(at, inner)] = True
    edge[m] = True
    first, last = edge[:m], edge[1:]
    space = kind == SPACE
    changed = np.ones(m, bool)
    changed[1:] = kind[1:] != kind[:-1]
    after_blank = np.zeros(m, bool)
    after_blank[1:] = (value[:-1] == 0x20) & ~edge[1:m]
    start = first | (changed & ~(~space & after_blank))
    tail = np.zeros(m, bool)  # the last character of white space before a word
    tail[:-1] = space[:-1] & ~space[1:] & ~last[:-1]
    start |= tail
    # contractions begin a word of their own and end it
    mark = np.flatnonzero(start & (value == 0x27) & ~last)
    if len(mark):
        one = value[mark + 1]
        two = np.where(last[mark + 1], 0, value[np.minimum(mark + 2, m - 1)])
        size = np.where(np.isin(one, [*b"stmd"]), 2, np.where(((one == 0x72) & (two == 0x65)) | ((one == 0x76) & (two == 0x65)) | ((one == 0x6C) & (two == 0x6C)), 3, 0))
        mark, size = mark[size > 0], size[size > 0]
        start[mark + 1] = False
        end = mark + size
        start[end[end < m]] = True
    words = np.flatnonzero(start)
    return words if ascii_only else at[words]


class Memo:
    """Integers made of byte spans (the ids of a word), kept for spans met before; emptied when full.

    ``make`` takes a list of distinct spans and gives (all integers side by side, how many of each). Spans are told apart by a
    64-bit hash, their length and their first eight bytes; where two of one hash differ in these, a chunk is made without the table.
    """

    def __init__(self, make: Callable, entries: int = 600_000, integers: int = 4_000_000):
        self.make, self.entries, self.integers = make, entries, integers
        self._empty()

    def _empty(self) -> None:
        self.slot: dict[int, int] = {}
        self.check, self.begin, self.length = np.zeros(1 << 12, U64), np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.pool, self.used = np.zeros(1 << 14, np.int64), 0

    def spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(integers of all spans in order, how many of each)."""
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        key = T.span_hash(data, starts, ends)
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        heads = np.lib.stride_tricks.as_strided(padded[:8].view(U64), (len(data),), (1,))[starts]
        size = np.minimum(ends - starts, 8).astype(U64)
        check = (heads << (U64(64) - U64(8) * size)) ^ ((ends - starts).astype(U64) * U64(0x9E3779B97F4A7C15))
        return self.look(key, check, lambda i: [data[a:b].tobytes() for a, b in zip(starts[i].tolist(), ends[i].tolist(), strict=True)])

    def look(self, key: np.ndarray, check: np.ndarray, spell: Callable) -> tuple[np.ndarray, np.ndarray]:
        unique, first, back = np.unique(key, return_index=True, return_inverse=True)
        if (check != check[first][back]).any():
            return self.make(spell(np.arange(len(key))))
        if len(self.slot) > self.entries or self.used > self.integers:
            self._empty()
        known = self.slot
        slot = np.array([known.get(k, -1) for k in unique.tolist()], np.int64)
        new = np.flatnonzero(slot < 0)
        if (self.check[slot[slot >= 0]] != check[first][slot >= 0]).any():
            return self.make(spell(np.arange(len(key))))
        if len(new):
            values, length = self.make(spell(first[new]))
            slot[new] = np.arange(len(known), len(known) + len(new))
            known.update(zip(unique[new].tolist(), slot[new].tolist(), strict=True))
            for name, what in (("check", check[first[new]]), ("begin", self.used + np.cumsum(length) - length), ("length", length)):
                array = getattr(self, name)
                if len(array) < len(known):
                    setattr(self, name, array := np.concatenate([array, np.zeros(max(len(array), len(known) - len(array)), array.dtype)]))
                array[slot[new]] = what
            if len(self.pool) < self.used + len(values):
                self.pool = np.concatenate([self.pool, np.zeros(max(len(self.pool), self.used + len(values) - len(self.pool)), np.int64)])
            self.pool[self.used : self.used + len(values)] = values
            self.used += len(values)
        slot = slot[back]
        return self.pool[T.ragged(self.begin[slot], self.length[slot])], self.length[slot]


# -- tokens


class Trie:
    """Longest match of a vocabulary at each position of bytes, for all positions at once."""

    def __init__(self, tokens: dict[int, bytes]):
        nodes: dict[int, int] = {}  # parent * 256 + byte -> node
        ids = [-1]
        for i, token in tokens.items():
            node = 0
            for b in token:
                key = node << 8 | b
                node = nodes.get(key)
                if node is None:
                    node = nodes[key] = len(ids)
                    ids.append(-1)
            ids[node] = i
        keys = np.fromiter(nodes, np.int64, len(nodes))
        order = np.argsort(keys)
        self.keys, self.child, self.ids = keys[order], np.fromiter(nodes.values(), np.int64, len(nodes))[order], np.array(ids, np.int64)

    def longest(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(id, length) of the longest token at each position that doesn't go beyond ``ends`` there; every byte is a token."""
        best, length = np.zeros(len(data), np.int64), np.ones(len(data), np.int64)
        at, node, depth = np.arange(len(data)), np.zeros(len(data), np.int64), 0
        while len(at):
            key = node << 8 | data[at + depth]
            i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[i] == key
            at, node, depth = at[hit], self.child[i[hit]], depth + 1
            done = self.ids[node] >= 0
            best[at[done]], length[at[done]] = self.ids[node[done]], depth
            more = at + depth < ends[at]
            at, node = at[more], node[more]
        return best, length


class Bpe:
    """A byte-level BPE tokenizer of the tokenizers library, read from its file.

    With ``specials`` the strings of added tokens in a text become these tokens, as in the library's ``encode``; else they are plain text.
    """

    def __init__(self, path: str, specials: bool = True, ranges: tuple | None = None):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model, decoder = spec["pre_tokenizer"] or {}, spec["model"], spec["decoder"] or {}
        odd = [k for k in ("unk_token", "dropout", "continuing_subword_prefix", "end_of_word_suffix") if model.get(k)]
        if model["type"] != "BPE" or odd or spec["normalizer"] or spec["post_processor"] or (pre.get("type"), pre.get("add_prefix_space"), pre.get("use_regex")) != ("ByteLevel", False, True) or decoder.get("type") != "ByteLevel" or model.get("ignore_merges"):
            raise ValueError("not a plain byte-level BPE file")
        byte = {c: b for b, c in enumerate(byte_letters())}
        self.vocab: dict[str, int] = model["vocab"]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("added tokens must be plain strings")
        self.added = {t.encode(): i for t, i in added.items()} if specials else {}
        self.finder = re.compile(b"|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True))) if self.added else None
        spelled = {i: bytes(byte[c] for c in t) if all(c in byte for c in t) else t.encode() for t, i in (self.vocab | added).items()}
        self.size = max(spelled) + 1
        self.classes = character_classes(ranges or character_ranges())
        #: bytes of all tokens side by side
        self.token_begin = np.zeros(self.size + 1, np.int64)
        self.token_begin[1:] = np.cumsum([len(spelled.get(i, b"")) for i in range(self.size)])
        self.token_bytes = np.frombuffer(b"".join(spelled.get(i, b"") for i in range(self.size)), np.uint8)
        # merges: parts and rank of what they make, and rank of each pair
        self.rank = np.full(self.size, -1, np.int64)
        self.left, self.right = np.full(self.size, -1, np.int64), np.full(self.size, -1, np.int64)
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        self.made = np.zeros(len(model["merges"]), np.int64)
        for k, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            x, y, z = self.vocab[a], self.vocab[b], self.vocab[a + b]
            if self.rank[z] < 0:
                self.rank[z], self.left[z], self.right[z] = k, x, y
            self.pairs[x, y], self.made[k] = (k, z), z
        key = np.array([x * self.size + y for x, y in self.pairs], np.int64)
        order = np.argsort(key)
        self.pair_key, self.pair_rank = key[order], np.array([k for k, _ in self.pairs.values()], np.int64)[order]
        self.byte_id = np.array([self.vocab[c] for c in byte_letters()], np.int64)
        # what BPE makes of its own bytes; only such a token may be proposed
        merged = np.flatnonzero(self.rank >= 0)
        merged = merged[np.argsort(self.rank[merged], kind="stable")]
        own = np.zeros(self.size, bool)
        own[self.byte_id] = True
        stays = self.compatible(self.left[merged], self.right[merged], self.rank[merged])
        for t, x, y, good in zip(merged.tolist(), self.left[merged].tolist(), self.right[merged].tolist(), stays.tolist(), strict=True):
            own[t] = good and own[x] and own[y]
        self.trie = Trie({int(i): spelled[int(i)] for i in np.flatnonzero(own)})
        self.words = Memo(self.encode_words)

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """For each pair of tokens, whether BPE leaves them side by side (until the merge of rank ``limit``, if given).

        Goes back in time along both spines: of the two parts at the border, the one made later is taken apart; a merge of the
        border comes first if its rank is below that of the merge which uses up its left part, and not above the one that uses up its
        right part (equal ranks are merged from the left).
        """
        n = len(a)
        good, todo = np.ones(n, bool), np.arange(n)
        u, v = a.copy(), b.copy()
        after_u = np.full(n, NEVER) if limit is None else limit.copy()
        after_v = after_u.copy()
        while len(todo):
            r = self._pair_ranks(u, v)
            bad = (r < after_u) & (r <= after_v) & (r < NEVER)
            good[todo[bad]] = False
            ru, rv = self.rank[u], self.rank[v]
            go = ~bad & ((ru >= 0) | (rv >= 0))
            back_u = ru > rv
            after_u, after_v = np.where(back_u, ru, after_u)[go], np.where(back_u, after_v, rv)[go]
            u, v = np.where(back_u, self.right[u], u)[go], np.where(back_u, v, self.left[v])[go]
            todo = todo[go]
        return good

    def _pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair's merge, ``NEVER`` where there is none."""
        key = a * self.size + b
        i = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where(self.pair_key[i] == key, self.pair_rank[i], NEVER)

    def merge_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, index of their word) of short words, merged exactly: each turn merges in every word the left-most of its pairs of least rank."""
        sizes = np.array([len(w) for w in words], np.int64)
        ids = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        last = np.zeros(len(ids), bool)
        last[np.cumsum(sizes) - 1] = True
        rank = np.where(last, NEVER, self._pair_ranks(ids, np.append(ids[1:], 0)))
        done_ids, done_words = [], []
        while len(ids):
            starts = np.flatnonzero(np.concatenate([[True], last[:-1]]))
            least = np.minimum.reduceat(rank, starts)
            going = np.repeat(least < NEVER, np.diff(np.append(starts, len(ids))))
            if not going.all():
                done_ids.append(ids[~going])
                done_words.append(word[~going])
                ids, word, last, rank, least = ids[going], word[going], last[going], rank[going], least[least < NEVER]
                if not len(ids):
                    break
                starts = np.flatnonzero(np.concatenate([[True], last[:-1]]))
            at = np.flatnonzero(rank == np.repeat(least, np.diff(np.append(starts, len(ids)))))
            at = at[np.concatenate([[True], word[at[1:]] != word[at[:-1]]])]  # the left-most of each word
            ids[at] = self.made[rank[at]]
            last[at] = last[at + 1]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))  # one place before each was taken out
            ids, word, last, rank = ids[keep], word[keep], last[keep], rank[keep]
            rank[at] = np.where(last[at], NEVER, self._pair_ranks(ids[at], ids[np.minimum(at + 1, len(ids) - 1)]))
            left = at[(at > 0) & ~last[at - 1]] - 1
            rank[left] = self._pair_ranks(ids[left], ids[left + 1])
        ids, word = np.concatenate(done_ids or [ids]), np.concatenate(done_words or [word])
        order = np.argsort(word, kind="stable")
        return ids[order], word[order]

    def merge(self, word: bytes) -> list[int]:
        """The merges of a long word in order of rank, equal ranks from the left."""
        ids = self.byte_id[np.frombuffer(word, np.uint8)].tolist()
        pairs = self.pairs
        n = len(ids)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(pairs[p][0], i, *p) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in pairs]
        heapq.heapify(heap)
        while heap:
            _, i, x, y = heapq.heappop(heap)
            j = after[i] if ids[i] == x else -1
            if j < 0 or ids[j] != y:
                continue  # one of the two is gone
            ids[i], ids[j] = pairs[x, y][1], -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (p := (ids[a], ids[b])) in pairs:
                    heapq.heappush(heap, (pairs[p][0], a, *p))
        return [i for i in ids if i >= 0]

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in order, how many of each)."""
        sizes = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        best, length = self.trie.longest(data, np.repeat(ends, sizes))
        # the chain of longest matches from each word's start; a plain walk, since a word's step depends on the one before
        chosen, edge = np.zeros(len(data), bool), np.zeros(len(data) + 1, bool)
        edge[ends] = True
        at = starts
        while len(at) > 64:
            chosen[at] = True
            at = at + length[at]
            at = at[~edge[at]]
        if len(at):
            step = length.tolist() if len(data) < 1 << 16 else length
            of = np.searchsorted(ends, at, "right")
            for a, end in zip(at.tolist(), ends[of].tolist(), strict=True):
                while a < end:
                    chosen[a] = True
                    a += int(step[a])
        at = np.flatnonzero(chosen)
        ids, word = best[at], np.searchsorted(ends, at, "right")
        same = np.flatnonzero(word[1:] == word[:-1])
        pair = ids[same] * self.size + ids[same + 1]
        unique, back = np.unique(pair, return_inverse=True)
        failing = np.unique(word[same[~self.compatible(unique // self.size, unique % self.size)[back]]])
        special = [i for i, w in enumerate(words) if w in self.added] if self.added else []
        long = failing[sizes[failing] > SHORT]
        redo = {int(i): self.merge(words[i]) for i in long} | {i: [self.added[words[i]]] for i in special}
        short = np.setdiff1d(failing, np.array(list(redo), np.int64))
        if redo or len(short):
            away = np.zeros(len(words), bool)
            away[[*redo, *short.tolist()]] = True
            keep = ~away[word]
            merged, of = self.merge_all([words[i] for i in short.tolist()])
            more = np.array([x for r in redo.values() for x in r], np.int64)
            owner = np.repeat(np.array(list(redo), np.int64), [len(r) for r in redo.values()])
            ids, word = np.concatenate([ids[keep], merged, more]), np.concatenate([word[keep], short[of], owner])
            order = np.argsort(word, kind="stable")
            ids, word = ids[order], word[order]
        return ids, np.bincount(word, minlength=len(words)).astype(np.int64)

    def chunk(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the texts side by side, where each begins and one more)."""
        bounds, found = offsets, []
        if self.finder:
            raw = data.tobytes()
            if any(t in raw for t in self.added):
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                    found += [m.span() for m in self.finder.finditer(raw, a, b)]
                bounds = np.unique(np.concatenate([offsets, np.array(found, np.int64).ravel()]))
        starts = cut_words(data, bounds, self.classes)
        if found:
            spans = np.array(found, np.int64)
            inside = np.searchsorted(spans[:, 0], starts, "right") - 1
            starts = starts[(inside < 0) | (starts == spans[inside, 0]) | (starts >= spans[inside, 1])]
        ids, count = self.words.spans(data, starts, np.append(starts[1:], len(data)))
        total = np.concatenate([[0], np.cumsum(count)])
        return ids, total[np.searchsorted(starts, offsets)]

    def encode(self, array: pa.Array):
        """The ids of each text of an Arrow string array, in order; nulls count as empty texts."""
        for first, last, data, offsets in T.chunks(array):
            ids, at = self.chunk(data, offsets)
            for i in range(last - first):
                yield ids[at[i] : at[i + 1]]

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids' bytes, what isn't UTF-8 replaced."""
        begin = self.token_begin[ids]
        return self.token_bytes[T.ragged(begin, self.token_begin[ids + 1] - begin)].tobytes().decode("utf-8", "replace")


_kept: dict[tuple, Bpe] = {}


def tokenizer(path: str, specials: bool = True, ranges: tuple | None = None) -> Bpe:
    """One for each Python worker, kept over its tasks."""
    if (path, specials) not in _kept:
        _kept[path, specials] = Bpe(path, specials, ranges)
    return _kept[path, specials]


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of each row; ``ids`` are those of the tokenizers library's ``encode`` without special tokens added.

    Strings of special tokens in a text become these tokens. Null and empty texts have no ids; an empty table gives no row; rows
    that repeat an id or a text each have theirs; texts are read whole; other columns, whatever they are called, are ignored.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind, ranges = rows.schema["doc_id"].dataType.simpleString(), character_ranges()

    def run(batches):
        bpe = tokenizer(vocabulary, True, ranges)
        for b in batches:
            ids = list(bpe.encode(b.column("text")))
            ends = np.cumsum([0, *map(len, ids)])
            flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))], ["doc_id", "ids"])

    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids): special tokens are spelled out, bytes that aren't UTF-8 replaced. Null ids give an empty text."""
    kind, ranges = encoded.schema["doc_id"].dataType.simpleString(), character_ranges()

    def run(batches):
        bpe = tokenizer(vocabulary, True, ranges)
        for b in batches:
            column = b.column("ids")
            texts = [bpe.decode(x.values.to_numpy(zero_copy_only=False).astype(np.int64) if x.is_valid else np.zeros(0, np.int64)) for x in column]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each row: of its ids as unsigned 32-bit little-endian integers and of the text decoded from them.

    Encoding and decoding run in one pass, so no ids are moved between tasks. Rows as in ``encode``.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind, ranges = rows.schema["doc_id"].dataType.simpleString(), character_ranges()

    def run(batches):
        bpe = tokenizer(vocabulary, True, ranges)
        for b in batches:
            n, of_ids, of_text = [], [], []
            for ids in bpe.encode(b.column("text")):
                n.append(len(ids))
                of_ids.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                of_text.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
