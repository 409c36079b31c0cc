"""Vectorised text work on Arrow string buffers: spans, hashes and counts without a Python object per word.

A chunk is the UTF-8 bytes of some whole texts side by side plus the offsets where each begins.
Nulls count as empty texts. Spans never cross from one text into the next.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
CHUNK_BYTES = 1 << 20

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE = np.random.default_rng(20240229).integers(0, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_powers = np.ones(1, U64), np.ones(1, U64)


def chunks(array: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) for runs of whole texts of about ``limit`` bytes; a longer text comes alone."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    n = len(array)
    if not n:
        return
    if array.null_count:
        array = array.fill_null("")
    large = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offs, data = array.buffers()
    offsets = np.frombuffer(offs, np.int64 if large else np.int32)[array.offset : array.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last, raw[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def spans(data: np.ndarray, offsets: np.ndarray, white: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes that aren't ``white``."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ok = ~white[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start, end = ok.copy(), ok.copy()
    start[1:] &= ~ok[:-1] | edge[1:n]
    end[:-1] &= ~ok[1:] | edge[1:n]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def of_text(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where each text's spans begin in ``starts``; one more entry than texts."""
    return np.searchsorted(starts, offsets)


def owner(bounds: np.ndarray) -> np.ndarray:
    """The text of each span."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64 bits."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; tables for up to two chunks are kept, longer ones made for the call."""
    global _powers
    if len(_powers[0]) >= n:
        return _powers
    size = max(n, 2 * CHUNK_BYTES + 1)
    out = []
    for base in (_BASE, pow(_BASE, -1, 2**64)):
        p = np.full(size, base, U64)
        p[0] = 1
        out.append(np.cumprod(p))
    if size == 2 * CHUNK_BYTES + 1:
        _powers = tuple(out)
    return tuple(out)


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span's bytes: a polynomial over a table of random values, read off running sums.

    ``starts`` ascend. Longer data goes by stretches of about a chunk, so tables and sums stay small next to a long text;
    only a single span of more bytes needs tables of its length, which aren't kept.
    """
    n = len(data)
    if n > 2 * CHUNK_BYTES and len(starts):
        out, at = [], 0
        while at < len(starts):
            to = max(at + 1, int(np.searchsorted(starts, starts[at] + CHUNK_BYTES)))
            low, high = int(starts[at]), int(ends[at:to].max())
            out.append(_span_hash(data[low:high], starts[at:to] - low, ends[at:to] - low))
            at = to
        return np.concatenate(out)
    return _span_hash(data, starts, ends)


def _span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    n = len(data)
    power, inverse = _power(n + 1)
    total = np.zeros(n + 1, U64)
    np.cumsum(_BYTE[data] * power[:n], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


def shingles(words: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``n`` words and its text. Texts with fewer words (but some) get one over all they have."""
    counts = np.diff(bounds)
    text = owner(bounds)
    inside = np.arange(len(words)) - bounds[:-1][text]
    full = inside + n <= counts[text]
    h = np.zeros(len(words), U64)
    for k in range(n):
        h[: len(words) - k] += mix(words[k:] + U64((k + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        h = mix(h)
    short = np.flatnonzero((counts > 0) & (counts < n))
    got, of = h[full], text[full]
    if len(short):
        extra = [mix(np.array([_fold(words[bounds[t] : bounds[t + 1]])], U64))[0] for t in short]
        got, of = np.concatenate([got, np.array(extra, U64)]), np.concatenate([of, short])
        order = np.argsort(of, kind="stable")
        got, of = got[order], of[order]
    return got, of


def _fold(words: np.ndarray) -> int:
    h = len(words)
    for w in words.tolist():
        h = (h * 0x100000001B3 ^ w) & 0xFFFFFFFFFFFFFFFF
    return h


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, .. of every run, one run after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def code_points(data: np.ndarray) -> np.ndarray:
    """True at the first byte of each code point."""
    return (data & 0xC0) != 0x80


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags each text has."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]
