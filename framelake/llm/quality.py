"""Quality rules by gradient-boosted trees over document statistics.

Trees are grown on histograms of a bounded sample of labelled documents, with the sign of some
features' effect fixed, and flattened into numpy node arrays, so that scoring walks all documents
of a batch down a tree at once. Scale: statistics, scoring and verdict are one pass over the
texts without a shuffle; the model is a few kilobytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm import _text as T

SAMPLE = 20_000  # labelled rows that a model is fitted on, at most
MIN_WORDS, MAX_REPEAT = 50, 50
SYMBOLS = np.isin(np.arange(256), [*b"#*$%&|<>"])
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: name of each feature and the sign that its effect on quality may have (0: either)
FEATURES = (("log_words", 1), ("mean_word", 0), ("symbol_ratio", -1), ("dup_line_ratio", -1), ("repeat_ratio", -1), ("upper_ratio", -1), ("digit_ratio", 0), ("mark_ratio", -1), ("letter_ratio", 1), ("mean_line", 0))
_UPPER = np.isin(np.arange(256), np.arange(65, 91))
_DIGIT = np.isin(np.arange(256), np.arange(48, 58))
_LETTER = np.isin(np.arange(256) | 32, np.arange(97, 123)) | (np.arange(256) >= 0xC0)
_MARK = np.array([b < 128 and chr(b).isprintable() and not chr(b).isalnum() and b != 32 for b in range(256)])
_LF = np.arange(256) == 10


def _repeats(key: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(how often each (key, text) occurs, whether it is not its first)."""
    if not len(key):
        return np.zeros(0, np.int64), np.zeros(0, bool)
    both = T.mix(key ^ T.mix(text.astype(np.uint64) + np.uint64(1)))
    _, first, inverse, count = np.unique(both, return_index=True, return_inverse=True, return_counts=True)
    later = np.ones(len(key), bool)
    later[first] = False
    return count[inverse], later


def statistics(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(counts, features) of each text; see COUNTS and FEATURES."""
    counts, features = [np.zeros((0, len(COUNTS)), np.int64)], [np.zeros((0, len(FEATURES)))]
    for first, last, data, offsets in T.chunks(array):
        n = last - first
        starts, ends = T.spans(data, offsets)
        bounds = T.of_text(starts, offsets)
        hashes = T.span_hash(data, starts, ends)
        words = np.diff(bounds)
        text = T.owner(bounds)
        point = T.code_points(data)
        solid = point & ~T.WHITE[data]
        # words of three-word windows that occur twice
        inside = np.arange(len(hashes)) - bounds[:-1][text]
        window = np.flatnonzero(inside + 3 <= words[text])
        gram = T.mix(T.mix(T.mix(hashes[window]) + hashes[np.minimum(window + 1, len(hashes) - 1)]) + hashes[np.minimum(window + 2, len(hashes) - 1)]) if len(window) else np.zeros(0, np.uint64)
        often = window[_repeats(gram, text[window])[0] > 1]
        covered = np.zeros(len(hashes) + 3, bool)
        for k in range(3):
            covered[often + k] = True
        repeat = T.per_text(covered[: len(hashes)], bounds)
        # lines that hold a word and equal an earlier one
        begin, end = T.spans(data, offsets, _LF)
        filled = np.searchsorted(starts, end) > np.searchsorted(starts, begin)
        begin, end = begin[filled], end[filled]
        at = T.of_text(begin, offsets)
        later = _repeats(T.span_hash(data, begin, end), T.owner(at))[1]
        dup = T.per_text(later, at)
        chars = T.per_text(solid, offsets)
        symbols = T.per_text(SYMBOLS[data], offsets)
        lines, w, c = np.maximum(1, np.diff(at)), np.maximum(1, words), np.maximum(1, chars)
        counts.append(np.stack([words, chars, symbols, dup, repeat], 1))
        share = [T.per_text(flag[data], offsets) / c for flag in (_UPPER, _DIGIT, _MARK, _LETTER)]
        features.append(np.stack([np.log1p(words), chars / w, symbols / w, dup / lines, repeat / w, *share, words / lines], 1))
    return np.concatenate(counts), np.concatenate(features)


@dataclass
class Trees:
    """Nodes of all trees side by side: a leaf is its own child on either side."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds that a document is good."""
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            out += self.value[node]
        return out


def fit(x: np.ndarray, y: np.ndarray, signs: tuple[int, ...], trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 48, ridge: float = 2.0, least: int = 10) -> Trees:
    """Second-order boosting of log loss; a split that breaks a feature's sign is not taken, and children keep to their side of its midpoint."""
    edges = [np.unique(np.quantile(f, np.linspace(0, 1, bins + 1)[1:-1])) if len(f) else np.zeros(0) for f in x.T]
    binned = np.stack([np.searchsorted(e, f, "left") for e, f in zip(edges, x.T, strict=True)], 1) if len(x) else np.zeros(x.shape, int)
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    score = np.full(len(y), base)
    nodes: list[list] = []
    roots = []

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, left: int, low: float, high: float) -> int:
        me = len(nodes)
        value = float(np.clip(-g[rows].sum() / (h[rows].sum() + ridge), low, high))
        nodes.append([0, np.inf, me, me, rate * value])
        best = (1e-6, None)
        if left and len(rows) >= 2 * least:
            total_g, total_h = g[rows].sum(), h[rows].sum()
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                b = binned[rows, f]
                n = np.cumsum(np.bincount(b, minlength=len(e) + 1))[:-1]
                gl, hl = (np.cumsum(np.bincount(b, v[rows], len(e) + 1))[:-1] for v in (g, h))
                gr, hr = total_g - gl, total_h - hl
                vl, vr = np.clip(-gl / (hl + ridge), low, high), np.clip(-gr / (hr + ridge), low, high)
                gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - total_g**2 / (total_h + ridge)
                gain[(n < least) | (len(rows) - n < least) | (signs[f] * (vr - vl) < 0)] = -np.inf
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (float(gain[k]), (f, k, (vl[k] + vr[k]) / 2))
        if best[1]:
            f, k, middle = best[1]
            side = binned[rows, f] <= k
            bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle)), 0: ((low, high), (low, high))}[signs[f]]
            a = grow(rows[side], g, h, left - 1, *bounds[0])
            b = grow(rows[~side], g, h, left - 1, *bounds[1])
            nodes[me][:4] = [f, float(edges[f][k]), a, b]
        return me

    for _ in range(trees if len(y) else 0):
        p = 1 / (1 + np.exp(-score))
        before = len(nodes)
        roots.append(grow(np.arange(len(y)), p - y, p * (1 - p), depth, -np.inf, np.inf))
        tree = Trees(np.array(roots[-1:]), *(np.array(c) for c in zip(*nodes, strict=True)), depth, 0.0)
        score += tree.score(x)
        if len(nodes) == before + 1:
            break
    columns = [np.array(c) for c in zip(*nodes, strict=True)] if nodes else [np.zeros(1, int)] * 4 + [np.zeros(1)]
    return Trees(np.array(roots, int), *columns, depth, base)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", **how) -> Trees:
    """Fit on ``sample`` labelled documents at most, those whose ids hash lowest."""
    picked = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y")).orderBy(F.xxhash64("id"), "id", "y").limit(sample)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(picked), "id")  # sample rows at most

    def run(batches):
        for b in batches:
            x = statistics(b.column("text"))[1]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("y"), pa.array(list(x), pa.list_(pa.float64()))], ["id", "y", "x"])

    got = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, y double, x array<double>").orderBy(F.xxhash64("id"), "id", "x").limit(sample).collect()
    x = np.array([r.x for r in got]).reshape(len(got), len(FEATURES))
    return fit(x, np.array([r.y for r in got]), tuple(s for _, s in FEATURES), **how)


def judge(docs: DataFrame, model: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of ``docs``: doc_id, the counts, base_failed, kept, score (log odds of good).

    base_failed: fewer than 50 words, or over half of them in three-word windows that the text
    repeats. kept: not base_failed and a score of 0 or more. Null and empty texts have no words and
    fail. Ids, null or repeated, pass through; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        for b in batches:
            n, x = statistics(b.column("text"))
            failed = (n[:, 0] < MIN_WORDS) | (100 * n[:, 4] > MAX_REPEAT * n[:, 0])
            score = model.score(x)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c) for c in n.T), pa.array(failed), pa.array(~failed & (score >= 0)), pa.array(score)], ["doc_id", *COUNTS, "base_failed", "kept", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", base_failed boolean, kept boolean, score double")
