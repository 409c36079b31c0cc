"""Toxicity grades by cumulative-link ordinal regression over sparse text features.

P(grade > k) = 1 / (1 + exp(theta_k - w.x)) with one w for all ordered thresholds theta_k; the
output is the expected grade, the sum of those chances. Features are hashed words and the first
bytes of longer ones (presence), chosen by how far their odds differ between toxic and other
documents of the sample.

Labels say toxic or not. Grades of toxic documents are cut by how many words they hold of those
that the sample ties to toxic ones most surely: up to 2, up to 5, more. So the severity among toxic
documents follows from words, not from anyone's judgement of how bad they are.

Scale: the sample's feature counts are summed up by Spark, and only the chosen features of each of its
documents, a bit for each, come to the driver. Grading is one pass over the texts without a shuffle; the model
has FEATURES weights.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framelake.llm import _text as T
from framelake.llm._spark import cut

SAMPLE = 20_000  # labelled rows that a model is fitted on, at most
BITS = 20
FEATURES = 400
PREFIX = 6  # bytes
CUTS = (2, 5)
_NOT_WORD = ~((np.isin(np.arange(256) | 32, np.arange(97, 123))) | (np.arange(256) >= 0x80))


def words(array: pa.Array):
    """For each chunk: (texts, index of each feature, its text)."""
    for first, last, data, offsets in T.chunks(array):
        data = T.LOWER[data]
        starts, ends = T.spans(data, offsets, _NOT_WORD)
        text = T.owner(T.of_text(starts, offsets))
        long = ends - starts > PREFIX
        heads = T.mix(T.span_hash(data, starts[long], starts[long] + PREFIX))  # mixed again, so that a head isn't the word of its letters
        hashes = np.concatenate([T.span_hash(data, starts, ends), heads])
        yield last - first, (hashes >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate([text, text[long]])


@dataclass
class Model:
    index: np.ndarray  # sorted feature indices
    weight: np.ndarray
    theta: np.ndarray

    def latent(self, array: pa.Array) -> np.ndarray:
        """w.x of each text."""
        out = [np.zeros(0)]
        for n, index, text in words(array):
            at = np.searchsorted(self.index, index)
            at[at == len(self.index)] = 0
            hit = self.index[at] == index if len(self.index) else np.zeros(len(at), bool)
            pairs = np.unique(text[hit] * len(self.index) + at[hit])  # presence: a word counts once
            out.append(np.bincount(pairs // len(self.index), self.weight[pairs % len(self.index)], n) if len(pairs) else np.zeros(n))
        return np.concatenate(out)

    def chances(self, latent: np.ndarray) -> np.ndarray:
        """P(grade > k) for each threshold."""
        return 1 / (1 + np.exp(np.clip(self.theta[None, :] - latent[:, None], -60, 60)))


def loss(x: np.ndarray, grade: np.ndarray, w: np.ndarray, first: float, gaps: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """The penalised negative log likelihood of grades, and its gradient by (w, first, gaps).

    P(grade = g) = F(g - 1) - F(g) with F(k) = 1 / (1 + exp(theta_k - w.x)); thresholds start at ``first`` and go up by exp(gaps).
    """
    theta = np.concatenate([[first], first + np.cumsum(np.exp(gaps))])
    levels, n, at_row = len(theta), len(x), np.arange(len(x))
    f = 1 / (1 + np.exp(np.clip(theta[None, :] - (x @ w)[:, None], -60, 60)))
    full = np.concatenate([np.ones((n, 1)), f, np.zeros((n, 1))], 1)
    p = np.maximum(full[at_row, grade] - full[at_row, grade + 1], 1e-9)
    slope = np.concatenate([np.zeros((n, 1)), f * (1 - f), np.zeros((n, 1))], 1)
    up, down = slope[at_row, grade] / p, slope[at_row, grade + 1] / p
    d_theta = np.zeros(levels)
    np.add.at(d_theta, np.maximum(grade - 1, 0), np.where(grade > 0, up, 0))
    np.add.at(d_theta, np.minimum(grade, levels - 1), np.where(grade < levels, -down, 0))
    d_w = -(x.T @ (up - down)) + ridge * w
    d_gaps = np.array([d_theta[k + 1 :].sum() for k in range(levels - 1)]) * np.exp(gaps)
    return float(-np.log(p).sum() + ridge / 2 * w @ w), np.concatenate([d_w, [d_theta.sum()], d_gaps])


def fit(x: np.ndarray, toxic: np.ndarray, index: np.ndarray, strong: np.ndarray, ridge: float = 1.0, steps: int = 500) -> Model:
    """``x``: which of the features ``index`` each document of the sample holds; those that are ``strong`` cut the grades of toxic ones."""
    x = x.astype(np.float64)
    count = x[:, strong].sum(1)
    grade = np.where(toxic, 1 + sum((count > c).astype(int) for c in CUTS), 0)
    # Adam, thresholds kept in order by positive gaps
    at, n = np.concatenate([np.zeros(len(index)), [1.0], np.zeros(len(CUTS))]), max(1, len(x))
    speed, square = np.zeros(len(at)), np.zeros(len(at))
    for step in range(1, steps + 1):
        g = loss(x, grade, at[: len(index)], at[len(index)], at[len(index) + 1 :], ridge)[1] / n
        speed, square = 0.9 * speed + 0.1 * g, 0.99 * square + 0.01 * g * g
        at = at - 0.1 * (speed / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    w, first, gaps = at[: len(index)], at[len(index) : len(index) + 1], at[len(index) + 1 :]
    return Model(index, w, np.concatenate([first, first + np.cumsum(np.exp(gaps))]))


def _features(batches):
    """id, y, the hash of the four least of its features, and all its features, of each document."""
    for b in batches:
        least, x = [], []
        for n, index, text in words(b.column("text")):
            pairs = np.unique(text << BITS | index)
            at = np.searchsorted(pairs >> BITS, np.arange(n + 1))
            for i in range(n):
                one = (pairs[at[i] : at[i + 1]] & ((1 << BITS) - 1)).astype(np.int32)
                x.append(one)
                least.append(np.sort(T.mix(one.astype(np.uint64)))[:4].tobytes())
        sizes = np.cumsum([0, *map(len, x)])
        lists = pa.ListArray.from_arrays(pa.array(sizes.astype(np.int32)), pa.array(np.concatenate(x) if x else np.zeros(0, np.int32)))
        yield pa.RecordBatch.from_arrays([b.column("id"), b.column("y"), pa.array(least, pa.binary()), lists], ["id", "y", "least", "x"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", features: int = FEATURES, **how) -> Model:
    """Fit on ``sample`` labelled documents at most, those whose ids hash lowest; near copies (equal least features) count once.

    Three quarters of the features are those that speak for toxic most surely, the rest those against; each is in four documents or
    more. Null labels, ids and texts without features are passed over; without a labelled row all grades are those of an empty text.
    """
    picked = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).orderBy(F.xxhash64("id"), "id", "y").limit(sample)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(picked), "id")  # sample rows at most
    place = [F.xxhash64("id"), F.col("id"), F.col("x")]
    found = rows.mapInArrow(_features, f"id {rows.schema['id'].dataType.simpleString()}, y int, least binary, x array<int>").where(F.size("x") > 0)
    again = F.row_number().over(Window.partitionBy("least", "y").orderBy(*place))
    seen = cut(found.withColumn("again", again).where("again = 1").orderBy(*place).limit(sample).select("id", "y", "x"), "toxic-sample")
    n1, n0 = (int(k or 0) for k in seen.agg(F.sum("y"), F.sum(1 - F.col("y"))).first())
    counts = seen.select("y", F.explode("x").alias("f")).groupBy("f").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b")).where("a + b >= 4")
    z = f"(ln((a + 0.5) / ({n1} - a + 0.5)) - ln((b + 0.5) / ({n0} - b + 0.5))) / sqrt(1 / (a + 0.5) + 1 / (b + 0.5))"
    rated = cut(counts.selectExpr("f", "a", "b", f"{z} as z").where("abs(z) > 2.5"), "toxic-features")
    chosen = rated.where("z > 0").orderBy(F.desc("z"), "f").limit(features * 3 // 4).collect() + rated.where("z < 0").orderBy("z", F.desc("f")).limit(features // 4).collect()
    chosen.sort(key=lambda r: r.f)
    index = np.array([r.f for r in chosen], np.int64)

    def marked(batches):
        for b in batches:
            bits = []
            for x in b.column("x").to_pylist():
                row = np.zeros(len(index), bool)
                at = np.searchsorted(index, x)
                hit = at < len(index)
                at, x = at[hit], np.array(x, np.int64)[hit]
                row[at[index[at] == x]] = True
                bits.append(np.packbits(row).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("y"), pa.array(bits, pa.binary())], ["id", "y", "bits"])

    kind = seen.schema["id"].dataType.simpleString()
    got = seen.mapInArrow(marked, f"id {kind}, y int, bits binary").orderBy(F.xxhash64("id"), "id", "bits").collect()  # sample rows of a bit for each feature
    x = np.array([np.unpackbits(np.frombuffer(r.bits, np.uint8), count=len(index)) for r in got], np.uint8).reshape(len(got), len(index)).astype(bool)
    return fit(x, np.array([r.y for r in got], bool), index, np.array([r.z > 4.5 and r.a > 9 * r.b for r in chosen], bool), **how)


def grade(docs: DataFrame, model: Model, text_col: str = "text", columns: list[str] | None = None) -> DataFrame:
    """``columns`` (all) of ``docs`` with p_toxic, severity (expected grade, 0 to 3) and toxic (p_toxic of at least a half).

    Null and empty texts hold no feature and get the grade of such a text. Rows, repeated or with
    null ids, each get theirs. A new column whose name ``docs`` has takes a leading underscore.
    """
    from framelake.llm._spark import fresh

    columns = docs.columns if columns is None else columns
    p, severity, toxic = (fresh(docs, c) for c in ("p_toxic", "severity", "toxic"))
    rows = docs.select(*columns, *([] if text_col in columns else [text_col]))
    text_at = rows.columns.index(text_col)

    def run(batches):
        for b in batches:
            chance = model.chances(model.latent(b.column(text_at)))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(columns))), pa.array(chance[:, 0]), pa.array(chance.sum(1)), pa.array(chance[:, 0] >= 0.5)], [*columns, p, severity, toxic])

    from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

    kinds = StructType([rows.schema[c] for c in columns] + [StructField(p, DoubleType()), StructField(severity, DoubleType()), StructField(toxic, BooleanType())])
    return rows.mapInArrow(run, kinds)
