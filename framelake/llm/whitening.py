"""Embedding whitening; leading eigenvalues of the covariance are isolated by spectrum slicing.

By Sylvester's law the number of positive pivots in a factorisation LDL' of V - sI is the number of eigenvalues above s. Counts at a
few shifts shrink an interval until it holds the k-th eigenvalue alone; Rayleigh quotient iteration from inside it then converges
cubically, and counts just below and above the result certify that it is the k-th one. Eigenvalues that double precision can't
tell apart are taken together, by inverse iteration kept orthogonal.

Entries are whole numbers (floor of ``SCALE`` times the value), so the counts, sums and second moments about a whole centre near the
mean are exact whatever the order in which tasks add them: products go through floating-point matrices in pieces small enough to be exact.

Scale: distinct vectors are found with partial aggregation (a vector that a third of all rows repeat is one row of each task) and
written; sums and moments are one row of partial results for each task and entry of the matrix, added by Spark. Only matrices
of the dimension's size reach the driver. The rows are then projected in one pass without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.llm._spark import cut

SCALE = 256
COMPONENTS = 4
EXACT = 1 << 40  # entries about the centre up to which moments are whole numbers; beyond, they are added as doubles
LIMB = 20
OUT = "n bigint, deviation bigint, whitened double, explained double, identity_error double"


# -- eigenvalues


def inertia(v: np.ndarray, shift: float) -> tuple[int, int, int]:
    """How many eigenvalues of the symmetric ``v`` are above, at and below ``shift``, by LDL' with pivots of order one and two from the diagonal."""
    a = v - shift * np.eye(len(v))
    tiny = np.finfo(float).eps * max(np.abs(v).max(initial=0.0), abs(shift), np.finfo(float).tiny) * len(v) / 8
    above = at = below = 0
    growth = (1 + 17**0.5) / 8  # bounds the growth of what is left
    while len(a):
        size = np.abs(a)
        d = int(np.argmax(size.diagonal()))
        top = size.max()
        if top <= tiny:
            return above, at + len(a), below
        if size[d, d] >= growth * top:
            pick = [d]
            above, below = above + (a[d, d] > 0), below + (a[d, d] < 0)
        else:
            off = size - np.diag(size.diagonal())
            i, j = divmod(int(np.argmax(off)), len(a))
            pick = [i, j]  # a block whose off-diagonal outweighs its diagonal: one eigenvalue on each side
            above, below = above + 1, below + 1
        rest = np.setdiff1d(np.arange(len(a)), pick)
        side = a[np.ix_(rest, pick)]
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(a[np.ix_(pick, pick)], side.T)
        a = (a + a.T) / 2
    return above, at, below


def _solve(v: np.ndarray, shift: float, z: np.ndarray, step: float) -> np.ndarray:
    try:
        out = np.linalg.solve(v - shift * np.eye(len(v)), z)
    except np.linalg.LinAlgError:  # the shift is an eigenvalue
        out = np.linalg.solve(v - (shift + step) * np.eye(len(v)), z)
    return out / np.linalg.norm(out)


def leading(v: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(values, unit vectors as rows) of the ``wanted`` largest eigenvalues of the symmetric ``v``, falling; fewer where it is smaller or has fewer positive ones."""
    d = len(v)
    norm = float(np.abs(v).sum(axis=1).max(initial=0.0))  # no eigenvalue is beyond it
    step = 4 * np.finfo(float).eps * norm
    values, vectors = [], np.zeros((0, d))
    rng = np.random.default_rng(7)
    while step and len(values) < min(wanted, d):
        k = len(values)
        low, high = -norm - step, norm + step if not values else values[-1] + 64 * step
        above_low, above_high = d, inertia(v, high)[0]  # more than k, and at most k where the interval is right
        while high - low > 8 * step and (above_low, above_high) != (k + 1, k):
            middle = (low + high) / 2
            n = inertia(v, middle)[0]
            if n > k:
                low, above_low = middle, n
            else:
                high, above_high = middle, n
        alone = (above_low, above_high) == (k + 1, k)
        if alone:
            value, vector, good = _rayleigh(v, low, high, vectors, rng, step)
            margin = 64 * step
            # the certificate: k eigenvalues above, k + 1 with this one
            good = good and inertia(v, value + margin)[0] <= k and inertia(v, value - margin)[0] >= k + 1
            while not good and high - low > 8 * step:  # an unlucky start: halve on
                middle = (low + high) / 2
                low, high = (middle, high) if inertia(v, middle)[0] > k else (low, middle)
                value, vector, good = _rayleigh(v, low, high, vectors, rng, step)
            found = [(value, vector)] if good else []
        else:
            found = []
        if not found:  # eigenvalues that can't be told apart: all of them, orthogonal to each other
            m = max(1, min(inertia(v, low - 8 * step)[0], d) - k)
            for _ in range(min(m, wanted - k)):
                z = rng.standard_normal(d)
                held = np.vstack([vectors, *[x[None] for _, x in found]])
                for _ in range(6):
                    z = _solve(v, (low + high) / 2, z, step)
                    z -= held.T @ (held @ z)
                    z /= np.linalg.norm(z)
                found.append((float(z @ v @ z), z))
        for value, vector in found:
            if value <= d * step:
                return np.array(values), vectors
            values.append(value)
            vectors = np.vstack([vectors, vector[None]])
    return np.array(values), vectors


def _rayleigh(v, low, high, held, rng, step):
    """(value, vector, whether it lies within low .. high) of Rayleigh quotient iteration from the middle."""
    z = rng.standard_normal(len(v))
    shift = (low + high) / 2
    for _ in range(3):  # towards the eigenvalue nearest to the middle
        z -= held.T @ (held @ z)
        z = _solve(v, shift, z, step)
    value = float(z @ v @ z)
    for _ in range(12):
        if np.linalg.norm(v @ z - value * z) <= step:
            break
        z = _solve(v, value, z, step)
        value = float(z @ v @ z)
    z -= held.T @ (held @ z)
    z /= np.linalg.norm(z)
    return float(z @ v @ z), z, low - step <= value <= high + step


# -- moments


def whole(vector: str) -> Column:
    """The entries of a vector as whole numbers; beyond 64 bits, the nearest of these."""
    return F.transform(F.col(vector), lambda c: F.floor(c.cast("double") * F.lit(float(SCALE))))


def _matrix(b: pa.Array, d: int) -> np.ndarray:
    return b.flatten().to_numpy(zero_copy_only=False).reshape(len(b), d)


def exact_products(y: np.ndarray) -> list[list[int]]:
    """The sums of products of columns of whole numbers below ``EXACT``, as Python integers."""
    d = y.shape[1]
    parts = [y.astype(float)] if np.abs(y).max(initial=0) < 1 << LIMB else [(y >> LIMB).astype(float), (y & ((1 << LIMB) - 1)).astype(float)]
    out = np.zeros((d, d), object)
    rows = 1 << (53 - 2 * LIMB - 2)
    for i, a in enumerate(parts):
        for j, b in enumerate(parts):
            weight = 1 << LIMB * ((len(parts) - 1 - i) + (len(parts) - 1 - j))
            for first in range(0, len(y), rows):
                out += (a[first : first + rows].T @ b[first : first + rows]).astype(np.int64).astype(object) * weight
    return out.tolist()


@dataclass
class Whitening:
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None = None

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows of whole vectors."""
        mean = np.array([float(Fraction(s, self.n)) for s in self.sums]) if self.n else np.zeros(x.shape[1])
        return (x - mean) @ self.vectors.T / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S) squared, exact; None where it is beyond 64 bits."""
        top = max((abs(s) for s in self.sums), default=0) + self.n * max(int(x.max(initial=0)), -int(x.min(initial=0)))
        if top * top * max(1, x.shape[1]) < 1 << 62:
            z = self.n * x - np.array(self.sums, np.int64)
            return (z * z).sum(axis=1).tolist()
        out = [sum((self.n * c - s) ** 2 for c, s in zip(row, self.sums, strict=True)) for row in x.tolist()]
        return [v if v < 1 << 63 else None for v in out]


def usable(embeddings: DataFrame, vector: str) -> Column:
    """Vectors without nulls and non-finite entries, of the length that most such vectors have (of equal ones, the greatest)."""
    held = F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    sizes = embeddings.where(held).groupBy(F.size(vector).alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return held & (F.size(vector) == (sizes.d if sizes else 0))


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a written table of distinct whole vectors ``x``; None where it is empty."""
    d_n = distinct.select(F.size("x").alias("d")).first()
    if d_n is None:
        return None
    d = d_n.d
    each = distinct.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("v").cast("decimal(20,0)")).alias("s"), F.min("v").alias("low"), F.max("v").alias("high"))
    told = sorted(each.collect(), key=lambda r: r.i)  # a row for each dimension
    n, sums = told[0].n, [int(r.s) for r in told]
    centre = [(2 * s + n) // (2 * n) for s in sums]
    most = max(max(abs(r.low - c), abs(r.high - c)) for r, c in zip(told, centre, strict=True))
    exact = most < EXACT

    def run(batches):
        total = np.zeros((d, d), object if exact else float)
        rows = 0
        for b in batches:
            x = _matrix(b.column(0), d)
            rows += len(x)
            if exact:
                total += np.array(exact_products(x - np.array(centre, np.int64)), object).reshape(d, d)
            else:
                y = x.astype(float) - np.array([float(c) for c in centre])
                total += y.T @ y
        if rows:
            i, j = np.tril_indices(d)
            v = total[i, j]
            from decimal import Decimal

            column = pa.array([Decimal(int(k)) for k in v], pa.decimal128(38, 0)) if exact else pa.array(v.astype(float))
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), column], ["i", "j", "v"])

    cells = distinct.select("x").mapInArrow(run, f"i int, j int, v {'decimal(38,0)' if exact else 'double'}").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    v = np.zeros((d, d))
    off = [Fraction(s, n) - c for s, c in zip(sums, centre, strict=True)]  # of the mean from the centre, at most a half
    for r in cells:  # d * (d + 1) / 2 of them
        v[r.i, r.j] = v[r.j, r.i] = float(Fraction(int(r.v) if exact else r.v) / n - off[r.i] * off[r.j])
    values, vectors = leading(v, components)
    out = Whitening(n, sums, values, vectors, float(np.trace(v)))
    out.identity_error = _identity_error(distinct, out, d)
    return out


def _identity_error(distinct: DataFrame, white: Whitening, d: int) -> float | None:
    """The largest entry, in size, of the whitened covariance less the identity, by a pass over the distinct vectors."""
    k = len(white.values)
    if not k:
        return None

    def run(batches):
        for b in batches:
            w = white.project(_matrix(b.column(0), d))
            if len(w):
                mean = w.mean(axis=0)
                c = w - mean
                yield pa.RecordBatch.from_arrays([pa.array([len(w)]), pa.array([mean.tolist()]), pa.array([(c.T @ c).ravel().tolist()])], ["n", "mean", "c"])

    parts = distinct.select("x").mapInArrow(run, "n bigint, mean array<double>, c array<double>")
    wanted = [F.sum(F.col("n") * F.col("mean")[i]).alias(f"m{i}") for i in range(k)]
    wanted += [F.sum(F.col("c")[i * k + j] + F.col("n") * F.col("mean")[i] * F.col("mean")[j]).alias(f"c{i}_{j}") for i in range(k) for j in range(k)]
    one = parts.agg(*wanted).first()
    m = np.array([one[f"m{i}"] for i in range(k)]) / white.n
    c = np.array([[one[f"c{i}_{j}"] for j in range(k)] for i in range(k)]) / white.n - np.outer(m, m)
    return float(np.abs(c - np.eye(k)).max())


def whiten(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for each usable row and leading component.

    Rows whose vector is null, empty, of another length than most, or holds a null or non-finite entry are left out. Components
    are numbered from 1 by falling eigenvalue of the covariance of all distinct whole vectors; those without variance (a
    single vector, fewer dimensions) are left out, and of equal eigenvalues the vectors are any orthonormal ones, the same for
    all rows. Rows that repeat an id or a vector each have theirs, null ids too. A deviation beyond 64 bits is null. An empty
    table gives no row. Other columns, whatever they are called, are ignored.
    """
    rows = embeddings.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("embedding"))
    rows = rows.where(usable(rows, "embedding")).select("vec_id", whole("embedding").alias("x"))
    white = fit(cut(rows.select("x").distinct(), "vectors"), components)
    kind = rows.schema["vec_id"].dataType.simpleString()
    k = 0 if white is None else len(white.values)
    explained = [] if not k else (white.values / white.trace).tolist()

    def run(batches):
        for b in batches:
            m = b.num_rows
            if not k or not m:
                continue
            x = _matrix(b.column("x"), len(white.sums))
            w, deviation = white.project(x), white.deviation(x)
            back = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id").take(back), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, white.n)), pa.array(deviation, pa.int64()).take(back),
                 pa.array(w.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, white.identity_error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, f"vec_id {kind}, component int, {OUT}")
