"""Embedding whitening by spectrum slicing.

The covariance of the distinct vectors is summed by Spark; its leading
eigenvalues are then isolated one by one. The signs of D in an LDL' factorisation
of the covariance shifted by s tell how many eigenvalues lie below s (Sylvester's
law of inertia), so bisection on that count encloses the k-th largest one, Rayleigh
quotient iteration converges to it cubically, and two more counts on either side
certify that the pair found is number k.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, table, written

COMPONENTS = 16
#: An entry c becomes floor(SCALE c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Vectors a task multiplies at a time.
ROWS = 4096
ALPHA = (1 + 17 ** 0.5) / 8


# --- the spectrum ------------------------------------------------------------

def inertia(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric ``matrix`` lie below ``shift``: the
    negative ones of D in P(A - shift I)P' = L D L', whose blocks are chosen by
    Bunch and Kaufman's pivoting. A pivot of exactly 0 counts as positive."""
    a = matrix - shift * np.eye(len(matrix))
    n, below, k = len(a), 0, 0
    while k < n:
        if k == n - 1:
            below += a[k, k] < 0
            break
        r = k + 1 + int(np.argmax(np.abs(a[k + 1:, k])))
        most = abs(a[r, k])
        if most == 0:
            below += a[k, k] < 0
            k += 1
            continue
        size, pivot = 1, k
        if abs(a[k, k]) < ALPHA * most:
            row = np.abs(a[r, k:])
            row[r - k] = 0
            other = row.max()
            if abs(a[k, k]) * other < ALPHA * most * most:
                size, pivot = (1, r) if abs(a[r, r]) >= ALPHA * other else (2, r)
        at = k + size - 1
        if pivot != at:
            a[[at, pivot]] = a[[pivot, at]]
            a[:, [at, pivot]] = a[:, [pivot, at]]
        below_block = a[k + size:, k:k + size]
        block = a[k:k + size, k:k + size]
        if size == 1:
            below += block[0, 0] < 0
            a[k + 1:, k + 1:] -= np.outer(below_block[:, 0], below_block[:, 0]) / block[0, 0]
        else:
            below += 1  # such a block has one eigenvalue of each sign
            a[k + 2:, k + 2:] -= below_block @ np.linalg.solve(block, below_block.T)
        k += size
    return int(below)


class Component(NamedTuple):
    value: float
    vector: np.ndarray
    #: Whether the counts around ``value`` certify its number (False where
    #: another eigenvalue is too near to tell them apart in double precision).
    certified: bool


def leading_components(matrix: np.ndarray, number: int) -> list[Component]:
    """The ``number`` (or all) largest eigenvalues of a symmetric matrix, falling,
    with unit vectors, each orthogonal to those before it. The sign of a vector
    is that of its largest entry's: positive."""
    d = len(matrix)
    norm = float(np.abs(matrix).sum(axis=1).max()) if d else 0.0
    small = 8 * d * np.finfo(float).eps * norm
    counts: dict[float, int] = {}

    def below(shift: float) -> int:
        if shift not in counts:
            counts[shift] = inertia(matrix, shift)
        return counts[shift]

    counts[-norm - small - 1], counts[norm + small + 1] = 0, d
    found: list[Component] = []
    for k in range(min(number, d)):
        index = d - 1 - k  # its place among the eigenvalues in rising order
        # The tightest enclosure that counts taken so far give.
        low = max(s for s, c in counts.items() if c <= index)
        high = min(s for s, c in counts.items() if c > index)
        while True:
            alone = below(low) == index and below(high) == index + 1
            if alone or high - low <= small:
                value, vector = rayleigh(matrix, (low + high) / 2, [c.vector for c in found], small)
                if high - low <= small or low <= value <= high:
                    break
            middle = (low + high) / 2
            if not low < middle < high:
                value, vector = rayleigh(matrix, middle, [c.vector for c in found], small)
                break
            low, high = (middle, high) if below(middle) <= index else (low, middle)
        error = float(np.linalg.norm(matrix @ vector - value * vector)) + small
        certified = below(value - 2 * error) == index and below(value + 2 * error) == index + 1
        sign = np.sign(vector[np.argmax(np.abs(vector))])
        found.append(Component(value, vector * (sign or 1), certified))
    return found


def rayleigh(matrix: np.ndarray, shift: float, known: list[np.ndarray], small: float
             ) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration from two steps of inverse iteration at
    ``shift``, in the complement of the ``known`` vectors."""
    d = len(matrix)
    basis = np.array(known).reshape(len(known), d)
    eye = np.eye(d)

    def apart(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - basis.T @ (basis @ v)
        size = np.linalg.norm(v)
        return v / size if size > 0 else v

    def solved(at: float, v: np.ndarray) -> np.ndarray:
        for nudge in (0.0, small, 2 * small):
            try:
                out = np.linalg.solve(matrix - (at + nudge) * eye, v)
            except np.linalg.LinAlgError:
                continue
            if np.isfinite(out).all() and np.any(out):
                return out / np.linalg.norm(out)
        return v

    # Another start for each pair: one start has one direction of an eigenspace.
    v = apart(np.random.default_rng([d, len(known)]).standard_normal(d))
    for _ in range(2):
        v = apart(solved(shift, v))
    value, last = float(v @ matrix @ v), np.inf
    for _ in range(30):
        rest = float(np.linalg.norm(matrix @ v - value * v))
        if rest <= small / 8 or rest >= last / 2 and rest <= small:
            break
        last = rest
        v = apart(solved(value, v))
        value = float(v @ matrix @ v)
    return value, v


# --- vectors as whole numbers ------------------------------------------------

def whole(batch: pa.RecordBatch, column: str, width: int | None = None
          ) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the batch's usable rows and their vectors as whole numbers; only
    rows of ``width`` entries if that is given. Unusable are NULL vectors, those
    with NULL or non-finite entries, and entries too large for a long."""
    col = batch.column(column)
    lens = col.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    if width is None:
        width = int(lens.max(initial=0))
    rows = np.flatnonzero(lens == width) if width else np.zeros(0, np.int64)
    flat = col.take(pa.array(rows, pa.int64())).flatten()
    c = flat.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
    c = np.floor(SCALE * c.reshape(len(rows), width))
    good = (np.abs(c) < 2.0 ** 62).all(axis=1)  # not so for NaN and infinities
    return rows[good], c[good].astype(np.int64) + OFFSET


def vector_width(vectors: DataFrame, column: str) -> int:
    """The commonest length of usable vectors (the largest of equally common)."""
    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        for batch in batches:
            lens = batch.column(column).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            for w in np.unique(lens[lens > 0]).tolist():
                counts[w] = counts.get(w, 0) + len(whole(batch, column, w)[0])
        yield pa.RecordBatch.from_arrays([pa.array([*counts], pa.int32()),
                                          pa.array([*counts.values()], pa.int64())],
                                         names=["width", "n"])

    top = (vectors.select(column).mapInArrow(lengths, "width int, n long").groupBy("width")
           .agg(F.sum("n").alias("n")).where("n > 0")
           .orderBy(F.col("n").desc(), F.col("width").desc()).first())
    return top["width"] if top else 0


def fit_list(vectors: DataFrame, column: str, width: int) -> DataFrame:
    """Each distinct whole-number vector once (``x``, its longs). Tasks fold equal
    vectors before the shuffle, so a very common one is a row per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, x = whole(batch, column, width)
            raw = x.astype("<i8").tobytes()
            size = 8 * width
            yield pa.RecordBatch.from_arrays(
                [pa.array([raw[i:i + size] for i in range(0, len(raw), size)], pa.binary())],
                names=["x"])

    return written(vectors.select(column).mapInArrow(run, "x binary").distinct(), "fit-list")


def blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    """The fit list's vectors, some thousand at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            raw = batch.column("x").slice(at, ROWS).to_pylist()
            yield np.frombuffer(b"".join(raw), "<i8").reshape(-1, width)


def summed(fit: DataFrame, width: int, each, rows: int, columns: int) -> np.ndarray:
    """The sum over the fit list of ``each(x)``, a (rows, columns) matrix for a
    block of vectors: one matrix a task, added up row by row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for x in blocks(batches, width):
            part = each(x)
            total = part if total is None else total + part
        if total is not None:
            yield packed(range(rows), total)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, raw, whole_ in zip(*(batch.column(c).to_pylist() for c in ("i", "v", "whole")),
                                      strict=True):
                v = np.frombuffer(raw, np.int64 if whole_ else np.float64)
                total[i] = total[i] + v if i in total else v
        if total:
            yield packed([*total], np.array([*total.values()]))

    def packed(at, matrix: np.ndarray) -> pa.RecordBatch:
        matrix = matrix.reshape(-1, columns)
        return pa.RecordBatch.from_arrays(
            [pa.array([*at], pa.int32()), pa.array([r.tobytes() for r in matrix], pa.binary()),
             pa.array([matrix.dtype.kind == "i"] * len(matrix), pa.bool_())],
            names=["i", "v", "whole"])

    kind = "i int, v binary, whole boolean"
    parts = fit.mapInArrow(run, kind).repartition(min(rows, 32), "i").mapInArrow(add, kind)
    out = None
    for r in written(parts, "matrix-rows").collect():  # as many rows as the matrix has
        v = np.frombuffer(r["v"], np.int64 if r["whole"] else np.float64)
        out = np.zeros((rows, columns), v.dtype) if out is None else out
        out[r["i"]] = v
    return np.zeros((rows, columns)) if out is None else out


# --- whitening ---------------------------------------------------------------

class Whitening(NamedTuple):
    """What a fit list gives: its size, sums by dimension, components, the trace of
    its covariance and how far the whitened covariance is from the identity."""
    n: int
    sums: np.ndarray
    components: list[Component]
    trace: float
    identity_error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n: whole parts first, so that nothing is lost to the size of
        the numbers."""
        base = self.sums // self.n
        return (x - base) - (self.sums - base * self.n) / self.n

    def basis(self) -> np.ndarray:
        """Columns that project a centred vector to whitened components (NaN for
        one without variance)."""
        d = len(self.sums)
        none = len(self.sums) * np.finfo(float).eps * self.trace
        return np.array([c.vector / np.sqrt(c.value) if c.value > none else np.full(d, np.nan)
                         for c in self.components]).reshape(-1, d).T

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - sums)^2, exact; None beyond a long."""
        rough = ((self.n * x.astype(float) - self.sums.astype(float)) ** 2).sum(axis=1)
        most = float(np.abs(x).max(initial=0)) * self.n
        if rough.max(initial=0) < 2.0 ** 61 and most < 2.0 ** 62 and self.sums.dtype != object:
            return ((self.n * x - self.sums) ** 2).sum(axis=1).tolist()
        sums = [int(s) for s in self.sums.tolist()]
        exact = (sum((self.n * v - s) ** 2 for v, s in zip(row, sums, strict=True))
                 for row in x.tolist())
        return [e if e < 1 << 63 else None for e in exact]


def fitted(fit: DataFrame, width: int, components: int) -> Whitening:
    """Four passes over the fit list: sums, covariance, the whitened vectors' sums
    and their covariance. Each task sends one matrix."""
    n = fit.count()
    # Sums in two halves: longs cannot overflow whatever the number of vectors.
    halves = summed(fit, width, lambda x: np.array([(x >> 32).sum(axis=0),
                                                    (x & 0xFFFFFFFF).sum(axis=0)]), 2, width)
    total = [(int(a) << 32) + int(b) for a, b in zip(*halves.tolist(), strict=True)]
    sums = np.array(total, np.int64 if all(abs(t) < 1 << 62 for t in total) else object)
    bare = Whitening(n, sums, [], 0.0, 0.0)

    def gram(x):
        y = bare.centred(x).astype(float)
        return y.T @ y

    matrix = summed(fit, width, gram, width, width) / n
    matrix = (matrix + matrix.T) / 2
    trace = float(np.trace(matrix))
    model = Whitening(n, sums, leading_components(matrix, components), trace, 0.0)
    basis = model.basis()
    basis = basis[:, np.isfinite(basis).all(axis=0)]
    k = basis.shape[1]
    if not k:
        return model
    mean = summed(fit, width, lambda x: (bare.centred(x).astype(float) @ basis)
                  .sum(axis=0, keepdims=True), 1, k)[0] / n

    def spread(x):
        w = bare.centred(x).astype(float) @ basis - mean
        return w.T @ w

    error = np.abs(summed(fit, width, spread, k, k) / n - np.eye(k)).max()
    return model._replace(identity_error=float(error))


def whiten(vectors: DataFrame, components: int = COMPONENTS, key: str = "vec_id",
           column: str = "embedding") -> DataFrame:
    """One row per usable row of ``vectors`` and component (1 .. ``components``,
    or the dimensions if fewer): ``key``, component, n, deviation, whitened,
    explained, identity_error, value (the eigenvalue) and certified.

    Unusable rows are left out: NULL vectors, vectors with NULL or non-finite
    entries (or beyond 2**62 when scaled), and vectors of another length than the
    commonest. Equal vectors count once in the fit; every row is returned, also
    where keys repeat or are NULL. ``deviation`` is NULL beyond a long; for a
    component without variance (fewer distinct vectors than components, constant
    dimensions) ``whitened`` is NULL and ``identity_error`` leaves it out. Other
    columns are left out. No usable row gives an empty table.
    """
    rows = vectors.select(F.col(key).alias("k"), F.col(column).alias("v"))
    kind = vectors.schema[key].dataType.simpleString()
    names = fresh(["k", "v"], "component", "n", "deviation", "whitened", "explained",
                  "identity_error", "value", "certified")
    types = ("int", "long", "long", "double", "double", "double", "double", "boolean")
    schema = f"k {kind}, " + ", ".join(f"{c} {t}" for c, t in zip(names, types, strict=True))
    width = vector_width(rows, "v")
    if not width:
        return vectors.sparkSession.createDataFrame([], schema).withColumnRenamed("k", key)
    model = fitted(fit_list(rows, "v", width), width, components)
    basis, found, count = model.basis(), model.components, len(model.components)
    explained = [c.value / model.trace if model.trace > 0 else 0.0 for c in found]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = whole(batch, "v", width)
            m = len(at)
            white = model.centred(x).astype(float) @ basis
            keys = batch.column("k").take(pa.array(np.repeat(at, count)))
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * count, model.n)),
                 pa.array(model.deviation(x), pa.int64()).take(
                     pa.array(np.repeat(np.arange(m), count))),
                 pa.array(white.ravel(), from_pandas=True),  # NaN: NULL
                 pa.array(np.tile(explained, m)), pa.array(np.full(m * count, model.identity_error)),
                 pa.array(np.tile([c.value for c in found], m)),
                 pa.array(np.tile([c.certified for c in found], m))],
                names=["k", *names])

    return rows.mapInArrow(project, schema).withColumnRenamed("k", key)


def op11_whitening(spark, sf_dir: str) -> DataFrame:
    """All usable embeddings on their 16 leading components; see ``whiten``."""
    return whiten(table(spark, sf_dir, "embeddings"))
