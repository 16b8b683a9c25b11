"""Operator 11: embedding whitening by spectrum slicing.

Vectors become whole numbers, so their sums are exact.  Spark adds up, task by
task, first the entries of every dimension, then the products of the centred
entries: numbers by (row, column) of the covariance, as many as it has,
whatever the number of vectors.  The driver holds that one matrix.

Its leading eigenvalues are isolated by slicing: the pivots of the LDL^T
factorisation (symmetric pivoting, 1x1 and 2x2 blocks) of V - s I have the
signs of its eigenvalues (Sylvester), so their count tells how many
eigenvalues lie above s.  An interval that holds several is halved until it
holds one.  There, inverse iteration at the middle and then Rayleigh quotient
iteration, which converges cubically, give the eigenpair; counts just below
and above the value found certify its number.  Values that no halving parts
(equal within rounding) get an orthonormal basis of their space.

A count costs d^3 / 3 operations for d dimensions, independent of the rows; the
driver's work suits up to some hundreds of dimensions.  The projection is one
matrix product a batch in the tasks; a further pass over the projected vectors
measures how far their covariance is from the identity.

Edge cases: vectors that are null, or hold null or non-finite entries, or
entries of 2^56 and more (their whole number would not fit) are dropped; of
vectors of several lengths those of the commonest length stay (ties: the
longer), as one covariance needs one length; components whose variance is
nothing but rounding do not exist, so a table without variance gives no rows;
a deviation beyond 64 bits is null; vectors with equal or null ids are rows of
their own; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, staged

COMPONENTS = 32
EPS = np.finfo(float).eps
_PIVOT = (1 + 17 ** 0.5) / 8  # bounds the growth of the pivoted factorisation


# ---- the eigenvalues of one matrix --------------------------------------------

def count_above(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric matrix lie above `shift`: the
    positive pivots of L D L^T = V - shift I."""
    a = v - shift * np.eye(len(v))
    above = 0
    while len(a):
        size = np.abs(a)
        on = size.diagonal().copy()
        np.fill_diagonal(size, 0)
        p, q = divmod(int(size.argmax()), len(a))
        r = int(on.argmax())
        if max(on[r], size[p, q]) == 0:
            break
        out = [r] if on[r] >= _PIVOT * size[p, q] else [p, q]
        block = a[np.ix_(out, out)]
        # A 2x2 pivot has a dominant off-diagonal: one value of either sign.
        above += 1 if len(out) == 2 else int(block[0, 0] > 0)
        rest = np.delete(np.arange(len(a)), out)
        side = a[np.ix_(rest, out)]
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(block, side.T)
    return above


@dataclass
class Slice:
    """The interval (low, high] with the eigenvalues first to last, by falling value."""
    low: float
    high: float
    first: int
    last: int


def slices(v: np.ndarray, wanted: int, width: float) -> list[Slice]:
    """Intervals of one eigenvalue each, or not wider than `width`, with the
    largest `wanted` eigenvalues of a matrix without negative ones."""
    top = float(np.abs(v).sum(1).max())  # Gershgorin
    todo = [Slice(-width, top + width, 1, len(v))]
    done = []
    while todo:
        s = todo.pop()
        if s.first > min(s.last, wanted):
            continue
        if s.first == s.last or s.high - s.low <= width:
            done.append(s)
            continue
        middle = (s.low + s.high) / 2
        above = min(max(count_above(v, middle), s.first - 1), s.last)
        todo += [Slice(s.low, middle, above + 1, s.last), Slice(middle, s.high, s.first, above)]
    return sorted(done, key=lambda s: s.first)


def _solve(v: np.ndarray, shift: float, x: np.ndarray) -> np.ndarray:
    """The direction of (V - shift I)^-1 x."""
    one = np.eye(len(v))
    try:
        y = np.linalg.solve(v - shift * one, x)
    except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
        y = np.linalg.solve(v - (shift + 4 * EPS * np.abs(v).max()) * one, x)
    return y / np.linalg.norm(y)


def _iterate(v: np.ndarray, shift: float, known: list[np.ndarray], seed: int, fixed: int,
             rounds: int) -> tuple[float, np.ndarray, float]:
    """(value, vector, residual) after `fixed` steps at the shift and up to
    `rounds` steps at the Rayleigh quotient, orthogonal to the known vectors."""
    def free(x):
        for _ in range(2):
            for k in known:
                x = x - (k @ x) * k
        return x / np.linalg.norm(x)

    x = free(np.random.default_rng(seed).normal(size=len(v)))
    for _ in range(fixed):
        x = free(_solve(v, shift, x))
    best = None
    for _ in range(rounds + 1):
        value = float(x @ v @ x)
        residual = float(np.linalg.norm(v @ x - value * x))
        if best is not None and residual >= best[2]:
            break
        best = value, x, residual
        x = free(_solve(v, value, x))
    return best


def leading_pairs(v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues by falling value, unit eigenvectors as columns): the first
    `wanted` of a covariance, without those that are zero within rounding."""
    d = len(v)
    scale = float(np.abs(v).sum(1).max()) if d else 0.0
    floor = 8 * d * EPS * scale
    if not scale:
        return np.zeros(0), np.zeros((d, 0))
    wanted = min(wanted, count_above(v, floor))
    width = max(1e-10 * scale, floor)
    values, vectors = [], []
    for s in slices(v, wanted, width):
        if s.first < s.last:  # equal within rounding
            middle, found = (s.low + s.high) / 2, []
            for k in range(s.first, min(s.last, wanted) + 1):
                value, x, _ = _iterate(v, middle, found, k, 4, 0)
                found.append(x)
                values.append(value)
            vectors += found
            continue
        low, high = s.low, s.high
        for attempt in range(64):
            value, x, residual = _iterate(v, (low + high) / 2, [], s.first + attempt * d, 3, 12)
            near = max(16 * residual, floor / 8)
            if (low < value <= high and count_above(v, value - near) >= s.first
                    and count_above(v, value + near) < s.first):
                break
            middle = (low + high) / 2
            if count_above(v, middle) >= s.first:
                low = middle
            else:
                high = middle
        else:
            raise ArithmeticError(f"eigenvalue {s.first} was not certified")
        values.append(value)
        vectors.append(x)
    signed = [x * (1.0 if x[np.abs(x).argmax()] > 0 else -1.0) for x in vectors]
    return np.array(values), np.stack(signed, 1) if signed else np.zeros((d, 0))


# ---- sums over all vectors ------------------------------------------------------

def fixed_point(rows: DataFrame, scale: int = 64, shift: int = 1_000_000, id_col: str = "vec_id",
                vec_col: str = "embedding") -> DataFrame:
    """(vec_id, x): usable vectors with entries floor(scale * c) + shift."""
    entry = lambda c: F.floor(c.cast("double") * scale)
    usable = F.forall(vec_col, lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                      & (F.abs(c.cast("double")) < float(1 << 56)))
    return (rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col))
            .where(F.col(vec_col).isNotNull() & usable)
            .select("vec_id", F.transform(vec_col, lambda c: entry(c) + F.lit(shift)).alias("x")))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _sums(batches):
    """Of each length of vectors: their number and the sums of each entry, in
    an upper and a lower part that cannot overflow."""
    held: dict[int, list] = {}
    for batch in batches:
        sizes = batch.column("x").value_lengths().to_numpy(zero_copy_only=False)
        for d in np.unique(sizes[sizes > 0]):
            x = _matrix(batch.column("x").filter(pa.array(sizes == d)), int(d))
            total = held.setdefault(int(d), [0, np.zeros(d, np.int64), np.zeros(d, np.int64)])
            total[0] += len(x)
            total[1] += (x >> 31).sum(0)
            total[2] += (x & ((1 << 31) - 1)).sum(0)
    for d, (n, high, low) in held.items():
        yield pa.RecordBatch.from_pydict({
            "size": np.full(d, d, np.int64), "dimension": np.arange(d), "n": np.full(d, n), "high": high, "low": low})


@dataclass
class Centre:
    """Number, whole sums S and mean of the vectors, the mean as whole + part."""
    n: int
    sums: list[int]

    def __post_init__(self):
        self.whole = np.array([round(s / self.n) for s in self.sums], np.int64) if self.n else np.zeros(0, np.int64)
        self.rest = [s - self.n * int(m) for s, m in zip(self.sums, self.whole)]
        self.part = np.array([r / self.n for r in self.rest])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(float) - self.part

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n x - S)^2, exact; None beyond 64 bits."""
        y = x - self.whole
        most = self.n * int(np.abs(y).max(initial=0)) + max(map(abs, self.rest), default=0)
        if most * most * len(self.sums) < 1 << 62:
            return ((self.n * y - np.array(self.rest, np.int64)) ** 2).sum(1).tolist()
        exact = ((self.n * y.astype(object) - np.array(self.rest, object)) ** 2).sum(1)
        return [int(v) if v < 1 << 63 else None for v in exact]


def centre(vectors: DataFrame) -> Centre:
    """The sums of the vectors of the commonest length (ties: the longer)."""
    whole = "decimal(38,0)"
    sums = staged(vectors.select("x").mapInArrow(_sums, "size long, dimension long, n long, high long, low long")
                  .groupBy("size", "dimension").agg(F.sum("n").alias("n"), F.sum(F.col("high").cast(whole)).alias("high"),
                                                    F.sum(F.col("low").cast(whole)).alias("low")), "sums")
    most = sums.where("dimension = 0").orderBy(F.desc("n"), F.desc("size")).first()
    if most is None:
        return Centre(0, [])
    rows = sums.where(F.col("size") == most["size"]).orderBy("dimension").collect()
    return Centre(most["n"], [(int(r["high"]) << 31) + int(r["low"]) for r in rows])


def covariance(vectors: DataFrame, c: Centre, projection: np.ndarray | None = None) -> np.ndarray:
    """Of the centred vectors, or of their projections; divisor n.  (The mean
    of the projections is the projected mean of the centred vectors: zero.)"""
    d = len(c.sums) if projection is None else projection.shape[1]
    i, j = np.triu_indices(d)

    def run(batches):
        total = np.zeros((d, d))
        for batch in batches:
            y = c.centred(_matrix(batch.column("x"), len(c.sums)))
            y = y if projection is None else y @ projection
            total += y.T @ y
        yield pa.RecordBatch.from_pydict({"i": i, "j": j, "v": total[i, j]})

    cells = (vectors.select("x").where(F.size("x") == len(c.sums)).mapInArrow(run, "i long, j long, v double")
             .groupBy("i", "j").agg(F.sum("v").alias("v")).collect())
    out = np.zeros((d, d))
    for r in cells:
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"] / c.n
    return out


# ---- the operator -----------------------------------------------------------------

@dataclass
class Whitening:
    centre: Centre
    values: np.ndarray      # eigenvalues by falling value
    vectors: np.ndarray     # unit eigenvectors as columns
    trace: float

    @property
    def projection(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening:
    """The leading components of the vectors (vec_id, x)."""
    prepare(vectors.sparkSession)
    c = centre(vectors)
    v = covariance(vectors, c) if c.n else np.zeros((0, 0))
    values, x = leading_pairs(v, components)
    return Whitening(c, values, x, float(np.trace(v)))


SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Per vector and component: see SCHEMA."""
    w = fit(vectors, components)
    k = len(w.values)
    if not k:
        return vectors.sparkSession.createDataFrame([], SCHEMA)
    error = float(np.abs(covariance(vectors, w.centre, w.projection) - np.eye(k)).max())
    explained = w.values / w.trace

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column("x"), len(w.centre.sums))
            rows = len(x)
            deviation = pa.array(w.centre.deviations(x), pa.int64())
            each = np.repeat(np.arange(rows), k)
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column("vec_id").take(pa.array(each)),
                "component": np.tile(np.arange(1, k + 1, dtype=np.int32), rows),
                "n": np.full(rows * k, w.centre.n), "deviation": deviation.take(pa.array(each)),
                "whitened": (w.centre.centred(x) @ w.projection).reshape(-1),
                "explained": np.tile(explained, rows), "identity_error": np.full(rows * k, error)})

    return vectors.where(F.size("x") == len(w.centre.sums)).mapInArrow(run, SCHEMA)
