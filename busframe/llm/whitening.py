"""Whitening of vectors by principal components, with the covariance from variances alone (polarisation).

For numbers p and q, var(p + q) - var(p) - var(q) is twice their covariance. So the only sums over the rows are of squares:
of each centred dimension and of each centred sum of two dimensions. All are whole numbers and exact at any size: a task
sums in machine integers where no sum can overflow, else in Python's, and its sums travel as limbs of 32 bits that Spark
adds. Centring is at the rounded mean, and what rounding leaves is put right exactly before anything is divided. The
driver sees d * (d + 1) / 2 sums for vectors of d components, whatever the number of rows, and takes the eigenvectors.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from busframe.llm.common import Scratch, lean, need

#: Components of a vector, and different numbers of components in one table, at most: the driver holds the square of the one for each of the other.
MOST_WIDTH, MOST_WIDTHS = 4096, 16
_LIMBS = 8
_SUMS = "width int, i int, j int, " + ", ".join(f"l{k} long" for k in range(_LIMBS))
_BLOCK = 8192


def scaled_vectors(vectors: DataFrame, scale: int, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x: array<long> floor(scale * c)) of the vectors that are neither null nor hold null or non-finite components."""
    need(vectors, id_col, vector_col)
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).where("v is not null").where(~bad)
    return rows.select("vec_id", F.transform("v", lambda c: F.floor(c * F.lit(float(scale)))).alias("x"))


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(width, row numbers, int64 matrix) for each number of components in a batch's last column, at most _BLOCK rows at once."""
    lists = batch.column(batch.num_columns - 1)
    offsets, flat = np.asarray(lists.offsets), np.asarray(lists.values, "int64")
    widths = np.diff(offsets)
    for d in np.unique(widths):
        at = np.flatnonzero(widths == d)
        for k in range(0, len(at), _BLOCK):
            rows = at[k : k + _BLOCK]
            yield int(d), rows, flat[offsets[rows][:, None] + np.arange(d)]


def _safe(x: np.ndarray, bound: int) -> np.ndarray:
    """x in machine integers, or in Python's if `bound`, which no intermediate value passes, doesn't fit."""
    return x if bound < 1 << 63 else x.astype(object)


def _most(x: np.ndarray) -> int:
    return max(int(x.max(initial=0)), -int(x.min(initial=0)))


def centred(x: np.ndarray, middle: list[int]) -> np.ndarray:
    m = np.array(middle, object)
    bound = _most(x) + max((abs(v) for v in middle), default=0)
    return _safe(x, bound) - (m if bound >= 1 << 63 else m.astype("int64"))


def squares(y: np.ndarray) -> np.ndarray:
    """Matrix of exact sums over the rows: of y_i ** 2 on the diagonal, of (y_i + y_j) ** 2 above it."""
    d = y.shape[1]
    most = max((abs(int(v)) for v in (y.max(initial=0), y.min(initial=0))), default=0)
    y = _safe(y, 4 * most * most * max(1, len(y)))
    out = np.zeros((d, d), object)
    for i in range(d):
        out[i, i] = int((y[:, i] * y[:, i]).sum())
        pair = y[:, i + 1 :] + y[:, i : i + 1]
        out[i, i + 1 :] = (pair * pair).sum(0)
    return out


def _limbs(v: int) -> list[int]:
    out = []
    for _ in range(_LIMBS - 1):
        out.append(v & 0xFFFFFFFF)
        v >>= 32
    return [*out, v]


def _whole(row) -> int:
    return sum(row[f"l{k}"] << 32 * k for k in range(_LIMBS))


def _summed(middle=None):
    """mapInArrow over x. Without a middle: rows (i = -1) and sums of each component; with one, sums of squares."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, _, x in _blocks(batch):
                if middle is None:
                    part = np.array([len(x), *_safe(x, _most(x) * len(x)).sum(0)], object)
                else:
                    part = squares(centred(x, middle.value[d]))
                total[d] = total[d] + part if d in total else part
        rows = []
        for d, t in total.items():
            if middle is None:
                rows += [(d, i - 1, i - 1, *_limbs(int(v))) for i, v in enumerate(t)]
            else:
                rows += [(d, i, j, *_limbs(int(t[i, j]))) for i in range(d) for j in range(i, d)]
        if rows:
            names = [f.split()[0] for f in _SUMS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if k < 3 else pa.int64()) for k, c in enumerate(zip(*rows, strict=True))], names=names)

    return run


def _gathered(xs: DataFrame, middle=None) -> dict[int, dict[tuple[int, int], int]]:
    sums = xs.mapInArrow(lean(_summed(middle)), _SUMS).groupBy("width", "i", "j").agg(*[F.sum(f"l{k}").alias(f"l{k}") for k in range(_LIMBS)])
    out: dict[int, dict[tuple[int, int], int]] = {}
    for r in sums.collect():
        out.setdefault(r["width"], {})[r["i"], r["j"]] = _whole(r)
    return out


@dataclass
class Fit:
    """What whitens vectors of one number of components. mean is sums / n; axes has a unit eigenvector a row."""

    n: int
    sums: list[int]
    values: np.ndarray
    axes: np.ndarray
    trace: float
    identity_error: float | None = None

    @property
    def middle(self) -> list[int]:
        return [(2 * s + self.n) // (2 * self.n) for s in self.sums]


def fit_sums(n: int, sums: list[int], middle: list[int], of_squares: dict[tuple[int, int], int]) -> Fit:
    """Eigenvectors by falling eigenvalue, from exact sums. An eigenvalue within rounding of 0 is 0; each axis's entry of largest size is positive."""
    d, left = len(sums), [s - n * m for s, m in zip(sums, middle, strict=True)]
    one = [n * of_squares[i, i] - left[i] ** 2 for i in range(d)]
    v = np.zeros((d, d))
    for i in range(d):
        v[i, i] = one[i] / n**2
        for j in range(i + 1, d):
            two = n * of_squares[i, j] - (left[i] + left[j]) ** 2
            v[i, j] = v[j, i] = (two - one[i] - one[j]) / (2 * n**2)
    e, axes = np.linalg.eigh(v)
    e, axes = e[::-1], axes.T[::-1]
    e = np.where(e <= d * np.finfo(float).eps * e.max(initial=0), 0.0, e)
    top = np.abs(axes).argmax(1) if d else np.zeros(0, int)
    return Fit(n, sums, e, axes * np.where(axes[np.arange(d), top] < 0, -1.0, 1.0)[:, None], sum(one) / n**2)


def fit(xs: DataFrame) -> dict[int, Fit]:
    """A Fit for each number of components among the rows' arrays x; each row counts once."""
    widths = [r[0] for r in xs.select(F.size("x").alias("d")).distinct().limit(MOST_WIDTHS + 1).collect()]
    if len(widths) > MOST_WIDTHS or max(widths, default=0) > MOST_WIDTH:
        raise ValueError(f"over {MOST_WIDTHS} different numbers of components, or over {MOST_WIDTH} components")
    first = {d: (s[-1, -1], [s[i, i] for i in range(d)]) for d, s in _gathered(xs).items()}
    middle = {d: Fit(n, sums, None, None, 0.0).middle for d, (n, sums) in first.items()}
    second = _gathered(xs, xs.sparkSession.sparkContext.broadcast(middle))
    return {d: fit_sums(n, sums, middle[d], second.get(d, {})) for d, (n, sums) in first.items()}


def project(x: np.ndarray, f: Fit, k: int) -> np.ndarray:
    """Rows by their first k whitened components; NaN for a component without variance."""
    y = centred(x, f.middle).astype("f8")
    y -= [(s - f.n * m) / f.n for s, m in zip(f.sums, f.middle, strict=True)]
    with np.errstate(divide="ignore", invalid="ignore"):
        out = y @ f.axes[:k].T / np.sqrt(f.values[:k])
    out[:, f.values[:k] <= 0] = np.nan
    return out


def _products(fits, k: int):
    """mapInArrow over x: sums (j = -1) of whitened components and of their products."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int, int], float] = {}
        for batch in batches:
            for d, _, x in _blocks(batch):
                w = project(x, fits.value[d], k)
                for i in range(w.shape[1]):
                    total[d, i, -1] = total.get((d, i, -1), 0.0) + math.fsum(w[:, i])
                    for j in range(i, w.shape[1]):
                        total[d, i, j] = total.get((d, i, j), 0.0) + math.fsum(w[:, i] * w[:, j])
        if total:
            keys = list(zip(*total, strict=True))
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int32()) for c in keys], pa.array(list(total.values()), pa.float64())], names=["width", "i", "j", "s"])

    return run


def identity_errors(xs: DataFrame, fits: dict[int, Fit], k: int) -> dict[int, float | None]:
    """For each number of components: the largest difference of the whitened components' covariance from the identity; None where none varies."""
    known = xs.sparkSession.sparkContext.broadcast(fits)
    sums: dict[int, dict[tuple[int, int], float]] = {}
    for r in xs.mapInArrow(lean(_products(known, k)), "width int, i int, j int, s double").groupBy("width", "i", "j").agg(F.sum("s").alias("s")).collect():
        sums.setdefault(r["width"], {})[r["i"], r["j"]] = r["s"]
    out = {}
    for d, f in fits.items():
        s, varies = sums.get(d, {}), [i for i in range(min(k, d)) if f.values[i] > 0]
        off = [abs(s[i, j] / f.n - s[i, -1] / f.n * (s[j, -1] / f.n) - (i == j)) for i in varies for j in varies if i <= j]
        out[d] = max(off, default=None)
    return out


_OUT = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def _decimals(far: np.ndarray) -> pa.Array:
    if far.dtype == object:
        return pa.array([decimal.Decimal(v) if v < 10**38 else None for v in far], pa.decimal128(38, 0))
    return pa.array(far).cast(pa.decimal128(38, 0))


def _applied(fits, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, rows, x in _blocks(batch):
                f = fits.value[d]
                m, w = min(k, d), project(x, f, k)
                if not m:
                    continue
                y, left = centred(x, f.middle), [s - f.n * c for s, c in zip(f.sums, f.middle, strict=True)]
                most = f.n * max(abs(int(y.max())), abs(int(y.min()))) + max(abs(v) for v in left)
                far = _safe(y, d * most * most) * f.n - np.array(left, object if d * most * most >= 1 << 63 else "int64")
                cells = [batch.column(0).take(pa.array(rows.repeat(m))), pa.array(np.tile(np.arange(1, m + 1, dtype="i4"), len(rows))), pa.array(np.full(len(rows) * m, f.n, "int64"))]
                cells.append(_decimals((far * far).sum(1)).take(pa.array(np.arange(len(rows)).repeat(m))))
                share = f.values[:m] / f.trace if f.trace else np.zeros(m)
                cells += [pa.array(w.ravel(), from_pandas=True), pa.array(np.tile(share, len(rows))), pa.array([f.identity_error] * (len(rows) * m), pa.float64())]
                yield pa.RecordBatch.from_arrays(cells, names=[c.split()[0] for c in _OUT.split(", ")])

    return run


def whiten(vectors: DataFrame, k: int = 4, *, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Whitened components of vectors: vec_id, component (from 1), n, deviation, whitened, explained, identity_error.

    Components c become x = floor(scale * c) (at the ends of the long range where it doesn't fit). The fit is over each distinct
    x vector once, n of them; deviation (decimal(38), null where it doesn't fit) is the exact sum over dimensions of
    (n * x - S) ** 2 with S the fit's sums; explained is a component's share of the variance; identity_error is how far the
    whitened components' covariance lies from the identity, one value for the fit.

    A row is returned with min(k, its number of components) components; a component without variance has whitened null and
    explained 0. Vectors that are null or hold null or non-finite components take no part; empty ones have no component.
    Vectors of another number of components have a fit of their own. Repeated rows and ids, and null ids, are returned as
    often as they are there; other columns are ignored; an empty table gives no rows. Over MOST_WIDTH components or
    MOST_WIDTHS different numbers of them raise ValueError.
    """
    scratch = Scratch(vectors.sparkSession, "whitening")
    rows = scaled_vectors(vectors, scale, id_col=id_col, vector_col=vector_col)
    xs = scratch.write(rows.select("x").distinct(), "distinct")
    fits = fit(xs)
    for d, error in identity_errors(xs, fits, k).items():
        fits[d].identity_error = error
    scratch.drop("distinct")
    return rows.mapInArrow(lean(_applied(vectors.sparkSession.sparkContext.broadcast(fits), k)), _OUT)
