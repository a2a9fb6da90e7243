"""Embedding whitening (operator 11) by Chebyshev-filtered subspace iteration.

Each entry ``c`` becomes the integer ``x = floor(64 * c) + 1000000``.  The fit list holds
every distinct integer vector once (a distributed ``distinct``, written to the shared
folder); its covariance is never formed.  What is needed of it is ``V Q`` for a few
columns ``Q``: one pass over the fit list, in which every task sends the sums of
``x_c (x_c' Q)`` over its rows (``x_c`` is centred first), added up by Spark into one row
per dimension.

The iteration:

1. A few Lanczos steps bound the spectrum.
2. A block of columns, twice the number of components, goes through a Chebyshev recurrence
   that damps the unwanted part of the spectrum (from the lower bound to the block's
   smallest Ritz value) and lets everything above it grow, one pass a degree.
3. QR, then Rayleigh-Ritz: the block's best eigenpairs and their residuals.
4. Repeat until the residuals are at rounding level.  The certificate is a last round whose
   spare columns are fresh random ones: had a leading direction been missed, it would
   rise in them.

Where the spectrum is so flat that the residuals hardly fall, the block is doubled; a block
of all dimensions is exact, so the loop always ends.  A table of few dimensions starts there.

Passes: the driver holds ``dimensions x block`` numbers, each task its batch and the same.

Rows whose vector is null or holds null, NaN or infinite entries take no part.  Vectors have
the length that most distinct vectors have (ties: the longer); others take no part either.
An empty table, or one without spread, has no components and gives no rows.  Components whose
eigenvalue is below ``1e-11`` of the first have no direction and are left out.  Repeated rows
and ids are all returned; a null id stays null.  A squared deviation beyond a long is null.
Entries that leave the range of exact integers (``|64 c| >= 2**52``) fail the job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import materialize

COMPONENTS = 16
SCALE = 64
SHIFT = 1_000_000
LANCZOS_STEPS = 12
#: residuals, as a share of the largest eigenvalue, that start the certifying round
TOLERANCE = 1e-13
#: eigenvalues below this share of the largest are rounding noise
NO_DIRECTION = 1e-11
_SPLIT = 31  # bits of the low half of an entry, so that a task's sums stay exact
_LONG = 2 ** 63


def _integers(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(rows, values, bounds)``: the usable rows of a list column and their integer entries, end to end."""
    sizes = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(lists), 0)).astype(np.int64)
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    flat = lists.flatten()
    values = np.asarray(flat.cast(pa.float64()).fill_null(np.nan)) if len(flat) else np.empty(0)
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
    good = (bad[bounds[1:]] == bad[bounds[:-1]]) & np.asarray(lists.is_valid())
    keep = np.repeat(good, sizes)
    scaled = np.floor(SCALE * values[keep])
    if len(scaled) and np.abs(scaled).max() >= 2.0 ** 52:
        raise OverflowError("an entry is too large for exact integers")
    rows = np.flatnonzero(good)
    return rows, scaled.astype(np.int64) + SHIFT, np.concatenate(([0], np.cumsum(sizes[rows])))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Packed vectors as a matrix of longs."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<i8").reshape(-1, dim)


def fit_list(vectors: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """Every distinct integer vector once, as ``x binary`` (little-endian longs), in the shared folder."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, values, bounds = _integers(b.column(0))
            data = values.astype("<i8").tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([data[8 * lo:8 * hi] for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)],
                          pa.binary())], ["x"])

    packed = vectors.select(F.col(f"`{vector_col}`").alias("v")).mapInArrow(pack, "x binary")
    return materialize(packed.distinct(), "whitening-fit")


class Centre:
    """Exact per-dimension sums ``S`` of ``n`` vectors, and differences from their mean."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.floor = np.array([s // n for s in sums], dtype=np.int64)
        self.rest = np.array([s % n for s in sums], dtype=np.int64)  # S = n * floor + rest

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - S / n`` in double precision: the integer part of the mean is taken off exactly."""
        return (x - self.floor).astype(np.float64) - self.rest / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """The sum over dimensions of ``(n x - S)**2``, exact; None beyond a long."""
        if not len(x):
            return []
        size = (self.centred(x) * float(self.n)) ** 2
        total = size.sum(axis=1)
        out: list[int | None] = [None] * len(x)
        small = np.flatnonzero(total < 0.99 * _LONG)
        d = (x[small] - self.floor) * self.n - self.rest
        for i, v in zip(small.tolist(), (d * d).sum(axis=1).tolist(), strict=True):
            out[i] = v
        for i in np.flatnonzero((total >= 0.99 * _LONG) & (total <= 1.01 * _LONG)).tolist():
            exact = sum(((a - f) * self.n - r) ** 2 for a, f, r in
                        zip(x[i].tolist(), self.floor.tolist(), self.rest.tolist(), strict=True))
            out[i] = exact if exact < _LONG else None
        return out


def centre_of(fit: DataFrame, dim: int) -> Centre:
    """Count and exact sums of the fit list: each task sends one row per dimension."""
    mask = (1 << _SPLIT) - 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(dim, np.int64), np.zeros(dim, np.int64)
        for b in batches:
            x = _matrix(b.column(0), dim)
            n += len(x)
            high += (x >> _SPLIT).sum(axis=0)
            low += (x & mask).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), pa.array(np.full(dim, n)),
                                              pa.array(high), pa.array(low)], ["i", "n", "high", "low"])

    rows = (fit.mapInArrow(sums, "i int, n long, high long, low long").groupBy("i")
            .agg(F.sum("n").alias("n"), F.sum(F.col("high").cast("decimal(38,0)")).alias("high"),
                 F.sum(F.col("low").cast("decimal(38,0)")).alias("low")).orderBy("i").collect())
    return Centre(rows[0].n, [(int(r.high) << _SPLIT) + int(r.low) for r in rows])


def _summed(fit: DataFrame, dim: int, height: int, width: int,
            part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over the fit list of ``part(matrix of rows)``, a ``height x width`` array."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                got = part(_matrix(b.column(0), dim))
                total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(height, dtype=np.int32)),
                                              *(pa.array(total[:, j]) for j in range(width))],
                                             ["i", *(f"y{j}" for j in range(width))])

    schema = "i int, " + ", ".join(f"y{j} double" for j in range(width))
    rows = (fit.mapInArrow(sums, schema).groupBy("i")
            .agg(*(F.sum(f"y{j}").alias(f"y{j}") for j in range(width))).collect())
    out = np.zeros((height, width))
    for r in rows:
        out[r[0]] = r[1:]
    return out


def covariance_times(fit: DataFrame, centre: Centre, q: np.ndarray) -> np.ndarray:
    """``V Q`` by one pass over the fit list."""

    def part(x: np.ndarray) -> np.ndarray:
        c = centre.centred(x)
        return c.T @ (c @ q)

    return _summed(fit, len(centre.floor), *q.shape, part) / centre.n


def total_variance(fit: DataFrame, centre: Centre) -> float:
    def part(x: np.ndarray) -> np.ndarray:
        return np.array([[np.square(centre.centred(x)).sum()]])

    return float(_summed(fit, len(centre.floor), 1, 1, part)[0, 0]) / centre.n


def _lower_bound(times: Callable[[np.ndarray], np.ndarray], dim: int, steps: int, rng: np.random.Generator) -> float:
    """What the smallest eigenvalue hardly falls below: the least Ritz value of some Lanczos steps less their last link."""
    basis = [rng.standard_normal(dim)]
    basis[0] /= np.linalg.norm(basis[0])
    diagonal, links = [], []
    for _ in range(min(steps, dim)):
        w = times(basis[-1][:, None])[:, 0]
        diagonal.append(float(w @ basis[-1]))
        for _ in range(2):
            for v in basis:
                w = w - (w @ v) * v
        links.append(float(np.linalg.norm(w)))
        if links[-1] <= 1e-12 * max(diagonal):
            break
        basis.append(w / links[-1])
    k = len(diagonal)
    tri = np.diag(diagonal) + np.diag(links[:k - 1], 1) + np.diag(links[:k - 1], -1)
    return max(0.0, float(np.linalg.eigvalsh(tri)[0]) - links[-1])


def _filtered(times: Callable[[np.ndarray], np.ndarray], x: np.ndarray, vx: np.ndarray, degree: int, low: float,
              cut: float, top: float) -> np.ndarray:
    """A scaled Chebyshev polynomial of V of this degree, at most 1 on ``[low, cut]``, times ``x``; ``vx`` is ``V x``."""
    half, middle = (cut - low) / 2, (cut + low) / 2
    sigma = half / (top - middle)
    first = sigma
    before, now = x, (vx - middle * x) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        before, now = now, 2 * (after / half) * (times(now) - middle * now) - (sigma * after) * before
        sigma = after
    return now


def _degree(values: np.ndarray, wanted: int, low: float, cut: float) -> int:
    """So many steps that the first direction outgrows the last wanted one by no more than rounding can bear."""
    half, middle = (cut - low) / 2, (cut + low) / 2
    growth = np.arccosh(np.maximum((values[[0, wanted - 1]] - middle) / half, 1.0))
    return int(np.clip(np.log(1e8) / max(growth[0] - growth[1], 1e-3), 3, 12))


def leading_pairs(times: Callable[[np.ndarray], np.ndarray], dim: int, wanted: int, *,
                  tolerance: float = TOLERANCE, seed: int = 11) -> tuple[np.ndarray, np.ndarray, dict]:
    """The ``wanted`` largest eigenvalues and their eigenvectors of the matrix behind ``times``, with a report."""
    rng = np.random.default_rng(seed)
    report = {"passes": 0, "rounds": 0, "block": min(dim, 2 * wanted), "residual": 0.0}

    def counted(q: np.ndarray) -> np.ndarray:
        report["passes"] += 1
        return times(q)

    def ritz(q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        vq = counted(q)
        h = q.T @ vq
        values, turn = np.linalg.eigh((h + h.T) / 2)
        turn = turn[:, ::-1]
        return values[::-1], q @ turn, vq @ turn

    block = report["block"]
    if block == dim:
        values, x, vx = ritz(np.eye(dim))
        report["residual"] = _residual(values, x, vx, wanted)
        return values[:wanted], x[:, :wanted], report
    low = _lower_bound(counted, dim, LANCZOS_STEPS, rng)
    values, x, vx = ritz(np.linalg.qr(rng.standard_normal((dim, block)))[0])
    residual, certifying = _residual(values, x, vx, wanted), False
    while True:
        if values[0] <= 0:
            return values[:wanted], x[:, :wanted], report
        if certifying and residual <= tolerance * values[0]:
            break
        certifying = residual <= tolerance * values[0]
        low = min(low, max(0.0, 2 * values[-1] - values[-2]))  # the block has seen what lies lower
        cut = max(values[-1], low + 1e-6 * (values[0] - low))
        if cut >= values[0]:
            cut = (low + values[0]) / 2
        degree = _degree(values, wanted, low, cut)
        if certifying:  # spare columns afresh: a direction that was missed would rise in them
            x = np.hstack((x[:, :wanted], rng.standard_normal((dim, block - wanted))))
            vx = counted(x)
        grown = _filtered(counted, x, vx, degree, low, cut, values[0])
        old, tops = residual, values[:wanted]
        values, x, vx = ritz(np.linalg.qr(grown / np.linalg.norm(grown, axis=0))[0])
        residual = _residual(values, x, vx, wanted)
        report["rounds"] += 1
        if certifying and np.any(np.abs(values[:wanted] - tops) > 1e3 * tolerance * values[0]):
            certifying = False  # something rose: go on with it
        rate = (residual / old) ** (1 / degree) if old else 0.0
        left = np.log(max(residual, 1e-300) / (tolerance * max(values[0], 1e-300)))
        if report["rounds"] > 2 and left > 0 and (rate >= 1 or left / -np.log(max(rate, 1e-9)) > 300):
            block = min(dim, 2 * block)
            q = np.linalg.qr(np.hstack((x, rng.standard_normal((dim, block - x.shape[1])))))[0]
            values, x, vx = ritz(q)
            residual = _residual(values, x, vx, wanted)
            report["block"] = block
            if block == dim:
                break
    report["residual"] = residual
    return values[:wanted], x[:, :wanted], report


def _residual(values: np.ndarray, x: np.ndarray, vx: np.ndarray, wanted: int) -> float:
    return float(np.linalg.norm(vx[:, :wanted] - x[:, :wanted] * values[:wanted], axis=0).max())


class Whitening:
    """A fitted transform: centre, directions (columns), eigenvalues and their certificate."""

    def __init__(self, centre: Centre, values: np.ndarray, directions: np.ndarray, trace: float,
                 identity_error: float, report: dict):
        self.centre, self.values, self.directions = centre, values, directions
        self.trace, self.identity_error, self.report = trace, identity_error, report

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (self.centre.centred(x) @ self.directions) / np.sqrt(self.values)


def fit(vectors: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Learn the transform; None where the table has no usable vector or no spread."""
    distinct = fit_list(vectors, vector_col)
    lengths = distinct.groupBy(F.length("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if lengths is None or lengths["size"] == 0:
        return None
    dim = lengths["size"] // 8
    rows = distinct.where(F.length("x") == lengths["size"])
    centre = centre_of(rows, dim)
    trace = total_variance(rows, centre)
    if trace <= 0:
        return None
    values, directions, report = leading_pairs(lambda q: covariance_times(rows, centre, q), dim, min(components, dim))
    real = values > NO_DIRECTION * values[0]
    model = Whitening(centre, values[real], directions[:, real], trace, 0.0, report)

    def part(x: np.ndarray) -> np.ndarray:
        w = model.whitened(x)
        return np.hstack((w.T @ w, w.sum(axis=0)[:, None]))

    k = len(model.values)
    sums = _summed(rows, dim, k, k + 1, part) / centre.n
    covariance = sums[:, :k] - np.outer(sums[:, k], sums[:, k])  # the means are zero but for rounding
    model.identity_error = float(np.abs(covariance - np.eye(k)).max())
    return model


_OUT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
        "identity_error double")


def transform(vectors: DataFrame, model: Whitening | None, id_col: str = "vec_id",
              vector_col: str = "embedding") -> DataFrame:
    """One row per usable vector and component."""
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").alias("v"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dim = len(model.values), len(model.centre.floor)
        explained = model.values / model.trace
        for whole in batches:
            for lo in range(0, whole.num_rows, 4096):
                b = whole.slice(lo, 4096)
                at, values, bounds = _integers(b.column(1))
                fits = np.diff(bounds) == dim
                x = values[np.repeat(fits, np.diff(bounds))].reshape(-1, dim)
                at = at[fits]
                n = len(at)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(np.repeat(at, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                     pa.array(np.full(n * k, model.centre.n)),
                     pa.array(model.centre.deviation(x), pa.int64()).take(pa.array(np.repeat(np.arange(n), k))),
                     pa.array(model.whitened(x).ravel()), pa.array(np.tile(explained, n)),
                     pa.array(np.full(n * k, model.identity_error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    if model is None:
        return rows.sparkSession.createDataFrame([], _OUT)
    return rows.mapInArrow(apply, _OUT)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """Fit on all distinct vectors and transform every row."""
    return transform(vectors, fit(vectors, vector_col, components), id_col, vector_col)
