"""Whitening of embeddings by shifted CholeskyQR.

Entries become whole numbers, x = floor(64 * c) + 1000000.  The fit list holds each distinct x
vector once; its rows, centred, are the matrix A.  A row is centred by whole numbers first
(n * x - S, with the sums S per dimension), so the large offset costs no digit.

Each pass over the fit list forms the Gram matrix of Q = A * inverse(R), task by task, and sums
the tasks' matrices by entry.  Its Cholesky factor, after a small shift in the first pass (and
where a factor does not exist), is multiplied onto R by triangular solves.  Two or three passes
bring the Gram matrix of Q to the identity, or to a projection if the rows span fewer
dimensions.  What is left of that Gram matrix, G, makes B = sqrt(G) * R, which has A's singular
values and right singular vectors: the SVD of this small matrix gives the components.  Squaring
A once and taking eigenvectors would lose half of the digits; the passes keep them.

The driver holds matrices of dimensions by dimensions only.  Rows stay in their partitions but
for one shuffle that finds the distinct vectors, in which every task drops its own repeats first.

Defined results: null vectors, and those with null, NaN or infinite entries, are dropped, and so
are vectors whose 64-fold entries pass 2**52, beyond which doubles are no whole numbers.  Vectors
are of one length: that of most usable rows, the larger one of equally many; rows of other
lengths, and empty ones, are dropped.  Repeated rows and null ids are returned like others.
Components whose standard deviation is under RANK times the largest are none, so equal vectors
only give no row; neither do empty tables.  `deviation` is null where it passes a long.  Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marketweave.session import shared_dir, stage

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
RANK = 1e-10  # standard deviations below this share of the largest one are rounding
CLOSE = 1e-12  # distance of a Gram matrix from a projection that ends the passes
PASSES = 8
_BLOCK = 8192  # rows that numpy handles at a time
_EPS = np.finfo(np.float64).eps / 2


def quantized(table: DataFrame, vector: str) -> DataFrame:
    """All columns of the usable rows, and `_x`, the whole numbers of `vector`."""
    entries = F.transform(F.col(vector), lambda c: c.cast("double") * SCALE)
    usable = F.forall(entries, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) <= 2.0**52), F.lit(False)))
    kept = table.filter(F.col(vector).isNotNull() & (F.size(vector) > 0) & usable)
    return kept.withColumn("_x", F.transform(entries, lambda v: F.floor(v) + OFFSET))


def _rows(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _blocks(batches, size: int):
    for batch in batches:
        x = _rows(batch.column("_x"), size)
        for at in range(0, len(x), _BLOCK):
            yield x[at : at + _BLOCK]


def _summed(fit: DataFrame, of, size: int, width: int) -> np.ndarray:
    """The sum over all rows of a matrix that `of` makes of a block of them; `width` columns.

    A task adds up its own rows and returns one matrix; entries are then added across tasks, so
    that what is gathered is the one matrix.
    """

    def task(batches):
        total = None
        for x in _blocks(batches, size):
            part = of(x)
            total = part if total is None else total + part
        if total is not None:
            values = total.reshape(-1)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values, pa.float64())], ["i", "v"])

    parts = fit.select("_x").mapInArrow(task, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(size * width)
    for row in parts:
        out[row["i"]] = row["v"]
    return out.reshape(size, width)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S / n: the whole number n * x - S is exact in 64 bits, or in doubles to the last digit."""
    if float(n) * float(np.abs(x).max(initial=0)) < 2.0**62:
        return (n * x - sums) / n
    mean = sums // n
    return (x - mean) - (sums - mean * n) / n


def _gram(x: np.ndarray, n: int, sums: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    q = _solved(_centred(x, n, sums), factors)
    return q.T @ q


def _solved(a: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """a * inverse(R) for each upper triangular R in turn, by substitution."""
    for r in factors:
        q = np.empty_like(a)
        for j in range(len(r)):
            q[:, j] = (a[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
        a = q
    return a


def _cholesky(g: np.ndarray, shift: float) -> np.ndarray:
    """The upper triangular factor of g, shifted by as much as it takes."""
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(len(g))).T
        except np.linalg.LinAlgError:
            shift = max(shift * 10, _EPS * max(np.trace(g), 1e-300))


def fit_components(fit: DataFrame, n: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Components (columns), their eigenvalues, and the trace of the covariance of the fit list."""
    size = len(sums)
    factors: list[np.ndarray] = []
    whole, trace = np.eye(size), 0.0
    for turn in range(PASSES):
        g = _summed(fit, partial(_gram, n=n, sums=sums, factors=factors), size, size)
        g = (g + g.T) / 2
        if not turn:
            trace = float(np.trace(g)) / n
            if not trace > 0:
                return np.zeros((size, 0)), np.zeros(0), 0.0
        elif np.abs(g @ g - g).max() <= CLOSE * max(1.0, np.sqrt(n) / 1000):
            break
        if turn == PASSES - 1:
            break
        shift = 11 * (n * size + size * (size + 1)) * _EPS * float(np.linalg.norm(g, 2)) if not turn else 0.0
        r = _cholesky(g, min(shift, float(np.trace(g)) * 1e-6))
        factors.append(r)
        whole = r @ whole
    value, vector = np.linalg.eigh(g)
    half = np.sqrt(np.maximum(value, 0))[:, None] * vector.T
    _, sigma, right = np.linalg.svd(half @ whole)
    kept = sigma > RANK * sigma[0]
    parts = right[kept].T
    # Either sign would do; the largest entry of each component is positive.
    parts = parts * np.sign(parts[np.abs(parts).argmax(axis=0), np.arange(parts.shape[1])])
    return parts, sigma[kept] ** 2 / n, trace


def _identity(x: np.ndarray, n: int, sums: np.ndarray, turn: np.ndarray) -> np.ndarray:
    w = np.zeros((len(x), len(sums)))
    w[:, : turn.shape[1]] = _centred(x, n, sums) @ turn
    return w.T @ w / n


def _deviation(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    if float(n) * float(np.abs(x).max(initial=0)) < 2.0**62:
        gap = n * x - sums
        if float(np.abs(gap).max(initial=0)) ** 2 * x.shape[1] < 2.0**62:
            return (gap * gap).sum(axis=1).tolist()
    each = [sum((n * v - s) ** 2 for v, s in zip(row, sums.tolist())) for row in x.tolist()]
    return [d if d < 2**63 else None for d in each]


def _project(batches, n: int, sums: np.ndarray, turn: np.ndarray, explained: np.ndarray, error: float):
    kinds = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    k = turn.shape[1]
    for batch in batches:
        for at in range(0, batch.num_rows, _BLOCK):
            part = batch.slice(at, _BLOCK)
            x = _rows(part.column("_x"), len(sums))
            rows = len(x)
            white = _centred(x, n, sums) @ turn
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("vec_id").take(pa.array(np.repeat(np.arange(rows), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, n, np.int64)),
                    pa.array(_deviation(x, n, sums), pa.int64()).take(pa.array(np.repeat(np.arange(rows), k))),
                    pa.array(white.reshape(-1)),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * k, error)),
                ],
                kinds,
            )


def whiten(table: DataFrame, components: int = COMPONENTS, vector: str = "embedding") -> DataFrame:
    """`vec_id, component, n, deviation, whitened, explained, identity_error` of each usable row and component."""
    root = shared_dir(table.sparkSession)
    kind = table.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    usable = quantized(table.select("vec_id", vector), vector)
    # A row per length that occurs; of many lengths only the first is fetched.
    commonest = usable.groupBy(F.size("_x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).head()
    if commonest is None:
        return table.sparkSession.createDataFrame([], schema)
    size = commonest["d"]
    usable = usable.filter(F.size("_x") == size).select("vec_id", "_x")
    fit = stage(usable.select("_x").distinct(), "fit", root)
    sums = fit.select(F.posexplode("_x").alias("i", "x")).groupBy("i").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("n"))
    found = sorted(sums.collect())  # a row per dimension
    n, sums = found[0]["n"], np.array([int(r["s"]) for r in found])
    parts, value, trace = fit_components(fit, n, sums)
    parts, value = parts[:, :components], value[:components]
    if not len(value):
        return table.sparkSession.createDataFrame([], schema)
    turn = parts / np.sqrt(value)
    cov = _summed(fit, partial(_identity, n=n, sums=sums, turn=turn), size, size)[: len(value), : len(value)]
    error = float(np.abs(cov - np.eye(len(value))).max())
    work = partial(_project, n=n, sums=sums, turn=turn, explained=value / trace, error=error)
    return usable.mapInArrow(work, schema)
