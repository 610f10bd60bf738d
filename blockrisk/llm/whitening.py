"""Whitening of embeddings with covariances from variances alone, by the polarisation identity.

For two dimensions a and b, var(a + b) - var(a) - var(b) is twice their covariance. So nothing but
sums of squares is aggregated: of every centred dimension, and of the sum of every two. Entries are
whole numbers x, and with n rows and sums S the centred entry is n*x - S, whole as well: the sums of
squares are exact at any size, held in parts of 40 bits, and only their final quotient is rounded.

The fit list is every distinct vector once. A first pass over it takes n and S, a second the
squares; a task works on blocks of rows and gives one row per dimension and pair, so what meets on
the driver has the size of the covariance matrix, whatever the table's. There ``eigh`` gives the
components. A last pass over the fit list measures how far the covariance of its whitened values is
from the identity, centred by its own mean.

Cases: rows whose vector is null or holds a null, NaN or infinite entry are dropped; vectors shorter
than the longest count as zero where they end, and are equal to those with the zeros written out;
repeated rows are one of the fit list and a result row each; rows without an id keep their place
with a null id; an empty table, or one of empty vectors, gives no rows; components without variance
(below ``NO_VARIANCE`` of the whole), thus all of a table of one distinct vector, give none. A
deviation beyond 64 bits is null. Entries beyond 62 bits less those of n are worked on as Python's
integers: slower, and as exact. Further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockrisk.llm.frames import written
from blockrisk.llm.maxscore import _matrix, integer_weights

COMPONENTS = 4
BLOCK_ROWS = 4096
LIMB, PARTS = 40, 5
NO_VARIANCE = 1e-12
SUMS = "place int, " + ", ".join(f"part{k} long" for k in range(PARTS))
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whole_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """vec_id and x, whole entries, of the rows that remain, stored; all as long as the longest."""
    vector = F.col(f"`{vector_col}`")
    bad = lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == F.lit(math.inf))
    rows = table.where(vector.isNotNull() & ~F.exists(vector, bad)).select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), integer_weights(vector, scale).alias("x"))
    rows = written(rows, "vectors")
    longest = rows.agg(F.max(F.size("x"))).first()[0] or 0
    filled = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(longest) - F.size("x")))
    return rows.withColumn("x", filled)


def exact_square_sums(values: np.ndarray) -> list[int]:
    """Sum of the squares of each column, exact for any 64-bit (or object) entries."""
    if values.dtype == object:
        return [int(s) for s in (values * values).sum(0)] if len(values) else [0] * values.shape[1]
    peak = int(max(-int(values.min(initial=0)), int(values.max(initial=0))))
    if peak < 1 << 31:
        step = max(1, ((1 << 62) // max(1, peak * peak)))
        if step >= len(values):
            return np.einsum("ij,ij->j", values, values).tolist()
        return _added(np.einsum("ij,ij->j", values[k : k + step], values[k : k + step]).tolist() for k in range(0, len(values), step))
    if peak < 1 << 48:  # high and low halves of 24 bits: each product stays below 2^49
        size = np.abs(values)
        high, low = size >> 24, size & ((1 << 24) - 1)
        sums = [np.zeros(values.shape[1], object)] * 3
        for k in range(0, len(values), 1 << 12):
            h, low_part = high[k : k + (1 << 12)], low[k : k + (1 << 12)]
            sums = [s + np.einsum("ij,ij->j", a, b).astype(object) for s, (a, b) in zip(sums, ((h, h), (h, low_part), (low_part, low_part)))]
        return [(int(a) << 48) + (int(b) << 25) + int(c) for a, b, c in zip(*sums)]
    return exact_square_sums(values.astype(object))


def _added(lists: Iterator[list[int]]) -> list[int]:
    total: list[int] | None = None
    for values in lists:
        total = values if total is None else [a + b for a, b in zip(total, values)]
    return total or []


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n*x - S; Python's integers where 64 bits might not hold it or its sum of two."""
    peak = max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0))))
    if 4 * peak * n < 1 << 62 and max(map(abs, sums), default=0) < 1 << 60:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _blocks(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for first in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(first, BLOCK_ROWS)
            yield part, _matrix(part.column("x"), dimensions)


def _parts(place: int, value: int) -> tuple[int, ...]:
    """A sum as parts of 40 bits, so that adding the parts of many tasks cannot run over; the last has the sign."""
    return (place, *((value >> (LIMB * k)) & ((1 << LIMB) - 1) for k in range(PARTS - 1)), value >> (LIMB * (PARTS - 1)))


def _sum_batch(sums: list[int]) -> pa.RecordBatch:
    columns = list(zip(*(_parts(k, s) for k, s in enumerate(sums)))) or [[]] * (PARTS + 1)
    types = [pa.int32(), *[pa.int64()] * PARTS]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[f.split()[0] for f in SUMS.split(", ")])


def _gathered(partial: DataFrame) -> list[int]:
    """Whole sums by place: a row per dimension or pair."""
    rows = partial.groupBy("place").agg(*(F.sum(f"part{k}").alias(f"part{k}") for k in range(PARTS))).collect()
    by_place = {r[0]: sum(v << (LIMB * k) for k, v in enumerate(r[1:])) for r in rows}
    return [by_place[k] for k in sorted(by_place)]


def column_sums(fit: DataFrame, dimensions: int) -> list[int]:
    """n and the exact sum of every dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * (dimensions + 1)
        for part, x in _blocks(batches, dimensions):
            peak = max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0))))
            added = x.sum(0) if peak < 1 << 50 else x.astype(object).sum(0)
            total = [a + int(b) for a, b in zip(total, [part.num_rows, *added])]
        yield _sum_batch(total)

    return _gathered(fit.mapInArrow(run, SUMS))


def polarised_sums(fit: DataFrame, n: int, sums: list[int]) -> list[int]:
    """Sums of squares of n*x - S: of every dimension, then of the sum of every two in order (0, 1), (0, 2), ..."""
    dimensions = len(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * (dimensions * (dimensions + 1) // 2)
        for _, x in _blocks(batches, dimensions):
            c = _centred(x, n, sums)
            squares = exact_square_sums(c)
            for a in range(dimensions - 1):
                squares += exact_square_sums(c[:, a : a + 1] + c[:, a + 1 :])
            total = [s + q for s, q in zip(total, squares)]
        yield _sum_batch(total)

    return _gathered(fit.mapInArrow(run, SUMS))


@dataclass
class Whitening:
    """What ``fit_whitening`` found: ``vectors`` holds a unit eigenvector per column, by falling eigenvalue."""

    n: int
    sums: list[int]
    covariance: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    identity_error: float = 0.0

    def project(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(n*x - S, whitened values) of rows of whole entries."""
        c = _centred(x, self.n, self.sums)
        return c, (c / self.n).astype(np.float64) @ (self.vectors / np.sqrt(self.values))


def covariance_of(squares: list[int], n: int, dimensions: int) -> np.ndarray:
    """Covariances from the polarised sums; each entry is rounded once."""
    out, pairs = np.zeros((dimensions, dimensions)), iter(squares[dimensions:])
    for a in range(dimensions):
        out[a, a] = squares[a] / n**3
        for b in range(a + 1, dimensions):
            out[a, b] = out[b, a] = (next(pairs) - squares[a] - squares[b]) / (2 * n**3)
    return out


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fits on the distinct ``x`` of ``vectors`` (see ``whole_vectors``); None where there is nothing to fit."""
    fit = written(vectors.select("x").distinct(), "fit-list")
    first = fit.select(F.size("x")).head(1)
    if not first or first[0][0] == 0:
        return None
    n, *sums = column_sums(fit, first[0][0])
    covariance = covariance_of(polarised_sums(fit, n, sums), n, len(sums))
    values, directions = np.linalg.eigh(covariance)
    values, directions = values[::-1], directions[:, ::-1]
    keep = values[:components] > NO_VARIANCE * max(float(np.trace(covariance)), 1e-300)
    model = Whitening(n, sums, covariance, values[:components][keep], directions[:, :components][:, keep])
    model.identity_error = identity_error(fit, model) if keep.any() else 0.0
    return model


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest entry, in size, of the covariance of the fit list's whitened values minus the identity."""
    k, dimensions = len(model.values), len(model.sums)

    def moments(batches: Iterator[pa.RecordBatch], centre: np.ndarray) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for _, x in _blocks(batches, dimensions):
            w = model.project(x)[1] - centre
            total[0] += w.sum(0)
            total[1:] += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], names=["sums"])

    def gathered(centre: np.ndarray) -> np.ndarray:
        partial = fit.mapInArrow(lambda b: moments(b, centre), "sums array<double>")
        rows = partial.select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col")).collect()
        return np.array([v for _, v in sorted(map(tuple, rows))]).reshape(k + 1, k) / model.n

    centre = gathered(np.zeros(k))[0]
    return float(np.abs(gathered(centre)[1:] - np.eye(k)).max())


def whiten(vectors: DataFrame, model: Whitening | None) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per row of ``vectors`` and component."""
    if model is None or not len(model.values):
        return vectors.sparkSession.createDataFrame([], RESULT)
    k, dimensions = len(model.values), len(model.sums)
    explained = model.values / np.trace(model.covariance)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches, dimensions):
            c, white = model.project(x)
            deviation = _row_squares(c)
            rows = len(x)
            take = pa.array(np.repeat(np.arange(rows), k))
            yield pa.RecordBatch.from_arrays([
                part.column("vec_id").take(take), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, model.n)),
                pa.array(deviation, pa.int64()).take(take), pa.array(white.ravel()), pa.array(np.tile(explained, rows)), pa.array(np.full(rows * k, model.identity_error)),
            ], names=[f.split()[0] for f in RESULT.split(", ")])

    return vectors.select("vec_id", "x").mapInArrow(run, RESULT)


def _row_squares(c: np.ndarray) -> list[int | None]:
    sums = exact_square_sums(np.ascontiguousarray(c.T)) if len(c) else []
    return [s if s < 1 << 63 else None for s in sums]


def whitened_rows(table: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    vectors = whole_vectors(table, id_col, vector_col, scale)
    return whiten(vectors, fit_whitening(vectors, components))
