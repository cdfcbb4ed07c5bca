"""Whitening of embeddings by the eigenvectors of their exact covariance.

Covariances come by polarisation: for whole numbers y centred exactly, the sum of (y_i + y_j)^2 less
those of y_i^2 and y_j^2 is twice the sum of y_i y_j.  Tasks add up the squares of every dimension and of
every sum of two dimensions without rounding; Spark adds the tasks' results; the driver sees one
number per pair of dimensions, whatever the number of vectors, and finds the eigenvectors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwell.sources.shared import stored

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: floor(64 * c) beyond this counts as this: it has to fit a long.
LIMIT = 1 << 61
#: Rows handled at once.
ROWS = 2048
#: Sums go to Spark as two decimals, in units of this and of 1.
UNIT = 10**18
_WIDE = pa.decimal128(38, 0)


def whole_vectors(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id and ``x``, the whole numbers floor(64 * c) + 1,000,000 of each usable vector."""
    c = F.col(column)
    usable = c.isNotNull() & F.forall(c, lambda e: F.coalesce(F.abs(e.cast("double")) < F.lit(float("inf")), F.lit(False)))

    def whole(e: Column) -> Column:
        return F.greatest(F.least(F.floor(e.cast("double") * SCALE), F.lit(LIMIT)), F.lit(-LIMIT)) + SHIFT

    return vectors.where(usable).select("vec_id", F.transform(c, whole).alias("x"))


def _of_length(d: int) -> Column:
    """Shorter vectors as if their missing entries were 0."""
    missing = F.lit(d) - F.size("x")
    return F.when(missing > 0, F.concat("x", F.array_repeat(F.lit(SHIFT).cast("long"), missing))).otherwise(F.col("x"))


def _blocks(batch: pa.RecordBatch, d: int) -> Iterator[np.ndarray]:
    x = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, d)
    for at in range(0, len(x), ROWS):
        yield x[at : at + ROWS]


@dataclass(frozen=True)
class Centre:
    """Number of vectors and sum of each dimension; ``centred`` gives n * x - S without rounding."""

    n: int
    sums: tuple[int, ...]

    def centred(self, x: np.ndarray) -> np.ndarray:
        floor = np.array([s // self.n for s in self.sums], dtype=np.int64)
        rest = [s % self.n for s in self.sums]
        if len(x) and self.n * (int(np.abs(x).max()) + int(np.abs(floor).max()) + 1) >= 1 << 61:
            return (x.astype(object) - floor.astype(object)) * self.n - np.array(rest, dtype=object)
        return (x - floor) * self.n - np.array(rest, dtype=np.int64)


def _square_sums(z: np.ndarray) -> list[int]:
    """The exact sum of squares of each column."""
    if z.dtype == object:
        return [int(s) for s in (z * z).sum(axis=0)]
    largest = int(np.abs(z).max(initial=0))
    if largest * largest * len(z) < 1 << 62:
        return (z * z).sum(axis=0).tolist()
    # Three limbs of 21 bits; each product of two stays below 2**62 over 2**20 rows.
    a = np.abs(z)
    low, mid, high = a & 0x1FFFFF, (a >> 21) & 0x1FFFFF, a >> 42
    parts = [(low * low, 0), (2 * low * mid, 21), (mid * mid, 42), (2 * low * high, 42), (2 * mid * high, 63), (high * high, 84)]
    return [sum(int(v) << shift for v, (_, shift) in zip(column, parts, strict=True)) for column in zip(*(p.sum(axis=0).tolist() for p, _ in parts), strict=True)]


def _pairs(d: int) -> list[tuple[int, int]]:
    """(i, i) stands for dimension i alone, (i, j) for the sum of two."""
    return [(i, j) for i in range(d) for j in range(i, d)]


def _emit(totals: dict[tuple[int, int], int]) -> pa.RecordBatch:
    keys, values = list(totals), list(totals.values())
    return pa.RecordBatch.from_arrays(
        [
            pa.array([i for i, _ in keys], pa.int32()),
            pa.array([j for _, j in keys], pa.int32()),
            pa.array([Decimal(v // UNIT) for v in values], _WIDE),
            pa.array([Decimal(v % UNIT) for v in values], _WIDE),
        ],
        names=["i", "j", "high", "low"],
    )


_SUMS = "i int, j int, high decimal(38,0), low decimal(38,0)"


def _summed(parts: DataFrame) -> dict[tuple[int, int], int]:
    """The totals over all tasks; one row for each key, of which there are at most d * (d + 1) / 2."""
    rows = parts.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    return {(r["i"], r["j"]): int(r["high"]) * UNIT + int(r["low"]) for r in rows}


def centre(fit: DataFrame, d: int) -> Centre:
    """Count and sums of the fit list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {(-1, 0): 0} | {(i, i): 0 for i in range(d)}
        for batch in batches:
            for x in _blocks(batch, d):
                totals[-1, 0] += len(x)
                # Halves of 32 bits, so that their sums fit.
                for i, (high, low) in enumerate(zip((x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist(), strict=True)):
                    totals[i, i] += (high << 32) + low
        if totals[-1, 0]:
            yield _emit(totals)

    found = _summed(fit.mapInArrow(run, _SUMS))
    return Centre(found.get((-1, 0), 0), tuple(found.get((i, i), 0) for i in range(d)))


def covariance(fit: DataFrame, middle: Centre, d: int) -> np.ndarray:
    """The covariance matrix of x by polarisation; each entry is rounded once, at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = dict.fromkeys(_pairs(d), 0)
        seen = False
        for batch in batches:
            for x in _blocks(batch, d):
                seen = True
                y = middle.centred(x)
                for i, s in enumerate(_square_sums(y)):
                    totals[i, i] += s
                for i in range(d - 1):
                    for j, s in enumerate(_square_sums(y[:, i : i + 1] + y[:, i + 1 :]), start=i + 1):
                        totals[i, j] += s
        if seen:
            yield _emit(totals)

    q = _summed(fit.mapInArrow(run, _SUMS))
    cube, out = middle.n**3, np.zeros((d, d))
    for i, j in _pairs(d):
        out[i, j] = out[j, i] = q[i, i] / cube if i == j else (q[i, j] - q[i, i] - q[j, j]) / (2 * cube)
    return out


@dataclass(frozen=True)
class Whitening:
    """The fitted map: a column of ``directions`` per component, already over the root of its eigenvalue;
    zeros where that is nil."""

    centre: Centre
    directions: np.ndarray
    explained: tuple[float | None, ...]
    usable: tuple[bool, ...]

    def __call__(self, y: np.ndarray) -> np.ndarray:
        return (y.astype(np.float64) / self.centre.n) @ self.directions


def fit_whitening(fit: DataFrame, d: int, components: int = COMPONENTS) -> Whitening | None:
    """The map from the distinct vectors ``fit`` (x, all of length d); None where there is none."""
    middle = centre(fit, d) if d else Centre(0, ())
    if not middle.n:
        return None
    v = covariance(fit, middle, d)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    # What eigh can't tell from nothing is nothing.
    usable = values > np.finfo(float).eps * d * max(float(np.abs(values).max()), 0.0)
    directions = np.where(usable, vectors / np.sqrt(np.where(usable, values, 1.0)), 0.0)
    trace = float(np.trace(v))
    explained = tuple(max(float(e), 0.0) / trace if trace > 0 else None for e in values)
    return Whitening(middle, directions, explained, tuple(bool(u) for u in usable))


def identity_error(fit: DataFrame, found: Whitening, d: int) -> float:
    """The largest entry, without sign, of the whitened fit list's covariance less the identity, measured
    on the vectors; components without variance are left out."""
    k = len(found.usable)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, sums = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            for x in _blocks(batch, d):
                w = found(found.centre.centred(x))
                products += w.T @ w
                sums += w.sum(axis=0)
        rows = [(i, j, products[i, j]) for i in range(k) for j in range(i, k)] + [(-1, i, sums[i]) for i in range(k)]
        i, j, value = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(value, pa.float64())], names=["i", "j", "value"])

    total = {(r["i"], r["j"]): r["value"] for r in fit.mapInArrow(run, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value")).collect()}
    n, worst = found.centre.n, 0.0
    for i in range(k):
        for j in range(i, k):
            if found.usable[i] and found.usable[j]:
                # The vectors are centred; what is left of their mean is rounding.
                own = total[i, j] / n - total[-1, i] / n * total[-1, j] / n
                worst = max(worst, abs(own - (i == j)))
    return worst


_RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row for each usable row of ``vectors`` (vec_id, embedding) and component: vec_id, component (from
    1, by falling eigenvalue), n (distinct vectors), deviation (exact sum of the squares of n * x - S),
    whitened, explained (the eigenvalue's share of the variance) and identity_error (of the whole fit).

    Rows whose vector is null or has null or non-finite entries are left out.  Distinct vectors count once
    in the fit, however many rows hold one; each of those rows gets its result.  Vectors shorter than the
    longest count as if filled up with 0; entries of 2**55 or more count as about that.  Along a
    component without variance ``whitened`` is null; where no vector differs from another ``explained`` is
    null too, and where a deviation does not fit a long it is null.  vec_id may be null or repeat; further
    columns are not looked at; without usable rows, or if all vectors are empty, there is no result."""
    kind = vectors.schema["vec_id"].dataType.simpleString()
    usable = whole_vectors(vectors)
    d = usable.agg(F.max(F.size("x")).alias("d")).first()["d"] or 0
    usable = usable.select("vec_id", _of_length(d).alias("x"))
    fit = stored(usable.select("x").distinct(), "fit-list")
    found = fit_whitening(fit, d, components)
    schema = f"vec_id {kind}, {_RESULT}"
    if found is None:
        return vectors.sparkSession.createDataFrame([], schema)
    error, k = identity_error(fit, found, d), len(found.usable)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in zip(range(0, batch.num_rows, ROWS), _blocks(batch, d), strict=True):
                y, rows = found.centre.centred(x), len(x)
                deviation = _square_sums(y.T)
                white = found(y)
                white = np.ma.MaskedArray(white, mask=np.broadcast_to(~np.array(found.usable), white.shape)).ravel()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(pa.array(np.repeat(np.arange(at, at + rows), k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                        pa.array(np.full(rows * k, found.centre.n)),
                        pa.array([s if s < 1 << 63 else None for s in deviation for _ in range(k)], pa.int64()),
                        pa.array(white.data, mask=white.mask),
                        pa.array(list(found.explained) * rows, pa.float64()),
                        pa.array(np.full(rows * k, error)),
                    ],
                    names=["vec_id", *(c.split()[0] for c in _RESULT.split(", "))],
                )

    return usable.mapInArrow(run, schema)
