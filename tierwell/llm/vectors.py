"""Vectors as binary columns, and units of rows that Python meets one after another."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F


def _rows(vectors: pa.Array) -> list[np.ndarray | None]:
    """Each row's components as doubles; None for null, empty, null components or non-finite ones."""
    flat = vectors.flatten()
    values = np.asarray(flat.cast(pa.float64()).to_numpy(zero_copy_only=False), dtype=np.float64)
    sizes = np.asarray(pc.fill_null(pc.list_value_length(vectors), 0), dtype=np.int64)
    ends = np.cumsum(sizes)
    good = np.isfinite(values)
    out: list[np.ndarray | None] = []
    for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True):
        out.append(values[a:b] if b > a and good[a:b].all() else None)
    return out


def packed(vector: Column) -> Column:
    """The components as little-endian doubles; null where a component is null or not finite, and for
    null or empty vectors."""

    @F.arrow_udf("binary")
    def pack(vectors: pa.Array) -> pa.Array:
        return pa.array([None if v is None else v.astype("<f8").tobytes() for v in _rows(vectors)], pa.binary())

    return pack(vector)


#: Whole numbers beyond this count as this; they have to fit a long.
LIMIT = 1 << 62


def packed_integers(vector: Column, scale: float) -> Column:
    """floor(scale * x) of every component as little-endian 64-bit integers, at most LIMIT without sign; null
    as in ``packed``."""

    @F.arrow_udf("binary")
    def pack(vectors: pa.Array) -> pa.Array:
        with np.errstate(over="ignore"):
            whole = [None if v is None else np.clip(np.floor(v * scale), -float(LIMIT), float(LIMIT)) for v in _rows(vectors)]
        return pa.array([None if w is None else w.astype("<i8").tobytes() for w in whole], pa.binary())

    return pack(vector)


def matrix(column: pa.Array, kind: str) -> np.ndarray:
    """Binary vectors of one length as rows of a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), -1)


def units(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], role: str) -> Iterator[tuple[tuple, pa.Table, Iterator[pa.RecordBatch]]]:
    """(key, the rows of role 0 together, the batches of the other rows) of each unit, from rows sorted
    by key and role.  Only the rows of role 0 are held; the caller takes the others one by one."""

    def pieces() -> Iterator[tuple[tuple, pa.RecordBatch]]:
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [np.asarray(batch.column(k)) for k in (*keys, role)]
            change = np.zeros(batch.num_rows - 1, dtype=bool)
            for c in columns:
                change |= c[1:] != c[:-1]
            edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            for a, b in itertools.pairwise(edges):
                yield tuple(c[a].item() for c in columns), batch.slice(a, b - a)

    for key, own in itertools.groupby(pieces(), key=lambda x: x[0][:-1]):
        home: list[pa.RecordBatch] = []
        first = None
        for (*_, part), batch in own:
            if part:
                first = batch
                break
            home.append(batch)
        rest = itertools.chain([first], (b for _, b in own)) if first is not None else iter(())
        if home:
            yield key, pa.Table.from_batches(home).combine_chunks(), rest
