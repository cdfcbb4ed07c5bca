"""Embedding near-deduplication: an exact metric range join around pivots.

Equal vectors become one class with a weight.  Every class belongs to the cell of its nearest pivot,
by angle.  It also visits the cells that may hold a class within the radius of it: the triangle
inequality bounds the angle by the pivot of the cell, by the cell's covering radius, and by the plane
between both pivots.  Of two cells only one is visited, so a pair meets once.  Cells beyond ``CELL``
classes are split into blocks, which visit each other.  Each block joins its visitors on its own.

In many dimensions directions without structure lie about equally far apart; then few bounds hold
and visitors come to many cells.  The result stays exact; see the README for figures."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwell.llm.components import components, local_roots
from tierwell.llm.vectors import matrix, packed, units
from tierwell.sources.shared import stored

THRESHOLD = 0.9
CELL = 4096
MAX_PIVOTS = 4096
_SLACK = 1e-9


def _unit(rows: np.ndarray) -> np.ndarray:
    # By the largest component first: squares of long or short vectors would leave the range of doubles.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


@dataclass
class Cells:
    """Pivots by dimension, and of each cell: covering radius and number of blocks."""

    pivots: dict[int, np.ndarray]
    offset: dict[int, int]
    radius: np.ndarray
    blocks: np.ndarray

    def home(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cell, cosines to all pivots) of unit rows of one dimension."""
        cosine = rows @ self.pivots[rows.shape[1]].T
        return cosine.argmax(axis=1), cosine

    def visits(self, home: np.ndarray, cosine: np.ndarray, dim: int, angle: float) -> np.ndarray:
        """For each row and cell whether the row has to be compared there."""
        pivots = self.pivots[dim]
        own = cosine[np.arange(len(home)), home]
        reach = np.arccos(np.clip(cosine, -1, 1))
        base = self.offset[dim]
        ok = reach <= reach[np.arange(len(home)), home][:, None] + 2 * angle + _SLACK
        ok &= reach <= self.radius[base : base + len(pivots)][None, :] + angle + _SLACK
        between = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (pivots @ pivots.T)))[home]
        ok &= own[:, None] - cosine <= math.sin(angle) * between + _SLACK
        other = np.arange(len(pivots))[None, :]
        host = np.where((home[:, None] + other) % 2 == 0, np.minimum(home[:, None], other), np.maximum(home[:, None], other))
        return ok & (host == other) & (other != home[:, None])


def _by_dimension(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    sizes = np.asarray(pa.array([len(v) // 8 for v in batch.column("vec").to_pylist()], pa.int64()))
    for dim in np.unique(sizes).tolist():
        yield dim, batch.take(pa.array(np.flatnonzero(sizes == dim)))


def _homes(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, part in _by_dimension(batch):
                if dim in shared.value.pivots:
                    home, cosine = shared.value.home(_unit(matrix(part.column("vec"), "<f8")))
                    reach = np.arccos(np.clip(cosine[np.arange(len(home)), home], -1, 1))
                    yield pa.RecordBatch.from_arrays([pa.array(home + shared.value.offset[dim], pa.int32()), pa.array(reach)], names=["cell", "reach"])

    return run


def _deal(shared, angle: float):
    """Every class at home in one block, and as a visitor (role 1) of the others it has to meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                for dim, part in _by_dimension(whole.slice(at, 1024)):
                    home, cosine = cells.home(_unit(matrix(part.column("vec"), "<f8")))
                    base = cells.offset[dim]
                    visit = cells.visits(home, cosine, dim, angle)
                    spread = np.array([int(n[:8], 16) for n in part.column("node").to_pylist()], dtype=np.int64)
                    own = spread % cells.blocks[base + home]
                    row, cell = np.nonzero(visit)
                    n = cells.blocks[base + cell]
                    first = [np.arange(len(home)), base + home, own, np.zeros(len(home), dtype=np.int64)]
                    guest = [np.repeat(row, n), np.repeat(base + cell, n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n), np.ones(n.sum(), dtype=np.int64)]
                    m = cells.blocks[base + home]
                    mine = np.repeat(np.arange(len(home)), m)
                    block = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
                    host = np.where((own[mine] + block) % 2 == 0, np.minimum(own[mine], block), np.maximum(own[mine], block))
                    inner = (host == block) & (block != own[mine])
                    near = [mine[inner], (base + home)[mine[inner]], block[inner], np.ones(inner.sum(), dtype=np.int64)]
                    rows, cell_no, block_no, role = (np.concatenate(x) for x in zip(first, guest, near, strict=True))
                    for k in range(0, len(rows), 16384):
                        cut = slice(k, k + 16384)
                        picked = part.take(pa.array(rows[cut]))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(cell_no[cut], pa.int32()), pa.array(block_no[cut], pa.int32()), pa.array(role[cut], pa.int32()), *(picked.column(c) for c in ("node", "weight", "vec"))],
                            names=["cell", "block", "role", "node", "weight", "vec"],
                        )

    return run


def _join(threshold: float):
    """Links inside each block and to its visitors, as weights by class and forests."""

    def result(names: np.ndarray, linked: np.ndarray, root: np.ndarray) -> pa.RecordBatch:
        own = np.flatnonzero(linked > 0)
        return pa.RecordBatch.from_arrays(
            [pa.array(names[own], pa.string()), pa.array(names[root[own]], pa.string()), pa.array(linked[own], pa.int64())], names=["node", "root", "linked"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, home, visitors in units(batches, ("cell", "block"), "role"):
            names = home.column("node").to_numpy(zero_copy_only=False)
            weight = home.column("weight").to_numpy()
            rows = _unit(matrix(home.column("vec").combine_chunks(), "<f8"))
            linked = np.zeros(len(rows), dtype=np.int64)
            left: list[np.ndarray] = []
            right: list[np.ndarray] = []
            for at in range(0, len(rows), 512):
                near = rows[at : at + 512] @ rows[at:].T >= threshold
                i, j = np.nonzero(near)
                i, j = i[j > i] + at, j[j > i] + at
                np.add.at(linked, i, weight[j])
                np.add.at(linked, j, weight[i])
                left.append(i)
                right.append(j)
            yield result(names, linked, local_roots(len(rows), np.concatenate(left), np.concatenate(right)))
            linked[:] = 0
            for batch in visitors:
                for k in range(0, batch.num_rows, 512):
                    part = batch.slice(k, 512)
                    guests = _unit(matrix(part.column("vec"), "<f8"))
                    i, j = np.nonzero(guests @ rows.T >= threshold)
                    if not len(i):
                        continue
                    guest_weight = np.asarray(part.column("weight"))
                    both = np.concatenate((names, part.column("node").to_numpy(zero_copy_only=False)))
                    sums = np.zeros(len(both), dtype=np.int64)
                    np.add.at(sums, j, guest_weight[i])
                    np.add.at(sums, len(names) + i, weight[j])
                    yield result(both, sums, local_roots(len(both), j, len(names) + i))

    return run


def near_vectors(embeddings: DataFrame, threshold: float = THRESHOLD, cell: int = CELL) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``embeddings`` (vec_id, embedding).

    Rows whose cosine, in double precision, is ``threshold`` (over 0) or more are linked; n_links
    counts the other rows linked to a row, equal vectors included.  component_id is the smallest
    vec_id reachable, itself included; kept tells whether the row has it.  Vectors that are null,
    empty, zero or hold null or non-finite components, and rows without an id, link with nothing;
    vectors of different lengths do not link.  Repeated rows each count and get their row.  Further
    columns are not looked at; an empty table gives an empty result."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold has to lie above 0 and up to 1")
    spark = embeddings.sparkSession
    nonzero = F.exists("embedding", lambda x: x != 0)
    usable = embeddings.select("vec_id", F.when(F.col("vec_id").isNotNull() & nonzero, packed(F.col("embedding"))).alias("vec"))
    rows = stored(usable.select("vec_id", F.md5("vec").alias("node"), "vec"), "vectors")
    classes = stored(rows.where(F.col("vec").isNotNull()).groupBy("node").agg(F.first("vec").alias("vec"), F.min("vec_id").alias("least"), F.count("*").alias("weight")), "vector-classes")
    n = classes.count()
    chosen = classes.select("vec").orderBy("node").limit(max(1, min(MAX_PIVOTS, -(-n // cell)))).collect()
    pivots: dict[int, list[np.ndarray]] = {}
    for r in chosen:
        pivots.setdefault(len(r["vec"]) // 8, []).append(np.frombuffer(bytes(r["vec"]), dtype="<f8"))
    for r in classes.select((F.octet_length("vec") / 8).cast("int").alias("dim"), "vec").where(~F.col("dim").isin(list(pivots))).groupBy("dim").agg(F.min("vec").alias("vec")).limit(MAX_PIVOTS + 1).collect():
        pivots[r["dim"]] = [np.frombuffer(bytes(r["vec"]), dtype="<f8")]
    if len(pivots) > MAX_PIVOTS:
        raise ValueError(f"more than {MAX_PIVOTS} lengths of vectors")
    stacked = {dim: _unit(np.stack(p)) for dim, p in pivots.items()}
    offset = dict(zip(stacked, np.concatenate(([0], np.cumsum([len(p) for p in stacked.values()]))).tolist(), strict=False))
    total = sum(len(p) for p in stacked.values())
    cells = Cells(stacked, offset, np.zeros(total), np.ones(total, dtype=np.int64))
    shared = spark.sparkContext.broadcast(cells)
    # One row a cell: at most 2 * MAX_PIVOTS.
    for r in classes.select("vec").mapInArrow(_homes(shared), "cell int, reach double").groupBy("cell").agg(F.max("reach").alias("reach"), F.count("*").alias("n")).collect():
        cells.radius[r["cell"]], cells.blocks[r["cell"]] = r["reach"], -(-r["n"] // cell)
    shared = spark.sparkContext.broadcast(cells)
    dealt = classes.select("node", "weight", "vec").mapInArrow(_deal(shared, math.acos(threshold)), "cell int, block int, role int, node string, weight long, vec binary")
    met = dealt.repartition("cell", "block").sortWithinPartitions("cell", "block", "role")
    found = stored(met.mapInArrow(_join(threshold), "node string, root string, linked long"), "vector-links")
    linked = found.groupBy("node").agg(F.sum("linked").alias("linked"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = classes.select("node", "least", "weight").join(roots, "node", "left").join(linked, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"), (F.coalesce("linked", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    smallest = known.groupBy("root").agg(F.min("least").alias("component_id"))
    told = known.join(smallest, "root").select("node", "n_links", "component_id")
    own = rows.select("vec_id", "node").join(told, "node", "left")
    component = F.coalesce("component_id", "vec_id")
    return own.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
