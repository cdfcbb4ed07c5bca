"""Exact top-k search by inner product: norm-bucketed retrieval.

Candidates are grouped by length.  A first threshold for each query is its k-th best among the
longest candidates, a bounded set.  A query visits a bucket only if its length times the bucket's
longest reaches that threshold.  There the threshold, divided by both lengths, is the cosine that a
candidate needs: where it is high, a few of the query's largest coordinates bound the cosine of each
candidate and only those that may reach it are multiplied; where it is low, candidates too short to
reach the threshold are cut off and the rest is multiplied at once.  Products are exact."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierwell.llm.vectors import matrix, packed_integers, units
from tierwell.sources.shared import stored

SCALE = 64.0
K = 20
BUCKET = 4096
MAX_BUCKETS = 4096
#: From this local cosine on a query uses coordinates, below it length.
COORDINATES_FROM = 0.6
FOCUS = 4


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact integer products of rows: in doubles while they hold every sum, else in integers, of any size
    where they need it; what no long holds counts as the nearest that does."""
    bound = np.sqrt((left.astype(np.float64) ** 2).sum(axis=1).max(initial=0) * (right.astype(np.float64) ** 2).sum(axis=1).max(initial=0))
    if bound < 1 << 52:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    if bound < 1 << 62:
        return left @ right.T
    wide = left.astype(object) @ right.astype(object).T
    return np.clip(wide, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if len(scores) > k:
        among = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        among = np.arange(len(scores))
    return among[np.lexsort((ids[among], ~scores[among]))][:k]


class Bucket:
    """Candidates of one dimension, longest first."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, uids: np.ndarray):
        square = (rows.astype(np.float64) ** 2).sum(axis=1)
        order = np.argsort(-square, kind="stable")
        self.rows, self.ids, self.uids = rows[order], ids[order], uids[order]
        self.length = np.sqrt(square[order])
        self.direction = self.rows / np.maximum(self.length, 1e-300)[:, None]

    def search(self, queries: np.ndarray, uids: np.ndarray, floors: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query, places, scores) of each query's candidates at its floor or above, k at most."""
        length = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
        longest = self.length[0] if len(self.length) else 0.0
        need = floors / np.maximum(length * longest, 1e-300)
        slack = 1e-9
        for q in np.flatnonzero((need >= COORDINATES_FROM) & (need <= 1 + slack)):
            unit = queries[q] / length[q]
            focus = np.argsort(-np.abs(unit))[:FOCUS]
            part = self.direction[:, focus]
            rest = np.sqrt(max(0.0, 1.0 - (unit[focus] ** 2).sum())) * np.sqrt(np.maximum(0.0, 1.0 - (part**2).sum(axis=1)))
            may = np.flatnonzero((part @ unit[focus] + rest + slack) * self.length * length[q] >= floors[q] * (1 - slack))
            yield from self._verified(q, may, queries[q : q + 1], uids, floors, k)
        low = np.flatnonzero(need < COORDINATES_FROM)
        for at in range(0, len(low), 128):
            own = low[at : at + 128]
            # The longest prefix any of them needs; a floor of 0 or less needs all.
            least = np.where(floors[own] > 0, floors[own] / np.maximum(length[own], 1e-300), 0.0).min()
            prefix = int(np.searchsorted(-self.length, -least * (1 - slack), "right"))
            scores = _products(queries[own], self.rows[:prefix])
            for q, row in zip(own, scores, strict=True):
                yield from self._picked(q, np.arange(prefix), row, uids, floors, k)

    def _verified(self, q, may, query, uids, floors, k):
        yield from self._picked(q, may, _products(query, self.rows[may])[0], uids, floors, k)

    def _picked(self, q, places, scores, uids, floors, k):
        good = (scores >= floors[q]) & (self.uids[places] != uids[q])
        places, scores = places[good], scores[good]
        best = _best(scores, self.ids[places], k)
        yield q, places[best], scores[best]


_NOTHING = -(1 << 63)


def _floors(shared, k: int):
    """Adds each query's k-th best score in the broadcast bucket of its dimension as its floor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            floors = np.full(batch.num_rows, _NOTHING, dtype=np.int64)
            dims = np.array([len(v) // 8 for v in batch.column("vec").to_pylist()])
            for dim, bucket in shared.value.items():
                own = np.flatnonzero(dims == dim)
                if len(own):
                    part = batch.take(pa.array(own))
                    none = np.full(len(own), _NOTHING, dtype=np.int64)
                    for q, _, scores in bucket.search(matrix(part.column("vec"), "<i8"), np.asarray(part.column("uid")), none, k):
                        if len(scores) == k:
                            floors[own[q]] = scores[-1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(floors)], names=[*batch.schema.names, "floor"])

    return run


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, home, visitors in units(batches, ("dim", "bucket", "chunk"), "role"):
            bucket = Bucket(matrix(home.column("vec").combine_chunks(), "<i8"), home.column("vec_id").to_numpy(), home.column("uid").to_numpy())
            for batch in visitors:
                for at in range(0, batch.num_rows, 1024):
                    part = batch.slice(at, 1024)
                    uid, ids = np.asarray(part.column("uid")), np.asarray(part.column("vec_id"))
                    found = [(q, p, s) for q, p, s in bucket.search(matrix(part.column("vec"), "<i8"), uid, np.asarray(part.column("floor")), k) if len(p)]
                    if found:
                        rows = np.repeat([q for q, _, _ in found], [len(p) for _, p, _ in found])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(uid[rows]), pa.array(ids[rows]), pa.array(bucket.ids[np.concatenate([p for _, p, _ in found])]), pa.array(np.concatenate([s for _, _, s in found]))],
                            names=["uid", "query_id", "vec_id", "score"],
                        )

    return run


def top_products(embeddings: DataFrame, every: int = 20, k: int = K, bucket: int = BUCKET) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest integer inner products of each query.

    A component x counts as floor(64 x).  Queries are the rows whose vec_id is divisible by ``every``,
    candidates all rows but the query's own; ties go to the smaller vec_id.  Rows without an id and
    vectors that are null, empty or hold null or non-finite components take no part; components of 2**56
    or more count as that, and scores beyond a long as its nearest; only vectors of one length meet.  Repeated rows are rows of their own, also as
    queries.  Further columns are not looked at; without queries the result is empty."""
    spark = embeddings.sparkSession
    whole = embeddings.where(F.col("vec_id").isNotNull()).select("vec_id", packed_integers(F.col("embedding"), SCALE).alias("vec")).where(F.col("vec").isNotNull())
    rows = stored(_with_squares(whole).withColumn("uid", F.monotonically_increasing_id()), "integer-vectors")
    n = rows.count()
    wanted = max(1, min(MAX_BUCKETS, -(-n // bucket)))
    cuts = sorted(set(rows.approxQuantile("square", [i / wanted for i in range(1, wanted)], 0.25 / wanted)), reverse=True) if wanted > 1 else []
    number = sum([(F.col("square") < c).cast("int") for c in cuts], F.lit(0)) if len(cuts) < 64 else F.size(F.filter(F.lit(cuts), lambda c: c > F.col("square")))
    placed = rows.withColumn("bucket", number)
    # One row a bucket and dimension, at most: the chunks of each, and its greatest length.
    sizes = placed.groupBy("dim", "bucket").agg(F.max("square").alias("longest"), F.ceil(F.count("*") / bucket).cast("int").alias("chunks"))
    sizes = stored(sizes, "bucket-sizes")
    longest = rows.orderBy(F.desc("square"), "uid").limit(bucket).collect()
    first: dict[int, Bucket] = {}
    for dim in {r["dim"] for r in longest}:
        own = [r for r in longest if r["dim"] == dim]
        first[dim] = Bucket(np.stack([np.frombuffer(bytes(r["vec"]), dtype="<i8") for r in own]), np.array([r["vec_id"] for r in own]), np.array([r["uid"] for r in own]))
    shared = spark.sparkContext.broadcast(first)
    schema = "vec_id long, vec binary, dim int, square double, uid long"
    queries = rows.where(F.col("vec_id") % every == 0).select("vec_id", "vec", "dim", "square", "uid").mapInArrow(_floors(shared, k), f"{schema}, floor long")
    can = F.sqrt("square") * F.sqrt("longest") * (1 + 1e-9) >= F.col("floor")
    visitors = (
        queries.join(sizes, "dim")
        .where(can)
        .select("dim", "bucket", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(1).alias("role"), "vec_id", "uid", "vec", "floor")
    )
    homes = placed.join(sizes.select("dim", "bucket", "chunks"), ["dim", "bucket"]).select(
        "dim", "bucket", F.pmod(F.xxhash64("uid"), F.col("chunks")).cast("int").alias("chunk"), F.lit(0).alias("role"), "vec_id", "uid", "vec", F.lit(_NOTHING).cast("long").alias("floor")
    )
    met = homes.unionByName(visitors).repartition("dim", "bucket", "chunk").sortWithinPartitions("dim", "bucket", "chunk", "role")
    found = met.mapInArrow(_search(k), "uid long, query_id long, vec_id long, score long")
    order = Window.partitionBy("uid").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _with_squares(whole: DataFrame) -> DataFrame:
    """Adds the dimension and the squared length of the integer vectors."""

    @F.arrow_udf("double")
    def squares(vectors: pa.Array) -> pa.Array:
        return pa.array([float((np.frombuffer(v, dtype="<i8").astype(np.float64) ** 2).sum()) for v in vectors.to_pylist()], pa.float64())

    return whole.select(F.col("vec_id").cast("long").alias("vec_id"), "vec", (F.octet_length("vec") / 8).cast("int").alias("dim"), squares(F.col("vec")).alias("square"))
