"""SimHash near-deduplication: fingerprints compared bit-sliced.

Equal fingerprints become one row before anything is compared.  Two fingerprints within the radius
agree on some blocks of bits; every combination of blocks that must agree for some pair is a table,
and rows meet where a table's key is equal.  The number of blocks follows the number of
fingerprints, so that cells stay small; a cell that is large all the same is split into chunks and
every pair of chunks is compared on its own.

Within a cell the fingerprints stand as bit planes, 64 to a word.  Distances from a batch of
fingerprints to all of them grow plane by plane in carry-save counters, and words in which every
distance has passed the radius are abandoned.  A cell returns a spanning forest of its links."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwell.llm.common import text_slices
from tierwell.llm.components import components, local_roots
from tierwell.sources.shared import stored

SHINGLE = 4
RADIUS = 4
SEED = 42
#: Fingerprints of a cell that are compared in one task; larger cells are split.
CELL = 2048


def shingle_hashes(text: str, width: int) -> list[int]:
    """The hash of every run of ``width`` words, of the whole text if it has fewer; none without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return []
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    width = min(width, len(words))
    stops = (starts + sizes)[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(line[a:b], SEED) for a, b in zip(starts.tolist(), stops, strict=False)]


def _majority(hashes) -> int:
    """Bit b is 1 if it is set in over half of the hashes."""
    total = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], dtype="<u8")
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str, width: int = SHINGLE) -> int:
    """Bit b is 1 if it is set in over half of the shingles' hashes; 0 for a text without words."""
    return _majority(shingle_hashes(text, width))


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, dtype=np.uint64).view(np.int64)


def fingerprint_column(text: Column) -> Column:
    """The fingerprint's bits as a signed 64-bit number; a null text counts as empty."""

    @F.arrow_udf("long")
    def fingerprints(texts: pa.Array) -> pa.Array:
        parts = [_signed([fingerprint(t) for t in part]) for _, part in text_slices(texts)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64), pa.int64())

    return fingerprints(text)


def block_layout(n: int, radius: int = RADIUS, cell: int = CELL) -> tuple[int, int, int]:
    """(blocks, blocks that agree, key bits of each) for n fingerprints: the fewest tables whose keys
    are long enough for cells of about ``cell`` rows, and no more key bits than those cells need."""
    need = max(0, (max(n, 1) // cell).bit_length())
    for agree in range(1, 64 - radius):
        blocks = radius + agree
        if agree * (64 // blocks) >= need:
            return blocks, agree, -(-need // agree)
    return 63, 63 - radius, 1


def _planes(values: np.ndarray) -> np.ndarray:
    """Bit planes: word w of plane p has bit p of values 64 w to 64 w + 63."""
    padded = np.zeros(-(-len(values) // 64) * 64, dtype=np.uint64)
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def within(queries: np.ndarray, values: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """(query number, value number) of all pairs within the radius, by bit-sliced comparison."""
    planes = _planes(values)
    words = planes.shape[1]
    counters = (radius + 1).bit_length()
    found_q: list[np.ndarray] = []
    found_v: list[np.ndarray] = []
    step = max(1, (1 << 17) // max(1, words))
    for at in range(0, len(queries), step):
        own = queries[at : at + step]
        q = np.repeat(np.arange(len(own)), words)
        w = np.tile(np.arange(words), len(own))
        sums = [np.zeros(len(q), dtype=np.uint64) for _ in range(counters)]
        over = np.zeros(len(q), dtype=np.uint64)
        # Bits beyond the last value count as passed from the start.
        spare = words * 64 - len(values)
        if spare:
            over[w == words - 1] = _ALL << np.uint64(64 - spare)
        for p in range(0, 64, 4):
            x = [planes[p + k][w] ^ (np.uint64(0) - ((own[q] >> np.uint64(p + k)) & np.uint64(1))) for k in range(4)]
            # Two carry-save adders take the first counter and four planes; carries go on upwards.
            a = sums[0] ^ x[0]
            one = (sums[0] & x[0]) | (a & x[1])
            a ^= x[1]
            b = a ^ x[2]
            two = (a & x[2]) | (b & x[3])
            sums[0] = b ^ x[3]
            for carry in (one, two):
                for level in range(1, counters):
                    up = sums[level] & carry
                    sums[level] ^= carry
                    carry = up
                over |= carry
            # Passed: the counters read more than the radius.
            above, equal = np.zeros(len(q), dtype=np.uint64), np.full(len(q), _ALL)
            for level in range(counters - 1, -1, -1):
                if radius >> level & 1:
                    equal &= sums[level]
                else:
                    above |= equal & sums[level]
                    equal &= ~sums[level]
            over |= above
            if p >= 16 and p % 8 == 4:
                alive = np.flatnonzero(over != _ALL)
                if len(alive) < len(q):
                    q, w, over = q[alive], w[alive], over[alive]
                    sums = [s[alive] for s in sums]
                if not len(q):
                    break
        if len(q):
            near = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, bit = np.nonzero(near)
            found_q.append(at + q[row])
            found_v.append(w[row] * 64 + bit)
    if not found_q:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(found_q), np.concatenate(found_v)


def _keys(blocks: int, agree: int, bits: int):
    """For each row one key a table: the table's number and the first bits of its blocks."""
    width = 64 // blocks
    tables = list(itertools.combinations(range(blocks), agree))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = np.asarray(batch.column("fp")).view(np.uint64)
            for number, chosen in enumerate(tables):
                key = np.full(len(value), number, dtype=np.uint64)
                for block in chosen:
                    key = (key << np.uint64(bits)) | ((value >> np.uint64(block * width)) & np.uint64((1 << bits) - 1))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column("fp")], names=["cell", "fp"])

    return run


def _forest(values: np.ndarray, left: np.ndarray, right: np.ndarray) -> pa.RecordBatch:
    root = local_roots(len(values), left, right)
    own = np.flatnonzero(root != np.arange(len(values)))
    return pa.RecordBatch.from_arrays([pa.array(values[own].view(np.int64)), pa.array(values[root[own]].view(np.int64))], names=["a", "b"])


def _compare(radius: int):
    """Links within each cell; rows come sorted by cell and chunk pair, cells never mix."""

    def links(values: np.ndarray, side: np.ndarray, split: bool) -> pa.RecordBatch:
        if split:  # two chunks: only pairs across them
            first, second = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            q, v = within(values[first], values[second], radius)
            return _forest(values, first[q], second[v])
        q, v = within(values, values, radius)
        return _forest(values, q[q < v], v[q < v])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                held.append(batch)
                keys = np.stack([np.asarray(batch.column(c)) for c in ("cell", "i", "j")])
                if not (keys[:, 0] != keys[:, -1]).any() and sum(b.num_rows for b in held) < 1 << 22:
                    continue
            if not held:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            cell, i, j, side = (rows.column(c).to_numpy() for c in ("cell", "i", "j", "side"))
            value = rows.column("fp").to_numpy().view(np.uint64)
            cuts = np.flatnonzero((np.diff(cell) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1
            edges = [0, *cuts.tolist(), len(cell)]
            last = len(edges) - 2 if batch is not None else len(edges) - 1
            for a, b in zip(edges[:last], edges[1 : last + 1], strict=True):
                if b - a > 1:
                    yield links(value[a:b], side[a:b], i[a] != j[a])
            held = rows.slice(edges[-2]).to_batches() if batch is not None else []

    return run


def near_links(distinct: DataFrame, n: int, radius: int = RADIUS, cell: int = CELL) -> DataFrame:
    """Links (a, b) that connect all pairs of ``distinct`` (fp) within the radius; n: its row count.

    What is linked is the closure: within a cell a spanning forest stands for all its links."""
    blocks, agree, bits = block_layout(n, radius, cell)
    keyed = distinct.select("fp").mapInArrow(_keys(blocks, agree, bits), "cell long, fp long")
    sizes = keyed.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    chunks = F.ceil(F.col("n") / cell).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("chunks")).cast("int")
    placed = keyed.join(sizes.select("cell", chunks.alias("chunks")), "cell").select("cell", "fp", "chunks", own.alias("own"))
    cells = placed.select("cell", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")).select(
        "cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"), "fp"
    )
    dealt = cells.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")
    return dealt.mapInArrow(_compare(radius), "a long, b long")


def _classes(distinct: DataFrame, radius: int) -> DataFrame:
    """(fp, least, root) of ``distinct`` (fp, least): fingerprints linked to each other have one root."""
    roots = components(near_links(distinct, distinct.count(), radius))
    return distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id for every row of ``docs`` (doc_id, text).

    Links join fingerprints at ``radius`` or fewer differing bits; component_id is the smallest doc_id
    of all documents reachable, the document itself included.  Null, empty and blank texts have
    fingerprint zero and are linked like any other.  Texts are read whole.  Repeated rows each get their
    row.  Rows without an id take part; a component without any id has a null component_id.  Further
    columns are not looked at; an empty table gives an empty result."""
    prints = stored(docs.select("doc_id", fingerprint_column(F.col("text")).alias("fp")), "fingerprints")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    grouped = _classes(distinct, radius)
    smallest = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = grouped.select("fp", "root").join(smallest, "root").select("fp", "component_id")
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(classes, "fp").select("doc_id", text.alias("fingerprint"), "component_id")


def keep_one_each(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row of each group that ``near_duplicates`` links, all columns kept: the smallest doc_id, rows
    without an id last, then by a hash of the text; of repeated rows one stays.

    The row that stays is found among fingerprints, of which a task hands on one row each; texts are read
    again only to pick it out."""
    print_of = F.xxhash64("text")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", print_of.alias("print"))
    prints = docs.select(fingerprint_column(F.col("text")).alias("fp"), place.alias("place"))
    distinct = stored(prints.groupBy("fp").agg(F.min("place").alias("least")), "distinct-fingerprints")
    kept = _classes(distinct, radius).groupBy("root").agg(F.min("least").alias("least"))
    kept = kept.select(F.col("least.doc_id").alias("_kept"), F.col("least.print").alias("_text"))
    rows = docs.withColumn("_print", print_of)
    rows = rows.join(kept, rows["doc_id"].eqNullSafe(kept["_kept"]) & (rows["_print"] == kept["_text"]), "left_semi")
    return rows.dropDuplicates(["doc_id", "_print"]).drop("_print")
