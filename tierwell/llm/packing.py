"""Packing of documents into sequences by non-negative least squares on the histogram of lengths.

A document's ids fill whole windows first; what is left of it is a remainder.  Remainders fall into
bins of ``STEP`` ids.  All combinations of at most ``DEPTH`` bins that fill a window are enumerated,
non-negative least squares finds how often each should be used to use up the histogram, and the
solution is rounded down.  In each sequence so planned the largest remainder stands last and is cut
where the window ends, a few ids before its own end.  What no combination uses and what was cut off
is packed greedily, one after another; the last, incomplete window is cut into powers of two, which
need no padding.

The driver sees the histogram, one row a bin, and a bounded plan; ranks within bins and positions in
the greedy stream are running sums within each input partition plus offsets of whole partitions."""

from __future__ import annotations

import json
import re
import sys
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierwell.llm.common import text_slices
from tierwell.llm.words import PieceEncoder, WordRanks, word_ranks
from tierwell.sources.shared import stored

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
WINDOW = 2048
STEP = 16
DEPTH = 3
END = 1
#: Bytes of text tokenised at once: the more, the more often a chunk is met again.
SLICE = 1 << 21
#: Chunks between white space a process remembers, and the longest of them.
CACHED = 500_000
LONGEST = 64


class ChunkEncoder:
    """Ids of texts by the tokenizer, which drops white space and joins nothing across it, so that
    each distinct chunk between white space is encoded once.

    Nor does it join letters to anything that follows them, and of Latin-1 text it only lowers the case.
    Such texts are lowered as a whole; chunks of plain characters without an apostrophe are put together
    from their runs of letters and the rest.  Words skip normalising and splitting, which change nothing.
    What has been encoded is remembered in two generations, so that frequent chunks stay when the older
    one is given up."""

    _SPACE = re.compile(r"[ \t-\r]+")
    #: In Python's white space but not in the tokenizer's.
    _ODD = re.compile("[\x1c-\x1f]")
    _WORD = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")
    _PLAIN = re.compile(r"[!-&(-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")
    _RUNS = re.compile(r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+|[^A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")

    def __init__(self, vocabulary: str, cached: int = CACHED):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole, self.letters = Tokenizer.from_str(vocabulary), Tokenizer.from_str(vocabulary)
        self.whole.encode_special_tokens = self.letters.encode_special_tokens = True
        self.letters.normalizer = None
        self.letters.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.dtype = "<u2" if self.whole.get_vocab_size() <= 1 << 16 else "<u4"
        self.cached = cached
        self.chunks: tuple[dict[str, bytes], dict[str, bytes]] = {}, {}
        self.runs: tuple[dict[str, bytes], dict[str, bytes]] = {}, {}

    def _encoded(self, tokenizer, texts: list[str]) -> dict[str, bytes]:
        out: dict[str, bytes] = {}
        kind = "H" if self.dtype == "<u2" else "I"
        for at in range(0, len(texts), 4096):
            own = texts[at : at + 4096]
            for text, found in zip(own, tokenizer.encode_batch_fast(own, add_special_tokens=False), strict=True):
                ids = array(kind, found.ids)
                if sys.byteorder == "big":
                    ids.byteswap()
                out[text] = ids.tobytes()
        return out

    def _recalled(self, memory: str, asked: set[str], learn: Callable[[list[str]], dict[str, bytes]]) -> dict[str, bytes]:
        """The ids of all asked for, from the memory or learned now."""
        young, old = getattr(self, memory)
        names = list(asked)
        local = dict(zip(names, map(young.get, names), strict=True))
        missing = [c for c, v in local.items() if v is None]
        again = {c: v for c in missing if (v := old.get(c)) is not None}
        fresh = again | learn([c for c in missing if c not in again])
        local |= fresh
        if len(young) + len(fresh) > self.cached // 2:
            young, old = {}, young
        young.update((c, v) for c, v in fresh.items() if len(c) <= LONGEST)
        setattr(self, memory, (young, old))
        return local

    def _learn_runs(self, runs: list[str]) -> dict[str, bytes]:
        letters = [r for r in runs if r.isalpha()]
        return self._encoded(self.letters, letters) | self._encoded(self.whole, [r for r in runs if not r.isalpha()])

    def _learn_chunks(self, chunks: list[str]) -> dict[str, bytes]:
        words = [c for c in chunks if self._WORD.fullmatch(c)]
        found = self._encoded(self.letters, words)
        parts = {c: self._RUNS.findall(low) for c in chunks if c not in found and len(c) <= LONGEST and self._PLAIN.fullmatch(low := c.lower())}
        runs = self._recalled("runs", set().union(*parts.values()), self._learn_runs)
        found |= {c: b"".join([runs[r] for r in p]) for c, p in parts.items()}
        return found | self._encoded(self.whole, [c for c in chunks if c not in found])

    def _chunks(self, text: str) -> list[str]:
        # An empty chunk, beside white space at an end, has no ids.
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            pass
        else:
            text = text.lower()
        return self._SPACE.split(text) if self._ODD.search(text) else text.split()

    def __call__(self, texts: list[str]) -> list[bytes]:
        parts = [self._chunks(t) for t in texts]
        ids = self._recalled("chunks", set().union(*parts), self._learn_chunks)
        return [b"".join(map(ids.__getitem__, p)) for p in parts]


# How a tokenizer has to normalise and split for its texts to be encoded piece by piece.
NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def splits_into_pieces(vocabulary: str) -> bool:
    """Whether ``ChunkEncoder`` and ``PieceEncoder`` hold for a tokenizer's file."""
    found = json.loads(vocabulary)
    before = (found.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    return (
        (found.get("normalizer") or {}).get("normalizers") == NORMALIZERS
        and len(before) == 2
        and before[0].get("pattern") == {"Regex": SPLIT}
        and (before[0].get("behavior"), before[0].get("invert")) == ("Removed", True)
        and (before[1].get("type"), before[1].get("add_prefix_space"), before[1].get("use_regex")) == ("ByteLevel", False, False)
        and not found.get("post_processor")
    )


class WholeEncoder:
    """Ids of whole texts by the tokenizer, for vocabularies of any kind."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.encode_special_tokens = True
        self.dtype = "<u4"

    def __call__(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class TextEncoder:
    """Ids of texts: by their pieces, odd chunks on their own."""

    def __init__(self, vocabulary: str, ranks: WordRanks):
        chunks = ChunkEncoder(vocabulary, cached=CACHED // 5)
        self.dtype = chunks.dtype

        def signs(pieces: list[str]) -> list[bytes]:
            found = chunks._encoded(chunks.whole, pieces)
            return [found[p] for p in pieces]

        self.pieces = PieceEncoder(ranks, self.dtype, signs, chunks)

    def __call__(self, texts: list[str]) -> list[bytes]:
        return self.pieces(texts)


@dataclass(frozen=True)
class Vocabulary:
    """A tokenizer's file, and what the driver has found out of it: whether texts can be encoded by pieces,
    and the ranks of plain words."""

    file: str
    pieces: bool
    ranks: WordRanks | None

    def encoder(self) -> WholeEncoder | ChunkEncoder | TextEncoder:
        if not self.pieces:
            return WholeEncoder(self.file)
        return TextEncoder(self.file, self.ranks) if self.ranks else ChunkEncoder(self.file)


def read_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        text = file.read()
    pieces = splits_into_pieces(text)
    return Vocabulary(text, pieces, word_ranks(text) if pieces else None)


_ENCODERS: dict[str, WholeEncoder | ChunkEncoder | TextEncoder] = {}


def _forget() -> None:
    """Give up what this process remembers, once its tasks no longer tokenise."""
    _ENCODERS.clear()


def _encoder(vocabulary: Vocabulary) -> WholeEncoder | ChunkEncoder | TextEncoder:
    if vocabulary.file not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[vocabulary.file] = vocabulary.encoder()
    return _ENCODERS[vocabulary.file]


def _tokenise(shared, window: int, step: int):
    """Each document with its ids, its partition and place there, and running numbers of the partition:
    full windows before it, and documents before it in its bin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        end = np.array([END], dtype=encoder.dtype).tobytes()
        part, at, full = TaskContext.get().partitionId(), 0, 0
        in_bin = np.zeros(window // step + 1, dtype=np.int64)
        for batch in batches:
            for start, texts in text_slices(batch.column("text"), SLICE):
                ids = [i + end for i in encoder(texts)]
                width = np.dtype(encoder.dtype).itemsize
                n = np.array([len(i) // width for i in ids], dtype=np.int64)
                bins = (n % window) // step
                rank = np.empty(len(n), dtype=np.int64)
                for k, b in enumerate(bins.tolist()):
                    rank[k] = in_bin[b]
                    in_bin[b] += 1
                windows = n // window
                before = full + np.cumsum(windows) - windows
                full += int(windows.sum())
                rows = np.arange(at, at + len(n))
                at += len(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").slice(start, len(texts)),
                        pa.array(np.full(len(n), part), pa.int32()),
                        pa.array(rows),
                        pa.array(n),
                        pa.array(before),
                        pa.array(bins, pa.int32()),
                        pa.array(rank),
                        pa.array(ids, pa.binary()),
                    ],
                    names=["row", "part", "at", "n", "full_before", "bin", "rank", "ids"],
                )

    return run


def combinations(units: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """All ascending combinations of 2 to ``depth`` bins, each at least 1, that add up to ``units``."""
    out: list[tuple[int, ...]] = []

    def extend(chosen: tuple[int, ...], left: int) -> None:
        if chosen and left >= chosen[-1]:
            out.append((*chosen, left))
        if len(chosen) + 2 <= depth:
            for b in range(chosen[-1] if chosen else 1, left // 2 + 1):
                extend((*chosen, b), left - b)

    extend((), units)
    return out


def non_negative_least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 with the least |a x - b|, by adding one column at a time and dropping those that turn negative."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], dtype=bool)
    limit = 1e-9 * max(1.0, np.abs(a.T @ b).max(initial=0.0))
    for _ in range(3 * len(b)):  # rounding down makes good use of any solution
        slope = a.T @ (b - a @ x)
        slope[active] = -np.inf
        if not len(slope) or slope.max() <= limit:
            break
        active[slope.argmax()] = True
        while active.any():
            own = np.flatnonzero(active)
            new = np.linalg.lstsq(a[:, own], b, rcond=None)[0]
            if (new > 0).all():
                x[:] = 0
                x[own] = new
                break
            falling = new <= 0
            old = x[own]
            share = np.min(old[falling] / np.maximum(old[falling] - new[falling], 1e-300))
            x[own] = old + share * (new - old)
            gone = own[(x[own] <= 1e-12) & falling]
            x[gone] = 0
            active[gone] = False
            if not len(gone):
                break
    return x


@dataclass(frozen=True)
class Plan:
    """For each bin its runs of ranks: first rank, end, first sequence, members of the bin in a sequence,
    place of the first of them.  For each combination used its first sequence and number of members;
    and the number of sequences."""

    runs: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    starts: np.ndarray
    size: np.ndarray
    sequences: int

    def place(self, bins: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sequence or -1, place in it, whether it is the last there) of each remainder."""
        sequence = np.full(len(bins), -1, dtype=np.int64)
        slot = np.zeros(len(bins), dtype=np.int64)
        last = np.zeros(len(bins), dtype=bool)
        for b, (first, stop, start, members, place) in self.runs.items():
            own = np.flatnonzero(bins == b)
            run = np.searchsorted(first, ranks[own], "right") - 1
            ok = (run >= 0) & (ranks[own] < stop[np.maximum(run, 0)])
            own, run = own[ok], run[ok]
            k = ranks[own] - first[run]
            sequence[own] = start[run] + k // members[run]
            slot[own] = place[run] + k % members[run]
            last[own] = slot[own] == self.size[np.searchsorted(self.starts, sequence[own], "right") - 1] - 1
        return sequence, slot, last


def plan(histogram: dict[int, int], units: int, depth: int = DEPTH) -> Plan:
    """How often each combination is used, rounded down and within what the histogram holds."""
    left = {b: n for b, n in histogram.items() if 0 < b < units and n > 0}
    usable = [c for c in combinations(units, depth) if all(b in left for b in c)]
    bins = sorted(left)
    row = {b: i for i, b in enumerate(bins)}
    a = np.zeros((len(bins), len(usable)))
    for j, c in enumerate(usable):
        for b in c:
            a[row[b], j] += 1
    x = non_negative_least_squares(a, np.array([left[b] for b in bins], dtype=float)) if usable else np.zeros(0)
    used = dict.fromkeys(bins, 0)
    runs: dict[int, list[tuple[int, int, int, int, int]]] = {b: [] for b in bins}
    starts, sizes, sequences = [], [], 0
    # Largest counts first; what rounding leaves over is taken in a second turn where it still fits.
    order = sorted(range(len(usable)), key=lambda j: (-x[j], usable[j]))
    for turn in (np.floor(x + 1e-6), np.ceil(x - 1e-6) - np.floor(x + 1e-6)):
        for j in order:
            c = usable[j]
            count = int(min(turn[j], *((left[b] - used[b]) // c.count(b) for b in set(c))))
            if count <= 0:
                continue
            for b in sorted(set(c)):
                m = c.count(b)
                runs[b].append((used[b], used[b] + count * m, sequences, m, c.index(b)))
                used[b] += count * m
            starts.append(sequences)
            sizes.append(len(c))
            sequences += count
    packed = {b: tuple(np.array(v, dtype=np.int64) for v in zip(*r, strict=True)) for b, r in runs.items() if r}
    return Plan(packed, np.array(starts, dtype=np.int64), np.array(sizes, dtype=np.int64), sequences)


def _placed(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _forget()
        for batch in batches:
            sequence, slot, last = shared.value.place(np.asarray(batch.column("bin")), np.asarray(batch.column("rank")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("part"), batch.column("at"), batch.column("start"), batch.column("length"), pa.array(sequence), pa.array(slot), pa.array(last)],
                names=["part", "at", "start", "length", "sequence", "slot", "last"],
            )

    return run


def _greedy(window: int, total: int):
    """Cuts rows of the greedy stream where windows end, the last window at powers of two."""
    whole = total // window
    powers = [1 << k for k in range(window.bit_length() - 1, -1, -1) if (total % window) >> k & 1]
    bounds = whole * window + np.concatenate(([0], np.cumsum(powers, dtype=np.int64))).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            columns = (batch.column(c).to_pylist() for c in ("part", "at", "start", "length", "position"))
            for part, at, start, length, position in zip(*columns, strict=True):
                here, end = position, position + length
                while here < end:
                    if here < bounds[0]:
                        number, low = here // window, here // window * window
                        high = low + window
                    else:
                        k = int(np.searchsorted(bounds, here, "right")) - 1
                        number, low, high = whole + k, int(bounds[k]), int(bounds[k + 1])
                    stop = min(end, high)
                    found.append((part, at, start + here - position, stop - here, number, here - low))
                    here = stop
            kinds = [pa.int32(), *[pa.int64()] * 5]
            values = list(zip(*found, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=["part", "at", "start", "length", "sequence", "offset"])

    return run


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a piece, with its ids."""
    _forget()
    for batch in batches:
        for begin in range(0, batch.num_rows, 256):
            part = batch.slice(begin, 256)
            ids, n = part.column("ids"), part.column("n").to_pylist()
            source, rows = [], []
            for i, pieces in enumerate(part.column("pieces").to_pylist()):
                body = ids[i].as_buffer()
                values = np.frombuffer(body, dtype="<u2" if body.size == 2 * n[i] else "<u4").astype("<u4")
                for p in pieces:
                    own = values[p["start"] : p["start"] + p["length"]].tobytes()
                    source.append(i)
                    rows.append((p["start"], p["length"], zlib.crc32(own), n[i], p["sequence"], p["offset"], own))
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            kinds = [pa.int64()] * 6 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [part.column("row").take(pa.array(source, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["row", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"],
            )


def _offsets(totals: DataFrame, value: str, name: str, *by: str) -> DataFrame:
    """Running sums over partitions, from one row a partition (and bin)."""
    order = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn(name, F.coalesce(F.sum(value).over(order), F.lit(0)))


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, window: int = WINDOW, step: int = STEP) -> DataFrame:
    """One row for each piece of each row of ``docs`` (doc_id, text): row (doc_id), start, length,
    ids_crc32, doc_tokens, sequence_id, offset, and the piece's ids (little-endian, 32 bits).

    A document's ids are its text's and END.  A null or empty text has END alone.  Pieces of a document
    cover each id once; offsets in a sequence have no gaps.  Every sequence is full, except at most one
    for each power of two below the window.  Repeated rows are packed each; ids of documents may be null
    or repeated; further columns are not looked at; no documents give no pieces."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(read_vocabulary(vocabulary))
    own = docs.select(F.struct("doc_id").alias("row"), "text")
    kind = own.schema["row"].dataType.simpleString()
    tokens = stored(own.mapInArrow(_tokenise(shared, window, step), f"row {kind}, part int, at long, n long, full_before long, bin int, rank long, ids binary"), "tokens")
    light = tokens.select("part", "at", "n", "full_before", "bin", "rank")
    # One row a partition and bin.
    per_bin = stored(light.groupBy("part", "bin").agg(F.count("*").alias("docs"), F.sum(F.floor(F.col("n") / window)).alias("full")), "partition-bins")
    histogram = {r["bin"]: r["docs"] for r in per_bin.groupBy("bin").agg(F.sum("docs").alias("docs")).collect()}
    found = plan(histogram, window // step)
    planned = spark.sparkContext.broadcast(found)
    starts = _offsets(per_bin.select("part", "bin", "docs"), "docs", "docs_before", "bin").select("part", "bin", "docs_before")
    remainder = F.col("n") % window
    ranked = light.join(starts, ["part", "bin"]).select(
        "part", "at", (F.col("n") - remainder).alias("start"), remainder.alias("length"), "bin", (F.col("rank") + F.col("docs_before")).alias("rank")
    )
    placed = stored(
        ranked.where("length > 0").mapInArrow(_placed(planned), "part int, at long, start long, length long, sequence long, slot long, last boolean"), "placed"
    )
    in_sequence = Window.partitionBy("sequence").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    planned_rows = placed.where("sequence >= 0").withColumn("offset", F.coalesce(F.sum("length").over(in_sequence), F.lit(0)))
    fit = F.when(F.col("last"), F.lit(window) - F.col("offset")).otherwise(F.col("length"))
    planned_rows = stored(planned_rows.select("part", "at", "start", "length", fit.alias("fit"), "sequence", "offset"), "planned")
    inner = planned_rows.select("part", "at", "start", F.col("fit").alias("length"), "sequence", "offset")
    tails = planned_rows.where("length > fit").select("part", "at", (F.col("start") + F.col("fit")).alias("start"), (F.col("length") - F.col("fit")).alias("length"))
    loose = placed.where("sequence < 0").select("part", "at", "start", "length").unionByName(tails)
    loose_before = _offsets(loose.groupBy("part").agg(F.sum("length").alias("ids")), "ids", "ids_before")
    total = loose.agg(F.sum("length").alias("n")).first()["n"] or 0
    running = Window.partitionBy("part").orderBy("at", "start").rowsBetween(Window.unboundedPreceding, -1)
    stream = (
        loose.withColumn("before", F.coalesce(F.sum("length").over(running), F.lit(0)))
        .join(loose_before.select("part", "ids_before"), "part")
        .select("part", "at", "start", "length", (F.col("before") + F.col("ids_before")).alias("position"))
    )
    greedy = stream.mapInArrow(_greedy(window, total), "part int, at long, start long, length long, sequence long, offset long")
    n_full = per_bin.agg(F.sum("full").alias("n")).first()["n"] or 0
    full_before = _offsets(per_bin.groupBy("part").agg(F.sum("full").alias("full")), "full", "windows_before").select("part", "windows_before")
    numbers = F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("n") / window) - 1))
    full = (
        light.where(F.col("n") >= window)
        .join(full_before, "part")
        .select("part", "at", (F.col("full_before") + F.col("windows_before") + found.sequences).alias("first"), numbers.alias("k"))
        .select("part", "at", (F.col("k") * window).alias("start"), F.lit(window).cast("long").alias("length"), (F.col("first") + F.col("k")).alias("sequence"), F.lit(0).cast("long").alias("offset"))
    )
    greedy = greedy.withColumn("sequence", F.col("sequence") + found.sequences + n_full)
    pieces = inner.unionByName(full).unionByName(greedy).groupBy("part", "at").agg(F.collect_list(F.struct("start", "length", "sequence", "offset")).alias("pieces"))
    joined = tokens.select("row", "part", "at", "n", "ids").join(pieces.hint("shuffle_hash"), ["part", "at"]).select("row", "n", "ids", "pieces")
    return joined.mapInArrow(_pieces, f"row {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary")


def digest(packed: DataFrame) -> DataFrame:
    """The pieces without their ids."""
    return packed.select("row.doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
