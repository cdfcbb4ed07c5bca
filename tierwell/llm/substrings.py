"""Removal of repeated substrings by prefix-free parsing.

The repeats looked for are strings of ``length`` bytes.  Every place where one begins has a trigger:
of the grams inside its string the one with the least rolling hash, the leftmost if equal.  Places
that follow one another and share a trigger make a phrase, the bytes of all their strings.  Triggers
depend on the string alone, so equal strings have the same trigger at the same distance, wherever
they stand: all that may be equal meets under the trigger's gram.  Phrases overlap by the string's
length, so the dictionary of distinct phrases holds every string whole.

A phrase that occurs twice is repeated entirely; on highly repetitive text that settles nearly all
of it by counting hashes.  Other phrases that share a trigger go on with their bytes.  Their texts
left of the trigger, sorted from its end (suffixes of the dictionary), and right of it (suffixes of
the parse) give two orders with longest common prefixes; a string is repeated just if another phrase
falls into the same class in both orders, at the depths to which it reaches left and right."""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwell.sources.shared import fresh_path, remove, stored

LENGTH = 400
GRAM = 48
#: Shortest passage that drop_repeats and op6's passage columns take for a repeat, in words, and the bytes of a word's hash.
WORDS = 51
TOKEN = 4
#: Bytes parsed at once.
CHUNK = 1 << 19
#: Distinct phrases of one trigger that are compared in memory; beyond, strings are grouped by Spark.
GROUP = 40_000
#: Up to so many phrases are compared pair by pair.
PAIRS = 16

_BASE = np.uint64(0xD6E8FEB86659FD93)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.uint64((1 << 24) - 1)
_BYTES = np.random.default_rng(42).integers(0, 1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def rolling(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes from each place, put together from powers of two."""
    n = len(data) - gram + 1
    part, size, factor = _BYTES[data], 1, _BASE
    out, done = None, 0
    while True:
        if gram & size:
            piece = part[done : done + n]
            out = piece.copy() if out is None else out * factor + piece
            done += size
        if size * 2 > gram:
            break
        part = part[:-size] * factor + part[size:]
        size, factor = size * 2, np.uint64(int(factor) * int(factor) & 0xFFFFFFFFFFFFFFFF)
    out ^= out >> np.uint64(32)
    out *= _MIX
    out ^= out >> np.uint64(29)
    return out


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of ``width`` values from each place on."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def phrases(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text number, first place, last place, trigger's place, trigger's hash) of all phrases of texts
    that stand one after another and end at ``ends``."""
    none = np.zeros(0, dtype=np.int64)
    if len(data) < length:
        return none, none, none, none, none
    hashed = rolling(data, gram)
    packed = (hashed & ~_PLACE) | np.arange(len(hashed), dtype=np.uint64)
    trigger = (sliding_min(packed, length - gram + 1) & _PLACE).astype(np.int64)
    places = np.arange(len(trigger))
    text = np.searchsorted(ends, places, "right")
    inside = np.flatnonzero(places + length <= ends[text])
    if not len(inside):
        return none, none, none, none, none
    text, trigger = text[inside], trigger[inside]
    starts = np.flatnonzero(np.concatenate(([True], (np.diff(trigger) != 0) | (np.diff(text) != 0) | (np.diff(inside) != 1))))
    stops = np.concatenate((starts[1:], [len(inside)])) - 1
    at = trigger[starts]
    return text[starts], inside[starts], inside[stops], at, hashed[at].view(np.int64)


_PARSED = "known boolean, doc long, print long, first long, last long, at long, key long, phrase long, weight long"


def _parse(length: int, gram: int):
    """The phrases of every text as rows.  What repeats within a chunk is known to be repeated at once
    (``known``, phrases that follow one another joined) and is counted in one row."""
    fields = [f.split() for f in _PARSED.split(", ")]
    kinds = {"boolean": pa.bool_(), "long": pa.int64()}

    def rows(known, docs, prints, texts, offsets, first, last, at, key, phrase, weight) -> pa.RecordBatch:
        columns = [np.full(len(texts), known), docs[texts], prints[texts], offsets[texts] + first, offsets[texts] + last, at, key, phrase, weight]
        return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])

    def chunk(parts: list[tuple[int, int, int, bytes]]) -> Iterator[pa.RecordBatch]:
        docs, prints, offsets = (np.array([p[k] for p in parts], dtype=np.int64) for k in range(3))
        whole = b"".join(p[3] for p in parts)
        ends = np.cumsum([len(p[3]) for p in parts])
        begins = ends - np.array([len(p[3]) for p in parts])
        text, first, last, at, key = phrases(np.frombuffer(whole, dtype=np.uint8), ends, length, gram)
        if not len(text):
            return
        view, digest = memoryview(whole), xxhash.xxh3_64_intdigest
        phrase = np.fromiter((digest(view[a:b]) for a, b in zip(first.tolist(), (last + length).tolist(), strict=True)), dtype=np.uint64, count=len(first)).view(np.int64)
        _, one, inverse, count = np.unique(key ^ (phrase * np.int64(3)), return_index=True, return_inverse=True, return_counts=True)
        start, stop, distance = first - begins[text], last - begins[text], at - first
        yield rows(False, docs, prints, text[one], offsets, start[one], stop[one], distance[one], key[one], phrase[one], count)
        twice = np.flatnonzero(count[inverse] > 1)
        if len(twice):
            t, a, b = text[twice], start[twice], stop[twice]
            new = np.flatnonzero(np.concatenate(([True], (np.diff(t) != 0) | (a[1:] > b[:-1] + 1))))
            end = np.concatenate((new[1:], [len(t)])) - 1
            zero = np.zeros(len(new), dtype=np.int64)
            yield rows(True, docs, prints, t[new], offsets, a[new], b[end], zero, zero, zero, zero)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[tuple[int, int, int, bytes]] = []
            size = 0
            for i, (doc, mark) in enumerate(zip(batch.column("doc").to_pylist(), batch.column("print").to_pylist(), strict=True)):
                text = batch.column("text")[i].as_buffer()
                if text is None or text.size < length:
                    continue
                for offset in range(0, text.size - length + 1, CHUNK):
                    part = bytes(memoryview(text)[offset : offset + CHUNK + length - 1])
                    held.append((doc, mark, offset, part))
                    size += len(part)
                    if size >= CHUNK:
                        yield from chunk(held)
                        held, size = [], 0
            if held:
                yield from chunk(held)

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the phrases asked for of each text."""
    for batch in batches:
        texts, asked = batch.column("text"), batch.column("asked")
        for begin in range(0, batch.num_rows, 64):
            out = []
            for i in range(begin, min(begin + 64, batch.num_rows)):
                text = memoryview(texts[i].as_buffer())
                doc, mark = batch.column("doc")[i].as_py(), batch.column("print")[i].as_py()
                for a in asked[i].as_py():
                    out.append((a["key"], doc, mark, a["first"], a["at"], a["single"], a["many"], bytes(text[a["first"] : a["last"] + a["length"]])))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary()]
            columns = list(zip(*out, strict=True)) or [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["key", "doc", "print", "first", "at", "single", "many", "body"])


def _common(a: bytes, b: bytes) -> int:
    """The length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return n - ((int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])).bit_length() + 7) // 8


def repeated(bodies: list[bytes], at: list[int], length: int = LENGTH, pairs: int = PAIRS) -> list[np.ndarray]:
    """For each phrase, given its trigger's distance from its start, whether each of its strings also
    stands in another phrase at the same distance from the trigger."""
    n = len(bodies)
    out = [np.zeros(len(b) - length + 1, dtype=bool) for b in bodies]
    left = [b[:k][::-1] for b, k in zip(bodies, at, strict=True)]
    right = [b[k:] for b, k in zip(bodies, at, strict=True)]
    if n <= pairs:
        for i, j in itertools.combinations(range(n), 2):
            before, after = _common(left[i], left[j]), _common(right[i], right[j])
            if before + after >= length:
                for k in (i, j):
                    out[k][at[k] - before : at[k] - max(0, length - after) + 1] = True
        return out

    def order(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(place of each part in sorted order, common prefix of each place with the one before)."""
        by = sorted(range(n), key=parts.__getitem__)
        place = np.empty(n, dtype=np.int64)
        place[by] = np.arange(n)
        return place, np.array([-1] + [_common(parts[a], parts[b]) for a, b in itertools.pairwise(by)])

    (left_place, left_common), (right_place, right_common) = order(left), order(right)
    reach, ahead = np.array(at), np.array([len(r) for r in right])
    for distance in range(int(reach.max()) + 1):
        has = np.flatnonzero((reach >= distance) & (ahead >= length - distance))
        if len(has) < 2:
            continue
        l_class = np.cumsum(left_common < distance)[left_place[has]]
        r_class = np.cumsum(right_common < length - distance)[right_place[has]]
        _, inverse, count = np.unique(l_class * (n + 1) + r_class, return_inverse=True, return_counts=True)
        for k in has[count[inverse] > 1].tolist():
            out[k][at[k] - distance] = True
    return out


def _spans(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return [(a, b - 1) for a, b in edge.reshape(-1, 2).tolist()]


def _compare(length: int):
    """Repeated places of the phrases that occur once, from rows sorted by trigger."""

    def group(rows: list[tuple]) -> Iterator[tuple]:
        seen: dict[tuple[int, bytes], tuple] = {(r[3], r[5]): r for r in rows}
        own = list(seen.values())
        if len(own) > 1:
            for r, flags in zip(own, repeated([r[5] for r in own], [r[3] for r in own], length), strict=True):
                if r[4]:
                    for a, b in _spans(flags):
                        yield r[0], r[1], r[2] + a, r[2] + b

    def table(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in range(4)], names=["doc", "print", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[int, tuple]]:
            for batch in batches:
                for begin in range(0, batch.num_rows, 512):
                    part = batch.slice(begin, 512)
                    yield from zip(
                        part.column("key").to_pylist(),
                        zip(*(part.column(c).to_pylist() for c in ("doc", "print", "first", "at", "single", "body")), strict=True),
                        strict=True,
                    )

        found: list[tuple] = []
        for _, own in itertools.groupby(rows(), key=lambda r: r[0]):
            found += group([r for _, r in own])
            if len(found) > 8192:
                yield table(found)
                found = []
        yield table(found)

    return run


def _strings(length: int):
    """Every string of the phrases as a 128-bit hash with its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                body = memoryview(batch.column("body")[i].as_buffer())
                doc, mark, first = (batch.column(c)[i].as_py() for c in ("doc", "print", "first"))
                n = len(body) - length + 1
                digests = [xxhash.xxh3_128_digest(body[k : k + length]) for k in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digests, pa.binary()), pa.array([doc] * n, pa.int64()), pa.array([mark] * n, pa.int64()), pa.array(range(first, first + n), pa.int64())],
                    names=["digest", "doc", "print", "first"],
                )

    return run


def repeated_places(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP, folder: str | None = None) -> DataFrame:
    """(doc, print, first, last): runs of places where a string of ``length`` bytes begins that also
    begins elsewhere, for ``texts`` (doc, print, text).  Its tables are stored below ``folder``, if given."""
    parsed = stored(texts.where(F.octet_length("text") >= length).mapInArrow(_parse(length, gram), _PARSED), "phrases", folder)
    place = ["doc", "print", "first", "last"]
    once = parsed.where(~F.col("known")).drop("known")
    # Written, so that the join below deals out both of its sides itself and can split a hot trigger.
    triggers = stored(
        once.groupBy("key")
        .agg(F.sum("weight").alias("total"), F.min("phrase").alias("low"), F.max("phrase").alias("high"))
        .where(F.col("total") > 1)
        .select("key", (F.col("low") != F.col("high")).alias("mixed")),
        "triggers",
        folder,
    )
    shared = stored(once.join(triggers, "key"), "shared-triggers", folder)
    mixed = shared.where("mixed")
    entries = stored(
        mixed.groupBy("key", "phrase").agg(F.sum("weight").alias("total"), F.min(F.struct(*place, "at")).alias("one")).select("key", "phrase", "one.*", (F.col("total") == 1).alias("single")),
        "dictionary",
        folder,
    )
    again = mixed.join(entries.where(~F.col("single")).select("key", "phrase"), ["key", "phrase"], "left_semi")
    open_keys = entries.groupBy("key").agg(F.max("single").alias("open"), (F.count("*") > group).alias("many")).where("open").select("key", "many")
    asked = (
        entries.join(open_keys, "key")
        .groupBy("doc", "print")
        .agg(F.collect_list(F.struct("key", "first", "last", "at", "single", "many", F.lit(length).alias("length"))).alias("asked"))
    )
    bodies = stored(
        texts.join(asked.hint("shuffle_hash"), ["doc", "print"]).select("doc", "print", "text", "asked").mapInArrow(_cut, "key long, doc long, print long, first long, at long, single boolean, many boolean, body binary"),
        "phrase-bodies",
        folder,
    )
    by_key = bodies.where(~F.col("many")).repartition("key").sortWithinPartitions("key")
    compared = by_key.mapInArrow(_compare(length), "doc long, print long, first long, last long")
    strings = bodies.where("many").mapInArrow(_strings(length), "digest binary, doc long, print long, first long")
    common = strings.select("digest", "doc", "print", "first").distinct().groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
    wide = strings.join(common, "digest", "left_semi").select("doc", "print", "first", F.col("first").alias("last"))
    parts = [parsed.where("known").select(*place), shared.where(~F.col("mixed")).select(*place), again.select(*place), compared, wide]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _settled(texts: DataFrame, length: int, gram: int, group: int, by_words: bool = False) -> DataFrame:
    """``repeated_places``, written; the tables it needed meanwhile are deleted, so that two searches don't hold theirs at once."""
    folder = fresh_path(texts.sparkSession, "repeats")
    if by_words:
        texts, length = _word_hashes(texts, folder), length * TOKEN
    places = stored(repeated_places(texts, length, gram, group, folder), "places")
    remove(texts.sparkSession, folder)
    return places


def _covered(places: list[dict], length: int) -> list[tuple[int, int]]:
    """Merged [start, stop) byte runs of the strings that begin at the places."""
    out: list[list[int]] = []
    for a, b in sorted((p["first"], p["last"] + length) for p in places):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


_WORD = re.compile(rb"\S+")


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text as the hashes of its words, TOKEN bytes each."""
    digest = xxhash.xxh3_64_digest
    for batch in batches:
        for begin in range(0, batch.num_rows, 256):
            part = batch.slice(begin, 256)
            found = [b"".join([digest(w)[:TOKEN] for w in bytes(t.as_buffer() or b"").split()]) for t in part.column("text")]
            yield pa.RecordBatch.from_arrays([part.column("doc"), part.column("print"), pa.array(found, pa.binary())], names=["doc", "print", "text"])


def _word_hashes(texts: DataFrame, folder: str | None = None) -> DataFrame:
    return stored(texts.mapInArrow(_tokens, "doc long, print long, text binary"), "word-hashes", folder)


def _bytes_of_words(body: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of token bytes as runs of the text's bytes, from the first word's start to the last one's end."""
    if not runs:
        return []
    words = [m.span() for m in _WORD.finditer(body)]
    whole = [(-(-a // TOKEN), b // TOKEN) for a, b in runs]
    return [(words[a][0], words[b - 1][1]) for a, b in whole if a < b]


def _remove(length: int, as_text: bool, by_words: bool = False, passages: int = 0):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def shown(kept: list[bytes]) -> pa.Array:
        return pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()) if as_text else pa.array(kept, pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                kept, sizes, spans, found = [], [], [], []
                for text, places in zip(part.column("text"), part.column("places").to_pylist(), strict=True):
                    body = memoryview(text.as_buffer() or b"")
                    runs = _covered(places or [], length)
                    if by_words:
                        runs = _bytes_of_words(bytes(body), runs)
                    edges = [0, *itertools.chain.from_iterable(runs), len(body)]
                    kept.append(b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                    sizes.append(len(body))
                    spans.append([{"start": a, "stop": b} for a, b in runs])
                keep = [c for c in part.schema.names if c not in ("text", "places", "worded")]
                columns, names = [*(part.column(c) for c in keep), pa.array(sizes, pa.int64()), shown(kept), pa.array(spans, kind)], [*keep, "n_bytes", "kept", "spans"]
                if passages:
                    for text, worded in zip(part.column("text"), part.column("worded").to_pylist(), strict=True):
                        runs = _bytes_of_words(bytes(text.as_buffer() or b""), _covered(worded, passages * TOKEN)) if worded else []
                        found.append([{"start": a, "stop": b} for a, b in runs])
                    columns, names = [*columns, pa.array(found, kind)], [*names, "passages"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP, as_text: bool = False, by_words: bool = False, passages: int = 0) -> DataFrame:
    """row (all columns of ``docs`` but text, as a struct), missing (text is null), n_bytes, kept (the bytes left), spans (removed
    [start, stop) runs) for every row of ``docs`` (doc_id, text, ...).

    Every byte under a string of ``length`` UTF-8 bytes that also begins elsewhere, in any row or the
    same one, is removed, all occurrences alike; strings are judged on the input.  With ``as_text`` the
    bytes left come as text, without those that are no whole character.  Texts shorter than
    that, null and empty ones stay as they are (null as empty).  Repeated rows repeat each other.
    Ids may be null or repeated; further columns are carried along whatever their names.  ``by_words``:
    strings are ``length`` words, whatever the blanks between them; words are compared by hashes of
    TOKEN bytes, so two strings that differ in one word are taken for equal once in 2**32 times.

    With ``passages`` a further column of that name holds the [start, stop) byte runs of repeated passages
    of so many words or more, found by words as above; they are reported, not removed."""
    row = F.struct(*[docs[c] for c in docs.columns if c != "text"]).alias("row")
    own = docs.select(row, F.col("text").isNull().alias("missing"), F.xxhash64("doc_id").alias("doc"), F.xxhash64("text").alias("print"), F.col("text").alias("text"))
    texts = own.select("doc", "print", "text")
    if by_words:
        texts, length = _word_hashes(texts), length * TOKEN
    if passages:
        lists = {"places": _settled(texts, length, gram, group), "worded": _settled(own.select("doc", "print", "text"), passages, gram, group, by_words=True)}
    else:
        lists = {"places": repeated_places(texts, length, gram, group)}
    marked = reduce(DataFrame.unionByName, [found.withColumn("list", F.lit(name)) for name, found in lists.items()])
    by_text = marked.groupBy("doc", "print").agg(*(F.collect_list(F.when(F.col("list") == name, F.struct("first", "last"))).alias(name) for name in lists))
    joined = own.join(by_text.hint("shuffle_hash"), ["doc", "print"], "left").select("row", "missing", "text", *lists)
    kind, runs = own.schema["row"].dataType.simpleString(), "array<struct<start:long,stop:long>>"
    schema = f"row {kind}, missing boolean, n_bytes long, kept {'string' if as_text else 'binary'}, spans {runs}"
    return joined.mapInArrow(_remove(length, as_text, by_words, passages), f"{schema}, passages {runs}" if passages else schema)


def digest(removed: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the text that is left; a character cut in
    two is shown as U+FFFD there.  Where repeated passages were looked for, n_passages and
    n_passage_bytes, their number and bytes in the text, whether removed or not."""
    found = [F.size("passages").cast("long").alias("n_passages"), F.aggregate("passages", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"]).alias("n_passage_bytes")]
    return removed.select(
        "row.doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),
        *(found if "passages" in removed.columns else []),
    )


def drop_repeats(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """The rows of ``docs`` without the passages of ``words`` words or more that repeat, all columns kept;
    words stand between blanks, ``n_chars`` follows where there is one, null texts stay null."""
    left = F.when(~F.col("missing"), F.col("kept"))
    texts = remove_repeats(docs, words, as_text=True, by_words=True).select("row", left.alias("text"))
    columns = [F.col("text") if c == "text" else F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col("row")[c].alias(c) for c in docs.columns]
    return texts.select(*columns)
