"""Byte-level BPE: encoding by ranks, with vectorised pre-tokenisation, and decoding.

Pre-tokenisation reads code points as classes and finds boundaries with a finite automaton.  Each
class is a function from state to state; these functions compose associatively, so blocks of the
text are composed side by side, a prefix scan over the blocks gives every block its first state, and
a second pass gives every character its boundary.  No regular expression runs over a text.

Slices between boundaries are merged once each: a process keeps the ids of slices it has seen, up
to a bound, and merges a batch's new slices together, a numpy row a slice."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwell.llm.common import text_slices

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Characters encoded at once.
BLOCK = 1 << 19
#: Slices a process remembers; then it starts anew.
CACHED = 200_000
#: Longer slices are merged one by one with a heap.
LONG = 200

LETTER, NUMBER, OTHER, SHORT, WIDE, BLANK, GAP, RUN, RESET = range(9)
"""Classes: letter; number; other; apostrophe before s, t, m or d; apostrophe before re, ve or ll;
last blank of white space before something else; last other white space there; white space before
white space or the end; between texts."""

START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_RUN, AFTER_BLANK, ONE_MORE, TWO_MORE = range(8)
_FIRST = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, SHORT: ONE_MORE, WIDE: TWO_MORE, BLANK: AFTER_BLANK, GAP: START, RUN: IN_RUN, RESET: START}


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state, and whether a slice begins at the character, by state and class."""
    state = np.array([[_FIRST[c] for c in range(9)] for _ in range(8)], dtype=np.uint8)
    cut = np.ones((8, 9), dtype=bool)
    joins = [(IN_LETTERS, LETTER), (IN_NUMBERS, NUMBER), (IN_RUN, RUN), (AFTER_BLANK, LETTER), (AFTER_BLANK, NUMBER)]
    joins += [(s, c) for s in (IN_OTHERS, AFTER_BLANK) for c in (OTHER, SHORT, WIDE)]
    for s, c in joins:
        cut[s, c] = False
        state[s, c] = IN_OTHERS if c in (SHORT, WIDE) else _FIRST[c]
    for s, after in ((ONE_MORE, START), (TWO_MORE, ONE_MORE)):
        cut[s, LETTER], state[s, LETTER] = False, after
    return state.ravel(), cut.ravel()


NEXT, CUT = _automaton()
_PLAIN: list[np.ndarray] = []


def _plain_classes() -> np.ndarray:
    """LETTER, NUMBER, RUN (white space) or OTHER by code point; made once in a process."""
    if not _PLAIN:
        table = np.full(0x110000, OTHER, dtype=np.uint8)
        points = np.concatenate((np.arange(0xD800), np.arange(0xE000, 0x110000)))
        every = points.astype("<u4").tobytes().decode("utf-32-le")
        for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\p{White_Space}+", RUN)):
            for m in regex.finditer(pattern, every):
                table[points[m.start() : m.end()]] = kind
        _PLAIN.append(table)
    return _PLAIN[0]


def classes(codes: np.ndarray, reset: np.ndarray) -> np.ndarray:
    """The automaton's class of each code point, looking at most two ahead."""
    kind = _plain_classes()[codes]
    space = kind == RUN
    kind[reset] = RESET
    space[reset] = False
    after = np.append(kind[1:], np.uint8(RESET))
    last = space & (after != RUN) & (after != RESET)
    kind[last] = np.where(codes[last] == 32, BLANK, GAP)
    marks = np.flatnonzero((codes == 39) & ~reset)
    if len(marks):
        wide = np.concatenate((np.where(reset, 0, codes), np.zeros(2, dtype=codes.dtype)))
        one, two = wide[marks + 1], wide[marks + 2]
        kind[marks[np.isin(one, [ord(c) for c in "stmd"])]] = SHORT
        pairs = one.astype(np.int64) * 128 + np.minimum(two, 127)
        kind[marks[np.isin(pairs, [ord(a) * 128 + ord(b) for a, b in ("re", "ve", "ll")])]] = WIDE
    return kind


def boundaries(kind: np.ndarray) -> np.ndarray:
    """Whether a slice begins at each character, by a blocked scan of composed transitions."""
    n = len(kind)
    if not n:
        return np.zeros(0, dtype=bool)
    lanes = max(1, min(4096, n // 64))
    steps = -(-n // lanes)
    padded = np.full(lanes * steps, RESET, dtype=np.uint8)
    padded[:n] = kind
    by_step = np.ascontiguousarray(padded.reshape(lanes, steps).T)
    # Every block's function, as its values for all states.
    whole = np.repeat(np.arange(8, dtype=np.uint8)[:, None], lanes, axis=1)
    for row in by_step:
        whole = NEXT[whole * np.uint8(9) + row]
    # Prefix composition over the blocks by doubling.
    width = 1
    while width < lanes:
        later = np.take_along_axis(whole[:, width:], whole[:, :-width].astype(np.int64), axis=0)
        whole = np.concatenate((whole[:, :width], later), axis=1)
        width *= 2
    state = np.concatenate((np.array([START], dtype=np.uint8), whole[START, :-1]))
    begins = np.empty((steps, lanes), dtype=bool)
    for j, row in enumerate(by_step):
        at = state * np.uint8(9) + row
        begins[j], state = CUT[at], NEXT[at]
    return begins.T.ravel()[:n]


def slices(texts: Sequence[str]) -> tuple[list[str], np.ndarray]:
    """All slices of the texts in order, and how many each text has."""
    joined = "\0".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    reset = np.zeros(len(codes), dtype=bool)
    reset[ends[:-1]] = True
    starts = np.flatnonzero(boundaries(classes(codes, reset)))
    stops = np.append(starts[1:], len(codes))
    own = ~reset[starts]
    starts, stops = starts[own], stops[own]
    counts = np.bincount(np.searchsorted(ends, starts), minlength=len(texts))
    return [joined[a:b] for a, b in zip(starts.tolist(), stops.tolist(), strict=True)], counts


def long_slices(text: str, block: int = BLOCK) -> Iterator[list[str]]:
    """The slices of one text, block by block; a block ends where a slice surely does."""
    at, size = 0, block
    while at < len(text):
        found, _ = slices([text[at : at + size]])
        if at + size < len(text):
            taken, kept = 0, 0
            for s in found:
                if taken + len(s) > size - 4:
                    break
                taken, kept = taken + len(s), kept + 1
            if not kept:
                size *= 2
                continue
            found, at, size = found[:kept], at + taken, block
        else:
            at = len(text)
        yield found


def _ranks(lines: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines.splitlines() if line)}


class Tokens:
    """The bytes of all ids, joined, with the start and size of each."""

    def __init__(self, rank: dict[bytes, int]):
        tokens = [b""] * (max(rank.values()) + 1)
        for token, number in rank.items():
            tokens[number] = token
        self.sizes = np.array([len(t) for t in tokens], dtype=np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))[:-1]
        self.joined = np.frombuffer(b"".join(tokens), dtype=np.uint8)


class Vocabulary:
    def __init__(self, lines: bytes):
        self.rank = _ranks(lines)
        self.single = np.array([self.rank[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = sorted(
            (self.rank[t[:k]] << 32 | self.rank[t[k:]], r) for t, r in self.rank.items() for k in range(1, len(t)) if t[:k] in self.rank and t[k:] in self.rank
        )
        self._table(np.array([k for k, _ in pairs], dtype=np.int64), np.array([r for _, r in pairs], dtype=np.int32))
        self.sizes = Tokens(self.rank).sizes

    NONE = (1 << 31) - 1
    _MIX = np.uint64(0x9E3779B97F4A7C15)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * self._MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _table(self, keys: np.ndarray, values: np.ndarray) -> None:
        """An open hash table of the pairs; ``probes`` places hold any key."""
        self.bits = max(4, int(len(keys) * 4).bit_length())
        self.table_keys = np.full((1 << self.bits) + 64, -1, dtype=np.int64)
        self.table_values = np.full(len(self.table_keys), self.NONE, dtype=np.int32)
        self.probes, left, place = 0, np.arange(len(keys)), self._slot(keys)
        while len(left):
            at = place[left] + self.probes
            free = self.table_keys[at] == -1
            _, first = np.unique(at, return_index=True)
            take = np.zeros(len(left), dtype=bool)
            take[first] = True
            take &= free
            self.table_keys[at[take]], self.table_values[at[take]] = keys[left[take]], values[left[take]]
            left = left[~take]
            self.probes += 1
            if self.probes > 60:
                raise ValueError("the pairs of the vocabulary don't spread over the table")

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair's union, NONE if there is none (also where a side is negative)."""
        shape = left.shape
        keys = ((left.astype(np.int64) << 32) | right).ravel()
        place = self._slot(keys)
        found = self.table_keys[place]
        out = np.where(found == keys, self.table_values[place], self.NONE)
        open_ = np.flatnonzero((found != keys) & (found != -1))
        for k in range(1, self.probes):
            if not len(open_):
                break
            found = self.table_keys[place[open_] + k]
            hit = found == keys[open_]
            out[open_[hit]] = self.table_values[place[open_[hit]] + k]
            open_ = open_[~hit & (found != -1)]
        return np.where((left >= 0) & (right >= 0), out.reshape(shape), self.NONE)

    def merge_rows(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each word, at most 255 bytes; the lowest pair of every word is merged in each
        round, the leftmost first.  A word is a column; row p holds what begins at byte p: its token,
        where the next and the former begin, and the rank of the pair it begins, with p below."""
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        n, height = len(words), int(sizes.max()) + 1
        place = np.arange(height)[:, None]
        token = np.full((height, n), -1, dtype=np.int32)
        inside = place < sizes
        token.T[inside.T] = self.single[np.frombuffer(b"".join(words), dtype=np.uint8)]
        after = np.broadcast_to(np.minimum(place + 1, height - 1), (height, n)).astype(np.uint8)
        before = np.broadcast_to(np.maximum(place - 1, 0), (height, n)).astype(np.uint8)

        def packed(rank: np.ndarray, at: np.ndarray) -> np.ndarray:
            return np.where(rank == self.NONE, self.NONE, rank.astype(np.int64) * 256 + at)

        pair = np.full((height, n), self.NONE, dtype=np.int64)
        pair[:-1] = packed(self.merged(token[:-1], token[1:]), place[:-1])
        out: list[np.ndarray] = [np.zeros(0, dtype=np.int32)] * n
        alive = np.arange(n)
        while len(alive):
            low = pair.min(axis=0)
            todo = np.flatnonzero(low != self.NONE)
            if len(todo) <= len(alive) // 2:
                done = np.flatnonzero(low == self.NONE)
                rows = token[:, done].T
                flat, ends = rows[rows >= 0], np.cumsum((rows >= 0).sum(axis=1)).tolist()
                for i, a, b in zip(alive[done].tolist(), [0, *ends[:-1]], ends, strict=True):
                    out[i] = flat[a:b]
                alive, token, after, before, pair, low = (x[..., todo] for x in (alive, token, after, before, pair, low))
                todo = np.arange(len(alive))
            at, rank = low[todo] & 255, low[todo] >> 8
            gone = after[at, todo].astype(np.int64)
            beyond = after[gone, todo].astype(np.int64)
            token[at, todo], token[gone, todo] = rank, -1
            pair[gone, todo] = self.NONE
            after[at, todo], before[beyond, todo] = beyond, at
            pair[at, todo] = packed(self.merged(token[at, todo], token[beyond, todo]), at)
            inner = np.flatnonzero(at > 0)
            own, col = at[inner], todo[inner]
            prior = before[own, col].astype(np.int64)
            pair[prior, col] = packed(self.merged(token[prior, col], token[own, col]), prior)
        return out

    def merge_long(self, word: bytes) -> np.ndarray:
        """The ids of one word, with a heap of pairs."""
        n = len(word)
        piece: list[bytes | None] = [word[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, 2) for i in range(n - 1) if (r := self.rank.get(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            own = piece[i]
            if own is None or after[i] >= n or len(own) + len(piece[after[i]] or b"") != size:
                continue
            j = after[i]
            piece[i], piece[j] = own + (piece[j] or b""), None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] < n:
                    both = (piece[a] or b"") + (piece[after[a]] or b"")
                    if (r := self.rank.get(both)) is not None:
                        heapq.heappush(heap, (r, a, len(both)))
        return np.array([self.rank[p] for p in piece if p is not None], dtype=np.int64)


class Encoder:
    """Encodes with a bounded cache from slice to ids."""

    def __init__(self, vocabulary: Vocabulary, cached: int = CACHED):
        self.vocabulary, self.cached = vocabulary, cached
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.sizes = np.zeros(1024, dtype=np.int64)
        self.starts = np.zeros(1024, dtype=np.int64)
        self.ids = np.zeros(4096, dtype=np.int32)
        self.used = 0

    def _learn(self, words: list[str]) -> None:
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        found: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * len(words)
        short = sorted((i for i in range(len(raw)) if len(raw[i]) <= LONG), key=lambda i: len(raw[i]))
        at = 0
        while at < len(short):
            # Rows of similar length, at most about a million cells.
            stop = at
            while stop < len(short) and (stop - at) * (len(raw[short[stop]]) + 1) < 1_000_000 and len(raw[short[stop]]) <= 2 * len(raw[short[at]]) + 4:
                stop += 1
            own = short[at:stop]
            for i, ids in zip(own, self.vocabulary.merge_rows([raw[i] for i in own]), strict=True):
                found[i] = ids
            at = stop
        for i in range(len(raw)):
            if len(raw[i]) > LONG:
                found[i] = self.vocabulary.merge_long(raw[i])
        sizes = np.array([len(f) for f in found], dtype=np.int64)
        first, total = len(self.number), int(sizes.sum())
        while first + len(words) > len(self.sizes):
            self.sizes, self.starts = np.concatenate((self.sizes, self.sizes)), np.concatenate((self.starts, self.starts))
        while self.used + total > len(self.ids):
            self.ids = np.concatenate((self.ids, self.ids))
        self.sizes[first : first + len(words)] = sizes
        self.starts[first : first + len(words)] = self.used + np.concatenate(([0], np.cumsum(sizes)))[:-1]
        self.ids[self.used : self.used + total] = np.concatenate(found)
        self.used += total
        self.number.update(zip(words, range(first, first + len(words)), strict=True))

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after another, number of ids of each word)."""
        if not words:
            return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
        found = list(map(self.number.get, words))
        new = {w for w, k in zip(words, found, strict=True) if k is None} if None in found else ()
        if new:
            if len(self.number) + len(new) > self.cached:
                self.forget()
                new = set(words)
            self._learn(list(new))
            found = list(map(self.number.__getitem__, words))
        numbers = np.array(found, dtype=np.int64)
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[numbers] - (ends - sizes), sizes) + np.arange(ends[-1])
        return self.ids[at], sizes


_ENCODERS: dict[bytes, Encoder] = {}
_TOKENS: dict[bytes, Tokens] = {}


def _encoder(lines: bytes) -> Encoder:
    """One encoder a process, for as long as the vocabulary stays the same."""
    if lines not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[lines] = Encoder(Vocabulary(lines))
    return _ENCODERS[lines]


def _tokens(lines: bytes) -> Tokens:
    if lines not in _TOKENS:
        _TOKENS.clear()
        _TOKENS[lines] = Tokens(_ranks(lines))
    return _TOKENS[lines]


def encode_texts(encoder: Encoder, texts: list[str]) -> list[np.ndarray]:
    """The ids of each text."""
    if sum(map(len, texts)) > 2 * BLOCK:  # a slice of rows beyond the limit is one long text
        return [np.concatenate([encoder(part)[0] for part in long_slices(t)] or [np.zeros(0, dtype=np.int32)]) for t in texts]
    words, counts = slices(texts)
    ids, sizes = encoder(words)
    ends = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum(counts)))]
    return [ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def encode(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, ids, offsets for every row of ``docs`` (doc_id, text).

    ``ids`` and ``offsets`` are little-endian unsigned 32-bit numbers: the ids, and the byte of the
    text where each begins.  A null or empty text has no ids; nothing in a text is a special token;
    texts of any length are encoded whole.  Repeated rows each get their row, further columns are not
    looked at.  The driver reads the vocabulary file and broadcasts it; its size is the vocabulary's."""
    with open(vocabulary, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in batches:
            for start, texts in text_slices(batch.column("text"), BLOCK):
                found = encode_texts(encoder, texts)
                places = [np.cumsum(encoder.vocabulary.sizes[f]) - encoder.vocabulary.sizes[f] for f in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(start, len(texts)),
                        pa.array([f.astype("<u4").tobytes() for f in found], pa.binary()),
                        pa.array([p.astype("<u4").tobytes() for p in places], pa.binary()),
                    ],
                    names=["doc_id", "ids", "offsets"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids binary, offsets binary")


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, ids, decoded for every row of ``encoded`` (doc_id, ids, offsets): each id's bytes, put
    at its offset.  Null ids decode to nothing."""
    with open(vocabulary, "rb") as file:
        shared = encoded.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _tokens(shared.value)
        for batch in batches:
            out = []
            for ids, places in zip(batch.column("ids"), batch.column("offsets"), strict=True):
                own = np.frombuffer(ids.as_buffer() or b"", dtype="<u4").astype(np.int64)
                at = np.frombuffer(places.as_buffer() or b"", dtype="<u4").astype(np.int64)
                sizes = known.sizes[own]
                text = known.joined[np.repeat(known.starts[own] - at, sizes) + np.arange(sizes.sum())]
                out.append(text.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), pa.array(out, pa.binary())], names=["doc_id", "ids", "decoded"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.mapInArrow(run, f"doc_id {kind}, ids binary, decoded binary")


def digest(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of decoded rows."""
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
