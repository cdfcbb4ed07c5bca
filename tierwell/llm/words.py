"""Ids of many plain words at once, under a vocabulary whose merges know the end of a word.

Plain words are of the letters a to z and those of Latin-1.  Their bytes, and their last bytes once more,
are fewer than 128 symbols.  Written in those, words are pieces of a byte-level vocabulary, whose ranks
follow from the merges, and a whole list of words is one call of that library.

That library joins any two neighbours whose bytes together have a rank, the other only the pairs it
lists.  Within a piece, merges take place in the order they would in the piece's token alone; so both
agree if each token has one pair that makes it and, taken as a word, is reduced to itself.  Tokens
that are not can't come about at all and get no rank; where one has two pairs there are no ranks."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np

END = "</w>"
#: Bytes of plain words in UTF-8: a to z, and the two of U+00DF to U+00FF but the division sign.
LETTERS = (*range(0x61, 0x7B), 0xC3, *(b for b in range(0x9F, 0xC0) if b != 0xB7))


def shown_bytes() -> dict[str, int]:
    """The characters that stand for bytes in the vocabulary: printable ones for themselves, the others for
    those from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(others)}


@dataclass(frozen=True)
class WordRanks:
    """Symbols of the tokens in the order of their ranks, from 1, and the id of each."""

    tokens: tuple[bytes, ...]
    ids: tuple[int, ...]


def _reduced(token: bytes, rank: dict[tuple[bytes, bytes], int]) -> list[bytes]:
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda i: rank.get((parts[i], parts[i + 1]), len(rank)))
        if (parts[best], parts[best + 1]) not in rank:
            break
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
    return parts


def word_ranks(vocabulary: str) -> WordRanks | None:
    """From a tokenizer's file; None where its model is none that this holds for."""
    model = json.loads(vocabulary)["model"]
    odd = ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges")
    if model.get("type") != "BPE" or model.get("end_of_word_suffix") != END or any(model.get(k) for k in odd):
        return None
    code = {b: 1 + k for k, b in enumerate(LETTERS)}
    by_char = {c: code[b] for c, b in shown_bytes().items() if b in code}

    def symbols(token: str) -> bytes | None:
        body = token.removesuffix(END)
        own = [by_char.get(c) for c in body]
        if not own or None in own:
            return None
        return bytes([*own[:-1], own[-1] + len(LETTERS)] if body != token else own)

    vocab = model["vocab"]
    singles = sorted((s, i) for t, i in vocab.items() if (s := symbols(t)) and len(s) == 1)
    pairs: dict[tuple[bytes, bytes], int] = {}
    made: dict[bytes, int] = {}
    for place, merge in enumerate(model["merges"]):
        a, b = merge if isinstance(merge, list) else merge.split(" ")
        left, right = symbols(a), symbols(b)
        if left is None or right is None:
            continue
        if left + right in made:
            return None
        pairs[left, right] = place
        made[left + right] = vocab[a + b]
    if len(singles) != 2 * len(LETTERS):  # a byte without a token of its own can't be written in symbols
        return None
    rank = {pair: k for k, pair in enumerate(sorted(pairs, key=pairs.__getitem__))}
    kept = [left + right for left, right in rank if _reduced(left + right, rank) == [left + right]]
    return WordRanks((*(s for s, _ in singles), *kept), (*(i for _, i in singles), *(made[t] for t in kept)))


class Words:
    """Ids of plain words, many at once."""

    def __init__(self, ranks: WordRanks, dtype: str):
        import tiktoken

        # Rank 0 ends a word and joins nothing.
        table = {b"\x00": 0} | {t: k for k, t in enumerate(ranks.tokens, start=1)}
        self.encoding = tiktoken.Encoding("words", pat_str="[^\\x00]+\\x00", mergeable_ranks=table, special_tokens={})
        self.ids = np.array([0, *ranks.ids], dtype=dtype)
        self.code = np.zeros(256, dtype=np.uint8)
        self.code[list(LETTERS)] = np.arange(1, len(LETTERS) + 1)

    def __call__(self, body: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of each) of words given as bytes, a zero after each; none is empty."""
        codes = self.code[body]
        ends = np.flatnonzero(body == 0)
        codes[ends - 1] += len(LETTERS)
        found = self.encoding.encode_to_numpy(codes.tobytes().decode("ascii"), disallowed_special=())
        gaps = np.flatnonzero(found == 0)
        return self.ids[found[found != 0]], np.diff(gaps, prepend=-1) - 1


SPACE, LETTER, DIGIT, OTHER, ODD = range(5)
#: Bytes of a piece that its key holds; longer ones are looked up by themselves.
KEY = 16
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _kinds() -> np.ndarray:
    """The class of each byte: ASCII, lower-cased, and those of plain letters; all else is odd, and so is an
    apostrophe, as some endings after one are pieces of their own."""
    out = np.full(256, ODD, dtype=np.uint8)
    out[[*range(9, 14), 32]] = SPACE
    out[[c for c in range(33, 127)]] = OTHER
    out[list(range(0x30, 0x3A))] = DIGIT
    out[list(LETTERS)] = LETTER
    out[0x27] = ODD
    return out


class PieceEncoder:
    """Ids of texts whose pieces are runs of letters, single digits and runs of what is neither, lower-cased,
    white space dropped and joined to nothing: found in whole slices of texts by array operations.

    What has been learned is in a table with one place for each value of a hash; a piece is found there if
    its bytes are the same, and a newer one takes an older one's place.  Pieces not found are learned once
    a slice, letters by ``Words`` and the rest by ``others``.  Pieces beyond KEY bytes, and chunks between
    white space with anything but plain letters, digits and ASCII signs, go to ``chunks``.  Both take and
    give lists, ids as bytes.  ``bits`` sizes the table, which bounds the memory."""

    def __init__(self, ranks: WordRanks, dtype: str, others: Callable[[list[str]], list[bytes]], chunks: Callable[[list[str]], list[bytes]], bits: int = 20):
        self.words, self.dtype, self.others, self.chunks, self.bits = Words(ranks, dtype), np.dtype(dtype), others, chunks, bits
        self.kinds = _kinds()
        self._forget()

    def _forget(self) -> None:
        size = 1 << self.bits
        # No piece begins with a zero, so an empty place equals none.
        self.low, self.high = np.zeros(size, dtype=np.uint64), np.zeros(size, dtype=np.uint64)
        self.start, self.count = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        self.flat = np.zeros(0, dtype=self.dtype)

    def _stored(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Where the ids of each piece start among all ids."""
        first = len(self.flat)
        self.flat = np.concatenate((self.flat, ids))
        return first + np.cumsum(counts) - counts

    def _stored_each(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        counts = np.array([len(f) // self.dtype.itemsize for f in found], dtype=np.int64)
        return self._stored(np.frombuffer(b"".join(found), dtype=self.dtype), counts), counts

    def _lowered(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The bytes in lower case, and the class of each."""
        body = np.frombuffer(raw, dtype=np.uint8).copy()
        body += ((body >= 0x41) & (body <= 0x5A)).view(np.uint8) * np.uint8(32)
        lead = np.flatnonzero(body[:-1] == 0xC3)
        after = body[lead + 1]
        upper = (after >= 0x80) & (after <= 0x9E) & (after != 0x97)
        body[lead[upper] + 1] += 32
        kinds = self.kinds[body]
        # A lead is a letter's with its own second byte only, and the other way round.
        second = np.zeros(len(body), dtype=bool)
        second[lead + 1] = True
        high = np.flatnonzero(body >= 0x80)
        wrong = high[np.where(body[high] == 0xC3, kinds[np.minimum(high + 1, len(body) - 1)] != LETTER, ~second[high])]
        kinds[wrong] = ODD
        odd = np.flatnonzero(kinds == ODD)
        if len(odd):
            # The whole chunk around an odd byte is one odd piece.
            space = np.flatnonzero(kinds == SPACE)
            chunk = np.unique(np.searchsorted(space, odd))
            low = np.concatenate(([-1], space))[chunk] + 1
            high = np.concatenate((space, [len(body)]))[chunk]
            edge = np.zeros(len(body) + 1, dtype=np.int8)
            edge[low] += 1
            edge[high] -= 1
            kinds[np.cumsum(edge[:-1], dtype=np.int8) > 0] = ODD
        return body, kinds

    def __call__(self, texts: Sequence[str]) -> list[bytes]:
        parts = [t.encode() for t in texts]
        raw = b"\n".join([*parts, b""])
        body, kinds = self._lowered(raw)
        change = kinds == DIGIT
        change[1:] |= kinds[1:] != kinds[:-1]
        change[:1] = True
        edges = np.flatnonzero(change)
        kind = kinds[edges]
        piece = kind != SPACE
        starts, stops, kind = edges[piece], np.append(edges[1:], len(body))[piece], kind[piece]
        size = stops - starts
        first, counts = np.empty(len(starts), dtype=np.int64), np.empty(len(starts), dtype=np.int64)
        short = (kind != ODD) & (size <= KEY)
        if short.all():
            first, counts = self._found(body, starts, size, kind)
        else:
            own, rest = np.flatnonzero(short), np.flatnonzero(~short)
            first[own], counts[own] = self._found(body, starts[own], size[own], kind[own])
            first[rest], counts[rest] = self._by_themselves(raw, body, starts[rest], stops[rest], kind[rest])
        ends = np.cumsum(counts)
        place = np.repeat(first - (ends - counts), counts)
        place += np.arange(len(place))
        ids = self.flat[place].tobytes()
        # The last piece of each text ends before the text does.
        last = np.searchsorted(starts, np.cumsum([len(p) + 1 for p in parts]))
        cut = (np.concatenate(([0], ends))[last] * self.dtype.itemsize).tolist()
        if len(self.flat) > 4 << self.bits:
            self._forget()
        return [ids[a:b] for a, b in zip([0, *cut[:-1]], cut, strict=True)]

    def _found(self, body: np.ndarray, starts: np.ndarray, size: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of short pieces start, and their number; new ones are learned."""
        padded = np.concatenate((body, np.zeros(KEY, dtype=np.uint8)))
        eight = np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), shape=(len(padded) - 7,), strides=(1,))
        low = eight[starts] & _MASKS[np.minimum(size, 8)]
        high = eight[starts + 8] & _MASKS[np.maximum(size - 8, 0)]
        mixed = low * _MIX[0]
        mixed ^= mixed >> np.uint64(29)
        mixed += high
        mixed *= _MIX[1]
        slot = (mixed >> np.uint64(64 - self.bits)).astype(np.int64)
        first, counts = self.start[slot], self.count[slot]
        new = np.flatnonzero((self.low[slot] != low) | (self.high[slot] != high))
        if len(new):
            order = new[np.lexsort((high[new], low[new]))]
            fresh = np.ones(len(order), dtype=bool)
            fresh[1:] = (low[order[1:]] != low[order[:-1]]) | (high[order[1:]] != high[order[:-1]])
            one = order[fresh]
            letters = kind[one] == LETTER
            at, n = np.empty(len(one), dtype=np.int64), np.empty(len(one), dtype=np.int64)
            at[letters], n[letters] = self._learned_words(body, starts[one[letters]], size[one[letters]])
            signs = one[~letters]
            names = [body[a : a + k].tobytes().decode() for a, k in zip(starts[signs].tolist(), size[signs].tolist(), strict=True)]
            at[~letters], n[~letters] = self._stored_each(self.others(names))
            which = np.cumsum(fresh) - 1
            first[order], counts[order] = at[which], n[which]
            place = slot[one]
            self.low[place], self.high[place], self.start[place], self.count[place] = low[one], high[one], at, n
        return first, counts

    def _learned_words(self, body: np.ndarray, starts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(starts):
            return starts, size
        ends = np.cumsum(size + 1)
        place = np.repeat(starts - (ends - size - 1), size + 1)
        place += np.arange(ends[-1])
        out = body[np.minimum(place, len(body) - 1)]
        out[ends - 1] = 0
        ids, counts = self.words(out)
        return self._stored(ids, counts), counts

    def _by_themselves(self, raw: bytes, body: np.ndarray, starts: np.ndarray, stops: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same of long pieces and odd chunks, each different one looked up once a slice."""
        places: dict[bytes, list[int]] = {}
        for i, (a, b, k) in enumerate(zip(starts.tolist(), stops.tolist(), kind.tolist(), strict=True)):
            places.setdefault(raw[a:b] if k == ODD else body[a:b].tobytes(), []).append(i)
        at, n = self._stored_each(self.chunks([p.decode() for p in places]))
        first, counts = np.empty(len(starts), dtype=np.int64), np.empty(len(starts), dtype=np.int64)
        for a, k, own in zip(at.tolist(), n.tolist(), places.values(), strict=True):
            first[own], counts[own] = a, k
        return first, counts
