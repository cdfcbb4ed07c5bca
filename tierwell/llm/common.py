"""Small helpers the operators share: slices of Arrow text, character n-grams, record folds."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters handled at once by one Python worker; bounds its memory for texts of any length.
BLOCK = 1 << 17


def fold_is(doc_id: str, remainder: int, folds: int = 3) -> Column:
    """crc32 of the id's decimal text, modulo ``folds``, is ``remainder``; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == remainder, F.lit(False))


def text_slices(texts: pa.Array, limit: int = BLOCK) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) so that each slice has about ``limit`` bytes, one row at least; null is empty."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)
    total, start = np.concatenate(([0], np.cumsum(sizes))), 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(total, total[start] + limit, "right")) - 1)
        yield start, [t or "" for t in texts.slice(start, stop - start).to_pylist()]
        start = stop


def _letters() -> np.ndarray:
    table = np.zeros(0x110000, dtype=bool)
    table[[c for c in range(0x110000) if chr(c).isalpha()]] = True
    return table


_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point whether it is a letter; made once in a process."""
    if not _LETTERS:
        _LETTERS.append(_letters())
    return _LETTERS[0]


_MIX = np.uint64(0x9E3779B97F4A7C15)


class Grams:
    """Hashed character n-grams of texts, lower-cased, everything but letters read as a space.

    A gram belongs to the place where it ends.  Long texts are cut into blocks that repeat the last
    characters of the block before as context only, so every gram of the whole text counts once."""

    def __init__(self, orders: Sequence[int], bits: int):
        self.orders, self.bits, self.reach = tuple(orders), bits, max(orders) - 1
        rng = np.random.default_rng(20240607)
        self.factors = rng.integers(1, 1 << 63, size=max(orders), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def blocks(self, texts: Sequence[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(code points, row of each; -1 marks context) in blocks of bounded size."""
        codes: list[np.ndarray] = []
        rows: list[np.ndarray] = []
        held = 0
        is_letter = letters()
        blank = np.full(self.reach, 32, dtype=np.uint32)
        for row, text in enumerate(texts):
            context = blank
            for at in range(0, len(text), BLOCK):
                body = np.frombuffer(text[at : at + BLOCK].lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
                body = np.where(is_letter[np.minimum(body, 0x10FFFF)], body, np.uint32(32))
                codes += [context, body]
                rows += [np.full(self.reach, -1, dtype=np.int32), np.full(len(body), row, dtype=np.int32)]
                held += len(body) + self.reach
                context = np.concatenate((context, body))[-self.reach :] if self.reach else blank
                if held >= BLOCK:
                    yield np.concatenate(codes), np.concatenate(rows)
                    codes, rows, held = [], [], 0
        if codes:
            yield np.concatenate(codes), np.concatenate(rows)

    def hashed(self, codes: np.ndarray, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row, slot) of the grams of each order; grams of spaces alone are left out."""
        wide = codes.astype(np.uint64)
        space = codes == 32
        mixed, blank = wide * self.factors[0], space.copy()
        shift = np.uint64(64 - self.bits)
        for order in range(1, max(self.orders) + 1):
            if order > 1:
                k = order - 1
                mixed[k:] += wide[:-k] * self.factors[k]
                blank[k:] &= space[:-k]
            if order in self.orders:
                use = np.flatnonzero((rows >= 0) & ~blank)
                value = (mixed[use] + np.uint64(order)) * _MIX
                value ^= value >> np.uint64(29)
                yield rows[use], ((value * _MIX) >> shift).astype(np.int64)


def sums_by_row(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of ``values`` over runs of equal ``rows`` (ascending), for rows 0 to n - 1."""
    out = np.zeros((n, *values.shape[1:]), dtype=np.float64)
    if len(rows):
        starts = np.concatenate(([0], np.flatnonzero(np.diff(rows)) + 1))
        out[rows[starts]] = np.add.reduceat(values, starts, axis=0, dtype=np.float64)
    return out
