"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training adds up n-gram counts by language over every training row: a task combines its own, so about
one row per language and slot leaves it, and Spark sums those rows.  The matrix of log probabilities has
``2**BITS`` cells of four bytes for each language, however many rows teach it; it is broadcast and scores
batches as a sparse product in numpy, GROUP languages at a time."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwell.llm.common import Grams, fold_is, letters, sums_by_row, text_slices

BITS = 15
ORDERS = (1, 2, 3)
#: Languages scored at once.
GROUP = 64
#: Groups of languages whose counts a task holds.
HELD = 4
SMOOTHING = 0.5
UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    log_prob: np.ndarray  # 2**BITS rows, a column per language
    log_prior: np.ndarray


def _count(languages: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, size = Grams(ORDERS, BITS), 1 << BITS
        place = {name: i for i, name in enumerate(languages)}
        # Dense counts of each group of languages met; of many groups the oldest is handed on.
        counts: dict[int, np.ndarray] = {}

        def rows(group: int) -> pa.RecordBatch:
            own = counts.pop(group)
            found = np.flatnonzero(own)
            return pa.RecordBatch.from_arrays(
                [pa.array(found // size + group * GROUP, pa.int32()), pa.array(found % size, pa.int32()), pa.array(own[found])], names=["lang_no", "slot", "n"]
            )

        for batch in batches:
            langs = np.asarray([place[x] for x in batch.column("lang").to_pylist()], dtype=np.int64)
            for start, texts in text_slices(batch.column("text")):
                for codes, owner in grams.blocks(texts):
                    for row, slot in grams.hashed(codes, owner):
                        lang = langs[start + row]
                        for group in np.unique(langs[start : start + len(texts)] // GROUP).tolist():
                            if group not in counts:
                                if len(counts) == HELD:
                                    yield rows(next(iter(counts)))
                                counts[group] = np.zeros(min(GROUP, len(languages) - group * GROUP) * size, dtype=np.int64)
                            if len(languages) <= GROUP:
                                key = lang * size + slot
                            else:
                                own = lang // GROUP == group
                                key = (lang[own] - group * GROUP) * size + slot[own]
                            counts[group] += np.bincount(key, minlength=len(counts[group]))
        for group in list(counts):
            yield rows(group)

    return run


def train(rows: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """A model of all ``rows`` with text and language, of however many languages."""
    known = rows.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    names = sorted(sizes)
    counts = np.full((len(names), 1 << BITS), SMOOTHING)
    if names:
        table = known.mapInArrow(_count(names), "lang_no int, slot int, n long").groupBy("lang_no", "slot").agg(F.sum("n").alias("n")).toPandas()
        counts[table["lang_no"].to_numpy(), table["slot"].to_numpy()] += table["n"].to_numpy()
    log_prob = np.log(counts / counts.sum(axis=1, keepdims=True)).T.astype(np.float32)
    total = max(1, sum(sizes.values()))
    return LanguageModel(tuple(names), np.ascontiguousarray(log_prob), np.log([sizes[x] / total for x in names]))


def score_texts(model: LanguageModel, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """The likeliest language of each text and its probability under the model."""
    n, grams = len(texts), Grams(ORDERS, BITS)
    lettered = np.zeros(n, dtype=bool)
    is_letter = letters()
    groups = [slice(a, a + GROUP) for a in range(0, len(model.languages), GROUP)]
    totals = [np.tile(model.log_prior[g].astype(np.float64), (n, 1)) for g in groups]
    # Views of whole rows where there is one group only.
    tables = [model.log_prob if len(groups) == 1 else model.log_prob[:, g] for g in groups]
    for codes, rows in grams.blocks(texts):
        lettered[rows[(rows >= 0) & is_letter[np.minimum(codes, 0x10FFFF)]]] = True
        for row, slot in grams.hashed(codes, rows):
            for total, table in zip(totals, tables, strict=True):
                total += sums_by_row(row, table[slot], n)
    if not model.languages:
        return [UNKNOWN] * n, np.zeros(n)
    best, top, rest = np.zeros(n, dtype=np.int64), np.full(n, -np.inf), np.zeros(n)
    for group, total in zip(groups, totals, strict=True):
        own = total.max(axis=1)
        best = np.where(own > top, group.start + total.argmax(axis=1), best)
        highest = np.maximum(top, own)
        # The sum of all probabilities so far, in units of the highest.
        rest = rest * np.exp(top - highest) + np.exp(total - highest[:, None]).sum(axis=1)
        top = highest
    return [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered, strict=True)], np.where(lettered, 1.0 / rest, 0.0)


def predictor(docs: DataFrame, model: LanguageModel):
    """A function from a text column to struct<lang_pred, score> under the broadcast model."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("lang_pred string, score double")
    def predict(texts: pa.Array) -> pa.Array:
        names: list[str] = []
        scores: list[np.ndarray] = []
        for _, part in text_slices(texts):
            found, share = score_texts(shared.value, part)
            names += found
            scores.append(share)
        flat = np.concatenate(scores) if scores else np.zeros(0)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(flat, pa.float64())], fields=list(kind))

    return predict


def training_rows(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Rows outside the held-out fold; rows without an id teach nothing, as their fold is unknown."""
    return docs.where(F.col(doc_id).isNotNull() & ~fold_is(doc_id, 1))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs`` (doc_id, text, lang).

    Null texts and texts without a letter are ``und`` with score 0, and so is every text if there is
    nothing to learn from.  A row without an id is predicted, is not held out and teaches nothing.
    Repeated rows each get their row; ties go to the alphabetically first language.  Texts are read whole,
    block by block.  Further columns are not looked at."""
    predict = predictor(docs, train(training_rows(docs)))
    return docs.select("doc_id", fold_is("doc_id", 1).alias("held_out"), predict(F.col("text")).alias("_p")).select("doc_id", "held_out", "_p.lang_pred", "_p.score")


def accepted(prediction: Column, least: float = 0.5) -> Column:
    """A document with a known language that is likelier than all others together."""
    return (prediction["lang_pred"] != UNKNOWN) & (prediction["score"] >= least)


def keep_known_language(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language the model can tell, with all their columns, whatever their names.

    Null texts and texts without a letter go; repeated rows share their fate, and a tie of two languages,
    neither of which has a majority then, goes too.  Rows without an id are judged like others.  Where no
    row has a language there is none to tell, and no row stays."""
    predict = predictor(docs, train(training_rows(docs)))
    return docs.where(accepted(predict(F.col("text"))))
