"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are n-grams present in a text, worth their naive Bayes log-count ratio; a logistic
regression weighs them.  Both are fitted on a sample of labelled rows of at most ``PER_CLASS`` rows
for each label, chosen by a hash of the id, so that what is broadcast and what the driver holds has
that bound whatever the corpus holds.  Scoring reads every text whole."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwell.llm.common import Grams, fold_is, text_slices
from tierwell.sources.shared import stored

BITS = 20
ORDERS = (3, 4, 5, 6)
PER_CLASS = 4000
MAX_FEATURES = 8192
LEAST_DOCS = 3
LEAST_SHARE = 0.01
LEAST_Z = 4.5
PENALTY = 0.0001
#: The fit's steps, and the gradient at which it ends before.
STEPS = 600
CLOSE = 1e-4
#: Features of the rows that a step takes at once.
BLOCK = 1 << 19
THRESHOLD = 0.7


@dataclass(frozen=True)
class ToxicityModel:
    feature: np.ndarray  # slot -> feature number, -1: none
    weight: np.ndarray  # feature -> log-count ratio times learned weight
    bias: float


def _present(texts: list[str], grams: Grams, feature: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, slot or feature) pairs of the texts."""
    size = 1 << BITS
    found: list[np.ndarray] = []
    for codes, rows in grams.blocks(texts):
        for row, slot in grams.hashed(codes, rows):
            if feature is not None:
                slot = feature[slot]
                hit = slot >= 0
                row, slot = row[hit], slot[hit]
            found.append(np.unique(row.astype(np.int64) * size + slot))
    pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.int64)
    return pairs // size, pairs % size


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    grams, size = Grams(ORDERS, BITS), 1 << BITS
    counts = np.zeros(2 * size, dtype=np.int64)
    for batch in batches:
        label = np.asarray(batch.column("label"), dtype=np.int64)
        for start, texts in text_slices(batch.column("text")):
            rows, slots = _present(texts, grams)
            np.add.at(counts, label[start + rows] * size + slots, 1)
    none, some = counts[:size], counts[size:]
    found = np.flatnonzero(none + some)
    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(none[found]), pa.array(some[found])], names=["slot", "n0", "n1"])


def _rows_of_features(feature: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(ORDERS, BITS)
        for batch in batches:
            label = batch.column("label").to_pylist()
            for start, texts in text_slices(batch.column("text")):
                rows, found = _present(texts, grams, feature)
                parts = np.split(found.astype("<i4"), np.searchsorted(rows, np.arange(1, len(texts))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(label[start : start + len(texts)], pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], names=["label", "features"]
                )

    return run


def _fit(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, share: float) -> tuple[np.ndarray, float]:
    """Penalised logistic regression by accelerated gradient steps; classes weigh as in the corpus.

    Steps end once the gradient is CLOSE to nothing, or after STEPS of them.  Rows are taken in blocks, so
    that a step holds little more than the rows themselves."""
    n, k = len(rows), len(ratio)
    counts = np.array([len(r) for r in rows], dtype=np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(counts) // BLOCK)) + 1).tolist(), n]
    blocks = [(a, b, np.concatenate(rows[a:b]).astype(np.int64)) for a, b in itertools.pairwise(cuts) if a < b]
    each = np.where(labels == 1, share / max(1, (labels == 1).sum()), (1 - share) / max(1, (labels == 0).sum()))

    def margins(weight: np.ndarray, bias: float) -> np.ndarray:
        out, worth = np.zeros(n), ratio * weight
        for a, b, own in blocks:
            some = np.flatnonzero(counts[a:b])
            if len(some):
                starts = np.cumsum(counts[a:b])[some] - counts[a:b][some]
                out[a + some] = np.add.reduceat(worth[own], starts)
        return out + bias

    def slope(miss: np.ndarray) -> np.ndarray:
        out = np.zeros(k)
        for a, b, own in blocks:
            out += np.bincount(own, np.repeat(miss[a:b], counts[a:b]), minlength=k)
        return ratio * out

    weight, bias, ahead, ahead_bias = np.zeros(k), 0.0, np.zeros(k), 0.0
    # The largest curvature, by power iteration on the weighted Gram matrix.
    probe = np.ones(k + 1) / np.sqrt(k + 1)
    curve = 1.0
    for _ in range(20):
        out = each * margins(probe[:k], probe[k])
        step = np.append(slope(out), out.sum())
        curve = float(np.linalg.norm(step)) or 1.0
        probe = step / curve
    rate = 1.0 / (0.3 * curve + PENALTY)
    for turn in range(1, STEPS + 1):
        miss = each * (1.0 / (1.0 + np.exp(-np.clip(margins(ahead, ahead_bias), -60, 60))) - labels)
        grad = slope(miss) + PENALTY * ahead
        if max(np.abs(grad).max(initial=0.0), abs(miss.sum())) <= CLOSE:
            break
        new, new_bias = ahead - rate * grad, ahead_bias - rate * miss.sum()
        push = (turn - 1) / (turn + 2)
        ahead, ahead_bias = new + push * (new - weight), new_bias + push * (new_bias - bias)
        weight, bias = new, new_bias
    return weight, bias


def training_sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, float]:
    """(text, label) of at most PER_CLASS labelled documents of each label outside the held-out fold, and
    the share of label 1 among all of those.

    Only labels of documents with text count, and towards the bound too; a document labelled both ways
    counts as toxic, and of rows that share a doc_id the first text by its bytes teaches."""
    rated = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~fold_is("doc_id", 1))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("label"))
    )
    texts = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text")
    known = stored(rated.join(texts.select("doc_id").distinct(), "doc_id"), "rated-documents")
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    chosen = [known.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(PER_CLASS) for y in (0, 1)]
    # At most PER_CLASS ids of each label, and as many rows in the end.
    both = F.broadcast(chosen[0].unionByName(chosen[1]))
    one_each = texts.join(both, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
    return stored(one_each.select("text", "label"), "labelled-sample"), sizes.get(1, 0) / max(1, sum(sizes.values()))


def train(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """A model of a bounded labelled sample; without both labels a model that calls nothing toxic."""
    size = 1 << BITS
    sample, share = training_sample(docs, labels)
    counts = sample.mapInArrow(_document_counts, "slot int, n0 long, n1 long").groupBy("slot").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    per_label = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n0, n1 = per_label.get(0, 0), per_label.get(1, 0)
    if not n0 or not n1:
        return ToxicityModel(np.full(size, -1, dtype=np.int32), np.zeros(1), -5.0)
    p, q = (F.col("n1") + 1.0) / (n1 + 2.0), (F.col("n0") + 1.0) / (n0 + 2.0)
    ratio = F.log(p / q)
    z = F.abs(ratio) / F.sqrt((1 - p) / (p * n1) + (1 - q) / (q * n0))
    top = (
        counts.where(F.greatest(F.col("n0") / n0, F.col("n1") / n1) >= LEAST_SHARE)
        .where(F.col("n0") + F.col("n1") >= LEAST_DOCS)
        .select("slot", ratio.alias("ratio"), z.alias("z"))
        .where(F.col("z") >= LEAST_Z)
        .orderBy(F.desc("z"), "slot")
        .limit(MAX_FEATURES)
        .toPandas()
    )
    feature = np.full(size, -1, dtype=np.int32)
    feature[top["slot"].to_numpy(dtype=np.int64)] = np.arange(len(top))
    if top.empty:
        return ToxicityModel(feature, np.zeros(1), -5.0)
    ratios = top["ratio"].to_numpy()
    rows = sample.mapInArrow(_rows_of_features(feature), "label int, features binary").toArrow()
    found = [np.frombuffer(r.as_buffer(), dtype="<i4") for r in rows.column("features")]
    weight, bias = _fit(found, np.asarray(rows.column("label"), dtype=float), ratios, share)
    return ToxicityModel(feature, weight * ratios, float(bias))


def score_texts(model: ToxicityModel, texts: list[str]) -> np.ndarray:
    rows, found = _present(texts, Grams(ORDERS, BITS), model.feature)
    margin = np.bincount(rows, model.weight[found], minlength=len(texts)) + model.bias
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -60, 60)))


def scorer(docs: DataFrame, model: ToxicityModel):
    """A function from a text column to the probability of label 1 under the broadcast model."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        parts = [score_texts(shared.value, part) for _, part in text_slices(texts)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return score


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs`` (doc_id, text).

    Null and empty texts have no feature and get the model's base rate.  Labels other than 0 and 1
    and labels of unknown documents teach nothing; a row without an id is scored, is not held out
    and teaches nothing.  Repeated rows each get their row.  Further columns are not looked at."""
    score = scorer(docs, train(docs, labels))
    return docs.select("doc_id", fold_is("doc_id", 1).alias("held_out"), score(F.col("text")).alias("score")).withColumn("predicted", toxic(F.col("score")).cast("int"))


def toxic(score: Column, threshold: float = THRESHOLD) -> Column:
    return score >= threshold


def keep_harmless(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the model does not call toxic, with all their columns, whatever their names.

    Null and empty texts get the model's base rate; without labels of both kinds nothing is called toxic.
    Repeated rows share their fate; a score equal to the threshold is toxic.  Texts are read whole."""
    score = scorer(docs, train(docs, labels))
    return docs.where(~toxic(score(F.col("text"))))
