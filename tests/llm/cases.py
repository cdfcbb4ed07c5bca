"""Rows every operator has to stand: nulls, empty and long texts, ties, repeats, clashing columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CLASHING = ", ".join(f"{c} string" for c in ("row", "key", "part", "fp", "cell", "doc", "print", "body", "score", "host", "node", "uid", "rank", "label", "_p"))
N_CLASHING = CLASHING.count(",") + 1


def documents(spark: SparkSession, texts: list[str | None], ids: list[int | None] | None = None, langs: list[str | None] | None = None) -> DataFrame:
    ids = ids if ids is not None else list(range(len(texts)))
    langs = langs if langs is not None else ["en"] * len(texts)
    rows = [(i, t, g, "src", len(t or ""), *["x"] * N_CLASHING) for i, t, g in zip(ids, texts, langs, strict=True)]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}")


ODD_TEXTS = [None, "", " \n\t", "one", "one", "a b c d e", "é" * 50, "x" * 3000, "Licensed under the MIT License. ", "word " * 4000, "'s 'sabc\u00a0 12\n\n 3", "\U0001f600 z\u0301"]
ODD_IDS = [1, 2, 3, 4, 4, None, 6, 7, 8, 9, 10, 11]


def odd_documents(spark: SparkSession) -> DataFrame:
    return documents(spark, ODD_TEXTS, ODD_IDS)


def no_documents(spark: SparkSession) -> DataFrame:
    return odd_documents(spark).limit(0)
