"""The registered queries of the operators: whole tables in, the digest columns of each result out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tierwell.llm import bpe, merkle, packing, sharding, sql, substrings
from tierwell.llm.embeddings import near_vectors
from tierwell.llm.language import identify
from tierwell.llm.licenses import scan_licenses
from tierwell.llm.simhash import near_duplicates
from tierwell.llm.topk import top_products
from tierwell.llm.toxicity import score_toxicity
from tierwell.llm.urls import judge
from tierwell.llm.whitening import whiten
from tierwell.tuning import tune

Run = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table, in a session whose joins split hot keys."""
    return tune(spark).read.parquet(f"{folder}/{name}.parquet")


def simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


def embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(table(spark, folder, "embeddings"))


def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digest(bpe.decode(bpe.encode(table(spark, folder, "documents"))))


def url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judge(table(spark, folder, "pages"))


def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(table(spark, folder, "documents")).drop("detections")


def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Strings of 400 bytes are removed; repeated passages of over 50 words, often shorter, are reported beside them."""
    return substrings.digest(substrings.remove_repeats(table(spark, folder, "documents"), passages=substrings.WORDS))


def exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_products(table(spark, folder, "embeddings"))


def language_id(spark: SparkSession, folder: str) -> DataFrame:
    return identify(table(spark, folder, "documents"))


def pack_sequences(spark: SparkSession, folder: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, folder, "documents")))


def toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def byte_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.digest(sharding.placements(table(spark, folder, "documents")))


def merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(table(spark, folder, "documents"), merkle.tampered())


def embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(table(spark, folder, "embeddings"))


QUERIES: dict[str, Run] = {
    "op1_simhash_dedup": simhash_dedup,
    "op2_embedding_dedup": embedding_dedup,
    "op3_byte_bpe": byte_bpe,
    "op4_url_filter": url_filter,
    "op5_license_scan": license_scan,
    "op6_suffix_array_dedup": substring_dedup,
    "op7_exact_top_k": exact_top_k,
    "op8_language_id": language_id,
    "op9_packing": pack_sequences,
    "op10_toxicity": toxicity,
    "op11_sharding": byte_shards,
    "op12_merkle_manifest": merkle_manifest,
    "op13_embedding_whitening": embedding_whitening,
}

#: SQL for those queries it can express.
SQL: dict[str, str] = {
    "op11_sharding": sql.SHARDS,
    "op12_merkle_manifest": sql.MERKLE,
    "op7_exact_top_k": """
        WITH v AS (
          SELECT vec_id, [floor(64 * x::DOUBLE) for x in embedding] AS w FROM embeddings
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(embedding) > 0 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (
          SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.w, c.w) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
        r AS (
          SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
}
