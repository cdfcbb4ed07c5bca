"""Contiguous shards of nearly equal bytes.

Documents are ordered by doc_id.  A global prefix sum of their sizes comes from the totals of
partitions plus running sums inside each (``prefix.running_sums``), and the order is cut where the sum
passes equal shares of the total.  Only ids, sizes and checksums are shuffled for that; as shards are
ranges of the order, whole rows find their shard by comparing themselves with one key per cut."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwell.llm.prefix import running_sums
from tierwell.sources.shared import stored

SHARDS = 8
#: The order of documents; the place in the scan tells repeated rows apart.
ORDER = ["doc_id", "text_crc32", "size", "place"]


def _keys() -> list[Column]:
    body = F.coalesce(F.col("text"), F.lit(""))
    return [
        F.col("doc_id"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        (F.octet_length(body).cast("long") + 1).alias("size"),
        F.monotonically_increasing_id().alias("place"),
    ]


def placements(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, text_crc32, size, place, shard, slot.

    ``size`` is the text's UTF-8 bytes and 1, so that a null or empty text counts as 1; its checksum
    is 0.  The row in the middle of whose bytes a cut falls goes to the side that holds more of it:
    a shard's bytes differ from an equal share by less than the largest document.  A document that is
    larger than a share leaves the shards it covers empty.  Slots follow the order of documents: null
    doc_id first, repeats of one by checksum, size and place in the scan; each repeated row has its
    own slot, and equal texts need not share a shard.  Texts are read whole, whatever their length,
    and not shuffled.  Further columns are not looked at; no documents give no rows."""
    # Written first: finding the ranges reads its input once more, and that should not be the texts.
    light = stored(docs.select(*_keys(), F.lit(1).cast("long").alias("one")), "sizes")
    sized = running_sums(light, ORDER, {"bytes_before": "size", "rows_before": "one"})
    total = sized.agg((F.max(F.col("bytes_before") + F.col("size"))).alias("n")).first()["n"] or 1
    # Twice the middle of the row, in decimals wide enough for any total.
    middle = F.col("bytes_before").cast("decimal(19,0)") * 2 + F.col("size")
    shard = F.floor(middle * F.lit(shards) / F.lit(2 * total).cast("decimal(19,0)")).cast("int")
    dealt = stored(sized.select(*ORDER, "rows_before", shard.alias("shard")), "dealt")
    first = dealt.groupBy("shard").agg(F.min("rows_before").alias("first"))
    # One row per shard.
    return dealt.join(F.broadcast(first), "shard").select(*ORDER, "shard", (F.col("rows_before") - F.col("first")).alias("slot"))


def cuts(placed: DataFrame) -> list[tuple[int, Column]]:
    """(shard, key of its first row) of every shard that has rows, from ``placements``."""
    key = F.struct(*ORDER)
    found = placed.groupBy("shard").agg(F.min(key).alias("key")).orderBy("shard").collect()
    kinds = placed.select(key.alias("key")).schema["key"].dataType
    return [(r["shard"], F.struct(*[F.lit(r["key"][f.name]).cast(f.dataType).alias(f.name) for f in kinds.fields])) for r in found]


def in_shards(docs: DataFrame, shards: int = SHARDS) -> tuple[DataFrame, str]:
    """All rows and columns of ``docs`` with the number of their shard, and the name of that column
    (``shard``, or with underscores where ``docs`` has one already).  Whole rows are not shuffled."""
    name = "shard"
    while name in docs.columns:
        name += "_"
    key, number = F.struct(*_keys()), F.lit(0)
    for shard, first in cuts(placements(docs, shards)):
        number = F.when(key >= first, F.lit(shard)).otherwise(number)
    return docs.withColumn(name, number), name


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> str:
    """Write whole documents below ``path``, one folder per shard, rows in the order of their slots.

    Rows are dealt by ranges of the order within their shard, so that a shard is written by as many
    tasks as its size asks for."""
    rows, name = in_shards(docs, shards)
    order = [F.col(name), F.col("doc_id").asc_nulls_first(), *_keys()[1:3]]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.write.partitionBy(name).parquet(path)
    return path


def digest(placed: DataFrame) -> DataFrame:
    """The law here is equal bytes, under which no shard grows when one more is added."""
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
