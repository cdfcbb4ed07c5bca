"""Reading raw files and layer tables.  No reader looks through the data to find a schema."""

from __future__ import annotations

import csv
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tierwell import fixed_values as fv
from tierwell.schemas import CORRUPT, RAW_TRANSACTIONS
from tierwell.sources.shared import exists, fresh_path
from tierwell.sources.sinks import overwrite


#: The file source forgets files by age, by default after a week; this is a hundred years.
FILES_OF_ANY_AGE = "36500d"


def literal(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Paths as readers take them.  One that exists as it is written means just that, whatever blanks,
    brackets or other glob characters it has; one that does not is a glob."""
    paths = [path] if isinstance(path, str) else list(path)
    return [_GLOB_CHARACTERS.sub(r"\\\1", p) if exists(spark, p) else p for p in paths]


_GLOB_CHARACTERS = re.compile(r"([\\{}\[\]*?])")


def csv_lines(spark: SparkSession, path: str | list[str], at: str | None = None) -> DataFrame:
    """The lines of text files, blank ones left out, each with its file, the start of its block there and its
    place in the scan.  The text is read once; what comes back is a table written to ``at``."""
    lines = spark.read.text(literal(spark, path)).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )
    at = at or fresh_path(spark, "csv-lines")
    overwrite(lines.filter(F.length(F.trim("value")) > 0), at)
    return read_table(spark, at)


def _names(header: str, spelled: dict[str, str]) -> list[str]:
    """The columns of a header line, where only the case differs spelled as they first were.  Empty and
    repeated names get their position."""
    names: list[str] = []
    for place, name in enumerate(next(csv.reader([header.removeprefix("\ufeff")]), [])):
        name = name.strip() or f"_c{place}"
        name = spelled.setdefault(name.lower(), name)
        names.append(f"{name}_c{place}" if name in names else name)
    return names


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, lines_at: str | None = None) -> DataFrame:
    """CSV files with a header each, every column as text; an empty field is NULL.

    The lines are read once and written with their file (``csv_lines``, to ``lines_at``).  Every line is
    parsed by the header of its own file, so the order of columns may differ from file to file; columns
    beyond ``schema`` are kept and those a file lacks are NULL.  A line with more or fewer fields than its
    header is kept whole in ``_corrupt_record``.  The driver sees the distinct header lines."""
    lines = csv_lines(spark, path, lines_at)
    headers = lines.filter(F.col("start") == 0).groupBy("file").agg(
        F.min_by("value", "place").alias("header"), F.min("place").alias("header_place")
    )
    found = sorted(r["header"] for r in headers.select("header").distinct().collect())
    spelled = {n.lower(): n for n in schema.fieldNames()}
    layouts = [_names(h, spelled) for h in found]
    columns = list(dict.fromkeys([*schema.fieldNames(), *(n for names in layouts for n in names)]))
    if not found:
        return empty(spark, T.StructType([T.StructField(n, T.StringType()) for n in (*columns, CORRUPT)]))
    number = F.lit(0)
    for place, header in enumerate(found):
        number = F.when(F.col("header") == header, F.lit(place)).otherwise(number)
    own = lines.join(headers.select("file", "header_place", number.alias("layout")), "file").filter(F.col("place") != F.col("header_place"))

    def parsed(place: int, names: list[str]) -> Column:
        fields = ", ".join(f"`{n.replace('`', '``')}` string" for n in (*names, CORRUPT))
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
        row = F.from_csv("value", fields, options)
        return F.when(F.col("layout") == place, row).alias(f"_{place}")

    rows = own.select(*[parsed(k, names) for k, names in enumerate(layouts)])

    def delivered(name: str) -> Column:
        parts = [F.col(f"_{k}")[name] for k, names in enumerate(layouts) if name in names or name == CORRUPT]
        return F.coalesce(*parts).alias(name) if parts else F.lit(None).cast("string").alias(name)

    return rows.select(*[delivered(c) for c in (*columns, CORRUPT)])


def read_jsonl(spark: SparkSession, path: str | list[str], schema: T.StructType = RAW_TRANSACTIONS) -> DataFrame:
    """JSON lines.  Absent keys read as NULL; a malformed line is kept in ``_corrupt_record``."""
    return _json_options(spark.read.schema(schema)).json(literal(spark, path))


def read_jsonl_as_delivered(
    spark: SparkSession, path: str | list[str], field: str = "amount", schema: T.StructType = RAW_TRANSACTIONS
) -> DataFrame:
    """JSON lines with ``<field>_is_text``: whether the line had the field as a string.

    The field is read as a variant, which remembers its kind, so every line is still parsed once."""
    kinds = [T.StructField(f.name, T.VariantType() if f.name == field else f.dataType) for f in schema.fields]
    found = read_jsonl(spark, path, T.StructType(kinds))
    value = F.col(field)
    return found.select(
        *[F.variant_get(value, "$", "string").alias(c) if c == field else F.col(c) for c in found.columns],
        F.coalesce(F.schema_of_variant(value) == F.lit("STRING"), F.lit(False)).alias(f"{field}_is_text"),
    )


def stream_jsonl(
    spark: SparkSession,
    folder: str,
    schema: T.StructType = RAW_TRANSACTIONS,
    files_per_batch: int | None = None,
    glob: str = fv.STREAM_FILE_GLOB,
    max_file_age: str = FILES_OF_ANY_AGE,
    archive: str | None = None,
) -> DataFrame:
    """New files of a folder as a stream.  The query's checkpoint remembers which were read, by name.

    Files count whatever time they are stamped with, unless ``max_file_age`` says otherwise.
    ``archive`` names a folder that files move to once read, which keeps the incoming folder and the
    list of names short; only one query may then read the folder."""
    reader = _json_options(spark.readStream.schema(schema)).option("pathGlobFilter", glob).option("maxFileAge", max_file_age)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder)


def _json_options(reader):
    return reader.option("columnNameOfCorruptRecord", CORRUPT).option("mode", "PERMISSIVE")


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw lines as text in ``value``, for checks on how a value was delivered."""
    return spark.read.text(literal(spark, path))


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A layer table.  ``fmt`` is any columnar format the session can read."""
    return spark.read.format(fmt).load(path)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """A layer table, or a typed empty frame where none has been written yet."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as failed:
        if failed.getCondition() == "PATH_NOT_FOUND":
            return empty(spark, schema)
        raise


def optional(df: DataFrame, name: str, kind: str = "string") -> Column:
    """A column that may be missing from the frame: NULL then.  Dots reach into structs."""
    schema: T.DataType = df.schema
    for part in name.split("."):
        if not isinstance(schema, T.StructType) or part not in schema.fieldNames():
            return F.lit(None).cast(kind)
        schema = schema[part].dataType
    return F.col(name).cast(kind)
