"""Registered queries: a Spark function and, where SQL can say the same, its SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Run
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        if name in ENTRIES:
            raise ValueError(f"{name} is registered twice")
        ENTRIES[name] = Entry(lambda spark, folder: portable(run(spark, folder)), sql)
        return run

    return register


def portable(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text and decimals as doubles, which every engine renders alike."""

    def shown(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        return c.alias(field.name)

    return df.select(*[shown(f) for f in df.schema.fields])
