"""Text canonicalisation and predicates on text."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierwell import fixed_values as fv


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(c: Column | str) -> Column:
    """The value as text without surrounding blanks."""
    return F.trim(as_col(c).cast("string"))


def code(c: Column | str) -> Column:
    """A code in its canonical upper-case spelling."""
    return F.upper(text(c))


def missing(c: Column | str) -> Column:
    """TRUE for NULL and for text that is empty after trimming; never NULL itself."""
    c = as_col(c)
    return c.isNull() | (F.length(F.trim(c.cast("string"))) == 0)


def any_of(predicates: Iterable[Column]) -> Column:
    """OR over any number of predicates, FALSE for none."""
    return reduce(or_, predicates, F.lit(False))


def outside(c: Column | str, allowed: list[str]) -> Column:
    """TRUE where a value is present but not in ``allowed``.  An empty list allows everything."""
    if not allowed:
        return F.lit(False)
    c = as_col(c)
    return c.isNotNull() & ~c.isin(*[str(v).upper() for v in allowed])


def currency(c: Column | str, target: str = fv.CURRENCY, strict: bool = False) -> Column:
    """The standard currency.  Loose: always ``target``.  Strict: ``target`` only for its known
    spellings, NULL for anything else."""
    if not strict:
        return F.lit(target)
    return F.when(code(c).isin(*fv.CURRENCY_SPELLINGS), F.lit(target))


def flags(c: Column | str) -> Column:
    """A pipe-delimited list as an array; NULL and blank give an empty array."""
    return F.when(missing(c), F.array().cast("array<string>")).otherwise(
        F.transform(F.split(text(c), r"\|"), lambda x: F.trim(x))
    )


def latitude_longitude(c: Column | str) -> Column:
    """``"lat,lon"`` as a struct of two doubles, each NULL when unusable."""
    parts = F.split(text(c), ",")
    return F.struct(
        F.trim(F.get(parts, 0)).try_cast("double").alias("latitude"),
        F.trim(F.get(parts, 1)).try_cast("double").alias("longitude"),
    )
