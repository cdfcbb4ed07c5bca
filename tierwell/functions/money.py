"""Amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierwell import fixed_values as fv
from tierwell.functions.text import as_col


def money(c: Column | str) -> Column:
    """The value as DECIMAL(18,2), rounded half up; NULL when it is no number."""
    return as_col(c).try_cast(fv.MONEY)


def zero() -> Column:
    return F.lit("0.00").cast(fv.MONEY)


def signed(amount: Column | str, kind: Column | str) -> Column:
    """The amount's effect on a balance: out for debits and fees, in for credits and reversals,
    nothing for any other type."""
    amount, kind = as_col(amount), as_col(kind)
    return (
        F.when(kind.isin(*fv.OUTGOING_TYPES), -amount)
        .when(kind.isin(*fv.INCOMING_TYPES), amount)
        .otherwise(zero())
        .cast(fv.MONEY)
    )


def balance(*candidates: Column | str) -> Column:
    """The first known balance, else zero."""
    return F.coalesce(*[as_col(c).cast(fv.MONEY) for c in candidates], zero())


def percent_of(part: Column | str, whole: Column | str) -> Column:
    """Percentage with two decimals, 0.0 for an empty whole."""
    whole = as_col(whole)
    return F.when(whole > 0, F.round(as_col(part) * F.lit(100.0) / whole, 2)).otherwise(F.lit(0.0))


def amount_is_text(json_line: Column | str, path: str = "$.amount") -> Column:
    """TRUE where a JSON record delivers the value as a string rather than a number.

    Works on the raw line, because a schema that reads both kinds has already lost the
    difference."""
    value = F.try_variant_get(F.try_parse_json(as_col(json_line)), path, "variant")
    return F.coalesce(F.schema_of_variant(value) == F.lit("STRING"), F.lit(False))
