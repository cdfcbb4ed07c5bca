"""Dates, timestamps and what is derived from them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierwell import fixed_values as fv
from tierwell.functions.text import as_col, text


def parse_date(c: Column | str) -> Column:
    """First match of ISO, day-first and Unix epoch (13 characters or more: milliseconds).

    A pattern decides the format and a cast reads it: unlike a parse by format string, a cast that
    fails costs no exception per row.  Epochs are turned into days by arithmetic, so the result
    does not depend on the session's time zone.  Anything unusable is NULL, also under ANSI mode."""
    raw = text(c)
    number = raw.try_cast("double")
    seconds = F.when(F.length(raw) >= fv.EPOCH_MILLIS_MIN_LENGTH, number / F.lit(1000.0)).otherwise(number)
    # Whole seconds first (towards zero), then whole days (downwards).
    days = F.floor(seconds.try_cast("bigint") / F.lit(86400.0)).try_cast("int")
    day_first = F.concat_ws("-", F.substring(raw, 7, 4), F.substring(raw, 4, 2), F.substring(raw, 1, 2))
    return (
        F.when(raw.rlike(fv.ISO_DATE_REGEX), raw.try_cast("date"))
        .when(raw.rlike(fv.DAY_FIRST_REGEX), day_first.try_cast("date"))
        .when(raw.rlike(fv.EPOCH_REGEX), F.date_add(F.lit(date(1970, 1, 1)), days))
    )


def compose_timestamp(day: Column | str, time: Column | str) -> Column:
    """A date and an ``HH:mm:ss`` text as one timestamp; NULL if either is unusable."""
    clock = text(time)
    joined = F.concat(as_col(day).cast("string"), F.lit(" "), clock)
    return F.when(clock.rlike(fv.TIME_REGEX), joined.try_cast("timestamp"))


def age_years(birth: Column | str, as_of: date) -> Column:
    return F.floor(F.datediff(F.lit(as_of), as_col(birth)) / F.lit(fv.DAYS_PER_YEAR))


def age_band(birth: Column | str, as_of: date) -> Column:
    """The age bucket on ``as_of``; NULL for an unknown birth date or an age below the lowest."""
    age = age_years(birth, as_of)
    (lowest, label), *others = fv.AGE_BANDS
    band = F.when(age >= lowest, F.lit(label))
    for lowest, label in others:
        band = band.when(age >= lowest, F.lit(label))
    return band


def sla_class(event_time: Column | str, written_at: Column | str) -> Column:
    """``full`` / ``partial`` / ``none`` by the time between an event and its write, to the microsecond."""
    delay = F.timestamp_diff("MICROSECOND", as_col(event_time), as_col(written_at))
    return (
        F.when(delay.isNull(), None)
        .when(delay <= fv.SLA_FULL_SECONDS * 1_000_000, "full")
        .when(delay <= fv.SLA_PARTIAL_SECONDS * 1_000_000, "partial")
        .otherwise("none")
    )


def latency_seconds(event_time: Column | str, written_at: Column | str) -> Column:
    """Whole seconds between an event and its write."""
    return F.timestamp_diff("SECOND", as_col(event_time), as_col(written_at))


def latency_step(event_time: Column | str, written_at: Column | str) -> Column:
    """The smallest of 0, 1, 2, 4, 8, ... seconds the delay does not exceed; 0 for a write before the event."""
    delay = F.timestamp_diff("MICROSECOND", as_col(event_time), as_col(written_at))
    seconds = F.ceil(delay / F.lit(1_000_000)).cast("bigint")
    # The number of binary digits of one less is the power that is not exceeded, without rounding.
    digits = F.length(F.bin(seconds - 1))
    return F.when(delay <= 0, F.lit(0).cast("bigint")).when(seconds == 1, F.lit(1).cast("bigint")).otherwise(F.pow(F.lit(2.0), digits).cast("bigint"))
