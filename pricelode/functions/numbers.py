"""Numbers inside text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_number(text: Column) -> Column:
    """The first number, decimal comma allowed, else null."""
    return F.replace(F.regexp_extract(text, r"(\d+(?:[.,]\d+)?)", 1), F.lit(","), F.lit(".")).try_cast("double")


def whole_number(text: Column) -> Column:
    """The text as a number if all of it is one, spaces and no-break spaces apart, else null."""
    return F.replace(F.regexp_replace(text, "[\\s\\x{a0}]", ""), F.lit(","), F.lit(".")).try_cast("double")


def nearest_year(day: Column, month: Column, today: Column) -> Column:
    """The date with that day and month, of the year before, this and the next, that is nearest to today; ties go to the earlier."""
    def of(shift: int) -> Column:
        return F.try_to_timestamp(F.format_string("%04d-%02d-%02d", F.year(today) + shift, month, day), F.lit("yyyy-MM-dd")).cast("date")

    return F.array_min(F.filter(F.array(*[F.struct(F.abs(F.datediff(of(s), today)).alias("far"), of(s).alias("day")) for s in (-1, 0, 1)]), lambda x: x["day"].isNotNull()))["day"]


def next_weekday(day: Column, weekday: int) -> Column:
    """The next day with that weekday (Monday is 0), the day itself included."""
    return F.date_add(day, F.pmod(F.lit(weekday) - F.weekday(day), F.lit(7)))


def epoch_to_local_date(seconds: Column, zone: str) -> Column:
    """The calendar date at a place of a moment in epoch seconds (session zone UTC)."""
    return F.to_date(F.from_utc_timestamp(F.timestamp_seconds(seconds), zone))
