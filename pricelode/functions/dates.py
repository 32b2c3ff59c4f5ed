"""Dates that sources write in different ways."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OPEN_END = "9999-12-31"


def date_digits(text: Column) -> Column:
    """The digits of a date text: 2026-06-01, 2026/06/01, 2026.06.01 and 20260601 all give 20260601; null stays null."""
    return F.regexp_replace(text, r"[^0-9]", "")


def flexible_date(text: Column) -> Column:
    """A DATE from year-first text with any or no separators and white space around it; null where it is no valid day."""
    digits = date_digits(text)
    return F.when(F.length(digits) == 8, F.try_to_timestamp(digits, F.lit("yyyyMMdd")).cast("date"))


def _day(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date")


def iso_day(text: Column) -> Column:
    """The DATE of a text's first ten characters (2026-09-08T00:00 too); null where they are no valid day."""
    start = F.substring(text, 1, 10)
    return F.when(start.rlike(r"^\d{4}-\d\d-\d\d$"), _day(start))


def iso_prefix(text: Column) -> Column:
    """The text's first ten characters if they look like a day, valid or not."""
    return F.nullif(F.regexp_extract(text, r"^(\d{4}-\d{2}-\d{2})", 1), F.lit(""))


def of_parts(year: Column, month: Column, day: Column) -> Column:
    """A DATE of numbers; null where there is no such day."""
    return _day(F.format_string("%04d-%02d-%02d", year.try_cast("int"), month.try_cast("int"), day.try_cast("int")))


def dotted_day(text: Column) -> Column:
    """The first d.m.yyyy of a text."""
    pattern = r"(\d{1,2})\.(\d{1,2})\.(\d{4})"
    return F.when(text.rlike(pattern), of_parts(*[F.regexp_extract(text, pattern, i) for i in (3, 2, 1)]))


# Fixed value: leaflet names such as velky-letak-30-12-5-1-2027: kind, first day and month, last day and month, year.
SLUG = r"((velky|maly)-letak-(\d{1,2})-(\d{1,2})-(\d{1,2})-(\d{1,2})-(\d{4}))"


def slug_period(slug: Column) -> Column:
    """STRUCT<kind, valid_from, valid_to> of a leaflet name; a first day behind the last is in the year before. Null where it is no such name or day."""
    part = lambda i: F.regexp_extract(slug, SLUG, i)
    last, first, before = of_parts(part(7), part(6), part(5)), of_parts(part(7), part(4), part(3)), of_parts(part(7).try_cast("int") - 1, part(4), part(3))
    start = F.when(last < first, before).otherwise(first)
    return F.when(slug.rlike(SLUG) & start.isNotNull() & last.isNotNull(), F.struct(part(2).alias("kind"), start.alias("valid_from"), last.alias("valid_to")))


def slugs(page: Column) -> Column:
    """Distinct leaflet names of a page, in order of their first place; escaped slashes count as slashes."""
    return F.array_distinct(F.regexp_extract_all(F.replace(page, F.lit("\\u002F"), F.lit("/")), F.lit(SLUG), F.lit(1)))


def chosen_period(periods: Column, today: Column) -> Column:
    """Of an ARRAY<STRUCT<first DATE, last DATE>> the first period that holds today (a null last day is open), else the earliest that
    begins later, else the one that ended last."""
    holding = F.filter(periods, lambda p: (p["first"] <= today) & F.coalesce(p["last"] >= today, F.lit(True)))
    later = F.array_sort(F.filter(periods, lambda p: p["first"] > today))
    past = F.array_max(F.transform(periods, lambda p: F.struct(F.coalesce(p["last"], p["first"]).alias("ended"), p["first"].alias("began"), p.alias("period"))))["period"]
    return F.coalesce(F.try_element_at(holding, F.lit(1)), F.try_element_at(later, F.lit(1)), past)


def validity(text: Column, today: Column, end: Column) -> Column:
    """STRUCT<valid_from, valid_to> of a validity text: today or tomorrow by name, one or two days without year (the nearest year to
    today), or `end` for "current" ones. One day alone is the last. Null parts where nothing is told."""
    from pricelode.functions.prices import let

    return let(F.lower(F.trim(F.regexp_replace(text, r"[\s\p{Z}]+", " "))), lambda low: _validity(low, today, end))


def _validity(low: Column, today: Column, end: Column) -> Column:
    from pricelode.functions.numbers import nearest_year

    hits = F.regexp_extract_all(low, F.lit(r"(\d{1,2}\.\s*\d{1,2}\.)"), F.lit(1))
    one = lambda i: nearest_year(F.regexp_extract(F.try_element_at(hits, F.lit(i)), r"^(\d+)", 1).try_cast("int"), F.regexp_extract(F.try_element_at(hits, F.lit(i)), r"\.\s*(\d+)", 1).try_cast("int"), today)
    none = F.lit(None).cast("date")
    pair = lambda a, b: F.struct(a.alias("valid_from"), b.alias("valid_to"))
    return (
        F.when(low.contains("dnes"), pair(today, today)).when(low.rlike("z[íi]tra"), pair(today, F.date_add(today, 1)))
        .when(F.size(hits) >= 2, pair(one(1), one(2))).when(F.size(hits) == 1, pair(today, one(1))).when(low.contains("aktu"), pair(today, end)).otherwise(pair(none, none))
    )


def duration_seconds(start: Column, end: Column) -> Column:
    """Whole seconds between two timestamps, never below zero."""
    return F.greatest(F.lit(0).cast("bigint"), F.unix_timestamp(end) - F.unix_timestamp(start))
