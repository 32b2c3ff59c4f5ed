"""Records that are equal but for formatting, by commutative multiset hashing of their fields."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelode.functions.dates import date_digits
from pricelode.session import checkpointed

#: Sums of hashes are kept to so many bits, so that adding two never overflows.
BITS = (1 << 62) - 1


def plain_text(text: Column) -> Column:
    """Text with what formatting leaves alone: letters, marks, digits and ×, in lower case; the decimal mark between two digits as a comma."""
    low = F.lower(text)
    marked = F.regexp_replace(low, r"(?<=\d)[.,](?=\d)", "\x01")
    # Most names and codes hold nothing to leave out, which is told faster than it is replaced.
    return F.when(low.rlike("^[a-z0-9]*$"), low).otherwise(F.translate(F.regexp_replace(marked, r"[^\p{L}\p{M}\p{N}×\x01]+", ""), "\x01", ","))


def json_fields(text: Column) -> Column:
    """A JSON object's fields as MAP<STRING,STRING>; null where the text is no object. Nested values are compact JSON in which
    the fields of objects are in order of their names, at any depth. Values that this would read as less exact numbers (16
    digits or more, exponents), or that name a field twice, stay as written."""
    fields = F.from_json(text, "map<string,string>")

    def ordered(_: Column, value: Column) -> Column:
        nested = value.rlike(r"^\s*[\[{]") & ~value.rlike(r"\d{16}|\d[eE][+-]?\d")
        return F.when(nested, F.coalesce(F.to_json(F.try_parse_json(value)), value)).otherwise(value)

    # A second brace tells that objects may be nested.
    return F.when(text.rlike(r"\{[^{]*\{"), F.transform_values(fields, ordered)).otherwise(fields)


#: How a column's values are compared.
KINDS: dict[str, Callable[[Column], Column]] = {
    "text": plain_text, "date": date_digits, "number": lambda value: value + F.lit(0), "exact": lambda value: value, "json": json_fields,
}


def _pair(name: Column, value: Column, seed: int) -> Column:
    """The hash of a (field name, value) pair; a null value is told from all others."""
    return F.xxhash64(F.lit(seed), name, value.isNull(), value).bitwiseAND(F.lit(BITS))


def _add(a: Column, b: Column) -> Column:
    return (a + b).bitwiseAND(F.lit(BITS))


def _map_sum(c: str, seed: int) -> Column:
    return F.aggregate(F.map_entries(c), F.lit(0).cast("bigint"), lambda acc, e: _add(acc, _pair(F.concat(F.lit(f"{c}."), e["key"]), e["value"], seed)))


def _fingerprint(fields: list[str], maps: set[str], seed: int) -> Column:
    """The sum of the hashes of all pairs of a record: the same whatever the order of fields."""
    total = F.lit(0).cast("bigint")
    for c in fields:
        if c in maps:
            total = _add(total, F.coalesce(_map_sum(c, seed), F.lit(0).cast("bigint")))
        else:
            total = _add(total, _pair(F.lit(c), F.col(c), seed))
    return total


def _equal(c: str, other: str, is_map: bool) -> Column:
    """Equality of two fields; maps by size and look-up of each key, without sorting."""
    a, b = F.col(c), F.col(other)
    if not is_map:
        return a.eqNullSafe(b)
    there = F.forall(F.map_entries(a), lambda e: F.map_contains_key(b, e["key"]) & F.element_at(b, e["key"]).eqNullSafe(e["value"]))
    return (a.isNull() & b.isNull()) | F.coalesce((F.size(a) == F.size(b)) & there, F.lit(False))


def collapse_formatting(frame: DataFrame, row: str, kinds: dict[str, str]) -> DataFrame:
    """keep, copy (row ids): one row for each copy of a record, whose first row (the smallest id) is `keep`.

    `kinds` maps each column that counts to how: `text` (white space, letter case and punctuation do not count, the decimal
    mark between two digits does), `date` (only digits count), `number`, `exact`, or `json` (an object, whose order of
    fields does not count, in nested objects neither). A null equals only a null; empty and blank texts equal each other; a `json` text that is no
    object is compared as text. Rows with a null id are left out; a repeated id counts as one row; other columns are
    ignored, whatever their names. An empty table gives an empty result.

    Each (field name, normalised value) pair is hashed with two seeds and a record's pairs are added up, so the order of
    fields plays no part and nothing is sorted. Records are grouped by the pair of sums with partial aggregation; only rows
    of groups with several members are read in full again, found by a bitmap of bounded size (see _among). Each is
    verified field by field against its group's first row; any that differ (a collision of 124 bits) are grouped again by
    their whole content. A group with a third of all rows is a few numbers a task after the first aggregation; its rows are
    joined back by a join that adaptive execution splits when skewed.
    """
    given = frame.select(F.col(row).alias("id"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(kinds)]).where("id is not null")
    maps = {f"f{i}" for i, kind in enumerate(kinds.values()) if kind == "json"}

    def normalised(rows: DataFrame, *keep: str) -> DataFrame:
        plain = [KINDS[kind](F.col(f"c{i}")).alias(f"f{i}") for i, kind in enumerate(kinds.values())]
        other = [F.when(json_fields(F.col(f"c{i}")).isNull(), plain_text(F.col(f"c{i}"))).alias(f"t{i}") for i, kind in enumerate(kinds.values()) if kind == "json"]
        return rows.select("id", *keep, *plain, *other)

    printed = normalised(given)
    fields = [c for c in printed.columns if c != "id"]
    prints = checkpointed(printed.select("id", _fingerprint(fields, maps, 1).alias("p1"), _fingerprint(fields, maps, 2).alias("p2")))
    groups = prints.groupBy("p1", "p2").agg(F.min("id").alias("keep"), F.max("id").alias("last")).where("last > keep").drop("last")
    repeated = checkpointed(prints.join(groups, ["p1", "p2"]).select("id", "keep").distinct())
    members = checkpointed(normalised(_among(given, repeated).join(repeated, "id"), "keep"))
    first = members.where("id = keep").groupBy("keep").agg(F.min_by(F.struct(*fields), F.lit(0)).alias("first")).select("keep", *[F.col(f"first.{c}").alias(f"_{c}") for c in fields])
    equal = F.lit(True)
    for c in fields:
        equal = equal & _equal(c, f"_{c}", c in maps)
    judged = members.where("id <> keep").join(first, "keep").withColumn("equal", equal)
    verified = judged.where("equal").select("keep", F.col("id").alias("copy"))
    # A map cannot be a grouping key; its entries in order can.
    whole = judged.where("not equal").select("id", *[F.sort_array(F.map_entries(c)).alias(c) if c in maps else F.col(c) for c in fields])
    again = whole.withColumn("keep", F.min("id").over(Window.partitionBy(*fields))).where("id <> keep").select("keep", F.col("id").alias("copy"))
    return verified.unionByName(again).distinct()


#: 64-bit words of the bitmap that picks rows by id: at most so many are broadcast (16 MB), and so few at least.
WORDS_MOST, WORDS_LEAST = 1 << 20, 1 << 10


def _among(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose id may be among the wanted ones, and few others, so that the rest need no shuffle.

    A bitmap of hashed ids, about ten bits a wanted id, is broadcast; its size is bounded. Beyond that bound it holds ever more of
    the other rows, which the join that follows drops.
    """
    count = wanted.count()
    words = min(WORDS_MOST, max(WORDS_LEAST, 1 << (count // 6).bit_length()))
    place = F.pmod(F.xxhash64("id"), F.lit(words * 64))
    bitmap = wanted.select(F.expr("1L").alias("one"), place.alias("place")).groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.col("one"), (F.col("place") % 64).cast("int"))).alias("bits"))
    kept = rows.withColumn("place", place).join(F.broadcast(bitmap), F.shiftright("place", 6) == F.col("word"))
    return kept.where(F.call_function("getbit", F.col("bits"), (F.col("place") % 64).cast("int")) == 1).drop("place", "word", "bits")


def copy_counts(copies: DataFrame) -> DataFrame:
    """keep, copies (BIGINT): how many copies of each repeated record there are, the first included."""
    return copies.groupBy("keep").agg((F.count("*") + 1).alias("copies"))


def records(frame: DataFrame, row: str, copies: DataFrame) -> DataFrame:
    """keep, copies (BIGINT): every record once, by its first row, with the number of its copies; 1 where nothing repeats it."""
    ids = frame.select(F.col(row).alias("keep")).where("keep is not null").distinct()
    kept = ids.join(copies.select(F.col("copy").alias("keep")), "keep", "left_anti")
    return kept.join(copy_counts(copies), "keep", "left").select("keep", F.coalesce("copies", F.lit(1).cast("bigint")).alias("copies"))
