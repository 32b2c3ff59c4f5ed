"""Pack sizes inside titles, in steps of short Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelode.functions.units import SPELLINGS

#: White space of any kind, the no-break spaces included.
BLANK = r"[\s\p{Z}]"
_UNITS = "|".join(sorted((s for own in SPELLINGS.values() for s in own), key=len, reverse=True))
_NUMBER = rf"\d+{BLANK}?/{BLANK}?\d+|\d+{BLANK}?[½¼¾]|[½¼¾]|\d+(?:[.,]\d+)?"
#: An optional count with x or ×, a number (decimal, fraction), a unit, and then no further letter.
SIZE = rf"(?iu)(?<![\p{{L}}\d.,/])(?:\d{{1,3}}{BLANK}*[x×*]{BLANK}*)?(?:{_NUMBER}){BLANK}*(?:{_UNITS})(?![\p{{L}}\d])"
#: The same in parts, for a size already cut out, in lower case and without white space; the unit may be missing.
_PARTS = r"^(?:(\d{1,3})[x×*])?(\d+/\d+|\d*[½¼¾]|\d+(?:[.,]\d+)?)(\p{L}*)\.?$"
#: Further digits, decimals and a slash make numbers that a double holds exactly enough.
_SLASH = r"^(\d+)/(\d+)$"


def squeezed(text: Column) -> Column:
    """Lower case without white space."""
    return F.regexp_replace(F.lower(text), f"{BLANK}+", "")


def bare_unit(text: Column) -> Column:
    """A unit field as a spelling: lower case, without spaces and points."""
    return F.regexp_replace(F.lower(text), rf"{BLANK}|\.", "")


def _number(text: Column) -> Column:
    vulgar = F.when(text.contains("½"), 0.5).when(text.contains("¼"), 0.25).when(text.contains("¾"), 0.75)
    whole = F.coalesce(F.substring_index(F.translate(text, "½¼¾", "   "), " ", 1).try_cast("double"), F.lit(0.0))
    slash = F.regexp_extract(text, _SLASH, 1).try_cast("double") / F.nullif(F.regexp_extract(text, _SLASH, 2).try_cast("double"), F.lit(0.0))
    return F.coalesce(F.translate(text, ",", ".").try_cast("double"), whole + vulgar, slash)


def with_size(frame: DataFrame, name: str, text: Column, unit: Column | None = None, search: bool = True) -> DataFrame:
    """`frame` with a column STRUCT<count DOUBLE, amount DOUBLE, unit STRING>, null where no size is told.

    With `search` it is the first size anywhere in the text: "máslo 2x40 dkg" gives (2, 40, dkg), "½ kg" (1, 0.5, kg);
    numbers before a per cent sign or another word are none. Without, the whole text must be a size ("200", "0,5",
    "2x100", "500 g"), and `unit` is the unit where the text holds none. Null, empty and very long texts are allowed.

    The text is scanned once; the parts are read from what that cuts out.
    """
    cut, parts = f"_{name}_cut", f"_{name}_parts"
    frame = frame.withColumn(cut, squeezed(F.regexp_extract(text, SIZE, 0) if search else text))
    frame = frame.withColumn(parts, F.when(F.col(cut) != "", F.array(*[F.regexp_extract(F.col(cut), _PARTS, i) for i in (1, 2, 3)])))
    own = F.nullif(F.col(parts)[2], F.lit(""))
    frame = frame.withColumn(f"_{name}_unit", own if unit is None else F.coalesce(own, F.nullif(bare_unit(unit), F.lit(""))))
    frame = frame.withColumn(f"_{name}_amount", _number(F.col(parts)[1]))
    size = F.struct(F.coalesce(F.col(parts)[0].try_cast("double"), F.lit(1.0)).alias("count"), F.col(f"_{name}_amount").alias("amount"), F.col(f"_{name}_unit").alias("unit"))
    return frame.withColumn(name, F.when(F.col(f"_{name}_unit").isNotNull() & F.col(f"_{name}_amount").isNotNull(), size)).drop(cut, parts, f"_{name}_unit", f"_{name}_amount")
