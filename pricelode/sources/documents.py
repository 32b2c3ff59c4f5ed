"""Semi-structured inputs: JSON that is a list or a wrapped list, HTML pages, page files by source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def wrapped_rows(spark: SparkSession, path: str, schema: str, wrappers: tuple[str, ...] = ("offers", "items", "rows", "data")) -> DataFrame:
    """Rows of JSON files that each hold a list of objects, or an object with such a list under one of `wrappers`; with `source`, the file's stem.

    The schema is given, never inferred; a byte order mark is allowed; a file that is neither, or an element that is no
    object, gives no rows.
    """
    text = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", "^\ufeff", "").alias("text"), F.col("_metadata.file_name").alias("file"))
    rows = f"array<struct<{', '.join(schema.split(', '))}>>"
    tries = [F.when(F.ltrim("text").startswith("["), F.from_json("text", rows))] + [F.from_json(F.get_json_object("text", f"$.{w}"), rows) for w in wrappers]
    return text.select(F.regexp_replace("file", r"\.json$", "").alias("source"), F.explode(F.coalesce(*tries)).alias("row")).where("row is not null").select("source", "row.*")


def links(html: Column) -> Column:
    """Targets of the links of an HTML page, in order."""
    return F.regexp_extract_all(html, F.lit(r'(?i)<a\s[^>]*href="([^"]*)"'), F.lit(1))


def embedded_json(html: Column, element: str, schema: str) -> Column:
    """JSON inside <script id=element>, parsed; null where there is none."""
    return F.from_json(F.regexp_extract(html, rf'(?s)<script[^>]*id="{element}"[^>]*>(.*?)</script>', 1), schema)
