"""Markets, their currencies and languages, and how a run goes over them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Units of a market's currency per Czech koruna, its currency and the language of its titles.
FX = {"cz": 1.0, "sk": 0.041, "de": 0.041, "at": 0.041, "pl": 0.17}
CURRENCIES = {"cz": "CZK", "sk": "EUR", "de": "EUR", "at": "EUR", "pl": "PLN"}
LANGUAGES = {"cz": "cs", "sk": "sk", "de": "de", "at": "de", "pl": "pl"}


def fx(market: Column) -> Column:
    """The market's rate; null for an unknown market."""
    rate = F.lit(None).cast("double")
    for name, value in FX.items():
        rate = F.when(market == name, value).otherwise(rate)
    return rate


def in_currency(koruna: Column, market: Column) -> Column:
    """A value in koruna in the market's currency, to two digits; koruna stay as they are."""
    return F.when(market == "cz", koruna).otherwise(F.round(koruna * fx(market), 2))


def chosen_markets(names: str | None = None) -> list[str]:
    """Market codes of a comma list, in the order of FX; all for none; an unknown one raises."""
    asked = [n.strip().lower() for n in (names or ",".join(FX)).split(",") if n.strip()]
    if unknown := sorted(set(asked) - set(FX)):
        raise ValueError(f"unknown markets: {', '.join(unknown)}")
    return [m for m in FX if m in asked]


def market_table(spark: SparkSession) -> DataFrame:
    """market, currency, language, fx: one row a market."""
    return spark.createDataFrame([(m, CURRENCIES[m], LANGUAGES[m], FX[m]) for m in FX], "market string, currency string, language string, fx double")


def attempted(spark: SparkSession, sources: dict[str, Callable[[], DataFrame]], schema: str) -> tuple[DataFrame, DataFrame]:
    """The rows of all sources that could be read, with `source` and `seq` (their order), and source, ok, error of every source: a failing one is a row, no exception.

    A source is tried by planning it and taking its first row; rows are put together in the order given, nothing is collected.
    """
    rows, states = spark.createDataFrame([], f"source string, seq int, {schema}"), []
    for seq, (name, read) in enumerate(sources.items()):
        try:
            own = read()
            own.isEmpty()
            rows = rows.unionByName(own.withColumn("source", F.lit(name)).withColumn("seq", F.lit(seq)))
            states.append((name, True, None))
        except Exception as error:  # noqa: BLE001 - the error is the result
            states.append((name, False, f"{type(error).__name__}: {str(error).splitlines()[0]}"))
    return rows, spark.createDataFrame(states, "source string, ok boolean, error string")
