"""Structured Streaming forms of batch operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pricelode.operators.intervals import IntervalMap
from pricelode.operators.relational import top_per_group


def interval_stream(stream: DataFrame, entity: str) -> DataFrame:
    """entity, span_kind (`period` or `gap`), day_from, day_to (INT days): after each batch all continuous periods, and the gaps
    between them, of every entity that got intervals.

    `stream` has entity, day_from and day_to (INT days). Each entity's ordered map of disjoint periods is its keyed state,
    which survives restarts; an insertion finds overlaps by binary search. Reversed and null intervals are left out.
    """
    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        own = IntervalMap()
        if state.exists:
            own.starts, own.ends = map(list, state.get)
        for batch in batches:
            for a, b in zip(batch.day_from, batch.day_to):
                if a == a and b == b and a is not None and b is not None and a <= b:
                    own.insert(int(a), int(b))
        state.update((own.starts, own.ends))
        spans = [("period", a, b) for a, b in zip(own.starts, own.ends)] + [("gap", a, b) for a, b in own.gaps()]
        yield pd.DataFrame([(key[0], *span) for span in spans], columns=["entity", "span_kind", "day_from", "day_to"])

    kind = dict(stream.dtypes)[entity]
    grouped = stream.select(F.col(entity).alias("entity"), "day_from", "day_to").groupBy("entity")
    return grouped.applyInPandasWithState(update, f"entity {kind}, span_kind string, day_from int, day_to int", "starts array<int>, ends array<int>", "update", GroupStateTimeout.NoTimeout)


def upsert_batches(path: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that keeps each batch in a folder of its own under `path`; see upserted for reading.

    A batch that is run again replaces only its own folder, and rows of others are never rewritten, so a failure at any moment
    loses nothing: until a batch's folder is committed, readers see the state before it.
    """
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def upserted(spark: SparkSession, path: str, keys: list[str], latest: str) -> DataFrame:
    """Of all rows that upsert_batches wrote, per key the one with the greatest `latest`; of equal ones that of the last batch."""
    rows = spark.read.parquet(path)
    columns = [c for c in rows.columns if c != "batch"]
    return top_per_group(rows, keys, [F.col(latest).desc_nulls_last(), F.col("batch").desc(), F.xxhash64(*columns)]).select(*columns)


def compact(spark: SparkSession, path: str, target: str, keys: list[str], latest: str) -> None:
    """The state of `path` as the first batch of a new folder, from which a stream may go on."""
    upserted(spark, path, keys, latest).write.mode("errorifexists").parquet(f"{target}/batch=0")
