"""Overlapping, nested and gapped intervals per entity, as ordered maps of disjoint intervals."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class IntervalMap:
    """Disjoint, non-adjacent closed intervals of whole days, kept in order.

    `insert` finds the intervals that overlap or directly touch the new one by binary search and replaces them by their
    union, so the map always holds the continuous periods, and the gaps are what lies between neighbours.
    """

    __slots__ = ("ends", "starts")

    def __init__(self) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []

    def insert(self, start: int, end: int) -> None:
        starts, ends = self.starts, self.ends
        if not starts or start > ends[-1] + 1:
            starts.append(start)
            ends.append(end)
            return
        low = bisect_left(ends, start - 1)  # the first that reaches start or the day before
        high = bisect_right(starts, end + 1)  # behind the last that begins by end or the day after
        if low < high:
            start, end = min(start, starts[low]), max(end, ends[high - 1])
        starts[low:high] = [start]
        ends[low:high] = [end]

    def gaps(self) -> Iterator[tuple[int, int]]:
        for left, right in zip(self.ends, self.starts[1:]):
            yield left + 1, right - 1


#: Intervals that a pre-merging task holds before it passes them on.
HELD = 200_000


def _columns(batch: pa.RecordBatch) -> tuple[list, list, list]:
    return batch.column(0).to_pylist(), batch.column(1).cast(pa.int32()).to_pylist(), batch.column(2).cast(pa.int32()).to_pylist()


def _premerge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merges what one task has of each entity, so that a hot entity crosses the shuffle as a few periods."""
    held: dict[str, IntervalMap] = {}
    rows = 0

    def flush() -> pa.RecordBatch:
        keys = [key for key, own in held.items() for _ in own.starts]
        starts = [x for own in held.values() for x in own.starts]
        ends = [x for own in held.values() for x in own.ends]
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], ["entity", "day_from", "day_to"])

    for batch in batches:
        for key, start, end in zip(*_columns(batch)):
            own = held.get(key)
            if own is None:
                own = held[key] = IntervalMap()
            own.insert(start, end)
        rows += batch.num_rows
        if rows >= HELD:
            yield flush()
            held.clear()
            rows = 0
    if held:
        yield flush()


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive with all of an entity together; its map is the only state."""
    entity: str | None = None
    own = IntervalMap()
    kinds: list[str] = []
    keys: list[str] = []
    starts: list[int] = []
    ends: list[int] = []

    def close() -> None:
        if entity is None:
            return
        kinds.extend(["period"] * len(own.starts))
        starts.extend(own.starts)
        ends.extend(own.ends)
        for a, b in own.gaps():
            kinds.append("gap")
            starts.append(a)
            ends.append(b)
        keys.extend([entity] * (2 * len(own.starts) - 1))

    def out() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(keys, pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], ["span_kind", "entity", "day_from", "day_to"])
        for part in (kinds, keys, starts, ends):
            part.clear()
        return batch

    for batch in batches:
        for key, start, end in zip(*_columns(batch)):
            if key != entity:
                close()
                entity, own = key, IntervalMap()
            own.insert(start, end)
        if len(kinds) >= 20_000:
            yield out()
    close()
    if kinds:
        yield out()


def merge_intervals(frame: DataFrame, entity: list[str], start: Column, end: Column) -> DataFrame:
    """Continuous periods and the gaps between them, per entity: span_kind (`period` or `gap`), the entity columns, span_from, span_to (DATE, both included).

    `start` and `end` are DATE columns. Rows with a null in an entity column, start or end, or with start after end, are
    left out; repeated rows and ties change nothing; an empty table gives an empty result; other columns are ignored,
    whatever their names. 9999-12-31 is an ordinary day.

    Each task first merges what it holds of an entity into disjoint intervals, so an entity with a third of all rows is
    shuffled as at most that many periods per task; after the shuffle rows of one entity stream through one ordered map,
    whose size is bounded by the disjoint periods a calendar can hold.
    """
    key = F.to_json(F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(entity)]))
    present = start.isNotNull() & end.isNotNull() & (start <= end)
    for c in entity:
        present = present & F.col(c).isNotNull()
    rows = frame.where(present).select(key.alias("entity"), F.datediff(start, F.lit("1970-01-01")).alias("day_from"), F.datediff(end, F.lit("1970-01-01")).alias("day_to"))
    held = rows.mapInArrow(_premerge, "entity string, day_from int, day_to int")
    together = held.repartition("entity").sortWithinPartitions("entity", "day_from")
    spans = together.mapInArrow(_merge, "span_kind string, entity string, day_from int, day_to int")
    types = dict(frame.dtypes)
    parsed = F.from_json("entity", ", ".join(f"k{i} {types[c]}" for i, c in enumerate(entity)))
    return spans.withColumn("k", parsed).select(
        "span_kind", *[F.col(f"k.k{i}").alias(c) for i, c in enumerate(entity)],
        F.date_add(F.lit("1970-01-01").cast("date"), F.col("day_from")).alias("span_from"),
        F.date_add(F.lit("1970-01-01").cast("date"), F.col("day_to")).alias("span_to"),
    )
