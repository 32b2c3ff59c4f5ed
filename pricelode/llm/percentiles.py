"""Percentiles of very large numeric columns per group, by exact bisection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelode.session import checkpointed

#: Parts that a value interval is cut into in a pass: all midpoints between them are counted at once (2 is plain bisection).
PARTS = 1024
#: Fixed intervals a unit of the natural logarithm, which states count in; any double falls into one of them.
FIRST = 64
#: Groups up to which their intervals (at most two a percentile) are broadcast; beyond, they are joined by a shuffle.
BROADCAST_GROUPS = 20_000


def _fixed_part(v: Column) -> Column:
    """The number of a value's fixed interval; never falls as the value grows."""
    size = F.least(F.floor(F.ln(F.abs(v)) * FIRST), F.lit(60_000)) + 100_000
    return F.when(v > 0, size).when(v < 0, -size).otherwise(0).cast("bigint")


def _part(v: Column, low: Column, high: Column, parts: int) -> Column:
    """The number of a value's part of [low, high]; never falls as the value grows, and the two ends differ in it."""
    part = F.when(v == high, parts - 1).otherwise(F.least(F.floor((v - low) / (high - low) * parts), F.lit(parts - 1)))
    return F.when(F.abs(high - low) < float("inf"), part).otherwise(_fixed_part(v)).cast("bigint")


def numeric_rows(frame: DataFrame, groups: list[str], value: Column, share: Column | None = None) -> DataFrame:
    """g (STRUCT of the group columns), v (DOUBLE) and, if asked for, share (STRING) of the rows that count."""
    shares = [] if share is None else [share.cast("string").alias("share")]
    return frame.select(F.struct(*groups).alias("g"), value.cast("double").alias("v"), *shares).where("v is not null and not isnan(v)")


def interval_states(rows: DataFrame) -> DataFrame:
    """g, share (where the rows have one), part, n, lo, hi: rows, least and greatest value in each fixed interval of a group.

    The state of one day or partition, which may be stored and merged with others later, in any order: the intervals do not
    depend on the data. Its size is that of the intervals in use, not of the rows.
    """
    return rows.groupBy("g", *[c for c in rows.columns if c == "share"], _fixed_part(F.col("v")).alias("part")).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))


def merged_states(states: DataFrame) -> DataFrame:
    """g, part, n, lo, hi: states of shares put together."""
    return states.groupBy("g", "part").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def _narrowed(targets: DataFrame, counts: DataFrame) -> DataFrame:
    """Each target rank moved into the part of its interval that it lies in: (g, rank, base, n, lo, hi)."""
    order = Window.partitionBy("g", "low").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    reached = counts.withColumn("below", F.coalesce(F.sum("n").over(order), F.lit(0)))
    joined = targets.select("g", "low", "rank", "base").join(reached, ["g", "low"])
    return joined.where("rank >= base + below and rank < base + below + n").select("g", "rank", (F.col("base") + F.col("below")).alias("base"), "n", "lo", "hi")


def _inside(rows: DataFrame, targets: DataFrame, few: bool) -> DataFrame:
    """The rows inside an interval that some target still needs, with its ends (low, high)."""
    wanted = targets.groupBy("g").agg(F.collect_set(F.struct("lo", "hi")).alias("intervals"))
    joined = rows.select("g", "v").join(F.broadcast(wanted) if few else wanted, "g")
    held = F.filter("intervals", lambda i: (F.col("v") >= i["lo"]) & (F.col("v") <= i["hi"]))
    return joined.withColumn("held", F.try_element_at(held, F.lit(1))).where("held is not null").select("g", "v", F.col("held.lo").alias("low"), F.col("held.hi").alias("high"))


def _asked(merged: DataFrame, fractions: list[float]) -> DataFrame:
    """g, total, fraction and the place (0-based, between two ranks) of each percentile of each group."""
    totals = merged.groupBy("g").agg(F.sum("n").alias("total"))
    wanted = F.explode(F.array(*[F.lit(float(f)) for f in sorted(set(fractions))])).alias("fraction")
    return totals.select("g", "total", wanted).withColumn("place", F.col("fraction") * (F.col("total") - 1))


def _first_targets(asked: DataFrame, merged: DataFrame) -> DataFrame:
    ends = asked.select("g", F.explode(F.array(F.floor("place"), F.ceil("place"))).alias("rank")).distinct()
    return _narrowed(ends.withColumn("low", F.lit(0.0)).withColumn("base", F.lit(0).cast("bigint")), merged.withColumn("low", F.lit(0.0)))


def _interpolated(asked: DataFrame, done: DataFrame) -> DataFrame:
    """The group columns, n, fraction, value, from the values (g, rank, v) of the ranks."""
    low, high = done.select("g", F.col("rank").alias("rank_low"), F.col("v").alias("v_low")), done.select("g", F.col("rank").alias("rank_high"), F.col("v").alias("v_high"))
    placed = asked.withColumn("rank_low", F.floor("place")).withColumn("rank_high", F.ceil("place")).join(low, ["g", "rank_low"]).join(high, ["g", "rank_high"])
    between = F.when(F.col("v_low") == F.col("v_high"), F.col("v_low")).otherwise(F.col("v_low") + (F.col("v_high") - F.col("v_low")) * (F.col("place") - F.col("rank_low")))
    return placed.select("g.*", F.col("total").alias("n"), "fraction", between.alias("value"))


def bounded_percentiles(states: DataFrame, fractions: list[float]) -> DataFrame:
    """The group columns, n, fraction, value of percentiles from states alone, without their rows.

    Each rank's value is the middle of what its fixed interval holds, at most 1 / (2 x FIRST) of it (0.8 %) off.
    """
    merged = merged_states(states)
    asked = _asked(merged, fractions)
    middle = F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(F.col("lo") / 2 + F.col("hi") / 2)
    return _interpolated(asked, _first_targets(asked, merged).select("g", "rank", middle.alias("v")))


def percentiles(rows: DataFrame, fractions: list[float], *, states: DataFrame | None = None, error: float = 0.0, parts: int = PARTS) -> DataFrame:
    """The group columns, n, fraction, value: percentiles per group of `rows` (see numeric_rows), interpolated between neighbouring ranks.

    Per group and target rank an interval of values is kept, first the fixed one that `states` (those of all shares of the
    rows; by default counted here) place it in. Each pass counts the rows below all midpoints that cut the intervals into
    `parts`, and moves every target into the part its rank lies in; the least and greatest value there are its next
    interval, and one with a single value resolves its targets. Results are exact; with `error` above 0 an interval also
    resolves, to its middle, when it is no wider than 2 x error x its values. States of shares (days, partitions) give the
    same result whatever the shares and their order.

    Null and nan values do not count; a group without values has no row; null group columns form a group; infinities are
    values. Ties and repeated rows count as often as they occur. An empty table gives an empty result.

    A pass is one partial aggregation, so a hot group is reduced to its parts before the shuffle, and counts only rows inside
    intervals still wanted. `rows` are read once a pass: cut their lineage (see checkpointed) if they are costly to make.
    """
    merged = checkpointed(merged_states(interval_states(rows) if states is None else states))
    asked = checkpointed(_asked(merged, fractions))
    few = asked.count() <= BROADCAST_GROUPS * len(set(fractions))
    targets = checkpointed(_first_targets(asked, merged))
    narrow = (F.col("lo") == F.col("hi")) | (F.col("hi") - F.col("lo") <= 2 * error * F.least(F.abs("lo"), F.abs("hi")))
    done = None
    while True:
        ready = targets.where(narrow).select("g", "rank", F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(F.col("lo") / 2 + F.col("hi") / 2).alias("v"))
        done = ready if done is None else done.unionByName(ready)
        rest = targets.where(~narrow)
        if rest.isEmpty():
            return _interpolated(asked, done)
        counts = _inside(rows, rest, few).groupBy("g", "low", _part(F.col("v"), F.col("low"), F.col("high"), parts).alias("part")).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        targets = checkpointed(_narrowed(rest.withColumnRenamed("lo", "low"), counts))
