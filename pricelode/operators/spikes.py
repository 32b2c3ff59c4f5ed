"""Implausible readings in series of measurements: spikes, stuck values, impossible values."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelode.session import checkpointed


@dataclass(frozen=True)
class SpikeRule:
    """What counts as implausible.

    reach: observations on each side that make up the level. longest: rows that may be off together and still be a spike.
    scatters: distance from the level, in scatters of the source (1.4826 x median absolute deviation of logarithms), from
    which a row is far off; `least` (a logarithm: 0.24 is about a quarter more) where a source has no scatter. stuck_times and stuck_least: how many
    times the source's usual run, and how many observations, a run of one value must have.
    """

    reach: int = 5
    longest: int = 3
    scatters: float = 4.75
    least: float = 0.24
    stuck_times: float = 3.0
    stuck_least: int = 8


#: Resolution of the histograms of deviations: bins a unit of logarithm of the deviation.
BINS = 50
_LOWEST = -14.0  # deviations below exp(-14) count as none


def _windows(values: np.ndarray, group: np.ndarray, offsets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Median of values[at + offsets] within the group of `at`; nan where none lies in it."""
    n = len(values)
    index = at[:, None] + offsets[None, :]
    clipped = np.clip(index, 0, n - 1)
    inside = (index >= 0) & (index < n) & (group[clipped] == group[at][:, None])
    taken = np.sort(np.where(inside, values[clipped], np.inf), axis=1)
    count = inside.sum(axis=1)
    rows = np.arange(len(at))
    low, high = taken[rows, np.maximum(count - 1, 0) // 2], taken[rows, np.minimum(count // 2, len(offsets) - 1)]
    return np.where(count > 0, (np.where(count > 0, low, 0) + np.where(count > 0, high, 0)) / 2, np.nan)


def spike_scores(values: np.ndarray, group: np.ndarray, rule: SpikeRule) -> np.ndarray:
    """How far each value is from the level around it, if it belongs to at most `longest` neighbours that are off together.

    For each start and length the level before is the median of the `reach` values before, the level after that of those
    after. A group's distance is the least of its members' distances from either level, each in its own direction; the values
    next to the group must lie by the level, else the group is part of a longer change and no spike. Lasting changes of
    level thus score nothing: their level after is the new one.
    """
    n = len(values)
    score = np.zeros(n)
    if n == 0:
        return score
    at = np.arange(n)
    before = _windows(values, group, np.arange(-rule.reach, 0), at)
    for length in range(1, rule.longest + 1):
        last = at + length - 1
        whole = (last < n) & (group[np.clip(last, 0, n - 1)] == group)
        after = _windows(values, group, np.arange(length, length + rule.reach), at)
        left, right = np.where(np.isnan(before), after, before), np.where(np.isnan(after), before, after)
        member = np.stack([values[np.clip(at + t, 0, n - 1)] for t in range(length)])
        above, below = np.minimum(member - left, member - right), np.minimum(left - member, right - member)
        distance = np.where(whole, np.nan_to_num(np.maximum(np.maximum(above, below), 0).min(axis=0)), 0)
        level = (left + right) / 2
        for neighbour in (at - 1, at + length):
            clipped = np.clip(neighbour, 0, n - 1)
            there = (neighbour >= 0) & (neighbour < n) & (group[clipped] == group)
            distance = np.where(there & (np.abs(values[clipped] - np.nan_to_num(level)) > distance / 2), 0, distance)
        for t in range(length):
            np.maximum.at(score, np.clip(at + t, 0, n - 1), distance)
    return score


def _runs(values: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the run of equal values each row is in, and the rows of each run."""
    first = np.r_[True, (group[1:] != group[:-1]) | (values[1:] != values[:-1])]
    number = np.cumsum(first) - 1
    return number, np.bincount(number)


#: Rows of one series that are judged together; of a longer one, pieces overlap by what a verdict looks at.
PIECE = 50_000


def _continued(frame: pd.DataFrame, rule: SpikeRule) -> tuple[pd.DataFrame, pd.DataFrame]:
    """A part of one long series as the piece to judge now and what the next piece starts with.

    The last rows, of each regime as many as a verdict looks ahead, wait for what follows; they are moved back to the start of
    their run of equal values (at most half a piece: such a run is far longer than any usual one wherever it is cut). The rows
    before are repeated in the next piece as context, which is looked at but not judged again.
    """
    around = 2 * (rule.reach + rule.longest)
    behind = frame.groupby("regime", dropna=False).cumcount(ascending=False).values
    keep = int(np.nonzero(behind >= around)[0].max()) + 1 if (behind >= around).any() else 0
    value = frame.value.values
    start = keep
    while start > max(0, keep - PIECE // 2) and value[start - 1] == value[min(start, len(value) - 1)]:
        start -= 1
    keep = start if start > keep - PIECE // 2 else keep
    now = frame.copy()
    now.loc[now.index[keep:], "context"] = True
    before = frame.iloc[:keep]
    last = before[before.groupby("regime", dropna=False).cumcount(ascending=False).values < around].assign(context=True)
    return now, pd.concat([last, frame.iloc[keep:]], ignore_index=True)


def _profile(rule: SpikeRule, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole series, sorted by observation, to candidates and to counts of what is usual for their source.

    Yields (kind, source, row_id, metric, weight): `deviation` and `run` are histograms, `spike` and `stuck` rows that a
    threshold of their source will decide on. Only unfinished series are held between batches.
    """
    held: list[pd.DataFrame] = []
    counts: dict[tuple[str, str | None, float], int] = {}

    def work(frame: pd.DataFrame) -> Iterator[pa.RecordBatch]:
        series = (frame.series.values[1:] != frame.series.values[:-1]) | (frame.source.values[1:] != frame.source.values[:-1])
        frame["number"] = np.r_[0, np.cumsum(series)]
        frame = frame[~frame.row_id.duplicated()]  # a second delivery lies beside the first
        own = ~frame.context.values
        number, size = _runs(frame.value.values, frame.number.values)
        source = frame.source.values
        starts = np.r_[0, np.cumsum(size)[:-1]] if len(size) else np.array([], int)
        begun = own[starts]
        for (name, length), n in pd.DataFrame({"s": source[starts][begun], "n": size[begun]}).groupby(["s", "n"], dropna=False).size().items():
            add("run", name, float(length), int(n))
        length = size[number]
        long = (length >= rule.stuck_least) & own
        yield from emit("stuck", source[long], frame.row_id.values[long], length[long].astype(float))

        plain = frame[frame.plausible.values].sort_values(["number", "regime"], kind="stable")
        if len(plain):
            value = np.log(plain.value.values)
            group = np.cumsum(np.r_[0, (plain.number.values[1:] != plain.number.values[:-1]) | (plain.regime.values[1:] != plain.regime.values[:-1])])
            score = spike_scores(value, group, rule)
            mine = ~plain.context.values
            off = (score > 0) & mine
            yield from emit("spike", plain.source.values[off], plain.row_id.values[off], score[off])
            # The usual scatter is that between values, however long each is held: one value a run.
            first = np.r_[True, (group[1:] != group[:-1]) | (value[1:] != value[:-1])]
            own, of = value[first], group[first]
            around = np.r_[np.arange(-rule.longest, 0), np.arange(1, rule.longest + 1)]
            deviation = np.abs(own - _windows(own, of, around, np.arange(len(own))))
            known = ~np.isnan(deviation) & mine[first]
            binned = np.floor(np.maximum(np.log(np.maximum(deviation[known], 1e-12)), _LOWEST) * BINS)
            for (name, at), n in pd.DataFrame({"s": plain.source.values[first][known], "b": binned}).groupby(["s", "b"], dropna=False).size().items():
                add("deviation", name, float(at), int(n))

    def add(kind: str, source: str | None, at: float, n: int) -> None:
        key = (kind, None if source is None or source != source else source, at)
        counts[key] = counts.get(key, 0) + n

    def emit(kind: str, source: np.ndarray, row: np.ndarray, metric: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(row):
            yield pa.RecordBatch.from_arrays([pa.array([kind] * len(row)), pa.array(source, pa.string(), from_pandas=True), pa.array(row, pa.int64()), pa.array(metric, pa.float64()), pa.array(np.ones(len(row), np.int64))], ["kind", "source", "row_id", "metric", "weight"])

    rows = 0
    for batch in batches:
        frame = batch.to_pandas()
        if not len(frame):
            continue
        if held and held[-1].row_id.values[-1] == frame.row_id.values[0]:
            frame = frame.iloc[1:]
        held.append(frame.assign(context=False))
        rows += len(frame)
        if rows >= PIECE and len(frame):
            frame = pd.concat(held, ignore_index=True)
            other = np.nonzero((frame.series.values != frame.series.values[-1]) | (frame.source.values != frame.source.values[-1]))[0]
            cut = int(other[-1]) + 1 if len(other) else 0
            if len(frame) - cut < PIECE:
                held, rows = [frame.iloc[cut:]], 0
                if cut:
                    yield from work(frame.iloc[:cut].copy())
            else:  # one series that is longer than a piece
                rest = _continued(frame.iloc[cut:], rule)
                yield from work(pd.concat([frame.iloc[:cut], rest[0]]).copy())
                held, rows = [rest[1]], len(rest[1])
    if held:
        yield from work(pd.concat(held, ignore_index=True))
    if counts:
        keys = list(counts)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys], pa.string()), pa.array([None] * len(keys), pa.int64()), pa.array([k[2] for k in keys], pa.float64()), pa.array(list(counts.values()), pa.int64())], ["kind", "source", "row_id", "metric", "weight"])


def _usual(profile: DataFrame, kind: str) -> DataFrame:
    """source, metric: the median of a histogram per source, from counts that were added up before."""
    counts = profile.where(F.col("kind") == kind).groupBy("source", "metric").agg(F.sum("weight").alias("n"))
    order = Window.partitionBy("source").orderBy("metric")
    ranked = counts.withColumn("upto", F.sum("n").over(order)).withColumn("total", F.sum("n").over(Window.partitionBy("source")))
    return ranked.where("upto * 2 >= total").groupBy("source").agg(F.min("metric").alias("usual"))


def _joined(columns: list[str]) -> Column:
    """The columns as one text that no other values make: each after its length, a null without one."""
    return F.concat(*[F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")) for text in (F.col(c).cast("string") for c in columns)])


def implausible_in_series(frame: DataFrame, *, row: str, source: str, series: list[str], regime: str, at: str, value: Column, impossible: Column, rule: SpikeRule = SpikeRule()) -> DataFrame:
    """row_id, why (`spike` or `stuck`) of readings that cannot be right for their source at their place; each row and why once.

    A series is (source, series columns), in order of `at`; spikes are sought among the rows of one `regime` of a series
    (e.g. promotion or not), by a Hampel filter on logarithms whose scatter is the source's (see spike_scores), stuck
    values among all priced rows of a series, by run length against the source's usual run. Rows that `impossible` holds
    for are no spikes and part of no level, but they end a run. A null value is no observation; a null source, series
    column, regime or time is a value like any other; rows with a null id are left out; a second delivery of a row id
    counts once (deliveries of one id must agree in series and time). An empty table gives an empty result.

    Hot sources, markets and items spread over their series; a series of more than PIECE rows is judged in overlapping pieces,
    so what a task holds is bounded. Repeated deliveries are dropped while rows stream in. What is
    usual for a source is the median of histograms that tasks fill and Spark adds up.
    """
    rows = frame.select(
        _joined(series).alias("series"), F.col(source).alias("source"),
        F.col(at).alias("at"), F.col(row).alias("row_id"), F.coalesce(F.col(regime).cast("int"), F.lit(-1)).alias("regime"),
        value.alias("value"), F.coalesce(~impossible, F.lit(True)).alias("plausible"),
    ).where("value is not null and not isnan(value) and row_id is not null")
    together = rows.repartition("series", "source").sortWithinPartitions("series", "source", "at", "row_id").drop("at")
    profile = checkpointed(together.mapInArrow(partial(_profile, rule), "kind string, source string, row_id bigint, metric double, weight bigint"))
    scatter = _usual(profile, "deviation").select(F.col("source").alias("s"), F.when(F.col("usual") <= _LOWEST * BINS, rule.least).otherwise(rule.scatters * 1.4826 * F.exp((F.col("usual") + 0.5) / BINS)).alias("limit"))
    hold = _usual(profile, "run").select(F.col("source").alias("s"), F.greatest(F.lit(float(rule.stuck_least)), rule.stuck_times * F.col("usual")).alias("limit"))
    out = []
    for kind, limits in (("spike", scatter), ("stuck", hold)):
        rows = profile.where(F.col("kind") == kind)
        out.append(rows.join(limits, rows["source"].eqNullSafe(limits["s"])).where("metric >= limit").select("row_id", F.lit(kind).alias("why")))
    return out[0].unionByName(out[1])


def implausible_in_stretches(frame: DataFrame, *, row: str, stretch: list[str], value: Column, impossible: Column, least: float = 0.2, rounding: float = 0.06) -> DataFrame:
    """row_id, why (`stray`) of values far from the rest of their stretch, in which one value is carried on purpose.

    Far: the logarithm is `least` off the stretch's median and the value more than `rounding` (values may be rounded to
    one digit). The median is taken over the rows that are not impossible, each row id once. Stretches are grouped with
    null-safe keys; null values and ids are left out. The median is aggregated from counts of distinct values, so a hot
    stretch is reduced before it is shuffled.
    """
    keys = [f"k{i}" for i in range(len(stretch))]
    rows = frame.select(*[F.col(c).alias(k) for c, k in zip(stretch, keys)], F.col(row).alias("row_id"), F.when(~F.coalesce(impossible, F.lit(False)), value).alias("value")).where("value > 0 and not isnan(value) and row_id is not null")
    once = rows.groupBy(*keys, "row_id").agg(F.max("value").alias("value"))
    level = once.groupBy(*keys).agg(F.median("value").alias("level"), F.min("value").alias("low"), F.max("value").alias("high")).where("high > low").select(*[F.col(k).alias(f"l{k}") for k in keys], "level")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"l{k}"))
    return once.join(level, same).where((F.abs(F.ln(F.col("value") / F.col("level"))) > least) & (F.abs(F.col("value") - F.col("level")) > rounding)).select("row_id", F.lit("stray").alias("why"))


def impossible_rows(frame: DataFrame, *, row: str, impossible: Column) -> DataFrame:
    """row_id, why (`impossible`) of rows outside the physical bounds; null ids are left out."""
    return frame.where(impossible & F.col(row).isNotNull()).select(F.col(row).alias("row_id"), F.lit("impossible").alias("why"))
