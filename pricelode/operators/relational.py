"""Relational building blocks: ordered choice, completion, merging and blocking, as DataFrame operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelode.functions.text import fold, fold_plain, rule_regex
from pricelode.session import checkpointed


def top_per_group(frame: DataFrame, by: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first n rows of each group in an order that has no ties. Spark prunes each task's rows to n a group before the shuffle."""
    return frame.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_rank") <= n).drop("_rank")


def first_failing(checks: list[tuple[str, Column]]) -> Column:
    """The name of the first check that fails (is not true), null if all hold."""
    return reduce(lambda rest, check: F.when(~F.coalesce(check[1], F.lit(False)), check[0]).otherwise(rest), reversed(checks), F.lit(None).cast("string"))


def first_match(frame: DataFrame, rules: DataFrame, *, text: str, store: str, market: str) -> DataFrame:
    """`frame` with `ordinal` and `target` of the first rule that its folded text matches, for rules of its store and market or of all (`*`).

    `rules`: ordinal, pattern (see text.rule_regex), target, store, market; null stores and markets count as `*`. Rows without a
    hit are left out. A market's rules, in order, travel as one list, joined on the market; rules are as many as people wrote,
    and Spark decides by their size whether to broadcast them.
    """
    every = F.lit("*")
    own = rules.select(F.coalesce("market", every).alias("_market"), F.struct("ordinal", rule_regex(F.col("pattern")).alias("regex"), "target", F.coalesce("store", every).alias("store")).alias("rule")).where("rule.regex is not null")
    general = own.where("_market = '*'").select("rule")
    named = own.where("_market <> '*'").select("_market").distinct()
    # Every named market has the general rules too: one row a market and general rule.
    spread = named.withColumn("_one", F.lit(1)).join(general.withColumn("_one", F.lit(1)), "_one").select("_market", "rule")
    lists = own.unionByName(spread).groupBy("_market").agg(F.array_sort(F.collect_list("rule")).alias("_rules"))
    known = F.broadcast(lists.select("_market").withColumn("_known", F.lit(True)))  # one row a market
    keyed = frame.join(known, frame[market] == F.col("_market"), "left").drop("_market").withColumn("_key", F.when(F.col("_known"), F.col(market)).otherwise(every))
    tested = keyed.join(lists, F.col("_key") == F.col("_market")).withColumn("_folded", fold(F.col(text)))
    hit = F.try_element_at(F.filter("_rules", lambda r: (r["store"].isin("*", "") | (r["store"] == F.col(store))) & F.rlike(F.col("_folded"), r["regex"])), F.lit(1))
    return tested.withColumn("_hit", hit).where("_hit is not null").select(*frame.columns, "_hit.ordinal", "_hit.target")


def complete(counts: DataFrame, frame: DataFrame, on: list[str], value: str) -> DataFrame:
    """Every row of a dimension with its value, 0 where there is none."""
    return frame.join(counts, on, "left").withColumn(value, F.coalesce(F.col(value), F.lit(0)))


def medians(frame: DataFrame, by: list[str], value: str) -> DataFrame:
    """The group columns, `median` (exact, between the two middle values) and `n` (rows with a value).

    Equal values are counted before they are shuffled, and the middle is found by a running count over distinct values, so
    a hot group is never held in memory. Null and nan values do not count; null group columns form a group.
    """
    counts = frame.where(F.col(value).isNotNull() & ~F.isnan(F.col(value))).groupBy(*by, F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    whole = Window.partitionBy(*by)
    placed = counts.withColumn("_upto", F.sum("_n").over(whole.orderBy("_v"))).withColumn("_all", F.sum("_n").over(whole))
    low, high = (F.min(F.when(F.col("_upto") > F.floor((F.col("_all") - k) / 2), F.col("_v"))) for k in (1, 0))
    return placed.groupBy(*by).agg(((low + high) / 2).alias("median"), F.max("_all").alias("n"))


def conditional_median(frame: DataFrame, by: list[str], value: str, preferred: Column) -> DataFrame:
    """`per_group`: the median of the preferred rows of a group, of all others if there are none; `n` rows in all."""
    flagged = frame.withColumn("_preferred", preferred)
    each = medians(flagged.where("_preferred is not null"), [*by, "_preferred"], value)
    middle = each.groupBy(*by).agg(F.coalesce(F.max(F.when(F.col("_preferred"), F.col("median"))), F.max("median")).alias("per_group"))
    return frame.groupBy(*by).agg(F.count("*").alias("n")).join(middle, by, "left").select(*by, "per_group", "n")


def merge_rules(old: DataFrame, new: DataFrame, on: list[str], value: str) -> DataFrame:
    """Old rows replaced by new ones with equal keys, and new ones added."""
    n = new.withColumnRenamed(value, "_new")
    return old.join(n, on, "full_outer").withColumn(value, F.coalesce("_new", value)).drop("_new")


def blocked_prefix_pairs(left: DataFrame, right: DataFrame, a: str, b: str, size: int = 3) -> DataFrame:
    """Rows of both sides whose tokens are one a prefix of the other: an equi-join on the first letters, then the check.

    Both sides should hold distinct tokens with whatever was counted for them, so that frequent tokens meet once.
    """
    x = left.where(F.length(a) >= size).withColumn("_block", F.substring(a, 1, size))
    y = right.where(F.length(b) >= size).withColumn("_block", F.substring(b, 1, size))
    return x.join(y, "_block").where(F.startswith(F.col(a), F.col(b)) | F.startswith(F.col(b), F.col(a))).drop("_block")


def carry_forward(today: DataFrame, previous: DataFrame, keys: list[str], as_of: Column, max_age: int) -> DataFrame:
    """Today's rows, and previous ones whose key is missing today with their original `seen` date, up to max_age days old: keys, value, seen, age, state."""
    gone = previous.join(today.select(*keys), keys, "left_anti").withColumn("age", F.datediff(as_of, F.col("seen")))
    fresh = today.select(*keys, "value", as_of.alias("seen"), F.lit(0).alias("age"), F.lit("fresh").alias("state"))
    return fresh.unionByName(gone.select(*keys, "value", "seen", "age", F.when(F.col("age") <= max_age, "carried").otherwise("dropped").alias("state")))


def numbered(frame: DataFrame, order: list[Column], name: str) -> DataFrame:
    """`frame` with each row's place (BIGINT from 1) in an order without ties, over all rows.

    Rows are sorted by range, so every task numbers its own; what is added to them is the rows of the tasks before, a table
    with one row a task, which is small enough to broadcast.
    """
    placed = checkpointed(frame.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()).withColumn("_task", F.shiftright("_at", 33)))
    counts = placed.groupBy("_task").agg(F.count("*").alias("_n"))
    before = counts.select("_task", F.coalesce(F.sum("_n").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return placed.join(F.broadcast(before), "_task").withColumn(name, F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_before") + 1).drop("_at", "_task", "_before")


def search(entries: DataFrame, query: str, names: str, parts: str) -> DataFrame:
    """`entries` with `score`: how well their folded names (ARRAY) and the words of these (ARRAY) answer a search text."""
    words = fold_plain(query).split()
    score = -0.02 * F.size(parts)
    begins = lambda w: F.exists(parts, lambda t: t.startswith(w))
    starts = [begins(w) for w in words]
    for w, begun in zip(words, starts):
        score = score + F.when(F.array_contains(parts, w), 3.0).when(begun, 1.5).otherwise(0.0)
    whole = " ".join(words)
    score = score + F.when(reduce(Column.__and__, starts, F.lit(True)), 2.0).otherwise(0.0)
    score = score + F.when(F.array_contains(names, whole), 5.0).when(F.exists(names, lambda n: n.startswith(whole)), 1.0).otherwise(0.0)
    return entries.withColumn("score", score)
