"""History of entity attributes from periodic snapshots, by presence bitmaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = 64


def _set_bits(bits: Column, word: Column) -> Column:
    """The snapshot numbers of the bits that are set in one 64-bit word."""
    return F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda i: F.call_function("getbit", bits, i) == 1),
        lambda i: word * WORD + i,
    )


def version_history(rows: DataFrame, calendar: DataFrame, *, scope: str, entity: list[str], at: str, loaded: str, attributes: dict[str, Column], open_end: str = "9999-12-31") -> DataFrame:
    """Full history of versions: scope, the entity columns, version_from, version_to (DATE) and the attributes.

    `rows` hold periodic full snapshots (`at`, a DATE) per `scope`; `calendar` (scope, at) lists the snapshots of each
    scope. A version is a longest series of consecutive snapshots in which the entity is present with equal attributes
    (a null equals a null). version_to is the scope's next snapshot after the last one, or `open_end`.

    Of several rows of an entity and snapshot the one with the latest `loaded` holds (ties: the greatest attributes).
    Rows with a null entity, scope or snapshot, and rows of a day that is no snapshot of the scope, are left out. Gaps
    (an entity that vanishes and comes back) end a version. Empty tables give an empty result; other columns are ignored.

    Every step groups by entity and snapshot or entity and attributes with partial aggregation, so a hot entity is
    reduced before it is shuffled; per version one bit a snapshot remains, 64 to a word.
    """
    window = Window.partitionBy("_scope").orderBy("_at")
    numbered = (
        calendar.select(F.col(scope).alias("_scope"), F.col(at).alias("_at")).where("_scope is not null and _at is not null").distinct()
        .withColumn("_n", F.row_number().over(window) - 1)
    )
    keys = [f"_e{i}" for i in range(len(entity))]
    names = list(attributes)
    values = [f"_v{i}" for i in range(len(names))]
    given = rows.select(
        F.col(scope).alias("_scope"), *[F.col(c).alias(k) for c, k in zip(entity, keys)], F.col(at).alias("_at"), F.col(loaded).alias("_loaded"),
        *[attributes[n].alias(v) for n, v in zip(names, values)],
    ).dropna(subset=["_scope", "_at", *keys])
    latest = given.groupBy("_scope", *keys, "_at").agg(F.max(F.struct("_loaded", *values)).alias("_row"))
    placed = latest.join(numbered, ["_scope", "_at"]).select("_scope", *keys, *[F.col(f"_row.{v}").alias(v) for v in values], "_n")
    words = (
        placed.groupBy("_scope", *keys, *values, F.floor(F.col("_n") / WORD).cast("int").alias("_word"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_n") % WORD)).alias("_bits"))
    )
    # A run crosses a word's edge when the neighbouring word exists and its nearest bit is set.
    order = Window.partitionBy("_scope", *keys, *values).orderBy("_word")
    before = F.when(F.lag("_word").over(order) == F.col("_word") - 1, F.call_function("getbit", F.lag("_bits").over(order), F.lit(WORD - 1))).otherwise(0)
    after = F.when(F.lead("_word").over(order) == F.col("_word") + 1, F.call_function("getbit", F.lead("_bits").over(order), F.lit(0))).otherwise(0)
    edged = words.withColumn("_before", before.cast("bigint")).withColumn("_after", after.cast("bigint"))
    shifted_up = F.call_function("shiftleft", F.col("_bits"), F.lit(1)).bitwiseOR(F.col("_before"))
    shifted_down = F.call_function("shiftrightunsigned", F.col("_bits"), F.lit(1)).bitwiseOR(F.call_function("shiftleft", F.col("_after"), F.lit(WORD - 1)))
    runs = (
        edged.withColumn("_starts", _set_bits(F.col("_bits").bitwiseAND(F.bitwise_not(shifted_up)), F.col("_word")))
        .withColumn("_ends", _set_bits(F.col("_bits").bitwiseAND(F.bitwise_not(shifted_down)), F.col("_word")))
        .groupBy("_scope", *keys, *values)
        .agg(F.sort_array(F.flatten(F.collect_list("_starts"))).alias("_starts"), F.sort_array(F.flatten(F.collect_list("_ends"))).alias("_ends"))
        .select("_scope", *keys, *values, F.explode(F.arrays_zip("_starts", "_ends")).alias("_run"))
        .select("_scope", *keys, *values, F.col("_run._starts").alias("_first"), (F.col("_run._ends") + 1).alias("_next"))
    )
    first = numbered.select("_scope", F.col("_n").alias("_first"), F.col("_at").alias("version_from"))
    following = numbered.select("_scope", F.col("_n").alias("_next"), F.col("_at").alias("_to"))
    return (
        runs.join(first, ["_scope", "_first"]).join(following, ["_scope", "_next"], "left")
        .select(
            F.col("_scope").alias(scope), *[F.col(k).alias(c) for c, k in zip(entity, keys)], "version_from",
            F.coalesce("_to", F.lit(open_end).cast("date")).alias("version_to"), *[F.col(v).alias(n) for n, v in zip(names, values)],
        )
    )
