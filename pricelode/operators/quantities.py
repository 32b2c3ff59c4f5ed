"""Quantities in different units and scales, converted to common units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelode.functions import packs
from pricelode.functions.units import TARGETS, UnitGraph, conversion_table


def size_of(count: Column, amount: Column, unit: Column) -> Column:
    return F.struct(count.cast("double").alias("count"), amount.cast("double").alias("amount"), unit.alias("unit"))


def to_base(frame: DataFrame, sizes: dict[str, Column], graph: UnitGraph | None = None) -> DataFrame:
    """`frame` with, for each name in `sizes`, a column STRUCT<base_unit STRING, amount DOUBLE>, null where the size is null or its unit unknown.

    A size is a STRUCT<count, amount, unit>; count x amount is converted by an equi-join on the unit's spelling with the
    conversion table, which holds one row per known spelling and is broadcast for that reason.
    """
    table = conversion_table(frame.sparkSession, graph)
    for name, size in sizes.items():
        own = F.broadcast(table.select(F.col("spelling").alias("_spelling"), F.col("base_unit").alias("_base"), F.col("factor").alias("_factor"), F.col("offset").alias("_offset")))
        frame = (
            frame.withColumn("_size", size).join(own, F.col("_size.unit") == F.col("_spelling"), "left")
            .withColumn(name, F.when(F.col("_base").isNotNull() & F.col("_size.amount").isNotNull(), F.struct(
                F.col("_base").alias("base_unit"), (F.col("_size.count") * (F.col("_size.amount") * F.col("_factor") + F.col("_offset"))).alias("amount"))))
            .drop("_size", "_spelling", "_base", "_factor", "_offset")
        )
    return frame


def price_basis(recorded: Column, price: Column, amount: Column, bases: tuple[int, ...] = (100, 1000)) -> Column:
    """Which of `bases` a recorded unit price is for, given the price of a pack of `amount`: the one whose implied value is nearest as a ratio.

    Null where an input is null or not above zero, so nothing can be told.
    """
    implied = [F.abs(F.ln(recorded / (price / amount * b))) for b in bases]
    nearest = F.least(*implied) if len(bases) > 1 else implied[0]
    basis = F.lit(bases[0])
    for b, own in zip(bases[1:], implied[1:]):
        basis = F.when(own == nearest, F.lit(b)).otherwise(basis)
    return F.when((recorded > 0) & (price > 0) & (amount > 0), basis)


def offer_quantities(offers: DataFrame) -> DataFrame:
    """field_name (`quantity`, `price_per_kg`), row_id, base_unit, base_amount (BIGINT) of offers.

    `quantity` is the whole pack, multipacks summed: a size in the title goes before unit and quantity. `price_per_kg` is
    the amount (100 or 1000 g or ml) that the recorded value is for. A row whose size neither the title nor the fields tell
    has no `quantity`; one without price, recorded value or a pack in g or ml has no `price_per_kg`. Rows with a null
    offer_seq are left out; a repeated offer_seq counts once (its greatest values).
    """
    rows = offers.select("offer_seq", "title", "unit", F.col("quantity").alias("qty"), F.col("price_czk").alias("price"), F.col("price_per_kg").alias("recorded")).where("offer_seq is not null")
    unit = packs.bare_unit(F.col("unit"))
    rows = packs.with_size(rows.withColumn("fields", F.when(F.col("qty").isNotNull() & ~F.isnan("qty") & (unit != ""), size_of(F.lit(1.0), F.col("qty"), unit))), "titled", F.col("title"))
    based = to_base(rows, {"pack": F.coalesce("titled", "fields")})
    whole = F.round("pack.amount").cast("bigint")
    basis = F.when(F.col("pack.base_unit").isin("g", "ml"), price_basis(F.col("recorded"), F.col("price"), F.col("pack.amount")))
    return _long(based, "offer_seq", {"quantity": (F.col("pack.base_unit"), whole), "price_per_kg": (F.col("pack.base_unit"), basis.cast("bigint"))})


def product_quantities(results: DataFrame) -> DataFrame:
    """field_name (`amount`, `base_price_factor`), row_id, base_unit, base_amount (BIGINT) of penny_results.

    `amount` is the whole pack, from amount and label, else product_name. `base_price_factor` is the amount that
    per_standardized_quantity is for: factor times unit, where a null or empty factor is 1 and a factor may hold the unit
    ("100 g"). Rows whose units are missing or unknown have no row; rows fetched twice (same result_id) count once.
    """
    rows = results.select("result_id", "product_name", "amount", F.col("volume_label_short").alias("label"), F.col("price.base_unit_short").alias("per"), F.col("price.base_price_factor").alias("factor")).where("result_id is not null")
    factor = F.when(F.trim("factor") != "", F.col("factor")).otherwise(F.lit("1"))
    rows = packs.with_size(rows, "stated", F.col("amount"), F.col("label"), search=False)
    rows = packs.with_size(packs.with_size(rows, "named", F.col("product_name")), "per_size", factor, F.col("per"), search=False)
    based = to_base(rows, {"pack": F.coalesce("stated", "named"), "basis": F.col("per_size")})
    return _long(based, "result_id", {"amount": (F.col("pack.base_unit"), F.round("pack.amount").cast("bigint")), "base_price_factor": (F.col("basis.base_unit"), F.round("basis.amount").cast("bigint"))})


def _long(frame: DataFrame, key: str, fields: dict[str, tuple[Column, Column]]) -> DataFrame:
    """One row per key and field that has a value; unit and amount travel as one BIGINT, so that repeated keys are reduced by hash aggregation."""
    targets = F.array(*[F.lit(t) for t in TARGETS])
    packed = [F.max(amount * len(TARGETS) + F.array_position(targets, unit) - 1).alias(name) for name, (unit, amount) in fields.items()]
    spread = F.array(*[F.struct(F.lit(name).alias("field_name"), F.col(name).alias("packed")) for name in fields])
    return (
        frame.groupBy(key).agg(*packed).select(F.col(key).alias("row_id"), F.explode(spread).alias("f")).where("f.packed is not null")
        .select("f.field_name", "row_id", F.element_at(targets, (F.col("f.packed") % len(TARGETS) + 1).cast("int")).alias("base_unit"), F.expr(f"f.packed div {len(TARGETS)}").alias("base_amount"))
    )
