"""Reports on runs: rows by source, store and status, carried values with their reasons, capped lists and nested documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelode.functions.text import fold, fold_plain
from pricelode.operators.relational import numbered, top_per_group


def first_present(*columns: Column) -> Column:
    """The first text that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c.cast("string"), F.lit("")) for c in columns])


def source_key(*columns: Column) -> Column:
    """What a row's source is called: the first column that tells, in lower case, else unknown."""
    return F.coalesce(F.lower(first_present(*columns)), F.lit("unknown"))


def status_class(status: Column) -> Column:
    """matched, review, ignored or unmatched, for the ways that rows spell it."""
    low = F.lower(F.trim(status))
    return F.when(low.isin("matched", "ok", "auto", "manual"), "matched").when(low == "review", "review").when(low.isin("ignored", "ignore", "nonfood"), "ignored").otherwise("unmatched")


def class_counts(frame: DataFrame, by: list[str], status: str) -> DataFrame:
    """The group columns and how many rows are matched, review, unmatched and ignored."""
    own = status_class(F.col(status))
    return frame.groupBy(*by).agg(*[F.count_if(own == c).alias(c) for c in ("matched", "review", "unmatched", "ignored")])


def split_matches(frame: DataFrame, status: str, confidence: str, title: str) -> tuple[DataFrame, DataFrame]:
    """The matched rows, and the rest with `place`: in order of review, unmatched, ignored, then falling confidence, then title."""
    own = frame.withColumn("_class", status_class(F.col(status)))
    order = F.when(F.col("_class") == "review", 0).when(F.col("_class") == "unmatched", 1).otherwise(2)
    rest = own.where("_class <> 'matched'").withColumn("_order", order).withColumn("_less", -F.coalesce(F.col(confidence), F.lit(0.0))).withColumn("_title", F.coalesce(F.col(title), F.lit("")))
    placed = numbered(rest, [F.col("_order"), F.col("_less"), F.col("_title"), F.xxhash64(*frame.columns)], "place")
    return own.where("_class = 'matched'").drop("_class"), placed.drop("_class", "_order", "_less", "_title")


def capped(frame: DataFrame, order: list[Column], most: int) -> tuple[DataFrame, Column]:
    """The first `most` rows in an order without ties (a list that is shown; the limit is the feature), and how many more there are as a scalar."""
    return frame.orderBy(*order).limit(most), frame.agg(F.greatest(F.lit(0).cast("bigint"), F.count("*") - most)).scalar()


def source_report(fetched: DataFrame, offers: DataFrame, matched: DataFrame, suffix: str = "-text") -> DataFrame:
    """source, ok, requests, error, offers, matched: one row per source that any of the three sides knows.

    `fetched`: source, ok, items, requests, error; `offers` and `matched`: source, n. A fetched source whose rows go by its name with
    `suffix` (and not by its own) is reported under that. ok is as fetched, else whether there were offers.
    """
    counted = offers.select("source", F.col("n").alias("offers")).join(matched.select("source", F.col("n").alias("matched")), "source", "full_outer")
    names = counted.select("source").distinct()
    known = fetched.join(names.withColumn("_own", F.lit(True)), "source", "left")
    other = names.select(F.regexp_replace("source", f"{suffix}$", "").alias("source"), F.col("source").alias("_renamed")).where("source <> _renamed")
    keyed = known.join(other, "source", "left").withColumn("source", F.when(F.col("_own").isNull(), F.coalesce("_renamed", "source")).otherwise(F.col("source"))).drop("_own", "_renamed")
    joined = keyed.join(counted, "source", "full_outer")
    n = F.coalesce("offers", "items")
    return joined.select("source", F.coalesce("ok", n > 0).alias("ok"), "requests", "error", n.alias("offers"), "matched")


def market_health(markets: DataFrame, health: DataFrame) -> DataFrame:
    """market, status (missing where there is no report), good and failed sources of every market."""
    counts = health.groupBy("market").agg(F.max("status").alias("status"), F.count_if("ok").alias("good"), F.count_if(~F.col("ok")).alias("failed"))
    return markets.select("market").join(counts, "market", "left").select("market", F.coalesce("status", F.lit("missing")).alias("status"), F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("failed", F.lit(0)).alias("failed"))


def carried_prices(today: DataFrame, previous: DataFrame, seen: DataFrame, stores: DataFrame, as_of: Column, max_age: int) -> DataFrame:
    """item, store, value, last_seen, age, state, reason: today's values, and earlier ones of pairs that have none today.

    `today` and `previous`: item, store, value; `seen`: item, store, last_seen; `stores`: the stores that have any row today, usable or
    not. An earlier value keeps its last_seen (as_of where none is recorded), is carried up to max_age days, inclusive, and dropped
    beyond; the reason is store_missing where the store has no row today, else not_matched_today.
    """
    gone = previous.join(today.select("item", "store"), ["item", "store"], "left_anti").join(seen, ["item", "store"], "left").join(stores.select("store").distinct().withColumn("_there", F.lit(True)), "store", "left")
    last = F.coalesce("last_seen", as_of)
    age = F.datediff(as_of, last)
    old = gone.select("item", "store", "value", last.alias("last_seen"), age.alias("age"), F.when(age <= max_age, "carried").otherwise("dropped").alias("state"), F.when(F.col("_there"), "not_matched_today").otherwise("store_missing").alias("reason"))
    fresh = today.select("item", "store", "value", as_of.alias("last_seen"), F.lit(0).alias("age"), F.lit("fresh").alias("state"), F.lit(None).cast("string").alias("reason"))
    return fresh.unionByName(old)


def carried_deals(today: DataFrame, previous: DataFrame, stores: DataFrame, as_of: Column, per_pair: int = 3) -> DataFrame:
    """item, store, value, valid_to, title: today's deals, and earlier ones that are still valid of stores without any row today; the cheapest `per_pair` of
    a pair, of deals with one title and end the cheapest only. Values count rounded to one digit."""
    old = previous.join(stores.select("store").distinct(), "store", "left_anti").where(F.col("valid_to") >= as_of)
    rows = today.unionByName(old).withColumn("value", F.round("value", 1)).withColumn("_key", F.lower(F.trim("title")))
    order = [F.asc("value"), F.asc("valid_to"), F.asc("title")]
    once = top_per_group(rows, ["item", "store", "_key", "valid_to"], order)
    return top_per_group(once, ["item", "store"], [*order, F.col("_key")], per_pair).select("item", "store", "value", "valid_to", "title")


def price_documents(prices: DataFrame, version: int) -> DataFrame:
    """market, document: a market's prices (market, currency, updated, item, store, value) as one nested JSON document in order of its keys; version 1
    has no market and currency and calls the values czkPerKg, version 2 perKg."""
    by_item = prices.groupBy("market", "currency", "updated", "item").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("store", "value")))).alias("stores"))
    nested = by_item.groupBy("market", "currency", "updated").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("item", F.to_json("stores").alias("stores"))))).alias("items"))
    name = "perKg" if version == 2 else "czkPerKg"
    body = F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries("items"), lambda e: F.concat(F.lit('"'), e["key"], F.lit('":'), e["value"])), ","), F.lit("}"))
    head = [F.lit(f'{{"v":{version}')] + ([F.lit(',"market":"'), F.col("market"), F.lit('","currency":"'), F.col("currency"), F.lit('"')] if version == 2 else [])
    return nested.select("market", F.concat(*head, F.lit(',"updated":"'), F.col("updated").cast("string"), F.lit(f'","{name}":'), body, F.lit("}")).alias("document"))


def price_rows(documents: DataFrame, document: str) -> DataFrame:
    """v, market, updated, item, store, value of price documents of either version."""
    kind = "map<string,map<string,double>>"
    parsed = documents.withColumn("d", F.from_json(document, f"v int, market string, updated date, perKg {kind}, czkPerKg {kind}"))
    return parsed.select("d.v", "d.market", "d.updated", F.explode(F.coalesce("d.perKg", "d.czkPerKg")).alias("item", "stores")).select("v", "market", "updated", "item", F.explode("stores").alias("store", "value"))


def fetch_states(frame: DataFrame, keys: list[str], document: str) -> DataFrame:
    """The keys, source, ok, items, error of a fetch report, however it is laid out: an object or list under sources, providers or stores, or either of these at the
    top. A list names its sources by id, name, source or store; a state that is no object is an error text."""
    state = "struct<id:string,name:string,source:string,store:string,ok:boolean,items:bigint,error:string,message:string>"
    parsed = frame.withColumn("_v", F.try_parse_json(document))
    inner = F.coalesce(*[F.try_variant_get("_v", f"$.{k}", "variant") for k in ("sources", "providers", "stores")], F.col("_v"))
    given = parsed.withColumn("_i", inner)
    listed = F.transform(F.try_variant_get("_i", "$", "array<variant>"), lambda e: F.struct(F.lit(None).cast("string").alias("key"), e.alias("value")))
    named = F.transform(F.map_entries(F.try_variant_get("_i", "$", "map<string,variant>")), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))
    rows = given.select(*keys, F.explode(F.coalesce(listed, named)).alias("_e")).select(*keys, F.col("_e.key").alias("_key"), F.to_json("_e.value").alias("_text"))
    read = rows.withColumn("_s", F.when(F.col("_text").startswith("{"), F.from_json("_text", state)))
    own = F.lower(first_present(F.col("_key"), *[F.col(f"_s.{c}") for c in ("id", "name", "source", "store")]))
    return read.select(*keys, own.alias("source"), F.col("_s.ok").alias("ok"), F.col("_s.items").alias("items"), F.coalesce(first_present(F.col("_s.error"), F.col("_s.message")), F.when(F.col("_s").isNull(), F.get_json_object(F.concat(F.lit('{"t":'), F.col("_text"), F.lit("}")), "$.t"))).alias("error")).where("source is not null")


def warnings(sources: DataFrame, prices: DataFrame, dropped: Column, *, least_items: int) -> DataFrame:
    """kind, subject: sources that failed or gave nothing, too few items priced, and dropped values."""
    failed = sources.where(~F.col("ok")).select(F.lit("failed").alias("kind"), F.col("source").alias("subject"))
    empty = sources.where("offers = 0").select(F.lit("empty").alias("kind"), F.col("source").alias("subject"))
    few = prices.agg(F.count_distinct("item").alias("n")).where(F.col("n") < least_items).select(F.lit("few_items").alias("kind"), F.col("n").cast("string").alias("subject"))
    lost = prices.agg(F.max(dropped).alias("n")).where("n > 0").select(F.lit("dropped").alias("kind"), F.col("n").cast("string").alias("subject"))
    return failed.unionByName(empty).unionByName(few).unionByName(lost)


def younger_than(frame: DataFrame, at: str, now: Column, days: int) -> DataFrame:
    """Rows whose time is less than so many days before `now`."""
    return frame.where(F.col(at) > now - F.make_dt_interval(F.lit(days)))


def latest(frame: DataFrame, by: list[str], at: str, n: int) -> DataFrame:
    """The n last rows of each group, by a time; of equal times any order that is the same each run."""
    order = Window.partitionBy(*by).orderBy(F.desc(at), F.xxhash64(*frame.columns))
    return frame.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= n).drop("_k")


def renamed(frame: DataFrame, names: dict[str, list[str]], keep: bool = False) -> DataFrame:
    """Columns by one name each, from the first of its aliases that is there and neither null nor an empty text; aliases that no column has
    are passed over, and a name without any is null. With `keep` the old columns stay beside the new ones."""
    out = []
    for name, aliases in names.items():
        there = [a for a in aliases if a in frame.columns]
        text = [F.nullif(F.col(a), F.lit("")) if dict(frame.dtypes)[a] == "string" else F.col(a) for a in there]
        out.append((F.coalesce(*text) if text else F.lit(None).cast("string")).alias(name))
    return frame.select(*[F.col(c) for c in frame.columns if keep and c not in names], *out)


def with_copies(frame: DataFrame, copies: dict[str, str]) -> DataFrame:
    """`frame` with copies of columns under second names, for readers that know those."""
    return frame.select("*", *[F.col(c).alias(name) for name, c in copies.items()])


def queue(frame: DataFrame, handled: DataFrame, key: str, *, status: str | None = None, store: str | None = None, search: str = "", columns: tuple[str, ...] = ("title", "store", "source")) -> DataFrame:
    """Rows still to be looked at: not handled yet, of a status and store if given, and with a text (folded) in one of the columns."""
    rows = frame.join(handled.select(key).distinct(), key, "left_anti")
    if status is not None:
        rows = rows.where(F.col("status") == status)
    if store is not None:
        rows = rows.where(F.col("store") == store)
    wanted = fold_plain(search)
    held = F.lit(not wanted)
    for c in columns:
        held = held | F.coalesce(fold(F.col(c)).contains(wanted), F.lit(False))
    return rows.where(held)
