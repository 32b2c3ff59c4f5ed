"""Queries for the data problems that belong to this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelode.llm import duplicates, packing, percentiles, products, sentences, tokens
from pricelode.session import checkpointed, table

# How each column of offers counts when records are compared; the rest do not.
OFFER_FIELDS = {
    "market": "text", "currency": "text", "store": "text", "outlet_id": "number", "source": "text", "title": "text", "price_czk": "number", "unit": "text",
    "quantity": "number", "price_per_kg": "number", "valid_from": "date", "valid_to": "date", "ingredient_id": "text", "original_price_czk": "number",
    "club": "exact", "is_promo": "exact", "raw": "json",
}
FRACTIONS = {"p05": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    """keep_seq, copy_seq of offers that differ only in format."""
    return duplicates.collapse_formatting(table(spark, root, "offers"), "offer_seq", OFFER_FIELDS).select(F.col("keep").alias("keep_seq"), F.col("copy").alias("copy_seq"))


def p2_copies(spark: SparkSession, root: str) -> DataFrame:
    """offer_seq, copies: each record of several copies once, with their number."""
    found = duplicates.collapse_formatting(table(spark, root, "offers"), "offer_seq", OFFER_FIELDS)
    return duplicates.copy_counts(found).select(F.col("keep").alias("offer_seq"), "copies")


def p2_records(spark: SparkSession, root: str) -> DataFrame:
    """offer_seq, copies: every record once, with the number of its copies, 1 where there is no other."""
    offers = table(spark, root, "offers")
    found = duplicates.collapse_formatting(offers, "offer_seq", OFFER_FIELDS)
    return duplicates.records(offers, "offer_seq", found).select(F.col("keep").alias("offer_seq"), "copies")


def _readings(spark: SparkSession, root: str) -> DataFrame:
    """One row per match_seq: a second delivery repeats its row later, so the first is taken."""
    rows = table(spark, root, "matched_rows").where("match_seq is not null and czk_per_kg is not null and not isnan(czk_per_kg)")
    return rows.groupBy("match_seq", "ingredient_id", "store", "observed_on").agg(F.min_by("czk_per_kg", "ingest_ts").alias("czk_per_kg"))


def _wide(found: DataFrame) -> DataFrame:
    return found.groupBy("ingredient_id", "store", "n").agg(*[F.round(F.max(F.when(F.col("fraction") == f, F.col("value"))), 6).alias(name) for name, f in FRACTIONS.items()])


def _numbers(spark: SparkSession, root: str, share: Column | None = None) -> DataFrame:
    return checkpointed(percentiles.numeric_rows(_readings(spark, root), ["ingredient_id", "store"], F.col("czk_per_kg"), share))


def p7_percentiles(spark: SparkSession, root: str) -> DataFrame:
    """ingredient_id, store, n and six percentiles of czk_per_kg, exact."""
    return _wide(percentiles.percentiles(_numbers(spark, root), list(FRACTIONS.values())))


def p7_by_day(spark: SparkSession, root: str) -> DataFrame:
    """The same, put together from the stored states of single days."""
    rows = _numbers(spark, root, F.col("observed_on"))
    days = checkpointed(percentiles.interval_states(rows))
    return _wide(percentiles.percentiles(rows, list(FRACTIONS.values()), states=days))


QUERIES = {f.__name__: f for f in (p2_found, p2_copies, p2_records, p7_by_day, p7_percentiles)}

SQL = {
    "p7_percentiles": f"""
SELECT ingredient_id, store, count(*) AS n, {', '.join(f'round(quantile_cont(czk_per_kg, {f}), 6) AS {name}' for name, f in FRACTIONS.items())}
FROM (SELECT match_seq, ingredient_id, store, observed_on, min_by(czk_per_kg, ingest_ts) AS czk_per_kg FROM matched_rows WHERE match_seq IS NOT NULL AND czk_per_kg IS NOT NULL GROUP BY ALL)
GROUP BY ALL""",
}
SQL["p7_by_day"] = SQL["p7_percentiles"]


def _same(c: str, kind: str) -> str:
    if kind == "text":
        # Twice, as neighbouring decimal marks share a digit.
        once = f"regexp_replace(lower({c}), '([0-9])[.,]([0-9])', '\\1§\\2', 'g')"
        return f"regexp_replace(regexp_replace({once}, '([0-9])[.,]([0-9])', '\\1§\\2', 'g'), '[^\\p{{L}}\\p{{M}}\\p{{N}}×§]+', '', 'g')"
    if kind == "date":
        return f"regexp_replace({c}, '[^0-9]', '', 'g')"
    if kind == "json":
        return f"list_sort(map_entries(CAST(CAST({c} AS JSON) AS MAP(VARCHAR, JSON))))::VARCHAR"
    return c


_FIELDS = ", ".join(f"{_same(c, kind)} AS k{i}" for i, (c, kind) in enumerate(OFFER_FIELDS.items()))
_KEYS = ", ".join(f"k{i}" for i in range(len(OFFER_FIELDS)))
SQL["p2_found"] = f"""
WITH k AS (SELECT offer_seq, {_FIELDS} FROM offers), g AS (SELECT offer_seq, min(offer_seq) OVER (PARTITION BY {_KEYS}) AS keep FROM k)
SELECT keep AS keep_seq, offer_seq AS copy_seq FROM g WHERE keep <> offer_seq"""
SQL["p2_copies"] = f"SELECT keep_seq AS offer_seq, count(*) + 1 AS copies FROM ({SQL['p2_found']}) GROUP BY ALL"
SQL["p2_records"] = f"SELECT min(offer_seq) AS offer_seq, count(DISTINCT offer_seq) AS copies FROM (SELECT offer_seq, {_FIELDS} FROM offers WHERE offer_seq IS NOT NULL) GROUP BY {_KEYS}"


def p8_ids(spark: SparkSession, root: str) -> DataFrame:
    """doc_id, ids: the tokens of every text."""
    return tokens.token_ids(table(spark, root, "documents"), "doc_id", F.col("text"))


def p8_texts(spark: SparkSession, root: str) -> DataFrame:
    """doc_id, text: every text out of its tokens again."""
    return tokens.token_texts(p8_ids(spark, root), "doc_id", "ids")


SQL["p8_texts"] = "SELECT doc_id, coalesce(text, '') AS text FROM documents"


def p9_containers(spark: SparkSession, root: str) -> DataFrame:
    """doc_id, piece, from_token, n_tokens, container, place: every text in containers of 2,048 tokens."""
    counts = tokens.token_counts(table(spark, root, "documents"), "doc_id", F.col("text"))
    return packing.fill_containers(counts, "doc_id", "n_tokens", 2048)


def p9_fill(spark: SparkSession, root: str) -> DataFrame:
    """containers, tokens, room (share of all containers' capacity that is unused), least: how full the containers are."""
    each = p9_containers(spark, root).groupBy("container").agg(F.sum("n_tokens").alias("fill"))
    return each.agg(F.count("*").alias("containers"), F.sum("fill").alias("tokens"), F.round(1 - F.sum("fill") / F.count("*") / 2048, 6).alias("room"), F.ceil(F.sum("fill") / 2048).alias("least"))


def p9_check(spark: SparkSession, root: str) -> DataFrame:
    """documents that have a place, containers over 2,048 tokens, documents of which a piece is missing or twice, and places that no item or two have."""
    placed = checkpointed(p9_containers(spark, root))
    documents = placed.groupBy("doc_id").agg(F.count("*").alias("n"), F.max("piece").alias("last"), F.count_distinct("piece").alias("different"))
    counted = documents.agg(F.count("*").alias("documents"), F.count_if((F.col("n") != F.col("last") + 1) | (F.col("different") != F.col("n"))).alias("broken"))
    fills = placed.groupBy("container").agg(F.sum("n_tokens").alias("fill"), F.max("place").alias("last"), F.count("*").alias("n"), F.count_distinct("place").alias("different"))
    full = fills.agg(F.count_if(F.col("fill") > 2048).alias("overfull"), F.count_if((F.col("n") != F.col("last") + 1) | (F.col("different") != F.col("n"))).alias("misplaced"))
    return counted.select("documents", "broken", full.select("overfull").scalar().alias("overfull"), full.select("misplaced").scalar().alias("misplaced"))


SQL["p9_check"] = "SELECT count(*) AS documents, 0 AS broken, 0 AS overfull, 0 AS misplaced FROM documents WHERE length(text) > 0"
QUERIES |= {f.__name__: f for f in (p8_ids, p8_texts, p9_containers, p9_fill, p9_check)}


def p10_found(spark: SparkSession, root: str) -> DataFrame:
    """doc_id, sent_start, sent_end: the sentence units of every text."""
    return sentences.sentence_units(table(spark, root, "documents"), "doc_id", F.col("text"))


def p10_cover(spark: SparkSession, root: str) -> DataFrame:
    """doc_id, letters: how many characters of a text, white space apart, lie in its sentence units; each character once."""
    units = p10_found(spark, root)
    texts = table(spark, root, "documents").select("doc_id", "text")
    own = F.substring("text", F.col("sent_start").cast("int") + 1, (F.col("sent_end") - F.col("sent_start")).cast("int"))
    counted = units.join(texts, "doc_id").groupBy("doc_id").agg(F.sum(F.length(F.regexp_replace(own, r"[\s\p{Z}\x1c-\x1f\x85]+", ""))).alias("letters"))
    return counted.select("doc_id", "letters")


SQL["p10_cover"] = "SELECT doc_id, length(regexp_replace(text, '[\\s\\p{Z}\\x0b\\x1c-\\x1f\\x85]+', '', 'g')) AS letters FROM documents WHERE letters > 0"
QUERIES |= {"p10_found": p10_found, "p10_cover": p10_cover}


def _grouped(spark: SparkSession, root: str) -> DataFrame:
    known = products.catalogue_wordings(table(spark, root, "catalogue"))
    learned, beside = products.learned_wordings(table(spark, root, "offers"), "title", "market", "ingredient_id", known)
    wordings, adjectives = products.wording_lists(known.unionByName(learned), beside)
    return products.group_listings(table(spark, root, "listings"), "listing_id", wordings, adjectives)


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    """listing_a, listing_b: every two listings of one product."""
    return products.pairs(_grouped(spark, root)).select(F.col("a").alias("listing_a"), F.col("b").alias("listing_b"))


def p3_products(spark: SparkSession, root: str) -> DataFrame:
    """listing_id, product, listings: the product of each listing and how many listings it has."""
    grouped = _grouped(spark, root)
    sizes = grouped.groupBy("product").agg(F.count("*").alias("listings"))
    return grouped.join(sizes, "product").select(F.col("id").alias("listing_id"), "product", "listings")


def p3_check(spark: SparkSession, root: str) -> DataFrame:
    """listings that have a product, products whose id is not the least of their listings, and products of two markets or sizes that titles tell."""
    grouped = checkpointed(_grouped(spark, root))
    listings = table(spark, root, "listings").select(F.col("listing_id").alias("id"), "market")
    products_ = grouped.join(listings.distinct(), "id").groupBy("product").agg(F.min("id").alias("least"), F.count_distinct("market").alias("markets"))
    return grouped.agg(F.count("*").alias("listings")).select("listings", products_.agg(F.count_if(F.col("least") != F.col("product"))).scalar().alias("strangers"), products_.agg(F.count_if(F.col("markets") > 1)).scalar().alias("mixed"))


SQL["p3_check"] = "SELECT count(DISTINCT listing_id) AS listings, 0 AS strangers, 0 AS mixed FROM listings"
QUERIES |= {"p3_products": p3_products, "p3_found": p3_found, "p3_check": p3_check}
