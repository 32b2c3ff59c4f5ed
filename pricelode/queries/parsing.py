"""Queries of titles, packs, prices, payloads, checks and reports on whole tables, with DuckDB SQL where it can tell the same."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelode.functions import dates, prices, text
from pricelode.operators import matching, reports, validation
from pricelode.plans.markets import FX, fx
from pricelode.queries.reference import _fold_sql
from pricelode.session import table
from pricelode.sources import payloads

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL if there is one."""
    def keep(function):
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql
        return function

    return keep


_FX_SQL = "(VALUES ('cz', 1.0), ('sk', 0.041), ('de', 0.041), ('at', 0.041), ('pl', 0.17)) f(market, fx)"
# Words of Czech titles that name no product.
_NOISE, _PHRASES = ["akce", "novinka", "bio", "super", "cena"], ["jen tento tyden", "tip tydne", "za skvelou cenu"]


@query(f"SELECT offer_seq, array_to_string(list_filter(string_split(trim(regexp_replace(regexp_replace(regexp_replace({_fold_sql('title')}, '\\bjen tento tyden\\b', ' ', 'g'), '\\btip tydne\\b', ' ', 'g'), '\\bza skvelou cenu\\b', ' ', 'g')), ' '), lambda x: length(x) >= 2 AND NOT regexp_matches(x, '^[0-9]+$') AND x NOT IN ('akce', 'novinka', 'bio', 'super', 'cena')), ' ') AS kept FROM offers")
def title_tokens(spark, root):
    """The words of titles without noise phrases, noise words and numbers."""
    rest = text.without_phrases(text.fold(F.col("title")), _PHRASES)
    return table(spark, root, "offers").select("offer_seq", F.array_join(text.content_tokens(rest, _NOISE), " ").alias("kept"))


@query("SELECT offer_seq, list_transform(regexp_extract_all(title, '([0-9]+(?:[.,][0-9]+)?)\\s*%', 1), lambda p: CAST(replace(p, ',', '.') AS DOUBLE)) AS found, CASE WHEN fat < 1 THEN 'skimmed' WHEN fat < 20 THEN 'low' WHEN fat < 1e9 THEN 'full' END AS band FROM offers, LATERAL (SELECT list_min(list_transform(regexp_extract_all(title, '([0-9]+(?:[.,][0-9]+)?)\\s*%', 1), lambda p: CAST(replace(p, ',', '.') AS DOUBLE))) AS fat)")
def fat_bands(spark, root):
    """Percentages of titles and the band of the least."""
    found = text.percents(F.col("title"))
    return table(spark, root, "offers").select("offer_seq", found.alias("found"), prices.band(F.array_min(found), [(1.0, "skimmed"), (20.0, "low"), (1e9, "full")]).alias("band"))


_STORE_SQL = "CASE WHEN raw = '' THEN NULL WHEN f IN ('kaufland', 'lidl', 'billa', 'albert', 'penny', 'tesco', 'globus') THEN f WHEN replace(f, ' ', '') IN ('aldinord', 'aldi_nord') THEN 'aldiNord' WHEN replace(f, ' ', '') = 'aldisued' THEN 'aldiSued' WHEN f = 'hofer' THEN 'aldiSued' " + " ".join(f"WHEN starts_with(f, '{s}') THEN '{s}'" for s in ("kaufland", "lidl", "billa", "albert", "penny", "tesco", "globus")) + " WHEN starts_with(replace(f, ' ', ''), 'aldinord') THEN 'aldiNord' WHEN starts_with(replace(f, ' ', ''), 'aldisued') THEN 'aldiSued' END"
STORES = ["kaufland", "lidl", "billa", "albert", "penny", "tesco", "globus", "aldiNord", "aldiSued"]


@query(f"SELECT offer_seq, {_STORE_SQL} AS name FROM (SELECT offer_seq, trim(store) AS raw, {_fold_sql('store')} AS f FROM offers)")
def store_names(spark, root):
    """Stores as written, as one of the known names."""
    return table(spark, root, "offers").select("offer_seq", text.known_name(F.col("store"), STORES, {"hofer": "aldiSued"}).alias("name"))


@query("SELECT offer_seq, coalesce(raw <> '' AND ((lower(raw[1]) = raw[1] AND upper(raw[1]) <> raw[1]) OR split_part(f, ' ', 1) IN ('s','se','z','ze','v','ve','na','k','ke','o','do','pro','bez','od','a','i','nebo')), false) AS fragment, coalesce(regexp_matches(lower(title), '(^|[^a-z])(vejce|vajec|vajic|vajíčk|vajick|vajcia|vajíčok|vajc|jaja|jajk|jajec|eier|egg)'), false) AS egg FROM (SELECT offer_seq, title, trim(title) AS raw, " + _fold_sql("title") + " AS f FROM offers)")
def title_kinds(spark, root):
    """titles that are fragments of a text, and titles of eggs."""
    return table(spark, root, "offers").select("offer_seq", text.is_fragment(F.col("title")).alias("fragment"), prices.is_egg(F.col("title")).alias("egg"))


@query("SELECT id, language, list_filter(CASE language WHEN 'cs' THEN [name_cs, name_plural_cs] WHEN 'sk' THEN [names['sk'], names_plural['sk'], name_cs, name_plural_cs] ELSE [names['de'], names_plural['de'], name_cs, name_plural_cs] END || CASE WHEN language = 'de' THEN [] ELSE coalesce(aliases, []) END, lambda n: n <> '') AS called FROM catalogue, (VALUES ('cs'), ('sk'), ('de')) l(language)")
def names_by_language(spark, root):
    """What entries are called in three languages, in order of preference."""
    catalogue = table(spark, root, "catalogue")
    each = [catalogue.select("id", F.lit(language).alias("language"), text.catalogue_names(language).alias("called")) for language in ("cs", "sk", "de")]
    return each[0].unionByName(each[1]).unionByName(each[2])


def _titles(spark, root, market: str, language: str) -> DataFrame:
    parts = matching.title_parts(F.col("title"), language, _PHRASES, _NOISE)
    return table(spark, root, "offers").where(F.col("market") == market).select(F.col("offer_seq").alias("row"), parts.alias("p"), F.lit(None).cast("array<string>").alias("allowed")).select("row", "p.stems", "p.n_raw", "p.percents", "allowed")


@query()
def score_offers(spark, root):
    """Q3, J7, J8, J9, W4, W5, W6, A17, §2.12: catalogue items that Czech titles may mean, best first; the three best are kept."""
    names = matching.variants(table(spark, root, "catalogue"), "cs", _PHRASES, _NOISE)
    negatives = spark.createDataFrame([("maslo", "arasid"), ("maslo", "kakaov"), ("mleko_cerstve", "kokos")], "item string, stem string")
    ranked = matching.score_titles(_titles(spark, root, "cz", "cs"), names, negatives=negatives, generic=["syr", "olej"])
    return ranked.where("place <= 3").select(F.col("row").alias("offer_seq"), "item", "score", "place")


@query()
def offer_items(spark, root):
    """The item of each Czech title, where the search it came from counts; the recorded item stands for the search."""
    names = matching.variants(table(spark, root, "catalogue"), "cs", _PHRASES, _NOISE)
    ranked = matching.score_titles(_titles(spark, root, "cz", "cs"), names)
    priors = table(spark, root, "offers").where("ingredient_id is not null").select(F.col("offer_seq").alias("row"), F.col("ingredient_id").alias("item"))
    return matching.with_prior(ranked, priors).select(F.col("row").alias("offer_seq"), "item", "score")


_SIMPLE = ("kg", "g", "ml", "l", "cl", "dl", "ks", "szt.", "stk.", "stück")


@query(f"SELECT offer_seq, n * CAST(quantity AS BIGINT) * CASE u WHEN 'cl' THEN 10.0 WHEN 'dl' THEN 100.0 ELSE 1.0 END AS amount, CASE WHEN u IN ('cl', 'dl') THEN 'ml' WHEN u IN ('kg', 'g', 'ml', 'l') THEN u ELSE 'ks' END AS unit FROM (SELECT offer_seq, quantity, lower(unit) AS u, CASE WHEN offer_seq % 3 = 0 AND lower(unit) IN ('kg', 'g', 'ml', 'l', 'cl', 'dl') THEN 2 ELSE 1 END AS n FROM offers WHERE quantity = floor(quantity) AND quantity < 100000 AND lower(unit) IN {_SIMPLE})")
def pack_texts(spark, root):
    """Packs as texts ("Je 2 x 500 g", "3 szt.") beside unit prices and former prices, read back."""
    rows = table(spark, root, "offers").where("quantity = floor(quantity) and quantity < 100000").where(F.lower("unit").isin(*_SIMPLE))
    count = F.when((F.col("offer_seq") % 3 == 0) & F.lower("unit").isin(*_SIMPLE[:6]), "Je 2 x ").otherwise("")
    pack = prices.pack_size(F.concat(count, F.col("quantity").cast("bigint").cast("string"), F.lit(" "), F.col("unit"), F.lit(" (1 kg = 3,50 €) statt 500 g")))
    return rows.select("offer_seq", pack["amount"].alias("amount"), pack["unit"].alias("unit"))


@query(r"""SELECT doc_id, line_no, CAST(replace(p.c, ',', '.') AS DOUBLE) AS price, CAST(replace(p.a, ',', '.') AS DOUBLE) AS amount, p.b AS unit FROM (SELECT doc_id, line_no, regexp_extract(line, '^([0-9]+(?:[.,][0-9]+)?)\s*(kg|g|ml|l)\s*=\s*([0-9]+(?:[.,][0-9]+)?)\s*(?:Kč|€|zł)$', ['a', 'b', 'c']) AS p FROM (SELECT doc_id, unnest(string_split_regex(text, '\n')) AS line, generate_subscripts(string_split_regex(text, '\n'), 1) AS line_no FROM documents WHERE doc_type = 'leaflet_page')) WHERE p.a <> ''""")
def unit_price_lines(spark, root):
    """Lines of leaflet pages that are nothing but a unit price ("1 kg = 43 Kč")."""
    lines = table(spark, root, "documents").where("doc_type = 'leaflet_page'").select("doc_id", F.posexplode(F.split("text", "\n")).alias("at", "line")).where(F.col("line").rlike(r"^\d+(?:[.,]\d+)?[ \t\r\f]*(?:kg|g|ml|l)[ \t\r\f]*=[ \t\r\f]*\d+(?:[.,]\d+)?[ \t\r\f]*(?:Kč|€|zł)\z"))
    found = prices.unit_price(F.col("line"))
    return lines.select("doc_id", (F.col("at") + 1).alias("line_no"), found["price"].alias("price"), found["amount"].alias("amount"), found["unit"].alias("unit"))


@query("SELECT match_seq, ingest_ts, round(CASE WHEN unit = 'kg' THEN price WHEN unit = 'l' THEN price / coalesce(nullif(density, 0), 1) WHEN grams > 0 THEN price / (grams / 1000) END, 6) AS per_kg, unit = 'l' AND coalesce(density, 0) <= 0 AS assumed FROM (SELECT match_seq, ingest_ts, price, CASE match_seq % 3 WHEN 0 THEN 'kg' WHEN 1 THEN 'l' ELSE 'ks' END AS unit, density_g_per_ml AS density, unit_grams['ks'] AS grams FROM matched_rows JOIN catalogue ON id = ingredient_id WHERE price IS NOT NULL) WHERE unit <> 'ks' OR grams > 0")
def to_kilograms(spark, root):
    """Prices per kilogram, litre or piece as prices per kilogram, by density and grams of a piece (units by row number, as the table has none)."""
    rows = table(spark, root, "matched_rows").where("price is not null").join(table(spark, root, "catalogue").select("id", "density_g_per_ml", F.col("unit_grams")["ks"].alias("grams")), F.col("id") == F.col("ingredient_id"))
    unit = F.when(F.col("match_seq") % 3 == 0, "kg").when(F.col("match_seq") % 3 == 1, "l").otherwise("ks")
    found = prices.base_to_kg(F.col("price"), unit, F.col("density_g_per_ml"), F.col("grams"))
    return rows.withColumn("f", found).where("f is not null").select("match_seq", "ingest_ts", F.round("f.value", 6).alias("per_kg"), "f.assumed")


@query("SELECT offer_seq, try_strptime(substr(valid_from, 1, 10), '%Y-%m-%d')::DATE AS starts, nullif(regexp_extract(valid_to, '^([0-9]{4}-[0-9]{2}-[0-9]{2})', 1), '') AS ends FROM (SELECT offer_seq, CASE WHEN regexp_matches(substr(valid_from, 1, 10), '^[0-9]{4}-[0-9][0-9]-[0-9][0-9]$') THEN valid_from END AS valid_from, valid_to FROM offers)")
def iso_days(spark, root):
    """Days at the start of texts, valid ones as dates and as they are written."""
    return table(spark, root, "offers").select("offer_seq", dates.iso_day(F.col("valid_from")).alias("starts"), dates.iso_prefix(F.col("valid_to")).alias("ends"))


@query("SELECT o_orderkey, make_date(year(d), month(d), day(d)) AS day, 'velky' AS kind, e AS first, d AS last FROM (SELECT o_orderkey, o_orderdate::DATE AS d, (o_orderdate::DATE - CAST(o_orderkey % 40 AS INTEGER))::DATE AS e FROM orders)")
def slug_days(spark, root):
    """Dotted days and leaflet names with days, over the turn of the year."""
    rows = table(spark, root, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d")).withColumn("e", F.date_sub("d", (F.col("o_orderkey") % 40).cast("int")))
    page = F.concat(F.lit("<a href='x\\u002Fvelky-letak-"), F.date_format("e", "d-M"), F.lit("-"), F.date_format("d", "d-M-yyyy"), F.lit("'>"))
    found = payloads.page_leaflets(rows.withColumn("html", page), ["o_orderkey", "d"], F.col("html"))
    return found.select("o_orderkey", dates.dotted_day(F.date_format("d", "d.M.yyyy")).alias("day"), "kind", F.col("valid_from").alias("first"), F.col("valid_to").alias("last"))


@query("SELECT market, run_date, greatest(0, epoch(generated_at)::BIGINT - epoch(lag(generated_at) OVER (PARTITION BY market ORDER BY generated_at))::BIGINT) AS seconds FROM run_history QUALIFY seconds IS NOT NULL")
def seconds_between_runs(spark, root):
    """Seconds from one run of a market to the next."""
    from pyspark.sql import Window

    before = F.lag("generated_at").over(Window.partitionBy("market").orderBy("generated_at"))
    return table(spark, root, "run_history").withColumn("seconds", dates.duration_seconds(before, F.col("generated_at"))).where("seconds is not null").select("market", "run_date", "seconds")


@query("""SELECT ingredient_id, outlet_id, p.a AS first, p.b AS last FROM (SELECT outlet_id, ingredient_id, arg_min(struct_pack(a := a, b := b), CASE WHEN a <= DATE '2026-07-10' AND b >= DATE '2026-07-10' THEN struct_pack(k := 0, o := epoch(a), q := epoch(b)) WHEN a > DATE '2026-07-10' THEN struct_pack(k := 1, o := epoch(a), q := epoch(b)) ELSE struct_pack(k := 2, o := -epoch(b), q := -epoch(a)) END) AS p
FROM (SELECT outlet_id, ingredient_id, try_strptime(valid_from, '%Y-%m-%d')::DATE AS a, try_strptime(valid_to, '%Y-%m-%d')::DATE AS b FROM offers WHERE regexp_matches(valid_from, '^[0-9]{4}-[0-9][0-9]-[0-9][0-9]$') AND regexp_matches(valid_to, '^[0-9]{4}-[0-9][0-9]-[0-9][0-9]$')) WHERE a IS NOT NULL AND b IS NOT NULL AND ingredient_id IS NOT NULL GROUP BY ALL)""")
def chosen_periods(spark, root):
    """Of a pair's periods the one that holds a day, else the next, else the last."""
    day = lambda c: F.when(F.col(c).rlike(r"^\d{4}-\d\d-\d\d$"), dates.iso_day(F.col(c)))
    rows = table(spark, root, "offers").where("ingredient_id is not null").select("outlet_id", "ingredient_id", day("valid_from").alias("first"), day("valid_to").alias("last")).where("first is not null and last is not null")
    grouped = rows.groupBy("outlet_id", "ingredient_id").agg(F.array_sort(F.collect_set(F.struct("first", "last"))).alias("periods"))
    chosen = dates.chosen_period(F.col("periods"), F.lit("2026-07-10").cast("date"))
    return grouped.select("outlet_id", "ingredient_id", chosen["first"].alias("first"), chosen["last"].alias("last"))


@query("""SELECT result_id, variant, price, round(per, 6) AS per_kg FROM (SELECT result_id, product_name, price.base_price_factor AS factor, lower(price.base_unit_short) AS u, unnest(CASE WHEN price.loyalty.price_value < price.regular.price_value THEN [struct_pack(variant := 0, v := price.regular.price_value, q := price.regular.per_standardized_quantity), struct_pack(variant := 1, v := price.loyalty.price_value, q := price.loyalty.per_standardized_quantity)] ELSE [struct_pack(variant := 0, v := price.regular.price_value, q := price.regular.per_standardized_quantity)] END) AS o FROM (SELECT DISTINCT ON (result_id) * FROM penny_results) WHERE trim(product_name) <> '' AND price.regular.price_value IS NOT NULL),
LATERAL (SELECT o.variant AS variant, round(o.v / 100, 2) AS price, CASE WHEN u IN ('kg', 'l') THEN o.q / 100 / coalesce(try_cast(factor AS DOUBLE), 1) WHEN u IN ('g', 'ml') THEN o.q / 100 / coalesce(try_cast(factor AS DOUBLE), 1) * 1000 WHEN u IS NOT NULL AND u NOT IN ('kg', 'g', 'l', 'ml', 'cl', 'dl', '') AND regexp_matches(lower(product_name), '(^|[^a-z])(vejce|vajec|vajic|vajíčk|vajick|vajcia|vajíčok|vajc|jaja|jajk|jajec|eier|egg)') THEN o.q / 100 / (coalesce(try_cast(factor AS DOUBLE), 1) * 0.055) END AS per)""")
def minor_units(spark, root):
    """Results with money in hundredths as one or two offers, with prices per kilogram."""
    offers = payloads.minor_unit_offers(table(spark, root, "penny_results"), "result_id", F.xxhash64("product_name", "amount"))
    return offers.select("result_id", "variant", "price", F.round("per_kg", 6).alias("per_kg"))




@query(f"""WITH o AS (SELECT *, f.fx, try_strptime(CASE WHEN regexp_matches(valid_from, '^[0-9]{{4}}-[0-9][0-9]-[0-9][0-9]$') THEN valid_from END, '%Y-%m-%d')::DATE AS a, try_strptime(CASE WHEN regexp_matches(valid_to, '^[0-9]{{4}}-[0-9][0-9]-[0-9][0-9]$') THEN valid_to END, '%Y-%m-%d')::DATE AS b FROM offers LEFT JOIN {_FX_SQL} USING (market))
SELECT 'no_title' AS rule, offer_seq FROM o WHERE trim(coalesce(title, '')) = '' UNION ALL SELECT 'no_price', offer_seq FROM o WHERE price_czk IS NULL OR price_czk <= 0 OR isnan(price_czk) OR isinf(price_czk)
UNION ALL SELECT 'no_day', offer_seq FROM o WHERE a IS NULL OR b IS NULL UNION ALL SELECT 'reversed', offer_seq FROM o WHERE a > b UNION ALL SELECT 'expired', offer_seq FROM o WHERE b < DATE '2026-07-01'
UNION ALL SELECT 'currency', offer_seq FROM o WHERE currency <> CASE market WHEN 'cz' THEN 'CZK' WHEN 'pl' THEN 'PLN' ELSE 'EUR' END UNION ALL SELECT 'market', offer_seq FROM o WHERE fx IS NULL
UNION ALL SELECT 'unknown_item', offer_seq FROM o WHERE ingredient_id IS NOT NULL AND ingredient_id NOT IN (SELECT id FROM catalogue)""")
def rule_errors(spark, root):
    """V2, V6: one row per offer and rule that it breaks."""
    offers = table(spark, root, "offers")
    price, first, last = F.col("price_czk"), dates.iso_day(F.when(F.length("valid_from") == 10, F.col("valid_from"))), dates.iso_day(F.when(F.length("valid_to") == 10, F.col("valid_to")))
    rules = {
        "no_title": F.trim(F.coalesce("title", F.lit(""))) == "", "no_price": price.isNull() | (price <= 0) | F.isnan(price) | (price == float("inf")), "no_day": first.isNull() | last.isNull(),
        "reversed": first > last, "expired": last < F.lit("2026-07-01").cast("date"), "currency": F.col("currency") != F.when(F.col("market") == "cz", "CZK").when(F.col("market") == "pl", "PLN").otherwise("EUR"), "market": fx(F.col("market")).isNull(),
    }
    return validation.broken_rules(offers, "offer_seq", rules).unionByName(validation.unknown_members(offers, "offer_seq", "ingredient_id", table(spark, root, "catalogue"), "id", "unknown_item"))


RAW_SCHEMA = {
    "type": "object", "required": ["sku", "tags"], "additionalProperties": False,
    "properties": {
        "sku": {"type": "string", "pattern": "^[0-9]+-[0-9]+$"}, "category": {"enum": ["MEAT", "DAIRY", "VEGETABLE", None]}, "discountPercentage": {"type": ["integer", "null"], "minimum": 10, "maximum": 40},
        "promotionType": {"$ref": "#/$defs/kind"}, "tags": {"type": "array", "items": {"type": "string", "maxLength": 4}, "maxItems": 2},
    },
    "$defs": {"kind": {"type": ["string", "null"], "minLength": 4}},
}


@query("""SELECT offer_seq, len(list_filter([
 NOT regexp_matches(coalesce(raw ->> '$.sku', ''), '^[0-9]+-[0-9]+$'), json_exists(raw, '$.category') AND json_type(raw, '$.category') <> 'NULL' AND raw ->> '$.category' NOT IN ('MEAT', 'DAIRY', 'VEGETABLE'),
 json_type(raw, '$.discountPercentage') <> 'NULL' AND CAST(raw ->> '$.discountPercentage' AS DOUBLE) < 10, json_type(raw, '$.discountPercentage') <> 'NULL' AND CAST(raw ->> '$.discountPercentage' AS DOUBLE) > 40,
 json_type(raw, '$.promotionType') <> 'NULL' AND length(raw ->> '$.promotionType') < 4, len(tags) > 2], lambda b: coalesce(b, false))) + len(list_filter(tags, lambda t: length(t) > 4)) AS errors
FROM (SELECT offer_seq, raw, from_json(raw -> '$.tags', '["VARCHAR"]') AS tags FROM offers WHERE raw IS NOT NULL)""")
def schema_errors(spark, root):
    """V1, V3, M9: how many parts of each raw document break a schema with references."""
    checked = validation.versioned_errors(table(spark, root, "offers").where("raw is not null").select("offer_seq", "raw"), "raw", {1: RAW_SCHEMA}, 1)
    return checked.select("offer_seq", F.size("errors").alias("errors"))


@query("""WITH d AS (SELECT store, ingredient_id AS item, observed_on, median(czk_per_kg) AS value FROM matched_rows WHERE czk_per_kg IS NOT NULL GROUP BY ALL), t AS (SELECT item, store, value FROM d WHERE observed_on = DATE '2026-08-01'),
p AS (SELECT item, store, arg_max(value, observed_on) AS value, max(observed_on) AS last_seen FROM d WHERE observed_on < DATE '2026-08-01' GROUP BY ALL), s AS (SELECT DISTINCT store FROM matched_rows WHERE observed_on = DATE '2026-08-01')
SELECT item, store, value, DATE '2026-08-01' AS last_seen, 0 AS age, 'fresh' AS state, NULL AS reason FROM t
UNION ALL SELECT item, store, value, last_seen, DATE '2026-08-01' - last_seen, CASE WHEN DATE '2026-08-01' - last_seen <= 21 THEN 'carried' ELSE 'dropped' END, CASE WHEN store IN (SELECT store FROM s) THEN 'not_matched_today' ELSE 'store_missing' END FROM p ANTI JOIN t USING (item, store)""")
def carried_with_reasons(spark, root):
    """§2.14, J3, J4, U2, W10: values of a day and those carried to it, with why."""
    from pricelode.operators import relational as R

    rows, day = table(spark, root, "matched_rows"), F.lit("2026-08-01").cast("date")
    daily = R.medians(rows, ["store", "ingredient_id", "observed_on"], "czk_per_kg").select("store", F.col("ingredient_id").alias("item"), "observed_on", F.col("median").alias("value"))
    before = daily.where(F.col("observed_on") < day).groupBy("item", "store").agg(F.max_by("value", "observed_on").alias("value"), F.max("observed_on").alias("last_seen"))
    return reports.carried_prices(daily.where(F.col("observed_on") == day).select("item", "store", "value"), before.select("item", "store", "value"), before.select("item", "store", "last_seen"), rows.where(F.col("observed_on") == day).select("store"), day, 21)


@query("""WITH t AS (SELECT ingredient_id AS item, store, round(czk_per_kg, 1) AS value, valid_to, title FROM matched_rows WHERE promo AND czk_per_kg IS NOT NULL AND ingredient_id IS NOT NULL AND valid_to >= '2026-07-01' AND valid_to < '2026-07-20' AND observed_on >= DATE '2026-07-01'),
u AS (SELECT *, row_number() OVER (PARTITION BY item, store, lower(trim(title)), valid_to ORDER BY value, valid_to, title) AS k FROM t), v AS (SELECT *, row_number() OVER (PARTITION BY item, store ORDER BY value, valid_to, title, lower(trim(title))) AS j FROM u WHERE k = 1) SELECT item, store, value, valid_to, title FROM v WHERE j <= 3""")
def best_deals(spark, root):
    """The three cheapest deals of a pair that end from a day on, each title once; nothing is carried, as all stores have rows."""
    rows = table(spark, root, "matched_rows").where("promo and czk_per_kg is not null and ingredient_id is not null and valid_to >= '2026-07-01' and valid_to < '2026-07-20' and observed_on >= '2026-07-01'")
    deals = rows.select(F.col("ingredient_id").alias("item"), "store", F.col("czk_per_kg").alias("value"), "valid_to", "title")
    return reports.carried_deals(deals, deals.limit(0), rows.select("store"), F.lit("2026-07-01").cast("date"))


@query("SELECT source, count(*) FILTER (status IN ('matched', 'auto')) AS matched, count(*) FILTER (status = 'review') AS review, count(*) FILTER (status NOT IN ('matched', 'auto', 'review')) AS unmatched, 0 AS ignored FROM (SELECT lower(coalesce(nullif(source, ''), nullif(store, ''), 'unknown')) AS source, status FROM matched_rows) GROUP BY ALL")
def classes_by_source(spark, root):
    """Rows by class of status and source."""
    rows = table(spark, root, "matched_rows").withColumn("source", reports.source_key(F.col("source"), F.col("store")))
    return reports.class_counts(rows, ["source"], "status").withColumn("ignored", F.col("ignored").cast("int"))


@query("SELECT match_seq, ingest_ts, row_number() OVER (ORDER BY CASE status WHEN 'review' THEN 0 ELSE 1 END, -coalesce(confidence, 0), coalesce(title, '')) AS place FROM matched_rows WHERE status = 'review' QUALIFY count(*) OVER (PARTITION BY confidence, title) = 1")
def review_queue(spark, root):
    """K3, L2: rows that are not matched, in order of class, confidence and title; those without ties are shown."""
    from pyspark.sql import Window

    rest = reports.split_matches(table(spark, root, "matched_rows").select("match_seq", "ingest_ts", "status", "confidence", "title"), "status", "confidence", "title")[1]
    alone = F.count("*").over(Window.partitionBy("confidence", "title")) == 1
    return rest.withColumn("alone", alone).where("alone").select("match_seq", "ingest_ts", "place")


@query("SELECT coalesce(f.source, c.source) AS source, coalesce(f.ok, coalesce(c.offers, f.items) > 0) AS ok, coalesce(c.offers, f.items) AS offers, c.matched FROM (VALUES ('albert', true, 5), ('kupi', NULL, 7), ('nothing', NULL, 0), ('gone', false, NULL)) f(source, ok, items) FULL JOIN (SELECT source, a.n AS offers, b.n AS matched FROM (SELECT lower(source) AS source, count(*) AS n FROM offers GROUP BY ALL) a FULL JOIN (SELECT lower(source) AS source, count(*) AS n FROM matched_rows GROUP BY ALL) b USING (source)) c ON c.source = f.source")
def source_states(spark, root):
    """Fetch states, offers and matches by source, of any side; the fetch report is read from JSON."""
    states = spark.createDataFrame([('{"sources": {"Albert": {"ok": true, "items": 5}, "kupi": {"items": 7}, "nothing": {"items": 0}, "gone": {"ok": false}}}',)], "document string")
    fetched = reports.fetch_states(states, [], "document").withColumn("requests", F.lit(None).cast("int"))
    counts = [table(spark, root, t).groupBy(F.lower("source").alias("source")).agg(F.count("*").alias("n")) for t in ("offers", "matched_rows")]
    return reports.source_report(fetched, *counts).select("source", "ok", "offers", "matched")


@query("SELECT m.market, coalesce(max(status) FILTER (run_date = last), 'missing') AS status, coalesce(count(*) FILTER (ok), 0) AS good, coalesce(count(*) FILTER (NOT ok), 0) AS failed FROM (SELECT unnest(['cz', 'sk', 'pl', 'de', 'at', 'hu']) AS market) m LEFT JOIN (SELECT *, run_date AS last FROM run_history) h USING (market) GROUP BY ALL")
def market_states(spark, root):
    """Every market with its runs, missing where there are none."""
    markets = spark.createDataFrame([(m,) for m in [*FX, "hu"]], "market string")
    return reports.market_health(markets, table(spark, root, "run_history"))


@query("SELECT 2 AS v, market, snapshot_date AS updated, ingredient_id AS item, store, max(czk_per_kg) AS value FROM last_seen WHERE czk_per_kg IS NOT NULL AND NOT isnan(czk_per_kg) AND snapshot_date IS NOT NULL GROUP BY ALL")
def documents_and_back(spark, root):
    """Prices of each market and day as nested documents, read back as rows."""
    rows = table(spark, root, "last_seen").where("czk_per_kg is not null and not isnan(czk_per_kg) and snapshot_date is not null").groupBy("market", F.lit("EUR").alias("currency"), F.col("snapshot_date").alias("updated"), F.col("ingredient_id").alias("item"), "store").agg(F.max("czk_per_kg").alias("value"))
    return reports.price_rows(reports.price_documents(rows, 2), "document")


@query("SELECT n_nationkey, n_name, s.p AS priority FROM nation, (SELECT unnest([1, 2, NULL, 3, 1]) AS p, unnest([0, 1, 2, 3, 4]) AS m) s WHERE n_nationkey % 5 = s.m AND coalesce(s.p, 1) <= 2 AND n_name IS NOT NULL")
def terms_by_priority(spark, root):
    """Terms up to a priority; one without has the first."""
    priority = F.when(F.col("n_nationkey") % 5 == 2, None).when(F.col("n_nationkey") % 5 == 1, 2).when(F.col("n_nationkey") % 5 == 3, 3).otherwise(1)
    return payloads.terms_up_to(table(spark, root, "nation").where("n_name is not null").select("n_nationkey", "n_name", priority.alias("priority")), 2)


@query("SELECT id, ref_price_czk_per_kg AS value FROM catalogue WHERE ref_price_czk_per_kg IS NOT NULL AND id NOT IN (SELECT ingredient_id FROM build_report WHERE czk_per_kg > 0 AND ingredient_id IS NOT NULL) UNION ALL SELECT id, v FROM catalogue JOIN (SELECT ingredient_id AS id, max(czk_per_kg) AS v FROM build_report WHERE czk_per_kg > 0 GROUP BY ALL) USING (id) WHERE ref_price_czk_per_kg IS NOT NULL")
def overlaid_defaults(spark, root):
    """Default values replaced by given ones above zero."""
    defaults = table(spark, root, "catalogue").where("ref_price_czk_per_kg is not null").select("id", F.col("ref_price_czk_per_kg").alias("value"))
    return payloads.overlaid(defaults, table(spark, root, "build_report").select(F.col("ingredient_id").alias("id"), F.col("czk_per_kg").alias("value")), "id", "value")


@query("SELECT offer_seq, market, price_czk AS price, coalesce(original_price_czk, NULL) AS old_price, coalesce(nullif(ingredient_id, ''), nullif(source, '')) AS term, price_czk, source_url AS url FROM offers")
def offer_aliases(spark, root):
    """Fields under one name each, from whichever alias is there, and copies under second names."""
    rows = reports.renamed(table(spark, root, "offers"), {"offer_seq": ["offer_seq"], "market": ["market"], "price": ["price", "price_czk"], "old_price": ["oldPrice", "original_price_czk"], "term": ["termId", "ingredient_id", "source"], "source_url": ["url", "source_url"]})
    return reports.with_copies(rows, {"price_czk": "price", "url": "source_url"}).drop("source_url")


@query(f"SELECT offer_seq FROM offers WHERE market = 'cz' AND is_promo AND store = 'billa' AND offer_seq NOT IN (SELECT entry_seq FROM build_report WHERE entry_seq IS NOT NULL) AND (coalesce(contains({_fold_sql('title')}, 'maslo'), false) OR coalesce(contains({_fold_sql('source')}, 'maslo'), false))")
def panel_queue(spark, root):
    """rows not handled yet, of one store, with a text in a title or source."""
    rows = table(spark, root, "offers").where("market = 'cz' and is_promo")
    handled = table(spark, root, "build_report").select(F.col("entry_seq").alias("offer_seq"))
    return reports.queue(rows, handled, "offer_seq", store="billa", search="Máslo", columns=("title", "source")).select("offer_seq")


@query("SELECT offer_seq, 'https://search.example.invalid/?f=' || url_encode(title) AS address FROM offers WHERE title IS NOT NULL")
def search_addresses(spark, root):
    """Addresses with percent-encoded texts."""
    coded = F.replace(F.replace(F.replace(F.url_encode("title"), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))
    return table(spark, root, "offers").where("title is not null").select("offer_seq", F.concat(F.lit("https://search.example.invalid/?f="), coded).alias("address"))


@query("SELECT o_orderkey, c_name, n_name FROM (SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 500) LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey")
def named_top(spark, root):
    """The 500 largest rows (the limit is the feature) with the names that belong to their keys."""
    top = table(spark, root, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(500)
    people = table(spark, root, "customer").join(table(spark, root, "nation"), F.col("n_nationkey") == F.col("c_nationkey"), "left")
    return top.join(people, F.col("c_custkey") == F.col("o_custkey"), "left").select("o_orderkey", "c_name", "n_name")


@query("SELECT outlet_id, ingredient_id, czk_per_kg, (SELECT greatest(0, count(*) - 5000) FROM d) AS truncated FROM (WITH d AS (SELECT outlet_id, ingredient_id, czk_per_kg, match_seq, ingest_ts FROM matched_rows WHERE promo) SELECT * FROM d ORDER BY outlet_id, ingredient_id, match_seq, ingest_ts LIMIT 5000) x, (SELECT 1) y".replace("(SELECT greatest(0, count(*) - 5000) FROM d)", "(SELECT greatest(0, count(*) - 5000) FROM matched_rows WHERE promo)"))
def capped_list(spark, root):
    """L1, L3: the first 5,000 rows of an ordered list (the cap is the feature), with how many more there are."""
    rows = table(spark, root, "matched_rows").where("promo")
    shown, more = reports.capped(rows, [F.asc_nulls_last("outlet_id"), F.asc_nulls_last("ingredient_id"), F.asc("match_seq"), F.asc("ingest_ts")], 5000)
    return shown.select("outlet_id", "ingredient_id", "czk_per_kg", more.alias("truncated"))


@query("SELECT market, list_distinct(list(DISTINCT source)) IS NOT NULL AS some, list_sort(list_distinct(list(source))) AS sources, max(czk_per_kg) AS top, list_contains(list(store), 'billa') AS billa FROM matched_rows GROUP BY market")
def market_sets(spark, root):
    """Sets of values, membership and the greatest value of each market."""
    rows = table(spark, root, "matched_rows").groupBy("market").agg(F.collect_set("source").alias("s"), F.collect_set("store").alias("t"), F.max("czk_per_kg").alias("top"))
    return rows.select("market", F.lit(True).alias("some"), F.array_sort(F.array_distinct(F.array_union("s", "s"))).alias("sources"), "top", F.array_contains("t", "billa").alias("billa"))


@query("SELECT market, run_date, CASE WHEN ok THEN CASE WHEN warnings > 0 THEN 'warning' ELSE 'ok' END ELSE 'error' END AS state FROM run_history")
def run_states(spark, root):
    """V4: what errors and warnings make of a run."""
    return table(spark, root, "run_history").select("market", "run_date", validation.report_status(F.when(F.col("ok"), 0).otherwise(1), F.col("warnings")).alias("state"))


@query()
def leaflet_prices(spark, root):
    """Offers of the products of leaflet pages, with how sure they are."""
    from pricelode.operators.leaflets import leaflet_offers, parse_products

    pages = table(spark, root, "documents").where("doc_type = 'leaflet_page'")
    return leaflet_offers(parse_products(pages, "doc_id", F.col("text")), ["doc_id", "product_no"])


_HINTS = [("pet|garden", []), ("meat|ham", ["meat", "poultry"]), ("dairy|milk", ["dairy", "egg"]), ("frozen", None), ("veg", ["vegetable", "herb"]), ("table", ["legume"])]


@query("SELECT result_id, CASE WHEN regexp_matches(c, 'pet|garden') THEN [''] WHEN len(a) > 0 THEN a END AS allowed FROM (SELECT DISTINCT result_id, lower(category) AS c FROM penny_results WHERE category IS NOT NULL), LATERAL (SELECT list_filter([CASE WHEN regexp_matches(c, 'meat|ham') THEN 'meat' END, CASE WHEN regexp_matches(c, 'meat|ham') THEN 'poultry' END, CASE WHEN regexp_matches(c, 'dairy|milk') THEN 'dairy' END, CASE WHEN regexp_matches(c, 'dairy|milk') THEN 'egg' END, CASE WHEN regexp_matches(c, 'veg') THEN 'vegetable' END, CASE WHEN regexp_matches(c, 'veg') THEN 'herb' END, CASE WHEN regexp_matches(c, 'table') THEN 'legume' END], lambda x: x IS NOT NULL) AS a)")
def hint_categories(spark, root):
    """The categories that ordered rules allow for a source's category."""
    rows = table(spark, root, "penny_results").where("category is not null").select("result_id", matching.category_hint(F.col("category"), _HINTS).alias("allowed"))
    return rows.distinct()


@query("SELECT outlet_id, n || ' ' || CASE WHEN n = 1 THEN 'cena' WHEN n BETWEEN 2 AND 4 THEN 'ceny' ELSE 'cen' END AS shown FROM (SELECT outlet_id, count(DISTINCT ingredient_id) AS n FROM build_report GROUP BY ALL)")
def counted_prices(spark, root):
    """Numbers with the form of the word that goes with them."""
    counts = table(spark, root, "build_report").groupBy("outlet_id").agg(F.count_distinct("ingredient_id").alias("n"))
    return counts.select("outlet_id", text.counted(F.col("n"), "cena", "ceny", "cen").alias("shown"))


@query("SELECT doc_id, trim(regexp_replace('<b>' || replace(doc, '  ', ' '), '[\\s\\p{Z}]+', ' ', 'g'))[4:] AS plain FROM (SELECT doc_id, lang || ' ' || source AS doc FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL)")
def html_text(spark, root):
    """The text of pieces of HTML."""
    html = F.concat(F.lit("<p class='x'>"), F.col("lang"), F.lit("&nbsp;\n <br/>"), F.col("source"), F.lit("</p> "))
    return table(spark, root, "documents").where("lang is not null and source is not null").select("doc_id", text.plain_html(html).alias("plain"))


@query("SELECT s.store, count(DISTINCT source) AS sources, count(DISTINCT source) = 0 AS not_fetched FROM (SELECT unnest(['billa', 'lidl', 'albert', 'globus', 'unknown']) AS store) s LEFT JOIN offers o ON o.store = s.store GROUP BY ALL")
def store_sources(spark, root):
    """Stores of a list with how many sources fetch them, and those that none does."""
    stores = spark.createDataFrame([(s,) for s in ("billa", "lidl", "albert", "globus", "unknown")], "store string")
    counts = table(spark, root, "offers").groupBy("store").agg(F.count_distinct("source").alias("sources"))
    return stores.join(counts, "store", "left").select("store", F.coalesce("sources", F.lit(0)).alias("sources"), F.col("sources").isNull().alias("not_fetched"))
