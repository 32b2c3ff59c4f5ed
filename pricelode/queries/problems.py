"""Queries for the data problems that belong to the core."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelode.functions.dates import flexible_date
from pricelode.operators import history, intervals, quantities, spikes
from pricelode.plans.markets import fx
from pricelode.session import table

#: A price above this many times the market's rate is impossible.
HIGHEST = 50_000.0


def _impossible(value: Column, market: Column) -> Column:
    return F.coalesce((value <= 0) | (value > HIGHEST * fx(market)), F.lit(False))


def p1_reasons(spark: SparkSession, root: str) -> DataFrame:
    """table_name, row_id, why, carried_for: implausible readings with what is wrong; of build_report also the reason it was carried for, in one spelling."""
    value = F.col("czk_per_kg")
    impossible = _impossible(value, F.col("market"))
    matched, carried = table(spark, root, "matched_rows"), table(spark, root, "build_report")
    series = spikes.impossible_rows(matched, row="match_seq", impossible=impossible).unionByName(
        spikes.implausible_in_series(matched, row="match_seq", source="source", series=["outlet_id", "ingredient_id"], regime="promo", at="observed_on", value=value, impossible=impossible))
    stretches = spikes.impossible_rows(carried, row="entry_seq", impossible=impossible).unionByName(
        spikes.implausible_in_stretches(carried, row="entry_seq", stretch=["outlet_id", "ingredient_id", "last_seen"], value=value, impossible=impossible))
    reasons = carried.groupBy(F.col("entry_seq").alias("row_id")).agg(F.max(F.regexp_replace(F.lower(F.trim("reason")), "[^a-z]+", "_")).alias("carried_for"))
    return series.withColumn("carried_for", F.lit(None).cast("string")).withColumn("table_name", F.lit("matched_rows")).unionByName(
        stretches.join(reasons, "row_id", "left").withColumn("table_name", F.lit("build_report"))
    ).groupBy("table_name", "row_id").agg(F.array_join(F.array_sort(F.collect_set("why")), ",").alias("why"), F.max("carried_for").alias("carried_for"))


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    """table_name, row_id of readings of czk_per_kg that cannot be right, each once."""
    return p1_reasons(spark, root).select("table_name", "row_id")


def p1_plain(spark: SparkSession, root: str) -> DataFrame:
    """table_name, row_id, why of implausible readings that are no spikes: impossible, stuck or stray."""
    reasons = p1_reasons(spark, root).select("table_name", "row_id", F.explode(F.split("why", ",")).alias("why"))
    return reasons.where("why <> 'spike'")


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    """span_kind, outlet_id, ingredient_id, span_from, span_to: continuous validity periods and the gaps between them."""
    offers = table(spark, root, "offers")
    spans = intervals.merge_intervals(offers, ["outlet_id", "ingredient_id"], flexible_date(F.col("valid_from")), flexible_date(F.col("valid_to")))
    return spans.select("span_kind", "outlet_id", "ingredient_id", F.col("span_from").cast("string").alias("span_from"), F.col("span_to").cast("string").alias("span_to"))


def p5_history(spark: SparkSession, root: str) -> DataFrame:
    """market, outlet_id, ingredient_id, version_from, version_to, last_seen, czk_per_kg: all versions of each pair."""
    calendar = table(spark, root, "run_history").where("ok").select("market", F.col("run_date").alias("snapshot_date"))
    versions = history.version_history(
        table(spark, root, "last_seen"), calendar, scope="market", entity=["outlet_id", "ingredient_id"], at="snapshot_date", loaded="loaded_at",
        attributes={"last_seen": F.col("last_seen"), "cents": F.round(F.col("czk_per_kg") * 100).cast("bigint")},
    )
    return versions.select("market", "outlet_id", "ingredient_id", F.col("version_from").cast("string").alias("version_from"), F.col("version_to").cast("string").alias("version_to"), F.col("last_seen").cast("string").alias("last_seen"), (F.col("cents") / 100).alias("czk_per_kg"))


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    """outlet_id, ingredient_id, version_from, version_to."""
    return p5_history(spark, root).select("outlet_id", "ingredient_id", "version_from", "version_to")


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    """table_name, field_name, row_id, base_unit, base_amount."""
    offers = quantities.offer_quantities(table(spark, root, "offers")).withColumn("table_name", F.lit("offers"))
    results = quantities.product_quantities(table(spark, root, "penny_results")).withColumn("table_name", F.lit("penny_results"))
    return offers.unionByName(results).select("table_name", "field_name", "row_id", "base_unit", "base_amount")


QUERIES = {f.__name__: f for f in (p1_found, p1_reasons, p1_plain, p4_found, p5_found, p5_history, p6_found)}

_DAY = "try_strptime(regexp_replace({0}, '[^0-9]', '', 'g'), '%Y%m%d')::DATE"

SQL = {
    "p4_found": f"""
WITH d AS (SELECT DISTINCT outlet_id, ingredient_id, {_DAY.format('valid_from')} AS a, {_DAY.format('valid_to')} AS b FROM offers WHERE outlet_id IS NOT NULL AND ingredient_id IS NOT NULL),
v AS (SELECT *, max(b) OVER (PARTITION BY outlet_id, ingredient_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM d WHERE a <= b),
g AS (SELECT *, sum(CASE WHEN seen IS NULL OR a - seen > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY outlet_id, ingredient_id ORDER BY a, b) AS n FROM v),
p AS (SELECT outlet_id, ingredient_id, n, min(a) AS a, max(b) AS b FROM g GROUP BY ALL),
q AS (SELECT *, lag(b) OVER (PARTITION BY outlet_id, ingredient_id ORDER BY a) AS last FROM p)
SELECT 'period' AS span_kind, outlet_id, ingredient_id, strftime(a, '%Y-%m-%d') AS span_from, strftime(b, '%Y-%m-%d') AS span_to FROM q
UNION ALL SELECT 'gap', outlet_id, ingredient_id, strftime(last + 1, '%Y-%m-%d'), strftime(a - 1, '%Y-%m-%d') FROM q WHERE last IS NOT NULL""",
    "p5_history": """
WITH c AS (SELECT market, run_date AS day, row_number() OVER (PARTITION BY market ORDER BY run_date) AS n FROM (SELECT DISTINCT market, run_date FROM run_history WHERE ok)),
s AS (SELECT market, outlet_id, ingredient_id, snapshot_date AS day, last_seen, CAST(round(czk_per_kg * 100) AS BIGINT) AS cents,
 row_number() OVER (PARTITION BY market, outlet_id, ingredient_id, snapshot_date ORDER BY loaded_at DESC, last_seen DESC NULLS LAST, czk_per_kg DESC NULLS LAST) AS k FROM last_seen),
t AS (SELECT s.*, c.n, c.n - row_number() OVER (PARTITION BY s.market, outlet_id, ingredient_id, last_seen, cents ORDER BY c.n) AS run FROM s JOIN c USING (market, day) WHERE k = 1),
r AS (SELECT market, outlet_id, ingredient_id, last_seen, cents, run, min(day) AS a, max(n) AS n FROM t GROUP BY ALL)
SELECT r.market, outlet_id, ingredient_id, strftime(a, '%Y-%m-%d') AS version_from, coalesce(strftime(c.day, '%Y-%m-%d'), '9999-12-31') AS version_to, strftime(last_seen, '%Y-%m-%d') AS last_seen, cents / 100.0 AS czk_per_kg
FROM r LEFT JOIN c ON c.market = r.market AND c.n = r.n + 1""",
}
SQL["p5_found"] = f"SELECT outlet_id, ingredient_id, version_from, version_to FROM ({SQL['p5_history']})"

_FX = "CASE market WHEN 'cz' THEN 1 WHEN 'pl' THEN 0.17 WHEN 'sk' THEN 0.041 WHEN 'de' THEN 0.041 WHEN 'at' THEN 0.041 END"
_BAD = f"coalesce(czk_per_kg <= 0 OR czk_per_kg > 50000 * {_FX}, false)"

SQL["p1_plain"] = f"""
WITH m AS (SELECT match_seq, outlet_id, ingredient_id, source, observed_on, czk_per_kg FROM matched_rows WHERE czk_per_kg IS NOT NULL AND match_seq IS NOT NULL QUALIFY row_number() OVER (PARTITION BY match_seq ORDER BY ingest_ts) = 1),
s AS (SELECT *, CASE WHEN czk_per_kg = lag(czk_per_kg) OVER w THEN 0 ELSE 1 END AS new FROM m WINDOW w AS (PARTITION BY source, outlet_id, ingredient_id ORDER BY observed_on, match_seq)),
r AS (SELECT *, sum(new) OVER (PARTITION BY source, outlet_id, ingredient_id ORDER BY observed_on, match_seq) AS run FROM s),
n AS (SELECT source, outlet_id, ingredient_id, run, count(*) AS held FROM r GROUP BY ALL),
u AS (SELECT source, quantile_disc(held, 0.5) AS usual FROM n GROUP BY source),
b AS (SELECT entry_seq, outlet_id, ingredient_id, last_seen, max(czk_per_kg) AS v FROM build_report WHERE czk_per_kg > 0 AND NOT {_BAD} AND entry_seq IS NOT NULL GROUP BY ALL),
l AS (SELECT *, median(v) OVER (PARTITION BY outlet_id, ingredient_id, last_seen) AS level FROM b)
SELECT DISTINCT 'matched_rows' AS table_name, match_seq AS row_id, 'impossible' AS why FROM matched_rows WHERE {_BAD} AND match_seq IS NOT NULL
UNION ALL SELECT DISTINCT 'build_report', entry_seq, 'impossible' FROM build_report WHERE {_BAD} AND entry_seq IS NOT NULL
UNION ALL SELECT 'matched_rows', match_seq, 'stuck' FROM r JOIN n USING (source, outlet_id, ingredient_id, run) JOIN u USING (source) WHERE held >= greatest(8, 3 * usual)
UNION ALL SELECT DISTINCT 'build_report', entry_seq, 'stray' FROM l WHERE abs(ln(v / level)) > 0.2 AND abs(v - level) > 0.06"""

# Fixed values of the SQL: spellings of units and what they are in g, ml or pieces, written out apart from the library's graph.
_SPELLED = {
    "mg": (0.001, "g"), "g gr gram grams gramm gramů gramu gramov": (1, "g"), "dkg dag deka": (10, "g"), "kg kilo kilogram": (1000, "g"), "ml mililitr mililiter milliliter": (1, "ml"), "cl": (10, "ml"), "dl": (100, "ml"),
    "l ltr liter litr litre litrů litru": (1000, "ml"), "ks kus kusy kusů kusu kusov szt sztuk sztuka sztuki stk st stück stuck pcs pc": (1, "ks"),
}
_UNITS = "|".join(sorted((u for own in _SPELLED for u in own.split()), key=len, reverse=True))
_UNIT_TABLE = "(VALUES " + ", ".join(f"('{u}', {factor}, '{base}')" for own, (factor, base) in _SPELLED.items() for u in own.split()) + ") u(spelling, factor, base)"
_B = r"[\s\p{Z}]"
_SIZE = rf"(?:^|[^\p{{L}}0-9.,/])(?:([0-9]{{1,3}}){_B}*[x×*]{_B}*)?([0-9]+{_B}?/{_B}?[0-9]+|[0-9]+{_B}?[½¼¾]|[½¼¾]|[0-9]+(?:[.,][0-9]+)?){_B}*({_UNITS})(?:[^\p{{L}}0-9]|$)"
_WHOLE = r"^(?:([0-9]{1,3})[x×*])?([0-9]+/[0-9]+|[0-9]*[½¼¾]|[0-9]+(?:[.,][0-9]+)?)(\p{L}*)\.?$"


def _amount_of(text: str) -> str:
    bare = f"regexp_replace({text}, '[\\s\\p{{Z}}]', '', 'g')"
    part = "CASE WHEN {0} LIKE '%½' THEN 0.5 WHEN {0} LIKE '%¼' THEN 0.25 WHEN {0} LIKE '%¾' THEN 0.75 END".format(bare)
    return (f"coalesce(try_cast(replace({bare}, ',', '.') AS DOUBLE), coalesce(try_cast(regexp_extract({bare}, '^([0-9]*)', 1) AS DOUBLE), 0) + {part}, "
            f"try_cast(split_part({bare}, '/', 1) AS DOUBLE) / nullif(try_cast(split_part({bare}, '/', 2) AS DOUBLE), 0))")


SQL["p6_found"] = f"""
WITH o AS (SELECT offer_seq, price_czk, price_per_kg, regexp_extract(lower(title), '{_SIZE}', ['n', 'a', 'u']) AS t, quantity, regexp_replace(lower(unit), '[\\s\\p{{Z}}.]', '', 'g') AS unit FROM offers WHERE offer_seq IS NOT NULL),
p AS (SELECT offer_seq, price_czk, price_per_kg, CASE WHEN t.a <> '' THEN coalesce(try_cast(t.n AS DOUBLE), 1) * {_amount_of('t.a')} WHEN quantity IS NOT NULL AND NOT isnan(quantity) AND unit <> '' THEN quantity END AS n, CASE WHEN t.a <> '' THEN t.u WHEN quantity IS NOT NULL AND unit <> '' THEN unit END AS spelling FROM o),
q AS (SELECT offer_seq, price_czk AS price, price_per_kg AS rec, base, n * factor AS amount FROM p JOIN {_UNIT_TABLE} USING (spelling) WHERE n IS NOT NULL),
r AS (SELECT result_id, regexp_extract(lower(regexp_replace(amount, '[\\s\\p{{Z}}]', '', 'g')), '{_WHOLE}', ['n', 'a', 'u']) AS s, regexp_replace(lower(volume_label_short), '[\\s\\p{{Z}}.]', '', 'g') AS label, regexp_extract(lower(product_name), '{_SIZE}', ['n', 'a', 'u']) AS t,
 regexp_extract(lower(regexp_replace(CASE WHEN trim(price.base_price_factor) <> '' THEN price.base_price_factor ELSE '1' END, '[\\s\\p{{Z}}]', '', 'g')), '{_WHOLE}', ['n', 'a', 'u']) AS f, regexp_replace(lower(price.base_unit_short), '[\\s\\p{{Z}}.]', '', 'g') AS per FROM penny_results WHERE result_id IS NOT NULL),
v AS (SELECT result_id, 'amount' AS field, CASE WHEN s.a <> '' AND coalesce(nullif(s.u, ''), nullif(label, '')) IS NOT NULL THEN coalesce(try_cast(s.n AS DOUBLE), 1) * {_amount_of('s.a')} WHEN t.a <> '' THEN coalesce(try_cast(t.n AS DOUBLE), 1) * {_amount_of('t.a')} END AS n,
 CASE WHEN s.a <> '' AND coalesce(nullif(s.u, ''), nullif(label, '')) IS NOT NULL THEN coalesce(nullif(s.u, ''), label) WHEN t.a <> '' THEN t.u END AS spelling FROM r
 UNION ALL SELECT result_id, 'base_price_factor', coalesce(try_cast(f.n AS DOUBLE), 1) * {_amount_of('f.a')}, coalesce(nullif(f.u, ''), nullif(per, '')) FROM r WHERE f.a <> '')
SELECT 'offers' AS table_name, 'quantity' AS field_name, offer_seq AS row_id, any_value(base) AS base_unit, CAST(max(round(amount)) AS BIGINT) AS base_amount FROM q GROUP BY offer_seq
UNION ALL SELECT 'offers', 'price_per_kg', offer_seq, any_value(base), max(CASE WHEN abs(ln(rec / (price / amount * 1000))) <= abs(ln(rec / (price / amount * 100))) THEN 1000 ELSE 100 END)::BIGINT FROM q WHERE base IN ('g', 'ml') AND rec > 0 AND price > 0 AND amount > 0 GROUP BY offer_seq
UNION ALL SELECT 'penny_results', field, result_id, any_value(base), CAST(max(round(n * factor)) AS BIGINT) FROM v JOIN {_UNIT_TABLE} USING (spelling) WHERE n IS NOT NULL GROUP BY result_id, field"""
