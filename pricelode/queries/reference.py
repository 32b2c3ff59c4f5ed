"""Queries that exercise the general operators on whole tables, with DuckDB SQL for each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricelode.functions import numbers, text
from pricelode.operators import relational as R
from pricelode.plans.markets import fx
from pricelode.session import table
from pricelode.sources.sinks import nested_map

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    """Registers a query under its function's name, with its SQL."""
    def keep(function):
        QUERIES[function.__name__] = function
        SQL[function.__name__] = sql
        return function

    return keep


# Fixed values of the SQL: letters and what each folds to, and the endings of stems, written out apart from the library's.
_LETTERS = "áäâàãåāăąǎảạắằẳặấầẩẫậæčçćĉċďđðéěëèêēęėĕẻẽẹếềểễệğģġħíïìîīıįǐỉĩịķľĺłļňñńņóöòôõøōőơǒỏọốồổỗộớờởỡợřŕšśşșŝťþţțúůüùûūűưųǔǚủũụứừửữựýÿỳỷỹỵžżź"
_PLAIN = "aaaaaaaaaaaaaaaaaaaaaacccccdddeeeeeeeeeeeeeeeeeggghiiiiiiiiiiikllllnnnnoooooooooooooooooooooorrsssssttttuuuuuuuuuuuuuuuuuuuyyyyyyzzz"
_CS = "ami|emi|ich|ech|ach|ata|ete|um|am|ou|em|im|ym|e|i|u|y|a|o"
_PL = "ami|ach|iem|ich|owe|owy|owa|ego|emu|ych|ymi|ow|om|em|ie|ia|iu|ek|ka|ki|ko|e|i|u|y|a|o"
_DE = "chen|lein|ern|en|er|es|em|st|e|n|s"


def _fold_sql(c: str) -> str:
    return f"trim(regexp_replace(translate(replace(replace(lower({c}), 'ß', 'ss'), 'œ', 'oe'), '{_LETTERS}', '{_PLAIN}'), '[^a-z0-9]+', ' ', 'g'))"


def _split(spark: SparkSession, root: str) -> DataFrame:
    """Distinct title tokens of offers with the rows they are in."""
    offers = table(spark, root, "offers").select("offer_seq", F.explode(F.array_distinct(text.tokens(text.fold(F.col("title"))))).alias("token"))
    return offers.groupBy("token").agg(F.count("*").alias("n"))


_SPLIT = f"SELECT token, count(*) AS n FROM (SELECT DISTINCT offer_seq, unnest(string_split({_fold_sql('title')}, ' ')) AS token FROM offers) WHERE length(token) >= 2 GROUP BY token"


@query(f"SELECT offer_seq, {_fold_sql('title')} AS folded FROM offers")
def fold_text(spark, root):
    """Titles folded to plain small letters."""
    return table(spark, root, "offers").select("offer_seq", text.fold(F.col("title")).alias("folded"))


@query(_SPLIT)
def token_counts(spark, root):
    """Tokens of titles and the offers they are in."""
    return _split(spark, root)


@query("SELECT token, " + ", ".join(f"regexp_replace(token, '^(.{{4,}}?)(?:{ends})$', '\\1') AS {name}" for name, ends in (("cs", _CS), ("pl", _PL), ("de", _DE))) + f" FROM ({_SPLIT})")
def stem_text(spark, root):
    """Stems of title tokens by language."""
    return _split(spark, root).select("token", *[text.stem(F.col("token"), language).alias(language) for language in ("cs", "pl", "de")])


@query(f"SELECT offer_seq FROM (SELECT offer_seq, string_split({_fold_sql('title')}, ' ') AS parts FROM offers) WHERE len(list_filter(parts, lambda x: length(x) >= 3 AND (starts_with(x, 'maslo') OR starts_with('maslo', x)))) > 0 AND len(list_filter(parts, lambda x: length(x) >= 2 AND starts_with(x, 'rost'))) = 0")
def term_predicate(spark, root):
    """Titles that have all words of a term and none of its negatives."""
    parts = text.tokens(text.fold(F.col("title")))
    return table(spark, root, "offers").withColumn("parts", parts).where(
        text.all_tokens_match(F.array(F.lit("maslo")), F.col("parts")) & ~F.exists("parts", lambda t: t.startswith("rost"))).select("offer_seq")


@query(f"SELECT a.token AS token, b.word AS word, a.n AS n FROM ({_SPLIT}) a JOIN (SELECT DISTINCT unnest(string_split({_fold_sql('name_cs')}, ' ')) AS word FROM catalogue) b ON length(a.token) >= 3 AND length(b.word) >= 3 AND (starts_with(a.token, b.word) OR starts_with(b.word, a.token))")
def prefix_join(spark, root):
    """Title tokens and catalogue words that one begins the other, by blocks of three letters."""
    words = table(spark, root, "catalogue").select(F.explode(text.tokens(text.fold(F.col("name_cs")))).alias("word")).distinct()
    return R.blocked_prefix_pairs(_split(spark, root), words, "token", "word").select("token", "word", "n")


@query("SELECT title, substr(title, 1, 80) AS shown, min(offer_seq) AS offer_seq FROM (SELECT offer_seq, trim(regexp_replace(title, '[\\s\\p{Z}]+', ' ', 'g')) AS title FROM offers) GROUP BY title")
def dedupe_first_seen(spark, root):
    """The first offer of each whole title, white space collapsed; `shown` is cut for display."""
    return table(spark, root, "offers").groupBy(text.collapse(F.col("title")).alias("title")).agg(F.min("offer_seq").alias("offer_seq")).withColumn("shown", text.shortened(F.col("title")))


@query("SELECT offer_seq, outlet_id, ingredient_id, price_czk FROM (SELECT *, row_number() OVER (PARTITION BY outlet_id, ingredient_id ORDER BY price_czk, valid_to, title, offer_seq) AS k FROM offers WHERE ingredient_id IS NOT NULL) WHERE k <= 3")
def top_three(spark, root):
    """The three cheapest offers of each pair."""
    order = [F.col("price_czk").asc_nulls_last(), F.col("valid_to").asc_nulls_last(), F.col("title").asc_nulls_last(), F.col("offer_seq").asc()]
    return R.top_per_group(table(spark, root, "offers").where("ingredient_id is not null"), ["outlet_id", "ingredient_id"], order, 3).select("offer_seq", "outlet_id", "ingredient_id", "price_czk")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, date_trunc('month', o_orderdate) ORDER BY o_totalprice, o_orderkey) AS k FROM orders) WHERE k = 1")
def dedupe_keep_cheapest(spark, root):
    """Of rows with equal keys the cheapest."""
    orders = table(spark, root, "orders").withColumn("month", F.date_trunc("month", "o_orderdate"))
    return R.top_per_group(orders, ["o_custkey", "month"], [F.col("o_totalprice"), F.col("o_orderkey")]).select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT l_partkey, l_suppkey, coalesce(median(CASE WHEN l_discount = 0 THEN l_extendedprice END), median(CASE WHEN l_discount > 0 THEN l_extendedprice END)) AS per_group, count(*) AS n FROM lineitem GROUP BY ALL")
def price_median(spark, root):
    """A1, A2: exact median of the regular rows of a group, of the others if there are none."""
    return R.conditional_median(table(spark, root, "lineitem"), ["l_partkey", "l_suppkey"], "l_extendedprice", F.col("l_discount") == 0)


@query("""
WITH t AS (SELECT outlet_id, ingredient_id, median(czk_per_kg) AS value FROM matched_rows WHERE observed_on = DATE '2026-08-01' GROUP BY ALL),
p AS (SELECT outlet_id, ingredient_id, max(observed_on) AS seen, arg_max(czk_per_kg, observed_on) AS value FROM (SELECT outlet_id, ingredient_id, observed_on, median(czk_per_kg) AS czk_per_kg FROM matched_rows WHERE observed_on < DATE '2026-08-01' GROUP BY ALL) WHERE czk_per_kg IS NOT NULL GROUP BY ALL)
SELECT outlet_id, ingredient_id, value, DATE '2026-08-01' AS seen, 0 AS age, 'fresh' AS state FROM t WHERE value IS NOT NULL
UNION ALL SELECT outlet_id, ingredient_id, value, seen, DATE '2026-08-01' - seen, CASE WHEN DATE '2026-08-01' - seen <= 21 THEN 'carried' ELSE 'dropped' END
FROM p ANTI JOIN (SELECT * FROM t WHERE value IS NOT NULL) USING (outlet_id, ingredient_id)""")
def carry_forward(spark, root):
    """J3, J4, U2, W10, §2.14: state of pairs on a day, older values carried for 21 days."""
    rows, day = table(spark, root, "matched_rows"), F.lit("2026-08-01").cast("date")
    daily = rows.groupBy("outlet_id", "ingredient_id", "observed_on").agg(F.median("czk_per_kg").alias("value")).where("value is not null")
    before = daily.where(F.col("observed_on") < day).groupBy("outlet_id", "ingredient_id").agg(F.max("observed_on").alias("seen"), F.max_by("value", "observed_on").alias("value"))
    return R.carry_forward(daily.where(F.col("observed_on") == day), before, ["outlet_id", "ingredient_id"], day, 21)


#: ordinal, pattern, target, store, market: rules as people write them (the last can never be reached by Czech rows).
RULES = [
    (1, "re:mrazen|mrozon", "frozen", "*", "*"), (2, "bio", "organic_billa", "billa", "cz"), (3, "/^[0-9]/", "leading_number", None, None), (4, "sub:mas", "butter", "*", "cz"),
    (5, "BIO", "organic", "*", "*"), (6, "Käse", "cheese", "*", "de"), (7, "sub:mas", "late", "*", "*"), (8, "  ", "nothing", "*", "*"),
]
_RULES_SQL = "(VALUES (1, 'mrazen|mrozon', 'frozen', '*', '*'), (2, '(^|[^a-z0-9])bio($|[^a-z0-9])', 'organic_billa', 'billa', 'cz'), (3, '^[0-9]', 'leading_number', '*', '*'), (4, 'mas', 'butter', '*', 'cz'), (5, '(^|[^a-z0-9])bio($|[^a-z0-9])', 'organic', '*', '*'), (6, '(^|[^a-z0-9])kase($|[^a-z0-9])', 'cheese', '*', 'de'), (7, 'mas', 'late', '*', '*')) r(ordinal, pattern, target, store, market)"


@query(f"SELECT offer_seq, min(ordinal)::INTEGER AS ordinal, arg_min(target, ordinal) AS target FROM (SELECT o.offer_seq, r.ordinal, r.target FROM (SELECT *, {_fold_sql('title')} AS folded FROM offers) o JOIN {_RULES_SQL} ON r.store IN ('*', o.store) AND r.market IN ('*', o.market) AND regexp_matches(o.folded, r.pattern)) GROUP BY offer_seq")
def first_match_rules(spark, root):
    """The first of ordered rules, of a title's store and market or of all, whose pattern it matches."""
    rules = spark.createDataFrame(RULES, "ordinal int, pattern string, target string, store string, market string")
    return R.first_match(table(spark, root, "offers").select("offer_seq", "title", "store", "market"), rules, text="title", store="store", market="market").select("offer_seq", "ordinal", "target")


@query("SELECT coalesce(reason, 'ok') AS reason, count(*) AS n FROM (SELECT CASE WHEN NOT l_returnflag <> 'R' THEN 'returned' WHEN NOT l_discount <= 0.05 THEN 'discounted' WHEN NOT l_quantity < 40 THEN 'bulk' END AS reason FROM lineitem) GROUP BY ALL")
def skip_reasons(spark, root):
    """rows by the first check they fail."""
    reason = R.first_failing([("returned", F.col("l_returnflag") != "R"), ("discounted", F.col("l_discount") <= 0.05), ("bulk", F.col("l_quantity") < 40)])
    return table(spark, root, "lineitem").groupBy(F.coalesce(reason, F.lit("ok")).alias("reason")).agg(F.count("*").alias("n"))


@query("SELECT match_seq, ingest_ts, m.market, CASE WHEN ref > 0 THEN czk_per_kg < ref * 0.2 OR czk_per_kg > ref * 4 ELSE false END AS flagged FROM matched_rows m JOIN (VALUES ('cz', 1.0), ('sk', 0.041), ('de', 0.041), ('at', 0.041), ('pl', 0.17)) f(market, fx) ON f.market = m.market LEFT JOIN (SELECT id, ref_price_czk_per_kg FROM catalogue) c ON c.id = ingredient_id, LATERAL (SELECT ref_price_czk_per_kg * fx AS ref) WHERE czk_per_kg > 0 AND czk_per_kg <= 50000 * fx AND coalesce(czk_per_kg BETWEEN ref * 0.1 AND ref * 10, true)")
def outlier_band(spark, root):
    """Readings within a wide band around the reference of their item, where one is known, in the market's currency;
    those outside a narrow band are kept with a flag."""
    rows = table(spark, root, "matched_rows").join(table(spark, root, "catalogue").select("id", "ref_price_czk_per_kg"), F.col("ingredient_id") == F.col("id"), "left").withColumn("fx", fx(F.col("market"))).withColumn("ref", F.col("ref_price_czk_per_kg") * F.col("fx"))
    value, ref = F.col("czk_per_kg"), F.col("ref")
    kept = rows.where((value > 0) & (value <= 50_000 * F.col("fx")) & F.coalesce(value.between(ref * 0.1, ref * 10), F.lit(True)))
    return kept.select("match_seq", "ingest_ts", "market", F.when(ref > 0, (value < ref * 0.2) | (value > ref * 4)).otherwise(F.lit(False)).alias("flagged"))


def _day_sql(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}, '^[0-9]{{4}}-[0-9][0-9]-[0-9][0-9]$') THEN try_strptime({c}, '%Y-%m-%d')::DATE END"


@query(f"SELECT offer_seq FROM offers WHERE coalesce({_day_sql('valid_from')} <= DATE '2026-07-01', true) AND coalesce({_day_sql('valid_to')} >= DATE '2026-07-01', true)")
def validity_current(spark, root):
    """Validity intervals that hold a day; an end that is null or no date is open."""
    day, parse = F.lit("2026-07-01").cast("date"), lambda c: F.try_to_timestamp(F.when(F.col(c).rlike(r"^\d{4}-\d\d-\d\d$"), F.col(c)), F.lit("yyyy-MM-dd")).cast("date")
    return table(spark, root, "offers").where(F.coalesce(parse("valid_from") <= day, F.lit(True)) & F.coalesce(parse("valid_to") >= day, F.lit(True))).select("offer_seq")


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def unknown_key_anti(spark, root):
    """Rows without a partner."""
    return table(spark, root, "orders").join(table(spark, root, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey")


@query("SELECT coalesce(a.source, b.source) AS source, coalesce(a.n, 0) AS offers, coalesce(b.n, 0) AS matched FROM (SELECT source, count(*) AS n FROM offers GROUP BY ALL) a FULL JOIN (SELECT source, count(*) AS n FROM matched_rows GROUP BY ALL) b ON a.source = b.source")
def source_outer(spark, root):
    """Counts of two tables by source, of either side."""
    a, b = (table(spark, root, t).groupBy("source").agg(F.count("*").alias(n)) for t, n in (("offers", "offers"), ("matched_rows", "matched")))
    return a.join(b, "source", "full_outer").na.fill(0, ["offers", "matched"])


@query("SELECT n_nationkey, s.m AS c_mktsegment, coalesce(n, 0) AS n FROM nation CROSS JOIN (SELECT DISTINCT c_mktsegment AS m FROM customer) s LEFT JOIN (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY ALL) c ON c_nationkey = n_nationkey AND c_mktsegment = s.m")
def store_frame(spark, root):
    """Every member of a dimension with its count, 0 where there is none."""
    customer = table(spark, root, "customer")
    segments = customer.agg(F.array_sort(F.collect_set("c_mktsegment"))).scalar()
    frame = table(spark, root, "nation").select("n_nationkey", F.explode(segments).alias("c_mktsegment"))
    counts = customer.groupBy(F.col("c_nationkey").alias("n_nationkey"), "c_mktsegment").agg(F.count("*").alias("n"))
    return R.complete(counts, frame, ["n_nationkey", "c_mktsegment"], "n")


@query("SELECT status, count(*) FILTER (market = 'cz') AS cz, count(*) FILTER (market = 'sk') AS sk, count(*) FILTER (market = 'pl') AS pl, count(*) FILTER (market = 'de') AS de, count(*) FILTER (market = 'at') AS at FROM matched_rows GROUP BY status".replace("AS at", 'AS "at"'))
def status_pivot(spark, root):
    """Counts by status, markets side by side."""
    markets = ["cz", "sk", "pl", "de", "at"]
    return table(spark, root, "matched_rows").groupBy("status").agg(*[F.count_if(F.col("market") == m).alias(m) for m in markets])


@query("SELECT store, ingredient_id, per_kg FROM (SELECT store, ingredient_id, median(czk_per_kg) AS per_kg FROM matched_rows GROUP BY ALL) WHERE per_kg IS NOT NULL")
def nested_price_map(spark, root):
    """A nested map built and flattened again."""
    each = R.medians(table(spark, root, "matched_rows"), ["store", "ingredient_id"], "czk_per_kg").withColumnRenamed("median", "per_kg")
    return nested_map(each, ["store"], "ingredient_id", F.col("per_kg")).select("store", F.explode("values").alias("ingredient_id", "per_kg"))


@query("SELECT market, run_date, status, ok FROM (SELECT *, row_number() OVER (PARTITION BY market, run_date ORDER BY generated_at DESC) AS k, dense_rank() OVER (PARTITION BY market ORDER BY run_date DESC) AS r FROM run_history) WHERE k = 1 AND r <= 14")
def daily_history(spark, root):
    """The latest run of each day, last fourteen days of a market."""
    latest = R.top_per_group(table(spark, root, "run_history"), ["market", "run_date"], [F.col("generated_at").desc()])
    return R.top_per_group(latest, ["market"], [F.col("run_date").desc()], 14).select("market", "run_date", "status", "ok")


@query("SELECT market, max(CASE WHEN ok THEN run_date END) AS last_ok, count(*) FILTER (ok) AS good, count(*) FILTER (NOT ok) AS failed FROM run_history GROUP BY ALL")
def last_good_run(spark, root):
    """The last good run of a market."""
    return table(spark, root, "run_history").groupBy("market").agg(F.max(F.when(F.col("ok"), F.col("run_date"))).alias("last_ok"), F.count_if("ok").alias("good"), F.count_if(~F.col("ok")).alias("failed"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def props_json(spark, root):
    """M8: a field of JSON text."""
    return table(spark, root, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("SELECT offer_seq, tag FROM (SELECT offer_seq, unnest(from_json(raw -> '$.tags', '[\"VARCHAR\"]')) AS tag FROM offers)")
def json_tags(spark, root):
    """M1, M7: a list inside JSON text, one row an element."""
    return table(spark, root, "offers").select("offer_seq", F.explode(F.from_json("raw", "tags array<string>")["tags"]).alias("tag"))


@query("SELECT event_id, CAST(timezone('Europe/Prague', to_timestamp(1767225600 + event_id * 3607)) AS DATE) AS day FROM events")
def epoch_to_local_date(spark, root):
    """Calendar dates at a place."""
    return table(spark, root, "events").select("event_id", numbers.epoch_to_local_date(F.lit(1767225600) + F.col("event_id") * 3607, "Europe/Prague").alias("day"))


@query("SELECT event_id, (ts::DATE + CAST((8 - isodow(ts)) % 7 + 0 AS INTEGER))::DATE AS monday FROM events".replace("(8 - isodow(ts)) % 7 + 0", "(8 - isodow(ts)) % 7"))
def period_end(spark, root):
    """The next Monday, the day itself included."""
    return table(spark, root, "events").select("event_id", numbers.next_weekday(F.to_date("ts"), 0).alias("monday"))


@query("""SELECT o_orderkey, arg_min(d, struct_pack(far := abs(d - DATE '1997-01-20'), day := d)) AS day FROM (SELECT o_orderkey, unnest([try_strptime(printf('%04d', y) || strftime(o_orderdate, '-%m-%d'), '%Y-%m-%d')::DATE for y in [1996, 1997, 1998]]) AS d FROM orders) WHERE d IS NOT NULL GROUP BY ALL""")
def nearest_year(spark, root):
    """The year in which a day and month are nearest to a date."""
    return table(spark, root, "orders").select("o_orderkey", numbers.nearest_year(F.dayofmonth("o_orderdate"), F.month("o_orderdate"), F.lit("1997-01-20").cast("date")).alias("day"))


@query("SELECT offer_seq, try_cast(replace(regexp_extract(title, '([0-9]+(?:[.,][0-9]+)?)', 1), ',', '.') AS DOUBLE) AS first FROM offers")
def first_number(spark, root):
    """The first number of a title."""
    return table(spark, root, "offers").select("offer_seq", numbers.first_number(F.col("title")).alias("first"))


@query("SELECT source, count(*) AS n, count(DISTINCT outlet_id) AS outlets, count(czk_per_kg) AS priced, count(*) FILTER (promo) AS promo, min(observed_on) AS first, max(observed_on) AS last FROM matched_rows GROUP BY ALL")
def per_source_report(spark, root):
    """Scalars of each source in one pass."""
    return table(spark, root, "matched_rows").groupBy("source").agg(F.count("*").alias("n"), F.count_distinct("outlet_id").alias("outlets"), F.count("czk_per_kg").alias("priced"), F.count_if("promo").alias("promo"), F.min("observed_on").alias("first"), F.max("observed_on").alias("last"))


@query("SELECT user_id, event_type, count(*) AS n, max(event_id) AS latest FROM events GROUP BY ALL")
def http_log_report(spark, root):
    """Counts and the latest entry per host and status."""
    return table(spark, root, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.max("event_id").alias("latest"))


@query("SELECT event_type, n, row_number() OVER (ORDER BY n DESC, event_type) AS place FROM (SELECT event_type, count(*) AS n FROM events GROUP BY ALL)")
def reason_histogram(spark, root):
    """Counts in order of count, then key."""
    counts = table(spark, root, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    return R.numbered(counts, [F.desc("n"), F.asc("event_type")], "place").select("event_type", "n", "place")


@query("SELECT o_custkey, o_orderkey, o_totalprice, coalesce(o_totalprice - following < 10000, false) AS close FROM (SELECT *, row_number() OVER w AS k, lead(o_totalprice) OVER w AS following FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)) WHERE k = 1")
def ambiguity_margin(spark, root):
    """The best of each group and whether the second is close; nothing is ranked again (W5), and variants are none."""
    best = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    two = table(spark, root, "orders").withColumn("k", F.row_number().over(best)).where("k <= 2")
    following = two.withColumn("following", F.lead("o_totalprice").over(best))
    return following.where("k = 1").select("o_custkey", "o_orderkey", "o_totalprice", F.coalesce(F.col("o_totalprice") - F.col("following") < 10000, F.lit(False)).alias("close"))


@query("SELECT 'bad_date' AS rule, offer_seq FROM offers WHERE valid_to < valid_from UNION ALL SELECT 'no_price', offer_seq FROM offers WHERE price_czk IS NULL OR price_czk <= 0 UNION ALL SELECT 'unknown_item', offer_seq FROM offers WHERE ingredient_id IS NOT NULL AND ingredient_id NOT IN (SELECT id FROM catalogue) UNION ALL SELECT 'no_title', offer_seq FROM offers WHERE trim(coalesce(title, '')) = ''")
def validation_errors(spark, root):
    """V2: four fixed checks (no schema as in V1), one row per broken rule and row, in one pass but for membership."""
    offers = table(spark, root, "offers").select("offer_seq", "valid_from", "valid_to", "price_czk", "ingredient_id", "title")
    checks = F.array_compact(F.array(
        F.when(F.col("valid_to") < F.col("valid_from"), F.lit("bad_date")), F.when(F.col("price_czk").isNull() | (F.col("price_czk") <= 0), F.lit("no_price")), F.when(F.trim(F.coalesce("title", F.lit(""))) == "", F.lit("no_title"))))
    unknown = offers.where("ingredient_id is not null").join(table(spark, root, "catalogue"), F.col("ingredient_id") == F.col("id"), "left_anti").select(F.lit("unknown_item").alias("rule"), "offer_seq")
    return offers.select(F.explode(checks).alias("rule"), "offer_seq").unionByName(unknown)


@query("SELECT market, ingredient_id, coalesce(b.v, a.v) AS v FROM (SELECT market, ingredient_id, min(czk_per_kg) AS v FROM matched_rows WHERE NOT promo GROUP BY ALL) a FULL JOIN (SELECT market, ingredient_id, min(czk_per_kg) AS v FROM matched_rows WHERE promo GROUP BY ALL) b USING (market, ingredient_id)")
def rule_merge(spark, root):
    """New values take the place of old ones with the same key."""
    rows = table(spark, root, "matched_rows")
    old, new = (rows.where(F.col("promo") == p).groupBy("market", "ingredient_id").agg(F.min("czk_per_kg").alias("v")) for p in (False, True))
    return R.merge_rules(old, new, ["market", "ingredient_id"], "v")


@query("SELECT store, source FROM offers UNION SELECT store, source FROM matched_rows")
def union_sources(spark, root):
    """Distinct rows of two tables put together."""
    return table(spark, root, "offers").select("store", "source").unionByName(table(spark, root, "matched_rows").select("store", "source")).distinct()


@query("SELECT ingredient_id FROM (SELECT id AS ingredient_id FROM catalogue EXCEPT SELECT ingredient_id FROM build_report)")
def set_difference(spark, root):
    """Members of one set that the other has not."""
    return table(spark, root, "catalogue").select(F.col("id").alias("ingredient_id")).exceptAll(table(spark, root, "build_report").select("ingredient_id").distinct())


@query("SELECT result_id, cat_name, slug FROM (SELECT result_id, unnest(flatten(parent_categories)) AS c FROM (SELECT DISTINCT result_id, parent_categories FROM penny_results)), (SELECT 1) x".replace("SELECT result_id, cat_name, slug", "SELECT result_id, c.cat_name AS cat_name, c.slug AS slug"))
def category_names(spark, root):
    """M7: nested lists of structs, flattened."""
    return table(spark, root, "penny_results").select("result_id", "parent_categories").distinct().select("result_id", F.explode(F.flatten("parent_categories")).alias("c")).select("result_id", "c.cat_name", "c.slug")


@query("SELECT result_id, kind, amount FROM (SELECT DISTINCT result_id, 'regular' AS kind, price.regular.price_value / 100 AS amount FROM penny_results UNION ALL SELECT DISTINCT result_id, 'club', price.loyalty.price_value / 100 FROM penny_results WHERE price.loyalty.price_value < price.regular.price_value)")
def minor_unit_offers(spark, root):
    """One or two rows of a product, from minor units."""
    regular, club = F.col("price.regular.price_value"), F.col("price.loyalty.price_value")
    both = F.array_compact(F.array(F.struct(F.lit("regular").alias("kind"), (regular / 100).alias("amount")), F.when(club < regular, F.struct(F.lit("club").alias("kind"), (club / 100).alias("amount")))))
    return table(spark, root, "penny_results").select("result_id", F.explode(both).alias("o")).select("result_id", "o.kind", "o.amount").distinct()


@query("SELECT offer_seq, market, lower(trim(store)) AS store, coalesce(nullif(trim(unit), ''), 'none') AS unit, coalesce(is_promo, original_price_czk > price_czk, false) AS promo, round(price_czk / CASE market WHEN 'cz' THEN 1 WHEN 'pl' THEN 0.17 ELSE 0.041 END, 6) AS price_home FROM offers")
def offer_projection(spark, root):
    """Fields brought to one form; the first that is present wins; prices in one currency."""
    return table(spark, root, "offers").select(
        "offer_seq", "market", F.lower(F.trim("store")).alias("store"), F.coalesce(F.nullif(F.trim("unit"), F.lit("")), F.lit("none")).alias("unit"),
        F.coalesce("is_promo", F.col("original_price_czk") > F.col("price_czk"), F.lit(False)).alias("promo"), F.round(F.col("price_czk") / fx(F.col("market")), 6).alias("price_home"))


@query("SELECT offer_seq, regexp_extract(source_url, '^https?://([^/]+)', 1) AS host, regexp_extract(source_url, '/o/([0-9]+)/', 1) AS outlet, regexp_extract(source_url, '([^/]+)$', 1) AS slug FROM offers")
def page_fields(spark, root):
    """Parts of addresses (no embedded JSON as in S11, no dates in slugs as in S12)."""
    parts = {"host": r"^https?://([^/]+)", "outlet": r"/o/([0-9]+)/", "slug": r"([^/]+)$"}
    return table(spark, root, "offers").select("offer_seq", *[F.regexp_extract("source_url", p, 1).alias(n) for n, p in parts.items()])


@query("""SELECT offer_seq, CASE WHEN regexp_matches(lower(title), '(akce|promocja|akcia|aktion)') THEN 'word' WHEN is_promo THEN 'flag' WHEN original_price_czk > price_czk THEN 'price' WHEN coalesce(CAST(raw -> '$.discountPercentage' AS VARCHAR), 'null') <> 'null' THEN 'discount' ELSE 'none' END AS why FROM offers""")
def promo_flag(spark, root):
    """the first of ordered signs that a row shows."""
    discount = F.get_json_object("raw", "$.discountPercentage")
    return table(spark, root, "offers").select("offer_seq", F.when(F.lower("title").rlike("(akce|promocja|akcia|aktion)"), "word").when(F.col("is_promo"), "flag")
        .when(F.col("original_price_czk") > F.col("price_czk"), "price").when(discount.isNotNull(), "discount").otherwise("none").alias("why"))


_SEARCH = {"syr": "syr", "eid": "eid"}
_SCORE = " + ".join(f"CASE WHEN list_contains(parts, '{q}') THEN 3.0 WHEN len(list_filter(parts, lambda x: starts_with(x, '{q}'))) > 0 THEN 1.5 ELSE 0 END" for q in _SEARCH)
_ALL = " AND ".join(f"len(list_filter(parts, lambda x: starts_with(x, '{q}'))) > 0" for q in _SEARCH)


@query(f"""SELECT id, round(score, 6) AS score FROM (SELECT id, {_SCORE} + CASE WHEN {_ALL} THEN 2 ELSE 0 END + CASE WHEN list_contains(names, 'syr eid') THEN 5 WHEN len(list_filter(names, lambda x: starts_with(x, 'syr eid'))) > 0 THEN 1 ELSE 0 END - 0.02 * len(parts) AS score
FROM (SELECT id, list_distinct(flatten(list_transform(names, lambda x: string_split(x, ' ')))) AS parts, names FROM (SELECT id, list_filter([{_fold_sql('id')}, {_fold_sql('name_cs')}], lambda x: x IS NOT NULL) || list_transform(coalesce(aliases, []), lambda a: {_fold_sql('a')}) AS names FROM catalogue))) WHERE score > 0 ORDER BY score DESC, id LIMIT 10""")
def catalogue_search(spark, root):
    """The ten best entries for a search (the limit is the feature): 3 a whole word, 1.5 a beginning, 2 more if all words are
    there, 5 more if a name is the search, 1 if one begins with it, 0.02 less a word."""
    names = F.concat(F.array_compact(F.array(text.fold(F.col("id")), text.fold(F.col("name_cs")))), F.transform(F.coalesce("aliases", F.array().cast("array<string>")), text.fold))
    entries = table(spark, root, "catalogue").withColumn("names", names).withColumn("parts", F.array_distinct(F.flatten(F.transform("names", lambda n: F.split(n, " ")))))
    return R.search(entries, "syr eid", "names", "parts").select("id", F.round("score", 6).alias("score")).where("score > 0").orderBy(F.desc("score"), "id").limit(10)


@query("SELECT user_id, n, round(taste, 4) AS taste, place FROM (SELECT *, row_number() OVER (ORDER BY taste DESC, n DESC, user_id) AS place FROM (SELECT user_id, count(*) AS n, CAST(avg(CAST(least(greatest(value, 0), 5) AS DECIMAL(20, 6))) AS DOUBLE) AS taste FROM events GROUP BY ALL HAVING count(value) >= 5))")
def ratings_rank(spark, root):
    """Clamped means of users with enough rows, ranked."""
    clamped = F.least(F.greatest("value", F.lit(0.0)), F.lit(5.0)).cast("decimal(20,6)")
    means = table(spark, root, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.count("value").alias("k"), F.avg(clamped).cast("double").alias("mean")).where("k >= 5")
    return R.numbered(means, [F.desc("mean"), F.desc("n"), F.asc("user_id")], "place").select("user_id", "n", F.round("mean", 4).alias("taste"), "place")


@query("SELECT l_partkey, min(per) AS low, median(per) AS mid FROM (SELECT l_partkey, l_suppkey, coalesce(min(CASE WHEN l_discount > 0.05 THEN l_extendedprice / l_quantity END), min(l_extendedprice / l_quantity)) AS per FROM lineitem GROUP BY ALL) GROUP BY ALL")
def effective_price(spark, root):
    """A deal overrides the regular value of a pair; least and median over a key's pairs."""
    each = F.col("l_extendedprice") / F.col("l_quantity")
    pairs = table(spark, root, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.coalesce(F.min(F.when(F.col("l_discount") > 0.05, each)), F.min(each)).alias("per"))
    return pairs.groupBy("l_partkey").agg(F.min("per").alias("low"), F.median("per").alias("mid"))


def _leaflet_pages(spark, root):
    return table(spark, root, "documents").where("doc_type = 'leaflet_page'").select("doc_id", "text")


def leaflet_parse(spark, root):
    """The products of leaflet pages with their packs and prices, read in order of lines."""
    from pricelode.operators.leaflets import parse_products

    return parse_products(_leaflet_pages(spark, root), "doc_id", F.col("text"))


def leaflet_lines(spark, root):
    """Attribute and price lines of leaflet pages under their running titles."""
    from pricelode.operators.leaflets import parse_pages

    return parse_pages(_leaflet_pages(spark, root), "doc_id", F.col("text"))


QUERIES |= {f.__name__: f for f in (leaflet_parse, leaflet_lines)}
