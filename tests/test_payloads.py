import datetime as dt
import json

from pyspark.sql import functions as F

from pricelode.functions import dates, prices, text
from pricelode.operators import reports, validation
from pricelode.sources import payloads

DAY = dt.date


def _one(spark, value, expression):
    return spark.createDataFrame([(value,)], "v string").select(expression(F.col("v")).alias("x")).first().x


def test_unit_prices_and_packs(spark):
    per_kg = {
        "1 kg = 174,75 Kč": 174.75, "100 g = 0,16": 1.6, "1 L = 13,32": 13.32, "Je 250 g (1 kg = 13.96)": 13.96, "2,49/100 g": 24.9, "1 Stk. = 0.22": 4.0, "15,96 Kč / 100 g": 159.6,
        "125/150 g": None, "5 x 50 g = 250 g": None, "* cena przed obniżką: 1 kg = 14,99": None, "0,33 €/l": 0.33, "": None,
    }
    packs = {
        "Je 250 g (1 kg = 13.96)": (250, "g"), "125/150 g": (125, "g"), "2 x 1 L": (2, "l"), "5 x 50 cl": (2500, "ml"), "cena za kg": (1, "kg"), "Bei 3 Stk. je Stück": (1, "ks"), "kus": (1, "ks"), "3 szt.": (3, "ks"),
        "6 ks, 300 g": (300, "g"), "500 g balenie * 1 kg = 2": (500, "g"), "1 kg = 2,64": None, "nic": None,
    }
    rows = {r.t: r for r in spark.createDataFrame([(t,) for t in {**per_kg, **packs}], "t string").select("t", prices.unit_price_per_kg(F.col("t"), F.lit("vejce M")).alias("k"), prices.pack_size(F.col("t")).alias("p")).collect()}
    assert all((rows[t].k is None) if v is None else abs(rows[t].k - v) < 1e-9 for t, v in per_kg.items())
    assert {t: rows[t].p and tuple(rows[t].p) for t in packs} == packs
    basis = _one(spark, "Cena za 100 g", prices.price_basis)
    assert (basis.amount, basis.unit) == (0.1, "kg")


def test_dates(spark):
    today = F.lit("2026-12-30").cast("date")
    said = {"dnes": ("2026-12-30", "2026-12-30"), "zítra končí": ("2026-12-30", "2026-12-31"), "od 28. 12. do 3.1.": ("2026-12-28", "2027-01-03"), "do 5. 1.": ("2026-12-30", "2027-01-05"), "aktuální leták": ("2026-12-30", "2027-01-03"), "kdykoli": (None, None)}
    for t, wanted in said.items():
        got = _one(spark, t, lambda c: dates.validity(c, today, F.lit("2027-01-03").cast("date")))
        assert tuple(str(x) if x else None for x in got) == wanted, t
    assert _one(spark, "x 31.12.2026", dates.dotted_day) == DAY(2026, 12, 31) and _one(spark, "31.2.2026", dates.dotted_day) is None
    assert _one(spark, "2026-02-30T10", dates.iso_day) is None and _one(spark, "2026-02-30T10", dates.iso_prefix) == "2026-02-30" and _one(spark, None, dates.iso_day) is None
    page = spark.createDataFrame([(1, r"a velky-letak-30-12-5-1-2027 b/maly-letak-1-1-2-1-2027 velky-letak-30-12-5-1-2027 velky-letak-31-2-1-3-2027"), (2, None)], "k int, html string")
    found = payloads.page_leaflets(page, ["k"], F.col("html"))
    assert [(r.slug[:5], str(r.valid_from), str(r.valid_to)) for r in payloads.current_leaflets(found, today, "velky").collect()] == [("velky", "2026-12-30", "2027-01-05"), ("maly-", "2027-01-01", "2027-01-02")]


def test_names_and_rules(spark):
    names = ["lidl", "coopJednota", "aldiNord"]
    got = {v: _one(spark, v, lambda c: text.known_name(c, names, {"hofer": "aldiNord"})) for v in ("Lidl", "coopJednota", "COOP Jednota", "Hofer", "Aldi Nord Markt", "Lidlík", "x", "", None)}
    assert got == {"Lidl": "lidl", "coopJednota": "coopJednota", "COOP Jednota": "coopJednota", "Hofer": "aldiNord", "Aldi Nord Markt": "aldiNord", "Lidlík": "lidl", "x": None, "": None, None: None}
    patterns = {"re:a.c": "(?i)a.c", "/x$/": "(?i)x$", "sub:Má.s": "ma s", "Bio sýr": "(?<![a-z0-9])bio syr(?![a-z0-9])", " ": None, None: None}
    assert {p: _one(spark, p, text.rule_regex) for p in patterns} == patterns
    rows = spark.createDataFrame([(0, None, "Failed to fetch"), (200, "42P01", None), (429, None, None), (503, None, ""), (None, None, None)], "s int, c string, m string")
    assert [r.k for r in rows.select(text.error_kind(F.col("c"), F.col("s"), F.col("m")).alias("k")).collect()] == ["network", "missing", "rate", "server", "other"]


def test_product_payloads(spark):
    house = {"actualPrice": 20.0, "originalPrice": 25.0, "priceValidFrom": "2026-09-08T00:00", "priceValidTo": "9999-12-31", "baseComparisonPrice": 8.0, "baseComparisonSaleUnitSizeText": "100 g"}
    rows = [{"name": " Máslo ", "sellUnitSizeText": "250 g", "productInHouse": {**house, "bonusProgramPrice": {"actualPrice": 18.0, "priceValidTo": "2026-09-20"}}}, {"name": "Chléb", "unitId": "kus", "productInHouse": {"actualPrice": 30.0, "bonusProgramPrice": {"actualPrice": 40.0}}}, {"name": "", "productInHouse": house}, {"name": "x"}]
    frame = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(rows)] + [(9, None), (10, "no json")], "k int, body string")
    got = [(r.k, r.variant, r.title, r.price, r.original, r.club, r.promo, r.unit, r.amount, r.per_kg, r.valid_from, r.valid_to) for r in payloads.product_offers(frame, ["k"], F.from_json("body", payloads.PRODUCT)).orderBy("k", "variant").collect()]
    assert got == [
        (0, 0, "Máslo", 20.0, 25.0, False, True, "g", 250.0, 80.0, DAY(2026, 9, 8), None), (0, 1, "Máslo", 18.0, 20.0, True, True, "g", 250.0, None, DAY(2026, 9, 8), DAY(2026, 9, 20)),
        (1, 0, "Chléb", 30.0, None, False, False, "ks", 1.0, None, None, None)]


def test_grid_items(spark):
    epoch = lambda d: int(dt.datetime(2026, 9, d, 10).timestamp())
    data = {"fullTitle": "Gouda", "price": {"price": 2.0, "oldPrice": 3.0, "basePrice": {"text": "Je 250 g (1 kg = 8.00)"}}, "stockAvailability": {"badgeInfoV2": [
        {"validFrom": epoch(20), "validUntil": epoch(25), "badges": [{"type": "IN_STORE_FROM_FUTURE_DATE_RANGE"}]}, {"validFrom": epoch(8), "validUntil": epoch(14), "badges": [{"type": "IN_STORE_TODAY_DATE_RANGE"}]}, {"validFrom": epoch(1), "badges": [{"type": "ONLINE"}]}]}}
    items = [{"code": "1", "gridbox": {"data": data}}, {"code": "2", "gridbox": {"data": {"keyfacts": {"title": "Voda"}, "price": {"price": 1.0}}}}, {"code": "3", "gridbox": {"data": {"fullTitle": "x"}}}, {"code": "4"}]
    frame = spark.createDataFrame([(json.dumps(i),) for i in items], "body string").withColumn("item", F.from_json("body", payloads.ITEM)).withColumn("code", F.col("item.code"))
    got = [(r.code, r.title, r.original, r.promo, r.unit, r.amount, r.per_kg, r.valid_from, r.valid_to) for r in payloads.item_offers(frame, ["code"], F.col("item"), F.lit("2026-09-10").cast("date")).orderBy("code").collect()]
    assert got == [("1", "Gouda", 3.0, True, "g", 250.0, 8.0, DAY(2026, 9, 8), DAY(2026, 9, 14)), ("2", "Voda", None, False, None, None, None, None, None)]


def test_trees(spark):
    nodes = spark.createDataFrame([("p", "a", None, True, 0), ("p", "b", "a", True, 1), ("p", "c", "b", False, 2), ("p", "d", "b", False, 3), ("p", "e", "a", False, 4)], "page string, node string, parent string, selected boolean, place int")
    assert {r.node for r in payloads.facet_children(nodes).collect()} == {"c", "d"}
    pages = spark.createDataFrame([("/", 10, 2, [("/x", "Maso"), ("/g", "Zahrada a hobby"), ("/y", "Sýry")]), ("/x", 5, 5, [("/x/1", "n")]), ("/y", 5, 1, [("/x", "Maso"), ("/y/1", "Gouda"), (None, "?")]), ("/g", 9, 1, [("/g/1", "n")])], "path string, found int, listed int, children array<struct<path:string,label:string>>")
    assert {(r.path, r.depth) for r in payloads.tree_walk(spark, pages, "/", ["zahrad"]).collect()} == {("/", 0), ("/x", 1), ("/y", 1), ("/y/1", 2)}


def test_leaflets_and_flyers(spark):
    state = {"props": {"pageProps": {"apolloState": {"Leaflet:1": {"id": "1", "title": "t", "validityStartDateFormatted": "9.9.2026", "validityEndDateFormatted": "15.9.2026", "viewUrl": "u", "locationType": "HYPERMARKET", "documentType": "LEAFLET"}, "Other:2": {"id": "2"}, "Leaflet:3": "x"}}}}
    frame = spark.createDataFrame([(1, f'<script id="__NEXT_DATA__" type="j">{json.dumps(state)}</script>'), (2, "<p>"), (3, None)], "k int, html string")
    assert [tuple(r) for r in payloads.leaflet_entries(frame, ["k"], F.col("html")).collect()] == [(1, "1", "t", DAY(2026, 9, 9), DAY(2026, 9, 15), "u", "HYPERMARKET", "LEAFLET")]
    overview = {"categories": [{"subcategories": [{"name": "s", "flyers": [{"name": "n", "offerStartDate": "2026-09-09T00", "pdfUrl": "p"}]}, {"name": "empty"}]}, {}]}
    flyer = payloads.flyers(spark.createDataFrame([(1, json.dumps(overview))], "k int, o string"), ["k"], F.col("o")).collect()
    assert [tuple(r) for r in flyer] == [(1, "s", "n", None, "2026-09-09", None, None, "p")]
    spreads = json.dumps([{"pages": [{"text": "a"}, {"text": "b"}]}, {"pages": []}, {"pages": [{"text": None}]}])
    assert [tuple(r) for r in payloads.spread_pages(spark.createDataFrame([(1, spreads)], "k int, s string"), ["k"], F.col("s")).collect()] == [(1, 0, 0, "a"), (1, 0, 1, "b"), (1, 2, 0, None)]


def test_search_pages(spark):
    row = lambda i, shop, price, shown: f'<div class="discount_row x" data-discount="{i}" data-shop="{shop}"><a class="btn_list_add" data-price="{price}"></a><strong class="discount_price_value">{shown}</strong><div class="discount_amount">/ 200 g</div><span class="price_per_unit">15,96 Kč / 100 g</span><div class="discounts_validity">do 5.&nbsp;1.</div><br></div>'
    page = f'<html><div class="group_discounts"><div class="product--wrap" data-product-id="7"><div class="product_name"><h2><strong>Máslo &amp;  sůl</strong><span class="nowrap"><span>250 g</span></span></h2></div><div class="avg_price"><span>49,90 Kč</span></div>{row(1, "s1", "39.9", "")}{row(1, "s1", "1", "")}{row(2, "s2", "", "29,90 Kč")}{row(3, "?", "1", "")}</div></div><p class="discount_row">'
    frame = spark.createDataFrame([(1, page), (2, None), (3, "")], "k int, html string")
    today = F.lit("2026-12-30").cast("date")
    got = [(r.k, r.discount_id, r.product_id, r.store, r.title, r.price, r.original, r.unit, r.amount, round(r.per_kg, 4), r.valid_to) for r in payloads.search_rows(frame, "k", "html", {"s1": "lidl", "s2": "billa"}, today, today).orderBy("discount_id").collect()]
    assert got == [(1, "1", "7", "lidl", "Máslo & sůl", 39.9, 49.9, "g", 200.0, 159.6, DAY(2027, 1, 5)), (1, "2", "7", "billa", "Máslo & sůl", 29.9, 49.9, "g", 200.0, 159.6, DAY(2027, 1, 5))]


def test_catalogue_files(spark, tmp_path):
    path = tmp_path / "c.json"
    path.write_text('﻿{"rules": [{"pattern": "a"}]}', encoding="utf-8")
    schema = "rules array<struct<pattern:string>>"
    assert payloads.document(spark, str(path), schema).count() == 1 and payloads.document(spark, str(tmp_path / "none"), schema).count() == 0
    assert payloads.document(spark, str(tmp_path / "none"), schema, '{"rules": []}').count() == 1
    entries = spark.createDataFrame([("a", 1, 0), ("a", 2, 1), ("", 3, 2), (None, 4, 3)], "id string, v int, n int")
    assert [(r.id, r.v) for r in payloads.last_by_id(entries, "id", "n").collect()] == [("a", 2)]
    terms = spark.createDataFrame([("a", ["y", "x"]), ("a", ["x"]), ("b", None)], "id string, neg array<string>")
    assert {r.id: r.negatives for r in payloads.with_negatives(spark.createDataFrame([("a",), ("b",), ("c",)], "id string"), terms).collect()} == {"a": ["x", "y"], "b": [], "c": []}
    rules = spark.createDataFrame([(1, "p", "t", None, None), (2, "p", "t", "lidl", "SK"), (3, "", "t", None, "*"), (4, "p", "t", None, "*")], "ordinal int, pattern string, target string, store string, market string")
    assert [(r.ordinal, r.store) for r in payloads.market_rules(rules, "sk", "cz").orderBy("ordinal").collect()] == [(2, "lidl"), (4, "*")]


def test_robots(spark):
    robots = "User-agent: *\nDisallow: /a\nAllow: /a/b$\nDisallow: *page=*\n\nUser-agent: mybot\nUser-agent: other\nCrawl-delay: 1\nDisallow: /x # c\nAllow: /x\n"
    rules = spark.createDataFrame([(robots,)], "t string").select(payloads.robot_rules(F.col("t")).alias("r"))
    ask = lambda agent, path: rules.select(payloads.robot_allows(F.col("r"), F.lit(path), agent).alias("x")).first().x
    assert [ask("any/1", p) for p in ("/a", "/a/b", "/a/bc", "/q?page=2", "/z")] == [False, True, False, False, True]
    assert [ask("MyBot/2.0", p) for p in ("/x", "/a")] == [True, True]


def test_schema_errors(spark):
    schema = {
        "type": "object", "required": ["a"], "minProperties": 1, "propertyNames": {"maxLength": 3}, "additionalProperties": {"$ref": "#/$defs/n"}, "$defs": {"n": {"type": "number", "exclusiveMinimum": 0}},
        "properties": {"a": {"type": ["string", "null"], "pattern": "^x", "minLength": 2}, "l": {"type": "array", "minItems": 1, "items": {"enum": [1, "b", None, True]}}, "c": {"const": 2}},
    }
    cases = {
        '{"a": "xy", "n": 1.5, "l": [1, "b", null, true, 1.0], "c": 2.0}': [], '{"a": null}': [], "[]": ["$: expected object"], "{}": ["$: a is missing", "$: fewer properties than 1"], '{"a": 1}': ["$.a: expected string or null"],
        '{"a": "y"}': ["$.a: does not match ^x", "$.a: shorter than 2"], '{"a": "xx", "q": 0, "long": "t"}': ["$.long (name): longer than 3", "$.long: expected number", "$.q: not above 0"],
        '{"a": "xx", "l": []}': ["$.l: fewer items than 1"], '{"a": "xx", "l": [2, false, "b"], "c": true}': ["$.c: expected 2", "$.l[0]: not one of the allowed values", "$.l[1]: not one of the allowed values"], "no": ["$: no JSON"],
    }
    frame = spark.createDataFrame([(t,) for t in cases], "t string")
    got = {r.t: sorted(r.errors) for r in validation.versioned_errors(frame, "t", {1: schema, 2: {"type": "string"}}, 1).collect()}
    assert got == {t: sorted(e) for t, e in cases.items()}
    two = validation.versioned_errors(spark.createDataFrame([('{"v": 2}',)], "t string"), "t", {1: schema, 2: {"properties": {"w": True, "v": False}}}, 1).first()
    assert two.errors == ["$.v: not allowed"]


def test_reports(spark):
    states = ['{"sources": {"A": {"ok": false, "error": "e"}, "b": "down"}}', '{"providers": [{"name": "C", "items": 3}, {"x": 1}, 5]}', '[{"id": "d"}]', '{"e": {"ok": true}}', "no", None]
    got = {(r.k, r.source, r.ok, r.items, r.error) for r in reports.fetch_states(spark.createDataFrame(list(enumerate(states)), "k int, document string"), ["k"], "document").collect()}
    assert got == {(0, "a", False, None, "e"), (0, "b", None, None, "down"), (1, "c", None, 3, None), (2, "d", None, None, None), (3, "e", True, None, None)}
    fetched = spark.createDataFrame([("k", True, 1, 9, None), ("m", None, 2, 9, None)], "source string, ok boolean, items int, requests int, error string")
    counts = spark.createDataFrame([("k-text", 4), ("z", 0)], "source string, n int")
    rows = {(r.source, r.ok, r.offers, r.matched) for r in reports.source_report(fetched, counts, counts.where("n > 0")).collect()}
    assert rows == {("k-text", True, 4, 4), ("m", True, 2, None), ("z", False, 0, None)}
    day, schema = F.lit("2026-08-22").cast("date"), "item string, store string, value double"
    today = spark.createDataFrame([("a", "s", 1.0)], schema)
    before = spark.createDataFrame([("a", "s", 2.0), ("b", "s", 3.0), ("c", "t", 4.0), ("d", "t", 5.0)], schema)
    seen = spark.createDataFrame([("b", "s", DAY(2026, 8, 1)), ("c", "t", DAY(2026, 7, 31))], "item string, store string, last_seen date")
    carried = {(r.item, r.value, r.age, r.state, r.reason) for r in reports.carried_prices(today, before, seen, today.select("store"), day, 21).collect()}
    assert carried == {("a", 1.0, 0, "fresh", None), ("b", 3.0, 21, "carried", "not_matched_today"), ("c", 4.0, 22, "dropped", "store_missing"), ("d", 5.0, 0, "carried", "store_missing")}
    deal = "item string, store string, value double, valid_to date, title string"
    end = DAY(2026, 8, 30)
    new = spark.createDataFrame([("a", "s", 5.04, end, "X "), ("a", "s", 5.01, end, "x"), ("a", "s", 1.0, end, "y"), ("a", "s", 2.0, end, "z"), ("a", "s", 9.0, end, "w")], deal)
    old = spark.createDataFrame([("a", "t", 3.0, end, "k"), ("a", "t", 3.0, DAY(2026, 8, 1), "gone"), ("a", "s", 0.5, end, "s has rows")], deal)
    assert {(r.store, r.value, r.title) for r in reports.carried_deals(new, old, today.select("store"), day).collect()} == {("s", 1.0, "y"), ("s", 2.0, "z"), ("s", 5.0, "X "), ("t", 3.0, "k")}
    shown, more = reports.capped(new, [F.asc("value"), F.asc("title")], 2)
    assert shown.count() == 2 and new.select(more.alias("m")).first().m == 3
    sources = spark.createDataFrame([("a", False, 3), ("b", True, 0)], "source string, ok boolean, offers int")
    assert {tuple(r) for r in reports.warnings(sources, spark.createDataFrame([("i", 2)], "item string, dropped int"), F.col("dropped"), least_items=5).collect()} == {("failed", "a"), ("empty", "b"), ("few_items", "1"), ("dropped", "2")}
    status = spark.createDataFrame([(1, 1), (0, 2), (0, 0), (None, None)], "e int, w int").select(validation.report_status(F.col("e"), F.col("w")).alias("s"))
    assert [r.s for r in status.collect()] == ["error", "warning", "ok", "ok"]
    bad = validation.quarantined(new, {"cheap": F.col("value") < 2, "long": F.length("title") > 1})
    assert {(r.title, r.quarantine) for r in bad.collect()} == {("X ", "long"), ("x", None), ("y", "cheap"), ("z", None), ("w", None)}
    times = spark.createDataFrame([(1, dt.datetime(2026, 8, 20)), (2, dt.datetime(2026, 8, 10))], "k int, at timestamp_ntz")
    assert [r.k for r in reports.younger_than(times, "at", F.lit("2026-08-21").cast("timestamp_ntz"), 7).collect()] == [1] == [r.k for r in reports.latest(times, [], "at", 1).collect()]
    numbers = spark.createDataFrame([(prices_row,) for prices_row in (1.0,)], "v double").select(prices.close(F.col("v"), F.lit(1.05)).alias("a"), prices.close(F.col("v"), F.lit(1.07)).alias("b"), prices.close(F.lit(None), F.lit(1.0)).alias("c")).first()
    assert tuple(numbers) == (True, False, False)


def test_leaflet_offers(spark):
    from pricelode.operators.leaflets import PRODUCT_SCHEMA, leaflet_offers, spread_offers

    base = {"product_no": 1, "title": "Máslo", "pack_quantity": 250.0, "pack_unit": "g", "price": 50.0}
    cases = {
        1: {**base, "per_kg": 200.0}, 2: {**base, "per_kg": 240.0, "per_kg_club": 200.0}, 3: {**base, "old_price": 100.0, "discount_pct": 50}, 4: base, 5: {**base, "per_kg": 4.0, "price": 1.0}, 6: {"product_no": 1, "title": "Chléb", "per_kg": 30.0},
        7: {"product_no": 1, "title": "Bez ceny"}, 8: {**base, "price_club": 40.0}, 9: {**base, "price_club": 60.0}, 10: {**base, "title": "abc"},
    }
    names = [p.split()[0] for p in PRODUCT_SCHEMA.split(", ")]
    frame = spark.createDataFrame([(k, *[c.get(n) for n in names]) for k, c in cases.items()], f"k int, {PRODUCT_SCHEMA}")
    got = {(r.k, r.variant): (r.price, r.per_kg, r.unit, r.amount, r.confidence) for r in leaflet_offers(frame, ["k"]).collect()}
    assert got == {
        (1, 0): (50.0, 200.0, "g", 250.0, "high"), (2, 0): (60.0, 240.0, "g", 250.0, "medium"), (2, 1): (50.0, 200.0, "g", 250.0, "medium"), (3, 0): (50.0, 200.0, "g", 250.0, "medium"), (4, 0): (50.0, 200.0, "g", 250.0, "low"),
        (6, 0): (30.0, 30.0, "kg", 1.0, "low"), (8, 0): (50.0, 200.0, "g", 250.0, "low"), (8, 1): (40.0, 160.0, "g", 250.0, "low"), (9, 0): (50.0, 200.0, "g", 250.0, "low"),
    }
    spreads = json.dumps([{"pages": [{"text": "Čerstvé máslo\n250 g\n49,90 Kč"}]}])
    offers = spread_offers(spark.createDataFrame([(1, spreads), (2, None)], "id int, s string"), ["id"], F.col("s")).collect()
    assert [(r.id, r.spread, r.page, r.title, r.price, r.amount) for r in offers] == [(1, 0, 0, "Čerstvé máslo", 49.9, 250.0)]


def test_documents_are_written_whole(spark, tmp_path):
    from pricelode.sources.sinks import write_document, write_with_health

    path = tmp_path / "d.json"
    for text_ in ('{"a": 1}', '{"a": "č"}'):
        write_document(spark.createDataFrame([(text_,)], "t string"), str(path))
        assert path.read_bytes() == f"{text_}\n".encode()
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["d.json"]
    rows = spark.createDataFrame([("cz", "a", 1), ("cz", "a", 2), ("sk", "b", 3)], "market string, source string, v int")
    assert {tuple(r) for r in write_with_health(rows, str(tmp_path / "t"), "market", "source").select("market", "source", "n", "ok").collect()} == {("cz", "a", 2, True), ("sk", "b", 1, True)}
