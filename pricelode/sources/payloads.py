"""Offers out of stored payloads of sources: product lists, grid items, leaflets, search pages, category trees and rule files.

Payloads are text columns or rows read with a given schema (never inferred); what fetched them is not part of this package. Money
stays in the payload's own unit unless stated; every function is built of native expressions but search_rows, which needs an HTML parser.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricelode.functions import dates, prices, text

OFFER = "title string, price double, original double, club boolean, promo boolean, unit string, amount double, per_kg double, valid_from date, valid_to date"
_OFFER_NAMES = [part.split()[0] for part in OFFER.split(", ")]

#: A day that stands for "no end".
PERMANENT = "9999-12-31"


def document(spark: SparkSession, path: str, schema: str, default: str | None = None) -> DataFrame:
    """One row per JSON document of a file or folder, read with a schema; a byte order mark is allowed. If nothing is there, the `default` text's row, or no row."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target):
        raw = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", "^\ufeff", "").alias("text"))
    else:
        raw = spark.createDataFrame([] if default is None else [(default,)], "text string")
    return raw.select(F.from_json("text", schema).alias("d")).where("d is not null").select("d.*")


def _offer(**parts: Column) -> Column:
    """An OFFER struct; what is not given is null or false."""
    types = dict(p.split() for p in OFFER.split(", "))
    return F.struct(*[parts.get(n, F.lit(False) if types[n] == "boolean" else F.lit(None)).cast(types[n]).alias(n) for n in _OFFER_NAMES])


def _rows(frame: DataFrame, keys: list[str], offers: Column) -> DataFrame:
    return frame.select(*keys, F.posexplode(F.array_compact(offers)).alias("variant", "_o")).select(*keys, "variant", "_o.*")


PRODUCT = (
    "struct<name:string,regulatedName:string,sellUnitSizeText:string,unitId:string,unitAmount:double,productInHouse:struct<actualPrice:double,originalPrice:double,priceValidFrom:string,priceValidTo:string,"
    "baseComparisonPrice:double,baseComparisonSaleUnitSizeText:string,bonusProgramPrice:struct<actualPrice:double,originalPrice:double,priceValidFrom:string,priceValidTo:string,baseComparisonPrice:double,baseComparisonSaleUnitSizeText:string>>>"
)


def product_offers(frame: DataFrame, keys: list[str], product: Column) -> DataFrame:
    """The keys, variant (0 plain, 1 club) and OFFER of each PRODUCT with a title and a price; the club offer only where it is cheaper.

    The pack is told by its text, else by unit and amount; PERMANENT is no end; an original price makes it a promotion.
    """
    p, house = F.col("_p"), F.col("_p.productInHouse")
    given = frame.withColumn("_p", product).withColumn("_title", F.trim(F.coalesce(F.nullif(F.trim("_p.name"), F.lit("")), "_p.regulatedName")))
    packed = given.withColumn("_pack", F.coalesce(prices.pack_size(p["sellUnitSizeText"]), F.when(p["unitId"].isNotNull(), F.struct(F.coalesce(p["unitAmount"], F.lit(1.0)).alias("amount"), prices.unit_name(p["unitId"]).alias("unit")))))
    end = lambda c: F.nullif(dates.iso_day(F.when(dates.iso_prefix(c) != PERMANENT, c)), F.lit(None).cast("date"))
    per = lambda block: prices.per_kg(block["baseComparisonPrice"], prices.pack_size(block["baseComparisonSaleUnitSizeText"]), F.col("_title"))
    common = {"title": F.col("_title"), "unit": F.col("_pack.unit"), "amount": F.col("_pack.amount")}
    bonus = house["bonusProgramPrice"]
    plain = F.when((F.col("_title") != "") & house["actualPrice"].isNotNull(), _offer(
        **common, price=house["actualPrice"], original=house["originalPrice"], promo=house["originalPrice"].isNotNull(), per_kg=per(house),
        valid_from=dates.iso_day(house["priceValidFrom"]), valid_to=end(house["priceValidTo"])))
    club = F.when(plain.isNotNull() & (bonus["actualPrice"] < house["actualPrice"]), _offer(
        **common, price=bonus["actualPrice"], original=F.coalesce(bonus["originalPrice"], house["actualPrice"]), promo=F.lit(True), club=F.lit(True), per_kg=per(bonus),
        valid_from=F.coalesce(dates.iso_day(bonus["priceValidFrom"]), dates.iso_day(house["priceValidFrom"])),
        valid_to=F.when(dates.iso_prefix(bonus["priceValidTo"]) == PERMANENT, None).otherwise(F.coalesce(dates.iso_day(bonus["priceValidTo"]), end(house["priceValidTo"])))))
    return _rows(packed, keys, F.array(plain, club))


def minor_unit_offers(frame: DataFrame, key: str, first: Column) -> DataFrame:
    """The key, variant and OFFER of results with money in hundredths (name, amount, label and price as in penny_results); one per key, by the least `first`.

    The price per kilogram is per_standardized_quantity for base_price_factor (1 where it is no number) units.
    """
    once = frame.withColumn("_k", F.row_number().over(Window.partitionBy(key).orderBy(first))).where("_k = 1")
    unit = prices.unit_name(F.col("volume_label_short"))
    factor = F.coalesce(F.col("price.base_price_factor").try_cast("double"), F.lit(1.0))
    per = lambda block: prices.per_kg(block["per_standardized_quantity"] / 100, F.struct(factor.alias("amount"), prices.unit_name(F.col("price.base_unit_short")).alias("unit")), F.col("product_name"))
    money = lambda c: F.round(c / 100, 2)
    common = {
        "title": F.trim("product_name"), "unit": unit, "amount": F.when(unit.isNotNull(), F.translate("amount", ",", ".").try_cast("double")), "promo": F.lit(True),
        "valid_from": dates.iso_day(F.col("price.validity_start")), "valid_to": dates.iso_day(F.col("price.validity_end")),
    }
    regular, loyalty = F.col("price.regular"), F.col("price.loyalty")
    plain = F.when((F.trim("product_name") != "") & regular["price_value"].isNotNull(), _offer(**common, price=money(regular["price_value"]), original=money(F.col("price.crossed")), per_kg=per(regular)))
    club = F.when(plain.isNotNull() & (loyalty["price_value"] < regular["price_value"]), _offer(**common, price=money(loyalty["price_value"]), original=money(regular["price_value"]), club=F.lit(True), per_kg=per(loyalty)))
    return _rows(once, [key], F.array(plain, club))


ITEM = (
    "struct<code:string,gridbox:struct<data:struct<fullTitle:string,keyfacts:struct<title:string>,price:struct<price:double,oldPrice:double,basePrice:struct<text:string>,packaging:struct<text:string>,"
    "discount:struct<discountText:string>>,stockAvailability:struct<badgeInfoV2:array<struct<validFrom:bigint,validUntil:bigint,badges:array<struct<type:string>>>>>>>>"
)
# Badges whose times are those of an offer in the shop.
DATED = ["IN_STORE_PAST_DATE_RANGE", "IN_STORE_FROM_FUTURE_DATE_RANGE", "IN_STORE_FROM_DATE_PAST", "IN_STORE_TODAY_DATE_RANGE", "IN_STORE_FROM_DATE_TODAY"]


def item_offers(frame: DataFrame, keys: list[str], item: Column, today: Column, zone: str = "Europe/Prague") -> DataFrame:
    """The keys and OFFER of each grid ITEM with a title and a price; of several periods that which dates.chosen_period takes."""
    from pricelode.functions.numbers import epoch_to_local_date

    given = frame.withColumn("_g", item["gridbox"]["data"])
    title = F.trim(F.coalesce(F.nullif(F.trim("_g.fullTitle"), F.lit("")), "_g.keyfacts.title"))
    base, packaging, price, old = F.col("_g.price.basePrice.text"), F.col("_g.price.packaging.text"), F.col("_g.price.price"), F.col("_g.price.oldPrice")
    dated = F.filter("_g.stockAvailability.badgeInfoV2", lambda b: (b["validFrom"] > 0) & F.exists(b["badges"], lambda t: t["type"].isin(*DATED)))
    periods = F.transform(dated, lambda b: F.struct(epoch_to_local_date(b["validFrom"], zone).alias("first"), epoch_to_local_date(b["validUntil"], zone).alias("last")))
    read = given.withColumn("_title", title).withColumn("_pack", F.coalesce(prices.pack_size(base), prices.pack_size(packaging), prices.price_basis(base))).withColumn("_period", dates.chosen_period(periods, today))
    offer = _offer(
        title=F.col("_title"), price=price, original=F.when(old > price, old), unit=F.col("_pack.unit"), amount=F.col("_pack.amount"),
        per_kg=F.coalesce(prices.unit_price_per_kg(base, F.col("_title")), prices.unit_price_per_kg(packaging, F.col("_title"))), valid_from=F.col("_period.first"), valid_to=F.col("_period.last"),
        promo=F.coalesce(old > price, F.lit(False)) | (F.coalesce("_g.price.discount.discountText", F.lit("")) != "") | F.col("_period.last").isNotNull())
    return _rows(read.where((F.col("_title") != "") & price.isNotNull()), keys, F.array(offer)).drop("variant")


def facet_children(nodes: DataFrame) -> DataFrame:
    """page, node of the children of each page's deepest selected node that has children, none of them selected. `nodes`: page, node, parent (null at the top), selected, place."""
    child = nodes.where("parent is not null").select("page", F.col("parent").alias("node"), F.col("selected").alias("_s"))
    state = child.groupBy("page", "node").agg(F.max("_s").alias("_deeper"))
    chosen = nodes.where("selected").join(state, ["page", "node"]).where("not _deeper").groupBy("page").agg(F.min_by("node", "place").alias("parent"))
    return nodes.join(chosen, ["page", "parent"]).select("page", "node", "place")


def tree_walk(spark: SparkSession, pages: DataFrame, root: str, skip: list[str], deepest: int = 20) -> DataFrame:
    """path, label, depth of the stored category pages that a walk from `root` opens: children of a page only where it lists fewer items than it
    has found, none under labels that begin (folded) with one of `skip`, each path once, by its shortest way. `pages`: path, found, listed, children ARRAY<STRUCT<path, label>>.

    One join a level, so a tree of any width takes as many steps as it is deep, `deepest` at most; a tree that goes deeper raises.
    """
    skipped = F.lit(False)
    for s in skip:
        skipped = skipped | text.fold(F.col("label")).startswith(text.fold_plain(s))
    reached = spark.createDataFrame([(root, "", 0)], "path string, label string, depth int")
    level = reached
    for depth in range(1, deepest + 2):
        opened = pages.join(level, "path").where("found > listed").select(F.explode("children").alias("c")).select("c.path", "c.label").where(F.col("path").isNotNull() & ~skipped)
        level = opened.groupBy("path").agg(F.min("label").alias("label")).join(reached, "path", "left_anti").withColumn("depth", F.lit(depth))
        if level.isEmpty():
            return reached
        reached = reached.unionByName(level)
    raise ValueError(f"a category tree is deeper than {deepest}")


def leaflet_entries(frame: DataFrame, keys: list[str], html: Column, element: str = "__NEXT_DATA__", prefix: str = "Leaflet:") -> DataFrame:
    """The keys, id, title, valid_from, valid_to, url, location, kind of the entries of a page's embedded state whose key begins with `prefix`."""
    entry = "struct<id:string,title:string,validityStartDateFormatted:string,validityEndDateFormatted:string,viewUrl:string,locationType:string,documentType:string>"
    state = F.from_json(F.regexp_extract(html, rf'(?s)<script id="{element}"[^>]*>(.*?)</script>', 1), f"props struct<pageProps:struct<apolloState:map<string,string>>>")
    found = frame.select(*keys, F.explode(F.map_filter(state["props"]["pageProps"]["apolloState"], lambda k, v: k.startswith(prefix) & v.startswith("{"))).alias("_key", "_value")).withColumn("_e", F.from_json("_value", entry))
    return found.select(*keys, "_e.id", "_e.title", dates.dotted_day(F.col("_e.validityStartDateFormatted")).alias("valid_from"), dates.dotted_day(F.col("_e.validityEndDateFormatted")).alias("valid_to"),
                        F.col("_e.viewUrl").alias("url"), F.col("_e.locationType").alias("location"), F.col("_e.documentType").alias("kind"))


def page_leaflets(frame: DataFrame, keys: list[str], html: Column) -> DataFrame:
    """The keys, slug, kind, valid_from, valid_to of each distinct leaflet name of a page; names without valid days are left out."""
    named = frame.select(*keys, F.explode(dates.slugs(html)).alias("slug")).withColumn("_p", dates.slug_period(F.col("slug"))).where("_p is not null")
    return named.select(*keys, "slug", "_p.kind", "_p.valid_from", "_p.valid_to")


def current_leaflets(leaflets: DataFrame, today: Column, large: str, horizon: int = 8) -> DataFrame:
    """Leaflets that have not ended and begin within `horizon` days (a null start has begun), in order of start, those of kind `large` first."""
    held = leaflets.where((F.col("valid_to") >= today) & F.coalesce(F.col("valid_from") <= F.date_add(today, horizon), F.lit(True)))
    return held.orderBy(F.asc_nulls_first("valid_from"), F.when(F.col("kind") == large, 0).otherwise(1))


def flyers(frame: DataFrame, keys: list[str], overview: Column) -> DataFrame:
    """The keys, subcategory, name, title, offer_from, offer_to, published, pdf of the flyers of an overview, three levels deep."""
    one = "struct<name:string,title:string,offerStartDate:string,offerEndDate:string,startDate:string,pdfUrl:string>"
    parsed = F.from_json(overview, f"categories array<struct<subcategories:array<struct<name:string,flyers:array<{one}>>>>>")
    subs = frame.select(*keys, F.explode(F.flatten(F.array_compact(parsed["categories"]["subcategories"]))).alias("_s")).select(*keys, F.col("_s.name").alias("_sub"), F.explode("_s.flyers").alias("_f"))
    day = lambda c: dates.iso_prefix(F.col(f"_f.{c}"))
    return subs.select(*keys, F.col("_sub").alias("subcategory"), "_f.name", "_f.title", day("offerStartDate").alias("offer_from"), day("offerEndDate").alias("offer_to"), day("startDate").alias("published"), F.col("_f.pdfUrl").alias("pdf"))


def spread_pages(frame: DataFrame, keys: list[str], spreads: Column) -> DataFrame:
    """The keys, spread, page (0-based each), text of all pages of leaflet spreads (JSON), in order."""
    parsed = F.from_json(spreads, "array<struct<pages:array<struct<text:string>>>>")
    return frame.select(*keys, F.posexplode(parsed).alias("spread", "_s")).select(*keys, "spread", F.posexplode("_s.pages").alias("page", "_p")).select(*keys, "spread", "page", "_p.text")


class _SearchPage(HTMLParser):
    """Discount rows of a search page: a product group has a name and a pack, its rows a shop and a price."""

    VOID = {"br", "img", "input", "meta", "link", "hr"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, set[str], dict]] = []
        self.rows: list[dict] = []
        self.group: dict | None = None
        self.row: dict | None = None

    def _open(self, *names: str) -> bool:
        return all(any(n in classes or n == tag for tag, classes, _ in self.stack) for n in names)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        own = {k: v or "" for k, v in attrs}
        classes = set(own.get("class", "").split())
        if tag not in self.VOID:
            self.stack.append((tag, classes, own))
        if "group_discounts" in classes:
            self.group = {"title": "", "pack": "", "product_id": "", "average": ""}
        elif self.group is not None and "product--wrap" in classes:
            self.group["product_id"] = own.get("data-product-id", "")
        elif self.group is not None and "discount_row" in classes:
            self.row = {"discount_id": own.get("data-discount", ""), "shop_id": own.get("data-shop", ""), "data_price": "", "shown": "", "amount": "", "unit_text": "", "validity": "", "club": False}
            self.rows.append(self.group | {"of": self.group, "row": self.row})
        if self.row is not None:
            if "btn_list_add" in classes:
                self.row["data_price"] = own.get("data-price", "")
            self.row["club"] |= "discounts_club" in classes

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                for _, classes, _ in self.stack[i:]:
                    self.group = None if "group_discounts" in classes else self.group
                    self.row = None if "discount_row" in classes or self.group is None else self.row
                del self.stack[i:]
                return

    def handle_data(self, data: str) -> None:
        if self.row is not None:
            for css, name in (("discount_price_value", "shown"), ("discount_amount", "amount"), ("price_per_unit", "unit_text"), ("discounts_validity", "validity")):
                if self._open(css):
                    self.row[name] += data
        elif self.group is not None:
            if self._open("product_name", "strong"):
                self.group["title"] += data
            elif self._open("product_name", "nowrap", "span"):
                self.group["pack"] += data
            elif self._open("avg_price", "span"):
                self.group["average"] += data


_SEARCH = ["title", "pack", "product_id", "average", "discount_id", "shop_id", "data_price", "shown", "amount", "unit_text", "validity"]


def page_rows(html: str | None) -> list[dict]:
    """The discount rows of a search page, texts with white space collapsed; of rows of one product with one discount id the first."""
    parser = _SearchPage()
    parser.feed(html or "")
    out, seen = [], set()
    for found in parser.rows:
        merged = {**found["of"], **found["row"]}
        key = (id(found["of"]), merged["discount_id"])
        if key not in seen:
            seen.add(key)
            out.append({k: " ".join(v.split()) if isinstance(v, str) else v for k, v in merged.items()})
    return out


def search_rows(frame: DataFrame, key: str, html: str, shops: dict[str, str], today: Column, end: Column) -> DataFrame:
    """The key, discount_id, product_id, store and OFFER of each discount of stored search pages whose shop is known and which has a price.

    Pages are parsed in Arrow batches; the rest is native. The price is that of the button, else that shown; the row's own pack goes before the product's.
    """
    kind = dict(frame.dtypes)[key]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(k, r) for k, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for r in page_rows(page)]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], batch.column(0).type), *[pa.array([r[c] for _, r in found], pa.string()) for c in _SEARCH], pa.array([r["club"] for _, r in found], pa.bool_())], ["key", *_SEARCH, "club"])

    from pricelode.functions.numbers import first_number

    rows = frame.select(F.col(key).alias("key"), F.col(html).alias("html")).mapInArrow(parse, f"key {kind}, {', '.join(f'{c} string' for c in _SEARCH)}, club boolean")
    store = F.try_element_at(F.create_map(*[F.lit(x) for pair in shops.items() for x in pair]), F.col("shop_id"))
    read = rows.withColumn("store", store).withColumn("price", F.coalesce(F.col("data_price").try_cast("double"), first_number(F.col("shown")))).where("store is not null and price is not null and title <> ''")
    read = read.withColumn("pack_", F.coalesce(prices.pack_size(F.col("amount")), prices.pack_size(F.col("pack")))).withColumn("valid", dates.validity(F.col("validity"), today, end))
    offer = _offer(title=F.col("title"), price=F.col("price"), original=first_number(F.col("average")), club=F.col("club"), promo=F.lit(True), unit=F.col("pack_.unit"), amount=F.col("pack_.amount"),
                   per_kg=prices.unit_price_per_kg(F.col("unit_text"), F.col("title")), valid_from=F.col("valid.valid_from"), valid_to=F.col("valid.valid_to"))
    return read.select(F.col("key").alias(key), "discount_id", "product_id", "store", offer.alias("o")).select(key, "discount_id", "product_id", "store", "o.*")


def last_by_id(entries: DataFrame, key: str, ordinal: str) -> DataFrame:
    """Entries with a text id, the last of equal ids."""
    return entries.where(F.col(key).isNotNull() & (F.col(key) != "")).withColumn("_k", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(ordinal)))).where("_k = 1").drop("_k")


def with_negatives(catalogue: DataFrame, terms: DataFrame) -> DataFrame:
    """Catalogue entries with `negatives`, the words of all terms (id, neg ARRAY) of their id, in order; empty where there are none."""
    own = terms.where("id is not null").groupBy("id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce("neg", F.array().cast("array<string>")))))).alias("negatives"))
    return catalogue.join(own, "id", "left").withColumn("negatives", F.coalesce("negatives", F.array().cast("array<string>")))


def terms_up_to(terms: DataFrame, priority: int) -> DataFrame:
    """Search terms of at most a priority; one without has the first."""
    return terms.where(F.coalesce(F.col("priority").try_cast("int"), F.lit(1)) <= priority)


def market_rules(rules: DataFrame, market: str, default: str) -> DataFrame:
    """ordinal, pattern, target, store, market of rules that have a pattern and a target, for a market or for all; a rule without a market is the default's."""
    kept = rules.withColumn("market", F.lower(F.coalesce(F.nullif("market", F.lit("")), F.lit(default)))).where(F.col("market").isin("*", market) & (F.coalesce("pattern", F.lit("")) != "") & (F.coalesce("target", F.lit("")) != ""))
    return kept.select("ordinal", "pattern", "target", F.coalesce(F.nullif("store", F.lit("")), F.lit("*")).alias("store"), "market")


def overlaid(defaults: DataFrame, given: DataFrame, key: str, value: str) -> DataFrame:
    """Default values, replaced by given ones of the same key that are numbers above zero."""
    own = given.withColumn("_v", F.col(value).try_cast("double")).where("_v > 0").groupBy(key).agg(F.max("_v").alias("_v"))
    return defaults.join(own, key, "left").select(key, F.coalesce("_v", value).alias(value))


def robot_rules(text_: Column) -> Column:
    """ARRAY<STRUCT<agents, allow, path>> of a robots.txt: rules with the agents of their group, in lower case."""
    lines = F.filter(F.transform(F.split(text_, r"\r?\n"), lambda s: F.trim(F.regexp_replace(s, "#.*$", ""))), lambda s: s.contains(":"))
    fields = F.transform(lines, lambda s: F.struct(F.lower(F.trim(F.substring_index(s, ":", 1))).alias("key"), F.trim(F.regexp_replace(s, "^[^:]*:", "")).alias("value")))
    known = F.filter(fields, lambda f: f["key"].isin("user-agent", "allow", "disallow", "crawl-delay"))
    start = F.struct(F.array().cast("array<string>").alias("agents"), F.lit(False).alias("inside"), F.array().cast("array<struct<agents:array<string>,allow:boolean,path:string>>").alias("rules"))

    def step(s: Column, f: Column) -> Column:
        named = F.struct(F.when(s["inside"], F.array(F.lower(f["value"]))).otherwise(F.array_append(s["agents"], F.lower(f["value"]))).alias("agents"), F.lit(False).alias("inside"), s["rules"].alias("rules"))
        rule = F.when(f["key"].isin("allow", "disallow") & (f["value"] != ""), F.array_append(s["rules"], F.struct(s["agents"].alias("agents"), (f["key"] == "allow").alias("allow"), f["value"].alias("path")))).otherwise(s["rules"])
        return F.when(f["key"] == "user-agent", named).otherwise(F.struct(s["agents"].alias("agents"), F.lit(True).alias("inside"), rule.alias("rules")))

    return F.aggregate(known, start, step)["rules"]


def robot_allows(rules: Column, path: Column, agent: str) -> Column:
    """Whether robot_rules allow a path (with its query): of the rules of groups that name the agent, else of those for all, the longest that matches; allowing ones win ties."""
    token = agent.split("/")[0].strip().lower()
    specific = F.filter(rules, lambda r: F.exists(r["agents"], lambda a: (a != "*") & F.lit(token).contains(a)))
    own = F.when(F.size(specific) > 0, specific).otherwise(F.filter(rules, lambda r: F.array_contains(r["agents"], "*")))
    quoted = lambda p: F.regexp_replace(F.regexp_replace(F.regexp_replace(p, r"([.\\+?()\[\]{}^|$])", r"\\$1"), r"\*", ".*"), r"\\\$$", "\\$")
    regex = lambda p: F.when(p.startswith("*"), quoted(p)).otherwise(F.concat(F.lit("^"), quoted(p)))
    hits = F.filter(own, lambda r: F.rlike(path, regex(r["path"])))
    best = F.array_max(F.transform(hits, lambda r: F.struct(F.length(r["path"]).alias("n"), r["allow"].alias("allow"))))
    return F.coalesce(best["allow"], F.lit(True))
