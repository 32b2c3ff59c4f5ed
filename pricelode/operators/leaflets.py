"""Offers in the text of leaflet pages, which only their order of lines tells."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, fields

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelode.functions import prices

_PRICE = regex.compile(r"(?<![\d.,])(\d{1,5}(?:[.,]\d{1,2})?)\s*(?:Kč|€|zł)(?!\p{L})", regex.I)
_EQUALS = regex.compile(r"^\s*(.+?)\s*=\s*(\d+(?:[.,]\d+)?)\s*(?:Kč|€|zł)\s*$", regex.I)
_BULLET = regex.compile(r"^\s*[•–*-]\s*(.+)$")

SCHEMA = "line_no int, kind string, subject string, price double"


def page_lines(text: str | None) -> list[tuple[int, str, str, float | None]]:
    """(line, kind, subject, price) of the lines of a page that hold an attribute or a price.

    `unit`: "500 g = 99,90 Kč", the price of a size. `price`: a line with a price; its subject is the last line before it
    that is no attribute and no price, the running title, whole. `item`: a bullet line under that title. Others set the title.
    """
    out: list[tuple[int, str, str, float | None]] = []
    title = ""
    for number, line in enumerate((text or "").splitlines(), 1):
        stripped = line.strip()
        if not stripped:
            continue
        if m := _EQUALS.match(stripped):
            out.append((number, "unit", m[1], float(m[2].replace(",", "."))))
        elif m := _BULLET.match(stripped):
            out.append((number, "item", m[1], None))
        elif (m := _PRICE.search(stripped)) and not stripped[:m.start()].strip():
            out.append((number, "price", title, float(m[1].replace(",", "."))))
        else:
            title = stripped
    return out


def parse_pages(pages: DataFrame, row: str, text: Column) -> DataFrame:
    """The row id, line_no, kind, subject, price of every attribute and price line of every page; see page_lines.

    Pages are read whole, one at a time, in Arrow batches; null and empty pages give no rows; other columns are ignored.
    """
    kind = dict(pages.dtypes)[row]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(i, *line) for i, t in zip(batch.id, batch.text) for line in page_lines(t)]
            yield pd.DataFrame(found, columns=["id", "line_no", "kind", "subject", "price"])

    return pages.select(F.col(row).alias("id"), text.alias("text")).mapInPandas(parse, f"id {kind}, {SCHEMA}").withColumnRenamed("id", row)


_WORD_UNIT = r"(kg|g|l|ml|ks|kus|kusů|kusy)"
_MONEY = r"(?:Kč|€|zł)"
_TOKEN = r"(\d{1,4}(?:[,.]\d\d)?)"
_UNIT_PRICE = regex.compile(
    rf"(\d+(?:[,.]\d+)?)\s*{_WORD_UNIT}\s*=\s*(?:od\s*)?{_TOKEN}\s*{_MONEY}(?:\s*(bez Aplikace|s Klubem)\s*/?\s*(?:od\s*)?{_TOKEN}\s*{_MONEY}\s*(?:Aplikace|bez Klubu)?)?", regex.I
)
_PACK = regex.compile(rf"^(?:•\s*)?(?:balení,?\s*|cena za\s*|od\s*)?(\d+(?:[,.]\d+)?)(?:\s*[–-]\s*\d+(?:[,.]\d+)?)?\s*{_WORD_UNIT}\b\.?$", regex.I)
_MULTI_PACK = regex.compile(rf"^(?:•\s*)?(\d+)\s*[x×]\s*(\d+(?:[,.]\d+)?)\s*{_WORD_UNIT}\b", regex.I)
_BARE = regex.compile(rf"^(\d{{1,4}})(?:,(?:(\d\d)|-))$|^(\d{{1,5}})(?:[,.](\d\d?))?\s*{_MONEY}$", regex.I)
_OLD = regex.compile(r"^(\d{1,4})(?:,(\d\d)|,-)?/$")
_CLUB = regex.compile(rf"^•\s*(\d{{1,4}})[,.](\d\d)\s*{_MONEY}$", regex.I)
_HIGH, _LOW = regex.compile(r"^\d{1,4}$"), regex.compile(r"^\d\d$")
_DISCOUNT = regex.compile(r"^[–-]\s*(\d{1,2})\s*%$")
_CONTINUED = regex.compile(rf"^(?:=|bez aplikace|aplikace|s klubem|bez klubu|(?:od\s*)?\d+,\d\d\s*{_MONEY}\s*(?:aplikace|bez klubu))", regex.I)
_EGGS = regex.compile(r"(?<![a-z])(?:vejce|vajec|vajic|vajíčk|vajick|vajcia|vajíčok|vajc|jaja|jajk|jajec|eier|egg)", regex.I)

# Lines that are no titles, as the reference lists them (Czech leaflets), and the kilograms of an egg.
_NOISE_STARTS = (
    "běžná cena", "nepora", "nelze", "více informací", "▼", "cena za 1 ks", "platí", "při koupi", "záloha", "původ", "pouze", "obsah", "nejnižší", "nabídka",
    "ilustrační", "chcete", "do vyprodání", "více druhů", "vybrané druhy", "vhodné", "ideální", "tip",
)
_NOISE_WORDS = set("neporazitelné novinka naše cena ceny super zralé billa albert akce sleva tip bio nové nový nová masa zdarma plus klub".split())
_EGG_KG = 0.055
#: Lines that one title may run over; a further one opens the next product.
TITLE_LINES = 3


@dataclass
class Product:
    title_lines: list[str] = field(default_factory=list)
    pack_quantity: float | None = None
    pack_unit: str | None = None
    pack_text: str | None = None
    per_kg: float | None = None
    per_kg_club: float | None = None
    unit_text: str | None = None
    price: float | None = None
    price_club: float | None = None
    old_price: float | None = None
    discount_pct: int | None = None
    club_first: bool = False

    @property
    def title(self) -> str:
        return " ".join(self.title_lines)


_PARTS = [f.name for f in fields(Product) if f.name != "title_lines"]
PRODUCT_SCHEMA = (
    "product_no int, title string, pack_quantity double, pack_unit string, pack_text string, per_kg double, per_kg_club double, unit_text string, "
    "price double, price_club double, old_price double, discount_pct int, club_first boolean"
)
_ARROW = [{"int": pa.int32(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_()}[part.split()[1]] for part in PRODUCT_SCHEMA.split(", ")]


def _number(text: str) -> float:
    return float(text.replace(",", "."))


def _per_kg(price: float, unit: str, quantity: float, title: str) -> float | None:
    """Litres count as kilograms; pieces have a mass for eggs only."""
    if quantity <= 0:
        return None
    if unit in ("kg", "l"):
        return price / quantity
    if unit in ("g", "ml"):
        return price / quantity * 1000
    return price / (quantity * _EGG_KG) if _EGGS.search(title) else None


def title_line(line: str) -> bool:
    """a line that may be (a part of) a title: letters enough, no price, no noise, no slogan in capitals."""
    letters = [c for c in line if c.isalpha()]
    low = line.lower()
    if len(letters) < 3 or line.startswith("•") or low.startswith(_NOISE_STARTS) or all(w in _NOISE_WORDS for w in low.split()):
        return False
    if any(c.isdigit() for c in line) and (regex.search(_MONEY, line) or "%" in line or regex.search(r"\d,(\d\d|-)", line)):
        return False
    return not (sum(c.isupper() for c in letters) > 0.8 * len(letters) and len(letters) > 4) and len(letters) >= 0.5 * len(line)


def bad_title(title: str) -> bool:
    """a title without a word of four letters, of spaced single letters, or that only says 'several kinds'."""
    words, low = title.split(), title.lower()
    if not words or title[0].isdigit() or max(map(len, words)) < 4:
        return True
    singles = sum(len(w) == 1 for w in words)
    return singles >= 3 and singles > len(words) / 2 or low in ("více druhů", "druhy", "vybrané druhy") or low.startswith(("více druh", "od ", "z pultu"))


def joined_lines(lines: list[str]) -> list[str]:
    """Fragments go back to the line they continue; a line with bullets inside becomes one line a bullet."""
    joined: list[str] = []
    for line in lines:
        if joined and (_CONTINUED.match(line) or joined[-1].endswith(("=", "/", "bez", "od")) and line[0].isdigit() and not _OLD.match(joined[-1])):
            joined[-1] += " " + line
        else:
            joined.append(line)
    out: list[str] = []
    for line in joined:
        if "•" in line[1:]:
            out += [f"• {p}" if i else p for i, p in enumerate(part.strip() for part in line.split("•")) if p]
        else:
            out.append(line)
    return out


def _assign(group: list[Product], name: str, value: float) -> None:
    """To the first product of the row group that lacks it, so that the k-th value goes to the k-th product."""
    for product in group:
        if getattr(product, name) is None:
            setattr(product, name, value)
            return


def _assign_pack(group: list[Product], quantity: float, unit: str, text: str) -> None:
    for product in group:
        if product.pack_text is None:
            product.pack_quantity, product.pack_unit, product.pack_text = quantity, _piece(unit), text
            return


def _piece(unit: str) -> str:
    return "ks" if unit.lower().startswith("kus") else unit.lower()


def page_products(text: str | None) -> list[Product]:
    """Q1: the products of a page. Neighbouring title lines open a row group of products; the k-th pack, unit price, price,
    old price or discount that follows goes to the k-th product of the group that lacks one; a title after attributes opens
    the next group. "129" and "90" on two lines are 129.90, and "3490" alone is 34.90. Wider than the reference: a price line
    may name its currency, € and zł count as Kč does, three digits wait for the two of the next line, and an old price
    ("199,90/") is not run together with the price below it.
    """
    lines = joined_lines([line for raw in (text or "").splitlines() if (line := " ".join(raw.split()))])
    products: list[Product] = []
    group: list[Product] = []
    was_title = False
    high: str | None = None
    for line, following in zip(lines, [*lines[1:], ""]):
        before, high_before = was_title, high
        was_title, high = False, None
        if m := _UNIT_PRICE.search(line):
            target = next((p for p in group if p.per_kg is None and p.per_kg_club is None), None)
            if target is not None:
                first, second = (_per_kg(_number(x), _piece(m[2]), _number(m[1]), target.title) if x else None for x in (m[3], m[5]))
                target.unit_text = m[0]
                if (m[4] or "").lower().startswith("s klubem"):
                    target.per_kg_club, target.per_kg, target.club_first = first, second, True
                else:
                    target.per_kg, target.per_kg_club = first, second
        elif m := _MULTI_PACK.match(line):
            _assign_pack(group, int(m[1]) * _number(m[2]), m[3], line)
            high = high_before
        elif m := _PACK.match(line):
            _assign_pack(group, _number(m[1]), m[2], line)
        elif m := _DISCOUNT.match(line):
            _assign(group, "discount_pct", int(m[1]))
        elif m := _OLD.match(line):
            _assign(group, "old_price", float(f"{m[1]}.{m[2] or '00'}"))
        elif m := _CLUB.match(line):
            _assign(group, "price_club", float(f"{m[1]}.{m[2]}"))
            high = high_before
        elif m := _BARE.match(line):
            _assign(group, "price", float(f"{m[1] or m[3]}.{m[2] or m[4] or '00'}"))
        elif high_before is not None and _LOW.match(line):
            _assign(group, "price", float(f"{high_before}.{line}"))
        elif _HIGH.match(line):
            if len(line) > 3 or len(line) == 3 and not _LOW.match(following):
                _assign(group, "price", float(f"{line[:-2]}.{line[-2:]}"))
            else:
                high = line
        elif title_line(line):
            own = products[-1].title_lines if products else []
            if before and len(own) < TITLE_LINES and (not line[0].isupper() or len(own) == 1 and " " not in own[0]):
                own.append(line)
            else:
                products.append(Product([line]))
                group = [*group, products[-1]] if before else [products[-1]]
            was_title = True
    return [p for p in products if not bad_title(p.title)]


def parse_products(pages: DataFrame, row: str, text: Column) -> DataFrame:
    """The row id, product_no (from 1) and the parts of every product of every page; see page_products.

    Pages are read whole, one at a time, in Arrow batches; null and empty pages give no rows; other columns are ignored.
    """
    kind = dict(pages.dtypes)[row]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, n, p.title, *(getattr(p, name) for name in _PARTS)) for i, t in zip(*(c.to_pylist() for c in batch.columns)) for n, p in enumerate(page_products(t), 1)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], wanted) for k, wanted in enumerate([batch.column(0).type, *_ARROW])], ["id", "product_no", "title", *_PARTS])

    return pages.select(F.col(row).alias("id"), text.alias("text")).mapInArrow(parse, f"id {kind}, {PRODUCT_SCHEMA}").withColumnRenamed("id", row)


def leaflet_offers(products: DataFrame, keys: list[str], lowest: float = 5.0, highest: float = 5000.0) -> DataFrame:
    """The keys, variant (0 plain, 1 club), title, price, per_kg, unit, amount, original and confidence of parsed products (see parse_products).

    A product counts if its title has four letters and a pack or a unit price is told. Confidence is high where price and pack
    agree with the unit price, medium where the unit price alone, or the old price less its discount, tells the price, else
    low; a price that is the club's gives way to the one that follows from the unit price. The club offer stands only where it
    is cheaper. Unit prices outside the bounds are misread and give no offer; without a pack of known mass the offer is for a kilogram.
    """
    c = F.col
    rows = products.where((F.length("title") >= 4) & (c("pack_quantity").isNotNull() | c("per_kg").isNotNull() | c("per_kg_club").isNotNull()))
    rows = rows.withColumn("_kg", prices.kg_of(F.struct(c("pack_quantity").alias("amount"), c("pack_unit").alias("unit")), c("title"))).withColumn("_by_pack", c("price") / c("_kg"))
    known, agrees = c("per_kg").isNotNull(), prices.close(c("per_kg"), c("_by_pack"))
    of_club = known & ~agrees & prices.close(c("per_kg_club"), c("_by_pack"))
    rows = rows.withColumn("_of_club", of_club).withColumn("_own", F.when(of_club, None).otherwise(c("price"))).withColumn("_club", F.when(of_club, c("price")).otherwise(c("price_club")))
    follows = F.when(known & (c("_own").isNull() | (c("_by_pack").isNotNull() & ~agrees)), F.round(c("per_kg") * c("_kg"), 2)).otherwise(c("_own"))
    discounted = prices.close(c("old_price") * (1 - c("discount_pct") / 100), c("price"))
    confidence = F.when(c("pack_quantity").isNull(), "low").when(agrees, "high").when(known, "medium").when(c("_by_pack").isNotNull() & discounted, "medium").otherwise("low")
    rows = rows.withColumn("_price", follows).withColumn("_per", F.coalesce("per_kg", "_by_pack")).withColumn("confidence", confidence)
    rows = rows.where((c("_per").isNotNull() & (known | c("price").isNotNull())) | c("per_kg_club").isNotNull()).where(c("_per").isNull() | c("_per").between(lowest, highest))
    club_per = F.coalesce("per_kg_club", c("_club") / c("_kg"))
    rows = rows.withColumn("_club_per", club_per).withColumn("_club_price", F.coalesce("_club", F.round(club_per * c("_kg"), 2)))

    def offer(variant: int, price: Column, per: Column) -> Column:
        whole = price.isNotNull()
        return F.struct(F.lit(variant).alias("variant"), F.when(whole, price).otherwise(F.round(per, 2)).alias("price"), per.alias("per_kg"), F.when(whole, c("pack_unit")).otherwise("kg").alias("unit"), F.when(whole, c("pack_quantity")).otherwise(1.0).alias("amount"))

    plain = F.when(c("_per").isNotNull(), offer(0, c("_price"), c("_per")))
    club = F.when(c("_club_per").between(lowest, highest) & F.coalesce(c("_club_per") < c("_per"), F.lit(True)), offer(1, c("_club_price"), c("_club_per")))
    return rows.select(*keys, "title", c("old_price").alias("original"), "confidence", F.explode(F.array_compact(F.array(plain, club))).alias("_o")).select(*keys, "_o.variant", "title", "_o.price", "_o.per_kg", "_o.unit", "_o.amount", "original", "confidence")


def spread_offers(frame: DataFrame, keys: list[str], spreads: Column) -> DataFrame:
    """leaflet_offers of all pages of leaflet spreads (JSON), with spread, page and product_no."""
    from pricelode.sources.payloads import spread_pages

    pages = spread_pages(frame, keys, spreads).withColumn("_page", F.to_json(F.struct(*keys, "spread", "page")))
    found = parse_products(pages, "_page", F.col("text"))
    placed = found.join(pages.drop("text"), "_page").drop("_page")
    return leaflet_offers(placed, [*keys, "spread", "page", "product_no"])
