"""Packs and unit prices inside texts, in several languages, as Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words for a piece, currencies, and what announces a former price, a limit or a deposit.
_PIECE = r"ks|kus[a-zů]*|szt\.?|sztuk[a-z]*|stk\.?|st\.|stück|stueck|stuck"
_MONEY = r"(?:kč|kc|czk|€|eur|zł|zl|pln)"
_FORMER = (
    r"\*|\bcena przed\b|\bnajni[żz]sza cena\b|\blimit:|\+\s*kaucja|\bstatt\b|\bpůvodn[íi]\b|\bp[ôo]vodn[áa]\b"
    r"|\bcena p[řr]ed\b|\bcena pred\b|\buvp\b|\bbisher\b"
)
# Words for eggs, the kilograms of one, and how far apart two prices may be and still be close.
EGGS = r"(?iu)(?<![a-z])(vejce|vajec|vajic|vajíčk|vajick|vajcia|vajíčok|vajc|jaja|jajk|jajec|eier|egg)"
EGG_KG = 0.055
CLOSE = 0.06

# The patterns of unit prices ("1 kg = 43 Kč", but not "5 x 50 g = 250 g"; "15,96 Kč / 100 g", "2,49/100 g", where a price has
# decimals or a currency, so that "125/150 g" is none), of alternative, multiple, single and bare sizes, and of what a price is for.
_FLAGS = "(?iuU)"
_NUM = r"(\d+(?:[.,]\d+)?)"
_UNIT = rf"(kg|g|ml|l|cl|dl|{_PIECE})"
_EQUALS = rf"{_FLAGS}{_NUM}\s*{_UNIT}\s*=\s*(?:od\s*|ab\s*)?{_NUM}(?![\d,.])\s*{_MONEY}?(?!\s*(?:kg|g|ml|l|cl|dl)(?![a-z]))"
_PER = rf"{_FLAGS}(?:(\d+[.,]\d+)\s*{_MONEY}?|(\d+)\s*{_MONEY})\s*/\s*(\d+(?:[.,]\d+)?)?\s*{_UNIT}(?![a-z])"
_EITHER = rf"{_FLAGS}{_NUM}(?:/\d+(?:[.,]\d+)?)+\s*(?={_UNIT}(?![a-z]))"
_MULTI = rf"{_FLAGS}(\d+)\s*[x×]\s*{_NUM}\s*(kg|g|ml|l|cl|dl)(?![a-z])"
_SINGLE = rf"{_FLAGS}(?<![\d.,]){_NUM}\s*{_UNIT}(?![a-z])"
_BARE_UNIT = rf"{_FLAGS}(?:\b(?:je|pro|za|per|cena za)\s+|^\s*)(?:1\s*)?(kg|l)\s*$"
_BARE_PIECE = rf"{_FLAGS}(?:\b(?:je|pro|za|per|cena za)\s+|^\s*)(?:1\s*)?(?:{_PIECE})\s*$"
_BASIS = rf"{_FLAGS}cena\s+za\s+{_NUM}\s*(kg|g|ml|l|ks|kus)"

PACK = "struct<amount:double,unit:string>"


def let(value: Column, of: Callable[[Column], Column]) -> Column:
    """of(value), where `value` is evaluated once however often `of` uses it, so that steps built on each other stay small plans."""
    return F.transform(F.array(value), lambda x: of(x))[0]


def _number(text: Column) -> Column:
    return F.translate(F.nullif(text, F.lit("")), ",", ".").try_cast("double")


def unit_name(unit: Column) -> Column:
    """kg, g, l, ml, cl or dl as they are, in small letters; every word for a piece as ks."""
    low = F.regexp_replace(F.lower(unit), r"\.$", "")
    return F.when(low.isin("kg", "g", "l", "ml", "cl", "dl"), low).when(low != "", "ks")


def _pack(amount: Column, unit: Column) -> Column:
    """STRUCT<amount, unit> in kg, g, l, ml or ks; centilitres and decilitres become millilitres."""
    def read(size: Column) -> Column:
        n, named = size["n"], size["named"]
        scaled = F.when(named == "cl", n * 10).when(named == "dl", n * 100).otherwise(n)
        return F.when(n.isNotNull() & named.isNotNull(), F.struct(scaled.alias("amount"), F.when(named.isin("cl", "dl"), "ml").otherwise(named).alias("unit")))

    return let(F.struct(amount.alias("n"), unit_name(unit).alias("named")), read)


def before_disclaimer(text: Column) -> Column:
    """The text before what announces a former price, a limit or a deposit."""
    return F.regexp_replace(F.translate(text, "\u00a0", " "), rf"(?isuU)(?:{_FORMER}).*$", "")


def base_amount(amount: Column, unit: Column) -> Column:
    """STRUCT<amount, unit> in kg, l or ks."""
    low = F.lower(unit)
    per = F.when(low.isin("kg", "l"), 1.0).when(low.isin("g", "ml"), 1000.0).when(low.isin("dkg", "dag", "cl"), 100.0).when(low == "dl", 10.0).when(low == "mg", 1e6).when(low.isin("ks", "kus", "kusy", "kusu", "kusů", "pcs"), 1.0)
    base = F.when(low.isin("kg", "g", "dkg", "dag", "mg"), "kg").when(low.isin("l", "ml", "cl", "dl"), "l").otherwise("ks")
    return F.when(per.isNotNull() & amount.isNotNull(), F.struct((amount / per).alias("amount"), base.alias("unit")))


def is_egg(title: Column) -> Column:
    return F.coalesce(title.rlike(EGGS), F.lit(False))


def kg_of(pack: Column, title: Column) -> Column:
    """Kilograms of a pack: litres count as kilograms, pieces have a mass for eggs only. Null unless above zero."""
    def read(p: Column) -> Column:
        unit, amount = p["unit"], p["amount"]
        kg = F.when(unit.isin("kg", "l"), amount).when(unit.isin("g", "ml"), amount / 1000).when((unit == "ks") & is_egg(title), amount * EGG_KG)
        return F.when(amount > 0, kg)

    return let(pack, read)


def per_kg(price: Column, pack: Column, title: Column) -> Column:
    return price / kg_of(pack, title)


def base_to_kg(price: Column, unit: Column, density: Column, piece_grams: Column) -> Column:
    """STRUCT<value, assumed>: a price per kg, l or ks as one per kg, by density (1 where none is known, and then assumed) and the
    grams of a piece."""
    known = density > 0
    value = F.when(unit == "kg", price).when(unit == "l", price / F.when(known, density).otherwise(1.0)).when((unit == "ks") & (piece_grams > 0), price / (piece_grams / 1000))
    return F.when(value.isNotNull(), F.struct(value.alias("value"), F.coalesce((unit == "l") & ~F.coalesce(known, F.lit(False)), F.lit(False)).alias("assumed")))


def unit_price(text: Column) -> Column:
    """STRUCT<price, amount, unit> of the first unit price before any former price: "1 kg = 43 Kč" before "15,96 Kč / 100 g"."""
    def read(plain: Column) -> Column:
        part = lambda p, i: F.regexp_extract(plain, p, i)
        found = lambda price, pack: F.when(price.isNotNull() & pack.isNotNull(), F.struct(price.alias("price"), pack["amount"].alias("amount"), pack["unit"].alias("unit")))
        equal = let(_pack(_number(part(_EQUALS, 1)), part(_EQUALS, 2)), lambda pack: found(_number(part(_EQUALS, 3)), pack))
        slash = let(_pack(F.coalesce(_number(part(_PER, 3)), F.lit(1.0)), part(_PER, 4)), lambda pack: found(_number(F.concat(part(_PER, 1), part(_PER, 2))), pack))
        return F.coalesce(equal, slash)

    return let(before_disclaimer(text), read)


def unit_price_per_kg(text: Column, title: Column) -> Column:
    return let(unit_price(text), lambda found: per_kg(found["price"], found, title))


def pack_size(text: Column) -> Column:
    """STRUCT<amount, unit> of the pack that a text tells, in kg, g, l, ml or ks.

    Unit prices are left out first, and of alternative sizes ("125/150 g") the first counts. Then the first that is there: a
    multipack, summed; a bare unit ("cena za kg"); a bare piece; the first weight or volume; the first number of pieces.
    """
    plain = before_disclaimer(text)
    for pattern in (_EQUALS, _PER):
        plain = F.regexp_replace(plain, pattern, " ")

    def read(plain: Column) -> Column:
        part = lambda p, i: F.regexp_extract(plain, p, i)
        multi = _pack(_number(part(_MULTI, 1)) * _number(part(_MULTI, 2)), part(_MULTI, 3))
        sizes = F.transform(F.arrays_zip(F.regexp_extract_all(plain, F.lit(_SINGLE), F.lit(1)).alias("a"), F.regexp_extract_all(plain, F.lit(_SINGLE), F.lit(2)).alias("u")), lambda z: _pack(_number(z["a"]), z["u"]))
        first = let(sizes, lambda own: F.coalesce(F.try_element_at(F.filter(own, lambda z: z["unit"] != "ks"), F.lit(1)), F.try_element_at(own, F.lit(1))))
        return F.coalesce(multi, F.when(part(_BARE_UNIT, 1) != "", _pack(F.lit(1.0), part(_BARE_UNIT, 1))), F.when(plain.rlike(_BARE_PIECE), _pack(F.lit(1.0), F.lit("ks"))), first)

    return let(F.regexp_replace(plain, _EITHER, "$1 "), read)


def price_basis(text: Column) -> Column:
    """STRUCT<amount, unit> (kg, l, ks) that "cena za 100 g" says a price is for."""
    return base_amount(_number(F.regexp_extract(text, _BASIS, 1)), F.regexp_extract(text, _BASIS, 2))


def close(a: Column, b: Column) -> Column:
    """b is within CLOSE of a, which is above zero; false where either is missing."""
    return F.coalesce((a > 0) & (F.abs(a - b) / a <= CLOSE), F.lit(False))


def band(value: Column, bands: list[tuple[float, str]]) -> Column:
    """The name of the first band (bound, name), in order, that the value is below; null beyond the last."""
    found = F.lit(None).cast("string")
    for bound, name in sorted(bands, reverse=True):
        found = F.when(value < bound, name).otherwise(found)
    return found
