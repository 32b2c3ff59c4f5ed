"""Listings of the same product, worded differently by different sellers."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import partial, reduce

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelode.functions.text import fold as folded
from pricelode.functions.units import SPELLINGS, UnitGraph
from pricelode.session import checkpointed

# The language of each market's titles.
LANGUAGES = {"cz": "cs", "sk": "sk", "pl": "pl", "de": "de", "at": "de"}

# Words that name the fat content, folded.
FAT_WORDS = {"tuk", "tuku", "obsah", "fett", "fettgehalt", "tl", "tluszczu", "zaw"}

_SPELLED = {s: unit for unit, own in SPELLINGS.items() for s in own}
_UNITS = "|".join(sorted(map(regex.escape, _SPELLED), key=len, reverse=True))
_SIZE = regex.compile(rf"(?<![\p{{L}}\d.,/])(?:(\d{{1,3}})\s*[x×*]\s*)?(\d+\s?/\s?\d+|\d*\s?[½¼¾]|\d+(?:[.,]\d+)?)\s*({_UNITS})\.?(?![\p{{L}}\d])")
_FAT = regex.compile(r"(?<![\d.,])(\d+(?:[.,]\d+)?)\s*%")
_CODE = regex.compile(r"(?<!\d)(\d{13}|\d{12}|\d{8}|\d{14})(?!\d)")
_WORD = regex.compile(r"[a-z]+")
_MODEL = regex.compile(r"(?<![a-z\d.,])(?=[a-z/-]*\d)[a-z\d]+(?:[/-][a-z\d]+)*(?![\d%]|[.,]\d)")
_VULGAR = {"½": 0.5, "¼": 0.25, "¾": 0.75}

#: A wording is learned when it stands in this share of an item's titles.
LEARN_SHARE = 0.2
#: Wordings that are sent to the tasks as one table; a catalogue with more must be cut into parts by its caller.
WORDINGS = 200_000
#: A word may be a brand when listings that share it share item, size and fat content so many times as often as any two.
BRAND_LIFT = 4.0
#: A spelling may stand for one that has so many times its listings in the market, and so many at least.
TIMES, RELIABLE = 5, 3
#: A word tells the variety when listings of one brand, item, size and fat content share it so many times as often as chance has it.
CARRIER_LIFT = 2.0
#: Two such words mean the same when one stands for the other so often; one that stands for words of two meanings has none itself.
SAME, NEAR, APART = 0.4, 0.3, 0.15
#: So many pairs of listings must be expected to share a word by chance before it counts as telling nothing.
EXPECTED = 3.0


def fold(text: str) -> str:
    """Small letters without accents."""
    plain = unicodedata.normalize("NFD", text.lower().replace("ł", "l").replace("ß", "ss"))
    return "".join(c for c in plain if not unicodedata.combining(c))


def valid_code(digits: str) -> bool:
    """The check digit of a GTIN of 8, 12, 13 or 14 digits holds."""
    total = sum(int(d) * (3 if i % 2 else 1) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0 and int(digits) > 0


def _amount(text: str) -> float | None:
    bare = regex.sub(r"\s", "", text)
    if bare[-1] in _VULGAR:
        return float(bare[:-1] or 0) + _VULGAR[bare[-1]]
    if "/" in bare:
        a, b = map(float, bare.split("/"))
        return a / b if b else None
    return float(bare.replace(",", "."))


class Titles:
    """Reads titles into parts, with the wordings of items by language."""

    def __init__(self, wordings: list[tuple[str, str, str]], adjectives: list[tuple[str, str, str]] = ()) -> None:
        self.items: dict[str, dict[tuple[str, ...], str]] = {language: {} for language in LANGUAGES.values()}
        for language, wording, item in wordings:
            if language in self.items and wording:
                self.items[language][tuple(sorted(wording.split()))] = item
        self.beside: dict[tuple[str, str], set[str]] = {}
        for language, word, item in adjectives:
            self.beside.setdefault((language, item), set()).add(word)
        self.longest = max((len(k) for own in self.items.values() for k in own), default=1)
        self.factors = {unit: (target, float(way.factor)) for unit, target, way in UnitGraph().to_targets()}

    def size(self, count: str | None, amount: str, unit: str) -> str | None:
        value = _amount(amount)
        target = self.factors.get(_SPELLED[unit])
        if value is None or target is None or value <= 0:
            return None
        return f"{max(1, int(count or 1))}x{round(value * target[1])}{target[0]}"

    def item(self, words: list[str], language: str) -> tuple[str | None, list[str]]:
        """The item that words name, the longest wording first, and the words left over. Words of a wording may come in any
        order but must stand together; further wordings of the same item are taken too."""
        own = self.items.get(language, {})
        item = None
        used = [False] * len(words)
        for n in range(min(self.longest, len(words)), 0, -1):
            for i in range(len(words) - n + 1):
                if not any(used[i:i + n]):
                    hit = own.get(tuple(sorted(words[i:i + n])))
                    if hit and item in (None, hit):
                        item = hit
                        used[i:i + n] = [True] * n
        beside = self.beside.get((language, item or ""), set())
        return item, [w for w, u in zip(words, used) if not u and w not in beside]

    def read(self, title: str | None, market: str | None, unit: str | None = None, quantity: float | None = None) -> dict:
        """size (`2x100g`), fat, code, part numbers, item and the words left over.

        Part numbers are tokens with digits that are no size, per cent, GTIN or decimal, without their separators: `18V-55` is
        18v55.
        """
        language = LANGUAGES.get(market or "", "")
        text = regex.sub(r"[\s\p{Z}]+", " ", (title or "").lower())
        size = None
        m = _SIZE.search(text)
        if m:
            size = self.size(m[1], m[2], m[3])
            text = text[:m.start()] + " | " + text[m.end():]
        elif unit and quantity and quantity > 0:
            spelled = regex.sub(r"[\s.]", "", unit.lower())
            size = self.size(None, repr(float(quantity)), spelled) if spelled in _SPELLED else None
        code = next((c.zfill(14) for c in _CODE.findall(text) if valid_code(c)), None)
        fat = None
        m = _FAT.search(text)
        if m:
            fat = f"{float(m[1].replace(',', '.')):g}"
            text = text[:m.start()] + " " + text[m.end():]
        text = fold(text)
        models: list[str] = []
        if any(c.isdigit() for c in text):
            text = _CODE.sub(" ", _SIZE.sub(" ", text))
            models = sorted({regex.sub("[/-]", "", m) for m in _MODEL.findall(text)})
            text = _MODEL.sub(" ", text)
        item, rest = self.item(_WORD.findall(text), language)
        return {"language": language, "size": size, "fat": fat or "", "code": code, "item": item or "", "parts": "+".join(models), "words": sorted({w for w in rest if w not in FAT_WORDS})}


def catalogue_wordings(catalogue: DataFrame) -> DataFrame:
    """language, wording (folded), item: each way that a catalogue names an item."""
    named = catalogue.where("id is not null").select("id", F.explode(F.concat(
        F.transform(F.concat(F.array("name_cs", "name_plural_cs"), F.coalesce("aliases", F.array().cast("array<string>"))), lambda t: F.struct(F.lit("cs").alias("key"), t.alias("value"))),
        F.coalesce(F.map_entries("names"), F.array().cast("array<struct<key:string,value:string>>")), F.coalesce(F.map_entries("names_plural"), F.array().cast("array<struct<key:string,value:string>>")))).alias("n"))
    return named.select(F.col("n.key").alias("language"), F.array_join(_words(F.col("n.value")), " ").alias("wording"), F.col("id").alias("item")).where("wording <> ''").distinct()


def _words(text: Column) -> Column:
    """The words of a text, folded, in order."""
    return F.regexp_extract_all(folded(text), F.lit("[a-z]+"), F.lit(0))


def _runs(words: Column, longest: int) -> Column:
    """All runs of up to `longest` neighbouring words; the words of a run in order of the alphabet."""
    def of(n: int) -> Column:
        starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.array_sort(F.slice(words, i, n)), " "))

    return F.array_distinct(F.flatten(F.array(*[of(n) for n in range(1, longest + 1)])))


def learned_wordings(labelled: DataFrame, title: str, market: str, item: str, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two tables of language, wording, item, from titles whose item is recorded: further wordings, and words that stand beside one.

    A further wording is a run of words in LEARN_SHARE of an item's titles in a language that hold no known wording (the bound
    holds with two standard deviations to spare); runs within a longer one that is about as frequent are dropped. A word
    beside a wording is one in that share of all titles of the item. All rows are counted, by partial aggregation.
    """
    language = F.create_map(*[F.lit(x) for pair in LANGUAGES.items() for x in pair])
    rows = labelled.select(F.try_element_at(language, F.col(market)).alias("language"), F.col(item).alias("item"), _words(F.col(title)).alias("words")).where("language is not null and item is not null")
    rows = rows.withColumn("words", F.filter("words", lambda w: ~w.isin("x", *FAT_WORDS, *_SPELLED)))
    longest = known.agg(F.max(F.size(F.split("wording", " ")))).first()[0] or 1  # one number
    own = known.groupBy("language", "item").agg(F.collect_set(F.split("wording", " ")).alias("known"))
    told = F.coalesce(F.exists("known", lambda k: F.size(F.array_except(k, "words")) == 0), F.lit(False))
    placed = rows.join(own, ["language", "item"], "left").withColumn("told", told)
    # Only titles without a known wording are cut into runs.
    parts = F.when(F.col("told"), F.array_distinct("words")).otherwise(_runs(F.col("words"), longest))
    counts = placed.select("language", "item", "told", F.explode(F.array_append(parts, F.lit(""))).alias("run")).groupBy("language", "item", "told", "run").agg(F.count("*").alias("n"))
    counts = checkpointed(counts)
    totals = counts.where("run = ''").select("language", "item", "told", F.col("n").alias("total"))
    often = counts.where("run <> ''").join(totals, ["language", "item", "told"]).where(F.col("n") - 2 * F.sqrt("n") >= LEARN_SHARE * F.col("total"))
    new = often.where("not told").select("language", "item", "run", "n")
    longer = new.select("language", "item", F.col("run").alias("longer"), F.col("n").alias("longer_n"))
    within = F.forall(F.split("run", " "), lambda w: F.array_contains(F.split("longer", " "), w)) & (F.length("longer") > F.length("run"))
    covered = new.join(longer, ["language", "item"]).where(within & (F.col("longer_n") >= 0.7 * F.col("n"))).select("language", "item", "run")
    fresh = new.join(covered, ["language", "item", "run"], "left_anti").select("language", F.col("run").alias("wording"), "item")
    return fresh, often.where("told").select("language", F.col("run").alias("wording"), "item")


def wording_lists(*tables: DataFrame) -> list[list[tuple[str, str, str]]]:
    """The rows of wording tables, for the tasks; raises beyond WORDINGS rows, as a list of unknown size must not leave the cluster."""
    tagged = [t.select(F.lit(i).alias("i"), "language", "wording", "item") for i, t in enumerate(tables)]
    rows = reduce(DataFrame.unionByName, tagged).limit(WORDINGS + 1).collect()
    if len(rows) > WORDINGS:
        raise ValueError(f"more than {WORDINGS} wordings")
    return [sorted(tuple(r)[1:] for r in rows if r.i == i) for i in range(len(tables))]


PARTS = "id {kind}, market string, language string, item string, size string, fat string, code string, parts string, words array<string>"


def _read(wordings: list, adjectives: list, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    titles = Titles(wordings, adjectives)
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(1, 5)]
        parts = [titles.read(*row) for row in zip(*columns)]
        yield pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(2), *[pa.array([p[k] for p in parts], pa.string()) for k in ("language", "item", "size", "fat", "code", "parts")],
            pa.array([p["words"] for p in parts], pa.list_(pa.string())),
        ], ["id", "market", "language", "item", "size", "fat", "code", "parts", "words"])


def read_listings(listings: DataFrame, row: str, wordings: list[tuple[str, str, str]], adjectives: list[tuple[str, str, str]] = ()) -> DataFrame:
    """id, market, language, item, size, fat, code, parts, words of each listing; a part that a title does not tell is null or empty."""
    kind = dict(listings.dtypes)[row]
    given = listings.select(F.col(row).alias("id"), "title", "market", "unit", F.when(~F.isnan("quantity"), F.col("quantity")).alias("quantity")).where("id is not null")
    read = given.mapInArrow(partial(_read, wordings, list(adjectives)), PARTS.format(kind=kind)).dropDuplicates(["id"])
    return read.withColumn("market", F.coalesce("market", F.lit("")))


def _deletion_keys(word: Column) -> Column:
    """Two words one edit apart have one of these in common: the word and all that one left-out letter makes of it; of words
    over 40 letters, which an edit cannot change at both ends, the first and the last 20 letters."""
    all_keys = F.concat(F.array(word), F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substr(word, i + 1))))
    ends = F.array(F.concat(F.substring(word, 1, 20), F.lit("-")), F.concat(F.lit("-"), F.right(word, F.lit(20))))
    return F.array_distinct(F.when(F.length(word) < 40, all_keys).when(F.length(word) == 40, F.concat(all_keys, ends)).otherwise(F.concat(ends, F.when(F.length(word) == 41, all_keys).otherwise(F.array().cast("array<string>")))))


def _near(a: Column, b: Column) -> Column:
    """One edit apart: a letter more, less or different, or two neighbouring letters exchanged."""
    swapped = F.exists(F.sequence(F.lit(1), F.greatest(F.length(a) - 1, F.lit(1))), lambda i: F.concat(F.substring(a, F.lit(1), i - 1), F.substring(a, i + 1, F.lit(1)), F.substring(a, i, F.lit(1)), F.substr(a, i + 2)) == b)
    return (F.levenshtein(a, b) <= 1) | ((F.length(a) == F.length(b)) & swapped)


def brand_spellings(own: DataFrame, base: DataFrame) -> DataFrame:
    """market, w, brand, score: words that may be a brand, as the spelling they stand for.

    `own` (market, w, n, pairs) counts a word's listings and its ordered pairs of listings with equal item, size and fat
    content, `base` (market, base) is the share of such pairs in the market. A brand has few products: two of its listings
    are such a pair far more often (`score` times as often) than any two, while advertising goes with all items and a
    variety with many. A word with a score under BRAND_LIFT is no brand. A spelling one edit from a possible brand stands for
    it where that has TIMES its listings, and RELIABLE at least; words under four letters are never taken for misspelt.
    Candidates meet on left-out letters; only distinct words are joined, never listings.
    """
    scored = own.join(base, "market").withColumn("score", F.when((F.col("n") >= RELIABLE) & (F.col("base") > 0), F.col("pairs") / (F.col("n") * (F.col("n") - 1.0)) / F.col("base"))).withColumn("score", F.when(F.col("score") >= BRAND_LIFT, F.col("score")))
    keyed = scored.where(F.length("w") >= 4).select("market", "w", "n", "score", F.explode(_deletion_keys(F.col("w"))).alias("key"))
    good = keyed.where("score is not null").select("market", "key", F.col("w").alias("other"), F.col("n").alias("other_n"), F.col("score").alias("other_score"))
    near = keyed.select("market", "key", "w", "n").join(good, ["market", "key"]).where(F.col("other_n") >= TIMES * F.col("n")).where(_near(F.col("w"), F.col("other")))
    best = near.groupBy("market", "w").agg(F.max(F.struct("other_n", "other", "other_score")).alias("best"))
    return scored.join(best, ["market", "w"], "left").select("market", "w", F.coalesce("best.other", "w").alias("brand"), F.coalesce("best.other_score", "score").alias("score")).where("score is not null")


def with_brand(read: DataFrame) -> DataFrame:
    """`read` with `brand` (null where none is reliable) and `rest`, the words beside it.

    Of a listing's possible brands the one with the highest score is taken. A word that loses to others in most of its
    listings is the variety of a few products and no brand; the listings are decided again without those.
    """
    words = checkpointed(read.select("id", "market", "item", "size", "fat", F.explode("words").alias("w")))
    counted = words.groupBy("market", "item", "size", "fat", "w").agg(F.count("*").alias("n"))
    own = counted.groupBy("market", "w").agg(F.sum("n").alias("n"), F.sum(F.col("n") * (F.col("n") - 1.0)).alias("pairs"))
    cells = read.groupBy("market", "item", "size", "fat").agg(F.count("*").alias("n")).groupBy("market").agg(F.sum("n").alias("all"), F.sum(F.col("n") * (F.col("n") - 1.0)).alias("pairs"))
    base = cells.select("market", (F.col("pairs") / F.greatest(F.col("all") * (F.col("all") - 1.0), F.lit(1.0))).alias("base"))
    spelled = checkpointed(brand_spellings(own, base))
    possible = checkpointed(words.select("id", "market", "w").join(spelled, ["market", "w"]))

    def chosen(among: DataFrame) -> DataFrame:
        return among.groupBy("id", "market").agg(F.max(F.struct("score", "brand", "w")).alias("best")).select("id", "market", "best.brand", "best.w")

    wins = chosen(possible).groupBy("market", "brand").agg(F.count("*").alias("wins"))
    valid = possible.groupBy("market", "brand").agg(F.count_distinct("id").alias("n")).join(wins, ["market", "brand"]).where("wins * 2 >= n").select("market", "brand")
    best = chosen(possible.join(valid, ["market", "brand"], "left_semi")).select("id", "brand", "w")
    return read.join(best, "id", "left").withColumn("rest", F.when(F.col("w").isNull(), F.col("words")).otherwise(F.array_remove("words", F.col("w")))).drop("w", "words")


CELL = ["market", "item", "size", "fat", "brand"]


def word_meanings(named: DataFrame) -> DataFrame:
    """language, w, meaning of the words that are understood: a variety's common name, or '' for words that tell nothing.

    Listings of one brand, item, size and fat content (a cell) are mostly one product. A word that tells the variety is
    shared by far more pairs of them than chance has it; advertising is not. Two wordings mean the same when, given one
    in a listing, the other is as frequent in further listings of the cell as beside itself; they and what they are linked
    with form a meaning. A word that stands for words of two meanings (a preposition in both) has none. Everything comes
    from counts per cell and word, so listings are never paired; pairs are of distinct words of a cell.
    """
    totals = named.groupBy("language").agg(F.count("*").alias("total"))
    every = named.select("id", "language", *CELL, F.explode("rest").alias("w"))
    frequent = every.groupBy("language", "w").agg(F.count("*").alias("n"))
    sizes = named.where("brand is not null").groupBy(*CELL).agg(F.count("*").alias("size_n")).where("size_n > 1")
    counts = checkpointed(every.where("brand is not null").groupBy("language", *CELL, "w").agg(F.count("*").alias("c")).join(sizes, CELL))
    seen = counts.groupBy("language", "w").agg(F.sum(F.col("c") * (F.col("c") - 1.0)).alias("both"), F.sum(F.col("c") * (F.col("size_n") - 1.0)).alias("open"))
    rates = seen.join(frequent, ["language", "w"]).join(totals, "language").withColumn("chance", F.col("open") * F.col("n") / F.col("total"))
    # Every pair counts twice, so the deviation of a count b is that of b / 2 pairs.
    sure = F.col("both") - 2 * F.sqrt(2 * F.col("both") + 1)
    judged = checkpointed(rates.withColumn("carries", (F.col("both") >= CARRIER_LIFT * F.col("chance")) & (sure >= 1.3 * F.col("chance"))))
    carriers = judged.where("carries").select("language", "w", "both", "open")
    own = checkpointed(counts.join(carriers, ["language", "w"]).select("language", *CELL, "w", "c"))
    of_listing = every.where("brand is not null").join(sizes, CELL, "left_semi").join(carriers.select("language", "w"), ["language", "w"]).groupBy("id", "language").agg(F.collect_list("w").alias("ws")).where(F.size("ws") > 1)
    together = of_listing.select("language", "ws", F.explode("ws").alias("p")).select("language", "p", F.explode("ws").alias("q")).where("p <> q").groupBy("language", "p", "q").agg(F.count("*").alias("same"))
    met = own.withColumnRenamed("w", "p").join(own.select(*[F.col(c).alias(f"{c}_") for c in CELL], F.col("w").alias("q"), F.col("c").alias("d")), [F.col(c) == F.col(f"{c}_") for c in CELL]).where("p <> q").groupBy("language", "p", "q").agg(F.sum(F.col("c") * F.col("d") * 1.0).alias("met"))
    side = {n: carriers.select("language", F.col("w").alias(n), F.col("both").alias(f"both_{n}"), F.col("open").alias(f"open_{n}")) for n in "pq"}
    linked = met.join(together, ["language", "p", "q"], "left").join(side["p"], ["language", "p"]).join(side["q"], ["language", "q"])
    apart = F.col("met") - F.coalesce("same", F.lit(0))
    strength = apart * F.least(F.col("open_q") / (F.col("open_p") * F.col("both_q")), F.col("open_p") / (F.col("open_q") * F.col("both_p")))
    links = checkpointed(linked.select("language", "p", "q", strength.alias("strength")).where(F.col("strength") >= APART))
    strong = links.where(F.col("strength") >= NEAR).select("language", "p", "q")
    two = strong.join(strong.withColumnRenamed("q", "other"), ["language", "p"]).where("q < other")
    unrelated = two.join(links.select("language", F.col("p").alias("q"), F.col("q").alias("other")), ["language", "q", "other"], "left_anti").groupBy("language", F.col("p").alias("w")).agg(F.count("*").alias("n"))
    unrelated = checkpointed(unrelated)
    # A word linked with a bridge may seem to be one; of two that are linked the one that stands between more is.
    around = strong.join(unrelated.select("language", F.col("w").alias("q"), F.col("n").alias("most")), ["language", "q"]).groupBy("language", F.col("p").alias("w")).agg(F.max("most").alias("most"))
    bridges = checkpointed(unrelated.join(around, ["language", "w"], "left").where("n >= coalesce(most, 0)").select("language", "w"))
    ends = [bridges.withColumnRenamed("w", n) for n in "pq"]
    edges = links.where(F.col("strength") >= SAME).join(ends[0], ["language", "p"], "left_anti").join(ends[1], ["language", "q"], "left_anti")
    node = lambda w: F.concat("language", F.lit(" "), F.col(w))
    classes = components(edges.select(node("p").alias("a"), node("q").alias("b")))
    meant = carriers.join(bridges, ["language", "w"], "left_anti").withColumn("node", node("w")).join(classes, "node", "left").select("language", "w", F.coalesce("component", "node").alias("meaning"))
    nothing = judged.where(~F.col("carries") & (F.col("chance") >= EXPECTED)).select("language", "w").unionByName(bridges).withColumn("meaning", F.lit(""))
    return meant.unionByName(nothing)


def brand_parts(named: DataFrame) -> DataFrame:
    """market, brand, w: words seen twice or more, nearly always beside one brand, and thus part of it (`Alpine Farm`, `Alpine Gold`)."""
    pairs = named.select("market", F.coalesce("brand", F.lit("")).alias("brand"), F.explode("rest").alias("w")).groupBy("market", "w", "brand").agg(F.count("*").alias("n"))
    totals = pairs.groupBy("market", "w").agg(F.sum("n").alias("total"))
    return pairs.join(totals, ["market", "w"]).where((F.col("total") >= 2) & (F.col("n") >= 0.8 * F.col("total")) & (F.col("brand") != "")).select("market", "brand", "w")


def identities(named: DataFrame) -> DataFrame:
    """id, maker, variety: the brand as far as it is known, and the meanings of the words beside it.

    Words that tell nothing are left out. A word that is not understood counts only where no brand is reliable: then all such
    words together stand for it.
    """
    meanings = checkpointed(word_meanings(named))
    parts = brand_parts(named).withColumn("part", F.lit(True))
    words = named.select("id", "market", "language", F.coalesce("brand", F.lit("")).alias("brand"), F.explode("rest").alias("w"))
    told = words.join(meanings, ["language", "w"], "left").join(parts, ["market", "brand", "w"], "left")
    unknown = F.col("meaning").isNull() & (F.col("part") | (F.col("brand") == ""))
    found = told.groupBy("id").agg(F.array_sort(F.collect_set(F.when(F.col("meaning") != "", F.col("meaning")))).alias("variety"), F.array_sort(F.collect_set(F.when(unknown, F.col("w")))).alias("beside"))
    return named.select("id", "brand").join(found, "id", "left").select("id", F.concat_ws(" ", F.array_sort(F.array_compact(F.concat(F.array("brand"), F.coalesce("beside", F.array().cast("array<string>")))))).alias("maker"), F.coalesce(F.concat_ws("+", "variety"), F.lit("")).alias("variety"))


def components(edges: DataFrame) -> DataFrame:
    """node, component: the least node that each node of the edges (a, b) is connected with, by propagating the least label and
    following labels of labels; the number of rounds grows with the logarithm of a component's diameter."""
    both = checkpointed(edges.select("a", "b").where("a <> b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")).where("a <> b")).distinct())
    labels = checkpointed(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")))
    while True:
        around = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        nearer = labels.join(around, "node").select("node", F.least("component", "near").alias("new"), "component")
        jumped = nearer.join(labels.select(F.col("node").alias("new"), F.col("component").alias("far")), "new", "left")
        moved = checkpointed(jumped.select("node", F.least("new", F.coalesce("far", "new")).alias("component"), (F.least("new", F.coalesce("far", "new")) < F.col("component")).alias("changed")))
        labels = moved.select("node", "component")
        if moved.where("changed").isEmpty():
            return labels


def _reliable(part: Column) -> Column:
    """A part number that may join listings: five characters, two digits, and not just a number with a unit."""
    return (F.length(part) >= 5) & (F.length(F.regexp_replace(part, "[^0-9]", "")) >= 2) & ~part.rlike("^[0-9]+[a-z]*$")


def _identifiers(grouped: DataFrame) -> DataFrame:
    """key, product: what a listing's identifiers say it is. A GTIN counts by market; a reliable part number by market, item
    and brand (without a known item, by all words, as none of them is known to be the brand). Listings of different sizes have
    different keys; one without a size has that of the only size its identifier is seen with, if there is one."""
    def named(*of: Column) -> Column:
        return F.to_json(F.array(*of)).alias("identifier")

    codes = grouped.where("code is not null").select(named(F.lit("code"), F.col("market"), F.col("code")), "size", "product")
    numbered = grouped.where("parts <> '' and maker <> ''").withColumn("part", F.explode(F.filter(F.split("parts", r"\+"), _reliable)))
    parts = numbered.select(named(F.lit("part"), F.col("market"), F.col("item"), F.col("maker"), F.col("part")), "size", "product")
    seen = checkpointed(codes.unionByName(parts).distinct())
    sizes = seen.groupBy("identifier").agg(F.min("size").alias("one"), F.max("size").alias("other"))
    only = F.when(F.col("one") == F.col("other"), F.col("one"))
    return seen.join(sizes, "identifier").select(F.concat_ws(" ", "identifier", F.coalesce("size", only, F.lit("?"))).alias("key"), "product").distinct()


def group_listings(listings: DataFrame, row: str, wordings: list[tuple[str, str, str]], adjectives: list[tuple[str, str, str]] = ()) -> DataFrame:
    """id, product: the product of each listing, as the least id of its listings (of one of them, where identifiers join
    groups); listings of one product share it. One row per id.

    Same product: same market, brand (a misspelling counts as the brand), item, variety, fat content, part numbers, size of
    the single item and number of items. What is a brand, a variety or mere advertising, and which wordings of a variety are
    the same, is told from counts over all listings (see brand_spellings and word_meanings), not from lists; while there
    are too few listings to tell, all words count. Listings that carry the same valid GTIN, or the same brand, item and
    reliable part number, are one product too, whatever else is known of them, unless their sizes differ; such identifiers
    join groups, and the groups' connected components are the products. A listing without a brand or size that no
    identifier joins is a product of its own. Price and seller do not count. Null, empty and very long titles and null
    markets are allowed; rows with a null id are left out; a repeated id counts once; a title without a size takes it from
    unit and quantity; an empty table gives an empty result.

    Listings are grouped by their parts with partial aggregation, so a hot product is one row a task before the shuffle;
    words are judged from counts per cell; identifiers are reduced to one edge a group and key before components are formed.
    """
    named = checkpointed(with_brand(checkpointed(read_listings(listings, row, wordings, adjectives))))
    whole = checkpointed(named.drop("brand", "rest").join(identities(named), "id"))
    parts = ["market", "item", "size", "fat", "parts", "maker", "variety"]
    known = whole.where("maker <> '' and size is not null")
    groups = known.groupBy(*parts).agg(F.min("id").alias("product"))
    grouped = known.join(groups, parts).unionByName(whole.where("maker = '' or size is null").withColumn("product", F.col("id")), allowMissingColumns=True)
    grouped = checkpointed(grouped.select("id", "product", "market", "item", "size", "code", "parts", "maker"))
    keys = checkpointed(_identifiers(grouped))
    if keys.isEmpty():
        return grouped.select("id", "product")
    edges = keys.join(keys.groupBy("key").agg(F.min("product").alias("least")), "key").select(F.col("product").alias("a"), F.col("least").alias("b"))
    joined = components(edges)
    return grouped.join(joined, grouped["product"] == joined["node"], "left").select("id", F.coalesce("component", "product").alias("product"))


def pairs(grouped: DataFrame) -> DataFrame:
    """a, b: every two listings of one product, a < b. The result itself has all pairs; it is made by an equi-join on the product."""
    left, right = grouped.select("product", F.col("id").alias("a")), grouped.select("product", F.col("id").alias("b"))
    return left.join(right, "product").where("a < b").select("a", "b")
