"""Folding, tokens and stems of multilingual titles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The letters that fold to each plain letter; all others but a-z and 0-9 become a space.
FOLDED = {
    "a": "áäâàãåāăąǎảạắằẳặấầẩẫậæ", "c": "čçćĉċ", "d": "ďđð", "e": "éěëèêēęėĕẻẽẹếềểễệ", "g": "ğģġ", "h": "ħ", "i": "íïìîīıįǐỉĩị", "k": "ķ", "l": "ľĺłļ", "n": "ňñńņ",
    "o": "óöòôõøōőơǒỏọốồổỗộớờởỡợ", "r": "řŕ", "s": "šśşșŝ", "t": "ťþţț", "u": "úůüùûūűưųǔǚủũụứừửữự", "y": "ýÿỳỷỹỵ", "z": "žżź",
}
DOUBLE = {"ß": "ss", "œ": "oe"}
FOLD_FROM, FOLD_TO = "".join(FOLDED.values()), "".join(plain * len(letters) for plain, letters in FOLDED.items())
# Endings that stems lose, by language, longest first.
SUFFIXES = {
    "cs": ["ami", "emi", "ich", "ech", "ach", "ata", "ete", "um", "am", "ou", "em", "im", "ym", "e", "i", "u", "y", "a", "o"],
    "pl": ["ami", "ach", "iem", "ich", "owe", "owy", "owa", "ego", "emu", "ych", "ymi", "ow", "om", "em", "ie", "ia", "iu", "ek", "ka", "ki", "ko", "e", "i", "u", "y", "a", "o"],
    "de": ["chen", "lein", "ern", "en", "er", "es", "em", "st", "e", "n", "s"],
}
SUFFIXES["sk"] = SUFFIXES["cs"]


def fold(text: Column) -> Column:
    """Small letters without marks; everything but a-z and 0-9 becomes one space; trimmed."""
    out = F.lower(text)
    for c, two in DOUBLE.items():
        out = F.replace(out, F.lit(c), F.lit(two))
    return F.trim(F.regexp_replace(F.translate(out, FOLD_FROM, FOLD_TO), "[^a-z0-9]+", " "))


def tokens(folded: Column) -> Column:
    """Tokens of at least two letters of a folded text."""
    return F.filter(F.split(folded, " "), lambda t: F.length(t) >= 2)


def stem_pattern(language: str = "cs") -> str:
    """The shortest start of four letters or more before an ending: what is left without the longest ending."""
    return rf"^(.{{4,}}?)(?:{'|'.join(SUFFIXES[language])})$"


def stem(token: Column, language: str = "cs") -> Column:
    """Without the longest ending of the language that leaves four letters."""
    return F.regexp_replace(token, stem_pattern(language), "$1")


def token_matches(a: Column, b: Column) -> Column:
    """Either is a prefix of the other; equality if the shorter has under three letters; nothing matches an empty token."""
    shorter = F.least(F.length(a), F.length(b))
    return F.when(shorter == 0, F.lit(False)).when(shorter < 3, a == b).otherwise(F.startswith(a, b) | F.startswith(b, a))


def all_tokens_match(query: Column, title: Column) -> Column:
    """Every token of the query matches some token of the title."""
    return F.forall(query, lambda q: F.exists(title, lambda t: token_matches(q, t)))


def collapse(text: Column) -> Column:
    """White space collapsed and trimmed."""
    return F.trim(F.regexp_replace(text, r"[\s\p{Z}]+", " "))


def shortened(text: Column, length: int = 80) -> Column:
    """White space collapsed, cut to a length for display."""
    return F.substring(collapse(text), 1, length)


def without_phrases(folded: Column, phrases: list[str]) -> Column:
    """A folded text without whole phrases, each taken out in turn, as a later one may only then stand together."""
    for phrase in phrases:
        folded = F.regexp_replace(folded, rf"\b{phrase}\b", " ")
    return folded


def content_tokens(folded: Column, noise: list[str]) -> Column:
    """Tokens of two letters or more that are no noise words and no numbers."""
    return F.filter(F.split(folded, " "), lambda t: (F.length(t) >= 2) & ~t.rlike("^[0-9]+$") & (~t.isin(*noise) if noise else F.lit(True)))


def clean_stems(text: Column, language: str = "cs", phrases: list[str] = (), noise: list[str] = ()) -> Column:
    """STRUCT<stems, reduced>: stems of a name without noise phrases, noise words and numbers, and whether a phrase was taken
    out. Where nothing is left the tokens as they were count."""
    whole = fold(text)
    rest = without_phrases(whole, list(phrases))
    kept = content_tokens(rest, list(noise))
    stems = F.transform(F.when(F.size(kept) > 0, kept).otherwise(tokens(rest)), lambda t: stem(t, language))
    return F.struct(stems.alias("stems"), (rest != whole).alias("reduced"))


# Words that leaflet text fragments begin with.
FRAGMENT_STARTS = "s se z ze v ve na k ke o do pro bez od a i nebo".split()


def is_fragment(title: Column) -> Column:
    """The title begins with a small letter or with one of FRAGMENT_STARTS."""
    first = F.substring(F.trim(title), 1, 1)
    small = (F.lower(first) == first) & (F.upper(first) != first)
    return F.coalesce((F.trim(title) != "") & (small | F.split(fold(title), " ")[0].isin(*FRAGMENT_STARTS)), F.lit(False))


def percents(title: Column) -> Column:
    """All percentages of a title, in order."""
    return F.transform(F.regexp_extract_all(title, F.lit(r"(?<![\p{L}\p{N}_,.])(\d+(?:[.,]\d+)?)\s*%"), F.lit(1)), lambda p: F.translate(p, ",", ".").cast("double"))


def rule_regex(pattern: Column) -> Column:
    """The regular expression of a rule's pattern, for folded titles: `re:x` and `/x/` as written, `sub:x` anywhere in the title, else the
    folded text as whole words. Null where nothing is left to match."""
    bare = F.trim(pattern)
    quoted = lambda t: F.regexp_replace(t, "([^a-z0-9 ])", r"\\$1")
    inside, word = fold(F.substring(bare, 5, 1 << 30)), fold(bare)
    return (
        F.when(bare.startswith("re:"), F.concat(F.lit("(?i)"), F.substring(bare, 4, 1 << 30)))
        .when(bare.startswith("sub:"), quoted(inside))
        .when((F.length(bare) > 2) & bare.startswith("/") & bare.endswith("/"), F.concat(F.lit("(?i)"), F.regexp_extract(bare, "^/(.*)/$", 1)))
        .when(word != "", F.concat(F.lit("(?<![a-z0-9])"), quoted(word), F.lit("(?![a-z0-9])")))
    )


def known_name(value: Column, names: list[str], aliases: dict[str, str] | None = None) -> Column:
    """The name of an ordered list that a text means: itself, folded, by alias, by folded or run-together name, else the first
    in order whose folded name it begins with. Null where none does."""
    raw, folded = F.trim(value), fold(value)
    compact = F.replace(folded, F.lit(" "), F.lit(""))
    plain = [(n, fold_plain(n)) for n in names]
    found = F.when(raw.isin(*names), raw).when(folded.isin(*names), folded)
    for alias, name in (aliases or {}).items():
        if name in names:
            found = found.when(folded == alias, F.lit(name))
    for form in (folded, compact):
        for name, own in plain:
            found = found.when(form == own, F.lit(name))
    for name, own in plain:
        found = found.when(folded.startswith(own) | compact.startswith(own), F.lit(name))
    return F.when(raw != "", found)


def fold_plain(text: str) -> str:
    """fold for a constant of the program."""
    table = str.maketrans(FOLD_FROM, FOLD_TO)
    low = text.lower()
    for c, two in DOUBLE.items():
        low = low.replace(c, two)
    return " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in low.translate(table)).split())


def catalogue_names(language: str) -> Column:
    """What an entry of a catalogue is called in a language, in order of preference: the language's own names first, then the
    Czech ones; aliases are Czech, and near enough to Slovak."""
    own = [] if language == "cs" else [F.col("names")[language], F.col("names_plural")[language]]
    listed = F.array_compact(F.array(*own, "name_cs", "name_plural_cs"))
    return F.filter(F.concat(listed, F.coalesce("aliases", F.array().cast("array<string>"))) if language in ("cs", "sk") else listed, lambda n: n != "")


def error_kind(code: Column, status: Column, message: Column) -> Column:
    """What an error is about, by the first test that holds: no connection, no rights, not there, taken, too many, too large, the
    service's own fault, else other."""
    low = F.lower(F.coalesce(message, F.lit("")))
    return (
        F.when((status == 0) | low.rlike("failed to fetch|network|timeout"), "network").when(status.isin(401, 403) | low.rlike("jwt|not authori[sz]ed|permission"), "access")
        .when((status == 404) | (code == "42P01") | low.rlike("not found|does not exist"), "missing").when((status == 409) | (code == "23505"), "conflict")
        .when(status == 429, "rate").when(status == 413, "size").when(status >= 500, "server").otherwise("other")
    )


def plain_html(html: Column) -> Column:
    """The text of a piece of HTML: tags out, the usual entities resolved, white space collapsed."""
    out = F.regexp_replace(html, r"(?s)<[^>]*>", " ")
    for entity, c in (("nbsp", " "), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "'"), ("amp", "&")):
        out = F.replace(out, F.lit(f"&{entity};"), F.lit(c))
    return collapse(out)


def counted(n: Column, one: str, few: str, many: str) -> Column:
    """A number with the word for it: one, two to four, or more (and none)."""
    return F.concat_ws(" ", n.cast("string"), F.when(n == 1, one).when(n.between(2, 4), few).otherwise(many))
