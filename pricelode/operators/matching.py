"""Scoring of titles against the names of a catalogue: blocked candidates, greedy matching of stems, penalties and ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricelode.functions import text as T

# The weights of a score.
PREFIX, BASE, COVERED = 0.8, 0.45, 0.55
HEAD, GENERIC, REDUCED = 0.93, 0.80, 0.95
NEGATIVE, WRONG_CATEGORY, NOT_FOOD, SIBLING = 0.25, 0.5, 0.1, 0.6
CLOSE_MARGIN, CLOSE_FROM, CLOSE_FACTOR = 0.03, 0.60, 0.85
PRIOR_FROM, PRIOR_MARGIN, PRIOR_SCORE = 0.60, 0.10, 0.9


def variants(catalogue: DataFrame, language: str, phrases: list[str] = (), noise: list[str] = ()) -> DataFrame:
    """item, category, variant (0-based, in order of preference), name, stems, weight: the ways an entry is called; ways with equal stems count once."""
    named = catalogue.where("id is not null").select(F.col("id").alias("item"), "category", F.posexplode(T.catalogue_names(language)).alias("place", "name"))
    cleaned = named.withColumn("c", T.clean_stems(F.col("name"), language, phrases, noise)).where(F.size("c.stems") > 0)
    first = cleaned.groupBy("item", "category", F.col("c.stems").alias("stems")).agg(F.min_by(F.struct("name", "c.reduced", "place"), "place").alias("first"))
    order = Window.partitionBy("item").orderBy("first.place")
    return first.select("item", "category", (F.row_number().over(order) - 1).alias("variant"), "first.name", "stems", F.when(F.col("first.reduced"), REDUCED).otherwise(1.0).alias("weight"))


def title_parts(title: Column, language: str = "cs", phrases: list[str] = (), noise: list[str] = (), brands: list[str] = (), dropped: list[str] = ()) -> Column:
    """STRUCT<stems, n_raw, percents, fragment>: what a title says, without sizes, percentages, noise phrases, brands (the longest
    first) and noise words. n_raw counts the tokens before brands and `dropped` words are taken out."""
    bare = F.regexp_replace(title, r"(?iu)\d+(?:[.,]\d+)?\s*%|(?<![\p{L}\p{N}.,])(?:\d+\s*[x×]\s*)?\d+(?:[.,]\d+)?\s*(?:kg|g|dkg|dag|ml|cl|dl|l|ks|kus|kusy|kusů|kusu)(?![\p{L}])", " ")
    plain = T.without_phrases(T.fold(bare), list(phrases))
    kept = T.content_tokens(T.without_phrases(plain, sorted((T.fold_plain(b) for b in brands), key=len, reverse=True)), [*noise, *dropped])
    return F.struct(
        F.transform(kept, lambda t: T.stem(t, language)).alias("stems"), F.size(T.content_tokens(plain, list(noise))).alias("n_raw"),
        T.percents(title).alias("percents"), T.is_fragment(title).alias("fragment"))


def _greedy(title: Column, name: Column) -> Column:
    """STRUCT<used ARRAY<INT>, total, ok>: each stem of a name takes the first unused equal stem of the title, else the first unused one that
    either begins with the other; ok if all found one."""
    def step(state: Column, stem: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(title))
        free = F.filter(places, lambda i: ~F.array_contains(state["used"], i))
        equal = F.try_element_at(F.filter(free, lambda i: F.element_at(title, i) == stem), F.lit(1))
        prefix = F.try_element_at(F.filter(free, lambda i: T.token_matches(stem, F.element_at(title, i))), F.lit(1))
        at = F.coalesce(equal, prefix)
        taken = F.struct(
            F.array_append(state["used"], at).alias("used"), (state["total"] + F.when(equal.isNotNull(), 1.0).otherwise(PREFIX)).alias("total"), F.lit(True).alias("ok"))
        lost = F.struct(state["used"].alias("used"), state["total"].alias("total"), F.lit(False).alias("ok"))
        return F.when(state["ok"] & at.isNotNull(), taken).otherwise(lost)

    start = F.struct(F.array().cast("array<int>").alias("used"), F.lit(0.0).alias("total"), F.lit(True).alias("ok"))
    return F.aggregate(name, start, step)


def candidates(titles: DataFrame, names: DataFrame) -> DataFrame:
    """Rows of `titles` (row, stems, ...) with each name (see variants) all of whose stems they hold, and its `match` (see _greedy).

    A name's longest stem must be found, so the two meet on its first three letters: one key a name, a few a title, and no
    pair twice.
    """
    longest = F.array_max(F.transform("stems", lambda s: F.struct(F.length(s), s.alias("stem"))))["stem"]
    blocks = names.select(F.substring(longest, 1, 3).alias("block"), "item", "category", "variant", "name", F.col("stems").alias("name_stems"), "weight")
    met = titles.withColumn("block", F.explode(F.array_distinct(F.transform("stems", lambda s: F.substring(s, 1, 3))))).join(blocks, "block").drop("block")
    return met.withColumn("match", _greedy(F.col("stems"), F.col("name_stems"))).where("match.ok")


def negative_hit(stems: Column, negatives: Column) -> Column:
    """A stem begins with a negative, or is the beginning (four letters or more) of one."""
    return F.coalesce(F.exists(negatives, lambda n: F.exists(stems, lambda s: s.startswith(n) | ((F.length(s) >= 4) & n.startswith(s)))), F.lit(False))


def category_hint(text: Column, rules: list[tuple[str, list[str] | None]]) -> Column:
    """The categories that ordered rules (pattern, categories) allow for a source's category text: the union of all that match, ['']
    from the first that has no category to allow (`[]`: not to be matched at all), null where none has an opinion (None)."""
    low, folded = F.lower(text), T.fold(text)
    hit = lambda p: low.rlike(p) | folded.rlike(p)
    barred = F.lit(False)
    allowed = F.array().cast("array<string>")
    for pattern, own in rules:
        if own == []:
            barred = barred | hit(pattern)
        elif own:
            allowed = F.array_union(allowed, F.when(hit(pattern), F.array(*map(F.lit, own))).otherwise(F.array().cast("array<string>")))
    return F.when(barred, F.array(F.lit(""))).when(F.size(allowed) > 0, allowed)


def score_titles(titles: DataFrame, names: DataFrame, *, negatives: DataFrame | None = None, siblings: DataFrame | None = None, generic: list[str] = (), title_hints: DataFrame | None = None) -> DataFrame:
    """row, item, variant name, score, negative, place: every catalogue item a title may mean, best first (place 1).

    `titles`: row (unique), stems, n_raw, percents, allowed (see category_hint; may be null). `names`: see variants. A name
    counts if all its stems are found; its score grows with the share of the title that it covers, is lowered if it skips the
    title's first stem, and capped for one `generic` stem beside dropped words. The best name of an item counts, the first
    among equals. Penalties follow for `negatives` (item, stem), for a category that the source or a strong title stem
    (`title_hints`: stem, categories) does not allow. `siblings` (group_no, ordinal, item, below, keywords, is_default) are items
    that share names: the one that a percentage, else a keyword, else the default chooses gets the group's best score, the
    others lose. If the two best are closer than CLOSE_MARGIN the first is lowered and the order made anew.

    Titles without stems have no rows. Native expressions only; the catalogue side is as small as the catalogue, and Spark decides
    by its size whether to broadcast it.
    """
    n = F.size("stems")
    used = F.size("match.used")
    cover = F.col("match.total") / F.size("name_stems") * (BASE + COVERED * F.sqrt(used / n)) * F.col("weight")
    headed = F.when(~F.array_contains("match.used", 1) & (used < n), cover * HEAD).otherwise(cover)
    vague = (F.size("name_stems") == 1) & F.col("name_stems")[0].isin(*generic) & (used == n) & (F.col("n_raw") > n) if generic else F.lit(False)
    scored = candidates(titles, names).withColumn("score", F.when(vague, F.least(headed, F.lit(GENERIC))).otherwise(headed))
    best = scored.groupBy("row", "item").agg(
        F.max_by(F.struct("name", "score", "category", "stems", "percents", "allowed"), F.struct("score", -F.col("variant"))).alias("b")).select("row", "item", "b.*")
    if negatives is not None:
        held = negatives.groupBy("item").agg(F.collect_set(T.fold(F.col("stem"))).alias("negatives"))
        best = best.join(held, "item", "left").withColumn("negative", negative_hit(F.col("stems"), F.col("negatives"))).drop("negatives")
    else:
        best = best.withColumn("negative", F.lit(False))
    score = F.when(F.col("negative"), F.col("score") * NEGATIVE).otherwise(F.col("score"))
    barred = F.coalesce(F.array_contains("allowed", ""), F.lit(False))
    score = F.when(barred, score * NOT_FOOD).when(F.col("allowed").isNotNull() & ~F.array_contains("allowed", F.col("category")), score * WRONG_CATEGORY).otherwise(score)
    best = best.withColumn("score", score)
    if title_hints is not None:
        hints = title_hints.select(F.substring("stem", 1, 3).alias("block"), F.col("stem").alias("key"), "categories")
        strong = titles.select("row", F.explode("stems").alias("s")).withColumn("block", F.substring("s", 1, 3)).join(hints, "block").where((F.col("s") == F.col("key")) | ((F.length("key") >= 5) & F.col("s").startswith(F.col("key"))))
        wanted = strong.groupBy("row").agg(F.array_distinct(F.flatten(F.collect_set("categories"))).alias("wanted"))
        best = best.join(wanted, "row", "left").withColumn("score", F.when(F.col("wanted").isNotNull() & ~F.array_contains("wanted", F.col("category")), F.col("score") * WRONG_CATEGORY).otherwise(F.col("score"))).drop("wanted")
    if siblings is not None:
        best = _siblings(best, siblings)
    order = Window.partitionBy("row").orderBy(F.desc("score"), "item")
    first = best.withColumn("k", F.row_number().over(order)).withColumn("following", F.lead("score").over(order))
    unsure = (F.col("k") == 1) & (F.col("score") >= CLOSE_FROM) & F.coalesce(F.col("score") - F.col("following") < CLOSE_MARGIN, F.lit(False))
    settled = first.withColumn("score", F.when(unsure, F.col("score") * CLOSE_FACTOR).otherwise(F.col("score")))
    final = settled.withColumn("place", F.row_number().over(order))
    return final.select("row", "item", "name", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.round("score", 4))).alias("score"), "negative", "place")


def _siblings(best: DataFrame, siblings: DataFrame) -> DataFrame:
    """Scores after each group of siblings has chosen one of them, in the order of the groups' numbers (an item is in one group)."""
    groups = siblings.groupBy("group_no").agg(
        F.array_sort(F.collect_list(F.when(F.col("below").isNotNull(), F.struct("below", "item")))).alias("bands"),
        F.array_sort(F.collect_list(F.when(F.size("keywords") > 0, F.struct("ordinal", "item", "keywords")))).alias("words"), F.max(F.when(F.col("is_default"), F.col("item"))).alias("usual"))
    member = siblings.select("item", "group_no")
    present = best.join(member, "item").groupBy("row", "group_no").agg(F.max("score").alias("top"), F.first("stems").alias("stems"), F.array_min(F.first("percents")).alias("percent"), F.min_by(F.struct("name", "category", "percents", "allowed", "negative"), "item").alias("like"))
    asked = present.join(groups, "group_no")
    by_percent = F.try_element_at(F.filter("bands", lambda b: F.col("percent") < b["below"]), F.lit(1))["item"]
    by_word = F.try_element_at(F.filter("words", lambda w: F.exists(w["keywords"], lambda k: F.exists("stems", lambda s: s.startswith(k)))), F.lit(1))["item"]
    chosen = asked.withColumn("chosen", F.coalesce(by_percent, by_word, F.col("usual"))).where("chosen is not null").select("row", "group_no", "chosen", "top", "stems", "like")
    tagged = best.join(member, "item", "left").join(chosen.select("row", "group_no", "chosen", "top"), ["row", "group_no"], "left")
    kept = tagged.withColumn("score", F.when(F.col("chosen").isNull(), F.col("score")).when(F.col("chosen") == F.col("item"), F.col("top")).otherwise(F.col("score") * SIBLING)).select(*best.columns)
    absent = chosen.join(best.select("row", F.col("item").alias("chosen")), ["row", "chosen"], "left_anti")
    made = absent.select("row", F.col("chosen").alias("item"), "like.name", F.col("top").alias("score"), "like.category", "stems", "like.percents", "like.allowed", "like.negative")
    return kept.unionByName(made.select(*best.columns))


def with_prior(ranked: DataFrame, priors: DataFrame) -> DataFrame:
    """row, item, score of each title's item: the best one, or the one that the search it came from (`priors`: row, item) was for, if that has a score of
    PRIOR_FROM and no negative and is within PRIOR_MARGIN of the best; its score is then PRIOR_SCORE at least."""
    best = ranked.where("place = 1").select("row", F.col("item").alias("best_item"), F.col("score").alias("best_score"))
    own = ranked.join(priors.select("row", "item"), ["row", "item"]).where(~F.col("negative") & (F.col("score") >= PRIOR_FROM)).select("row", F.col("item").alias("own_item"), F.col("score").alias("own_score"))
    joined = best.join(own, "row", "left")
    takes = F.coalesce(F.col("own_score") >= F.col("best_score") - PRIOR_MARGIN, F.lit(False))
    return joined.select("row", F.when(takes, F.col("own_item")).otherwise(F.col("best_item")).alias("item"), F.when(takes, F.greatest("own_score", F.lit(PRIOR_SCORE))).otherwise(F.col("best_score")).alias("score"))


def explain_title(spark: SparkSession, title: str, names: DataFrame, language: str = "cs", **parts: list[str]) -> DataFrame:
    """score_titles of one title: what it may mean, and by which name; `parts` as for title_parts."""
    one = spark.createDataFrame([(0, title)], "row int, title string").select("row", title_parts(F.col("title"), language, **parts).alias("p"))
    return score_titles(one.select("row", "p.stems", "p.n_raw", "p.percents", F.lit(None).cast("array<string>").alias("allowed")), names)
