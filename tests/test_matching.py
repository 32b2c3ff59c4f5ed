"""Scores of titles against a plain version of the same rules, row by row."""

import math
import random

from pyspark.sql import functions as F

from pricelode.functions import text
from pricelode.operators import matching


def _matches(a, b):
    short = min(len(a), len(b))
    return (a == b) if short < 3 else a.startswith(b) or b.startswith(a)


def _plain_scores(stems, n_raw, allowed, names, negatives, generic):
    best = {}
    for item, category, variant, name_stems, weight in sorted(names, key=lambda v: (v[0], v[2])):
        used, total = [], 0.0
        for n in name_stems:
            free = [i for i in range(len(stems)) if i not in used]
            exact = [i for i in free if stems[i] == n]
            near = [i for i in free if _matches(n, stems[i])]
            if not near and not exact:
                break
            used.append((exact or near)[0])
            total += 1.0 if exact else 0.8
        else:
            score = total / len(name_stems) * (0.45 + 0.55 * math.sqrt(len(used) / len(stems))) * weight
            if 0 not in used and len(used) < len(stems):
                score *= 0.93
            if len(name_stems) == 1 and name_stems[0] in generic and len(used) == len(stems) and n_raw > len(stems):
                score = min(score, 0.8)
            if item not in best or score > best[item][0]:
                best[item] = (score, category)
    out = {}
    for item, (score, category) in best.items():
        if any(s.startswith(n) or (len(s) >= 4 and n.startswith(s)) for n in negatives.get(item, []) for s in stems):
            score *= 0.25
        if allowed is not None:
            score *= 0.1 if "" in allowed else 1.0 if category in allowed else 0.5
        out[item] = score
    ranked = sorted(out.items(), key=lambda x: (-x[1], x[0]))
    if len(ranked) > 1 and ranked[0][1] >= 0.6 and ranked[0][1] - ranked[1][1] < 0.03:
        ranked = sorted([(ranked[0][0], ranked[0][1] * 0.85), *ranked[1:]], key=lambda x: (-x[1], x[0]))
    return [(item, round(score, 4)) for item, score in ranked]


def test_scores_equal_the_plain_rules(spark):
    random.seed(4)
    stock = ["masl", "maslov", "syr", "syre", "goud", "gouda", "ab", "abc", "mlek", "mle", "vod", "voda", "olej", "x1", "kakaov"]
    names = [(f"i{k % 9}", random.choice(["dairy", "oil"]), k // 9, tuple(random.sample(stock, random.randint(1, 3))), random.choice([1.0, 0.95])) for k in range(25)]
    category = {n[0]: n[1] for n in names}
    names = [(i, category[i], v, s, w) for i, _, v, s, w in names]
    titles = [(t, [random.choice(stock) for _ in range(random.randint(1, 5))], random.randint(1, 7), random.choice([None, [""], ["dairy"]])) for t in range(150)] + [(999, [], 0, None)]
    negatives = {"i1": ["kaka"], "i2": ["olejov"]}
    got: dict = {}
    out = matching.score_titles(
        spark.createDataFrame([(t, s, n, None, a) for t, s, n, a in titles], "row int, stems array<string>, n_raw int, percents array<double>, allowed array<string>"),
        spark.createDataFrame([(i, c, v, "n", list(s), w) for i, c, v, s, w in names], "item string, category string, variant int, name string, stems array<string>, weight double"),
        negatives=spark.createDataFrame([(i, n) for i, own in negatives.items() for n in own], "item string, stem string"), generic=["syr", "olej"])
    for r in out.orderBy("row", "place").collect():
        got.setdefault(r.row, []).append((r.item, r.score))
    wanted = {t: scores for t, s, n, a in titles if s and (scores := _plain_scores(s, n, a, names, negatives, ["syr", "olej"]))}
    assert {t: [i for i, _ in v] for t, v in got.items()} == {t: [i for i, _ in v] for t, v in wanted.items()}
    assert all(abs(x - y) <= 1e-4 for t in wanted for (_, x), (_, y) in zip(got[t], wanted[t]))


def test_siblings_hints_and_priors(spark):
    titles = spark.createDataFrame([
        (1, ["mlek", "tuk"], 2, [1.5], None), (2, ["mlek", "plnotucn"], 2, [], None), (3, ["mlek"], 1, None, None), (4, ["smetan", "mlek"], 2, None, None), (5, ["chleb"], 1, None, None),
    ], "row int, stems array<string>, n_raw int, percents array<double>, allowed array<string>")
    names = spark.createDataFrame([("mleko_15", "dairy", 0, "m", ["mlek"], 1.0), ("mleko_35", "dairy", 0, "m", ["mlek"], 0.9), ("mleko_kokos", "other", 0, "m", ["mlek"], 0.93)], "item string, category string, variant int, name string, stems array<string>, weight double")
    siblings = spark.createDataFrame([(1, 0, "mleko_05", 1.0, ["odtucn"], False), (1, 1, "mleko_15", 2.5, ["polotucn"], True), (1, 2, "mleko_35", float("inf"), ["plnotucn"], False)], "group_no int, ordinal int, item string, below double, keywords array<string>, is_default boolean")
    hints = spark.createDataFrame([("smetan", ["dairy"])], "stem string, categories array<string>")
    ranked = matching.score_titles(titles, names, siblings=siblings, title_hints=hints)
    best = {r.row: r.item for r in ranked.where("place = 1").collect()}
    assert best[2] == "mleko_35" and 5 not in best
    scores = {(r.row, r.item): r.score for r in ranked.collect()}
    assert scores[4, "mleko_kokos"] < 0.5 < scores[4, "mleko_15"]
    low = matching.score_titles(titles.where("row = 1").withColumn("percents", F.array(F.lit(0.1))), names, siblings=siblings)
    assert ("mleko_05", True) in {(r.item, r.score > 0) for r in low.collect()}  # made, as the group chose one that no name led to
    priors = spark.createDataFrame([(3, "mleko_kokos"), (1, "nothing")], "row int, item string")
    chosen = {r.row: (r.item, r.score) for r in matching.with_prior(ranked, priors).collect()}
    assert chosen[3] == ("mleko_kokos", max(0.9, scores[3, "mleko_kokos"])) and chosen[1][0] == best[1]


def test_names_and_title_parts(spark):
    catalogue = spark.createDataFrame([("a", "veg", "Mrkev bez kosti", "mrkve", {"sk": "mrkva"}, None, ["mrkve", "extra"]), (None, "x", "y", None, None, None, None)], "id string, category string, name_cs string, name_plural_cs string, names map<string,string>, names_plural map<string,string>, aliases array<string>")
    got = {(r.variant, r.name, tuple(r.stems), r.weight) for r in matching.variants(catalogue, "cs", ["bez kosti"], ["extra"]).collect()}
    assert got == {(0, "Mrkev bez kosti", ("mrkev",), 0.95), (1, "mrkve", ("mrkv",), 1.0), (2, "extra", ("extr",), 1.0)}
    assert [r.name for r in matching.variants(catalogue, "sk").orderBy("variant").collect()][0] == "mrkva"
    title = spark.createDataFrame([("Leerdammer plátkový sýr 2x100 g 45% akce",), ("s vepřovým masem",), (None,), ("",)], "t string")
    rows = title.select(matching.title_parts(F.col("t"), "cs", [], ["akce"], ["Leerdammer"]).alias("p")).select("p.*").collect()
    assert (rows[0].stems, rows[0].n_raw, rows[0].percents, rows[0].fragment) == ([text_stem(spark, "platkovy"), "syr"], 3, [45.0], False)
    assert rows[1].fragment and not rows[3].stems


def text_stem(spark, word):
    return spark.createDataFrame([(word,)], "w string").select(text.stem(F.col("w")).alias("s")).first().s


def test_category_hints(spark):
    rules = [("zahrad", []), ("maso", ["meat", "poultry"]), ("mraz", None), ("drubez", ["poultry"])]
    rows = spark.createDataFrame([("Maso a drůbež",), ("Zahrada, maso",), ("mražené",), ("",), (None,)], "t string")
    assert [r.h for r in rows.select(matching.category_hint(F.col("t"), rules).alias("h")).collect()] == [["meat", "poultry"], [""], None, None, None]


def test_one_title_is_explained(spark):
    names = spark.createDataFrame([("maslo", "dairy", 0, "máslo", ["masl"], 1.0), ("mleko", "dairy", 0, "mléko", ["mlek"], 1.0)], "item string, category string, variant int, name string, stems array<string>, weight double")
    rows = matching.explain_title(spark, "Čerstvé máslo 250 g akce", names, noise=["akce"]).collect()
    assert [(r.item, r.name, r.place) for r in rows] == [("maslo", "máslo", 1)] and rows[0].score == round((0.45 + 0.55 * math.sqrt(0.5)) * 0.93, 4)
