import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pricelode.llm import duplicates, packing, percentiles, products, registry, sentences, tokens
from tests.oracle import same_rows


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_equals_sql(spark, root, name):
    same_rows(registry.QUERIES[name](spark, root), registry.SQL[name], root)


def test_duplicates(spark):
    rows = [
        (5, "Máslo 1,8 kg", 1.0, "2026-06-01", '{"a": 1, "b": ["x" , "y"]}'), (3, " máslo\xa0| 1.8 KG!", 1.0, "2026/06/01", '{"b":["x","y"],"a":1}'),
        (4, "Máslo 18 kg", 1.0, "2026-06-01", '{"a": 1, "b": ["x", "y"]}'), (6, "Máslo 1,8 kg", 1.0, "2026-06-01", '{"a": 1, "b": ["y", "x"]}'),
        (7, "Máslo 1,8 kg", None, "2026-06-01", '{"a": 1, "b": ["x", "y"]}'), (8, None, None, None, None), (9, None, None, None, None), (10, "", None, None, None),
        (11, "  ", None, None, None), (12, "", None, None, "no object"), (13, "", None, None, "No Object."), (None, "", None, None, None), (3, " máslo\xa0| 1.8 KG!", 1.0, "2026/06/01", '{"b":["x","y"],"a":1}'),
    ]
    kinds = {"title": "text", "price": "number", "day": "date", "raw": "json"}
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "id int, title string, price double, day string, raw string, f0 string")
    found = duplicates.collapse_formatting(frame, "id", kinds)
    assert {tuple(r) for r in found.collect()} == {(3, 5), (8, 9), (10, 11), (12, 13)}
    assert {tuple(r) for r in duplicates.copy_counts(found).collect()} == {(3, 2), (8, 2), (10, 2), (12, 2)}
    hot = spark.range(2000).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.lit("Same")).otherwise(F.col("id").cast("string")).alias("title"))
    assert duplicates.collapse_formatting(hot, "id", {"title": "text"}).count() == 666
    assert duplicates.collapse_formatting(frame.limit(0), "id", kinds).count() == 0


def test_nested_objects_and_single_records(spark):
    rows = [
        (1, '{"a": {"x": 1, "y": [{"p": null, "q": "b"}]}, "b": 2}'), (2, '{"b": 2, "a": {"y": [{"q": "b", "p": null}], "x": 1}}'), (3, '{"b": 2, "a": {"y": [{"q": "b"}], "x": 1}}'),
        (4, '{"a": {"x": 12345678901234567890123456789012345678901, "y": 1}}'), (5, '{"a": {"x": 12345678901234567890123456789012345678902, "y": 1}}'), (None, '{"a": 1}'),
    ]
    frame = spark.createDataFrame(rows, "id int, raw string")
    found = duplicates.collapse_formatting(frame, "id", {"raw": "json"})
    assert {tuple(r) for r in found.collect()} == {(1, 2)}
    assert {tuple(r) for r in duplicates.records(frame, "id", found).collect()} == {(1, 2), (3, 1), (4, 1), (5, 1)}


@pytest.mark.parametrize("parts, by_share", [(2, False), (7, True), (256, True)])
def test_percentiles_equal_numpy(spark, parts, by_share):
    random.seed(parts)
    values = {"a": [random.lognormvariate(0, 3) * random.choice([1, -1]) for _ in range(500)], "b": [7.5] * 40, None: [0.0, -0.0, 1e300, -1e300, 5e-324], "c": [1.0]}
    rows = [(g, v, i % 4) for g, own in values.items() for i, v in enumerate(own)] + [("d", None, 1), ("d", float("nan"), 1), ("b", None, 0)]
    frame = percentiles.numeric_rows(spark.createDataFrame(rows, "g string, low double, share int"), ["g"], F.col("low"), F.col("share") if by_share else None)
    fractions = [0.0, 0.05, 0.5, 0.99, 1.0]
    out = percentiles.percentiles(frame, fractions, parts=parts)
    got = {(r.g, r.fraction): (r.value, r.n) for r in out.collect()}
    assert set(got) == {(g, f) for g in values for f in fractions}
    for (g, f), (value, n) in got.items():
        own = sorted(values[g])
        place = f * (len(own) - 1)
        a, b = own[math.floor(place)], own[math.ceil(place)]
        assert n == len(own) and math.isclose(value, a + (b - a) * (place - math.floor(place)) if a != b else a, rel_tol=1e-12, abs_tol=1e-300)
    assert percentiles.percentiles(frame.limit(0), [0.5]).count() == 0


def test_percentiles_with_error(spark):
    frame = percentiles.numeric_rows(spark.range(1, 20001).select(F.lit(1).alias("g"), F.col("id").cast("double").alias("v")), ["g"], F.col("v"))
    out = percentiles.percentiles(frame, [0.25, 0.5], error=0.01)
    assert all(abs(r.value - (1 + r.fraction * 19999)) <= 0.01 * r.value for r in out.collect())


def test_states_of_days_merge_in_any_order(spark, monkeypatch):
    random.seed(5)
    days = [spark.createDataFrame([(i % 3, random.lognormvariate(3, 1)) for i in range(200)], "g int, low double") for _ in range(4)]
    rows = [percentiles.numeric_rows(d, ["g"], F.col("low")) for d in days]
    every = rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3]).cache()
    one = sorted(tuple(r) for r in percentiles.percentiles(every, [0.05, 0.5, 0.95]).collect())
    passes = []
    narrowed = percentiles._narrowed
    monkeypatch.setattr(percentiles, "_narrowed", lambda *a: passes.append(1) or narrowed(*a))
    for order in ([0, 1, 2, 3], [3, 1, 0, 2]):
        apart = [percentiles.interval_states(rows[i]) for i in order]
        first = percentiles.merged_states(apart[0].unionByName(apart[1]))
        last = percentiles.merged_states(apart[2].unionByName(apart[3]))
        states = first.unionByName(last)
        passes.clear()
        assert sorted(tuple(r) for r in percentiles.percentiles(every, [0.05, 0.5, 0.95], states=states).collect()) == one
        assert len(passes) > 1  # intervals of several values are narrowed on, however few rows they have
        near = {tuple(r)[:3]: r.value for r in percentiles.bounded_percentiles(states, [0.05, 0.5, 0.95]).collect()}
        assert all(abs(near[g, n, f] / v - 1) <= 1 / 64 for g, n, f, v in one)


def test_tokens_equal_the_library(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokens.TOKENIZER)
    tokenizer.encode_special_tokens = True
    texts = ["Máslo 250 g", "", None, "   ", "<|endoftext|>", "a" * 3000, "ab" * 501, "!!!!!!!", "中文没有空格的长句子" * 30, "it's\n\n we'll  go", "👩‍👧", "x " * 20000]
    frame = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "id int, text string, out int")
    got = {r.id: list(r.ids) for r in tokens.token_ids(frame, "id", F.col("text")).collect()}
    want = {i: tokenizer.encode(t, add_special_tokens=False).ids if t else [] for i, t in enumerate(texts)}
    assert got == want
    assert {r.id: r.n_tokens for r in tokens.token_counts(frame, "id", F.col("text")).collect()} == {i: len(x) for i, x in want.items()}
    assert tokens.token_ids(frame.limit(0), "id", F.col("text")).count() == 0


def test_decoding(spark):
    frame = spark.createDataFrame([(1, [], "c"), (2, None, "c"), (3, [999_999_999], "c")], "id int, ids array<int>, text string")
    assert {tuple(r) for r in tokens.token_texts(frame, "id", "ids").collect()} == {(1, ""), (2, None), (3, "")}
    texts = ["\x00<|endoftext|> a\u0301 \U0001f600\r\n\t ", "ab" * 3_000, "x" * 9_001]
    given_texts = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    out = tokens.token_texts(tokens.token_ids(given_texts, "id", F.col("text")), "id", "ids")
    assert [r.text for r in out.orderBy("id").collect()] == texts


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=80))
def test_bins_hold_all_and_improve(sizes):
    bins = packing.pack_sizes(sizes, 100)
    fill = np.bincount(bins, sizes) if sizes else np.array([])
    assert (fill <= 100).all() and (fill > 0).all()
    start = packing.Bins(100)
    start.pack(sizes)
    assert len(fill) <= len(start.items)


def test_local_search_empties_a_bin():
    bins = packing.Bins(10)
    bins.items, bins.fill = [[(3, 0), (5, 1)], [(3, 2), (5, 3)], [(2, 4), (2, 5)]], [8, 8, 4]
    bins.improve(keep=2)
    assert sorted(f for f in bins.fill if f) == [10, 10]


def test_local_search_tries_all_open_bins():
    bins = packing.Bins(10)
    bins.items = [[(4, 0)], [(5, 1)], *[[(9, i)] for i in range(2, 62)]]
    bins.fill = [4, 5, *[9] * 60]
    bins.improve(keep=1)
    assert sorted(f for f in bins.fill if f) == [9] * 61


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=120))
def test_local_search_leaves_no_exchange(sizes):
    bins = packing.Bins(100)
    bins.pack(sizes)
    bins.improve(keep=0)
    assert bins.fill == [sum(size for size, _ in own) for own in bins.items] and sorted(i for own in bins.items for _, i in own) == list(range(len(sizes)))
    used = [b for b, f in enumerate(bins.fill) if 0 < f < 100]
    assert not any(bins._best(a, b) for a in used for b in used if a != b and bins.fill[a] <= bins.fill[b])


def test_containers(spark):
    sizes = [(i, n) for i, n in enumerate([5000, 2048, 4096, 1, 0, None, 2047, 700, 700, 700] + [300] * 50)] + [(None, 5), (3, 1)]
    frame = spark.createDataFrame(sizes, "id int, n int")
    rows = packing.fill_containers(frame, "id", "n", 2048, group=20).collect()
    by = {}
    for r in rows:
        by.setdefault(r.container, []).append(r)
    assert all(sum(r.n_tokens for r in own) <= 2048 and sorted(r.place for r in own) == list(range(len(own))) for own in by.values())
    whole = {}
    for r in rows:
        whole.setdefault(r.id, []).append((r.piece, r.from_token, r.n_tokens))
    assert sorted(whole[0]) == [(0, 0, 2048), (1, 2048, 2048), (2, 4096, 904)]
    assert sum(r.n_tokens for r in rows) == sum(n for i, n in sizes if i is not None and n) and {4, 5}.isdisjoint(whole)
    assert len(by) <= math.ceil(sum(r.n_tokens for r in rows) / 2048) + 2
    assert packing.fill_containers(frame.limit(0), "id", "n", 2048).count() == 0


def _cut(text, classifier):
    return [text[a:b] for a, b in sentences.units(text, classifier)]


@pytest.fixture(scope="module")
def classifier(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return sentences.train(frame, F.col("text"))


@pytest.mark.parametrize("units", [
    ["Podávejte např. Gibodizi s čerstvým pečivem, zeleninou atd.", "Akce platí od 9.1. do vyprodání zásob."],
    ["Vedoucí prodejny řekla: „Tak levné to ještě nebylo! Přijďte včas.“", "Proč čekat?"],
    ["„Ist das wirklich frisch?“, fragten die Kunden an Theke Nr. 27.", "Warum warten?"],
    ["Am 3. Oktober bleibt die Filiale geschlossen.", "Den Kuchen bei 180 °C etwa 1,5 Std. im vorgeheizten Ofen backen."],
    ["店长说：“从来没有这么便宜！请早点来。”", "真好吃！", "“还有货吗？”顾客问道。", "为什么要等？"],
    ["Kupte Lesonegi a získáte (zcela zdarma!) tašku.", "Ach… to snad ne."],
    ["Είναι πραγματικά φρέσκο;", "Νόστιμο!"],
])
def test_sentences(classifier, units):
    joined = "" if units[0][0] in "店" else " "
    assert _cut(joined.join(units), classifier) == units


def test_structure(classifier):
    text = "Nadpis\n\n• 1 kg. Nové!\n– druhý\r\ntext na\nřádku\n \t\n1,5 kg = 2 Kč\n"
    assert _cut(text, classifier) == ["Nadpis", "• 1 kg. Nové!", "– druhý", "text na\nřádku", "1,5 kg = 2 Kč"]
    assert _cut("ราคา 8.00 บาท ลูกค้าซื้อ", classifier) == ["ราคา 8.00 บาท", "ลูกค้าซื้อ"]
    assert [_cut(t, classifier) for t in (None, "", " \n\t ")] == [[], [], []]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab A.!?…\n„“”\"()«»•- 。か1", max_size=60))
def test_units_cover_all_but_white_space(text):
    found = sentences.units(text, sentences.Classifier(np.zeros(sentences.WEIGHTS, np.float32), 1.0))
    covered = {i for a, b in found for i in range(a, b)}
    assert all(c.isspace() for i, c in enumerate(text) if i not in covered)
    assert all(not text[a].isspace() and not text[b - 1].isspace() for a, b in found) and all(x[1] <= y[0] for x, y in zip(found, found[1:]))


def test_held_out_boundaries(spark, classifier):
    """Blocks of other documents joined by spaces: the classifier finds where they met."""
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("text is not null").collect()]
    hits = total = 0
    for text in texts:
        own = [text[b.start:b.end] for b in sentences.blocks(text) if not b.single]
        own = [b for b in own if sentences.ended(b, sentences.Block(0, len(b), False))]
        for a, b in zip(own, own[1:]):
            total += 1
            hits += len(a) in {end for _, end in sentences.units(a + " " + b, classifier)}
    assert total > 20 and hits >= 0.97 * total


def test_sentence_table(spark, classifier):
    frame = spark.createDataFrame([(1, "A b. C d.", 0), (2, None, 0), (3, "", 0)], "id int, text string, sent_start int")
    rows = {(r.id, r.sent_start, r.sent_end) for r in sentences.sentence_units(frame, "id", F.col("text"), classifier).collect()}
    assert {i for i, _, _ in rows} == {1} and max(e for _, _, e in rows) == 9
    assert sentences.sentence_units(frame.limit(0), "id", F.col("text")).count() == 0


def _listing_frame(spark, titles):
    return spark.createDataFrame([(i, t, m, None, None, "clash") for i, m, t in titles], "listing_id int, title string, market string, unit string, quantity double, product string")


def test_products(spark):
    words = [("cs", "maslo", "maslo"), ("cs", "krkovice veprova", "krkovice"), ("pl", "maslo", "maslo")]
    titles = [
        (1, "cz", "Gibodizi máslo bio 250 g"), (2, "cz", "BIO | 0,25 kg | GIBODIZI | MASLO"), (3, "cz", "bio Gibodizi maslo (25 dkg)"), (4, "cz", "Gibodizi máslo 250 g"),
        (5, "cz", "Gibodizi máslo bio 2x125 g"), (6, "pl", "Gibodizi masło bio 250 g"), (7, "cz", "Vepřová krkovice Gibodizi tuk 4,5 % 1 kg"), (8, "cz", "krkovice, vepřová, gibodizi, 1000 g, obsah tuku 4.5 %"),
        (9, "cz", "Gibodizi máslo bio 250 g"), (10, "cz", None), (11, "cz", ""), (None, "cz", "Gibodizi máslo bio 250 g"), (12, None, "x" * 50_000), (13, "cz", "Gibodizi mléko 4006381333931 1 l"), (14, "cz", "Jiné 4006381333931 zboží 1 l"), (15, "cz", "Třetí 4006381333932 1 l"),
    ]
    frame = _listing_frame(spark, titles)
    found = {tuple(r) for r in products.pairs(products.group_listings(frame, "listing_id", words)).collect()}
    assert found == {(1, 2), (1, 3), (1, 9), (2, 3), (2, 9), (3, 9), (7, 8), (13, 14)}
    assert products.group_listings(frame.limit(0), "listing_id", words).count() == 0


def test_products_without_word_lists(spark):
    """Invented brands, wordings of two varieties and advertising, none of which the library has seen."""
    random.seed(11)
    syllable = lambda: random.choice("bdfgklmnprstvz") + random.choice("aeiou")
    word = lambda n: "".join(syllable() for _ in range(n))
    items = [word(3) + "x" for _ in range(12)]
    brands = [word(4) + "q" for _ in range(60)]
    varieties = [[word(3) + "w" for _ in range(3)] for _ in range(8)]
    advertising = [f"{word(3)}h {word(2)}h" for _ in range(10)]
    rows, truth = [], {}
    for brand in brands:
        for item in random.sample(items, 6):
            size, kinds = random.choice([100, 250, 500]), random.sample([None, *varieties], 1 + (random.random() < 0.3))
            for variety in kinds:
                for _ in range(random.randint(2, 6)):
                    spelled = brand if random.random() > 0.05 else brand[:3] + brand[4:]
                    parts = [spelled, item, f"{size} g", *([random.choice(variety)] if variety else []), *random.sample(advertising, random.randint(0, 2))]
                    random.shuffle(parts)
                    truth[len(rows)] = (brand, item, size, tuple(variety or ()))
                    rows.append((len(rows), "cz", " ".join(parts)))
    known = [("cs", item, item) for item in items]
    wanted = {(a, b) for a in truth for b in truth if a < b and truth[a] == truth[b]}
    # An advertising word that stands once, and a part number that tells two products apart and joins two wordings.
    first = next(a for a in truth if (a, a + 1) in wanted)
    rows[first] = (first, "cz", rows[first][2] + " limitovana edice")
    found = {tuple(r) for r in products.pairs(products.group_listings(_listing_frame(spark, rows), "listing_id", known)).collect()}
    assert (first, first + 1) in found
    assert len(found & wanted) >= 0.95 * len(wanted) and len(found & wanted) >= 0.95 * len(found)


def test_wordings_are_learned(spark):
    catalogue = spark.createDataFrame([("maslo", "máslo", None, {"sk": "maslo"}, None, ["stolní máslo"]), (None, "nic", None, None, None, None)], "id string, name_cs string, name_plural_cs string, names map<string,string>, names_plural map<string,string>, aliases array<string>")
    known = products.catalogue_wordings(catalogue)
    assert {tuple(r) for r in known.collect()} == {("cs", "maslo", "maslo"), ("cs", "stolni maslo", "maslo"), ("sk", "maslo", "maslo")}
    rows = [(f"Znacka{chr(97 + i % 26)} čerstvé máslo 250 g", "cz", "maslo") for i in range(60)] + [(f"Bra{chr(97 + i % 26)} pomazánka mléčná {i} kg", "cz", "maslo") for i in range(60)] + [(None, "cz", "maslo"), ("x", None, "maslo"), ("x", "cz", None)]
    offers = spark.createDataFrame(rows, "title string, market string, ingredient_id string")
    fresh, beside = products.learned_wordings(offers, "title", "market", "ingredient_id", known)
    assert [tuple(r) for r in fresh.collect()] == [("cs", "mlecna pomazanka", "maslo")]
    assert {tuple(r) for r in beside.collect()} == {("cs", "cerstve", "maslo"), ("cs", "maslo", "maslo")}
    assert products.learned_wordings(offers.limit(0), "title", "market", "ingredient_id", known)[0].count() == 0


@pytest.mark.parametrize("length", [3, 39, 40, 41, 42, 90])
def test_words_an_edit_apart_share_a_key(spark, length):
    random.seed(length)
    word = "".join(random.choice("abcdef") for _ in range(length))
    edits = [word[:i] + word[i + 1:] for i in range(length)] + [word[:i] + "z" + word[i:] for i in range(length + 1)] + [word[:i] + "z" + word[i + 1:] for i in range(length)]
    edits += [word[:i] + word[i + 1] + word[i] + word[i + 2:] for i in range(length - 1)]
    frame = spark.createDataFrame([(word, e) for e in edits], "a string, b string")
    assert frame.where(~F.arrays_overlap(products._deletion_keys(F.col("a")), products._deletion_keys(F.col("b"))) | ~products._near(F.col("a"), F.col("b"))).count() == 0


def test_products_by_identifiers(spark):
    words = [("cs", "maslo", "maslo")]
    titles = [
        (1, "de", "Bosch Akkuschrauber GSR 18V-55 2 kg"), (2, "de", "Bosch Akkuschrauber GSR 12V-15 2 kg"), (3, "de", "GSR 18V/55, Akkuschrauber Bosch"), (4, "de", "Makita Akkuschrauber GSR 18V-55 2 kg"),
        (5, "cz", "Alpine Farm máslo 250 g"), (6, "cz", "Alpine Gold máslo 250 g"), (7, "cz", "máslo Farm Alpine 0,25 kg"),
        (8, "cz", "Gibodizi mléko 4006381333931"), (9, "cz", "4006381333931 1 l"), (10, "cz", "Gibodizi 4006381333931 6 l"), (11, "cz", "Jiné 4006381333931 1 l"),
        (12, None, "Máslo Kato 200 g"), (13, None, "Kato máslo 0,2 kg"), (14, "cz", None), (15, "cz", ""), (16, "cz", "Pivo Tovo 24pack 5 l"), (17, "cz", "Tovo sýr 24pack 5 l"),
    ]
    frame = spark.createDataFrame([(i, t, m, None, None) for i, m, t in titles], "listing_id int, title string, market string, unit string, quantity double")
    rows = products.group_listings(frame, "listing_id", words)
    assert sorted(r.id for r in rows.collect()) == list(range(1, 18))
    assert {tuple(r) for r in products.pairs(rows).collect()} == {(1, 3), (5, 7), (9, 11), (12, 13)}
    one = products.group_listings(frame.where("listing_id in (8, 9, 14)"), "listing_id", words)
    assert {tuple(r) for r in products.pairs(one).collect()} == {(8, 9)} and one.count() == 3


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    got = {r.node: r.component for r in products.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_long_tokens_are_read_to_their_end():
    for letters in (30, 60, 50_000):
        text = "a" * letters + ". " + "B" * letters + " c."
        (at, context), = sentences.candidates(text, sentences.Block(0, len(text), False), "N", [])
        assert context.before.startswith("a" * 20) and context.after.startswith("b" * 20) and context.after_next == " "
    one, other = (sentences._name("x" * 40 + c) for c in "yz")
    assert one != other
