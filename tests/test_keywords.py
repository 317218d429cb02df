import random

import pytest

from postsieve.operators import keywords as K
from postsieve.operators.numbering import dense_ids, running_sum
from postsieve.plans.generate import build_keywords, keyword_order

WORDS = ["ab", "law", "Droit", " law ", "e sport", "x", "art", "bio", "été"]


def accepted(rows, categories, stored):
    """Per (category, word) that is not stored: the lowest model with all its languages."""
    known = {(c, w.strip().lower()) for c, w in stored}
    offers = {(categories[q], w.strip().lower(), lang, m) for m, q, w, lang in rows if len(w.strip()) >= 3}
    lowest = {}
    for category, word, _, model in offers:
        lowest[category, word] = min(model, lowest.get((category, word), model))
    return sorted(o for o in offers if o[:2] not in known and lowest[o[:2]] == o[3])


def test_first_model_wins_with_all_its_languages(spark):
    rows = [(1, "a", "Law", "en"), (0, "a", " law", "fr"), (0, "a", "law", "en"), (1, "b", "law", "fr"), (2, "a", "xy", "en")]
    got = K.keyword_build(
        spark.createDataFrame(rows, "model_seq int, query string, keyword string, language string"),
        spark.createDataFrame([(1, "a"), (2, "b")], "id int, category string"),
        spark.createDataFrame([(2, "other")], "category_id int, keyword string"),
    ).collect()
    assert sorted((r.category_id, r.language, r.model_seq) for r in got) == [(1, "en", 0), (1, "fr", 0), (2, "fr", 1)]


@pytest.mark.parametrize("seed", range(4))
def test_keyword_build_follows_the_rule(spark, seed):
    rng = random.Random(seed)
    categories = {"a": 1, "b": 2}
    rows = [
        (rng.randint(0, 3), rng.choice("ab"), rng.choice(WORDS), rng.choice(["en", "fr"])) for _ in range(80)
    ]
    stored = [(1, "ART "), (2, "été")]
    got = K.keyword_build(
        spark.createDataFrame(rows, "model_seq int, query string, keyword string, language string").repartition(5),
        spark.createDataFrame([(i, c) for c, i in categories.items()], "id int, category string"),
        spark.createDataFrame(stored, "category_id int, keyword string"),
    ).collect()
    assert sorted((r.category_id, r.keyword, r.language, r.model_seq) for r in got) == accepted(
        rows, categories, stored
    )


def test_category_get_or_create(spark):
    categories = spark.createDataFrame([(4, "law"), (9, "art")], "id long, category string")
    wanted = spark.createDataFrame(
        [(3, "zoo"), (1, "music"), (2, "law"), (5, "music"), (7, "bio")], "input_seq int, category string"
    )
    got = {r.category: r.id for r in K.category_get_or_create(categories, wanted).collect()}
    assert got == {"law": 4, "art": 9, "music": 10, "zoo": 11, "bio": 12}
    empty = spark.createDataFrame([], "id long, category string")
    assert sorted(r.id for r in K.category_get_or_create(empty, wanted).collect()) == [1, 2, 3, 4]


@pytest.mark.parametrize("n", [0, 1, 500])
def test_running_sum_and_dense_ids(spark, n):
    values = list(range(n))
    random.Random(3).shuffle(values)
    frame = spark.createDataFrame([(v, v % 7) for v in values], "seq int, v int").repartition(6)
    sums = {r.seq: r.running_total for r in running_sum(frame, ["seq"], "v").collect()}
    total, want = 0, {}
    for v in range(n):
        total += v % 7
        want[v] = total
    assert sums == want
    ids = {r.seq: r.id for r in dense_ids(frame, ["seq"], 10).collect()}
    assert ids == {v: v + 10 for v in range(n)}


def test_lemmatize_and_variants(spark):
    lemmas = spark.createDataFrame(
        [("cats", "en", "cat"), ("chevaux", "fr", "cheval"), ("hunde", "de", "hund")],
        "token string, language string, lemma string",
    )
    cases = [
        (1, "Cats", "en", ["cats", "catses", "cat"]),
        (2, "chevaux blancs", "FR", ["chevaux blancs", "cheval"]),
        (3, "hunde", "de", ["hunde"]),
        (4, "dog house", "en", ["dog house", "dog houses", "dog"]),
        (5, "prix", "fr", ["prix"]),
    ]
    keywords = spark.createDataFrame([c[:3] for c in cases], "id int, keyword string, language string")
    rows = K.expand_variants(keywords, lemmas).orderBy("id", "variant_seq").collect()
    got = {}
    for r in rows:
        got.setdefault(r.id, []).append(r.keyword)
    assert got == {c[0]: c[3] for c in cases}
    empty = spark.createDataFrame([("", "en")], "keyword string, language string")
    assert K.lemmatize(empty, lemmas).first().lemma == ""


def test_build_plan(spark):
    completions = spark.createDataFrame(
        [
            (0, "m0", "law", "t", '[{"keyword": "Legal-Aid", "language": "en"}, {"keyword": "ab", "language": "en"}]'),
            (1, "m1", "law", "t", '[{"keyword": "legal aid", "language": "fr"}, {"keyword": "droit", "language": "fr"}]'),
            (1, "m1", "art", "t", "no json"),
        ],
        "model_seq int, model string, query string, topic string, content string",
    )
    wanted = spark.createDataFrame([(0, "law"), (1, "art")], "input_seq int, category string")
    categories = spark.createDataFrame([(1, "art")], "id long, category string")
    stored = spark.createDataFrame([(7, 1, "old", "en")], "id long, category_id long, keyword string, language string")
    all_categories, new = build_keywords(completions, wanted, categories, stored)
    assert sorted(map(tuple, all_categories.collect())) == [(1, "art"), (2, "law")]
    assert sorted(map(tuple, new.collect())) == [(8, 2, "legal aid", "en"), (9, 2, "droit", "fr")]
    assert {r.id: r.kw_seq for r in keyword_order(new).collect()} == {8: 8, 9: 9}
