import random

import pytest

from postsieve.operators import arrivals, upsert
from tests.test_text import python_match

SCHEMA = "keyword_id long, kw_seq long, page long, pos long, external_id string, text string"
KEYWORDS = [(1, "red", "en"), (2, "bleu ciel", "fr"), (3, "art", "en")]


def feed(seed, n=400):
    """Candidates in arrival order; one id makes up a third of them."""
    rng = random.Random(seed)
    texts = ["Red art", "ciel bleu", "bleu ciel", "redart", "", "ART!"]
    rows = []
    for i in range(n):
        key = 0 if rng.random() < 0.34 else rng.randint(1, 60)
        keyword = rng.randint(1, 4)
        rows.append((keyword, keyword, i // 20, i % 20, f"id{key}", texts[key % len(texts)]))
    return rows


def sequential_first_seen(rows, seen):
    words = {k: (w, lang) for k, w, lang in KEYWORDS}
    known, hits = set(seen), {}
    for keyword, _, _, _, key, text in sorted(rows, key=lambda r: r[1:4]):
        if keyword in words and key not in known:
            known.add(key)
            if python_match(words[keyword][0], text):
                hits[key] = (keyword, words[keyword][1])
    return hits


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("small", [True, False])
def test_match_first_seen_equals_the_loop(spark, monkeypatch, seed, small):
    monkeypatch.setattr(arrivals, "fits_broadcast", lambda df: small)
    rows = feed(seed)
    shuffled = random.Random(seed).sample(rows, len(rows))
    seen = ["id3", "id7", "id11"]
    got = arrivals.match_first_seen(
        spark.createDataFrame(shuffled, SCHEMA).repartition(7),
        spark.createDataFrame(KEYWORDS, "id long, keyword string, language string"),
        spark.createDataFrame([(s,) for s in seen], "external_id string"),
    ).collect()
    assert {r.external_id: (r.keyword_id, r.language) for r in got} == sequential_first_seen(rows, seen)


def test_first_arrival_ignores_partitioning(spark):
    rows = feed(5)
    frame = spark.createDataFrame(rows, SCHEMA)
    results = [
        sorted(map(tuple, arrivals.first_arrival(frame.repartition(n)).collect())) for n in (1, 4, 9)
    ]
    assert results[0] == results[1] == results[2]
    first = {}
    for r in sorted(rows, key=lambda r: r[1:4]):
        first.setdefault(r[4], r)
    assert results[0] == sorted(first.values())


def test_first_arrival_limits_before_the_shuffle(spark):
    plan = arrivals.first_arrival(spark.createDataFrame(feed(1), SCHEMA))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("Exchange") < text.rindex("WindowGroupLimit")


@pytest.mark.parametrize("n", [1, 10, 1000])
def test_cap_per_keyword(spark, n):
    rows = feed(6)
    capped = arrivals.cap_per_keyword(spark.createDataFrame(rows, SCHEMA), n)
    want = []
    for keyword in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == keyword), key=lambda r: (r[2], r[3], r[4]))
        want += own[:n]
    assert sorted(map(tuple, capped.collect())) == sorted(want)


@pytest.mark.parametrize("bound", [None, 0])
def test_anti_seen_batch_both_ways(spark, monkeypatch, bound):
    if bound is not None:
        monkeypatch.setattr(arrivals, "fits_broadcast", lambda df: False)
    batch = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("c", 4)], "external_id string, n int")
    seen = spark.createDataFrame([("b",), ("b",), ("z",)], "external_id string")
    for operator in (arrivals.anti_seen_batch, arrivals.anti_seen):
        assert sorted(r.n for r in operator(batch, seen).collect()) == [1, 4]


def test_union_feeds_and_seen_union(spark):
    one = spark.createDataFrame([("a", 2, "a2"), ("a", 1, "a1"), ("b", 5, "b5")], "external_id string, pos int, text string")
    two = spark.createDataFrame([("b", 0, "late"), ("c", 9, "c9")], "external_id string, pos int, text string")
    got = {r.external_id: (r.text, r.feed_seq) for r in arrivals.union_feeds([one, two]).collect()}
    assert got == {"a": ("a1", 0), "b": ("b5", 0), "c": ("c9", 1)}
    assert sorted(r[0] for r in arrivals.seen_union(one, two).collect()) == ["a", "b", "c"]


@pytest.mark.parametrize("small", [True, False])
def test_upsert_last_write_wins(spark, monkeypatch, small):
    monkeypatch.setattr(upsert, "fits_broadcast", lambda df: small)
    rng = random.Random(9)
    state, current = {}, []
    for i in range(30):
        state[f"k{i}"] = (0, "old")
    current = [(k, *v) for k, v in state.items()]
    batch = [(f"k{0 if rng.random() < 0.4 else rng.randint(0, 50)}", i, f"new{i}") for i in range(1, 200)]
    for key, seq, value in batch:
        state[key] = (seq, value)
    schema = "k string, seq int, v string"
    got = upsert.upsert(
        spark.createDataFrame(current, schema),
        spark.createDataFrame(random.Random(1).sample(batch, len(batch)), schema).repartition(6),
        ["k"],
        ["seq"],
    ).collect()
    assert sorted(map(tuple, got)) == sorted((k, *v) for k, v in state.items())


def test_insert_absent_and_bridge(spark):
    matched = spark.createDataFrame([("a", [1, 2]), ("b", [2])], "external_id string, keyword_ids array<int>")
    links = upsert.bridge_rows(matched)
    current = spark.createDataFrame([("a", 2)], "external_id string, keyword_id int")
    new = upsert.insert_absent(current, links.union(links), ["external_id", "keyword_id"])
    assert sorted(map(tuple, new.collect())) == [("a", 1), ("b", 2)]
