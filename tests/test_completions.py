import pytest
from pyspark.sql import functions as F

from postsieve.functions import completions as C
from postsieve.operators import keywords as K

ANSWERS = {
    "bare": '[{"keyword": "Real_Estate", "language": "EN"}, {"keyword": "maison", "language": " fr "}]',
    "fenced": '```json\n[{"keyword": "a b", "language": "en"}]\n```',
    "fenced plain": 'Here:\n```\n[{"keyword": "chat", "language": "fr"}]\n``` bye',
    "fenced json inside": '```json [{"keyword": "json tools", "language": "en"}]```',
    "unclosed fence": '```json\n[{"keyword": "open", "language": "en"}]',
    "broken": '[{"keyword": "a", "language": "en"}',
    "trailing": '[{"keyword": "a", "language": "en"}], more',
    "trailing bracket": '[{"keyword": "a", "language": "en"}]]',
    "trailing brace": '[{"keyword": "a", "language": "en"}]}',
    "two values": '[] []',
    "empty": "",
    "scalar": "3",
    "text": '"abc"',
    "object": '{"keyword": "a", "language": "en"}',
    "null": "null",
    "mixed": '[3, "x", null, [1], {"keyword": 5, "language": "en"}, {"language": "en"}, {"keyword": "ok", "language": "fr"}]',
    "twice": '[{"keyword": "A-b", "language": "en"}, {"keyword": "c", "language": "en"}, {"keyword": "a b", "language": "en"}, {"keyword": "a b", "language": "fr"}]',
    "double field": '[{"keyword": "a", "keyword": "b", "language": "en"}]',
    "numbers": '[{"keyword": 1.50, "language": "en"}, {"keyword": true, "language": "fr"}]',
    "control": '[{"keyword": "a\tb", "language": "en"}]',
    "comment": '[{"keyword": "a", "language": "en"}] // no',
    "foreign": '[{"keyword": "haus", "language": "de"}, {"keyword": "", "language": "en"}, {"keyword": "x"}]',
    "white space": ' \n [{"keyword": " a\\u00a0b ", "language": "en"}] \n',
}


# The clean keywords of each answer; None for one that cannot be used.
CLEAN = {
    "bare": [("real estate", "en"), ("maison", "fr")],
    "fenced": [("a b", "en")],
    "fenced plain": [("chat", "fr")],
    "fenced json inside": [("json tools", "en")],
    "unclosed fence": [("open", "en")],
    "broken": None,
    "trailing": None,
    "trailing bracket": None,
    "trailing brace": None,
    "two values": None,
    "empty": None,
    "scalar": [],
    "text": [],
    "object": [],
    "null": [],
    "mixed": [("5", "en"), ("ok", "fr")],
    "twice": [("a b", "en"), ("c", "en"), ("a b", "fr")],
    "double field": [("b", "en")],
    "numbers": [("1.5", "en"), ("true", "fr")],
    "control": None,
    "comment": None,
    "foreign": [],
    "white space": [("a b", "en")],
}


@pytest.fixture(scope="module")
def completions(spark):
    rows = [(i, "m", name, "t", content) for i, (name, content) in enumerate(ANSWERS.items())]
    return spark.createDataFrame(rows, "model_seq int, model string, query string, topic string, content string")


def test_parse_completions(completions):
    for row in K.parse_completions(completions).collect():
        want = CLEAN[row.query]
        assert row.is_valid == (want is not None), row.query
        assert [tuple(k) for k in row.keywords or []] == (want or []), row.query


def test_clean_keywords_agrees_with_results(completions):
    rows = K.clean_keywords(completions).orderBy("model_seq", "pos").collect()
    want = [(q, i, *k) for q, c in CLEAN.items() for i, k in enumerate(c or [])]
    assert [(r.query, r.pos, r.keyword, r.language) for r in rows] == want


def test_rejects_and_shortage(completions):
    rejected = {r.query: r for r in K.rejects_report(completions).collect()}
    assert set(rejected) == {q for q, c in CLEAN.items() if c is None}
    assert rejected["broken"].title == "BROKEN"
    short = {r.query: (r.accepted, r.missing) for r in K.keyword_shortage(completions, 2).collect()}
    want = {q: len(c) for q, c in CLEAN.items() if c is not None}
    assert short == {q: (n, 2 - n) for q, n in want.items() if n < 2}


def test_null_keyword_is_dropped(spark):
    rows = spark.createDataFrame([('[{"keyword": null, "language": "en"}]',)], "c string")
    assert rows.select(C.clean_items(C.parse_json(F.col("c")))).first()[0] == []


TOPICS = {
    "good": '{"topics": ["Law", "art"]}',
    "fenced": '```json\n{"topics": ["x", "y"]}\n```',
    "short": '{"topics": ["law"]}',
    "broken": '{"topics": ["law", "art"]',
    "list": '["law", "art"]',
    "none": '{"other": 1}',
    "null": '{"topics": null}',
    "blank": '{"topics": ["", "art"]}',
    "number": '{"topics": [7, "art"]}',
}


def test_topic_fallback(spark):
    answers = spark.createDataFrame(list(TOPICS.items()), "model string, content string")
    queries = spark.createDataFrame(
        [(m, i, q) for m in [*TOPICS, "silent"] for i, q in enumerate(["E_Law", "Art"])],
        "model string, pos int, query string",
    )
    got = {}
    for r in K.topic_fallback(queries, answers).orderBy("model", "pos").collect():
        got.setdefault(r.model, []).append(r.topic)
    lowered = ["e_law", "art"]
    assert got == {
        "good": ["Law", "art"],
        "fenced": ["x", "y"],
        "short": lowered,
        "broken": lowered,
        "list": lowered,
        "none": lowered,
        "null": lowered,
        "blank": ["art"],
        "number": ["7", "art"],
        "silent": lowered,
    }


def test_numbered_list_splits_long_lists(spark):
    queries = spark.createDataFrame([("m", i, f"q{i}") for i in range(5)], "model string, pos int, query string")
    got = {r.prompt_no: r.listing for r in K.numbered_list(queries, per_prompt=3).collect()}
    assert got == {0: "1. q0\n2. q1\n3. q2", 1: "4. q3\n5. q4"}


def test_prompt_table(spark):
    topics = spark.createDataFrame([("m", 0, "law")], "model string, pos int, topic string")
    assert K.prompt_table(topics, 7, "%d words on %s").first().prompt == "7 words on law"


def test_topics_belong_to_their_prompt(spark):
    queries = spark.createDataFrame([("m", i, f"Q{i}") for i in range(6)], "model string, pos int, query string")
    answers = [("m", 0, '["a", "b", "c"]'), ("m", 0, '["a", "z", "c"]'), ("m", 1, '["d", "e"]')]
    answers = [(m, p, '{"topics": %s}' % c) for m, p, c in answers]
    answers = spark.createDataFrame(answers, "model string, prompt_no long, content string")
    got = [r.topic for r in K.topic_fallback(queries, answers, per_prompt=3).orderBy("pos").collect()]
    assert got == ["a", "b", "c", "q3", "q4", "q5"]
