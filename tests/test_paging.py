import json

import pytest

from postsieve.operators import progress
from postsieve.sinks.store import Store
from postsieve.sources.feeds import stream_pages
from postsieve.streaming import paging
from tests.test_ingest import KEYWORDS, TEXTS
from tests.test_text import python_match


@pytest.fixture
def keywords(spark):
    return spark.createDataFrame(KEYWORDS, "id long, keyword string, language string")


@pytest.fixture
def store(spark, folder):
    made = Store(spark, folder + "/store")
    made.bootstrap()
    return made


def page(keyword, number, ids, broken=None):
    body = json.dumps([{"external_id": f"id{n}", "text": TEXTS[n % len(TEXTS)], "like_count": n} for n in ids])
    return f"{keyword}\t{number}\t{broken if broken is not None else body}"


def land(folder, name, lines):
    import os

    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/.{name}", "w") as file:
        file.write("\n".join(lines) + "\n")
    os.rename(f"{folder}/.{name}", f"{folder}/{name}")


def run(spark, store, keywords, landing, checkpoint, **options):
    return paging.ingest_pages(stream_pages(spark, landing, 1), keywords, store, checkpoint, **options)


def seen(store):
    return sorted(int(r.external_id[2:]) for r in store.read("scanned_posts").collect())


def rejects(store):
    return sorted(map(tuple, store.read("page_rejects").select("keyword_id", "page", "reason").collect()), key=repr)


def rows(frame):
    return sorted(map(tuple, frame.collect()))


def test_a_broken_page_ends_its_keyword_only(spark, store, keywords, folder):
    landing, checkpoint = folder + "/landing", folder + "/checkpoint"
    land(landing, "a", [page(1, 0, [0, 1]), page(1, 1, [2], broken='[{"external_id": "id2", "te'), page(1, 2, [3]), page(2, 0, [4])])
    run(spark, store, keywords, landing, checkpoint)
    assert seen(store) == [0, 1, 4]
    want = [(1, 1, "broken"), (1, 2, "after a broken page")]
    assert rejects(store) == sorted(want, key=repr)
    # The stop holds in later batches of the run; keyword 2 goes on.
    land(landing, "b", [page(1, 3, [5]), page(2, 1, [6, 7]), "no page at all", page(3, 0, [8])])
    run(spark, store, keywords, landing, checkpoint)
    assert seen(store) == [0, 1, 4, 6, 7, 8]
    want += [(1, 3, "after a broken page"), (None, None, "broken")]
    assert rejects(store) == sorted(want, key=repr)
    # A new run starts every keyword anew.
    land(folder + "/landing2", "c", [page(1, 1, [2]), page(1, 2, [3])])
    run(spark, store, keywords, folder + "/landing2", folder + "/checkpoint2")
    assert seen(store) == [0, 1, 2, 3, 4, 6, 7, 8]


@pytest.mark.parametrize("body", ["", "{}", "null", "[1]", '[{"text": "x"}]', '[{"external_id": "a"}]', "[null]", '[{"external_id": "a", "text": "b"}'])
def test_what_counts_as_broken(spark, body):
    pages = spark.createDataFrame([(1, 0, body)], "keyword_id long, page long, body string")
    assert progress.read_pages(pages).first().broken


def test_an_empty_page_is_whole(spark):
    pages = spark.createDataFrame([(1, 0, "[]"), (1, 1, '[{"external_id": "a", "text": ""}]')], "keyword_id long, page long, body string")
    assert [r.broken for r in progress.read_pages(pages).collect()] == [False, False]


def test_the_cap_holds_over_batches_and_restarts(spark, store, keywords, folder):
    landing, checkpoint = folder + "/landing", folder + "/checkpoint"
    number = 0
    for batch in range(3):
        lines = []
        for p in range(2):
            lines.append(page(1, 2 * batch + p, range(number, number + 3)))
            number += 3
        land(landing, f"f{batch}", [*lines, page(2, batch, [100 + batch])])
        run(spark, store, keywords, landing, checkpoint, max_rows=10)
    assert seen(store) == [*range(10), 100, 101, 102]
    cursor = {r.keyword_id: (r.last_page, r.n_rows) for r in progress.cursor_of(store.read("page_cursors")).collect()}
    assert cursor == {1: (3, 10), 2: (2, 3)}
    # A page that comes again was read already.
    land(landing, "again", [page(2, 1, [500])])
    run(spark, store, keywords, landing, checkpoint, max_rows=10)
    assert 500 not in seen(store)


def test_replays_change_nothing(spark, store, keywords):
    first = [page(1, 0, [0, 1, 2]), page(2, 0, [3], broken="x")]
    second = [page(1, 1, [4, 5]), page(2, 1, [6]), page(3, 0, [2, 7])]

    def batch(lines, epoch):
        cells = [tuple(line.split("\t")) for line in lines]
        pages = spark.createDataFrame([(int(k), int(p), b) for k, p, b in cells], "keyword_id long, page long, body string")
        return paging.write_pages(pages, keywords, store, 0, epoch, max_rows=4)

    def state():
        return {t: rows(store.read(t).na.fill("")) for t in ("page_rejects", "page_cursors", "keyword_deltas", "post_keywords", "scanned_posts")}

    counts = batch(first, 0)
    assert batch(first, 0) == counts
    batch(second, 1)
    before = state()
    batch(second, 1)
    assert state() == before
    assert seen(store) == [0, 1, 2, 2, 4, 7] or seen(store) == [0, 1, 2, 4, 7]


def test_counts_kept_up_equal_a_recount(spark, store, keywords, folder, monkeypatch):
    landing, checkpoint = folder + "/landing", folder + "/checkpoint"
    for batch, ids in enumerate([range(8), range(4, 14), range(30)]):
        land(landing, f"f{batch}", [page(1, batch, ids), page(3, batch, [n + 2 for n in ids])])
        run(spark, store, keywords, landing, checkpoint)
    arrived = {n for n in [*range(30), *range(2, 32)]}
    links = [(n, k) for n in arrived for k, word, _ in KEYWORDS if python_match(word, TEXTS[n % len(TEXTS)])]
    got = {r.keyword_id: (r.received, r.matched) for r in progress.totals(store.read("keyword_deltas")).collect()}
    received = {1: 48, 3: 48}
    assert got == {k: (received.get(k, 0), sum(1 for _, j in links if j == k)) for k, _, _ in KEYWORDS}
    by_batch = progress.counts_by_batch(store.versions("keyword_deltas")).orderBy("epoch").collect()
    assert by_batch[-1].total_matched == len(links) == sum(r.matched for r in by_batch)
    assert [r.total_received for r in by_batch] == [16, 36, 96]
    # The totals come from the deltas alone.
    read = []
    monkeypatch.setattr(Store, "path", lambda self, table, path=Store.path: read.append(table) or path(self, table))
    progress.counts_by_batch(store.versions("keyword_deltas")).collect()
    assert set(read) == {"keyword_deltas"}


@pytest.mark.parametrize("cut_early", [0, 1000])
def test_only_keywords_beyond_the_cap_are_ranked(spark, monkeypatch, cut_early):
    """Keywords of any number of candidates that all fit move no rows; the others are cut as before."""
    rows = [(k, p, q, f"{k}-{p}-{q}") for k, n in [(1, 5), (2, 9), (3, 3), (None, 2), (4, 4)] for p in range(n) for q in range(2)]
    candidates = spark.createDataFrame(rows, "keyword_id long, page long, pos long, external_id string")
    cursor = spark.createDataFrame([(3, 7, 4), (4, 7, 5)], "keyword_id long, last_page long, n_rows long")
    monkeypatch.setattr(progress, "_CUT_EARLY", cut_early)
    whole = progress.cap_after_cursor(candidates, cursor, 1 << 40)
    assert "Window" not in whole._jdf.queryExecution().toString()
    assert sorted(map(str, whole.collect())) == sorted(map(str, candidates.collect()))
    got = progress.cap_after_cursor(candidates, cursor, 10).collect()
    taken = {3: 4, 4: 5}
    expected = []
    for k in (1, 2, 3, None, 4):
        expected += [r for r in rows if r[0] == k][: 10 - taken.get(k, 0)]
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, expected))


def test_a_page_is_an_array_whatever_it_holds(spark):
    """The schema of a page is not worked out to see that it is an array."""
    whole = ['[]', ' \n[{"external_id": "a", "text": "b", "more": {"x": [1, {"y": 2}]}}]']
    broken = ['{"external_id": "a", "text": "b"}', '[1]', '[null]', '3', 'null', '"[]"', '[{"external_id": "a"}]', '[', '', None]
    pages = spark.createDataFrame([(1, i, b) for i, b in enumerate(whole + broken)], "keyword_id long, page long, body string")
    read = progress.read_pages(pages)
    assert [r.broken for r in read.orderBy("page").collect()] == [False] * len(whole) + [True] * len(broken)
    assert "schema_of_variant" not in read._jdf.queryExecution().toString()
