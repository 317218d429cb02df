import pytest
from pyspark.sql import functions as F

from postsieve import schemas
from postsieve.sinks.store import Store
from postsieve.sources.feeds import stream_candidates
from postsieve.streaming import ingest
from tests.test_text import python_match

KEYWORDS = [(1, "art", "en"), (2, "bleu ciel", "fr"), (3, "red", "en")]
TEXTS = ["Modern ART", "rouge", "un bleu ciel, red", "bleu-ciel", "red art"]


@pytest.fixture
def keywords(spark):
    return spark.createDataFrame(KEYWORDS, "id long, keyword string, language string")


@pytest.fixture
def store(spark, folder):
    made = Store(spark, folder + "/store")
    made.bootstrap()
    return made


def candidates(spark, ids, page=0):
    """Candidates (keyword_id, id); the text belongs to the id."""
    rows = [(k, k, page, i, f"id{n}", TEXTS[n % len(TEXTS)], n) for i, (k, n) in enumerate(ids)]
    frame = spark.createDataFrame(
        rows, "kw_seq long, keyword_id long, page long, pos long, external_id string, text string, like_count int"
    )
    for field in schemas.CANDIDATES:
        if field.name not in frame.columns:
            frame = frame.withColumn(field.name, F.lit(None).cast(field.dataType))
    return frame.select(*schemas.CANDIDATES.names)


def land(spark, folder, ids, page):
    candidates(spark, ids, page).coalesce(1).write.mode("append").parquet(folder)


def expected(numbers):
    links = set()
    for n in numbers:
        for k, word, _ in KEYWORDS:
            if python_match(word, TEXTS[n % len(TEXTS)]):
                links.add((f"id{n}", k))
    return links


def content(store):
    posts = store.read("posts")
    return {
        "links": {tuple(r) for r in store.read("post_keywords").collect()},
        "posts": sorted(r.external_id for r in posts.collect()),
        "seen": sorted(r.external_id for r in store.read("scanned_posts").collect()),
        "record": sorted(map(tuple, posts.select("external_id", "content", "language", "like_count", "labels", "embed").collect())),
    }


def run(spark, store, keywords, landing, checkpoint, **options):
    stream = stream_candidates(spark, landing, files_per_batch=1)
    return ingest.ingest_posts(stream, keywords, store, checkpoint, **options)


PAGES = [[(1, n) for n in range(8)], [(2, n) for n in range(4, 12)], [(3, n) for n in (0, 1, 30, 30, 30)]]
ALL_IDS = set(range(12)) | {30}


@pytest.mark.parametrize("state", [False, True])
def test_pages_resume_and_replay(spark, store, keywords, folder, state):
    landing, checkpoint = folder + "/landing", folder + "/checkpoint"
    for i, page in enumerate(PAGES[:2]):
        land(spark, landing, page, i)
    first = run(spark, store, keywords, landing, checkpoint, dedup_state=state)
    assert [w["scanned_posts"] for w in first if w["scanned_posts"]] == [8, 4]
    land(spark, landing, PAGES[2], 2)
    second = run(spark, store, keywords, landing, checkpoint, dedup_state=state)
    assert sum(w["scanned_posts"] for w in second) == 1
    assert sum(w["scanned_posts"] for w in run(spark, store, keywords, landing, checkpoint, dedup_state=state)) == 0
    state_now = content(store)
    assert state_now["links"] == expected(ALL_IDS)
    assert state_now["seen"] == sorted(f"id{n}" for n in ALL_IDS)
    assert state_now["posts"] == sorted({p for p, _ in expected(ALL_IDS)})
    assert ("id2", "un bleu ciel, red", "fr", 2, "[]", "null") in state_now["record"]
    # A fresh checkpoint reads everything again and finds nothing new.
    again = run(spark, store, keywords, landing, folder + "/checkpoint2", dedup_state=state)
    assert sum(w["scanned_posts"] + w["posts"] + w["post_keywords"] for w in again) == 0
    assert content(store) == state_now


def test_crash_between_posts_and_ids_is_made_good(spark, store, keywords, folder, monkeypatch):
    landing, checkpoint = folder + "/landing", folder + "/checkpoint"
    land(spark, landing, PAGES[0], 0)
    append = Store.append

    def failing(self, table, *args):
        if table == "scanned_posts":
            raise RuntimeError("lost")
        return append(self, table, *args)

    monkeypatch.setattr(Store, "append", failing)
    with pytest.raises(Exception, match="lost"):
        run(spark, store, keywords, landing, checkpoint)
    assert content(store)["posts"] and not content(store)["seen"]
    monkeypatch.setattr(Store, "append", append)
    run(spark, store, keywords, landing, checkpoint)
    assert content(store)["links"] == expected(range(8))
    assert store.versions("post_keywords").count() == len(expected(range(8)))
    assert len(content(store)["seen"]) == 8


def test_a_fresh_checkpoint_after_a_break_keeps_links_unique(spark, store, keywords, folder, monkeypatch):
    landing = folder + "/landing"
    land(spark, landing, PAGES[0], 0)
    append = Store.append

    def failing(self, table, *args):
        if table == "scanned_posts":
            raise RuntimeError("lost")
        return append(self, table, *args)

    monkeypatch.setattr(Store, "append", failing)
    with pytest.raises(Exception, match="lost"):
        run(spark, store, keywords, landing, folder + "/one")
    monkeypatch.setattr(Store, "append", append)
    run(spark, store, keywords, landing, folder + "/two")
    assert store.read("post_keywords").count() == len(expected(range(8)))
    assert content(store)["links"] == expected(range(8))


def test_variants_match_under_the_same_id(spark, store, folder):
    keywords = spark.createDataFrame([(1, "cats", "en"), (2, "red", "en")], "id long, keyword string, language string")
    lemmas = spark.createDataFrame([("cats", "en", "modern")], "token string, language string, lemma string")
    land(spark, folder + "/landing", [(1, 0), (1, 1), (1, 2)], 0)
    run(spark, store, keywords, folder + "/landing", folder + "/cp", lemmas=lemmas)
    assert content(store)["links"] == {("id0", 1), ("id2", 2)}


def test_an_older_checkpoint_may_not_write_any_more(spark, store, keywords, folder):
    landing = folder + "/landing"
    land(spark, landing, PAGES[0], 0)
    run(spark, store, keywords, landing, folder + "/old")
    land(spark, landing, PAGES[1], 1)
    run(spark, store, keywords, landing, folder + "/new")
    with pytest.raises(ValueError, match="is over"):
        run(spark, store, keywords, landing, folder + "/old")


def test_first_seen_mode(spark, store, keywords, folder):
    landing = folder + "/landing"
    # id2 comes for keyword 1 first, which it does not hold: that miss is final.
    land(spark, landing, [(1, 2), (1, 0), (2, 2), (3, 4), (9, 7)], 0)
    run(spark, store, keywords, landing, folder + "/checkpoint", mode="first_seen")
    got = content(store)
    assert got["links"] == {("id0", 1), ("id4", 3)}
    assert got["seen"] == ["id0", "id2", "id4"]
    with pytest.raises(ValueError, match="first_seen"):
        run(spark, store, keywords, landing, folder + "/c2", mode="first_seen", dedup_state=True)
