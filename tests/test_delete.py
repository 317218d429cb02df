import pytest
from pyspark.sql import functions as F

from postsieve import schemas
from postsieve.sinks.store import BATCH_TABLES, Store


@pytest.fixture
def store(spark, folder):
    made = Store(spark, folder + "/store")
    made.bootstrap()
    posts = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C")], "external_id string, content string")
    made.upsert_posts(wide(posts), 0, 0)
    links = [("a", 1), ("a", 2), ("b", 1), ("c", 3)]
    made.insert_links(spark.createDataFrame(links, "external_id string, keyword_id long"), 0, 0)
    made.append("scanned_posts", spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "external_id string"), 0, 0)
    made.append("keywords", spark.createDataFrame([(1, 1, "k", "en"), (2, 1, "l", "en"), (3, 1, "m", "en")], schemas.KEYWORDS), 0, 0)
    return made


def wide(posts):
    for field in schemas.POSTS:
        if field.name not in posts.columns:
            posts = posts.withColumn(field.name, F.lit(None).cast(field.dataType))
    return posts


def content(store):
    def ids(name, *columns):
        return sorted(map(tuple, store.read(name).select(*columns).collect()))

    return (
        ids("posts", "external_id", "content"), ids("post_keywords", "external_id", "keyword_id"),
        ids("scanned_posts", "external_id"), ids("keywords", "id"),
    )


def frame(spark, values, schema):
    return spark.createDataFrame([(v,) for v in values], schema)


SEEN = [("a",), ("b",), ("c",), ("d",)]


def test_deletes_cascade_and_replay(spark, store):
    def delete():
        return store.delete(0, 1, frame(spark, ["a", "a", "x", None], "external_id string"), frame(spark, [3], "id long"))

    assert delete() == 3
    want = ([("b", "B"), ("c", "C")], [("b", 1)], SEEN, [(1,), (2,)])
    assert content(store) == want
    delete()
    assert content(store) == want
    for name in BATCH_TABLES:
        store.compact(name)
    assert content(store) == want


def test_what_comes_again_is_back(spark, store):
    store.delete(0, 1, frame(spark, ["a"], "external_id string"))
    store.upsert_posts(wide(spark.createDataFrame([("a", "A2")], "external_id string, content string")), 0, 2)
    # The link of keyword 1 was deleted, so it is new; keyword 2's does not come back by itself.
    assert store.insert_links(spark.createDataFrame([("a", 1), ("b", 1)], "external_id string, keyword_id long"), 0, 2) == 1
    want = ([("a", "A2"), ("b", "B"), ("c", "C")], [("a", 1), ("b", 1), ("c", 3)], SEEN, [(1,), (2,), (3,)])
    assert content(store) == want
    store.delete(0, 1, frame(spark, ["a"], "external_id string"))
    assert content(store) == want
    for name in BATCH_TABLES:
        store.compact(name)
    assert content(store) == want
    dead = spark.read.parquet(f"{store.path('posts')}/_compacted/0-2").collect()
    assert sorted(r.external_id for r in dead) == ["b", "c"]


def test_forgotten_ids_are_new(spark, store):
    store.delete(0, 1, frame(spark, ["a"], "external_id string"))
    store.delete(0, 2, frame(spark, ["d"], "external_id string"), forget=True)
    assert content(store)[2] == [("a",), ("b",), ("c",)]
    assert store.insert_seen(frame(spark, ["a", "d"], "external_id string"), 0, 3) == 1
    assert content(store)[2] == SEEN


def test_views_leave_deleted_rows_out(spark, store):
    store.delete(0, 1, frame(spark, ["a"], "external_id string"), frame(spark, [3], "id long"))
    store.register("monitor_deleted")
    assert [r.external_id for r in spark.table("monitor_deleted.posts").orderBy("external_id").collect()] == ["b", "c"]
    assert [tuple(r) for r in spark.table("monitor_deleted.post_keywords").collect()] == [("b", 1)]
    assert spark.table("monitor_deleted.scanned_posts").count() == 4


def test_without_deletions_nothing_is_joined(spark, store):
    plan = store.read("post_keywords")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert store.delete(0, 1) == 0
    assert len(content(store)[0]) == 3
