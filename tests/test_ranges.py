import os

import pytest
from pyspark.sql import functions as F

from postsieve import schemas
from postsieve.sinks.ranges import place
from postsieve.sinks.store import Store


def posts(spark, ids, likes):
    rows = spark.createDataFrame([(f"p{i:04d}" if i is not None else None, f"text {i}", likes) for i in ids],
                                 "external_id string, content string, like_count int")
    for field in schemas.POSTS:
        if field.name not in rows.columns:
            rows = rows.withColumn(field.name, F.lit(None).cast(field.dataType))
    return rows.select(*schemas.POSTS.names)


def files(store, table="posts"):
    return {os.path.join(at, f) for at, _, names in os.walk(store.path(table)) for f in names if f.endswith(".parquet")}


def live(store, table="posts"):
    """The files that hold the compacted state, by the folder of their range."""
    return {f"{e.generation}/{e.range}" for e in store.ranges(table)._entries(store.ranges(table).until())[0]}


def content(rows):
    return sorted(((r.external_id or "", r.like_count) for r in rows.collect()))


@pytest.fixture
def store(spark, folder):
    made = Store(spark, folder + "/store")
    made.bootstrap()
    return made


def test_place(spark):
    lows = ["b", "d", "d\n", "é", "😀"]
    rows = spark.createDataFrame([(k,) for k in [None, "", "a", "b", "c", "d", "d\n", "e", "é", "😀", "😀x"]], "k string")
    got = {r.k: r.at for r in rows.select("k", place(F.col("k"), lows, "string").alias("at")).collect()}
    assert got == {k: 0 if k is None else sum(low <= k for low in lows) for k in got}
    numbers = spark.range(-3, 12).select("id", place(F.col("id"), [0, 4, 9], "bigint").alias("at")).collect()
    assert all(r.at == sum(low <= r.id for low in [0, 4, 9]) for r in numbers)
    assert spark.range(1).select(place(F.col("id"), [], "bigint").alias("at")).first().at == 0


def test_a_small_batch_rewrites_a_small_part(spark, store):
    store.upsert_posts(posts(spark, range(1000), 1), 0, 0)
    store.upsert_posts(posts(spark, range(500, 510), 2), 0, 1)
    assert store.compact("posts", 50)
    first = live(store)
    assert 20 <= len(first) <= 42
    store.upsert_posts(posts(spark, [2000], 3), 0, 2)
    assert store.compact("posts", 50)
    second = live(store)
    # Ten neighbouring ids lie in one or two ranges; all others are the same files as before.
    assert len(first - second) <= 2 and len(first & second) >= 18
    want = sorted((f"p{i:04d}", 2 if 500 <= i < 510 else 1) for i in range(1000)) + [("p2000", 3)]
    assert content(store.read("posts")) == want
    store.register("ranges_views")
    assert content(spark.table("ranges_views.posts")) == want


def test_disk_use_is_bounded(spark, store):
    """Ten batches of changes leave no more files than the live ones, those they replaced, and two batches."""
    store.upsert_posts(posts(spark, [None, *range(300)], 0), 0, 0)
    store.register("bounded_views")
    for epoch in range(1, 11):
        store.upsert_posts(posts(spark, range(epoch * 10, epoch * 10 + 10), epoch), 0, epoch)
        store.compact("posts", 40)
        rows = spark.read.schema("external_id string").parquet(*files(store)).count()
        assert rows <= 2 * 301 + 20
        want = [("", 0)] + [(f"p{i:04d}", i // 10 if 10 <= i < epoch * 10 + 10 else 0) for i in range(300)]
        assert content(store.read("posts")) == sorted(want)
    assert content(spark.table("bounded_views.posts")) == sorted(want)
    assert not os.path.exists(f"{store.batch_path('posts', 0, 0)}/part-00000")
    assert not [f for f in files(store) if "/epoch=0/" in f and "/run=0/" in f]


def test_deletions_touch_their_ranges_only(spark, store):
    links = spark.range(400).select(F.format_string("p%04d", "id").alias("external_id"), (F.col("id") % 100 + 1).alias("keyword_id"))
    store.insert_links(links, 0, 0)
    store.insert_links(spark.createDataFrame([("p9000", 1)], "external_id string, keyword_id long"), 0, 1)
    store.compact("post_keywords", 20)
    before = live(store, "post_keywords")
    store.delete(0, 2, posts=spark.createDataFrame([("p0005",)], "external_id string"))
    store.insert_links(spark.createDataFrame([("p9001", 1)], "external_id string, keyword_id long"), 0, 3)
    store.compact("post_keywords", 20)
    after = live(store, "post_keywords")
    assert len(before - after) <= 2
    stored = spark.read.parquet(*[f"{store.path('post_keywords')}/_compacted/{g}/part={n}" for g, n in (e.split("/") for e in after)])
    assert stored.where("external_id = 'p0005'").isEmpty() and stored.count() == 400
    # A keyword's links lie anywhere: each range that holds one is written anew.
    store.delete(0, 4, keywords=spark.createDataFrame([(7,)], "id long"))
    store.insert_links(spark.createDataFrame([("p9002", 1)], "external_id string, keyword_id long"), 0, 5)
    store.compact("post_keywords", 20)
    assert store.ranges("post_keywords").rows().where("keyword_id = 7").isEmpty()
    assert store.read("post_keywords").count() == 403 - 1 - 4  # three single links came, too


def test_all_rows_deleted(spark, store):
    for epoch in range(3):
        store.upsert_posts(posts(spark, range(5), epoch), 0, epoch)
        store.compact("posts", 2)
    store.delete(0, 3, posts(spark, range(5), 0))
    store.upsert_posts(posts(spark, [7], 4), 0, 4)
    store.compact("posts", 2)
    store.register("emptied_views")
    assert content(store.read("posts")) == content(spark.table("emptied_views.posts")) == [("p0007", 4)]
    store.upsert_posts(posts(spark, [8], 5), 0, 5)
    store.compact("posts", 2)
    assert content(store.read("posts")) == content(spark.table("emptied_views.posts")) == [("p0007", 4), ("p0008", 5)]


def test_the_index_outlives_removed_batches(spark, store):
    store.index_seen()
    for epoch in range(4):
        store.insert_seen(spark.createDataFrame([(f"s{epoch}",)], "external_id string"), 0, epoch)
        store.compact("scanned_posts")
    again = spark.createDataFrame([(f"s{i}",) for i in range(5)], "external_id string")
    assert store.insert_seen(again, 0, 4) == 1
    assert sorted(r[0] for r in store.read("scanned_posts").collect()) == [f"s{i}" for i in range(5)]


def test_long_texts_make_more_ranges(spark, store):
    """One task writes a range, so its bytes are bounded as well as its rows."""
    long = posts(spark, range(400), 1).withColumn("content", F.repeat(F.lit("x"), 10_000)).repartition(3)
    store.upsert_posts(long, 0, 0)
    store.upsert_posts(posts(spark, [], 1), 0, 1)
    store.upsert_posts(posts(spark, [7], 2), 0, 2)
    assert store.compact("posts", bytes_per_range=500_000)
    ranges = store.ranges("posts")
    entries = ranges._entries(ranges.until())[0]
    assert len(entries) >= 6 and max(e.n_bytes for e in entries) < 1_500_000
    assert sum(e.n_rows for e in entries) == 400 and sum(e.n_bytes for e in entries) >= 4_000_000
    store.upsert_posts(posts(spark, [8], 3), 0, 3)
    assert store.compact("posts", bytes_per_range=500_000)
    # The new batch touches one range; the others are not taken for too many.
    after = ranges._entries(ranges.until())[0]
    assert len(set(entries) & set(after)) == len(entries) - 1
    assert sorted(r.like_count for r in store.read("posts").where("like_count > 1").collect()) == [2, 3]


def test_a_large_table_gets_larger_ranges_not_more(spark, store, monkeypatch):
    monkeypatch.setattr("postsieve.sinks.ranges.MAX_RANGES", 8)
    for epoch, ids in enumerate([range(800), range(400, 1200), [3]]):
        store.upsert_posts(posts(spark, ids, epoch), 0, epoch)
    assert store.compact("posts", 10)
    ranges = store.ranges("posts")
    assert 4 <= len(ranges._entries(ranges.until())[0]) <= 9
    assert content(store.read("posts")) == sorted((f"p{i:04d}", 2 if i == 3 else int(i >= 400)) for i in range(1200))
