import os

import pytest
from pyspark.sql import functions as F

from postsieve import schemas
from postsieve.operators import integrity, reports
from postsieve.sinks.csv_posts import append_unseen_csv
from postsieve.session import work_folder
from postsieve.sinks.store import Store
from postsieve.sources.files import scan_posts_csv


def posts(spark, rows):
    """rows: (external_id, content, like_count)"""
    frame = spark.createDataFrame(rows, "external_id string, content string, like_count int")
    for field in schemas.POSTS:
        if field.name not in frame.columns:
            frame = frame.withColumn(field.name, F.lit(None).cast(field.dataType))
    return frame


@pytest.fixture
def store(spark, folder):
    made = Store(spark, folder + "/store")
    made.bootstrap()
    return made


def likes(store):
    return {r.external_id: r.like_count for r in store.read("posts").collect()}


def test_bootstrap_declares_empty_tables(store):
    for table, schema in schemas.TABLES.items():
        assert store.read(table).schema.names == schema.names
        assert store.read(table).count() == 0
    assert store.newest_run() == -1


def test_upsert_keeps_the_newest_and_replays(spark, store):
    assert store.upsert_posts(posts(spark, [("a", "x", 1), ("b", "y", 1)]), 0, 0) == 2
    store.upsert_posts(posts(spark, [("a", "x", 2)]), 0, 1)
    store.upsert_posts(posts(spark, [("b", "y", 3)]), 1, 0)
    assert likes(store) == {"a": 2, "b": 3}
    # An old and the newest batch again: nothing changes.
    store.upsert_posts(posts(spark, [("a", "x", 1), ("b", "y", 1)]), 0, 0)
    store.upsert_posts(posts(spark, [("b", "y", 3)]), 1, 0)
    assert likes(store) == {"a": 2, "b": 3}


def test_links_and_ids_are_inserted_once(spark, store):
    links = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "external_id string, keyword_id long")
    ids = links.select("external_id")
    for _ in range(2):  # the same batch twice
        assert store.insert_links(links, 0, 0) == 2
        assert store.insert_seen(ids, 0, 0) == 2
    more = spark.createDataFrame([("a", 1), ("a", 2), ("c", 1)], "external_id string, keyword_id long")
    assert store.insert_links(more, 0, 1) == 2
    assert store.insert_seen(more.select("external_id"), 0, 1) == 1
    assert sorted(map(tuple, store.read("post_keywords").collect())) == [("a", 1), ("a", 2), ("b", 1), ("c", 1)]
    assert sorted(r[0] for r in store.read("scanned_posts").collect()) == ["a", "b", "c"]


@pytest.mark.parametrize("keep_seen", [True, False])
def test_reset(spark, store, keep_seen):
    store.upsert_posts(posts(spark, [("a", "x", 1)]), 0, 0)
    store.insert_seen(spark.createDataFrame([("a",)], "external_id string"), 0, 0)
    store.bootstrap(reset=True, keep_seen=keep_seen)
    assert store.read("posts").count() == 0
    assert store.read("scanned_posts").count() == int(keep_seen)


def test_register_lists_the_tables(spark, store):
    store.upsert_posts(posts(spark, [("a", "x", 1)]), 0, 0)
    store.register("monitor_test")
    assert sorted(t.name for t in spark.catalog.listTables("monitor_test")) == sorted(schemas.TABLES)
    assert spark.table("monitor_test.posts").count() == 1
    # Later batches show at once, replaced versions do not.
    store.upsert_posts(posts(spark, [("a", "y", 2), ("b", "z", 1)]), 0, 1)
    rows = spark.table("monitor_test.posts")
    assert rows.columns == schemas.POSTS.names
    assert sorted((r.external_id, r.content) for r in rows.collect()) == [("a", "y"), ("b", "z")]
    spark.sql("DROP DATABASE monitor_test CASCADE")


AWKWARD = [
    ("1", 'say "hi", twice', 1),
    ("2", "line\nbreak\n\nand, comma", 2),
    ("3", "", 3),
    ("4", "  edges  ", 4),
    ("5", "back\\slash \\\"", 5),
    ("6", '"', 6),
    ("7", "#comment 🤔", 7),
]


def test_csv_round_trip_and_append(spark, folder):
    path = folder + "/posts_csv"
    assert append_unseen_csv(posts(spark, AWKWARD), path) == len(AWKWARD)
    got = scan_posts_csv(spark, path).orderBy("external_id").collect()
    assert [(r.external_id, r.content, r.like_count) for r in got] == AWKWARD
    # Known ids stay out, repeats within the batch stay in.
    batch = [("1", "again", 0), ("8", "new", 0), ("8", "new again", 0)]
    assert append_unseen_csv(posts(spark, batch), path) == 2
    assert scan_posts_csv(spark, path).count() == len(AWKWARD) + 2
    assert append_unseen_csv(posts(spark, batch), path) == 0
    assert scan_posts_csv(spark, path).count() == len(AWKWARD) + 2


def test_csv_keeps_every_field(spark, folder):
    rows = posts(spark, [("1", "x", 1)]).withColumns(
        {"language": F.lit("fr"), "embed": F.lit('{"a": 1}'), "keyword_ids": F.array(F.lit(3), F.lit(5))}
    )
    append_unseen_csv(rows, folder + "/csv")
    got = scan_posts_csv(spark, folder + "/csv").first()
    assert (got.language, got.embed, got.keyword_ids) == ("fr", '{"a": 1}', "[3,5]")
    with pytest.raises(ValueError, match="no column other"):
        append_unseen_csv(rows.withColumn("other", F.lit(1)), folder + "/csv")


def test_csv_writes_nothing_for_no_posts(spark, folder):
    assert append_unseen_csv(posts(spark, [("1", "x", 1)]).limit(0), folder + "/none") == 0
    assert not os.path.exists(folder + "/none")


def test_csv_columns_by_name(spark, folder):
    with open(folder + "/p.csv", "w") as file:
        file.write("category,created_at,like_count,content,external_id\n")
        file.write("art,2025-03-01T10:00:00.000Z,7,hi,1\nlaw,2025-03-01 10:00:00,x,,2\nlaw,2025-03-01T12:00:00+02:00,,a,3\n")
    rows = scan_posts_csv(spark, folder + "/p.csv").orderBy("external_id").collect()
    assert [(r.external_id, r.content, r.like_count, r.category) for r in rows] == [
        ("1", "hi", 7, "art"), ("2", "", None, "law"), ("3", "a", None, "law")
    ]
    assert {str(r.created_at) for r in rows} == {"2025-03-01 10:00:00"}
    with open(folder + "/q.csv", "w") as file:
        file.write("id,content\n1,x\n")
    with pytest.raises(ValueError, match="external_id"):
        scan_posts_csv(spark, folder + "/q.csv")


def test_a_cluster_must_name_its_folder():
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_folder(Session())


def test_csv_null_content_is_empty(spark, folder):
    append_unseen_csv(posts(spark, [("1", None, 1)]), folder + "/csv")
    assert scan_posts_csv(spark, folder + "/csv").first().content == ""


def test_constraint_report(spark):
    tables = {
        "categories": spark.createDataFrame([(1, "a"), (2, "a"), (None, "b")], "id long, category string"),
        "keywords": spark.createDataFrame(
            [(1, 1, "x", "en"), (2, 1, "x", "en"), (3, 9, "y", None), (4, None, "z", "fr")],
            "id long, category_id long, keyword string, language string",
        ),
        "posts": spark.createDataFrame([("p", "t"), ("q", None)], "external_id string, content string"),
        "post_keywords": spark.createDataFrame(
            [("p", 1), ("p", 1), ("r", 1), ("r", 8)], "external_id string, keyword_id long"
        ),
        "scanned_posts": spark.createDataFrame([("p",)], "external_id string"),
    }
    report = {(r.table_name, r.rule, r.columns): r.violations for r in integrity.constraint_report(tables).collect()}
    assert {k: v for k, v in report.items() if v} == {
        ("categories", "unique", "category"): 1,
        ("categories", "not null", "id"): 1,
        ("keywords", "unique", "category_id,keyword,language"): 1,
        ("keywords", "not null", "language"): 1,
        ("keywords", "references categories", "category_id"): 1,
        ("posts", "not null", "content"): 1,
        ("post_keywords", "unique", "external_id,keyword_id"): 1,
        ("post_keywords", "references posts", "external_id"): 2,
        ("post_keywords", "references keywords", "keyword_id"): 1,
    }
    assert len(report) == 21
    twice = spark.createDataFrame([("p", "t"), ("p", "u"), ("q", "t"), ("q", "t")], "external_id string, content string")
    report = {r.columns: r.violations for r in integrity.constraint_report({"posts": twice}).collect() if r.rule == "unique"}
    assert report == {"external_id": 2, "external_id,content": 1}
    orphans = integrity.fk_orphans(tables["post_keywords"], "external_id", tables["posts"], "external_id")
    assert orphans.count() == 2
    kept = integrity.cascade_delete(tables["post_keywords"], tables["posts"].filter("external_id = 'p'"), "external_id")
    assert sorted(map(tuple, kept.collect())) == [("r", 1), ("r", 8)]


def test_reports(spark):
    keywords = spark.createDataFrame([(1, "a", 7), (2, "b", 7), (3, "c", 8)], "id long, keyword string, category_id int")
    candidates = spark.createDataFrame([(1,), (1,), (2,)], "keyword_id long")
    matched = spark.createDataFrame([(1,)], "keyword_id long")
    counts = reports.keyword_counts(keywords, candidates, matched)
    got = [tuple(r) for r in reports.running_total(counts).orderBy("keyword_id").collect()]
    assert got == [(1, "a", 2, 1, 1), (2, "b", 1, 0, 1), (3, "c", 0, 0, 1)]
    categories = spark.createDataFrame([(7, "art"), (8, "law")], "id int, category string")
    bridge = spark.createDataFrame([("p", 1), ("p", 3), ("gone", 1)], "external_id string, keyword_id long")
    texts = spark.createDataFrame([("p", "t"), ("q", "u")], "external_id string, content string")
    rows = reports.posts_by_category(texts, bridge, keywords, categories).collect()
    assert sorted((r.external_id, r.category, r.keyword) for r in rows) == [("p", "art", "a"), ("p", "law", "c")]
    assert [r.external_id for r in reports.filter_word(texts, "T").collect()] == ["p"]
    assert [r.external_id for r in reports.filter_eq(texts, "content", "u").collect()] == ["q"]
    assert [r.id for r in reports.head_n(keywords, ["id"], 2).collect()] == [1, 2]
    assert {r.table_name: r.n_rows for r in reports.count_rows({"t": texts, "b": bridge}).collect()} == {"t": 2, "b": 3}


def test_compaction_changes_no_rows(spark, store):
    assert not store.compact("posts")
    store.upsert_posts(posts(spark, [("a", "x", 1), ("b", "y", 1)]), 0, 0)
    store.upsert_posts(posts(spark, [("a", "x", 2)]), 0, 1)
    store.upsert_posts(posts(spark, [("c", "z", 3)]), 1, 0)
    assert store.compact("posts") and not store.compact("posts")
    assert likes(store) == {"a": 2, "b": 1, "c": 3}
    # Only the newest versions are read, and the batch that may come again.
    assert store.versions("posts").count() == 3
    store.upsert_posts(posts(spark, [("c", "z", 4)]), 1, 0)
    store.upsert_posts(posts(spark, [("b", "y", 5)]), 1, 1)
    assert likes(store) == {"a": 2, "b": 5, "c": 4}
    assert store.compact("posts")
    assert likes(store) == {"a": 2, "b": 5, "c": 4}
    store.bootstrap(reset=True)
    assert likes(store) == {}


def test_compacted_ids_are_known(spark, store):
    for epoch, ids in enumerate([["a", "b"], ["c"], ["d"]]):
        store.insert_seen(spark.createDataFrame([(i,) for i in ids], "external_id string"), 0, epoch)
    assert store.compact("scanned_posts")
    more = spark.createDataFrame([("a",), ("d",), ("e",)], "external_id string")
    assert store.insert_seen(more, 0, 3) == 1
    assert sorted(r[0] for r in store.read("scanned_posts").collect()) == list("abcde")


def test_a_broken_compaction_does_not_count(spark, store):
    store.insert_seen(spark.createDataFrame([("a",)], "external_id string"), 0, 0)
    store.insert_seen(spark.createDataFrame([("b",)], "external_id string"), 0, 1)
    os.makedirs(store.path("scanned_posts") + "/_compacted/0-1")
    assert sorted(r[0] for r in store.read("scanned_posts").collect()) == ["a", "b"]
    assert store.compact("scanned_posts")
    assert sorted(r[0] for r in store.read("scanned_posts").collect()) == ["a", "b"]
