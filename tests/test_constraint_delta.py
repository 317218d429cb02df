import random

import pytest
from pyspark.sql import functions as F

from postsieve import schemas
from postsieve.operators import integrity
from postsieve.plans.check import check_batch, constraint_state
from postsieve.sinks.store import Store

SHAPES = {
    "categories": lambda r: (r.choice([1, 2, 3, None]), r.choice(["a", "b", None])),
    "keywords": lambda r: (r.choice([1, 2, 3, 4, None]), r.choice([1, 2, 5, None]), r.choice(["x", "y"]), r.choice(["en", None])),
    "posts": lambda r: (r.choice(["p", "q", "r", None]), r.choice(["t", "u", None])),
    "post_keywords": lambda r: (r.choice(["p", "q", "s", None]), r.choice([1, 2, 9, None])),
    "scanned_posts": lambda r: (r.choice(["p", "q", None]),),
}
SCHEMAS = {t: s if t != "posts" else "external_id string, content string" for t, s in schemas.TABLES.items()}


def counts(report):
    return {(r.table_name, r.rule, r.columns): r.violations for r in report.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_delta_equals_recount(spark, seed):
    """Random rows come and go; violations before plus the delta are those counted anew."""
    r = random.Random(seed)
    before = {t: [make(r) for _ in range(r.randint(0, 12))] for t, make in SHAPES.items()}
    gone = {t: r.sample(rows, len(rows) // 3) for t, rows in before.items()}
    came = {t: [make(r) for _ in range(r.randint(0, 6))] for t, make in SHAPES.items()}
    if seed == 1:  # tables that no batch touches
        for name in ("posts", "keywords"):
            gone[name], came[name] = [], []
    after = {}
    for t, rows in before.items():
        left = list(rows)
        for row in gone[t]:
            left.remove(row)
        after[t] = left + came[t]

    def frames(tables):
        return {t: spark.createDataFrame(rows, SCHEMAS[t]) for t, rows in tables.items()}

    old, new = frames(before), frames(after)
    changes = {
        t: spark.createDataFrame(came[t], SCHEMAS[t]).withColumn("_sign", F.lit(1)).unionByName(
            spark.createDataFrame(gone[t], SCHEMAS[t]).withColumn("_sign", F.lit(-1)))
        for t in SHAPES if came[t] or gone[t]
    }
    delta = counts(integrity.constraint_delta(changes, lambda table, column, values: old[table]))
    was, want = counts(integrity.constraint_report(old)), counts(integrity.constraint_report(new))
    assert {k: n + delta.get(k, 0) for k, n in was.items()} == want


def test_store_keeps_the_violations(spark, folder):
    """Planted faults, an upsert, deletions of both kinds, a replay and a compaction."""
    store = Store(spark, folder + "/store")
    store.bootstrap()

    def write(name, rows, epoch):
        frame = spark.createDataFrame(rows, SCHEMAS[name])
        for field in schemas.TABLES[name]:
            if field.name not in frame.columns:
                frame = frame.withColumn(field.name, F.lit(None).cast(field.dataType))
        store.append(name, frame, 0, epoch)

    def agrees(epoch):
        check_batch(store, 0, epoch)
        want = counts(integrity.constraint_report({t: store.read(t) for t in schemas.TABLES}))
        assert counts(constraint_state(store)) == want
        return {k: n for k, n in want.items() if n}

    write("categories", [(1, "a"), (1, "b")], 0)
    write("keywords", [(1, 1, "x", "en"), (2, 9, "y", None)], 0)
    write("posts", [("p", "t"), ("q", None), ("r", "u")], 0)
    write("post_keywords", [("p", 1), ("q", 2), ("z", 1), ("z", 7), ("p", 1)], 0)
    assert len(agrees(0)) == 7
    write("posts", [("q", "now a text"), ("z", "now here")], 1)
    write("post_keywords", [("r", 2), ("r", 8)], 1)
    write("scanned_posts", [("p",), ("p",), (None,)], 1)
    agrees(1)
    for name in ("posts", "post_keywords", "scanned_posts"):
        store.compact(name, 1)
    # The links of a deleted post and of a deleted keyword go with them; one link has both.
    store.delete(0, 2, spark.createDataFrame([("p",)], "external_id string"), spark.createDataFrame([(1,)], "id long"))
    write("keywords", [(7, 1, "w", "en")], 2)
    assert agrees(2) == agrees(2)  # a replay changes nothing


def test_only_touched_ranges_of_posts_are_read(spark, folder):
    store = Store(spark, folder + "/store")
    store.bootstrap()
    ids = spark.range(200).select(F.format_string("p%03d", "id").alias("external_id"), F.lit("t").alias("content"))
    for field in schemas.POSTS:
        if field.name not in ids.columns:
            ids = ids.withColumn(field.name, F.lit(None).cast(field.dataType))
    store.upsert_posts(ids, 0, 0)
    store.upsert_posts(ids.where("external_id = 'p199'"), 0, 1)
    store.compact("posts", 10)
    keys = spark.createDataFrame([("p055",), ("p056",)], "external_id string")
    ranges = store.ranges("posts")
    assert len(ranges.near(keys).inputFiles()) <= 2 < len(ranges.rows().inputFiles())
    assert store.as_of("posts", 0, 2, keys).join(keys, "external_id", "left_semi").count() == 2
