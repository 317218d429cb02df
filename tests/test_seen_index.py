import pytest
from pyspark.sql import functions as F

from postsieve.sinks import seen_index
from postsieve.sinks.seen_index import SeenIndex
from postsieve.sinks.store import Store


@pytest.fixture(autouse=True)
def few_buckets(monkeypatch):
    monkeypatch.setattr(seen_index, "BUCKETS", 16)


@pytest.fixture
def store(spark, folder):
    made = Store(spark, folder + "/store")
    made.bootstrap()
    made.index_seen()
    return made


def ids(spark, numbers):
    return spark.createDataFrame([(f"id{n}",) for n in numbers], "external_id string")


def seen(store):
    return sorted(r.external_id for r in store.read("scanned_posts").collect())


def among(store, numbers, run, epoch):
    found = SeenIndex(store).among(ids(store.spark, numbers), run, epoch)
    return sorted(int(r.external_id[2:]) for r in found.collect())


def test_only_new_ids_are_added(spark, store):
    assert store.insert_seen(ids(spark, [*range(20), *range(5)]), 0, 0) == 20
    assert store.insert_seen(ids(spark, range(10, 30)), 0, 1) == 10
    assert store.insert_seen(ids(spark, range(10, 30)), 0, 1) == 10  # done again
    assert store.insert_seen(ids(spark, range(30)), 1, 0) == 0
    assert store.insert_seen(ids(spark, []), 1, 1) == 0
    assert seen(store) == sorted(f"id{n}" for n in range(30))
    assert among(store, [3, 12, 25, 99], 0, 1) == [3, 12]
    assert among(store, [3, 12, 25, 99], 0, 0) == []


def test_null_and_odd_ids(spark, store):
    rows = spark.createDataFrame([("",), ("Ω",), ("x" * 10_000,)], "external_id string")
    store.insert_seen(rows, 0, 0)
    with_null = rows.union(spark.createDataFrame([(None,)], "external_id string"))
    assert SeenIndex(store).among(with_null, 0, 1).count() == 3


def test_a_large_batch_has_more_bitmaps(spark, store):
    many = spark.range(300_000).select(F.concat(F.lit("id"), "id").alias("external_id"))
    store.insert_seen(many, 0, 0)
    wide = [p[3] for p in SeenIndex(store).parts(0, 1) if p[0] == "batch"]
    assert wide == [16]
    assert among(store, [0, 299_999, 300_000], 0, 1) == [0, 299_999]
    # Needless reads are rare: 200 ids that were never seen.
    assert len(SeenIndex(store).hits(ids(spark, range(10**6, 10**6 + 200)), 0, 1)) <= 8


def test_reads_of_a_small_batch_do_not_grow_with_history(spark, store):
    files = []
    for epoch in range(7):
        store.insert_seen(ids(spark, range(epoch * 500, epoch * 500 + 500)), 0, epoch)
        batch = ids(spark, [0, 1, 10**7, 10**7 + 1])
        folders = SeenIndex(store).hits(batch, 0, epoch + 1)
        files.append(len(spark.read.parquet(*folders).inputFiles()))
    assert files[0] == 2 and max(files) <= 3
    total = spark.read.parquet(f"{store.base}/seen_index/ids").inputFiles()
    assert len(total) > 7 * 15


def test_folding_keeps_all_and_removes_what_it_replaced(spark, store, monkeypatch):
    monkeypatch.setattr(seen_index, "FOLD_AT", 2)
    for epoch in range(7):
        assert store.insert_seen(ids(spark, range(epoch * 5, epoch * 5 + 10)), 0, epoch) == (10 if epoch == 0 else 5)
    parts = SeenIndex(store).parts(0, 7)
    assert [p[0] for p in parts].count("folded") == 4 and len(parts) <= 4 + 2
    assert among(store, range(100), 0, 7) == list(range(40))
    assert len(seen_index.child_folders(spark, f"{store.base}/seen_index/ids")) <= 4 + 2 + 2
    assert store.insert_seen(ids(spark, range(30, 40)), 0, 6) == 5  # done again


def test_too_many_hits_read_all(spark, store, monkeypatch):
    store.insert_seen(ids(spark, range(50)), 0, 0)
    monkeypatch.setattr(seen_index, "MAX_FOLDERS", 3)
    assert SeenIndex(store).hits(ids(spark, range(50)), 0, 1) is None
    assert among(store, range(40, 60), 0, 1) == list(range(40, 50))


def test_a_batch_that_broke_off_is_not_seen(spark, store, monkeypatch):
    append = Store.append

    def failing(self, table, *args):
        if table == "scanned_posts":
            raise RuntimeError("lost")
        return append(self, table, *args)

    monkeypatch.setattr(Store, "append", failing)
    with pytest.raises(RuntimeError, match="lost"):
        store.insert_seen(ids(spark, range(5)), 0, 0)
    monkeypatch.setattr(Store, "append", append)
    assert among(store, range(5), 1, 0) == []
    assert store.insert_seen(ids(spark, range(5)), 1, 0) == 5


def test_index_of_an_older_store_and_forgotten_ids(spark, folder):
    store = Store(spark, folder + "/old")
    store.bootstrap()
    store.insert_seen(ids(spark, range(10)), 0, 0)
    store.index_seen()
    assert store.insert_seen(ids(spark, range(5, 15)), 1, 0) == 5
    store.delete(1, 1, posts=ids(spark, [2, 12]), forget=True)
    assert among(store, range(20), 1, 2) == [n for n in range(15) if n not in (2, 12)]
    assert store.insert_seen(ids(spark, range(15)), 1, 2) == 2
    assert among(store, range(20), 1, 3) == list(range(15))
    store.bootstrap(reset=True)
    assert store.insert_seen(ids(spark, range(20)), 2, 0) == 5
    store.bootstrap(reset=True, keep_seen=False)
    assert seen(store) == [] and not SeenIndex(store).exists()
