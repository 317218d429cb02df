"""Incremental collection: each micro-batch is one page of candidates."""

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from postsieve.operators.progress import keyword_delta
from postsieve.operators.upsert import bridge_rows
from postsieve.plans.collect import collect_all, collect_first_seen
from postsieve.session import path_exists
from postsieve.sinks.store import Store

MODES = {"all": collect_all, "first_seen": collect_first_seen}


def run_of(spark: SparkSession, store: Store, checkpoint: str) -> int:
    """The run number that belongs to a checkpoint.

    It is kept inside the checkpoint, so a restart goes on with its run and a
    fresh checkpoint starts a new one.
    """
    path = f"{checkpoint}/store_run"
    newest = store.newest_run()
    stored = spark.read.schema("run int").json(path).first() if path_exists(spark, path) else None
    if stored is None:
        run = newest + 1
        spark.createDataFrame([(run,)], "run int").write.mode("overwrite").json(path)
        return run
    if stored.run < newest:
        raise ValueError(f"run {stored.run} is over: run {newest} has written to {store.base}")
    return stored.run


def write_batch(
    candidates: DataFrame,
    keywords: DataFrame,
    store: Store,
    run: int,
    epoch: int,
    mode: str = "all",
    lemmas: DataFrame | None = None,
    counts: bool = False,
) -> dict[str, int]:
    """Collect one batch of candidates and store it; returns the rows written.

    With ``counts`` the batch also leaves its candidates and new links per keyword.

    Posts first, seen ids last: a batch that breaks off in between is done again
    and overwrites its own partitions.  If that is done from a fresh checkpoint, the
    links are there already under another run, so links are inserted only if absent;
    ids, written last, are new whenever they come this far.
    """
    seen = store.seen_among(candidates, run, epoch)
    options = {"lemmas": lemmas} if mode == "all" else {}
    collected = MODES[mode](candidates, keywords, seen, **options)
    # Both are used more than once; the batch itself is read for them only once.
    base = collected.base.persist(StorageLevel.MEMORY_AND_DISK)
    matched = collected.posts.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        written = {
            "posts": store.upsert_posts(matched, run, epoch),
            "post_keywords": store.insert_links(bridge_rows(matched), run, epoch),
        }
        if counts:
            new_links = store.batch("post_keywords", run, epoch)
            written["keyword_deltas"] = store.append("keyword_deltas", keyword_delta(candidates, new_links), run, epoch)
        return written | {"scanned_posts": store.append_seen(collected.seen, run, epoch)}
    finally:
        matched.unpersist()
        base.unpersist()


def ingest_posts(
    candidates: DataFrame,
    keywords: DataFrame,
    store: Store,
    checkpoint: str,
    mode: str = "all",
    dedup_state: bool = False,
    lemmas: DataFrame | None = None,
    counts: bool = False,
) -> list[dict[str, int]]:
    """Work through all waiting candidates, batch by batch, and stop.

    ``mode`` is ``all`` (every keyword is tested, with ``lemmas`` also its plural and
    lemma) or ``first_seen``.  Ids are
    compared with the seen table; with ``dedup_state`` repeats within the stream
    are also dropped by the stream's own state, which spares the batches that are
    repeats only (choose the RocksDB state store for large id sets).  Returns the
    rows written per batch.
    """
    spark = store.spark
    run = run_of(spark, store, checkpoint)
    written: list[dict[str, int]] = []

    def page(batch: DataFrame, epoch: int) -> None:
        written.append(write_batch(batch, keywords, store, run, epoch, mode, lemmas, counts))

    if dedup_state and mode != "all":
        raise ValueError("dedup_state keeps any copy of a repeated id; first_seen needs the first")
    stream = candidates.dropDuplicates(["external_id"]) if dedup_state else candidates
    query = (
        stream.writeStream.foreachBatch(page)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return written

