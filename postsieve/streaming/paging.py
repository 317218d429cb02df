"""Incremental collection of pages: a cursor and a stop per keyword, and a table of rejects."""

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.operators import progress
from postsieve.sinks.store import Store
from postsieve.streaming.ingest import run_of, write_batch

MAX_ROWS = 1000  # ten pages of a hundred candidates


def _own(store: Store, table: str, run: int, epoch: int) -> DataFrame:
    """What earlier batches of this run wrote; other runs have cursors of their own."""
    return store.before(table, run, epoch).where(F.col("run") == run)


def write_pages(
    pages: DataFrame,
    keywords: DataFrame,
    store: Store,
    run: int,
    epoch: int,
    max_rows: int = MAX_ROWS,
    mode: str = "all",
    lemmas: DataFrame | None = None,
) -> dict[str, int]:
    """Collect one batch of pages; returns the rows written.

    A broken page ends its keyword for the rest of the run: that page and those after it
    go to ``page_rejects``, what came before stays, other keywords go on.  Pages up
    to a keyword's cursor were read already, and a keyword takes ``max_rows`` candidates over
    all batches.  All is worked out from earlier batches and written to partitions of this
    one, so a replay gives the same.
    """
    cursor = progress.cursor_of(_own(store, "page_cursors", run, epoch)).persist(StorageLevel.MEMORY_AND_DISK)
    stopped = progress.stops(_own(store, "page_rejects", run, epoch))
    read = progress.read_pages(pages).persist(StorageLevel.MEMORY_AND_DISK)
    taken, rejects = progress.split_pages(read, stopped)
    taken = progress.after_cursor(taken, cursor, max_rows)
    capped = progress.cap_after_cursor(progress.page_candidates(taken), cursor, max_rows)
    capped = capped.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        written = {
            "page_rejects": store.append("page_rejects", rejects, run, epoch),
            "page_cursors": store.append("page_cursors", progress.cursor_rows(taken, capped), run, epoch),
        }
        return written | write_batch(capped, keywords, store, run, epoch, mode, lemmas, counts=True)
    finally:
        for frame in (capped, read, cursor):
            frame.unpersist()


def ingest_pages(
    pages: DataFrame,
    keywords: DataFrame,
    store: Store,
    checkpoint: str,
    max_rows: int = MAX_ROWS,
    mode: str = "all",
    lemmas: DataFrame | None = None,
) -> list[dict[str, int]]:
    """Work through all waiting pages, batch by batch, and stop; a later call goes on where each keyword stands.

    The pages of a keyword must land in their order.  Returns the rows written per batch.
    """
    run = run_of(store.spark, store, checkpoint)
    written: list[dict[str, int]] = []

    def batch(rows: DataFrame, epoch: int) -> None:
        written.append(write_pages(rows, keywords, store, run, epoch, max_rows, mode, lemmas))

    query = (
        pages.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return written
