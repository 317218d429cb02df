"""Constraint checks that keep up with the batches of a store."""

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve import schemas
from postsieve.operators.integrity import constraint_delta
from postsieve.operators.sizing import fits_broadcast
from postsieve.session import path_exists
from postsieve.sinks.store import DELETED_BY, Store


def check_batch(store: Store, run: int, epoch: int) -> None:
    """Leave what the newest batch changes in the violations, in ``constraint_deltas``.

    To be called when all tables of the batch are written, deletions included, and before a later
    batch.  Of posts and seen ids only the ranges are read that the batch touches, and
    batches not yet compacted; links are scanned only where a keyword came or went.
    Done again it replaces its own rows.
    """
    changes = {t: rows.persist(StorageLevel.MEMORY_AND_DISK) for t in schemas.TABLES if (rows := _changes(store, t, run, epoch)) is not None}
    try:
        if changes:
            store.append("constraint_deltas", constraint_delta(changes, _stored(store, run, epoch)), run, epoch)
    finally:
        for rows in changes.values():
            rows.unpersist()


def constraint_state(store: Store) -> DataFrame:
    """The violations of every declared constraint, from what the batches left: no table is read."""
    names = [("unique", t, ",".join(k)) for t, keys in schemas.UNIQUE_KEYS.items() for k in keys]
    names += [("not null", t, c) for t, columns in schemas.NOT_NULL.items() for c in columns]
    names += [(f"references {parent}", child, c) for child, c, parent, _ in schemas.FOREIGN_KEYS]
    zero = store.spark.createDataFrame([(t, rule, c, 0) for rule, t, c in names], schemas.RUN_TABLES["constraint_deltas"])
    counts = zero.unionByName(store.read("constraint_deltas"))
    return counts.groupBy("table_name", "rule", "columns").agg(F.sum("violations").alias("violations"))


def _stored(store: Store, run: int, epoch: int):
    def stored(table: str, column: str, values: DataFrame) -> DataFrame:
        keys = values if column == schemas.TABLES[table].names[0] else None
        return store.as_of(table, run, epoch, keys)

    return stored


def _changes(store: Store, table: str, run: int, epoch: int) -> DataFrame | None:
    """The rows of a table that came and went with the batch; None if it does not concern the table."""
    written = store.batch(table, run, epoch) if path_exists(store.spark, store.batch_path(table, run, epoch)) else None
    gone = _gone(store, table, run, epoch)
    if written is None and not gone:
        return None
    key = schemas.TABLES[table].names[0]
    came = store.spark.createDataFrame([], schemas.TABLES[table]) if written is None else written
    for column, ids in gone.items():
        came = came.join(ids, column, "left_anti")
    went = []
    if table == "posts":
        # A post written again replaces its older self.
        ids = None if written is None else written.select(key)
        for more in gone.values():
            ids = more if ids is None else ids.unionByName(more)
        ids = ids.distinct()
        went.append(store.as_of(table, run, epoch, ids).join(_small(ids), key, "left_semi"))
    else:
        met = []
        for column, ids in gone.items():
            rows = store.as_of(table, run, epoch, ids if column == key else None)
            for other in met:  # a row that two deletions concern went once
                rows = rows.join(gone[other], other, "left_anti")
            went.append(rows.join(ids, column, "left_semi"))
            met.append(column)
    names = schemas.TABLES[table].names
    rows = came.select(*names, F.lit(1).alias("_sign"))
    for part in went:
        rows = rows.unionByName(part.select(*names, F.lit(-1).alias("_sign")))
    return rows


def _gone(store: Store, table: str, run: int, epoch: int) -> dict[str, DataFrame]:
    """The ids the batch deletes, by the column of the table they stand in."""
    if not path_exists(store.spark, store.batch_path("deletions", run, epoch)):
        return {}
    deletions = store.batch("deletions", run, epoch)
    if table == "scanned_posts":
        deletions = deletions.where("forget")
    found = {}
    for column, deleted in DELETED_BY.get(table, []):
        ids = deletions.where(F.col(deleted).isNotNull()).select(F.col(deleted).alias(column)).distinct()
        if not ids.isEmpty():
            found[column] = _small(ids)
    return found


def _small(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if fits_broadcast(ids) else ids
