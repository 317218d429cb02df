"""Upsert and insert-if-absent as DataFrames."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postsieve.operators.sizing import fits_broadcast


def latest_per_key(versions: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The newest version of each key; one row per key and task is shuffled."""
    window = Window.partitionBy(*key).orderBy(*[F.col(c).desc() for c in order])
    return versions.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def upsert(
    current: DataFrame,
    batch: DataFrame,
    key: list[str],
    order: list[str],
) -> DataFrame:
    """``current`` after writing ``batch``: new keys come in, known keys take all
    values of the newest row of the batch.

    ``current`` holds one row per key; ``order`` gives the sequence within the
    batch.  A batch with few keys is anti-joined by broadcast, and ``current``
    is neither shuffled nor sorted.
    """
    newest = latest_per_key(batch, key, order)
    keys = batch.select(*key).distinct()
    replaced = F.broadcast(keys) if fits_broadcast(keys) else keys
    return current.join(replaced, key, "left_anti").unionByName(newest)


def insert_absent(current: DataFrame, batch: DataFrame, key: list[str]) -> DataFrame:
    """The rows of ``batch`` to append: distinct, and not yet in ``current``."""
    return batch.dropDuplicates(key).join(current.select(*key), key, "left_anti")


def bridge_rows(matched: DataFrame, id_col: str = "external_id") -> DataFrame:
    """One (post, keyword) row per matched keyword id."""
    return matched.select(id_col, F.explode("keyword_ids").alias("keyword_id"))
