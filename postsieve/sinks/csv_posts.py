"""Append-only CSV folder of posts."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from postsieve.operators.arrivals import anti_seen
from postsieve.session import path_exists
from postsieve.sources.files import CSV_OPTIONS, header, scan_posts_csv


def unseen_rows(posts: DataFrame, path: str) -> DataFrame:
    """Posts whose id the folder does not hold; repeats within ``posts`` stay."""
    if not path_exists(posts.sparkSession, path):
        return posts
    stored = scan_posts_csv(posts.sparkSession, path).select("external_id").distinct()
    return anti_seen(posts, stored)


def append_unseen_csv(posts: DataFrame, path: str) -> int:
    """Append the unseen posts with all their columns and return how many there were.

    Lists are written as JSON text.  Every file carries the header, so any file of the
    folder can be read alone; what comes later is brought into the columns of the
    folder, and a column it does not have is an error.  Without unseen posts nothing
    is written.
    """
    lists = [f.name for f in posts.schema if isinstance(f.dataType, (ArrayType, MapType, StructType))]
    rows = posts.withColumns({c: F.to_json(c) for c in lists})
    if path_exists(posts.sparkSession, path):
        columns = header(posts.sparkSession, path)
        if new := [c for c in rows.columns if c not in columns]:
            raise ValueError(f"{path} has no column {', '.join(new)}")
        rows = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in columns])
    rows = unseen_rows(rows, path)
    if rows.isEmpty():
        return 0
    written = Observation()
    rows.observe(written, F.count(F.lit(1)).alias("n")).write.mode("append").options(
        **CSV_OPTIONS
    ).csv(path)
    return written.get["n"]
