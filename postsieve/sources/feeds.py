"""Candidate posts as a stream of files, in place of a paged search with a cursor."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsieve.schemas import CANDIDATES


def stream_candidates(
    spark: SparkSession,
    folder: str,
    schema: T.StructType = CANDIDATES,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Files as they land in ``folder``.  The query's checkpoint is the cursor,
    ``files_per_batch`` the page size."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def stream_pages(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Pages of search results as they land in ``folder``: (keyword_id, page, body).

    A line is a page: keyword id, page number and body, with a tab between.  Lines are
    read as text, so one that is broken stops nothing; what cannot be read of it is NULL.
    """
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    part = F.split("value", "\t", 3)
    number = [F.get(part, F.lit(i)).try_cast("long") for i in (0, 1)]
    return reader.text(folder).select(
        number[0].alias("keyword_id"), number[1].alias("page"), F.coalesce(F.get(part, F.lit(2)), F.col("value")).alias("body")
    )
