"""File sources: CSV posts, CSV keywords, parquet tables."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsieve.schemas import KEYWORDS_CSV, POSTS_CSV

# Quotes are doubled inside quoted fields, and blanks at the edge belong to the field.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def wall_time(text: Column) -> Column:
    """A time without zone; one that names its zone is taken to UTC first."""
    instant = F.to_utc_timestamp(text.try_cast("timestamp"), F.current_timezone()).cast("timestamp_ntz")
    zoned = text.rlike(r"(?i)(Z|UTC|[+-][0-9]{2}:?[0-9]{2})\s*$") & text.rlike(":")
    return F.when(zoned, instant).otherwise(text.try_cast("timestamp_ntz"))


def _by_header(spark: SparkSession, path: str, schema: T.StructType, required: list[str], **options) -> DataFrame:
    """Columns by their names in the header: those of ``schema`` first, absent ones NULL,
    then all others as text.  The files of a folder must have the same header."""
    rows = spark.read.options(**CSV_OPTIONS, **options, enforceSchema="false").csv(path)
    if missing := [c for c in required if c not in rows.columns]:
        raise ValueError(f"{path} has no column {', '.join(missing)}")

    def typed(field: T.StructField) -> Column:
        if field.name not in rows.columns:
            return F.lit(None).cast(field.dataType)
        own = F.col(f"`{field.name}`")
        return wall_time(own) if isinstance(field.dataType, T.TimestampNTZType) else own.try_cast(field.dataType)

    known = [typed(field).alias(field.name) for field in schema]
    return rows.select(*known, *[F.col(f"`{c}`") for c in rows.columns if c not in schema.names])


def header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file or folder, in their order there."""
    return spark.read.options(**CSV_OPTIONS, multiLine="true").csv(path).columns


def scan_posts_csv(spark: SparkSession, path: str) -> DataFrame:
    """Posts from a CSV file or folder; contents may span lines, empty ones are ''.

    Needs external_id and content; further columns are kept as text.
    """
    rows = _by_header(spark, path, POSTS_CSV, ["external_id", "content"], multiLine="true")
    return rows.withColumn("content", F.coalesce("content", F.lit("")))


def scan_keywords_csv(spark: SparkSession, path: str) -> DataFrame:
    """Generated keywords: query, keyword, language, model; further columns as text."""
    return _by_header(spark, path, KEYWORDS_CSV, ["keyword", "language"])


def scan_project(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """The named columns of a parquet table; only these are read."""
    return spark.read.parquet(path).select(*columns)
