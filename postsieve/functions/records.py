"""The post record as Column expressions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsieve.functions.text import post_text
from postsieve.schemas import COUNTS


def labels_json(labels: Column, kind: str = "array") -> Column:
    """Labels as JSON text, a list in any case.  Absent fields are written out."""
    text = labels if kind == "string" else F.to_json(labels, {"ignoreNullFields": "false"})
    return F.coalesce(text, F.lit("[]"))


def embed_json(embed: Column, kind: str = "struct") -> Column:
    """The embedded object as JSON text, or the JSON ``null``."""
    text = embed if kind == "string" else F.to_json(embed, {"ignoreNullFields": "false"})
    return F.when(embed.isNull(), F.lit("null")).otherwise(text)


def post_record(posts: DataFrame) -> DataFrame:
    """Found posts in the shape of the posts table.

    Text in lower case, missing counts as 0, labels and embed as JSON text; other
    columns (``language``, ``keyword_id``, ...) pass through.
    """
    kinds = dict(posts.dtypes)
    own = {"external_id", "text", "created_at", "labels", "embed", *COUNTS}
    return posts.select(
        "external_id",
        post_text(F.col("text")).alias("content"),
        "created_at",
        *[F.coalesce(c, F.lit(0)).cast("int").alias(c) for c in COUNTS],
        labels_json(F.col("labels"), kinds["labels"]).alias("labels"),
        embed_json(F.col("embed"), kinds["embed"]).alias("embed"),
        *[c for c in posts.columns if c not in own],
    )
