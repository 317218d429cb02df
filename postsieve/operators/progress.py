"""How far a run has come: pages per keyword, rows taken, counts kept up by batch."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postsieve.operators.arrivals import cap_per_keyword
from postsieve.operators.sizing import fits_broadcast
from postsieve.schemas import CANDIDATES, PAGE_POST

BROKEN, AFTER = "broken", "after a broken page"

# Up to this cap Spark cuts what it ranks within each task (spark.sql.optimizer.windowGroupLimitThreshold).
_CUT_EARLY = 1000


def read_pages(pages: DataFrame) -> DataFrame:
    """Pages with their posts, and ``broken`` where the body is no JSON array of posts with id
    and text, or keyword or page is missing.  A page without posts is whole."""
    posts = F.from_json("body", f"array<{PAGE_POST.simpleString()}>")
    # An array of variants takes no further look at what they hold.
    whole = F.try_variant_get(F.try_parse_json("body"), "$", "array<variant>").isNotNull() & F.col("posts").isNotNull()
    faulty = F.exists("posts", lambda p: p.isNull() | p["external_id"].isNull() | p["text"].isNull())
    known = F.col("keyword_id").isNotNull() & F.col("page").isNotNull()
    ok = F.coalesce(whole & ~faulty & known, F.lit(False))
    return pages.withColumn("posts", posts).withColumn("broken", ~ok)


def stops(rejects: DataFrame) -> DataFrame:
    """The first broken page of each keyword: (keyword_id, stop)."""
    broken = rejects.where((F.col("reason") == BROKEN) & F.col("keyword_id").isNotNull() & F.col("page").isNotNull())
    return broken.groupBy("keyword_id").agg(F.min("page").alias("stop"))


def split_pages(read: DataFrame, stopped: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pages before the break of their keyword, and the rejects (keyword_id, page, reason, body).

    ``stopped``: breaks of earlier batches.  A broken page ends its keyword only;
    one whose keyword or page cannot be read ends none.
    """
    here = read.where("broken").select("keyword_id", "page", F.lit(BROKEN).alias("reason"))
    ends = stops(here).unionByName(stopped).groupBy("keyword_id").agg(F.min("stop").alias("stop"))
    if fits_broadcast(ends):
        ends = F.broadcast(ends)
    marked = read.join(ends, "keyword_id", "left")
    taken = ~F.col("broken") & (F.col("stop").isNull() | (F.col("page") < F.col("stop")))
    reason = F.when(F.col("broken"), BROKEN).otherwise(AFTER).alias("reason")
    return marked.where(taken).drop("stop", "broken"), marked.where(~taken).select("keyword_id", "page", reason, "body")


def page_candidates(pages: DataFrame) -> DataFrame:
    """One candidate per post of a page, in the order of the page."""
    rows = pages.select("keyword_id", "page", F.posexplode("posts").alias("pos", "post"))
    rows = rows.select(F.col("keyword_id").alias("kw_seq"), "keyword_id", "page", "pos", "post.*")
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CANDIDATES])


def cursor_of(cursors: DataFrame) -> DataFrame:
    """Where each keyword stands after some batches: last page, rows taken."""
    return cursors.groupBy("keyword_id").agg(F.max("last_page").alias("last_page"), F.sum("n_rows").alias("n_rows"))


def after_cursor(pages: DataFrame, cursor: DataFrame, rows: int) -> DataFrame:
    """Pages behind the last one of their keyword, if that may still take rows."""
    if fits_broadcast(cursor):
        cursor = F.broadcast(cursor)
    new = F.col("last_page").isNull() | ((F.col("page") > F.col("last_page")) & (F.col("n_rows") < rows))
    return pages.join(cursor, "keyword_id", "left").where(new).drop("last_page", "n_rows")


def cap_after_cursor(candidates: DataFrame, cursor: DataFrame, rows: int) -> DataFrame:
    """The next candidates of each keyword, until it has ``rows`` of them over all batches.

    Candidates are cut to ``rows`` of a keyword first, task by task; what is ranked with the cursor
    is bounded by that. With a large cap that cuts little, so there candidates are counted before, and only
    those of keywords that exceed the cap are ranked.
    """
    if fits_broadcast(cursor):
        cursor = F.broadcast(cursor)
    taken = F.coalesce(F.col("n_rows"), F.lit(0).cast("long"))
    order = Window.partitionBy("keyword_id").orderBy("page", "pos", "external_id")

    def cut(some: DataFrame) -> DataFrame:
        capped = cap_per_keyword(some, rows).withColumn("_rn", F.row_number().over(order))
        return capped.join(cursor, "keyword_id", "left").where(F.col("_rn") + taken <= rows).select(*candidates.columns)

    if rows <= _CUT_EARLY:
        return cut(candidates)
    counts = candidates.groupBy("keyword_id").agg(F.count("*").alias("_n"))
    over = counts.join(cursor, "keyword_id", "left").where(F.col("_n") + taken > rows)
    over = over.select(F.col("keyword_id").alias("_over"))
    if over.isEmpty():
        return candidates
    over = F.broadcast(over) if fits_broadcast(over) else over
    same = F.col("keyword_id").eqNullSafe(F.col("_over"))
    return candidates.join(over, same, "left_anti").unionByName(cut(candidates.join(over, same, "left_semi")))


def cursor_rows(pages: DataFrame, capped: DataFrame) -> DataFrame:
    """What a batch adds to the cursor of each keyword: (keyword_id, last_page, n_rows)."""
    last = pages.groupBy("keyword_id").agg(F.max("page").alias("last_page"))
    taken = capped.groupBy("keyword_id").agg(F.count("*").alias("n_rows"))
    return last.join(taken, "keyword_id", "left").na.fill(0, ["n_rows"])


def keyword_delta(candidates: DataFrame, new_links: DataFrame) -> DataFrame:
    """What a batch adds per keyword: candidates received, links that are new."""
    received = candidates.groupBy("keyword_id").agg(F.count("*").alias("received"))
    matched = new_links.groupBy("keyword_id").agg(F.count("*").alias("matched"))
    return received.join(matched, "keyword_id", "full").na.fill(0, ["received", "matched"])


def totals(deltas: DataFrame) -> DataFrame:
    """Counts per keyword over all batches, from their deltas alone."""
    return deltas.groupBy("keyword_id").agg(F.sum("received").alias("received"), F.sum("matched").alias("matched"))


def counts_by_batch(deltas: DataFrame) -> DataFrame:
    """Per batch what it received and matched, and the sums up to it.

    Deltas are added up per batch first: the window runs over one row a batch.
    """
    per_batch = deltas.groupBy("run", "epoch").agg(F.sum("received").alias("received"), F.sum("matched").alias("matched"))
    so_far = Window.orderBy("run", "epoch").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_batch.withColumn("total_received", F.sum("received").over(so_far)).withColumn(
        "total_matched", F.sum("matched").over(so_far)
    )
