"""Queries of collection by pages and of deletion."""

from pyspark.sql import functions as F

from postsieve.operators import progress
from postsieve.operators.numbering import running_sum
from postsieve.sinks.store import BATCH_TABLES, Store
from postsieve.sources.feeds import stream_pages
from postsieve.streaming.paging import ingest_pages, write_pages
from workload import inputs
from workload.inputs import HOLDS, table, with_sql
from workload.registry import query
from workload.storing import _FIVE, _filled_store, _new_folder

# No keyword comes near this.
_ALL_ROWS = 1 << 40

_CANDIDATES = with_sql("candidates")


def _pages(spark, sf_dir):
    """Candidates as pages: one per keyword and order, its parts in their order."""
    rows = inputs.candidates(spark, sf_dir)
    posts = F.array_sort(F.collect_list(F.struct("pos", "external_id", "text")))
    pages = rows.groupBy("keyword_id", "page").agg(posts.alias("posts"))
    return pages.withColumn("body", F.to_json(F.transform("posts", lambda p: F.struct(p["external_id"], p["text"]))))


def _land(pages, folder):
    pages.select(F.concat_ws("\t", F.col("keyword_id").cast("string"), F.col("page").cast("string"), "body")).write.mode(
        "append"
    ).text(folder)


def _thirds(spark, sf_dir, pages):
    """Pages in three batches by their number, so that each keyword's come in order."""
    # The rows have the numbers of the pages, and need not be put together for the last one.
    last = inputs.candidates(spark, sf_dir).agg(F.max("page")).first()[0] or 1
    third = F.floor(F.col("page") * 3 / F.lit(last + 1))
    return [pages.where(third == n) for n in range(3)]


def _new_store(spark):
    store = Store(spark, _new_folder(spark, "store"))
    store.bootstrap()
    return store


# Pages of partly delivered orders are cut short for the keywords of region 0.
_FAILURES = f"""{_CANDIDATES}, pages AS (SELECT DISTINCT keyword_id, page FROM candidates),
    bad AS (SELECT keyword_id, page FROM pages JOIN orders ON page = o_orderkey JOIN nation ON keyword_id = n_nationkey
            WHERE o_orderstatus = 'P' AND n_regionkey = 0),
    stops AS (SELECT keyword_id, min(page) AS stop FROM bad GROUP BY keyword_id)
    SELECT CASE WHEN b.page IS NULL THEN 'after a broken page' ELSE 'broken' END AS kind, p.keyword_id, p.page,
        CAST(NULL AS VARCHAR) AS external_id
    FROM pages p JOIN stops USING (keyword_id) LEFT JOIN bad b ON b.keyword_id = p.keyword_id AND b.page = p.page
    WHERE p.page >= stop
    UNION ALL
    SELECT DISTINCT 'seen', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), external_id FROM candidates
    LEFT JOIN stops USING (keyword_id) WHERE stop IS NULL OR page < stop"""


def _seen_rows(store):
    none = F.lit(None).cast("long")
    return store.read("scanned_posts").select(
        F.lit("seen").alias("kind"), none.alias("keyword_id"), none.alias("page"), "external_id"
    )


@query("ingest_failures", _FAILURES)
def ingest_failures(spark, sf_dir):
    """Broken pages end their keywords; the rejects and what arrived all the same, over three batches."""
    store, landing, checkpoint = _new_store(spark), _new_folder(spark, "landing"), _new_folder(spark, "checkpoint")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("page"), "o_orderstatus")
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("keyword_id"), "n_regionkey")
    pages = _pages(spark, sf_dir).join(orders, "page", "left").join(nations, "keyword_id", "left")
    bad = (F.col("o_orderstatus") == "P") & (F.col("n_regionkey") == 0)
    cut = F.when(bad, F.substring("body", F.lit(1), F.length("body") - 3)).otherwise(F.col("body"))
    for part in _thirds(spark, sf_dir, pages.withColumn("body", cut)):
        _land(part, landing)
        ingest_pages(stream_pages(spark, landing), inputs.feed_words(spark), store, checkpoint, _ALL_ROWS)
    rejects = store.read("page_rejects").select(
        F.col("reason").alias("kind"), "keyword_id", "page", F.lit(None).cast("string").alias("external_id")
    )
    return rejects.unionByName(_seen_rows(store))


@query("ingest_paged", f"""{_CANDIDATES}, capped AS (SELECT keyword_id, external_id FROM candidates
        QUALIFY row_number() OVER (PARTITION BY keyword_id ORDER BY page, pos, external_id) <= 1000)
    SELECT 'taken' AS kind, keyword_id, count(*) AS page, CAST(NULL AS VARCHAR) AS external_id FROM capped GROUP BY keyword_id
    UNION ALL SELECT DISTINCT 'seen', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), external_id FROM capped""")
def ingest_paged(spark, sf_dir):
    """The feature is the cap: a thousand candidates per keyword over three batches, with a restart between."""
    store, landing, checkpoint = _new_store(spark), _new_folder(spark, "landing"), _new_folder(spark, "checkpoint")
    for part in _thirds(spark, sf_dir, _pages(spark, sf_dir)):
        _land(part, landing)
        ingest_pages(stream_pages(spark, landing), inputs.feed_words(spark), store, checkpoint)
    taken = progress.cursor_of(store.read("page_cursors")).where("n_rows > 0").select(
        F.lit("taken").alias("kind"), "keyword_id", F.col("n_rows").alias("page"), F.lit(None).cast("string").alias("external_id")
    )
    return taken.unionByName(_seen_rows(store))


@query("counts_by_batch", f"""{with_sql('candidates', 'feed_words')},
    received AS (SELECT keyword_id, count(*) AS received FROM candidates GROUP BY keyword_id),
    arrived AS (SELECT DISTINCT external_id, marked FROM candidates),
    matched AS (SELECT k.id AS keyword_id, count(*) AS matched FROM arrived p JOIN feed_words k ON {HOLDS} GROUP BY k.id),
    counts AS (SELECT keyword_id, coalesce(received, 0) AS received, coalesce(matched, 0) AS matched
               FROM received FULL JOIN matched USING (keyword_id))
    SELECT keyword_id, received, matched, CAST(sum(matched) OVER (ORDER BY keyword_id) AS BIGINT) AS total FROM counts""")
def counts_by_batch(spark, sf_dir):
    """Counts of three batches, the last one replayed, from what each batch added."""
    store, keywords = _new_store(spark), inputs.feed_words(spark)
    parts = [part.select("keyword_id", "page", "body") for part in _thirds(spark, sf_dir, _pages(spark, sf_dir))]
    for epoch, part in [*enumerate(parts), (2, parts[2])]:
        write_pages(part, keywords, store, 0, epoch, _ALL_ROWS)
    return running_sum(progress.totals(store.read("keyword_deltas")), ["keyword_id"], "matched", "total")


_DELETED = f"""{_FIVE}, gone_posts AS (SELECT CAST(doc_id AS VARCHAR) AS external_id FROM documents WHERE lang = 'fr'),
    back AS (SELECT CAST(doc_id AS VARCHAR) AS external_id FROM documents WHERE lang = 'fr' AND source LIKE '%1'),
    gone_keywords AS (SELECT p_partkey AS keyword_id FROM part WHERE p_size < 10),
    kept AS (
        SELECT 'posts' AS table_name, external_id, CAST(NULL AS BIGINT) AS keyword_id FROM post_rows
        WHERE external_id NOT IN (SELECT external_id FROM gone_posts) OR external_id IN (SELECT external_id FROM back)
        UNION ALL SELECT 'post_keywords', external_id, keyword_id FROM post_keywords
        WHERE external_id NOT IN (SELECT external_id FROM gone_posts) AND keyword_id NOT IN (SELECT keyword_id FROM gone_keywords)
        UNION ALL SELECT 'keywords', CAST(NULL AS VARCHAR), id FROM keywords
        WHERE id NOT IN (SELECT keyword_id FROM gone_keywords))
    SELECT kept.*, phase FROM kept, (VALUES ('before'), ('compacted'), ('catalog')) phases(phase)"""


@query("store_delete", _DELETED)
def store_delete(spark, sf_dir):
    """French posts and small keywords go with their links, once more as a replay; some posts come again.
    Read before and after compaction, and through the catalog."""
    store = _filled_store(spark, sf_dir)
    documents = table(spark, sf_dir, "documents").where("lang = 'fr'")
    ids = documents.select(F.col("doc_id").cast("string").alias("external_id"))
    keywords = table(spark, sf_dir, "part").where("p_size < 10").select(F.col("p_partkey").alias("id"))
    store.delete(0, 1, ids, keywords)
    again = documents.where("source LIKE '%1'").select(
        F.col("doc_id").cast("string").alias("external_id"), F.col("text").alias("content")
    )
    for field in store.read("posts").schema:
        if field.name not in again.columns:
            again = again.withColumn(field.name, F.lit(None).cast(field.dataType))
    store.upsert_posts(again, 0, 2)
    store.delete(0, 1, ids, keywords)

    def content(read, phase):
        null_id, null_keyword = F.lit(None).cast("string"), F.lit(None).cast("long")
        parts = [
            read("posts").select(F.lit("posts").alias("table_name"), "external_id", null_keyword.alias("keyword_id")),
            read("post_keywords").select(F.lit("post_keywords").alias("table_name"), "external_id", "keyword_id"),
            read("keywords").select(F.lit("keywords").alias("table_name"), null_id.alias("external_id"), F.col("id").alias("keyword_id")),
        ]
        return inputs.union(*parts).withColumn("phase", F.lit(phase))

    path = _new_folder(spark, "before")
    content(store.read, "before").write.parquet(path)  # what was read before the compaction
    database = f"monitor_{path.rsplit('-', 1)[-1]}"
    store.register(database)
    catalog = content(lambda name: spark.table(f"{database}.{name}"), "catalog")
    for name in BATCH_TABLES:
        store.compact(name)
    return inputs.union(spark.read.parquet(path), content(store.read, "compacted"), catalog)
