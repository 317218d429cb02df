"""Queries of sources, sinks, constraints, inspection and ingestion."""

import uuid

from pyspark.sql import functions as F

from postsieve import schemas
from postsieve.operators import integrity, reports, upsert
from postsieve.plans.check import check_batch
from postsieve.sinks.csv_posts import append_unseen_csv
from postsieve.sinks.store import BATCH_TABLES, Store
from postsieve.session import work_folder
from postsieve.sources import files
from postsieve.sources.feeds import stream_candidates
from postsieve.streaming.ingest import ingest_posts
from workload import inputs
from workload.inputs import HOLDS, WITH_MARKS, table, with_sql
from workload.registry import query


def _new_folder(spark, name):
    return f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("csv_by_header", """SELECT CAST(event_id AS VARCHAR) AS external_id, coalesce(props, '') AS content,
    CAST(ts AS TIMESTAMP) AS created_at, CAST(user_id AS INTEGER) AS like_count, event_type AS category FROM events""")
def csv_by_header(spark, sf_dir):
    """A file with its columns in another order, one too many, and zoned times."""
    folder = _new_folder(spark, "header_csv")
    table(spark, sf_dir, "events").select(
        F.col("event_type").alias("category"),
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("created_at"),
        F.col("user_id").alias("like_count"),
        F.col("props").alias("content"),
        F.col("event_id").alias("external_id"),
    ).write.options(**files.CSV_OPTIONS).csv(folder)
    rows = files.scan_posts_csv(spark, folder)
    return rows.select("external_id", "content", "created_at", "like_count", "category")


def _as_csv_posts(posts):
    """Posts in the columns of the CSV file; the length stands in for the likes."""
    return posts.select(
        "external_id",
        F.col("text").alias("content"),
        F.lit(None).cast("timestamp_ntz").alias("created_at"),
        F.length("text").alias("like_count"),
        *[F.lit(0).alias(c) for c in schemas.COUNTS[1:]],
        F.lit("[]").alias("labels"),
    )


_CSV_SQL = "external_id, text AS content, CAST(length(text) AS INTEGER) AS like_count, '[]' AS labels"


@query("scan_posts_csv", f"{with_sql('posts')} SELECT {_CSV_SQL} FROM posts")
def scan_posts_csv(spark, sf_dir):
    folder = _new_folder(spark, "posts_csv")
    append_unseen_csv(_as_csv_posts(inputs.posts(spark, sf_dir)), folder)
    return files.scan_posts_csv(spark, folder).select("external_id", "content", "like_count", "labels")


@query("append_unseen", f"""{with_sql('posts', 'turns')}
    SELECT {_CSV_SQL} FROM turns UNION ALL
    SELECT {_CSV_SQL} FROM posts WHERE external_id NOT IN (SELECT external_id FROM turns)""")
def append_unseen(spark, sf_dir):
    """The file holds the conversations, repeats included; then the documents come."""
    folder = _new_folder(spark, "append_csv")
    append_unseen_csv(_as_csv_posts(inputs.turns(spark, sf_dir)), folder)
    append_unseen_csv(_as_csv_posts(inputs.posts(spark, sf_dir)), folder)
    return files.scan_posts_csv(spark, folder).select("external_id", "content", "like_count", "labels")


@query("scan_keywords_csv", """SELECT p_type AS query, p_name AS keyword, p_brand AS model, 'en' AS language,
    count(*) AS n FROM part GROUP BY ALL""")
def scan_keywords_csv(spark, sf_dir):
    folder = _new_folder(spark, "keywords_csv")
    table(spark, sf_dir, "part").select(
        F.col("p_type").alias("query"),
        F.col("p_name").alias("keyword"),
        F.lit("en").alias("language"),
        F.col("p_brand").alias("model"),
    ).write.options(**files.CSV_OPTIONS).csv(folder)
    rows = files.scan_keywords_csv(spark, folder)
    return rows.groupBy("query", "keyword", "model", "language").agg(F.count("*").alias("n"))


@query("scan_project", "SELECT doc_id, lang FROM documents")
def scan_project(spark, sf_dir):
    return files.scan_project(spark, f"{sf_dir}/documents.parquet", "doc_id", "lang")


@query("filter_eq", "SELECT doc_id, source FROM documents WHERE lang = 'fr'")
def filter_eq(spark, sf_dir):
    documents = files.scan_project(spark, f"{sf_dir}/documents.parquet", "doc_id", "source", "lang")
    return reports.filter_eq(documents, "lang", "fr").select("doc_id", "source")


@query("head_n", "SELECT doc_id, lang, text FROM documents ORDER BY doc_id LIMIT 5")
def head_n(spark, sf_dir):
    """The feature is the limit: the first five rows for inspection."""
    return reports.head_n(files.scan_project(spark, f"{sf_dir}/documents.parquet", "doc_id", "lang", "text"), ["doc_id"])


_COUNTED = ["documents", "conversations", "part", "lineitem", "events"]


@query("count_rows", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in _COUNTED))
def count_rows(spark, sf_dir):
    return reports.count_rows({t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in _COUNTED})


# events: user_id is the key; these event types are the first batch, all others the second.
_FIRST_BATCH = ["click", "view", "error"]


@query("upsert_posts", """SELECT user_id, event_id, event_type, value, props,
    CAST(coalesce(event_type NOT IN ('click', 'view', 'error'), true) AS INTEGER) AS batch_seq FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY batch_seq DESC, event_id DESC) = 1""")
def upsert_posts(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", "props")
    is_first = F.coalesce(F.col("event_type").isin(_FIRST_BATCH), F.lit(False))
    first = events.filter(is_first).withColumn("batch_seq", F.lit(0))
    second = events.filter(~is_first).withColumn("batch_seq", F.lit(1))
    current = upsert.latest_per_key(first, ["user_id"], ["event_id"])
    return upsert.upsert(current, second, ["user_id"], ["event_id"])


@query("latest_per_key", """SELECT user_id, event_id, event_type, value, props FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def latest_per_key(spark, sf_dir):
    latest = upsert.latest_per_key(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"])
    return latest.select("user_id", "event_id", "event_type", "value", "props")


@query("fk_orphans", """SELECT doc_id, quality, toxic FROM labels WHERE doc_id NOT IN (SELECT conv_id FROM conversations)""")
def fk_orphans(spark, sf_dir):
    labels, conversations = table(spark, sf_dir, "labels"), table(spark, sf_dir, "conversations")
    return integrity.fk_orphans(labels, "doc_id", conversations, "conv_id").select("doc_id", "quality", "toxic")


@query("cascade_delete", """SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
      AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_type = 'SMALL')""")
def cascade_delete(spark, sf_dir):
    """Line items link orders with parts; finished orders and small parts go."""
    links = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey")
    orders = reports.filter_eq(table(spark, sf_dir, "orders"), "o_orderstatus", "F").select(
        F.col("o_orderkey").alias("l_orderkey")
    )
    parts = reports.filter_eq(table(spark, sf_dir, "part"), "p_type", "SMALL").select(
        F.col("p_partkey").alias("l_partkey")
    )
    return integrity.cascade_delete(integrity.cascade_delete(links, orders, "l_orderkey"), parts, "l_partkey")


def _five_tables(spark, sf_dir):
    """categories: supplier names; keywords: part names; posts: documents;
    post_keywords: line items; scanned_posts: labels and conversations."""
    nation = F.col("s_nationkey").cast("long")
    return {
        "categories": table(spark, sf_dir, "supplier").select(
            nation.alias("id"), F.col("s_name").alias("category")
        ),
        "keywords": table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("id"),
            F.col("p_size").cast("long").alias("category_id"),
            F.col("p_name").alias("keyword"),
            F.col("p_brand").alias("language"),
        ),
        "posts": inputs.posts(spark, sf_dir).select("external_id", F.col("text").alias("content")),
        "post_keywords": table(spark, sf_dir, "lineitem").select(
            F.col("l_orderkey").cast("string").alias("external_id"), F.col("l_partkey").alias("keyword_id")
        ),
        "scanned_posts": inputs.seen(spark, sf_dir).unionByName(
            inputs.turns(spark, sf_dir).select("external_id")
        ),
    }


_FIVE = f"""{with_sql('posts', 'turns', 'seen')},
    categories AS (SELECT CAST(s_nationkey AS BIGINT) AS id, s_name AS category FROM supplier),
    keywords AS (SELECT p_partkey AS id, CAST(p_size AS BIGINT) AS category_id, p_name AS keyword, p_brand AS language FROM part),
    post_rows AS (SELECT external_id, text AS content FROM posts),
    post_keywords AS (SELECT CAST(l_orderkey AS VARCHAR) AS external_id, l_partkey AS keyword_id FROM lineitem),
    scanned_posts AS (SELECT external_id FROM seen UNION ALL SELECT external_id FROM turns)"""


def _constraint_parts(source):
    parts = []
    for name, keys in schemas.UNIQUE_KEYS.items():
        for key in keys:
            columns = ", ".join(key)
            parts.append(
                f"SELECT '{name}' AS table_name, 'unique' AS rule, '{','.join(key)}' AS columns, count(*) AS violations "
                f"FROM (SELECT {columns} FROM {source[name]} GROUP BY {columns} HAVING count(*) > 1)"
            )
        for column in schemas.NOT_NULL[name]:
            parts.append(
                f"SELECT '{name}', 'not null', '{column}', count(*) FROM {source[name]} WHERE {column} IS NULL"
            )
    for child, column, parent, parent_column in schemas.FOREIGN_KEYS:
        parts.append(
            f"SELECT '{child}', 'references {parent}', '{column}', count(*) FROM {source[child]} "
            f"WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {parent_column} FROM {source[parent]})"
        )
    return " UNION ALL ".join(parts)


@query("constraint_report", f"{_FIVE} " + _constraint_parts({t: "post_rows" if t == "posts" else t for t in schemas.TABLES}))
def constraint_report(spark, sf_dir):
    return integrity.constraint_report(_five_tables(spark, sf_dir))


def _filled_store(spark, sf_dir):
    """A store that holds the five tables in its first batch."""
    store = Store(spark, _new_folder(spark, "store"))
    store.bootstrap()
    for name, rows in _five_tables(spark, sf_dir).items():
        for field in schemas.TABLES[name]:
            if field.name not in rows.columns:
                rows = rows.withColumn(field.name, F.lit(None).cast(field.dataType))
        store.append(name, rows, 0, 0)
    return store


_SOURCES = {t: "post_rows" if t == "posts" else t for t in schemas.TABLES}


@query("bootstrap", f"{_FIVE} " + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS filled, "
    + (f"count(*)" if t == "scanned_posts" else "CAST(0 AS BIGINT)") + f" AS after_reset FROM {s}"
    for t, s in _SOURCES.items()))
def bootstrap(spark, sf_dir):
    """Fill the tables, reset them, count before and after; seen ids stay."""
    store = _filled_store(spark, sf_dir)
    filled = reports.count_rows({t: store.read(t) for t in schemas.TABLES}).withColumnRenamed("n_rows", "filled")
    filled = spark.createDataFrame(filled.collect(), filled.schema)  # five rows, before the reset
    store.bootstrap(reset=True)
    after = reports.count_rows({t: store.read(t) for t in schemas.TABLES}).withColumnRenamed("n_rows", "after_reset")
    return filled.join(after, "table_name")


@query("list_tables", f"{_FIVE} " + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {s}" for t, s in _SOURCES.items()))
def list_tables(spark, sf_dir):
    """The tables the catalog lists for the schema, with their rows; all posts are replaced once."""
    store = _filled_store(spark, sf_dir)
    again = store.read("posts").withColumn("content", F.lit("replaced"))
    store.upsert_posts(again, 0, 1)
    database = f"monitor_{uuid.uuid4().hex}"
    store.register(database)
    names = [t.name for t in spark.catalog.listTables(database)]
    return reports.count_rows({name: spark.table(f"{database}.{name}") for name in names})


def _landing(rows):
    """Any feed in the columns of a candidate."""
    for field in schemas.CANDIDATES:
        if field.name not in rows.columns:
            rows = rows.withColumn(field.name, F.lit(None).cast(field.dataType))
        rows = rows.withColumn(field.name, F.col(field.name).cast(field.dataType))
    return rows.select(*schemas.CANDIDATES.names)


def _ingest(spark, sf_dir, compacted=False, indexed=False):
    """Two feeds land as files and are ingested one after the other."""
    store = Store(spark, _new_folder(spark, "store"))
    store.bootstrap()
    if indexed:
        store.index_seen()
    keywords = inputs.watched(spark)
    feeds = [inputs.turns(spark, sf_dir), inputs.posts(spark, sf_dir)]
    for feed in feeds:
        folder = _new_folder(spark, "landing")
        _landing(feed).write.parquet(folder)
        stream = stream_candidates(spark, folder)
        ingest_posts(stream, keywords, store, _new_folder(spark, "checkpoint"))
        if compacted:
            for name in BATCH_TABLES:
                store.compact(name)
    return store


_NEW_POSTS = f"""{with_sql('watched', 'posts', 'turns')}, all_keywords AS (SELECT *, {WITH_MARKS} AS marked FROM watched),
    arrived AS MATERIALIZED (SELECT external_id, text, marked FROM turns
                QUALIFY row_number() OVER (PARTITION BY external_id ORDER BY pos) = 1
                UNION ALL SELECT external_id, text, marked FROM posts
                WHERE external_id NOT IN (SELECT external_id FROM turns)),
    pairs AS (SELECT p.external_id, p.text, k.id, k.language FROM arrived p, all_keywords k WHERE {HOLDS})"""


_INGESTED = f"""{_NEW_POSTS} SELECT external_id, lower(text) AS content, arg_min(language, id) AS language,
    0 AS like_count, '[]' AS labels, 'null' AS embed, CAST(count(*) AS BIGINT) AS n_links
    FROM pairs GROUP BY external_id, text"""


def _posts_with_links(store):
    links = store.read("post_keywords").groupBy("external_id").agg(F.count("*").alias("n_links"))
    posts = store.read("posts").select("external_id", "content", "language", "like_count", "labels", "embed")
    return posts.join(links, "external_id")


@query("ingest_posts", _INGESTED)
def ingest(spark, sf_dir):
    return _posts_with_links(_ingest(spark, sf_dir))


@query("ingest_compacted", _INGESTED)
def ingest_compacted(spark, sf_dir):
    """The same with a compaction after each feed."""
    return _posts_with_links(_ingest(spark, sf_dir, compacted=True))


_SEEN = f"{with_sql('posts', 'turns')} SELECT external_id FROM posts UNION SELECT external_id FROM turns"


@query("ingest_seen", _SEEN)
def ingest_seen(spark, sf_dir):
    return _ingest(spark, sf_dir).read("scanned_posts")


@query("ingest_indexed", _SEEN)
def ingest_indexed(spark, sf_dir):
    """The same with an index of the seen ids; both feeds arrive a second time, too."""
    store = _ingest(spark, sf_dir, indexed=True)
    for epoch, feed in enumerate([inputs.posts(spark, sf_dir), inputs.turns(spark, sf_dir)]):
        store.insert_seen(feed, store.newest_run() + 1, epoch)
    return store.read("scanned_posts")


_STATES = "(VALUES ('read'), ('catalog')) phases(phase)"


@query("compact_ranges", f"""{with_sql('posts', 'turns')},
    first AS (SELECT external_id, min_by(text, pos) AS content FROM turns GROUP BY external_id),
    before AS (SELECT external_id, text AS content, lang FROM posts WHERE external_id NOT IN (SELECT external_id FROM first)
               UNION ALL SELECT external_id, content, NULL FROM first),
    kept AS (SELECT * FROM before WHERE external_id NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM labels WHERE toxic = 1)),
    again AS (SELECT external_id, upper(text) AS content, lang FROM posts WHERE lang = 'fr')
    SELECT phase, external_id, content, language FROM (
        SELECT external_id, content, lang AS language FROM kept WHERE external_id NOT IN (SELECT external_id FROM again)
        UNION ALL SELECT external_id, content, lang FROM again), {_STATES}""")
def compact_ranges(spark, sf_dir):
    """Documents, then conversations over them, then deletions, then some documents anew, with
    compactions by range between; read by the store and through the catalog."""
    store = Store(spark, _new_folder(spark, "store"))
    store.bootstrap()

    def write(rows, epoch):
        for field in schemas.POSTS:
            if field.name not in rows.columns:
                rows = rows.withColumn(field.name, F.lit(None).cast(field.dataType))
        store.upsert_posts(rows, 0, epoch)
        store.compact("posts", rows_per_range=500)

    documents = inputs.posts(spark, sf_dir).withColumnRenamed("lang", "language")
    write(documents.withColumnRenamed("text", "content"), 0)
    write(inputs.turns(spark, sf_dir).groupBy("external_id").agg(F.min_by("text", "pos").alias("content")), 1)
    toxic = table(spark, sf_dir, "labels").where("toxic = 1")
    store.delete(0, 2, toxic.select(F.col("doc_id").cast("string").alias("external_id")))
    write(reports.filter_eq(documents, "language", "fr").select("external_id", "language", F.upper("text").alias("content")), 3)
    database = f"ranges_{uuid.uuid4().hex}"
    store.register(database)
    columns = ["external_id", "content", "language"]
    states = {"read": store.read("posts"), "catalog": spark.table(f"{database}.posts")}
    return inputs.union(*[rows.select(F.lit(phase).alias("phase"), *columns) for phase, rows in states.items()])


# The five tables in three batches: documents and line items by their columns, the last batch deletes, too.
_BY_BATCH = f"""{_FIVE},
    docs AS (SELECT CAST(doc_id AS VARCHAR) AS external_id, text AS content, CASE WHEN lang = 'en' THEN 0 ELSE 1 END AS epoch FROM documents),
    lines AS (SELECT CAST(l_orderkey AS VARCHAR) AS external_id, l_partkey AS keyword_id,
              CASE WHEN l_linenumber <= 2 THEN 0 WHEN l_linenumber <= 4 THEN 1 ELSE 2 END AS epoch FROM lineitem),
    scans AS (SELECT external_id, 0 AS epoch FROM seen UNION ALL SELECT external_id, 1 FROM turns),
    toxic AS (SELECT CAST(doc_id AS VARCHAR) AS external_id FROM labels WHERE toxic = 1),
    small AS (SELECT p_partkey AS keyword_id FROM part WHERE p_type = 'SMALL')""" + "".join(f""",
    c{e} AS (SELECT * FROM categories), s{e} AS (SELECT external_id FROM scans WHERE epoch <= {e}),
    k{e} AS (SELECT * FROM keywords {"WHERE id NOT IN (FROM small)" if e == 2 else ""}),
    p{e} AS (SELECT external_id, content FROM docs WHERE epoch <= {e} {"AND external_id NOT IN (FROM toxic)" if e == 2 else ""}),
    l{e} AS (SELECT external_id, keyword_id FROM lines WHERE epoch <= {e}
             {"AND external_id NOT IN (FROM toxic) AND keyword_id NOT IN (FROM small)" if e == 2 else ""})""" for e in range(3))


@query("constraint_delta", f"{_BY_BATCH} " + " UNION ALL ".join(
    f"SELECT {e} AS epoch, * FROM (" + _constraint_parts(dict(zip(schemas.TABLES, [f"c{e}", f"k{e}", f"p{e}", f"l{e}", f"s{e}"]))) + ")"
    for e in range(3)))
def constraint_delta(spark, sf_dir):
    """The violations after each of three batches, each from its own changes alone."""
    store = Store(spark, _new_folder(spark, "store"))
    store.bootstrap()
    tables = _five_tables(spark, sf_dir)
    lang = inputs.posts(spark, sf_dir).select("external_id", F.col("text").alias("content"), F.col("lang").alias("language"))
    english = F.coalesce(F.col("language") == "en", F.lit(False))
    links = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("external_id"), F.col("l_partkey").alias("keyword_id"), "l_linenumber"
    )
    nr = F.col("l_linenumber")
    batches = [
        {"categories": tables["categories"], "keywords": tables["keywords"], "posts": lang.filter(english),
         "post_keywords": links.filter(nr <= 2), "scanned_posts": inputs.seen(spark, sf_dir)},
        {"posts": lang.filter(~english), "post_keywords": links.filter((nr > 2) & (nr <= 4)),
         "scanned_posts": inputs.turns(spark, sf_dir).select("external_id")},
        {"post_keywords": links.filter(~(nr <= 4) | nr.isNull())},
    ]
    for epoch, batch in enumerate(batches):
        for name, rows in batch.items():
            for field in schemas.TABLES[name]:
                if field.name not in rows.columns:
                    rows = rows.withColumn(field.name, F.lit(None).cast(field.dataType))
            store.append(name, rows, 0, epoch)
        if epoch == 2:
            toxic = table(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").cast("string").alias("external_id"))
            small = reports.filter_eq(table(spark, sf_dir, "part"), "p_type", "SMALL").select(F.col("p_partkey").alias("id"))
            store.delete(0, epoch, toxic, small)
        check_batch(store, 0, epoch)
        for name in ["posts", "post_keywords", "scanned_posts"]:
            store.compact(name, rows_per_range=20_000)
    upto = spark.createDataFrame([(e,) for e in range(3)], "state int")
    deltas = store.versions("constraint_deltas").join(F.broadcast(upto), F.col("epoch") <= F.col("state"))
    sums = deltas.groupBy(F.col("state").alias("epoch"), "table_name", "rule", "columns")
    return sums.agg(F.sum("violations").alias("violations"))
