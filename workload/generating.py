"""Queries of keyword generation."""

import uuid

from pyspark.sql import functions as F

from postsieve.operators import keywords as kw
from postsieve.plans.generate import store_generated
from postsieve.session import work_folder
from postsieve.sinks.store import Store
from workload import inputs
from workload.inputs import COMPLETIONS_SQL, LEMMAS_SQL, TOPICS_SQL, VOCABULARY_SQL, table, with_sql
from workload.registry import query


@query("numbered_list", f"""WITH {TOPICS_SQL}
    SELECT model, CAST(pos // 20 AS BIGINT) AS prompt_no,
           string_agg((pos + 1) || '. ' || query, chr(10) ORDER BY pos) AS listing
    FROM queries GROUP BY model, pos // 20""")
def numbered_list(spark, sf_dir):
    return kw.numbered_list(inputs.topic_queries(spark, sf_dir), per_prompt=20)


@query("parse_topics", f"""WITH {TOPICS_SQL},
    said AS (SELECT model, no, list, CASE WHEN no IN (4, 14) THEN list[:len(list) - 1] ELSE list END AS used FROM lines)
    SELECT model, CASE WHEN no IN (6, 16) THEN NULL
        ELSE [regexp_extract(q, '^[^ \\t\\n\\r\\f\\v]*') FOR q IN used] END AS topics FROM said""")
def parse_topics(spark, sf_dir):
    return kw.parse_topics(inputs.topic_answers(spark, sf_dir))


@query("topic_fallback", f"""WITH {TOPICS_SQL} SELECT model, CAST(pos AS INTEGER) AS pos, query, topic
    FROM topics WHERE topic != ''""")
def topic_fallback(spark, sf_dir):
    return kw.topic_fallback(inputs.topic_queries(spark, sf_dir), inputs.topic_answers(spark, sf_dir))


@query("topics_by_prompt", f"""WITH {TOPICS_SQL.replace("topics AS (", "one_answer AS (")}, sizes AS (
    SELECT model, pos // 7 AS prompt_no, count(*) AS n FROM queries GROUP BY ALL)
    SELECT q.model, CAST(q.pos AS INTEGER) AS pos, q.query,
        CASE WHEN (q.pos // 7 + q.no) % 3 = 0 THEN lower(q.query)
             ELSE regexp_extract(q.query, '^[^ \t\n\r\f\v]*') END AS topic
    FROM queries q JOIN sizes s ON s.model = q.model AND s.prompt_no = q.pos // 7 WHERE topic != ''""")
def topics_by_prompt(spark, sf_dir):
    """Seven queries to a prompt; every third answer lacks its last topic."""
    queries = inputs.topic_queries(spark, sf_dir)
    numbers = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("model"),
        F.regexp_extract("source", "[0-9]+", 0).cast("int").alias("no"),
        F.split("text", "\n").alias("list"),
    )
    prompts = numbers.select(
        "model", "no", "list", F.explode(F.sequence(F.lit(0), F.floor((F.size("list") - 1) / 7).cast("int"))).alias("prompt_no")
    )
    part = F.slice("list", F.col("prompt_no") * 7 + 1, F.lit(7))
    said = F.transform(part, lambda q: F.regexp_extract(q, r"^[^ \t\n\r\f\x0b]*", 0))
    short = (F.col("prompt_no") + F.col("no")) % 3 == 0
    used = F.when(short, F.slice(said, 1, F.size(said) - 1)).otherwise(said)
    answers = prompts.select(
        "model", F.col("prompt_no").cast("long").alias("prompt_no"), F.to_json(F.struct(used.alias("topics"))).alias("content")
    )
    return kw.topic_fallback(queries, answers, per_prompt=7).select("model", "pos", "query", "topic")


@query("prompt_table", f"""WITH {TOPICS_SQL} SELECT model, CAST(pos AS INTEGER) AS pos,
    '50 keywords for: ' || topic AS prompt
    FROM topics WHERE topic != ''""")
def prompt_table(spark, sf_dir):
    topics = kw.topic_fallback(inputs.topic_queries(spark, sf_dir), inputs.topic_answers(spark, sf_dir))
    return kw.prompt_table(topics, 50, "%d keywords for: %s").select("model", "pos", "prompt")


@query("parse_completions", f"""WITH {COMPLETIONS_SQL}
    SELECT r.model_seq, r.model, r.query, r.topic,
           coalesce((SELECT list(c.keyword || '/' || c.language ORDER BY c.pos) FROM cleaned c
                     WHERE c.topic = r.topic), []) AS keywords
    FROM results r""")
def parse_completions(spark, sf_dir):
    results = kw.generation_results(inputs.completions(spark, sf_dir))
    return results.withColumn(
        "keywords", F.transform("keywords", lambda k: F.concat(k["keyword"], F.lit("/"), k["language"]))
    )


@query("clean_keywords", f"""WITH {COMPLETIONS_SQL}
    SELECT model_seq, model, query, topic, CAST(pos AS INTEGER) AS pos, keyword, language FROM cleaned""")
def clean_keywords(spark, sf_dir):
    return kw.clean_keywords(inputs.completions(spark, sf_dir))


@query("rejects_report", f"""WITH {COMPLETIONS_SQL}
    SELECT model, query, upper(query) AS title, left(body, 100) AS excerpt
    FROM completions WHERE NOT json_valid(body)""")
def rejects_report(spark, sf_dir):
    return kw.rejects_report(inputs.completions(spark, sf_dir))


@query("keyword_shortage", f"""WITH {COMPLETIONS_SQL}, counted AS (
    SELECT r.model_seq, r.model, r.query, r.topic,
           (SELECT count(*) FROM cleaned c WHERE c.topic = r.topic) AS accepted FROM results r)
    SELECT *, 10 - accepted AS missing FROM counted WHERE accepted < 10""")
def keyword_shortage(spark, sf_dir):
    return kw.keyword_shortage(inputs.completions(spark, sf_dir), 10)


# Categories: the languages of the documents.  Two are stored already.
_STORED_CATEGORIES = [(1, "fr"), (2, "travel")]


def _categories(spark, sf_dir):
    stored = spark.createDataFrame(_STORED_CATEGORIES, "id long, category string")
    wanted = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("input_seq"), F.col("lang").alias("category")
    )
    return kw.category_get_or_create(stored, wanted)


_CATEGORIES = """
categories AS (
    SELECT 1 AS id, 'fr' AS category UNION ALL SELECT 2, 'travel' UNION ALL
    SELECT 2 + row_number() OVER (ORDER BY min(doc_id)), lang FROM documents WHERE lang != 'fr' GROUP BY lang)"""
_STORED = """
stored AS (
    SELECT unnest(range(1, 6)) AS category_id, keyword
    FROM (SELECT DISTINCT unnest(string_split(text, chr(10))) AS keyword FROM benchmark))"""
_NEW = f"""WITH {COMPLETIONS_SQL}, {_CATEGORIES}, {_STORED}, named AS (
    SELECT id AS category_id, trim(lower(keyword)) AS keyword, language, min(model_seq) AS model_seq
    FROM cleaned JOIN categories ON query = category WHERE length(keyword) >= 3 GROUP BY ALL),
    built AS (SELECT * FROM named n
    WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.category_id = n.category_id AND trim(lower(s.keyword)) = n.keyword)
    QUALIFY rank() OVER (PARTITION BY category_id, keyword ORDER BY model_seq) = 1)"""


# part: the keywords that are stored before, in the first category.
_STORED_ROWS = """
stored AS (
    SELECT p_partkey AS id, CAST(1 AS BIGINT) AS category_id, p_name AS keyword, p_brand AS language FROM part)"""


def _stored_keywords(spark, sf_dir):
    """benchmark: every line is stored already, in every category."""
    return (
        spark.read.parquet(f"{sf_dir}/benchmark.parquet")
        .select(F.explode(F.split("text", "\n")).alias("keyword"))
        .select("keyword", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("category_id"))
    )


def _build(spark, sf_dir):
    categories = _categories(spark, sf_dir)
    cleaned = kw.clean_keywords(inputs.completions(spark, sf_dir))
    return kw.keyword_build(cleaned, categories, _stored_keywords(spark, sf_dir))


@query("keyword_build", f"{_NEW} SELECT category_id, keyword, language, model_seq FROM built")
def keyword_build(spark, sf_dir):
    return _build(spark, sf_dir)


@query("keyword_insert", f"""{_NEW} SELECT 500 + row_number() OVER (
    ORDER BY model_seq, category_id, keyword, language) AS id, category_id, keyword, language FROM built""")
def keyword_insert(spark, sf_dir):
    """The accepted batch with the ids it is stored under."""
    stored = spark.createDataFrame([(500,)], "id long")
    return kw.number_keywords(_build(spark, sf_dir), stored)


@query("generate_and_store", f"""{_NEW.replace(_STORED.strip(), _STORED_ROWS.strip())}
    SELECT c.category, k.keyword, k.language, k.id FROM (
        SELECT id, category_id, keyword, language FROM stored UNION ALL
        SELECT (SELECT max(id) FROM stored) + row_number() OVER (ORDER BY model_seq, category_id, keyword, language),
            category_id, keyword, language FROM built) k JOIN categories c ON c.id = k.category_id""")
def generate_and_store(spark, sf_dir):
    """Categories and keywords of a store before and after a batch, which is done twice."""
    store = Store(spark, f"{work_folder(spark)}/generated-{uuid.uuid4().hex}")
    store.bootstrap()
    store.append("categories", spark.createDataFrame(_STORED_CATEGORIES, "id long, category string"), 0, 0)
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.lit(1).cast("long").alias("category_id"),
        F.col("p_name").alias("keyword"), F.col("p_brand").alias("language"),
    )
    store.append("keywords", parts, 0, 0)
    wanted = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("input_seq"), F.col("lang").alias("category"))
    for _ in range(2):
        store_generated(inputs.completions(spark, sf_dir), wanted, store, 0, 1)
    categories = store.read("categories").withColumnRenamed("id", "category_id")
    return store.read("keywords").join(F.broadcast(categories), "category_id").select("category", "keyword", "language", "id")


@query("category_get_or_create", """
    WITH wanted AS (SELECT s_suppkey AS input_seq, s_name AS category FROM supplier UNION ALL
                    SELECT c_custkey, c_mktsegment FROM customer),
    stored AS (SELECT CAST(p_partkey AS BIGINT) AS id, 'Supplier#' || lpad(CAST(p_partkey * 3 AS VARCHAR), 9, '0') AS category FROM part)
    SELECT id, category FROM stored UNION ALL
    SELECT (SELECT max(id) FROM stored) + row_number() OVER (ORDER BY min(input_seq), category), category
    FROM wanted WHERE category NOT IN (SELECT category FROM stored) GROUP BY category""")
def category_get_or_create(spark, sf_dir):
    wanted = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("input_seq"), F.col("s_name").alias("category")
    ).unionByName(
        table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("input_seq"), F.col("c_mktsegment").alias("category")
        )
    )
    stored = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.concat(F.lit("Supplier#"), F.lpad((F.col("p_partkey") * 3).cast("string"), 9, "0")).alias("category"),
    )
    return kw.category_get_or_create(stored, wanted)


@query("category_lookup", f"""{with_sql('watched')}, categories AS (SELECT DISTINCT id, p FROM (
        SELECT p_partkey AS id, p_name AS p FROM part))
    SELECT l_orderkey, l_linenumber, p AS query, id AS category_id FROM (
        SELECT l_orderkey, l_linenumber, p_name AS name, p_partkey FROM lineitem JOIN part ON l_partkey = p_partkey) x
    JOIN (SELECT min(id) AS id, p FROM categories GROUP BY p) c ON c.p = x.name""")
def category_lookup(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    rows = table(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", F.col("p_name").alias("query")
    )
    categories = part.groupBy(F.col("p_name").alias("category")).agg(F.min("p_partkey").alias("id"))
    return kw.category_lookup(rows, categories).select("l_orderkey", "l_linenumber", "query", "category_id")


@query("pluralize", f"""WITH {VOCABULARY_SQL} SELECT keyword, language,
    CASE WHEN language = 'en' AND regexp_matches(keyword, '(s|x|z|ch|sh)$') THEN keyword || 'es'
         WHEN language = 'en' THEN keyword || 's'
         WHEN language = 'fr' AND NOT regexp_matches(keyword, '[sxz]$') THEN keyword || 's'
         ELSE keyword END AS plural FROM vocabulary""")
def pluralize(spark, sf_dir):
    return kw.pluralize(inputs.vocabulary(spark, sf_dir))


def _line_keywords(spark, sf_dir):
    return (
        table(spark, sf_dir, "documents")
        .select(F.explode(F.split(F.lower("text"), "\n")).alias("keyword"), F.col("lang").alias("language"))
        .distinct()
    )


_LEMMA = r"""CASE WHEN k.language NOT IN ('en', 'fr') OR regexp_extract(k.keyword, '^\s*([^ \t\n\r\f\v]+)', 1) = ''
    THEN k.keyword ELSE coalesce(d.lemma, regexp_extract(k.keyword, '^\s*([^ \t\n\r\f\v]+)', 1)) END"""
_LINE_LEMMAS = rf"""WITH {VOCABULARY_SQL}, {LEMMAS_SQL}, line_keywords AS (
    SELECT DISTINCT unnest(string_split(lower(text), chr(10))) AS keyword, lang AS language FROM documents)"""


@query("lemmatize_dict", rf"""{_LINE_LEMMAS} SELECT k.keyword, k.language, {_LEMMA} AS lemma
    FROM line_keywords k LEFT JOIN lemmas d
    ON d.token = regexp_extract(k.keyword, '^\s*([^ \t\n\r\f\v]+)', 1) AND d.language = k.language""")
def lemmatize_dict(spark, sf_dir):
    return kw.lemmatize(_line_keywords(spark, sf_dir), inputs.lemmas(spark, sf_dir))


@query("expand_variants", rf"""WITH {VOCABULARY_SQL}, {LEMMAS_SQL},
    forms AS (SELECT k.keyword, k.language,
        CASE WHEN k.language = 'en' AND regexp_matches(k.keyword, '(s|x|z|ch|sh)$') THEN k.keyword || 'es'
             WHEN k.language = 'en' OR (k.language = 'fr' AND NOT regexp_matches(k.keyword, '[sxz]$')) THEN k.keyword || 's'
             ELSE k.keyword END AS plural, {_LEMMA} AS lemma
    FROM vocabulary k LEFT JOIN lemmas d ON d.token = k.keyword AND d.language = k.language)
    SELECT keyword AS surface, language, 0 AS variant_seq, keyword FROM forms UNION ALL
    SELECT keyword, language, 1, plural FROM forms WHERE plural != keyword UNION ALL
    SELECT keyword, language, CASE WHEN plural = keyword THEN 1 ELSE 2 END, lemma
    FROM forms WHERE lemma != keyword AND lemma != plural""")
def expand_variants(spark, sf_dir):
    words = inputs.vocabulary(spark, sf_dir).withColumn("surface", F.col("keyword"))
    return kw.expand_variants(words, inputs.lemmas(spark, sf_dir)).select(
        "surface", "language", "variant_seq", "keyword"
    )
