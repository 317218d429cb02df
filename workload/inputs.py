"""The given tables in the roles of this project, once for Spark and once as SQL.

Every role covers its whole table.
"""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postsieve.operators.sizing import spread

# The watched keywords: id, category, keyword, language.
WATCHED = [
    (1, "art", "that", "en"),
    (2, "art", "ther", "en"),
    (3, "art", "The And", "en"),
    (4, "art", "attion to", "en"),
    (5, "law", "thanedble the", "en"),
    (6, "law", "eriner thanea", "en"),
    (7, "law", "über", "de"),
    (8, "law", "für", "de"),
    (9, "food", "nicht", "de"),
    (10, "food", "der der", "de"),
    (11, "food", "éeau", "fr"),
    (12, "food", "ÉLE", "fr"),
    (13, "travel", "avec", "fr"),
    (14, "travel", "la des", "fr"),
    (15, "travel", "dans", "fr"),
    (16, "travel", "ción", "es"),
    (17, "music", "ciónas", "es"),
    (18, "music", "de los", "es"),
    (19, "music", "that", "fr"),
    (20, "music", "missing word", "en"),
    (21, "space", "@", "en"),
    (22, "space", "é", "fr"),
]

# The words searched for by the candidate feed: id, keyword, language.
FEED_WORDS = [
    (0, "red", "en"),
    (1, "large", "en"),
    (2, "blue", "en"),
    (3, "new", "en"),
    (4, "cold", "en"),
    (5, "small", "en"),
    (6, "hot", "en"),
    (7, "old", "en"),
    (8, "ring", "en"),
    (9, "bolt", "en"),
    (10, "plate", "en"),
    (11, "rod", "en"),
    (12, "gear", "en"),
    (13, "gizmo", "en"),
    (14, "widget", "en"),
    (15, "anvil", "en"),
    (16, "red bolt", "en"),
    (17, "new anvil", "en"),
    (18, "hot ring", "en"),
    (19, "red rod", "en"),
    (20, "hot plate", "en"),
    (21, "rin", "en"),
    (22, "ed", "en"),
    (23, "plate", "fr"),
    (24, "old gear", "en"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    # Texts are worth spreading; for plain columns the shuffle costs more than it gains.
    return spread(rows) if "text" in rows.columns else rows


def union(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def sql_values(rows: list[tuple]) -> str:
    return ", ".join(
        "(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows
    )


def marked(text: str) -> str:
    """SQL: the lower-cased text with a mark on both sides of every word."""
    return rf"regexp_replace(lower({text}), '([\p{{L}}\p{{N}}_]+)', chr(1) || '\1' || chr(1), 'g')"


# A keyword is there as a whole word if the marked text contains it marked, with
# a mark at either end.
WITH_MARKS = f"""CASE WHEN starts_with({marked('keyword')}, chr(1)) THEN '' ELSE chr(1) END || {marked('keyword')}
    || CASE WHEN ends_with({marked('keyword')}, chr(1)) THEN '' ELSE chr(1) END"""
HOLDS = "contains(p.marked, k.marked)"

CTES = {
    "watched": f"""listed(id, category, keyword, language) AS (VALUES {sql_values(WATCHED)}),
        watched AS (SELECT CAST(id AS BIGINT) AS id, category, keyword, language FROM listed)""",
    "feed_words": f"""words(id, keyword, language) AS (VALUES {sql_values(FEED_WORDS)}),
        feed_words AS (SELECT CAST(id AS BIGINT) AS id, keyword, language, {WITH_MARKS} AS marked FROM words)""",
    "posts": f"""posts AS MATERIALIZED (SELECT CAST(doc_id AS VARCHAR) AS external_id, text, lang, source,
        {marked('text')} AS marked FROM documents)""",
    "turns": f"""turns AS MATERIALIZED (SELECT CAST(conv_id AS VARCHAR) AS external_id, turn AS pos, text,
               {marked('text')} AS marked
                    FROM conversations)""",
    "candidates": f"""candidates AS (
            SELECT CAST(s_nationkey AS BIGINT) AS keyword_id, CAST(s_nationkey AS BIGINT) AS kw_seq,
                   l_orderkey AS page, CAST(l_linenumber AS BIGINT) AS pos,
                   CAST(l_partkey AS VARCHAR) AS external_id, {marked('p_name')} AS marked
            FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey)""",
    "phrases": """phrases AS (
        SELECT min(1000 + item_id * 1000 + pos) AS id, 'benchmark' AS category, phrase AS keyword, 'en' AS language
        FROM (SELECT item_id, trim(s) AS phrase, pos
              FROM (SELECT item_id, unnest(list) AS s, unnest(range(len(list))) AS pos
                    FROM (SELECT item_id, string_split(text, '.') AS list FROM benchmark)))
        WHERE phrase != '' GROUP BY phrase)""",
    "seen": "seen AS (SELECT CAST(doc_id AS VARCHAR) AS external_id FROM labels)",
}


def with_sql(*names: str) -> str:
    """The WITH clause that defines the given roles."""
    return "WITH " + ", ".join(CTES[n] for n in names)


def watched(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(WATCHED, "id long, category string, keyword string, language string")


def feed_words(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FEED_WORDS, "id long, keyword string, language string")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents: one post per document."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("external_id"), "text", "lang", "source"
    )


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations: a second feed, where one id arrives turn after turn."""
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("external_id"), F.col("turn").alias("pos"), "text"
    )


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem: part names delivered for the keyword of the supplier's nation, one
    page per order; the same part arrives many times and for many keywords."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", "s_nationkey")
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name")
    joined = lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).join(
        parts, F.col("l_partkey") == F.col("p_partkey")
    )
    return joined.select(
        F.col("s_nationkey").cast("long").alias("keyword_id"),
        F.col("s_nationkey").cast("long").alias("kw_seq"),
        F.col("l_orderkey").alias("page"),
        F.col("l_linenumber").cast("long").alias("pos"),
        F.col("l_partkey").cast("string").alias("external_id"),
        F.col("p_name").alias("text"),
    )


def seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet").select(
        F.col("doc_id").cast("string").alias("external_id")
    )


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """benchmark: every sentence as a long keyword."""
    sentences = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select(
        "item_id", F.posexplode(F.split("text", r"\.")).alias("pos", "sentence")
    )
    return (
        sentences.groupBy(F.trim("sentence").alias("keyword"))
        .agg(F.min(F.lit(1000) + F.col("item_id") * 1000 + F.col("pos")).alias("id"))
        .filter("keyword != ''")
        .select("id", F.lit("benchmark").alias("category"), "keyword", F.lit("en").alias("language"))
    )


# Raw model answers from documents: one answer per document, the lines as keyword
# items.  The number of the source decides on the form of the answer.
def _source_no():
    return F.regexp_extract("source", r"\d+", 0).cast("int")


def completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    no = _source_no()
    item = F.struct
    lines = F.split("text", "\n")
    items = F.to_json(
        F.transform(
            lines, lambda x: item(x.alias("keyword"), F.concat(F.lit(" "), F.upper("lang")).alias("language"))
        )
    )
    single = F.to_json(item(F.col("text").alias("keyword"), F.col("lang").alias("language")))
    content = (
        F.when(no.isin(3, 13), F.concat(F.lit("```json\n"), items, F.lit("\n```")))
        .when(no.isin(5, 15), F.concat(F.lit("Sure:\n```\n"), items, F.lit("\n``` done")))
        .when(no.isin(7, 17), F.concat(items, F.lit(",")))
        .when(no.isin(9), single)
        .when(no.isin(11), F.concat(F.substring(items, F.lit(1), F.length(items) - 1), F.lit(', 5, "x", {"language": "en"}]')))
        .otherwise(items)
    )
    return table(spark, sf_dir, "documents").select(
        no.alias("model_seq"),
        F.col("source").alias("model"),
        F.col("lang").alias("query"),
        F.col("doc_id").cast("string").alias("topic"),
        content.alias("content"),
    )


COMPLETIONS_SQL = r"""
docs AS (
    SELECT CAST(regexp_extract(source, '[0-9]+') AS INTEGER) AS no, source, lang, doc_id, text,
           CAST(to_json([{'keyword': x, 'language': ' ' || upper(lang)}
                         FOR x IN string_split(text, chr(10))]) AS VARCHAR) AS items,
           CAST(to_json({'keyword': text, 'language': lang}) AS VARCHAR) AS single
    FROM documents),
completions AS (
    SELECT no AS model_seq, source AS model, lang AS query, CAST(doc_id AS VARCHAR) AS topic,
           CASE WHEN no IN (7, 17) THEN items || ','
                WHEN no = 9 THEN single
                WHEN no = 11 THEN left(items, length(items) - 1) || ', 5, "x", {"language": "en"}]'
                ELSE items END AS body
    FROM docs),
results AS (SELECT * FROM completions WHERE json_valid(body)),
raw_items AS (
    SELECT model_seq, model, query, topic, unnest(list) AS item, unnest(range(len(list))) AS nr
    FROM (SELECT *, CASE WHEN json_type(CAST(body AS JSON)) = 'ARRAY'
                         THEN from_json(body, '["JSON"]') ELSE [] END AS list FROM results)),
pairs AS (
    SELECT model_seq, model, query, topic, nr,
           trim(regexp_replace(translate(lower(json_extract_string(item, '$.keyword')), '_-', '  '),
                               '[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g')) AS keyword,
           lower(trim(json_extract_string(item, '$.language'))) AS language
    FROM raw_items WHERE json_type(item) = 'OBJECT'),
kept AS (
    SELECT model_seq, model, query, topic, keyword, language, min(nr) AS nr
    FROM pairs WHERE keyword != '' AND language IN ('fr', 'en') GROUP BY ALL),
cleaned AS (
    SELECT model_seq, model, query, topic, keyword, language,
           row_number() OVER (PARTITION BY topic ORDER BY nr) - 1 AS pos
    FROM kept)
"""


def topic_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents: each line is a query, the document stands for the model asked."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("model"),
        F.posexplode(F.split("text", "\n")).alias("pos", "query"),
    )


def topic_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One answer per document: the first word of each line; some sources give one
    topic too few or no JSON."""
    no = _source_no()
    topics = F.transform(F.split("text", "\n"), lambda x: F.regexp_extract(x, r"^\S*", 0))
    listed = F.when(no.isin(4, 14), F.slice(topics, F.lit(1), F.size(topics) - 1)).otherwise(topics)
    answer = F.to_json(F.struct(listed.alias("topics")))
    content = (
        F.when(no.isin(6, 16), F.concat(F.lit("topics: "), answer))
        .when(no.isin(8, 18), F.concat(F.lit("```json\n"), answer, F.lit("\n```")))
        .otherwise(answer)
    )
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("model"), content.alias("content")
    )


TOPICS_SQL = r"""
lines AS (
    SELECT CAST(doc_id AS VARCHAR) AS model, CAST(regexp_extract(source, '[0-9]+') AS INTEGER) AS no,
           string_split(text, chr(10)) AS list FROM documents),
queries AS (
    SELECT model, no, unnest(list) AS query, unnest(range(len(list))) AS pos FROM lines),
topics AS (
    SELECT model, pos,
           CASE WHEN no IN (4, 14, 6, 16) THEN lower(query)
                ELSE regexp_extract(query, '^[^ \t\n\r\f\v]*') END AS topic, query
    FROM queries)
"""


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents: the distinct (word, language) pairs of all texts."""
    from postsieve.functions.text import fold, words

    tokens = table(spark, sf_dir, "documents").select(
        F.explode(F.array_distinct(words(fold(F.col("text"))))).alias("keyword"),
        F.col("lang").alias("language"),
    )
    return tokens.filter("keyword != ''").distinct()


VOCABULARY_SQL = r"""
vocabulary AS (
    SELECT DISTINCT keyword, language FROM (
        SELECT unnest(string_split_regex(lower(text), '[^\p{L}\p{N}_]+')) AS keyword, lang AS language
        FROM documents)
    WHERE keyword != '')
"""


def lemmas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary from the texts: a word that is another word plus ``s`` has that
    other word as its lemma."""
    known = vocabulary(spark, sf_dir)
    base = known.select(F.concat("keyword", F.lit("s")).alias("token"), "language", F.col("keyword").alias("lemma"))
    return base.join(known.withColumnRenamed("keyword", "token"), ["token", "language"], "left_semi")


LEMMAS_SQL = """
lemmas AS (
    SELECT b.keyword || 's' AS token, b.language, b.keyword AS lemma
    FROM vocabulary b JOIN vocabulary v ON v.keyword = b.keyword || 's' AND v.language = b.language)
"""
