"""From raw model answers to the keyword table."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postsieve.functions.completions import (
    clean_items,
    keyword_body,
    parse_json,
    topic_body,
    topic_list,
)
from postsieve.functions.text import bind, plural, strip
from postsieve.operators.numbering import dense_ids
from postsieve.operators.sizing import fits_broadcast

MIN_KEYWORD_LENGTH = 3

def numbered_list(queries: DataFrame, per_prompt: int = 500) -> DataFrame:
    """The queries of each model as one numbered text per prompt.

    ``queries`` holds ``model, pos, query`` with ``pos`` counting from 0.  A prompt
    takes ``per_prompt`` queries, so no list outgrows a task; numbers go on in the
    next prompt.
    """
    entry = F.struct("pos", "query")
    lines = F.transform(
        F.array_sort(F.collect_list(entry)),
        lambda e: F.concat((e["pos"] + 1).cast("string"), F.lit(". "), e["query"]),
    )
    return (
        queries.groupBy("model", F.floor(F.col("pos") / per_prompt).cast("long").alias("prompt_no"))
        .agg(F.array_join(lines, "\n").alias("listing"))
    )


def prompt_table(topics: DataFrame, n_keywords: int, template: str) -> DataFrame:
    """One prompt per (model, query), for the batch that asks the models.

    ``template`` takes the number and the topic, as ``%d`` and ``%s``.
    """
    return topics.withColumn("prompt", F.format_string(template, F.lit(n_keywords), F.col("topic")))


def parse_topics(answers: DataFrame) -> DataFrame:
    """Replaces ``content`` by ``topics``; NULL where the answer is unusable."""
    topics = F.struct(topic_list(parse_json(topic_body(F.col("content")))).alias("topics"))
    rest = [c for c in answers.columns if c != "content"]
    # Behind the generator, so that filters on the topics do not parse again.
    return answers.select(*rest, F.inline(F.array(topics)))


def topic_fallback(queries: DataFrame, answers: DataFrame, per_prompt: int | None = None) -> DataFrame:
    """Pair each query with its topic.

    With ``per_prompt``, as given to ``numbered_list``, an answer belongs to one
    prompt and ``answers`` has its ``prompt_no``; else a model has one list and one answer.
    The topics of an answer count only if there are as many as queries in its
    prompt; of several such answers to a prompt the least list counts.  Where none
    does, every query of that prompt stands for itself, lower-cased.  Pairs with an
    empty topic are skipped.  The joins are on (model, position), so one model with a
    great many queries spreads over all tasks.
    """
    prompt = F.floor(F.col("pos") / per_prompt).cast("long") if per_prompt else F.lit(0).cast("long")
    counts = queries.groupBy("model", prompt.alias("prompt_no")).agg(F.count("*").alias("_n"))
    parsed = parse_topics(answers)
    if per_prompt is None:
        parsed = parsed.withColumn("prompt_no", F.lit(0).cast("long"))
    usable = (
        parsed.join(counts, ["model", "prompt_no"])
        .filter(F.size("topics") == F.col("_n"))
        .groupBy("model", "prompt_no")
        .agg(F.min("topics").alias("topics"))
    )
    topics = usable.select("model", "prompt_no", F.posexplode("topics").alias("_at", "_topic")).select(
        "model",
        (F.col("_at") + F.col("prompt_no") * F.lit(per_prompt or 0)).alias("pos"),
        "_topic",
        F.lit(True).alias("_usable"),
    )
    paired = queries.join(topics, ["model", "pos"], "left").withColumn(
        "topic", F.when(F.col("_usable"), F.col("_topic")).otherwise(F.lower("query"))
    )
    return paired.filter("topic != ''").drop("_topic", "_usable")


def parse_completions(completions: DataFrame) -> DataFrame:
    """Add ``body`` (the JSON text), ``is_valid`` and the clean ``keywords``.

    Each answer is unwrapped and parsed once: filters on the result stay above the
    generator and cannot repeat the work.
    """
    answer = bind(
        keyword_body(F.col("content")),
        lambda body: bind(
            parse_json(body),
            lambda parsed: F.struct(
                body.alias("body"),
                parsed.isNotNull().alias("is_valid"),
                clean_items(parsed).alias("keywords"),
            ),
        ),
    )
    return completions.select("*", F.inline(F.array(answer)))


def generation_results(completions: DataFrame) -> DataFrame:
    """One row per usable answer, with its clean keywords (maybe none)."""
    return parse_completions(completions).filter("is_valid").drop("content", "body", "is_valid")


def clean_keywords(completions: DataFrame) -> DataFrame:
    """One row per clean keyword, in order within its answer."""
    rest = [c for c in completions.columns if c != "content"]
    items = clean_items(parse_json(keyword_body(F.col("content"))))
    return completions.select(*rest, F.posexplode(items).alias("pos", "item")).select(
        *rest, "pos", "item.keyword", "item.language"
    )


def rejects_report(completions: DataFrame) -> DataFrame:
    """Answers that are no JSON: the query for display and how the text begins."""
    parsed = parse_completions(completions).filter(~F.col("is_valid"))
    return parsed.select(
        "model", "query", F.upper("query").alias("title"), F.substring("body", 1, 100).alias("excerpt")
    )


def keyword_shortage(completions: DataFrame, n_keywords: int) -> DataFrame:
    """Usable answers with fewer clean keywords than asked for."""
    counted = generation_results(completions).withColumn("accepted", F.size("keywords").cast("long"))
    return counted.filter(F.col("accepted") < n_keywords).select(
        "model_seq", "model", "query", "topic", "accepted", (F.lit(n_keywords) - F.col("accepted")).alias("missing")
    )


def category_lookup(rows: DataFrame, categories: DataFrame, name_col: str = "query") -> DataFrame:
    """Add ``category_id`` by category name.

    A name may be that of a third of all rows, so the categories are broadcast while
    they fit; beyond that adaptive execution splits the larger side.
    """
    names = categories.select(F.col("category").alias(name_col), F.col("id").alias("category_id"))
    return rows.join(F.broadcast(names) if fits_broadcast(names) else names, name_col)


def category_get_or_create(categories: DataFrame, wanted: DataFrame) -> DataFrame:
    """All categories after asking for ``wanted(input_seq, category)``: known
    names keep their id, new names get the next ids in order of first mention."""
    mentioned = wanted.groupBy("category").agg(F.min("input_seq").alias("_seq"))
    new = mentioned.join(categories.select("category"), "category", "left_anti")
    last = categories.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    created = dense_ids(new, ["_seq", "category"], last + 1)
    return categories.select("id", "category").unionByName(created.select("id", "category"))


def keyword_build(cleaned: DataFrame, categories: DataFrame, stored: DataFrame) -> DataFrame:
    """The keywords to insert: ``category_id, keyword, language, model_seq``.

    Words shorter than three characters are dropped, and words the category
    already holds in any language.  The first model that proposes a word for a
    category wins; it may bring the word in several languages.
    """
    named = category_lookup(cleaned, categories).select(
        "category_id", F.lower(strip(F.col("keyword"))).alias("keyword"), "language", "model_seq"
    )
    distinct = (
        named.filter(F.length("keyword") >= MIN_KEYWORD_LENGTH)
        .groupBy("category_id", "keyword", "language")
        .agg(F.min("model_seq").alias("model_seq"))
    )
    word = Window.partitionBy("category_id", "keyword")
    winners = (
        distinct.withColumn("_first", F.min("model_seq").over(word))
        .filter("model_seq = _first")
        .drop("_first")
    )
    known = stored.select("category_id", F.lower(strip(F.col("keyword"))).alias("keyword")).distinct()
    return winners.join(known, ["category_id", "keyword"], "left_anti")


def number_keywords(new: DataFrame, stored: DataFrame) -> DataFrame:
    """Give new keywords the next ids, by model, category, word and language."""
    last = stored.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    order = ["model_seq", "category_id", "keyword", "language"]
    return dense_ids(new, order, last + 1).select("id", "category_id", "keyword", "language")


def pluralize(keywords: DataFrame) -> DataFrame:
    return keywords.withColumn("plural", plural(F.col("keyword"), F.col("language")))


def lemmatize(keywords: DataFrame, lemmas: DataFrame, languages: tuple[str, ...] = ("en", "fr")) -> DataFrame:
    """Add ``lemma``: the dictionary form of the first word of the keyword.

    ``lemmas(token, language, lemma)`` has one row per (token, language).  A word
    it does not know stands for itself; a keyword in another language, or an
    empty one, stays as it is.
    """
    lang = F.lower("language")
    first = F.regexp_extract(F.col("keyword"), r"^\s*(\S+)", 1)
    dictionary = lemmas.select(
        F.col("token").alias("_token"), F.col("language").alias("_lang"), F.col("lemma").alias("_lemma")
    )
    joined = keywords.withColumn("_token", first).withColumn("_lang", lang).join(
        dictionary, ["_token", "_lang"], "left"
    )
    known = lang.isin(*languages) & (F.col("_token") != "")
    return joined.withColumn(
        "lemma", F.when(known, F.coalesce("_lemma", "_token")).otherwise(F.col("keyword"))
    ).drop("_token", "_lang", "_lemma")


def expand_variants(keywords: DataFrame, lemmas: DataFrame) -> DataFrame:
    """Each keyword as itself, its plural and its lemma, under the same id.

    ``variant_seq`` keeps their order; equal forms appear once.
    """
    lowered = keywords.withColumn("keyword", F.lower("keyword"))
    forms = lemmatize(pluralize(lowered), lemmas)
    rest = [c for c in keywords.columns if c != "keyword"]
    variants = F.array_distinct(F.array("keyword", "plural", "lemma"))
    return forms.select(*rest, F.posexplode(variants).alias("variant_seq", "keyword"))
