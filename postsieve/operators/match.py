"""The whole-word join of posts and keywords.

A keyword occurs in a text as a whole word only if every run of word characters
inside the keyword is a whole run in the text.  So the join is an equi-join: the
distinct words of a text against one word of each keyword, its *anchor*.  A
keyword that is nothing but its anchor is then already proven; the others are
confirmed against the text.  A keyword without any word character can only fill
a gap between two words, so there the gaps of the text play the part of words.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsieve.functions.text import WORD, fold, gaps, word_pattern, words
from postsieve.operators.sizing import BROADCAST_CHARS, BROADCAST_ROWS, fits_broadcast

_SALTS = 16

# Bare anchors are short: so many may be broadcast to cut the words of the texts down.
_ANCHOR_ROWS = 2_000_000

# From this many keywords with the same anchor on, other anchors are looked for.
_CROWDED = 64


def prepare_keywords(keywords: DataFrame) -> DataFrame:
    """Add the compared form, the anchor and the pattern of each keyword.

    Needs ``id, keyword, language``; ``kw_seq`` (default: id) and ``variant_seq``
    (default: 0) give the keyword order.  The anchor is the longest word.
    """
    columns = keywords.columns
    prepared = keywords.select(
        F.col("id").cast("long").alias("keyword_id"),
        F.col("language"),
        (F.col("kw_seq") if "kw_seq" in columns else F.col("id")).cast("long").alias("kw_seq"),
        (F.col("variant_seq") if "variant_seq" in columns else F.lit(0)).alias("variant_seq"),
        fold(F.col("keyword")).alias("folded"),
    ).filter(F.col("folded") != "")
    by_length = F.transform(_runs(), lambda r: F.struct(F.length(r).alias("n"), r.alias("run")))
    return _anchored(prepared.withColumn("anchor", F.array_max(by_length)["run"]))


def _runs() -> Column:
    return F.regexp_extract_all("folded", F.lit(f"{WORD}+"), F.lit(0))


def _anchored(prepared: DataFrame) -> DataFrame:
    rest = [c for c in prepared.columns if c not in ("anchor", "is_gap", "is_proven", "spaced", "pattern")]
    anchor = F.coalesce("anchor", "folded")
    return prepared.select(
        *rest,
        anchor.alias("anchor"),
        F.col("anchor").isNull().alias("is_gap"),
        (anchor.isNotNull() & F.col("anchor").eqNullSafe(F.col("folded"))).alias("is_proven"),
        F.when(
            F.col("folded").rlike(f"^{WORD}") & F.col("folded").rlike(f"{WORD}\\z"),
            F.concat(F.lit(" "), "folded", F.lit(" ")),
        ).alias("spaced"),
        word_pattern(F.col("folded")).alias("pattern"),
    )


def spread_anchors(prepared: DataFrame) -> DataFrame:
    """Anchor each keyword at the word that the fewest keywords contain.

    If a third of all keywords begin with the same long word, a text with that
    word would have to be compared with all of them.
    """
    words_of = prepared.select("folded", F.explode(F.array_distinct(_runs())).alias("run")).distinct()
    counts = words_of.groupBy("run").agg(F.count("*").alias("n"))
    rarest = (
        words_of.join(counts, "run")
        .groupBy("folded")
        .agg(F.min(F.struct("n", (-F.length("run")).alias("short"), "run")).alias("best"))
        .select("folded", F.col("best.run").alias("anchor"))
    )
    return _anchored(prepared.drop("anchor").join(rarest, "folded", "left"))


def _confirmed(text: Column) -> Column:
    """Proven by the anchor alone, or found in the text.

    From cheap to dear: the plain substring, the substring between two blanks,
    and only then the pattern.
    """
    found = F.contains(text, F.col("spaced")) | F.rlike(text, F.col("pattern"))
    return F.col("is_proven") | (F.contains(text, F.col("folded")) & found)


def _tokens(text: Column, with_gaps: bool) -> Column:
    return F.array_distinct(F.concat(words(text), gaps(text)) if with_gaps else words(text))


def match_pairs(
    posts: DataFrame,
    keywords: DataFrame,
    id_col: str = "external_id",
    text_col: str = "content",
    carry: list[str] | None = None,
    max_broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """All (post, keyword) pairs with the keyword as a whole word in the post.

    Returns ``id_col``, the ``carry`` columns and ``keyword_id, kw_seq,
    variant_seq, language``.  A keyword table within the bounds is broadcast:
    posts are then read, split into words and joined in one stage, without a
    shuffle.  A larger one is joined by shuffling bare words, see
    ``_match_shuffled``.  Either way every row of ``posts`` is matched by itself, also
    rows that share an id.
    """
    carry = carry or []
    prepared = prepare_keywords(keywords)
    size = (
        prepared.groupBy("anchor", "is_proven")
        .agg(
            F.count("*").alias("n"),
            F.sum((F.octet_length("folded") * 3).cast("long")).alias("chars"),
            F.max("is_gap").alias("gaps"),
        )
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
            F.coalesce(F.sum("chars"), F.lit(0)).alias("chars"),
            F.coalesce(F.max("gaps"), F.lit(False)).alias("gaps"),
            F.coalesce(F.max(F.when(~F.col("is_proven"), F.col("n"))), F.lit(0)).alias("crowd"),
        )
        .first()
    )
    if size.crowd >= _CROWDED:
        prepared = spread_anchors(prepared)
    payload = [c for c in dict.fromkeys(carry) if c != id_col]
    texts = posts.select(id_col, *payload, fold(F.col(text_col)).alias("_text"))
    outcome = [id_col, *payload, "keyword_id", "kw_seq", "variant_seq", "language"]
    if size.n <= max_broadcast_rows and size.chars <= BROADCAST_CHARS:
        side = prepared.withColumnRenamed("language", "_language")
        tokens = texts.withColumn("_token", F.explode(_tokens(F.col("_text"), size.gaps)))
        hits = tokens.join(
            F.broadcast(side),
            (F.col("_token") == F.col("anchor")) & _confirmed(F.col("_text")),
        )
        if "language" in payload:
            hits = hits.drop("language")
        return hits.withColumnRenamed("_language", "language").select(outcome)
    return _match_shuffled(texts, prepared, id_col, payload, size.gaps).select(outcome)


def _match_shuffled(
    texts: DataFrame, prepared: DataFrame, id_col: str, payload: list[str], with_gaps: bool
) -> DataFrame:
    """The join for a keyword table of any size.

    Words are shuffled as bare (id, word) pairs, and where the anchors fit a
    broadcast only those that are an anchor.  A word that most texts contain
    would land in one task, so words are salted by post id and keywords copied
    once per salt.  The pairs found meet the rows again by id and text, so rows that
    share an id stay apart, and rows that share both are looked up once.  Pairs that
    the anchor proves need no text; for the others texts are shuffled, never
    broadcast by an estimate of their size.
    """
    texts = texts.withColumn("_hash", F.xxhash64("_text"))
    salt = F.pmod(F.xxhash64(id_col, "_hash"), F.lit(_SALTS)).cast("int")
    tokens = texts.select(
        id_col, "_hash", salt.alias("_salt"), F.explode(_tokens(F.col("_text"), with_gaps)).alias("anchor")
    )
    anchors = prepared.select("anchor").distinct()
    if fits_broadcast(anchors, max_rows=_ANCHOR_ROWS):
        tokens = tokens.join(F.broadcast(anchors), "anchor", "left_semi")
    # The join needs this placing anyway.
    tokens = tokens.repartition("anchor", "_salt").dropDuplicates()
    copies = prepared.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    rest = texts.select(id_col, "_hash", "_text", *[c for c in payload if c != "language"])

    def met(keywords: DataFrame, rows: DataFrame) -> DataFrame:
        # Hashing the keywords spares sorting the many words.
        found = tokens.join(keywords.hint("shuffle_hash"), ["anchor", "_salt"])
        return found.join(rows.hint("merge"), [id_col, "_hash"])

    proven = met(copies.filter("is_proven"), rest.drop("_text"))
    others = met(copies.filter(~F.col("is_proven")), rest).filter(_confirmed(F.col("_text")))
    return proven.unionByName(others.drop("_text"))


def match_all(
    posts: DataFrame,
    keywords: DataFrame,
    id_col: str = "external_id",
    text_col: str = "content",
    carry: list[str] | None = None,
    **options,
) -> DataFrame:
    """Per matching post the sorted set of keyword ids, and the language of the
    first matching keyword in keyword order.

    Posts that already sit in partitions by ``id_col`` need no further shuffle;
    otherwise only matching posts move, combined per task beforehand.
    """
    pairs = match_pairs(posts, keywords, id_col, text_col, carry, **options)
    payload = [c for c in dict.fromkeys(carry or []) if c not in (id_col, "language")]
    return (
        pairs.groupBy(id_col)
        .agg(
            F.array_sort(F.collect_set("keyword_id")).alias("keyword_ids"),
            F.min(F.struct("kw_seq", "variant_seq", "language"))["language"].alias("language"),
            *[F.first(c).alias(c) for c in payload],
        )
        .select(id_col, *payload, "language", "keyword_ids")
    )


def keyword_lookup(targets: DataFrame, keywords: DataFrame) -> DataFrame:
    """Id and language per wanted keyword; the lowest id if there are several,
    no row if there is none."""
    lowest = keywords.groupBy("keyword").agg(F.min(F.struct("id", "language")).alias("k"))
    return targets.join(lowest, "keyword").select("keyword", "k.id", "k.language")
