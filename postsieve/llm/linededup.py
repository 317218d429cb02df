"""Line deduplication, in DataFrame functions only.

Lines become 128-bit hashes, range-partitioned by (hash, block of documents) and sorted
by document and position, so that first occurrences stream by and a line that a
third of all documents share still spreads over many partitions.  What comes back
are sparse bitmaps per document, not text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postsieve.llm.common import small, stored, text_or_empty

MIN_CHARS = 40
MIN_DOCS = 5
BROADCAST_ROWS = 500_000
BLOCK_BITS = 12  # documents whose ids agree but for these bits are one block

_BLANKS = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """Stripped of ASCII white space, with A-Z lower-cased (other letters stay)."""
    bare = F.btrim(line, F.lit(_BLANKS))
    # lower() folds exactly A-Z if every character is one byte long; it is much faster.
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(
        F.translate(bare, _UPPER, _LOWER)
    )


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def long_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, th, pos, h1, h2) of each line whose key has ``min_chars`` code points."""
    texts = docs.where("doc_id IS NOT NULL").select("doc_id", F.xxhash64("text").alias("th"), "text")
    lines = texts.select("doc_id", "th", F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    keys = lines.where(F.char_length("line") >= min_chars).select("doc_id", "th", "pos", line_key(F.col("line")).alias("key"))
    # Two 64-bit hashes: one of the key, one of the key behind another seed.
    return keys.where(F.char_length("key") >= min_chars).select(
        "doc_id", "th", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")
    )


def first_occurrences(lines: DataFrame) -> DataFrame:
    """``lines`` with ``opens``: 1 on the first line of its hash in its document, else 0.

    Ranges are cut by (hash, block of documents), and sorted within by document, the
    largest first, and position.  The window asks for that very partitioning and order, so it
    streams over the sorted rows without another shuffle, and no run is longer than
    what a block of documents holds of one line.
    """
    blocks = lines.withColumn("block", F.shiftright(F.col("doc_id").cast("long"), BLOCK_BITS))
    spread = blocks.repartitionByRange("h1", "h2", "block").sortWithinPartitions(
        "h1", "h2", "block", F.desc("doc_id"), "pos"
    )
    run = Window.partitionBy("h1", "h2", "block").orderBy(F.desc("doc_id"), "pos")
    opens = F.when(F.lag("doc_id").over(run) == F.col("doc_id"), 0).otherwise(1)
    return spread.withColumn("opens", opens).drop("block")


def crowded_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """(h1, h2, keeper, n): hashes that open in ``min_docs`` documents, and their rows.

    The ranges hold a hash together but for the cuts, so each task sends one row per hash.
    """
    return (
        first_occurrences(lines)
        .groupBy("h1", "h2")
        .agg(F.sum("opens").alias("docs"), F.max("doc_id").alias("keeper"), F.count("*").alias("n"))
        .where(F.col("docs") >= min_docs)
        .select("h1", "h2", "keeper", "n")
    )


def lines_of(lines: DataFrame, crowded: DataFrame) -> DataFrame:
    """The rows of ``lines`` that are in ``crowded`` (stored), with their keeper.

    Beyond the bound of the broadcast the hashes with most rows, as many powers of two as stay
    below it, are still broadcast; so a hash that is left to the shuffle has few rows.
    """
    keys = ["h1", "h2"]
    if small(crowded, BROADCAST_ROWS):
        return lines.join(F.broadcast(crowded), keys)
    power = F.floor(F.log2("n"))
    room, least = BROADCAST_ROWS, 64
    for row in crowded.groupBy(power.alias("power")).count().orderBy(F.desc("power")).collect():
        room -= row["count"]
        if room < 0:
            break
        least = row["power"]
    heavy = F.broadcast(crowded.where(power >= least))
    rest = lines.join(heavy, keys, "left_anti").join(crowded.where(power < least), keys)
    return lines.join(heavy, keys).unionByName(rest)


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, th, dropped): per document a sparse bitmap of the lines that go.

    ``dropped`` maps a position divided by 64 to the 64 bits of its lines; words
    without a bit are left out, and so are documents that keep every line.  A line
    goes if its key is in ``min_docs`` documents and this is not the largest doc_id
    among them.
    """
    lines = stored(long_lines(docs, min_chars))
    crowded = stored(crowded_lines(lines, min_docs))
    bit = F.expr("shiftleft(1L, pos % 64)")
    gone = lines_of(lines, crowded).where(F.col("doc_id") != F.col("keeper"))
    words = (
        gone.repartition("doc_id", "th")
        .groupBy("doc_id", "th", F.expr("pos div 64").cast("int").alias("word"))
        .agg(F.bit_or(bit).alias("bits"))
    )
    return words.groupBy("doc_id", "th").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("word", "bits")))).alias("dropped")
    )


def _with_bitmaps(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """(all of ``docs`` as a struct, text, dropped) for every row."""
    base = docs.select(
        F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("_id"), text_or_empty().alias("_text")
    ).withColumn("_th", F.xxhash64("_text"))
    maps = dropped_lines(base.select(F.col("_id").alias("doc_id"), F.col("_text").alias("text")), min_chars, min_docs)
    maps = maps.select(F.col("doc_id").alias("_mid"), F.col("th").alias("_mth"), "dropped")
    joined = base.join(maps, (F.col("_id") == F.col("_mid")) & (F.col("_th") == F.col("_mth")), "left")
    return joined.select("row", "_text", "dropped")


_KEPT = """CASE WHEN dropped IS NULL THEN _text ELSE array_join(filter(split(_text, '\\n', -1),
    (x, i) -> (shiftright(coalesce(dropped[i div 64], 0L), i % 64) & 1L) = 0L), '\\n') END"""


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with shared long lines taken out of all but the largest doc_id.

    Keeps the columns of ``docs`` (n_chars, if there, follows the new text).  A NULL
    or empty text is one empty line and stays as it is; rows without doc_id stay
    whole and count for nothing; rows that share a doc_id count as one document.
    """
    joined = _with_bitmaps(docs, min_chars, min_docs)
    kept = F.when(F.col("dropped").isNull(), F.col("row.text")).otherwise(F.expr(_KEPT))
    out = joined.select("row", kept.alias("_kept"), "dropped")

    def column(name: str) -> Column:
        own = F.col("row").getField(name)
        if name == "text":
            return F.col("_kept").alias(name)
        if name == "n_chars":
            kind = docs.schema[name].dataType
            return F.when(F.col("dropped").isNull(), own).otherwise(F.char_length("_kept").cast(kind)).alias(name)
        return own.alias(name)

    return out.select(*[column(name) for name in docs.columns])


def line_report(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, kept_sha256 (of the lines that stay)."""
    joined = _with_bitmaps(docs.select("doc_id", "text"), min_chars, min_docs)
    bits = F.expr("aggregate(map_values(dropped), 0, (n, w) -> n + bit_count(w))")
    return joined.select(
        F.col("row.doc_id").alias("doc_id"),
        F.size(_lines(F.col("_text"))).cast("long").alias("n_lines"),
        F.coalesce(bits, F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(F.expr(_KEPT).cast("binary"), 256).alias("kept_sha256"),
    )


SQL = r"""
WITH lines AS (
    SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keys AS (
    SELECT doc_id, pos, line,
        translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), crowded AS (
    SELECT key, max(doc_id) AS keeper FROM keys WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
    SELECT k.doc_id, k.pos, k.line, (c.key IS NOT NULL AND k.doc_id <> c.keeper) AS gone
    FROM keys k LEFT JOIN crowded c ON k.key = c.key
)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
