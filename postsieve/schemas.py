"""The five tables, the records that travel between them, and their keys."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_TEXT, _INT, _LONG = T.StringType(), T.IntegerType(), T.LongType()

CATEGORIES = _struct(id=_LONG, category=_TEXT)
KEYWORDS = _struct(id=_LONG, category_id=_LONG, keyword=_TEXT, language=_TEXT)
POSTS = _struct(
    external_id=_TEXT,
    content=_TEXT,
    language=_TEXT,
    created_at=T.TimestampNTZType(),
    like_count=_INT,
    reply_count=_INT,
    quote_count=_INT,
    repost_count=_INT,
    labels=_TEXT,  # JSON text
    embed=_TEXT,  # JSON text; 'null' when the post embeds nothing
)
POST_KEYWORDS = _struct(external_id=_TEXT, keyword_id=_LONG)
SCANNED_POSTS = _struct(external_id=_TEXT)

TABLES: dict[str, T.StructType] = {
    "categories": CATEGORIES,
    "keywords": KEYWORDS,
    "posts": POSTS,
    "post_keywords": POST_KEYWORDS,
    "scanned_posts": SCANNED_POSTS,
}

# What a run keeps about itself, batch by batch.
RUN_TABLES: dict[str, T.StructType] = {
    "page_rejects": _struct(keyword_id=_LONG, page=_LONG, reason=_TEXT, body=_TEXT),
    "page_cursors": _struct(keyword_id=_LONG, last_page=_LONG, n_rows=_LONG),
    "keyword_deltas": _struct(keyword_id=_LONG, received=_LONG, matched=_LONG),
    "constraint_deltas": _struct(table_name=_TEXT, rule=_TEXT, columns=_TEXT, violations=_LONG),
    # Either an id of a post or one of a keyword; forget: the id may be collected anew.
    "deletions": _struct(external_id=_TEXT, keyword_id=_LONG, forget=T.BooleanType()),
}

COUNTS = ["like_count", "reply_count", "quote_count", "repost_count"]

# Declared constraints, checked by operators.integrity.constraint_report.
UNIQUE_KEYS: dict[str, list[list[str]]] = {
    "categories": [["id"], ["category"]],
    "keywords": [["id"], ["category_id", "keyword", "language"]],
    "posts": [["external_id"], ["external_id", "content"]],
    "post_keywords": [["external_id", "keyword_id"]],
    "scanned_posts": [["external_id"]],
}
NOT_NULL: dict[str, list[str]] = {
    "categories": ["id", "category"],
    "keywords": ["id", "keyword", "language"],
    "posts": ["external_id", "content"],
    "post_keywords": ["external_id", "keyword_id"],
    "scanned_posts": ["external_id"],
}
FOREIGN_KEYS: list[tuple[str, str, str, str]] = [
    # child table, child column, parent table, parent column
    ("keywords", "category_id", "categories", "id"),
    ("post_keywords", "external_id", "posts", "external_id"),
    ("post_keywords", "keyword_id", "keywords", "id"),
]

# CSV files.
POSTS_CSV = _struct(
    external_id=_TEXT,
    content=_TEXT,
    created_at=T.TimestampNTZType(),
    like_count=_INT,
    reply_count=_INT,
    quote_count=_INT,
    repost_count=_INT,
    labels=_TEXT,
)
KEYWORDS_CSV = _struct(query=_TEXT, keyword=_TEXT, language=_TEXT, model=_TEXT)

# Batches that cross the edge of the system.
COMPLETIONS = _struct(model_seq=_INT, model=_TEXT, query=_TEXT, topic=_TEXT, content=_TEXT)
PAGES = _struct(keyword_id=_LONG, page=_LONG, body=_TEXT)  # body: JSON text, an array of posts
PAGE_POST = _struct(
    external_id=_TEXT,
    text=_TEXT,
    created_at=T.TimestampNTZType(),
    like_count=_INT,
    reply_count=_INT,
    quote_count=_INT,
    repost_count=_INT,
    labels=_TEXT,
    embed=_TEXT,
)
CANDIDATES = _struct(
    kw_seq=_LONG,
    keyword_id=_LONG,
    page=_LONG,
    pos=_LONG,
    external_id=_TEXT,
    text=_TEXT,
    created_at=T.TimestampNTZType(),
    like_count=_INT,
    reply_count=_INT,
    quote_count=_INT,
    repost_count=_INT,
    labels=_TEXT,
    embed=_TEXT,
)
