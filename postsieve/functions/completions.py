"""Model answers as Column expressions: fences, JSON, keyword items."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from postsieve.functions.text import bind, normalize_keyword, normalize_language, strip

# Fixed values.
FENCE = "```"
LANGUAGES_ALLOWED = ["fr", "en"]

_PAIR = "\u0001"
_END = "end of answer 7f3a91"


def _body(content: Column, clean_fenced: Callable[[Column], Column]) -> Column:
    return bind(
        strip(content),
        lambda text: F.when(
            F.contains(text, F.lit(FENCE)), strip(clean_fenced(F.split(text, FENCE, -1)[1]))
        ).otherwise(text),
    )


def keyword_body(content: Column) -> Column:
    """The JSON text of a keyword answer: the fenced part, if there is a fence,
    without one leading ``json``."""
    return _body(content, lambda fenced: F.regexp_replace(fenced, "^json", ""))


def topic_body(content: Column) -> Column:
    """The JSON text of a topic answer; here every ``json`` in the fence goes."""
    return _body(content, lambda fenced: F.replace(fenced, F.lit("json"), F.lit("")))


def parse_json(text: Column) -> Column:
    """JSON text -> variant; NULL if the text is anything but one JSON value.

    The parser stops at the end of the first value and would let trailing text
    pass.  So the text becomes the first element of a two-element array: with
    anything behind the value, the array breaks or has another size.
    """
    framed = F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{_END}"]')))
    return bind(
        framed.try_cast("array<variant>"), lambda pair: F.when(F.size(pair) == 2, pair[0])
    )


def clean_items(parsed: Column) -> Column:
    """Parsed answer -> ``array<struct<keyword,language>>``.

    Normalised, only whitelisted languages, each pair once and in order of first
    appearance.  Items that are no objects, or lack a keyword, drop out.  All of
    it happens within the row, so no rows move.
    """
    # One text per pair: distinct on text hashes, distinct on structs compares
    # every element with every other.
    empty = [language + _PAIR for language in LANGUAGES_ALLOWED]
    items = F.coalesce(parsed.try_cast("array<variant>"), F.array().cast("array<variant>"))

    def pair(item: Column) -> Column:
        language = normalize_language(F.try_variant_get(item, "$.language", "string"))
        # Keywords in other languages are not worked out at all.
        keyword = normalize_keyword(F.try_variant_get(item, "$.keyword", "string"))
        return F.when(language.isin(LANGUAGES_ALLOWED), F.concat(language, F.lit(_PAIR), keyword))

    kept = F.array_distinct(F.filter(F.transform(items, pair), lambda p: ~p.isin(empty)))
    return F.transform(
        kept,
        lambda p: F.struct(
            F.substring(p, F.instr(p, _PAIR) + 1, F.length(p)).alias("keyword"),
            F.substring_index(p, _PAIR, 1).alias("language"),
        ),
    )


def topic_list(parsed: Column) -> Column:
    """``topics`` of a topic answer as ``array<string>``; NULL if there is no such list."""
    field = F.try_variant_get(parsed, "$.topics", "variant")
    return F.transform(
        field.try_cast("array<variant>"), lambda t: F.try_variant_get(t, "$", "string")
    )
