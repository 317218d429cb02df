"""Text as Column expressions: normalising, folding, words and word patterns."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space in keywords.
WHITESPACE = (
    r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)

# The same characters one by one, for trimming.
_SPACES = "".join(
    chr(c)
    for first, last in [(0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
                        (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)]
    for c in range(first, last + 1)
)

# What becomes one blank in keywords: runs of white space, ``_`` and ``-``, but for a blank alone.
# The first class makes the search skip letters at once.
_GAP = f"{WHITESPACE[1:-1]}_\\-"
_NOT_ONE_BLANK = rf"[\x00-\x1f_\-\x{{80}}-\x{{ffff}}&&[{_GAP}]][{_GAP}]*| [{_GAP}]+"

# A word character is a letter, a number or an underscore
# (combining marks are not).
WORD = r"[\p{L}\p{N}_]"
NOT_WORD = r"[^\p{L}\p{N}_]"

# The same for looking back.  The last code point, which no text holds, makes the
# look-behind step over whole code points instead of halves of surrogate pairs.
_WORD_BEHIND = "[\\p{L}\\p{N}_\U0010ffff]"

# Lower-case letters that Unicode case folding treats as another
# lower-case letter, each followed by the letter it stands for.  (The combining
# iota U+0345 is left out: it is no word character, the iota is.)
SAME_LETTER = {
    "\u0131": "i",
    "\u017f": "s",
    "\u00b5": "\u03bc",
    "\u1fbe": "\u03b9",
    "\u1fd3": "\u0390",
    "\u1fe3": "\u03b0",
    "\u03d0": "\u03b2",
    "\u03f5": "\u03b5",
    "\u03d1": "\u03b8",
    "\u03f0": "\u03ba",
    "\u03d6": "\u03c0",
    "\u03f1": "\u03c1",
    "\u03c2": "\u03c3",
    "\u03d5": "\u03c6",
    "\u1c80": "\u0432",
    "\u1c81": "\u0434",
    "\u1c82": "\u043e",
    "\u1c83": "\u0441",
    "\u1c84": "\u0442",
    "\u1c85": "\u0442",
    "\u1c86": "\u044a",
    "\u1c87": "\u0463",
    "\u1c88": "\ua64b",
    "\u1e9b": "\u1e61",
    "\ufb05": "\ufb06",
}

# All of them lie beyond ASCII; the range makes the search skip ASCII at once.
_SAME_LETTER_SEARCH = r"[\x{80}-\x{ffff}&&[" + "".join(SAME_LETTER) + "]]"

# Word endings that decide the plural.
PLURAL_ES_EN = r"(s|x|z|ch|sh)$"
PLURAL_SAME_FR = r"(s|x|z)$"


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once.

    A Column that occurs several times in an expression may be computed as often;
    the variable of a lambda is not.
    """
    return F.transform(F.array(value), use)[0]


def strip(text: Column) -> Column:
    """Remove leading and trailing Unicode white space; only the edges are looked at."""
    return F.btrim(text, F.lit(_SPACES))


def normalize_keyword(keyword: Column) -> Column:
    """Lower case; ``_`` and ``-`` become blanks; one blank between words."""
    return F.trim(F.regexp_replace(F.lower(keyword), _NOT_ONE_BLANK, " "))


def normalize_language(language: Column) -> Column:
    return F.lower(strip(language))


def post_text(text: Column) -> Column:
    """Lower-cased post text; a missing text is the empty text."""
    return F.lower(F.coalesce(text, F.lit("")))


def fold(text: Column) -> Column:
    """The form in which texts and keywords are compared, ignoring case.

    The letter-by-letter translation is slow, so only the rare texts that hold
    one of its letters pay for it.
    """
    low = post_text(text)
    folded = F.translate(low, "".join(SAME_LETTER), "".join(SAME_LETTER.values()))
    return F.when(low.rlike(_SAME_LETTER_SEARCH), folded).otherwise(low)


def words(text: Column) -> Column:
    """The maximal runs of word characters (plus '' at a ragged edge)."""
    return F.split(text, f"{NOT_WORD}+")


def gaps(text: Column) -> Column:
    """The runs of other characters between the words and at the edges."""
    return F.split(text, f"{WORD}+")


def word_pattern(keyword: Column) -> Column:
    """A regular expression that finds ``keyword`` as a whole word, any case.

    A word boundary lies between a word character and another one, so a side of
    the keyword that is itself no word character needs a word next to it.
    """
    quoted = F.replace(keyword, F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
    left = F.when(keyword.rlike(f"^{WORD}"), F.lit(f"(?<!{_WORD_BEHIND})")).otherwise(
        F.lit(f"(?<={_WORD_BEHIND})")
    )
    right = F.when(keyword.rlike(f"{WORD}\\z"), F.lit(f"(?!{WORD})")).otherwise(F.lit(f"(?={WORD})"))
    return F.concat(F.lit("(?iu)"), left, F.lit("\\Q"), quoted, F.lit("\\E"), right)


def plural(keyword: Column, language: Column) -> Column:
    lang = F.lower(language)
    return (
        F.when((lang == "en") & keyword.rlike(PLURAL_ES_EN), F.concat(keyword, F.lit("es")))
        .when(lang == "en", F.concat(keyword, F.lit("s")))
        .when((lang == "fr") & keyword.rlike(PLURAL_SAME_FR), keyword)
        .when(lang == "fr", F.concat(keyword, F.lit("s")))
        .otherwise(keyword)
    )


def post_uri_parts(external_id: Column) -> Column:
    """Author, collection and record key of ``at://author/collection/key``."""
    pattern = r"^at://([^/]+)/([^/]+)/([^/]+)$"
    names = ["author", "collection", "record_key"]
    return F.struct(*[F.regexp_extract(external_id, pattern, i + 1).alias(n) for i, n in enumerate(names)])


def url_parts(url: Column) -> Column:
    """Scheme, host and path of a web address; the path without query or fragment."""
    pattern = r"^([a-z][a-z0-9+.-]*)://([^/?#]+)([^?#]*)"
    names = ["scheme", "host", "path"]
    return F.struct(*[F.regexp_extract(url, pattern, i + 1).alias(n) for i, n in enumerate(names)])
