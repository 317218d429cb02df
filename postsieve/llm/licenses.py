"""License scans: Aho-Corasick for tags and notices, a shunting-yard parser for expressions."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.llm.common import text_or_empty

# Fixed by the contract: phrase and label.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Further notices and how telling they are.
NOTICES = {
    "apache license": ("apache", 0.9),
    "apache license version 2 0": ("apache-2.0", 0.95),
    "mit license": ("mit", 0.9),
    "bsd license": ("bsd", 0.9),
    "bsd 2 clause": ("bsd-2-clause", 0.9),
    "bsd 3 clause": ("bsd-3-clause", 0.9),
    "mozilla public license": ("mpl", 0.9),
    "gnu general public license": ("gpl", 0.9),
    "general public license version 2": ("gpl-2.0", 0.95),
    "general public license version 3": ("gpl-3.0", 0.95),
    "lesser general public license": ("lgpl", 0.9),
    "affero general public license": ("agpl", 0.9),
    "creative commons attribution": ("cc-by", 0.8),
    "cc by sa": ("cc-by-sa", 0.8),
    "cc by nc": ("cc-by-nc", 0.8),
    "cc by nd": ("cc-by-nd", 0.8),
    "cc0": ("cc0-1.0", 0.7),
    "public domain": ("public-domain", 0.5),
    "the unlicense": ("unlicense", 0.7),
    "isc license": ("isc", 0.9),
    "zlib license": ("zlib", 0.9),
    "boost software license": ("bsl-1.0", 0.9),
    "artistic license": ("artistic", 0.8),
    "eclipse public license": ("epl", 0.9),
    "european union public licence": ("eupl", 0.9),
    "open software license": ("osl", 0.8),
    "common development and distribution license": ("cddl", 0.9),
    "sil open font license": ("ofl", 0.9),
    "business source license": ("busl", 0.9),
    "server side public license": ("sspl", 0.9),
    "elastic license": ("elastic", 0.7),
    "permission is hereby granted free of charge to any person obtaining a copy": ("mit", 0.8),
    "redistribution and use in source and binary forms": ("bsd", 0.8),
}
BASE_WEIGHT = {"cc-by": 0.6, "gpl": 0.8, "reserved": 0.6}
TAG, TAG_WEIGHT = "spdx license identifier", 0.95
_TAG_MARK = b"spdx-license-identifier:"
_LINE_END = re.compile(rb"[\r\n]")
_COMMENT_END = re.compile(r"\*/|-->")
_TOKEN = re.compile(r"[()]|[^\s()]+")

# What a licence asks for, from the freest to what nobody here knows.
CLASSES = ("permissive", "copyleft", "no-derivatives", "non-commercial", "source-available", "unknown")


def _versions(names: str, versions: str, endings: tuple[str, ...] = ("",)) -> list[str]:
    return [f"{name}-{version}{ending}" for name in names.split() for version in versions.split() for ending in endings]


_GNU = ("", "-only", "-or-later")
_CC = "1.0 2.0 2.5 3.0 4.0"
# Identifiers of the public licence list, by class.
_IDENTIFIERS = {
    "permissive": [
        *"mit mit-0 x11 isc zlib 0bsd unlicense ncsa postgresql wtfpl curl ms-pl hpnd".split(),
        *"apache-1.0 apache-1.1 apache-2.0 bsl-1.0 cc0-1.0 upl-1.0 blueoak-1.0.0 python-2.0 psf-2.0".split(),
        *"bsd-1-clause bsd-2-clause bsd-2-clause-patent bsd-3-clause bsd-3-clause-clear bsd-4-clause".split(),
        *_versions("artistic", "1.0 2.0"),
        *_versions("afl", "1.1 1.2 2.0 2.1 3.0"),
        *_versions("cc-by", _CC),
    ],
    "copyleft": [
        *_versions("gpl", "1.0 2.0 3.0", _GNU),
        *_versions("lgpl", "2.0 2.1 3.0", _GNU),
        *_versions("agpl", "1.0 3.0", _GNU),
        *_versions("mpl", "1.0 1.1 2.0"),
        *_versions("epl", "1.0 2.0"),
        *_versions("eupl", "1.0 1.1 1.2"),
        *_versions("osl", "1.0 1.1 2.0 2.1 3.0"),
        *_versions("cddl ofl", "1.0 1.1"),
        *_versions("cc-by-sa", _CC),
        "mpl-2.0-no-copyleft-exception", "ms-rl",
    ],
    "no-derivatives": _versions("cc-by-nd", _CC),
    "non-commercial": [*_versions("cc-by-nc cc-by-nc-sa cc-by-nc-nd", _CC), "polyform-noncommercial-1.0.0"],
    "source-available": ["busl-1.1", "sspl-1.0", "elastic-2.0", "polyform-small-business-1.0.0"],
}
CLASS_OF = {name: kind for kind, names in _IDENTIFIERS.items() for name in names}
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}


def to_postfix(expression: str) -> list[str]:
    """The shunting yard: operands and operators of an expression in postfix order.

    ``with`` binds closer than ``and``, that closer than ``or``.  ValueError for an
    expression that is not well formed.
    """
    out: list[str] = []
    waiting: list[str] = []
    operand_next = True
    for token in _TOKEN.findall(expression.lower()):
        if token == "(":
            if not operand_next:
                raise ValueError("operator expected")
            waiting.append(token)
        elif token == ")":
            if operand_next:
                raise ValueError("operand expected")
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                raise ValueError("no parenthesis to close")
            waiting.pop()
        elif token in _PRECEDENCE:
            if operand_next:
                raise ValueError("operand expected")
            while waiting and waiting[-1] != "(" and _PRECEDENCE[waiting[-1]] >= _PRECEDENCE[token]:
                out.append(waiting.pop())
            waiting.append(token)
            operand_next = True
        else:
            if not operand_next:
                raise ValueError("operator expected")
            out.append(token)
            operand_next = False
    if operand_next or "(" in waiting:
        raise ValueError("unfinished")
    return out + waiting[::-1]


def expression_of(line: str) -> str:
    """The longest well-formed expression a line begins with, up to the end of a comment; empty without one."""
    tokens = _TOKEN.findall(_COMMENT_END.split(line, maxsplit=1)[0])
    end, depth, operand_next = 0, 0, True
    for k, token in enumerate(tokens):
        if operand_next != (token != ")" and token.lower() not in _PRECEDENCE) or (token == ")" and not depth):
            break
        if token in "()":
            depth += 1 if token == "(" else -1
        else:
            operand_next = token.lower() in _PRECEDENCE
        if not operand_next and not depth:
            end = k + 1
    return " ".join(tokens[:end])


def evaluate(postfix: list[str]) -> tuple[set[str], bool, str]:
    """The licences of an expression, whether a permissive choice satisfies it, and its class.

    ``a or b`` has the freer class of both, ``a and b`` the less free one; ``a with e`` that of a,
    where a named exception frees a copyleft licence.  Only exact identifiers are known
    (``CLASS_OF``; a ``+`` behind one is let pass), all else is unknown, which counts as least free.
    """
    stack: list[tuple[set[str], int]] = []
    for token in postfix:
        if token not in _PRECEDENCE:
            licence = token.strip(".,;*/").rstrip("+")
            stack.append(({licence}, CLASSES.index(CLASS_OF.get(licence, "unknown"))))
            continue
        (right, right_class), (left, left_class) = stack.pop(), stack.pop()
        if token == "with":
            freed = CLASSES[left_class] == "copyleft" and any("exception" in e for e in right)
            stack.append((left, 0 if freed else left_class))
        else:
            stack.append((left | right, (max if token == "and" else min)(left_class, right_class)))
    found, kind = stack.pop()
    return found, kind == 0, CLASSES[kind]


def tag_expressions(raw: bytes, flat: bytes, first_words: list[int]) -> Iterator[str]:
    """What follows the tags that begin at these words, to the end of their lines.

    ``flat`` is ``raw`` as ``scan`` splits it, byte for byte, so the words are found again in the text.
    """
    bare = np.frombuffer(flat, dtype=np.uint8) != 32
    starts = np.flatnonzero(bare & ~np.concatenate([[False], bare[:-1]]))
    for k in first_words:
        start = int(starts[k])
        end = start + len(_TAG_MARK)
        if raw[start:end].lower() == _TAG_MARK:
            yield _LINE_END.split(raw[end:], maxsplit=1)[0].decode("utf-8", "surrogatepass")


@cache
def _automaton() -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for phrase in {*BASE, *NOTICES, TAG}:
        out.add_word(f" {phrase} ", phrase)
    out.make_automaton()
    return out


# A-Z to a-z; ASCII that is neither letter nor digit to a blank.  On UTF-8 bytes, so
# that every other character is part of a word.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def scan(text: str) -> tuple[int, int, int | None, int | None, str, str, float, str]:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, terms, classes of a whole text."""
    raw = text.encode("utf-8", "surrogatepass")
    flat = raw.translate(_WORDS)
    words = flat.split()
    line = " " + b" ".join(words).decode("latin-1") + " "
    hits = list(_automaton().iter(line))
    if not hits:
        return len(words), 0, None, None, "", "", 0.0, "", ""
    blanks = np.flatnonzero(np.frombuffer(line.encode("latin-1"), dtype=np.uint8) == 32)
    base, weights, places, tags = set(), {}, [], []
    terms, classes = set(), set()
    for end, phrase in hits:
        first = int(np.searchsorted(blanks, end - len(phrase) - 1))
        if phrase in BASE:
            places.append(first)
            label = BASE[phrase]
            base.add(label)
            weights[label] = max(weights.get(label, 0.0), BASE_WEIGHT[label])
        if phrase in NOTICES:
            label, weight = NOTICES[phrase]
            weights[label] = max(weights.get(label, 0.0), weight)
        if phrase == TAG:
            tags.append(first)
    for line in tag_expressions(raw, flat, tags) if tags else []:
        try:
            found, free, kind = evaluate(to_postfix(expression_of(line)))
        except ValueError:
            continue
        classes.add(kind)
        terms.add("permissive" if free else "unknown" if kind == "unknown" else "restricted")
        for label in found - {""}:
            weights[label.replace(",", "")] = TAG_WEIGHT
    missed = 1.0
    for weight in weights.values():
        missed *= 1 - weight
    span = (min(places), max(places)) if places else (None, None)
    return len(words), len(places), *span, ",".join(sorted(base)), ",".join(sorted(weights)), 1 - missed, ",".join(sorted(terms)), ",".join(sorted(classes))


_COLUMNS = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "terms", "classes"]
_SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string,"
    " score double, terms string, classes string"
)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Per document what ``scan`` finds; texts are read once and nothing is shuffled.

    ``labels`` has the base labels, those of further notices and the licences of
    tag expressions, each as far as it is well formed; ``score`` is the chance that one of the findings is
    right if each is by its weight; ``terms`` says whether tags leave a permissive
    choice (permissive, restricted, unknown) and ``classes`` which of ``CLASSES`` they are.  NULL texts are empty; repeated rows each get their row.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [scan(text) for text in batch["text"]]
            out = pd.DataFrame(rows, columns=_COLUMNS[1:], dtype=object)
            out = out.astype({"first_word": "Int64", "last_word": "Int64"})
            out.insert(0, "doc_id", batch["doc_id"])
            yield out

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return narrow.mapInPandas(run, _SCHEMA)
