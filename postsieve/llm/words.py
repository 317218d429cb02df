"""Texts cut where tokenizers cut them anyway, so that repeated pieces are encoded once.

A worker remembers what it worked out for short pieces, up to a bound; a piece met
again costs one look-up.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa

REMEMBERED = 250_000
LONGEST = 64

# What may start a piece behind a blank: printable ASCII, or a letter, digit or underscore anywhere.
_SAFE = re.compile(r"[!-~\w]")
_LINES = str.maketrans("\t\n\r", "   ")
# Characters of a batch of texts whose pieces are held at once.
BATCH_CHARS = 1_000_000


def blank_pieces(text: str) -> list[str]:
    """``text`` cut at single blanks that something other than white space follows; the blank goes.

    Blanks that stand beside white space stay inside a piece.
    """
    parts = text.split(" ")
    safe = _SAFE.match
    if all(map(safe, parts)):
        return parts
    out = [parts[0]]
    for before, part in zip(parts, parts[1:]):  # noqa: B905
        if before and safe(part):
            out.append(part)
        else:
            out[-1] += " " + part
    return out


def spaced_pieces(text: str) -> list[str]:
    """The parts of ``text`` between blanks, tabs and line ends."""
    return [part for part in text.translate(_LINES).split(" ") if part]


# Letters and numbers of Latin-1 in lower case; printable Latin-1 is put together already.
_LETTERS, _NUMBERS = "a-zªµºß-öø-ÿ", "0-9²³¹¼-¾"
_LATIN = re.compile(r"[!-~¡-ÿ]+")
_LATIN_TEXT = re.compile(r"[\t\n\r -~¡-ÿ]*")
_WORDS = re.compile(rf"[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[{_NUMBERS}]|[^\s{_LETTERS}{_NUMBERS}]+")


def is_plain(text: str) -> bool:
    """Whether ``text`` is of Latin-1 alone, without control characters and special tokens."""
    return "<|" not in text and _LATIN_TEXT.fullmatch(text) is not None


def lower_words(text: str) -> list[str]:
    """The words of a tokenizer that lower-cases, drops white space and cuts contractions, letters,
    single numbers and the rest; parts beyond Latin-1, and such with a special token, stay whole.

    For Latin-1 it is certain what is a letter and what lower case is.
    """
    if is_plain(text):
        return _WORDS.findall(text.lower())
    out: list[str] = []
    for part in spaced_pieces(text):
        if "<|" not in part and _LATIN.fullmatch(part):
            out += _WORDS.findall(part.lower())
        else:
            out.append(part)
    return out


# Classes of the characters of Latin-1, and what may follow an apostrophe as two characters.
_SPACE, _LETTER, _NUMBER, _OTHER = 0, 1, 2, 3
_CLASSES = np.array(
    [
        _LETTER if re.match(f"[{_LETTERS}]", c) else _NUMBER if re.match(f"[{_NUMBERS}]", c) else _SPACE if c.isspace() else _OTHER
        for c in map(chr, range(256))
    ],
    dtype=np.uint8,
)
_TAIL = np.zeros(256, dtype=bool)
_TAIL[list(b"stmd")] = True
_TAILS = [tuple(tail) for tail in (b"re", b"ve", b"ll")]


def plain_words(texts: list[str]) -> pa.Array:
    """The ``lower_words`` of each of many plain texts, as a list of Latin-1 bytes.

    Words start where the class of characters changes, and at each number.  An apostrophe
    that stands alone before one of the tails is one word with it.
    """
    codes = np.frombuffer("\n".join([*texts, "\n"]).lower().encode("latin-1"), dtype=np.uint8)
    kind = _CLASSES[codes]
    starts = kind == _NUMBER
    starts[0] = True
    starts[1:] |= kind[1:] != kind[:-1]
    # Two line ends stand behind the last text, so a letter has at least two characters behind it.
    marks = np.flatnonzero((codes == 39) & starts)
    marks = marks[kind[marks + 1] == _LETTER]
    first, second = codes[marks + 1], codes[marks + 2]
    two = np.zeros(len(marks), dtype=bool)
    for a, b in _TAILS:
        two |= (first == a) & (second == b)
    for found, size in ((_TAIL[first], 2), (two, 3)):
        at = marks[found]
        starts[at + 1] = False
        starts[(at + size)[kind[at + size] == _LETTER]] = True
    bounds = np.flatnonzero(starts)
    sizes, is_word = np.diff(bounds, append=len(codes)), kind[bounds] != _SPACE
    begins = np.cumsum([0, *[len(text) + 1 for text in texts]])
    ends = np.cumsum(sizes[is_word])
    words = pa.Array.from_buffers(
        pa.large_binary(),
        len(ends),
        [None, pa.py_buffer(np.concatenate([[0], ends])), pa.py_buffer(codes[kind != _SPACE])],
    )
    return pa.LargeListArray.from_arrays(np.searchsorted(bounds[is_word], begins), words)


# One such word by itself.
_WORD = re.compile(rf"[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[{_NUMBERS}]|[!-/:-@\[-`{{-~¡-©«-±´¶-¸»¿×÷]+")


def is_word(piece: str) -> bool:
    """Whether ``piece`` is one word of ``lower_words``, not a part left whole."""
    return _WORD.fullmatch(piece) is not None and "<|" not in piece


def joinable(piece: str) -> bool:
    """Whether ``piece`` may stand between others with single blanks between, and is cut there again."""
    return _SAFE.match(piece) is not None and not piece[-1].isspace()


def batches(texts: list[str], chars: int = BATCH_CHARS) -> Iterator[list[str]]:
    """``texts`` in order, in lists that end once they have ``chars`` characters."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held


class Memory:
    """Results for pieces; ``learn`` works out those of a list of new ones.

    What has not been met since the memory was full the last time is forgotten when it is full again.
    """

    def __init__(self, learn: Callable[[list[str]], Sequence[Any]], most: int = REMEMBERED):
        self._learn, self._most = learn, most
        self._known: dict[str, Any] = {}
        self._before: dict[str, Any] = {}

    def of(self, pieces: list[str]) -> list[Any]:
        found = list(map(self._known.get, pieces))
        if None not in found:
            return found
        missed = {p for p, f in zip(pieces, found) if f is None}  # noqa: B905
        old = {p: self._before[p] for p in missed & self._before.keys()}
        new = list(missed - old.keys())
        learned = old | dict(zip(new, self._learn(new))) if new else old  # noqa: B905
        for piece, result in learned.items():
            if len(piece) <= LONGEST:
                if len(self._known) >= self._most:
                    self._before, self._known = self._known, {}
                self._known[piece] = result
        return [learned[p] if f is None else f for p, f in zip(pieces, found)]  # noqa: B905
