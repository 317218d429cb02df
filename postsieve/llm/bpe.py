"""BPE by a tokenization automaton.

The merges are compiled one after another.  The automaton starts with one state
that has a loop for every byte.  The gadget of a merge (a, b) -> ab adds one state:
a copy of the state that a leads to, without the arc b; a then leads to the copy,
every state with an arc a gets an arc ab, and ab leads where b leads.  In the end the
paths of a byte string are exactly its BPE tokenization.

Written out, 50,000 such states have up to 50,000 arcs each.  So a gadget is kept as the
one arc it removes; whether a state has an arc follows from the gadgets along the right
parts of its label and the left parts of the arc, and is remembered as a transition.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.llm.common import text_or_empty

CACHED_WORDS = 400_000  # twice; about 60 MB each


def byte_characters() -> dict[str, int]:
    """Characters that stand for bytes in byte-level vocabularies.

    Printable Latin-1 stands for itself, the other bytes for the characters from 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Automaton:
    """Compiled from a vocabulary {bytes: id} and its merges in order.

    A state is named by the label that leads to it; -1 is the start.
    """

    def __init__(self, vocabulary: dict[bytes, int], merges: list[tuple[bytes, bytes]]):
        size = max(vocabulary.values(), default=-1) + 1
        self.labels = [b""] * size
        for token, number in vocabulary.items():
            self.labels[number] = token
        self.left, self.right, self.born = [-1] * size, [-1] * size, [-1] * size
        self.removed: dict[int, int] = {}  # (state, arc) that a gadget took away: its number
        self._table: dict[int, bool] = {}
        for number, (a, b) in enumerate(merges):
            self._gadget(number, vocabulary[a], vocabulary[b], vocabulary[a + b])
        # Labels that are on arcs, as a trie: (node << 8 | byte) leads to the next node.
        self._next: dict[int, int] = {}
        self._label_at = [-1]
        for token, number in vocabulary.items():
            if not self._reached(number):
                continue
            node = 0
            for byte in token:
                node = self._next.setdefault(node << 8 | byte, len(self._label_at))
                if node == len(self._label_at):
                    self._label_at.append(-1)
            self._label_at[node] = number

    def _reached(self, label: int) -> bool:
        return self.born[label] >= 0 or len(self.labels[label]) == 1

    def _gadget(self, number: int, a: int, b: int, ab: int) -> None:
        # Without an arc b behind a no path uses the two, so the merge never applies.
        if self.born[ab] < 0 and self._reached(a) and self._reached(b) and self._has_arc(a, b):
            self.removed[a << 20 | b] = number
            self.left[ab], self.right[ab], self.born[ab] = a, b, number

    def _has_arc(self, state: int, label: int) -> bool:
        """Whether the state has the arc, with the gadgets put in so far.

        State ab began as what b led to when ab was made, so it lacks the arcs that b
        had lost by then, and so on along right parts.  A state got an arc ab if it had
        the arc a at that gadget, and so on along left parts.
        """
        removed, born, left = self.removed, self.born, self.left
        made = len(born)
        while state >= 0:
            arc, needed = label, len(born)
            while arc >= 0:
                gone = removed.get(state << 20 | arc)
                if gone is not None and gone < made and gone <= needed:
                    return False
                needed, arc = born[arc], left[arc]
            made, state = born[state], self.right[state]
        return True

    def step(self, state: int, label: int) -> bool:
        """Table of transitions, filled as they are met."""
        key = state << 20 | label
        known = self._table.get(key)
        if known is None:
            if len(self._table) > 1_000_000:
                self._table.clear()
            known = self._table[key] = self._has_arc(state, label)
        return known

    def encode_word(self, word: bytes) -> list[int]:
        """The labels on the automaton's one path over ``word``.

        Longest arcs first.  A prefix has only one path, so a place from which the path
        does not go on is never tried again.
        """
        step, follow, label_at, n = self.step, self._next.get, self._label_at, len(word)
        path: list[int] = []
        dead = bytearray(n + 1)
        at, state = 0, -1
        while at < n:
            fits, node, end = [], 0, at
            while end < n:
                node = follow(node << 8 | word[end])
                if node is None:
                    break
                end += 1
                label = label_at[node]
                if label >= 0 and not dead[end]:
                    fits.append((end, label))
            for end, label in reversed(fits):
                if state < 0 or step(state, label):
                    path.append(label)
                    at, state = end, label
                    break
            else:
                if not path:
                    raise ValueError(f"the vocabulary lacks a byte of {word!r}")
                dead[at] = 1
                at -= len(self.labels[path.pop()])
                state = path[-1] if path else -1
        return path


# Classes of code points for the split into words.
_SPACE, _LETTER, _NUMBER, _OTHER = 0, 1, 2, 3


@cache
def _classes() -> np.ndarray:
    import regex

    out = np.full(0x110000, _OTHER, dtype=np.uint8)
    everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for pattern, kind in ((r"\p{L}", _LETTER), (r"\p{N}", _NUMBER), (r"\s", _SPACE)):
        out[[ord(c) for c in regex.findall(pattern, everything)]] = kind
    return out


def word_starts(text: str) -> list[int]:
    """Where the words of byte-level BPE start in a text.

    A word is a run of letters, of numbers or of other characters, with one blank
    before it; an English contraction behind an apostrophe; or white space, whose last
    character starts the next word if it is a blank.  (The usual pattern of byte-level
    vocabularies.)
    """
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    n = len(codes)
    if n == 0:
        return []
    kind = _classes()[codes]
    change = np.empty(n, dtype=bool)
    change[0] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:])
    space = kind == _SPACE
    starts = change.copy()
    # The last character of white space before something else stands apart; a blank is
    # taken into the word behind it.
    lasts = np.flatnonzero(space[:-1] & ~space[1:])
    starts[lasts] = True
    blanks = lasts[codes[lasts] == 32]
    starts[blanks + 1] = False
    # Contractions: only where an apostrophe starts a word.
    marks = np.flatnonzero((codes == 39) & starts)
    for at in marks.tolist():
        if not starts[at]:
            continue
        for tail in ("re", "ve", "ll", "s", "t", "m", "d"):
            if text.startswith(tail, at + 1):
                end = at + 1 + len(tail)
                starts[at + 1 : end] = False
                if end < n and not (space[end] and starts[end]):
                    starts[end] = True
                break
    return np.flatnonzero(starts).tolist()


class Tokenizer:
    """Encodes and decodes whole texts; words met before come from a bounded memory."""

    def __init__(self, automaton: Automaton, specials: dict[str, int]):
        self.automaton = automaton
        self.specials = specials
        self._memory: dict[str, bytes] = {}  # words met of late, and those of before
        self._before: dict[str, bytes] = {}
        self._labels = dict(enumerate(automaton.labels)) | {i: s.encode() for s, i in specials.items()}

    def _encode_plain(self, text: str, out: list[bytes]) -> None:
        starts = word_starts(text)
        words = [text[start:end] for start, end in zip(starts, [*starts[1:], len(text)])]  # noqa: B905
        found = list(map(self._memory.get, words))
        if None in found:
            for k, ids in enumerate(found):
                if ids is None:
                    found[k] = self._learn(words[k])
        out += found

    def _learn(self, word: str) -> bytes:
        ids = self._memory.get(word) or self._before.get(word)
        if ids is None:
            path = self.automaton.encode_word(word.encode("utf-8"))
            ids = struct.pack(f"<{len(path)}I", *path)
        if len(self._memory) >= CACHED_WORDS:
            self._before, self._memory = self._memory, {}
        if len(word) <= 64:
            self._memory[word] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text; the text of a special token becomes its id, as in the library."""
        out: list[bytes] = []
        rest = [text]
        for special, number in self.specials.items():
            if special in text:
                mark = np.array([number], dtype="<u4").tobytes()
                parts: list = []
                for piece in rest:
                    if isinstance(piece, bytes):
                        parts.append(piece)
                        continue
                    for k, part in enumerate(piece.split(special)):
                        parts += ([mark] if k else []) + [part]
                rest = parts
        for piece in rest:
            if isinstance(piece, bytes):
                out.append(piece)
            else:
                self._encode_plain(piece, out)
        return np.frombuffer(b"".join(out), dtype="<u4")

    def decode(self, ids: np.ndarray) -> str:
        """The labels on the arcs, put together; bytes that are no UTF-8 become U+FFFD."""
        labels = self._labels
        return b"".join([labels[i] for i in ids.tolist()]).decode("utf-8", "replace")


def read_vocabulary(path: str) -> tuple[dict[bytes, int], list[tuple[bytes, bytes]], dict[str, int]]:
    """Vocabulary, merges and special tokens of a byte-level BPE file of the tokenizers library."""
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    byte_of = byte_characters()

    def raw(token: str) -> bytes:
        return bytes(byte_of[c] for c in token)

    specials = {t["content"]: t["id"] for t in data["added_tokens"]}
    vocabulary = {raw(t): i for t, i in data["model"]["vocab"].items() if t not in specials}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"]]
    return vocabulary, [(raw(a), raw(b)) for a, b in pairs], specials


_BUILT: dict[str, Tokenizer] = {}


def tokenize(docs: DataFrame, path: str) -> DataFrame:
    """Per document: doc_id, ids (array of int).  A NULL text is an empty one."""
    return _apply(docs, path, "doc_id long, ids array<int>", lambda t, d, text: (d, t.encode(text).astype(np.int32)))


def token_report(docs: DataFrame, path: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    ``path`` is read on the driver; the merges, bounded by the vocabulary, are broadcast
    and compiled once in each Python worker.  Texts are encoded where they are read.
    NULL and empty texts have no tokens; repeated rows each get their row.
    """

    def digest(tokenizer: Tokenizer, doc_id, text: str):
        ids = tokenizer.encode(text)
        decoded = tokenizer.decode(ids).encode("utf-8")
        return doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest()

    return _apply(docs, path, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", digest)


def _apply(docs: DataFrame, path: str, schema: str, row) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    names = [field.strip().split(" ")[0] for field in schema.split(",")]
    # Workers live on and keep the model; another vocabulary under the same path has another name.
    number = hashlib.sha256(Path(path).read_bytes()).hexdigest()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if number not in _BUILT:
            vocabulary, merges, specials = shared.value
            _BUILT.clear()
            _BUILT[number] = Tokenizer(Automaton(vocabulary, merges), specials)
        tokenizer = _BUILT[number]
        for batch in batches:
            rows = [row(tokenizer, d, t) for d, t in zip(batch["doc_id"], batch["text"])]  # noqa: B905
            yield pd.DataFrame(rows, columns=names)

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return narrow.mapInPandas(run, schema)
