"""Alignment of two tokenizers over a corpus, each distinct text once.

Texts are shuffled by themselves; each distinct one is encoded by both tokenizers and
aligned by byte offsets, with its number of copies.  Pair counts are summed with these
numbers, measures are worked out per distinct text, and joined to the documents by digest.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.llm.bpe import byte_characters
from postsieve.llm.common import keyed, stored, text_or_empty
from postsieve.llm.words import Memory, batches, blank_pieces, joinable

# Pairs whose counts are broadcast (17 bytes each); the others are joined.
TABLE_PAIRS = 500_000
# A text with more than this part of all rows is heavy; there are fewer than 1,000.
HEAVY_PART = 1_000

# New pieces that are encoded as one text.
_ROW = 500

# Groups as text with a mark behind each, links (a << 32 | b) as bytes, tokens of A and B.
# False: the tokens do not give the piece back.
Piece = tuple[str, bytes, int, int] | bool


def _numbers(n: int, end: str) -> np.ndarray:
    return np.array([f"{i}{end}" for i in range(n)], dtype=object)


class Aligner:
    """Both tokenizers and what they gave for pieces met before.

    A is a byte-level BPE that starts a word at a blank, B one whose blanks only start
    pieces; so both cut a text at every single blank between words, and the alignment of
    a text is that of its pieces, one after the other.  If B has a piece with a blank
    behind something else, texts are taken whole.
    """

    def __init__(self, a_json: str, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_str(a_json)
        self._a.no_padding()
        self._a.no_truncation()
        self._a.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        byte_of = byte_characters()
        vocabulary = self._a.get_vocab()
        self._a_bytes = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, number in vocabulary.items():
            known = all(c in byte_of for c in token)
            self._a_bytes[number] = bytes(byte_of[c] for c in token) if known else token.encode()
        names = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        self._b_bytes = [
            bytes([int(name[3:5], 16)]) if self._b.is_byte(i) else name.replace("▁", " ").encode()
            for i, name in enumerate(names)
        ]
        self._cuts = not any("▁" in name.lstrip("▁") for name in names)
        self._a_size, self._b_size = np.array([len(t) for t in self._a_bytes]), np.array([len(t) for t in self._b_bytes])
        self._a_more, self._a_last = _numbers(len(self._a_bytes), ","), _numbers(len(self._a_bytes), "|")
        self._b_more, self._b_last = _numbers(len(self._b_bytes), ","), _numbers(len(self._b_bytes), ";")
        self._memory = Memory(self._learn)

    def _learn(self, pieces: list[str]) -> list[Piece]:
        """New pieces are encoded some hundreds in a row, and all of them aligned in one go."""
        single = [p for p in pieces if not joinable(p)]
        rows = [p for p in pieces if joinable(p)]
        order = rows + single
        units = [" ".join(rows[k : k + _ROW]) for k in range(0, len(rows), _ROW)] + single
        a = [row.ids for row in self._a.encode_batch_fast([" " + u for u in units], add_special_tokens=False)]
        b = self._b.encode(units, num_threads=1)
        ends = np.cumsum([len(p.encode()) + 1 for p in order])
        a, b = [i for ids in a for i in ids], [i for ids in b for i in ids]
        whole = "".join([" " + u for u in units]).encode()
        a_bytes, b_bytes = b"".join([self._a_bytes[i] for i in a]), b"".join([self._b_bytes[i] for i in b])
        if a_bytes != whole or b_bytes != whole:
            return list(map(self._learn_one, pieces))
        learned = dict(zip(order, self._align(np.array(a), np.array(b), ends), strict=True))
        return [learned[p] for p in pieces]

    def _learn_one(self, piece: str) -> Piece:
        a = self._a.encode(" " + piece, add_special_tokens=False).ids
        b, want = self._b.encode(piece), (" " + piece).encode()
        if b"".join([self._a_bytes[i] for i in a]) != want or b"".join([self._b_bytes[i] for i in b]) != want:
            return False
        return self._align(np.array(a), np.array(b), np.array([len(want)]))[0]

    def _align(self, a: np.ndarray, b: np.ndarray, ends: np.ndarray) -> list[Piece]:
        """The pieces that end at the bytes ``ends``, from the tokens of all of them.

        Every stretch between neighbouring ends of any of the two lies in one token of each
        and is one link; where both end, a group ends.
        """
        end_a, end_b = np.cumsum(self._a_size[a]), np.cumsum(self._b_size[b])
        cuts = np.union1d(end_a, end_b)
        links = a[np.searchsorted(end_a, cuts)] << 32 | b[np.searchsorted(end_b, cuts)]
        groups = np.intersect1d(end_a, end_b, assume_unique=True)
        # The ids as text in the order of the result: of each group those of A, then those of B.
        group_a, group_b = np.searchsorted(groups, end_a), np.searchsorted(groups, end_b)
        before_a = np.searchsorted(group_b, group_a)  # B ids of earlier groups
        before_b = np.searchsorted(group_a, group_b, side="right")
        text = np.empty(len(a) + len(b), dtype=object)
        last_a, last_b = groups[group_a] == end_a, groups[group_b] == end_b
        text[np.arange(len(a)) + before_a] = np.where(last_a, self._a_last[a], self._a_more[a])
        text[np.arange(len(b)) + before_b] = np.where(last_b, self._b_last[b], self._b_more[b])
        to_a, to_b = np.searchsorted(end_a, ends, side="right"), np.searchsorted(end_b, ends, side="right")
        to_link = (8 * np.searchsorted(cuts, ends, side="right")).tolist()
        words, data = text.tolist(), links.astype(np.int64).tobytes()
        out: list[Piece] = []
        i = j = at = 0
        for next_i, next_j, next_at in zip(to_a.tolist(), to_b.tolist(), to_link, strict=True):
            out.append(("".join(words[i + j : next_i + next_j]), data[at:next_at], next_i - i, next_j - j))
            i, j, at = next_i, next_j, next_at
        return out

    def align_all(self, texts: list[str]) -> Iterator[tuple[str, np.ndarray, int, int]]:
        """Per text its groups, links, and numbers of tokens; a text that the tokens do not give back has none."""
        for some in batches(texts):
            pieces = [(blank_pieces(text) if self._cuts else [text]) if text else [] for text in some]
            found = self._memory.of([p for of_text in pieces for p in of_text])
            at = 0
            for of_text in pieces:
                own = found[at : at + len(of_text)]
                at += len(of_text)
                if not own or False in own:
                    yield "", np.zeros(0, dtype=np.int64), 0, 0
                    continue
                groups, links, a, b = zip(*own, strict=True)
                yield "".join(groups)[:-1], np.frombuffer(b"".join(links), dtype=np.int64), sum(a), sum(b)


_ALIGNERS: dict[str, Aligner] = {}

_MEASURES = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def aligned_texts(docs: DataFrame, a_path: str, b_path: str, keep_groups: bool = False) -> DataFrame:
    """Per distinct text: digest, copies, measures, its different pairs and how often it links them.

    ``keep_groups`` adds the groups as text.  The tokenizers' files, bounded by their vocabularies,
    are read here and broadcast.  A NULL text counts as an empty one.
    """
    with open(a_path, encoding="utf-8") as a_file, open(b_path, "rb") as b_file:
        shared = docs.sparkSession.sparkContext.broadcast((a_file.read(), b_file.read()))
    name = uuid.uuid4().hex
    last = "groups string" if keep_groups else ""
    schema = f"digest binary, copies long, {_MEASURES}, pairs array<long>, times array<int>" + (", " + last if last else "")
    types = [pa.binary(), pa.int64(), *[pa.int64()] * 4, pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.string()]
    names = [field.split()[0] for field in schema.split(", ")]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _ALIGNERS:
            _ALIGNERS.clear()
            _ALIGNERS[name] = Aligner(*shared.value)
        aligner = _ALIGNERS[name]
        for batch in parts:
            rows = []
            aligned = aligner.align_all(batch.column("text").to_pylist())
            for digest, copies, of_text in zip(batch.column("digest"), batch.column("copies"), aligned, strict=True):
                groups, links, n_a, n_b = of_text
                pairs, times = np.unique(links, return_counts=True)
                sha = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
                n_groups = groups.count("|")
                row = (digest.as_py(), copies.as_py(), n_a, n_b, n_groups, len(links), sha, pairs, times.astype(np.int32), groups)
                rows.append(row[: len(names)])
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=names  # noqa: B905
            )

    texts = docs.select(text_or_empty().alias("text")).groupBy("text").agg(F.count("*").alias("copies"))
    return texts.select(_digest().alias("digest"), "copies", "text").mapInArrow(run, schema)


def _digest():
    return F.unhex(F.sha2(F.col("text"), 256))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """Per linked pair: its links over all documents, and whether no pair of its B id has more."""
    links = aligned.select("copies", F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    counts = links.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum(F.col("p.times") * F.col("copies")).alias("count"))
    counts = stored(counts.withColumn("b_id", F.col("pair").bitwiseAND((1 << 32) - 1)))
    # One row per B id: bounded by the vocabulary.
    highest = counts.groupBy("b_id").agg(F.max("count").alias("highest"))
    return counts.join(F.broadcast(highest), "b_id").select(
        "pair", F.shiftright("pair", 32).alias("a_id"), "b_id", "count", (F.col("count") == F.col("highest")).alias("best")
    )


def _frequent(counts: DataFrame, most: int) -> int:
    """The least count from which at most ``most`` pairs have it, by steps of an eighth of an octave."""
    step = F.floor(F.log2(F.col("count")) * 8)
    steps = counts.groupBy(step.alias("step")).agg(F.count("*").alias("n"), F.min("count").alias("least")).collect()
    total, least = 0, 1 << 62
    for row in sorted(steps, key=lambda row: -row.step):
        total += row.n
        if total > most:
            break
        least = row.least
    return least


def _measured(aligned: DataFrame, counts: DataFrame, most: int) -> DataFrame:
    """Measures per distinct text, with n_best and count_sum.

    The frequent pairs come by broadcast; what a text has besides goes through a join,
    whose keys are rare pairs.
    """
    least = _frequent(counts, most)
    often = counts.where(F.col("count") >= least).select("pair", "count", "best").toArrow()
    table = [often.column(c).to_numpy() for c in ("pair", "count", "best")]
    order = np.argsort(table[0])
    shared = counts.sparkSession.sparkContext.broadcast([column[order] for column in table])
    names = ["digest", "copies", *[f.split()[0] for f in _MEASURES.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, count, best = shared.value
        for batch in batches:
            lists, ends = batch.column("pairs"), np.cumsum([len(p) for p in batch.column("pairs")], dtype=np.int64)
            pairs = lists.flatten().to_numpy(zero_copy_only=False)
            times = batch.column("times").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
            known = keys[at] == pairs if len(keys) else np.zeros(len(pairs), dtype=bool)
            got, of = np.where(known, count[at] if len(keys) else 0, 0), np.where(known, best[at] if len(keys) else False, False)

            def per_row(values: np.ndarray, ends: np.ndarray = ends) -> np.ndarray:
                sums = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))[np.concatenate(([0], ends))]
                return np.diff(sums)

            rare = per_row(~known)
            offsets = pa.array(np.concatenate(([0], np.cumsum(rare))).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in names],
                    pa.array(per_row(times * of)),
                    pa.array(per_row(times * got)),
                    pa.ListArray.from_arrays(offsets, pa.array(pairs[~known])),
                    pa.ListArray.from_arrays(offsets, pa.array(times[~known])),
                ],
                names=[*names, "n_best", "count_sum", "rare", "rare_times"],
            )

    schema = f"digest binary, copies long, {_MEASURES}, n_best long, count_sum long, rare array<long>, rare_times array<long>"
    part = stored(aligned.mapInArrow(run, schema))
    seldom = counts.where(F.col("count") < least).select("pair", "count", "best")
    left = part.select("digest", F.explode(F.arrays_zip("rare", "rare_times")).alias("p"))
    left = left.select("digest", F.col("p.rare").alias("pair"), F.col("p.rare_times").alias("times"))
    more = left.join(seldom, "pair").groupBy("digest").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("times") * F.col("count")).alias("more_sum"),
    )
    zero = F.lit(0).cast("long")
    return part.drop("rare", "rare_times").join(more, "digest", "left").select(
        *names,
        (F.col("n_best") + F.coalesce("more_best", zero)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", zero)).alias("count_sum"),
    )


RESULT = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "copies"]


def alignment_report(docs: DataFrame, a_path: str, b_path: str, table_pairs: int = TABLE_PAIRS) -> DataFrame:
    """Per document: numbers of tokens, groups and links, how many of its links are the best of their
    B id, the sum of its links' counts, the digest of its groups, and the rows that have its text.

    A text that is NULL, empty or not given back by the tokens has zeros and an empty
    digest.  Repeated rows each get their row; rows without doc_id, too.  An empty table gives none.
    """
    docs = keyed(docs, "doc_id", "text")
    aligned = stored(aligned_texts(docs, a_path, b_path))
    counts = stored(pair_counts(aligned))
    measures = stored(_measured(aligned, counts, table_pairs))
    total = measures.agg(F.sum("copies").alias("n")).first().n or 0
    return _joined(docs, measures, total)


def _joined(docs: DataFrame, measures: DataFrame, total: int) -> DataFrame:
    """Measures of each document by the digest of its text.

    The few texts with more than a thousandth of all rows come by broadcast; their documents
    take no common key to the other join.
    """
    heavy = F.col("copies") * HEAVY_PART > F.lit(total)
    first = measures.where(heavy).select(F.col("digest").alias("h_digest"), F.struct(*RESULT).alias("h"))
    second = measures.where(~heavy).select(F.col("digest").alias("key"), F.struct(*RESULT).alias("m"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _digest_of_rows().alias("digest"))
    rows = rows.join(F.broadcast(first), F.col("digest") == F.col("h_digest"), "left")
    apart = F.concat(F.col("digest"), F.unhex(F.hex(F.xxhash64("doc_id"))))
    rows = rows.withColumn("key", F.when(F.col("h").isNull(), F.col("digest")).otherwise(apart))
    rows = rows.join(second, "key", "left")
    return rows.select("doc_id", *[F.coalesce(F.col(f"h.{c}"), F.col(f"m.{c}")).alias(c) for c in RESULT])


def _digest_of_rows():
    return F.unhex(F.sha2(text_or_empty(), 256))


def translation(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per B id the A ids it is linked with most, over all documents: (b_id, a_id, count)."""
    counts = pair_counts(stored(aligned_texts(docs, a_path, b_path)))
    return counts.where("best").select("b_id", "a_id", "count")
