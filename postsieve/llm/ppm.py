"""Language-model scores by prediction by partial matching.

Contexts are bytes, up to order 3.  Counts of all training texts make the trie;
a byte not seen in a context escapes to the next shorter one, where the symbols of the
longer context are excluded, and finally to the bytes never seen.  Escapes take the
number of different symbols as their count.  As the trie is fixed when texts are scored,
escapes and exclusions are worked out once per context: each row of a table is the
whole distribution behind a context, and scoring reads one cell per byte.
"""

from __future__ import annotations

import struct
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.llm.common import crc_mod, stored, text_or_empty

START = b"\n\n\n"  # the context in front of a text
END = 255  # the symbol behind a text; no byte of UTF-8
# Memory bound of the trie in the workers: the most frequent contexts of order 3 are in its
# table, all others are joined.  Orders 0 to 2 have at most 2**24 cells and are complete.
MAX_CONTEXTS = 1 << 16
HEAVY_WORDS, HEAVY_BYTES = 150_000, 64
_WORD_END = b"\n"  # stands for the end token; no word holds it
_CONTEXT = b"\t"  # in front of a context among words; no word holds it either
_FLUSH_GRAMS, _FLUSH_WORDS = 1 << 22, 300_000

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def grams(text: bytes) -> np.ndarray:
    """The four-byte numbers (context, symbol) of a text, with its end."""
    data = np.frombuffer(START + text + bytes([END]), dtype=np.uint8).astype(np.uint32)
    return data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]


def words(text: bytes) -> Counter:
    """Counts of the tokens: words between ASCII white space, with A-Z lower-cased, and the end."""
    out = Counter(text.translate(_FOLD).split())
    out[_WORD_END] += 1
    return out


def corpus_counts(training: DataFrame) -> DataFrame:
    """(gram, word, n) over all texts: one of the two is NULL."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting, size, tokens = [], 0, Counter()

        def gram_rows() -> pd.DataFrame:
            keys, n = np.unique(np.concatenate(waiting), return_counts=True)
            return pd.DataFrame({"gram": keys.astype(np.int64), "word": None, "n": n.astype(np.int64)})

        def word_rows() -> pd.DataFrame:
            return pd.DataFrame({"gram": pd.array([None] * len(tokens), "Int64"), "word": list(tokens), "n": list(tokens.values())})

        for batch in batches:
            for text in batch["text"]:
                raw = text.encode("utf-8", "surrogatepass")
                tokens.update(words(raw))
                waiting.append(grams(raw))
                size += len(waiting[-1])
                if size > _FLUSH_GRAMS:
                    yield gram_rows()
                    waiting, size = [], 0
                if len(tokens) > _FLUSH_WORDS:
                    yield word_rows()
                    tokens = Counter()
        if waiting:
            yield gram_rows()
        if tokens:
            yield word_rows()

    rows = training.select("text").mapInPandas(count, "gram long, word binary, n long")
    return rows.groupBy("gram", "word").agg(F.sum("n").alias("n"))


def frequent(tokens: DataFrame, words: int) -> DataFrame:
    """The words of at most ``HEAVY_BYTES`` whose count so few words reach that they are at most ``words``."""
    short = tokens.where(F.octet_length("word") <= HEAVY_BYTES)
    # Words by the octave of their count, so that only a few sums come back.
    octaves = short.groupBy(F.floor(F.log2("c") * 16).alias("octave")).agg(F.count("*").alias("words"))
    least, room = None, words
    for row in octaves.orderBy(F.desc("octave")).collect():
        room -= row["words"]
        if room < 0:
            break
        least = row["octave"]
    return short.where(F.lit(False) if least is None else F.floor(F.log2("c") * 16) >= least)


class Trie:
    """Counts of contexts, turned into one table of log10 probabilities."""

    def __init__(self, grams3: tuple[np.ndarray, np.ndarray], grams2: tuple[np.ndarray, np.ndarray], whole: bool = True):
        """``grams3``: (context of three bytes, symbol) and counts; ``grams2`` likewise for two.

        Unless ``whole``, there may be contexts of three bytes besides those of ``grams3``.
        """
        keys2, n2 = grams2
        order1 = np.zeros((256, 256), dtype=np.float64)
        np.add.at(order1, ((keys2 >> 8) & 255, keys2 & 255), n2)
        order0 = order1.sum(axis=0)
        rows0 = self._lowest(order0)[None, :]
        seen1 = np.flatnonzero(order1.any(axis=1))
        rows1 = self._rows(order1[seen1], np.broadcast_to(order0, (len(seen1), 256)), np.broadcast_to(rows0, (len(seen1), 256)))
        at1 = np.zeros(256, dtype=np.int32)
        at1[seen1] = 1 + np.arange(len(seen1))
        table = [rows0, rows1]
        contexts2, dense = self._dense(keys2, n2)
        all1 = np.concatenate(table)
        below = contexts2 & 255
        rows2 = self._rows(dense, order1[below], all1[at1[below]])
        # Rows of order-2 contexts; those not seen use their order-1 row.
        at2 = np.tile(at1, 256)
        at2[contexts2] = len(all1) + np.arange(len(contexts2))
        counts2 = dense
        place2 = np.zeros(65536, dtype=np.int64)
        place2[contexts2] = np.arange(len(contexts2))
        keys3, n3 = grams3
        contexts3, dense = self._dense(keys3, n3)
        below = contexts3 & 0xFFFF
        rows3 = self._rows(dense, counts2[place2[below]], rows2[place2[below]])
        self.row_of = np.tile(at2, 256)
        self.row_of[contexts3] = len(all1) + len(rows2) + np.arange(len(contexts3))
        self.table = np.log10(np.concatenate((all1, rows2, rows3))).astype(np.float32).ravel()
        # Where order-3 contexts may be missing: those, and the order-2 cells that were seen.
        self.missing = None
        if not whole:
            held = np.zeros(65536, dtype=bool)
            held[contexts2] = True
            self.missing = np.tile(held, 256)
            self.missing[contexts3] = False
            self.first2 = len(all1)
            self.seen2 = (counts2 > 0).ravel()

    @staticmethod
    def _dense(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        contexts, place = np.unique(keys >> 8, return_inverse=True)
        out = np.zeros((len(contexts), 256), dtype=np.float32)
        out[place, keys & 255] = n
        return contexts, out

    @staticmethod
    def _lowest(counts: np.ndarray) -> np.ndarray:
        total, kinds = counts.sum(), np.count_nonzero(counts)
        if kinds == 256 or kinds == 0:
            return counts / total if kinds else np.full(256, 1 / 256)
        out = counts / (total + kinds)
        out[counts == 0] = kinds / (total + kinds) / (256 - kinds)
        return out

    @staticmethod
    def _rows(counts: np.ndarray, below: np.ndarray, rows_below: np.ndarray, step: int = 2048) -> np.ndarray:
        """Distributions behind contexts, from their counts and those of their suffixes.

        ``rows_below`` are the finished distributions behind the suffixes.  Done in
        steps, as the arrays of doubles are large.
        """
        out = np.empty(counts.shape, dtype=np.float32)
        for at in range(0, len(counts), step):
            n = counts[at : at + step].astype(np.float64)
            m = below[at : at + step].astype(np.float64)
            rows = rows_below[at : at + step].astype(np.float64)
            seen, known = n > 0, m > 0
            total, kinds = n.sum(axis=1, keepdims=True), seen.sum(axis=1, keepdims=True)
            escape = kinds / (total + kinds)
            # One level down only what the context itself has not seen counts.
            rest = np.where(seen, 0.0, m)
            rest_total, rest_kinds = rest.sum(axis=1, keepdims=True), (rest > 0).sum(axis=1, keepdims=True)
            size = np.maximum(rest_total + rest_kinds, 1)
            further = np.where(rest_kinds > 0, rest_kinds / size, 1.0)
            kinds_below = known.sum(axis=1, keepdims=True)
            escape_below = kinds_below / np.maximum(m.sum(axis=1, keepdims=True) + kinds_below, 1)
            tail = escape * further * rows / np.where(escape_below > 0, escape_below, 1)
            lower = np.where(known, escape * rest / size, tail)
            out[at : at + step] = np.where(seen, n / (total + kinds), lower)
        return out

    def score(self, text: bytes) -> float:
        """log10 of the probability of a text and its end."""
        found = grams(text)
        return float(self.table[self.row_of[found >> 8].astype(np.int64) * 256 + (found & 255)].sum(dtype=np.float64))

    def elsewhere(self, text: bytes) -> pd.DataFrame | None:
        """The grams whose order-3 context may be missing, with their number, whether order 2 has seen them, and its score."""
        found = grams(text)
        if self.missing is None or not len(found := found[self.missing[found >> 8]]):
            return None
        keys, times = np.unique(found, return_counts=True)
        cells = self.row_of[keys >> 8].astype(np.int64) * 256 + (keys & 255)
        return pd.DataFrame(
            {
                "word": [_CONTEXT + struct.pack(">I", c) for c in (keys >> 8).tolist()],
                "tf": times,
                "symbol": (keys & 255).astype(np.int32),
                "seen2": self.seen2[cells - self.first2 * 256],
                "low": self.table[cells].astype(np.float64),
            }
        )


def _collected(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    frame = rows.toPandas()
    return frame["gram"].to_numpy(dtype=np.int64), frame["n"].to_numpy(dtype=np.float64)


def collect_trie(counts: DataFrame, max_contexts: int = MAX_CONTEXTS) -> tuple[tuple, DataFrame | None]:
    """What a ``Trie`` takes, with the order-3 cells of the most frequent contexts, and ``rare_contexts`` of the others."""
    cells = counts.where("gram IS NOT NULL").select("gram", "n", F.expr("shiftright(gram, 8)").alias("context"))
    kept = cells.groupBy("context").agg(F.sum("n").alias("total"))
    kept = stored(kept.orderBy(F.desc("total"), "context").limit(max_contexts).select("context"))
    order3 = cells.join(F.broadcast(kept), "context", "left_semi").select("gram", "n")
    order2 = cells.groupBy((F.col("gram").bitwiseAND(F.lit(0xFFFFFF))).alias("gram")).agg(F.sum("n").alias("n"))
    whole = kept.count() < max_contexts
    others = None if whole else rare_contexts(cells.join(F.broadcast(kept), "context", "left_anti"), order2)
    return (_collected(order3), _collected(order2), whole), others


def rare_contexts(cells: DataFrame, order2: DataFrame) -> DataFrame:
    """(context, symbols, known, unknown) of the order-3 ``cells`` (gram, n, context), for a join.

    ``symbols`` maps what the context has seen to its log10 probability.  ``known`` and
    ``unknown`` are added to the order-2 score of other symbols, those that order 2 has
    seen and those it has not; see ``Trie._rows``.
    """
    suffix = F.expr("shiftright(gram, 8)")
    totals = order2.groupBy(suffix.alias("suffix")).agg(
        F.sum("n").cast("double").alias("total2"), F.count("*").cast("double").alias("kinds2")
    )
    below = order2.select(F.col("gram").alias("short"), F.col("n").alias("m"))
    own = (
        cells.withColumn("short", F.col("gram").bitwiseAND(F.lit(0xFFFFFF)))
        .join(below, "short")
        .groupBy("context")
        .agg(
            F.sum("n").cast("double").alias("total"),
            F.count("*").cast("double").alias("kinds"),
            F.sum("m").cast("double").alias("shared"),
            F.collect_list(F.struct(F.col("gram").bitwiseAND(F.lit(255)).cast("int").alias("symbol"), "n")).alias("seen"),
        )
        .withColumn("suffix", F.col("context").bitwiseAND(F.lit(0xFFFF)))
        .join(totals, "suffix")
    )
    size = F.col("total") + F.col("kinds")
    escape = F.col("kinds") / size
    rest_kinds = F.col("kinds2") - F.col("kinds")
    rest = F.col("total2") - F.col("shared") + rest_kinds
    all2 = F.col("total2") + F.col("kinds2")
    # Nothing of order 2 is left where the context has seen all of it.
    further = F.when(rest_kinds > 0, rest_kinds / rest).otherwise(1.0)
    log = F.transform("seen", lambda s: F.struct(s["symbol"], F.log10(s["n"] / size)))
    return own.select(
        "context",
        F.map_from_entries(log).alias("symbols"),
        F.when(rest_kinds > 0, F.log10(escape * all2 / rest)).alias("known"),
        F.log10(escape * further * all2 / F.col("kinds2")).alias("unknown"),
    )


_MODELS: dict[str, tuple] = {}


def score_documents(docs: DataFrame, held_out: int = 10, max_contexts: int = MAX_CONTEXTS) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows whose crc32(doc_id) modulo ``held_out`` is not 0.  Words are
    looked up in two exact ways: the most frequent ones, bounded in number and
    length, in a broadcast table; all others by a join on the word.  So are contexts of
    order 3: ``max_contexts`` of them in the broadcast trie, the others in the join.  NULL and empty
    texts consist of their end.  Rows without id are scored but teach nothing;
    repeated rows count as often as they occur and each get their row.
    """
    spark = docs.sparkSession
    fold = crc_mod(F.col("doc_id"), held_out)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"), fold.alias("fold"))
    counts = stored(corpus_counts(rows.where("fold <> 0")))
    tokens = counts.where("word IS NOT NULL").select("word", F.col("n").alias("c"))
    total, distinct = tokens.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    heavy = frequent(tokens, HEAVY_WORDS).toPandas()
    logs = dict(zip(map(bytes, heavy["word"]), np.log10(heavy["c"].to_numpy(dtype=np.float64) + 0.1), strict=True))
    model, others = collect_trie(counts, max_contexts)
    shared = spark.sparkContext.broadcast((model, logs))
    number = uuid.uuid4().hex  # names this model in workers that live on

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if number not in _MODELS:
            model, table = shared.value
            _MODELS.clear()
            _MODELS[number] = (Trie(*model), table)
        trie, table = _MODELS[number]
        blank = {"doc_id": pd.NA, "held_out": False, "n_tokens": 0, "n_known": 0, "base": 0.0, "score": 0.0}
        no_gram = {"symbol": pd.NA, "seen2": False, "low": 0.0}
        kinds = {"doc_id": "Int64", "symbol": "Int32"}
        for batch in batches:
            whole = {c: [] for c in ("row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score")}
            rare = {c: [] for c in ("row", "word", "tf")}
            contexts = []
            for row, doc_id, fold_of, text in zip(batch["row"], batch["doc_id"], batch["fold"], batch["text"]):  # noqa: B905
                raw = text.encode("utf-8", "surrogatepass")
                own = words(raw)
                base, known = 0.0, 0
                for word, n in own.items():
                    log = table.get(word)
                    if log is None:
                        rare["row"].append(row)
                        rare["word"].append(word)
                        rare["tf"].append(n)
                    else:
                        base += n * log
                        known += n
                values = (row, doc_id, fold_of == 0, sum(own.values()), known, base, trie.score(raw))
                for column, value in zip(whole.values(), values, strict=True):
                    column.append(value)
                missing = trie.elsewhere(raw)
                if missing is not None:
                    contexts.append(missing.assign(row=row))
            if whole["row"]:
                # A word that no text can hold, another one for each row, so that the join deals
                # these rows out evenly and finds nothing for them.
                none = [_WORD_END + struct.pack("<q", row) for row in whole["row"]]
                yield pd.DataFrame(whole).assign(word=none, tf=0, **no_gram).astype(kinds)
            if rare["row"]:
                yield pd.DataFrame(rare).assign(**blank, **no_gram)[[*whole, "word", "tf", *no_gram]].astype(kinds)
            if contexts:
                rows = pd.concat(contexts, ignore_index=True).assign(**blank)
                yield rows[[*whole, "word", "tf", *no_gram]].astype(kinds)

    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    schema = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, word binary, tf long"
    schema += ", symbol int, seen2 boolean, low double"
    scored = numbered.mapInPandas(score, schema)
    light = tokens.withColumnRenamed("word", "known_word")
    if others is not None:
        key = F.concat(F.lit(bytearray(_CONTEXT)), F.unhex(F.lpad(F.hex("context"), 8, "0")))
        light = light.unionByName(others.withColumn("known_word", key).drop("context"), allowMissingColumns=True)
    joined = scored.join(light, scored["word"] == light["known_word"], "left")
    found = F.when(F.col("c").isNotNull(), F.col("tf")).otherwise(F.lit(0))
    of_word = F.col("tf") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.1))
    term = F.col("base") + F.when(F.col("symbol").isNull(), of_word).otherwise(0.0)
    byte_term = F.col("score")
    if others is not None:
        lower = F.col("low") + F.when(F.col("seen2"), F.col("known")).otherwise(F.col("unknown"))
        log = F.coalesce(F.try_element_at("symbols", F.col("symbol")), lower)
        byte_term += F.when(F.col("symbols").isNotNull(), F.col("tf") * (log - F.col("low"))).otherwise(0.0)
    scale = float(np.log10(total + 0.1 * (distinct + 1)))
    return (
        joined.groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("held_out").alias("held_out"),
            F.sum("n_tokens").alias("n_tokens"),
            F.sum(F.col("n_known") + found).alias("n_known"),
            F.sum(term).alias("base"),
            F.sum(byte_term).alias("score"),
        )
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            "n_known",
            F.lit(int(total)).cast("long").alias("train_tokens"),
            (F.col("base") - F.col("n_tokens") * F.lit(scale)).alias("base_score"),
            "score",
        )
    )
