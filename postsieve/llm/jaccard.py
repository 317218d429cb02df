"""N-gram Jaccard join with Bayesian pruning of candidates.

1. Each text becomes its set of five-word shingles (hashes), a digest of the set and 160
   MinHash values.  Texts with the same set are one node from here on.
2. Nodes that share a band of five values are compared in blocks of a bucket: value by
   value in steps, and a pair goes as soon as the posterior probability that it
   reaches the threshold, given the matches so far, is below a tolerance.  Pairs that
   stay only name groups; no pair leaves the task.
3. Inside each group the shingle sets are compared exactly, again in blocks.  Links are
   counted per document and joined into classes.

A group of m nodes is m / BLOCK blocks, and every two blocks are one task's work, so no
task holds an unbounded group.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.llm.common import Rolling, mix64, small, stored, text_or_empty
from postsieve.llm.components import components

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 5
VALUES = BANDS * ROWS
STEP = 32  # values compared before the next look at the posterior
TOLERANCE = 1e-5
BLOCK = 256
BROADCAST_ROWS = 500_000
_CELLS = 1 << 23  # of a dense block of shingle incidences

_ROLLING = Rolling()
_DRAWS = np.random.default_rng(11).integers(0, 2**32, (2, VALUES), dtype=np.uint64).astype(np.uint32)
_FACTORS, _SHIFTS = _DRAWS[0] | np.uint32(1), _DRAWS[1]


def shingles(text: str, size: int = WORDS) -> np.ndarray:
    """The sorted hashes of all runs of ``size`` words; of all words, if there are fewer.

    Words are what white space separates, in lower case.  Empty without words.
    """
    words = text.lower().encode("utf-8", "surrogatepass").split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    line = b" ".join(words) + b" "
    sums = _ROLLING.sums(line)
    ends = np.flatnonzero(np.frombuffer(line, dtype=np.uint8) == 32)
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(size, len(words))
    return np.unique(_ROLLING.slices(sums, starts[: len(words) - size + 1], ends[size - 1 :]))


def minhash(hashes: np.ndarray) -> np.ndarray:
    """The least value of every permutation over a set of hashes."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)[:, None]
    out = np.full(VALUES, 2**32 - 1, dtype=np.uint32)
    for at in range(0, len(x), 4096):
        np.minimum(out, (x[at : at + 4096] * _FACTORS + _SHIFTS).min(axis=0), out=out)
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of MinHash values; the band's number is part of it."""
    rows = values.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return key.view(np.int64)


@cache
def least_matches(threshold: float, tolerance: float) -> list[tuple[int, int]]:
    """(values compared, matches needed): below it the posterior is under ``tolerance``.

    The prior of the similarity is uniform.  One byte of each value is compared, so two
    values also match by chance with 1/256.
    """
    grid = (np.arange(2000) + 0.5) / 2000
    match = grid + (1 - grid) / 256
    out = []
    for n in range(STEP, VALUES + 1, STEP):
        for m in range(n + 1):
            log = m * np.log(match) + (n - m) * np.log1p(-match + 1e-15)
            weight = np.exp(log - log.max())
            if weight[grid >= threshold].sum() / weight.sum() >= tolerance:
                out.append((n, m))
                break
    return out


def _prints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = {c: [] for c in ("n", "d1", "d2", "sig", "bands")}
        for text in batch["text"]:
            found = shingles(text)
            out["n"].append(len(found))
            if not len(found):
                for c in ("d1", "d2", "sig", "bands"):
                    out[c].append(None)
                continue
            with np.errstate(over="ignore"):
                d1 = mix64(found).sum(dtype=np.uint64)
                d2 = mix64(found ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64)
            values = minhash(found)
            out["d1"].append(int(d1.view(np.int64)))
            out["d2"].append(int(d2.view(np.int64)))
            out["sig"].append((values & np.uint32(255)).astype(np.uint8).tobytes())
            out["bands"].append(band_keys(values))
        frame = pd.DataFrame({"doc_id": batch["doc_id"], "th": batch["th"], **out})
        yield frame.astype({"doc_id": "Int64", "d1": "Int64", "d2": "Int64"})


def _read(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.select("doc_id", F.xxhash64("text").alias("th"), "text")


def _spread(rows: DataFrame, group: str, size: str) -> DataFrame:
    """Deals the rows of a group into blocks, and each row to every pair of blocks that has its own."""
    blocks = F.ceil(F.col(size) / F.lit(BLOCK)).cast("int")
    own = rows.withColumn("own", F.pmod(F.xxhash64("node", F.lit(3)), blocks).cast("int"))
    other = own.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return other.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("other", size)


def _lowest_labels(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least position each of ``n`` is connected with."""
    labels = np.arange(n)
    while True:
        low = np.minimum(labels[left], labels[right])
        fresh = labels.copy()
        np.minimum.at(fresh, left, low)
        np.minimum.at(fresh, right, low)
        fresh = fresh[fresh]
        if (fresh == labels).all():
            return labels
        labels = fresh


def _probable_links(batches: Iterator[pd.DataFrame], needed: list[tuple[int, int]]) -> Iterator[pd.DataFrame]:
    """Rows sorted by group: (node, label) of nodes that a pair connects after the pruning."""

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        nodes = frame["node"].to_numpy()
        sig = np.frombuffer(b"".join(frame["sig"]), dtype=np.uint8).reshape(-1, VALUES)
        keys = frame[["key", "i", "j"]].to_numpy()
        group = np.concatenate(([0], np.cumsum((keys[1:] != keys[:-1]).any(axis=1))))
        lefts, rights = [], []
        left = np.arange(len(nodes))
        for apart in range(1, len(nodes)):
            left = left[left < len(nodes) - apart]
            left = left[group[left] == group[left + apart]]
            if not len(left):
                break
            pair = left
            matches = np.zeros(len(pair), dtype=np.int32)
            before = 0
            for n, least in needed:
                matches += (sig[pair, before:n] == sig[pair + apart, before:n]).sum(axis=1, dtype=np.int32)
                stay = matches >= least
                pair, matches, before = pair[stay], matches[stay], n
            lefts.append(pair)
            rights.append(pair + apart)
        if not lefts:
            return pd.DataFrame({"a": nodes[:0], "b": nodes[:0]})
        left, right = np.concatenate(lefts), np.concatenate(rights)
        labels = _lowest_labels(len(nodes), left, right)
        # Where two blocks meet, what a block connects by itself is known from where it
        # meets itself; only the connections between such parts are new.
        own = frame["own"].to_numpy()
        inside = own[left] == own[right]
        parts = _lowest_labels(len(nodes), left[inside], right[inside])
        alone = frame["i"].to_numpy() == frame["j"].to_numpy()
        at = np.arange(len(nodes))
        moved = np.flatnonzero((labels != at) & (alone | (parts == at)))
        return pd.DataFrame({"a": nodes[moved], "b": nodes[labels[moved]]})

    waiting = None
    for batch in _gathered(batches):
        rows = batch if waiting is None else pd.concat([waiting, batch], ignore_index=True)
        last = (rows[["key", "i", "j"]] == rows[["key", "i", "j"]].iloc[-1]).all(axis=1).to_numpy()
        cut = len(rows) - int(last[::-1].argmin()) if not last.all() else 0
        if cut:
            for start, end in _whole_groups(rows.iloc[:cut]):
                yield compare(rows.iloc[start:end].reset_index(drop=True))
        waiting = rows.iloc[cut:].reset_index(drop=True)
    if waiting is not None and len(waiting):
        for start, end in _whole_groups(waiting):
            yield compare(waiting.iloc[start:end].reset_index(drop=True))


def _gathered(batches: Iterator[pd.DataFrame], size: int = 8192) -> Iterator[pd.DataFrame]:
    """The rows of ``batches`` in frames of ``size`` rows or little more; none is empty."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += len(batch)
        if rows >= size:
            yield pd.concat(held, ignore_index=True)
            held, rows = [], 0
    if rows:
        yield pd.concat(held, ignore_index=True)


def _whole_groups(rows: pd.DataFrame, size: int = 8192, pairs: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Ranges of whole groups, of about ``size`` rows and ``pairs`` pairs at most, or one group."""
    keys = rows[["key", "i", "j"]].to_numpy()
    ends = np.append(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, len(rows))
    members = np.diff(ends, prepend=0)
    filled = np.cumsum(np.maximum(members / size, members * (members - 1) / (2 * pairs)))
    at = 0
    while at < len(ends):
        done = filled[at - 1] if at else 0.0
        stop = max(at + 1, int(np.searchsorted(filled, done + 1, side="right")))
        yield int(ends[at] - members[at]), int(ends[stop - 1])
        at = stop


def _exact_links(threshold: float):
    def link(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("node", ignore_index=True)
        sets = [np.frombuffer(s, dtype=np.uint64) for s in frame["hashes"]]
        sizes = np.array([len(s) for s in sets])
        _, place, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(sets)), sizes)
        shared = held[place] > 1
        place, owner = place[shared], owner[shared]
        columns, place = np.unique(place, return_inverse=True)
        common = np.zeros((len(sets), len(sets)), dtype=np.float32)
        width = max(1, min(len(columns), _CELLS // len(sets)))
        order = np.argsort(place, kind="stable")
        place, owner = place[order], owner[order]
        for at in range(0, len(columns), width):
            low, high = np.searchsorted(place, (at, at + width))
            part = np.zeros((len(sets), width), dtype=np.float32)
            part[owner[low:high], place[low:high] - at] = 1
            common += part @ part.T
        union = sizes[:, None] + sizes[None, :] - common
        linked = common >= threshold * union - 1e-6
        np.fill_diagonal(linked, False)
        i, j = int(frame["i"].iloc[0]), int(frame["j"].iloc[0])
        own = frame["own"].to_numpy()
        if i != j:  # pairs inside a block are counted where the block meets itself
            linked &= own[:, None] != own[None, :]
        left, right = np.nonzero(linked)
        labels = _lowest_labels(len(sets), left, right)
        nodes = frame["node"].to_numpy()
        return pd.DataFrame(
            {
                "node": nodes,
                "label": nodes[labels],
                "texts": linked.sum(axis=1).astype(np.int64),
                "links": (linked * frame["copies"].to_numpy()[None, :]).sum(axis=1).astype(np.int64),
            }
        )

    return link


def _checked(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if small(df, BROADCAST_ROWS) else df


def near_duplicates(
    docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, join_wordless: bool = False
) -> DataFrame:
    """Per document: doc_id, th (hash of the text), class_id, n_links, n_similar_texts.

    Two documents are linked if the Jaccard similarity of their shingle sets is at
    least ``threshold`` (0.8 or more).  A class is a connected group; its id is its
    least doc_id.  ``n_links`` counts linked documents, copies included, and
    ``n_similar_texts`` linked texts with another shingle set.  A text without words has
    no shingles, thus no links, and is a class of its own; with ``join_wordless`` all such
    texts, whose shingle sets are equal, are one class.  Every row without doc_id that is
    no copy of another is a class of its own, too.  Rows that repeat a doc_id and its text are separate links of
    one class.
    """
    rows = _read(docs)
    prints = stored(
        rows.mapInPandas(_prints, "doc_id long, th long, n int, d1 long, d2 long, sig binary, bands array<long>")
    )
    nodes = stored(
        prints.where("n > 0")
        .groupBy("d1", "d2")
        .agg(
            F.min("doc_id").alias("rep"),
            F.count("*").alias("copies"),
            F.first("sig").alias("sig"),
            F.first("bands").alias("bands"),
        )
        .select(F.col("d1").alias("node"), "d2", "rep", "copies", "sig", "bands")
    )

    # Buckets of two or more nodes.
    bands = nodes.select("node", F.explode("bands").alias("key"))
    crowded = bands.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = bands.join(crowded, "key").join(nodes.select("node", "sig"), "node")
    needed = least_matches(threshold, tolerance)
    blocks = _spread(members, "key", "size").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "node")
    probable = blocks.select("key", "i", "j", "own", "node", "sig").mapInPandas(
        lambda batches: _probable_links(batches, needed), "a long, b long"
    )
    groups = components(probable)

    # Exact comparison inside each group.
    sizes = groups.groupBy("label").agg(F.count("*").alias("size"))
    wanted = groups.join(sizes, "label").join(nodes.select("node", "d2", "rep", "copies"), "node")
    wanted = stored(wanted)

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.drop(columns="text").assign(hashes=[shingles(t).tobytes() for t in batch["text"]])

    # The least doc_id of a set, and its text; a doc_id that has other texts too is told
    # apart by their hashes.
    holders = (
        prints.join(_checked(wanted.select("node", "d2")), (F.col("d1") == F.col("node")) & (prints["d2"] == wanted["d2"]))
        .groupBy("node")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")).alias("h"))
        .select("node", F.col("h.doc_id").alias("rep"), F.col("h.th").alias("th"))
    )
    wanted_texts = stored(wanted.drop("rep", "d2").join(holders, "node"))
    side = _checked(wanted_texts)
    texts = rows.join(side, rows["doc_id"].eqNullSafe(side["rep"]) & (rows["th"] == side["th"])).select(
        "node", "label", "size", "copies", "text"
    )
    hashed = texts.mapInPandas(sets, "node long, label long, size long, copies long, hashes binary").dropDuplicates(["node"])
    compared = stored(
        _spread(hashed, "label", "size")
        .groupBy("label", "i", "j")
        .applyInPandas(_exact_links(threshold), "node long, label long, texts long, links long")
    )
    counts = compared.groupBy("node").agg(F.sum("texts").alias("texts"), F.sum("links").alias("links"))
    final = components(compared.select(F.col("node").alias("a"), F.col("label").alias("b")))
    classes = final.join(nodes.select("node", "rep"), "node").groupBy("label").agg(F.min("rep").alias("class_rep"))
    linked = final.join(classes, "label").select("node", "class_rep").join(counts, "node")
    info = (
        nodes.select("node", "rep", "copies")
        .join(linked, "node", "left")
        .where("copies > 1 OR class_rep IS NOT NULL")
        .select(
            F.col("node").alias("d1"),
            F.coalesce("class_rep", "rep").alias("class_rep"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
            F.coalesce("texts", F.lit(0)).alias("texts"),
        )
    )
    info = _checked(stored(info))
    alone = F.col("doc_id")
    if join_wordless:
        least = prints.where("n = 0").agg(F.min("doc_id")).first()[0]
        alone = F.when(F.col("n") == 0, F.lit(least).cast("long")).otherwise(alone)
    return prints.select("doc_id", "th", "n", "d1").join(info, "d1", "left").select(
        "doc_id",
        "th",
        F.coalesce(F.col("class_rep"), alone).alias("class_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("texts", F.lit(0)).cast("long").alias("n_similar_texts"),
    )


def near_duplicate_report(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, class_id, n_links, n_similar_texts."""
    return near_duplicates(docs, threshold).drop("th")


def keep_one_per_class(docs: DataFrame, threshold: float = THRESHOLD, join_wordless: bool = False) -> DataFrame:
    """The rows of ``docs`` without those whose class has a smaller doc_id.

    Texts without words all stay, or with ``join_wordless`` one of them.  Rows without doc_id stay; rows that repeat a doc_id are one document and share
    its fate.
    """
    names = list(docs.columns)
    found = near_duplicates(docs, threshold, join_wordless=join_wordless).where("doc_id <> class_id").select(
        F.col("doc_id").alias("_gone"), F.col("th").alias("_th")
    )
    gone = _checked(stored(found.distinct()))
    own = docs.withColumn("_own", F.xxhash64(text_or_empty()))
    kept = own.join(gone, (F.col("doc_id").cast("long") == F.col("_gone")) & (F.col("_own") == F.col("_th")), "left_anti")
    return kept.select(*names)
