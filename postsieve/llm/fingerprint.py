"""Document fingerprints by a homomorphic multiset hash.

A text is the multiset of its paragraphs.  Each paragraph becomes one wide vector,
and the fingerprint is their sum: equal for any order of the paragraphs, and a
paragraph is put in or taken out by adding or subtracting its vector.

* 16 lanes modulo 2**32 come from a digest of the paragraph; they tell texts apart.
* 256 lanes modulo 2**32 count the paragraph's pieces (windows of 16 characters, or all
  of a shorter paragraph), each with a sign on one lane by its hash.  The product of
  two such sums estimates how much two texts share.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.llm.common import mix64, text_or_empty

WIDE, NEAR, WINDOW = 16, 256, 16
BUCKETS_PER_PARTITION = 4
_BEFORE_ALL = -(2**63)


def _piece_counts(pieces: np.ndarray) -> np.ndarray:
    """Signed counts on the lanes: eight bits of a hash choose the lane, one the sign."""
    counts = np.bincount((pieces >> np.uint64(55)).astype(np.int64), minlength=2 * NEAR)
    return counts[:NEAR] - counts[NEAR:]


class Fingerprint:
    """A sum of paragraph vectors."""

    def __init__(self, wide: np.ndarray | None = None, near: np.ndarray | None = None):
        self.wide = np.zeros(WIDE, dtype=np.uint32) if wide is None else wide
        self.near = np.zeros(NEAR, dtype=np.uint32) if near is None else near

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.wide + other.wide, self.near + other.near)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.wide - other.wide, self.near - other.near)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Fingerprint) and self.key() == other.key()

    __hash__ = None

    def key(self) -> bytes:
        return self.wide.astype("<u4").tobytes() + self.near.astype("<u4").tobytes()

    def text(self) -> str:
        return base64.b64encode(self.key()).decode("ascii")

    def likeness(self, other: Fingerprint) -> float:
        """1 for equal fingerprints, else the estimated cosine of the pieces, 0 to 1."""
        if self == other:
            return 1.0
        a, b = self.near.view(np.int32).astype(np.float64), other.near.view(np.int32).astype(np.float64)
        size = np.sqrt((a @ a) * (b @ b))
        return float(min(1.0, max(0.0, a @ b / size))) if size else 0.0


def fingerprint(text: str) -> Fingerprint:
    """The sum over the paragraphs of a whole text; paragraphs end at ``\\n``."""
    raw = text.encode("utf-8", "surrogatepass")
    digests = b"".join([hashlib.blake2b(p, digest_size=4 * WIDE).digest() for p in raw.split(b"\n")])
    lanes = np.frombuffer(digests, dtype="<u4").reshape(-1, WIDE)
    wide = lanes.sum(axis=0, dtype=np.uint32)

    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    breaks = np.concatenate(([-1], np.flatnonzero(codes == 10), [len(codes)]))
    # A paragraph shorter than a window is one piece, known by its digest.
    short = np.flatnonzero(np.diff(breaks) - 1 < WINDOW)
    near = _piece_counts(mix64(lanes[short, 0].astype(np.uint64) << np.uint64(32) | lanes[short, 1]))
    if len(codes) >= WINDOW:
        hashes, width = codes.astype(np.uint64), 1
        while width < WINDOW:
            hashes = mix64(hashes[:-width] * np.uint64(0x9E3779B97F4A7C15) + hashes[width:])
            width *= 2
        inside = np.zeros(len(codes) + 1, dtype=np.int64)
        np.cumsum(codes == 10, out=inside[1:])
        near = near + _piece_counts(hashes[inside[WINDOW:] == inside[:-WINDOW]])
    return Fingerprint(wide, near.astype(np.int64).astype(np.uint32))


def edited(text: str, following: str) -> str:
    """``text`` with its last half, rounded down, replaced by as much of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def _report(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows stream by in order; each document waits for the one behind it."""
    waiting = None
    for batch in batches:
        out = []
        for bucket, borrowed, doc_id, missing, text in batch.itertuples(index=False):
            if borrowed and (waiting is None or waiting[0] != bucket):
                continue  # only the first document of the next bucket is needed
            own = (bucket, None if missing else doc_id, text, fingerprint(text))
            if waiting is not None and waiting[0] == bucket:
                _, at, before, mark = waiting
                changed = edited(before, text)
                mark_changed = fingerprint(changed)
                digest = hashlib.sha256(changed.encode("utf-8")).hexdigest()
                near = (mark.likeness(mark_changed), mark.likeness(own[3]))
                out.append((at, len(before), digest, mark.text(), mark_changed.text(), *near))
            waiting = None if borrowed else own
        frame = pd.DataFrame(out, columns=_COLUMNS)
        yield frame.astype({"doc_id": "Int64", "n_chars": "int64"})


def neighbours(docs: DataFrame) -> DataFrame:
    """(bucket, borrowed, doc_id, missing, text), each bucket a run of ids in order.

    Bounds between buckets are ids that occur, so the first document of a bucket is
    known; it also goes, as ``borrowed``, behind the bucket before it.  One shuffle.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_BEFORE_ALL)).alias("doc_id"),
        F.col("doc_id").isNull().alias("missing"),
        text_or_empty().alias("text"),
    )
    count = BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [k / count for k in range(count)]
    bounds = rows.agg(
        F.min("doc_id").alias("first"), F.percentile_approx("doc_id", shares, 20 * count).alias("bounds")
    ).first()
    starts = sorted({bounds["first"], *(bounds["bounds"] or [])} - {None})
    shared = spark.sparkContext.broadcast(np.array(starts, dtype=np.int64))

    def place(ids: pd.Series) -> pd.DataFrame:
        values, own = ids.to_numpy(dtype=np.int64), shared.value
        bucket = np.searchsorted(own, values, side="right") - 1
        lent = np.where(own[bucket] == values, (bucket - 1) % max(1, len(own)), -1)
        return pd.DataFrame({"bucket": bucket.astype(np.int32), "lent": lent.astype(np.int32)})

    placed = rows.withColumn("place", F.pandas_udf(place, "bucket int, lent int")(F.col("doc_id")))
    places = F.expr(
        "filter(array(struct(place.bucket AS bucket, false AS borrowed), struct(place.lent AS bucket, true AS borrowed)),"
        " x -> x.bucket >= 0)"
    )
    dealt = placed.select(F.explode(places).alias("at"), "doc_id", "missing", "text")
    return (
        dealt.select("at.bucket", "at.borrowed", "doc_id", "missing", "text")
        .repartition("bucket")
        .sortWithinPartitions("bucket", "borrowed", "doc_id", "text")
    )


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and likenesses.

    The next document is the one with the next doc_id (ties by text, NULL ids first;
    after the last comes the first, so a single document follows itself).  A NULL
    text is an empty one.  Repeated rows each get their row.
    """
    return neighbours(docs).mapInPandas(_report, _SCHEMA)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` with the fingerprint of each text, where it is read; no shuffle."""
    mark = F.pandas_udf(lambda texts: texts.map(lambda t: fingerprint(t or "").text()), "string")
    return docs.withColumn("fingerprint", mark(text_or_empty()))
