"""What several operators share: document keys, stored results, size checks."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import postsieve
from postsieve.session import work_folder

_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared work folder and read again.

    Cuts the lineage: what follows survives the loss of executors without
    doing the work above again, and is the same for every reader.
    """
    path = f"{work_folder(df.sparkSession)}/llm/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()

ARROW_ROWS = 1_000
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def prepare(spark: SparkSession) -> None:
    """Ship the package, and bound the Arrow batches of the session by ``ARROW_ROWS`` rows.

    Every core of an executor holds some batches outside the heap, and again in its
    Python worker; ten thousand whole texts would be most of that.  A smaller bound
    of the session stays.
    """
    ship_package(spark)
    rows = int(spark.conf.get(_ARROW_ROWS))
    if rows <= 0 or rows > ARROW_ROWS:
        spark.conf.set(_ARROW_ROWS, str(ARROW_ROWS))


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, where it is not installed."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        folder = Path(postsieve.__file__).resolve().parents[1]
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/postsieve", "zip", folder, "postsieve")
        context.addPyFile(archive)
        _SHIPPED.add(context.applicationId)


def crc_mod(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """Only ``columns`` of ``docs``, so that further ones cannot clash."""
    return docs.select(*[F.col(name) for name in columns])


def small(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows.

    Meant for stored tables, whose rows are counted from the footers of their files; a
    limit would send rows of every partition through one task.
    """
    return df.count() <= rows


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX_1
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX_2
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of many slices of one byte string, from running sums.

    ``hash(s, e)`` is the polynomial of the slice over 64-bit integers: the sum of
    a random value per byte times a power of an odd base, shifted back to 0.
    """

    _BASE = 0x9E3779B97F4A7C15 | 1
    _INVERSE = pow(_BASE, -1, 1 << 64)

    def __init__(self, seed: int = 7):
        self._values = np.random.default_rng(seed).integers(1, 2**63, 256, dtype=np.uint64)
        self._powers = self._backs = np.ones(1, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if len(self._powers) < n:
            size = max(n, 1 << 16)
            for name, base in (("_powers", self._BASE), ("_backs", self._INVERSE)):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def sums(self, data: bytes) -> np.ndarray:
        n = len(data)
        self._grow(n + 1)
        out = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(
            self._values[np.frombuffer(data, dtype=np.uint8)] * self._powers[:n], dtype=np.uint64, out=out[1:]
        )
        return out

    def slices(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((sums[end] - sums[start]) * self._backs[start] + (end - start).astype(np.uint64))
