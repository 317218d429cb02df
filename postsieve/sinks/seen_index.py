"""An index of the seen ids: which files of earlier batches can hold an id of this one.

Ids lie in hash buckets, one file per part and bucket.  Beside them each part keeps
bitmaps of hashed ids, 16 bits an id, in which every id sets three bits of one bitmap.
A batch is compared with the bitmaps and then reads only the buckets that can hold one of its
ids; a new id leads to a needless read in about one of 200 cases.  A part is a batch, or
many batches folded into one.  No id is missed: what the bitmaps let through is compared exactly.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsieve.operators.sizing import fits_broadcast
from postsieve.session import child_folders, path_exists, remove_folder

BUCKETS = 64
FOLD_AT = 64  # batches that are folded into one part
MAX_FOLDERS = 5_000  # beyond so many hits all parts are read

_BITMAP_BITS = 32_768  # the size of Spark's bitmaps
_BITS_PER_ID = 16
_PROBES = 3

_IDS = "external_id string, run int, epoch long, part string, bucket int"
_MARKS = "bucket int, number int, bits binary, part string"


def _hashed(seed: int, modulus: int) -> Column:
    return F.pmod(F.xxhash64("external_id", F.lit(seed)), F.lit(modulus)).cast("int")


def _bits() -> list[Column]:
    return [_hashed(2 + k, _BITMAP_BITS) for k in range(_PROBES)]


def _is_set(bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring("bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, bit % 8) == 1


class SeenIndex:
    """The index of a store (``Store.index``), in its folder ``seen_index``."""

    def __init__(self, store):
        self.store = store
        self.spark = store.spark
        self.base = f"{store.base}/seen_index"

    def exists(self) -> bool:
        return path_exists(self.spark, f"{self.base}/marks")

    def build(self) -> None:
        """Index all that the store has seen so far; from then on each batch is added as it is written."""
        self.drop()
        self._write("folded", self.store.newest_run() + 1, 0, self.store.versions("scanned_posts"))

    def drop(self) -> None:
        remove_folder(self.spark, self.base)

    def append(self, ids: DataFrame, run: int, epoch: int) -> None:
        """Add the ids of a batch, before the store's own rows: without these they do not count."""
        waiting = [p for p in self.parts(run, epoch) if p[0] == "batch"]
        if len(waiting) >= FOLD_AT:
            self._fold(waiting, run, epoch)
        rows = ids.select("external_id", F.lit(run).alias("run"), F.lit(epoch).cast("long").alias("epoch"))
        self._write("batch", run, epoch, rows)

    def parts(self, run: int, epoch: int) -> list[tuple[str, int, int, int]]:
        """(kind, run, epoch, bitmaps per bucket) of the complete parts that batches before this one are in."""
        named = []
        for folder in child_folders(self.spark, f"{self.base}/marks"):
            kind, *numbers = folder.removeprefix("part=").split(".")
            named.append((kind, *map(int, numbers)))
        done = [p for p in named if path_exists(self.spark, f"{self._marks(p)}/_SUCCESS")]
        folded = [p for p in done if p[0] == "folded"]
        bound = max((p[1:3] for p in folded), default=(-2, 0))
        batches = [p for p in done if p[0] == "batch" and bound <= p[1:3] < (run, epoch)]
        # A batch whose ids the store itself lacks broke off, and its ids are not seen.
        return folded + [p for p in batches if path_exists(self.spark, f"{self.store.batch_path('scanned_posts', *p[1:3])}/_SUCCESS")]

    def hits(self, batch: DataFrame, run: int, epoch: int) -> list[str] | None:
        """The folders that can hold an id of ``batch``; None if they are too many to name."""
        parts = self.parts(run, epoch)
        if not parts:
            return []
        ids = batch.select("external_id").where("external_id IS NOT NULL").distinct()
        probes = ids.select(
            _hashed(0, BUCKETS).alias("bucket"),
            F.explode(F.array(*[F.struct(F.lit(w).alias("wide"), _hashed(1, w).alias("number")) for w in sorted({p[3] for p in parts})])).alias("place"),
            *[bit.alias(f"bit{k}") for k, bit in enumerate(_bits())],
        ).select("bucket", "place.*", *[f"bit{k}" for k in range(_PROBES)])
        if fits_broadcast(probes):
            probes = F.broadcast(probes)
        marks = (
            self.spark.read.schema(_MARKS)
            .option("basePath", f"{self.base}/marks")
            .parquet(*[self._marks(p) for p in parts])
            .withColumn("wide", F.element_at(F.split("part", r"\."), -1).cast("int"))
        )
        hit = marks.join(probes, ["bucket", "wide", "number"])
        for k in range(_PROBES):
            hit = hit.where(_is_set(F.col(f"bit{k}")))
        found = hit.select("part", "bucket").distinct().limit(MAX_FOLDERS + 1).collect()
        if len(found) > MAX_FOLDERS:
            return None
        return sorted(f"{self.base}/ids/part={r.part.rpartition('.')[0]}/bucket={r.bucket}" for r in found)

    def among(self, batch: DataFrame, run: int, epoch: int) -> DataFrame:
        """The ids that batches before (run, epoch) have seen, cut down to what concerns ``batch``."""
        folders = self.hits(batch, run, epoch)
        if folders is None:
            folders = [self._ids(p) for p in self.parts(run, epoch)]
        if not folders:
            return self.spark.createDataFrame([], "external_id string")
        rows = self.spark.read.schema(_IDS).option("basePath", f"{self.base}/ids").parquet(*folders)
        earlier = F.struct("run", "epoch") < F.struct(F.lit(run), F.lit(epoch).cast("long"))
        known = self.store.alive("scanned_posts", rows.select("external_id", "run", "epoch").where(earlier))
        ids = batch.select("external_id").distinct()
        ids = F.broadcast(ids) if fits_broadcast(ids) else ids
        return known.select("external_id").join(ids, "external_id", "left_semi").distinct()

    def _fold(self, waiting: list[tuple[str, int, int, int]], run: int, epoch: int) -> None:
        """Make one part of the waiting batches; remove those that the fold before this one replaced."""
        bound = max((p[1:3] for p in self.parts(run, epoch) if p[0] == "folded"), default=(-2, 0))
        rows = self.spark.read.schema(_IDS).option("basePath", f"{self.base}/ids").parquet(*[self._ids(p) for p in waiting])
        self._write("folded", run, epoch, self.store.alive("scanned_posts", rows.select("external_id", "run", "epoch")))
        for folder in child_folders(self.spark, f"{self.base}/marks"):
            kind, *numbers = folder.removeprefix("part=").split(".")
            part = (kind, *map(int, numbers))
            if kind == "batch" and part[1:3] < bound:
                remove_folder(self.spark, self._marks(part))
                remove_folder(self.spark, self._ids(part))

    def _marks(self, part: tuple[str, int, int, int]) -> str:
        return f"{self.base}/marks/part={'.'.join(map(str, part))}"

    def _ids(self, part: tuple) -> str:
        return f"{self.base}/ids/part={'.'.join(map(str, part[:3]))}"

    def _write(self, kind: str, run: int, epoch: int, rows: DataFrame) -> None:
        """Ids first, bitmaps from them last: a part without its bitmaps does not count."""
        name = f"{kind}.{run}.{epoch}."
        for folder in child_folders(self.spark, f"{self.base}/marks"):
            if folder.startswith(f"part={name}"):
                remove_folder(self.spark, f"{self.base}/marks/{folder}")
        path = self._ids((kind, run, epoch))
        buckets = rows.select("external_id", "run", "epoch", _hashed(0, BUCKETS).alias("bucket"))
        buckets.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
        written = self.spark.read.schema("external_id string, bucket int").parquet(path)
        most = written.groupBy("bucket").count().agg(F.max("count")).first()[0] or 0
        wide = 1
        while wide * _BITMAP_BITS < most * _BITS_PER_ID:
            wide *= 2
        marks = written.select("bucket", _hashed(1, wide).alias("number"), F.explode(F.array(*_bits())).alias("bit"))
        marks = marks.groupBy("bucket", "number").agg(F.expr("bitmap_construct_agg(bit)").alias("bits"))
        marks.write.mode("overwrite").parquet(self._marks((kind, run, epoch, wide)))
