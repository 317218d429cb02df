"""The compacted part of a table: files with known ranges of the key.

Each range is a folder with rows of one stretch of keys, about ``rows_per_range`` of them,
more if the table would take over ``MAX_RANGES``, and fewer if these hold more than about
``BYTES_PER_RANGE``: one task writes a range.
A manifest lists the ranges that hold together all that batches before some
(run, epoch) wrote.  Compaction writes anew only the ranges that later batches or
deletions touch, and then a manifest of new and untouched ranges.  The manifest comes last, so
a broken compaction changes nothing.  What only older manifests name stays for one
more compaction, for readers under way, and is then removed.
"""

import json
from functools import reduce
from math import ceil
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsieve.operators.sizing import fits_broadcast
from postsieve.operators.upsert import latest_per_key
from postsieve.session import child_folders, path_exists, remove_files, remove_folder

ROWS_PER_RANGE = 2_000_000
BYTES_PER_RANGE = 128_000_000

# By its rows a table takes no more ranges than this: each is a folder to list at every reading.
MAX_RANGES = 256

# The folder that declares the compacted part; it never holds rows.
_EMPTY = "none/part=-1"


class Range(NamedTuple):
    generation: str  # the folder it lies in, named by the batch it was compacted before
    range: int
    n_rows: int
    n_bytes: int


def place(key: Column, lows: list, kind: str) -> Column:
    """How many of the ascending ``lows`` are not above ``key``, by binary search; 0 for NULL."""
    bounds = F.from_json(F.lit(json.dumps(lows)), f"array<{kind}>")
    steps = [1 << b for b in reversed(range(max(len(lows), 1).bit_length()))]
    reached = lambda at, step: F.coalesce(F.get(bounds, at + step - 1) <= key, F.lit(False))
    return F.aggregate(
        F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(reached(at, step), at + step).otherwise(at)
    )


class Ranges:
    def __init__(self, store, table: str, schema: T.StructType, deleted_by: list[tuple[str, str]]):
        self.store = store
        self.spark = store.spark
        self.table = table
        self.schema = schema  # with run and epoch
        self.key = schema[0]
        self.deleted_by = deleted_by
        self.data = f"{store.path(table)}/_compacted"
        self.manifests = f"{store.path(table)}/_manifests"
        self.manifest_schema = T.StructType(
            [
                T.StructField("generation", T.StringType()),
                T.StructField("range", T.LongType()),
                T.StructField("low", self.key.dataType),
                T.StructField("n_rows", T.LongType()),
                T.StructField("n_bytes", T.LongType()),
            ]
        )

    def declare(self) -> None:
        """Empty folders, so that views can name them."""
        empty = self.spark.createDataFrame([], self._with_range())
        empty.write.mode("overwrite").parquet(f"{self.data}/{_EMPTY}")
        self._write_manifest(self.spark.createDataFrame([], self.manifest_schema), (-1, -1))

    def sql(self) -> str:
        """The table for a view, before deletions: the ranges of the newest manifest, and later batches."""
        columns = ", ".join(self.schema.names)
        manifests = f"parquet.`{self.manifests}`"
        until = f"(SELECT max(struct(CAST(run AS BIGINT), CAST(epoch AS BIGINT))) FROM {manifests})"
        later = f"coalesce(struct(CAST(run AS BIGINT), CAST(epoch AS BIGINT)) >= {until}, true)"
        return f"""(SELECT {columns} FROM parquet.`{self.store.path(self.table)}` WHERE {later}
            UNION ALL SELECT {columns} FROM parquet.`{self.data}/*/*` WHERE range IN (SELECT range FROM {manifests}
            WHERE struct(CAST(run AS BIGINT), CAST(epoch AS BIGINT)) = {until}))"""

    def until(self) -> tuple[int, int] | None:
        """The batch before which all is compacted."""
        return max(self._bounds(), default=None)

    def rows(self) -> DataFrame:
        """What the newest manifest names."""
        return self.near(None)

    def near(self, keys: DataFrame | None) -> DataFrame:
        """What the newest manifest names, of the ranges only that ``keys`` fall into."""
        entries, lows = self._entries(self.until())
        if keys is not None and entries:
            at = place(F.col(self.key.name), lows[1:], self.key.dataType.simpleString())
            entries = [entries[r.at] for r in keys.select(at.alias("at")).distinct().collect()]
        return self._read(entries).drop("range")

    def compact(self, newest: tuple[int, int], rows_per_range: int, bytes_per_range: int = BYTES_PER_RANGE) -> None:
        """Take in all batches before ``newest``."""
        until = self.until()
        entries, lows = self._entries(until)
        self._sweep()
        pending = self._pending(until, newest)
        n_pending, pending_bytes = pending.agg(F.count("*"), self._bytes()).first()
        touched = self._touched(entries, lows, pending, until)

        # Of a large table the ranges grow, not their number.
        rows_per_range = max(rows_per_range, ceil((n_pending + sum(e.n_rows for e in entries)) / MAX_RANGES))

        def needed(ranges: list[Range]) -> int:
            rows = n_pending + sum(e.n_rows for e in ranges)
            size = pending_bytes + sum(e.n_bytes for e in ranges)
            return max(1, ceil(rows / rows_per_range), ceil(size / bytes_per_range))

        if len(entries) > 2 * needed(entries) + 2:
            touched = set(range(len(entries)))  # too many small ranges: all are written anew
        name = f"{newest[0]}-{newest[1]}"
        old = [entries[i] for i in sorted(touched)]
        rows = self._keep(self._read(old).drop("range").unionByName(pending), newest)
        # Neighbours that are all written anew may exchange rows, so each run of them is cut as a whole.
        runs = [i for i in sorted(touched) if i - 1 not in touched]
        starts = [lows[i] for i in runs[1:]]
        parts = needed(old)
        first = 1 + max((e.range for e in self._named()), default=-1)
        number = F.lit(first).cast("long") + F.col("_run") * parts + F.spark_partition_id()
        key = self.key.name
        rows.withColumn("_run", place(F.col(key), starts, self.key.dataType.simpleString())).repartitionByRange(
            parts, "_run", key
        ).withColumn("range", number).withColumn("part", F.col("range")).drop("_run").sortWithinPartitions(
            "part", key
        ).write.mode("overwrite").partitionBy("part").parquet(f"{self.data}/{name}")
        written = self.spark.read.schema(self._with_range()).parquet(f"{self.data}/{name}").groupBy("range")
        manifest = written.agg(F.min(key).alias("low"), F.count("*").alias("n_rows"), self._bytes().alias("n_bytes"))
        manifest = manifest.withColumn("generation", F.lit(name))
        stay = [(e.generation, e.range, low, e.n_rows, e.n_bytes) for i, (e, low) in enumerate(zip(entries, lows)) if i not in touched]
        names = self.manifest_schema.names
        self._write_manifest(
            manifest.select(*names).unionByName(self.spark.createDataFrame(stay, self.manifest_schema)), newest
        )
        self._retire(newest, until)

    def _pending(self, until: tuple[int, int] | None, newest: tuple[int, int]) -> DataFrame:
        rows = self.spark.read.schema(self.schema).parquet(self.store.path(self.table))
        rows = rows.where(_version() < _batch(*newest))
        rows = rows if until is None else rows.where(_version() >= _batch(*until))
        return self.store.alive(self.table, rows, newest)

    def _keep(self, rows: DataFrame, newest: tuple[int, int]) -> DataFrame:
        # Like batches, the newest deletions may yet be done again.
        rows = self.store.alive(self.table, rows, newest)
        return latest_per_key(rows, [self.key.name], ["run", "epoch"]) if self.table == "posts" else rows

    def _touched(self, entries: list[Range], lows: list, pending: DataFrame, until) -> set[int]:
        """Places of the ranges that keys of ``pending`` or deletions since ``until`` fall into."""
        if not entries:
            return set()
        at = place(F.col(self.key.name), lows[1:], self.key.dataType.simpleString())
        touched = {r.at for r in pending.select(at.alias("at")).distinct().collect()}
        places = {e.range: i for i, e in enumerate(entries)}
        for column, deleted in self.deleted_by:
            gone = self.store.read("deletions", since=until).where(F.col(deleted).isNotNull())
            if self.table == "scanned_posts":
                gone = gone.where("forget")
            gone = gone.select(F.col(deleted).alias(column)).distinct()
            if gone.isEmpty():
                continue
            gone = F.broadcast(gone) if fits_broadcast(gone) else gone
            hit = self._read(entries).join(gone, column, "left_semi").select("range").distinct()
            touched |= {places[r.range] for r in hit.collect()}
        return touched

    def _bytes(self) -> Column:
        """The size of rows: their texts, and eight bytes for any other column."""
        sizes = [F.coalesce(F.octet_length(f.name), F.lit(0)) if isinstance(f.dataType, T.StringType) else F.lit(8) for f in self.schema]
        return F.coalesce(F.sum(reduce(lambda a, b: a + b, sizes).cast("long")), F.lit(0).cast("long"))

    def _with_range(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField("range", T.LongType())])

    def _read(self, entries: list[Range]) -> DataFrame:
        if not entries:
            return self.spark.createDataFrame([], self._with_range())
        return self.spark.read.schema(self._with_range()).parquet(*[f"{self.data}/{e.generation}/part={e.range}" for e in entries])

    def _bounds(self) -> list[tuple[int, int]]:
        """The complete manifests."""
        found = []
        for run in child_folders(self.spark, self.manifests):
            for epoch in child_folders(self.spark, f"{self.manifests}/{run}"):
                if path_exists(self.spark, f"{self.manifests}/{run}/{epoch}/_SUCCESS"):
                    found.append((int(run.removeprefix("run=")), int(epoch.removeprefix("epoch="))))
        return sorted(b for b in found if b != (-1, -1))

    def _manifest(self, bound: tuple[int, int]) -> str:
        return f"{self.manifests}/run={bound[0]}/epoch={bound[1]}"

    def _write_manifest(self, rows: DataFrame, bound: tuple[int, int]) -> None:
        # One file: readers see the whole manifest or none.
        rows.coalesce(1).write.mode("overwrite").parquet(self._manifest(bound))

    def _entries(self, bound: tuple[int, int] | None) -> tuple[list[Range], list]:
        """The ranges of a manifest, in order of the key, and their least keys."""
        if bound is None:
            return [], []
        rows = self.spark.read.schema(self.manifest_schema).parquet(self._manifest(bound)).orderBy("low").collect()
        # Manifests of older versions lack the bytes.
        return [Range(r.generation, r.range, r.n_rows, r.n_bytes or 0) for r in rows], [r.low for r in rows]

    def _named(self) -> list[Range]:
        return [e for bound in self._bounds() for e in self._entries(bound)[0]]

    def _sweep(self) -> None:
        """Remove ranges that no manifest names."""
        named = {(e.generation, e.range) for e in self._named()}
        generations = {g for g, _ in named}
        for generation in child_folders(self.spark, self.data):
            if generation == _EMPTY.split("/")[0]:
                continue
            if generation not in generations:
                remove_folder(self.spark, f"{self.data}/{generation}")
                continue
            for folder in child_folders(self.spark, f"{self.data}/{generation}"):
                if folder.startswith("part=") and (generation, int(folder.removeprefix("part="))) not in named:
                    remove_folder(self.spark, f"{self.data}/{generation}/{folder}")

    def _retire(self, newest: tuple[int, int], previous: tuple[int, int] | None) -> None:
        """Remove what neither the new manifest nor the one before it needs."""
        if previous is None:
            return
        for bound in self._bounds():
            if bound not in (newest, previous):
                remove_folder(self.spark, self._manifest(bound))
        self._sweep()
        base = self.store.path(self.table)
        for run in child_folders(self.spark, base):
            if not run.startswith("run=") or run == "run=-1":
                continue
            for epoch in child_folders(self.spark, f"{base}/{run}"):
                if (int(run.removeprefix("run=")), int(epoch.removeprefix("epoch="))) < previous:
                    # The mark of a complete batch stays: the index of seen ids asks for it.
                    remove_files(self.spark, f"{base}/{run}/{epoch}")


def _version() -> Column:
    return F.struct("run", "epoch")


def _batch(run: int, epoch: int) -> Column:
    return F.struct(F.lit(run).alias("run"), F.lit(epoch).cast("long").alias("epoch"))
