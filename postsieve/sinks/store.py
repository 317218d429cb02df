"""The five tables as parquet folders, written batch by batch.

Every write goes to its own partition ``run=<r>/epoch=<e>`` and replaces what an
earlier attempt at the same batch left there, so a replay changes nothing and no
write touches old data.  Posts keep their versions; readers take the newest one.
Seen ids and post-keyword links are inserted only if no earlier batch holds them.
``compact`` takes batches into files with known ranges of ids, after which readers skip
their partitions.  Posts and keywords are deleted by rows that say so; what was written
up to then under their ids is read no more, links included.  One writer at a time.
"""

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsieve.operators.arrivals import anti_seen, seen_among
from postsieve.operators.sizing import fits_broadcast
from postsieve.operators.upsert import latest_per_key
from postsieve.schemas import RUN_TABLES, TABLES
from postsieve.session import child_folders
from postsieve.sinks.ranges import BYTES_PER_RANGE, ROWS_PER_RANGE, Ranges
from postsieve.sinks.seen_index import SeenIndex

_VERSION = [T.StructField("run", T.IntegerType()), T.StructField("epoch", T.LongType())]

# The partition that declares a table; it never holds rows.
_EMPTY = "run=-1/epoch=-1"

_ALL = TABLES | RUN_TABLES

# Which columns of a table say that a deletion concerns a row: its own, that of the deletion.
DELETED_BY = {
    "posts": [("external_id", "external_id")],
    "post_keywords": [("external_id", "external_id"), ("keyword_id", "keyword_id")],
    "scanned_posts": [("external_id", "external_id")],
    "keywords": [("id", "keyword_id")],
}

BATCH_TABLES = ["posts", "post_keywords", "scanned_posts"]


class Store:
    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.base}/{table}"

    def bootstrap(self, reset: bool = False, keep_seen: bool = True) -> None:
        """Declare the tables.  ``reset`` empties them; the seen ids outlive a
        reset unless ``keep_seen`` is off."""
        for table, schema in _ALL.items():
            empty = self.spark.createDataFrame([], schema)
            if reset and table == "scanned_posts" and not keep_seen:
                SeenIndex(self).drop()
            if reset and not (table == "scanned_posts" and keep_seen):
                # Overwriting the folder drops every partition in it.
                empty.withColumn("run", F.lit(-1)).withColumn("epoch", F.lit(-1)).write.partitionBy(
                    "run", "epoch"
                ).mode("overwrite").option("partitionOverwriteMode", "static").parquet(self.path(table))
            empty.write.mode("overwrite").parquet(f"{self.path(table)}/{_EMPTY}")
            if table in TABLES:
                self.ranges(table).declare()

    def register(self, database: str) -> None:
        """Make the tables known to the catalog under ``database``, as ``read`` shows them.

        They are views: what later batches write shows at once.
        """
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{self.base}/_catalog'")
        for table, schema in TABLES.items():
            columns = ", ".join(schema.names)
            rows = self.ranges(table).sql()
            for column, deleted in DELETED_BY.get(table, []):
                forget = " AND d.forget" if table == "scanned_posts" else ""
                rows = f"""(SELECT * FROM {rows} t WHERE NOT EXISTS (
                    SELECT 1 FROM parquet.`{self.path('deletions')}` d WHERE d.{deleted} = t.{column}{forget}
                    AND struct(d.run, d.epoch) >= struct(t.run, t.epoch)))"""
            if table == "posts":
                newest = "row_number() OVER (PARTITION BY external_id ORDER BY run DESC, epoch DESC)"
                rows = f"(SELECT *, {newest} AS version FROM {rows}) WHERE version = 1"
            self.spark.sql(f"CREATE OR REPLACE VIEW {database}.{table} AS SELECT {columns} FROM {rows}")

    def versions(self, table: str) -> DataFrame:
        """All rows with the run and epoch that wrote them, without deleted ones."""
        return self.alive(table, self._written(table))

    def alive(self, table: str, rows: DataFrame, before: tuple[int, int] | None = None) -> DataFrame:
        """Rows (with run and epoch) that no later deletion concerns, or none ``before`` a batch.
        The deletions are cut to one per id before they meet the rows."""
        if table not in DELETED_BY or child_folders(self.spark, self.path("deletions")) in ([], [_EMPTY.split("/")[0]]):
            return rows
        deletions = self._written("deletions")
        if before is not None:
            deletions = deletions.where(F.struct("run", "epoch") < F.struct(F.lit(before[0]), F.lit(before[1]).cast("long")))
        if table == "scanned_posts":
            deletions = deletions.where("forget")
        for column, deleted in DELETED_BY[table]:
            gone = deletions.where(F.col(deleted).isNotNull()).groupBy(F.col(deleted).alias(column))
            gone = gone.agg(F.max(F.struct("run", "epoch")).alias("_gone"))
            if fits_broadcast(gone):
                gone = F.broadcast(gone)
            alive = F.col("_gone").isNull() | (F.struct("run", "epoch") > F.col("_gone"))
            rows = rows.join(gone, column, "left").where(alive).drop("_gone")
        return rows.select(*_ALL[table].names, "run", "epoch")

    def _written(self, table: str, keys: DataFrame | None = None) -> DataFrame:
        rows = self.spark.read.schema(self._versioned(table)).parquet(self.path(table))
        ranges = self.ranges(table)
        bound = ranges.until()
        if bound is None:
            return rows
        run, epoch = bound
        later = rows.filter((F.col("run") > run) | ((F.col("run") == run) & (F.col("epoch") >= epoch)))
        return ranges.near(keys).unionByName(later)

    def _versioned(self, table: str) -> T.StructType:
        return T.StructType(_ALL[table].fields + _VERSION)

    def ranges(self, table: str) -> Ranges:
        """The compacted part of a table."""
        return Ranges(self, table, self._versioned(table), DELETED_BY.get(table, []))

    def compact(self, table: str, rows_per_range: int = ROWS_PER_RANGE, bytes_per_range: int = BYTES_PER_RANGE) -> bool:
        """Take all batches before the newest one into the compacted part, in order of the id; of
        posts only the newest version stays.  Returns whether there was anything to do.

        The newest batch may yet be done again and stays as it is.  Only the ranges of ids
        are written anew that these batches or deletions touch.  Replaced files and batches
        go with the next compaction; views read the compacted part by themselves.
        """
        newest = self._written(table).agg(F.max(F.struct("run", "epoch"))).first()[0]
        if newest is None or tuple(newest) == self.ranges(table).until():
            return False
        self.ranges(table).compact(tuple(newest), rows_per_range, bytes_per_range)
        return True

    def before(self, table: str, run: int, epoch: int) -> DataFrame:
        """What earlier batches wrote; later and own partitions are not read."""
        earlier = (F.col("run") < run) | ((F.col("run") == run) & (F.col("epoch") < epoch))
        return self.versions(table).filter(earlier)

    def as_of(self, table: str, run: int, epoch: int, keys: DataFrame | None = None) -> DataFrame:
        """The table as it stood before a batch, which must be the newest or the one to come.
        With ``keys`` (values of its id) at least the rows with one of them: only their ranges are read."""
        earlier = F.struct("run", "epoch") < F.struct(F.lit(run), F.lit(epoch).cast("long"))
        rows = self.alive(table, self._written(table, keys).filter(earlier), (run, epoch))
        if table == "posts":
            rows = latest_per_key(rows, ["external_id"], ["run", "epoch"])
        return rows.select(*_ALL[table].names)

    def batch(self, table: str, run: int, epoch: int) -> DataFrame:
        """What one batch wrote, from its own partition."""
        return self.spark.read.schema(_ALL[table]).parquet(self.batch_path(table, run, epoch))

    def batch_path(self, table: str, run: int, epoch: int) -> str:
        return f"{self.path(table)}/run={run}/epoch={epoch}"

    def read(self, table: str, since: tuple[int, int] | None = None) -> DataFrame:
        """The table as it stands: for posts the newest version of each id.
        With ``since`` only what that batch and later ones wrote."""
        rows = self.versions(table)
        if since is not None:
            rows = rows.filter(F.struct("run", "epoch") >= F.struct(F.lit(since[0]), F.lit(since[1]).cast("long")))
        if table == "posts":
            rows = latest_per_key(rows, ["external_id"], ["run", "epoch"])
        return rows.select(*_ALL[table].names)

    def append(self, table: str, rows: DataFrame, run: int, epoch: int) -> int:
        """Write one batch and return its number of rows."""
        written = Observation()
        rows.select(*_ALL[table].names).observe(written, F.count(F.lit(1)).alias("n")).write.mode(
            "overwrite"
        ).parquet(self.batch_path(table, run, epoch))
        return written.get["n"]

    def upsert_posts(self, posts: DataFrame, run: int, epoch: int) -> int:
        """``posts`` holds one row per id; it replaces older versions."""
        return self.append("posts", posts, run, epoch)

    def insert_links(self, links: DataFrame, run: int, epoch: int) -> int:
        """Add the post-keyword links that no earlier batch added."""
        batch = links.dropDuplicates(["external_id", "keyword_id"])
        ids = batch.select("external_id").distinct()
        # With few posts in the batch the stored links are scanned, not shuffled.
        ids = F.broadcast(ids) if fits_broadcast(ids) else ids
        known = self.before("post_keywords", run, epoch).join(ids, "external_id", "left_semi")
        new = batch.join(known, ["external_id", "keyword_id"], "left_anti")
        return self.append("post_keywords", new, run, epoch)

    def delete(
        self,
        run: int,
        epoch: int,
        posts: DataFrame | None = None,
        keywords: DataFrame | None = None,
        forget: bool = False,
    ) -> int:
        """Delete posts (external_id) and keywords (id) with their links, as a batch of its own.

        All that batches up to this one wrote under these ids is gone; what comes later is
        there again.  With ``forget`` the ids of the posts also leave the seen ids.
        Compaction leaves deleted rows out.
        """
        none = self.spark.createDataFrame([], "external_id string, keyword_id long")
        rows = none if posts is None else posts.select("external_id", F.lit(None).cast("long").alias("keyword_id"))
        if keywords is not None:
            rows = rows.unionByName(keywords.select(F.lit(None).cast("string").alias("external_id"), F.col("id").alias("keyword_id")))
        rows = rows.where("external_id IS NOT NULL OR keyword_id IS NOT NULL").distinct()
        return self.append("deletions", rows.withColumn("forget", F.lit(forget)), run, epoch)

    def index_seen(self) -> None:
        """Build the index of seen ids; from now on batches keep it up and are compared with it."""
        SeenIndex(self).build()

    def seen_among(self, batch: DataFrame, run: int, epoch: int) -> DataFrame:
        """What earlier batches have seen of the ids of ``batch``: by the index if there is one, else by a scan."""
        index = SeenIndex(self)
        if index.exists():
            return index.among(batch, run, epoch)
        return seen_among(batch, self.before("scanned_posts", run, epoch))

    def append_seen(self, ids: DataFrame, run: int, epoch: int) -> int:
        """Write the new ids of a batch, in the index, too, if there is one."""
        index = SeenIndex(self)
        if index.exists():
            index.append(ids, run, epoch)
        return self.append("scanned_posts", ids, run, epoch)

    def insert_seen(self, ids: DataFrame, run: int, epoch: int) -> int:
        """Add the ids that no earlier batch added."""
        batch = ids.select("external_id").distinct()
        return self.append_seen(anti_seen(batch, self.seen_among(batch, run, epoch)), run, epoch)

    def newest_run(self) -> int:
        """The highest run that wrote anything, -1 for none."""
        runs = [self._written(t).agg(F.max("run").alias("run")) for t in BATCH_TABLES]
        newest = reduce(lambda a, b: a.union(b), runs).agg(F.max("run")).first()[0]
        return -1 if newest is None else newest
