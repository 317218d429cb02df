"""Constraints of the tables: keys, not-null columns, references, cascades."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve import schemas
from postsieve.operators.sizing import fits_broadcast

# (table, column, values) -> rows of the table before a batch; see constraint_delta.
Stored = Callable[[str, str, DataFrame], DataFrame]


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number; counted per task first.
    As in SQL, a key with a NULL in it is never a duplicate."""
    complete = df.na.drop(subset=key)
    return complete.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def unique_violations(
    table: str, df: DataFrame, key: list[str], within: list[str] | None = None
) -> DataFrame:
    """Number of keys that occur more than once.

    ``within`` names a part of the key that should be unique already: then only
    rows that repeat that part are grouped, and the long rest of the key (a text)
    is not shuffled for all the others.
    """
    rows = df
    if within:
        repeated = duplicate_keys(df, within).select(*within)
        repeated = F.broadcast(repeated) if fits_broadcast(repeated) else repeated
        rows = df.join(repeated, within, "left_semi")
    return duplicate_keys(rows, key).agg(F.count("*").alias("violations")).select(
        F.lit(table).alias("table_name"),
        F.lit("unique").alias("rule"),
        F.lit(",".join(key)).alias("columns"),
        "violations",
    )


def null_violations(table: str, df: DataFrame, columns: list[str]) -> DataFrame:
    """One scan for all columns of the table."""
    counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns])
    per_column = F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c))])
    return counts.select(F.explode(per_column).alias("columns", "violations")).select(
        F.lit(table).alias("table_name"), F.lit("not null").alias("rule"), "columns", "violations"
    )


def fk_orphans(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose reference points nowhere; a NULL refers to nothing."""
    keys = parent.select(F.col(parent_col).alias(child_col))
    return child.filter(F.col(child_col).isNotNull()).join(keys, child_col, "left_anti")


def fk_violations(
    table: str, child: DataFrame, child_col: str, parent_table: str, parent: DataFrame, parent_col: str
) -> DataFrame:
    """Number of orphans.  References are counted per value before the join, so a
    value that most rows refer to counts as one row there."""
    values = child.groupBy(child_col).agg(F.count("*").alias("_n"))
    orphans = fk_orphans(values, child_col, parent, parent_col)
    return orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("violations")).select(
        F.lit(table).alias("table_name"),
        F.lit(f"references {parent_table}").alias("rule"),
        F.lit(child_col).alias("columns"),
        "violations",
    )


def constraint_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Violations of every declared constraint of the given tables."""
    parts = []
    for table, df in tables.items():
        keys = schemas.UNIQUE_KEYS[table]
        for key in keys:
            within = next((k for k in keys if set(k) < set(key)), None)
            parts.append(unique_violations(table, df, key, within))
        parts.append(null_violations(table, df, schemas.NOT_NULL[table]))
    for child, child_col, parent, parent_col in schemas.FOREIGN_KEYS:
        if child in tables and parent in tables:
            parts.append(
                fk_violations(child, tables[child], child_col, parent, tables[parent], parent_col)
            )
    return reduce(lambda a, b: a.unionByName(b), parts)


def _hinted(keys: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(keys) if small else keys


def _row(table: str, rule: str, columns: str, frame: DataFrame) -> DataFrame:
    return frame.select(
        F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), F.lit(columns).alias("columns"),
        F.coalesce(F.col("violations"), F.lit(0)).cast("long").alias("violations"),
    )


def unique_delta(table: str, key: list[str], changes: DataFrame, stored: Stored, small: bool) -> DataFrame:
    """By how many the keys that occur more than once change; only keys of ``changes`` are looked up."""
    moved = changes.na.drop(subset=key).groupBy(*key).agg(F.sum("_sign").alias("_moved")).filter("_moved != 0")
    keys = _hinted(moved.select(*key), small)
    rows = stored(table, key[0], moved.select(key[0]).distinct()).select(*key)
    before = rows.join(keys, key, "left_semi").groupBy(*key).agg(F.count("*").alias("_n"))
    n = F.coalesce("_n", F.lit(0))
    change = (n + F.col("_moved") > 1).cast("int") - (n > 1).cast("int")
    return _row(table, "unique", ",".join(key), moved.join(before, key, "left").agg(F.sum(change).alias("violations")))


def null_delta(table: str, columns: list[str], changes: DataFrame) -> DataFrame:
    """By how many the NULLs of each column change."""
    sums = changes.agg(*[F.sum(F.when(F.col(c).isNull(), F.col("_sign"))).alias(c) for c in columns])
    parts = [_row(table, "not null", c, sums.select(F.col(c).alias("violations"))) for c in columns]
    return reduce(lambda a, b: a.unionByName(b), parts)


def fk_delta(
    key: tuple[str, str, str, str], changes: dict[str, DataFrame], stored: Stored, small: bool
) -> DataFrame:
    """By how many the orphans of one reference change.

    Children of the batch count by whether their parent is there afterwards.  Stored children
    matter only where a parent came or went, so they are read for those values alone.
    """
    child, column, parent, parent_column = key
    spark = next(iter(changes.values())).sparkSession

    def moved(table, name, total):
        if table not in changes:
            kind = schemas.TABLES[table][name].dataType.simpleString()
            return spark.createDataFrame([], f"_v {kind}, {total} bigint")
        rows = changes[table].select(F.col(name).alias("_v"), "_sign")
        return rows.filter("_v IS NOT NULL").groupBy("_v").agg(F.sum("_sign").alias(total)).filter(f"{total} != 0")

    def there(table, name, values, total):
        rows = stored(table, name, values.withColumnRenamed("_v", name)).select(F.col(name).alias("_v"))
        return rows.join(_hinted(values, small), "_v", "left_semi").groupBy("_v").agg(F.count("*").alias(total))

    both = moved(child, column, "_c").join(moved(parent, parent_column, "_p"), "_v", "full")
    parents = there(parent, parent_column, both.select("_v"), "_p0")
    state = both.join(parents, "_v", "left").na.fill(0, ["_c", "_p", "_p0"])
    state = state.withColumn("_was", F.col("_p0") > 0).withColumn("_is", F.col("_p0") + F.col("_p") > 0)
    # New children without parent; then those stored before whose parent came or went.
    change = F.when(~F.col("_is"), F.col("_c")).otherwise(0)
    if parent in changes:
        flipped = state.filter("_was != _is").select("_v")
        state = state.join(there(child, column, flipped, "_c0"), "_v", "left").na.fill(0, ["_c0"])
        change = change + F.col("_c0") * (F.col("_was").cast("int") - F.col("_is").cast("int"))
    return _row(child, f"references {parent}", column, state.agg(F.sum(change).alias("violations")))


def constraint_delta(changes: dict[str, DataFrame], stored: Stored) -> DataFrame:
    """What a batch adds to, or takes from, the violations of every declared constraint.

    ``changes`` holds the rows that came (``_sign`` 1) and went (-1) of each table concerned.
    ``stored(table, column, values)`` gives the rows before the batch, at least those whose
    ``column`` is among ``values``.  Violations before plus
    this are the violations after, as ``constraint_report`` counts them.
    """
    # Keys and references are parts of these rows, so one check of each table's rows serves them all.
    small = {table: fits_broadcast(rows) for table, rows in changes.items()}
    parts = []
    for table, rows in changes.items():
        parts += [unique_delta(table, key, rows, stored, small[table]) for key in schemas.UNIQUE_KEYS[table]]
        parts.append(null_delta(table, schemas.NOT_NULL[table], rows))
    for key in schemas.FOREIGN_KEYS:
        if key[0] in changes or key[2] in changes:
            parts.append(fk_delta(key, changes, stored, small.get(key[0], True) and small.get(key[2], True)))
    return reduce(lambda a, b: a.unionByName(b), parts)


def cascade_delete(bridge: DataFrame, deleted: DataFrame, key: str) -> DataFrame:
    """The bridge rows that stay when the given posts or keywords go."""
    return bridge.join(deleted.select(key), key, "left_anti")
