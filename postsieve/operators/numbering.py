"""Running sums and dense numbers over a whole ordered table, without one big task."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postsieve.session import ensure_checkpoint_dir


def running_sum(
    df: DataFrame,
    order: list[str],
    value: str,
    output: str = "running_total",
) -> DataFrame:
    """Sum of ``value`` up to and including each row, in ``order`` (unique).

    Rows are range-partitioned by ``order`` and that partitioning is fixed by a
    checkpoint.  One sum per partition gives the offset of the next ones; within
    its partition each row adds its own running sum.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        df.repartitionByRange(partitions, *order)
        .withColumn("_part", F.spark_partition_id())
        .checkpoint()
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition, so the unpartitioned window is safe here.
    offsets = (
        placed.groupBy("_part")
        .agg(F.sum(value).alias("_sum"))
        .select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    )
    within = (
        Window.partitionBy("_part")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        placed.withColumn("_within", F.sum(value).over(within))
        .join(F.broadcast(offsets), "_part")
        .withColumn(output, F.col("_within") + F.col("_offset"))
        .drop("_part", "_within", "_offset")
    )


def dense_ids(df: DataFrame, order: list[str], start: int, output: str = "id") -> DataFrame:
    """Number the rows ``start, start + 1, ...`` in ``order``."""
    numbered = running_sum(df.withColumn("_one", F.lit(1).cast("long")), order, "_one", "_n")
    return numbered.withColumn(output, F.col("_n") + F.lit(start - 1)).drop("_one", "_n")
