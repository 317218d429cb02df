"""Size checks that stand before every broadcast, and spreading of small scans."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is broadcast only if it stays below both bounds.
BROADCAST_ROWS = 200_000
BROADCAST_CHARS = 32_000_000


def fits_broadcast(
    df: DataFrame,
    max_rows: int = BROADCAST_ROWS,
    max_chars: int = BROADCAST_CHARS,
) -> bool:
    """Count rows and text of ``df`` in one aggregate and compare with the bounds."""
    text_columns = [name for name, kind in df.dtypes if kind == "string"]
    chars = F.lit(0)
    for name in text_columns:
        chars = chars + F.coalesce(F.octet_length(name), F.lit(0))
    rows, size = df.agg(F.count("*"), F.coalesce(F.sum(chars.cast("long")), F.lit(0))).first()
    return rows <= max_rows and size <= max_chars


def spread(scan: DataFrame) -> DataFrame:
    """Use all cores on a scan that has fewer splits than there are cores.

    For a plain file scan only.  A large input has more splits than cores and
    passes through unchanged.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
