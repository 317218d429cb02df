"""Session defaults and the shared work folder."""

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(app: str = "postsieve", cpus: int | None = None) -> SparkSession:
    """A session for local runs and tests; on a cluster bring your own."""
    cores = cpus or os.cpu_count() or 8
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.variant.allowDuplicateKeys", "true")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_folder(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    A cluster names it in ``spark.checkpoint.dir``.  Only where that is unset and
    driver and executors are one process (tests, a laptop) a temporary folder is
    made and remembered.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.postsieve.work.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"{master} needs a folder that all executors share in spark.checkpoint.dir")
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.postsieve.work.dir", folder)
    return folder.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(work_folder(spark) + "/checkpoints")


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(location)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it is not there."""
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    files = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(location):
        return []
    return [s.getPath().getName() for s in files.listStatus(location) if s.isDirectory()]


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder and what is in it; nothing happens if it is not there."""
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(location, True)


def remove_files(spark: SparkSession, path: str) -> None:
    """Remove the data files of a folder; marks such as ``_SUCCESS`` and the folder itself stay."""
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    files = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in files.listStatus(location) if files.exists(location) else []:
        if not status.getPath().getName().startswith("_"):
            files.delete(status.getPath(), True)
