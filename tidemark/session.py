"""Session set-up and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str | int = "*", app: str = "tidemark") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a session that names none (a local test run) gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


_MADE: dict[str, list[str]] = {}  # by application: what was written to the shared folder


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/tidemark/{name}-{uuid.uuid4().hex}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession) -> int:
    """Deletes the tables that this session has written to the shared folder; how many there were.

    To be called when results have been stored or shown: a result that was not reads these tables.
    """
    paths = _MADE.pop(spark.sparkContext.applicationId, [])
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for path in paths:
        at = hadoop(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    return len(paths)


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet and go on from the file.

    Cuts the lineage (a lost executor re-reads the file instead of re-running the
    job), and unlike a cache it costs no memory and keeps column pruning.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settle_by(df: DataFrame, key: str, name: str) -> DataFrame:
    """As ``settle``, with rows stored by ``key``: what groups by it, and by more, reads without a shuffle.

    One shuffle places the rows; as many buckets as the session has shuffle partitions.
    """
    spark = df.sparkSession
    path, buckets = new_path(spark, name), int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    df.repartition(buckets, key).write.bucketBy(buckets, key).option("path", path).saveAsTable(table)
    return spark.table(table)
