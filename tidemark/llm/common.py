"""Folds, written tables and bounded samples that the operators share."""

from __future__ import annotations

from threading import Lock

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import new_path

WORDS = r"[ \t-\r]+"  # what lies between words, for split()
FOLDS = 5
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BROADCAST_ROWS = 100_000  # of some hundred bytes each, that a broadcast may hold
BROADCAST_IDS = 1 << 20  # of some forty bytes each in a broadcast's table


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning; one without an id always is."""
    fold = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == 0, F.lit(True))


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def words(text: Column) -> Column:
    """The words of a text as an array; none of a null text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORDS), lambda w: w != "")


_WRITES = {"now": 0, "before": "false"}  # how many are under way, and the option before the first
_LOCK = Lock()


def settle(df: DataFrame, name: str, **options) -> DataFrame:
    """``df`` written once to the shared folder and read again; its shuffle files go at once.

    Until the table is complete they stay, so that a lost executor costs its own tasks only. The
    session's option for that is put back when the last of the writes under way is done.
    """
    conf = df.sparkSession.conf
    with _LOCK:
        if not _WRITES["now"]:
            _WRITES["before"] = conf.get(CLEANUP, "false")
        _WRITES["now"] += 1
        conf.set(CLEANUP, "true")
    try:
        path = new_path(df.sparkSession, name)
        df.write.options(**options).parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        with _LOCK:
            _WRITES["now"] -= 1
            if not _WRITES["now"]:
                conf.set(CLEANUP, _WRITES["before"])


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Written once, and marked for broadcast if it then has few enough rows."""
    made = settle(df, "small")
    return F.broadcast(made) if made.count() <= rows else made
