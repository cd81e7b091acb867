"""Readers and writers of the pipeline's tables (CSV or Parquet)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clock import parse_release
from tidemark.operators.prepare import localize
from tidemark.session import settle
from tidemark.sources.schema import BEHAVIORS, ITEM_COLUMNS, ITEMS_TEXT, LABELS, PREDICTIONS


def _read(
    spark: SparkSession, path: str, fmt: str | None, schema: T.StructType, strict: bool = True
) -> DataFrame:
    """By header name, in whatever order the file has the columns.

    A value that its type cannot hold fails the job, whatever the session's settings; without
    ``strict`` it is NULL, and ``rejects`` counts those.
    """
    def typed(f: T.StructField):
        raw = F.col(f"`{f.name}`")
        value = raw.try_cast(f.dataType)
        fails = F.raise_error(F.concat(F.lit(f"{f.name} is no {f.dataType.simpleString()}: "), raw)).cast(f.dataType)
        return (F.when(raw.isNull() | value.isNotNull(), value).otherwise(fails) if strict else value).alias(f.name)

    fmt = fmt or ("csv" if ".csv" in path.rsplit("/", 1)[-1] else "parquet")
    if fmt == "csv":
        raw = spark.read.option("header", True).csv(path)
        return raw.select(*map(typed, schema))
    return spark.read.schema(schema).format(fmt).load(path)


def rejects(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One row: for each column, the values of a CSV table that its type cannot hold."""
    raw = spark.read.option("header", True).csv(path)
    return raw.agg(*[
        F.count_if(F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull()).alias(f.name)
        for f in schema
    ])


def read_lines(
    spark: SparkSession, path: str, schema: T.StructType, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """The good rows of a CSV table, and its broken lines (``line``) with their text.

    Broken are lines with fewer or more fields than the file has, with a value that its declared type
    cannot hold, or with a quote that does not fit. A value that is left out is NULL, not broken.
    With a header columns are matched by name, in whatever order the file has them, and all that are
    not declared are texts; without one the file has the declared columns. The lines are parsed once and stored.
    """
    names = spark.read.option("header", True).csv(path).columns if header else schema.names
    kinds = {f.name: f.dataType for f in schema}
    declared = T.StructType([T.StructField(n, kinds.get(n, T.StringType())) for n in names] + [T.StructField("_line", T.StringType())])
    parsed = spark.read.schema(declared).options(
        header=header, mode="PERMISSIVE", columnNameOfCorruptRecord="_line", columnPruning=False, enforceSchema=True).csv(path)
    parsed = settle(parsed, "lines")
    good = parsed.where("_line IS NULL").select(*[F.col(f"`{f.name}`") for f in schema])
    return good, parsed.where("_line IS NOT NULL").select(F.col("_line").alias("line"))


def write_by_day(events: DataFrame, path: str) -> None:
    """Events with their local day, one folder per day: what asks for some days reads those only.

    Rows are dealt by ranges of day and user, so a busy day has several files and a quiet one few.
    """
    rows = events if "date_day" in events.columns else localize(events)
    rows.drop("date").repartitionByRange("date_day", "did").write.partitionBy("date_day").parquet(path)


def read_by_day(spark: SparkSession, path: str) -> DataFrame:
    """Events stored by ``write_by_day``; conditions on ``date_day`` choose folders."""
    rows = spark.read.parquet(path)
    return rows.withColumn("date", F.timestamp_seconds("timestamp")) if "date" not in rows.columns else rows


def read_behaviors(spark: SparkSession, path: str, fmt: str | None = None, strict: bool = True) -> DataFrame:
    return _read(spark, path, fmt, BEHAVIORS, strict)


def read_items(
    spark: SparkSession, path: str, fmt: str | None = None, items_tz: str = "UTC", strict: bool = True
) -> DataFrame:
    """The item table with its release time as an instant, unused columns left out."""
    raw = _read(spark, path, fmt, ITEMS_TEXT, strict)
    return raw.withColumn("online_time", parse_release(F.col("online_time"), items_tz)).select(*ITEM_COLUMNS)


def read_samples(
    spark: SparkSession, path: str, fmt: str | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """A stored sample table. As CSV its types come from ``schema``; without one, everything
    but the keys and counts is a double."""
    fmt = fmt or "parquet"
    if schema is not None:
        return _read(spark, path, fmt, schema)
    if fmt != "csv":
        return spark.read.format(fmt).load(path)
    raw = spark.read.option("header", True).csv(path)
    whole = {"active_days", "watch_nums"}
    text = {"did", "split"}
    return raw.select(*[
        F.col(f"`{c}`") if c in text else F.col(f"`{c}`").cast("long" if c in whole else "double").alias(c)
        for c in raw.columns
    ])


def read_predictions(spark: SparkSession, path: str, fmt: str | None = "csv") -> DataFrame:
    return _read(spark, path, fmt, PREDICTIONS)


def write_samples(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """One folder per split, so a training job reads only the splits it wants."""
    if fmt == "csv":
        df.write.option("header", True).csv(path)
    elif "split" in df.columns:
        df.write.partitionBy("split").format(fmt).save(path)
    else:
        df.write.format(fmt).save(path)


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """A few rows to look at, those of the smallest values from the first column on."""
    return df.orderBy(*df.columns).limit(rows)


def write_predictions(df: DataFrame, path: str) -> None:
    """In the order of the users: a range sort, so the files follow each other."""
    df.select("did", *LABELS).orderBy("did").write.option("header", True).csv(path)


def write_importance(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)
