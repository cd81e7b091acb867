"""Column ranges and the narrowest numeric type that holds them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_REAL = (T.FloatType, T.DoubleType)
# fixed values: bounds of the types, none of which may be reached
_WHOLE_BOUNDS = (
    ("tinyint", -(2**7), 2**7 - 1),
    ("smallint", -(2**15), 2**15 - 1),
    ("int", -(2**31), 2**31 - 1),
    ("bigint", -(2**63), 2**63 - 1),
)
_FLOAT_MAX = 3.4028234663852886e38


def _numeric(df: DataFrame) -> list[T.StructField]:
    return [f for f in df.schema.fields if isinstance(f.dataType, _WHOLE + _REAL)]


def range_profile(df: DataFrame) -> DataFrame:
    """One row per numeric column: least, greatest and the type its range fits.

    All ranges come from one aggregate over the table.
    """
    fields = _numeric(df)
    one = df.agg(*[
        c for f in fields for c in (
            F.min(F.col(f"`{f.name}`")).cast("double").alias(f"{f.name}_lo"),
            F.max(F.col(f"`{f.name}`")).cast("double").alias(f"{f.name}_hi"),
        )
    ])
    rows = F.array(*[
        F.struct(
            F.lit(f.name).alias("column"),
            F.col(f"`{f.name}_lo`").alias("least"), F.col(f"`{f.name}_hi`").alias("greatest"),
            F.lit(f.dataType.simpleString()).alias("stored"),
        )
        for f in fields
    ])
    lo, hi = F.col("least"), F.col("greatest")
    whole = F.col("stored").isin("tinyint", "smallint", "int", "bigint")
    fit = F.col("stored")
    for name, low, high in reversed(_WHOLE_BOUNDS):
        fit = F.when(whole & (lo > F.lit(float(low))) & (hi < F.lit(float(high))), F.lit(name)).otherwise(fit)
    small = ~whole & (lo > F.lit(-_FLOAT_MAX)) & (hi < F.lit(_FLOAT_MAX))
    fit = F.when(small, F.lit("float")).otherwise(fit)
    return one.select(F.inline(rows)).select("column", "least", "greatest", "stored", fit.alias("fitting"))


def narrow_types(df: DataFrame) -> DataFrame:
    """``df`` with every numeric column in the narrowest type of its range.

    The profile (one row per column) is read first, since types are part of the plan.
    Half-precision does not exist in Spark; reals become ``float`` where they fit.
    """
    fit = {r["column"]: r["fitting"] for r in range_profile(df).collect()}
    return df.select(*[
        F.col(f"`{c}`").cast(fit[c]).alias(c) if c in fit else F.col(f"`{c}`") for c in df.columns
    ])
