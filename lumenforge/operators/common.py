"""Checks and projections that several stages share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenforge.functions.nulls import or_null


#: HotSpot only interprets methods of more bytes than this; Spark's default lets a projection of many terms grow to eight times that.
_METHOD_SETTING, _METHOD_DEFAULT, METHOD_BYTES = "spark.sql.codegen.hugeMethodLimit", 65535, 8000


def compiled(spark: SparkSession) -> None:
    """Long projections become methods that the JVM compiles, unless the session has its own setting."""
    if int(spark.conf.get(_METHOD_SETTING, str(_METHOD_DEFAULT))) == _METHOD_DEFAULT:
        spark.conf.set(_METHOD_SETTING, str(METHOD_BYTES))


def require(df: DataFrame, columns, what: str) -> DataFrame:
    """df, if its schema has the columns; no job runs."""
    if missing := sorted(set(columns) - set(df.columns)):
        raise ValueError(f"{what}: missing columns {', '.join(missing)}")
    return df


def conform(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """The schema's columns in its order, NULL where df has none."""
    return df.select(*(or_null(df, c, t).alias(c) for c, t in schema.items()))


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*(c.strip().lower() for c in df.columns))


def fail_if(df: DataFrame, message) -> None:
    """Raises with the first row that should not be there."""
    if bad := df.limit(1).collect():
        raise ValueError(message(bad[0]) if callable(message) else message)


def without(df: DataFrame, bad: Column, message: Column) -> DataFrame:
    """df, whose reading fails with the message of a row that is bad: a check within the job that reads it."""
    return df.withColumn("_refused", F.when(F.coalesce(bad, F.lit(False)), F.raise_error(message).cast("string"))).filter("_refused IS NULL").drop("_refused")


def first_by(df: DataFrame, keys: list[str], *order, last: bool = False) -> DataFrame:
    """The first row of each key, or the last: a partial aggregate, so a hot key is not gathered."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg((F.max_by if last else F.min_by)(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*keys, *(F.col("_row")[c].alias(c) for c in rest)).select(*df.columns)
