"""Missing values. Inside the engine a missing number is NULL; NaN is turned into NULL where data come in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

INF = float("inf")


def nan_to_null(df: DataFrame) -> DataFrame:
    """df with NULL for NaN in every floating-point column."""
    kinds = {f.name: f.dataType for f in df.schema}
    return df.select(*(F.nanvl(F.col(f"`{n}`"), F.lit(None).cast(t)).alias(n) if isinstance(t, (DoubleType, FloatType)) else F.col(f"`{n}`") for n, t in kinds.items()))


def finite(c: Column) -> Column:
    """True or false, never NULL."""
    return F.coalesce((c < INF) & (c > -INF), F.lit(False))


def positive(c: Column) -> Column:
    """Finite and above zero."""
    return F.coalesce((c > 0) & (c < INF), F.lit(False))


def yes(c: Column) -> Column:
    """A predicate with NULL read as false, safe to negate."""
    return F.coalesce(c, F.lit(False))


def score(c: Column) -> Column:
    """A finite score, else infinity."""
    return F.when(finite(c), c).otherwise(F.lit(INF))


def number(df: DataFrame, name: str) -> Column:
    """A column as double; NULL where the table has none of that name or the text is no number."""
    return F.nanvl(F.col(name).try_cast("double"), F.lit(None).cast("double")) if name in df.columns else F.lit(None).cast("double")


def or_null(df: DataFrame, name: str, kind: str) -> Column:
    """A column as `kind`, NULL if absent or unfit."""
    return F.col(name).try_cast(kind) if name in df.columns else F.lit(None).cast(kind)
