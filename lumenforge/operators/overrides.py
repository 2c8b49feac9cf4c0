"""Curated overrides: add, replace or drop a star."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenforge.functions import ids
from lumenforge.functions.astrometry import cartesian
from lumenforge.functions.flags import DIST_SOURCE, DIST_VALID
from lumenforge.functions.nulls import number, or_null
from lumenforge.operators.common import conform, without
from lumenforge.operators.schemas import DENSE, OVERRIDE_EXTRA

ACTIONS = ("add", "replace", "drop")
FLAGS = DIST_SOURCE["OVERRIDE"] | DIST_VALID


def override_rows(raw: DataFrame) -> DataFrame:
    """Dense columns with override_id, action, override_reason, override_policy_version. Drop rows have no payload; others get
    Cartesian places from the spherical ones where all three are missing."""
    drop = ids.source_name(F.col("action")) == "drop"
    n = lambda c: number(raw, c)
    x, y, z = cartesian(n("ra_deg"), n("dec_deg"), n("r_pc"))
    given = [n(c) for c in ("x_icrs_pc", "y_icrs_pc", "z_icrs_pc")]
    count = sum((g.isNotNull().cast("int") for g in given[1:]), given[0].isNotNull().cast("int"))
    payload = {"x_icrs_pc": F.coalesce(given[0], x), "y_icrs_pc": F.coalesce(given[1], y), "z_icrs_pc": F.coalesce(given[2], z)}
    payload |= {c: n(c) for c in ("ra_deg", "dec_deg", "r_pc", "mag_abs", "teff")}
    payload |= {"quality_flags": F.lit(FLAGS), "astrometry_quality": F.lit(0.0), "photometry_quality": F.lit(0.0)}
    rows = raw.select(
        ids.source_name(F.col("source")).alias("source"), F.trim(F.col("source_id").cast("string")).alias("source_id"), *(F.when(~drop, v).alias(k) for k, v in payload.items()),
        or_null(raw, "override_id", "string").alias("override_id"), ids.source_name(F.col("action")).alias("action"), or_null(raw, "override_reason", "string").alias("override_reason"),
        or_null(raw, "override_policy_version", "string").alias("override_policy_version"), (~drop & count.isin(1, 2)).alias("_partial"),
    )
    named = lambda text: F.concat(F.lit("override "), F.coalesce("override_id", F.lit("NULL")), F.lit(f": {text}"))
    rows = without(rows, F.col("_partial"), named("x, y and z come together or not at all"))
    rows = without(rows, F.expr("action <> 'drop' AND (mag_abs IS NULL OR teff IS NULL OR ra_deg IS NULL OR dec_deg IS NULL OR r_pc IS NULL)"), named("incomplete"))
    return conform(rows, {**DENSE, **OVERRIDE_EXTRA})


def checked_overrides(rows: DataFrame) -> DataFrame:
    """rows with canonical actions, sources and keys; unknown actions, two overrides of one target, one override_id on two targets and
    drops with a payload fail the job that reads them. A row without an id has no target: it is no second one of another, and has no effect."""
    rows = rows.withColumn("action", ids.source_name(F.col("action"))).withColumn("key", ids.key(F.col("source"), F.col("source_id"))).withColumn("source", ids.source_name(F.col("source")))
    named = F.coalesce("override_id", F.lit("NULL"))
    rows = without(rows, ~F.coalesce(F.col("action").isin(*ACTIONS), F.lit(False)), F.concat(F.lit("override "), named, F.lit(": action "), F.coalesce("action", F.lit("NULL"))))
    payload = [c for c in DENSE if c not in ("source", "source_id")]
    rows = without(rows, (F.col("action") == "drop") & F.coalesce(*(F.col(c).cast("string") for c in payload)).isNotNull(), F.concat(F.lit("override "), named, F.lit(": a drop has no payload")))
    # overrides are curated by hand: a window over them is small
    target = F.count_if(F.col("action") != "add")
    rows = rows.withColumn("_n", target.over(Window.partitionBy("source", "key"))).withColumn("_m", target.over(Window.partitionBy("override_id")))
    aims = F.col("action") != "add"
    rows = without(rows, aims & F.col("key").isNotNull() & (F.col("_n") > 1), F.concat(F.lit("two overrides of "), F.coalesce("source", F.lit("NULL")), F.lit(" "), F.coalesce("key", F.lit("NULL"))))
    return without(rows, aims & (F.col("_m") > 1), F.concat(F.lit("override_id "), named, F.lit(" is on two targets"))).drop("_n", "_m")
