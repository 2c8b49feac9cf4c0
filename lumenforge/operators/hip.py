"""Hipparcos stage: the same dense rows from a second catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lumenforge.functions import astrometry as A
from lumenforge.functions import photometry as P
from lumenforge.functions.flags import DIST_SOURCE, PHOT_SOURCE, TEFF_SOURCE, distance_flags, with_sources
from lumenforge.functions.ids import positive_int
from lumenforge.functions.nulls import finite, number, or_null, positive
from lumenforge.operators.common import require
from lumenforge.operators.schemas import DENSE

# The catalogue's own column names, and its epoch
REQUIRED = ("HIP", "RArad", "DErad", "Plx", "e_Plx", "pmRA", "pmDE", "Hpmag", "B-V")
EPOCH = 1991.25


def hip_stage(raw: DataFrame, limit: int | None = None, order: str | None = None, log_g: bool = False, observation: Observation | None = None) -> DataFrame:
    """Dense rows with Sn and Hpmag; rows without a finite distance go. `limit` keeps the first rows by `order`: the
    column input_order where the input has one (it goes on to the output), else source_id. The catalogue
    knows no surface gravity: with `log_g` there is a column of that name, all NULL. observation: gets `rows` read and
    `dropped` from the job that reads the stage."""
    df = require(raw, REQUIRED, "HIP catalogue").withColumnRenamed("B-V", "bv")
    n = lambda name: number(df, name)
    plx, error = n("Plx"), n("e_Plx")
    distance, quality = A.parallax_distance(plx), A.fractional_error(plx, error)
    df = df.withColumn("_p", A.propagated(n("RArad"), n("DErad"), distance, n("pmRA"), n("pmDE"), F.lit(EPOCH)))
    teff = P.teff_from_bv(n("bv"))
    source = F.when(n("bv").isNotNull(), F.lit(TEFF_SOURCE["BV"])).otherwise(F.lit(TEFF_SOURCE["DEFAULT"]))
    flags = with_sources(distance_flags(F.lit(DIST_SOURCE["HIP"]), distance, ~(positive(plx) & positive(error))), F.lit(PHOT_SOURCE["HIP_HP"]), source)
    place = {"x_icrs_pc": "x", "y_icrs_pc": "y", "z_icrs_pc": "z", "ra_deg": "ra", "dec_deg": "dec", "r_pc": "r"}
    if observation:
        df = df.observe(observation, F.count("*").alias("rows"), F.count_if(~finite(distance)).alias("dropped"))
    out = df.filter(finite(distance)).select(
        F.lit("hip").alias("source"), positive_int(F.col("HIP")).alias("source_id"), *(F.col(f"_p.{v}").alias(k) for k, v in place.items()),
        P.absolute_magnitude(n("Hpmag"), distance).alias("mag_abs"), F.coalesce(teff, F.lit(P.DEFAULT_TEFF)).alias("teff"), flags.alias("quality_flags"),
        quality.alias("astrometry_quality"), (F.lit(P.MAG_ERROR) * quality).alias("photometry_quality"), or_null(df, "Sn", "int").alias("Sn"), n("Hpmag").alias("Hpmag"),
        *([F.col("input_order")] if "input_order" in df.columns else []),
    )
    out = out.withColumn("log_g", P.logg_cascade()) if log_g else out
    assert out.columns[: len(DENSE)] == list(DENSE)
    by = order or ("input_order" if "input_order" in out.columns else "source_id")
    return out if limit is None else out.orderBy(by).limit(limit)
