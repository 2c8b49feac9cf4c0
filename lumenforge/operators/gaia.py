"""Gaia stage: raw rows to dense star rows. One projection, no shuffle."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenforge.functions import astrometry as A
from lumenforge.functions import photometry as P
from lumenforge.functions.flags import PHOT_SOURCE, distance_flags, with_sources
from lumenforge.functions.nulls import finite, number, yes
from lumenforge.operators.common import compiled
from lumenforge.operators.schemas import DENSE

CARRY_TYPES = {"float64": "double", "int64": "long", "uint64": "decimal(20,0)", "string": "string", "bool": "boolean"}


@dataclass(frozen=True)
class CarryField:
    """An extra column of the output, gaia_<name>.

    origin: "input" takes it from the input as it comes, "stage" from the stage's own columns, and "query" from the input column of
    its name, which source_rows() makes by `expression`. sidecar names the table that it goes to.
    """

    name: str
    dtype: str = "float64"
    origin: str = "input"
    column: str | None = None
    expression: str | None = None
    sidecar: str | None = None
    unit: str | None = None

    @property
    def output(self) -> str:
        return f"gaia_{self.name}"


def whole(value: Column, source: str, kind: str) -> Column:
    """A whole number of `kind`, halves to even: whole numbers and whole text keep all their digits, NULL where it doesn't fit."""
    rounded = F.bround(value.try_cast("double")).try_cast("decimal(38,0)").try_cast(kind)
    if source in ("tinyint", "smallint", "int", "bigint", "boolean"):
        out = value.try_cast(kind)
    elif source == "string":
        out = F.when(value.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(value).try_cast("decimal(38,0)").try_cast(kind)).otherwise(rounded)
    elif source.startswith("decimal"):
        out = F.bround(value, 0).try_cast(kind)
    else:
        out = rounded
    if kind == "decimal(20,0)":  # unsigned, of 64 bits
        out = F.when(out.between(F.lit(0).cast("decimal(20,0)"), F.lit(str(2**64 - 1)).cast("decimal(20,0)")), out)
    return out


def _carried(field: CarryField, column: str | None, kinds: dict[str, str]) -> Column:
    kind = CARRY_TYPES[field.dtype]
    if column not in kinds:
        return F.lit(None).cast(kind).alias(field.output)
    value = F.col(column)
    return (whole(value, kinds[column], kind) if field.dtype in ("int64", "uint64") else value.try_cast(kind)).alias(field.output)


def within_magnitude(df: DataFrame, limit: float | None) -> DataFrame:
    """Rows of phot_g_mean_mag up to the limit; rows without one go. No limit keeps all."""
    return df if limit is None else df.filter(yes(number(df, "phot_g_mean_mag") <= limit))


def gaia_stage(raw: DataFrame, mag_limit: float | None = None, carry: tuple[CarryField, ...] = (), faintest: float | None = None) -> DataFrame:
    """Dense rows with ruwe, phot_g_mean_mag and the carried fields. faintest: only rows of an absolute magnitude up to it."""
    compiled(raw.sparkSession)
    df = within_magnitude(raw, mag_limit)
    # the stage's own columns may take an input column's name
    taken = {f: f"_in_{k}" for k, f in enumerate(carry) if f.origin != "stage" and (f.column or f.name) in raw.columns}
    df = df.withColumns({alias: F.col(f.column or f.name) for f, alias in taken.items()})
    n = lambda name: number(df, name)
    df = df.withColumn("bp_rp", n("phot_bp_mean_mag") - n("phot_rp_mean_mag"))
    g, mg, ag = n("phot_g_mean_mag"), n("mg_gspphot"), n("ag_gspphot")
    geo = (n("r_lo_geo"), n("r_med_geo"), n("r_hi_geo"))
    photogeo = (n("r_lo_photogeo"), n("r_med_photogeo"), n("r_hi_photogeo"))
    df = df.withColumn("_d", A.tiered_distance(n("parallax"), n("parallax_error"), geo, photogeo, g, mg, ag))
    distance, quality = F.col("_d.distance"), F.col("_d.quality")
    has_mg = yes((mg > -10) & (mg < 15))
    absorbed = yes((ag >= 0) & (ag < 5))
    mag = F.when(has_mg, mg).when(absorbed, P.absolute_magnitude(g, distance, ag)).otherwise(P.absolute_magnitude(g, distance))
    if faintest is not None:
        # observed, so that the filter is not pushed below the distance, of whose long expression it would hold several copies
        df = df.withColumn("_mag", mag).observe("gaia rows", F.count("*").alias("n")).filter(F.col("_mag") <= faintest)
        mag = F.col("_mag")
    df = df.withColumn("_p", A.propagated(n("ra"), n("dec"), distance, n("pmra"), n("pmdec"), F.coalesce(n("ref_epoch"), F.lit(A.TARGET_EPOCH)) if "ref_epoch" in df.columns else F.lit(A.TARGET_EPOCH)))
    df = df.withColumn("_t", P.teff_cascade(n("teff_esphs"), n("teff_gspspec"), n("teff_espucd"), n("teff_gspphot"), F.col("bp_rp"), n("bv")))
    spread = F.abs(n("mg_gspphot_upper") - n("mg_gspphot_lower")) / 2.0
    flags = with_sources(distance_flags(F.col("_d.source"), distance, F.col("_d.review")), F.lit(PHOT_SOURCE["GAIA_G"]), F.col("_t.source"))
    stage = df.withColumns({
        "mag_abs": mag, "teff": F.col("_t.teff"), "quality_flags": flags, "astrometry_quality": quality,
        "photometry_quality": F.when(has_mg, F.when(finite(spread), spread)).otherwise(F.lit(P.MAG_ERROR) * quality),
        "distance_use_pc": distance, "r_lo_pc": F.col("_d.lo"), "r_hi_pc": F.col("_d.hi"),
    })
    kinds = dict(stage.dtypes)
    place = {"x_icrs_pc": "x", "y_icrs_pc": "y", "z_icrs_pc": "z", "ra_deg": "ra", "dec_deg": "dec", "r_pc": "r"}
    dense = [F.lit("gaia").alias("source"), F.col("source_id").cast("long").alias("source_id"), *(F.col(f"_p.{v}").alias(k) for k, v in place.items())]
    dense += [F.col(c) for c in list(DENSE)[8:]]
    return stage.select(*dense, n("ruwe").alias("ruwe"), g.alias("phot_g_mean_mag"), *(_carried(f, (f.column or f.name) if f.origin == "stage" else taken.get(f), kinds) for f in carry))


def tile_counts(rows: DataFrame, order: int = 3) -> DataFrame:
    """Rows by nested tile of the source id, most first, ties by tile."""
    tile = F.shiftright(F.col("source_id").cast("long"), 59 - 2 * order).cast("int")
    return rows.groupBy(tile.alias("hp3")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "hp3")
