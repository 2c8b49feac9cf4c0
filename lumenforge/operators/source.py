"""Raw Gaia rows from local copies of the archive's tables: source, distances, astrophysical parameters."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenforge.operators.common import require
from lumenforge.operators.gaia import CarryField

# The archive's column names, the solutions with a parallax, and the aliases that expressions may use
SOURCE_COLUMNS = ("source_id", "ra", "dec", "parallax", "parallax_error", "pmra", "pmdec", "phot_g_mean_mag", "phot_bp_mean_mag", "phot_rp_mean_mag", "ruwe")
DISTANCE_COLUMNS = ("r_med_geo", "r_lo_geo", "r_hi_geo", "r_med_photogeo", "r_lo_photogeo", "r_hi_photogeo")
PARAMETER_COLUMNS = (
    "mg_gspphot", "mg_gspphot_lower", "mg_gspphot_upper", "ag_gspphot", "teff_esphs", "teff_gspspec", "teff_espucd", "teff_gspphot",
    "teff_gspphot_lower", "teff_gspphot_upper", "logg_esphs", "logg_gspspec", "logg_gspphot", "logg_gspphot_lower", "logg_gspphot_upper",
)
SOLVED = (31, 95)
ALIASES = ("g", "d", "ap", "aps")


def aliases(expression: str) -> set[str]:
    """The table aliases that an expression names."""
    return set(re.findall(r"\b([A-Za-z]\w*)\.(?=[A-Za-z_])", expression))


def source_rows(source: DataFrame, distances: DataFrame, parameters: DataFrame, supplement: DataFrame | None = None, fields: tuple[CarryField, ...] = (), mag_limit: float | None = None, tiles: list[int] | None = None) -> DataFrame:
    """The core columns and the query-sourced fields of each source with a distance.

    source (alias g) needs astrometric_params_solved beside its core columns; distances (d) are an inner join, parameters (ap) and
    supplement (aps), which only fields ask for, left joins on source_id. All predicates are on g and d and reach their scans.
    tiles: tiles of order 3 of the source id.
    """
    asked = [f for f in fields if f.origin == "query"]
    if clash := sorted({f.name for f in asked} & {*SOURCE_COLUMNS, *DISTANCE_COLUMNS, *PARAMETER_COLUMNS}):
        raise ValueError(f"fields named like core columns: {', '.join(clash)}")
    used = set().union(*(aliases(f.expression) for f in asked))
    if unknown := sorted(used - set(ALIASES)):
        raise ValueError(f"unknown aliases: {', '.join(unknown)}")
    g = require(source, (*SOURCE_COLUMNS, "astrometric_params_solved"), "source table").alias("g").filter(F.col("astrometric_params_solved").isin(*SOLVED))
    if mag_limit is not None:
        g = g.filter(F.col("phot_g_mean_mag") <= mag_limit)
    if tiles is not None:
        if not tiles:
            raise ValueError("no tiles are given")
        g = g.filter(F.shiftright("source_id", 53).isin(*tiles))
    d = require(distances, ("source_id", *DISTANCE_COLUMNS), "distances").alias("d").filter("r_med_photogeo IS NOT NULL OR r_med_geo IS NOT NULL")
    rows = g.join(d, F.col("g.source_id") == F.col("d.source_id"))
    rows = rows.join(require(parameters, ("source_id", *PARAMETER_COLUMNS), "parameters").alias("ap"), F.col("ap.source_id") == F.col("g.source_id"), "left")
    if "aps" in used:
        if supplement is None:
            raise ValueError("fields use aps, but there is no supplement")
        rows = rows.join(supplement.alias("aps"), F.col("aps.source_id") == F.col("g.source_id"), "left")
    core = [F.col(f"{a}.{c}").alias(c) for a, columns in (("g", SOURCE_COLUMNS), ("d", DISTANCE_COLUMNS), ("ap", PARAMETER_COLUMNS)) for c in columns]
    return rows.select(*core, *(F.expr(f.expression).alias(f.name) for f in asked))
