"""Crossmatch of the two catalogues: valid pairs, once each, in order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenforge.functions.ids import positive_int
from lumenforge.functions.nulls import or_null
from lumenforge.operators.common import conform, fail_if, first_by, lower_names
from lumenforge.operators.schemas import CROSSMATCH

MAPPING_SOURCE = "gaia_hip_crossmatch"


def crossmatch_map(raw: DataFrame, mapping_source: str = MAPPING_SOURCE, order: str | None = None) -> DataFrame:
    """gaia_source_id, hip_source_id, mapping_source, number_of_neighbours, angular_distance from raw source_id and
    original_ext_source_id. Repeated pairs keep the first by `order` or the column input_order (without either, by their other columns)."""
    df = lower_names(raw)
    order = order or ("input_order" if "input_order" in df.columns else None)
    if not {"source_id", "original_ext_source_id"} <= set(df.columns):
        return conform(df.limit(0), CROSSMATCH)
    pairs = df.select(
        positive_int(F.col("source_id")).alias("gaia_source_id"), positive_int(F.col("original_ext_source_id")).alias("hip_source_id"),
        F.lit(mapping_source).alias("mapping_source"), F.coalesce(or_null(df, "number_of_neighbours", "short"), F.lit(0).cast("short")).alias("number_of_neighbours"),
        or_null(df, "angular_distance", "float").alias("angular_distance"), *([F.col(order).alias("_order")] if order else []),
    ).filter("gaia_source_id IS NOT NULL AND hip_source_id IS NOT NULL")
    by = ["_order"] if order else ["number_of_neighbours", "angular_distance"]
    return first_by(pairs, ["gaia_source_id", "hip_source_id"], *by).select(*CROSSMATCH).orderBy("gaia_source_id", "hip_source_id")


def require_one_to_one(pairs: DataFrame) -> DataFrame:
    """pairs, if no id of either side is linked to two of the other."""
    for one, other in (("gaia_source_id", "hip_source_id"), ("hip_source_id", "gaia_source_id")):
        twice = pairs.groupBy(one).agg(F.min(other).alias("least"), F.max(other).alias("most")).filter("least <> most")
        fail_if(twice, lambda r, one=one: f"{one} {r[one]} is linked to {r['least']} and {r['most']}")
    return pairs
