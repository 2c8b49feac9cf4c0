"""Names of stars from three catalogues, linked to both source catalogues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenforge.functions import ids
from lumenforge.functions.nulls import or_null
from lumenforge.operators.common import conform, first_by
from lumenforge.operators.schemas import IDENTIFIERS


def identifier_rows(hip_hd: DataFrame, catalogue: DataFrame, names: DataFrame, pairs: DataFrame | None = None, overrides: DataFrame | None = None, order: str | None = "input_order") -> DataFrame:
    """hip_hd (HIP, HD), catalogue (HIP, HD, Bayer, Fl, Cst), names (HD, Name), pairs (crossmatch), overrides (identifier rows).

    Repeated keys keep their first row by the column `order` where a table has it, else by their values; of a star's links the last
    counts, or the greatest. Override rows replace a catalogue
    row of the same source and source_id as a whole.
    """
    hip_hd, catalogue, names = (df.toDF(*(c.strip() for c in df.columns)) for df in (hip_hd, catalogue, names))
    number = lambda df, c: ids.positive_int(or_null(df, c, "string"))
    at = lambda df: F.col(order) if order and order in df.columns else F.lit(0)
    main = hip_hd.select(number(hip_hd, "HIP").alias("hip_id"), number(hip_hd, "HD").alias("hd_main"), at(hip_hd).alias("_at")).filter("hip_id IS NOT NULL AND hd_main IS NOT NULL")
    main = first_by(main, ["hip_id"], "_at", "hd_main").drop("_at")
    proper = names.select(number(names, "HD").alias("hd"), ids.proper_name(or_null(names, "Name", "string")).alias("proper_name"), at(names).alias("_at")).filter("hd IS NOT NULL AND proper_name IS NOT NULL")
    proper = first_by(proper, ["hd"], "_at", "proper_name").drop("_at")
    cst = ids.text(or_null(catalogue, "Cst", "string"))
    stars = catalogue.select(
        number(catalogue, "HIP").alias("hip_id"), number(catalogue, "HD").alias("hd"), ids.bayer(ids.text(or_null(catalogue, "Bayer", "string")), cst).alias("bayer"),
        number(catalogue, "Fl").alias("flamsteed"), cst.alias("constellation"), at(catalogue).alias("_at"),
    ).filter("hip_id IS NOT NULL")
    stars = first_by(stars, ["hip_id"], "_at", "hd", "bayer", "flamsteed", "constellation").drop("_at")
    out = stars.join(main, "hip_id", "full").withColumn("hd", F.coalesce("hd_main", "hd")).drop("hd_main").join(proper, "hd", "left")
    out = out.filter("bayer IS NOT NULL OR proper_name IS NOT NULL").withColumn("source", F.lit("hip")).withColumn("source_id", F.col("hip_id").cast("string"))
    if pairs is not None:
        links = pairs.select(F.col("hip_source_id").cast("long").alias("hip_id"), F.col("gaia_source_id").cast("long").alias("gaia_source_id"), at(pairs).alias("_at")).filter("hip_id IS NOT NULL AND gaia_source_id IS NOT NULL")
        out = out.join(first_by(links, ["hip_id"], "_at", "gaia_source_id", last=True).drop("_at"), "hip_id", "left")
    out = conform(out, IDENTIFIERS)
    if overrides is None:
        return out.orderBy("source", "source_id")
    # rows of one star stay in their own order
    new = overrides.select(*(or_null(overrides, c, t).alias(c) for c, t in IDENTIFIERS.items()), at(overrides).alias("_at"))
    out = out.join(new.select("source", "source_id").distinct(), ["source", "source_id"], "left_anti").select(*IDENTIFIERS)
    return out.unionByName(new, allowMissingColumns=True).orderBy("source", "source_id", "_at").drop("_at")


def labels(rows: DataFrame, order: str = "input_order") -> DataFrame:
    """source, source_id, label: proper name, else designation and constellation, else HD, else HIP number. Of repeated stars the first
    by the column `order` where there is one, else the least label."""
    at = F.col(order) if order in rows.columns else F.lit(0)
    rows = rows.select(*(or_null(rows, c, t).alias(c) for c, t in IDENTIFIERS.items()), at.alias("_at"))
    named = lambda prefix, c: F.when(F.col(c).isNotNull(), F.concat(F.lit(prefix), F.col(c).cast("string")))
    designation = F.when(ids.text(F.col("bayer")).isNotNull(), F.concat_ws(" ", ids.text(F.col("bayer")), ids.text(F.col("constellation"))))
    label = F.coalesce(ids.text(F.col("proper_name")), designation, named("HD ", "hd"), named("HIP ", "hip_id"))
    return first_by(rows.select("source", "source_id", label.alias("label"), "_at").filter("label IS NOT NULL"), ["source", "source_id"], "_at", "label").drop("_at")
