"""Audit of a merge: suspicious pairs and rows, with labels and counts. Issue types, severities and reasons are fixed values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenforge.functions.nulls import INF, or_null, yes
from lumenforge.operators.common import conform, first_by
from lumenforge.operators.merge import STANDARD_SOLUTION, filter_bits, id_filter, may_hold
from lumenforge.operators.schemas import ISSUES
from lumenforge.sources.tables import occupied, write_report, write_table

# Fixed default thresholds
THRESHOLDS = {"distance": 0.25, "severe_ratio": 2.0, "ruwe": 1.4, "astrometry": 1.0, "extreme_mag": -10.0, "luminous_mag": -8.0, "remote_pc": 20_000.0}


def override_keys(overrides: DataFrame) -> DataFrame:
    """Distinct source and source_id of overrides, as they are written."""
    return overrides.filter(F.col("action").isin("replace", "drop", "add")).select(F.col("source").cast("string"), F.col("source_id").cast("string")).distinct()


def _number(c: str):
    """The whole number that an id's text stands for."""
    return F.regexp_replace(F.trim(c), r"\.0$", "").try_cast("long")


def _side(rows: DataFrame, asked: DataFrame, name: str, more: dict[str, str]) -> DataFrame:
    """Of a catalogue, the rows whose ids are asked for: they alone are put together by id. A bit filter of the ids parts most others off
    where they are read, before they are shuffled."""
    bits = filter_bits(asked.count())
    words = id_filter(asked.select(F.col("_id").alias("id")), bits)
    rows = rows.withColumn("_id", F.col("source_id").cast("long")).filter("_id IS NOT NULL").filter(may_hold(words.scalar(), F.col("_id"), bits)).join(asked, "_id", "left_semi")
    cols = {"r_pc": "double", "mag_abs": "double", "astrometry_quality": "double", **more}
    df = rows.select(F.col("_id").alias(f"{name}_num"), *(or_null(rows, c, t).alias(f"{name}_{c}") for c, t in cols.items()))
    return first_by(df, [f"{name}_num"], *(c for c in df.columns if c != f"{name}_num"))


def pair_issues(decisions: DataFrame, gaia: DataFrame, hip: DataFrame, keys: DataFrame, limits: dict[str, float] | None = None) -> DataFrame:
    """Scored pairs whose two distances disagree and whose winner is doubtful."""
    t = THRESHOLDS | (limits or {})
    d = conform(decisions, {c: k for c, k in decisions.dtypes}).filter("decision_type = 'score'")
    d = d.withColumn("g_num", _number("gaia_source_id")).withColumn("h_num", _number("hip_source_id")).filter("g_num IS NOT NULL AND h_num IS NOT NULL")
    g = _side(gaia, d.select(F.col("g_num").alias("_id")), "g", {"ruwe": "double"})
    h = _side(hip, d.select(F.col("h_num").alias("_id")), "h", {"Sn": "int"})
    p = d.join(g, "g_num", "left").join(h, "h_num", "left")
    # covered is what an override names by the plain number
    for source, number, mark in (("gaia", "g_num", "c_g"), ("hip", "h_num", "c_h")):
        named = keys.filter(F.col("source") == source).select(F.col("source_id").alias("_key"), F.lit(True).alias(mark)).distinct()
        p = p.join(named, F.col(number).cast("string") == F.col("_key"), "left").drop("_key")
    p = p.withColumn("g_score", F.coalesce("gaia_score", "g_astrometry_quality")).withColumn("h_score", F.coalesce("hip_score", "h_astrometry_quality"))
    p = p.withColumn("ruwe_", F.coalesce("gaia_ruwe", "g_ruwe")).withColumn("sn_", F.coalesce("hip_solution_type", "h_Sn"))
    # a distance of zero beside one that is not is infinitely far off
    far, close = F.greatest("g_r_pc", "h_r_pc"), F.least("g_r_pc", "h_r_pc")
    ratio = F.when((close == 0) & (far > 0), F.lit(INF)).otherwise(F.try_divide(far, close))
    p = p.withColumn("ratio", F.when(F.col("g_r_pc").isNotNull() & F.col("h_r_pc").isNotNull(), ratio))
    p = p.withColumn("not_lowest", yes((F.col("g_score") < F.col("h_score")) & (F.col("winner_catalog") != "gaia")) | yes((F.col("h_score") < F.col("g_score")) & (F.col("winner_catalog") != "hip")))
    p = p.withColumn("high_ruwe", yes(F.col("ruwe_") > t["ruwe"])).withColumn("odd", yes(F.col("sn_") != STANDARD_SOLUTION)).withColumn("severe", yes(F.col("ratio") >= t["severe_ratio"]))
    doubtful = F.col("not_lowest") | (F.col("high_ruwe") & (F.col("odd") | F.col("severe")))
    p = p.filter(yes(F.col("ratio") - 1.0 > t["distance"]) & doubtful & F.col("c_g").isNull() & F.col("c_h").isNull())
    tag = lambda c, text: F.when(F.col(c), F.lit(text))
    reasons = F.concat_ws(";", F.lit("distance_disagreement"), tag("not_lowest", "winner_not_lowest_astrometry_score"), tag("high_ruwe", "gaia_high_ruwe"), tag("odd", "hip_non_standard_solution"), tag("severe", "severe_distance_disagreement"))
    high = F.col("not_lowest") | (F.col("high_ruwe") & F.col("odd")) | F.col("severe")
    return p.select(
        F.lit("matched_pair_conflict").alias("issue_type"), F.when(high, F.lit("high")).otherwise(F.lit("medium")).alias("severity"), reasons.alias("reasons"), F.lit("hip").alias("source"),
        F.col("h_num").cast("string").alias("source_id"), F.col("g_num").cast("string").alias("gaia_source_id"), F.col("h_num").cast("string").alias("hip_source_id"), "winner_catalog",
        "winner_source_id", "tie_break_reason", F.col("ratio").alias("distance_ratio"), (F.col("ratio") - 1.0).alias("distance_frac_diff"), (F.col("g_mag_abs") - F.col("h_mag_abs")).alias("mag_abs_delta"),
        F.col("g_r_pc").alias("gaia_r_pc"), F.col("h_r_pc").alias("hip_r_pc"), F.col("g_mag_abs").alias("gaia_mag_abs"), F.col("h_mag_abs").alias("hip_mag_abs"), F.col("g_score").alias("gaia_score"),
        F.col("h_score").alias("hip_score"), F.col("ruwe_").alias("gaia_ruwe"), F.col("sn_").alias("hip_solution_type"), "number_of_neighbours", "angular_distance_arcsec", F.lit(False).alias("overridden"),
    )


def faintest(limits: dict[str, float] | None = None) -> float:
    """The largest absolute magnitude of a row that row_issues() may report."""
    t = THRESHOLDS | (limits or {})
    return max(t["extreme_mag"], t["luminous_mag"])


def row_issues(dense: DataFrame, keys: DataFrame, limits: dict[str, float] | None = None) -> DataFrame:
    """Merged rows that are implausibly bright, or bright with poor astrometry or from far away."""
    t = THRESHOLDS | (limits or {})
    m, q, r = F.col("mag_abs"), F.col("astrometry_quality"), F.col("r_pc")
    luminous = m <= t["luminous_mag"]
    flagged = dense.withColumn("extreme", yes(m <= t["extreme_mag"])).withColumn("poor", yes(luminous & (q >= t["astrometry"]))).withColumn("remote", yes(luminous & (r >= t["remote_pc"])))
    flagged = flagged.filter("extreme OR poor OR remote").join(keys, ["source", "source_id"], "left_anti")
    tag = lambda c, text: F.when(F.col(c), F.lit(text))
    return flagged.select(
        F.lit("merged_row_extreme").alias("issue_type"), F.when(F.col("extreme"), F.lit("high")).otherwise(F.lit("medium")).alias("severity"),
        F.concat_ws(";", tag("extreme", "extreme_absolute_magnitude"), tag("poor", "low_quality_astrometry_for_luminous_row"), tag("remote", "remote_luminous_row")).alias("reasons"),
        "source", "source_id", F.col("ra_deg").alias("merged_ra_deg"), F.col("dec_deg").alias("merged_dec_deg"), r.alias("merged_r_pc"), m.alias("merged_mag_abs"), F.col("teff").alias("merged_teff"),
        "astrometry_quality", "photometry_quality", F.lit(False).alias("overridden"),
    )


def quality_issues(decisions: DataFrame, gaia: DataFrame, hip: DataFrame, dense: DataFrame, overrides: DataFrame, labels: DataFrame | None = None, limits: dict[str, float] | None = None) -> DataFrame:
    keys = override_keys(overrides)
    issues = pair_issues(decisions, gaia, hip, keys, limits).unionByName(row_issues(dense, keys, limits), allowMissingColumns=True)
    if labels is not None:
        issues = issues.join(labels, ["source", "source_id"], "left").withColumn("label", F.coalesce("label", F.lit("")))
    return conform(issues, ISSUES)


# Fixed names of the thresholds in a report
REPORTED = {
    "distance_disagreement_threshold": "distance", "severe_distance_ratio": "severe_ratio", "ruwe_threshold": "ruwe", "high_astrometry_quality": "astrometry",
    "extreme_abs_mag": "extreme_mag", "luminous_abs_mag": "luminous_mag", "remote_luminous_pc": "remote_pc",
}
# Fixed names of the paths in a report
PATHS = ("gaia_dir", "hip_path", "crossmatch_path", "overrides_path", "merge_dir", "issues_path")


def issue_counts(issues: DataFrame) -> DataFrame:
    return issues.groupBy("issue_type", "severity").agg(F.count("*").alias("n")).orderBy("issue_type", "severity")


def audit_summary(issues: DataFrame, decisions: DataFrame, overrides: DataFrame) -> DataFrame:
    """One row: scored and override decisions, distinct override targets, issues by kind, and maps of counts by type and severity."""
    n = lambda condition, name: F.count_if(condition).alias(name)
    kind = F.col("issue_type")
    d = decisions.agg(n(F.col("decision_type") == "score", "score_decisions"), n(F.coalesce(F.col("decision_type") != "score", F.lit(True)), "override_decisions"))
    o = override_keys(overrides).agg(F.count("*").alias("override_targets"))
    i = issues.agg(n(kind == "matched_pair_conflict", "matched_pair_issues"), n(kind == "merged_row_extreme", "merged_row_issues"), F.count("*").alias("total_issues"))
    out = d.join(o, F.lit(True)).join(i, F.lit(True))  # one row each
    for column, name in (("issue_type", "issue_counts_by_type"), ("severity", "issue_counts_by_severity")):
        counted = issues.groupBy(column).agg(F.count("*").alias("n"))
        out = out.join(counted.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(column, "n")))).alias(name)), F.lit(True))
    return out


def _known(limits: dict[str, float] | None, paths: dict[str, str] | None) -> tuple[dict[str, float], dict[str, str]]:
    limits, paths = limits or {}, paths or {}
    if unknown := [*(limits.keys() - THRESHOLDS.keys()), *(paths.keys() - set(PATHS))]:
        raise ValueError(f"unknown names: {', '.join(sorted(unknown))}")
    return limits, paths


def audit_report(issues: DataFrame, decisions: DataFrame, overrides: DataFrame, limits: dict[str, float] | None = None, paths: dict[str, str] | None = None) -> DataFrame:
    """audit_summary() with the paths that were read and written (null where none is given) and the thresholds that held; one row.

    A limit or path of another name is an error."""
    limits, paths = _known(limits, paths)
    held = THRESHOLDS | limits
    thresholds = F.create_map(*(v for name, own in REPORTED.items() for v in (F.lit(name), F.lit(float(held[own])))))
    row = audit_summary(issues, decisions, overrides)
    return row.select(*(F.lit(paths.get(p)).cast("string").alias(p) for p in PATHS), thresholds.alias("thresholds"), *row.columns)


def write_audit(spark: SparkSession, inputs: dict[str, DataFrame], folder: str, limits: dict[str, float] | None = None, paths: dict[str, str] | None = None, mode: str = "errorifexists") -> dict:
    """The audit of a merge as issues.parquet and report.json in `folder`; returns the report. The issues are written once and counted
    from what was written. `inputs`: decisions, gaia, hip, dense, overrides and, if there are any, labels, as in quality_issues().
    `mode` is as in write_table(), without ignore: where there are issues or a report, nothing is written unless it is overwrite."""
    at, report = f"{folder.rstrip('/')}/issues.parquet", f"{folder.rstrip('/')}/report.json"
    limits, paths = _known(limits, paths)
    if mode not in ("errorifexists", "overwrite"):
        raise ValueError(f"mode {mode!r}")
    if mode == "errorifexists" and occupied(spark, report):
        raise FileExistsError(f"{report} already exists")
    write_table(quality_issues(**inputs, limits=limits), at, mode=mode)
    return write_report(audit_report(spark.read.parquet(at), inputs["decisions"], inputs["overrides"], limits, {**paths, "issues_path": at}), report)
