"""Merge: one canonical star table from two catalogues, their crossmatch and overrides.

Everything is decided by joins on ids; no row depends on the order in which others are met. Few rows of the large catalogue have a link
or an override. A bit filter of the linked ids, made from the small sides, parts the others off where they are read: they need no
join and are never shuffled, whatever the small sides' size. What the filter lets through is joined and staged; all that its rows emit
is decided in one row each, written once, and dense rows, decisions and sidecar are read from there. Counters are observed on
those writes, and rows that should not be there fail them: the only job for a count alone is one over the linked ids, which says how long their
filter is. Texts in the outputs
(decision types, notes, reasons) are fixed values.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from lumenforge.functions.healpix import pixel
from lumenforge.functions.nulls import finite, or_null, score, yes
from lumenforge.functions.photometry import apparent_magnitude
from lumenforge.operators.common import compiled, first_by, require, without
from lumenforge.operators.overrides import checked_overrides
from lumenforge.operators.schemas import DECISIONS, DENSE
from lumenforge.sources.staging import at_once, removed, staged

# Fixed values of the winner policy: magnitude limits, shares that the second catalogue must beat, its standard solution
BRIGHT, MIDDLE = 3.5, 6.0
MARGINS = (1.0, 0.6, 0.5)
STANDARD_SOLUTION = 5

PAYLOAD = [c for c in DENSE if c not in ("source", "source_id")]
#: Least and most bits of the filter of linked ids, sent to all tasks: half a megabyte and eight. Between them it has 16 for each id and lets at most 6
#: of 100 others through; of six million ids 9, of a hundred million 77.
FILTER_BITS, MOST_FILTER_BITS = 1 << 22, 1 << 26


@dataclass
class Merged:
    dense: DataFrame  # DENSE
    decisions: DataFrame  # DECISIONS
    report: DataFrame  # one row of counts
    sidecar: DataFrame  # source, source_id, gaia_source_id, the place and the gaia_* columns of rows that a Gaia row led to


def winner(neighbours: Column, solution: Column, g: Column, gaia_mag: Column, gaia_r: Column, gaia_score: Column, hip_score: Column) -> Column:
    """struct(catalog, reason): vetoes first, then the margin that the star's brightness asks for."""
    bright = F.coalesce(F.when(finite(g), g), F.when(gaia_r > 0, apparent_magnitude(gaia_mag, gaia_r)))
    margin = F.when(yes(bright < BRIGHT), F.lit(MARGINS[0])).when(yes(bright < MIDDLE), F.lit(MARGINS[1])).otherwise(F.lit(MARGINS[2]))
    pick = lambda catalog, reason: F.struct(F.lit(catalog).alias("catalog"), F.lit(reason).cast("string").alias("reason"))
    out = F.when(yes(neighbours > 1), pick("gaia", "neighbour_veto")).when(yes(solution != STANDARD_SOLUTION), pick("gaia", "hip_multiplicity"))
    out = out.when(hip_score < gaia_score * margin, pick("hip", None)).when(gaia_score <= hip_score, pick("gaia", None))
    return out.otherwise(pick("gaia", "gaia_margin"))


def _payload(df: DataFrame, name: str, more: dict[str, str], beside: list[Column] | tuple = ()) -> DataFrame:
    """id and a struct of the dense payload and some more columns."""
    cols = [or_null(df, c, DENSE[c]).alias(c) for c in PAYLOAD] + [or_null(df, c, t).alias(c) for c, t in more.items()]
    return df.select(F.col("source_id").cast("long").alias(f"{name}_id"), F.struct(*cols).alias(name), *beside)


def id_filter(ids: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """One row with the words of a bit filter of a column `id`: of so many bits whatever the ids."""
    at = F.pmod(F.xxhash64("id"), F.lit(bits))
    words = ids.select((F.floor(at / 64)).alias("word"), F.pmod(at, F.lit(64)).cast("int").alias("bit")).groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("set"))
    every = ids.sparkSession.range(bits // 64).select(F.col("id").alias("word")).join(words, "word", "left")
    held = F.array_sort(F.collect_list(F.struct("word", F.coalesce("set", F.lit(0)).alias("set"))))
    return every.agg(F.transform(held, lambda w: w["set"]).alias("words"))


def filter_bits(ids: int) -> int:
    """Bits of a filter of so many ids, a power of two."""
    return min(MOST_FILTER_BITS, max(FILTER_BITS, 1 << (16 * ids - 1).bit_length()))


def may_hold(words: Column, c: Column, bits: int = FILTER_BITS) -> Column:
    """False only for ids that the filter was not made from."""
    at = F.pmod(F.xxhash64(c), F.lit(bits))
    return F.coalesce(F.getbit(F.element_at(words, (F.floor(at / 64) + 1).cast("int")), F.pmod(at, F.lit(64)).cast("int")) == 1, F.lit(True))


def _once(df: DataFrame, one: str, other: str, name: str, partner: str) -> DataFrame:
    """df, if no value of one id has two of the other."""
    w = Window.partitionBy(one)
    least, most = F.min(other).over(w), F.max(other).over(w)
    named = df.withColumn("_least", least).withColumn("_most", most)
    text = F.concat(F.lit(f"{name} "), F.col(one), F.lit(" is linked to "), F.col("_least"), F.lit(" and "), F.col("_most"))
    return without(named, F.col(one).isNotNull() & (F.col("_least") != F.col("_most")), text).drop("_least", "_most")


def _decision(kinds: dict[str, str] = DECISIONS, **values: Column) -> Column:
    return F.struct(*(values.get(c, F.lit(None)).cast(t).alias(c) for c, t in kinds.items()))


def _row(source: Column, source_id: Column, payload: str) -> Column:
    return F.struct(source.alias("source"), source_id.cast("string").alias("source_id"), *(F.col(f"{payload}.{c}").cast(DENSE[c]).alias(c) for c in PAYLOAD))


def _written(df: DataFrame, name: str) -> DataFrame:
    """staged(), with what a row was refused for as a ValueError."""
    try:
        return staged(df, name)
    except PySparkException as error:
        if found := re.search(r"\[USER_RAISED_EXCEPTION\] (.*?) SQLSTATE", str(error), re.DOTALL):
            raise ValueError(found[1]) from error
        raise


def merge(gaia: DataFrame, hip: DataFrame, pairs: DataFrame, overrides: DataFrame, validate: bool = True, order: str = "input_order", kept: DataFrame | None = None) -> Merged:
    """gaia, hip: rows of their stages; pairs: crossmatch; overrides: override rows. gaia ids are unique.

    Runs the merge: its tables are written to the shared folder, those that are of no more use deleted. gaia is read for its ids,
    for the rows that may be linked and for the others: a table or a projection of one, not something to be worked out anew. validate: ids of pairs that are linked
    twice, and repeated gaia rows, are an error. order: a column of hip and pairs that says where a row came (see with_input_order());
    of repeated rows the last wins by it. Where there is none, the one of the least values. kept: for callers that read no other
    rows without a link, those of gaia that they read: the others are checked and counted, but not written to dense and sidecar.
    """
    spark = gaia.sparkSession
    compiled(spark)
    for df, what in ((gaia, "gaia rows"), (hip, "hip rows")):
        require(df, DENSE, what)
    require(pairs, ("gaia_source_id", "hip_source_id"), "crossmatch")
    carried = {c: t for c, t in gaia.dtypes if c.startswith("gaia_") and c != "gaia_source_id"}
    payload = lambda df: _payload(df, "gaia", {"ruwe": "double", "phot_g_mean_mag": "double", **carried})
    g = payload(gaia)
    at = lambda df: [F.col(order).alias("_at")] if order in df.columns else []
    h = _payload(hip, "hip", {"Sn": "int", "Hpmag": "double"}, at(hip))
    h = first_by(h, ["hip_id"], "_at" if "_at" in h.columns else "hip", last="_at" in h.columns).select("hip_id", "hip")
    aux = {"mapping_source": "string", "number_of_neighbours": "int", "angular_distance": "double"}
    x = pairs.select(F.col("gaia_source_id").cast("long").alias("gaia_id"), F.col("hip_source_id").cast("long").alias("hip_id"), *(or_null(pairs, c, t).alias(c) for c, t in aux.items()), *at(pairs))
    x = first_by(x, ["gaia_id", "hip_id"], *(["_at"] if "_at" in x.columns else aux), last="_at" in x.columns).select("gaia_id", "hip_id", *aux)
    if validate:
        x = _once(_once(x, "gaia_id", "hip_id", "gaia_source_id", "hip_source_id"), "hip_id", "gaia_id", "hip_source_id", "gaia_source_id")
    x_, h_ = x, h
    # the small sides, once: everything below reads them
    x, h, ov_rows = at_once(spark, lambda: _written(x_, "links"), lambda: _written(h_, "second"), lambda: _written(checked_overrides(overrides), "overrides"))
    targets, adds = ov_rows.filter("action <> 'add'"), ov_rows.filter("action = 'add'")
    ov = targets.select("source", "key", F.struct("override_id", "action", "override_reason", "override_policy_version", "source", "source_id", "key", *PAYLOAD).alias("ov"))
    by_gaia = ov.filter("source = 'gaia'").select(F.col("key").cast("long").alias("gaia_id"), F.col("ov").alias("ov_g"))
    by_hip = ov.filter("source = 'hip'").select(F.col("key").cast("long").alias("hip_id"), F.col("ov").alias("ov_h"))

    def overridden(df: DataFrame) -> DataFrame:
        """One override for each row; two of them are an error."""
        both = df.join(by_gaia, "gaia_id", "left").join(by_hip, "hip_id", "left")
        clash = yes(F.col("ov_g.override_id") != F.col("ov_h.override_id"))
        both = without(both, clash, F.concat(F.lit("two overrides of one pair: "), F.col("ov_g.override_id"), F.lit(", "), F.col("ov_h.override_id")))
        return both.withColumn("ov", F.coalesce("ov_g", "ov_h")).drop("ov_g", "ov_h")

    # Gaia rows that may have a link or an override, with it and their partner
    linked_ids = x.select(F.col("gaia_id").alias("id")).unionByName(by_gaia.select(F.col("gaia_id").alias("id"))).filter("id IS NOT NULL")
    bits = filter_bits(linked_ids.count())
    words = _written(id_filter(linked_ids, bits), "linked-ids")
    linked = overridden(x.join(h, "hip_id", "left").join(by_gaia.select("gaia_id"), "gaia_id", "full"))
    may = may_hold(words.scalar(), F.col("gaia_id"), bits)
    col, text = F.col, lambda c: F.col(c).cast("string")

    def beside(source: Column, source_id: Column, ra: Column, dec: Column) -> Column:
        return F.struct(source.alias("source"), source_id.alias("source_id"), col("gaia_id").alias("gaia_source_id"), ra.alias("ra_deg"), dec.alias("dec_deg"), *(col(f"gaia.{c}").alias(c) for c in carried))

    def unlinked() -> tuple[DataFrame, int]:
        """Rows that the filter parts off: all they emit, and how many they are."""
        counted = Observation("unlinked")
        # a sidecar row's place and name are those of its dense row
        row, more = _row(F.lit("gaia"), col("gaia_id"), "gaia"), F.struct(col("gaia_id").alias("gaia_source_id"), *(col(f"gaia.{c}").alias(c) for c in carried))
        alone = (g if kept is None else payload(kept)).filter(~may).select(row.alias("dense"), more.alias("more"))
        # in the same write: a branch that has no rows, or fails it; ids alone are counted
        ids = g.groupBy("gaia_id").count().observe(counted, F.coalesce(F.sum(F.when(~may, col("count"))), F.lit(0)).alias("rows")) if validate else g.filter(~may).select("gaia_id", F.lit(1).alias("count")).observe(counted, F.count("count").alias("rows"))
        twice = without(ids, col("count") > 1, F.concat(F.lit("gaia row "), F.coalesce(text("gaia_id"), F.lit("NULL")), F.lit(" is repeated"))).filter("count > 1")
        out = _written(alone.unionByName(twice.select(*(F.lit(None).cast(alone.schema[c].dataType).alias(c) for c in alone.columns))), "unlinked")
        beside_it = F.struct("dense.source", "dense.source_id", "more.gaia_source_id", "dense.ra_deg", "dense.dec_deg", *(f"more.{c}" for c in carried))
        return out.filter("dense IS NOT NULL").select("dense", beside_it.alias("sidecar")), counted.get["rows"]

    def met_rows() -> tuple[DataFrame, dict]:
        """What all other rows emit, and the counts of it."""
        met = _written(g.filter(may).join(linked, "gaia_id", "left"), "linked")
        kind = F.when(F.col("ov").isNotNull(), F.col("ov.action")).when(F.col("hip").isNull(), F.lit("alone")).otherwise(F.lit("pair"))
        g_score, h_score = score(F.col("gaia.astrometry_quality")), score(F.col("hip.astrometry_quality"))
        win = winner(F.col("number_of_neighbours"), F.col("hip.Sn"), F.col("gaia.phot_g_mean_mag"), F.col("gaia.mag_abs"), F.col("gaia.r_pc"), g_score, h_score)
        left = met.withColumn("kind", kind).withColumn("win", F.when(F.col("kind") == "pair", win)).withColumn("g_score", g_score).withColumn("h_score", h_score)

        # second-catalogue rows that no Gaia row has settled
        settled = left.filter("hip_id IS NOT NULL AND kind <> 'alone'").select("hip_id").distinct()
        seen = left.filter("ov IS NOT NULL").select(F.col("ov.override_id").alias("override_id")).distinct()
        rest = h.join(settled, "hip_id", "left_anti").join(x, "hip_id", "left")
        right = overridden(rest).withColumn("seen_id", F.col("ov.override_id")).join(seen.select(F.col("override_id").alias("seen_id"), F.lit(True).alias("seen")), "seen_id", "left")
        right = _written(right.filter(F.col("seen").isNull()).drop("seen", "seen_id").withColumn("kind", F.coalesce("ov.action", F.lit("alone"))).withColumn("h_score", h_score), "unsettled")
        used = seen.unionByName(right.filter("ov IS NOT NULL").select(F.col("ov.override_id").alias("override_id")).distinct())
        added = first_by(adds, ["override_id"], "source", "source_id").join(used, "override_id", "left_anti")
        idle = targets.join(used, "override_id", "left_anti")

        # what each row emits: a dense row, a decision and a sidecar row, or less
        replaced, paired, took_gaia = col("kind") == "replace", col("kind") == "pair", col("win.catalog") == "gaia"
        source = F.when(replaced, col("ov.source")).when(paired, F.lit("hip")).otherwise(F.lit("gaia"))
        source_id = F.when(replaced, col("ov.source_id")).when(paired, text("hip_id")).otherwise(text("gaia_id"))
        body = {c: F.when(replaced, col(f"ov.{c}")).when(paired & ~took_gaia, col(f"hip.{c}")).otherwise(col(f"gaia.{c}")).cast(DENSE[c]) for c in PAYLOAD}
        policy = {c: col(f"ov.{c}") for c in ("override_id", "override_reason", "override_policy_version")} | {"override_action": col("ov.action")}
        manual = {"winner_catalog": F.when(replaced, F.lit("manual")), "winner_source_id": F.when(replaced, col("ov.source_id"))}
        ids = {"gaia_source_id": text("gaia_id"), "hip_source_id": text("hip_id"), "mapping_source": col("mapping_source")}
        measured = lambda c: F.when(finite(col(c)), col(c))

        overruled = _decision(decision_type=F.lit("override"), **ids, **manual, gaia_score=col("g_score"), hip_score=col("h_score"), **policy, note=F.when(col("hip_id").isNull(), F.lit("partner_missing")))
        scored = _decision(
            decision_type=F.lit("score"), **ids, winner_catalog=col("win.catalog"), winner_source_id=F.when(took_gaia, text("gaia_id")).otherwise(text("hip_id")), gaia_score=col("g_score"), hip_score=col("h_score"),
            tie_break_reason=col("win.reason"), number_of_neighbours=col("number_of_neighbours"), angular_distance_arcsec=measured("angular_distance"), gaia_ruwe=measured("gaia.ruwe"),
            gaia_phot_g_mean_mag=measured("gaia.phot_g_mean_mag"), hip_solution_type=col("hip.Sn"), hip_apparent_mag=measured("hip.Hpmag"),
        )
        late = _decision(
            decision_type=F.lit("override"), **ids, **manual, hip_score=col("h_score"), **policy,
            note=F.when(yes((col("ov.source") == "gaia") & (col("ov.key") == text("gaia_id"))), F.lit("resolved_in_hip_flush")),
        )
        own = {"override_id": col("override_id"), "override_action": col("action"), "override_reason": col("override_reason"), "override_policy_version": col("override_policy_version")}
        parts = [
            left.select(
                F.lit("gaia").alias("side"), "kind", col("win.catalog").alias("catalog"), F.when(~(col("kind") == "drop"), F.struct(source.alias("source"), source_id.alias("source_id"), *(v.alias(c) for c, v in body.items()))).alias("dense"),
                F.when(col("ov").isNotNull(), overruled).when(paired, scored).alias("decision"), F.when(~(col("kind") == "drop"), beside(source, source_id, body["ra_deg"], body["dec_deg"])).alias("sidecar"),
            ),
            right.select(
                F.lit("hip").alias("side"), "kind", F.when(col("kind") == "alone", _row(F.lit("hip"), col("hip_id"), "hip")).when(replaced, _row(col("ov.source"), col("ov.source_id"), "ov")).alias("dense"),
                F.when(col("ov").isNotNull(), late).alias("decision"),
            ),
            added.select(
                F.lit("override").alias("side"), col("action").alias("kind"), F.struct(*(col(c).cast(t).alias(c) for c, t in DENSE.items())).alias("dense"),
                _decision(decision_type=F.lit("override_add"), winner_catalog=F.lit("manual"), winner_source_id=col("source_id"), **own).alias("decision"),
            ),
            idle.select(F.lit("override").alias("side"), F.lit("idle").alias("kind"), _decision(decision_type=F.lit("override_no_effect"), note=F.lit("target_and_partner_absent"), **own).alias("decision")),
        ]
        emitted = parts[0]
        for df in parts[1:]:
            emitted = emitted.unionByName(df, allowMissingColumns=True)
        counted = Observation("merge")
        n = lambda condition, name: F.count_if(condition).alias(name)
        first, done, what = col("side") == "gaia", col("decision.decision_type"), col("decision.override_action")
        emitted = emitted.observe(
            counted, n(first, "gaia_rows_total"), n(first & (col("kind") == "alone"), "unmatched_gaia"), n(first & paired, "matched_pairs_scored"), n(first & (col("catalog") == "gaia"), "matched_winner_gaia"),
            n(first & (col("catalog") == "hip"), "matched_winner_hip"), n((col("side") == "hip") & (col("kind") == "alone"), "unmatched_hip"), n(done == "override_add", "override_add_applied"),
            n((done == "override") & (what == "replace"), "override_replace_applied"), n((done == "override") & (what == "drop"), "override_drop_applied"), n(done == "override_no_effect", "override_no_effect"),
            n(done.isNotNull(), "decisions_rows"), n(col("dense").isNotNull(), "rows_emitted_total"),
        )
        emitted = _written(emitted.select("dense", "decision", "sidecar"), "emitted")
        removed(met, right)
        return emitted, dict(counted.get)

    (alone, free), (emitted, report) = at_once(spark, unlinked, met_rows)
    for name in ("gaia_rows_total", "unmatched_gaia", "rows_emitted_total"):
        report[name] += free
    removed(x, h, ov_rows, words)
    get = lambda name, *frames: _union([df.filter(col(name).isNotNull()).select(f"{name}.*") for df in frames])
    counts = spark.createDataFrame([tuple(report.values())], ", ".join(f"{k} long" for k in report))
    return Merged(get("dense", alone, emitted), get("decision", emitted), counts, get("sidecar", alone, emitted))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def check_report(report: dict) -> None:
    expected = sum(report[c] for c in ("unmatched_gaia", "unmatched_hip", "matched_pairs_scored", "override_replace_applied", "override_add_applied"))
    if report["rows_emitted_total"] != expected:
        raise RuntimeError(f"{report['rows_emitted_total']} rows were emitted, {expected} are accounted for")


def with_pixel(dense: DataFrame, order: int = 3) -> DataFrame:
    return dense.withColumn("healpix_pixel", pixel(F.col("ra_deg"), F.col("dec_deg"), order))
