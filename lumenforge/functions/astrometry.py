"""Distances, their errors, epoch propagation and Cartesian places."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumenforge.functions.angles import sine_cosine
from lumenforge.functions.flags import DIST_SOURCE
from lumenforge.functions.nulls import finite, positive, yes

# Penalties of catalogue distances, qualities of the fallback tiers, the prior's absolute magnitude
GEO_PENALTY, PHOTOGEO_PENALTY = 0.01, 0.02
WEAK_QUALITY, PHOTO_QUALITY, PRIOR_QUALITY = 10.0, 20.0, 50.0
PRIOR_MAG = 4.0
TARGET_EPOCH = 2016.0


def parallax_distance(parallax: Column) -> Column:
    """Parsecs from milliarcseconds."""
    return F.when(positive(parallax), F.lit(1000.0) / parallax)


def fractional_error(parallax: Column, error: Column) -> Column:
    return F.when(positive(parallax) & positive(error), error / parallax)


def interval_width(distance: Column, low: Column, high: Column) -> Column:
    """Half the interval as a share of the distance; NULL if any of the three is."""
    return F.when(distance.isNotNull(), (high - low) / (F.lit(2.0) * F.greatest(distance, F.lit(1e-12))))


def photometric_distance(apparent: Column, absolute: Column, extinction: Column) -> Column:
    return F.pow(F.lit(10.0), (apparent - extinction - absolute + 5.0) / 5.0)


def tiered_distance(parallax: Column, error: Column, geo: tuple[Column, Column, Column], photogeo: tuple[Column, Column, Column], g: Column, mg: Column, ag: Column) -> Column:
    """struct(distance, source, quality, review, lo, hi) by the first tier that gives one. geo, photogeo: (low, middle, high).

    Strong tier: the least of three scores, ties in the order parallax, geometric, photogeometric. Then any catalogue distance,
    then one from photometry, then one from a prior magnitude.
    """
    src = {k: F.lit(v) for k, v in DIST_SOURCE.items()}

    def candidate(bounds: tuple[Column, Column, Column], penalty: float) -> Column:
        low, middle, high = bounds
        width = interval_width(middle, low, high)
        return F.when(finite(width) & positive(middle), width + penalty)

    scores = [fractional_error(parallax, error), candidate(geo, GEO_PENALTY), candidate(photogeo, PHOTOGEO_PENALTY)]
    best = F.least(*scores)  # skips NULLs; NULL if there is none
    none = F.lit(None).cast("double")

    def row(distance: Column, source: str, quality: Column, review: bool, low: Column = none, high: Column = none) -> Column:
        return F.struct(distance.alias("distance"), src[source].alias("source"), quality.alias("quality"), F.lit(review).alias("review"), low.alias("lo"), high.alias("hi"))

    near = parallax_distance(parallax)
    absorbed = F.when(yes((ag >= 0) & (ag < 5)), ag).otherwise(F.lit(0.0))
    has_mg = yes((mg > -10) & (mg < 15)) & finite(g)
    weak, photo, prior = F.lit(WEAK_QUALITY), F.lit(PHOTO_QUALITY), F.lit(PRIOR_QUALITY)
    tier = F.when(yes(scores[0] == best), row(near, "DR3", scores[0], False))
    tier = tier.when(yes(scores[1] == best), row(geo[1], "BJ_GEO", scores[1], False, geo[0], geo[2]))
    tier = tier.when(yes(scores[2] == best), row(photogeo[1], "BJ_PHOTOGEO", scores[2], False, photogeo[0], photogeo[2]))
    tier = tier.when(positive(photogeo[1]), row(photogeo[1], "PHOTOGEO_WEAK", weak, True))
    tier = tier.when(positive(geo[1]), row(geo[1], "GEO_WEAK", weak, True))
    tier = tier.when(positive(parallax), row(near, "DR3_WEAK", weak, True))
    tier = tier.when(has_mg, row(photometric_distance(g, mg, absorbed), "PHOTO_MG_AG", photo, True))
    tier = tier.when(finite(g), row(photometric_distance(g, F.lit(PRIOR_MAG), absorbed), "PRIOR", prior, True))
    return tier.otherwise(row(none, "UNKNOWN", none, True))


def cartesian(ra: Column, dec: Column, r: Column) -> tuple[Column, Column, Column]:
    """ICRS x, y, z of a direction in degrees and a distance."""
    (sa, ca), (sd, cd) = sine_cosine(F.radians(ra)), sine_cosine(F.radians(dec))
    return r * cd * ca, r * cd * sa, r * sd


def propagated(ra: Column, dec: Column, r: Column, pmra: Column, pmdec: Column, epoch: Column) -> Column:
    """struct(x, y, z, ra, dec, r) at TARGET_EPOCH, moving in a straight line on the tangent plane; proper motions in mas/yr."""
    (sa, ca), (sd, cd) = sine_cosine(F.radians(ra)), sine_cosine(F.radians(dec))
    scale = r * (F.lit(TARGET_EPOCH) - epoch) * F.lit(math.pi / 648_000_000.0)  # mas to radians
    east, north = scale * pmra, scale * pmdec
    x = r * cd * ca - east * sa - north * sd * ca
    y = r * cd * sa + east * ca - north * sd * sa
    z = r * sd + north * cd
    flat = F.sqrt(x * x + y * y)
    turn = F.degrees(F.pmod(F.atan2(y, x), F.lit(2 * math.pi)))
    return F.struct(x.alias("x"), y.alias("y"), z.alias("z"), turn.alias("ra"), F.degrees(F.atan2(z, flat)).alias("dec"), F.sqrt(x * x + y * y + z * z).alias("r"))
