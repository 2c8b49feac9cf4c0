"""Packed provenance flags of a star (quality_flags, 12 bits in an INT)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumenforge.functions.nulls import positive, yes

# Fixed values of the flag layout: distance source in bits 0-3
DIST_SOURCE = {"UNKNOWN": 0, "DR3": 1, "BJ_GEO": 2, "BJ_PHOTOGEO": 3, "HIP": 4, "DR3_WEAK": 5, "GEO_WEAK": 6, "PHOTOGEO_WEAK": 7, "PHOTO_MG_AG": 8, "PRIOR": 9, "OVERRIDE": 10}
# temperature source in bits 4-6
TEFF_SOURCE = {"DEFAULT": 0, "ESPHS": 1, "GSPSPEC": 2, "ESPUCD": 3, "GSPPHOT": 4, "BPRP": 5, "BV": 6}
# single bits 7, 8, 9
DIST_VALID, NEEDS_REVIEW, DIST_PLAUSIBLE = 1 << 7, 1 << 8, 1 << 9
# photometry source in bits 10-11
PHOT_SOURCE = {"UNKNOWN": 0, "GAIA_G": 1, "HIP_HP": 2}
# a plausible distance lies strictly between these parsecs
PLAUSIBLE_PC = (0.1, 200_000.0)


def plausible(distance: Column) -> Column:
    low, high = PLAUSIBLE_PC
    return yes((distance > low) & (distance < high))


def _bit(condition: Column, mask: int) -> Column:
    return F.when(condition, F.lit(mask)).otherwise(F.lit(0))


def status_flags(source: Column, valid: Column, review: Column, is_plausible: Column) -> Column:
    return source.bitwiseOR(_bit(valid, DIST_VALID)).bitwiseOR(_bit(review, NEEDS_REVIEW)).bitwiseOR(_bit(is_plausible, DIST_PLAUSIBLE)).cast("int")


def distance_flags(source: Column, distance: Column, review: Column) -> Column:
    return status_flags(source, positive(distance), yes(review), plausible(distance))


def with_sources(flags: Column, photometry: Column, teff: Column) -> Column:
    return flags.bitwiseOR(F.shiftleft(photometry, 10)).bitwiseOR(F.shiftleft(teff, 4)).cast("int")


def dist_source(flags: Column) -> Column:
    return flags.bitwiseAND(0xF)


def teff_source(flags: Column) -> Column:
    return F.shiftright(flags, 4).bitwiseAND(0x7)


def phot_source(flags: Column) -> Column:
    return F.shiftright(flags, 10).bitwiseAND(0x3)


def is_set(flags: Column, mask: int) -> Column:
    return flags.bitwiseAND(mask) != 0
