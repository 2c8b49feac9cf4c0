"""Magnitudes, temperatures and colours."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumenforge.functions.flags import TEFF_SOURCE
from lumenforge.functions.nulls import positive, yes

# Default and allowed temperatures, colour ranges, error of a magnitude from a distance error
DEFAULT_TEFF = 5800.0
TEFF_MIN, TEFF_MAX = 1000.0, 40_000.0
VALID_TEFF = (2000.0, 50_000.0)
VALID_LOGG = (0.0, 9.0)
BV_RANGE, BPRP_RANGE = (-0.5, 2.5), (-0.5, 3.5)
MAG_ERROR = 2.17


def distance_modulus(distance: Column) -> Column:
    return F.when(positive(distance), F.lit(5.0) * F.log10(distance / 10.0))


def absolute_magnitude(apparent: Column, distance: Column, extinction: Column | float = 0.0) -> Column:
    return apparent - distance_modulus(distance) - extinction


def apparent_magnitude(absolute: Column, distance: Column) -> Column:
    return absolute + distance_modulus(distance)


def clamped(c: Column, low: float, high: float) -> Column:
    """NULL stays NULL."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def teff_from_bv(bv: Column) -> Column:
    x = F.lit(0.92) * clamped(bv, *BV_RANGE)
    return clamped(F.lit(4600.0) * (F.lit(1.0) / (x + 1.7) + F.lit(1.0) / (x + 0.62)), TEFF_MIN, TEFF_MAX)


def teff_from_bp_rp(bp_rp: Column) -> Column:
    return teff_from_bv(F.lit(0.77) * clamped(bp_rp, *BPRP_RANGE) + 0.20)


def teff_cascade(esphs: Column, gspspec: Column, espucd: Column, gspphot: Column, bp_rp: Column, bv: Column) -> Column:
    """struct(teff, source) of the first source that gives one, else the default."""

    def row(value: Column, source: str) -> Column:
        return F.struct(value.alias("teff"), F.lit(TEFF_SOURCE[source]).alias("source"))

    def valid(c: Column) -> Column:
        return yes(c.between(*VALID_TEFF))

    out = F.when(valid(esphs), row(esphs, "ESPHS")).when(valid(gspspec), row(gspspec, "GSPSPEC")).when(valid(espucd), row(espucd, "ESPUCD")).when(valid(gspphot), row(gspphot, "GSPPHOT"))
    out = out.when(bp_rp.isNotNull(), row(teff_from_bp_rp(bp_rp), "BPRP")).when(bv.isNotNull(), row(teff_from_bv(bv), "BV"))
    return out.otherwise(row(F.lit(DEFAULT_TEFF), "DEFAULT"))


def logg_cascade(*sources: Column) -> Column:
    """The first surface gravity in the valid range."""
    return F.coalesce(*(F.when(c.between(*VALID_LOGG), c) for c in sources), F.lit(None).cast("double"))


def rgb(teff: Column) -> Column:
    """array(r, g, b) of a black body's colour, each from 0 to 255."""
    t = clamped(teff, TEFF_MIN, TEFF_MAX) / 100.0
    # Fixed values of the published fit to black-body colours
    red = F.when(t <= 66, F.lit(255.0)).otherwise(clamped(F.lit(329.698727446) * F.pow(t - 60, F.lit(-0.1332047592)), 0, 255))
    green = F.when(t <= 66, clamped(F.lit(99.4708025861) * F.log(t) - 161.1195681661, 0, 255)).otherwise(clamped(F.lit(288.1221695283) * F.pow(t - 60, F.lit(-0.0755148492)), 0, 255))
    blue = F.when(t >= 66, F.lit(255.0)).when(t <= 19, F.lit(0.0)).otherwise(clamped(F.lit(138.5177312231) * F.log(t - 10) - 305.0447927307, 0, 255))
    return F.when(teff.isNotNull(), F.array(red, green, blue))


def hex_colour(teff: Column) -> Column:
    """#rrggbb, channels cut to whole numbers."""
    colour = rgb(teff)
    return F.concat(F.lit("#"), *(F.lpad(F.lower(F.hex(colour[k].cast("int"))), 2, "0") for k in range(3)))
