"""Nested HEALPix pixels (Gorski et al. 2005) in plain column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _spread(c: Column, order: int) -> Column:
    """The low `order` bits of c on the even places."""
    out = F.lit(0)
    for bit in range(order):
        out = out + F.shiftleft(F.shiftright(c, bit).bitwiseAND(1), 2 * bit)
    return out


def pixel(ra: Column, dec: Column, order: int) -> Column:
    """Nested pixel number of a direction in degrees, NULL for a NULL one."""
    n = 1 << order
    z = F.sin(F.radians(dec))
    t = F.pmod(ra, F.lit(360.0)) / 90.0
    # belt
    up = F.lit(n * 0.5) + t * n
    jp, jm = F.floor(up - z * (0.75 * n)).cast("int"), F.floor(up + z * (0.75 * n)).cast("int")
    fp, fm = F.floor(jp / n).cast("int"), F.floor(jm / n).cast("int")
    belt_face = F.when(fp == fm, F.pmod(fp, F.lit(4)) + 4).when(fp < fm, F.pmod(fp, F.lit(4))).otherwise(F.pmod(fm, F.lit(4)) + 8)
    belt_x, belt_y = F.pmod(jm, F.lit(n)), F.lit(n - 1) - F.pmod(jp, F.lit(n))
    # caps
    corner = F.least(F.floor(t).cast("int"), F.lit(3))
    part = t - corner
    sigma = F.sqrt(F.lit(3.0) * (F.lit(1.0) - F.abs(z))) * n
    cp = F.least(F.floor(part * sigma).cast("int"), F.lit(n - 1))
    cm = F.least(F.floor((F.lit(1.0) - part) * sigma).cast("int"), F.lit(n - 1))
    cap_face = F.when(z >= 0, corner).otherwise(corner + 8)
    cap_x = F.when(z >= 0, F.lit(n - 1) - cm).otherwise(cp)
    cap_y = F.when(z >= 0, F.lit(n - 1) - cp).otherwise(cm)
    belt = F.abs(z) <= 2.0 / 3.0
    face, x, y = F.when(belt, belt_face).otherwise(cap_face), F.when(belt, belt_x).otherwise(cap_x), F.when(belt, belt_y).otherwise(cap_y)
    return F.when(ra.isNotNull() & dec.isNotNull(), (face * (n * n) + _spread(x, order) + F.lit(2) * _spread(y, order)).cast("int"))


def source_tile(source_id: Column) -> Column:
    """The order-3 pixel that a catalogue's 64-bit source id holds in its top bits."""
    return F.shiftright(source_id, 53).cast("int")
