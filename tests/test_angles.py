"""Sines, cosines and rounded doubles against the C library's and DuckDB's."""

import math

import duckdb
from pyspark.sql import functions as F

from lumenforge.functions.angles import nearest, sine_cosine
from lumenforge.operators.gaia import gaia_stage


def test_sine_and_cosine_are_the_nearest_doubles(spark):
    degrees = spark.range(-9_000, 36_000).select((F.col("id") / 100).alias("a")).select(F.radians("a").alias("a"))
    odd = spark.createDataFrame([(v,) for v in (1e-300, -1e-9, 6.6, -100.5, 1e6)], "a double")
    s, c = sine_cosine(F.col("a"))
    rows = degrees.unionByName(odd).select("a", s.alias("s"), c.alias("c")).collect()
    assert len(rows) == 45_005
    for want, got in ((math.sin, "s"), (math.cos, "c")):
        wide = [r for r in rows if abs(want(r["a"])) >= 1 / 64 and abs(r["a"]) < 6.5]
        assert not [r for r in wide if r[got] != want(r["a"])]
        assert all(math.isclose(r[got], want(r["a"]), rel_tol=1e-15, abs_tol=1e-17) for r in rows)
    assert [*spark.range(1).select(*sine_cosine(F.lit(None).cast("double"))).first()] == [None, None]


def test_a_distance_on_a_limit_is_as_in_sql(spark):
    """260.49 and 31.66 degrees at 2,000 pc: DuckDB's length of the vector is a unit in the last place below."""
    raw = spark.createDataFrame([(1, 260.49, 31.66, 0.0, 0.0, 1990.0, 2000.0, 2010.0)], "source_id long, ra double, dec double, pmra double, pmdec double, r_lo_geo double, r_med_geo double, r_hi_geo double")
    a, d = "radians(260.49::DOUBLE)", "radians(31.66::DOUBLE)"
    x, y, z = f"(2000.0::DOUBLE*cos({d})*cos({a}))", f"(2000.0::DOUBLE*cos({d})*sin({a}))", f"(2000.0::DOUBLE*sin({d}))"
    want = duckdb.execute(f"SELECT sqrt({x}*{x} + {y}*{y} + {z}*{z})").fetchone()[0]
    assert gaia_stage(raw).first()["r_pc"] == want < 2000.0


def test_nearest_rounds_as_sql_does(spark):
    values = [24.4140625, 0.0640625, -0.0640625, 2.5, -2.5, 0.49999999999999994, 1e300, -1.7e308, 1e16 / 3, 0.0, -0.0, float("inf"), float("nan"), None, *(k / 128 + k * k for k in range(-500, 500)), *(k / 3e6 for k in range(500))]
    got = [r[0] for r in spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v double").orderBy("k").select(nearest(F.col("v"), 6)).collect()]
    want = [duckdb.execute("SELECT round(?::DOUBLE, 6)", [v]).fetchone()[0] for v in values]
    assert [repr(v) for v in got] == [repr(v) for v in want]
