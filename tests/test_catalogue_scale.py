"""What the catalogue queries cost at size, and rounding as in SQL."""

import duckdb

from lumenforge.operators.gaia import gaia_stage
from lumenforge.plans import catalogue
from lumenforge.plans.adapter import frame

SMALL = "/root/testdata/sf0.001"


def test_doubles_are_rounded_as_sql_does(spark):
    values = [24.4140625, 0.0640625, -0.0640625, 2.5, -2.5, 0.49999999999999994, 1e300, -1.7e308, 1e16 / 3, 0.0, -0.0, float("inf"), float("nan"), None, *(k / 128 + k * k for k in range(-500, 500)), *(k / 3e6 for k in range(500))]
    frame_ = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v double")
    got = [r["v"] for r in catalogue.rounded(frame_).orderBy("k").collect()]
    want = [duckdb.execute("SELECT round(?::DOUBLE, 6) + 0.0::DOUBLE", [v]).fetchone()[0] for v in values]
    assert [repr(v) for v in got] == [repr(v) for v in want]


def test_the_gaia_stage_is_compiled(spark):
    """Its projection is longer than the JVM compiles in one method: Spark must cut it."""
    old = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    try:
        gaia_stage(frame(spark, SMALL, "SELECT * FROM gaia_raw"))
        assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "20000")
        gaia_stage(frame(spark, SMALL, "SELECT * FROM gaia_raw"))
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "20000"
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", old)


def test_the_merge_groups_its_lines_once(spark, monkeypatch):
    from lumenforge.plans import adapter

    asked = []
    monkeypatch.setattr(catalogue, "frame", lambda spark, sf, query, k=None, old=adapter.frame: asked.append((query, k is None)) or old(spark, sf, query, k))
    catalogue._stages(spark, SMALL)
    assert [fresh for query, fresh in asked if "hip_raw" not in query] == [False, False, False]


def test_the_merge_writes_wide_rows_once(spark, monkeypatch):
    """Gaia rows go from the grouped lines into what they emit, with no table of the stage between."""
    from lumenforge.operators import merge as module

    made = []
    for place in (catalogue, module):
        monkeypatch.setattr(place, "staged", lambda df, name, old=place.staged: made.append((name, df.columns, out := old(df, name))) or out)
        monkeypatch.setattr(place, "removed", lambda *tables: None, raising=False)
    dense = catalogue._merged(spark, SMALL).dense.count()
    assert [name for name, _, df in made if df.count() > dense / 2] == ["unlinked"]
    assert not [columns for _, columns, _ in made if "phot_g_mean_mag" in columns]


def test_the_filter_of_linked_ids_grows_with_them(spark):
    from pyspark.sql import functions as F

    from lumenforge.operators.merge import filter_bits, id_filter, may_hold

    assert filter_bits(0) == filter_bits(1_000) == 1 << 22 and filter_bits(10**9) == 1 << 26
    n = 300_000
    assert filter_bits(n) >= 16 * n
    words = id_filter(spark.range(n), filter_bits(n))
    passed = spark.range(-n, n).crossJoin(words).filter(may_hold(F.col("words"), F.col("id"), filter_bits(n)))
    inside, outside = passed.filter("id >= 0").count(), passed.filter("id < 0").count()
    assert inside == n and outside < 0.07 * n


def test_rows_that_are_not_read_are_not_written(spark):
    whole, linked = catalogue._merged(spark, SMALL), catalogue._merged(spark, SMALL, linked_only=True)
    _, audited = catalogue._audited(spark, SMALL)
    ids = lambda df: {r[0] for r in df.filter("source = 'gaia'").select("source_id").collect()}
    bright = ids(whole.dense.filter(f"mag_abs <= {catalogue.LIMITS['luminous_mag']}"))
    assert ids(linked.dense) < ids(audited.dense) < ids(whole.dense) and bright <= ids(audited.dense)
    # all are counted, and no decision is lost
    assert whole.report.collect() == linked.report.collect() == audited.report.collect()
    assert sorted(map(str, whole.decisions.collect())) == sorted(map(str, linked.decisions.collect()))
