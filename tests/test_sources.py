"""Readers, writers, field sets and checks on small files."""

import base64
import gzip
import json
import lzma
import re
import struct

import pytest
from pyspark.sql import functions as F

from lumenforge.functions import photometry
from lumenforge.operators import sidecars
from lumenforge.operators.gaia import CarryField, gaia_stage
from lumenforge.operators.hip import hip_stage
from lumenforge.operators.merge import check_report, merge
from lumenforge.operators.overrides import override_rows
from lumenforge.operators.quality import audit_summary, quality_issues, write_audit
from lumenforge.operators.source import aliases, source_rows
from lumenforge.plans.adapter import frame
from lumenforge.sources import ecsv, tables, text_tables
from lumenforge.sources import votable as formats
from lumenforge.streaming.stages import stream_gaia

SMALL = "/root/testdata/sf0.001"

#: Columns of a VOTable with a value of every kind a row, and rows with missing ones.
FIELDS = [
    ("SOURCE_ID", "long", None, None), ("ra", "double", None, None), ("pm", "float", None, None), ("n", "short", None, "-9"), ("tiny", "unsignedByte", None, None), ("k", "int", None, None),
    ("good", "boolean", None, None), ("letter", "char", "4", None), ("name", "char", "*", None), ("note", "unicodeChar", "*", None), ("pair", "double", "2", None), ("many", "int", "*", None), ("flags", "bit", "10", None), ("z", "floatComplex", None, None),
]
ROWS = [
    (1, 0.5, 1.5, 3, 200, -7, True, "abcd", "one two", "é \u4e00", [1.0, 2.0], [1, 2, 3], [True, False] * 5, [1.0, -1.0]),
    (2**60 + 1, None, None, None, None, None, None, None, None, None, None, None, None, None),
    (3, -1e300, float("inf"), 0, 0, 2**31 - 1, False, "ab", "<&>", "x", [0.25, None], [], [False] * 10, [0.0, 0.5]),
]


def _packed(value, kind, size, null) -> bytes:
    """A cell as the binary forms have it."""
    code = {"long": ">q", "double": ">d", "float": ">f", "short": ">h", "unsignedByte": ">B", "int": ">i", "floatComplex": ">f"}.get(kind)
    if kind in ("char", "unicodeChar"):
        raw = (value or "").encode("utf-16-be" if kind == "unicodeChar" else "utf-8")
        return struct.pack(">i", len(value or "")) + raw if size == "*" else raw.ljust(4, b"\0")
    if kind == "boolean":
        return b"?" if value is None else b"T" if value else b"F"
    if kind == "bit":
        bits = value or [False] * 10
        return bytes([sum(b << (7 - k) for k, b in enumerate(bits[:8])), sum(b << (7 - k) for k, b in enumerate(bits[8:]))])
    values = value if isinstance(value, list) else [value] if value is not None or size is None and kind != "floatComplex" else [None] * (0 if size == "*" else 2)
    missing = float("nan") if kind in ("double", "float", "floatComplex") else int(null or 0)
    body = b"".join(struct.pack(code, missing if v is None else v) for v in values)
    return struct.pack(">i", len(values)) + body if size == "*" else body


def votable(form: str, rows, fields=FIELDS) -> bytes:
    from xml.sax.saxutils import escape

    named = lambda f: f'<FIELD name="{f[0]}" datatype="{f[1]}"' + (f' arraysize="{f[2]}"' if f[2] else "") + (f'><VALUES null="{f[3]}"/></FIELD>' if f[3] else "/>")
    text = lambda v: "" if v is None else " ".join(text(x) or "NaN" for x in v) if isinstance(v, list) else str(int(v)) if isinstance(v, bool) else escape(str(v)).replace("inf", "+Inf")
    if form == "TABLEDATA":
        data = "".join("<TR>" + "".join(f"<TD>{text(v)}</TD>" for v in r) + "</TR>\n" for r in rows)
    else:
        raw = b""
        for r in rows:
            if form == "BINARY2":
                bits = [v is None for v in r] + [False] * (-len(r) % 8)
                raw += bytes(sum(b << (7 - k) for k, b in enumerate(bits[j : j + 8])) for j in range(0, len(bits), 8))
            raw += b"".join(_packed(v, *f[1:]) for v, f in zip(r, fields, strict=True))
        data = f'<STREAM encoding="base64">\n{base64.encodebytes(raw).decode()}</STREAM>'
    return f"""<?xml version="1.0"?><VOTABLE xmlns="http://www.ivoa.net/xml/VOTable/v1.3"><RESOURCE><TABLE>
{"".join(map(named, fields))}
<DATA><{form}>{data}</{form}></DATA></TABLE></RESOURCE></VOTABLE>""".encode()


COLUMNS = {"source_id": "long", "ra": "double", "pm": "float", "n": "smallint", "tiny": "smallint", "k": "int", "good": "boolean", "letter": "string", "name": "string", "note": "string", "pair": "array<double>", "many": "array<int>", "flags": "array<boolean>", "z": "array<float>"}


@pytest.mark.parametrize("form", ["TABLEDATA", "BINARY", "BINARY2"])
def test_a_votable_is_the_same_in_every_form(spark, tmp_path, form):
    """Three forms by three compressions: the same rows, of the same types, in the files' order."""
    want = [tuple(v or None if isinstance(v, list) else v for v in r) for r in ROWS]
    if form == "BINARY":  # it has no mask: what has no missing value of its own is there as zeros
        want[1] = (2**60 + 1, None, None, None, 0, 0, None, None, None, None, [None, None], None, [False] * 10, [None, None])
    for name, pack in (("b.vot", bytes), ("a.VOT.gz", gzip.compress), ("c.vot.xz", lzma.compress)):
        (tmp_path / name).write_bytes(pack(votable(form, ROWS)))
    (tmp_path / "notes.txt").write_text("not a table")
    read = text_tables.read_votable(spark, str(tmp_path))
    assert dict(read.dtypes) == {c: {"long": "bigint"}.get(t, t) for c, t in COLUMNS.items()} and read.rdd.getNumPartitions() == 3
    assert [tuple(r) for r in read.collect()] == want * 3
    some = text_tables.read_votable(spark, str(tmp_path), {"tiny": "double", "source_id": "string", "absent": "int", "ra": "int", "letter": "int"}, input_order=True)
    got = some.orderBy("input_order").collect()
    assert [(r["tiny"], r["source_id"], r["absent"], r["ra"], r["letter"]) for r in got] == [(None if w[4] is None else float(w[4]), str(w[0]), None, None, None) for w in want] * 3
    assert [tuple(r["input_order"]) for r in got] == [(f, k) for f in range(3) for k in range(3)]
    one = text_tables.read_votable(spark, f"file://{tmp_path}/c.vot.xz", {"source_id": "long"})
    assert [r["source_id"] for r in one.collect()] == [w[0] for w in want]


@pytest.mark.parametrize("form", ["TABLEDATA", "BINARY", "BINARY2"])
def test_a_large_votable_leaves_in_small_batches(tmp_path, form):
    """No more of a file is held than a chunk and a batch; rows of one width and rows with texts of any length."""
    import pyarrow as pa

    for fields, row in ((FIELDS[:8], lambda k: (k, k / 4, None, k % 100, 1, k, None, "ab")), ([FIELDS[0], FIELDS[8]], lambda k: (k, "s" * (k % 50)))):
        path = tmp_path / f"{len(fields)}.vot"
        path.write_bytes(votable(form, [row(k) for k in range(60_000)], fields))
        schema = pa.schema([("source_id", pa.int64()), (fields[-1][0], pa.string()), ("input_order", pa.struct([("file", pa.int32()), ("row", pa.int64())]))])
        sizes, seen = [], 0
        for batch in formats.batches(str(path), schema, 7):
            assert batch.column(0).to_pylist() == list(range(seen, seen + batch.num_rows)) and batch.column(2)[0].as_py() == {"file": 7, "row": seen}
            sizes.append(batch.num_rows)
            seen += batch.num_rows
        assert seen == 60_000 and len(sizes) > 1 and max(sizes) < 60_000


def test_votables_that_are_refused_or_empty(spark, tmp_path):
    (tmp_path / "e.vot").write_bytes(votable("BINARY2", []))
    assert text_tables.read_votable(spark, str(tmp_path)).count() == 0
    assert text_tables.read_votable(spark, str(tmp_path), {"nothing": "int"}).count() == 0
    for name, text, said in (("f", votable("FITS", []), "form FITS"), ("h", votable("BINARY", []).replace(b'encoding="base64"', b'href="x"'), "in the file itself"), ("t", re.sub(rb"[^<]{9}</STREAM>", b"</STREAM>", votable("BINARY", ROWS[:1])), "within a row"), ("d", votable("TABLEDATA", []).replace(b'"long"', b'"colour"'), "type colour")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.vot").write_bytes(text)
        with pytest.raises(Exception, match=said):
            text_tables.read_votable(spark, str(tmp_path / name), {"source_id": "long"}).collect()
    (tmp_path / "none").mkdir()
    assert text_tables.read_votable(spark, str(tmp_path / "none"), {"source_id": "long"}).count() == 0
    assert [text_tables.output_name(n) for n in ("x.vot.gz", "x.vot", "y.vot.xz", "z")] == ["x.parquet", "x.parquet", "y.parquet", "z.parquet"]


ECSV = """# %ECSV 1.0
# ---
# datatype:
# - {name: HIP, unit: '', datatype: int32, description: number}
# - {name: RArad, datatype: float64}
# - name: name
#   datatype: string
# - {name: whole, datatype: float64}
# - {name: ok, datatype: bool}
# - {name: big, datatype: uint64}
# - {name: pair, datatype: string, subtype: 'float64[2]'}
# meta: !!omap
# - {ID: x}
# schema: astropy-2.0
"""


def test_ecsv_has_the_types_of_its_header(spark, tmp_path):
    data = 'HIP RArad name whole ok big pair\n1 2.5 "two ""words""" 3 True 18446744073709551615 [1.0,2.5]\n2 "" "" nan False "" ""\n3 -inf x "" "" 5 [null,1]\n'
    (tmp_path / "t.ecsv").write_text(ECSV.replace("# meta: !!omap\n# - {ID: x}\n", "# meta: {ID: x}\n") + data)
    got = ecsv.read_ecsv(spark, str(tmp_path / "t.ecsv"))
    assert dict(got.dtypes) == {"HIP": "int", "RArad": "double", "name": "string", "whole": "double", "ok": "boolean", "big": "decimal(20,0)", "pair": "array<double>"}
    assert [tuple(r) for r in got.orderBy("HIP").collect()] == [(1, 2.5, 'two "words"', 3.0, True, 18446744073709551615, [1.0, 2.5]), (2, None, None, None, False, None, None), (3, float("-inf"), "x", None, None, 5, [None, 1.0])]
    # comma-separated, compressed, and a second file of the same table
    (tmp_path / "two").mkdir()
    head = '# %ECSV 1.0\n# ---\n# delimiter: \',\'\n# datatype:\n# - {name: a, datatype: int64}\n# - {name: b c, datatype: string}\na,b c\n'
    (tmp_path / "two" / "1.ecsv").write_text(head + '1,"x, y"\n')
    (tmp_path / "two" / "2.ecsv.gz").write_bytes(gzip.compress((head + "2,\n").encode()))
    assert [tuple(r) for r in ecsv.read_ecsv(spark, str(tmp_path / "two")).orderBy("a").collect()] == [(1, "x, y"), (2, None)]
    (tmp_path / "two" / "3.ecsv").write_text(head.replace("int64", "int32") + "3,\n")
    for path, said in (("two", "not the columns of"), ("none", "no files")):
        with pytest.raises(ValueError, match=said):
            ecsv.read_ecsv(spark, str(tmp_path / path))
    for text, said in (("a b\n1 2\n", "no ECSV header"), (head.replace("a,b c\n", "a,c\n"), "its first line"), (head.replace("int64", "colour"), "type colour"), (head.replace("','", "';'"), "delimiter")):
        with pytest.raises(ValueError, match=said):
            ecsv.parsed_header("f", iter(text.splitlines()))
    (tmp_path / "bad.ecsv").write_text(head + "x,y\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        ecsv.read_ecsv(spark, str(tmp_path / "bad.ecsv")).collect()


def test_ecsv_goes_out_and_comes_back(spark, tmp_path):
    rows = spark.createDataFrame([(1, 0.5, 'a "b" c', True, 2.0), (2, None, None, None, float("inf")), (3, 1e-300, "", False, -1.5)], "i long, d double, s string, t boolean, f float")
    ecsv.write_ecsv(rows.repartition(2), str(tmp_path / "out"), {"what": "test"})
    back = ecsv.read_ecsv(spark, str(tmp_path / "out"))
    assert back.dtypes == rows.dtypes
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(None if v == "" else v for v in r) for r in rows.collect())
    with pytest.raises(ValueError, match="no ECSV type for m"):
        ecsv.write_ecsv(rows.select(F.create_map("i", "d").alias("m")), str(tmp_path / "no"))


def test_text_keeps_its_order_however_splits_are_packed(spark, tmp_path):
    """Files of very different lengths, in splits of a few lines: Spark packs the largest splits first."""
    want = []
    for name, n in (("a", 3), ("b", 900), ("c", 40), ("d", 400)):
        (tmp_path / f"{name}.csv").write_text("".join(f"{name}{k}\n" for k in range(n)))
        want += [f"{name}{k}" for k in range(n)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        read = tables.with_input_order(spark.read.schema("v string").csv(str(tmp_path)))
        assert read.rdd.getNumPartitions() > 4
        assert [r["v"] for r in read.orderBy("input_order").collect()] == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_parquet_tables(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = spark.createDataFrame([(1, float("nan")), (2, 0.5)], "a long, b double")
    tables.write_table(rows, path, partitions=1)
    assert [r["b"] for r in tables.read_required(spark, path, ["a", "b"]).orderBy("a").collect()] == [None, 0.5]
    with pytest.raises(ValueError, match="missing columns c"):
        tables.read_required(spark, path, ["a", "c"])
    assert [tuple(r) for r in tables.read_lenient(spark, path, {"b": "double", "c": "string"}).orderBy("b").collect()] == [(None, None), (0.5, None)]
    with pytest.raises(Exception, match="already exists"):
        tables.write_table(rows, path)
    tables.write_table(rows.limit(0), path, mode="ignore")
    assert spark.read.parquet(path).count() == 2
    tables.write_table(rows.limit(1), path, mode="overwrite")
    assert spark.read.parquet(path).count() == 1
    report = tables.write_report(spark.sql("SELECT 2 AS b, 1 AS a"), str(tmp_path / "report"))
    assert report == {"a": 1, "b": 2} and json.loads("\n".join(r["value"] for r in spark.read.text(str(tmp_path / "report")).collect())) == report


OVERRIDES = {
    "b.yaml": """
description: second
stars:
  - {override_id: o3, action: replace, source: " Gaia ", source_id: 12, override_reason: r, override_policy_version: v, ra_deg: 10, dec_deg: 0, r_pc: 2, mag_abs: 1, teff: 5000,
     identifiers: {hip_id: "7", hd: x, bayer: " alpha ", proper_name: ""}}
""",
    "a.YML": "stars:\n  - {override_id: o1, action: drop, source: hip, source_id: '5', override_reason: r, override_policy_version: v, identifiers: {}}\n  - {override_id: o2, action: add, source: manual, source_id: m1, ra_deg: 0, dec_deg: 90, r_pc: 3, x_icrs_pc: 1, y_icrs_pc: 2, z_icrs_pc: 3, mag_abs: 4, teff: 6000}\n",
    "empty.yaml": "# nothing\n",
    "none.yaml": "description: no stars\n",
}


def test_override_files(spark, tmp_path):
    for name, text in OVERRIDES.items():
        (tmp_path / name).write_text(text)
    raw = text_tables.read_overrides(spark, str(tmp_path))
    assert [(r["override_id"], r["source_file"], r["file_description"]) for r in raw.collect()] == [("o1", "a.YML", None), ("o2", "a.YML", None), ("o3", "b.yaml", "second")]
    rows = {r["override_id"]: r for r in override_rows(raw).collect()}
    assert rows["o1"]["ra_deg"] is None and rows["o1"]["quality_flags"] is None and rows["o2"]["x_icrs_pc"] == 1.0
    assert (rows["o3"]["source"], rows["o3"]["source_id"]) == ("gaia", "12") and rows["o3"]["r_pc"] == 2.0
    ids = text_tables.read_override_identifiers(spark, str(tmp_path)).collect()
    assert [(r["source"], r["source_id"], r["hip_id"], r["hd"], r["bayer"], r["proper_name"]) for r in ids] == [("gaia", "12", 7, None, "alpha", None)]


@pytest.mark.parametrize("text,said", [
    ("- a list\n", "root must be a mapping"), ("stars: 3\n", "list of mappings"), ("stars: [3]\n", "list of mappings"),
    ("stars: [{override_id: o, action: drop, source: hip, source_id: 1}]\n", "lacks override_reason, override_policy_version"),
    ("stars: [{override_id: o, action: add, ra_deg: 1, dec_deg: 2}]\n", "lacks r_pc"),
    ("stars: [{override_id: o, action: add, ra_deg: 1, dec_deg: 2, r_pc: 3, x_icrs_pc: 1}]\n", "x, y and z"),
])
def test_override_files_that_are_wrong(text, said):
    with pytest.raises(ValueError, match=said):
        [text_tables.checked_star("f", s) for s in text_tables.override_stars("f", text)]


def test_field_sets():
    one = '[[fields]]\nname = "mass"\nexpression = "ap.mass + aps.more"\ndtype = "float64"\nsidecar = "mass"\nunit = "solar"\n[[fields]]\nname = "bp_rp"\nsource = "stage"\ncolumn = "bp_rp"\ndtype = "float64"\nsidecar = "motion"\n'
    fields = text_tables.field_set(one)
    assert [(f.name, f.origin, f.expression, f.column, f.sidecar, f.unit, f.output) for f in fields] == [("mass", "query", "ap.mass + aps.more", None, "mass", "solar", "gaia_mass"), ("bp_rp", "stage", None, "bp_rp", "motion", None, "gaia_bp_rp")]
    assert aliases("ap.mass * 2.5 + coalesce(aps.x, g.y)") == {"ap", "aps", "g"}
    assert {k: [f.name for f in v] for k, v in sidecars.by_sidecar(fields).items()} == {"mass": ["mass"], "motion": ["bp_rp"]}
    assert len(text_tables.field_sets({"one": one})) == 2
    with pytest.raises(ValueError, match="two sets: bp_rp, mass"):
        text_tables.field_sets({"one": one, "two": one})
    for bad in (one.replace('"ap.mass + aps.more"', '"zz.mass"'), one.replace("bp_rp", "mass"), one.replace("float64", "real"), one.replace('"stage"', '"query"'), one.replace('name = "mass"', 'name = "gaia_mass"'), one.replace('sidecar = "mass"', ""), ""):
        with pytest.raises(ValueError):
            text_tables.field_set(bad)


def test_carried_values_keep_their_digits(spark):
    rows = spark.sql("SELECT 1L AS source_id, 4611686018427387905L AS a, '4611686018427387905' AS b, 2.7D AS c, '2.5' AS d, '18446744073709551615' AS e, -1L AS f, 'x' AS g, 3.5D AS h, 1 AS bp_rp, CAST(7.5 AS DECIMAL(9,2)) AS i")
    field = lambda n, t, o="input": CarryField(n, t, o)
    fields = (field("a", "int64"), field("b", "int64"), field("c", "uint64"), field("d", "int64"), field("e", "uint64"), field("f", "uint64"), field("g", "int64"), field("h", "int64"), field("bp_rp", "string"), field("i", "int64"), CarryField("flag", "bool", "query"))
    got = gaia_stage(rows, carry=fields).first()
    assert [got[f.output] for f in fields] == [4611686018427387905, 4611686018427387905, 3, 2, 18446744073709551615, None, None, 4, "1", 8, None]


def test_archive_tables_are_joined(spark):
    raw = frame(spark, SMALL, "SELECT *, 31 AS astrometric_params_solved FROM gaia_raw")
    tables_ = (raw, raw.drop("ra"), raw.withColumns({c: F.lit(None).cast("double") for c in ("teff_gspphot_lower", "teff_gspphot_upper", "logg_esphs", "logg_gspspec", "logg_gspphot", "logg_gspphot_lower", "logg_gspphot_upper")}))
    twice = CarryField("twice", origin="query", expression="2 * g.ra")
    got = source_rows(*tables_, fields=(twice,), tiles=[0]).filter("twice <> 2 * ra")
    assert got.count() == 0 and "twice" in gaia_stage(source_rows(*tables_, fields=(twice,)), carry=(twice,)).columns[-1]
    for fields, said in (((CarryField("ra", origin="query", expression="g.ra"),), "core columns: ra"), ((CarryField("x", origin="query", expression="aps.x"),), "no supplement"), ((CarryField("x", origin="query", expression="q.x"),), "unknown aliases: q")):
        with pytest.raises(ValueError, match=said):
            source_rows(*tables_, fields=fields)
    with pytest.raises(ValueError, match="no tiles"):
        source_rows(*tables_, tiles=[])


def _inputs(spark):
    gaia = gaia_stage(frame(spark, SMALL, "SELECT * FROM gaia_raw LIMIT 500"), carry=(CarryField("parallax_mas", column="parallax"),))
    hip = hip_stage(frame(spark, SMALL, "SELECT hip AS HIP, sn AS Sn, rarad AS RArad, derad AS DErad, plx AS Plx, e_plx AS e_Plx, pmra AS pmRA, pmde AS pmDE, hpmag AS Hpmag, bv AS `B-V` FROM hip_raw"), log_g=True)
    return gaia, hip


def test_tables_by_pixel_come_back_whole(spark, tmp_path):
    gaia, hip = _inputs(spark)
    assert hip.schema["log_g"].dataType.simpleString() == "double" and hip.filter("log_g IS NOT NULL").count() == 0
    pairs = spark.createDataFrame([], "gaia_source_id long, hip_source_id long")
    none = override_rows(spark.createDataFrame([], "override_id string, action string, source string, source_id string"))
    m = merge(gaia, hip, pairs, none)
    check_report(m.report.first().asDict())
    with pytest.raises(RuntimeError, match="accounted for"):
        check_report(m.report.first().asDict() | {"rows_emitted_total": 1})
    path = str(tmp_path / "out")
    tables.write_by_pixel(m.dense, f"{path}/dense", rows_per_file=2)
    back = tables.read_by_pixel(spark, f"{path}/dense")
    assert back.count() == m.dense.count() and back.select("source", "source_id").distinct().count() == m.dense.count()
    assert tables.write_sidecars(m.sidecar, path) == ["gaia_enrichment", "motion"]
    assert tables.read_by_pixel(spark, f"{path}/motion").columns == ["source", "source_id", "gaia_source_id", "parallax_mas", "healpix_pixel"]
    placed = back.filter("source = 'gaia'").select("source_id", "healpix_pixel").exceptAll(tables.read_by_pixel(spark, f"{path}/gaia_enrichment").select("source_id", "healpix_pixel"))
    assert placed.count() == 0 and tables.read_by_pixel(spark, f"{path}/gaia_enrichment").count() == gaia.count()
    with pytest.raises(Exception, match="already exists"):
        tables.write_by_pixel(m.dense, f"{path}/dense")
    assert m.decisions.count() == 0 and sidecars.sidecar_tables(m.sidecar.select("source", "source_id", "gaia_source_id", "ra_deg", "dec_deg")) == {}


def test_pixels_go_on_across_writes(spark, tmp_path):
    star = lambda ids, ra: spark.createDataFrame([(f"s{k}", ra, 1.0) for k in ids], "source_id string, ra_deg double, dec_deg double").withColumn("source", F.lit("hip"))
    path = str(tmp_path / "stars")
    tables.write_by_pixel(star(range(5), 10.0).unionByName(star(range(5, 7), 200.0)), path, phase="gaia", rows_per_file=2)
    # a write that fails, after the first of two has put its rows, counts for nothing
    bad = star([90], 10.0).withColumn("source_id", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        tables.write_by_pixel(bad, path, mode="append", phase="hip")
    star([91], 10.0).withColumns({"healpix_pixel": F.lit(304), "part": F.lit("000002_hip_" + "0" * 32)}).write.mode("append").partitionBy("healpix_pixel", "part").parquet(path)
    tables.write_by_pixel(star(range(7, 10), 10.0), path, mode="append", phase="hip")
    got = tables.read_by_pixel(spark, path, places=True).select("source_id", "sequence", "phase", "healpix_pixel").collect()
    assert sorted((r["source_id"], r["sequence"], r["phase"]) for r in got) == [(f"s{k}", 1, "gaia") for k in range(7)] + [(f"s{k}", 2, "hip") for k in range(7, 10)]
    entries = tables.pixel_manifest(spark, path).collect()
    assert sorted((r["sequence"], r["phase"], r["rows"]) for r in entries) == [(1, "gaia", 2), (1, "gaia", 5), (2, "hip", 3)]
    assert {r["healpix_pixel"] for r in got} == {r["healpix_pixel"] for r in entries} and len({r["write"] for r in entries}) == 2
    with pytest.raises(FileExistsError):
        tables.write_by_pixel(star([1], 10.0), path)
    tables.write_by_pixel(star([1], None), path, mode="overwrite")
    assert [tuple(r) for r in tables.read_by_pixel(spark, path, places=True).select("source_id", "sequence", "healpix_pixel").collect()] == [("s1", 1, None)]


def test_a_replacement_that_fails_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "table")
    tables.write_table(spark.range(3), path)
    bad = spark.range(3).withColumn("id", F.when(F.col("id") == 2, F.raise_error(F.lit("broken"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="broken"):
        tables.write_table(bad, path, mode="overwrite")
    assert spark.read.parquet(path).count() == 3 and [p.name for p in tmp_path.iterdir()] == ["table"]
    # a table may replace itself
    tables.write_table(spark.read.parquet(path).filter("id > 0"), path, mode="overwrite")
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [1, 2] and [p.name for p in tmp_path.iterdir()] == ["table"]
    (tmp_path / "empty").mkdir()
    tables.write_table(spark.range(1), str(tmp_path / "empty"))  # an empty folder is no output
    assert tables.occupied(spark, str(tmp_path / "empty")) and not tables.occupied(spark, str(tmp_path / "nothing"))
    with pytest.raises(ValueError, match="mode"):
        tables.write_table(spark.range(1), path, mode="other")


def test_dropped_rows_are_counted_by_the_write(spark, tmp_path):
    from pyspark.sql import Observation

    raw = frame(spark, SMALL, "SELECT hip AS HIP, sn AS Sn, rarad AS RArad, derad AS DErad, plx AS Plx, e_plx AS e_Plx, pmra AS pmRA, pmde AS pmDE, hpmag AS Hpmag, bv AS `B-V` FROM hip_raw")
    seen = Observation("hip")
    tables.write_table(hip_stage(raw, observation=seen), str(tmp_path / "hip"))
    kept = spark.read.parquet(str(tmp_path / "hip")).count()
    assert seen.get == {"rows": raw.count(), "dropped": raw.count() - kept} and seen.get["dropped"] > 0


def test_only_linked_rows_are_joined(spark, monkeypatch):
    """With broadcasts off, what is shuffled for the join is what the bit filter lets through."""
    from lumenforge.operators import merge as merging

    ids = spark.range(0, 50_000, 50).select(F.col("id"))
    words = merging.id_filter(ids, 1 << 16)
    assert words.count() == 1
    passed = spark.range(50_000).filter(merging.may_hold(words.scalar(), F.col("id"), 1 << 16))
    assert ids.join(passed, "id", "left_anti").count() == 0 and passed.count() < 3_000
    gaia, hip = _inputs(spark)
    pairs = spark.createDataFrame([(r["source_id"], k + 1) for k, r in enumerate(gaia.orderBy("source_id").limit(5).collect())], "gaia_source_id long, hip_source_id long")
    none = override_rows(spark.createDataFrame([], "override_id string, action string, source string, source_id string"))
    seen = {}
    monkeypatch.setattr(merging, "staged", lambda df, name, old=merging.staged: seen.setdefault(name, old(df, name)))
    monkeypatch.setattr(merging, "removed", lambda *tables: None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        m = merge(gaia, hip, pairs, none)
        assert seen["linked"].count() < 20 and seen["unlinked"].count() > 450
        check_report(m.report.first().asDict())
        assert m.report.first()["gaia_rows_total"] == 500 and m.report.first()["matched_pairs_scored"] > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_merges_that_are_refused(spark):
    gaia, hip = _inputs(spark)
    none = override_rows(spark.createDataFrame([], "override_id string, action string, source string, source_id string"))
    pairs = spark.createDataFrame([(1, 1), (1, 2)], "gaia_source_id long, hip_source_id long")
    with pytest.raises(ValueError):
        merge(gaia, hip, pairs, none)
    with pytest.raises(ValueError, match="is repeated"):
        merge(gaia.unionByName(gaia), hip, pairs.limit(1), none)
    with pytest.raises(ValueError, match="missing columns"):
        merge(gaia.drop("teff"), hip, pairs, none)
    drop = none.limit(0).unionByName(spark.sql("SELECT 'hip' AS source, '1' AS source_id, 5.0D AS teff, 'o' AS override_id, 'drop' AS action"), allowMissingColumns=True)
    with pytest.raises(ValueError, match="no payload"):
        merge(gaia, hip, pairs.limit(1), drop)
    two = none.unionByName(spark.sql("SELECT 'hip' AS source, '1' AS source_id, explode(array('o', 'p')) AS override_id, 'drop' AS action"), allowMissingColumns=True)
    with pytest.raises(ValueError, match="two overrides"):
        merge(gaia, hip, pairs.limit(1), two)


def test_audit_of_zero_distances_and_covered_pairs(spark, tmp_path):
    decisions = spark.createDataFrame([(f"{k}.0", str(k), "hip", 1.0, 2.0) for k in (1, 2, 3)], "gaia_source_id string, hip_source_id string, winner_catalog string, gaia_score double, hip_score double").withColumn("decision_type", F.lit("score"))
    from lumenforge.operators.common import conform
    from lumenforge.operators.schemas import DECISIONS, DENSE

    star = lambda source, rows: conform(spark.createDataFrame(rows, "source_id string, r_pc double").withColumn("source", F.lit(source)), DENSE)
    gaia, hip = star("gaia", [("1", 0.0), ("2", 10.0), ("3", 10.0)]), star("hip", [("1", 5.0), ("2", 50.0), ("3", 50.0)])
    overrides = spark.createDataFrame([("drop", "gaia", "2")], "action string, source string, source_id string")
    issues = quality_issues(conform(decisions, DECISIONS), gaia, hip, gaia.limit(0), overrides)
    assert sorted((r["gaia_source_id"], r["distance_ratio"]) for r in issues.collect()) == [("1", float("inf")), ("3", 5.0)]
    row = audit_summary(issues, decisions, overrides).first().asDict()
    inputs = {"decisions": conform(decisions, DECISIONS), "gaia": gaia, "hip": hip, "dense": gaia.limit(0), "overrides": overrides}
    report = write_audit(spark, inputs, str(tmp_path), {"ruwe": 2}, {"gaia_dir": "somewhere"})
    assert {k: report[k] for k in row} == row and json.loads(next((tmp_path / "report.json").glob("part*")).read_text()) == report
    assert report["thresholds"] == {
        "distance_disagreement_threshold": 0.25, "severe_distance_ratio": 2.0, "ruwe_threshold": 2.0, "high_astrometry_quality": 1.0, "extreme_abs_mag": -10.0, "luminous_abs_mag": -8.0, "remote_luminous_pc": 20_000.0,
    }
    assert report["gaia_dir"] == "somewhere" and report["hip_path"] is None and spark.read.parquet(report["issues_path"]).count() == report["total_issues"]
    with pytest.raises(FileExistsError):
        write_audit(spark, inputs, str(tmp_path))
    assert write_audit(spark, inputs, str(tmp_path), {"distance": 100.0}, mode="overwrite")["total_issues"] == 1  # an infinite ratio
    with pytest.raises(ValueError, match="colour"):
        write_audit(spark, inputs, str(tmp_path), {"colour": 1.0}, mode="overwrite")
    assert spark.read.parquet(report["issues_path"]).count() == 1
    assert row == {"score_decisions": 3, "override_decisions": 0, "override_targets": 1, "matched_pair_issues": 2, "merged_row_issues": 0, "total_issues": 2, "issue_counts_by_type": {"matched_pair_conflict": 2}, "issue_counts_by_severity": {"high": 2}}


def test_gravity_takes_the_first_valid_source(spark):
    got = spark.range(1).select(photometry.logg_cascade(F.lit(-1.0), F.lit(None).cast("double"), F.lit(4.5), F.lit(2.0)).alias("a"), photometry.logg_cascade().alias("b")).first()
    assert (got["a"], got["b"]) == (4.5, None)


def test_stage_on_a_stream(spark, tmp_path):
    raw = frame(spark, SMALL, "SELECT * FROM gaia_raw LIMIT 200")
    at = {k: str(tmp_path / k) for k in ("in", "out", "checkpoint")}
    raw.write.parquet(at["in"])
    for _ in range(2):  # nothing is written twice
        stream_gaia(spark, at["in"], raw.schema, at["out"], at["checkpoint"]).awaitTermination()
    assert spark.read.parquet(at["out"]).count() == 200


def test_names_of_stars(spark):
    from lumenforge.functions import ids

    codes = [("alf", "Cas", "alpha Cas"), ("kap01", "Cyg", "kappa1 Cyg"), ("mu.", "", "mu"), ("pi.06", None, "pi6"), ("A.", "Cas", "A Cas"), ("", "Cas", None), ("...", "Cas", None), ("zz9", "Cas", "zz Cas"), ("12a", " Ori ", "12a Ori"), (None, "Cas", None), ("ksi..", "Cas", "xi Cas")]
    got = spark.createDataFrame([c[:2] for c in codes], "code string, cst string").select(ids.bayer(F.col("code"), F.col("cst")).alias("b")).collect()
    assert [r["b"] for r in got] == [c[2] for c in codes]
    names = [("Vega; other (x)", "Vega"), (" Deneb (see HD2)", "Deneb"), ("(none)", None), ("", None), (None, None), ("a\nb (c)", "a\nb")]
    got = spark.createDataFrame([n[:1] for n in names], "n string").select(ids.proper_name(F.col("n")).alias("p")).collect()
    assert [r["p"] for r in got] == [n[1] for n in names]


def test_repeated_rows_go_by_their_place_in_the_input(spark, tmp_path):
    from lumenforge.operators.crossmatch import crossmatch_map
    from lumenforge.operators.identifiers import identifier_rows
    from lumenforge.sources.tables import with_input_order

    at = lambda rows, schema, name: with_input_order(_read_back(spark, tmp_path, rows, schema, name))
    raw = at([(5, 1, 9, 0.9), (5, 1, 1, 0.1), (4, 2, 1, 0.2)], "source_id long, original_ext_source_id long, number_of_neighbours int, angular_distance double", "xm")
    assert [(r["gaia_source_id"], r["number_of_neighbours"]) for r in crossmatch_map(raw).collect()] == [(4, 1), (5, 9)]
    names = at([(7, "Second Name"), (7, "A Name")], "HD long, Name string", "names")
    hip_hd = at([(1, 7), (1, 3)], "HIP long, HD long", "hd")
    stars = at([(1, 9, "zet", 1, "Ori"), (1, 9, "alf", 1, "Ori")], "HIP long, HD long, Bayer string, Fl int, Cst string", "stars")
    links = at([(80, 1), (20, 1)], "gaia_source_id long, hip_source_id long", "links")
    row = identifier_rows(hip_hd, stars, names, links).first()
    assert (row["hd"], row["proper_name"], row["bayer"], row["gaia_source_id"]) == (7, "Second Name", "zeta Ori", 20)
    gaia, hip = _inputs(spark)
    one = hip.drop("log_g").orderBy("source_id").limit(1)
    copies = _read_back(spark, tmp_path, one.withColumn("teff", F.lit(9_000.0)).union(one.withColumn("teff", F.lit(7_000.0))).collect(), one.schema, "hip")
    none = override_rows(spark.createDataFrame([], "override_id string, action string, source string, source_id string"))
    pairs = spark.createDataFrame([], "gaia_source_id long, hip_source_id long")
    assert [r["teff"] for r in merge(gaia, with_input_order(copies), pairs, none).dense.filter("source = 'hip'").collect()] == [7_000.0]
    text = tmp_path / "t.csv"
    text.write_text("a\n3\n1\n2\n")
    assert [r["a"] for r in with_input_order(spark.read.option("header", True).csv(str(text))).orderBy("input_order").collect()] == ["3", "1", "2"]


def _read_back(spark, tmp_path, rows, schema, name):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / name))
    return spark.read.parquet(str(tmp_path / name))
