"""ECSV tables: space- or comma-separated text under a commented YAML header that names the columns and their types.

The header makes the schema, so the data are read once, by Spark's own CSV reader, split like any text. Only the headers go through the
driver, line by line. An empty field, quoted or not, and NaN are NULL; a value that does not fit its column's type is an error.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, ByteType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType, StructField, StructType

from lumenforge.functions.nulls import nan_to_null

# Fixed values of the format: its names of types, and what holds them
TYPES = {
    "bool": BooleanType(), "int8": ByteType(), "int16": ShortType(), "int32": IntegerType(), "int64": LongType(), "uint8": ShortType(), "uint16": IntegerType(), "uint32": LongType(),
    "uint64": DecimalType(20, 0), "float16": FloatType(), "float32": FloatType(), "float64": DoubleType(), "float128": DoubleType(), "string": StringType(),
}
NAMES = {"boolean": "bool", "tinyint": "int8", "smallint": "int16", "int": "int32", "bigint": "int64", "float": "float32", "double": "float64", "string": "string", "decimal(20,0)": "uint64"}


def parsed_header(name: str, lines: Iterator[str]) -> tuple[StructType, str, list[str]]:
    """(schema, delimiter, columns whose cells are JSON) of a file's first lines, up to its line of column names."""
    import yaml

    said, names = [], None
    for line in lines:
        if line.startswith("#"):
            said.append(line[2:] if line.startswith("# ") else line[1:])
        elif line.strip():
            names = line
            break
    if not said or not said[0].startswith("%ECSV") or names is None:
        raise ValueError(f"{name}: no ECSV header")
    root = yaml.safe_load("\n".join(x for x in said[1:] if x.strip() != "---")) or {}
    delimiter = root.get("delimiter", " ")
    if delimiter not in (" ", ","):
        raise ValueError(f"{name}: delimiter {delimiter!r}")
    fields, nested = [], []
    for column in root.get("datatype") or []:
        kind = TYPES.get(column.get("datatype"))
        if kind is None:
            raise ValueError(f"{name}: {column.get('name')} of type {column.get('datatype')}")
        subtype = column.get("subtype") or ""
        if "[" in subtype:  # arrays: "float64[3]", "int32[null]"
            inner = TYPES.get(subtype.partition("[")[0])
            if inner is None:
                raise ValueError(f"{name}: {column.get('name')} of type {subtype}")
            kind = inner
            for _ in subtype.partition("[")[2].split(","):
                kind = ArrayType(kind)
            nested.append(column["name"])
        fields.append(StructField(str(column["name"]), kind))
    import csv

    given = next(csv.reader([names], delimiter=delimiter))
    if given != [f.name for f in fields]:
        raise ValueError(f"{name}: its header names {[f.name for f in fields]}, its first line {given}")
    return StructType(fields), delimiter, nested


def _lines(spark: SparkSession, path) -> Iterator[str]:
    """A file's lines as the driver's file system gives them, as many as are asked for."""
    jvm = spark._jvm
    stream = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).open(path)
    factory = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsparkSession.sessionState().newHadoopConf())
    codec = factory.getCodec(path)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
    try:
        while (line := reader.readLine()) is not None:
            yield line
    finally:
        reader.close()


def _files(spark: SparkSession, path: str) -> list:
    """The files of a folder (or that match a pattern) that Spark would read."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = [s for s in system.globStatus(at) or []]
    inside = [f for s in found for f in (system.listStatus(s.getPath()) if s.isDirectory() else [s])]
    return sorted((f.getPath() for f in inside if not f.isDirectory() and not f.getPath().getName().startswith(("_", "."))), key=lambda p: p.toString())


def read_ecsv(spark: SparkSession, path: str) -> DataFrame:
    """The ECSV file or files at a path; files of one table have the same header."""
    heads = {p.toString(): parsed_header(p.getName(), _lines(spark, p)) for p in _files(spark, path)}
    if not heads:
        raise ValueError(f"{path}: no files")
    (first, head), *others = heads.items()
    if unlike := [p for p, h in others if h != head]:
        raise ValueError(f"{unlike[0]}: not the columns of {first}")
    schema, delimiter, nested = head
    flat = StructType([StructField(f.name, StringType() if f.name in nested else f.dataType) for f in schema])
    reader = spark.read.schema(flat).option("comment", "#").option("sep", delimiter).option("header", True).option("enforceSchema", True).option("mode", "FAILFAST")
    rows = reader.option("nanValue", "nan").option("positiveInf", "inf").option("negativeInf", "-inf").option("escape", '"').csv(path)
    made = {}
    for f in schema:
        text = F.nullif(F.col(f"`{f.name}`"), F.lit(""))
        if f.name in nested:
            made[f.name] = F.from_json(text, f.dataType)
        elif isinstance(f.dataType, StringType):
            made[f.name] = text
    return nan_to_null(rows.withColumns(made) if made else rows)


def write_ecsv(df: DataFrame, path: str, meta: dict | None = None) -> None:
    """df as ECSV, a whole file with its header from each partition that has rows (coalesce for one). NULL is an empty field."""
    columns = [{"name": n, "datatype": NAMES.get(t, "string")} | ({} if t in NAMES else {"subtype": "json"}) for n, t in df.dtypes]
    if wrong := [n for n, t in df.dtypes if t not in NAMES]:
        raise ValueError(f"no ECSV type for {', '.join(wrong)}")
    head = ["# %ECSV 1.0", "# ---", "# datatype:", *(f"# - {json.dumps(c)}" for c in columns)] + ([f"# meta: {json.dumps(meta)}"] if meta else [])
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    cell = {n: quoted(F.col(f"`{n}`")) if t == "string" else F.initcap(F.col(f"`{n}`").cast("string")) if t == "boolean" else F.lower(F.replace(F.col(f"`{n}`").cast("string"), F.lit("Infinity"), F.lit("inf"))) for n, t in df.dtypes}
    lines = df.select(F.concat_ws(" ", *(F.coalesce(c, F.lit('""')) for c in cell.values())).alias("value"))
    names = " ".join('"' + n.replace('"', '""') + '"' if set(n) & set(' "#') else n for n in df.columns)

    def with_header(batches):
        import pyarrow as pa

        first = True
        for batch in batches:
            if batch.num_rows:
                if first:
                    yield pa.RecordBatch.from_arrays([pa.array([*head, names])], schema=batch.schema)
                first = False
                yield batch

    lines.mapInArrow(with_header, "value string").write.text(path)
