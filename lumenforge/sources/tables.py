"""Parquet in and out: required columns, columns that may be absent, pixel folders."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenforge.functions.nulls import nan_to_null
from lumenforge.operators.common import conform, require
from lumenforge.operators.merge import with_pixel
from lumenforge.operators.sidecars import PLACE, sidecar_tables
from lumenforge.sources.staging import at_once


def read_required(spark: SparkSession, path: str, columns, what: str = "table") -> DataFrame:
    """Checked on the schema alone; NaN comes in as NULL."""
    return nan_to_null(require(spark.read.parquet(path), columns, f"{what} {path}"))


def read_lenient(spark: SparkSession, path: str, schema: dict[str, str]) -> DataFrame:
    """The schema's columns, NULL where no file has them."""
    return conform(nan_to_null(spark.read.option("mergeSchema", True).parquet(path)), schema)


def with_input_order(df: DataFrame, name: str = "input_order") -> DataFrame:
    """df, straight from files, with a column that sorts its rows as they lie there: by path, and in a file by row.

    Parquet knows its row numbers. Text has none; there a split of a file is read by one task from its start on, so rows go by
    where their split starts and by their order in the task, however Spark packs splits into tasks.
    """
    try:
        return df.withColumn(name, F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")))
    except AnalysisException:
        return df.withColumn(name, F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row")))


def _at(spark: SparkSession, path: str):
    """(file system, path) as the JVM has them."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def occupied(spark: SparkSession, path: str) -> bool:
    """Whether there is a file, or a folder that is not empty."""
    system, at = _at(spark, path)
    return system.exists(at) and (not system.getFileStatus(at).isDirectory() or len(system.listStatus(at)) > 0)


def replaced(spark: SparkSession, path: str, write: Callable[[str], object]):
    """What write() puts beside `path` takes its place by renaming, once it is whole; whatever fails, the old output is still there.
    Returns what write() does."""
    path, token = path.rstrip("/"), uuid.uuid4().hex
    system, at = _at(spark, path)
    new, old = (spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{what}-{token}") for what in ("new", "old"))
    try:
        out = write(new.toString())
    except BaseException:
        system.delete(new, True)
        raise
    there = system.exists(at)
    if there and not system.rename(at, old):
        system.delete(new, True)
        raise OSError(f"{path} cannot be renamed")
    if not system.rename(new, at):
        if there:
            system.rename(old, at)
        raise OSError(f"{new.toString()} cannot be renamed to {path}")
    system.delete(old, True)
    return out


def guarded(spark: SparkSession, path: str, mode: str, write: Callable[[str], object]):
    """write(path) where nothing is yet. Where something is: an error (errorifexists), nothing at all (ignore), or a replacement
    (overwrite)."""
    if mode not in ("errorifexists", "ignore", "overwrite"):
        raise ValueError(f"mode {mode!r}")
    if mode != "overwrite" and occupied(spark, path):
        if mode == "ignore":
            return None
        raise FileExistsError(f"{path} already exists")
    return replaced(spark, path, write)


def write_table(df: DataFrame, path: str, mode: str = "errorifexists", partitions: int | None = None) -> None:
    """mode: errorifexists, overwrite (the old table is there until the new one is whole), or ignore (keep what is there).
    partitions: files, for small tables."""
    out = df.coalesce(partitions) if partitions else df
    guarded(df.sparkSession, path, mode, lambda to: out.write.option("compression", "zstd").parquet(to))


#: The log of a folder by pixel: a table of (healpix_pixel, sequence, phase, write, rows) for each write, in folders numbered from 1.
MANIFEST = "_manifest"
MANIFEST_SCHEMA = "healpix_pixel int, sequence int, phase string, write string, rows long"


def pixel_manifest(spark: SparkSession, path: str) -> DataFrame:
    """What the writes that were committed put where: healpix_pixel, sequence (from 1 in each pixel), phase, write, rows."""
    system, at = _at(spark, f"{path}/{MANIFEST}")
    found = [f.getPath().toString() for f in system.listStatus(at) if f.getPath().getName().isdigit()] if system.exists(at) else []
    return spark.read.schema(MANIFEST_SCHEMA).parquet(*found) if found else spark.createDataFrame([], MANIFEST_SCHEMA)


def _committed(spark: SparkSession, path: str, entries: DataFrame) -> None:
    """entries as the next folder of the log: a rename, which fails if another write took the number."""
    system, at = _at(spark, f"{path}/{MANIFEST}")
    names = [f.getPath().getName() for f in system.listStatus(at)] if system.exists(at) else []
    number = 1 + max((int(n) for n in names if n.isdigit()), default=0)
    made = f"{path}/{MANIFEST}/.{uuid.uuid4().hex}"
    entries.coalesce(1).write.parquet(made)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    target = hadoop(f"{path}/{MANIFEST}/{number:08d}")
    if system.exists(target) or not system.rename(hadoop(made), target):
        system.delete(hadoop(made), True)
        raise OSError(f"{path}: write {number} was committed by another")


def _named(rows: DataFrame) -> DataFrame:
    """rows with what the name of their part says: sequence, phase and write."""
    said = {"sequence": F.left("part", F.lit(6)).cast("int"), "phase": F.regexp_extract("part", r"^\d+_(.*)_[0-9a-f]+$", 1), "write": F.substring_index("part", "_", -1)}
    return rows.withColumns(said).drop("part")


def write_by_pixel(df: DataFrame, path: str, order: int = 3, mode: str = "errorifexists", rows_per_file: int = 5_000_000, without: tuple[str, ...] = (), phase: str = "rows") -> None:
    """A folder a pixel of (ra_deg, dec_deg), and in it one for each write that had rows there, named by its sequence in the pixel, its
    phase and its own name. `mode` is as in write_table(), or append, which goes on with the sequences of the writes before it.

    Spark's rebalancing deals a crowded pixel to several tasks and small pixels to one, by size, in the job that writes. A write counts once the
    log names it; what one that failed has left is never read. `without`: columns that only place a row.
    """
    spark = df.sparkSession

    def write(to: str) -> None:
        token = uuid.uuid4().hex
        last = pixel_manifest(spark, to).groupBy("healpix_pixel").agg(F.max("sequence").alias("last"))
        # a row a pixel, 12 * 4^order at most
        rows = with_pixel(df, order)
        placed = rows.join(F.broadcast(last), rows["healpix_pixel"].eqNullSafe(last["healpix_pixel"]), "left").drop(last["healpix_pixel"])
        name = F.format_string(f"%06d_{phase}_{token}", F.coalesce(F.col("last"), F.lit(0)) + 1)
        placed = placed.withColumn("part", name).drop("last", *without)
        placed.hint("rebalance", "healpix_pixel").write.mode("append").option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).partitionBy("healpix_pixel", "part").parquet(to)
        # only the counts in the files' footers are read
        there = spark.read.schema("healpix_pixel int, part string").parquet(to).filter(F.col("part").endswith(token))
        entries = _named(there.groupBy("healpix_pixel", "part").agg(F.count("*").alias("rows")))
        _committed(spark, to, entries.select(*(F.col(c).cast(t) for c, t in (x.split() for x in MANIFEST_SCHEMA.split(", ")))))

    write(path) if mode == "append" else guarded(spark, path, mode, write)


def read_by_pixel(spark: SparkSession, path: str, places: bool = False) -> DataFrame:
    """The rows of all committed writes, with healpix_pixel; with `places` also sequence and phase."""
    writes = [r["write"] for r in pixel_manifest(spark, path).select("write").distinct().collect()]  # one a write
    rows = spark.read.parquet(path)
    committed = rows.filter(F.substring_index("part", "_", -1).isin(writes))  # on the folders' names alone: others are not read
    return _named(committed).drop("write") if places else committed.drop("part")


def write_sidecars(sidecar: DataFrame, path: str, order: int = 3, mode: str = "errorifexists", maps: dict[str, dict[str, str]] | None = None, phase: str = "rows") -> list[str]:
    """The tables of sidecar_tables() in folders of their names, each by pixel; returns the names."""
    tables = sidecar_tables(sidecar, maps)
    writes = [lambda name=name, df=df: write_by_pixel(df, f"{path.rstrip('/')}/{name}", order, mode, without=PLACE, phase=phase) for name, df in tables.items()]
    if writes:
        at_once(sidecar.sparkSession, *writes)
    return list(tables)


def write_report(report: DataFrame, path: str) -> dict:
    """A one-row table as JSON with sorted keys, through Spark's writer; returns it."""
    row, spark = report.first().asDict(), report.sparkSession
    lines = spark.createDataFrame([(json.dumps(row, indent=2, sort_keys=True),)], "value string").coalesce(1)
    replaced(spark, path, lambda to: lines.write.text(to))
    return row
