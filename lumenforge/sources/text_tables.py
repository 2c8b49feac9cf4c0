"""VOTable, YAML and TOML inputs."""

from __future__ import annotations

import re
import tomllib
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenforge.functions.ids import source_name
from lumenforge.functions.ids import text as clean
from lumenforge.operators.common import conform
from lumenforge.operators.gaia import CARRY_TYPES, CarryField
from lumenforge.operators.schemas import IDENTIFIERS
from lumenforge.operators.source import ALIASES, aliases
from lumenforge.sources.votable import ORDER, VOTables

def read_votable(spark: SparkSession, path: str, columns: dict[str, str] | None = None, input_order: bool = False) -> DataFrame:
    """Rows of the VOTables of a folder, or of one file: the named columns in lower case with their Spark types (without names, those
    of the first file). input_order: a column of that name sorts them by file name and place."""
    spark.dataSource.register(VOTables)
    reader = spark.read.format("votable").option("path", path)
    if columns is None and input_order:
        columns = dict(reader.load().dtypes)
    if columns is None:
        return reader.load()
    order = f", {ORDER} struct<file:int,row:bigint>" if input_order else ""
    return reader.schema(", ".join(f"`{c}` {t}" for c, t in columns.items()) + order).load()


def output_name(name: str) -> str:
    """x.vot.gz becomes x.parquet."""
    stem = re.sub(r"\.vot\.(gz|xz)$", "", name)
    return (stem if stem != name else name.rpartition(".")[0] or name) + ".parquet"


# What a drop must say, and the identifiers that a star may carry
DROP_KEYS = ("override_id", "action", "source", "source_id", "override_reason", "override_policy_version")
NUMBERS, NAMES = ("gaia_source_id", "hip_id", "hd", "flamsteed"), ("bayer", "constellation", "proper_name")
_TEXT = ("override_id", "action", "source", "source_id", "override_reason", "override_policy_version")
_NUMBER = ("ra_deg", "dec_deg", "r_pc", "x_icrs_pc", "y_icrs_pc", "z_icrs_pc", "mag_abs", "teff")


def override_stars(name: str, text: str) -> list[dict]:
    """The stars of one YAML text, with its description as `file_description`. A file without content or `stars` has none."""
    import yaml

    root = yaml.safe_load(text)
    if root is None:
        return []
    if not isinstance(root, dict):
        raise ValueError(f"{name}: the root must be a mapping")
    stars = root.get("stars")
    stars = [] if stars is None else stars
    if not isinstance(stars, list) or not all(isinstance(s, dict) for s in stars):
        raise ValueError(f"{name}: `stars` must be a list of mappings")
    return [s | {"file_description": root.get("description")} for s in stars]


def checked_star(name: str, star: dict) -> dict:
    """star, if it says what its action needs: a drop all of DROP_KEYS, others where the star is."""
    dropped = star.get("action") == "drop"
    needed = DROP_KEYS if dropped else ("ra_deg", "dec_deg", "r_pc")
    if missing := [k for k in needed if star.get(k) is None]:
        raise ValueError(f"{name}: {star.get('action')} {star.get('override_id')} lacks {', '.join(missing)}")
    if not dropped and sum(star.get(k) is not None for k in ("x_icrs_pc", "y_icrs_pc", "z_icrs_pc")) in (1, 2):
        raise ValueError(f"{name}: {star.get('override_id')}: x, y and z come together or not at all")
    return star


def _yaml_rows(spark: SparkSession, path: str, schema: str, made) -> DataFrame:
    """made(file name, text) of each YAML file of a folder as rows, in order of file name and place."""
    texts = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("name"), "value").filter(F.lower("name").rlike(r"\.ya?ml$"))

    def rows(batches):
        import pandas as pd

        for batch in batches:
            for name, text in zip(batch["name"], batch["value"], strict=True):
                got = [{**r, "source_file": name, "nth": k} for k, r in enumerate(made(name, text))]
                yield pd.DataFrame(got, columns=[c.split()[0] for c in schema.split(", ")])

    return texts.mapInPandas(rows, schema).orderBy("source_file", "nth").drop("nth")


def read_overrides(spark: SparkSession, path: str) -> DataFrame:
    """Raw override rows of the YAML files of a folder, in order of file name, with source_file and file_description."""
    schema = ", ".join([*(f"{c} string" for c in _TEXT), *(f"{c} double" for c in _NUMBER), "file_description string", "source_file string", "nth int"])

    def made(name: str, text: str) -> list[dict]:
        get = lambda s, c, kind: None if s.get(c) is None else kind(s[c])
        return [{**{c: get(s, c, str) for c in (*_TEXT, "file_description")}, **{c: get(s, c, float) for c in _NUMBER}} for s in (checked_star(name, s) for s in override_stars(name, text))]

    return _yaml_rows(spark, path, schema, made)


def read_override_identifiers(spark: SparkSession, path: str) -> DataFrame:
    """Identifier rows of the stars that carry a mapping `identifiers` and a source_id; what is no number, or empty, is NULL."""
    schema = ", ".join(["source string", "source_id string", *(f"{c} string" for c in (*NUMBERS, *NAMES)), "source_file string", "nth int"])

    def made(name: str, text: str) -> list[dict]:
        stars = [s for s in override_stars(name, text) if isinstance(s.get("identifiers"), dict) and s["identifiers"] and s.get("source_id") is not None]
        return [{"source": str(s.get("source", "")), "source_id": str(s["source_id"]), **{c: None if s["identifiers"].get(c) is None else str(s["identifiers"][c]) for c in (*NUMBERS, *NAMES)}} for s in stars]

    rows = _yaml_rows(spark, path, schema, made).drop("source_file")
    rows = rows.select(source_name(F.col("source")).alias("source"), F.trim("source_id").alias("source_id"), *(F.trim(c).try_cast("long").alias(c) for c in NUMBERS), *(clean(F.col(c)).alias(c) for c in NAMES))
    return conform(rows, IDENTIFIERS)


def field_set(text: str, name: str = "fields") -> tuple[CarryField, ...]:
    """Carried columns from TOML, a table [[fields]] each: name, dtype and sidecar; then either an expression over the archive's
    tables (aliases g, d, ap, aps), or source ("input" or "stage") and column."""
    simple = re.compile(r"[a-z][a-z0-9_]*")
    tables = tomllib.loads(text).get("fields")
    if not isinstance(tables, list) or not tables:
        raise ValueError(f"{name}: no [[fields]]")
    out: dict[str, CarryField] = {}
    for f in tables:
        asked = {"name": None, "dtype": CARRY_TYPES, "sidecar": None} | ({} if "expression" in f else {"source": ("input", "stage"), "column": None})
        for key, allowed in asked.items():
            value = f.get(key)
            if not isinstance(value, str) or (value not in allowed if allowed else not simple.fullmatch(value)):
                raise ValueError(f"{name}: {key} {value!r}")
        if f["name"].startswith("gaia_"):
            raise ValueError(f"{name}: {f['name']} must not have the prefix of the output")
        expression = f.get("expression")
        if "expression" in f and (not isinstance(expression, str) or not expression.strip() or aliases(expression) - set(ALIASES)):
            raise ValueError(f"{name}: {f['name']}: expression {expression!r}")
        if f["name"] in out:
            raise ValueError(f"{name}: {f['name']} is there twice")
        out[f["name"]] = CarryField(f["name"], f["dtype"], "query" if expression else f["source"], None if expression else f["column"], expression and expression.strip(), f["sidecar"], f.get("unit"))
    return tuple(out.values())


def field_sets(texts: dict[str, str]) -> tuple[CarryField, ...]:
    """The fields of several sets by name; a field may be in one of them only."""
    fields = [f for name, text in texts.items() for f in field_set(text, name)]
    if twice := sorted(n for n, k in Counter(f.name for f in fields).items() if k > 1):
        raise ValueError(f"fields in two sets: {', '.join(twice)}")
    return tuple(fields)
