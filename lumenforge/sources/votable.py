"""VOTables as a Spark data source: one partition a file, decoded from an open stream.

The three serialisations TABLEDATA, BINARY and BINARY2 give the same rows; files may be plain, gzip or xz. A file goes through an
XML parser in pieces of CHUNK_BYTES, and rows leave as Arrow batches of BATCH_ROWS, so a task never holds a whole file, nor one large
text node of it. Files are opened with pyarrow's file systems (local, hdfs, s3, gs), since tasks of a Python source have no JVM.

Missing values: empty cells, the value that a column declares as its null, the null mask of BINARY2 and, in numbers, NaN, are NULL.
"""

from __future__ import annotations

import base64
import gzip
import lzma
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from xml.parsers import expat

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import StructType

SUFFIXES = (".vot", ".vot.gz", ".vot.xz")
CHUNK_BYTES, BATCH_ROWS = 1 << 20, 50_000
#: The column that says where a row came, if it is asked for: rank of the file by its path, and row in it.
ORDER = "input_order"

# Fixed values of the format: bytes of a value, how NumPy reads it, and what a column of it is
KINDS = {
    "boolean": (1, "S1", pa.bool_()), "unsignedByte": (1, "u1", pa.int16()), "short": (2, ">i2", pa.int16()), "int": (4, ">i4", pa.int32()), "long": (8, ">i8", pa.int64()),
    "float": (4, ">f4", pa.float32()), "double": (8, ">f8", pa.float64()), "floatComplex": (8, ">f4", pa.float32()), "doubleComplex": (16, ">f8", pa.float64()),
    "char": (1, "S1", pa.string()), "unicodeChar": (2, ">u2", pa.string()), "bit": (1, "u1", pa.bool_()),
}
TRUE, FALSE = ("t", "1", "true"), ("f", "0", "false")


@dataclass
class Field:
    """A column as its FIELD says."""

    name: str
    kind: str
    size: str | None = None  # arraysize: "3", "*", "8*" or "2x3"
    null: str | None = None

    @property
    def text(self) -> bool:
        return self.kind in ("char", "unicodeChar")

    @property
    def variable(self) -> bool:
        return bool(self.size) and self.size.strip().endswith("*")

    @property
    def count(self) -> int:
        """Values of a fixed array."""
        out = 1
        for n in (self.size or "1").split("x"):
            out *= int(n)
        return out

    @property
    def complex(self) -> bool:
        return self.kind.endswith("Complex")

    @property
    def arrow(self) -> pa.DataType:
        one = KINDS[self.kind][2]
        if self.text:
            return pa.list_(one) if "x" in (self.size or "") else one
        return pa.list_(one) if self.size not in (None, "1") or self.complex else one

    def number(self, text: str):
        """One value from its text; None if it has none."""
        text = text.strip()
        if not text or text == self.null:
            return None
        if self.kind in ("boolean", "bit"):
            low = text.lower()
            return True if low in TRUE else False if low in FALSE else None
        if self.kind in ("float", "double", "floatComplex", "doubleComplex"):
            value = float(text.replace("Inf", "inf"))
            return None if value != value else value
        return int(text, 16) if text[:2].lower() == "0x" else int(text)

    def from_text(self, text: str):
        """A cell of TABLEDATA."""
        if self.text:
            if "x" not in (self.size or ""):
                return text.rstrip("\0") or None
            width = int(self.size.split("x")[0])
            return [text[k : k + width].rstrip() for k in range(0, len(text), width)] or None
        if not pa.types.is_list(self.arrow):
            return self.number(text)
        return [self.number(t) for t in text.split()] or None

    def from_values(self, raw: bytes, n: int):
        """n values of a cell of BINARY or BINARY2."""
        if self.text:
            text = raw.decode("utf-16-be" if self.kind == "unicodeChar" else "utf-8", "replace")
            if "x" in (self.size or ""):
                width = int(self.size.split("x")[0])
                return [text[k : k + width].rstrip("\0 ") for k in range(0, len(text), width)] or None
            return text.split("\0", 1)[0] or None
        if self.kind == "bit":
            values = np.unpackbits(np.frombuffer(raw, np.uint8))[:n].astype(bool).tolist()
        elif self.kind == "boolean":
            values = [True if c in b"Tt1" else False if c in b"Ff0" else None for c in raw]
        else:
            values = np.frombuffer(raw, KINDS[self.kind][1]).tolist()
            null = int(self.null, 0) if self.null and KINDS[self.kind][1][-2] in "iu" else None
            values = [None if v != v or v == null else v for v in values]
        if pa.types.is_list(self.arrow):
            return values or None
        return values[0] if values else None

    def bytes_of(self, n: int) -> int:
        return (n + 7) // 8 if self.kind == "bit" else n * KINDS[self.kind][0]


class BinaryRows:
    """Rows out of the bytes of BINARY (masked=False) or BINARY2, as they come; only the columns in `wanted` are made."""

    def __init__(self, fields: list[Field], wanted: list[int], masked: bool):
        self.fields, self.wanted = fields, wanted
        self.mask = (len(fields) + 7) // 8 if masked else 0
        self.left = b""
        plain = not any(f.variable or pa.types.is_list(f.arrow) or f.kind == "unicodeChar" for f in fields)
        #: Rows of one width that hold single values and texts are read many at a time.
        self.layout = np.dtype([("mask", "u1", (self.mask,))] + [(f"c{k}", f"S{f.count}" if f.text else KINDS[f.kind][1]) for k, f in enumerate(fields)]) if plain else None

    def feed(self, data: bytes) -> list[list] | None:
        """Columns of the whole rows that are there now (one of None where no column is wanted), or None without a row."""
        data = self.left + data
        if self.layout is not None:
            n = len(data) // self.layout.itemsize if self.layout.itemsize else 0
            self.left = data[n * self.layout.itemsize :]
            return (self.many(np.frombuffer(data, self.layout, n)) or [[None] * n]) if n else None
        rows, at = [], 0
        while (got := self.one(data, at)) is not None:
            row, at = got
            rows.append(row)
        self.left = data[at:]
        return (list(map(list, zip(*rows, strict=True))) or [[None] * len(rows)]) if rows else None

    def many(self, rows: np.ndarray) -> list[list]:
        nulls = np.unpackbits(rows["mask"], axis=1).astype(bool) if self.mask else None
        out = []
        for k in self.wanted:
            field, values = self.fields[k], rows[f"c{k}"]
            if field.text:
                made = [v.split(b"\0", 1)[0].decode("utf-8", "replace") or None for v in values.tolist()]
            elif field.kind in ("boolean", "bit"):
                made = [field.from_values(v.tobytes(), 1) for v in values]
            else:
                missing = values != values
                if field.null and values.dtype.kind in "iu":
                    missing |= values == int(field.null, 0)
                made = [None if m else v for v, m in zip(values.tolist(), missing.tolist(), strict=True)]
            out.append(made if nulls is None else [None if gone else v for v, gone in zip(made, nulls[:, k].tolist(), strict=True)])
        return out

    def one(self, data: bytes, at: int) -> tuple[list, int] | None:
        """The row at a place and where the next begins; None if it is not all there."""
        start = at
        at += self.mask
        row = [None] * len(self.wanted)
        place = {k: j for j, k in enumerate(self.wanted)}
        for k, field in enumerate(self.fields):
            n = 1
            if field.variable:
                if at + 4 > len(data):
                    return None
                n = struct.unpack_from(">i", data, at)[0]
                at += 4
                for fixed in field.size.split("x")[:-1]:
                    n *= int(fixed)
            elif field.size:
                n = field.count
            size = field.bytes_of(n)
            if at + size > len(data):
                return None
            if k in place and not (self.mask and data[start + k // 8] >> (7 - k % 8) & 1):
                row[place[k]] = field.from_values(data[at : at + size], n)
            at += size
        return (row, at) if at > start and at <= len(data) else None


class Decoder:
    """A VOTable, fed in pieces: blocks of columns of the names in `wanted` (lower case) gather in `blocks`.

    A column that a table does not have is missing in `fields` and None in its blocks.
    """

    def __init__(self, path: str, wanted: list[str] | None):
        self.path, self.wanted = path, wanted
        self.fields: list[Field] = []
        self.blocks: list[tuple[dict[str, Field], list[list]]] = []
        self.rows: list[list] = []
        self.cell: list[str] | None = None
        self.form: str | None = None
        self.binary: BinaryRows | None = None
        self.digits = ""
        self.started = False
        self.parser = expat.ParserCreate()
        self.parser.buffer_text, self.parser.buffer_size = True, 1 << 18
        self.parser.StartElementHandler, self.parser.EndElementHandler, self.parser.CharacterDataHandler = self.start, self.end, self.said

    def columns(self) -> list[int]:
        names = [f.name for f in self.fields]
        return [names.index(w) for w in self.wanted if w in names] if self.wanted is not None else list(range(len(names)))

    def start(self, name: str, given: dict) -> None:
        tag = name.rpartition(":")[2]
        if tag == "TABLE":
            self.fields = []
        elif tag == "FIELD":
            kind = given.get("datatype", "char")
            if kind not in KINDS:
                raise ValueError(f"{self.path}: a column of type {kind}")
            self.fields.append(Field(given.get("name", "").strip().lower(), kind, given.get("arraysize")))
        elif tag == "VALUES" and self.fields and "null" in given:
            self.fields[-1].null = given["null"].strip()
        elif tag in ("TABLEDATA", "BINARY", "BINARY2", "FITS"):
            if tag == "FITS":
                raise ValueError(f"{self.path}: data in the form FITS")
            self.form, self.started, self.at = tag, True, self.columns()
            self.binary = BinaryRows(self.fields, self.at, tag == "BINARY2") if tag != "TABLEDATA" else None
        elif tag == "STREAM":
            if "href" in given or given.get("encoding", "base64") != "base64":
                raise ValueError(f"{self.path}: a stream that is not base64 in the file itself")
            self.cell = []
        elif tag == "TR":
            self.row: list[str | None] = []
        elif tag == "TD":
            self.cell = []

    def said(self, text: str) -> None:
        if self.cell is None:
            return
        self.cell.append(text)

    def drain(self) -> None:
        """Decodes what a stream has said so far."""
        digits = self.digits + "".join("".join(self.cell).split())
        whole = len(digits) // 4 * 4
        self.cell, self.digits = [], digits[whole:]
        if block := self.binary.feed(base64.b64decode(digits[:whole], validate=True)):
            self.add(block)

    def end(self, name: str) -> None:
        tag = name.rpartition(":")[2]
        if tag == "TD":
            self.row.append("".join(self.cell))
            self.cell = None
        elif tag == "TR":
            cells = self.row + [""] * (len(self.fields) - len(self.row))
            self.rows.append([self.fields[k].from_text(cells[k]) for k in self.at])
        elif tag == "STREAM":
            self.drain()
            if self.digits or self.binary.left:
                raise ValueError(f"{self.path}: the data end within a row")
            self.cell = None
        elif tag in ("TABLEDATA", "BINARY", "BINARY2"):
            self.flush()
            self.form = self.binary = None

    def add(self, block: list[list]) -> None:
        self.blocks.append(([self.fields[k] for k in self.at], block))

    def flush(self) -> None:
        if self.rows:
            self.add(list(map(list, zip(*self.rows, strict=True))) or [[None] * len(self.rows)])
            self.rows = []

    def feed(self, data: bytes, last: bool = False) -> None:
        self.parser.Parse(data, last)
        if self.binary and self.cell:
            self.drain()
        if len(self.rows) >= BATCH_ROWS:
            self.flush()


def opened(path: str):
    """An open stream of a file's bytes, decompressed by what its name says."""
    system, at = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    raw = system.open_input_stream(at, compression=None)
    low = path.lower()
    return gzip.GzipFile(fileobj=raw) if low.endswith(".gz") else lzma.LZMAFile(raw) if low.endswith(".xz") else raw


def files(path: str) -> list[str]:
    """VOTable files, told by their suffix whatever its case: of a folder in order of name, or the one file that path is."""
    system, at = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    head = path[: len(path) - len(at)] if path.endswith(at) else ""
    info = system.get_file_info(at)
    if info.type == fs.FileType.NotFound:
        raise ValueError(f"{path}: no such file or folder")
    if info.type == fs.FileType.File:
        return [path]
    inside = system.get_file_info(fs.FileSelector(at))
    return sorted(head + f.path for f in inside if f.type == fs.FileType.File and f.base_name.lower().endswith(SUFFIXES))


def fitted(values: list, kind: pa.DataType) -> pa.Array:
    """values as `kind`; those that do not fit are NULL."""
    try:
        return pa.array(values, kind)
    except (pa.ArrowInvalid, pa.ArrowTypeError, OverflowError, TypeError):
        pass

    def one(v):
        try:
            if v is None:
                return None
            if pa.types.is_string(kind):
                return str(v)
            if pa.types.is_integer(kind):
                whole = int(v) if not isinstance(v, float) or v.is_integer() else None
                return None if whole is None else pa.scalar(whole, kind).as_py()
            if pa.types.is_floating(kind):
                return float(v)
            return pa.scalar(v, kind).as_py()
        except (ValueError, TypeError, OverflowError, pa.ArrowInvalid):
            return None

    return pa.array([one(v) for v in values], kind)


def batches(path: str, schema: pa.Schema, rank: int = 0) -> Iterator[pa.RecordBatch]:
    """A file's rows in its order, as batches of the schema."""
    decoder = Decoder(path, [n for n in schema.names if n != ORDER])
    done = 0
    with opened(path) as stream:
        while True:
            data = stream.read(CHUNK_BYTES)
            decoder.feed(data, last=not data)
            for fields, block in decoder.blocks:
                n = len(block[0])
                have = {f.name: c for f, c in zip(fields, block, strict=False)}
                columns = []
                for field in schema:
                    if field.name == ORDER:
                        columns.append(pa.StructArray.from_arrays([pa.array(np.full(n, rank), pa.int32()), pa.array(np.arange(done, done + n), pa.int64())], fields=list(field.type)))
                    else:
                        columns.append(fitted(have[field.name], field.type) if field.name in have else pa.nulls(n, field.type))
                done += n
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
            decoder.blocks = []
            if not data:
                return


def header(path: str) -> list[Field]:
    """The columns of a file's first table, from no more of it than it takes."""
    decoder = Decoder(path, None)
    with opened(path) as stream:
        while not decoder.started and (data := stream.read(1 << 16)):
            decoder.feed(data)
    return decoder.fields


@dataclass
class File(InputPartition):
    path: str
    rank: int


class Reader(DataSourceReader):
    def __init__(self, schema: StructType, path: str):
        self.schema, self.path = schema, path

    def partitions(self) -> list[File]:
        return [File(path, rank) for rank, path in enumerate(files(self.path))]

    def read(self, partition: File) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark gives where there are no files
            return
        yield from batches(partition.path, to_arrow_schema(self.schema), partition.rank)


class VOTables(DataSource):
    """format("votable"): a file or folder of VOTables. Without a schema, that of the first file by name, names in lower case."""

    @classmethod
    def name(cls) -> str:
        return "votable"

    def schema(self) -> StructType:
        found = files(self.options["path"])
        if not found:
            raise ValueError(f"{self.options['path']}: no VOTables")
        return from_arrow_schema(pa.schema([pa.field(f.name, f.arrow) for f in header(found[0])]))

    def reader(self, schema: StructType) -> Reader:
        return Reader(schema, self.options["path"])
