import re
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

SMALL = "/root/testdata/sf0.001"

DOCUMENTS = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())])


def words(text: str | None) -> list[str]:
    """The brute-force tests' own idea of a word."""
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def documents(*texts, lang="en") -> pa.Table:
    rows = [{"doc_id": k, "text": t, "lang": lang, "source": "s", "n_chars": None if t is None else len(t)} for k, t in enumerate(texts)]
    return pa.Table.from_pylist(rows, DOCUMENTS)


@pytest.fixture
def folder(tmp_path):
    """Writes tables to a folder of their own and returns its path."""

    def made(**tables: pa.Table) -> str:
        at = Path(tmp_path, f"sf{len(list(tmp_path.iterdir()))}")
        at.mkdir()
        for name, rows in tables.items():
            pq.write_table(rows, at / f"{name}.parquet")
        return str(at)

    return made


@pytest.fixture
def odd() -> pa.Table:
    """Nulls in every column, empty and letterless texts, a long text, repeated rows, and columns with names the operators use."""
    long = " ".join(f"word{k % 997} tail{k % 31}" for k in range(60_000))
    rows = [
        {"doc_id": 1, "text": None, "lang": None, "source": None, "n_chars": None},
        {"doc_id": 2, "text": "", "lang": "en", "source": "a", "n_chars": 0},
        {"doc_id": 3, "text": "   \t\n ", "lang": "en", "source": "a", "n_chars": 6},
        {"doc_id": 4, "text": "one", "lang": "en", "source": "a", "n_chars": 3},
        {"doc_id": 5, "text": "1234 5678 !!!", "lang": "en", "source": "a", "n_chars": 13},
        {"doc_id": 6, "text": long, "lang": "en", "source": "a", "n_chars": len(long)},
        {"doc_id": 7, "text": "the same text twice here", "lang": "en", "source": "a", "n_chars": 24},
        {"doc_id": 7, "text": "the same text twice here", "lang": "en", "source": "a", "n_chars": 24},
        {"doc_id": 8, "text": "the same text twice here", "lang": "de", "source": "b", "n_chars": 24},
        {"doc_id": None, "text": "a row without an id éè \U0001f600", "lang": "fr", "source": "b", "n_chars": 20},
    ]
    table = pa.Table.from_pylist(rows, DOCUMENTS)
    for clash in ("class", "uid", "component_id", "spans", "n", "shard"):
        table = table.append_column(clash, pa.array(range(len(rows))))
    return table
