"""Operator 9: benchmark decontamination by greedy string tiling.

A benchmark item and a document that share a seed (a run of MIN_MATCH words) are tiled: the longest runs that both hold and that are still
unmarked are found by Karp-Rabin fingerprints, marked in both, and so on down to MIN_MATCH words. Tiles never overlap
but may stand in any order, so passages that were cut up and reordered are caught. A document leaks an item when its tiles cover
at least COVERAGE of the item's words.

Words are lower-cased (A-Z) and lose ASCII signs at both ends; words of signs alone do not count. Items of fewer than MIN_MATCH words are
too short to be told from common speech and leak nothing, and neither do items without words, null texts and empty tables.
Rows with null ids are compared like others. Equal rows give a row each. Other columns are ignored. Items are broadcast in blocks of about BLOCK_WORDS words, one pass over the documents
for each, so what a worker holds is bounded however large the benchmark is. A document is never split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenforge.llm.shared import table, written
from lumenforge.llm.text import LOWER, column, mix, powers, slices, span_hashes, text_bytes, word_spans

MIN_MATCH = 5
COVERAGE = 0.5
BLOCK_WORDS = 4_000_000

_SIGN = np.zeros(256, bool)
_SIGN[33:48] = _SIGN[58:65] = _SIGN[91:97] = _SIGN[123:127] = True


def bare_words(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of words without signs at their ends, first word of each row)."""
    data, offsets = text_bytes(array)
    data = LOWER[data]
    starts, ends, first = word_spans(data, offsets)
    starts, ends = starts.copy(), ends.copy()
    live = np.arange(len(starts))
    while len(live := live[(starts[live] < ends[live]) & _SIGN[data[np.minimum(starts[live], len(data) - 1)]]]):
        starts[live] += 1
    live = np.arange(len(starts))
    while len(live := live[(starts[live] < ends[live]) & _SIGN[data[ends[live] - 1]]]):
        ends[live] -= 1
    full = starts < ends
    return span_hashes(data, starts[full], ends[full]), np.concatenate([[0], np.cumsum(full)])[first]


def windows(words: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin fingerprints of each run of `size` words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, inverse = powers(len(words))
    total = np.concatenate([[np.uint64(0)], np.cumsum(words * power, dtype=np.uint64)])
    return mix((total[size:] - total[:n]) * inverse[:n] + np.uint64(size))


def tiles(item: np.ndarray, doc: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in item, place in doc, words), the longest first."""
    free_i, free_d = np.ones(len(item), bool), np.ones(len(doc), bool)
    out: list[tuple[int, int, int]] = []

    def unmarked(size: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(hash, place) of the runs of this size without a marked word, of the item and of the document."""
        runs = []
        for words, free in ((item, free_i), (doc, free_d)):
            blocked = np.concatenate([[0], np.cumsum(~free)])
            hashes = windows(words, size)
            at = np.flatnonzero(blocked[size:] == blocked[: len(hashes)])
            runs.append((hashes[at], at))
        return runs

    def common(size: int) -> bool:
        (hi, _), (hd, _) = unmarked(size)
        return bool(np.isin(hi, hd).any())

    def mark(size: int) -> None:
        """Marks the common runs of this size: each of the item's, in order, with the first of the document's that is still free."""
        (hi, pi), (hd, pd_) = unmarked(size)
        order = np.argsort(hd, kind="stable")
        hd, pd_ = hd[order], pd_[order]
        low, high = np.searchsorted(hd, hi, "left"), np.searchsorted(hd, hi, "right")
        next_free: dict[int, int] = {}  # by a hash's first place among hd: what is marked stays so
        for i, a, b in zip(pi[low < high].tolist(), low[low < high].tolist(), high[low < high].tolist(), strict=True):
            if not free_i[i : i + size].all():
                continue
            at = next_free.get(a, a)
            while at < b and not free_d[pd_[at] : pd_[at] + size].all():
                at += 1
            next_free[a] = at
            if at < b and (item[i : i + size] == doc[pd_[at] : pd_[at] + size]).all():
                d = int(pd_[at])
                free_i[i : i + size] = free_d[d : d + size] = False
                out.append((i, d, size))

    high = min(len(item), len(doc))
    while high >= least:
        # the longest size with a common unmarked run: runs of a size hold runs of all smaller sizes
        low, top = least - 1, high
        while low < top:
            middle = (low + top + 1) // 2
            if common(middle):
                low = middle
            else:
                top = middle - 1
        if low < least:
            break
        mark(low)
        high = low - 1
    return out


class Items:
    """A block of benchmark items of at least min_match words, with their seeds in order of hash."""

    def __init__(self, ids: list, words: list[np.ndarray], min_match: int):
        long = [k for k, w in enumerate(words) if len(w) >= min_match]
        self.ids, self.words, self.min_match = [ids[k] for k in long], [words[k] for k in long], min_match
        hashes = [windows(w, min_match) for w in self.words]
        h = np.concatenate([np.zeros(0, np.uint64), *hashes])
        order = np.argsort(h, kind="stable")
        self.seeds = h[order]
        self.owner = np.repeat(np.arange(len(long)), [len(x) for x in hashes])[order]
        self.place = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(x)) for x in hashes)])[order]

    def leaks(self, words: np.ndarray, first: np.ndarray, coverage: float) -> list[tuple[int, int, float, list[tuple[int, int, int]]]]:
        """(row, item, coverage, tiles) of each row that leaks an item."""
        out, size = [], self.min_match
        h = windows(words, size)
        if not len(self.seeds) or not len(h):
            return out
        at = np.flatnonzero(self.seeds[np.minimum(np.searchsorted(self.seeds, h), len(self.seeds) - 1)] == h)
        rows = np.searchsorted(first, at, "right") - 1
        inside = at + size <= first[rows + 1]
        at, rows = at[inside], rows[inside]
        cuts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1], [True]])) if len(rows) else np.zeros(1, np.int64)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            row, mine = rows[a], np.unique(h[at[a:b]])
            low, high = np.searchsorted(self.seeds, mine, "left"), np.searchsorted(self.seeds, mine, "right")
            hits = np.repeat(low - (np.cumsum(high - low) - (high - low)), high - low) + np.arange((high - low).sum())
            hits = hits[np.argsort(self.owner[hits], kind="stable")]
            owner, place = self.owner[hits], self.place[hits]
            of = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1], [True]]))
            doc = words[first[row] : first[row + 1]]
            for x, y in zip(of[:-1], of[1:], strict=True):
                item = self.words[owner[x]]
                # tiles lie within the seeds: too few seeded words cannot cover enough
                edge = np.zeros(len(item) + 1, np.int64)
                np.add.at(edge, place[x:y], 1)
                np.add.at(edge, place[x:y] + size, -1)
                if (np.cumsum(edge[:-1]) > 0).sum() < coverage * len(item):
                    continue
                got = tiles(item, doc, size)
                share = sum(n for _, _, n in got) / len(item)
                if share >= coverage:
                    out.append((int(row), int(owner[x]), share, got))
        return out


def item_blocks(benchmark: DataFrame, min_match: int = MIN_MATCH) -> Iterator[Items]:
    """The items, block by block (item_id, text)."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text IS NOT NULL")
    size = rows.agg(F.sum(F.size(F.split("text", "\\s+")))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_WORDS))
    for b in range(blocks):
        got = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").toArrow()
        text = got["text"].combine_chunks() if got.num_rows else pa.array([], pa.string())
        words, first = bare_words(text)
        yield Items(got["item_id"].to_pylist(), [words[a:z] for a, z in zip(first[:-1], first[1:], strict=True)], min_match)


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, item_id, coverage, n_tiles, longest, tiles (item_start, doc_start, n_words) of each document and item it leaks."""
    schema = "doc_id long, item_id long, coverage double, n_tiles int, longest int, tiles array<struct<item_start:int,doc_start:int,n_words:int>>"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for items in item_blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)
        found = rows.mapInArrow(_leaks(shared, coverage), schema)
        out = found if out is None else out.unionByName(found)
    return out


def _leaks(shared, coverage: float):
    tile = pa.struct([("item_start", pa.int32()), ("doc_start", pa.int32()), ("n_words", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for batch in batches:
            for rows in slices(batch, "text"):
                words, first = bare_words(column(rows, "text"))
                got = items.leaks(words, first, coverage)
                if got:
                    ids = column(rows, "doc_id").take(pa.array([g[0] for g in got]))
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids, pa.array([items.ids[g[1]] for g in got], pa.int64()), pa.array([g[2] for g in got]), pa.array([len(g[3]) for g in got], pa.int32()),
                            pa.array([max(n for _, _, n in g[3]) for g in got], pa.int32()), pa.array([[{"item_start": i, "doc_start": d, "n_words": n} for i, d, n in g[3]] for g in got], pa.list_(tile)),
                        ],
                        ["doc_id", "item_id", "coverage", "n_tiles", "longest", "tiles"],
                    )

    return run


def without_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of docs that leak no item, in one pass without a shuffle for each block of items.

    Between blocks the rows are written, so that a task has one worker and one block at a time."""
    for k, items in enumerate(item_blocks(benchmark)):
        docs = written(docs, "clean") if k else docs
        shared = docs.sparkSession.sparkContext.broadcast(items)
        docs = docs.mapInArrow(_kept(shared, coverage), docs.schema)
    return docs


def _kept(shared, coverage: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text"):
                words, first = bare_words(column(rows, "text"))
                keep = np.ones(rows.num_rows, bool)
                keep[[g[0] for g in shared.value.leaks(words, first, coverage)]] = False
                yield rows.filter(pa.array(keep))

    return run


def op9_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
