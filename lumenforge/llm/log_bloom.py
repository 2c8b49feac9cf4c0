"""Operator 1: n-gram language-model scores from a log-frequency Bloom filter.

Counts of n-grams (2 to ORDER words) over all training texts are quantised to levels of a logarithm: level q stands for counts
of at least BASE^(q-1). A Bloom filter holds each n-gram once for each of its levels; probing levels 1, 2, ... until one is absent
returns the level, never too low. Unigram counts are exact. The model backs off from order to order:
P(w|h) = (c(hw) + m * P(w|shorter h)) / (c(h) + m), m = MU * c(h)^GAMMA, with quantised counts rounded down above the line and up below, so a context's
probabilities do not sum to more than 1 but for false positives.

Counting and building are distributed: each task tallies its n-grams, hash buckets merge the tallies, and each bucket builds
its own part of the filter and of the unigram table. The parts are broadcast in segments of at most SEGMENT_BYTES, each
segment in a pass of its own over the texts that fills in the levels of its n-grams; a corpus whose filter fits one segment takes one pass.
So what a worker holds is bounded, whatever the size of the corpus, and nothing is pruned.

Null texts are empty: one end token. A text's words are lower-cased (A-Z) runs of bytes other than white space. Rows with a null
doc_id are held out. Without training tokens every count is 0, and base_score uses N = V = 0. Equal rows are scored each on
its own; other columns are ignored. Words and n-grams are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenforge.llm.language import held_out
from lumenforge.llm.shared import input_partitions, table, written
from lumenforge.llm.text import column, mix, slices, tallied, word_hashes

ORDER = 2
BASE = 1.6
#: The back-off weight of a context seen c times is MU * c^GAMMA: as Heaps' law has it, its distinct followers grow so.
MU, GAMMA = 4.0, 0.8
PROBES = 4
BITS_PER_ENTRY = 10
SEGMENT_BYTES = 192 << 20
#: Tallies of a task are handed on when they hold so many n-grams.
TALLY = 4_000_000
END = np.uint64(0x5851F42D4C957F2D)


def tokens(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of each row's words and one end, first token of each row)."""
    words, first = word_hashes(array)
    out = np.full(len(words) + len(array), END, np.uint64)
    out[np.arange(len(words)) + np.repeat(np.arange(len(array)), np.diff(first))] = words
    return out, first + np.arange(len(first))


def ngrams(words: np.ndarray, first: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the n-gram that ends at each token, whether it lies within its row)."""
    h = words.copy()
    inside = np.ones(len(words), bool)
    starts = first[:-1]
    for j in range(1, order):
        h[j:] = h[j:] * np.uint64(0xD1342543DE82EF95) + words[: len(words) - j]
        at = starts + j - 1
        inside[at[at < first[1:]]] = False
    return mix(h + np.uint64(order)), inside


def levels(counts: np.ndarray) -> np.ndarray:
    """Quantised counts: 1 + floor(log_BASE(count)), exact at the powers."""
    q = np.floor(np.log(np.maximum(counts, 1)) / np.log(BASE) + 1e-9).astype(np.int64) + 1
    return np.where(counts > 0, q, 0)


def at_least(level: np.ndarray) -> np.ndarray:
    """The smallest whole count of a level."""
    return np.where(level > 0, np.ceil(BASE ** (level - 1.0) - 1e-9), 0.0)


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def _positions(keys: np.ndarray, level: int, sizes: np.ndarray) -> list[np.ndarray]:
    """Bits of (key, level) in a part of the given size."""
    h = mix(keys + np.uint64(level * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    step = mix(h) | np.uint64(1)
    return [((h + np.uint64(k) * step) % sizes).astype(np.int64) for k in range(PROBES)]


def _counted(buckets: int, order: int):
    schema = ["bucket", "order", "keys", "counts"]

    def handed(n: int, held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys, counts = tallied(np.concatenate(held))
        where = _bucket(keys, buckets)
        by = np.argsort(where, kind="stable")
        keys, counts = keys[by], counts[by].astype(np.uint32)
        cuts = np.searchsorted(where[by], np.arange(buckets + 1))
        full = np.flatnonzero(np.diff(cuts))
        for b in full:
            part = slice(cuts[b], cuts[b + 1])
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([n], pa.int32()), pa.array([keys[part].tobytes()], pa.binary()), pa.array([counts[part].tobytes()], pa.binary())], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {n: [] for n in range(1, order + 1)}
        for batch in batches:
            for rows in slices(batch, "text"):
                words, first = tokens(column(rows, "text"))
                for n in held:
                    keys, inside = ngrams(words, first, n)
                    held[n].append(keys[inside])
                    if sum(map(len, held[n])) > TALLY:
                        yield from handed(n, held[n])
                        held[n] = []
        for n, kept in held.items():
            if kept:
                yield from handed(n, kept)

    return run


def _merged(rows: pa.Table) -> pa.Table:
    """One bucket and order: its distinct n-grams; unigrams as they are, longer ones as a part of the filter."""
    keys = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in rows["keys"]])
    counts = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in rows["counts"]]).astype(np.int64)
    keys, counts = tallied(keys, counts)
    order = rows["order"][0].as_py()
    if order == 1:
        data, more = keys.tobytes(), counts.tobytes()
        size = len(keys)
    else:
        q = levels(counts)
        size = max(64, int(BITS_PER_ENTRY * q.sum()) + 7 & ~7)
        bits = np.zeros(size, np.uint8)
        for level in range(1, int(q.max()) + 1):
            for at in _positions(keys[q >= level], level, np.uint64(size)):
                bits[at] = 1
        data, more = np.packbits(bits, bitorder="little").tobytes(), b""
    return pa.table({"bucket": rows["bucket"][:1], "order": rows["order"][:1], "size": [size], "total": [int(counts.sum())], "data": pa.array([data], pa.binary()), "more": pa.array([more], pa.binary())})


class Segment:
    """The parts of some buckets: unigram tables and filter parts."""

    def __init__(self, sizes: list, buckets: int):
        """sizes: bucket, order and size of each part. Room is made once; `fill` takes the parts a few at a time."""
        self.buckets = buckets
        total = sum(r["size"] for r in sizes if r["order"] == 1)
        self.keys, self.counts, self.filled = np.empty(total, np.uint64), np.empty(total, np.int64), 0
        self.filters = {}
        for n in sorted({r["order"] for r in sizes} - {1}):
            size, start, at = np.zeros(buckets, np.uint64), np.zeros(buckets, np.int64), 0
            for r in sizes:
                if r["order"] == n:
                    size[r["bucket"]], start[r["bucket"]] = r["size"], at
                    at += r["size"]
            self.filters[n] = (size, start, np.zeros(at // 8, np.uint8))

    def fill(self, rows: list) -> None:
        for r in rows:
            if r["order"] == 1:
                to = slice(self.filled, self.filled + r["size"])
                self.keys[to], self.counts[to] = np.frombuffer(r["data"], np.uint64), np.frombuffer(r["more"], np.int64)
                self.filled += r["size"]
            else:
                _, start, bits = self.filters[r["order"]]
                at = start[r["bucket"]] // 8
                bits[at : at + len(r["data"])] = np.frombuffer(r["data"], np.uint8)

    def sort(self) -> None:
        by = np.argsort(self.keys)
        self.keys = self.keys[by]
        self.counts = self.counts[by].astype(np.uint32) if len(by) and self.counts.max() < 1 << 32 else self.counts[by]

    def unigrams(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.counts[at], 0).astype(np.int64)

    def level(self, n: int, keys: np.ndarray) -> np.ndarray:
        """Level of each n-gram: probes of levels 1, 2, ... until one is absent; 0 for those of other segments."""
        out = np.zeros(len(keys), np.int64)
        if n not in self.filters:
            return out
        size, start, bits = self.filters[n]
        bucket = _bucket(keys, self.buckets)
        live = np.flatnonzero(size[bucket] > 0)
        level = 1
        while len(live):
            for k in range(PROBES):
                h = mix(keys[live] + np.uint64(level * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
                b = bucket[live]
                at = ((h + np.uint64(k) * (mix(h) | np.uint64(1))) % size[b]).astype(np.int64) + start[b]
                live = live[(bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
            out[live] = level
            level += 1
        return out


class Model:
    """Totals of a training corpus and its parts, in segments."""

    def __init__(self, docs: DataFrame, order: int = ORDER, segment_bytes: int = SEGMENT_BYTES):
        self.order = order
        rows = docs.select("text")
        self.buckets = max(16, 2 * input_partitions(rows))
        counted = rows.mapInArrow(_counted(self.buckets, order), "bucket int, order int, keys binary, counts binary")
        merged = counted.groupBy("bucket", "order").applyInArrow(_merged, "bucket int, order int, size long, total long, data binary, more binary")
        self.parts = written(merged, "lm-parts")
        sizes = self.parts.withColumn("bytes", F.octet_length("data") + F.octet_length("more"))
        self.train_tokens, self.vocabulary = sizes.filter("`order` = 1").agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("size"), F.lit(0))).first()
        per_bucket = {r["bucket"]: r["bytes"] for r in sizes.groupBy("bucket").agg(F.sum("bytes").alias("bytes")).collect()}
        self.segments: list[list[int]] = [[]]
        held = 0
        for b in sorted(per_bucket):
            if held + per_bucket[b] > segment_bytes and self.segments[-1]:
                self.segments.append([])
                held = 0
            self.segments[-1].append(b)
            held += per_bucket[b]

    def segment(self, spark: SparkSession, k: int):
        """Broadcast of the k-th segment: at most SEGMENT_BYTES, or one bucket (whose size follows one input partition's)."""
        rows = self.parts.filter(F.col("bucket").isin(self.segments[k]))
        out = Segment(sorted(rows.select("bucket", "order", "size").collect()), self.buckets)
        for low in range(0, len(self.segments[k]), 4):
            out.fill(self.parts.filter(F.col("bucket").isin(self.segments[k][low : low + 4])).collect())
        out.sort()
        return spark.sparkContext.broadcast(out)

    def scored(self, docs: DataFrame, keep: list[str]) -> DataFrame:
        """keep and n_tokens, n_known, base_score, score of each row of docs (text)."""
        spark = docs.sparkSession
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
        rows = docs.select(*keep, "text")
        if len(self.segments) == 1:
            return rows.mapInArrow(self._last(self.segment(spark, 0), keep, None), f"{kinds}, n_tokens long, n_known long, base_score double, score double")
        rows = rows.withColumn("seen", F.lit(b""))
        for k in range(len(self.segments) - 1):
            rows = written(rows.mapInArrow(self._fill(self.segment(spark, k), keep), f"{kinds}, text string, seen binary"), "lm-pass")
        return rows.mapInArrow(self._last(self.segment(spark, len(self.segments) - 1), keep, "seen"), f"{kinds}, n_tokens long, n_known long, base_score double, score double")

    def _fill(self, shared, keep: list[str]):
        order = self.order

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for rows in slices(batch, "text"):
                    words, first = tokens(column(rows, "text"))
                    found = _with(_found(shared.value, words, first, order), column(rows, "seen"), first, order)
                    packed = _packed(found)
                    seen = pa.array([packed[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary())
                    yield pa.RecordBatch.from_arrays([*(column(rows, c) for c in keep), column(rows, "text"), seen], [*keep, "text", "seen"])

        return run

    def _last(self, shared, keep: list[str], seen: str | None):
        total, vocabulary, order = self.train_tokens, self.vocabulary, self.order

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for rows in slices(batch, "text"):
                    words, first = tokens(column(rows, "text"))
                    found = _found(shared.value, words, first, order)
                    if seen:
                        found = _with(found, column(rows, seen), first, order)
                    counts = found[0]
                    base = (counts + 0.1) / (total + 0.1 * (vocabulary + 1))
                    prob = base
                    for n in range(2, order + 1):
                        # the context of n - 1 words ends at the token before
                        if n == 2:
                            context = np.concatenate([[0], counts[:-1]]).astype(float)
                        else:
                            q = np.concatenate([[0], found[n - 2][:-1]])
                            context = np.where(q > 0, at_least(q + 1) - 1, 0)
                        c = np.minimum(at_least(found[n - 1]), context)
                        _, inside = ngrams(words, first, n)
                        mass = MU * np.maximum(context, 1) ** GAMMA
                        prob = np.where(inside, (c + mass * prob) / (context + mass), prob)
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(column(rows, c) for c in keep), pa.array(np.diff(first)), pa.array(np.add.reduceat((counts > 0).astype(np.int64), first[:-1])),
                            pa.array(np.add.reduceat(np.log10(base), first[:-1])), pa.array(np.add.reduceat(np.log10(prob), first[:-1])),
                        ],
                        [*keep, "n_tokens", "n_known", "base_score", "score"],
                    )

        return run


def _found(segment: Segment, words: np.ndarray, first: np.ndarray, order: int) -> list[np.ndarray]:
    """Unigram counts, then the levels of longer n-grams, at each token."""
    codes, distinct = pd.factorize(words)
    keys, _ = ngrams(distinct, np.arange(len(distinct) + 1), 1)
    out = [segment.unigrams(keys)[codes]]
    for n in range(2, order + 1):
        keys, inside = ngrams(words, first, n)
        got = np.zeros(len(words), np.int64)
        got[inside] = segment.level(n, keys[inside])
        out.append(got)
    return out


def _packed(found: list[np.ndarray]) -> np.ndarray:
    """A record a token: its count in 8 bytes, then a byte a level."""
    out = np.zeros(len(found[0]), np.dtype([("c", "<i8"), *((f"q{n}", "u1") for n in range(2, len(found) + 1))]))
    out["c"] = found[0]
    for n in range(2, len(found) + 1):
        out[f"q{n}"] = found[n - 1]
    return out


def _with(found: list[np.ndarray], seen: pa.Array, first: np.ndarray, order: int) -> list[np.ndarray]:
    """What earlier passes have found, with this pass's: each n-gram is in one segment only."""
    kind = np.dtype([("c", "<i8"), *((f"q{n}", "u1") for n in range(2, order + 1))])
    raw = b"".join(x.as_py() or b"" for x in seen)
    if not raw:
        return found
    before = np.frombuffer(raw, kind)
    return [found[0] + before["c"], *(found[n - 1] + before[f"q{n}"] for n in range(2, order + 1))]


def op1_log_bloom_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(parts=10).alias("held_out"))
    model = Model(docs.filter(~F.col("held_out")))
    out = model.scored(docs, ["doc_id", "held_out"]).withColumn("train_tokens", F.lit(model.train_tokens).cast("long"))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
