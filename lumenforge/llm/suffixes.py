"""Operator 6: exact substring dedup with shard suffix arrays built by induced sorting.

Every byte covered by a string of LENGTH bytes that also starts anywhere else, in any document or the same one, is removed.

Suffixes that can match are brought together first. Each window of LENGTH bytes has an anchor: the least, leftmost hash of its runs
of GRAM bytes. Equal windows have equal anchors at equal places, so only windows of one anchor can be equal, and
consecutive windows of one anchor make a context. Contexts that are equal bytes repeat as a whole; where an anchor has
contexts that differ, one of each goes to the anchor's shard. A shard's contexts are one string whose suffix array is built by induced
sorting; permuted common prefixes of at least LENGTH bytes then mark the windows that start elsewhere too.

Equal contexts are put together within each batch before they are shuffled, so text that a third of all rows share meets
nowhere. Contexts count as equal by two independent 64-bit hashes of their bytes, which are not compared. The contexts of an anchor with
more than `hot` different ones do not go to one shard: their windows get new anchors from longer runs of bytes, halfway to LENGTH each time,
and so come apart into contexts of many anchors, which go to shards of their own. Rows are told apart by a 64-bit hash of id and text. Texts are UTF-8 bytes; null is empty. Rows of equal doc_id and text are two occurrences. Empty
tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenforge.llm.sais import permuted_lcp, suffix_array
from lumenforge.llm.shared import input_partitions, table, written
from lumenforge.llm.text import column, gathered, mix, prefix_sums, slices, text_bytes
from lumenforge.operators.merge import filter_bits, id_filter, may_hold

LENGTH = 200
GRAM = 32
#: Bytes of contexts in a shard, about.
SHARD_BYTES = 2 << 20
#: Different contexts of an anchor that go to one shard.
HOT = 20_000
#: Contexts that a worker puts in order at once.
HELD = 1 << 18


def contexts(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(row, start in row, size, anchor hash, two content hashes) of each run of windows with one anchor."""
    n = len(data) - length + 1
    if n <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    total, inverse = prefix_sums(data)
    h = mix((total[gram:] - total[: len(data) - gram + 1]) * inverse[: len(data) - gram + 1])
    # hash in the upper bits, place in the lower: the least is also the leftmost
    bits = np.uint64(max(1, int(len(h) - 1).bit_length()))
    least = (h >> bits << bits) | np.arange(len(h), dtype=np.uint64)
    window, span = length - gram + 1, 1
    while span < window:
        step = min(span, window - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    anchor = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    # windows that lie within one row
    low, high = offsets[:-1], np.maximum(offsets[:-1], offsets[1:] - length + 1)
    inside = np.zeros(n + 1, np.int64)
    np.add.at(inside, np.minimum(low, n), 1)
    np.add.at(inside, np.minimum(high, n), -1)
    ok = np.cumsum(inside[:n]) > 0
    lead = ok.copy()
    lead[1:] &= (anchor[1:] != anchor[:-1]) | ~ok[:-1]
    lead[offsets[:-1][high > low]] = True
    start = np.flatnonzero(lead)
    stop = ok.copy()
    stop[:-1] &= lead[1:] | ~ok[1:]
    end = np.flatnonzero(stop) + length
    content = mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))
    total, inverse = prefix_sums(data, 1)
    second = mix((total[end] - total[start]) * inverse[start])
    row = np.searchsorted(offsets, start, "right") - 1
    return row, start - offsets[row], end - start, h[anchor[start]], content, second


_PACKED = "bucket int, anchors binary, contents binary, seconds binary, uids binary, starts binary, sizes binary, many binary"
_NAMES = ["bucket", "anchors", "contents", "seconds", "uids", "starts", "sizes", "many"]
_KINDS = dict(zip(_NAMES[1:], (np.uint64, np.uint64, np.uint64, np.int64, np.int64, np.int64, np.uint8), strict=True))


def _anchored(buckets: int, length: int, gram: int):
    """Contexts met more than once in the batch (bucket -1), and one of each packed by the anchor's bucket; starts count from `base`."""

    def packed(bucket: int, *columns: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), *(pa.array([np.ascontiguousarray(c, k).tobytes()], pa.binary()) for c, k in zip(columns, _KINDS.values(), strict=True))], _NAMES)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        for batch in batches:
            for rows in slices(batch, "text"):
                row, start, size, anchor, content, second = contexts(*text_bytes(column(rows, "text")), length, gram)
                yield anchor, content, second, column(rows, "uid").to_numpy()[row], start + column(rows, "base").to_numpy()[row], size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for anchor, content, second, uid, start, size in gathered(found(batches), HELD):
            order = np.lexsort((second, content, anchor))
            anchor, content, second, uid, start, size = (x[order] for x in (anchor, content, second, uid, start, size))
            lead = np.ones(len(anchor), bool)
            lead[1:] = (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1]) | (second[1:] != second[:-1])
            count = np.diff(np.append(np.flatnonzero(lead), len(anchor)))
            many = (count > 1)[np.cumsum(lead) - 1] if len(anchor) else lead
            if many.any():
                yield packed(-1, anchor[many], content[many], second[many], uid[many], start[many], size[many], many[many])
            where = ((anchor >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)
            at = np.flatnonzero(lead)
            at = at[np.argsort(where[at], kind="stable")]
            cuts = np.searchsorted(where[at], np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(cuts)):
                some = at[cuts[b] : cuts[b + 1]]
                yield packed(int(b), anchor[some], content[some], second[some], uid[some], start[some], size[some], many[some])

    return run


def _sorted_out(hot: int):
    """kind 0: spans that repeat as a whole; 1: one of each of an anchor's different contexts (2: of an anchor with more than `hot`)."""

    def run(rows: pa.Table) -> pa.Table:
        anchor, content, second, uid, start, size, many = (np.concatenate([np.frombuffer(x.as_buffer(), k) for x in rows[n]]) for n, k in _KINDS.items())
        kind = np.zeros(len(anchor), np.int8)
        if rows["bucket"][0].as_py() >= 0:
            order = np.lexsort((second, content, anchor))
            anchor, content, second, uid, start, size, many = (x[order] for x in (anchor, content, second, uid, start, size, many))
            new_anchor = np.ones(len(anchor), bool)
            new_anchor[1:] = anchor[1:] != anchor[:-1]
            lead = new_anchor.copy()
            lead[1:] |= (content[1:] != content[:-1]) | (second[1:] != second[:-1])
            group, of = np.cumsum(lead) - 1, np.cumsum(new_anchor) - 1
            repeats = (np.bincount(group) > 1)[group]
            classes = np.bincount(of[lead])[of]
            whole = np.flatnonzero(repeats & (many == 0))  # those of `many` are told from their batch
            shard = np.flatnonzero(lead & (classes > 1))
            kind = np.concatenate([np.zeros(len(whole), np.int8), np.where(classes[shard] > hot, 2, 1).astype(np.int8)])
            at = np.concatenate([whole, shard])
            anchor, uid, start, size = anchor[at], uid[at], start[at], size[at]
        return pa.table({"kind": pa.array(kind), "anchor": anchor.astype(np.int64), "uid": uid, "start": start, "size": size})

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The asked contexts' bytes of each text."""
    for batch in batches:
        for rows in slices(batch, "text"):
            data, offsets = text_bytes(column(rows, "text"))
            asked = column(rows, "asked")
            owner = np.repeat(np.arange(rows.num_rows), np.diff(asked.offsets.to_numpy()))
            flat = asked.flatten()
            start, size = flat.field("start").to_numpy(), flat.field("size").to_numpy()
            low = offsets[owner] + start
            body = data[np.repeat(low - (np.cumsum(size) - size), size) + np.arange(size.sum())]
            ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            made = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(body.tobytes())])
            yield pa.RecordBatch.from_arrays([column(rows, "uid").take(pa.array(owner)), flat.field("kind"), flat.field("anchor"), flat.field("start"), made], ["uid", "kind", "anchor", "start", "bytes"])


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _matched(length: int):
    """Spans of a shard's contexts whose windows start elsewhere in it too."""

    def run(rows: pa.Table) -> pa.Table:
        body = rows["bytes"].combine_chunks()
        data, offsets = text_bytes(body)
        sizes = np.diff(offsets)
        # 0xff parts the contexts: no UTF-8 text holds it
        s = np.full(len(data) + len(sizes), 255, np.uint8)
        s[np.arange(len(data)) + np.repeat(np.arange(len(sizes)), sizes)] = data
        starts = offsets[:-1] + np.arange(len(sizes))
        order = suffix_array(s)
        prefix, before = permuted_lcp(s, order, length)
        left = np.repeat(starts + sizes, sizes + 1) - np.arange(len(s))  # bytes to the context's end
        good = np.flatnonzero((prefix >= length) & (left >= length))
        # the neighbour's match lies within its own context: equal bytes hold no separator
        repeated = np.zeros(len(s), bool)
        repeated[good] = repeated[before[good]] = True
        covered = np.zeros(len(s) + 1, np.int64)
        at = np.flatnonzero(repeated)
        np.add.at(covered, at, 1)
        np.add.at(covered, np.minimum(at + length, len(s)), -1)
        low, high = _runs(np.cumsum(covered[:-1]) > 0)
        owner = np.searchsorted(starts, low, "right") - 1
        return pa.table({"uid": rows["uid"].combine_chunks().take(pa.array(owner)), "start": low - starts[owner] + rows["start"].combine_chunks().to_numpy()[owner], "size": high - low})

    return run


def _cut_out(docs: DataFrame, open_: DataFrame) -> DataFrame:
    """uid, kind, anchor, start, bytes of the contexts of docs in open_. docs go to the other side with all their columns, never by broadcast:
    whatever the table's size, it is the same exchange as any other of docs by uid in a plan, and Spark writes it once."""
    asked = open_.groupBy("uid").agg(F.collect_list(F.struct("kind", "anchor", "start", "size")).alias("asked"))  # in proportion to a text's bytes
    return docs.join(asked.hint("merge"), "uid").mapInArrow(_cut, "uid long, kind byte, anchor long, start long, bytes binary")


def _holding(docs: DataFrame, open_: DataFrame) -> DataFrame:
    """docs less those that a filter of the uids in open_, of 16 bits for each up to 8 MB, tells to hold none of its contexts: they are not shuffled."""
    uids = open_.select(F.col("uid").alias("id")).distinct()
    bits = filter_bits(uids.count())
    return docs.filter(may_hold(written(id_filter(uids, bits), "hot-ids").scalar(), F.col("uid"), bits))


def repeated_spans(docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """uid, start, size of byte spans of docs (uid, text, maybe more) to remove; they may overlap."""
    buckets = max(16, 4 * input_partitions(docs))
    spread = F.when(F.col("bucket") < 0, -1 - F.pmod(F.xxhash64("anchors"), F.lit(buckets))).otherwise(F.col("bucket")).cast("int")
    rows, gram, levels = docs.select("uid", F.lit(0).cast("long").alias("base"), "text"), min(GRAM, length), []
    while True:
        packed = rows.mapInArrow(_anchored(buckets, length, gram), _PACKED).withColumn("bucket", spread)
        # windows of one anchor of `length` bytes are equal
        most = hot if gram < length else 1 << 62
        out = written(packed.groupBy("bucket").applyInArrow(_sorted_out(most), "kind byte, anchor long, uid long, start long, size long"), "contexts")
        levels.append(out)
        again = out.filter("kind = 2")
        if again.isEmpty():
            break
        cut = _cut_out(_holding(docs, again), again)
        rows = written(cut.select("uid", F.col("start").alias("base"), F.col("bytes").alias("text")), "hot")
        gram += -(-(length - gram) // 2)
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    size = out.filter("kind = 1").agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    shards = max(1, -(-size // SHARD_BYTES))
    cut = _cut_out(docs, out.filter("kind = 1")).withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    matched = cut.groupBy("shard").applyInArrow(_matched(length), "uid long, start long, size long")
    return out.filter("kind = 0").select("uid", "start", "size").unionByName(matched)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    for batch in batches:
        for rows in slices(batch, "text"):
            data, offsets = text_bytes(column(rows, "text"))
            spans = column(rows, "spans")
            lists = spans.fill_null([]) if spans.null_count else spans
            owner = np.repeat(np.arange(rows.num_rows), np.diff(lists.offsets.to_numpy()))
            flat = lists.flatten()
            low = offsets[owner] + flat.field("start").to_numpy()
            edge = np.zeros(len(data) + 1, np.int64)
            np.add.at(edge, low, 1)
            np.add.at(edge, low + flat.field("size").to_numpy(), -1)
            gone = np.cumsum(edge[:-1]) > 0
            first = gone.copy()
            first[1:] &= ~gone[:-1]
            starts = offsets[:-1][offsets[1:] > offsets[:-1]]
            first[starts] = gone[starts]
            removed, runs = np.concatenate([[0], np.cumsum(gone)]), np.concatenate([[0], np.cumsum(first)])
            kept = [data[a:b][~gone[a:b]].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    column(rows, "doc_id"), pa.array(np.diff(offsets)), pa.array(removed[offsets[1:]] - removed[offsets[:-1]]), pa.array(runs[offsets[1:]] - runs[offsets[:-1]]),
                    pa.array([hashlib.sha256(k).hexdigest() for k in kept]), pa.array(kept, pa.binary()),
                ],
                names,
            )


def without_repeats(docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes of each row of docs (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("uid", F.xxhash64("doc_id", "text"))
    spans = repeated_spans(rows, length, hot).distinct().groupBy("uid").agg(F.collect_list(F.struct("start", "size")).alias("spans"))
    joined = rows.join(spans.hint("merge"), "uid", "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(_digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents")).drop("kept")
