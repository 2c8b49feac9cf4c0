"""Operator 3: token ids in patched frame-of-reference blocks.

A block holds BLOCK ids: its minimum is subtracted, the differences are packed at a width that covers a chosen
percentile of them, and the high bits of the few wider ones go to an exception list. A segment is a run of whole documents:
its blocks one after another with an index of where each starts, so a reader may seek to any block of any document.

File format: a Parquet folder, one file a range of doc_id, one row a segment:
part int (files in ascending doc_id order), segment int, first_token long (within the part), doc_ids list<long>,
doc_starts list<long> (within the segment), n_tokens long, block_starts list<int> (bytes in payload), payload binary.
A block is: minimum uint32, width uint8, exceptions uint8, packed ids (16 * width bytes), exceptions' places (uint8 each),
their high bits (uint32 each); little-endian, the packed bits big-endian. The last block of a segment is padded with its
first id.

Null texts are empty documents (only the end id); empty tables give empty files; rows with a null doc_id come first;
equal doc_ids stay apart, in text order; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenforge.llm.shared import input_partitions, offsets_by_part, scratch_path, table
from lumenforge.llm.text import column, list_array, slices
from lumenforge.llm.tokens import ids_crc32, tokenizer

BLOCK = 128
PERCENTILE = 90.0
SEGMENT_TOKENS = 1 << 16

SEGMENTS = "part int, segment int, first_token long, doc_ids array<bigint>, doc_starts array<bigint>, n_tokens long, block_starts array<int>, payload binary"


def _bits(x: np.ndarray) -> np.ndarray:
    """How many bits each value needs."""
    return np.where(x > 0, np.floor(np.log2(np.maximum(x, 1).astype(np.float64))).astype(np.int64) + 1, 0)


def encode_blocks(ids: np.ndarray, percentile: float = PERCENTILE) -> tuple[bytes, np.ndarray]:
    """(payload, byte offset of each block)."""
    if not len(ids):
        return b"", np.zeros(0, np.int32)
    n = -(-len(ids) // BLOCK)
    full = np.empty(n * BLOCK, np.uint32)
    full[: len(ids)] = ids
    full[len(ids) :] = ids[(n - 1) * BLOCK]
    blocks = full.reshape(n, BLOCK)
    low = blocks.min(axis=1)
    rest = blocks - low[:, None]
    rank = min(BLOCK - 1, int(np.ceil(percentile / 100 * BLOCK)) - 1)
    width = _bits(np.partition(rest, rank, axis=1)[:, rank])
    high = rest >> np.minimum(width, 31).astype(np.uint32)[:, None]
    high[width == 32] = 0
    outliers = (high > 0).sum(axis=1)
    sizes = 6 + 16 * width + 5 * outliers
    starts = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(starts[-1], np.uint8)
    heads = np.zeros((n, 6), np.uint8)
    heads[:, :4] = low.astype("<u4").view(np.uint8).reshape(n, 4)
    heads[:, 4], heads[:, 5] = width, outliers
    out[starts[:-1, None] + np.arange(6)] = heads
    wide = np.dtype(">u2") if width.max() <= 16 else np.dtype(">u4")
    size = wide.itemsize * 8
    for w in np.unique(width[width > 0]):
        rows = np.flatnonzero(width == w)
        mask = np.uint32((1 << int(w)) - 1)
        bits = np.unpackbits((rest[rows] & mask).astype(wide).view(np.uint8).reshape(len(rows) * BLOCK, -1), axis=1)
        packed = np.packbits(bits[:, size - w :].reshape(len(rows), -1), axis=1)
        out[starts[rows, None] + 6 + np.arange(16 * w)] = packed
    if outliers.any():
        row, place = np.nonzero(high)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(outliers) - outliers, outliers)
        at = starts[row] + 6 + 16 * width[row]
        out[at + nth] = place
        out[(at + outliers[row] + 4 * nth)[:, None] + np.arange(4)] = high[row, place].astype("<u4").view(np.uint8).reshape(-1, 4)
    return out.tobytes(), starts[:-1].astype(np.int32)


def decode_blocks(payload: bytes, starts: np.ndarray, n_tokens: int) -> np.ndarray:
    """The ids of the blocks that start at the given bytes, the first n_tokens of them."""
    if not len(starts):
        return np.zeros(0, np.uint32)
    data, starts = np.frombuffer(payload, np.uint8), np.asarray(starts, np.int64)
    heads = data[starts[:, None] + np.arange(6)]
    low = np.ascontiguousarray(heads[:, :4]).view("<u4").ravel()
    width, outliers = heads[:, 4].astype(np.int64), heads[:, 5].astype(np.int64)
    rest = np.zeros((len(starts), BLOCK), np.uint32)
    wide = np.dtype(">u2") if width.max() <= 16 else np.dtype(">u4")
    size = wide.itemsize * 8
    for w in np.unique(width[width > 0]):
        rows = np.flatnonzero(width == w)
        bits = np.unpackbits(data[starts[rows, None] + 6 + np.arange(16 * w)], axis=1).reshape(-1, w)
        whole = np.zeros((len(bits), size), np.uint8)
        whole[:, size - w :] = bits
        rest[rows] = np.packbits(whole, axis=1).view(wide).reshape(len(rows), BLOCK)
    if outliers.any():
        row = np.repeat(np.arange(len(starts)), outliers)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(outliers) - outliers, outliers)
        at = starts[row] + 6 + 16 * width[row]
        high = np.ascontiguousarray(data[(at + outliers[row] + 4 * nth)[:, None] + np.arange(4)]).view("<u4").ravel()
        rest[row, data[at + nth]] |= high << width[row].astype(np.uint32)
    return (rest + low[:, None]).ravel()[:n_tokens]


def _segments(path: str, end_id: int, part_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, part = tokenizer(path), part_of()
        segment = total = 0
        held_ids: list[np.ndarray] = []
        held_docs: list[pa.Array] = []
        held_sizes: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            nonlocal segment, total, held_ids, held_docs, held_sizes
            ids, sizes = np.concatenate(held_ids), np.concatenate(held_sizes)
            payload, index = encode_blocks(ids)
            docs = pa.concat_arrays(held_docs)
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()), pa.array([segment], pa.int32()), pa.array([total], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs),
                    list_array(np.cumsum(sizes) - sizes, np.array([0, len(docs)]), pa.int64()),
                    pa.array([len(ids)], pa.int64()), list_array(index, np.array([0, len(index)]), pa.int32()), pa.array([payload], pa.binary()),
                ],
                ["part", "segment", "first_token", "doc_ids", "doc_starts", "n_tokens", "block_starts", "payload"],
            )
            segment, total = segment + 1, total + len(ids)
            held_ids, held_docs, held_sizes = [], [], []
            return out

        for batch in batches:
            for rows in slices(batch, "text", 1 << 20):
                ids, offsets = made.encode(column(rows, "text"), end_id)
                docs = column(rows, "doc_id")
                low = 0
                while low < len(docs):
                    room = SEGMENT_TOKENS - sum(map(len, held_ids))
                    high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + room, "right")) - 1)
                    held_ids.append(ids[offsets[low] : offsets[high]])
                    held_docs.append(docs.slice(low, high - low))
                    held_sizes.append(np.diff(offsets[low : high + 1]))
                    low = high
                    if sum(map(len, held_ids)) >= SEGMENT_TOKENS or low < len(docs):
                        yield flush()
        if held_ids:
            yield flush()

    return run


def _task_partition() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, partitions: int | None = None) -> None:
    """Encodes docs (doc_id, text), each followed by end_id, and writes the file format to the folder `path`.

    The range partitions come in ascending doc_id; text order parts equal ids. One shuffle, of the texts.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = partitions or max(1, input_partitions(rows))
    rows = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    rows.mapInArrow(_segments(tokenizer_path, end_id, _task_partition), SEGMENTS).write.parquet(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = {name: batch.column(i)[k] for i, name in enumerate(batch.schema.names)}
            ids = decode_blocks(row["payload"].as_py(), row["block_starts"].values.to_numpy(), row["n_tokens"].as_py())
            starts = row["doc_starts"].values.to_numpy()
            sizes = np.diff(np.append(starts, len(ids)))
            n = len(starts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, row["part"].as_py(), np.int32)), row["doc_ids"].values.cast(pa.int64()), pa.array(starts + row["first_token"].as_py()), pa.array(sizes),
                    pa.array([ids_crc32(ids[a : a + s]) for a, s in zip(starts.tolist(), sizes.tolist(), strict=True)], pa.int64()),
                ],
                ["part", "doc_id", "part_start", "n_tokens", "ids_crc32"],
            )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Decodes a folder of the format: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    files = spark.read.schema(SEGMENTS).parquet(path)
    # one row a file: the sizes of the parts, added up in order
    parts = offsets_by_part(files.groupBy("part").agg(F.sum("n_tokens").alias("size")), "part", "size", "before").select("part", "before")
    docs = files.mapInArrow(_documents, "part int, doc_id long, part_start long, n_tokens long, ids_crc32 long")
    return docs.join(F.broadcast(parts), "part").select("doc_id", (F.col("before") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32")


def op3_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), 2)
    return read_tokens(spark, path)
