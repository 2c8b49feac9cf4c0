"""Operator 12: hard negatives by a full sort of each anchor's scores.

Components become whole numbers, so scores are exact and their order does not depend on how rows are dealt. Rows are scored
against the anchors where they lie: a task takes a batch of rows by a block of anchors, scores it with one matrix product, and
sorts every anchor's scores, by score and then by id. In a first pass each task keeps an anchor's best rows of its own label; the
tasks' lists are merged, and the best of all are the anchor's positives. In a second pass the rows of other labels are sorted the
same way, a binary search finds each positive's upper limit in them, and the rows read on from there, down to the lower limit, are
merged likewise. A task hands on a few rows an anchor, so neither a label that holds a third of all rows nor copies of a vector meet
in one task; what is never built is a list of all pairs.

Anchors come in segments of SEGMENT_BYTES, sent to all tasks: that bounds what is broadcast, and the memory of a task, whatever the
number of anchors. The work is anchors times rows in any case; segments only read the rows more than once.

What odd rows give. Rows without a vec_id or label, or whose vector is null or holds a null or a component that is not finite even
when multiplied, take no part. Rows that share a vec_id count as one, the one of the least label and components. Shorter vectors
count as having zeros at the end, an empty one as zeros alone. Scores beyond a long are held to its ends. An anchor without positives,
and a positive without negatives, have no rows; nor has an empty table. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumenforge.llm.shared import removed, table, written
from lumenforge.operators.common import first_by

SCALE = 256
#: Bytes of anchors' components in one broadcast, and anchors that are scored at once.
SEGMENT_BYTES = 32 << 20
ANCHOR_BLOCK = 128
#: Rows scored at once: with a block of anchors, some 8 MB of scores.
ROW_BLOCK = 8_192
#: The score of a row that does not count for an anchor; others are held above it.
NONE = -(2**63 - 1)

OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def prepared(rows: DataFrame, label=None) -> DataFrame:
    """vec_id long, label long, vec array<double>: the rows of (vec_id, embedding, label) that take part, once an id. label: a
    column expression in place of `label`."""
    vec = F.col("vec")
    named = rows.select(F.col("vec_id").cast("long").alias("vec_id"), (F.col("label").cast("long") if label is None else label).alias("label"), F.col("embedding").cast("array<double>").alias("vec"))
    fine = named.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & vec.isNotNull() & F.forall(vec, lambda x: x.isNotNull() & (F.abs(x * SCALE) < float("inf"))))
    return first_by(fine, ["vec_id"], "label", "vec")


def components(array: pa.Array, width: int) -> np.ndarray:
    """Whole components of each vector, `width` of them: zeros after its own, none beyond."""
    lengths = np.diff(array.offsets.to_numpy())
    flat = np.floor(SCALE * array.flatten().to_numpy(zero_copy_only=False))
    if (lengths == width).all():
        return flat.reshape(len(array), width)
    out = np.zeros((len(array), width))
    row = np.repeat(np.arange(len(array)), lengths)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row[at < width], at[at < width]] = flat[at < width]
    return out


def integer_scores(anchors: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole components, exact: in doubles as long as no sum can leave their whole numbers, else in Python's."""
    if not anchors.size or not x.size:
        return np.zeros((len(anchors), len(x)), np.int64)
    if np.abs(anchors).max() * np.abs(x).max() * anchors.shape[1] < 2.0**53:
        return (anchors @ x.T).astype(np.int64)
    whole = lambda m: np.array([[int(v) for v in r] for r in m], object)
    return np.clip(whole(anchors) @ whole(x).T, NONE + 1, -NONE).astype(np.int64)


def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first k along the last axis, higher scores first, ties by smaller id."""
    order = np.argsort(ids, axis=-1, kind="stable")
    scores, ids = np.take_along_axis(scores, order, -1), np.take_along_axis(ids, order, -1)
    order = np.argsort(-scores, axis=-1, kind="stable")[..., :k]
    return np.take_along_axis(scores, order, -1), np.take_along_axis(ids, order, -1)


class Anchors:
    """A segment of anchors: ids, labels, components; later their positives, NONE where there are fewer."""

    def __init__(self, rows: pa.Table):
        rows = rows.combine_chunks()
        vec = rows["vec"].combine_chunks() if isinstance(rows["vec"], pa.ChunkedArray) else rows["vec"]
        width = int(np.diff(vec.offsets.to_numpy()).max(initial=0))
        self.ids, self.labels, self.x = rows["vec_id"].to_numpy(), rows["label"].to_numpy(), components(vec, width)

    def with_positives(self, found: pa.Table, k: int, share: Fraction) -> Anchors:
        """found: anchor_id, rank (from 1), vec_id, score."""
        at = {int(a): n for n, a in enumerate(self.ids)}
        row = np.array([at[int(a)] for a in found["anchor_id"].to_numpy()], np.int64)
        rank = found["rank"].to_numpy() - 1
        self.positives, self.upper = np.zeros((len(self.ids), k), np.int64), np.full((len(self.ids), k), NONE, np.int64)
        self.positives[row, rank], self.upper[row, rank] = found["vec_id"].to_numpy(), found["score"].to_numpy()
        # whole numbers at or above share * positive: beyond a long where no row can be
        least = [min(-((-share.numerator * int(p)) // share.denominator), -NONE) for p in self.upper.ravel()]
        self.lower = np.maximum(np.array(least, object), NONE).astype(np.int64).reshape(self.upper.shape)
        return self


def _blocks(batches: Iterator[pa.RecordBatch], anchors: Anchors) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """(anchors, ids of rows in ascending order, which of them have the anchor's label, scores) of each block of anchors by rows; an
    anchor's own row is NONE."""
    for batch in batches:
        for low in range(0, batch.num_rows, ROW_BLOCK):
            rows = batch.slice(low, ROW_BLOCK)
            rows = rows.take(pa.array(np.argsort(rows.column(0).to_numpy(), kind="stable")))
            ids, labels, x = rows.column(0).to_numpy(), rows.column(1).to_numpy(), components(rows.column(2), anchors.x.shape[1])
            for first in range(0, len(anchors.ids), ANCHOR_BLOCK):
                block = slice(first, first + ANCHOR_BLOCK)
                scores = integer_scores(anchors.x[block], x)
                scores[anchors.ids[block, None] == ids] = NONE
                yield block, ids, anchors.labels[block, None] == labels, scores


def _sorted(scores: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each anchor's scores in full order, and their ids; what does not count comes last. ids ascend, so a stable sort settles ties."""
    scores = np.where(counts, scores, NONE)
    order = np.argsort(-scores, axis=1, kind="stable")
    return np.take_along_axis(scores, order, 1), ids[order]


def _positives(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: Anchors = shared.value
        best, who = np.full((len(anchors.ids), k), NONE, np.int64), np.zeros((len(anchors.ids), k), np.int64)
        for block, ids, same, scores in _blocks(batches, anchors):
            new, near = _sorted(scores, same, ids)
            best[block], who[block] = _first(np.hstack([best[block], new[:, :k]]), np.hstack([who[block], near[:, :k]]), k)
        row, place = np.nonzero(best > NONE)
        yield pa.RecordBatch.from_arrays([pa.array(anchors.ids[row]), pa.array(who[row, place]), pa.array(best[row, place])], ["anchor_id", "vec_id", "score"])

    return run


def _negatives(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: Anchors = shared.value
        shape = (*anchors.upper.shape, k)
        best, who = np.full(shape, NONE, np.int64), np.zeros(shape, np.int64)
        for block, ids, same, scores in _blocks(batches, anchors):
            line, near = _sorted(scores, ~same, ids)
            upper, lower = anchors.upper[block], anchors.lower[block]
            start = np.array([np.searchsorted(-s, -u, "left") for s, u in zip(line, upper, strict=True)])
            read = start[:, :, None] + np.arange(k)
            at = np.minimum(read, line.shape[1] - 1).reshape(len(line), -1)
            new, whom = np.take_along_axis(line, at, 1).reshape(read.shape), np.take_along_axis(near, at, 1).reshape(read.shape)
            fits = (read < line.shape[1]) & (new > NONE) & (new >= lower[:, :, None]) & (upper[:, :, None] > NONE)
            new = np.where(fits, new, NONE)
            best[block], who[block] = _first(np.concatenate([best[block], new], 2), np.concatenate([who[block], whom], 2), k)
        a, p, n = np.nonzero(best > NONE)
        columns = [anchors.ids[a], anchors.positives[a, p], who[a, p, n], anchors.upper[a, p], best[a, p, n]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"])

    return run


def mine(rows: DataFrame, anchors, positives: int = 5, negatives: int = 5, share: Fraction = Fraction(4, 5)) -> DataFrame:
    """rows: as prepared() gives them; anchors: a condition on them. For each anchor and each of its first `positives` rows of the same
    label, the first `negatives` rows of other labels that score at most as high as the positive and at least `share` of it.
    """
    spark = rows.sparkSession
    base = written(rows, "vectors")
    asked = base.filter(anchors)
    stats = asked.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("vec")), F.lit(0)).alias("width")).first()
    segments = max(1, -(-stats["n"] * (stats["width"] + 2 * positives + 2) * 8 // SEGMENT_BYTES))
    out = []
    for segment in range(segments if stats["n"] else 0):
        # a segment's anchors, at most SEGMENT_BYTES by the count above but for the spread of the hash
        held = Anchors(asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(segments)) == segment).toArrow())
        w = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
        near = base.mapInArrow(_positives(spark.sparkContext.broadcast(held), positives), "anchor_id long, vec_id long, score long")
        found = near.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= positives).toArrow()
        limits = spark.sparkContext.broadcast(held.with_positives(found, positives, share))
        w = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
        hard = base.mapInArrow(_negatives(limits, negatives), "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long")
        hard = hard.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= negatives)
        out.append(written(hard.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), "negatives"))
    removed(base)
    return reduce(DataFrame.unionByName, out) if out else spark.createDataFrame([], OUT)


def relabelled():
    """The label of op12_hard_negatives: rows whose vec_id is divisible by 7 have the next one."""
    label = F.col("label").cast("long")
    return F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(prepared(table(spark, sf_dir, "embeddings"), relabelled()), F.col("vec_id") % 100 == 0)
