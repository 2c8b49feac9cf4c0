"""Operator 8: language identification by bit-sliced Bloom filters of byte n-grams.

Each slot of the filter holds a bitmask of languages, in as many words of 64 as they take, so one probe of a few slots returns
all languages that contain an n-gram. A document's hits are counted for each language, corrected for that language's rate of false positives, and the
language with most decides. A language's filter holds the n-grams whose share of its training n-grams is at least
CHARACTERISTIC of the largest share any language has.

Null, empty and letterless texts are `und` with score 0; ties go to the language with more training n-grams, then by name.
A document without a doc_id is held out. With no labelled training text every document is `und`. Repeated rows are
predicted each on its own; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumenforge.llm.shared import table, written
from lumenforge.llm.text import column, mix, slices, tallied, text_bytes

#: Bytes in an n-gram; words are parted by one space.
N = 4
#: The classifier is fitted on a sample of about so many labelled rows at most, dealt evenly to the languages; the filter's
#: size follows from it.
TRAIN_ROWS = 20_000
CHARACTERISTIC = 0.6
MIN_COUNT = 3
PROBES = 3
SLOTS_PER_GRAM = 16

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n-grams of all rows as uint32, offsets by row, rows that have a letter)."""
    data, offsets = text_bytes(pc.utf8_lower(texts.fill_null("") if texts.null_count else texts))
    letter = _LETTER[data]
    plain = np.concatenate([[0], np.cumsum((data >= 97) & (data < 123))])
    lettered = plain[offsets[1:]] > plain[offsets[:-1]]
    for r in np.flatnonzero(~lettered & (offsets[1:] > offsets[:-1])):
        lettered[r] = any(c.isalpha() for c in data[offsets[r] : offsets[r + 1]].tobytes().decode())
    # one space before each word and after the last: a non-letter stays only right after a letter
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    start = offsets[:-1][offsets[1:] > offsets[:-1]]
    keep[start] = letter[start]
    kept = np.concatenate([[0], np.cumsum(keep)])
    body = np.where(letter, data, np.uint8(32))[keep]
    rows = np.repeat(np.arange(len(texts)), np.diff(kept[offsets]))
    size = np.diff(kept[offsets]) + 2
    at = np.concatenate([[0], np.cumsum(size)])
    padded = np.full(at[-1], 32, np.uint8)
    padded[np.arange(len(body)) + 2 * rows + 1] = body
    n = np.maximum(size - N + 1, 0)
    wide = padded.astype(np.uint32)
    every = wide[: len(wide) - N + 1].copy() if len(wide) >= N else np.zeros(0, np.uint32)
    for j in range(1, N):
        every |= wide[j : len(wide) - N + 1 + j] << np.uint32(8 * j)
    inside = np.ones(len(every), bool)
    ends = at[1:-1]
    for j in range(1, N):
        inside[(ends - j)[(ends - j >= 0) & (ends - j < len(every))]] = False
    return every[inside], np.concatenate([[0], np.cumsum(n)]), lettered


def _slots(values: np.ndarray, n_slots: int) -> list[np.ndarray]:
    h = mix(values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    step = (h >> np.uint64(32)) | np.uint64(1)
    return [((h + np.uint64(k) * step) & np.uint64(n_slots - 1)).astype(np.int64) for k in range(PROBES)]


class MaskFilter:
    """Slots of language bits; languages in descending order of training n-grams."""

    def __init__(self, languages: list[str], values: np.ndarray, masks: np.ndarray):
        """masks: the languages of each n-gram, as one word or, by row, as many words as the languages take."""
        self.languages = languages
        words = max(1, -(-len(languages) // 64))
        masks = masks.reshape(len(values), words)
        kind = np.uint8 if len(languages) <= 8 else np.uint32 if len(languages) <= 32 else np.uint64
        self.bits = np.zeros((1 << max(10, int(SLOTS_PER_GRAM * max(1, len(values)) - 1).bit_length()), words), kind)
        for at in _slots(values, len(self.bits)):
            np.bitwise_or.at(self.bits, at, masks.astype(kind))
        filled = np.array([((self.bits[:, k // 64] >> kind(k % 64)) & kind(1)).mean() for k in range(len(languages))])
        self.false_rate = filled**PROBES

    def masks(self, values: np.ndarray) -> np.ndarray:
        """The languages of each n-gram: a row of words."""
        first, *rest = _slots(values, len(self.bits))
        out = self.bits[first]
        for at in rest:
            out &= self.bits[at]
        return out

    def shares(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(corrected hits by row and language, as a share of the row's n-grams; rows that have a letter)."""
        values, offsets, lettered = grams(texts)
        masks, n = self.masks(values), np.diff(offsets)
        out = np.zeros((len(texts), len(self.languages)))
        one = masks.dtype.type(1)
        for k, wrong in enumerate(self.false_rate):
            total = np.concatenate([[0], np.cumsum((masks[:, k // 64] >> masks.dtype.type(k % 64)) & one, dtype=np.int64)])
            hits = total[offsets[1:]] - total[offsets[:-1]]
            out[:, k] = np.clip((hits - n * wrong) / max(1e-9, 1 - wrong), 0, None) / np.maximum(n, 1)
        return out, lettered


def _tally(languages: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text"):
                values, offsets, _ = grams(column(rows, "text"))
                code = np.array([languages[x] for x in column(rows, "lang").to_pylist()], np.uint64)
                keys, counts = tallied((np.repeat(code, np.diff(offsets)) << np.uint64(32)) | values)
                yield pa.RecordBatch.from_arrays([pa.array((keys & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array((keys >> np.uint64(32)).astype(np.int32)), pa.array(counts)], ["gram", "code", "count"])

    return run


def quotas(sizes: dict[str, int], rows: int) -> dict[str, int]:
    """Rows to take of each language, `rows` in all: the smallest are taken whole, and the others share what is left evenly."""
    out, left = {}, rows
    for done, x in enumerate(sorted(sizes, key=lambda x: (sizes[x], x))):
        out[x] = min(sizes[x], left // (len(sizes) - done))
        left -= out[x]
    return out


def sampled(labelled: DataFrame, sizes: dict[str, int], rows: int) -> DataFrame:
    """About quotas() rows of each language of labelled (text, lang, and doc_id if there is one), by a hash of id and text."""
    if sum(sizes.values()) <= rows:
        return labelled
    scale = 1 << 40
    limits = [v for x, n in quotas(sizes, rows).items() for v in (F.lit(x), F.lit(scale * n // sizes[x]).cast("long"))]
    row = [c for c in ("doc_id", "text") if c in labelled.columns]
    return labelled.filter(F.pmod(F.xxhash64(*row), F.lit(scale)) < F.element_at(F.create_map(*limits), F.col("lang")))


def train(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> MaskFilter:
    """A filter from labelled docs (text, lang, doc_id), of which a random sample of about train_rows is read whole.

    What comes to the driver are the sample's distinct n-grams with their masks: bounded by the sample.
    """
    labelled = docs.select(*(c for c in docs.columns if c == "doc_id"), "text", F.col("lang").cast("string").alias("lang")).filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    codes = {x: k for k, x in enumerate(sorted(sizes))}
    if not codes:
        return MaskFilter([], np.zeros(0, np.uint32), np.zeros(0, np.uint64))
    sample = sampled(labelled, sizes, train_rows).select("text", "lang")
    counts = sample.mapInArrow(_tally(codes), "gram long, code int, count long").groupBy("gram", "code").agg(F.sum("count").alias("count"))
    counts = written(counts, "grams")
    totals = counts.groupBy("code").agg(F.sum("count").alias("total"))
    by_gram = Window.partitionBy("gram")
    shares = counts.join(F.broadcast(totals), "code").withColumn("share", F.col("count") / F.col("total"))
    chosen = shares.withColumn("most", F.max("share").over(by_gram)).filter((F.col("count") >= MIN_COUNT) & (F.col("share") >= CHARACTERISTIC * F.col("most")))
    rows = chosen.select("gram", "code", "total").toPandas()
    size = rows.groupby("code")["total"].max().to_dict()
    names = {k: x for x, k in codes.items()}
    order = sorted(codes.values(), key=lambda k: (-size.get(k, 0), names[k]))
    place = {k: i for i, k in enumerate(order)}
    values, which = np.unique(rows["gram"].to_numpy(), return_inverse=True)
    at = rows["code"].map(place).to_numpy().astype(np.int64)
    masks = np.zeros((len(values), -(-len(order) // 64)), np.uint64)
    np.bitwise_or.at(masks, (which, at // 64), np.uint64(1) << (at % 64).astype(np.uint64))
    return MaskFilter([names[k] for k in order], values.astype(np.uint32), masks)


def predicted(docs: DataFrame, model: MaskFilter, columns: list[str]) -> DataFrame:
    """The named columns of docs with lang_pred, score (the winner's part of all languages' corrected hits) and support
    (its corrected hits as a share of the text's n-grams)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for rows in slices(batch, "text"):
                if model.languages:
                    shares, lettered = model.shares(column(rows, "text"))
                    best = shares.argmax(axis=1)
                    support = np.where(lettered, np.minimum(shares.max(axis=1), 1), 0.0)
                    score = np.where(lettered, shares.max(axis=1) / np.maximum(shares.sum(axis=1), 1e-12), 0.0)
                    names = [model.languages[b] if ok else "und" for b, ok in zip(best, lettered, strict=True)]
                else:
                    names, score, support = ["und"] * rows.num_rows, np.zeros(rows.num_rows), np.zeros(rows.num_rows)
                yield pa.RecordBatch.from_arrays([*(column(rows, c) for c in columns), pa.array(names, pa.string()), pa.array(score), pa.array(support)], [*columns, "lang_pred", "score", "support"])

    read = docs.select(*columns, *([] if "text" in columns else ["text"]))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema]
    return read.mapInArrow(run, ", ".join([*kinds, "lang_pred string", "score double", "support double"]))


def accepted(docs: DataFrame, model: MaskFilter, min_support: float = 0.2) -> DataFrame:
    """The rows of docs whose text has letters, and whose best language knows at least min_support of its n-grams."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for rows in slices(batch, "text"):
                if model.languages:
                    shares, lettered = model.shares(column(rows, "text"))
                    yield rows.filter(pa.array(lettered & (shares.max(axis=1) >= min_support)))

    return docs.mapInArrow(run, docs.schema)


def held_out(column: str = "doc_id", parts: int = 5):
    """True for the rows kept from training: crc32 of the id as text is divisible by `parts`; so are null ids."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % parts == 0, F.lit(True))


def op8_language_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out().alias("held_out"))
    model = train(docs.filter(~F.col("held_out")))
    return predicted(docs, model, ["doc_id", "held_out", "text"]).drop("text")
