"""Operator 10: best-fit packing with swap-based local search.

Texts become ids with an end id; only texts of more than `capacity` tokens are cut, into full pieces and a last one. Full pieces
are sequences of their own. The others are dealt at random to groups of about GROUP_PIECES, and each group is packed best fit in
decreasing order, then improved: documents move, or are exchanged one for one or two for one, between underfull bins
wherever that raises the sum of squared fills, and bins that empty are closed. Bins still underfull are opened again and
packed with those of other groups, round after round, until one group holds what is left or a round leaves more than STALL of the pieces that
it opened in underfull bins. A group is of bounded size, so any number of documents packs without a task that holds them all.

Bins are indexed by what they could take in exchange for nothing, for one item or for two, so each step is the best of all
that the items of a bin have, whatever the number of bins. The search ends where no step raises the squared fill, or at once where the tokens need that many
bins anyway. `sequence_report` says how many sequences came of it and how many the tokens need at least.

Null texts are empty documents (only the end id). Nothing is dropped: rows with a null or repeated doc_id are packed each on its own.
An empty table gives no sequences. Other columns are ignored.
"""

from __future__ import annotations

import bisect
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenforge.llm.shared import table, written
from lumenforge.llm.text import column, slices
from lumenforge.llm.tokens import ids_crc32, tokenizer

CAPACITY = 4096
#: Pieces packed by one task at once.
GROUP_PIECES = 20_000
#: Bins at least this full stay as they are between the rounds.
FULL_SHARE = 0.999
#: A round that leaves more than this part of its pieces open has nothing left to gain.
STALL = 0.9

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, uid long"


def _pieces(path: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        made, uid = tokenizer(path), TaskContext.get().partitionId() << 40
        for batch in batches:
            for rows in slices(batch, "text", 1 << 20):
                ids, offsets = made.encode(column(rows, "text"), end_id)
                raw = ids.astype("<u4")
                sizes = np.diff(offsets)
                n = -(-sizes // capacity)
                owner = np.repeat(np.arange(len(sizes)), n)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * capacity
                length = np.minimum(capacity, sizes[owner] - start)
                at = offsets[owner] + start
                yield pa.RecordBatch.from_arrays(
                    [
                        column(rows, "doc_id").take(pa.array(owner)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length),
                        pa.array([ids_crc32(raw[a : a + s]) for a, s in zip(at.tolist(), length.tolist(), strict=True)], pa.int64()),
                        pa.array(uid + np.arange(len(owner))),
                    ],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "uid"],
                )
                uid += len(owner)

    return run


def token_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and a unique uid of each piece of each document's ids."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_pieces(tokenizer_path, end_id, capacity), PIECES)


class Bins:
    """Bins of item numbers, with those of each free size listed for best fit."""

    def __init__(self, sizes: list[int], capacity: int):
        self.sizes, self.capacity, self.items, self.free = sizes, capacity, [], []

    def best_fit(self) -> None:
        """Decreasing: each item goes to the fullest bin that has room for it."""
        by_free: dict[int, list[int]] = {}
        frees: list[int] = []  # ascending free sizes that some bin has
        for item in sorted(range(len(self.sizes)), key=lambda i: -self.sizes[i]):
            size = self.sizes[item]
            at = bisect.bisect_left(frees, size)
            if at < len(frees):
                free = frees[at]
                which = by_free[free].pop()
                if not by_free[free]:
                    frees.pop(at)
                    del by_free[free]
                self.items[which].append(item)
            else:
                free, which = self.capacity, len(self.items)
                self.items.append([item])
                self.free.append(0)
            self.free[which] = left = free - size
            if left not in by_free:
                by_free[left] = []
                bisect.insort(frees, left)
            by_free[left].append(which)

    def improve(self) -> None:
        """Moves and exchanges between underfull bins until none raises the sum of squared fills or no bin can be saved.

        A step takes g > 0 tokens from a bin with f free ones to another and leaves that one r free; the sum rises by 2g(f - r).
        """
        least = -(-sum(self.sizes) // self.capacity)
        if len(self.items) <= least:
            return
        small = min(self.sizes, default=0)
        offers = tuple(Offers(self.capacity, k * small) for k in range(3))
        for b in range(len(self.items)):
            self._offer(offers, b)
        filled, changed = len(self.items), True
        while changed and filled > least:
            changed = False
            for donor in sorted((b for b in range(len(self.items)) if self.free[b] > 0 and self.items[b]), key=lambda b: -self.free[b]):
                while self.items[donor] and self.free[donor] > 0 and (step := self._step(offers, donor)):
                    other, there, back = step
                    for b in (donor, other):
                        for o in offers:
                            o.withdraw(b)
                    gain = sum(self.sizes[i] for i in there) - sum(self.sizes[i] for i in back)
                    self.items[donor] = [i for i in self.items[donor] if i not in there] + back
                    self.items[other] = [i for i in self.items[other] if i not in back] + there
                    self.free[donor], self.free[other] = self.free[donor] + gain, self.free[other] - gain
                    for b in (donor, other):
                        self._offer(offers, b)
                    changed = True
                filled -= not self.items[donor]
        self.items = [x for x in self.items if x]

    def _distinct(self, b: int) -> tuple[list[int], list[tuple[int, int]]]:
        """A bin's items, one of each size, and its pairs of them, one of each two sizes. Distinct sizes of a bin are at most some
        root of twice the capacity, so neither list grows with its number of items."""
        by_size: dict[int, list[int]] = {}
        for i in self.items[b]:
            by_size.setdefault(self.sizes[i], []).append(i)
        one = [x[0] for x in by_size.values()]
        return one, [*itertools.combinations(one, 2), *((x[0], x[1]) for x in by_size.values() if len(x) > 1)]

    def _offer(self, offers: tuple[Offers, Offers, Offers], b: int) -> None:
        """Lists what an underfull bin gives for something larger: nothing, one item or two."""
        free, sizes = self.free[b], self.sizes
        if free > 0 and self.items[b]:
            one, two = self._distinct(b)
            for items in ((), *((x,) for x in one), *two):
                size = sum(sizes[i] for i in items)
                offers[len(items)].add(b, size + free, size, items)

    def _step(self, offers: tuple[Offers, Offers, Offers], donor: int) -> tuple[int, list[int], list[int]] | None:
        """(other bin, items that go there, items that come back): the step that raises the squared fill most."""
        top, value = None, 0
        one, two = self._distinct(donor)
        for items in (*((x,) for x in one), *two):
            size = sum(self.sizes[i] for i in items)
            for offer in offers[: 4 - len(items)]:  # never two for two
                found = offer.best(size, donor, self.free[donor], value)
                if found:
                    value, other, back = found
                    top = other, list(items), list(back)
        return top


class Offers:
    """What bins give for something larger, by reach: the size up to which the thing may be, given up items and free tokens together."""

    def __init__(self, capacity: int, least: int):
        self.least = least  # that any of them gives up
        self.by_reach: list[dict[int, dict[int, tuple[int, ...]]]] = [{} for _ in range(capacity + 1)]
        self.by_bin: dict[int, list[tuple[int, int]]] = {}
        self.mask = 0  # a bit for each reach that some bin has

    def add(self, b: int, reach: int, size: int, items: tuple[int, ...]) -> None:
        self.by_reach[reach].setdefault(size, {})[b] = items
        self.by_bin.setdefault(b, []).append((reach, size))
        self.mask |= 1 << reach

    def withdraw(self, b: int) -> None:
        for reach, size in self.by_bin.pop(b, ()):
            offers = self.by_reach[reach]
            if size in offers:
                offers[size].pop(b, None)
                if not offers[size]:
                    del offers[size]
                    if not offers:
                        self.mask &= ~(1 << reach)

    def best(self, size: int, donor: int, free: int, value: int) -> tuple[int, int, tuple[int, ...]] | None:
        """(value, bin, items) of the best offer of another bin to a donor with so many free tokens, if it is worth more than `value`.

        From the offers that leave the other bin full on; of those that leave it equally full, the one that gives least.
        """
        out, mask = None, (self.mask >> size) & ((1 << free) - 1)
        while mask:
            left = (mask & -mask).bit_length() - 1
            if (size - self.least) * (free - left) <= value:
                break
            offers = self.by_reach[size + left]
            for give in sorted(offers) if len(offers) > 1 else offers:
                if give >= size:
                    break
                b = next((b for b in offers[give] if b != donor), None)
                if b is not None:
                    if (size - give) * (free - left) > value:
                        value = (size - give) * (free - left)
                        out = value, b, offers[give][b]
                    break
            mask &= mask - 1
        return out


def packed_bins(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Item numbers by bin."""
    bins = Bins(sizes, capacity)
    bins.best_fit()
    bins.improve()
    return bins.items


def _pack(capacity: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "uid"], ascending=[False, True], ignore_index=True)
        bins = packed_bins(rows["length"].tolist(), capacity)
        order = np.array([i for b in bins for i in b], np.int64)
        counts = [len(b) for b in bins]
        out = rows.iloc[order]
        length = out["length"].to_numpy()
        ends = np.cumsum(length)
        first = np.cumsum(counts) - counts
        before = ends[first] - length[first] if len(first) else ends
        fill = np.add.reduceat(length, first) if len(first) else length
        return out.assign(sequence=np.repeat(rows["uid"].to_numpy()[order[first]], counts), offset=ends - length - np.repeat(before, counts), fill=np.repeat(fill, counts))[["uid", "sequence", "offset", "fill"]]

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """pieces (a written table with uid and length) with sequence_id and offset."""
    full = pieces.filter(F.col("length") >= capacity).select("uid", F.col("uid").alias("sequence"), F.lit(0).cast("long").alias("offset"))
    rest = pieces.filter(F.col("length") < capacity).select("uid", "length")
    done = [full]
    size, n, turn = None, rest.count(), 0
    while True:
        groups = max(1, -(-n // group_pieces))
        dealt = rest.withColumn("group", F.pmod(F.xxhash64("uid", F.lit(turn)), F.lit(groups)))
        bins = written(dealt.groupBy("group").applyInPandas(_pack(capacity), "uid long, sequence long, offset long, fill long"), "bins").withColumn("open", F.col("fill") < int(FULL_SHARE * capacity))
        again = bins.filter("open").count() if groups > 1 else 0
        if not again or (size is not None and again >= STALL * size):
            done.append(bins.select("uid", "sequence", "offset"))
            break
        done.append(bins.filter(~F.col("open")).select("uid", "sequence", "offset"))
        rest, size, n, turn = bins.filter("open").select("uid").join(pieces.select("uid", "length"), "uid"), again, again, turn + 1
    out = done[0]
    for df in done[1:]:
        out = out.unionByName(df)
    return pieces.join(out, "uid").withColumnRenamed("sequence", "sequence_id")


def sequence_report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: pieces, tokens, sequences, and the fewest sequences that so many tokens could take."""
    out = packed.agg(F.count("*").alias("pieces"), F.coalesce(F.sum("length"), F.lit(0)).alias("tokens"), F.count_distinct("sequence_id").alias("sequences"))
    return out.withColumn("least", F.ceil(F.col("tokens") / capacity))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = written(token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 1), "pieces")
    return pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
