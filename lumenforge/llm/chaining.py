"""Operator 4: fuzzy repeated passages by collinear chaining of shared k-mer seeds.

Seeds are the minimizers of each text's runs of K words. Each occurrence of a seed is joined to the seed's first occurrence (smallest doc_id,
then place), found among those a worker holds and then over all, so joined pairs grow with the rows however many documents share a
passage. The seeds that a document shares with an earlier one are chained: the best chain in order in both, less a cost for
gaps, by prefix maxima in a Fenwick tree; then the next best of the seeds left. A chain's words are aligned between its
seeds and extended at both ends as long as they agree, and a passage is an alignment of at least MIN_WORDS words of which
IDENTITY agree. A chain that falls short of it is parted at its worst gap, and its parts likewise.

Runs of MIN_WORDS words that an earlier document holds word for word are found whoever else holds their parts: each such
run between shared seeds is a seed of its own, and what no passage above holds is reported too, with identity 1. A passage with changed words
is compared with the first holders of its seeds only: one whose parts each have another first holder may be missed.

IDENTITY is what an alignment must reach, not what is sure to be found: seeds need runs of K equal words, of which about 2 of 13
are kept. Measured on two random texts that share a passage with one changed word each n words (200 trials a row), the share
found of passages of 60, 100 and 200 words is 1.00, 1.00, 1.00 at identity 0.95; 0.93, 0.99, 1.00 at 0.92; 0.69, 0.83, 1.00
at 0.90; 0.51, 0.61, 0.91 at 0.89; and none at 0.875 or less, where no K words in a row are equal.

Words are lower-cased (A-Z) runs of bytes other than white space. Null and empty texts, and texts of fewer than K words, hold no passage;
rows with a null doc_id take no part. Repeats within one document do not count. doc_id names a text: repeated
rows of it are one document. Empty tables give no rows; other columns are ignored. Whole texts are read and nothing
is capped.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenforge.llm.shared import input_partitions, removed, table, written
from lumenforge.llm.text import column, gathered, list_array, rolled, slices, text_bytes, word_hashes, word_spans

K = 8
#: Of each so many runs of K words in a row, the least is a seed.
WINDOW = 12
MIN_WORDS = 50
IDENTITY = 0.8
#: Cost of a skipped word in a chain, in matched words.
GAP_COST = 0.1
#: Seeds that a worker puts in order at once.
HELD = 1 << 19
#: Words around a chain that an alignment may extend into, beyond the edges of blocks of so many words.
BLOCK = 64
#: An extension ends when its score (1 for equal words, -2 for others) has fallen by this much.
DROP = 12


def minimizers(words: np.ndarray, first: np.ndarray, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place of the word in its row, hash) of each seed; texts shorter than a window have one."""
    h = rolled(words, k)
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), h
    sizes = np.diff(first)
    rows = np.repeat(np.arange(len(sizes)), sizes)[: len(h)]
    n = np.maximum(sizes - k + 1, 0)
    place = np.arange(len(h)) - first[rows]
    chosen = np.zeros(len(h), bool)
    # a run is a seed if it is the least of some window of its own row: the greatest of the leasts of the windows that hold it is its own
    if len(h) >= window:
        least = _least(h, window)
        least[place[: len(least)] > (n - window)[rows[: len(least)]]] = 0
        around = np.zeros(len(h) + window - 1, np.uint64)
        around[window - 1 : window - 1 + len(least)] = least
        chosen = (_least(~around, window) == ~h) & (n[rows] >= window) & (place < n[rows])
    for r in np.flatnonzero((n > 0) & (n < window)):
        run = h[first[r] : first[r] + n[r]]
        chosen[first[r] : first[r] + n[r]] = run == run.min()
    at = np.flatnonzero(chosen)
    return rows[at], place[at], h[at]


def _firsts(seeds: np.ndarray, docs: np.ndarray, places: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct occurrences in order of seed, doc and place, with their seed's first (doc, place), and what a seed tells of itself."""
    order = np.argsort(seeds)
    again = np.zeros(len(seeds) + 1, bool)
    again[1:-1] = seeds[order[1:]] == seeds[order[:-1]]
    several = np.flatnonzero(again[1:] | again[:-1])
    some = order[several]
    order[several] = some[np.lexsort((places[some], docs[some], seeds[some]))]
    seeds, docs, places, *more = (x[order] for x in (seeds, docs, places, *more))
    new = np.ones(len(seeds), bool)
    new[1:] = (seeds[1:] != seeds[:-1]) | (docs[1:] != docs[:-1]) | (places[1:] != places[:-1])
    seeds, docs, places, *more = (x[new] for x in (seeds, docs, places, *more))
    lead = np.ones(len(seeds), bool)
    lead[1:] = seeds[1:] != seeds[:-1]
    at = np.flatnonzero(lead)[np.cumsum(lead) - 1] if len(seeds) else np.zeros(0, np.int64)
    return seeds, docs, places, docs[at], places[at], *more


def _shared(seeds: np.ndarray, docs: np.ndarray, other: np.ndarray) -> np.ndarray:
    """True for the occurrences, in the order of _firsts, of seeds that more than one document holds."""
    if not len(seeds):
        return np.zeros(0, bool)
    lead = np.flatnonzero(np.concatenate([[True], seeds[1:] != seeds[:-1]]))
    return np.repeat(np.logical_or.reduceat(docs != other, lead), np.diff(np.append(lead, len(seeds))))


def _least(values: np.ndarray, window: int) -> np.ndarray:
    """The least of each `window` values in a row, by its first place."""
    least, span = values, 1
    while span < window:
        step = min(span, window - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    return least


def long_runs(words: np.ndarray, first: np.ndarray, ranges: list[list[dict]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, hash, least hash of its K words) of the runs of MIN_WORDS words that start within a row's ranges (low, high beyond
    the last). Runs that follow one another mostly share that least hash: dealt by it, they stay together."""
    rows, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for r, some in enumerate(ranges):
        for x in some:
            at = np.arange(x["low"], min(x["high"], int(first[r + 1] - first[r]) - MIN_WORDS + 1))
            rows.append(np.full(len(at), r))
            places.append(at)
    row, place = np.concatenate(rows), np.concatenate(places)
    if not len(row):
        return row, place, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    at = first[row] + place
    return row, place, rolled(words, MIN_WORDS)[at], _least(rolled(words, K), MIN_WORDS - K + 1)[at]


_PACKED = "bucket int, seeds binary, docs binary, places binary, other_docs binary, other_places binary"
_NAMES = ["bucket", "seeds", "docs", "places", "other_docs", "other_places"]


def _pack(bucket: int, *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), *(pa.array([c.tobytes()], pa.binary()) for c in columns)], _NAMES)


def _seeded(buckets: int, ranged: bool = False):
    """Occurrences of seeds shared among HELD of them (bucket -1), and those in each seed's first document packed by hash bucket.

    The seeds are minimizers or, if `ranged`, the runs of MIN_WORDS words that start within the column `ranges`.
    """

    def seeded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        for batch in batches:
            for rows in slices(batch, "text"):
                words, first = word_hashes(column(rows, "text"))
                row, place, h, *by = long_runs(words, first, column(rows, "ranges").to_pylist()) if ranged else minimizers(words, first)
                yield h, column(rows, "doc_id").to_numpy()[row], place, *(by or [h])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in gathered(seeded(batches), HELD):
            seeds, docs, places, other, other_places, by = _firsts(*some)
            shared = _shared(seeds, docs, other)
            if shared.any():
                yield _pack(-1, seeds[shared], docs[shared], places[shared], other[shared], other_places[shared])
            # repeats within the first document too: an earlier document of another batch may hold them
            lead = docs == other
            seeds, docs, places, by = seeds[lead], docs[lead], places[lead], by[lead]
            where = ((by >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(where, kind="stable")
            cuts = np.searchsorted(where[order], np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(cuts)):
                part = order[cuts[b] : cuts[b + 1]]
                yield _pack(int(b), seeds[part], docs[part], places[part], docs[:0], places[:0])

    return run


def _paired(rows: pa.Table) -> pa.Table:
    """The shared occurrences of each document with their seed's first; those of the first document itself have it as `others`."""
    load = lambda name, kind: np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in rows[name]])
    seeds, docs, places = load("seeds", np.uint64), load("docs", np.int64), load("places", np.int64)
    if rows["bucket"][0].as_py() < 0:
        other, other_places = load("other_docs", np.int64), load("other_places", np.int64)
    else:
        seeds, docs, places, other, other_places = _firsts(seeds, docs, places)
        shared = _shared(seeds, docs, other)
        docs, places, other, other_places = docs[shared], places[shared], other[shared], other_places[shared]
    order = np.lexsort((places, docs))
    docs, places, other, other_places = docs[order], places[order], other[order], other_places[order]
    cuts = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1], [True]])) if len(docs) else np.zeros(1, np.int64)
    lists = [list_array(x, cuts, t) for x, t in ((places, pa.int32()), (other, pa.int64()), (other_places, pa.int32()))]
    return pa.table([pa.array(docs[cuts[:-1]]), *lists], ["doc_id", "places", "others", "other_places"])


def chains(places: np.ndarray, others: np.ndarray, k: int = K, gap_cost: float = GAP_COST) -> list[list[int]]:
    """Seed numbers of each chain, ascending in both; each seed is in one chain at most, the best chains come first.

    score(i) = k + max(0, max over j before i in both of score(j) - gap_cost * (skipped words of both)): the maximum over j is
    a prefix maximum over `others` in a Fenwick tree, taken in order of `places`.
    """
    n = len(places)
    if n == 1:
        return [[0]]
    order = np.lexsort((others, places)).tolist()
    distinct = np.unique(others)
    rank = (np.searchsorted(distinct, others) + 1).tolist()
    size = len(distinct)
    p, o = places.tolist(), others.tolist()
    tree: list[tuple[float, int]] = [(float("-inf"), -1)] * (size + 1)
    score, before = [0.0] * n, [-1] * n
    waiting: list[int] = []
    for i in order:
        # seeds at the same place cannot follow one another
        if waiting and p[waiting[0]] != p[i]:
            for w in waiting:
                best = (score[w] + gap_cost * (p[w] + o[w]), w)
                at = rank[w]
                while at <= size:
                    if best > tree[at]:
                        tree[at] = best
                    at += at & -at
            waiting = []
        best, at = (float("-inf"), -1), rank[i] - 1
        while at > 0:
            if tree[at] > best:
                best = tree[at]
            at -= at & -at
        gain = best[0] - gap_cost * (p[i] + o[i])
        # seeds that overlap count only their new words
        score[i] = float(k)
        if best[1] >= 0:
            j = best[1]
            new = min(k, p[i] - p[j], o[i] - o[j])
            if gain + new > k:
                score[i], before[i] = gain + new + gap_cost * 2 * min(p[i] - p[j], o[i] - o[j]) * (new < k), j
        waiting.append(i)
    used, out = [False] * n, []
    for i in sorted(range(n), key=lambda i: -score[i]):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = before[i]
        if chain:
            out.append(chain[::-1])
    return out


_CHAIN = pa.struct([("other", pa.int64()), ("low", pa.int32()), ("high", pa.int32()), ("other_low", pa.int32()), ("other_high", pa.int32()), ("places", pa.list_(pa.int32())), ("other_places", pa.list_(pa.int32()))])
_CHAIN_SQL = "struct<other:bigint,low:int,high:int,other_low:int,other_high:int,places:array<int>,other_places:array<int>>"


_RANGE = pa.struct([("low", pa.int32()), ("high", pa.int32())])
_RANGE_SQL = "struct<low:int,high:int>"


def _block(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words to align around chains: whole blocks, so that the chains of a shared passage ask for the same ones."""
    return np.maximum(0, (low // BLOCK - 1) * BLOCK), (high // BLOCK + 3) * BLOCK


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The batches, which are in order of doc_id, cut so that each document is whole in one table."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = column(batch, "doc_id").to_numpy()
        if held and ids[-1] == column(held[0], "doc_id")[0].as_py():
            held.append(batch)
            continue
        cut = int(np.searchsorted(ids, ids[-1]))
        if held or cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)


def _by_document(work):
    """A function of tables of whole documents as one of batches in order of doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole(batches):
            yield from work(rows).to_batches()

    return run


def _occurrences(rows: pa.Table) -> tuple[np.ndarray, ...]:
    """The documents, and of each shared seed its document's number, place, the document it is first in, and its place there."""
    ids = rows["doc_id"].to_numpy()
    new = np.ones(len(ids), bool)
    new[1:] = ids[1:] != ids[:-1]
    sizes = np.concatenate([np.diff(x.offsets.to_numpy()) for x in rows["places"].chunks])
    flat = (np.concatenate([x.flatten().to_numpy() for x in rows[c].chunks]).astype(np.int64) for c in ("places", "others", "other_places"))
    return ids[new], np.repeat(np.cumsum(new) - 1, sizes), *flat


def _ranges_of(steps: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each step on, so many of them, one run after another."""
    return np.repeat(steps - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def _lists(doc: np.ndarray, count: int, items: pa.StructArray) -> pa.ListArray:
    """The items, in order of their document's number, as a list for each document."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(count + 1)).astype(np.int32)), items)


def _structs(kind: pa.StructType, *columns) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array(c, f.type) if isinstance(c, np.ndarray) else c for c, f in zip(columns, kind, strict=True)], fields=list(kind))


def _candidates(doc: np.ndarray, places: np.ndarray, count: int) -> pa.ListArray:
    """Where runs of MIN_WORDS words that another document holds may start, given the places of each document's shared seeds.

    Each window within such a run has a seed that is shared, so shared seeds lie at most WINDOW apart from its start to its end.
    """
    order = np.lexsort((places, doc))
    doc, places = doc[order], places[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (np.diff(places) > WINDOW)
    lead = np.flatnonzero(new)
    last = np.append(lead[1:], len(doc))[: len(lead)] - 1
    low, high = np.maximum(places[lead] - (WINDOW - 1), 0), places[last] - (MIN_WORDS - K - WINDOW + 1) + 1
    some = low < high
    return _lists(doc[lead][some], count, _structs(_RANGE, low[some], high[some]))


def _chained(rows: pa.Table) -> pa.Table:
    """One row a document: the chains of its seeds with each earlier document, those to align first and the rest, and where
    runs shared word for word may start. The rows of one document follow one another."""
    docs, doc, place, other, other_place = _occurrences(rows)
    ranges = _candidates(doc, place, len(docs))
    earlier = np.flatnonzero(other != docs[doc])
    # rows arrive in any order: ties between chains must not depend on it
    order = earlier[np.lexsort((other_place[earlier], place[earlier], other[earlier], doc[earlier]))]
    doc, place, other, other_place = doc[order], place[order], other[order], other_place[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (other[1:] != other[:-1])
    lead = np.flatnonzero(new)
    sizes = np.diff(np.append(lead, len(doc)))
    # where each step adds more than it costs, the best chain takes all seeds: most pairs of documents are such
    step, other_step = np.diff(place, prepend=0), np.diff(other_place, prepend=0)
    gains = new | (np.minimum(np.minimum(step, other_step), K) > GAP_COST * (step + other_step) + 1e-6)
    simple = np.logical_and.reduceat(gains, lead) if len(lead) else np.zeros(0, bool)
    parts, number, found = [np.flatnonzero(np.repeat(simple, sizes))], [np.zeros(int(simple.sum()), np.int64)], [sizes[simple]]
    for g in np.flatnonzero(~simple):
        a, b = lead[g], lead[g] + sizes[g]
        made = chains(place[a:b], other_place[a:b])
        parts.append(np.fromiter((i for c in made for i in c), np.int64) + a)
        number.append(np.arange(len(made)))
        found.append(np.array([len(c) for c in made]))
    seeds, number, sizes = np.concatenate(parts), np.concatenate(number), np.concatenate(found).astype(np.int64)
    begin = np.cumsum(sizes) - sizes
    head, tail = seeds[begin], seeds[begin + sizes - 1]
    # chains of each document by the words they reach over
    rank = np.lexsort((number, other[head], -sizes, place[head] - place[tail], doc[head]))
    begin, sizes, head, tail = begin[rank], sizes[rank], head[rank], tail[rank]
    (low, high), (other_low, other_high) = _block(place[head], place[tail]), _block(other_place[head], other_place[tail])
    first = _apart(doc[head], low, high)

    def listed(some: np.ndarray) -> pa.ListArray:
        at = seeds[_ranges_of(begin[some], sizes[some])]
        cuts = np.append(0, np.cumsum(sizes[some]))
        whose, words, other_words = head[some], list_array(place[at], cuts, pa.int32()), list_array(other_place[at], cuts, pa.int32())
        return _lists(doc[whose], len(docs), _structs(_CHAIN, other[whose], low[some], high[some], other_low[some], other_high[some], words, other_words))

    return pa.table([pa.array(docs), listed(np.flatnonzero(first)), listed(np.flatnonzero(~first)), ranges], ["doc_id", "first", "rest", "ranges"])


def _apart(doc: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """True for the ranges that overlap none taken before them in their document."""
    first = np.ones(len(doc), bool)
    cuts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1], [True]])) if len(doc) else np.zeros(1, np.int64)
    several = np.flatnonzero(np.diff(cuts) > 1)
    for a, b in zip(cuts[several].tolist(), cuts[several + 1].tolist(), strict=True):
        starts: list[int] = []
        ends: list[int] = []
        for i, (lo, hi) in enumerate(zip(low[a:b].tolist(), high[a:b].tolist(), strict=True), a):
            at = bisect.bisect_left(starts, hi)
            if at and ends[at - 1] > lo:
                first[i] = False
            else:
                starts.insert(at, lo)
                ends.insert(at, hi)
    return first


def _few(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of so many rows: their lists become Python objects."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


def _uncovered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the chains put off, those with a seed that no passage found so far covers."""
    for batch in batches:
        if not batch.num_rows:
            continue
        rest, spans = batch.column(1), batch.column(2)
        made, held = rest.flatten(), spans.flatten()
        numbers = np.arange(batch.num_rows, dtype=np.int64)
        whose = np.repeat(numbers, np.diff(rest.offsets.to_numpy()))
        span_doc = np.repeat(numbers, spans.value_lengths().fill_null(0).to_numpy()) << 32
        starts = span_doc + held.field("start_word").to_numpy()
        order = np.argsort(starts)
        # the furthest end of the spans that start no later, in the same document
        reach = np.append(np.maximum.accumulate((span_doc + held.field("end_word").to_numpy())[order]), -1)
        places = made.field("places")
        sizes = np.diff(places.offsets.to_numpy())
        at = (np.repeat(whose, sizes) << 32) + places.flatten().to_numpy()
        covered = reach[np.searchsorted(starts[order], at, "right") - 1] >= at + K
        kept = np.flatnonzero(~np.logical_and.reduceat(covered, np.cumsum(sizes) - sizes)) if len(sizes) else np.zeros(0, np.int64)
        docs, cuts = np.unique(whose[kept], return_index=True)
        lists = pa.ListArray.from_arrays(pa.array(np.append(cuts, len(kept)).astype(np.int32)), made.take(pa.array(kept)))
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(docs)), lists], ["doc_id", "chains"])


def _runs(rows: pa.Table) -> pa.Table:
    """One row a document: its stretches that an earlier document holds word for word, all starts of MIN_WORDS words put together."""
    docs, doc, place, other, other_place = _occurrences(rows)
    earlier = np.flatnonzero(other != docs[doc])
    order = earlier[np.lexsort((place[earlier], other_place[earlier] - place[earlier], other[earlier], doc[earlier]))]
    doc, place, other, other_place = doc[order], place[order], other[order], other_place[order]
    new = np.ones(len(place), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (other[1:] != other[:-1]) | (place[1:] - place[:-1] > 1) | (other_place[1:] - other_place[:-1] != place[1:] - place[:-1])
    lead = np.flatnonzero(new)
    last = np.append(lead[1:], len(place))[: len(lead)] - 1
    made = _structs(_RUN, place[lead], place[last] + MIN_WORDS, other[lead], other_place[lead])
    return pa.table([pa.array(docs), _lists(doc[lead], len(docs), made)], ["doc_id", "runs"])


_RUN = pa.struct([("start_word", pa.int32()), ("end_word", pa.int32()), ("other", pa.int64()), ("other_start", pa.int32())])
_RUN_SQL = "struct<start_word:int,end_word:int,other:bigint,other_start:int>"


def covering(runs: list[dict], spans: list[dict]) -> list[dict]:
    """Of runs, those that a single span does not hold, less those whose words the others cover."""
    spans = sorted((s["start_word"], s["end_word"]) for s in spans)
    starts = [s for s, _ in spans]
    reach = np.maximum.accumulate([e for _, e in spans]).tolist() if spans else []
    left = []
    for x in sorted(runs, key=lambda x: (x["start_word"], -x["end_word"], x["other"], x["other_start"])):
        at = bisect.bisect_right(starts, x["start_word"]) - 1
        if at < 0 or reach[at] < x["end_word"]:
            left.append(x)
    out: list[dict] = []
    end, best = -1, None
    for x in left:
        if best and x["start_word"] > end:  # nothing later covers the word at `end`
            out.append(best)
            end, best = best["end_word"], None
        if x["end_word"] > end and (not best or x["end_word"] > best["end_word"]):
            best = x
            if x["start_word"] > end:
                out.append(x)
                end, best = x["end_word"], None
    return [*out, best] if best else out


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passages of the runs that no passage found by chains holds."""
    for batch in _few(batches):
        out: list[list] = [[] for _ in _PASSAGE]
        for doc, runs, spans in zip(*(column(batch, c).to_pylist() for c in ("doc_id", "runs", "spans")), strict=True):
            for x in covering(runs, spans or []):
                n = x["end_word"] - x["start_word"]
                for kept, v in zip(out, (doc, x["other"], x["start_word"], x["end_word"], x["other_start"], x["other_start"] + n, 1.0), strict=True):
                    kept.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, _PASSAGE, strict=True)], _PASSAGE.names)


_PASSAGE = pa.schema([("doc_id", pa.int64()), ("other_doc_id", pa.int64()), ("start_word", pa.int32()), ("end_word", pa.int32()), ("other_start_word", pa.int32()), ("other_end_word", pa.int32()), ("identity", pa.float64())])
_PASSAGE_SQL = "doc_id long, other_doc_id long, start_word int, end_word int, other_start_word int, other_end_word int, identity double"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word hashes of the asked blocks of each text."""
    for batch in batches:
        for rows in slices(batch, "text"):
            words, first = word_hashes(column(rows, "text"))
            asked = column(rows, "asked")
            row = np.repeat(np.arange(rows.num_rows), np.diff(asked.offsets.to_numpy()))
            low, high = (asked.flatten().field(c).to_numpy() for c in ("low", "high"))
            begin, end = np.minimum(first[row] + low, first[row + 1]), np.minimum(first[row] + high, first[row + 1])
            cut = [words[a:b].tobytes() for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([column(rows, "doc_id").take(pa.array(row)), pa.array(low), pa.array(high), pa.array(cut, pa.binary())], ["doc_id", "low", "high", "words"])


def _extend(x: np.ndarray, y: np.ndarray) -> tuple[int, int]:
    """(words, equal ones) of the best common start of x and y."""
    every, n = min(len(x), len(y)), BLOCK
    while every:
        n = min(n, every)
        same = x[:n] == y[:n]
        score = np.cumsum(np.where(same, 1, -2))
        dropped = np.flatnonzero(np.maximum.accumulate(np.maximum(score, 0)) - score > DROP)
        if len(dropped) or n == every:
            score = score[: dropped[0]] if len(dropped) else score
            best = int(score.argmax()) if len(score) else 0
            return (best + 1, (int(score[best]) + 2 * (best + 1)) // 3) if len(score) and score[best] > 0 else (0, 0)
        n *= 4
    return 0, 0


def _extended(x: np.ndarray, y: np.ndarray, at_x: np.ndarray, at_y: np.ndarray, n: np.ndarray, way: int) -> tuple[np.ndarray, np.ndarray]:
    """_extend from many places of x and y at once, over n words of each, forward (way 1) or back (-1)."""
    step = np.arange(int(n.max()))
    if not len(step):
        return np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
    same = x.take(at_x[:, None] + way * step, mode="clip") == y.take(at_y[:, None] + way * step, mode="clip")
    same &= step < n[:, None]
    score = np.cumsum(np.where(same, np.int32(1), np.int32(-2)), axis=1, dtype=np.int32)
    dropped = np.maximum.accumulate(np.maximum(score, 0), axis=1) - score > DROP
    score[np.logical_or.accumulate(dropped, axis=1)] = -1
    best = score.argmax(axis=1)
    top = score[np.arange(len(n)), best].astype(np.int64)
    return np.where(top > 0, best + 1, 0), np.where(top > 0, (top + 2 * (best + 1)) // 3, 0)


def _equal(x: np.ndarray, y: np.ndarray) -> int:
    """Words of the longest common subsequence of two gaps."""
    if len(x) == len(y):
        same = int((x == y).sum())
        if 2 * same >= len(x):
            return same
    # common ends are part of it
    n = min(len(x), len(y))
    unequal = np.flatnonzero(x[:n] != y[:n])
    head = int(unequal[0]) if len(unequal) else n
    x, y, n = x[head:], y[head:], n - head
    unequal = np.flatnonzero(x[len(x) - n :] != y[len(y) - n :])
    tail = n - 1 - int(unequal[-1]) if len(unequal) else n
    x, y = x[: len(x) - tail], y[: len(y) - tail]
    if not len(x) or not len(y):
        return head + tail
    # a row of the dynamic program as bits of a whole number, zero where it grows
    held: dict[int, int] = {}
    for i, b in enumerate(y.tolist()):
        held[b] = held.get(b, 0) | 1 << i
    full = row = (1 << len(y)) - 1
    for a in x.tolist():
        if same := held.get(a, 0):
            row = (row + (row & same) | row - (row & same)) & full
    return head + tail + len(y) - row.bit_count()


def _gaps(x: np.ndarray, y: np.ndarray, places: np.ndarray, others: np.ndarray, begin: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What each seed of the chains that begin at `begin` adds: (equal words of the gap before it, all of them, its own new words)."""
    step, other_step = np.diff(places, prepend=0), np.diff(others, prepend=0)
    fresh = np.maximum(0, np.minimum(np.minimum(step, other_step), k))
    fresh[begin] = k
    gap_x, gap_y = np.maximum(step - k, 0), np.maximum(other_step - k, 0)
    gap_x[begin] = gap_y[begin] = 0
    same = np.zeros(len(places), np.int64)
    level = np.flatnonzero((gap_x == gap_y) & (gap_x > 0))
    if len(level):
        sizes = gap_x[level]
        agree = x[_ranges_of(places[level - 1] + k, sizes)] == y[_ranges_of(others[level - 1] + k, sizes)]
        same[level] = np.add.reduceat(agree.astype(np.int64), np.cumsum(sizes) - sizes)
    unlike = np.flatnonzero((gap_x > 0) & (gap_y > 0) & ((gap_x != gap_y) | (2 * same < gap_x)))
    ends = (places[unlike - 1] + k, places[unlike], others[unlike - 1] + k, others[unlike])
    same[unlike] = [_equal(x[a:b], y[c:d]) for a, b, c, d in zip(*(e.tolist() for e in ends), strict=True)]
    return same, np.maximum(gap_x, gap_y), fresh


def aligned(x: np.ndarray, y: np.ndarray, places: np.ndarray, others: np.ndarray, k: int = K, least: float = IDENTITY) -> list[tuple[int, int, int, int, float]]:
    """(start, end, other start, other end, share of equal words) of a chain's alignment between word arrays.

    Where too few words agree over the whole, the chain is parted at its gap of the most unequal words, and its parts again: passages
    with other text between them come out one by one.
    """
    return _parted(x, y, places, others, *_gaps(x, y, places, others, np.zeros(1, np.int64), k), k, least)


def _parted(x: np.ndarray, y: np.ndarray, places: np.ndarray, others: np.ndarray, gap_same: np.ndarray, gap_total: np.ndarray, fresh: np.ndarray, k: int, least: float) -> list[tuple[int, int, int, int, float]]:
    """The alignments of a chain and, where it falls short, of its parts, from what each seed adds."""
    unequal, all_same, every = gap_total - gap_same, np.cumsum(gap_same + fresh).tolist(), np.cumsum(gap_total + fresh).tolist()
    out, parts = [], [(0, len(places))]
    while parts:
        low, high = parts.pop()
        a, b, c, d = int(places[low]), int(others[low]), int(places[high - 1]) + k, int(others[high - 1]) + k
        right, right_same = _extend(x[c:], y[d:])
        left, left_same = _extend(x[:a][::-1], y[:b][::-1])
        total = k + every[high - 1] - every[low] + left + right
        same = k + all_same[high - 1] - all_same[low] + left_same + right_same
        if same >= least * total:
            out.append((a - left, c + right, b - left, d + right, same / total))
        elif high - low > 1:
            cut = low + 1 + int(unequal[low + 1 : high].argmax())
            if unequal[cut]:
                parts += [(cut, high), (low, cut)]
    return out


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The passages of each row's chain: those that hold as a whole for many rows at once, the others one by one."""
    for batch in _few(batches):
        ids, others, low, other_low = (column(batch, c).to_numpy().astype(np.int64) for c in ("doc_id", "other", "low", "other_low"))
        (x, x_at), (y, y_at) = (text_bytes(column(batch, c)) for c in ("words", "other_words"))
        x, x_at, y, y_at = x.view(np.uint64), x_at // 8, y.view(np.uint64), y_at // 8
        sizes = np.diff(column(batch, "places").offsets.to_numpy()).astype(np.int64)
        begin = np.cumsum(sizes) - sizes
        # places within the words of all rows
        p = column(batch, "places").flatten().to_numpy() + np.repeat(x_at[:-1] - low, sizes)
        o = column(batch, "other_places").flatten().to_numpy() + np.repeat(y_at[:-1] - other_low, sizes)
        gap_same, gap_total, fresh = _gaps(x, y, p, o, begin, K)
        a, b, c, d = p[begin], o[begin], p[begin + sizes - 1] + K, o[begin + sizes - 1] + K
        right, right_same = _extended(x, y, c, d, np.minimum(x_at[1:] - c, y_at[1:] - d), 1)
        left, left_same = _extended(x, y, a - 1, b - 1, np.minimum(a - x_at[:-1], b - y_at[:-1]), -1)
        total = np.add.reduceat(gap_total + fresh, begin) + left + right
        same = np.add.reduceat(gap_same + fresh, begin) + left_same + right_same
        whole = same >= IDENTITY * total
        row = np.arange(len(ids))
        found = [v[whole] for v in (row, a - left - x_at[:-1], c + right - x_at[:-1], b - left - y_at[:-1], d + right - y_at[:-1], same / total)]
        parts = []
        for r in np.flatnonzero(~whole & (np.add.reduceat(gap_total - gap_same, begin) > 0)):
            mine, u, v = slice(begin[r], begin[r] + sizes[r]), slice(x_at[r], x_at[r + 1]), slice(y_at[r], y_at[r + 1])
            parts += [(r, *m) for m in _parted(x[u], y[v], p[mine] - x_at[r], o[mine] - y_at[r], gap_same[mine], gap_total[mine], fresh[mine], K, IDENTITY)]
        if parts:
            found = [np.concatenate([v, np.array(w, v.dtype)]) for v, w in zip(found, zip(*parts, strict=True), strict=True)]
        row, start, end, other_start, other_end, share = (v[found[2] - found[1] >= MIN_WORDS] for v in found)
        columns = (ids[row], others[row], start + low[row], end + low[row], other_start + other_low[row], other_end + other_low[row], share)
        yield pa.RecordBatch.from_arrays([pa.array(v).cast(f.type) for v, f in zip(columns, _PASSAGE, strict=True)], _PASSAGE.names)


def passages(docs: DataFrame) -> DataFrame:
    """Passages of docs (doc_id, text) that an earlier document holds too: doc_id, start_word, end_word (beyond the last),
    other_doc_id (smaller), other_start_word, other_end_word and identity, the share of aligned words that agree."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id IS NOT NULL AND text IS NOT NULL")
    buckets = max(16, 4 * input_partitions(docs))
    spread = F.when(F.col("bucket") < 0, -1 - F.pmod(F.xxhash64("seeds"), F.lit(buckets))).otherwise(F.col("bucket")).cast("int")

    def paired(packed: DataFrame) -> DataFrame:
        return packed.withColumn("bucket", spread).groupBy("bucket").applyInArrow(_paired, "doc_id long, places array<int>, others array<bigint>, other_places array<int>")

    def documents(rows: DataFrame, work, schema: str) -> DataFrame:
        """work on tables of whole documents: a document's seeds, which are at most its words, come together, with those of others."""
        return rows.repartition("doc_id").sortWithinPartitions("doc_id").mapInArrow(_by_document(work), schema)

    pairs = paired(docs.mapInArrow(_seeded(buckets), _PACKED))
    both = f"doc_id long, first array<{_CHAIN_SQL}>, rest array<{_CHAIN_SQL}>, ranges array<{_RANGE_SQL}>"
    chained = written(documents(pairs, _chained, both), "chains")

    def align(some: DataFrame) -> DataFrame:
        """Passages of the chains in some (doc_id, chains)."""
        flat = written(some.select("doc_id", F.explode("chains").alias("c")).select("doc_id", "c.*"), "flat-chains")
        asked = flat.select("doc_id", "low", "high").unionByName(flat.select(F.col("other").alias("doc_id"), F.col("other_low").alias("low"), F.col("other_high").alias("high"))).distinct()
        per_doc = asked.groupBy("doc_id").agg(F.collect_list(F.struct("low", "high")).alias("asked"))
        cut = written(docs.join(per_doc, "doc_id").mapInArrow(_cut, "doc_id long, low int, high int, words binary"), "blocks")
        other = cut.select(F.col("doc_id").alias("other"), F.col("low").alias("other_low"), F.col("high").alias("other_high"), F.col("words").alias("other_words"))
        met = flat.join(cut, ["doc_id", "low", "high"]).join(other, ["other", "other_low", "other_high"])
        out = written(met.select("doc_id", "other", "places", "other_places", "low", "other_low", "words", "other_words").mapInArrow(_aligned, _PASSAGE_SQL), "passages")
        removed(flat, cut)
        return out

    # chains apart from one another first: most others lie within the passages they give
    found = align(chained.select("doc_id", F.col("first").alias("chains")))
    spans = found.groupBy("doc_id").agg(F.collect_list(F.struct("start_word", "end_word")).alias("spans"))
    left = chained.filter(F.size("rest") > 0).select("doc_id", "rest").join(spans, "doc_id", "left").select("doc_id", "rest", "spans")
    left = written(left.mapInArrow(_uncovered, f"doc_id long, chains array<{_CHAIN_SQL}>"), "left-chains")
    found = found if left.isEmpty() else found.unionByName(align(left))
    # a run of MIN_WORDS words is a seed of its own: whoever holds its parts, its first holder is met
    long = docs.join(chained.filter(F.size("ranges") > 0).select("doc_id", "ranges"), "doc_id").select("doc_id", "text", "ranges")
    runs = documents(paired(long.mapInArrow(_seeded(buckets, ranged=True), _PACKED)), _runs, f"doc_id long, runs array<{_RUN_SQL}>")
    runs = written(runs.filter(F.size("runs") > 0), "runs")
    removed(left, chained)
    spans = found.groupBy("doc_id").agg(F.collect_list(F.struct("start_word", "end_word")).alias("spans"))
    return found.unionByName(runs.join(spans, "doc_id", "left").mapInArrow(_exact, _PASSAGE_SQL))


def without_passages(docs: DataFrame, row_id: Column | None = None) -> DataFrame:
    """docs less the passages an earlier document holds; n_chars, where there is one, counts what is left.

    row_id: a number that tells the rows of one doc_id apart, below all ids. Rows that share a doc_id go by it, before all others;
    without it they are one document.
    """
    named = docs.withColumn("id ", F.col("doc_id").cast("long"))
    if row_id is not None:
        shared = written(docs.groupBy("doc_id").count().filter("count > 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("shared ")), "shared-ids")
        named = named.withColumn("row ", row_id).join(shared, F.col("doc_id") == F.col("shared "), "left")
        named = named.withColumn("id ", F.when(F.col("shared ").isNull(), F.col("id ")).otherwise(F.col("row "))).drop("row ", "shared ")
    found = written(passages(named.select(F.col("id ").alias("doc_id"), "text")), "passages").groupBy(F.col("doc_id").alias("id ")).agg(F.collect_list(F.struct("start_word", "end_word")).alias("spans_"))
    joined = named.join(found, "id ", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text"):
                data, offsets = text_bytes(column(rows, "text"))
                starts, ends, first = word_spans(data, offsets)
                spans = column(rows, "spans_").to_pylist()
                texts = column(rows, "text").to_pylist()
                for r, some in enumerate(spans):
                    if not some or texts[r] is None:
                        continue
                    gone = np.zeros(len(data[offsets[r] : offsets[r + 1]]), bool)
                    mine = slice(first[r], first[r + 1])
                    s, e = starts[mine] - offsets[r], ends[mine] - offsets[r]
                    for x in some:
                        low, high = x["start_word"], min(x["end_word"], len(s))
                        if low < high:
                            gone[s[low] : s[high] if high < len(s) else len(gone)] = True
                    texts[r] = data[offsets[r] : offsets[r + 1]][~gone].tobytes().decode()
                at = rows.schema.get_field_index("text")
                new = rows.set_column(at, "text", pa.array(texts, rows.schema.field(at).type))
                yield new.drop_columns(["spans_"]) if hasattr(new, "drop_columns") else new.select([n for n in new.schema.names if n != "spans_"])

    out = joined.select(*docs.columns, "spans_").mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def op4_chained_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages(table(spark, sf_dir, "documents"))
