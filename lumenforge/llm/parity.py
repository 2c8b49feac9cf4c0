"""Operator 5: exact n-gram Jaccard join by parity sketches.

A document is its set of k-word shingles. Two sets of sizes a and b reach the similarity num/den only if their symmetric
difference is at most (den - num) * (a + b) / (den + num). Each shingle flips one bit of a parity sketch: the Hamming distance of two
sketches is at most the symmetric difference, since equal shingles cancel. A sketch has about BITS_PER_DIFFERENCE bits for each
shingle that may differ, a power of two; of two sketches the longer is folded to the shorter.

Candidates: sizes fall into bands so narrow that the larger of two linked sets is in the smaller one's band or the next. In a band whose
sets differ in at most d shingles, shingles are dealt to more than d segments by hash, and a segment's parity sketch, held as the
exclusive or of its shingles' words, is a token. At most d tokens differ, so under any order that all sets share, the first token that
two linked sets have in common is among the first d + 1 of either: those are a set's keys. Tokens come in the order of how
common they are, the rarest first, so lines and passages that many texts share make few keys. How common is told by a summary of
bounded size over all texts; the order is right whatever it says.

A key's sets are linked to the least of them, first among those a worker holds, then over all, which keeps the pairs in proportion to the rows
however many sets share a key. Pairs within the Hamming distance are verified on whole shingle sets. Keys whose sets are then in
more than one component are compared block by block inside tasks, which hand on only pairs of different components that are within the
distance, and these are verified too: no link is lost. Keys of the same sets are compared once; while a key has more than CROWD sets
left, they first meet another of them, round after round. Equal sets are one class from the start. Tables are deleted when their last
reader is done.

Texts without words have no shingles and are linked with nothing; texts of fewer than k words have their whole sequence as one shingle. Rows with a null doc_id
have a null component_id; rows that share a doc_id get the component of each one's set. Empty tables give no rows; other columns are ignored.
Shingles and sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenforge.llm.components import components
from lumenforge.llm.shared import input_partitions, removed, table, written
from lumenforge.llm.text import column, gathered, mix, shingles, slices, tallied, word_hashes

BITS_PER_DIFFERENCE = 8
#: Segments for each one that must be a key.
SPREAD = 1.5
#: Common tokens that HELD tokens hand on, those met so often among them at least, and those that all tasks get to know.
BATCH_COMMON, LEAST_COMMON, COMMON = 4_096, 4, 1 << 17
#: Keys, and tokens, that a worker puts in order at once.
HELD = 1 << 19
#: Sets of one key that are compared with each other in one task.
BLOCK = 1_024
#: A key with more sets in different components meets another of them first, at most so many times.
CROWD, TURNS = 4 * BLOCK, 4
#: Bytes of sketches in a task that compares.
TASK_BYTES = 8 << 20


def bands(largest: int, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """(first size of each band, most shingles that two linked sets of sizes up to the band's last can differ in)."""
    low = [1]
    while low[-1] <= largest:
        low.append(max(low[-1] + 1, (low[-1] - 1) * den // num + 1))
    low = np.array([*low, max(low[-1] + 1, (low[-1] - 1) * den // num + 1)])
    return low[:-1], 2 * (low[1:] - 1) * (den - num) // (den + num)


def class_ids(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each set; 0 for an empty one."""
    n = np.diff(offsets)
    one, two = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
    full = n > 0
    if full.any():
        one[full] = np.add.reduceat(mix(values), offsets[:-1][full])
        two[full] = np.bitwise_xor.reduceat(mix(values + np.uint64(0x9E3779B97F4A7C15)), offsets[:-1][full])
    return np.where(full, mix(one ^ (two * np.uint64(0xD1342543DE82EF95) + n.astype(np.uint64))), np.uint64(0)).astype(np.int64)


def sketches(values: np.ndarray, offsets: np.ndarray, num: int, den: int) -> list[bytes]:
    """Parity sketches by row: each shingle flips one bit."""
    n = np.diff(offsets)
    differ = 2 * n * (den - num) // (den + num)
    bits = np.int64(1) << np.ceil(np.log2(np.maximum(BITS_PER_DIFFERENCE * differ, 128))).astype(np.int64)
    base = np.concatenate([[0], np.cumsum(bits)])
    rows = np.repeat(np.arange(len(n)), n)
    h = mix(values ^ np.uint64(0xA0761D6478BD642F)).astype(np.int64)
    flips = np.bincount(base[rows] + (h & (bits[rows] - 1)), minlength=base[-1])
    packed = np.packbits((flips & 1).astype(np.uint8), bitorder="little")
    return [packed[a:b].tobytes() for a, b in zip(base[:-1] // 8, base[1:] // 8, strict=True)]


def folded(sketch: np.ndarray, words: int) -> np.ndarray:
    """Rows of 64-bit words as the sketches of fewer words that the same shingles give."""
    while sketch.shape[1] > words:
        half = sketch.shape[1] // 2
        sketch = sketch[:, :half] ^ sketch[:, half:]
    return sketch


def _limit(total: np.ndarray, num: int, den: int) -> np.ndarray:
    """Most shingles that two linked sets of that many shingles together can differ in."""
    return total * (den - num) // (den + num)


def segment_tokens(values: np.ndarray, offsets: np.ndarray, num: int, den: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, token, its shingles, most tokens of the row that may differ) for the sets' own bands, then the same for the next."""
    n = np.diff(offsets)
    low, differ = bands(int(n.max(initial=0)) + 1, num, den)
    for ahead in (0, 1):
        band = np.searchsorted(low, np.maximum(n, 1), "right") - 1 + ahead
        d = differ[np.minimum(band, len(differ) - 1)]
        live = np.flatnonzero((n > 0) & (d > 0))  # where nothing may differ, equal sets are one class already
        if not len(live):
            continue
        segments = np.zeros(len(n), np.int64)
        segments[live] = np.maximum(d[live] + 1, (SPREAD * (d[live] + 1)).astype(np.int64))
        base = np.cumsum(segments) - segments
        rows = np.repeat(np.arange(len(n)), n)
        used = segments[rows] > 0
        rows, h = rows[used], mix(values[used] + np.uint64(0x5851F42D4C957F2D))
        at = base[rows] + ((h >> np.uint64(20)) % segments[rows].astype(np.uint64)).astype(np.int64)
        total = int(segments.sum())
        weight = np.bincount(at, minlength=total)
        word = np.zeros(total, np.uint64)
        np.bitwise_xor.at(word, at, h)
        owner = np.repeat(np.arange(len(n)), segments)
        place = np.arange(total) - base[owner]
        yield owner, mix(word + mix((band[owner].astype(np.uint64) << np.uint64(40)) + (place.astype(np.uint64) << np.uint64(16)) + weight.astype(np.uint64))), weight, d[owner]


class Common:
    """How often the most common tokens were met; others count 0."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        order = np.argsort(tokens)
        self.tokens, self.counts = tokens[order], counts[order]

    def __call__(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.tokens):
            return np.zeros(len(tokens), np.int64)
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        return np.where(self.tokens[at] == tokens, self.counts[at], 0)


def segment_keys(values: np.ndarray, offsets: np.ndarray, num: int, den: int, common: Common) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of each set's keys, in its own band and the next."""
    out_rows, out_keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for owner, token, weight, differ in segment_tokens(values, offsets, num, den):
        # the rarest, then the heaviest, then by the token itself: an order that all sets share
        order = np.lexsort((token, -weight, common(token), owner))
        nth = np.arange(len(order)) - np.searchsorted(owner, owner[order])  # owners come in order
        chosen = order[nth <= differ[order]]
        out_rows.append(owner[chosen])
        out_keys.append(token[chosen])
    return np.concatenate(out_rows), np.concatenate(out_keys)


def _fresh(ids: np.ndarray) -> np.ndarray:
    """True for the first row of each class."""
    out = np.zeros(len(ids), bool)
    out[np.unique(ids, return_index=True)[1]] = True
    return out


def _sets(k: int, num: int, den: int, kept: list[str]):
    """A row a document: kept columns, size, class and sketch; and rows with the tokens most common among the HELD last."""
    names = [*kept, "n", "class", "sketch", "common", "counts"]

    def often_met(met: list[np.ndarray], batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        tokens, counts = tallied(np.concatenate([np.zeros(0, np.uint64), *met]))
        often = np.flatnonzero(counts >= LEAST_COMMON)
        often = often[np.argsort(-counts[often], kind="stable")[:BATCH_COMMON]]
        if len(often):
            nulls = [pa.nulls(1, column(batch, c).type) for c in kept]
            yield pa.RecordBatch.from_arrays([*nulls, pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([tokens[often].tobytes()], pa.binary()), pa.array([counts[often].astype(np.int64).tobytes()], pa.binary())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: list[np.ndarray] = []
        batch = None
        for batch in batches:
            for rows in slices(batch, "text"):
                values, offsets = shingles(*word_hashes(column(rows, "text")), k)
                ids = class_ids(values, offsets)
                fresh = _fresh(ids)
                met += [token[fresh[owner]] for owner, token, _, _ in segment_tokens(values, offsets, num, den)]
                nothing = pa.nulls(rows.num_rows, pa.binary())
                yield pa.RecordBatch.from_arrays([*(column(rows, c) for c in kept), pa.array(np.diff(offsets)), pa.array(ids), pa.array(sketches(values, offsets, num, den), pa.binary()), nothing, nothing], names)
                if sum(map(len, met)) >= HELD:
                    yield from often_met(met, batch)
                    met = []
        if batch is not None:
            yield from often_met(met, batch)

    return run


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in zip(batch.column(0), batch.column(1), strict=True):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(a.as_buffer(), np.int64)), pa.array(np.frombuffer(b.as_buffer(), np.int64))], ["token", "count"])


def runs(keys: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (key, class) in order, and the least class of each one's key."""
    order = np.lexsort((classes, keys))
    keys, classes = keys[order], classes[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (classes[1:] != classes[:-1])
    keys, classes = keys[new], classes[new]
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    return keys, classes, classes[np.flatnonzero(first)][np.cumsum(first) - 1] if len(keys) else classes


_STARS = ["bucket", "keys", "classes", "hubs"]


def _keyed(k: int, num: int, den: int, buckets: int, shared):
    """Among HELD keys, links of each key's sets to the least (bucket -1); and the least of each key, packed by hash bucket."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            for rows in slices(batch, "text"):
                values, offsets = shingles(*word_hashes(column(rows, "text")), k)
                ids = class_ids(values, offsets)
                owner, keys = segment_keys(values, offsets, num, den, shared.value)
                fresh = _fresh(ids)[owner]
                yield keys[fresh], ids[owner[fresh]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in gathered(keyed(batches), HELD):
            keys, classes, hubs = runs(*some)
            linked = classes != hubs
            if linked.any():
                yield _star(-1, keys[linked], classes[linked], hubs[linked])
            keys, hubs = keys[~linked], hubs[~linked]
            where = ((keys >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(where, kind="stable")
            cuts = np.searchsorted(where[order], np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(cuts)):
                part = order[cuts[b] : cuts[b + 1]]
                yield _star(int(b), keys[part], hubs[part], hubs[:0])

    return run


def _star(bucket: int, keys: np.ndarray, classes: np.ndarray, hubs: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in (keys, classes, hubs))], _STARS)


def _stars(rows: pa.Table) -> pa.Table:
    """Links of one bucket's keys: key, class, hub (the least class of the key)."""
    load = lambda name, kind: np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in rows[name]])
    if rows["bucket"][0].as_py() < 0:
        keys, classes, hubs = load("keys", np.uint64), load("classes", np.int64), load("hubs", np.int64)
    else:
        keys, classes, hubs = runs(load("keys", np.uint64), load("classes", np.int64))
        linked = classes != hubs
        keys, classes, hubs = keys[linked], classes[linked], hubs[linked]
    return pa.table({"key": keys.astype(np.int64), "class": classes, "hub": hubs})


def _matrix(sketch: pa.Array) -> np.ndarray:
    """Sketches of one length as rows of 64-bit words."""
    return np.frombuffer(b"".join(x.as_buffer() for x in sketch), np.uint64).reshape(len(sketch), -1)


def _near(num: int, den: int):
    """Of pairs (class, hub, n, m, sketch, other), those whose sketches and sizes allow the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = column(batch, "n").to_numpy(), column(batch, "m").to_numpy()
            one, two = column(batch, "sketch"), column(batch, "other")
            sizes = np.stack([np.diff(np.frombuffer(x.buffers()[1], np.int32)[x.offset : x.offset + len(x) + 1]) // 8 for x in (one, two)], axis=1)
            apart = np.abs(n - m)
            for a, b in np.unique(sizes, axis=0):
                at = np.flatnonzero((sizes == (a, b)).all(axis=1))
                x, y = (folded(_matrix(s.take(pa.array(at))), min(a, b)) for s in (one, two))
                apart[at] = np.maximum(apart[at], np.bitwise_count(x ^ y).sum(axis=1))
            good = apart <= _limit(n + m, num, den)
            yield pa.RecordBatch.from_arrays([column(batch, "class"), column(batch, "hub")], ["class", "hub"]).filter(pa.array(good))

    return run


def _compared(num: int, den: int):
    """Pairs of different components that are near, of the sets of each key's two blocks i and j (one block if they are the same)."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("key", "ascending"), ("i", "ascending"), ("j", "ascending"), ("class", "ascending")])
        key, i, j, block, ids, component, n = (rows[c].to_numpy() for c in ("key", "i", "j", "block", "class", "component", "n"))
        sketch = rows["sketch"].combine_chunks()
        cuts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]), [True]]))
        found = [np.zeros((0, 2), np.int64)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            mine = sketch.slice(a, b - a)
            sizes = np.diff(np.frombuffer(mine.buffers()[1], np.int32)[mine.offset : mine.offset + len(mine) + 1]) // 8
            words = np.empty((b - a, sizes.min()), np.uint64)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                words[at] = folded(_matrix(mine.take(pa.array(at))), sizes.min())
            first = np.flatnonzero(block[a:b] == i[a])
            second = np.flatnonzero(block[a:b] == j[a])
            for x in first:
                y = second[second > x] if i[a] == j[a] else second
                y = y[component[a + y] != component[a + x]]
                close = np.maximum(np.bitwise_count(words[y] ^ words[x]).sum(axis=1), np.abs(n[a + y] - n[a + x])) <= _limit(n[a + y] + n[a + x], num, den)
                if close.any():
                    other = ids[a + y[close]]
                    found.append(np.stack([np.maximum(ids[a + x], other), np.minimum(ids[a + x], other)], axis=1))
        pairs = np.unique(np.concatenate(found), axis=0)
        return pa.table({"class": pairs[:, 0], "hub": pairs[:, 1]})

    return run


def _class_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text"):
                values, offsets = shingles(*word_hashes(column(rows, "text")), k)
                own = class_ids(values, offsets) == column(rows, "class").to_numpy()
                sets = pa.array([values[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([column(rows, "class"), sets], ["class", "set"]).filter(pa.array(own))

    return run


def _verified(num: int, den: int):
    """Of pairs (class, hub, set, other) those that reach the similarity, counted on whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = batch.column(2), batch.column(3)
            good = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = np.frombuffer(one[i].as_buffer(), np.uint64), np.frombuffer(two[i].as_buffer(), np.uint64)
                both = np.sort(np.concatenate([x, y]), kind="stable")
                same = int((both[1:] == both[:-1]).sum())
                good[i] = den * same >= num * (len(both) - same)
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(good))

    return run


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links of similarity >= num/den) of docs (doc_id, text),
    with the columns of `keep`."""
    renamed = {c: f"kept_{i}" for i, c in enumerate(keep)}
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *(F.col(c).alias(r) for c, r in renamed.items()), "text")
    spark, kept = docs.sparkSession, [c for c in docs.columns if c != "text"]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    every = written(docs.mapInArrow(_sets(k, num, den, kept), f"{kinds}, n long, class long, sketch binary, common binary, counts binary"), "sets")
    sets = every.filter("n IS NOT NULL")
    common = every.filter("common IS NOT NULL").select("common", "counts").mapInArrow(_unpacked, "token long, count long").groupBy("token").agg(F.sum("count").alias("count"))
    common = common.orderBy(F.desc("count"), "token").limit(COMMON).toPandas()
    shared = spark.sparkContext.broadcast(Common(common["token"].to_numpy(np.int64).view(np.uint64), common["count"].to_numpy(np.int64)))
    buckets = max(16, 4 * input_partitions(docs))
    packed = docs.select("text").mapInArrow(_keyed(k, num, den, buckets, shared), "bucket int, keys binary, classes binary, hubs binary")
    # bucket -1 (links made within batches) is spread by its first key
    spread = F.when(F.col("bucket") < 0, -1 - F.pmod(F.xxhash64("keys"), F.lit(buckets))).otherwise(F.col("bucket")).cast("int")
    stars = written(packed.withColumn("bucket", spread).groupBy("bucket").applyInArrow(_stars, "key long, class long, hub long"), "stars")
    # the classes that share a key with another
    involved = stars.select("class").unionByName(stars.select(F.col("hub").alias("class"))).distinct()
    own = sets.filter("n > 0").join(involved, "class", "left_semi").groupBy("class").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    own = written(own.filter("rep IS NOT NULL"), "classes")

    def near(pairs: DataFrame) -> DataFrame:
        other = own.select(F.col("class").alias("hub"), F.col("n").alias("m"), F.col("sketch").alias("other"))
        both = pairs.join(own.drop("rep"), "class").join(other, "hub").select("class", "hub", "n", "m", "sketch", "other")
        return written(both.mapInArrow(_near(num, den), "class long, hub long"), "pairs")

    def linked(pairs: DataFrame) -> DataFrame:
        """a, b: the linked classes among pairs (a written table)."""
        needed = pairs.select("class").unionByName(pairs.select(F.col("hub").alias("class"))).distinct().join(own.select("class", F.col("rep").alias("doc_id")), "class")
        needed = written(needed, "needed")
        # rows that share a doc_id may hold other texts: the class is checked again
        texts = written(docs.select("doc_id", "text").join(needed, "doc_id").mapInArrow(_class_sets(k), "class long, set binary").dropDuplicates(["class"]), "shingle-sets")
        both = pairs.join(texts, "class").join(texts.select(F.col("class").alias("hub"), F.col("set").alias("other")), "hub").select("class", "hub", "set", "other")
        out = written(both.mapInArrow(_verified(num, den), "a long, b long"), "links")
        removed(needed, texts)
        return out

    def unsettled(placed: DataFrame) -> DataFrame:
        """Members of keys whose sets are in more than one component; of keys with the same sets, one. `size` is how many there are."""
        marks = [F.bit_xor(F.xxhash64("class", F.lit(s))).alias(f"x{s}") for s in (1, 2)]
        keys = placed.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most"), F.count("*").alias("size"), *marks).filter("least <> most")
        keys = keys.groupBy("size", "x1", "x2").agg(F.min("key").alias("key")).select("key", "size")
        return written(placed.join(keys, "key"), "unsettled")

    pairs = near(stars.select(F.greatest("class", "hub").alias("class"), F.least("class", "hub").alias("hub")).distinct())
    links = linked(pairs)
    steps = [components(links)]
    removed(pairs, links)
    members = stars.select("key", "class").unionByName(stars.select("key", F.col("hub").alias("class"))).distinct()
    left = unsettled(_renamed(members.join(own.select("class"), "class").withColumn("component", F.col("class")), steps[0]))
    removed(stars)

    def joined(pairs: DataFrame) -> DataFrame | None:
        """What links among pairs join of the components so far; None without a link."""
        if pairs.isEmpty():
            return None
        links = linked(pairs)
        of = left.select("class", "component").distinct()
        named = links.join(of.select(F.col("class").alias("a"), F.col("component").alias("ca")), "a").join(of.select(F.col("class").alias("b"), F.col("component").alias("cb")), "b")
        out = components(named.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
        removed(links)
        return out

    for turn in range(TURNS):
        if (left.agg(F.max("size")).first()[0] or 0) <= CROWD:
            break
        # each key's sets against one of them, another for each key and turn: large groups grow together
        hubs = left.groupBy("key").agg(F.min_by(F.struct(F.col("class").alias("hub"), F.col("component").alias("c2")), F.xxhash64("key", "class", F.lit(turn))).alias("h")).select("key", "h.*")
        met = left.join(hubs, "key").filter(F.col("component") != F.col("c2"))
        pairs = near(met.select(F.greatest("class", "hub").alias("class"), F.least("class", "hub").alias("hub")).distinct())
        step = joined(pairs)
        removed(pairs)
        if step is not None:
            steps.append(step)
            last, left = left, unsettled(_renamed(left.drop("size"), step))
            removed(last)
    parts = F.ceil(F.col("size") / BLOCK).cast("int")
    blocks = left.withColumn("block", F.pmod(F.xxhash64("class"), parts).cast("int")).withColumn("with", F.explode(F.sequence(F.lit(0), parts - 1)))
    blocks = blocks.select("key", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "class", "component")
    met = blocks.join(own.select("class", "n", "sketch"), "class")
    size = met.agg(F.coalesce(F.sum(F.octet_length("sketch") + 64), F.lit(0))).first()[0]
    dealt = met.withColumn("task", F.pmod(F.xxhash64("key", "i", "j"), F.lit(max(1, -(-size // TASK_BYTES)))))
    pairs = written(dealt.groupBy("task").applyInArrow(_compared(num, den), "class long, hub long").distinct(), "pairs")
    step = joined(pairs)
    # a component is a class until all links are known; then its smallest doc_id
    placed = own.select("class", "rep", F.col("class").alias("component"))
    for found in [*steps, *([] if step is None else [step])]:
        placed = _renamed(placed, found)
    placed = written(placed, "placed")
    names = placed.groupBy("component").agg(F.min("rep").alias("name"), F.count("*").alias("classes")).filter("classes > 1").select("component", "name")
    names = written(placed.join(names, "component").select("class", "name"), "names")
    removed(pairs, left, own, placed)
    reps = sets.filter("n > 0").groupBy("class").agg(F.min("doc_id").alias("rep")).join(names, "class", "left")
    out = sets.join(reps, "class", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("name", "rep", "doc_id"))
    return out.select("doc_id", *(F.col(r).alias(c) for c, r in renamed.items()), F.col("n").alias("n_shingles"), component.alias("component_id"))


def _renamed(rows: DataFrame, step: DataFrame) -> DataFrame:
    """rows whose component is a node of step (node, component) in that node's component."""
    names = step.select(F.col("node").alias("component"), F.col("component").alias("renamed"))
    return rows.join(names, "component", "left").withColumn("component", F.coalesce("renamed", "component")).drop("renamed")


def op5_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=3, num=90, den=100)
