"""Operator 2: nearest neighbours by inner product with multiprobe p-stable hashing.

Vectors are scaled by the largest norm and get one more component that makes all of them equally long, so that the largest
inner product is the smallest Euclidean distance. Each table cuts the space by a few p-stable (Gaussian) projections into cells
of one width. A near neighbour is the query scaled by their inner product plus a residual in a random direction, so its projections
are normal about the query's own; from that a query's cells get a probability each, and it visits them in descending order of it,
until those visited sum to `cover` in each table, however many they are; the candidates of all tables are merged and ranked by the
inner product of the original vectors in double precision.

Every table of vectors has at least one cut, and as many more as it takes to part it into cells of CELL_ROWS: they grow with the
logarithm of the rows. Tables, cuts, width and cover are fitted: of the choices that find RECALL of the true
neighbours of FIT_QUERIES queries, told by one pass over all rows, the one that ranks the fewest of a sample of at most FIT_VECTORS vectors;
that share is kept in `Hashes.share`. Only the choice comes from the sample: every row is indexed. Where vectors have no near neighbours to
speak of, as with independent random directions, no cells tell them from the rest and most of the table is ranked.

Rows are placed once, by their cells of the first table, whatever the tables: each row names its cells. Queries are dealt to segments
of SEGMENT_BYTES, with lists of those of their cells that exist (a bit filter tells) or, where they visit much of the table, with the
probability of the last cell that they visit, from which a task tells the others. Lists are never written. Tasks hold a segment, read
their share of the rows and keep each query's k best, so that what they hand on is k rows for a query and task, and the disk used
grows with the rows.
Neither a crowded cell nor a third of all rows being one vector meets in one task, no pairs are emitted, and no candidate of a visited
cell is left out. A query that found fewer than k is ranked against all rows in a second round. The work itself, queries times the rows
of their cells, grows with the square of a table where cells leave out nothing.

Vectors that are null, zero, of another length than most, or that hold a null or non-finite component take no part; nor do
rows without an id. Rows that share an id count as one, by their best score. Empty tables give no rows. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumenforge.llm.shared import removed, table, written
from lumenforge.llm.text import mix
from lumenforge.sources.staging import at_once

UNIT_ROWS = 2_000
#: Bytes of a part of the placed rows, of the queries with their cells that all tasks hold at once, and most bits of the filter of cells.
PART_BYTES, SEGMENT_BYTES, MOST_BITS = 32 << 20, 16 << 20, 1 << 26
#: Most tasks that rank the rows for one segment of the queries: each hands on k rows a query. Where there are more cores, segments run side by side.
TASKS = 32
#: Rows ranked at once, scores held at once, and the share of the table ranked below which queries hold lists of their cells.
ROWS, SCORES, LISTED = 4_096, 1 << 21, 0.15
#: The fit: share of neighbours to find, and what is chosen from: widths, each with the most cuts that leave a query's cover to some thousand cells.
RECALL = 0.96
FIT_QUERIES, FIT_VECTORS = 60, 10_000
WIDTHS = {2.0: 6, 3.0: 16, 4.5: 64}
TABLES = (1, 2, 3)
COVERS = (0.4, 0.55, 0.7, 0.8, 0.9, 0.95, 0.98)
#: Rows of a cell that more cuts would part to no use.
CELL_ROWS = 32
#: Queries whose cells are put in order at once.
ORDERED = 16


def clean(rows: DataFrame) -> DataFrame:
    """vec_id long, vec array<double>: the rows that take part."""
    v = F.col("vec")
    fine = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec")).filter(F.col("vec_id").isNotNull() & v.isNotNull())
    fine = fine.filter(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0))
    most = fine.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return fine.filter(F.size("vec") == (most[0]["n"] if most else 0))


def _matrix(array: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    return array.flatten().to_numpy(zero_copy_only=False).reshape(len(array), -1)


def _phi(x: np.ndarray) -> np.ndarray:
    """The normal distribution function, by a rational approximation good to 1e-7."""
    t = 1 / (1 + 0.3275911 * np.abs(x) / np.sqrt(2))
    tail = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) * np.exp(-x * x / 2)
    return np.where(x >= 0, 1 - tail / 2, tail / 2)


class Hashes:
    """Tables of p-stable projections. `near` is the inner product of a query and a neighbour, both of length 1."""

    def __init__(self, dim: int, cuts: int, norm: float, near: float, width: float = 3.0, tables: int = 2, cover: float = 0.85, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.norm, self.near, self.spread, self.cover, self.share = norm, near, float(np.sqrt(1 - near * near)), cover, 1.0
        self.width = width * self.spread
        # table by table, so that fewer tables are the first of more
        drawn = [(rng.standard_normal((cuts, dim + 1)), rng.uniform(0, self.width, cuts)) for _ in range(tables)]
        self.cuts, self.shift = np.stack([c for c, _ in drawn]), np.stack([s for _, s in drawn])
        # cells on either side of a neighbour's likeliest one: three spreads and more
        self.steps = np.arange(-1, 2) if width >= 3 else np.arange(-2, 3)

    def project(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        """Places in units of the width, by table, row and projection; a query's are those expected of a neighbour."""
        x = vectors / self.norm
        if query:
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
        extra = np.zeros(len(x)) if query else np.sqrt(np.clip(1 - (x * x).sum(axis=1), 0, None))
        x = np.column_stack([x, extra]) * (self.near if query else 1)
        return np.stack([(x @ c.T + s) / self.width for c, s in zip(self.cuts, self.shift, strict=True)])

    def cell_ids(self, table: int, cells: np.ndarray) -> np.ndarray:
        """int64 ids of rows of cell numbers."""
        h = np.full(cells.shape[:-1], table + 1, np.uint64)
        for k in range(cells.shape[-1]):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + cells[..., k].astype(np.int64).astype(np.uint64))
        return h.astype(np.int64)

    def homes(self, vectors: np.ndarray) -> np.ndarray:
        """Each vector's cell, by table."""
        places = np.floor(self.project(vectors, False)).astype(np.int64)
        return np.stack([self.cell_ids(t, p) for t, p in enumerate(places)])

    def visits(self, vectors: np.ndarray) -> list[np.ndarray]:
        """For each query its cells' ids over all tables, the likeliest first, as far as they sum to `cover`."""
        return [np.concatenate([ids[: _first_over(sums, self.cover)] for ids, sums in tables]) for tables in self.ordered(vectors)]

    def ordered(self, vectors: np.ndarray) -> Iterator[list[tuple[np.ndarray, np.ndarray]]]:
        """For each query and table its cells' ids, the likeliest first, and the sums of their probabilities, up to `cover`."""
        for low in range(0, len(vectors), ORDERED):
            yield from self._ordered(vectors[low : low + ORDERED])

    def _ordered(self, vectors: np.ndarray) -> list[list[tuple[np.ndarray, np.ndarray]]]:
        out: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in vectors]
        for t, (home, chance) in enumerate(self.chances(vectors)):
            for q, (prob, cells) in enumerate(likeliest(chance, self.cover)):
                out[q].append((self.cell_ids(t, self.steps[cells] + home[q]), np.cumsum(prob)))
        return out

    def chances(self, vectors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """By table the queries' own cells and, by query, projection and step, the probability of a neighbour there."""
        out, scale = [], self.width / self.spread
        for places in self.project(vectors, True):
            home = np.floor(places)
            low = (self.steps[None, None, :] - (places - home)[:, :, None]) * scale
            out.append((home.astype(np.int64), _phi(low + scale) - _phi(low)))
        return out

    def least(self, vectors: np.ndarray) -> np.ndarray:
        """By query and table the probability of the last cell that the query visits."""
        parts = [np.stack([[prob[-1] for prob, _ in likeliest(chance, self.cover)] for _, chance in self.chances(vectors[low : low + ORDERED])], axis=1) for low in range(0, len(vectors), ORDERED)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.cuts)))


def likeliest(chance: np.ndarray, cover: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query (probability, step numbers) of its likeliest cells in descending order, as many as sum to `cover` or to all there is.

    chance: probabilities by query, projection and step. All cells above a floor are listed, leaving out each start of a cell
    that cannot reach it; where they don't suffice, the floor is lowered."""
    best = np.ones((chance.shape[0], chance.shape[1] + 1))
    best[:, :-1] = np.cumprod(chance.max(axis=2)[:, ::-1], axis=1)[:, ::-1]
    goal = np.minimum(cover, chance.sum(axis=2).prod(axis=1) * (1 - 1e-9))
    floor = best[:, 0] / 4
    out: list = [None] * len(chance)
    left = np.arange(len(chance))
    while len(left):
        owner, prob, cells = left, np.ones(len(left)), np.zeros((len(left), 0), np.int8)
        for k in range(chance.shape[1]):
            grown = prob[:, None] * chance[owner, k]
            at, step = np.nonzero(grown * best[owner, k + 1, None] >= floor[owner, None])
            owner, prob, cells = owner[at], grown[at, step], np.column_stack([cells[at], step.astype(np.int8)])
        short = np.bincount(owner, prob, len(chance)) < goal
        for q in left[~short[left]]:
            mine = np.flatnonzero(owner == q)
            order = mine[np.argsort(-prob[mine], kind="stable")]
            order = order[: _first_over(np.cumsum(prob[order]), goal[q])]
            out[q] = prob[order], cells[order]
        left = left[short[left]]
        floor[left] /= 4
    return out


def _first_over(sums: np.ndarray, cover: float) -> int:
    """How many cells it takes to reach the cover; all there are, if they don't."""
    return min(len(sums), int(np.searchsorted(sums, cover)) + 1)


def tried(hashes: Hashes, rows: np.ndarray, queries: np.ndarray, near: list[np.ndarray]) -> dict[tuple[int, float], tuple[float, float]]:
    """By number of tables and cover: (share found of the queries' neighbours `near`, rows ranked as a share of `rows`, whose first are the queries)."""
    ends = len(rows) + np.cumsum([0, *(len(x) for x in near)])
    homes = [np.unique(h, return_inverse=True) for h in hashes.homes(np.concatenate([rows, *near]))]
    hits: dict[tuple[int, float], list[float]] = {(t, c): [0, 0] for t in range(1, len(homes) + 1) for c in COVERS}
    for mine, tables in enumerate(hashes.ordered(queries)):
        met = {c: np.zeros(len(near[mine]), bool) for c in COVERS}
        ranked = dict.fromkeys(COVERS, 0)
        for t, ((ids, sums), (known, which)) in enumerate(zip(tables, homes, strict=True)):
            by = np.argsort(ids)
            at = np.minimum(np.searchsorted(ids[by], known), len(ids) - 1)
            nth = np.where(ids[by][at] == known, by[at], len(ids))[which]
            for c in COVERS:
                seen = nth < _first_over(sums, c)
                met[c] |= seen[ends[mine] : ends[mine + 1]]
                ranked[c] += int(seen[: len(rows)].sum()) - int(seen[mine])
                hits[t + 1, c][0] += int(met[c].sum())
                hits[t + 1, c][1] += ranked[c]
    return {key: (found / max(1, ends[-1] - len(rows)), ranked / max(1, len(queries) * len(rows))) for key, (found, ranked) in hits.items()}


def choose(x: np.ndarray, n: int, near: list[np.ndarray], norm: float) -> Hashes:
    """Hashes for a table of n ids, of which x is a sample that starts with the queries whose neighbours are `near`."""
    q = x[: len(near)]
    unit = q / np.linalg.norm(q, axis=1, keepdims=True)
    scores = np.concatenate([v @ u for v, u in zip(near, unit, strict=True)]) / norm
    middle = float(np.clip(np.median(scores), 0.05, 0.9999)) if len(scores) else 0.5
    most = int(max(1, np.log2(max(2, n / CELL_ROWS))))
    best, dim = None, x.shape[1]
    for cuts in sorted({1, *range(2, min(most, 8), 2), *range(8, most, 4), most}):
        for width, bound in WIDTHS.items():
            if cuts > bound:
                continue
            for (tables, cover), (recall, share) in tried(Hashes(dim, cuts, norm, middle, width, max(TABLES), max(COVERS)), x, q, near).items():
                rank = (min(recall, RECALL), -share)
                if best is None or rank > best[0]:
                    best = (rank, share, (cuts, norm, middle, width, tables, cover))
    out = Hashes(dim, *best[2])
    out.share = best[1]
    return out


def _nearest(queries: np.ndarray, own: np.ndarray, k: int):
    """Each query's k nearest ids among a task's rows, with a vector of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [(np.zeros(0, np.int64), np.zeros(0), np.zeros((0, queries.shape[1])))] * len(queries)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, x = batch.column(0).to_numpy(), _matrix(batch.column(1))
            for q, scores in enumerate(queries @ x.T):
                held = kept[q]
                if len(held[0]) == k:  # what may still be among the best
                    some = np.flatnonzero((scores >= held[1][-1]) & (ids != own[q]))
                else:
                    some = np.flatnonzero(ids != own[q])
                if not len(some):
                    continue
                v, s, m = (np.concatenate(pair) for pair in zip(held, (ids[some], scores[some], x[some]), strict=True))
                order = np.lexsort((v, -s))
                order = order[np.sort(np.unique(v[order], return_index=True)[1])][:k]  # an id by its best row
                kept[q] = v[order], s[order], m[order]
        sizes = [len(v) for v, _, _ in kept]
        columns = [np.repeat(np.arange(len(kept), dtype=np.int32), sizes), *(np.concatenate([x[j] for x in kept]) for j in (0, 1))]
        flat = np.concatenate([x[2] for x in kept])
        vec = pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1, dtype=np.int32) * flat.shape[1]), pa.array(flat.ravel()))
        yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns), vec], ["q", "vec_id", "score", "vec"])

    return run


def fit(rows: DataFrame, k: int) -> tuple[Hashes | None, int]:
    """Hashes for rows, and how many rows there are."""
    stats = rows.agg(F.count("*").alias("n"), F.count_distinct("vec_id").alias("ids"), F.max(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))).alias("norm")).first()
    if not stats["n"]:
        return None, 0
    ids = rows.select("vec_id").distinct().orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_VECTORS)
    sample = rows.join(F.broadcast(ids), "vec_id").groupBy("vec_id").agg(F.max("vec").alias("vec")).orderBy(F.xxhash64("vec_id"), "vec_id").select("vec_id", "vec").toArrow()
    x = _matrix(sample["vec"])
    q, own = x[:FIT_QUERIES], sample["vec_id"].to_numpy()[:FIT_QUERIES]
    found = rows.select("vec_id", "vec").mapInArrow(_nearest(q, own, k), "q int, vec_id long, score double, vec array<double>")
    found = found.groupBy("q", "vec_id").agg(F.max_by("vec", "score").alias("vec"), F.max("score").alias("score"))
    first = found.withColumn("nth", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))).filter(F.col("nth") <= k).select("q", "vec").toArrow()
    at, vectors = first["q"].to_numpy(), _matrix(first["vec"]) if first.num_rows else np.zeros((0, x.shape[1]))
    return choose(x, stats["ids"], [vectors[at == j] for j in range(len(q))], stats["norm"]), stats["n"]


def fixed_order(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products row by row, each summed in the same order."""
    out = np.zeros(len(x))
    for j in range(x.shape[1]):
        out += x[:, j] * y[:, j]
    return out


class Asked:
    """Queries that all tasks hold at once: ids, vectors, and which cells they visit: lists in the order of the cells, or for each table
    the least probability of one (`least`); neither: all cells."""

    def __init__(self, rows: pa.Table, hashes: Hashes):
        if not rows.num_rows:
            rows = rows.select(["query_id", "vec"])
        self.ids, self.q, self.hashes = rows["query_id"].to_numpy(), _matrix(rows["vec"]).astype(np.float64) if rows.num_rows else np.zeros((0, hashes.cuts.shape[2] - 1)), hashes
        self.norms, self.cells, self.owner, self.least = np.sqrt((self.q * self.q).sum(axis=1)), None, None, None
        if "least" in rows.column_names:
            self.least = _matrix(rows["least"])
        elif "cells" in rows.column_names:
            visited = rows["cells"].combine_chunks()
            flat, owner = visited.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(self.ids), dtype=np.int32), np.diff(visited.offsets.to_numpy()))
            order = np.argsort(flat, kind="stable")
            self.cells, self.owner = flat[order], owner[order]


class Nearest:
    """The k nearest so far of each query among a task's rows. Only rows that may still be among them get a score of fixed order."""

    def __init__(self, asked: Asked, k: int):
        self.asked, self.k = asked, k
        self.scores, self.ids = np.full((len(asked.ids), k), -np.inf), np.zeros((len(asked.ids), k), np.int64)
        self.chances = asked.hashes.chances(asked.q) if asked.least is not None else []

    def add(self, ids: np.ndarray, x: np.ndarray, homes: np.ndarray) -> None:
        """homes: the rows' cells by table."""
        asked, n = self.asked, len(self.asked.ids)
        if not n:
            return
        norm = float(np.sqrt((x * x).sum(axis=1).max()))
        found, step = [], max(1, SCORES // len(ids))
        if asked.cells is None:
            known = [np.unique(h, return_index=True, return_inverse=True) for h in homes] if self.chances else []
            places = np.floor(asked.hashes.project(x, False)).astype(np.int64) if known else []
            tables = [(p[first], at) for p, (_, first, at) in zip(places, known, strict=True)]
            for low in range(0, n, step):
                who = np.arange(low, min(low + step, n))
                found.append(self._near(who, ids, x, norm, [(self._visited(t, who, cells), at) for t, (cells, at) in enumerate(tables)]))
        else:
            for h in homes:
                cells, at = np.unique(h, return_inverse=True)
                low, high = np.searchsorted(asked.cells, cells), np.searchsorted(asked.cells, cells, "right")
                order = np.argsort(at, kind="stable")
                first = np.searchsorted(at[order], np.arange(len(cells) + 1))
                for c in np.flatnonzero(high > low):
                    rows, asking = order[first[c] : first[c + 1]], asked.owner[low[c] : high[c]]
                    step = max(1, SCORES // len(rows))
                    found += [self._near(asking[m : m + step], ids[rows], x[rows], norm, []) for m in range(0, len(asking), step)]
        if found:
            self._merge(*(np.concatenate(f) for f in zip(*found, strict=True)))

    def _visited(self, t: int, who: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Whether the queries visit cells, given by their places: those as likely as the last one of each query."""
        home, chance = self.chances[t]
        home, chance, prob = home[who], chance[who], np.ones((len(who), len(cells)))
        steps = self.asked.hashes.steps
        for c in range(cells.shape[1]):
            known, at = np.unique(cells[:, c], return_inverse=True)
            off = known[None, :] - home[:, c, None] - steps[0]
            near = (off >= 0) & (off < len(steps))
            prob *= np.where(near, np.take_along_axis(chance[:, c], np.where(near, off, 0), axis=1), 0.0)[:, at]
        # the least may be off in its last places
        return prob >= self.asked.least[who, t, None] * (1 - 1e-9)

    def _near(self, who: np.ndarray, ids: np.ndarray, x: np.ndarray, norm: float, seen: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, id, score) of what may be among a query's best. seen: by table which cells each of `who` visits and each row's cell; none: all."""
        asked = self.asked

        def visited(i, j):
            out = asked.ids[who[i]] != ids[j]
            return out & np.logical_or.reduce([mask[i, at[j]] for mask, at in seen]) if seen else out

        with np.errstate(all="ignore"):
            scores = asked.q[who] @ x.T
            least = self.scores[who, -1].copy()
            short = np.flatnonzero(np.isneginf(least))
            if len(short):  # fewer than k so far: these rows alone may tell what is too far
                mine = np.where(visited(short[:, None], np.arange(len(ids))[None, :]), scores[short], -np.inf)
                scores[short] = mine
                known, at = np.unique(ids, return_inverse=True)
                if len(known) < len(ids):
                    order = np.argsort(at, kind="stable")
                    mine = np.maximum.reduceat(mine[:, order], np.searchsorted(at[order], np.arange(len(known))), axis=1)
                if mine.shape[1] > self.k:
                    least[short] = -np.partition(-mine, self.k - 1, axis=1)[:, self.k - 1]
            # a product of matrices may sum equal vectors in different orders
            least = least - 1e-9 * asked.norms[who] * norm
            least[np.isnan(least)] = -np.inf
            i, j = np.nonzero((scores >= least[:, None]) & ~np.isneginf(scores))
            keep = visited(i, j)
            i, j = i[keep], j[keep]
            exact = np.concatenate([np.zeros(0), *(fixed_order(asked.q[who[i[m : m + 20_000]]], x[j[m : m + 20_000]]) for m in range(0, len(i), 20_000))])
        return who[i], ids[j], exact

    def _merge(self, who: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        some = np.unique(who)
        who, ids, scores = np.concatenate([np.repeat(some, self.k), who]), np.concatenate([self.ids[some].ravel(), ids]), np.concatenate([self.scores[some].ravel(), scores])
        keep = np.isfinite(scores)
        who, ids, scores = who[keep], ids[keep], scores[keep]
        order = np.lexsort((-scores, ids, who))
        who, ids, scores = who[order], ids[order], scores[order]
        # a row may come from more than one table, an id from more than one row
        keep = np.ones(len(who), bool)
        keep[1:] = (who[1:] != who[:-1]) | (ids[1:] != ids[:-1])
        who, ids, scores = who[keep], ids[keep], scores[keep]
        order = np.lexsort((ids, -scores, who))
        who, ids, scores = who[order], ids[order], scores[order]
        nth = np.arange(len(who)) - np.searchsorted(who, who)
        keep = nth < self.k
        self.scores[some] = -np.inf
        self.scores[who[keep], nth[keep]], self.ids[who[keep], nth[keep]] = scores[keep], ids[keep]

    def rows(self) -> pa.RecordBatch:
        i, j = np.nonzero(np.isfinite(self.scores))
        return pa.RecordBatch.from_arrays([pa.array(self.asked.ids[i]), pa.array(self.ids[i, j]), pa.array(self.scores[i, j])], ["query_id", "vec_id", "score"])


def _ranked(shared, k: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = Nearest(shared.value, k)
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                some = batch.slice(low, ROWS)
                near.add(some.column(0).to_numpy(), _matrix(some.column(1 + tables)).astype(np.float64), np.stack([some.column(1 + t).to_numpy() for t in range(tables)]))
        yield near.rows()

    return run


def _known_cells(cells: DataFrame, bits: int) -> np.ndarray:
    """The bits of a filter of a column `cell`, in words."""
    at = F.pmod(F.col("cell"), F.lit(bits))
    words = cells.select(F.floor(at / 64).alias("word"), F.pmod(at, F.lit(64)).cast("int").alias("bit")).groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("held")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[words["word"].to_numpy()] = words["held"].to_numpy().view(np.uint64)
    return out


def search(rows: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """The k nearest of `rows` for each of `queries` (both vec_id, embedding): query_id, rank, vec_id, score."""
    base = clean(rows)
    hashes, n = fit(base, k)
    spark = base.sparkSession
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shared = spark.sparkContext.broadcast(hashes)
    tables, dim = len(hashes.cuts), hashes.cuts.shape[2] - 1
    # vectors are kept as they come: singles take half the place of doubles
    kind = "array<float>" if dict(rows.dtypes)["embedding"] == "array<float>" else "array<double>"
    vec = F.col("vec").cast(kind).alias("vec")
    homes = [f"cell_{t}" for t in range(tables)]

    def cells(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(h) for h in shared.value.homes(_matrix(batch.column(1)).astype(np.float64))), batch.column(1)], ["vec_id", *homes, "vec"])

    size = n * (dim * (4 if kind == "array<float>" else 8) + 8 * (1 + tables))
    tasks = min(spark.sparkContext.defaultParallelism, TASKS)
    parts = max(1, -(-size // PART_BYTES), min(tasks, n // UNIT_ROWS))
    placed = base.select("vec_id", vec).mapInArrow(cells, f"vec_id long, {', '.join(f'{c} long' for c in homes)}, vec {kind}")
    # rows of a cell lie together; a crowded cell is dealt to several parts
    placed = written(placed.repartitionByRange(parts, homes[0], F.xxhash64("vec_id")).sortWithinPartitions(homes[0]), "cells")
    # queries that visit much of the table go by the probabilities of its cells, so that no list of them is held; others by lists
    listed = hashes.share < LISTED
    if listed:
        bits = min(MOST_BITS, max(1 << 16, 1 << (16 * n * tables - 1).bit_length()))
        held = spark.sparkContext.broadcast(_known_cells(placed.select(F.explode(F.array(*homes)).alias("cell")), bits))

    def lists(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                some = batch.slice(low, 64)
                seen = shared.value.visits(_matrix(some.column(1)).astype(np.float64))
                flat = np.concatenate(seen)
                place = np.mod(flat, bits)
                there = (held.value[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1
                ends = np.concatenate([[0], np.cumsum(there)])[np.cumsum([0, *(len(c) for c in seen)])]
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat[there]))], ["query_id", "vec", "cells"])

    def least(batches):
        for batch in batches:
            if batch.num_rows:
                found = shared.value.least(_matrix(batch.column(1)).astype(np.float64))
                ends = pa.array(np.arange(len(found) + 1, dtype=np.int32) * tables)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(ends, pa.array(found.ravel()))], ["query_id", "vec", "least"])

    vectors = clean(queries).select(F.col("vec_id").alias("query_id"), vec)
    # rows of one id each ask for themselves: their best scores are put together below
    asked = written(vectors if listed else vectors.mapInArrow(least, f"query_id long, vec {kind}, least array<double>"), "asked")

    def with_cells(some: DataFrame) -> DataFrame:
        return some.mapInArrow(lists, f"query_id long, vec {kind}, cells array<long>")

    def nearest(some: DataFrame, cells: bool) -> list[DataFrame]:
        """Written tables, each of a segment of the queries: as many as all tasks hold at once. cells: each query's, else all."""
        count, long = some.count(), 0
        if cells and listed:  # how long the lists are, by a few
            long = with_cells(some.orderBy(F.xxhash64("query_id")).limit(200)).agg(F.avg(F.size("cells"))).first()[0] or 0
        segments = max(1, -(-int(count * (8 * (dim + 2 * k + 2 * tables) + 12 * long)) // SEGMENT_BYTES))

        def one(s: int) -> DataFrame:
            mine = some.filter(F.pmod(F.xxhash64("query_id"), F.lit(segments)) == s)
            mine = mine.select("query_id", "vec") if not cells else with_cells(mine) if listed else mine
            segment = spark.sparkContext.broadcast(Asked(mine.toArrow(), hashes))
            # a task hands on k rows a query: their number follows the tasks, not the table
            found = placed.coalesce(tasks).mapInArrow(_ranked(segment, k, tables), "query_id long, vec_id long, score double").repartition("query_id")
            best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
            out = written(best.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), "nearest")
            segment.destroy()
            return out

        beside = max(1, spark.sparkContext.defaultParallelism // tasks)
        return [df for low in range(0, segments, beside) for df in at_once(spark, *(lambda s=s: one(s) for s in range(low, min(segments, low + beside))))]

    first = _union(nearest(asked, True))
    enough = first.groupBy("query_id").count().filter(F.col("count") >= k)
    left = asked.join(enough, "query_id", "left_anti")
    if left.isEmpty():
        removed(placed, asked)
        return first
    # the few queries that saw too little: all rows
    left = written(left, "left")
    again = nearest(left, False)
    out = first.join(left.select("query_id").distinct(), "query_id", "left_anti").unionByName(_union(again))
    removed(placed, asked)
    return out


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def op2_multiprobe_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return search(rows, rows.filter(F.col("vec_id") % 20 == 0))
