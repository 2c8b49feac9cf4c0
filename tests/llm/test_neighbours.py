import itertools
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lumenforge.llm import multiprobe


def table(vectors, ids=None):
    rows = [None if v is None else [None if x is None else float(x) for x in v] for v in vectors]
    return pa.table({"vec_id": pa.array(range(len(rows)) if ids is None else ids, pa.int64()), "embedding": pa.array(rows, pa.list_(pa.float64())), "label": pa.array([0] * len(rows))})


def brute(x, queries, k=20):
    scores = x[queries] @ x.T
    scores[np.arange(len(queries)), queries] = -np.inf
    order = np.argsort(-scores, axis=1, kind="stable")[:, :k]
    return {int(q): list(zip(o.tolist(), s[o].tolist(), strict=True)) for q, o, s in zip(queries, order, scores, strict=True)}


def test_tight_clusters_are_found_without_reading_the_table(spark, folder):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((400, 32))
    x = centres[rng.integers(0, 400, 20_000)] + 0.15 * rng.standard_normal((20_000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = spark.read.parquet(folder(embeddings=table(x)) + "/embeddings.parquet")
    got = {}
    for r in multiprobe.search(rows, rows.filter(F.col("vec_id") % 20 == 0)).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = brute(x, np.arange(0, 20_000, 20))
    assert got.keys() == want.keys()
    hits = sum(len({v for _, v, _ in got[q]} & {v for v, _ in near}) for q, near in want.items())
    assert hits / (20 * len(want)) >= 0.9
    for q, found in got.items():
        found.sort()
        assert [rank for rank, _, _ in found] == list(range(1, 21))
        assert all(s == pytest.approx(float(x[q] @ x[v]), rel=1e-12) for _, v, s in found)
    # the choice on a sample, and what it ranks of the whole table
    hashes, n = multiprobe.fit(multiprobe.clean(rows), 20)
    assert n == 20_000 and hashes.cuts.shape[1] >= 1
    homes, own = hashes.homes(x), np.arange(0, 20_000, 200)
    ranked = sum(np.isin(homes, v).sum() for v in hashes.visits(x[own]))
    assert ranked / (len(own) * len(x)) < 0.2 and hashes.share < 0.2


def test_small_tables_are_cut_too_and_lose_little(spark, folder):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((1_500, 16)) * rng.uniform(0.5, 2, (1_500, 1))
    rows = spark.read.parquet(folder(embeddings=table(x)) + "/embeddings.parquet")
    hashes, _ = multiprobe.fit(multiprobe.clean(rows), 20)
    assert hashes.cuts.shape[1] >= 1 and hashes.share < 1
    want = brute(x, np.arange(0, 1_500, 20))
    got = {}
    for r in multiprobe.search(rows, rows.filter(F.col("vec_id") % 20 == 0)).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert sum(len(got[q] & {v for v, _ in near}) for q, near in want.items()) / (20 * len(want)) >= 0.9


def test_copies_ties_and_odd_vectors(spark, folder):
    rng = np.random.default_rng(5)
    good = rng.standard_normal((60, 8))
    # every row twice, by id: an id counts once; ids 100.. are copies of id 0's vector: ties go to the smaller id
    vectors = [*good, *good, *([good[0]] * 25), None, [0.0] * 8, [float("nan")] * 8, [1.0, None] * 4, [1.0] * 5, [float("inf")] * 8, [1.0] * 8]
    ids = [*range(60), *range(60), *range(100, 125), 200, 220, 240, 260, 280, 300, None]
    sf = folder(embeddings=table(vectors, ids))
    got = {}
    for r in multiprobe.op2_multiprobe_ann(spark, sf).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got.keys() == {0, 20, 40, 100, 120}
    assert all(len(set(v)) == len(v) == 20 and q not in v for q, v in got.items())
    assert got[0] == list(range(100, 120)) and got[100] == [0, *range(101, 120)]
    assert multiprobe.op2_multiprobe_ann(spark, folder(embeddings=table([]))).count() == 0
    one = multiprobe.op2_multiprobe_ann(spark, folder(embeddings=table([[1.0, 2.0]])))
    assert one.count() == 0


def test_ties_go_to_the_smaller_id_in_large_tables_too(spark, folder):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((400, 32))
    x = np.concatenate([x] * 8)[rng.permutation(3_200)]  # every vector eight times
    got = {}
    for r in multiprobe.op2_multiprobe_ann(spark, folder(embeddings=table(x))).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    for found in got.values():
        found.sort()
        assert all(a[1] > b[1] or (a[1] == b[1] and a[2] < b[2]) for a, b in zip(found, found[1:], strict=False))
        assert len({s for _, s, _ in found}) <= 20 // 7 + 1


def test_cells_come_in_the_order_of_their_success():
    rng = np.random.default_rng(0)
    for cuts in (1, 3, 5):
        chance = rng.dirichlet([1, 2, 1], (7, cuts)) * 0.98
        for cover in (0.4, 0.9, 0.99):
            for q, (prob, cells) in enumerate(multiprobe.likeliest(chance, cover)):
                every = sorted((np.prod(chance[q, np.arange(cuts), list(c)]) for c in itertools.product(range(3), repeat=cuts)), reverse=True)
                n = min(len(every), int(np.searchsorted(np.cumsum(every), min(cover, sum(every) * (1 - 1e-9)))) + 1)
                assert prob == pytest.approx(every[:n]) and len({tuple(c) for c in cells.tolist()}) == n


@pytest.mark.parametrize("n", [100_000, 1_000_000])
def test_what_is_ranked_does_not_grow_with_the_table(spark, n):
    """The fit on the whole of a clustered table, and what it leaves to be ranked."""
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((n // 500, 16))
    x = centres[rng.integers(0, len(centres), n)] + 0.2 * rng.standard_normal((n, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    vec = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * 16), pa.array(x.ravel()))
    hashes, rows = multiprobe.fit(spark.createDataFrame(pa.table({"vec_id": pa.array(np.arange(n)), "vec": vec})), 20)
    own = np.arange(0, n, n // 100)
    homes, ranked, found = hashes.homes(x), 0, 0
    for i, cells in zip(own, hashes.visits(x[own]), strict=True):
        seen = np.isin(homes, cells)
        scores = x @ x[i]
        scores[i] = -np.inf
        ranked += seen.sum()
        found += seen.any(axis=0)[np.argsort(-scores)[:20]].sum()
    assert rows == n and ranked / (len(own) * n) < 0.02 and found / (20 * len(own)) >= 0.9


def test_disk_grows_no_faster_than_the_table(spark, folder, monkeypatch):
    """Shuffle files of a search in many parts, for four times the rows: queries times parts would be sixteen times as much."""
    rng, local, grown = np.random.default_rng(11), Path(spark.conf.get("spark.local.dir")), []
    monkeypatch.setattr(multiprobe, "PART_BYTES", 16 << 10)
    monkeypatch.setattr(multiprobe, "UNIT_ROWS", 100)
    for n in (3_000, 12_000):
        rows = spark.read.parquet(folder(embeddings=table(rng.standard_normal((n, 16)))) + "/embeddings.parquet")
        known = set(local.rglob("shuffle_*.data"))
        assert multiprobe.search(rows, rows.filter(F.col("vec_id") % 20 == 0)).count() == n
        grown.append(sum(p.stat().st_size for p in set(local.rglob("shuffle_*.data")) - known))
    assert 0 < grown[1] < 6 * grown[0], grown


def test_cells_by_lists_and_by_their_probability_give_the_same(spark, folder, monkeypatch):
    rng = np.random.default_rng(12)
    centres = rng.standard_normal((40, 16))
    x = centres[rng.integers(0, 40, 4_000)] + 0.2 * rng.standard_normal((4_000, 16))
    rows = spark.read.parquet(folder(embeddings=table(x)) + "/embeddings.parquet")
    got = []
    for limit, segment in ((0.0, 16 << 20), (1.1, 16 << 20), (0.0, 20_000), (1.1, 20_000)):
        monkeypatch.setattr(multiprobe, "LISTED", limit)
        monkeypatch.setattr(multiprobe, "SEGMENT_BYTES", segment)
        got.append(sorted(tuple(r) for r in multiprobe.search(rows, rows.filter(F.col("vec_id") % 20 == 0)).collect()))
    assert len(got[0]) == 4_000 and all(g == got[0] for g in got[1:])


def test_no_queries_and_segments_without_any(spark, folder, monkeypatch):
    x = np.random.default_rng(13).standard_normal((90, 8))
    assert multiprobe.op2_multiprobe_ann(spark, folder(embeddings=table(x, [*range(1, 20), *range(21, 40), *range(41, 60), *range(61, 80), *range(81, 95)]))).count() == 0
    monkeypatch.setattr(multiprobe, "SEGMENT_BYTES", 200)
    got = multiprobe.op2_multiprobe_ann(spark, folder(embeddings=table(x))).collect()
    assert sorted((r["query_id"], r["rank"]) for r in got) == [(q, k) for q in range(0, 90, 20) for k in range(1, 21)]
