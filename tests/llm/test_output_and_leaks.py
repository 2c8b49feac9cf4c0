import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lumenforge.llm import label_shards, multiprobe, packing, pfor, tiling
from tests.llm.conftest import SMALL, documents

public_tokenizers = pytest.importorskip("public_tokenizers")


def encoded(texts, end):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [[*e.ids, end] for e in made.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 60), st.integers(0, 2**32 - 1)), max_size=400), st.sampled_from([50.0, 90.0, 100.0]))
def test_blocks_round_trip(values, percentile):
    ids = np.array(values, np.uint32)
    payload, starts = pfor.encode_blocks(ids, percentile)
    assert (pfor.decode_blocks(payload, starts, len(ids)) == ids).all()
    if len(starts) > 1:  # a block is read on its own
        assert (pfor.decode_blocks(payload, starts[1:], len(ids) - pfor.BLOCK) == ids[pfor.BLOCK :]).all()


def test_files_hold_the_tokenizer_ids(spark):
    rows = sorted(pq.read_table(f"{SMALL}/documents.parquet").to_pylist(), key=lambda r: r["doc_id"])
    start, want = 0, {}
    for r, ids in zip(rows, encoded([r["text"] for r in rows], 2), strict=True):
        want[r["doc_id"]] = (start, len(ids), crc(ids))
        start += len(ids)
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in pfor.op3_token_blocks(spark, SMALL).collect()} == want


def test_odd_texts_tokenize_alike(spark, folder):
    texts = ["é combining", "<|endoftext|> in a text", "AÉÎ MiXed", "don't, stop... now!!", " nbsp wide", "", None, "a\x00b", "日本語 text", "x" * 3000, "ß ſ K İ"]
    got = {r["doc_id"]: r["ids_crc32"] for r in pfor.op3_token_blocks(spark, folder(documents=documents(*texts))).collect()}
    assert got == {k: crc(ids) for k, ids in enumerate(encoded(texts, 2))}


def test_packing_places_every_piece(spark):
    rows = pq.read_table(f"{SMALL}/documents.parquet").to_pylist()
    want = {}
    for r, ids in zip(rows, encoded([r["text"] for r in rows], 1), strict=True):
        for p in range(0, len(ids), 4096):
            want[r["doc_id"], p // 4096] = (p, len(ids[p : p + 4096]), crc(ids[p : p + 4096]))
    got = packing.op10_best_fit_packing(spark, SMALL).collect()
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in got} == want
    check_sequences(got)
    total = sum(r["length"] for r in got)
    assert len({r["sequence_id"] for r in got}) <= 1.02 * -(-total // 4096) + 1


def check_sequences(rows):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096


def test_swaps_never_need_more_bins():
    rng = random.Random(8)
    for _ in range(20):
        sizes = [rng.randrange(1, 90) for _ in range(rng.randrange(1, 120))]
        bins = packing.Bins(sizes, 100)
        bins.best_fit()
        before = len(bins.items)
        bins.improve()
        assert sorted(i for b in bins.items for i in b) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in b) <= 100 for b in bins.items) and len(bins.items) <= before


def fewest(sizes, capacity):
    """Bins that all items need at least, by trying every place."""
    sizes, best = sorted(sizes, reverse=True), [len(sizes)]

    def place(k, fills):
        if len(fills) >= best[0]:
            return
        if k == len(sizes):
            best[0] = len(fills)
            return
        for b in {f: b for b, f in enumerate(fills)}.values():
            if fills[b] + sizes[k] <= capacity:
                place(k + 1, [f + sizes[k] * (c == b) for c, f in enumerate(fills)])
        place(k + 1, [*fills, sizes[k]])

    place(0, [])
    return best[0]


def test_small_cases_against_the_fewest_bins():
    rng, more, fitted = random.Random(4), 0, 0
    for _ in range(300):
        sizes = [rng.randrange(10, 45) for _ in range(rng.randrange(0, 12))]
        least, got = fewest(sizes, 100), len(packing.packed_bins(sizes, 100))
        bins = packing.Bins(sizes, 100)
        bins.best_fit()
        assert least <= got <= len(bins.items)
        more, fitted = more + got - least, fitted + len(bins.items) - least
    assert more <= fitted / 2 and more <= 6


@pytest.mark.parametrize(("low", "high", "saved"), [(800, 2200, 20), (1000, 1700, 80), (1300, 1400, 10)])
def test_the_search_saves_bins(low, high, saved):
    rng = random.Random(1)
    sizes = [rng.randint(low, high) for _ in range(3_000)]
    bins = packing.Bins(sizes, 4096)
    bins.best_fit()
    fitted = len(bins.items)
    bins.improve()
    assert sorted(i for b in bins.items for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= 4096 for b in bins.items) and len(bins.items) <= fitted - saved


def test_bins_of_many_small_items_are_searched():
    sizes = [3] * 5_000 + [1365] * 40 + [2] * 7 + [4000] * 3
    got = packing.packed_bins(sizes, 4096)
    assert sorted(i for b in got for i in b) == list(range(len(sizes))) and all(sum(sizes[i] for i in b) <= 4096 for b in got)
    assert len(got) == -(-sum(sizes) // 4096)


def test_output_of_odd_rows(spark, folder, odd):
    sf, none = folder(documents=odd), folder(documents=odd.slice(0, 0))
    tokens = pfor.op3_token_blocks(spark, sf).collect()
    assert len(tokens) == odd.num_rows and sum(r["n_tokens"] for r in tokens) == max(r["start"] + r["n_tokens"] for r in tokens)
    packed = packing.op10_best_fit_packing(spark, sf).collect()
    check_sequences(packed)
    assert sum(r["length"] for r in packed) == sum(r["n_tokens"] for r in tokens)
    assert pfor.op3_token_blocks(spark, none).count() == packing.op10_best_fit_packing(spark, none).count() == 0


def check_shards(rows):
    by = {}
    for r in rows:
        assert r["law"] == "rows" and r["grown_shard"] is None
        by.setdefault(r["shard"], []).append(r["slot"])
    counts = [len(by.get(s, [])) for s in range(8)]
    assert sum(counts) == len(rows) and max(counts) - min(counts) <= 1
    assert all(sorted(slots) == list(range(len(slots))) for slots in by.values())


def test_shards_are_even_and_hold_groups(spark, folder):
    texts = [f"text {k // 5}" for k in range(400)] + ["the same"] * 200 + [None, ""]
    for sf, n in ((SMALL, None), (folder(documents=documents(*texts)), len(texts))):
        rows = label_shards.op7_label_shards(spark, sf).collect()
        check_shards(rows)
        assert n is None or len(rows) == n
    by_text = {}
    for r in rows:
        by_text.setdefault(texts[r["doc_id"]], set()).add(r["shard"])
    assert sum(len(by_text[f"text {k}"]) == 1 for k in range(80)) >= 60
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))


def test_shards_of_odd_rows(spark, folder, odd):
    check_shards(label_shards.op7_label_shards(spark, folder(documents=odd)).collect())
    assert label_shards.op7_label_shards(spark, folder(documents=odd.slice(0, 0))).count() == 0


def nearest(ids, x, k=20):
    out = {}
    for i, q in zip(ids, x, strict=True):
        if i % 20 == 0:
            scores = [(-float(np.dot(q, v)), j) for j, v in zip(ids, x, strict=True) if j != i]
            out[i] = sorted(scores)[:k]
    return out


def test_neighbours_reach_the_recall(spark):
    for sf in (SMALL, "/root/testdata/sf0.1"):
        rows = pq.read_table(f"{sf}/embeddings.parquet").to_pylist()
        fine = [(r["vec_id"], np.array(r["embedding"], float)) for r in rows if r["embedding"] and np.isfinite(np.array(r["embedding"], float)).all() and np.any(r["embedding"])]
        ids, x = np.array([i for i, _ in fine]), np.stack([v for _, v in fine])
        found = {}
        for r in multiprobe.op2_multiprobe_ann(spark, sf).collect():
            found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
        queries = np.flatnonzero(ids % 20 == 0)
        assert found.keys() == set(ids[queries].tolist())
        hit = total = 0
        for q in queries[:300]:
            scores = x @ x[q]
            scores[q] = -np.inf
            best = np.lexsort((ids, -scores))[: min(20, len(ids) - 1)]
            got = sorted(found[int(ids[q])])
            assert [r for r, _, _ in got] == list(range(1, len(best) + 1))
            hit += len({v for _, v, _ in got} & set(ids[best].tolist()))
            total += len(best)
        assert hit / total >= 0.9


def test_vectors_that_take_no_part(spark, folder):
    nan, inf = float("nan"), float("inf")
    vectors = [[1.0, 2.0], None, [0.0, 0.0], [nan, 1.0], [inf, 1.0], [None, 1.0], [1.0, 2.0], [2.0, 1.0], [1.0]]
    rows = pa.table({"vec_id": pa.array([0, 20, 40, 60, 80, 100, 7, 9, 11]), "embedding": pa.array(vectors, pa.list_(pa.float32())), "cell": list(range(9))})
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in multiprobe.op2_multiprobe_ann(spark, folder(embeddings=rows)).collect()]
    assert sorted(got) == [(0, 1, 7, 5.0), (0, 2, 9, 4.0)]
    assert multiprobe.op2_multiprobe_ann(spark, folder(embeddings=rows.slice(0, 0))).count() == 0


@pytest.mark.parametrize("n,copies", [(80, 2), (80, 25), (300, 25)])
def test_rows_of_one_id_are_one_neighbour(spark, folder, n, copies):
    rng = np.random.default_rng(8)
    base = rng.standard_normal((n, 8))
    ids = np.repeat(np.arange(n), copies)
    x = base[ids] + 0.01 * rng.standard_normal((n * copies, 8))
    rows = pa.table({"vec_id": pa.array(ids), "embedding": pa.array(x.tolist(), pa.list_(pa.float64()))})
    found = {}
    for r in multiprobe.op2_multiprobe_ann(spark, folder(embeddings=rows)).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    hit = total = 0
    for q in range(0, n, 20):
        scores = (x[ids == q] @ x.T).max(axis=0)
        best = np.maximum.reduceat(scores, np.arange(0, len(x), copies))
        best[q] = -np.inf
        want = np.argsort(-best, kind="stable")[:20].tolist()
        got = [v for _, v in sorted(found[q])]
        assert len(got) == 20 == len(set(got))
        hit, total = hit + len(set(got) & set(want)), total + 20
    assert hit / total >= 0.9


@pytest.mark.parametrize("cuts", [1, 4, 8])
def test_cells_visited_reach_their_cover(cuts):
    rng = np.random.default_rng(9)
    made = multiprobe.Hashes(32, cuts, 1.0, 0.6, 3.0, 2, 0.85)
    queries = rng.standard_normal((40, 32))
    visited = made.visits(queries)
    full = np.column_stack([queries / np.linalg.norm(queries, axis=1, keepdims=True), np.zeros(40)])
    once, either = [], []
    for q, v in enumerate(full):
        away = rng.standard_normal((50, 33))
        near = made.near * v + made.spread * away / np.linalg.norm(away, axis=1, keepdims=True)
        met = [np.isin(made.cell_ids(t, np.floor((near @ made.cuts[t].T + made.shift[t]) / made.width).astype(np.int64)), visited[q]) for t in range(2)]
        once.append(np.mean(met))
        either.append(np.mean(met[0] | met[1]))
    assert np.mean(once) > 0.82 and np.mean(either) > 0.95


def benchmark(*texts):
    return pa.table({"item_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})


def test_reordered_passages_leak(spark, folder):
    rng = random.Random(6)
    item = [f"q{rng.randrange(9000)}" for _ in range(60)]
    noise = lambda n: [f"n{rng.randrange(10**6)}" for _ in range(n)]
    cut = item[40:] + noise(4) + item[:20] + noise(3) + item[20:40]
    texts = [noise(50) + item + noise(50), noise(9) + cut, noise(200), item[:12] + noise(100)]
    sf = folder(documents=documents(*(" ".join(t) for t in texts), None, ""), benchmark=benchmark(" ".join(item), None, "", "one two"))
    got = {(r["doc_id"], r["item_id"]): r for r in tiling.op9_string_tiling(spark, sf).collect()}
    assert got.keys() == {(0, 0), (1, 0)} and got[1, 0]["coverage"] == 1.0 and got[1, 0]["n_tiles"] == 3
    for r in got.values():
        words = texts[r["doc_id"]]
        assert all(words[t["doc_start"] : t["doc_start"] + t["n_words"]] == item[t["item_start"] : t["item_start"] + t["n_words"]] for t in r["tiles"])


def brute_tiles(item, doc, least):
    """Greedy string tiling by trying every pair of places."""
    free_i, free_d, out = [True] * len(item), [True] * len(doc), []

    def run(i, d):
        n = 0
        while i + n < len(item) and d + n < len(doc) and free_i[i + n] and free_d[d + n] and item[i + n] == doc[d + n]:
            n += 1
        return n

    while True:
        best = max(((run(i, d), -i, -d) for i in range(len(item)) for d in range(len(doc))), default=(0, 0, 0))
        n, i, d = best[0], -best[1], -best[2]
        if n < least:
            return out
        free_i[i : i + n] = free_d[d : d + n] = [False] * n
        out.append((i, d, n))


def test_tiles_match_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(60):
        item, doc = (rng.integers(0, rng.choice([2, 4, 9]), rng.integers(1, 40)).astype(np.uint64) for _ in range(2))
        assert tiling.tiles(item, doc, 3) == brute_tiles(item.tolist(), doc.tolist(), 3)


def test_repeated_words_take_one_step_each():
    item, doc = np.full(400, 7, np.uint64), np.full(30_000, 7, np.uint64)
    assert tiling.tiles(item, doc, 5) == [(0, 0, 400)]
    other = np.where(np.arange(30_000) % 9 == 8, np.uint64(1), np.uint64(7))
    assert sum(n for _, _, n in tiling.tiles(item, other, 5)) == 400


def test_blocks_of_items_change_nothing(spark, folder, monkeypatch):
    rng = random.Random(13)
    items = [[f"q{rng.randrange(9000)}" for _ in range(30)] for _ in range(6)]
    texts = [" ".join([f"n{rng.randrange(10**6)}" for _ in range(20)] + (items[k % 8] if k % 8 < 6 else [])) for k in range(40)]
    sf = folder(documents=documents(*texts, None), benchmark=benchmark(*(" ".join(i) for i in items)))
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")

    def found():
        leaks = sorted((r["doc_id"], r["item_id"], r["coverage"]) for r in tiling.leaks(docs, bench).collect())
        return leaks, sorted(r["doc_id"] for r in tiling.without_leaks(docs, bench).collect())

    whole = found()
    assert [x[:2] for x in whole[0]] == [(k, k % 8) for k in range(40) if k % 8 < 6]
    monkeypatch.setattr(tiling, "BLOCK_WORDS", 60)
    assert len(list(tiling.item_blocks(bench))) == 3 and found() == whole


def test_items_too_short_leak_nothing(spark, folder):
    sf = folder(documents=documents("a walk through Paris in spring", "Paris", "one two three four five"), benchmark=benchmark("Paris", "one two three four", "one two three four five"))
    got = tiling.op9_string_tiling(spark, sf).collect()
    assert [(r["doc_id"], r["item_id"], r["coverage"]) for r in got] == [(2, 2, 1.0)]


def test_leaks_of_odd_rows(spark, folder, odd):
    sf = folder(documents=odd, benchmark=benchmark("the same text twice here", None))
    assert sorted(r["doc_id"] for r in tiling.op9_string_tiling(spark, sf).collect()) == [7, 7, 8]
    assert tiling.op9_string_tiling(spark, folder(documents=odd.slice(0, 0), benchmark=benchmark("a b c d e"))).count() == 0
    assert tiling.op9_string_tiling(spark, folder(documents=odd, benchmark=benchmark("a").slice(0, 0))).count() == 0


def test_pipeline_catches_planted_cases_and_keeps_clean_texts(spark, folder):
    import corpus_pipeline

    rng = random.Random(11)
    noise = lambda n: [f"{rng.choice('bcdfgklmn')}{rng.choice('aeiou')}{rng.choice('rstlmn')}{rng.choice('aeiou')}{rng.randrange(999)}x" for _ in range(n)]
    base, passage, item = noise(120), noise(80), noise(40)
    near = list(base)
    near[60] = "changed"
    clean = [noise(100) for _ in range(30)]
    texts = [" ".join(t) for t in (base, base, near, noise(40) + passage, passage + noise(60), noise(30) + item + noise(30), *clean)]
    sf = folder(documents=documents(*texts, "12 34", None), benchmark=benchmark(" ".join(item)))
    got = corpus_pipeline.run(spark, sf).collect()
    check_sequences(got)
    assert {r["doc_id"] for r in got} == {0, 3, 4, *range(6, 36)}
    assert len(corpus_pipeline.STAGES) == 5


def test_pipeline_of_odd_rows(spark, folder, odd):
    import corpus_pipeline

    items = benchmark("nothing of this is there at all")
    check_sequences(corpus_pipeline.run(spark, folder(documents=odd, benchmark=items)).collect())
    assert corpus_pipeline.run(spark, folder(documents=odd.slice(0, 0), benchmark=items)).count() == 0
