import hashlib
import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumenforge.llm import chaining, parity, sais, suffixes, text
from tests.llm.conftest import SMALL, documents, words


def shingle_set(text, k):
    w = words(text)
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute_components(rows, k, num, den):
    sets = {r["doc_id"]: shingle_set(r["text"], k) for r in rows}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = {}
    for d, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(d)
    for a, s in sets.items():
        for b in {b for x in s for b in where[x] if b < a}:
            same = len(s & sets[b])
            if den * same >= num * (len(s) + len(sets[b]) - same):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {d: (len(s), root(d)) for d, s in sets.items()}


def test_components_match_brute_force(spark):
    want = brute_components(pq.read_table(f"{SMALL}/documents.parquet").to_pylist(), 3, 90, 100)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in parity.op5_parity_join(spark, SMALL).collect()}
    assert got == want


def test_chains_of_near_copies_lose_no_link(spark, folder):
    rng = random.Random(5)
    texts = []
    for _ in range(12):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.choice((12, 40, 150, 400)))]
        for _ in range(8):
            texts.append(" ".join(base))
            base = list(base)
            base[rng.randrange(len(base))] = f"new{rng.randrange(10**6)}"
    texts += ["a b", "a  B", "", None, "a"]
    rng.shuffle(texts)
    sf = folder(documents=documents(*texts))
    rows = [{"doc_id": k, "text": t} for k, t in enumerate(texts)]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for k, num in ((3, 90), (5, 80)):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in parity.near_duplicates(docs, k, num, 100).collect()}
        assert got == brute_components(rows, k, num, 100)


def test_rows_that_share_an_id_are_removed_apart(spark, folder):
    import corpus_pipeline

    one, two, three = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = [(1, one), (2, one + " more"), (2, two), (3, three), (3, three), (None, one), (4, ""), (4, "")]
    made = pa.Table.from_pylist([{"doc_id": d, "text": t, "lang": "en", "source": "s", "n_chars": len(t)} for d, t in rows], documents().schema)
    docs = spark.read.parquet(folder(documents=made) + "/documents.parquet")
    got = corpus_pipeline.near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(((r["doc_id"] or 0), r["text"]) for r in got.collect()) == sorted([(0, one), (1, one), (2, two), (3, three), (4, ""), (4, "")])


def test_sketch_distance_is_at_most_the_symmetric_difference():
    rng = np.random.default_rng(1)
    for _ in range(50):
        pool = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
        a, b = (np.unique(rng.choice(pool, 40)) for _ in range(2))
        one, two = (np.frombuffer(x, np.uint64)[None] for x in parity.sketches(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 80, 100))
        words = min(one.shape[1], two.shape[1])
        apart = int(np.bitwise_count(parity.folded(one, words) ^ parity.folded(two, words)).sum())
        assert apart <= len(np.setxor1d(a, b))


def test_join_of_odd_rows(spark, folder, odd):
    got = parity.op5_parity_join(spark, folder(documents=odd)).collect()
    assert len(got) == odd.num_rows
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[7]["component_id"] == by_id[8]["component_id"] == 7
    assert by_id[1]["n_shingles"] == 0 and by_id[2]["component_id"] == 2 and by_id[None]["component_id"] is None
    assert parity.op5_parity_join(spark, folder(documents=odd.slice(0, 0))).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=80), st.sampled_from([0, 10**9]))
def test_suffix_order_and_prefixes(values, wave):
    s = np.array(values, np.uint8)
    kept, sais.WAVE_PLACES = sais.WAVE_PLACES, wave
    try:
        order = sais.suffix_array(s)
    finally:
        sais.WAVE_PLACES = kept
    body = bytes(values)
    assert order.tolist() == sorted(range(len(body)), key=lambda i: body[i:])
    for cap in (1, 3, 100):
        prefix, before = sais.permuted_lcp(s, order, cap)
        for a, b in zip(order[1:].tolist(), order[:-1].tolist(), strict=True):
            n = 0
            while n < cap and max(a, b) + n < len(s) and s[a + n] == s[b + n]:
                n += 1
            assert (prefix[a], before[a]) == (n, b)


def test_suffix_order_of_many_symbols_and_long_runs():
    rng = np.random.default_rng(2)
    for s in (rng.integers(0, 5_000, 20_000), np.zeros(30_000, np.int64), np.tile([3, 1, 2, 1], 5_000), np.repeat(rng.integers(0, 4, 300), 100), rng.integers(0, 4, 40_000)):
        order = sais.suffix_array(s, 5_000)
        rank = np.empty(len(s) + 1, np.int64)
        rank[order], rank[-1] = np.arange(len(s)), -1
        # suffixes are in order if their first symbols are, and where those agree the suffixes that follow are
        a, b = order[:-1], order[1:]
        assert (s[a] <= s[b]).all() and (rank[a + 1] < rank[b + 1])[s[a] == s[b]].all() and sorted(order.tolist()) == list(range(len(s)))


def brute_removed(texts, length):
    starts = {}
    raw = [(t or "").encode() for t in texts]
    for d, b in enumerate(raw):
        for i in range(len(b) - length + 1):
            starts.setdefault(b[i : i + length], []).append((d, i))
    gone = [np.zeros(len(b), bool) for b in raw]
    for at in starts.values():
        if len(at) > 1:
            for d, i in at:
                gone[d][i : i + length] = True
    out = {}
    for d, b in enumerate(raw):
        edges = np.diff(np.concatenate([[0], gone[d].astype(int), [0]]))
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[d]])
        out[d] = (len(b), int(gone[d].sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def digest(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()}


def test_removed_bytes_match_brute_force(spark, folder):
    rows = sorted(pq.read_table(f"{SMALL}/documents.parquet").to_pylist(), key=lambda r: r["doc_id"])
    want = dict(zip((r["doc_id"] for r in rows), brute_removed([r["text"] for r in rows], 200).values(), strict=True))
    assert digest(suffixes.op6_suffix_dedup(spark, SMALL)) == want
    rng = random.Random(3)
    noise = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    shared, loop = noise(450), "xyz " * 300
    texts = [noise(300) + shared + noise(50), shared[100:420] + noise(10), shared, loop, noise(90) + loop[:400], shared, "", None, "short"]
    assert digest(suffixes.op6_suffix_dedup(spark, folder(documents=documents(*texts)))) == brute_removed(texts, 200)


@pytest.mark.parametrize("hot", [1, 2, 5])
def test_hot_anchors_give_the_same(spark, folder, hot):
    rng = random.Random(4)
    noise = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    shared = noise(700)
    texts = [noise(rng.randrange(300)) + shared[rng.randrange(200) : 500 + rng.randrange(200)] + noise(rng.randrange(300)) for _ in range(20)]
    # one line in different places, with and without more that is shared beside it
    line, longer = noise(40), noise(170)
    texts += [noise(180) + line + noise(150) for _ in range(15)] + [noise(rng.randrange(200)) + longer + noise(rng.randrange(200)) for _ in range(10)]
    texts += [longer + "a" * 40 + noise(9), "b" + longer + "a" * 31 + noise(9)]
    docs = spark.read.parquet(folder(documents=documents(*texts)) + "/documents.parquet")
    assert digest(suffixes.without_repeats(docs, hot=hot)) == brute_removed(texts, 200)


def test_hot_anchors_go_to_suffix_arrays(spark, folder, monkeypatch):
    rng = random.Random(5)
    noise = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    # of many lines the one of least hash, which is then the anchor of the windows that hold it
    raw = noise(20_000)
    total, inverse = text.prefix_sums(np.frombuffer(raw.encode(), np.uint8))
    at = int(np.argmin(text.mix((total[32:] - total[:-32]) * inverse[: len(raw) - 31])))
    line = raw[at : at + 32]
    shared = [noise(150) + line + noise(150) for _ in range(12)]
    texts = [noise(20) + s + noise(20) for s in shared for _ in range(2)]
    grams, made = [], suffixes._anchored
    monkeypatch.setattr(suffixes, "_anchored", lambda buckets, length, gram: grams.append(gram) or made(buckets, length, gram))
    docs = spark.read.parquet(folder(documents=documents(*texts)) + "/documents.parquet")
    assert digest(suffixes.without_repeats(docs, hot=4)) == brute_removed(texts, 200)
    assert grams == [32, 116]  # longer anchors part them, so that no window is matched by itself


def test_texts_are_shuffled_once_whatever_their_number(spark):
    df = suffixes.op6_suffix_dedup(spark, SMALL)
    assert df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
    assert "BroadcastHashJoin" not in plan and "ReusedExchange" in plan


def test_texts_without_hot_contexts_are_not_shuffled_again(spark):
    docs = spark.range(20_000).select(F.xxhash64("id").alias("uid"), F.lit("text").alias("text"))
    hot = docs.limit(50).withColumn("kind", F.lit(2)).localCheckpoint()
    left = suffixes._holding(docs, hot)
    assert left.join(hot, "uid").count() == 50 and left.count() < 200


def test_suffix_dedup_of_odd_rows(spark, folder, odd):
    assert suffixes.op6_suffix_dedup(spark, folder(documents=odd)).count() == odd.num_rows
    assert suffixes.op6_suffix_dedup(spark, folder(documents=odd.slice(0, 0))).count() == 0


def planted(rng, changed=0):
    passage = [f"p{rng.randrange(9000)}" for _ in range(90)]
    texts = []
    for _ in range(4):
        mine = list(passage)
        for _ in range(changed):
            mine[rng.randrange(len(mine))] = f"x{rng.randrange(10**6)}"
        before, after = ([f"n{rng.randrange(10**6)}" for _ in range(rng.randrange(20, 200))] for _ in range(2))
        texts.append((len(before), " ".join(before + mine + after)))
    return texts


def test_planted_passages_are_found(spark, folder):
    rng = random.Random(9)
    for changed in (0, 4):
        made = planted(rng, changed)
        clean = [" ".join(f"c{rng.randrange(10**6)}" for _ in range(120)) for _ in range(5)]
        got = chaining.op4_chained_passages(spark, folder(documents=documents(*(t for _, t in made), *clean))).collect()
        assert {r["doc_id"] for r in got} == {1, 2, 3}
        for r in got:
            start = made[r["doc_id"]][0]
            assert abs(r["start_word"] - start) <= 12 and abs(r["end_word"] - start - 90) <= 12 and r["identity"] >= 0.8


def brute_shared(rows, n=50):
    """Words of each document that lie in a run of n words which an earlier document holds."""
    first, out = {}, {}
    for d, text in sorted(rows):
        w = words(text)
        for i in range(len(w) - n + 1):
            if first.setdefault(tuple(w[i : i + n]), d) != d:
                out.setdefault(d, set()).update(range(i, i + n))
    return out


def test_shared_runs_match_brute_force(spark, folder):
    rng = random.Random(11)
    noise = lambda n: [f"n{rng.randrange(10**6)}" for _ in range(n)]
    texts = []
    for n in (80, 60, 50, 51):
        for _ in range(8):  # earlier documents hold the parts of a passage, none of them 50 words
            whole = noise(n)
            cut = rng.randrange(n - 48, 49)
            texts += [noise(5) + whole[:48], whole[cut - 16 :][:49] + noise(7), noise(30) + whole + noise(9), whole + noise(20), noise(3) + whole]
    twice = noise(70)
    texts += [noise(20) + twice, twice + noise(60) + twice, ["a", "b", "c"] * 400, noise(30) + ["a", "b", "c"] * 300]
    rows = list(enumerate(" ".join(t) for t in texts))
    want = brute_shared(rows)
    docs = spark.read.parquet(folder(documents=documents(*(t for _, t in rows))) + "/documents.parquet")
    for parts in (1, 5):
        covered = {}
        for r in chaining.passages(docs.repartition(parts, "text")).collect():
            assert r["other_doc_id"] < r["doc_id"]
            covered.setdefault(r["doc_id"], set()).update(range(r["start_word"], r["end_word"]))
            if r["identity"] == 1 and r["end_word"] - r["start_word"] == r["other_end_word"] - r["other_start_word"]:
                mine, other = words(rows[r["doc_id"]][1]), words(rows[r["other_doc_id"]][1])
                assert mine[r["start_word"] : r["end_word"]] == other[r["other_start_word"] : r["other_end_word"]]
        assert not {d: sorted(some - covered.get(d, set())) for d, some in want.items() if some - covered.get(d, set())}


def test_runs_that_cover_are_kept():
    rng = random.Random(12)
    for _ in range(300):
        made = [[{"start_word": a, "end_word": a + rng.randrange(5, 15), "other": 0, "other_start": k} for k, a in enumerate(rng.choices(range(60), k=rng.randrange(8)))] for _ in range(2)]
        every = lambda some: {w for x in some for w in range(x["start_word"], x["end_word"])}
        kept = chaining.covering(*made)
        assert every(made[0]) | every(made[1]) == every(kept) | every(made[1]) and all(x in made[0] for x in kept)


def test_changed_passages_are_found_as_stated():
    rng = np.random.default_rng(3)
    fresh = lambda n: rng.integers(1, 1 << 62, n).astype(np.uint64)
    for n, every, least in ((60, 20, 0.97), (60, 12, 0.85), (100, 10, 0.75), (200, 9, 0.82)):
        found = 0
        for _ in range(100):
            passage = fresh(n)
            changed = passage.copy()
            changed[rng.integers(every) :: every] = fresh(1)
            one, two = np.concatenate([fresh(100), passage, fresh(100)]), np.concatenate([fresh(60), changed, fresh(100)])
            row, place, h = chaining.minimizers(np.concatenate([one, two]), np.array([0, len(one), len(one) + len(two)]))
            _, docs, places, other, others = chaining._firsts(h, row, place)
            places, others = places[docs != other], others[docs != other]
            made = [m for c in chaining.chains(places, others) for m in chaining.aligned(two, one, places[c], others[c])] if len(places) else []
            found += any(b - a >= chaining.MIN_WORDS and share >= chaining.IDENTITY for a, b, _, _, share in made)
        assert found / 100 >= least


def test_passages_with_other_text_between_them_are_all_found(spark, folder):
    rng = random.Random(14)
    noise = lambda n: [f"z{rng.randrange(10**7)}" for _ in range(n)]
    changed = lambda some, every: [w if k % every else f"c{rng.randrange(10**7)}" for k, w in enumerate(some)]
    texts, want = [], []
    for gap, every, n in ((200, 20, 300), (40, 20, 120), (1_000, 12, 200), (90, 12, 300)):
        one, two, three = noise(n), noise(n), noise(n)
        texts += [noise(10) + one + noise(gap) + two + noise(gap) + three, changed(one, every) + noise(gap) + changed(two, every) + noise(gap) + changed(three, every) + noise(30)]
        want += [[(k * (n + gap), k * (n + gap) + n) for k in range(3)]]
    docs = spark.read.parquet(folder(documents=documents(*(" ".join(t) for t in texts))) + "/documents.parquet")
    covered = {}
    for r in chaining.passages(docs).collect():
        assert r["other_doc_id"] == r["doc_id"] - 1 and r["identity"] >= chaining.IDENTITY
        covered.setdefault(r["doc_id"], set()).update(range(r["start_word"], r["end_word"]))
    for k, spans in enumerate(want):
        for low, high in spans:
            assert len(covered[2 * k + 1] & set(range(low, high))) >= 0.9 * (high - low)
        if k in (1, 3):
            continue  # so short a gap lies within the identity asked for
        assert len(covered[2 * k + 1] - {w for low, high in spans for w in range(low - 3, high + 3)}) <= 0.05 * len(covered[2 * k + 1])


def test_long_words_of_two_letters_are_told_apart():
    """The Thue-Morse word and its complement are equal for every polynomial hash modulo a power of two."""
    for n in (1_024, 4_096):
        bits = [bin(k).count("1") % 2 for k in range(n)]
        pair = ["".join("ab"[b ^ flip] for b in bits) for flip in (0, 1)]
        hashes, first = text.word_hashes(pa.array([*pair, f"{pair[0]} x {pair[1]}"]))
        assert len({int(h) for h in hashes}) == 3 and hashes[0] == hashes[2] and hashes[1] == hashes[4] and first.tolist() == [0, 1, 2, 5]
    rng = random.Random(6)
    made = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 12))) for _ in range(20_000)]
    hashes, _ = text.word_hashes(pa.array([" ".join(made)]))
    assert len(set(hashes.tolist())) == len(set(made))


def test_chains_do_not_depend_on_the_order_of_rows():
    rng = np.random.default_rng(5)
    kinds = [pa.int32(), pa.int64(), pa.int32()]
    seeds = np.unique(np.column_stack([rng.integers(0, 60, 300), rng.integers(0, 4, 300), rng.integers(0, 60, 300)]), axis=0)
    seen = set()
    for _ in range(6):
        parts = np.array_split(seeds[rng.permutation(len(seeds))], 3)
        lists = [pa.chunked_array([pa.array([x[:, j] for x in parts], pa.list_(kind))]) for j, kind in enumerate(kinds)]
        rows = pa.table([pa.array([9] * 3, pa.int64()), *lists], ["doc_id", "places", "others", "other_places"])
        seen.add(str(chaining._chained(rows).to_pylist()))
    assert len(seen) == 1


def test_seeds_of_short_texts_do_not_depend_on_their_neighbours():
    rng = np.random.default_rng(8)
    for window in (1, 2, 5, chaining.WINDOW):
        sizes = np.concatenate([rng.integers(0, 40, 200), [0, 7, 8, 9, 19, 20]])
        first = np.append(0, np.cumsum(sizes))
        words = rng.integers(0, 3, first[-1]).astype(np.uint64)
        got = list(zip(*(x.tolist() for x in chaining.minimizers(words, first, window=window)), strict=True))
        want = []
        for r in range(len(sizes)):
            h = text.rolled(words[first[r] : first[r + 1]], chaining.K).tolist()
            held = min(window, len(h))
            least = [min(h[a : a + held]) for a in range(len(h) - held + 1)] if h else []
            want += [(r, at, v) for at, v in enumerate(h) if any(a <= at < a + held and least[a] == v for a in range(len(least)))]
        assert got == want


def test_chains_of_many_documents_are_those_of_each():
    rng = np.random.default_rng(9)
    names, kinds = ["places", "others", "other_places"], [pa.int32(), pa.int64(), pa.int32()]
    every, want = [], []
    for doc in range(300):
        # runs of seeds on a few diagonals, some seeds elsewhere, some first in the document itself
        seeds = {}
        for _ in range(rng.integers(1, 4)):
            other, at, other_at = int(rng.integers(0, 3)), int(rng.integers(0, 200)), int(rng.integers(0, 200))
            for step in np.cumsum(rng.integers(1, 60 if rng.random() < 0.3 else 8, rng.integers(1, 12))).tolist():
                seeds[at + step] = (other, other_at + step + int(rng.integers(0, 2)))
        if rng.random() < 0.2:
            seeds |= {int(p): (1000 + doc, int(p)) for p in rng.integers(0, 400, 5)}
        rows = [(p, *v) for p, v in seeds.items()]
        rng.shuffle(rows)
        every += [{"doc_id": 1000 + doc, **{n: [x[j] for x in part] for j, n in enumerate(names)}} for part in (rows[:3], rows[3:]) if part]
        found = []
        for other in sorted({o for _, o, _ in rows} - {1000 + doc}):
            mine = sorted((p, q) for p, o, q in rows if o == other)
            for chain in chaining.chains(*(np.array([m[j] for m in mine]) for j in (0, 1))):
                found.append((other, [mine[i][0] for i in chain], [mine[i][1] for i in chain]))
        found.sort(key=lambda c: (c[1][0] - c[1][-1], -len(c[1]), c[0]))
        want.append((1000 + doc, found))
    schema = pa.schema([("doc_id", pa.int64()), *((n, pa.list_(k)) for n, k in zip(names, kinds, strict=True))])
    whole = pa.RecordBatch.from_pylist(every, schema)
    calls = []
    work = lambda rows: calls.append(rows.num_rows) or chaining._chained(rows)
    for size in (1, 7, 10_000):
        calls.clear()
        got = [r for b in chaining._by_document(work)(iter([whole.slice(a, size) for a in range(0, whole.num_rows, size)])) for r in b.to_pylist()]
        assert size < whole.num_rows or len(calls) <= 2
        assert [r["doc_id"] for r in got] == [doc for doc, _ in want]
        for row, (_, found) in zip(got, want, strict=True):
            assert sorted(str((c["other"], c["places"], c["other_places"])) for c in row["first"] + row["rest"]) == sorted(str(c) for c in found)
            taken, first = [], []
            for _, places, _ in found:
                low, high = max(0, (places[0] // 64 - 1) * 64), (places[-1] // 64 + 3) * 64
                if all(high <= a or b <= low for a, b in taken):
                    taken.append((low, high))
                    first.append(places)
            assert [c["places"] for c in row["first"]] == first
            assert [(c["low"], c["high"]) for c in row["first"]] == taken


def test_alignments_of_many_rows_are_those_of_each():
    rng = np.random.default_rng(10)
    rows = []
    for _ in range(600):
        n = int(rng.integers(60, 500))
        x = rng.integers(0, 1 << 60, n).astype(np.uint64)
        y = x.copy()
        for at in rng.integers(0, n, int(rng.integers(0, 1 + n // 8))):  # changed, dropped and added words, and swapped stretches
            kind = rng.integers(0, 4)
            if kind == 0:
                y[at % len(y)] = rng.integers(0, 1 << 60)
            elif kind == 1:
                y = np.delete(y, at % len(y))
            elif kind == 2:
                y = np.insert(y, at % len(y), rng.integers(0, 1 << 60, 3).astype(np.uint64))
            elif rng.random() < 0.1:
                y[at % len(y) : at % len(y) + 60] = rng.integers(0, 1 << 60, len(y[at % len(y) : at % len(y) + 60]))
        h, g = text.rolled(x, chaining.K), text.rolled(y, chaining.K)
        _, p, o = np.intersect1d(h, g, return_indices=True)
        if len(p):
            order = np.lexsort((o, p))
            p, o = p[order][:: int(rng.integers(1, 9))], o[order][:: int(rng.integers(1, 9))][: len(p)]
            n = min(len(p), len(o))
            p, o = p[:n], o[:n]
            made = [c for c in chaining.chains(p, o) if len(c)]
            rows += [(p[c] + 5, o[c] + 9, x, y) for c in made]
    want = sorted(
        (i, a + 5, b + 5, c + 9, d + 9, s) for i, (p, o, x, y) in enumerate(rows) for a, b, c, d, s in chaining.aligned(x, y, p - 5, o - 9) if b - a >= chaining.MIN_WORDS
    )
    batch = pa.RecordBatch.from_pylist(
        [{"doc_id": i, "other": -i, "places": p.tolist(), "other_places": o.tolist(), "low": 5, "other_low": 9, "words": x.tobytes(), "other_words": y.tobytes()} for i, (p, o, x, y) in enumerate(rows)],
        pa.schema([("doc_id", pa.int64()), ("other", pa.int64()), ("places", pa.list_(pa.int32())), ("other_places", pa.list_(pa.int32())), ("low", pa.int32()), ("other_low", pa.int32()), ("words", pa.binary()), ("other_words", pa.binary())]),
    )
    got = [tuple(r.values()) for b in chaining._aligned(iter([batch.slice(0, 3), batch.slice(3)])) for r in b.to_pylist()]
    assert len(want) > 300 and sorted((i, *more) for i, _, *more in got) == want
    assert all(other == -i for i, other, *_ in got)


def test_chains_put_off_are_left_where_no_passage_covers_a_seed():
    rng = np.random.default_rng(11)
    some = lambda n: [int(v) for v in rng.integers(0, 300, n)]
    rows = []
    for doc in range(200):
        rest = [{"other": 1, "low": 0, "high": 64, "other_low": 0, "other_high": 64, "places": sorted(some(3)), "other_places": some(3)} for _ in range(rng.integers(1, 5))]
        spans = [{"start_word": a, "end_word": a + int(rng.integers(50, 250))} for a in some(rng.integers(0, 4))]
        rows.append({"doc_id": doc, "rest": rest, "spans": spans or (None if doc % 2 else [])})
    want = []
    for r in rows:
        left = [c for c in r["rest"] if not all(any(s["start_word"] <= p and p + chaining.K <= s["end_word"] for s in r["spans"] or []) for p in c["places"])]
        want += [{"doc_id": r["doc_id"], "chains": left}] if left else []
    span = pa.struct([("start_word", pa.int32()), ("end_word", pa.int32())])
    batch = pa.RecordBatch.from_pylist(rows, pa.schema([("doc_id", pa.int64()), ("rest", pa.list_(chaining._CHAIN)), ("spans", pa.list_(span))]))
    got = [r for b in chaining._uncovered(iter([batch.slice(0, 0), batch.slice(0, 70), batch.slice(70)])) for r in b.to_pylist()]
    assert 0 < len(want) < len(rows) and got == want


def test_chains_are_collinear_and_disjoint():
    rng = random.Random(2)
    for _ in range(30):
        n = rng.randrange(1, 40)
        places, others = (np.array([rng.randrange(60) for _ in range(n)]) for _ in range(2))
        made = chaining.chains(places, others)
        assert sorted(i for c in made for i in c) == list(range(n))
        for c in made:
            assert (np.diff(places[c]) > 0).all() and (np.diff(others[c]) > 0).all()


def test_passages_of_odd_rows(spark, folder, odd):
    assert chaining.op4_chained_passages(spark, folder(documents=odd)).count() == 0
    assert chaining.op4_chained_passages(spark, folder(documents=odd.slice(0, 0))).count() == 0
    docs = spark.read.parquet(folder(documents=odd) + "/documents.parquet")
    assert chaining.without_passages(docs).count() == odd.num_rows


def test_crowded_keys_are_compared_in_blocks(spark, folder, monkeypatch):
    monkeypatch.setattr(parity, "BLOCK", 3)
    monkeypatch.setattr(parity, "CROWD", 6)
    rng = random.Random(8)
    base = [f"w{rng.randrange(4000)}" for _ in range(90)]
    texts = []
    for _ in range(40):  # copies that differ by about as much as a link allows: no hub is linked with all
        some = list(base)
        for k in rng.sample(range(90), rng.choice((1, 2, 2, 3))):
            some[k] = f"new{rng.randrange(10**6)}"
        texts.append(" ".join(some))
    rows = [{"doc_id": k, "text": t} for k, t in enumerate(texts)]
    docs = spark.read.parquet(folder(documents=documents(*texts)) + "/documents.parquet")
    for k, num in ((5, 80), (3, 90)):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in parity.near_duplicates(docs, k, num, 100).collect()}
        assert got == brute_components(rows, k, num, 100)


def test_common_words_of_long_gaps_are_counted_once_a_word(monkeypatch):
    rng = np.random.default_rng(8)

    def common(x, y):
        row = [0] * (len(y) + 1)
        for a in x:
            row, old = [0], row
            for j, b in enumerate(y):
                row.append(max(row[-1], old[j + 1], old[j] + (a == b)))
        return row[-1]

    for _ in range(200):
        x, y = (rng.integers(0, rng.integers(2, 40), rng.integers(1, 130)).astype(np.uint64) for _ in range(2))
        if len(x) != len(y) or 2 * (x == y).sum() < len(x):
            assert chaining._equal(x, y) == common(x.tolist(), y.tolist())
    # no array work for each word of a gap
    monkeypatch.setattr(np, "maximum", None)
    assert chaining._equal(np.arange(300, dtype=np.uint64), np.arange(100, 350, dtype=np.uint64)) == 200


def test_hashes_of_words_come_from_a_table_of_places(monkeypatch):
    want = lambda w: int(text.mix(np.array([sum(int(text.mix(np.array([(k << 8) + b + (1 << 40)], np.uint64))[0]) for k, b in enumerate(w)) + len(w) & (1 << 64) - 1], np.uint64))[0])
    words = [b"a", b"word", bytes(range(97, 122)) * 9, b"x" * 64, b"y" * 65, b"\xff" * 70]
    ends = np.cumsum([len(w) for w in words])
    hashes = lambda: text.span_hashes(np.frombuffer(b"".join(words), np.uint8), ends - [len(w) for w in words], ends).tolist()
    assert hashes() == [want(w) for w in words]
    mixed, made = [], text.mix
    monkeypatch.setattr(text, "mix", lambda x: mixed.append(len(x)) or made(x))
    hashes()
    assert mixed == [sum(max(0, len(w) - 64) for w in words), len(words)]
