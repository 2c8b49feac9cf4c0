"""The pipeline's filtering stages on their own, against brute force."""

import random

import pyarrow as pa

import corpus_pipeline
from tests.llm.conftest import documents, words


def stage(spark, folder, f, rows, **tables):
    sf = folder(documents=rows, **tables)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = f(spark, docs, sf)
    assert out.columns == docs.columns
    return sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)


def benchmark(*texts):
    return pa.table({"item_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})


def brute_cut(texts, least=50):
    """Each text less the words of its runs of `least` words that an earlier text holds."""
    split, out = [words(t) for t in texts], []
    for k, mine in enumerate(split):
        held = {tuple(w[i : i + least]) for w in split[:k] for i in range(len(w) - least + 1)}
        gone = [False] * len(mine)
        for i in range(len(mine) - least + 1):
            if tuple(mine[i : i + least]) in held:
                gone[i : i + least] = [True] * least
        out.append(" ".join(w for w, g in zip(mine, gone, strict=True) if not g))
    return out


def test_passages_cut_match_brute_force(spark, folder):
    rng = random.Random(21)
    noise = lambda n: [f"x{rng.randrange(10**7)}" for _ in range(n)]
    long = noise(160)
    # whole and partial copies, parts held by different documents, and shares of under 50 words
    texts = [noise(20) + long[:70] + noise(10), noise(5) + long[60:130], noise(30) + long[20:110] + noise(30), long, noise(40) + long[100:145] + noise(40), noise(80)]
    texts = [" ".join(t) for t in texts]
    got = dict(stage(spark, folder, corpus_pipeline.repeated_passages, documents(*texts)))
    assert {k: " ".join(words(t)) for k, t in got.items()} == dict(enumerate(brute_cut(texts)))


def test_passages_of_odd_texts_stay(spark, folder, odd):
    got = stage(spark, folder, corpus_pipeline.repeated_passages, odd)
    assert got == sorted(((r["doc_id"], r["text"]) for r in odd.to_pylist()), key=str)
    assert stage(spark, folder, corpus_pipeline.repeated_passages, odd.slice(0, 0)) == []


def test_rows_that_share_an_id_are_cut_each_by_its_own(spark, folder):
    rng = random.Random(23)
    noise = lambda n: " ".join(f"y{rng.randrange(10**7)}" for _ in range(n))
    p, q, r = noise(120), noise(300), noise(80)
    rows = documents(p, f"{p} {noise(30)}", q, q, f"{r} {q}", r)
    rows = rows.set_column(0, "doc_id", pa.array([1, 2, 2, 4, 2, None], pa.int64()))
    got = [(d, len(words(t))) for d, t in stage(spark, folder, corpus_pipeline.repeated_passages, rows)]
    # one holder keeps p, one q, and nothing else is cut
    assert sorted(n for d, n in got if d == 1)[0] in (0, 120) and sum(n for _, n in got) == 120 + 30 + 300 + 80 + 80
    assert (None, 80) in got


def test_leaks_go_and_clean_documents_stay(spark, folder, odd):
    rng = random.Random(22)
    item = [f"q{rng.randrange(10**6)}" for _ in range(40)]
    noise = [f"n{k}" for k in range(60)]
    texts = [noise + item, item[20:] + noise + item[:20], noise + item[:15], noise, None, "", "short item"]
    texts = [t if t is None or isinstance(t, str) else " ".join(t) for t in texts]
    items = benchmark(" ".join(item), "short item", None, "")
    got = stage(spark, folder, corpus_pipeline.decontaminated, documents(*texts), benchmark=items)
    assert [k for k, _ in got] == [2, 3, 4, 5, 6]
    assert len(stage(spark, folder, corpus_pipeline.decontaminated, odd, benchmark=items)) == odd.num_rows
    assert len(stage(spark, folder, corpus_pipeline.decontaminated, odd, benchmark=items.slice(0, 0))) == odd.num_rows
    assert stage(spark, folder, corpus_pipeline.decontaminated, odd.slice(0, 0), benchmark=items) == []
