import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lumenforge.llm import hard_negatives as hn


def table(vectors, labels, ids=None):
    rows = [None if v is None else [None if x is None else float(x) for x in v] for v in vectors]
    ids = range(len(rows)) if ids is None else ids
    columns = {"vec_id": pa.array(ids, pa.int64()), "embedding": pa.array(rows, pa.list_(pa.float64())), "label": pa.array(labels, pa.int32())}
    return pa.table(columns | {c: pa.array([None] * len(rows), pa.string()) for c in ("vec", "score", "rank")})


def brute(vectors, labels, ids, every=100):
    """The contract word for word, in Python's whole numbers."""
    rows = {}
    for v, label, i in zip(vectors, labels, ids, strict=True):
        if v is None or label is None or i is None or any(x is None or not math.isfinite(x * 256) for x in v):
            continue
        new = ((label + 1) % 10 if i % 7 == 0 else label, list(v))
        rows[i] = min(rows.get(i, new), new)
    q = {i: [math.floor(256 * x) for x in v] for i, (_, v) in rows.items()}
    held = lambda s: max(min(s, 2**63 - 1), -(2**63 - 2))
    out = set()
    for a in rows:
        if a % every:
            continue
        line = sorted((-held(sum(x * y for x, y in zip(q[a], q[b], strict=False))), b) for b in rows if b != a)
        same, other = [x for x in line if rows[x[1]][0] == rows[a][0]], [x for x in line if rows[x[1]][0] != rows[a][0]]
        for s, p in same[:5]:
            fits = [(n, m) for n, m in other if 80 * -s <= 100 * -n <= 100 * -s]
            out |= {(a, p, k + 1, m, -s, -n) for k, (n, m) in enumerate(fits[:5])}
    return out


def got(df):
    rows = [tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture
def vectors():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((1_500, 6)).round(1)  # many ties
    x[300:700] = x[300]  # a large group of copies
    return x.tolist(), rng.choice([0, 0, 0, 1, 2, 9], 1_500).tolist()


def test_all_rows_against_brute_force(spark, folder, vectors):
    x, labels = vectors
    sf = folder(embeddings=table(x, labels))
    want = brute(x, labels, range(len(x)))
    assert len(want) > 100
    assert got(hn.op12_hard_negatives(spark, sf).repartition(3)) == want


def test_segments_and_blocks_change_nothing(spark, folder, vectors, monkeypatch):
    x, labels = vectors
    rows = spark.read.parquet(folder(embeddings=table(x, labels)) + "/embeddings.parquet").repartition(5)
    monkeypatch.setattr(hn, "SEGMENT_BYTES", 900)
    assert got(hn.mine(hn.prepared(rows, hn.relabelled()), F.col("vec_id") % 100 == 0)) == brute(x, labels, range(len(x)))
    # small blocks, in this process
    monkeypatch.setattr(hn, "ROW_BLOCK", 7)
    monkeypatch.setattr(hn, "ANCHOR_BLOCK", 2)
    batch = pa.record_batch([pa.array(range(50, 0, -1)), pa.array([k % 3 for k in range(50)]), pa.array(x[:50])], ["vec_id", "label", "vec"])
    anchors = hn.Anchors(pa.Table.from_batches([batch.slice(0, 5)]))
    whole = {(b, i) for block, ids, _, s in hn._blocks(iter([batch]), anchors) for b, r in zip(range(50)[block], s, strict=False) for i, v in zip(ids.tolist(), r.tolist(), strict=True) if v > hn.NONE}
    assert whole == {(b, i) for b in range(5) for i in range(1, 51) if i != 50 - b}


def test_odd_rows(spark, folder):
    big = 1e300
    x = [[1, 2], [1, 2], None, [1, None], [1, math.nan], [math.inf, 1], [], [1, 2, 3], [2.5, -1], [big, big], [-big, big], [1, 1], [1, 2], [0, 0], [3, 1], [2, 2], [-1, -1], [2, 0], [1, 3]]
    labels = [1, 1, 1, 1, 1, 1, 1, 2, 2, 2, 1, None, 1, 1, 2, 1, 2, 2, 1]
    ids = [100, 200, 300, 4, 5, 6, 8, 9, 10, 11, 12, 13, None, 0, 15, 16, 16, 17, 100]
    want = brute(x, labels, ids)
    assert {a for a, *_ in want} == {0, 100, 200}
    assert got(hn.op12_hard_negatives(spark, folder(embeddings=table(x, labels, ids)))) == want
    for none in (table([], []), table([[1.0]], [1], [100]), table([[1.0], [2.0]], [1, 1], [100, 200])):
        empty = hn.op12_hard_negatives(spark, folder(embeddings=none))
        assert empty.count() == 0 and len(empty.columns) == 6


def test_other_numbers_and_shares(spark, folder, vectors):
    x, labels = vectors
    rows = spark.read.parquet(folder(embeddings=table(x[:80], labels[:80])) + "/embeddings.parquet")
    found = hn.mine(hn.prepared(rows), F.col("vec_id") == 3, positives=2, negatives=40, share=Fraction(-1, 3)).collect()
    assert found and all(-r["positive_score"] <= 3 * r["negative_score"] and r["negative_score"] <= r["positive_score"] for r in found)
