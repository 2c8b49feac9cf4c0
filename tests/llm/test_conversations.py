import hashlib
import random
import re
import zlib
from functools import cache

import pyarrow as pa
import pytest

from lumenforge.llm import conversations as cv
from tests.llm.conftest import SMALL

COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def brute(rows):
    """The contract word for word: all edits of every row, cheapest first, then ASCII-least."""
    after, everyone = {}, {c for c, *_ in rows}
    for c, t, role, text in rows:
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        after.setdefault(c, []).extend([(t, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1))
    out = set()
    for c in everyone:
        turns = sorted(after.get(c, []), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        faults, seen = [], set()
        for _, role, text in turns:
            body = re.sub("[\x20\x09-\x0d]", "", text)
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [r[1][:1] for r in turns]

        @cache
        def best(k, said, new=0, turns=tuple(turns), faults=tuple(faults)):
            """(cost, letters, turns said) from row k on, after the initials `said` in short: "", "s", "u" or "a"; new: inserted in a row."""
            options = []
            legal = {"": "su", "s": "u", "u": "a", "a": "u"}[said]
            written = legal[-1]
            full = {"u": "user", "a": "assistant"}[written]
            if new < 3:
                cost, letters, lines = best(k, written, new + 1)
                options.append((cost + 3, "I" + letters, (full + ":", *lines)))
            if k == len(turns):
                if said in ("", "a"):
                    options.append((0, "", ()))
                return min(options) if options else (10**6, "", ())
            _, role, text = turns[k]
            cost, letters, lines = best(k + 1, said)
            options.append((cost + 4, "D" + letters, lines))
            if faults[k] not in ("blank", "duplicate"):
                more = 3 * (faults[k] == "truncated")
                if role[:1] and role[:1] in legal:
                    cost, letters, lines = best(k + 1, role[:1])
                    options.append((cost + more, "K" + letters, (f"{role}:{text}", *lines)))
                cost, letters, lines = best(k + 1, written)
                options.append((cost + more + 3, "R" + letters, (f"{full}:{text}", *lines)))
            return min(options)

        cost, letters, lines = best(0, "")
        known = [t for t, _, _ in turns if t is not None]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out.add((c, max(known) - min(known) + 1 - len(set(known)) if known else 0, *counts, illegal, cost, letters, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def table(rows):
    names = [("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]
    out = pa.table({n: pa.array([r[k] for r in rows], t) for k, (n, t) in enumerate(names)})
    for clash in ("kind", "fault", "copies", "cost"):
        out = out.append_column(clash, pa.array([7] * len(rows)))
    return out


def got(df):
    rows = [tuple(r) for r in df.select(*COLUMNS).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture
def rows():
    pick = random.Random(4)
    said = ["Yes.", "No", "Why?", " ", "", None, "So! \n", "a ", ". ", "x.\x0b", "é.", "word" * 9]
    who = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "u2", "Assistant", " system"]
    out = []
    for c in range(400):
        turns = pick.choice([1, 2, 3, 5, 8, 13, 21])
        wild = pick.random()
        for t in range(turns):
            role = pick.choice(who) if pick.random() < wild else ("user", "assistant")[t % 2]
            turn = t if pick.random() < 0.9 else pick.choice([None, 0, t * 3])
            out.append((c if c else None, turn, role, pick.choice(said)))
    pick.shuffle(out)
    return out


def test_all_conversations_against_brute_force(spark, folder, rows, monkeypatch):
    want = brute(rows)
    sf = folder(conversations=table(rows))
    assert got(cv.op11_conversation_repair(spark, sf)) == want
    assert {set(w[7]) <= set("DIKR") for w in want} == {True} and {letter for w in want for letter in w[7]} == set("DIKR")
    # small blocks, in this process: conversations cut by batches come out whole
    sorted_rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    batches = pa.table({"conv_id": pa.array([r[0] for r in sorted_rows], pa.int64()), "n": pa.array(range(len(rows)))}).to_batches(max_chunksize=6)
    for size in (1, 10, 10**6):
        monkeypatch.setattr(cv, "BLOCK_ROWS", size)
        runs = [t.to_pydict() for t in cv._runs(iter(batches))]
        assert [n for t in runs for n in t["n"]] == list(range(len(rows)))
        ids = [set(t["conv_id"]) for t in runs]
        assert sum(map(len, ids)) == len(set().union(*ids)) == 400


def test_given_conversations(spark):
    want = brute([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect()])
    assert got(cv.op11_conversation_repair(spark, SMALL)) == want


def test_odd_conversations(spark, folder):
    assert got(cv.op11_conversation_repair(spark, folder(conversations=table([])))) == set()
    gone = next(c for c in range(1_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    long = [(5_000, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(600)]
    same = [(6_000, 3, "user", "Again.")] * 50
    nothing = [(None, None, None, None)] * 3
    wide = [(7_000, 0, "system", "w" * 2_000_000 + "."), (7_000, -9, "user", "x. " * 400_000)]
    rows = [(gone, 0, "user", "Hello."), *long, *same, *nothing, *wide]
    found = {r[0]: r for r in got(cv.op11_conversation_repair(spark, folder(conversations=table(rows))))}
    want = {r[0]: r for r in brute([r for r in rows if r[0] != 5_000])}
    assert {k: v for k, v in found.items() if k != 5_000} == want
    assert want[gone][1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert found[5_000][6] > 0 and len(found[5_000][7]) >= 500
    # the operator without the faults of the query: nothing to mend, nothing changed
    whole = spark.createDataFrame([("a", t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(6)], "conv_id string, turn int, role string, text string")
    one = cv.repaired(whole).first()
    lines = "\n".join(f"{('user', 'assistant')[t % 2]}:turn {t}." for t in range(6))
    assert (one["conv_id"], one["cost"], one["audit"], one["repaired_sha256"]) == ("a", 0, "KKKKKK", hashlib.sha256(lines.encode()).hexdigest())
