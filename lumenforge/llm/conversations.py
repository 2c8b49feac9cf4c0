"""Operator 11: repair of conversations by a dynamic program over turns, for many conversations at once.

A conversation is right if its roles' initials read (s?(ua)+)?. An automaton of four states says how far one has come: nothing yet,
after the system's turn, after a user's, after an assistant's. Rows are kept (K), given another role (R) or deleted (D), and turns
without text are inserted (I). Given the state, the letter says all else: what R and I write follows from the state.

Conversations are dealt by id, each task reads its own in order, some BLOCK_ROWS rows at once, and puts those of like length (within
a power of two) into one bucket: arrays with the turn as first axis, then the state, then the conversation. Going back from the last
turn, one NumPy step a turn finds the cost to the end of every state of all the bucket's conversations. They are kept in a byte
each: costs above the least of their turn, which never differ by more than a few edits, and the steps of that least. The trace goes
forward, again a step a turn for all conversations: of the letters that lead on at the stored cost it takes the ASCII-least, so
the edits are the least text of all cheapest.

A task holds the rows of a block, and of the one conversation that it cuts; a conversation is read by one task, since the hash of its
repaired text goes through it from the start. What is not bounded here is the length of a single conversation.

What odd rows give. Turns sort with nulls first; rows of one turn by role, then text. A null id is a conversation like others; null
roles and texts count as one space; roles whose initial is none of s, u, a are rewritten or deleted. Repeated rows are
duplicates. An empty table has no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenforge.llm.shared import table

BLOCK_ROWS, BLOCK_BYTES = 20_000, 16 << 20
WHITE = " \t\n\v\f\r"
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
#: Costs of edits.
REROLE, DELETE, INSERT, UNENDED = 3, 4, 3, 3
#: Kinds of rows: system, user, assistant, other, and the filling behind a shorter conversation's end.
OTHER, PAD = 3, 4
#: States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant. Where a kept row of each kind leads (-1: nowhere), and where a
#: written turn leads: to a user's (2) or an assistant's (3).
KEPT = np.array([[1, -1, -1, -1], [2, 2, -1, 2], [-1, -1, 3, -1], [-1] * 4, [-1] * 4], np.int8)
WRITTEN = np.array([2, 2, 3, 2], np.int8)
#: What the end costs: 1 and 2 have turns to be inserted.
ENDS = np.array([0, 2 * INSERT, INSERT, 0], np.int8)
FAR = np.int8(64)

OUT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def damaged(rows: DataFrame) -> DataFrame:
    """rows with the faults of op11_conversation_repair, told by the checksum of id and turn, and `copies`: how often each is there."""
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn"))) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate(or_space("text"), ".!?", "")).otherwise(or_space("text"))
    role = F.when(fault == 4, "user").otherwise(or_space("role"))
    # a dropped row only tells that its conversation was there
    there = fault != 0
    copies = F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).cast("byte")
    return rows.select("conv_id", "turn", F.when(there, role).alias("role"), F.when(there, text).alias("text"), copies.alias("copies"))


def backward(kinds: np.ndarray, lost: np.ndarray, unended: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """kinds, lost (must be deleted), unended: (turns, conversations). The cost to the end from before each turn, by turn, state and
    conversation, above the least of the turn; and by how much that least grows a turn."""
    turns, n = kinds.shape
    above, steps = np.zeros((turns + 1, 4, n), np.int8), np.zeros((turns, n), np.int8)
    above[turns] = ENDS[:, None]
    at = np.arange(n)
    for t in range(turns - 1, -1, -1):
        after, extra = above[t + 1], unended[t] * np.int8(UNENDED)
        to = KEPT[kinds[t]].T
        keep = np.where((to >= 0) & ~lost[t], after[to, at] + extra, FAR)
        rewrite = np.where(lost[t], FAR, after[WRITTEN] + extra + np.int8(REROLE))
        row = np.minimum(np.minimum(keep, rewrite), after + np.int8(DELETE))
        # up to two inserted turns before the row: a third leads back
        row = np.minimum(row, np.minimum(row[WRITTEN] + np.int8(INSERT), row[WRITTEN[WRITTEN]] + np.int8(2 * INSERT)))
        row = np.where(kinds[t] == PAD, after, row)
        steps[t] = row.min(axis=0)
        above[t] = row - steps[t]
    return above, steps


def trace(kinds: np.ndarray, lost: np.ndarray, unended: np.ndarray, above: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(letters, roles): by turn, place in the turn (two inserted turns, then the row; a last turn has what is inserted at the end)
    and conversation. letters: ASCII or 0; roles: 0 none or as it was, 2 user, 3 assistant."""
    turns, n = kinds.shape
    letters, roles = np.zeros((turns + 1, 3, n), np.uint8), np.zeros((turns + 1, 3, n), np.int8)
    state, at = np.zeros(n, np.int8), np.arange(n)
    for t in range(turns):
        going = kinds[t] != PAD
        after, here, extra = above[t + 1], above[t] + steps[t], unended[t] * np.int8(UNENDED)
        for place in range(3):
            cost, new = here[state, at], WRITTEN[state]
            delete = going & (cost == after[state, at] + DELETE)
            insert = going & ~delete & (cost == here[new, at] + INSERT)
            to = KEPT[kinds[t], state]
            keep = going & ~delete & ~insert & ~lost[t] & (to >= 0) & (cost == after[to, at] + extra)
            rewrite = going & ~delete & ~insert & ~keep
            row = ~insert & going
            for chosen, letter in ((delete, "D"), (keep, "K"), (rewrite, "R")):
                letters[t, 2, chosen] = ord(letter)
            letters[t, min(place, 1), insert] = ord("I")
            roles[t, min(place, 1), insert] = new[insert]
            roles[t, 2, rewrite & row] = new[rewrite & row]
            state = np.where(keep, to, np.where(insert | rewrite, new, state))
            going = insert
    for place in range(2):
        insert = (state == 1) | (state == 2)
        letters[turns, place, insert], roles[turns, place, insert] = ord("I"), WRITTEN[state][insert]
        state = np.where(insert, WRITTEN[state], state)
    return letters, roles


def _first_rows(ids: pa.Array) -> np.ndarray:
    """Where a run of equal ids begins; nulls are equal."""
    n = len(ids)
    if not n:
        return np.zeros(0, np.int64)
    a, b = ids.slice(1), ids.slice(0, n - 1)
    other = pc.or_(pc.xor(a.is_null(), b.is_null()), pc.fill_null(pc.not_equal(a, b), False))
    return np.concatenate([[0], 1 + np.flatnonzero(other.to_numpy(zero_copy_only=False))])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole conversations from sorted batches."""
    held: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        cut = int(_first_rows(batch.column(0))[-1])
        if not cut and held and not batch.column(0)[0].equals(held[-1].column(0)[-1]):
            cut = -1  # the whole batch is one conversation, and another than those held
        if cut and (rows + batch.num_rows >= BLOCK_ROWS or size + batch.nbytes >= BLOCK_BYTES):
            cut = max(cut, 0)
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held, rows, size = [], 0, 0
            batch = batch.slice(cut)
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
    if held:
        yield pa.Table.from_batches(held)


def _codes(array: pa.Array) -> np.ndarray:
    return array.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _gaps(turns: pa.Array, owner: np.ndarray, n: int) -> np.ndarray:
    """Turns that lie between a conversation's least and greatest and are not there."""
    known = turns.is_valid().to_numpy(zero_copy_only=False)
    turn, owner = turns.drop_null().to_numpy(), owner[known]
    out = np.zeros(n, np.int64)
    if len(turn):
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        last = np.append(first[1:], len(owner)) - 1
        new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (turn[1:] != turn[:-1])])
        out[owner[first]] = turn[last] - turn[first] + 1 - np.add.reduceat(new, first)
    return out


def repaired_block(rows: pa.Table) -> pa.RecordBatch:
    """One row a conversation of a table of whole ones (conv_id, turn, role, text, copies, kind, fault), in order."""
    rows = rows.combine_chunks()
    get = lambda c: rows[c].combine_chunks() if isinstance(rows[c], pa.ChunkedArray) else rows[c]
    starts = _first_rows(get("conv_id"))
    n = len(starts)
    owner = np.repeat(np.arange(n), np.diff(np.append(starts, rows.num_rows)))
    # from here on each row as often as it is there
    place = np.repeat(np.arange(rows.num_rows), get("copies").to_numpy())
    owner = owner[place]
    length = np.bincount(owner, minlength=n)
    begin = np.cumsum(length) - length
    kind, fault = get("kind").to_numpy()[place], get("fault").to_numpy()[place]
    text = _codes(get("text"))
    said = np.unique((_codes(get("role")) * (text.max(initial=0) + 1) + text)[place], return_inverse=True)[1]
    again = np.ones(len(place), bool)
    again[np.unique(owner * (len(place) + 1) + said, return_index=True)[1]] = False
    fault = np.where(again & (fault != BLANK), DUPLICATE, fault)
    counts = {name: np.bincount(owner[fault == k], minlength=n) for name, k in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", TRUNCATED))}
    pair = (owner[1:] == owner[:-1]) & (KEPT[kind[1:], np.array([1, 2, 3, 0, 0])[kind[:-1]]] < 0)
    # after a system, user or assistant turn, su, ua and au are just what may be kept; after other kinds nothing is legal
    pair |= (owner[1:] == owner[:-1]) & (kind[:-1] >= OTHER)
    illegal = np.bincount(owner[1:][pair], minlength=n)
    cost, audits, hashes = np.zeros(n, np.int64), [""] * n, [hashlib.sha256(b"").hexdigest()] * n
    roles, texts = get("role").to_pylist(), get("text").to_pylist()
    bucket = np.frexp(length - 0.5)[1]  # lengths of one power of two; those without rows are left out
    for b in np.unique(bucket[length > 0]):
        some = np.flatnonzero((bucket == b) & (length > 0))
        turns = int(length[some].max())
        at = begin[some] + np.arange(turns)[:, None]
        inside = np.arange(turns)[:, None] < length[some]
        at = np.where(inside, at, 0)
        kinds = np.where(inside, kind[at], PAD)
        lost, unended = np.isin(fault[at], (BLANK, DUPLICATE)), fault[at] == TRUNCATED
        above, steps = backward(kinds, lost, unended)
        letters, written = trace(kinds, lost, unended, above, steps)
        cost[some] = steps.sum(axis=0, dtype=np.int64) + above[0, 0]
        # conversation by conversation now
        letters, written = letters.reshape(-1, len(some)).T, written.reshape(-1, len(some)).T
        for j, c in enumerate(some):
            edits = np.flatnonzero(letters[j])
            audits[c] = letters[j, edits].tobytes().decode()
            hashed, first = hashlib.sha256(), True
            for e in edits[letters[j, edits] != ord("D")]:
                row = place[at[e // 3, j]] if e % 3 == 2 and e // 3 < turns else None
                who = (b"user", b"assistant")[written[j, e] - 2] if written[j, e] else roles[row]
                hashed.update((b"" if first else b"\n") + who + b":" + (b"" if row is None else texts[row]))
                first = False
            hashes[c] = hashed.hexdigest()
    columns = [get("conv_id").take(pa.array(starts)), pa.array(_gaps(get("turn").take(pa.array(place)), owner, n)), *(pa.array(v.astype(np.int64)) for v in counts.values())]
    columns += [pa.array(illegal.astype(np.int64)), pa.array(cost), pa.array(audits, pa.string()), pa.array(hashes, pa.string())]
    return pa.RecordBatch.from_arrays(columns, ["conv_id", *(c.split()[0] for c in OUT.split(", "))])


def repaired(rows: DataFrame, copies: str | None = None) -> DataFrame:
    """conv_id and the columns of OUT for each conversation of rows (conv_id, turn, role, text). copies: a column that says how often
    a row is there, from 0 on."""
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    role, text = or_space("role"), or_space("text")
    bare = F.rtrim(text, F.lit(WHITE))
    fault = F.when(bare == "", BLANK).when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(0)
    initial = F.left(role, F.lit(1))
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(OTHER)
    times = F.col(copies) if copies else F.lit(1)
    marked = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.cast("binary").alias("role"), text.cast("binary").alias("text"), times.cast("byte").alias("copies"), kind.cast("byte").alias("kind"), fault.cast("byte").alias("fault"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _runs(batches):
            yield repaired_block(whole)

    dealt = marked.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(run, f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, {OUT}")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(damaged(table(spark, sf_dir, "conversations")), "copies")
