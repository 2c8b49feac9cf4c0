"""Operator 7: sharding by balanced label propagation.

Documents of a group (equal texts, or any other link column) are linked. Every row starts in a shard by hash. Each round, a
group wants to be where most of its rows already are; rows outside want to move there, and so many of them move from shard a
to shard b as its quota allows: those that room below the capacity admits and those that rows moving the other way replace.
Unlinked rows have no wish, and take part as the other half of such exchanges. Then the surplus of overfull shards,
the rows that cut fewest links first, goes to the underfull ones until counts are at most one apart (law `rows`).

A group of more rows than BLOCK_SHARE of a shard is linked in blocks of at most that size, dealt by hash, so a third of all rows
being one text neither overfills a shard nor is bound to one. Joins on groups and blocks never gather a large one either: those
of more than one in HEAVY rows, of which there are at most HEAVY, are broadcast to the rows where they lie, and only rows of the
others are shuffled. What reaches the driver are tables of shards by shards.

Null texts have size 1 and are unlinked; so are rows whose text nobody else has. Rows with null or repeated doc_id are placed each on its
own. Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumenforge.llm.shared import input_partitions, offsets_by_part, removed, table, written

SHARDS = 8
ROUNDS = 3
#: A group's rows are linked in blocks of at most this share of a shard.
BLOCK_SHARE = 0.5
#: A group or block of more rows than this part of all is joined by broadcast; there can be no more of them than this.
HEAVY = 4_096


def _by_shard(shards: int, values: dict[int, int], key) -> F.Column:
    """A small table as an expression."""
    items = [x for s in range(shards) for x in (F.lit(s), F.lit(int(values.get(s, 0))))]
    return F.create_map(*items)[key]


def met(rows: DataFrame, facts: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """rows joined with facts, which has one row a key, of `size` rows among the `total`."""
    heavy = F.broadcast(facts.filter(F.col(size) * HEAVY > total))
    rest = rows.join(F.broadcast(heavy.select(*keys)), keys, "left_anti").join(facts.filter(F.col(size) * HEAVY <= total), keys)
    return rows.join(heavy, keys).unionByName(rest)


def linked_rows(docs: DataFrame) -> DataFrame:
    """doc_id, uid, size, text_crc32, and the link: a 128-bit hash of the text, null for null texts."""
    body = F.col("text").cast("binary")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("uid"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(body, F.lit(b""))).alias("text_crc32"),
        F.when(F.col("text").isNotNull(), F.md5(body)).alias("link"),
    )


def propagated(rows: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """rows (uid, link; a written table) with `block` (null: unlinked), `shard` after the rounds and `loss`, the links a move would cut."""
    n = rows.count()
    block_rows = max(2, int(BLOCK_SHARE * n / shards))
    capacity = -(-n // shards)
    groups = rows.filter(F.col("link").isNotNull()).groupBy("link").agg(F.count("*").alias("n")).filter("n > 1").withColumn("blocks", F.ceil(F.col("n") / block_rows))
    block = F.xxhash64("link", F.pmod(F.xxhash64("uid", F.lit(1)), F.col("blocks")))
    groups = written(groups, "groups")
    shared = met(rows.filter(F.col("link").isNotNull()), groups, ["link"], "n", n).select(*rows.columns, block.alias("block"))
    alone = rows.join(F.broadcast(groups.filter(F.col("n") * HEAVY > n).select("link")), "link", "left_anti").join(groups.select("link"), "link", "left_anti")
    placed = shared.unionByName(alone.select(*rows.columns, F.lit(None).cast("long").alias("block")))
    placed = written(placed.withColumn("shard", F.pmod(F.xxhash64("uid"), F.lit(shards)).cast("int")).drop("link"), "placed")
    removed(groups)
    for turn in range(rounds):
        by_block = placed.filter(F.col("block").isNotNull()).groupBy("block", "shard").agg(F.count("*").alias("n"))
        # the shard with most of a block's rows, ties to one dealt by the block's hash so that small blocks don't all go to shard 0
        wish = by_block.groupBy("block").agg(F.max_by("shard", F.struct("n", F.pmod(F.xxhash64("block", "shard"), F.lit(1 << 30)))).alias("want"), F.sum("n").alias("n"))
        linked = met(placed.filter(F.col("block").isNotNull()), wish, ["block"], "n", n).select(*placed.columns, "want")
        wished = linked.unionByName(placed.filter(F.col("block").isNull()).withColumn("want", F.col("shard")))
        flows = {(r["shard"], r["want"]): (r["n"], r["free"]) for r in wished.groupBy("shard", "want").agg(F.count("*").alias("n"), F.count_if(F.col("block").isNull()).alias("free")).collect()}
        held = {s: sum(c for (a, _), (c, _) in flows.items() if a == s) for s in range(shards)}
        spare = {s: flows.get((s, s), (0, 0))[1] for s in range(shards)}  # unlinked rows
        # all wishes are granted whose surplus can go back as unlinked rows; else the same share of each wish into a shard
        share = {}
        for b in range(shards):
            into = sum(c for (a, w), (c, _) in flows.items() if w == b and a != b)
            out = sum(c for (a, w), (c, _) in flows.items() if a == b and w != b)
            room = max(0, capacity - held[b]) + out + spare[b]
            share[b] = 1.0 if into <= room else room / into
        lucky = F.pmod(F.xxhash64("uid", F.lit(turn)), F.lit(1_000_000)) < _by_shard(shards, {b: int(1_000_000 * x) for b, x in share.items()}, F.col("want"))
        last = placed
        placed = written(wished.withColumn("shard", F.when(lucky, F.col("want")).otherwise(F.col("shard"))).drop("want"), "placed")
        removed(last)
    # what a row's leaving would cut: its block's rows beside it; the rest of the block stays
    together = placed.filter(F.col("block").isNotNull()).groupBy("block", "shard").agg((F.count("*") - 1).alias("loss"))
    linked = met(placed.filter(F.col("block").isNotNull()), together, ["block", "shard"], "loss", n).select(*placed.columns, "loss")
    return linked.unionByName(placed.filter(F.col("block").isNull()).withColumn("loss", F.lit(0).cast("long")))


def ranked(rows: DataFrame, within: str, *order: str, alias: str) -> DataFrame:
    """rows with their place (from 0) within each value of `within`, by range partitions and a small table of their sizes."""
    parted = rows.repartitionByRange(max(1, input_partitions(rows)), within, *order).withColumn("range", F.spark_partition_id())
    parted = written(parted, "ranges")
    w = Window.partitionBy("range", within).orderBy(*order)
    counts = offsets_by_part(parted.groupBy("range", within).agg(F.count("*").alias("n")), "range", "n", "before", (within,)).select("range", within, "before")
    return parted.withColumn("nth", F.row_number().over(w) - 1).join(F.broadcast(counts), ["range", within]).withColumn(alias, F.col("before") + F.col("nth")).drop("range", "before", "nth")


def balanced(placed: DataFrame, shards: int = SHARDS) -> DataFrame:
    """placed (shard, loss, uid) with counts at most one apart and a gapless slot in each shard; rows move by least loss."""
    # largest loss first: the rows past the target are those that cut least
    first = ranked(placed.withColumn("keep", -F.col("loss")).withColumn("tie", F.coalesce("block", F.xxhash64("uid"))), "shard", "keep", "tie", "uid", alias="place")
    first = written(first, "places")
    held = {r["shard"]: r["n"] for r in first.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    n = sum(held.values())
    # the larger targets go to the shards that hold most
    target = dict.fromkeys(range(shards), n // shards)
    for s in sorted(range(shards), key=lambda s: (-held.get(s, 0), s))[: n % shards]:
        target[s] += 1
    surplus = {s: max(0, held.get(s, 0) - target[s]) for s in range(shards)}
    before, ends, total = {}, {}, 0
    for s in range(shards):
        before[s] = total
        total += surplus[s]
    total = 0
    for s in range(shards):
        total += max(0, target[s] - held.get(s, 0))
        ends[s] = total
    moves = F.col("place") >= _by_shard(shards, target, F.col("shard"))
    index = _by_shard(shards, before, F.col("shard")) + F.col("place") - _by_shard(shards, target, F.col("shard"))
    to = F.lit(shards - 1)
    for s in reversed(range(shards)):
        to = F.when(index < ends[s], F.lit(s)).otherwise(to)
    begins = {s: (ends[s - 1] if s else 0) - held.get(s, 0) for s in range(shards)}
    out = first.withColumn("moves", moves).withColumn("index", index).withColumn("to", F.when(moves, to).otherwise(F.col("shard")))
    slot = F.when(F.col("moves"), F.col("index") - _by_shard(shards, begins, F.col("to"))).otherwise(F.col("place"))
    return out.withColumn("slot", slot.cast("long")).withColumn("shard", F.col("to").cast("int")).drop("moves", "index", "to", "place", "keep", "tie")


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """docs (doc_id, text) as doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    rows = written(linked_rows(docs), "linked")
    out = balanced(propagated(rows, shards), shards)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_label_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(table(spark, sf_dir, "documents"))
