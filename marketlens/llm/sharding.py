"""Sharding by balanced label propagation.

Documents that share a link key are neighbours; here the key is the text, so
that copies are linked.  Linked documents start evenly spread.  In each round
a document looks for the shard where most of its neighbours are, among its
own and those that can be entered; documents that want to move are numbered
per pair of shards and admitted up to a quota, by which no shard exceeds its
capacity after all moves.  Rounds end when nobody wants to move or after
``rounds``.  Documents without a link fill
the shards up.

Law ``rows``: shard counts are at most one apart.

Groups are never gathered: neighbour counts are partial aggregates (one row
per key and shard), and numbering uses hash buckets.  The driver learns
shards x shards counts a round.

Edge cases: a null text has no link; empty texts are linked with each other;
a group larger than a shard is cut along the shards that have room; where
nearly all documents are linked, few moves fit and more groups stay cut; repeated
rows are documents of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import numbered, running_offsets, text_key
from marketlens.sources.sinks import materialize

SHARDS = 8
ROUNDS = 8


def capacities(rows: int, shards: int) -> list[int]:
    return [rows // shards + (k < rows % shards) for k in range(shards)]


def admit(want: list[list[int]], load: list[int], room: list[int]) -> list[list[int]]:
    """How many of those that want to move from a shard to another may, all
    at once, so that no shard exceeds its room: entries are cut back where
    too many would come in, until all shards fit."""
    quota = [list(w) for w in want]
    shards = range(len(room))
    while True:
        over = [load[k] + sum(q[k] for q in quota) - sum(quota[k]) - room[k] for k in shards]
        k = max(shards, key=lambda k: over[k])
        if over[k] <= 0:
            return quota
        for a in sorted(shards, key=lambda a: -quota[a][k]):
            cut = min(quota[a][k], over[k])
            quota[a][k] -= cut
            over[k] -= cut


def propagate(links: DataFrame, room: list[int], rounds: int = ROUNDS) -> DataFrame:
    """Shards for the linked rows of (row, key): a row may have several keys.

    Returns (row, shard); no shard gets more rows than its ``room``, whose
    sum must be the number of rows at least.
    """
    shards = len(room)
    links = materialize(links)
    nodes = materialize(links.groupBy("row").agg(F.min("key").alias("key")))
    count = nodes.count()
    state = materialize(running_offsets(nodes.withColumn("_all", F.lit(0)), ["_all"], ["row"], count)
                        .select("row", (F.col("_idx") % shards).cast("int").alias("shard")))
    open_ = [True] * shards
    for _ in range(rounds):
        here = links.join(state, "row")
        by_key = (here.groupBy("key", "shard").agg(F.count(F.lit(1)).alias("n"))
                  .groupBy("key").agg(*[F.sum(F.when(F.col("shard") == k, F.col("n")).otherwise(0)).alias(f"n{k}")
                                        for k in range(shards)])
                  .where(F.greatest(*[F.col(f"n{k}") for k in range(shards)])
                         < sum(F.col(f"n{k}") for k in range(shards))))
        votes = (here.join(by_key, "key").groupBy("row", "shard")
                 .agg(*[F.sum(f"n{k}").alias(f"n{k}") for k in range(shards)], F.min("key").alias("key")))
        # ties go one way for all rows of a key, so that neighbours do not swap places
        tie = [F.pmod(F.xxhash64("key", F.lit(k)), F.lit(1 << 20)) for k in range(shards)]
        best = F.array_max(F.array(*[
            F.when((F.col("shard") == k) | F.lit(open_[k]),
                   F.struct(F.col(f"n{k}").alias("n"), tie[k].alias("tie"), F.lit(k).alias("to")))
            for k in range(shards)]))
        wish = votes.select("row", "shard", best["to"].alias("to"), best["n"].alias("n")).where(F.col("to") != F.col("shard"))
        wish = materialize(wish.select("row", F.col("shard").alias("from"), F.col("to").cast("int").alias("to")))
        want = [[0] * shards for _ in range(shards)]
        for r in wish.groupBy("from", "to").agg(F.count(F.lit(1)).alias("n")).collect():
            want[r["from"]][r["to"]] = r["n"]
        movers = sum(map(sum, want))
        if not movers:
            break
        load = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
        quota = admit(want, [load.get(k, 0) for k in range(shards)], room)
        # a shard that nobody can enter any more is not looked at again
        open_ = [open_[k] and (not any(w[k] for w in want) or any(q[k] for q in quota)) for k in range(shards)]
        allowed = F.get(F.get(F.array(*[F.array(*[F.lit(n).cast("long") for n in q]) for q in quota]), F.col("from")), F.col("to"))
        admitted = (running_offsets(wish, ["from", "to"], ["row"], movers)
                    .where(F.col("_idx") < allowed).select("row", F.col("to").alias("moved")))
        state = materialize(state.join(admitted, "row", "left")
                            .select("row", F.coalesce("moved", "shard").alias("shard")))
    return state


def cut_edges(links: DataFrame, state: DataFrame) -> DataFrame:
    """Per key: its rows and the number of shards that they lie in."""
    return (links.join(state, "row").groupBy("key", "shard").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("key").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("shards")))


def shard_rows(items: DataFrame, key: str, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``items`` (a stored table with a unique ``row``) with ``shard`` and the
    gapless ``slot`` in it; rows with an equal, non-null ``key`` are linked."""
    total = items.count()
    room = capacities(total, shards)
    keyed = items.select("row", F.col(key).alias("key")).where(F.col("key").isNotNull())
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("key")
    linked = propagate(keyed.join(shared, "key", "left_semi").select("row", "key"), room, rounds)
    load = {r["shard"]: r["n"] for r in linked.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    rest = materialize(items.select("row").join(linked, "row", "left_anti").withColumn("_all", F.lit(0)))
    left, ends = 0, []
    for k in range(shards):
        left += room[k] - load.get(k, 0)
        ends.append(left)
    bounds = F.array(*[F.lit(e).cast("long") for e in ends])
    fill = running_offsets(rest, ["_all"], ["row"], max(1, total)).select(
        "row", F.size(F.filter(bounds, lambda e: e <= F.col("_idx"))).alias("shard"))
    placed = materialize(items.join(linked.unionByName(fill), "row"))
    return running_offsets(placed, ["shard"], ["row"], max(1, total)).withColumnRenamed("_idx", "slot").drop("_start")


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every document."""
    text = F.col("text")
    items = materialize(docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), text_key(text).alias("text_key")))
    return shard_rows(items, "text_key", shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def shard_stage(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The documents with their shard and slot; columns of these names are replaced."""
    names = [c for c in docs.columns if c not in ("shard", "slot")]
    rowed = numbered(docs)
    items = materialize(rowed.select("row", text_key(F.col("doc.text")).alias("text_key")))
    where = shard_rows(items, "text_key", shards).select("row", "shard", "slot")
    # the hash table is of the numbers: texts are neither sorted nor kept
    return rowed.join(where.hint("shuffle_hash"), "row").select(*[F.col("doc")[c].alias(c) for c in names], "shard", "slot")
