"""Mixing sources to target weights by token blocks.

Every source's documents form one stream of words, cut into blocks of
``block_words``.  A source takes whole passes over its blocks and a part of
one more, together its target number of words.  The output is dealt into
shards: each shard's source counts are a multinomial draw over what the
sources still have to give, so that the totals come out exactly.  The slots
of a source, numbered through all shards, map to block indices by a keyed
pseudorandom permutation of [0, blocks) for each pass, and slots and blocks
are joined by index.

Sources are few (a bounded vocabulary): only one row per source reaches the
driver, and one row per shard and source goes back.

Edge cases: a null source is a source of its own, last in order; a null or
empty text has size 0 and takes nothing; a source without words takes
nothing and gives its share to the others; empty tables give empty results;
repeated rows count as documents of their own; equal seeds give equal mixes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import _WHITE, numbered, running_offsets
from marketlens.sources.sinks import materialize

#: Fixed values of the query: weights by source order, share of all words,
#: and how often a source may be taken.
WEIGHTS = (5, 2, 1)
MIX_PERCENT = 150
MOST_PASSES = 2


@dataclass(frozen=True)
class Settings:
    """``shard_slots`` is the least number of blocks of an output shard; there
    are ``most_shards`` shards at most."""

    block_words: int = 512
    shard_slots: int = 8192
    most_shards: int = 10_000
    seed: int = 11


def word_count(text: Column) -> Column:
    """Number of maximal runs of other characters than ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def share_out(sizes: list[int], weights: list[float], total: float, passes: int = MOST_PASSES) -> list[float]:
    """``total`` shared by weight; no share is above ``passes`` times its
    size, and what that leaves over is shared again among the rest."""
    size, weight = np.array(sizes, dtype=float), np.array(weights, dtype=float)
    out, open_ = np.zeros(len(size)), size > 0
    left = min(float(total), passes * size.sum())
    while open_.any() and left > 0:
        share = np.where(open_, left * weight / weight[open_].sum(), 0.0)
        full = open_ & (share >= passes * size)
        if not full.any():
            out[open_] = share[open_]
            break
        out[full] = passes * size[full]
        left -= out[full].sum()
        open_ &= ~full
    return out.tolist()


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray, inverse: bool = False) -> np.ndarray:
    """Keyed permutation of [0, n), or its inverse: four Feistel rounds over
    the next even number of bits, walked on until the value is below n."""
    bits = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2))).astype(np.int64) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << bits) - np.uint64(1)
    value, limit, key = index.astype(np.uint64).copy(), n.astype(np.uint64), key.astype(np.uint64)

    def noise(half: np.ndarray, k: np.ndarray, turn: int) -> np.ndarray:
        mixed = (half + k + np.uint64(turn * 0x632BE5AB)) * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)

    walking = np.ones(len(value), dtype=bool)
    while walking.any():
        v, b, m, k = value[walking], bits[walking], mask[walking], key[walking]
        left, right = v >> b, v & m
        for turn in range(4):
            if inverse:
                left, right = right ^ (noise(left, k, 3 - turn) & m), left
            else:
                left, right = right, left ^ (noise(right, k, turn) & m)
        value[walking] = (left << b) | right
        walking = value >= limit
    return value.astype(np.int64)


def _pass_key(source, pass_no, seed: int):
    return ((source + 1) * 1_000_003 + pass_no) * 7919 + seed


def _slots(size: int, taken: int, source: int, s: Settings) -> tuple[int, int]:
    """Number of slots that hold exactly ``taken`` words, and the words of
    the last one that count.  The stream's last block may be short."""
    blocks = -(-size // s.block_words)
    passes, rest = divmod(taken, size) if size else (0, 0)
    if not rest:
        return passes * blocks, s.block_words
    short = size - (blocks - 1) * s.block_words
    at = int(permuted(np.array([blocks - 1]), np.array([blocks]), np.array([_pass_key(source, passes, s.seed)]), True)[0])
    if at * s.block_words < rest:  # the short block is among them: its gap is filled by those that follow
        if rest <= at * s.block_words + short:
            return passes * blocks + at + 1, rest - at * s.block_words
        rest += s.block_words - short
    count = -(-rest // s.block_words)
    return passes * blocks + count, rest - (count - 1) * s.block_words


def _shard_counts(slots: np.ndarray, s: Settings) -> list[np.ndarray]:
    """Source counts of each shard: multinomial by what is left, cut at what is left."""
    rng, left, out = np.random.default_rng(s.seed), slots.astype(np.int64).copy(), []
    size = max(s.shard_slots, -(-int(left.sum()) // s.most_shards))
    while left.sum() > 0:
        want, got = min(size, int(left.sum())), np.zeros(len(left), dtype=np.int64)
        while want:
            rest = left - got
            draw = np.minimum(rng.multinomial(want, rest / rest.sum()), rest)
            got += draw
            want -= int(draw.sum())
        out.append(got)
        left -= got
    return out


def source_targets(sizes: DataFrame) -> list[dict]:
    """One entry per source of (source, size): its size and target."""
    rows = sizes.groupBy("source").agg(F.sum("size").alias("size")).collect()
    rows = sorted(rows, key=lambda r: (r["source"] is None, r["source"] or ""))
    total = [int(r["size"] or 0) for r in rows]
    weights = [WEIGHTS[k % len(WEIGHTS)] for k in range(len(rows))]
    targets = share_out(total, weights, sum(total) * MIX_PERCENT / 100)
    return [{"source": r["source"], "number": k, "size": n, "target": t}
            for k, (r, n, t) in enumerate(zip(rows, total, targets))]


def mix_slots(spark, targets: list[dict], s: Settings = Settings()) -> DataFrame:
    """The mix: shard, position (within shard and source), source number,
    block index and the words of the block that count (from its start)."""
    planned = [_slots(t["size"], int(round(t["target"])), t["number"], s) for t in targets]
    counts = _shard_counts(np.array([n for n, _ in planned], dtype=np.int64), s) if targets else []
    begun, plan = np.zeros(len(targets), dtype=np.int64), []
    for shard, got in enumerate(counts):
        plan += [(shard, t["number"], int(begun[k]), int(got[k]), -(-t["size"] // s.block_words), *planned[k])
                 for k, t in enumerate(targets) if got[k]]
        begun += got
    plan = spark.createDataFrame(plan, "shard int, number int, begun long, n long, blocks long, slots long, last_words long")

    @F.pandas_udf("long")
    def block_of(number: pd.Series, slot: pd.Series, blocks: pd.Series) -> pd.Series:
        turn = (slot // blocks).to_numpy()
        return pd.Series(permuted((slot % blocks).to_numpy(), blocks.to_numpy(),
                                  _pass_key(number.to_numpy().astype(np.int64), turn, s.seed)))

    slots = plan.select("shard", "number", "blocks", "slots", "last_words",
                        F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("position"), "begun")
    slots = slots.withColumn("slot", F.col("begun") + F.col("position"))
    return slots.select("shard", "position", "number", block_of("number", "slot", "blocks").alias("block"),
                        F.when(F.col("slot") == F.col("slots") - 1, F.col("last_words"))
                        .otherwise(s.block_words).alias("words"))


def _taken_spans(docs: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """For (doc_id, source, text): the placed documents, and the parts of them
    that the mix takes: number, place, low and high (words of the document,
    high exclusive) and times."""
    spark = docs.sparkSession
    sized = materialize(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    targets = source_targets(sized)
    numbers = spark.createDataFrame([(t["source"], t["number"], t["size"], float(t["target"])) for t in targets],
                                    "source string, number int, source_size long, target double")
    numbered = (sized.withColumnRenamed("source", "_source")
                .join(F.broadcast(numbers), F.col("_source").eqNullSafe(F.col("source"))).drop("_source"))
    placed = materialize(running_offsets(numbered, ["number"], ["doc_id", "size"], sized.count(), "size")
                         .withColumnRenamed("_start", "start").withColumnRenamed("_idx", "place"))
    width = F.lit(s.block_words).cast("long")
    end = F.col("start") + F.col("size")
    spans = (placed.where(F.col("size") > 0)
             .select("number", "place", "start", end.alias("end"),
                     F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((end - 1) / width))).alias("block"))
             .select("number", "place", "block", "start",
                     F.greatest(F.col("start") - F.col("block") * width, F.lit(0)).alias("from_word"),
                     F.least(F.col("end") - F.col("block") * width, width).alias("to_word")))
    uses = mix_slots(spark, targets, s).groupBy("number", "block", "words").agg(F.count(F.lit(1)).alias("times"))
    before = F.col("block") * width - F.col("start")
    taken = (spans.join(uses, ["number", "block"]).where(F.least("to_word", "words") > F.col("from_word"))
             .select("number", "place", (before + F.col("from_word")).alias("low"),
                     (before + F.least("to_word", "words")).alias("high"), "times"))
    return placed, taken


def mix_documents(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """doc_id, size, source_size, target, taken for every document."""
    placed, spans = _taken_spans(docs, s)
    taken = spans.groupBy("number", "place").agg(F.sum((F.col("high") - F.col("low")) * F.col("times")).alias("taken"))
    return (placed.join(taken, ["number", "place"], "left")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def _uses(spans: list[tuple[int, int, int]], size: int) -> list[list[tuple[int, int]]]:
    """The word ranges of each use of a document: the first holds the words
    taken at least once, the second those taken twice.  There are as many
    uses as the taken words are nearest to, one at least; what is beyond
    them follows in the last."""
    edge: dict[int, int] = {}
    for low, high, times in spans:
        edge[low] = edge.get(low, 0) + times
        edge[high] = edge.get(high, 0) - times
    layers: list[list[tuple[int, int]]] = []
    depth, last, total = 0, 0, 0
    for at in sorted(edge):
        for layer in layers[:depth]:
            if layer and layer[-1][1] == last:
                layer[-1] = layer[-1][0], at
            else:
                layer.append((last, at))
        total += depth * (at - last)
        depth, last = depth + edge[at], at
        layers += [[] for _ in range(depth - len(layers))]
    n = max(1, int(total / size + 0.5))
    return layers[:n - 1] + [[r for layer in layers[n - 1:] for r in layer]]


def _cut(text: str, ranges: list[tuple[int, int]], size: int) -> str:
    """The words of the ranges as they stand in the text, ranges parted by
    line ends; a text that is taken whole stays as it is."""
    if ranges == [(0, size)]:
        return text
    data = text.encode()
    inside = np.concatenate([[False], ~_WHITE[np.frombuffer(data, np.uint8)], [False]])
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = turns[::2], turns[1::2]
    return "\n".join(text if r == (0, size) else data[begin[r[0]]:end[r[1] - 1]].decode() for r in ranges)


def mix_stage(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The words that the mix takes, as documents with all their columns.  A
    document comes once, or twice where its taken words are nearer to two
    times its size; its text is cut to the words that the use takes, and
    ``n_chars`` follows the text.  Each source's words are its target."""
    stored = numbered(docs)
    placed, spans = _taken_spans(stored.select(F.col("row").alias("doc_id"), "doc.source", "doc.text"), s)
    rows = (spans.groupBy("number", "place").agg(F.collect_list(F.struct("low", "high", "times")).alias("spans"))
            .join(placed, ["number", "place"]).select(F.col("doc_id").alias("row"), "size", "spans"))

    @F.arrow_udf("array<string>")
    def used(texts: pa.Array, sizes: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for text, size, parts in zip(texts, sizes.to_pylist(), spans.to_pylist()):
            uses = _uses([(p["low"], p["high"], p["times"]) for p in parts], size)
            text = text.as_py()
            out.append([_cut(text, ranges, size) for ranges in uses])
        return pa.array(out, pa.list_(pa.string()))

    # the hash table is of the numbers: texts are neither sorted nor kept
    copies = (stored.join(rows.hint("shuffle_hash"), "row")
              .select("doc", F.explode(used(F.col("doc.text"), F.col("size"), F.col("spans"))).alias("use")))
    changed = {"text": F.col("use"), "n_chars": F.length("use").cast(dict(docs.dtypes).get("n_chars", "long"))}
    return copies.select(*[changed.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])
