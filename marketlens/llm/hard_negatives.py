"""Hard-negative mining by Kronecker-packed products.

Components of several candidate vectors are biased to be non-negative and
laid side by side, as fields, into one wide integer; one multiplication by an
anchor's component then multiplies all of them, and the sum over components
holds the exact inner product of each candidate in its own field.  A field is
as wide as the largest sum that the biased components allow, so that none
overflows into the next.  Where the fields of two or more candidates fit into
53 bits, the wide integer is kept in a double, which holds it exactly, and
the multiplications of a tile run as one matrix product; larger components
use Python's integers with a field for each candidate.  Both are exact.

Anchors are a stated query set against all rows.  They are taken in blocks of
``BLOCK_BYTES``, one on the driver at a time, and each block is scored in two
passes over the candidates: the first finds the positives of each anchor (the
best rows of its label), the second, which knows their scores, the best rows
of other labels inside the range that each positive allows.  Tasks keep the
best rows of an anchor only, so that what is shuffled grows with the anchors
and tasks, not with the pairs.

Of equal vectors of one label only the first ``positives + 1`` by id can be
among the first of any anchor (one of them may be the anchor itself); the
others are left out of the candidates before, which changes no result and
takes the weight off groups of copies.  Every copy may still be an anchor.

Edge cases: rows with a null label or vector, or with a null or non-finite
component, take no part; null ids come after all others and are no anchors;
rows with one id are separate rows, each compared with all but itself; equal
scores are ordered by id, then by the row's place in its table; vectors of
different lengths are compared as if the shorter ended with zeros; empty
vectors have product 0 with all; an empty table or one without anchors gives
an empty result; further columns, whatever their names, are not read.  A
quantised component of 2^24 or more ends the query with an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.common import numbered
from marketlens.sources.sinks import materialize

#: Components of anchors that the driver and a task hold at once, as bytes.
BLOCK_BYTES = 4 << 20
#: Anchors and candidates of one matrix product.
TILE_ANCHORS, TILE_ROWS = 1024, 2048
#: Bits of an integer that a double holds exactly.
DOUBLE_BITS = 53
#: Magnitude that a quantised component stays below.
COMPONENT_LIMIT = 1 << 24


@dataclass(frozen=True)
class Settings:
    """``positives`` rows of the same label an anchor, ``negatives`` rows a
    positive, whose score lies between ``low`` and ``high`` percent of it."""
    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95


def packed_products(anchors: np.ndarray, rows: np.ndarray, double_bits: int = DOUBLE_BITS) -> np.ndarray:
    """Inner products (anchors x rows) of two matrices of integers."""
    n, dim = rows.shape
    if not n or not len(anchors) or not dim:
        return np.zeros((len(anchors), n), np.int64)
    low_a, low_r = int(anchors.min()), int(rows.min())
    a, r = anchors - low_a, rows - low_r  # biased: no component is below 0
    width = max(1, (dim * int(a.max()) * int(r.max())).bit_length())
    fields = double_bits // width
    if fields:
        words = -(-n // fields)
        if words * fields > n:
            r = np.vstack([r, np.zeros((words * fields - n, dim), np.int64)])
        wide = np.zeros((words, dim), np.int64)
        for f in range(fields):
            wide |= r[f * words:(f + 1) * words] << (f * width)
        # sums stay below 2^53, so every step of the product is exact
        sums = (a.astype(np.float64) @ wide.T.astype(np.float64)).astype(np.int64)
        out = np.concatenate([(sums >> (f * width)) & ((1 << width) - 1) for f in range(fields)], axis=1)[:, :n]
        r = r[:n]
    else:
        size = -(-width // 8)
        wide_ints = [int.from_bytes(b"".join(int(x).to_bytes(size, "little") for x in r[:, k]), "little") for k in range(dim)]
        out = np.empty((len(a), n), object)
        for i, anchor in enumerate(a):
            sums = sum(int(x) * w for x, w in zip(anchor, wide_ints)).to_bytes(size * n, "little")
            out[i] = [int.from_bytes(sums[size * k:size * k + size], "little") for k in range(n)]
    bias = low_r * a.sum(axis=1)[:, None] + low_a * r.sum(axis=1)[None, :] + dim * low_a * low_r
    return (out + bias).astype(np.int64)


@dataclass(frozen=True)
class Block:
    """Anchors that a task scores at once."""
    vectors: np.ndarray
    label: np.ndarray
    file: np.ndarray
    index: np.ndarray

    def is_row(self, a: np.ndarray, rows: "Rows", r: np.ndarray) -> np.ndarray:
        return (self.file[a] == rows.file[r]) & (self.index[a] == rows.index[r])


@dataclass
class Rows:
    """Candidates of a batch, ordered by label."""
    vectors: np.ndarray
    label: np.ndarray
    none: np.ndarray
    id: np.ndarray
    file: np.ndarray
    index: np.ndarray


def _matrix(column: pa.Array, dim: int = 0) -> np.ndarray:
    """Lists of integers as a matrix, filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    dim = max(dim, int(lengths.max(initial=0)))
    out = np.zeros((len(lengths), dim), np.int64)
    out[np.arange(dim)[None, :] < lengths[:, None]] = values
    return out


def _batch_rows(batch: pa.RecordBatch, dim: int) -> Rows:
    label = batch.column("label").to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.argsort(label, kind="stable")
    ids = batch.column("id")
    return Rows(_matrix(batch.column("vector"), dim)[order], label[order], ids.is_null().to_numpy(zero_copy_only=False)[order],
                ids.fill_null(0).to_numpy(zero_copy_only=False)[order],
                batch.column("file").to_numpy(zero_copy_only=False)[order],
                batch.column("index").to_numpy(zero_copy_only=False)[order])


class Best:
    """The first ``k`` rows of each slot, by score, id and place."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.floor = np.full(slots, np.iinfo(np.int64).min)  # below it, no row counts any more
        self.kept = [np.zeros(0, t) for t in (np.int64, np.int64, bool, np.int64, np.int64, np.int64)]

    def add(self, slot: np.ndarray, score: np.ndarray, rows: Rows, r: np.ndarray) -> None:
        if not len(slot):
            return
        new = (slot, score, rows.none[r], rows.id[r], rows.file[r], rows.index[r])
        slot, score, none, ident, file, index = cols = [np.concatenate(p) for p in zip(self.kept, new)]
        order = np.lexsort((index, file, ident, none, -score, slot))
        at = slot[order]
        begins = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        place = np.arange(len(at)) - np.repeat(begins, np.diff(np.r_[begins, len(at)]))
        self.kept = [c[order[place < self.k]] for c in cols]
        last = order[place == self.k - 1]
        self.floor[slot[last]] = score[last]

    def batch(self) -> pa.RecordBatch:
        slot, score, none, ident, file, index = self.kept
        return pa.RecordBatch.from_pydict({"slot": pa.array(slot), "score": pa.array(score), "id": pa.array(ident, mask=none),
                                           "file": pa.array(file), "index": pa.array(index)})


_BEST = "slot long, score long, id long, file long, index long"


def _tiles(n: int, size: int) -> Iterator[slice]:
    for k in range(0, n, size):
        yield slice(k, min(n, k + size))


def _positives(batches: Iterator[pa.RecordBatch], block: Block, k: int) -> Iterator[pa.RecordBatch]:
    """The best ``k`` rows of each anchor's label among a task's rows."""
    best = Best(len(block.label), k)
    for batch in batches:
        rows = _batch_rows(batch, block.vectors.shape[1])
        vectors = np.pad(block.vectors, ((0, 0), (0, rows.vectors.shape[1] - block.vectors.shape[1])))
        for label in np.unique(rows.label):
            own = np.flatnonzero(block.label == label)
            begin, end = np.searchsorted(rows.label, [label, label + 1])
            for tile in _tiles(len(own), TILE_ANCHORS):
                a = own[tile]
                for part in _tiles(end - begin, TILE_ROWS):
                    first, last = begin + part.start, begin + part.stop
                    scores = packed_products(vectors[a], rows.vectors[first:last])
                    least = best.floor[a]
                    if last - first > k + 1:  # one of the k + 1 may be the anchor itself
                        least = np.maximum(least, np.partition(scores, -k - 1, axis=1)[:, -k - 1])
                    i, j = np.nonzero(scores >= least[:, None])
                    other = ~block.is_row(a[i], rows, first + j)
                    best.add(a[i][other], scores[i, j][other], rows, first + j[other])
    yield best.batch()


def _negatives(batches: Iterator[pa.RecordBatch], block: Block, anchor: np.ndarray, low: np.ndarray, high: np.ndarray,
               k: int) -> Iterator[pa.RecordBatch]:
    """The best ``k`` rows of another label, with a score of ``low`` to
    ``high``, for each pair of an anchor and a positive (a slot; ``anchor``
    rises)."""
    best = Best(len(anchor), k)
    used, first = np.unique(anchor, return_index=True)
    for batch in batches:
        rows = _batch_rows(batch, block.vectors.shape[1])
        vectors = np.pad(block.vectors, ((0, 0), (0, rows.vectors.shape[1] - block.vectors.shape[1])))
        for part in _tiles(len(rows.label), TILE_ROWS):
            for tile in _tiles(len(used), TILE_ANCHORS):
                a = used[tile]
                slots = np.arange(first[tile.start], first[tile.stop] if tile.stop < len(first) else len(anchor))
                least = np.maximum(low[slots], best.floor[slots])
                begins = first[tile] - first[tile.start]
                scores = packed_products(vectors[a], rows.vectors[part])
                inside = (scores >= np.minimum.reduceat(least, begins)[:, None]) & (scores <= np.maximum.reduceat(high[slots], begins)[:, None])
                inside &= block.label[a][:, None] != rows.label[part][None, :]
                i, j = np.nonzero(inside)
                # every hit for each of its anchor's slots
                n = np.diff(np.r_[begins, len(slots)])[i]
                hit = np.repeat(np.arange(len(i)), n)
                slot = np.repeat(begins[i], n) + np.arange(len(hit)) - np.repeat(np.cumsum(n) - n, n)
                score = scores[i, j][hit]
                fits = (score >= least[slot]) & (score <= high[slots][slot])
                best.add(slots[slot[fits]], score[fits], rows, part.start + j[hit][fits])
    yield best.batch()


def _first(best: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each slot over all tasks, with their ``place``."""
    order = Window.partitionBy("slot").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "file", "index")
    return best.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def quantised(vector: Column, scale: int = 256) -> Column:
    """Components as whole numbers: floor(scale * x), x as double."""
    def component(x: Column) -> Column:
        y = F.lit(float(scale)) * x.cast("double")
        return F.when(F.abs(y) < COMPONENT_LIMIT, F.floor(y)).otherwise(
            F.raise_error(F.lit(f"hard negatives: a quantised component is {COMPONENT_LIMIT} or more"))).cast("int")
    return F.transform(vector, component)


def usable(vector: Column) -> Column:
    """Whether a vector and all its components are there and finite."""
    def bad(x: Column) -> Column:
        y = x.cast("double")
        return y.isNull() | F.isnan(y) | (F.abs(y) == float("inf"))
    return vector.isNotNull() & ~F.coalesce(F.exists(vector, bad), F.lit(False))


def mine(vectors: DataFrame, s: Settings = Settings()) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score for a table of id (long), label, vector (array<int>) and
    anchor (boolean), whose rows are all usable."""
    spark = vectors.sparkSession
    stored = materialize(vectors.select("id", F.col("label").cast("long").alias("label"), "vector", "anchor"))
    rows = numbered(stored).select("doc.*", "row.file", "row.index")
    same = Window.partitionBy("label", F.xxhash64("vector"), "vector").orderBy(F.col("id").asc_nulls_last(), "file", "index")
    kept = max(s.positives + 1, s.negatives)
    candidates = materialize(rows.withColumn("copy", F.row_number().over(same)).where(F.col("copy") <= kept).drop("copy", "anchor"))
    anchors = rows.where(F.col("anchor") & F.col("id").isNotNull())
    held = anchors.agg(F.sum(F.size("vector") + 4)).first()[0] or 0
    blocks = -(-held * 8 // BLOCK_BYTES)
    parts = []
    for b in range(blocks):
        found = anchors.where(F.pmod(F.xxhash64("file", "index"), F.lit(blocks)) == b).drop("anchor").toArrow().combine_chunks()
        if found.num_rows:
            parts.append(materialize(_mine_block(candidates, found, s)))
    if not parts:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return reduce(DataFrame.unionByName, parts)


def _mine_block(candidates: DataFrame, found: pa.Table, s: Settings) -> DataFrame:
    spark = candidates.sparkSession
    column = {n: found.column(n).to_numpy() for n in ("id", "label", "file", "index")}
    block = Block(_matrix(pa.concat_arrays(found.column("vector").chunks)), column["label"], column["file"], column["index"])
    positives = _first(candidates.mapInArrow(lambda batches: _positives(batches, block, s.positives), _BEST), s.positives)
    # a few rows for each anchor of the block
    pairs = positives.select("slot", "place", "id", "score").toArrow().sort_by([("slot", "ascending"), ("place", "ascending")])
    anchor, score = pairs.column("slot").to_numpy(), pairs.column("score").to_numpy()
    low, high = -(-s.low * score // 100), s.high * score // 100
    names = spark.createDataFrame(pa.table({
        "slot": np.arange(len(anchor)), "anchor_id": pa.array(column["id"][anchor]),
        "positive_id": pairs.column("id"), "positive_score": pairs.column("score")}))
    best = candidates.mapInArrow(lambda batches: _negatives(batches, block, anchor, low, high, s.negatives), _BEST)
    return _first(best, s.negatives).join(names, "slot").select(
        "anchor_id", "positive_id", F.col("place").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


def mine_embeddings(embeddings: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Hard negatives of the rows whose vec_id is divisible by 50, with the
    labels of every seventh row shifted, of (vec_id, embedding, label)."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(embeddings.where(F.col("label").isNotNull() & usable(F.col("embedding"))).select(
        F.col("vec_id").alias("id"), label.alias("label"), quantised(F.col("embedding")).alias("vector"),
        F.coalesce(F.col("vec_id") % 50 == 0, F.lit(False)).alias("anchor")), s)


EMBEDDING_SQL = """
with rows as (
  select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.r as a, b.r as b, a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
         cast(list_inner_product(a.v, b.v) as bigint) as score
  from rows a join rows b on a.r <> b.r where a.vec_id % 50 = 0),
positives as (
  select * from (select *, row_number() over (partition by a order by score desc, other_id) as n from scored where same)
  where n <= 5),
negatives as (
  select p.anchor_id, p.other_id as positive_id, n.other_id as negative_id, p.score as positive_score, n.score as negative_score,
         row_number() over (partition by p.a, p.b order by n.score desc, n.other_id) as rank
  from positives p join scored n on n.a = p.a and not n.same
    and 100 * n.score between 50 * p.score and 95 * p.score)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score
from negatives where rank <= 3"""
