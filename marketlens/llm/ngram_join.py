"""N-gram Jaccard self-join by MinHash banding.

Texts are compared by their sets of five-word shingles; links are pairs of
different texts of similarity ``similarity`` or more.

1. Equal texts are one node (a 128-bit key); the rest works on nodes.
2. A node's MinHash signature is cut into ``bands`` of ``rows`` values; the
   numbers are the cheapest whose expected recall at the threshold is
   ``recall`` or more.  Nodes that share a band are candidates.
3. The band buckets are shuffled; each names its members its smallest node,
   their hub.  A node keeps one edge, to the least of its hubs, and ties its
   other hubs to that one: nodes of equal hubs give equal ties, so a large
   group has about one edge a node however many bands it shares.  Connected
   components of these edges bring all candidates of a node together.
4. A component is cut into blocks of about ``block`` nodes.  Every two blocks
   meet in a task, which computes the similarity of their pairs on full
   shingle sets; every pair that reaches the threshold is a link, whether its
   own bands agree or others brought it there.  The task returns each node's
   number of links and a spanning forest of them, so its output grows with
   the nodes and not with the pairs.
5. Components of the forests are the classes.

Nothing is capped: large buckets are only cut into blocks.

Edge cases: null and empty texts and texts of white space have no shingles
and link to nothing, but equal ones share a class (nulls do not); texts of
one to four words have one shingle of all; words are lower-cased; repeated
rows are copies, ties among ids go to any of them alike; an empty table gives
an empty result; very long texts are sets of more shingles; further columns,
whatever their names, are not read by the join and come back from the stage.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import NEAR_SIMILARITY, numbered, pieces, scramble, shingle_hashes, text_key
from marketlens.sources.sinks import materialize


@dataclass(frozen=True)
class Settings:
    similarity: float = NEAR_SIMILARITY
    recall: float = 0.9995
    most_hashes: int = 256
    block: int = 256
    seed: int = 3

    @cached_property
    def banding(self) -> tuple[int, int]:
        """(bands, rows): of all choices that reach the recall with
        ``most_hashes`` the one with the most rows, which has the fewest
        candidates."""
        best = (self.most_hashes, 1)
        for rows in range(1, self.most_hashes + 1):
            share = self.similarity ** rows
            bands = np.ceil(np.log1p(-self.recall) / np.log1p(-min(share, 1 - 1e-9)))
            if bands * rows > self.most_hashes:
                break
            best = int(bands), rows
        return best


def lowered(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(texts).cast(pa.large_string())


def band_hashes(text: Column, s: Settings = Settings()) -> Column:
    """Array of band hashes of a text column; empty for texts without words."""
    bands, rows = s.banding
    factors = np.random.default_rng(s.seed).integers(1, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    @F.arrow_udf("array<bigint>")
    def run(texts: pa.Array) -> pa.Array:
        out = []
        for piece in pieces(texts):
            shingles, first = shingle_hashes(lowered(piece))
            filled = np.flatnonzero(np.diff(first))
            values = np.zeros((len(piece), bands), np.uint64)
            if len(filled):
                starts = first[:-1][filled]
                for b in range(bands):
                    band = np.full(len(filled), b, np.uint64)
                    for f in factors[b * rows:(b + 1) * rows]:
                        band = scramble(band * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(shingles * f, starts))
                    values[filled, b] = band
            sizes = np.zeros(len(piece), np.int32)
            sizes[filled] = bands
            out.append(pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32),
                                                values[filled].ravel().view(np.int64)))
        return pa.concat_arrays(out) if out else pa.array([], pa.list_(pa.int64()))

    return run(text)


def shingle_set(text: Column) -> Column:
    """The sorted distinct shingle hashes of a text column, as bytes."""
    @F.arrow_udf("binary")
    def run(texts: pa.Array) -> pa.Array:
        out: list[bytes] = []
        for piece in pieces(texts):
            shingles, first = shingle_hashes(lowered(piece))
            out += [np.unique(shingles[a:b]).tobytes() for a, b in zip(first, first[1:])]
        return pa.array(out, pa.binary())

    return run(text)


def thin_stars(stars: DataFrame) -> DataFrame:
    """Edges (a, b) that connect what (key, hub) connect, and no more of them.
    A key has at most a hub a band."""
    least = F.col("hubs")[0]
    edge = lambda hub: F.struct(least.alias("a"), F.when(hub == least, F.col("key")).otherwise(hub).alias("b"))
    return (stars.groupBy("key").agg(F.sort_array(F.collect_set("hub")).alias("hubs"))
            .select(F.explode(F.transform("hubs", edge)).alias("edge")).select("edge.a", "edge.b").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for all nodes of the undirected (a, b): root is the
    smallest node that can be reached.  Each round takes the least label of
    the neighbours and then the label's own label; joins and partial
    aggregates only, and the state is a stored table after each round."""
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    state = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root")).withColumnRenamed("a", "node"))
    while True:
        near = (both.join(state.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("root").alias("near"))
                .withColumnRenamed("a", "node"))
        step = materialize(state.join(near, "node", "left")
                           .select("node", F.col("root").alias("old"), F.least("root", F.coalesce("near", "root")).alias("root")))
        above = step.select(F.col("node").alias("root"), F.col("root").alias("top"))
        state = materialize(step.join(above, "root", "left")
                            .select("node", "old", F.least("root", F.coalesce("top", "root")).alias("root")))
        if not state.where(F.col("old") != F.col("root")).limit(1).count():
            return state.select("node", "root")
        state = state.select("node", "root")


def _forest(n: int, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the given links of n nodes."""
    root, out = list(range(n)), []
    for a, b in zip(left.tolist(), right.tolist()):
        x, y = a, b
        while root[x] != x:
            root[x] = x = root[root[x]]
        while root[y] != y:
            root[y] = y = root[root[y]]
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def _common(one: list[np.ndarray], other: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of two lists of sets, as a matrix."""
    if len(one) * len(other) <= 4:
        return np.array([[len(np.intersect1d(x, y, assume_unique=True)) for y in other] for x in one])
    values, column = np.unique(np.concatenate([*one, *other]), return_inverse=True)
    sizes = [len(x) for x in [*one, *other]]
    owner, total = np.repeat(np.arange(len(sizes)), sizes), np.zeros((len(one), len(other)))
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for low in range(0, len(values), 8192):
        a, b = np.searchsorted(column, [low, low + 8192])
        part = np.zeros((len(sizes), min(8192, len(values) - low)), np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        total += part[:len(one)] @ part[len(one):].T
    return total


def links_between(sets: list[np.ndarray], blocks: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs whose sets are similar.  With two blocks only pairs across
    them are formed."""
    here, there = (np.flatnonzero(blocks == b) for b in (blocks.min(), blocks.max()))
    common = _common([sets[i] for i in here], [sets[i] for i in there])
    size = np.array([len(x) for x in sets])
    either = size[here][:, None] + size[there][None, :] - common
    alike = common >= similarity * either - 1e-9
    if blocks.min() == blocks.max():
        alike &= here[:, None] < there[None, :]
    a, b = np.nonzero(alike)
    return here[a], there[b]


def _verify(rows: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """Links of all (root, one, two) tasks of a pack: spanning pairs (a, b),
    and for each node (b null) its number of links in the task."""
    out_a, out_b, out_n = [], [], []
    for _, task in rows.groupby(["root", "one", "two"], sort=False):
        if len(task) < 2:
            continue
        nodes = task["node"].tolist()
        sets = [np.frombuffer(x, np.uint64) for x in task["shingles"]]
        a, b = links_between(sets, task["block"].to_numpy(), similarity)
        if not len(a):
            continue
        for x, y in _forest(len(nodes), a, b):
            out_a.append(nodes[x])
            out_b.append(nodes[y])
            out_n.append(0)
        count = np.bincount(np.concatenate([a, b]), minlength=len(nodes))
        for k in np.flatnonzero(count):
            out_a.append(nodes[k])
            out_b.append(None)
            out_n.append(int(count[k]))
    return pd.DataFrame({"a": pd.Series(out_a, dtype=object), "b": pd.Series(out_b, dtype=object), "links": pd.Series(out_n, dtype="int64")})


def similar_texts(docs: DataFrame, s: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """For (doc_id, text): the nodes (key, doc_id: the smallest of the copies,
    copies) and, for those that have a link, (key, root, links)."""
    keyed = docs.select("doc_id", "text", text_key(F.col("text")).alias("key")).where(F.col("text").isNotNull())
    signed = materialize(keyed.select("key", "doc_id", band_hashes(F.col("text"), s).alias("bands"))
                         .groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"),
                                             F.any_value("bands").alias("bands")))
    nodes = signed.select("key", "doc_id", "copies")
    banded = signed.select("key", F.explode("bands").alias("bucket"))
    shared = (banded.groupBy("bucket").agg(F.min("key").alias("hub"), F.max("key").alias("last"))
              .where(F.col("hub") < F.col("last")).select("bucket", "hub"))
    stars = banded.join(shared, "bucket").where(F.col("key") != F.col("hub")).select("key", "hub")
    groups = components(thin_stars(stars)).withColumnRenamed("node", "key")

    width = groups.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / s.block).cast("int").alias("width"))
    members = groups.join(width, "root")
    ids = members.join(nodes, "key").select("key", "root", "width", "doc_id")
    sets = (keyed.join(ids.hint("shuffle_hash"), (keyed["key"] == ids["key"]) & keyed["doc_id"].eqNullSafe(ids["doc_id"]))
            .select(ids["key"].alias("node"), "root", "width", shingle_set(keyed["text"]).alias("shingles"))
            .dropDuplicates(["node"]))
    sets = materialize(sets.withColumn("block", F.pmod(F.xxhash64("node"), F.col("width")).cast("int")))
    mates = F.explode(F.sequence(F.lit(0), F.col("width") - 1))
    tasks = (sets.withColumn("mate", mates)
             .select("node", "root", "shingles", "block",
                     F.least("block", "mate").alias("one"), F.greatest("block", "mate").alias("two")))
    # a node takes part in as many tasks as its group has blocks
    packs = max(1, -(-(sets.agg(F.sum("width")).first()[0] or 0) // (2 * s.block)))
    # a group of several blocks spreads over many packs; small groups share one
    pack = F.pmod(F.xxhash64("root", "one", "two"), F.lit(packs))
    similarity = s.similarity
    found = materialize(tasks.withColumn("pack", pack).groupBy("pack")
                        .applyInPandas(lambda rows: _verify(rows, similarity), "a binary, b binary, links long"))
    linked = components(found.where(F.col("b").isNotNull())).withColumnRenamed("node", "key")
    counts = found.where(F.col("b").isNull()).groupBy(F.col("a").alias("key")).agg(F.sum("links").alias("links"))
    return nodes, linked.join(counts, "key")


def _classes(docs: DataFrame, s: Settings) -> DataFrame:
    """(key, root, class_id, n_copies, n_links) for every different text; the
    root, a text key, names the class also where ids are null or repeated."""
    nodes, linked = similar_texts(docs, s)
    named = nodes.join(linked, "key", "left").withColumn("root", F.coalesce("root", "key"))
    least = (named.where(F.col("links").isNotNull()).groupBy("root")
             .agg(F.min("doc_id").alias("least")))
    return named.join(least, "root", "left").select(
        "key", "root", F.coalesce("least", "doc_id").alias("class_id"), F.col("copies").alias("n_copies"),
        F.coalesce("links", F.lit(0)).alias("n_links"))


def join_documents(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Per document: doc_id, class_id (the smallest doc_id of its class),
    n_copies (rows with its text) and n_links (other texts that are similar).
    A null text is a class of its own: its own doc_id, one copy, no link."""
    classes = _classes(docs, s)
    rows = docs.select("doc_id", text_key(F.col("text")).alias("key"))
    return rows.join(classes, "key", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def keep_one(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """One document of each class, all columns as they are: that with the
    smallest doc_id, and of repeated rows one.  Classes go by their texts:
    null or repeated ids do not join them.  Documents with a null text all
    stay."""
    classes = materialize(_classes(docs.select("doc_id", "text"), s))
    rowed = numbered(docs)
    rows = materialize(rowed.select("row", "doc.doc_id", text_key(F.col("doc.text")).alias("key")))
    first = (rows.join(classes, "key").groupBy("root")
             .agg(F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))).alias("first")))
    kept = first.select("first.row").unionByName(rows.where(F.col("key").isNull()).select("row"))
    # the hash table is of the numbers: texts are neither sorted nor kept
    return rowed.join(kept.hint("shuffle_hash"), "row", "left_semi").select("doc.*")
