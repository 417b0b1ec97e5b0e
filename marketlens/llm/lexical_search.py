"""Ranked lexical search with norm buckets.

A document is the vector of its terms' impacts, an item the vector of its
terms' weights, and the score their inner product in whole numbers.  For each
item the ``k`` documents of the highest score are found without scoring all
of them:

1. One pass over the texts counts every document's terms and the frequencies
   of those that the items use (the items' vocabulary, matched by hash and
   then byte by byte).  The counts of documents, terms and document
   frequencies are sums over all rows of that table.
2. The impact vectors are ordered by length: range-partitioned by norm and
   sorted, so that each batch of the stored index is a bucket of vectors of
   about one length.  Equal lengths (copies) are spread by the rows' places.
3. The longest vectors are searched first; the k-th best score that each item
   has then is the floor with which all others are searched.  A bucket whose
   longest vector cannot reach an item's floor by Cauchy-Schwarz is passed
   over; the smallest norm that any item can use goes to the Parquet scan.
   Inside a bucket the largest impact of each term bounds what the terms can
   add: only documents with a term of the item's focus (the fewest terms
   without which the floor is out of reach) are candidates, and those are
   kept whose score from the focus, with the Cauchy-Schwarz or coordinate
   bound of the rest, whichever is less, reaches the floor.  Survivors are
   scored exactly in 64-bit integers.  A task's floors rise as it goes on.
4. The best of all tasks are ranked by item.

Bounds only leave out documents that cannot be among the first k, so the
result is exact.  Items are taken in blocks of ``BLOCK_BYTES`` of text, one on
the driver at a time; a block costs one pass over the documents.

Edge cases: null, empty and termless texts of documents count nowhere and are
never returned; such items return nothing; a term's repeats in an item count
once; equal scores are ordered by doc_id, null ids last; rows with one doc_id,
or one item_id, are separate documents or items, ranked on their own; equal
texts have equal scores; long texts are read in windows cut between terms; an
empty table on either side gives an empty result; further columns, whatever
their names, are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.common import CHUNK_BYTES, numbered, scramble, text_bytes
from marketlens.sources.sinks import materialize

#: Documents returned for each item.
RANKS = 10
#: Text of items that are searched at once.
BLOCK_BYTES = 1 << 20
#: Share of the documents, those of the longest vectors, that is searched first.
FIRST_SHARE = 1 / 32

# Fixed value: a term is a longest run of these characters.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_TERM = re.compile(TERM)
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_BYTE = np.arange(256, dtype=np.uint8)
_LOWER_BYTE = np.where((_BYTE >= 0x41) & (_BYTE <= 0x5A), _BYTE + 32, _BYTE).astype(np.uint8)
_INSIDE = np.array([bool(b >= 0x80 or chr(b).isalnum()) for b in range(256)])
_VALUES = np.random.default_rng(20240513).integers(1, 1 << 63, size=256 * 256, dtype=np.uint64)


def terms_of(text: str | None) -> list[str]:
    """The terms of a text, in order and with repeats; only A-Z lower-cased."""
    return [t.translate(_LOWER) for t in _TERM.findall(text or "")]


def _hashes(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """64-bit hashes of terms laid end to end, from where each begins."""
    place = np.arange(len(data)) - np.repeat(begins, np.diff(np.append(begins, len(data))))
    values = _VALUES[(place & 255) << 8 | data]
    if len(place) and place.max() > 255:
        values = values * (2 * (place >> 8) + 1).astype(np.uint64)
    return scramble(np.add.reduceat(values, begins))


class Vocabulary:
    """Terms by number, found again in bytes of text."""

    def __init__(self, terms: list[str]):
        coded = [t.encode() for t in terms]
        length = np.array([len(t) for t in coded], np.int64)
        data = np.frombuffer(b"".join(coded), np.uint8)
        begins = np.cumsum(length) - length
        hashes = _hashes(data, begins)
        order = np.argsort(hashes)
        if (hashes[order][1:] == hashes[order][:-1]).any():
            raise ValueError("two terms of the items have one hash")
        self.size, self.hashes, self.number = len(terms), hashes[order], order.astype(np.int32)
        self.data, self.begins, self.length = data, begins[order], length[order]

    def find(self, data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of terms laid end to end: the places of those that are in the
        vocabulary, and their numbers."""
        hashes = _hashes(data, begins)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        length = np.diff(np.append(begins, len(data)))
        found = np.flatnonzero((self.hashes[at] == hashes) & (self.length[at] == length))
        at, length = at[found], length[found]
        if not len(found):
            return found, at.astype(np.int32)
        inner = np.cumsum(length) - length
        step = np.arange(int(length.sum())) - np.repeat(inner, length)
        same = data[np.repeat(begins[found], length) + step] == self.data[np.repeat(self.begins[at], length) + step]
        right = np.logical_and.reduceat(same, inner)
        return found[right], self.number[at[right]]


def _windows(inside: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of about ``CHUNK_BYTES`` that cut no term."""
    begin, size = 0, len(inside)
    while begin < size:
        end = min(begin + CHUNK_BYTES, size)
        if end < size:
            stop = int(offsets[np.searchsorted(offsets, end)])
            while end < stop:
                gap = np.flatnonzero(~inside[end:min(stop, end + 4096)])
                if len(gap):
                    end += int(gap[0])
                    break
                end = min(stop, end + 4096)
        yield begin, end
        begin = end


def count_terms(texts: pa.Array, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For texts without nulls: terms of each; and text, term and frequency
    of the vocabulary's terms in each, in this order."""
    data, offsets = text_bytes(texts)
    inside = _INSIDE[data]
    number, text, term = np.zeros(len(texts), np.int64), [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
    for a, b in _windows(inside, offsets):
        part = inside[a:b]
        first = part.copy()
        first[1:] &= ~part[:-1]
        starts = offsets[np.searchsorted(offsets, a):np.searchsorted(offsets, b)] - a
        first[starts] = part[starts]
        at = np.flatnonzero(first)
        if not len(at):
            continue
        owner = np.searchsorted(offsets, at + a, side="right") - 1
        number += np.bincount(owner, minlength=len(texts))
        begins = np.cumsum(part)[at] - 1
        found, terms = vocabulary.find(_LOWER_BYTE[data[a:b][part]], begins)
        text.append(owner[found])
        term.append(terms)
    keys, frequency = np.unique(np.concatenate(text) * vocabulary.size + np.concatenate(term), return_counts=True)
    return number, keys // vocabulary.size, keys % vocabulary.size, frequency


_COUNTED = "doc_id long, n long, terms array<int>, frequencies array<int>"


def _count(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.large_string())
        number, text, term, frequency = count_terms(texts, vocabulary)
        offsets = pa.array(np.searchsorted(text, np.arange(len(texts) + 1)), pa.int32())
        out = pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), pa.array(number), pa.ListArray.from_arrays(offsets, pa.array(term, pa.int32())),
             pa.ListArray.from_arrays(offsets, pa.array(frequency, pa.int32()))], ["doc_id", "n", "terms", "frequencies"])
        yield out.filter(pa.array(number > 0))


class Items:
    """The weight vectors of a block of items, with their floors."""

    def __init__(self, ids: list, terms: list[np.ndarray], weight: np.ndarray):
        self.ids, self.terms = ids, terms
        self.weights = [weight[t] for t in terms]
        self.norm = np.array([math.sqrt(float((w.astype(np.float64) ** 2).sum())) for w in self.weights])
        self.floor = np.ones(len(ids), np.int64)  # a score counts from here on
        self.size = len(weight)


class Bucket:
    """Impact vectors of about one length, and what bounds them."""

    def __init__(self, batch: pa.RecordBatch, size: int):
        ids = batch.column("doc_id")
        self.none = ids.is_null().to_numpy(zero_copy_only=False)
        self.id = ids.fill_null(0).to_numpy(zero_copy_only=False)
        self.norm = batch.column("norm").to_numpy()
        terms = batch.column("terms")
        self.first = terms.offsets.to_numpy().astype(np.int64) - terms.offsets[0].as_py()
        self.term = terms.flatten().to_numpy()
        self.impact = batch.column("impacts").flatten().to_numpy().astype(np.int64)
        order = np.argsort(self.term, kind="stable")
        self.lists = np.searchsorted(self.term[order], np.arange(size + 1))
        self.row = np.repeat(np.arange(len(self.norm)), np.diff(self.first))[order]
        self.listed = self.impact[order]
        self.most = np.zeros(size, np.int64)  # largest impact of each term
        used = np.flatnonzero(np.diff(self.lists))
        if len(used):
            self.most[used] = np.maximum.reduceat(self.listed, self.lists[:-1][used])

    def candidates(self, terms: np.ndarray, weights: np.ndarray, floor: int) -> np.ndarray:
        """Rows that may score ``floor`` or more."""
        caps = weights * self.most[terms]
        order = np.argsort(-caps, kind="stable")
        rest = int(caps.sum()) - np.cumsum(caps[order])  # all that the terms after a place can add
        if not len(order) or int(caps.sum()) < floor:
            return np.zeros(0, np.int64)
        focus = order[:int(np.argmax(rest < floor)) + 1]
        other = order[len(focus):]
        sums, squares = np.zeros(len(self.norm)), np.zeros(len(self.norm))
        for t, w in zip(terms[focus], weights[focus]):
            rows, impact = self.row[self.lists[t]:self.lists[t + 1]], self.listed[self.lists[t]:self.lists[t + 1]]
            sums[rows] += w * impact  # exact: whole numbers below 2^53
            squares[rows] += impact.astype(np.float64) ** 2
        rows = np.flatnonzero(squares)
        length = math.sqrt(float((weights[other].astype(np.float64) ** 2).sum()))
        beyond = length * np.sqrt(np.maximum(self.norm[rows] ** 2 * _SLACK - squares[rows], 0)) * _SLACK
        return rows[sums[rows] + np.minimum(beyond, float(rest[len(focus) - 1])) >= floor]

    def scores(self, rows: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """The exact scores of rows for a weight of each term."""
        length = self.first[rows + 1] - self.first[rows]
        begins = np.cumsum(length) - length
        at = np.repeat(self.first[rows] - begins, length) + np.arange(int(length.sum()))
        return np.add.reduceat(weight[self.term[at]] * self.impact[at], begins)


#: Covers the rounding of norms, so that no bound is below the true one.
_SLACK = 1 + 1e-9

_FOUND = "slot int, item_id long, doc_id long, score long"


def _search(batches: Iterator[pa.RecordBatch], items: Items, k: int) -> Iterator[pa.RecordBatch]:
    floor = items.floor.copy()
    kept: dict[int, tuple[np.ndarray, ...]] = {}
    weight = np.zeros(items.size, np.int64)
    for batch in batches:
        bucket = Bucket(batch, items.size)
        for i in np.flatnonzero(items.norm * bucket.norm.max() * _SLACK >= floor):
            rows = bucket.candidates(items.terms[i], items.weights[i], int(floor[i]))
            if not len(rows):
                continue
            weight[items.terms[i]] = items.weights[i]
            score = bucket.scores(rows, weight)
            weight[items.terms[i]] = 0
            if len(rows) > k:
                floor[i] = max(floor[i], np.partition(score, -k)[-k])
            good = score >= floor[i]
            new = score[good], bucket.none[rows[good]], bucket.id[rows[good]]
            if i in kept:
                new = tuple(np.concatenate(p) for p in zip(kept[i], new))
            first = np.lexsort((new[2], new[1], -new[0]))[:k]
            kept[i] = tuple(c[first] for c in new)
            if len(first) == k:
                floor[i] = max(floor[i], kept[i][0][-1])
    if kept:
        slots = np.concatenate([np.full(len(c[0]), i) for i, c in kept.items()])
        score, none, doc = (np.concatenate(p) for p in zip(*kept.values()))
        yield pa.RecordBatch.from_pydict({
            "slot": pa.array(slots, pa.int32()), "item_id": pa.array([items.ids[i] for i in slots], pa.int64()),
            "doc_id": pa.array(doc, mask=none), "score": pa.array(score)})


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("slot").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _index(counted: DataFrame, documents: int, terms: int) -> DataFrame:
    """The impact vectors, stored by falling norm."""
    m = F.expr(f"100 - 90 + (90 * n * {documents}L) div {terms}L")
    rows = numbered(counted).select("doc.*", "row").where(F.size("terms") > 0).withColumn("m", m)
    impacts = F.expr("transform(frequencies, f -> cast((1000000000L * f) div (1000L * f + 8 * m) as int))")
    rows = rows.select("doc_id", "terms", impacts.alias("impacts"), "row")
    norm = F.sqrt(F.aggregate("impacts", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    rows = rows.withColumn("norm", norm)
    by_length = [F.col("norm").desc(), F.xxhash64("row.file", "row.index")]
    return materialize(rows.repartitionByRange(*by_length).sortWithinPartitions(*by_length).drop("row"))


def search(docs: DataFrame, items: DataFrame, k: int = RANKS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents (doc_id, text)
    of each item (item_id, text)."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    queries = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.col("text").isNotNull())
    held = queries.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0
    blocks = -(-held // BLOCK_BYTES)
    parts = []
    for b in range(blocks):
        block = queries.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).toArrow().to_pylist()
        block = [(r["item_id"], sorted(set(terms_of(r["text"])))) for r in block]
        block = [r for r in block if r[1]]
        if block:
            parts.append(_search_block(docs, block, k))
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, parts)


def _search_block(docs: DataFrame, block: list[tuple], k: int) -> DataFrame:
    names = sorted({t for _, terms in block for t in terms})
    number = {t: n for n, t in enumerate(names)}
    vocabulary = Vocabulary(names)
    counted = materialize(docs.mapInArrow(lambda batches: _count(batches, vocabulary), _COUNTED))
    documents, terms = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(1))).first()
    found = counted.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
    frequency = np.zeros(len(names), np.int64)
    frequency[found.column("term").to_numpy()] = found.column("count").to_numpy()
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(f) + 1))) for f in frequency], np.int64)
    queries = Items([i for i, _ in block], [np.array([number[t] for t in terms], np.int64) for _, terms in block], weight)
    index = _index(counted, documents, terms)
    longest = index.agg(F.percentile_approx("norm", 1 - FIRST_SHARE, 1000)).first()[0]
    if longest is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    kernel = lambda batches: _search(batches, queries, k)
    first = materialize(_ranked(index.where(F.col("norm") >= longest).select("doc_id", "terms", "impacts", "norm").mapInArrow(kernel, _FOUND), k))
    for r in first.where(F.col("rank") == k).select("slot", "score").collect():  # one row an item
        queries.floor[r["slot"]] = max(1, r["score"])
    least = float(np.min(queries.floor / np.maximum(queries.norm, 1e-300))) / _SLACK
    rest = index.where((F.col("norm") < longest) & (F.col("norm") >= least)).select("doc_id", "terms", "impacts", "norm")
    both = first.drop("rank").unionByName(rest.mapInArrow(kernel, _FOUND))
    return _ranked(both, k).select("item_id", "rank", "doc_id", "score")


SEARCH_SQL = rf"""
with words as (
  select row_number() over () as r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}') as terms
  from documents where text is not null),
size as (select r, doc_id, len(terms) as n from words where len(terms) > 0),
total as (select cast(count(*) as bigint) as docs, cast(sum(n) as bigint) as terms from size),
item_terms as (
  select distinct i, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}')) as term
  from (select row_number() over () as i, item_id, text from benchmark where text is not null)),
tf as (
  select r, term, cast(count(*) as bigint) as tf from (select r, unnest(terms) as term from words)
  where term in (select term from item_terms) group by r, term),
weight as (
  select term, cast(floor(1000 * ln(cast(2 * docs + 2 as double) / (2 * count(*) + 1))) as bigint) as w
  from tf, total group by term, docs),
impact as (
  select r, term, (1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // total.terms)) as x
  from tf join size using (r), total),
scored as (
  select i, item_id, r, cast(sum(w * x) as bigint) as score
  from item_terms join weight using (term) join impact using (term) group by i, item_id, r having sum(w * x) > 0),
ranked as (
  select i, item_id, doc_id, score, row_number() over (partition by i order by score desc, doc_id) as rank
  from scored join size using (r))
select item_id, cast(rank as integer) as rank, doc_id, score from ranked where rank <= 10"""
