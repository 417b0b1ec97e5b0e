"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlens.sources.sinks import materialize

#: Word length of a shingle and least similarity of near-duplicates.
SHINGLE_WORDS = 5
NEAR_SIMILARITY = 0.8

#: Bytes of text handled at once by the NumPy kernels; bounds their memory.
CHUNK_BYTES = 1 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read a table of the input folder with just the named columns."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


def numbered(docs: DataFrame) -> DataFrame:
    """(row, doc): every row's lasting number and its columns.

    The number is the place of the row in the files it is read from (hash of
    the file's path, index in the file), so that every read gives a row the
    same one.  Numbers counted by partition would change with the files'
    split, which follows from the executors there are at the time.  A frame
    that is not read from files is stored first.
    """
    try:
        place = docs.metadataColumn("_metadata")
    except AnalysisException:
        docs = materialize(docs)
        place = docs.metadataColumn("_metadata")
    row = F.struct(F.xxhash64(place["file_path"]).alias("file"), place["row_index"].alias("index"))
    return docs.select(row.alias("row"), F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"))


def running_offsets(df: DataFrame, group: list[str], order: list[str], rows: int,
                    value: str | None = None, per_bucket: int = 20_000) -> DataFrame:
    """Adds ``_idx`` (gapless from 0 in the group) and ``_start`` (sum of
    ``value`` over the group's earlier rows).

    A group may hold any share of the rows: it is cut into hash buckets of
    its order key, only the bucket totals are summed across the group, and
    rows are numbered inside their bucket.  ``df`` must be a stored table,
    since it is read twice, and ``group`` columns must not be null; rows that
    are equal in ``order`` are numbered in any order.  ``rows`` is its row
    count.
    """
    buckets = max(1, -(-rows // per_bucket))
    val = F.col(value).cast("long") if value else F.lit(0).cast("long")
    df = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    keys = [*group, "_bucket"]
    totals = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.sum(val).alias("_sum"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
                           F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_sum0"))
    inside = Window.partitionBy(*keys).orderBy(*order)
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    return (df.withColumn("_idx", F.row_number().over(inside).cast("long") - 1)
            .withColumn("_start", F.coalesce(F.sum(val).over(earlier), F.lit(0)))
            .join(totals, keys)
            .withColumn("_idx", F.col("_idx") + F.col("_n0"))
            .withColumn("_start", F.col("_start") + F.col("_sum0"))
            .drop("_n0", "_sum0", "_bucket"))


def text_key(text: Column) -> Column:
    """128-bit key of a text: equal for equal texts only."""
    return F.unhex(F.md5(text.cast("binary")))


def pieces(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[pa.Array]:
    """Slices of a text array of about ``limit`` bytes each (one text at
    least); nulls become empty texts."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(texts):
        base = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield texts.slice(first, last - first)
        first = last


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a large_string array without nulls, and the
    position at which each text begins, with the end added."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def _byte_values() -> np.ndarray:
    """Random 64-bit values by position in the word (modulo 256) and byte;
    zero for white space."""
    values = np.random.default_rng(20240229).integers(1, 1 << 63, size=(256, 256), dtype=np.uint64) << np.uint64(1)
    values |= np.uint64(1)
    values[:, _WHITE] = 0
    return values.ravel()


_VALUES = _byte_values()


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the white-space separated words of all texts, and for
    each text the index of its first word, with the end added."""
    data, offsets = text_bytes(texts)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    inside = ~_WHITE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    at = offsets[:-1][offsets[:-1] < len(data)]
    begins[at] = inside[at]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    place = np.arange(starts[0], len(data), dtype=np.int64)
    place -= np.repeat(starts, np.diff(np.append(starts, len(data))))
    place &= 255
    place <<= 8
    place |= data[starts[0]:]
    hashes = np.add.reduceat(_VALUES[place], starts - starts[0])
    return scramble(hashes), np.searchsorted(starts, offsets)


def shingle_hashes(texts: pa.Array, words: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the word n-grams of all texts and each text's first
    index, with the end added.  A text of fewer words has one n-gram of all
    its words; a text without words has none."""
    hashes, first = word_hashes(texts)
    counts = np.diff(first)
    n = np.where(counts >= words, counts - words + 1, np.minimum(counts, 1))
    begin = np.concatenate([[0], np.cumsum(n)])
    total = int(begin[-1])
    if not total:
        return np.zeros(0, np.uint64), begin
    start = np.repeat(first[:-1], n) + np.arange(total) - np.repeat(begin[:-1], n)
    end = np.repeat(first[1:], n)
    out = np.zeros(total, np.uint64)
    padded = np.append(hashes, np.zeros(words, np.uint64))
    for k in range(words):
        part = padded[start + k]
        part[start + k >= end] = 0
        out = (out * _MIX) + part
    return scramble(out), begin
