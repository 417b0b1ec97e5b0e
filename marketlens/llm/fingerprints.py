"""Document fingerprints by consistent weighted sampling.

The weighted terms of a text are its white-space separated words with their
counts.  For each of ``samples`` hash functions a term draws r and c from
Gamma(2, 1) and b from U(0, 1); with t = floor(ln w / r + b) the term's value
is ln a = ln c - r (t - b) - r, and the sample is the pair (term, t) of the
smallest value.  Two texts agree in a sample with the probability of their
generalised Jaccard similarity, sum(min) / sum(max) of the weights.  The
draws are read from tables of 2^16 variates, indexed by a hash of term and
sample number, with the hash breaking equal values.

A fingerprint is ``samples`` 16-bit hashes of the winning pairs in
hexadecimal; likeness is the share of equal ones.

Edge cases: a null text counts as empty; texts without a word share one
fixed fingerprint; equal texts have equal fingerprints wherever they are; a
very long text is cut by no limit; further columns, whatever their names, are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import numbered, pieces, scramble, word_hashes
from marketlens.sources.sinks import materialize

SAMPLES = 128
#: Rows of a range of consecutive documents, unless the session's number of
#: shuffle partitions asks for larger ones.
RANGE_ROWS = 4096

_LEVELS = 16
_LOW = np.uint64(0xFFFFFFFF)


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """1/r, r, b and ln c + r b - r of 2^16 draws."""
    rng = np.random.default_rng(20100513)
    r, c = rng.gamma(2.0, 1.0, (2, 1 << _LEVELS))
    b = rng.random(1 << _LEVELS)
    return (1 / r).astype(np.float32), r.astype(np.float32), b.astype(np.float32), (np.log(c) + r * b - r).astype(np.float32)


_INVERSE_R, _R, _B, _BASE = _tables()


def _ordered(values: np.ndarray) -> np.ndarray:
    """Floats as integers of the same order."""
    bits = values.astype(np.float32).view(np.uint32)
    return np.where(bits >> np.uint32(31), ~bits, bits | np.uint32(1 << 31)).astype(np.uint64)


#: For a weight of 1 (t = 0) the value depends on the draw alone.
_SINGLE = _ordered(_BASE) << np.uint64(32)


def _multipliers(samples: int) -> np.ndarray:
    return np.random.default_rng(19).integers(1, 1 << 63, size=samples, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def weighted_terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct term hashes, their counts, and the first index of each text."""
    hashes, first = word_hashes(texts)
    n = len(texts)
    owner = np.repeat(np.arange(n), np.diff(first))
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    counts = np.diff(np.append(at, len(hashes)))
    return hashes[at], counts, np.searchsorted(owner[at], np.arange(n + 1))


def signatures(texts: pa.Array, samples: int = SAMPLES) -> np.ndarray:
    """16-bit samples of each text, texts x samples."""
    out = np.zeros((len(texts), samples), dtype=np.uint16)
    row = 0
    for piece in pieces(texts):
        terms, counts, first = weighted_terms(piece)
        filled = np.flatnonzero(np.diff(first))
        if len(filled):
            starts = first[:-1][filled]
            tag = terms & _LOW
            many = np.flatnonzero(counts > 1)
            log_w = np.log(counts[many]).astype(np.float32)
            for k, factor in enumerate(_multipliers(samples)):
                draw = (terms * factor) >> np.uint64(64 - _LEVELS)
                packed = _SINGLE[draw] | tag
                at = draw[many]
                t = np.floor(log_w * _INVERSE_R[at] + _B[at])
                value = _ordered(_BASE[at] - _R[at] * t) << np.uint64(32)
                packed[many] = value | ((tag[many] + t.astype(np.uint64) * np.uint64(0x9E3779B1)) & _LOW)
                least = np.minimum.reduceat(packed, starts) & _LOW
                out[row + filled, k] = scramble(least + np.uint64(k)) >> np.uint64(48)
        row += len(piece)
    return out


def fingerprint_strings(found: np.ndarray) -> list[str]:
    return [r.astype(">u2").tobytes().hex() for r in found]


def fingerprint(text, samples: int = SAMPLES):
    """Column of the fingerprint of a text column."""
    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(fingerprint_strings(signatures(texts, samples)), pa.string())

    return run(text)


def _edit(text: str, following: str) -> str:
    """The last third of a text replaced by the beginning of the next one."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


_RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")


def _compare(ids: list, texts: list[str], samples: int) -> pa.RecordBatch:
    """Rows for all texts but the last, each with its follower."""
    edited = [_edit(a, b) for a, b in zip(texts, texts[1:])]
    own = signatures(pa.array(texts, pa.large_string()), samples)
    other = signatures(pa.array(edited, pa.large_string()), samples)
    return pa.RecordBatch.from_pydict({
        "doc_id": pa.array(ids[:-1], pa.int64()),
        "n_chars": pa.array([len(t) for t in texts[:-1]], pa.int64()),
        "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in edited],
        "fingerprint": fingerprint_strings(own[:-1]),
        "edited_fingerprint": fingerprint_strings(other),
        "near_edited": (own[:-1] == other).mean(axis=1),
        "near_next": (own[:-1] == own[1:]).mean(axis=1)})


def _follow(batches: Iterator[pa.RecordBatch], samples: int) -> Iterator[pa.RecordBatch]:
    """Pairs each row with the next of its range.  Rows come sorted; a range's
    last row is there only to be followed up to."""
    at, ids, texts, held = None, [], [], 0
    for batch in batches:
        for r, i, t in zip(*(batch.column(n).to_pylist() for n in ("range", "doc_id", "text"))):
            if r != at:
                if len(ids) > 1:
                    yield _compare(ids, texts, samples)
                at, ids, texts, held = r, [], [], 0
            ids.append(i)
            texts.append(t)
            held += len(t)
            if held > 2_000_000 and len(ids) > 1:
                yield _compare(ids, texts, samples)
                ids, texts, held = ids[-1:], texts[-1:], len(texts[-1])
    if len(ids) > 1:
        yield _compare(ids, texts, samples)


_SIGN = np.uint64(1 << 63)


def _places(none: np.ndarray, down: np.ndarray, mark: np.ndarray, file: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Keys of 33 bytes that compare as the columns do, one after the other."""
    out = np.zeros((len(none), 33), np.uint8)
    out[:, 0] = none
    for k, column in enumerate((down, mark, file, index)):
        out[:, 1 + 8 * k:9 + 8 * k] = (column.astype(np.int64).view(np.uint64) ^ _SIGN).astype(">u8").view(np.uint8).reshape(-1, 8)
    return out.view("S33").ravel()


def _columns(place: pa.StructArray | pa.Table) -> list[np.ndarray]:
    names = ("none", "down", "mark", "file", "index")
    get = place.field if isinstance(place, pa.StructArray) else (lambda n: place.column(n).combine_chunks())
    return [get(n).fill_null(0).to_numpy(zero_copy_only=False) if n != "none" else get(n).to_numpy(zero_copy_only=False) for n in names]


def compare_with_next(docs: DataFrame, samples: int = SAMPLES, bucket_rows: int = RANGE_ROWS) -> DataFrame:
    """Fingerprints of every text and of its edited text, which ends with the
    beginning of the next document by descending doc_id (the last is followed
    by the first).

    Rows are ordered by doc_id, then by a hash of their text and their place
    in the table, so that a hot id is cut like any other.  Spark's range
    partitioning of these narrow keys finds the first key of each range; with
    them (one a range; ranges grow with the rows, to the session's number of
    shuffle partitions or more) every row finds its range, and goes there once.
    The first row of a range also goes to the range before, for the last row
    there to be followed by.  Null ids come last; a single document follows
    itself; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = numbered(docs.select("doc_id", "text")).select("doc.doc_id", F.coalesce("doc.text", F.lit("")).alias("text"), "row")
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.bitwise_not("doc_id").alias("down"), F.xxhash64("text").alias("mark"),
                     F.col("row.file").alias("file"), F.col("row.index").alias("index"))
    keys = materialize(rows.select(place.alias("place")).select("place.*"))
    wanted = max(1, min(-(-keys.count() // bucket_rows), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    order = ["none", "down", "mark", "file", "index"]
    # one row a range
    firsts = (keys.repartitionByRange(wanted, *order).groupBy(F.spark_partition_id().alias("p"))
              .agg(F.min(F.struct(*order)).alias("first")).select("first.*").toArrow())
    if not firsts.num_rows:
        return spark.createDataFrame([], _RESULT)
    begins = np.sort(_places(*_columns(firsts)))
    ranges = len(begins)

    @F.arrow_udf("array<int>")
    def goes_to(places: pa.Array) -> pa.Array:
        """The range of each row, and for the first of a range that before."""
        key = _places(*_columns(places))
        at = np.searchsorted(begins, key, side="right") - 1
        first = begins[at] == key
        both = np.stack([at, (at - 1) % ranges], axis=1)
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(1 + first)]), pa.int32()),
                                        pa.array(both[np.stack([np.ones(len(at), bool), first], axis=1)], pa.int32()))

    dealt = rows.withColumn("place", place).withColumn("to", goes_to("place")).select(
        "doc_id", "text", "place", F.posexplode("to").alias("last", "range"))
    return (dealt.repartitionById(ranges, "range").sortWithinPartitions("range", "last", *[f"place.{c}" for c in order])
            .select("range", "doc_id", "text").mapInArrow(lambda batches: _follow(batches, samples), _RESULT))
