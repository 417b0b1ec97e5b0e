"""Language identification with a string kernel.

Two texts are compared by the code-point n-grams that both contain (the
blended spectrum of lengths 1 to ``max_n`` of the lower-cased text, presence
only):

    k(x, y) = |grams(x) & grams(y)| / sqrt(|grams(x)| |grams(y)|)

n-grams are hashed to ``buckets`` columns.  A Nystroem map over ``landmarks``
training texts turns the kernel into features, on which one ridge regression
per language (targets +1 and -1) is fitted; prediction is one batched matrix
product against the landmarks and one against the folded weights.

Learning uses a bounded sample, ``per_class`` labelled rows of each language
(the smallest hashes of the key, then of the text; up to ``max_classes``
languages); prediction covers every whole text.

Edge cases: a null text, an empty text and a text without a letter get the
language ``und`` and score 0; rows with a null language teach nothing;
without any labelled row every text gets ``und``; repeated rows are predicted
alike; the languages' values tie only where texts have no known n-gram, and
then the first by name is taken; a very long text is one row of presence like
any other, and its batch is cut to about 1 MB of text; an empty table gives an
empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.common import pieces

UNDETERMINED = "und"


@dataclass(frozen=True)
class Settings:
    """``per_class`` bounds the labelled rows of each language that are
    learned from, ``max_classes`` the languages, ``landmarks`` the landmark
    texts."""

    max_n: int = 3
    buckets: int = 1 << 14
    per_class: int = 200
    max_classes: int = 500
    landmarks: int = 96
    ridge: float = 1e-2


@dataclass(frozen=True)
class Model:
    settings: Settings
    languages: tuple[str, ...]
    landmarks: np.ndarray  # landmarks x buckets, presence
    weights: np.ndarray    # landmarks x languages


def presence(texts: pa.Array, settings: Settings) -> np.ndarray:
    """Rows of 0 and 1: which hashed n-grams each text (large_string, no
    nulls) contains."""
    out = np.zeros((len(texts), settings.buckets), dtype=np.float32)
    flat = out.ravel()
    strings = pc.utf8_lower(texts).to_pylist()
    lengths = np.array([len(s) for s in strings], dtype=np.int64)
    points = np.frombuffer("".join(strings).encode("utf-32-le"), dtype=np.uint32)
    if not len(points):
        return out
    row = np.repeat(np.arange(len(texts), dtype=np.int64) * settings.buckets, lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(points))
    value = np.zeros(len(points), dtype=np.uint32)
    shift = np.uint32(32 - int(settings.buckets).bit_length() + 1)
    for n in range(1, settings.max_n + 1):
        m = len(points) - n + 1
        if m <= 0:
            break
        value = (value[:m] * np.uint32(0x01000193) + points[n - 1:]) * np.uint32(0x9E3779B1)
        column = ((value ^ np.uint32(n * 0x51ED27)) * np.uint32(0x85EBCA6B)) >> shift
        whole = left[:m] >= n
        flat[row[:m][whole] + column[whole]] = 1
    return out


def _kernel(x: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    norms = np.sqrt(np.outer(x.sum(1), landmarks.sum(1)))
    return (x @ landmarks.T) / np.maximum(norms, 1e-9)


#: Rows of the learning sample that are unpacked at once.
CHUNK_ROWS = 512


def ridge(bits: np.ndarray, label: np.ndarray, classes: int, landmarks: np.ndarray, settings: Settings) -> np.ndarray:
    """Weights (landmarks x classes) of the ridge regressions on the Nystroem
    features of packed presence rows.  Rows are unpacked a chunk at a time and
    leave sums of landmarks x landmarks only."""
    values, vectors = np.linalg.eigh(_kernel(landmarks, landmarks).astype(np.float64))
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    balance = 1.0 / np.bincount(label, minlength=classes)
    gram, target = np.zeros((keep.sum(), keep.sum())), np.zeros((keep.sum(), classes))
    for at in range(0, len(bits), CHUNK_ROWS):
        own = label[at:at + CHUNK_ROWS]
        features = _kernel(np.unpackbits(bits[at:at + CHUNK_ROWS], axis=1).astype(np.float32), landmarks) @ root
        y = np.where(own[:, None] == np.arange(classes)[None, :], 1.0, -1.0)
        weighted = features.T * balance[own]
        gram += weighted @ features
        target += weighted @ y
    return root @ np.linalg.solve(gram + settings.ridge * np.eye(len(gram)), target)


def train(labelled: DataFrame, settings: Settings = Settings()) -> Model | None:
    """Fit on ``labelled`` (key, text, lang).  Only the sampled rows' bit
    vectors (``per_class`` x ``max_classes`` at most, packed) reach the
    driver.  More than ``max_classes`` languages are an error: none is dropped."""
    rows = labelled.where(F.col("lang").isNotNull() & has_letter(F.col("text")))
    # a repeated key is told apart by its text, so that every run picks the same rows
    mark = F.xxhash64("text").alias("mark")
    rows = rows.select("key", "lang", "text", mark)
    order = F.xxhash64("key"), F.col("key"), F.col("mark")
    picked = (rows.select("key", "lang", "mark")
              .withColumn("_rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
              .where(F.col("_rank") <= settings.per_class).drop("_rank").distinct())
    languages = tuple(sorted(r["lang"] for r in picked.select("lang").distinct().limit(settings.max_classes + 1).collect()))
    if len(languages) > settings.max_classes:
        raise ValueError(f"language identification: more than {settings.max_classes} languages; raise max_classes")
    if not languages:
        return None

    @F.arrow_udf("binary")
    def bits(texts: pa.Array) -> pa.Array:
        out = []
        for piece in pieces(texts):
            for at in range(0, len(piece), 256):
                x = presence(piece.slice(at, 256), settings).astype(bool)
                out += [r.tobytes() for r in np.packbits(x, axis=1)]
        return pa.array(out, pa.binary())

    # keys of the sample: at most per_class x max_classes, so they can be broadcast;
    # of rows that are equal in all three one is learned from
    sample = (rows.join(F.broadcast(picked), ["key", "lang", "mark"], "left_semi").dropDuplicates(["key", "lang", "mark"])
              .select("key", "lang", "mark", bits("text").alias("bits")).collect())
    sample.sort(key=lambda r: (r["lang"], str(r["key"]), bytes(r["bits"])))
    packed = np.frombuffer(b"".join(bytes(r["bits"]) for r in sample), np.uint8).reshape(len(sample), -1)
    label = np.searchsorted(np.array(languages), np.array([r["lang"] for r in sample]))
    rng = np.random.default_rng(7)
    by_class = [rng.permutation(np.flatnonzero(label == c)) for c in range(len(languages))]
    share = max(1, settings.landmarks // len(languages))
    chosen = np.sort(np.concatenate([rows[:share] for rows in by_class]))
    landmarks = np.unpackbits(packed[chosen], axis=1).astype(np.float32)
    weights = ridge(packed, label, len(languages), landmarks, settings)
    return Model(settings, languages, landmarks.astype(bool), weights.astype(np.float32))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predict(text: Column, model: Model | None) -> Column:
    """Struct of ``lang_pred`` and ``score`` (0 to 1: the winner's regression
    value, mapped from [-1, 1]) for a text column."""
    if model is None:
        return F.struct(F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    settings, languages, weights = model.settings, np.array(model.languages, dtype=object), model.weights
    packed = np.packbits(model.landmarks, axis=1)

    @F.arrow_udf("lang_pred string, score double")
    def classify(texts: pa.Array) -> pa.Array:
        landmarks = np.unpackbits(packed, axis=1).astype(np.float32)
        names, scores = [], []
        for piece in pieces(texts):
            for at in range(0, len(piece), 256):
                values = _kernel(presence(piece.slice(at, 256), settings), landmarks) @ weights
                best = values.argmax(1)
                names.append(languages[best])
                scores.append(np.clip((values[np.arange(len(best)), best] + 1) / 2, 0, 1))
        joined = (np.concatenate(names), np.concatenate(scores).astype(np.float64)) if names else ([], [])
        return pa.StructArray.from_arrays([pa.array(joined[0], pa.string()), pa.array(joined[1], pa.float64())],
                                          names=["lang_pred", "score"])

    guess, letters = classify(text), has_letter(text)
    return F.struct(F.when(letters, guess["lang_pred"]).otherwise(UNDETERMINED).alias("lang_pred"),
                    F.when(letters, guess["score"]).otherwise(0.0).alias("score"))


def _held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_documents(docs: DataFrame, settings: Settings = Settings()) -> Model | None:
    """Learn from the documents whose crc32(doc_id) leaves another remainder
    than 1 by 3; a null doc_id teaches nothing."""
    labelled = docs.where(F.col("doc_id").isNotNull() & ~_held_out(F.col("doc_id")))
    return train(labelled.select(F.col("doc_id").alias("key"), "text", "lang"), settings)


def identify_documents(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document."""
    model = fit_documents(docs, settings)
    return (docs.select("doc_id", _held_out(F.col("doc_id")).alias("held_out"),
                        predict(F.col("text"), model).alias("_guess"))
            .select("doc_id", "held_out", "_guess.lang_pred", "_guess.score"))


def keep_identified(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents with a language, all columns as they are; documents that
    get ``und`` go.  Where nothing is labelled there is nothing to reject by
    but letters: documents that have one stay."""
    model = fit_documents(docs, settings)
    if model is None:
        return docs.where(has_letter(F.col("text")))
    return docs.where(predict(F.col("text"), model)["lang_pred"] != UNDETERMINED)
