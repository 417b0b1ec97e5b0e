"""Sum-of-squares packing of tokenised documents into fixed windows.

Every document becomes its token ids and an end id.  A document of a window's
size or more fills whole windows with its beginning; what is left of it is an
item.  Items are placed online: a level array counts the partially filled
windows of every fill level, and an item goes where the sum of the squared
counts becomes least, into a window of some level or into a new one (ties: the
fullest window).  This keeps the levels evenly used, so that later items
find a window that they fill up exactly.

Each task packs the documents of its input partition, in order, with an array
of its own; no text is shuffled, and a task that runs again gives the same
windows.  Its memory is bounded: where more than ``open_windows`` are partially
filled (a size without a counterpart, such as that of a third of all documents
being copies, would leave one a document), two windows of the most crowded
level are poured together: the first is filled up from the second, which
cuts one item at most.  At the end of the partition the windows that are left are filled
up in the same way, the fullest from the emptiest, so that one of them stays;
it is cut into windows of powers of two, which need no padding, unless it
lacks no more than ``spare`` tokens.  Padding is thus at most ``spare`` tokens
a task; every token lies in exactly one piece.

Tokenising: the ids are those of the ``tokenizers`` library.  Where its file is
a byte-level BPE whose merges stand in the order of their ids, texts of common
Latin letters and punctuation (``_PLAIN``: characters whose classes every
version of Unicode agrees on) without the string of a special token are encoded
by ``tiktoken`` from the same vocabulary and split pattern, which gives the
same ids in a quarter of the time (tests compare the two); all other texts are
encoded by ``tokenizers``.  A special token's string in a text becomes that
token's id, as the tokenizer file says.

Edge cases: a null text is an empty one, whose only token is the end id;
long texts are tokenised in sections, cut before
single spaces that a visible character follows, where the pattern always cuts; rows with one
doc_id, or none, are separate documents; equal texts are separate items; an
empty table gives an empty result; further columns, whatever their names, are
not read.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import pieces

#: Tokens of a window; most partially filled windows that a task holds;
#: padding that the last window of a task may need.
CAPACITY, OPEN_WINDOWS, SPARE = 2048, 512, 32
#: The id that ends each document.
END_ID = 1
#: Characters of a section of a long text.
SECTION_CHARS = 1 << 19

# Fixed value: the pattern by which byte-level tokenizers split a text.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_WORD = re.compile(r" [^\s\u180e\u200b\ufeff]")
_PLAIN = re.compile(r"[\x00-\u024f\u2010-\u2027\u2030-\u205e\u20ac]*")


def byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for:
    visible characters of Latin-1 stand for themselves, those above for the
    other bytes in turn."""
    visible = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    others = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(others)}


class Tokens:
    """The ids that a tokenizer file gives to texts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t["content"] for t in file.get("added_tokens") or []]
        split, model = file.get("pre_tokenizer") or {}, file["model"]
        self.by_byte = (file.get("normalizer") is None and split.get("type") == "ByteLevel" and bool(split.get("use_regex"))
                        and not split.get("add_prefix_space"))
        self.plain = self._plain(model) if self.by_byte and model.get("type") == "BPE" else None

    def _plain(self, model: dict):
        """The same vocabulary for ``tiktoken``, where its rule (the pair of
        the lowest id is merged first) is the file's."""
        vocabulary, specials = model["vocab"], set(self.special)
        merged = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if merged != sorted(merged) or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
            return None
        import tiktoken

        byte = byte_of()
        ranks = {bytes(byte[c] for c in t): i for t, i in vocabulary.items() if t not in specials}
        return tiktoken.Encoding("packed", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, text: str) -> np.ndarray:
        if self.plain is not None and (text.isascii() or _PLAIN.fullmatch(text)) and not any(t in text for t in self.special):
            return self.plain.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)
        return self.whole([text])[0]


@lru_cache(maxsize=2)
def tokens(path: str) -> Tokens:
    return Tokens(path)


def sections(text: str, chars: int = SECTION_CHARS) -> Iterator[str]:
    """A text in parts whose ids follow each other, cut before a word."""
    begin = 0
    while len(text) - begin > chars:
        cut = _WORD.search(text, begin + chars)
        if not cut:
            break
        yield text[begin:cut.start()]
        begin = cut.start()
    yield text[begin:] if begin else text


def token_ids(texts: pa.Array, path: str) -> Iterator[np.ndarray]:
    """The ids of each text; nulls are empty texts."""
    encoder = tokens(path)
    for piece in pieces(texts):
        for text in piece.to_pylist():
            if encoder.by_byte and len(text) > SECTION_CHARS:
                yield np.concatenate([encoder.encode(s) for s in sections(text)])
            else:
                yield encoder.encode(text)


Piece = tuple  # doc_id, start, ids, tokens of the document


class Packer:
    """The level array of one task and what it emits."""

    def __init__(self, first_id: int, capacity: int = CAPACITY, open_windows: int = OPEN_WINDOWS, spare: int = SPARE):
        self.capacity, self.open_windows, self.spare = capacity, open_windows, spare
        self.count = np.zeros(capacity + 1, np.int64)  # partially filled windows by level; 0 where full
        self.windows: list[list[list[Piece]]] = [[] for _ in range(capacity)]
        self.held = 0
        self.next_id = first_id
        self.rows: list[tuple] = []

    def emit(self, window: list[Piece]) -> None:
        offset = 0
        for doc, start, ids, total in window:
            self.rows.append((doc, start, len(ids), total, self.next_id, offset, ids.tobytes()))
            offset += len(ids)
        self.next_id += 1

    def put(self, window: list[Piece], level: int) -> None:
        if level == self.capacity:
            self.emit(window)
        elif level:
            self.windows[level].append(window)
            self.count[level] += 1
            self.held += 1

    def take(self, level: int) -> list[Piece]:
        self.count[level] -= 1
        self.held -= 1
        return self.windows[level].pop()

    def level_for(self, size: int) -> int:
        """The level (0: a new window) at which an item of ``size`` makes the
        sum of squared counts least."""
        here, there = self.count[1:self.capacity - size + 1], self.count[size + 1:]
        if not len(here):
            return 0
        change = 2 * (there - here) + 2
        change[-1] -= 1  # a full window leaves the array
        change[here == 0] = np.iinfo(np.int64).max
        last = len(change) - 1 - int(np.argmin(change[::-1]))
        return last + 1 if change[last] <= 2 * self.count[size] + 1 else 0

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        total = len(ids)
        whole = total - total % self.capacity
        for start in range(0, whole, self.capacity):
            self.emit([(doc, start, ids[start:start + self.capacity], total)])
        size = total - whole
        if size:
            level = self.level_for(size)
            window = self.take(level) if level else []
            window.append((doc, whole, ids[whole:], total))
            self.put(window, level + size)
            if self.held > self.open_windows:
                self.relieve()

    def pour(self, into: list[Piece], level: int, source: list[Piece]) -> int:
        """Fill ``into``, of ``level``, up from ``source``; its new level."""
        while source and level < self.capacity:
            doc, start, ids, total = source.pop()
            room = self.capacity - level
            if len(ids) > room:  # the item's end goes, its beginning stays
                source.append((doc, start, ids[:-room], total))
                start, ids = start + len(ids) - room, ids[-room:]
            into.append((doc, start, ids, total))
            level += len(ids)
        return level

    def relieve(self) -> None:
        """One window less: the most crowded level's, else the fullest, is
        filled up."""
        level = int(np.argmax(self.count))
        other = level
        if self.count[level] < 2:
            used = np.flatnonzero(self.count)
            level, other = int(used[-1]), int(used[0])
        into, source = self.take(level), self.take(other)
        filled = self.pour(into, level, source)
        self.put(into, filled)
        self.put(source, other - (filled - level))

    def finish(self) -> None:
        left = [w for level in range(self.capacity - 1, 0, -1) for w in self.windows[level]]
        at, last = 0, len(left) - 1
        while at <= last:
            window = left[at]
            level = sum(len(ids) for _, _, ids, _ in window)
            while level < self.capacity and last > at:
                level = self.pour(window, level, left[last])
                if not left[last]:
                    last -= 1
            at += 1
            if level == self.capacity:
                self.emit(window)
            else:
                self.emit_powers(window, level)
        self.windows, self.held = [[] for _ in range(self.capacity)], 0
        self.count[:] = 0

    def emit_powers(self, window: list[Piece], level: int) -> None:
        """The last window, in parts of powers of two."""
        source = window[::-1]
        while level and self.capacity - level > self.spare:
            part: list[Piece] = []
            room = size = 1 << (level.bit_length() - 1)
            while room:
                doc, start, ids, total = source.pop()
                if len(ids) > room:
                    source.append((doc, start + room, ids[room:], total))
                    ids = ids[:room]
                part.append((doc, start, ids, total))
                room -= len(ids)
            self.emit(part)
            level -= size
        if level:
            self.emit(source[::-1])


_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
                     ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])
_PACKED = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PIECES)], schema=_PIECES)


def _pack(batches: Iterator[pa.RecordBatch], path: str, end_id: int, settings: dict) -> Iterator[pa.RecordBatch]:
    packer = Packer(TaskContext.get().partitionId() << 40, **settings)
    end = np.array([end_id], "<u4")
    for batch in batches:
        for doc, ids in zip(batch.column("doc_id").to_pylist(), token_ids(batch.column("text"), path)):
            packer.add(doc, np.concatenate([ids, end]))
            if len(packer.rows) >= 1000:
                yield _batch(packer.rows)
                packer.rows = []
    packer.finish()
    if packer.rows:
        yield _batch(packer.rows)


def pack(docs: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID,
         capacity: int = CAPACITY, open_windows: int = OPEN_WINDOWS, spare: int = SPARE) -> DataFrame:
    """The pieces of all sequences: doc_id, start (the document's ids before
    it), length, doc_tokens (with the end id), sequence_id, offset (in the
    sequence) and ids (little-endian unsigned 32-bit integers).  ``tokenizer``
    is the path of a file that every executor can open."""
    settings = {"capacity": capacity, "open_windows": open_windows, "spare": spare}
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        lambda batches: _pack(batches, tokenizer, end_id, settings), _PACKED)


def pack_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The packed pieces of (doc_id, text) with the ids' CRC-32 in their place."""
    return pack(docs, tokenizer).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
