"""Benchmark decontamination by embedded windows.

Texts and benchmark items are read as words (runs of letters and digits,
lower-cased).  A document contains an item of n words if some stretch of it
is within e = floor(0.2 n) word edits of the whole item.

1. Seeds.  With e edits, k = floor((n - e) / (e + 1)) consecutive words of
   the item stay together, so a match has one of the item's k-grams.  Each
   k-gram that a document shares with an item places one window of n words.
   This loses no match.
2. CGK embedding.  A random walk copies the window's current word to the
   output step by step, moving on or not by a random bit of (step, word); few
   edits change few places of the output.  Independent walks are
   each compared with the item's at ``places`` steps sampled from the first
   1.5 n (later ones of the 3 n may lie beyond the words); a window goes
   on if one of them agrees in all.  The number of walks follows from n, e and
   ``recall``: the shares of walks that agree are measured on random words with
   all e edits substitutions, insertions or deletions (``needed_repeats``).
   An item of more than ``share_words`` words is cut into shares of about equal
   length, which are seeded and walked in its stead: of a match with e edits at
   least one share has no more than a share of its length may have, so the item
   is found by it with the same recall, at any length.
3. Verification.  The edit distance of the item to the best stretch in and
   around the windows is computed exactly (bit-parallel dynamic program), once
   for windows that overlap.

The benchmark is a query set: it is taken in blocks of ``block_items`` items,
which bounds what a task holds, and all documents are held against each.
Nothing is shuffled.

Edge cases: null and empty texts contain nothing; items without a word are
never found; a null item_id is reported as null; repeated rows are reported
each; of equally distant stretches the first is reported; very long texts are
read whole, their windows some at a time; no documents or no benchmark means no
result; further columns, whatever their names, are not read by the search and
come back from the stage.
"""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import NEAR_SIMILARITY, pieces, scramble, word_hashes
from marketlens.sources.sinks import materialize

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BITS = 20
#: Walks that a task takes side by side; bounds their memory.
_WALKS_AT_ONCE = 100_000


@dataclass(frozen=True)
class Settings:
    """``recall`` is the least share of matches that the walks must keep;
    ``share_words`` the most words that are walked as one."""

    similarity: float = NEAR_SIMILARITY
    recall: float = 0.999
    places: int = 2
    share_words: int = 24
    block_items: int = 5_000
    seed: int = 5


#: Matches of each kind of edit, and walks of each, that a number of walks is
#: measured on; lengths are measured in steps of ``LADDER`` words.
TRIALS, TRIAL_WALKS, LADDER, MOST_WALKS = 200, 128, 10, 4096


def edits_of(similarity: float, n) -> np.ndarray:
    return ((1 - similarity) * np.asarray(n) + 1e-9).astype(np.int64)


def _edited(rng: np.random.Generator, words: np.ndarray, edits: int, kind: int) -> np.ndarray:
    """The words with ``edits`` substitutions (0), insertions (1) or deletions (2)."""
    fresh = rng.integers(1, 1 << 63, edits, dtype=np.uint64)
    if kind == 0:
        out = words.copy()
        out[rng.choice(len(words), edits, replace=False)] = fresh
        return out
    if kind == 1:
        return np.insert(words, rng.integers(0, len(words) + 1, edits), fresh)
    return np.delete(words, rng.choice(len(words), edits, replace=False))


@lru_cache(maxsize=256)
def _measured(similarity: float, recall: float, places: int, n: int) -> int:
    edits = int(edits_of(similarity, n))
    if not edits:
        return 1
    rng = np.random.default_rng(n)
    needed, aim = 1, (1 + recall) / 2  # half of the loss is left for what a sample does not show
    length = 3 * n // 2
    for kind in range(3):
        steps = np.sort((rng.random((TRIAL_WALKS, places)) * length).astype(np.int64), axis=1)
        salts = rng.integers(1, 1 << 63, TRIAL_WALKS, dtype=np.uint64)
        agree = np.empty(TRIALS)
        for t in range(TRIALS):
            words = rng.integers(1, 1 << 63, n, dtype=np.uint64)
            # as in a document: other words follow
            other = np.append(_edited(rng, words, edits, kind), rng.integers(1, 1 << 63, edits, dtype=np.uint64))[:n]
            agree[t] = (_embed(words, steps, salts) == _embed(other, steps, salts)).all(axis=1).mean()
        agree = np.maximum(agree, 0.5 / TRIAL_WALKS)  # a walk may agree though none of these did
        walks = 1
        while walks < MOST_WALKS and (1 - (1 - agree) ** walks).mean() < aim:
            walks = -(-walks * 5 // 4)
        needed = max(needed, walks)
    return needed


def _embed(words: np.ndarray, steps: np.ndarray, salts: np.ndarray) -> np.ndarray:
    """Walks x places: the embedded words at the steps; 0 beyond the words."""
    at, out = np.zeros(len(salts), np.int64), np.zeros(steps.shape, np.uint64)
    padded = np.append(words, np.uint64(0))
    for turn in range(int(steps.max()) + 1):
        now = padded[np.minimum(at, len(words))]
        hit = steps == turn
        if hit.any():
            out[hit] = np.broadcast_to(now[:, None], steps.shape)[hit]
        at += _moves(now, salts, turn)
    return out


def _moves(words: np.ndarray, salts: np.ndarray, turn: int) -> np.ndarray:
    """Whether each walk moves on from its word at a step: 0 or 1."""
    salted = (words ^ (salts + np.array([turn], np.uint64) * _STEP)) * _STEP
    return ((salted ^ (salted << np.uint64(23))) >> np.uint64(63)).astype(np.int64)


def needed_repeats(s: Settings, n: int) -> int:
    """Walks that keep ``recall`` of the matches of n words with the most
    edits that ``similarity`` allows; measured at the next length of the
    ladder, which needs as many or more."""
    return _measured(s.similarity, s.recall, s.places, n if n < LADDER else -(-n // LADDER) * LADDER)


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of large_string texts, and each text's first index."""
    plain = pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\pL\pN]+", " ")
    return word_hashes(plain.cast(pa.large_string()))


def _grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position on; the last ones are cut off."""
    m = max(0, len(words) - k + 1)
    out = np.zeros(m, np.uint64)
    for j in range(k):
        out = out * _STEP + words[j:j + m]
    return scramble(out)


def edit_distance(item: list[int], stretch: list[int]) -> tuple[int, int]:
    """Least edit distance of the whole item to any part of the stretch, and
    where the first best part ends (exclusive); Myers' bit vectors."""
    where: dict[int, int] = {}
    for k, w in enumerate(item):
        where[w] = where.get(w, 0) | 1 << k
    full, top = (1 << len(item)) - 1, 1 << (len(item) - 1)
    plus, minus, score = full, 0, len(item)
    best, end = score, 0
    for at, w in enumerate(stretch):
        equal = where.get(w, 0)
        x = equal | minus
        d = ((((x & plus) + plus) ^ plus) | x) & full
        up, down = minus | (full & ~(d | plus)), plus & d
        score += bool(up & top) - bool(down & top)
        up, down = (up << 1) & full, (down << 1) & full
        plus, minus = down | (full & ~(d | up)), up & d
        if score < best:
            best, end = score, at + 1
    return best, end


class Items:
    """A block of benchmark items, ready to be looked for."""

    def __init__(self, ids: list, texts: list[str], s: Settings) -> None:
        hashes, first = words_of(pa.array(texts, pa.large_string()))
        kept = [(i, hashes[a:b]) for i, a, b in zip(ids, first, first[1:]) if b > a]
        self.settings = s
        self.ids = [i for i, _ in kept]
        self.words = [w for _, w in kept]
        self.size = np.array([len(w) for w in self.words], dtype=np.int64)
        self.edits = edits_of(s.similarity, self.size)
        #: what is seeded and walked: items, or the shares of long ones
        shares = [(i, int(a), int(b)) for i, n in enumerate(self.size.tolist())
                  for m in (-(-n // s.share_words),) for a, b in ((k * n // m, (k + 1) * n // m) for k in range(m))]
        self.owner = np.array([i for i, _, _ in shares], dtype=np.int64)
        self.offset = np.array([a for _, a, _ in shares], dtype=np.int64)
        self.parts = [self.words[i][a:b] for i, a, b in shares]
        self.length = np.array([b - a for _, a, b in shares], dtype=np.int64)
        part_edits = edits_of(s.similarity, self.length)
        self.walks = np.array([needed_repeats(s, n) for n in self.length.tolist()], dtype=np.int64)
        gram = np.maximum(1, (self.length - part_edits) // (part_edits + 1))
        self.seeds = {}
        for k in np.unique(gram) if len(kept) else []:
            at = [(_grams(self.parts[i], int(k)), i) for i in np.flatnonzero(gram == k)]
            found = np.concatenate([g for g, _ in at])
            item = np.concatenate([np.full(len(g), i) for g, i in at])
            place = np.concatenate([np.arange(len(g)) for g, _ in at])
            order = np.argsort(found, kind="stable")
            filled = np.zeros(1 << _BITS, dtype=bool)
            filled[found >> np.uint64(64 - _BITS)] = True
            self.seeds[int(k)] = found[order], item[order], place[order], filled
        rng, most = np.random.default_rng(s.seed), int(self.walks.max(initial=1))
        # sampled steps as shares of the walk, so that they suit parts of any length
        self.steps = np.sort(rng.random((most, s.places)), axis=1)
        self.salts = rng.integers(1, 1 << 63, most, dtype=np.uint64)
        if len(kept):
            flat = np.concatenate(self.parts)
            begin = np.concatenate([[0], np.cumsum(self.length)])[:-1]
            self.marks = np.zeros((len(self.parts), most, s.places), np.uint64)
            for at in range(0, len(self.parts), 500):
                part = np.arange(at, min(at + 500, len(self.parts)))
                self.marks[part] = self._walk(flat, begin[part], begin[part], begin[part] + self.length[part], part)

    def _walk(self, words, start, low, high, item, marks=None):
        """All walks of the given windows: rows x most repeats x places with
        the embedded words at the sampled steps; words outside of [low, high)
        are blank.  With ``marks``, whether any of its item's walks of a row
        agrees with the item's; walks that differ stop."""
        n = len(item)
        repeats = np.full(n, len(self.salts)) if marks is None else self.walks[item]
        row = np.repeat(np.arange(n), repeats)
        repeat = np.arange(len(row)) - np.repeat(np.cumsum(repeats) - repeats, repeats)
        length = 3 * self.length[item][row] // 2  # beyond, walks may be at the end of the window
        steps = (self.steps[repeat] * length[:, None]).astype(np.int64)
        out = np.zeros(steps.shape, np.uint64)
        live, at, turn = np.arange(len(row)), np.zeros(len(row), dtype=np.int64), 0
        wanted = None if marks is None else marks[item[row], repeat]
        begin, end, size = start[row], high[row], self.length[item][row]
        low, salt = low[row], self.salts[repeat]
        while len(live):
            place = begin[live] + at
            outside = (at >= size[live]) | (place < low[live]) | (place >= end[live])
            now = words[np.where(outside, 0, place)]
            now[outside] = 0
            last = steps[live, -1] <= turn
            going = ~last
            hits = steps[live] == turn
            for p in np.flatnonzero(hits.any(axis=0)):
                hit = hits[:, p]
                out[live[hit], p] = now[hit]
                if marks is not None:
                    going[hit] &= wanted[live[hit], p] == now[hit]
            at += _moves(now, salt[live], turn)
            live, at, turn = live[going], at[going], turn + 1
        if marks is None:
            return out.reshape(n, len(self.salts), -1)
        return np.bincount(row[(out == wanted).all(axis=1)], minlength=n) > 0

    def windows(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, part and start (may be outside of the text) of seeded windows."""
        out = []
        for k, (found, item, place, filled) in self.seeds.items():
            grams = _grams(words, k)
            hit = np.flatnonzero(filled[grams >> np.uint64(64 - _BITS)])
            left = np.searchsorted(found, grams[hit], "left")
            n = np.searchsorted(found, grams[hit], "right") - left
            hit, left, n = hit[n > 0], left[n > 0], n[n > 0]
            text = np.searchsorted(first, hit, "right") - 1
            whole = hit + k <= first[text + 1]
            hit, left, n, text = hit[whole], left[whole], n[whole], text[whole]
            entry = np.repeat(left - np.concatenate([[0], np.cumsum(n)])[:-1], n) + np.arange(n.sum())
            out.append(np.stack([np.repeat(text, n), item[entry], np.repeat(hit, n) - place[entry]]))
        if not out:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.unique(np.concatenate(out, axis=1), axis=1))

    def near(self, words: np.ndarray, first: np.ndarray, text: np.ndarray, item: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Which windows go on to be verified."""
        low, high = first[text], first[text + 1]
        out = np.zeros(len(text), dtype=bool)
        # windows of about as many walks at a time
        turns = np.searchsorted(np.cumsum(self.walks[item]), np.arange(_WALKS_AT_ONCE, int(self.walks[item].sum()), _WALKS_AT_ONCE))
        for part in np.split(np.arange(len(text)), turns):
            if len(part):
                out[part] = self._walk(words, start[part], low[part], high[part], item[part], self.marks)
        return out

    def matches(self, texts: pa.Array) -> list[list[dict]]:
        """For each text the items that it contains: index of the item, least
        distance, and where its best stretch ends (in words)."""
        words, first = words_of(texts)
        result: list[dict[int, tuple[int, int]]] = [{} for _ in range(len(texts))]
        text, part, start = self.windows(words, first)
        near = self.near(words, first, text, part, start)
        # a share's window tells where its item would begin
        text, item, start = text[near], self.owner[part[near]], start[near] - self.offset[part[near]]
        order = np.lexsort((start, item, text))
        text, item, start = text[order], item[order], start[order]
        stretches: list[list[int]] = []  # text, item, begin, end of windows that overlap
        for t, i, a, lo, hi in zip(*(x.tolist() for x in (text, item, start, first[text], first[text + 1]))):
            e, n = int(self.edits[i]), int(self.size[i])
            begin, end = max(lo, a - e), min(hi, a + n + e)
            if stretches and stretches[-1][:2] == [t, i] and begin <= stretches[-1][3]:
                stretches[-1][3] = max(end, stretches[-1][3])
            else:
                stretches.append([t, i, begin, end])
        lists: dict[int, list[int]] = {}
        for t, i, begin, end in stretches:
            known = lists.setdefault(i, self.words[i].tolist())
            distance, best = edit_distance(known, words[begin:end].tolist())
            if distance <= self.edits[i] and (i not in result[t] or distance < result[t][i][0]):
                result[t][i] = distance, begin + best - int(first[t])
        return [[{"item": i, "distance": d, "end_word": e} for i, (d, e) in sorted(r.items())] for r in result]


_FOUND = pa.list_(pa.struct([("item", pa.int32()), ("distance", pa.int32()), ("end_word", pa.int64())]))


def find_items(text: Column, items: Items) -> Column:
    """Array of the items (by index) that a text contains."""
    @F.arrow_udf("array<struct<item int, distance int, end_word bigint>>")
    def run(texts: pa.Array) -> pa.Array:
        out: list[list[dict]] = []
        for piece in pieces(texts):
            out += items.matches(piece)
        return pa.array(out, _FOUND)

    return run(text)


def item_blocks(benchmark: DataFrame, s: Settings = Settings()) -> Iterator[Items]:
    """The benchmark (item_id, text) in blocks of about ``block_items`` items;
    the driver holds one at a time."""
    rows = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    blocks = max(1, -(-rows.count() // s.block_items))
    for b in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        part.sort(key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"]))
        items = Items([r["item_id"] for r in part], [r["text"] for r in part], s)
        if items.ids:
            yield items


_FOUND_IN = "doc_id long, item_id long, distance int, item_words int, end_word long"


def contaminations(docs: DataFrame, benchmark: DataFrame, s: Settings = Settings()) -> DataFrame:
    """doc_id, item_id, distance, item_words, end_word: one row for each
    document and item that it contains.  A block's rows are stored before the
    next block is read."""
    parts = []
    for items in item_blocks(benchmark, s):
        known = docs.sparkSession.createDataFrame(
            [(k, i, int(n)) for k, (i, n) in enumerate(zip(items.ids, items.size))], "item int, item_id long, item_words int")
        hits = (docs.select("doc_id", find_items(F.col("text"), items).alias("hits")).where(F.size("hits") > 0)
                .select("doc_id", F.inline("hits")))
        found = hits.join(F.broadcast(known), "item").select("doc_id", "item_id", "distance", "item_words", "end_word")
        parts.append(materialize(found))
    return reduce(DataFrame.unionByName, parts) if parts else docs.sparkSession.createDataFrame([], _FOUND_IN)


def clean_stage(docs: DataFrame, benchmark: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The documents that contain no item, all columns as they are.  With
    several blocks, what one leaves is stored for the next."""
    blocks, last = item_blocks(benchmark, s), None
    for items in blocks:
        if last is not None:
            docs = materialize(docs.where(last))
        last = F.size(find_items(F.col("text"), items)) == 0
    return docs if last is None else docs.where(last)
