"""Packing, ranked search and hard negatives against brute force."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from marketlens.llm import packing
from marketlens.llm.hard_negatives import mine_embeddings, packed_products
from marketlens.llm.lexical_search import TERM, Vocabulary, count_terms, search, terms_of
from marketlens.llm.packing import Packer, pack, pack_documents, sections, token_ids, tokens
from marketlens.llm.queries import ORACLE, QUERIES

public_tokenizers = pytest.importorskip("public_tokenizers")
BPE = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ packing
def brute_ids(texts, path=BPE):
    tokenizer = Tokenizer.from_file(path)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def strings(alphabet, n, longest=80, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(longest))) for _ in range(n)]


def test_ids_are_those_of_the_tokenizers_library():
    plain = [chr(k) for k in [*range(0x250), *range(0x2010, 0x2028), *range(0x2030, 0x205F), 0x20AC]]
    texts = [*strings(plain, 3000), *strings(" \n\t\x0b\x1c\x85\xa0ab1.'stdl", 3000), *strings(" \nab'é日　᠎​😀", 2000),
             "x<|endoftext|> y", "don't I'll", "", "日本 語  don't", None]
    assert tokens(BPE).plain is not None
    got = list(token_ids(pa.array(texts), BPE))
    assert [x.tolist() for x in got] == brute_ids(texts)


def test_sections_of_long_texts_give_the_same_ids(monkeypatch):
    texts = strings(" \n\tab1.'é日  　    wwww", 30, 5000)
    for t in texts:
        assert "".join(sections(t, 100)) == t
    monkeypatch.setattr(packing, "SECTION_CHARS", 100)
    assert [x.tolist() for x in token_ids(pa.array(texts), BPE)] == brute_ids(texts)


def test_other_tokenizers_are_read_as_they_are():
    other = public_tokenizers.path("word_bpe_49k.json")
    texts = ["Some Words here", "  ", "", "déjà vu 1234"]
    assert tokens(other).plain is None
    assert [x.tolist() for x in token_ids(pa.array(texts), other)] == brute_ids(texts, other)


def windows(rows):
    """Sequence lengths; checks that offsets are gapless."""
    seen = defaultdict(list)
    for r in rows:
        seen[r[4]].append((r[5], r[2]))
    out = []
    for parts in seen.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end and length > 0
            end += length
        out.append(end)
    return out


def padding(lengths, capacity):
    return sum(capacity - n for n in lengths if n & (n - 1))


@pytest.mark.parametrize("name", ["mixed", "copies", "tiny", "one", "long", "full", "none"])
def test_every_token_lies_in_one_piece(name):
    rng = random.Random(5)
    sizes = {"mixed": [rng.randrange(1, 300) for _ in range(3000)], "copies": [70] * 2000 + [rng.randrange(1, 200) for _ in range(500)],
             "tiny": [1] * 500, "one": [3], "long": [100_000, 5], "full": [128] * 9, "none": []}[name]
    packer = Packer(7 << 40, capacity=128, open_windows=24, spare=2)
    most = 0
    for k, n in enumerate(sizes):
        packer.add(k, np.arange(n, dtype="<u4"))
        assert packer.held == sum(map(len, packer.windows)) == packer.count.sum()
        most = max(most, packer.held)
    packer.finish()
    assert most <= 24
    tokens_of = defaultdict(list)
    for doc, start, length, total, _, _, ids in packer.rows:
        assert total == sizes[doc] and length == len(ids) // 4
        tokens_of[doc].append((start, np.frombuffer(ids, "<u4")))
    for k, n in enumerate(sizes):
        assert np.array_equal(np.concatenate([x for _, x in sorted(tokens_of[k], key=lambda p: p[0])]), np.arange(n))
    lengths = windows(packer.rows)
    assert max(lengths, default=0) <= 128 and padding(lengths, 128) <= 2
    assert len({r[4] for r in packer.rows}) == len(lengths) and all(r[4] >= 7 << 40 for r in packer.rows)


def test_item_goes_where_the_squares_are_least():
    rng = random.Random(9)
    packer = Packer(0, capacity=32, open_windows=1000)
    for k in range(600):
        size = rng.randrange(1, 32)
        before = packer.count.copy()
        options = {}
        for level in range(0, 33 - size):
            if level and not before[level]:
                continue
            after = before.copy()
            after[level] -= level > 0
            if level + size < 32:
                after[level + size] += 1
            options[level] = int((after ** 2).sum())
        assert options[packer.level_for(size)] == min(options.values())
        packer.add(k, np.zeros(size, "<u4"))


def test_pack_awkward_documents(spark, tmp_path):
    texts = [None, "", "same words", "same words", " ", "long " * 9000, "日本 語", "<|endoftext|>"] + ["copy of a text " * 40] * 60
    rows = [(None if k == 4 else k // 2, t, "x", 1) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, offset int").repartition(3)
    got = pack_documents(docs, BPE).collect()
    lengths = windows([(r.doc_id, r.start, r.length, r.doc_tokens, r.sequence_id, r.offset) for r in got])
    assert max(lengths) <= 2048 and padding(lengths, 2048) <= 3 * 32
    total = Counter()
    for r in got:
        total[r.doc_id] += r.length
    want = Counter()
    for (i, t, _, _), ids in zip(rows, brute_ids(texts)):
        want[i] += len(ids) + 1
    assert total == want
    assert pack_documents(docs.limit(0), BPE).count() == 0


def test_pack_query_gives_back_all_tokens(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    want = {i: np.array([*ids, 1], "<u4") for i, ids in zip(docs, brute_ids(docs.values()))}
    got = QUERIES["op11_pack"](spark, SF).collect()
    assert {r.doc_id for r in got} == set(want)
    covered = Counter()
    for r in got:
        ids = want[r.doc_id][r.start:r.start + r.length]
        assert r.doc_tokens == len(want[r.doc_id]) and r.ids_crc32 == zlib.crc32(ids.tobytes())
        covered[r.doc_id] += r.length
    assert covered == {i: len(x) for i, x in want.items()}
    lengths = windows([tuple(r[c] for c in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")) for r in got])
    assert padding(lengths, 2048) <= 0.001 * sum(lengths)


def test_pack_other_settings(spark):
    docs = spark.createDataFrame([(k, "a b c d e f g h " * (k % 9)) for k in range(200)], "k long, t string").coalesce(1)
    rows = pack(docs, BPE, doc_id="k", text="t", end_id=50256, capacity=100, open_windows=8, spare=0).collect()
    ends = [np.frombuffer(r.ids, "<u4")[-1] for r in rows if r.start + r.length == r.doc_tokens]
    assert len(ends) == 200 and set(ends) == {50256}
    assert padding(windows([(r.doc_id, r.start, r.length, 0, r.sequence_id, r.offset) for r in rows]), 100) == 0


# ------------------------------------------------------------------- search
def brute_search(docs, items, k=10):
    bags = [(i, Counter(terms_of(t))) for i, t in docs if t is not None]
    bags = [(i, b) for i, b in bags if b]
    total, length = len(bags), sum(sum(b.values()) for _, b in bags)
    frequency = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        terms = set(terms_of(text))
        scored = []
        for i, b in bags:
            m = 100 - 90 + (90 * sum(b.values()) * total) // length
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * frequency[t] + 1))) * ((1000000000 * b[t]) // (1000 * b[t] + 8 * m))
                        for t in terms if t in b)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, n, i, -s) for n, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def collection(seed=11, n=400):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(300)] + ["É", "é", "ÀB", "x_y", "日本", "A1", "a1", "Zz"]
    weights = [1 / (k + 1) for k in range(len(words))]
    docs = [(k, " ".join(rng.choices(words, weights, k=rng.randrange(1, 120)))) for k in range(n)]
    docs += [(n + k, "w1 w2 w250 w251 copies") for k in range(150)]  # a hot text
    docs += [(None, "w250 w251"), (None, "w250 w251"), (5, "w299 w298"), (5, "w299"), (2000, None), (2001, ""), (2002, " .,;! "),
             (2003, "w250 " * 30_000), (2004, "q" * 600 + " " + "Q" * 600), (2005, "é-É|ab\x00cd\x7fe")]
    items = [(k, " ".join(rng.choices(words, k=rng.randrange(1, 30)))) for k in range(30)]
    items += [(100, "w1 w2 w250 copies"), (101, None), (102, ""), (103, "nothing here"), (104, "q" * 600), (105, "É ab CD e"),
              (106, "w299 w298"), (106, "w1"), (None, "w250 W251"), (107, "W250 w250, w250")]
    return docs, items


@pytest.mark.parametrize("k", [10, 3])
def test_search_equals_brute_force(spark, k):
    docs, items = collection()
    frame = spark.createDataFrame([(i, t, 1.5, "x") for i, t in docs], "doc_id long, text string, norm double, terms string").repartition(4)
    asked = spark.createDataFrame(items, "item_id long, text string").repartition(2)
    got = [tuple(r) for r in search(frame, asked, k).collect()]
    assert sorted(got, key=str) == brute_search(docs, items, k)


def test_search_in_small_buckets_and_blocks(spark, monkeypatch):
    from marketlens.llm import lexical_search
    monkeypatch.setattr(lexical_search, "BLOCK_BYTES", 400)
    docs, items = collection(12)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 16)
    try:
        frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
        got = [tuple(r) for r in search(frame, spark.createDataFrame(items, "item_id long, text string")).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(got, key=str) == brute_search(docs, items)


def test_search_of_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert search(docs.limit(0), items).collect() == [] and search(docs, items.limit(0)).collect() == []
    assert search(docs.where("false").unionByName(spark.createDataFrame([(1, None)], docs.schema)), items).collect() == []
    assert [tuple(r) for r in search(docs, items).collect()] == brute_search([(1, "a b")], [(1, "a")])


def test_terms_are_counted_as_the_pattern_says(monkeypatch):
    from marketlens.llm import lexical_search
    rng = random.Random(2)
    texts = ["".join(rng.choice("abAB09 _-é日\x00\x7f@[`{~\n") for _ in range(rng.randrange(300))) for _ in range(200)] + ["", "a" * 700, "x " * 500]
    known = sorted({t for x in texts[::3] for t in terms_of(x)})
    for chunk in (1 << 20, 50):
        monkeypatch.setattr(lexical_search, "CHUNK_BYTES", chunk)
        number, text, term, frequency = count_terms(pa.array(texts, pa.large_string()), Vocabulary(known))
        assert number.tolist() == [len(re.findall(TERM, t)) for t in texts]
        want = {(k, t): n for k, x in enumerate(texts) for t, n in Counter(terms_of(x)).items() if t in set(known)}
        assert {(int(a), known[b]): int(c) for a, b, c in zip(text, term, frequency)} == want


# ------------------------------------------------------------ hard negatives
@pytest.mark.parametrize("top", [3, 300, 1 << 20, 1 << 23])
def test_packed_products_are_exact(top):
    rng = np.random.default_rng(top)
    for a, n, dim in ((5, 17, 64), (1, 1, 1), (3, 8, 7), (4, 0, 3), (2, 5, 0)):
        anchors, rows = rng.integers(-top, top, (a, dim)), rng.integers(-top, top, (n, dim))
        want = np.array([[sum(int(x) * int(y) for x, y in zip(p, q)) for q in rows] for p in anchors], np.int64).reshape(a, n)
        assert np.array_equal(packed_products(anchors, rows), want)
        assert np.array_equal(packed_products(anchors, rows, 0), want)  # Python's integers
        assert np.array_equal(packed_products(np.abs(anchors), -np.abs(rows)), np.array(
            [[sum(int(abs(x)) * -int(abs(y)) for x, y in zip(p, q)) for q in rows] for p in anchors], np.int64).reshape(a, n))


def brute_negatives(rows):
    use = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        use.append((i, [math.floor(256 * x) for x in v], label))
    def order(s, i):
        return -s, i is None, i or 0
    out = []
    for a, (i, v, label) in enumerate(use):
        if i is None or i % 50:
            continue
        scored = [(sum(x * y for x, y in zip(v, w)), j, m) for b, (j, w, m) in enumerate(use) if b != a]
        same = sorted([(s, j) for s, j, m in scored if m == label], key=lambda p: order(*p))[:5]
        for p, j in same:
            other = sorted([(s, n) for s, n, m in scored if m != label and 50 * p <= 100 * s <= 95 * p], key=lambda q: order(*q))[:3]
            out += [(i, j, k, n, p, s) for k, (s, n) in enumerate(other, 1)]
    return sorted(out, key=str)


def vectors(seed=4):
    rng = random.Random(seed)
    rows = [(k, [round(rng.uniform(-1, 1) + (k % 4 == c), 3) for c in range(8)], rng.randrange(4)) for k in range(330)]
    hot = [0.5, -0.25, 1.0, 0.0, 0.0, 0.125, 0.0, 0.75]
    rows += [(1000 + k, hot, k % 2) for k in range(300)]  # a group of copies under two labels
    rows += [(None, hot, 1), (None, hot, 0), (50, hot, 1), (50, hot, 1), (51, [1.0, 2.0], 1), (100, [], 2), (150, [3.0] * 8, None), (200, None, 1),
             (250, [float("nan")] + [0.0] * 7, 1), (300, [float("inf")] * 8, 1), (301, [None] * 8, 1), (302, [-3.0] * 8, 3), (350, [-3.0] * 8, 3)]
    return rows


@pytest.mark.parametrize("tile,block", [(2048, 4 << 20), (16, 2000)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, tile, block):
    from marketlens.llm import hard_negatives
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", block)  # the driver's; tiles are the workers' own
    frame = spark.createDataFrame([(i, v, m, "x", 9) for i, v, m in vectors()],
                                  "vec_id long, embedding array<float>, label int, id string, score int").repartition(5)
    rows = [(r.vec_id, r.embedding, r.label) for r in frame.collect()]
    if tile == 16:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 16)
    try:
        got = [tuple(r) for r in mine_embeddings(frame).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(got, key=str) == brute_negatives(rows)


def test_hard_negatives_of_little_data(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert mine_embeddings(spark.createDataFrame([], schema)).collect() == []
    assert mine_embeddings(spark.createDataFrame([(50, [1.0], 1)], schema)).collect() == []
    assert mine_embeddings(spark.createDataFrame([(3, [1.0], 1), (4, [0.5], 2)], schema)).collect() == []
    with pytest.raises(Exception, match="quantised component"):
        mine_embeddings(spark.createDataFrame([(50, [1e9], 1), (51, [1.0], 1)], schema)).collect()


@pytest.mark.parametrize("name", ["op12_lexical_search", "op13_hard_negatives"])
def test_queries_equal_sql(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    frame = QUERIES[name](spark, SF)
    want = con.sql(f"select {', '.join(frame.columns)} from ({ORACLE[name]})").fetchall()
    assert sorted(map(tuple, frame.collect())) == sorted(want) and want
