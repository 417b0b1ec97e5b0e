"""Near-duplicate join, decontamination and fingerprints against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from marketlens.llm import ngram_join
from marketlens.llm.decontamination import Items, Settings as LeakSettings, clean_stage, contaminations, edit_distance
from marketlens.llm.fingerprints import compare_with_next, signatures
from marketlens.llm.ngram_join import Settings, components, join_documents, keep_one
from marketlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORDS = [f"w{k}" for k in range(400)]


def prose(rng, n):
    return " ".join(rng.choices(WORDS, k=n))


def changed(rng, text, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = rng.choice(WORDS)
    return " ".join(words)


def awkward():
    """Documents with nulls, empty, short, repeated and long texts and groups of near copies."""
    rng = random.Random(4)
    rows = [(1, None), (2, None), (3, ""), (4, ""), (5, "  \n "), (6, "one"), (7, "one"), (8, "one two three four"), (None, "no id at all here now"),
            (9, prose(rng, 30_000))]
    base = prose(rng, 120)
    rows += [(10 + k, changed(rng, base, k % 4)) for k in range(60)]
    rows += [(100, base), (101, base), (101, base), (102, base.upper())]
    rows += [(200 + k, prose(rng, rng.randrange(1, 80))) for k in range(60)]
    return [(i, t, "en", "s") for i, t in rows]


def shingles(text):
    words = (text or "").lower().split()
    return frozenset(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def brute_classes(rows):
    texts = {t for _, t in rows if t is not None}
    sets = {t: shingles(t) for t in texts}
    links, near = Counter(), defaultdict(set)
    for a in texts:
        for b in texts:
            if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-12:
                links[a] += 1
                links[b] += 1
                near[a].add(b)
                near[b].add(a)
    least = {t: min((i for i, x in rows if x == t and i is not None), default=None) for t in texts}
    out = {}
    for t in texts:
        seen, todo = {t}, [t]
        while todo:
            for u in near[todo.pop()] - seen:
                seen.add(u)
                todo.append(u)
        out[t] = min((least[u] for u in seen if least[u] is not None), default=None)
    copies = Counter(t for _, t in rows)
    return sorted(((i, i if t is None else out[t], 1 if t is None else copies[t], links[t]) for i, t in rows), key=str)


@pytest.mark.parametrize("block", [256, 16])
def test_join_equals_brute_force(spark, docs_of, tmp_path, block):
    docs = docs_of(awkward(), str(tmp_path / "d"))
    got = [tuple(r) for r in join_documents(docs, Settings(block=block)).collect()]
    assert sorted(got, key=str) == brute_classes([(r[0], r[1]) for r in awkward()])


def test_join_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = [tuple(r) for r in QUERIES["op6_ngram_join"](spark, SF).collect()]
    assert sorted(got, key=str) == brute_classes(rows)


def test_join_of_nothing(spark, docs_of, tmp_path):
    docs = docs_of([], str(tmp_path / "d"))
    assert join_documents(docs).count() == 0
    assert keep_one(docs).columns == docs.columns and keep_one(docs).count() == 0


def test_one_of_each_class_stays(spark, docs_of, tmp_path):
    rows = awkward()
    docs = docs_of(rows, str(tmp_path / "d"))
    kept = keep_one(docs).collect()
    brute = brute_classes([(r[0], r[1]) for r in rows])
    wanted = len({c for i, c, _, _ in brute if i not in (1, 2)}) + 2
    assert len(kept) == wanted < len(rows)
    assert set(kept[0].asDict()) == set(docs.columns)
    assert sum(r.doc_id in (1, 2) for r in kept) == 2


def test_classes_go_by_texts_and_not_by_ids(spark, docs_of, tmp_path):
    rng = random.Random(12)
    lone = [prose(rng, 40) for _ in range(6)]
    base = prose(rng, 120)
    near = changed(rng, base, 1)
    rows = [(None, lone[0]), (None, lone[1]), (None, lone[1]), (None, lone[2]), (5, lone[3]), (5, lone[4]), (6, lone[5]),
            (None, base), (7, near), (7, base)]
    docs = docs_of([(i, t, "en", "s") for i, t in rows], str(tmp_path / "d"))
    kept = sorted(((r.doc_id, r.text) for r in keep_one(docs).collect()), key=str)
    groups = [r for r in kept if r[1] in (base, near)]
    assert len(groups) == 1 and groups[0][0] == 7
    assert [r for r in kept if r not in groups] == sorted(
        [(None, lone[0]), (None, lone[1]), (None, lone[2]), (5, lone[3]), (5, lone[4]), (6, lone[5])], key=str)


def test_banding_reaches_the_recall():
    bands, rows = Settings().banding
    assert bands * rows <= 256 and 1 - (1 - 0.8 ** rows) ** bands >= 0.9995


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(70)] + [(100, 101)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{k: 0 for k in range(71)}, 100: 100, 101: 100}


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_edit_distance_to_the_best_stretch():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(1, 9))] for _ in range(2))
        best = min(levenshtein(a, b[i:j]) for i in range(len(b) + 1) for j in range(i, len(b) + 1))
        assert edit_distance(a, b)[0] == best


def test_leaks_equal_brute_force(spark):
    got = {(r.doc_id, r.item_id): r.distance for r in QUERIES["op7_decontaminate"](spark, SF).collect()}
    import re
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    docs = {r.doc_id: words(r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r.item_id: words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    want = {(d, i): edit_distance(w, x)[0] for d, x in docs.items() for i, w in items.items()}
    want = {k: n for k, n in want.items() if n <= int(0.2 * len(items[k[1]]) + 1e-9)}
    assert want and got == want


def test_changed_items_are_found():
    rng = random.Random(8)
    items = [prose(rng, n) for n in range(6, 66) for _ in range(3)]
    found = Items(list(range(len(items))), items, LeakSettings())
    texts, wanted = [], []
    for k, item in enumerate(items):
        words = item.split()
        for _ in range(int(0.2 * len(words) * rng.random())):
            at = rng.randrange(len(words))
            words[at:at + rng.randrange(2)] = rng.choices(WORDS, k=rng.randrange(2))
        texts.append(f"{prose(rng, 40)} {' '.join(words)}. {prose(rng, 40)}")
        wanted.append(k)
    got = found.matches(pa.array(texts, pa.large_string()))
    assert sum(k in [m["item"] for m in g] for k, g in zip(wanted, got)) >= 0.98 * len(wanted)


def edited(rng, words, edits, kind):
    """The words with so many substitutions, insertions or deletions."""
    out = list(words)
    for at in sorted(rng.choice(len(words), edits, replace=False).tolist(), reverse=True):
        new = [] if kind == "deletion" else [f"e{rng.integers(1 << 40)}"]
        out[at:at + (kind != "insertion")] = new
    return out


@pytest.mark.parametrize("kind", ["substitution", "insertion", "deletion"])
def test_items_of_all_lengths_are_found_at_the_full_edits(kind):
    rng = np.random.default_rng(3)
    sizes = [20, 40, 80, 160, 320, 500]
    items = [" ".join(f"v{w}" for w in rng.integers(0, 5_000, n)) for n in sizes for _ in range(50)]
    found = Items(list(range(len(items))), items, LeakSettings())
    texts = [" ".join(["before it"] * 20 + edited(rng, x.split(), len(x.split()) // 5, kind) + ["after it"] * 20) for x in items]
    got = [k in [m["item"] for m in g] for k, g in enumerate(found.matches(pa.array(texts, pa.large_string())))]
    for at, n in enumerate(sizes):
        hits = got[at * 50:at * 50 + 50]
        assert sum(hits) >= (48 if found.walks[at * 50] else 50), n


def test_leaks_of_awkward_rows(spark, docs_of, tmp_path):
    item = prose(random.Random(1), 30)
    docs = docs_of([(1, None, "en", "s"), (2, "", "en", "s"), (3, item, "en", "s"), (3, item, "en", "s"), (None, f"x {item}", None, None),
                    (4, "clean text", "en", "s"), (5, prose(random.Random(3), 20_000) + " " + item.upper(), "en", "s")], str(tmp_path / "d"))
    bench = spark.createDataFrame([(7, item), (8, None), (9, ""), (10, "--"), (None, "something else that no text has")], "item_id long, text string")
    got = contaminations(docs, bench, LeakSettings(block_items=2)).collect()
    assert sorted(((r.doc_id, r.item_id) for r in got), key=str) == [(3, 7), (3, 7), (5, 7), (None, 7)]
    clean = clean_stage(docs, bench)
    assert sorted(r.doc_id for r in clean.collect()) == [1, 2, 4] and clean.columns == docs.columns
    assert contaminations(docs, bench.limit(0)).count() == 0 and clean_stage(docs, bench.limit(0)).count() == 7


def weighted_jaccard(a, b):
    a, b = Counter(a.split()), Counter(b.split())
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_likeness_estimates_weighted_jaccard():
    rng = random.Random(6)
    errors = []
    for _ in range(40):
        a = prose(rng, 200)
        b = changed(rng, a, rng.randrange(120))
        x, y = signatures(pa.array([a, b], pa.large_string()), 512)
        errors.append((x == y).mean() - weighted_jaccard(a, b))
    assert abs(np.mean(errors)) < 0.01 and np.max(np.abs(errors)) < 0.1


@pytest.mark.parametrize("bucket_rows", [4096, 5])
def test_followers_equal_brute_force(spark, docs_of, tmp_path, bucket_rows):
    rng = random.Random(5)
    rows = [(k * 3, prose(rng, rng.randrange(0, 60)) + rng.choice(["", "é𝄞"]), "en", "s") for k in range(57)]
    rows += [(300, None, "en", "s"), (301, "", "en", "s"), (302, prose(rng, 20_000), "en", "s")]
    docs = docs_of(rows, str(tmp_path / "d"))
    got = {r.doc_id: r for r in compare_with_next(docs, bucket_rows=bucket_rows).collect()}
    order = sorted(((i, t or "") for i, t, _, _ in rows), reverse=True)
    prints = {}
    for k, (i, t) in enumerate(order):
        follower = order[(k + 1) % len(order)][1]
        third = len(t) // 3
        edited = t[:len(t) - third] + follower[:third]
        assert got[i].n_chars == len(t)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(t, got[i].fingerprint) == got[i].fingerprint
        assert prints.setdefault(edited, got[i].edited_fingerprint) == got[i].edited_fingerprint
        assert 0 <= got[i].near_next <= 1
    assert len(got) == len(order)


def test_followers_of_few_rows(spark, docs_of, tmp_path):
    assert compare_with_next(docs_of([], str(tmp_path / "a"))).count() == 0
    one = compare_with_next(docs_of([(5, "a b c", "en", "s")], str(tmp_path / "b"))).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    same = [(7, "x y", "en", "s")] * 4 + [(None, None, None, None), (None, "z", None, None)]
    assert compare_with_next(docs_of(same, str(tmp_path / "c")), bucket_rows=2).count() == 6


def test_a_hot_id_is_cut(spark, docs_of, tmp_path):
    rng = random.Random(6)
    texts = [prose(rng, 6) for _ in range(900)] + ["the same text"] * 600  # one id, and one text, of many rows
    docs = docs_of([(7, t, "en", "s") for t in texts] + [(k, prose(rng, 5), "en", "s") for k in range(20, 40)], str(tmp_path / "d"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 12)
    try:
        got = compare_with_next(docs, bucket_rows=50)
        parts = [n for n in got.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sum(parts) == 1520 and len([n for n in parts if n]) >= 8 and max(parts) < 400


def test_query_likeness_equals_weighted_jaccard(spark):
    """near_edited and near_next against the exact generalised Jaccard
    similarity of the words."""
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids = sorted(docs, reverse=True)

    def jaccard(a, b):
        x, y = Counter(a.split()), Counter(b.split())
        return sum((x & y).values()) / max(1, sum((x | y).values())) if x or y else 1.0

    got = {r.doc_id: r for r in QUERIES["op1_fingerprints"](spark, SF).collect()}
    errors = []
    for i, n in zip(ids, ids[1:] + ids[:1]):
        third = len(docs[i]) // 3
        edited_text = docs[i][:len(docs[i]) - third] + docs[n][:third]
        errors += [got[i].near_edited - jaccard(docs[i], edited_text), got[i].near_next - jaccard(docs[i], docs[n])]
    assert max(map(abs, errors)) < 0.25 and abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.04


@pytest.mark.parametrize("similarity,recall", [(0.8, 0.99), (0.7, 0.95), (0.9, 0.999)])
def test_every_window_is_walked(similarity, recall):
    rng = np.random.default_rng(8)
    sizes = [3, 5, 12, 24, 25, 60, 200]
    items = [" ".join(f"v{w}" for w in rng.integers(0, 5_000, n)) for n in sizes for _ in range(20)]
    found = Items(list(range(len(items))), items, LeakSettings(similarity=similarity, recall=recall))
    assert (found.walks > 0).all() and found.length.max() <= LeakSettings().share_words
    assert [found.length[found.owner == k].sum() for k in range(len(items))] == found.size.tolist()
    hits = 0
    for kind in ("substitution", "insertion", "deletion"):
        texts = [" ".join(["x"] * 9 + edited(rng, x.split(), int(found.edits[k]), kind) + ["y"] * 9) for k, x in enumerate(items)]
        hits += sum(k in [m["item"] for m in g] for k, g in enumerate(found.matches(pa.array(texts, pa.large_string()))))
    assert hits >= (recall - 0.02) * 3 * len(items)


def test_verified_links_stay_without_a_common_band():
    from marketlens.llm.ngram_join import links_between
    sets = [np.arange(100, dtype=np.uint64), np.arange(10, 100, dtype=np.uint64), np.arange(50, 150, dtype=np.uint64)]
    a, b = links_between(sets, np.zeros(3, int), 0.8)
    assert list(zip(a, b)) == [(0, 1)]


def test_edges_of_a_large_group_grow_with_its_nodes(spark, docs_of, tmp_path, monkeypatch):
    rng = random.Random(12)
    base = prose(rng, 300)
    rows = [(k, changed(rng, base, 2), "en", "s") for k in range(300)]
    docs, edges = docs_of(rows, str(tmp_path / "d")), []
    monkeypatch.setattr(ngram_join, "components", lambda e: (edges.append(e.count()), components(e))[1])
    got = [tuple(r) for r in join_documents(docs).collect()]
    assert sorted(got, key=str) == brute_classes([r[:2] for r in rows])
    assert edges[0] < 2 * len(rows)
