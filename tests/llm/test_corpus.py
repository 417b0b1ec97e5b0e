"""Mixing, sharding, the shared helpers and the pipeline."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marketlens.llm.common import numbered, running_offsets
from marketlens.llm.mixing import Settings, mix_documents, mix_stage, permuted, share_out
from marketlens.llm.queries import QUERIES
from marketlens.llm.sharding import capacities, propagate, shard_documents, shard_stage

SF = "/root/testdata/sf0.001"


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes):
    """Targets by repeated sharing, sources in order."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    out, open_, left = {}, [s for s in names if sizes[s]], 1.5 * sum(sizes.values())
    out = {s: 0.0 for s in names}
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total >= 2 * sizes[s]]
        if not over:
            out.update({s: left * weight[s] / total for s in open_})
            break
        for s in over:
            out[s] = 2.0 * sizes[s]
        left -= sum(out[s] for s in over)
        open_ = [s for s in open_ if s not in over]
    return out


def check_mix(rows, texts):
    """rows: of mix_documents; texts: (doc_id, text, source) in any order."""
    sizes = Counter()
    for _, t, s in texts:
        sizes[s] += n_words(t)
    targets = brute_targets(sizes)
    assert len(rows) == len(texts)
    assert sorted(((r.doc_id, r.size) for r in rows), key=str) == sorted(((i, n_words(t)) for i, t, _ in texts), key=str)
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    taken = Counter()
    source_of = {i: s for i, _, s in texts}
    for r in rows:
        s = source_of[r.doc_id]
        taken[s] += r.taken
        assert r.source_size == sizes[s] and r.target == pytest.approx(targets[s])
    assert all(abs(taken[s] - targets[s]) <= 1 for s in sizes)


def test_mix_query(spark):
    texts = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = QUERIES["op3_source_mix"](spark, SF).collect()
    check_mix(rows, texts)
    assert sorted(rows) == sorted(QUERIES["op3_source_mix"](spark, SF).collect())


@pytest.mark.parametrize("block", [1, 7, 64])
def test_mix_of_awkward_rows(spark, docs_of, tmp_path, block):
    rng = random.Random(block)
    rows = [(k, " ".join("w" * rng.randrange(0, 40)), "en", rng.choice(["a", "b", "c", "d", None, "é"])) for k in range(300)]
    rows += [(900, None, None, "a"), (901, "", None, None), (902, "x  y", None, "only"), (903, None, None, "empty"), (904, "z " * 20_000, "en", "b")]
    docs = docs_of(rows, str(tmp_path / "d"))
    settings = Settings(block_words=block, shard_slots=16)
    check_mix(mix_documents(docs, settings).collect(), [(i, t, s) for i, t, _, s in rows])
    mixed = mix_stage(docs, settings)
    assert mixed.columns == docs.columns
    times = Counter(r.doc_id for r in mixed.collect())
    assert set(times.values()) <= {1, 2} and not {900, 901, 903} & set(times)


@pytest.mark.parametrize("block", [7, 64])
def test_mixed_words_of_sources_meet_their_targets(spark, docs_of, tmp_path, block):
    rng = random.Random(block)
    words = lambda n: rng.choice([" ", "\n", " \t"]).join(f"é{rng.randrange(99)}" for _ in range(n))
    rows = [(k, words(rng.randrange(0, 400)), "en", "abcdef"[k % 5]) for k in range(200)] + [(900, words(25_000), "en", "f"), (901, words(20_000), "en", "b")]
    docs = docs_of(rows, str(tmp_path / "d"))
    settings = Settings(block_words=block, shard_slots=16)
    sizes, mixed, of_doc = Counter(), Counter(), defaultdict(Counter)
    for _, t, _, s in rows:
        sizes[s] += n_words(t)
    for r in mix_stage(docs, settings).collect():
        mixed[r.source] += n_words(r.text)
        of_doc[r.doc_id].update(r.text.split())
        assert r.n_chars == len(r.text)
    targets = brute_targets(sizes)
    assert all(abs(mixed[s] - targets[s]) <= 1 for s in sizes)
    assert any(targets[s] < 0.9 * sizes[s] for s in sizes) and any(1.1 * sizes[s] < targets[s] < 1.9 * sizes[s] for s in sizes)
    whole = {i: Counter(t.split()) for i, t, _, _ in rows}
    assert all(not c - (whole[i] + whole[i]) for i, c in of_doc.items())


def test_mix_of_repeated_rows_and_nothing(spark, docs_of, tmp_path):
    same = docs_of([(1, "a b c", "en", "s")] * 5 + [(None, "d", None, None)] * 2, str(tmp_path / "d"))
    rows = mix_documents(same, Settings(block_words=2)).collect()
    assert len(rows) == 7 and all(r.taken <= 2 * r.size for r in rows)
    none = docs_of([], str(tmp_path / "e"))
    assert mix_documents(none).count() == 0 and mix_stage(none).count() == 0
    blank = docs_of([(1, None, None, None), (2, "  ", None, "s")], str(tmp_path / "f"))
    assert [r.taken for r in mix_documents(blank).collect()] == [0, 0]


def test_permutations_and_shares():
    for n in (1, 2, 3, 17, 1000, 4097):
        index, size, key = np.arange(n), np.full(n, n), np.full(n, 99)
        there = permuted(index, size, key)
        assert sorted(there) == list(range(n)) and (permuted(there, size, key, True) == index).all()
    assert share_out([], [], 0) == [] and share_out([10, 0], [1, 5], 15) == [15.0, 0.0]
    assert share_out([10, 100], [5, 2], 165) == [20.0, 145.0]


def check_shards(rows, texts):
    assert sorted(((r.doc_id, r.size) for r in rows), key=str) == sorted(((i, len((t or "").encode()) + 1) for i, t in texts), key=str)
    slots = defaultdict(list)
    for r in rows:
        assert r.law == "rows" and r.grown_shard is None
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(8))
    counts = [len(slots[k]) for k in range(8)]
    assert max(counts) - min(counts) <= 1


def test_shard_query(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = QUERIES["op4_balanced_shards"](spark, SF).collect()
    check_shards(rows, texts)
    where = defaultdict(set)
    text_of = dict(texts)
    for r in rows:
        where[text_of[r.doc_id]].add(r.shard)
    assert all(len(s) == 1 for s in where.values())


def test_shards_of_awkward_rows(spark, docs_of, tmp_path):
    rows = [(k, "hot", "en", "s") for k in range(70)] + [(100 + k, f"t{k // 3}", "en", "s") for k in range(90)]
    rows += [(1000 + k, f"alone {k}", "en", "s") for k in range(200)]
    rows += [(500, None, None, None), (501, None, None, None), (502, "", None, None), (502, "", None, None), (None, "é" * 40_000, None, None)]
    docs = docs_of(rows, str(tmp_path / "d"))
    found = shard_documents(docs).collect()
    check_shards(found, [(i, t) for i, t, _, _ in rows])
    where = defaultdict(Counter)
    for r in found:
        if r.doc_id is not None and r.doc_id < 200:
            where["hot" if r.doc_id < 70 else (r.doc_id - 100) // 3][r.shard] += 1
    assert len(where["hot"]) <= 4
    assert sum(len(c) > 1 for g, c in where.items() if g != "hot") <= 3
    staged = shard_stage(docs)
    assert staged.count() == len(rows) and set(staged.columns) == {*docs.columns, "slot"}
    none = docs_of([], str(tmp_path / "e"))
    assert shard_documents(none).count() == 0 and shard_stage(none).count() == 0
    few = docs_of([(1, "a", None, None), (2, "a", None, None)], str(tmp_path / "f"))
    check_shards(shard_documents(few).collect(), [(1, "a"), (2, "a")])


def test_propagation_with_several_keys_keeps_capacity(spark):
    rng = random.Random(1)
    links = spark.createDataFrame([(k, f"g{k % 40}") for k in range(400)] + [(rng.randrange(400), f"g{rng.randrange(40)}") for _ in range(60)],
                                  "row long, key string").distinct()
    got = propagate(links, capacities(400, 8)).collect()
    assert len(got) == 400 and max(Counter(r.shard for r in got).values()) <= 50


def test_offsets_equal_a_plain_window(spark):
    rng = random.Random(3)
    frame = spark.createDataFrame([(rng.choice("ab"), k % 50, rng.randrange(9)) for k in range(1000)], "g string, k long, v long").cache()
    rows = running_offsets(frame, ["g"], ["k"], 1000, "v", per_bucket=30).collect()
    for g in "ab":
        total = 0
        for place, r in enumerate(sorted((r for r in rows if r.g == g), key=lambda r: r._idx)):
            assert (r._idx, r._start) == (place, total)
            total += r.v


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontaminate", "mix", "shard"]
    identified = stage["language_id"](spark, docs, SF)
    assert identified.count() == docs.where(F.col("text").rlike(r"\p{L}")).count()
    one = stage["near_duplicates"](spark, docs, SF)
    classes = {r.class_id for r in QUERIES["op6_ngram_join"](spark, SF).collect()}
    assert sorted(r.doc_id for r in one.collect()) == sorted(classes)
    leaks = {r.doc_id for r in QUERIES["op7_decontaminate"](spark, SF).collect()}
    clean = stage["decontaminate"](spark, docs, SF)
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - leaks
    taken = {r.doc_id: r.taken / r.size for r in QUERIES["op3_source_mix"](spark, SF).collect() if r.taken}
    mixed = Counter(r.doc_id for r in stage["mix"](spark, docs, SF).collect())
    assert set(mixed) == set(taken) and all((n == 2) == (taken[i] > 1.5) for i, n in mixed.items() if taken[i] != 1.5)
    assert all(f.columns == docs.columns for f in (identified, one, clean))


def test_pipeline_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    counts = Counter(r.shard for r in rows)
    assert rows and max(counts.values()) - min(counts.values()) <= 1
    assert corpus_pipeline.ORACLE_SQL is None


def test_rows_keep_their_numbers_when_files_are_split_otherwise(spark, docs_of, tmp_path):
    docs = docs_of([(k, f"text {k}", "en", "s") for k in range(500)] + [(7, "text 7", "en", "s")] * 3, str(tmp_path / "d"))
    read = lambda: {r["row"]: r["doc_id"] for r in numbered(docs).select("row", "doc.doc_id").collect()}
    first = read()
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512b")
    try:
        assert read() == first and len(first) == 503
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    other = numbered(spark.range(5).withColumn("_metadata", F.lit("x")))
    assert other.select("row").distinct().count() == 5 and other.select("doc.*").columns == ["id", "_metadata"]
