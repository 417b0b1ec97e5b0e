"""Row-wise operators: language, HTML, WARC, personal data, preferences."""

import base64
import gzip
import hashlib
import html
import io
import re

import duckdb
import numpy as np
import pytest

from marketlens.llm.html_text import extract_pages, main_text
from marketlens.llm.language_id import Settings, identify_documents, keep_identified
from marketlens.llm.preference import CONVERSATION_SQL, conversation_pairs, examples, format_preferences
from marketlens.llm.private_data import Settings as FindSettings, find_documents
from marketlens.llm.queries import ORACLE, QUERIES
from marketlens.llm.warc import members, parse_record, read_archives, record_bytes, round_trip, sha1_base32, write_archives

SF = "/root/testdata/sf0.001"


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    langs = {r.doc_id: r.lang for r in docs.collect()}
    got = [r for r in QUERIES["op8_language_id"](spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert len(got) > 250 and sum(langs[r.doc_id] == r.lang_pred for r in got) >= 0.97 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_of_awkward_rows(spark, docs_of, tmp_path):
    real = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    odd = [(9001, None, "en", "s"), (9002, "", "en", "s"), (9003, "12 34 !! \U0001f600", "de", "s"), (None, real[0][1], "xx", None),
           (9005, real[1][1], None, "s"), (9005, real[1][1], None, "s"), (9006, real[2][1] * 60, None, "s")]
    docs = docs_of(real + odd, str(tmp_path / "d"))
    got = {}
    for r in identify_documents(docs).collect():
        got.setdefault(r.doc_id, []).append((r.held_out, r.lang_pred, r.score))
    assert [got[k][0][1:] for k in (9001, 9002, 9003)] == [("und", 0.0)] * 3
    assert len(got[9005]) == 2 and got[9005][0] == got[9005][1]
    assert got[None][0][0] is False and got[None][0][1] in {r[2] for r in real}
    kept = keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() == len(real) + 4
    assert {r.lang_pred for r in identify_documents(docs_of([(1, "abc", None, "s")], str(tmp_path / "e"))).collect()} == {"und"}
    assert identify_documents(docs.limit(0)).count() == 0


def test_language_sample_is_bounded(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert identify_documents(docs, Settings(per_class=2, landmarks=4)).count() == docs.count()


def test_article_of_every_page(spark):
    def expected(page):
        at = page.find("<article>")
        if at < 0:
            return ""
        body = page[at + 9:].split("</article>")[0]
        body = re.sub(r"<[^>]*\Z", "", body)
        parts = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>|<br>", body))
        return "\n".join(x for x in parts if x)

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = QUERIES["op5_main_text"](spark, SF).collect()
    assert len(got) == len(pages)
    assert all(r.text == expected(pages[r.page_id]) and r.n_chars == len(r.text) for r in got)


LONG = " ".join(["A sentence of the story, with some words in it."] * 6)


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain words only", "plain words only"),
    (f"<nav><a href=x>Home</a></nav><article><h1>T&eacute;st</h1><p>{LONG}<p>a&nbsp;b &lt;c&gt;<br>d</article><aside>x</aside>",
     f"Tést\n{LONG}\na b <c> d"),
    (f"<body><div class='site-header'>Logo</div><div id=content><h2>Head</h2><p>{LONG}</p><ul><li>one.</li><li>two.</li></ul></div>"
     f"<div class='cookie-notice'>We use cookies, many.</div><div class=comments><p>{LONG}</p></div><footer>foot</footer>",
     f"Head\n{LONG}\none.\ntwo."),
    (f"<main><form>Name <input></form><p hidden>no</p><p>{LONG}</p><section class='comment-list'><p>{LONG}</p></section></main>", LONG),
    ("<nav>only</nav><script>var a='<p>x</p>'</script><style>p{}</style><!-- <p>c</p> -->", ""),
    (f"<article><p>{LONG}</p><p>cut of", f"{LONG}\ncut of"), (f"<article><p>{LONG}</p><p cla", LONG),
])
def test_main_text(page, text):
    assert main_text(page or "") == text


def test_values_choose_the_content_and_not_the_element_name():
    text = f"Head\n{LONG}\n{LONG}"
    body = f"<div class=text><h2>Head</h2><p>{LONG}</p><p>{LONG}</p></div>"
    teaser = "<div class=cards><article class=card><h3>Next</h3><p>A short one.</p></article></div>"
    assert main_text(f"<body>{teaser}{body}</body>") == main_text(f"<body>{body}{teaser}</body>") == main_text(f"<body>{body}</body>") == text
    deep = f"<article><header><h1>Title</h1></header><div class=body><p>{LONG}</p></div><div><p>End.</p></div></article>"
    assert main_text(f"<body>{teaser}{deep}</body>") == f"Title\n{LONG}\nEnd."


def test_articles_split_over_sibling_elements_stay_whole():
    intro = " ".join(LONG.split()[:30])
    split = (f"<div class=content><div class=intro><p>{intro}</p></div><div class=body><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div>"
             f"<div class=facts><table><tr><td>{LONG}</td></tr></table></div><div class=end><p>End.</p></div></div>")
    side = "<div class=teasers><p>A short one.</p></div>"
    wanted = "\n".join([intro, LONG, LONG, LONG, LONG, "End."])
    assert main_text(f"<body>{side}{split}<div class=comments><p>{LONG}</p></div>{side}</body>") == wanted
    loose = f"<body>{side}<div class=text>{LONG}<p>{LONG}</p><p>End.</p></div>{side}</body>"
    assert main_text(loose) == f"{LONG}\n{LONG}\nEnd."
    many = "".join(f"<div class=c{k}><p>{LONG}</p></div>" for k in range(40))  # no path reaches the threshold
    assert main_text(f"<body>{many}</body>").count(LONG) == 40


def test_articles_in_plain_elements_are_found(spark):
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        plain = r.html.replace("<article>", "<div class=text>").replace("</article>", "</div>")
        assert main_text(plain) == main_text(r.html)


def test_pages_with_nulls(spark):
    rows = [(1, None, None), (None, "u", "<article><p>x y</p></article>"), (3, "u", ""), (3, "u", "")]
    got = extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted(((r.page_id, r.text, r.n_chars) for r in got), key=str) == [(1, "", 0), (3, "", 0), (3, "", 0), (None, "x y", 3)]


def test_archives_round_trip(spark):
    pages = {r.page_id: r.html.encode() for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = QUERIES["op9_warc_round_trip"](spark, SF).collect()
    first = {}
    for i, data in pages.items():
        first[data] = max(first.get(data, i), i)
    assert len(got) == len(pages)
    for r in got:
        data = pages[r.page_id]
        assert (r.payload_bytes, r.payload_digest, r.verified) == (len(data), sha1_base32(data), True)
        assert r.refers_to == (None if first[data] == r.page_id else first[data])
        assert r.record_type == ("response" if r.refers_to is None else "revisit")


def test_archives_of_awkward_rows(spark, tmp_path):
    rows = [(1, "u", "same"), (5, "u\r\nX: y", "same"), (5, "u", "same"), (2, None, None), (3, "u", ""), (None, "u", "é"), (7, "u", "x" * 3_000_000)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "p"))
    pages = spark.read.parquet(str(tmp_path / "p"))
    got = round_trip(pages).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in got), key=str) == sorted([
        (1, 4, "revisit", 5), (5, 4, "response", None), (5, 4, "revisit", 5), (2, 0, "revisit", 3), (3, 0, "response", None),
        (None, 2, "response", None), (7, 3_000_000, "response", None)], key=str)
    assert all(r.verified for r in got)
    assert {r.record_type for r in round_trip(pages, 10_000_000).collect()} == {"response"}
    assert round_trip(pages.limit(0)).count() == 0
    folder = str(tmp_path / "w")
    manifest = write_archives(pages, folder, archive_bytes=200)
    assert manifest.count() > 1
    assert {bytes(r.payload).decode() for r in read_archives(manifest, folder).collect() if r.record_type == "response"} == {
        "same", "", "é", "x" * 3_000_000}


def test_reader_finds_damage():
    data = record_bytes("response", "1", "u", b"body", sha1_base32(b"body"), 4, None)
    assert base64.b32decode(sha1_base32(b"body")) == hashlib.sha1(b"body").digest()
    assert parse_record(data, True)["verified"]
    assert not parse_record(data.replace(b"body", b"bodY"), True)["verified"]
    assert not parse_record(data[:-6], True)["verified"]
    packed = gzip.compress(data) + gzip.compress(data)
    assert [ok for _, ok in members(io.BytesIO(packed))] == [True, True]
    assert [ok for _, ok in members(io.BytesIO(packed[:-9]))] == [True, False]


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        total = sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(digits[::-1]))
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return kind != "phone" or 10 <= len(digits) <= 15


def brute_spans(text):
    found = [(m.start(), n, m.end(), kind) for n, (kind, p) in enumerate(PATTERNS.items())
             for m in re.finditer(p, text or "") if valid(kind, m[0])]
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))


def test_base_spans_of_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op10_private_data"](spark, SF).collect()
    assert len(got) == len(texts) and any(r.spans for r in got)
    for r in got:
        spans = brute_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(spans.encode()).hexdigest() and spans in r.spans


def test_base_spans_of_awkward_texts(spark, docs_of, tmp_path):
    texts = [None, "", "a@b.c_x@y.org a@b a@b.c-d@e.f", "1.2.3.4.5.6.7.8 999.1.1.1 0001.2.3.255 1.2.3", "4111 1111-1111 1111 41111111111111112",
             "+1 (017) 555-7713 +1+49 30 1234567 +12", "é𝄞 x@y.de 𝄞 10.0.0.1", "9" * 50_000, "a" * 50_000, "1." * 20_000, "+1" + " " * 30_000,
             "5 " * 20_000, "x@y.z " * 3_000, "a.b%c@d-e.f.g 4111111111111111!"]
    docs = docs_of([(k, t, None, None) for k, t in enumerate(texts)] + [(None, texts[6], None, None)] * 2, str(tmp_path / "d"))
    got = find_documents(docs).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        assert r.spans == brute_spans(texts[6 if r.doc_id is None else r.doc_id]), r.doc_id
        assert r.base_sha256 == hashlib.sha256(r.spans.encode()).hexdigest()
        kinds = [s.split(":")[0] for s in r.spans.split(",")]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(kinds.count(k) for k in PATTERNS)
    assert find_documents(docs.limit(0)).count() == 0


def test_contexts_find_unseen_identifiers(spark, docs_of, tmp_path):
    rows = [(k, f"please write to p{k}@mail.example soon, or be late", None, None) for k in range(6)]
    rows += [(50, "please write to jo(at)mail.example soon, or be late", None, None), (51, "version 2.0 of jo(at)mail.example is out", None, None),
             (52, "chapter one, section 12345678 of it", None, None)]
    got = {r.doc_id: r.spans for r in find_documents(docs_of(rows, str(tmp_path / "d"))).collect()}
    assert got[50] == "email:16:34" and got[51] == "email:15:33" and got[52] == ""
    none = find_documents(docs_of(rows, str(tmp_path / "e")), FindSettings(least_support=50)).collect()
    assert {r.doc_id: r.spans for r in none}[50] == ""


def test_private_data_is_native(spark):
    plan = QUERIES["op10_private_data"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def turn_rows(conversations):
    """(pair_id, part, turn, ord, role, text) by brute force."""
    out = []
    for pair, (a, b) in conversations.items():
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        out += [(pair, "prompt", *t) for t in a[:n]] + [(pair, "chosen", *t) for t in a[n:]] + [(pair, "rejected", *t) for t in b[n:]]
    return out


def test_prefix_and_completions(spark):
    schema = "pair_id long, turn long, role string, text string, part string"
    a = [(1, 0, "user", "q", "z"), (1, 1, "assistant", "good", "z"), (2, 0, "user", "same", "z"), (3, 0, None, None, "z"), (3, 1, "user", "x", "z"),
         (4, 0, "user", "alone", "z"), (None, 0, "user", "n", "z"), (5, 0, "user", "twice", "z"), (5, 0, "user", "twice", "z"), (6, 0, "user", "<|im_end|>", "z")]
    b = [(1, 0, "user", "q", "z"), (1, 1, "assistant", "bad", "z"), (1, 2, "user", "more", "z"), (2, 0, "user", "same", "z"), (3, 0, None, None, "z"),
         (None, 0, "user", "n", "z"), (5, 0, "user", "twice", "z"), (6, 0, "user", "y", "z")]
    rows = format_preferences(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema))

    def sides(x):
        out = {}
        for p, t, r, s, _ in x:
            out.setdefault(p, []).append((t, sum(q[0] == t for q in out.get(p, [])), r, s))
        return out

    one, two = sides(a), sides(b)
    want = turn_rows({p: (one.get(p, []), two.get(p, [])) for p in {*one, *two}})
    show = lambda r, t: f"<|im_start|>{r or ''}\n{(t or '').replace('<|im_', '<| im_')}<|im_end|>\n"
    want = [(p, part, t, o, r, show(r, s), part != "prompt" and r == "assistant") for p, part, t, o, r, s in want]
    assert sorted((tuple(r) for r in rows.collect()), key=str) == sorted(want, key=str)
    joined = {r.pair_id: r for r in examples(rows).collect()}
    assert joined[1].prompt == show("user", "q") and joined[1].rejected == show("assistant", "bad") + show("user", "more")
    assert [p.loss for p in joined[1].rejected_parts] == [True, False] and joined[2].chosen == ""
    assert format_preferences(spark.createDataFrame([], schema), spark.createDataFrame([], schema)).count() == 0


def test_conversation_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    want = con.sql(ORACLE["op2_preference_format"]).fetchall()
    assert ORACLE["op2_preference_format"] == CONVERSATION_SQL
    got = QUERIES["op2_preference_format"](spark, SF)
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got.collect())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    chosen, rejected = conversation_pairs(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert chosen.count() == rejected.count() == 0


def test_ridge_equals_plain_kernel_ridge_regression():
    """The chunked sums against plain kernel ridge regression with the same
    kernel, all rows as landmarks."""
    from marketlens.llm import language_id as L
    rng = np.random.default_rng(5)
    settings = Settings(buckets=256, ridge=0.3)
    x = (rng.random((90, 256)) < 0.15).astype(np.uint8)
    label = np.sort(rng.integers(0, 3, 90))
    landmarks = x.astype(np.float32)
    for chunk in (7, 512):
        L.CHUNK_ROWS, old = chunk, L.CHUNK_ROWS
        weights = L.ridge(np.packbits(x, axis=1), label, 3, landmarks, settings)
        L.CHUNK_ROWS = old
        kernel = np.array([[(a & b).sum() / np.sqrt(a.sum() * b.sum()) for b in x] for a in x])
        balance = (1 / np.bincount(label))[label]
        y = np.where(label[:, None] == np.arange(3), 1.0, -1.0)
        dual = np.linalg.solve(kernel * balance[None, :] + settings.ridge * np.eye(90), y)
        assert np.allclose(kernel @ weights, kernel @ (balance[:, None] * dual), atol=1e-3)


def test_many_languages_and_repeated_ids(spark):
    from marketlens.llm import language_id as L
    rows = [(k % 3, f"{chr(0x4E00 + 40 * g + k % 5)}{chr(0x4E00 + 40 * g + k % 7)} {chr(0x4E05 + 40 * g)}", f"l{g:03}") for g in range(120) for k in range(12)]
    frame = spark.createDataFrame(rows, "key long, text string, lang string")
    models = [L.train(f, Settings(per_class=6)) for f in (frame, frame.repartition(5, "text"))]
    assert len(models[0].languages) == 120 and np.array_equal(models[0].weights, models[1].weights)
    with pytest.raises(ValueError, match="languages"):
        L.train(frame, Settings(max_classes=119))


def test_stage_without_labels_keeps_documents(spark, docs_of, tmp_path):
    docs = docs_of([(1, "some text", None, "s"), (2, "12 -", None, "s"), (3, None, None, "s"), (4, "x", None, None)], str(tmp_path / "d"))
    assert sorted(r.doc_id for r in keep_identified(docs).collect()) == [1, 4]
    assert keep_identified(docs.limit(0)).collect() == []


@pytest.mark.parametrize("name", ["inline", "inline in blocks", "quotes", "closed quotes", "nested", "lists", "comment", "cells"])
def test_long_and_odd_pages_take_little_time(name):
    import time
    page = {"inline": "<div><p>text, here. " + "<b>x " * 60_000 + "</p>" * 100 + "</div>", "inline in blocks": "<b>x <p>y " * 40_000,
            "quotes": '<a href="x' * 80_000 + "<p>text</p>", "closed quotes": '<a href="x>' * 60_000 + "<p>text</p>",
            "nested": '<div class="a">' * 60_000 + "text, long. ", "lists": "<li>a<p>b" * 60_000, "comment": "<!-- " * 100_000,
            "cells": "<table>" + "<tr><td>a, b." * 60_000}[name]
    begin = time.process_time()
    main_text(page)
    assert time.process_time() - begin < 5


def brute_bootstrap(edges, rounds, least_support, least_score, least_confidence, unknown_weight):
    """(value, kind, confidence) of (pattern, value, kind) edges, plainly."""
    from marketlens.llm.private_data import KINDS, SHAPES
    shapes = {v: [n for n, k in enumerate(KINDS) if re.search(SHAPES[k], v)] for _, v, k in edges if k is None}
    open_ = {(p, v, t) for p, v, k in edges if k is None for t in shapes[v]}
    found = {}
    for _ in range(rounds):
        scores = {}
        for p, t in {(p, t) for p, _, t in open_}:
            seeds = sum(q == p and k == t for q, _, k in edges)
            against = sum(q == p and (k != t if k is not None else t not in shapes[v]) for q, v, k in edges)
            places = [v for q, v, u in open_ if (q, u) == (p, t)]
            support = seeds + sum(found.get((v, t), 0) for v in places)
            score = support / (support + against + unknown_weight * sum((v, t) not in found for v in places) + 0.25)
            if support >= least_support and score >= least_score:
                scores[p, t] = score
        found = {}
        for v, t in {(v, t) for _, v, t in open_}:
            miss = 1.0
            for p, w, u in open_:
                if (w, u) == (v, t) and (p, t) in scores:
                    miss *= 1 - scores[p, t]
            if 1 - miss >= least_confidence:
                found[v, t] = 1 - miss
    best = {}
    for (v, t), c in found.items():
        if v not in best or (c, -t) > (best[v][1], -best[v][0]):
            best[v] = t, c
    return {(v, t, round(c, 9)) for v, (t, c) in best.items()}


def test_bootstrap_equals_brute_force(spark):
    import random
    from marketlens.llm.private_data import bootstrap
    rng = random.Random(3)
    values = [f"0{k}0 555 12{k}4" for k in range(10, 30)] + [f"{k}.{k}.{k}.9" for k in range(5)] + ["jo(at)m.example", "al at m dot example", "12 34", "4111 1111 1111 1"]
    known = [(f"p{k}@x.y", 0) for k in range(6)] + [(f"1.1.1.{k}", 1) for k in range(6)] + [(f"+49 30 55512{k}0", 3) for k in range(20)]
    edges = {(f"w{rng.randrange(9)} _", *rng.choice(known)) for _ in range(70)} | {(f"w{rng.randrange(12)} _", rng.choice(values), None) for _ in range(70)}
    frame = spark.createDataFrame(sorted(edges, key=str), "pattern string, value string, kind int")
    for s in (FindSettings(), FindSettings(rounds=4, least_support=2.0, least_score=0.5, least_confidence=0.5)):
        got = {(r.value, r.kind, round(r.confidence, 9)) for r in bootstrap(frame, s).collect()}
        assert got == brute_bootstrap(edges, s.rounds, s.least_support, s.least_score, s.least_confidence, s.unknown_weight)
    assert got


def test_values_with_blanks_are_found(spark, docs_of, tmp_path):
    rows = [(k, f"you may call us under +49 30 555 12{k}4 at any time, day or night", None, None) for k in range(8)]
    rows += [(20 + k, f"please write to p{k}@mail.example soon, or be late", None, None) for k in range(8)]
    rows += [(50, "you may call us under (030) 555 1234 at any time", None, None), (51, "please write to bob at example dot com soon, or be late", None, None),
             (52, "the sum of (030) 555 1234 and more", None, None), (53, "pages 12 34 56 of it", None, None), (54, "look at example dot com", None, None)]
    got = {r.doc_id: r.spans for r in find_documents(docs_of(rows, str(tmp_path / "d"))).collect()}
    assert got[50] == "phone:22:36" and got[51] == "email:16:38" and got[52] == "phone:11:25" and got[53] == "" and got[54] == ""
    assert got[0] == "phone:22:37"


PARAGRAPH = "The council met on Monday, and it agreed, after a long debate, to build the bridge; work begins in May."


@pytest.mark.parametrize("page,want", [
    ("<h1>Bridge agreed</h1><div class=story>{p}{p}</div><p>foot</p>", ["Bridge agreed", "P", "P"]),
    ("<ul><li><a href=1>Home</a><li><a href=2>News</a></ul><h2>T</h2>{p}{p}", ["T", "P", "P"]),
    ("<div class=thread><p>I disagree, strongly, with this, and with that.</p></div><div>{p}{p}</div>", ["P", "P"]),
    ("<article>{p}<div class='social-history'>{p}</div><div class=related-work>{p}</div><div class='share-prices'>{p}</div></article>", ["P"] * 4),
    ("<article>{p}<div class='share-buttons'>x</div><div class='related-articles'>{p}</div><div class='comment-list'>{p}</div></article>", ["P"]),
    ("<p><a href=1>one</a></p><p><a href=2>two</a></p>", ["one", "two"])])
def test_parts_are_chosen_by_their_place_and_values(page, want):
    html = "<html><body>" + page.replace("{p}", f"<p>{PARAGRAPH}</p>") + "</body></html>"
    assert main_text(html).split("\n") == [PARAGRAPH if w == "P" else w for w in want]
