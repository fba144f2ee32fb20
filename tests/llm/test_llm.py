"""The training-data operators against brute force, libraries, SQL, and odd rows."""

import base64
import hashlib
import os
import sys
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oracle import connect, differences  # noqa: E402
from placewell.llm import (  # noqa: E402
    byte_bpe, html_text, licenses, near_dedup, neighbours, packing, quality_classifier, quality_rules,
    token_counts, url_filters,
)
from placewell.llm.components import components  # noqa: E402
from placewell.llm.queries import ORACLE, QUERIES  # noqa: E402
from placewell.llm.ragged import Texts  # noqa: E402
from placewell.llm.workers import importable  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
UNITS, RANKS, PIECES = (public_tokenizers.path(n) for n in (
    "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"))
LONG = " ".join(f"word{i * i % 977} it's" for i in range(4000)) + "a" * 3000 + "​" * 7
TEXTS = [None, "", "  ", "a b", "a b", "it's '' 'S  x\n\n y<|endoftext|> z ", "aaaaaaa", "ñandú 東京 😀 12³", LONG, LONG]


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    importable(spark)


@pytest.fixture
def odd(spark):
    rows = [(None if k == 3 else k // 2, t, "x", True) for k, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, row string, kept boolean").repartition(3)


def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoding_is_the_librarys(spark, odd):
    encode = library().encode_ordinary
    wanted = Counter()
    for k, t in enumerate(TEXTS):
        ids = encode(t or "")
        wanted[(None if k == 3 else k // 2, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256((t or "").encode()).hexdigest())] += 1
    assert Counter(map(tuple, byte_bpe.encode_documents(odd, RANKS).collect())) == wanted
    assert byte_bpe.encode_documents(odd.limit(0), RANKS).count() == 0


def test_decoding_is_exact(spark, odd):
    found = byte_bpe.decode_documents(byte_bpe.encode_documents(odd, RANKS, keep_ids=True), RANKS)
    assert Counter(bytes(r.content).decode() for r in found.collect()) == Counter(t or "" for t in TEXTS)


def test_counts_are_the_librarys(spark, odd):
    model = Tokenizer.from_file(UNITS)
    wanted = Counter()
    for k, t in enumerate(TEXTS):
        n = len(model.encode(t or "", add_special_tokens=False).ids)
        wanted[(None if k == 3 else k // 2, len((t or "").encode()), n, n > 1024)] += 1
    assert Counter(map(tuple, token_counts.count_tokens(odd, UNITS).collect())) == wanted


def check_packing(rows, ids):
    by_sequence, by_doc = {}, Counter()
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc[(r.doc_id, r.doc_tokens)] += r.length
        assert any(zlib.crc32(np.array(own[r.start:r.start + r.length], "<u4").tobytes()) == r.ids_crc32
                   for own in ids[r.doc_id] if len(own) == r.doc_tokens)
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    wanted = Counter()
    for doc, many in ids.items():
        for own in many:
            wanted[(doc, len(own))] += len(own)
    assert by_doc == wanted


def test_packing_keeps_every_id_once(spark, odd):
    model = Tokenizer.from_file(UNITS)
    ids = {}
    for r in odd.collect():
        ids.setdefault(r.doc_id, []).append(model.encode(r.text or "", add_special_tokens=False).ids + [0])
    check_packing(packing.pack(odd, UNITS).collect(), ids)
    assert packing.pack(odd.limit(0), UNITS).count() == 0


def test_packing_pads_little_where_one_length_is_common():
    for histogram in ({88: 500}, {70: 300, **{k: 3 for k in range(1, 129)}}):
        rows, sequences = packing.plan(histogram, 128)
        covered = Counter()
        for length, low, high, _, size, *_ in rows:
            covered[length] += size * (high - low)
        assert covered == {k: k * n for k, n in histogram.items()}
        assert sum(covered.values()) >= 0.93 * sequences * 128


def test_licences_agree_with_sql_and_rules(spark, odd):
    con = connect(SF_DIR)
    assert differences(QUERIES["op2_license_scan"](spark, SF_DIR), con, ORACLE["op2_license_scan"]) == []
    text = ("Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in "
            "compliance with the License.\nfoo.\nReleased under the MIT License. All rights reserved.")
    rows = spark.createDataFrame([(text,), (None,), ("",)], "text string")
    found = [r.licence for r in licenses.scan(rows).collect()]
    assert found[0].names == ["Apache-2.0", "MIT", "all-rights-reserved"] and found[0].n_sentences == 4
    assert found[0].sentence_ids == "APACHE2_REF,APACHE2_USE,;,MIT_REF,RESERVED"
    assert [(f.sentence_ids, f.n_sentences, f.names) for f in found[1:]] == [("", 0, [])] * 2
    assert licenses.scan(odd).columns == [*odd.columns, "licence"]


def test_urls_agree_with_sql(spark):
    con = connect(SF_DIR)
    assert differences(QUERIES["op9_url_filters"](spark, SF_DIR), con, ORACLE["op9_url_filters"]) == []


def test_aliases_take_over_blocks(spark):
    urls = ["http://a.org/x", "http://a.org/x#top", "http://b.org/y", "http://example.net/es/1", "http://c.org/z",
            "https://www.example.com/en/1", "http://EXAMPLE.com/en/9", None, "mailto:x", "http://d.org/"]
    pages = spark.createDataFrame([(k, u, "n") for k, u in enumerate(urls)], "page_id long, url string, node string")
    edges = spark.createDataFrame([
        ("http://a.org/x", "http://b.org/y"), ("http://b.org/y", "http://example.net/es/1"),
        ("http://c.org/z", "http://example.net/fr/2"), ("http://c.org/z", "https://www.example.com/en/1")],
        "src string, dst string")
    found = {r.page_id: (r.judged.host, r.judged.path, r.judged.rule, r.judged.verdict)
             for r in url_filters.judge_urls(pages, edges).collect()}
    assert [found[k][3] for k in range(10)] == [
        "block", "block", "block", "block", "allow", "allow", "block", "allow", "allow", "allow"]
    assert found[6] == ("example.com", "/en/9", "example.com/en/", "block") and found[7][:3] == ("", "", None)
    html = '<link href="/en/1?x#y" rel=canonical><meta http-equiv="Refresh" content="0; url=//b.org/z">'
    page = spark.createDataFrame([("http://a.org/p/q", html)], "url string, html string")
    assert {r.dst for r in url_filters.page_edges(page).collect()} == {"http://a.org/en/1?x", "http://b.org/z"}


def test_components(spark):
    chain = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3), (30, 29)]
    found = {r.node: r.component for r in components(spark.createDataFrame(chain, "src long, dst long")).collect()}
    assert found == {k: 0 for k in range(31)} | {k: 100 for k in range(100, 140)}
    assert components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_main_text():
    page = """<html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header><h1>Site</h1></header>
    <nav><a href=/>Home</a></nav><div class="cookie-notice">We use cookies, a lot of them, really.</div>
    <div id=content><article><h1>Head &amp; tail</h1><p><b>One, two,  three</b> four.<p>Five&nbsp;six &lt;seven&gt;
    <ul><li>item one<li>item two</ul><script>var a="</p>";</script><form>Name<input></form>
    <div class="comments"><p>I disagree, strongly, with all of this.</p></div></article></div>
    <aside>More, more, more</aside><footer>&copy; us</footer></body></html>"""
    assert html_text.main_text(page) == "Head & tail\nOne, two, three four.\nFive six <seven>\nitem one\nitem two"
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<p></p><nav>x</nav>") == ""
    assert html_text.main_text("<div><p>Cut off, in the middle &amp of <b") == "Cut off, in the middle & of"


def test_pages_keep_rows_and_columns(spark):
    pages = spark.createDataFrame([(1, None, "t"), (1, "<p>a</p>", "u")], "page_id long, html string, text string")
    found = html_text.extract(pages)
    assert found.columns == ["page_id", "text", "n_chars"]
    assert sorted(map(tuple, found.collect())) == [(1, "", 0), (1, "a", 1)]


def brute_rules(text):
    words = [w for w in text.encode().split()]
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    return (len(words), sum(len(w.decode()) for w in words), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered))


def test_quality_rules_against_brute_force(spark, odd):
    more = ["x y z " * 9, "l #\nl #\n\n \n \nl #", " ".join("abcdefgh" * 3) + " q"]
    rows = odd.unionByName(spark.createDataFrame([(50 + k, t, "x", True) for k, t in enumerate(more)], odd.schema))
    rows = rows.selectExpr("*", "CAST(NULL AS STRING) AS lang")
    found = quality_rules.judge(rows, PIECES, UNITS)
    assert found.columns == [*rows.columns, "rules"]
    for r in found.collect():
        q, wanted = r.rules.quality, brute_rules(r.text or "")
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == wanted
        failed = wanted[0] < 20 or 100 * wanted[4] > 30 * wanted[0]
        assert r.rules.base_failed == failed and not (failed and r.rules.kept)
    assert quality_rules.judge(rows.limit(0), PIECES, UNITS).count() == 0


def test_classifier_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = quality_classifier.classify(docs, labels.where("doc_id % 2 = 0")).join(
        labels.where("doc_id % 2 = 1"), "doc_id").select("sampling.kept", "quality").collect()
    assert sum(r.kept == (r.quality == 1) for r in found) >= 0.95 * len(found)
    assert sum(not r.kept for r in found if r.quality == 1) <= 0.02 * len(found)


def test_classifier_odd_rows(spark, odd):
    labels = spark.createDataFrame([(4, 1, 0), (None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    found = quality_classifier.classify(odd, labels).collect()
    assert len(found) == len(TEXTS)
    assert all(not r.sampling.kept for r in found if not (r.text or "").strip())
    none = quality_classifier.classify(odd, labels.limit(0)).collect()
    assert all(r.sampling.kept == bool((r.text or "").strip()) for r in none)
    assert quality_classifier.classify(odd.limit(0), labels).count() == 0


def test_kth_largest(spark):
    rows = spark.range(5000).selectExpr("cast(pmod(id * 7919, 5000) div 3 as double) as x")
    values = sorted((r.x for r in rows.collect()), reverse=True)
    assert [quality_classifier.kth_largest(rows, "x", k) for k in (1, 2500, 5000)] == [values[0], values[2499], values[4999]]


def test_near_duplicates_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    base = [[f"w{rng.integers(5000)}" for _ in range(120)] for _ in range(30)]
    texts = []
    for words in base:
        texts.append(" ".join(words))
        for edits in (1, 2, 9):
            copy = list(words)
            for _ in range(edits):
                copy[rng.integers(len(copy))] = f"v{rng.integers(5000)}"
            texts.append(" ".join(copy))
    texts += [texts[0], texts[0].upper() + "!", None, None, "", " .", "short text", "short text"]
    rows = spark.createDataFrame([(k, t, 1, "k") for k, t in enumerate(texts)], "doc_id long, text string, node int, key string")
    found = {r.doc_id: r for r in near_dedup.classes(rows).collect()}
    sets = [Counter(tuple((t or "").lower().split()[i:i + 5]) for i in range(max(1, len((t or "").split()) - 4))) for t in texts[:120]]
    above = list(range(120))

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    for a in range(120):
        for b in range(a):
            both = sum((sets[a] & sets[b]).values())
            if both >= 0.8 * (sets[a].total() + sets[b].total() - both):
                above[max(top(a), top(b))] = min(top(a), top(b))
    assert [found[k].class_id for k in range(120)] == [top(k) for k in range(120)]
    assert [found[k].class_id for k in range(120, 128)] == [0, 0, 122, 123, 124, 124, 126, 126]
    kept = near_dedup.drop_near_duplicates(rows)
    assert kept.columns == rows.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, r in found.items() if r.is_kept}
    assert near_dedup.classes(rows.limit(0)).count() == 0


def test_pairs_hidden_in_groups_of_other_texts(spark):
    # texts from one template: every sketch is shared by many that are no near-duplicates
    rng = np.random.default_rng(11)
    picks = (rng.random((120, 24)) < 0.25).astype(int)
    for k in range(0, 24, 2):  # a text and one that differs in one slot
        picks[119 - k] = picks[k]
        picks[119 - k, k] ^= 1
    texts = [" ".join(f"s{slot}v{v}w{w}" for slot, v in enumerate(row) for w in range(8)) for row in picks.tolist()]
    sets = [{tuple(t.split()[i:i + 5]) for i in range(24 * 8 - 4)} for t in texts]
    names = {x: k for k, x in enumerate(sorted(set().union(*sets)))}
    there = np.zeros((120, len(names)))
    for k, found in enumerate(sets):
        there[k, [names[x] for x in found]] = 1
    both = there @ there.T
    pairs = np.argwhere(np.triu(both >= 0.8 * (2 * len(sets[0]) - both), 1)).tolist()
    assert 12 <= len(pairs) < 60
    # every similar pair meets in a group, however many others share its sketches
    hashed = [near_dedup.shingles(Texts(pa.array([t])))[0].tobytes() for t in texts]
    met = {}
    for r in near_dedup.rare_shingles(spark.createDataFrame(
            list(enumerate(hashed)), "node long, shingles binary"), 0.8)[0].collect():
        met.setdefault(r.node, set()).add(r.g)
        assert r.n == 24 * 8 - 4
    assert all(met[a] & met[b] for a, b in pairs)
    assert sum(bool(met[a] & met[b]) for a in range(120) for b in range(a)) < 120 * 119 / 2


def test_groups_of_rare_shingles_do_not_grow_with_the_number_of_texts(spark):
    # 20,000 texts that all have words of their own and one passage: counted in few buckets all shingles are frequent
    rng = np.random.default_rng(2)
    passage = rng.integers(0, 2**63, 60, dtype=np.uint64)
    rows, size = [], 200
    for k in range(0, 20_000, 2):
        text = rng.integers(0, 2**63, size, dtype=np.uint64)
        text[:60] = passage
        twin = text.copy()
        twin[100:110] = rng.integers(0, 2**63, 10, dtype=np.uint64)
        rows += [(k, text.tobytes()), (k + 1, twin.tobytes())]
    found = near_dedup.rare_shingles(spark.createDataFrame(rows, "node long, shingles binary").repartition(8), 0.8)[0]
    sizes = found.groupBy("g").count().groupBy("count").count().collect()
    assert {r[0] for r in sizes} == {2}  # twins meet, the passage brings nobody together
    assert found.groupBy("node").count().agg({"count": "min"}).head()[0] == 190 - 160 + 1 and found.select("node").distinct().count() == 20_000


def test_signs_let_all_similar_texts_through(spark):
    rng = np.random.default_rng(4)
    texts = []
    for k in range(60):
        base = rng.integers(0, 2**63, rng.integers(5, 900), dtype=np.uint64)
        base[rng.random(len(base)) < 0.2] = base[0]
        other = base.copy()
        other[rng.random(len(base)) < rng.random() * 0.3] = 3
        texts += [base, np.delete(other, rng.integers(0, len(other), len(other) // 15))]
    rare, signs = near_dedup.rare_shingles(spark.createDataFrame(
        [(k, t.tobytes()) for k, t in enumerate(texts)], "node long, shingles binary"), 0.8)
    sizes = spark.createDataFrame([(k, len(t)) for k, t in enumerate(texts)], "node long, n long")
    rows = signs.join(sizes, "node")
    hubs = rows.selectExpr("node AS hub", "n AS hub_n", "sign AS hub_sign")
    through = {(r.hub, r.node) for r in rows.crossJoin(hubs).where(near_dedup.may_be_similar(0.8)).collect()}
    alike = {(a, b) for a in range(120) for b in range(120) if near_dedup.similar(texts[a], texts[b])}
    assert alike <= through and len(alike) > 150 and len(through) < 1.5 * len(alike)


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((6, 16))
    vectors = [(k, [float(x) for x in np.float32(centres[k % 6] + rng.standard_normal(16))]) for k in range(800)]
    vectors += [(k, vectors[0][1]) for k in range(800, 840)]
    odd_rows = [(900, None), (920, [0.0] * 16), (940, [float("nan")] * 16), (960, [1.0]), (None, vectors[1][1]), (980, [None] * 16)]
    rows = spark.createDataFrame(vectors + odd_rows, "vec_id long, embedding array<float>")
    found = {}
    for r in neighbours.nearest(rows).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    ids, matrix = np.array([v[0] for v in vectors]), np.array([v[1] for v in vectors])
    assert set(found) == {k for k in range(840) if k % 20 == 0}
    hits = 0
    for query, got in found.items():
        score = matrix @ matrix[query]
        score[query] = -np.inf
        best = np.lexsort((ids, -np.round(score, 9)))[:20]
        got.sort()
        assert [g[0] for g in got] == list(range(1, 21)) and query not in [g[1] for g in got]
        assert np.allclose([g[2] for g in got], [score[g[1]] for g in got])
        hits += len(set(best.tolist()) & {g[1] for g in got})
    assert hits >= 0.9 * 20 * len(found)


def test_one_very_long_vector_leaves_the_others_apart(spark):
    rng = np.random.default_rng(5)
    matrix = rng.standard_normal((400, 16))
    matrix[7] *= 1e6
    rows = spark.createDataFrame(list(enumerate(matrix.tolist())), "vec_id long, embedding array<double>")
    found = {}
    for r in neighbours.nearest(rows, stride=40).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for query, got in found.items():
        score = matrix @ matrix[query]
        score[query] = -np.inf
        hits += len(set(np.argsort(-score)[:20].tolist()) & got)
    assert len(found) == 10 and hits >= 0.9 * 200


def test_few_vectors(spark):
    rows = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [1.0, 0.0])], "vec_id long, embedding array<float>")
    found = [tuple(r) for r in neighbours.nearest(rows).orderBy("query_id", "rank").collect()]
    assert found == [(0, 1, 20, 1.0), (0, 2, 1, 0.5), (20, 1, 0, 1.0), (20, 2, 1, 0.5)]
    assert neighbours.nearest(rows.limit(0)).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == columns, name
    kept = docs.count()
    assert 0 < kept < before
    assert corpus_pipeline.run(spark, SF_DIR).select("doc_id").distinct().count() == kept


def test_merging_looks_up_only_pairs_that_a_merge_has_changed(monkeypatch):
    merges = token_counts.read_json(public_tokenizers.path("byte_bpe_50k.json"))[0]
    words = [b" international", b"x" * 64, "straßenbahnhaltestelle".encode(), b"a", b"the", bytes(range(33, 120))]
    looked_up, rank = [], merges.rank
    monkeypatch.setattr(merges, "rank", lambda a, b: looked_up.append(np.size(a)) or rank(a, b))
    counts, ids = token_counts.merge_words(words, merges)
    merged = sum(map(len, words)) - counts.sum()
    assert sum(looked_up) <= 2 * merged
    vocabulary = {n: t for t, n in merges.tokens.items()}
    ends = np.cumsum(counts)
    assert [b"".join(vocabulary[i] for i in ids[e - n:e].tolist()) for e, n in zip(ends, counts, strict=True)] == words
