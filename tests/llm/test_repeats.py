"""Suffix sorting and the removal of repeats against brute force, and odd rows."""

import hashlib
import os
import sys
from collections import Counter

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from placewell.llm import repeated_spans  # noqa: E402
from placewell.llm.queries import QUERIES  # noqa: E402
from placewell.llm.suffix_sort import PAD, sort_suffixes  # noqa: E402
from placewell.llm.workers import importable  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    importable(spark)


def brute(texts, length):
    """n_bytes, spans and kept bytes of each text."""
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    found = []
    for d in data:
        gone = np.zeros(len(d) + 1, np.int64)
        for i in range(len(d) - length + 1):
            if count[d[i:i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        gone = np.cumsum(gone)[:len(d)] > 0
        edges = np.flatnonzero(np.diff(np.r_[0, gone.astype(int), 0])).tolist()
        found.append((len(d), list(zip(edges[::2], edges[1::2], strict=True)), bytes(np.frombuffer(d, np.uint8)[~gone])))
    return found


def test_suffixes_are_in_order():
    rng = np.random.default_rng(1)
    for trial in range(120):
        a = rng.integers(0, [2, 3, 256][trial % 3], rng.integers(1, 300)).astype(np.uint8)
        data = np.concatenate([a, a[:len(a) // 2], a, np.zeros([50, 500][trial % 2], np.uint8), a])
        depth = int(rng.choice([1, 7, 8, 9, 16, 17, 40, 100]))
        starts = rng.permutation(max(len(data) - depth + 1, 0))
        order, equal = sort_suffixes(np.r_[data, np.zeros(PAD, np.uint8)], starts, depth)
        found = [data[k:k + depth].tobytes() for k in starts[order]]
        assert found == sorted(found)
        assert equal.tolist() == [k > 0 and found[k] == found[k - 1] for k in range(len(found))]


def odd_texts():
    rng = np.random.default_rng(2)
    words = [f"wörd{k}" for k in range(40)]
    passage = " ".join(rng.choice(words, 30))
    texts = [None, "", "short", "short", "ab" * 40, passage, passage, "x" + passage[5:] + "y" * 70]
    for k in range(60):
        texts.append(" ".join(rng.choice(words, rng.integers(1, 30))) + passage[k:k + 90] + " ".join(rng.choice(words, 9)))
    return texts


@pytest.mark.parametrize("most", [4_000, 2])
def test_odd_rows(spark, monkeypatch, most):
    texts = odd_texts()
    rows = [(None if k == 6 else k // 2, t, "r", 1) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, key int").repartition(3)
    got = repeated_spans.remove_repeats(docs, length=64, most_regions=most).collect()
    want = [(r[0], *x) for r, x in zip(rows, brute(texts, 64), strict=True)]
    assert sorted(((r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in got), key=str) == sorted(want, key=str)
    assert sum(len(x[2]) > 0 for x in want) > 30
    assert repeated_spans.remove_repeats(docs.limit(0)).count() == 0


def test_very_long_texts_come_in_blocks(spark):
    rng = np.random.default_rng(4)
    base = "".join(map(chr, rng.integers(97, 123, repeated_spans.BLOCK + 3000).tolist()))
    texts = [base, base[-2500:] + "é" * 10 + base[1000:2500], "z" * 900, base[:300]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = sorted((r.doc_id, r.n_bytes, [tuple(s) for s in r.spans]) for r in repeated_spans.remove_repeats(docs).collect())
    n = len(base)
    assert got == [(0, n, [(1000, 2500), (n - 2500, n)]), (1, 4020, [(0, 2500), (2520, 4020)]), (2, 900, [(0, 900)]),
                   (3, 300, [])]


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_repeated_spans"](spark, SF_DIR).collect()}
    assert len(got) == len(rows)
    for row, (n, spans, kept) in zip(rows, brute([r.text for r in rows], 400), strict=True):
        removed = sum(b - a for a, b in spans)
        assert got[row.doc_id] == (n, removed, len(spans), hashlib.sha256(kept).hexdigest())
