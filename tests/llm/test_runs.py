"""Periodic runs against brute force, and odd rows."""

import hashlib
import os
import re
import sys
import zlib
from fractions import Fraction

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from placewell.llm import periodic_runs  # noqa: E402
from placewell.llm.queries import QUERIES  # noqa: E402
from placewell.llm.workers import importable  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    importable(spark)


def brute(words):
    """Every maximal stretch of each period; the smallest period of a stretch counts."""
    found = {}
    n = len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i) + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def collapse(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def made_texts():
    rng = np.random.default_rng(7)
    texts = [[], ["a"], ["a"] * 6, ["a"] * 5, ["a", "b"] * 4, ["a", "b"] * 3 + ["a"]]
    for k in range(220):
        words = rng.integers(0, [2, 3, 4, 50][k % 4], rng.integers(1, 60)).tolist()
        for _ in range(rng.integers(0, 4)):
            p, times = int(rng.integers(1, [4, 12, 40, 90][k % 4])), float(rng.choice([3.9, 4, 4.3, 5, 7.7, 16]))
            unit = rng.integers(0, [2, 3, 40][k % 3], p).tolist()
            if k % 5 == 0:  # a period that repeats itself inside
                unit = unit * int(rng.integers(2, 9)) + rng.integers(0, 9, 3).tolist()
            words += (unit * 17)[:int(len(unit) * times)] + rng.integers(0, 5, rng.integers(0, 20)).tolist()
        texts.append([f"w{w}" for w in words])
    return texts


def test_runs_are_those_of_brute_force():
    texts = made_texts()
    names = {w: k for k, w in enumerate(sorted({w for t in texts for w in t}))}
    codes = np.array([names[w] for t in texts for w in t], np.int64)
    text, *rest = periodic_runs.runs(codes, np.array([len(t) for t in texts], np.int64))
    got = [[] for _ in texts]
    for k, run in zip(text.tolist(), zip(*(x.tolist() for x in rest), strict=True), strict=True):
        got[k].append(run)
    for words, found in zip(texts, got, strict=True):
        assert found == brute(words)
    assert sum(q >= 64 for found in got for _, _, q in found) > 20


def test_odd_rows(spark):
    texts = [None, "", " \n ", "x x x x x x", "x x x x x x", "é " * 9 + "b", "t " * 40_000, " a  " * 7]
    rows = [(None if k == 4 else k // 2, t, "r", 1) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, collapsed int").repartition(3)
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed)
                  for r in periodic_runs.find_runs(docs).collect()), key=str)
    want = []
    for row in rows:
        words = re.findall("[^\x20\x09-\x0D]+", row[1] or "")
        runs = [(0, 40_000, 1)] if len(words) == 40_000 else brute(words)
        left = "t" if len(words) == 40_000 else collapse(words, runs)
        want.append((row[0] is None, row[0] or 0, len(words), runs, left))
    assert got == sorted(want, key=str)
    assert periodic_runs.find_runs(docs.limit(0)).count() == 0


def test_query_against_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, SF_DIR).collect()}
    assert got.keys() == texts.keys()
    planted = 0
    for doc_id, text in texts.items():
        words = re.findall("[^\x20\x09-\x0D]+", text or "")
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        g = h // 10
        if n > 1500:
            continue
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        runs = brute(words)
        row = got[doc_id]
        assert row.n_runs == len(runs)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
        assert (row.start, row.length, row.period) == best
        assert row.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(collapse(words, runs).encode()).hexdigest()
    assert planted > 5
