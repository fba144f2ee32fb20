"""The quality draw against brute force, hidden near-duplicates end to end, and the pipeline on odd rows."""

import math
import os
import re
import struct
import sys
import zlib

import numpy as np
import pytest
import xxhash

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from placewell.llm import near_dedup, quality_classifier  # noqa: E402
from placewell.llm.queries import QUERIES  # noqa: E402
from placewell.llm.workers import importable  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
WORD = 2**64 - 1


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    importable(spark)


def buckets(text):
    """Bucket of each word and pair, in plain numbers."""
    import regex

    words = [w.lower() for w in regex.findall(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\p{White_Space}]+", text or "")]
    h = [zlib.crc32(w.encode()) for w in words]
    mixed = [x * 0x9E3779B97F4A7C15 & WORD for x in h]
    out = [(x >> 33) % quality_classifier.BUCKETS for x in mixed]
    for k in range(len(h) - 1):
        pair = ((mixed[k] ^ (mixed[k] >> 29)) * 0xBF58476D1CE4E5B9 + mixed[k + 1]) & WORD
        if h[k] == h[k + 1]:
            pair = quality_classifier.REPEAT
        out.append(((((pair ^ (pair >> 31)) * 0x94D049BB133111EB) & WORD) >> 33) % quality_classifier.BUCKETS)
    return out


def noise(doc_id, text):
    seed = xxhash.xxh64_intdigest(struct.pack("<i", quality_classifier.SEED), seed=42)
    seed = xxhash.xxh64_intdigest(struct.pack("<q", doc_id), seed=seed)
    h = xxhash.xxh64_intdigest(text.encode(), seed=seed)
    draw = (h - 2**64 if h >= 2**63 else h) / 2.0**64 + 0.5
    return -math.log(-math.log(min(max(draw, 1e-15), 1 - 1e-15)))


def test_weights_and_draw_are_those_of_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    good = {r.doc_id for r in labels.collect() if r.quality == 1}
    known = {r.doc_id for r in labels.collect() if r.quality is not None}
    found = {k: buckets(t) for k, t in rows.items()}
    size = quality_classifier.BUCKETS
    total, liked = np.zeros(size), np.zeros(size)
    for k, b in found.items():
        np.add.at(total, b, 1)
        if k in good:
            np.add.at(liked, b, 1)
    ratio = np.log((liked + 1) / (liked.sum() + size)) - np.log((total + 1) / (total.sum() + size))
    keys = {k: ratio[b].sum() + 0.3 * noise(k, rows[k]) for k, b in found.items() if b}
    count = round(len(good) / len(known) * len(keys))
    kept = set(sorted(keys, key=keys.get, reverse=True)[:count])
    got = {r.doc_id: r for r in QUERIES["op5_quality_classifier"](spark, SF_DIR).collect()}
    assert got.keys() == rows.keys()
    for k, b in found.items():
        assert got[k].n_grams == len(b) and got[k].kept == (k in kept)
        assert got[k].key is None if not b else abs(got[k].key - keys[k]) < 1e-6


def test_hidden_pairs_of_a_large_group_are_found(spark):
    """Texts of one template share most words but differ by more than the limit; a few pairs among them do not."""
    rng = np.random.default_rng(5)
    template = [f"t{k}" for k in range(60)]
    rows, want = [], {}
    for k in range(300):
        words = template[:30] + [f"own{k}x{j}" for j in range(16)] + template[30:]
        rows.append((k, " ".join(words)))
        if k % 50 == 7:  # a twin with one other word
            words[32] = f"other{k}"
            rows.append((1000 + k, " ".join(words)))
            want[1000 + k] = k
    rng.shuffle(rows)
    docs = spark.createDataFrame([(int(a), str(b)) for a, b in rows], "doc_id long, text string").repartition(4)
    found = {r.doc_id: r.class_id for r in near_dedup.classes(docs).collect()}
    assert found == {k: want.get(k, k) for k, _ in ((int(a), b) for a, b in rows)}


ODD = [None, "", "  ", "word", "good words " * 9, "\n".join(["the same line of words here"] * 30), "é東京🙂 " * 50]


def test_stages_take_odd_rows(spark, tmp_path):
    real = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in
            spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    odd = [(None if k == 4 else -k, t, None if k % 2 else "en", None, None) for k, t in enumerate(ODD)]
    long = " ".join(t for _, t, *_ in real if t) * 3
    rows = real + real[:5] + odd + odd + [(10**12, long, "en", "s", 1), (None, real[7][1], None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema).selectExpr(
        "*", "1 AS row", "2 AS sampling", "3 AS rules", "4 AS key", "5 AS size", "6 AS quality", "7 AS kept", "8 AS node", "9 AS id")
    folder = str(tmp_path)
    spark.read.parquet(f"{SF_DIR}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = docs.count()
        assert stage(spark, docs.limit(0), folder).count() == 0, name
        out = stage(spark, docs, folder)
        out.write.parquet(f"{folder}/{name}")
        out = spark.read.parquet(f"{folder}/{name}")
        if name == "packing":
            assert out.select("doc_id").distinct().count() > 0
            assert out.groupBy("sequence_id").sum("length").where("`sum(length)` > 1024").isEmpty()
        else:
            gone = {"sampling"} if name == "quality_classifier" else {"rules"} if name == "quality_rules" else set()
            assert set(out.columns) >= set(docs.columns) - gone and 0 < out.count() <= before
            columns = [c for c in out.columns if c in docs.columns]
            assert out.select(columns).exceptAll(docs.select(columns)).isEmpty()  # rows are kept as they came
        docs = out
    assert not re.search("None", str(out.columns))


def test_run_is_its_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    found = corpus_pipeline.run(spark, SF_DIR)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    pieces = lambda df: sorted(map(tuple, df.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()))
    assert pieces(found) == pieces(docs) and set(columns) <= set(found.columns)
