"""Quality rules: measures, bands and verdicts against the libraries, and shares rejected per language."""

import math
import os
import re
import sys
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from placewell.llm import quality_rules as rules  # noqa: E402
from placewell.llm.workers import importable  # noqa: E402

UNITS, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    importable(spark)


def brute(rows):
    """doc_id -> (measures, base_failed, kept), from the libraries."""
    model, units = sentencepiece.SentencePieceProcessor(model_file=PIECES), Tokenizer.from_file(UNITS)
    found = {}
    for r in rows:
        text = r["text"] or ""
        words = re.findall("[^\x20\x09-\x0D]+", text)
        pieces = [i for w in words for i in model.encode(w)]
        n, tokens = len(pieces), len(units.encode(text, add_special_tokens=False).ids)
        grams = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
        count = Counter(grams)
        covered = {j for i, g in enumerate(grams) if count[g] > 1 for j in range(i, i + 8)}
        entropy = -sum(c / n * math.log2(c / n) for c in Counter(pieces).values()) / math.log2(n) if n > 1 else None
        measures = (sum(map(len, words)) / n if n else None, len(text) / tokens if tokens else None,
                    sum(map(model.is_byte, pieces)) / n if n else None, entropy)
        failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
        found[r["doc_id"]] = [r["lang"] or "", n, measures, failed]

    def quartiles(values):
        values = sorted(v for v in values if v is not None)
        return [values[max(math.ceil(q * len(values)) - 1, 0)] for q in (0.25, 0.75)]

    kind = lambda n: min(max(int(math.log2(max(n, 1))), 5), 24)
    passed = [x for x in found.values() if not x[3]]
    bands = {}
    for key in {(x[0], k) for x in passed for k in (None, kind(x[1]))}:
        own = [x for x in passed if x[0] == key[0] and key[1] in (None, kind(x[1]))]
        bands[key] = len(own), [quartiles([x[2][m] for x in own]) for m in range(4)]
    for x in found.values():
        lang, n, measures, failed = x
        size, limits = bands.get((lang, kind(n)), (0, None))
        wide = 2.25
        if size < 100:
            size, limits = bands.get((lang, None), (0, None))
            wide *= math.sqrt(1 + 150 / max(n, 1))
        ok = not failed
        for m, value in enumerate(measures):
            if ok and value is not None:
                low, high = limits[m]
                span = wide * max(high - low, (high + low) / 1000, 0.01 if m == 2 else 0)
                ok = value <= high + span and (m == 2 or value >= low - span)
        x.append(ok)
    return found


def test_verdicts_are_those_of_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text")
    odd = [(-1, None, None), (-2, "xx", ""), (-3, "en", "東京 " * 40), (-4, "en", "a b " * 500), (-5, None, "one two " * 3),
           (-6, "en", "🙂🙃 " * 30 + "word " * 4)]
    docs = docs.unionByName(spark.createDataFrame(odd, "doc_id long, lang string, text string")).repartition(4)
    want = brute([r.asDict() for r in docs.collect()])
    got = {r.doc_id: r.rules for r in rules.judge(docs, PIECES, UNITS).collect()}
    assert got.keys() == want.keys()
    for doc_id, (_, n, measures, failed, kept) in want.items():
        r = got[doc_id]
        assert (r.quality.n_pieces, r.base_failed, r.kept) == (n, failed, kept), doc_id
        for name, value in zip(rules.MEASURES, measures, strict=True):
            assert (r.quality[name] is None) == (value is None)
            assert value is None or abs(r.quality[name] - value) < 1e-9
    assert rules.judge(docs.limit(0), PIECES, UNITS).count() == 0


def test_bad_texts_go_and_good_ones_stay_in_every_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "lang", "text").repartition(8)
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    judged = rules.judge(docs, PIECES, UNITS).join(labels, "doc_id").where("NOT rules.base_failed")
    shares = {(r.lang, r.label): r.gone for r in judged.groupBy("lang", labels["quality"].alias("label")).agg(
        F.avg((~F.col("rules.kept")).cast("int")).alias("gone")).collect()}
    for lang, least in (("de", 0.8), ("en", 0.8), ("es", 0.1), ("fr", 0.35)):
        assert shares[lang, 0] > least and shares[lang, 1] < 0.02, (lang, shares)


def test_bytes_alone_can_reject(spark):
    plain = "some usual words that any vocabulary holds without trouble and so on for a while with more words here "
    rows = [(k, "en", plain * (1 + k % 7) + f"word{k}") for k in range(150)]
    rows.append((999, "en", plain * 3 + "".join(chr(0x2800 + k % 200) for k in range(12))))
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    found = {r.doc_id: r.quality for r in rules.judge(docs, PIECES, UNITS).select("doc_id", "rules.quality").collect()}
    assert found[999].m_byte_share > 0.1 and found[0].m_byte_share == 0
