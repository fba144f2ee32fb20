"""Links between the tokens of two vocabularies against the public libraries, and odd rows."""

import hashlib
import os
import sys
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from placewell.llm import token_links  # noqa: E402
from placewell.llm.queries import QUERIES  # noqa: E402
from placewell.llm.vocabulary import byte_letters  # noqa: E402
from placewell.llm.workers import importable  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
UNITS, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
LONG = " ".join(f"word{i * i % 977} it's\n\n ñu" for i in range(3000)) + "a" * 3000 + "​" * 7
TEXTS = [
    None, "", " ", "   ", "a b", "a b", "\n", " \n\n x \t  y ", "ñandú 東京 😀 12³", "a▁b", " ▁ x", "▁", "<s> <unk>",
    "<|endoftext|> z", "<0x41> A", "ﬁ ① é\x00z", "x\r\n y", LONG, LONG, "… — “q”"]


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    importable(spark)


def brute(texts):
    """Rows as the contract has them, from the libraries, token by token."""
    units = Tokenizer.from_file(UNITS)
    units.encode_special_tokens = True
    names, letters = {i: t for t, i in units.get_vocab().items()}, byte_letters()
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found = []
    for text in texts:
        whole = (" " + text).encode() if text else b""
        a = units.encode(" " + text, add_special_tokens=False).ids if text else []
        b = model.encode(text) if text else []
        a_bytes = [bytes(letters[c] for c in names[i]) for i in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()
                   for i, p in ((i, model.id_to_piece(i)) for i in b)]
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            found.append(([], [], [], []))
            continue
        a_ends, b_ends = np.cumsum([len(x) for x in a_bytes]), np.cumsum([len(x) for x in b_bytes])
        both = sorted(set(a_ends.tolist()) & set(b_ends.tolist()))
        groups, links, i, j = [], [], 0, 0
        for end in both:
            p, q = i, j
            while i < len(a) and a_ends[i] <= end:
                i += 1
            while j < len(b) and b_ends[j] <= end:
                j += 1
            groups.append(",".join(map(str, a[p:i])) + "|" + ",".join(map(str, b[q:j])))
            for x in range(p, i):
                for y in range(q, j):
                    if max(a_ends[x] - len(a_bytes[x]), b_ends[y] - len(b_bytes[y])) < min(a_ends[x], b_ends[y]):
                        links.append((a[x], b[y]))
        found.append((a, b, groups, links))
    counts = Counter(link for row in found for link in row[3])
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return [(len(a), len(b), len(groups), len(links), sum(counts[x] == most[x[1]] for x in links),
             sum(counts[x] for x in links), ";".join(groups)) for a, b, groups, links in found]


def test_odd_rows_are_as_the_libraries_have_them(spark, monkeypatch):
    rows = [(None if k == 4 else k // 2, t, "r", 1) for k, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, groups string, pair int").repartition(3)
    want = sorted(((r[0], *x) for r, x in zip(rows, brute(TEXTS), strict=True)), key=str)
    assert sorted((tuple(r) for r in token_links.align(docs, UNITS, PIECES).collect()), key=str) == want
    monkeypatch.setattr(token_links, "BROADCAST_PAIRS", 0)
    assert sorted((tuple(r) for r in token_links.align(docs, UNITS, PIECES).collect()), key=str) == want
    assert token_links.align(docs.limit(0), UNITS, PIECES).count() == 0
    assert sum(x[1] > 0 for x in want) > 10


def test_query_is_as_the_libraries_have_it(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op12_token_alignment"](spark, SF_DIR).collect()}
    for row, want in zip(rows, brute([r.text for r in rows]), strict=True):
        digest = hashlib.sha256(want[-1].encode()).hexdigest() if want[-1] else ""
        assert got[row.doc_id] == (*want[:-1], digest)
    assert len(got) == len(rows)


def test_postings_return_every_link():
    rng = np.random.default_rng(3)
    pairs, docs = rng.integers(0, 9, 4000) ** 2, rng.integers(0, 70, 4000)
    docs[:900], pairs[:900] = 5, 4  # many links of one pair in one document
    back = Counter()
    kinds = set()
    for found, plane, maps, dense in token_links.postings(pairs, docs, 70):
        kinds.add(dense)
        row, doc = token_links.members(maps, np.full(len(found), dense))
        for p, d in zip(found[row].tolist(), doc.tolist(), strict=True):
            back[p, d] += 1 if plane == 0 else 1 << (plane - 1)
    assert back == Counter(zip(pairs.tolist(), docs.tolist(), strict=True))
    assert kinds == {True, False}
    assert [len(x) for x in token_links.members(pa.array([], pa.binary()), np.zeros(0, bool))] == [0, 0]
