"""Links between the tokens of two vocabularies, and how often each pair is linked.

Two tokens of a text are linked if their byte ranges overlap. Texts are taken in chunks;
a chunk writes postings for each pair of ids: a bitmap of its documents that hold the
pair, and one bitmap for each binary digit of the further links a document has of it
(multiplicity planes). A bitmap is a list of document numbers where that is shorter.
Chunks hold different documents, so the union over chunks has as many documents as their
bit counts add up to; link counts add the planes at their weights. The postings then
return the scores of the pairs to the documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from placewell.llm.components import stored
from placewell.llm.ragged import Texts, WordStore, distinct, pretokens, slices, sums
from placewell.llm.token_counts import json_encoder
from placewell.llm.vocabulary import read_json
from placewell.llm.workers import lean

SLICE = 4_000_000  # bytes of text of a chunk
CHUNK_ROWS = 1 << 15
IDS = 1 << 20  # ids of a vocabulary are below
STORE = 150_000  # distinct words that a task remembers
BROADCAST_PAIRS = 1_000_000  # scores of so many pairs, 32 bytes each, are sent to all tasks
UNFIT = -1  # stands in for the pieces of a stretch that do not spell it

POSTINGS = ("chunk bigint, pair bigint, plane int, docs binary, dense boolean, "
            "doc int, id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string")


@lru_cache(maxsize=2)
def piece_model(path: str):
    """The model and the bytes of each piece."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    spelled = [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i)
               else model.id_to_piece(i).replace("▁", " ").encode() for i in range(model.get_piece_size())]
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    # What the cutting into stretches rests on: no piece has a blank after another sign, or a line end.
    if any("▁" in p.lstrip("▁") or "\n" in p for p in pieces):
        raise ValueError(f"pieces of {path} reach beyond words")
    return model, spelled, np.array([len(s) for s in spelled], np.int64)


def piece_store(path: str) -> WordStore:
    """Pieces of stretches; ``UNFIT`` alone where they do not spell the stretch."""
    model, spelled, _ = piece_model(path)

    def encode(stretches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        # Behind a line end the model adds no blank: its own two pieces for that are cut off.
        found = [x[2:] for x in model.encode(["\n" + s.decode() for s in stretches], num_threads=1)]
        found = [x if b"".join(map(spelled.__getitem__, x)) == s else [UNFIT]
                 for x, s in zip(found, stretches, strict=True)]
        counts = np.array([len(x) for x in found], np.int64)
        return counts, np.fromiter((i for x in found for i in x), np.int64, int(counts.sum()))

    return WordStore(encode, STORE)


def stretches(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of the stretches that pieces do not cross, and the first stretch of each text.

    A stretch begins at a blank that follows another sign, and before and after a line end.
    """
    data = texts.data
    if not len(data):
        return np.zeros(1, np.int64), np.zeros(len(texts) + 1, np.int64)
    blank, line = data == 0x20, data == 0x0A
    cut = line | blank
    cut[1:] &= ~(blank[1:] & blank[:-1])
    cut[1:] |= line[:-1]
    cut[texts.offsets[:-1][texts.offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(cut)
    return np.r_[starts, len(data)], np.searchsorted(starts, texts.offsets)


class Aligned:
    """Tokens, links and groups of the texts of a slice, each with a blank before it."""

    def __init__(self, column: pa.Array, units, pieces) -> None:
        """``units``: store and token lengths of the byte-level vocabulary; ``pieces``: of the other."""
        given = Texts(column)
        blank = np.diff(given.offsets) == 0
        texts = Texts(pc.binary_join_element_wise(
            pc.if_else(pa.array(blank), "", " "), pc.fill_null(column, ""), "").cast(column.type))
        n = len(texts)
        (unit_store, unit_sizes), (store, sizes) = units, pieces
        offsets, first = stretches(texts)
        words, codes = distinct(texts.data, offsets)
        places = store.look_up(words)[codes]
        b, b_first = store.expand(places), np.r_[0, np.cumsum(sums(store.counts[places], first))]
        unfit = sums((b == UNFIT).astype(np.int64), b_first) > 0
        offsets, first = pretokens(texts)
        words, codes = distinct(texts.data, offsets)
        places = unit_store.look_up(words)[codes]
        a, a_first = unit_store.expand(places), np.r_[0, np.cumsum(sums(unit_store.counts[places], first))]
        # Lengths of texts without tokens are 0 from here on.
        length = np.where(unfit, 0, np.diff(texts.offsets))
        self.ends = np.cumsum(length)
        a, b = (x[~np.repeat(unfit, np.diff(f))] for x, f in ((a, a_first), (b, b_first)))
        self.a, self.b = a, b
        a_ends, b_ends = np.cumsum(unit_sizes[a]), np.cumsum(sizes[b])
        total = int(length.sum())
        of_a, of_b = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
        of_a[a_ends], of_b[b_ends] = True, True
        cuts = np.flatnonzero(of_a | of_b)
        # Each stretch between two cuts lies in one token of either side: a link.
        self.link_a, self.link_b = a[np.searchsorted(a_ends, cuts)], b[np.searchsorted(b_ends, cuts)]
        self.link_doc = np.searchsorted(self.ends, cuts)
        groups = np.flatnonzero(of_a & of_b)
        self.group_doc = np.searchsorted(self.ends, groups)
        self.group_a, self.group_b = np.searchsorted(groups, a_ends), np.searchsorted(groups, b_ends)
        doc_a, doc_b = np.searchsorted(self.ends, a_ends), np.searchsorted(self.ends, b_ends)
        self.n_a, self.n_b, self.n_groups, self.n_links = (
            np.bincount(x, minlength=n) for x in (doc_a, doc_b, self.group_doc, self.link_doc))

    def groups(self) -> list[str]:
        """Per text its groups, ``a1,a2|b1;a3|b2``: ids of either side in order."""
        n = len(self.group_doc)
        count_a, count_b = np.bincount(self.group_a, minlength=n), np.bincount(self.group_b, minlength=n)
        ends = np.cumsum(count_a + count_b + 1)
        starts = ends - (count_a + count_b + 1)
        flat = np.full(int(ends[-1]) if n else 0, UNFIT, np.int32)  # UNFIT: between the sides
        before_a, before_b = np.cumsum(count_a) - count_a, np.cumsum(count_b) - count_b
        flat[starts[self.group_a] + np.arange(len(self.a)) - before_a[self.group_a]] = self.a
        flat[(starts + count_a + 1)[self.group_b] + np.arange(len(self.b)) - before_b[self.group_b]] = self.b
        kinds, codes = distinct(flat.view(np.uint8), np.r_[0, ends] * 4)
        spelled = []
        for kind in kinds.to_pylist():
            ids = np.frombuffer(kind, np.int32).tolist()
            k = ids.index(UNFIT)
            spelled.append(f"{','.join(map(str, ids[:k]))}|{','.join(map(str, ids[k + 1:]))}")
        spelled = np.array(spelled, object)[codes] if n else np.zeros(0, object)
        bounds = np.r_[0, np.cumsum(self.n_groups)].tolist()
        return [";".join(spelled[p:q]) for p, q in zip(bounds[:-1], bounds[1:], strict=True)]


def bitmaps(pair: np.ndarray, doc: np.ndarray, n_docs: int) -> Iterator[tuple[np.ndarray, pa.Array, bool]]:
    """The distinct pairs, the bitmap of the documents of each, and whether it is one: lists first, then bitmaps.

    ``pair`` and ``doc`` are ordered by both, without repeats.
    """
    size = (n_docs + 7) // 8
    first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
    held = np.diff(np.r_[first, len(pair)])
    dense = 2 * held > size
    sparse = ~np.repeat(dense, held)
    offsets = np.r_[0, np.cumsum(2 * held[~dense])].astype(np.int32)
    yield pair[first[~dense]], pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [
        None, pa.py_buffer(offsets), pa.py_buffer(doc[sparse].astype("<u2"))]), False
    rows = int(dense.sum())
    bits = np.zeros((rows, size * 8), bool)
    bits[np.repeat(np.arange(rows), held[dense]), doc[~sparse]] = True
    packed = np.packbits(bits, axis=1, bitorder="little")
    yield pair[first[dense]], pa.Array.from_buffers(pa.binary(), rows, [
        None, pa.py_buffer((np.arange(rows + 1) * size).astype(np.int32)), pa.py_buffer(packed.tobytes())]), True


def postings(
    pairs: np.ndarray, docs: np.ndarray, n_docs: int
) -> Iterator[tuple[np.ndarray, int, pa.Array, bool]]:
    """Pairs, plane, bitmaps and whether they are dense, for the links (pair, document) of a chunk.

    Plane 0 holds the documents of a pair, plane k > 0 those whose number of further links
    has binary digit k - 1 set.
    """
    keys, counts = np.unique((pairs.astype(np.uint64) << np.uint64(16)) | docs.astype(np.uint64), return_counts=True)
    pair, doc, more = (keys >> np.uint64(16)).astype(np.int64), (keys & np.uint64(0xFFFF)).astype(np.int64), counts - 1
    plane = 0
    chosen = np.ones(len(keys), bool)
    while plane == 0 or more.any():
        if plane:
            chosen, more = (more & 1).astype(bool), more >> 1
        if chosen.any():
            for found, maps, dense in bitmaps(pair[chosen], doc[chosen], n_docs):
                if len(found):
                    yield found, plane, maps, dense
        plane += 1


def members(maps: pa.Array, dense: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and document number of every bit that is set."""
    texts = Texts(maps)
    sizes = np.diff(texts.offsets)
    of = np.repeat(dense, sizes)
    listed = texts.data[~of].view("<u2").astype(np.int64)
    rows = np.repeat(np.flatnonzero(~dense), sizes[~dense] // 2)
    inside = np.flatnonzero(np.unpackbits(texts.data[of], bitorder="little"))
    ends = np.cumsum(8 * sizes[dense])
    at = np.searchsorted(ends, inside, "right")
    return np.r_[rows, np.flatnonzero(dense)[at]], np.r_[listed, inside - (ends - 8 * sizes[dense])[at]]


def weight(plane: Column) -> Column:
    """What a bit of the plane adds to the links."""
    return F.when(plane == 0, F.lit(1)).otherwise(F.expr("shiftleft(1L, plane - 1)")).cast("bigint")


def pair_scores(table: DataFrame) -> DataFrame:
    """pair, documents and links of every linked pair of ids, and whether no other pair of its second id has more."""
    held = F.when(F.col("dense"), F.bitmap_count("docs")).otherwise(F.expr("octet_length(docs) div 2"))
    counts = table.where("pair IS NOT NULL").groupBy("pair").agg(
        F.sum(held * weight(F.col("plane"))).alias("links"),
        F.sum(F.when(F.col("plane") == 0, held)).alias("documents"))
    counts = stored(counts, "pair-counts")
    second = (F.col("pair") % IDS).alias("second")
    best = counts.groupBy(second).agg(F.max("links").alias("most"))
    return stored(counts.withColumn("second", second).join(best, "second").select(
        "pair", "documents", "links", (F.col("links") == F.col("most")).alias("best")), "pair-scores")


def returned(table: DataFrame, scores: DataFrame) -> DataFrame:
    """chunk, doc, n_best and count_sum: what the postings of a document's links add up to."""
    few = scores.count() <= BROADCAST_PAIRS
    scored = table.where("pair IS NOT NULL").select("chunk", "pair", "plane", "docs", "dense").join(
        F.broadcast(scores) if few else scores, "pair")
    if not few:  # rows of a chunk meet again, so that few sums leave a task
        scored = scored.repartition("chunk")
    scored = scored.select("chunk", "docs", "dense", weight(F.col("plane")).alias("weight"), "links", "best")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, doc = members(batch.column("docs"), batch.column("dense").to_numpy(zero_copy_only=False))
            chunk, each, links, best = (
                batch.column(c).to_numpy(zero_copy_only=False)[row] for c in ("chunk", "weight", "links", "best"))
            chunks, place = np.unique(chunk, return_inverse=True)
            keys, place = np.unique(place * CHUNK_ROWS + doc, return_inverse=True)
            # Whole numbers throughout: sums of weights in floating point could lose the last digits.
            count_sum, n_best = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
            np.add.at(count_sum, place, each * links)
            np.add.at(n_best, place, each * best)
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunks[keys // CHUNK_ROWS]), pa.array((keys % CHUNK_ROWS).astype(np.int32)),
                 pa.array(n_best), pa.array(count_sum)], ["chunk", "doc", "n_best", "count_sum"])

    return scored.mapInArrow(lean(add), "chunk bigint, doc int, n_best bigint, count_sum bigint").groupBy(
        "chunk", "doc").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def linked(
    docs: DataFrame, units: str, pieces: str, id_column: str = "doc_id", text_column: str = "text",
    digest: bool = False,
) -> DataFrame:
    """Postings of all links, and one row per document (pair is null) with its counts and groups.

    ``units``: a byte-level vocabulary; ``pieces``: one of pieces with byte fallback.
    ``digest``: groups as lowercase hex of their sha256, empty where there are none.
    """

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, _ = json_encoder(units)
        own = (WordStore(encode, STORE), read_json(units)[0].lengths), (piece_store(pieces), piece_model(pieces)[2])
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK_ROWS):
                for part in slices(iter([batch.slice(at, CHUNK_ROWS)]), "text", SLICE):
                    found = Aligned(part.column("text"), *own)
                    n = part.num_rows
                    groups = found.groups()
                    if digest:
                        groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
                    given = {
                        "chunk": pa.array(np.full(n, chunk)), "doc": pa.array(np.arange(n, dtype=np.int32)),
                        "id": part.column("id"), "groups": pa.array(groups, pa.string()),
                        **{c: pa.array(getattr(found, c).astype(np.int64)) for c in ("n_a", "n_b", "n_groups", "n_links")}}
                    yield filled(given, n)
                    pairs = found.link_a.astype(np.int64) * IDS + found.link_b
                    for pair, plane, maps, dense in postings(pairs, found.link_doc, n):
                        k = len(pair)
                        yield filled({
                            "chunk": pa.array(np.full(k, chunk)), "pair": pa.array(pair), "docs": maps,
                            "plane": pa.array(np.full(k, plane, np.int32)), "dense": pa.array(np.full(k, dense))}, k)
                    chunk += 1

    read = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = docs.schema[id_column].dataType.simpleString()
    schema = POSTINGS.format(kind=kind)
    fields = to_arrow_schema(StructType.fromDDL(schema))

    def filled(given: dict[str, pa.Array], n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [given[f.name] if f.name in given else pa.nulls(n, f.type) for f in fields], fields.names)

    return read.mapInArrow(lean(link), schema)


def align(
    docs: DataFrame, units: str, pieces: str, id_column: str = "doc_id", text_column: str = "text",
    digest: bool = False,
) -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups of each row.

    Each text is encoded with a blank before it. ``groups`` lists the stretches between
    byte offsets at which tokens of both sides end, as ``a1,a2|b1;a3|b2`` (``digest``:
    their sha256). A pair of ids counts how many links of all rows hold it: ``count_sum``
    adds these counts over the links of a row, ``n_best`` is the number of its links whose
    pair is the most frequent of its second id, ties included. Null and empty texts, and
    texts that a vocabulary cannot spell byte for byte, have no tokens: zeros and an empty
    ``groups``. Null and repeated ids are kept row by row, repeated texts count each time;
    other columns are not read. No rows give no rows.
    """
    table = stored(linked(docs, units, pieces, id_column, text_column, digest), "token-links")
    sums_ = returned(table, pair_scores(table))
    rows = table.where("pair IS NULL").drop("pair", "plane", "docs", "dense")
    return rows.join(sums_, ["chunk", "doc"], "left").select(
        F.col("id").alias(id_column), "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", F.lit(0).cast("bigint")).alias("n_best"),
        F.coalesce("count_sum", F.lit(0).cast("bigint")).alias("count_sum"), "groups")
