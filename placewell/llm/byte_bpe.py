"""Byte-level BPE by corpus-level merge replay, and decoding.

The distinct pre-tokens of a stretch of texts are laid out as one array of symbols with
links to their neighbours. An inverted index leads from each pair, named by its rank, to
the positions where it stands. Merges are replayed in rank order over all words at once;
a merge visits its own positions and enters the new neighbouring pairs, nothing else.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placewell.llm.ragged import STORE_WORDS, Texts, distinct, pretokens, slices, spread, sums
from placewell.llm.vocabulary import Merges, read_ranks
from placewell.llm.workers import lean

# Words of a stretch are replayed together; this many bytes of text at a time are held.
STRETCH_BYTES = 18_000_000


def replay(words: list[bytes], merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Number of ids of each word, and the ids end to end."""
    lengths = np.array([len(w) for w in words], np.int64)
    n = int(lengths.sum())
    if n == 0:
        return np.zeros(len(words), np.int64), np.zeros(0, np.int64)
    whole = [merges.tokens.get(w) for w in words]  # a word that is a token needs no merge
    owner = np.repeat(np.arange(len(words)), lengths)
    symbols = np.r_[merges.singles[np.frombuffer(b"".join(words), np.uint8)], -1]
    after = np.arange(1, n + 2)  # next symbol; n: none
    ends = np.flatnonzero(np.r_[owner[1:] != owner[:-1], True])
    after[ends] = n
    before = np.arange(-1, n)  # previous symbol; n: none
    before[0] = n
    before[ends[:-1] + 1] = n
    index: dict[int, list[np.ndarray]] = {}
    waiting: list[int] = []
    again: list[np.ndarray] = []

    def enter(positions: np.ndarray, now: int) -> None:
        """Index the pairs that start at these positions."""
        ranks = merges.rank(symbols[positions], symbols[after[positions]])
        known = ranks != merges.none
        positions, ranks = positions[known], ranks[known]
        if not len(ranks):
            return
        if now > 0 and ranks.min() < now:  # a word whose order is not the ranks' own
            again.append(owner[positions[ranks < now]])
        order = np.argsort(ranks, kind="stable")
        positions, ranks = positions[order], ranks[order]
        first = np.flatnonzero(np.r_[True, ranks[1:] != ranks[:-1]])
        for rank, found in zip(ranks[first].tolist(), np.split(positions, first[1:]), strict=True):
            if rank in index:
                index[rank].append(found)
            else:
                index[rank] = [found]
                heapq.heappush(waiting, rank)

    split = np.array([w is None for w in whole])
    enter(np.flatnonzero((after[:n] != n) & split[owner]), 0)
    while waiting:
        rank = heapq.heappop(waiting)
        found = index.pop(rank)
        places = np.sort(found[0] if len(found) == 1 else np.concatenate(found))
        places = places[np.r_[True, places[1:] != places[:-1]]]
        # Positions whose pair has changed since they were entered drop out here.
        alive = (symbols[places] >= 0) & (after[places] != n)
        places = places[alive]
        places = places[merges.rank(symbols[places], symbols[after[places]]) == rank]
        if not len(places):
            continue
        if len(places) > 1:
            places = leftmost(places, after)
        right = after[places]
        symbols[places], symbols[right] = merges.made[rank], -1
        beyond = after[right]
        after[places] = beyond
        linked = beyond != n
        before[beyond[linked]] = places[linked]
        left = before[places]
        touched = np.r_[places[linked], left[left != n]]
        if len(touched):
            enter(touched, rank)
    begins = np.r_[0, np.cumsum(lengths)[:-1]][~split]
    alive = symbols[:n] >= 0
    alive &= split[owner]
    alive[begins] = True
    symbols[begins] = [w for w in whole if w is not None]
    counts, flat = np.bincount(owner[alive], minlength=len(words)), symbols[:n][alive]
    if again:
        parts = np.split(flat, np.cumsum(counts)[:-1])
        for k in np.unique(np.concatenate(again)).tolist():
            parts[k] = one_by_one(words[k], merges)
        counts, flat = np.array([len(p) for p in parts], np.int64), np.concatenate(parts)
    return counts, flat


def leftmost(places: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Without the positions that overlap a taken one to the left, as in a run of one sign."""
    joined = np.r_[False, after[places[:-1]] == places[1:]]
    if not joined.any():
        return places
    at = np.arange(len(places))
    since = at - np.maximum.accumulate(np.where(joined, 0, at))
    return places[since % 2 == 0]


def one_by_one(word: bytes, merges: Merges) -> np.ndarray:
    """A single word, always its lowest and then leftmost pair."""
    symbols = merges.singles[np.frombuffer(word, np.uint8)]
    while len(symbols) > 1:
        ranks = merges.rank(symbols[:-1], symbols[1:])
        k = int(np.argmin(ranks))
        if ranks[k] == merges.none:
            break
        symbols = np.r_[symbols[:k], merges.made[ranks[k]], symbols[k + 2:]]
    return symbols


def decode(ids: np.ndarray, merges: Merges) -> np.ndarray:
    """The bytes of ids, end to end."""
    return merges.bytes[spread(merges.starts[ids], merges.lengths[ids])]


def stretches(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[list[pa.RecordBatch]]:
    """Slices, gathered until they have ``limit`` bytes of text."""
    held, size = [], 0
    for part in slices(batches, "text"):
        held.append(part)
        size += part.column("text").nbytes
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


class Replayed:
    """Ids of the words that this process has met, ragged and flat; at most STORE_WORDS and a stretch."""

    def __init__(self, path: str) -> None:
        self.merges = read_ranks(path)
        self.clear()

    def clear(self) -> None:
        self.places: dict[bytes, int] = {}
        self.counts, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def split(self, text: Texts) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Word number of each match, first match of each text, words that are new."""
        offsets, first = pretokens(text)
        words, codes = distinct(text.data, offsets)
        words = words.to_pylist()
        numbers = list(map(self.places.get, words))
        new = [w for w, n in zip(words, numbers, strict=True) if n is None]
        self.places.update(zip(new, range(len(self.places), len(self.places) + len(new)), strict=True))
        if new:
            numbers = list(map(self.places.get, words))
        return np.array(numbers, np.int32)[codes], first, new

    def add(self, words: list[bytes]) -> None:
        if words:
            counts, ids = replay(words, self.merges)
            self.counts, self.flat = np.r_[self.counts, counts], np.r_[self.flat, ids.astype(np.int32)]


@lru_cache(maxsize=1)
def replayed(path: str) -> Replayed:
    return Replayed(path)


def encode_stretches(
    batches: Iterator[pa.RecordBatch], path: str
) -> Iterator[tuple[pa.RecordBatch, Texts, np.ndarray, np.ndarray, Replayed]]:
    """For each slice: itself, its texts, the word number of each match, the first match of
    each text, and the words held."""
    store = replayed(path)
    for held in stretches(batches, STRETCH_BYTES):
        if len(store.places) > STORE_WORDS:
            store.clear()
        new, found = [], []
        for part in held:
            texts = Texts(part.column("text"))
            codes, first, more = store.split(texts)
            new += more
            found.append((part, texts, codes, first, store))
        try:
            store.add(new)
        except BaseException:
            store.clear()
            raise
        yield from found


def encode_documents(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """id, n_tokens, ids_sha256 and decoded_sha256 for each row; with ``keep_ids`` the ids.

    Whole texts are encoded by the ranks in ``path``, each match of the splitting pattern
    by itself, without special tokens; the ids are then decoded to bytes. ids_sha256 is
    the hash of the decimal ids joined by one space. Null text counts as empty: no ids,
    and both hashes are those of no bytes. Null and repeated ids are kept row by row.
    Other columns of ``docs`` are not read. No rows give no rows.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" if keep_ids else ""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = read_ranks(path)
        names = np.array([str(n) for n in range(merges.size)], object)
        for part, texts, codes, first, store in encode_stretches(batches, path):
            counts, flat = store.counts, store.flat
            starts = np.cumsum(counts) - counts
            ids = flat[spread(starts[codes], counts[codes])]
            bounds = np.r_[0, np.cumsum(sums(counts[codes], first))]
            content = decode(ids, merges)
            ends = np.r_[0, np.cumsum(sums(merges.lengths[ids], bounds))].tolist()
            used, places = np.unique(codes, return_inverse=True)
            spelled = [" ".join(names[flat[starts[w]:starts[w] + counts[w]]]) for w in used.tolist()]
            places, begin = places.tolist(), first.tolist()
            said, read = [], []
            for k in range(len(texts)):
                line = " ".join([spelled[w] for w in places[begin[k]:begin[k + 1]]])
                said.append(hashlib.sha256(line.encode()).hexdigest())
                read.append(hashlib.sha256(content[ends[k]:ends[k + 1]]).hexdigest())
            columns = [part.column("id"), pa.array(np.diff(bounds)), pa.array(said, pa.string()),
                       pa.array(read, pa.string())]
            found = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                columns.append(pa.ListArray.from_arrays(
                    pa.array(bounds, pa.int32()), pa.array(ids, pa.int32())))
                found.append("ids")
            yield pa.RecordBatch.from_arrays(columns, found)

    read = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return read.mapInArrow(lean(encode, thrifty=False), schema).withColumnRenamed("id", id_column)


def decode_documents(
    encoded: DataFrame, path: str, id_column: str = "doc_id", ids_column: str = "ids"
) -> DataFrame:
    """id and content (bytes) of rows that hold arrays of ids. Null ids give null content."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = read_ranks(path)
        for batch in batches:
            content = [None if ids is None else decode(np.array(ids, np.int64), merges).tobytes()
                       for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(content, pa.binary())], ["id", "content"])

    kind = encoded.schema[id_column].dataType.simpleString()
    rows = encoded.select(F.col(id_column).alias("id"), F.col(ids_column).alias("ids"))
    return rows.mapInArrow(lean(read, thrifty=False), f"id {kind}, content binary").withColumnRenamed("id", id_column)
