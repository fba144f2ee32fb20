"""Token counts by rank-synchronous array merging.

Pre-tokens of a slice are held as ragged numpy arrays of symbols. In each round every
sequence applies its own lowest-rank pair, all of them at once; the symbols that survive
when no pair is left are the tokens. Only distinct pre-tokens are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placewell.llm.ragged import Texts, WordStore, distinct, pretokens, slices, sums
from placewell.llm.vocabulary import Merges, read_json
from placewell.llm.workers import lean

LIMIT = 1024


def merge_words(words: list[bytes], merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Number of symbols of each word after all merges, and the symbols end to end."""
    lengths = np.array([len(w) for w in words], np.int64)
    letters = np.frombuffer(b"".join(words), np.uint8)
    symbols = merges.singles[letters]
    owner = np.repeat(np.arange(len(words)), lengths)
    # of each symbol and the one after it; the last symbol of a word has none
    ranks = np.full(len(symbols), merges.none, np.int64)
    ranks[:-1] = np.where(owner[1:] == owner[:-1], merges.byte_ranks[letters[:-1], letters[1:]], merges.none)
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while len(symbols):
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        lowest = np.repeat(np.minimum.reduceat(ranks, first), np.diff(np.r_[first, len(owner)]))
        idle = lowest == merges.none
        if idle.any():
            done.append((owner[idle], symbols[idle]))
            busy = ~idle
            symbols, owner, ranks, lowest = symbols[busy], owner[busy], ranks[busy], lowest[busy]
        hit = np.flatnonzero(every_other(ranks == lowest))
        symbols[hit] = merges.made[lowest[hit]]
        keep = np.ones(len(symbols), bool)
        keep[hit + 1] = False
        symbols, owner, ranks = symbols[keep], owner[keep], ranks[keep]
        # only pairs with a new symbol have other ranks than before
        new = hit - np.arange(len(hit))
        left = np.concatenate([new[new > 0] - 1, new])
        right = np.minimum(left + 1, len(symbols) - 1)
        inside = (owner[left] == owner[right]) & (left < right)
        ranks[left] = merges.none
        left, right = left[inside], right[inside]
        ranks[left] = merges.rank(symbols[left], symbols[right])
    if not done:
        return np.zeros(len(words), np.int64), np.zeros(0, np.int64)
    owners, found = (np.concatenate(x) for x in zip(*done, strict=True))
    order = np.argsort(owners, kind="stable")
    return np.bincount(owners, minlength=len(words)), found[order]


def every_other(hit: np.ndarray) -> np.ndarray:
    """Of neighbouring hits, which overlap, the first, third and so on."""
    places = np.arange(len(hit))
    start = hit.copy()
    start[1:] &= ~hit[:-1]
    since = places - np.maximum.accumulate(np.where(start, places, 0))
    return hit & (since % 2 == 0)


def json_encoder(path: str):
    """Encoder of pre-tokens for a byte-level JSON vocabulary, and its special strings."""
    merges, special = read_json(path)

    def encode(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        plain = [w for w in words if w not in special]
        counts, flat = merge_words(plain, merges)
        if len(plain) == len(words):
            return counts, flat
        parts = iter(np.split(flat, np.cumsum(counts)[:-1]) if len(plain) else [])
        found = [np.array([special[w]]) if w in special else next(parts) for w in words]
        return np.array([len(x) for x in found], np.int64), np.concatenate(found)

    return encode, special


@lru_cache(maxsize=1)
def json_store(path: str) -> tuple[WordStore, dict[bytes, int]]:
    """The words that this process has met."""
    encode, special = json_encoder(path)
    return WordStore(encode), special


def count_tokens(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text",
    limit: int = LIMIT,
) -> DataFrame:
    """id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) for each row.

    Whole texts are counted, without begin, end or added special tokens; the special
    string of the vocabulary inside a text is one token, as its library has it by default.
    Null text counts as empty: 0 bytes, 0 tokens. Null and repeated ids are kept row by
    row. Other columns of ``docs`` are not read. No rows give no rows.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, special = json_store(path)
        for part in slices(batches, "text"):
            texts = Texts(part.column("text"))
            offsets, first = pretokens(texts, next(iter(special), None))
            words, codes = distinct(texts.data, offsets)
            places = store.look_up(words)
            found = sums(store.counts[places[codes]], first)
            yield pa.RecordBatch.from_arrays([
                part.column("id"), pa.array(np.diff(texts.offsets)), pa.array(found),
                pa.array(found > limit)], ["id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_column].dataType.simpleString()
    read = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return read.mapInArrow(
        lean(count, thrifty=False), f"id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    ).withColumnRenamed("id", id_column)
