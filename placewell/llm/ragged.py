"""Texts of an Arrow batch as flat numpy arrays: slicing, splitting, distinct words.

A task holds a bounded slice of its texts at a time. Splitting, hashing and counting run
on whole slices; Python loops run over distinct words only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

SLICE_BYTES = 2_500_000
STORE_WORDS = 120_000  # rare words are most of a store; what is frequent comes back soon after it is cleared

# The code points with the White_Space property.
WHITE_SPACE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
               0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
OTHER, LETTER, NUMBER, SPACE = range(4)


class Texts:
    """UTF-8 bytes of several texts, end to end; ``offsets`` has one entry more than texts."""

    def __init__(self, column: pa.Array) -> None:
        if column.null_count:
            column = pc.fill_null(column, "")
        wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
        kind = np.int64 if wide else np.int32
        _, offsets, data = column.buffers()
        self.offsets = np.zeros(len(column) + 1, np.int64)
        if len(column) and offsets is not None:
            self.offsets += np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.data = raw[self.offsets[0]:self.offsets[-1]]
        self.offsets -= self.offsets[0]

    def __len__(self) -> int:
        return len(self.offsets) - 1


def slices(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that a slice has about ``limit`` bytes of text; a longer text stands alone."""
    for batch in batches:
        ends = Texts(batch.column(column)).offsets
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(ends, ends[at] + limit, "right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


@lru_cache(maxsize=1)
def char_kinds() -> np.ndarray:
    """LETTER, NUMBER, SPACE or OTHER for each code point."""
    gap = range(0xD800, 0xE000)  # surrogates are no characters
    points = np.r_[0:gap.start, gap.stop:0x110000]
    chars = "".join(map(chr, points.tolist()))
    kinds = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for found in regex.finditer(pattern, chars):
            kinds[points[found.start():found.end()]] = kind
    kinds[list(WHITE_SPACE)] = SPACE
    return kinds


def characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and code point of each character of valid UTF-8."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    first = data[at]
    points = first.astype(np.int32)
    for least, mask, more in ((0xC0, 0x1F, 1), (0xE0, 0x0F, 2), (0xF0, 0x07, 3)):
        hit = np.flatnonzero((first >= least) & (first < {1: 0xE0, 2: 0xF0, 3: 0xF8}[more]))
        if len(hit):
            value = (first[hit] & mask).astype(np.int32)
            for k in range(1, more + 1):
                value = (value << 6) | (data[at[hit] + k] & 0x3F)
            points[hit] = value
    return at, points


def pretokens(texts: Texts, special: bytes | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of the matches of the byte-level vocabularies' splitting pattern.

    The pattern takes, in this order: an English contraction after an apostrophe; a run
    of letters, of numbers or of other signs, each with one blank before it; white space
    up to its last character if something follows; white space. ``special`` is cut out
    first and stays whole. Returns the offsets of all matches (one more than matches) and
    the number of the first match of each text (one more than texts).
    """
    data = texts.data
    hard = texts.offsets
    spans: list[int] = []
    if special:
        whole, found = data.tobytes(), -1
        while (found := whole.find(special, found + 1 if not spans else max(found + 1, spans[-1]))) >= 0:
            end = found + len(special)
            text = np.searchsorted(hard, found, "right")
            if end <= texts.offsets[min(text, len(texts))]:
                spans += [found, end]
        if spans:
            hard = np.unique(np.r_[hard, spans])
    if not len(data):
        return np.zeros(1, np.int64), np.zeros(len(texts) + 1, np.int64)
    at, points = characters(data)
    kinds = char_kinds()[points]
    n = len(at)
    fresh = np.zeros(n + 3, bool)  # a text or a special string starts or ends here
    fresh[np.searchsorted(at, hard)] = True
    fresh[n:] = True
    cut = fresh[:n].copy()
    cut[1:] |= kinds[1:] != kinds[:-1]
    last = np.flatnonzero((kinds[:-1] == SPACE) & (kinds[1:] != SPACE) & ~fresh[1:n])
    cut[last] = True
    cut[last[points[last] == 0x20] + 1] = False
    mark = np.flatnonzero((points == 0x27) & cut & ~fresh[1:n + 1])
    if len(mark):
        padded = np.r_[points, 0, 0, 0]
        one, two = padded[mark + 1], padded[mark + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        pair = np.zeros(len(mark), bool)
        for a, b in ("re", "ve", "ll"):
            pair |= (one == ord(a)) & (two == ord(b))
        pair &= ~fresh[mark + 2] & ~short
        cut[mark[short | pair] + 1] = False
        after = np.r_[mark[short] + 2, mark[pair] + 3]
        cut[after[after < n]] = True
    for k in range(0, len(spans), 2):
        a, b = np.searchsorted(at, spans[k:k + 2])
        cut[a + 1:b] = False
    starts = at[cut]
    return np.r_[starts, len(data)], np.searchsorted(starts, texts.offsets)


def blank_words(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of words between ASCII white space and of the gaps after them, in turn.

    Match 2k is word k. Returns the offsets and the number of the first word of each text.
    """
    data = texts.data
    if not len(data):
        return np.zeros(1, np.int64), np.zeros(len(texts) + 1, np.int64)
    inside = ~((data == 0x20) | ((data >= 0x09) & (data <= 0x0D)))
    begins = np.zeros(len(data) + 1, bool)
    begins[:-1] = inside
    starts = begins[:-1].copy()
    starts[1:] &= ~inside[:-1]
    edge = texts.offsets[:-1][texts.offsets[:-1] < len(data)]
    starts[edge] = inside[edge]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edge = texts.offsets[1:][texts.offsets[1:] > 0] - 1
    ends[edge] = inside[edge]
    first, last = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    offsets = np.empty(2 * len(first) + 1, np.int64)
    offsets[0:-1:2], offsets[1::2] = first, last
    offsets[-1] = len(data)
    return offsets, np.searchsorted(first, texts.offsets)


def distinct(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The distinct matches as bytes, and for each match its place among them."""
    n = len(offsets) - 1
    if n == 0:
        return pa.array([], pa.binary()), np.zeros(0, np.int32)
    found = pa.Array.from_buffers(pa.large_binary(), n, [
        None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)),
        pa.py_buffer(np.ascontiguousarray(data))])
    encoded = found.dictionary_encode()
    return encoded.dictionary, encoded.indices.to_numpy()


class WordStore:
    """Values of distinct words, ragged and flat; cleared when it holds too many."""

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]],
                 most: int = STORE_WORDS) -> None:
        self.encode, self.most = encode, most
        self.clear()

    def clear(self) -> None:
        self.places: dict[bytes, int] = {}
        self.counts = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def look_up(self, words: pa.Array) -> np.ndarray:
        """The place of each word; words not held yet are encoded together."""
        if len(self.places) > self.most:
            self.clear()
        words = words.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.places.get, words))
        new = [w for w, place in zip(words, found, strict=True) if place is None]
        if new:
            counts, flat = self.encode(new)
            held = len(self.places)
            self.places.update(zip(new, range(held, held + len(new)), strict=True))
            found = list(map(self.places.get, words))
            self.starts = np.r_[self.starts, len(self.flat) + np.cumsum(counts) - counts]
            self.counts = np.r_[self.counts, counts]
            self.flat = np.r_[self.flat, flat.astype(np.int32)]
        return np.array(found, np.int64)

    def expand(self, places: np.ndarray) -> np.ndarray:
        """The values of the words at these places, one after the other."""
        return self.flat[spread(self.starts[places], self.counts[places])]


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for ``count`` steps, for each pair, one after the other."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - counts), counts) + np.arange(total)


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values between neighbouring bounds; 0 where they are equal."""
    total = np.r_[np.zeros(1, values.dtype), np.cumsum(values)]
    return total[bounds[1:]] - total[bounds[:-1]]
