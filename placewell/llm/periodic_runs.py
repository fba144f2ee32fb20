"""Periodic runs of words, found by minimizers at several scales.

A run is a stretch of words that repeats itself at a fixed distance, its period. Within a
run the minima of sliding windows over hashed word sequences come back at that distance,
so pairs of equal minima are the seeds, one scale for each doubling of the period; each
seed is extended to both sides as far as the words agree. Periods below the first scale
are found by comparing the words with themselves at each distance.

Why no run is lost. At scale ``m`` (sequences of ``m`` words, periods from ``2m`` to
``4m - 1``) a sequence that returns within ``m / 2`` words is itself periodic and takes no
part. A run whose smallest period is at least ``2m`` holds a sequence of the other kind
in every period, so windows inside the run have a minimum, and it returns one period
later. Sequences of the other kind are more than ``m / 2`` words apart, so at most seven
further places of a sequence lie within ``4m`` words, and all of them are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placewell.llm.ragged import Texts, blank_words, distinct, slices
from placewell.llm.workers import lean

LEAST_WORDS = 6
LEAST_PERIODS = 4
FIRST_SCALE = 8  # words; shorter periods than twice this are compared directly
SLICE = 1_500_000  # bytes of text that a task works on at a time
NONE = np.uint64(2**64 - 1)


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of stretches made of two halves."""
    with np.errstate(over="ignore"):
        return mix(left * np.uint64(0x9E3779B97F4A7C15) + right)


def sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over ``width`` (a power of two) neighbours; shorter by ``width - 1``."""
    span = 1
    while span < width:
        values = pick(values[:-span], values[span:])
        span *= 2
    return values


def minimizers(grams: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Places that hold the minimum of a window of ``m`` sequences, ordered by hash and place, and their hashes."""
    order = np.argsort(grams, kind="stable")
    ordered = grams[order]
    same = ordered[1:] == ordered[:-1]
    group = np.r_[0, np.cumsum(~same)]
    dense = np.zeros(group[-1] + 1, bool)
    dense[group[1:][same & (np.diff(order) <= m // 2)]] = True
    keys = grams.copy()
    keys[order[dense[group]]] = NONE
    lowest = sliding(keys, m, np.minimum)
    edge = np.zeros(m - 1, np.uint64)
    chosen = (sliding(np.r_[edge, lowest, edge], m, np.maximum) == keys) & (keys != NONE)
    places = order[chosen[order]]
    return places, grams[places]


def seeds(grams: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of equal minimizers that lie ``2m`` to ``4m - 1`` apart and return once more."""
    if len(grams) < 4 * m:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    places, hashes = minimizers(grams, m)
    found_places, found_lags = [], []
    for step in range(1, 8):
        lag = places[step:] - places[:-step]
        hit = (hashes[step:] == hashes[:-step]) & (lag >= 2 * m) & (lag < 4 * m)
        at, lag = places[:-step][hit], lag[hit]
        third = at + 2 * lag
        ok = third < len(grams)
        ok[ok] = grams[third[ok]] == grams[at[ok]]
        found_places.append(at[ok])
        found_lags.append(lag[ok])
    return np.concatenate(found_places), np.concatenate(found_lags)


def extended(
    levels: list[np.ndarray], at: np.ndarray, lags: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The stretch around each place in which words agree with those ``lag`` further on.

    ``levels[k]`` holds the hashes of all stretches of ``2 ** k`` words.
    """
    low, high = at.copy(), at.copy()
    for k in range(len(levels) - 1, -1, -1):
        names, size = levels[k], 1 << k
        live = np.arange(len(at))
        while len(live):
            here, there = high[live], high[live] + lags[live]
            ok = there < len(names)
            ok[ok] = names[here[ok]] == names[there[ok]]
            live = live[ok]
            high[live] += size
        live = np.arange(len(at))
        while len(live):
            here = low[live] - size
            there = here + lags[live]
            ok = (here >= 0) & (there < len(names))
            ok[ok] = names[here[ok]] == names[there[ok]]
            live = live[ok]
            low[live] -= size
    return low, high


def direct(codes: np.ndarray, lag: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of all stretches that agree with the words ``lag`` further on and make a run."""
    places = np.flatnonzero(codes[:-lag] == codes[lag:])
    if not len(places):
        return places, places
    cut = np.flatnonzero(np.diff(places) != 1)
    low, high = places[np.r_[0, cut + 1]], places[np.r_[cut, len(places) - 1]] + 1
    ok = high - low + lag >= max(LEAST_WORDS, LEAST_PERIODS * lag)
    return low[ok], high[ok]


def runs(codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start, length and period of every run, by text, start and period.

    ``codes``: the words of all texts, end to end, equal numbers for equal words;
    ``lengths``: words of each text.
    """
    texts = np.argsort(-lengths, kind="stable")  # long texts first: later scales need them only
    sizes = lengths[texts]
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    total = int(sizes.sum()) + len(sizes)
    line = np.empty(total, np.int64)
    ends = starts + sizes
    inner = np.ones(total, bool)
    inner[ends] = False
    old = np.cumsum(lengths) - lengths
    line[inner] = codes[np.repeat(old[texts] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))]
    # A word of its own after each text: no stretch reaches into another text.
    line[ends] = (int(codes.max()) + 1 if len(codes) else 0) + np.arange(len(sizes))
    found = []
    for lag in range(1, min(2 * FIRST_SCALE, total)):
        low, high = direct(line, lag)
        found.append((low, high + lag - low, np.full(len(low), lag)))

    def reach(m: int) -> int:
        """Words of the texts that can hold a run at scale ``m``, with their end marks."""
        count = int(np.searchsorted(-sizes, -LEAST_PERIODS * 2 * m, "right"))
        return int(ends[count - 1]) + 1 if count else 0

    candidates = []
    levels: list[np.ndarray] = []
    if reach(FIRST_SCALE):
        levels.append(mix(line[:reach(FIRST_SCALE)].astype(np.uint64) + np.uint64(1)))
        m = 1
        while m < FIRST_SCALE or reach(m):
            if m >= FIRST_SCALE:
                candidates.append(seeds(levels[-1], m))
            m *= 2
            last = levels[-1][:reach(max(m, FIRST_SCALE))]
            if len(last) < m:
                break
            levels.append(join(last[:-(m // 2)], last[m // 2:]))
    for at, lags in candidates:
        if len(at):
            low, high = extended(levels, at, lags)
            keep = high - low + lags >= LEAST_PERIODS * lags
            found.append((low[keep], (high - low + lags)[keep], lags[keep]))
    if not found:
        return (np.zeros(0, np.int64),) * 4
    start, length, period = (np.concatenate(c).astype(np.int64) for c in zip(*found, strict=True))
    # A stretch is found with multiples of its period, too: the smallest counts.
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[first], length[first], period[first]
    place = np.searchsorted(starts, start, "right") - 1
    text, start = texts[place], start - starts[place]
    order = np.lexsort((period, start, text))
    return text[order], start[order], length[order], period[order]


def find_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, n_words, runs and collapsed of each row.

    Words are stretches without ASCII white space. ``runs`` lists start (word number from
    0), length and period of every maximal stretch of at least six words and four periods,
    by start, then period; ``collapsed`` holds the words that are left when each run keeps
    its first period only, joined by one blank. Whole texts are searched. Null and empty
    texts have no words and no runs and an empty ``collapsed``; null and repeated ids are
    kept row by row; other columns are not read. No rows give no rows. A text is held by
    one task with about 200 bytes for each of its words.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            texts = Texts(part.column("text"))
            offsets, first = blank_words(texts)
            words, codes = distinct(texts.data, offsets)
            codes, lengths = codes[::2].astype(np.int64), np.diff(first)
            text, start, length, period = runs(codes, lengths)
            change = np.zeros(len(codes) + 1, np.int64)
            np.add.at(change, first[text] + start + period, 1)
            np.add.at(change, first[text] + start + length, -1)
            kept = np.cumsum(change)[:-1] == 0
            spelled = np.array([w.decode() for w in words.to_pylist()], object)
            left = spelled[codes[kept]] if len(codes) else spelled
            bounds = np.r_[0, np.cumsum(kept)][first].tolist()
            collapsed = [" ".join(left[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            listed = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(text, np.arange(len(texts) + 1)), pa.int32()),
                pa.StructArray.from_arrays([pa.array(start), pa.array(length), pa.array(period)],
                                           ["start", "length", "period"]))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(lengths.astype(np.int64)), listed, pa.array(collapsed, pa.string())],
                ["id", "n_words", "runs", "collapsed"])

    kind = docs.schema[id_column].dataType.simpleString()
    read = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return read.mapInArrow(
        lean(search), f"id {kind}, n_words bigint, "
        "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string",
    ).withColumnRenamed("id", id_column)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, in which about every tenth id's words repeat from some word on.

    With h = crc32 of the id in decimal, g = h div 10 and n words: if h is divisible by 10,
    each word from number a = g mod n on becomes word a + (i - a) mod p, where
    p = 1 + (n - a) div (3 + g mod 8). Null ids and texts without words stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    changed = docs.select("doc_id", "text", h.alias("h")).where("h % 10 = 0").select(
        "doc_id", "text", F.expr("h div 10").alias("g"), words.alias("w")).select(
        "*", F.size("w").cast("bigint").alias("n"))
    changed = changed.select("*", F.expr("CASE WHEN n > 0 THEN g % n ELSE 0 END").alias("a")).select(
        "*", F.expr("1 + (n - a) div (3 + g % 8)").alias("p"))
    repeated = F.expr(
        "concat(slice(w, 1, int(a)), slice(flatten(array_repeat(slice(w, int(a) + 1, int(p)), "
        "int((n - a + p - 1) div p))), 1, int(n - a)))")
    changed = changed.select("doc_id", F.when(F.col("n") > 0, F.array_join(repeated, " ")).otherwise(
        F.col("text")).alias("text"))
    return docs.where(F.coalesce(h % 10 != 0, F.lit(True))).select("doc_id", "text").unionByName(changed)


def digest(found: DataFrame) -> DataFrame:
    """Per row: number of runs, the run of most periods, and digests of all runs and of the collapsed text."""
    best = F.expr(
        "get(array_sort(runs, (l, r) -> CASE WHEN l.length * r.period > r.length * l.period THEN -1 "
        "WHEN l.length * r.period < r.length * l.period THEN 1 WHEN l.start < r.start THEN -1 "
        "WHEN l.start > r.start THEN 1 WHEN l.period < r.period THEN -1 WHEN l.period > r.period THEN 1 "
        "ELSE 0 END), 0)")
    lines = F.expr(
        "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return found.select("doc_id", "runs", "collapsed", best.alias("best")).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
