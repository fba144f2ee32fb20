"""Exact removal of long repeated byte strings by suffix sorting.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else. To
sort only suffixes that can agree, each string is named by its anchor: of the shorter
strings inside it, the first with the smallest hash. Equal strings have equal anchors at
the same place, so neighbouring strings with one anchor make a region, and regions whose
anchor is alone drop out at a filter. Equal regions are one before anything is sorted. The
suffixes of the regions that are left are sorted by ``suffix_sort``, anchor by anchor;
those that agree with a neighbour, or whose region is there more than once, are repeats.
An anchor with very many different regions is split by the hash of each string.

Texts are named by their md5; the regions of equal texts are counted, not repeated.
Anchors and regions are compared by hashes of 64 bits each, regions by both.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placewell.llm.components import stored
from placewell.llm.ragged import Texts, slices
from placewell.llm.suffix_sort import PAD, sort_suffixes
from placewell.llm.workers import lean

LENGTH = 400  # bytes
BLOCK_BITS = 20  # places of a block of text that is hashed at a time
BLOCK = 1 << BLOCK_BITS
PLACE = np.uint64(BLOCK - 1)
FILTER_BITS = 1 << 27  # of each filter that is broadcast, 16 MB; its size does not grow
MAPS = 32_768  # bits of one of Spark's bitmaps
SEEN = 200_000  # regions whose text a task remembers to have sent
MOST_REGIONS = 500  # different regions of an anchor that are sorted together
SORT_BYTES = 2_000_000  # of regions that are sorted together, if an anchor has no more

_draw = np.random.default_rng(20240613)
LETTERS = _draw.integers(1, 2**63, 256, dtype=np.uint64)
BASES = tuple(int(b) * 2 + 1 for b in _draw.integers(1, 2**62, 2))


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, as many as a block has places."""
    found = []
    for b in (base, pow(base, -1, 2**64)):
        steps = np.full(BLOCK + 1, b, np.uint64)
        steps[0] = 1
        with np.errstate(over="ignore"):
            found.append(np.multiply.accumulate(steps))
    return found[0], found[1]


class Rolling:
    """Hashes of any stretch of a block."""

    def __init__(self, data: np.ndarray, base: int) -> None:
        up, self.down = powers(base)
        with np.errstate(over="ignore"):
            self.sums = np.r_[np.uint64(0), np.cumsum(LETTERS[data] * up[:len(data)])]

    def all(self, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[size:] - self.sums[:-size]) * self.down[:len(self.sums) - size])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def blocks(texts: Texts, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """Bytes, offsets of texts, their rows, and bytes of the first text that come before.

    Short texts come together; a text longer than a block comes in parts, each with the
    start of the next, so that every string of ``length`` bytes starts in one of them.
    """
    step = BLOCK - length
    if len(texts.data) <= BLOCK:
        yield texts.data, texts.offsets, np.arange(len(texts)), 0
        return
    for row in range(len(texts)):
        low, high = int(texts.offsets[row]), int(texts.offsets[row + 1])
        for at in range(low, max(high - length + 1, low + 1), step):
            part = texts.data[at:min(at + step + length - 1, high)]
            yield part, np.array([0, len(part)]), np.array([row]), at - low


def regions(
    data: np.ndarray, offsets: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, anchor, hash, first place and number of strings of each region of a block."""
    none = np.zeros(0, np.int64)
    gram = max(length // 2, 1)
    width = length - gram + 1
    if len(data) < length:
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none
    keys = Rolling(data, BASES[0]).all(gram)
    names = (keys & ~PLACE) | np.arange(len(keys), dtype=np.uint64)
    lowest, span = names, 1
    while span < width:  # the smallest name in ``width`` neighbours; ties go to the first place
        step = min(span, width - span)
        lowest = np.minimum(lowest[:-step], lowest[step:])
        span += step
    sizes = np.diff(offsets)
    change = np.zeros(len(data) + 1, np.int64)
    long = sizes >= length
    np.add.at(change, offsets[:-1][long], 1)
    np.add.at(change, offsets[1:][long] - length + 1, -1)
    places = np.flatnonzero(np.cumsum(change)[:len(lowest)] > 0)
    if not len(places):
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none
    anchor = (lowest[places] & PLACE).astype(np.int64)
    text = np.searchsorted(offsets, places, "right") - 1
    fresh = np.ones(len(places), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(fresh)
    count = np.diff(np.r_[first, len(places)])
    start = places[first]
    return text[first], keys[anchor[first]], Rolling(data, BASES[1]).of(start, start + count + length - 1), start, count


def bit_filter(hashes: DataFrame) -> np.ndarray:
    """A fixed number of bits, set for each long in ``h``; a bit may stand for several."""
    place = F.pmod("h", F.lit(FILTER_BITS)) + 1  # Spark's bitmaps count from 1
    found = hashes.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in found.toLocalIterator():  # FILTER_BITS / MAPS rows of 4 KB at most
        start = (r["bucket"] - 1) * (MAPS // 8)
        bits[start:start + MAPS // 8] |= np.frombuffer(bytes(r["bits"]), np.uint8)
    return bits


def inside(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes.astype(np.int64) % FILTER_BITS
    return ((bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1).astype(bool)


def repeated_anchors(texts: DataFrame, length: int) -> DataFrame:
    """g of the anchors that more than one region has."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", BLOCK):
            for data, offsets, _, _ in blocks(Texts(part.column("text")), length):
                found, counts = np.unique(regions(data, offsets, length)[1].view(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts)], ["g", "n"])

    return texts.select("text").mapInArrow(lean(count), "g bigint, n bigint").groupBy("g").agg(
        F.sum("n").alias("n")).where("n > 1").select("g")


def region_rows(texts: DataFrame, anchors: DataFrame, length: int) -> DataFrame:
    """g, r, key, start, strings and bytes of the regions whose anchor passes the filter.

    ``bytes`` is given once a task for each region, as long as the task remembers it.
    """
    held = texts.sparkSession.sparkContext.broadcast(bit_filter(anchors.select(F.col("g").alias("h"))))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, sent = held.value, set()
        for part in slices(batches, "text", BLOCK):
            keys = part.column("key")
            for data, offsets, rows, before in blocks(Texts(part.column("text")), length):
                text, g, r, start, count = regions(data, offsets, length)
                hit = inside(bits, g.view(np.int64))
                text, g, r, start, count = (x[hit] for x in (text, g, r, start, count))
                spelled = []
                for name, at, n in zip(zip(g.tolist(), r.tolist(), strict=True), start.tolist(), count.tolist(), strict=True):
                    new = name not in sent
                    spelled.append(data[at:at + n + length - 1].tobytes() if new else None)
                    if new:
                        sent.add(name)
                if len(sent) > SEEN:
                    sent.clear()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(g.view(np.int64)), pa.array(r.view(np.int64)), keys.take(pa.array(rows[text])),
                     pa.array(start - offsets[text] + before), pa.array(count), pa.array(spelled, pa.binary())],
                    ["g", "r", "key", "start", "strings", "bytes"])

    return texts.select("key", "text").mapInArrow(
        lean(cut), "g bigint, r bigint, key binary, start bigint, strings bigint, bytes binary")


def stretches(flags: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    """First and last place of each run of true flags, between neighbouring bounds."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    places = np.flatnonzero(flags)
    of = owner[places]
    fresh = np.ones(len(places), bool)
    fresh[1:] = (np.diff(places) != 1) | (of[1:] != of[:-1])
    first = np.flatnonzero(fresh)
    last = np.r_[first[1:], len(places)] - 1
    base = bounds[of[first]]
    return pa.ListArray.from_arrays(
        pa.array(np.searchsorted(of[first], np.arange(len(bounds))), pa.int32()),
        pa.StructArray.from_arrays([pa.array(places[first] - base), pa.array(places[last[:len(first)]] - base)], ["low", "high"]))


def sorted_regions(found: DataFrame, length: int) -> DataFrame:
    """g, r and repeats (low, high: first and last string that is a repeat) of different regions."""

    def judge(rows: pa.Table) -> pa.RecordBatch:
        texts = Texts(rows.column("bytes").combine_chunks())
        strings = np.diff(texts.offsets) - length + 1
        bounds = np.r_[0, np.cumsum(strings)]
        starts = np.repeat(texts.offsets[:-1] - bounds[:-1], strings) + np.arange(bounds[-1])
        order, equal = sort_suffixes(np.r_[texts.data, np.zeros(PAD, np.uint8)], starts, length)
        flags = np.repeat(rows.column("copies").to_numpy() > 1, strings)
        flags[order] |= equal | np.r_[equal[1:], False]
        return pa.RecordBatch.from_arrays(
            [rows.column("g").combine_chunks(), rows.column("r").combine_chunks(), stretches(flags, bounds)],
            ["g", "r", "repeats"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for part in slices(batches, "bytes", SORT_BYTES):
            # Anchors up to the last one are complete; that one may go on.
            g = part.column("g").to_numpy()
            last = int(np.searchsorted(g, g[-1]))
            if last:
                yield judge(pa.Table.from_batches([*held, part.slice(0, last)]))
                held = [part.slice(last)]
            elif held and held[-1].column("g")[0].as_py() != g[0]:
                yield judge(pa.Table.from_batches(held))
                held = [part]
            else:
                held.append(part)
        if held:
            yield judge(pa.Table.from_batches(held))

    return found.select("g", "r", "copies", "bytes").repartition("g").sortWithinPartitions("g").mapInArrow(
        lean(walk), "g bigint, r bigint, repeats array<struct<low: bigint, high: bigint>>")


def split_regions(found: DataFrame, length: int) -> DataFrame:
    """As ``sorted_regions``, for anchors with very many regions: each string goes by its own hash."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "bytes", BLOCK // 2):
            for data, offsets, rows, _ in blocks(Texts(part.column("bytes")), length):
                strings = np.maximum(np.diff(offsets) - length + 1, 0)
                bounds = np.r_[0, np.cumsum(strings)]
                place = np.arange(bounds[-1]) - np.repeat(bounds[:-1], strings)
                starts = place + np.repeat(offsets[:-1], strings)
                of = pa.array(np.repeat(rows, strings))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c).take(of) for c in ("g", "r", "copies")), pa.array(place),
                     *(pa.array(Rolling(data, b).of(starts, starts + length).view(np.int64)) for b in BASES)],
                    ["g", "r", "copies", "place", "h", "i"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("places").value_lengths().to_numpy()
            places = batch.column("places").flatten().to_numpy()
            # Flags of one region lie between its own bounds.
            top = np.array([p.max() for p in np.split(places, np.cumsum(sizes)[:-1])], np.int64) + 1
            bounds = np.r_[0, np.cumsum(top)]
            flags = np.zeros(bounds[-1], bool)
            flags[places + np.repeat(bounds[:-1], sizes)] = True
            yield pa.RecordBatch.from_arrays(
                [batch.column("g"), batch.column("r"), stretches(flags, bounds)], ["g", "r", "repeats"])

    strings = stored(found.select("g", "r", "copies", "bytes").mapInArrow(
        lean(name), "g bigint, r bigint, copies bigint, place bigint, h bigint, i bigint"), "strings")
    again = strings.groupBy("h", "i").agg(F.sum("copies").alias("n")).where("n > 1").select("h", "i")
    return strings.join(again, ["h", "i"]).groupBy("g", "r").agg(F.collect_list("place").alias("places")).mapInArrow(
        lean(join), "g bigint, r bigint, repeats array<struct<low: bigint, high: bigint>>")


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Start and end of what the spans cover, in order; touching spans are one."""
    out: list[tuple[int, int]] = []
    for low, high in sorted((s["start"], s["end"]) for s in spans):
        if out and low <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], high)
        else:
            out.append((low, high))
    return out


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH,
    most_regions: int = MOST_REGIONS,
) -> DataFrame:
    """id, n_bytes, spans (start and end of what is removed) and kept (the bytes left) of each row.

    Texts are UTF-8 bytes; a string never spans two texts. What is a repeat is judged on
    the texts as given; overlapping strings of one text count. Null texts are empty; texts
    shorter than ``length`` keep everything; null and repeated ids are kept row by row, and
    each row is a text of its own. Other columns are not read. No rows give no rows.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    texts = rows.select("text", F.unhex(F.md5("text")).alias("key"))
    anchors = stored(repeated_anchors(texts, length), "anchors")
    table = stored(region_rows(texts, anchors, length), "regions")
    found = stored(table.groupBy("g", "r").agg(
        F.count(F.lit(1)).alias("copies"), F.max("bytes").alias("bytes")), "distinct-regions")
    heavy = stored(found.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where(
        F.col("n") > most_regions).select("g"), "heavy-anchors")
    if heavy.isEmpty():
        repeats = sorted_regions(found, length)
    else:
        repeats = sorted_regions(found.join(heavy, "g", "left_anti"), length).unionByName(
            split_regions(found.join(heavy, "g", "left_semi"), length))
    repeats = stored(repeats.where(F.size("repeats") > 0), "repeats")
    # One row for each region of each different text.
    places = table.select("g", "r", "key", "start").distinct()
    spans = places.join(repeats, ["g", "r"]).select("key", "start", F.explode("repeats").alias("s")).select(
        "key", F.struct((F.col("start") + F.col("s.low")).alias("start"),
                        (F.col("start") + F.col("s.high") + length).alias("end")).alias("span"))
    spans = stored(spans.groupBy("key").agg(F.collect_list("span").alias("spans")), "spans")
    held = rows.sparkSession.sparkContext.broadcast(bit_filter(spans.select(F.xxhash64("key").alias("h"))))

    def passing(hit: bool):
        """Rows whose text may, or can not, have spans."""

        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = inside(held.value, batch.column("h").to_numpy())
                yield batch.filter(pa.array(found == hit))

        return choose

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(iter([batch]), "text", BLOCK):
                kept, gone = [], []
                for text, spans in zip(part.column("text"), part.column("spans").to_pylist(), strict=True):
                    whole = text.as_buffer().to_pybytes()
                    found = merged(spans or [])
                    edges = [0, *(e for span in found for e in span), len(whole)]
                    kept.append(b"".join(whole[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                    gone.append([{"start": a, "end": b} for a, b in found])
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(np.diff(Texts(part.column("text")).offsets)),
                     pa.array(gone, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                     pa.array(kept, pa.binary())], ["id", "n_bytes", "spans", "kept"])

    kind = rows.schema["id"].dataType.simpleString()
    shape = f"id {kind}, n_bytes bigint, spans array<struct<start: bigint, end: bigint>>, kept binary"
    marked = rows.select("id", "text", F.unhex(F.md5("text")).alias("key")).withColumn("h", F.xxhash64("key"))
    layout = f"id {kind}, text string, key binary, h bigint"
    clean = marked.mapInArrow(passing(False), layout).select(
        "id", F.octet_length("text").cast("bigint").alias("n_bytes"),
        F.expr("CAST(array() AS array<struct<start: bigint, end: bigint>>)").alias("spans"),
        F.col("text").cast("binary").alias("kept"))
    other = marked.mapInArrow(passing(True), layout).join(spans, "key", "left").select(
        "id", "text", "spans").mapInArrow(lean(cut), shape)
    return clean.unionByName(other).withColumnRenamed("id", id_column)
