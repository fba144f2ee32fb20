"""Near-duplicates by order min-hash with verification by banded alignment.

Texts are sequences of word shingles, each labelled with its occurrence. A sketch takes
several labelled shingles with the smallest hashes and keeps them in text order, so that
it agrees for texts that are close in edits, not only in content. Texts that share a
sketch are candidates; an alignment within a band decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placewell.llm.components import components, discard, stored
from placewell.llm.ragged import Texts, blank_words, distinct, slices
from placewell.llm.workers import lean

WORDS = 5  # words of a shingle
SIMILARITY = 0.8
SKETCHES = 14
PICKS = 3  # shingles of a sketch
DEPTHS = (1, 2, 4)  # neighbouring sketches that make a group of candidates
FIRST_HUBS = 16  # of a group in the first further round
SIGN_BITS = 1024  # of the sign by which most texts are told apart before they are aligned; more of them change no result
SHARE = 500  # members of a group that meet its hubs in one task
GROWTH = 8  # times as many hubs in each round, until every member has been one
FILTER_BITS = 1 << 25  # of the filter that is broadcast; its size does not grow

SEEDS = np.random.default_rng(20240501).integers(1, 2**63, SKETCHES, dtype=np.uint64)
LARGEST = np.uint64(2**64 - 1)


# ---- sequences of shingles ------------------------------------------------------------

def normalised(text: Column) -> Column:
    """Words in lower case, one blank between them. Null stays null."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\p{M}]+", " "))


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingles(texts: Texts, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of each text in order, and the first of each text.

    A text of fewer words has one shingle of all of them; a text without words has none.
    """
    offsets, first = blank_words(texts)
    found, codes = distinct(texts.data, offsets)
    hashes = np.frombuffer(b"".join(map(xxhash.xxh64_digest, found.to_pylist())), ">u8").astype(np.uint64)
    w = hashes[codes[::2]] if len(codes) else np.zeros(0, np.uint64)
    sizes = np.diff(first)
    counts = np.where(sizes >= words, sizes - words + 1, np.minimum(sizes, 1))
    bounds = np.r_[0, np.cumsum(counts)]
    starts = np.repeat(first[:-1] - bounds[:-1], counts) + np.arange(bounds[-1])
    widths = np.repeat(np.minimum(sizes, words), counts)
    out = np.zeros(len(starts), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(words):
            there = widths > k
            step = w[np.minimum(starts + k, max(len(w) - 1, 0))] if len(w) else w
            out = np.where(there, out * np.uint64(0x9E3779B97F4A7C15) + step + np.uint64(1), out)
    return mix(out), bounds


def labelled(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Hashes with the occurrence in the text mixed in, so that each is unique in its text."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    occurrence = np.zeros(len(hashes), np.uint64)
    # Only hashes that are equal, with those whose names happen to be, need to be put in order.
    with np.errstate(over="ignore"):
        names = hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    in_order = np.sort(names)
    again = in_order[1:][in_order[1:] == in_order[:-1]]
    if len(again):
        at = np.minimum(np.searchsorted(again, names), len(again) - 1)
        among = np.flatnonzero(again[at] == names)
        order = among[np.lexsort((hashes[among], owner[among]))]
        h, o = hashes[order], owner[order]
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
        at = np.arange(len(h))
        occurrence[order] = at - np.maximum.accumulate(np.where(fresh, at, 0))
    with np.errstate(over="ignore"):
        return mix(hashes + occurrence * np.uint64(0xD6E8FEB86659FD93))


def order_sketches(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row per text with SKETCHES hashes; texts without shingles have zeros."""
    n = len(bounds) - 1
    out = np.zeros((n, SKETCHES), np.uint64)
    counts = np.diff(bounds)
    own = np.flatnonzero(counts)
    if not len(own):
        return out
    first, counts = bounds[:-1][own], counts[own]
    label = labelled(hashes, bounds)
    place = np.repeat(np.arange(len(own)), counts)
    for k, seed in enumerate(SEEDS):
        value = mix(label ^ seed)
        picks = np.full((len(own), PICKS), len(hashes), np.int64)
        for p in range(PICKS):
            least = np.minimum.reduceat(value, first)
            hit = np.flatnonzero(value == least[place])
            where = np.full(len(own), len(hashes), np.int64)
            where[place[hit[::-1]]] = hit[::-1]
            there = counts > p
            picks[there, p] = where[there]
            value[where[there]] = LARGEST
        picks.sort(axis=1)
        padded = np.r_[label, np.uint64(0)]
        sketch = np.full(len(own), k + 1, np.uint64)
        with np.errstate(over="ignore"):
            for p in range(PICKS):
                sketch = mix(sketch * np.uint64(0x9E3779B97F4A7C15) + padded[picks[:, p]])
        out[own, k] = sketch
    return out


# ---- alignment ------------------------------------------------------------------------

def aligned(a: np.ndarray, b: np.ndarray, need: int) -> int:
    """Matches of the best alignment of two sequences, if there are ``need`` at least.

    Only the band that an alignment with that many matches can reach is looked at; below
    that number the result may be too small.
    """
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    head = int(differ[0]) if len(differ) else n
    a, b = a[head:], b[head:]
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[::-1][:n] != b[::-1][:n])
    tail = int(differ[0]) if len(differ) else n
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    rest = need - head - tail
    if not len(a) or not len(b):
        return head + tail
    if rest > min(len(a), len(b)):
        return head + tail
    rest = max(rest, 0)
    low, high = -(len(a) - rest), len(b) - rest
    width = high - low + 1
    lead = np.full(-low, -1, np.int64)
    padded = np.r_[lead, b, np.full(len(a) + width, -1, np.int64)]
    row = np.zeros(width + 1, np.int32)
    for i in range(len(a)):
        step = row[:width] + (padded[i:i + width] == a[i])
        np.maximum(step, row[1:], out=step)
        np.maximum.accumulate(step, out=row[:width])
    return head + tail + int(row[len(b) - len(a) - low])


def similar(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> bool:
    """Whether aligned shingles are ``least`` of all shingles of both, matches counted once."""
    need = int(np.ceil(least * (len(a) + len(b)) / (1 + least) - 1e-9))
    if min(len(a), len(b)) < need:
        return False
    # Matches out of order count here, so this is an upper bound.
    values, places = np.unique(np.r_[a, b], return_inverse=True)
    shared = np.minimum(np.bincount(places[:len(a)], minlength=len(values)),
                        np.bincount(places[len(a):], minlength=len(values)))
    if shared.sum() < need:
        return False
    names = places.astype(np.int64)
    return aligned(names[:len(a)], names[len(a):], need) >= need


# ---- jobs -----------------------------------------------------------------------------

def sketch_table(rows: DataFrame) -> DataFrame:
    """id, key, mark, n (shingles) and sketches for rows of id, key, mark and words."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "words"):
            hashes, bounds = shingles(Texts(part.column("words")))
            found = order_sketches(hashes, bounds).view(np.int64)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(found) + 1) * SKETCHES, pa.int32()), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("key"), part.column("mark"), pa.array(np.diff(bounds)), lists],
                ["id", "key", "mark", "n", "sketches"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "key", "mark", "words").mapInArrow(
        lean(sketch), f"id {kind}, key binary, mark bigint, n bigint, sketches array<bigint>")


def group_keys(sketches: Column, depths=DEPTHS) -> Column:
    """Keys of the groups that a text is in: of one sketch, and of neighbouring ones together."""
    at = lambda k: F.get(sketches, F.lit(k % SKETCHES))
    return F.array(*[F.xxhash64(F.lit(1000 * depth + k), *[at(k + j) for j in range(depth)])
                     for depth in depths for k in range(SKETCHES)])


def bit_filter(hashes: DataFrame) -> np.ndarray:
    """A fixed number of bits, set for each long in ``h``; a bit may stand for several."""
    place = F.pmod("h", F.lit(FILTER_BITS)) + 1  # Spark's bitmaps count from 1
    found = hashes.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in found.collect():  # FILTER_BITS / 32768 rows of 4 KB at most
        start = (r["bucket"] - 1) * 4096
        bits[start:start + 4096] |= np.frombuffer(bytes(r["bits"]), np.uint8)
    return bits


def passing(rows: DataFrame, column: str, wanted: DataFrame, hit: bool = True) -> DataFrame:
    """Rows whose long in ``column`` the filter of ``h`` lets through, or with ``hit`` false the others."""
    held = rows.sparkSession.sparkContext.broadcast(bit_filter(wanted))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = held.value
        for batch in batches:
            p = batch.column(column).to_numpy() % FILTER_BITS
            inside = ((bits[p >> 3] >> (p & 7).astype(np.uint8)) & 1).astype(bool)
            yield batch.filter(pa.array(inside == hit))

    return rows.mapInArrow(lean(choose), rows.schema)


def sequences(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """key and shingles (bytes) of the rows of text and mark that have a wanted ``mark``.

    A filter of fixed size drops most other rows before their texts are normalised; the
    join that follows drops the rest.
    """
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "words"):
            hashes, bounds = shingles(Texts(part.column("words")))
            ends = bounds.tolist()
            yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(
                [hashes[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())],
                ["key", "shingles"])

    picked = passing(rows.select("text", "mark"), "mark", wanted.select(F.col("mark").alias("h")))
    words = picked.where("text IS NOT NULL").select(normalised(F.col("text")).alias("words"))
    return words.select("words", F.unhex(F.md5("words")).alias("key")).mapInArrow(
        lean(split), "key binary, shingles binary")


def verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """src, dst of the candidate pairs (hub, other) whose texts are similar."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [similar(np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64), least)
                  for a, b in zip(batch.column("a"), batch.column("b"), strict=True)]
            kept = batch.filter(pa.array(ok, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("hub"), kept.column("other")], ["src", "dst"])

    # Texts of no pair are not moved, but for some that the filter lets through.
    texts = passing(texts.select("node", "shingles"), "node", pairs.select(
        F.explode(F.array("hub", "other")).alias("h")))
    other = texts.select(F.col("node").alias("other"), F.col("shingles").alias("b"))
    hub = texts.select(F.col("node").alias("hub"), F.col("shingles").alias("a"))
    return pairs.join(other, "other").join(hub, "hub").select("hub", "other", "a", "b").mapInArrow(
        lean(verify), "src bigint, dst bigint")


def rare_shingles(texts: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """node, n (shingles), m (shared ones) and g: for each text so many of its rarest shingles that similar texts share one.

    And node and sign: SIGN_BITS bits as longs, those set that its shingles fall on, for
    ``may_be_similar``.

    Texts of n shingles need least * n in common, so one of the n - least * n + 1 that come
    first in any order that holds for all texts is shared. The order is by the number of
    texts that have the shingle, counted one by one: by counts of a fixed number of buckets
    the groups would grow faster than the input. Shingles of one text meet no other, and a
    text with too few others to be similar to any is left out.
    """

    def sequences_of(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(x.as_buffer()) // 8 for x in part.column("shingles")], np.int64)
        data = b"".join(x.as_py() for x in part.column("shingles"))
        return np.frombuffer(data, np.uint64), np.r_[0, np.cumsum(sizes)]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "shingles"):
            hashes, bounds = sequences_of(part)
            sizes = np.diff(bounds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(part.column("node").to_numpy(), sizes)), pa.array(np.repeat(sizes, sizes)),
                 pa.array(labelled(hashes, bounds).view(np.int64))], ["node", "n", "g"])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "shingles"):
            hashes, bounds = sequences_of(part)
            flags = np.zeros((part.num_rows, SIGN_BITS), np.uint8)
            owner = np.repeat(np.arange(part.num_rows), np.diff(bounds))
            flags[owner, (hashes % np.uint64(SIGN_BITS)).astype(np.int64)] = 1
            yield pa.RecordBatch.from_arrays([part.column("node"), pa.ListArray.from_arrays(
                pa.array(np.arange(part.num_rows + 1) * (SIGN_BITS // 64), pa.int32()),
                pa.array(np.packbits(flags, axis=1).view(np.int64).ravel()))], ["node", "sign"])

    read = texts.select("node", "shingles")
    grams = read.mapInArrow(lean(split), "node bigint, n bigint, g bigint")
    often = F.count(F.lit(1)).over(Window.partitionBy("g"))
    own = Window.partitionBy("node")
    common = F.ceil(F.lit(least) * F.col("n") - F.lit(1e-9))
    rarest = stored(grams.withColumn("often", often).where("often > 1").withColumn("m", F.count(F.lit(1)).over(own)).where(
        F.col("m") >= common).withColumn("turn", F.row_number().over(own.orderBy("often", "g"))).where(
        # n - m shingles that only this text has come before these.
        F.col("turn") <= F.col("m") - common + 1).select("node", "n", "m", "g"), "rare")
    return rarest, stored(read.mapInArrow(lean(sign), "node bigint, sign array<bigint>"), "signs")


def may_be_similar(least: float) -> Column:
    """Whether the signs of two texts differ in so few bits as those of similar ones do.

    Similar texts of a and b shingles share t = least (a + b) / (1 + least), so at most a - t
    shingles of the one are not in the other. Each bit that only the one has set stands for
    such a shingle at least.
    """
    shared = F.ceil(F.lit(least / (1 + least)) * (F.col("n") + F.col("hub_n")) - F.lit(1e-6))
    pairs = [(F.get("sign", F.lit(k)), F.get("hub_sign", F.lit(k))) for k in range(SIGN_BITS // 64)]
    only = lambda a, b: F.bit_count(a.bitwiseAND(F.bitwise_not(b)))
    return (sum((only(a, b) for a, b in pairs[1:]), only(*pairs[0])) <= F.col("n") - shared) & (
        sum((only(b, a) for a, b in pairs[1:]), only(*pairs[0][::-1])) <= F.col("hub_n") - shared)


def classes(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: float = SIMILARITY
) -> DataFrame:
    """id, key, class_id, is_kept: one row per row of ``docs``, its class and one kept row per class.

    Texts with equal words are copies; copies are one node. Nodes that share a sketch are
    candidates: in each group the most central node is aligned with every other. Then the
    nodes that share a sketch with any other meet by their rarest shingles, with more hubs in
    each round, until every such pair of different classes and fitting lengths is tried; no
    similar pair of them is left out. A class is what links connect; class_id is
    its smallest id. Null texts are in no class (class_id is their own id, all are kept);
    texts without words are copies of each other. Rows with null or equal ids count by
    their texts; of equal rows one is kept. Other columns are not read. No rows give no
    rows.
    """
    words = normalised(F.col("text"))
    raw_texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"),
                            F.xxhash64(F.col(id_column), F.col(text_column)).alias("mark"))
    # A text that is there has words that are there, so that a test of the text spares their making.
    rows = raw_texts.where("text IS NOT NULL").select("id", "mark", words.alias("words")).withColumn(
        "key", F.unhex(F.md5("words")))
    table = stored(sketch_table(rows), "sketches")
    nodes = stored(table.groupBy("key").agg(
        F.min("id").alias("id"), F.min("mark").alias("mark"), F.any_value("n").alias("n"),
        F.any_value("sketches").alias("sketches"),
    ).withColumn("node", F.monotonically_increasing_id()), "nodes")

    single = nodes.where("n > 0").select("node", F.explode(group_keys(F.col("sketches"), (1,))).alias("g"))
    sizes = single.groupBy("g").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    central = single.join(sizes, "g").groupBy("node").agg(F.sum("size").alias("degree"))
    linked = stored(nodes.join(central, "node"), "linked")
    # A group's hub: the node that meets most others, ties by a hash.
    rank = F.shiftleft(F.least("degree", F.lit(1 << 22)), 40) + F.pmod(F.xxhash64("node"), F.lit(1 << 40))
    members = stored(linked.select(
        "node", "n", rank.alias("rank"), F.explode(group_keys(F.col("sketches"))).alias("g")), "members")

    texts = stored(sequences(raw_texts, linked.select("mark")).join(
        linked.select("key", "node"), "key").dropDuplicates(["node"]).select("node", "shingles"), "shingles")

    fits = lambda a, b: F.least(a, b) >= F.lit(least) * F.greatest(a, b)
    hubs = members.groupBy("g").agg(
        F.max_by("node", "rank").alias("hub"), F.max_by("n", "rank").alias("hub_n"),
        F.count(F.lit(1)).alias("size")).where("size > 1").drop("size")
    tried = stored(members.join(hubs, "g").where("node <> hub").where(fits("n", "hub_n")).select(
        F.least("hub", "node").alias("hub"), F.greatest("hub", "node").alias("other")).distinct(), "tried")
    discard(linked, members)
    links = stored(verified(tried, texts, least), "links")
    labels = components(links)
    # Similar texts share one of their rarest shingles; a text's place in such a group says
    # in which round it is a hub.
    rarest, signs = rare_shingles(texts, least)
    held, done, reach = rarest, 0, FIRST_HUBS
    while True:
        # Texts that were hubs have met all others; only groups that still hold more than one class go on.
        now = held.where(F.col("place") >= done) if done else held.withColumn("label", F.col("node"))
        now = now.join(labels.select(F.col("node").alias("label"), "component"), "label", "left").withColumn(
            "label", F.coalesce("component", "label")).drop("component")
        open_ = now.groupBy("g").agg(
            F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("size")).where(
            "low < high").select("g", "size")
        now = now.join(open_, "g")
        if not done:
            now = now.withColumns({"place": F.pmod(F.xxhash64("node", "g"), F.col("size")),
                                   "shares": F.ceil(F.col("size") / SHARE)})
        before, held = held, stored(now.drop("size"), "open")
        discard(before)
        if held.isEmpty():
            break
        # A large group is dealt into shares; its hubs go to each of them.
        share = F.pmod(F.xxhash64("node"), F.col("shares")).alias("share")
        known = held.join(signs, "node")
        hubs = known.where(F.col("place") < reach).select(
            F.col("g").alias("hub_g"), F.col("node").alias("hub"), F.col("n").alias("hub_n"), F.col("m").alias("hub_m"),
            F.col("sign").alias("hub_sign"), F.col("label").alias("hub_label"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shares") - 1)).alias("hub_share"))
        # Of so many aligned shingles none can be in one text alone.
        enough = F.least("m", "hub_m") >= F.lit(least / (1 + least)) * (F.col("n") + F.col("hub_n")) - F.lit(1e-6)
        once = (F.col("place") >= reach) | (F.col("node") > F.col("hub"))
        new = known.select("*", share).join(
            hubs, (F.col("g") == F.col("hub_g")) & (F.col("share") == F.col("hub_share")) & (F.col("label") != F.col("hub_label"))
                        & fits("n", "hub_n") & enough & once & may_be_similar(least)).select(
            F.least("hub", "node").alias("hub"), F.greatest("hub", "node").alias("other")).distinct()
        new = stored(new.join(tried, ["hub", "other"], "left_anti"), "tried")
        if not new.isEmpty():
            found = stored(verified(new, texts, least), "links")
            tried = tried.unionByName(new)
            if not found.isEmpty():
                links = links.unionByName(found)
                labels = components(links)
        done, reach = reach, reach * GROWTH

    named = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("component", "node"))
    smallest = named.groupBy("label").agg(F.min("id").alias("class_id"))
    named = stored(named.join(smallest, "label").select("key", F.col("id").alias("first_id"), "class_id", "label"), "classes")
    discard(nodes, texts, signs, held)
    # The kept row of a class: its smallest id; of rows with that id, the first by key.
    keeper = named.where(F.col("first_id").eqNullSafe(F.col("class_id"))).groupBy("label").agg(
        F.min("key").alias("keeper"))
    named = named.join(keeper, "label").withColumn("is_keeper", F.col("key") == F.col("keeper"))
    found = table.select("id", "key").join(named.select("key", "class_id", "is_keeper"), "key").withColumn(
        "is_kept", F.col("is_keeper") & F.col("id").eqNullSafe(F.col("class_id"))).drop("is_keeper")
    empty = raw_texts.where("text IS NULL").select(
        "id", F.lit(None).cast("binary").alias("key"), F.col("id").alias("class_id"), F.lit(True).alias("is_kept"))
    return found.unionByName(empty).withColumnRenamed("id", id_column)


def drop_near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: float = SIMILARITY
) -> DataFrame:
    """``docs`` with one row of each class of near-duplicates, the one with the smallest id.

    Rows with null text are all kept; of rows that have the same id and words one is. Every
    column is returned, whatever its name.
    """
    held = docs.select(F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns]).alias("row"),
                       F.col(id_column).alias("id"), F.xxhash64(F.col(id_column)).alias("h"),
                       F.col(text_column).alias("text"))
    # Only rows that go, or that are there more than once, need to be looked up; a filter of
    # fixed size tells most others by their ids before anything is shuffled or normalised.
    doubtful = stored(classes(docs, id_column, text_column, least).where("key IS NOT NULL").groupBy(
        F.col(id_column).alias("id"), "key").agg(F.max("is_kept").alias("is_kept"), F.count(F.lit(1)).alias("n")).where(
        "n > 1 OR NOT is_kept"), "doubtful")
    ids = doubtful.select(F.xxhash64("id").alias("h"))
    worded = held.where("text IS NOT NULL")
    other = passing(worded, "h", ids).withColumn("key", F.unhex(F.md5(normalised(F.col("text")))))
    same = other["id"].eqNullSafe(doubtful["id"]) & (other["key"] == doubtful["key"])
    looked = other.join(doubtful, same, "left").select(other["row"], other["id"], other["key"], "is_kept")
    one = Window.partitionBy("key", "id").orderBy(F.xxhash64("row"))
    again = looked.where("is_kept").withColumn("turn", F.row_number().over(one)).where("turn = 1").select("row")
    return passing(worded.select("row", "h"), "h", ids, hit=False).select("row").unionByName(
        looked.where("is_kept IS NULL").select("row")).unionByName(again).unionByName(
        held.where("text IS NULL").select("row")).select("row.*")
