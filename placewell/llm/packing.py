"""Packing of documents into fixed-length sequences by cutting-stock column generation.

A document's ids fill whole sequences as far as they go; the rest is counted in a
length histogram. A linear program over patterns (how many rests of each length share a
sequence) is solved by column generation: a knapsack dynamic program prices new patterns
with the dual values. Pattern counts are rounded down, what remains is packed best-fit,
and lengths that pack badly are cut in parts and packed again. Documents are ranked
within their length, and their rank alone says which pattern takes them.

The driver sees the histogram only (at most one entry per length class).
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placewell.llm.ragged import Texts, distinct, pretokens, slices, sums
from placewell.llm.token_counts import json_store
from placewell.llm.workers import lean
from placewell.session import scratch_dir

CAPACITY = 1024
UNIT = 8  # lengths are rounded up to this many tokens for the patterns
END = 0  # id after each document
ROUNDS = 4  # of cutting and packing again
WASTE = 0.01  # cut lengths in parts while more than this share is padding

PLAN = ("length int, low bigint, high bigint, start int, size int, shift bigint, "
        "each bigint, sequence bigint, slot int")


# ---- on the histogram -----------------------------------------------------------------

def best_pattern(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern within the capacity, by dynamic programming over it."""
    best, chosen = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        fits = int(np.searchsorted(sizes, c, "right"))
        if fits:
            worth = best[c - sizes[:fits]] + values[:fits]
            k = int(np.argmax(worth))
            if worth[k] > best[c] + 1e-12:
                best[c], chosen[c] = worth[k], k
    pattern, c = np.zeros(len(sizes), np.int64), capacity
    while c > 0:
        if chosen[c] < 0:
            c -= 1
        else:
            pattern[chosen[c]] += 1
            c -= int(sizes[chosen[c]])
    return float(best[capacity]), pattern


def fractional_patterns(
    sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 1e-3
) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows) and how often the linear program uses each, within ``gap`` of its optimum.

    Dual values swing widely at first, so patterns are priced with a blend of them and of
    the sizes' own shares (the dual values of a packing without waste). Where the blend
    finds no pattern that helps, the dual values alone decide.
    """
    basis = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1.0 / (capacity // sizes))
    share = sizes / capacity
    least = float(share @ demand)
    step, blend = 0, 0.9
    while step < 12 * len(sizes) + 200:
        duals = inverse.sum(axis=0)
        if float(duals @ demand) <= (1 + gap) * least:
            break
        _, pattern = best_pattern(sizes, blend * share + (1 - blend) * duals, capacity)
        if float(duals @ pattern) <= 1 + gap:
            if blend == 0:
                break
            blend = blend - 0.15 if blend > 0.15 else 0
            continue
        step += 1
        amounts, column = inverse @ demand, inverse @ pattern
        ratio = np.full(len(sizes), np.inf)
        grows = column > 1e-9
        ratio[grows] = np.maximum(amounts[grows], 0) / column[grows]
        k = int(np.argmin(ratio))
        basis[:, k] = pattern
        row = inverse[k] / column[k]
        inverse = inverse - np.outer(column, row)
        inverse[k] = row
    return basis.T.astype(np.int64), np.maximum(inverse @ demand, 0)


def whole_patterns(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Patterns (size to number) with whole counts that take every entry exactly once."""
    if not histogram:
        return []
    sizes = np.array(sorted(histogram), np.int64)
    left = np.array([histogram[int(s)] for s in sizes], np.int64)
    found: list[tuple[dict[int, int], int]] = []
    for pattern, amount in zip(*fractional_patterns(sizes, left.astype(float), capacity), strict=True):
        taken = pattern > 0
        count = min(int(amount + 1e-6), int((left[taken] // pattern[taken]).min()))
        if count > 0:
            left = left - count * pattern
            found.append(({int(s): int(p) for s, p in zip(sizes, pattern, strict=True) if p}, count))
    # At most a pattern's worth per size is left: best fit, longest first.
    room: dict[int, list[Counter]] = {}
    for size, count in zip(sizes[::-1].tolist(), left[::-1].tolist(), strict=True):
        for _ in range(count):
            at = next((r for r in range(size, capacity + 1) if room.get(r)), None)
            bin_ = room[at].pop() if at is not None else Counter()
            rest = (at if at is not None else capacity) - size
            bin_[size] += 1
            room.setdefault(rest, []).append(bin_)
    return found + [(dict(b), 1) for bins in room.values() for b in bins]


def parts(size: int, cuts: int) -> list[int]:
    """A size in about ``cuts`` parts, the last one being the shortest."""
    each = -(-size // min(cuts, size))
    return [each] * ((size - 1) // each) + [size - (size - 1) // each * each]


def plan(histogram: dict[int, int], capacity: int, waste: float = WASTE) -> tuple[list[tuple], int]:
    """Where each (size, rank) goes, as rows of PLAN in units, and the number of sequences.

    A row says: of the rests of this ``length`` those with rank ``low`` to ``high`` have a
    part from ``start``, ``size`` long; counted from ``shift``, ``each`` of them share a
    sequence, from number ``sequence`` on, in order after ``slot``.
    """
    cut: dict[int, tuple[int, int]] = {}  # size: how many are cut, in how many parts
    for turn in range(ROUNDS):
        pieces: list[tuple[int, int, int, int, int]] = []  # length, low, high, start, size
        for length, n in sorted(histogram.items()):
            many, into = cut.get(length, (0, 1))
            if n > many:
                pieces.append((length, 0, n - many, 0, length))
            start = 0
            for size in parts(length, into) if many else []:
                pieces.append((length, n - many, n, start, size))
                start += size
        wanted: Counter = Counter()
        for _, low, high, _, size in pieces:
            wanted[size] += high - low
        patterns = whole_patterns(dict(wanted), capacity)
        total = sum(count for _, count in patterns)
        used = sum(s * n for s, n in wanted.items())
        if (total - 1) * capacity - used <= waste * used:
            break
        bad: Counter = Counter()
        for pattern, count in patterns:
            if capacity - sum(s * n for s, n in pattern.items()) > waste * capacity:
                for size, n in pattern.items():
                    bad[size] += n * count
        more = dict(cut)
        for length, low, high, _, size in pieces:
            if bad[size] and length > 1:
                many, into = cut.get(length, (0, 1))
                if size == length:
                    more[length] = (min(histogram[length], many + min(bad[size], high - low)), max(into, 2))
                elif into < length:
                    more[length] = (many, min(2 * into, length))
        if more == cut or turn == ROUNDS - 1:
            break
        cut = more
    # Ranks within a size: pieces one after the other; patterns take them in that order.
    rows, first = [], 0
    taken: Counter = Counter()
    spans: dict[int, list[tuple[int, int, int, int, int]]] = {}
    for pattern, count in patterns:
        slot = 0
        for size, n in sorted(pattern.items(), reverse=True):
            spans.setdefault(size, []).append((taken[size], taken[size] + n * count, n, first, slot))
            taken[size] += n * count
            slot += n
        first += count
    begins: Counter = Counter()
    for length, low, high, start, size in pieces:
        base = begins[size]
        begins[size] += high - low
        for a, b, each, sequence, slot in spans[size]:
            lo, hi = max(a, base), min(b, base + high - low)
            if lo < hi:
                # rank - low + base is the place within the size; the span starts at a
                rows.append((length, low + lo - base, low + hi - base, start, size,
                             low - base + a, each, sequence, slot))
    return rows, first


# ---- on the documents -----------------------------------------------------------------

def token_table(docs: DataFrame, path: str, id_column: str, text_column: str, capacity: int) -> DataFrame:
    """For each row: id, number of ids, a checksum per full sequence, the rest and its checksum."""

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, special = json_store(path)
        for part in slices(batches, "text"):
            texts = Texts(part.column("text"))
            offsets, first = pretokens(texts, next(iter(special), None))
            words, codes = distinct(texts.data, offsets)
            places = store.look_up(words)[codes]
            ids = store.expand(places).astype("<u4")
            bounds = np.r_[0, np.cumsum(sums(store.counts[places], first))].tolist()
            end = np.array([END], "<u4")
            sizes, checks, rests, rest_checks = [], [], [], []
            for k in range(len(texts)):
                own = np.r_[ids[bounds[k]:bounds[k + 1]], end]
                full = len(own) // capacity * capacity
                sizes.append(len(own))
                checks.append([zlib.crc32(own[a:a + capacity]) for a in range(0, full, capacity)])
                rests.append(own[full:].tobytes())
                rest_checks.append(zlib.crc32(rests[-1]))
            yield pa.RecordBatch.from_arrays([
                part.column("id"), pa.array(sizes, pa.int64()), pa.array(checks, pa.list_(pa.int64())),
                pa.array(rests, pa.binary()), pa.array(rest_checks, pa.int64()),
            ], ["id", "doc_tokens", "checks", "rest", "rest_check"])

    kind = docs.schema[id_column].dataType.simpleString()
    read = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return read.mapInArrow(
        lean(tokenize, thrifty=False), f"id {kind}, doc_tokens bigint, checks array<bigint>, rest binary, rest_check bigint")


def pack(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text",
    capacity: int = CAPACITY,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids by the vocabulary in ``path`` (special strings inside a text as
    that library has them by default), then id 0; null text counts as empty, so that its
    only id is 0. Pieces of a sequence follow each other from offset 0 without a gap and
    hold at most ``capacity`` ids together. Rows with null or repeated ids are documents
    of their own; texts of any length are cut as needed. Other columns are not read. No
    rows give no rows.
    """
    spark = docs.sparkSession
    stored = scratch_dir(spark, "packing")
    token_table(docs, path, id_column, text_column, capacity).withColumn(
        "row", F.monotonically_increasing_id()
    ).withColumns({
        "left": (F.col("doc_tokens") % capacity).cast("int"),
        "salt": F.pmod(F.xxhash64("row"), F.lit(salts(spark))).cast("int"),
    }).withColumn("length", F.ceil(F.col("left") / UNIT).cast("int")).write.option(
        "compression", "zstd").parquet(stored)
    table = spark.read.parquet(stored)

    counts = table.groupBy("salt", "length").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.size("checks")).alias("full"))
    histogram = {r["length"]: r["n"] for r in counts.where("length > 0")
                 .groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows, sequences = plan(histogram, capacity // UNIT)
    where = spark.createDataFrame(rows, PLAN)
    cut = sorted({r[0] for r in rows if r[0] != r[4]})

    before = lambda *keys: Window.partitionBy(*keys).orderBy("salt").rowsBetween(
        Window.unboundedPreceding, -1)
    bases = counts.withColumn("rank_base", F.coalesce(F.sum("n").over(before("length")), F.lit(0)))
    full = counts.groupBy("salt").agg(F.sum("full").alias("full")).withColumn(
        "full_base", F.coalesce(F.sum("full").over(before(F.lit(0))), F.lit(0)))
    # Both are bounded by the salts (times the length classes), not by the documents.
    bases = bases.join(full.select("salt", "full_base"), "salt").select(
        "salt", "length", "rank_base", "full_base")

    own = Window.partitionBy("salt", "length").orderBy("row")
    salt = Window.partitionBy("salt").orderBy("length", "row")
    ranked = (
        table.withColumn("rest", F.when(F.col("length").isin(cut), F.col("rest")) if cut
                         else F.lit(None).cast("binary"))
        .withColumn("fulls", F.size("checks").cast("bigint"))
        .repartition("salt")
        .withColumns({
            "rank": F.row_number().over(own) - 1,
            "full_rank": F.sum("fulls").over(salt.rowsBetween(Window.unboundedPreceding, 0)) - F.col("fulls"),
        })
        .join(F.broadcast(bases) if bounded(spark) else bases, ["salt", "length"])
        .withColumns({"rank": F.col("rank") + F.col("rank_base"),
                      "full_rank": F.col("full_rank") + F.col("full_base")})
    )
    whole = ranked.where("fulls > 0").select(
        "id", "doc_tokens", F.col("full_rank"), F.posexplode("checks").alias("k", "ids_crc32")
    ).select(
        "id", (F.col("k") * F.lit(capacity)).cast("bigint").alias("start"),
        F.lit(capacity).cast("bigint").alias("length"), "ids_crc32", "doc_tokens",
        (F.lit(sequences) + F.col("full_rank") + F.col("k")).cast("bigint").alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
    )
    place = F.col("rank") - F.col("shift")
    share = Window.partitionBy("sequence_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    shared = (
        ranked.join(F.broadcast(where), "length").where("rank >= low AND rank < high")
        .withColumns({
            "sequence_id": (F.col("sequence") + F.floor(place / F.col("each"))).cast("bigint"),
            "turn": F.col("slot") + place % F.col("each"),
            "start": F.col("start").cast("bigint") * UNIT,
        })
        .withColumn("size", F.least(F.col("size").cast("bigint") * UNIT, F.col("left") - F.col("start")))
        .withColumn("ids_crc32", F.when(F.col("size") == F.col("left"), F.col("rest_check")).otherwise(
            F.crc32(F.expr("substring(rest, cast(4 * start + 1 as int), cast(4 * size as int))"))))
        .select("id", (F.col("fulls") * capacity + F.col("start")).alias("start"),
                F.col("size").alias("length"), "ids_crc32", "doc_tokens", "sequence_id", "turn")
        .withColumn("offset", F.coalesce(F.sum("length").over(share), F.lit(0)).cast("bigint"))
        .drop("turn")
    )
    return whole.unionByName(shared).withColumnRenamed("id", id_column)


def salts(spark) -> int:
    """Groups that documents are ranked in: some for each shuffle partition."""
    return 8 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def bounded(spark) -> bool:
    """Whether the table of salts and length classes is small enough to broadcast."""
    return salts(spark) * (CAPACITY // UNIT + 1) * 32 <= 32_000_000
