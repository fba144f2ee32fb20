"""Quality classifier by importance resampling.

Two bags of hashed n-grams are fitted: one on documents labelled good, one on all
documents. A document's log weight is the sum over its n-grams of the log ratio of the
two. Adding Gumbel noise and keeping the k largest keys draws k documents without
replacement in proportion to their weights; k is the labelled share of good documents.
The noise is scaled by a temperature t, which draws in proportion to the weights to the
power 1 / t: with the 0.3 used here, sharper than the weights alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placewell.llm.ragged import SPACE, Texts, char_kinds, characters, distinct, slices, sums
from placewell.llm.workers import lean, with_field
from placewell.session import scratch_dir

BUCKETS = 32_768
LABELLED = 50_000  # labelled rows at most that the good model is fitted on
SMOOTH = 1.0
SEED = 17
TEXT = "_text"  # a struct's text, beside it inside a task
REPEAT = 0x5EED  # stands for a word that follows itself


def grams(texts: Texts, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and word pairs of each text, and the first of each text.

    A word is a run of letters and numbers or a run of other signs, in lower case. A pair
    of equal words has one bucket of its own, so that repetition is seen whatever the word.
    """
    data = texts.data
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    at, points = characters(data)
    kinds = np.minimum(char_kinds()[points], 3)
    kinds[(kinds == 1) | (kinds == 2)] = 1
    cut = np.ones(len(at), bool)
    cut[1:] = kinds[1:] != kinds[:-1]
    begin = np.searchsorted(at, texts.offsets)
    cut[begin[begin < len(at)]] = True
    starts, word = at[cut], kinds[cut] != SPACE
    words, codes = distinct(data, np.r_[starts, len(data)])
    hashes = np.array([zlib.crc32(w.decode("utf-8", "replace").lower().encode())
                       for w in words.to_pylist()], np.uint64)[codes[word]]
    first = np.searchsorted(starts[word], texts.offsets)
    with np.errstate(over="ignore"):
        mixed = hashes * np.uint64(0x9E3779B97F4A7C15)
        pairs = (mixed[:-1] ^ (mixed[:-1] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + mixed[1:]
        pairs[hashes[:-1] == hashes[1:]] = REPEAT
        pairs = (pairs ^ (pairs >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    single = (mixed >> np.uint64(33)) % np.uint64(buckets)
    double = np.r_[(pairs >> np.uint64(33)) % np.uint64(buckets), np.zeros(1, np.uint64)][:len(single)]
    both = np.empty(2 * len(single), np.int64)
    both[::2], both[1::2] = single, double
    ends = first[1:][first[1:] > first[:-1]] - 1  # the last word of a text starts no pair
    keep = np.ones(len(both), bool)
    keep[2 * ends + 1] = False
    return both[keep], 2 * first - np.r_[0, np.cumsum(first[1:] > first[:-1])]


def gram_counts(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, all_count and good_count over rows of ``text`` and ``good`` (boolean or null)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, good = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for part in slices(batches, "text"):
            found, first = grams(Texts(part.column("text")), buckets)
            total += np.bincount(found, minlength=buckets)
            liked = np.array(part.column("good").fill_null(False).to_numpy(zero_copy_only=False), bool)
            good += np.bincount(found[np.repeat(liked, np.diff(first))], minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen), pa.array(total[seen]), pa.array(good[seen])],
            ["bucket", "all_count", "good_count"])

    return rows.mapInArrow(lean(count), "bucket bigint, all_count bigint, good_count bigint").groupBy("bucket").agg(
        F.sum("all_count").alias("all_count"), F.sum("good_count").alias("good_count"))


def log_ratios(counts: DataFrame, buckets: int = BUCKETS, smooth: float = SMOOTH) -> np.ndarray:
    """Log ratio of the good model to the model of all documents, per bucket."""
    total, good = np.zeros(buckets), np.zeros(buckets)
    for r in counts.collect():  # one row per bucket at most
        total[r["bucket"]], good[r["bucket"]] = r["all_count"], r["good_count"]
    ratio = lambda x: np.log((x + smooth) / (x.sum() + smooth * buckets))
    return ratio(good) - ratio(total) if good.sum() else np.zeros(buckets)


def weights(
    rows: DataFrame, ratios: np.ndarray, text_column: str = "text", struct: str | None = None, drop_text: bool = False
) -> DataFrame:
    """``rows`` with n_grams and log_weight (null without n-grams).

    ``struct``: the column that holds ``text_column``, if that is no column itself.
    ``drop_text``: leave ``text_column`` out.
    """
    held = rows.sparkSession.sparkContext.broadcast(ratios)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if struct:
            batches = with_field(batches, struct, text_column, TEXT)
        for part in slices(batches, TEXT if struct else text_column):
            found, first = grams(Texts(part.column(TEXT if struct else text_column)), len(held.value))
            n = np.diff(first)
            weight = np.add.reduceat(np.r_[held.value[found], 0.0], first[:-1]) if len(n) else np.zeros(0)
            if struct or drop_text:
                part = part.drop_columns([TEXT if struct else text_column])
            yield part.append_column("n_grams", pa.array(n)).append_column(
                "log_weight", pa.array(weight.astype(float), mask=n == 0))

    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in rows.schema
                       if not (drop_text and f.name == text_column))
    return rows.mapInArrow(lean(weigh), f"{fields}, n_grams bigint, log_weight double")


def kth_largest(keys: DataFrame, column: str, k: int, bins: int = 1024, few: int = 1000) -> float:
    """The k-th largest value, from counts of ever narrower bins; at most ``few`` values are collected."""
    low, high = keys.agg(F.min(column), F.max(column)).first()
    above = 0
    while True:
        inside = keys.where((F.col(column) >= low) & (F.col(column) <= high))
        width = (high - low) / bins
        if not width > 0 or low + width == low:
            return low
        place = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1)).cast("int").alias("bin")
        found = {r["bin"]: r for r in inside.groupBy(place).agg(
            F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).collect()}
        for b in sorted(found, reverse=True):
            if above + found[b]["n"] >= k:
                break
            above += found[b]["n"]
        low, high = found[b]["low"], found[b]["high"]
        if found[b]["n"] <= few:
            values = sorted((r[0] for r in keys.where(
                (F.col(column) >= low) & (F.col(column) <= high)).select(column).collect()), reverse=True)
            return values[k - above - 1]


def classify(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    temperature: float = 0.3, share: float | None = None,
) -> DataFrame:
    """``docs`` with a struct ``sampling``: n_grams, log_weight, key and kept.

    ``labels`` holds the id and quality (1: good). The good model is fitted on at most
    LABELLED labelled rows, those with the smallest hashes; all counts of the other model
    cover every document. The k documents with the largest keys are kept, k being
    ``share`` (the share of good ones among these labels if none is given) of the rows
    with text; rows that tie with the last of them are kept too. Null and empty texts
    have no weight and are not kept. Null ids match no label; an id labelled twice is
    good if one label says so. Without labels all weights are 0 and every text is kept.
    The noise depends on id and text only, so copies under other ids have noise of their
    own and a rerun keeps the same rows. Every column of ``docs`` is returned, whatever
    its name; a column named ``sampling`` is replaced. No rows give no rows.
    """
    spark = docs.sparkSession
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
             .groupBy("doc_id").agg((F.max("quality") == 1).alias("good"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED))
    n, good = known.agg(F.count(F.lit(1)), F.count_if("good")).first()
    if share is None:
        share = good / n if n else 1.0
    row = docs.drop("sampling")
    marked = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).join(
        F.broadcast(known.withColumnRenamed("doc_id", "id")), "id", "left").select("text", "good")
    ratios = log_ratios(gram_counts(marked))
    stored = scratch_dir(spark, "sampling")
    draw = (F.xxhash64(F.lit(SEED), F.col(id_column), F.col(text_column)) / F.lit(2.0 ** 64)) + F.lit(0.5)
    noise = -F.log(-F.log(F.least(F.greatest(draw, F.lit(1e-15)), F.lit(1 - 1e-15))))
    # Keys are worked out twice, to the same numbers: once to find the least that is kept, and
    # once beside the rows. Storing the rows with them would cost their size on disk.
    own = F.lit(temperature) * F.col("noise")
    alone = weights(docs.select(F.col(text_column).alias(TEXT), noise.alias("noise")), ratios, TEXT, drop_text=True)
    alone.where("log_weight IS NOT NULL").select((F.col("log_weight") + own).alias("key")).write.parquet(stored)
    table = spark.read.parquet(stored)
    k = round(share * table.count())
    least = kth_largest(table, "key", k) if k else float("inf")
    packed = row.select(  # the text travels once, inside its row
        F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in row.columns]).alias("row"), noise.alias("noise"))
    found = weights(packed, ratios, text_column, "row").withColumn("key", F.col("log_weight") + own)
    kept = F.coalesce(F.col("key") >= F.lit(least), F.lit(False))
    return found.select("row.*", F.struct("n_grams", "log_weight", "key", kept.alias("kept")).alias("sampling"))
