"""Quality rules: counts of words, repeats and signs, and the fertility of public tokenizers.

Fertility says how well known vocabularies cover a text: characters per token, share of
tokens that fall back to bytes, and entropy of the tokens. Each is held against a band
of the texts of the same language and about the same length, because entropy falls with
length and the means of short texts vary more. The bands come from all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from placewell.llm.ragged import Texts, WordStore, blank_words, distinct, pretokens, slices, sums
from placewell.llm.token_counts import json_store
from placewell.llm.workers import lean, with_field
from placewell.session import scratch_dir

LEAST_WORDS = 20
MOST_REPEATED = 30  # per cent of words
WINDOW = 8
REACH = 2.25  # bands reach so many interquartile ranges beyond the quartiles
LEAST_CLASS = 100  # texts of a length class; with fewer the language's own band holds
CLASSES = (5, 24)  # binary logarithms of the numbers of tokens of the first and the last class
STEADY = 150  # tokens; a language's band widens for texts with fewer
BROADCAST_BANDS = 10_000

TEXT = "_text"  # a struct's text, beside it inside a task
MEASURES = ("m_chars_per_piece", "m_chars_per_unit", "m_byte_share", "m_entropy")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS = b"#*$%&|<>"
IS_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS, np.uint8))


def repeated_words(codes: np.ndarray, first: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Words of each text that lie in a window found twice or more in that text."""
    n = len(codes)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    names, span = codes.astype(np.int64), 1
    while span < window:  # names of stretches twice as long, from pairs of names
        count = int(names.max()) + 1 if len(names) else 1
        names = names[:-span] * count + names[span:] if len(names) > span else names[:0]
        names, span = ranks(names), span * 2
    starts = np.flatnonzero(owner[:n - window + 1] == owner[window - 1:]) if n >= window else np.zeros(0, np.int64)
    keys = ranks(owner[starts] * (int(names.max()) + 1 if len(names) else 1) + names[starts])
    twice = np.bincount(keys)[keys] > 1 if len(keys) else np.zeros(0, bool)
    change = np.zeros(n + window + 1, np.int64)
    np.add.at(change, starts[twice], 1)
    np.add.at(change, starts[twice] + window, -1)
    return sums((np.cumsum(change)[:n] > 0).astype(np.int64), first)


def ranks(keys: np.ndarray) -> np.ndarray:
    """Small numbers, equal for equal keys and no others."""
    order = np.argsort(keys)  # any order of equal keys will do
    ordered = keys[order]
    fresh = np.zeros(len(keys), np.int64)
    fresh[1:] = ordered[1:] != ordered[:-1]
    out = np.empty(len(keys), np.int64)
    out[order] = np.cumsum(fresh)
    return out


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.split()]
    return len(lines) - len(set(lines))


def entropies(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Entropy in bits of the tokens of each text, as a share of the largest possible."""
    n = np.diff(bounds)
    owner = np.repeat(np.arange(len(n)), n)
    keys = ranks(owner * (int(tokens.max()) + 1) + tokens) if len(tokens) else tokens
    counts = np.bincount(keys) if len(keys) else np.zeros(0, np.int64)
    text = np.zeros(len(counts), np.int64)
    text[keys] = owner
    spread = np.bincount(text, counts * np.log2(np.maximum(counts, 1)), len(n))
    with np.errstate(divide="ignore", invalid="ignore"):
        found = (np.log2(n) - spread / n) / np.log2(n)
    return np.where(n > 1, found, np.nan)


@lru_cache(maxsize=1)
def piece_store(path: str) -> tuple[WordStore, np.ndarray]:
    """Pieces of the words that this process has met, and which pieces stand for bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def encode(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = model.encode([w.decode("utf-8", "replace") for w in words], num_threads=1)
        counts = np.array([len(x) for x in found], np.int64)
        return counts, np.fromiter(chain.from_iterable(found), np.int64, int(counts.sum()))

    return WordStore(encode), np.array([model.is_byte(i) for i in range(model.get_piece_size())])


def measured(
    docs: DataFrame, pieces: str, units: str, text_column: str = "text", struct: str | None = None
) -> DataFrame:
    """``docs`` with the counts and measures of each row's text as a struct ``quality``.

    ``pieces``: a vocabulary with byte fallback, applied to words; ``units``: a byte-level
    one, applied to the whole text. ``struct``: the column that holds ``text_column``, if
    that is no column itself.
    """
    name = TEXT if struct else text_column

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, byte = piece_store(pieces)
        unit_store, special = json_store(units)
        if struct:
            batches = with_field(batches, struct, text_column, TEXT)
        for part in slices(batches, name):
            texts = Texts(part.column(name))
            data, ends = texts.data, texts.offsets
            offsets, first = blank_words(texts)
            words, codes = distinct(data, offsets)
            codes = codes[::2]
            used, codes = np.unique(codes, return_inverse=True)
            places = store.look_up(words.take(pa.array(used)))[codes]
            head = (data & 0xC0) != 0x80
            blank = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
            chars = sums((head & ~blank).astype(np.int64), ends)
            symbols = sums(IS_SYMBOL[data].astype(np.int64), ends)
            raw = data.tobytes()
            lines = [repeated_lines(raw[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            tokens = store.expand(places)
            bounds = np.r_[0, np.cumsum(sums(store.counts[places], first))]
            unit_offsets, unit_first = pretokens(texts, next(iter(special), None))
            unit_words, unit_codes = distinct(data, unit_offsets)
            unit_places = unit_store.look_up(unit_words)
            n_units = sums(unit_store.counts[unit_places[unit_codes]], unit_first)
            n_pieces = np.diff(bounds)
            with np.errstate(divide="ignore", invalid="ignore"):
                found = {
                    "n_words": np.diff(first), "word_chars": chars, "n_symbols": symbols,
                    "n_dup_lines": np.array(lines, np.int64),
                    "n_repeat_words": repeated_words(codes, first), "n_pieces": n_pieces,
                    "m_chars_per_piece": chars / n_pieces,
                    "m_chars_per_unit": sums(head.astype(np.int64), ends) / n_units,
                    "m_byte_share": sums(byte[tokens].astype(np.int64), bounds) / n_pieces,
                    "m_entropy": entropies(tokens, bounds),
                }
            columns = [pa.array(v, mask=~np.isfinite(v)) if v.dtype.kind == "f" else pa.array(v, pa.int64())
                       for v in found.values()]
            if struct:
                part = part.drop_columns([TEXT])
            yield part.append_column("quality", pa.StructArray.from_arrays(columns, list(found)))
        # Words met so far are not kept for the next task: other stages share this worker.
        store.clear()
        unit_store.clear()

    kinds = ", ".join([f"{c}: bigint" for c in (*COUNTS, "n_pieces")] + [f"{c}: double" for c in MEASURES])
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(lean(measure), f"{fields}, quality struct<{kinds}>")


def base_failed(q: str = "quality.") -> F.Column:
    n, repeated = F.col(f"{q}n_words"), F.col(f"{q}n_repeat_words")
    return (n < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * n)


def length_class(q: str = "quality.") -> F.Column:
    """About the binary logarithm of the number of tokens."""
    tokens = F.greatest(F.col(f"{q}n_pieces"), F.lit(1)).cast("double")
    return F.least(F.greatest(F.floor(F.log2(tokens)), F.lit(CLASSES[0])), F.lit(CLASSES[1])).cast("int")


def bands(table: DataFrame) -> DataFrame:
    """lang, size, n and per measure its quartiles over the n documents that pass the base rules.

    ``size`` is the length class, or null for all documents of the language.
    """
    quartiles = [F.percentile_approx(f"quality.{m}", F.array(F.lit(0.25), F.lit(0.75)), 10_000).alias(m)
                 for m in MEASURES]
    passed = table.where(~base_failed())
    by_class = passed.groupBy("lang", length_class().alias("size")).agg(F.count(F.lit(1)).alias("n"), *quartiles)
    by_lang = passed.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), *quartiles).withColumn(
        "size", F.lit(None).cast("int"))
    return by_class.unionByName(by_lang)


def in_bands(reach: float = REACH) -> F.Column:
    """Whether all measures of a row lie in its band: of its class, ``near``, or of its language, ``all``.

    A measure that a text has not is in.
    """
    small = F.coalesce(F.col("near.n") < LEAST_CLASS, F.lit(True))
    few = F.sqrt(1 + F.lit(float(STEADY)) / F.greatest(F.col("quality.n_pieces"), F.lit(1)))
    wide = F.lit(reach) * F.when(small, few).otherwise(F.lit(1.0))
    ok = F.lit(True)
    for m in MEASURES:
        low, high = (F.when(small, F.col(f"all.{m}")[k]).otherwise(F.col(f"near.{m}")[k]) for k in (0, 1))
        value = F.col(f"quality.{m}")
        # A band is never narrower than a five-hundredth of its middle, or than a share of 0.01.
        span = F.greatest(high - low, (high + low) / 1000, F.lit(0.01 if m == "m_byte_share" else 0.0))
        fits = (value >= low - wide * span) & (value <= high + wide * span)
        if m == "m_byte_share":
            fits = value <= high + wide * span
        ok &= F.coalesce(fits, F.lit(True))
    return ok


def judge(
    docs: DataFrame, pieces: str, units: str, text_column: str = "text", lang_column: str = "lang",
    reach: float = REACH,
) -> DataFrame:
    """``docs`` with ``quality`` (counts and measures), ``base_failed`` and ``kept`` in one struct ``rules``.

    A row is kept if it passes the base rules and its measures lie within the bands of its
    language and length class, or of its language, if the class has few texts. Null text has no words and fails; null language is a language of its own;
    repeated rows are judged alike. Every column of ``docs`` is returned, whatever its
    name; a column named ``rules`` is replaced. No rows give no rows.
    """
    spark = docs.sparkSession
    stored = scratch_dir(spark, "rules")
    row = docs.drop("rules")
    packed = row.select(
        F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in row.columns]).alias("row"),
        F.coalesce(F.col(lang_column), F.lit("")).alias("lang"))
    measured(packed, pieces, units, text_column, "row").write.option("compression", "zstd").parquet(stored)  # the text travels once
    table = spark.read.parquet(stored)
    found = bands(table)
    near = found.where("size IS NOT NULL").select("lang", "size", F.struct("n", *MEASURES).alias("near"))
    whole = found.where("size IS NULL").select("lang", F.struct("n", *MEASURES).alias("all"))
    if near.count() <= BROADCAST_BANDS:
        near, whole = F.broadcast(near), F.broadcast(whole)
    table = table.withColumn("size", length_class()).join(near, ["lang", "size"], "left").join(whole, "lang", "left")
    failed = F.coalesce(base_failed(), F.lit(True))
    return table.select(
        "row.*", F.struct("quality", failed.alias("base_failed"),
                          (~failed & in_bands(reach)).alias("kept")).alias("rules"))
