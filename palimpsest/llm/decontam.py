"""Benchmark decontamination by SimHash of item-sized windows.

Windows. A window of a document has as many words as the items it is held
against. Which of them get a fingerprint is bounded without loss: a window
that reaches the least similarity holds, in whatever order, so many places with
a shingle of one item; so only windows are made that hold as many places with a
shingle of any item of that length. The shingles of all items go out as two
bitmaps of a fixed greatest size (``SEED_BITS``): the fuller they are, the more
windows are tried.

Lookup. The 64-bit SimHash of a window and those of the items of its length are
cut into five blocks of 13 bits; of two fingerprints that differ in at most
``RADIUS`` bits one block differs in at most ``RADIUS // 5``. So each item is
entered under all values that near to its blocks, and a window asks for its own
five: a join of both sides by length, block and value, in which no side is sent
whole to anyone. All fingerprints within the radius are found.

Verification. What is found is held against the item by the weighted similarity
of word shingles, exactly.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bitmap import marked, maybe
from .bpe import slices
from .simhash import simhash
from .storage import fresh, importable, materialize, small_batches

SHINGLE, SIMILARITY, RADIUS = 5, 0.8, 24
BLOCKS, BITS = 5, 13
#: Each bitmap of shingles has at most 2 ** SEED_BITS bits (16 MB), and 64 bits a shingle below that.
SEED_BITS, PAGE = 27, 32768

_DROP = b"".join(bytes([c]) for c in range(33, 127) if not chr(c).isalnum())
#: Starts of windows that are fingerprinted at once.
_RUN = 8192


def normal_words(text: str | None) -> list[bytes]:
    """Words in lower case without ASCII punctuation; null has none."""
    return (text or "").lower().encode().translate(None, _DROP).split()


def shingles(words: list[bytes]) -> list[bytes]:
    """Shingles of five words; fewer words are one shingle, no words none."""
    if len(words) < SHINGLE:
        return [b" ".join(words)] if words else []
    return [b" ".join(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)]


def _hash64(shingle: bytes) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(shingle, 42)


def fingerprint(words: list[bytes]) -> int:
    return simhash(np.array([_hash64(s) for s in shingles(words)], np.uint64))


def similarity(window: list[bytes], item: list[bytes]) -> float:
    """Share of the item's shingles, each weighted by how often it occurs there, that the window holds too."""
    bag, got = Counter(shingles(item)), Counter(shingles(window))
    return sum(min(n, got[s]) for s, n in bag.items()) / sum(bag.values()) if bag else 0.0


def places(words: int, least: float) -> int:
    """Places with a shingle of an item of so many words that a window similar to it has at least."""
    return max(1, math.ceil(least * max(1, words - SHINGLE + 1) - 1e-9))


# seeds


def _word_hashes(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh64_intdigest

    return np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))


def _runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words; used to find windows only."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:n].copy()
    for i in range(1, size):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out ^= hashes[i : n + i]
    return out


def _slots(runs: np.ndarray, salt: int, bits: int) -> np.ndarray:
    """Bits of the runs in a bitmap; the salt is their size, or the length of their item."""
    mixed = (runs ^ np.uint64(salt * 0x9E3779B9)) * np.uint64(0xFF51AFD7ED558CCD)
    return (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53) >> np.uint64(64 - bits)


class Seeds(NamedTuple):
    """The lengths of the items, and bitmaps of their shingles: by size alone, and by length."""

    lengths: tuple[int, ...]
    bits: int
    any: np.ndarray
    of_length: np.ndarray

    @staticmethod
    def held(bitmap: np.ndarray, slots: np.ndarray) -> np.ndarray:
        return np.flatnonzero((bitmap[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8)) & 1)


def items_of(benchmark: DataFrame, item_col: str, item_text: str) -> DataFrame:
    """``(item_no, item_id, words, n, fp)`` of each different item with words, ids null or not; ``item_no`` is the row's own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [(i, w) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) if (w := normal_words(t))]
            fps = np.array([fingerprint(w) for _, w in got], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in got], pa.int64()), pa.array([b" ".join(w) for _, w in got], pa.binary()), pa.array([len(w) for _, w in got], pa.int32()), pa.array(fps)], names=["item_id", "words", "n", "fp"])

    rows = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text")).distinct()
    made = rows.mapInArrow(run, "item_id long, words binary, n int, fp long").distinct()
    return materialize(made.select(F.monotonically_increasing_id().alias("item_no"), "item_id", "words", "n", "fp"), "items")


def seeds_of(items: DataFrame) -> Seeds:
    """Made by the executors; pages of bitmaps of the bounded size, and the different lengths, come to the driver."""
    lengths = tuple(sorted(r[0] for r in items.select("n").distinct().collect()))
    count = items.agg(F.sum(F.greatest(F.col("n") - SHINGLE + 1, F.lit(1)))).first()[0] or 0
    bits = min(SEED_BITS, max(15, (64 * count).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for words in (w.split(b" ") for w in b.column(0).to_pylist()):
                size = min(len(words), SHINGLE)
                runs = _runs(_word_hashes(words), size)
                at = np.concatenate([_slots(runs, size, bits), _slots(runs, len(words), bits) + np.uint64(1 << bits)]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at)], names=["slot"])

    slots = items.select("words").mapInArrow(run, "slot long")
    pages = slots.groupBy(F.floor(F.col("slot") / PAGE).alias("page")).agg(F.bitmap_construct_agg(F.col("slot") % PAGE).alias("bitmap")).collect()
    both = np.zeros(2 << bits >> 3, np.uint8)
    for r in pages:
        both[r.page * (PAGE >> 3) : (r.page + 1) * (PAGE >> 3)] = np.frombuffer(r.bitmap, np.uint8)[: PAGE >> 3]
    return Seeds(lengths, bits, both[: 1 << bits >> 3].copy(), both[1 << bits >> 3 :].copy())


# windows


def _ranges(starts: np.ndarray) -> list[np.ndarray]:
    """Sorted starts in runs of neighbours, none longer than ``_RUN``."""
    cuts = np.flatnonzero(np.diff(starts) != 1) + 1
    return [part[i : i + _RUN] for part in np.split(starts, cuts) for i in range(0, len(part), _RUN)]


def window_fingerprints(hashes: np.ndarray, count: int) -> np.ndarray:
    """SimHash of each run of ``count`` neighbours in ``hashes``, by sums of bits that roll from one to the next."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.zeros((len(hashes) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    set_ = (sums[count:] - sums[:-count]) * 2 > count
    return np.packbits(set_, axis=1, bitorder="little").view("<u8").reshape(-1)


def windows(words: list[bytes], seeds: Seeds, least: float = SIMILARITY) -> Iterator[tuple[int, int, int, bytes]]:
    """``(start, length, fingerprint, words)`` of the windows that may be similar to an item of that length; a text shorter than that is one window."""
    hashes, by_size = _word_hashes(words), {}
    for size in sorted({min(n, SHINGLE) for n in seeds.lengths}):
        runs = _runs(hashes, size)
        at = Seeds.held(seeds.any, _slots(runs, size, seeds.bits))
        if len(at):
            by_size[size] = at, runs[at]
    made: dict[int, int] = {}
    for n in seeds.lengths:
        size, need = min(n, SHINGLE), places(n, least)
        at, runs = by_size.get(size, ((), ()))
        if len(at) < need:
            continue
        at = at[Seeds.held(seeds.of_length, _slots(runs, n, seeds.bits))]
        if len(at) < need:
            continue
        length = min(n, len(words))
        starts = np.arange(max(0, at[0] - length + size), min(at[-1], len(words) - length) + 1)
        starts = starts[np.searchsorted(at, starts + length - size, "right") - np.searchsorted(at, starts, "left") >= need]
        count = length - size + 1
        for part in _ranges(starts) if len(starts) else ():
            first, last = int(part[0]), int(part[-1]) + count
            for p in range(first, last):
                if (p, size) not in made:
                    made[p, size] = _hash64(b" ".join(words[p : p + size]))
            fps = window_fingerprints(np.array([made[p, size] for p in range(first, last)], np.uint64), count)
            for start, fp in zip(part.tolist(), fps.tolist(), strict=True):
                yield start, n, fp, b" ".join(words[start : start + length])


def windows_of(rows: DataFrame, seeds: Seeds, least: float) -> DataFrame:
    """``(key, first_word, n, window, fp, words)`` of the windows of rows ``(key, text)``; ``window`` is a hash of its length and words."""
    sent = rows.sparkSession.sparkContext.broadcast(seeds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for b in slices(batches):
            out = [(key, start, n, xxh3_128_digest(w, n), fp, w) for key, t in zip(b.column(0), b.column(1), strict=True) for start, n, fp, w in windows(normal_words(t.as_py()), sent.value, least)]
            key, start, n, digest, fp, w = zip(*out, strict=True) if out else [()] * 6
            cols = [pa.array([k.as_py() for k in key], pa.binary()), pa.array(start, pa.int64()), pa.array(n, pa.int32()), pa.array(digest, pa.binary()), pa.array(np.array(fp, np.uint64).view(np.int64)), pa.array(w, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["key", "first_word", "n", "window", "fp", "words"])

    return rows.mapInArrow(run, "key binary, first_word long, n int, window binary, fp long, words binary")


# lookup


def masks(radius: int) -> list[int]:
    """The differences that one of the blocks has at least: up to ``radius // BLOCKS`` bits."""
    return [sum(1 << b for b in bits) for k in range(min(BITS, radius // BLOCKS) + 1) for bits in combinations(range(BITS), k)]


def _block(fp: str, b: Column | int) -> Column:
    shift = b * BITS if isinstance(b, int) else (b * BITS).cast("int")
    return F.call_function("shiftrightunsigned", F.col(fp), F.lit(shift) if isinstance(b, int) else shift).bitwiseAND(F.lit((1 << BITS) - 1).cast("long"))


def near(asked: DataFrame, items: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(window, item_no, differing_bits)``: all pairs of ``asked`` (``window, n, fp``) and ``items`` of one length whose fingerprints differ in at most ``radius`` bits, each once."""
    every = F.sequence(F.lit(0), F.lit(BLOCKS - 1))
    values = F.split(F.lit(",".join(map(str, masks(radius)))), ",").cast("array<long>")
    slot = lambda value: (F.col("b").cast("long") * (1 << BITS) + value).alias("slot")
    left = asked.select("window", "n", "fp", F.explode(every).alias("b")).select("window", "n", "fp", "b", slot(_block("fp", F.col("b"))))
    right = items.select("item_no", "n", F.col("fp").alias("item_fp"), F.explode(every).alias("b")).select("item_no", "n", "item_fp", "b", F.explode(values).alias("mask")).select("item_no", "n", "item_fp", slot(_block("item_fp", F.col("b")).bitwiseXOR(F.col("mask"))))
    # no estimate of sizes knows how far the explode goes: neither side may be broadcast
    met = left.join(right.hint("merge"), ["n", "slot"]).withColumn("differ", F.col("fp").bitwiseXOR(F.col("item_fp"))).withColumn("differing_bits", F.bit_count("differ"))
    # a pair that meets in several blocks counts in the first of them
    first = F.lit(True)
    for b in range(BLOCKS - 1):
        first = first & ((F.col("b") <= b) | (F.bit_count(_block("differ", b)) > radius // BLOCKS))
    return met.where((F.col("differing_bits") <= radius) & first).select("window", "item_no", "differing_bits")


def _verified(pairs: DataFrame, least: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [similarity(w.split(b" "), i.split(b" ")) for w, i in zip(b.column(4).to_pylist(), b.column(5).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(found, pa.float64())], names=["window", "item_no", "item_id", "differing_bits", "similarity"])

    out = pairs.select("window", "item_no", "item_id", "differing_bits", "words", "item_words").mapInArrow(run, "window binary, item_no long, item_id long, differing_bits int, similarity double")
    return out.where(F.col("similarity") >= least)


def _text_key(text_col: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))


def search(texts: DataFrame, benchmark: DataFrame, item_col: str, item_text: str, radius: int, least: float) -> DataFrame:
    """``(key, item_id, similarity, first_word, differing_bits)`` of rows ``(key, text)`` for each key and item; of windows of one similarity the first."""
    importable(texts.sparkSession)
    small_batches(texts.sparkSession)
    items = items_of(benchmark, item_col, item_text)
    made = materialize(windows_of(texts, seeds_of(items), least), "windows")
    # a passage that many documents share is looked up once
    asked = materialize(made.select("window", "n", "fp", "words").dropDuplicates(["window"]), "distinct_windows")
    words = items.select("item_no", "item_id", F.col("words").alias("item_words"))
    pairs = near(asked, items, radius).join(words, "item_no").join(asked.select("window", "words"), "window")
    verified = materialize(_verified(pairs, least), "verified_windows")
    met = made.select("key", "first_word", "window").join(verified, "window")
    # items without an id stay apart; of items that share one the most similar counts
    apart = F.when(F.col("item_id").isNull(), F.col("item_no")).otherwise(F.lit(0).cast("long"))
    best = F.max(F.struct("similarity", (-F.col("first_word")).alias("before"), (-F.col("differing_bits")).alias("alike"))).alias("best")
    found = met.groupBy("key", "item_id", apart.alias("apart")).agg(best)
    return materialize(found.select("key", "item_id", "best.similarity", (-F.col("best.before")).alias("first_word"), (-F.col("best.alike")).alias("differing_bits")), "contaminated")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", radius: int = RADIUS, least: float = SIMILARITY) -> DataFrame:
    """``(doc_id, item_id, similarity, first_word, differing_bits)`` for each document and item with a window of similarity ``least`` or more within ``radius`` bits.

    Null or empty texts and items match nothing; an item of fewer than five
    words is one shingle. Repeated rows repeat theirs, and rows without an id
    have a null ``doc_id``. Of items that share an id the most similar counts;
    each different text with a null item id counts for itself and is reported
    with a null ``item_id``. Very long texts are searched whole.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("key", _text_key("text"))
    found = search(rows.select("key", "text"), benchmark, item_col, item_text, radius, least)
    held = maybe(rows.select("doc_id", "key"), found)
    return held.join(found, "key").select("doc_id", "item_id", "similarity", "first_word", "differing_bits")


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", radius: int = RADIUS, least: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` (all columns) whose text holds no benchmark item, be its id null or not; only rows that may hold one are shuffled."""
    key, of = fresh(docs.columns, "key_", "of_key")
    own = docs.withColumn(key, _text_key(text_col))
    rows = own.select(F.col(key).alias("key"), F.col(text_col).cast("string").alias("text"))
    found = search(rows, benchmark, item_col, item_text, radius, least).select(F.col("key").alias(of)).distinct()
    split, there = marked(own, found, F.col(key), F.col(of))
    stay = split.where(F.col(there)).join(found, F.col(key) == F.col(of), "left_anti")
    return split.where(~F.col(there)).select(*docs.columns).union(stay.select(*docs.columns))
