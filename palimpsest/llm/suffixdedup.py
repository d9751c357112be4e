"""Removal of long repeated byte strings by run-length indexes of phrases.

Every window of ``LENGTH`` bytes picks the least k-gram in it, its anchor, by a
hash; neighbouring windows with one anchor form a phrase, and each has a core,
the bytes that all windows at these places round the anchor have. Equal windows
have the same core, so windows are compared only among phrases of one core, and
phrases whose core occurs once are left alone. Phrases are counted as distinct
strings, as in a prefix-free parse: a phrase that occurs again is a run of equal
suffixes, and where it is the only one of its core that is all there is to know.
The other phrases, of whole cores, go into run-length indexes: the Burrows-
Wheeler transform of their text as runs, with the suffixes at both ends of each
run. Where a suffix stands inside a run, its match with the neighbour is one
byte shorter than that of the suffix a byte before, so matching statistics are
streamed from the samples at the run ends alone; windows whose match reaches
``LENGTH`` are repeated.

A core with more than ``CROWD`` different phrases (a passage that many texts
share in different surroundings) is compared window by window, by digests of
128 bits that are counted with partial sums, so no group is whole in one task.
Equal phrases and windows of such cores are known by 128-bit digests.

Awkward rows: a null text is empty; texts shorter than ``LENGTH`` bytes lose
nothing; equal texts, also of rows with equal or null ids, are occurrences of
their own; added columns whose names are taken get an underscore.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bitmap import marked, maybe
from .storage import fresh, materialize, small_batches

LENGTH = 200
#: Bytes of an anchor, and places of it in a window that share a core.
GRAM, REACH = 32, 85
#: Bytes hashed at once; longer texts are cut, with an overlap. Positions fit the low 24 bits of a packed hash.
CHUNK = 1 << 20
#: Different phrases of one core up to which an index holds them all, and bytes after which an index is closed.
CROWD, INDEX = 2048, 1 << 19

_BASE = 0x9E3779B97F4A7C15 | 1
_POSITION = np.uint64((1 << 24) - 1)


@lru_cache(2)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@lru_cache(1)
def _byte_values() -> np.ndarray:
    return np.random.default_rng(7).integers(1, 1 << 63, 256, np.uint64)


class _Hashes:
    """Hashes of all substrings of a buffer, by differences of prefix sums; numbers wrap at 2^64."""

    def __init__(self, buffer: np.ndarray) -> None:
        n = 1 << len(buffer).bit_length()
        up, self.down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
        self.sums = np.zeros(len(buffer) + 1, np.uint64)
        np.cumsum(_byte_values()[buffer] * up[: len(buffer)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        x = (self.sums[end] - self.sums[start]) * self.down[start]
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(29))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n, have = len(x) - width + 1, 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[:n], x[width - have : width - have + n])


def _phrases(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """``(core, segment, first, last)``: hash of the core, the segment and the first and last window of each phrase; places in the buffer."""
    valid = np.zeros(len(buffer) + 1, np.int32)
    long = ends - starts >= length
    np.add.at(valid, starts[long], 1)
    np.add.at(valid, ends[long] - length + 1, -1)
    windows = np.flatnonzero(np.cumsum(valid[:-1]))
    if not len(windows):
        return (np.empty(0, np.int64),) * 4
    hashes = _Hashes(buffer)
    at = np.arange(len(buffer) - GRAM + 1)
    packed = (hashes.of(at, at + GRAM) & ~_POSITION) | at.astype(np.uint64)
    anchor = (_sliding_min(packed, length - GRAM + 1)[windows] & _POSITION).astype(np.int64)
    place = (anchor - windows) // REACH
    cut = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(place) != 0) | (np.diff(windows) != 1)) + 1
    first = np.concatenate([[0], cut])
    last = np.concatenate([cut, [len(windows)]]) - 1
    anchor, place = anchor[first], place[first]
    low, high = place * REACH, np.minimum(place * REACH + REACH - 1, length - GRAM)
    core = hashes.of(anchor - low, anchor - high + length) ^ place.astype(np.uint64)
    first, last = windows[first], windows[last]
    return core.view(np.int64), np.searchsorted(starts, first, "right") - 1, first, last


def _buffers(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
    """Buffers of about ``CHUNK`` bytes with keys, starts, ends and offsets of their segments; a longer text is cut so that each window is in one."""
    keys, parts, offsets, held = [], [], [], 0

    def full() -> tuple:
        sizes = np.array([len(p) for p in parts])
        ends = np.cumsum(sizes)
        return np.frombuffer(b"".join(parts), np.uint8), list(keys), ends - sizes, ends, np.array(offsets)

    for b in batches:
        for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            for start in range(0, len(text) - length + 1, CHUNK):
                part = text[start : start + CHUNK + length - 1]
                keys.append(key)
                parts.append(part)
                offsets.append(start)
                held += len(part)
                if held >= CHUNK:
                    yield full()
                    keys, parts, offsets, held = [], [], [], 0
    if parts:
        yield full()


def _texts(docs: DataFrame, text: str) -> DataFrame:
    small_batches(docs.sparkSession)
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return docs.select(F.unhex(F.md5(raw)).alias("doc"), raw.alias("raw")).where(F.octet_length("raw") >= LENGTH)


def _cores(rows: DataFrame, length: int) -> DataFrame:
    """``(core, n)``, counted within a buffer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for buffer, _, starts, ends, _ in _buffers(batches, length):
            core, n = np.unique(_phrases(buffer, starts, ends, length)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(core), pa.array(n)], names=["core", "n"])

    return rows.mapInArrow(run, "core long, n long")


def _occurrences(rows: DataFrame, length: int, with_text: bool = False) -> DataFrame:
    """``(core, phrase, doc, first, last)`` of every phrase, phrase being a digest, first and last its windows; ``raw``, the bytes, if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for buffer, keys, starts, ends, offsets in _buffers(batches, length):
            core, segment, first, last = _phrases(buffer, starts, ends, length)
            whole = buffer.tobytes()
            raw = [whole[a : b + length] for a, b in zip(first.tolist(), last.tolist(), strict=True)]
            shift = offsets[segment] - starts[segment] if len(segment) else segment
            columns = {"core": pa.array(core), "phrase": pa.array([xxhash.xxh3_128_digest(x) for x in raw], pa.binary()), "doc": pa.array(keys, pa.binary()).take(pa.array(segment)), "first": pa.array(first + shift), "last": pa.array(last + shift)}
            if with_text:
                columns["raw"] = pa.array(raw, pa.binary())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return rows.mapInArrow(run, "core long, phrase binary, doc binary, first long, last long" + ", raw binary" * with_text)


# the index of one bucket of phrases


def suffix_array(symbols: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Suffixes in order by doubling; a suffix ends at its phrase's separator, of equal ones the first comes first. ``rest``: symbols up to the separator."""
    n = len(symbols)
    padded = np.concatenate([symbols.astype(np.int64) + 1, np.zeros(8, np.int64)])
    key = np.zeros(n, np.int64)
    for t in range(7):
        key = (key << 9) | np.where(t < rest, padded[t : t + n], 0)
    have = 7
    while True:
        order = np.argsort(key)
        ordered = key[order]
        new = np.concatenate([[False], ordered[1:] != ordered[:-1]])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        if have > rest.max() or new[1:].all():
            return np.argsort(rank * n + np.arange(n))
        behind = np.concatenate([rank, np.zeros(have, np.int64)])[have : have + n] + 1
        key = rank * (n + 1) + np.where(have < rest, behind, 0)
        have *= 2


def common_prefix(words: np.ndarray, rest: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal bytes from a and from b on, eight at a time; neither passes its separator."""
    out = np.minimum(rest[a], rest[b])
    open_ = np.flatnonzero(out > 0)
    done = 0
    while len(open_):
        odd = words[a[open_] + done] ^ words[b[open_] + done]
        differ = odd != 0
        low = odd[differ]
        first = (np.frexp((low & (~low + np.uint64(1))).astype(float))[1] - 1) >> 3
        hit = open_[differ]
        out[hit] = np.minimum(out[hit], done + first)
        done += 8
        open_ = open_[~differ]
        open_ = open_[out[open_] > done]
    return out


def run_ends(symbols: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The transform as runs: their symbols, lengths, and the suffixes in their first and last rows. Separators differ, so each is a run."""
    bwt = np.where(order > 0, symbols[order - 1], -1)
    new = np.concatenate([[True], (bwt[1:] != bwt[:-1]) | (bwt[1:] < 0)])
    start = np.flatnonzero(new)
    end = np.concatenate([start[1:], [len(order)]]) - 1
    return bwt[start], end - start + 1, order[start], order[end]


def longest_matches(phrases: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of the phrases (each followed by a separator) the longest match that starts there with another place, and the phrases' starts."""
    sizes = np.array([len(p) for p in phrases])
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    raw = np.frombuffer(b"\0".join(phrases) + b"\0" * 9, np.uint8)
    n = int(sizes.sum()) + len(phrases)
    owner = np.repeat(np.arange(len(phrases)), sizes + 1)
    rest = (starts + sizes)[owner] - np.arange(n)
    symbols = np.where(rest > 0, raw[:n].astype(np.int64), -1)
    _, _, first, last = run_ends(symbols, suffix_array(symbols, rest))
    words = np.lib.stride_tricks.as_strided(raw, (n + 1, 8), (1, 1)).copy().view(np.uint64).ravel()
    edge = common_prefix(words, rest, first[1:], last[:-1])
    best = np.where(counts[owner] > 1, rest, 0)
    for samples, values in ((first, np.concatenate([[0], edge])), (last, np.concatenate([edge, [0]]))):
        by = np.argsort(samples)
        samples, values = samples[by], values[by]
        # inside a run a match is one shorter than a byte before
        latest = np.searchsorted(samples, np.arange(n), "right") - 1
        best = np.maximum(best, np.where(latest >= 0, values[latest] - (np.arange(n) - samples[latest]), 0))
    return best, starts


def _repeated(rows: DataFrame, length: int) -> DataFrame:
    """``(core, phrase, start, end)``: runs of repeated windows in phrases ``(core, phrase, n, raw)``, by places in the phrase; all phrases of a core come to one task, in a row."""

    def solve(held: list[tuple]) -> pa.RecordBatch:
        best, starts = longest_matches([h[3] for h in held], np.array([h[2] for h in held]))
        hit = np.concatenate([[False], best >= length, [False]])
        start, end = np.flatnonzero(hit[1:] & ~hit[:-1]), np.flatnonzero(hit[:-1] & ~hit[1:])
        owner = np.searchsorted(starts, start, "right") - 1
        own = starts[owner]
        at = pa.array(owner)
        return pa.RecordBatch.from_arrays([pa.array([h[0] for h in held], pa.int64()).take(at), pa.array([h[1] for h in held], pa.binary()).take(at), pa.array(start - own, pa.int64()), pa.array(end - own, pa.int64())], names=["core", "phrase", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if size >= INDEX and row[0] != held[-1][0]:
                    yield solve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield solve(held)

    ordered = rows.repartition("core").sortWithinPartitions("core").select("core", "phrase", "n", "raw")
    return ordered.mapInArrow(run, "core long, phrase binary, start long, end long")


def _windows(rows: DataFrame, length: int) -> DataFrame:
    """``(window, doc, at)``: digest and place of each window of phrases ``(doc, first, raw)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start in range(0, b.num_rows, 500):
                part = b.slice(start, 500)
                owner, at, digest = [], [], []
                for k, (first, raw) in enumerate(zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True)):
                    n = len(raw) - length + 1
                    owner += [k] * n
                    at += range(first, first + n)
                    digest += [xxhash.xxh3_128_digest(raw[s : s + length]) for s in range(n)]
                yield pa.RecordBatch.from_arrays([pa.array(digest, pa.binary()), part.column(0).take(pa.array(owner, pa.int64())), pa.array(at, pa.int64())], names=["window", "doc", "at"])

    return rows.select("doc", "first", "raw").mapInArrow(run, "window binary, doc binary, at long")


def repeated_windows(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """``(doc, start, end)``: window starts in [start, end) are repeated in the text whose MD5 is ``doc``; runs may be in several rows."""
    rows = _texts(docs, text)
    again = materialize(_cores(rows, length).groupBy("core").agg(F.sum("n").alias("n")).where("n > 1").select("core"), "cores")
    found = materialize(maybe(_occurrences(rows, length), again, F.col("core"), F.col("core")), "phrases")
    each = found.groupBy("core", "phrase").agg(F.count("*").alias("n"))
    cores = materialize(each.groupBy("core").agg(F.sum("n").alias("n"), F.count("*").alias("phrases")).where("n > 1").select("core", "phrases"), "kinds")
    placed = found.join(cores, "core")
    alone = placed.where("phrases = 1").select("doc", F.col("first").alias("start"), (F.col("last") + 1).alias("end"))
    with_text = maybe(_occurrences(rows, length, with_text=True), cores.where("phrases > 1").select("core"), F.col("core"), F.col("core"))
    texts = materialize(with_text.groupBy("core", "phrase").agg(F.count("*").alias("n"), F.first("raw").alias("raw")).join(cores, "core"), "texts")
    hits = _repeated(texts.where(F.col("phrases").between(2, CROWD)), length)
    met = placed.where(F.col("phrases").between(2, CROWD)).select("core", "phrase", "doc", "first").join(hits, ["core", "phrase"])
    out = alone.unionByName(met.select("doc", (F.col("first") + F.col("start")).alias("start"), (F.col("first") + F.col("end")).alias("end")))
    if not cores.where(F.col("phrases") > CROWD).isEmpty():
        crowded = placed.where(F.col("phrases") > CROWD).select("core", "phrase", "doc", "first").join(texts.select("core", "phrase", "raw"), ["core", "phrase"])
        windows = materialize(_windows(crowded, length), "windows")
        twice = windows.groupBy("window").agg(F.count("*").alias("n")).where("n > 1")
        out = out.unionByName(windows.join(twice, "window").select("doc", F.col("at").alias("start"), (F.col("at") + 1).alias("end")))
    return out.distinct()


def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH) -> tuple[DataFrame, str, str, str]:
    """``docs`` without the bytes of repeated strings of ``length``; also the names of the three columns added.

    These are the UTF-8 bytes that are left (a cut may fall inside a
    character, so they are binary), the number of bytes there were, and the
    removed runs as ``array<struct<start, end>>``.
    """
    kept, size, spans, doc, runs, there = fresh(docs.columns, "kept", "n_bytes", "removed", "doc_key", "runs", "has_runs")
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    keyed = docs.withColumns({kept: raw, doc: F.unhex(F.md5(raw))})
    found = materialize(repeated_windows(docs, text, length), "repeated")
    marks, there = marked(keyed, found, F.col(doc), F.col("doc"))
    span = "array<struct<start:bigint,end:bigint>>"
    by_text = found.groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias(runs)).withColumnRenamed("doc", f"{doc}_")
    shape = [*docs.columns, kept, size, spans]
    same = marks.where(~F.col(there)).select(*docs.columns, kept, F.octet_length(kept).cast("long").alias(size), F.array().cast(span).alias(spans))
    joined = marks.where(F.col(there)).drop(there).join(by_text, F.col(doc) == F.col(f"{doc}_"), "left").select(*docs.columns, kept, runs)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            left, sizes, removed = [], [], []
            for whole, own in zip(b.column(kept), b.column(runs), strict=True):
                whole = whole.as_py()
                sizes.append(len(whole))
                cover = np.zeros(len(whole) + 2, np.int32)
                if own.is_valid:
                    flat = own.values
                    np.add.at(cover, flat.field("start").to_numpy() + 1, 1)
                    np.add.at(cover, flat.field("end").to_numpy() + length, -1)
                gone = np.cumsum(cover) > 0
                edges = np.flatnonzero(np.diff(gone.astype(np.int8)))
                removed.append([{"start": int(s), "end": int(e)} for s, e in zip(edges[::2], edges[1::2], strict=True)])
                left.append(np.frombuffer(whole, np.uint8)[~gone[1:-1]].tobytes())
            keep = [c for c in b.schema.names if c not in (kept, runs)]
            shape_ = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(left, pa.binary()), pa.array(sizes, pa.int64()), pa.array(removed, shape_)], names=[*keep, kept, size, spans])

    out = joined.mapInArrow(cut, same.schema)
    return out.select(*shape).unionByName(same.select(*shape)), kept, size, spans
