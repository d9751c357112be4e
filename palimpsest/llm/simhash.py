"""SimHash near-duplicates by anchor points of a covering code.

Fingerprint: 64-bit SimHash over the XXH64 (seed 42) of word shingles.
Two fingerprints link when they differ in at most three bits. The 64 bits hold
two blocks of 31; of two linked fingerprints one block differs in at most one
bit. Each block is covered by the perfect Hamming(31, 26) code (radius 1): its
code words are the anchors. A fingerprint is at home at the anchor within
radius 1 of its block and is replicated to every anchor within radius
1 + 1 = 2; so every linked pair meets at the home of either one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bitmap import marked
from .components import connected_components
from .storage import fresh, importable, materialize

BITS, BLOCK, SHIFTS = 64, 31, (0, 33)
MAX_DISTANCE = 3
#: Fingerprints at one anchor, homes and replicas, beyond which it is split.
HOT = 4096
#: Bits outside a block, and the widths of the parts by which a hot anchor is split, and split again.
REST, WIDTHS = BITS - BLOCK, (8, 6, 4)

_LANES = np.uint64(0x0101010101010101)
_STEPS = np.arange(8, dtype=np.uint64)[:, None]
_MIX = tuple((np.uint64(a), np.uint64(b)) for a, b in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)))


def words_of(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased (bytes methods know ASCII alone)."""
    return (text or b"").lower().split()


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 with seed 42 of every shingle, repeats included; fewer words make one shingle."""
    from xxhash import xxh64_intdigest

    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= size:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    n = max(1, len(words) - size + 1)
    return np.fromiter((xxh64_intdigest(s, 42) for s in shingles), np.uint64, n)


def simhash(hashes: np.ndarray) -> int:
    """Bit i is 1 if it is set in over half of the hashes; of none, zero.

    Counts bits eight at a time: a byte lane of a 64-bit word holds up to 255.
    """
    n = len(hashes)
    if not n:
        return 0
    lanes = np.add.reduceat((hashes[None, :] >> _STEPS) & _LANES, np.arange(0, n, 255), axis=1)
    counts = np.ascontiguousarray(lanes).view(np.uint8).reshape(8, -1, 8).sum(axis=1, dtype=np.int64)
    bits = (counts * 2 > n).T.reshape(64)  # lane by lane, so that bit 8 * lane + step
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def simhashes(hashes: np.ndarray, words: int) -> np.ndarray:
    """``words`` SimHashes of 64 bits, each over the hashes mixed once more under a number of its own (the finalizer of SplitMix64)."""
    own = np.arange(1, words + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    counts = np.zeros((8, words, 8), np.int64)  # by place in a byte, word and byte
    for at in range(0, len(hashes), 255):
        z = hashes[at : at + 255, None] + own
        for shift, times in _MIX:
            z = (z ^ z >> shift) * times
        z ^= z >> np.uint64(31)
        for step in range(8):
            counts[step] += (z >> np.uint64(step) & _LANES).sum(axis=0).view(np.uint8).reshape(words, 8)
    bits = (counts * 2 > len(hashes)).transpose(1, 2, 0).reshape(words, 64)
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)[:, 0]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, carry: str | None = None) -> DataFrame:
    """``(doc_id, fp)`` of each row and the binary column ``carry``, ``fp`` as a signed long. Null text counts as empty: fingerprint zero."""
    more = [carry] if carry else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).cast(pa.binary())
            out = [simhash(shingle_hashes(words_of(t.as_py()), size)) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(out, np.uint64).view(np.int64)), *b.columns[2:]], names=["doc_id", "fp", *more])

    importable(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *more)
    return rows.mapInArrow(run, ", ".join(["doc_id long, fp long", *(f"{c} binary" for c in more)]))


def _block(shift: int) -> Column:
    return F.shiftrightunsigned("fp", shift).bitwiseAND((1 << BLOCK) - 1)


def syndrome(v: Column) -> Column:
    """XOR of the places (1 to 31) of the set bits: zero for a code word, else the place whose flip gives one."""
    out = F.lit(0)
    for k in range(5):
        mask = sum(1 << (p - 1) for p in range(1, BLOCK + 1) if p >> k & 1)
        out = out + (F.bit_count(v.bitwiseAND(F.lit(mask))) % 2) * (1 << k)
    return out.cast("int")


def _flip(p: Column) -> Column:
    """The bit at place p; none for place zero."""
    return F.when(p > 0, F.call_function("shiftleft", F.lit(1).cast("long"), p - 1)).otherwise(F.lit(0).cast("long"))


def code_words() -> Column:
    """By syndrome, the bits to flip in a block for its home and for each other code word within radius 2 of it."""
    bit = lambda p: 1 << p - 1
    near = [[0], *([bit(s), *(bit(p) | bit(p ^ s) for p in range(1, BLOCK + 1) if p < p ^ s)] for s in range(1, BLOCK + 1))]
    return F.array(*(F.array(*(F.lit(m).cast("long") for m in flips)) for flips in near))


def anchors(fps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Homes and replicas ``(anchor, fp, rep)`` of distinct fingerprints; an anchor's number names its block too."""
    homes, copies = [], []
    for b, shift in enumerate(SHIFTS):
        at = fps.withColumn("v", _block(shift)).withColumn("s", syndrome(F.col("v")))
        key = lambda c, b=b: (c * 2 + b).cast("long")
        home = F.col("v").bitwiseXOR(_flip(F.col("s")))
        homes.append(at.select(key(home).alias("anchor"), "fp", "rep"))
        pairs = F.transform(F.sequence(F.lit(1), F.lit(BLOCK)), lambda p: F.when(p < p.bitwiseXOR(F.col("s")), F.col("v").bitwiseXOR(_flip(p)).bitwiseXOR(_flip(p.bitwiseXOR(F.col("s"))))))
        two = F.when(F.col("s") > 0, F.array_compact(pairs)).otherwise(F.array().cast("array<long>"))
        copies.append(at.select(F.explode(F.array_append(two, home)).alias("c"), "fp", "rep").select(key(F.col("c")).alias("anchor"), "fp", "rep"))
    return homes[0].union(homes[1]), copies[0].union(copies[1])


def _forest(batches: pa.Table, most: int) -> pa.Table:
    """Edges of a spanning forest of the links between the homes and the replicas of one dealt block."""
    fp, rep = batches["fp"].to_numpy(), batches["rep"].to_numpy()
    home = batches["home"].to_numpy(zero_copy_only=False)
    label = np.unique(fp, return_inverse=True)[1]  # a fingerprint that is both home and replica is one node
    others, other_label = fp[~home], label[~home]
    first = np.full(label.max() + 1, -1)
    first[label[::-1]] = np.arange(len(fp))[::-1]
    tree, edges = np.arange(len(first)), []
    for at in np.flatnonzero(home):
        near = other_label[np.bitwise_count((others ^ fp[at]).view(np.uint64)) <= most]
        for root in np.unique(tree[near]):
            if root != tree[label[at]]:
                edges.append((rep[at], rep[first[near[tree[near] == root][0]]]))
                tree[tree == root] = tree[label[at]]
    a, b = zip(*edges, strict=True) if edges else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _met(homes: DataFrame, copies: DataFrame, most: int) -> DataFrame:
    """``(a, b)`` of linked pairs at one anchor; of a pair the lesser fingerprint is met at home."""
    h, c = homes.select("anchor", "fp", F.col("rep").alias("a")), copies.select(F.col("anchor").alias("at"), F.col("fp").alias("fp2"), F.col("rep").alias("b"))
    differ = F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2")))
    return h.join(c, (h.anchor == F.col("at")) & (F.col("fp") < F.col("fp2")) & (differ <= most)).select("a", "b")


def _split(members: DataFrame, width: int) -> DataFrame:
    """Each anchor as many, by four parts of ``width`` of the bits outside its block: of two linked fingerprints one part at least is equal. What is left of those bits goes on in ``rest``."""
    shift = lambda name, by: F.call_function(name, F.col("rest"), by.cast("int"))
    low = F.col("p") * width
    value = shift("shiftright", low).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
    above = F.call_function("shiftleft", shift("shiftright", low + width), low.cast("int"))
    below = F.col("rest").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), low.cast("int")) - 1)
    parts = members.select("*", F.explode(F.sequence(F.lit(0), F.lit(MAX_DISTANCE))).alias("p"))
    return parts.select(F.xxhash64("anchor", "p", value).alias("anchor"), "fp", "rep", "home", above.bitwiseOR(below).alias("rest"))


def links(fps: DataFrame, most: int = MAX_DISTANCE, hot: int = HOT, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """``(a, b)``: reps of fingerprints that differ in at most ``most`` (3 or fewer) bits, enough to connect them all.

    ``fps`` holds distinct ``fp`` with ``rep``. At an anchor with up to ``hot``
    homes and replicas every link is a row. One with more is split by the bits
    outside its block: of any two that link one of four parts is equal, so each
    fingerprint goes on at four lesser anchors, which are split again where
    they are hot. Fingerprints that share the block and 18 more bits are near
    each other and mostly all linked: of those, blocks of about ``hot`` are
    dealt to tasks in pairs, each of which returns a spanning forest in place of
    all links. So rows grow with the fingerprints, no task holds more than two
    blocks, and no link is lost to the components.
    """
    if most > MAX_DISTANCE:
        raise ValueError(f"the anchors cover {MAX_DISTANCE} differing bits, not {most}")
    homes, copies = anchors(fps)
    # every home is among the copies
    many = lambda rows: materialize(rows.groupBy("anchor").agg(F.count("*").alias("times")).where(F.col("times") > hot), "hot_anchors")
    crowd = many(copies)
    if crowd.isEmpty():
        return _met(homes, copies, most)
    found = _met(homes.join(crowd, "anchor", "left_anti"), copies.join(crowd, "anchor", "left_anti"), most)
    rest = F.when(F.col("anchor") % 2 == 0, F.shiftrightunsigned("fp", BLOCK)).otherwise(F.col("fp").bitwiseAND(F.lit((1 << REST) - 1)))
    both = homes.withColumn("home", F.lit(True)).union(copies.withColumn("home", F.lit(False)))
    members = both.join(crowd.select("anchor"), "anchor").withColumn("rest", rest)
    for width in widths:
        members = materialize(_split(members, width), "split_anchors")
        crowd = many(members)
        calm = members.join(crowd, "anchor", "left_anti")
        found = found.union(_met(calm.where("home"), calm.where("not home"), most))
        if crowd.isEmpty():
            return found
        members = members.join(crowd.select("anchor"), "anchor")
    dense = members.join(crowd.select("anchor", F.ceil(F.col("times") / hot).cast("int").alias("k")), "anchor")
    own = F.pmod(F.xxhash64("fp"), F.col("k")).cast("int")
    dealt = dense.select("anchor", "fp", "rep", "home", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other"))
    side = lambda at_home, other: F.when(F.col("home"), at_home).otherwise(other)
    blocks = dealt.select("anchor", "fp", "rep", "home", side(F.col("own"), F.col("other")).alias("i"), side(F.col("other"), F.col("own")).alias("j"))
    return found.union(blocks.groupBy("anchor", "i", "j").applyInArrow(lambda t: _forest(t, most), "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, hot: int = HOT) -> DataFrame:
    """``(doc_id, fp, component_id)`` per row; ``component_id`` is the least id reachable over links.

    Null and empty texts have fingerprint zero and link like any other. Rows of
    one id are rows of one document. A row without an id links others like any
    row, and gets their least id; a component is null only if no row of it has
    an id. Very long texts are hashed whole.
    """
    rows = materialize(fingerprints(docs, id_col, text_col, size), "fingerprints")
    fps = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    several = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).where("a <> z")
    one_document = rows.join(several, "doc_id").where("fp <> a").select("a", F.col("fp").alias("b")).distinct()
    comps = connected_components(links(fps.select("fp", F.col("fp").alias("rep")), hot=hot).union(one_document), "a", "b")
    label = materialize(fps.join(comps, fps.fp == comps.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("component")), "labels")
    ids = label.groupBy(F.col("component").alias("of")).agg(F.min("least").alias("component_id"))
    named = label.join(ids, F.col("component") == F.col("of")).select(F.col("fp").alias("of"), "component_id")
    return rows.join(named, F.col("fp") == F.col("of")).select("doc_id", "fp", "component_id")


def _text_key(text_col: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, key, text)`` of each row; ``key`` is the MD5 of the text."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), _text_key(text_col).alias("key"), F.col(text_col).cast("string").alias("text"))


def keep_rows(docs: DataFrame, seen: DataFrame, kept: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns) whose id and text are in ``kept`` (``doc_id, key``), each once, and those without an id.

    ``seen`` holds ``doc_id, key`` of every row with an id. Of rows that agree
    in id and text, the one whose other columns come first in order stays. Only
    rows that go or have an equal are shuffled, as a bitmap tells them from the
    others where they stand.
    """
    own, of, key, stays, first = fresh(docs.columns, "own_key", "seen_id", "seen_key", "stays", "first")
    counted = seen.groupBy("doc_id", "key").agg(F.count("*").alias("times"))
    keep = kept.select(F.col("doc_id").alias("kept_id"), F.col("key").alias("kept_key"))
    odd = counted.join(keep, (F.col("doc_id") == F.col("kept_id")) & (F.col("key") == F.col("kept_key")), "left").where("kept_id is null or times > 1")
    odd = materialize(odd.select(F.col("doc_id").alias(of), F.col("key").alias(key), F.col("kept_id").isNotNull().alias(stays)), "rows_that_go")
    rows = docs.withColumn(own, _text_key(text_col))
    split, there = marked(rows, odd, F.struct(F.col(id_col).cast("long"), own), F.struct(of, key))
    asked = F.col(there) & F.col(id_col).isNotNull()
    held = split.where(asked).join(odd.hint("merge"), (F.col(id_col) == F.col(of)) & (F.col(own) == F.col(key)), "left")
    alone = held.where(F.col(of).isNull())
    equal = held.where(F.col(stays)).groupBy(of, key).agg(F.min_by(F.struct(*docs.columns), F.to_json(F.struct(*docs.columns))).alias(first)).select(f"{first}.*")
    return split.where(~asked).select(*docs.columns).union(alone.select(*docs.columns)).union(equal)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns) less near copies: of each component of fingerprints the row with the least id, then MD5 of the text.

    Rows of one id with texts that aren't near each other are kept each for
    itself, and equal ones once; rows without an id stay, as nothing tells
    which of them to keep. Null and empty texts are copies of each other.
    """
    keys = keyed(docs, id_col, text_col).where("doc_id is not null")
    rows = materialize(fingerprints(keys, "doc_id", "text", carry="key"), "fingerprints")
    fps = materialize(rows.groupBy("fp").agg(F.min(F.struct("doc_id", "key")).alias("least")), "distinct")
    comps = connected_components(links(fps.select("fp", F.col("fp").alias("rep"))), "a", "b")
    label = fps.join(comps, fps.fp == comps.node, "left").select(F.coalesce("component", "fp").alias("component"), "least")
    return keep_rows(docs, rows, label.groupBy("component").agg(F.min("least").alias("least")).select("least.*"), id_col, text_col)


def hex_fingerprint(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
