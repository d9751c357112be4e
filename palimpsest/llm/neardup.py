"""Near-duplicates of a Jaccard similarity of 0.8 or more, by anchor points of a covering code over a long SimHash.

Fingerprint: ``WORDS`` 64-bit SimHashes over the set of five-word shingles,
each under a hash of its own. At a similarity of 0.8 about 15 in 100 bits
differ, ten of 64: far beyond the three for which ``simhash`` covers one word.
So the same two blocks of 31 bits are taken from every word. A text is at home
at the Hamming(31, 26) code word within radius 1 of each block and is
replicated to those within radius 2; two texts are held against each other
where one meets the other's home. Of two at 0.8 a block does so with a chance
of 0.08, of two unrelated ones with 1 in two million: that is too often where
texts are many, as such meetings grow with their square. So an anchor is a
code word and a tag, the least of a text's shingles under one of ``TAGS``
hashes. Each block goes with two tags and each tag with 26 blocks; two texts at
0.8 share a tag with a chance of 0.8, unrelated ones as good as never. Over
all a pair at 0.8 is missed with a chance of 0.00005, a nearer one with less.
Pairs that met and differ in at most ``RADIUS`` of 64 further bits are compared
exactly.

The texts of a tag meet at once: of a calm tag as pairs of rows, of a crowded
one in tasks, by their blocks alone; shingles are asked for where texts met.
Only tags of very many texts, and texts without tags, are rows at their
anchors. For these the words are used up in rounds; between them linked texts
become one group, and a tag or an anchor where only one group meets is done.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bitmap import BUCKET_BITS, BUCKETS, among, marked, maybe
from .bpe import slices
from .components import connected_components
from .simhash import BLOCK as CODE
from .simhash import SHIFTS, code_words, keep_rows, keyed, shingle_hashes, simhash, simhashes, syndrome, words_of
from .storage import importable, materialize, small_batches

SHINGLE, WORDS, RADIUS, TAGS = 5, 52, 24, 8
#: A block goes with the tag of its number (modulo TAGS) and with the one so far behind it.
SECOND_TAG = 3
#: Words of the first round, whose links make most later meetings needless, and homes that a later round enters into the bitmap.
FIRST, HOMES = 1, BUCKETS * BUCKET_BITS // 16
#: Pairs whose blocks a task compares at once.
CELLS = 1 << 16
#: Texts at one anchor or tag beyond which its pairs are dealt out over tasks, texts in a dealt block, and blocks up to which a tag is dealt as a whole.
#: Beyond these a tag's texts are rows at its anchors.
HOT, BLOCK, DENSE = 64, 512, 16

_RNG = np.random.default_rng(42)
_XOR, _TIMES = (_RNG.integers(0, 1 << 64, (TAGS, 1), np.uint64) for _ in range(2))


def shingle_set(text: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """The XXH64 of each different shingle, in order; fewer words make one shingle."""
    return np.unique(shingle_hashes(words_of(text), size))


def set_key(shingles: np.ndarray) -> bytes:
    from xxhash import xxh128_digest

    return xxh128_digest(shingles.tobytes(), 42)


def blocks(shingles: np.ndarray) -> np.ndarray:
    """The blocks of 31 bits of every word of the long SimHash, two a word."""
    long = simhashes(shingles, WORDS)
    return np.stack([long >> np.uint64(shift) & np.uint64((1 << CODE) - 1) for shift in SHIFTS], axis=1).ravel().astype(np.int32)


def least(shingles: np.ndarray) -> np.ndarray:
    """The least of the shingles under each of the hashes; none of no shingles."""
    if not len(shingles):
        return np.empty(0, np.int64)
    return ((shingles ^ _XOR) * (_TIMES | np.uint64(1))).min(axis=1).view(np.int64)


def sketches(rows: DataFrame) -> DataFrame:
    """``(doc_id, key, node, fp, n, tags)`` of rows ``(doc_id, key, text)``; ``node`` is a hash of the set of ``n`` shingles, ``tags`` its least ones, by number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            sets = [shingle_set(t.as_py()) for t in b.column(2).cast(pa.binary())]
            fps = np.array([simhash(s) for s in sets], np.uint64).view(np.int64)
            cols = [pa.array([set_key(s) for s in sets], pa.binary()), pa.array(fps), pa.array([len(s) for s in sets], pa.int32()), pa.array([least(s) for s in sets], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols], names=["doc_id", "key", "node", "fp", "n", "least"])

    found = rows.mapInArrow(run, "doc_id long, key binary, node binary, fp long, n int, least array<long>")
    return found.select("doc_id", "key", "node", "fp", "n", F.transform("least", lambda x, i: F.struct(i.alias("number"), x.alias("tag"))).alias("tags"))


def _by_set(rows: DataFrame, name: str, kind: str, of: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """``(node, name)`` of rows ``(key, text)``, once each: what ``of`` makes of the set of shingles."""
    inner = {"int": pa.int32(), "long": pa.int64()}[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices([b], 64):
                sets = [shingle_set(t.as_py()) for t in part.column(1).cast(pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.array([set_key(s) for s in sets], pa.binary()), pa.array([of(s) for s in sets], pa.list_(inner))], names=["node", name])

    return rows.mapInArrow(run, f"node binary, {name} array<{kind}>").dropDuplicates(["node"])


def sets_of(rows: DataFrame) -> DataFrame:
    """``(node, shingles)`` of rows ``(key, text)``, once each."""
    return _by_set(rows, "shingles", "long", lambda s: s.view(np.int64))


def blocks_of(rows: DataFrame) -> DataFrame:
    """``(node, blocks)`` of rows ``(key, text)``, once each."""
    return _by_set(rows, "blocks", "int", blocks)


def _homes(values: np.ndarray) -> np.ndarray:
    """The code words within radius 1 of blocks."""
    at = sum((np.bitwise_count(values & sum(1 << p - 1 for p in range(1, CODE + 1) if p >> k & 1)).astype(np.int64) & 1) << k for k in range(5))
    return np.where(at > 0, values ^ 1 << np.maximum(at - 1, 0), values)


def _candidates(t: pa.Table) -> pa.Table:
    """Pairs of two dealt blocks of a tag, or within one, that meet at an anchor and whose further bits are near; if they are more than the texts, one row without a pair."""
    node, fp, n, own = t["node"], *(t[c].to_numpy() for c in ("fp", "n", "own"))
    lo, hi = t["lo"][0].as_py(), t["hi"][0].as_py()
    a, b = np.flatnonzero(own == lo), np.flatnonzero(own == hi)
    near = (np.bitwise_count((fp[a, None] ^ fp[b]).view(np.uint64)) <= RADIUS) & (5 * np.minimum(n[a, None], n[b]) >= 4 * np.maximum(n[a, None], n[b]))
    i, j = np.nonzero(np.triu(near, 1) if lo == hi else near)
    i, j = a[i], b[j]
    values = pc.list_flatten(t["blocks"]).to_numpy().reshape(len(own), -1)
    home = _homes(values)
    met = [((np.bitwise_count(values[y] ^ home[x]) <= 2) | (np.bitwise_count(home[y] ^ values[x]) <= 2)).any(axis=1) for x, y in zip(*(np.array_split(k, len(k) // CELLS + 1) for k in (i, j)), strict=True)]
    met = np.concatenate(met)
    i, j = i[met], j[met]
    if len(i) > len(own):
        i = j = np.array([None])
    pairs = [node.take(pa.array(k, pa.int64())).cast(pa.binary()).combine_chunks() for k in (i, j)]
    one = [t[c].slice(0, 1).take(pa.array(np.zeros(len(i), int))) for c in ("anchor", "lo", "hi")]
    return pa.table([*one, *pairs], names=["anchor", "lo", "hi", "a", "b"])


def _forest(t: pa.Table) -> pa.Table:
    """Edges that connect the similar texts of two dealt blocks, or within one, to a forest of components. With ``blocks`` only texts of which one meets the other's home are held against each other."""
    node, fp, own = t["node"].to_pylist(), t["fp"].to_numpy(), t["own"].to_numpy()
    sets = [np.asarray(s.values) for s in t["shingles"]]
    n = np.array([len(s) for s in sets])
    number = {c: i for i, c in enumerate(dict.fromkeys(t["comp"].to_pylist()))}
    tree, edges, one = np.array([number[c] for c in t["comp"].to_pylist()]), [], t["lo"][0] == t["hi"][0]
    if met := "blocks" in t.column_names:
        values = np.array(t["blocks"].to_pylist(), np.int64)
        home = _homes(values)
    for i in range(len(node) - 1):
        j = np.arange(i + 1, len(node))
        near = (np.bitwise_count((fp[j] ^ fp[i]).view(np.uint64)) <= RADIUS) & (5 * np.minimum(n[j], n[i]) >= 4 * np.maximum(n[j], n[i])) & (one | (own[j] != own[i])) & (tree[j] != tree[i])
        j = j[near]
        if met:
            j = j[((np.bitwise_count(values[j] ^ home[i]) <= 2) | (np.bitwise_count(home[j] ^ values[i]) <= 2)).any(axis=1)]
        for k in j.tolist():
            if tree[k] != tree[i] and 9 * len(np.intersect1d(sets[i], sets[k], assume_unique=True)) >= 4 * (n[i] + n[k]):
                edges.append((node[i], node[k]))
                tree[tree == tree[k]] = tree[i]
    a, b = zip(*edges, strict=True) if edges else ((), ())
    return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})


def _goes(tag: Column, block: Column) -> Column:
    return (tag == block % TAGS) | (tag == (block + SECOND_TAG) % TAGS)


def anchors(nodes: DataFrame, first: int, words: int) -> tuple[DataFrame, DataFrame]:
    """Homes ``(anchor, ...)``, and homes and replicas ``(anchor, home, ...)``, with the other columns of ``nodes``, of ``words`` words from ``first`` on.

    An anchor's number names its block too. If ``nodes`` have ``tags``, a block
    is at an anchor for each tag that it goes with, a hash of both numbers.
    """
    own = [c for c in nodes.columns if c not in ("blocks", "tags")]
    tags = ["tags"] if "tags" in nodes.columns else []
    some = nodes.select(*own, *tags, F.posexplode(F.slice("blocks", 2 * first + 1, 2 * words)).alias("i", "v")).withColumn("i", F.col("i") + 2 * first)
    anchor = lambda v: v
    if tags:
        goes = lambda t: _goes(t["number"], F.col("i"))
        some = some.select(*own, "i", "v", F.explode(F.filter("tags", goes)).alias("t")).select(*own, "i", "v", "t.tag")
        anchor = lambda v: F.xxhash64(v, "tag")
        tags = ["tag"]
    at = some.select(*own, *tags, F.call_function("shiftleft", F.col("i").cast("long"), F.lit(CODE)).bitwiseOR(F.col("v").cast("long")).alias("v"), syndrome(F.col("v")).alias("s"))
    near = F.element_at(code_words(), F.col("s") + 1)
    every = at.select(*own, *tags, "v", F.posexplode(near).alias("j", "flips"))
    return at.select(anchor(F.col("v").bitwiseXOR(F.element_at(near, 1))).alias("anchor"), *own), every.select(anchor(F.col("v").bitwiseXOR(F.col("flips"))).alias("anchor"), (F.col("j") == 0).alias("home"), *own)


def mixed_tags(nodes: DataFrame) -> DataFrame:
    """``nodes`` with those of their ``tags`` that a node of another ``comp`` has too, and the ``times`` each occurs; those with none left go, and only the others, as good as, are shuffled."""
    each = nodes.select("node", F.xxhash64("comp").alias("of_comp"), F.explode("tags").alias("t")).select("node", "of_comp", "t.number", "t.tag")
    mixed = each.groupBy("tag").agg(F.count("*").alias("times"), F.min("of_comp").alias("x"), F.max("of_comp").alias("y")).where("x <> y").select("tag", "times")
    mixed = materialize(mixed, "shared_tags")
    kept = among(each, mixed, "tag").join(mixed, "tag")
    tags = materialize(kept.groupBy("node").agg(F.collect_list(F.struct("number", "tag", "times")).alias("tags")), "tags")  # TAGS at most
    return materialize(maybe(nodes.drop("tags"), tags, F.col("node"), F.col("node")).join(tags, "node"), "tagged")


def _round(nodes: DataFrame, rows: DataFrame, first: int, words: int, hot: int, block: int) -> DataFrame:
    """``(a, b)``: similar nodes of different components that meet at an anchor of these words, enough to connect the components."""
    homes, every = anchors(nodes, first, words)
    near = among(every.select("anchor", F.xxhash64("comp").alias("tag")), homes, "anchor")  # a replica at nobody's home meets nothing
    mixed = near.groupBy("anchor").agg(F.min("tag").alias("x"), F.max("tag").alias("y")).where("x <> y").select("anchor")
    mixed = materialize(mixed, "shared_anchors")
    members = materialize(among(every, mixed, "anchor").join(mixed, "anchor"), "anchored")
    many = materialize(members.groupBy("anchor").agg(F.count("*").alias("times"), F.bit_xor(F.xxhash64("node")).alias("all")).where(F.col("times") > hot), "hot_anchors")
    once = many.groupBy("times", "all").agg(F.min("anchor").alias("anchor"))  # the same nodes are compared at one anchor
    calm, crowd = members.join(many, "anchor", "left_anti"), members.join(once, "anchor")
    other = calm.select(F.col("anchor").alias("at"), *(F.col(c).alias(f"{c}2") for c in ("node", "comp", "fp", "n")))
    met = calm.where("home").join(other, (F.col("anchor") == F.col("at")) & (F.col("comp") != F.col("comp2")) & _near())
    pairs = materialize(met.select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")).distinct(), "near_pairs")
    sets = _asked_sets(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(crowd.select("node")), nodes, rows)
    found = _similar(pairs, sets)
    return found if many.isEmpty() else found.union(_dealt(_blocked(crowd.join(sets, "node"), block)))


def _near() -> Column:
    """Whether the further bits of two nodes are near and their sizes allow the similarity."""
    return (F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= RADIUS) & (5 * F.least("n", "n2") >= 4 * F.greatest("n", "n2"))


def _asked_sets(asked: DataFrame, nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """``(node, shingles)`` of the ``asked`` nodes, once each, from their texts."""
    asked = materialize(asked.distinct(), "asked_nodes")
    named = maybe(nodes.select("node", "key"), asked, F.col("node"), F.col("node"))
    keys = materialize(named.join(asked, "node", "left_semi").select("key").distinct(), "asked_texts")
    return materialize(sets_of(maybe(rows.select("key", "text"), keys)), "shingle_sets")


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    both = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    return both.where(9 * F.size(F.array_intersect("x", "y")) >= 4 * (F.size("x") + F.size("y"))).select("a", "b")


def _blocked(crowd: DataFrame, block: int) -> DataFrame:
    """``crowd`` with ``own``, the block of a row of its anchor's ``times``, of about ``block`` rows each, once for every pair of blocks ``lo`` and ``hi`` that it belongs to."""
    k = F.ceil(F.col("times") / block).cast("int")
    dealt = crowd.withColumn("own", F.pmod(F.xxhash64("node"), k).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), k - 1)))
    return dealt.withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")}).drop("other", "times")


def _dealt(blocked: DataFrame) -> DataFrame:
    """``(a, b)``: edges of the spanning forests of every two blocks of an anchor."""
    columns = [c for c in ("anchor", "node", "comp", "fp", "shingles", "blocks", "own", "lo", "hi") if c in blocked.columns]
    return blocked.select(*columns).groupBy("anchor", "lo", "hi").applyInArrow(_forest, "a binary, b binary")


def _calm(times: Column, hot: int) -> Column:
    """Whether the texts of a tag meet as pairs of rows."""
    return times <= hot


def _crowded(times: Column, hot: int, block: int) -> Column:
    """Whether the texts of a tag meet in tasks."""
    return (times > hot) & (times <= DENSE * block)


def _home(v: Column) -> Column:
    """The code word within radius 1 of a block."""
    flips = F.array(*(F.lit(1 << p - 1 if p else 0) for p in range(CODE + 1)))
    return v.bitwiseXOR(F.element_at(flips, syndrome(v) + 1))


def _under_tags(nodes: DataFrame, rows: DataFrame, hot: int, block: int) -> DataFrame:
    """``(a, b)``: similar nodes that meet at an anchor of a calm or crowded tag, of any word, enough to connect them.

    What meets is told from further bits and blocks alone. Where more pairs of
    two dealt blocks meet than there are texts in them (near copies), these go
    out again with their shingles and a spanning forest comes back.
    """
    own = F.filter("blocks", lambda v, i: _goes(F.col("t.number"), i))
    each = nodes.select("node", "fp", "n", "blocks", F.explode("tags").alias("t")).select("node", "fp", "n", F.col("t.tag").alias("anchor"), "t.number", "t.times", own.alias("blocks"))
    calm = each.where(_calm(F.col("times"), hot)).drop("times").withColumn("homes", F.transform("blocks", _home))
    other = calm.select(*(F.col(c).alias(f"{c}2") for c in calm.columns))
    within = lambda x, y: F.exists(F.zip_with(x, y, lambda v, w: F.bit_count(v.bitwiseXOR(w)) <= 2), lambda x: x)
    same = (F.col("anchor") == F.col("anchor2")) & (F.col("number") == F.col("number2")) & (F.col("node") < F.col("node2"))
    pairs = calm.join(other, same & _near()).where(within("blocks", "homes2") | within("homes", "blocks2")).select(F.col("node").alias("a"), F.col("node2").alias("b"))
    crowd = materialize(each.where(_crowded(F.col("times"), hot, block)).drop("number"), "crowded_tags")
    if crowd.isEmpty():
        pairs = materialize(pairs.distinct(), "near_pairs")
        return _similar(pairs, _asked_sets(pairs.select(F.col("a").alias("node")).union(pairs.select("b")), nodes, rows))
    blocked = _blocked(crowd, block)
    met = materialize(blocked.groupBy("anchor", "lo", "hi").applyInArrow(_candidates, "anchor long, lo int, hi int, a binary, b binary"), "met_in_tasks")
    some = met.where("a is not null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = materialize(pairs.union(some).distinct(), "near_pairs")
    full = met.where("a is null").select("anchor", "lo", "hi")
    dense = materialize(blocked.join(full, ["anchor", "lo", "hi"], "left_semi").drop("n"), "dense_blocks")
    sets = _asked_sets(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(dense.select("node")), nodes, rows)
    found = _similar(pairs, sets)
    return found if dense.isEmpty() else found.union(_dealt(dense.withColumn("comp", F.col("node")).join(sets, "node")))


def labelled(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``nodes`` with ``comp``, the least node that edges reach. Only nodes that may have an edge are shuffled."""
    comps = materialize(connected_components(edges, "a", "b").toDF("of", "component"), "near_components")
    split, there = marked(nodes, comps, F.col("node"), F.col("of"))
    alone = split.where(~F.col(there)).select(*nodes.columns, F.col("node").alias("comp"))
    return alone.union(split.where(F.col(there)).join(comps, F.col("node") == F.col("of"), "left").select(*nodes.columns, F.coalesce("component", "node").alias("comp")))


def links(nodes: DataFrame, rows: DataFrame, hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """``(a, b)``: nodes of a similarity of 0.8 or more, enough to connect all of them that meet.

    ``nodes`` holds distinct ``node`` with ``key``, the hash of a text of it in
    ``rows``, and may hold ``tags``; without them code words alone are anchors.
    The texts of a tag of up to ``DENSE`` blocks meet at once, however many
    tags there are; only those of larger ones are rows at their anchors, word by
    word. At an anchor of up to ``hot`` homes and replicas every pair of
    different components is compared as a row. Beyond that, its nodes are dealt
    into blocks and each pair of blocks returns a spanning forest.
    """
    now, tagged = nodes.withColumn("comp", F.col("node")), "tags" in nodes.columns
    found, first, step = None, 0, FIRST
    if tagged:
        found = materialize(_under_tags(nodes, rows, hot, block), "near_links")
        huge = lambda t: ~(_calm(t["times"], hot) | _crowded(t["times"], hot, block))
        nodes = materialize(nodes.withColumn("tags", F.filter("tags", huge)).where(F.size("tags") > 0), "huge_tags")
        if nodes.isEmpty():
            return found
        now = mixed_tags(labelled(nodes, found))
    while first < WORDS:
        more = materialize(_round(now, rows, first, min(step, WORDS - first), hot, block), "near_links")
        found = more if found is None else found.union(more)
        first += step
        if first < WORDS:
            now = labelled(nodes, found)
            now = mixed_tags(now) if tagged else now
            # homes a word: two of a node without tags; a tag goes with two blocks of TAGS
            homes = now.agg(F.coalesce(F.sum(F.size("tags")), F.lit(0))).first()[0] * 4 // TAGS if tagged else 2 * now.count()
            step = max(1, HOMES // max(1, homes))
    return found


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` (all columns) less near copies: of each component over similar texts the row with the least id, then text hash.

    Texts of the same shingles are copies. Equal rows of one id stay once; rows
    without an id stay, as nothing tells which of them to keep.
    """
    importable(docs.sparkSession)
    small_batches(docs.sparkSession)
    rows = keyed(docs, id_col, text_col).where("doc_id is not null")
    found = materialize(sketches(rows), "sketches")
    same = found.groupBy("node").agg(F.min(F.struct("doc_id", "key")).alias("least"), *(F.first(c).alias(c) for c in ("fp", "n", "tags")))
    nodes = materialize(same.select("node", "least", F.col("least.key").alias("key"), "fp", "n", "tags"), "distinct")
    some = mixed_tags(nodes.select("node", "key", "fp", "n", "tags", F.col("node").alias("comp"))).drop("comp")
    # a text that shares no tag meets nothing and needs no blocks
    some = materialize(some.join(blocks_of(maybe(rows.select("key", "text"), some.select("key"))), "node"), "sketched")
    comps = connected_components(links(some, rows, hot, block), "a", "b").toDF("of", "component")
    label = nodes.join(comps, F.col("node") == F.col("of"), "left").select(F.coalesce("component", "node").alias("component"), "least")
    return keep_rows(docs, found, label.groupBy("component").agg(F.min("least").alias("least")).select("least.*"), id_col, text_col)
