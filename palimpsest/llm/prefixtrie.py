"""Tries of conversations that share their first turns, and subtree sums by parallel tree contraction.

A node is a distinct sequence of first turns; it is named by its smallest
member and its depth, so that the nodes of one name form a path downwards.
Sums over subtrees come from contraction: rounds that alternate a rake (leaves
add their sum to their parent) and a compress (nodes with one child hand theirs
on to it), until the root is raked; spliced nodes get their sum back from the
node that they were spliced into. Rounds grow with the logarithm of the trie's
size, not with its depth.

Awkward rows: rows without ``conv_id`` belong to no conversation and are left
out; a null role or text is empty; turns of equal number are ordered by role and
text, repeated rows are turns of their own; other columns are ignored, whatever
their names; an empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import materialize, remove, written

#: Turns that one task sums up in order, and live nodes of a path that one task splices at once.
BLOCK = 65536
#: Members' numbers that are joined to one string.
SPAN = 65536
#: Largest number of turns taken over from another conversation, plus one.
SHARED = 9
FAMILY = 5


def numbered_turns(rows: DataFrame) -> DataFrame:
    """``(conv, pos, role, text)``: turns numbered from 1, null turns first.

    Rows are cut into ranges of their whole order, so that a conversation that
    holds much of the table is numbered by many tasks; a range's first number
    comes from the sizes of the ranges before it.
    """
    plain = rows.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = ["turn", "role", "text", "tie"]
    ranges = plain.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange("conv", *order).withColumn("part", F.spark_partition_id())
    kept = materialize(ranges, "turns")
    sizes = kept.groupBy("conv", "part").agg(F.count("*").alias("size"))
    every = Window.partitionBy("conv")
    starts = sizes.withColumn("start", F.sum("size").over(every.orderBy("part")) - F.col("size")).where("start > 0").select("conv", "part", "start")
    placed = kept.withColumn("row", F.row_number().over(Window.partitionBy("conv", "part").orderBy(*order)))
    # a conversation in several ranges fills all but its first and last: fewer rows than ranges
    found = placed.join(F.broadcast(starts), ["conv", "part"], "left")
    return found.select("conv", (F.col("row") + F.coalesce("start", F.lit(0))).alias("pos"), "role", "text")


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(conv, pos, role, text, length)`` of the rebuilt conversations, and ``(conv, length)`` of all, those without turns too.

    Conversation c starts with the first h turns of c - c % 5 and goes on with
    its own after the first h; h is the CRC-32 of c's digits modulo 9.
    """
    turns = materialize(numbered_turns(rows), "numbered")
    sizes = turns.groupBy("conv").agg(F.count("*").alias("own"))
    convs = sizes.withColumn("base", F.col("conv") - F.col("conv") % FAMILY).withColumn("h", F.when(F.col("conv") % FAMILY == 0, 0).otherwise(F.crc32(F.col("conv").cast("string").cast("binary")) % SHARED))
    bases = sizes.select(F.col("conv").alias("base"), F.col("own").alias("there"))
    taken = F.least("h", F.coalesce("there", F.lit(0))).cast("long")
    convs = materialize(convs.join(bases, "base", "left").select("conv", "base", "h", taken.alias("taken"), (taken + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length")), "convs")
    own = turns.join(convs.drop("base"), "conv").where("pos > h").select("conv", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "role", "text", "length")
    first = turns.where((F.col("pos") < SHARED) & (F.col("conv") % FAMILY == 0)).select(F.col("conv").alias("base"), "pos", "role", "text")
    lent = convs.where("taken > 0").join(first, "base").where("pos <= taken").select("conv", "pos", "role", "text", "length")
    return own.unionByName(lent), convs.select("conv", "length")


def _limbs() -> list[Column]:
    """Four 32-bit parts of a turn's digest; its place and the length of its role are in it, so no two texts run into each other."""
    digest = F.md5(F.concat_ws(":", F.col("pos").cast("string"), F.length("role").cast("string"), "role", "text"))
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"l{k}") for k in range(4)]


def prefixes(turns: DataFrame) -> DataFrame:
    """``(conv, depth, k1, k2, p1, p2, bytes, length)``: a row for each conversation and number of first turns.

    A prefix is known by its depth and 128 bits, four sums modulo 2^32 of its
    turns' digests; p1 and p2 are those of the prefix one turn shorter. Sums are
    taken in blocks of ``BLOCK`` turns, then over blocks.
    """
    hashed = turns.select("conv", "pos", "length", F.octet_length("text").cast("long").alias("bytes"), F.floor(F.col("pos") / BLOCK).alias("block"), *_limbs())
    limbs = [f"l{k}" for k in range(4)]
    within = Window.partitionBy("conv", "block").orderBy("pos")
    running = hashed.withColumns({f"s{k}": F.sum(f"l{k}").over(within) for k in range(4)})
    sums = hashed.where(F.col("length") >= BLOCK).groupBy("conv", "block").agg(*(F.sum(x).alias(x) for x in limbs))
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col("conv"), F.col("block"), *(F.coalesce(F.sum(F.col(x) % (1 << 32)).over(before), F.lit(0)).alias(f"b{k}") for k, x in enumerate(limbs)))
    found = running.join(starts, ["conv", "block"], "left")
    now = [(F.col(f"s{k}") + F.coalesce(F.col(f"b{k}"), F.lit(0))) % (1 << 32) for k in range(4)]
    then = [(F.col(f"s{k}") + F.coalesce(F.col(f"b{k}"), F.lit(0)) - F.col(f"l{k}")) % (1 << 32) for k in range(4)]
    pair = lambda x: F.shiftleft(x[0], 32).bitwiseXOR(x[1])
    return found.select("conv", F.col("pos").alias("depth"), pair(now).alias("k1"), pair(now[2:]).alias("k2"), pair(then).alias("p1"), pair(then[2:]).alias("p2"), "bytes", "length")


def _sha(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of strings that come in pieces, by node and in order; holds one batch and one digest."""
    at, digest, shape = None, None, [("depth", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("ends", pa.string())]

    def table(done: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, (_, t) in zip(zip(*done, strict=True), shape, strict=True)], schema=pa.schema(shape))

    for b in batches:
        done = []
        for *key, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if key == at:
                digest.update(b",")
            else:
                if at:
                    done.append((*at, digest.hexdigest()))
                at, digest = key, hashlib.sha256()
            digest.update(text.encode())
        if done:
            yield table(done)
    if at:
        yield table([(*at, digest.hexdigest())])


def ends(members: DataFrame) -> DataFrame:
    """``(depth, k1, k2, ends)``: SHA-256 of the joined numbers of the conversations that end at a node.

    ``SPAN`` neighbouring numbers at most are joined to one string first, so the
    task that digests a node with many of them reads few rows, in order.
    """
    keys = ["depth", "k1", "k2"]
    spans = members.groupBy(*keys, F.floor(F.col("conv") / SPAN).alias("span")).agg(F.array_join(F.array_sort(F.collect_list("conv")).cast("array<string>"), ",").alias("text"))
    ordered = spans.repartition(*keys).sortWithinPartitions(*keys, "span").select(*keys, "text")
    return ordered.mapInArrow(_sha, "depth long, k1 long, k2 long, ends string")


# contraction; a live node has its own sums, and those of the nodes spliced out between it and its live parent (over_*)

SUMS = ("leaves", "saved")
OVER = tuple(f"over_{s}" for s in SUMS)


def _rake(live: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Inner nodes, with the sums of their leaves added and the number ``kids`` of other children and one of them; and the leaves."""
    inner = live.where("pc is not null").groupBy(F.col("pc").alias("c"), F.col("pd").alias("d")).agg(F.lit(True).alias("inner"))
    told = live.join(inner, ["c", "d"], "left").withColumn("leaf", F.col("inner").isNull()).drop("inner")
    child = F.when(~F.col("leaf"), F.struct("c", "d"))
    given = told.where("pc is not null").groupBy(F.col("pc").alias("c"), F.col("pd").alias("d")).agg(
        *(F.sum(F.when(F.col("leaf"), F.col(s) + F.col(f"over_{s}")).otherwise(0)).alias(f"new_{s}") for s in SUMS), F.count(child).alias("kids"), F.max(child).alias("kid"))
    rest = told.where("not leaf").join(given, ["c", "d"]).withColumns({s: F.col(s) + F.col(f"new_{s}") for s in SUMS})
    return rest.drop("leaf", *(f"new_{s}" for s in SUMS)), told.where("leaf").select("c", "d", *SUMS)


def _compress_paths(live: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Splices runs of unary nodes of one path, up to ``BLOCK`` depths at a time, into the node below them: the nodes left, and the others with their target ``c2, d2`` and the sums down to it."""
    down = Window.partitionBy("c", "block").orderBy("d")
    rows = live.withColumn("block", F.floor(F.col("d") / BLOCK))
    goes = (F.col("kids") == 1) & F.col("pc").isNotNull() & (F.col("kid.c") == F.col("c")) & F.lead("d").over(down).isNotNull()
    rows = rows.withColumn("goes", goes)
    stop = F.first(F.when(~F.col("goes"), F.col("d")), ignorenulls=True).over(down.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("stop", stop)
    run = Window.partitionBy("c", "block", "stop").orderBy("d")
    below, whole = run.rowsBetween(0, Window.unboundedFollowing), run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns({"top_c": F.first("pc").over(whole), "top_d": F.first("pd").over(whole)})
    for s in SUMS:
        own, over = F.when(F.col("goes"), F.col(s)).otherwise(0), F.col(f"over_{s}")
        rows = rows.withColumns({f"sum_{s}": F.sum(own + over).over(below) - over, f"all_{s}": F.sum(own + over).over(whole)})
    gone = rows.where("goes").select("c", "d", F.col("c").alias("c2"), F.col("stop").alias("d2"), *(F.col(f"sum_{s}").alias(s) for s in SUMS))
    kept = rows.where("not goes").select("c", "d", F.col("top_c").alias("pc"), F.col("top_d").alias("pd"), *SUMS, *(F.col(f"all_{s}").alias(f"over_{s}") for s in SUMS), "kids", "kid")
    return kept, gone


def _compress_across(live: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """Splices unary nodes that draw heads into a child that draws tails, on whichever path the child is; a child that draws tails stays."""
    heads = lambda c, d: F.pmod(F.xxhash64(c, d, F.lit(turn)), F.lit(2)) == 1
    rows = live.withColumn("goes", (F.col("kids") == 1) & F.col("pc").isNotNull() & heads(F.col("c"), F.col("d")) & ~heads(F.col("kid.c"), F.col("kid.d")))
    above = rows.where("goes").select(F.col("kid.c").alias("c"), F.col("kid.d").alias("d"), F.struct("c", "d", "pc", "pd", *SUMS, *OVER).alias("up"))
    met = rows.where("not goes").join(above, ["c", "d"], "left").withColumn("takes", F.col("up").isNotNull())
    gone = met.where("takes").select(F.col("up.c").alias("c"), F.col("up.d").alias("d"), F.col("c").alias("c2"), F.col("d").alias("d2"), *((F.col(f"up.{s}") + F.col(f"over_{s}")).alias(s) for s in SUMS))
    take = lambda a, b: F.when(F.col("takes"), a).otherwise(b)
    over = [(F.col(f"over_{s}") + take(F.col(f"up.{s}") + F.col(f"up.over_{s}"), F.lit(0))).alias(f"over_{s}") for s in SUMS]
    return met.select("c", "d", take(F.col("up.pc"), F.col("pc")).alias("pc"), take(F.col("up.pd"), F.col("pd")).alias("pd"), *SUMS, *over, "kids", "kid"), gone


def subtree_sums(nodes: DataFrame, most_rounds: int = 200) -> DataFrame:
    """``(c, d, leaves, saved)``, summed over subtrees, for ``(c, d, pc, pd, leaves, saved)``; the root's pc is null.

    Each round is written, with what it raked and spliced, to one table in the
    shared folder; the next reads it.
    """
    spark = nodes.sparkSession
    none = F.lit(None).cast("long")
    shape = ["kind", "c", "d", "pc", "pd", *SUMS, *OVER]
    live, last = nodes.withColumns({o: F.lit(0).cast("long") for o in OVER}), None
    done = []
    for turn in range(most_rounds):
        inner, raked = _rake(live)
        kept, crossed = _compress_across(inner, turn)
        kept, spliced = _compress_paths(kept)
        as_row = lambda df, kind, pc, pd: df.select(F.lit(kind).alias("kind"), "c", "d", pc.alias("pc"), pd.alias("pd"), *SUMS, *((F.col(o) if o in df.columns else F.lit(0).cast("long")).alias(o) for o in OVER))
        gone = as_row(spliced.union(crossed), "spliced", F.col("c2"), F.col("d2"))
        table, path = written(as_row(kept, "live", F.col("pc"), F.col("pd")).union(gone).union(as_row(raked, "raked", none, none)).select(*shape), f"contracted{turn}")
        done.append(table)
        live = table.where("kind = 'live'").drop("kind")
        if live.isEmpty():
            break
    else:
        raise RuntimeError(f"not contracted after {most_rounds} rounds")
    every = done[0]
    for table in done[1:]:
        every = every.unionByName(table)
    every = every.where("kind <> 'live'").drop("kind", *OVER)
    # a spliced node's chain of targets has at most one for each compress: jumps double what they cover
    jumps = max(1, (2 * len(done)).bit_length())
    for _ in range(jumps):
        to = every.select(F.col("c").alias("pc"), F.col("d").alias("pd"), F.struct(F.col("pc").alias("c"), F.col("pd").alias("d"), *SUMS).alias("to"))
        open_, shut = every.where("pc is not null"), every.where("pc is null")
        moved = open_.join(to, ["pc", "pd"]).select("c", "d", F.col("to.c").alias("pc"), F.col("to.d").alias("pd"), *((F.col(s) + F.col(f"to.{s}")).alias(s) for s in SUMS))
        then, (every, path) = last, written(shut.unionByName(moved), "expanded")
        if then:
            remove(spark, then)
        last = path
        if every.where("pc is not null").isEmpty():
            break
    return every.drop("pc", "pd")


def trie(rows: DataFrame) -> DataFrame:
    """The nodes of the rebuilt conversations: ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``."""
    turns, convs = rebuilt(rows)
    chains = materialize(prefixes(turns), "prefixes")
    keys = ["depth", "k1", "k2"]
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv").alias("c"), F.count("*").alias("n_convs")).where("n_convs > 0").select(*(zero.alias(k) for k in keys), "c", "n_convs", F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"), zero.alias("bytes"))
    inner = chains.groupBy(*keys).agg(F.min("conv").alias("c"), F.count("*").alias("n_convs"), F.first("p1").alias("p1"), F.first("p2").alias("p2"), F.first("bytes").alias("bytes"))
    nodes = materialize(root.unionByName(inner), "nodes")
    kids = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("c").alias("pc"))
    last = chains.where("depth = length").select("conv", *keys).union(convs.where("length = 0").select("conv", *(zero for _ in keys)))
    joined = nodes.join(kids, keys, "left").join(parents, ["depth", "p1", "p2"], "left").join(ends(last), keys, "left")
    n, size = F.coalesce("n_children", F.lit(0)), F.col("bytes")
    known = joined.select("c", F.col("depth").alias("d"), "pc", F.when(F.col("pc").isNotNull(), F.col("depth") - 1).alias("pd"), "n_convs", n.alias("n_children"),
                          F.coalesce("ends", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"), (n == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * size).alias("saved"))
    known = materialize(known, "known")
    sums = subtree_sums(known.select("c", "d", "pc", "pd", *SUMS)).select("c", "d", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    out = known.join(sums, ["c", "d"])
    return out.select(F.col("c").alias("conv_id"), F.col("d").alias("depth"), F.col("pc").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
