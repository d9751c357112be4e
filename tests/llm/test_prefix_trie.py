import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from palimpsest.llm import prefixtrie, queries

SHAPE = "conv_id long, turn long, role string, text string, depth string, c string, kids string"


def brute(rows):
    """Node by node, as the contract says it."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    members = defaultdict(set)
    whole = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c > 0 else -1)
        whole[c] = tuple(own.get(base, [])[:h] + ts[h:])
        for d in range(len(whole[c]) + 1):
            members[whole[c][:d]].add(c)
    out = {}
    for node, cs in members.items():
        kids = [k for k in members if len(k) == len(node) + 1 and k[: len(node)] == node]
        below = [k for k in members if k[: len(node)] == node]
        saved = sum((len(members[k]) - 1) * len(k[-1][1].encode()) for k in below if k)
        leaves = sum(not any(len(x) == len(k) + 1 and x[: len(k)] == k for x in below) for k in below)
        ends = ",".join(map(str, sorted(c for c in cs if whole[c] == node)))
        out[min(cs), len(node)] = (min(members[node[:-1]]) if node else None, len(cs), len(kids), leaves, saved, hashlib.sha256(ends.encode()).hexdigest())
    return out


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SHAPE)
    found = prefixtrie.trie(df).collect()
    got = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in found}
    assert len(got) == len(found)
    return got


def awkward():
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", None]), rng.choice(["a", "bb", "é", "", None])) for c in range(40) for t in rng.choices([None, 0, 1, 2, 3], k=rng.randint(1, 6))]
    rows += [(c, None, "user", "same") for c in (41, 42, 43, 45) for _ in range(3)] + [(None, 1, "user", "lost"), (-7, 1, "r", "t"), (-5, 1, "r", "u"), (2**40 + 1, 5, "role:", ":x")]
    return rows


def test_trie_against_brute_force(spark):
    rows = awkward()
    assert run(spark, rows) == brute(rows)


def test_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "BLOCK", 3)
    monkeypatch.setattr(prefixtrie, "SPAN", 4)
    rows = awkward() + [(60, t, "user", "long" * (t % 3)) for t in range(30)] + [(65, t, "user", "long" * (t % 3)) for t in range(40)]
    assert run(spark, rows) == brute(rows)


def test_caterpillar(spark):
    """A deep spine whose smallest member changes at every turn: one node a path, so only splices across paths shorten it."""
    rows = [(5 * c, t, "user", str(t)) for c in range(40) for t in range(c + 1)] + [(5 * c, c + 1, "user", f"own {c}") for c in range(40)]
    assert run(spark, rows) == brute(rows)


def test_hot_conversation_and_hot_node(spark):
    rows = [(10, t, "user", str(t)) for t in range(700)] + [(5 * c, 0, "user", "first") for c in range(3, 400)]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(None, 1, "a", "b")], [(1, None, None, None)], [(0, 0, "", "x" * 1_000_000), (1, 0, "", "x" * 1_000_000)]])
def test_edges(spark, rows):
    assert run(spark, rows) == brute(rows)


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = queries.QUERIES["op11_prefix_trie"](spark, sf).collect()
    assert {(r.conv_id, r.depth): tuple(r[2:]) for r in found} == brute(rows) and len(found) == len(brute(rows))
