import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from palimpsest.llm import queries, suffixdedup

SHAPE = "doc_id long, text string, kept string, removed string, core string, doc string"


def brute(texts, length=200):
    """(bytes, removed, spans, left) of each text, window by window."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[s : s + length] for r in raw for s in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = np.zeros(len(r) + 2, bool)
        for s in range(len(r) - length + 1):
            if seen[r[s : s + length]] > 1:
                gone[s + 1 : s + 1 + length] = True
        left = bytes(b for b, g in zip(r, gone[1:-1], strict=True) if not g)
        out.append((len(r), int(gone.sum()), int((np.diff(gone.astype(int)) > 0).sum()), left))
    return out


def run(spark, texts):
    """In the texts' order: each has its place as doc_id, and a second row without one is left out of what comes back."""
    df = spark.createDataFrame([(i, t, "a", "b", "c", "d") for i, t in enumerate(texts)], SHAPE).repartition(3)
    out, kept, size, spans = suffixdedup.remove_repeats(df)
    assert out.columns[:6] == ["doc_id", "text", "kept", "removed", "core", "doc"] and (kept, spans) == ("kept_", "removed_")
    rows = {r.doc_id: r for r in out.collect()}
    assert len(rows) == len(texts)
    return [(rows[i][size], sum(s.end - s.start for s in rows[i][spans]), len(rows[i][spans]), bytes(rows[i][kept])) for i in range(len(texts))]


def text(rng, n, alphabet="abcdefghijklmnop qrstuvwxyzé"):
    return "".join(rng.choice(alphabet) for _ in range(n))


def awkward(seed):
    rng = random.Random(seed)
    a, b, c = text(rng, 1500), text(rng, 700), text(rng, 230)
    near = a[:700] + "X" + a[701:]
    texts = [a, a, near, b + c, c + text(rng, 400), text(rng, 50) + c[:198] + text(rng, 50), text(rng, 300) + c[5:] + b[:250] + text(rng, 10)]
    texts += [b[100:299], b[100:300], b[100:301], None, "", "short", "short", "é" * 150, "x" * 1000, "ab" * 300, "x" * 199, "x" * 200, text(rng, 40) * 9]
    return texts + [text(rng, 500) for _ in range(5)] + [text(rng, 200, "ab") for _ in range(5)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    texts = awkward(seed)
    assert run(spark, texts) == brute(texts)


def test_crowded_cores_and_small_buffers(spark, monkeypatch):
    """A passage in many surroundings, beyond what one index takes, and texts cut into several buffers."""
    monkeypatch.setattr(suffixdedup, "CROWD", 5)
    monkeypatch.setattr(suffixdedup, "CHUNK", 1000)
    rng = random.Random(5)
    common, close = text(rng, 240), text(rng, 190)
    texts = [text(rng, 30 + i) + common[i % 30 :] + text(rng, 60) for i in range(40)]
    texts += [text(rng, 30) + close + ("same tail" if i % 3 else text(rng, 9)) + text(rng, 60) for i in range(40)] + awkward(6) + [text(rng, 4000)] * 2
    assert run(spark, texts) == brute(texts)


def test_long_text(spark):
    rng = random.Random(7)
    block = text(rng, 5000)
    texts = ["".join(text(rng, 20_000) for _ in range(100)) + block + "y" * 3000, block[1000:1400]]
    got = run(spark, texts)
    assert [g[:3] for g in got] == [(got[0][0], len(block[1000:1400].encode()) + 3000, 2), (len(texts[1].encode()),) * 2 + (1,)]


def test_empty_table(spark):
    assert run(spark, []) == [] and run(spark, [None, None, ""]) == [(0, 0, 0, b"")] * 3


@pytest.mark.parametrize("seed", range(6))
def test_index_against_brute_force(seed):
    """Matching statistics of small alphabets, with repeats inside and between phrases, and with phrases counted twice."""
    rng = random.Random(seed)
    base = bytes(rng.choice(b"ab\0") for _ in range(40))
    phrases = sorted({bytes(rng.choice(b"ab\0") for _ in range(rng.randint(1, 30))) + base[rng.randint(0, 30) :] for _ in range(8)})
    counts = np.array([rng.choice([1, 1, 2]) for _ in phrases])
    best, starts = suffixdedup.longest_matches(phrases, counts)
    for k, p in enumerate(phrases):
        for i in range(len(p)):
            others = [q[j:] for m, q in enumerate(phrases) for j in range(len(q)) if (m, j) != (k, i) or counts[k] > 1]
            same = lambda q: next((x for x, (s, t) in enumerate(zip(p[i:], q, strict=False)) if s != t), min(len(p) - i, len(q)))
            assert best[starts[k] + i] == max(map(same, others), default=0)


def test_index_samples_run_ends_only():
    """Of a text with many copies the transform has few runs, and without the samples at their ends nothing is matched."""
    rng = random.Random(1)
    base = bytes(rng.randrange(97, 123) for _ in range(300))
    phrases = [base[: 150 + k] + b"%d" % k for k in range(60)]
    sizes = np.array([len(p) for p in phrases])
    ends = np.cumsum(sizes + 1) - 1
    rest = ends[np.repeat(np.arange(60), sizes + 1)] - np.arange(ends[-1] + 1)
    raw = np.frombuffer(b"\0".join(phrases) + b"\0", np.uint8)
    symbols = np.where(rest > 0, raw.astype(np.int64), -1)
    heads, lengths, first, last = suffixdedup.run_ends(symbols, suffixdedup.suffix_array(symbols, rest))
    assert lengths.sum() == len(raw) and len(heads) < len(raw) / 10


def test_query(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: (*w[:3], hashlib.sha256(w[3]).hexdigest()) for r, w in zip(rows, brute([r.text for r in rows]), strict=True)}
    found = queries.QUERIES["op12_suffix_dedup"](spark, sf).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == want and len(found) == len(rows)
    assert 0 < sum(w[1] for w in want.values()) < sum(w[0] for w in want.values())


def test_edges_come_from_the_index(spark, monkeypatch):
    """Without what the indexes find, whole phrases that repeat would go, and passages would keep their edges."""
    texts = awkward(1)
    monkeypatch.setattr(suffixdedup, "_repeated", lambda rows, length: rows.select("core", "phrase", *(rows.n.alias(c) for c in ("start", "end"))).limit(0))
    got = [g[1] for g in run(spark, texts)]
    want = [w[1] for w in brute(texts)]
    assert all(g <= w for g, w in zip(got, want, strict=True)) and sum(g < w for g, w in zip(got, want, strict=True)) > 4
