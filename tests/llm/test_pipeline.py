import hashlib
import random

import brute
import fixtures
import numpy as np

import corpus_pipeline
from palimpsest.llm import quality


def test_pipeline_against_brute_force(spark, tmp_path):
    rng = random.Random(8)
    clean = [fixtures.prose(rng, 120) for _ in range(12)]
    item = fixtures.prose(rng, 30)
    texts = clean + [clean[3], clean[4] + "\nmore words at the end of it", "%%% a### b&&& " * 60, "short", clean[5].replace(".", "") + " " + item, "\n".join(clean[0].split("\n")[2:9] + clean[7].split("\n"))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], fixtures.DOCS)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert found.columns[:5] == docs.columns
    kept = found.collect()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in kept}
    assert all(hashlib.sha256(r.ids).hexdigest() == r.ids_sha256 and hashlib.sha256(r.text.encode()).hexdigest() == r.decoded_sha256 and len(r.text) == r.n_chars for r in kept)

    judged = {r.doc_id: r.kept for r in quality.assess(docs).collect()}  # its own test holds it against the contract
    rows = [(i, t) for i, t in enumerate(texts) if judged[i]]
    before = dict(rows)
    rows = [(d, t) for d, t in brute.line_dedup(rows).items() if t == before[d] or t.strip()]
    least = brute.components([(d, brute.fingerprint(t)) for d, t in rows])
    rows = [(d, t) for d, t in rows if least[d] == d]
    bad = {d for d, _ in brute.leaks(rows, [(0, item)])}
    enc = brute.tiktoken_encoding()
    want = {}
    for d, t in rows:
        if d not in bad:
            ids = enc.encode_ordinary(t)
            want[d] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
    assert got == want and set(range(12)) <= set(got) | bad


def test_pipeline_on_awkward_rows(spark, tmp_path):
    """Null text, null and repeated ids, equal rows, no rows, and columns named like those the stages add."""
    rng = random.Random(18)
    one, two, three = (fixtures.prose(rng, 120) for _ in range(3))
    rows = [(1, one, "en", "s", 1, 7), (1, two, "en", "s", 1, 8), (1, one, "en", "s", 1, 7), (2, None, "en", "s", 0, 7), (None, three, "en", "s", 1, 7), (None, three, "en", "s", 1, 7), (3, "", "en", "s", 0, 7), (4, one, "en", "s", 1, 7)]
    for name, some in (("all", rows), ("none", [])):
        docs = spark.createDataFrame(some, "doc_id long, text string, lang string, source string, n_chars long, ids int")
        (tmp_path / name).mkdir()
        docs.write.parquet(str(tmp_path / name / "documents.parquet"))
        spark.createDataFrame([(0, "never seen words of a benchmark item in any text")], "item_id long, text string").write.parquet(str(tmp_path / name / "benchmark.parquet"))
        found = corpus_pipeline.run(spark, str(tmp_path / name))
        assert found.columns == [*docs.columns, "ids_", "n_tokens", "ids_sha256", "decoded_sha256"]
        got = sorted((r.doc_id or 0, r.text[:20], r["ids"]) for r in found.collect())
        # both texts of id 1 stay, equal rows once; rows without an id can't be told apart; 4 has nothing left and goes
        want = [(0, three[:20], 7)] * 2 + sorted([(1, one[:20], 7), (1, two[:20], 8)]) if some else []
        assert got == want


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "byte_bpe"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns
