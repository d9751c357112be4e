import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from palimpsest.functions import kernels
from palimpsest.operators import confidence, decode, lexicon
from palimpsest.plans.inputs import VOCAB as LONG
from palimpsest.sources import files
from palimpsest.streaming import lines as streams

VOCAB = ["<blank>", " ", *map(chr, range(97, 123))]
INDEX = {"_": 0, **{c: VOCAB.index(c) for c in VOCAB[1:]}}


def one_hot(text, low=-10.0):
    return [[0.0 if c == INDEX[k] else low for c in range(28)] for k in text]


def logits(spark, lines):
    rows = [(i, t, step) for i, steps in enumerate(lines) for t, step in reversed(list(enumerate(steps)))]
    return spark.createDataFrame(rows, "line_id long, t int, log_probs array<double>")


CASES = {"hho_oll_a": "hoola", "hh_oll_a": "hola", "aaa": "a", "a_a": "aa", "___": "", "d_e": "de"}


def test_greedy(spark):
    got = {r.line_id: r for r in decode.greedy(logits(spark, map(one_hot, CASES)), VOCAB).collect()}
    assert [got[i].text for i in range(len(CASES))] == list(CASES.values())
    assert got[2].raw_indices == [2, 2, 2] and got[2].token_indices == [2]


def test_argmax_takes_the_first(spark):
    row = spark.createDataFrame([([1.0, 3.0, 3.0],)], "p array<double>").select(decode.best_class(F.col("p")).alias("k"), decode.log_softmax(F.col("p")).alias("s"), decode.log_sum_exp(F.lit(-1.0), F.lit(-3.0)).alias("l")).first()
    assert row.k == 1 and np.allclose(row.s, np.array([1, 3, 3]) - np.log(np.exp([1, 3, 3]).sum())) and math.isclose(row.l, np.logaddexp(-1, -3))


def test_confidence(spark):
    steps = np.log(np.array([[0.1, 0.1, 0.8], [0.1, 0.2, 0.7], [0.9, 0.05, 0.05], [0.2, 0.1, 0.7], [0.2, 0.6, 0.2]])).tolist()
    rows = {r.line_id: r for r in confidence.scored(logits(spark, [steps, [[0.0, -9.0, -9.0]]]), ["_", "a", "b"]).collect()}
    assert rows[0].text == "bba" and np.allclose(rows[0].token_confidence, [0.8, 0.7, 0.6])
    assert math.isclose(rows[0].sequence_confidence, (0.8 * 0.7 * 0.6) ** (1 / 3)) and rows[1].sequence_confidence == 0.0 and rows[1].token_confidence == []
    assert math.isclose(spark.range(1).select(confidence.sequence_confidence(F.array(F.lit(0.0), F.lit(1.0))).alias("c")).first().c, 1e-6)


def test_beam(spark):
    lines = spark.createDataFrame([(0, one_hot("d_e")), (1, one_hot("aaa")), (2, one_hot("abc"))], "line_id long, log_probs array<array<double>>")
    best = lambda **kw: {(r.line_id, r.rank): r for r in decode.beam(lines, VOCAB, width=5, **kw).collect()}
    simple, exact = best(), best(mode="exact")
    assert simple[0, 0].text == exact[0, 0].text == "de" and simple[1, 0].text == "aa" and exact[1, 0].text == "a"
    assert max(r for _, r in best(most=2)) == 1
    scores = [simple[2, r].score for r in range(5)]
    assert scores == sorted(scores, reverse=True)
    with pytest.raises(ValueError):
        decode.beam(lines, VOCAB, mode="other")
    with pytest.raises(ValueError):
        decode.check_vocab(VOCAB, 5)


def test_beam_keeps_going_past_bad_lines(spark):
    lines = spark.createDataFrame([(0, one_hot("d_e")), (1, None), (2, [[0.0] * 28, [0.0] * 3]), (3, [[0.0, 1.0]]), (4, [])], "line_id long, log_probs array<array<double>>")
    for mode in ("simple", "exact"):
        got = {r.line_id: r for r in decode.beam(lines, VOCAB, most=1, mode=mode, errors=True).collect()}
        assert got[0].text == "de" and got[0].error is None and all(got[k].text is None and got[k].error for k in range(1, 5)) and "vocabulary" in got[3].error
    with pytest.raises(Exception, match="steps by classes"):
        decode.beam(lines.where("line_id = 1"), VOCAB).collect()


def probabilities(rng, steps, classes):
    p = rng.random((steps, classes)) ** 3
    return np.log(p / p.sum(1, keepdims=True))


def all_paths(steps, blank=0):
    out = {}
    for path in itertools.product(range(steps.shape[1]), repeat=len(steps)):
        key = tuple(k for i, k in enumerate(path) if k != blank and (i == 0 or path[i - 1] != k))
        out[key] = np.logaddexp(out.get(key, -np.inf), sum(steps[t, k] for t, k in enumerate(path)))
    return out


def test_exact_search_and_loss_equal_the_sum_over_all_paths():
    rng = np.random.default_rng(0)
    for _ in range(20):
        steps = probabilities(rng, 5, 4)
        want = all_paths(steps)
        got = {tuple(k): s for _, s, k in kernels.beam_exact(steps, ["_", "a", "b", "c"], 0, 10_000)}
        assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], abs_tol=1e-9) for k in want)
        for key, lp in list(want.items())[:20]:
            assert math.isclose(kernels.ctc_loss(steps, list(key), 0), -lp, abs_tol=1e-9)
    assert kernels.ctc_loss(steps, [1, 1, 1, 1], 0) == math.inf


def slow_simple(steps, blank, width):
    """The rules of the simple mode over lists instead of dicts."""
    beams = [[(), 0.0, None, False]]
    for row in steps:
        new = []
        for key, score, last, ended in beams:
            for k, s, la, en in [(key, score + row[blank], last, True)] + [(key, score + lp, c, False) if c == last and not ended else ((*key, c), score + lp, c, False) for c, lp in enumerate(row) if c != blank]:
                old = [b for b in new if b[0] == k]
                if old:
                    old[0][1] = float(np.logaddexp(old[0][1], s))
                else:
                    new.append([k, s, la, en])
        beams = sorted(new, key=lambda b: -b[1])[:width]
    return [(list(b[0]), b[1]) for b in beams]


def test_simple_search_follows_its_rules():
    rng = np.random.default_rng(1)
    for _ in range(20):
        steps = probabilities(rng, 6, 4)
        got = [(k, s) for _, s, k in kernels.beam_simple(steps, ["_", "a", "b", "c"], 0, 4)]
        want = slow_simple(steps, 0, 4)
        assert [k for k, _ in got] == [k for k, _ in want] and np.allclose([s for _, s in got], [s for _, s in want])


def test_lexicon_bonus_in_search():
    steps = np.log(np.array([[0.05, 0.05, 0.5, 0.4], [0.05, 0.85, 0.05, 0.05]]))
    vocab = ["_", " ", "a", "b"]
    assert kernels.beam_simple(steps, vocab, 0, 5)[0][0] == "a "
    assert kernels.beam_simple(steps, vocab, 0, 5, kernels.WordBonus({"b": 3.0}, 1.0, 0.0))[0][0] == "b "
    assert kernels.WordBonus({"b": 3.0}, 0.0, 1.0)("b") == 0.0 and kernels.WordBonus({"rey": 2.0}, 1.0, 0.5)("el rey  ") == pytest.approx(math.log(2.0) + 0.5)


def test_losses_and_padding(spark):
    rows = spark.createDataFrame([(0, one_hot("ab"), [2, 3]), (1, one_hot("a"), [2, 3])], "line_id long, log_probs array<array<double>>, target array<int>")
    assert {r.line_id: r.loss for r in decode.ctc_losses(rows).collect()} == {0: 0.0, 1: 0.0}
    assert spark.range(1).select(decode.padded(F.array(F.lit(1.0)), 3).alias("p")).first().p == [1.0, 0.0, 0.0]


def test_lexicon(spark, tmp_path):
    (tmp_path / "lex.txt").write_text("  dios\nrey 2.0\n\n# comment\nfoo x extra\nrey 3.5\n")
    words = files.read_lexicon(spark, str(tmp_path / "lex.txt"))
    assert {r.word: r.score for r in words.collect()} == {"dios": 1.0, "rey": 3.5, "foo": 1.0}
    (tmp_path / "again.txt").write_text("".join(f"w{i % 7} {i}\n" for i in range(500)))
    assert {r.word: r.score for r in files.read_lexicon(spark, str(tmp_path / "again.txt")).collect()} == {f"w{i % 7}": float(i) for i in range(493, 500)}
    assert lexicon.size(words).first().n == 3
    files.write_lexicon(words, str(tmp_path / "out"))
    assert sorted(files.read_lexicon(spark, str(tmp_path / "out")).collect()) == sorted(words.collect())
    rows = spark.createDataFrame([("rey",), ("Rey",), ("dios",), ("rey",)], "word string")
    assert lexicon.known(rows, words).count() == 3 and lexicon.from_words(rows).count() == 3
    assert {(r.word, r.score, r.hit) for r in lexicon.scores(rows, words).collect()} == {("rey", 3.5, True), ("Rey", 0.0, False), ("dios", 1.0, True)}
    texts = spark.createDataFrame([("el rey ",), ("el rey",), ("foo",), ("rey  ",), (" ",)], "text string")
    bonus = {r.text: r.bonus for r in lexicon.boundary_score(texts, words, 1.0, 0.5).collect()}
    assert bonus["el rey "] == bonus["rey  "] == pytest.approx(math.log(3.5) + 0.5) and bonus["el rey"] == bonus["foo"] == bonus[" "] == 0.0


def test_stream_decodes_like_a_batch(spark, tmp_path):
    rows = spark.createDataFrame([(i, one_hot(k)) for i, k in enumerate(CASES)], "line_id long, log_probs array<array<double>>")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    decoded = streams.flag(streams.decode_lines(stream, VOCAB)).select("line_id", "text", "gate")
    query = decoded.writeStream.format("memory").queryName("decoded_lines").trigger(availableNow=True).start()
    query.awaitTermination(60)
    got = {r.line_id: (r.text, r.gate) for r in spark.table("decoded_lines").collect()}
    assert [got[i][0] for i in range(len(CASES))] == list(CASES.values()) and got[4][1] == "flagged"
    done = streams.each_batch(stream, lambda b: b.groupBy().count(), str(tmp_path / "out"), str(tmp_path / "check"))
    done.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).agg(F.sum("count")).first()[0] == len(CASES)


def test_stream_counts_by_window(spark, tmp_path):
    rows = spark.sql("select timestamp'2024-01-01 00:10:00' ts, 0.1D sequence_confidence union all select timestamp'2024-01-01 00:20:00', 0.9D union all select timestamp'2024-01-02 00:20:00', 0.9D")
    rows.write.parquet(str(tmp_path / "in"))
    stream = streams.gate_counts(streams.flag(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))))
    query = stream.writeStream.format("memory").queryName("gate_counts").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert {(r.gate, r.n) for r in spark.table("gate_counts").collect()} == {("flagged", 1), ("accepted", 1)}


def test_default_vocabulary():
    assert len(LONG) == 64 and LONG[0] == "<blank>" and LONG[1] == " "
