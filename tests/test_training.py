import random

import pytest
from pyspark.sql import functions as F

from palimpsest.functions import alignment
from palimpsest.functions.alignment import cut_lines, word_cost
from palimpsest.operators import models, training
from palimpsest.plans import inputs
from palimpsest.plans import training as plans


def aligned(heard, words):
    """Least cost of aligning words, cell by cell."""
    row = [float(j) for j in range(len(words) + 1)]
    for h in heard:
        last, row[0] = row[0], row[0] + 1
        for j, w in enumerate(words, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + word_cost(h, w))
    return row[-1]


@pytest.mark.parametrize("seed", range(20))
def test_cut_lines_is_optimal(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdnr") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 40))]
    at = sorted(rng.choices(range(len(words) + 1), k=rng.randint(0, 6)))
    lines = [" ".join(words[a:b]) for a, b in zip([0, *at], [*at, len(words)], strict=True)]
    heard = ["".join(c if rng.random() < 0.8 else rng.choice(["", "x", c + c, " "]) for c in x) for x in lines]
    cut = cut_lines(heard, " ".join(words))
    assert len(cut) == len(heard) and " ".join(x for x in cut if x).split(" ") == words
    assert abs(sum(aligned(h.split(), c.split()) for h, c in zip(heard, cut, strict=True)) - aligned(" ".join(heard).split(), words)) < 1e-4


def test_cut_lines_edges():
    assert cut_lines([], "any") == [] and cut_lines([""], "one two") == ["one two"] and cut_lines(["a", "b"], "") == ["", ""] and cut_lines(["", "a b", ""], "a b") == ["", "a b", ""]
    assert cut_lines(["one tvo", "thre", "four"], "one two three four") == ["one two", "three", "four"]
    long = [" ".join(f"w{i * 12 + k}" for k in range(12)) for i in range(400)]
    assert cut_lines([x.replace("1", "l") for x in long], " ".join(long)) == long


def test_align_transcripts(spark):
    lines = spark.createDataFrame([(1, 1, "tvo"), (1, 0, "0ne"), (2, 0, "lost"), (3, 0, None)], "page long, line_id int, text string")
    texts = spark.createDataFrame([(1, "one\n two "), (3, "all of it"), (4, "nobody heard")], "page long, transcript string")
    got = {(r.page, r.line_id): r.transcript for r in training.align_transcripts(lines, texts).collect()}
    assert got == {(1, 0): "one", (1, 1): "two", (2, 0): None, (3, 0): "all of it"}


def test_transcript_lines_query(spark, sf):
    """Lines whose recognised text is spoilt in many places come back as they were, but for words that line up as well on either side of a cut."""
    want = {(r.doc_id, r.line_id): r.transcript for r in inputs.lines(spark, sf).collect()}
    got = {(r.page, r.line_id): r.transcript for r in plans.transcript_lines(spark, sf).collect()}
    assert set(got) == set(want) and sum(got[k] == want[k] for k in want) >= 0.99 * len(want)


def test_weighted_sample(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 8.0).when(F.col("id") % 3 == 1, 1.0).alias("weight"))
    some = [r.id for r in training.weighted_sample(rows, 300, ["id"]).collect()]
    assert len(set(some)) == 300 and not any(i % 3 == 2 for i in some)
    heavy = sum(i % 3 == 0 for i in some)
    assert 240 < heavy < 290 and some == [r.id for r in training.weighted_sample(rows.repartition(7), 300, ["id"]).collect()]
    assert some != [r.id for r in training.weighted_sample(rows, 300, ["id"], seed=1).collect()]
    assert training.weighted_sample(rows, 5000, ["id"]).count() == 2000 and training.weighted_sample(rows.limit(0), 5, ["id"]).count() == 0


def test_rarity(spark):
    lines = spark.createDataFrame([(1, "aab"), (2, "ab"), (3, "az"), (4, ""), (5, None)], "id int, transcript string")
    assert {r.id: (r.rarest, r.weight) for r in training.rarity(lines, ["id"]).collect()} == {1: (2, 0.5), 2: (2, 0.5), 3: (1, 1.0)}


def test_split_lines(spark):
    pages = spark.createDataFrame([("a", 0, "train"), ("a", 1, "val"), ("b", 0, "train"), (None, 0, "train")], "source_id string, page_id int, split string")
    lines = spark.createDataFrame([("a", 0), ("a", 0), ("b", 0), (None, 0), ("c", 9)], "source_id string, page_id int")
    assert {r.split: (r.pages, r.lines, r.sources) for r in training.split_lines(pages, lines).collect()} == {"train": (3, 4, ["a", "b"]), "val": (1, 0, ["a"])}


def test_models(spark, tmp_path):
    path = f"file://{tmp_path}/models"
    assert models.describe(spark, path, ["x"]).first().error == "missing" and models.describe(spark, path).count() == 0
    with pytest.raises(FileNotFoundError):
        models.require(spark, path, "x")
    counts = spark.createDataFrame([("a", 3), ("b", 1)], "ch string, n long")
    assert models.register(spark, path, "x", "counts", models.train_characters(counts.where("n > 1"))) == 1
    assert models.register(spark, path, "x", "counts", models.train_characters(counts)) == 2 and models.register(spark, path, "y", "counts", b"") == 1
    told = {(r.name, r.version): (r.latest, r.bytes) for r in models.describe(spark, path).collect()}
    assert told == {("x", 1): (False, 4), ("x", 2): (True, 9), ("y", 1): (True, 0)}
    assert models.require(spark, path, "x", 1) == b"97 3" and models.require(spark, path, "x") == b"97 3\n98 1"
    with pytest.raises(FileNotFoundError):
        models.require(spark, path, "x", 3)
    score = models.applied(spark, models.require(spark, path, "x"), models.characters, "double")
    rows = spark.createDataFrame([("aab",), ("",), ("c",)], "t string").select("t", score("t").alias("s")).collect()
    assert [None if r.s is None else round(r.s, 6) for r in rows] == [-0.653886, None, -2.079442]


def test_model_is_built_once_per_process(spark):
    built = []
    payload = models._Payload(b"abc")
    build = lambda raw: built.append(raw) or (lambda s: s)
    assert models._built(build, "digest", payload) is models._built(build, "digest", models._Payload(b"abc")) and built == [b"abc"]


def test_texts_are_aligned_at_once():
    """Text by text, a word took some twenty calls of numpy, and the table was as wide as the whole cost; now texts share the calls and only words more or less widen it."""
    rng = random.Random(5)
    common = ["on", "or", "the", "in", *("".join(rng.choice("abcdenrst") for _ in range(6)) for _ in range(300))]
    whole, heard = [], []
    for n in (1, 7, 30, 400, 400, 900, 0, 2500):
        words = [rng.choice(common) for _ in range(n)]
        whole.append(" ".join(words))
        heard.append([" ".join(words[k : k + 12]).translate(str.maketrans("nr", "rn")).replace(" the ", " ") for k in range(0, n, 12)])
    one_by_one = [alignment.cut_lines(h, w) for h, w in zip(heard, whole, strict=True)]
    calls, within = [], alignment._cuts_within
    alignment._cuts_within = lambda pairs, *a: calls.append(sum(p.width * len(p.heard) for p in pairs)) or within(pairs, *a)
    try:
        assert alignment.cut_texts(heard, whole) == one_by_one
        assert sum(calls) < 2500 * 2500 // 2
    finally:
        alignment._cuts_within = within
    got = alignment.cut_texts([["lost words here", ""], [], ["a"]], ["quite another text of it all", "no lines", ""])
    assert got[1:] == [[], [""]] and " ".join(got[0]).split() == "quite another text of it all".split()
