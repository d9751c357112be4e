"""Quality rules under weak supervision.

Each rule votes that a text is good (1) or bad (-1) or abstains (0). The number
of texts with each pattern of votes, of which there are at most 3^rules, is all
that expectation-maximisation needs to estimate the share of good texts and how
often each rule is right on good and on bad ones (Dawid and Skene, 1979; Ratner
et al., 2016). A text is kept if its posterior probability of being good
reaches ``KEEP``, so that one rule against a text can be outvoted.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .expressions import let, words
from .storage import fresh, materialize

SYMBOLS = "[#*$%&|<>]"
LEAST_WORDS, MOST_REPEATED = 50, 50
KEEP, ROUNDS = 0.5, 100
#: Where estimation starts, and what ``SMOOTH`` texts are added for: the share of good texts; a rule seldom doubts a good text and finds half of the bad ones.
PRIOR, START, SMOOTH = 0.6, (0.95, 0.5), 10.0
BOUNDS, SHARES = (0.01, 0.99), (0.05, 0.95)
#: Fields of the features, in order.
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_digits", "n_marks", "n_letters")


def _repeat_words(grams: Column, w: Column) -> Column:
    """Words in three-word windows that occur twice or more; where two hashes agree the words are compared."""
    three = lambda i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    placed = F.array_sort(F.transform(grams, lambda h, i: F.struct(h.alias("h"), three(i).alias("words"), i.alias("i"))))
    same = lambda p, k, x: (F.get(p, k)["h"] == x["h"]) & (F.get(p, k)["words"] == x["words"])
    twice = lambda p: F.filter(p, lambda x, k: same(p, k + 1, x) | ((k > 0) & same(p, k - 1, x)))
    # windows overlap: each one adds the words up to the next
    added = lambda at: F.aggregate(F.transform(at, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - x, F.lit(3)))), F.lit(0).cast("long"), lambda a, x: a + x)
    marked = lambda p: F.sort_array(F.transform(twice(p), lambda x: x["i"]))
    some = let(placed, lambda p: let(marked(p), added))
    return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0).cast("long")).otherwise(some)


def features(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` (all columns) with a struct of ``FEATURES`` (long) by the whole text, and its name. A null text has no words."""
    text, ws, lines, grams, name = fresh(docs.columns, "text_", "words_", "lines_", "grams_", "features")
    rows = docs.withColumn(text, F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = rows.withColumn(ws, words(F.col(text))).withColumn(lines, F.filter(F.split(text, "\n", -1), lambda x: F.regexp_like(x, F.lit("[^\\x20\\x09-\\x0D]"))))
    w = F.col(ws)
    rows = rows.withColumn(grams, F.transform(F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))))
    chars = lambda pattern: F.length(text) - F.length(F.regexp_replace(text, pattern, ""))
    parts = (
        F.size(ws), F.length(F.array_join(ws, "")), chars(f"{SYMBOLS}+"), F.size(lines) - F.size(F.array_distinct(lines)), _repeat_words(F.col(grams), w),
        F.size(lines), F.size(F.array_distinct(ws)), chars("\\p{Lu}+"), chars("[0-9]+"), chars("[!?]+"), F.length(F.regexp_replace(text, "\\P{L}+", "")),
    )
    return rows.withColumn(name, F.struct(*(p.cast("long").alias(n) for p, n in zip(parts, FEATURES, strict=True)))).drop(text, ws, lines, grams), name


def base_failed(f: Column) -> Column:
    return (f["n_words"] < LEAST_WORDS) | (100 * f["n_repeat_words"] > MOST_REPEATED * f["n_words"])


@dataclass(frozen=True)
class Vote:
    """A rule over the ratio of two features: bad outside ``bad``, good inside ``good`` (bounds included, None for none), between them no vote."""

    name: str
    over: str
    under: str
    bad: tuple[float | None, float | None]
    good: tuple[float | None, float | None]

    def column(self, f: Column) -> Column:
        ratio = f[self.over] / F.greatest(f[self.under], F.lit(1))
        low, high = self.bad
        bad = (F.lit(False) if low is None else ratio <= low) | (F.lit(False) if high is None else ratio >= high)
        low, high = self.good
        good = (F.lit(True) if low is None else ratio >= low) & (F.lit(True) if high is None else ratio <= high)
        return F.when(bad, -1).when(good, 1).otherwise(0)


VOTES = (
    Vote("symbols", "n_symbols", "n_words", (None, 0.1), (None, 0.02)),
    Vote("letters", "n_letters", "word_chars", (0.9, None), (0.93, None)),
    Vote("length", "word_chars", "n_words", (4.2, 7.2), (4.5, 6.5)),
    Vote("capitals", "n_upper", "n_letters", (None, 0.4), (None, 0.1)),
    Vote("marks", "n_marks", "n_words", (None, 0.4), (None, 0.1)),
    Vote("digits", "n_digits", "word_chars", (None, 0.2), (None, 0.1)),
    Vote("repeats", "n_repeat_words", "n_words", (None, 0.4), (None, 0.1)),
    Vote("variety", "n_distinct", "n_words", (0.15, None), (0.5, None)),
    Vote("lines", "n_dup_lines", "n_lines", (None, 0.4), (None, 0.2)),
)


@dataclass(frozen=True)
class Model:
    """The share of good texts, and for each rule how often its votes are right on good and on bad texts."""

    share: float
    good: tuple[float, ...]
    bad: tuple[float, ...]

    def weights(self) -> tuple[float, list[float], list[float]]:
        """Log-odds: before any vote, and added by each rule's vote for good and for bad."""
        return math.log(self.share / (1 - self.share)), [math.log(a / (1 - b)) for a, b in zip(self.good, self.bad, strict=True)], [math.log((1 - a) / b) for a, b in zip(self.good, self.bad, strict=True)]

    def posterior(self, votes: tuple[int, ...]) -> float:
        """Probability that a text with these votes is good."""
        start, up, down = self.weights()
        return 1 / (1 + math.exp(-start - sum(up[j] if v > 0 else down[j] for j, v in enumerate(votes) if v)))


def fit(patterns: dict[tuple[int, ...], int], rules: int) -> Model:
    """The model by expectation-maximisation.

    A rule that votes alike on good and bad texts comes to weigh nothing, and
    none may count against itself. Without texts, or votes, the start is
    returned; ``SMOOTH`` texts of the start are always added.
    """
    clip = lambda x, bounds: min(bounds[1], max(bounds[0], x))
    model = Model(PRIOR, (START[0],) * rules, (START[1],) * rules)
    for _ in range(ROUNDS):
        share = [SMOOTH * PRIOR, SMOOTH]
        right, cast = ([[SMOOTH * x] * rules for x in START], [[SMOOTH] * rules for _ in START])
        for votes, times in patterns.items():
            p = model.posterior(votes)
            share[0] += p * times
            share[1] += times
            for j, v in enumerate(votes):
                if v:
                    for side, part in enumerate((p * times, (1 - p) * times)):
                        cast[side][j] += part
                        right[side][j] += part * (v == (1, -1)[side])
        good = tuple(clip(r / c, BOUNDS) for r, c in zip(right[0], cast[0], strict=True))
        bad = tuple(max(clip(r / c, BOUNDS), 1 - g) for r, c, g in zip(right[1], cast[1], good, strict=True))
        model = Model(clip(share[0] / share[1], SHARES), good, bad)
    return model


def judge(rows: DataFrame, features_col: str, votes: tuple[Vote, ...] = VOTES, prob_col: str = "quality") -> DataFrame:
    """``rows`` with the posterior probability that each is good; the model is fitted on all that pass the base rules."""
    cast = [v.column(F.col(features_col)) for v in votes]
    names = [f"v{i}" for i in range(len(votes))]
    passing = rows.where(~base_failed(F.col(features_col)))
    # at most 3 ** rules rows come to the driver
    counts = passing.select(*(c.alias(n) for c, n in zip(cast, names, strict=True))).groupBy(*names).count().collect()
    odds, up, down = fit({tuple(r[:-1]): r[-1] for r in sorted(counts)}, len(votes)).weights()
    odds = F.lit(odds)
    for c, u, d in zip(cast, up, down, strict=True):
        odds = odds + F.when(c > 0, u).when(c < 0, d).otherwise(0.0)
    return rows.withColumn(prob_col, 1 / (1 + F.exp(-odds)))


def assess(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, features, quality, base_failed, kept)`` for every row of ``docs``.

    Null and empty texts have no words, so they fail the base. Repeated rows
    count as often as they occur. On an empty table nothing is fitted. Very
    long texts are measured whole.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    made, name = features(rows)
    made = materialize(made.select("doc_id", F.col(name).alias("features")), "features")
    failed = base_failed(F.col("features"))
    return judge(made, "features").withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("quality") >= KEEP))


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns) that are kept; the others go."""
    made, name = features(docs, text_col)
    made = materialize(made, "documents_with_features")
    prob, = fresh(made.columns, "quality")
    judged = judge(made, name, prob_col=prob)
    return judged.where(~base_failed(F.col(name)) & (F.col(prob) >= KEEP)).select(*docs.columns)
