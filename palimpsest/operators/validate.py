"""Validation of correction candidates: the first check that fails rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import characters, strip, tokens

ACCEPTED, REJECTED, PASSED = "accepted", "rejected", "all checks passed"
MOST_RATIO = 2.0
#: Words of a lexicon up to which each row is tested where it is, by a set in the plan.
SMALL = 5000


def length_ratio(original: Column, candidate: Column) -> Column:
    return F.greatest(F.length(candidate), F.lit(1)) / F.greatest(F.length(original), F.lit(1))


def foreign_characters(candidate: Column, allowed: str) -> Column:
    return F.array_sort(F.array_except(F.array_distinct(characters(candidate)), F.array(*(F.lit(c) for c in sorted(set(allowed))))))


def lexicon_hits(audit: DataFrame, lexicon: DataFrame) -> DataFrame:
    """``(text_a, text_b, original_hit, candidate_hit)`` for the pairs of texts of which either has a listed word: one join for both, each pair once, counted before the shuffle back."""
    def sided(side: int, text: str) -> Column:
        return F.transform(F.array_distinct(tokens(F.col(text))), lambda w: F.struct(F.lit(side).alias("side"), w.alias("word")))

    pair = ["text_a", "text_b"]
    both = F.explode(F.concat(sided(0, "text_a"), sided(1, "text_b")))
    words = audit.select(F.col("input_text").alias("text_a"), F.col("candidate_text").alias("text_b")).distinct().select(*pair, both.alias("w")).select(*pair, "w.side", "w.word")
    hits = words.join(lexicon.select("word"), "word", "left_semi")
    return hits.groupBy(*pair).agg(F.bool_or(F.col("side") == 0).alias("original_hit"), F.bool_or(F.col("side") == 1).alias("candidate_hit"))


def _listed(lexicon: DataFrame) -> list[str] | None:
    """The words of a lexicon of ``SMALL`` words or fewer; no more than one word beyond that is fetched."""
    words = [r[0] for r in lexicon.select("word").where("word is not null").limit(SMALL + 1).collect()]
    return words if len(words) <= SMALL else None


def _any_of(column: str, words: list[str]) -> Column:
    """Whether an array column has one of the words: one test of a set, given as text, as thousands of literals would be as many calls."""
    quoted = ("'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'" for w in words)
    return F.expr(f"exists({column}, w -> w in ({', '.join(quoted)}))") if words else F.lit(False)


def validate(audit: DataFrame, allowed: str | None = None, most_ratio: float = MOST_RATIO, lexicon: DataFrame | None = None) -> DataFrame:
    """``audit`` with ``decision``, ``decision_reason``, ``reason_code`` and ``length_ratio``.

    In order: the candidate is empty or blank; its length is more than
    ``most_ratio`` times the original's, or less than its inverse; it has
    characters outside ``allowed``; the original has listed words and the
    candidate none. A missing text counts as empty. Each row is judged by its
    texts alone, with a lexicon of any size.
    """
    rows = audit.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in ("input_text", "candidate_text")})
    original, candidate = F.col("input_text"), F.col("candidate_text")
    rows = rows.withColumn("length_ratio", length_ratio(original, candidate))
    ratio = F.col("length_ratio")
    code = F.when(strip(candidate) == "", "empty").when((ratio > most_ratio) | (ratio < 1.0 / most_ratio), "length_ratio")
    text = F.when(F.col("reason_code") == "empty", "candidate is empty").when(F.col("reason_code") == "length_ratio", F.format_string("length ratio %.2f is out of bounds", ratio))
    if allowed is not None:
        code = code.when(F.translate(candidate, allowed, "") != "", "characters")
        text = text.when(F.col("reason_code") == "characters", F.concat(F.lit("disallowed characters: "), F.array_join(foreign_characters(candidate, allowed), " ")))
    if lexicon is not None:
        words = _listed(lexicon)
        if words is None:
            rows = rows.join(lexicon_hits(rows, lexicon), (original == F.col("text_a")) & (candidate == F.col("text_b")), "left").drop("text_a", "text_b")
        else:
            rows = rows.withColumn("original_hit", tokens(original)).withColumn("candidate_hit", tokens(candidate))
            rows = rows.withColumns({c: _any_of(c, words) for c in ("original_hit", "candidate_hit")})
        code = code.when(F.coalesce("original_hit", F.lit(False)) & ~F.coalesce("candidate_hit", F.lit(False)), "lexicon")
        text = text.when(F.col("reason_code") == "lexicon", "lexicon words were lost")
    rows = rows.withColumn("reason_code", code).drop("original_hit", "candidate_hit")
    return rows.withColumn("decision", F.when(F.col("reason_code").isNull(), ACCEPTED).otherwise(REJECTED)).withColumn("decision_reason", text.otherwise(PASSED))


def acceptance_rate(validated: DataFrame) -> DataFrame:
    return validated.agg(F.avg((F.col("decision") == ACCEPTED).cast("double")).alias("acceptance_rate"), F.count("*").alias("n"))


def reject_reasons(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("decision") == REJECTED).groupBy("reason_code").agg(F.count("*").alias("n"))
