"""Word lists with scores: ``(word, score)``, each word once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import BLANKS, strip


def from_lines(lines: DataFrame, default: float = 1.0) -> DataFrame:
    """From ``(line_no, value)``: ``word [score]``; blank lines and those beginning with # are skipped, a bad score is the default, the last entry of a word wins."""
    text = strip(F.col("value"))
    parts = F.split(text, BLANKS)
    rows = lines.where((text != "") & ~text.startswith("#")).select("line_no", F.get(parts, 0).alias("word"), F.coalesce(F.get(parts, 1).try_cast("double"), F.lit(default)).alias("score"))
    return rows.groupBy("word").agg(F.max_by("score", "line_no").alias("score"))


def from_words(words: DataFrame, default: float = 1.0) -> DataFrame:
    return words.select("word").distinct().withColumn("score", F.lit(default))


def size(lexicon: DataFrame) -> DataFrame:
    """``n``, the number of words."""
    return lexicon.agg(F.count("*").alias("n"))


def known(rows: DataFrame, lexicon: DataFrame, word: str = "word") -> DataFrame:
    """The rows whose word is listed, exactly as it is written."""
    return rows.join(lexicon.select(F.col("word").alias(word)), word, "left_semi")


def scores(rows: DataFrame, lexicon: DataFrame, word: str = "word") -> DataFrame:
    """Adds ``score``, zero for a word that isn't listed, and ``hit``."""
    found = rows.join(lexicon.select(F.col("word").alias(word), F.col("score").alias("found")), word, "left")
    return found.withColumn("hit", F.col("found").isNotNull()).withColumn("score", F.coalesce("found", F.lit(0.0))).drop("found")


def last_word(text: Column) -> Column:
    """The word that a space at the end has closed; null if none has."""
    return F.when(text.endswith(" "), F.substring_index(F.rtrim(text), " ", -1))


def boundary_score(rows: DataFrame, lexicon: DataFrame, alpha: float, beta: float, text: str = "text") -> DataFrame:
    """Adds ``bonus``: ``alpha * ln(score + 1e-10) + beta`` where the text ends in a space after a listed word, else zero."""
    listed = lexicon.select(F.col("word").alias("_word"), F.col("score").alias("_score"))
    out = rows.withColumn("_last", last_word(F.col(text))).join(listed, F.col("_last") == F.col("_word"), "left")
    return out.withColumn("bonus", F.coalesce(F.lit(alpha) * F.log(F.col("_score") + 1e-10) + beta, F.lit(0.0))).drop("_last", "_word", "_score")
