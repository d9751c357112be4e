"""Line dedup by content-defined chunks of lines.

A rolling hash over the hashes of ``WINDOW`` lines starts a chunk where it is
divisible by ``DIVISOR``, so boundaries move with the content. Chunks of two or
more lines that occur again are found first, by their hash. A passage that
repeats inside other text also has lines before its first and after its last
boundary, and a short one no whole chunk at all; so in all other chunks, and
across the edges of those found, each run of ``LEAST_LINES`` lines is keyed too,
and each line of ``LONG_LINE`` words, which stands for a passage by itself.

What occurs again, in any document, goes from all places but its first (least
doc_id, then line), after the bytes of its lines have been compared. Repeated
lines that follow each other make a run; one of fewer than ``LEAST_WORDS`` words
stays, as short lines meet by chance. Of every passage that goes, each line
stays at the least place where it occurs in the same company.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .bitmap import marked, maybe
from .expressions import total
from .storage import fresh, materialize

WINDOW, DIVISOR, FACTOR = 2, 3, 31
LEAST_LINES, LONG_LINE, LEAST_WORDS = 2, 50, 25
_PLACE = ("doc_id", "row", "pos")


def _weight(line: Column) -> Column:
    """Words of a line: its blanks and one; none in a line of white space."""
    return F.when(F.regexp_like(line, F.lit("\\S")), F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1).otherwise(0)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, row, text)`` of the texts in which something can repeat; ``row`` tells different texts of one id apart."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("doc_id is not null and text is not null")
    return rows.where(F.contains("text", F.lit("\n")) | (_weight(F.col("text")) >= LONG_LINE)).select("doc_id", F.xxhash64("text").alias("row"), "text")


def chunks(rows: DataFrame) -> DataFrame:
    """``(doc_id, row, pos, n, hashes, weights, key)``: a row for each chunk of ``n`` lines from line ``pos`` on.

    ``hashes`` and ``weights`` are those of its lines and of the line that
    follows; ``key`` is the hash of the chunk.
    """
    lines = rows.withColumn("lines", F.split("text", "\n", -1)).drop("text")
    hashed = lines.withColumn("h", F.transform("lines", lambda x: F.xxhash64(x))).withColumn("w", F.transform("lines", _weight)).drop("lines")

    def rolled(i: Column) -> Column:
        out = F.lit(0).cast("long")
        for k in range(WINDOW):
            out = out * FACTOR + F.coalesce(F.pmod(F.get("h", i + k), F.lit(1 << 31)), F.lit(0))
        return out % DIVISOR

    every = F.sequence(F.lit(0), F.size("h") - 1)
    cut = hashed.withColumn("starts", F.filter(every, lambda i: (i == 0) | (rolled(i) == 0)))
    length = lambda s, k: F.coalesce(F.get("starts", k + 1), F.size("h")) - s
    made = F.transform("starts", lambda s, k: F.struct(s.alias("pos"), length(s, k).alias("n"), F.slice("h", s + 1, length(s, k) + 1).alias("hashes"), F.slice("w", s + 1, length(s, k) + 1).alias("weights")))
    # outer, or the optimiser copies all of this into a test before it
    out = cut.select("doc_id", "row", F.explode_outer(made).alias("c")).where("c is not null").select("doc_id", "row", "c.*")
    return out.withColumn("key", F.xxhash64("n", F.slice("hashes", F.lit(1), F.col("n"))))


def _again(units: DataFrame, name: str) -> DataFrame:
    """``(of_key, first)`` of the keys that occur more than once, with their first place."""
    counted = units.groupBy("key").agg(F.count("*").alias("times"), F.min(F.struct(*_PLACE)).alias("first")).where("times > 1")
    return materialize(counted.select(F.col("key").alias("of_key"), "first"), name)


def _later() -> Column:
    return F.col("first").isNotNull() & (F.struct(*_PLACE) != F.col("first"))


def _lines_of(units: DataFrame) -> DataFrame:
    """``(doc_id, row, i, h, w)`` of the ``n`` lines of units with ``hashes`` and ``weights``."""
    each = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda j: F.struct((F.col("pos") + j).alias("i"), F.get("hashes", j).alias("h"), F.get("weights", j).alias("w")))
    return units.select("doc_id", "row", F.explode(each).alias("l")).select("doc_id", "row", "l.*")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, row, spans)``: for each text with repeated runs of lines, ``(pos, n)`` of each but the first, by line.

    Rows of one id are rows of one document, and equal ones repeat nothing;
    rows without an id or text have no repeats. A text is read twice: for the
    hashes of its lines, and for the bytes of those that would go; only these,
    once for each task, are shuffled.
    """
    rows = _rows(docs, id_col, text_col)
    cut = materialize(chunks(rows), "chunks")
    found = cut.join(_again(cut.where(F.col("n") >= LEAST_LINES), "repeated_chunks").hint("merge"), F.col("key") == F.col("of_key"), "left")
    found = materialize(found.select(*_PLACE, "n", "hashes", "weights", _later().alias("gone")), "marked_chunks")
    # runs of two lines that lie in no chunk that goes, and long lines
    spare = F.when(F.col("gone"), F.array(F.col("n") - 1)).otherwise(F.sequence(F.lit(0), F.col("n") - 1))
    pairs = F.transform(F.filter(spare, lambda j: j + LEAST_LINES <= F.size("hashes")), lambda j: F.struct(j.alias("j"), F.lit(LEAST_LINES).alias("n")))
    long = F.transform(F.filter(spare, lambda j: ~F.col("gone") & (F.get("weights", j) >= LONG_LINE)), lambda j: F.struct(j.alias("j"), F.lit(1).alias("n")))
    units = found.select("doc_id", "row", "pos", "hashes", "weights", F.explode_outer(F.concat(pairs, long)).alias("u")).where("u is not null")
    part = lambda c: F.slice(c, F.col("u.j") + 1, F.col("u.n"))
    units = units.select("doc_id", "row", (F.col("pos") + F.col("u.j")).alias("pos"), F.col("u.n").alias("n"), part("hashes").alias("hashes"), part("weights").alias("weights"))
    units = materialize(units.withColumn("key", F.xxhash64("n", "hashes")), "line_runs")
    firsts = _again(units, "repeated_runs")
    later = maybe(units, firsts, keys_key=F.col("of_key")).join(firsts.hint("merge"), F.col("key") == F.col("of_key")).where(_later())
    # copies of one text under one id are one place
    gone = materialize(_lines_of(found.where("gone")).union(_lines_of(later)).distinct(), "repeated_lines")
    gone = _compared(gone, rows)
    order = Window.partitionBy("doc_id", "row").orderBy("i")  # a text's own lines
    runs = gone.withColumn("run", F.col("i") - F.row_number().over(order)).groupBy("doc_id", "row", "run").agg(F.min("i").alias("pos"), F.count("*").cast("int").alias("n"), F.sum("w").alias("words"))
    return runs.where(F.col("words") >= LEAST_WORDS).groupBy("doc_id", "row").agg(F.array_sort(F.collect_list(F.struct("pos", "n"))).alias("spans"))


def _compared(gone: DataFrame, rows: DataFrame) -> DataFrame:
    """``gone`` less the lines whose hash stands for different bytes somewhere; hashes alone decide nothing."""
    each = rows.select(F.explode(F.split("text", "\n", -1)).alias("line")).select("line", F.xxhash64("line").alias("key"))
    texts = maybe(each, gone.select("h").distinct(), keys_key=F.col("h")).groupBy("key").agg(F.min("line").alias("least"), F.max("line").alias("most"))
    unlike = materialize(texts.where("least <> most").select(F.col("key").alias("h")), "unlike_lines")
    return gone if unlike.isEmpty() else gone.join(unlike, "h", "left_anti")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` (all columns, every row) with repeated lines taken out of the text; and the name of an added column, the number of lines taken out.

    A text of which nothing is left is empty; null stays null. Rows from which
    nothing goes, which a bitmap of bounded size tells, aren't shuffled.
    """
    of, of_row, row, g, lines, taken = fresh(docs.columns, "of_", "of_row", "row_", "gone_", "lines_", "removed_lines")
    found = materialize(repeats(docs, id_col, text_col), "spans").select(F.col("doc_id").alias(of), F.col("row").alias(of_row), F.col("spans").alias(g))
    text = F.col(text_col)
    own = docs.withColumn(row, F.xxhash64(text.cast("string")))
    split, there = marked(own, found, F.struct(F.col(id_col).cast("long"), row), F.struct(of, of_row))
    held = split.where(F.col(there)).join(found.hint("merge"), (F.col(id_col) == F.col(of)) & (F.col(row) == F.col(of_row)), "left").withColumn(lines, F.split(text, "\n", -1))
    size = F.size(g)
    start = lambda k: F.when(k == 0, F.lit(0)).otherwise(F.get(g, k - 1)["pos"] + F.get(g, k - 1)["n"])
    end = lambda k: F.when(k < size, F.get(g, k)["pos"]).otherwise(F.size(lines))
    left = F.flatten(F.transform(F.sequence(F.lit(0), size), lambda k: F.slice(lines, start(k) + 1, end(k) - start(k))))
    n = total(F.transform(g, lambda s: s["n"].cast("long")))
    cleared = held.withColumn(taken, F.when(size > 0, n).otherwise(F.lit(0).cast("long"))).withColumn(text_col, F.when(size > 0, F.array_join(left, "\n")).otherwise(text))
    whole = split.where(~F.col(there)).withColumn(taken, F.lit(0).cast("long"))
    columns = [*docs.columns, taken]
    return whole.select(*columns).union(cleared.select(*columns)), taken
