"""Licence scans: Dice coefficient over word bigrams against templates.

A text's units are its lines, its paragraphs (parted by blank lines), the whole
of it, and its regions: for each long template, the longest runs of lines, of
two words or more, that have half of their bigrams from that template, with at
most ``GAP`` other lines between them. So a licence in several paragraphs, or
wrapped over lines, is one unit whatever stands around it. A unit is held
against a template only if its number of bigrams allows the least coefficient:
with |A| bigrams in the template, |B| must lie between t / (2 - t) * |A| and
(2 - t) / t * |A|. Before that, a document is passed over unless it holds one of
the templates' anchors: a unit reaching the coefficient shares so many bigrams
that an anchor is among them.
"""

from __future__ import annotations

import math
import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .expressions import let
from .license_texts import TEMPLATES

LEAST = 0.8
_WORD = "[^\\p{L}\\p{N}]+"
#: Letters from which on a word alone is an anchor.
LONG = 6

#: Bigrams of a template from which on it has regions, and other lines allowed in one.
REGION, GAP = 20, 1

def normal(text: str) -> list[str]:
    """Words of a template: runs of letters and digits in lower case."""
    return re.findall(r"[^\W_]+", text.lower())


def bigrams_of(words: list[str]) -> list[str]:
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def anchors(templates: dict[str, str], least: float = LEAST) -> tuple[list[str], list[str]]:
    """Long words, and patterns of pairs of short ones, of which any text with a unit that reaches ``least`` holds one.

    A match shares so many bigrams with its template that of the rest and one
    more, whichever they are, it holds one; those with the longest words are
    taken, as rarer. Tests are on lower-case text.
    """
    words, pairs = set(), set()
    for text in templates.values():
        grams = sorted((g.split(" ") for g in bigrams_of(normal(text))), key=lambda g: (-max(map(len, g)), g))
        shared = math.ceil(least / (2 - least) * len(grams) - 1e-9)
        for g in grams[: len(grams) - shared + 1]:
            longest = max(g, key=len)
            if len(longest) >= LONG:
                words.add(longest)
            else:
                pairs.add(f"(?<![\\p{{L}}\\p{{N}}]){g[0]}{_WORD}{g[1]}(?![\\p{{L}}\\p{{N}}])")
    return sorted(words), sorted(pairs)


def _bigrams(words: Column) -> Column:
    return F.array_distinct(F.transform(F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))), lambda w, i: F.concat(w, F.lit(" "), F.get(words, i + 1))))


def _constant(bigrams: list[str]) -> Column:
    """One literal array in the plan, made from one text."""
    return F.split(F.lit("|".join(bigrams)), "[|]")


def _regions(lines: Column, grams: Column, template: list[str]) -> Column:
    """Word arrays of the regions of one template: from each hit that no other comes shortly before to the last that follows it closely."""
    own = _constant(template)
    hits = F.filter(F.sequence(F.lit(0), F.size(grams) - 1), lambda i: 2 * F.size(F.array_intersect(F.get(grams, i), own)) >= F.size(F.get(grams, i)))
    starts = lambda at: F.filter(at, lambda i, k: (k == 0) | (i - F.get(at, k - 1) > GAP + 1))
    ends = lambda at: F.filter(at, lambda i, k: (k == F.size(at) - 1) | (F.get(at, k + 1) - i > GAP + 1))
    return let(hits, lambda at: F.zip_with(starts(at), ends(at), lambda a, z: F.flatten(F.slice(lines, a + 1, z - a + 1))))


def _units(text: Column, sets: dict[str, list[str]]) -> Column:
    """Word arrays of all units of a lower-case text, each once."""
    words = lambda x: F.array_remove(F.split(x, _WORD), "")
    plain = F.transform(F.array_distinct(F.concat(F.split(text, "\n", -1), F.split(text, "\n\\s*\n", -1), F.array(text))), words)
    lines = F.filter(F.transform(F.split(text, "\n", -1), words), lambda w: F.size(w) > 1)
    long = [s for s in sets.values() if len(s) >= REGION]
    none = F.array().cast("array<array<string>>")
    found = let(lines, lambda x: let(F.struct(x.alias("lines"), F.transform(x, _bigrams).alias("grams")), lambda y: F.when(F.size(y["lines"]) > 1, F.concat(*(_regions(y["lines"], y["grams"], s) for s in long), none)).otherwise(none)))
    return F.array_distinct(F.concat(plain, found))


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, least: float = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, license, dice, n_units)``: the licences found, with the best coefficient and the number of distinct units that reach ``least``.

    Null and empty texts, and units of fewer than two words, match nothing.
    Rows of one id are rows of one document. A unit that two templates fit
    counts for both. Very long texts are scanned whole; a licence that shares
    its line with much other text is beyond the units.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    words, pairs = anchors(templates, least)
    some = let(F.lower("text"), lambda low: reduce(or_, [F.contains(low, F.lit(w)) for w in words] + [F.regexp_like(low, F.lit(p)) for p in pairs], F.lit(False)))
    sets = {k: bigrams_of(normal(t)) for k, t in templates.items()}

    split = rows.where(some).select("doc_id", F.explode_outer(let(F.lower("text"), lambda low: _units(low, sets))).alias("words")).where("words is not null")

    def tests(grams: Column) -> Column:
        n, out = F.size(grams), []
        for name, s in sets.items():
            bound = (n >= least / (2 - least) * len(s) - 1e-9) & (n <= (2 - least) / least * len(s) + 1e-9)
            dice = F.lit(2.0) * F.size(F.array_intersect(grams, _constant(s))) / (n + len(s))
            out.append(F.when(bound, F.struct(F.lit(name).alias("license"), dice.alias("dice"))))
        return F.array_compact(F.array(*out))

    # bound by let, so that the optimiser can't copy the bigrams into each test
    tested = split.select("doc_id", "words", F.explode_outer(let(let(F.col("words"), _bigrams), tests)).alias("t")).where(F.col("t.dice") >= least)
    found = tested.select("doc_id", "words", "t.license", "t.dice").distinct()
    return found.groupBy("doc_id", "license").agg(F.max("dice").alias("dice"), F.count("*").alias("n_units"))
