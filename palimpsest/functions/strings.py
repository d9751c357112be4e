"""Text helpers. White space is Unicode white space unless said otherwise."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters with the Unicode property White_Space (fixed values), as the inside of a class that Java and RE2 both read.
WHITE = "\\t-\\r \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}"
BLANKS = f"[{WHITE}]+"
_WHITE_CHARS = "\t\n\x0b\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: Distinct words of a pair up to which each has a letter of its own at hand.
LETTERS = 1024


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once per row, even inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(_WHITE_CHARS))


def tokens(text: Column) -> Column:
    """Words between white space; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def characters(text: Column) -> Column:
    """Code points, in order; an empty text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), ""), "")


def stem(path: Column) -> Column:
    """File name without its last suffix."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.when(F.regexp_like(name, F.lit("^.+\\.[^.]*$")), F.regexp_replace(name, "\\.[^.]*$", "")).otherwise(name)


def count_of(text: Column, part: Column) -> Column:
    """How often a single character occurs."""
    return (F.length(text) - F.length(F.replace(text, part, F.lit("")))).cast("long")


@F.pandas_udf(T.StringType())
def nfc(texts: pd.Series) -> pd.Series:
    """Unicode normal form C; Spark has no built-in for it."""
    return texts.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


def same_text(a: Column, b: Column) -> Column:
    """Equal in normal form C. ASCII, and what is equal as it stands, needs no normal form: Python sees a null for it."""
    odd = (a != b) & F.regexp_like(F.concat(a, b), F.lit("[^\\x00-\\x7F]"))
    return (a == b) | F.coalesce(nfc(F.when(odd, a)) == nfc(F.when(odd, b)), F.lit(False))


def char_distance(predicted: Column, reference: Column) -> Column:
    """Edit distance in characters; equal texts need no table of costs."""
    return F.when(predicted == reference, F.lit(0)).otherwise(F.levenshtein(predicted, reference)).cast("long")


def word_errors(predicted: Column, reference: Column) -> Column:
    """Word-level edit distance: each distinct word of the pair becomes one character for ``levenshtein``."""
    letters = F.split(F.lit(" ".join(chr(0x100 + i) for i in range(LETTERS))), " ")  # folded into one constant

    def spelled(words: Column, known: Column) -> Column:
        few = F.array_join(F.transform(words, lambda w: F.get(letters, F.array_position(known, w).cast("int") - 1)), "")
        # from U+10000 on, beyond surrogates and byte order marks
        code = lambda w: F.array_position(known, w) + 0xFFFF
        many = F.array_join(F.transform(words, lambda w: F.decode(F.unhex(F.lpad(F.hex(code(w)), 8, "0")), "UTF-32")), "")
        return F.when(F.size(known) <= LETTERS, few).otherwise(many)

    pair = F.struct(predicted.alias("p"), reference.alias("r"))
    known = lambda x: F.struct(x["p"].alias("p"), x["r"].alias("r"), F.array_distinct(F.concat(x["p"], x["r"])).alias("known"))
    found = bound(bound(pair, known), lambda x: F.levenshtein(spelled(x["p"], x["known"]), spelled(x["r"], x["known"])))
    return F.when(predicted == reference, F.lit(0)).otherwise(found).cast("long")
