"""Secret scans through a trigram inverted index.

From each rule's regex a Boolean trigram query is derived: what any match must
hold, as alternatives of sets of trigrams over lower-case text. The index has a
posting (trigram, doc_id) for each document and trigram that some rule asks for;
intersecting the postings of a set gives candidates, and the regex runs on those
alone. A rule from which no mandatory trigram follows is run on every text.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product
from re import _parser as parser  # Python's own; a Python without it fails here, not in a scan

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bitmap import marked
from .expressions import let, total
from .storage import materialize

_MOST_STRINGS = 64
_BLOCK = 256


@dataclass(frozen=True)
class Rule:
    """``kind`` of secret; ``pattern`` in the syntax that Java and Python share; matches count whose ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The contract's kinds, in its order. Runs of hex digits are as long as they
#: can be, so asking for 24 in the pattern drops exactly the shorter ones.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: Further kinds of this library.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)


def _trigrams(s: str) -> frozenset[str]:
    return frozenset(s[i : i + 3] for i in range(len(s) - 2))


def _either(options: list[set[frozenset[str]] | None]) -> set[frozenset[str]] | None:
    return None if any(o is None for o in options) else set().union(*options)


def _both(a: set[frozenset[str]] | None, b: set[frozenset[str]] | None) -> set[frozenset[str]] | None:
    if a is None or b is None:
        return a if b is None else b
    return {x | y for x in a for y in b} if len(a) * len(b) <= _MOST_STRINGS else min(a, b, key=len)


def _of_strings(strings: set[str]) -> set[frozenset[str]] | None:
    return None if any(len(s) < 3 for s in strings) else {_trigrams(s) for s in strings}


def _walk(nodes) -> tuple[set[str] | None, set[frozenset[str]] | None]:
    """Of a parsed sequence: all strings it can match if they are few, and alternatives of trigrams a match must hold (None: any)."""
    run, need, exact = {""}, None, True

    def close() -> None:
        nonlocal run, need
        need, run = _both(need, _of_strings(run)), {""}

    for op, arg in nodes:
        strings, query = _one(str(op), arg)
        if strings is not None and len(run) * len(strings) <= _MOST_STRINGS:
            run = {a + b for a, b in product(run, strings)}
        else:
            exact = False
            close()
            if strings is not None:
                run = strings
            else:
                need = _both(need, query)
    return (run, _of_strings(run)) if exact else (None, _both(need, _of_strings(run)))


def _one(op: str, arg) -> tuple[set[str] | None, set[frozenset[str]] | None]:
    if op == "LITERAL":
        return {chr(arg).lower()}, None
    if op == "IN":
        chars = [chr(v).lower() for k, v in arg if str(k) == "LITERAL"]
        return (set(chars), None) if len(chars) == len(arg) <= 8 else (None, None)
    if op == "SUBPATTERN":
        return _walk(arg[3])
    if op == "BRANCH":
        parts = [_walk(x) for x in arg[1]]
        if all(s is not None for s, _ in parts) and sum(len(s) for s, _ in parts) <= _MOST_STRINGS:
            return set().union(*(s for s, _ in parts)), None
        return None, _either([q for _, q in parts])
    if op in ("MAX_REPEAT", "MIN_REPEAT"):
        low, high, body = arg
        strings, query = _walk(body)
        if strings is not None and int(low) == 0 and high == 1:
            return strings | {""}, None
        if strings is not None and low == high and int(low) * max(map(len, strings)) <= 16:
            return {"".join(x) for x in product(strings, repeat=int(low))} if len(strings) ** int(low) <= _MOST_STRINGS else None, None
        return None, query if int(low) >= 1 else None
    if op == "AT":
        return {""}, None
    return None, None


def trigram_query(pattern: str) -> set[frozenset[str]] | None:
    """Sets of lower-case trigrams, of which any match holds one whole set; None where none is mandatory."""
    strings, query = _walk(parser.parse(pattern))
    found = _of_strings(strings) if strings is not None else query
    return None if not found or any(not s for s in found) else found


def index(docs: DataFrame, trigrams: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Postings ``(trigram, doc_id)`` of the given lower-case trigrams."""
    text = F.lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    has = let(text, lambda low: F.array_compact(F.array(*(F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in trigrams))))
    # outer, or the optimiser tests the array before it makes it again
    return docs.select(F.explode_outer(has).alias("trigram"), F.col(id_col).cast("long").alias("doc_id")).where("trigram is not null")


def candidates(docs: DataFrame, rules: tuple[Rule, ...], id_col: str = "doc_id", text_col: str = "text") -> DataFrame | None:
    """``(doc_id, kinds)``: the rules with mandatory trigrams whose query the document fulfils; None if there is no such rule."""
    asked = [(r.kind, k, t, len(s)) for r in rules for k, s in enumerate(sorted(trigram_query(r.pattern) or (), key=sorted)) for t in sorted(s)]
    if not asked:
        return None
    spark = docs.sparkSession
    queries = spark.createDataFrame(asked, "kind string, part int, trigram string, n int")  # as many rows as the rules have trigrams
    postings = index(docs, sorted({t for _, _, t, _ in asked}), id_col, text_col)
    met = postings.join(F.broadcast(queries), "trigram").groupBy("doc_id", "kind", "part", "n").agg(F.count("*").alias("found"))
    # rows of one id post the same trigram more than once; a surplus only makes a candidate
    return met.where("found >= n").groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))


def _starts(lengths: Column) -> Column:
    """Sum of what stands before each place: by blocks, so that the work does not grow with the square."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _BLOCK).cast("int")), lambda b: total(F.slice(lengths, b * _BLOCK + 1, _BLOCK)))
    before = lambda sums: F.transform(F.sequence(F.lit(0), F.size(sums) - 1), lambda b: total(F.slice(sums, F.lit(1), b)))
    each = lambda sums: F.transform(lengths, lambda _, i: F.get(sums, F.floor(i / _BLOCK).cast("int")) + total(F.slice(lengths, F.floor(i / _BLOCK).cast("int") * _BLOCK + 1, i % _BLOCK)))
    return let(blocks, lambda s: let(before(s), each))


def matches(text: Column, rule: Rule, number: int) -> Column:
    """Array of ``(start, number, end, kind)`` in code points of the leftmost non-overlapping matches that are long enough."""
    none = F.array().cast("array<struct<start:long,number:int,end:long,kind:string>>")
    parts = F.struct(
        F.transform(F.split(text, rule.pattern, -1), lambda x: F.length(x).cast("long")).alias("gaps"),
        F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), lambda x: F.length(x).cast("long")).alias("hits"),
        F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)), lambda x: F.length(x)).alias("values"),
    )

    def spans(p: Column) -> Column:
        steps = F.zip_with(F.slice(p["gaps"], F.lit(1), F.size(p["hits"])), p["hits"], lambda g, h: g + h)
        made = lambda st: F.transform(st, lambda s, i: F.struct((s + p["gaps"][i]).alias("start"), F.lit(number).alias("number"), (s + p["gaps"][i] + p["hits"][i]).alias("end"), F.lit(rule.kind).alias("kind"), p["values"][i].alias("long")))
        kept = lambda m: F.transform(F.filter(m, lambda x: x["long"] >= rule.least), lambda x: F.struct(x["start"].alias("start"), x["number"].alias("number"), x["end"].alias("end"), x["kind"].alias("kind")))
        return let(steps, lambda n: let(let(n, _starts), lambda st: kept(made(st))))

    return F.when(F.regexp_like(text, F.lit(rule.pattern)), let(parts, spans)).otherwise(none)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, found)`` for every row: ``found`` the spans of all rules as ``(start, number, end, kind)``, by start, then rule.

    Null text counts as empty and holds none. Repeated rows repeat their
    result; rows of one id, or without one, are each matched by their own text.
    Very long texts are scanned whole. Only candidates are shuffled: which rows
    they are a bitmap of bounded size tells where the rows stand.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("row", F.xxhash64("doc_id", "text"))  # an id alone could be null, or stand for several texts
    none = F.array().cast("array<struct<start:long,number:int,end:long,kind:string>>")
    bound = [trigram_query(r.pattern) is not None for r in rules]
    every = [none if b else matches(F.col("text"), r, k) for k, (r, b) in enumerate(zip(rules, bound, strict=True))]
    out = lambda part, found: part.select("doc_id", F.sort_array(F.concat(*found)).alias("found"))
    some = candidates(rows, rules, "row", "text")
    if some is None:
        return out(rows, every)
    some = materialize(some.withColumnRenamed("doc_id", "of"), "candidates")
    split, there = marked(rows, some, F.col("row"), F.col("of"))
    held = split.where(F.col(there)).join(some, F.col("row") == F.col("of"), "left")
    asked = [F.when(F.array_contains("kinds", r.kind), matches(F.col("text"), r, k)).otherwise(none) if b else every[k] for k, (r, b) in enumerate(zip(rules, bound, strict=True))]
    return out(split.where(~F.col(there)), every).union(out(held, asked))


def joined(found: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
