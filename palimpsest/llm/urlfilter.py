"""URL filters with redirect equivalence.

An explicit rule decides a URL on its own. A URL without a rule takes the
decision of its aliases: the URLs it is connected to by redirects (meta refresh)
and canonical links. There a block spreads to all, unless an alias is
explicitly allowed; what is left is allowed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .expressions import let

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``allow`` or ``block`` for a host with all its subdomains, where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))


def _after(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_after(url), "(?s)^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after(url), "(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """The URL as a node: A-Z of scheme and host lower-cased, without the fragment, which no server sees; null without ``://``."""

    def node(u: Column) -> Column:
        scheme = F.translate(F.substring_index(u, "://", 1), UPPER, LOWER)
        return F.when(F.instr(u, "://") > 0, F.concat(scheme, F.lit("://"), host_of(u), F.regexp_extract(_after(u), "(?s)^[^/?#]*([^#]*)", 1)))

    return let(url, node)


def match(url: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """The longest rule that fits, as its text, and its verdict; null if none does. Of rules of one length the first given wins."""
    host, path = host_of(url), path_of(url)
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text), reverse=True)[::-1]:
        name = F.when(r.fits(host, path), r.text).otherwise(name)
        verdict = F.when(r.fits(host, path), r.verdict).otherwise(verdict)
    return name, verdict


def _attribute(tag: Column, name: str) -> Column:
    """Value of an HTML attribute, quoted or not, with ``&amp;`` undone."""
    raw = F.regexp_extract(tag, rf"""(?is)[\s"']{name}\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""", 1)
    return F.trim(F.replace(F.regexp_replace(raw, """^["']|["']$""", ""), F.lit("&amp;"), F.lit("&")))


def _level(url: Column) -> Column:
    """An absolute URL whose path has no ``.`` and ``..`` segments any more (RFC 3986, 5.2.4)."""
    parts = F.split(path_of(url), "/")
    fold = lambda done, s: F.when(s == ".", done).when(s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.array_append(done, s))
    done = F.aggregate(F.slice(parts, 2, F.size(parts)), F.array().cast("array<string>"), fold)
    ended = F.when(F.element_at(parts, -1).isin(".", ".."), F.array_append(done, F.lit(""))).otherwise(done)
    made = F.concat(F.regexp_extract(url, "(?s)^(.*?://[^/?#]*)", 1), F.lit("/"), F.array_join(ended, "/"), F.regexp_extract(_after(url), "(?s)^[^?#]*(.*)$", 1))
    return F.when(F.regexp_like(path_of(url), F.lit("/[.][.]?(/|$)")), made).otherwise(url)


def _resolved(base: Column, ref: Column) -> Column:
    """An absolute URL for a reference found at ``base`` (RFC 3986, 5.2); null for one that names none."""
    scheme = F.substring_index(base, "://", 1)
    root = F.concat(scheme, F.lit("://"), host_of(base))
    folder = F.regexp_extract(path_of(base), "(?s)^(.*/)", 1)
    found = (
        F.when(ref.isNull() | (ref == "") | ref.startswith("#"), None)
        .when(F.regexp_like(ref, F.lit("^[A-Za-z][A-Za-z0-9+.-]*://")), ref)
        .when(ref.startswith("//"), F.concat(scheme, F.lit(":"), ref))
        .when(ref.startswith("/"), F.concat(root, ref))
        .when(ref.startswith("?"), F.concat(root, path_of(base), ref))
        .when(F.regexp_like(ref, F.lit("^[A-Za-z][A-Za-z0-9+.-]*:")), None)
        .otherwise(F.concat(root, F.when(folder == "", "/").otherwise(folder), ref))
    )
    return let(found, _level)


def alias_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(src, dst)``: nodes of pages and of the targets of their canonical links and meta refreshes, relative to the page or its ``<base>``."""
    html = F.col(html_col).cast("string")
    rows = pages.select(F.col(url_col).cast("string").alias("url"), html.alias("html")).where(F.col("url").contains("://") & F.regexp_like("html", F.lit("(?i)canonical|refresh")))
    base = F.regexp_extract("html", "(?is)<base\\s[^>]*>", 0)
    place = let(F.struct(F.col("url").alias("url"), _attribute(base, "href").alias("href")), lambda p: F.when(p["href"] == "", p["url"]).otherwise(F.coalesce(_resolved(p["url"], p["href"]), p["url"])))
    tags = rows.withColumn("base", place).select("url", "base", F.explode_outer(F.regexp_extract_all("html", F.lit("(?is)<(?:link|meta)\\s[^>]*>"), F.lit(0))).alias("tag"))

    def target(tag: Column) -> Column:
        content = F.regexp_extract(_attribute(tag, "content"), """(?is)url\\s*=\\s*["']?([^"']+)""", 1)
        canonical = F.array_contains(F.split(F.lower(_attribute(tag, "rel")), "\\s+"), "canonical")
        return F.trim(F.when(canonical, _attribute(tag, "href")).when(F.lower(_attribute(tag, "http-equiv")) == "refresh", content))

    # bound step by step: as one expression it would be copied many times over
    to = let(F.struct(F.col("base").alias("base"), let(F.col("tag"), target).alias("ref")), lambda p: node_of(_resolved(p["base"], p["ref"])))
    found = tags.select(node_of(F.col("url")).alias("src"), to.alias("dst"))
    return found.where("dst is not null and src <> dst").distinct()


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for every row of ``pages``.

    A null URL, or one without ``://``, has an empty host and path, no rule and
    no alias, and is allowed. Pages of one URL are aliases of each other. Null
    html names no alias; repeated rows repeat their result.
    """
    nodes = connected_components(alias_edges(pages, url_col, html_col), "src", "dst")
    _, own = match(F.col("node"), rules)
    marked = nodes.select("node", "component", own.alias("own"))
    decided = marked.groupBy("component").agg(F.max((F.col("own") == "allow").cast("int")).alias("allowed"), F.max((F.col("own") == "block").cast("int")).alias("blocked"))
    spread = decided.where("blocked = 1 and coalesce(allowed, 0) = 0").select("component")
    blocked = marked.join(spread, "component", "left_semi").select(F.col("node").alias("of"), F.lit("block").alias("spread"))
    url = F.col("url")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"))
    name, verdict = match(url, rules)
    out = rows.join(blocked, node_of(url) == F.col("of"), "left")
    return out.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), name.alias("rule"), F.coalesce(verdict, "spread", F.lit("allow")).alias("verdict"))
