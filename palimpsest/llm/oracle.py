"""DuckDB SQL of the queries that SQL can express.

Not here: op4, op7 and op10 (XXH64 fingerprints and their components, windows
by fingerprint, expectation-maximisation), op6 (BPE) and the pipeline, which
ends in it; op12 (every window of every text takes minutes on the whole table)
and op13 (eigenvectors). Tests hold those against brute force.
"""

from __future__ import annotations

from . import licenses, linededup, prefixtrie, secrets, sharding, urlfilter


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _secrets() -> str:
    parts = []
    for k, r in enumerate(secrets.BASE + secrets.MORE):
        p = _text(r.pattern)
        parts.append(
            f"SELECT doc_id, {k} AS number, '{r.kind}' AS kind, i, hits, vals[i] AS val, parts, {r.least} AS least FROM (SELECT doc_id, string_split_regex(t, {p}) AS parts, regexp_extract_all(t, {p}, 0) AS hits, regexp_extract_all(t, {p}, {r.group}) AS vals "
            f"FROM docs_ WHERE regexp_matches(t, {p})), unnest(range(1, len(hits) + 1)) AS u(i)"
        )
    base = len(secrets.BASE)
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in secrets.BASE)
    joined = "string_agg(concat(kind, ':', s, ':', e), ',' ORDER BY s, number)"
    return f"""WITH docs_ AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), found_ AS ({" UNION ALL ".join(parts)}),
 placed_ AS (SELECT doc_id, number, kind, CAST(list_sum(list_transform(parts[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s, length(hits[i]) AS n FROM found_ WHERE length(val) >= least),
 spans_ AS (SELECT *, s + n AS e FROM placed_),
 sums_ AS (SELECT doc_id, {counts}, {joined} FILTER (number < {base}) AS base, {joined} AS spans FROM spans_ GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secrets.BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM docs_ d LEFT JOIN sums_ s ON s.doc_id = d.doc_id"""


def _sharding() -> str:
    m, n = sharding.SIZE, sharding.SHARDS
    frac = lambda x: f"CAST(concat('0x', substr(md5({x}), 1, 8)) AS BIGINT)"
    return f"""WITH RECURSIVE shards_ AS (SELECT i, name, {frac("concat('offset:', name)")} % {m} AS o, {frac("concat('skip:', name)")} % {m - 1} + 1 AS k FROM (SELECT i, printf('shard%03d', i) AS name FROM range({n}) AS r(i))),
 fill_ AS (SELECT CAST(0 AS BIGINT) AS turn, list_transform(range(0, {m}), lambda x: CAST(-1 AS BIGINT)) AS t UNION ALL
 SELECT turn + 1, list_concat(list_concat(t[1:s], [i]), t[s + 2:]) FROM (SELECT turn, t, i, (o + k * list_filter(range(0, {m}), lambda j: t[(o + j * k) % {m} + 1] < 0)[1]) % {m} AS s FROM fill_ JOIN shards_ ON i = turn % {n} WHERE turn < {m})),
 table_ AS (SELECT slot, t[slot + 1] AS i FROM fill_, unnest(range(0, {m})) AS u(slot) WHERE turn = {m})
SELECT doc_id, CAST(slot AS INTEGER) AS slot, name AS shard FROM (SELECT doc_id, {frac("coalesce(CAST(doc_id AS VARCHAR), '')")} % {m} AS slot FROM documents) d JOIN table_ USING (slot) JOIN shards_ USING (i)"""


def _licenses() -> str:
    values = ", ".join(f"({_text(k)}, {_text(t)})" for k, t in licenses.TEMPLATES.items())
    words = lambda x: f"list_filter(regexp_split_to_array(lower({x}), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')"
    grams = "list_distinct(list_transform(range(1, len(w)), lambda i: concat(w[i], ' ', w[i + 1])))"
    return f"""WITH templates_ AS (SELECT license, {grams} AS g FROM (SELECT license, {words("t")} AS w FROM (VALUES {values}) AS v(license, t))),
 plain_ AS (SELECT doc_id, {words("unit")} AS w FROM (SELECT doc_id, unnest(list_concat(list_concat(string_split(lower(text), chr(10)), regexp_split_to_array(lower(text), '\\n\\s*\\n')), [lower(text)])) AS unit FROM documents WHERE text IS NOT NULL)),
 every_ AS (SELECT doc_id, ln, {words("line")} AS w FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS ln FROM documents WHERE text IS NOT NULL)),
 lines_ AS (SELECT doc_id, w, {grams} AS g, row_number() OVER (PARTITION BY doc_id ORDER BY ln) AS i FROM every_ WHERE len(w) > 1),
 hits_ AS (SELECT l.doc_id, license, i FROM lines_ l JOIN templates_ t ON len(t.g) >= {licenses.REGION} AND 2 * len(list_intersect(l.g, t.g)) >= len(l.g)),
 islands_ AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, license ORDER BY i) AS island FROM (SELECT *, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id, license ORDER BY i) <= {licenses.GAP + 1} THEN 0 ELSE 1 END AS fresh FROM hits_)),
 bounds_ AS (SELECT doc_id, license, island, min(i) AS a, max(i) AS z FROM islands_ GROUP BY ALL),
 regions_ AS (SELECT b.doc_id, flatten(list(w ORDER BY i)) AS w FROM bounds_ b JOIN lines_ l ON l.doc_id = b.doc_id AND i BETWEEN a AND z GROUP BY b.doc_id, license, island),
 units_ AS (SELECT doc_id, w FROM plain_ UNION SELECT doc_id, w FROM regions_),
 grams_ AS (SELECT doc_id, w, {grams} AS g FROM units_ WHERE len(w) > 1),
 dice_ AS (SELECT doc_id, w, license, 2.0 * len(list_intersect(d.g, t.g)) / CAST(len(d.g) + len(t.g) AS DOUBLE) AS dice FROM grams_ d JOIN templates_ t ON len(d.g) BETWEEN 0.66 * len(t.g) AND 1.51 * len(t.g))
SELECT doc_id, license, round(max(CAST(dice AS DOUBLE)), 6) AS dice, count(*) AS n_units FROM dice_ WHERE dice >= {licenses.LEAST} GROUP BY doc_id, license"""


def _warc() -> str:
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    five = [f"CAST(concat('0x', substr(h, {5 * k + 1}, 5)) AS BIGINT)" for k in range(8)]
    digest = ", ".join(f"substr('{letters}', CAST(({v} >> {s}) & 31 AS INTEGER) + 1, 1)" for v in five for s in (15, 10, 5, 0))
    return f"""SELECT page_id, strlen(t) AS payload_bytes, concat({digest}) AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM (SELECT page_id, t, sha1(t) AS h, min(page_id) OVER (PARTITION BY t) AS first FROM (SELECT page_id, coalesce(html, '') AS t FROM pages))"""


def _line_dedup() -> str:
    """Repeated chunks of lines are made of repeated runs of two, so these, and long lines, decide."""
    d = linededup
    if d.LEAST_LINES != 2:
        raise ValueError("the SQL is written for runs of two lines")
    return f"""WITH split_ AS (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents WHERE text IS NOT NULL),
 lines_ AS (SELECT doc_id, i, x[i + 1] AS line, CASE WHEN regexp_matches(x[i + 1], '[^ \\t\\n\\x0B\\f\\r]') THEN length(x[i + 1]) - length(replace(x[i + 1], ' ', '')) + 1 ELSE 0 END AS w, CASE WHEN i + 1 < len(x) THEN concat(x[i + 1], chr(10), x[i + 2]) END AS two FROM split_, unnest(range(0, len(x))) AS u(i)),
 pairs_ AS (SELECT doc_id, i FROM lines_ WHERE two IS NOT NULL QUALIFY row_number() OVER (PARTITION BY two ORDER BY doc_id, i) > 1),
 long_ AS (SELECT doc_id, i FROM lines_ WHERE w >= {d.LONG_LINE} QUALIFY row_number() OVER (PARTITION BY line ORDER BY doc_id, i) > 1),
 found_ AS (SELECT doc_id, i FROM pairs_ UNION SELECT doc_id, i + 1 FROM pairs_ UNION SELECT doc_id, i FROM long_),
 runs_ AS (SELECT doc_id, i, w, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS run FROM found_ JOIN lines_ USING (doc_id, i)),
 gone_ AS (SELECT doc_id, i, true AS gone FROM (SELECT doc_id, i, sum(w) OVER (PARTITION BY doc_id, run) AS words FROM runs_) WHERE words >= {d.LEAST_WORDS}),
 left_ AS (SELECT l.doc_id, coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (gone IS NULL), '') AS text, count(*) FILTER (gone) AS removed FROM lines_ l LEFT JOIN gone_ g ON g.doc_id = l.doc_id AND g.i = l.i GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(removed, 0) AS removed_lines, length(l.text) AS kept_chars, md5(l.text) AS kept_md5 FROM documents d LEFT JOIN left_ l ON l.doc_id = d.doc_id"""


def _url_filter() -> str:
    upper, lower = urlfilter.UPPER, urlfilter.LOWER
    rest = lambda u: f"substr({u}, instr({u}, '://') + 3)"
    host = lambda u: f"CASE WHEN instr({u}, '://') > 0 THEN translate(regexp_extract({rest(u)}, '(?s)^([^/?#]*)', 1), '{upper}', '{lower}') ELSE '' END"
    path = lambda u: f"CASE WHEN instr({u}, '://') > 0 THEN regexp_extract({rest(u)}, '(?s)^[^/?#]*([^?#]*)', 1) ELSE '' END"
    node = lambda u: f"CASE WHEN instr({u}, '://') > 0 THEN concat(translate(substr({u}, 1, instr({u}, '://') - 1), '{upper}', '{lower}'), '://', {host(u)}, regexp_extract({rest(u)}, '(?s)^[^/?#]*([^#]*)', 1)) END"
    fits = [(f"(host = '{r.host}' OR host LIKE '%.{r.host}') AND starts_with(path, '{r.path}')", r) for r in sorted(urlfilter.RULES, key=lambda r: -len(r.text))]
    rule = "CASE " + " ".join(f"WHEN {f} THEN '{r.text}'" for f, r in fits) + " END"
    own = "CASE " + " ".join(f"WHEN {f} THEN '{r.verdict}'" for f, r in fits) + " END"
    value = lambda name: f"""trim(replace(regexp_replace(regexp_extract(tag, '(?is)[\\s"'']{name}\\s*=\\s*("[^"]*"|''[^'']*''|[^\\s>"'']+)', 1), '^["'']|["'']$', '', 'g'), '&amp;', '&'))"""
    root = lambda u: f"concat(substr({u}, 1, instr({u}, '://') - 1), '://', {host(u)})"
    found = lambda u: f"""CASE WHEN ref IS NULL OR ref = '' OR starts_with(ref, '#') THEN NULL WHEN regexp_matches(ref, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN ref WHEN starts_with(ref, '//') THEN concat(substr({u}, 1, instr({u}, '://') - 1), ':', ref)
 WHEN starts_with(ref, '/') THEN concat({root(u)}, ref) WHEN starts_with(ref, '?') THEN concat({root(u)}, {path(u)}, ref) WHEN regexp_matches(ref, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
 ELSE concat({root(u)}, coalesce(nullif(regexp_extract({path(u)}, '(?s)^(.*/)', 1), ''), '/'), ref) END"""  # noqa: E731
    # segments as lists of one, so that they fold into the list of those that stay
    fold = "list_reduce(list_concat([list_value()::VARCHAR[]], list_transform(p[2:], lambda x: [x])), lambda done, x: CASE WHEN x[1] = '.' THEN done WHEN x[1] = '..' THEN done[1:len(done) - 1] ELSE list_concat(done, x) END)"
    level = lambda rows, u, keep: f"""SELECT {keep}, CASE WHEN regexp_matches(pa, '/[.][.]?(/|$)') THEN concat(regexp_extract(u, '(?s)^(.*?://[^/?#]*)', 1), '/', array_to_string(CASE WHEN p[-1] IN ('.', '..') THEN list_concat({fold}, ['']) ELSE {fold} END, '/'), regexp_extract({rest("u")}, '(?s)^[^?#]*(.*)$', 1)) ELSE u END AS {u}
 FROM (SELECT *, {path("u")} AS pa, string_split({path("u")}, '/') AS p FROM ({rows}))"""  # noqa: E731
    return f"""WITH RECURSIVE found_ AS (SELECT url, regexp_extract(html, '(?is)<base\\s[^>]*>') AS tag, regexp_extract_all(html, '(?is)<(?:link|meta)\\s[^>]*>') AS tags FROM pages WHERE url LIKE '%://%' AND regexp_matches(html, '(?i)canonical|refresh')),
 based_ AS ({level(f"SELECT url, tags, {found('url')} AS u FROM (SELECT url, tags, {value('href')} AS ref FROM found_)", "base", "url, tags")}),
 tags_ AS (SELECT url, coalesce(base, url) AS base, unnest(tags) AS tag FROM based_),
 refs_ AS (SELECT url, base, trim(CASE WHEN list_contains(regexp_split_to_array(lower({value("rel")}), '\\s+'), 'canonical') THEN {value("href")}
 WHEN lower({value("http-equiv")}) = 'refresh' THEN regexp_extract({value("content")}, '(?is)url\\s*=\\s*["'']?([^"'']+)', 1) END) AS ref FROM tags_),
 targets_ AS ({level(f"SELECT url, {found('base')} AS u FROM refs_", "target", "url")}),
 links_ AS (SELECT DISTINCT {node("url")} AS a, {node("target")} AS b FROM targets_ WHERE target IS NOT NULL),
 both_ AS (SELECT a, b FROM links_ WHERE a <> b UNION SELECT b, a FROM links_ WHERE a <> b),
 reach_ AS (SELECT a AS node, a AS other FROM both_ UNION SELECT r.node, b FROM reach_ r JOIN both_ ON r.other = a),
 judged_ AS (SELECT node, bool_or(verdict = 'allow') AS allowed, bool_or(verdict = 'block') AS blocked FROM (SELECT node, {own} AS verdict FROM (SELECT node, {host("other")} AS host, {path("other")} AS path FROM reach_)) GROUP BY node),
 urls_ AS (SELECT page_id, {host("u")} AS host, {path("u")} AS path, {node("u")} AS node FROM (SELECT page_id, coalesce(url, '') AS u FROM pages))
SELECT page_id, host, path, {rule} AS rule, coalesce({own}, CASE WHEN blocked AND NOT coalesce(allowed, false) THEN 'block' END, 'allow') AS verdict FROM urls_ u LEFT JOIN judged_ j ON j.node = u.node"""


def _prefix_trie() -> str:
    """A prefix is its texts, joined with their lengths; a node's sums are those of all nodes whose smallest member begins with it."""
    t = prefixtrie
    bits = "list_reduce(list_prepend(xor(c, y), list_transform(range(8), lambda z: CAST(0 AS BIGINT))), lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    crc = f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, y: {bits}), 4294967295)"
    return f"""WITH own_ AS (SELECT conv_id, r, t, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r, t) AS pos FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL)),
 sizes_ AS (SELECT conv_id, count(*) AS n, CASE WHEN conv_id % {t.FAMILY} = 0 THEN 0 ELSE {crc} % {t.SHARED} END AS h FROM own_ GROUP BY conv_id),
 convs_ AS (SELECT s.conv_id, s.h, s.conv_id - s.conv_id % {t.FAMILY} AS base, least(s.h, coalesce(b.n, 0)) AS taken, least(s.h, coalesce(b.n, 0)) + greatest(s.n - s.h, 0) AS len FROM sizes_ s LEFT JOIN sizes_ b ON b.conv_id = s.conv_id - s.conv_id % {t.FAMILY}),
 turns_ AS (SELECT conv_id, pos - h + taken AS pos, r, t FROM own_ JOIN convs_ USING (conv_id) WHERE pos > h UNION ALL SELECT c.conv_id, pos, r, t FROM convs_ c JOIN own_ o ON o.conv_id = c.base AND pos <= taken),
 prefixes_ AS (SELECT conv_id, pos AS d, strlen(t) AS bytes, md5(string_agg(concat(length(r), ':', length(t), ':', r, t), '') OVER (PARTITION BY conv_id ORDER BY pos)) AS k FROM turns_ UNION ALL SELECT conv_id, 0, 0, '' FROM convs_),
 nodes_ AS (SELECT d, k, min(conv_id) AS c, count(*) AS n, any_value(bytes) AS bytes FROM prefixes_ GROUP BY d, k),
 parents_ AS (SELECT n.d, n.k, p.d AS pd, p.k AS pk FROM nodes_ n JOIN prefixes_ p ON p.conv_id = n.c AND p.d = n.d - 1),
 kids_ AS (SELECT pd AS d, pk AS k, count(*) AS kids FROM parents_ GROUP BY pd, pk),
 known_ AS (SELECT n.*, coalesce(kids, 0) AS kids FROM nodes_ n LEFT JOIN kids_ USING (d, k)),
 sums_ AS (SELECT p.d, p.k, count(*) FILTER (n.kids = 0) AS n_leaves, CAST(sum((n.n - 1) * n.bytes) AS BIGINT) AS saved FROM known_ n JOIN prefixes_ p ON p.conv_id = n.c AND p.d <= n.d GROUP BY p.d, p.k),
 ends_ AS (SELECT d, k, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ends FROM prefixes_ JOIN convs_ USING (conv_id) WHERE d = len GROUP BY d, k)
SELECT n.c AS conv_id, n.d AS depth, q.c AS parent_conv_id, n.n AS n_convs, n.kids AS n_children, n_leaves, saved AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
FROM known_ n JOIN sums_ USING (d, k) LEFT JOIN ends_ USING (d, k) LEFT JOIN parents_ p USING (d, k) LEFT JOIN nodes_ q ON q.d = p.pd AND q.k = p.pk"""


SQL: dict[str, str] = {
    "op1_secrets": _secrets(), "op2_sharding": _sharding(), "op3_licenses": _licenses(), "op5_warc": _warc(), "op8_line_dedup": _line_dedup(), "op9_url_filter": _url_filter(),
    "op11_prefix_trie": _prefix_trie(),
}
