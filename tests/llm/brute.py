"""What the contracts say, row by row in plain Python; slow and without Spark."""

import base64
import hashlib
import re
import unicodedata
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
KINDS = ("assign", "access", "hex")
PATTERNS = {
    "assign": re.compile(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}


def secrets(text):
    found = []
    for k, kind in enumerate(KINDS):
        for m in PATTERNS[kind].finditer(text or ""):
            size = len(m[2]) if kind == "assign" else len(m[0])
            if size >= {"assign": 6, "access": 20, "hex": 24}[kind]:
                found.append((m.start(), k, m.end(), kind))
    found.sort()
    joined = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in found)
    return (*(sum(x[3] == k for x in found) for k in KINDS), hashlib.sha256(joined.encode()).hexdigest()), joined


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def fingerprint(text, size=3):
    words = WORD.findall(lower(text))
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] if len(words) > size else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def bits(a, b):
    return ((a ^ b) & (1 << 64) - 1).bit_count()


def components(prints, most=3):
    """prints: list of (id, fingerprint); returns id -> least id reachable."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= most:
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(prints):
        least[root(i)] = min(d, least.get(root(i), d))
    return {d: least[root(i)] for i, (d, _) in enumerate(prints)}


def warc(pages):
    first = {}
    for pid, html in pages:
        first[html or ""] = min(pid, first.get(html or "", pid))
    out = {}
    for pid, html in pages:
        raw = (html or "").encode()
        again = first[html or ""] != pid
        out[pid] = (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", first[html or ""] if again else None)
    return out


def tiktoken_encoding():
    import public_tokenizers as P
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def url(u):
    if u is None or "://" not in u:
        return "", "", None, None
    rest = u.split("://", 1)[1]
    host = lower(re.match(r"[^/?#]*", rest)[0])
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, None))
    return host, path, best[1], best[2]


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] >= 2 for k in range(3)}
    lines, seen, dup = text.split("\n"), set(), 0
    for x in lines:
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def weight(line):
    return line.count(" ") + 1 if re.search(r"[^ \t\n\x0b\f\r]", line) else 0


def line_dedup(docs):
    """docs: list of (id, text); returns id -> text left. Every run of two lines, and every line of 50 words, in plain sight."""
    places = defaultdict(list)
    for d, t in docs:
        lines = [] if t is None else t.split("\n")
        for i in range(len(lines)):
            if i + 1 < len(lines):
                places[lines[i], lines[i + 1]].append((d, i, 2))
            if weight(lines[i]) >= 50:
                places[lines[i]].append((d, i, 1))
    gone = defaultdict(set)
    for where in places.values():
        for d, i, n in where:
            if (d, i) != min(where)[:2]:
                gone[d] |= set(range(i, i + n))
    out = {}
    for d, t in docs:
        if t is None:
            out[d] = None
            continue
        lines, keep, run = t.split("\n"), [], []
        for i, x in enumerate([*lines, None]):
            if x is not None and i in gone[d]:
                run.append(x)
                continue
            keep += run if sum(map(weight, run)) < 25 else []
            keep, run = keep + [x], []
        out[d] = "\n".join(keep[:-1])
    return out


def normal(text):
    return re.sub(r"[!-/:-@\[-`{-~]", "", (text or "").lower()).split()


def leaks(docs, items, least=0.8, size=5):
    """Every window of an item's length against the item: (doc, item) with a similarity of ``least`` or more."""
    shingles = lambda w: [tuple(w[i : i + size]) for i in range(len(w) - size + 1)] if len(w) >= size else [tuple(w)] if w else []
    out = set()
    for item, text in items:
        words = normal(text)
        bag = Counter(shingles(words))
        for d, t in docs:
            w = normal(t)
            for a in range(max(1, len(w) - len(words) + 1)):
                got = Counter(shingles(w[a : a + len(words)]))
                if bag and sum((bag & got).values()) / sum(bag.values()) >= least:
                    out.add((d, item))
                    break
    return out


def best_windows(docs, items, least=0.8, size=5, radius=24):
    """(doc, item) -> (similarity, first word, differing bits) of the best of all windows of the item's length within the radius, the first of equals."""
    shingles = lambda w: [" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] if len(w) >= size else [" ".join(w)] if w else []

    def bits(grams):
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in grams]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    out = {}
    for item, text in items:
        words = normal(text)
        bag = Counter(shingles(words))
        for d, t in docs:
            w = normal(t)
            for a in range(max(1, len(w) - len(words) + 1)) if bag else ():
                window = shingles(w[a : a + len(words)])
                s = sum((bag & Counter(window)).values()) / sum(bag.values())
                if s >= least and s > out.get((d, item), (0,))[0]:
                    differ = (bits(window) ^ bits(shingles(words))).bit_count()
                    if differ <= radius:
                        out[d, item] = (s, a, differ)
    return out


def quality_votes(text):
    """The nine votes, by the thresholds as they stand."""
    text = text or ""
    n, chars, symbols, dup, repeated, _ = quality(text)
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    kind = [unicodedata.category(c) for c in text]
    letters, upper = sum(k[0] == "L" for k in kind), kind.count("Lu")
    per = lambda a, b: a / max(b, 1)
    at_most = lambda x, good, bad: -1 if x >= bad else 1 if x <= good else 0
    share, length, variety = per(letters, chars), per(chars, n), per(len(set(words)), n)
    return (
        at_most(per(symbols, n), 0.02, 0.1), -1 if share <= 0.9 else 1 if share >= 0.93 else 0, -1 if length <= 4.2 or length >= 7.2 else 1 if 4.5 <= length <= 6.5 else 0, at_most(per(upper, letters), 0.1, 0.4),
        at_most(per(len(re.findall("[!?]", text)), n), 0.1, 0.4), at_most(per(len(re.findall("[0-9]", text)), chars), 0.1, 0.2), at_most(per(repeated, n), 0.1, 0.4), -1 if variety <= 0.15 else 1 if variety >= 0.5 else 0, at_most(per(dup, len(lines)), 0.2, 0.4),
    )


def qualities(docs, rounds=100):
    """id -> (posterior, kept): expectation-maximisation text by text, over those that pass the base rules."""
    votes = {d: quality_votes(t) for d, t in docs}
    failed = {d: quality(t)[-1] for d, t in docs}
    share, good, bad = 0.6, [0.95] * 9, [0.5] * 9

    def posterior(v):
        yes, no = share, 1 - share
        for j, x in enumerate(v):
            if x:
                yes *= good[j] if x > 0 else 1 - good[j]
                no *= bad[j] if x < 0 else 1 - bad[j]
        return yes / (yes + no)

    for _ in range(rounds):
        ps = [(posterior(votes[d]), votes[d]) for d, _ in docs if not failed[d]]
        new_good, new_bad = [], []
        for j in range(9):
            cast = [(p, v[j]) for p, v in ps if v[j]]
            g = (9.5 + sum(p for p, v in cast if v > 0)) / (10 + sum(p for p, _ in cast))
            b = (5 + sum(1 - p for p, v in cast if v < 0)) / (10 + sum(1 - p for p, _ in cast))
            new_good.append(min(0.99, max(0.01, g)))
            new_bad.append(max(min(0.99, max(0.01, b)), 1 - new_good[-1]))
        share = min(0.95, max(0.05, (6 + sum(p for p, _ in ps)) / (10 + len(ps))))
        good, bad = new_good, new_bad
    return {d: (posterior(votes[d]), not failed[d] and posterior(votes[d]) >= 0.5) for d, _ in docs}


def license_regions(text):
    """Runs of lines with half of their bigrams from one long template, as texts."""
    from palimpsest.llm.license_texts import TEMPLATES

    words = lambda t: re.findall(r"[^\W_]+", t.lower())
    grams = lambda w: set(zip(w, w[1:]))
    lines, out = [w for w in map(words, text.split("\n")) if len(w) > 1], []
    for template in TEMPLATES.values():
        own = grams(words(template))
        run = []
        for i, w in enumerate(lines if len(own) >= 20 and len(lines) > 1 else ()):
            if 2 * len(grams(w) & own) >= len(grams(w)):
                if run and i - run[1] > 2:
                    out.append(run)
                    run = []
                run = [run[0] if run else i, i]
        out += [run] if run else []
    return [" ".join(x for w in lines[a : z + 1] for x in w) for a, z in out]
