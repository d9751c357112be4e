"""Sequential kernels that columns can't express, over whole Arrow batches."""

from __future__ import annotations

import math
from collections import defaultdict
from itertools import count

import numpy as np


#: Cells of the tables of costs that are held at once.
CELLS = 8_000_000
#: Pairs of texts of up to 64 characters whose distances are found at once.
PAIRS = 4096
FAR = 1 << 29


def _affixes(a: str, b: str) -> tuple[int, int]:
    """Lengths of the common beginning and, of what is left, the common end."""
    most = min(len(a), len(b))
    head = next((i for i in range(most) if a[i] != b[i]), most)
    tail = next((i for i in range(most - head) if a[-1 - i] != b[-1 - i]), most - head)
    return head, tail


def substitutions(predicted: list[str], reference: list[str], errors: list[int]) -> tuple[list[int], list[int], list[str], list[str]]:
    """Substituted characters as columns (pair, place from the end, predicted, reference); ``errors`` are the pairs' edit distances.

    On the way back from the end a match goes before a substitution, that before
    a dropped predicted character, and that before a missing one. Two of one
    length that differ at as many places as their distance have no other way
    than place by place. Of the rest the common beginning and end, where the way
    holds matches alone, are left out, and the tables are filled for many at
    once, by anti-diagonals. A pair whose table alone would be too large is
    gone through row by row, no farther from the diagonal than its distance.
    """
    found: list[list[tuple[str, str]]] = [[] for _ in predicted]
    hard = []
    for k, (p, r, e) in enumerate(zip(predicted, reference, errors, strict=True)):
        if len(p) == len(r):
            odd = [(x, y) for x, y in zip(p, r, strict=True) if x != y]
            if len(odd) == e:
                found[k] = odd[::-1]
                continue
        head, tail = _affixes(p, r)
        p, r = p[head : len(p) - tail], r[head : len(r) - tail]
        if p and r and (len(p) + 1) * (len(r) + 1) > CELLS:
            found[k] = _long_way(p, r, e)
        elif p and r:
            hard.append((max(len(p), len(r)), k, p, r))
    hard.sort(key=lambda x: x[0])
    while hard:
        n = max(1, min(len(hard), CELLS // (hard[-1][0] + 1) ** 2))
        some, hard = hard[-n:], hard[:-n]
        for (_, k, _, _), subs in zip(some, _ways([x[2] for x in some], [x[3] for x in some]), strict=True):
            found[k] = subs
    flat = [(k, i, x, y) for k, subs in enumerate(found) for i, (x, y) in enumerate(subs)]
    return tuple(map(list, zip(*flat, strict=True))) if flat else ([], [], [], [])


def _codes(texts: list[str], fill: int) -> np.ndarray:
    out = np.full((max(map(len, texts)), len(texts)), fill, np.int32)
    for k, t in enumerate(texts):
        out[: len(t), k] = np.frombuffer(t.encode("utf-32-le"), np.int32)
    return out


def _ways(predicted: list[str], reference: list[str]) -> list[list[tuple[str, str]]]:
    """Substitutions of pairs of texts that aren't empty, from the end."""
    p, r = _codes(predicted, -1), _codes(reference, -2)
    m, n, size = len(p), len(r), len(predicted)
    cost = np.zeros((m + 1, n + 1, size), np.int16 if m + n < 32_000 else np.int32)
    cost[:, 0], cost[0] = np.arange(m + 1)[:, None], np.arange(n + 1)[:, None]
    for d in range(2, m + n + 1):
        i = np.arange(max(1, d - n), min(m, d - 1) + 1)
        j = d - i
        swap = cost[i - 1, j - 1] + (p[i - 1] != r[j - 1])
        cost[i, j] = np.minimum(np.minimum(cost[i - 1, j], cost[i, j - 1]) + 1, swap)
    out: list[list[tuple[str, str]]] = [[] for _ in predicted]
    i, j, at = np.array([len(x) for x in predicted]), np.array([len(x) for x in reference]), np.arange(size)
    while len(at := at[(i[at] > 0) & (j[at] > 0)]):
        a, b = i[at], j[at]
        here, same = cost[a, b, at], p[a - 1, at] == r[b - 1, at]
        swap = ~same & (here == cost[a - 1, b - 1, at] + 1)
        drop = ~same & ~swap & (here == cost[a - 1, b, at] + 1)
        for k, x, y in zip(at[swap], a[swap], b[swap], strict=True):
            out[k].append((predicted[k][x - 1], reference[k][y - 1]))
        i[at] -= same | swap | drop
        j[at] -= ~drop
    return out


def _long_way(predicted: str, reference: str, errors: int) -> list[tuple[str, str]]:
    """As ``_ways``, of one long pair: a band about the diagonal as wide as the distance allows, of which every so-manieth row is kept and the rows between are made again on the way back."""
    p, r = (np.frombuffer(t.encode("utf-32-le"), np.int32) for t in (predicted, reference))
    m, n, band = len(p), len(r), errors
    width = 2 * band + 1
    place = np.arange(width, dtype=np.int32)
    padded = np.concatenate([np.full(band + 1, -1, np.int32), r, np.full(m + band + 2, -1, np.int32)])

    def below(row: np.ndarray, i: int) -> np.ndarray:
        """Row i from row i - 1; place k is column i + k - band."""
        new = np.minimum(np.append(row[1:], FAR) + 1, row + (padded[i : i + width] != p[i - 1]))
        column = place + (i - band)
        new[(column < 0) | (column > n)] = FAR
        new = np.minimum(np.minimum.accumulate(new - place) + place, FAR)
        new[(column < 0) | (column > n)] = FAR
        return new

    first = np.where((place >= band) & (place - band <= n), place - band, FAR).astype(np.int32)
    step = max(1, int(m**0.5))
    marks, row = [first], first
    for i in range(1, m + 1):
        row = below(row, i)
        if i % step == 0:
            marks.append(row)
    out, i, j = [], m, n
    while i and j:
        base = (i - 1) // step
        rows = [marks[base]]
        for k in range(base * step + 1, i + 1):
            rows.append(below(rows[-1], k))
        at = lambda i, j: rows[i - base * step][j - i + band] if 0 <= j - i + band < width else FAR  # noqa: E731, B023
        while j and i > base * step:
            here = at(i, j)
            if p[i - 1] == r[j - 1]:
                i, j = i - 1, j - 1
            elif here == at(i - 1, j - 1) + 1:
                out.append((predicted[i - 1], reference[j - 1]))
                i, j = i - 1, j - 1
            elif here == at(i - 1, j) + 1:
                i -= 1
            else:
                j -= 1
    return out


def edit_distances(a: list[str], b: list[str]) -> np.ndarray:
    """Edit distances of pairs of texts by bit-parallel columns of the table of costs (Myers, 1999; blocks of 64 rows after Hyyro, 2003), many pairs at once."""
    out = np.zeros(len(a), np.int64)
    hard = []
    for k, (x, y) in enumerate(zip(a, b, strict=True)):
        if x == y:
            continue
        if len(x) > len(y):
            x, y = y, x
        if not len(x):
            out[k] = len(y)
        else:
            hard.append(((len(x) + 63) // 64, len(y), k, x, y))
    hard.sort(key=lambda h: h[:2], reverse=True)
    first = 0
    while first < len(hard):
        most = first + max(1, PAIRS // hard[first][0])
        last = next((i for i in range(first, min(most, len(hard))) if hard[i][0] != hard[first][0]), min(most, len(hard)))
        some = hard[first:last]
        out[[h[2] for h in some]] = _distances([h[3] for h in some], [h[4] for h in some], some[0][0])
        first = last
    return out


def spelled(a: list[str], b: list[str]) -> tuple[str, str]:
    """Two lists of words as texts: each distinct word of both is a character."""
    letters: dict[str, str] = defaultdict(map(chr, count(1)).__next__)
    return "".join([letters[w] for w in a]), "".join([letters[w] for w in b])


def _numbered(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All characters of all texts, one after the other, as numbers, and the texts' lengths."""
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.int32), np.array([len(t) for t in texts], int)


def _distances(patterns: list[str], texts: list[str], blocks: int) -> np.ndarray:
    """Distances of patterns of ``blocks`` blocks to texts, the longest text first; none is empty."""
    size = len(patterns)
    flat, sizes = _numbered([*patterns, *texts])
    kinds, codes = np.unique(flat, return_inverse=True)
    if size > 1 and blocks * size * len(kinds) > CELLS:
        return np.concatenate([_distances(patterns[k], texts[k], blocks) for k in (slice(size // 2), slice(size // 2, None))])
    table = np.full((2 * size, sizes.max()), len(kinds), np.int64)
    table[np.arange(table.shape[1]) < sizes[:, None]] = codes
    m, n, line, one = sizes[:size], sizes[size:], np.arange(size), np.uint64(1)
    equal = np.zeros((blocks, size, len(kinds) + 1), np.uint64)
    for k in range(m.max()):
        some = np.flatnonzero(m > k)
        equal[k // 64, some, table[some, k]] |= one << np.uint64(k % 64)
    text = np.ascontiguousarray(table[size:].T)
    top = (m - 1).astype(np.uint64) % np.uint64(64)
    more, less = np.full((blocks, size), ~np.uint64(0)), np.zeros((blocks, size), np.uint64)
    score, alive = m.copy(), size
    for j in range(n.max()):
        while n[alive - 1] <= j:
            alive -= 1
        at = slice(None, alive)
        up, down = np.uint64(1), np.uint64(0)
        for w in range(blocks):
            eq, p, q = equal[w, line[at], text[j, at]], more[w, at], less[w, at]
            xv = eq | q
            eq |= down
            xh = (((eq & p) + p) ^ p) | eq
            h, g = q | ~(xh | p), p & xh
            if w == blocks - 1:
                score[at] += (h >> top[at] & one).astype(np.int64) - (g >> top[at] & one).astype(np.int64)
            h, g, up, down = h << one | up, g << one | down, h >> np.uint64(63), g >> np.uint64(63)
            more[w, at] = g | ~(xv | h)
            less[w, at] = h & xv
    return score


def shared_counts(a: list[str], b: list[str]) -> tuple[list[str], np.ndarray]:
    """Characters of both texts of all pairs, and for each of them in rows: how often ``b`` has it, and summed over the pairs the occurrences that both have, those that ``a`` alone and those that ``b`` alone has."""
    (x, nx), (y, ny) = _numbered(a), _numbered(b)
    kinds, codes = np.unique(np.concatenate([x, y]), return_inverse=True)
    out = np.zeros((len(kinds), 4), np.int64)
    at_x, at_y = np.concatenate([[0], nx.cumsum()]), np.concatenate([[0], ny.cumsum()])
    step = max(1, CELLS // 2 // max(1, len(kinds)))
    for k in range(0, len(a), step):
        end = min(k + step, len(a))
        bags = []
        for own, at, sizes in ((codes[: len(x)], at_x, nx), (codes[len(x) :], at_y, ny)):
            line = np.repeat(np.arange(end - k), sizes[k:end])
            bags.append(np.bincount(line * len(kinds) + own[at[k] : at[end]], minlength=(end - k) * len(kinds)).reshape(end - k, len(kinds)))
        both = np.minimum(*bags).sum(axis=0)
        mine, theirs = (bag.sum(axis=0) for bag in bags)
        out += np.stack([theirs, both, mine - both, theirs - both], axis=1)
    return [chr(c) for c in kinds], out


def log_add(a: float, b: float) -> float:
    top, low = (a, b) if a > b else (b, a)
    return top if low == -math.inf else top + math.log1p(math.exp(low - top))


class WordBonus:
    """``alpha * ln(score + 1e-10) + beta`` for a known word that a space has just closed."""

    def __init__(self, scores: dict[str, float], alpha: float, beta: float):
        self.scores, self.alpha, self.beta = scores, alpha, beta

    def __call__(self, text: str) -> float:
        word = text.rstrip(" ").rpartition(" ")[2]
        return self.alpha * math.log(self.scores[word] + 1e-10) + self.beta if self.alpha > 0 and word in self.scores else 0.0


def beam_simple(steps: np.ndarray, vocab: list[str], blank: int, width: int, bonus: WordBonus | None = None) -> list[tuple[str, float, list[int]]]:
    """One score per prefix, as the pipeline this follows does it.

    Whether a prefix last saw a blank is as its first arrival in a step had it;
    later arrivals only add their probability. So after a repeat a prefix
    counts as blank-ended, unlike in an exact prefix search.

    A step is a table of beams by classes. Row by row it is the order of
    arrival, with the blank's column, which keeps the prefix, put first; a
    prefix may arrive twice only where one beam grows into another.
    """
    classes = steps.shape[1]
    order = np.array([blank, *(c for c in range(classes) if c != blank)])
    space = np.array([v == " " for v in vocab])
    keys: list[tuple[int, ...]] = [()]
    score, last, ended = np.zeros(1), np.full(1, -1), np.zeros(1, bool)
    for row in steps:
        table = score[:, None] + row[order][None, :]
        if bonus is not None:
            closes = np.array([0.0 if k and space[k[-1]] else bonus("".join(vocab[c] for c in k)) for k in keys])
            table += closes[:, None] * space[order][None, :]
        stays = (order[None, :] == last[:, None]) & ~ended[:, None]
        stays[:, 0] = True
        if bonus is not None:  # a repeated space closes nothing
            again = stays[:, 1:] & space[order][None, 1:]
            table[:, 1:] -= np.where(again, closes[:, None], 0.0)
        first = {k: i * classes for i, k in enumerate(keys)}  # where each prefix arrives first
        flat, alive = table.ravel(), np.ones(table.size, bool)
        twice = [(i * classes + c, i) for i, c in zip(*np.nonzero(stays), strict=True) if c]
        place = {k: i for i, k in enumerate(keys)}
        for k, i in place.items():
            parent = place.get(k[:-1]) if k else None
            if parent is not None and not ((c := k[-1]) == last[parent] and not ended[parent]):
                twice.append((parent * classes + int(np.flatnonzero(order == c)[0]), i))
        into: dict[int, list[int]] = {}
        for at, i in twice:
            into.setdefault(i, []).append(at)
        for i, ats in into.items():
            head, *more = sorted([first[keys[i]], *ats])
            for at in more:
                flat[head] = log_add(float(flat[head]), float(flat[at]))
                alive[at] = False
        kept = np.flatnonzero(alive)
        best = kept[np.argsort(-flat[kept], kind="stable")[:width]]
        beam, c = np.divmod(best, classes)
        keep = stays[beam, c]
        keys = [keys[i] if s else (*keys[i], int(order[k])) for i, k, s in zip(beam, c, keep, strict=True)]
        score, last, ended = flat[best], np.where(c == 0, last[beam], order[c]), c == 0
    return [("".join(vocab[k] for k in key), float(s), list(key)) for key, s in zip(keys, score, strict=True)]


def beam_exact(steps: np.ndarray, vocab: list[str], blank: int, width: int, bonus: WordBonus | None = None) -> list[tuple[str, float, list[int]]]:
    """CTC prefix search: each prefix keeps the probability of ending in a blank and of ending in its last token apart.

    A step is a table of beams by classes for the prefixes that grow, and a
    column for those that stay; a beam that grows into another is added to it.
    """
    classes = steps.shape[1]
    space = np.array([v == " " for v in vocab])
    keys: list[tuple[int, ...]] = [()]
    in_blank, in_token = np.zeros(1), np.full(1, -np.inf)
    for row in steps:
        total, n = np.logaddexp(in_blank, in_token), len(keys)
        grown = total[:, None] + row[None, :]
        stay = in_token.copy()
        for i, k in enumerate(keys):
            if k:
                grown[i, k[-1]] = in_blank[i] + row[k[-1]]
                stay[i] += row[k[-1]]
        if bonus is not None:
            closes = np.array([0.0 if k and space[k[-1]] else bonus("".join(vocab[c] for c in k)) for k in keys])
            grown += closes[:, None] * space[None, :]
        grown[:, blank] = -np.inf
        own, arrival = np.arange(n) * (classes + 1), np.arange(n)[:, None] * (classes + 1) + 1 + np.arange(classes)
        place = {k: i for i, k in enumerate(keys)}
        for k, j in place.items():
            i = place.get(k[:-1]) if k else None
            if i is not None:
                stay[j] = np.logaddexp(stay[j], grown[i, k[-1]])
                own[j] = min(own[j], arrival[i, k[-1]])
                grown[i, k[-1]] = -np.inf
        rest = total + row[blank]
        score = np.concatenate([np.logaddexp(rest, stay), grown.ravel()])
        possible = np.flatnonzero(score > -np.inf)
        best = possible[np.lexsort((np.concatenate([own, arrival.ravel()])[possible], -score[possible]))[:width]]
        old = best < n
        keys = [keys[x] if o else (*keys[(x - n) // classes], int((x - n) % classes)) for x, o in zip(best.tolist(), old, strict=True)]
        at = np.minimum(best, n - 1)
        in_blank, in_token = np.where(old, rest[at], -np.inf), np.where(old, stay[at], score[best])
    return [("".join(vocab[c] for c in k), float(s), list(k)) for k, s in zip(keys, np.logaddexp(in_blank, in_token), strict=True)]


def ctc_loss(steps: np.ndarray, target: list[int], blank: int) -> float:
    """Negative log-probability of the target over all alignments; infinity if it can't fit into the steps."""
    states = [blank, *(x for t in target for x in (t, blank))]
    skip = np.array([k >= 2 and s != blank and s != states[k - 2] for k, s in enumerate(states)])
    alpha = np.full(len(states), -np.inf)
    for n, row in enumerate(steps):
        if n:
            before = np.concatenate((np.full(2, -np.inf), alpha))
            alpha = np.logaddexp(np.logaddexp(alpha, before[1:-1]), np.where(skip, before[:-2], -np.inf)) + row[states]
        else:
            alpha[:2] = row[states[:2]]
    return float(-np.logaddexp.reduce(alpha[-2:]))
