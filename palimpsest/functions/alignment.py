"""Cutting a text into lines by what was recognised of them."""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass
from itertools import count

import numpy as np

FAR = 1e9
#: Cells of a step that are computed at once, for as many texts as have them; numbers of pairs of words compared at once.
CELLS, WORDS = 1 << 14, 1 << 20
#: How far an alignment may stray from the way between its corners at first: so far, and a word more for so many.
STRAY, STRAY_WORDS = 6, 20
#: Classes of characters, by the last five bits of their code point: letters of one alphabet differ, their cases don't.
CLASSES = 32


def _marks(words: list[str]) -> np.ndarray:
    """Each word's classes of characters as bits: one for a class that it has, another for one that it has twice or more."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.int32) % CLASSES
    owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
    n = np.bincount(owner * CLASSES + codes, minlength=len(words) * CLASSES).reshape(-1, CLASSES)
    bit = np.uint64(1) << np.arange(CLASSES, dtype=np.uint64)
    return ((n > 0) * bit).sum(axis=1, dtype=np.uint64) | ((n > 1) * (bit << np.uint64(CLASSES))).sum(axis=1, dtype=np.uint64)


def word_cost(a: str, b: str) -> float:
    """0 of equal words, else from 0.1 to 1 by the share of their marks that the other lacks."""
    x, y = map(int, _marks([a, b]))
    return 0.0 if a == b else 0.1 + 0.9 * (x ^ y).bit_count() / (x.bit_count() + y.bit_count())


def _unlike(differ: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return 0.1 + 0.9 * (np.bitwise_count(differ) / sizes)


@dataclass
class _Pair:
    """Words by number, heard and written; where lines end; and the diagonals that an alignment may use: ``low`` to ``low + width - 1``."""

    heard: np.ndarray
    words: np.ndarray
    ends: list[int]
    spare: np.ndarray
    floor: float
    stray: int

    @property
    def apart(self) -> int:
        return abs(len(self.heard) - len(self.words))

    @property
    def low(self) -> int:
        return min(0, len(self.words) - len(self.heard)) - self.stray

    @property
    def width(self) -> int:
        return self.apart + 2 * self.stray + 1

    def enough(self, cost: float, stray: int) -> bool:
        """Whether every way that strays farther costs more: it has ``stray + 1`` words more on one side, and so many and ``apart`` on the other; the other words cost their least."""
        more = stray + 1
        return more > len(self.spare) or cost < self.floor + self.apart + more + self.spare[:more].sum()


def _least_costs(some: np.ndarray, other: np.ndarray, marks: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of each word in ``some`` the least cost at any in ``other``."""
    kinds, at = np.unique(some, return_inverse=True)
    least = np.zeros(len(kinds))
    lost = np.flatnonzero(~np.isin(kinds, other))
    there, first = np.unique(marks[other], return_index=True)
    size = sizes[other[first]]
    step = max(1, WORDS // len(there))
    for k in range(0, len(lost), step):
        own = kinds[lost[k : k + step], None]
        least[lost[k : k + step]] = np.minimum(_unlike(marks[own] ^ there, sizes[own] + size).min(axis=1), 1)
    return least[at]


def _cuts_within(pairs: list[_Pair], marks: np.ndarray, sizes: np.ndarray) -> list[tuple[float, list[int]]]:
    """Cost of each pair's cheapest alignment of words within its diagonals, and the column at each of its ends; the longest heard comes first.

    A word more or less costs 1. Of each cell only the column is kept at which
    its way crossed the end before. A pair's diagonals are a row of the tables;
    costs are held less their place, so that a word more leaves them as they are.
    """
    many, width = len(pairs), max(x.width for x in pairs)
    m, n, low = (np.array(x) for x in zip(*((len(x.heard), len(x.words), x.low) for x in pairs), strict=True))
    top = int(m[0])
    # place p at step i is column i + low + p; its word stands at i + p here
    heard, words = np.full((many, top + 1), -1, np.int32), np.full((many, top + width + 1), -1, np.int32)
    for k, x in enumerate(pairs):
        heard[k, 1 : m[k] + 1] = x.heard
        some = x.words[: max(0, words.shape[1] - 1 + x.low)]
        words[k, 1 - x.low : 1 - x.low + len(some)] = some
    heard_marks, heard_sizes, word_marks, word_sizes = marks[heard], sizes[heard], marks[words], sizes[words]
    place, rows = np.arange(width), np.arange(many)[:, None] * width
    column = low[:, None] + place
    level = np.where((column >= 0) & (column <= n[:, None]), low[:, None].astype(float), FAR)
    crossed = np.zeros((many, width), np.int32)
    kept: list[list[np.ndarray]] = [[] for _ in pairs]
    stops: dict[int, list[int]] = {}
    for k, x in enumerate(pairs):
        for end in x.ends:
            stops.setdefault(end, []).append(k)

    def stop(i: int) -> None:
        todo = stops.get(i, [])
        while todo:
            now = sorted(set(todo))
            was = crossed[now]
            crossed[now] = np.clip(low[now, None] + (i + place), 0, n[now, None])
            for k, row in zip(now, was, strict=True):
                kept[k].append(row)
                todo.remove(k)

    stop(0)
    out: list[tuple[float, list[int]]] = [(FAR, [])] * many
    alive = many
    down = np.full((many, width), FAR)
    for i in range(1, top + 1):
        at = slice(i, i + width)
        sub = _unlike(word_marks[:alive, at] ^ heard_marks[:alive, i, None], word_sizes[:alive, at] + heard_sizes[:alive, i, None])
        sub *= words[:alive, at] != heard[:alive, i, None]
        across = level[:alive] + sub
        np.add(level[:alive, 1:], 2, out=down[:alive, :-1])
        from_ = crossed[:alive].copy()
        np.copyto(from_[:, :-1], crossed[:alive, 1:], where=across[:, :-1] > down[:alive, :-1])
        new = np.minimum(across, down[:alive])
        np.minimum.accumulate(new, axis=1, out=level[:alive])
        source = np.maximum.accumulate(np.where(new == level[:alive], place, 0), axis=1)
        source += rows[:alive]
        np.take(from_, source, out=crossed[:alive], mode="clip")
        stop(i)
        while alive and m[alive - 1] == i:
            alive -= 1
            x, last = pairs[alive], n[alive] - i - low[alive]
            here, cuts = int(crossed[alive, last]), []
            for end, back in zip(x.ends[::-1], kept[alive][::-1], strict=True):
                cuts.append(here)
                # a way that was never in the diagonals is not to be followed
                here = int(back[min(max(here - end - x.low, 0), width - 1)])
            out[alive] = float(level[alive, last] + last), cuts[::-1]
            kept[alive] = []
    return out


def _batches(pairs: list[_Pair]) -> list[list[_Pair]]:
    """Pairs of like widths and lengths, the longest heard first, as many as fit the cells of a step."""
    out: list[list[_Pair]] = []
    for x in sorted(pairs, key=lambda x: (-int(4 * math.log2(x.width)), -len(x.heard))):
        most = max((y.width for y in out[-1][:1]), default=0) if out else 0
        if not out or int(4 * math.log2(x.width)) != int(4 * math.log2(most)) or (len(out[-1]) + 1) * most > CELLS:
            out.append([])
        out[-1].append(x)
    return out


def _split(text: str) -> list[str]:
    return [w for w in text.split(" ") if w]


def cut_texts(recognised: list[list[str]], texts: list[str]) -> list[list[str]]:
    """Each text, whose words are a blank apart, in as many parts as it has recognised lines, cut between words so that aligning the words costs least.

    Texts of like sizes are aligned at once. The diagonals grow until the cost
    that was found in them is less than that of any way outside; then what was
    found is the cheapest.
    """
    number: dict[str, int] = defaultdict(count().__next__)
    numbers = lambda some: np.fromiter(map(number.__getitem__, some), np.int32, len(some))
    cuts: list[list[int]] = []
    named: list[tuple[int, np.ndarray, np.ndarray, list[int]]] = []
    for k, (own, text) in enumerate(zip(recognised, texts, strict=True)):
        lines, words = [_split(x) for x in own], _split(text)
        ends = np.cumsum([len(x) for x in lines[:-1]]).astype(int).tolist()
        heard = [w for x in lines for w in x]
        cuts.append(ends if heard == words else [0] * len(ends))
        if ends and heard and words and heard != words:
            named.append((k, numbers(heard), numbers(words), ends))
    todo: dict[int, _Pair] = {}
    if named:
        # what stands beyond a text has the last number
        marks = np.append(_marks(list(number)), np.uint64(0))
        sizes = np.maximum(np.bitwise_count(marks), 1).astype(np.float32)
        for k, a, b, ends in named:
            least = _least_costs(a, b, marks, sizes) if len(a) <= len(b) else _least_costs(b, a, marks, sizes)
            todo[k] = _Pair(a, b, ends, np.sort(1 - least), float(least.sum()), STRAY + min(len(a), len(b)) // STRAY_WORDS)
    while todo:
        key = {id(x): k for k, x in todo.items()}
        for some in _batches(list(todo.values())):
            for x, (cost, found) in zip(some, _cuts_within(some, marks, sizes), strict=True):
                if x.enough(cost, x.stray):
                    cuts[key[id(x)]] = found
                    del todo[key[id(x)]]
                else:
                    most = 4 * x.stray + 4
                    x.stray = next((n for n in range(x.stray + 1, most) if x.enough(cost, n)), most)
    out = []
    for own, found, text in zip(recognised, cuts, texts, strict=True):
        words = _split(text)
        edges = [0, *found, len(words)]
        out.append([" ".join(words[a:b]) for a, b in zip(edges, edges[1:], strict=False)] if own else [])
    return out


def cut_lines(recognised: list[str], text: str) -> list[str]:
    """As ``cut_texts``, of one text."""
    return cut_texts([recognised], [text])[0]
