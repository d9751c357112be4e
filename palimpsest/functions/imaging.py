"""Small numeric helpers on one grey image, or one page's points; Spark deals the pages and blocks out."""

from __future__ import annotations

import math

import numpy as np


def otsu_level(grey: np.ndarray) -> int:
    """The least level whose split from what lies above has the greatest variance between the classes."""
    n = np.bincount(grey.ravel(), minlength=256).astype(float)
    w0, s0 = n.cumsum(), (n * np.arange(256)).cumsum()
    with np.errstate(divide="ignore", invalid="ignore"):
        between = w0 * (w0[-1] - w0) * (s0 / w0 - (s0[-1] - s0) / (w0[-1] - w0)) ** 2
    return int(np.nan_to_num(between).argmax())


def joined_runs(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The component of each run of pixels (start to end, end exclusive), ordered by row and start: runs of neighbouring rows that touch, at corners too, are one.

    Union-find over runs; neighbours are found by going down two rows at once.
    """
    parent = list(range(len(row)))

    def root(a: int) -> int:
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        return a

    above = 0
    rows, starts, ends = row.tolist(), start.tolist(), end.tolist()
    for k, r in enumerate(rows):
        while above < k and (rows[above] < r - 1 or rows[above] == r - 1 and ends[above] < starts[k]):
            above += 1
        other = above
        while other < k and rows[other] == r - 1 and starts[other] <= ends[k]:
            a, b = root(other), root(k)
            parent[max(a, b)] = min(a, b)
            other += 1
    return np.array([root(k) for k in range(len(rows))], np.int64)


def hull(points: np.ndarray) -> np.ndarray:
    """Corners of the convex hull in turn, of integer points ``(x, y)`` without repeats."""
    ordered = sorted(map(tuple, points.tolist()))
    if len(ordered) < 3:
        return np.array(ordered)

    def half(some: list) -> list:
        out: list = []
        for p in some:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]):
                out.pop()
            out.append(p)
        return out[:-1]

    return np.array(half(ordered) + half(ordered[::-1]))


def least_rectangle(corners: np.ndarray) -> tuple[float, float]:
    """Area and angle of the least rectangle round a hull, one of whose sides has a side of the hull in it.

    The angle is that of a side's direction in (x, y), in degrees, turned by
    right angles into [-45, 45). Of rectangles of equal area the one with the
    least turn counts, of these the one with the negative angle.
    """
    sides = np.roll(corners, -1, axis=0) - corners
    sides = sides[(sides != 0).any(axis=1)]
    if not len(sides):
        return 0.0, 0.0
    along = corners @ sides.T
    across = corners[:, :1] * sides[:, 1] - corners[:, 1:] * sides[:, 0]
    area = np.ptp(along, axis=0) * np.ptp(across, axis=0) / (sides**2).sum(axis=1)
    # turned by right angles in integers, so that equal directions give equal angles
    x, y = sides[:, 0], sides[:, 1]
    for _ in range(3):
        turn = ~((x > 0) & (-x <= y) & (y < x))
        x, y = np.where(turn, -y, x), np.where(turn, x, y)
    angle = np.degrees(np.arctan2(y, x))
    best = np.lexsort((angle, np.abs(angle), area))[0]
    return float(area[best]), float(angle[best])


def _at(grey: np.ndarray, x: np.ndarray, y: np.ndarray, border: int | None) -> np.ndarray:
    """Levels at integer places; beyond the edge the border's, or with None the nearest pixel's."""
    h, w = grey.shape
    level = grey[np.clip(y, 0, h - 1), np.clip(x, 0, w - 1)].astype(float)
    return level if border is None else np.where((x >= 0) & (x < w) & (y >= 0) & (y < h), level, border)


def _bilinear(grey: np.ndarray, x: np.ndarray, y: np.ndarray, border: int | None) -> np.ndarray:
    x0, y0 = np.floor(x).astype(np.int64), np.floor(y).astype(np.int64)
    fx, fy = x - x0, y - y0
    top = _at(grey, x0, y0, border) * (1 - fx) + _at(grey, x0 + 1, y0, border) * fx
    low = _at(grey, x0, y0 + 1, border) * (1 - fx) + _at(grey, x0 + 1, y0 + 1, border) * fx
    return top * (1 - fy) + low * fy


def rotated(grey: np.ndarray, angle: float, border: int = 255) -> np.ndarray:
    """Turned counter-clockwise by ``angle`` degrees about its centre, on a canvas that holds all of it, by inverse mapping and bilinear sampling."""
    h, w = grey.shape
    cos, sin = math.cos(math.radians(angle)), math.sin(math.radians(angle))
    new_w, new_h = int(h * abs(sin) + w * abs(cos)), int(h * abs(cos) + w * abs(sin))
    y, x = np.indices((new_h, new_w))
    x, y = x - new_w / 2, y - new_h / 2
    return np.rint(_bilinear(grey, x * cos - y * sin + w / 2, x * sin + y * cos + h / 2, border)).astype(np.uint8)


def resized(grey: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear, pixel centres on pixel centres, edges repeated; levels rounded."""
    h, w = grey.shape
    y = (np.arange(height) + 0.5) * h / height - 0.5
    x = (np.arange(width) + 0.5) * w / width - 0.5
    return np.rint(_bilinear(grey, *np.meshgrid(x, y), None)).astype(np.uint8)


def _mirrored(at: np.ndarray, n: int) -> np.ndarray:
    """Places beyond the edge mirrored at the edge pixel, which isn't repeated."""
    at = np.abs(at) % max(2 * (n - 1), 1)
    return np.minimum(at, 2 * (n - 1) - at) if n > 1 else np.zeros_like(at)


def equalized(grey: np.ndarray, clip: float = 2.0, tiles: tuple[int, int] = (8, 8)) -> np.ndarray:
    """Contrast-limited adaptive histogram equalisation.

    The image, mirrored to a multiple of the tiles, gets a histogram a tile; what
    is above the limit is dealt out over all levels, a rest to every so-manieth.
    Levels are mapped by the cumulative histograms of the four tiles round a
    pixel, weighted by its distance from their centres.
    """
    h, w = grey.shape
    gx, gy = tiles
    th, tw = -(-h // gy), -(-w // gx)
    padded = grey[np.ix_(_mirrored(np.arange(th * gy), h), _mirrored(np.arange(tw * gx), w))]
    blocks = padded.reshape(gy, th, gx, tw).transpose(0, 2, 1, 3).reshape(gy * gx, th * tw)
    n = np.stack([np.bincount(b, minlength=256) for b in blocks])
    limit = max(int(clip * th * tw / 256), 1)
    over = np.maximum(n - limit, 0).sum(axis=1)
    n = np.minimum(n, limit) + (over // 256)[:, None]
    rest = over % 256
    step = np.maximum(256 // np.maximum(rest, 1), 1)
    level = np.arange(256)
    n += (level % step[:, None] == 0) & (level // step[:, None] < rest[:, None])
    maps = np.rint(n.cumsum(axis=1) * (255 / (th * tw))).clip(0, 255).reshape(gy, gx, 256)
    fy, fx = np.arange(h) / th - 0.5, np.arange(w) / tw - 0.5
    y0, x0 = np.floor(fy).astype(int), np.floor(fx).astype(int)
    wy, wx = (fy - y0)[:, None], (fx - x0)[None, :]
    tile = lambda dy, dx: maps[np.clip(y0 + dy, 0, gy - 1)[:, None], np.clip(x0 + dx, 0, gx - 1)[None, :], grey]
    return np.rint((tile(0, 0) * (1 - wx) + tile(0, 1) * wx) * (1 - wy) + (tile(1, 0) * (1 - wx) + tile(1, 1) * wx) * wy).astype(np.uint8)


def _box_sums(values: np.ndarray, side: int) -> np.ndarray:
    """Sums over squares, by a summed-area table."""
    table = np.zeros((values.shape[0] + 1, values.shape[1] + 1))
    table[1:, 1:] = values.cumsum(axis=0).cumsum(axis=1)
    return table[side:, side:] - table[:-side, side:] - table[side:, :-side] + table[:-side, :-side]


def denoised(block: np.ndarray, halo: int, strength: float, patch: int = 7, search: int = 21) -> np.ndarray:
    """Non-local means of a block that comes with ``halo`` pixels all round: each pixel becomes the mean of the pixels of its search square, weighted by how like their patches are."""
    reach = search // 2
    inner = block[halo - patch // 2 : len(block) - halo + patch // 2, halo - patch // 2 : block.shape[1] - halo + patch // 2].astype(float)
    h, w = len(block) - 2 * halo, block.shape[1] - 2 * halo
    total, weights = np.zeros((h, w)), np.zeros((h, w))
    for dy in range(-reach, reach + 1):
        for dx in range(-reach, reach + 1):
            y, x = halo - patch // 2 + dy, halo - patch // 2 + dx
            other = block[y : y + inner.shape[0], x : x + inner.shape[1]].astype(float)
            weight = np.exp(-_box_sums((inner - other) ** 2, patch) / (patch * patch * strength * strength))
            weight[weight < 1e-3] = 0.0
            total += weight * block[halo + dy : halo + dy + h, halo + dx : halo + dx + w]
            weights += weight
    return np.rint(total / weights).astype(np.uint8)
