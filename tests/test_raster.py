import math
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from palimpsest.functions import imaging
from palimpsest.operators import raster, transcribe
from palimpsest.plans import imagery
from palimpsest.plans.inputs import VOCAB
from palimpsest.sources import png

IMAGE = "page long, height int, width int, pixels binary"


def images(spark, *greys):
    return spark.createDataFrame([(k, *g.shape, g.tobytes()) for k, g in enumerate(greys)], IMAGE)


def pixels(df):
    return {r.page: None if r.pixels is None else np.frombuffer(r.pixels, np.uint8).reshape(r.height, r.width) for r in df.collect()}


def noise(seed, h, w):
    return np.random.default_rng(seed).integers(0, 256, (h, w)).astype(np.uint8)


# components


def brute_components(points, width, kernel=20):
    """Dilated pixel by pixel, then flood fill."""
    dark = {(y, x + d) for y, x in points for d in range(-((kernel - 1) // 2), kernel // 2 + 1) if 0 <= x + d < width}
    out = []
    while dark:
        todo, part = [dark.pop()], []
        while todo:
            y, x = todo.pop()
            part.append((y, x))
            near = {(y + a, x + b) for a in (-1, 0, 1) for b in (-1, 0, 1)} & dark
            dark -= near
            todo += near
        ys, xs = [p[0] for p in part], [p[1] for p in part]
        out.append((min(xs), min(ys), max(xs) - min(xs) + 1, max(ys) - min(ys) + 1, len(part)))
    return sorted(out)


@pytest.mark.parametrize("kernel", [1, 2, 5, 20])
def test_components(spark, kernel):
    rng = np.random.default_rng(kernel)
    pages = {f"p{k}": {(int(y), int(x)) for y, x in zip(rng.integers(0, 30, n), rng.integers(0, 90, n), strict=True)} for k, n in enumerate((1, 40, 200, 900))}
    spiral = [(y, x) for y in range(0, 20, 4) for x in range(40)] + [(y, 39 if y % 8 < 4 else 0) for y in range(17)]
    pages["spiral"] = set(spiral)
    ink = spark.createDataFrame([(p, y, x) for p, ps in pages.items() for y, x in ps] + [("spiral", 0, 0)], "page string, row int, col int")
    sized = spark.createDataFrame([(p, 90, 30) for p in pages], "page string, width int, height int")
    found = raster.components(ink, sized, kernel).collect()
    for p, points in pages.items():
        assert sorted((r.left, r.top, r.width, r.height, r.area) for r in found if r.page == p) == brute_components(points, 90, kernel), p


def test_components_of_nothing(spark):
    assert raster.components(spark.createDataFrame([], "page string, row int, col int"), spark.createDataFrame([("p", 5, 5)], "page string, width int, height int")).collect() == []


# skew


def brute_rectangle(points):
    """Least area over the directions of all pairs of points, and the angles that reach it."""
    best = {}
    for a in points:
        for b in points:
            d = (b[0] - a[0], b[1] - a[1])
            if d == (0, 0):
                continue
            along, across = [p[0] * d[0] + p[1] * d[1] for p in points], [p[0] * d[1] - p[1] * d[0] for p in points]
            area = (max(along) - min(along)) * (max(across) - min(across)) / (d[0] ** 2 + d[1] ** 2)
            best.setdefault(round(area, 6), set()).add(round((math.degrees(math.atan2(d[1], d[0])) + 45) % 90 - 45, 6))
    return min(best), best[min(best)]


@pytest.mark.parametrize("seed", range(8))
def test_least_rectangle(seed):
    points = np.unique(np.random.default_rng(seed).integers(0, 12, (25, 2)), axis=0)
    area, angle = imaging.least_rectangle(imaging.hull(points))
    want, angles = brute_rectangle(points.tolist())
    assert round(area, 6) == want and round(angle, 6) in angles


def test_skew(spark):
    def tilted(degrees):
        return {(round(60 + x * math.sin(math.radians(degrees)) + y), round(x * math.cos(math.radians(degrees)))) for x in range(200) for y in range(0, 10, 3)}

    pages = {"down": tilted(4), "up": tilted(-6), "level": tilted(0), "few": {(1, k) for k in range(9)}, "line": {(3, k) for k in range(30)}, "stack": {(k, 3) for k in range(30)}, "diagonal": {(k, k) for k in range(30)}}
    ink = spark.createDataFrame([(p, y, x) for p, ps in pages.items() for y, x in ps] + [("few", 1, 1)], "page string, row int, col int")
    got = {r.page: r.angle for r in raster.skew(ink).collect()}
    assert abs(got["down"] + 4) < 0.5 and abs(got["up"] - 6) < 0.5
    assert [got[p] for p in ("level", "few", "line", "stack")] == [0.0] * 4 and got["diagonal"] == -45.0


def test_deskew_levels_a_tilted_page(spark):
    page = np.full((120, 200), 255, np.uint8)
    for y in range(20, 100, 12):
        page[y : y + 4, 20:180] = 0
    skewed = imaging.rotated(page, 5.0)
    flat = np.full((30, 30), 200, np.uint8)
    made = raster.deskew(images(spark, page, skewed, flat, imaging.rotated(page, 20.0)).union(spark.createDataFrame([(9, None, None, None)], IMAGE)))
    angles = {r.page: r.angle for r in made.collect()}
    got = pixels(made)
    assert abs(angles[1] - 5) < 0.7 and angles[0] == 0.0 and angles[3] == 0.0 and angles[2] == 0.0 and got[9] is None
    again = {r.page: r.angle for r in raster.skew(raster.ink_of(made)).collect()}
    assert abs(again[1]) < 1 and (got[0] == page).all() and got[3].shape == imaging.rotated(page, 20.0).shape


# rotation, scaling, contrast, noise


def brute_rotated(grey, angle):
    h, w = grey.shape
    c, s = math.cos(math.radians(angle)), math.sin(math.radians(angle))
    nw, nh = int(h * abs(s) + w * abs(c)), int(h * abs(c) + w * abs(s))
    out = np.zeros((nh, nw), np.uint8)
    at = lambda y, x: float(grey[y, x]) if 0 <= y < h and 0 <= x < w else 255.0
    for y in range(nh):
        for x in range(nw):
            sx, sy = (x - nw / 2) * c - (y - nh / 2) * s + w / 2, (x - nw / 2) * s + (y - nh / 2) * c + h / 2
            x0, y0 = math.floor(sx), math.floor(sy)
            fx, fy = sx - x0, sy - y0
            out[y, x] = round((at(y0, x0) * (1 - fx) + at(y0, x0 + 1) * fx) * (1 - fy) + (at(y0 + 1, x0) * (1 - fx) + at(y0 + 1, x0 + 1) * fx) * fy)
    return out


@pytest.mark.parametrize("angle", [0.0, 7.3, -33.0, 90.0, 180.0])
def test_rotated(angle):
    grey = noise(3, 17, 23)
    assert (imaging.rotated(grey, angle) == brute_rotated(grey, angle)).all()
    assert angle or (imaging.rotated(grey, angle) == grey).all()


def test_rotation_is_counter_clockwise():
    grey = np.full((41, 41), 255, np.uint8)
    grey[18:23, 20:] = 0
    turned = imaging.rotated(grey, 45.0) < 128
    assert turned.nonzero()[0].min() < 15 and turned.nonzero()[0].max() < 32


def test_resized():
    grey = noise(4, 9, 14)
    assert (imaging.resized(grey, 9, 14) == grey).all() and (imaging.resized(np.full((5, 7), 9, np.uint8), 32, 3) == 9).all()
    half = imaging.resized(np.array([[0, 100, 200, 40]], np.uint8), 1, 2)
    assert half.tolist() == [[50, 120]]
    assert imaging.resized(np.array([[0, 100]], np.uint8), 1, 4).tolist() == [[0, 25, 75, 100]]


def brute_equalized(grey, clip, gx, gy):
    h, w = grey.shape
    th, tw = -(-h // gy), -(-w // gx)
    mirror = lambda i, n: 0 if n == 1 else min(i % (2 * n - 2), 2 * n - 2 - i % (2 * n - 2))
    maps = {}
    for ty in range(gy):
        for tx in range(gx):
            n = [0] * 256
            for y in range(ty * th, (ty + 1) * th):
                for x in range(tx * tw, (tx + 1) * tw):
                    n[grey[mirror(y, h), mirror(x, w)]] += 1
            limit = max(int(clip * th * tw / 256), 1)
            over = sum(max(v - limit, 0) for v in n)
            n = [min(v, limit) + over // 256 for v in n]
            rest, step = over % 256, max(256 // max(over % 256, 1), 1)
            for k in range(0, 256, step):
                if rest:
                    n[k] += 1
                    rest -= 1
            total, table = 0, []
            for v in n:
                total += v
                table.append(min(max(round(total * (255 / (th * tw))), 0), 255))
            maps[ty, tx] = table
    out = np.zeros_like(grey)
    for y in range(h):
        for x in range(w):
            fy, fx = y / th - 0.5, x / tw - 0.5
            y0, x0 = math.floor(fy), math.floor(fx)
            m = lambda a, b: maps[min(max(y0 + a, 0), gy - 1), min(max(x0 + b, 0), gx - 1)][grey[y, x]]  # noqa: E731, B023
            wy, wx = fy - y0, fx - x0
            out[y, x] = round((m(0, 0) * (1 - wx) + m(0, 1) * wx) * (1 - wy) + (m(1, 0) * (1 - wx) + m(1, 1) * wx) * wy)
    return out


@pytest.mark.parametrize("shape, tiles", [((40, 56), (8, 8)), ((37, 50), (4, 3)), ((1, 9), (8, 8)), ((5, 1), (2, 2))])
def test_equalized(spark, shape, tiles):
    grey = (noise(5, *shape) // 3 + 60).astype(np.uint8)
    assert (imaging.equalized(grey, 2.0, tiles) == brute_equalized(grey, 2.0, *tiles)).all()


def brute_denoised(grey, strength, patch, search):
    h, w = grey.shape
    mirror = lambda i, n: 0 if n == 1 else min(abs(i) % (2 * n - 2), 2 * n - 2 - abs(i) % (2 * n - 2))
    at = lambda y, x: float(grey[mirror(y, h), mirror(x, w)])
    r, p = search // 2, patch // 2
    out = np.zeros_like(grey)
    for y in range(h):
        for x in range(w):
            total = weights = 0.0
            for dy in range(-r, r + 1):
                for dx in range(-r, r + 1):
                    d = sum((at(y + a, x + b) - at(y + dy + a, x + dx + b)) ** 2 for a in range(-p, p + 1) for b in range(-p, p + 1))
                    k = math.exp(-d / (patch * patch * strength * strength))
                    k = k if k >= 1e-3 else 0.0
                    total += k * at(y + dy, x + dx)
                    weights += k
            out[y, x] = round(total / weights)
    return out


def test_denoise_against_brute_force(spark):
    grey = (noise(6, 23, 11) // 8 + 100).astype(np.uint8)
    bad = spark.createDataFrame([(5, None, None, None), (6, 2, 2, b"123"), (7, 0, 0, b"")], IMAGE)
    made = pixels(raster.denoise(images(spark, grey, grey[:1], grey[:3, :2]).union(bad).withColumn("extra", F.lit(1)), 10.0, 3, 7, 8))
    for k, g in enumerate((grey, grey[:1], grey[:3, :2])):
        assert (made[k] == brute_denoised(g, 10.0, 3, 7)).all(), k
    assert made[5] is made[6] is made[7] is None


def test_bands_are_seamless(spark):
    grey = (noise(7, 90, 33) // 6).astype(np.uint8)
    whole = pixels(raster.denoise(images(spark, grey), block=1000))[0]
    assert (pixels(raster.denoise(images(spark, grey), block=16))[0] == whole).all() and whole.std() < grey.std()
    same = images(spark, grey)
    assert (pixels(raster.normalize(same, 0, 0))[0] == grey).all()


# files


def filtered(grey, kinds):
    """A PNG whose rows use these filters in turn."""
    h, w = grey.shape[:2]
    step = 1 if grey.ndim == 2 else grey.shape[2]
    rows = grey.reshape(h, -1).astype(int)
    raw = b""
    for y in range(h):
        kind = kinds[y % len(kinds)]
        up = rows[y - 1] if y else np.zeros_like(rows[0])
        left = np.concatenate([np.zeros(step, int), rows[y][:-step]])
        corner = np.concatenate([np.zeros(step, int), up[:-step]])
        guess = left + up - corner
        paeth = np.where((abs(guess - left) <= abs(guess - up)) & (abs(guess - left) <= abs(guess - corner)), left, np.where(abs(guess - up) <= abs(guess - corner), up, corner))
        raw += bytes([kind]) + ((rows[y] - [0, left, up, (left + up) // 2, paeth][kind]) % 256).astype(np.uint8).tobytes()
    return packed(w, h, 8, {1: 0, 2: 4, 3: 2, 4: 6}[step], raw)


def packed(w, h, depth, colour, raw, extra=b"", interlaced=0):
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return png.SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, depth, colour, 0, 0, interlaced)) + extra + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def test_png_filters():
    grey, colour = noise(8, 13, 9), np.random.default_rng(9).integers(0, 256, (12, 7, 3)).astype(np.uint8)
    assert (png.from_png(filtered(grey, [0, 1, 2, 3, 4])) == grey).all() and (png.from_png(png.to_png(grey)) == grey).all()
    want = np.rint(colour @ np.array([0.299, 0.587, 0.114])).astype(np.uint8)
    assert (png.from_png(filtered(colour, [4, 3, 1])) == want).all()
    with_alpha = np.concatenate([colour, colour[:, :, :1]], axis=2)
    assert (png.from_png(filtered(with_alpha, [2, 4])) == want).all() and (png.from_png(filtered(with_alpha[:, :, 1:3].copy(), [1])) == colour[:, :, 1]).all()
    bits = packed(10, 1, 1, 0, b"\0" + np.packbits([1, 0, 1, 1, 0, 0, 0, 1, 1, 0]).tobytes())
    assert png.from_png(bits).tolist() == [[255, 0, 255, 255, 0, 0, 0, 255, 255, 0]]


def test_files_with_errors(spark, tmp_path):
    good = png.to_png(noise(1, 5, 6))
    spoilt = good[:40] + bytes([good[40] ^ 1]) + good[41:]
    contents = {"good": good, "cut": good[:-20], "spoilt": spoilt, "text": b"no image", "empty": b"", "wide": packed(1 << 20, 1 << 20, 8, 0, b""), "deep": packed(1, 1, 16, 0, b"\0\0\0"), "laced": packed(1, 1, 8, 0, b"\0\0", interlaced=1), "short": packed(4, 4, 8, 0, b"\0\0\0")}
    for name, content in contents.items():
        (tmp_path / f"{name}.png").write_bytes(content)
    got = {r.path.rsplit("/", 1)[1][:-4]: r for r in png.read_images(spark, str(tmp_path)).collect()}
    # Spark's scans leave files of no bytes out
    assert set(got) == set(contents) - {"empty"} and got["good"].error is None and bytes(got["good"].pixels) == noise(1, 5, 6).tobytes()
    assert all(got[k].pixels is None and got[k].error for k in got if k != "good")
    assert got["cut"].error == "cut off" and "checksum" in got["spoilt"].error and "signature" in got["text"].error
    missing = png.decode(spark.createDataFrame([(1, None)], "page long, content binary")).first()
    assert missing.error == "no content"


def test_crops_to_files_and_back(spark, tmp_path):
    grey = noise(2, 40, 30)
    boxes = spark.createDataFrame([(0, 0, 3, 4, 10, 12), (0, 1, 25, 35, 30, 30), (0, 2, 100, 100, 5, 5), (4, 0, 0, 0, 1, 1)], "page long, line_id int, x int, y int, w int, h int")
    made = raster.crops(images(spark, grey, grey), boxes)
    got = {r.line_id: r for r in made.collect()}
    assert len(got) == 3 and bytes(got[0].pixels) == grey[4:16, 3:13].tobytes() and (got[1].height, got[1].width) == (5, 5) and got[2].height == 0
    assert {(r.height, r.width) for r in raster.crops(images(spark, grey), boxes, 24).collect()} == {(24, 20), (24, 24), (0, 0)}
    folder = str(tmp_path / "crops")
    png.write_crops(made.withColumn("source_id", F.lit("book")), folder)
    back = {r.path.rsplit("/", 1)[1]: bytes(r.pixels) for r in png.read_images(spark, folder).collect()}
    assert back == {"book_p0000_l0000.png": grey[4:16, 3:13].tobytes(), "book_p0000_l0001.png": grey[35:, 25:].tobytes()}
    assert (tmp_path / "crops" / "_SUCCESS").read_text() == "2\n" and not [p for p in (tmp_path / "crops").iterdir() if p.name.endswith("png") and p.name.startswith(".book")]


def test_crops_are_listed_where_they_are_read(spark, tmp_path):
    """Spark's scan kept the name, size and place of every crop on the driver; now it gets the folders' names alone, however many crops there are."""
    grey = noise(3, 20, 20)
    boxes = spark.createDataFrame([(0, k, k % 10, k % 7, 5, 6) for k in range(300)], "page long, line_id int, x int, y int, w int, h int")
    folder = str(tmp_path / "crops")
    png.write_crops(raster.crops(images(spark, grey), boxes).withColumn("source_id", F.lit("book")), folder)
    parts = png.CropReader(folder).partitions()
    names = [n for p in parts for n in p.names]
    assert len(names) == len(set(names)) <= png.FOLDERS and all(n.startswith("part=") for n in names) and max(len(p.names) for p in parts) <= png.TOGETHER
    (tmp_path / "crops" / names[0] / ".half").write_bytes(b"x")
    got, want = ({r.path.rsplit("/", 1)[1]: (r.height, r.width, bytes(r.pixels), r.error) for r in read(spark, folder).collect()} for read in (png.read_crops, png.read_images))
    assert got == want and len(got) == 300
    empty = str(tmp_path / "none")
    png.write_crops(raster.crops(images(spark, grey), boxes.limit(0)).withColumn("source_id", F.lit("book")), empty)
    assert png.read_crops(spark, empty).count() == 0


def test_tensors(spark):
    row = raster.tensors(images(spark, np.array([[0, 51], [255, 102]], np.uint8))).first()
    assert [[round(v, 3) for v in c] for c in row["columns"]] == [[0.0, 1.0], [0.2, 0.4]]


def test_pages_with_a_dead_letter(spark):
    page = np.full((120, 200), 255, np.uint8)
    for y in (20, 40):
        page[y : y + 12, 30:170] = 0
    blank = np.full((50, 50), 255, np.uint8)
    files = spark.createDataFrame([(1, png.to_png(page)), (2, b"broken"), (3, png.to_png(blank)), (4, png.to_png(page)), (5, None)], "page long, content binary")

    def network(lines):
        steps = F.explode(F.array(*(F.struct(F.lit(k).alias("t"), F.array(*(F.lit(math.log(0.9 if v == k + 1 else 0.1 / 3)) for v in range(4))).alias("log_probs")) for k in range(3))))
        made = lines.select("page", "line_id", steps.alias("s")).select("page", "line_id", "s.t", "s.log_probs")
        return made.where("not (page = 4 and line_id = 1)")

    got = {r.page: r for r in transcribe.pages(files, network, ["<blank>", "a", "b", "c"], strength=0, clip=0).collect()}
    assert (got[1].text, got[1].n_lines, got[1].n_failed, got[1].error) == ("abc abc", 2, 0, None) and got[1].confidence > 0.5
    assert (got[2].text, got[2].error) == ("", "no PNG signature") and got[3].error == "no lines" and got[5].error == "no content"
    assert (got[4].text, got[4].n_lines, got[4].n_failed, got[4].error) == ("abc", 1, 1, "no logits")


# the registered queries without SQL


def test_registered_pages(spark, sf):
    given = {r.page: (r.height, r.width, bytes(r.pixels)) for r in imagery.grey_pages(spark, sf).collect()}
    assert sum(h * w for h, w, _ in given.values()) == 64 * spark.read.parquet(f"{sf}/embeddings.parquet").count()
    got = imagery.denoised_pages(spark, sf).collect()
    assert {r.page: (r.height, r.width) for r in got} == {k: v[:2] for k, v in given.items()}


def test_registered_deskew(spark, sf):
    ink = imagery.dots(spark, sf)
    made = {r.page: r for r in imagery.deskewed_pages(spark, sf).collect()}
    angles = {r.page: r.angle for r in raster.skew(ink).collect()}
    assert set(made) == set(angles)
    for p, a in angles.items():
        turned = 0.1 <= abs(a) <= 10
        assert made[p].angle == round(a if abs(a) <= 10 else 0.0, 9) and ((made[p].height, made[p].width) != (imagery.HEIGHT, imagery.WIDTH)) >= (turned and abs(a) > 2)


def test_registered_transcription(spark, sf):
    rows = imagery.page_transcription(spark, sf).collect()
    assert len(rows) == imagery.dots(spark, sf).select("page").distinct().count() and len(VOCAB) == 64
    assert all((r.error is not None) == (r.page % 10 == 7) for r in rows if r.n_lines or r.page % 10 == 7)
    assert any(r.n_lines > 0 and r.text for r in rows) and all(r.error in (None, "no lines", "cut off") for r in rows)
