import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from palimpsest.operators import layout
from palimpsest.sources import files


def profile(spark, values):
    return spark.createDataFrame([("p", i, v) for i, v in enumerate(values)], "page string, row int, ink long")


@pytest.mark.parametrize("values, gap, want", [
    ([0, 1, 1, 0, 0, 0, 0, 1, 0], 3, [(1, 3), (7, 8)]), ([0, 1, 1, 0, 0, 0, 1, 0], 3, [(1, 7)]), ([1, 0, 1], 0, [(0, 1), (2, 3)]), ([1, 0, 1], -2, [(0, 1), (2, 3)]), ([0, 0], 3, []), ([1, 1, 1], 3, [(0, 3)]),
])
def test_bands(spark, values, gap, want):
    assert sorted((r.start, r.end) for r in layout.bands(profile(spark, values), gap).collect()) == want


def test_lines(spark):
    bands = [(10, 20), (40, 50), (70, 73)]
    ink = [("p", y, x) for a, b in bands for y in range(a, b) for x in range(30 if a != 40 else 5)]
    page = spark.createDataFrame([("p", 200, 300, 10, 20)], "page string, width int, height int, x int, y int")
    rows = layout.lines(spark.createDataFrame(ink, "page string, row int, col int"), page, target_height=28).collect()
    # the second has too few columns, the third is too low even when padded
    assert [(r.line_id, r.x, r.y, r.w, r.h, r.out_width) for r in rows] == [(0, 10, 28, 200, 14, 400)]


def components(spark, rows):
    return spark.createDataFrame([("p", *r, r[2] * r[3]) for r in rows], "page string, left int, top int, width int, height int, area int")


def test_text_region(spark):
    pages = spark.createDataFrame([("p", 400, 300), ("empty", 128, 64)], "page string, width int, height int")
    rows = components(spark, [(5, 5, 75, 15), *((40, y, 320, 12) for y in range(100, 200, 18)), (0, 0, 5, 5)])
    got = {r.page: (r.x, r.y, r.w, r.h) for r in layout.text_region(pages, rows).collect()}
    assert got["empty"] == (0, 0, 128, 64) and got["p"] == (35, 95, 330, 112)
    assert [r.cluster for r in layout.clusters(components(spark, [(0, 0, 20, 10), (0, 20, 20, 10), (0, 41, 20, 10)])).orderBy("top").collect()] == [0, 0, 1]


def test_otsu_and_skew(spark):
    rows = spark.createDataFrame([("p", 10, 50), ("p", 12, 5), ("p", 200, 50), ("flat", 7, 9)], "page string, level int, n long")
    assert {r.page: r.threshold for r in layout.otsu(rows).collect()} == {"p": 12, "flat": 7}
    angles = spark.createDataFrame([(0.05,), (5.0,), (-20.0,)], "a double")
    action, kept = layout.skew_action(F.col("a"))
    assert [tuple(r) for r in angles.select(action, kept).collect()] == [("keep", 0.05), ("rotate", 5.0), ("keep", 0.0)]
    w, h = layout.rotated_size(F.lit(100), F.lit(50), F.lit(90.0))
    assert tuple(spark.range(1).select(w, h).first()) == (50, 100)


def png(pixels):
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    h, w = pixels.shape[:2]
    raw = b"".join(b"\0" + row.tobytes() for row in pixels)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0 if pixels.ndim == 2 else 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def test_image_folder_to_lines(spark, tmp_path):
    page = np.full((120, 200), 255, np.uint8)
    for y in (20, 60):
        page[y : y + 12, 30:170] = 0
    (tmp_path / "page_01.png").write_bytes(png(page))
    (tmp_path / "page_02.PNG").write_bytes(png(np.repeat(page[:, :, None], 3, 2)))
    (tmp_path / "notes.txt").write_text("x")
    (tmp_path / "broken.jpg").write_bytes(b"no image")
    names = [r.path.rsplit("/", 1)[1] for r in files.image_paths(spark, str(tmp_path)).collect()]
    assert names == ["broken.jpg", "page_01.png", "page_02.PNG"]
    images = files.read_images(spark, str(tmp_path))
    ink = layout.ink_table(images)
    region = images.select("page", F.col("image.width").alias("width"), F.col("image.height").alias("height"), F.lit(0).alias("x"), F.lit(0).alias("y"))
    rows = layout.lines(ink, region).collect()
    assert len(rows) == 4 and {(r.line_id, r.y, r.h) for r in rows} == {(0, 18, 16), (1, 58, 16)}


def test_grey():
    flat = np.zeros((4, 5), np.uint8)
    assert layout.grey(flat) is flat and layout.grey(flat[:, :, None]).shape == (4, 5) and layout.grey(np.zeros((4, 5, 4), np.uint8)).shape == (4, 5)
    with pytest.raises(ValueError):
        layout.grey(np.zeros((4, 5, 5), np.uint8))
