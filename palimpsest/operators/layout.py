"""Layout of pages from tables of components, ink and pixels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.imaging import otsu_level

def keep_components(components: DataFrame, least_width: int = 20, least_height: int = 10) -> DataFrame:
    return components.where((F.col("width") >= least_width) & (F.col("height") >= least_height))


def clusters(components: DataFrame, ratio: float = 2.0, page: str = "page") -> DataFrame:
    """Adds ``cluster`` (from 0, downwards): a new one begins where the next vertical centre lies more than ``ratio`` median heights below."""
    rows = components.withColumn("_cy", F.col("top") + F.col("height") / 2.0)
    down = Window.partitionBy(page).orderBy("_cy")
    rows = rows.withColumn("_median", F.percentile("height", 0.5).over(Window.partitionBy(page)))
    rows = rows.withColumn("_new", (F.col("_cy") - F.lag("_cy").over(down) > ratio * F.col("_median")).cast("int"))
    run = F.sum(F.coalesce("_new", F.lit(0))).over(down.rangeBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("cluster", run.cast("int")).drop("_cy", "_median", "_new")


def text_region(pages: DataFrame, components: DataFrame, padding: int = 5, ratio: float = 2.0, page: str = "page") -> DataFrame:
    """``(page, x, y, w, h)``: the box of the cluster with the most area (the upper of equals), padded and kept inside; the whole page if it has none.

    ``pages`` has page, width and height.
    """
    boxes = clusters(keep_components(components), ratio, page).groupBy(page, "cluster").agg(
        F.sum("area").alias("area"), F.min("left").alias("x0"), F.min("top").alias("y0"), F.max(F.col("left") + F.col("width")).alias("x1"), F.max(F.col("top") + F.col("height")).alias("y1"))
    best = boxes.groupBy(page).agg(F.max_by(F.struct("x0", "y0", "x1", "y1"), F.struct("area", -F.col("cluster"))).alias("b"))
    found = pages.select(page, F.col("width").alias("_w"), F.col("height").alias("_h")).join(best, page, "left")
    low = lambda c: F.coalesce(F.greatest(F.col(c) - padding, F.lit(0)), F.lit(0))
    high = lambda c, top: F.coalesce(F.least(F.col(c) + padding, F.col(top)), F.col(top))
    return found.select(page, low("b.x0").alias("x"), low("b.y0").alias("y"), (high("b.x1", "_w") - low("b.x0")).alias("w"), (high("b.y1", "_h") - low("b.y0")).alias("h"))


def row_profile(ink: DataFrame, page: str = "page") -> DataFrame:
    """Ink per row of a table with one row per inked pixel ``(page, row, col)``."""
    return ink.groupBy(page, "row").agg(F.count("*").alias("ink"))


def bands(profile: DataFrame, merge_gap: int = 3, page: str = "page") -> DataFrame:
    """``(page, band, start, end)``, half-open runs of rows with ink; gaps of up to ``merge_gap`` rows are bridged, none if it is 0 or less."""
    down = Window.partitionBy(page).orderBy("row")
    rows = profile.where("ink > 0").withColumn("_new", (F.col("row") - F.lag("row").over(down) - 1 > max(merge_gap, 0)).cast("int"))
    rows = rows.withColumn("band", F.sum(F.coalesce("_new", F.lit(0))).over(down).cast("int"))
    return rows.groupBy(page, "band").agg(F.min("row").alias("start"), (F.max("row") + 1).alias("end"))


def lines(ink: DataFrame, pages: DataFrame, merge_gap: int = 3, least_height: int = 10, least_width: int = 20, pad: int = 2, target_height: int | None = None, page: str = "page") -> DataFrame:
    """``(page, line_id, x, y, w, h, out_width)`` of text lines, numbered after the filters.

    A band is padded within the page before its height is tested; its width is
    the number of columns with ink in the padded band. ``pages`` has page,
    width, height and the region's x and y. ``out_width`` is the width after
    scaling to ``target_height``.
    """
    found = bands(row_profile(ink, page), merge_gap, page).join(pages, page)
    padded = found.withColumn("start", F.greatest(F.col("start") - pad, F.lit(0))).withColumn("end", F.least(F.col("end") + pad, F.col("height")))
    tall = padded.where(F.col("end") - F.col("start") >= least_height)
    wide = tall.join(ink.select(F.col(page).alias("_page"), "row", "col"), (F.col(page) == F.col("_page")) & (F.col("row") >= F.col("start")) & (F.col("row") < F.col("end")))
    kept = wide.groupBy(page, "start", "end", "x", "y", "width").agg(F.count_distinct("col").alias("cols")).where(F.col("cols") >= least_width)
    number = F.row_number().over(Window.partitionBy(page).orderBy("start")) - 1
    h = F.col("end") - F.col("start")
    out = F.when(h == target_height, F.col("width")).otherwise(F.greatest(F.lit(1), F.floor(F.col("width") * target_height / h))) if target_height else F.col("width")
    return kept.select(page, number.cast("int").alias("line_id"), "x", (F.col("y") + F.col("start")).alias("y"), F.col("width").alias("w"), h.alias("h"), out.cast("int").alias("out_width"))


def otsu(histogram: DataFrame, page: str = "page") -> DataFrame:
    """``(page, threshold)`` of a histogram ``(page, level, n)``: the least level whose split from what lies above has the greatest variance between the classes."""
    up = Window.partitionBy(page).orderBy("level")
    every = Window.partitionBy(page)
    rows = histogram.select(page, "level", F.sum("n").over(up).alias("w0"), F.sum(F.col("n") * F.col("level")).over(up).alias("s0"), F.sum("n").over(every).alias("w"), F.sum(F.col("n") * F.col("level")).over(every).alias("s"))
    w1 = F.col("w") - F.col("w0")
    apart = F.pow(F.col("s0") / F.col("w0") - (F.col("s") - F.col("s0")) / F.nullif(w1, F.lit(0)), 2)
    scored = rows.withColumn("between", F.round(F.coalesce(F.col("w0") * w1 * apart / F.col("w") / F.col("w"), F.lit(0.0)), 9))
    return scored.groupBy(page).agg(F.max_by("level", F.struct("between", -F.col("level"))).alias("threshold"))


def skew_action(angle: Column, most: float = 10.0) -> tuple[Column, Column]:
    """What to do with a page of this skew (rotate or keep), and the angle to report: zero for one that is too large to trust."""
    rotate = (F.abs(angle) <= most) & (F.abs(angle) >= 0.1)
    return F.when(rotate, "rotate").otherwise("keep"), F.when(F.abs(angle) > most, 0.0).otherwise(angle)


def rotated_size(width: Column, height: Column, angle: Column) -> tuple[Column, Column]:
    """Canvas that holds the whole page after rotation."""
    sin, cos = F.abs(F.sin(F.radians(angle))), F.abs(F.cos(F.radians(angle)))
    return (height * sin + width * cos).cast("int"), (height * cos + width * sin).cast("int")


def grey(pixels: np.ndarray) -> np.ndarray:
    """Grey levels of an image of shape H×W or H×W×(1, 3 or 4), channels in the order blue, green, red, alpha."""
    if pixels.ndim == 2:
        return pixels
    if pixels.ndim == 3 and pixels.shape[2] == 1:
        return pixels[:, :, 0]
    if pixels.ndim == 3 and pixels.shape[2] in (3, 4):
        return np.rint(pixels[:, :, :3] @ np.array([0.114, 0.587, 0.299])).astype(np.uint8)
    raise ValueError(f"an image of shape {pixels.shape} is none of grey, BGR and BGRA")


def ink_table(images: DataFrame, page: str = "page") -> DataFrame:
    """``(page, row, col)`` of each pixel darker than the page's Otsu threshold, or as dark, of Spark's image struct in ``image``."""
    kind = images.schema[page].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, image in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                shape = (image["height"], image["width"], image["nChannels"])
                g = grey(np.frombuffer(image["data"], np.uint8).reshape(shape))
                rows, cols = np.nonzero(g <= otsu_level(g)) if g.min() < g.max() else (np.empty(0, int),) * 2
                yield pa.RecordBatch.from_arrays([pa.array([key.as_py()] * len(rows), b.schema.field(0).type), pa.array(rows, pa.int32()), pa.array(cols, pa.int32())], names=[page, "row", "col"])

    return images.select(page, "image").mapInArrow(run, f"`{page}` {kind}, row int, col int")
