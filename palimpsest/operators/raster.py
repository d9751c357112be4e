"""Page images: components and skew of their ink, denoising, contrast, rotation, and line crops.

An image is a row with ``height``, ``width`` and ``pixels``, one byte a grey
level, row by row; ink is a table with one row per inked pixel ``(page, row,
col)``. What a page is made of is reduced to runs or row ends by group-bys before
one task sees it; images stay where they are, and blocks of them are dealt out
where a pixel costs much. A null image, one without pixels, or one whose sizes
don't fit its bytes has null results and is never an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import imaging
from ..session import long_rows
from . import layout


def valid(height: Column, width: Column, pixels: Column) -> Column:
    """Whether the sizes fit the bytes and there is a pixel."""
    return F.coalesce((height > 0) & (width > 0) & (F.octet_length(pixels) == height.cast("long") * width), F.lit(False))


def each_image(rows: DataFrame, change: Callable[..., np.ndarray | None], *extra: str) -> DataFrame:
    """``rows`` with ``change(grey, *extra)`` in place of their images; null where there is no image, or it gives none."""
    long_rows(rows.sparkSession)
    names = rows.columns
    ready = rows.withColumn("pixels", F.when(valid(F.col("height"), F.col("width"), F.col("pixels")), F.col("pixels")))
    shape = F.struct("height", "width", "pixels", *extra)

    @F.pandas_udf("height int, width int, pixels binary")
    def changed(images: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in images:
            out = []
            for h, w, raw, *more in b.itertuples(index=False):
                new = None if raw is None or any(pd.isna(m) for m in more) else change(np.frombuffer(raw, np.uint8).reshape(int(h), int(w)), *more)
                out.append((None, None, None) if new is None else (*new.shape, new.tobytes()))
            yield pd.DataFrame(out, columns=["height", "width", "pixels"]).astype({"height": "Int32", "width": "Int32"})

    done = ready.withColumn("_new", changed(shape))
    return done.select(*(F.col(f"_new.{c}").alias(c) if c in ("height", "width", "pixels") else F.col(c) for c in names))


def ink_of(images: DataFrame, page: str = "page") -> DataFrame:
    """``(page, row, col)`` of each pixel as dark as the page's Otsu threshold or darker; an image of one level has none."""
    kind = images.schema[page].dataType.simpleString()
    fine = images.where(valid(F.col("height"), F.col("width"), F.col("pixels"))).select(page, "height", "width", "pixels")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                h, w, raw = (b.column(c)[k].as_py() for c in (1, 2, 3))
                g = np.frombuffer(raw, np.uint8).reshape(h, w)
                rows, cols = np.nonzero(g <= imaging.otsu_level(g)) if g.min() < g.max() else (np.empty(0, int),) * 2
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(np.full(len(rows), k))), pa.array(rows, pa.int32()), pa.array(cols, pa.int32())], names=[page, "row", "col"])

    return fine.mapInArrow(run, f"`{page}` {kind}, row int, col int")


def images_of(ink: DataFrame, pages: DataFrame, page: str = "page") -> DataFrame:
    """Images of ``pages`` (page, width, height), black where there is ink and white elsewhere; ink beyond the page is left out."""
    at = ink.groupBy(page).agg(F.collect_set(F.struct(F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"))).alias("ink"))
    rows = pages.join(at, page, "left").select(page, "height", "width", "ink")
    kind = pages.schema[page].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for k in range(b.num_rows):
                g = np.full((b.column(1)[k].as_py(), b.column(2)[k].as_py()), 255, np.uint8)
                own = b.column(3)[k]
                if own.is_valid:
                    r, c = (own.values.field(f).to_numpy() for f in ("row", "col"))
                    inside = (r >= 0) & (r < g.shape[0]) & (c >= 0) & (c < g.shape[1])
                    g[r[inside], c[inside]] = 0
                out.append(g.tobytes())
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(out, pa.binary())], names=[page, "height", "width", "pixels"])

    shape = f"`{page}` {kind}, height int, width int, pixels binary"
    return rows.withColumns({"height": F.col("height").cast("int"), "width": F.col("width").cast("int")}).mapInArrow(run, shape)


def dilated_runs(ink: DataFrame, pages: DataFrame, kernel: int = 20, page: str = "page") -> DataFrame:
    """``(page, row, start, end)``: runs of ink, end exclusive, after a dilation by ``kernel`` pixels along the row, inside the page.

    A pixel spreads over ``(kernel - 1) // 2`` to its left and ``kernel // 2`` to its right, so pixels up to
    ``kernel`` apart run together. ``pages`` has page and width.
    """
    along = Window.partitionBy(page, "row").orderBy("col")
    marked = ink.select(page, "row", "col").withColumn("_new", (F.col("col") - F.lag("col").over(along) > kernel).cast("int"))
    runs = marked.withColumn("_run", F.sum(F.coalesce("_new", F.lit(0))).over(along)).groupBy(page, "row", "_run").agg(F.min("col").alias("a"), F.max("col").alias("b"))
    sized = runs.join(pages.select(page, F.col("width").alias("_width")), page)
    return sized.select(page, "row", F.greatest(F.col("a") - (kernel - 1) // 2, F.lit(0)).cast("int").alias("start"), F.least(F.col("b") + kernel // 2 + 1, F.col("_width")).cast("int").alias("end"))


def components(ink: DataFrame, pages: DataFrame, kernel: int = 20, page: str = "page") -> DataFrame:
    """``(page, left, top, width, height, area)`` of the 8-connected components of dilated ink; area counts dilated pixels."""
    runs = dilated_runs(ink, pages, kernel, page)
    kind = runs.schema[page].dataType.simpleString()

    def label(b: pa.Table) -> pa.Table:
        b = b.sort_by([("row", "ascending"), ("start", "ascending")])
        row, start, end = (b.column(c).to_numpy() for c in ("row", "start", "end"))
        root = imaging.joined_runs(row, start, end)
        _, at = np.unique(root, return_inverse=True)
        n = at.max() + 1 if len(at) else 0
        low = lambda v: np.minimum.reduceat(v[by], cuts)
        high = lambda v: np.maximum.reduceat(v[by], cuts)
        by = np.argsort(at, kind="stable")
        cuts = np.searchsorted(at[by], np.arange(n))
        left, top = low(start), low(row)
        return pa.table({page: pa.concat_arrays(b.column(page).chunks).take(pa.array(by[cuts])), "left": pa.array(left, pa.int32()), "top": pa.array(top, pa.int32()), "width": pa.array(high(end) - left, pa.int32()),
                         "height": pa.array(high(row) - top + 1, pa.int32()), "area": pa.array(np.add.reduceat((end - start)[by], cuts), pa.int64())})

    return runs.groupBy(page).applyInArrow(label, f"`{page}` {kind}, left int, top int, width int, height int, area long")


def skew(ink: DataFrame, least: int = 10, page: str = "page") -> DataFrame:
    """``(page, angle)`` in degrees, counter-clockwise positive: the turn of the least rectangle round a page's ink; 0 with fewer than ``least`` pixels.

    A row's ends are the hull of the row, so only they reach the page's task;
    it takes the hull of those and turns a rectangle round it.
    """
    ends = ink.groupBy(page, "row").agg(F.min("col").alias("a"), F.max("col").alias("b"), F.count_distinct("col").alias("n"))
    kind = ends.schema[page].dataType.simpleString()

    def turn(b: pa.Table) -> pa.Table:
        row, first, last, n = (b.column(c).to_numpy() for c in ("row", "a", "b", "n"))
        angle = 0.0
        if n.sum() >= least:
            points = np.unique(np.concatenate([np.stack([row, first], 1), np.stack([row, last], 1)]).astype(np.int64), axis=0)
            angle = imaging.least_rectangle(imaging.hull(points))[1]
        return pa.table({page: b.column(page).slice(0, 1), "angle": pa.array([angle])})

    return ends.groupBy(page).applyInArrow(turn, f"`{page}` {kind}, angle double")


def denoise(images: DataFrame, strength: float = 10.0, patch: int = 7, search: int = 21, block: int = 64, page: str = "page") -> DataFrame:
    """Non-local means; images unchanged if ``strength`` is 0 or less. ``page`` must tell images apart.

    An image goes out in bands of ``block`` rows with the rows that their pixels
    look at, so a large one is the work of many tasks; beyond the edge the image
    is mirrored.
    """
    if strength <= 0:
        return images
    long_rows(images.sparkSession)
    halo = search // 2 + patch // 2
    names = images.columns
    h, w = F.col("height"), F.col("width")
    fine = images.where(valid(h, w, F.col("pixels")))
    bands = fine.select(page, "height", "width", F.explode(F.sequence(F.lit(0), F.floor((h - 1) / block).cast("int"))).alias("band"), "pixels")
    first = F.greatest(F.col("band") * block - halo, F.lit(0))
    last = F.least((F.col("band") + 1) * block + halo, h)
    cut = bands.select(page, "height", "width", "band", first.alias("first"), F.substring("pixels", first * w + 1, (last - first) * w).alias("pixels"))

    @F.pandas_udf("binary")
    def clean(height: pd.Series, width: pd.Series, band: pd.Series, first: pd.Series, raw: pd.Series) -> pd.Series:
        out = []
        for h, w, k, at, r in zip(height, width, band, first, raw, strict=True):
            rows = np.arange(k * block - halo, min((k + 1) * block, h) + halo)
            cols = np.arange(-halo, w + halo)
            there = np.frombuffer(r, np.uint8).reshape(-1, w)
            # rows mirrored at the page's edge lie in the band as long as the page is no thinner than the halo
            inside = imaging._mirrored(rows, h) - at
            out.append(imaging.denoised(there[np.ix_(inside, imaging._mirrored(cols, w))], halo, strength, patch, search).tobytes())
        return pd.Series(out)

    done = cut.repartition(page, "band").select(page, F.struct("band", clean("height", "width", "band", "first", "pixels").alias("pixels")).alias("b"))
    whole = done.groupBy(page).agg(F.array_sort(F.collect_list("b")).alias("b")).select(page, F.aggregate(F.transform("b", lambda x: x["pixels"]), F.lit(b""), lambda a, x: F.concat(a, x)).alias("_clean"))
    joined = images.join(whole, page, "left")
    return joined.select(*(F.col("_clean").alias(c) if c == "pixels" else F.col(c) for c in names))


def equalize(images: DataFrame, clip: float = 2.0, tiles: tuple[int, int] = (8, 8)) -> DataFrame:
    """Contrast-limited adaptive histogram equalisation; images unchanged if ``clip`` is 0 or less."""
    return each_image(images, lambda g: imaging.equalized(g, clip, tiles)) if clip > 0 else images


def normalize(images: DataFrame, strength: float = 10.0, clip: float = 2.0, tiles: tuple[int, int] = (8, 8), page: str = "page") -> DataFrame:
    return equalize(denoise(images, strength, page=page), clip, tiles)


def rotate(images: DataFrame, angle: str = "angle") -> DataFrame:
    """Images turned counter-clockwise by the degrees in column ``angle``, on white, their canvas grown to hold all; a null angle gives no image."""
    return each_image(images, lambda g, a: imaging.rotated(g, float(a)), angle)


def deskew(images: DataFrame, most: float = 10.0, page: str = "page") -> DataFrame:
    """Images made level, with ``angle``: that of their ink, zero where it is too large to trust; from a tenth of a degree on they are turned back by it."""
    found = images.join(skew(ink_of(images, page), page=page), page, "left").withColumn("angle", F.coalesce("angle", F.lit(0.0)))
    action, told = layout.skew_action(F.col("angle"), most)
    turned = found.withColumn("_turn", F.when(action == "rotate", F.col("angle")).otherwise(0.0)).withColumn("angle", told)
    return each_image(turned, lambda g, a: imaging.rotated(g, -float(a)) if a else g, "_turn").drop("_turn")


def crops(images: DataFrame, lines: DataFrame, target_height: int | None = None, page: str = "page") -> DataFrame:
    """``(page, line_id, x, y, w, h, height, width, pixels)``: the boxes of ``lines`` (page, line_id, x, y, w, h) cut out of their images, scaled to ``target_height`` if given.

    A page's boxes travel to its image in one row, so an image isn't repeated;
    a box that leaves the image is cut at its edge, one outside has no pixels.
    """
    box = ["line_id", "x", "y", "w", "h"]
    kinds = {f.name: f.dataType.simpleString() for f in lines.schema}
    boxes = lines.groupBy(page).agg(F.array_sort(F.collect_list(F.struct(*(F.col(c).cast("long").alias(c) for c in box)))).alias("boxes"))
    rows = images.where(valid(F.col("height"), F.col("width"), F.col("pixels"))).select(page, "height", "width", "pixels").join(boxes, page)
    shape = f"`{page}` {kinds[page]}, " + ", ".join(f"{c} long" for c in box) + ", height int, width int, pixels binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                h, w, raw, own = (b.column(c)[k].as_py() for c in (1, 2, 3, 4))
                g = np.frombuffer(raw, np.uint8).reshape(h, w)
                out = []
                for o in own:
                    part = g[max(o["y"], 0) : max(o["y"] + o["h"], 0), max(o["x"], 0) : max(o["x"] + o["w"], 0)]
                    if part.size and target_height and len(part) != target_height:
                        part = imaging.resized(part, target_height, max(1, int(part.shape[1] * target_height / len(part))))
                    out.append((*(o[c] for c in box), *part.shape, part.tobytes()))
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array([k] * len(out))), *(pa.array(c, pa.int64()) for c in columns[:5]), *(pa.array(c, pa.int32()) for c in columns[5:7]), pa.array(columns[7], pa.binary())],
                    names=[page, *box, "height", "width", "pixels"])

    return rows.mapInArrow(run, shape)


def tensors(images: DataFrame) -> DataFrame:
    """Adds ``columns``: for each pixel column its levels from top to bottom, scaled to [0, 1]; what ``decode.pad_batches`` pads."""

    @F.pandas_udf("array<array<float>>")
    def scaled(height: pd.Series, width: pd.Series, raw: pd.Series) -> pd.Series:
        return pd.Series([None if r is None or pd.isna(h) else list((np.frombuffer(r, np.uint8).reshape(int(h), int(w)).T / 255.0).astype(np.float32)) for h, w, r in zip(height, width, raw, strict=True)])

    return images.withColumn("columns", scaled("height", "width", "pixels"))
