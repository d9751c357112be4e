"""From image files to page texts, with what went wrong kept on its row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from ..sources import png
from . import decode, layout, raster, service


def line_images(images: DataFrame, merge_gap: int = 3, least_height: int = 10, least_width: int = 20, pad: int = 2, target_height: int | None = None, page: str = "page") -> DataFrame:
    """``(page, line_id, x, y, w, h, height, width, pixels)``: text regions of level pages cut into lines, boxes in page coordinates."""
    sizes = images.select(page, "height", "width")
    region = layout.text_region(sizes, raster.components(raster.ink_of(images, page), sizes, page=page), page=page)
    cut = raster.crops(images, region.withColumn("line_id", F.lit(0)), page=page)
    inside = cut.select(page, F.col("x").cast("int").alias("x"), F.col("y").cast("int").alias("y"), "width", "height", "pixels")
    boxes = layout.lines(raster.ink_of(inside, page), inside.drop("pixels"), merge_gap, least_height, least_width, pad, page=page)
    return raster.crops(images, boxes, target_height, page)


def pages(files: DataFrame, logits_of: Callable[[DataFrame], DataFrame], vocab: list[str], strength: float = 10.0, clip: float = 2.0, most_skew: float = 10.0, beam_width: int = 10, mode: str = "simple", least_height: int = 10, least_width: int = 20, page: str = "page") -> DataFrame:
    """``(page, text, confidence, n_lines, n_failed, error)`` of image files ``(page, content)``; ``page`` must tell them apart.

    ``logits_of`` is the network: it gets the line images and returns
    ``(page, line_id, t, log_probs)``. A file that isn't an image, a page
    without lines and lines without usable logits stay, with the reason in
    ``error`` (of several lines the first one's); the rest of a page is read.
    The cleaned pages are written once, as several stages read them.
    """
    opened = png.decode(files.select(page, "content"))
    level = raster.deskew(raster.normalize(opened.where("error is null").drop("error"), strength, clip, page=page), most_skew, page)
    level = stored(level, "level-pages")
    bad = opened.where("error is not null").select(page, "error")
    lines = stored(line_images(level, least_height=least_height, least_width=least_width, page=page), "line-images")
    key = F.struct(page, "line_id")
    steps = logits_of(lines).select(key.alias("key"), "t", "log_probs")
    best = decode.beam(decode.matrices(steps, "key"), vocab, width=beam_width, most=1, mode=mode, line="key", errors=True)
    found = lines.select(key.alias("key")).join(best.select("key", "text", "score", F.coalesce("error", F.when(F.col("text").isNull(), "no text")).alias("error")), "key", "left")
    told = found.select(F.col(f"key.{page}").alias(page), F.col("key.line_id").alias("line_id"), "text", F.exp("score").alias("sequence_confidence"), F.when(F.col("text").isNull(), F.coalesce("error", F.lit("no logits"))).alias("error"))
    texts = service.page_texts(told.where("error is null"), page)
    failed = told.where("error is not null").groupBy(page).agg(F.count("*").alias("n_failed"), F.min_by("error", "line_id").alias("line_error"))
    whole = files.select(page).join(texts, page, "left").join(failed, page, "left").join(bad, page, "left")
    error = F.coalesce("error", "line_error", F.when(F.col("n_lines").isNull(), "no lines"))
    return whole.select(page, F.coalesce("text", F.lit("")).alias("text"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"), F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"), F.coalesce("n_failed", F.lit(0)).cast("long").alias("n_failed"), error.alias("error"))
