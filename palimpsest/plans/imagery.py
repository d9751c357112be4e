"""Queries on page images: ink from ``events`` (a page per user), grey pages from ``embeddings`` (64 vectors of 64 entries each)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import layout, raster, transcribe
from ..session import new_path
from ..sources import png
from . import inputs
from .registry import query

#: Sizes of the ink pages: a row per six hours, a column per second of the minute.
WIDTH, HEIGHT, ROW_SECONDS, SIDE = 60, 120, 21600, 64


def dots(spark, sf) -> DataFrame:
    at = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts)")
    return inputs.table(spark, sf, "events").select(F.col("user_id").alias("page"), F.floor(at / ROW_SECONDS).cast("int").alias("row"), (at % 60).cast("int").alias("col"))


def sized(ink: DataFrame) -> DataFrame:
    return ink.select("page").distinct().select("page", F.lit(WIDTH).alias("width"), F.lit(HEIGHT).alias("height"))


DOTS = f"""dots_ AS (SELECT user_id AS page, CAST(floor((floor(epoch(ts)) - 1704067200) / {ROW_SECONDS}) AS INTEGER) AS row_, CAST(CAST(floor(epoch(ts)) AS BIGINT) % 60 AS INTEGER) AS col_ FROM events),
 breaks_ AS (SELECT *, CASE WHEN col_ - lag(col_) OVER (PARTITION BY page, row_ ORDER BY col_) > 20 THEN 1 ELSE 0 END AS fresh FROM dots_),
 runs_ AS (SELECT page, row_, greatest(min(col_) - 9, 0) AS s, least(max(col_) + 11, {WIDTH}) AS e FROM (SELECT *, sum(fresh) OVER (PARTITION BY page, row_ ORDER BY col_) AS run FROM breaks_) GROUP BY page, row_, run),
 ids_ AS (SELECT *, row_number() OVER (ORDER BY page, row_, s) AS id FROM runs_),
 edges_ AS (SELECT a.id AS a, b.id AS b FROM ids_ a JOIN ids_ b ON a.page = b.page AND abs(a.row_ - b.row_) = 1 AND a.s <= b.e AND b.s <= a.e),
 reach_ AS (SELECT id, id AS root FROM ids_ UNION SELECT e.b, r.root FROM reach_ r JOIN edges_ e ON e.a = r.id),
 roots_ AS (SELECT id, min(root) AS root FROM reach_ GROUP BY id),
 blobs_ AS (SELECT page, CAST(min(s) AS INTEGER) AS lft, CAST(min(row_) AS INTEGER) AS top, CAST(max(e) - min(s) AS INTEGER) AS width, CAST(max(row_) - min(row_) + 1 AS INTEGER) AS height, CAST(sum(e - s) AS BIGINT) AS area FROM ids_ JOIN roots_ USING (id) GROUP BY page, root)"""


@query('SELECT page, lft AS "left", top, width, height, area FROM blobs_', "RECURSIVE " + DOTS)
def ink_components(spark, sf):
    ink = dots(spark, sf)
    return raster.components(ink, sized(ink))


@query(
    f"""SELECT p.page, coalesce(greatest(x0 - 5, 0), 0) AS x, coalesce(greatest(y0 - 5, 0), 0) AS y, coalesce(least(x1 + 5, {WIDTH}), {WIDTH}) - coalesce(greatest(x0 - 5, 0), 0) AS w, coalesce(least(y1 + 5, {HEIGHT}), {HEIGHT}) - coalesce(greatest(y0 - 5, 0), 0) AS h
 FROM (SELECT DISTINCT page FROM dots_) p LEFT JOIN (SELECT page, sum(area) AS a, min(lft) AS x0, min(top) AS y0, max(lft + width) AS x1, max(top + height) AS y1 FROM clusters_ GROUP BY page, cluster QUALIFY row_number() OVER (PARTITION BY page ORDER BY a DESC, cluster) = 1) c ON c.page = p.page""",
    "RECURSIVE " + DOTS,
    """kept_ AS (SELECT *, top + height / 2.0 AS cy FROM blobs_ WHERE width >= 20 AND height >= 10),
 gaps_ AS (SELECT *, CASE WHEN cy - lag(cy) OVER (PARTITION BY page ORDER BY cy) > 2.0 * quantile_cont(height, 0.5) OVER (PARTITION BY page) THEN 1 ELSE 0 END AS fresh FROM kept_),
 clusters_ AS (SELECT *, sum(fresh) OVER (PARTITION BY page ORDER BY cy RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cluster FROM gaps_)""",
)
def ink_region(spark, sf):
    ink = dots(spark, sf)
    return layout.text_region(sized(ink), raster.components(ink, sized(ink)))


# a side of the hull is a pair of points that has all others on its left
_SKEW = """ends_ AS (SELECT page, row_ AS x, min(col_) AS a, max(col_) AS b, count(DISTINCT col_) AS n FROM dots_ GROUP BY page, row_),
 points_ AS (SELECT DISTINCT page, x, u.y FROM ends_, unnest([a, b]) AS u(y)),
 pairs_ AS (SELECT p.page, p.x, p.y, q.x - p.x AS dx, q.y - p.y AS dy FROM points_ p JOIN points_ q ON p.page = q.page AND (p.x, p.y) <> (q.x, q.y)),
 sides_ AS (SELECT s.page, dx, dy, CAST(max(t.x * dx + t.y * dy) - min(t.x * dx + t.y * dy) AS DOUBLE) * (max(t.x * dy - t.y * dx) - min(t.x * dy - t.y * dx)) / (dx * dx + dy * dy) AS area
  FROM pairs_ s JOIN points_ t ON s.page = t.page GROUP BY s.page, s.x, s.y, dx, dy HAVING min(dx * (t.y - s.y) - dy * (t.x - s.x)) >= 0),
 turns_ AS (SELECT page, area, unnest([[dx, dy], [-dy, dx], [-dx, -dy], [dy, -dx]]) AS d FROM sides_),
 angles_ AS (SELECT page, area, degrees(atan2(d[2], d[1])) AS angle FROM turns_ WHERE d[1] > 0 AND -d[1] <= d[2] AND d[2] < d[1])"""


@query(
    """SELECT e.page, round(CASE WHEN sum(n) < 10 THEN 0.0 ELSE coalesce(any_value(angle), 0.0) END, 9) AS angle FROM ends_ e
 LEFT JOIN (SELECT page, angle FROM angles_ QUALIFY row_number() OVER (PARTITION BY page ORDER BY round(area, 9), abs(angle), angle) = 1) b ON b.page = e.page GROUP BY e.page""",
    DOTS.partition(",\n breaks_")[0],
    _SKEW,
)
def skew_estimate(spark, sf):
    return raster.skew(dots(spark, sf)).withColumn("angle", F.round("angle", 9))


def grey_pages(spark, sf) -> DataFrame:
    """``(page, height, width, pixels)`` of all vectors, 64 to a page, in the order of their ids."""
    level = lambda x: F.floor(F.least(F.greatest((x.cast("double") + 0.5) * 256, F.lit(0.0)), F.lit(255.0))).cast("long")
    rows = inputs.table(spark, sf, "embeddings").select(F.floor(F.col("vec_id") / SIDE).alias("page"), F.struct("vec_id", F.array_join(F.transform("embedding", lambda x: F.lpad(F.hex(level(x)), 2, "0")), "").alias("row")).alias("row"))
    pages = rows.groupBy("page").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    return pages.select("page", F.size("rows").alias("height"), F.lit(SIDE).alias("width"), F.unhex(F.array_join(F.transform("rows", lambda r: r["row"]), "")).alias("pixels"))


GREY = f"""grey_ AS (SELECT vec_id // {SIDE} AS page, row_number() OVER (PARTITION BY vec_id // {SIDE}, k ORDER BY vec_id) - 1 AS y, k - 1 AS x, count(*) OVER (PARTITION BY vec_id // {SIDE}, k) AS h, {SIDE} AS w,
 CAST(floor(least(greatest((CAST(embedding[k] AS DOUBLE) + 0.5) * 256, 0), 255)) AS INTEGER) AS v FROM embeddings, unnest(range(1, {SIDE} + 1)) AS u(k))"""


def digest(images: DataFrame) -> DataFrame:
    return images.select("page", "height", "width", F.md5(F.hex("pixels").cast("binary")).alias("pixels_md5"))


@query(
    """SELECT page, CAST(nh AS INTEGER) AS height, CAST(nw AS INTEGER) AS width, md5(string_agg(printf('%02X', CAST(round_even((v00 * (1 - fx) + v01 * fx) * (1 - fy) + (v10 * (1 - fx) + v11 * fx) * fy, 0) AS INTEGER)), '' ORDER BY y, x)) AS pixels_md5 FROM (
 SELECT d.page, nh, nw, d.x, d.y, fx, fy, coalesce(a.v, 255) AS v00, coalesce(b.v, 255) AS v01, coalesce(c.v, 255) AS v10, coalesce(e.v, 255) AS v11 FROM warp_ d
 LEFT JOIN grey_ a ON a.page = d.page AND a.x = d.x0 AND a.y = d.y0 LEFT JOIN grey_ b ON b.page = d.page AND b.x = d.x0 + 1 AND b.y = d.y0
 LEFT JOIN grey_ c ON c.page = d.page AND c.x = d.x0 AND c.y = d.y0 + 1 LEFT JOIN grey_ e ON e.page = d.page AND e.x = d.x0 + 1 AND e.y = d.y0 + 1) GROUP BY page, nh, nw""",
    GREY,
    """turn_ AS (SELECT page, max(h) AS h, max(w) AS w, cos(radians(any_value(page % 19 - 9))) AS co, sin(radians(any_value(page % 19 - 9))) AS si FROM grey_ GROUP BY page),
 canvas_ AS (SELECT *, CAST(trunc(h * abs(si) + w * abs(co)) AS BIGINT) AS nw, CAST(trunc(h * abs(co) + w * abs(si)) AS BIGINT) AS nh FROM turn_),
 spots_ AS (SELECT *, (x - nw / 2.0) * co - (y - nh / 2.0) * si + w / 2.0 AS sx, (x - nw / 2.0) * si + (y - nh / 2.0) * co + h / 2.0 AS sy FROM canvas_, unnest(range(nw)) AS u(x), unnest(range(nh)) AS t(y)),
 warp_ AS (SELECT *, CAST(floor(sx) AS BIGINT) AS x0, CAST(floor(sy) AS BIGINT) AS y0, sx - floor(sx) AS fx, sy - floor(sy) AS fy FROM spots_)""",
)
def rotated_pages(spark, sf):
    return digest(raster.rotate(grey_pages(spark, sf).withColumn("angle", (F.col("page") % 19 - 9).cast("double"))))


@query(
    """SELECT page, CAST(h AS INTEGER) AS height, CAST(w AS INTEGER) AS width, md5(string_agg(printf('%02X', CAST(round_even((a.m * (1 - fx) + b.m * fx) * (1 - fy) + (c.m * (1 - fx) + e.m * fx) * fy, 0) AS INTEGER)), '' ORDER BY y, x)) AS pixels_md5 FROM near_ d
 JOIN maps_ a USING (page, v) JOIN maps_ b USING (page, v) JOIN maps_ c USING (page, v) JOIN maps_ e USING (page, v)
 WHERE a.tx = greatest(x0, 0) AND a.ty = greatest(y0, 0) AND b.tx = least(x0 + 1, 7) AND b.ty = greatest(y0, 0) AND c.tx = greatest(x0, 0) AND c.ty = least(y0 + 1, 7) AND e.tx = least(x0 + 1, 7) AND e.ty = least(y0 + 1, 7) GROUP BY page, h, w""",
    GREY,
    """sizes_ AS (SELECT page, max(h) AS h, max(w) AS w, CAST(ceil(max(h) / 8.0) AS BIGINT) AS th, CAST(ceil(max(w) / 8.0) AS BIGINT) AS tw FROM grey_ GROUP BY page),
 padded_ AS (SELECT page, h, w, th, tw, x, y, CASE WHEN w = 1 THEN 0 ELSE least(x % (2 * w - 2), 2 * w - 2 - x % (2 * w - 2)) END AS mx, CASE WHEN h = 1 THEN 0 ELSE least(y % (2 * h - 2), 2 * h - 2 - y % (2 * h - 2)) END AS my FROM sizes_, unnest(range(8 * tw)) AS u(x), unnest(range(8 * th)) AS t(y)),
 counts_ AS (SELECT p.page, p.x // tw AS tx, p.y // th AS ty, th * tw AS n, g.v, count(*) AS c FROM padded_ p JOIN grey_ g ON g.page = p.page AND g.x = mx AND g.y = my GROUP BY ALL),
 tiles_ AS (SELECT page, tx, ty, n, greatest(CAST(floor(2.0 * n / 256) AS BIGINT), 1) AS lim, CAST(sum(greatest(c - greatest(CAST(floor(2.0 * n / 256) AS BIGINT), 1), 0)) AS BIGINT) AS over FROM counts_ GROUP BY page, tx, ty, n),
 clipped_ AS (SELECT t.page, t.tx, t.ty, t.n, l AS v, least(coalesce(c, 0), lim) + over // 256 + CASE WHEN over % 256 > 0 AND l % greatest(256 // greatest(over % 256, 1), 1) = 0 AND l // greatest(256 // greatest(over % 256, 1), 1) < over % 256 THEN 1 ELSE 0 END AS c
  FROM (SELECT *, unnest(range(256)) AS l FROM tiles_) t LEFT JOIN counts_ k ON k.page = t.page AND k.tx = t.tx AND k.ty = t.ty AND k.v = l),
 maps_ AS (SELECT page, tx, ty, v, least(greatest(round_even(CAST(sum(c) OVER (PARTITION BY page, tx, ty ORDER BY v) AS DOUBLE) * (255.0::DOUBLE / n), 0), 0), 255) AS m FROM clipped_),
 near_ AS (SELECT g.page, g.x, g.y, g.h, g.w, g.v, CAST(floor(g.x / th_w - 0.5) AS BIGINT) AS x0, CAST(floor(g.y / th_h - 0.5) AS BIGINT) AS y0, g.x / th_w - 0.5 - floor(g.x / th_w - 0.5) AS fx, g.y / th_h - 0.5 - floor(g.y / th_h - 0.5) AS fy
  FROM grey_ g JOIN (SELECT page, CAST(tw AS DOUBLE) AS th_w, CAST(th AS DOUBLE) AS th_h FROM sizes_) s ON s.page = g.page)""",
)
def equalized_pages(spark, sf):
    return digest(raster.equalize(grey_pages(spark, sf)))


@query()
def denoised_pages(spark, sf):
    """Non-local means over all pages, then contrast: the whole normalisation."""
    return digest(raster.normalize(grey_pages(spark, sf)))


@query()
def deskewed_pages(spark, sf):
    ink = dots(spark, sf)
    made = raster.deskew(raster.images_of(ink, sized(ink)))
    return made.select("page", "height", "width", F.round("angle", 9).alias("angle"), F.md5(F.hex("pixels").cast("binary")).alias("pixels_md5"))


_BOXES = """profile_ AS (SELECT page, row_, count(*) AS ink FROM dots_ GROUP BY page, row_),
 gaps_ AS (SELECT page, row_, CASE WHEN row_ - lag(row_) OVER (PARTITION BY page ORDER BY row_) - 1 > 3 THEN 1 ELSE 0 END AS fresh FROM profile_),
 bands_ AS (SELECT page, greatest(min(row_) - 2, 0) AS s, least(max(row_) + 3, 120) AS e FROM (SELECT *, sum(fresh) OVER (PARTITION BY page ORDER BY row_) AS band FROM gaps_) GROUP BY page, band),
 boxes_ AS (SELECT b.page, s, e, count(DISTINCT col_) AS cols, count(DISTINCT (row_, col_)) AS dark FROM bands_ b JOIN dots_ d ON d.page = b.page AND row_ >= s AND row_ < e WHERE e - s >= 10 GROUP BY b.page, s, e HAVING count(DISTINCT col_) >= 3)"""


@query(
    "SELECT printf('s_p%04d_l%04d.png', page, row_number() OVER (PARTITION BY page ORDER BY s) - 1) AS image_path, CAST(e - s AS INTEGER) AS height, 60 AS width, CAST(dark AS BIGINT) AS dark, CAST(NULL AS VARCHAR) AS error FROM boxes_",
    DOTS.partition(",\n breaks_")[0],
    _BOXES,
)
def line_crops(spark, sf):
    """Lines cut out of their pages, written as PNG files by the image sink, and read back from there."""
    ink = dots(spark, sf)
    pages = sized(ink)
    boxes = layout.lines(ink, pages.withColumns({"x": F.lit(0), "y": F.lit(0)}), least_width=3)
    path = new_path(spark, "crops")
    png.write_crops(raster.crops(raster.images_of(ink, pages), boxes).withColumn("source_id", F.lit("s")), path)
    back = png.read_crops(spark, path)
    name = F.regexp_extract("path", "[^/]*$", 0).alias("image_path")
    return back.select(name, "height", "width", (F.col("width") * F.col("height") - F.length(F.regexp_replace(F.hex("pixels"), "(00)", "")) / 2).cast("long").alias("dark"), "error")


@query()
def page_transcription(spark, sf):
    """Image bytes to page text: decoded, normalised, levelled, cut into lines; the lines' logits decoded by beam; an error stays on its row."""
    ink = dots(spark, sf)
    images = raster.images_of(ink, sized(ink)).withColumn("content", png.encode("height", "width", "pixels"))
    files = images.select("page", F.when(F.col("page") % 10 == 7, F.substring("content", F.lit(1), F.octet_length("content") - 30)).otherwise(F.col("content")).alias("content"))
    logits = inputs.logits(spark, sf)
    n = logits.agg(F.count_distinct("line_id").alias("_n"))
    heard = lambda lines: lines.join(F.broadcast(n)).select("page", "line_id", F.pmod(F.col("page") + F.col("line_id"), F.col("_n")).alias("key")).join(logits.withColumnRenamed("line_id", "key"), "key").drop("key")
    return transcribe.pages(files, heard, inputs.VOCAB, strength=0.0, least_width=3).withColumn("confidence", F.round("confidence", 6))
