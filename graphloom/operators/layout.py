"""Boxes, reading order, screenshots, figures and image filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.functions.text import clamp, figure_number, round4, text

BOX = ("x", "y", "width", "height")
#: Least side, area and bytes of a kept image, its least share of the page, its
#: longest form, and bytes per pixel under which a small one has too little in it.
MIN_SIDE, MIN_AREA, MIN_BYTES, MIN_SHARE, MAX_ASPECT, LOW_BPP, LOW_AREA = 100, 30_000, 2048, 0.05, 12.0, 0.08, 500_000


def valid_box(*columns: Column) -> Column:
    """All four are numbers."""
    out = F.lit(True)
    for c in columns:
        out = out & c.try_cast("double").isNotNull()
    return out


def union_boxes(elements: DataFrame, *by: str) -> DataFrame:
    """The box around all valid boxes of a group, clamped and rounded."""
    own = elements.where(valid_box(*(F.col(c) for c in BOX)))
    left, top = F.min("x"), F.min("y")
    right, bottom = F.max(F.col("x") + F.col("width")), F.max(F.col("y") + F.col("height"))
    return own.groupBy(*by).agg(
        round4(clamp(left, 0.0, 1.0)).alias("x"),
        round4(clamp(top, 0.0, 1.0)).alias("y"),
        round4(clamp(right - left, 0.0001, 1.0)).alias("width"),
        round4(clamp(bottom - top, 0.0001, 1.0)).alias("height"),
        F.count("*").alias("n_boxes"),
    )


def normalized_box(x: Column, y: Column, width: Column, height: Column, page_width: Column, page_height: Column) -> list[Column]:
    """Pixels to shares of the page."""
    w, h = (F.when(c > 0, c).otherwise(F.lit(1.0)) for c in (page_width, page_height))
    return [clamp(x / w, 0.0, 1.0), clamp(y / h, 0.0, 1.0), clamp(width / w, 0.0, 1.0), clamp(height / h, 0.0, 1.0)]


def reading_order(elements: DataFrame, doc: str = "doc") -> DataFrame:
    """``order`` by page, line, place in the line and input position."""
    bands = (F.coalesce("y", F.lit(0.0)) / 0.035).cast("bigint")
    order = W.partitionBy(doc).orderBy("page", bands, F.coalesce("y", F.lit(0.0)), F.coalesce("x", F.lit(0.0)), "pos")
    return elements.withColumn("order", F.row_number().over(order).cast("bigint"))


def overlapped(blocks: DataFrame, tables: DataFrame, share: float = 0.6) -> DataFrame:
    """Blocks without those that a table on the page covers by more than ``share``."""
    t = tables.select(F.col("doc"), F.col("page"), *(F.col(c).alias(f"_{c}") for c in BOX))
    w = F.least(F.col("x") + F.col("width"), F.col("_x") + F.col("_width")) - F.greatest("x", "_x")
    h = F.least(F.col("y") + F.col("height"), F.col("_y") + F.col("_height")) - F.greatest("y", "_y")
    area = F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))
    boxed = blocks.where(valid_box(*(F.col(c) for c in BOX)))
    inside = boxed.join(t, ["doc", "page"]).where(area > share * F.greatest(F.col("width") * F.col("height"), F.lit(1e-9)))
    return blocks.join(inside.select("id").distinct(), "id", "left_anti")


def screenshots(segmented: DataFrame, doc: str = "doc") -> DataFrame:
    """One crop for each page of a problem, and one for each of its images with a box."""
    crops = union_boxes(segmented, doc, "problem", "page").select(doc, "problem", F.concat(F.lit("problem_page_"), F.col("page").cast("string")).alias("crop"), *BOX)
    n = F.row_number().over(W.partitionBy(doc, "problem").orderBy("pos"))
    images = segmented.where("type = 'image'").withColumn("_n", n).where(valid_box(*(F.col(c) for c in BOX)))
    return crops.unionByName(images.select(doc, "problem", F.concat(F.lit("diagram_"), F.col("_n").cast("string")).alias("crop"), *BOX))


def figures(candidates: DataFrame, elements: DataFrame, doc: str = "doc") -> DataFrame:
    """Diagram crops, or the image elements of documents without any; ``n`` in order."""
    crops = candidates.where(F.col("crop").startswith("diagram_")).select(doc, "crop", F.concat_ws("-", F.lpad(F.col("problem").cast("string"), 9, "0"), "crop").alias("at"))
    images = elements.where("type = 'image'").select(doc, F.concat(F.lit("element_"), F.col("id").cast("string")).alias("crop"), F.lpad(F.col("pos").cast("string"), 9, "0").alias("at"))
    images = images.join(crops.select(doc).distinct(), doc, "left_anti")
    return crops.unionByName(images).withColumn("n", F.row_number().over(W.partitionBy(doc).orderBy("at")).cast("bigint")).drop("at")


def match_figure(found: DataFrame, wanted: Column, doc: str = "doc") -> DataFrame:
    """Without a wanted label all figures; else the one of its number, else the
    first with low confidence."""
    number = F.nullif(figure_number(wanted), F.lit("")).try_cast("bigint")
    own = found.withColumn("_hit", number == F.col("n"))
    own = own.withColumn("_any", F.max("_hit").over(W.partitionBy(doc)))
    free = text(wanted).isNull()
    keep = free | F.coalesce("_hit", F.lit(False)) | (~free & ~F.coalesce("_any", F.lit(False)) & (F.col("n") == 1))
    certain = F.when(free, "all").when(F.coalesce("_hit", F.lit(False)), "matched").otherwise("low")
    return own.withColumn("match", certain).where(keep).drop("_hit", "_any")


def kept_images(images: DataFrame) -> DataFrame:
    """Images of ``doc, pos, width, height, n_bytes, md5, page_share, ...`` worth
    keeping.  A hash counts as seen from its first image that is large enough,
    whether that one is kept in the end or not."""
    area = F.col("width") * F.col("height")
    large = images.where((F.col("width") >= MIN_SIDE) & (F.col("height") >= MIN_SIDE) & (area >= MIN_AREA) & (F.col("n_bytes") >= MIN_BYTES))
    first = F.row_number().over(W.partitionBy("doc", "md5").orderBy("pos"))
    aspect = F.greatest("width", "height") / F.greatest(F.least("width", "height"), F.lit(1))
    poor = (F.col("n_bytes") / area < LOW_BPP) & (area < LOW_AREA)
    return large.withColumn("_n", first).where((F.col("_n") == 1) & (F.col("page_share") >= MIN_SHARE) & (aspect <= MAX_ASPECT) & ~poor).drop("_n")
