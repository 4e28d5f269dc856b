"""Figures: from boxes and text blocks of pages to grouped, captioned and de-duplicated plots."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from alloyframe.functions.boxes import DPI, good_share, padded, suppress_contained
from alloyframe.functions.pixels import decode_png, encode_png, page_box_array, page_boxes
from alloyframe.functions.text import caption_fits, is_caption, one_line, speaks_of_a_plot, squash, strip
from alloyframe.plugins import PlotDetector


def caption_blocks(blocks: DataFrame, only_plots: bool = False) -> DataFrame:
    """Text blocks that are captions, white space squashed; with only_plots those that speak of stress and strain."""
    out = blocks.withColumn("text", squash(F.col("text"))).where(is_caption(F.col("text")))
    return out.where(speaks_of_a_plot(F.col("text"))) if only_plots else out


def kept_boxes(boxes: DataFrame) -> DataFrame:
    """Candidate boxes of a fitting size that lie in no larger kept box of their page.

    boxes: doc_id, page, ord, x, y, w, h, page_w, page_h. A page's boxes are gathered in one row.
    """
    fit = boxes.where(good_share(F.col("w"), F.col("h"), F.col("page_w"), F.col("page_h")))
    pages = fit.groupBy("doc_id", "page", "page_w", "page_h").agg(F.collect_list(F.struct("x", "y", "w", "h", "ord")).alias("boxes"))
    return pages.select("doc_id", "page", "page_w", "page_h", F.inline(suppress_contained(F.col("boxes")))).drop("rank")


def nearest_caption(boxes: DataFrame, blocks: DataFrame, dpi: int = DPI) -> DataFrame:
    """Boxes with the caption that begins nearest below them, within 0.3 of the page's height; else a made-up one.

    Of captions at the same distance the first block counts. Every row of boxes gives one row. Boxes and captions of a
    page are gone through once, from the bottom up, so that no pairs are made.
    """
    texts = blocks.withColumn("text", strip(F.col("text"))).where(is_caption(F.col("text")))
    caps = texts.select("doc_id", "page", (F.col("y0") * (dpi / 72.0)).cast("double").alias("at"), F.lit(1).alias("kind"), F.col("ord").cast("long").alias("block_ord"), one_line(F.col("text")).alias("text"))
    box = F.struct(*(F.col(f"`{c}`") for c in boxes.columns))
    own = boxes.select("doc_id", "page", (F.col("y") + F.col("h")).cast("double").alias("at"), F.lit(0).alias("kind"), box.alias("box"))
    # a caption level with a box's lower edge comes after it and so is not below it; of captions at one height the first is seen last
    upwards = W.partitionBy("doc_id", "page").orderBy(F.desc("at"), "kind", F.desc("block_ord")).rowsBetween(W.unboundedPreceding, W.currentRow)
    seen = own.unionByName(caps, allowMissingColumns=True).withColumn("below", F.last(F.when(F.col("kind") == 1, F.struct("at", "text")), ignorenulls=True).over(upwards))
    near = F.col("below.at") - F.col("at") < F.col("box.page_h") * 0.3
    unlabeled = F.format_string("Figure on Page %d (Unlabeled)", "box.page")
    return seen.where("kind = 0").select("box.*", F.coalesce(F.when(near, F.col("below.text")), unlabeled).alias("caption"))


def grouped_figures(images: DataFrame) -> DataFrame:
    """(doc_id, caption, page, image_data, ord) from images (doc_id, page, ord, caption, filename, bytes).

    ord is whatever orders a document's images. Images of one caption are one figure, in order, on the page of the
    last of them. Images without the column bytes, whose files are elsewhere, give figures of file names alone, so
    that a caption with very many images stays small.
    """
    held = [c for c in ("filename", "bytes") if c in images.columns]
    listed = F.transform(F.sort_array(F.collect_list(F.struct("ord", *held))), lambda i: F.struct(*(i[c].alias(c) for c in held)))
    return images.groupBy("doc_id", "caption").agg(F.max_by("page", "ord").alias("page"), listed.alias("image_data"), F.min("ord").alias("ord"))


def extract_figures(boxes: DataFrame, blocks: DataFrame) -> DataFrame:
    """Figures of pages from detected boxes and text blocks: crops with padding, named by page and corner."""
    placed = nearest_caption(kept_boxes(boxes), blocks)
    rank = F.row_number().over(W.partitionBy("doc_id").orderBy("page", F.desc(F.col("w").cast("long") * F.col("h")), "ord"))
    return placed.select(
        "doc_id", "page", "caption", F.format_string("pg%d_%d_%d.png", "page", "x", "y").alias("filename"), padded(*(F.col(c) for c in ("x", "y", "w", "h", "page_w", "page_h"))).alias("crop"), rank.alias("ord")
    )


def extract_images(pages: DataFrame, blocks: DataFrame, detector: PlotDetector = page_boxes, dpi: int = DPI) -> DataFrame:
    """Figures (doc_id, caption, page, image_data, ord) of page images (doc_id, page, png, page_w, page_h).

    The detector names boxes; those of a fitting size that lie in no larger one are cut out with padding, while the page
    is decoded, and grouped by the caption below them.
    """
    boxes = F.filter(page_box_array(F.col("png"), detector), lambda b: good_share(b["w"], b["h"], F.col("page_w"), F.col("page_h")))
    kept = suppress_contained(F.transform(boxes, lambda b, i: F.struct(b["x"].alias("x"), b["y"].alias("y"), b["w"].alias("w"), b["h"].alias("h"), i.alias("ord"))))
    found = pages.select("doc_id", "page", "page_w", "page_h", "png", kept.alias("kept"))
    corners = F.transform("kept", lambda b: padded(b["x"], b["y"], b["w"], b["h"], F.col("page_w"), F.col("page_h")))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                if len(r.kept):
                    image = decode_png(bytes(r.png))
                    parts = [encode_png(image[c["y0"] : c["y1"], c["x0"] : c["x1"]]) for c in r.corners]
                    yield pd.DataFrame([(r.doc_id, r.page, r.page_w, r.page_h, k, b["x"], b["y"], b["w"], b["h"], part) for k, (b, part) in enumerate(zip(r.kept, parts, strict=True))])

    rows = found.withColumn("corners", corners).mapInPandas(cut, "doc_id string, page int, page_w int, page_h int, rank int, x int, y int, w int, h int, bytes binary")
    images = nearest_caption(rows, blocks, dpi)
    named = images.withColumn("filename", F.format_string("pg%d_%d_%d.png", "page", "x", "y")).withColumn("ord", F.struct("page", "rank"))
    return grouped_figures(named)


def first_of_equal_hashes(plots: DataFrame) -> DataFrame:
    """Of a document's plots (doc_id, ord, page, dhash, ...) those whose hash comes first, numbered and named from 0."""
    first = plots.withColumn("_n", F.row_number().over(W.partitionBy("doc_id", "dhash").orderBy("ord"))).where("_n = 1").drop("_n")
    saved = (F.row_number().over(W.partitionBy("doc_id").orderBy("page", "ord")) - 1).alias("saved")
    return first.select("*", saved).withColumn("filename", F.format_string("p%02d_%04d.png", "page", "saved"))


def best_plot(candidates: DataFrame, most: int = 35) -> DataFrame:
    """The largest accepted candidate of each caption among its first `most` by area; the first of equal ones.

    candidates: doc_id, caption_id, ord (by falling area), area, accepted, box.
    """
    return candidates.where((F.col("ord") < most) & F.col("accepted")).groupBy("doc_id", "caption_id").agg(F.max_by(F.struct("area", "ord", "box"), F.struct(F.col("area"), -F.col("ord"))).alias("b")).select("doc_id", "caption_id", "b.*")


def match_captions(figures: DataFrame, properties: DataFrame) -> DataFrame:
    """(doc_id, caption, property_name) one to one: each figure in order takes the first property left that fits.

    figures: doc_id, ord, caption, image_data; one without images takes none. properties: doc_id, ord, property_name;
    names count once, at their first place. A document's figures and properties are gathered in one row.
    """
    figs = figures.where(F.size("image_data") > 0).groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("ord", "caption"))).alias("figs"))
    names = properties.groupBy("doc_id", "property_name").agg(F.min("ord").alias("ord"))
    props = names.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("ord", "property_name"))).alias("props"))
    pairs = F.array().cast("array<struct<caption:string,property_name:string>>")

    def take(done, fig):
        free = F.filter("props", lambda p: ~F.exists(done, lambda d: d["property_name"] == p["property_name"]) & F.coalesce(caption_fits(fig["caption"], p["property_name"]), F.lit(False)))
        return F.when(F.size(free) > 0, F.concat(done, F.array(F.struct(fig["caption"].alias("caption"), F.get(free, F.lit(0))["property_name"].alias("property_name"))))).otherwise(done)

    return figs.join(props, "doc_id").select("doc_id", F.inline(F.aggregate("figs", pairs, take)))
