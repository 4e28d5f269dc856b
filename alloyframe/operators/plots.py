"""Caption-anchored plot extraction: from page images and captions to numbered, distinct plots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alloyframe.functions import boxes as B
from alloyframe.functions import pixels as P
from alloyframe.operators.figures import best_plot, caption_blocks, first_of_equal_hashes


def extract_plots(pages: DataFrame, blocks: DataFrame, only_plots: bool = False) -> DataFrame:
    """(doc_id, caption, page, dhash, png, filename, saved) of the plots that captions belong to.

    pages: doc_id, page, png, page_w, page_h; blocks: doc_id, page, ord, x0, y0, x1, y1, text in points. Pages
    without a caption are not decoded. A plot whose hash an earlier one of the document has is left out.
    """
    caps = caption_blocks(blocks, only_plots).select("doc_id", "page", F.col("ord").alias("caption_id"), "text", B.to_pixels(F.col("y0")).alias("cy0"), B.to_pixels(F.col("y1")).alias("cy1"))
    region = B.search_region(F.col("cy0"), F.col("cy1"), F.col("page_h"))
    found = caps.join(pages, ["doc_id", "page"]).withColumn("r", region)
    whole = B.safe_crop(F.lit(0), F.col("r.top"), F.col("page_w"), F.col("r.bottom"), F.col("page_w"), F.col("page_h"))
    cut = found.withColumn("region", P.crop(F.col("png"), whole)).where("region is not null").withColumn("region_h", F.col("r.bottom") - F.col("r.top"))
    parts = cut.select("doc_id", "page", "caption_id", "text", "region", "page_w", "region_h", F.posexplode(P.region_box_array(F.col("region"))).alias("ord", "c"))
    parts = parts.where((F.col("ord") < 35) & B.large_enough(F.col("c.w"), F.col("c.h")))
    grown = B.grown(F.col("c.x"), F.col("c.y"), F.col("c.x") + F.col("c.w"), F.col("c.y") + F.col("c.h"), F.col("page_w"), F.col("region_h"))
    tried = parts.withColumn("box", grown).withColumn("png", P.crop(F.col("region"), F.col("box"))).withColumn("accepted", P.is_real_plot(F.col("png")))
    best = best_plot(tried.select("doc_id", F.struct("page", "caption_id", "text").alias("caption_id"), "ord", F.col("c.area").alias("area"), "accepted", F.struct("box", "png").alias("box")))
    plots = best.select("doc_id", F.col("caption_id.page").alias("page"), F.col("caption_id.caption_id").alias("n"), F.col("caption_id.text").alias("caption"), F.col("box.png").alias("png"), (F.col("box.box.x1") - F.col("box.box.x0")).alias("w"), (F.col("box.box.y1") - F.col("box.box.y0")).alias("h"))
    plots = plots.withColumn("png", P.crop(F.col("png"), B.trimmed(F.col("w"), F.col("h"))))
    hashed = plots.withColumn("levels", P.thumbnail_levels(F.col("png"))).withColumn("dhash", B.difference_bits(F.col("levels"), 9)).withColumn("ord", F.col("page") * 1_000_000 + F.col("n"))
    return first_of_equal_hashes(hashed).select("doc_id", "caption", "page", "dhash", "png", "filename", "saved")
