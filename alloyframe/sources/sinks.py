"""Sinks: the upload store, sheets by material, archives of figures, metadata, links and views."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alloyframe.functions.json import figure_metadata
from alloyframe.schema import PROPERTY_FACT


def conform(rows: DataFrame) -> DataFrame:
    """Rows as the property table has them: `english_units` is `english`, missing columns are null, others go."""
    if "english_units" in rows.columns and "english" not in rows.columns:
        rows = rows.withColumnRenamed("english_units", "english")
    return rows.select([(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in PROPERTY_FACT.fields])


def append_uploads(rows: DataFrame, path: str, source: str, once_by: str | None = None) -> None:
    """Append rows to the upload store, kept by class; with once_by, rows whose key the store has are left out."""
    out = conform(rows.withColumn("_src", F.lit(source)))
    if once_by:
        from alloyframe.sources.tables import read_uploads

        out = out.join(read_uploads(rows.sparkSession, path).select(once_by).distinct(), once_by, "left_anti").select(PROPERTY_FACT.names)
    out.write.mode("append").parquet(path)


def write_sheets(rows: DataFrame, path: str, table: str = "material_table") -> None:
    """One folder of CSV for each material, named by the first 31 characters; names that fall together are an error.

    A workbook would be one file written by one task, and no library for it is at hand.
    """
    named = rows.withColumn("sheet", F.substring(table, 1, 31))
    clash = named.groupBy("sheet").agg(F.count_distinct(table).alias("n")).where("n > 1").limit(1).collect()
    if clash:
        raise ValueError(f"several materials share the sheet name {clash[0]['sheet']}")
    named.write.mode("overwrite").partitionBy("sheet").option("header", True).csv(path)


def zip_figures(figures: Iterable[dict], with_json: bool = False) -> bytes:
    """An archive of one document's figures: metadata if asked for, then every image."""
    figures, sink = list(figures), io.BytesIO()
    with zipfile.ZipFile(sink, "w") as z:
        if with_json:
            z.writestr("plot_data.json", metadata_json(figures))
        for f in figures:
            for image in f["image_data"]:
                z.writestr(image["filename"], image["bytes"])
    return sink.getvalue()


def figure_archives(figures: DataFrame, with_json: bool = False) -> DataFrame:
    """(doc_id, archive): one archive for each document; the figures of one document fit a task."""

    def run(key, group):
        import pandas as pd

        rows = group.sort_values("ord", kind="stable").to_dict("records")
        return pd.DataFrame({"doc_id": [key[0]], "archive": [zip_figures(rows, with_json)]})

    return figures.groupBy("doc_id").applyInPandas(run, "doc_id string, archive binary")


def metadata_json(figures: Iterable[dict], names: bool = False) -> str:
    """Metadata of a document's figures as one array, indented by 4, ASCII only; with names, those of the images."""
    out = []
    for f in figures:
        own = {"caption": f["caption"], "page": f["page"], "image_count": len(f["image_data"])}
        out.append(own | {"images": [i["filename"] for i in f["image_data"]]} if names else own)
    return json.dumps(out, indent=4)


def plots_json(plots: Iterable[dict]) -> str:
    """Kept plots of a document as one array of page, caption and image, indented by 2, Unicode as it is."""
    return json.dumps([{"page": p["page"], "caption": p["caption"], "image": p["filename"]} for p in plots], indent=2, ensure_ascii=False)


def document_json(rows: DataFrame, write: Callable[[Iterable[dict]], str], order: str) -> DataFrame:
    """(doc_id, json) by one of the above for each document, whose figures fit a task; images' bytes are not read."""
    if "image_data" in rows.columns:
        rows = rows.withColumn("image_data", F.transform("image_data", lambda i: F.struct(i["filename"].alias("filename"))))
    own = [c for c in ("doc_id", "caption", "page", "image_data", "filename", order) if c in rows.columns]

    def run(key, group):
        import pandas as pd

        return pd.DataFrame({"doc_id": [key[0]], "json": [write(group.sort_values(order, kind="stable").to_dict("records"))]})

    return rows.select(*dict.fromkeys(own)).groupBy("doc_id").applyInPandas(run, "doc_id string, json string")


def write_table_texts(texts: DataFrame, folder: str) -> DataFrame:
    """Write table texts (doc_id, page, table_idx, text) as files by the name of each; returns (filename, path)."""
    name = table_text_name(F.col("doc_id"), F.col("page"), F.col("table_idx"))
    return write_binaries(texts.select(name.alias("filename"), F.col("text").cast("binary").alias("bytes")), folder)


def write_metadata(figures: DataFrame, path: str, names: bool = False) -> None:
    """Metadata of figures as JSON lines."""
    figures.select(figure_metadata(F.col("caption"), F.col("page"), F.col("image_data"), names).alias("value")).write.mode("overwrite").text(path)


def image_link(abbreviation, prop, folder: str = "images"):
    """Where the image of a material's property lies; a slash in the names may not open a folder."""
    safe = F.replace(F.concat_ws("_", abbreviation, prop), F.lit("/"), F.lit("_"))
    return F.concat(F.lit(f"{folder}/"), safe, F.lit(".png"))


def plot_name(page, number):
    """Name of the kept plots of a document, numbered from 0."""
    return F.format_string("p%02d_%04d.png", page, number)


def table_text_name(doc, page, number):
    return F.format_string("%s_table_%d_%d.txt", doc, page, number)


def write_binaries(rows: DataFrame, folder: str, name: str = "filename", content: str = "bytes") -> DataFrame:
    """Write images to a shared folder through the file system of its address; returns (filename, path)."""

    def run(batches):
        import pandas as pd
        import pyarrow.fs as pafs

        fs, root = pafs.FileSystem.from_uri(folder) if "://" in folder else (pafs.LocalFileSystem(), folder)
        fs.create_dir(root, recursive=True)
        for batch in batches:
            for n, data in zip(batch[name], batch[content], strict=True):
                with fs.open_output_stream(f"{root}/{n}") as f:
                    f.write(data)
            yield pd.DataFrame({"filename": batch[name], "path": [f"{folder}/{n}" for n in batch[name]]})

    return rows.select(name, content).mapInPandas(run, "filename string, path string")


def publish(rows: DataFrame, name: str = "base_data") -> None:
    """Offer a table to other queries of the session."""
    rows.createOrReplaceTempView(name)
