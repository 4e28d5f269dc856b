"""Queries of sources, sinks, models, page measures and whole pipelines, with the SQL that says the same.

Injected models are stand-ins that SQL can express: counts of letters as an embedding, the length of a name as a
verifier, JSON in a file's bytes as an extractor.
"""

from __future__ import annotations

import io
import json
import re
import sqlite3
import zipfile
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alloyframe import plugins, schema
from alloyframe.functions import boxes, pixels, text
from alloyframe.functions.json import extraction, figure_metadata
from alloyframe.functions.vectors import cosine, squared_distance
from alloyframe.operators import figures, ingest, reconcile, retrieve, search
from alloyframe.plans.queries import _FACTS, _FORMS, _TEMPLATE, _facts, _forms
from alloyframe.plans.registry import query, table
from alloyframe.sources import extractors, sinks, tables
from alloyframe.sources.scratch import scratch

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def letter_counts(texts) -> np.ndarray:
    return np.array([[x.lower().count(c) for c in LETTERS] for x in texts], np.float32).reshape(-1, 26)


def long_name(wanted: str, found: str) -> bool:
    return len(found) >= 5


def _sql_letters(column: str) -> str:
    return f"list_transform(string_split('{' '.join(LETTERS)}', ' '), lambda c: len({column}) - len(replace(lower({column}), c, '')))"


def _sql_cosine(a: str, b: str) -> str:
    dot = lambda x, y: f"list_sum(list_transform(range(1, 27), lambda i: CAST({x}[i] AS DOUBLE) * {y}[i]))"
    return f"CASE WHEN sqrt({dot(a, a)}) * sqrt({dot(b, b)}) = 0 THEN 0 ELSE {dot(a, b)} / (sqrt({dot(a, a)}) * sqrt({dot(b, b)})) END"


# --- sources and sinks -----------------------------------------------------------------------------------------
@query("""SELECT p_brand AS material_abbreviation, CASE WHEN p_partkey % 5 NOT IN (0, 1, 2) THEN p_name WHEN p_partkey % 5 = 1 THEN 'na' END AS value, 'Polymer' AS material_class, count(*) AS n FROM part GROUP BY ALL""")
def csv_nulls(spark, sf_dir):
    """Parts as a property file, read back with the strings that stand for null."""
    part = table(spark, sf_dir, "part")
    k = F.col("p_partkey") % 5
    value = F.when(k == 0, "N/A").when(k == 1, "na").when(k == 2, "NaN").otherwise(F.col("p_name"))
    folder = scratch(spark, "csv")
    part.select(F.col("p_brand").alias("material_abbreviation"), value.alias("value")).write.option("header", True).csv(f"{folder}/Polymers.csv")
    return tables.read_class(spark, folder, "Polymers").groupBy("material_abbreviation", "value", "material_class").agg(F.count("*").alias("n"))


@query(f"WITH {_FORMS} SELECT c AS material_class, j.p_name AS material_name, upper(array_to_string(list_transform(string_split(j.p_name, ' '), lambda w: w[1]), '')) AS material_abbreviation, CAST(p_size AS VARCHAR) AS value, 'form' AS _src FROM j JOIN part USING (p_partkey) WHERE reason IS NULL")
def submit_form(spark, sf_dir):
    """Form rows into the upload store, and what the store then has."""
    store = scratch(spark, "store")
    ingest.submit_form(_forms(spark, sf_dir).drop("p_partkey"), store)
    return tables.read_uploads(spark, store).select("material_class", "material_name", "material_abbreviation", "value", "_src")


def _nation_rows(spark, sf_dir) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    name = F.concat("n_name", F.lit("!"))  # so that no name is part of another
    return nation.select(F.col("n_regionkey").cast("string").alias("doc_id"), F.col("n_nationkey").cast("long").alias("_ord"), F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("material_abbreviation"), name.alias("property_name"), F.col("n_name").alias("value"))


def _nation_figures(spark, sf_dir) -> DataFrame:
    """A figure for every nation, those of even keys with an image, whose caption names it."""
    image = F.struct(F.concat("n_name", F.lit(".png")).alias("filename"), F.encode("n_name", "utf-8").alias("bytes"))
    none = F.array().cast("array<struct<filename:string,bytes:binary>>")
    return table(spark, sf_dir, "nation").select(F.col("n_regionkey").cast("string").alias("doc_id"), F.col("n_nationkey").alias("ord"), F.concat(F.lit("Fig. 1 of "), "n_name", F.lit("!")).alias("caption"), F.col("n_regionkey").alias("page"), F.when(F.col("n_nationkey") % 2 == 0, F.array(image)).otherwise(none).alias("image_data"))


@query("SELECT n_name || '!' AS property_name, 'Fig. 1 of ' || n_name || '!' AS caption, 'images/R' || n_regionkey || '_' || n_name || '!.png' AS image_path, n_name AS saved FROM nation WHERE n_nationkey % 2 = 0")
def save_matched_images(spark, sf_dir):
    """Images written under the names of the properties that their captions fit, and their bytes read back."""
    folder = scratch(spark, "images")
    links = ingest.save_matched_images(_nation_rows(spark, sf_dir), _nation_figures(spark, sf_dir), folder).persist()
    links.count()
    files = tables.read_files(spark, folder).select(F.regexp_extract(F.url_decode("path"), "([^/]+)$", 1).alias("name"), F.decode("content", "utf-8").alias("saved"))
    return links.join(files, F.substring_index("image_path", "/", -1) == F.col("name")).select("property_name", "caption", "image_path", "saved")


@query("SELECT 'Fiber' AS material_class, 'R' || n_regionkey AS material_abbreviation, n_name || '!' AS property_name, n_name AS value, 'pdf' AS _src, CASE WHEN n_nationkey % 2 = 0 THEN 'images/R' || n_regionkey || '_' || n_name || '!.png' END AS image_path FROM nation")
def ingest_with_images(spark, sf_dir):
    """Rows under a class and their figures' images into the store, and the search's view of both."""
    store, folder = scratch(spark, "store"), scratch(spark, "images")
    links = ingest.ingest(_nation_rows(spark, sf_dir), "Fiber", store, _nation_figures(spark, sf_dir), folder)
    return search.with_images(tables.read_uploads(spark, store), links).select("material_class", "material_abbreviation", "property_name", "value", "_src", "image_path")


@query("SELECT n_nationkey AS key, 'Figure 1.' || n_nationkey AS caption, len(n_name) AS n_bytes, n_name || '.png' AS name FROM nation WHERE n_nationkey % 2 = 0")
def figure_archives(spark, sf_dir):
    """What the archives of a document's figures hold."""
    figs = _nation_figures(spark, sf_dir).withColumn("caption", F.concat(F.lit("Figure 1."), F.col("ord").cast("string")))

    def names(batches):
        for batch in batches:
            out = []
            for data in batch["archive"]:
                with zipfile.ZipFile(io.BytesIO(bytes(data))) as z:
                    said = {f["caption"]: f["image_count"] for f in json.loads(z.read("plot_data.json"))}
                    held = sorted(int(c.split(".")[1]) for c, n in said.items() if n)
                    images = [i for i in z.infolist() if i.filename != "plot_data.json"]
                    out += [(k, f"Figure 1.{k}", i.file_size, i.filename) for k, i in zip(held, images, strict=True)]
            yield pd.DataFrame(out, columns=["key", "caption", "n_bytes", "name"])

    return sinks.figure_archives(figs, True).mapInPandas(names, "key int, caption string, n_bytes long, name string")


_JSON_ITEM = """'    {' || chr(10) || '        "caption": "Fig. 1 of ' || n_name || '!",' || chr(10) || '        "page": ' || n_regionkey || ',' || chr(10) || '        "image_count": ' || CASE WHEN n_nationkey % 2 = 0 THEN 1 ELSE 0 END || chr(10) || '    }'"""


@query(f"SELECT CAST(n_regionkey AS VARCHAR) AS doc_id, '[' || chr(10) || string_agg({_JSON_ITEM}, ',' || chr(10) ORDER BY n_nationkey) || chr(10) || ']' AS json FROM nation GROUP BY n_regionkey")
def figures_json(spark, sf_dir):
    return sinks.document_json(_nation_figures(spark, sf_dir), sinks.metadata_json, "ord")


@query("""SELECT CAST(n_regionkey AS VARCHAR) AS doc_id, '[' || chr(10) || string_agg('  {' || chr(10) || '    "page": ' || n_regionkey || ',' || chr(10) || '    "caption": "é ' || n_name || '",' || chr(10) || '    "image": "p0' || n_regionkey || '_' || printf('%04d', n) || '.png"' || chr(10) || '  }', ',' || chr(10) ORDER BY n) || chr(10) || ']' AS json
FROM (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS n FROM nation) GROUP BY n_regionkey""")
def plots_json(spark, sf_dir):
    plots = table(spark, sf_dir, "nation").select(F.col("n_regionkey").cast("string").alias("doc_id"), F.col("n_nationkey").alias("ord"), F.col("n_regionkey").alias("page"), F.concat(F.lit("é "), "n_name").alias("caption"), F.col("n_nationkey").alias("dhash"))
    return sinks.document_json(figures.first_of_equal_hashes(plots), sinks.plots_json, "saved")


@query("""SELECT p_partkey, '{"caption":"' || p_name || '","page":' || p_size || ',"image_count":' || (p_size % 3) || ',"images":[' || array_to_string(list_transform(range(p_size % 3), lambda i: '"f' || i || '.png"'), ',') || ']}' AS json FROM part""")
def figure_metadata_json(spark, sf_dir):
    images = F.transform(F.filter(F.sequence(F.lit(0), F.lit(2)), lambda i: i < F.col("p_size") % 3), lambda i: F.struct(F.concat(F.lit("f"), i.cast("string"), F.lit(".png")).alias("filename")))
    return table(spark, sf_dir, "part").select("p_partkey", figure_metadata(F.col("p_name"), F.col("p_size"), images, True).alias("json"))


@query("SELECT printf('%d_table_%d_0.txt', n_regionkey, n_regionkey + 1) AS filename, string_agg(n_name || ' | ' || n_nationkey, chr(10) ORDER BY n_nationkey) AS text FROM nation GROUP BY n_regionkey")
def table_files(spark, sf_dir):
    """Tables read from files by an injected reader that counts pages from 0, as text files, and read back."""
    folder = scratch(spark, "tables")
    sinks.write_table_texts(retrieve.table_text(_nation_cells(spark, sf_dir)), folder).count()
    files = tables.read_files(spark, folder)
    return files.select(F.regexp_extract("path", "([^/]+)$", 1).alias("filename"), F.decode("content", "utf-8").alias("text"))


def _nation_files(spark, sf_dir) -> DataFrame:
    """A file for each region that holds its nations as JSON."""
    rows = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.sort_array(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("rows"))
    return rows.select(F.concat(F.lit("/in/"), F.col("n_regionkey").cast("string"), F.lit(".pdf")).alias("path"), F.encode(F.to_json(F.struct("n_regionkey", "rows")), "utf-8").alias("content"))


def _read_table(content: bytes) -> list[tuple]:
    said = json.loads(content)
    return [(said["n_regionkey"], [["name", "key"], *([r["n_name"], str(r["n_nationkey"])] for r in said["rows"])])]


def _nation_cells(spark, sf_dir) -> DataFrame:
    return extractors.page_tables(_nation_files(spark, sf_dir), _read_table, first_page=0)


@query("SELECT n_regionkey + 1 AS page, row_number() OVER (PARTITION BY n_regionkey, c.col_name ORDER BY n_nationkey) AS row_idx, c.col_name, CASE c.col_name WHEN 'name' THEN n_name ELSE CAST(n_nationkey AS VARCHAR) END AS cell FROM nation, (VALUES ('name'), ('key')) AS c(col_name)")
def promote_header(spark, sf_dir):
    return retrieve.promote_header(_nation_cells(spark, sf_dir)).select(F.col("page").cast("long").alias("page"), F.col("row_idx").cast("long").alias("row_idx"), "col_name", "cell")


@query("""SELECT CAST(n_regionkey + 1 AS INTEGER) AS page, 'table' AS type, string_agg(n_name || ' | ' || n_nationkey, chr(10) ORDER BY n_nationkey) AS text, n_regionkey || '_table_' || (n_regionkey + 1) || '_0.txt' AS path FROM nation GROUP BY n_regionkey""")
def table_items(spark, sf_dir):
    return retrieve.table_items(_nation_cells(spark, sf_dir)).drop("image")


@query("SELECT CAST(n_regionkey AS VARCHAR) AS doc_id, CAST(n_regionkey AS INTEGER) AS page, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS ord, CAST(n_nationkey AS DOUBLE) AS y0, n_name AS text FROM nation")
def page_blocks(spark, sf_dir):
    def reader(content: bytes) -> list[tuple]:
        said = json.loads(content)
        return [(said["n_regionkey"], 0.0, float(r["n_nationkey"]), 1.0, float(r["n_nationkey"]), r["n_name"]) for r in said["rows"]]

    return extractors.page_blocks(_nation_files(spark, sf_dir), reader).select("doc_id", "page", F.col("ord").cast("long").alias("ord"), "y0", "text")


@query("""SELECT CAST(p_partkey AS VARCHAR) AS doc_id, p_name AS material_name, upper(array_to_string(list_transform(string_split(p_name, ' '), lambda w: w[1]), '')) AS material_abbreviation, p_type AS property_name, CASE WHEN p_size % 2 = 0 THEN 'N/A' ELSE CAST(p_size AS VARCHAR) END AS value FROM part WHERE p_partkey % 3 != 0""")
def extract_answers(spark, sf_dir):
    """Files through an injected extractor, which fails on every third, to rows."""
    inner = F.to_json(F.struct(F.col("p_name").alias("material_name"), F.array(F.struct(F.col("p_type").alias("property_name"), F.when(F.col("p_size") % 2 == 0, "").otherwise(F.col("p_size").cast("string")).alias("value"))).alias("mechanical_properties")))
    content = F.when(F.col("p_partkey") % 3 == 0, "no answer {").otherwise(F.concat(F.lit("junk "), inner))
    files = table(spark, sf_dir, "part").select(F.concat(F.lit("/in/"), F.col("p_partkey").cast("string"), F.lit(".pdf")).alias("path"), F.encode(content, "utf-8").alias("content"))
    rows = ingest.extract_rows(ingest.parse_answers(extractors.extract_answers(files, plugins.embedded_json)))
    return rows.select("doc_id", "material_name", "material_abbreviation", "property_name", "value")


@query("SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_returnflag) - 1 AS _ord, 'order' AS material_name, l_returnflag AS property_name, CASE WHEN l_linenumber > 2 THEN '' ELSE CAST(l_linenumber AS VARCHAR) END AS value FROM orders JOIN lineitem ON o_orderkey = l_orderkey")
def explode_plain(spark, sf_dir):
    """The older row builder, which puts no defaults in."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.struct("l_linenumber", F.col("l_returnflag").alias("property_name"), F.when(F.col("l_linenumber") > 2, "").otherwise(F.col("l_linenumber").cast("string")).alias("value")).alias("x"))
    docs = lines.groupBy("l_orderkey").agg(F.to_json(F.struct(F.lit("order").alias("material_name"), F.sort_array(F.collect_list("x")).alias("mechanical_properties"))).alias("text"))
    parsed = docs.select(F.col("l_orderkey").alias("doc_id"), extraction(F.col("text")).alias("doc"))
    return ingest.extract_rows_plain(parsed).select(F.col("doc_id").alias("o_orderkey"), "_ord", "material_name", "property_name", "value")


@query("SELECT r_name AS material_table, row_number() OVER (PARTITION BY r_name ORDER BY n_nationkey) - 1 AS _ord, n_name AS property_name, CAST(n_nationkey AS VARCHAR) AS value, NULL::VARCHAR AS comments FROM nation JOIN region ON n_regionkey = r_regionkey")
def sqlite_scan(spark, sf_dir):
    """A database with a table for each region, made from 25 rows on this machine and read by the data source."""
    rows = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).orderBy("n_nationkey").collect()
    path = re.sub("^file:/*", "/", scratch(spark, "tables")) + ".db"
    spark.createDataFrame([], "x int").write.parquet(f"file://{path}-folder")  # so that the folder is there
    with sqlite3.connect(path) as db:
        for r in rows:
            db.execute(f'CREATE TABLE IF NOT EXISTS "{r.r_name}" (property_name TEXT, value INTEGER)')
            db.execute(f'INSERT INTO "{r.r_name}" VALUES (?, ?)', (r.n_name, r.n_nationkey))
    return tables.read_sqlite(spark, path).select("material_table", "_ord", "property_name", "value", "comments")


@query("SELECT r_name AS sheet, n_nationkey, n_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def sheets(spark, sf_dir):
    """Sheets by material, read back."""
    rows = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_name").alias("material_table"), "n_nationkey", "n_name")
    path = scratch(spark, "sheets")
    sinks.write_sheets(rows, path)
    return spark.read.schema("material_table string, n_nationkey int, n_name string, sheet string").option("header", True).csv(path).select("sheet", "n_nationkey", "n_name")


@query("SELECT n_nationkey, 'data:image/png;base64,' || base64(encode(n_name)) AS url FROM nation")
def data_url(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_nationkey", tables.data_url(F.encode("n_name", "utf-8")).alias("url"))


@query(f"WITH {_FACTS} SELECT material_abbreviation, count(*) AS n FROM facts GROUP BY 1")
def published_view(spark, sf_dir):
    """The base table as other queries of the session find it, counted by material."""
    sinks.publish(_facts(spark, sf_dir))
    return spark.sql("SELECT material_abbreviation, count(*) AS n FROM base_data GROUP BY material_abbreviation")


_LEAVES = [(c, s, n) for c, own in schema.TAXONOMY.items() for s, names in own.items() for n in names]


@query("SELECT * FROM (VALUES " + ", ".join(f"('{c}', '{s}', '{n}', {i})" for i, (c, s, n) in enumerate(_LEAVES)) + ") AS t(material_class, section, property_name, ord)")
def taxonomy_lookup(spark, sf_dir):
    """Categories of each class and names of each category, as a form asks for them one after the other."""
    base = table(spark, sf_dir, "region")
    names = [ingest.property_names(base, c, s).select(F.lit(c).alias("material_class"), F.lit(s).alias("section"), "property_name", "ord") for c in ingest.CLASSES for s in schema.TAXONOMY[c]]
    known = [ingest.categories(base, c).select(F.lit(c).alias("material_class"), "section") for c in ingest.CLASSES]
    return reduce(DataFrame.unionAll, names).join(F.broadcast(reduce(DataFrame.unionAll, known)), ["material_class", "section"], "left_semi")  # 16 rows


# --- search and matching ---------------------------------------------------------------------------------------
_ABBREVIATIONS = ("Carbon/Epoxy", "E-Glass/PP", "CF/PPS", "Nylon PA6 Kevlar", "Basalt Vinyl Ester", "Cynate Ester S-glass", "copper", "", None, "natural PEEK")
_ABBREVIATION = "CASE p_partkey % 10 " + " ".join(f"WHEN {i} THEN '{a}'" for i, a in enumerate(_ABBREVIATIONS) if a is not None) + " END"


def _first_key(keys, column: str) -> str:
    return "CASE " + " ".join(f"WHEN contains(lower({column}), '{k}') THEN '{v}'" for k, v in keys) + " END"


@query(f"WITH a AS (SELECT coalesce({_ABBREVIATION}, '') AS material_abbreviation, p_brand AS material_name, min(p_partkey) AS _ord FROM part GROUP BY 1, 2) SELECT *, {_first_key(schema.MATRIX_KEYS, 'material_abbreviation')} AS matrix, {_first_key(schema.FIBER_KEYS, 'material_abbreviation')} AS fiber FROM a")
def matrix_and_fiber(spark, sf_dir):
    """Materials with matrix and fiber by the engine's own keys."""
    rows = table(spark, sf_dir, "part").select(F.get(F.array(*map(F.lit, _ABBREVIATIONS)), (F.col("p_partkey") % 10).cast("int")).alias("material_abbreviation"), F.col("p_brand").alias("material_name"), F.col("p_partkey").alias("_ord"))
    return search.material_list(rows)


@query("SELECT p_partkey, p_name FROM (SELECT *, row_number() OVER (ORDER BY p_size, p_partkey) - 1 AS n FROM part) WHERE n IN (0, 17)")
def positional_rows(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return search.row_at(part, 0, "p_size", "p_partkey").unionAll(search.row_at(part, 17, "p_size", "p_partkey")).select("p_partkey", "p_name")


@query(f"WITH {_FACTS}, o AS (SELECT property_name, min(_ord) AS _ord FROM facts WHERE section LIKE 'P%' GROUP BY 1) SELECT property_name, _ord FROM o")
def property_names_in_order(spark, sf_dir):
    return search.first_distinct(_facts(spark, sf_dir).where("section like 'P%'"), "property_name")


@query("""SELECT event_id AS image_id, event_type AS property_name, us AS at FROM (SELECT user_id, event_id, event_type, epoch_us(ts) AS us FROM events) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY us DESC, event_id DESC) = 1""")
def latest_links(spark, sf_dir):
    """A user's events as changes of one image's link; the latest holds."""
    events = table(spark, sf_dir, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp")) if dict(events.dtypes)["ts"] == "timestamp" else F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts"))
    own = events.select(F.col("user_id").alias("image_id"), F.struct("event_type", "event_id").alias("property_name"), F.struct(micros.alias("us"), "event_id").alias("at"))
    found = ingest.latest_links(own.where("at.event_id % 2 = 0"), own.where("at.event_id % 2 = 1"))
    return found.select(F.col("property_name.event_id").alias("image_id"), F.col("property_name.event_type").alias("property_name"), F.col("at.us").alias("at"))


_PLOT_TEXT = "CASE p_partkey % 4 WHEN 0 THEN 'Fig. 1 Tensile load' WHEN 1 THEN 'Fig. 2 in gpa' WHEN 2 THEN 'Fig. 3 ' || p_name ELSE 'stress strain' END"


@query(f"SELECT p_partkey, {_PLOT_TEXT} AS text FROM part WHERE regexp_matches({_PLOT_TEXT}, '^(Fig\\.?\\s*\\d+|Figure\\s*\\d+)\\b', 'i') AND regexp_matches({_PLOT_TEXT}, '(stress\\s*[-–]?\\s*strain|stress|strain|tensile|MPa|GPa|kN|yield|elongation)', 'i')")
def plot_captions(spark, sf_dir):
    made = F.array(F.lit("Fig. 1  Tensile\tload"), F.lit("Fig. 2 in gpa"), F.concat(F.lit("Fig. 3 "), "p_name"), F.lit("stress strain"))
    blocks = table(spark, sf_dir, "part").select("p_partkey", F.get(made, (F.col("p_partkey") % 4).cast("int")).alias("text"))
    return figures.caption_blocks(blocks, only_plots=True)


_SEMANTIC = f"""m AS (SELECT p_brand AS material_table, p_type AS section, p_name AS name, p_partkey AS _ord FROM part),
w AS (SELECT p_brand AS material_table, p_partkey AS tpl_row, p_type AS s, p_name AS name FROM part WHERE p_partkey % 50 = 0),
v AS (SELECT DISTINCT name, {_sql_letters("name")} AS v FROM m),
p AS (SELECT w.material_table, w.tpl_row, m.name, m._ord, {_sql_cosine("a.v", "b.v")} AS sim FROM w JOIN m ON w.material_table = m.material_table AND lower(w.s) = lower(m.section) JOIN v a ON a.name = w.name JOIN v b ON b.name = m.name),
r AS (SELECT *, row_number() OVER (PARTITION BY material_table, tpl_row ORDER BY sim DESC, _ord) AS rank FROM p)"""


def _semantic(spark, sf_dir) -> DataFrame:
    part = table(spark, sf_dir, "part")
    own = part.select(F.col("p_brand").alias("material_table"), F.col("p_type").alias("section"), F.col("p_name").alias("property_name"), *[F.lit("").alias(c) for c in ("value", "unit", "english", "comments")], F.col("p_partkey").alias("_ord"))
    wanted = part.where("p_partkey % 50 = 0").select(F.col("p_brand").alias("material_table"), F.col("p_partkey").alias("tpl_row"), F.col("p_type").alias("tpl_section"), F.col("p_name").alias("tpl_property"))
    return reconcile.nearest_names(wanted, own, letter_counts)


@query(f"WITH {_SEMANTIC} SELECT material_table, tpl_row, rank, round(sim, 6) AS sim, name, _ord FROM r WHERE rank <= 5")
def template_semantic(spark, sf_dir):
    """The five most similar names of the same table and section, for every part whose key 50 divides."""
    return _semantic(spark, sf_dir).select("material_table", "tpl_row", "rank", F.round("sim", 6).alias("sim"), F.col("found.property_name").alias("name"), F.col("found._ord").alias("_ord"))


@query(f"WITH {_SEMANTIC} SELECT material_table, tpl_row, arg_min(name, rank) AS name FROM r WHERE rank <= 5 AND len(name) % 2 = 0 GROUP BY ALL")
def template_verified(spark, sf_dir):
    """The first of the five that the verifier accepts."""
    got = reconcile.first_verified(_semantic(spark, sf_dir), lambda wanted, found: len(found) % 2 == 0)
    return got.select("material_table", "tpl_row", F.col("found.property_name").alias("name"))


@query(f"""WITH {_FACTS}, t(tpl_row, s, p) AS (VALUES {", ".join(map(str, _TEMPLATE))}),
m AS (SELECT DISTINCT material_abbreviation AS material_table FROM facts),
c AS (SELECT material_table, tpl_row, p, f.property_name, value, _ord, f.section IS NOT NULL AND lower(f.property_name) = lower(trim(p)) AS exact FROM m CROSS JOIN t LEFT JOIN facts f ON f.material_abbreviation = material_table AND lower(f.section) = lower(trim(s))),
e AS (SELECT material_table, tpl_row, arg_min(property_name, _ord) FILTER (exact) AS name, arg_min(value, _ord) FILTER (exact) AS value FROM c GROUP BY ALL),
v AS (SELECT c.*, {_sql_cosine("a.v", "b.v")} AS sim FROM c JOIN e USING (material_table, tpl_row) JOIN (SELECT DISTINCT p AS x, {_sql_letters("p")} AS v FROM t) a ON a.x = c.p JOIN (SELECT DISTINCT property_name AS y, {_sql_letters("property_name")} AS v FROM facts) b ON b.y = c.property_name WHERE e.name IS NULL),
k AS (SELECT *, row_number() OVER (PARTITION BY material_table, tpl_row ORDER BY sim DESC, _ord, property_name) AS rank FROM v),
n AS (SELECT material_table, tpl_row, arg_min(property_name, rank) AS name, arg_min(value, rank) AS value FROM k WHERE rank <= 5 AND len(property_name) >= 5 GROUP BY ALL)
SELECT e.material_table, CAST(e.tpl_row AS BIGINT) AS tpl_row, coalesce(e.name, n.name) AS matched, coalesce(e.value, n.value) AS value FROM e LEFT JOIN n USING (material_table, tpl_row)""")
def reconcile_template(spark, sf_dir):
    """Exact names first, then similar ones that the verifier accepts, for every material."""
    facts = _facts(spark, sf_dir).withColumn("_ord", F.col("_ord") * 2 + (F.col("property_name") == "size").cast("int"))  # one order for all rows, cents before size
    materials = facts.select(F.col("material_abbreviation").alias("material_table"), "section", "property_name", "value", *[F.lit("").alias(c) for c in ("unit", "english", "comments")], "_ord")
    template = spark.createDataFrame(_TEMPLATE, "_ord long, `My Section` string, `Property name` string")
    got = reconcile.reconcile(template, materials, letter_counts, long_name)
    return got.select("material_table", "tpl_row", F.col("Matched Property").alias("matched"), F.col("Value").alias("value"))


@query("""WITH q AS (SELECT vec_id AS query_id, embedding FROM embeddings WHERE vec_id % 50 = 0),
r AS (SELECT query_id, e.vec_id AS id, e.label, row_number() OVER (PARTITION BY query_id ORDER BY list_sum(list_transform(range(1, 65), lambda i: pow(q.embedding[i]::DOUBLE - e.embedding[i]::DOUBLE, 2))), e.vec_id) AS rank FROM q, embeddings e)
SELECT query_id, id, label, rank FROM r WHERE rank <= 5""")
def retrieve_items(spark, sf_dir):
    """The nearest items of every vector whose id 50 divides, without their embeddings."""
    e = table(spark, sf_dir, "embeddings")
    asks = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return retrieve.retrieve(asks, e.select(F.col("vec_id").alias("id"), "embedding", "label")).select("query_id", "id", "label", "rank")


@query("SELECT vec_id, round(list_sum(list_transform(range(1, 65), lambda i: pow(embedding[i]::DOUBLE - embedding[65 - i]::DOUBLE, 2))), 6) AS d2, round(list_cosine_similarity(embedding::DOUBLE[], list_reverse(embedding)::DOUBLE[]), 6) AS sim FROM embeddings")
def vector_measures(spark, sf_dir):
    back = F.reverse("embedding")
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(squared_distance(F.col("embedding"), back), 6).alias("d2"), F.round(cosine(F.col("embedding"), back), 6).alias("sim"))


@query(f"SELECT p_partkey, list_transform({_sql_letters('p_name')}, lambda x: CAST(x AS FLOAT)) AS embedding FROM part")
def embed_names(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", extractors.embed(F.col("p_name"), letter_counts).alias("embedding"))


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 2 THEN 'image' ELSE 'text' END AS kind, CASE WHEN n_nationkey % 3 != 2 THEN n_name END AS context_text FROM nation")
def context_parts(spark, sf_dir):
    kind = F.get(F.array(F.lit("text"), F.lit("table"), F.lit("image")), F.col("n_nationkey") % 3)
    items = table(spark, sf_dir, "nation").select("n_nationkey", kind.alias("type"), F.col("n_name").alias("text"), F.lit(None).cast("binary").alias("image"))
    return retrieve.context_parts(items).select("n_nationkey", "kind", "context_text")


@query("SELECT 'who' || chr(10) || string_agg(n_name, chr(10) ORDER BY n_nationkey) AS answer FROM nation WHERE n_regionkey = 1")
def answer(spark, sf_dir):
    """An answer of the injected generator from five matched items."""
    matched = table(spark, sf_dir, "nation").where("n_regionkey = 1").select(F.lit("text").alias("type"), F.col("n_name").alias("text"), F.lit(None).cast("binary").alias("image"), F.col("n_nationkey").alias("rank"))
    return spark.createDataFrame([(retrieve.answer("who", matched, plugins.listing),)], "answer string")


# --- boxes and pixels ------------------------------------------------------------------------------------------
_BOX = "CAST(p_partkey % 900 AS INTEGER) AS x, CAST(p_partkey % 700 AS INTEGER) AS y, CAST(p_size * 12 AS INTEGER) AS w, CAST(p_partkey % 41 * 11 AS INTEGER) AS h"


@query(f"""WITH b AS (SELECT p_partkey, {_BOX} FROM part)
SELECT p_partkey, CAST(trunc(x * (300 / 72.0::DOUBLE)) AS INTEGER) AS px, (w * h) / (1000.0 * 800) > 0.03 AND (w * h) / (1000.0 * 800) < 0.8 AS good, w >= 220 AND h >= 180 AS large,
  greatest(0, x - 30) AS pad_x0, greatest(0, y - 30) AS pad_y0, least(1000, x + w + 30) AS pad_x1, least(800, y + h + 30) AS pad_y1,
  CASE WHEN least(1000, x + w) > least(x, 1000) AND least(800, y + h) > y THEN least(1000, x + w) END AS crop_x1,
  greatest(0, CAST(trunc(x - w * 0.10::DOUBLE) AS INTEGER)) AS grown_x0, least(800, CAST(trunc(y + h + h * 0.18::DOUBLE) AS INTEGER)) AS grown_y1,
  greatest(0, y - 760) AS top, least(800, y + h + 160) AS bottom, CASE WHEN w > 8 AND h > 8 THEN w - 2 ELSE w END AS trim_x1,
  y < 800 AND x < 1000 AND x <= 950 AND y >= 40 AS crosses FROM b""")
def box_arithmetic(spark, sf_dir):
    made = table(spark, sf_dir, "part").selectExpr("p_partkey", "cast(p_partkey % 900 as int) AS x", "cast(p_partkey % 700 as int) AS y", "cast(p_size * 12 as int) AS w", "cast(p_partkey % 41 * 11 as int) AS h")
    x, y, w, h, pw, ph = F.col("x"), F.col("y"), F.col("w"), F.col("h"), F.lit(1000), F.lit(800)
    pad, grown, region = boxes.padded(x, y, w, h, pw, ph), boxes.grown(x, y, x + w, y + h, pw, ph), boxes.search_region(y, y + h, ph)
    return made.select(
        "p_partkey", boxes.to_pixels(x).alias("px"), boxes.good_share(w, h, pw, ph).alias("good"), boxes.large_enough(w, h).alias("large"), *[pad[c].alias(f"pad_{c}") for c in ("x0", "y0", "x1", "y1")],
        boxes.safe_crop(x + w, y, x, y + h, pw, ph)["x1"].alias("crop_x1"), grown["x0"].alias("grown_x0"), grown["y1"].alias("grown_y1"), region["top"].alias("top"), region["bottom"].alias("bottom"),
        boxes.trimmed(w, h)["x1"].alias("trim_x1"), boxes.axes_cross(y, x, pw, ph).alias("crosses"),
    )


@query("""WITH c AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey) - 1 AS ord FROM part)
SELECT p_brand AS caption_id, arg_min(p_partkey, ord) AS box, max(p_size) AS area FROM c WHERE ord < 35 AND p_partkey % 7 = 0 GROUP BY p_brand""")
def best_plot(spark, sf_dir):
    """The largest accepted one of the first 35 candidates of each caption."""
    part = table(spark, sf_dir, "part")
    ranked = search.numbered_by(part.withColumn("_size", -F.col("p_size")), ["p_brand"], ["_size", "p_partkey"], "ord")
    tried = ranked.select(F.lit("d").alias("doc_id"), F.col("p_brand").alias("caption_id"), "ord", F.col("p_size").alias("area"), (F.col("p_partkey") % 7 == 0).alias("accepted"), F.col("p_partkey").alias("box"))
    return figures.best_plot(tried).select("caption_id", "box", "area")


def _drawn(kind: str) -> callable:
    """Pages made from a number, so that what they measure follows from it."""

    def draw(n: int) -> np.ndarray:
        if kind == "strip":  # n + 60 colours at the right edge
            image = np.full((160, 260, 3), 255, np.uint8)
            for k in range(n + 60):
                image[k, -18:] = (24 * (k % 10), 24 * (k // 10), 0)
            return image
        if kind == "blocks":  # n blocks, the k-th k + 5 pixels wide
            image = np.full((20, 1200, 3), 255, np.uint8)
            for k in range(n):
                image[2:8, 45 * k : 45 * k + k + 5] = 0
            return image
        image = np.zeros((8, 9), np.uint8)  # falls n times in each row, then rises
        image[:] = [200 - 10 * k if k <= min(n, 8) else 200 - 10 * min(n, 8) + 5 * (k - min(n, 8)) for k in range(9)]
        return image

    return draw


def _pages(spark, sf_dir, kind: str) -> DataFrame:
    draw = _drawn(kind)

    def run(batches):
        for batch in batches:
            yield pd.DataFrame({"n": batch["n"], "png": [pixels.encode_png(draw(n)) for n in batch["n"]]})

    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("n")).mapInPandas(run, "n int, png binary")


def _measure(png, kind: str, fn):
    return F.pandas_udf(lambda x: pd.Series([fn(pixels.decode_png(bytes(v))) for v in x]), kind)(png)


@query("SELECT n_nationkey AS n, n_nationkey + 60 + 1 AS colours, n_nationkey + 61 > 70 AS strip FROM nation")
def colours_of_strips(spark, sf_dir):
    png = F.col("png")
    return _pages(spark, sf_dir, "strip").select("n", _measure(png, "int", lambda i: pixels.colour_count(i[:, -18:], 24)).alias("colours"), _measure(png, "boolean", pixels.colour_strip).alias("strip"))


@query("SELECT n_nationkey AS n, n_nationkey AS parts, CASE WHEN n_nationkey > 0 THEN 6 * (n_nationkey + 4) END AS largest FROM nation")
def parts_of_pages(spark, sf_dir):
    """How many connected parts a page has, and the area of the first when they are sorted by it."""
    parts = F.pandas_udf(lambda x: pd.Series([[a for a, *_ in sorted(pixels.components(pixels.gray(pixels.decode_png(bytes(v))) < 245)[1], reverse=True)] for v in x]), "array<long>")
    return _pages(spark, sf_dir, "blocks").select("n", parts("png").alias("areas")).select("n", F.size("areas").alias("parts"), F.get("areas", F.lit(0)).cast("int").alias("largest"))


@query("SELECT n_nationkey AS n, CAST(list_sum(list_transform(range(64), lambda i: CASE WHEN i % 8 < least(n_nationkey, 8) THEN CAST(1 AS HUGEINT) << CAST(63 - i AS INTEGER) ELSE 0 END)) - CASE WHEN n_nationkey > 0 THEN CAST(1 AS HUGEINT) << 64 ELSE 0 END AS BIGINT) AS dhash FROM nation")
def hashes_of_images(spark, sf_dir):
    """The difference hash of decoded images, whose rows fall a known number of times."""
    levels = pixels.thumbnail_levels(F.col("png"))
    return _pages(spark, sf_dir, "rows").withColumn("levels", levels).select("n", boxes.difference_bits(F.col("levels"), 9).alias("dhash"))


@query("""SELECT p_partkey, CASE WHEN trim(p_name) = '' THEN NULL ELSE regexp_replace(trim(p_name), '\\s+', ' ', 'g') END AS squashed, substr(p_name, 1, 6) AS part FROM part""")
def squash_and_slice(spark, sf_dir):
    messy = F.concat(F.lit(" \t"), F.replace("p_name", F.lit(" "), F.lit(" \n ")), F.lit(" "))
    return table(spark, sf_dir, "part").select("p_partkey", F.nullif(text.squash(messy), F.lit("")).alias("squashed"), F.substring("p_name", 1, 6).alias("part"))
