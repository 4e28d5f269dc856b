import sqlite3

import duckdb
import pytest
from pyspark.sql import functions as F

from alloyframe import plugins, schema
from alloyframe.functions import pixels
from alloyframe.operators import figures, ingest, order, plots, reconcile, retrieve, search
from alloyframe.plans import queries as plans
from alloyframe.sources import extractors, sinks, tables
from alloyframe.streaming import ingest as streams

DATA = "/root/testdata/sf0.001"


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_same_as_sql(spark, oracle, name):
    df = plans.queries()[name](spark, DATA)
    con = oracle.execute(plans.oracle_sql()[name])
    names = [d[0] for d in con.description]
    assert sorted(names) == sorted(df.columns)
    key = lambda r: tuple(round(v, 6) if isinstance(v, float) else v for v in r)
    assert sorted(map(repr, (key(r) for r in df.select(names).collect()))) == sorted(map(repr, map(key, con.fetchall())))


def test_taxonomy(spark):
    t = schema.taxonomy(spark)
    assert (t.count(), t.select("material_class", "section").distinct().count(), t.select("material_class").distinct().count()) == (46, 16, 3)


def test_csv_nulls_and_uploads(spark, tmp_path):
    (tmp_path / "Polymers.csv").write_text("material_abbreviation,material_name,section,property_name,value,more\nPP,Polyprop,Thermal,Tm,N/A,x\nPP,,Thermal,Tm,na,nan\n")
    base = tables.read_class(spark, str(tmp_path), "Polymers")
    assert rows(base.select("material_name", "value", "more", "material_class"), "_ord") == [("Polyprop", None, "x", "Polymer"), (None, "na", None, "Polymer")]
    store = str(tmp_path / "uploads")
    assert tables.read_uploads(spark, store).isEmpty()
    form = spark.createDataFrame([("Polymer", "PP", "Thermal", "Tm", "N/A", "e")], "material_class string, material_abbreviation string, section string, property_name string, value string, english_units string")
    sinks.append_uploads(form, store, "form")
    sinks.append_uploads(form, store, "form", once_by="material_abbreviation")
    both = search.union_uploads(base, tables.read_uploads(spark, store), "Polymer")
    assert both.count() == 3 and rows(search.search(both, "PP", "Tm").select("value"), "value") == [("N/A",), ("na",)]
    with pytest.raises(ValueError):
        search.search(both, "PP", "")


def test_extraction(spark):
    doc = '{"material_name":"isotactic polypropylene","material_abbreviation":"","mechanical_properties":[{"value":""},{"section":"Thermal","property_name":"Tm","value":"165"}]}'
    files = spark.createDataFrame([("/a/my doc.pdf", f"junk {doc}".encode()), ("/a/none.pdf", b"no json")], "path string, content binary")
    answers = extractors.extract_answers(files, plugins.embedded_json)
    got = ingest.extract_rows(ingest.parse_answers(answers))
    assert rows(got.select("doc_id", "material_abbreviation", "section", "property_name", "value", "unit"), "_ord") == [("my_doc", "IP", "Mechanical", "Unknown property", "N/A", ""), ("my_doc", "IP", "Thermal", "Tm", "165", "")]
    assert ingest.extract_rows_plain(ingest.parse_answers(answers)).count() == 2
    assert ingest.classify_rows(got, "Polymer").select("material_class").distinct().collect()[0][0] == "Polymer"
    with pytest.raises(ValueError):
        ingest.classify_rows(got, "Metal")


def test_nearest_caption(spark):
    box = spark.createDataFrame([("d", 1, 0, 0, 0, 10, 100, 1000, 1000), ("d", 1, 1, 0, 300, 10, 100, 1000, 1000)], "doc_id string, page int, ord int, x int, y int, w int, h int, page_w int, page_h int")
    block = spark.createDataFrame([("d", 1, i, 0.0, y, 0.0, 0.0, t) for i, (y, t) in enumerate([(100.0, "Fig 1"), (150.0, "Fig 2\nb"), (180.0, "Fig 3"), (400.0, "Fig 4"), (150.0, "Fig 5")])], "doc_id string, page int, ord int, x0 double, y0 double, x1 double, y1 double, text string")
    assert rows(figures.nearest_caption(box, block, dpi=72).select("ord", "caption"), "ord") == [(0, "Fig 2 b"), (1, "Figure on Page 1 (Unlabeled)")]


def test_nearest_caption_of_repeated_rows(spark):
    """Every box gives a row, repeated ones too, whatever other columns there are; level captions are not below."""
    box = spark.createDataFrame([("d", 1, 10, 90, 1000, "a"), ("d", 1, 10, 90, 1000, "a"), ("d", 2, 0, 10, 100, None), ("e", 1, 0, 10, 100, "c")], "doc_id string, page int, y int, h int, page_h int, `at` string")
    block = spark.createDataFrame([("d", 1, 0, 100.0, "Fig 1"), ("d", 1, 1, 399.0, "Fig 2"), ("d", 2, 0, 40.0, "Fig 3"), ("e", 1, 0, 39.9, "no caption")], "doc_id string, page int, ord int, y0 double, text string")
    assert rows(figures.nearest_caption(box, block, dpi=72).select("doc_id", "page", "at", "caption"), "doc_id", "page") == [
        ("d", 1, "a", "Fig 2"), ("d", 1, "a", "Fig 2"), ("d", 2, None, "Figure on Page 2 (Unlabeled)"), ("e", 1, "c", "Figure on Page 1 (Unlabeled)")
    ]


def test_numbers_in_order(spark):
    data = [(i % 3 if i % 5 else None, (i * 37) % 101, f"k{i}") for i in range(300)]
    df = spark.createDataFrame(data, "g int, v int, key string").repartition(5)
    got = {r.key: r.n for r in order.numbered_by(df, ["g"], ["v", "key"], "n", 1).collect()}
    for g in (0, 1, 2, None):
        own = sorted((v, k) for h, v, k in data if h == g)
        assert [got[k] for _, k in own] == list(range(1, len(own) + 1))
    assert [r.key for r in search.numbered(df, "v", "key", name="row").orderBy("row").collect()] == [k for _, k in sorted((v, k) for _, v, k in data)]
    assert search.numbered(df.limit(0), "v").count() == 0 and search.numbered(df.where("v is null").unionAll(df.limit(1)), "v").first().row == 0


def test_forms_and_images(spark, tmp_path):
    """A form row in, a document's rows with matched images in, and the store as the search then finds it."""
    store, folder = str(tmp_path / "store"), str(tmp_path / "images")
    form = [("Polymer", "Thermal", "Decomposition temperature", "poly one", "", "300"), ("Polymer", "Thermal", "Density", "poly one", "", "1"), ("Polymer", "Physical", "Density", "", "", "1")]
    n, bad = ingest.submit_form(spark.createDataFrame(form, "material_class string, section string, property_name string, material_name string, material_abbreviation string, value string"), store)
    assert n == 1 and {r.reason for r in bad.collect()} == {"not in the taxonomy", "material_name is empty"}
    facts = spark.createDataFrame([("d", 0, "PO", "Density", "1.1"), ("d", 1, "PO", "Tensile modulus", "3"), ("d", 2, "XX", "Density", "2")], "doc_id string, _ord long, material_abbreviation string, property_name string, value string")
    shape = "doc_id string, ord int, caption string, image_data array<struct<filename:string,bytes:binary>>"
    figs = spark.createDataFrame([("d", 0, "Fig 1 nothing", [("a.png", b"0")]), ("d", 1, "Fig 2 specific gravity", [("b.png", b"1"), ("c.png", b"2")]), ("d", 2, "Fig 3 Young", [("e.png", b"3")]), ("d", 3, "Fig 4 density", [("f.png", b"4")])], shape)
    links = ingest.ingest(facts, "Polymer", store, figs, folder)
    assert rows(links.select("property_name", "caption", "image_path"), "property_name") == [("Density", "Fig 2 specific gravity", "images/PO_Density.png"), ("Tensile modulus", "Fig 3 Young", "images/PO_Tensile modulus.png")]
    assert (tmp_path / "images" / "PO_Density.png").read_bytes() == b"1"
    every = tables.read_uploads(spark, store)
    assert every.count() == 4 and rows(search.search(every, "PO", "Density", links).select("value", "image_path")) == [("1.1", "images/PO_Density.png")]
    with pytest.raises(ValueError):
        ingest.ingest(facts, "Metal", store, figs, folder)
    assert tables.read_uploads(spark, store).count() == 4


def test_images_of_pages(spark):
    """From files to figures: rasters, injected boxes, containment, captions, crops."""
    import numpy as np

    page = np.full((400, 300, 3), 255, np.uint8)
    page[50:150, 50:150] = 10
    files = spark.createDataFrame([("/a/my doc.pdf", b"x")], "path string, content binary")
    pages = extractors.page_images(files, lambda content: [(n, pixels.encode_png(page)) for n in (1, 2)])
    assert rows(pages.select("doc_id", "page", "page_w", "page_h"), "page") == [("my_doc", 1, 300, 400), ("my_doc", 2, 300, 400)]
    block = spark.createDataFrame([("my_doc", 1, 0, 160.0, "Fig. 1\nStress")], "doc_id string, page int, ord int, y0 double, text string")
    got = figures.extract_images(pages, block, detector=lambda gray: [(50, 50, 100, 100), (60, 60, 50, 90), (0, 0, 5, 5)], dpi=72).collect()
    assert {(r.caption, r.page, tuple(i.filename for i in r.image_data)) for r in got} == {("Fig. 1 Stress", 1, ("pg1_50_50.png",)), ("Figure on Page 2 (Unlabeled)", 2, ("pg2_50_50.png",))}
    image = pixels.decode_png(bytes(got[0].image_data[0].bytes))
    assert image.shape == (160, 160, 3) and (image[30:130, 30:130] == 10).all()
    assert figures.extract_images(pages, block).count() >= 0  # the engine's own detector


def test_json_and_text_files(spark, tmp_path):
    import json

    shape = "doc_id string, ord int, caption string, page int, image_data array<struct<filename:string,bytes:binary>>"
    figs = spark.createDataFrame([("d", 1, "é", 2, [("b.png", b"1")]), ("d", 0, "a", 1, [])], shape)
    got = sinks.document_json(figs, lambda f: sinks.metadata_json(f, True), "ord").first().json
    assert got == json.dumps([{"caption": "a", "page": 1, "image_count": 0, "images": []}, {"caption": "é", "page": 2, "image_count": 1, "images": ["b.png"]}], indent=4)
    kept = spark.createDataFrame([("d", 0, "é", 2, "p02_0000.png")], "doc_id string, saved int, caption string, page int, filename string")
    assert sinks.document_json(kept, sinks.plots_json, "saved").first().json == '[\n  {\n    "page": 2,\n    "caption": "é",\n    "image": "p02_0000.png"\n  }\n]'
    texts = spark.createDataFrame([("d", 1, 0, "a | b")], "doc_id string, page int, table_idx int, text string")
    assert [r.filename for r in sinks.write_table_texts(texts, str(tmp_path)).collect()] == ["d_table_1_0.txt"] and (tmp_path / "d_table_1_0.txt").read_text() == "a | b"
    cells = extractors.page_tables(spark.createDataFrame([("/a/t.pdf", b"x")], "path string, content binary"), lambda c: [(0, [["h"], ["v"]])], first_page=0)
    assert {(r.page, r.cell) for r in cells.collect()} == {(1, "h"), (1, "v")}


def test_nearest_with_ties_and_blocks(spark, monkeypatch):
    import numpy as np

    r = np.random.default_rng(4)
    vectors = r.integers(0, 3, (300, 4)).astype(float)  # many equal distances
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)] + [(999, None)], "id long, embedding array<float>").repartition(6)
    asks = spark.createDataFrame([(i, vectors[i].tolist()) for i in range(0, 300, 50)], "query_id long, embedding array<float>")
    want = sorted((q, i, float(((vectors[q] - vectors[i]) ** 2).sum()), n + 1) for q in range(0, 300, 50) for n, i in enumerate(sorted(range(300), key=lambda i: (((vectors[q] - vectors[i]) ** 2).sum(), i))[:5]))
    assert rows(retrieve.nearest(asks, items), "query_id", "id") == sorted(want, key=lambda x: x[:2])
    monkeypatch.setattr(retrieve, "MOST_NUMBERS", 8)
    monkeypatch.setattr(retrieve, "BLOCK_ITEMS", 7)
    assert rows(retrieve.nearest(asks, items), "query_id", "id") == sorted(want, key=lambda x: x[:2])
    assert retrieve.nearest(asks.limit(0), items).count() == 0 and retrieve.nearest(asks, items.limit(0)).count() == 0


def test_context(spark):
    items = spark.createDataFrame([("text", "t", b"1", 1), ("image", "t", b"2", 2), (None, None, b"3", 3), ("table", "u", None, 4)], "type string, text string, image binary, rank int")
    seen = []
    retrieve.answer("why", items, lambda prompt, parts: seen.extend(parts) or "")
    assert [next(iter(p)) for p in seen] == ["text", "image", "image", "text"] and seen[1]["image"]["bytes"] == b"2"


def test_match_and_group(spark):
    figs = spark.createDataFrame([("d", i, f"Fig {i} {t}", ["x"] * n) for i, (t, n) in enumerate([("density", 1), ("density", 0), ("density and gravity", 1)])], "doc_id string, ord int, caption string, image_data array<string>")
    props = spark.createDataFrame([("d", 0, "Density"), ("d", 1, "Density ratio"), ("d", 2, "Density")], "doc_id string, ord int, property_name string")
    assert rows(figures.match_captions(figs, props).select("caption", "property_name"), "caption") == [("Fig 0 density", "Density"), ("Fig 2 density and gravity", "Density ratio")]
    images = spark.createDataFrame([("d", 2, 0, "c", "a.png", b"1"), ("d", 5, 1, "c", "b.png", b"2")], "doc_id string, page int, ord int, caption string, filename string, bytes binary")
    one = figures.grouped_figures(images)
    got = one.collect()[0]
    assert got.page == 5 and [i.filename for i in got.image_data] == ["a.png", "b.png"]
    assert sinks.figure_archives(one, True).collect()[0].archive[:2] == b"PK"
    gone = spark.createDataFrame([("d", "c", "a.png")], "doc_id string, caption string, filename string")
    assert [i.filename for i in ingest.without_removed(one, gone).collect()[0].image_data] == ["b.png"]
    hashes = spark.createDataFrame([("d", i, 1, h) for i, h in enumerate([7, 8, 7])], "doc_id string, ord int, page int, dhash long")
    assert rows(figures.first_of_equal_hashes(hashes).select("ord", "filename"), "ord") == [(0, "p01_0000.png"), (1, "p01_0001.png")]


def test_plots(spark):
    import numpy as np

    from tests.test_functions import drawn_plot

    page = np.full((1100, 900, 3), 255, np.uint8)
    page[200:600, 200:700] = drawn_plot()
    pages = spark.createDataFrame([("d", p, pixels.encode_png(page), 900, 1100) for p in (1, 2)], "doc_id string, page int, png binary, page_w int, page_h int")
    y = 700 * 72 / 300
    block = spark.createDataFrame([("d", p, 0, 0.0, y, 10.0, y + 5, "Fig. 1 Stress") for p in (1, 2)], "doc_id string, page int, ord int, x0 double, y0 double, x1 double, y1 double, text string")
    got = plots.extract_plots(pages, block, True).collect()
    assert len(got) <= 1 and all(r.filename == "p01_0000.png" for r in got)


def test_reconcile(spark, tmp_path):
    path = str(tmp_path / "m.db")
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE steel (section TEXT, property_name TEXT, value TEXT, unit TEXT, english TEXT, comments TEXT)")
        db.executemany("INSERT INTO steel VALUES (?,?,?,?,?,?)", [("Physical", "density", "7.8", "g", "", ""), ("Physical", "density", "9", "g", "", ""), ("physical", " mass", "1", "", "", ""), ("Physical", "Modulus tensile", "200", "GPa", "", "")])
    materials = tables.read_sqlite(spark, path)
    template = spark.createDataFrame([(0, " PHYSICAL ", " Density "), (1, "Physical", "mass"), (2, "Physical", "tensile modulus"), (3, "Physical", "none")], "_ord long, `The Section` string, `A property` string")
    got = reconcile.reconcile(template, materials, plugins.hashed_words, plugins.same_words)
    assert rows(got.select("tpl_row", "Matched Property", "Value"), "tpl_row") == [(0, "density", "7.8"), (1, " mass", "1"), (2, "Modulus tensile", "200"), (3, None, None)]
    sinks.write_sheets(got, str(tmp_path / "sheets"))


def test_retrieve(spark):
    cells = spark.createDataFrame([("d", 1, 0, r, c, v) for r, line in enumerate([("h1", "h2"), ("a", None), ("c", "d")]) for c, v in enumerate(line)], "doc_id string, page int, table_idx int, row_idx int, col_idx int, cell string")
    items = retrieve.table_items(cells)
    assert items.collect()[0].text == "a | nan\nc | d"
    assert rows(retrieve.promote_header(cells).where("row_idx = 1").select("col_name", "cell"), "col_idx") == [("h1", "a"), ("h2", None)]
    e = extractors.embed_items(items, plugins.hashed_words).withColumn("id", F.lit(1))
    q = e.select(F.lit(0).alias("query_id"), "embedding")
    found = retrieve.retrieve(q, e)
    assert found.collect()[0].d2 == 0.0 and "embedding" not in found.columns
    assert retrieve.answer("why", found, plugins.listing).startswith("why\na | nan")


def test_stream(spark, tmp_path):
    src, store = tmp_path / "in", str(tmp_path / "store")
    src.mkdir()
    inner = '{\\"material_name\\":\\"m x\\",\\"mechanical_properties\\":[{\\"value\\":\\"1\\"}]}'
    line = '{"doc_id":"a","at":"2024-01-01T00:00:00Z","answer":' + '"{\\"candidates\\":[{\\"content\\":{\\"parts\\":[{\\"text\\":\\"' + inner.replace("\\", "\\\\\\") + '\\"}]}}]}"}'
    (src / "1.json").write_text(line + "\n" + line + "\n")
    streams.stream_rows(spark, str(src), store, str(tmp_path / "cp"), "Polymer").awaitTermination(120)
    assert rows(tables.read_uploads(spark, store).select("material_abbreviation", "value", "material_class")) == [("MX", "1", "Polymer")]
