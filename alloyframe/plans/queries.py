"""Queries that exercise each operator on the driver's tables, with the SQL that says the same.

The tables hold no materials, so parts stand in for them: brand as abbreviation, name as name, type as section, size
and price as two properties.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alloyframe.functions import boxes, classify, text
from alloyframe.functions.json import envelope_text, extraction
from alloyframe.operators import figures, ingest, reconcile, retrieve, search
from alloyframe.plans.registry import QUERIES, SQL, Query, query, table
from alloyframe.sources.sinks import image_link

def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    both = F.explode(F.array(F.struct(F.lit("size").alias("k"), F.col("p_size").cast("string").alias("v")), F.struct(F.lit("cents").alias("k"), F.round(F.col("p_retailprice") * 100).cast("long").cast("string").alias("v"))))
    named = part.select(F.col("p_brand").alias("material_abbreviation"), F.col("p_name").alias("material_name"), F.col("p_type").alias("section"), F.col("p_partkey").alias("_ord"), both.alias("x"))
    return named.select("material_abbreviation", "material_name", "section", F.col("x.k").alias("property_name"), F.col("x.v").alias("value"), "_ord")


_FACTS = """facts AS (
  SELECT p_brand AS material_abbreviation, p_name AS material_name, p_type AS section, 'size' AS property_name, CAST(p_size AS VARCHAR) AS value, p_partkey AS _ord FROM part
  UNION ALL SELECT p_brand, p_name, p_type, 'cents', CAST(CAST(round(p_retailprice * 100) AS BIGINT) AS VARCHAR), p_partkey FROM part)"""


@query(f"WITH {_FACTS} SELECT material_abbreviation, material_name, section, property_name, value, _ord FROM facts WHERE material_abbreviation = 'Brand#12' AND property_name = 'size' AND value IS NOT NULL")
def search_material_property(spark, sf_dir):
    return search.search(_facts(spark, sf_dir), "Brand#12", "size").select("material_abbreviation", "material_name", "section", "property_name", "value", "_ord")


@query(f"WITH {_FACTS} SELECT coalesce(material_abbreviation, '') AS material_abbreviation, coalesce(material_name, '') AS material_name, min(_ord) AS _ord FROM facts GROUP BY 1, 2")
def material_list(spark, sf_dir):
    return search.material_list(_facts(spark, sf_dir)).select("material_abbreviation", "material_name", "_ord")


_KEYS = (("ring", "Ring"), ("hot", "Hot"), ("red ring", "Never"), ("small", "Small"), ("o", "Other"))
_CASE = "CASE " + " ".join(f"WHEN contains(lower(p_name), '{k}') THEN '{v}'" for k, v in _KEYS) + " END"


@query(f"SELECT p_partkey, {_CASE} AS label FROM part")
def classify_first_match(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", classify.first_match(F.col("p_name"), _KEYS).alias("label"))


@query(f"SELECT DISTINCT {_CASE} AS label FROM part WHERE {_CASE} IS NOT NULL")
def facet_options(spark, sf_dir):
    return search.facet_options(classify_first_match(spark, sf_dir), "label")


@query(f"SELECT p_partkey, label AS matrix, p_type AS fiber FROM (SELECT *, {_CASE} AS label FROM part) WHERE label = 'Ring'")
def filter_materials_all_sentinel(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", classify.first_match(F.col("p_name"), _KEYS).alias("matrix"), F.col("p_type").alias("fiber"))
    return search.filter_materials(rows, "Composite", "Ring", search.ALL)


@query(f"WITH {_FACTS}, o AS (SELECT section, min(_ord) AS _ord FROM facts WHERE material_abbreviation = 'Brand#12' AND section IS NOT NULL GROUP BY section) SELECT section, row_number() OVER (ORDER BY _ord) - 1 AS row FROM o")
def section_options(spark, sf_dir):
    return search.numbered(search.list_sections(_facts(spark, sf_dir), "Brand#12"), "_ord").select("section", "row")


@query(f"WITH {_FACTS} SELECT property_name, section, min(_ord) AS _ord FROM facts WHERE section = (SELECT min(p_type) FROM part) GROUP BY 1, 2")
def section_properties(spark, sf_dir):
    first = table(spark, sf_dir, "part").agg(F.min("p_type")).first()[0]
    return search.list_properties(_facts(spark, sf_dir), first).select("property_name", "section", "_ord")


@query("SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, NULL::VARCHAR AS material_class FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, 'S' FROM supplier")
def union_by_name_nullfill(spark, sf_dir):
    a = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.lit("S").alias("material_class"))
    return search.union_uploads(a, b, "S")


@query("SELECT event_id, event_type AS label, CASE event_type WHEN 'purchase' THEN 'Composite' WHEN 'click' THEN 'Fiber' END AS material_class FROM events")
def class_lookup_join(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("label"))
    return search.class_of_label(rows, {"purchase": "Composite", "click": "Fiber"}).select("event_id", "label", "material_class")


def _forms(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select(
        "p_partkey", F.when(F.col("p_partkey") % 3 == 0, "Polymer").otherwise("Fiber").alias("material_class"), F.when(F.col("p_partkey") % 2 == 0, "Thermal").otherwise("Physical").alias("section"),
        F.when(F.col("p_size") > 25, "Density").otherwise("Decomposition temperature").alias("property_name"), F.when(F.col("p_partkey") % 7 != 0, F.col("p_name")).otherwise("").alias("material_name"),
        F.lit("").alias("material_abbreviation"), F.col("p_size").cast("string").alias("value"),
    )


_FORMS = """f AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'Polymer' ELSE 'Fiber' END AS c, p_partkey % 2 = 0 AS thermal, p_size > 25 AS density, p_partkey % 7 != 0 AS named, p_name FROM part),
j AS (SELECT *, CASE WHEN NOT named THEN 'material_name is empty' WHEN thermal = density THEN 'not in the taxonomy' END AS reason FROM f)"""


@query(f"WITH {_FORMS} SELECT p_partkey, upper(array_to_string(list_transform(string_split(p_name, ' '), lambda w: w[1]), '')) AS material_abbreviation FROM j WHERE reason IS NULL")
def taxonomy_valid(spark, sf_dir):
    return ingest.split_form(_forms(spark, sf_dir))[0].select("p_partkey", "material_abbreviation")


@query(f"WITH {_FORMS} SELECT p_partkey, reason FROM j WHERE reason IS NOT NULL")
def taxonomy_reject(spark, sf_dir):
    return ingest.split_form(_forms(spark, sf_dir))[1].select("p_partkey", "reason")


@query("SELECT p_partkey, upper(array_to_string(list_transform(string_split(p_name, ' '), lambda w: w[1]), '')) AS abbreviation FROM part")
def abbreviation(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", text.abbreviation(F.col("p_name")).alias("abbreviation"))


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 OR p_size % 3 = 1 THEN 'N/A' ELSE p_name END AS value FROM part")
def default_if_blank(spark, sf_dir):
    blank = F.when(F.col("p_size") % 3 == 0, "").when(F.col("p_size") % 3 == 2, F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", text.or_default(blank, "N/A").alias("value"))


@query("""SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, CASE WHEN l_returnflag = 'A' THEN '' ELSE l_returnflag END) - 1 AS _ord, 'O' AS material_abbreviation, 'Mechanical' AS section,
  CASE WHEN l_returnflag = 'A' THEN 'Unknown property' ELSE l_returnflag END AS property_name, CAST(l_linenumber AS VARCHAR) AS value FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def explode_extraction(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.struct(F.col("l_linenumber").alias("n"), F.when(F.col("l_returnflag") != "A", F.col("l_returnflag")).otherwise("").alias("property_name"), F.col("l_linenumber").cast("string").alias("value")).alias("x"))
    docs = lines.groupBy("l_orderkey").agg(F.transform(F.sort_array(F.collect_list("x")), lambda x: F.struct(x["property_name"].alias("property_name"), x["value"].alias("value"))).alias("p"))
    docs = table(spark, sf_dir, "orders").select("o_orderkey").join(docs, F.col("o_orderkey") == F.col("l_orderkey"))
    inner = F.to_json(F.struct(F.lit("order").alias("material_name"), F.lit("").alias("material_abbreviation"), F.col("p").alias("mechanical_properties")))
    answer = F.to_json(F.struct(F.array(F.struct(F.struct(F.array(F.struct(F.lit("thinking").alias("text")), F.struct(F.concat(F.lit("\n "), inner).alias("text"))).alias("parts")).alias("content"))).alias("candidates")))
    rows = ingest.extract_rows(ingest.parse_answers(docs.select(F.col("o_orderkey").alias("doc_id"), answer.alias("answer"))))
    return rows.select(F.col("doc_id").alias("o_orderkey"), "_ord", "material_abbreviation", "section", "property_name", "value")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("SELECT event_id, '{\"k\":' || CAST(json_extract(props, '$.k') AS VARCHAR) || '}' AS doc, event_id % 2 = 0 AS parsed FROM events")
def json_envelope(spark, sf_dir):
    """Answers whose second part holds the document; those of odd events hold broken JSON."""
    k = F.from_json("props", "k bigint")["k"].cast("string")
    doc = F.concat(F.lit('{"k":'), k, F.lit("}"))
    sent = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"material_name":"m","k":'), k, F.lit("}"))).otherwise(F.lit('{"material_name": '))
    rows = table(spark, sf_dir, "events").select("event_id", doc.alias("doc"), F.to_json(F.struct(F.array(F.struct(F.struct(F.array(F.struct(F.lit("x").alias("text")), F.struct(sent.alias("text"))).alias("parts")).alias("content"))).alias("candidates"))).alias("answer"))
    return rows.select("event_id", "doc", extraction(envelope_text(F.col("answer"))).isNotNull().alias("parsed"))


_CAPTION = "CASE p_partkey % 6 WHEN 0 THEN 'Fig. ' || p_size || ' x' WHEN 1 THEN 'FIGURE ' || p_size || ': y' WHEN 2 THEN 'Figs ' || p_size WHEN 3 THEN 'Fig' || p_size || 'a' WHEN 4 THEN '  Fig' || chr(10) || p_size ELSE 'see Fig 1' END"


@query(f"SELECT p_partkey, regexp_matches(trim(regexp_replace({_CAPTION}, '\\s+', ' ', 'g')), '^(Fig\\.?\\s*\\d+|Figure\\s*\\d+)\\b', 'i') AS is_caption FROM part")
def caption_regex(spark, sf_dir):
    n = F.col("p_size").cast("string")
    made = [F.concat(F.lit("Fig. "), n, F.lit(" x")), F.concat(F.lit("FIGURE "), n, F.lit(": y")), F.concat(F.lit("Figs "), n), F.concat(F.lit("Fig"), n, F.lit("a")), F.concat(F.lit("  Fig\n"), n), F.lit("see Fig 1")]
    return table(spark, sf_dir, "part").select("p_partkey", text.is_caption(text.squash(F.get(F.array(*made), (F.col("p_partkey") % 6).cast("int")))).alias("is_caption"))


_WORDS = (("ring", ("rod", "hot")), ("large", ("small",)))


@query("""SELECT a.p_partkey, w.name, contains(lower(p_name), lower(name)) OR (contains(lower(name), 'ring') AND (contains(lower(p_name), 'rod') OR contains(lower(p_name), 'hot'))) OR (contains(lower(name), 'large') AND contains(lower(p_name), 'small'))
  OR len(list_filter(list_intersect(string_split(lower(p_name), ' '), string_split(lower(name), ' ')), lambda x: x NOT IN ('the', 'of', 'at', 'in', 'a', 'an'))) >= 2 AS fits
  FROM part a, (VALUES ('Ring'), ('large bolt'), ('rod hot'), ('a of')) AS w(name)""")
def caption_property_match(spark, sf_dir):
    names = spark.createDataFrame([("Ring",), ("large bolt",), ("rod hot",), ("a of",)], "name string")
    pairs = table(spark, sf_dir, "part").crossJoin(F.broadcast(names))  # four names
    return pairs.select("p_partkey", "name", text.caption_fits(F.col("p_name"), F.col("name"), _WORDS).alias("fits"))


@query("""WITH RECURSIVE l AS (SELECT l_orderkey AS doc, l_linenumber AS n, 'Fig ' || l_linenumber || ' ' || l_returnflag || ' ' || l_linestatus AS cap, l_returnflag || ' ' || l_linestatus AS prop FROM lineitem),
f AS (SELECT doc, cap, row_number() OVER (PARTITION BY doc ORDER BY n, cap) AS i FROM l),
p AS (SELECT doc, list(prop ORDER BY n, prop) AS props FROM (SELECT doc, prop, min(n) AS n FROM l GROUP BY doc, prop) GROUP BY doc),
s AS (
  SELECT doc, CAST(0 AS BIGINT) AS i, CAST([] AS VARCHAR[]) AS taken, CAST(NULL AS VARCHAR) AS cap, CAST(NULL AS VARCHAR) AS hit FROM p
  UNION ALL
  SELECT doc, i, CASE WHEN hit IS NULL THEN taken ELSE list_append(taken, hit) END, cap, hit FROM (
    SELECT f.doc, f.i, s.taken, f.cap, list_filter(props, lambda x: NOT list_contains(taken, x) AND (contains(lower(f.cap), lower(x))
      OR len(list_filter(list_intersect(string_split(lower(f.cap), ' '), string_split(lower(x), ' ')), lambda w: w NOT IN ('the', 'of', 'at', 'in', 'a', 'an'))) >= 2))[1] AS hit
    FROM s JOIN f ON f.doc = s.doc AND f.i = s.i + 1 JOIN p ON p.doc = s.doc))
SELECT doc AS doc_id, cap AS caption, hit AS property_name FROM s WHERE hit IS NOT NULL""")
def greedy_match(spark, sf_dir):
    """Orders' lines as captions, their flags and states as properties, matched one to one in order."""
    lines = table(spark, sf_dir, "lineitem").withColumn("doc_id", F.col("l_orderkey"))
    figs = lines.select("doc_id", F.col("l_linenumber").alias("ord"), F.concat_ws(" ", F.lit("Fig"), F.col("l_linenumber").cast("string"), "l_returnflag", "l_linestatus").alias("caption"), F.array(F.lit("x")).alias("image_data"))
    props = lines.select("doc_id", F.col("l_linenumber").alias("ord"), F.concat_ws(" ", "l_returnflag", "l_linestatus").alias("property_name"))
    return figures.match_captions(figs, props)


@query("""WITH e AS (SELECT * FROM events WHERE event_type = 'error'), p AS (SELECT * FROM events WHERE event_type = 'purchase')
SELECT e.event_id, coalesce((SELECT 'Fig ' || arg_min(p.event_id, (epoch_us(p.ts) - epoch_us(e.ts), p.event_id)) FROM p WHERE p.user_id = e.user_id AND epoch_us(p.ts) > epoch_us(e.ts) AND epoch_us(p.ts) - epoch_us(e.ts) < 86400000000), 'Figure on Page ' || e.user_id || ' (Unlabeled)') AS caption FROM e""")
def nearest_following(spark, sf_dir):
    """Errors as boxes and purchases as captions below them on the page of their user, a day apart at most."""
    events = table(spark, sf_dir, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp")) if dict(events.dtypes)["ts"] == "timestamp" else F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts"))
    rows = events.select("event_id", "event_type", F.lit("d").alias("doc_id"), F.col("user_id").alias("page"), micros.alias("us"))
    # whole numbers up to 2^53 are exact in double precision, which captions' places have
    marks = rows.where("event_type = 'error'").select("event_id", "doc_id", "page", F.col("us").alias("y"), F.lit(0).alias("h"), F.lit(288_000_000_000).alias("page_h"))
    caps = rows.where("event_type = 'purchase'").select("doc_id", "page", F.col("us").alias("y0"), F.col("event_id").alias("ord"), F.concat(F.lit("Fig "), F.col("event_id").cast("string")).alias("text"))
    return figures.nearest_caption(marks, caps, dpi=72).select("event_id", "caption")


@query("""SELECT source AS caption, arg_max(n_chars, doc_id) AS page, array_to_string(list_transform(list(doc_id ORDER BY doc_id), lambda x: CAST(x AS VARCHAR)), ',') AS files, count(*) AS image_count FROM documents GROUP BY source""")
def group_figures(spark, sf_dir):
    images = table(spark, sf_dir, "documents").select(F.lit("d").alias("doc_id"), F.col("n_chars").alias("page"), F.col("doc_id").alias("ord"), F.col("source").alias("caption"), F.col("doc_id").cast("string").alias("filename"), F.lit(None).cast("binary").alias("bytes"))
    got = figures.grouped_figures(images)
    return got.select("caption", "page", F.array_join(F.transform("image_data", lambda i: i["filename"]), ",").alias("files"), F.size("image_data").cast("long").alias("image_count"))


@query("""WITH RECURSIVE b AS (SELECT p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY -(p_size * (p_partkey % 60)), p_partkey) AS i,
  {'x': CAST(p_partkey % 50 AS INTEGER), 'y': CAST(p_partkey % 30 AS INTEGER), 'w': p_size, 'h': CAST(p_partkey % 60 AS INTEGER), 'ord': p_partkey} AS b FROM part),
s AS (
  SELECT p_brand, i, [b] AS kept FROM b WHERE i = 1
  UNION ALL
  SELECT b.p_brand, b.i, CASE WHEN len(list_filter(kept, lambda k: b.b.x >= k.x - 15 AND b.b.y >= k.y - 15 AND b.b.x + b.b.w <= k.x + k.w + 15 AND b.b.y + b.b.h <= k.y + k.h + 15)) > 0 THEN kept ELSE list_append(kept, b.b) END
  FROM s JOIN b ON b.p_brand = s.p_brand AND b.i = s.i + 1),
k AS (SELECT p_brand, unnest(arg_max(kept, i)) AS k FROM s GROUP BY p_brand)
SELECT p_brand, k.ord, k.x, k.y, k.w, k.h FROM k""")
def suppress_contained(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    made = part.groupBy("p_brand").agg(F.collect_list(F.struct((F.col("p_partkey") % 50).cast("int").alias("x"), (F.col("p_partkey") % 30).cast("int").alias("y"), F.col("p_size").alias("w"), (F.col("p_partkey") % 60).cast("int").alias("h"), F.col("p_partkey").alias("ord"))).alias("b"))
    return made.select("p_brand", F.inline(boxes.suppress_contained(F.col("b")))).select("p_brand", "ord", "x", "y", "w", "h")


@query("""WITH f AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source, md5(text) ORDER BY doc_id) AS n FROM documents)
SELECT doc_id, printf('p%02d_%04d.png', 1, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) AS filename FROM f WHERE n = 1""")
def first_wins_dedupe(spark, sf_dir):
    plots = table(spark, sf_dir, "documents").select(F.col("source").alias("doc_id"), F.col("doc_id").alias("ord"), F.lit(1).alias("page"), F.md5("text").alias("dhash"))
    return figures.first_of_equal_hashes(plots).select(F.col("ord").alias("doc_id"), "filename")


@query(f"WITH {_FACTS} SELECT _ord, facts.property_name, CASE WHEN facts.property_name = 'size' AND material_abbreviation < 'Brand#3' THEN 'images/' || replace(material_abbreviation, '/', '_') || '_size.png' END AS image_path FROM facts")
def link_image_left_join(spark, sf_dir):
    facts = _facts(spark, sf_dir)
    links = facts.where("property_name = 'size' and material_abbreviation < 'Brand#3'").select("material_abbreviation", "property_name").distinct()
    links = links.withColumn("image_path", image_link(F.col("material_abbreviation"), F.col("property_name")))
    return search.with_images(facts, links).select("_ord", "property_name", "image_path")


_TEMPLATE = ((0, " ECONOMY ", " SIZE "), (1, "standard", "cents"), (2, "Promo", "weight"), (3, "PROMO", "Cents"))


@query(f"""WITH {_FACTS}, t(tpl_row, s, p) AS (VALUES {", ".join(map(str, _TEMPLATE))}),
m AS (SELECT DISTINCT material_abbreviation AS material_table FROM facts),
j AS (SELECT material_table, tpl_row, _ord, value, row_number() OVER (PARTITION BY material_table, tpl_row ORDER BY _ord) AS n FROM m CROSS JOIN t LEFT JOIN facts f ON f.material_abbreviation = material_table AND lower(f.section) = lower(trim(s)) AND lower(f.property_name) = lower(trim(p)))
SELECT material_table, tpl_row, value, _ord AS found_ord FROM j WHERE n = 1""")
def template_exact(spark, sf_dir):
    facts = _facts(spark, sf_dir).select(F.col("material_abbreviation").alias("material_table"), "section", "property_name", "value", *[F.lit("").alias(c) for c in ("unit", "english", "comments")], "_ord")
    template = spark.createDataFrame(_TEMPLATE, "_ord long, `My Section` string, `Property name` string")
    wanted = reconcile.for_every_table(reconcile.template_rows(template), facts)
    return reconcile.exact_matches(wanted, facts).select("material_table", F.col("tpl_row").cast("int").alias("tpl_row"), "found.value", F.col("found._ord").alias("found_ord"))


@query("""WITH d AS (SELECT q.vec_id AS query_id, e.vec_id AS id, pow(list_distance(q.embedding::DOUBLE[], e.embedding::DOUBLE[]), 2) AS d2 FROM embeddings q, embeddings e WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d2, id) AS rank FROM d) SELECT query_id, id, round(d2, 6) AS d2, rank FROM r WHERE rank <= 5""")
def knn_l2(spark, sf_dir):
    """The five nearest of every vector whose id 50 divides, among all vectors."""
    e = table(spark, sf_dir, "embeddings")
    asks = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return retrieve.nearest(asks, e.select(F.col("vec_id").alias("id"), "embedding")).select("query_id", "id", F.round("d2", 6).alias("d2"), "rank")


@query("SELECT count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'error') AS error, count(*) FILTER (event_type = 'purchase') AS purchase FROM events")
def type_counts(spark, sf_dir):
    return retrieve.type_counts(table(spark, sf_dir, "events").withColumnRenamed("event_type", "type"), ("click", "error", "purchase"))


@query("SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS seen FROM events")
def running_type_counter(spark, sf_dir):
    return retrieve.running_counts(table(spark, sf_dir, "events"), "event_type", "event_id").select("event_id", "seen")


@query("""SELECT CAST(n_regionkey AS BIGINT) AS page, string_agg(n_name || ' | ' || CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE 'nan' END, chr(10) ORDER BY n_nationkey) AS text FROM nation GROUP BY n_regionkey""")
def table_to_text(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    cell = F.explode(F.array(F.struct(F.lit(0).alias("c"), F.col("n_name").alias("v")), F.struct(F.lit(1).alias("c"), F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).alias("v"))))
    cells = nation.select(F.lit("d").alias("doc_id"), F.col("n_regionkey").cast("long").alias("page"), F.lit(0).alias("table_idx"), (F.col("n_nationkey") + 1).alias("row_idx"), cell.alias("x"))
    return retrieve.table_text(cells.select("doc_id", "page", "table_idx", "row_idx", F.col("x.c").alias("col_idx"), F.col("x.v").alias("cell"))).select("page", "text")


@query("""SELECT p_partkey AS _ord, field, value FROM (UNPIVOT (SELECT p_partkey, p_brand, p_name, CAST(p_size AS VARCHAR) AS p_size FROM part) ON p_brand, p_name, p_size INTO NAME field VALUE value)""")
def transpose_result(spark, sf_dir):
    return search.transposed(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("_ord"), "p_brand", "p_name", "p_size"))


@query("""SELECT doc_id, c AS chunk, c * 500 AS start, substr(text, CAST(c * 500 + 1 AS INTEGER), 700) AS text FROM (SELECT doc_id, text, unnest(generate_series(0, greatest(0, CAST(ceil((length(text) - 700) / 500.0) AS BIGINT)))) AS c FROM documents WHERE length(text) > 0)""")
def chunk_text(spark, sf_dir):
    return retrieve.chunks(table(spark, sf_dir, "documents")).select("doc_id", "chunk", "start", "text")


@query("""SELECT vec_id, list_reduce(list_prepend(0::BIGINT, list_transform(range(1, 64), lambda i: CAST(embedding[i] > embedding[i + 1] AS BIGINT))), lambda a, b: a * 2 + b) AS bits FROM embeddings""")
def dhash_bits(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", boxes.difference_bits(F.col("embedding"), 64).alias("bits"))


@query("""SELECT page_id, replace(regexp_extract(url, '([^/]+?)(\\.[^./]*)?$', 1), ' ', '_') AS paper_id FROM pages""")
def file_stem(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.file_stem(F.col("url")).alias("paper_id"))


@query("""WITH i AS (SELECT source, doc_id FROM documents WHERE source != 'src3' AND n_chars >= 300) SELECT source AS caption, count(*) AS images, min(doc_id) AS first_image FROM i GROUP BY source""")
def tombstone_remove(spark, sf_dir):
    """Figures by source without the one of src3 and without images of less than 300 characters."""
    docs = table(spark, sf_dir, "documents")
    images = docs.select(F.lit("d").alias("doc_id"), F.col("n_chars").alias("page"), F.col("doc_id").alias("ord"), F.col("source").alias("caption"), F.col("doc_id").cast("string").alias("filename"), F.lit(None).cast("binary").alias("bytes"))
    gone = images.where("page < 300").select("doc_id", "caption", "filename").unionAll(images.where("caption = 'src3'").select("doc_id", "caption", F.lit(None).cast("string")).distinct())
    left = ingest.without_removed(figures.grouped_figures(images), gone)
    return left.select("caption", F.size("image_data").cast("long").alias("images"), F.array_min(F.transform("image_data", lambda i: i["filename"].cast("long"))).alias("first_image"))


def queries() -> dict[str, Query]:
    from alloyframe.plans import pipelines  # noqa: F401  registers its own

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from alloyframe.plans import pipelines  # noqa: F401

    return dict(SQL)
