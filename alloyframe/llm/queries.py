"""The registered queries of the corpus operators, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alloyframe.llm import bpe_prefix, decontamination, golay_simhash, language_mixture, license_diagonals, line_frequency, prefix_free_dedup, token_rollups, toxicity_cnn, zip_warc
from alloyframe.llm.common import held_out, scratch, stage, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"), 4, 2)
    model = language_mixture.train(docs.where(~out))
    return language_mixture.predict(docs, model).select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op2_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five batches over all documents: two tokenizer versions in, one revised, copies deleted; two come twice."""
    t = token_rollups
    patterns = t.TOKENIZERS | {"words-2": t.REVISED}
    docs = stage(t.measured(table(spark, sf_dir, "documents"), patterns), "counts")
    rollup = t.TokenRollup(spark, scratch(spark, "rollup"))
    revision = t.revised(docs, "words-1", "words-1", "words-2")
    copies = t.later_copies(docs)
    rollup.apply("words", t.counted(docs, "words-1"))
    rollup.apply("pieces", t.counted(docs, "pieces-1"))
    rollup.apply("revision", revision)
    rollup.apply("copies/words", t.counted(copies, "words-1", "words-2", -1))
    rollup.apply("copies/pieces", t.counted(copies, "pieces-1", sign=-1))
    rollup.apply("revision", revision)
    rollup.compact()
    rollup.apply("words", t.counted(docs, "words-1"))
    return rollup.totals()


OP2_SQL = r"""
WITH kept AS (
  SELECT source, lang, coalesce(text, '') AS text FROM documents
  QUALIFY row_number() OVER (PARTITION BY text IS NULL, text ORDER BY doc_id) = 1 OR text IS NULL
)
SELECT source, lang, tokenizer, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens FROM (
  SELECT source, lang, 'words-1' AS tokenizer, len(regexp_extract_all(text, '[^\x20\x09-\x0D]*[A-Za-z0-9][^\x20\x09-\x0D]*')) AS n FROM kept
  UNION ALL
  SELECT source, lang, 'pieces-1', len(regexp_extract_all(text, '[A-Za-z]+|[0-9]|[^\x20\x09-\x0DA-Za-z0-9]+')) FROM kept
) GROUP BY ALL
"""


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "item_id", "score", "first_word", "last_word")


def op4_zip_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = zip_warc.archive_pages(table(spark, sf_dir, "pages"))
    return got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP4_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS hex, max(page_id) OVER (PARTITION BY html) AS largest FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS INTEGER), 5) AS BIGINT) >> CAST(15 - i % 4 * 5 AS BIGINT)) & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id != largest THEN largest END AS refers_to
FROM h
"""


def op5_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = golay_simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_prefix_free_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_free_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_diagonals.license_labels(table(spark, sf_dir, "documents"))


def _op7_sql() -> str:
    d = license_diagonals
    values = lambda rows: ", ".join("('" + "', '".join(x.replace("'", "''") for x in r) + "')" for r in rows)
    cut = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {cut} AS w FROM documents),
pos AS (SELECT r, w, unnest(range(len(w))) AS p FROM docs),
phrase AS (SELECT string_split(phrase, ' ') AS q, label FROM (VALUES {values(d.PHRASES)}) AS v(phrase, label)),
place AS (SELECT r, p, label FROM pos JOIN phrase ON w[p + 1] = q[1] AND w[p + 1 : p + len(q)] = q),
base AS (SELECT r, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word, list_sort(list(DISTINCT label)) AS own FROM place GROUP BY r),
template AS (SELECT label, {cut} AS q FROM (VALUES {values(d.TEMPLATES)}) AS v(label, text)),
gram AS (SELECT label, len(q) - {d.K} + 1 AS grams, t, array_to_string(q[t + 1 : t + {d.K}], ' ') AS g FROM (SELECT label, q, unnest(range(len(q) - {d.K} + 1)) AS t FROM template)),
hit AS (SELECT r, label, grams, p, t, p - t AS diagonal FROM (SELECT r, p, array_to_string(w[p + 1 : p + {d.K}], ' ') AS g FROM pos WHERE p + {d.K} <= len(w)) JOIN gram USING (g)),
vote AS (SELECT r, label, grams, diagonal, list(DISTINCT t) AS ts, min(p) AS low, max(p) AS high FROM hit GROUP BY r, label, grams, diagonal),
step AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY r, label ORDER BY diagonal) <= {d.BAND} THEN 0 ELSE 1 END AS new FROM vote),
span AS (SELECT *, sum(new) OVER (PARTITION BY r, label ORDER BY diagonal) AS span FROM step),
merged AS (SELECT r, label, grams, len(list_distinct(flatten(list(ts)))) AS votes, min(low) AS low, max(high) AS high FROM span GROUP BY r, label, grams, span),
judged AS (SELECT r, label, CAST(votes AS DOUBLE) / grams AS cover,
  100 * votes >= {d.COVER_PERCENT} * grams AND 100 * (high + {d.K} - low) <= {d.LENGTH_PERCENT} * (grams + {d.K} - 1) AS ok FROM merged),
found AS (SELECT r, list(DISTINCT label) FILTER (ok) AS more, max(cover) FILTER (ok) AS sure, max(cover) AS best FROM judged GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(array_to_string(own, ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(own, []), coalesce(more, [])))), ','), '') AS labels,
  CAST(coalesce(sure, CASE WHEN n_base > 0 THEN 0.5 END, best / 2, 0) AS DOUBLE) AS score
FROM docs LEFT JOIN base USING (r) LEFT JOIN found USING (r)
"""


def op8_bpe_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_prefix.encode_documents(table(spark, sf_dir, "documents"))


def op9_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_cnn.train_and_score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_words"]
    return line_frequency.line_rules(table(spark, sf_dir, "documents")).select(names)


OP10_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
words AS (SELECT doc_id, host, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d),
lines AS (
  SELECT doc_id, host, i, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
    regexp_replace(trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g'), ' '), '[0-9]', '0', 'g') AS norm
  FROM (SELECT doc_id, host, generate_subscripts(s, 1) AS i, unnest(s) AS line FROM (SELECT doc_id, host, string_split(text, chr(10)) AS s FROM d))
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY doc_id),
tri AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS times FROM (
    SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words))
),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM tri, (SELECT unnest([0, 1, 2]) AS k) WHERE times > 1 GROUP BY doc_id),
contents AS (SELECT host, text, min(doc_id) AS doc_id FROM d GROUP BY 1, 2),
held AS (SELECT l.host, l.norm, count(DISTINCT c.doc_id) AS n, min(c.doc_id) AS first_doc FROM contents c JOIN lines l USING (doc_id) GROUP BY 1, 2),
frequent AS (SELECT * FROM held WHERE n > 20),
lost AS (SELECT l.doc_id, sum(l.n) AS lost_words FROM lines l JOIN frequent f ON l.host = f.host AND l.norm = f.norm WHERE l.doc_id != f.first_doc GROUP BY 1),
every AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(lost_words, 0) AS BIGINT) AS lost_words
  FROM words LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN lost USING (doc_id)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * lost_words <= 50 * n_words AS kept
FROM every
"""


def queries() -> dict[str, Query]:
    return {
        "op1_language_mixture": op1_language_mixture,
        "op2_token_rollups": op2_token_rollups,
        "op3_decontamination": op3_decontamination,
        "op4_zip_archives": op4_zip_archives,
        "op5_golay_simhash": op5_golay_simhash,
        "op6_prefix_free_dedup": op6_prefix_free_dedup,
        "op7_license_diagonals": op7_license_diagonals,
        "op8_bpe_prefix": op8_bpe_prefix,
        "op9_toxicity_cnn": op9_toxicity_cnn,
        "op10_line_frequency": op10_line_frequency,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_token_rollups": OP2_SQL, "op4_zip_archives": OP4_SQL, "op7_license_diagonals": _op7_sql(), "op10_line_frequency": OP10_SQL}
