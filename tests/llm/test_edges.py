"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing extra columns."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from alloyframe.llm import (
    bpe_prefix, decontamination, golay_simhash, language_mixture, license_diagonals, line_frequency, prefix_free_dedup, token_rollups, toxicity_cnn, zip_warc,
)
from alloyframe.llm.common import components, in_class_sample, scratch

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h long, key string, label string, words int, slice int, fp string, rid long"
LONG = "lorem ipsum dolor sit amet " * 20_000
ROWS = [
    (1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "en", "a"), (4, "MIT License", "en", None), (5, LONG, "en", "a"), (6, LONG, None, "a"), (6, LONG, None, "a"), (None, "no id here", "fr", "b"), (7, "x" * 300_000, "fr", "b"),
    (8, "日本語のテキスト " * 30, "ja", "b"), (9, "12 34 !!", "en", "c"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, lang, s, len(t or ""), 1, "k", "l", 1, 1, "f", 2) for i, t, lang, s in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_line_rules(docs, empty):
    got = line_frequency.line_rules(docs)
    assert got.count() == len(ROWS) and by_id(got)[1].base_failed and by_id(got)[1].n_words == 0 and by_id(got)[5].n_words == 100_000
    assert line_frequency.line_rules(empty).count() == 0
    assert line_frequency.keep_documents(docs).columns == docs.columns


def test_frequent_lines(spark):
    name = lambda n: "".join(chr(97 + int(c)) for c in str(n))  # noqa: E731  digits would be normalised
    own = lambda i: "\n".join(" ".join(f"w{name(i)}x{name(k)}x{name(j)}" for j in range(20)) for k in range(4))
    shared = "the same line of many words " + " ".join(f"s{name(j)}" for j in range(100))
    rows = [(i, own(i) + "\n" + shared, "h") for i in range(30)] + [(100 + i, own(100 + i), "h") for i in range(5)] + [(200 + i, own(0) + "\n" + shared, "h") for i in range(40)]
    got = by_id(line_frequency.line_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")))
    assert got[0].kept and not got[1].kept and got[1].lost_words == 106 and got[100].kept
    few = spark.createDataFrame(rows[:1] + rows[35:], "doc_id long, text string, source string")
    assert all(r.kept for r in line_frequency.line_rules(few).collect())  # copies alone make no line frequent


def test_frequent_lines_go(spark, monkeypatch):
    name = lambda n: "".join(chr(97 + int(c)) for c in str(n))  # noqa: E731  digits would be normalised
    own = lambda i: [" ".join(f"w{name(i)}x{name(k)}x{name(j)}" for j in range(20)) for k in range(4)]
    rows = [(i, "\n".join([*own(i), "", f"Read  on, page {i:02}", "the end"]), "h", 5, None) for i in range(30)]
    rows += [(50, "\n".join([*own(50), "the end"]), "other", 5, "é"), (None, "\n".join([*own(60), "The End"]), "h", 5, None), (3, rows[3][1], "h", 5, "x"), (70, "the end", "h", 5, None), (71, None, "h", 5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int, `rid` string").repartition(3)
    got = sorted(map(tuple, line_frequency.keep_documents(docs).collect()), key=repr)
    monkeypatch.setattr(line_frequency, "FREQUENT_LINES", 0)  # more lines than every worker could have
    assert sorted(map(tuple, line_frequency.keep_documents(docs).collect()), key=repr) == got
    less = lambda i: "\n".join([*own(i), ""])
    want = [rows[0], *((i, less(i), "h", len(less(i)), None) for i in range(1, 30)), rows[30], (None, "\n".join(own(60)), "h", len("\n".join(own(60))), None), (3, less(3), "h", len(less(3)), "x")]
    assert got == sorted(want, key=repr)


def test_frequent_lines_of_a_large_host(spark):
    name = lambda n: "".join(chr(97 + int(c)) for c in str(n))  # noqa: E731  digits would be normalised
    shared = "the same line " + " ".join(f"s{name(j)}" for j in range(97))
    held = [(i, " ".join(f"w{name(i)}x{name(j)}" for j in range(60)) + "\n" + shared) for i in range(21)]
    docs = spark.createDataFrame([(i, t, "h") for i, t in held + [(100 + i, f"clean {name(i)}") for i in range(10_600)]], "doc_id long, text string, source string")
    got = by_id(line_frequency.line_rules(docs).where("doc_id < 100"))
    assert {i for i in got if got[i].kept} == {0} and {got[i].lost_words for i in range(1, 21)} == {100}


def test_stubs_of_a_template_count_each(spark):
    name = lambda n: "".join(chr(97 + int(c)) for c in str(n))  # noqa: E731  digits would be normalised
    stub = " ".join(f"s{name(j)}" for j in range(100))
    docs = spark.createDataFrame([(i, f"{stub}\nNumber {10 + i}", "digits") for i in range(25)] + [(100 + i, stub + " " * i, "spaces") for i in range(25)] + [(200, stub, "copies")] * 25, "doc_id long, text string, source string")
    got = line_frequency.line_rules(docs)
    assert {r.doc_id for r in got.where("kept").collect()} == {0, 100, 200}


def test_repeat_words():
    def plain(words):
        seen = {}
        for i in range(len(words) - 2):
            seen.setdefault(tuple(words[i : i + 3]), []).append(i)
        return len({i + k for v in seen.values() if len(v) > 1 for i in v for k in range(3)})

    for text in (b"", b"a b c", b"a a a a", b"a b c d a b c", b"a b a b a b a", b"x y z w " * 9):
        assert line_frequency.repeat_words(text.split()) == plain(text.split())


def test_rollup(spark, docs, empty):
    t = token_rollups
    r = t.TokenRollup(spark, scratch(spark, "rollup"))
    rows = t.measured(docs, {"w": r"\S+"})
    assert r.totals().count() == 0
    delta = t.counted(rows, "w")
    assert r.apply("one", delta) and not r.apply("one", delta) and r.apply("none", t.counted(t.measured(empty, {"w": r"\S+"}), "w"))
    total = lambda: (r.totals().agg(F.sum("n_docs"), F.sum("n_tokens")).first())
    first = total()
    assert first[0] == len(ROWS)
    assert r.compact() and total() == first and not r.apply("one", delta)
    odd = ["a/b", "..", "a:b c", "é%2F", ""]
    assert all(r.apply(k, delta) for k in odd) and not any(r.apply(k, delta) for k in odd) and r.committed() == {"one", "none", *odd} and total()[0] == 6 * len(ROWS)
    for k in odd:
        r.apply(f"not {k}", t.counted(rows, "w", sign=-1))
    r.apply("back", t.counted(rows, "w", sign=-1))
    assert r.totals().count() == 0
    assert r.compact() and r.totals().count() == 0
    with pytest.raises(ValueError, match="characters"):
        r.apply("x" * 300, delta)
    assert sorted(x.doc_id for x in t.later_copies(rows).collect()) == [6, 6]
    assert [(x.doc_id, x.counts["b"]) for x in t.measured_by_bpe(docs, "b").where("doc_id in (1, 2, 4)").orderBy("doc_id").collect()][:2] == [(1, 0), (2, 0)]


def test_batches_that_land_during_a_compaction(spark, monkeypatch):
    t = token_rollups
    one = spark.createDataFrame([("s", "l", "w", 1, 5)], "source string, lang string, tokenizer string, sign int, n_tokens long")
    path = scratch(spark, "rollup")
    a, b = t.TokenRollup(spark, path), t.TokenRollup(spark, path)
    a.apply("1", one)
    a.apply("2", one)
    summed = a._summed

    def late(*of):
        b.apply("3", one)  # after the look at the folder
        return summed(*of)

    monkeypatch.setattr(a, "_summed", late)
    assert a.compact()
    assert [(r.n_docs, r.n_tokens) for r in b.totals().collect()] == [(3, 15)]
    state = b._state()
    monkeypatch.setattr(b, "_state", lambda: state)
    monkeypatch.setattr(a, "_summed", summed)
    assert a.compact() and not b.compact()  # the second of two compactions at once goes
    assert [(r.n_docs, r.n_tokens) for r in a.totals().collect()] == [(3, 15)]
    folder = a._attempt()
    one.write.parquet(folder)  # an attempt that broke off before its rename
    assert a.apply("4", one) and a.totals().first().n_docs == 4
    assert not a._commit(folder, "batches/id-4") and a.totals().first().n_docs == 4


def test_simhash(docs, empty):
    got = golay_simhash.near_duplicates(docs)
    assert got.count() == len(ROWS)
    found = by_id(got)
    assert found[1].fp == found[2].fp == found[3].fp == 0 and {found[i].component_id for i in (1, 2, 3)} == {1} and found[6].component_id == 5
    assert golay_simhash.near_duplicates(empty).count() == 0
    assert golay_simhash.keep_first(docs).columns == docs.columns


def test_repeats(docs, empty):
    cols = docs.select("doc_id", "text", "lang")
    got = prefix_free_dedup.remove_repeats(cols)
    found = by_id(got)
    assert got.count() == len(ROWS) and found[1].n_bytes == 0 and found[6].n_removed == found[6].n_bytes == len(LONG) and found[6].n_spans == 1 and found[5].n_removed == 0 and found[7].n_removed == 0
    assert prefix_free_dedup.remove_repeats(empty.select("doc_id", "text")).count() == 0
    assert prefix_free_dedup.remove_repeats(docs).columns == [c for c in docs.columns if c != "text"] + ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    clash = docs.select("doc_id", "text", F.lit("a").alias("n_bytes"), F.lit(2).alias("row"), F.lit("x").alias("kept text"), F.lit(1).alias("answers"), F.lit(1).alias("kept_text"))
    assert prefix_free_dedup.remove_repeats(clash).columns == ["doc_id", "row", "kept text", "answers", "kept_text", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert {r.n_bytes for r in prefix_free_dedup.keep_rest(clash).collect()} == {"a"} and prefix_free_dedup.keep_rest(clash).columns == clash.columns
    assert not [t for t in docs.sparkSession.catalog.listTables() if t.name.startswith("slices_")]
    kept = prefix_free_dedup.keep_rest(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [1, 2, 3, 4, 5, 7, 8, 9]


def test_decontamination(spark, docs, empty):
    items = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "two words", 1), (4, "lorem ipsum dolor sit amet lorem", 1), (4, "lorem ipsum dolor sit amet lorem", 2), (5, "nothing of this stands there", 1)], "item_id long, text string, doc_id int")
    got = decontamination.contaminated(docs, items)
    assert sorted((r.doc_id, r.item_id, r.score) for r in got.collect()) == [(5, 4, 1.0), (6, 4, 1.0)]
    assert decontamination.contaminated(empty, items).count() == 0 and decontamination.contaminated(docs, items.limit(0)).count() == 0
    assert decontamination.drop_contaminated(docs, items).columns == docs.columns


def test_licenses(docs, empty):
    got = license_diagonals.license_labels(docs)
    found = by_id(got)
    assert got.count() == len(ROWS) and found[1].n_words == 0 and found[1].labels == "" and found[4].base_labels == "mit" and found[4].first_word == 0 and found[4].score == 0.5 and found[5].n_words == 100_000
    assert license_diagonals.license_labels(empty).count() == 0


def test_codec(docs, empty):
    got = bpe_prefix.encode_documents(docs, ids=True)
    found = by_id(got)
    assert got.count() == len(ROWS) and found[1].n_tokens == 0 == found[2].n_tokens and len(found[5].ids) == found[5].n_tokens
    assert bpe_prefix.encode_documents(empty).count() == 0


def test_languages(docs, empty):
    model = language_mixture.train(docs)
    assert model.names == ("en", "fr", "ja")
    got = language_mixture.predict(docs, model)
    found = by_id(got)
    assert got.count() == len(ROWS) and all(0 <= r.score <= 1 for r in found.values())
    assert [found[i].lang_pred for i in (1, 2, 3, 9, 5, 8)] == ["und"] * 4 + ["en", "ja"]
    none = language_mixture.train(empty)
    assert none.names == () and {r.lang_pred for r in language_mixture.predict(docs, none).collect()} == {"und"}


def test_mixture_of_many(spark):
    r = random.Random(2)
    letters = ["abcdef", "ghijkl", "mnopqr", "stuvwx", "yzäöüß"]
    words = lambda k, n: " ".join("".join(r.choice(letters[k]) for _ in range(5)) for _ in range(n))
    model = language_mixture.train(spark.createDataFrame([(k, words(k, 3000), f"l{k}") for k in range(5)], "doc_id long, text string, lang string"))
    docs = spark.createDataFrame([(n, " ".join(words(k, 60) for k in range(n))) for n in range(1, 6)], "doc_id long, text string")
    got = by_id(language_mixture.predict(docs, model))
    assert all(set(got[n].mixture) == {f"l{k}" for k in range(n)} and max(abs(p - 1 / n) for p in got[n].mixture.values()) < 0.05 for n in got)


def test_toxicity(spark, docs, empty):
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 0), (6, 0, 0), (7, None, 0), (None, 1, 0), (4, 0, 0), (99, 1, 0)], "doc_id long, toxic int, text int")
    for some in (labels, labels.limit(0), labels.where("toxic = 0")):
        got = toxicity_cnn.score(docs, toxicity_cnn.train(docs, some))
        assert got.count() == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.collect())
    assert toxicity_cnn.train_and_score(empty, labels).count() == 0


def test_archives(spark):
    rows = [(1, None, None), (2, "u", ""), (3, "u\r\nX: y", "é" * 300_000), (4, "v", "same"), (9, "v", "same"), (7, None, "same"), (9, "v", "same"), (None, "w", "alone"), (None, "w", "same")]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, refers_to string, size int")
    got = zip_warc.archive_pages(pages).collect()
    assert sorted((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in got if r.page_id not in (4, 7, 1, None)) == [(2, 0, "response", None), (3, 600_000, "response", None), (9, 4, "response", None), (9, 4, "response", None)]
    assert sorted((r.page_id or 0, r.refers_to) for r in got if r.record_type == "revisit") == [(0, 9), (1, 2), (4, 9), (7, 9)]
    assert len(got) == len(rows) and [(r.record_type, r.payload_bytes) for r in got if r.page_id is None and r.refers_to is None] == [("response", 5)]
    assert {r.record_type for r in zip_warc.archive_pages(pages.where("length(html) = 4"), least_bytes=5).collect()} == {"response"}
    assert zip_warc.archive_pages(pages.limit(0)).count() == 0


def test_sample_of_a_large_class(spark):
    rows = spark.range(10_000_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 3, "rare").otherwise("large").alias("label"))
    n = {r[0]: r[1] for r in rows.where(in_class_sample(rows, "label", 4)).groupBy("label").count().collect()}
    assert n["rare"] == 3 and 1 <= n.get("large", 0) <= 12
    # the limit itself, for a share below 1e-7: the sample is drawn from the whole 63 bits
    one = spark.createDataFrame([(None, "a"), (1, None), (2, "b"), (3, "c"), (4, "c")], "doc_id long, label string")
    assert sorted(r.doc_id for r in one.where(in_class_sample(one, "label", 9, labels=1)).collect()) == [3, 4]
    assert one.where(in_class_sample(one.limit(0), "label", 9)).count() == 0


def test_thresholds():
    bins = toxicity_cnn.BINS
    counts = lambda *at: np.bincount(np.array(at, int), minlength=bins).astype(float)
    assert toxicity_cnn.best_threshold(counts(1, 2, 3), counts(7, 8)) == pytest.approx((4 + 7) / 2 * 60 / bins - 30)
    assert toxicity_cnn.best_threshold(counts(), counts(5)) == 0


def test_components(spark):
    pairs = [(5, 4), (4, 3), (3, 2), (9, 8), (7, 7), (5, 4), *((100 + i, 99) for i in range(50)), *((200 + i, 201 + i) for i in range(30))]
    got = dict(map(tuple, components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()))
    assert {got[i] for i in (3, 4, 5)} == {2} and got[9] == 8 and not {2, 7, 8} & set(got) and {got[i] for i in range(100, 150)} == {99} and {got[i] for i in range(201, 231)} == {200}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_pipeline_stages(spark, docs, empty):
    import corpus_pipeline

    data = "/root/testdata/sf0.001"
    for start in (docs, empty):
        kept = start
        for _, function in corpus_pipeline.STAGES[:-1]:
            kept = function(spark, kept, data).cache()
            assert kept.columns == docs.columns
        ids = sorted(r.doc_id for r in kept.where("doc_id is not null").collect())
        assert ids == ([] if start is empty else ids) and corpus_pipeline.STAGES[-1][1](spark, kept, data).count() == kept.count()
    assert not {None, 1} & {r.doc_id for r in corpus_pipeline.quality(spark, docs, data).collect()}  # too few words, with an id or not


def test_pipeline_rows_without_ids(spark):
    """Rows without a doc_id stand or fall by their text, as others do; columns of any name come along."""
    import corpus_pipeline

    data, r = "/root/testdata/sf0.001", random.Random(8)
    words = lambda n: " ".join("".join(r.choice("aeioulnrst") for _ in range(6)) for _ in range(n))
    a, b, item = words(80), words(80), spark.read.parquet(f"{data}/benchmark.parquet").first().text
    rows = [(1, a), (None, a), (None, b), (None, b), (None, "short"), (None, f"{words(60)} {item} {words(60)}"), (5, words(80))]
    names = "doc_id long, text string, lang string, source string, n_chars long, n_bytes string, `row` int, key int, host string, cut int, kept_text int, words int, `a b` int"
    docs = spark.createDataFrame([(i, t, "en", "s", len(t), "nb", 1, 2, "h", 3, 4, 5, 6) for i, t in rows], names)
    for _, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, data).cache()
    assert sorted(((x.doc_id or 0, x.text) for x in docs.collect())) == sorted([(1, a), (0, b), (0, b), (5, rows[6][1])])
    assert {tuple(x)[5:] for x in docs.collect()} == {("nb", 1, 2, "h", 3, 4, 5, 6)}
