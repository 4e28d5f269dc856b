"""Operators that SQL cannot express against plain versions, exact round trips and held-out labels."""

import hashlib
import io
import math
import random
import re
import string
import struct
import zipfile
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from alloyframe.llm import bpe_prefix, decontamination, golay_simhash, language_mixture, license_diagonals, prefix_free_dedup, queries, token_rollups, toxicity_cnn, zip_warc
from alloyframe.llm.common import scratch, table

DATA = "/root/testdata/sf0.001"


def texts():
    return dict(duckdb.connect().execute(f"SELECT doc_id, coalesce(text, '') FROM '{DATA}/documents.parquet'").fetchall())


def plain_rest(rows):
    """What is left of each document's bytes, and which bytes go."""
    first, out = {}, {}
    for i, data in sorted(rows):
        gone = bytearray(len(data))
        for k in range(len(data) - 49):
            if first.setdefault(data[k : k + 50], i) < i:
                gone[k : k + 50] = b"\1" * 50
        out[i] = bytes(x for x, g in zip(data, gone, strict=True) if not g), gone
    return out


def plain_repeats(rows):
    spans = lambda gone: sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
    return {i: (len(gone), sum(gone), spans(gone), hashlib.sha256(kept).hexdigest()) for i, (kept, gone) in plain_rest(rows).items()}


def test_repeats_of_documents(spark):
    want = plain_repeats([(i, t.encode()) for i, t in texts().items()])
    docs = table(spark, DATA, "documents").select("doc_id", "text").repartition(7)  # a slice for each partition
    got = {r.doc_id: tuple(r)[1:] for r in prefix_free_dedup.remove_repeats(docs).collect()}
    assert got == want


def test_repeats_of_random_texts(spark):
    r = random.Random(3)
    parts = ["".join(r.choice("abé") for _ in range(r.choice((5, 30, 49, 50, 51, 80, 200)))) for _ in range(40)]
    rows = [(i, "".join(r.choice(parts) for _ in range(r.randint(0, 8)))) for i in range(120)] + [(500 + i, "ab" * r.randint(20, 60)) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    got = {x.doc_id: tuple(x)[1:] for x in prefix_free_dedup.remove_repeats(docs).collect()}
    assert got == plain_repeats([(i, t.encode()) for i, t in rows])


def plain_components(ids, fp):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(fp ^ fp[i]) <= 4):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return {k: ids[find(i)] for i, k in enumerate(ids)}


def plain_fingerprint(text):
    import xxhash

    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    bits = 0
    for b in range(64):
        ones = sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles)
        bits |= (2 * ones > len(shingles)) << b
    return bits


def test_fingerprints_and_components(spark):
    own = texts()
    got = {r.doc_id: r for r in queries.op5_golay_simhash(spark, DATA).collect()}
    ids = sorted(own)
    fp = np.array([plain_fingerprint(own[i]) for i in ids], np.uint64)
    assert {i: got[i].fingerprint for i in ids} == {i: f"{int(x):016x}" for i, x in zip(ids, fp, strict=True)}
    assert {i: got[i].component_id for i in ids} == plain_components(ids, fp)


def test_links_lose_nothing(spark):
    r = np.random.default_rng(5)
    near = [r.integers(0, 2**63, dtype=np.int64)]
    for _ in range(400):  # a large group in which each differs from some other by four bits at most
        x = int(near[r.integers(len(near))])
        for b in r.choice(63, r.integers(1, 5), replace=False):
            x ^= 1 << int(b)
        near.append(np.int64(x))
    fp = np.unique(np.concatenate([np.array(near), r.integers(0, 2**63, 500, dtype=np.int64)]))
    row, key = golay_simhash.keys(fp)
    order = np.argsort(key, kind="stable")
    a, b = golay_simhash.links(key[order], fp[row][order])
    ids = fp.tolist()
    at = {x: i for i, x in enumerate(ids)}
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        assert (x ^ y).bit_count() <= 4
        p, q = find(at[x]), find(at[y])
        root[max(p, q)] = min(p, q)
    assert {i: ids[find(k)] for k, i in enumerate(ids)} == plain_components(ids, fp.view(np.uint64))


def test_golay_decoder():
    d = golay_simhash.decoder()
    assert (d >= 0).all() and (np.bincount(d) == 2048).all()


def encoding():
    path = public_tokenizers.path(bpe_prefix.VOCABULARY)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe_prefix.read_ranks(path), special_tokens={})


def test_tokens_as_the_library(spark):
    own, enc = texts(), encoding()
    for r in queries.op8_bpe_prefix(spark, DATA).collect():
        ids = enc.encode_ordinary(own[r.doc_id])
        data = np.array(ids, "<u4").tobytes()
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256(own[r.doc_id].encode()).hexdigest())


def test_rollup_of_the_encoder(spark):
    own, enc = texts(), encoding()
    docs = table(spark, DATA, "documents")
    r = token_rollups.TokenRollup(spark, scratch(spark, "rollup"))
    rows = token_rollups.measured_by_bpe(docs)
    assert r.apply("in", token_rollups.counted(rows, "bpe-1")) and not r.apply("in", token_rollups.counted(rows, "bpe-1"))
    assert r.totals().agg(F.sum("n_docs"), F.sum("n_tokens")).first() == (len(own), sum(len(enc.encode_ordinary(t)) for t in own.values()))


def test_tokens_of_odd_texts():
    enc, codec, r = encoding(), bpe_prefix.codec(public_tokenizers.path(bpe_prefix.VOCABULARY), public_tokenizers.PATTERN), random.Random(1)
    parts = ["a", "th", "ing", " ", "  ", "é", "ß", "你", "好", "\n", " \n", "\t", "😀", "1", "!", "'s", "'", "   ", "\x00", " ", " ", "<|endoftext|>"]
    for k in range(3000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 40)))
        assert codec.encode(text).tolist() == enc.encode_ordinary(text), (k, text)
        assert codec.decode(codec.encode(text)) == text.encode()


def test_appends_and_edits():
    bpe, r = bpe_prefix.codec(public_tokenizers.path(bpe_prefix.VOCABULARY), public_tokenizers.PATTERN).bpe, random.Random(2)
    some = lambda n: bytes(r.choice(b"thing aeo\xc3\xa9bcd") for _ in range(r.randint(0, n)))
    for _ in range(100):
        t = bpe.table(some(80))
        for _ in range(4):
            i = r.randint(0, len(t.data))
            j, new, more = r.randint(i, min(len(t.data), i + 9)), some(9), some(20)
            want = t.data[:i] + new + t.data[j:] + more
            t.edit(i, j, new)
            t.append(more)
            assert t.data == want and t.ids() == bpe.merge(want)
    long = bpe.table(b"the thing and other things " * 400)
    assert long.edit(500, 503, b"xyz") < 200


def test_planted_passages(spark):
    r = random.Random(4)
    vocabulary = ["".join(r.choice("aeioulnrst") for _ in range(r.randint(2, 7))) for _ in range(800)]
    text = lambda n: [r.choice(vocabulary) for _ in range(n)]
    items = {i: text(40) for i in range(20)}
    rows, want = [], set()
    for d in range(200):
        words = text(300)
        if d % 4 == 0:
            own = list(items[d % 20])
            if d % 8 == 0:  # an edited copy: words replaced, left out and put in
                for _ in range(6):
                    own[r.randrange(len(own))] = r.choice(vocabulary)
                del own[r.randrange(len(own))]
                own.insert(r.randrange(len(own)), r.choice(vocabulary))
            words[100:100] = own
            want.add((d, d % 20))
        rows.append((d, " ".join(words).capitalize() + "."))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = decontamination.contaminated(docs, spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")).collect()
    assert {(x.doc_id, x.item_id) for x in found} == want
    assert all(95 <= x.first_word <= 105 and 130 <= x.last_word <= 145 for x in found) and all(x.score == 1 for x in found if x.doc_id % 8)


def test_copies_with_regular_edits(spark):
    item = [f"w{chr(97 + k)}" for k in range(20)]
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    edited = {every: ["around", "it", *(f"x{every}y{k}" if k % every == every - 1 else w for k, w in enumerate(item)), "and", "after"] for every in (4, 5, 6)}
    common = [(1000 + i, " ".join(["common", *item[k : k + 3], "words"])) for i, k in enumerate([0, 8, 17] * 20)]
    for more in ([], [(100, " ".join(item))], [(100 + i, " ".join(item)) for i in range(50)], common):
        for some in ([4], [5], [6], [4, 5, 6]):
            docs = spark.createDataFrame([(k, " ".join(edited[k])) for k in some] + more, "doc_id long, text string")
            got = {r.doc_id: r.score for r in decontamination.contaminated(docs, items).collect()}
            assert set(got) == {*some, *(i for i, _ in more if i < 1000)}
            assert all(got[k] >= 0.65 for k in some)


def plain_contaminated(docs, items, how=decontamination.Alignment()):
    """Every item against every whole document that has three of its words in a row."""
    known, out = decontamination.WordHashes(), {}
    cut = {d: known.of(t.encode()) for d, t in docs.items()}
    for i, text in items.items():
        item = known.of(text.encode())
        grams = set(decontamination.trigram_hashes(item).tolist())
        for d, words in cut.items():
            if grams.intersection(decontamination.trigram_hashes(words).tolist()):
                score = decontamination.align(item, words, how)[0] / (how.match * len(item))
                if score >= how.least:
                    out[d, i] = score
    return out


def test_contamination_of_documents(spark):
    items = dict(duckdb.connect().execute(f"SELECT item_id, coalesce(text, '') FROM '{DATA}/benchmark.parquet'").fetchall())
    got = {(r.doc_id, r.item_id): r.score for r in queries.op3_decontamination(spark, DATA).collect()}
    assert got == plain_contaminated(texts(), items) and len(got) >= 3


def test_contamination_by_edits(spark, monkeypatch):
    """Random edits at several rates, and items that share a phrase: what is due and has a seed is found."""
    r = random.Random(9)
    vocabulary = ["".join(r.choice("aeioulnrst") for _ in range(r.randint(2, 7))) for _ in range(500)]
    text = lambda n: [r.choice(vocabulary) for _ in range(n)]
    phrase = text(6)
    items = {i: (phrase if i % 2 else []) + text(24) for i in range(30)}
    docs, rate_of = {}, {}
    for k, rate in enumerate((0.0, 0.1, 0.2, 0.3)):
        for i, words in items.items():
            own = []
            for w in words:
                own += r.choice([[r.choice(vocabulary)], [], [w, r.choice(vocabulary)]]) if r.random() < rate else [w]
            docs[100 * k + i], rate_of[100 * k + i] = " ".join(text(50) + own + text(50)), rate
    rows = spark.createDataFrame(sorted(docs.items()), "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    got = {(x.doc_id, x.item_id): x.score for x in decontamination.contaminated(rows, bench).collect()}
    assert got == plain_contaminated(docs, {i: " ".join(w) for i, w in items.items()})
    monkeypatch.setattr(decontamination, "MOST_WORDS", 0)  # more items than every worker could have, two of them equal
    more = bench.unionAll(spark.createDataFrame([(77, " ".join(items[3]))], "item_id long, text string"))
    again = {(x.doc_id, x.item_id): x.score for x in decontamination.contaminated(rows, more).collect()}
    assert again == got | {(d, 77): score for (d, i), score in got.items() if i == 3}
    found = {rate: np.mean([(d, d % 100) in got for d in docs if rate_of[d] == rate]) for rate in (0.0, 0.1, 0.2, 0.3)}
    assert found[0.0] == found[0.1] == 1 and found[0.2] >= 0.9


def test_alignment_against_a_plain_table():
    r, how = np.random.default_rng(1), decontamination.Alignment()
    for _ in range(30):
        a, b = r.integers(0, 5, r.integers(1, 12)), r.integers(0, 5, r.integers(1, 15))
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                h[i + 1, j + 1] = max(0, h[i, j] + (2 if a[i] == b[j] else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
        assert decontamination.align(a, b, how)[0] == h.max()


def test_edited_license(spark):
    grant = license_diagonals.TEMPLATES[10][1]
    docs = spark.createDataFrame([(1, "Hello. " + grant.replace("free of charge", "free of any charge") + " and more"), (2, "Permission is granted"), (3, grant[:60])], "doc_id long, text string")
    got = {r.doc_id: r for r in license_diagonals.license_labels(docs).collect()}
    assert got[1].labels == "mit-grant" and got[1].score > 0.6 and got[2].labels == got[3].labels == "" and got[1].base_labels == ""


def test_license_votes_by_row(spark):
    """Parts of a license are no license, however often the row or the part is repeated."""
    grant = license_diagonals.TEMPLATES[10][1]
    part = " ".join(grant.split()[:10])
    rows = [(1, part), (1, part), (1, part), (2, part), (3, f"{part} {part} {part}"), (4, part), (4, " ".join(grant.split()[9:])), (5, grant), (5, grant), (None, grant), (None, part), (6, "\u212aelvin " + grant.upper())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.n_words, r.labels, round(r.score, 3)) for r in license_diagonals.license_labels(docs).collect()]
    low = next(x[3] for x in got if x[0] == 2)
    assert sorted(x for x in got if x[0] in (1, 2)) == [(1, 10, "", low)] * 3 + [(2, 10, "", low)]
    assert {x[2] for x in got if x[0] in (3, 4)} == {""} and [x[2] for x in got if x[0] in (5, 6)] == ["mit-grant"] * 3
    assert sorted(x[2] for x in got if x[0] is None) == ["", "mit-grant"]


def test_whole_license_texts(spark):
    texts = dict(license_diagonals.TEXTS)
    edited = {k: " ".join(w for i, w in enumerate(t.split()) if i % 25 != 3) for k, t in texts.items()}
    docs = spark.createDataFrame([(i, f"Some words before. {t} And after.") for i, t in enumerate([*texts.values(), *edited.values()])], "doc_id long, text string")
    got = {r.doc_id: r.labels.split(",") for r in license_diagonals.license_labels(docs).collect()}
    assert all(name in got[i] and name in got[i + len(texts)] for i, name in enumerate(texts))


def test_languages_held_out(spark):
    lang = dict(duckdb.connect().execute(f"SELECT doc_id, lang FROM '{DATA}/documents.parquet'").fetchall())
    got = [r for r in queries.op1_language_mixture(spark, DATA).collect() if r.held_out]
    assert len(got) > 20 and np.mean([r.lang_pred == lang[r.doc_id] for r in got]) > 0.95


def test_mixture_of_two(spark):
    docs = table(spark, DATA, "documents")
    model = language_mixture.train(docs)
    own = {r.lang: r.text for r in docs.where("length(text) > 1500 and lang in ('en', 'de')").collect()}
    both = spark.createDataFrame([(1, own["en"][:1000] + " " + own["de"][:1000]), (2, own["en"])], "doc_id long, text string")
    got = {r.doc_id: r.mixture for r in language_mixture.predict(both, model).collect()}
    assert set(got[1]) == {"en", "de"} and all(0.25 < v < 0.75 for v in got[1].values()) and max(got[2], key=got[2].get) == "en" and got[2]["en"] > 0.85


def test_mixtures_against_plain_estimation(spark):
    """Proportions and sets by loops over words and languages, in double precision."""
    r = random.Random(12)
    docs = table(spark, DATA, "documents")
    model = language_mixture.train(docs)
    own = [x for x in texts().values() if len(x) > 300][:12]
    cases = own[:4] + [f"{own[4][:200]} {own[5][:300]}", f"{own[6][:150]} {own[7][:150]} {own[8][:400]}", "one", "a b"] + [" ".join(r.sample(own[9].split() + own[10].split(), 30))]
    share, count = model.infer(cases, slice_of=500)
    for text, got, n in zip(cases, share, count, strict=True):
        scores, _ = model.word_scores([text])
        assert n == len(scores)
        like = [[math.exp(float(x) - float(max(w))) for x in w] for w in scores]

        def estimate(start):
            for _ in range(language_mixture.ROUNDS):
                parts = [[p * x for p, x in zip(start, w, strict=True)] for w in like]  # noqa: B023
                start = [sum(w[j] / (sum(w) + 1e-30) for w in parts) / len(parts) for j in range(len(start))]
            return start, sum(math.log(sum(p * x for p, x in zip(start, w, strict=True)) + 1e-30) for w in like)  # noqa: B023

        k = len(model.names)
        alone = [sum(math.log(w[j] + 1e-300) for w in like) for j in range(k)]
        best, value = [float(j == max(range(k), key=alone.__getitem__)) for j in range(k)], max(alone)
        full, _ = estimate([1 / k] * k)
        order = sorted(range(k), key=lambda j: -full[j])
        penalty = language_mixture.PENALTY * 0.5 * math.log(max(n, 2))
        for size in range(2, k + 1):
            if -penalty * (size - 1) <= value or full[order[size - 1]] * n <= 0.5:
                break
            start = [full[j] + 1e-3 if j in order[:size] else 0 for j in range(k)]
            found, logs = estimate([x / sum(start) for x in start])
            if logs - penalty * (size - 1) > value:
                best, value = found, logs - penalty * (size - 1)
        assert np.abs(np.array(best) - got).max() < 2e-3, text[:40]


def test_network_against_loops(monkeypatch):
    r = np.random.default_rng(3)
    words = [f"w{i}" for i in range(40)]
    rows = toxicity_cnn.WordRows()
    cut = [rows.of(" ".join(r.choice(words, n)).encode()) for n in (0, 1, 2, 3, 17, 60)]
    m = toxicity_cnn.fit([cut[4], cut[5], cut[3], cut[4]] * 8, np.array([0, 1, 0, 1] * 8), epochs=1)
    monkeypatch.setattr(toxicity_cnn, "BLOCK", 7)
    for t in cut:
        x = [m.table[w >> toxicity_cnn.SHIFT] + m.table[w & toxicity_cnn.STEMS] for w in t]
        total = float(m.out_bias)
        for i, (span, w) in enumerate(zip(toxicity_cnn.SPANS, m.filters, strict=True)):
            for f in range(toxicity_cnn.FILTERS):
                c = i * toxicity_cnn.FILTERS + f
                values = [sum(float(x[p + k] @ w[k][:, f]) for k in range(span)) + float(m.bias[c]) for p in range(len(x) - span + 1)]
                total += max([0.0, *values]) * float(m.out[c])
        assert abs(m.logit(t) - total) < 1e-3


def test_toxicity_learns(spark):
    r = random.Random(6)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(600):
        words = [r.choice(vocabulary) for _ in range(60)]
        if i % 4 == 0:
            words[r.randrange(60)] = r.choice(["nasty", "vile", "awful"])
        rows.append((i, " ".join(words), "en", i, int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n int, toxic int")
    got = toxicity_cnn.train_and_score(docs.drop("toxic"), docs.select("doc_id", "toxic")).where("held_out").collect()
    assert len(got) > 80 and np.mean([x.predicted == (x.doc_id % 4 == 0) for x in got]) > 0.95


def test_zip_directories():
    """The reader against the standard library: with and without ZIP64 records, a comment, and other members."""
    for wide in (False, True):
        sink = io.BytesIO()
        with zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED) as z:
            for name, data in (("é.txt", b"one"), ("b", b"\0" * 5000), ("c/d", b"")):
                with z.open(name, "w", force_zip64=wide) as f:
                    f.write(data)
            z.writestr("packed", b"x" * 1000, zipfile.ZIP_DEFLATED)
        comment = b"a comment PK\5\6 with a false mark"  # at which the standard library stumbles
        raw = sink.getvalue()[:-2] + struct.pack("<H", len(comment)) + comment
        own = zip_warc.ZipReader(io.BytesIO(raw), len(raw))
        with zipfile.ZipFile(sink) as z:
            assert {n: (m.size, m.crc) for n, m in own.members.items()} == {i.filename: (i.file_size, i.CRC) for i in z.infolist()}
        assert own.read("é.txt") == b"one" and own.read("b", 10, 7) == b"\0" * 7 and own.read("c/d") == b""
        try:
            own.read("packed")
            raise AssertionError
        except ValueError as e:
            assert "compressed" in str(e)


def test_zip64_end_record():
    """A directory that stands behind a ZIP64 end record, with sizes and offsets in the extra field."""
    name, data = b"archive/data.warc.gz", b"payload"
    local = struct.pack("<4sHHHHHIIIHH", b"PK\3\4", 45, 0x800, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), 20) + name + struct.pack("<HHQQ", 1, 16, len(data), len(data))
    extra = struct.pack("<HHQQQ", 1, 24, len(data), len(data), 0)
    entry = struct.pack("<4sHHHHHHIIIHHHHHII", b"PK\1\2", 45, 45, 0x800, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    at = len(local) + len(data)
    end64 = struct.pack("<4sQHHIIQQQQ", b"PK\6\6", 44, 45, 45, 0, 0, 1, 1, len(entry), at)
    tail = struct.pack("<4sIQI", b"PK\6\7", 0, at + len(entry), 1) + struct.pack("<4sHHHHIIH", b"PK\5\6", 0xFFFF, 0xFFFF, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    raw = local + data + entry + end64 + tail
    assert zip_warc.ZipReader(io.BytesIO(raw), len(raw)).read(name.decode()) == data


def other_record(kind, block, content_type="application/http; msgtype=response", crlf="\r\n", **more):
    head = {"warc-type": kind, "WARC-Record-Id": f"<urn:uuid:{hashlib.md5(block).hexdigest()}>", "Content-Type": content_type, "Content-length": len(block)} | {k.replace("_", "-"): v for k, v in more.items()}
    return ("WARC/1.0\r\n" + "".join(f"{k}:{v}{crlf}" for k, v in head.items()) + "\r\n").encode() + block + b"\r\n\r\n"


def test_packages_of_other_writers(spark, tmp_path):
    """Several WARC members, packed or not, real index lines, a packed index, no index, other record types and ids."""
    import gzip
    import json

    chunked = b"HTTP/1.1 200 OK\r\ntransfer-encoding: chunked\r\n\r\n3\r\nabc\r\n2;x=y\r\nde\r\n0\r\n\r\n"
    records = [
        other_record("warcinfo", b"software: x\r\n", "application/warc-fields"), other_record("response", b"HTTP/1.1 200 OK\r\n\r\n" + b"body " * 300_000, WARC_Target_URI="http://a/"),
        other_record("response", chunked, WARC_Payload_Digest="sha1:" + hashlib.sha1(b"abcde").hexdigest()), other_record("revisit", b"HTTP/1.1 200 OK\r\nContent-Length: 5\r\n\r\n", WARC_Refers_To="<urn:uuid:1>", WARC_Payload_Digest="sha1:XYZ"),
        other_record("resource", b"", "text/plain"),
    ]
    for how in ("walked", "lines", "packed"):
        with zipfile.ZipFile(tmp_path / f"{how}.wacz", "w", zipfile.ZIP_STORED) as z:
            lines = []
            for name, data in (("a.warc.gz", [gzip.compress(r) for r in records]), ("b.warc", records)):
                z.writestr(f"archive/{name}", b"".join(data))
                at = 0
                for x in data:
                    lines.append(f"com,a)/ 2020 {json.dumps({'url': 'http://a/', 'filename': name, 'offset': str(at), 'length': len(x)})}")
                    at += len(x)
            text = "\n".join(["!meta {}", *reversed(lines)]).encode()
            if how == "lines":
                z.writestr("indexes/index.cdxj", text, zipfile.ZIP_DEFLATED)
            if how == "packed":
                z.writestr("indexes/index.cdx.gz", gzip.compress(text))
            z.writestr("pages/pages.jsonl", "{}")
    paths = [(str(x), x.stat().st_size) for x in tmp_path.iterdir()]
    ranges = zip_warc.list_ranges(spark.createDataFrame(paths, "path string, size long"), 2000)
    got = [(r.record_type, r.payload_bytes, r.payload_digest if r.record_type == "revisit" else r.payload_digest == zip_warc.base32_sha1(r.payload), r.page_id, r.refers_to_id) for r in zip_warc.read_ranges(ranges, payload=True).collect()]
    one = [("warcinfo", 13, True, None, None), ("response", 1_500_000, True, None, None), ("response", 5, True, None, None), ("revisit", 5, "XYZ", None, "<urn:uuid:1>"), ("resource", 0, True, None, None)]
    assert sorted(got, key=repr) == sorted(one * 6, key=repr)


def plain_quality(rows):
    """The texts that the quality rules keep, less frequent lines; rows are (doc_id, text, host)."""
    space = "[ \\t-\\r]+"
    cut = lambda t: [w for w in re.split(space, t) if w]
    norm = lambda line: re.sub("[0-9]", "0", " ".join(cut(line.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)))))
    holders = {}
    for host, text in {(h, t) for _, t, h in rows}:
        first = min(i for i, t, h in rows if (h, t) == (host, text))
        for line in {norm(x) for x in text.split("\n") if cut(x)}:
            holders.setdefault((host, line), []).append(first)
    out = {}
    for i, text, host in rows:
        words = cut(text)
        threes = Counter(zip(words, words[1:], words[2:], strict=False))
        twice = {k + j for k in range(len(words) - 2) if threes[tuple(words[k : k + 3])] > 1 for j in range(3)}
        gone = [x for x in text.split("\n") if cut(x) and len(holders[host, norm(x)]) > 20 and min(holders[host, norm(x)]) != i]
        lost = sum(len(cut(x)) for x in gone)
        if len(words) >= 50 and 2 * len(twice) <= len(words) and 2 * lost <= len(words):
            out[i] = "\n".join(x for x in text.split("\n") if x not in gone) if gone else text
    return out


def test_pipeline(spark):
    """The whole pipeline against plain versions of its stages, one after the other."""
    rows = duckdb.connect().execute(f"SELECT doc_id, coalesce(text, ''), coalesce(source, '') FROM '{DATA}/documents.parquet'").fetchall()
    # a line in many documents of a host, so that lines are cut and a document is depleted
    more = [(1000 + i, " ".join(f"{a}{b}" for a in "abcdefghij"[: 10 if i else 1] for b in f"{chr(97 + i)}xyzklmno") + "\nThe Same  line 7 in all of them", "many") for i in range(24)]
    rows = [(i, t, s, "en", len(t)) for i, t, s in rows + more]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long").repartition(4)
    kept = docs
    for name, function in corpus_pipeline.STAGES[:-1]:
        kept = function(spark, kept, DATA).cache()
        assert kept.columns == docs.columns, name
    assert kept.where(F.length("text") != F.col("n_chars")).count() == 0
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.STAGES[-1][1](spark, kept, DATA).collect()}

    own = plain_quality([r[:3] for r in rows])
    assert any("Same  line" not in own[i] for i in own if i >= 1000) and len(own) < len(rows)
    ids = sorted(own)
    first = plain_components(ids, np.array([plain_fingerprint(own[i]) for i in ids], np.uint64))
    own = {i: own[i] for i in ids if first[i] == i}
    rest = plain_rest([(i, t.encode()) for i, t in own.items()])
    own = {i: left.decode("utf-8", "ignore") for i, (left, gone) in rest.items() if not all(gone) or not gone}
    items = dict(duckdb.connect().execute(f"SELECT item_id, coalesce(text, '') FROM '{DATA}/benchmark.parquet'").fetchall())
    dirty = {d for d, _ in plain_contaminated(own, items)}
    enc, want = encoding(), {}
    for i, t in own.items():
        if i not in dirty:
            tokens = enc.encode_ordinary(t)
            want[i] = len(tokens), hashlib.sha256(np.array(tokens, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()
    assert got == want


def test_pipeline_from_tables(spark):
    assert corpus_pipeline.run(spark, DATA).count() > 20


def answered_in_memory(rows, n_slices, hot):
    """The steps over slices in this process, as the buckets would answer them; which bytes go, by document."""
    d, bits, own, answers = prefix_free_dedup, 3, [], []
    groups = [rows[k::n_slices] for k in range(n_slices)]
    sent = {}
    for k, g in enumerate(groups):
        body, sizes = np.frombuffer(b"".join(t for _, t in g), np.uint8), np.array([len(t) for _, t in g], np.int64)
        count, off, gram = d.parse(body, sizes)
        own.append(d.Slice(body, sizes, np.array([i for i, _ in g], np.int64), count, off))
        answers.append(d.Answers({}, bits))
        assert (d.gram_hashes_at(own[k].words, own[k].at) == gram).all()
        for step, b, message in d.first_messages(own[k], bits):
            sent.setdefault((step, b), []).append((k, message))
    how = {1: lambda m: d.answer_triggers(m, hot), 2: d.answer_phrases, 3: d.answer_hashes, 4: d.answer_hashes}

    def answered():
        for (step, b), messages in sent.items():
            for (k, _), got in zip(messages, how[step]([m for _, m in messages]), strict=True):
                answers[k].by_step.setdefault(step, {})[b] = got
        sent.clear()

    answered()
    steps = set()
    for k, s in enumerate(own):
        for step, b, message in s.asked(answers[k], bits):
            sent.setdefault((step, b), []).append((k, message))
            steps.add(step)
    answered()
    out = {}
    for k, s in enumerate(own):
        stay, at = s.kept(answers[k]), 0
        for i, t in groups[k]:
            kept = bytes(x for x, y in zip(t, stay[at : at + len(t)], strict=True) if y)
            out[i] = (len(t), len(t) - len(kept), hashlib.sha256(kept).hexdigest())
            at += len(t)
    return out, steps


def test_repeats_when_documents_are_cut(monkeypatch):
    r = random.Random(1)
    for chunk in (60, 100, 300, 1 << 18):
        monkeypatch.setattr(prefix_free_dedup, "CHUNK", chunk)
        for k in range(9):
            letters = (b"abcd", b"ab", bytes(range(256)))[k % 3]
            parts = [bytes(r.choices(letters, k=r.choice((20, 49, 50, 51, 90, 300)))) for _ in range(12)]
            rows = [(i, b"".join(r.choice(parts) if r.random() < 0.7 else bytes(r.choices(letters, k=r.randint(0, 120))) for _ in range(r.randint(0, 12)))) for i in range(25)]
            rows += [(100 + i, letters[:1] * r.randint(0, 300)) for i in range(4)]
            r.shuffle(rows)
            monkeypatch.setattr(prefix_free_dedup, "RUN_BITS", k % 4)
            want = {i: (n, gone, kept) for i, (n, gone, _, kept) in plain_repeats(rows).items()}
            for hot in (0, 20, 50_000):  # every trigger hot, some, none
                got, steps = answered_in_memory(rows, 3, hot)
                assert got == want
                assert steps <= {0: {3}, 20: {2, 3}, 50_000: {2}}[hot]


def test_phrases_that_share_a_hash(monkeypatch):
    """Equality goes by bytes: hashes that say nothing change no result."""
    first = prefix_free_dedup.string_hashes_at
    monkeypatch.setattr(prefix_free_dedup, "string_hashes_at", lambda words, at: (np.zeros(len(at), np.uint64), first(words, at)[1]))
    r = random.Random(5)
    parts = [bytes(r.choices(b"abc", k=r.choice((30, 60, 120)))) for _ in range(6)]
    rows = [(i, b"".join(r.choices(parts, k=r.randint(0, 4)))) for i in range(15)]
    assert answered_in_memory(rows, 2, 50_000)[0] == {i: (n, gone, kept) for i, (n, gone, _, kept) in plain_repeats(rows).items()}


def test_orders_and_common_lengths():
    data = bytes(random.Random(2).choices(b"ab\0", k=3000))
    rows = [data[i : i + 16] for i in range(0, 2900, 7)]
    words = [np.array([int.from_bytes(x[8 * j : 8 * j + 8], "big") for x in rows], np.uint64) for j in range(2)]
    order, common = prefix_free_dedup._sorted_with_lcp(words)
    by_hand = sorted(rows)
    assert [rows[i] for i in order] == by_hand and common[0] == -1
    assert common[1:].tolist() == [next((k for k in range(16) if a[k] != b[k]), 16) for a, b in zip(by_hand, by_hand[1:], strict=False)]
