"""Toxicity by a convolutional text classifier, trained in numpy.

A word's embedding is the sum of two hashed rows, one for the word and one for its first four bytes, so that an ending
that training has not seen does not hide a stem. Filters that span one, two and three words run over the whole text;
each filter's largest value goes into a logistic unit. The gradient reaches only the words at the largest values. The
logit is shifted by a threshold for the text's language, so that 0.5 divides the classes; the language is guessed from
the same hashed words, never taken from a column.

The network learns from a bounded sample of labelled documents. A fifth of all labelled documents, by a hash, is kept
from it and sets the thresholds: their logits are counted by language, class and bin on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alloyframe.llm.common import MOST_LABELS, held_out, in_class_sample, map_slices, maybe_broadcast, stage, utf8

#: Rows of the embedding table for words, and as many for stems; its width, the filters' widths and how many there are of each.
ROWS, WIDTH, SPANS, FILTERS = 1 << 17, 16, (1, 2, 3), 16
#: Bytes of a word's stem, and by how many bits a word's row is shifted to make room for its stem's.
STEM, SHIFT = 4, 20
STEMS = (1 << SHIFT) - 1
#: Labelled documents of each class that training reads at most (about; whole texts), and the words of the longest.
TRAIN_DOCS, TRAIN_WORDS = 3000, 5000
#: Documents that must hold a row's words for the row to be trained; others stay zero.
LEAST_DOCS = 3
EPOCHS, BATCH_WORDS, BATCH_DOCS, RATE, SEED = 12, 20_000, 32, 0.01, 7
#: Steps that training takes at least: few documents are gone through more often.
LEAST_STEPS = 600
#: One in so many labelled documents sets thresholds; bins of logits, from -30 to 30.
CALIBRATE, BINS = 5, 1200
#: Documents of all languages that count along with those of each one when its threshold is set.
PRIOR = 50
#: Words of a long text that are held at a time; neighbouring blocks overlap by the widest filter.
BLOCK = 1 << 15
#: Words whose row a worker remembers.
CACHED_WORDS = 1_000_000

_MARKS = bytes(b" "[0] if chr(i) in " \t\n\r\x0b\x0c!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else i for i in range(256))


class WordRows(dict):
    """The embedding rows of a word and its stem in one number, remembered up to a number of words."""

    def __missing__(self, word: bytes) -> int:
        row = xxhash.xxh64_intdigest(word) % ROWS << SHIFT | ROWS + xxhash.xxh64_intdigest(word[:STEM], 1) % ROWS
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = row
        return row

    def of(self, text: bytes) -> np.ndarray:
        words = text.lower().translate(_MARKS).split()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


@dataclass
class ToxicityModel:
    table: np.ndarray  # 2 ROWS x WIDTH
    filters: list[np.ndarray]  # for each span: span x WIDTH x FILTERS
    bias: np.ndarray  # FILTERS of all spans
    out: np.ndarray
    out_bias: float
    languages: np.ndarray  # 2 ROWS x languages, logarithms; only stems count
    thresholds: np.ndarray  # by language

    def embed(self, rows: np.ndarray) -> np.ndarray:
        return self.table[rows >> SHIFT] + self.table[rows & STEMS]

    def pool(self, rows: np.ndarray) -> np.ndarray:
        """The largest value of each filter over a whole text, at least 0; a text shorter than a filter gives 0."""
        best = np.zeros(len(self.bias), np.float32)
        widest = max(SPANS)
        for at in range(0, max(1, len(rows)), BLOCK):
            x = self.embed(rows[at : at + BLOCK + widest - 1])
            for i, (span, w) in enumerate(zip(SPANS, self.filters, strict=True)):
                if len(x) >= span:
                    z = x[: len(x) - span + 1] @ w[0]
                    for k in range(1, span):
                        z += x[k : len(x) - span + 1 + k] @ w[k]
                    own = slice(i * FILTERS, (i + 1) * FILTERS)
                    best[own] = np.maximum(best[own], z.max(axis=0) + self.bias[own])
        return best

    def logit(self, rows: np.ndarray) -> float:
        return float(self.pool(rows) @ self.out + self.out_bias)

    def language(self, rows: np.ndarray) -> int:
        return int(self.languages[rows & STEMS].sum(axis=0).argmax()) if len(rows) and self.languages.shape[1] else -1


def _batches(texts: list[np.ndarray], order: np.ndarray):
    """Indices of texts of like length, BATCH_DOCS of them or about BATCH_WORDS padded words together."""
    batch, longest = [], 0
    for i in order:
        longest_now = max(longest, len(texts[i]))
        if batch and (len(batch) == BATCH_DOCS or longest_now * (len(batch) + 1) > BATCH_WORDS):
            yield batch
            batch, longest_now = [], len(texts[i])
        batch, longest = [*batch, i], longest_now
    if batch:
        yield batch


def fit(texts: list[np.ndarray], label: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> ToxicityModel:
    """Train on texts as arrays of embedding rows; thresholds are 0. A class without a text gives a constant score."""
    rng = np.random.default_rng(seed)
    held = np.zeros(2 * ROWS, np.int64)
    for t in texts:
        held[np.unique(np.concatenate([t >> SHIFT, t & STEMS]))] += 1
    table = rng.normal(0, 0.1, (2 * ROWS, WIDTH)).astype(np.float32)
    table[held < LEAST_DOCS] = 0
    filters = [rng.normal(0, 0.3, (s, WIDTH, FILTERS)).astype(np.float32) for s in SPANS]
    n_out = FILTERS * len(SPANS)
    m = ToxicityModel(table, filters, np.full(n_out, 0.01, np.float32), rng.normal(0, 0.1, n_out).astype(np.float32), 0.0, np.zeros((2 * ROWS, 0), np.float32), np.zeros(1))
    ones = int(label.sum())
    if ones in (0, len(label)):
        m.out[:], m.out_bias = 0, 4.0 if ones else -4.0
        return m
    weight = np.where(label == 1, len(label) / 2 / ones, len(label) / 2 / (len(label) - ones))
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (*m.filters, m.bias, m.out)]
    seen = np.full(2 * ROWS, 1e-3, np.float32)
    bias_state, step = [0.0, 0.0], 0
    size = np.array([len(t) for t in texts])
    epoch = 0
    while epoch < epochs or step < LEAST_STEPS:
        epoch += 1
        noisy = size * rng.uniform(0.8, 1.25, len(texts))
        groups = list(_batches(texts, np.argsort(noisy)))
        for g in rng.permutation(len(groups)):
            own = groups[g]
            long = max(max(SPANS), *(len(texts[i]) for i in own))
            ids, on = np.zeros((len(own), long), np.int64), np.zeros((len(own), long), bool)
            for r, i in enumerate(own):
                ids[r, : len(texts[i])], on[r, : len(texts[i])] = texts[i], True
            x = m.embed(ids) * on[:, :, None]
            pooled, places = [], []
            for i, (span, w) in enumerate(zip(SPANS, m.filters, strict=True)):
                z = sum(x[:, k : long - span + 1 + k] @ w[k] for k in range(span))
                z = np.where(on[:, span - 1 :, None], z, -1e9)
                at = z.argmax(axis=1)
                pooled.append(np.take_along_axis(z, at[:, None], axis=1)[:, 0] + m.bias[i * FILTERS : (i + 1) * FILTERS])
                places.append(at)
            value = np.concatenate(pooled, axis=1)
            kept = np.maximum(value, 0)
            p = 1 / (1 + np.exp(-np.clip(kept @ m.out + m.out_bias, -30, 30)))
            err = ((p - label[own]) * weight[own] / len(own)).astype(np.float32)
            down = (err[:, None] * m.out) * (value > 0)
            grads = [np.zeros_like(w) for w in m.filters]
            rows, parts = [], []
            for i, (span, w) in enumerate(zip(SPANS, m.filters, strict=True)):
                d = down[:, i * FILTERS : (i + 1) * FILTERS]
                for k in range(span):
                    words = np.take_along_axis(ids, places[i] + k, axis=1)
                    vec = np.take_along_axis(x, (places[i] + k)[:, :, None], axis=1)  # text, filter, width
                    grads[i][k] = np.einsum("bf,bfw->wf", d, vec)
                    part = (d[:, :, None] * w[k].T[None]).reshape(-1, WIDTH)
                    hit = np.flatnonzero(d.ravel())
                    rows += [words.ravel()[hit] >> SHIFT, words.ravel()[hit] & STEMS]
                    parts += [part[hit]] * 2
            step += 1
            for s, q, grad in zip(state, (*m.filters, m.bias, m.out), (*grads, down.sum(axis=0), kept.T @ err + 1e-4 * m.out), strict=True):
                s[0] = 0.9 * s[0] + 0.1 * grad
                s[1] = 0.999 * s[1] + 0.001 * grad * grad
                q -= RATE * (s[0] / (1 - 0.9**step)) / (np.sqrt(s[1] / (1 - 0.999**step)) + 1e-6)
            e = float(err.sum())
            bias_state = [0.9 * bias_state[0] + 0.1 * e, 0.999 * bias_state[1] + 0.001 * e * e]
            m.out_bias -= RATE * bias_state[0] / (1 - 0.9**step) / ((bias_state[1] / (1 - 0.999**step)) ** 0.5 + 1e-6)
            rows, parts = np.concatenate(rows), np.concatenate(parts)
            which, inverse = np.unique(rows, return_inverse=True)
            grad = np.zeros((len(which), WIDTH), np.float32)
            np.add.at(grad, inverse, parts)
            grad[held[which] < LEAST_DOCS] = 0
            seen[which] += (grad * grad).mean(axis=1)
            m.table[which] -= 5 * RATE * grad / np.sqrt(seen[which])[:, None]
    return m


def best_threshold(zeros: np.ndarray, ones: np.ndarray) -> float:
    """The logit that divides counts of both classes by bin with the most right answers, in the middle of equal ones."""
    if not (zeros.sum() and ones.sum()):
        return 0.0
    right = np.concatenate([[0], np.cumsum(zeros)]) + ones.sum() - np.concatenate([[0], np.cumsum(ones)])
    best = np.flatnonzero(right >= right.max() - 1e-9)
    return float((best[0] + best[-1]) / 2 * 60 / BINS - 30)


def _known(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic): of several rows of a doc_id the largest label holds."""
    return labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))


def _calibrates() -> Column:
    return F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(CALIBRATE)) == 0


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> ToxicityModel:
    """Fit on about `most` labelled documents of each class, without those that set thresholds; thresholds are 0.

    labels has doc_id and toxic; rows with null are not used. docs has doc_id and text, and lang, which names the
    groups for which thresholds can be set. Texts of more than TRAIN_WORDS words are not in the sample, so that what
    the driver gathers is bounded.
    """
    known = _known(labels).where(~_calibrates())
    picked = stage(known.where(in_class_sample(known, "toxic", most)), "sample")
    rows = docs.select("doc_id", "text", "lang").join(maybe_broadcast(picked, 100_000), "doc_id")

    def read(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = WordRows()
        cut = [own.of(x) for x in utf8(batch.column("text"))]
        small = np.flatnonzero([len(x) <= TRAIN_WORDS for x in cut])
        part = batch.take(pa.array(small, pa.int64()))
        return pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("toxic"), part.column("lang"), pa.array([cut[i].tobytes() for i in small], pa.binary())], names=["doc_id", "toxic", "lang", "rows"])

    data = map_slices(rows, read, "doc_id long, toxic int, lang string, rows binary").toPandas().sort_values(["doc_id", "rows"], kind="stable")
    texts = [np.frombuffer(x, np.int64) for x in data["rows"]]
    label, lang = data["toxic"].to_numpy(), data["lang"].fillna("").to_numpy()
    m = fit(texts, label)
    names = [str(k) for k in data["lang"].fillna("").value_counts().index[:MOST_LABELS]]
    counts = np.full((2 * ROWS, len(names)), 0.01)
    for t, k in zip(texts, lang, strict=True):
        if k in names:
            np.add.at(counts[:, names.index(k)], t & STEMS, 1)
    m.languages = np.log(counts / counts.sum(axis=0)).astype(np.float32)
    m.thresholds = np.zeros(len(names) + 1)
    return m


def logits(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, logit and language (its place in the model, -1 for a text without words) of every row's whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = WordRows()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = shared.value
        cut = [keep.of(x) for x in utf8(batch.column("text"))]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([own.logit(x) for x in cut], pa.float64()), pa.array([own.language(x) for x in cut], pa.int32())], names=["doc_id", "logit", "language"])

    return map_slices(docs.select("doc_id", "text"), run, "doc_id long, logit double, language int")


def calibrated(scored: DataFrame, labels: DataFrame, model: ToxicityModel) -> np.ndarray:
    """The threshold of each language, and last that of texts without one, from the logits of labelled documents.

    What the driver gathers is a count for each language, class and bin. A language's counts go with those of all
    languages, as if of PRIOR documents more, so that few labels move its threshold little.
    """
    known = _known(labels).where(_calibrates())
    place = F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor((F.col("logit") + 30) * BINS / 60))).cast("int")
    counts = scored.join(known, "doc_id").groupBy("language", "toxic", place.alias("bin")).count().collect()
    n = np.zeros((len(model.thresholds), 2, BINS))
    for r in counts:
        n[r["language"], int(r["toxic"] > 0), r["bin"]] += r["count"]
    every = n.sum(axis=0)
    prior = every * PRIOR / max(1, every.sum())
    return np.array([*(best_threshold(*(x + prior)) for x in n[:-1]), best_threshold(*every)])


def finished(scored: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score and predicted (1 if the score is 0.5 or more) from logits and the model's thresholds."""
    shift = F.element_at(F.array(*(F.lit(float(x)) for x in model.thresholds)), F.when(F.col("language") < 0, len(model.thresholds)).otherwise(F.col("language") + 1))
    part = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.col("logit") - shift))
    return scored.select("doc_id", (1 / (1 + F.exp(-part))).alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score and predicted (1 if the score is 0.5 or more) of every row's whole text.

    Null and empty texts get the score of a text without words. Repeated rows are judged each for itself, other
    columns are not read, and an empty table gives an empty result.
    """
    return finished(logits(docs, model), model)


def train_and_score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted; labels of held-out documents (crc32 of the id, remainder 0 by 5) are not read."""
    own = labels.where(~held_out(F.col("doc_id"), 5, 0))
    model = train(docs, own)
    scored = stage(logits(docs, model), "logits")
    model.thresholds = calibrated(scored, own, model)
    return finished(scored, model).select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", "predicted")
