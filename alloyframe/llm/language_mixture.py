"""Language identification by mixture inference.

A language is a distribution over hashed character trigrams of letters, with word ends as a letter of their own. A
word's likelihood under a language is the product over its trigrams, and a document is a mixture of languages over
its words. Expectation maximisation estimates the proportions, and the set of languages is chosen by likelihood less
a penalty for each language beyond the first (half the logarithm of the number of words, as in the Bayesian
information criterion, times a factor for words being dependent).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alloyframe.llm.common import in_class_sample, map_slices

#: Buckets of trigram hashes.
BITS = 15
#: Documents of each language that training reads at most (about; whole texts).
TRAIN_DOCS = 4000
#: Added to the count of each bucket.
SMOOTH = 0.05
#: Rounds of expectation maximisation.
ROUNDS = 8
#: Factor of the penalty.
PENALTY = 2.0
UNKNOWN = "und"


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the trigrams of all texts, the word that each belongs to, and the text of each word."""
    joined = "\n\n\n".join(x.lower() for x in texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(x.lower()) + 3 for x in texts])
    on = letters()[points]
    c = np.where(on, points, 0).astype(np.uint64)
    begin = on.copy()
    begin[1:] &= ~on[:-1]
    word = np.cumsum(begin) - 1
    after = np.zeros(len(on), bool)
    after[1:] = on[:-1]
    take = np.flatnonzero(on | after)  # each letter, and the end of each word
    one = c[take]
    two = np.where(take >= 1, c[take - 1], 0).astype(np.uint64)
    three = np.where((take >= 2) & (two > 0), c[take - 2], 0).astype(np.uint64)
    h = (one * np.uint64(0x9E3779B97F4A7C15)) ^ (two * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (three * np.uint64(0x165667B19E3779F9))
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x9FB21C651E98DF25)
    return (h >> np.uint64(64 - BITS)).astype(np.int64), word[take], np.searchsorted(ends, np.flatnonzero(begin), side="right")


@dataclass(frozen=True)
class LanguageModel:
    """Logarithms of bucket probabilities, a column for each language."""

    names: tuple[str, ...]
    table: np.ndarray

    def word_scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log likelihoods of the words of all texts, and the text of each word."""
        bucket, word, text = trigrams(texts)
        if not len(text):
            return np.zeros((0, len(self.names)), np.float32), text
        starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        return np.add.reduceat(self.table[bucket], starts, axis=0), text

    def infer(self, texts: list[str], slice_of: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
        """Proportions of the chosen languages by text, and the number of words; in slices of about so many characters."""
        share, count, at = np.zeros((len(texts), len(self.names))), np.zeros(len(texts), np.int64), 0
        while at < len(texts):
            stop, size = at, 0
            while stop < len(texts) and (stop == at or size + len(texts[stop]) <= slice_of):
                size += len(texts[stop])
                stop += 1
            scores, text = self.word_scores(texts[at:stop])
            n = np.bincount(text, minlength=stop - at)
            if len(text):
                share[at:stop][n > 0] = mixtures(scores, n[n > 0])
            count[at:stop] = n
            at = stop
        return share, count


def _em(like: np.ndarray, n: np.ndarray, share: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions after some rounds, and the log likelihood, of words (rows) that stand text by text."""
    starts = np.concatenate([[0], np.cumsum(n)[:-1]])
    for k in range(rounds + 1):
        joint = like * np.repeat(share, n, axis=0)
        total = joint.sum(axis=1) + 1e-30
        if k == rounds:
            return share, np.add.reduceat(np.log(total), starts)
        joint /= total[:, None]
        share = (np.add.reduceat(joint, starts, axis=0) / n[:, None]).astype(np.float32)
    raise AssertionError


def mixtures(scores: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The proportions of the set of languages with the best penalised likelihood; n: words of each text, all above 0."""
    k = scores.shape[1]
    starts = np.concatenate([[0], np.cumsum(n)[:-1]])
    top = scores.max(axis=1, keepdims=True)
    like = np.exp(scores - top)
    alone = np.add.reduceat((scores - top).astype(np.float64), starts, axis=0)  # log likelihood of each language alone
    best = np.zeros((len(n), k), np.float32)
    best[np.arange(len(n)), alone.argmax(axis=1)] = 1
    value = alone.max(axis=1)
    if k == 1:
        return best
    full, _ = _em(like, n, np.full((len(n), k), 1 / k, np.float32), ROUNDS)
    order = np.argsort(-full, axis=1, kind="stable")
    penalty = PENALTY * 0.5 * np.log(np.maximum(n, 2))
    for size in range(2, k + 1):
        # no set of this size can win if the best word by word does not
        hope = np.flatnonzero(-penalty * (size - 1) > value)
        hope = hope[full[hope, order[hope, size - 1]] * n[hope] > 0.5]
        if not len(hope):
            break
        rows = np.repeat(np.isin(np.arange(len(n)), hope), n)
        start = np.zeros((len(hope), k), np.float32)
        np.put_along_axis(start, order[hope, :size], np.take_along_axis(full[hope], order[hope, :size], axis=1) + 1e-3, axis=1)
        share, logs = _em(like[rows], n[hope], start / start.sum(axis=1, keepdims=True), ROUNDS)
        won = logs - penalty[hope] * (size - 1) > value[hope]
        best[hope[won]], value[hope[won]] = share[won], (logs - penalty[hope] * (size - 1))[won]
    return best


def train(docs: DataFrame, lang: str = "lang", most: int = TRAIN_DOCS) -> LanguageModel:
    """Fit on about `most` rows of docs for each of the most frequent languages; counts are summed on the executors.

    The result has 2^BITS numbers for each language, of which there are MOST_LABELS at most. Without a labelled row
    it has no language.
    """
    named = docs.select("doc_id", F.col(lang).alias("lang"), "text")
    rows = named.where("text is not null").where(in_class_sample(named, "lang", most))

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
        out = []
        for name in sorted(set(names)):
            n = np.bincount(trigrams([t for k, t in zip(names, texts, strict=True) if k == name])[0], minlength=1 << BITS)
            at = np.flatnonzero(n)
            out.append((pa.array([name] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(n[at], pa.int64())))
        return pa.RecordBatch.from_arrays([pa.concat_arrays(x) for x in zip(*out, strict=True)], names=["lang", "bucket", "n"])

    summed = map_slices(rows, count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    names = tuple(sorted(summed["lang"].unique()))
    n = np.zeros((1 << BITS, len(names)))
    for i, name in enumerate(names):
        own = summed[summed["lang"] == name]
        n[own["bucket"], i] = own["n"]
    n += SMOOTH
    return LanguageModel(names, np.log(n / n.sum(axis=0)).astype(np.float32))


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score and mixture (language to proportion) of every row's whole text.

    The score is the share of words of the predicted language, drawn a little to an even share where words are few.
    A null text, and one without a letter, is `und` with score 0. Repeated rows are judged each for itself, other
    columns are not read, and an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = shared.value
        names = own.names
        share, n = own.infer([x or "" for x in batch.column("text").to_pylist()]) if names else (np.zeros((batch.num_rows, 1)), np.zeros(batch.num_rows))
        top = share.argmax(axis=1)
        score = np.where(n > 0, (share.max(axis=1) * n + 0.5) / (n + 0.5 * max(1, len(names))), 0)
        lang = [names[i] if k else UNKNOWN for i, k in zip(top, n, strict=True)]
        mixture = [{names[j]: float(p) for j, p in enumerate(row) if p > 0} if k else {} for row, k in zip(share, n, strict=True)]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(np.clip(score, 0, 1), pa.float64()), pa.array([list(m.items()) for m in mixture], pa.map_(pa.string(), pa.float64()))],
            names=["doc_id", "lang_pred", "score", "mixture"],
        )

    return map_slices(docs.select("doc_id", "text"), run, "doc_id long, lang_pred string, score double, mixture map<string,double>")
