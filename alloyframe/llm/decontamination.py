"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Every word trigram of a test item is a seed, so that a copy is looked at if three words in a row are left as they
were. Rarity does not choose among them: an edit makes rare trigrams out of the broken ones, and copies make the
intact ones common. Documents give the regions around places that may be seeds, a join on the seed's hash names the
items, and each region and item are aligned word by word, unless too few of the item's words stand in the region for
any alignment to reach the least score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alloyframe.llm.common import kept_rows, map_slices, maybe_broadcast, row_key, stage, utf8
from alloyframe.sources.scratch import scratch, temporary

_MARKS = bytes(b" "[0] if chr(i) in " \t\n\r\x0b\x0c!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else i for i in range(256))
#: Words whose hash a worker remembers.
CACHED_WORDS = 1_000_000
#: Words of all items together, of eight bytes each, up to which every worker has them.
MOST_WORDS = 4_000_000
#: Bits of the filter that tells which places may be seeds; at most 32 MB, however many seeds there are.
LEAST_BITS, MOST_BITS = 23, 25


@dataclass(frozen=True)
class Alignment:
    """Scores of an aligned word, a replaced word and a word on one side only, and the share of an item's full score
    from which a region counts as a copy."""

    match: int = 2
    mismatch: int = -1
    gap: int = -1
    least: float = 0.5


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word) >> 1
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = h
        return h

    def of(self, text: bytes) -> np.ndarray:
        """Hashes of the words of a text: ASCII letters in lower case, ASCII marks as space."""
        words = text.lower().translate(_MARKS).split()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def trigram_hashes(words: np.ndarray) -> np.ndarray:
    w = words.view(np.uint64)
    if len(w) < 3:
        return np.zeros(0, np.int64)
    h = w[:-2] * np.uint64(0x9E3779B97F4A7C15) + w[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + w[2:] * np.uint64(0x165667B19E3779F9)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x9FB21C651E98DF25)
    h ^= h >> np.uint64(29)
    return h.view(np.int64)


def align(item: np.ndarray, words: np.ndarray, how: Alignment) -> tuple[int, int]:
    """Best local alignment score, and where in words it ends."""
    n = len(words)
    steps = np.arange(n + 1) * -how.gap
    row, best, end = np.zeros(n + 1, np.int64), 0, 0
    for w in item:
        new = np.maximum(row + how.gap, 0)
        new[1:] = np.maximum(new[1:], row[:-1] + np.where(words == w, how.match, how.mismatch))
        row = np.maximum.accumulate(new + steps) - steps
        if (top := int(row.max())) > best:
            best, end = top, int(row.argmax())
    return best, end


def item_words(benchmark: DataFrame) -> DataFrame:
    """(item_id, words): word hashes of the items; null texts have none."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = WordHashes()
        return pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array([own.of(x) for x in utf8(batch.column("text"))], pa.list_(pa.int64()))], names=["item_id", "words"])

    return map_slices(benchmark.select("item_id", "text").where("item_id is not null").dropDuplicates(), run, "item_id long, words array<long>")


def item_grams(items: DataFrame) -> DataFrame:
    """(text_id, h) of the trigrams of the items."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = [np.unique(trigram_hashes(np.array(x, np.int64))) for x in batch.column("words").to_pylist()]
        ids = np.repeat(batch.column("text_id").to_numpy(zero_copy_only=False), [len(x) for x in got])
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(np.concatenate(got), pa.int64())], names=["text_id", "h"])

    return map_slices(items, run, "text_id long, h long").distinct()


def _filter(grams: DataFrame) -> np.ndarray:
    """Which residues of a hash some gram has: a set that may say yes wrongly, of bounded size."""
    n = grams.count()
    bits = min(MOST_BITS, max(LEAST_BITS, (64 * max(1, n)).bit_length()))
    on = np.zeros(1 << bits, bool)
    residues = grams.select(F.pmod("h", F.lit(1 << bits)).cast("int").alias("r")).distinct()  # at most 2^25 numbers
    on[residues.toPandas()["r"].to_numpy()] = True
    return np.packbits(on)


class _Maybe:
    """The filter on a worker, unpacked once."""

    def __init__(self, shared):
        self.shared, self.on = shared, None

    def __call__(self, h: np.ndarray) -> np.ndarray:
        if self.on is None:
            self.on = np.unpackbits(self.shared.value).view(bool)
        return self.on[h & (len(self.on) - 1)]

    def __reduce__(self):
        return _Maybe, (self.shared,)


def regions(docs: DataFrame, seeds: DataFrame, reach: int) -> DataFrame:
    """(doc_id, words, h, p): stretches of documents with places that may be seeds, and so many words to either side.

    h and p are the places' hashes and their places within the stretch.
    """
    maybe = _Maybe(docs.sparkSession.sparkContext.broadcast(_filter(seeds)))
    known = WordHashes()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple] = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), utf8(batch.column("text")), strict=True):
            words = known.of(text)
            h = trigram_hashes(words)
            hit = np.flatnonzero(maybe(h))
            if not len(hit):
                continue
            for part in np.split(hit, np.flatnonzero(np.diff(hit) > reach) + 1):
                start = max(0, part[0] - reach)
                out.append((doc_id, start, words[start : part[-1] + 3 + reach], h[part], part - start))
        cols = list(zip(*out, strict=True)) or [()] * 5
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["doc_id", "start", "words", "h", "p"])

    return map_slices(docs.select("doc_id", "text").where("doc_id is not null"), run, "doc_id long, start long, words array<long>, h array<long>, p array<long>")


def _texts(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(text_id, words) of the distinct items, named by the smallest of equal ones, and (item_id, text_id) of all."""
    texts = stage(items.groupBy("words").agg(F.min("item_id").alias("text_id")), "texts")
    return texts, stage(items.join(texts, "words").select("item_id", "text_id"), "members")


class _Items:
    """The words of items on a worker, by id."""

    def __init__(self, shared):
        self.shared, self.by_id = shared, None

    def __getitem__(self, text_id: int) -> np.ndarray:
        if self.by_id is None:
            self.by_id = {k: np.frombuffer(v, np.int64) for k, v in self.shared.value.items()}
        return self.by_id[text_id]

    def __reduce__(self):
        return _Items, (self.shared,)


def _aligned(item: np.ndarray, words: np.ndarray, low: int, high: int, how: Alignment) -> tuple[float, int, int] | None:
    """Score, and first and last aligned word, of an item in the region about the places of its seeds."""
    side = len(item) + len(item) // 4 + 1
    left = max(0, low - side)
    words = words[left : high + 3 + side]
    if np.isin(item, words).sum() < how.least * len(item):
        return None
    best, end = align(item, words, how)
    score = best / (how.match * len(item))
    if score < how.least:
        return None
    _, back = align(item[::-1], words[:end][::-1], how)
    return score, left + end - back, left + end - 1


SCORED = "doc_id long, text_id long, score double, first_word long, last_word long"


def _scored(out: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*out, strict=True)) or [()] * 5
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["doc_id", "text_id", "score", "first_word", "last_word"])


def _by_region(pairs: DataFrame, found: DataFrame, texts: DataFrame, how: Alignment) -> DataFrame:
    """Every region once with the items to look for in it, whose words all workers have."""
    known = {r["text_id"]: np.array(r["words"], np.int64).tobytes() for r in texts.collect()}  # MOST_WORDS at most
    items = _Items(texts.sparkSession.sparkContext.broadcast(known))
    listed = pairs.groupBy("rid").agg(F.collect_list(F.struct("text_id", "low", "high")).alias("looked_for"))  # an entry for each item at most

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple] = []
        for i in range(batch.num_rows):
            doc_id, start = batch.column("doc_id")[i].as_py(), batch.column("start")[i].as_py()
            words = batch.column("words")[i].values.to_numpy()
            for x in batch.column("looked_for")[i].as_py():
                if got := _aligned(items[x["text_id"]], words, x["low"], x["high"], how):
                    out.append((doc_id, x["text_id"], got[0], start + got[1], start + got[2]))
        return _scored(out)

    return map_slices(listed.join(found.select("rid", "doc_id", "start", "words"), "rid").select("doc_id", "start", "words", "looked_for"), run, SCORED)


def _by_pair(pairs: DataFrame, found: DataFrame, texts: DataFrame, how: Alignment) -> DataFrame:
    """Every pair of a region and an item with the words of both, for more items than all workers could have."""
    rows = pairs.join(found.select("rid", "doc_id", "start", "words"), "rid").join(texts.withColumnRenamed("words", "item"), "text_id")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple] = []
        take = [batch.column(k) for k in ("doc_id", "text_id", "start", "low", "high", "words", "item")]
        for i in range(batch.num_rows):
            doc_id, text_id, start, low, high = (c[i].as_py() for c in take[:5])
            words, item = (c[i].values.to_numpy() for c in take[5:])
            if got := _aligned(item, words, low, high, how):
                out.append((doc_id, text_id, got[0], start + got[1], start + got[2]))
        return _scored(out)

    return map_slices(rows.select("doc_id", "text_id", "start", "low", "high", "words", "item"), run, SCORED)


def contaminated(docs: DataFrame, benchmark: DataFrame, how: Alignment = Alignment()) -> DataFrame:
    """(doc_id, item_id, score, first_word, last_word): items that a document holds, exactly or edited.

    The score is the share of the item's full alignment score; a pair appears once, with its best region. Items of
    fewer than three words have no trigram and give no row, nor does a copy without three words of it in a row; null
    texts and null ids give none; repeated rows and repeated items count once, and equal items are aligned once; other
    columns are not read; empty tables give an empty result. Texts are read whole.
    """
    texts, members = _texts(item_words(benchmark))
    seeds = stage(item_grams(texts), "seeds")
    longest, total = texts.agg(F.coalesce(F.max(F.size("words")), F.lit(0)), F.coalesce(F.sum(F.size("words") + 1), F.lit(0))).first()
    reach = longest + longest // 4 + 1
    found = stage(regions(docs, seeds, reach).withColumn("rid", F.monotonically_increasing_id()), "regions")
    places = found.select("rid", F.explode(F.arrays_zip("h", "p")).alias("x")).select("rid", "x.h", "x.p")
    pairs = places.join(maybe_broadcast(seeds, 500_000), "h").groupBy("rid", "text_id").agg(F.min("p").alias("low"), F.max("p").alias("high"))
    scored = (_by_region if total <= MOST_WORDS else _by_pair)(stage(pairs, "pairs"), found, texts, how)
    best = scored.groupBy("doc_id", "text_id").agg(F.max(F.struct("score", -F.col("first_word"), "last_word")).alias("b"))
    named = best.join(maybe_broadcast(members, 500_000), "text_id")
    return named.select("doc_id", "item_id", "b.score", (-F.col("b.col2")).alias("first_word"), "b.last_word")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, how: Alignment = Alignment()) -> DataFrame:
    """The rows of docs that hold no item; rows without a doc_id are judged by their text like all others."""
    place = scratch(docs.sparkSession, "contaminated")
    with temporary(docs.sparkSession):
        found = contaminated(docs.select(row_key().alias("doc_id"), "text"), benchmark, how)
        gone = stage(found.select(F.col("doc_id").alias("key")).distinct(), "contaminated", place)
    return kept_rows(docs, gone).select("row.*")
