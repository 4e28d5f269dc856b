"""Removal of repeated passages by prefix-free parsing.

A byte string of the least length (50) is a repeat if it also starts in a document with a smaller doc_id, and every
byte that a repeat covers goes.

Parse. A trigger is the place of the smallest rolling hash (of 20 bytes) in some string of the least length, the first
of equal ones, so that each such string has one trigger, within it, that only its own bytes decide. A phrase is all
the strings that have one trigger, taken together: some bytes to the left, the 20 bytes of the trigger, some bytes to
the right. A text is a row of phrases, and equal passages have equal phrases but for the first and the last. The row
is parsed in its turn: phrases with a certain hash ends a run of some 8 phrases.

Corpus order. Two strings are equal only if their triggers are, so the order is made trigger by trigger:

1. runs and triggers: a run that an earlier document has goes whole. Of the rest, only phrases whose trigger stands in
   two documents are looked at further;
2. these phrases go, each distinct one of a slice once, with all their bytes, to the bucket of their trigger, where
   they are the corpus's dictionary for it. What leads up to a trigger is ordered as the dictionary's suffixes, from
   the trigger backwards; what follows it as the parse continues. Each order comes with the lengths that neighbours
   have in common, so that for a string of k bytes to the left of its trigger, a class of the first order at depth k
   and one of the second at depth 50 - k together name the run of equal strings in the corpus. The first document
   of these keeps the string.

Phrases are compared by their bytes, runs by 128-bit hashes. A trigger with very many phrases (a line in a large part
of all documents, with other text around it) would make one bucket's dictionary grow with the corpus: its strings go
one by one instead, each distinct one of a slice once, to buckets of their own 128-bit hash.

Texts are packed into slices of some MB that are parsed and written once, with the places of their phrases, bucketed
by slice. A slice sends its keys,
sorted and packed, to buckets, a bucket answers for each key, and the answers join the slices where they are. A key
that a third of the documents share is one entry of each slice, so no task grows with it.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alloyframe.llm.common import drop_staged, keep_freed_memory, slices, stage
from alloyframe.sources.scratch import drop_path, scratch

LEAST, GRAM = 50, 20
#: Bytes of a phrase on either side of its trigger, at most.
SIDE = LEAST - GRAM
#: Bytes of text in a slice, of all texts for each hash bucket, and for each task that reads slices.
SLICE, BUCKET, TASK = 4 << 20, 16 << 20, 16 << 20
#: Hash buckets at most, as a power of two; beyond it buckets grow.
MOST_BITS = 18
#: Places of a trigger in the corpus, about, from which its strings go one by one.
HOT = 20_000
#: Phrases with this many low bits of their hash zero end a run.
RUN_BITS = 3
#: Bytes of text that are hashed at a time, for the processor's cache.
CHUNK = 1 << 16
#: Zero bytes around gathered text, so that words may be read beyond its ends.
MARGIN = 64

A, B, C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
#: Offsets of the eight-byte words that cover a string of the least length.
WORDS = (*range(0, LEAST - 8, 8), LEAST - 8)


def _mix(v: np.ndarray) -> np.ndarray:
    v ^= v >> np.uint64(32)
    v *= A
    v ^= v >> np.uint64(29)
    return v


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of what a and b are hashes of, one after the other."""
    return _mix(a * B + b * C)


def word_view(data: np.ndarray, order: str = "<") -> np.ndarray:
    """The eight bytes from each place on as a number, without a copy."""
    return np.ndarray((max(0, len(data) - 7),), f"{order}u8", data, strides=(1,))


def _gram(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Hash of 20 bytes from the words at 0, 8 and 12, each mixed so that its highest bytes reach the lower bits."""
    h = a * A
    h += b * B
    h += c * C
    h ^= h >> np.uint64(32)
    h *= A
    return h


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 20 bytes from each place on."""
    w = np.ascontiguousarray(word_view(data))
    w ^= w >> np.uint64(29)
    return _gram(w[:-12], w[8:-4], w[12:])


def gram_hashes_at(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The same, of some places only, mixed once more: hashes of triggers are small ones, and buckets go by high bits."""
    got = [words[at + k] for k in (0, 8, 12)]
    return _mix(_gram(*(w ^ w >> np.uint64(29) for w in got)))


#: Odd factors of the words of a string, for two hashes.
FACTORS = [[(0x9E3779B97F4A7C15 * (2 * i + 3) ^ 0xD6E8FEB86659FD93 * (j + 1)) % 2**64 | 1 for j in range(len(WORDS))] for i in range(2)]


def string_hashes_at(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the 50 bytes from each of these places on."""
    a, b = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
    for k, m, n in zip(WORDS, *FACTORS, strict=True):
        w = _mix(words[at + k])
        a += w * np.uint64(m)
        b += w * np.uint64(n)
    return _mix(a), _mix(b)


def triggers(h: np.ndarray, width: int) -> np.ndarray:
    """For each stretch of so many hashes the place of the smallest one, the first of equal ones."""
    m = (h & ~np.uint64(0xFFFFFFFF)) | np.arange(len(h), dtype=np.uint64)
    size = 1
    while size * 2 <= width:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    if size < width:
        m = np.minimum(m[: size - width], m[width - size :])
    return (m & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _starts(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal sorted keys begins."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return np.flatnonzero(new)


@dataclass
class Classes:
    """Distinct keys in order, and for each entry which key it has."""

    keys: np.ndarray
    entry: np.ndarray
    least: np.ndarray  # smallest document of each key
    some: np.ndarray  # an entry of each key
    count: np.ndarray
    many: np.ndarray  # whether entries of more than one document have the key

    @staticmethod
    def of(keys: np.ndarray, docs: np.ndarray) -> Classes:
        order = np.argsort(keys)
        k, d = keys[order], docs[order]
        start = _starts(k)
        count = np.diff(np.append(start, len(k)))
        entry = np.empty(len(k), np.int64)
        entry[order] = np.repeat(np.arange(len(start)), count)
        if not len(k):
            return Classes(k, entry, d, entry, count, np.zeros(0, bool))
        low = np.minimum.reduceat(d, start)
        return Classes(k[start], entry, low, order[start], count, low != np.maximum.reduceat(d, start))


def _exact(keys: np.ndarray, docs: np.ndarray, parts: list[np.ndarray]) -> Classes:
    """Classes by hashes of strings, told apart by the strings' words where hashes fall together."""
    while True:
        got = Classes.of(keys, docs)
        same = np.ones(len(keys), bool)
        for p in parts:
            same &= p == p[got.some][got.entry]
        if same.all():
            return got
        keys = np.where(same, keys, _mix(keys + A))


# --- the parse of a slice --------------------------------------------------------------------------------------
def parse(body: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each phrase how many strings it has, how far its trigger is from its first, and the trigger's hash.

    Strings are in order, document by document, and every one is in one phrase.
    """
    out, ends, i = [], np.cumsum(sizes), 0
    while i < len(sizes):
        begin = int(ends[i - 1]) if i else 0
        j = max(i + 1, int(np.searchsorted(ends, begin + CHUNK, side="right")))
        end = int(ends[j - 1])
        # a long document is hashed in parts that share 49 bytes; a phrase that is cut there is two phrases
        cuts = range(begin, max(begin + 1, end - LEAST + 1), CHUNK) if j == i + 1 else (begin,)
        for base in cuts:
            stop = min(end, base + CHUNK + LEAST - 1) if j == i + 1 else end
            if stop - base >= LEAST:
                out.append(_parse(body[base:stop], np.minimum(ends[i:j], stop) - base))
        i = j
    kinds = (np.uint8, np.uint8, np.uint64)
    return tuple(np.concatenate([np.zeros(0, t), *(x[c] for x in out)]) for c, t in enumerate(kinds))


def _parse(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    h = gram_hashes(data)
    t = triggers(h, SIDE + 1)
    begins = np.concatenate([[0], ends[:-1]])
    strings = np.maximum(0, ends - begins - LEAST + 1)
    t = np.concatenate([t[:0], *(t[a : a + n] for a, n in zip(begins.tolist(), strings.tolist(), strict=True) if n)])
    # equal triggers of two documents are never the same place, so runs of one trigger are phrases
    start = _starts(t)
    before = np.cumsum(strings)
    which = np.searchsorted(before, start, side="right")
    first, at = start - (before - strings)[which] + begins[which], t[start]
    return np.diff(np.append(start, len(t))).astype(np.uint8), (at - first).astype(np.uint8), _mix(h[at])


@dataclass
class Runs:
    """Runs of phrases: the run of each phrase, first and last phrase of each, and two hashes of its bytes."""

    of: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    keys: np.ndarray
    other: np.ndarray


@dataclass
class Slice:
    """Some documents and their parse; first is where each phrase's first string begins."""

    body: np.ndarray
    sizes: np.ndarray
    ids: np.ndarray
    count: np.ndarray
    off: np.ndarray

    def __post_init__(self):
        self.count, self.off = self.count.astype(np.int64), self.off.astype(np.int64)
        self.ends = np.cumsum(self.sizes)
        strings = np.maximum(0, self.sizes - LEAST + 1)
        before = np.cumsum(strings)  # strings of a document and those before it
        rank = np.cumsum(self.count) - self.count
        self.which = np.searchsorted(before, rank, side="right")
        self.first = rank + (self.ends - self.sizes - before + strings)[self.which]
        self.doc = self.ids[self.which]
        self.at = self.first + self.off
        self.words = word_view(self.body)

    def runs(self) -> Runs:
        n = len(self.first)
        if not n:
            none = np.zeros(0, np.int64)
            return Runs(none, none, none, none.view(np.uint64), none.view(np.uint64))
        a, b = string_hashes_at(self.words, self.first)
        new = np.ones(n, bool)
        new[1:] = (a[:-1] & np.uint64((1 << RUN_BITS) - 1) == 0) | (self.which[1:] != self.which[:-1])
        start = np.flatnonzero(new)
        of = np.cumsum(new) - 1
        place = np.arange(n) - start[of]
        stop = np.append(start[1:], n) - 1
        last = string_hashes_at(self.words, self.first[stop] + self.count[stop] - 1)
        keys = []
        for h, end, factor in zip((a, b), last, (A, B), strict=True):
            power = np.cumprod(np.full(int(place.max()) + 1, factor))
            keys.append(_pair(np.add.reduceat(h * power[place], start), end + (stop - start).astype(np.uint64)))
        return Runs(of, start, stop, *keys)

    def run_classes(self, runs: Runs) -> Classes:
        return _exact(runs.keys, self.doc[runs.start], [runs.other])

    def open(self, answers: Answers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases in runs that an earlier document has, and of the others those whose trigger stands in two
        documents: of ordinary triggers, and of hot ones."""
        runs = self.runs()
        own = self.run_classes(runs)
        held = (answers.repeats(4, own.keys)[own.entry] | (self.doc[runs.start] > own.least[own.entry]))[runs.of]
        r = Classes.of(gram_hashes_at(self.words, self.at), self.doc)
        shared, hot = answers.triggers(r.keys)
        some = shared[r.entry] & ~held
        return np.flatnonzero(held), np.flatnonzero(some & ~hot[r.entry]), np.flatnonzero(some & hot[r.entry])

    def phrases(self, which: np.ndarray) -> Classes:
        """Classes of equal phrases, in the order of their trigger's hash."""
        first, last = self.first[which], self.first[which] + self.count[which] - 1
        parts = [self.count[which], *(self.words[p + k] for p in (first, last) for k in WORDS)]
        a, b = string_hashes_at(self.words, first)[0], string_hashes_at(self.words, last)[0]
        got = _exact(_pair(_pair(a, b), self.count[which].astype(np.uint64)), self.doc[which], parts)
        gram = gram_hashes_at(self.words, self.at[which[got.some]])
        order = np.lexsort((got.keys, gram))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return Classes(gram[order], place[got.entry], got.least[order], got.some[order], got.count[order], got.many[order])

    def strings(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, Classes, np.ndarray]:
        """Places and documents of the strings of these phrases, their classes by one hash, and the other hash."""
        n = self.count[which]
        s = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[which], n)
        doc = np.repeat(self.doc[which], n)
        a, b = string_hashes_at(self.words, s)
        return s, doc, _exact(a, doc, [self.words[s + k] for k in WORDS]), b

    def asked(self, answers: Answers, bits: int) -> Iterator[tuple[int, int, bytes]]:
        """(step, bucket, message) of steps 2 and 3."""
        _, plain, hot = self.open(answers)
        r = self.phrases(plain)
        rep = plain[r.some]
        for b, own in _buckets(r.keys, bits):
            yield 2, b, pack_phrases(self.body, self.first[rep[own]], self.count[rep[own]], self.off[rep[own]], r.least[own])
        _, _, r, other = self.strings(hot)
        yield from hash_messages(3, r, other, bits)

    def kept(self, answers: Answers) -> np.ndarray:
        """Which bytes stay."""
        held, plain, hot = self.open(answers)
        r = self.phrases(plain)
        masks = answers.masks(r.keys)[r.entry]
        whole = self.doc[plain] > r.least[r.entry]
        gone, end = [self.first[plain[whole]], self.first[held]], [(self.first + self.count - 1)[plain[whole]], (self.first + self.count - 1)[held]]
        some = ~whole & (masks > 0)
        part, masks = plain[some], masks[some]
        for k in range(SIDE + 1):
            at = self.at[part[(masks >> np.uint32(k) & np.uint32(1)).astype(bool)]] - k
            gone.append(at)
            end.append(at)
        s, doc, r, _ = self.strings(hot)
        at = s[answers.repeats(3, r.keys)[r.entry] | (doc > r.least[r.entry])]
        step = np.bincount(np.concatenate([*gone, at]), minlength=len(self.body) + 1).astype(np.int32)
        step -= np.bincount(np.concatenate([*end, at]) + LEAST, minlength=len(step)).astype(np.int32)
        return np.cumsum(step[:-1], dtype=np.int32) == 0


def _edges(keys: np.ndarray, bits: int) -> np.ndarray:
    tops = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.concatenate([np.searchsorted(keys, tops), [len(keys)]])


def _buckets(keys: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """The buckets that have some of the sorted keys, by their highest bits."""
    edges = _edges(keys, bits)
    for b in np.flatnonzero(np.diff(edges)):
        yield int(b), slice(edges[b], edges[b + 1])


def first_messages(own: Slice, bits: int) -> Iterator[tuple[int, int, bytes]]:
    """(step, bucket, message) of what a slice asks first: of triggers (step 1) and of runs (step 4).

    A trigger is 48 bits of its hash, whether many documents have it, and seven bits of about how often it stands.
    """
    r = Classes.of(gram_hashes_at(own.words, own.at), own.doc)
    often = np.minimum(127, np.ceil(8 * np.log2(np.maximum(1, r.count)))).astype(np.uint8)
    marks = r.many.astype(np.uint8) << 7 | often
    for b, part in _buckets(r.keys, bits):
        short = (r.keys[part] << np.uint64(bits) >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
        yield 1, b, np.ascontiguousarray(short).tobytes() + marks[part].tobytes()
    runs = own.runs()
    yield from hash_messages(4, own.run_classes(runs), runs.other, bits)


def hash_messages(step: int, r: Classes, other: np.ndarray, bits: int) -> Iterator[tuple[int, int, bytes]]:
    """Both hashes of each class, and its smallest document."""
    for b, part in _buckets(r.keys, bits):
        yield step, b, r.keys[part].astype("<u8").tobytes() + other[r.some[part]].astype("<u8").tobytes() + r.least[part].astype("<i8").tobytes()


@dataclass
class Answers:
    """What buckets said to a slice: step to bucket to message."""

    by_step: dict[int, dict[int, bytes]]
    bits: int

    def _spread(self, step: int, keys: np.ndarray, kind: str, unpack=lambda x, n: x) -> np.ndarray:
        edges, out = _edges(keys, self.bits), np.zeros(len(keys), kind)
        for b, packed in self.by_step.get(step, {}).items():
            out[edges[b] : edges[b + 1]] = unpack(packed, edges[b + 1] - edges[b])
        return out

    def triggers(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        got = self._spread(1, keys, "u1", lambda x, n: np.frombuffer(x, np.uint8, n))
        return got > 0, got > 1

    def masks(self, keys: np.ndarray) -> np.ndarray:
        return self._spread(2, keys, "u4", lambda x, n: np.frombuffer(x, "<u4", n))

    def repeats(self, step: int, keys: np.ndarray) -> np.ndarray:
        return self._spread(step, keys, "?", lambda x, n: np.frombuffer(x, np.bool_, n))


# --- what buckets do -------------------------------------------------------------------------------------------
def answer_triggers(messages: list[bytes], hot: int) -> list[bytes]:
    """For each key 0 if one document has it, 1 if several have, 2 if it also stands in very many places."""
    keys, marks, n = [], [], []
    for x in messages:
        k = len(x) // 7
        full = np.zeros((k, 8), np.uint8)
        full[:, :6] = np.frombuffer(x, np.uint8, 6 * k).reshape(k, 6)
        keys.append(full.view("<u8").ravel())
        marks.append(np.frombuffer(x, np.uint8, k, 6 * k))
        n.append(k)
    key, mark = np.concatenate(keys), np.concatenate(marks)
    order = np.argsort(key)
    start = _starts(key[order])
    size = np.diff(np.append(start, len(key)))
    shared = (size > 1) | (np.maximum.reduceat(mark[order], start) > 127)
    often = np.add.reduceat(2.0 ** ((mark[order] & 127) / 8), start)
    state = np.where(shared, np.where(often > hot, 2, 1), 0).astype(np.uint8)
    out = np.empty(len(key), np.uint8)
    out[order] = np.repeat(state, size)
    return [x.tobytes() for x in np.split(out, np.cumsum(n)[:-1])]


def pack_phrases(body: np.ndarray, first: np.ndarray, count: np.ndarray, off: np.ndarray, doc: np.ndarray) -> bytes:
    n = count + LEAST - 1
    kind = np.int32 if max(len(body), n.sum()) < 1 << 31 else np.int64
    flat = np.arange(n.sum(), dtype=kind) + np.repeat((first - (np.cumsum(n) - n)).astype(kind), n)
    head = np.array([len(first)], "<u4").tobytes() + doc.astype("<i8").tobytes()
    return head + count.astype(np.uint8).tobytes() + off.astype(np.uint8).tobytes() + body[flat].tobytes()


def _sorted_with_lcp(words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The order of strings of words, and how many bytes each has in common with the one before it."""
    order = np.lexsort(words[::-1])
    common, alike = np.zeros(len(order), np.int64), np.ones(len(order), bool)
    for w in words:
        x = w[order]
        x[1:] ^= x[:-1].copy()
        for b in range(1, 9):  # how many of its highest bytes are equal
            common += alike & (x < np.uint64(1 << 8 * (8 - b)))
        alike &= x == 0
    common[:1] = -1
    return order, common


def answer_phrases(messages: list[bytes]) -> list[bytes]:
    """For each phrase a bit for each string of it, by the bytes to the left of the trigger: whether another phrase
    of a smaller document has it."""
    docs, counts, offs, flat, n = [], [], [], [np.zeros(MARGIN, np.uint8)], []
    for x in messages:
        k = int(np.frombuffer(x, "<u4", 1)[0])
        docs.append(np.frombuffer(x, "<i8", k, 4))
        counts.append(np.frombuffer(x, np.uint8, k, 4 + 8 * k))
        offs.append(np.frombuffer(x, np.uint8, k, 4 + 9 * k))
        flat.append(np.frombuffer(x, np.uint8, offset=4 + 10 * k))
        n.append(k)
    doc, count, off = np.concatenate(docs), np.concatenate(counts).astype(np.int64), np.concatenate(offs).astype(np.int64)
    text = np.concatenate([*flat, np.zeros(MARGIN, np.uint8)])
    size = count + LEAST - 1
    at = MARGIN + np.cumsum(size) - size + off  # of the triggers
    masks = _runs(text, at, off, size - off, doc, off - count + 1)
    return [x.tobytes() for x in np.split(masks, np.cumsum(n)[:-1])]


def _masked(word: np.ndarray, have: np.ndarray) -> np.ndarray:
    """Words without the bytes, from the lowest on, that a string does not have."""
    lack = (8 * (8 - np.clip(have, 0, 8))).astype(np.uint64)
    return np.where(lack == 64, np.uint64(0), word >> np.minimum(lack, 63) << np.minimum(lack, 63))


def _runs(text: np.ndarray, at: np.ndarray, left: np.ndarray, right: np.ndarray, doc: np.ndarray, least: np.ndarray) -> np.ndarray:
    """The strings of phrases with triggers at these places that are not of their run's first document, as bits.

    A phrase has so many bytes left of its trigger, and right from its trigger on; its strings begin between least and
    left bytes before the trigger.
    """
    after, before = word_view(text, ">"), word_view(text)
    follow = [_masked(after[at + 8 * j].astype(np.uint64), right - 8 * j) for j in range(7)]
    lead = [_masked(before[at - 8 * (j + 1)], left - 8 * j) for j in range(4)]
    classes = []
    for words in (lead, follow):
        order, common = _sorted_with_lcp(words)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        classes.append((place, common))
    out = np.zeros(len(at), np.uint32)
    for k in range(SIDE + 1):
        own = np.flatnonzero((left >= k) & (least <= k))
        (p, low), (q, high) = classes
        a, b = (np.cumsum(low < k) - 1)[p[own]], (np.cumsum(high < LEAST - k) - 1)[q[own]]
        some = (np.bincount(b)[b] > 1) & (np.bincount(a)[a] > 1)  # a class of one phrase has no repeat
        own, a, b = own[some], a[some], b[some]
        if not len(own):
            continue
        r = Classes.of(a * len(at) + b, doc[own])
        out[own[doc[own] > r.least[r.entry]]] |= np.uint32(1 << k)
    return out


def answer_hashes(messages: list[bytes]) -> list[bytes]:
    """For each pair of hashes whether a smaller document has the same."""
    n = [len(x) // 24 for x in messages]
    key, other, doc = (np.concatenate([np.frombuffer(x, t, k, 8 * i * k) for x, k in zip(messages, n, strict=True)]) for i, t in enumerate(("<u8", "<u8", "<i8")))
    order = np.lexsort((other, key))
    new = np.ones(len(key), bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (other[order][1:] != other[order][:-1])
    group = np.cumsum(new) - 1
    out = np.empty(len(key), bool)
    out[order] = np.minimum.reduceat(doc[order], np.flatnonzero(new))[group] < doc[order]
    return [x.tobytes() for x in np.split(out, np.cumsum(n)[:-1])]


# --- Spark -----------------------------------------------------------------------------------------------------
#: A document without an id has no smaller one before it, and comes after all others.
NO_ID = np.iinfo(np.int64).max


def _ids(ids: list) -> np.ndarray:
    return np.array([NO_ID if x is None else x for x in ids], np.int64)


def _one(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    column = column.combine_chunks()
    return pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column


def pack(docs: DataFrame) -> DataFrame:
    """Slices of documents with their parse.

    rest holds the columns other than text in Arrow's stream format.
    """
    others = [c for c in docs.columns if c != "text"]

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        texts = _one(t.column("text").cast(pa.large_binary())).fill_null(b"")
        raw = b"".join(x.as_py() for x in texts)
        sizes = np.fromiter((len(x) for x in texts.to_pylist()), np.int64, len(texts))
        count, off, _ = parse(np.frombuffer(raw, np.uint8), sizes)
        ids = _one(t.column("doc_id")).to_pylist()
        sink = pa.BufferOutputStream()
        rest = t.select(others)
        with pa.ipc.new_stream(sink, rest.schema) as w:
            w.write_table(rest)
        row = {
            "slice": pa.array([uuid.uuid4().int >> 65], pa.int64()), "ids": pa.array([ids], pa.list_(pa.int64())), "sizes": pa.array([sizes.tolist()], pa.list_(pa.int32())), "body": pa.array([raw], pa.binary()),
            "count": pa.array([count.tobytes()], pa.binary()), "off": pa.array([off.tobytes()], pa.binary()), "rest": pa.array([sink.getvalue().to_pybytes()], pa.binary()),
        }
        return pa.RecordBatch.from_arrays(list(row.values()), names=list(row))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed_memory()
        held, size = [], 0
        for part in slices(batches, SLICE // 4):
            held.append(part)
            size += part.nbytes
            if size >= SLICE:
                yield packed(held)
                held, size = [], 0
        if held:
            yield packed(held)

    return docs.mapInArrow(run, "slice long, ids array<long>, sizes array<int>, body binary, count binary, off binary, rest binary")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    keep_freed_memory()
    for batch in batches:
        for i in range(batch.num_rows):
            yield {k: batch.column(k)[i].as_py() for k in batch.schema.names}


def _read(row: dict, bits: int) -> tuple[Slice, Answers]:
    answers = Answers({}, bits)
    for x in row.get("answers") or []:
        answers.by_step.setdefault(x["step"], {})[x["bucket"]] = x["answer"]
    byte = lambda k: np.frombuffer(row[k], np.uint8)
    return Slice(byte("body"), np.array(row["sizes"], np.int64), _ids(row["ids"]), byte("count"), byte("off")), answers


class Corpus:
    """The slices of a table of documents, in a table of the session's catalog until it is dropped."""

    def __init__(self, docs: DataFrame, hot: int = HOT):
        self.spark, self.hot, self.name = docs.sparkSession, hot, f"slices_{uuid.uuid4().hex}"
        self.path = scratch(self.spark, "slices")
        size = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
        self.bits = max(1, min(MOST_BITS, int(size // BUCKET).bit_length()))
        # fewer buckets than shuffle partitions would make every join deal the slices out again
        tables = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), min(100_000, int(size // TASK) + 1))
        pack(docs).write.option("path", self.path).option("compression", "zstd").bucketBy(tables, "slice").saveAsTable(self.name)
        self.slices = self.spark.table(self.name)
        self.rest = docs.drop("text").schema
        self.told: list[DataFrame] = []

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        drop_path(self.spark, self.path)
        drop_staged(*self.told)

    def joined(self, *columns: str) -> DataFrame:
        """The slices with what buckets have told them: for each step an entry for each bucket at most."""
        told = self.told[0]
        for more in self.told[1:]:
            told = told.unionAll(more)
        own = told.groupBy("slice").agg(F.collect_list(F.struct("step", "bucket", "answer")).alias("answers"))
        return self.slices.select("slice", *columns).join(own.hint("shuffle_hash"), "slice", "left").select("slice", *columns, "answers")

    def answered(self, sent: DataFrame) -> None:
        """Let the buckets answer messages (step, bucket, slice, message)."""
        hot = self.hot
        how = {1: lambda m: answer_triggers(m, hot), 2: answer_phrases, 3: answer_hashes, 4: answer_hashes}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def out() -> pa.RecordBatch:
                step, bucket = of
                got = how[step]([m for _, m in held])
                n = len(held)
                cols = [pa.array([s for s, _ in held], pa.int64()), pa.array([step] * n, pa.int32()), pa.array([bucket] * n, pa.int32()), pa.array(got, pa.binary())]
                return pa.RecordBatch.from_arrays(cols, names=["slice", "step", "bucket", "answer"])

            of, held = None, []
            for row in _rows(batches):
                if held and (row["step"], row["bucket"]) != of:
                    yield out()
                    held = []
                of = row["step"], row["bucket"]
                held.append((row["slice"], row["message"]))
            if held:
                yield out()

        dealt = sent.repartitionById(1 << self.bits, F.col("bucket")).sortWithinPartitions("step", "bucket")
        self.told.append(stage(dealt.mapInArrow(run, "slice long, step int, bucket int, answer binary"), "answers"))

    def ask(self) -> None:
        """What the slices ask, first from their parse and then from the answers."""
        bits = self.bits

        def asking(how):
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for row in _rows(batches):
                    got = list(how(*_read(row, bits)))
                    cols = [pa.array([x[0] for x in got], pa.int32()), pa.array([x[1] for x in got], pa.int32()), pa.array([row["slice"]] * len(got), pa.int64()), pa.array([x[2] for x in got], pa.binary())]
                    yield pa.RecordBatch.from_arrays(cols, names=["step", "bucket", "slice", "message"])

            return run

        columns, message = ("ids", "sizes", "body", "count", "off"), "step int, bucket int, slice long, message binary"
        self.answered(self.slices.select("slice", *columns).mapInArrow(asking(lambda own, _: first_messages(own, bits)), message))
        self.answered(self.joined(*columns).mapInArrow(asking(lambda own, answers: own.asked(answers, bits)), message))

    def result(self, text: bool) -> DataFrame:
        """The other columns as one, n_bytes, n_removed, n_spans, kept_sha256, and if asked for the kept bytes as text."""
        bits = self.bits

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _rows(batches):
                own, answers = _read(row, bits)
                stay = own.kept(answers)
                rest = pa.ipc.open_stream(row["rest"]).read_all()
                cols: dict[str, list] = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text")}
                for end, n in zip(own.ends.tolist(), own.sizes.tolist(), strict=True):
                    here, data = stay[end - n : end], own.body[end - n : end]
                    kept = data.tobytes() if here.all() else data[here].tobytes()
                    cols["n_bytes"].append(n)
                    cols["n_removed"].append(n - len(kept))
                    cols["n_spans"].append(0 if len(kept) == n else int((~here[:1]).sum() + (here[:-1] & ~here[1:]).sum()))
                    cols["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                    cols["kept_text"].append(kept.decode("utf-8", "ignore") if text else None)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
                other = pa.StructArray.from_arrays([_one(c) for c in rest.columns], fields=list(rest.schema))
                yield pa.RecordBatch.from_arrays([other, *(pa.array(v, t) for v, t in zip(cols.values(), kinds, strict=True))], names=["row", *cols])

        kinds = {"n_bytes": T.LongType(), "n_removed": T.LongType(), "n_spans": T.LongType(), "kept_sha256": T.StringType(), "kept_text": T.StringType()}
        schema = T.StructType([T.StructField("row", self.rest), *(T.StructField(k, t) for k, t in kinds.items())])
        return self.joined("ids", "sizes", "body", "count", "off", "rest").drop("slice").mapInArrow(run, schema)


MEASURES = ("n_bytes", "n_removed", "n_spans", "kept_sha256")


def measured(docs: DataFrame, text: bool = False, hot: int = HOT) -> DataFrame:
    """(row, n_bytes, n_removed, n_spans, kept_sha256, kept_text): row holds the columns of docs but for its text.

    Every row of docs gives one row. A null text is empty; rows of one doc_id are no repeats of each other; a null
    doc_id comes after all others. Kept text leaves out the rest of a character that was cut, and is null unless it
    is asked for. Texts of any length are read whole (a document stays within a slice). Columns of any name may
    come with the documents. An empty table gives an empty result. The result is staged, and what led to it is deleted.
    """
    corpus = Corpus(docs, hot)
    try:
        corpus.ask()
        return stage(corpus.result(text), "repeats")
    finally:
        corpus.drop()


def remove_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """For each row of docs its columns but for text, and n_bytes, n_removed, n_spans and kept_sha256.

    A column of docs that is named like one of these four gives way to it. For odd rows see `measured`.
    """
    names = [c for c in docs.columns if c != "text" and c not in MEASURES]
    return measured(docs, hot=hot).select(*(F.col("row").getField(c).alias(c) for c in names), *MEASURES)


def keep_rest(docs: DataFrame) -> DataFrame:
    """The rows of docs with their text less repeats and n_chars brought up to date; rows left without text go."""
    got = measured(docs, text=True).where("n_removed < n_bytes or n_bytes = 0")
    new = {"text": F.col("kept_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
    return got.select(*(new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))
