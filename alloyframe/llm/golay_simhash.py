"""SimHash near duplicates found through the perfect binary Golay code.

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits, each padded to a 23-bit word. The Golay code
decodes any word to the index of the one codeword within three bits of it. The keys of a segment are the indices of
all words within one bit of it: one index, or six. Segments that differ in two bits or fewer have a word within one
bit of both, and so share a key.

Fingerprints that differ in four bits or fewer meet in one of two ways (pigeonhole):
- a segment is equal, and then one of the other two differs in two bits at most: keys (equal segment, key of other);
- every segment differs, and then none by more than two bits: keys (key, key, key).
Each fingerprint gives about 180 keys of 33 or 36 bits, so that a bucket stays small as the corpus grows. Buckets are
formed by one sort on the key and searched breadth first, which gives links enough to connect what is connected
and never all pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alloyframe.llm.common import components, kept_rows, map_slices, maybe_broadcast, row_key, stage, utf8
from alloyframe.sources.scratch import scratch, temporary

SEED, SHINGLE, BITS = 42, 4, 4
#: First bit and width of each segment.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Generator polynomial x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 of the (23, 12) code.
GENERATOR = 0b110001110101
#: Fingerprints whose keys one task makes, about.
KEYED = 20_000
#: Groups of a bucket up to this size are compared by offsets, larger ones breadth first.
SMALL = 8


# --- fingerprints ----------------------------------------------------------------------------------------------
def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Majority of the bits of the shingles' hashes; without words zero."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    stops = ends[shingle - 1 :].tolist() or [len(joined)]
    starts = [0, *(ends[: len(stops) - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(stops), 1 << 16):
        h = np.array([digest(joined[a:b], seed) for a, b in zip(starts[at : at + (1 << 16)], stops[at : at + (1 << 16)], strict=True)], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(stops), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long; a null text has no words."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = np.array([fingerprint(x) for x in utf8(batch.column("text"))], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp)], names=["doc_id", "fp"])

    return map_slices(docs.select("doc_id", "text"), run, "doc_id long, fp long")


# --- keys ------------------------------------------------------------------------------------------------------
@lru_cache(maxsize=1)
def decoder() -> np.ndarray:
    """The codeword index of every 23-bit word."""
    message = np.arange(4096, dtype=np.int64)
    rest = message << 11
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ GENERATOR << (bit - 11), rest)
    code = message << 11 | rest
    one = 1 << np.arange(23)
    errors = {0} | {int(a | b | c) for a in one for b in one for c in one}  # all of weight 1 to 3
    table = np.full(1 << 23, -1, np.int16)
    for e in errors:
        table[code ^ e] = message
    return table


def segment_keys(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices within one bit of each value, six columns, and which of them count."""
    near = np.concatenate([values[:, None], values[:, None] ^ (1 << np.arange(width))], axis=1)
    got = np.sort(decoder()[near], axis=1).astype(np.int64)
    new = np.concatenate([np.ones((len(got), 1), bool), got[:, 1:] != got[:, :-1]], axis=1)
    place = np.cumsum(new, axis=1) - 1
    out, on = np.zeros((len(got), 6), np.int64), np.zeros((len(got), 6), bool)
    row, col = np.nonzero(new)
    out[row, place[row, col]], on[row, place[row, col]] = got[row, col], True
    return out, on


def keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) pairs of an array of fingerprints."""
    parts = [(fp.view(np.uint64) >> np.uint64(a) & np.uint64((1 << w) - 1)).astype(np.int64) for a, w in SEGMENTS]
    near = [segment_keys(v, w) for v, (_, w) in zip(parts, SEGMENTS, strict=True)]
    rows, out = [], []
    for i, value in enumerate(parts):
        for j, (index, on) in enumerate(near):
            if i != j:
                row, col = np.nonzero(on)
                rows.append(row)
                out.append((3 * i + j) << 36 | value[row] << 12 | index[row, col])
    (a, a_on), (b, b_on), (c, c_on) = near
    row, x, y, z = np.nonzero(a_on[:, :, None, None] & b_on[:, None, :, None] & c_on[:, None, None, :])
    rows.append(row)
    out.append(9 << 36 | a[row, x] << 24 | b[row, y] << 12 | c[row, z])
    return np.concatenate(rows), np.concatenate(out)


def _key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            fp = batch.column("fp").slice(at, 1000).to_numpy(zero_copy_only=False)
            row, key = keys(np.ascontiguousarray(fp))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[row])], names=["key", "fp"])


# --- links -----------------------------------------------------------------------------------------------------
def _differ(a: np.ndarray, b: np.ndarray | np.int64) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))


def forest(fp: np.ndarray, most: int = BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what links of `most` bits connect, each value reached once."""
    out, rest = [], fp
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            hit = _differ(rest, at) <= most
            if hit.any():
                found, rest = rest[hit], rest[~hit]
                out.append((np.full(len(found), at), found))
                queue.extend(found)
    return out


def links(key: np.ndarray, fp: np.ndarray, most: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links within the buckets of sorted whole buckets."""
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(start, len(key)))
    many = size > 1
    if not many.any():
        return fp[:0], fp[:0]
    a, b = [], []
    keep = np.repeat(many & (size <= SMALL), size)
    k, f = key[keep], fp[keep]
    for off in range(1, min(SMALL, len(k))):
        x, y = f[:-off], f[off:]
        hit = np.flatnonzero((k[:-off] == k[off:]) & (_differ(x, y) <= most))
        a.append(x[hit])
        b.append(y[hit])
    for g in np.flatnonzero(size > SMALL):
        for x, y in forest(np.unique(fp[start[g] : start[g] + size[g]]), most):
            a.append(x)
            b.append(y)
    return (np.concatenate(a), np.concatenate(b)) if a else (fp[:0], fp[:0])


def _link_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of rows sorted by key; the last bucket of a batch waits for the next batch."""
    key, fp = np.zeros(0, np.int64), np.zeros(0, np.int64)
    waiting: list[tuple[np.ndarray, np.ndarray]] = []

    def batch_of(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        pair = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], axis=1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pair[:, 0])), pa.array(np.ascontiguousarray(pair[:, 1]))], names=["a", "b"])

    for batch in batches:
        k, f = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "fp"))
        if not len(k):
            continue
        waiting.append((k, f))
        if k[0] == k[-1] and waiting[0][0][0] == k[0]:
            continue  # one bucket so far
        key, fp = (np.concatenate(x) for x in zip(*waiting, strict=True))
        last = np.searchsorted(key, key[-1])
        yield batch_of(*links(key[:last], fp[:last]))
        waiting = [(key[last:], fp[last:])]
    if waiting:
        key, fp = (np.concatenate(x) for x in zip(*waiting, strict=True))
        yield batch_of(*links(key, fp))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fp and component_id: the smallest doc_id that links of four differing bits or fewer reach.

    Reads doc_id and text only. Null and wordless texts have fingerprint zero and link like any other; repeated
    rows and equal texts share a fingerprint and so a component; texts are read whole; an empty table gives an
    empty result. What is compared are distinct fingerprints, so a group of copies of any size is one of them.
    """
    marked = stage(fingerprints(docs), "fingerprints")
    nodes = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    # a fingerprint makes some 180 rows, so that few files of fingerprints are many tasks' work
    spread = nodes.select("fp").repartition(max(docs.sparkSession.sparkContext.defaultParallelism, nodes.count() // KEYED))
    rows = spread.mapInArrow(_key_rows, "key long, fp long")
    found = rows.repartition("key").sortWithinPartitions("key").mapInArrow(_link_rows, "a long, b long")
    roots = stage(components(found, "a", "b"), "roots")
    if roots.isEmpty():
        grouped = nodes.select("fp", F.col("least").alias("component_id"))
    else:
        known = nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
        known = stage(known, "members")
        first = stage(known.groupBy("root").agg(F.min("least").alias("component_id")), "firsts")
        grouped = known.join(first, "root").select("fp", "component_id")
    grouped = stage(grouped, "components")
    return marked.join(maybe_broadcast(grouped, 100_000), "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of docs whose doc_id is the first of its component.

    Rows without a doc_id are named by their text and come after all others; of any name are further columns.
    """
    place = scratch(docs.sparkSession, "near-copies")
    with temporary(docs.sparkSession):
        own = near_duplicates(docs.select(row_key().alias("doc_id"), "text"))
        gone = stage(own.where("doc_id != component_id").select(F.col("doc_id").alias("key")).distinct(), "near-copies", place)
    return kept_rows(docs, gone).select("row.*")
