"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For every prefix of a piece there is exactly one token that can end the encoding of that prefix. A token that ends
at byte i is that token if the last token of the prefix before it and the token itself would not be merged
differently when their bytes are encoded together. So one pass over the bytes, asking only for the tokens that end
at each byte, gives the last token of each prefix, and the encoding is read backwards from the end. A kept table of
last tokens can be extended by appended bytes, or repaired after an edit until it agrees with the old one again.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from alloyframe.llm.common import map_slices

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Words whose ids a worker remembers, the longest of them, and the pairs of tokens that it remembers.
CACHED_WORDS, CACHED_CHARACTERS, CACHED_PAIRS = 700_000, 32, 1_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class PrefixBPE:
    """A vocabulary of byte strings by rank, of which every single byte is one."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.ends = ahocorasick.Automaton()
        for token, rank in ranks.items():
            if self.merge(token) == [rank]:  # a token that merging its own bytes doesn't give never ends a prefix
                self.ends.add_word(token.decode("latin-1"), (rank, len(token)))
        self.ends.make_automaton()
        self._pairs: dict[int, bool] = {}

    def merge(self, piece: bytes) -> list[int]:
        """The encoding by merging the pair of lowest rank, leftmost first, until none is left; for short strings."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        rank = self.ranks.get
        none = 1 << 60
        pairs = [rank(parts[i] + parts[i + 1], none) for i in range(len(parts) - 1)]
        while pairs and (low := min(pairs)) != none:
            at = pairs.index(low)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = rank(parts[at - 1] + parts[at], none)
            if at < len(pairs):
                pairs[at] = rank(parts[at] + parts[at + 1], none)
        return [self.ranks[x] for x in parts]

    def pair(self, a: int, b: int) -> bool:
        """Whether b may follow a in an encoding."""
        key = a << 32 | b
        if (known := self._pairs.get(key)) is None:
            if len(self._pairs) >= CACHED_PAIRS:
                self._pairs.clear()
            known = self._pairs[key] = self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return known

    def table(self, piece: bytes) -> PrefixTable:
        return PrefixTable(self, piece)

    def encode_piece(self, piece: bytes) -> list[int]:
        """A piece that is itself a token is that token, as in the rank-file libraries; else the prefixes decide."""
        if (one := self.ranks.get(piece)) is not None:
            return [one]
        last: list[tuple[int, int]] = []
        known, pair, solved = self._pairs.get, self.pair, 0
        for end, hit in self.ends.iter(piece.decode("latin-1")):
            if end < solved:
                continue
            token, n = hit
            if n <= end:
                a = last[end - n][0]
                ok = known(a << 32 | token)
                if not (pair(a, token) if ok is None else ok):
                    continue
            last.append(hit)
            solved += 1
        return _read_back(last)


def _read_back(last: list[tuple[int, int]]) -> list[int]:
    out, i = [], len(last)
    while i:
        token, n = last[i - 1]
        out.append(token)
        i -= n
    return out[::-1]


class PrefixTable:
    """The last token of each prefix of a byte string."""

    def __init__(self, bpe: PrefixBPE, data: bytes = b""):
        self.bpe, self.data, self.last = bpe, b"", []
        self.append(data)

    def _candidates(self, data: bytes, start: int) -> list[list[tuple[int, int]]]:
        """(token, length) of the tokens that end at each byte from start on."""
        back = max(0, start - self.bpe.longest + 1)
        found: list[list[tuple[int, int]]] = [[] for _ in range(len(data) - start)]
        for end, hit in self.bpe.ends.iter(data[back:].decode("latin-1")):
            if (i := back + end - start) >= 0:
                found[i].append(hit)
        return found

    def _solve(self, i: int, candidates: list[tuple[int, int]]) -> tuple[int, int]:
        for hit in candidates:
            if hit[1] == i + 1 or self.bpe.pair(self.last[i - hit[1]][0], hit[0]):
                return hit
        raise ValueError("the vocabulary lacks a single byte")

    def append(self, more: bytes) -> None:
        """Extend the string; what was there keeps its last tokens."""
        start = len(self.data)
        self.data += more
        for k, candidates in enumerate(self._candidates(self.data, start)):
            self.last.append(self._solve(start + k, candidates))

    def edit(self, start: int, end: int, new: bytes) -> int:
        """Replace data[start:end]; returns how many prefixes were solved again.

        After the new bytes, as many equal last tokens in a row as the longest token has bytes mean that all later
        ones are equal too, since nothing further back is ever asked.
        """
        tail, old = self.data[end:], self.last[end:]
        self.data = self.data[:start] + new + tail
        del self.last[start:]
        same = solved = 0
        step = 4 * self.bpe.longest
        at = start
        while at < len(self.data):
            stop = min(len(self.data), at + step)
            for k, candidates in enumerate(self._candidates(self.data[:stop], at)):
                i = at + k
                self.last.append(self._solve(i, candidates))
                solved += 1
                j = i - start - len(new)
                same = same + 1 if j >= 0 and old[j] == self.last[-1] else 0
                if same >= self.bpe.longest:
                    self.last.extend(old[j + 1 :])
                    return solved
            at = stop
        return solved

    def ids(self) -> list[int]:
        return _read_back(self.last)


class _Words(dict):
    """Packed ids of a space and the word after it; b"" stands for a word that may not be cut off its neighbours."""

    def __init__(self, whole):
        super().__init__()
        self.whole = whole

    def __missing__(self, word: str) -> bytes:
        packed = self.whole(" " + word) if word and not word[0].isspace() and not word[-1].isspace() else b""
        if len(word) <= CACHED_CHARACTERS:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = packed
        return packed


class Codec:
    """Encoding of whole texts by a vocabulary file and the pattern that cuts a text into pieces.

    By the public pattern no piece holds a space after another character, unless both are white space. So a text is
    cut before each single space between words, and the ids of a word with its space are remembered; only new words
    and places with more white space go through the pattern. By any other pattern whole texts go through it.
    """

    def __init__(self, vocabulary: str, pattern: str):
        self.bpe = PrefixBPE(read_ranks(vocabulary))
        self.find = regex.compile(pattern).findall
        self.words = _Words(self.whole)
        self.cuts = pattern == public_tokenizers.PATTERN
        self.tokens = [self.bpe.bytes_of.get(i, b"") for i in range(max(self.bpe.bytes_of, default=-1) + 1)]

    def whole(self, text: str) -> bytes:
        ids = array("I")
        for piece in self.find(text):
            ids.extend(self.bpe.encode_piece(piece.encode("utf-8", "surrogatepass")))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def encode(self, text: str) -> np.ndarray:
        if not self.cuts:
            return np.frombuffer(self.whole(text), "<u4")
        first, *rest = text.split(" ")
        packed = list(map(self.words.__getitem__, rest))
        if b"" not in packed and not first[-1:].isspace() and first:
            return np.frombuffer(self.whole(first) + b"".join(packed), "<u4")
        out, start, joined = [], 0, [first]
        for word, got in zip(rest, packed, strict=True):
            if got and joined[-1] and not joined[-1][-1].isspace():
                out.append(self.whole((" " if start else "") + " ".join(joined)) if len(joined) > 1 or not start else self.words[joined[0]])
                joined, start = [word], 1
            else:
                joined.append(word)
        out.append(self.whole((" " if start else "") + " ".join(joined)))
        return np.frombuffer(b"".join(out), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def codec(vocabulary: str, pattern: str) -> Codec:
    return Codec(vocabulary, pattern)


def encode_documents(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN, ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row's whole text; with ids, the token ids too.

    A null or empty text has no tokens. Repeated rows are encoded each for itself, other columns are not read, and
    an empty table gives an empty result. `vocabulary` is a file name that public_tokenizers.path() finds on each
    worker, or a path.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(public_tokenizers.path(vocabulary), pattern)
        n, a, b, every = [], [], [], []
        for text in batch.column("text").to_pylist():
            got = own.encode(text or "")
            n.append(len(got))
            a.append(hashlib.sha256(got.tobytes()).hexdigest())
            b.append(hashlib.sha256(own.decode(got)).hexdigest())
            if ids:
                every.append(got.astype(np.int32))
        more = [pa.array(every, pa.list_(pa.int32()))] if ids else []
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a), pa.array(b), *more], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * ids])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    return map_slices(docs.select("doc_id", "text"), run, schema)
