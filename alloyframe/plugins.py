"""Models that the engine calls but does not hold, with plain stand-ins that need no network."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Sequence
from typing import Protocol

import numpy as np


class Extractor(Protocol):
    def __call__(self, content: bytes, name: str) -> str | None: ...  # a model's answer as JSON, or null


class Vectorizer(Protocol):
    def __call__(self, texts: Sequence[str]) -> np.ndarray: ...  # a row of floats for each text


class Verifier(Protocol):
    def __call__(self, wanted: str, found: str) -> bool: ...  # whether two names mean the same property


class PlotDetector(Protocol):
    def __call__(self, gray: np.ndarray) -> list[tuple[int, int, int, int]]: ...  # boxes (x, y, w, h)


class Generator(Protocol):
    def __call__(self, prompt: str, context: Sequence[dict]) -> str: ...  # an answer from matched items


def embedded_json(content: bytes, name: str) -> str | None:
    """Stand-in extractor: the first JSON object in the bytes, as a model would send it."""
    text = content.decode("utf-8", "replace")
    at = text.find("{")
    if at < 0:
        return None
    try:
        found, _ = json.JSONDecoder().raw_decode(text[at:])
    except ValueError:
        return None
    return json.dumps({"candidates": [{"content": {"parts": [{"text": json.dumps(found)}]}}]})


def hashed_words(texts: Sequence[str], width: int = 384) -> np.ndarray:
    """Stand-in vectorizer: counts of words by hash, of length 1."""
    out = np.zeros((len(texts), width), np.float32)
    for i, text in enumerate(texts):
        for word in re.findall(r"\w+", (text or "").lower()):
            out[i, zlib.crc32(word.encode()) % width] += 1
    norms = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norms == 0, 1, norms)


def same_words(wanted: str, found: str) -> bool:
    """Stand-in verifier: the same words in any order."""
    cut = lambda s: sorted(re.findall(r"\w+", (s or "").lower()))
    return bool(cut(wanted)) and cut(wanted) == cut(found)


def is_yes(answer: str | None) -> bool:
    """What a verifier model's answer means."""
    return (answer or "").strip().upper() == "YES"


def listing(prompt: str, context: Sequence[dict]) -> str:
    """Stand-in generator: the matched texts under the prompt."""
    return "\n".join([prompt, *(str(c.get("text") or "an image") for c in context)])
