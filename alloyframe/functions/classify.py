"""Matrix and fiber of a material from its abbreviation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from alloyframe.schema import FIBER_KEYS, MATRIX_KEYS


def first_match(text: Column, keys: Sequence[tuple[str, str]], mode: str = "parity") -> Column:
    """The label of the first key that is a substring of the text in lower case, null if there is none.

    `longest_match` tries longer keys first, so that a key is not hidden by one that is part of it.
    """
    if mode not in ("parity", "longest_match"):
        raise ValueError(f"no such mode: {mode}")
    ordered = keys if mode == "parity" else sorted(keys, key=lambda k: -len(k[0]))
    low = F.lower(text)
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for key, label in ordered:
        out = out.when(low.contains(key), label)
    return out


def matrix_of(abbreviation: Column, mode: str = "parity") -> Column:
    return first_match(abbreviation, MATRIX_KEYS, mode)


def fiber_of(abbreviation: Column, mode: str = "parity") -> Column:
    return first_match(abbreviation, FIBER_KEYS, mode)
