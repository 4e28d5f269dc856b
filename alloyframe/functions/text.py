"""Text expressions: white space as Unicode has it, captions, abbreviations, defaults."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from alloyframe.schema import CAPTION, CAPTION_WORDS, PLOT_WORDS, STOP_WORDS


def strip(c: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squash(c: Column) -> Column:
    """Words with one space between."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def one_line(c: Column) -> Column:
    return F.translate(c, "\n", " ")


def words(c: Column) -> Column:
    return F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")


def without_parentheses(c: Column) -> Column:
    return F.translate(c, "()", "")


def or_default(c: Column, default: str) -> Column:
    """The value, or the default where it is null or empty."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))


def abbreviation(name: Column) -> Column:
    """Upper-case initials of the words that begin with a letter; else the first six characters; UNKNOWN for no name."""
    initials = F.upper(F.array_join(F.transform(F.filter(words(name), lambda w: w.rlike(r"^\p{L}")), lambda w: F.substring(w, 1, 1)), ""))
    return F.when(F.coalesce(name, F.lit("")) == "", "UNKNOWN").otherwise(F.coalesce(F.nullif(initials, F.lit("")), F.upper(F.substring(name, 1, 6))))


def file_stem(path: Column) -> Column:
    """The file's name without its ending, spaces as underscores."""
    return F.replace(F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1), F.lit(" "), F.lit("_"))


def is_caption(c: Column) -> Column:
    return c.rlike(CAPTION)


def speaks_of_a_plot(c: Column) -> Column:
    return c.rlike(PLOT_WORDS)


def any_in(text: Column, parts: Sequence[str]) -> Column:
    """Whether one of the parts is a substring."""
    return F.exists(F.array(*map(F.lit, parts)), lambda p: text.contains(p))


def caption_fits(caption: Column, prop: Column, table: Sequence[tuple[str, Sequence[str]]] = CAPTION_WORDS, stop: Sequence[str] = STOP_WORDS) -> Column:
    """Whether a caption speaks of a property: by its name, by a word that stands for it, or by two words in common."""
    cap, name = F.lower(caption), F.lower(prop)
    fits = cap.contains(name)
    for key, parts in table:
        fits = fits | (name.contains(key) & any_in(cap, parts))
    common = F.array_intersect(words(without_parentheses(cap)), words(without_parentheses(name)))
    return fits | (F.size(F.array_except(common, F.array(*map(F.lit, stop)))) >= 2)
