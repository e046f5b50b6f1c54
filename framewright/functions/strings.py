"""String functions (T1-T11).  All run inside generated code; no Python per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def capitalise_words(c: Column) -> Column:
    """First letter of each blank-separated word upper case, the rest lower case."""
    return F.initcap(c)


def lower(c: Column) -> Column:
    """T2."""
    return F.lower(c)


def upper(c: Column) -> Column:
    """T2."""
    return F.upper(c)


def trims(c: Column) -> tuple[Column, Column, Column]:
    """Left, right and both-sides trim of blanks."""
    return F.ltrim(c), F.rtrim(c), F.trim(c)


def pad_left(c: Column, width: int, fill: str = " ") -> Column:
    """T4: a shorter width cuts the text to ``width`` characters."""
    return F.lpad(c, width, fill)


def pad_right(c: Column, width: int, fill: str = " ") -> Column:
    """T5."""
    return F.rpad(c, width, fill)


def replace_words(c: Column, words: Sequence[str], replacement: str) -> Column:
    """Replace every occurrence of any of the words (regex alternation; words and the
    replacement are taken literally).  No words: the text is unchanged."""
    import re
    words = [w for w in words if w]
    if not words:
        return c
    pattern = "|".join(re.escape(w) for w in words)
    literal = replacement.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(c, pattern, literal)


def translate_chars(c: Column, source: str, target: str) -> Column:
    """Character-wise map; characters of ``source`` without a partner are deleted."""
    return F.translate(c, source, target)


def extract_first(c: Column, words: Sequence[str]) -> Column:
    """First occurrence of any of the words, empty string when none matches."""
    import re
    words = [w for w in words if w]
    if not words:
        return F.when(c.isNotNull(), F.lit(""))
    pattern = "(" + "|".join(re.escape(w) for w in words) + ")"
    return F.regexp_extract(c, pattern, 1)


def position(c: Column, needle: str) -> Column:
    """1-based position of ``needle``, 0 when absent."""
    return F.instr(c, needle)


def contains_flag(c: Column, needle: str) -> Column:
    """``locate`` cast to boolean."""
    return F.locate(needle, c).cast("boolean")


def split_pattern(c: Column, pattern: str) -> Column:
    """Array of the pieces between matches of ``pattern``."""
    return F.split(c, pattern)
