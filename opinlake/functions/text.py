"""Text measures of a review as column expressions."""

from __future__ import annotations

import operator
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The word lists of the keyword flags.
POSITIVE_WORDS = (
    "great", "excellent", "amazing", "good", "perfect", "love", "tasty", "fresh", "recommend",
)
NEGATIVE_WORDS = (
    "bad", "terrible", "awful", "disappointed", "stale", "broken", "poor", "worst", "expired",
    "disgusting",
)

# What makes up a word: letters, decimal digits, combining marks, underscore. Spelled out
# because the meaning of \b differs between JVM versions.
WORD_CHARS = r"\p{L}\p{Nd}\p{Mn}_"

# White space in the wide sense (Unicode), as a regex class body and as plain characters.
WIDE_SPACE = (
    r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WIDE_SPACE_CHARS = "".join(
    chr(code)
    for code in (
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
        0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    )
)


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def text_length(text: Column) -> Column:
    """Number of characters; NULL counts as empty."""
    return F.length(text_or_empty(text)).cast("int")


def word_count(text: Column) -> Column:
    """Words between runs of white space. Only blanks are trimmed first, so a text that
    begins or ends with a line break or tab counts one more word on that side."""
    trimmed = F.trim(text_or_empty(text))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, r"\s+"))).cast("int")


def word_count_strict(text: Column) -> Column:
    """Words between runs of white space, none of it counted at either end."""
    text = text_or_empty(text)
    pieces = F.size(F.split(text, f"[{WIDE_SPACE}]+"))

    def blank_edge(edge: Column) -> Column:
        return F.contains(F.lit(WIDE_SPACE_CHARS), edge).cast("int")

    # White space at an edge splits off an empty piece there.
    edges = blank_edge(F.substring(text, 1, 1)) + blank_edge(F.substring(text, -1, 1))
    return F.when(text == "", 0).otherwise(pieces - edges).cast("int")


def strip(text: Column) -> Column:
    """Drop white space of every kind from both ends."""
    return F.btrim(text, F.lit(WIDE_SPACE_CHARS))


def has_visible_text(text: Column) -> Column:
    """At least one character that is not white space; false for NULL."""
    return F.coalesce(text.rlike(f"[^{WIDE_SPACE}]"), F.lit(False))


def has_nonblank_text(text: Column) -> Column:
    """At least one character that is not a plain blank; false for NULL."""
    return F.coalesce(F.trim(text) != "", F.lit(False))


def whole_word_pattern(words: Sequence[str]) -> str:
    choice = "|".join(re.escape(word.lower()) for word in words)
    return f"(?<![{WORD_CHARS}])(?:{choice})(?![{WORD_CHARS}])"


def mentions_any(text: Column, words: Sequence[str]) -> Column:
    """Whether one of `words` stands in the text as a whole word, in any case.

    The plain substring tests come first: they are far cheaper than the pattern and rule
    out most texts, so the pattern runs only where some word may be present.
    """
    lowered = F.lower(text_or_empty(text))
    somewhere = reduce(operator.or_, (F.contains(lowered, F.lit(w.lower())) for w in words))
    return somewhere & lowered.rlike(whole_word_pattern(words))
