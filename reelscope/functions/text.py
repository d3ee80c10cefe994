"""Text expressions: quote stripping, title keys, channel lists, tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Everything that is not a letter or a digit separates tokens.
NON_WORD = r"[^\p{L}\p{N}]+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_quotes(c) -> Column:
    """Remove every double quote."""
    return F.translate(_c(c), '"', "")


def title_key(c, sep: str = ":") -> Column:
    """Part of a title before the first separator (X5); whole title if none."""
    return F.substring_index(_c(c), sep, 1)


def parse_channels(c) -> Column:
    """Split a channel list on runs of whitespace, no empty names."""
    parts = F.split(F.regexp_replace(_c(c), r"^\s+|\s+$", ""), r"\s+")
    return F.filter(parts, lambda x: x != F.lit(""))


def normalize_text(c) -> Column:
    """Lower-case; every run of non letters/digits becomes one space; trimmed."""
    return F.trim(F.regexp_replace(F.lower(_c(c)), NON_WORD, " "))


def word_tokens(c) -> Column:
    """Tokens of raw text in one regex pass: the same tokens as
    ``tokens(normalize_text(c))`` without building the normalized string."""
    return F.array_remove(F.split(F.lower(_c(c)), NON_WORD), "")


def tokens(normalized) -> Column:
    """Tokens of an already normalized text (empty text → empty array)."""
    n = _c(normalized)
    return F.when(n == F.lit(""), F.array().cast("array<string>")).otherwise(F.split(n, " "))


def padded(normalized) -> Column:
    """' ' + text + ' ' so that a phrase test is a whole-token test."""
    return F.concat(F.lit(" "), _c(normalized), F.lit(" "))
