"""Column expressions for tokenising text.  All are JVM built-ins (codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import TWEET_DELIMITER_PATTERN, TWEET_STRIP_PATTERN, WORD_SPLIT_PATTERN


def word_pieces(text: Column) -> Column:
    """``lower(text)`` split on runs of non-word characters (keeps empties)."""
    return F.split(F.lower(text), WORD_SPLIT_PATTERN, -1)


def tweet_pieces(text: Column) -> Column:
    """``text`` split on whitespace-tokenizer delimiters (keeps empties)."""
    return F.split(text, TWEET_DELIMITER_PATTERN, -1)


def clean_tweet_piece(piece: Column) -> Column:
    """Remove remaining whitespace, then lower-case (in that order)."""
    return F.lower(F.regexp_replace(piece, TWEET_STRIP_PATTERN, ""))


def non_empty(c: Column) -> Column:
    return F.length(c) > 0
