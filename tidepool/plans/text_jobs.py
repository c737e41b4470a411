"""Word-count jobs over the ``documents`` table (and its JSON form).

Every plan reads only the columns it needs, so the Parquet scan's
``ReadSchema`` is ``doc_id, text`` (plus ``lang`` for the JSON jobs).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import (COUNT_WINDOW_SIZE, COUNT_WINDOW_SLIDE, WINDOW_WORDS_SIZE,
                               WINDOW_WORDS_SLIDE)
from ..operators.count_window import count_window
from ..operators.rolling import keyed_totals, rolling_sum
from ..operators.tokenize import english_records, tokenize_tweets, tokenize_words
from ..operators.user_functions import flat_map
from ..sources.records import json_records
from ..sources.tables import read_table, spread

ORDER = ["doc_id", "pos"]
DOCS_PER_BLOCK = 500   # blocks are cut on doc_id; a document holds hundreds of tokens


def documents(spark: SparkSession, sf_dir: str, columns=("doc_id", "text")) -> DataFrame:
    return spread(read_table(spark, sf_dir, "documents", list(columns)), key="doc_id")


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, pos, word)`` tokens of every document."""
    return tokenize_words(documents(spark, sf_dir))


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final count per word."""
    return keyed_totals(words(spark, sf_dir), ["word"], name="n")


def word_count_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-token running count of its word in (doc_id, pos) order."""
    docs = documents(spark, sf_dir)
    return rolling_sum(tokenize_words(docs), ["word"], ORDER, name="n", block_source=docs,
                       min_rows_per_block=DOCS_PER_BLOCK)


def _count_window_words(spark: SparkSession, sf_dir: str, size: int, slide: int) -> DataFrame:
    docs = documents(spark, sf_dir)
    return count_window(tokenize_words(docs), ["word"], ORDER, size, slide, name="n", block_source=docs,
                        min_rows_per_block=DOCS_PER_BLOCK)


def count_window_sum_10_5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _count_window_words(spark, sf_dir, COUNT_WINDOW_SIZE, COUNT_WINDOW_SLIDE)


def count_window_sum_6_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _count_window_words(spark, sf_dir, WINDOW_WORDS_SIZE, WINDOW_WORDS_SLIDE)


def count_window_tumbling_5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``slide == size``: tumbling count windows."""
    return _count_window_words(spark, sf_dir, 5, 5)


# JSON ("tweet") path -------------------------------------------------------

def tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return json_records(documents(spark, sf_dir, ("doc_id", "text", "lang")))


def json_language_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English records with a text field: ``(doc_id, text)``."""
    return english_records(tweets(spark, sf_dir))


def tokenize_tweets_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize_tweets(tweets(spark, sf_dir))


def json_english_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_totals(tokenize_tweets(tweets(spark, sf_dir)), ["word"], name="n")


def json_english_word_count_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, ("doc_id", "text", "lang"))
    toks = tokenize_tweets(json_records(docs))
    return rolling_sum(toks, ["word"], ORDER, name="n", block_source=docs, min_rows_per_block=DOCS_PER_BLOCK)


def tokenize_words_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words(spark, sf_dir)


def _word_tuples(text):
    """A user's tokenizer: one record in, any number of tuples out."""
    import re

    if text is not None:
        for pos, word in enumerate(re.split(r"\W+", text.lower(), flags=re.ASCII)):
            if word:
                yield pos, word


def flat_map_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The word tokenizer as a user's Python flat-map."""
    return flat_map(documents(spark, sf_dir), _word_tuples, ["text"], "pos int, word string").drop("text")


def word_lengths_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed sum of a value (token length) -- the reduce path with a
    non-constant measure."""
    return keyed_totals(words(spark, sf_dir).withColumn("len", F.length("word")), ["word"],
                        F.col("len").cast("long"), name="chars")


# text sink / text source round trip ----------------------------------------

def _written_word_counts(spark: SparkSession, sf_dir: str) -> str:
    from ..session import scratch_path
    from ..sinks.tuple_text import write_tuple_text

    path = scratch_path(spark, "word-count-text")
    write_tuple_text(word_count(spark, sf_dir), path, ["word", "n"])
    return path


def src_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts written as tuple text, read back line by line."""
    from ..sources.records import text_lines

    return text_lines(spark, _written_word_counts(spark, sf_dir)).select("line")


def sink_tuple_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts through the tuple text sink and back: ``(word, n)``."""
    from ..sinks.tuple_text import parse_tuple_line
    from ..sources.records import text_lines

    lines = text_lines(spark, _written_word_counts(spark, sf_dir))
    return lines.select(*parse_tuple_line("line"))
