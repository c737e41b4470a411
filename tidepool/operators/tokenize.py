"""Flat-map tokenisers and the English-record filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import json as J
from ..functions.fixed import ENGLISH, JSON_TEXT_PATH
from ..functions.text import clean_tweet_piece, non_empty, tweet_pieces, word_pieces


def tokenize_words(df: DataFrame, text_col: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``(keep..., pos, word)``: one row per non-empty word of ``lower(text)``
    split on runs of non-word characters; ``pos`` is the piece index within
    the record, so ``(keep, pos)`` is the emission order."""
    return (
        df.select(*keep, F.posexplode(word_pieces(F.col(text_col))).alias("pos", "piece"))
        .where(non_empty(F.col("piece")))
        # never NULL after the filter; declaring it lets key-partitioned
        # operators use the plain column
        .select(*keep, "pos", F.coalesce(F.col("piece"), F.lit("")).alias("word"))
    )


def tokenize_whitespace(df: DataFrame, text_col: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``(keep..., pos, word)``: whitespace-tokenizer pieces with remaining
    whitespace removed and lower-cased; punctuation is kept."""
    return (
        df.select(*keep, F.posexplode(tweet_pieces(F.col(text_col))).alias("pos", "piece"))
        .select(*keep, "pos", F.coalesce(clean_tweet_piece(F.col("piece")), F.lit("")).alias("word"))
        .where(non_empty(F.col("word")))
    )


# the two fields the English filter reads, plus the corrupt-record slot
_FAST_SCHEMA = "text STRING, user STRUCT<lang STRING>, _corrupt STRING"


def english_records(df: DataFrame, json_col: str = "json", strict: bool = True,
                    keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Records whose ``user.lang`` is exactly ``"en"`` and that have a
    ``text`` field (present JSON ``null`` counts; its text is ``"null"``).
    Returns ``(keep..., text)``.

    Fast path: ``from_json`` with a two-field schema (a streaming parse that
    skips everything else; duplicate keys resolve last-wins, as a JSON tree
    parser does).  Exact fallbacks through ``VARIANT`` run only for rare
    rows: records ``from_json`` flags as corrupt (valid non-object JSON is
    skipped, malformed JSON fails the job in strict mode), and English
    records whose text is NULL or starts with ``{``/``[`` (JSON ``null`` vs
    missing, containers vs strings).
    """
    j = F.from_json(F.col(json_col), _FAST_SCHEMA,
                    {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    rows = df.select(*keep, F.col(json_col).alias("_json"), j.alias("_j"))
    corrupt = F.col("_j._corrupt").isNotNull()
    if strict:
        # evaluating the strict parser raises on malformed input; the
        # comparison is never true, so valid non-object records drop out
        rows = rows.where(~corrupt | (F.schema_of_variant(J.parse(F.col("_json"), True)) == F.lit("")))
    else:
        rows = rows.where(~corrupt)
    english = F.coalesce(F.col("_j.user.lang") == F.lit(ENGLISH), F.lit(False))
    text = F.col("_j.text")
    ambiguous = text.isNull() | text.startswith("{") | text.startswith("[")
    rows = rows.where(english).withColumn(
        "_v", F.when(ambiguous, J.field(J.parse(F.col("_json"), False), JSON_TEXT_PATH)))
    exact = J.as_text(F.col("_v"))
    # VARIANT rejects records with a key twice; their text is the one from_json read
    return (rows.where(~ambiguous | F.col("_v").isNotNull() | text.isNotNull())
            .select(*keep, F.when(ambiguous & F.col("_v").isNotNull(), exact).otherwise(text).alias("text")))


def tokenize_tweets(df: DataFrame, json_col: str = "json", strict: bool = True,
                    keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """English JSON records → ``(keep..., pos, word)`` whitespace tokens."""
    return tokenize_whitespace(english_records(df, json_col, strict, keep), "text", keep)
