import pytest

from fixtures import TWEET_COUNTS, TWEETS
from tidepool.operators.rolling import rolling_sum
from tidepool.operators.tokenize import english_records, tokenize_tweets
from tidepool.sources.records import from_elements


def recs(spark, values):
    return from_elements(spark, values, "json").withColumnRenamed("seq", "doc_id")


def test_tweets_rolling_golden(spark):
    toks = tokenize_tweets(recs(spark, TWEETS))
    out = rolling_sum(toks, ["word"], ["doc_id", "pos"])
    assert sorted((r.word, r.n) for r in out.collect()) == TWEET_COUNTS


def test_json_edges(spark):
    docs = [
        '{"user": {"lang": "en"}}',                     # no text -> no rows
        '{"text": null, "user": {"lang": "en"}}',       # JSON null -> word "null"
        '{"text": 5, "user": {"lang": "en"}}',          # number -> "5"
        '{"text": "x", "user": 3}',                     # user not an object
        '{"text": "x", "user": {"lang": null}}',        # lang null
        '{"text": "x", "user": {"lang": "EN"}}',        # case-sensitive
        '{"text": {"a": 1}, "user": {"lang": "en"}}',   # object text -> "" -> no tokens
    ]
    out = english_records(recs(spark, docs)).orderBy("doc_id").collect()
    assert [(r.doc_id, r.text) for r in out] == [(1, "null"), (2, "5"), (6, "")]
    assert sorted(r.word for r in tokenize_tweets(recs(spark, docs)).collect()) == ["5", "null"]


def test_malformed_json_strict_fails_permissive_skips(spark):
    df = recs(spark, ['{"text": "ok", "user": {"lang": "en"}}', "{not json"])
    with pytest.raises(Exception):
        english_records(df).collect()
    assert [r.text for r in english_records(df, strict=False).collect()] == ["ok"]


def test_json_fast_path_edges(spark):
    docs = [
        "5", "[1, 2]", "null", '"x"',                                   # valid JSON, not objects: skipped
        '{"text": "a", "text": "b", "user": {"lang": "en"}}',         # duplicate keys: last wins
        '{"text": "{not an object}", "user": {"lang": "en"}}',        # a string that looks like one
        '{"text": ["a"], "user": {"lang": "en"}}',                    # array text: empty text
        '  {"text": "Hi There", "user": {"lang": "en", "x": [1]}}  ', # padding, extra fields
        '{"text": "z", "user": {"lang": ["en"]}}',                    # lang not a string
    ]
    out = english_records(recs(spark, docs)).orderBy("doc_id").collect()
    assert [(r.doc_id, r.text) for r in out] == [(4, "b"), (5, "{not an object}"), (6, ""), (7, "Hi There")]
