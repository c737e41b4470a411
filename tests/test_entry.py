import __spark_entry__ as E
from tidepool.plans import registry

CHEAP = ["word_count", "sliding_time_sum", "session_window_sum", "top_speed", "json_english_word_count"]


def test_registry_and_oracles_line_up():
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q)
    # every query but those of the optional subpackage has SQL
    own = set(registry.queries())
    assert own == set(registry.oracle_sql()) and own <= set(q) and own <= set(sql)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"user_id", "session_start", "session_end", "n_events", "value_sum"} <= set(df.columns)


def test_cheap_queries_run_on_smallest_tables(spark):
    for name in CHEAP:
        assert E.queries()[name](spark, "/root/testdata/sf0.001").count() >= 0
