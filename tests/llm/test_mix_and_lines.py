import pandas as pd
import pytest

from tidepool.llm import line_dedup as L
from tidepool.llm import queries as Q
from tidepool.llm import sql
from tidepool.llm import wfq_mix as M

from .util import duck, spark_rows

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op2_line_dedup", "op5_mix_sources"])
def test_query_equals_sql(spark, name):
    assert spark_rows(Q.queries()[name](spark, SMALL)) == duck(Q.oracle_sql()[name], SMALL)


ODD = [(1, "a b c", "x"), (2, None, "x"), (3, "", "y"), (4, "one two\nthree", None), (None, "q q", "x"), (1, "a b c", "x"),
       (5, " \n\t", "z"), (5, " \n\t", "z"), (6, "w " * 30000, "y")] + [(i, "menu\nbody %d\n menu " % i, "big") for i in range(10, 60)]


def test_mix_odd_rows(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string, source string")
    want = duck(sql.OP5, documents=pd.DataFrame(ODD, columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"}))
    for rows in (4, 1000):
        assert spark_rows(M.mix_sources(df, rows_per_block=rows)) == want
    assert M.mix_sources(df.limit(0)).count() == 0


def test_mix_comes_near_targets(spark):
    out = M.mix_sources(spark.read.parquet(f"{SMALL}/documents.parquet"), rows_per_block=8).toPandas()
    assert (out.taken <= 2 * out["size"]).all()
    for _, g in out.groupby(["source_size", "target"]):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= 2 * out["size"].max()


def test_lines_odd_rows(spark):
    df = spark.createDataFrame([(d, t, s, 9) for d, t, s in ODD], "doc_id long, text string, source string, host int")
    got = L.drop_boilerplate(df, "source", dropped="n_dropped")
    assert got.columns == ["doc_id", "text", "source", "host", "n_dropped"]
    want = duck(sql.OP2, documents=pd.DataFrame(ODD, columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"}))
    assert spark_rows(got.select("doc_id", "text", "n_dropped")) == want
    assert L.drop_boilerplate(df.limit(0), "source").count() == 0


def test_a_copied_page_keeps_its_lines(spark):
    rows = [(i, "one page\nof two lines", "s") for i in range(90)] + [(100 + i, f"menu\npage {i}", "s") for i in range(60)]
    out = L.drop_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert {r.text for r in out.collect()} == {"one page\nof two lines"} | {f"page {i}" for i in range(60)}


def test_host_of(spark):
    df = spark.createDataFrame([("http://u@WWW.a.Org:80/x?y",), ("nope",), (None,)], "url string")
    assert [r[0] for r in df.select(L.host_of("url")).collect()] == ["a.org", "", None]
