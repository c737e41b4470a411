from html.parser import HTMLParser

import numpy as np
import pytest

from tidepool.llm import main_text as H
from tidepool.llm import queries as Q
from tidepool.llm import sql
from tidepool.llm import voronoi_knn as V
from tidepool.sources.tables import read_table

from .util import duck, spark_rows

SMALL = "/root/testdata/sf0.001"


class Article(HTMLParser):
    """Text of the first article element, block by block."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.on, self.blocks, self.run, self.skip = False, [], [], 0

    def cut(self):
        if t := " ".join("".join(self.run).split()):
            self.blocks.append(t)
        self.run = []

    def handle_starttag(self, tag, attrs):
        self.on |= tag == "article"
        if tag == "footer":
            self.skip += 1
        if tag in ("p", "h1", "article", "footer"):
            self.cut()
        if tag == "br":
            self.run.append(" ")

    def handle_endtag(self, tag):
        if tag in ("p", "h1", "article", "footer"):
            self.cut()
        if tag == "footer":
            self.skip -= 1
        if tag == "article":
            self.on = False

    def handle_data(self, data):
        if self.on and not self.skip:
            self.run.append(data)


def test_pages_equal_plain_reading(spark):
    for r, t in zip(read_table(spark, SMALL, "pages").orderBy("page_id").collect(), Q.op3_main_text(spark, SMALL).orderBy("page_id").collect(), strict=True):
        a = Article()
        a.feed(r.html)
        a.close()
        a.cut()
        assert t.text == "\n".join(a.blocks) and t.n_chars == len(t.text) and t.url == r.url


def site(i, main, extra=""):
    return f"""<html><head><title>T</title><script>if(a<b){{"</p>"}}</script></head><body class="p{i}">
<header><a href=/>Home</a> Daily</header><div id="cookie-notice">We use cookies &amp; such, a lot of them, everywhere and always.</div>
<div class="wrap"><div class="post post-{i}"><h1>Title&nbsp;{i}</h1>{main}</div><div class="sidebar"><p>{'popular links ' * 30}</p></div>{extra}
<form><p>Your name</p><input name=q></form><div class="comments"><p>{'First! great post ' * 20}</p></div></div>
<div class="ad-slot">buy</div><footer>&copy; x</footer></body></html>"""


def test_consensus_and_odd_pages(spark):
    rows = [(i, f"http://A.org/{i}", site(i, f"<p>One&lt;{i}&gt;  text <b>bold</b>,<br>more\n words.<p>Two <i>x</i><ul><li>a<li>b</ul><!-- c --><style>p{{}}</style>")) for i in range(6)]
    rows += [(10, "http://a.org/z", site(7, "<p>short")), (11, None, "<p>lone &eacute;"), (12, "http://a.org/e", None), (13, "x", ""), (14, "http://b.org/", "plain <b>text"),
             (14, "http://b.org/", "plain <b>text"), (None, "http://b.org/l", "<article><p>" + "w " * 50000 + "</article>"), (15, "http://c.org/", "<div>" * 300 + "deep" + "</div>" * 300),
             (16, "http://c.org/q", "<p title='a>b'>c < d <e")]
    got = {(r.page_id, r.url): r.text for r in H.main_text(spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, host string")).collect()}
    for i in range(6):
        assert got[i, f"http://A.org/{i}"] == f"Title {i}\nOne<{i}> text bold, more words.\nTwo x\na\nb"
    assert got[10, "http://a.org/z"] == "Title 7\nshort" and got[11, None] == "lone é" and got[12, "http://a.org/e"] == got[13, "x"] == ""
    assert got[14, "http://b.org/"] == "plain text" and got[None, "http://b.org/l"] == " ".join(["w"] * 50000) and got[15, "http://c.org/"] == "deep"
    assert got[16, "http://c.org/q"].startswith("c < d")


ARTICLE = '<article><h1>T</h1><p>Body text here</p><section id="related-work"><p>Related</p></section></article>'


@pytest.mark.parametrize("name", ["no-sidebar", "has-sidebar", "post comments-open", "content-area with-sidebar", "site nav-open", "entry social-policy", "menu-page", "page alerts-on", "sidebar"])
def test_names_that_are_no_furniture(name):
    """Nor does a furniture name around the whole page lose it."""
    page = f'<body><div class="{name}">{ARTICLE}</div><div class="sidebar">x</div><div id="cookie-notice-2">c</div><div class="ad-slot">a</div></body>'
    assert H.page_text(page, None) == "T\nBody text here\nRelated"


def test_long_comments_stay_out():
    page = f'{ARTICLE}<div class="comments-area"><div class="comment-content"><p>{"First! " * 500}</p></div></div>'
    assert H.page_text(page, None) == "T\nBody text here\nRelated"


def test_stray_quotes():
    assert H.page_text("<p title=it's>First<p>It's</p><p title=\"a>b\" id='x>y'>Third</p><p class=\"open>Fourth</p>", None) == "First\nIt's\nThird\nFourth"


def test_deep_nesting():
    import time
    import tracemalloc

    start = time.time()
    tracemalloc.start()
    assert H.page_text("<div class='a b'>" * 30_000 + "deep" + "</div></p></b>" * 30_000, None) == "deep"
    assert tracemalloc.get_traced_memory()[1] < 100e6
    tracemalloc.stop()
    assert time.time() - start < 10 and H.page_text("<div>" * 30_000 + "x", ">".join(["div"] * 30_000)) == "x"


def test_votes_of_a_site_choose_the_container(spark):
    """On one page a table holds more text than the site's text column."""
    def page(i, table):
        return f'<div class="wrap-{i}"><div class="story"><p>Own text {i} of this page.</p></div><table class="facts"><tr><td>{table}</td></tr></table></div>'

    rows = [(i, "http://s.org/p", page(i, "few")) for i in range(9)] + [(9, "http://s.org/q", page(9, "many numbers " * 20))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert H.page_text(rows[9][2], None) != "Own text 9 of this page."
    keyed = df.selectExpr("'s.org' AS host", "html")
    paths = [r.path for r in H.consensus_paths(keyed).collect()]
    text = {r.page_id: r.text for r in H.main_text(df).collect()}
    assert paths == ["div.wrap->div.story"] and all(text[i] == f"Own text {i} of this page." for i in range(10))


def test_vectors_equal_sql(spark):
    assert spark_rows(Q.op4_voronoi_knn(spark, SMALL)) == duck(sql.OP4, SMALL)


@pytest.mark.parametrize("n", [0, 1, 3, 400])
def test_vectors_odd_rows(spark, monkeypatch, n):
    monkeypatch.setattr(V, "QUERY_BLOCK", 3)
    monkeypatch.setattr(V, "DATA_BLOCK", 50)
    rng = np.random.default_rng(n)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 4) / 4]) for i in range(n)]
    if n > 3:
        rows += [(1000 + i, [0.5, 0.5, 0.25, 1.0]) for i in range(120)] + [(2000, None), (2050, [1.0, None, 2.0, 3.0]), (2100, [1.0, float("nan"), 2.0, 3.0]), (None, [1.0] * 4),
                 (2150, [float("inf"), 0.0, 0.0, 0.0]), (2200, [0.0] * 4), (2250, []), rows[50], rows[50]]
    df = spark.createDataFrame([(i, v, 1.0) for i, v in rows], "vec_id long, embedding array<float>, score double")
    got = spark_rows(V.top_k(df, lambda i: i % 50 == 0, pivots=7))
    import pyarrow as pa

    table = pa.table({"vec_id": pa.array([i for i, _ in rows], pa.int64()), "embedding": pa.array([v for _, v in rows], pa.list_(pa.float32()))})
    assert got == (duck(sql.OP4, embeddings=table) if n else [])


def test_routes_of_clusters_and_large_scores(spark, monkeypatch):
    """Tight clusters: most pairs of blocks are ruled out, and the results stay exact."""
    monkeypatch.setattr(V, "QUERY_BLOCK", 4)
    monkeypatch.setattr(V, "DATA_BLOCK", 64)
    rng = np.random.default_rng(7)
    centre = rng.normal(size=(20, 16))
    centre /= np.sqrt((centre**2).sum(axis=1, keepdims=True))
    x = 60000 * (centre[np.arange(2000) % 20] + 0.01 * rng.normal(size=(2000, 16))).clip(-1, 1)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(5000, [1e9] + [0.0] * 15), (5050, [1.0] * 3)]
    seen, whole = [], V.routes

    def counted(queries, data, *more):
        out = whole(queries, data, *more)
        seen.append((out.select("qb", "block").distinct().count(), queries.select("qb").distinct().count() * data.select("block").distinct().count()))
        return out

    monkeypatch.setattr(V, "routes", counted)
    got = V.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), lambda i: i % 50 == 0).collect()
    v = np.floor(256 * x).astype(np.int64)
    score = v @ v.T
    want = []
    for q in range(0, 2000, 50):
        best = sorted((i for i in range(2000) if i != q), key=lambda i: (-score[q, i], i))[:5]
        want += [(q, n, i, score[q, i]) for n, i in enumerate(best, 1)]
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == want
    print("pairs of blocks", seen)
    assert seen[0][0] <= 0.4 * seen[0][1]


def test_exact_products_of_large_components():
    rng = np.random.default_rng(3)
    q, x = rng.integers(-(2**24), 2**24, (5, 64)), rng.integers(-(2**24), 2**24, (9, 64))
    assert np.array_equal(V.products(q.astype("<i4"), x.astype("<i4")), [[sum(int(a) * int(b) for a, b in zip(u, w, strict=True)) for w in x] for u in q])
