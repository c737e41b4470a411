import hashlib
import math
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from tidepool.llm import sanitize as S
from tidepool.sources.tables import read_table

SMALL = "/root/testdata/sf0.001"
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def ok(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 14 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    return kind == "email" or 10 <= len(d) <= 15


def base_spans(text):
    return sorted((m.start(), n, m.end(), m.group(0)) for n, (k, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text or "") if ok(k, m.group(0)))


def joined(spans):
    return ",".join(f"{S.KINDS[k]}:{s}:{e}" for s, k, e, _ in spans)


def words(t):
    return [(m.start(), m.end(), m.group(0)) for m in re.finditer(r"[^\W\d_]{3,}", t)]


def bound(c, n, z=2.576):
    """Wilson's lower bound of c / n."""
    p = c / n
    return (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def brute(rows):
    lines = {x for _, t in rows for x in (t or "").split("\n") if x.strip(" ")}
    n_e, n_t, n_te = defaultdict(int), defaultdict(int), defaultdict(int)
    for x in lines:
        es = {s[3] for s in base_spans(x)}
        ts = {w for _, _, w in words(x)}
        for t in ts:
            n_t[t] += 1
        for e in es:
            n_e[e] += 1
            for t in ts:
                if not any(t in o for o in es):
                    n_te[e, t] += 1
    n = len(lines)
    risky = {(e, t) for (e, t), c in n_te.items() if n > n_e[e] and math.log(n * bound(c, n_t[t]) / n_e[e]) >= 0.8 * math.log(n / n_e[e])}
    out = []
    for d, t in rows:
        base = base_spans(t)
        terms = {x for e in {s[3] for s in base} for r, x in risky if r == e}
        spans = sorted(base + [(a, 4, b, w) for a, b, w in words(t or "") if w in terms])
        out.append((d, *[sum(s[1] == k for s in base) for k in range(4)], hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
    return sorted(out, key=str), risky


def got(df):
    return sorted((tuple(r) for r in S.span_digest(S.personal_spans(df)).collect()), key=str)


def test_table(spark):
    docs = read_table(spark, SMALL, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(docs) == brute(rows)[0]


def test_terms_of_a_whole_table(spark):
    """Pairs of one or two lines, by their confidence bound."""
    docs = read_table(spark, "/root/testdata/sf0.1", "documents")
    want, risky = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert len(risky) > 2000 and got(docs) == want


def test_long_texts_with_many_finds(spark):
    text = " ".join(f"u{i}@mail.de" for i in range(3000)) + " " + "Konstanze " * 3000
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert got(df) == brute([(1, text)])[0]
    few = S._placed(F.array(*[F.lit(x) for x in "ababa"]), F.array(*[F.lit("-")] * 6), F.array(F.lit("b")))
    assert [tuple(x) for x in df.select(few.alias("x")).first().x] == [("b", 3), ("b", 7)]


def test_odd_and_terms(spark):
    rng = random.Random(3)
    bits = ["a@b.co", "x.y%z@q-r.s.t@u.v", "@", "a@b", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "0001.02.3.255", "4539 1488 0343 6467", "4539-1488-0343-6467-", "12  34",
            "+1 (386) 555-3733", "+12", "++49 30 1234567 ", "é𝄞", " ", "\n", "9" * 40, ".5", "Zürich", "of", "+1.2.3.4.5.6.7.8.9.0"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(1, 14)))) for i in range(300)]
    rows += [(1000 + i, f"Konstanze writes from {i} harbour to k.weber@mail.de the") for i in range(4)]
    rows += [(2000 + i, f"the harbour from line {i} word writes") for i in range(900)] + [(1000, rows[-64][1])] * 2
    rows += [(None, "k.weber@mail.de Konstanze"), (7, None), (8, ""), (9, "1 " * 20000 + "é a@b.co"), (10, "x" * 100000), (11, "7." * 30000)]
    df = spark.createDataFrame([(d, t, "q") for d, t in rows], "doc_id long, text string, spans string")
    want, risky = brute(rows)
    assert ("k.weber@mail.de", "Konstanze") in risky
    assert got(df) == want
    clean = {(r.doc_id, r.text) for r in S.redact(df).collect()}
    assert (None, "[EMAIL] [TERM]") in clean and (7, None) in clean and (8, "") in clean
    assert got(df.limit(0)) == []


def test_terms_of_every_support(spark):
    rows = ["Konstanze writes the word to k.weber@mail.de"] * 3 + ["call +1 (386) 555-3733 Anselm", "ask Anselm +1 (386) 555-3733 from", "Konrad Weber", "Weber to w@mail.de"]
    lines = spark.range(30000).selectExpr("concat('the harbour from line ', id, ' word writes') as line").union(spark.createDataFrame([(x,) for x in rows], "line string"))
    held = S.with_spans(lines.filter("line rlike '[@+]'"), "line", "found").selectExpr("line", "transform(found, s -> s.m) as entities")
    got = {tuple(r) for r in S.disclosing_terms(lines, held).collect()}
    # One line of one is enough among 30,000 lines, one of two is not; of the phone's two lines both are, one is not.
    assert got == {("k.weber@mail.de", "Konstanze"), ("+1 (386) 555-3733", "Anselm")}
