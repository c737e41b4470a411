"""Information-theoretic sanitisation of personal data (JVM expressions only).

Base spans are e-mail addresses, IPv4 addresses, card numbers (Luhn) and phone
numbers.  The values found are the protected entities.  A term ``t`` on the
same line as an entity ``e`` discloses it as far as their pointwise mutual
information reaches the entity's information content,

    disclosure(t, e) = ln(N * p(e|t) / n(e)) / ln(N / n(e)),

with all counts over the distinct lines of the corpus, so that copies count
once.  ``p(e|t)`` is the share ``n(t,e) / n(t)`` of the term's lines that hold
the entity; for pairs on fewer than ``MIN_LINES`` lines it is the lower 99 %
confidence bound of that share (Wilson, ``Z``), so entities and terms of every
support take part, and a pair seen rarely must be the more specific.  Terms with ``disclosure >= DISCLOSURE`` are spans of kind ``term`` in every
document that holds ``e`` (the same surface form, whole words).  ``redact``
generalises spans to their kind.

Matches come from ``regexp_extract_all`` and their places from ``split`` by the
same pattern: the gaps between matches give the offsets.  The patterns only
find matches where a run can start and are possessive where that changes
nothing, so long runs cost linear time.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import apply_recommended_conf
from .store import written

DISCLOSURE, Z = 0.8, 2.576
KINDS = ("email", "ip", "card", "phone", "term")
#: Patterns of the base kinds, in the order in which kinds are listed.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
WORD = r"(?<!\p{L})\p{L}{3,}+"
RUN = 256                    # finds collected before they are joined
PARTS = (4096, 256, 16, 1)   # one line in so many, by hash; the last must be 1
#: Candidate terms are broadcast up to this many; more go through a shuffle.
MAX_BROADCAST_TERMS = 100_000


def _luhn(match: Column) -> Column:
    digits = F.reverse(F.regexp_replace(match, "[^0-9]", ""))
    value = F.transform(F.filter(F.split(digits, ""), lambda d: d != ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), d.cast("int") + 1)))
    return F.aggregate(value, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    digits = F.length(F.regexp_replace(match, "[^0-9]", ""))
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: p.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return digits.between(14, 19) & _luhn(match)
    if kind == "phone":
        return digits.between(10, 15)
    return F.lit(True)


def _placed(matches: Column, gaps: Column, wanted: Column | None = None) -> Column:
    """Array of (match, start) in code points, of the matches among ``wanted``.

    Offsets are carried; finds are collected in runs of ``RUN`` that are joined at
    the end, so the cost is linear in the matches."""
    each = F.arrays_zip(matches.alias("m"), F.slice(gaps, 1, F.size(matches)).alias("g"))
    found, none = "array<struct<m:string,s:long>>", F.array()
    zero = F.struct(F.lit(0).cast("long").alias("at"), none.cast(found).alias("run"), none.cast(f"array<{found}>").alias("out"))

    def step(a: Column, x: Column) -> Column:
        start = (a["at"] + F.char_length(x["g"])).cast("long")
        one, full = F.array(F.struct(x["m"].alias("m"), start.alias("s"))), F.size(a["run"]) >= RUN
        keep = F.lit(True) if wanted is None else F.array_contains(wanted, x["m"])
        return F.struct((start + F.char_length(x["m"])).cast("long").alias("at"),
                        F.when(~keep, a["run"]).when(full, one).otherwise(F.concat(a["run"], one)).alias("run"),
                        F.when(keep & full, F.concat(a["out"], F.array(a["run"]))).otherwise(a["out"]).alias("out"))

    done = F.aggregate(each, zero, step)
    return F.flatten(F.concat(done["out"], F.array(done["run"])))


def _spans(placed: Column, kind: int) -> Column:
    end = lambda x: (x["s"] + F.char_length(x["m"])).cast("long")
    return F.transform(placed, lambda x: F.struct(x["s"].alias("s"), F.lit(kind).alias("k"), end(x).alias("e"), x["m"].alias("m")))


SPAN = "array<struct<s:long,k:int,e:long,m:string>>"


def with_spans(df: DataFrame, text: str = "text", name: str = "spans") -> DataFrame:
    """``df`` with a column of the base spans: start, kind number, end, match."""
    full = F.coalesce(F.col(text), F.lit(""))
    for kind, pattern in PATTERNS.items():
        found = F.regexp_extract_all(full, F.lit(pattern), F.lit(0))
        if kind in NEEDS:
            found = F.when(F.contains(full, F.lit(NEEDS[kind])), found).otherwise(F.array().cast("array<string>"))
        df = df.withColumn(f"__{kind}", found)
    parts = []
    for n, (kind, pattern) in enumerate(PATTERNS.items()):
        m = F.col(f"__{kind}")
        is_valid = partial(_valid, kind)
        spans = _spans(F.filter(_placed(m, F.split(full, pattern, -1)), lambda x: is_valid(x["m"])), n)  # noqa: B023
        parts.append(F.when(F.exists(m, lambda x: is_valid(x)), spans).otherwise(F.array().cast(SPAN)))  # noqa: B023
    return df.withColumn(name, F.array_sort(F.concat(*parts))).drop(*[f"__{k}" for k in PATTERNS])


def _terms(line: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(line, F.lit(WORD), F.lit(0)))


def _share(n_te: Column, n_t: Column) -> Column:
    """The lower confidence bound of ``n_te / n_t``."""
    z2, p = F.lit(Z * Z), n_te / n_t
    return (p + z2 / (2 * n_t) - Z * F.sqrt(p * (1 - p) / n_t + z2 / (4 * n_t * n_t))) / (1 + z2 / n_t)


def disclosing_terms(lines: DataFrame, held: DataFrame) -> DataFrame:
    """``(entity, term)`` pairs above the threshold.  ``lines(line)`` are all
    lines of the corpus, ``held(line, entities)`` those with base spans."""
    line_id = F.xxhash64("line")
    total = lines.select(line_id.alias("l")).distinct().count()
    held = held.withColumn("l", line_id).dropDuplicates(["l"])
    n_entity = held.select(F.explode(F.array_distinct("entities")).alias("entity")).groupBy("entity").agg(F.count("*").alias("n_e"))
    known = n_entity.filter(F.col("n_e") < total)
    words = F.filter(_terms(F.col("line")), lambda t: ~F.exists("entities", lambda e: F.contains(e, t)))
    pmi = lambda n_t: F.log(F.lit(float(total)) * _share(F.col("n_te"), n_t) / F.col("n_e"))
    content = F.log(F.lit(float(total)) / F.col("n_e"))
    # A term has at least the pair's lines, so a pair that fails with just those is out.
    joint = (held.select(F.explode(F.array_distinct("entities")).alias("entity"), words.alias("terms"))
             .join(known, "entity").select("entity", "n_e", F.explode("terms").alias("term"))
             .groupBy("entity", "term").agg(F.count("*").alias("n_te"), F.first("n_e").alias("n_e"))
             .filter(pmi(F.col("n_te")) >= DISCLOSURE * content))
    joint = written(joint, "joint")
    # Lower bounds of a term's lines rule pairs out: the bits that its lines set
    # out of 64 (one row a term and task is shuffled), then its lines among a
    # part of all lines, chosen by hash.  A pair that passes a part has few lines
    # more in the next, larger one; the last part is all lines, so exact.
    numbered = lines.select(line_id.alias("l"), "line")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.col("l"), F.lit(64)).cast("int"))
    term = F.explode(_terms(F.col("line"))).alias("term")

    def left(pairs: DataFrame, least: DataFrame) -> DataFrame:
        at_least = F.greatest(F.col("n_some").cast("long"), F.col("n_te"))
        return written(pairs.join(least, "term").filter(pmi(at_least) >= DISCLOSURE * content).drop("n_some"), "sifted")

    pairs = left(joint, numbered.select("l", term).groupBy("term").agg(F.bit_count(F.bit_or(bit)).alias("n_some")))
    for part in PARTS:
        wanted = written(pairs.select("term").distinct(), "candidates")
        n_wanted = wanted.count()
        if not n_wanted:
            break
        some = numbered.filter(F.pmod(F.shiftright("l", 6), F.lit(part)) == 0).select("l", term)
        hits = some.join(F.broadcast(wanted) if n_wanted <= MAX_BROADCAST_TERMS else wanted, "term").distinct().groupBy("term").agg(F.count("*").alias("n_hits"))
        # no line in the part: no bound
        least = wanted.join(hits, "term", "left").select("term", F.coalesce("n_hits", F.lit(0)).alias("n_some"))
        pairs = left(pairs, least)
    return pairs.select("entity", "term")


def personal_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, base, spans)`` per row: sorted base spans, and all spans with
    the disclosing terms.  Rows that repeat get equal rows; null and empty texts
    and tables have no spans; null ids stay; other columns are ignored."""
    apply_recommended_conf(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    text_id = F.struct(F.xxhash64("text").alias("x"), F.hash("text").alias("y"))
    # texts without base spans need no second look
    base = with_spans(rows.withColumn("t", text_id), name="base").withColumn("held", F.when(F.size("base") > 0, F.col("text"))).drop("text")
    base = written(base, "base-spans")
    holders = base.filter(F.col("held").isNotNull())
    lines = rows.select(F.explode(F.split("text", "\n", -1)).alias("line")).filter(F.btrim("line") != "")
    has = F.lit(False)
    for kind in PATTERNS:
        has = has | F.col("line").rlike("@" if kind == "email" else r"[0-9]")
    # no pattern crosses a line, so lines with spans are lines of such texts
    near = holders.select(F.explode(F.split("held", "\n", -1)).alias("line")).filter(has)
    held = with_spans(near, "line", "found").filter(F.size("found") > 0).select("line", F.transform("found", lambda s: s["m"]).alias("entities"))
    risky = written(disclosing_terms(lines, held), "risky")
    found = holders.select("t", "base").dropDuplicates(["t"])
    mine = (found.select("t", F.explode(F.array_distinct(F.transform("base", lambda s: s["m"]))).alias("entity"))
            .join(risky, "entity").groupBy("t").agg(F.collect_set("term").alias("terms")))
    mine = written(mine.withColumnRenamed("t", "m_t"), "risky-texts")
    both = holders.join(mine, F.col("t") == F.col("m_t"), "left")
    words = F.regexp_extract_all("held", F.lit(WORD), F.lit(0))
    extra = _spans(_placed(words, F.split("held", WORD, -1), F.col("terms")), len(PATTERNS))
    spans = F.when(F.col("terms").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", extra)))
    rest = base.filter(F.col("held").isNull()).select("doc_id", "base", F.col("base").alias("spans"), "t")
    return both.select("doc_id", "base", spans.alias("spans"), "t").unionByName(rest)


def span_text(spans: str) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    kind = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kind, s["k"] + 1), s["s"].cast("string"), s["e"].cast("string"))), ",")


def span_digest(spans: DataFrame) -> DataFrame:
    """Counts per base kind, the digest of the base spans, and all spans."""
    kinds = F.transform("base", lambda s: s["k"])
    count = [(F.size("base") - F.size(F.array_remove(kinds, n))).cast("long").alias(f"n_{k}") for n, k in enumerate(PATTERNS)]
    return spans.select("doc_id", *count, F.sha2(span_text("base"), 256).alias("base_sha256"), span_text("spans").alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every span of ``text_col`` generalised to ``[KIND]``;
    overlapping spans become the first one's kind.  Null texts stay null."""
    found = personal_spans(docs, id_col, text_col).select(F.col("t").alias("r_t"), F.col("spans").alias("r_spans")).dropDuplicates(["r_t"])
    kind = F.array(*[F.lit(k.upper()) for k in KINDS])
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("r_text"))
    both = row.join(found, F.struct(F.xxhash64("r_text").alias("x"), F.hash("r_text").alias("y")) == F.col("r_t"))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    step = lambda a, s: F.when(s["s"] >= a["at"], F.struct(
        s["e"].alias("at"), F.concat(a["out"], F.substring(F.col("r_text"), (a["at"] + 1).cast("int"), (s["s"] - a["at"]).cast("int")),
                                     F.lit("["), F.element_at(kind, s["k"] + 1), F.lit("]")).alias("out"))).otherwise(
        F.struct(F.greatest(a["at"], s["e"]).alias("at"), a["out"].alias("out")))
    done = F.aggregate("r_spans", zero, step)
    clean = F.concat(done["out"], F.substring(F.col("r_text"), (done["at"] + 1).cast("int"), F.lit(1 << 30)))
    both = both.withColumn("clean", clean)
    return both.select(*[(F.when(F.col("row")[c].isNotNull(), F.col("clean")).alias(c) if c == text_col else F.col("row")[c].alias(c)) for c in docs.columns])
