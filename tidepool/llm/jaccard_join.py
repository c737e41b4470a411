"""N-gram Jaccard join: size-aware heavy-light join, reported as components.

Sets of distinct word shingles; two documents link when
``|A n B| / |A u B| >= num / den``.  Equal sets fall into one class first (one
map-side combined aggregation), so copies never meet as pairs.

* Light sets (at most ``x`` shingles) enumerate all their subsets of the
  overlap sizes that a link with another light set needs; two light sets that
  link share such a subset.
* Heavy sets (and the light ones that can still reach a heavy one) are looked
  up in inverted lists of their rarest shingles: a link needs an overlap of at
  least ``num/den`` of the larger set, so it shows in the first
  ``s - ceil(num*s/den) + 1`` shingles of either set under one global order.
* ``x`` is where enumerating stops being cheaper than scanning, by the counts
  of set sizes and of list lengths.

Any global order is right; this one puts hashes in ascending order, and the
shingles known to be frequent last, so that passages that many documents
share make no long lists.  Lists of up to ``LIST_PAIRS`` members give pairs.  A
longer list is linked to its smallest member first; members that then are not in
the list's main component are compared with every other member, in bounded
blocks, by an exact bound on the symmetric difference (parity bitmaps) and
then on the sets.  No link between different sets is lost, and a list of
copies costs its length, not its square.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import apply_recommended_conf
from .graph import connected_components
from .order import ranked
from .store import written
from .textvec import U64, list_column, mix, shingle_sets

LIST_PAIRS = 64
BLOCK = 1536
#: Shingles found more often than this go last in the order, the most frequent
#: ORDER_HINTS of them (a bound on what is broadcast; the order stays total).
FREQUENT, ORDER_HINTS = 32, 200_000
#: Bits of the filter of class keys that the last scans are given (4 MB).
FILTER_BITS = 1 << 25
MAX_LIGHT = 24


def _min_overlap(s: int, t: int, num: int, den: int) -> int:
    return -(-num * (s + t) // (num + den))


def prefix_len(s: int, num: int, den: int) -> int:
    return s - -(-num * s // den) + 1


def subset_sizes(n: int, x: int, num: int, den: int) -> list[int]:
    """Overlap sizes that a link of a set of ``n`` with one of at most ``x`` may need."""
    low, high = -(-num * n // den), min(x, den * n // num)
    return sorted({c for t in range(low, high + 1) if (c := _min_overlap(n, t, num, den)) <= min(n, t)})


def light_boundary(sizes: dict[int, int], list_len: float, num: int, den: int) -> int:
    """Largest set size for which enumerating subsets is the cheaper way."""
    def cost(x: int) -> float:
        total = 0.0
        for n, docs in sizes.items():
            if n <= x:
                total += docs * sum(comb(n, c) for c in subset_sizes(n, x, num, den))
            if n >= -(-num * (x + 1) // den):
                total += docs * prefix_len(n, num, den) * list_len
        return total

    return min(range(MAX_LIGHT + 1), key=lambda x: (cost(x), x))


def _fingerprint(s: np.ndarray) -> bytes:
    with np.errstate(over="ignore"):
        return np.array([mix(s).sum(dtype=U64), mix(s ^ U64(0x5851F42D4C957F2D)).sum(dtype=U64) + U64(len(s))], U64).tobytes()


def parity_bitmap(s: np.ndarray) -> bytes:
    """One bit per hash slot, flipped by each element: two bitmaps differ in
    at most ``|A xor B|`` bits."""
    m = 256
    while m < 2 * len(s) and m < 1 << 16:
        m *= 2
    bits = np.bincount((s & U64(m - 1)).astype(np.int64), minlength=m) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").tobytes()


def _fold(b: np.ndarray, size: int) -> np.ndarray:
    while b.shape[-1] > size:
        h = b.shape[-1] // 2
        b = b[..., :h] ^ b[..., h:]
    return b


def bitmaps_allow(a: bytes, b: bytes, s: int, t: int, num: int, den: int) -> bool:
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    m = min(len(x), len(y))
    d = int(np.bitwise_count(_fold(x, m) ^ _fold(y, m)).sum())
    return d <= s + t - 2 * _min_overlap(s, t, num, den)


def shingle_digest(docs: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp, n_shingles)`` per row."""
    def run(batches):
        for b in batches:
            ids, col = b.column(0), b.column(1)
            got = [(_fingerprint(s), len(s)) for _, s in shingle_sets(col, k)]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([x for x, _ in got], pa.binary()), pa.array([n for _, n in got], pa.int64())],
                names=["doc_id", "fp", "n_shingles"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, "doc_id long, fp binary, n_shingles long")


def _order_hints(texts: DataFrame, k: int, num: int, den: int) -> tuple[np.ndarray, float]:
    """Frequent shingles (ascending by count) and the mean list length of the rest."""
    def run(batches):
        for b in batches:
            rows = [s[: 2 * prefix_len(len(s), num, den)] for _, s in shingle_sets(b.column(0), k) if len(s)]
            flat = np.concatenate(rows) if rows else np.zeros(0, U64)
            yield pa.RecordBatch.from_arrays([pa.array(flat.view(np.int64))], names=["key"])

    counts = texts.mapInArrow(run, "key long").groupBy("key").agg(F.count("*").alias("df")).filter("df > 1")
    counts = written(counts, "list-lengths")
    got = (counts.filter(F.col("df") > FREQUENT).orderBy(F.desc("df"), "key").limit(ORDER_HINTS)
           .select("key").toPandas()["key"].to_numpy(np.int64, copy=True))
    short = counts.filter(F.col("df") <= FREQUENT).agg(
        (F.sum(F.col("df") * F.col("df")) / F.sum("df")).alias("m")).first()["m"]
    return got[::-1].view(U64), float(short or 1.0)


def _keyed_classes(texts: DataFrame, k: int, num: int, den: int, x: int, hints: np.ndarray) -> DataFrame:
    """One row per distinct set: fingerprint, size, keys, bitmap."""
    order = np.argsort(hints)
    shared = texts.sparkSession.sparkContext.broadcast((hints[order], order))

    def keys_of(s: np.ndarray) -> np.ndarray:
        n, out = len(s), []
        with np.errstate(over="ignore"):
            if n <= x:
                m = mix(s)
                total = m.sum(dtype=U64)
                for c in subset_sizes(n, x, num, den):
                    sums = [total - m[list(d)].sum(dtype=U64) for d in combinations(range(n), n - c)]
                    out.append(mix(np.array(sums, U64) ^ SUBSET) + U64(c))
            if n >= -(-num * (x + 1) // den):
                frequent, rank = shared.value
                at = np.searchsorted(frequent, s)
                known = np.zeros(n, bool) if not len(frequent) else frequent[np.minimum(at, len(frequent) - 1)] == s
                tail = s[known][np.argsort(rank[at[known]], kind="stable")] if known.any() else s[:0]
                out.append(np.concatenate([s[~known], tail])[: prefix_len(n, num, den)])
        return np.unique(np.concatenate(out)) if out else s[:0]

    def run(batches):
        seen: set[bytes] = set()
        for b in batches:
            rows = []
            for _, s in shingle_sets(b.column(0), k):
                if len(s) and (fp := _fingerprint(s)) not in seen:
                    seen.add(fp)
                    rows.append((fp, len(s), keys_of(s).view(np.int64), parity_bitmap(s)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()),
                 list_column([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.binary())],
                names=["fp", "n", "keys", "bm"])

    rows = texts.mapInArrow(run, "fp binary, n long, keys array<long>, bm binary")
    one = rows.groupBy("fp").agg(F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("bm").alias("bm"))
    return written(one.withColumn("id", F.monotonically_increasing_id()), "classes")


SUBSET = U64(0xD6E8FEB86659FD93)


def _sets_of(texts: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """``(id, toks)`` of the wanted classes ``(id, fp)``."""
    # A bit per fingerprint, of a fixed number: other texts are skipped in the
    # scan, and the join below decides.
    bit = F.conv(F.hex(F.substring("fp", 1, 6)), 16, 10).cast("long")
    filled = wanted.select((bit % FILTER_BITS).alias("b")).groupBy(F.floor(F.col("b") / 64).cast("long").alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("b") % 64).cast("int"))).alias("v"))
    table = np.zeros(FILTER_BITS // 64, U64)
    for part in filled.toArrow().to_batches():
        table[part.column(0).to_numpy()] = part.column(1).to_numpy().view(U64)
    allowed = texts.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        seen: set[bytes] = set()
        for b in batches:
            fps, rows = [], []
            for _, s in shingle_sets(b.column(0), k):
                if not len(s):
                    continue
                fp = _fingerprint(s)
                if fp in seen:
                    continue
                at = int.from_bytes(fp[:6], "big") % FILTER_BITS
                if not int(allowed.value[at >> 6]) >> (at & 63) & 1:
                    continue
                seen.add(fp)
                fps.append(fp)
                rows.append(s.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(fps, pa.binary()), list_column(rows, pa.int64())], names=["fp", "toks"])

    found = texts.mapInArrow(run, "fp binary, toks array<long>")
    return written(found.join(wanted, "fp").groupBy("id").agg(F.first("toks").alias("toks")), "sets")


def _allowed_pairs(pairs: DataFrame, num: int, den: int) -> DataFrame:
    def run(batches):
        for b in batches:
            keep = [bitmaps_allow(x, y, s, t, num, den) for x, y, s, t in zip(
                b.column("bm_a").to_pylist(), b.column("bm_b").to_pylist(), b.column("n_a").to_pylist(), b.column("n_b").to_pylist(), strict=True)]
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.mapInArrow(run, "a long, b long")


def _links(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs whose sets reach the similarity, by their exact intersection."""
    a = sets.select(F.col("id").alias("a"), F.col("toks").alias("ta"))
    b = sets.select(F.col("id").alias("b"), F.col("toks").alias("tb"))
    both = pairs.join(b, "b").join(a, "a")
    common = F.size(F.array_intersect("ta", "tb"))
    union = F.size("ta") + F.size("tb") - common
    return both.filter(den * common >= num * union).select(F.col("a").alias("u"), F.col("b").alias("v"))


def _blocks(members: DataFrame, payload: DataFrame) -> DataFrame:
    """Long lists cut into bounded blocks: every member outside the list's main
    component (side r) meets every member (side l) in just one block."""
    per = members.groupBy("key", "comp").agg(F.count("*").alias("c"))
    lists = per.groupBy("key").agg(F.sum("c").alias("m"), F.max_by("comp", F.struct("c", "comp")).alias("main"), F.max("c").alias("cm"))
    lists = lists.withColumn("nl", F.ceil(F.col("m") / BLOCK).cast("int")).withColumn("nr", F.ceil((F.col("m") - F.col("cm")) / BLOCK).cast("int"))
    rows = members.join(lists, "key").join(payload, "id")
    spot, cols = F.xxhash64("id"), ["id", "comp", "n", "load", "smaller"]
    left = rows.select("key", F.pmod(spot, "nl").cast("int").alias("lb"), F.explode(F.sequence(F.lit(0), F.col("nr") - 1)).alias("rb"), F.lit(0).alias("side"), *cols)
    right = rows.filter("comp <> main").select("key", F.explode(F.sequence(F.lit(0), F.col("nl") - 1)).alias("lb"), F.pmod(spot, "nr").cast("int").alias("rb"), F.lit(1).alias("side"), *cols)
    return left.union(right)


class _Elsewhere:
    """Which members of ``left`` meet a member of the other side in a smaller
    list already: two members that share several long lists meet in one."""

    def __init__(self, left):
        self.keys = np.concatenate([np.asarray(x, np.int64) for x in left.smaller]) if len(left) else np.zeros(0, np.int64)
        self.row = np.repeat(np.arange(len(left)), [len(x) for x in left.smaller])
        self.n = len(left)

    def __call__(self, other) -> np.ndarray:
        out = np.zeros(self.n, bool)
        out[self.row[np.isin(self.keys, other)]] = True
        return out


def _possible_in_block(num: int, den: int):
    def run(pdf):
        import pandas as pd

        left, right = pdf[pdf.side == 0], pdf[pdf.side == 1]
        hit: set[int] = set()
        by_len = [(m, g, np.frombuffer(b"".join(g.load), np.uint8).reshape(len(g), m), _Elsewhere(g)) for m, g in left.groupby(left.load.str.len())]
        for r in right.itertuples():
            mine = np.frombuffer(r.load, np.uint8)
            for m, g, rows, met in by_len:
                size = min(m, len(mine))
                d = np.bitwise_count(_fold(rows, size) ^ _fold(mine, size)).sum(axis=1, dtype=np.int64)
                n = g.n.to_numpy()
                most = n + r.n - 2 * (-(-num * (n + r.n) // (num + den)))
                ok = (d <= most) & (g.comp.to_numpy() != r.comp)
                if ok.any():
                    ok &= ~met(r.smaller)
                if ok.any():
                    hit.add(r.id)
                    hit.update(g.id.to_numpy()[ok].tolist())
        return pd.DataFrame({"key": pdf.key.iloc[0], "id": sorted(hit)}, columns=["key", "id"]).astype("int64")

    return run


def _links_in_block(num: int, den: int):
    def run(pdf):
        import pandas as pd

        left, right = pdf[pdf.side == 0], pdf[pdf.side == 1]
        root: dict[int, int] = {}

        def find(c: int) -> int:
            while root.setdefault(c, c) != c:
                c = root[c] = root[root[c]]
            return c

        out = []
        toks = np.concatenate(list(left.load)) if len(left) else np.zeros(0, np.int64)
        values, spot = np.unique(toks, return_inverse=True)
        starts = np.concatenate([[0], np.cumsum([len(x) for x in left.load])])[:-1].astype(np.int64)
        n, comps, ids, met = left.n.to_numpy(), left.comp.to_numpy(), left.id.to_numpy(), _Elsewhere(left)
        for r in right.itertuples():
            if not len(left):
                break
            mark = np.isin(values, r.load)
            common = np.add.reduceat(mark[spot].astype(np.int64), starts)
            ok = (den * common >= num * (n + r.n - common)) & ~met(r.smaller)
            for j in np.flatnonzero(ok):
                a, b = find(int(comps[j])), find(int(r.comp))
                if a != b:
                    root[a] = b
                    out.append((int(ids[j]), int(r.id)))
        return pd.DataFrame(out, columns=["u", "v"]).astype("int64")

    return run


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` per row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` reachable by links, its own
    included.  Null, empty and blank texts have no shingles and are linked
    with nothing: their ``component_id`` is their own id.  Rows with a null id
    are kept; they link like others but never name a component (a component
    of null ids only has null).  Repeated rows stay repeated.  Other columns
    of ``docs`` are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    apply_recommended_conf(spark)
    texts = docs.select(F.col(text_col).alias("text"))
    digest = written(shingle_digest(docs, k, id_col, text_col), "digest")
    sizes = {r["n_shingles"]: r["c"] for r in digest.filter(F.col("n_shingles").between(1, MAX_LIGHT))
             .groupBy("n_shingles").agg(F.count_distinct("fp").alias("c")).collect()}
    hints, list_len = _order_hints(texts, k, num, den)
    x = light_boundary(sizes, list_len, num, den)
    classes = _keyed_classes(texts, k, num, den, x, hints)

    posts = classes.select(F.explode("keys").alias("key"), "id", "n")
    lists = posts.groupBy("key").agg(F.count("*").alias("m"), F.min("id").alias("first")).filter("m > 1")
    posts = written(posts.join(lists, "key"), "shared-lists")
    short, long_ = posts.filter(F.col("m") <= LIST_PAIRS), posts.filter(F.col("m") > LIST_PAIRS)
    one, two = (short.select("key", F.col("id").alias(i), F.col("n").alias(n)) for i, n in (("a", "na"), ("b", "nb")))
    fits = (F.col("na") * den >= F.col("nb") * num) & (F.col("nb") * den >= F.col("na") * num)
    pairs = one.join(two, "key").filter((F.col("a") < F.col("b")) & fits).select("a", "b")
    stars = long_.filter("first <> id").select(F.col("first").alias("a"), F.col("id").alias("b"))
    pairs = pairs.union(stars).distinct()
    bm = classes.select("id", "n", "bm")
    pairs = (pairs.join(bm.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("bm").alias("bm_a")), "a")
             .join(bm.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("bm").alias("bm_b")), "b"))
    pairs = written(_allowed_pairs(pairs, num, den), "pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(classes.select("id", "fp"), "id")
    links = written(_links(pairs, _sets_of(texts, wanted, k), num, den), "links")
    comps = connected_components(links)

    # Long lists: what the stars left apart is compared member by member.
    members = (long_.select("key", "id").join(comps.withColumnRenamed("node", "id"), "id", "left")
               .select("key", "id", F.coalesce("comp", "id").alias("comp")))
    apart = members.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi")
    members = written(members.join(apart.select("key"), "key"), "apart")
    if members.limit(1).count():
        mine = members.groupBy("id").agg(F.collect_list("key").alias("mine"))
        smaller = F.filter("mine", lambda x: x < F.col("key")).alias("smaller")
        members = written(members.join(mine, "id").select("key", "id", "comp", smaller), "apart")
        load = classes.select("id", "n", F.col("bm").alias("load"))
        near = (_blocks(members, load).groupBy("key", "lb", "rb")
                .applyInPandas(_possible_in_block(num, den), "key long, id long").distinct())
        members = written(members.join(near, ["key", "id"]), "near")
        apart = members.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi")
        members = members.join(apart.select("key"), "key")
        wanted = members.select("id").distinct().join(classes.select("id", "fp"), "id")
        sets = _sets_of(texts, wanted, k).select("id", F.size("toks").cast("long").alias("n"), F.col("toks").alias("load"))
        more = _blocks(members, sets).groupBy("key", "lb", "rb").applyInPandas(_links_in_block(num, den), "u long, v long").distinct()
        comps = connected_components(links.union(written(more, "links")))

    named = (digest.filter("n_shingles > 0").groupBy("fp").agg(F.min("doc_id").alias("low"))
             .join(classes.select("fp", "id"), "fp")
             .join(comps.withColumnRenamed("node", "id"), "id", "left")
             .select("fp", "low", F.coalesce("comp", "id").alias("comp")))
    lowest = named.groupBy("comp").agg(F.min("low").alias("component_id"))
    named = named.join(lowest, "comp").select("fp", "component_id")
    full = digest.filter("n_shingles > 0").join(named, "fp").select("doc_id", "n_shingles", "component_id")
    return full.union(digest.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def one_per_group(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one document of each linked group, the one with the
    smallest ``(doc_id, text)``, null ids last.

    A document is a pair of id and text: rows that repeat both are one
    document (any one stays), rows that share an id, or have none, but differ
    in text are documents of their own.  Texts without words are linked with
    nothing, and all their rows stay.  Other columns stay as they are.
    """
    id_ = F.col("doc_id")
    many = docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter(id_.isNull() | (F.col("n") > 1)).select(id_.alias("m_id"))
    many = written(many, "repeated-ids")
    if not many.limit(1).count():
        gone = jaccard_components(docs, k, num, den).filter("n_shingles > 0 and doc_id <> component_id").select("doc_id")
        return docs.join(gone, "doc_id", "left_anti").select(docs.columns)

    same = id_.eqNullSafe(F.col("m_id"))
    odd, plain = docs.join(many, same, "left_semi"), docs.join(many, same, "left_anti")
    # documents whose id does not tell them apart get keys below all ids
    low = docs.agg(F.min("doc_id")).first()[0] or 0
    keyed = ranked(odd.select("doc_id", "text").distinct(), [id_.asc_nulls_last(), F.col("text").asc_nulls_last()], "nth", "repeated")
    keyed = written(keyed.select((F.lit(low - 1) - F.col("nth")).alias("key"), id_.alias("k_id"), F.col("text").alias("k_text"), "nth"), "keys")
    every = plain.select(id_.cast("long").alias("doc_id"), "text").unionByName(keyed.select(F.col("key").alias("doc_id"), F.col("k_text").alias("text")))
    found = written(jaccard_components(every, k, num, den), "components").withColumnRenamed("doc_id", "f_key")
    named = found.filter("n_shingles > 0").join(keyed, F.col("f_key") == F.col("key"), "left")
    own = F.when(F.col("key").isNull(), F.col("f_key")).otherwise(F.col("k_id"))
    place = F.struct(own.isNull().alias("a"), own.alias("b"), F.coalesce("nth", F.lit(-1)).alias("c"))
    stays = named.groupBy(F.col("component_id").alias("c_id")).agg(F.min_by("f_key", place).alias("first"))
    gone = written(named.join(stays, F.col("component_id") == F.col("c_id")).filter(F.col("f_key") != F.col("first")).select("f_key"), "dropped")
    plain = plain.join(gone, id_ == F.col("f_key"), "left_anti").select(docs.columns)
    rows = odd.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), id_.alias("doc_id"), "text")
    rows = rows.join(keyed, id_.eqNullSafe(F.col("k_id")) & F.col("text").eqNullSafe(F.col("k_text"))).select("row", "key")
    rows = rows.join(gone, F.col("key") == F.col("f_key"), "left_anti")
    blank = found.filter("n_shingles = 0").select(F.col("f_key").alias("b_key"))
    once = F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("row")))
    single = rows.join(blank, F.col("key") == F.col("b_key"), "left_anti").withColumn("copy", once).filter("copy = 1").select("row")
    rest = rows.join(blank, F.col("key") == F.col("b_key"), "left_semi").select("row")
    return plain.union(single.union(rest).select("row.*").select(docs.columns))
