"""Merkle manifest of a dataset by nested-interval labels.

Every row is a leaf; leaves are ranked globally by group and id.  A node is
labelled with the interval ``[lo, hi]`` of leaf ranks that it covers, so a
group's tree is named by the rank of its first leaf and the node of height
``L`` above a leaf ``r`` is the one whose interval holds ``r`` in the bucket
``(r - first) div FANOUT^L``.  The trees grow level by level (a group of at most
``FANOUT`` rows each); the groups' roots are the leaves of one more tree.

Proofs go down the same levels: the nodes of one level join the nodes above by
level bucket and interval containment, and a node's siblings are what its
parent's children cover outside the node's own interval, split into those left
and right of it.  A bucket holds one parent and at most ``FANOUT`` children, so
a group with a third of all rows is spread like any other.  Every level is a
16th of the one below; leaves move three times, as digests only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import apply_recommended_conf
from .order import ranked
from .store import written

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def digest(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Digest of a row: per field ``-`` if null, else its UTF-8 byte count, ``:``
    and its value."""
    def part(c: Column) -> Column:
        s = c.cast("string")
        return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))

    return digest(F.concat(*[part(c) for c in fields]))


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and the siblings of ``path`` give."""
    return F.aggregate(path, leaf, lambda h, p: digest(F.concat(p["left"], h, p["right"])))


def proof_text(path: Column) -> Column:
    """The siblings of ``path``, level by level, left to right."""
    return F.concat_ws("", F.transform(path, lambda p: F.concat(p["left"], p["right"])))


def _levels(leaves: DataFrame, most: int, label: str) -> list[DataFrame]:
    """Nodes of every level above ``leaves`` (tree, n, lo, hi, h); ``n`` is the
    number of leaves of the tree, which starts at rank ``tree``.  A tree has
    no nodes above its root."""
    out, below, width = [], leaves, 1
    while width < most:
        parent = F.col("tree") + F.floor((F.col("lo") - F.col("tree")) / (width * FANOUT)).cast("long") * (width * FANOUT)
        kids = below.filter(F.col("n") > width).groupBy("tree", "n", parent.alias("at")).agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "h"))).alias("kids"))
        nodes = kids.select("tree", "n", F.col("at").alias("lo"), F.element_at("kids", -1)["hi"].alias("hi"),
                            digest(F.concat_ws("", F.transform("kids", lambda k: k["h"]))).alias("h"), "kids")
        below = written(nodes, f"{label}-level")
        out.append(below)
        width *= FANOUT
    return out


def _attach(nodes: DataFrame, above: DataFrame, width: int, carried: Sequence[str]) -> DataFrame:
    """``nodes`` with the path of each to the root: ``above`` are the nodes of the
    next level (``width`` leaves each) with theirs."""
    c, p = nodes.alias("c"), above.alias("p")

    def bucket(side: str) -> Column:
        return F.floor((F.col(f"{side}.lo") - F.col(f"{side}.tree")) / width).cast("long")

    inside = (F.col("p.lo") <= F.col("c.lo")) & (F.col("c.hi") <= F.col("p.hi"))
    both = c.join(p, (F.col("c.tree") == F.col("p.tree")) & (bucket("c") == bucket("p")) & inside)

    def hashes(test) -> Column:
        return F.concat_ws("", F.transform(F.filter(F.col("p.kids"), test), lambda k: k["h"]))

    own = F.struct(hashes(lambda k: k["hi"] < F.col("c.lo")).alias("left"), hashes(lambda k: k["lo"] > F.col("c.hi")).alias("right"))
    return both.select("c.*", F.concat(F.array(own), F.col("p.path")).alias("path"), *[F.col(f"p.{x}") for x in carried])


def _descend(leaves: DataFrame, levels: list[DataFrame], ends: DataFrame, carried: Sequence[str], label: str) -> DataFrame:
    """``leaves`` with their path.  ``ends`` has the path (and ``carried``) that a
    tree's root starts from, one row per ``tree``."""
    above = None
    for height in range(len(levels), -1, -1):
        nodes = levels[height - 1] if height else leaves
        width = FANOUT**height
        top = F.col("n") <= width
        roots = nodes.filter(top).join(ends, "tree").select(*nodes.columns, "path", *carried)
        if above is not None:
            roots = roots.unionByName(_attach(nodes.filter(~top), above, width * FANOUT, carried))
        above = written(roots, f"{label}-paths") if height else roots
    return above


def merkle_manifest(table: DataFrame, fields: Sequence[str] = FIELDS, group: str = "source", id_col: str = "doc_id",
                    carry: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per row of ``table``: ``(id, group, lo, leaf, path, subroot, root)``
    and the expressions of ``carry``, computed on the same scan.

    ``leaf`` is the digest of ``fields``, ``lo`` the leaf's global rank, ``path`` the
    siblings from the leaf to the root (left and right of it, joined, per
    level; empty where a node has none).  Leaves ascend by ``id_col`` in their
    group, nulls first, equal ids by digest; groups ascend by UTF-8 bytes,
    null first.  Repeated rows are leaves of their own.  Any column may be
    null and any text empty; an empty table gives no rows; other columns of the
    table are ignored, whatever their names.
    """
    spark = table.sparkSession
    apply_recommended_conf(spark)
    carry = dict(carry or {})
    every = table.select(F.col(id_col).alias("id"), F.col(group).cast("string").alias("grp"), leaf_digest([F.col(f) for f in fields]).alias("h"),
                         *[c.alias(f"x_{n}") for n, c in carry.items()], F.monotonically_increasing_id().alias("nth"))
    extra = [f"x_{n}" for n in carry]
    # the texts are read once: the sort samples and moves digests
    leaves = ranked(written(every, "digests"), [F.col("grp"), F.col("id"), F.col("h"), F.col("nth")], "lo", "leaves")

    # The interval of every group; the interval of its part in one range keeps
    # the join's keys as even as the ranges.
    slot = F.floor(F.col("lo") / 65536).cast("long")
    parts = leaves.groupBy("grp", slot.alias("slot")).agg(F.min("lo").alias("first"), F.count("*").alias("n"))
    spans = written(parts.groupBy("grp").agg(F.min("first").alias("tree"), F.sum("n").alias("n")), "spans")
    most = spans.agg(F.max("n"), F.count("*")).first()
    per_part = parts.alias("a").join(spans.alias("b"), F.col("a.grp").eqNullSafe(F.col("b.grp"))).select("a.grp", "slot", "b.tree", "b.n")
    a, b = leaves.withColumn("slot", slot).alias("a"), per_part.alias("b")
    leaves = a.join(b, (F.col("a.slot") == F.col("b.slot")) & F.col("a.grp").eqNullSafe(F.col("b.grp")))
    leaves = written(leaves.select("b.tree", "b.n", "a.lo", F.col("a.lo").alias("hi"), "a.h", "a.id", "a.grp", *[f"a.{x}" for x in extra]), "labelled")

    levels = _levels(leaves.select("tree", "n", "lo", "hi", "h"), most[0] or 0, "groups")
    roots = leaves.filter("n = 1").select("tree", F.col("h").alias("subroot"))
    for height, nodes in enumerate(levels, 1):
        roots = roots.unionByName(nodes.filter(F.col("n") <= FANOUT**height).select("tree", F.col("h").alias("subroot")))
    tops = ranked(roots, [F.col("tree")], "lo", "subroots")
    tops = tops.select(F.lit(0).cast("long").alias("tree"), F.lit(most[1]).cast("long").alias("n"), "lo", F.col("lo").alias("hi"), F.col("subroot").alias("h"), F.col("tree").alias("of"))
    upper = _levels(tops.select("tree", "n", "lo", "hi", "h"), most[1], "tops")
    last = (upper[-1] if upper else tops).select("h").first()
    end = spark.range(1).select(F.col("id").alias("tree"), F.array().cast(PATH).alias("path"))
    ends = _descend(tops, upper, end, [], "tops").select(F.col("of").alias("tree"), "path", F.col("h").alias("subroot"))
    out = _descend(leaves, levels, written(ends, "ends"), ["subroot"], "groups")
    return out.select(F.col("id").alias(id_col), F.col("grp").alias(group), "lo", F.col("h").alias("leaf"), "path", "subroot",
                      F.lit(last["h"] if last else None).cast("string").alias("root"), *[F.col(f"x_{n}").alias(n) for n in carry])
