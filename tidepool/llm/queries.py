"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from . import sql
from .decontaminate import contamination
from .hard_negatives import hard_negatives
from .jaccard_join import jaccard_components
from .language_id import language_id
from .license_scan import license_scan
from .line_dedup import drop_boilerplate
from .main_text import main_text
from .merkle import FIELDS, digest, fold, leaf_digest, merkle_manifest, proof_text
from .multi_index import nearest
from .sanitize import personal_spans, span_digest
from .toxicity import toxicity
from .voronoi_knn import top_k
from .wfq_mix import mix_sources

Query = Callable[[SparkSession, str], DataFrame]


def _remainder(n: int) -> Column:
    """The fold of a row: crc32 of its id as text, modulo ``n``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License families of every document."""
    return license_scan(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), name="p").select("doc_id", "p.*")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` without the boilerplate lines of their source."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "source", "text"])
    return drop_boilerplate(docs, "source", dropped="n_dropped").select("doc_id", "text", "n_dropped")


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    out = main_text(read_table(spark, sf_dir, "pages", ["page_id", "url", "html"]))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op4_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest integer inner products of every 50th vector with all others."""
    return top_k(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"]), lambda i: i % 50 == 0)


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix of all ``documents`` takes of each."""
    return mix_sources(read_table(spark, sf_dir, "documents", ["doc_id", "source", "text"]))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three of four folds."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    held = F.coalesce(_remainder(4) == 2, F.lit(False))
    out = language_id(docs, ~held, name="p")
    return out.select("doc_id", held.alias("held_out"), "p.lang_pred", "p.score")


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark items it leaks."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return contamination(docs, read_table(spark, sf_dir, "benchmark")).select("doc_id", "leak.*")


def op8_sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document, with the terms that disclose it."""
    return span_digest(personal_spans(read_table(spark, sf_dir, "documents", ["doc_id", "text"])))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of ``documents`` linked by 4-word shingles at Jaccard 0.85."""
    return jaccard_components(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), k=4, num=85, den=100)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from two of three folds of the labels."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    held = F.coalesce(_remainder(3) == 1, F.lit(False))
    out = toxicity(docs, read_table(spark, sf_dir, "labels", ["doc_id", "toxic"]), ~held, name="p")
    return out.select("doc_id", held.alias("held_out"), "p.score", "p.predicted", F.col("p.neighbours").alias("evidence"))


def op11_multi_index_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found (inner product) of every 20th vector."""
    return nearest(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"]), lambda i: i % 20 == 0)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of ``documents``; the texts of every fifth document (by crc32 of
    its id) are lower-cased and their proofs folded again."""
    docs = read_table(spark, sf_dir, "documents", list(FIELDS))
    changed = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = leaf_digest([changed if f == "text" else F.col(f) for f in FIELDS])
    out = merkle_manifest(docs, carry={"tampered": F.when(_remainder(5) == 0, tampered)})
    out = out.withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("path")))
    return out.select("doc_id", "leaf", "subroot", "root", digest(proof_text(F.col("path"))).alias("proof_sha256"), "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 50th vector; every 7th vector has the next label."""
    table = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    label = F.col("label").cast("long")
    table = table.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives(table, lambda i: i % 50 == 0)


QUERIES: list[Query] = [op1_license_scan, op2_line_dedup, op3_main_text, op4_voronoi_knn, op5_mix_sources, op6_language_id, op7_benchmark_decontamination,
                        op8_sanitize, op9_ngram_jaccard_join, op10_toxicity, op11_multi_index_search, op12_merkle_manifest, op13_hard_negatives]


def queries() -> dict[str, Query]:
    return {q.__name__: q for q in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op2_line_dedup": sql.OP2, "op4_voronoi_knn": sql.OP4, "op5_mix_sources": sql.OP5, "op12_merkle_manifest": sql.OP12,
            "op13_hard_negatives": sql.OP13}
