"""The corpus pipeline: five stages over ``documents``, each on what the one
before kept.

1. toxicity drops the documents predicted toxic (learned from ``labels``);
2. line dedup takes boilerplate lines out of the texts, source by source;
3. near duplicates keep one document of each group (5-word shingles, Jaccard 0.8);
4. decontamination drops the documents that leak a ``benchmark`` item;
5. mixing takes the rest in the sources' target proportions.

Each stage takes ``(spark, docs, sf_dir)``; all but the last return the columns
of ``documents``, the last ``mix_sources``'s rows.  ``run`` writes each stage's
result as Parquet in the shared folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.decontaminate import drop_contaminated
from tidepool.llm.jaccard_join import one_per_group
from tidepool.llm.line_dedup import drop_boilerplate
from tidepool.llm.store import written
from tidepool.llm.toxicity import drop_toxic
from tidepool.llm.wfq_mix import mix_sources
from tidepool.session import apply_recommended_conf
from tidepool.sources.tables import read_table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    apply_recommended_conf(spark)
    return drop_toxic(docs, read_table(spark, sf_dir, "labels", ["doc_id", "toxic"]))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    apply_recommended_conf(spark)
    out = drop_boilerplate(docs, "source")
    if "n_chars" not in docs.columns:
        return out
    kind = docs.schema["n_chars"].dataType
    return out.withColumn("n_chars", F.char_length("text").cast(kind)).select(docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    apply_recommended_conf(spark)
    return one_per_group(docs, k=5, num=80, den=100)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    apply_recommended_conf(spark)
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    apply_recommended_conf(spark)
    return mix_sources(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_dedup_stage),
    ("near duplicates", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources", mixing_stage),
]

#: SQL cannot express the toxicity, near-duplicate and tiling stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
