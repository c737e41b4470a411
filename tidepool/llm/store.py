"""Intermediate tables of the operators, in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import scratch_path


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet below ``spark.checkpoint.dir`` and read it
    back: cuts the lineage, keeps column pruning, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
