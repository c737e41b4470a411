"""Readers for the Parquet tables and the record shapes the jobs consume."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """One Parquet table; selecting ``columns`` here makes the scan's
    ``ReadSchema`` carry only those columns."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def spread(df: DataFrame, key: str | None = None, min_partitions: int | None = None) -> DataFrame:
    """Give per-record work (tokenising, parsing) enough tasks.

    A Parquet file with a single row group is read as one split.  Only when
    the scan has fewer splits than the cluster has cores is the input
    re-hashed (on ``key`` when given, which is deterministic on task retry).
    Large inputs already have many splits and are left untouched, so this
    adds no shuffle at scale.
    """
    spark = df.sparkSession
    target = min_partitions or spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, key) if key else df.repartition(target)


def as_utc_timestamp(col: str = "ts"):
    """Zone-free timestamps (``TIMESTAMP_NTZ``) as ``TIMESTAMP`` so watermarks
    and ``unix_micros`` accept them; the session zone is UTC, so the
    wall-clock value is unchanged."""
    return F.col(col).cast("timestamp")
