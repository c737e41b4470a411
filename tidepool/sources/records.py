"""Record sources: in-memory elements, text lines, JSON records, keyed ranges
and car telemetry.  Each returns a DataFrame with an explicit order column,
because a DataFrame has no arrival order of its own."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fixed import KEYED_RANGE_KEYS, TELEMETRY_FIELDS
from ..functions.telemetry import cast_field, line_fields
from .tables import as_utc_timestamp


def from_elements(spark: SparkSession, values: Sequence, column: str = "text",
                  dtype: T.DataType = T.StringType()) -> DataFrame:
    """In-memory records in array order: ``(seq, <column>)``."""
    schema = T.StructType([T.StructField("seq", T.LongType(), False), T.StructField(column, dtype, True)])
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], schema)


def from_tuples(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """In-memory tuples in array order with a leading ``seq`` column."""
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "seq long, " + schema)


def text_lines(spark: SparkSession, path: str, streaming: bool = False, files_per_batch: int | None = None) -> DataFrame:
    """One record per line: ``(file, line_start, line_no, line)``.

    Batch: the order key ``(file, line_start, line_no)`` is the line order
    inside each file (``line_no`` increases within a split; splits of a file
    are ordered by their start offset).  Streaming: new files arrive in
    micro-batches (at most ``files_per_batch`` each); Spark offers no per-line
    id on streams, so only ``(file, line_start)`` is given (``line_no`` is NULL);
    :func:`numbered_lines` orders the lines of a micro-batch.
    """
    reader = spark.readStream if streaming else spark.read
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    line_no = F.lit(None).cast("long") if streaming else F.monotonically_increasing_id()
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("line_start"),
        line_no.alias("line_no"),
        F.col("value").alias("line"),
    )


def numbered_lines(batch: DataFrame, name: str = "line_no") -> DataFrame:
    """A micro-batch of streamed ``text_lines`` with the ordinal of each line (0,
    1, ...) in the order of files, splits and lines.

    Lines are numbered within their split as they are read; the splits' sizes
    (one row per split) give the rest."""
    rows = batch.drop("line_no").withColumn("_at", F.monotonically_increasing_id())
    splits = rows.groupBy("file", "line_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = F.sum("_n").over(Window.orderBy("file", "line_start").rowsBetween(Window.unboundedPreceding, -1))
    starts = splits.select("file", "line_start", "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    joined = rows.join(starts, ["file", "line_start"])
    return joined.select("file", "line_start", (F.col("_before") + F.col("_at") - F.col("_first")).cast("long").alias(name), "line")


def json_records(documents: DataFrame) -> DataFrame:
    """Tweet-shaped JSON records built from ``documents``:
    ``{"text": ..., "user": {"lang": ...}}`` keyed by ``doc_id``."""
    return documents.select(
        "doc_id",
        F.to_json(F.struct(F.col("text"), F.struct(F.col("lang")).alias("user"))).alias("json"),
    )


def keyed_range(df: DataFrame, id_col: str, n_keys: int = KEYED_RANGE_KEYS) -> DataFrame:
    """Cyclic keyed records ``(key 1..n_keys, value 1)`` over a dense id:
    record ``i`` gets key ``i mod n_keys + 1``, as a cyclic counter source
    emits them.  ``arrival_ms`` = the record index (one record per ms)."""
    return df.select(
        F.col(id_col).alias("seq"),
        (F.col(id_col) % n_keys + 1).cast("long").alias("key"),
        F.lit(1).cast("long").alias("value"),
        F.timestamp_millis(F.col(id_col)).alias("arrival"),
    )


def synthetic_keyed_range(spark: SparkSession, n: int, n_keys: int = KEYED_RANGE_KEYS,
                          rows_per_ms: int = 1) -> DataFrame:
    """The same shape from ``spark.range`` (bench only: a throughput source)."""
    ids = spark.range(n)
    return ids.select(
        F.col("id").alias("seq"),
        (F.col("id") % n_keys + 1).alias("key"),
        F.lit(1).cast("long").alias("value"),
        F.timestamp_millis(F.floor(F.col("id") / rows_per_ms)).alias("arrival"),
    )


def telemetry_from_events(events: DataFrame, n_cars: int = 8) -> DataFrame:
    """Car records from the events table: ``car_id = user_id mod n_cars``,
    ``speed = value`` (km/h), ``ts``, ``seq = event_id`` (arrival order)."""
    return events.select(
        F.col("event_id").alias("seq"),
        (F.col("user_id") % n_cars).cast("int").alias("car_id"),
        F.col("value").alias("speed"),
        as_utc_timestamp("ts").alias("ts"),
    )


def telemetry_lines(events: DataFrame, n_cars: int = 8) -> DataFrame:
    """Text lines ``(car_id,speed,distance,epoch_ms)`` built from events
    (speed = whole km/h, distance = value), to exercise the line parser."""
    ts = as_utc_timestamp("ts")
    return events.select(
        F.col("event_id").alias("seq"),
        F.concat(
            F.lit("("),
            F.concat_ws(",", (F.col("user_id") % n_cars).cast("string"),
                        F.floor("value").cast("int").cast("string"),
                        F.col("value").cast("string"),
                        F.unix_millis(ts).cast("string")),
            F.lit(")"),
        ).alias("line"),
    )


def parse_telemetry(lines: DataFrame, line_col: str = "line", strict: bool = True) -> DataFrame:
    """Parse ``(car_id,speed,distance,epoch_ms)`` lines.  Extra fields are
    ignored.  Strict mode fails the job on a malformed line; permissive mode
    keeps the row with NULL fields and ``parse_ok = false``."""
    fields = line_fields(F.col(line_col))
    types = ("int", "int", "double", "bigint")
    out = lines.select(
        *[c for c in lines.columns if c != line_col],
        *[cast_field(fields, i, t, strict).alias(n) for i, (n, t) in enumerate(zip(TELEMETRY_FIELDS, types))],
    ).withColumn("ts", F.timestamp_millis("ts_ms"))
    if not strict:
        ok = F.col("car_id").isNotNull() & F.col("speed").isNotNull() & F.col("distance").isNotNull() \
            & F.col("ts_ms").isNotNull()
        out = out.withColumn("parse_ok", ok)
    return out
