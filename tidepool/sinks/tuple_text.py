"""Sinks: tuple-formatted text files, no-op, console -- for tables and streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def tuple_lines(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One ``value`` line per row, formatted ``(f0,f1,...)``; NULL fields
    print as ``null``."""
    cols = list(cols or df.columns)
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in cols]
    return df.select(F.concat(F.lit("("), F.concat_ws(",", *fields), F.lit(")")).alias("value"))


def write_tuple_text(df: DataFrame, path: str, cols: Sequence[str] | None = None) -> None:
    """Write tuple lines as text files; fails if ``path`` already exists."""
    tuple_lines(df, cols).write.mode("errorifexists").text(path)


def stream_tuple_text(stream: DataFrame, path: str, cols: Sequence[str] | None = None) -> DataStreamWriter:
    """A stream's rows appended as tuple lines to text files below ``path``
    (exactly once; needs a ``checkpointLocation``)."""
    return tuple_lines(stream, cols).writeStream.format("text").option("path", path).outputMode("append")


def stream_show(stream: DataFrame, n: int = 20, mode: str = "append") -> DataStreamWriter:
    """Debug print of every micro-batch, one tuple per line."""
    return (tuple_lines(stream).writeStream.format("console").option("numRows", n)
            .option("truncate", "false").outputMode(mode))


def write_noop(df: DataFrame) -> None:
    """Run the plan and discard its rows (throughput measurement)."""
    df.write.format("noop").mode("overwrite").save()


def show(df: DataFrame, n: int = 20) -> None:
    """Debug print, one tuple per line."""
    df.show(n, truncate=False)


def parse_tuple_line(line_col: str = "line", types: Sequence[str] = ("string", "bigint"),
                     names: Sequence[str] = ("word", "n")):
    """Columns parsed back from ``(f0,...,fk)`` lines (fields must not
    contain commas)."""
    body = F.expr(f"substring({line_col}, 2, length({line_col}) - 2)")
    parts = F.split(body, ",", -1)
    return [F.element_at(parts, i + 1).cast(t).alias(n) for i, (t, n) in enumerate(zip(types, names))]
