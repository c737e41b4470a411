"""Vectors as packed rows, and back as numpy matrices."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def packed(table: DataFrame, id_col: str, vec_col: str, keep: Mapping[str, Column] | None = None, scale: float | None = None,
           largest: float = float("inf"), zero: bool = True) -> tuple[DataFrame, int, str]:
    """``(vec_id, vec, keep...)``, the length of the vectors and their numpy type.

    ``vec`` holds the components as bytes: as they are (32-bit floats stay so), or
    ``floor(scale * x)`` as 32-bit integers.  Rows with a null id or vector, a
    null or non-finite component, one whose ``|scale * x|`` reaches ``largest``,
    an empty vector or (``zero=False``) one of zeros only are left out, and those
    of another length than the commonest (of equally common ones the longest).
    """
    single = isinstance(table.schema[vec_col].dataType, T.ArrayType) and isinstance(table.schema[vec_col].dataType.elementType, T.FloatType)
    kind = "<i4" if scale else "<f4" if single else "<f8"
    x, keep = F.col(vec_col).cast("array<double>"), dict(keep or {})
    limit = F.lit(largest / (scale or 1.0))
    fine = F.col(id_col).isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < limit))
    if not zero:
        fine = fine & F.exists(x, lambda v: v != 0)
    rows = table.filter(F.coalesce(fine, F.lit(False)) & (F.size(x) > 0)).select(F.col(id_col).cast("long").alias("vec_id"), x.alias("vec"), *[c.alias(n) for n, c in keep.items()])
    size = rows.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    d = size["d"] if size else 0

    def run(batches):
        for b in batches:
            v = np.asarray(b.column(1).flatten().to_numpy(zero_copy_only=False), np.float64)
            v = (np.floor(scale * v) if scale else v).astype(kind)
            yield pa.RecordBatch.from_arrays([b.column(0), as_bytes(v, b.num_rows, d), *b.columns[2:]], names=b.schema.names)

    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("vec", T.BinaryType()), *[rows.schema[n] for n in keep]])
    return rows.filter(F.size("vec") == d).mapInArrow(run, schema), d, kind


def as_bytes(values: np.ndarray, n: int, per_row: int) -> pa.Array:
    """``n`` rows of ``per_row`` values as a binary column."""
    step = per_row * values.dtype.itemsize
    at = pa.array(np.arange(n + 1, dtype=np.int32) * step, pa.int32())
    return pa.Array.from_buffers(pa.binary(), n, [None, at.buffers()[1], pa.py_buffer(np.ascontiguousarray(values).tobytes())])


def matrix(col, kind: str, d: int) -> np.ndarray:
    """A binary column (Arrow or pandas) as an ``(n, d)`` matrix of ``kind``."""
    rows = col.to_pylist() if hasattr(col, "to_pylist") else list(col)
    return np.frombuffer(b"".join(bytes(r) for r in rows), kind).reshape(len(rows), d)
