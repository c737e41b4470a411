"""A user's own flat-map and map, for logic that columns cannot express.

Both run in Python workers, with records moved in Arrow batches; prefer built-in
functions where they do.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flat_map(df: DataFrame, fn: Callable[..., Iterable[tuple]], args: Sequence[str], returns: str) -> DataFrame:
    """Every record of ``df`` with each tuple that ``fn(*args)`` yields for it (none:
    the record goes), as columns ``returns``: a table function in a lateral join."""
    class Call:
        def eval(self, *values):
            yield from fn(*values)

    table = F.udtf(Call, returnType=returns, useArrow=True)
    return df.lateralJoin(table(*[F.col(a).outer() for a in args]))


def map_records(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], returns: str | T.StructType) -> DataFrame:
    """``fn`` over the records, a batch at a time; one record out for each one in (checked)."""
    def run(batches):
        for b in batches:
            out = fn(b)
            if len(out) != len(b):
                raise ValueError("a map must return one record for every record")
            yield out

    return df.mapInPandas(run, returns)
