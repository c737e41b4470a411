"""Column expressions for car telemetry records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import KMH_TO_MPS_DIVISOR


def line_fields(line: Column) -> Column:
    """Drop the first and the last character (no check that they are
    brackets) and split the rest on commas."""
    return F.split(line.substr(F.lit(2), F.length(line) - 2), ",", -1)


def cast_field(fields: Column, i: int, dtype: str, strict: bool) -> Column:
    """Element ``i`` of ``fields`` cast to ``dtype``; strict casts fail the
    job on malformed values (ANSI), permissive ones return NULL."""
    if strict:
        return F.element_at(fields, i + 1).cast(dtype)
    return F.try_element_at(fields, F.lit(i + 1)).try_cast(dtype)


def speed_centi(speed: Column) -> Column:
    """Speed in 1/100 km/h as an exact integer (inputs carry two decimals)."""
    return F.round(speed * 100).cast("bigint")


def centi_kmh_seconds_to_metres(total_centi: Column) -> Column:
    """Σ(speed·1 s) in 1/100 km/h·s → metres, with one final division so the
    value is reproducible bit for bit by any engine."""
    return total_centi.cast("double") / F.lit(round(100 * KMH_TO_MPS_DIVISOR, 9))
