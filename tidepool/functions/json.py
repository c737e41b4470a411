"""JSON field access with the reference's existence / null / text rules.

Records are parsed once into ``VARIANT`` (``parse_json``); fields are read
with ``variant_get`` family built-ins, so nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse(json_text: Column, strict: bool = True) -> Column:
    """Parse a JSON string.  Strict mode fails the job on malformed input
    (as the reference does); permissive mode yields NULL for such records."""
    return F.parse_json(json_text) if strict else F.try_parse_json(json_text)


def field(v: Column, path: str) -> Column:
    """The sub-document at ``path``; SQL NULL when a step is missing or the
    parent is not an object.  A present JSON ``null`` is *not* SQL NULL."""
    return F.try_variant_get(v, path, "variant")


def has(v: Column, path: str) -> Column:
    """Existence test (``has``): true for any present value, JSON null included."""
    return field(v, path).isNotNull()


def as_text(node: Column) -> Column:
    """Text of a JSON node as a tree-model ``asText`` gives it: strings as is,
    scalars in their JSON spelling, ``null`` for JSON null, and the empty
    string for objects and arrays."""
    kind = F.schema_of_variant(node)
    return (
        F.when(node.isNull(), F.lit(None).cast("string"))
        .when(F.is_variant_null(node), F.lit("null"))
        .when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.lit(""))
        .otherwise(F.try_variant_get(node, "$", "string"))
    )
