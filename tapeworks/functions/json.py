"""Typed access to one JSON object per line through Spark's VARIANT type.

The ingest must know the JSON *type* of each value (an integer price is
rejected, a string price is accepted), which ``from_json`` with a schema would
hide. ``try_parse_json`` keeps it, and ``schema_of_variant`` names it.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# A line must hold exactly one object. Spark's parser stops after one value and
# accepts any text behind it, so the line is parsed as the first element of an
# array that a known second element closes: text behind the object would come
# between the two, and a line that closes the array itself has no such element.
_OBJECT_LINE = r"(?s)^\s*\{.*\}\s*$"
_CLOSING = "end of line"


def json_object(line: Column) -> Column:
    """Parse ``line`` to a VARIANT; NULL unless it is one JSON object."""
    pair = F.try_parse_json(F.when(line.rlike(_OBJECT_LINE),
                                   F.concat(F.lit("["), line, F.lit(f',"{_CLOSING}"]'))))
    closed = F.try_variant_get(pair, "$[1]", "string") == _CLOSING
    return F.when(closed, F.try_variant_get(pair, "$[0]", "variant"))


def json_field(obj: Column, *keys: str) -> Column:
    """Value of the first present key as a VARIANT (JSON null stays a variant
    null); SQL NULL when no key is present."""
    return F.coalesce(*[F.try_variant_get(obj, f"$.{k}", "variant") for k in keys])


def json_type(value: Column) -> Column:
    """Type name of a VARIANT value: ``BIGINT``, ``DECIMAL(4,2)``, ``DOUBLE``,
    ``STRING``, ``BOOLEAN``, ``VOID`` (JSON null), ``OBJECT<…>``, ``ARRAY<…>``."""
    return F.schema_of_variant(value)
