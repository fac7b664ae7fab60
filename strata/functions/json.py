"""Embedded JSON: structs, unit arrays in both spellings, VARIANT edges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import schemas


def parse_struct(c: Column, schema: T.StructType) -> Column:
    return F.from_json(c, schema)


def parse_array(c: Column, element: T.StructType) -> Column:
    """JSON array text; Python-style single quotes are accepted too."""
    return F.from_json(c, T.ArrayType(element))


def _field(struct: Column, name: str) -> Column:
    return struct.getField(name)


def parse_units(c: Column) -> Column:
    """Unit list in either of its raw forms, with one set of field names.

    Blocks arrive as an array of objects, tables as an array of JSON *texts*.
    """
    blocks = F.from_json(c, T.ArrayType(schemas.UNIT))
    texts = F.from_json(c, T.ArrayType(T.StringType()))
    wanted = list(schemas.UNIT_FIELDS.items())
    from_blocks = F.transform(
        blocks, lambda u: F.struct(*[_field(u, spelled[0]).alias(n) for n, spelled in wanted])
    )
    from_texts = F.transform(
        F.transform(texts, lambda t: F.from_json(t, schemas.UNIT_TABLE)),
        lambda u: F.struct(*[_field(u, spelled[1]).alias(n) for n, spelled in wanted]),
    )
    is_text = c.rlike(r"""^\s*\[\s*['"]""")
    return F.when(is_text, from_texts).otherwise(from_blocks)


def to_record(**fields: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))


def variant_field(c: Column, path: str, type_name: str) -> Column:
    """One field of a JSON text by way of VARIANT; NULL where text or type do not fit."""
    return F.try_variant_get(F.try_parse_json(c), path, type_name)
