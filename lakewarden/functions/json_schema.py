"""A subset of JSON Schema as predicates over VARIANT values.

Supported: type, required, properties, enum, minimum, maximum. Titles and other notes
are ignored; every other keyword raises, so that a rule never passes by accident.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakewarden.functions.binding import let

NOTES = {"$schema", "$id", "title", "description", "default", "examples"}


class UnsupportedSchema(ValueError):
    """A JSON Schema keyword or value outside the supported subset."""


def _is_number(kind: Column) -> Column:
    return kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")


def _has_type(value: Column, kind: Column, name: str) -> Column:
    if name == "object":
        return kind.startswith("OBJECT")
    if name == "array":
        return kind.startswith("ARRAY")
    if name == "string":
        return kind == "STRING"
    if name == "boolean":
        return kind == "BOOLEAN"
    if name == "null":
        return kind == "VOID"
    if name == "number":
        return _is_number(kind)
    if name == "integer":
        number = F.try_variant_get(value, "$", "double")
        return (kind == "BIGINT") | (_is_number(kind) & (number == F.floor(number)))
    raise UnsupportedSchema(f"unknown type: {name}")


def _equals(value: Column, kind: Column, constant) -> Column:
    if constant is None:
        return kind == "VOID"
    if isinstance(constant, bool):
        return (kind == "BOOLEAN") & (F.try_variant_get(value, "$", "boolean") == F.lit(constant))
    if isinstance(constant, (int, float)):
        return _is_number(kind) & (F.try_variant_get(value, "$", "double") == float(constant))
    if isinstance(constant, str):
        return (kind == "STRING") & (F.try_variant_get(value, "$", "string") == constant)
    raise UnsupportedSchema("enum of objects or arrays")


def conforms(value: Column, schema: dict) -> Column:
    """TRUE where the VARIANT value is valid under the schema, FALSE where it is NULL.

    The value is computed once, however often the schema looks at it.
    """
    checked = let(value, lambda v: let(F.schema_of_variant(v), lambda k: _conforms(v, k, schema)))
    return F.coalesce(checked, F.lit(False))


def _conforms(value: Column, kind: Column, schema: dict) -> Column:
    if not isinstance(schema, dict):
        raise UnsupportedSchema("schema must be an object")
    unknown = set(schema) - NOTES - {
        "type", "required", "properties", "enum", "minimum", "maximum"
    }
    if unknown:
        raise UnsupportedSchema(f"unsupported keywords: {', '.join(sorted(unknown))}")
    checks = [F.lit(True)]
    if "type" in schema:
        names = schema["type"] if isinstance(schema["type"], list) else [schema["type"]]
        checks.append(reduce(or_, [_has_type(value, kind, n) for n in names]))
    if "enum" in schema:
        checks.append(reduce(or_, [_equals(value, kind, c) for c in schema["enum"]], F.lit(False)))
    for keyword in ("minimum", "maximum"):
        if keyword in schema:
            number = F.try_variant_get(value, "$", "double")
            bound = float(schema[keyword])
            inside = number >= bound if keyword == "minimum" else number <= bound
            checks.append(~_is_number(kind) | inside)
    is_object = kind.startswith("OBJECT")
    for name in schema.get("required", []):
        checks.append(~is_object | _member(value, name).isNotNull())
    for name, inner in schema.get("properties", {}).items():
        member = _member(value, name)
        checks.append(~is_object | member.isNull() | conforms(member, inner))
    return reduce(and_, checks)


def _member(value: Column, name: str) -> Column:
    if "'" in name or "\\" in name:
        raise UnsupportedSchema(f"property name: {name}")
    return F.try_variant_get(value, f"$['{name}']", "variant")
