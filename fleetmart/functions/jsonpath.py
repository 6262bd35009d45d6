"""JSON access: scalars, subtrees, typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _path(key: str) -> str:
    return key if key.startswith("$") else f"$.{key}"


def scalar_only(text: Column, doc: Column, key: str) -> Column:
    """Drop objects and arrays from an extracted text.

    Only text that looks like an object or array is checked again, through a variant that keeps the value's kind, so a
    string such as "{x" is still returned and ordinary values are parsed once.
    """
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(doc), _path(key), "variant"))
    return F.when(~text.startswith("{") & ~text.startswith("["), text).when(kind == "STRING", text)


def json_scalar(doc: Column, key: str) -> Column:
    """Text of a scalar; NULL for objects, arrays, missing keys and broken documents."""
    return scalar_only(F.get_json_object(doc, _path(key)), doc, key)


def json_subtree(doc: Column, key: str) -> Column:
    """Any value at the path as JSON text: arrays and objects keep their form."""
    return F.get_json_object(doc, _path(key))


def json_as(doc: Column, key: str, type_name: str) -> Column:
    """Typed scalar, NULL when the text does not convert."""
    return json_scalar(doc, key).try_cast(type_name)


def first_scalar(doc: Column, *keys: str) -> Column:
    """First key that has a scalar; serves documents written under different key names."""
    return F.coalesce(*[json_scalar(doc, k) for k in keys])


GATEWAY_FIELDS = [
    # Output column, path, type.
    ("gateway_name", "$.gateway", "string"),
    ("gateway_reference", "$.reference", "string"),
    ("gateway_status", "$.status", "string"),
    ("gateway_amount", "$.amount", "double"),
    ("gateway_timestamp", "$.timestamp", "string"),
    ("client_ip", "$.metadata.ip", "string"),
    ("client_device", "$.metadata.device", "string"),
]


def gateway_columns(doc: Column) -> list[Column]:
    return [json_as(doc, path, type_name).alias(name) for name, path, type_name in GATEWAY_FIELDS]
