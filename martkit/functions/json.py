"""JSON documents held as strings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_text(doc: Column, *path: str) -> Column:
    """Text at a path of object keys; null where the path is absent."""
    return F.get_json_object(doc, "$" + "".join(f"['{key}']" for key in path))


def json_entries(doc: Column, value_type: str = "string") -> Column:
    """Generator of (key, value) rows of one JSON object."""
    return F.explode(F.from_json(doc, f"map<string,{value_type}>"))


def json_items(doc: Column, item_type: str) -> Column:
    """Generator of the elements of a JSON array."""
    return F.explode(F.from_json(doc, f"array<{item_type}>"))


def json_set(doc: Column, path: Sequence[str], value: Column, schema: str | T.DataType) -> Column:
    """Document with the value at an existing ``path`` replaced.

    ``schema`` describes the document as nested maps and structs; keys it
    leaves out are not kept, so describe open objects as maps. Numbers are
    written back in the schema's type.
    """
    parsed_type = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    parsed = F.from_json(doc, parsed_type)
    replaced = _replace(parsed, parsed_type, list(path), value)
    return F.when(json_text(doc, *path).isNull(), doc).otherwise(F.to_json(replaced))


def _replace(node: Column, node_type: T.DataType, path: list[str], value: Column) -> Column:
    if not path:
        return value.cast(node_type)
    key, rest = path[0], path[1:]
    if isinstance(node_type, T.MapType):
        child = _replace(F.element_at(node, key), node_type.valueType, rest, value)
        return F.transform_values(node, lambda k, v: F.when(k == key, child).otherwise(v))
    if isinstance(node_type, T.StructType):
        child = _replace(node[key], node_type[key].dataType, rest, value)
        return node.withField(key, child)
    raise ValueError(f"cannot descend into {node_type.simpleString()} with key {key!r}")
