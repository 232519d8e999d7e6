"""Nested references (C8): dotted paths into structs, maps, arrays and
VARIANT values, read with native accessors.

``name.common`` is a field (or map key) of a field; ``*`` stands for every
element of an array, every value of a map, every field of a struct, and gives
an array.  What a row does not have is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def split_path(path: str) -> list[str]:
    """Parts between dots; a part in backticks may hold dots itself."""
    parts, at = [], 0
    while at <= len(path):
        if path[at:at + 1] == "`":
            end = path.index("`", at + 1)
            parts.append(path[at + 1:end])
            at = end + 2
        else:
            end = path.find(".", at)
            end = len(path) if end < 0 else end
            parts.append(path[at:end])
            at = end + 1
    return parts


def variant_path(*keys: str) -> str:
    """The VARIANT path of object keys; a key holds one kind of quote at most."""
    out = "$"
    for key in keys:
        if '"' in key and "'" in key:
            raise ValueError(f"no path to a key with both quotes: {key}")
        out += f"['{key}']" if '"' in key else f'["{key}"]'
    return out


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _field(fields: list[T.StructField], name: str) -> T.StructField | None:
    exact = [f for f in fields if f.name == name]
    return (exact or [f for f in fields if f.name.lower() == name.lower()] or [None])[0]


def _walk(value: Column, kind: T.DataType, parts: list[str]) -> Column:
    if not parts:
        return value
    part, rest = parts[0], parts[1:]
    if isinstance(kind, T.VariantType):
        return _walk_variant(value, parts)
    if part == "*":
        if isinstance(kind, T.StructType):
            types = {f.dataType.simpleString() for f in kind.fields}
            if len(types) > 1:
                raise ValueError("* over a struct needs fields of one type")
            if not kind.fields:
                return F.lit(None)
            elements, kind = F.array(*[value.getField(f.name) for f in kind.fields]), kind.fields[0].dataType
            elements = F.when(value.isNotNull(), elements)
        elif isinstance(kind, T.MapType):
            elements, kind = F.map_values(value), kind.valueType
        elif isinstance(kind, T.ArrayType):
            elements, kind = value, kind.elementType
        else:
            return F.lit(None)
        return F.transform(elements, lambda x: _walk(x, kind, rest)) if rest else elements
    if isinstance(kind, T.StructType):
        field = _field(kind.fields, part)
        return _walk(value.getField(field.name), field.dataType, rest) if field else F.lit(None)
    if isinstance(kind, T.MapType):
        return _walk(F.try_element_at(value, F.lit(part).cast(kind.keyType)), kind.valueType, rest)
    if isinstance(kind, T.ArrayType) and part.lstrip("-").isdigit():
        return _walk(F.get(value, F.lit(int(part))), kind.elementType, rest)
    return F.lit(None)


def _walk_variant(value: Column, parts: list[str]) -> Column:
    keys = parts[:parts.index("*")] if "*" in parts else parts
    if keys:
        value = F.try_variant_get(value, variant_path(*keys), "variant")
    rest = parts[len(keys) + 1:]
    if "*" not in parts:
        return value
    elements = F.coalesce(F.try_variant_get(value, "$", "array<variant>"),
                          F.map_values(F.try_variant_get(value, "$", "map<string,variant>")))
    return F.transform(elements, lambda x: _walk_variant(x, rest)) if rest else elements


def nested(df: DataFrame, path: str, dtype: str | None = None) -> Column:
    """The value at a dotted path.  A column that is named like the whole
    path comes first.  NULL where a row lacks the path, and for paths that
    the schema rules out.  ``dtype`` casts the result; VARIANT values that do
    not fit it are NULL, and without ``dtype`` they stay VARIANT."""
    field = _field(df.schema.fields, path)
    if field:
        out, kind = quoted(field.name), field.dataType
    else:
        parts = split_path(path)
        field = _field(df.schema.fields, parts[0])
        if field is None:
            out, kind = F.lit(None), T.NullType()
        else:
            out, kind = _walk(quoted(field.name), field.dataType, parts[1:]), None
            kind = df.select(out.alias("v")).schema["v"].dataType  # the plan is not run
    if dtype is None:
        return out
    if isinstance(kind, T.VariantType):
        return F.try_variant_get(out, "$", dtype)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.VariantType):
        inner = dtype.strip()
        inner = inner[len("array<"):-1] if inner.lower().startswith("array<") else inner
        return F.transform(out, lambda x: F.try_variant_get(x, "$", inner))
    return out.try_cast(dtype)


def has_path(df: DataFrame, path: str) -> bool:
    """Whether the schema has a column of that name, or one that the path
    starts with and that has parts."""
    if _field(df.schema.fields, path):
        return True
    parts = split_path(path)
    field = _field(df.schema.fields, parts[0])
    return (len(parts) > 1 and field is not None
            and isinstance(field.dataType, (T.StructType, T.MapType, T.ArrayType, T.VariantType)))
