"""Records of JSON pages, typed by the whole source.

Pages are parsed as VARIANT.  The schema is merged over all records of all
pages by one aggregate, so a field that only a later record has, or a value
of another type, is in the result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nested import variant_path


class RecordError(ValueError):
    """Strict mode: a page that is no JSON, or a value that does not fit."""


def page_records(pages: DataFrame, results_path: str = "", body_col: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` and ``_rec`` (VARIANT), a row a record.

    The list at ``results_path`` (``a.b.c``, object keys) is exploded; an
    object or a scalar there is one record; a missing path or a null has
    none.  Pages that are no JSON (or repeat a key in one object) have none,
    and are counted by :func:`unreadable_pages`."""
    at = variant_path(*filter(None, results_path.split(".")))
    node = F.try_variant_get(F.try_parse_json(F.col(body_col)), at, "variant")
    some = pages.select(*keep, node.alias("_node")).where(F.col("_node").isNotNull() & ~F.is_variant_null("_node"))
    listed = F.try_variant_get("_node", "$", "array<variant>")
    return some.select(*keep, F.explode(F.coalesce(listed, F.array("_node"))).alias("_rec"))


def unreadable_pages(body_col: str = "body") -> Column:
    """Aggregate: pages that are there and cannot be parsed."""
    return F.count_if(F.col(body_col).isNotNull() & (F.trim(F.col(body_col)) != "") & F.try_parse_json(F.col(body_col)).isNull())


def _settled(kind: T.DataType) -> T.DataType:
    """The column type of a merged type.  Decimals with a fraction become
    doubles, mixed types and fields that are null everywhere become text
    (nested mixed values as JSON), whole numbers beyond a long stay decimal."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _settled(f.dataType)) for f in kind.fields]) if kind.fields else T.StringType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_settled(kind.elementType))
    if isinstance(kind, T.DecimalType) and kind.scale > 0:
        return T.DoubleType()
    if isinstance(kind, (T.VariantType, T.NullType)):
        return T.StringType()
    return kind


def merged_schema(records: DataFrame, rec_col: str = "_rec") -> T.DataType:
    """The type that holds every record: the union of all fields, each of
    the widest type its values have.  One aggregate over all records; what
    reaches the driver is the type's text."""
    text = records.select(F.schema_of_variant_agg(rec_col)).first()[0]
    in_backticks_or_object = re.compile(r"(`(?:[^`]|``)*`)|\bOBJECT<")
    return _settled(T._parse_datatype_string(in_backticks_or_object.sub(lambda m: m[1] or "STRUCT<", text)))


def _columns(schema: T.StructType) -> list[tuple[str, str, T.DataType]]:
    """Key, column name and type; a name that differs from an earlier one
    only in case gets a number."""
    out, seen = [], {}
    for f in schema.fields:
        seen[f.name.lower()] = seen.get(f.name.lower(), 0) + 1
        n = seen[f.name.lower()]
        out.append((f.name, f.name if n == 1 else f"{f.name}_{n}", f.dataType))
    return out


@dataclass
class Records:
    """Typed rows, their type, and the values that did not fit (by column)."""

    rows: DataFrame
    schema: T.DataType
    unfit: dict[str, int]


def typed_records(records: DataFrame, schema: T.DataType | str | None = None, strict: bool = False,
                  rec_col: str = "_rec", keep: tuple[str, ...] = ()) -> Records:
    """Columns of the records (a single ``_rec`` where records are no objects).

    Without ``schema`` the merged type is used, which every value fits.  With
    one, a value that cannot be cast to its type is NULL and counted, and
    raises in strict mode; records that are no objects count for every
    column.  Fields outside a given schema are left out: that is what giving
    one means."""
    given = schema is not None
    if schema is None:
        schema = merged_schema(records, rec_col)
    elif isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    rec = F.col(rec_col)
    if isinstance(schema, T.StructType):
        cells = [(variant_path(key), name, kind) for key, name, kind in _columns(schema)]
    else:
        cells = [("$", "_rec", schema)]
    raw = {name: F.try_variant_get(rec, path, "variant") for path, name, _ in cells}
    typed = {name: F.try_variant_get(rec, path, _ddl(kind))
             for path, name, kind in cells}
    unfit: dict[str, int] = {}
    if given and cells:
        no_object = F.lit(False)
        if isinstance(schema, T.StructType):
            no_object = ~F.is_variant_null(rec) & F.try_variant_get(rec, "$", "map<string,variant>").isNull()
        bad = [F.count_if(no_object | (raw[n].isNotNull() & ~F.is_variant_null(raw[n]) & typed[n].isNull())).alias(f"_{i}")
               for i, n in enumerate(raw)]
        unfit = {n: v for n, v in zip(raw, records.agg(*bad).first()) if v}
        if unfit and strict:
            raise RecordError("values that do not fit: " + ", ".join(f"{n} ({v})" for n, v in unfit.items()))
    return Records(records.select(*keep, *[c.alias(n) for n, c in typed.items()]), schema, unfit)


def _ddl(kind: T.DataType) -> str:
    """A type with its field names quoted."""
    if isinstance(kind, T.StructType):
        return "struct<" + ",".join(f"`{f.name.replace('`', '``')}`:{_ddl(f.dataType)}" for f in kind.fields) + ">"
    if isinstance(kind, T.ArrayType):
        return f"array<{_ddl(kind.elementType)}>"
    return kind.simpleString()
