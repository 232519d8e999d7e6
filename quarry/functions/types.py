"""Type names, type maps and column-by-type selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The type names that schema files and constraint maps use
# beside Spark's own.
SPARK_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}

# Pandas-style dtype names used by constraint maps, as Spark types.
DTYPE_NAMES = {
    "int64": T.LongType(),
    "int32": T.IntegerType(),
    "float64": T.DoubleType(),
    "float32": T.FloatType(),
    "object": T.StringType(),
    "str": T.StringType(),
    "string": T.StringType(),
    "bool": T.BooleanType(),
    "boolean": T.BooleanType(),
    "datetime64[ns]": T.TimestampType(),
}

# Column type -> SQL column type used when a database table
# gains a column (anything else becomes TEXT).
SQL_COLUMN_TYPES = {
    "bigint": "BIGINT",
    "double": "DOUBLE PRECISION",
    "string": "TEXT",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
    "int": "INTEGER",
    "float": "REAL",
}


def spark_type(name: str) -> T.DataType:
    """Resolve a type name from a schema file or constraint map: one of the
    names above, or any type Spark's DDL knows.  Others raise ``ValueError``."""
    key = str(name).strip().lower()
    known = SPARK_TYPES.get(key) or DTYPE_NAMES.get(key)
    if known is not None:
        return known
    try:
        return T._parse_datatype_string(key)
    except Exception as error:
        raise ValueError(f"unknown type name {name!r}") from error


def is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, T.NumericType)


def is_fractional(dt: T.DataType) -> bool:
    return isinstance(dt, (T.DoubleType, T.FloatType))


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """All numeric columns (byte..bigint, float, double, decimal)."""
    return [f.name for f in df.schema.fields if is_numeric(f.dataType) and f.name not in exclude]


def string_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def columns_named_like(df: DataFrame, keywords=("date", "time"), only_strings=True) -> list[str]:
    """Columns whose name *tokens* contain a keyword (``order_date`` yes,
    ``sentiment`` no), restricted to string columns by default."""
    out = []
    for f in df.schema.fields:
        tokens = [t for t in f.name.lower().replace("-", "_").split("_") if t]
        hit = any(t in keywords or any(t.startswith(k) and t[len(k):] in ("", "s", "stamp") for k in keywords)
                  for t in tokens)
        if hit and (not only_strings or isinstance(f.dataType, T.StringType)):
            out.append(f.name)
    return out


def sql_column_type(dt: T.DataType, overrides: dict | None = None) -> str:
    table = dict(SQL_COLUMN_TYPES)
    table.update(overrides or {})
    return table.get(dt.simpleString(), table.get("string", "TEXT"))
