"""Declared column types: what Spark type each reads as, what can be bound, and which conversions are refused.

Declared lengths of text types are not enforced. TIME has no Spark type that is on by default; it is read as text and
checked. A conversion that Spark would allow but the declared rules do not (whole numbers to booleans or times, for
instance) is refused when the table is opened; a value that does not fit its type raises when it is read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


class UnsupportedTypeError(ValueError):
    pass


class CoercionError(ValueError):
    pass


#: Names of declared types by what they read as.
NAMES = {
    "boolean": T.BooleanType(), "bool": T.BooleanType(),
    "smallint": T.ShortType(), "int2": T.ShortType(),
    "integer": T.IntegerType(), "int": T.IntegerType(), "int4": T.IntegerType(), "serial": T.IntegerType(),
    "bigint": T.LongType(), "int8": T.LongType(),
    "real": T.FloatType(), "float4": T.FloatType(),
    "double precision": T.DoubleType(), "float8": T.DoubleType(), "double": T.DoubleType(),
    "char": T.StringType(), "character": T.StringType(), "bpchar": T.StringType(), "varchar": T.StringType(), "character varying": T.StringType(),
    "text": T.StringType(), "string": T.StringType(), "name": T.StringType(), "bit": T.StringType(),
    "bytea": T.BinaryType(), "date": T.DateType(), "time": T.StringType(),
    "timestamp": T.TimestampNTZType(), "timestamptz": T.TimestampType(), "timestamp with time zone": T.TimestampType(),
}
REJECTED = {"money", "cidr", "inet", "macaddr", "point", "line", "lseg", "box", "path", "circle", "interval", "json", "jsonb", "enum", "oid", "xml", "uuid"}
UNBINDABLE = {"bytea", "time"}
#: Pairs of source family and declared family that are refused though Spark would cast.
REFUSED = {("number", "boolean"), ("number", "timestamp"), ("number", "date"), ("date", "boolean"), ("boolean", "date"), ("boolean", "timestamp"), ("date", "time"), ("number", "time"), ("boolean", "time")}
TIME = r"([01]?\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d{1,6})?)?"


def base_name(declared: str) -> str:
    return re.sub(r"\(.*\)", "", declared.lower()).strip()


def spark_type(declared: str) -> T.DataType:
    name = base_name(declared)
    if name.endswith("[]"):
        raise UnsupportedTypeError(f'unsupported data type "{declared}": arrays can be used in expressions alone')
    if name in ("numeric", "decimal"):
        m = re.search(r"\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)", declared)
        return T.DecimalType(int(m[1]), int(m[2] or 0)) if m else T.DecimalType(38, 18)
    if name in NAMES:
        return NAMES[name]
    hint = "; supported: " + ", ".join(sorted({*NAMES, "numeric"}))
    raise UnsupportedTypeError(f'unsupported data type "{declared}"{hint}')


def bindable(declared: str) -> bool:
    name = base_name(declared)
    return (name in NAMES or name in ("numeric", "decimal", "json")) and name not in UNBINDABLE


def family(of: T.DataType) -> str:
    if isinstance(of, T.NumericType):
        return "number"
    if isinstance(of, (T.TimestampType, T.TimestampNTZType)):
        return "timestamp"
    return of.typeName() if not isinstance(of, (T.VarcharType, T.CharType)) else "string"


def coerced(column: Column, source: T.DataType, declared: str, empty_as_null: bool = True) -> Column:
    """The column as its declared type. Empty text counts as null for every type if asked for."""
    target = spark_type(declared)
    to = "time" if base_name(declared) == "time" else family(target)
    if (family(source), to) in REFUSED:
        raise CoercionError(f"cannot read {source.simpleString()} as {declared}")
    if isinstance(source, T.StringType) and empty_as_null:
        column = F.when(column != "", column)
    if to == "time":
        text = column.cast("string")
        return F.when(text.isNull() | text.rlike(f"^{TIME}$"), text).otherwise(F.raise_error(F.concat(F.lit("invalid time: "), text)).cast("string"))
    if to == "date" and isinstance(source, T.StringType):
        return F.substring(F.trim(column), 1, 10).cast("date")
    if isinstance(target, T.BinaryType):
        return column.cast("string").cast("binary")
    return column if source == target else column.cast(target)
