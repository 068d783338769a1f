"""Source type to warehouse type and to Spark type.

Source schemas are plain data: ``Field(name, type, nullable)`` where ``type`` is one of the simple names below,
``Decimal(p, s)``, ``Array(element)`` or ``Record(fields)``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Simple source types, with the warehouse's type and Spark's.
SIMPLE_TYPES = {
    "INT": ("INT64", T.LongType()),
    "LONG": ("INT64", T.LongType()),
    "FLOAT": ("FLOAT64", T.DoubleType()),
    "DOUBLE": ("FLOAT64", T.DoubleType()),
    "STRING": ("STRING", T.StringType()),
    "ENUM": ("STRING", T.StringType()),
    "BOOLEAN": ("BOOL", T.BooleanType()),
    "BYTES": ("BYTES", T.BinaryType()),
    "DATE": ("DATE", T.DateType()),
    "TIME_MILLIS": ("TIME", T.LongType()),
    "TIME_MICROS": ("TIME", T.LongType()),
    "TIMESTAMP_MILLIS": ("TIMESTAMP", T.TimestampType()),
    "TIMESTAMP_MICROS": ("TIMESTAMP", T.TimestampType()),
    "DATETIME": ("DATETIME", T.TimestampNTZType()),
}
# Warehouse types that a table can be clustered on.
CLUSTERABLE = {"DATE", "BOOL", "GEOGRAPHY", "INT64", "NUMERIC", "STRING", "TIMESTAMP", "DATETIME"}
NUMERIC_MAX_PRECISION, NUMERIC_MAX_SCALE = 38, 9
LOGICAL_TO_BASE = {
    "DATE": "INT",
    "TIME_MILLIS": "INT",
    "TIME_MICROS": "LONG",
    "TIMESTAMP_MILLIS": "LONG",
    "TIMESTAMP_MICROS": "LONG",
    "DATETIME": "STRING",
}


@dataclass(frozen=True)
class Decimal:
    precision: int
    scale: int


@dataclass(frozen=True)
class Array:
    element: object
    element_nullable: bool = False


@dataclass(frozen=True)
class Record:
    fields: tuple


@dataclass(frozen=True)
class Field:
    name: str
    type: object
    nullable: bool = False


class UnsupportedType(ValueError):
    """The type has no counterpart in the target."""


def _array_element(t: Array) -> str:
    if isinstance(t.element, Decimal):
        return "BYTES"
    if isinstance(t.element, str) and t.element in SIMPLE_TYPES:
        return LOGICAL_TO_BASE.get(t.element, t.element)
    raise UnsupportedType(f"an array of {t.element!r} is not supported")


def warehouse_type(t: object) -> str:
    """Name of the warehouse's type."""
    if isinstance(t, Decimal):
        fits = t.precision <= NUMERIC_MAX_PRECISION and t.scale <= NUMERIC_MAX_SCALE
        return "NUMERIC" if fits else "BIGNUMERIC"
    if isinstance(t, Array):
        return SIMPLE_TYPES[_array_element(t)][0]
    if isinstance(t, Record):
        return "STRUCT"
    if isinstance(t, str) and t in SIMPLE_TYPES:
        return SIMPLE_TYPES[t][0]
    raise UnsupportedType(f"type {t!r} is not supported")


def spark_type(t: object) -> T.DataType:
    """Spark's type.  Times are microseconds of the day, decimals beyond 38 digits are strings."""
    if isinstance(t, Decimal):
        if t.precision > 38:
            return T.StringType()
        return T.DecimalType(t.precision if warehouse_type(t) == "NUMERIC" else 38, t.scale)
    if isinstance(t, Array):
        return T.ArrayType(SIMPLE_TYPES[_array_element(t)][1], containsNull=False)
    if isinstance(t, Record):
        return spark_schema(t.fields)
    if isinstance(t, str) and t in SIMPLE_TYPES:
        return SIMPLE_TYPES[t][1]
    raise UnsupportedType(f"type {t!r} is not supported")


def spark_schema(fields) -> T.StructType:
    return T.StructType([T.StructField(f.name, spark_type(f.type), f.nullable) for f in fields])


def mode(field: Field) -> str:
    if isinstance(field.type, Array):
        return "REPEATED"
    return "NULLABLE" if field.nullable else "REQUIRED"


def clustering_keys(fields, primary_keys: list[str], limit: int = 4) -> list[str]:
    """Primary-key columns of a clusterable type, at most ``limit``; none where the limit is not positive."""
    types = {f.name: f.type for f in fields}
    keys = []
    for k in primary_keys:
        if k in types and not isinstance(types[k], Array | Record) and warehouse_type(types[k]) in CLUSTERABLE:
            keys.append(k)
    return keys[: max(0, limit)]


def from_spark(schema: T.StructType) -> list[Field]:
    """Fields for a Spark schema, for tables that are described by DataFrames."""

    def kind(t):
        if isinstance(t, T.DecimalType):
            return Decimal(t.precision, t.scale)
        if isinstance(t, T.ArrayType):
            return Array(kind(t.elementType), t.containsNull)
        if isinstance(t, T.StructType):
            return Record(tuple(from_spark(t)))
        names = {
            T.ByteType: "INT", T.ShortType: "INT", T.IntegerType: "INT", T.LongType: "LONG", T.FloatType: "FLOAT",
            T.DoubleType: "DOUBLE", T.StringType: "STRING", T.BooleanType: "BOOLEAN", T.BinaryType: "BYTES",
            T.DateType: "DATE", T.TimestampType: "TIMESTAMP_MICROS", T.TimestampNTZType: "DATETIME",
        }
        return names.get(type(t), type(t).__name__)

    return [Field(f.name, kind(f.dataType), f.nullable) for f in schema.fields]
