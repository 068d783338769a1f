"""Metadata columns, the event envelope, and the staging projection."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names of the metadata columns.
SEQUENCE_NUM = "_sequence_num"
IS_DELETED = "_is_deleted"
ROW_ID = "_row_id"
SOURCE_TIMESTAMP = "_source_timestamp"
SORT = "_sort"
SORT_KEY = "_key_"
OPERATION = "_op"
BATCH_ID = "_batch_id"
BEFORE_PREFIX = "_before_"
INSERT, UPDATE, DELETE = "INSERT", "UPDATE", "DELETE"


@dataclass(frozen=True)
class SourceProperties:
    """What the source guarantees, and the soft-delete option, which matters for ordered sources only."""

    row_id: bool = False
    ordered: bool = True
    soft_deletes: bool = False


@dataclass(frozen=True)
class TableSpec:
    """A table's row columns, its primary key and its sort-key types (empty: none known)."""

    schema: T.StructType
    primary_keys: tuple[str, ...]
    sort_types: tuple[T.DataType, ...] = field(default=())
    source_names: tuple[str, ...] = ()  # the columns' names at the source, where they differ

    @property
    def columns(self) -> list[str]:
        return self.schema.names


def sort_type(types) -> T.StructType:
    return T.StructType([T.StructField(f"{SORT_KEY}{i}", t, True) for i, t in enumerate(types)])


def metadata_fields(spec: TableSpec, source: SourceProperties) -> list[T.StructField]:
    out = [
        T.StructField(SEQUENCE_NUM, T.LongType(), False),
        T.StructField(IS_DELETED, T.BooleanType(), True),
        T.StructField(ROW_ID, T.StringType(), True),
        T.StructField(SOURCE_TIMESTAMP, T.LongType(), True),
    ]
    if not source.ordered and spec.sort_types:
        out.append(T.StructField(SORT, sort_type(spec.sort_types), True))
    return out


def target_schema(spec: TableSpec, source: SourceProperties, metadata_first: bool = True) -> T.StructType:
    """Target columns; a table made by DDL has the metadata first, a batch's view of it has them last."""
    meta, own = metadata_fields(spec, source), list(spec.schema.fields)
    return T.StructType(meta + own if metadata_first else own + meta)


def staging_schema(spec: TableSpec, source: SourceProperties) -> T.StructType:
    out = list(spec.schema.fields)
    out += [
        T.StructField(OPERATION, T.StringType(), False),
        T.StructField(BATCH_ID, T.LongType(), False),
        T.StructField(SEQUENCE_NUM, T.LongType(), False),
    ]
    if not source.ordered:
        out.append(T.StructField(SOURCE_TIMESTAMP, T.LongType(), False))
        if spec.sort_types:
            out.append(T.StructField(SORT, sort_type(spec.sort_types), True))
    if source.row_id:
        out.append(T.StructField(ROW_ID, T.StringType(), False))
    else:
        out += [T.StructField(f"{BEFORE_PREFIX}{f.name}", f.dataType, True) for f in spec.schema.fields]
    return T.StructType(out)


def stage(events: DataFrame, spec: TableSpec, source: SourceProperties, batch_id: int) -> DataFrame:
    """Envelope rows (op, seq, source_ts, row_id, sort, row, prev) to staging rows.

    Without row ids each row carries its previous image: the old row for UPDATE, the row itself for DELETE, nulls for
    INSERT; an UPDATE without an old row is an error.
    """
    op = F.upper(F.col("op"))
    cols: list[Column] = [F.col("row")[n].alias(n) for n in spec.columns]
    cols += [op.alias(OPERATION), F.lit(batch_id).cast("long").alias(BATCH_ID), F.col("seq").cast("long").alias(SEQUENCE_NUM)]
    if not source.ordered:
        cols.append(F.col("source_ts").cast("long").alias(SOURCE_TIMESTAMP))
        if spec.sort_types:
            cols.append(F.col("sort").cast(sort_type(spec.sort_types)).alias(SORT))
    if source.row_id:
        cols.append(F.col("row_id").cast("string").alias(ROW_ID))
    else:
        missing = F.raise_error(F.lit("an UPDATE needs its previous row where the source has no row ids"))
        for f in spec.schema.fields:
            prev = F.when(F.col("prev").isNull(), missing.cast(f.dataType)).otherwise(F.col("prev")[f.name])
            before = F.when(op == UPDATE, prev).when(op == DELETE, F.col("row")[f.name])
            cols.append(before.cast(f.dataType).alias(f"{BEFORE_PREFIX}{f.name}"))
    return events.select(*cols)


def snapshot_rows(events: DataFrame, spec: TableSpec, source: SourceProperties) -> DataFrame:
    """Envelope rows of a snapshot as target rows, for appending."""
    cols = [F.col("row")[n].alias(n) for n in spec.columns]
    cols += [F.col("seq").cast("long").alias(SEQUENCE_NUM), F.lit(None).cast("boolean").alias(IS_DELETED)]
    cols.append((F.col("row_id") if source.row_id else F.lit(None)).cast("string").alias(ROW_ID))
    cols.append((F.lit(None) if source.ordered else F.col("source_ts")).cast("long").alias(SOURCE_TIMESTAMP))
    if not source.ordered and spec.sort_types:
        cols.append(F.col("sort").cast(sort_type(spec.sort_types)).alias(SORT))
    return events.select(*cols)


def is_json_format(schema: T.StructType) -> bool:
    """Whether the row-format staging file would have to be JSON: a DATETIME column or a non-ASCII name."""
    from tidemark.functions.naming import is_ascii_name

    return any(isinstance(f.dataType, T.TimestampNTZType) or not is_ascii_name(f.name) for f in schema.fields)
