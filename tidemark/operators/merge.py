"""MERGE of surviving events into a target, as one full outer join.

First matching clause wins: matched DELETE, matched INSERT/UPDATE, unmatched INSERT/UPDATE, unmatched DELETE.
"Matched" is decided by the key alone; the guard (soft delete, or "the event is later than the row") only decides
whether the clause fires.  Two events that fire on one row are an error, as in standard SQL.

The events are grouped by match key before the join, so that each target row comes out of the join exactly once and the
target is shuffled once, without a window over it.  Events whose match key holds a null can match nothing and skip the
join (and its grouping) altogether.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.naming import quote
from tidemark.functions.ordering import later
from tidemark.plans.envelope import (
    BEFORE_PREFIX,
    DELETE,
    IS_DELETED,
    OPERATION,
    ROW_ID,
    SORT,
    SOURCE_TIMESTAMP,
    SourceProperties,
)


def merge_columns(names: list[str], source: SourceProperties) -> list[str]:
    """Columns that the clauses set.  For ordered sources any name containing the sort column's name is left out."""
    out = []
    for n in names:
        if n == IS_DELETED:
            continue
        if source.ordered and (n == SOURCE_TIMESTAMP or SORT in n):
            continue
        if n == ROW_ID and not source.row_id:
            continue
        out.append(n)
    return out


def add_sort_column(target: DataFrame, sort: T.DataType) -> DataFrame:
    """Add the sort column, null for older rows, where the target lacks it."""
    return target if SORT in target.columns else target.withColumn(SORT, F.lit(None).cast(sort))


def merge(
    target: DataFrame,
    events: DataFrame,
    primary_keys: list[str],
    batch_columns: list[str],
    source: SourceProperties,
    n_sort_keys: int = 0,
) -> DataFrame:
    """The target after the events.  ``batch_columns``: the batch's view of the target schema; other columns keep
    their value on update and are null on insert."""
    if n_sort_keys and not source.ordered:
        target = add_sort_column(target, events.schema[SORT].dataType)
    if source.row_id:
        own, theirs = [ROW_ID], [ROW_ID]
    else:
        own, theirs = list(primary_keys), [f"{BEFORE_PREFIX}{k}" for k in primary_keys]
    listed = [c for c in merge_columns(batch_columns, source) if c in events.columns]
    missing = [c for c in listed if c not in target.columns]
    for c in missing:
        target = target.withColumn(c, F.lit(None).cast(events.schema[c].dataType))
    schema = target.schema

    payload = F.struct(*[F.col(quote(c)) for c in dict.fromkeys([*listed, OPERATION])])
    keyed = reduce(lambda a, b: a & b, [F.col(quote(k)).isNotNull() for k in theirs])
    names = [f"__k{i}" for i in range(len(theirs))]
    grouped = (
        events.where(keyed)
        .groupBy(*[F.col(quote(k)).cast(schema[o].dataType).alias(n) for k, o, n in zip(theirs, own, names, strict=True)])
        .agg(F.collect_list(payload).alias("__events"))
    )
    t = target.withColumn("__t", F.lit(True))
    on = reduce(lambda a, b: a & b, [t[quote(o)] == grouped[n] for o, n in zip(own, names, strict=True)])
    joined = t.join(grouped, on, "full_outer")
    of_target = _matched(joined.where(F.col("__t")), schema, listed, source, n_sort_keys)
    unmatched = joined.where(F.col("__t").isNull()).select(F.explode("__events").alias("__e"))
    unmatched = unmatched.unionByName(events.where(~keyed).select(payload.alias("__e")))
    return of_target.unionByName(_inserted(unmatched, schema, listed, source))


def _matched(rows: DataFrame, schema: T.StructType, listed: list[str], source: SourceProperties, n: int) -> DataFrame:
    def guard(e: Column) -> Column:
        if not source.ordered:
            return later(lambda c: F.col(c), lambda c: e[c], n)
        return ~F.coalesce(F.col(IS_DELETED), F.lit(False)) if source.soft_deletes else F.lit(True)

    fired = F.filter(F.coalesce(F.col("__events"), F.array()), lambda e: F.coalesce(guard(e), F.lit(False)))
    rows = rows.withColumn("__f", fired)
    many = F.raise_error(F.lit("a merge must not change one target row more than once"))
    rows = rows.withColumn("__e", F.when(F.size("__f") > 1, many.cast(rows.schema["__f"].dataType.elementType)).otherwise(F.get("__f", F.lit(0))))
    e = F.col("__e")
    fires, deletes = e.isNotNull(), F.coalesce(e[OPERATION] == DELETE, F.lit(False))
    if source.ordered and not source.soft_deletes:
        rows = rows.where(~(fires & deletes))
    # An ordered soft delete marks the row and leaves every other column alone.
    takes = fires & ~deletes if source.ordered else fires
    out = []
    for f in schema.fields:
        old = F.col(quote(f.name))
        if f.name == IS_DELETED:
            new = F.when(fires & deletes, F.lit(True)).when(fires, F.lit(None).cast("boolean")).otherwise(old)
        elif f.name in listed:
            new = F.when(takes, e[f.name].cast(f.dataType)).otherwise(old)
        else:
            new = old
        out.append(new.alias(f.name))
    return rows.select(*out)


def _inserted(rows: DataFrame, schema: T.StructType, listed: list[str], source: SourceProperties) -> DataFrame:
    e = F.col("__e")
    deletes = e[OPERATION] == DELETE
    if source.ordered:
        rows = rows.where(~deletes)
    out = []
    for f in schema.fields:
        if f.name == IS_DELETED:
            c = F.when(deletes, F.lit(True)) if not source.ordered else F.lit(None).cast("boolean")
        elif f.name in listed:
            c = e[f.name].cast(f.dataType)
        else:
            c = F.lit(None).cast(f.dataType)
        out.append(c.alias(f.name))
    return rows.select(*out)
