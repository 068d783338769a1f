"""Diff: the events of a batch that no later event of the batch supersedes.

An event A is superseded where an event B of the same row comes later.  Rows are the same by row id, or, without row
ids, where A's primary key is B's *previous* key, so that chains of key changes collapse.

For ordered sources "some B has a greater sequence number" is "the greatest sequence number of B is greater", so the
self-join becomes an equi-join with one pre-aggregated row per key: linear in the events of a key, whatever its share.
For unordered sources the order is partial (nulls), but it is still enough to know a few maxima a key: see
``_diff_unordered``.  So both are linear, with hot keys and null keys alike; the aggregation is partial before its shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.naming import quote
from tidemark.functions.ordering import sort_keys
from tidemark.plans.envelope import BATCH_ID, BEFORE_PREFIX, ROW_ID, SEQUENCE_NUM, SOURCE_TIMESTAMP, SourceProperties


def batch_filter(staged: DataFrame, batch_id: int, latest_applied: int) -> DataFrame:
    """Rows of one batch whose sequence number is beyond the last applied one (strictly)."""
    return staged.where((F.col(BATCH_ID) == batch_id) & (F.col(SEQUENCE_NUM) > latest_applied))


def _keys(primary_keys: list[str], source: SourceProperties) -> tuple[list[str], list[str]]:
    if source.row_id:
        return [ROW_ID], [ROW_ID]
    return list(primary_keys), [f"{BEFORE_PREFIX}{k}" for k in primary_keys]


def _not_null(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in cols])


def _keep_unless_below_max(a: DataFrame, b: DataFrame, own: list[str], other: list[str], order: str) -> DataFrame:
    """Rows of ``a`` without a row in ``b`` of the same key and greater ``order``."""
    names = [f"__k{i}" for i in range(len(own))]
    top = (
        b.where(_not_null([F.col(quote(k)) for k in other]))
        .groupBy(*[F.col(quote(k)).alias(n) for k, n in zip(other, names, strict=True)])
        .agg(F.max(order).alias("__top"))
    )
    on = reduce(lambda x, y: x & y, [a[quote(k)] == top[n] for k, n in zip(own, names, strict=True)])
    return a.join(top, on, "left").where(F.col("__top").isNull() | (F.col(order) >= F.col("__top"))).drop("__top", *names)


def diff(staged: DataFrame, primary_keys: list[str], source: SourceProperties, n_sort_keys: int = 0) -> DataFrame:
    """Surviving events, in all staging columns.  Ties survive; events without a row id survive."""
    own, other = _keys(primary_keys, source)
    if source.ordered:
        return _keep_unless_below_max(staged, staged, own, other, SEQUENCE_NUM).select(*[quote(c) for c in staged.columns])
    return _diff_unordered(staged, own, other, n_sort_keys)


def _diff_unordered(staged: DataFrame, own: list[str], other: list[str], n: int) -> DataFrame:
    """One left join with per-key maxima.  With the first sort key null on either side, timestamp and sequence decide.
    Else B is later than A where some prefix of A's sort keys is less than B's; as a null ends what can be compared, the
    greatest prefix of each length among the events that know it stands for all of them."""
    def get(c: str) -> Column:
        return F.col(c)

    keys = sort_keys(get, n) if n else []
    prefixes = [F.when(_not_null(keys[: q + 1]), F.struct(*[k.alias(f"o{i}") for i, k in enumerate(keys[: q + 1])])) for q in range(n)]
    arrival = F.when(F.col(SOURCE_TIMESTAMP).isNotNull(), F.struct(F.col(SOURCE_TIMESTAMP).alias("ts"), F.col(SEQUENCE_NUM).alias("seq")))
    unkeyed = keys[0].isNull() if keys else F.lit(True)
    tops = [F.max(p).alias(f"__top{q}") for q, p in enumerate(prefixes)]
    tops += [F.max(arrival).alias("__any"), F.max(F.when(unkeyed, arrival)).alias("__unkeyed")]
    names = [f"__k{i}" for i in range(len(own))]
    top = staged.where(_not_null([F.col(quote(k)) for k in other])).groupBy(*[F.col(quote(k)).alias(x) for k, x in zip(other, names, strict=True)]).agg(*tops)
    on = reduce(lambda x, y: x & y, [staged[quote(k)] == top[x] for k, x in zip(own, names, strict=True)])
    beaten = [p < F.col(f"__top{q}") for q, p in enumerate(prefixes)]
    beaten.append(arrival < F.when(unkeyed, F.col("__any")).otherwise(F.col("__unkeyed")))
    later_exists = reduce(lambda x, y: x | y, [F.coalesce(b, F.lit(False)) for b in beaten])
    return staged.join(top, on, "left").where(~later_exists).select(*[quote(c) for c in staged.columns])
