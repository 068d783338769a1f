"""Sequence-number high-water marks, the replay gate and event counters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.envelope import SEQUENCE_NUM

TABLES_PER_QUERY = 1000  # Fixed value: tables in one maximum query.


def max_sequence(table: DataFrame | None) -> int:
    """Greatest sequence number; 0 for a missing or empty table."""
    return 0 if table is None else max_sequence_frame(table).first()[0]


def max_sequence_frame(table: DataFrame) -> DataFrame:
    if SEQUENCE_NUM not in table.columns:
        raise ValueError(f"the table has no {SEQUENCE_NUM} column")
    return table.agg(F.coalesce(F.max(SEQUENCE_NUM), F.lit(0).cast("long")).alias("max_seq"))


def max_sequence_union(tables: list[DataFrame]) -> DataFrame:
    """One row: the maximum over all tables, from per-table maxima."""
    parts = [max_sequence_frame(t) for t in tables]
    return reduce(DataFrame.unionAll, parts).agg(F.coalesce(F.max("max_seq"), F.lit(0).cast("long")).alias("max_seq"))


def max_existing_sequence(wanted: set[str], existing: dict[str, DataFrame], per_query: int = TABLES_PER_QUERY) -> int:
    """Maximum over the wanted tables that exist, a bounded number of tables a query; no query where none exists."""
    names, top = sorted(wanted & set(existing)), 0
    for i in range(0, len(names), per_query):
        top = max(top, max_sequence_union([existing[n] for n in names[i : i + per_query]]).first()[0])
    return top


def replay_gate(events: DataFrame, latest_merged: int) -> DataFrame:
    """Drop events that were applied before: keep ``seq`` strictly beyond the mark."""
    return events.where(F.col("seq") > latest_merged)


def operation_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("tbl", F.upper("op").alias("op")).agg(F.count(F.lit(1)).alias("n_events"))


def batch_counts(events: DataFrame) -> DataFrame:
    """Number of events of each batch object, that is each database, table and snapshot flag."""
    return events.groupBy("db", "tbl", "is_snapshot").agg(F.count(F.lit(1)).alias("n_events"))
