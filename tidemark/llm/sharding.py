"""Sharding by a permutation-filled lookup table.

Each shard orders the slots of a prime-sized table by its own permutation (offset + j * skip); shards take turns, in the
order given, each claiming the first slot of its preference that is free, until the table is full.  A key goes to the
shard that holds slot ``hash(key) mod size``.  Adding or removing a shard moves little more than its share.

The table has a fixed number of entries (``size``, 8,191), whatever the data and the number of shards, so broadcasting
it is bounded; looking a key up is one hash join probe, without a shuffle of the data.

Defined results: a null key counts as the empty text, so all null keys share one shard; equal keys share a shard; an
empty table gives no rows; the table's other columns are not read.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_SIZE = 8191
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def _digest(text: str) -> tuple[int, int]:
    d = hashlib.md5(text.encode()).hexdigest()
    return int(d[:15], 16), int(d[16:31], 16)


def fill(shards: tuple[str, ...], size: int = TABLE_SIZE) -> list[int]:
    """The lookup table: for each slot the number of the shard that claimed it."""
    if not shards or len(set(shards)) != len(shards) or len(shards) > size:
        raise ValueError("give distinct shards, no more than the table has slots")
    if size < 3 or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError("the table's size must be a prime of 3 or more")
    state = []
    for s in shards:
        a, b = _digest(s)
        state.append([a % size, b % (size - 1) + 1])
    slots, free = [-1] * size, size
    while free:
        for i, st in enumerate(state):
            at, skip = st
            while slots[at] >= 0:
                at = (at + skip) % size
            slots[at] = i
            st[0] = (at + skip) % size
            free -= 1
            if not free:
                break
    return slots


def lookup_table(spark: SparkSession, shards: tuple[str, ...] = SHARDS, size: int = TABLE_SIZE) -> DataFrame:
    """(slot, shard) rows."""
    owners = F.split(F.lit(",".join(map(str, fill(shards, size)))), ",")
    names = F.array(*[F.lit(s) for s in shards])
    rows = spark.range(1).select(F.posexplode(owners).alias("slot", "owner"))
    return rows.select("slot", F.element_at(names, F.col("owner").cast("int") + 1).alias("shard"))


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """Slot of a key: sixty bits of the md5 of its text, modulo the table's size."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % size).cast("int")


def place(docs: DataFrame, key: str = "doc_id", shards: tuple[str, ...] = SHARDS, size: int = TABLE_SIZE) -> DataFrame:
    """(key, slot, shard) for every row."""
    table = F.broadcast(lookup_table(docs.sparkSession, shards, size))
    return docs.select(key, slot_of(F.col(key), size).alias("slot")).join(table, "slot").select(key, "slot", "shard")


def oracle_sql(shards: tuple[str, ...] = SHARDS, size: int = TABLE_SIZE) -> str:
    """The same placement by a recursive query that makes one claim a step."""
    names = ", ".join(f"({i}, '{s}')" for i, s in enumerate(shards))
    return f"""WITH RECURSIVE s(i, name) AS (VALUES {names}),
    p AS MATERIALIZED (SELECT i, name, CAST('0x' || substr(md5(name), 1, 15) AS BIGINT) % {size} AS o,
        CAST('0x' || substr(md5(name), 17, 15) AS BIGINT) % {size - 1} + 1 AS k FROM s),
    claims(step, slot, taken) AS (
        SELECT 0, CAST(-1 AS BIGINT), list_transform(range({size}), lambda x: FALSE)
        UNION ALL
        SELECT step + 1, pos, list_concat(list_concat(taken[1 : pos], [TRUE]), taken[pos + 2 :]) FROM (
            SELECT step, taken, (o + k * list_filter(range({size}), lambda j: NOT taken[(o + j * k) % {size} + 1])[1]) % {size} AS pos
            FROM claims JOIN p ON p.i = step % {len(shards)} WHERE step < {size})),
    lookup AS MATERIALIZED (SELECT CAST(slot AS INTEGER) AS slot, p.name AS shard FROM claims JOIN p ON p.i = (step - 1) % {len(shards)} WHERE step > 0)
    SELECT doc_id, slot, shard FROM (SELECT doc_id,
        CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) % {size} AS INTEGER) AS slot FROM documents) JOIN lookup USING (slot)"""
