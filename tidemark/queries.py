"""Registered queries over the synthetic tables, with equivalent SQL.

The ``events`` table serves as a change stream: key ``user_id``, sequence ``event_id + 1`` (arrival order), signup is an
INSERT, error a DELETE, anything else an UPDATE.  The target is seeded from the first half of the stream.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import jsonfmt, naming
from tidemark.functions.types import from_spark
from tidemark.operators import sequence
from tidemark.operators.assess import Assessor
from tidemark.operators.ddl import DdlEvent, DdlHandler
from tidemark.operators.diff import batch_filter, diff
from tidemark.operators.merge import add_sort_column
from tidemark.plans.apply import TableApplier, append_snapshot, apply_events, live_rows
from tidemark.plans.envelope import IS_DELETED, SEQUENCE_NUM, SORT, SourceProperties, TableSpec, sort_type, stage
from tidemark.sources.files import scratch_dir
from tidemark.sources.store import Store
from tidemark.streaming.consumer import ENVELOPE, Consumer

ROW = T.StructType([T.StructField("id", T.LongType()), T.StructField("value", T.DoubleType()), T.StructField("kind", T.StringType())])
SORTS = (T.LongType(), T.LongType())
ASSESSED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "labels")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spec(source: SourceProperties) -> TableSpec:
    return TableSpec(ROW, ("id",), () if source.ordered else SORTS)


def envelope(spark: SparkSession, sf_dir: str, key_changes: bool = False, null_keys: bool = False, row_ids: bool = False) -> DataFrame:
    """The change stream as envelope rows."""
    e, t = F.col("event_id"), F.col("event_type")
    op = F.when(t == "signup", "INSERT").when(t == "error", "DELETE").otherwise("UPDATE")
    previous = F.when(e % 5 == 0, F.col("user_id") + 1).otherwise(F.col("user_id")) if key_changes else F.col("user_id")
    key0 = F.when(e % 11 == 0, F.lit(None).cast("long")).otherwise(e % 7) if null_keys else e % 7
    row = F.struct(F.col("user_id").alias("id"), "value", t.alias("kind"))
    prev = F.struct(previous.alias("id"), "value", t.alias("kind"))
    return _table(spark, sf_dir, "events").select(
        F.lit("shop").alias("db"), F.lit("public").alias("schema"), F.lit("users").alias("tbl"), op.alias("op"),
        (e % 2 == 0).alias("is_snapshot"), (e + 1).alias("seq"), ((e * 7919) % 100003).alias("source_ts"),
        F.when(F.lit(row_ids) | (e % 97 != 0), F.col("user_id").cast("string")).alias("row_id"),
        F.struct(key0.alias("_key_0"), e.alias("_key_1")).alias("sort"),
        row.alias("row"), F.when(op == "UPDATE", prev).alias("prev"), e.cast("string").alias("offset"),
    )


_OP = "CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END"


def _staged_sql(key_changes: bool, null_keys: bool) -> str:
    prev = "CASE WHEN event_id % 5 = 0 THEN user_id + 1 ELSE user_id END" if key_changes else "user_id"
    key0 = "CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id % 7 END" if null_keys else "event_id % 7"
    return f"""SELECT user_id AS id, value, event_type AS kind, {_OP} AS op, event_id + 1 AS seq,
        (event_id * 7919) % 100003 AS ts, CASE WHEN event_id % 97 <> 0 THEN CAST(user_id AS VARCHAR) END AS row_id,
        {key0} AS k0, event_id AS k1,
        CASE {_OP} WHEN 'UPDATE' THEN {prev} WHEN 'DELETE' THEN user_id END AS before_id
        FROM events"""


_LATER = """(({l}.k0 IS NOT NULL AND {r}.k0 IS NOT NULL AND ({l}.k0 < {r}.k0 OR ({l}.k0 = {r}.k0 AND {l}.k1 < {r}.k1)))
    OR (({l}.k0 IS NULL OR {r}.k0 IS NULL) AND ({l}.ts < {r}.ts OR ({l}.ts = {r}.ts AND {l}.seq < {r}.seq))))"""


def _diff_query(source: SourceProperties):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = _spec(source)
        staged = stage(envelope(spark, sf_dir, not source.row_id, not source.ordered), spec, source, 1)
        out = diff(batch_filter(staged, 1, 0), ["id"], source, len(spec.sort_types))
        return out.select("id", "value", "kind", F.col("_op").alias("op"), F.col(SEQUENCE_NUM).alias("seq"))

    return run


def _diff_sql(source: SourceProperties) -> str:
    same = "a.row_id = b.row_id" if source.row_id else "a.id = b.before_id"
    after = "a.seq < b.seq" if source.ordered else _LATER.format(l="a", r="b")
    return f"""WITH s AS ({_staged_sql(not source.row_id, not source.ordered)})
        SELECT id, value, kind, op, seq FROM s a WHERE NOT EXISTS (SELECT 1 FROM s b WHERE {same} AND {after})"""


def seeded_target(spark: SparkSession, sf_dir: str, source: SourceProperties, every: bool = False) -> DataFrame:
    """Latest row of each user in the first half of the stream, some soft-deleted.  Every third user is new to the target
    (unless ``every``), so that a merge has rows to insert."""
    e = F.col("event_id")
    events = _table(spark, sf_dir, "events")
    half = events.agg((F.max("event_id") / 2).cast("long").alias("half"))
    last = F.max(F.struct("event_id", "value", F.col("event_type").alias("kind"))).alias("x")
    t = events.crossJoin(F.broadcast(half)).where((e <= F.col("half")) & (F.lit(every) | (F.col("user_id") % 3 != 0))).groupBy("user_id").agg(last)
    x = F.col("x")
    cols = [
        F.col("user_id").alias("id"), x["value"].alias("value"), x["kind"].alias("kind"), (x["event_id"] + 1).alias(SEQUENCE_NUM),
        F.when(F.col("user_id") % 5 == 0, True).alias(IS_DELETED), F.col("user_id").cast("string").alias("_row_id"),
        ((x["event_id"] * 7919) % 100003).alias("_source_timestamp"),
    ]
    if not source.ordered:
        key0 = F.when(F.col("user_id") % 4 == 0, F.lit(None).cast("long")).otherwise(x["event_id"] % 7)
        cols.append(F.struct(key0.alias("_key_0"), x["event_id"].alias("_key_1")).alias(SORT))
    return t.select(*cols)


def full_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest row of every user over all events; some are soft-deleted."""
    last = F.max(F.struct("event_id", "value", F.col("event_type").alias("kind"))).alias("x")
    t = _table(spark, sf_dir, "events").groupBy("user_id").agg(last)
    return t.select(
        F.col("user_id").alias("id"), "x.value", "x.kind", (F.col("x.event_id") + 1).alias(SEQUENCE_NUM),
        F.when(F.col("user_id") % 5 == 0, True).alias(IS_DELETED), F.col("user_id").cast("string").alias("_row_id"),
        ((F.col("x.event_id") * 7919) % 100003).alias("_source_timestamp"),
    )


def _half(spark: SparkSession, sf_dir: str) -> int:
    return _table(spark, sf_dir, "events").agg((F.max("event_id") / 2).cast("long")).first()[0] or 0


def _store(spark: SparkSession) -> Store:
    return Store(spark, f"{scratch_dir(spark)}/store-{uuid.uuid4().hex}")


def _batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = envelope(spark, sf_dir)
    half = _table(spark, sf_dir, "events").agg((F.max("event_id") / 2).cast("long").alias("half"))
    return events.crossJoin(F.broadcast(half)).where(F.col("seq") - 1 > F.col("half")).drop("half")


def _merge_query(source: SourceProperties):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = apply_events(seeded_target(spark, sf_dir, source), _batch(spark, sf_dir), _spec(source), source)
        return out.select("id", "value", "kind", F.col(SEQUENCE_NUM).alias("seq"), F.col(IS_DELETED).alias("is_deleted"))

    return run


def _merge_sql(source: SourceProperties, add_sort: bool = False) -> str:
    same = "a.row_id = b.row_id" if source.row_id else "a.id = b.before_id"
    match = "t.row_id = d.row_id" if source.row_id else "t.id = d.before_id"
    after = "a.seq < b.seq" if source.ordered else _LATER.format(l="a", r="b")
    guard = "TRUE"
    if not source.ordered:
        guard = f"coalesce({_LATER.format(l='t', r='d')}, FALSE)"
    elif source.soft_deletes:
        guard = "t.is_deleted IS NOT TRUE"
    soft = source.soft_deletes or not source.ordered
    takes = "fired AND op <> 'DELETE'" if source.ordered else "fired"

    def col(c: str) -> str:
        return f"CASE WHEN NOT in_t OR ({takes}) THEN d_{c} ELSE t_{c} END AS {c}"

    where = "(in_t OR op <> 'DELETE')" if source.ordered else "TRUE"
    where += "" if soft else " AND NOT (in_t AND fired AND op = 'DELETE')"
    deleted = "CASE WHEN NOT in_t OR fired THEN CASE WHEN op = 'DELETE' THEN TRUE END ELSE t_del END AS is_deleted"
    rest = f"{col('key_0')}, {col('key_1')}" if add_sort else f"{col('kind')}, {col('seq')}, {deleted}"
    target_keys = "CAST(NULL AS BIGINT) AS k0, CAST(NULL AS BIGINT) AS k1" if add_sort else "CASE WHEN e.user_id % 4 = 0 THEN NULL ELSE e.event_id % 7 END AS k0, e.event_id AS k1"
    return f"""WITH s0 AS ({_staged_sql(False, False)}), half AS (SELECT CAST(floor(max(event_id) / 2) AS BIGINT) AS h FROM events),
    s AS (SELECT s0.* FROM s0, half WHERE seq - 1 > h),
    d AS (SELECT * FROM s a WHERE NOT EXISTS (SELECT 1 FROM s b WHERE {same} AND {after})),
    last AS (SELECT user_id, max(event_id) AS event_id FROM events, half WHERE event_id <= h{'' if add_sort else ' AND user_id % 3 <> 0'} GROUP BY user_id),
    t AS (SELECT e.user_id AS id, value, event_type AS kind, e.event_id + 1 AS seq, CASE WHEN e.user_id % 5 = 0 THEN TRUE END AS is_deleted,
        CAST(e.user_id AS VARCHAR) AS row_id, (e.event_id * 7919) % 100003 AS ts,
        {target_keys}, TRUE AS in_t
        FROM events e JOIN last l ON e.event_id = l.event_id),
    j AS (SELECT t.id AS t_id, t.value AS t_value, t.kind AS t_kind, t.seq AS t_seq, t.is_deleted AS t_del, coalesce(in_t, FALSE) AS in_t, t.k0 AS t_key_0, t.k1 AS t_key_1, d.k0 AS d_key_0, d.k1 AS d_key_1,
        d.id AS d_id, d.value AS d_value, d.kind AS d_kind, d.seq AS d_seq, d.op, (in_t AND d.seq IS NOT NULL AND {guard}) IS TRUE AS fired
        FROM t FULL OUTER JOIN d ON {match})
    SELECT {col('id')}, {col('value')}, {rest} FROM j WHERE {where}"""


_SOURCES = {
    "ordered_pk": SourceProperties(),
    "ordered_rowid": SourceProperties(row_id=True),
    "softdelete_pk": SourceProperties(soft_deletes=True),
    "softdelete_rowid": SourceProperties(row_id=True, soft_deletes=True),
    "unordered_pk": SourceProperties(ordered=False),
    "unordered_rowid": SourceProperties(row_id=True, ordered=False),
}


def snapshot_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = SourceProperties(row_id=True)
    t = append_snapshot(full_target(spark, sf_dir), envelope(spark, sf_dir).where("is_snapshot"), _spec(source), source)
    return t.select("id", "value", F.col(SEQUENCE_NUM).alias("seq"), F.col(IS_DELETED).alias("is_deleted"))


_FULL_SQL = """t AS (SELECT e.user_id AS id, e.value, e.event_type AS kind, e.event_id + 1 AS seq, CASE WHEN e.user_id % 5 = 0 THEN TRUE END AS is_deleted
    FROM events e JOIN (SELECT user_id, max(event_id) AS event_id FROM events GROUP BY user_id) l ON e.event_id = l.event_id)"""
_HALF_SQL = "(SELECT CAST(floor(max(event_id) / 2) AS BIGINT) FROM events)"


def seq_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.max_sequence_frame(_table(spark, sf_dir, "events").select((F.col("event_id") + 1).alias(SEQUENCE_NUM)))


def seq_max_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = {"events": "event_id", "orders": "o_orderkey", "customer": "c_custkey"}
    return sequence.max_sequence_union([_table(spark, sf_dir, t).select(F.col(k).alias(SEQUENCE_NUM)) for t, k in keys.items()])


def replay_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.replay_gate(envelope(spark, sf_dir), 1000).select("seq", "op", F.col("row.id").alias("id"))


def op_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.operation_counts(envelope(spark, sf_dir))


def batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.batch_counts(envelope(spark, sf_dir))


#: Names with characters that the rules treat differently, made from a base column.
_ODD = ["{}", "2 {}", "{}?/x", "{}-né&%", "9|{}\t!"]


def _odd_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.col("c_name")
    parts = [F.concat(*[base if x == "{}" else F.lit(x) for x in _pieces(p)]) for p in _ODD]
    return _table(spark, sf_dir, "customer").select("c_custkey", F.element_at(F.array(*parts), (F.col("c_custkey") % len(_ODD) + 1).cast("int")).alias("name"))


def _pieces(pattern: str) -> list[str]:
    a, b = pattern.split("{}")
    return [x for x in (a, "{}", b) if x]


_ODD_SQL = "SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN c_name WHEN 1 THEN '2 ' || c_name WHEN 2 THEN c_name || '?/x' WHEN 3 THEN c_name || '-né&%' ELSE '9|' || c_name || chr(9) || '!' END AS name FROM customer"


def _naming_query(f):
    return lambda spark, sf_dir: _odd_names(spark, sf_dir).select("c_custkey", "name", f(F.col("name")).alias("normalized"))


def _naming_sql(pattern: str, limit: int, digits: bool) -> str:
    inner = f"regexp_replace(name, '{pattern}', '_', 'g')"
    if digits:
        inner = f"CASE WHEN regexp_matches({inner}, '^[0-9]') THEN '_' || {inner} ELSE {inner} END"
    return f"SELECT c_custkey, name, substr({inner}, 1, {limit}) AS normalized FROM ({_ODD_SQL})"


def resolve_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    configured = F.when(F.col("c_custkey") % 3 == 0, "").when(F.col("c_custkey") % 3 == 1, "set name")
    return _odd_names(spark, sf_dir).select("c_custkey", naming.resolve_dataset_col(configured, F.col("name")).alias("dataset"))


def ascii_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _odd_names(spark, sf_dir).select("c_custkey", naming.ascii_name_col(F.col("name")).alias("is_ascii"))


def datetime_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    text = F.when(e % 3 == 0, F.concat(F.lit("2022-4-1 4:01:2."), F.lpad((e * 7919 % 1000000000).cast("string"), 9, "0"))).when(
        e % 3 == 1, F.concat(F.lit("2022-04-01T14:31:12."), F.lpad((e % 1000000).cast("string"), 6, "0"))
    ).otherwise(F.lit("2022-04-01"))
    return _table(spark, sf_dir, "events").select("event_id", jsonfmt.datetime_json(text).alias("datetime"))


def _json_query(kind: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        events, e = _table(spark, sf_dir, "events"), F.col("event_id")
        value = {
            "date": jsonfmt.date_json(e - 5000),
            "time": jsonfmt.time_json(e * 8640123 % 86400000000),
            "time_millis": jsonfmt.time_json(e * 8640 % 86400000, "millis"),
            "timestamp": jsonfmt.timestamp_json((e - 5000) * 1234567890123),
            "timestamp_millis": jsonfmt.timestamp_json((e - 5000) * 1234567890, "millis"),
            "decimal": jsonfmt.decimal_json((e.cast("decimal(12,2)") / 4).cast("decimal(12,2)")),
            "bytes": jsonfmt.bytes_json(F.col("event_type").cast("binary")),
            "array": F.to_json(jsonfmt.array_json(F.array(e, e + 1))),
        }[kind]
        return events.select("event_id", value.alias("json_value"))

    return run


def json_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 2 == 0, F.col("event_type")).alias("kind"), F.struct("user_id", "event_type").alias("nested"))
    return t.select("event_id", jsonfmt.record_json(t).alias("json_value"))


def add_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge into a table that has no sort column yet: rows that no event changes get a null one."""
    source = SourceProperties(row_id=True, ordered=False)
    target = seeded_target(spark, sf_dir, source, every=True).drop(SORT)
    out = apply_events(add_sort_column(target, sort_type(SORTS)), _batch(spark, sf_dir), _spec(source), source)
    return out.select("id", "value", F.col("_sort")["_key_0"].alias("key_0"), F.col("_sort")["_key_1"].alias("key_1"))


def alter_add_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table, loaded from the first half of the stream; a column is added; the second half is merged."""
    store, source, half = _store(spark), SourceProperties(row_id=True), _half(spark, sf_dir)
    handler = DdlHandler(store, source)
    handler.handle(DdlEvent("CREATE_TABLE", "shop", "users", ROW, ("id",)))
    events = envelope(spark, sf_dir, row_ids=True)
    applier = TableApplier(store, "shop", "users", source)
    applier.snapshot(_last(events.where(F.col("seq") - 1 <= half)), TableSpec(ROW, ("id",)), 1)
    wide = T.StructType([*ROW.fields, T.StructField("age", T.LongType(), True)])
    handler.handle(DdlEvent("ALTER_TABLE", "shop", "users", wide, ("id",)))
    with_age = events.withColumn("row", F.struct("row.*", (F.col("row.id") * 2).alias("age"))).withColumn("op", F.lit("UPDATE"))
    applier.stream(with_age.where(F.col("seq") - 1 > half), TableSpec(wide, ("id",)), 2)
    return store.read("shop", "users").select("id", "value", "age")


def _last(events: DataFrame) -> DataFrame:
    """The last event of each row id."""
    names = events.columns
    return events.groupBy("row_id").agg(F.max(F.struct("seq", *[c for c in names if c not in ("seq", "row_id")])).alias("x")).select("row_id", "x.*").select(*names)


def truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table, loaded from the first half of the stream, truncated, then loaded from the second half."""
    store, source, half = _store(spark), SourceProperties(row_id=True), _half(spark, sf_dir)
    handler = DdlHandler(store, source)
    handler.handle(DdlEvent("CREATE_TABLE", "shop", "users", ROW, ("id",)))
    events, applier = envelope(spark, sf_dir), TableApplier(store, "shop", "users", source)
    applier.snapshot(events.where(F.col("seq") - 1 <= half), _spec(source), 1)
    handler.handle(DdlEvent("TRUNCATE_TABLE", "shop", "users", ROW, ("id",)))
    applier.snapshot(events.where(F.col("seq") - 1 > half), _spec(source), 2)
    return store.read("shop", "users").select("id", "value", F.col(SEQUENCE_NUM).alias("seq"))


def stream_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two micro-batches through the consumer: the table's creation, a snapshot whose sequence numbers run among those of
    the streaming events beside it, and then all of it once more, together with the rest of the stream."""
    quarter = F.floor(F.col("top") / 4)
    events = envelope(spark, sf_dir, row_ids=True).crossJoin(F.broadcast(_table(spark, sf_dir, "events").agg(F.max("event_id").alias("top"))))
    events = events.withColumn("q", quarter).withColumn("e", F.col("seq") - 1)
    shot = _last(events.where(F.col("e") <= 2 * F.col("q"))).withColumn("seq", F.col("seq") + F.col("q")).withColumns({"is_snapshot": F.lit(True), "op": F.lit("INSERT")})
    rest = events.where(F.col("e") > 2 * F.col("q")).withColumn("is_snapshot", F.lit(False))
    every = shot.unionByName(rest).withColumns({"row": F.to_json("row"), "prev": F.to_json("prev"), "sort": F.lit(None).cast("string")})
    body = json.dumps({"schema": ROW.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), "primary_keys": ["id"]})
    create = spark.createDataFrame([("shop", "public", "users", "CREATE_TABLE", True, 0, 0, None, None, body, None, "0")], ENVELOPE)
    consumer = Consumer(spark, f"{scratch_dir(spark)}/stream-{uuid.uuid4().hex}", SourceProperties(row_id=True))
    names = ENVELOPE.names
    first = create.unionByName(every.where((F.col("is_snapshot")) | (F.col("e") <= 3 * F.col("q"))).select(names))
    consumer.process(first, 0)
    consumer.process(create.unionByName(every.select(names)), 1)
    return consumer.store.read("shop", "users").select("id", "value", "kind", F.col(SEQUENCE_NUM).alias("seq"))


def assess_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of all plain tables as the target would have them."""
    assessor, frames = Assessor(), []
    for name in ASSESSED:
        frame = assessor.frames(spark, "shop", "public", name, from_spark(_table(spark, sf_dir, name).schema), [])[0]
        frames.append(frame.withColumn("tbl", F.lit(name)))
    return reduce(DataFrame.unionByName, frames)


def assess_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stands against some tables: a name in two schemas, no key, names that must change."""
    assessor, out = Assessor(), []
    fields = from_spark(_table(spark, sf_dir, "nation").schema)
    for db, schema, table, keys in (("shop", "a", "nation", ["n_nationkey"]), ("shop", "b", "nation", []), ("web shop", "a", "nation?", ["n_nationkey"])):
        out.append(assessor.frames(spark, db, schema, table, fields, keys)[1].withColumn("tbl", F.lit(f"{db}.{schema}.{table}")))
    return reduce(DataFrame.unionByName, out)


def live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live_rows(full_target(spark, sf_dir)).select("id", "value")


def queries() -> dict:
    out = {f"diff_{k}": _diff_query(s) for k, s in _SOURCES.items() if not k.startswith("soft")}
    out |= {f"merge_{k}": _merge_query(s) for k, s in _SOURCES.items()}
    out |= {f"json_{k}": _json_query(k) for k in ("date", "time", "time_millis", "timestamp", "timestamp_millis", "decimal", "bytes", "array")}
    out |= {
        "normalize_dataset": _naming_query(naming.dataset_name_col),
        "normalize_table": _naming_query(naming.table_name_col),
        "normalize_field": _naming_query(naming.field_name_col),
        "normalize_field_flexible": _naming_query(lambda c: naming.field_name_col(c, True)),
    }
    return out | {f.__name__: f for f in (snapshot_append, seq_max, seq_max_union, replay_gate, op_counts, batch_counts, resolve_dataset,
                                          ascii_names, datetime_trim, json_record, add_sort, alter_add_column, truncate, stream_apply, assess_columns, assess_problems, live)}


def oracle_sql() -> dict[str, str]:
    out = {f"diff_{k}": _diff_sql(s) for k, s in _SOURCES.items() if not k.startswith("soft")}
    out |= {f"merge_{k}": _merge_sql(s) for k, s in _SOURCES.items()}
    time_format = "strftime(make_timestamp({}), '%H:%M:%S.%f')"
    stamp_format = "strftime(make_timestamp({}), '%Y-%m-%d %H:%M:%S.%f')"
    json_values = {
        "date": "strftime(DATE '1970-01-01' + CAST(event_id - 5000 AS INTEGER), '%Y-%m-%d')",
        "time": time_format.format("event_id * 8640123 % 86400000000"),
        "time_millis": time_format.format("event_id * 8640 % 86400000 * 1000"),
        "timestamp": stamp_format.format("(event_id - 5000) * 1234567890123"),
        "timestamp_millis": stamp_format.format("(event_id - 5000) * 1234567890000"),
        "decimal": "CAST(CAST(CAST(event_id AS DECIMAL(12,2)) / 4 AS DECIMAL(12,2)) AS VARCHAR)",
        "bytes": "base64(encode(event_type))",
        "array": "'[' || event_id || ',' || (event_id + 1) || ']'",
    }
    out |= {f"json_{k}": f"SELECT event_id, {v} AS json_value FROM events" for k, v in json_values.items()}
    table = r"[^\p{L}\p{M}\p{N}\p{Pc}\p{Pd}\p{Zs}]+"
    flexible = r"[^\p{L}\p{M}\p{N}\p{Pc}\p{Pd}&%+=:''<>#| ]+"
    out |= {
        "normalize_dataset": _naming_sql("[^A-Za-z0-9_]+", 1024, False),
        "normalize_table": _naming_sql(table, 1024, False),
        "normalize_field": _naming_sql("[^A-Za-z0-9_]+", 300, True),
        "normalize_field_flexible": _naming_sql(flexible, 300, True),
        "resolve_dataset": f"SELECT c_custkey, CASE c_custkey % 3 WHEN 1 THEN 'set_name' ELSE regexp_replace(name, '[^A-Za-z0-9_]+', '_', 'g') END AS dataset FROM ({_ODD_SQL})",
        "ascii_names": f"SELECT c_custkey, regexp_full_match(name, '[A-Za-z0-9_]+') AS is_ascii FROM ({_ODD_SQL})",
        "snapshot_append": f"WITH {_FULL_SQL} SELECT id, value, seq, is_deleted FROM t UNION ALL SELECT user_id, value, event_id + 1, NULL FROM events WHERE event_id % 2 = 0",
        "seq_max": "SELECT max(event_id) + 1 AS max_seq FROM events",
        "seq_max_union": "SELECT max(m) AS max_seq FROM (SELECT max(event_id) AS m FROM events UNION ALL SELECT max(o_orderkey) FROM orders UNION ALL SELECT max(c_custkey) FROM customer)",
        "replay_gate": f"SELECT event_id + 1 AS seq, {_OP} AS op, user_id AS id FROM events WHERE event_id + 1 > 1000",
        "op_counts": f"SELECT 'users' AS tbl, {_OP} AS op, count(*) AS n_events FROM events GROUP BY 2",
        "batch_counts": "SELECT 'shop' AS db, 'users' AS tbl, event_id % 2 = 0 AS is_snapshot, count(*) AS n_events FROM events GROUP BY 3",
        "datetime_trim": """SELECT event_id, CASE event_id % 3 WHEN 0 THEN '2022-4-1 4:01:2.' || substr(lpad(CAST(event_id * 7919 % 1000000000 AS VARCHAR), 9, '0'), 1, 6)
            WHEN 1 THEN '2022-04-01T14:31:12.' || lpad(CAST(event_id % 1000000 AS VARCHAR), 6, '0') ELSE '2022-04-01' END AS datetime FROM events""",
        "json_record": """SELECT event_id, '{"event_id":' || event_id || ',"kind":' || CASE WHEN event_id % 2 = 0 THEN '"' || event_type || '"' ELSE 'null' END
            || ',"nested":{"user_id":' || user_id || ',"event_type":"' || event_type || '"}}' AS json_value FROM events""",
        "add_sort": _merge_sql(_SOURCES["unordered_rowid"], add_sort=True),
        "alter_add_column": f"""WITH l AS (SELECT user_id, max(event_id) AS event_id, max(CASE WHEN event_id <= {_HALF_SQL} THEN event_id END) AS before FROM events GROUP BY user_id)
            SELECT e.user_id AS id, value, CASE WHEN e.event_id > {_HALF_SQL} THEN e.user_id * 2 END AS age FROM events e JOIN l USING (event_id)""",
        "truncate": f"SELECT user_id AS id, value, event_id + 1 AS seq FROM events WHERE event_id > {_HALF_SQL}",
        "stream_apply": f"""WITH q AS (SELECT CAST(floor(max(event_id) / 4) AS BIGINT) AS q FROM events),
            l AS (SELECT user_id, max(event_id) AS late, max(CASE WHEN event_id <= 2 * q THEN event_id END) AS early, any_value(q) AS q FROM events, q GROUP BY user_id)
            SELECT e.user_id AS id, value, event_type AS kind, event_id + 1 + CASE WHEN late > 2 * q THEN 0 ELSE q END AS seq
            FROM l JOIN events e ON e.event_id = l.late WHERE late <= 2 * q OR {_OP} <> 'DELETE'""",
        "live": f"WITH {_FULL_SQL} SELECT id, value FROM t WHERE is_deleted IS NOT TRUE",
        "assess_columns": f"""SELECT table_name AS tbl, column_name AS "column", column_name AS target_column,
            CASE regexp_replace(data_type, '\\[\\]$', '') WHEN 'BIGINT' THEN 'INT64' WHEN 'INTEGER' THEN 'INT64' WHEN 'DOUBLE' THEN 'FLOAT64' WHEN 'FLOAT' THEN 'FLOAT64'
                WHEN 'VARCHAR' THEN 'STRING' WHEN 'TIMESTAMP' THEN 'DATETIME' ELSE 'N/A' END AS "type", TRUE AS supported
            FROM information_schema.columns WHERE table_name IN ({", ".join(f"'{t}'" for t in ASSESSED)})""",
        "assess_problems": """SELECT * FROM (VALUES ('shop.b.nation', 'table name used twice', 'error', 'nation is in the schemas a and b'),
            ('shop.b.nation', 'no primary key', 'warning', 'nation needs a primary key to be replicated'), ('web shop.a.nation?', 'namespace renamed', 'warning', 'web shop becomes web_shop'),
            ('web shop.a.nation?', 'table renamed', 'warning', 'nation? becomes nation_'),
            ('web shop.a.nation?', 'staging table renamed', 'warning', '_staging_nation? becomes _staging_nation_')) AS v(tbl, problem, severity, detail)""",
    }
    return out
