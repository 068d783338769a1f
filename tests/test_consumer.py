"""The consumer: marks, failures, schema changes in order, stops; and the store at growing sizes."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.retry import PermanentError, RetryPolicy, is_permanent
from tidemark.operators.ddl import DdlEvent
from tidemark.plans.apply import TableApplier
from tidemark.plans.envelope import SourceProperties, TableSpec
from tidemark.sources.store import Conflict, Store
from tidemark.streaming.consumer import ENVELOPE, Consumer

ROW = T.StructType([T.StructField("id", T.LongType()), T.StructField("first name", T.StringType())])
EVENTS = "op string, seq long, source_ts long, row_id string, sort struct<_key_0:long>, row struct<id:long,name:string>, prev struct<id:long,name:string>"
PLAIN = TableSpec(T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())]), ("id",))
FEW = RetryPolicy(2, 5, 0.01, 0.02, 0)


def wire(op, seq, id=None, name=None, snapshot=False, tbl="t", prev=None, row=None, sort=None, ts=None):
    row = row or json.dumps({"id": id, "first name": name})
    return ("db", "s", tbl, op, snapshot, seq, ts, None, sort, row, None if prev is None else json.dumps({"id": prev, "first name": "old"}), str(seq))


def change(kind, seq, schema=None, tbl="t"):
    body = None if schema is None else json.dumps({"schema": schema.jsonValue(), "primary_keys": ["id"]})
    return ("db", "s", tbl, kind, False, seq, None, None, None, body, None, str(seq))


def consumer(spark, root, **k):
    return Consumer(spark, root, retry_policy=FEW, **k)


def send(c, rows, epoch=0):
    c.process(c.spark.createDataFrame(rows, ENVELOPE), epoch)


def rows_of(c, tbl="t", cols=("id", "first_name")):
    return sorted(tuple(r) for r in c.store.read("db", tbl).select(*cols).collect())


def test_snapshot_beside_stream_and_renamed_columns(spark, spark_root):
    c = consumer(spark, spark_root)
    first = [change("CREATE_TABLE", 0, ROW), wire("INSERT", 10, 1, "shot", True), wire("INSERT", 5, 2, "stream"), wire("UPDATE", 11, 1, "new", prev=1)]
    send(c, first)
    assert rows_of(c) == [(1, "new"), (2, "stream")] and c.latest["db", "t"] == 11
    send(c, [*first, wire("INSERT", 12, 3, "x")], 1)
    assert rows_of(c) == [(1, "new"), (2, "stream"), (3, "x")]
    again = consumer(spark, spark_root)
    assert again.specs == c.specs and again.states == c.states and again.latest["db", "t"] == 12


def test_a_crash_between_the_phases_loses_nothing(spark, spark_root, monkeypatch):
    c = consumer(spark, spark_root)
    first = [change("CREATE_TABLE", 0, ROW), wire("INSERT", 10, 1, "shot", True), wire("INSERT", 5, 2, "stream")]
    monkeypatch.setattr(TableApplier, "stream", lambda *a, **k: (_ for _ in ()).throw(PermanentError("lost")))
    with pytest.raises(PermanentError):
        send(c, first)
    with pytest.raises(PermanentError):  # a failure is kept
        send(c, [], 1)
    monkeypatch.undo()
    c = consumer(spark, spark_root)
    assert c.states["db", "t"] and rows_of(c) == [(1, "shot")]
    send(c, first)
    assert rows_of(c) == [(1, "shot"), (2, "stream")] and c.store.manifest("db", "t").high_water == 10


def test_a_finished_snapshot_is_never_dropped(spark, spark_root, monkeypatch):
    c = consumer(spark, spark_root)
    shot = [change("CREATE_TABLE", 0, ROW), *[wire("INSERT", i, i, "a", True) for i in range(1, 5)]]
    commit, failed = Store.commit, []

    def flaky(self, db, table, m):  # the commit takes place, but its answer is lost
        commit(self, db, table, m)
        if m.buckets and not failed:
            failed.append(1)
            raise OSError("connection lost")

    monkeypatch.setattr(Store, "commit", flaky)
    send(c, shot)
    assert failed and len(rows_of(c)) == 4
    m = c.store.manifest("db", "t")
    assert not m.direct_load_in_progress and sum(j.startswith("app_load") for j in m.jobs) == 1
    c.apply_ddl(DdlEvent("CREATE_TABLE", "db", "t", ROW, ("id",)))
    assert len(rows_of(c)) == 4
    c.store.set_flag("db", "t", True)  # left by an earlier failure
    send(c, shot, 1)
    assert not c.store.manifest("db", "t").direct_load_in_progress and len(rows_of(c)) == 4


@pytest.mark.parametrize("bad", ["{broken", '{"id": "text"}', "[1]"])
def test_malformed_rows_are_errors(spark, spark_root, bad):
    c = consumer(spark, spark_root)
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING") as e:
        send(c, [change("CREATE_TABLE", 0, ROW), wire("INSERT", 1, row=bad)])
    assert is_permanent(e.value) and not is_permanent(OSError("x")) and not is_permanent(Conflict("x"))
    assert c.states["db", "t"] == "error" and c.store.read("db", "t").count() == 0


def test_schema_changes_in_order(spark, spark_root):
    wide = T.StructType([*ROW.fields, T.StructField("age", T.LongType())])
    c = consumer(spark, spark_root)
    batch = [
        change("CREATE_TABLE", 0, ROW), wire("INSERT", 1, 1, "a"), wire("INSERT", 2, 2, "b"), change("TRUNCATE_TABLE", 3, ROW), wire("INSERT", 4, 3, "c"),
        change("ALTER_TABLE", 5, wide), wire("INSERT", 6, row='{"id":4,"first name":"d","age":9}'),
        change("CREATE_TABLE", 0, ROW, "u"), wire("INSERT", 1, 7, "x", tbl="u"), change("DROP_TABLE", 7, tbl="u"),
    ]
    for epoch in (0, 1):  # the second delivery changes nothing
        send(c, batch, epoch)
        assert rows_of(c, cols=("id", "first_name", "age")) == [(3, "c", None), (4, "d", 9)] and not c.store.exists("db", "u")
    send(c, [change("CREATE_TABLE", 8, ROW, "u"), wire("INSERT", 9, 8, "y", tbl="u")], 2)
    assert rows_of(c, "u") == [(8, "y")] and c.counts["t", "TRUNCATE_TABLE"] == 2
    with pytest.raises(PermanentError, match="never created"):
        send(c, [wire("INSERT", 1, 1, "x", tbl="unknown")], 3)


def test_names_that_become_one_table_are_one_slice(spark, spark_root):
    c = consumer(spark, spark_root)
    send(c, [change("CREATE_TABLE", 0, ROW, "a/b"), wire("INSERT", 1, 1, "x", tbl="a/b"), wire("INSERT", 2, 2, "y", tbl="a?b")])
    assert rows_of(c, "a_b") == [(1, "x"), (2, "y")]


def test_sort_keys_come_from_the_first_event(spark, spark_root):
    c = consumer(spark, spark_root, source=SourceProperties(ordered=False))
    key = '{"_key_0":%d,"_key_1":"%s"}'
    send(c, [change("CREATE_TABLE", 0, ROW), wire("INSERT", 1, 1, "a", True, sort=key % (5, "m"), ts=1)])
    send(c, [wire("UPDATE", 2, 1, "late", prev=1, sort=key % (5, "l"), ts=2)], 1)
    assert rows_of(c) == [(1, "a")] and c.specs["db", "t"].sort_types == (T.LongType(), T.StringType())
    send(c, [wire("UPDATE", 3, 1, "new", prev=1, sort=key % (6, "a"), ts=0)], 2)
    assert rows_of(c) == [(1, "new")] and consumer(spark, spark_root, source=c.source).specs == c.specs


def test_stop(spark, spark_root, tmp_path):
    c = consumer(spark, spark_root)
    send(c, [change("CREATE_TABLE", 0, ROW)])
    source = str(tmp_path / "in")
    spark.createDataFrame([wire("INSERT", 1, 1, "a")], ENVELOPE).write.parquet(source)
    query = c.start(spark.readStream.schema(ENVELOPE).parquet(source), str(tmp_path / "cp"), interval_seconds=1)
    query.processAllAvailable()
    assert c.stop() in (True, False) and not query.isActive and rows_of(c) == [(1, "a")]
    with pytest.raises(PermanentError, match="stopped"):
        send(c, [], 9)


@pytest.mark.parametrize("last", [T.StructField("at", T.TimestampNTZType()), T.StructField("größe", T.DoubleType())])
def test_staging_as_json_lines(spark, spark_root, last):
    schema = T.StructType([*ROW.fields, last])
    value = {"at": "2020-01-02T03:04:05.123456", "größe": 1.5}[last.name]
    c = consumer(spark, spark_root, keep_staging_files=True, flexible_names=True)
    send(c, [change("CREATE_TABLE", 0, schema), wire("INSERT", 1, row=json.dumps({"id": 1, "first name": "é\n", last.name: value}))])
    got = c.store.read("db", "t").first()
    assert got["first name"] == "é\n" and (got[last.name] == 1.5 or got[last.name].isoformat() == value)
    folder = f"{spark_root}-staging/staged/changes/app/db/t"
    (batch,) = c.store.files.names(folder)
    assert any(n.endswith(".json") or n.endswith(".txt") for n in c.store.files.names(f"{folder}/{batch}"))


def test_a_small_batch_rewrites_a_bounded_share(spark, spark_root):
    store = Store(spark, spark_root, n_buckets=2, bucket_rows=100)
    a = TableApplier(store, "db", "t", SourceProperties())
    events = spark.range(20000).select(F.lit("INSERT").alias("op"), (F.col("id") + 1).alias("seq"), F.lit(0).cast("long").alias("source_ts"), F.lit(None).cast("string").alias("row_id"),
        F.lit(None).cast("struct<_key_0:long>").alias("sort"), F.struct("id", F.lit("n").alias("name")).alias("row"), F.lit(None).cast("struct<id:long,name:string>").alias("prev"))
    a.snapshot(events, PLAIN, 1)
    before = store.manifest("db", "t")
    assert before.n_buckets == 256 and before.rows == 20000 and all(len(f) == 1 for f in before.buckets.values())
    update = [("UPDATE", 30000 + i, 0, None, None, (i * 7, "u"), (i * 7, "n")) for i in range(5)]
    a.stream(spark.createDataFrame(update, EVENTS), PLAIN, 2)
    after = store.manifest("db", "t")
    assert sum(before.buckets[b] != after.buckets[b] for b in before.buckets) <= 5
    assert store.read("db", "t").count() == 20000 and store.read("db", "t").where("name = 'u'").count() == 5


def test_buckets_grow_and_are_compacted(spark, spark_root):
    store = Store(spark, spark_root, n_buckets=2, bucket_rows=4)
    a = TableApplier(store, "db", "t", SourceProperties())
    for k in range(6):
        a.snapshot(spark.createDataFrame([("INSERT", k * 8 + i + 1, 0, None, None, (k * 8 + i, "n"), None) for i in range(8)], EVENTS), PLAIN, k)
    m = store.manifest("db", "t")
    assert m.n_buckets == 8 and sorted(r["id"] for r in store.read("db", "t").collect()) == list(range(48))
    assert store.compact("db", "t", 1) > 0 and all(len(f) == 1 for f in store.manifest("db", "t").buckets.values())
    a.stream(spark.createDataFrame([("UPDATE", 100, 0, None, None, (5, "u"), (5, "n"))], EVENTS), PLAIN, 9)
    assert store.read("db", "t").count() == 48 and store.read("db", "t").where("name = 'u'").count() == 1
    for _ in range(2):
        assert store.files.write_new(f"{spark_root}/one", "x") in (True, False)
    assert not store.files.write_new(f"{spark_root}/one", "y") and store.files.read(f"{spark_root}/one") == "x"
