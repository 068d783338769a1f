"""Diff, merge, store, schema changes and streaming, on the worked scenarios and against a plain interpreter."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.ddl import DdlEvent, DdlHandler, ManualDropRequired
from tidemark.operators.diff import batch_filter, diff
from tidemark.operators.merge import merge_columns
from tidemark.operators.sequence import max_existing_sequence, max_sequence
from tidemark.plans.apply import TableApplier, apply_events
from tidemark.plans.envelope import SourceProperties, TableSpec, stage, target_schema
from tidemark.sources.store import Conflict, Store
from tidemark.streaming.consumer import ENVELOPE, Consumer
from tidemark.target import Target, TargetConfig

ROW = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
SORT = (T.LongType(), T.LongType(), T.StringType())
EVENTS = "op string, seq long, source_ts long, row_id string, sort struct<_key_0:long,_key_1:long,_key_2:string>, row struct<id:long,name:string>, prev struct<id:long,name:string>"
PK, RID = SourceProperties(), SourceProperties(row_id=True)
UN, UNRID = SourceProperties(ordered=False), SourceProperties(row_id=True, ordered=False)


def ev(op, seq, id, name="n", prev=None, ts=0, row_id=None, sort=None):
    return (op, seq, ts, row_id, sort, (id, name), None if prev is None else (prev, "old"))


def frame(spark, events):
    return spark.createDataFrame(events, EVENTS)


def spec(source):
    return TableSpec(ROW, ("id",), () if source.ordered else SORT)


def empty(spark, source):
    return spark.createDataFrame([], target_schema(spec(source), source))


def run(spark, source, batches):
    t = empty(spark, source)
    for i, b in enumerate(batches):
        t = apply_events(t, frame(spark, b), spec(source), source, i)
        t = spark.createDataFrame(t.collect(), t.schema)
    return sorted((r["id"], r["name"], r["_is_deleted"]) for r in t.collect())


def survivors(spark, source, events):
    s = stage(frame(spark, events), spec(source), source, 1)
    return sorted(r["_sequence_num"] for r in diff(batch_filter(s, 1, 0), ["id"], source, len(spec(source).sort_types)).collect())


def test_diff_documented_chain(spark):
    chain = [ev("INSERT", 2, 0), ev("UPDATE", 3, 1, prev=0), ev("UPDATE", 4, 2, prev=1), ev("DELETE", 5, 2), ev("INSERT", 6, 0), ev("INSERT", 7, 1), ev("UPDATE", 8, 1, prev=1)]
    assert survivors(spark, PK, chain) == [5, 6, 8]


def test_diff_row_ids(spark):
    seqs = [("ABCD", s) for s in (20, 40, 50, 60, 30, 20)] + [("ABCE", 70), ("ABCE", 80)]
    events = [ev("UPDATE", s, 1, row_id=r, ts=s, sort=(s, 0, "")) for r, s in seqs]
    assert survivors(spark, RID, events) == survivors(spark, UNRID, events) == [60, 80]
    ties = [ev("UPDATE", 5, 1, row_id="a"), ev("UPDATE", 5, 2, row_id="a"), ev("UPDATE", 1, 3)]
    assert survivors(spark, RID, ties) == [1, 5, 5]


def naive_later(l, r):
    if l["sort"] is not None and r["sort"] is not None and l["sort"][0] is not None and r["sort"][0] is not None:
        for x, y in zip(l["sort"], r["sort"], strict=True):
            if x is None or y is None:
                return False
            if x != y:
                return x < y
        return False
    return (l["ts"], l["seq"]) < (r["ts"], r["seq"])


@pytest.mark.parametrize("source", [PK, RID, UN, UNRID])
def test_diff_random(spark, source):
    rng = random.Random(7)
    events = []
    for i in range(400):
        sort = None if rng.random() < 0.1 else (rng.choice([None, 1, 2]), rng.choice([None, 1, 2, 3]), rng.choice("ab"))
        op = rng.choice(["INSERT", "UPDATE", "DELETE"])
        events.append(ev(op, i + 1, rng.randrange(12), prev=rng.randrange(12) if op == "UPDATE" else None, ts=rng.randrange(20), row_id=rng.choice([None, *"abcdefgh"]), sort=sort))
    plain = [{"seq": e[1], "ts": e[2], "rid": e[3], "sort": e[4], "id": e[5][0], "before": {"INSERT": None, "UPDATE": e[6] and e[6][0], "DELETE": e[5][0]}[e[0]]} for e in events]

    def same(a, b):
        return a["rid"] is not None and a["rid"] == b["rid"] if source.row_id else b["before"] is not None and a["id"] == b["before"]

    after = (lambda a, b: a["seq"] < b["seq"]) if source.ordered else naive_later
    want = [a["seq"] for a in plain if not any(same(a, b) and after(a, b) for b in plain)]
    assert survivors(spark, source, events) == want


def test_ordered_scenarios(spark):
    first = [ev("INSERT", 1, 0, "alice"), ev("INSERT", 2, 1, "bob")]
    second = [ev("UPDATE", 3, 2, "alice", prev=0), ev("DELETE", 4, 1, "bob")]
    assert run(spark, PK, [first, second]) == [(2, "alice", None)]
    assert run(spark, SourceProperties(soft_deletes=True), [first, second]) == [(1, "bob", True), (2, "alice", None)]


def test_soft_deleted_rows_stay_deleted_when_ordered(spark):
    source = SourceProperties(row_id=True, soft_deletes=True)
    batches = [[ev("INSERT", 1, 1, row_id="r")], [ev("DELETE", 2, 1, row_id="r")], [ev("INSERT", 3, 1, "new", row_id="r")]]
    assert run(spark, source, batches) == [(1, "n", True)]
    batches = [[(*b[0][:4], (b[0][1], 0, ""), *b[0][5:])] for b in batches]
    assert run(spark, UNRID, batches) == [(1, "new", None)]


def test_unordered_scenarios(spark):
    def u(op, seq, id, name, sort, **k):
        return ev(op, seq, id, name, prev=id if op == "UPDATE" else None, sort=sort, **k)

    batches = [[u("INSERT", 1, 0, "a", (1000, 100, "d1")), u("INSERT", 2, 1, "b", (1000, 100, "d1"))],
               [u("UPDATE", 3, 0, "late", (1000, 90, "d1"))], [u("DELETE", 4, 1, "gone", (1000, 110, "d2"))], [u("UPDATE", 5, 1, "late", (1000, 110, "d1"))]]
    assert run(spark, UN, batches) == [(0, "a", None), (1, "gone", True)]
    one = [u("UPDATE", 1, 0, "x", (1, 0, "")), u("DELETE", 2, 1, "y", (9, 0, "")), u("UPDATE", 3, 1, "z", (5, 0, "")), u("INSERT", 4, 2, "w", (1, 0, ""))]
    assert run(spark, UN, [one]) == [(0, "x", None), (1, "y", True), (2, "w", None)]


def test_known_quirks(spark):
    # A chain of key changes whose start is in an earlier batch leaves the old row.
    assert run(spark, PK, [[ev("INSERT", 1, 0)], [ev("UPDATE", 2, 1, prev=0), ev("UPDATE", 3, 2, "end", prev=1)]]) == [(0, "n", None), (2, "end", None)]
    # Inserting an existing key again adds a row without row ids.
    assert run(spark, PK, [[ev("INSERT", 1, 0)], [ev("INSERT", 2, 0, "again")]]) == [(0, "again", None), (0, "n", None)]
    # Two events for one row are an error.
    with pytest.raises(Exception, match="more than once"):
        run(spark, PK, [[ev("INSERT", 1, 5)], [ev("UPDATE", 2, 6, prev=5), ev("INSERT", 3, 5), ev("UPDATE", 4, 7, prev=5)]])
    with pytest.raises(Exception, match="previous row"):
        run(spark, PK, [[ev("UPDATE", 1, 5)]])
    assert merge_columns(["id", "my_sort_order", "_row_id", "_is_deleted", "_source_timestamp"], PK) == ["id"]
    assert run(spark, PK, [[]]) == []


def test_store_versions_buckets_and_replay(spark, spark_root):
    store = Store(spark, spark_root, n_buckets=4)
    a = TableApplier(store, "db", "t", PK)
    a.snapshot(frame(spark, [ev("INSERT", i + 1, i) for i in range(20)]), spec(PK), 1)
    before = store.manifest("db", "t")
    a.stream(frame(spark, [ev("UPDATE", 21, 3, "new", prev=3), ev("DELETE", 22, 4)]), spec(PK), 2)
    after = store.manifest("db", "t")
    assert after.high_water == 22 and after.version > before.version
    assert sum(before.buckets[b] == after.buckets.get(b) for b in before.buckets) >= 2  # untouched buckets keep their files
    a.stream(frame(spark, [ev("UPDATE", 21, 3, "again", prev=3)]), spec(PK), 3)
    a.snapshot(frame(spark, [ev("INSERT", 5, 4)]), spec(PK), 4)
    rows = {r["id"]: r["name"] for r in store.read("db", "t").collect()}
    assert len(rows) == 19 and rows[3] == "new" and 4 not in rows
    a.stream(frame(spark, [ev("UPDATE", 30, 100, "moved", prev=5)]), spec(PK), 5)
    assert sorted(r["id"] for r in store.read("db", "t").collect())[-1] == 100 and store.read("db", "t").count() == 19
    assert store.vacuum("db", "t") > 0 and store.read("db", "t").count() == 19
    with pytest.raises(Conflict):
        store.commit("db", "t", store.manifest("db", "t"))
    assert max_sequence(store.read("db", "t")) == 30 and max_sequence(None) == 0


def test_max_sequence_in_batches(spark):
    tables = {f"t{i}": spark.createDataFrame([(0,), (i,)], "_sequence_num long") for i in range(1, 11)}
    for n, want in ((0, 0), (3, 3), (6, 6), (10, 10)):
        assert max_existing_sequence({f"t{i}" for i in range(1, n + 1)} | {"missing"}, tables, 4) == want


def test_ddl(spark, spark_root):
    store = Store(spark, spark_root)
    flushed = []
    h = DdlHandler(store, flush=lambda: flushed.append(1))
    dashed = T.StructType([T.StructField("field-with-dash", T.LongType(), False)])
    h.handle(DdlEvent("CREATE_DATABASE", "my db"))
    assert store.databases() == ["my_db"]
    h.handle(DdlEvent("CREATE_TABLE", "my db", "t?", dashed, ("field-with-dash",)))
    m = store.manifest("my_db", "t_")
    assert m.primary_keys == ["field_with_dash"] and m.clustering == ["field_with_dash"] and m.struct.names[0] == "_sequence_num"
    wider = T.StructType([*dashed.fields, T.StructField("1970-01-01", T.StringType(), True)])
    h.handle(DdlEvent("ALTER_TABLE", "my db", "t?", wider, ("field-with-dash",)))
    assert "_1970_01_01" in store.manifest("my_db", "t_").struct.names
    with pytest.raises(ValueError):
        h.handle(DdlEvent("ALTER_TABLE", "my db", "t?", dashed, ("field-with-dash",)))
    with pytest.raises(ValueError):
        h.handle(DdlEvent("CREATE_TABLE", "my db", "u", dashed))
    h.handle(DdlEvent("RENAME_TABLE", "my db", "t?"))
    h.handle(DdlEvent("TRUNCATE_TABLE", "my db", "t?", wider, ("field-with-dash",)))
    assert store.read("my_db", "t_").count() == 0
    h.require_manual_drops = True
    h.handle(DdlEvent("DROP_TABLE", "my db", "missing"))
    with pytest.raises(ManualDropRequired):
        h.handle(DdlEvent("DROP_TABLE", "my db", "t?"))
    with pytest.raises(ManualDropRequired):
        h.handle(DdlEvent("DROP_DATABASE", "my db"))
    h.require_manual_drops = False
    store.set_flag("my_db", "t_", True)
    h.handle(DdlEvent("CREATE_TABLE", "my db", "t?", dashed, ("field-with-dash",)))  # an abandoned snapshot is dropped
    assert not store.manifest("my_db", "t_").direct_load_in_progress and store.manifest("my_db", "t_").version == 1
    h.handle(DdlEvent("DROP_TABLE", "my db", "t?"))
    h.handle(DdlEvent("DROP_DATABASE", "my db"))
    assert store.databases() == [] and len(flushed) >= 3


def wire(op, seq, id, name, snapshot=False, tbl="users", prev=None):
    row = json.dumps({"id": id, "name": name})
    return ("db", "public", tbl, op, snapshot, seq, seq, None, None, row, None if prev is None else json.dumps({"id": prev, "name": "old"}), str(seq))


def test_stream_in_micro_batches(spark, spark_root, tmp_path):
    target = Target(spark, TargetConfig(spark_root))
    c = target.consumer()
    for t in ("users", "other"):
        c.apply_ddl(DdlEvent("CREATE_TABLE", "db", t, ROW, ("id",)))
    source = str(tmp_path / "in")
    files = [
        [wire("INSERT", 1, 0, "alice", True), wire("INSERT", 2, 1, "bob", True), wire("INSERT", 3, 7, "x", tbl="other")],
        [wire("UPDATE", 4, 2, "alice", prev=0), wire("DELETE", 5, 1, "bob")],
        [wire("UPDATE", 4, 2, "replayed", prev=0), wire("INSERT", 6, 9, "eve")],
    ]
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, ENVELOPE).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", 1).parquet(source)
        c.start(stream, str(tmp_path / "cp"), available_now=True).awaitTermination()
    rows = sorted((r["id"], r["name"]) for r in c.store.read("db", "users").collect())
    assert rows == [(2, "alice"), (9, "eve")] and c.store.read("db", "other").count() == 1
    assert target.initialize([("db", "users"), ("db", "other"), ("db", "none")]) == 6
    assert c.states["db", "users"] == "replicating" and c.counts["users", "UPDATE"] == 2
    again = Target(spark, TargetConfig(spark_root)).consumer()
    assert again.specs == c.specs
    with pytest.raises(Exception, match="never created"):
        again.retry_policy = again.retry_policy.__class__(1)
        again.process(spark.createDataFrame([wire("INSERT", 1, 1, "x", tbl="unknown")], ENVELOPE), 0)
    with pytest.raises(Exception, match="never created"):  # a failure is kept
        again.process(spark.createDataFrame([wire("INSERT", 9, 1, "x")], ENVELOPE), 1)


def test_registered_queries_match_their_sql(spark):
    import duckdb

    from tidemark.queries import oracle_sql, queries

    con, sf = duckdb.connect(), "/root/testdata/sf0.001"
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for name, sql in oracle_sql().items():
        df = queries()[name](spark, sf)
        cur = con.execute(sql)
        cols = [d[0] for d in cur.description]
        assert sorted(cols) == sorted(df.columns), name
        want = sorted(repr([r[cols.index(c)] for c in sorted(cols)]) for r in cur.fetchall())
        assert sorted(repr([r[c] for c in sorted(cols)]) for r in df.collect()) == want, name
