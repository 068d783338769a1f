"""Structured Streaming front end: an envelope stream in, up-to-date tables out.

The envelope carries ``row``, ``prev`` and ``sort`` as JSON text, since the tables of one stream differ in schema; each
table's slice is parsed strictly with its schema at the source, then bound to the target's names.  A micro-batch is split
by (database, table, is_snapshot); snapshot slices are appended first, then streaming slices are merged, tables in
parallel; one mark a table, read before both, gates both, and it moves after both.  There is no watermark: lateness is
unbounded, older late events lose to the rows they find.

Schema changes may come in the stream too: ``op`` is then their kind and ``row`` holds ``{"schema": ..., "primary_keys":
[...]}`` (the schema as Spark's JSON or as DDL text).  They take effect in the order of ``seq``: what comes before a change
that drops, alters or truncates is applied before it.
"""

from __future__ import annotations

import json
import threading
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.naming import normalize_table_name, resolve_dataset_name, retry_delay_seconds, state_key, table_key
from tidemark.functions.retry import COMMIT_POLICY, PermanentError, RetryPolicy, retry
from tidemark.operators.ddl import FLUSHING, KINDS, DdlEvent, DdlHandler
from tidemark.operators.sequence import operation_counts
from tidemark.plans.apply import TableApplier
from tidemark.plans.envelope import SORT_KEY, SourceProperties, TableSpec, sort_type
from tidemark.sources.staging import staging_path
from tidemark.sources.store import Store

DEFAULT_INTERVAL_SECONDS = 90  # Fixed value: default flush interval.
STOP_SECONDS = 10  # Fixed value: how long a stop waits for what is running.
ENVELOPE = T.StructType([
    T.StructField("db", T.StringType()), T.StructField("schema", T.StringType()), T.StructField("tbl", T.StringType()),
    T.StructField("op", T.StringType()), T.StructField("is_snapshot", T.BooleanType()), T.StructField("seq", T.LongType()),
    T.StructField("source_ts", T.LongType()), T.StructField("row_id", T.StringType()), T.StructField("sort", T.StringType()),
    T.StructField("row", T.StringType()), T.StructField("prev", T.StringType()), T.StructField("offset", T.StringType()),
])
SNAPSHOTTING, REPLICATING, ERROR = "snapshotting", "replicating", "error"
#: JSON values of the first event's sort keys, with the types that they stand for.
SORT_KEY_TYPES = {bool: T.BooleanType(), int: T.LongType(), float: T.DoubleType(), str: T.StringType()}
MAX_SEGMENTS = 1000

Key = tuple[str, str]


class Stopped(PermanentError):
    """The consumer was stopped."""


@dataclass
class Consumer:
    """Keeps per-table specs and states; ``process`` is the body of ``foreachBatch``."""

    spark: SparkSession
    root: str
    source: SourceProperties = field(default_factory=SourceProperties)
    app: str = "app"
    dataset: str | None = None
    parallelism: int = 8
    keep_staging_files: bool = False
    require_manual_drops: bool = False
    flexible_names: bool = False
    load_interval: int = DEFAULT_INTERVAL_SECONDS
    retry_policy: RetryPolicy | None = None
    store: Store | None = None

    def __post_init__(self):
        self.retry_policy = self.retry_policy or RetryPolicy(max_delay=retry_delay_seconds(self.load_interval))
        self.store = self.store or Store(self.spark, self.root)
        self.specs: dict[Key, TableSpec] = {}
        self.states: dict[Key, str] = {}
        self.counts: dict[Key, int] = {}
        self.latest: dict[Key, int] = {}
        self.changed_at: dict[Key, int] = {}  # sequence number of each table's last schema change of the stream
        self.failure: BaseException | None = None
        self.ddl = DdlHandler(self.store, self.source, self.dataset, self.require_manual_drops, self.flexible_names)
        self._stop, self._queries, self._state_version = threading.Event(), [], 0
        self._state_folder = f"{self.root.rstrip('/')}-state/{self.app}"
        self._saved = None
        self._restore()

    # --- state that outlives the process: schemas, keys, sort types and states, a new file each time ---

    def _restore(self) -> None:
        files = [n for n in self.store.files.names(self._state_folder) if n.endswith(".json") and n[0] != "."]
        if not files:
            return
        self._state_version = int(max(files)[:-5])
        self._saved = self.store.files.read(f"{self._state_folder}/{max(files)}")
        for x in json.loads(self._saved).values():
            key = x["db"], x["table"]
            if x["schema"] is not None:
                sort = T.StructType.fromJson(x["sort"])
                self.specs[key] = TableSpec(T.StructType.fromJson(x["schema"]), tuple(x["keys"]), tuple(f.dataType for f in sort.fields), tuple(x["names"]))
                m = self.store.manifest(*key)
                self.latest[key] = m.high_water if m else 0
            if x["state"] is not None:
                self.states[key] = x["state"]
            if x["changed_at"] is not None:
                self.changed_at[key] = x["changed_at"]

    def _save(self) -> None:
        out = {}
        for d, t in sorted({*self.specs, *self.states, *self.changed_at}, key=str):
            s = self.specs.get((d, t))
            out[state_key(d, t)] = {
                "db": d, "table": t, "state": self.states.get((d, t)), "changed_at": self.changed_at.get((d, t)), "schema": s and s.schema.jsonValue(),
                "keys": list(s.primary_keys) if s else [], "sort": sort_type(s.sort_types).jsonValue() if s else None, "names": list(s.source_names) if s else [],
            }
        text = json.dumps(out)
        if text == self._saved:
            return

        def write() -> None:
            self._state_version += 1
            if not self.store.files.write_new(f"{self._state_folder}/{self._state_version:012d}.json", text):
                raise RuntimeError(f"state {self._state_version} of {self.app} was written by another process")

        retry(write, COMMIT_POLICY, self._stop.is_set, self._stop.wait)
        self._saved = text
        self.store.files.delete(f"{self._state_folder}/{self._state_version - 2:012d}.json")

    # --- schema changes ---

    def _ready(self) -> None:
        if self.failure is not None:
            raise self.failure
        if self._stop.is_set():
            raise Stopped("the consumer was stopped")

    def apply_ddl(self, event: DdlEvent, sort_types=(), seq: int | None = None) -> None:
        self._ready()
        retry(lambda: self.ddl.handle(event), self.retry_policy, self._stop.is_set, self._stop.wait)
        db, table = self.ddl.names(event)
        if event.kind in ("CREATE_TABLE", "ALTER_TABLE"):
            old = self.specs.get((db, table))
            spec = self.ddl.spec(event)
            self.specs[db, table] = TableSpec(spec.schema, spec.primary_keys, tuple(sort_types) or (old.sort_types if old else ()), spec.source_names)
        if event.kind == "DROP_TABLE":
            self.specs.pop((db, table), None)
            self.states.pop((db, table), None)
            self.latest.pop((db, table), None)
        elif table is not None:
            self.states[db, table] = SNAPSHOTTING if event.is_snapshot else REPLICATING
        if seq is not None:
            self.changed_at[db, table or ""] = seq
        self._save()

    def _change(self, r: Row) -> DdlEvent:
        body = json.loads(r["row"]) if r["row"] else {}
        schema = body.get("schema")
        if schema is not None:
            schema = T.StructType.fromJson(schema) if isinstance(schema, dict) else T.StructType.fromDDL(schema)
        return DdlEvent(r["op"].upper(), r["db"], r["tbl"], schema, tuple(body.get("primary_keys", ())), bool(r["is_snapshot"]))

    # --- data ---

    def _parsed(self, slice_: DataFrame, spec: TableSpec) -> DataFrame:
        """JSON text to structs, read with the source's names and bound to the target's; malformed text is an error."""
        target = T.StructType([T.StructField(f.name, f.dataType, True) for f in spec.schema.fields])
        source = T.StructType([T.StructField(n, f.dataType, True) for n, f in zip(spec.source_names or target.names, target.fields, strict=True)])
        strict = {"mode": "FAILFAST"}
        out = slice_
        for c in ("row", "prev"):
            out = out.withColumn(c, F.from_json(c, source, strict).cast(target))
        if spec.sort_types:
            return out.withColumn("sort", F.from_json("sort", sort_type(spec.sort_types), strict))
        return out

    def _capture_sort(self, key: Key, events: DataFrame) -> None:
        """The types of a table's sort keys, from its first event that has them."""
        first = events.where(F.col("sort").isNotNull()).orderBy("seq").select("sort").first()
        if first is not None:
            found = json.loads(first["sort"])
            values = [found[k] for k in sorted(found, key=lambda k: int(k.removeprefix(SORT_KEY)))]
            old = self.specs[key]
            self.specs[key] = TableSpec(old.schema, old.primary_keys, tuple(SORT_KEY_TYPES.get(type(v), T.StringType()) for v in values), old.source_names)

    def process(self, batch: DataFrame, epoch: int) -> None:
        """Apply a micro-batch; the first failure is kept and raised, now and on later calls."""
        self._ready()
        batch = batch.persist()
        try:
            for r in operation_counts(batch).collect():
                self.counts[r["tbl"], r["op"]] = self.counts.get((r["tbl"], r["op"]), 0) + r["n_events"]
            change = F.coalesce(F.upper("op").isin(*KINDS), F.lit(False))
            changes = batch.where(change).orderBy("seq").collect()  # as many as there are schema changes
            data, begin, segment = batch.where(~change), None, 0
            for r in changes:
                event = self._change(r)
                db, table = self.ddl.names(event)
                if r["seq"] <= self.changed_at.get((db, table or ""), -1):
                    continue  # applied before this micro-batch was delivered again
                if event.kind in FLUSHING:
                    before = data.where(F.col("seq") < r["seq"])
                    self._flush(before if begin is None else before.where(F.col("seq") > begin), epoch * MAX_SEGMENTS + segment)
                    begin, segment = r["seq"], segment + 1
                self.apply_ddl(event, seq=r["seq"])
            self._flush(data if begin is None else data.where(F.col("seq") > begin), epoch * MAX_SEGMENTS + segment)
            self._save()
        except Exception as e:
            self.failure = self.failure or e
            raise
        finally:
            batch.unpersist()

    def _flush(self, data: DataFrame, batch: int) -> None:
        """Snapshot slices, then streaming slices.  Source names that become one table are one slice."""
        snapshot = F.coalesce("is_snapshot", F.lit(False))
        routes = data.groupBy("db", "tbl", snapshot.alias("snapshot")).agg(F.max("seq").alias("top")).collect()  # as many rows as tables
        slices: dict[tuple[Key, bool], list[Row]] = {}
        for r in routes:
            key = resolve_dataset_name(self.dataset, r["db"]), normalize_table_name(r["tbl"])
            if r["top"] is None:
                raise PermanentError(f"events of {table_key(*key)} have no sequence number")
            if r["top"] > self.changed_at.get(key, -1) or key in self.specs:
                slices.setdefault((key, r["snapshot"]), []).append(r)
        marks = {key: max(m.high_water if (m := self.store.manifest(*key)) else 0, 0) for key, _ in slices}
        for phase in (True, False):
            todo = [key for key, s in slices if s == phase]
            with ThreadPoolExecutor(max(1, min(self.parallelism, len(todo)))) as pool:
                futures = []
                for key in todo:
                    names = [F.col("db").eqNullSafe(r["db"]) & F.col("tbl").eqNullSafe(r["tbl"]) for r in slices[key, phase]]
                    mine = data.where((snapshot == phase) & reduce(lambda a, b: a | b, names))
                    futures.append(pool.submit(self._slice, mine, key, phase, batch * 2 + (not phase), marks[key], (key, False) not in slices))
            errors = [e for f in futures if (e := f.exception()) is not None]
            if errors:
                for other in errors[1:]:
                    errors[0].add_note(f"also failed: {other}")
                self.failure = errors[0]
                raise errors[0]

    def _slice(self, events: DataFrame, key: Key, snapshot: bool, batch_id: int, mark: int, promote: bool) -> None:
        if key not in self.specs:
            raise PermanentError(f"table {table_key(*key)} was never created")
        events = events.where(F.col("seq") > self.changed_at.get(key, -1))
        if not self.source.ordered and not self.specs[key].sort_types:
            self._capture_sort(key, events)
        spec = self.specs[key]
        parsed = self._parsed(events, spec)
        path = staging_path(f"{self.root}-staging", self.app, *key, batch_id, snapshot) if self.keep_staging_files else None
        applier = TableApplier(self.store, *key, self.source, path, retain_staging=self.keep_staging_files, app=self.app)
        attempts = iter(range(10**9))

        def attempt() -> int:
            if snapshot:
                return applier.snapshot(parsed, spec, batch_id, mark, promote, next(attempts))
            return applier.stream(parsed, spec, batch_id, mark, next(attempts))

        try:
            self.latest[key] = retry(attempt, self.retry_policy, self._stop.is_set, self._stop.wait)
        except BaseException:
            self.states[key] = ERROR
            raise
        self.states[key] = SNAPSHOTTING if snapshot else REPLICATING

    # --- running ---

    def start(self, stream: DataFrame, checkpoint: str, interval_seconds: int | None = None, available_now: bool = False):
        self._ready()
        seconds = interval_seconds or self.load_interval
        trigger = {"availableNow": True} if available_now else {"processingTime": f"{seconds} seconds"}
        query = stream.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint).trigger(**trigger).start()
        self._queries.append(query)
        return query

    def stop(self, seconds: float = STOP_SECONDS) -> bool:
        """Stop: no retry goes on and no further batch begins; what is running gets some seconds to end, then its query is
        cancelled.  Whether all ended by themselves.  What was not committed comes again with the next start."""
        self._stop.set()
        ended = [q.awaitTermination(seconds) if q.isActive and q.status["isTriggerActive"] else True for q in self._queries]
        for q in self._queries:
            q.stop()
        return all(ended)
