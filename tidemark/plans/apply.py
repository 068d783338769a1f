"""Apply one batch of one table: gate, stage, diff, merge, commit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.naming import job_id
from tidemark.operators.diff import batch_filter, diff
from tidemark.operators.merge import merge
from tidemark.operators.sequence import replay_gate
from tidemark.plans.envelope import (
    BEFORE_PREFIX,
    IS_DELETED,
    ROW_ID,
    SEQUENCE_NUM,
    SORT,
    SourceProperties,
    TableSpec,
    snapshot_rows,
    stage,
    staging_schema,
    target_schema,
)
from tidemark.sources.staging import read_staging, staging_format, write_staging
from tidemark.sources.store import Store


def apply_events(target: DataFrame, events: DataFrame, spec: TableSpec, source: SourceProperties,
                 batch_id: int = 1, latest_applied: int = 0) -> DataFrame:
    """Pure plan: the target after one batch of envelope events."""
    staged = batch_filter(stage(replay_gate(events, latest_applied), spec, source, batch_id), batch_id, latest_applied)
    n = 0 if source.ordered else len(spec.sort_types)
    survivors = diff(staged, list(spec.primary_keys), source, n)
    names = target_schema(spec, source, metadata_first=False).names
    return merge(target, survivors, list(spec.primary_keys), names, source, n)


def append_snapshot(target: DataFrame, events: DataFrame, spec: TableSpec, source: SourceProperties) -> DataFrame:
    """Pure plan: bag union of snapshot events into the target."""
    return target.unionByName(snapshot_rows(events, spec, source), allowMissingColumns=True)


class TableApplier:
    """Applies batches of one table to a store.

    A batch that is delivered again changes nothing: the marks, committed together with the data, gate its events.
    ``mark`` is the table's high-water mark when the micro-batch began: it gates snapshot and streaming events alike, so
    that neither hides the other's.  The snapshot's own mark is promoted with the streaming phase (``promote``: there is
    none).  A further attempt first looks for a commit of an earlier one, newest first, and adopts it.
    """

    def __init__(self, store: Store, db: str, table: str, source: SourceProperties, staging_path: str | None = None,
                 retain_staging: bool = False, app: str = "app"):
        self.store, self.db, self.table, self.source = store, db, table, source
        self.staging_path, self.retain_staging, self.app = staging_path, retain_staging, app

    def _ready(self, spec: TableSpec):
        m = self.store.manifest(self.db, self.table)
        if m is None:
            keys = [ROW_ID] if self.source.row_id else list(spec.primary_keys)
            m = self.store.create_table(self.db, self.table, target_schema(spec, self.source), list(spec.primary_keys), bucket_keys=keys)
        return m

    def job(self, kind: str, batch_id: int, attempt: int) -> str:
        return job_id(self.app, kind, self.db, self.table, batch_id, attempt)

    def _adopted(self, m, kind: str, batch_id: int, attempt: int) -> bool:
        return any(self.job(kind, batch_id, a) in m.jobs for a in range(attempt - 1, -1, -1))

    def snapshot(self, events: DataFrame, spec: TableSpec, batch_id: int, mark: int | None = None, promote: bool = True, attempt: int = 0) -> int:
        """Append a snapshot batch.  The flag tells a load that was begun and abandoned; data, mark and the cleared flag
        are one commit, and a flag that an earlier failure left is cleared where nothing is left to load."""
        m = self._ready(spec)
        rows = snapshot_rows(replay_gate(events, max(m.high_water if mark is None else mark, m.snapshot_water)), spec, self.source)
        n, top = rows.agg(F.count(F.lit(1)), F.max(SEQUENCE_NUM)).first()
        if not n or self._adopted(m, "load", batch_id, attempt):
            self.store.mark(self.db, self.table, direct_load_in_progress=False, **({"high_water": m.snapshot_water} if promote else {}))
            return max(m.high_water, m.snapshot_water)
        self.store.set_flag(self.db, self.table, True)
        marks = {"snapshot_water": top, "direct_load_in_progress": False} | ({"high_water": top} if promote else {})
        self.store.append(self.db, self.table, rows, n, self.job("load", batch_id, attempt), **marks)
        self.store.compact(self.db, self.table)
        return top

    def stream(self, events: DataFrame, spec: TableSpec, batch_id: int, mark: int | None = None, attempt: int = 0) -> int:
        """Merge a streaming batch, touching only the buckets its events can match, and promote the marks."""
        m = self._ready(spec)
        if self._adopted(m, "merge", batch_id, attempt):
            return m.high_water
        mark = m.high_water if mark is None else mark
        staged = stage(replay_gate(events, mark), spec, self.source, batch_id)
        if self.staging_path:
            file_format = staging_format(staged.schema)
            write_staging(staged, self.staging_path, file_format)
            staged = read_staging(self.store.spark, self.staging_path, staging_schema(spec, self.source), file_format)
        staged = batch_filter(staged, batch_id, mark).persist()
        try:
            count, top = staged.agg(F.count(F.lit(1)), F.max(SEQUENCE_NUM)).first()
            if not count:
                self.store.mark(self.db, self.table, high_water=m.snapshot_water)
                return max(m.high_water, m.snapshot_water)
            n = 0 if self.source.ordered else len(spec.sort_types)
            survivors = diff(staged, list(spec.primary_keys), self.source, n)
            own = [ROW_ID] if self.source.row_id else list(spec.primary_keys)
            theirs = [ROW_ID] if self.source.row_id else [f"{BEFORE_PREFIX}{k}" for k in spec.primary_keys]
            m = self._widen(m, spec)
            buckets = self.store.touched(m, survivors, theirs) if own == m.bucket_keys else set(range(m.n_buckets))
            target = self.store.read(self.db, self.table, buckets, m)
            names = target_schema(spec, self.source, metadata_first=False).names
            rows = merge(target, survivors, list(spec.primary_keys), names, self.source, n)
            top = max(top, m.snapshot_water)
            self.store.rewrite(self.db, self.table, m, buckets, rows, count, self.job("merge", batch_id, attempt), high_water=top)
        finally:
            staged.unpersist()
            if self.staging_path and not self.retain_staging:
                self.store.files.delete(self.staging_path)
        self.store.compact(self.db, self.table)
        return top

    def _widen(self, m, spec: TableSpec):
        """Add the columns that the batch has and the table lacks, such as the sort column on its first use."""
        from pyspark.sql import types as T

        have = {f.name: f for f in m.struct.fields}
        extra = [f for f in target_schema(spec, self.source).fields if f.name not in have]
        if extra:
            m.schema = T.StructType([*m.struct.fields, *[T.StructField(f.name, f.dataType, True) for f in extra]]).jsonValue()
        if SORT in [f.name for f in extra]:
            m.sort_types = [t.simpleString() for t in spec.sort_types]
        return m


def live_rows(target: DataFrame) -> DataFrame:
    """Rows that are not tombstones."""
    return target.where(~F.coalesce(F.col(IS_DELETED), F.lit(False)))
