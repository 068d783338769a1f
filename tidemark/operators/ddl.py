"""Schema-change events on a store."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import types as T

from tidemark.functions.naming import field_mapping, normalize_dataset_name, normalize_table_name, resolve_dataset_name
from tidemark.functions.types import clustering_keys, from_spark
from tidemark.plans.envelope import ROW_ID, SourceProperties, TableSpec, target_schema
from tidemark.sources.staging import staging_table
from tidemark.sources.store import Store

log = logging.getLogger(__name__)

# The kinds of schema-change events.
KINDS = ("CREATE_DATABASE", "DROP_DATABASE", "CREATE_TABLE", "DROP_TABLE", "ALTER_TABLE", "RENAME_TABLE", "TRUNCATE_TABLE")
#: Those that change what earlier events have made: all events before them are applied first.
FLUSHING = ("DROP_TABLE", "ALTER_TABLE", "TRUNCATE_TABLE")
MAX_CLUSTERING = 4


class ManualDropRequired(RuntimeError):
    """Drops are left to an operator, and the object still exists."""


@dataclass(frozen=True)
class DdlEvent:
    kind: str
    database: str
    table: str | None = None
    schema: T.StructType | None = None
    primary_keys: tuple[str, ...] = ()
    is_snapshot: bool = False


@dataclass
class DdlHandler:
    """Normalises names, flushes before destructive changes, and keeps the primary keys it has been told."""

    store: Store
    source: SourceProperties = field(default_factory=SourceProperties)
    dataset: str | None = None
    require_manual_drops: bool = False
    flexible_names: bool = False
    max_clustering: int = MAX_CLUSTERING
    staging_prefix: str | None = None
    flush: Callable[[], None] = lambda: None
    primary_keys: dict[tuple[str, str], tuple[str, ...]] = field(default_factory=dict)

    def names(self, event: DdlEvent) -> tuple[str, str | None]:
        db = resolve_dataset_name(self.dataset, event.database)
        return normalize_dataset_name(db), normalize_table_name(event.table)

    def spec(self, event: DdlEvent) -> TableSpec:
        mapping = field_mapping(event.schema.names, self.flexible_names)
        fields = [T.StructField(mapping[f.name], f.dataType, f.nullable) for f in event.schema.fields]
        return TableSpec(T.StructType(fields), tuple(mapping[k] for k in event.primary_keys), source_names=tuple(event.schema.names))

    def keys_of(self, db: str, table: str) -> tuple[str, ...]:
        """Cached primary keys, reloaded from the manifest."""
        if (db, table) not in self.primary_keys and (m := self.store.manifest(db, table)):
            self.primary_keys[db, table] = tuple(m.primary_keys)
        return self.primary_keys[db, table]

    def clustering(self, spec: TableSpec) -> list[str]:
        return clustering_keys(from_spark(spec.schema), list(spec.primary_keys), self.max_clustering)

    def _create(self, db: str, table: str, spec: TableSpec) -> None:
        self.store.create_database(db)
        keys = [ROW_ID] if self.source.row_id else list(spec.primary_keys)
        self.store.create_table(db, table, target_schema(spec, self.source), list(spec.primary_keys), self.clustering(spec), keys)

    def _needs_keys(self, event: DdlEvent) -> None:
        if not event.primary_keys:
            raise ValueError(f"table {event.table} has no primary key; tables need one to be replicated")

    def handle(self, event: DdlEvent) -> None:
        if event.kind not in KINDS:
            raise ValueError(f"unknown schema change {event.kind!r}")
        db, table = self.names(event)
        getattr(self, f"_{event.kind.lower()}")(event, db, table)

    def _create_database(self, event, db, table) -> None:
        self.store.create_database(db)

    def _drop_database(self, event, db, table) -> None:
        self.primary_keys.clear()
        if db not in self.store.databases():
            return
        if self.require_manual_drops:
            raise ManualDropRequired(f"namespace {db} must be dropped by hand")
        self.store.drop_database(db)

    def _create_table(self, event, db, table) -> None:
        self._needs_keys(event)
        spec = self.spec(event)
        m = self.store.manifest(db, table)
        if m is not None and m.direct_load_in_progress:
            self.store.drop_table(db, table)  # an abandoned snapshot load
            m = None
        self.primary_keys[db, table] = spec.primary_keys
        if m is None:
            self._create(db, table, spec)

    def _drop_table(self, event, db, table) -> None:
        self.flush()
        self.primary_keys.pop((db, table), None)
        if self.store.exists(db, table):
            if self.require_manual_drops:
                raise ManualDropRequired(f"table {db}.{table} must be dropped by hand")
            self.store.drop_table(db, table)
        self.store.drop_table(db, staging_table(table, self.staging_prefix))

    def _alter_table(self, event, db, table) -> None:
        self._needs_keys(event)
        self.flush()
        spec = self.spec(event)
        m = self.store.manifest(db, table)
        if m is None:
            self._create(db, table, spec)
        else:
            schema = target_schema(spec, self.source)
            sort = [f for f in m.struct.fields if f.name not in schema.names and f.name == "_sort"]
            self.store.alter(db, table, T.StructType([*schema.fields, *sort]), list(spec.primary_keys), self.clustering(spec))
        self.primary_keys[db, table] = spec.primary_keys

    def _rename_table(self, event, db, table) -> None:
        log.warning("renaming tables is not supported; the event for %s.%s is ignored", db, table)

    def _truncate_table(self, event, db, table) -> None:
        self.flush()
        if self.store.exists(db, table):
            self.store.truncate(db, table)
        else:
            self._create(db, table, self.spec(event))
