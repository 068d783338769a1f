"""Entry point: the options of a replication target, start-up recovery, and the pieces built from them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from tidemark.functions.naming import normalize_table_name, resolve_dataset_name, staging_location_name
from tidemark.operators.assess import Assessor
from tidemark.operators.sequence import max_existing_sequence
from tidemark.plans.envelope import SEQUENCE_NUM, SourceProperties
from tidemark.sources.files import Files
from tidemark.sources.store import BUCKET_ROWS, Store
from tidemark.streaming.consumer import DEFAULT_INTERVAL_SECONDS, Consumer


@dataclass(frozen=True)
class TargetConfig:
    root: str
    dataset_name: str | None = None
    staging_location: str | None = None
    staging_table_prefix: str = "_staging_"
    load_interval: int = DEFAULT_INTERVAL_SECONDS
    require_manual_drops: bool = False
    soft_deletes: bool = False
    allow_flexible_column_naming: bool = False
    max_clustering_columns: int = 4
    retain_staging: bool = False
    namespace: str = "default"
    app: str = "app"
    generation: int = 0
    bucket_rows: int = BUCKET_ROWS


class Target:
    """A sink for change events."""

    def __init__(self, spark: SparkSession, config: TargetConfig):
        self.spark, self.config = spark, config
        self.store = Store(spark, config.root, bucket_rows=config.bucket_rows)

    def initialize(self, tables: list[tuple[str, str]]) -> int:
        """Greatest applied sequence number over the selected tables, to seed the source's numbering."""
        existing = {}
        for db, table in tables:
            key = resolve_dataset_name(self.config.dataset_name, db), normalize_table_name(table)
            if self.store.exists(*key):
                if SEQUENCE_NUM not in self.store.manifest(*key).struct.names:
                    raise ValueError(f"table {'.'.join(key)} has no {SEQUENCE_NUM} column")
                existing[".".join(key)] = self.store.read(*key)
        return max_existing_sequence(set(existing), existing)

    def staging_location(self) -> str:
        """Make sure that the staging location exists; one that is there already is fine."""
        c = self.config
        path = f"{c.root.rstrip('/')}-{staging_location_name(c.staging_location, c.namespace, c.app, c.generation)}"
        Files(self.spark).make(path)
        return path

    def assessor(self) -> Assessor:
        return Assessor(self.config.dataset_name, self.config.staging_table_prefix, self.config.allow_flexible_column_naming)

    def consumer(self, row_id: bool = False, ordered: bool = True) -> Consumer:
        c = self.config
        self.staging_location()
        out = Consumer(self.spark, c.root, SourceProperties(row_id, ordered, c.soft_deletes), c.app, c.dataset_name,
                       keep_staging_files=c.retain_staging, require_manual_drops=c.require_manual_drops,
                       flexible_names=c.allow_flexible_column_naming, load_interval=c.load_interval, store=self.store)
        out.ddl.max_clustering, out.ddl.staging_prefix = c.max_clustering_columns, c.staging_table_prefix
        return out
