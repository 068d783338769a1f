"""Versioned tables on plain Parquet: immutable data files, and one manifest a version, put in place in one step.

A manifest holds the schema, keys, sort types, high-water marks, finished jobs and, for each hash bucket, the data
folders that make it up.  A merge rewrites only the buckets that its events can match; rows whose key moves to another
bucket are added there as a further folder, and buckets of many folders are compacted.  The number of buckets follows
the number of rows (about ``bucket_rows`` a bucket), so that a batch of few keys rewrites a small share of a large table.
Data and progress are committed together, which makes ``foreachBatch``'s at-least-once delivery exactly-once.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.naming import quote, table_key
from tidemark.sources.files import Files

BUCKET = "_bucket"
KEEP_JOBS = 1000
BUCKETS, MAX_BUCKETS = 16, 1 << 17
BUCKET_ROWS = 1_000_000
MAX_FOLDERS = 16  # a bucket of more is compacted


class Conflict(RuntimeError):
    """Another writer has committed this version."""


@dataclass
class Manifest:
    version: int
    schema: dict
    primary_keys: list[str]
    clustering: list[str] = field(default_factory=list)
    sort_types: list[str] = field(default_factory=list)
    high_water: int = 0  # greatest sequence number of all that is applied
    snapshot_water: int = 0  # that of snapshot batches, which may be ahead until the streaming phase is over
    buckets: dict[str, list[str]] = field(default_factory=dict)
    n_buckets: int = BUCKETS
    rows: int = 0  # at most so many
    bucket_keys: list[str] = field(default_factory=list)
    jobs: list[str] = field(default_factory=list)
    direct_load_in_progress: bool = False

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(self.schema)


class Store:
    """Namespaces, tables and versions under one root folder."""

    def __init__(self, spark: SparkSession, root: str, n_buckets: int = BUCKETS, bucket_rows: int = BUCKET_ROWS, put_if_absent=None):
        self.spark, self.root, self.n_buckets, self.bucket_rows = spark, root.rstrip("/"), n_buckets, bucket_rows
        self.files = Files(spark, put_if_absent)

    def path(self, db: str, table: str = "") -> str:
        return f"{self.root}/{db}/{table}".rstrip("/")

    def databases(self) -> list[str]:
        return self.files.names(self.root)

    def tables(self, db: str) -> list[str]:
        return [t for t in self.files.names(self.path(db)) if self.exists(db, t)]

    def create_database(self, db: str) -> None:
        self.files.make(self.path(db))

    def drop_database(self, db: str) -> bool:
        """Drop an empty namespace; no-op where it is missing."""
        if self.tables(db):
            raise ValueError(f"namespace {db} still holds tables")
        return self.files.delete(self.path(db))

    def drop_table(self, db: str, table: str) -> bool:
        return self.files.delete(self.path(db, table))

    def exists(self, db: str, table: str) -> bool:
        return bool(self._versions(db, table))

    def _versions(self, db: str, table: str) -> list[int]:
        names = self.files.names(f"{self.path(db, table)}/manifests")
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[0] != ".")

    def manifest(self, db: str, table: str) -> Manifest | None:
        versions = self._versions(db, table)
        if not versions:
            return None
        return Manifest(**json.loads(self.files.read(f"{self.path(db, table)}/manifests/{versions[-1]}.json")))

    def commit(self, db: str, table: str, m: Manifest) -> None:
        m.jobs = m.jobs[-KEEP_JOBS:]
        where = f"{self.path(db, table)}/manifests/{m.version}.json"
        if not self.files.write_new(where, json.dumps(asdict(m))):
            raise Conflict(f"version {m.version} of {table_key(db, table)} exists")

    def create_table(self, db: str, table: str, schema: T.StructType, primary_keys: list[str],
                     clustering: list[str] = (), bucket_keys: list[str] | None = None) -> Manifest:
        m = Manifest(1, schema.jsonValue(), list(primary_keys), list(clustering), n_buckets=self.n_buckets,
                     bucket_keys=list(bucket_keys or primary_keys))
        self.commit(db, table, m)
        return m

    def bucket(self, m: Manifest, keys: list[str]) -> Column:
        """Bucket of a row, from key columns cast to the table's types, so that events and rows agree."""
        types = {f.name: f.dataType for f in m.struct.fields}
        cast = [F.col(quote(k)).cast(types[own]).cast("string") for k, own in zip(keys, m.bucket_keys, strict=True)]
        return F.pmod(F.xxhash64(*cast), F.lit(m.n_buckets)).cast("int")

    def read(self, db: str, table: str, buckets: set[int] | None = None, manifest: Manifest | None = None) -> DataFrame:
        """The table, or some of its buckets; columns that older files lack are null."""
        m = manifest or self.manifest(db, table)
        if m is None:
            raise ValueError(f"table {table_key(db, table)} does not exist")
        base = self.path(db, table)
        paths = [f"{base}/data/{folder}/{BUCKET}={b}" for b, folders in m.buckets.items()
                 if buckets is None or int(b) in buckets for folder in folders]
        if not paths:
            return self.spark.createDataFrame([], m.struct)
        return self.spark.read.schema(m.struct).parquet(*paths)

    def _write(self, db: str, table: str, m: Manifest, df: DataFrame, tag: str) -> dict[str, list[str]]:
        """Write rows by bucket: about a file a bucket, where adaptive execution splits what is too large for one task."""
        tag = f"{tag}-{uuid.uuid4().hex[:8]}"  # what a failed attempt left is never part of a later one
        folder = f"{self.path(db, table)}/data/{tag}"
        placed = df.withColumn(BUCKET, self.bucket(m, m.bucket_keys)).hint("rebalance", BUCKET)
        if m.clustering:
            placed = placed.sortWithinPartitions(BUCKET, *[quote(c) for c in m.clustering])
        placed.write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
        return {n.split("=")[1]: [tag] for n in self.files.names(folder) if n.startswith(f"{BUCKET}=")}

    def _fitting(self, rows: int) -> int:
        """Buckets for so many rows: a power of two times the least number, so that buckets split evenly."""
        n = self.n_buckets
        while n * self.bucket_rows < rows and n < MAX_BUCKETS:
            n *= 2
        return n

    @staticmethod
    def _mark(m: Manifest, job: str | None, marks: dict) -> None:
        for name, value in marks.items():
            setattr(m, name, max(getattr(m, name), value) if name.endswith("_water") else value)
        if job:
            m.jobs = [*m.jobs, job]

    def append(self, db: str, table: str, rows: DataFrame, n_rows: int, job: str | None = None, **marks) -> Manifest:
        """Bag union of ``n_rows`` rows into the table, for snapshots; widens the schema by new columns.  ``marks`` are
        committed together with the data."""
        m = self._widened(self.manifest(db, table), rows.schema)
        aligned, want = align(rows, m.struct), self._fitting(m.rows + n_rows)
        if want > m.n_buckets and (not m.buckets or want >= 4 * m.n_buckets):  # deal all rows out anew, each time four-fold
            aligned = self.read(db, table, None, m).unionByName(aligned) if m.buckets else aligned
            m.n_buckets, m.buckets = want, {}
        m.version, m.rows = m.version + 1, m.rows + n_rows
        for b, folders in self._write(db, table, m, aligned, f"a{m.version}").items():
            m.buckets[b] = [*m.buckets.get(b, []), *folders]
        self._mark(m, job, marks)
        self.commit(db, table, m)
        return m

    def touched(self, m: Manifest, events: DataFrame, match_keys: list[str]) -> set[int]:
        """Buckets that the events can match: at most ``n_buckets`` numbers."""
        found = events.where(reduce(lambda a, b: a & b, [F.col(quote(k)).isNotNull() for k in match_keys]))
        return {r[0] for r in found.select(self.bucket(m, match_keys)).distinct().collect()}

    def rewrite(self, db: str, table: str, m: Manifest, buckets: set[int], rows: DataFrame, n_events: int = 0, job: str | None = None, **marks) -> Manifest:
        """Replace the touched buckets by ``rows``; rows of other buckets are added to those."""
        m = self._widened(m, rows.schema)
        m.version, m.rows = m.version + 1, m.rows + n_events
        new = self._write(db, table, m, align(rows, m.struct), f"m{m.version}")
        kept = {b: f for b, f in m.buckets.items() if int(b) not in buckets}
        m.buckets = {b: [*kept.get(b, []), *new.get(b, [])] for b in {*kept, *new}}
        self._mark(m, job, marks)
        self.commit(db, table, m)
        return m

    def compact(self, db: str, table: str, max_folders: int = MAX_FOLDERS) -> int:
        """Rewrite buckets of more than ``max_folders`` folders as one each, or all where the table has outgrown their
        number; the number of buckets rewritten."""
        m = self.manifest(db, table)
        want = self._fitting(m.rows)
        grown = want >= 4 * m.n_buckets
        if grown:  # the rows are counted anew, since merges only bound their number
            m.rows = self.read(db, table, None, m).count()
            want = self._fitting(m.rows)
            grown = want > m.n_buckets
        some = {int(b) for b, f in m.buckets.items() if grown or len(f) > max_folders}
        if not some:
            return 0
        rows = self.read(db, table, some, m)
        m.version, m.n_buckets = m.version + 1, want if grown else m.n_buckets
        new = self._write(db, table, m, rows, f"c{m.version}")
        m.buckets = {b: f for b, f in m.buckets.items() if int(b) not in some} | new
        self.commit(db, table, m)
        return len(some)

    def truncate(self, db: str, table: str) -> Manifest:
        m = self.manifest(db, table)
        m.version, m.buckets, m.rows = m.version + 1, {}, 0
        self.commit(db, table, m)
        return m

    def alter(self, db: str, table: str, schema: T.StructType, primary_keys: list[str], clustering: list[str]) -> Manifest:
        """Add nullable columns and relax NOT NULL; any other change is an error.  Old data are not rewritten."""
        m = self.manifest(db, table)
        old = {f.name: f for f in m.struct.fields}
        new = {f.name: f for f in schema.fields}
        for name, f in new.items():
            if name in old and old[name].dataType != f.dataType:
                raise ValueError(f"column {name} cannot change from {old[name].dataType} to {f.dataType}")
            if name not in old and not f.nullable:
                raise ValueError(f"the new column {name} must be nullable")
            if name in old and old[name].nullable and not f.nullable:
                raise ValueError(f"column {name} cannot become NOT NULL")
        if gone := set(old) - set(new):
            raise ValueError(f"columns cannot be dropped: {sorted(gone)}")
        fields = [new[n] for n in old] + [f for n, f in new.items() if n not in old]
        m.version, m.schema, m.primary_keys, m.clustering = m.version + 1, T.StructType(fields).jsonValue(), list(primary_keys), list(clustering)
        self.commit(db, table, m)
        return m

    def mark(self, db: str, table: str, **marks) -> None:
        """Commit marks alone, where they change anything."""
        m = self.manifest(db, table)
        if m is not None:
            before = asdict(m)
            self._mark(m, None, marks)
            if asdict(m) != before:
                m.version += 1
                self.commit(db, table, m)

    def set_flag(self, db: str, table: str, in_progress: bool) -> None:
        self.mark(db, table, direct_load_in_progress=in_progress)

    @staticmethod
    def _widened(m: Manifest, schema: T.StructType) -> Manifest:
        have = set(m.struct.names)
        extra = [T.StructField(f.name, f.dataType, True) for f in schema.fields if f.name not in have]
        if extra:
            m.schema = T.StructType([*m.struct.fields, *extra]).jsonValue()
        return m

    def vacuum(self, db: str, table: str, keep: int = 1) -> int:
        """Delete data folders that none of the last ``keep`` manifests names."""
        base = self.path(db, table)
        versions = self._versions(db, table)
        live: set[str] = set()
        for v in versions[-keep:]:
            m = Manifest(**json.loads(self.files.read(f"{base}/manifests/{v}.json")))
            live |= {f for folders in m.buckets.values() for f in folders}
        dead = [f for f in self.files.names(f"{base}/data") if f not in live]
        for f in dead:
            self.files.delete(f"{base}/data/{f}")
        return len(dead)


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Bind columns by name, cast to the schema, null where absent."""
    have = set(df.columns)
    return df.select(*[
        (F.col(quote(f.name)) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ])
