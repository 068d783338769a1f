"""Assessment: what a table becomes in the target, and what stands against it."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.naming import normalize_dataset_name, normalize_field_name, normalize_table_name
from tidemark.functions.types import Field, UnsupportedType, warehouse_type

COLUMN_SCHEMA = "column string, target_column string, type string, supported boolean"
PROBLEM_SCHEMA = "problem string, severity string, detail string"


@dataclass
class Assessor:
    """Keeps the tables it has seen, to find a table name that two source schemas share."""

    dataset: str | None = None
    staging_prefix: str = "_staging_"
    flexible_names: bool = False
    _seen: dict[tuple[str, str], str] = field(default_factory=dict)

    def assess(self, database: str, schema: str, table: str, fields: list[Field], primary_keys: list[str]):
        """(column rows, problem rows)."""
        columns, problems = [], []
        for f in fields:
            name = normalize_field_name(f.name, self.flexible_names)
            try:
                columns.append((f.name, name, warehouse_type(f.type), True))
            except UnsupportedType:
                columns.append((f.name, name, "N/A", False))
        other = self._seen.setdefault((database, table), schema)
        if other != schema:
            problems.append(("table name used twice", "error", f"{table} is in the schemas {other} and {schema}"))
        if not primary_keys:
            problems.append(("no primary key", "warning", f"{table} needs a primary key to be replicated"))
        wanted = self.dataset or database
        if (got := normalize_dataset_name(wanted)) != wanted:
            problems.append(("namespace renamed", "warning", f"{wanted} becomes {got}"))
        for kind, name in (("table", table), ("staging table", f"{self.staging_prefix}{table}")):
            if (got := normalize_table_name(name)) != name:
                problems.append((f"{kind} renamed", "warning", f"{name} becomes {got}"))
        return columns, problems

    def frames(self, spark: SparkSession, *args) -> tuple[DataFrame, DataFrame]:
        columns, problems = self.assess(*args)
        return spark.createDataFrame(columns, COLUMN_SCHEMA), spark.createDataFrame(problems, PROBLEM_SCHEMA)
