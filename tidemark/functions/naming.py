"""Identifier normalisation, as plain functions for schemas and as Columns for data.

Every rule is: leave null and empty alone, replace each *run* of forbidden characters by one ``_``,
prefix ``_`` where the rule asks for it, then truncate.  The plain functions and the Column functions
give the same results for text without surrogate pairs near the length limit.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Limits and character sets of the warehouse's naming rules.
MAX_NAMESPACE_LENGTH = 1024
MAX_TABLE_LENGTH = 1024
MAX_FIELD_LENGTH = 300
TABLE_CATEGORIES = ("L", "M", "N", "Pc", "Pd", "Zs")
FLEXIBLE_EXTRA = "&%+=:'<>#| "

_STRICT_RUN = re.compile(r"[^A-Za-z0-9_]+")
_ASCII_NAME = re.compile(r"[A-Za-z0-9_]+")
_STRICT_SQL = "[^A-Za-z0-9_]+"
_TABLE_SQL = r"[^\p{L}\p{M}\p{N}\p{Pc}\p{Pd}\p{Zs}]+"
_FLEXIBLE_SQL = r"[^\p{L}\p{M}\p{N}\p{Pc}\p{Pd}&%+=:'<>#| ]+"


def _collapse(name: str, allowed) -> str:
    out: list[str] = []
    in_run = False
    for ch in name:
        ok = allowed(ch)
        if ok:
            out.append(ch)
        elif not in_run:
            out.append("_")
        in_run = not ok
    return "".join(out)


def _in_categories(ch: str, categories: tuple[str, ...]) -> bool:
    kind = unicodedata.category(ch)
    return kind in categories or kind[0] in categories


def normalize_dataset_name(name: str | None) -> str | None:
    """Namespace name: ASCII word characters only, a leading digit is fine."""
    if not name:
        return name
    return _STRICT_RUN.sub("_", name)[:MAX_NAMESPACE_LENGTH]


def normalize_table_name(name: str | None) -> str | None:
    """Table name: letters, marks, numbers, connectors, dashes and spaces."""
    if not name:
        return name
    return _collapse(name, lambda ch: _in_categories(ch, TABLE_CATEGORIES))[:MAX_TABLE_LENGTH]


def normalize_field_name(name: str | None, flexible: bool = False) -> str | None:
    """Column name; ``flexible`` also admits international letters and a few symbols."""
    if not name:
        return name
    if flexible:
        kinds = TABLE_CATEGORIES[:-1]
        out = _collapse(name, lambda ch: ch in FLEXIBLE_EXTRA or _in_categories(ch, kinds))
    else:
        out = _STRICT_RUN.sub("_", name)
    if out[0] in "0123456789":
        out = "_" + out
    return out[:MAX_FIELD_LENGTH]


def resolve_dataset_name(configured: str | None, database: str) -> str | None:
    """The configured namespace, or the source database's name where none is configured."""
    return normalize_dataset_name(configured or database)


def is_ascii_name(name: str) -> bool:
    return _ASCII_NAME.fullmatch(name) is not None


def quote(path: str) -> str:
    """Backtick-quote a whole dotted path."""
    return "`" + path.replace("`", "``") + "`"


def field_mapping(names: list[str], flexible: bool = False) -> dict[str, str]:
    """Source name to normalised name.  Two names that become one are an error here, not a silent duplicate."""
    mapping = {n: normalize_field_name(n, flexible) for n in names}
    seen: dict[str, str] = {}
    for src, dst in mapping.items():
        if dst in seen:
            raise ValueError(f"columns {seen[dst]!r} and {src!r} both normalise to {dst!r}")
        seen[dst] = src
    return mapping


# --- Column versions ---------------------------------------------------------------------------------------------


def dataset_name_col(c: Column) -> Column:
    return F.substring(F.regexp_replace(c, _STRICT_SQL, "_"), 1, MAX_NAMESPACE_LENGTH)


def table_name_col(c: Column) -> Column:
    return F.substring(F.regexp_replace(c, _TABLE_SQL, "_"), 1, MAX_TABLE_LENGTH)


def field_name_col(c: Column, flexible: bool = False) -> Column:
    out = F.regexp_replace(c, _FLEXIBLE_SQL if flexible else _STRICT_SQL, "_")
    out = F.when(out.rlike("^[0-9]"), F.concat(F.lit("_"), out)).otherwise(out)
    return F.substring(out, 1, MAX_FIELD_LENGTH)


def resolve_dataset_col(configured: Column, database: Column) -> Column:
    chosen = F.when(F.coalesce(configured, F.lit("")) == "", database).otherwise(configured)
    return dataset_name_col(chosen)


def ascii_name_col(c: Column) -> Column:
    return c.rlike("^[A-Za-z0-9_]+$")


# --- keys and delays ---------------------------------------------------------------------------------------------


def state_key(dataset: str, table: str, prefix: str = "cdc") -> str:
    return f"{prefix}-{dataset}-{table}"


def table_key(dataset: str, table: str) -> str:
    return f"{dataset}:{table}"


# Job kinds, and how a derived staging location begins.
JOB_TYPES = ("stage", "load", "merge")
DERIVED_LOCATION_PREFIX = "tidemark"


def job_id(app: str, job: str, dataset: str, table: str, batch_id: int, attempt: int) -> str:
    if job not in JOB_TYPES:
        raise ValueError(f"unknown job type {job!r}")
    return f"{app}_{job}_{dataset}_{table}_{batch_id}_{attempt}"


def retry_delay_seconds(max_delay: int) -> int:
    """Upper backoff bound in seconds, kept under a minute and a half."""
    return min(91, max_delay) - 1


def staging_location_name(name: str | None, namespace: str, app: str, generation: int) -> str:
    """Staging location: trimmed, without a store scheme, lower-cased; derived where blank."""
    trimmed = (name or "").strip()
    if not trimmed:
        trimmed = f"{DERIVED_LOCATION_PREFIX}-{namespace}-{app}-{generation}"
    if trimmed.startswith("gs://"):
        trimmed = trimmed[len("gs://") :]
    return trimmed.lower()

