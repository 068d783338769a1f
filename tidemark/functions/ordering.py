"""Ordering of out-of-order events.

``later(L, R)`` holds where R is known to be later than L.  With sort keys the keys decide, lexicographically and with
SQL's three-valued logic; where either first key is null, the source timestamp and then the sequence number decide.
Without sort keys only the latter do.  Struct comparison is no substitute: it ranks nulls, while here a null in a later
key makes the events incomparable.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.plans.envelope import SEQUENCE_NUM, SORT, SORT_KEY, SOURCE_TIMESTAMP

Getter = Callable[[str], Column]


def lexicographic_less(left: list[Column], right: list[Column]) -> Column:
    out = None
    for i in range(len(left)):
        terms = [left[j] == right[j] for j in range(i)] + [left[i] < right[i]]
        one = reduce(lambda a, b: a & b, terms)
        out = one if out is None else out | one
    return out


def sort_keys(side: Getter, n: int) -> list[Column]:
    return [side(SORT)[f"{SORT_KEY}{i}"] for i in range(n)]


def later(left: Getter, right: Getter, n_sort_keys: int) -> Column:
    fallback = lexicographic_less(
        [left(SOURCE_TIMESTAMP), left(SEQUENCE_NUM)], [right(SOURCE_TIMESTAMP), right(SEQUENCE_NUM)]
    )
    if not n_sort_keys:
        return fallback
    lk, rk = sort_keys(left, n_sort_keys), sort_keys(right, n_sort_keys)
    known = lk[0].isNotNull() & rk[0].isNotNull()
    return (known & lexicographic_less(lk, rk)) | ((lk[0].isNull() | rk[0].isNull()) & fallback)
