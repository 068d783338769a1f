"""A small driver-side retry policy with exponential backoff."""

from __future__ import annotations

import random
import time
from collections.abc import Callable
from dataclasses import dataclass


class PermanentError(Exception):
    """An error that no retry mends."""


@dataclass(frozen=True)
class RetryPolicy:
    max_attempts: int = 25
    max_seconds: float = 120.0
    first_delay: float = 1.0
    max_delay: float = 30.0
    jitter: float = 0.1


#: The policies for the staging writer and set-up, and for the offset commit.
WRITER_POLICY = RetryPolicy(25, 120.0, 1.0, 30.0, 0.1)
COMMIT_POLICY = RetryPolicy(10**9, 300.0, 1.0, 60.0, 0.0)

#: Spark's error conditions that the request itself causes, so that sending it again mends nothing.
REASONS_PERMANENT = ("MALFORMED_RECORD_IN_PARSING", "USER_RAISED_EXCEPTION", "CAST_INVALID_INPUT", "CAST_OVERFLOW", "NUMERIC_VALUE_OUT_OF_RANGE")


def is_permanent(e: BaseException) -> bool:
    """Whether no retry can mend the error: wrong requests and wrong data, not lost machines or busy stores."""
    from pyspark.errors import AnalysisException, IllegalArgumentException

    if isinstance(e, PermanentError | ValueError | TypeError | KeyError | IllegalArgumentException):
        return True
    text = str(e)
    if isinstance(e, AnalysisException):
        return "[PATH_NOT_FOUND]" not in text
    return any(f"[{r}" in text for r in REASONS_PERMANENT)


def retry(action: Callable, policy: RetryPolicy = WRITER_POLICY, stopped: Callable[[], bool] = lambda: False,
          sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic):
    """Run ``action`` until it returns; give up on permanent errors, on the policy's limits or when stopped."""
    began, delay, attempt = clock(), policy.first_delay, 0
    while True:
        attempt += 1
        try:
            return action()
        except Exception as e:
            if is_permanent(e) or attempt >= policy.max_attempts or clock() - began + delay > policy.max_seconds or stopped():
                raise
        sleep(delay * (1 + random.uniform(-policy.jitter, policy.jitter)))
        delay = min(delay * 2, policy.max_delay)
