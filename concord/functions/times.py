"""Expiry, retry and throttle arithmetic. Epochs are truncated, not rounded."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_seconds(value: Column) -> Column:
    return value.try_cast("double").cast("bigint")


def is_expired(expiry: Column, now: Column) -> Column:
    """Expired when earlier than now in whole seconds; equal is still valid, a value that is no number is null."""
    return whole_seconds(expiry) < whole_seconds(now)


def is_ready(cookie: Column, now: Column, ttl: int) -> Column:
    """Whether a retry is due: not within ttl seconds of the cookie's time; a malformed cookie is ready."""
    return F.coalesce(whole_seconds(now) - whole_seconds(cookie) >= ttl, F.lit(True))


def backoff_wait(attempt: Column, initial: float, step: float) -> Column:
    return F.lit(initial) + attempt * F.lit(step)
