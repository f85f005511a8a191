"""What Python workers do between tasks: Spark keeps them for the next stage, so what a task has freed must not stay with them."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa


def give_back() -> None:
    """Hands what this process has freed back to the system: allocators keep it otherwise, and an executor's limit counts it for every worker."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def then_give_back(parts: Iterator, ended: Callable[[], None] | None = None) -> Iterator:
    """parts, after the last of which (or an error) `ended` runs and freed memory goes back."""
    try:
        yield from parts
    finally:
        if ended is not None:
            ended()
        give_back()
