"""Memory of Python workers, which outlive their tasks and serve the next operator."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa


def give_back() -> None:
    """Return freed memory to the system; the C library and Arrow would keep it for this worker."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def released(run: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """``run``, a function over the batches of a task, which gives its memory back when the task ends."""
    def task(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return task
