"""Memory that a Python worker needs no more, given back before its next task.

A worker lives on between tasks, and beside it are others and the executor's own heap. What its
tasks free stays with the C library and with Arrow, in pieces between blocks that are in use, so
that each worker would keep about the most that any of its tasks took.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa

from voltledger.llm import words

# Only the GNU C library has to be asked.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return what is free to the system, and forget tables that are soon made again."""
    words.forget_powers()
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def giving_back(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` over the batches of a task, with its memory given back at the end of the task."""

    @functools.wraps(work)
    def task(batches):
        try:
            yield from work(batches)
        finally:
            give_back()

    return task
