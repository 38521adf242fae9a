"""What Python workers keep over their tasks, and how they give it back.

Workers are reused by all operators of an application. What one operator remembers, such as the ids of
words, is dropped when a worker starts on another operator, and freed memory is returned to the system
after every task, so that an executor's memory does not pile up over the stages of a pipeline.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa

_forget: list[Callable[[], None]] = []
_serving: list[str] = []


def forgets(clear: Callable[[], None]) -> None:
    """Call ``clear`` when a worker turns to another operator."""
    _forget.append(clear)


def serving(operator: str) -> None:
    """Tell the worker which operator it works for now."""
    if _serving != [operator]:
        for clear in _forget:
            clear()
        _serving[:] = [operator]


def give_back() -> None:
    """Return freed memory to the system, where the allocators can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(function: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function on batches that leaves no more behind than its operator remembers."""
    operator = function.__module__

    def run(batches: Iterator) -> Iterator:
        serving(operator)
        try:
            yield from function(batches)
        finally:
            give_back()

    return run
