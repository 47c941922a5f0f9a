"""What a Python worker holds between tasks: caches that one kind of task needs, and memory that its libraries keep.

Workers outlive their tasks, and a stage of another kind may follow in the same process. So caches are kept by name and
dropped once a function runs that doesn't use them, and freed memory goes back to the system when a task ends.
"""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa

_caches: dict[str, object] = {}


def cached[T](name: str, make: Callable[[], T]) -> T:
    """The worker's one object of this name, made when it is first asked for."""
    if name not in _caches:
        _caches[name] = make()
    return _caches[name]


def forget(*but: str) -> None:
    """Drop all caches but those named."""
    for name in [n for n in _caches if n not in but]:
        del _caches[name]


def give_back() -> None:
    """Return freed memory to the system, as far as the platform can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], *uses: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function over batches that begins without the caches of others and gives memory back at its end."""

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget(*uses)
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def _freed(run: Callable[[], pa.Table]) -> pa.Table:
    forget()
    try:
        return run()
    finally:
        give_back()


def lean_group(run: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """The same for a function over the table of a group."""
    return lambda table: _freed(lambda: run(table))


def lean_pair(run: Callable[[pa.Table, pa.Table], pa.Table]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The same for a function over the tables of two groups."""
    return lambda left, right: _freed(lambda: run(left, right))
