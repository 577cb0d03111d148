"""Memory of a Python worker, which Spark uses again for later tasks of any operator.

What one task leaves there, kept on purpose or as freed memory that its allocators hold, is on top of what the next
one needs, while the JVM beside it has grown. So tasks give freed memory back, and what is kept for an operator's later
tasks goes when those of another one start.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa

_kept: dict[tuple, object] = {}
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it


def kept(make: Callable, *args):
    """``make(*args)``, made once in this worker and there until a lean task starts in it."""
    key = (make, *args)
    if key not in _kept:
        _kept[key] = make(*args)
    return _kept[key]


def forget() -> None:
    _kept.clear()
    give_back()


def give_back() -> None:
    """Freed memory returns to the system."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def lean(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The same ``task`` of mapInArrow; it starts without what other operators have kept, and ends giving memory back."""
    @functools.wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        yield from task(batches)
        give_back()

    return run
