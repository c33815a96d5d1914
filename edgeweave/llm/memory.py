"""Memory of Python workers, which live on from task to task beside the executor's heap.

Freed arrays stay with the allocators of a worker unless they are asked to give them back; without
that, a worker keeps the peak of the largest task that it ever ran while other stages fill the heap.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
import ctypes
from functools import wraps

import pyarrow as pa

KEPT_PAGES = 40_000  # of 4 KB: a worker below that is left alone


def give_back() -> None:
    """Return what is free to the system, if the worker has grown."""
    try:
        with open("/proc/self/statm") as said:
            if int(said.read().split()[1]) < KEPT_PAGES:
                return
        pa.default_memory_pool().release_unused()
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another system or C library: nothing to ask
        pass


def returning(run: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """A function for ``mapInArrow`` or ``mapInPandas`` that gives memory back at its end."""

    @wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def returning_table(run: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """The same for a function of ``applyInArrow``."""

    def wrapped(table: pa.Table) -> pa.Table:
        try:
            return run(table)
        finally:
            give_back()

    return wrapped


def free_names(taken: list[str], *names: str) -> list[str]:
    """The names, with underscores added as long as a column already has them, in any case of letters."""
    lower = {c.lower() for c in taken}
    out = []
    for name in names:
        while name.lower() in lower:
            name += "_"
        lower.add(name.lower())
        out.append(name)
    return out
