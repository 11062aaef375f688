"""Memory that a finished stage gives back. Spark keeps its Python workers for the next stage; what the allocators hold
of one that is over, and the tables it read or filled, would stand beside the next one's."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache, wraps

import pyarrow as pa

_kept: dict[str, Callable[[], None]] = {}


def kept(most: int) -> Callable[[Callable], Callable]:
    """A function whose last `most` results stay with the worker from task to task, until a stage that does not
    name it runs there."""

    def wrap(function: Callable) -> Callable:
        held = lru_cache(maxsize=most)(function)
        _kept[function.__name__] = held.cache_clear
        return held

    return wrap


def let_go(keeps: tuple[str, ...] = ()) -> None:
    """Forget what other stages keep."""
    for name, clear in _kept.items():
        if name not in keeps:
            clear()


def release() -> None:
    """Return free memory of Arrow and of the C library to the system, where it offers that."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def given_back(stage: Callable[..., Iterator], *keeps: str) -> Callable[..., Iterator]:
    """The stage, which starts without the kept results of others but those named, and whose worker lets go of
    free memory when its task is done."""

    @wraps(stage)
    def run(batches):
        let_go(keeps)
        try:
            yield from stage(batches)
        finally:
            release()

    return run
