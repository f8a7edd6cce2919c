"""Caches of a Python worker. A worker serves task after task; what one operator cached is dropped, and its memory given back to the
system, when another's task starts."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa

_clear: dict[str, Callable[[], None]] = {}
_last: list[str] = []


def caches(owner: str, clear: Callable[[], None]) -> None:
    _clear[owner] = clear


def enter(owner: str) -> None:
    if _last == [owner]:
        return
    _last[:] = [owner]
    for name, clear in _clear.items():
        if name != owner:
            clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # other C libraries give memory back by themselves
