"""What a Python worker keeps between tasks: one model at a time."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable

import pyarrow as pa

_held: list = [None, None]


def release() -> None:
    """Give back what the worker keeps: the model, and freed memory that Arrow and C still hold."""
    _held[:] = [None, None]
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if trim:
        trim(0)


def held(key: Hashable, make: Callable[[], object]):
    """The object of ``key``, made when it is first asked for; it takes the place of any other.

    Spark's workers serve one operator after another, and what each of them
    kept would add up in the memory of an executor."""
    if _held[0] != key:
        release()  # the old one goes before the new one is made
        _held[:] = [key, make()]
    return _held[1]
