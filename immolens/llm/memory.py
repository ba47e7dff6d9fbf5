"""Giving memory back between tasks.

Python workers live on between tasks, and so does what the C and Arrow
allocators keep for reuse. On an executor several workers share one limit, so
each task hands back what it no longer needs when it ends.
"""

from __future__ import annotations

import ctypes
import functools
import inspect

import pyarrow as pa


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):          # not the GNU C library
        pass


def thrifty(fn):
    """A task's function (a generator over batches, or one over groups) that
    gives memory back when it ends."""
    if inspect.isgeneratorfunction(fn):
        def run(batches):
            try:
                yield from fn(batches)
            finally:
                give_back()
    else:
        def run(a, b):
            try:
                return fn(a, b)
            finally:
                give_back()
    return functools.wraps(fn, assigned=("__name__", "__doc__"))(run)
