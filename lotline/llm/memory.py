"""Memory of Python workers, which serve one stage after the other."""

from __future__ import annotations

import contextlib
import ctypes

import pyarrow as pa


def give_back() -> None:
    """Hands what is free in this worker back to the system (where the C library can)."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)
