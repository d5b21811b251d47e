"""Join helpers: a broadcast that is only used behind a measured size."""

from __future__ import annotations

import threading
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest side, in bytes as cached, that is shipped whole to every executor.
DEFAULT_BROADCAST_BYTES = 64 << 20


# Spark's estimate for a frame of unknown size is near the largest long; no side is a pebibyte.
UNKNOWN_BYTES = 1 << 50


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own size estimate of ``df``: the files' bytes for a written
    table, an upper estimate for anything computed. No job runs."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def small_side(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """Whether the size estimate of ``df`` is within ``max_bytes``."""
    return estimated_bytes(df) <= max_bytes


def join_side(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``df``, to be broadcast if its size estimate is within ``max_bytes``. A
    frame that Spark has no estimate for is measured by :func:`sized_side`."""
    if estimated_bytes(df) >= UNKNOWN_BYTES:
        return sized_side(df, max_bytes).for_join()
    return F.broadcast(df) if small_side(df, max_bytes) else df


@dataclass
class SizedSide:
    """A persisted join side, its measured size, and the chosen strategy."""

    frame: DataFrame
    bytes: int
    broadcast: bool

    def for_join(self) -> DataFrame:
        return F.broadcast(self.frame) if self.broadcast else self.frame

    def release(self) -> None:
        self.frame.unpersist()


_scopes = threading.local()


@contextmanager
def released_after():
    """Unpersist every side that :func:`sized_side` persists inside the block.

    Jobs and streaming micro-batches wrap their writes in it, so cached join
    sides do not pile up over a long-running application.
    """
    stack = getattr(_scopes, "stack", None)
    if stack is None:
        stack = _scopes.stack = []
    stack.append([])
    try:
        yield
    finally:
        for side in stack.pop():
            side.release()


def sized_side(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> SizedSide:
    """Persist ``df``, measure it, and broadcast it only if it has at most
    ``max_bytes`` bytes. Beyond that the join falls back to a shuffle join, where
    adaptive execution splits skewed keys.

    The count is the job that fills the cache, so the joins that follow read
    the persisted rows instead of recomputing the side. Lost cache blocks are
    rebuilt from lineage.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    kept.count()
    size = int(kept._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    side = SizedSide(kept, size, size <= max_bytes)
    stack = getattr(_scopes, "stack", None)
    if stack:
        stack[-1].append(side)
    return side
