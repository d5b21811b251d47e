"""Streaming of sorted groups through Arrow batches, and pair work in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa



def runs(keys: list[np.ndarray]) -> np.ndarray:
    """Start offsets of runs of equal key rows (sorted), with the end."""
    n = len(keys[0])
    if n == 0:
        return np.zeros(1, np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.concatenate((np.flatnonzero(new), [n]))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], min_rows: int = 4096) -> Iterator[pa.Table]:
    """Tables that hold whole groups of a stream sorted by ``keys``: the last
    group of what has come is held back until the next one begins."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        rows += b.num_rows
        if rows < min_rows:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        cut = runs([t.column(k).combine_chunks().to_numpy(zero_copy_only=False) for k in keys])[-2]
        if cut:
            yield t.slice(0, cut)
            t = t.slice(cut)
        held, rows = t.to_batches(), 0 if cut == 0 else t.num_rows
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def group_pairs(starts: np.ndarray, max_pairs: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j) inside each group, in pieces of about ``max_pairs``."""
    size = np.diff(starts)
    # row i of a group pairs with the rows after it
    after = np.concatenate([np.arange(m - 1, -1, -1) for m in size]) if len(size) else np.zeros(0, np.int64)
    row = np.arange(starts[0], starts[-1])
    end = np.cumsum(after)
    lo = 0
    while lo < len(row):
        base = end[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(end, base + max_pairs, side="right")))
        n = after[lo:hi]
        if n.sum():
            left = np.repeat(row[lo:hi], n)
            first = np.repeat(np.cumsum(n) - n, n)
            yield left, left + 1 + (np.arange(len(left)) - first)
        lo = hi


def merge_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least-label propagation over the edges (a, b) until it settles."""
    while len(a):
        la, lb = label[a], label[b]
        keep = la != lb
        if not keep.any():
            break
        a, b, la, lb = a[keep], b[keep], la[keep], lb[keep]
        lo = np.minimum(la, lb)
        np.minimum.at(label, np.maximum(la, lb), lo)
        np.minimum.at(label, a, lo)
        np.minimum.at(label, b, lo)
        # shorten the chains of labels
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    return label


def blobs(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column as one array, with offsets (no copy)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):  # no chunk at all
        column = pa.array([], pa.large_binary())
    column = column.cast(pa.large_binary())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64, n + 1, column.offset * 8)
    if data is None or off[-1] == off[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8, int(off[-1] - off[0]), int(off[0])), off - off[0]
