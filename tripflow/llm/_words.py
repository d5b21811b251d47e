"""Words and word n-grams of Arrow text batches as 64-bit hashes (numpy).

Words are maximal runs of characters other than ASCII white space
(``[^\\x20\\x09-\\x0D]+``), case kept. A word is hashed over all its UTF-8
bytes; an n-gram is hashed over its word hashes in order. Two different
n-grams share a hash with probability 2**-64.
"""

from __future__ import annotations

import contextlib
import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import encode

_U = np.uint64
_PRIME = _U(0x100000001B3)
_RNG = np.random.default_rng(20240601)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)  # a random value per byte
_PLACE = _RNG.integers(1, 2**63, 64, dtype=np.uint64) | _U(1)  # a multiplier per place in an n-gram


def tidy(rows):
    """A mapInArrow function that gives the memory it no longer uses back to
    the system when its partition ends, since workers are kept for later
    tasks."""

    def run(batches):
        yield from rows(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL(None).malloc_trim(0)

    return run


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit values (splitmix finaliser)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def seeds(n: int, salt: int) -> np.ndarray:
    """``n`` fixed odd 64-bit values."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _PRIME + _U(salt)) | _U(1)


def hash_strings(strings: pa.Array) -> np.ndarray:
    """64-bit hash of each string's UTF-8 bytes (no nulls)."""
    strings = strings.cast(pa.large_binary())
    n = len(strings)
    if n == 0:
        return np.zeros(0, np.uint64)
    _, off, data = strings.buffers()
    off = np.frombuffer(off, np.int64, n + 1, strings.offset * 8)
    length = np.diff(off)
    total = int(off[-1] - off[0])
    out = length.astype(np.uint64)
    if total:
        b = np.frombuffer(data, np.uint8, total, int(off[0]))
        start = off[:-1] - off[0]
        power = np.cumprod(np.full(int(length.max()), _PRIME, np.uint64), dtype=np.uint64)
        place = np.arange(total, dtype=np.int64) - np.repeat(start, length)
        value = _BYTE[b] * power[place]
        full = length > 0
        out[full] += np.add.reduceat(value, start[full])
    return mix(out)


def words(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Flat array of all words and the offset of each text's first word
    (one more offset at the end). A null text has no words."""
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    lists = pc.ascii_split_whitespace(pc.fill_null(text.cast(pa.large_string()), ""))
    flat = lists.flatten()
    per_text = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate(([0], np.cumsum(per_text))).astype(np.int64)
    some = pc.greater(pc.binary_length(flat), 0)
    keep = np.asarray(some.to_numpy(zero_copy_only=False), dtype=bool)
    if not keep.all():
        flat = flat.filter(some)
        offsets = np.concatenate(([0], np.cumsum(keep)))[offsets].astype(np.int64)
    return flat, offsets


def word_hashes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the offsets of the texts in that array."""
    flat, offsets = words(text)
    if len(flat) == 0:
        return np.zeros(0, np.uint64), offsets
    coded = flat.dictionary_encode()
    return hash_strings(coded.dictionary)[coded.indices.to_numpy()], offsets


def ngram_hashes(h: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every n-gram that lies in one text, with the texts' offsets."""
    count = np.maximum(np.diff(offsets) - (n - 1), 0)
    out_off = np.concatenate(([0], np.cumsum(count))).astype(np.int64)
    if out_off[-1] == 0:
        return np.zeros(0, np.uint64), out_off
    acc = h[: len(h) - n + 1] * _PLACE[0]
    for k in range(1, n):
        acc += h[k: len(h) - n + 1 + k] * _PLACE[k]
    # positions whose n-gram would run into the next text are left out
    inside = np.ones(len(acc), bool)
    for k in range(1, n):
        ends = offsets[1:-1] - k
        inside[ends[(ends >= 0) & (ends < len(acc))]] = False
    # texts shorter than n: every start in them is outside
    short = np.diff(offsets) < n
    for i in np.flatnonzero(short):
        inside[offsets[i]: offsets[i + 1]] = False
    return mix(acc[inside] + _U(n)), out_off


def shingle_sets(text: pa.Array, n: int) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text; a text of 1 to n-1 words has
    one shingle of all its words, a text without words has none."""
    h, offsets = word_hashes(text)
    grams, goff = ngram_hashes(h, offsets, n)
    out = []
    for i in range(len(offsets) - 1):
        m = offsets[i + 1] - offsets[i]
        if m >= n:
            out.append(np.unique(grams[goff[i]: goff[i + 1]]))
        elif m:
            w = h[offsets[i]: offsets[i + 1]]
            out.append(mix((w * _PLACE[:m]).sum(dtype=np.uint64, keepdims=True) + _U(m)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 8 << 20):
    """Cut a batch into pieces of about ``max_bytes`` of ``column`` (a single
    longer text is a piece of its own)."""
    encode.release()  # a worker that has turned to other work needs no token cache
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, b in enumerate(sizes):
        if held and held + b > max_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(b)
    if start < batch.num_rows:
        yield batch.slice(start)
