"""Token ids of Arrow text batches with a public tokenizer file.

The byte-level tokenizers cut a text before every single space that stands
between two other characters, whatever comes around it, so a text is cut there
first and each distinct piece is encoded by the library once; ids of repeated
pieces are copied. A text with any other white space next to a space (runs of
spaces, a space at either end) is encoded whole.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHED_PIECES = 1_000_000  # about 200 bytes each
#: Pieces that are empty or have a control character at an end.
ODD = r"^$|^[\x00-\x20\x7f-\x{a0}]|[\x00-\x20\x7f-\x{a0}]$"


class Encoder:
    """One tokenizer file, with the ids of the pieces met so far."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        vocab = self.lib.get_vocab()
        self.spaced = np.zeros(max(vocab.values()) + 1, bool)  # ids that begin with a space
        self.spaced[[i for t, i in vocab.items() if t[0] == "\u0120"]] = True
        self._clear()

    def _clear(self):
        self.known: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.off = np.zeros(1 << 14, np.int64)

    def _encode(self, strings: list[str]) -> list[list[int]]:
        return [e.ids for e in self.lib.encode_batch_fast(strings, add_special_tokens=False)]

    def _learn(self, keys: list[str]) -> None:
        """Encode new keys: a piece stands for itself after a space, a piece
        with a space before it for itself at the start of a text. Pieces after
        a space go to the library many at a time; their ids are told apart by
        the one id of each that begins with the space."""
        heads = [k for k in keys if k[0] == " "]
        keys = [k for k in keys if k[0] != " "] + heads
        inner = len(keys) - len(heads)
        joined = [" " + " ".join(keys[i: min(i + 64, inner)]) for i in range(0, inner, 64)]
        got, of_heads = self._encode(joined), self._encode([k[1:] for k in heads])
        flat = [np.fromiter(chain.from_iterable(x), np.uint32) for x in (got, of_heads)]
        begins = np.flatnonzero(self.spaced[flat[0]])
        if len(begins) != inner:
            raise ValueError("the tokenizer joins pieces across a space")
        size = np.concatenate((np.diff(begins, append=len(flat[0])), [len(x) for x in of_heads])).astype(np.int64)
        n = len(self.known)
        end = self.off[n] + np.cumsum(size)
        while len(self.off) < n + len(keys) + 1:
            self.off = np.concatenate((self.off, np.zeros_like(self.off)))
        while len(self.ids) < end[-1]:
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        self.ids[self.off[n]: end[-1]] = np.concatenate(flat)
        self.off[n + 1: n + 1 + len(keys)] = end
        self.known.update(zip(keys, range(n, n + len(keys)), strict=True))

    def _numbers(self, keys: list[str]) -> np.ndarray:
        """Number of each key in the store; unknown ones are learnt."""
        got = list(map(self.known.get, keys))
        new = list({k for k, v in zip(keys, got, strict=True) if v is None})
        if len(self.known) + len(new) > CACHED_PIECES:
            self._clear()
            new = list(set(keys))
        if new:
            self._learn(new)
            got = list(map(self.known.__getitem__, keys))
        return np.array(got, np.int64)

    def batch(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, end to end, and their offsets. A null text
        has none."""
        if isinstance(text, pa.ChunkedArray):
            text = text.combine_chunks()
        if not len(text):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        text = pc.fill_null(text.cast(pa.large_string()), "")
        lists = pc.split_pattern(text, " ")
        per = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        start = np.concatenate(([0], np.cumsum(per)))
        coded = lists.flatten().dictionary_encode()
        pieces, index = coded.dictionary, coded.indices.to_numpy()
        odd = pc.or_(pc.not_equal(pc.utf8_trim_whitespace(pieces), pieces), pc.match_substring_regex(pieces, ODD))
        odd = odd.to_numpy(zero_copy_only=False).astype(bool)
        whole = np.logical_or.reduceat(odd[index], start[:-1])
        # the first piece of a text has no space before it; odd texts are encoded whole
        inner = np.repeat(~whole, per)
        inner[start[:-1]] = False
        met = np.zeros(len(pieces), bool)
        met[index[inner]] = True
        here = np.flatnonzero(met)
        plain = np.flatnonzero(~whole)
        heads = pieces.take(pa.array(index[start[:-1][plain]])).to_pylist()
        number = self._numbers(pieces.take(pa.array(here)).to_pylist() + [" " + h for h in heads])
        of_piece = np.zeros(len(pieces), np.int64)
        of_piece[here] = number[: len(here)]
        entry = of_piece[index]
        entry[start[:-1][plain]] = number[len(here):]
        size = np.diff(self.off)[entry]
        size[np.repeat(whole, per)] = 0
        total = np.cumsum(size)
        step = np.repeat(self.off[entry] - (total - size), size)
        flat = self.ids[step + np.arange(total[-1])]
        ends = np.concatenate(([0], total))[start]
        if whole.any():
            parts = np.split(flat, ends[1:-1])
            at = np.flatnonzero(whole)
            for i, ids in zip(at, self._encode(text.take(pa.array(at)).to_pylist()), strict=True):
                parts[i] = np.array(ids, np.uint32)
            ends = np.concatenate(([0], np.cumsum([len(x) for x in parts]))).astype(np.int64)
            flat = np.concatenate(parts)
        return flat, ends


_OPEN: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a tokenizer file, opened once."""
    if path not in _OPEN:
        _OPEN[path] = Encoder(path)
    return _OPEN[path]


def release() -> None:
    """Drop the worker's encoders and their pieces."""
    _OPEN.clear()


def default_tokenizer() -> str:
    """Path of the byte-level tokenizer file that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def gathered(batches, column: str, max_bytes: int = 12 << 20):
    """Tables of about ``max_bytes`` of a text column, from the batches of a
    partition (one batch may hold more)."""
    held, size = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            size += b.column(column).nbytes
        if size >= max_bytes:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
