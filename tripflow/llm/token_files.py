"""Token-id files with directly addressable codes.

Ids are split into 8-bit chunks, least first. Level 0 holds the first chunk of
every id; a bitmap tells which ids go on, and level k+1 holds the next chunk of
those only. A rank directory (ones before every 512 bits of a bitmap) turns a
position in one level into the position in the next, so the id at any place is
read with one chunk and one rank per level, without decoding a block.

A file holds documents in ascending order of doc_id, with their ids' start
positions. Layout, all little-endian:

    b"DAC1", u32 levels, u64 documents, u64 ids, u64 chunks of each level
    i64 doc_id[documents], u64 start[documents + 1]
    per level: u8 chunk[n], and except for the last level
               u8 bitmap[ceil(n / 8)] (bit i of byte i // 8, lowest first),
               u64 rank[ceil(n / 512)]
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripflow.session import fresh_dir

from ._tables import arrow_conf, saved
from ._words import tidy
from .encode import encoder, gathered

#: Ids after which a file is closed (a longer document is one file).
IDS_PER_FILE = 4_000_000
#: Tasks that read files, at most; more files are several to a task.
MAX_TASKS = 20_000
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def encode_ids(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray | None, np.ndarray | None]]:
    """Levels of (chunks, bitmap, rank directory); the last has no bitmap."""
    levels, v = [], ids.astype(np.uint32)
    while True:
        chunk, rest = (v & 255).astype(np.uint8), v >> 8
        on = rest > 0
        if not on.any():
            return [*levels, (chunk, None, None)]
        bits = np.packbits(on, bitorder="little")
        ones = np.add.reduceat(_ONES[bits].astype(np.uint64), np.arange(0, len(bits), 64))
        levels.append((chunk, bits, np.concatenate(([0], np.cumsum(ones)[:-1])).astype(np.uint64)))
        v = rest[on]


def pack(doc_ids: np.ndarray, starts: np.ndarray, ids: np.ndarray) -> bytes:
    """The bytes of one file."""
    levels = encode_ids(ids)
    out = [b"DAC1", struct.pack("<IQQ", len(levels), len(doc_ids), len(ids)),
           struct.pack(f"<{len(levels)}Q", *(len(c) for c, _, _ in levels)),
           doc_ids.astype("<i8").tobytes(), starts.astype("<u8").tobytes()]
    for chunk, bits, rank in levels:
        out.append(chunk.tobytes())
        if bits is not None:
            out += [bits.tobytes(), rank.astype("<u8").tobytes()]
    return b"".join(out)


class TokenFile:
    """Random access to the ids of one file's bytes."""

    def __init__(self, data: bytes):
        if data[:4] != b"DAC1":
            raise ValueError("not a token file")
        n_levels, self.n_docs, self.n_ids = struct.unpack_from("<IQQ", data, 4)
        sizes = struct.unpack_from(f"<{n_levels}Q", data, 24)
        at = 24 + 8 * n_levels

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        self.doc_ids, self.starts = take("<i8", self.n_docs), take("<u8", self.n_docs + 1).astype(np.int64)
        self.levels = []
        for k, n in enumerate(sizes):
            chunk = take("u1", n)
            last = k == n_levels - 1
            self.levels.append((chunk, None if last else take("u1", -(-n // 8)),
                                None if last else take("<u8", -(-n // 512))))

    @staticmethod
    def _rank(bits: np.ndarray, rank: np.ndarray, i: int) -> int:
        """Ones among the first ``i`` bits."""
        if i == len(bits) * 8 and i % 512 == 0 or i // 512 >= len(rank):
            return int(rank[-1]) + int(_ONES[bits[(len(rank) - 1) * 64:]].sum()) if len(rank) else 0
        block, byte = i // 512, i // 8
        n = int(rank[block]) + int(_ONES[bits[block * 64: byte]].sum())
        return n + (int(_ONES[bits[byte] & ((1 << (i % 8)) - 1)]) if i % 8 else 0)

    def ids(self, start: int, end: int) -> np.ndarray:
        """The ids at positions ``start`` up to ``end``."""
        out, shift, where = np.zeros(end - start, np.uint32), 0, None
        for chunk, bits, rank in self.levels:
            part = chunk[start:end].astype(np.uint32) << np.uint32(shift)
            if where is None:
                out |= part
            else:
                out[where] |= part
            if bits is None or start == end:
                break
            lead = start % 8
            on = np.unpackbits(bits[start // 8: -(-end // 8)], bitorder="little")[lead: lead + end - start] > 0
            where = np.flatnonzero(on) if where is None else where[on]
            start = self._rank(bits, rank, start)
            end = start + int(on.sum())
            shift += 8
        return out

    def doc(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i + 1]))


def _put(folder: str, name: str, data: bytes) -> str:
    """Write a file under a name of its own and move it into place, so that a
    repeated task leaves one whole file."""
    fs, path = pafs.FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    tmp = f"{path}/_{uuid.uuid4().hex}"
    with fs.open_output_stream(tmp) as f:
        f.write(data)
    fs.move(tmp, f"{path}/{name}")
    return f"{folder}/{name}"


def read_file(uri: str) -> TokenFile:
    fs, path = pafs.FileSystem.from_uri(uri)
    with fs.open_input_file(path) as f:
        return TokenFile(f.read())


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 0,
                      ids_per_file: int = IDS_PER_FILE) -> DataFrame:
    """Encode ``docs(doc_id, text)``, append ``end_id`` to every document, and
    write files in ascending doc_id order below ``folder`` (a URI that all
    executors reach).

    Returns the manifest, one row per file: ``part``, ``seq``, ``path``,
    ``n_docs``, ``n_ids`` and ``base`` (ids in all files before it). Files in
    (part, seq) order hold the documents in order. Rows without doc_id are
    left out; a null text is empty; rows that repeat a doc_id are written one
    after the other, by text. An empty table gives an empty manifest.
    """
    arrow_conf(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")) \
        .filter("doc_id is not null")
    ordered = slim.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def rows(batches):
        enc, part, seq = encoder(tokenizer), TaskContext.get().partitionId(), 0
        held, n_ids = [], 0

        def close():
            nonlocal held, n_ids, seq
            doc_ids, sizes, ids = (np.concatenate(x) for x in zip(*held, strict=True))
            starts = np.concatenate(([0], np.cumsum(sizes)))
            path = _put(folder, f"part-{part:06d}-{seq:06d}.dac", pack(doc_ids, starts, ids))
            row = pa.RecordBatch.from_pydict({
                "part": [part], "seq": [seq], "path": [path], "n_docs": [len(doc_ids)], "n_ids": [len(ids)]})
            held, n_ids, seq = [], 0, seq + 1
            return row

        for t in gathered(batches, "text"):
            ids, off = enc.batch(t.column("text"))
            size = np.diff(off)
            ids = np.insert(ids, off[1:], np.uint32(end_id)).astype(np.uint16 if end_id < 65536 and (
                not len(ids) or ids.max() < 65536) else np.uint32)
            held.append((t.column("doc_id").to_numpy(), size + 1, ids))
            n_ids += len(ids)
            if n_ids >= ids_per_file:
                yield close()
        if held:
            yield close()

    files = saved(ordered.mapInArrow(tidy(rows), "part long, seq long, path string, n_docs long, n_ids long"), "token_files")
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("whole"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    parts = parts.select("part", F.coalesce(F.sum("whole").over(before), F.lit(0)).alias("part_base"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("in_part", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(parts, "part") \
        .select("part", "seq", "path", "n_docs", "n_ids", (F.col("part_base") + F.col("in_part")).alias("base"))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """One row per document, read from the files of a manifest: ``doc_id``,
    ``start`` (ids of all documents before it), ``n_tokens`` (with the end id)
    and ``ids_crc32`` (unsigned crc32 of its ids as little-endian unsigned
    32-bit integers)."""

    def rows(batches):
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
                f = read_file(path)
                step = max(1, int(f.n_docs * 1_000_000 // max(f.n_ids, 1)))  # about a million ids at a time
                for lo in range(0, f.n_docs, step):
                    hi = min(lo + step, f.n_docs)
                    starts = f.starts[lo: hi + 1]
                    raw = memoryview(f.ids(int(starts[0]), int(starts[-1])).astype("<u4").tobytes())
                    at = (starts - starts[0]) * 4
                    crc = [zlib.crc32(raw[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(f.doc_ids[lo:hi]), pa.array(starts[:-1] + base), pa.array(np.diff(starts)),
                         pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    # as many tasks as files: the rows are tiny, so sizes would put all files in one task
    files = manifest.select("path", "base").repartition(max(1, min(manifest.count(), MAX_TASKS)), "path")
    return files.mapInArrow(tidy(rows), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str, folder: str | None = None) -> DataFrame:
    """Write the token files of ``docs`` and read every document back."""
    where = folder or fresh_dir(docs.sparkSession, "dac")
    return read_token_files(saved(write_token_files(docs, tokenizer, where), "token_files"))
