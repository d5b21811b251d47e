"""Language-model scores with stupid backoff over the corpus' own n-gram counts.

The count table of all n-grams is partitioned by hash. Documents are taken in
chunks of bounded size, which are written first; a chunk sends each bucket (a
range of the hash) the distinct n-grams of its documents that fall there, with
their counts, packed as one row for each bucket that it has n-grams in. A
frequent n-gram costs one entry per chunk, not one per occurrence, and there
are never more rows than distinct n-grams of chunks. A bucket adds the counts
up and answers every chunk with the totals of the n-grams it asked for; the
chunk joins them to the n-grams of its documents in order and sums the scores
per document.

Keys are as many leading bits of the 64-bit hash as keep the chance that an
n-gram meets another one's key below 2**-24 at the corpus' size. Sorted, they
are sent as gaps, which take half of what a row of its own would: the rows of
the plain join (n-gram hash, chunk, count) hold 8 bytes each that nothing
compresses, over four times the input for trigrams.
"""

from __future__ import annotations

import math
import struct
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.session import fresh_dir

from ._pairs import runs, whole_groups
from ._tables import arrow_conf, saved
from ._words import ngram_hashes, word_hashes, tidy
from .encode import gathered

CHUNK_BYTES = 4 << 20    # text of one chunk
BUCKET_BYTES = 12 << 20  # text whose n-grams make up one bucket, on average
TASK_BYTES = 48 << 20    # text whose n-grams, or whose chunks, one task takes
BACKOFF = 0.4            # fixed value of the scheme


def pack(values: np.ndarray) -> bytes:
    """Unsigned values by byte planes, least byte first, as many as the largest
    value needs; a plane is compressed where that makes it smaller."""
    if not len(values):
        return b""
    width = max(1, (int(values.max()).bit_length() + 7) // 8)
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    codec, out = pa.Codec("zstd", 1), [struct.pack("<BI", width, len(values))]
    for plane in planes.T:
        raw = plane.tobytes()
        small = codec.compress(raw, asbytes=True)
        out += [struct.pack("<I", len(small)), small] if len(small) < len(raw) else [struct.pack("<I", 0), raw]
    return b"".join(out)


def unpack(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    width, n = struct.unpack_from("<BI", data)
    codec, at = pa.Codec("zstd"), 5
    out = np.zeros((n, 8), np.uint8)
    for i in range(width):
        size, = struct.unpack_from("<I", data, at)
        at += 4
        plane = codec.decompress(data[at: at + size], n, asbytes=True) if size else data[at: at + n]
        out[:, i] = np.frombuffer(plane, np.uint8)
        at += size or n
    return out.reshape(-1).view("<u8").astype(np.uint64)


def pack_keys(keys: np.ndarray) -> bytes:
    """Ascending keys: the first one whole, then the gaps."""
    return keys[:1].astype("<u8").tobytes() + pack(np.diff(keys))


def unpack_keys(data: bytes) -> np.ndarray:
    first = np.frombuffer(data[:8], "<u8").astype(np.uint64)
    return np.cumsum(np.concatenate((first, unpack(data[8:]))), dtype=np.uint64)


def key_bits(size: int, order: int) -> int:
    """Bits of a key in a corpus of ``size`` bytes, at most that many n-grams of
    each order: the chance to meet another n-gram's key stays below 2**-24."""
    return min(64, 24 + max(16, (size * order).bit_length()))


def _grams(text: pa.Array, order: int, bits: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Keys and text offsets of the n-grams of each order."""
    h, off = word_hashes(text)
    got = [ngram_hashes(h, off, n) for n in range(1, order + 1)]
    return [g >> np.uint64(64 - bits) for g, _ in got], [o for _, o in got]


def _bucket_of(keys: np.ndarray, buckets: int, bits: int) -> np.ndarray:
    """Range of the hash in which a key falls (ascending with the key)."""
    return ((keys >> np.uint64(bits - 32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _chunks(docs: DataFrame, folder: str) -> DataFrame:
    """Write the documents to files of a chunk each and give the files' names.
    The names must be written before they are used: a repeated task makes files
    of its own, and only those of the attempt that Spark commits are named."""

    def rows(batches):
        fs, path = pafs.FileSystem.from_uri(folder)
        fs.create_dir(path, recursive=True)
        for t in gathered(batches, "text", CHUNK_BYTES):
            name = uuid.uuid4().hex
            with fs.open_output_stream(f"{path}/{name}") as f, pa.ipc.new_stream(
                    f, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_table(t)
            yield pa.RecordBatch.from_arrays([pa.array([name])], names=["chunk"])

    return docs.mapInArrow(tidy(rows), "chunk string")


def _read_chunk(folder: str, name: str) -> pa.Table:
    fs, path = pafs.FileSystem.from_uri(folder)
    with fs.open_input_stream(f"{path}/{name}") as f:
        return pa.ipc.open_stream(f).read_all().combine_chunks()


def _requests(chunks: DataFrame, order: int, buckets: int, bits: int, folder: str) -> DataFrame:
    """Each chunk's distinct n-grams with their counts, by bucket. The same
    chunk gives the same rows whenever a task is repeated."""

    def rows(batches):
        for batch in batches:
            for name in batch.column("chunk").to_pylist():
                grams, _ = _grams(_read_chunk(folder, name).column("text"), order, bits)
                keys, counts = np.unique(np.concatenate(grams), return_counts=True)
                begin = runs([_bucket_of(keys, buckets, bits)])
                lead = np.where(begin[:-1] == 0, len(grams[0]), 0)  # the words go with the first row
                for lo in range(0, len(lead), 64):
                    cut = begin[lo: lo + 65]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(_bucket_of(keys[cut[:-1]], buckets, bits)), pa.array([name] * (len(cut) - 1)),
                         pa.array(lead[lo: lo + 64]),
                         pa.array([pack_keys(keys[x:y]) for x, y in zip(cut[:-1], cut[1:])], pa.binary()),
                         pa.array([pack(counts[x:y]) for x, y in zip(cut[:-1], cut[1:])], pa.binary())],
                        names=["bucket", "chunk", "words", "keys", "counts"])

    return chunks.mapInArrow(tidy(rows), "bucket long, chunk string, words long, keys binary, counts binary")


def _totals(requests: DataFrame, tasks: int) -> DataFrame:
    """The count table, bucket by bucket, as answers to the chunks."""

    def rows(batches):
        for t in whole_groups(batches, ["bucket"], min_rows=1):
            start = runs([t.column("bucket").combine_chunks().to_numpy()])
            out = []
            for lo, hi in zip(start[:-1], start[1:], strict=True):
                group = t.slice(lo, hi - lo)
                keys = [unpack_keys(x) for x in group.column("keys").to_pylist()]
                cut = np.cumsum([len(k) for k in keys])
                keys = np.concatenate(keys)
                counts = np.concatenate([unpack(x) for x in group.column("counts").to_pylist()])
                order = np.argsort(keys, kind="stable")
                begin = runs([keys[order]])
                sums = np.add.reduceat(counts[order], begin[:-1]) if len(keys) else counts
                total = np.empty(len(keys), np.uint64)
                total[order] = np.repeat(sums, np.diff(begin))
                out += [pack(x) for x in np.split(total, cut[:-1])]
            yield pa.RecordBatch.from_arrays(
                [x.combine_chunks() for x in (t.column("bucket"), t.column("chunk"), t.column("words"))]
                + [pa.array(out, pa.binary())], names=["bucket", "chunk", "words", "totals"])

    dealt = requests.repartition(tasks, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(tidy(rows), "bucket long, chunk string, words long, totals binary")


def own_counts(keys: np.ndarray, text: np.ndarray) -> np.ndarray:
    """How often the key of each place stands in the text of that place; keys
    are numbers from 0."""
    code = text * (int(keys.max(initial=0)) + 1) + keys
    _, at, n = np.unique(code, return_inverse=True, return_counts=True)
    return n[at]


def micro_scores(counts: list[np.ndarray], offsets: list[np.ndarray], total: int) -> np.ndarray:
    """Sum per text of each word's log score, in whole millionths.

    ``counts[n-1][i]`` is the count of the i-th n-gram in the *other* texts, and
    ``total`` the words of all texts. The n-gram that ends at a word is tried
    from the longest down; one that no other text holds backs off. A word that
    no other text holds counts as met once.
    """
    n_words = len(counts[0])
    if not n_words:
        return np.zeros(len(offsets[0]) - 1, np.int64)
    size = np.diff(offsets[0])
    text = np.repeat(np.arange(len(size)), size)
    score = np.log(np.maximum(counts[0], 1) / np.maximum(total - size, 1)[text])
    place = np.arange(n_words) - offsets[0][text]
    for n in range(2, len(counts) + 1):
        has = place >= n - 1
        at = (offsets[n - 1][text] + place - (n - 1))[has]
        # the context of an n-gram is the (n-1)-gram with the same start
        context = (offsets[n - 2][text] + place - (n - 1))[has]
        seen = counts[n - 1][at]
        score[has] = np.where(seen > 0, np.log(np.maximum(seen, 1) / np.maximum(counts[n - 2][context], 1)),
                              math.log(BACKOFF) + score[has])
    micro = np.concatenate(([0], np.cumsum(np.rint(score * 1e6).astype(np.int64))))
    return micro[offsets[0][1:]] - micro[offsets[0][:-1]]


def _scored(chunks: DataFrame, answers: DataFrame, order: int, total: int, bits: int, folder: str,
            tasks: int) -> DataFrame:
    def rows(batches):
        for t in whole_groups(batches, ["chunk"], min_rows=1):
            names = t.column("chunk").combine_chunks()
            start = runs([names.to_numpy(zero_copy_only=False)])
            for lo, hi in zip(start[:-1], start[1:], strict=True):
                docs = _read_chunk(folder, names[int(lo)].as_py())
                grams, offsets = _grams(docs.column("text"), order, bits)
                # the chunk's distinct n-grams ascend, and so do the buckets' answers
                at = np.unique(np.concatenate(grams), return_inverse=True)[1]
                asked = [unpack(x) for x in t.slice(lo, hi - lo).column("totals").to_pylist() if x is not None]
                text = np.concatenate([np.repeat(np.arange(len(o) - 1), np.diff(o)) for o in offsets])
                totals = np.concatenate([np.zeros(0, np.uint64), *asked]).astype(np.int64)[at]
                counts = np.split(totals - own_counts(at, text), np.cumsum([len(g) for g in grams])[:-1])
                yield pa.RecordBatch.from_arrays(
                    [docs.column("doc_id").combine_chunks(), pa.array(np.diff(offsets[0])),
                     pa.array(micro_scores(counts, offsets, total))],
                    names=["doc_id", "n_words", "log_score_micro"])

    # a chunk without any word has no answer and is named by itself
    named = chunks.select("chunk", F.lit(-1).cast("long").alias("bucket"), F.lit(None).cast("binary").alias("totals"))
    dealt = answers.select("chunk", "bucket", "totals").unionByName(named) \
        .repartition(tasks, "chunk").sortWithinPartitions("chunk", "bucket")
    return dealt.mapInArrow(tidy(rows), "doc_id long, n_words long, log_score_micro long")


def lm_scores(docs: DataFrame, order: int = 3) -> DataFrame:
    """Stupid-backoff score of every row of ``docs(doc_id, text)`` under the
    n-gram counts of all other rows.

    Returns ``doc_id``, ``n_words``, ``log_score_micro`` (sum of the words'
    natural-log scores in millionths, each rounded) and ``mean_log_score``
    (per word; null without words). A text's own n-grams are taken out of the
    counts, so it does not vouch for itself; an n-gram that no other row holds
    backs off, and a word that no other row holds counts as met once.

    Null and empty texts have no words and score 0; copies and repeated rows
    are other rows, count and are scored each; a null doc_id is kept. Other
    columns are ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    arrow_conf(spark)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets, bits = max(8, math.ceil(size / BUCKET_BYTES)), key_bits(size, order)
    # tasks grow with the corpus, so that none reads more than a few buckets or chunks
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / TASK_BYTES))
    folder = fresh_dir(spark, "lm_chunks")
    chunks = saved(_chunks(slim, folder), "lm_names")
    requests = _requests(chunks.repartition(tasks), order, buckets, bits, folder)
    answers = saved(_totals(requests, tasks), "lm_totals")
    total = answers.agg(F.sum("words")).first()[0] or 0
    return _scored(chunks, answers, order, total, bits, folder, tasks).select(
        "doc_id", "n_words", "log_score_micro",
        F.when(F.col("n_words") > 0, F.col("log_score_micro") / (F.col("n_words") * 1000000)).alias("mean_log_score"))
