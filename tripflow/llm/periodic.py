"""Maximal periodic runs of words, by tiles scaled to octaves of the period.

Periods are taken by octaves ``[P, 2P)``, P a power of two. In an octave every
multiple of P is a boundary, and its tile reaches 2P words to the left and 4P to
the right: a run of at least three periods holds a boundary at which the next P
words come again one period later, and the tiles of neighbouring boundaries
overlap by more than a period. A boundary is looked at only where hashes of P
words agree; then a Z-function of the tile's right part and one of its left part,
reversed, give how far each period reaches, which is one interval fragment per
period that is not a multiple of a shorter one. Fragments are shuffled by
document and period and stitched where they overlap by a period or more.

All octaves of a text of usual length are tiled in one task. A text longer than
``LONG_BYTES`` is exploded to rows of tiles, small octaves sharing one, which
are dealt to tasks of their own.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._pairs import runs
from ._tables import arrow_conf, saved
from ._words import mix, slices, tidy, words

_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)
LONG_BYTES = 4 << 20  # a longer text is solved by several tasks
SMALL = 1 << 12       # largest octave whose hashes are kept
TILE_WORDS = 1 << 16  # words of the tiles that small octaves of a long text share


def z_function(x: list[int]) -> list[int]:
    """``z[i]``: length of the longest common prefix of ``x`` and ``x[i:]``."""
    n = len(x)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and x[k] == x[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


def _hits(h: np.ndarray, size: int, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """Boundaries (multiples of ``size`` from ``first`` up to ``last``) and
    periods of the octave at which the hashes of ``size`` words agree."""
    lo, hi = -(-first // size), -(-last // size)
    need = (hi + 1) * size
    if len(h) < need:  # a place past the end agrees with nothing
        h = np.concatenate((h, mix(np.arange(len(h), need, dtype=np.uint64)) | _U(1)))
    rows = h[lo * size: need].reshape(-1, size)
    at, d = np.nonzero(rows[1:] == rows[:-1, :1])
    return (at + lo) * size, d + size


def _primitive(hashes: list[np.ndarray], b: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Which stretches ``[b, b + p)`` are no power of a shorter one, by hashes."""
    ok = np.ones(len(b), bool)
    for period in np.unique(p).tolist():
        own = np.flatnonzero(p == period)
        for r in prime_factors(period):
            q = period // r
            rest = period - q
            k = rest.bit_length() - 1
            h, at, tail = hashes[k], b[own], rest - (1 << k)
            ok[own] &= ~((h[at] == h[at + q]) & (h[at + tail] == h[at + q + tail]))
    return ok


@functools.lru_cache(1 << 16)
def prime_factors(n: int) -> tuple[int, ...]:
    """Distinct prime factors of ``n``."""
    out, r = [], 2
    while r * r <= n:
        if n % r == 0:
            out.append(r)
            while n % r == 0:
                n //= r
        r += 1
    return (*out, n) if n > 1 else tuple(out)


def fragments(codes: np.ndarray, first: int, last: int, octaves: range) -> np.ndarray:
    """Rows (start, end, period) of all stretches that the tiles of the
    boundaries in ``[first, last)`` show. Equal words have equal codes; a code
    that occurs once separates texts."""
    found = []
    h = mix(codes.astype(np.uint64) * _ODD + _U(1))
    hashes = []
    for j in range(octaves.stop):
        size = 1 << j
        if size <= SMALL:
            hashes.append(h)
        if j >= octaves.start and len(codes) > 2 * size:
            at, period = _hits(h, size, first, last)
            fits = at + period + size <= len(codes)
            at, period = at[fits], period[fits]
            if len(at) and size <= SMALL:  # most multiples need no Z-function
                ok = _primitive(hashes, at, period)
                at, period = at[ok], period[ok]
            found += _extended(codes, at, period, size)
        if len(h) <= size:
            break
        h = mix(h[:-size] * _ODD + h[size:])
    return np.array(found, np.int64).reshape(-1, 3)


def _extended(codes: np.ndarray, at: np.ndarray, period: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """The stretch of each hit inside its boundary's tile, unless its period is
    a multiple of a shorter one."""
    out = []
    start = runs([at])
    for lo, hi in zip(start[:-1], start[1:], strict=True):
        b = int(at[lo])
        left = codes[max(0, b - 2 * size): b].tolist()
        right = codes[b: b + 4 * size].tolist()
        forth = z_function(right)
        # backwards from b against backwards from b + p: -1 is no code
        back = z_function(left[::-1] + [-1] + (left + right[:2 * size])[::-1])
        base = len(left) + 1 + min(len(right), 2 * size)
        for p in period[lo:hi].tolist():
            if not any(forth[p // r] >= p - p // r for r in prime_factors(p)):
                out.append((b - back[base - p], b + p + forth[p], p))
    return out


def stitched(rows: np.ndarray) -> np.ndarray:
    """Fragments (start, end, period) of one text, joined where two of a period
    overlap by that period."""
    if not len(rows):
        return rows
    rows = rows[np.lexsort((rows[:, 0], rows[:, 2]))]
    out = []
    for s, e, p in rows.tolist():
        if out and out[-1][2] == p and s <= out[-1][1] - p:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e, p])
    return np.array(out, np.int64)


def _coded(text: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All words of the texts, their codes, and the offsets of the texts."""
    flat, offsets = words(text)
    if not len(flat):
        return flat, np.zeros(0, np.int64), offsets
    return flat, flat.dictionary_encode().indices.to_numpy().astype(np.int64), offsets


def _text_fragments(codes: np.ndarray, offsets: np.ndarray, least: int, times: int) -> list[np.ndarray]:
    """Stretches of each text, stitched; those that are whole and too short to
    be runs are left out. Texts of similar length are tiled side by side."""
    size = np.diff(offsets)
    out: list[np.ndarray] = [np.zeros((0, 3), np.int64)] * len(size)
    band = np.frexp(np.maximum(size // times, 1))[1]  # octaves: 2**j <= n / times
    for octaves in np.unique(band[size >= least]):
        own = np.flatnonzero((band == octaves) & (size >= least))
        # a code of its own after each text keeps texts apart
        parts = [x for k, i in enumerate(own) for x in (codes[offsets[i]: offsets[i + 1]], np.array([-2 - k]))]
        begin = np.concatenate(([0], np.cumsum(size[own] + 1)))
        line = np.concatenate(parts)
        got = fragments(line, 0, len(line), range(int(octaves)))
        text = np.searchsorted(begin, got[:, 0], side="right") - 1
        for k in np.unique(text):
            rows = got[text == k] - np.array([begin[k], begin[k], 0])
            rows = stitched(rows)
            length = rows[:, 1] - rows[:, 0]
            out[own[k]] = rows[length >= np.maximum(least, times * rows[:, 2])]
    return out


def collapsed(flat: list[str], found: list[tuple[int, int, int]]) -> str:
    """The words outside every run's repeats (all after its first period)."""
    drop = np.zeros(len(flat) + 1, np.int64)
    for s, e, p in found:
        drop[s + p] += 1
        drop[e] -= 1
    keep = np.cumsum(drop)[:-1] == 0
    return " ".join(w for w, k in zip(flat, keep, strict=True) if k)


_LOOK = ("row long, doc_id long, n_words long, text string, long_text boolean, sha string,"
         " found array<struct<start:long,end:long,period:long>>")
_FOUND = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("period", pa.int64())]))


def _looked(docs: DataFrame, least: int, times: int, long_bytes: int) -> DataFrame:
    """Every text with the fragments that its tiles show. Only texts that have
    some, or that are long, are carried on; of the others the collapsed text is
    the text."""

    def rows(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                text = part.column("text")
                is_long = pc.greater(pc.fill_null(pc.binary_length(text), 0), long_bytes)
                flat, codes, offsets = _coded(pc.if_else(is_long, pa.scalar(None, text.type), text))
                found = _text_fragments(codes, offsets, least, times)
                has = [len(x) > 0 for x in found]
                carried = pc.or_(is_long, pa.array(has, pa.bool_()))
                joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat), pa.scalar(" ", flat.type))
                sha = [None if h else hashlib.sha256(x.as_buffer()).hexdigest()
                       for h, x in zip(carried.to_pylist(), joined, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("doc_id"), pa.array(np.diff(offsets)),
                     pc.if_else(carried, text, pa.scalar(None, text.type)), is_long, pa.array(sha, pa.string()),
                     pa.array([[{"start": s, "end": e, "period": p} for s, e, p in x.tolist()] for x in found], _FOUND)],
                    names=["row", "doc_id", "n_words", "text", "long_text", "sha", "found"])

    return docs.mapInArrow(tidy(rows), _LOOK)


def tiles(n: int, times: int, tile_words: int) -> list[tuple[int, int, int, int]]:
    """Tiles of a text of ``n`` words as (first octave, end octave, first
    boundary, end boundary): small octaves share tiles, larger ones have tiles
    that grow with the period."""
    top = max(1, (n // times).bit_length())
    shared = min(top, max(1, tile_words.bit_length() - 4))
    bands = [(0, shared, tile_words)] + [(j, j + 1, max(tile_words, 4 << j)) for j in range(shared, top)]
    return [(lo, hi, at, min(at + step, n)) for lo, hi, step in bands for at in range(0, n, step)]


def _tile_rows(texts: DataFrame, times: int, tile_words: int) -> DataFrame:
    """Long texts exploded to tiles: their words' codes with what the outermost
    boundaries need on either side."""

    def rows(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                part = batch.slice(i, 1)
                _, codes, _ = _coded(part.column("text"))
                for lo, hi, first, last in tiles(len(codes), times, tile_words):
                    begin = max(0, first - (2 << (hi - 1)))
                    piece = codes[begin: last + (4 << (hi - 1))].astype("<i4")
                    yield pa.RecordBatch.from_arrays(
                        [part.column("row"), *(pa.array([x], pa.int64()) for x in (lo, hi, begin, first, last)),
                         pa.array([piece.tobytes()], pa.binary())],
                        names=["row", "lo", "hi", "begin", "first", "last", "codes"])

    return texts.mapInArrow(tidy(rows), "row long, lo long, hi long, begin long, first long, last long, codes binary")


def _solved(tile_rows: DataFrame) -> DataFrame:
    """Fragments of each tile, without those that end inside it too early."""

    def rows(batches):
        for batch in batches:
            for r in batch.to_pylist():
                codes = np.frombuffer(r["codes"], "<i4").astype(np.int64)
                # places of the text and of the tile differ by a multiple of the largest boundary step
                skip = r["begin"] % (1 << (r["hi"] - 1))
                codes = np.concatenate((-2 - np.arange(skip), codes))
                shift = r["begin"] - skip
                got = fragments(codes, r["first"] - shift, r["last"] - shift, range(r["lo"], r["hi"]))
                got = stitched(got)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(got), r["row"])), pa.array(got[:, 0] + shift), pa.array(got[:, 1] + shift),
                     pa.array(got[:, 2])], names=["row", "start", "end", "period"])

    return tile_rows.mapInArrow(tidy(rows), "row long, start long, end long, period long")


def _maximal(parts: DataFrame, least: int, times: int) -> DataFrame:
    """Fragments stitched per text and period to maximal runs."""
    by = Window.partitionBy("row", "period").orderBy("start", "end")
    reach = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce((F.col("start") > reach - F.col("period")).cast("int"), F.lit(1))
    whole = parts.withColumn("new", new).withColumn("run", F.sum("new").over(by)) \
        .groupBy("row", "period", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    long_enough = F.col("end") - F.col("start") >= F.greatest(F.lit(least), F.col("period") * times)
    return whole.filter(long_enough).groupBy("row", "start", "end").agg(F.min("period").alias("period"))


def _told(texts: DataFrame) -> DataFrame:
    """The runs of each carried text and what is left without their repeats."""

    def rows(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                flat, offsets = words(part.column("text"))
                out = []
                for i, got in enumerate(part.column("runs").to_pylist()):
                    own = flat[int(offsets[i]): int(offsets[i + 1])].to_pylist()
                    found = sorted((r["start"], r["period"], r["end"]) for r in got or [])
                    listed = "".join(f"{s},{e - s},{p}\n" for s, p, e in found)
                    best = None
                    for s, p, e in found:  # by start, then period: the first of equal exponents stays
                        if best is None or (e - s) * best[1] > best[2] * p:
                            best = (s, p, e - s)
                    left = collapsed(own, [(s, e, p) for s, p, e in found])
                    out.append((len(found), *((best[0], best[2], best[1]) if best else (None,) * 3),
                                hashlib.sha256(listed.encode()).hexdigest(),
                                hashlib.sha256(left.encode()).hexdigest(), left, len(own)))
                n, start, length, period, listed, left, text, n_words = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n, pa.int64()),
                     *(pa.array(c, pa.int64()) for c in (start, length, period)),
                     pa.array(listed), pa.array(left), pa.array(text, pa.string()), part.column("runs")],
                    names=["doc_id", "n_words", "n_runs", "start", "length", "period", "runs_sha256",
                           "collapsed_sha256", "collapsed", "runs"])

    return texts.mapInArrow(tidy(rows), "doc_id long, n_words long, n_runs long, start long, length long, period long,"
                            " runs_sha256 string, collapsed_sha256 string, collapsed string,"
                            " runs array<struct<start:long,end:long,period:long>>")


def periodic_runs(docs: DataFrame, least: int = 24, times: int = 3, long_bytes: int = LONG_BYTES,
                  tile_words: int = TILE_WORDS) -> DataFrame:
    """Periodic runs of words in ``docs(doc_id, text)``.

    A run is a stretch of words with a least period p (words p apart are the
    same) and at least ``least`` words and ``times`` periods (``times`` is 3 or
    more), which no neighbouring word extends. Returns per row of ``docs``:
    ``doc_id``, ``n_words``, ``n_runs``, and of the run with the greatest
    length / period (ties: least start, then period) ``start`` (words counted
    from 0), ``length``, ``period``; ``runs_sha256`` (of ``start,length,period``
    lines of all runs by start, then period), ``collapsed_sha256`` (of the words
    that no run repeats, joined by one space); ``runs`` (start, end, period),
    empty or null without runs, and ``collapsed``, that text itself, null where
    it is all words of the text.

    Null, empty and white-space texts have no words and no run; a null doc_id is
    kept; repeated rows are told each for itself. Other columns are ignored. An
    empty table gives an empty result.
    """
    if times < 3:
        raise ValueError("runs of fewer than three periods need not hold a boundary")
    arrow_conf(docs.sparkSession)
    slim = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    seen = saved(_looked(slim, least, times, long_bytes), "periodic_texts")
    parts = seen.filter(F.size("found") > 0).select("row", F.explode("found").alias("f")).select("row", "f.*")
    dealt = _tile_rows(seen.filter("long_text").select("row", "text"), times, tile_words)
    parts = parts.unionByName(_solved(dealt.repartition("row", "lo", "first")))
    found = _maximal(parts, least, times).groupBy("row").agg(
        F.collect_list(F.struct("start", "end", "period")).alias("runs"))
    carried = seen.filter("text is not null").select("row", "doc_id", "text").join(found, "row", "left")
    empty = hashlib.sha256(b"").hexdigest()
    none = F.lit(None).cast("long")
    plain = seen.filter("text is null").select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_runs"), none.alias("start"), none.alias("length"),
        none.alias("period"), F.lit(empty).alias("runs_sha256"), F.col("sha").alias("collapsed_sha256"),
        F.lit(None).cast("string").alias("collapsed"),
        F.lit(None).cast("array<struct<start:long,end:long,period:long>>").alias("runs"))
    return plain.unionByName(_told(carried))
