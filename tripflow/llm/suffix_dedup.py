"""Removal of repeated passages by a sampled suffix array.

Every byte that lies in a string of ``length`` bytes which also starts earlier is
removed, exactly. All windows of ``length`` bytes would be too many to sort, so
each window is told by its anchor: the least hashed ``LEAD`` bytes inside it, the
leftmost of equal ones. Equal windows have the same anchor at the same place, and
neighbouring windows share theirs, so a text has one suffix to look at (it starts
at an anchor) for about forty windows.

1. *Screen.* A task reduces its texts to one row per different stretch (the bytes
   that all windows of an anchor cover), with the places where it has it. Where
   the leading bytes are hot (they come with very many stretches), a stretch is
   cut into a few pieces by how far its windows start before the anchor: the
   windows of a piece share more bytes, which take the place of the leading ones,
   and a piece whose bytes are hot is cut again, at last into single windows.
   Rows meet by the hash of their leading bytes. A stretch that is equal to an
   earlier one is a repeat as a whole; one whose leading bytes come with no other
   stretch is done; the rest goes on, one row per different stretch.
2. *Suffix array.* Those suffixes are range-partitioned by their leading tokens
   (8 bytes each) and the hash of all leading bytes, between sampled splitters,
   so that equal ones stay together. A bucket sorts the windows of its suffixes
   by multikey quicksort, token by token, and finds equal neighbours. Leading
   bytes of more suffixes than a bucket holds are cut further by document; only
   their windows are compared across the boundaries by hash.
3. *Removal.* Repeats are joined to intervals per document and cut out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripflow.operators.joins import join_side

from ._pairs import blobs, runs, whole_groups
from ._tables import arrow_conf, saved
from ._words import _BYTE, mix, slices, tidy

_U = np.uint64
LEAD = 24             # leading bytes of a suffix that are hashed: three tokens
BLOCK_BITS = 19       # bytes of text that are hashed side by side: 2**BLOCK_BITS
BUCKET_ROWS = 40_000  # suffixes of one bucket, on average
BROADCAST_BYTES = 16 << 20  # largest table of intervals, as written, that is sent whole
SAMPLE = 64           # one document in so many is looked at for hot leading bytes
HOT_SHARE = 2e-4      # share of the sample's suffixes that makes leading bytes hot
PIECES = 9            # pieces of a stretch with hot leading bytes
_BASE = 0x2545F4914F6CDD1D | 1  # odd, so that it has an inverse modulo 2**64
_NULL_ID = 2**63 - 1  # documents without an id come last
_POWER: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse."""
    if not _POWER or len(_POWER[0]) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        _POWER[:] = [np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n, b, np.uint64))), dtype=np.uint64)
                     for b in (_BASE, inverse)]
    return _POWER[0], _POWER[1]


class Prefix:
    """Hashes of any stretches of some bytes, from sums over their prefixes."""

    def __init__(self, data: np.ndarray):
        power, self.inverse = _powers(max(len(data), 1 << BLOCK_BITS) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * power[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.inverse[start]

    def all(self, size: int) -> np.ndarray:
        """Of every stretch of ``size`` bytes."""
        return (self.sums[size:] - self.sums[:-size]) * self.inverse[: len(self.sums) - size]


def widths(length: int) -> list[int]:
    """Places of the anchor that a piece stands for, by how often it was cut."""
    out = [length - LEAD + 1]
    while out[-1] > 1:
        out.append(-(-out[-1] // PIECES))
    return out[1:]


def pieces_of(start: np.ndarray, n: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Stretches cut where their windows' anchor has moved by ``width`` places:
    the stretch, start, number of windows, and the first byte that all windows
    with such an anchor share (``length - width + 1`` bytes are shared)."""
    most = at - start
    first = (most - n + 1) // width
    count = most // width - first + 1
    own = np.repeat(np.arange(len(start)), count)
    node = first[own] + np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
    core = at[own] - node * width
    begin = np.maximum(start[own], core - width + 1)
    return own, begin, np.minimum(start[own] + n[own] - 1, core) - begin + 1, core


def stretches(data: np.ndarray, begin: np.ndarray, length: int, hot: np.ndarray) -> tuple[np.ndarray, ...]:
    """The stretches of the texts that start at ``begin`` in ``data`` (ends
    included), those with ``hot`` leading bytes in pieces: start, number of
    windows, first leading byte, and hashes of the leading bytes and of all
    bytes."""
    span = length - LEAD + 1  # places where a window's anchor may be
    n = len(data) - length + 1
    if n <= 0:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    prefix = Prefix(data)
    lead = mix(prefix.all(LEAD))
    place = np.arange(len(lead), dtype=np.uint64)
    low = _U((1 << (BLOCK_BITS + 1)) - 1)
    best = (lead & ~low) | place  # equal hashes: the leftmost place
    width = 1
    while width * 2 <= span:
        best = np.minimum(best[:-width], best[width:])
        width *= 2
    if span > width:
        best = np.minimum(best[: n], best[span - width: span - width + n])
    anchor = (best[:n] & low).astype(np.int64)
    # windows that run into the next text belong to none
    inside = np.ones(n + 1, np.int8)
    inside[n] = 0
    ends = begin[1:]
    edge = np.zeros(n + 2, np.int64)
    np.add.at(edge, np.clip(np.maximum(ends - length + 1, begin[:-1]), 0, n + 1), 1)
    np.add.at(edge, np.clip(ends, 0, n + 1), -1)
    inside[:n] = np.cumsum(edge)[:n] <= 0
    new = np.flatnonzero(np.diff(anchor, prepend=-1) != 0)
    cut = np.flatnonzero(np.diff(inside[:n], prepend=0) != 0)
    # a text's first window may have the anchor value of a window left out before it
    start = np.union1d(new, cut)
    stop = np.append(start[1:], n)
    good = inside[start] == 1
    start, n = start[good], stop[good] - start[good]
    at = core = anchor[start]
    lead = lead[at]
    done, hot = [], np.sort(hot)
    for width in widths(length):
        cut = np.isin(lead, hot) if len(hot) else np.zeros(len(lead), bool)
        done.append([x[~cut] for x in (start, n, core, lead)])
        if not cut.any():
            break
        own, start, n, core = pieces_of(start[cut], n[cut], at[cut], width)
        at = at[cut][own]
        lead = mix(prefix.of(core, core + length - width + 1) + _U(width))
    else:
        done.append([start, n, core, lead])  # single windows
    start, n, core, lead = (np.concatenate(x) for x in zip(*done, strict=True))
    return start, n, core, lead, mix(prefix.of(start, start + n + length - 1) + core.astype(np.uint64)
                                     - start.astype(np.uint64))


def pieces(off: np.ndarray, length: int):
    """Texts (by their offsets) as blocks of at most ``2**BLOCK_BITS`` bytes: the
    text, first byte and end byte of each part. A longer text is cut where its
    windows can be shared out."""
    size, block, held = 1 << BLOCK_BITS, [], 0
    for i in range(len(off) - 1):
        lo, end = int(off[i]), int(off[i + 1])
        while end - lo >= length:
            hi = min(end, lo + size)
            if held + hi - lo > size and block:
                yield block
                block, held = [], 0
            block.append((i, lo, hi))
            held += hi - lo
            if hi == end:
                break
            lo = hi - length + 1
    if block:
        yield block


def _occurrences(text: pa.Array, length: int, hot: np.ndarray):
    """All stretches of some texts: text, start, windows, the leading bytes'
    place in the stretch, hash of the leading bytes, hash of the stretch."""
    data, off = blobs(text)
    out = []
    for block in pieces(off, length):
        begin = np.concatenate(([0], np.cumsum([hi - lo for _, lo, hi in block])))
        part = np.concatenate([data[lo:hi] for _, lo, hi in block])
        start, n, at, lead, whole = stretches(part, begin, length, hot)
        k = np.searchsorted(begin, start, side="right") - 1
        own = np.array([i for i, _, _ in block])[k]
        first = np.array([lo for _, lo, _ in block])[k] - off[own]
        out.append((own, start - begin[k] + first, n, at - start, lead, whole))
    if not out:
        return [np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64)]
    return [np.concatenate(c) for c in zip(*out, strict=True)]


_OCC = "lead long, whole long, doc long, mark long, start int, windows short, anchor short, more binary"


def _screen_rows(texts: DataFrame, length: int, hot: np.ndarray) -> DataFrame:
    """One row per different stretch of a slice of texts, at its first place;
    ``more`` has its other places there."""

    def rows(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                own, start, n, anchor, lead, whole = _occurrences(part.column("text"), length, hot)
                if not len(own):
                    continue
                doc = part.column("doc").to_numpy()[own]
                mark = part.column("mark").to_numpy()[own]
                order = np.lexsort((start, mark, doc, whole, lead))
                first = runs([lead[order], whole[order]])
                more = [None] * (len(first) - 1)
                for i in np.flatnonzero(np.diff(first) > 1):
                    o = order[first[i] + 1: first[i + 1]]
                    more[i] = np.stack((doc[o], mark[o], start[o])).astype("<i8").tobytes()
                o = order[first[:-1]]
                cols = (lead[o].view(np.int64), whole[o].view(np.int64), doc[o], mark[o], start[o].astype(np.int32),
                        n[o].astype(np.int16), anchor[o].astype(np.int16))
                yield pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array(more, pa.binary())],
                                                 names=[c.split()[0] for c in _OCC.split(", ")])

    return texts.mapInArrow(tidy(rows), _OCC)


def _hot(texts: DataFrame, length: int) -> np.ndarray:
    """Leading bytes (hashed) that come with many different stretches, or pieces
    of such, in a sample of the documents; at most ``1 / HOT_SHARE`` of them for
    each length of pieces. Only how rows are cut and dealt depends on it."""
    some = texts.filter(F.pmod(F.xxhash64("doc", "mark"), F.lit(SAMPLE)) == 0)
    hot = np.zeros(0, np.uint64)
    for _ in widths(length):

        def rows(batches, hot=hot):
            for batch in batches:
                for part in slices(batch, "text"):
                    *_, lead, whole = _occurrences(part.column("text"), length, hot)
                    pairs = np.unique(np.stack((lead, whole)), axis=1).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in pairs], names=["lead", "whole"])

        pairs = some.mapInArrow(tidy(rows), "lead long, whole long").distinct()
        counts = saved(pairs.groupBy("lead").agg(F.count(F.lit(1)).alias("n")).filter("n > 8"), "suffix_sample")
        all_rows = counts.agg(F.sum("n")).first()[0] or 0
        found = counts.filter(F.col("n") > F.lit(max(64, all_rows * HOT_SHARE))).select("lead").collect()
        if not found:
            break
        hot = np.concatenate((hot, np.array([r[0] for r in found], np.int64).view(np.uint64)))
    return hot


_SCREENED = "open boolean, doc long, mark long, start long, size long, anchor long, lead long"


def _screened(rows_: DataFrame, length: int) -> DataFrame:
    """Repeats (as intervals) and stretches to look into (``open``)."""
    keys = ["lead", "whole"]

    def rows(batches):
        for t in whole_groups(batches, ["lead"], min_rows=1 << 16):
            cols = {c: t.column(c).combine_chunks() for c in t.column_names if c != "more"}
            cols = {c: v.to_numpy() for c, v in cols.items()}
            same = runs([cols[c] for c in keys])
            head = np.repeat(same[:-1], np.diff(same))
            # a repeated row of the same document and place is not another place
            again = np.zeros(t.num_rows, bool)
            for c in ("doc", "mark", "start"):
                again |= cols[c] != cols[c][head]
            group = runs([cols["lead"]])
            kinds = np.searchsorted(same, group)  # index of each group's first stretch
            several = np.repeat(np.diff(kinds) > 1, np.diff(group))
            open_ = several & (head == np.arange(t.num_rows))
            size = cols["windows"].astype(np.int64)
            parts = [(np.zeros(int(again.sum()), bool), *(cols[c][again] for c in ("doc", "mark", "start")),
                      size[again] + length - 1, cols["anchor"][again], cols["lead"][again]),
                     (np.ones(int(open_.sum()), bool), *(cols[c][open_] for c in ("doc", "mark", "start")),
                      size[open_], cols["anchor"][open_], cols["lead"][open_])]
            more = t.column("more").combine_chunks()
            for i in np.flatnonzero(more.is_valid().to_numpy(zero_copy_only=False)):
                got = np.frombuffer(more[int(i)].as_py(), "<i8").reshape(3, -1)
                differs = (got != np.array([[cols[c][head[i]]] for c in ("doc", "mark", "start")])).any(0)
                d, m, s = got[:, differs]
                parts.append((np.zeros(len(d), bool), d, m, s, np.full(len(d), size[i] + length - 1), np.zeros(len(d), np.int64),
                              np.zeros(len(d), np.int64)))
            cols = [np.concatenate(c) for c in zip(*parts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0]), *(pa.array(c.astype(np.int64)) for c in cols[1:])],
                names=[c.split()[0] for c in _SCREENED.split(", ")])

    dealt = rows_.repartition("lead").sortWithinPartitions(*keys, "doc", "mark", "start")
    return dealt.mapInArrow(tidy(rows), _SCREENED)


_SUFFIX = "t0 long, t1 long, t2 long, lead long, doc long, mark long, start long, bytes binary"


def _suffixes(texts: DataFrame, length: int) -> DataFrame:
    """The leading tokens and the bytes of each stretch to look into."""

    def rows(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                data, off = blobs(part.column("text"))
                lists = part.column("open")
                own = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy())
                flat = lists.flatten()
                start, size, anchor, lead = (pc.struct_field(flat, i).to_numpy() for i in range(4))
                lo = off[own] + start
                words = tokens(data, lo + anchor, LEAD // 8)
                out = [data[a: b].tobytes() for a, b in zip(lo, lo + size + length - 1, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(ordered(w)) for w in words), pa.array(lead), part.column("doc").take(pa.array(own)),
                     part.column("mark").take(pa.array(own)), pa.array(start), pa.array(out, pa.binary())],
                    names=[c.split()[0] for c in _SUFFIX.split(", ")])

    return texts.mapInArrow(tidy(rows), _SUFFIX)


def big_endian(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as one number that sorts as they do (zeros
    past the end)."""
    one = np.concatenate((data, np.zeros(8, np.uint8)))
    two = one[:-1].astype(np.uint64) << _U(8) | one[1:]
    four = two[:-2] << _U(16) | two[2:]
    return (four[:-4] << _U(32) | four[4:])[: len(data)]


def tokens(data: np.ndarray, at: np.ndarray, n: int) -> list[np.ndarray]:
    """``n`` tokens of 8 bytes from each place on."""
    out = []
    for k in range(n):
        token = np.zeros(len(at), np.uint64)
        for b in range(8):
            token = token << _U(8) | data[at + 8 * k + b]
        out.append(token)
    return out


def ordered(token: np.ndarray) -> np.ndarray:
    """Unsigned numbers as signed ones in the same order."""
    return (token ^ _U(1 << 63)).view(np.int64)


def multikey_sort(token: np.ndarray, at: np.ndarray, places: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort of the strings that start ``at`` some places: they are
    sorted by one token, then each run of equal ones by the next. A string that
    is alone is done. Returns the places that stay together to the last token,
    and the number of their run, ascending."""
    run = np.zeros(len(at), np.int64)
    for p in places:
        key = token[at + p]
        order = np.lexsort((key, run)) if run.any() else np.argsort(key, kind="quicksort")
        at, run, key = at[order], run[order], key[order]
        start = runs([run, key])
        size = np.diff(start)
        keep = np.repeat(size > 1, size)
        run = np.repeat(np.arange(len(size)), size)[keep]
        at = at[keep]
        if not len(at):
            break
    return at, run


_FOUND = "edge boolean, h1 long, h2 long, doc long, mark long, start long, size long"


def _sorted_buckets(suffixes: DataFrame, length: int) -> DataFrame:
    """Repeats inside each bucket, as intervals; and, hashed, the windows of
    leading bytes that are cut by document (``edge``), which may go on next door."""
    places = [*range(0, length - 8, 8), length - 8]

    def rows(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held).combine_chunks()
        del held
        data, off = blobs(t.column("bytes"))
        col = {c: t.column(c).combine_chunks().to_numpy() for c in ("doc", "mark", "start")}
        n = np.diff(off) - length + 1
        row = np.repeat(np.arange(t.num_rows), n)
        at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + off[row]
        token = big_endian(data)
        got, run = multikey_sort(token, at, places)
        owner = np.searchsorted(off, got, side="right") - 1
        key = [col["doc"][owner], col["mark"][owner], col["start"][owner] + got - off[owner]]
        order = np.lexsort((key[2], key[1], key[0], run))
        got, run, key = got[order], run[order], [k[order] for k in key]
        head = np.repeat(runs([run])[:-1], np.diff(runs([run])))
        repeat = np.zeros(len(got), bool)
        for k in key:
            repeat |= k != k[head]
        again = np.zeros(len(data) + 1, bool)
        again[got[repeat]] = True
        marked = again[at]
        # neighbouring repeats of a stretch are one interval
        joins = marked[1:] & marked[:-1] & (row[1:] == row[:-1])
        first = np.flatnonzero(marked & ~np.concatenate(([False], joins)))
        last = np.flatnonzero(marked & ~np.concatenate((joins, [False])))
        own = row[first]
        zero = np.zeros(len(first), np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.zeros(len(first), bool)), pa.array(zero), pa.array(zero), pa.array(col["doc"][own]),
             pa.array(col["mark"][own]), pa.array(col["start"][own] + at[first] - off[own]),
             pa.array(last - first + length)], names=[c.split()[0] for c in _FOUND.split(", ")])
        edge = t.column("slice").combine_chunks().is_valid().to_numpy(zero_copy_only=False)
        w = np.flatnonzero(edge[row] & ~marked)
        for lo in range(0, len(w), 1 << 18):
            x, own = at[w[lo: lo + (1 << 18)]], row[w[lo: lo + (1 << 18)]]
            h = [np.full(len(x), s, np.uint64) for s in (1, 2)]
            for p in places:
                h = [mix(v * _U(_BASE) + token[x + p] + _U(k)) for k, v in enumerate(h)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ones(len(x), bool)), *(pa.array(v.view(np.int64)) for v in h), pa.array(col["doc"][own]),
                 pa.array(col["mark"][own]), pa.array(col["start"][own] + x - off[own]),
                 pa.array(np.full(len(x), length))], names=[c.split()[0] for c in _FOUND.split(", ")])

    return suffixes.mapInArrow(tidy(rows), _FOUND)


def _intervals(parts: DataFrame) -> DataFrame:
    """Intervals of each document, joined where they touch."""

    def rows(batches):
        for t in whole_groups(batches, ["doc", "mark"], min_rows=1 << 15):
            doc, mark, start, size = (t.column(c).combine_chunks().to_numpy() for c in ("doc", "mark", "start", "size"))
            group = runs([doc, mark])
            number = np.repeat(np.arange(len(group) - 1), np.diff(group))
            # ends ascend over all rows when each document is moved past the one before it
            step = int((start + size).max()) + 1
            reach = np.maximum.accumulate(start + size + number * step)
            new = np.flatnonzero(np.concatenate(([True], (start + number * step)[1:] > reach[:-1])))
            end = reach[np.append(new[1:], len(start)) - 1] - number[new] * step
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (doc[new], mark[new], start[new], end)],
                                             names=["doc", "mark", "start", "end"])

    dealt = parts.select("doc", "mark", "start", "size").repartition("doc", "mark").sortWithinPartitions("doc", "mark", "start")
    return dealt.mapInArrow(tidy(rows), "doc long, mark long, start long, end long")


def _cut(docs: DataFrame) -> DataFrame:
    """What is left of each text."""

    def rows(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                data, off = blobs(part.column("text"))
                out = []
                for i, got in enumerate(part.column("removed").to_pylist()):
                    own = data[off[i]: off[i + 1]]
                    spans = sorted((r["start"], r["end"]) for r in got or [])
                    kept = own
                    if spans:
                        keep = np.ones(len(own), bool)
                        for s, e in spans:
                            keep[s:e] = False
                        kept = own[keep]
                    out.append((len(own), len(own) - len(kept), len(spans), hashlib.sha256(kept.tobytes()).hexdigest()))
                n, removed, spans, sha = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c, pa.int64()) for c in (n, removed, spans)), pa.array(sha),
                     part.column("removed")], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])

    return docs.mapInArrow(tidy(rows), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string,"
                           " removed array<struct<start:long,end:long>>")


def repeated_spans(texts: DataFrame, length: int) -> DataFrame:
    """Maximal intervals (doc, mark, start, end) to remove from
    ``texts(doc, mark, text)``."""
    hot = _hot(texts, length)
    screened = saved(_screened(_screen_rows(texts, length, hot), length), "suffix_screened")
    open_ = screened.filter("open").groupBy("doc", "mark").agg(
        F.collect_list(F.struct("start", "size", "anchor", "lead")).alias("open"))
    suffixes = saved(_suffixes(texts.join(open_.hint("merge"), ["doc", "mark"]), length), "suffix_rows")
    buckets = suffixes.count() // BUCKET_ROWS + 1
    group = ["t0", "t1", "t2", "lead"]
    large = saved(suffixes.groupBy("lead").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > BUCKET_ROWS)
                  .select("lead", F.lit(True).alias("large")), "suffix_large")  # one to a bucket at most
    cut = suffixes.join(F.broadcast(large), "lead", "left").withColumn("slice", F.when(F.col("large"), F.xxhash64("doc", "mark")))
    dealt = cut.drop("large").repartitionByRange(buckets, *group, "slice", F.when(F.col("slice").isNotNull(), F.col("start")))
    found = saved(_sorted_buckets(dealt, length), "suffix_found")
    across = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("doc", "mark", "start"))
    next_door = found.filter("edge").dropDuplicates(["h1", "h2", "doc", "mark", "start"]) \
        .withColumn("nth", across).filter("nth > 1")
    parts = screened.filter("not open").select("doc", "mark", "start", "size")
    for more in (found.filter("not edge"), next_door):
        parts = parts.unionByName(more.select("doc", "mark", "start", "size"))
    return _intervals(parts)


def suffix_dedup(docs: DataFrame, length: int = 100) -> DataFrame:
    """Remove from ``docs(doc_id, text)`` every byte (UTF-8) covered by a string
    of ``length`` bytes that also starts earlier: in a document with a smaller
    doc_id, or further ahead in the same one. Strings are judged on the input
    and never cross documents.

    Returns per row of ``docs``: ``doc_id``, ``n_bytes``, ``n_removed``,
    ``n_spans`` (maximal removed runs), ``kept_sha256`` (of the bytes left, as
    lower-case hex) and ``removed`` (the runs, start and end; null if none).

    Null and empty texts have no bytes. Rows without doc_id come after all
    others. Rows that share a doc_id but not the text are ordered by a hash of
    the text; rows that repeat both are one document and get the same result.
    Other columns are ignored. An empty table gives an empty result. ``length``
    is at least 32 and at most 16,000.
    """
    if not LEAD + 8 <= length <= 16_000:
        raise ValueError("length must be between 32 and 16,000")
    arrow_conf(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("doc"),
                        F.xxhash64(text).alias("mark"), text.alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    spans = repeated_spans(texts.select("doc", "mark", "text"), length)
    removed = saved(spans.groupBy("doc", "mark").agg(F.collect_list(F.struct("start", "end")).alias("removed")),
                    "suffix_removed")
    return _cut(texts.join(join_side(removed, BROADCAST_BYTES), ["doc", "mark"], "left").select("doc_id", "text", "removed"))
