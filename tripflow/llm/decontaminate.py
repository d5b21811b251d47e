"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are short, documents long, so the Jaccard similarity of an item and
a whole document says little. Items are partitioned by size (number of
shingles, in powers of two); for the class with at most ``c`` shingles every
document is covered by windows of ``2c`` consecutive shingles, ``c`` apart.
An occurrence of an item lies in one window, and containment ``t`` means
Jaccard at least ``t / (2c / q + 1 - t)`` there, which fixes the number of
MinHash values that are needed for the recall. A window whose i-th MinHash
value equals an item's i-th value makes its document a candidate for the item;
the candidate is then verified by exact containment of the item's shingles in
the whole document.

All documents are scanned once per block of items. A block is bounded by
``BLOCK_ITEMS`` items and ``BLOCK_SHINGLES`` shingles, so what is broadcast
does not grow with the data; more items make more blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._tables import arrow_conf, saved
from ._words import ngram_hashes, seeds, shingle_sets, slices, word_hashes, tidy

_U = np.uint64
BLOCK_ITEMS = 20_000
BLOCK_SHINGLES = 2_000_000


def values_for(threshold: float, recall: float) -> int:
    """MinHash values for the recall at the least Jaccard of an item and its
    window: an item just over half its class, in a window of 2c shingles."""
    least = threshold / (4 + 1 - threshold)
    return math.ceil(math.log(1 - recall) / math.log(1 - least))


def size_class(n: int) -> int:
    """Least power of two that is no less than ``n``, so that every item is
    over half its class."""
    return 1 << (n - 1).bit_length()


def _index(items: list[tuple[int, np.ndarray, int]], family: np.ndarray) -> dict:
    """Per size class and MinHash function: sorted (value, item number)."""
    by_class: dict[int, list[int]] = {}
    for no, (_, s, short) in enumerate(items):
        if len(s) and not short:
            by_class.setdefault(size_class(len(s)), []).append(no)
    out = {}
    for c, nos in sorted(by_class.items()):
        tables = []
        for f in family:
            low = np.array([(items[no][1] * f).min() for no in nos])
            order = np.argsort(low, kind="stable")
            tables.append((low[order], np.array(nos)[order]))
        out[c] = tables
    return out


def _candidates(grams: np.ndarray, goff: np.ndarray, index: dict, family: np.ndarray) -> np.ndarray:
    """Distinct (document, item) candidates of one piece of documents."""
    found = []
    full = np.flatnonzero(np.diff(goff) > 0)
    if not len(full) or not len(grams):
        return np.zeros((0, 2), np.int64)
    doc_of_gram_start, length = goff[full], np.diff(goff)[full]
    layout = {}
    for c in index:
        n = -(-length // c)  # blocks of each document
        start = np.repeat(doc_of_gram_start, n) + c * (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        layout[c] = (start, np.repeat(full, n))
    for i, f in enumerate(family):
        v = grams * f
        for c, tables in index.items():
            start, doc = layout[c]
            low = np.minimum.reduceat(v, start)
            # a window is a block and the next one of the same document
            pair = low.copy()
            same = doc[1:] == doc[:-1]
            pair[:-1][same] = np.minimum(low[:-1], low[1:])[same]
            values, nos = tables[i]
            at = np.searchsorted(values, pair)
            hit = np.flatnonzero(values[np.minimum(at, len(values) - 1)] == pair)
            if len(hit):
                last = np.searchsorted(values, pair[hit], side="right")
                n = last - at[hit]
                which = np.repeat(at[hit], n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
                found.append(np.stack((np.repeat(doc[hit], n), nos[which]), 1))
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)


def _short_index(items: list[tuple[int, np.ndarray, int]]) -> dict:
    """Per number of words of the items shorter than a shingle: sorted (hash
    of all the words, item number)."""
    by_words: dict[int, list[int]] = {}
    for no, (_, _, short) in enumerate(items):
        if short:
            by_words.setdefault(short, []).append(no)
    out = {}
    for m, nos in by_words.items():
        keys = np.array([items[no][1][0] for no in nos])
        order = np.argsort(keys, kind="stable")
        out[m] = keys[order], np.array(nos)[order]
    return out


def _short_hits(h: np.ndarray, off: np.ndarray, index: dict) -> list[tuple[int, int]]:
    """(document, item) pairs where all words of a short item stand in a row."""
    found = set()
    for m, (keys, nos) in index.items():
        grams, goff = ngram_hashes(h, off, m)
        hit = np.flatnonzero(np.isin(grams, keys))
        for d, g in zip(np.searchsorted(goff, hit, side="right") - 1, grams[hit], strict=True):
            lo, hi = np.searchsorted(keys, g), np.searchsorted(keys, g, side="right")
            found.update((int(d), int(no)) for no in nos[lo:hi])
    return sorted(found)


def _scan(docs: DataFrame, items: list[tuple[int, np.ndarray, int]], n: int, threshold: float, recall: float) -> DataFrame:
    key = [c for c in docs.columns if c != "text"]
    family = seeds(values_for(threshold, recall), 4242)
    known = docs.sparkSession.sparkContext.broadcast((items, _index(items, family), _short_index(items)))

    def rows(batches):
        items, index, short = known.value
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                h, off = word_hashes(part.column("text"))
                grams, goff = ngram_hashes(h, off, n)
                pairs = _candidates(grams, goff, index, family)
                out = [(d, items[no][0], 1, 1) for d, no in _short_hits(h, off, short)]
                for d in np.unique(pairs[:, 0]):
                    s = np.unique(grams[goff[d]: goff[d + 1]])
                    for no in pairs[pairs[:, 0] == d, 1]:
                        item_id, own, _ = items[no]
                        got = int(np.isin(own, s, assume_unique=True).sum())
                        if got >= threshold * len(own) - 1e-9:
                            out.append((int(d), item_id, got, len(own)))
                cols = list(zip(*out, strict=True)) if out else [[], [], [], []]
                at = pa.array(cols[0], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c).take(at) for c in key), *(pa.array(c, pa.int64()) for c in cols[1:])],
                    names=[*key, "item_id", "shared", "item_shingles"])

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in key)
    return docs.mapInArrow(tidy(rows), f"{kinds}, item_id long, shared long, item_shingles long")


def _item_blocks(items: DataFrame, n: int, short_items: bool):
    """Items with their shingle sets (and, of those shorter than a shingle, the
    number of words), in bounded blocks, by item_id."""

    least = 1 if short_items else n

    def rows(batches):
        for batch in batches:
            sets = shingle_sets(batch.column("text"), n)
            few = [len(s) for s in sets]
            words = np.diff(word_hashes(batch.column("text"))[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"),
                 pa.array([s.tobytes() if w >= least else b"" for s, w in zip(sets, words, strict=True)], pa.binary()),
                 pa.array([int(f) if w >= least else 0 for f, w in zip(few, words, strict=True)], pa.int64()),
                 pa.array([int(w) if w < n else 0 for w in words], pa.int64())],
                names=["item_id", "tokens", "size", "short"])

    sets = items.mapInArrow(tidy(rows), "item_id long, tokens binary, size long, short long").filter("size > 0")
    block, held = [], 0
    for r in sets.orderBy("item_id", "tokens").toLocalIterator():
        block.append((r["item_id"], np.frombuffer(bytes(r["tokens"]), np.uint64), r["short"]))
        held += r["size"]
        if len(block) >= BLOCK_ITEMS or held >= BLOCK_SHINGLES:
            yield block
            block, held = [], 0
    if block:
        yield block


def contaminated(docs: DataFrame, items: DataFrame, n: int = 5, threshold: float = 0.8,
                 recall: float = 0.9999, short_items: bool = False, key: list[str] | None = None) -> DataFrame:
    """Test items of ``items(item_id, text)`` found in ``docs(doc_id, text)``.

    Returns one row per (``doc_id``, ``item_id``) whose containment, the share
    of the item's distinct ``n``-word shingles that occur in the document, is
    at least ``threshold``, with ``shared``, ``item_shingles`` and
    ``containment``. The whole text of every document is searched. ``key``
    names other columns that identify a row, each judged by its own text; they
    take the place of doc_id in the result.

    Rows without an id are left out; null and empty texts, and items of fewer
    than ``n`` words, have no shingle and match nothing; with ``short_items``
    an item of 1 to ``n - 1`` words is one shingle of all its words, found
    wherever they stand in a row. Repeated rows of a document or an item give
    one row. Other columns are ignored. An empty table on either side gives an
    empty result.
    """
    spark = docs.sparkSession
    arrow_conf(spark)
    ids = [F.col(k) for k in key] if key else [F.col("doc_id").cast("long").alias("doc_id")]
    key = key or ["doc_id"]
    slim = docs.select(*ids, F.col("text").alias("text")).dropna(subset=[*key, "text"])
    tests = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text")) \
        .filter("item_id is not null and text is not null")
    out = None
    for block in _item_blocks(tests, n, short_items):
        part = saved(_scan(slim, block, n, threshold, recall), "leaks")
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = slim.drop("text").limit(0).select("*", *(F.lit(0).cast("long").alias(c) for c in (
            "item_id", "shared", "item_shingles")))
    out = out.groupBy(*key, "item_id").agg(F.max(F.struct(
        (F.col("shared") / F.col("item_shingles")).alias("containment"), "shared", "item_shingles")).alias("m"))
    return out.select(*key, "item_id", "m.shared", "m.item_shingles",
                      F.round("m.containment", 6).alias("containment"))
