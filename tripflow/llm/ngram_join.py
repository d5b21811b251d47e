"""N-gram Jaccard join by chosen paths, and near-duplicate classes from it.

Each document is the set of its distinct five-word shingles. Equal sets are
one class representative. A run of the join starts at a root seed; at each
node a set picks every token whose seeded hash falls below
``1 / (threshold * size)``, and each picked token is a child node. Two sets
with Jaccard ``threshold`` or more share at least one child on average. A node
shared by few sets is a bucket for brute force; a node shared by more is split
again by its children, up to ``depth`` levels. Runs with fresh seeds repeat
until a pair at the threshold is met with probability ``recall``.

Brute force in a bucket compares 128-bin one-permutation sketches with a
margin of four standard deviations; what passes is joined to coarse clusters,
and inside each cluster *every* pair of sets is compared exactly. A bucket or
cluster that is too large for one task is dealt as pairs of blocks, so no
group is ever gathered whole and nothing is capped. Joins whose sides both grow
with the corpus are merge joins at every size; AQE splits their hot keys.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.operators.bloom import blocks_for, bloom_filter, filter_bytes, may_hold
from tripflow.operators.joins import join_side

from ._pairs import blobs, group_pairs, merge_labels, runs, whole_groups
from ._tables import arrow_conf, collected, discard, saved
from ._words import mix, seeds, shingle_sets, slices, tidy
from .components import components

_U = np.uint64
BINS = 128          # bins of a sketch
MARGIN = 0.15       # a sketch estimate this far below the threshold still passes
SMALL_BUCKET = 2048  # sets that one node may hold before it is split
BLOCK = 1024        # sets of one block of a bucket or cluster that stays large
BLOCK_SHINGLES = 2_000_000  # shingles of one block
BROADCAST_BYTES = 16 << 20  # largest table of large nodes, as written, that is sent whole
FILTER_BYTES = 64 << 20  # largest filter of clustered documents (67 million); beyond it all texts are shuffled


def runs_for(recall: float, depth: int) -> int:
    """Runs after which a pair at the threshold has met with probability
    ``recall``, if it had to be split down to the last level every time
    (children shared: Poisson with mean 1, a lower bound)."""
    q = 1.0
    for _ in range(depth):
        q = 1 - math.exp(-q)
    return math.ceil(math.log(1 - recall) / math.log(1 - q))


def paths_of(s: np.ndarray, run_seeds: np.ndarray, threshold: float, depth: int):
    """Node ids of one set: per level the ids and the ids of their parents."""
    rate = min(1.0, 1.0 / (threshold * max(len(s), 1)))
    cut = _U(min(int(rate * 2**64), 2**64 - 1))
    levels = []
    nodes = run_seeds
    for _ in range(depth):
        ids, parents = [], []
        for seed in nodes:
            picked = s[(s ^ seed) * (seed | _U(1)) <= cut]
            if len(picked):
                ids.append(mix(picked + seed))
                parents.append(np.full(len(picked), seed))
        nodes = np.concatenate(ids) if ids else np.zeros(0, np.uint64)
        levels.append((nodes, np.concatenate(parents) if parents else nodes))
    return levels


def sketch_of(s: np.ndarray) -> bytes:
    """One byte of the least hash in each of the bins; 0 marks an empty bin."""
    out = np.zeros(BINS, np.uint8)
    if len(s):
        h = mix(s ^ _U(0x9E3779B97F4A7C15))
        bin_ = (h >> _U(57)).astype(np.intp)
        low = np.full(BINS, np.iinfo(np.uint64).max, np.uint64)
        np.minimum.at(low, bin_, h)
        full = np.zeros(BINS, bool)
        full[bin_] = True
        out[full] = (mix(low[full]) % _U(255)).astype(np.uint8) + 1
    return out.tobytes()


def signature(s: np.ndarray) -> tuple[int, int, int]:
    """Size of a set and two 64-bit sums over it; equal sets have equal
    signatures, different sets the same one with probability 2**-128."""
    total = [np.array(v.sum(dtype=np.uint64)).view(np.int64).item() for v in (s, mix(s))]
    return len(s), total[0], total[1]


def _sets_table(docs: DataFrame, n: int, threshold: float, recall: float, depth: int) -> DataFrame:
    """Size, signature, sketch and nodes of each row's shingle set, beside the
    row's columns other than its text."""
    run_seeds = seeds(runs_for(recall, depth), 77)
    level_cols = [f"k{i}" for i in range(1, depth + 1)] + [f"p{i}" for i in range(1, depth + 1)]
    kept = [c for c in docs.columns if c != "text"]
    names = [*kept, "size", "sig1", "sig2", "sketch", *level_cols]
    schema = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in kept) \
        + ", size long, sig1 long, sig2 long, sketch binary, " + ", ".join(f"{c} array<long>" for c in level_cols)

    def rows(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                cols = {c: [] for c in names[len(kept):]}
                for s in shingle_sets(part.column("text"), n):
                    size, sig1, sig2 = signature(s)
                    cols["size"].append(size)
                    cols["sig1"].append(sig1)
                    cols["sig2"].append(sig2)
                    cols["sketch"].append(sketch_of(s))
                    for i, (ids, parents) in enumerate(paths_of(s, run_seeds, threshold, depth), 1):
                        cols[f"k{i}"].append(ids.view(np.int64))
                        cols[f"p{i}"].append(parents.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [*map(part.column, kept), *(pa.array(cols[c], pa.int64()) for c in ("size", "sig1", "sig2")),
                     pa.array(cols["sketch"], pa.binary()),
                     *(pa.array(cols[c], pa.list_(pa.int64())) for c in level_cols)], names=names)

    return docs.mapInArrow(tidy(rows), schema).withColumn("row", F.monotonically_increasing_id())


def _dealt(rows: DataFrame, group: str, node: str, *carried: str) -> DataFrame:
    """Deal each group to cells of at most two blocks: a group of ``blocks``
    blocks has a cell for every pair of them, so every pair of its rows meets
    in one task. ``side`` tells in which of a cell's two blocks a row is. The
    rows come out partitioned and sorted by cell."""
    blk = rows.withColumn("blk", F.expr(f"pmod(xxhash64({node}), blocks)").cast("int"))
    blk = blk.withColumn("other", F.explode(F.expr("sequence(0, cast(blocks as int) - 1)")))
    cells = blk.select(
        group, F.least("blk", "other").alias("ci"), F.greatest("blk", "other").alias("cj"),
        F.when(F.col("blk") <= F.col("other"), 0).otherwise(1).cast("int").alias("side"), node, *carried)
    return cells.repartition(group, "ci", "cj").sortWithinPartitions(group, "ci", "cj")


def _sketch_edges(cells: DataFrame, floor: float) -> DataFrame:
    """Least sketch-linked member of each member's part of its cell."""

    def rows(batches):
        for t in whole_groups(batches, ["path", "ci", "cj"]):
            keys = [t.column(c).combine_chunks().to_numpy() for c in ("path", "ci", "cj")]
            sk = blobs(t.column("sketch"))[0].reshape(-1, BINS)
            rep = t.column("rep").combine_chunks().to_numpy()
            label = np.arange(len(rep))
            for a, b in group_pairs(runs(keys)):
                new = label[a] != label[b]  # already linked pairs need no look
                a, b = a[new], b[new]
                for lo in range(0, len(a), 1 << 15):
                    x, y = sk[a[lo: lo + (1 << 15)]], sk[b[lo: lo + (1 << 15)]]
                    same = ((x == y) & (x != 0)).sum(1)
                    either = ((x != 0) | (y != 0)).sum(1)
                    hit = same >= floor * either
                    label = merge_labels(label, a[lo: lo + (1 << 15)][hit], b[lo: lo + (1 << 15)][hit])
            far = np.flatnonzero(label != np.arange(len(rep)))
            yield pa.RecordBatch.from_arrays([pa.array(rep[far]), pa.array(rep[label[far]])], names=["a", "b"])

    return cells.mapInArrow(tidy(rows), "a long, b long")


def shared_counts(tokens: np.ndarray, owner: np.ndarray, m: int, width: int = 4096) -> np.ndarray:
    """Matrix of the number of tokens that each two of ``m`` sets share."""
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    start = runs([tokens])
    many = np.repeat(np.diff(start) > 1, np.diff(start)) if len(tokens) else np.zeros(0, bool)
    tokens, owner = tokens[many], owner[many]
    out = np.zeros((m, m), np.float32)
    if not len(tokens):
        return out
    new = np.concatenate(([False], tokens[1:] != tokens[:-1]))
    col = np.cumsum(new)
    for lo in range(0, int(col[-1]) + 1, width):
        i, j = np.searchsorted(col, [lo, lo + width])
        x = np.zeros((m, min(width, int(col[-1]) + 1 - lo)), np.float32)
        x[owner[i:j], col[i:j] - lo] = 1
        out += x @ x.T
    return out


def _token_sets(texts: DataFrame, n: int) -> DataFrame:
    """Shingle sets, as packed 64-bit values, of the texts whose signature is
    the one wanted (a repeated doc_id may come with another text)."""
    schema = "cluster long, rep long, copies long, blocks long, tokens binary"

    def rows(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                want = list(zip(*(part.column(c).to_pylist() for c in ("size", "sig1", "sig2")), strict=True))
                s = shingle_sets(part.column("text"), n)
                ok = pa.array([signature(x) == w for x, w in zip(s, want, strict=True)], pa.bool_())
                out = pa.RecordBatch.from_arrays(
                    [part.column(c) for c in ("cluster", "rep", "copies", "blocks")]
                    + [pa.array([x.tobytes() for x in s], pa.binary())],
                    names=["cluster", "rep", "copies", "blocks", "tokens"])
                yield out.filter(ok)

    return texts.mapInArrow(tidy(rows), schema)


def _verified(cells: DataFrame, threshold: float) -> DataFrame:
    """Exact links of each set in each cell: the documents it is linked to and
    the least set of its linked part."""

    def rows(batches):
        for t in whole_groups(batches, ["cluster", "ci", "cj"], min_rows=64):
            keys = [t.column(c).combine_chunks().to_numpy() for c in ("cluster", "ci", "cj")]
            start = runs(keys)
            data, off = blobs(t.column("tokens"))
            rep_all, copies_all, side_all = (
                t.column(c).combine_chunks().to_numpy() for c in ("rep", "copies", "side"))
            found = []
            for lo, hi in zip(start[:-1], start[1:], strict=True):
                own = lo + np.unique(rep_all[lo:hi], return_index=True)[1]  # a repeated row counts once
                m = len(own)
                if m < 2:
                    continue
                rep, copies, side = rep_all[own], copies_all[own], side_all[own]
                sets = [np.frombuffer(data[off[i]: off[i + 1]].tobytes(), np.uint64) for i in own]
                size = np.array([len(x) for x in sets])
                both = shared_counts(np.concatenate(sets), np.repeat(np.arange(m), size), m)
                union = size[:, None] + size[None, :] - both
                hit = (both > 0) & (both >= threshold * union - 1e-6)
                np.fill_diagonal(hit, False)
                if keys[1][lo] != keys[2][lo]:  # pairs inside one block are counted in its own cell
                    hit &= side[:, None] != side[None, :]
                label = merge_labels(np.arange(m), *np.nonzero(np.triu(hit)))
                found.append((rep, hit @ copies, rep[label]))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*found, strict=True)],
                    names=["rep", "links", "root"])

    return cells.mapInArrow(tidy(rows), "rep long, links long, root long")


def _linked(slim: DataFrame, key: list[str], merged: bool, n: int, threshold: float, recall: float,
            depth: int) -> DataFrame:
    """Per document its node id, set size, representative, component, links and
    copies. ``key`` identifies a row of ``slim``; where ``merged``, rows that
    repeat the key are one document and the key is its node id, else every row
    is one and is numbered."""
    spark = slim.sparkSession
    sig = ["size", "sig1", "sig2"]
    other = [c for c in slim.columns if c not in (*key, "text")]
    with collected() as made:
        sets = saved(_sets_table(slim, n, threshold, recall, depth), "ngram_sets")
        if merged:
            one = sets.groupBy(*key).agg(F.min(F.struct(*sig, "row")).alias("s")).select(*key, F.col(key[0]).alias("node"), "s.*")
        else:
            one = sets.select(*key, *other, F.col("row").alias("node"), *sig, "row")
        one = saved(one, "ngram_docs")
        reps = one.filter("size > 0").groupBy(*sig).agg(
            F.min(F.struct("node", "row", *key)).alias("r"), F.count(F.lit(1)).alias("copies"))
        reps = saved(reps.select(F.col("r.node").alias("rep"), F.col("r.row").alias("row"),
                                 *(F.col(f"r.{k}").alias(k) for k in key), "copies", *sig), "ngram_reps")
        first = saved(sets.drop(*key, *other, *sig).join(reps.select("row", "rep").hint("merge"), "row"), "ngram_first")
        discard(spark, made, one, reps, first)

        # level by level: a node of 2 to SMALL_BUCKET sets is a bucket, a larger one is split
        leaves, big = None, None
        for level in range(1, depth + 1):
            rows = first.select("rep", F.explode(F.arrays_zip(f"k{level}", f"p{level}")).alias("e")) \
                .select("rep", F.col(f"e.k{level}").alias("path"), F.col(f"e.p{level}").alias("parent"))
            if big is not None:
                rows = rows.join(join_side(big.select(F.col("path").alias("parent")), BROADCAST_BYTES), "parent", "left_semi")
            rows = rows.select("rep", "path")
            sizes = saved(rows.groupBy("path").agg(F.count(F.lit(1)).alias("members")).filter("members > 1"),
                          "ngram_nodes")
            # written, so that its size is known and a few large nodes make no shuffle of all paths
            big = saved(sizes.filter(F.col("members") > SMALL_BUCKET), "ngram_large_nodes")
            done = sizes if level == depth else sizes.filter(F.col("members") <= SMALL_BUCKET)
            part = rows.join(done.hint("merge"), "path")
            leaves = part if leaves is None else leaves.unionByName(part)
            if big.isEmpty():
                break
        leaves = leaves.withColumn("blocks", F.ceil(F.col("members") / BLOCK)) \
            .join(first.select("rep", "sketch").hint("merge"), "rep")
        coarse = components(_sketch_edges(_dealt(leaves, "path", "rep", "sketch"), threshold - MARGIN))

        # inside each coarse cluster every pair of sets is compared exactly
        members = saved(coarse.select(F.col("node").alias("rep"), F.col("component").alias("cluster"))
                        .join(reps, "rep"), "ngram_members")
        discard(spark, made, one, reps, members)
        blocks = members.groupBy("cluster").agg(
            F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("size") / BLOCK_SHINGLES)).alias("blocks"))
        wanted = members.join(blocks, "cluster").select(*key, "rep", "cluster", "copies", "blocks", *sig)
        # texts of documents outside the clusters stay where they are
        count, near = members.count(), slim
        if filter_bytes(count) <= FILTER_BYTES:
            near = may_hold(slim, key, bloom_filter(members, key, blocks_for(count)), blocks_for(count))
        tokens = _token_sets(near.join(wanted.hint("merge"), key), n)
        linked = saved(_verified(_dealt(tokens, "cluster", "rep", "copies", "tokens"), threshold), "ngram_links")
        parts = components(linked.filter("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
        found = reps.join(linked.groupBy("rep").agg(F.sum("links").alias("links")), "rep", "left") \
            .join(parts.select(F.col("node").alias("rep"), "component"), "rep", "left")
        found = saved(found.select(*sig, "rep", "component", "links", "copies"), "ngram_found")
        discard(spark, made, one, found)
    return one.join(found, sig, "left").select(
        *key, *other, F.coalesce("component", "rep", "node").alias("class_id"), F.coalesce("rep", "node").alias("rep_id"),
        F.col("size").alias("n_shingles"),
        (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).cast("long").alias("n_links"))


def ngram_join(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.999,
               depth: int = 3) -> DataFrame:
    """Near-duplicate links of ``docs(doc_id long, text string, ...)``.

    Returns one row per row of ``docs`` with a doc_id: ``doc_id``,
    ``class_id`` (the least doc_id that it is linked to, directly or through
    others; its own if none), ``rep_id`` (the least doc_id with the same
    shingle set), ``n_shingles`` and ``n_links`` (the other documents whose
    Jaccard with it is at least ``threshold``).

    Rows without doc_id are left out; rows that repeat a doc_id are one
    document (of several texts the one with the least set signature counts).
    Null, empty and white-space texts have no shingle and link to nothing; a
    text of fewer than ``n`` words is one shingle of all its words. Other
    columns are ignored. An empty table gives an empty result.
    """
    arrow_conf(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")) \
        .filter("doc_id is not null")
    return _linked(slim, ["doc_id"], True, n, threshold, recall, depth)


def joined_rows(docs: DataFrame, key: list[str], n: int = 5, threshold: float = 0.8, recall: float = 0.999,
                depth: int = 3) -> DataFrame:
    """:func:`ngram_join` of rows that ``key`` (columns without nulls) tells
    apart, each judged by its own text whatever its doc_id. Returns the columns
    other than ``text``, and class and links as above; classes and
    representatives are numbers of rows, made up for the run."""
    arrow_conf(docs.sparkSession)
    return _linked(docs, key, False, n, threshold, recall, depth)
