"""Merkle manifest of a dataset: nested structs rolled up by rank digits.

Every row is a leaf. The leaves of a group are ranked in key order without
bringing a group into one task: rows are range-partitioned, ranked inside their
partition, and a table of counts per partition gives each partition its start.
The binary digits of the rank are then columns to group by: a block holds
``2**BITS`` neighbouring nodes and is dealt to a task once; its lowest digit is
grouped away first, children becoming an array of structs in their parent, then
the next digit, until one nested struct per block is left. Blocks' hashes are
the nodes of the next round, so a group of any size takes ``log(n) / BITS``
rounds and no row ever holds more than a block. Going back down, each block
meets the path above it as rows of one grouping; a transform over the nested
struct writes every node's path and an explode gives the nodes back. No leaf is
joined to anything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._tables import saved

#: Rank digits (binary) that are grouped away inside one block: each is one more
#: aggregation, with buffers of its own, in the same task.
BITS = 4
#: Rows of a partition while ranks are given.
RANK_ROWS = 200_000
_STEP = "array<struct<side:int,hash:string>>"


def digest(*inputs: Column) -> Column:
    """Lower-case hex SHA-256 of the inputs, concatenated."""
    return F.sha2(F.concat(*inputs), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``rank`` (from 0, in ``order`` within ``group``) and ``n``
    (rows of the group). ``group`` must not be null."""
    parts = rows.count() // RANK_ROWS + 1
    dealt = rows.repartitionByRange(parts, group, *order).sortWithinPartitions(group, *order)
    dealt = saved(dealt.withColumn("part", F.spark_partition_id()), "merkle_sorted")
    counts = dealt.groupBy(group, "part").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(group, "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"),
                           F.sum("rows").over(Window.partitionBy(group)).alias("n"))
    inside = F.row_number().over(Window.partitionBy(group, "part").orderBy(*order)) - 1
    return dealt.withColumn("inside", inside).join(starts, [group, "part"]) \
        .withColumn("rank", F.col("start") + F.col("inside")).drop("part", "start", "inside")


def _nodes_left(level: int) -> Column:
    """Nodes of the group ``level`` levels above the round's lowest one."""
    return F.shiftright(F.col("n") + F.lit((1 << level) - 1), level)


def rolled_up(nodes: DataFrame, bits: int = BITS) -> DataFrame:
    """One row per block of ``nodes(group, n, rank, node struct<hash, ...>)``:
    ``group``, ``n``, ``block`` and ``node``, whose ``kids`` nest down to the
    round's nodes. A group that is down to one node is not hashed further."""
    cur = nodes.select("group", "n", F.shiftright("rank", bits).alias("block"),
                       F.col("rank").bitwiseAND((1 << bits) - 1).alias("at"), "node").repartition("group", "block")
    for level in range(bits):
        kids = F.array_sort(F.collect_list(F.struct("at", "node"))).getField("node")
        cur = cur.groupBy("group", "n", "block", F.shiftright("at", 1).alias("at")).agg(kids.alias("kids"))
        hashes = F.col("kids").getField("hash")
        both = F.when(_nodes_left(level) > 1, F.sha2(F.array_join(hashes, ""), 256)).otherwise(hashes[0])
        cur = cur.select("group", "n", "block", "at", F.struct(both.alias("hash"), "kids").alias("node"))
    return cur.drop("at")


def _paths(node: Column, above: Column, bits: int) -> Column:
    """All nodes of a block's lowest level with their paths (lowest first)."""
    if not bits:
        return F.array(F.struct(node.alias("node"), above.alias("path")))
    kids, level = node.getField("kids"), bits - 1

    def one(kid: Column, i: Column) -> Column:
        other = F.when(F.size(kids) == 2, kids[1 - i].getField("hash"))
        side = F.when(other.isNull(), 0).when(i == 0, 1).otherwise(-1)  # where the sibling stands
        step = F.array(F.struct(side.cast("int").alias("side"), other.alias("hash")))
        step = F.when(_nodes_left(level) > 1, step).otherwise(F.array().cast(_STEP))
        return _paths(kid, F.concat(step, above), level)

    return F.flatten(F.transform(kids, one))


def tree(nodes: DataFrame, bits: int = BITS) -> tuple[DataFrame, list[DataFrame]]:
    """Roll ``nodes(group, n, rank, node)`` up to one row per group. Returns
    ``(group, root)`` and the rounds' block tables, lowest first."""
    rounds = []
    while True:
        blocks = saved(rolled_up(nodes, bits), "merkle_blocks")
        rounds.append(blocks)
        if (blocks.agg(F.max("block")).first()[0] or 0) == 0:
            return blocks.select("group", F.col("node.hash").alias("root")), rounds
        nodes = blocks.select(
            "group", F.shiftright(F.col("n") + F.lit((1 << bits) - 1), bits).alias("n"),
            F.col("block").alias("rank"), F.struct(F.col("node.hash").alias("hash")).alias("node"))


def with_paths(rounds: list[DataFrame], above: DataFrame, bits: int = BITS) -> DataFrame:
    """The lowest round's nodes as ``group``, ``node``, ``path``, ``carried``.
    ``above(group, path, carried)`` continues each group's path at its root."""
    tops = above.select("group", F.lit(0).cast("long").alias("block"), "path", "carried")
    for blocks in reversed(rounds):
        # a block and the path above it are two rows of one group
        nest = blocks.select("group", F.col("block").cast("long").alias("block"), "n", "node",
                             F.lit(None).cast(tops.schema["path"].dataType).alias("path"),
                             F.lit(None).cast(tops.schema["carried"].dataType).alias("carried"))
        met = nest.unionByName(tops, allowMissingColumns=True).groupBy("group", "block").agg(
            *(F.first(c, ignorenulls=True).alias(c) for c in ("n", "node", "path", "carried")))
        met = met.filter("node is not null")
        found = met.select("group", "block", "carried", F.posexplode(_paths(F.col("node"), F.col("path"), bits)))
        out = found.select("group", (F.shiftleft("block", bits) + F.col("pos")).alias("block"),
                           F.col("col.node").alias("node"), F.col("col.path").alias("path"), "carried")
        tops = out if blocks is rounds[0] else out.select("group", "block", "path", "carried")
    return tops.select("group", "node", "path", "carried")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf's hash and its path lead to."""

    def up(acc: Column, step: Column) -> Column:
        other = F.coalesce(step["hash"], F.lit(""))
        return digest(F.when(step["side"] < 0, F.concat(other, acc)).otherwise(F.concat(acc, other)))

    return F.aggregate(path, leaf, up)


def merkle_manifest(docs: DataFrame, columns: list[str], group: str, order: str,
                    claimed: dict[str, Column] | None = None, bits: int = BITS) -> DataFrame:
    """Merkle tree over the rows of ``docs`` with a proof for each.

    A row's leaf is the digest of its ``columns``, each as :func:`field`. The
    leaves of a ``group`` ascend by ``order`` (null first, equal keys by leaf);
    neighbours are paired up to one subroot, a last one without a neighbour is
    hashed alone, a lone leaf is the subroot. Subroots, null group first, then
    bytewise, give the root in the same way. ``claimed`` replaces columns by
    what a reader claims they hold; each row is then checked with its path.

    Returns per row ``order`` as it was, ``leaf``, ``subroot``, ``root``,
    ``proof_sha256`` (digest of the path's sibling hashes), ``proof`` (the
    path: ``side`` -1 / 1 / 0 for a sibling on the left, right or none, and its
    ``hash``), ``folded_root`` (what the claimed leaf and the path give) and
    ``verified`` (equals the root).

    Null columns hash as ``-``; null and empty texts differ. Rows that are
    repeated are leaves of their own. Columns not named are ignored, whatever
    their names. An empty table gives an empty result.
    """
    claimed = claimed or {}
    real = digest(*(field(F.col(c)) for c in columns))
    other = digest(*(field(claimed.get(c, F.col(c))) for c in columns))
    changed = F.lit(False)
    for c, new in claimed.items():
        changed = changed | ~new.eqNullSafe(F.col(c))
    slim = docs.select(F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("group"),
                       F.col(order).alias("id"), real.alias("leaf"), F.when(changed, other).alias("claim"))
    leaves = ranked(slim, "group", ["id", "leaf"])
    leaves = leaves.select("group", "n", "rank", F.struct(F.col("leaf").alias("hash"), "id", "claim").alias("node"))
    subroots, rounds = tree(leaves, bits)
    top = ranked(subroots.select(F.lit("").alias("all"), "group", "root"), "all", ["group"])
    top = top.select(F.lit("").alias("group"), "n", "rank",
                     F.struct(F.col("root").alias("hash"), F.col("group").alias("of")).alias("node"))
    root, top_rounds = tree(top, bits)
    start = root.select("group", F.array().cast(_STEP).alias("path"), F.col("root").alias("carried"))
    above = with_paths(top_rounds, start, bits).select(
        F.col("node.of").alias("group"), "path",
        F.struct(F.col("node.hash").alias("subroot"), F.col("carried").alias("root")).alias("carried"))
    found = with_paths(rounds, above, bits).select(
        F.col("node.id").alias(order), F.col("node.hash").alias("leaf"), "carried.subroot", "carried.root",
        F.sha2(F.array_join(F.col("path").getField("hash"), ""), 256).alias("proof_sha256"),
        F.col("path").alias("proof"),
        fold(F.coalesce("node.claim", "node.hash"), F.col("path")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
