"""Table maintenance expressed as DataFrame operations: keyed upsert (K8),
insert-if-absent (K9) and first-row-per-key deduplication.

These compute the *new contents* (or the rows to append); writing them
atomically is the job of :mod:`tripflow.sinks`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow import functions as tf
from tripflow.operators import bloom
from tripflow.operators.joins import DEFAULT_BROADCAST_BYTES, small_side


def _pack(cols: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in cols])


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest by ``order`` and then by every other
    column, so the choice does not depend on partitioning.

    ``min`` over a struct is combined inside each task before the shuffle, so a
    key with a huge share of the rows sends one row per task. Rows with a null
    key component are kept one per distinct row, as a relational unique key
    lets nulls repeat: they are grouped by their whole row, in the same single
    aggregation (one pass over the input).
    """
    key = list(key)
    rest = [c for c in df.columns if c not in key and c not in order]
    ranked = [*order, *rest]
    null_row = F.when(tf.any_null(key), _pack(df.columns)).alias("_null_key_row")
    return (
        df.groupBy(*key, null_row)
        .agg(F.min(_pack(ranked)).alias("_row"))
        .select(*key, *[F.col(f"_row.{c}").alias(c) for c in ranked])
        .select(*df.columns)
    )


def _candidates(loaded: DataFrame, target: DataFrame, key: Sequence[str], max_broadcast_bytes: int) -> DataFrame:
    """Keys of ``target``, without most of those that ``loaded`` lacks. The
    target is scanned and not shuffled: against the broadcast keys where they
    have at most ``max_broadcast_bytes`` bytes, else against a Bloom filter of
    them, where that has; a load beyond both leaves the target whole."""
    present = target.select(*key)
    if small_side(loaded, max_broadcast_bytes):
        return present.join(F.broadcast(loaded.distinct()), key, "left_semi")
    keys = loaded.count()
    if bloom.filter_bytes(keys) > max_broadcast_bytes:
        return present
    blocks = bloom.blocks_for(keys)
    return bloom.may_hold(present, key, bloom.bloom_filter(loaded, key, blocks), blocks)


def insert_if_absent(incoming: DataFrame, target: DataFrame, key: Sequence[str],
                     order: Sequence[str] = (), max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Rows of ``incoming`` to append so that ``key`` stays unique in
    ``target``: one row per new key, none for keys already present (K9,
    ``ON CONFLICT DO NOTHING``).

    The target (the whole table) is usually far larger than a load. Its key
    column is scanned, not shuffled, and only keys that the load may have
    (:func:`_candidates`) meet the load in the final anti join.

    The key is a primary key, so rows with a null in it are never inserted;
    callers that keep rejects find them among the rows that are not returned.
    """
    key = list(key)
    incoming = incoming.filter(~tf.any_null(key))
    winners = first_per_key(incoming, key, order)
    return winners.join(_candidates(incoming.select(*key), target, key, max_broadcast_bytes), key, "left_anti")


def flag_new(incoming: DataFrame, target: DataFrame, key: Sequence[str], order: Sequence[str], eligible: Column,
             max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``incoming`` with ``is_new``: whether :func:`insert_if_absent` of its
    ``eligible`` rows would append the row. ``order`` must tell rows of a key
    apart. Only keys and their order are aggregated; whole rows meet the result
    once, so inserted and rejected rows come from one pass."""
    key = list(key)
    loaded = incoming.filter(eligible & ~tf.any_null(key))
    firsts = loaded.groupBy(*key).agg(F.min(_pack(order)).alias("_first"))
    firsts = firsts.join(_candidates(loaded.select(*key), target, key, max_broadcast_bytes), key, "left_anti")
    same = F.col("_first").isNotNull() & F.col("_first").eqNullSafe(_pack(order))
    return incoming.join(firsts, key, "left").withColumn("is_new", eligible & same).drop("_first")


def upsert(existing: DataFrame, updates: DataFrame, key: str, values: Sequence[str],
           version: str | None = None, as_of=None,
           created: str = "created_at", updated: str = "updated_at") -> DataFrame:
    """New table contents after upserting ``updates`` into ``existing`` (K8).

    * a new key is inserted with ``created = updated = as_of``;
    * an existing key takes the update's ``values`` and ``updated = as_of``,
      keeping its ``created``;
    * a key absent from the updates is unchanged;
    * a key repeated in the updates resolves to its greatest ``version``
      (then the greatest values, so the pick is deterministic);
    * null keys never conflict: such rows are kept or inserted as they are.

    One union and one aggregation keyed on ``key``: both sides are read once
    and shuffled once, with the aggregate combined per task before it.
    """
    values = list(values)
    stamp = tf.now(as_of)
    ver_type = updates.schema[version].dataType if version else "long"
    ver = F.col(version) if version else F.lit(None)
    ts_type = existing.schema[created].dataType
    old = existing.select(
        key, *values, F.col(created), F.col(updated),
        F.lit(0).alias("_src"), F.lit(None).cast(ver_type).alias("_ver"),
    )
    new = updates.select(
        key, *values,
        F.lit(None).cast(ts_type).alias(created), F.lit(None).cast(ts_type).alias(updated),
        F.lit(1).alias("_src"), ver.cast(ver_type).alias("_ver"),
    )
    both = old.unionByName(new)
    null_key = F.col(key).isNull()
    # null keys never conflict: such rows group by their whole row, and the
    # count restores how many there were, so one aggregation covers both cases
    null_row = F.when(null_key, _pack(both.columns)).alias("_null_row")
    merged = both.groupBy(key, null_row).agg(
        F.max(_pack(["_src", "_ver", *values])).alias("_win"),
        F.min(created).alias("_created"),
        F.max(updated).alias("_updated_old"),
        F.max("_src").alias("_touched"),
        F.count(F.lit(1)).cast("int").alias("_n"),
    )
    is_null = F.col(key).isNull()
    copies = F.when(is_null, F.array_repeat(F.lit(1), F.col("_n"))).otherwise(F.array(F.lit(1)))
    return merged.select(
        key,
        *[F.when(is_null, F.col(f"_null_row.{v}")).otherwise(F.col(f"_win.{v}")).alias(v) for v in values],
        F.when(is_null, F.coalesce(F.col(f"_null_row.{created}"), stamp))
        .otherwise(F.coalesce(F.col("_created"), stamp)).alias(created),
        F.when(is_null, F.coalesce(F.col(f"_null_row.{updated}"), stamp))
        .when(F.col("_touched") == 1, stamp).otherwise(F.col("_updated_old")).alias(updated),
        F.explode(copies).alias("_copy"),
    ).drop("_copy")
