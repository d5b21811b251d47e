"""Bloom filter of the keys of a load, as a small table of bit blocks.

A key belongs to one block of 32,768 bits, by a hash, and sets four of its bits,
by the parts of a second one. The blocks are built by one aggregation (bits are
combined per task before the shuffle) and hold 4,096 keys each on average: about
one byte a key, so a filter of a broadcast's size stands for many times the keys
that could be broadcast themselves. A table that is scanned looks its keys up in
the broadcast blocks and keeps those whose four bits are set: all that are in the
load, and about 2.5 % of the others (3 % is what the tests allow).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 1 << 15  # fixed: what bitmap_construct_agg covers
BLOCK_KEYS = BLOCK_BITS // 8
HASHES = 4


def filter_bytes(keys: int) -> int:
    """Bytes of the filter of so many keys."""
    return blocks_for(keys) * BLOCK_BITS // 8


def blocks_for(keys: int) -> int:
    return max(1, -(-keys // BLOCK_KEYS))


def _block(key: Sequence[str], blocks: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(blocks)).alias("_block")


def _bits(key: Sequence[str]) -> list[Column]:
    """Four places in a block, from a hash that does not depend on the block's."""
    h = F.xxhash64(F.lit("bits"), *key)
    return [F.shiftrightunsigned(h, 16 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)) for i in range(HASHES)]


def bloom_filter(keys: DataFrame, key: Sequence[str], blocks: int) -> DataFrame:
    """``_block`` and its bits as ``_words``: up to 512 numbers of 64 bits."""
    one = keys.select(_block(key, blocks), F.explode(F.array(*_bits(key))).alias("bit"))
    return bit_blocks(one, ["_block"], "bit")


def bit_blocks(rows: DataFrame, block: Sequence[str], bit: str) -> DataFrame:
    """Per block its bits (0 to ``BLOCK_BITS - 1``) as ``_words``, numbers of 64
    bits up to the last one that has a bit."""
    built = rows.groupBy(*block).agg(F.rtrim(F.hex(F.bitmap_construct_agg(bit)), F.lit("0")).alias("hex"))
    words = F.transform(F.sequence(F.lit(0), F.floor((F.length("hex") - 1) / 16).cast("int")),
                        lambda i: F.conv(F.rpad(F.substring("hex", 16 * i + 1, 16), 16, "0"), 16, -10).cast("long"))
    return built.select(*block, words.alias("_words"))


def bit_is_set(bit: Column) -> Column:
    """Whether ``_words`` has the bit; null where it has no such word."""
    word = F.get("_words", F.shiftright(bit, 6).cast("int"))
    place = 8 * (7 - F.shiftright(bit, 3).bitwiseAND(F.lit(7))) + bit.bitwiseAND(F.lit(7))
    return F.expr("0L") != F.call_function("shiftright", word, place.cast("int")).bitwiseAND(F.lit(1))


def may_hold(table: DataFrame, key: Sequence[str], bloom: DataFrame, blocks: int) -> DataFrame:
    """Rows of ``table`` whose key may be in the filter; the table is scanned
    and not shuffled."""
    met = table.withColumn("_block", _block(key, blocks)).join(F.broadcast(bloom), "_block")
    hit = F.lit(True)
    for bit in _bits(key):
        hit = hit & bit_is_set(bit)
    return met.filter(hit).select(*table.columns)
