"""Rows of files told by their place there, kept or left out without a shuffle.

A row's place is its file and its number in it. The places to look for are one
bit a row, in blocks of 32,768 rows of a file, so the table of blocks stays a
broadcast's size where the places themselves would not: texts are scanned and
filtered where they are, exactly.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.operators.bloom import BLOCK_BITS, bit_blocks, bit_is_set

from ._tables import saved

#: A row's place in its file.
PLACE = ["_file", "_place"]
PLACES_BYTES = 64 << 20  # largest table of blocks that is sent whole (500 million rows); beyond it rows are shuffled


def placed(docs: DataFrame) -> DataFrame:
    """``docs`` with the file of each row and its place there (written first, if
    they are not read from files)."""
    try:
        return docs.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_place"))
    except AnalysisException:
        return placed(saved(docs, "placed_rows"))


def at_places(rows: DataFrame, places: DataFrame, wanted: bool = True) -> DataFrame:
    """The rows of ``rows(_file, _place, ...)`` whose place is in
    ``places(_file, _place)``, or, if not ``wanted``, the others."""
    block, bit = F.floor(F.col("_place") / BLOCK_BITS).alias("_block"), F.pmod("_place", F.lit(BLOCK_BITS))
    blocks = saved(bit_blocks(places.select("_file", block, bit.alias("_bit")), ["_file", "_block"], "_bit"),
                   "place_blocks")
    size = blocks.agg(F.sum(8 * F.size("_words") + 64 + F.length("_file"))).first()[0] or 0
    if size > PLACES_BYTES:
        return rows.join(places.select(*PLACE), PLACE, "left_semi" if wanted else "left_anti").select(*rows.columns)
    found = F.coalesce(bit_is_set(bit), F.lit(False))
    met = rows.withColumn("_block", block).join(F.broadcast(blocks), ["_file", "_block"], "left")
    return met.filter(found if wanted else ~found).select(*rows.columns)
