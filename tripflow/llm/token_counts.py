"""Token counts: an exact histogram of encoded lengths, and its suffix sums.

Documents are aggregated by encoded length; with the suffix sums of the
histogram any context limit is answered without going back to the documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._tables import arrow_conf, saved
from ._words import tidy
from .encode import encoder, gathered

#: Lengths per step of the two-step suffix sums.
STEP = 1024


def encoded_lengths(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """``n_tokens`` of every row's whole text (null: 0)."""
    arrow_conf(docs.sparkSession)

    def rows(batches):
        enc = encoder(tokenizer)
        for t in gathered(batches, "text"):
            yield pa.RecordBatch.from_arrays([pa.array(np.diff(enc.batch(t.column("text"))[1]))], names=["n_tokens"])

    return docs.select(F.col(text).alias("text")).mapInArrow(tidy(rows), "n_tokens long")


def length_histogram(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """One row per encoded length that occurs, over the whole texts of ``docs``.

    ``n_tokens``, ``n_docs``, ``docs_at_least`` and ``tokens_at_least`` (suffix
    sums: documents this long or longer, and their tokens), ``total_docs``,
    ``total_tokens``, ``truncated_tokens`` (what remains if every document is
    cut to this length) and ``quantile`` (share of documents no longer).

    Empty and null texts have length 0; copies and repeated rows count each
    time; other columns are ignored. An empty table gives an empty histogram.
    """
    hist = encoded_lengths(docs, tokenizer, text).groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))
    hist = saved(hist.withColumn("step", F.floor(F.col("n_tokens") / STEP)), "length_histogram")
    # suffix sums in two steps: over the steps of lengths, then inside each step
    steps = hist.groupBy("step").agg(F.sum("n_docs").alias("d"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("t"))
    after = Window.orderBy(F.col("step").desc()).rowsBetween(Window.unboundedPreceding, -1)
    steps = saved(steps.select("step", *[F.coalesce(F.sum(c).over(after), F.lit(0)).alias(f"{c}_after")
                                         for c in ("d", "t")]), "length_steps")
    total = hist.agg(F.sum("n_docs").alias("d"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("t")).first()
    inside = Window.partitionBy("step").orderBy(F.col("n_tokens").desc())
    out = hist.join(steps, "step").select(
        "n_tokens", "n_docs",
        (F.sum("n_docs").over(inside) + F.col("d_after")).alias("docs_at_least"),
        (F.sum(F.col("n_docs") * F.col("n_tokens")).over(inside) + F.col("t_after")).alias("tokens_at_least"),
        F.lit(total["d"] or 0).cast("long").alias("total_docs"),
        F.lit(total["t"] or 0).cast("long").alias("total_tokens"))
    return out.withColumn("truncated_tokens", F.col("total_tokens") - F.col("tokens_at_least")
                          + F.col("docs_at_least") * F.col("n_tokens")) \
        .withColumn("quantile", F.round((F.col("total_docs") - F.col("docs_at_least") + F.col("n_docs"))
                                        / F.col("total_docs"), 6))


def at_limit(histogram: DataFrame, limit: int) -> tuple[int, int]:
    """(documents longer than ``limit``, tokens that remain if every document
    is cut to it), from the suffix sums of the first longer length."""
    longer = histogram.filter(F.col("n_tokens") > limit).orderBy("n_tokens").first()
    if longer is None:
        all_ = histogram.agg(F.max("total_tokens")).first()[0]
        return 0, int(all_ or 0)
    return longer["docs_at_least"], longer["total_tokens"] - longer["tokens_at_least"] \
        + longer["docs_at_least"] * limit
