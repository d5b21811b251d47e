"""Mixing sources to target weights: iterative proportional fitting, then sampling.

Token counts are summed per cell (source, language, topic); the cells' weights
are raked in turn to the target share of every source, language and topic
until all three agree; a document is drawn with the probability its cell's
weight calls for. All steps are DataFrame operations: a sweep aggregates and
joins the table of cells only, never the documents, and each sweep is written
so that lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._tables import saved

DIMENSIONS = ("source", "lang", "topic")
#: Label of rows whose source, language or topic is null.
NONE = "(none)"


def word_tokens(text: Column) -> Column:
    """Words (runs of other than ASCII white space) in a text, null: none."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"),
                           lambda w: w != "")).cast("long")


def tempered_targets(cells: DataFrame, alpha: dict[str, float]) -> dict[str, DataFrame]:
    """Target share of every value of each dimension: its token share to the
    power ``alpha``, made to sum to one (1: as it is, 0: all values alike)."""
    out = {}
    for d in DIMENSIONS:
        own = cells.groupBy(d).agg(F.sum("tokens").cast("double").alias("t"))
        own = own.filter("t > 0").withColumn("t", F.pow("t", F.lit(alpha[d])))
        whole = own.agg(F.sum("t")).first()[0]
        out[d] = saved(own.select(d, (F.col("t") / F.lit(whole or 1.0)).alias("target")), "mix_targets")
    return out


def rake(cells: DataFrame, targets: dict[str, DataFrame], tolerance: float = 1e-9, max_sweeps: int = 50) -> DataFrame:
    """``cells`` (dimensions and ``tokens``) with ``factor``, such that the
    sums of tokens * factor over each dimension's values are in proportion to
    the targets, to within ``tolerance``. A value without tokens or without a
    target keeps its factor; a value with tokens and target 0 gets 0."""
    whole = float(cells.agg(F.sum("tokens")).first()[0] or 1)
    out = cells.withColumn("factor", F.lit(1.0) / F.lit(whole))
    for d in DIMENSIONS:  # each cell carries its targets, so that a sweep only joins sums
        out = out.join(targets[d].select(d, F.col("target").alias(f"{d}_target")), d, "left")
    out = saved(out, "mix_cells")
    for _ in range(max_sweeps):
        out = out.withColumn("before", F.col("factor"))
        for d in DIMENSIONS:
            sums = out.groupBy(d).agg(F.sum(F.col("tokens") * F.col("factor")).alias("s"))
            out = out.join(sums, d, "left").withColumn("factor", F.col("factor") * F.coalesce(
                F.when(F.col("s") > 0, F.col(f"{d}_target") / F.col("s")), F.lit(1.0))).drop("s")
            # written for each dimension, as the table is used twice: for its sums and for the join
            out = saved(out, "mix_cells")
        moved = out.filter("before > 0").agg(F.max(F.abs(F.col("factor") / F.col("before") - 1))).first()[0]
        if moved is None or moved <= tolerance:
            break
    return out.select(*cells.columns, "factor")


def marginal_error(cells: DataFrame, targets: dict[str, DataFrame]) -> float:
    """Largest difference between a value's share of the raked tokens and its
    target: what raking could not reach, where targets contradict each other."""
    whole = cells.agg(F.sum(F.col("tokens") * F.col("factor"))).first()[0]
    if not whole:
        return 0.0
    gaps = [cells.groupBy(d).agg((F.sum(F.col("tokens") * F.col("factor")) / F.lit(whole)).alias("s"))
            .join(targets[d], d).agg(F.max(F.abs(F.col("s") - F.col("target")))).first()[0] for d in DIMENSIONS]
    return max((g for g in gaps if g is not None), default=0.0)


def _placed(docs: DataFrame, topic: Column, *kept: Column) -> DataFrame:
    """``kept`` and the three dimensions of every row."""
    return docs.select(*kept, *[F.coalesce(c.cast("string"), F.lit(NONE)).alias(d) for d, c in (
        ("source", F.col("source")), ("lang", F.col("lang")), ("topic", topic))])


def _probabilities(placed: DataFrame, alpha: dict[str, float], targets, tolerance: float) -> DataFrame:
    """Inclusion probability of every cell: its factor over the largest one of
    the cells with tokens (one without tokens may have a larger one: 1)."""
    cells = saved(placed.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), "mix_cells")
    targets = targets or tempered_targets(cells, alpha)
    raked = rake(cells, targets, tolerance)
    error = marginal_error(raked, targets)
    top = raked.filter("tokens > 0").agg(F.max("factor")).first()[0] or 1.0
    share = F.least(F.col("factor") / F.lit(top), F.lit(1.0))
    return saved(raked.select(*DIMENSIONS, F.round(share, 6).alias("probability"),
                              F.round(F.lit(float(error)), 6).alias("marginal_error")), "mix_cells")


def _drawn(key: str, seed: int) -> Column:
    """Whether a key's hash falls below its row's probability."""
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    draw = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    return draw < F.col("probability")


def mix_sources(docs: DataFrame, topic: Column, alpha: dict[str, float], tokens: Column | None = None,
                targets: dict[str, DataFrame] | None = None, seed: int = 20, tolerance: float = 1e-9) -> DataFrame:
    """Raked inclusion probability and draw of every row of ``docs``.

    ``topic`` and ``tokens`` (default: words of ``text``) are column
    expressions over ``docs``; ``targets`` overrides the tempered targets of
    ``alpha``. Returns ``doc_id``, ``source``, ``lang``, ``topic``, ``tokens``,
    ``probability`` (the cell's factor over the largest one of the cells with
    tokens, at most 1, so the most wanted cell is taken whole and nothing is repeated), ``sampled`` and
    ``marginal_error`` (:func:`marginal_error`; 0 where all targets are met). The
    draw is a hash of doc_id and ``seed``: rows that repeat a doc_id in one
    cell are drawn together, and a rerun draws the same documents.

    A null source, language or topic is a value of its own (``(none)``); a
    null text has no token and gets its cell's probability; a null doc_id is
    drawn like an empty one. Other columns are ignored. An empty table gives
    an empty result.
    """
    counted = F.coalesce(tokens if tokens is not None else word_tokens(F.col("text")), F.lit(0)).cast("long")
    placed = saved(_placed(docs, topic, F.col("doc_id"), counted.alias("tokens")), "mix_docs")
    return placed.join(_probabilities(placed, alpha, targets, tolerance), list(DIMENSIONS)).select(
        "doc_id", *DIMENSIONS, "tokens", "probability", _drawn("doc_id", seed).alias("sampled"), "marginal_error")


def sampled_rows(docs: DataFrame, topic: Column, alpha: dict[str, float], tokens: Column | None = None,
                 targets: dict[str, DataFrame] | None = None, seed: int = 20, tolerance: float = 1e-9) -> DataFrame:
    """The rows that :func:`mix_sources` samples, with all their columns; the
    texts are not shuffled where the table of cells is small."""
    counted = F.coalesce(tokens if tokens is not None else word_tokens(F.col("text")), F.lit(0)).cast("long")
    cells = _probabilities(_placed(docs, topic, counted.alias("tokens")), alpha, targets, tolerance)
    packed = _placed(docs, topic, F.struct("*").alias("row"), F.col("doc_id").alias("key"))
    return packed.join(cells, list(DIMENSIONS)).filter(_drawn("key", seed)).select("row.*")


def topic_by_form(text: str = "text", tokens: Column | None = None) -> Column:
    """A coarse topic from the form of a text: tables, licence notices, and
    short, middle and long prose."""
    n = tokens if tokens is not None else word_tokens(F.col(text))
    return F.when(F.col(text).contains(" | "), "table").when(F.col(text).contains("icense"), "notice") \
        .when(n < 100, "short").when(n < 1000, "middle").when(n.isNotNull(), "long")
