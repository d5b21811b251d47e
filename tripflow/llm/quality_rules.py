"""Quality rules: per-document counts, and host verdicts from shrunken failure rates.

All steps are Spark SQL expressions. A document fails by its own counts; a
host (the column the caller names) is judged by the failure rate of all its
documents, shrunk toward the corpus by a beta prior fitted to the hosts
themselves (method of moments), and the host's verdict is joined back to its
documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._tables import saved

# Fixed values of the base rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda x: x != "")


def text_counts(docs: DataFrame, text: str, *keep: str) -> DataFrame:
    """``keep`` columns with ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines`` and ``n_repeat_words`` of each text (null: none).

    Repeated three-word windows are found by sorting (hash, position) pairs of
    one text and comparing neighbours, so a text of n words costs n log n and
    is never exploded or shuffled.
    """
    t = docs.select(*keep, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_t"))
    t = t.select(
        *keep, _words(F.col("_t")).alias("_w"),
        F.length(F.translate("_t", WHITE, "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_l"))
    t = t.select(
        *keep, F.size("_w").cast("long").alias("n_words"), "word_chars", "n_symbols",
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.expr("""case when size(_w) < 3 then cast(array() as array<bigint>) else
                  transform(slice(_w, 1, size(_w) - 2), (x, i) -> xxhash64(x, _w[i + 1], _w[i + 2])) end""")
        .alias("_h"))
    # (hash, position) pairs in hash order, only for texts that repeat a window
    t = t.withColumn("_s", F.expr(
        """case when size(array_distinct(_h)) < size(_h)
           then array_sort(transform(_h, (x, i) -> struct(x as h, i as p))) end"""))
    t = t.withColumn("_p", F.expr(
        """array_sort(transform(filter(transform(_s, (x, i) -> struct(x.p as p,
               coalesce(get(_s, i - 1).h = x.h, false) or coalesce(get(_s, i + 1).h = x.h, false) as d)),
             y -> y.d), y -> y.p))"""))
    repeat = F.expr("aggregate(transform(_p, (p, i) -> least(3, coalesce(get(_p, i + 1), p + 3) - p)), "
                    "0, (a, x) -> a + x)")
    return t.select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    F.coalesce(repeat, F.lit(0)).cast("long").alias("n_repeat_words"))


def with_base(counts: DataFrame) -> DataFrame:
    """``base_failed``: too few words, or too many of them in repeated windows."""
    return counts.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                             | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def host_rates(base: DataFrame, host: str, max_rate: float) -> DataFrame:
    """One row per non-null host: documents, failures, the rate shrunk by the
    empirical beta prior, and ``host_kept``: the rate is at most ``max_rate``,
    or at most twice the failure rate of all other hosts, so that a host is
    never rejected for being like the others, nor spared by its own failures.
    A host without others is held to ``max_rate``.

    Five sums over the hosts fit the prior (:func:`beta_prior`); only they
    reach the driver.
    """
    hosts = base.filter(F.col(host).isNotNull()).groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("host_docs"), F.sum(F.col("base_failed").cast("long")).alias("host_failed"))
    hosts = saved(hosts, "host_rates")
    sums = hosts.agg(
        F.count(F.lit(1)).alias("k"), F.sum("host_docs").alias("n"), F.sum("host_failed").alias("failed"),
        F.sum(F.col("host_docs") * F.col("host_docs")).alias("n2"),
        F.sum(F.col("host_failed") * F.col("host_failed") / F.col("host_docs")).alias("q")).first()
    prior = beta_prior(sums)
    others = (F.lit(sums["failed"] or 0) - F.col("host_failed")) / F.nullif(
        F.lit(sums["n"] or 0) - F.col("host_docs"), F.lit(0))
    most = F.greatest(F.lit(float(max_rate)), F.coalesce(2 * others, F.lit(0.0)))
    rate = (F.col("host_failed") + F.lit(prior[0])) / (F.col("host_docs") + F.lit(sum(prior)))
    return hosts.select("host", "host_docs", "host_failed", rate.alias("host_rate"), (rate <= most).alias("host_kept"))


def beta_prior(sums) -> tuple[float, float]:
    """Beta prior (a, b) from five sums over the hosts: their number ``k``,
    documents ``n``, failures ``failed``, squared documents ``n2`` and
    ``q`` = sum of failures**2 / documents. The variance between hosts is what
    remains of the weighted variance after the binomial part."""
    if not sums["n"]:
        return 0.0, 1.0
    n, k, mean = float(sums["n"]), sums["k"], sums["failed"] / sums["n"]
    spread = mean * (1 - mean)
    weight = n - sums["n2"] / n - (k - 1)
    between = (sums["q"] - n * mean * mean - (k - 1) * spread) / weight if weight > 0 else 0.0
    # hosts that differ no more than by chance: as strong as the whole corpus
    strength = max(spread / between - 1, 0.0) if 0 < between else n
    return mean * strength, (1 - mean) * strength


def quality_rules(docs: DataFrame, host: str = "source", text: str = "text", max_rate: float = 0.5,
                  key: str = "doc_id") -> DataFrame:
    """Counts, base rules and host verdicts of every row of ``docs``.

    Returns ``doc_id``, ``host``, the counts of :func:`text_counts`,
    ``base_failed``, ``host_rate`` and ``kept`` (not ``base_failed``, and the
    host is kept by :func:`host_rates`).

    A null text has no words and fails; a null host has no verdict, so such
    rows are kept or not by their own counts. Rows with a null or repeated key
    are judged each by itself. Other columns are ignored. An empty table gives
    an empty result.
    """
    slim = docs.select(F.col(key).alias("doc_id"), F.col(host).cast("string").alias("host"), F.col(text).alias("txt"))
    base = saved(with_base(text_counts(slim, "txt", "doc_id", "host")), "quality_base")
    hosts = saved(host_rates(base, "host", max_rate).select("host", "host_rate", "host_kept"), "host_rates")
    return base.join(hosts, "host", "left").select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.round("host_rate", 6).alias("host_rate"),
        (~F.col("base_failed") & F.coalesce("host_kept", F.lit(True))).alias("kept"))


def kept_rows(docs: DataFrame, host: str = "source", text: str = "text", max_rate: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that :func:`quality_rules` keeps, with all their
    columns. Counts and rows are written once and filtered after the hosts'
    verdicts are known, so texts are neither counted twice nor shuffled."""
    packed = docs.select(F.struct("*").alias("row"), F.col(host).cast("string").alias("host"),
                         F.col(text).alias("txt"))
    base = saved(with_base(text_counts(packed, "txt", "row", "host")).select("row", "host", "base_failed"),
                 "quality_rows")
    hosts = host_rates(base.select("host", "base_failed"), "host", max_rate).select("host", "host_kept")
    good = base.filter("not base_failed").join(saved(hosts, "host_rates"), "host", "left")
    return good.filter(F.coalesce("host_kept", F.lit(True))).select("row.*")
