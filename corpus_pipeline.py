"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs. All but the last return
the columns of documents; the last writes the corpus as token files and
returns one row per document read back from them.

Every row is judged by its own text, whatever its doc_id: rows without one, and
rows that share one but not the text, go through all stages but the last, whose
files are in doc_id order and take rows that have one. Rows are told apart by
their place in the file that they are read from. An empty table passes through
all stages.

A stage's result must be written before the next stage is called: that call
removes the folders that the stage before has used.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm._places import PLACE, at_places, placed
from tripflow.llm._tables import collected, discard, read, saved
from tripflow.llm.decontaminate import contaminated
from tripflow.llm.encode import default_tokenizer
from tripflow.llm.mixing import sampled_rows, topic_by_form
from tripflow.llm.ngram_join import joined_rows
from tripflow.llm.quality_rules import kept_rows
from tripflow.llm.queries import MIX_ALPHA, MIX_SEED
from tripflow.llm.token_files import token_files

#: Folders that the stage called last has made on its way.
_USED: list[str] = []


def stage(fn):
    """A stage that removes what the one before it has left."""

    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        discard(spark, _USED)
        with collected() as made:
            out = fn(spark, docs, sf_dir)
        _USED.extend(made)
        return out

    return run_stage


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and their host's verdict keep."""
    return kept_rows(docs)


@stage
def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every near-duplicate class the document with the least id (rows with
    an id before rows without, then the first row)."""
    rows = placed(docs)
    classes = joined_rows(rows.select(*PLACE, "doc_id", "text"), PLACE)
    first = classes.groupBy("class_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", *PLACE)).alias("h"))
    heads = saved(first.select(*(F.col(f"h.{c}").alias(c) for c in PLACE)), "class_heads")
    return at_places(rows, heads).select(*docs.columns)


@stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    rows = placed(docs)
    leaks = contaminated(rows, read(spark, sf_dir, "benchmark"), short_items=True, key=PLACE)
    leaks = saved(leaks.select(*PLACE).distinct(), "leaking_docs")
    return at_places(rows, leaks, wanted=False).select(*docs.columns)


@stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the target shares of source, language and topic."""
    return sampled_rows(docs, topic_by_form(), MIX_ALPHA, seed=MIX_SEED)


@stage
def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus as token files, one row per document read back."""
    return token_files(docs, default_tokenizer())


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", deduplicate),
    ("benchmark_decontamination", decontaminate),
    ("source_mix", mix),
    ("token_files", write_tokens),
]

#: The tokenizer of the last stage cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = saved(step(spark, docs, sf_dir), f"stage_{name}")
    return docs
