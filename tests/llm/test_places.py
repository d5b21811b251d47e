"""Rows kept or left out by their place in a file."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tripflow.llm import _places as m
from tripflow.llm import ngram_join
from tripflow.llm._tables import saved


@pytest.fixture(scope="module")
def rows(spark):
    docs = spark.range(0, 150_000, 1, 3).select(F.col("id").alias("doc_id"), F.expr("repeat('x', id % 7)").alias("text"))
    return m.placed(saved(docs, "test_places"))


@pytest.mark.parametrize("some", ["doc_id % 3 = 0", "doc_id in (0, 49999, 50000, 82767, 82768, 149999)", "doc_id < 50000", "false", "true"])
def test_kept_and_left_out_exactly(rows, some, monkeypatch):
    places = rows.filter(some).select(*m.PLACE)
    kept, rest = (sorted(r[0] for r in rows.filter(f).select("doc_id").collect()) for f in (some, f"not ({some})"))
    for most in (m.PLACES_BYTES, 0):  # beyond the limit by a join
        monkeypatch.setattr(m, "PLACES_BYTES", most)
        assert m.at_places(rows, places).columns == rows.columns
        assert sorted(r["doc_id"] for r in m.at_places(rows, places).collect()) == kept
        assert sorted(r["doc_id"] for r in m.at_places(rows, places, wanted=False).collect()) == rest


@pytest.mark.parametrize("name", ["ngram_jaccard_join", "benchmark_decontamination"])
def test_texts_are_filtered_without_a_shuffle(spark, name, monkeypatch):
    made = []
    monkeypatch.setattr(ngram_join, "saved", lambda df, kind: made.append(kind) or saved(df, kind))
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for places beyond it
    try:
        docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
        out = dict(corpus_pipeline.STAGES)[name](spark, docs, "/root/testdata/sf0.001")
        out.collect()
        assert "hashpartitioning" not in out._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
    # no node holds many sets, so the levels below the first are not read
    assert made.count("ngram_nodes") == (1 if name == "ngram_jaccard_join" else 0)
