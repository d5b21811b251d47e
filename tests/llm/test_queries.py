"""The registered queries: SQL, held-out accuracy, brute force, the pipeline."""

import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from test_entry import TABLES, norm
from test_operators import rule_counts, shingles
from tripflow.llm import queries as Q
from tripflow.llm.encode import Encoder, default_tokenizer
from tripflow.llm.lm_score import lm_scores

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=str)


def test_every_operator_is_registered():
    numbers = sorted(int(m[1]) for n in E.queries() if (m := re.match(r"op(\d+)_", n)))
    assert numbers == list(range(1, 14)) and "pipeline" in E.queries()


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_query_matches_its_sql(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rel = duck.sql(Q.SQL[name])
    assert bag(df.columns, df.collect()) == bag(rel.columns, rel.fetchall())


def test_classifier_on_held_out_labels(spark, duck):
    got = {r["doc_id"]: r for r in E.queries()["op3_quality_classifier"](spark, "/root/testdata/sf0.01").collect()}
    labels = duck.sql("SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet'").fetchall()
    held = [(got[d]["predicted"], q) for d, q in labels if zlib.crc32(str(d).encode()) % 3 == 1]
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in got.items())
    assert np.mean([p == q for p, q in held]) >= 0.9


def test_token_queries_against_the_library(spark, duck):
    enc, start = Encoder(default_tokenizer()), 0
    got = {r["doc_id"]: tuple(r)[1:] for r in E.queries()["op5_token_files"](spark, SF).collect()}
    sizes = []
    for d, t in duck.sql("SELECT doc_id, text FROM documents ORDER BY 1").fetchall():
        ids = np.array([*enc.lib.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        assert got[d] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
        sizes.append(len(ids) - 1)
    rows = E.queries()["op2_token_counts"](spark, SF).collect()
    assert sum(r["n_docs"] for r in rows) == len(sizes) and max(r["total_tokens"] for r in rows) == sum(sizes)


def test_longer_contexts_reach_the_documents_scores(spark):
    two = {r["doc_id"]: r["log_score_micro"]
           for r in lm_scores(spark.read.parquet(f"{SF}/documents.parquet"), order=2).collect()}
    three = {r["doc_id"]: r["log_score_micro"] for r in E.queries()["op7_lm_scores"](spark, SF).collect()}
    assert set(two) == set(three) and sum(two[d] != three[d] for d in two) > len(two) / 2


def test_license_query_against_plain_search(spark, duck):
    notice = "Licensed under CC BY-NC 4.0.", "Released under the MIT License."
    rows = {r["doc_id"]: r for r in E.queries()["op10_license_scan"](spark, "/root/testdata/sf0.01").collect()}
    texts = duck.sql("SELECT doc_id, text FROM '/root/testdata/sf0.01/documents.parquet'").fetchall()
    assert len(rows) == len(texts)
    for d, t in texts:
        for name, line in zip(("CC-BY-NC-4.0", "MIT"), notice, strict=True):
            assert (rows[d]["own_license"] == name) == (line in t.split("\n"))
        if rows[d]["inherited_from"] is not None:
            assert rows[d]["directory"].startswith(rows[d]["inherited_from"]) and rows[d]["license"]


def test_pipeline_against_brute_force(spark, duck):
    docs = {d: (t, src) for d, t, src in duck.sql("SELECT doc_id, text, source FROM documents").fetchall()}
    good = {d for d, (t, _) in docs.items() if not ((c := rule_counts(t))[0] < 50 or 100 * c[4] > 50 * c[0])}
    sets = {d: shingles(docs[d][0]) for d in good}
    parent = {d: d for d in good}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a in sorted(good):
        for b in sorted(good):
            if a < b and len(k := sets[a] & sets[b]) and len(k) >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    heads = {d for d in good if root(d) == d}
    tests = [shingles(t) for (t,) in duck.sql("SELECT text FROM benchmark").fetchall()]
    clean = {d for d in heads if not any(len(s & sets[d]) >= 0.8 * len(s) for s in tests)}
    state = {}
    table = spark.read.parquet(f"{SF}/documents.parquet")
    cur = table
    for name, stage in corpus_pipeline.STAGES[:4]:
        cur = corpus_pipeline.saved(stage(spark, cur, SF), "test_stage")
        assert cur.columns == table.columns
        state[name] = {r["doc_id"] for r in cur.select("doc_id").collect()}
    assert state["quality_rules"] == good and state["ngram_jaccard_join"] == heads
    assert state["benchmark_decontamination"] == clean
    assert state["source_mix"] <= clean and len(state["source_mix"]) > len(clean) / 4
    out = corpus_pipeline.run(spark, SF).orderBy("doc_id").collect()
    enc, start = Encoder(default_tokenizer()), 0
    assert {r["doc_id"] for r in out} == state["source_mix"]
    for r in out:
        ids = np.array([*enc.lib.encode(docs[r["doc_id"]][0], add_special_tokens=False).ids, 0], "<u4")
        assert tuple(r) == (r["doc_id"], start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def prose(word, n=80):
    return " ".join(f"{word}{i}" for i in range(n))


def test_pipeline_on_an_empty_table_and_odd_rows(spark):
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    odd = spark.createDataFrame([(None, "a " * 60, None, None, None), (1, None, None, None, None),
                                 (2, prose("v"), None, None, 5), (2, prose("v"), None, None, 5)], empty.schema)
    for docs, n in ((empty, 0), (odd, 1)):
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.saved(stage(spark, docs, SF), "test_stage")
        assert docs.count() == n


def test_rows_without_an_id_or_with_a_shared_one_are_judged_by_their_text(spark, duck):
    schema = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").schema
    item = next(t for (t,) in duck.sql("SELECT text FROM benchmark ORDER BY item_id").fetchall() if len(t.split()) > 20)
    rows = [(None, prose("n"), "en", "a", 1), (None, prose("m"), "en", "a", 1), (5, prose("x"), "en", "a", 1),
            (5, prose("y"), "en", "a", 1), (5, prose("y") + " one more", "en", "a", 1), (3, prose("x"), "en", "a", 1),
            (None, prose("x"), "en", "a", 1), (5, prose("z") + " " + item, "en", "a", 1),
            (None, prose("w") + " " + item, "en", "a", 1)]
    docs = spark.createDataFrame(rows, schema).withColumn("row", F.lit(1)).withColumn("class_id", F.lit(2))
    docs = corpus_pipeline.saved(docs, "test_stage")
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = corpus_pipeline.saved(stage(spark, docs, SF), "test_stage")
        if name == "ngram_jaccard_join":
            got = sorted((r["doc_id"] or 0, r["text"].split()[0], len(r["text"].split()) - 80) for r in docs.collect())
            assert [g[:2] for g in got if g[2] < 5 and g[1] != "y0"] == [(0, "m0"), (0, "n0"), (3, "x0")]
            assert sum(g[1] == "y0" for g in got) == 1 and len(got) == 6
    assert sorted((r["doc_id"] or 0, r["text"].split()[0]) for r in docs.collect()) == [
        (0, "m0"), (0, "n0"), (3, "x0"), (5, "y0")]
    assert docs.columns == [*schema.fieldNames(), "row", "class_id"]


def test_short_items_are_found_by_query_and_sql(spark, duck, tmp_path):
    docs = [(1, "alpha beta gamma delta"), (2, "beta gamma"), (3, "gamma beta " + prose("q")), (4, None), (5, "alpha")]
    items = [(1, "beta gamma"), (2, "alpha"), (3, ""), (4, "alpha beta gamma delta"), (5, prose("q"))]
    spark.createDataFrame(docs, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    got = E.queries()["op6_decontamination"](spark, str(tmp_path))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    rel = con.sql(Q.SQL["op6_decontamination"])
    assert bag(got.columns, got.collect()) == bag(rel.columns, rel.fetchall())
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == {(1, 1), (1, 2), (1, 4), (2, 1), (5, 2), (3, 5)}
