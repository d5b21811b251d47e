"""The Merkle manifest against a tree built by plain loops."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tripflow.llm import merkle
from tripflow.llm.merkle import merkle_manifest
from tripflow.llm.queries import LEAF_COLUMNS

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i:i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def siblings(tree, i):
    out = []
    for level in tree[:-1]:
        out.append((i % 2, level[i ^ 1] if i ^ 1 < len(level) else ""))
        i //= 2
    return out


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for x in langs:
        by[x].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[x] = levels([leaf(r) for r in by[x]])
    top = levels([trees[x][-1][0] for x in langs])
    out = []
    for k, x in enumerate(langs):
        for i, r in enumerate(by[x]):
            path = siblings(trees[x], i) + siblings(top, k)
            told = list(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None:
                told[3] += 1
            root = leaf(told)
            for right, other in path:
                root = h(other + root) if right else h(root + other)
            out.append((r[0], leaf(r), trees[x][-1][0], top[-1][0], h("".join(o for _, o in path)), root,
                        root == top[-1][0]))
    return sorted(out, key=str)


def manifest(docs, bits):
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    found = merkle_manifest(docs, LEAF_COLUMNS, "lang", "doc_id", {"n_chars": changed}, bits)
    return sorted((tuple(r) for r in found.drop("proof").collect()), key=str)


@pytest.mark.parametrize("bits", [8, 2])
def test_documents(spark, bits):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(*LEAF_COLUMNS)
    got = manifest(docs, bits)
    assert got == brute([tuple(r) for r in docs.collect()])
    assert 0 < sum(not r[-1] for r in got) < len(got) / 3


def test_odd_rows(spark):
    rows = [(None, "a", None, 3, "x"), (None, "a", None, 3, "x"), (5, None, "de", None, None), (5, None, "de", 2, ""),
            (7, "b", "", 1, "é"), (8, "b", "é", 1, "q" * 200_000), (14, "b", "é", None, "tampering adds nothing")]
    docs = spark.createDataFrame(rows, SCHEMA)
    for c in ("group", "rank", "hash", "n", "node", "path", "leaf", "root", "block"):
        docs = docs.withColumn(c, F.lit(1))
    assert manifest(docs, 8) == manifest(docs, 1) == brute(rows)
    assert manifest(docs.limit(0), 8) == []


def test_proof_leads_to_the_root(spark):
    docs = spark.createDataFrame([(i, "s", "en", 1, f"t{i}") for i in range(11)], SCHEMA)
    for r in merkle_manifest(docs, LEAF_COLUMNS, "lang", "doc_id", bits=2).collect():
        root = r["leaf"]
        for step in r["proof"]:
            root = h((step["hash"] + root) if step["side"] < 0 else root + (step["hash"] or ""))
        assert root == r["root"] == r["folded_root"] and r["verified"]


def test_a_block_holds_few_nodes(spark):
    nodes = spark.range(40).select(F.lit("g").alias("group"), F.lit(40).cast("long").alias("n"), F.col("id").alias("rank"),
                                   F.struct(F.sha2(F.col("id").cast("string"), 256).alias("hash")).alias("node"))
    blocks = merkle.rolled_up(nodes)
    assert blocks.count() == 3
    plan = blocks._jdf.queryExecution().optimizedPlan().toString()
    assert sum(line.lstrip(" +-:").startswith("Aggregate") for line in plan.splitlines()) <= 4
