"""Removal of repeated strings against a set of all strings of 100 bytes."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripflow.llm import queries as Q
from tripflow.llm import suffix_dedup as m
from tripflow.llm._tables import saved


def brute(rows, length=100):
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - length + 1):
            if (w := data[s:s + length]) in seen:
                gone[s:s + length] = True
            seen.add(w)
        spans = int((np.diff(np.concatenate(([0], gone.astype(np.int8)))) == 1).sum())
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out.append((doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def told(df):
    return sorted((tuple(r) for r in df.drop("removed").collect()), key=str)


@pytest.fixture(scope="module")
def mixed():
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdé \n") for _ in range(rng.choice([90, 100, 101, 150, 400, 2000]))) for _ in range(30)]
    rows = []
    for i in range(150):
        text = ""
        for _ in range(rng.randint(0, 6)):
            b = rng.choice(base)
            text += rng.choice([b, b[rng.randint(0, 50):], "".join(rng.choice("xyz") for _ in range(rng.randint(1, 150))),
                                rng.choice(["=", "ab", "-+-"]) * rng.randint(1, 300)])
        rows.append((i, text))
    return [*rows, (1000, None), (1001, ""), (1002, "a" * 5000), (1003, "a" * 99), (None, base[3] * 2)]


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = told(Q.op13_suffix_dedup(spark, "/root/testdata/sf0.001"))
    assert got == brute([(r["doc_id"], r["text"]) for r in docs.collect()]) and sum(r[2] for r in got) > 10_000


def test_buckets_and_boundaries(spark, mixed, monkeypatch):
    docs = spark.createDataFrame(mixed, "doc_id long, text string").repartition(5)
    for c in ("doc", "mark", "start", "open", "bytes", "lead", "removed"):
        docs = docs.withColumn(c, F.lit(1))
    exp = brute(mixed)
    assert told(m.suffix_dedup(docs)) == exp
    monkeypatch.setattr(m, "BUCKET_ROWS", 20)
    monkeypatch.setattr(m, "BLOCK_BITS", 11)  # long texts are cut into blocks
    assert told(m.suffix_dedup(docs)) == exp
    # half of all leading bytes dealt as hot ones
    monkeypatch.setattr(m, "_hot", lambda t, n: np.array([r[0] for r in m._screen_rows(
        t, n, np.zeros(0, np.uint64)).select("lead").distinct().collect()][::2], np.int64).view(np.uint64))
    assert told(m.suffix_dedup(docs)) == exp


def test_hot_leading_bytes_are_found(spark, monkeypatch):
    monkeypatch.setattr(m, "SAMPLE", 1)
    shared = "The same few words come first, then " * 2
    rows = [(i, hashlib.sha256(b"%d" % i).hexdigest() + shared + hashlib.sha512(b"%d" % i).hexdigest()) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = docs.select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("mark"), "text")
    assert len(m._hot(texts, 100)) > 0
    assert told(m.suffix_dedup(docs)) == brute(rows)


def test_ids_that_repeat_and_empty_tables(spark):
    passage = hashlib.sha512(b"x").hexdigest() + "!?"
    rows = [(1, passage), (1, passage), (1, passage + "."), (2, "x" + passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = m.suffix_dedup(docs).collect()
    # one document of the two texts of id 1 is the first; its repeated row counts as that document
    assert sorted(r["n_removed"] for r in got if r["doc_id"] == 1) in ([0, 0, 130], [0, 130, 130])
    assert [r["n_removed"] for r in got if r["doc_id"] == 2] == [130]
    assert m.suffix_dedup(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="length"):
        m.suffix_dedup(docs, 20)


def test_multikey_sort_groups_equal_strings():
    data = np.frombuffer(b"abcabcabcabcabcxyzxyz" * 3, np.uint8)
    at, run = m.multikey_sort(m.big_endian(data), np.arange(len(data) - 12), [0, 4])
    groups = {}
    for a, r in zip(at.tolist(), run.tolist(), strict=True):
        groups.setdefault(r, set()).add(bytes(data[a:a + 12]))
    assert all(len(g) == 1 for g in groups.values()) and len(at) == len(data) - 12 - sum(
        1 for i in range(len(data) - 12) if bytes(data[i:i + 12]) not in [bytes(data[j:j + 12]) for j in range(len(data) - 12) if j != i])


def hot_rows(n):
    """Texts that share a line of 110 bytes among others of their own, some of them twice."""
    line = hashlib.sha256(b"line").hexdigest() + hashlib.sha256(b"more").hexdigest()[:46]
    own = [hashlib.sha512(b"%d" % (i % (n - 20))).hexdigest() for i in range(n)]
    return [(i, t[:90 + i % 30] + line + t[::-1]) for i, t in enumerate(own)] + [(n, line[:95]), (n + 1, line[3:104] * 2)]


def test_hot_stretches_are_cut_into_pieces(spark, mixed, monkeypatch):
    monkeypatch.setattr(m, "SAMPLE", 1)
    monkeypatch.setattr(m, "BUCKET_ROWS", 50)
    found = []
    monkeypatch.setattr(m, "saved", lambda df, kind: found.append((kind, saved(df, kind))) or found[-1][1])
    rows = hot_rows(400)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert told(m.suffix_dedup(docs)) == brute(rows)
    made = {kind: df for kind, df in found}
    # far fewer rows than one for each of a stretch's windows
    assert made["suffix_found"].filter("edge").count() < len(rows)
    # every stretch and every piece cut: single windows
    everything = np.zeros(0, np.uint64)
    texts = spark.createDataFrame(mixed, "doc long, text string").select("doc", F.lit(0).cast("long").alias("mark"), "text").fillna("")
    for _ in m.widths(100):
        lead = [r[0] for r in m._screen_rows(texts.fillna(0), 100, everything).select("lead").distinct().collect()]
        everything = np.union1d(everything, np.array(lead, np.int64).view(np.uint64))
    monkeypatch.setattr(m, "_hot", lambda t, n: everything)
    assert m._screen_rows(texts.fillna(0), 100, everything).filter("windows > 1").count() == 0
    assert told(m.suffix_dedup(spark.createDataFrame(mixed, "doc_id long, text string"))) == brute(mixed)


@pytest.mark.parametrize("width", [9, 4, 1])
def test_pieces_hold_every_window_once(width):
    start, n, at = np.array([5, 100, 200]), np.array([77, 3, 40]), np.array([81, 110, 270])
    own, begin, count, core = m.pieces_of(start, n, at, width)
    got = sorted((o, w) for o, b, c in zip(own, begin, count, strict=True) for w in range(b, b + c))
    assert got == [(i, w) for i in range(3) for w in range(start[i], start[i] + n[i])]
    assert (core >= begin).all() and (core + 100 - width + 1 <= begin + count + 99).all()


def test_leading_bytes_of_more_than_a_bucket_are_compared_across(spark, monkeypatch):
    monkeypatch.setattr(m, "BUCKET_ROWS", 10)  # not hot by the sample, and cut by document
    rows = hot_rows(120)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert told(m.suffix_dedup(docs)) == brute(rows)
