"""Periodic runs against a comparison of every word with every later one."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripflow.llm import queries as Q
from tripflow.llm.periodic import periodic_runs, prime_factors, tiles, z_function

WORD = r"[^\x20\x09-\x0D]+"


def all_runs(words, least=24, times=3):
    codes, out = {}, {}
    x = np.array([codes.setdefault(w, len(codes)) for w in words])
    for p in range(1, len(x) // times + 1):
        edges = np.flatnonzero(np.diff(np.concatenate(([0], (x[:-p] == x[p:]).view(np.int8), [0]))))
        for s, e in zip(edges[::2].tolist(), (edges[1::2] + p).tolist(), strict=True):
            if e - s >= max(least, times * p):
                out.setdefault((s, e), p)
    return sorted((s, e - s, p) for (s, e), p in out.items())


def brute(doc_id, words):
    found = all_runs(words)
    drop = {i for s, n, p in found for i in range(s + p, s + n)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None,) * 3
    sha = [hashlib.sha256(t.encode()).hexdigest() for t in (
        "".join("%d,%d,%d\n" % r for r in found), " ".join(w for i, w in enumerate(words) if i not in drop))]
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, *sha)


def told(df):
    cols = ("doc_id", "n_runs", "start", "length", "period", "x", "runs_sha256", "collapsed_sha256")
    df = df.withColumn("x", F.expr("length * 1000 div period")).select(*cols)
    return sorted((tuple(r) for r in df.collect()), key=str)


def planted(doc_id, text):
    words = re.findall(WORD, text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_documents_with_planted_runs(spark):
    got = sorted((tuple(r) for r in Q.op11_periodic_runs(spark, "/root/testdata/sf0.001").collect()), key=str)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    exp = sorted((brute(r["doc_id"], planted(r["doc_id"], r["text"])) for r in docs), key=str)
    assert got == exp and sum(r[1] > 0 for r in exp) > len(exp) / 12


@pytest.fixture(scope="module")
def mixed():
    rng, rows = random.Random(5), []
    for i in range(120):
        words, n = [], rng.choice([30, 100, 400, 2000])
        while len(words) < n:
            if rng.random() < 0.5:
                words += [rng.choice("abcdefgh") for _ in range(rng.randint(1, 30))]
            else:
                unit = [rng.choice(rng.choice(["ab", "abcdefghij"])) for _ in range(rng.choice([1, 2, 3, 6, 8, 17, 33, 100]))]
                words += (unit * rng.randint(2, 9))[:rng.randint(10, 700)]
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize(("long_bytes", "tile_words"), [(1 << 22, 1 << 16), (10, 64), (200, 256)])
def test_tiles_in_one_task_or_dealt(spark, mixed, long_bytes, tile_words):
    docs = spark.createDataFrame(mixed, "doc_id long, text string")
    got = told(periodic_runs(docs, long_bytes=long_bytes, tile_words=tile_words))
    assert got == sorted((brute(d, t.split(" ")) for d, t in mixed), key=str)


def test_odd_rows(spark):
    long_run = "x y z " * 100_000
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, "a " * 24), (4, "a " * 23), (5, "a b " * 12 + "c"), (5, "a b " * 12 + "c"),
            (6, long_run)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("row", "runs", "found", "start", "period", "n_words", "sha"):
        docs = docs.withColumn(c, F.lit(1))
    got = told(periodic_runs(docs))
    view = {(r[0], r[1:5]) for r in got}
    assert view == {(1, (0, None, None, None)), (2, (0, None, None, None)), (3, (0, None, None, None)),
                    (None, (1, 0, 24, 1)), (4, (0, None, None, None)), (5, (1, 0, 24, 2)), (6, (1, 0, 300_000, 3))}
    assert len(got) == len(rows) and periodic_runs(docs.limit(0)).count() == 0
    text = {r["doc_id"]: r["collapsed"] for r in periodic_runs(docs).collect()}
    assert text[5] == "a b c" and text[6] == "x y z" and text[4] is None
    with pytest.raises(ValueError, match="three periods"):
        periodic_runs(docs, times=2)


def test_z_function_and_factors():
    rng = random.Random(1)
    for _ in range(50):
        x = [rng.randint(0, 1) for _ in range(rng.randint(1, 40))]
        z = z_function(x)
        for i in range(1, len(x)):
            k = 0
            while i + k < len(x) and x[k] == x[i + k]:
                k += 1
            assert z[i] == k
    assert prime_factors(360) == (2, 3, 5) and prime_factors(97) == (97,) and prime_factors(1) == ()


def test_every_boundary_lies_in_one_tile_of_its_octave():
    for n in (30, 1000, 70_000):
        got = tiles(n, 3, 64)
        for j in range((n // 3).bit_length()):
            spans = sorted((a, b) for lo, hi, a, b in got if lo <= j < hi)
            assert spans[0][0] == 0 and spans[-1][1] == n
            assert all(x[1] == y[0] for x, y in zip(spans, spans[1:], strict=False))
