"""Edge cases of every operator: nulls, empty and long texts, repeated rows,
empty tables, extra columns with clashing names."""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tripflow.llm import _words
from tripflow.llm.decontaminate import contaminated
from tripflow.llm.encode import Encoder, default_tokenizer
from tripflow.llm.licenses import license_scan
from tripflow.llm.lm_score import lm_scores
from tripflow.llm.mixing import mix_sources, sampled_rows, topic_by_form
from tripflow.llm.ngram_join import ngram_join, runs_for
from tripflow.llm.quality_model import quality_scores
from tripflow.llm.quality_rules import beta_prior, kept_rows, quality_rules
from tripflow.llm.token_counts import at_limit, length_histogram
from tripflow.llm.token_files import TokenFile, pack, token_files
from tripflow.llm.warc import LoserTree, parse_record, warc_round_trip

LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(20_000))
NEAR = LONG.replace("w500x6", "changed", 1)
PROSE = " ".join(f"word{i}" for i in range(60))
ROWS = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, "  \n\t ", None, "b"), (4, "one two three", "de", None),
    (5, LONG, "en", "a"), (6, NEAR, "en", "a"), (7, LONG, "fr", "b"), (7, LONG, "fr", "b"),
    (8, PROSE, "en", "c"), (9, "one two three", None, None), (None, PROSE, "en", "a"),
    (10, "x | y <|endoftext|> é ü\n\nLicensed under the Apache License, Version 2.0.\n", "en", "c"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


@pytest.fixture(scope="module")
def docs(spark):
    extra = [F.lit(1).alias(c) for c in ("n_words", "row", "host", "tokens", "size", "score", "path", "topic", "_w")]
    return spark.createDataFrame(ROWS, SCHEMA).select("*", *extra).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(r.asDict())
    return out


def shingles(t, n=5):
    w = words(t)
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def test_words_agree_with_the_definition():
    texts = [t for _, t, _, _ in ROWS] + ["a\x0bb\x0cc\rd", "　x y"]
    flat, off = _words.words(pa.array(texts))
    assert [flat.to_pylist()[a:b] for a, b in zip(off, off[1:], strict=False)] == [words(t) for t in texts]
    assert [len(s) for s in _words.shingle_sets(pa.array(texts), 5)] == [len(shingles(t)) for t in texts]


def test_join_links_and_classes(docs, none):
    got = by_id(ngram_join(docs))
    assert all(len(v) == 1 for v in got.values()) and set(got) == set(range(1, 11))
    view = {k: (v[0]["class_id"], v[0]["rep_id"], v[0]["n_links"]) for k, v in got.items()}
    assert view[5] == (5, 5, 2) and view[7] == (5, 5, 2) and view[6] == (5, 6, 2)
    assert view[4] == (4, 4, 1) and view[9] == (4, 4, 1)
    for lone in (1, 2, 3, 8, 10):
        assert view[lone] == (lone, lone, 0)
    assert ngram_join(none).count() == 0


def test_join_finds_every_pair_in_a_large_group(spark):
    base = [f"t{i}" for i in range(400)]
    rows = []
    for i in range(120):  # near copies, each with a word changed at a place of its own
        w = list(base)
        w[3 * i] = f"own{i}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(f"z{i}_{k}" for k in range(100))) for i in range(40)]
    sets = {i: shingles(t) for i, t in rows}
    links = {i: sum(1 for j in sets if j != i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])) for i in sets}
    got = by_id(ngram_join(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {k: v[0]["n_links"] for k, v in got.items()} == links and links[5] == 119
    assert {v[0]["class_id"] for k, v in got.items() if k < 1000} == {0}


def test_join_deals_large_buckets_as_blocks(spark, monkeypatch):
    from tripflow.llm import ngram_join as m
    monkeypatch.setattr(m, "SMALL_BUCKET", 8)
    monkeypatch.setattr(m, "BLOCK", 5)
    rows = [(i, " ".join(f"t{k}" if k != 2 * i else f"own{i}" for k in range(300))) for i in range(40)]
    got = by_id(m.ngram_join(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {v[0]["n_links"] for v in got.values()} == {39} and {v[0]["class_id"] for v in got.values()} == {0}


def test_runs_reach_the_recall():
    q = 1 - 0.626 ** runs_for(0.999, 3)
    assert q >= 0.999 and runs_for(0.9, 1) == 3


def test_components_of_chains_and_stars(spark):
    from tripflow.llm.components import components
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 20)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(31)} == {0} and {got[100 + i] for i in range(20)} == {100} and got[201] == 200
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_histogram_against_the_library(docs, none):
    enc = Encoder(default_tokenizer())
    sizes = [len(enc.lib.encode(t or "", add_special_tokens=False).ids) for _, t, _, _ in ROWS]
    rows = length_histogram(docs, default_tokenizer()).collect()
    assert {r["n_tokens"]: r["n_docs"] for r in rows} == Counter(sizes)
    for r in rows:
        lim = r["n_tokens"]
        assert r["truncated_tokens"] == sum(min(s, lim) for s in sizes)
        assert r["docs_at_least"] == sum(s >= lim for s in sizes)
        assert r["tokens_at_least"] == sum(s for s in sizes if s >= lim)
        assert r["quantile"] == pytest.approx(sum(s <= lim for s in sizes) / len(sizes), abs=1e-6)
    hist = length_histogram(docs, default_tokenizer())
    for lim in (0, 5, 100, 10**9):
        assert at_limit(hist, lim) == (sum(s > lim for s in sizes), sum(min(s, lim) for s in sizes))
    assert length_histogram(none, default_tokenizer()).count() == 0


def test_encoder_equals_the_library():
    enc = Encoder(default_tokenizer())
    texts = ["", None, " a", "a ", "a  b", "a\n b", "it's 5 o'clock  now\t x", "a<|endoftext|> b", "\x00 a b", "a\x85 b",
             "ünï 日本語 😀 a", " ", "x  y", LONG]
    ids, off = enc.batch(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert ids[off[i]:off[i + 1]].tolist() == enc.lib.encode(t or "", add_special_tokens=False).ids


def test_encoder_with_a_full_cache(monkeypatch):
    from tripflow.llm import encode
    monkeypatch.setattr(encode, "CACHED_PIECES", 50)
    enc = Encoder(default_tokenizer())
    for lo in range(0, 400, 40):
        texts = [" ".join(f"p{i % 90}, q{i}" for i in range(lo, lo + 60)), "p1, one  two"]
        ids, off = enc.batch(pa.array(texts))
        for i, t in enumerate(texts):
            assert ids[off[i]:off[i + 1]].tolist() == enc.lib.encode(t, add_special_tokens=False).ids


def test_token_file_gives_any_token():
    rng = np.random.default_rng(1)
    for ids in (rng.integers(0, 50_000, 5000), rng.integers(0, 200, 700), rng.integers(0, 2**32, 1500),
                np.zeros(0, np.int64), np.array([256])):
        f = TokenFile(pack(np.arange(1), np.array([0, len(ids)]), ids))
        assert f.ids(0, len(ids)).tolist() == ids.tolist()
        for i in rng.integers(0, max(len(ids), 1), 40):
            if len(ids):
                assert f.ids(int(i), int(i) + 1)[0] == ids[i]


def test_token_files_round_trip(docs, none, tmp_path):
    enc = Encoder(default_tokenizer())
    rows = sorted([r for r in ROWS if r[0] is not None], key=lambda r: r[0])
    got = sorted(token_files(docs, default_tokenizer(), f"file://{tmp_path}/dac").collect(), key=lambda r: r["start"])
    start = 0
    assert len(got) == len(rows)
    for r, (doc, text, _, _) in zip(got, rows, strict=True):
        ids = np.array([*enc.lib.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        assert tuple(r) == (doc, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert token_files(none, default_tokenizer()).count() == 0


def test_classifier_learns_and_scores_every_row(spark, docs, none):
    good = [(i, " ".join(f"gut{(i * j) % 50} haus" for j in range(1, 30)), 1) for i in range(100, 140)]
    bad = [(i, " ".join(f"GUT{(i * j) % 50}!!" for j in range(1, 30)), 0) for i in range(200, 240)]
    train = spark.createDataFrame(good + bad, "doc_id long, text string, label int")
    held = spark.createDataFrame([(300, "gut3 haus gut90 haus"), (301, "XGUT3!! GUT7!!"), (302, None), (303, "")],
                                 "doc_id long, text string")
    got = by_id(quality_scores(train.drop("label").unionByName(held), train.select("doc_id", "label")))
    assert got[300][0]["predicted"] == 1 and got[301][0]["predicted"] == 0
    assert got[302][0]["score"] == got[303][0]["score"] and len(got) == 84
    labels = train.select("doc_id", "label")
    assert quality_scores(docs, labels.limit(0)).filter("score = 0.5").count() == len(ROWS)
    assert quality_scores(none, labels).count() == 0


def rule_counts(t):
    w = words(t)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    many = Counter(grams)
    lines = [x for x in (t or "").split("\n") if words(x)]
    covered = {p + k for p, g in enumerate(grams) if many[g] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(covered))


def test_quality_counts(spark, docs, none):
    texts = [t for _, t, _, _ in ROWS] + ["a b c a b c a b", "x\nx\n \nx\n\n", "u v w u v w x u v w", "🙂 é b ##|"]
    df = spark.createDataFrame([(i, t, "h") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    for i, r in by_id(quality_rules(df)).items():
        r = r[0]
        exp = rule_counts(texts[i])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == exp
        assert r["base_failed"] == (exp[0] < 50 or 100 * exp[4] > 50 * exp[0])
    assert quality_rules(docs).count() == len(ROWS) and quality_rules(none).count() == 0
    assert kept_rows(docs).columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept_rows(docs).collect()) == ["8", "None"]
    assert kept_rows(none).count() == 0


def test_bad_hosts_are_rejected_and_small_ones_shrunk(spark):
    short = "too short"
    rows = [(i, short if i < 90 else PROSE, "bad") for i in range(100)]
    rows += [(1000 + i, short if i % 50 == 0 else PROSE, f"good{i % 4}") for i in range(400)]
    rows += [(5000, short, "tiny"), (5001, PROSE, "tiny"), (5002, PROSE, None)]
    got = by_id(quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")))
    assert not any(got[i][0]["kept"] for i in range(100))
    assert got[1001][0]["kept"] and got[5002][0]["kept"] and got[5002][0]["host_rate"] is None
    assert 0 < got[5000][0]["host_rate"] < 0.5 and got[5001][0]["kept"]
    a, b = beta_prior({"k": 2, "n": 100, "failed": 10, "n2": 5000, "q": 1.0})
    assert a / (a + b) == pytest.approx(0.1) and a + b == pytest.approx(100)
    assert beta_prior({"k": 0, "n": None, "failed": None, "n2": None, "q": None}) == (0.0, 1.0)


def test_decontamination_against_brute_force(spark, docs, none):
    items = [(1, " ".join(words(LONG)[5000:5030])), (2, PROSE), (3, "one two three"), (4, None), (None, PROSE),
             (5, " ".join(words(LONG)[19980:]) + " q1 q2 q3"), (6, "zz " * 40), (2, PROSE)]
    tests = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(0))
    exp = {}
    for d, t, _, _ in ROWS:
        for i, s in items:
            if d is not None and i is not None and len(words(s)) >= 5:
                share = len(shingles(s) & shingles(t)) / len(shingles(s))
                if share >= 0.8 - 1e-9:
                    exp[d, i] = round(share, 6)
    got = {(r["doc_id"], r["item_id"]): r["containment"] for r in contaminated(docs, tests).collect()}
    assert got == exp and {(5, 1), (6, 1), (7, 1), (8, 2), (5, 5)} <= set(got)
    assert contaminated(none, tests).count() == 0 and contaminated(docs, tests.limit(0)).count() == 0


def test_packed_values_come_back():
    from tripflow.llm.lm_score import pack, pack_keys, unpack, unpack_keys
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 300):
        v = rng.integers(0, 2**64, n, dtype=np.uint64)
        assert unpack(pack(v)).tolist() == v.tolist()
        assert unpack(pack(v >> np.uint64(45))).tolist() == (v >> np.uint64(45)).tolist()
        assert unpack_keys(pack_keys(np.unique(v))).tolist() == np.unique(v).tolist()


def test_scores_of_trigrams_against_brute_force(docs, none):
    from math import log
    grams = []
    for _, t, _, _ in ROWS:
        w = words(t)
        grams.append(Counter(tuple(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)))
    count = sum(grams, Counter())
    total = sum(len(words(t)) for _, t, _, _ in ROWS)

    def score(own, w, i, n):
        g = tuple(w[i - n + 1:i + 1])
        other = count[g] - own[g]
        if n == 1:
            return log(max(other, 1) / max(total - len(w), 1))
        if i < n - 1:
            return score(own, w, i, n - 1)
        return log(other / (count[g[:-1]] - own[g[:-1]])) if other else log(0.4) + score(own, w, i, n - 1)

    got = by_id(lm_scores(docs))
    assert sum(map(len, got.values())) == len(ROWS)
    for (d, t, _, _), own in zip(ROWS, grams, strict=True):
        w = words(t)
        want = sum(round(score(own, w, i, 3) * 1e6) for i in range(len(w)))
        assert any(r["n_words"] == len(w) and abs(r["log_score_micro"] - want) <= 1
                   and (r["mean_log_score"] is None) == (not w) for r in got[d])
    assert lm_scores(none).count() == 0


def test_scores_where_all_texts_are_empty_or_there_is_one(spark):
    blank = spark.createDataFrame([(1, None), (2, ""), (None, " ")], "doc_id long, text string")
    assert sorted(tuple(r)[1:] for r in lm_scores(blank).collect()) == [(0, 0, None)] * 3
    alone = spark.createDataFrame([(1, "a b a b a")], "doc_id long, text string")
    # no other text: four words back off once or twice to one of one
    assert lm_scores(alone).first()["log_score_micro"] == 1 * -916291 + 3 * -1832581


def test_score_chunks_of_repeated_tasks(spark, tmp_path, monkeypatch):
    """Chunks are named by a written table: what a repeated task writes beside
    them is not read, and requests do not differ when they are made again."""
    import os

    from tripflow.llm import lm_score
    from tripflow.llm._tables import saved
    monkeypatch.setattr(lm_score, "CHUNK_BYTES", 2000)

    def requests(n, buckets):
        df = spark.range(n).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(0, 40), "
                                       "i -> cast(hash(id, i) % 500 as string))) AS text").repartition(4, "doc_id")
        folder = str(tmp_path / f"chunks{n}_{buckets}")
        made = lm_score._chunks(df, "file://" + folder)
        names = saved(made, "names")
        made.collect()  # the same tasks once more
        assert len(os.listdir(folder)) == 2 * names.count()
        out = lm_score._requests(names, 3, buckets, 60, "file://" + folder)
        rows = sorted(map(tuple, out.collect()))
        assert rows == sorted(map(tuple, out.collect()))
        return rows

    few, many = requests(200, 1 << 20), requests(800, 1 << 22)
    keys = sum(len(lm_score.unpack_keys(r[3])) for r in many)
    # rows are bounded by n-grams, not by chunks times buckets
    assert len(many) <= keys and len(many) < 5 * len(few)
    assert sum(r[2] for r in many) == 800 * 41


def test_mix_meets_the_targets(spark, docs, none):
    rows = [(i, " ".join(["w"] * (5 + i % 7)), "en" if i % 3 else "de", "big" if i % 5 else "small") for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    topic = F.when(F.col("doc_id") % 2 == 0, "even").otherwise("odd")
    got = mix_sources(df, topic, {"source": 0.0, "lang": 0.0, "topic": 1.0}).toPandas()
    want = got.assign(t=got.tokens * got.probability)
    for d, share in (("source", 0.5), ("lang", 0.5)):
        part = want.groupby(d).t.sum()
        assert np.allclose(part / part.sum(), share, atol=1e-4)
    assert got.probability.max() == 1.0
    drawn = got[got.sampled].groupby("source").tokens.sum()
    assert abs(drawn["small"] / drawn.sum() - 0.5) < 0.06
    alpha = {"source": 0.7, "lang": 0.7, "topic": 1.0}
    mixed = mix_sources(docs, topic_by_form(), alpha)
    assert mixed.count() == len(ROWS) and mixed.filter("source = '(none)'").count() == 2
    kept = sampled_rows(docs, topic_by_form(), alpha)
    assert kept.columns == docs.columns and kept.count() == mixed.filter("sampled").count()
    assert mix_sources(none, topic_by_form(), alpha).count() == 0 and sampled_rows(none, topic_by_form(), alpha).count() == 0


def test_loser_tree_merges():
    rng = np.random.default_rng(3)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted(rng.integers(0, 50, rng.integers(0, 30)).tolist()) for _ in range(k)]
        assert list(LoserTree(runs)) == sorted(x for r in runs for x in r)


def test_warc_round_trip(spark, tmp_path):
    import hashlib
    big, small = "<p>ü " + "x" * 2000, "tiny"
    rows = [(1, "http://A.example.com/x#f", big), (2, "https://www.a.example.com:443/x", big), (3, None, None),
            (4, "no host", small), (5, "http://a.example.com/x", small), (6, "http://b.org", big + "y"),
            (None, "http://b.org", big), (7, "http://a.example.com/x\r\nevil", big), (9, "http://b.org", LONG), (9, "u", LONG)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("size", F.lit(1)).repartition(3)
    got = sorted(warc_round_trip(pages, f"file://{tmp_path}/warc").collect(), key=lambda r: (r["page_id"], r["url_key"]))
    assert [r["page_id"] for r in got] == [1, 2, 3, 4, 5, 6, 7, 9, 9]
    for r in got:
        body = dict((k, h) for k, _, h in rows)[r["page_id"]] or ""
        assert (r["payload_bytes"], r["payload_digest"]) == (len(body.encode()), hashlib.sha1(body.encode()).hexdigest())
        refers = 7 if r["page_id"] in (1, 2) else None
        assert r["refers_to"] == refers and r["record_type"] == ("revisit" if refers else "response")
    same = [(r["page_id"], r["capture_no"]) for r in got if r["url_key"] == "com,example,a)/x"]
    assert same == [(1, 1), (2, 2), (5, 3)]
    assert warc_round_trip(pages.limit(0)).count() == 0
    with pytest.raises(ValueError):
        parse_record(b"HTTP/1.1\r\n\r\n")


def test_license_inheritance(spark, docs, none):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [(1, mit, "r/LICENSE"), (2, PROSE, "r/a/b/f.txt"), (3, gpl + "\nshort", "r/a/COPYING"), (4, PROSE, "r/a/g.txt"),
            (5, PROSE + "\n" + mit + "\n" + PROSE, "r/a/h.txt"), (6, PROSE, "s/i.txt"), (7, None, "r/j"), (8, PROSE, None),
            (9, "the license of the version", "t/k"), (10, PROSE, "t/l"), (None, PROSE, "r/m"), (11, PROSE, "f")]
    got = by_id(license_scan(spark.createDataFrame(rows, "doc_id long, text string, p string"), F.col("p")))
    view = {k: (v[0]["license"], v[0]["inherited_from"]) for k, v in got.items()}
    assert view[1] == ("MIT", None) and view[3] == ("GPL-3.0", None) and view[5] == ("MIT", None)
    assert view[2] == ("GPL-3.0", "r/a") and view[4] == ("GPL-3.0", "r/a") and view[7] == ("MIT", "r")
    assert view[None] == ("MIT", "r")
    for k in (6, 8, 10, 11):
        assert view[k] == (None, None)
    scan = license_scan(docs, F.concat_ws("/", "source", "lang", F.lit("x")))
    assert scan.count() == len(ROWS) and by_id(scan)[10][0]["own_license"] == "Apache-2.0"
    assert license_scan(none, F.lit("a/b")).count() == 0


def test_wrapped_embedded_and_whole_licences(spark):
    from tripflow.llm.licenses import BLOCKS, default_templates
    import textwrap
    gpl = dict(BLOCKS)["GPL-3.0"]
    whole = dict(default_templates())
    texts = ["\n".join(" * " + x for x in textwrap.wrap(gpl, 70)) + "\n" + PROSE,
             PROSE + " Released under the MIT License. " + PROSE, "# SPDX-License-Identifier: MIT\n" + PROSE,
             "# SPDX-License-Identifier: (Apache-2.0 OR Zlib) AND GPL-2.0-only WITH Classpath-exception-2.0\n" + PROSE,
             whole["ISC"], PROSE + "\n" + whole["MIT"] + "\n" + PROSE, whole["Apache-2.0"], PROSE,
             "Released under the MIT License.\n" + PROSE + "\nLicensed under CC BY-NC 4.0."]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {k: v[0] for k, v in by_id(license_scan(df, F.lit(None).cast("string"))).items()}
    own = {k: v["own_license"] for k, v in got.items()}
    assert own == {0: "GPL-3.0", 1: "MIT", 2: "MIT", 3: "Apache-2.0", 4: "ISC", 5: "MIT", 6: "Apache-2.0", 7: None,
                   8: own[8]}
    assert got[3]["own_licenses"] == ["Apache-2.0", "GPL-2.0-only", "Zlib"] and got[4]["is_license_file"]
    assert {"MIT", "CC-BY-NC-4.0"} <= set(got[8]["own_licenses"]) and got[7]["own_licenses"] == []


def test_items_of_a_few_words_are_found_in_every_document(spark):
    rows = [(i, " ".join([*(f"a{i}x{k}" for k in range(i % 31)), "q1 q2 q3 q4 q5 q6", *(f"b{i}x{k}" for k in range(40))]))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, "q1 q2 q3 q4 q5"), (2, "q1 q2 q3 q4 q5 q6"), (3, "q3 q4"), (4, "q4 q3"), (5, "b7x3")],
                                  "item_id long, text string")
    count = {r["item_id"]: r["count"] for r in contaminated(df, items).groupBy("item_id").count().collect()}
    assert count == {1: 3000, 2: 3000}
    count = {r["item_id"]: r["count"] for r in contaminated(df, items, short_items=True).groupBy("item_id").count().collect()}
    assert count == {1: 3000, 2: 3000, 3: 3000, 5: 1}
