"""The operators applied to the test tables, and their SQL where there is any."""

from __future__ import annotations

from pyspark.sql import functions as F

from ._tables import read
from .decontaminate import contaminated
from .encode import default_tokenizer
from .licenses import license_scan
from .lm_score import lm_scores
from .merkle import merkle_manifest
from .mixing import mix_sources, topic_by_form, word_tokens
from .ngram_join import ngram_join
from .periodic import periodic_runs
from .quality_model import quality_scores
from .quality_rules import quality_rules
from .suffix_dedup import suffix_dedup
from .token_counts import length_histogram
from .token_files import token_files
from .warc import warc_round_trip

#: Tempering of the mixture: 1 leaves shares as they are, 0 makes them alike.
MIX_ALPHA = {"source": 0.7, "lang": 0.7, "topic": 1.0}
MIX_SEED = 20


def op1_ngram_jaccard_join(spark, sf_dir):
    """Near-duplicate classes and link counts of all documents."""
    return ngram_join(read(spark, sf_dir, "documents"))


def op2_token_counts(spark, sf_dir):
    """Histogram of encoded lengths of all documents, with suffix sums."""
    return length_histogram(read(spark, sf_dir, "documents"), default_tokenizer())


def op3_quality_classifier(spark, sf_dir):
    """Quality score of every document; a third of the ids is held out."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    labels = read(spark, sf_dir, "labels").filter(~held_out).select("doc_id", F.col("quality").alias("label"))
    return quality_scores(read(spark, sf_dir, "documents"), labels).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


def op4_quality_rules(spark, sf_dir):
    """Counts, base rules and host verdicts of every document; its source is
    its host."""
    return quality_rules(read(spark, sf_dir, "documents"))


def op5_token_files(spark, sf_dir):
    """All documents written as token files and read back."""
    return token_files(read(spark, sf_dir, "documents"), default_tokenizer())


def op6_decontamination(spark, sf_dir):
    """Every benchmark item in every document."""
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), short_items=True)


def op7_lm_scores(spark, sf_dir):
    """Stupid-backoff trigram score of every document under all others."""
    return lm_scores(read(spark, sf_dir, "documents"))


def counted(docs):
    """Documents with their words counted once, for the mixture."""
    return docs.select("doc_id", "text", "source", "lang", word_tokens(F.col("text")).alias("words"))


def op8_source_mix(spark, sf_dir):
    """Raked probability and draw of every document."""
    docs = counted(read(spark, sf_dir, "documents"))
    return mix_sources(docs, topic_by_form("text", F.col("words")), MIX_ALPHA, F.col("words"), seed=MIX_SEED)


def op9_warc(spark, sf_dir):
    """All pages through WARC archives and the merged index."""
    return warc_round_trip(read(spark, sf_dir, "pages"))


def document_path():
    """The documents have no path; this lays them out in a tree by source,
    language and number, at a depth that a hash of doc_id decides."""
    depth = F.crc32(F.col("doc_id").cast("string")) % 3
    return F.concat_ws("/", "source", F.when(depth > 0, F.col("lang")),
                       F.when(depth > 1, F.expr("cast(doc_id div 1000 as string)")),
                       F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))


def op10_license_scan(spark, sf_dir):
    """Own and inherited licence of every document."""
    return license_scan(read(spark, sf_dir, "documents"), document_path())


def with_planted_runs(docs):
    """``docs`` where a tenth of the texts, by a checksum of their id, repeat
    their words from some place on with some period."""
    h = F.crc32(F.col("doc_id").cast("string"))

    def planted(ws):
        n, g = F.size(ws), F.expr("crc32(cast(doc_id as string)) div 10")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))  # below 2**53: exact
        place = F.sequence(F.lit(0).cast("long"), n.cast("long") - 1)
        return F.array_join(F.transform(place, lambda i: F.get(ws, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " ")

    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # the words are a variable of the outer transform, so that they are cut once
    one = F.transform(F.array(words), lambda ws: F.when(F.size(ws) > 0, planted(ws)))[0]
    return docs.withColumn("text", F.when(h % 10 == 0, one).otherwise(F.col("text")))


def op11_periodic_runs(spark, sf_dir):
    """Periodic runs of words of every document, a tenth of them with planted
    ones."""
    found = periodic_runs(with_planted_runs(read(spark, sf_dir, "documents")))
    return found.withColumn("exponent_milli", F.expr("length * 1000 div period")).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


LEAF_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def op12_merkle_manifest(spark, sf_dir):
    """Leaf, proof and check of every document; where 7 divides the checksum
    of its id, a document is checked with one character more than it has."""
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.col("n_chars") + 1) \
        .otherwise(F.col("n_chars"))
    found = merkle_manifest(read(spark, sf_dir, "documents"), LEAF_COLUMNS, "lang", "doc_id", {"n_chars": tampered})
    return found.drop("proof")


def op13_suffix_dedup(spark, sf_dir):
    """What is left of every document without bytes of strings of 100 bytes that
    also start earlier."""
    return suffix_dedup(read(spark, sf_dir, "documents")).drop("removed")


QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_token_counts, op3_quality_classifier, op4_quality_rules, op5_token_files,
    op6_decontamination, op7_lm_scores, op8_source_mix, op9_warc, op10_license_scan,
    op11_periodic_runs, op12_merkle_manifest, op13_suffix_dedup)}

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_SHINGLES = "list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' '))"


def _mix_sql(sweeps: int = 50) -> str:
    """The same raking with the sweeps written out."""
    dims = ("source", "lang", "topic")
    out = [f"""WITH d AS MATERIALIZED (SELECT doc_id, source, lang, len({_WORDS}) AS tokens, text FROM documents),
      p AS MATERIALIZED (SELECT doc_id, source, lang, CASE WHEN contains(text, ' | ') THEN 'table'
        WHEN contains(text, 'icense') THEN 'notice' WHEN tokens < 100 THEN 'short' WHEN tokens < 1000 THEN 'middle'
        ELSE 'long' END AS topic, tokens FROM d),
      c0 AS MATERIALIZED (SELECT source, lang, topic, sum(tokens)::BIGINT AS tokens,
        1.0::DOUBLE / (SELECT sum(tokens) FROM p) AS f FROM p GROUP BY ALL)"""]
    for d in dims:
        out.append(f"""t_{d} AS MATERIALIZED (SELECT {d}, x / sum(x) OVER () AS target FROM (
          SELECT {d}, pow(sum(tokens)::DOUBLE, {MIX_ALPHA[d]}) AS x FROM p GROUP BY 1 HAVING sum(tokens) > 0))""")
    n = 0
    for _ in range(sweeps):
        for d in dims:
            out.append(f"""c{n + 1} AS MATERIALIZED (SELECT c.source, c.lang, c.topic, c.tokens,
              c.f * coalesce(s.k, 1.0) AS f FROM c{n} c LEFT JOIN (SELECT x.{d}, t.target / x.s AS k FROM (
                SELECT {d}, sum(tokens * f) AS s FROM c{n} GROUP BY 1) x JOIN t_{d} t ON x.{d} = t.{d} WHERE x.s > 0) s
              ON c.{d} = s.{d})""")
            n += 1
    gaps = " UNION ALL ".join(f"""SELECT max(abs(x.s / y.s - t.target)) AS gap FROM (
        SELECT {d}, sum(tokens * f) AS s FROM c{n} GROUP BY 1) x JOIN t_{d} t ON x.{d} = t.{d},
        (SELECT sum(tokens * f) AS s FROM c{n}) y""" for d in dims)
    return ", ".join(out) + f"""
      SELECT p.doc_id, p.source, p.lang, p.topic, p.tokens, round(least(c.f / m.top, 1.0), 6) AS probability,
        ('0x' || substr(md5(p.doc_id::VARCHAR || ':{MIX_SEED}'), 1, 8))::BIGINT / 4294967296.0::DOUBLE
          < round(least(c.f / m.top, 1.0), 6) AS sampled, round(e.gap, 6) AS marginal_error
      FROM p JOIN c{n} c USING (source, lang, topic), (SELECT max(f) AS top FROM c{n} WHERE tokens > 0) m,
        (SELECT max(gap) AS gap FROM ({gaps})) e"""


def _crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text: each byte goes in, then eight steps."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda ch: [ord(ch)::BIGINT" + ", -1::BIGINT" * 8 + "]))"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), lambda c, x: CASE WHEN x >= 0 THEN xor(c, x)"
            " ELSE xor(c >> 1, 3988292384::BIGINT * (c & 1)) END), 4294967295::BIGINT)")


def _merkle_sql(levels: int = 24, top_levels: int = 6) -> str:
    """The tree level by level; each row carries its way up along."""

    def leaf(n_chars: str) -> str:
        cols = [n_chars if c == "n_chars" else c for c in LEAF_COLUMNS]
        return "sha256(" + " || ".join(
            f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in cols) + ")"

    crc = _crc32_sql("doc_id::VARCHAR")
    out = [f"""WITH d AS MATERIALIZED (SELECT doc_id, lang, {leaf('n_chars')} AS leaf,
        {leaf(f"(CASE WHEN ({crc}) % 7 = 0 THEN n_chars + 1 ELSE n_chars END)")} AS claim FROM documents),
      r AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
        count(*) OVER (PARTITION BY lang) AS n FROM d),
      n0 AS MATERIALIZED (SELECT lang, i, leaf AS h, n FROM r),
      p0 AS MATERIALIZED (SELECT doc_id, lang, leaf, i AS pos, n, claim AS f, '' AS s FROM r)"""]

    def up(k: int, group: str, same: str) -> None:
        out.append(f"""n{k + 1} AS MATERIALIZED (SELECT {group}i // 2 AS i, CASE WHEN any_value(n) > 1
          THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h, (any_value(n) + 1) // 2 AS n
          FROM n{k} GROUP BY {group}i // 2)""")
        out.append(f"""p{k + 1} AS MATERIALIZED (SELECT p.* REPLACE (p.pos // 2 AS pos, (p.n + 1) // 2 AS n,
          CASE WHEN p.n = 1 THEN p.f WHEN p.pos % 2 = 0 THEN sha256(p.f || coalesce(x.h, ''))
            ELSE sha256(x.h || p.f) END AS f, p.s || coalesce(x.h, '') AS s)
          FROM p{k} p LEFT JOIN n{k} x ON {same} x.i = xor(p.pos, 1) AND p.n > 1)""")

    for k in range(levels):
        up(k, "lang, ", "x.lang IS NOT DISTINCT FROM p.lang AND")
    k = levels + 1
    out.append(f"""t AS MATERIALIZED (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i,
        count(*) OVER () AS n FROM n{levels}),
      n{k} AS MATERIALIZED (SELECT i, h, n FROM t),
      p{k} AS MATERIALIZED (SELECT p.doc_id, p.lang, p.leaf, t.i AS pos, t.n, p.f, p.s, t.h AS subroot
        FROM p{levels} p JOIN t ON t.lang IS NOT DISTINCT FROM p.lang)""")
    for j in range(top_levels):
        up(k + j, "", "")
    return ", ".join(out) + f"""
      SELECT p.doc_id, p.leaf, p.subroot, n.h AS root, sha256(p.s) AS proof_sha256, p.f AS folded_root,
        p.f = n.h AS verified FROM p{k + top_levels} p, n{k + top_levels} n"""


SQL = {
    "op1_ngram_jaccard_join": f"""
      WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
      sh AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN {_SHINGLES}
        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM w),
      n AS MATERIALIZED (SELECT w.doc_id, count(sh.s) AS n FROM w LEFT JOIN sh USING (doc_id) GROUP BY 1),
      l AS MATERIALIZED (SELECT p.a, p.b, p.k = na.n AND p.k = nb.n AS same FROM (
          SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id <> y.doc_id
          GROUP BY 1, 2) p JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b
        WHERE p.k >= 0.8 * (na.n + nb.n - p.k)),
      r AS (SELECT doc_id, doc_id AS c FROM n UNION SELECT l.b, r.c FROM r JOIN l ON r.doc_id = l.a)
      SELECT n.doc_id, (SELECT min(c) FROM r WHERE r.doc_id = n.doc_id) AS class_id,
        least(n.doc_id, coalesce((SELECT min(b) FROM l WHERE l.a = n.doc_id AND same), n.doc_id)) AS rep_id,
        n.n AS n_shingles, (SELECT count(*) FROM l WHERE l.a = n.doc_id) AS n_links FROM n""",
    "op4_quality_rules": rf"""
      WITH w AS MATERIALIZED (SELECT doc_id, source AS host, coalesce(text, '') AS text, {_WORDS} AS ws FROM documents),
      g AS (SELECT doc_id, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM (
        SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
      r AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM (
        SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS m FROM g), (VALUES (0), (1), (2)) v(k)
        WHERE m > 1 GROUP BY 1),
      l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))
        AS ls FROM w),
      b AS MATERIALIZED (SELECT w.doc_id, host, len(ws)::BIGINT AS n_words,
        coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
        len(ws) < 50 OR 100 * coalesce(r.n, 0) > 50 * len(ws) AS base_failed
        FROM w JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)),
      h AS (SELECT host, count(*)::DOUBLE AS n, sum(base_failed::INT)::DOUBLE AS x FROM b GROUP BY 1),
      s AS (SELECT sum(n) AS n, count(*) AS k, sum(x) / sum(n) AS m, sum(n * n) AS n2, sum(x * x / n) AS q FROM h),
      v AS (SELECT *, (q - n * m * m - (k - 1) * m * (1 - m)) / (n - n2 / n - (k - 1)) AS v FROM s),
      z AS (SELECT m, CASE WHEN v > 0 THEN greatest(m * (1 - m) / v - 1, 0) ELSE n END AS strength FROM v),
      t AS (SELECT host, (h.x + m * strength) / (h.n + strength) AS rate,
        greatest(0.5, coalesce(2 * (s.n * s.m - h.x) / nullif(s.n - h.n, 0), 0)) AS most FROM h, s, (SELECT strength FROM z))
      SELECT doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        round(rate, 6) AS host_rate, NOT base_failed AND rate <= most AS kept FROM b JOIN t USING (host)""",
    "op6_decontamination": f"""
      WITH w AS MATERIALIZED (SELECT doc_id, {_WORDS} AS ws FROM documents),
      v AS MATERIALIZED (SELECT item_id, {_WORDS} AS ws FROM benchmark),
      d AS (SELECT DISTINCT doc_id, unnest({_SHINGLES}) AS s FROM w WHERE len(ws) >= 5 UNION ALL
        SELECT DISTINCT doc_id, array_to_string(ws[i : i + m - 1], ' ') FROM (
          SELECT doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM w,
            (SELECT DISTINCT len(ws) AS m FROM v WHERE len(ws) BETWEEN 1 AND 4))),
      i AS (SELECT DISTINCT item_id, unnest(CASE WHEN len(ws) >= 5 THEN {_SHINGLES}
        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM v),
      n AS (SELECT item_id, count(*) AS item_shingles FROM i GROUP BY 1)
      SELECT doc_id, item_id, count(*) AS shared, item_shingles, round(count(*) / item_shingles, 6) AS containment
      FROM d JOIN i USING (s) JOIN n USING (item_id) GROUP BY doc_id, item_id, item_shingles
      HAVING count(*) >= 0.8 * item_shingles""",
    "op7_lm_scores": f"""
      WITH w AS MATERIALIZED (SELECT doc_id, {_WORDS} AS ws FROM documents),
      p AS MATERIALIZED (SELECT doc_id, len(ws) AS n, ws[i] AS z, CASE WHEN i > 1 THEN ws[i - 1] END AS y,
        CASE WHEN i > 2 THEN ws[i - 2] END AS x FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w)),
      d1 AS (SELECT doc_id, z, count(*) AS n FROM p GROUP BY ALL),
      d2 AS (SELECT doc_id, y, z, count(*) AS n FROM p WHERE y IS NOT NULL GROUP BY ALL),
      d3 AS (SELECT doc_id, x, y, z, count(*) AS n FROM p WHERE x IS NOT NULL GROUP BY ALL),
      e1 AS MATERIALIZED (SELECT doc_id, z, (sum(n) OVER (PARTITION BY z) - n)::BIGINT AS n FROM d1),
      e2 AS MATERIALIZED (SELECT doc_id, y, z, (sum(n) OVER (PARTITION BY y, z) - n)::BIGINT AS n FROM d2),
      e3 AS MATERIALIZED (SELECT doc_id, x, y, z, (sum(n) OVER (PARTITION BY x, y, z) - n)::BIGINT AS n FROM d3),
      t AS (SELECT count(*) AS total FROM p),
      s AS (SELECT p.doc_id, round(1e6 * CASE WHEN e3.n > 0 THEN ln(e3.n / xy.n) ELSE
          CASE WHEN p.x IS NOT NULL THEN ln(0.4::DOUBLE) ELSE 0 END + CASE WHEN e2.n > 0 THEN ln(e2.n / q.n) ELSE
            CASE WHEN p.y IS NOT NULL THEN ln(0.4::DOUBLE) ELSE 0 END
            + ln(greatest(e1.n, 1) / greatest(t.total - p.n, 1)) END END)::BIGINT AS m
        FROM p JOIN e1 ON p.doc_id = e1.doc_id AND p.z = e1.z
        LEFT JOIN e1 q ON p.doc_id = q.doc_id AND p.y = q.z
        LEFT JOIN e2 ON p.doc_id = e2.doc_id AND p.y = e2.y AND p.z = e2.z
        LEFT JOIN e2 xy ON p.doc_id = xy.doc_id AND p.x = xy.y AND p.y = xy.z
        LEFT JOIN e3 ON p.doc_id = e3.doc_id AND p.x = e3.x AND p.y = e3.y AND p.z = e3.z, t)
      SELECT w.doc_id, len(w.ws)::BIGINT AS n_words, coalesce(m.m, 0)::BIGINT AS log_score_micro,
        CASE WHEN len(w.ws) > 0 THEN m.m::DOUBLE / (len(w.ws) * 1000000)::DOUBLE END AS mean_log_score
      FROM w LEFT JOIN (SELECT doc_id, sum(m) AS m FROM s GROUP BY 1) m USING (doc_id)""",
    "op8_source_mix": _mix_sql(),
    "op9_warc": r"""
      WITH a AS (SELECT page_id, coalesce(html, '') AS html, page_id % 1000000000 AS time,
        regexp_replace(lower(trim(coalesce(url, ''))), '#.*$', '') AS u FROM pages WHERE page_id IS NOT NULL),
      k AS (SELECT *, strlen(html) AS size, sha1(html) AS digest,
        regexp_replace(regexp_extract(u, '^[a-z][a-z0-9+.-]*://([^/?]*)', 1), '^www\.|:(80|443)$', '', 'g') AS host,
        regexp_replace(u, '^[a-z][a-z0-9+.-]*://[^/?]*', '') AS rest FROM a),
      m AS (SELECT *, CASE WHEN size >= 1000 THEN max(page_id) OVER (PARTITION BY digest, size) END AS holder,
        CASE WHEN host = '' THEN u ELSE array_to_string(list_reverse(string_split(host, '.')), ',') || ')'
          || CASE WHEN rest = '' THEN '/' ELSE rest END END AS url_key FROM k)
      SELECT page_id, size::BIGINT AS payload_bytes, digest AS payload_digest,
        CASE WHEN holder <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN holder <> page_id THEN holder END AS refers_to, url_key,
        row_number() OVER (PARTITION BY url_key ORDER BY time, page_id) AS capture_no FROM m""",
    "op12_merkle_manifest": _merkle_sql(),
}
