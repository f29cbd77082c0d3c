"""The corpus queries: name -> (Spark callable, DuckDB oracle or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


@query("op3_simhash")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import simhash_components
    out = simhash_components(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op8_decontaminate")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contamination
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@query("op9_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary())


@query("op10_html_text")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_text import extract_main_text
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_main_text(pages).withColumn("n_chars", F.length("text").cast("long"))


@query("op2_exact_dedup", """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h
           FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM d""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import exact_dedup
    return exact_dedup(spark, f"{sf_dir.rstrip('/')}/documents.parquet")


# The oracle spells the sentences of these tables itself: whole lines of the text, one licence per sentence.
@query("op4_licenses", """
WITH lines AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS k,
                      unnest(string_split(text, chr(10))) AS line FROM documents),
s AS (SELECT doc_id, k, CASE lower(trim(line))
        WHEN 'licensed under the apache license, version 2.0.' THEN 'apache2-grant'
        WHEN 'released under the mit license.' THEN 'mit-grant'
        WHEN 'this work is licensed under the gnu general public license, version 3.' THEN 'gpl3-grant'
        WHEN 'licensed under cc by-nc 4.0.' THEN 'cc-by-nc-grant'
        WHEN 'all rights reserved.' THEN 'all-rights' END AS sid FROM lines),
n AS (SELECT doc_id, string_agg(sid, ' ' ORDER BY k) AS sentences FROM s WHERE sid IS NOT NULL GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.sentences, '') AS sentences,
       CASE WHEN n.sentences LIKE '%apache2-grant%' THEN 'Apache-2.0' WHEN n.sentences LIKE '%mit-grant%' THEN 'MIT'
            WHEN n.sentences LIKE '%gpl3-grant%' THEN 'GPL-3.0' WHEN n.sentences LIKE '%cc-by-nc-grant%' THEN 'CC-BY-NC'
            WHEN n.sentences LIKE '%all-rights%' THEN 'Proprietary' END AS license
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan_licenses
    out = scan_licenses(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.array_join("sentences", " ").alias("sentences"), "license")


def held_out():
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


@query("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import score_toxicity, train_toxicity
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, train_toxicity(docs, table(spark, sf_dir, "labels")), name="score")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op1_quality")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import score_quality, train_quality
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_quality(docs, train_quality(docs, table(spark, sf_dir, "labels")), name="score").drop("text")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op5_line_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import dedup_lines
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_exact=1)


@query("op7_sharding", """
WITH RECURSIVE h AS (SELECT doc_id, coalesce(strlen(text), 0) AS bytes, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 10) AS BIGINT) AS k
            FROM documents),
p AS (SELECT doc_id, bytes, k, 0 AS depth, sum(bytes) OVER () AS shard_bytes, count(*) OVER () AS documents FROM h
      UNION ALL
      SELECT doc_id, bytes, k, depth + 1, sum(bytes) OVER (PARTITION BY k >> (39 - depth)),
             count(*) OVER (PARTITION BY k >> (39 - depth))
      FROM p WHERE shard_bytes > 16777216 AND documents > 1 AND depth < 40)
SELECT doc_id, bytes, CASE WHEN depth = 0 THEN '' ELSE right(bin((1::BIGINT << 40) | (k >> (40 - depth))), depth) END AS shard,
       CAST(shard_bytes AS BIGINT) AS shard_bytes, documents
FROM p WHERE shard_bytes <= 16777216 OR documents = 1""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import assign_shards
    return assign_shards(table(spark, sf_dir, "documents"))


@query("op11_collocations", r"""
WITH p AS MATERIALIZED (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^.,;:!?\x0A-\x0D]+')) AS piece FROM documents),
w AS MATERIALIZED (SELECT lang, piece, unnest(w) AS w, generate_subscripts(w, 1) AS i
      FROM (SELECT lang, row_number() OVER () AS piece, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p)),
v AS MATERIALIZED (SELECT lang, w AS w1, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3, lead(w, 3) OVER o AS w4, lead(w, 4) OVER o AS w5
      FROM w WINDOW o AS (PARTITION BY piece ORDER BY i)),
g AS (SELECT lang, 1 AS m, w1 AS phrase FROM v UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM v
      UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM v UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM v
      UNION ALL SELECT lang, 5, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5 FROM v),
f AS MATERIALIZED (SELECT lang, m, phrase, count(*) AS a FROM g WHERE phrase IS NOT NULL GROUP BY ALL HAVING count(*) >= 100 OR m = 1),
t AS MATERIALIZED (SELECT lang, sum(a) AS n FROM f WHERE m = 1 GROUP BY 1),
c AS MATERIALIZED (SELECT lang, m, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND a >= 100),
covered AS (SELECT lang, a, array_to_string(w[2:], ' ') AS phrase FROM c UNION ALL SELECT lang, a, array_to_string(w[:-2], ' ') FROM c),
k AS MATERIALIZED (SELECT c.*, k FROM c, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE k < m),
s AS MATERIALIZED (SELECT k.lang, k.phrase, k.a, k.k, l.a AS l, r.a AS r, t.n,
             1000::HUGEINT * k.a * t.n // (l.a::HUGEINT * r.a) AS score
      FROM k JOIN f l ON l.lang = k.lang AND l.phrase = array_to_string(k.w[:k.k], ' ')
             JOIN f r ON r.lang = k.lang AND r.phrase = array_to_string(k.w[k.k + 1:], ' ') JOIN t ON t.lang = k.lang),
b AS (SELECT * FROM s ANTI JOIN covered USING (lang, phrase, a)
      QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM b QUALIFY rank <= 2000""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .collocations import collocations
    return collocations(table(spark, sf_dir, "documents").select("text", "lang"))


@query("op12_url_filter", """
WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path FROM pages),
fits AS (SELECT page_id, host, path,
           CASE WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
                WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
                WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
                WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule FROM u),
ruled AS (SELECT *, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS said FROM fits),
h AS (SELECT host, array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS domain, string_split(host, '.')[-1] AS suffix,
             count(rule) AS n, count(*) FILTER (WHERE said = 'block') AS x FROM ruled GROUP BY 1, 2, 3),
s0 AS (SELECT suffix, CAST(sum(n) AS DOUBLE) AS n, CAST(sum(x) AS DOUBLE) AS x FROM h GROUP BY 1),
s1 AS (SELECT *, (SELECT CASE WHEN sum(n) > 0 THEN (sum(x) + 1) / (sum(n) + 2) ELSE 0.5 END FROM s0) AS m FROM s0),
sr AS (SELECT sum(CAST((x - n * m) * (x - n * m) AS DECIMAL(38, 9))) AS seen, sum(CAST(n * (m * (1 - m)) AS DECIMAL(38, 9))) AS alone,
              sum(CAST(n * (n - 1) * (m * (1 - m)) AS DECIMAL(38, 9))) AS pairs FROM s1),
sk AS (SELECT CASE WHEN pairs > 0 AND seen > alone THEN least(greatest(CAST(pairs AS DOUBLE) / CAST(seen - alone AS DOUBLE) - 1, 1.0), 1000.0) ELSE 1000.0 END AS k FROM sr),
s2 AS (SELECT suffix, (k * m + x) / (k + n) AS mean FROM s1, sk),
d1 AS (SELECT domain, CAST(sum(h.n) AS DOUBLE) AS n, CAST(sum(h.x) AS DOUBLE) AS x, any_value(s2.mean) AS m FROM h JOIN s2 USING (suffix) GROUP BY 1),
dr AS (SELECT sum(CAST((x - n * m) * (x - n * m) AS DECIMAL(38, 9))) AS seen, sum(CAST(n * (m * (1 - m)) AS DECIMAL(38, 9))) AS alone,
              sum(CAST(n * (n - 1) * (m * (1 - m)) AS DECIMAL(38, 9))) AS pairs FROM d1),
dk AS (SELECT CASE WHEN pairs > 0 AND seen > alone THEN least(greatest(CAST(pairs AS DOUBLE) / CAST(seen - alone AS DOUBLE) - 1, 1.0), 1000.0) ELSE 1000.0 END AS k FROM dr),
d2 AS (SELECT domain, (k * m + x) / (k + n) AS mean FROM d1, dk),
h1 AS (SELECT host, CAST(n AS DOUBLE) AS n, CAST(x AS DOUBLE) AS x, d2.mean AS m FROM h JOIN d2 USING (domain)),
hr AS (SELECT sum(CAST((x - n * m) * (x - n * m) AS DECIMAL(38, 9))) AS seen, sum(CAST(n * (m * (1 - m)) AS DECIMAL(38, 9))) AS alone,
              sum(CAST(n * (n - 1) * (m * (1 - m)) AS DECIMAL(38, 9))) AS pairs FROM h1),
hk AS (SELECT CASE WHEN pairs > 0 AND seen > alone THEN least(greatest(CAST(pairs AS DOUBLE) / CAST(seen - alone AS DOUBLE) - 1, 1.0), 1000.0) ELSE 1000.0 END AS k FROM hr),
h2 AS (SELECT host, k * m + x AS a, k * (1 - m) + (n - x) AS b FROM h1, hk)
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN a / (a + b) - 3 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > 0.5
       THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled JOIN h2 USING (host)""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import judge_urls
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


@query("op13_fill_middle", r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
                  regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w FROM documents),
d AS (SELECT doc_id, text, w, len(w) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
             CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM t),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
                  WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT *, array_to_string(w[1:a], '') AS p, array_to_string(w[a + 1:b], '') AS m, array_to_string(w[b + 1:], '') AS s FROM f)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM p""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fill_middle import fill_in_middle, restore
    out = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
                      digest(restore(F.col("form"), F.col("output"))).alias("restored_sha256"))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
