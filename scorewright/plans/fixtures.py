"""Test-input views over the driver's parquet tables.

The ``fx_*`` views follow FIXTURES.md verbatim (portable SQL that runs on
Spark and DuckDB alike).  ``fx_hints`` additionally derives one hint per order
from ``lineitem`` so the rubric parser's work grows with the data; that part
needs an ordered string aggregate, which the two engines spell differently.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

FX_FILES = """
SELECT CONCAT('S', CAST(CAST(floor(doc_id / 20) AS BIGINT) AS VARCHAR(20))) AS submission,
       CONCAT('/in/S', CAST(CAST(floor(doc_id / 20) AS BIGINT) AS VARCHAR(20)),
              CASE WHEN doc_id % 41 = 2 THEN '/__MACOSX/' WHEN doc_id % 43 = 5 THEN '/processed/' ELSE '/' END,
              CAST(doc_id AS VARCHAR(20)), '/', nm) AS path,
       nm AS name,
       CASE WHEN doc_id % 50 = 7 THEN CAST(0 AS BIGINT)
            WHEN doc_id % 33 = 1 THEN CAST(200 AS BIGINT) * 1048576 + n_chars
            ELSE n_chars END AS size_bytes,
       text AS content, doc_id
FROM (SELECT doc_id, text, n_chars,
        CASE WHEN CAST(floor(doc_id / 20) AS BIGINT) % 17 = 3 THEN '.DS_Store'
             WHEN doc_id % 20 = 0 THEN CONCAT('notes_', CAST(doc_id AS VARCHAR(20)), '.txt')
             WHEN doc_id % 20 = 1 THEN 'Main.PY'
             WHEN doc_id % 20 = 2 THEN 'report.md'
             WHEN doc_id % 20 = 3 THEN 'proof.tex'
             WHEN doc_id % 20 IN (4, 5) THEN 'scan.pdf'
             WHEN doc_id % 20 = 6 THEN 'essay.docx'
             WHEN doc_id % 20 = 7 THEN 'lab.ipynb'
             WHEN doc_id % 20 = 8 THEN 'page.html'
             WHEN doc_id % 20 = 9 THEN 'plot.JPG'
             WHEN doc_id % 20 = 10 THEN 'fig.png'
             WHEN doc_id % 20 = 11 THEN 'all.zip'
             WHEN doc_id % 20 = 12 THEN 'all.tar.gz'
             WHEN doc_id % 20 = 13 THEN 'all.tar.bz2'
             WHEN doc_id % 20 = 14 THEN 'weights.npy'
             WHEN doc_id % 20 = 15 THEN '.hidden.txt'
             WHEN doc_id % 20 = 16 THEN '._a.txt'
             WHEN doc_id % 20 = 17 THEN 'README'
             WHEN doc_id % 20 = 18 THEN 'data.foo'
             ELSE 'scan.pdf' END AS nm
      FROM documents) d
"""

FX_SUBMISSIONS = """
SELECT c_custkey AS submission_id,
       CASE WHEN c_custkey % 7 = 0 THEN c_name
            WHEN c_custkey % 7 = 1 THEN CONCAT('Solo_', CAST(c_custkey AS VARCHAR(20)), '_', CAST(1000 + c_custkey AS VARCHAR(20)))
            WHEN c_custkey % 7 = 2 THEN CONCAT('Van_Der_Berg_', CAST(c_custkey AS VARCHAR(20)), '_', CAST(1000 + c_custkey AS VARCHAR(20)))
            WHEN c_custkey % 7 = 3 THEN CONCAT('only_', CAST(c_custkey AS VARCHAR(20)))
            WHEN c_custkey % 7 = 4 THEN CONCAT('#reports_', CAST(c_custkey AS VARCHAR(20)))
            WHEN c_custkey % 7 = 5 THEN CONCAT('__', CAST(c_custkey AS VARCHAR(20)))
            ELSE CONCAT('Doe_Jane_', CAST(c_custkey AS VARCHAR(20)), '_', CAST(1000 + c_custkey AS VARCHAR(20))) END AS dir_name
FROM customer
"""

FX_HINTS_FIXED = """
SELECT '0' AS assignment_id, CONCAT('Exercise 0.1:', chr(10), 'i)', chr(10), 'a) 2 points', chr(10), 'b) 2 points', chr(10), 'c) 2 points', chr(10), 'ii) 2 points', chr(10), 'Exercise 0.2:', chr(10), 'i) 2 points', chr(10), 'ii) 2 points', chr(10), 'iii) 2 points', chr(10), 'iv) 2 points') AS hint
UNION ALL
SELECT '1', CONCAT('Exercise 1.1:', chr(10), 'i) 3 points', chr(10), 'ii) 4 points', chr(10), 'iii) 1 point', chr(10), 'Exercise 1.2:', chr(10), 'i)', chr(10), 'a) 1 point', chr(10), 'b) 1 point', chr(10), 'c) 2 points', chr(10), 'ii)', chr(10), 'a) 1 point', chr(10), 'b) 1 point', chr(10), 'c) 2 points', chr(10), 'iii)', chr(10), 'a) 1 point', chr(10), 'b) 1 point', chr(10), 'c) 0 points', chr(10), 'Exercise 1.3:', chr(10), '0 points')
UNION ALL
SELECT '2', CONCAT('Exercise 2.1:', chr(10), 'i) [3 points]', chr(10), 'ii) [4 points]', chr(10), '   a) [1.5 points]', chr(10), '   b) [2.5 points]', chr(10), 'Exercise 2.2: 5 points')
"""


def _pts(x: str) -> str:
    return f"CONCAT(CAST({x} AS VARCHAR(20)), CASE WHEN {x} = 1 THEN ' point' ELSE ' points' END)"


_NL = "chr(10)"
_EX = "CONCAT('Exercise ', CAST(l_linenumber AS VARCHAR(20)), '.', CAST(l_partkey AS VARCHAR(20)))"
_Q = "CAST(floor(l_quantity) AS BIGINT)"
_LETTERS = ", ".join(f"{_NL}, '{c}) 1 point'" for c in "abcdefghi")

# One hint block per line item: one-line exercise, points on their own line,
# pointed parts, containers with sub-parts (some running a..j so that 'i)' is
# a letter), and bracketed / indented / decimal points with a stated-sum part.
HINT_BLOCKS = f"""
SELECT CONCAT('L', CAST(l_orderkey AS VARCHAR(20))) AS assignment_id, l_linenumber AS n,
  CASE WHEN {_Q} % 5 = 0 THEN CONCAT({_EX}, ': ', {_pts(f'{_Q} % 6')})
       WHEN {_Q} % 5 = 1 THEN CONCAT({_EX}, ':', {_NL}, {_pts(f'{_Q} % 3')})
       WHEN {_Q} % 5 = 2 THEN CONCAT({_EX}, ':', {_NL}, 'i) ', {_pts('l_partkey % 4')}, {_NL}, 'ii) ', {_pts('l_partkey % 3 + 1')}, {_NL}, 'iii) ', {_pts(f'{_Q} % 2')})
       WHEN {_Q} % 5 = 3 AND l_partkey % 11 = 0 THEN CONCAT({_EX}, ':', {_NL}, 'i)'{', ' + _LETTERS}, {_NL}, 'j) 2 points', {_NL}, 'ii) ', {_pts('l_partkey % 5')})
       WHEN {_Q} % 5 = 3 THEN CONCAT({_EX}, ':', {_NL}, 'i)', {_NL}, 'a) 1 point', {_NL}, 'b) ', {_pts('l_partkey % 5')}, {_NL}, 'ii)', {_NL}, 'a) ', {_pts(f'{_Q} % 4')}, {_NL}, 'b) 2 points', {_NL}, 'c) ', {_pts('l_partkey % 2')})
       ELSE CONCAT({_EX}, ':', {_NL}, 'i) [', CAST(l_partkey % 4 AS VARCHAR(20)), '.5 points]', {_NL}, 'ii) [', CAST({_Q} % 7 AS VARCHAR(20)), ' points]', {_NL}, '   a) [1.5 points]', {_NL}, '   b) [', CAST({_Q} % 7 AS VARCHAR(20)), '.5 points]')
  END AS block
FROM lineitem
"""

FX_HINTS_SPARK = f"""
SELECT * FROM ({FX_HINTS_FIXED}) f
UNION ALL
SELECT assignment_id, array_join(transform(array_sort(collect_list(named_struct('n', n, 'b', block))), x -> x.b), chr(10)) AS hint
FROM ({HINT_BLOCKS}) b GROUP BY assignment_id
"""

FX_HINTS_DUCKDB = f"""
SELECT * FROM ({FX_HINTS_FIXED}) f
UNION ALL
SELECT assignment_id, string_agg(block, chr(10) ORDER BY n, block) AS hint
FROM ({HINT_BLOCKS}) b GROUP BY assignment_id
"""

FX_RESPONSES = """
SELECT o_orderkey AS submission,
       CASE WHEN o_orderkey % 11 = 0 THEN 'No json here.'
            WHEN o_orderkey % 7 = 0 THEN CONCAT('Bad ', fence, 'json', chr(10), '{"Exercise 1.1": {"i": ', chr(10), fence)
            WHEN o_orderkey % 5 = 0 THEN CONCAT('Draft ', fence, 'json {"total": 0}', fence, ' Final ', fence, 'json', chr(10), js, chr(10), fence)
            ELSE CONCAT('Report.', chr(10), fence, 'json', chr(10), js, chr(10), fence, chr(10), 'End.') END AS report
FROM (SELECT o_orderkey, CONCAT(chr(96), chr(96), chr(96)) AS fence,
        CONCAT('{"Exercise 1.1": {"i": ', CAST(o_orderkey % 5 AS VARCHAR(20)),
               ', "ii": {"a": ', CAST(o_custkey % 2 AS VARCHAR(20)), ', "b": ', CAST(o_custkey % 3 AS VARCHAR(20)),
               '}}, "Exercise 1.3": ', CAST(o_orderkey % 4 AS VARCHAR(20)), '.5, "total": ',
               CAST((o_orderkey % 5) + (o_custkey % 2) + (o_custkey % 3) + (o_orderkey % 4) AS VARCHAR(20)),
               CASE WHEN o_orderkey % 13 = 0 THEN '.0' ELSE '.5' END, '}') AS js
      FROM orders) o
"""

# The rubric the fx_responses replies are scored against (FIXTURES.md).
FX_RUBRIC = """
SELECT 'R' AS assignment_id, 1 AS ord, 'Exercise 1.1' AS exercise, 'i' AS part, CAST(NULL AS VARCHAR(20)) AS sub, CAST(3 AS DOUBLE) AS points
UNION ALL SELECT 'R', 2, 'Exercise 1.1', 'ii', 'a', CAST(1 AS DOUBLE)
UNION ALL SELECT 'R', 3, 'Exercise 1.1', 'ii', 'b', CAST(2 AS DOUBLE)
UNION ALL SELECT 'R', 4, 'Exercise 1.3', CAST(NULL AS VARCHAR(20)), CAST(NULL AS VARCHAR(20)), CAST(4 AS DOUBLE)
"""

FX_USAGE = """
SELECT l_orderkey AS submission, l_linenumber AS req,
       CASE WHEN l_linestatus = 'F' THEN 'parsing' ELSE 'grading' END AS stage,
       CASE WHEN l_returnflag = 'R' THEN 'flash' ELSE 'pro' END AS model_type,
       (l_returnflag = 'R' AND l_partkey % 2 = 0) AS thinking,
       CAST(floor(l_extendedprice) AS BIGINT) AS prompt_tokens,
       CAST(l_quantity * 20 AS BIGINT) AS completion_tokens,
       CAST(l_quantity / 2 AS DOUBLE) AS elapsed_s,
       CAST(l_suppkey % 12 AS INT) AS files_processed
FROM lineitem
"""

FX_STAGE_RESULTS = """
SELECT CONCAT('U', CAST(user_id AS VARCHAR(20))) AS submission, event_id AS seq,
       CASE event_type WHEN 'view' THEN 'skipped' WHEN 'error' THEN 'failed' ELSE 'success' END AS parsing,
       CASE event_type WHEN 'purchase' THEN 'success' WHEN 'click' THEN 'skipped' WHEN 'view' THEN 'timeout' WHEN 'error' THEN 'skipped' ELSE 'failed' END AS grading,
       CASE event_type WHEN 'view' THEN 'parsed_submission.md already exists' WHEN 'error' THEN 'Failed to parse submission' ELSE NULL END AS parsing_reason,
       CASE event_type WHEN 'click' THEN 'grading_result.json already exists' WHEN 'error' THEN 'Parsing failed' WHEN 'signup' THEN 'Failed to grade submission' ELSE NULL END AS grading_reason
FROM events
"""

FX_PAGE_IMAGES = """
SELECT user_id AS doc_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS page_no,
       CAST(floor(value * 20) + 1 AS INT) AS width, CAST(event_id % 4096 + 1 AS INT) AS height
FROM events
"""

FX_FAILURES = """
SELECT submission, doc_id AS ord, name AS filename, size_bytes,
       CASE WHEN doc_id % 3 = 0 THEN 'PDF conversion failed: Conversion timeout' ELSE 'Image conversion failed: None' END AS failure_reason,
       CASE WHEN doc_id % 3 = 0 THEN 'PDF' ELSE 'Image' END AS conversion_type
FROM fx_files WHERE doc_id % 20 IN (4, 5, 6, 7, 8) AND CAST(floor(doc_id / 20) AS BIGINT) % 3 = 1
"""

# name -> (spark sql, duckdb sql, fixtures it reads)
FIXTURES = {
    "fx_files": (FX_FILES, FX_FILES, ()),
    "fx_submissions": (FX_SUBMISSIONS, FX_SUBMISSIONS, ()),
    "fx_hints": (FX_HINTS_SPARK, FX_HINTS_DUCKDB, ()),
    "fx_responses": (FX_RESPONSES, FX_RESPONSES, ()),
    "fx_rubric": (FX_RUBRIC, FX_RUBRIC, ()),
    "fx_usage": (FX_USAGE, FX_USAGE, ()),
    "fx_stage_results": (FX_STAGE_RESULTS, FX_STAGE_RESULTS, ()),
    "fx_page_images": (FX_PAGE_IMAGES, FX_PAGE_IMAGES, ()),
    "fx_failures": (FX_FAILURES, FX_FAILURES, ("fx_files",)),
}


def register_tables(spark: SparkSession, sf_dir: str, names=BASE_TABLES) -> None:
    """Temp views over the driver tables (lazy parquet scans, nothing read yet)."""
    for name in names:
        spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").createOrReplaceTempView(name)


def tables_of(name: str) -> list[str]:
    """Base tables that a fixture and the fixtures below it name."""
    text = " ".join(FIXTURES[n][0] for n in (name, *FIXTURES[name][2]))
    return [t for t in BASE_TABLES if re.search(rf"\b(?:FROM|JOIN)\s+{t}\b", text)]


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One fixture as a DataFrame; only the base views that it names are registered."""
    register_tables(spark, sf_dir, tables_of(name))
    for dep in FIXTURES[name][2]:
        spark.sql(FIXTURES[dep][0]).createOrReplaceTempView(dep)
    return spark.sql(FIXTURES[name][0])

