"""Solution markdown written by SQL, one exercise per line item, with wrong totals and units that the rubric knows
otherwise; the oracles state the units as generated and parse nothing (T9, T10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rubric as RB
from .registry import query, register_tables, with_sql

# per line item: kind of exercise, points, stated total
_ITEMS = """
SELECT CONCAT('L', CAST(l_orderkey AS VARCHAR(20))) AS assignment_id, l_linenumber AS n,
       CONCAT(CAST(l_linenumber AS VARCHAR(20)), '.', CAST(l_partkey AS VARCHAR(20)), '.',
              CAST(l_suppkey AS VARCHAR(20)), '.', CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR(20))) AS num,
       CAST(floor(l_quantity) AS BIGINT) % 3 AS kind, l_partkey % 4 + 2 AS a, CAST(floor(l_quantity) AS BIGINT) % 5 + 2 AS b,
       CASE WHEN l_partkey % 7 = 0 THEN 1 ELSE 0 END AS off, l_suppkey % 5 AS variant
FROM lineitem
"""

# kind 0: a sole unit; kind 1: two parts; kind 2: a container with two sub-parts
_MARKDOWN = f"""
SELECT assignment_id, n, CONCAT('## Exercise ', num, ' (Title of ', num, '). (Total: ',
  CAST(CASE WHEN kind = 0 THEN a WHEN kind = 1 THEN a + b ELSE a + 1 END + off AS VARCHAR(20)), ' points)', chr(10),
  CASE WHEN kind = 0 THEN CONCAT('(i) The question. [', CAST(a AS VARCHAR(20)), ' points]', chr(10), '**Solution.**', chr(10), 'First line', chr(10), chr(10), 'last line of ', num)
       WHEN kind = 1 THEN CONCAT('(i) Question one [', CAST(a AS VARCHAR(20)), ' points]', chr(10), '**Solution.**', chr(10), 'One of ', num, chr(10),
                                 '(ii) Question two [', CAST(b AS VARCHAR(20)), '.0 points]', chr(10), '**Solution.**', chr(10), 'Two')
       ELSE CONCAT('(i) Both of these', chr(10), '(a) Sub one [', CAST(a AS VARCHAR(20)), ' points]', chr(10), '**Solution.**', chr(10), 'Sub one of ', num, chr(10),
                   '(b) Sub two [1 point]', chr(10), '**Solution.**', chr(10), 'Sub two') END) AS block
FROM ({_ITEMS}) i
"""

_UNITS = [("it", _ITEMS), ("units", """
SELECT assignment_id, 'Exercise ' || num AS exercise, kind, variant, 'Title of ' || num AS title,
       CAST(CASE WHEN kind = 0 THEN a WHEN kind = 1 THEN a + b ELSE a + 1 END + off AS DOUBLE) AS header_total,
       CASE WHEN kind = 1 THEN 'i' WHEN kind = 2 THEN 'i' END AS part, CASE WHEN kind = 2 THEN 'a' END AS sub,
       CASE kind WHEN 0 THEN 'The question.' WHEN 1 THEN 'Question one' ELSE 'Sub one' END AS prompt, CAST(a AS DOUBLE) AS points,
       CASE kind WHEN 0 THEN 'First line' || chr(10) || chr(10) || 'last line of ' || num WHEN 1 THEN 'One of ' || num ELSE 'Sub one of ' || num END AS solution_text
FROM it
UNION ALL
SELECT assignment_id, 'Exercise ' || num, kind, variant, 'Title of ' || num, CAST(CASE WHEN kind = 1 THEN a + b ELSE a + 1 END + off AS DOUBLE),
       CASE WHEN kind = 1 THEN 'ii' ELSE 'i' END, CASE WHEN kind = 2 THEN 'b' END, CASE WHEN kind = 1 THEN 'Question two' ELSE 'Sub two' END,
       CAST(CASE WHEN kind = 1 THEN b ELSE 1 END AS DOUBLE), CASE WHEN kind = 1 THEN 'Two' ELSE 'Sub two' END
FROM it WHERE kind > 0""")]

# what the rubric says: variant 0 of kind 1 has a third part, variant 1 one point more, variant 2 of kind 2 no second sub-part
_RUBRIC = """
SELECT assignment_id, CONCAT('Exercise ', num) AS exercise, CASE WHEN kind > 0 THEN 'i' END AS part, CASE WHEN kind = 2 THEN 'a' END AS sub,
       CAST(a + CASE WHEN variant = 1 THEN 1 ELSE 0 END AS DOUBLE) AS points FROM {items}
UNION ALL SELECT assignment_id, CONCAT('Exercise ', num), 'ii', CAST(NULL AS VARCHAR(20)), CAST(b AS DOUBLE) FROM {items} WHERE kind = 1
UNION ALL SELECT assignment_id, CONCAT('Exercise ', num), 'iii', CAST(NULL AS VARCHAR(20)), CAST(2 AS DOUBLE) FROM {items} WHERE kind = 1 AND variant = 0
UNION ALL SELECT assignment_id, CONCAT('Exercise ', num), 'i', 'b', CAST(1 AS DOUBLE) FROM {items} WHERE kind = 2 AND variant <> 2
"""


def _solutions(spark, sf_dir):
    """The markdown of every assignment.  Line items are dealt by assignment as they are stored, not as text, which is larger."""
    register_tables(spark, sf_dir, ["lineitem"])
    items = spark.table("lineitem")
    items.repartition(F.concat(F.lit("L"), F.col("l_orderkey").cast("string"))).createOrReplaceTempView("lineitem")
    blocks = spark.sql(_MARKDOWN)  # they lie by their assignment_id now
    items.createOrReplaceTempView("lineitem")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "block"))), lambda x: x["block"]), "\n")
    return blocks.groupBy("assignment_id").agg(text.alias("markdown"))


@query("solution_units", with_sql((), _UNITS, "SELECT assignment_id, exercise, title, header_total, part, sub, prompt, points, solution_text FROM units"))
def q_solution_units(spark, sf_dir):
    return RB.parse_solution_units(_solutions(spark, sf_dir)).select(
        "assignment_id", "exercise", "title", "header_total", "part", "sub", "prompt", "points", "solution_text")


@query("solution_checks", with_sql((), _UNITS, """
SELECT assignment_id, exercise, max(header_total) AS header_total, sum(points) AS unit_points,
       CAST(max(CASE WHEN kind = 2 AND variant = 2 THEN 1 ELSE 0 END) AS BIGINT) AS units_not_in_rubric,
       CAST(max(CASE WHEN kind = 1 AND variant = 0 THEN 1 ELSE 0 END) AS BIGINT) AS units_omitted,
       CAST(max(CASE WHEN variant = 1 THEN 1 ELSE 0 END) AS BIGINT) AS points_mismatch,
       max(header_total) = sum(points) AND NOT max(kind = 1 AND variant = 0) AS total_ok
FROM units GROUP BY assignment_id, exercise"""))
def q_solution_checks(spark, sf_dir):
    units = RB.parse_solution_units(_solutions(spark, sf_dir))
    return RB.validate_solution(units, spark.sql(_RUBRIC.format(items=f"({_ITEMS}) i")))
