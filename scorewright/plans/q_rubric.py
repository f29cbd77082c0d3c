"""Rubric queries (W1, A6, T13) over fixed and generated structure hints."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import prompts as PR
from ..operators import rubric as RB
from . import sqlgen as G
from .registry import fx, query, with_sql

W1_STEPS = [
    ("hl", "SELECT assignment_id, CAST(generate_subscripts(arr, 1) AS INTEGER) AS ord, regexp_replace(unnest(arr), '\\r$', '') AS line "
           "FROM (SELECT assignment_id, string_split(hint, chr(10)) AS arr FROM fx_hints)"),
    ("h1", f"SELECT *, nullif(regexp_extract(line, {G.q(RB.EXERCISE_RE)}, 1), '') AS ex_id FROM hl"),
    ("h2", f"SELECT *, CASE WHEN ex_id IS NULL THEN nullif(lower(regexp_extract(line, {G.q(RB.MARKER_RE)}, 1)), '') END AS marker FROM h1"),
    ("h3", f"SELECT *, (ex_id IS NULL AND marker IS NULL AND regexp_matches(line, {G.q(RB.BARE_POINTS_RE)})) AS bare FROM h2"),
    ("h4", "SELECT *, CASE WHEN ex_id IS NOT NULL THEN TRY_CAST(nullif(regexp_extract(regexp_extract(line, "
           f"{G.q(RB.EXERCISE_RE)}, 2), {G.q(RB.POINTS_RE)}, 1), '') AS DOUBLE) "
           f"WHEN marker IS NOT NULL THEN TRY_CAST(nullif(regexp_extract(regexp_extract(line, {G.q(RB.MARKER_RE)}, 2), {G.q(RB.POINTS_RE)}, 1), '') AS DOUBLE) "
           f"WHEN bare THEN CAST(regexp_extract(line, {G.q(RB.BARE_POINTS_RE)}, 1) AS DOUBLE) END AS pts, "
           "last_value(CASE WHEN ex_id IS NOT NULL THEN 'Exercise ' || ex_id END IGNORE NULLS) OVER "
           "(PARTITION BY assignment_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS exercise FROM h3"),
    ("h5", "SELECT *, last_value(CASE WHEN ex_id IS NOT NULL THEN '#' ELSE marker END IGNORE NULLS) OVER (PARTITION BY assignment_id "
           "ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_marker FROM h4"),
    ("h6", f"SELECT *, marker IS NOT NULL AND regexp_matches(marker, {G.q(RB.ROMAN_RE)}) AND NOT coalesce(prev_marker = "
           "(CASE marker WHEN 'i' THEN 'h' WHEN 'v' THEN 'u' WHEN 'x' THEN 'w' END), false) AS is_roman FROM h5"),
    ("h7", "SELECT *, nullif(last_value(CASE WHEN ex_id IS NOT NULL THEN '#' WHEN is_roman THEN marker END IGNORE NULLS) OVER "
           "(PARTITION BY assignment_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '#') AS cur_part FROM h6"),
    ("h8", "SELECT *, CASE WHEN ex_id IS NOT NULL OR bare THEN 'exercise' WHEN is_roman OR (marker IS NOT NULL AND cur_part IS NULL) "
           "THEN 'part' WHEN marker IS NOT NULL THEN 'sub' END AS level FROM h7"),
    ("h9", "SELECT *, CASE WHEN level = 'part' THEN marker WHEN level = 'sub' THEN cur_part END AS part, "
           "sum(CASE WHEN level = 'sub' AND pts IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY assignment_id ORDER BY ord "
           "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c FROM h8"),
    ("h10", "SELECT *, coalesce(first_value(CASE WHEN level IN ('part', 'exercise') THEN c END IGNORE NULLS) OVER (PARTITION BY assignment_id "
            "ORDER BY ord ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), last_value(c) OVER (PARTITION BY assignment_id ORDER BY ord "
            "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) - c AS pointed_children FROM h9"),
    ("rubric", "SELECT assignment_id, ord, exercise, CASE WHEN level = 'exercise' THEN NULL ELSE part END AS part, "
               "CASE WHEN level = 'sub' THEN marker END AS sub, pts AS points FROM h10 "
               "WHERE pts IS NOT NULL AND (level <> 'part' OR pointed_children = 0)"),
]


def _rubric(spark, sf_dir):
    return RB.parse_structure_hint(fx(spark, sf_dir, "fx_hints"))


@query("parse_rubric", with_sql(("fx_hints",), W1_STEPS, "SELECT * FROM rubric"))
def q_parse_rubric(spark, sf_dir):
    return _rubric(spark, sf_dir)


@query("rubric_totals", with_sql(("fx_hints",), W1_STEPS, "SELECT assignment_id, exercise, sum(points) AS total_points, "
                                 "CAST(count(*) AS BIGINT) AS n_units FROM rubric GROUP BY assignment_id, exercise"))
def q_rubric_totals(spark, sf_dir):
    return RB.rubric_totals(_rubric(spark, sf_dir))


@query("fill_hint", with_sql(("fx_hints",), [], f"SELECT assignment_id, replace({G.q(PR.GRADING_INSTRUCTION)}, "
                             "'{structural_hint}', hint) AS instruction FROM fx_hints"))
def q_fill_hint(spark, sf_dir):
    h = fx(spark, sf_dir, "fx_hints")
    return h.select("assignment_id", PR.fill_hint(PR.GRADING_INSTRUCTION, F.col("hint")).alias("instruction"))
