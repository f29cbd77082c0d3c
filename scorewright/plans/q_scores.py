"""Queries over model replies and score trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import paths as P
from ..functions import scores as S
from ..operators import scores as SC
from . import sqlgen as G
from .registry import fx, query, table, with_sql

PARSED = [
    ("p0", f"SELECT submission, {G.last_json('report')} AS json_str FROM fx_responses"),
    ("parsed", "SELECT submission, json_str, CASE WHEN json_str IS NULL THEN 'no_json' "
               "WHEN NOT json_valid(json_str) THEN 'parse_error' ELSE 'ok' END AS json_status FROM p0"),
    ("scores", "SELECT r.submission, e.key AS exercise, p.key AS part, s.key AS sub, "
               "CAST(coalesce(s.value, p.value, e.value) AS DOUBLE) AS points "
               "FROM (SELECT * FROM parsed WHERE json_status = 'ok' AND json_type(json_str) = 'OBJECT') r, "
               "json_each(r.json_str) e "
               "LEFT JOIN LATERAL json_each(CASE WHEN e.type = 'OBJECT' THEN e.value END) p ON true "
               "LEFT JOIN LATERAL json_each(CASE WHEN p.type = 'OBJECT' THEN p.value END) s ON true "
               "WHERE e.key <> 'total' AND coalesce(s.type, p.type, e.type) IN ('UBIGINT', 'BIGINT', 'DOUBLE')"),
]


def _parsed(spark, sf_dir):
    return SC.parse_replies(fx(spark, sf_dir, "fx_responses"))


def _scores(spark, sf_dir):
    return SC.flatten_scores(_parsed(spark, sf_dir))


@query("extract_last_json", with_sql(("fx_responses",), PARSED, "SELECT submission, json_str FROM parsed"))
def q_extract_last_json(spark, sf_dir):
    return fx(spark, sf_dir, "fx_responses").select("submission", S.extract_last_json(F.col("report")).alias("json_str"))


@query("report_json_status", with_sql(("fx_responses",), PARSED,
                                      "SELECT json_status, CAST(count(*) AS BIGINT) AS n FROM parsed GROUP BY json_status"))
def q_report_json_status(spark, sf_dir):
    return _parsed(spark, sf_dir).groupBy("json_status").agg(F.count(F.lit(1)).alias("n"))


@query("flatten_scores", with_sql(("fx_responses",), PARSED, "SELECT * FROM scores"))
def q_flatten_scores(spark, sf_dir):
    return _scores(spark, sf_dir)


@query("score_rollup", with_sql(("fx_responses",), PARSED,
                                "SELECT submission, exercise, part, sum(points) AS points, CAST(count(*) AS BIGINT) AS n_units, "
                                "CAST(GROUPING(submission, exercise, part) AS BIGINT) AS level "
                                "FROM scores GROUP BY ROLLUP (submission, exercise, part)"))
def q_score_rollup(spark, sf_dir):
    return SC.score_rollup(_scores(spark, sf_dir))


@query("total_mismatch", with_sql(("fx_responses",), PARSED,
                                  "SELECT p.submission, CAST(json_extract(p.json_str, '$.total') AS DOUBLE) AS reported_total, "
                                  "coalesce(s.sum_points, CAST(0 AS DOUBLE)) AS sum_points, "
                                  "coalesce(abs(coalesce(s.sum_points, CAST(0 AS DOUBLE)) - CAST(json_extract(p.json_str, '$.total') AS DOUBLE)) > CAST(1e-9 AS DOUBLE), true) AS mismatch "
                                  "FROM parsed p LEFT JOIN (SELECT submission, sum(points) AS sum_points FROM scores GROUP BY 1) s "
                                  "ON s.submission = p.submission WHERE p.json_status = 'ok' AND json_type(p.json_str) = 'OBJECT'"))
def q_total_mismatch(spark, sf_dir):
    parsed = _parsed(spark, sf_dir).filter(F.expr("schema_of_variant(v) LIKE 'OBJECT%'"))
    return SC.total_mismatch(parsed, SC.flatten_scores(parsed))


@query("rubric_check", with_sql(("fx_responses", "fx_rubric"), PARSED + [
    ("expected", "SELECT p.submission, r.exercise, r.part, r.sub, r.points AS max_points FROM parsed p "
                 "JOIN fx_rubric r ON r.assignment_id = 'R' WHERE p.json_status = 'ok'")],
    "SELECT coalesce(s.submission, e.submission) AS submission, coalesce(s.exercise, e.exercise) AS exercise, "
    "CASE WHEN s.submission IS NULL THEN e.part ELSE s.part END AS part, "
    "CASE WHEN s.submission IS NULL THEN e.sub ELSE s.sub END AS sub, "
    "CASE WHEN s.submission IS NULL THEN 'missing' WHEN e.submission IS NULL THEN 'unexpected' ELSE 'matched' END AS status, "
    "s.points AS points, e.max_points AS max_points, coalesce(s.points > e.max_points, false) AS over_max "
    "FROM scores s FULL OUTER JOIN expected e ON s.submission = e.submission AND s.exercise IS NOT DISTINCT FROM e.exercise "
    "AND s.part IS NOT DISTINCT FROM e.part AND s.sub IS NOT DISTINCT FROM e.sub"))
def q_rubric_check(spark, sf_dir):
    """Every reply here answers assignment 'R'."""
    rubric = fx(spark, sf_dir, "fx_rubric").select("assignment_id", "exercise", "part", "sub", F.col("points").alias("max_points"))
    return SC.rubric_check(_parsed(spark, sf_dir).withColumn("assignment_id", F.lit("R")), rubric)


_DIR_RE = G.q(P.DIR_RE)
STUDENT_SQL = (
    f"CASE WHEN regexp_matches(dir_name, {_DIR_RE}) THEN split_part(regexp_extract(dir_name, {_DIR_RE}, 1), '_', 1) ELSE dir_name END AS last_name, "
    f"CASE WHEN NOT regexp_matches(dir_name, {_DIR_RE}) THEN '' "
    f"WHEN strpos(regexp_extract(dir_name, {_DIR_RE}, 1), '_') > 0 THEN regexp_extract(regexp_extract(dir_name, {_DIR_RE}, 1), '^(?s)[^_]*_(.*)$', 1) "
    f"ELSE regexp_extract(dir_name, {_DIR_RE}, 1) END AS first_name, "
    f"CASE WHEN regexp_matches(dir_name, {_DIR_RE}) THEN regexp_extract(dir_name, {_DIR_RE}, 2) ELSE 'unknown' END AS student_id, "
    f"CASE WHEN regexp_matches(dir_name, {_DIR_RE}) THEN regexp_extract(dir_name, {_DIR_RE}, 3) ELSE 'unknown' END AS matriculation_number")


@query("student_details", with_sql(("fx_submissions",), [], f"SELECT submission_id, dir_name, {STUDENT_SQL} FROM fx_submissions"))
def q_student_details(spark, sf_dir):
    s = fx(spark, sf_dir, "fx_submissions")
    return s.select("submission_id", "dir_name", P.student_details(F.col("dir_name")).alias("d")).select(
        "submission_id", "dir_name", "d.*")


@query("combine_results", with_sql(("fx_responses", "fx_submissions"), PARSED + [
    ("st", f"SELECT submission_id, dir_name, {STUDENT_SQL} FROM fx_submissions")],
    "SELECT p.submission, st.dir_name, st.last_name, st.first_name, st.student_id, st.matriculation_number, "
    "p.json_status, CASE WHEN p.json_status = 'ok' THEN p.json_str END AS grading_results, "
    "CASE WHEN p.json_status = 'parse_error' THEN 'Failed to parse grading results' END AS error "
    "FROM parsed p JOIN orders o ON o.o_orderkey = p.submission JOIN st ON st.submission_id = o.o_custkey"))
def q_combine_results(spark, sf_dir):
    parsed = _parsed(spark, sf_dir)
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("submission"), "o_custkey")
    st = fx(spark, sf_dir, "fx_submissions").select(
        F.col("submission_id").alias("o_custkey"), "dir_name", P.student_details(F.col("dir_name")).alias("d"))
    students = orders.join(st, "o_custkey").select("submission", "dir_name", "d.last_name", "d.first_name", "d.student_id", "d.matriculation_number")
    return SC.combine_results(parsed, students).drop("stored")


@query("stored_results", with_sql(("fx_responses",), PARSED, "SELECT submission, json_status, CASE WHEN json_status = 'parse_error' THEN "
       "CAST(to_json(struct_pack(error := 'Failed to parse grading results', raw_json_str := json_str)) AS VARCHAR) END AS fallback FROM parsed"))
def q_stored_results(spark, sf_dir):
    """The fallback object of replies that do not parse; the others' objects are compared by flatten_scores."""
    stored = S.grading_results_json(F.col("json_str"))
    return _parsed(spark, sf_dir).select("submission", "json_status", F.when(F.col("json_status") == "parse_error", stored).alias("fallback"))


def _kv(k, v):
    return f"CAST(to_json({k}) AS VARCHAR) || ':' || {v}"


@query("nest_scores", with_sql(("fx_responses",), PARSED + [
    ("l3", f"SELECT submission, exercise, part, '{{' || string_agg({_kv('sub', 'CAST(points AS VARCHAR)')}, ',' ORDER BY "
           f"{_kv('sub', 'CAST(points AS VARCHAR)')}) || '}}' AS node FROM scores WHERE sub IS NOT NULL GROUP BY 1, 2, 3"),
    ("l2in", "SELECT submission, exercise, part, node FROM l3 UNION ALL "
             "SELECT submission, exercise, part, CAST(points AS VARCHAR) FROM scores WHERE part IS NOT NULL AND sub IS NULL"),
    ("l2", f"SELECT submission, exercise, '{{' || string_agg({_kv('part', 'node')}, ',' ORDER BY {_kv('part', 'node')}) || '}}' AS node "
           "FROM l2in GROUP BY 1, 2"),
    ("l1in", "SELECT submission, exercise, node FROM l2 UNION ALL SELECT submission, exercise, CAST(points AS VARCHAR) FROM scores WHERE part IS NULL")],
    f"SELECT submission, '{{' || string_agg({_kv('exercise', 'node')}, ',' ORDER BY {_kv('exercise', 'node')}) || '}}' AS scores_json "
    "FROM l1in GROUP BY submission"))
def q_nest_scores(spark, sf_dir):
    return SC.nest_scores(_scores(spark, sf_dir))
