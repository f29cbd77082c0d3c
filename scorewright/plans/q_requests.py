"""Request parts (T12) and the jobs on replies that are stored in the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import rules
from ..functions import prompts as PR
from ..operators import requests as RQ
from . import grading as GR
from . import preprocess as PP
from . import sqlgen as G
from .q_enrich import _CTX_SQL, q_build_context
from .q_files import PRE_FX, PRE_STEPS, failures_by_path
from .q_reports import _SOL_SQL
from .q_reports import _solutions as _solution_folders
from .q_scores import PARSED
from .q_solutions import _ITEMS, _RUBRIC, _UNITS, _solutions
from .q_usage import _cost_sql
from .registry import ORACLES, fx, query, table, with_sql

_AID = "CAST(conv_id % 3 AS VARCHAR)"
_FILLED = "replace(" + G.q(PR.GRADING_INSTRUCTION) + ", '{structural_hint}', h.hint)"


def _part_rows(df, keys, parts):
    return df.select(*keys, F.posexplode(parts).alias("ord", "part")).select(*keys, F.col("ord").cast("bigint").alias("ord"), "part.*")


# ---- T12: every request as ordered parts, a row each -----------------------------------------
@query("grade_request_parts", with_sql(("fx_hints",), [
    ("u", f"SELECT conv_id, turn, {_FILLED} AS filled, '/solutions/Assignment_' || {_AID} || '/parsed_solution.md' AS sol, "
          "'/parsed/' || CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR) || '.md' AS sub "
          f"FROM conversations JOIN fx_hints h ON h.assignment_id = {_AID} WHERE role = 'user'")],
    "SELECT conv_id, turn, CAST(0 AS BIGINT) AS ord, 'text' AS kind, filled AS text, CAST(NULL AS VARCHAR) AS ref FROM u "
    f"UNION ALL SELECT conv_id, turn, 1, 'text', {G.q(PR.MODEL_SOLUTION_HEADER)}, NULL FROM u "
    "UNION ALL SELECT conv_id, turn, 2, 'file', NULL, sol FROM u "
    f"UNION ALL SELECT conv_id, turn, 3, 'text', {G.q(PR.STUDENT_SUBMISSION_HEADER)}, NULL FROM u "
    "UNION ALL SELECT conv_id, turn, 4, 'file', NULL, sub FROM u"))
def q_grade_request_parts(spark, sf_dir):
    u = table(spark, sf_dir, "conversations").filter(F.col("role") == "user").withColumn(
        "assignment_id", (F.col("conv_id") % 3).cast("string")).join(fx(spark, sf_dir, "fx_hints"), "assignment_id")
    sol = F.concat(F.lit("/solutions/Assignment_"), "assignment_id", F.lit("/parsed_solution.md"))
    sub = F.concat(F.lit("/parsed/"), F.col("conv_id").cast("string"), F.lit("_"), F.col("turn").cast("string"), F.lit(".md"))
    return _part_rows(u, ["conv_id", "turn"], PR.grade_parts(F.col("hint"), sol, sub))


@query("parse_request_parts", with_sql(PRE_FX, [*PRE_STEPS, ("ctx", _CTX_SQL),
    ("asked", "SELECT * FROM ctx WHERE submission IN (SELECT submission FROM outputs)")],
    f"SELECT submission, CAST(0 AS BIGINT) AS ord, 'text' AS kind, {G.q(PR.PARSE_INSTRUCTION)} AS text, CAST(NULL AS VARCHAR) AS ref FROM asked "
    "UNION ALL SELECT submission, 1, 'text', context, NULL FROM asked "
    "UNION ALL SELECT submission, 1 + row_number() OVER (PARTITION BY submission ORDER BY channel, output_path), 'file', NULL, output_path FROM outputs"))
def q_parse_request_parts(spark, sf_dir):
    pp = PP.preprocess(fx(spark, sf_dir, "fx_files"), failures_by_path(spark, sf_dir))
    return RQ.parse_request_rows(q_build_context(spark, sf_dir), pp.outputs)


@query("solution_request_parts", with_sql(("fx_hints",), [*_SOL_SQL,
    ("t", "SELECT s.*, replace(" + G.q(PR.SOLUTION_INSTRUCTION) + ", '{structural_hint}', h.hint) AS filled "
          "FROM sol s JOIN fx_hints h ON h.assignment_id = s.assignment_id")],
    f"SELECT assignment_id, 'solution_extract' AS stage, CAST(0 AS BIGINT) AS ord, 'text' AS kind, {G.q(PR.SOLUTION_EXTRACT_INSTRUCTION)} AS text, "
    "CAST(NULL AS VARCHAR) AS ref FROM t UNION ALL SELECT assignment_id, 'solution_extract', 1, 'file', NULL, dir || '/solution.pdf' FROM t "
    "UNION ALL SELECT assignment_id, 'solution_enhance', 0, 'text', filled, NULL FROM t "
    "UNION ALL SELECT assignment_id, 'solution_enhance', 1, 'file', NULL, dir || '/solution_text.txt' FROM t "
    "UNION ALL SELECT assignment_id, 'solution_enhance', 1 + i, 'file', NULL, dir || '/pages/model_solution_page_' || CAST(i AS VARCHAR) || '.png' "
    "FROM (SELECT *, unnest(range(1, n_pages + 1)) AS i FROM t)"))
def q_solution_request_parts(spark, sf_dir):
    s = _solution_folders(spark, sf_dir).select("assignment_id", "dir", "n_pages").join(fx(spark, sf_dir, "fx_hints"), "assignment_id")
    pages = F.transform(F.sequence(F.lit(1), F.col("n_pages")),
                        lambda i: F.concat("dir", F.lit("/pages/model_solution_page_"), i.cast("string"), F.lit(".png")))
    extract = PR.solution_extract_parts(F.concat("dir", F.lit("/solution.pdf")))
    enhance = PR.solution_enhance_parts("hint", F.concat("dir", F.lit("/solution_text.txt")), pages)
    return (_part_rows(s.withColumn("stage", F.lit("solution_extract")), ["assignment_id", "stage"], extract)
            .unionByName(_part_rows(s.withColumn("stage", F.lit("solution_enhance")), ["assignment_id", "stage"], enhance)))


# ---- I5: every user turn is a parsed submission, the assistant's turn after it the grader's reply -----
_SID = "CAST(u.conv_id AS VARCHAR) || '/' || CAST(u.turn AS VARCHAR)"
_BLANK = f"{G.collapse('coalesce(r.report, ' + chr(39) * 2 + ')')} = ''"


@query("grade_pipeline", with_sql(("fx_hints",), [
    ("r", f"SELECT {_SID} AS submission, a.text AS report, {_FILLED} || {G.q(PR.MODEL_SOLUTION_HEADER)} || h.hint || "
          f"{G.q(PR.STUDENT_SUBMISSION_HEADER)} || u.text AS request FROM conversations u "
          "LEFT JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant' "
          "JOIN fx_hints h ON h.assignment_id = CAST(u.conv_id % 3 AS VARCHAR) WHERE u.role = 'user'"),
    ("fx_responses", "SELECT submission, report FROM r WHERE report IS NOT NULL"), *PARSED,
    ("tok", "SELECT submission, 'pro' AS model_type, FALSE AS thinking, (length(request) + 3) // 4 AS p, (length(report) + 3) // 4 AS c FROM r WHERE report IS NOT NULL")],
    f"SELECT r.submission, 'skipped' AS parsing, {G.q(rules.PARSED_EXISTS)} AS parsing_reason, "
    f"CASE WHEN {_BLANK} THEN 'failed' ELSE 'success' END AS grading, CASE WHEN {_BLANK} THEN {G.q(rules.GRADE_FAILED)} ELSE '' END AS grading_reason, "
    f"p.json_status, t.p AS prompt_tokens, t.c AS completion_tokens, {_cost_sql('t.p', 't.c', 't.model_type', 't.thinking')} AS cost_usd "
    "FROM r LEFT JOIN parsed p ON p.submission = r.submission LEFT JOIN tok t ON t.submission = r.submission"))
def q_grade_pipeline(spark, sf_dir):
    pairs = RQ.turn_pairs(table(spark, sf_dir, "conversations")).withColumn(
        "submission", F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")))
    subs = pairs.select("submission", (F.col("conv_id") % 3).cast("string").alias("assignment_id"), "text")
    sol = fx(spark, sf_dir, "fx_hints").select("assignment_id", "hint", F.col("hint").alias("solution"))
    replies = pairs.filter(F.col("reply").isNotNull()).select("submission", F.lit("grading").alias("stage"), F.col("reply").alias("text"))
    out = GR.grade_pipeline(subs, sol, parsed_ledger=subs.select("submission", F.col("text").alias("parsed_text")),
                            answer=RQ.stored_answers(replies))
    use = out["usage"].select("submission", "prompt_tokens", "completion_tokens", "cost_usd")
    return out["status"].select("submission", "parsing", "parsing_reason", "grading", "grading_reason", "json_status").join(use, "submission", "left")


# ---- I6: the solution job on markdown that the tables give -----------------------------------
def _solution_job(spark, sf_dir):
    md = _solutions(spark, sf_dir)
    stored = md.select("assignment_id", F.explode(F.array(F.lit("solution_extract"), F.lit("solution_enhance"))).alias("stage"),
                       F.col("markdown").alias("text"))
    solutions = md.select("assignment_id", F.lit("").alias("hint"), F.col("markdown").alias("solution_text"))
    return GR.solution_pipeline(solutions, answer=RQ.stored_answers(stored, "assignment_id"),
                                rubric=spark.sql(_RUBRIC.format(items=f"({_ITEMS}) i")))


@query("solution_pipeline", ORACLES["solution_checks"])
def q_solution_pipeline(spark, sf_dir):
    return _solution_job(spark, sf_dir)["checks"]


@query("parse_solution_units", ORACLES["solution_units"])
def q_parse_solution_units(spark, sf_dir):
    return _solution_job(spark, sf_dir)["units"].select(
        "assignment_id", "exercise", "title", "header_total", "part", "sub", "prompt", "points", "solution_text")


@query("validate_solution", "SELECT total_ok, CAST(count(*) AS BIGINT) AS exercises, CAST(sum(points_mismatch) AS BIGINT) AS points_mismatch, "
       f"CAST(sum(units_not_in_rubric) AS BIGINT) AS units_not_in_rubric FROM ({ORACLES['solution_checks']}) GROUP BY total_ok")
def q_validate_solution(spark, sf_dir):
    return _solution_job(spark, sf_dir)["checks"].groupBy("total_ok").agg(
        F.count(F.lit(1)).alias("exercises"), F.sum("points_mismatch").alias("points_mismatch"),
        F.sum("units_not_in_rubric").alias("units_not_in_rubric"))
