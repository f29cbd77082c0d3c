"""Status, ledger and report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import rules
from ..functions import paths as P
from ..functions import text as X
from ..operators import ledger as L
from ..operators import reports as R
from ..operators.solutions import add_parsed_path, manifest_json
from . import sqlgen as G
from .registry import fx, query, table, with_sql

LATEST = [("latest", "SELECT submission, seq, parsing, grading, parsing_reason, grading_reason FROM fx_stage_results "
                     "QUALIFY row_number() OVER (PARTITION BY submission ORDER BY seq DESC) = 1"),
          ("srows", "SELECT submission, 'parsing' AS stage, CASE WHEN parsing IN ('success', 'skipped') THEN parsing ELSE 'failed' END AS status, "
                    "coalesce(parsing_reason, 'Unknown') AS reason FROM latest UNION ALL "
                    "SELECT submission, 'grading', CASE WHEN grading IN ('success', 'skipped') THEN grading ELSE 'failed' END, "
                    "coalesce(grading_reason, 'Unknown') FROM latest")]


def _latest(spark, sf_dir):
    return R.latest_result(fx(spark, sf_dir, "fx_stage_results"))


@query("latest_result", with_sql(("fx_stage_results",), LATEST, "SELECT * FROM latest"))
def q_latest_result(spark, sf_dir):
    return _latest(spark, sf_dir)


@query("processing_report", with_sql(("fx_stage_results",), LATEST,
                                     "SELECT stage, status, CAST(count(*) AS BIGINT) AS n FROM srows GROUP BY stage, status"))
def q_processing_report(spark, sf_dir):
    return R.processing_report(_latest(spark, sf_dir))


@query("report_pivot", with_sql(("fx_stage_results",), LATEST,
                                "SELECT stage, CAST(count_if(status = 'success') AS BIGINT) AS success, "
                                "CAST(count_if(status = 'skipped') AS BIGINT) AS skipped, "
                                "CAST(count_if(status = 'failed') AS BIGINT) AS failed FROM srows GROUP BY stage"))
def q_report_pivot(spark, sf_dir):
    return R.report_pivot(_latest(spark, sf_dir))


@query("report_details", with_sql(("fx_stage_results",), LATEST, "SELECT stage, status, submission, reason FROM srows"))
def q_report_details(spark, sf_dir):
    """L1/K5: the name lists of the report as rows (sorted when written)."""
    return R.stage_rows(_latest(spark, sf_dir)).select("stage", "status", "submission", "reason")


@query("run_summary", with_sql(("fx_stage_results",), LATEST,
                               "SELECT CAST(count(*) AS BIGINT) AS total, CAST(count_if(grading = 'success') AS BIGINT) AS successful, "
                               "CAST(count_if(grading = 'skipped') AS BIGINT) AS skipped, "
                               "CAST(count(*) - count_if(grading = 'success') AS BIGINT) AS failed_reported, "
                               "CAST(count(*) - count_if(grading = 'success') - count_if(grading = 'skipped') AS BIGINT) AS failed FROM latest"))
def q_run_summary(spark, sf_dir):
    return R.run_summary(_latest(spark, sf_dir))


# ---- J1-J3 over documents / labels / customers --------------------------------
@query("pending_grading", "SELECT d.doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def q_pending_grading(spark, sf_dir):
    return L.pending(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id")


@query("already_graded", "SELECT d.doc_id FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def q_already_graded(spark, sf_dir):
    return L.already_done(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id")


_PROCESSED = "SELECT DISTINCT o_custkey AS submission_id FROM orders WHERE o_orderstatus = 'F'"


def _processed(spark, sf_dir):
    """'processed/' exists for customers with a finished order."""
    return table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F").select(
        F.col("o_custkey").alias("submission_id"))


@query("not_preprocessed", with_sql(("fx_submissions",), [("done", _PROCESSED)],
                                    "SELECT submission_id, dir_name FROM fx_submissions WHERE NOT starts_with(dir_name, '#') "
                                    "AND submission_id NOT IN (SELECT submission_id FROM done)"))
def q_not_preprocessed(spark, sf_dir):
    subs = fx(spark, sf_dir, "fx_submissions").filter(~F.col("dir_name").startswith("#"))
    return L.not_preprocessed(subs, _processed(spark, sf_dir), "submission_id")


@query("invalid_summary", with_sql(("fx_submissions",), [
    ("done", _PROCESSED),
    ("subs", "SELECT * FROM fx_submissions WHERE NOT starts_with(dir_name, '#')"),
    ("inv", "SELECT submission_id, 'not_preprocessed' AS kind FROM subs WHERE submission_id NOT IN (SELECT submission_id FROM done) "
            f"UNION ALL SELECT submission_id, 'invalid' FROM subs WHERE NOT regexp_matches(dir_name, {G.q(P.DIR_RE)})")],
    "SELECT coalesce(kind, 'all') AS kind, CAST(count(DISTINCT submission_id) AS BIGINT) AS n FROM inv GROUP BY CUBE (kind)"))
def q_invalid_summary(spark, sf_dir):
    subs = fx(spark, sf_dir, "fx_submissions").filter(~F.col("dir_name").startswith("#"))
    npre = L.not_preprocessed(subs, _processed(spark, sf_dir), "submission_id").select(
        "submission_id", F.lit("not_preprocessed").alias("kind"))
    bad = subs.filter(~F.col("dir_name").rlike(P.DIR_RE)).select("submission_id", F.lit("invalid").alias("kind"))
    return R.invalid_summary(npre.unionByName(bad), "submission_id")


# ---- I3 / I8 over documents + labels ------------------------------------------
def _stage_inputs(spark, sf_dir):
    """parsed_exists = labelled; graded_exists = labelled good quality; the
    parse call fails on a blank reply (the document text), the grade call on
    text with nothing extractable."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    j = docs.join(lab, "doc_id", "left")
    return j.select("doc_id", F.col("quality").isNotNull().alias("parsed_exists"),
                    F.coalesce(F.col("quality") == 1, F.lit(False)).alias("graded_exists"),
                    (X.collapse_ws(F.coalesce(F.col("text"), F.lit(""))) != "").alias("reply_ok"),
                    X.has_extractable_text(F.col("text")).alias("gradable"))


_INPUTS_SQL = [("inp", "SELECT d.doc_id, l.quality IS NOT NULL AS parsed_exists, coalesce(l.quality = 1, false) AS graded_exists, "
                       f"{G.collapse('coalesce(d.text, ' + chr(39) + chr(39) + ')')} <> '' AS reply_ok, {G.has_text('d.text')} AS gradable "
                       "FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")]


def _plan_sql(mode):
    dp = "true" if mode == "full" else "NOT parsed_exists"
    dg = "true" if mode in ("regrade", "full") else "NOT graded_exists"
    return f"SELECT *, {dp} AS do_parse, {dg} AS do_grade FROM inp"


@query("regrade_plan", with_sql((), _INPUTS_SQL + [("p_" + m, _plan_sql(m)) for m in L.MODES],
                                " UNION ALL ".join(f"SELECT '{m}' AS mode, doc_id, do_parse, do_grade FROM p_{m}" for m in L.MODES)))
def q_regrade_plan(spark, sf_dir):
    inp = _stage_inputs(spark, sf_dir)
    out = None
    for m in L.MODES:
        p = L.stage_plan(inp, m).select(F.lit(m).alias("mode"), "doc_id", "do_parse", "do_grade")
        out = p if out is None else out.unionByName(p)
    return out


@query("stage_status", with_sql((), _INPUTS_SQL + [
    ("p", _plan_sql("incremental")),
    ("c", "SELECT *, CASE WHEN do_parse THEN reply_ok END AS parse_ok, "
          "CASE WHEN do_grade AND (NOT do_parse OR reply_ok) THEN gradable END AS grade_ok FROM p")],
    "SELECT doc_id, "
    "CASE WHEN NOT do_parse THEN 'skipped' WHEN parse_ok THEN 'success' ELSE 'failed' END AS parsing, "
    "CASE WHEN do_parse AND NOT coalesce(parse_ok, false) THEN 'skipped' WHEN NOT do_grade THEN 'skipped' WHEN grade_ok THEN 'success' ELSE 'failed' END AS grading, "
    f"CASE WHEN NOT do_parse THEN {G.q(rules.PARSED_EXISTS)} WHEN parse_ok THEN '' ELSE {G.q(rules.PARSE_FAILED)} END AS parsing_reason, "
    f"CASE WHEN do_parse AND NOT coalesce(parse_ok, false) THEN {G.q(rules.PARSING_FAILED_FOR_GRADE)} WHEN NOT do_grade THEN {G.q(rules.GRADED_EXISTS)} "
    f"WHEN grade_ok THEN '' ELSE {G.q(rules.GRADE_FAILED)} END AS grading_reason FROM c"))
def q_stage_status(spark, sf_dir):
    plan = L.stage_plan(_stage_inputs(spark, sf_dir), "incremental")
    calls = (plan.withColumn("parse_ok", F.when(F.col("do_parse"), F.col("reply_ok")))
             .withColumn("grade_ok", F.when(F.col("do_grade") & (~F.col("do_parse") | F.col("reply_ok")), F.col("gradable"))))
    return L.stage_status(calls).select("doc_id", "parsing", "grading", "parsing_reason", "grading_reason")


# ---- solutions: K4, S5, J4 ------------------------------------------------------
def _solutions(spark, sf_dir):
    h = fx(spark, sf_dir, "fx_hints")
    d = F.concat(F.lit("/solutions/Assignment_"), F.col("assignment_id"))
    return h.select("assignment_id", d.alias("dir"), (F.length("hint") % 9 + 1).cast("int").alias("n_pages"),
                    F.length("hint").alias("hint_len"))


_SOL_SQL = [("sol", "SELECT assignment_id, '/solutions/Assignment_' || assignment_id AS dir, "
                    "CAST(length(hint) % 9 + 1 AS INTEGER) AS n_pages, length(hint) AS hint_len FROM fx_hints")]


_MANIFEST_SQL = ("CAST(to_json(struct_pack(assignment_id := assignment_id, solution_pdf := dir || '/solution.pdf', "
                 "solution_text_path := dir || '/solution_text.txt', structure_hint_path := dir || '/structure_hint.txt', "
                 "solution_images := list_transform(range(1, n_pages + 1), lambda i: dir || '/pages/model_solution_page_' || CAST(i AS VARCHAR) || '.png'))) AS VARCHAR)")


@query("solution_manifest", with_sql(("fx_hints",), _SOL_SQL, f"SELECT assignment_id, {_MANIFEST_SQL} AS manifest FROM sol"))
def q_solution_manifest(spark, sf_dir):
    s = _solutions(spark, sf_dir)
    return s.select("assignment_id", manifest_json(F.col("dir"), F.col("assignment_id"), F.col("n_pages")).alias("manifest"))


@query("solution_manifest_parsed", with_sql(("fx_hints",), _SOL_SQL, "SELECT assignment_id, dir_ok AS valid, CASE WHEN NOT dir_ok THEN "
       "'Structure hint file not found: ' || hint_path END AS invalid_reason, dir || '/parsed_solution.md' AS solution_path, hint_path FROM "
       "(SELECT *, hint_len % 5 <> 0 AS dir_ok, dir || '/structure_hint.txt' AS hint_path FROM sol)"))
def q_solution_manifest_parsed(spark, sf_dir):
    """K4 written, read back, given its parsed solution, and checked by S5."""
    import uuid
    from .. import sinks
    from ..session import shared_dir
    from ..sources.files import check_solution_manifest
    s, path = _solutions(spark, sf_dir), shared_dir(spark, f"manifests/{uuid.uuid4().hex}")
    sinks.write_manifests(s.select("assignment_id", "dir", manifest_json(F.col("dir"), F.col("assignment_id"), F.col("n_pages")).alias("manifest")),
                          path, "2026-01-05")
    back = sinks.read_runs(spark, path, "assignment_id string, dir string, manifest string")
    done = add_parsed_path(back, F.concat("dir", F.lit("/parsed_solution.md")))
    listing = s.select(F.concat("dir", F.lit("/parsed_solution.md")).alias("path")).unionByName(
        s.filter(F.col("hint_len") % 5 != 0).select(F.concat("dir", F.lit("/structure_hint.txt")).alias("path")))
    return check_solution_manifest(done.select("assignment_id", "manifest"), listing)


@query("attach_solution", with_sql(("fx_responses", "fx_hints"), _SOL_SQL,
                                   "SELECT r.submission, s.assignment_id, s.dir || '/solution.pdf' AS solution_pdf, s.n_pages "
                                   "FROM fx_responses r JOIN sol s ON s.assignment_id = 'L' || CAST(r.submission AS VARCHAR)"))
def q_attach_solution(spark, sf_dir):
    subs = fx(spark, sf_dir, "fx_responses").select(
        "submission", F.concat(F.lit("L"), F.col("submission").cast("string")).alias("assignment_id"))
    sol = _solutions(spark, sf_dir).select("assignment_id", F.concat("dir", F.lit("/solution.pdf")).alias("solution_pdf"), "n_pages")
    return L.attach_solution(subs, sol).select("submission", "assignment_id", "solution_pdf", "n_pages")


# ---- S5: manifests with broken variants, checked against a file listing ------------
def _manifests(spark, sf_dir):
    s = _solutions(spark, sf_dir)
    full = F.to_json(F.struct(F.col("assignment_id"), F.concat("dir", F.lit("/parsed_solution.md")).alias("parsed_solution_path"),
                              F.concat("dir", F.lit("/structure_hint.txt")).alias("structure_hint_path")))
    no_key = F.to_json(F.struct(F.col("assignment_id"), F.concat("dir", F.lit("/structure_hint.txt")).alias("structure_hint_path")))
    text = (F.when(F.col("hint_len") % 11 == 0, F.substring(full, 1, 20))
            .when(F.col("hint_len") % 4 == 0, no_key).otherwise(full))
    listing = s.filter(F.col("hint_len") % 3 != 0).select(F.concat("dir", F.lit("/parsed_solution.md")).alias("path")) \
        .unionByName(s.filter(F.col("hint_len") % 5 != 0).select(F.concat("dir", F.lit("/structure_hint.txt")).alias("path")))
    return s.select("assignment_id", text.alias("manifest")), listing


@query("solution_manifest_check", with_sql(("fx_hints",), _SOL_SQL + [
    ("m", "SELECT assignment_id, dir, hint_len, CASE WHEN hint_len % 11 = 0 THEN substring(full_json, 1, 20) "
          "WHEN hint_len % 4 = 0 THEN no_key ELSE full_json END AS manifest FROM (SELECT *, "
          "CAST(to_json(struct_pack(assignment_id := assignment_id, parsed_solution_path := dir || '/parsed_solution.md', "
          "structure_hint_path := dir || '/structure_hint.txt')) AS VARCHAR) AS full_json, "
          "CAST(to_json(struct_pack(assignment_id := assignment_id, structure_hint_path := dir || '/structure_hint.txt')) AS VARCHAR) AS no_key FROM sol)"),
    ("listing", "SELECT dir || '/parsed_solution.md' AS path FROM sol WHERE hint_len % 3 <> 0 "
                "UNION ALL SELECT dir || '/structure_hint.txt' FROM sol WHERE hint_len % 5 <> 0"),
    ("p", "SELECT assignment_id, NOT json_valid(manifest) AS bad_json, "
          "TRY(json_extract_string(manifest, '$.parsed_solution_path')) AS solution_path, "
          "TRY(json_extract_string(manifest, '$.structure_hint_path')) AS hint_path FROM m"),
    ("r", "SELECT p.*, CASE WHEN bad_json THEN 'Invalid solution info file' "
          "WHEN solution_path IS NULL OR hint_path IS NULL THEN 'Missing required keys in solution info file' "
          "WHEN s.path IS NULL THEN 'Parsed solution file not found: ' || solution_path "
          "WHEN h.path IS NULL THEN 'Structure hint file not found: ' || hint_path END AS invalid_reason "
          "FROM p LEFT JOIN listing s ON s.path = p.solution_path LEFT JOIN listing h ON h.path = p.hint_path")],
    "SELECT assignment_id, invalid_reason IS NULL AS valid, invalid_reason, solution_path, hint_path FROM r"))
def q_solution_manifest_check(spark, sf_dir):
    from ..sources.files import check_solution_manifest
    manifests, listing = _manifests(spark, sf_dir)
    return check_solution_manifest(manifests, listing)
