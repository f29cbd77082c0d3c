"""Sinks and readers as write-then-read-back queries on the shared folder (K1, K2, K3, K5, K6, S4, S7, I3 branches)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import rules, sinks
from ..operators import ledger as L
from ..session import shared_dir
from ..sources.files import read_preprocess_info, read_text_files, read_usage_ledger
from . import preprocess as PP
from . import sqlgen as G
from .q_files import PRE_FX, PRE_STEPS, _pp
from .q_reports import LATEST, _PROCESSED, _latest, _processed
from .registry import fx, query, table, with_sql
from ..functions import paths as P

DAY = "2026-01-05"
FILE_COLUMNS = "submission string, kind string, name string, path string, size_bytes bigint, detail string"


def _place(spark, name):
    return shared_dir(spark, f"{name}/{uuid.uuid4().hex}")


def _half(k):
    """Submissions 'S<number>' by the parity of their number: the two runs of one day."""
    return F.regexp_extract("submission", "[0-9]+", 0).cast("bigint") % 2 == k


_LISTS = """
SELECT submission, 'original' AS kind, unique_name AS name, path, CAST(size_bytes AS BIGINT) AS size_bytes, category AS detail FROM named
UNION ALL SELECT submission, channel, output_path, path, (SELECT f.size_bytes FROM f0 f WHERE f.path = o.path), NULL FROM outputs o
UNION ALL SELECT submission, 'skipped', name, path, size_bytes, skip_reason FROM cls WHERE skip_reason NOT IN ('', 'System/hidden file', 'Empty file')
UNION ALL SELECT submission, 'scanned', unique_name, path, size_bytes, {sample} FROM named WHERE category = 'mixed' AND ext = '.pdf' AND NOT has_text
UNION ALL SELECT submission, 'failed', filename, path, NULL, failure_reason FROM eff
UNION ALL SELECT submission, 'archive_error', '', path, NULL, 'Failed to extract ' || name || ': not a readable archive' FROM cls
WHERE skip_reason = '' AND cat0 = 'archive'
""".format(sample=G.scanned_sample(G.text_sample("content")))


@query("preprocess_file_lists", with_sql(PRE_FX, PRE_STEPS, _LISTS))
def q_preprocess_file_lists(spark, sf_dir):
    """K1 written by two runs of one day, the first of them twice; read back."""
    pp = _pp(spark, sf_dir)
    info, lists, path = PP.preprocess_info(pp), PP.file_lists(pp), _place(spark, "preprocess_info")
    for k, run in ((0, "a"), (1, "b"), (0, "a")):
        sinks.write_preprocess_info(info.filter(_half(k)), lists.filter(_half(k)), path, DAY, run)
    return sinks.read_runs(spark, f"{path}/files", FILE_COLUMNS).drop(*sinks.RUN)


@query("preprocess_documents", with_sql(PRE_FX, PRE_STEPS,
       "SELECT o.submission AS submission_name, o.channel, o.output_path, i.total_original_files, i.textual_outputs, i.visual_outputs, "
       "i.skipped_files, i.failed_files, i.scanned_pdfs FROM info i JOIN outputs o ON o.submission = i.submission UNION ALL "
       "SELECT submission, NULL, NULL, total_original_files, textual_outputs, visual_outputs, skipped_files, failed_files, scanned_pdfs "
       "FROM info WHERE submission NOT IN (SELECT submission FROM outputs)"))
def q_preprocess_documents(spark, sf_dir):
    """K1 as nested documents of at most eight files each, read back by S6: their file lists as rows, beside the counts."""
    pp, path = _pp(spark, sf_dir), _place(spark, "preprocess_documents")
    sinks.write_preprocess_documents(PP.preprocess_info(pp), pp.outputs, path, DAY, files_per_document=8)
    docs = read_preprocess_info(spark, path, multi_line=False)

    def named(channel):
        return F.transform(f"{channel}_files", lambda x: F.struct(F.lit(channel).alias("channel"), x.alias("output_path")))

    listed = F.concat(named("textual"), named("visual"))
    return docs.select("submission_name", F.inline_outer(listed), *[F.col(f"summary.{c}").alias(c) for c in sinks.SUMMARY_COUNTS])


@query("failure_report_two_runs", with_sql(PRE_FX, PRE_STEPS,
       "SELECT submission, CAST(count(*) AS BIGINT) AS total_failed_files, CAST(count(DISTINCT filename) AS BIGINT) AS distinct_files, "
       "CASE WHEN CAST(substring(submission, 2) AS BIGINT) % 2 = 0 THEN 'a' ELSE 'b' END AS run_id FROM eff GROUP BY submission"))
def q_failure_report_two_runs(spark, sf_dir):
    """K2 by two runs of one day: the second keeps the first's rows."""
    failures, path = _pp(spark, sf_dir).failures, _place(spark, "failure_report")
    for k, run in ((0, "a"), (1, "b")):
        sinks.write_failure_report(failures.filter(_half(k)), path, DAY, run)
    back = sinks.read_runs(spark, f"{path}/summary", "submission string, total_failed_files bigint, distinct_files bigint")
    return back.drop("run_date")


@query("archive_errors", with_sql(PRE_FX, PRE_STEPS, "SELECT submission, path, 'Failed to extract ' || name || ': not a readable archive' AS error "
                                                    "FROM cls WHERE skip_reason = '' AND cat0 = 'archive'"))
def q_archive_errors(spark, sf_dir):
    return _pp(spark, sf_dir).archive_errors.select("submission", "path", "error")


# ---- K3 ---------------------------------------------------------------------------
_LEDGER = "submission string, seq bigint, parsing string, grading string"


def _ledger(spark, sf_dir, mode):
    """Even events first, then odd ones, as two runs; each key may come often within a run."""
    rows, path = fx(spark, sf_dir, "fx_stage_results").select("submission", F.col("seq").cast("bigint").alias("seq"), "parsing", "grading"), _place(spark, "ledger")
    for k, run in ((0, "a"), (1, "b"), (1, "b")):
        sinks.write_ledger(rows.filter(F.col("seq") % 2 == k), path, ["submission"], DAY, run, mode=mode, seq="seq")
    return sinks.read_ledger(spark, path, _LEDGER, ["submission"])


def _ledger_sql(first):
    return (f"SELECT submission, CAST(seq AS BIGINT) AS seq, parsing, grading FROM (SELECT *, row_number() OVER (PARTITION BY submission "
            f"ORDER BY seq % 2 {first}, seq DESC) AS k FROM fx_stage_results) WHERE k = 1")


@query("ledger_insert", with_sql(("fx_stage_results",), [], _ledger_sql("ASC")))
def q_ledger_insert(spark, sf_dir):
    return _ledger(spark, sf_dir, "insert")


@query("ledger_upsert", with_sql(("fx_stage_results",), [], _ledger_sql("DESC")))
def q_ledger_upsert(spark, sf_dir):
    return _ledger(spark, sf_dir, "upsert")


# ---- K5, K6 -----------------------------------------------------------------------
GENERATED = "2026-01-05 12:00:00"
_EQ, _D40, _D50 = "repeat('=', 80)", "repeat('-', 40)", "repeat('-', 50)"


def _stage_sql(stage, at, summary):
    up = stage.upper()
    counts = "".join(f"UNION ALL SELECT {at + 2 + i}, '', '{t}: ' || (SELECT count(*) FROM srows WHERE stage = '{stage}' AND status = '{s}') "
                     for i, (s, t) in enumerate((("success", "✓ Successful"), ("skipped", "⏭ Skipped"), ("failed", "✗ Failed"))))
    if summary:
        return f"UNION ALL SELECT {at}, '', '{up} SUMMARY:' UNION ALL SELECT {at + 1}, '', {_D40} {counts}UNION ALL SELECT {at + 9}, '', '' "
    out = f"UNION ALL SELECT {at}, '', '{up} RESULTS:' UNION ALL SELECT {at + 1}, '', {_D50} "
    for i, (s, t) in enumerate((("success", "✓ SUCCESSFUL"), ("skipped", "⏭ SKIPPED"), ("failed", "✗ FAILED"))):
        some = f"WHERE EXISTS (SELECT 1 FROM srows WHERE stage = '{stage}' AND status = '{s}')"
        tail = "" if s == "success" else " || ' - ' || reason"
        out += (f"UNION ALL SELECT {at + 10 * i + 2}, '', '{t} {up}:' {some} "
                f"UNION ALL SELECT {at + 10 * i + 3}, submission, '  • ' || submission{tail} FROM srows WHERE stage = '{stage}' AND status = '{s}' "
                f"UNION ALL SELECT {at + 10 * i + 4}, '', '' {some} ")
    return out


_REPORT = ("SELECT CAST(row_number() OVER (ORDER BY pos, name, line) AS BIGINT) AS line_no, line FROM ("
           f"SELECT 0 AS pos, '' AS name, {_EQ} AS line UNION ALL SELECT 1, '', 'COMPREHENSIVE PROCESSING REPORT' UNION ALL SELECT 2, '', {_EQ} "
           f"UNION ALL SELECT 3, '', 'Generated: {GENERATED}' UNION ALL SELECT 4, '', 'Total Submissions Processed: ' || (SELECT count(*) FROM latest) "
           "UNION ALL SELECT 5, '', '' " + _stage_sql("parsing", 10, True) + _stage_sql("grading", 20, True)
           + f"UNION ALL SELECT 30, '', {_EQ} UNION ALL SELECT 31, '', 'DETAILED RESULTS' UNION ALL SELECT 32, '', {_EQ} UNION ALL SELECT 33, '', '' "
           + _stage_sql("parsing", 40, False) + _stage_sql("grading", 80, False)
           + f"UNION ALL SELECT 900, '', {_EQ} UNION ALL SELECT 901, '', 'END OF REPORT' UNION ALL SELECT 902, '', {_EQ})")


@query("processing_report_text", with_sql(("fx_stage_results",), LATEST, _REPORT))
def q_processing_report_text(spark, sf_dir):
    """K5 (and L1): the report as written, line by line."""
    path = _place(spark, "processing_report")
    sinks.write_processing_report(_latest(spark, sf_dir), path, GENERATED)
    return sinks.read_report(spark, path)


_INVALID = [("done", _PROCESSED), ("subs", "SELECT * FROM fx_submissions WHERE NOT starts_with(dir_name, '#')"),
            ("inv", "SELECT submission_id, 'not_preprocessed' AS kind FROM subs WHERE submission_id NOT IN (SELECT submission_id FROM done) "
                    f"UNION ALL SELECT submission_id, 'invalid' FROM subs WHERE NOT regexp_matches(dir_name, {G.q(P.DIR_RE)})"),
            ("one", "SELECT DISTINCT CAST(submission_id AS VARCHAR) AS who, submission_id || '_' || kind || '.txt' AS name FROM inv")]


@query("invalid_report_text", with_sql(("fx_submissions",), _INVALID,
       "SELECT CAST(row_number() OVER (ORDER BY pos, name, k) AS BIGINT) AS line_no, line FROM ("
       "SELECT 0 AS pos, '' AS name, 0 AS k, '=== INVALID SUBMISSIONS SUMMARY ===' AS line UNION ALL SELECT 1, '', 0, '' "
       "UNION ALL SELECT 2, '', 0, 'Total invalid submissions: ' || (SELECT count(*) FROM one) UNION ALL SELECT 3, '', 0, '' "
       "UNION ALL SELECT 4, name, 0, 'Submission: ' || who FROM one UNION ALL SELECT 4, name, 1, 'Report: ' || name FROM one "
       f"UNION ALL SELECT 4, name, 2, {_D50} FROM one)"))
def q_invalid_report_text(spark, sf_dir):
    subs = fx(spark, sf_dir, "fx_submissions").filter(~F.col("dir_name").startswith("#"))
    npre = L.not_preprocessed(subs, _processed(spark, sf_dir), "submission_id").select("submission_id", F.lit("not_preprocessed").alias("kind"))
    bad = subs.filter(~F.col("dir_name").rlike(P.DIR_RE)).select("submission_id", F.lit("invalid").alias("kind"))
    path = _place(spark, "invalid_report")
    sinks.write_invalid_report(npre.unionByName(bad), path, "submission_id")
    return sinks.read_report(spark, path)


# ---- S4, S7 -----------------------------------------------------------------------
@query("read_text_files", "SELECT CAST(item_id AS BIGINT) AS item_id, text || chr(10) AS text FROM benchmark")
def q_read_text_files(spark, sf_dir):
    """One text file per benchmark item, read whole."""
    path = _place(spark, "text_files")
    b = table(spark, sf_dir, "benchmark")
    b.select("text", F.col("item_id").alias("item")).repartition("item").write.partitionBy("item").text(path)
    return read_text_files(spark, f"{path}/item=*").select(
        F.regexp_extract("file_path", "item=([0-9]+)", 1).cast("bigint").alias("item_id"), "text")


_BY_STAGE = [("u", "SELECT submission, stage, CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens, CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens "
                   "FROM fx_usage GROUP BY submission, stage")]


@query("read_usage_ledger", with_sql(("fx_usage",), _BY_STAGE,
       "SELECT CAST(submission AS VARCHAR) AS submission, stage, prompt_tokens, completion_tokens, prompt_tokens + completion_tokens AS total_tokens, "
       "'pro' AS model_type FROM u WHERE submission % 9 <> 4"))
def q_read_usage_ledger(spark, sf_dir):
    """Usage documents, one a line, every ninth cut off in the middle: bad JSON gives no rows."""
    u = fx(spark, sf_dir, "fx_usage").groupBy("submission").agg(*[
        F.when(F.count_if(F.col("stage") == s) > 0, F.struct(
            F.sum(F.when(F.col("stage") == s, F.col("prompt_tokens"))).alias("prompt_tokens"),
            F.sum(F.when(F.col("stage") == s, F.col("completion_tokens"))).alias("completion_tokens"),
            F.sum(F.when(F.col("stage") == s, F.col("prompt_tokens") + F.col("completion_tokens"))).alias("total_tokens"),
            F.lit("pro").alias("model_type"))).alias(s) for s in ("parsing", "grading")])
    doc = F.to_json(F.struct(F.col("submission").cast("string").alias("submission"), "parsing", "grading"))
    path = _place(spark, "usage_ledger")
    u.select(F.when(F.col("submission") % 9 == 4, F.substring(doc, 1, 25)).otherwise(doc)).write.text(path)
    return read_usage_ledger(spark, path, one_per_line=True).select(
        "submission", "stage", "prompt_tokens", "completion_tokens", "total_tokens", "model_type")


# ---- I3: every branch ---------------------------------------------------------------
_BRANCHES = [("b", "SELECT doc_id, doc_id % 2 = 0 AS do_parse, doc_id % 3 <> 0 AS do_grade, doc_id % 5 <> 1 AS parse_ok, doc_id % 7 <> 2 AS grade_ok, "
                   "CASE WHEN doc_id % 11 = 0 THEN 'out of memory ' || doc_id END AS run_exception, "
                   "CASE WHEN doc_id % 2 = 0 AND doc_id % 13 = 0 THEN 'disk full' END AS parse_exception, "
                   "CASE WHEN doc_id % 17 = 0 THEN 'bad reply' END AS grade_exception, doc_id % 19 <> 0 AS parsed_present FROM documents")]


@query("stage_status_errors", with_sql((), _BRANCHES, f"""
SELECT doc_id,
 CASE WHEN run_exception IS NOT NULL OR parse_exception IS NOT NULL THEN 'failed' WHEN NOT do_parse THEN 'skipped' WHEN parse_ok THEN 'success' ELSE 'failed' END AS parsing,
 CASE WHEN run_exception IS NOT NULL OR parse_exception IS NOT NULL THEN 'failed' WHEN do_parse AND NOT parse_ok THEN 'skipped' WHEN NOT parsed_present THEN 'failed'
      WHEN grade_exception IS NOT NULL THEN 'failed' WHEN NOT do_grade THEN 'skipped' WHEN grade_ok THEN 'success' ELSE 'failed' END AS grading,
 CASE WHEN run_exception IS NOT NULL THEN 'Thread exception: ' || run_exception WHEN parse_exception IS NOT NULL THEN 'Exception: ' || parse_exception
      WHEN NOT do_parse THEN {G.q(rules.PARSED_EXISTS)} WHEN parse_ok THEN '' ELSE 'Failed to parse submission' END AS parsing_reason,
 CASE WHEN run_exception IS NOT NULL THEN 'Thread exception: ' || run_exception WHEN parse_exception IS NOT NULL THEN 'Exception: ' || parse_exception
      WHEN do_parse AND NOT parse_ok THEN 'Parsing failed' WHEN NOT parsed_present THEN 'No parsed submission file'
      WHEN grade_exception IS NOT NULL THEN 'Exception: ' || grade_exception WHEN NOT do_grade THEN {G.q(rules.GRADED_EXISTS)}
      WHEN grade_ok THEN '' ELSE 'Failed to grade submission' END AS grading_reason FROM b"""))
def q_stage_status_errors(spark, sf_dir):
    i = F.col("doc_id")
    plan = table(spark, sf_dir, "documents").select(
        "doc_id", (i % 2 == 0).alias("do_parse"), (i % 3 != 0).alias("do_grade"), (i % 5 != 1).alias("parse_ok"), (i % 7 != 2).alias("grade_ok"),
        F.when(i % 11 == 0, F.concat(F.lit("out of memory "), i.cast("string"))).alias("run_exception"),
        F.when((i % 2 == 0) & (i % 13 == 0), "disk full").alias("parse_exception"),
        F.when(i % 17 == 0, "bad reply").alias("grade_exception"), (i % 19 != 0).alias("parsed_present"))
    return L.stage_status(plan).select("doc_id", "parsing", "grading", "parsing_reason", "grading_reason")
