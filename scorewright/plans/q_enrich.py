"""Request building, model calls, documents, archives, pipelines, streaming
(T11, T12, T14, S8, S9, I1, I5, I6, T9, T10, X1)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import rules
from ..functions import prompts as PR
from ..functions import text as X
from ..operators import enrich as E
from ..operators import files as FO
from ..session import shared_dir
from ..sources.archives import expand_archives
from ..sources.documents import extract_document_text
from . import preprocess as PP
from . import sqlgen as G
from .fixtures import FX_FILES
from .q_files import CAT_SQL as _CAT, PRE_FX, PRE_STEPS, REASON_SQL as _REASON, failures_by_path
from .registry import fx, query, table, with_sql


def _offline():
    return E.OfflineClient("offline-pro")


_CLS = [("c", f"SELECT *, {_REASON} AS skip_reason, {_CAT} AS cat0 FROM fx_files")]
_SIG = ("(starts_with(content, 'PK' || chr(3) || chr(4)) OR starts_with(content, 'PK' || chr(5) || chr(6)) "
        "OR starts_with(content, 'PK' || chr(7) || chr(8)) OR starts_with(content, chr(31) || chr(139)) "
        "OR starts_with(content, 'BZh') OR starts_with(content, chr(253) || '7zXZ' || chr(0)) "
        "OR substring(content, 258, 5) = 'ustar')")


# ---- T11 ------------------------------------------------------------------------
_CTX_SQL = (
    "SELECT o.submission, '\nSubmission Structure Information:\n- Submission Name: ' || o.submission || "
    "'\n- Total Original Files: ' || coalesce(CAST(i.total_original_files AS VARCHAR), 'Unknown') || "
    "'\n- Textual Files: ' || coalesce(CAST(i.textual_outputs AS VARCHAR), 'Unknown') || "
    "'\n- Visual Files: ' || coalesce(CAST(i.visual_outputs AS VARCHAR), 'Unknown') || "
    "'\n\nThe following files have been uploaded for analysis:\n' || "
    "CASE WHEN i.submission IS NULL THEN '' ELSE '\nTextual files:\n' || coalesce(t.l, '') || '\nVisual files:\n' || coalesce(v.l, '') END AS context "
    "FROM outcome o LEFT JOIN info i ON i.submission = o.submission "
    "LEFT JOIN (SELECT submission, string_agg('- ' || output_path || chr(10), '' ORDER BY output_path) AS l FROM outputs WHERE channel = 'textual' GROUP BY 1) t ON t.submission = o.submission "
    "LEFT JOIN (SELECT submission, string_agg('- ' || output_path || chr(10), '' ORDER BY output_path) AS l FROM outputs WHERE channel = 'visual' GROUP BY 1) v ON v.submission = o.submission")


@query("build_context", with_sql(PRE_FX, PRE_STEPS, _CTX_SQL))
def q_build_context(spark, sf_dir):
    pp = PP.preprocess(fx(spark, sf_dir, "fx_files"), failures_by_path(spark, sf_dir))
    info = PP.preprocess_info(pp)
    lists = pp.outputs.groupBy("submission").agg(
        F.array_sort(F.collect_list(F.when(F.col("channel") == "textual", F.col("output_path")))).alias("tf"),
        F.array_sort(F.collect_list(F.when(F.col("channel") == "visual", F.col("output_path")))).alias("vf"))
    j = pp.submissions.join(info, "submission", "left").join(lists, "submission", "left")
    has = F.col("total_original_files").isNotNull()
    return j.select("submission", PR.build_context(
        F.col("submission"), "total_original_files", "textual_outputs", "visual_outputs",
        F.when(has, F.coalesce("tf", F.array().cast("array<string>"))),
        F.when(has, F.coalesce("vf", F.array().cast("array<string>")))).alias("context"))


# ---- T12, T14 over conversations ---------------------------------------------------
# Every conversation belongs to one of the three documented assignments.
_AID = "CAST(u.conv_id % 3 AS VARCHAR)"


@query("build_grade_request", with_sql(("fx_hints",), [],
       "SELECT u.conv_id, u.turn, replace(" + G.q(PR.GRADING_INSTRUCTION) + ", '{structural_hint}', h.hint) || "
       + G.q(PR.MODEL_SOLUTION_HEADER) + " || a.text || " + G.q(PR.STUDENT_SUBMISSION_HEADER) + " || u.text AS request "
       "FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 "
       f"JOIN fx_hints h ON h.assignment_id = {_AID} "
       "WHERE u.role = 'user' AND a.role = 'assistant'"))
def q_build_grade_request(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    u = c.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("submission"))
    a = c.filter(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("solution"))
    j = u.join(a, ["conv_id", "turn"]).withColumn("assignment_id", (F.col("conv_id") % 3).cast("string")).join(
        fx(spark, sf_dir, "fx_hints"), "assignment_id")
    return j.select("conv_id", "turn", PR.build_grade_request(F.col("hint"), F.col("solution"), F.col("submission")).alias("request"))


@query("empty_reply", f"SELECT conv_id, turn, CASE WHEN {G.collapse('coalesce(text, ' + chr(39) + chr(39) + ')')} = '' THEN "
                      f"{G.q(rules.EMPTY_REPLY_MARKER)} ELSE text END AS reply, "
                      f"{G.collapse('coalesce(text, ' + chr(39) + chr(39) + ')')} = '' AS is_error FROM conversations WHERE role = 'assistant'")
def q_empty_reply(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").filter(F.col("role") == "assistant")
    return c.select("conv_id", "turn", PR.empty_reply(F.col("text")).alias("reply"), PR.is_empty_reply(F.col("text")).alias("is_error"))


# ---- S9 html (native), S9 others and S8 (Python) ------------------------------------
def _html_sql(col):
    out = col
    for pattern, repl in X.HTML_REWRITES:
        out = f"regexp_replace({out}, {G.q(pattern)}, {G.q(repl)}, 'g')"
    return G.collapse(out)


@query("extract_html_text", f"SELECT page_id, {_html_sql('html')} AS text FROM pages")
def q_extract_html_text(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", X.html_to_text(F.col("html")).alias("text"))


@query("extract_document_text", with_sql(("fx_files",), _CLS + [
    ("d", f"SELECT path, {G.ext('name')} AS ext, content FROM c WHERE skip_reason = '' AND cat0 = 'mixed'")],
    f"SELECT path, {_html_sql('content')} AS text, CAST(NULL AS VARCHAR) AS reason FROM d WHERE ext = '.html' "
    "UNION ALL SELECT path, CAST(NULL AS VARCHAR), 'not a notebook (no JSON object)' FROM d WHERE ext = '.ipynb' AND NOT coalesce(json_valid(content) AND json_type(CASE WHEN json_valid(content) THEN content ELSE '{}' END) = 'OBJECT', false) "
    "UNION ALL SELECT path, CAST(NULL AS VARCHAR), 'no text extractor for ' || ext FROM d WHERE ext NOT IN ('.html', '.ipynb', '.docx', '.pptx', '.odt') "
    "UNION ALL SELECT path, CAST(NULL AS VARCHAR), 'not an office container' FROM d WHERE ext IN ('.docx', '.pptx', '.odt') AND NOT starts_with(content, 'PK' || chr(3) || chr(4))"))
def q_extract_document_text(spark, sf_dir):
    f = FO.classify_files(fx(spark, sf_dir, "fx_files"))
    docs = f.filter(F.col("category") == "mixed")
    return extract_document_text(docs.select("path", "name", "content"))


# Fixture contents are prose, so no row carries an archive signature and every
# archive takes the native rejection path; the oracle states exactly that (a
# plausible archive would need Python and would not match it).
@query("expand_archives", with_sql(("fx_files",), _CLS,
       "SELECT submission, path AS archive_path, CAST(NULL AS VARCHAR) AS member_path, CAST(NULL AS VARCHAR) AS name, "
       "CAST(NULL AS BIGINT) AS size_bytes, 1 AS depth, 'Failed to extract ' || name || ': not a readable archive' AS error "
       f"FROM c WHERE skip_reason = '' AND cat0 = 'archive' AND NOT {_SIG}"))
def q_expand_archives(spark, sf_dir):
    f = FO.classify_files(fx(spark, sf_dir, "fx_files"))
    return expand_archives(f.filter(F.col("category") == "archive")).drop("content")


# ---- I1 with the offline client ---------------------------------------------
@query("invoke_model")
def q_invoke_model(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    req = c.select("conv_id", "turn", F.lit("parsing").alias("stage"),
                   F.concat(F.lit(PR.PARSE_INSTRUCTION), F.lit("\n\n"), F.col("text")).alias("request"))
    return E.persist_responses(E.invoke_model(req, _offline))


# ---- X1 -------------------------------------------------------------------------------
@query("stream_intake", with_sql(("fx_files",), _CLS,
       f"SELECT submission, path, name, size_bytes, doc_id, {G.ext('name')} AS ext, skip_reason, skip_reason = '' AS should_process, "
       "CASE WHEN skip_reason = '' THEN cat0 ELSE '' END AS category FROM c"))
def q_stream_intake(spark, sf_dir):
    from ..streaming.intake import stream_intake
    run = shared_dir(spark, f"stream_intake/{uuid.uuid4().hex}")

    def to_files(docs):
        docs.createOrReplaceTempView("documents_stream")
        return docs.sparkSession.sql(FX_FILES.replace("FROM documents) d", "FROM documents_stream) d"))

    # a glob, so the file source treats the one table file as a listing
    q = stream_intake(spark, f"{sf_dir.rstrip('/')}/documents.parque[t]", f"{run}/ledger", f"{run}/checkpoint", to_files)
    q.awaitTermination()
    return spark.read.parquet(f"{run}/ledger").drop("batch_id").select(
        "submission", "path", "name", "size_bytes", "doc_id", "ext", "skip_reason", "should_process", "category")


@query("intake_known_keys", with_sql(("fx_files",), [], "SELECT DISTINCT path FROM fx_files"))
def q_intake_known_keys(spark, sf_dir):
    """The intake run twice over the same files: the second run adds nothing, the state names every path."""
    from ..streaming.intake import known_keys, stream_intake
    run = shared_dir(spark, f"stream_intake/{uuid.uuid4().hex}")

    def to_files(docs):
        docs.createOrReplaceTempView("documents_stream")
        return docs.sparkSession.sql(FX_FILES.replace("FROM documents) d", "FROM documents_stream) d"))

    for _ in range(2):
        stream_intake(spark, f"{sf_dir.rstrip('/')}/documents.parque[t]", f"{run}/ledger", f"{run}/checkpoint", to_files).awaitTermination()
    return known_keys(spark, f"{run}/checkpoint")
