"""Queries over the file inventory (S*, F*, W2-W4, L2, A1-A5, I7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import rules
from ..functions import paths as P
from ..functions import text as X
from ..operators import files as FO
from ..operators import reports as R
from . import preprocess as PP
from . import sqlgen as G
from .registry import fx, query, table, with_sql

NAME, PATH = "name", "path"
REASON_SQL, CAT_SQL = G.skip_reason("name", "path", "size_bytes", "content")

# ---- shared oracle steps: the preprocess plan in DuckDB ---------------------
PRE_STEPS = [
    ("f0", "SELECT *, CASE WHEN strpos(path, '/' || submission || '/') > 0 THEN "
           "substr(path, strpos(path, '/' || submission || '/') + length(submission) + 2) ELSE path END AS rel "
           "FROM fx_files WHERE NOT starts_with(submission, '#')"),
    ("subs", "SELECT DISTINCT submission FROM f0"),
    ("done", "SELECT DISTINCT submission FROM f0 WHERE starts_with(rel, 'processed/')"),
    ("below", "SELECT * FROM f0 WHERE submission NOT IN (SELECT submission FROM done) "
              "AND NOT list_contains(string_split(rel, '/'), 'processed')"),
    ("cls", f"SELECT *, {G.ext('name')} AS ext, {REASON_SQL} AS skip_reason, {CAT_SQL} AS cat0 FROM below"),
    ("flat", "SELECT *, cat0 AS category FROM cls WHERE skip_reason = '' AND cat0 <> 'archive'"),
    ("ranked", "SELECT *, row_number() OVER (PARTITION BY submission, name ORDER BY path) - 1 AS k FROM flat"),
    ("named", f"SELECT *, CASE WHEN k = 0 THEN name ELSE {G.stem('name')} || '_' || CAST(k AS VARCHAR) || "
              f"{G.suffix('name')} END AS unique_name, "
              f"CASE WHEN category = 'mixed' AND ext = '.pdf' THEN {G.has_text('content')} ELSE false END AS has_text "
              "FROM ranked"),
    ("routes", "SELECT submission, doc_id, path, unique_name, category, ext, 'textual' AS channel, "
               "'processed/textual/' || unique_name AS output_path FROM named WHERE category = 'textual' "
               "UNION ALL SELECT submission, doc_id, path, unique_name, category, ext, 'visual', "
               "'processed/visual/' || unique_name FROM named WHERE category = 'visual' "
               "UNION ALL SELECT submission, doc_id, path, unique_name, category, ext, 'textual', "
               f"'processed/textual/' || {G.pdf_name('unique_name')} FROM named "
               "WHERE category = 'mixed' AND (ext <> '.pdf' OR has_text) "
               "UNION ALL SELECT submission, doc_id, path, unique_name, category, ext, 'visual', "
               f"'processed/visual/' || {G.stem('unique_name')} || '_page_*.jpg' FROM named WHERE category = 'mixed'"),
    ("eff", "SELECT f.submission, r.path, r.unique_name AS filename, f.failure_reason, f.conversion_type, "
            "f.ord * 2 + CASE WHEN f.conversion_type = 'PDF' THEN 0 ELSE 1 END AS order_key, r.channel "
            "FROM fx_failures f JOIN routes r ON f.submission = r.submission AND f.ord = r.doc_id "
            "AND (CASE WHEN f.conversion_type = 'PDF' THEN 'textual' ELSE 'visual' END) = r.channel"),
    ("outputs", "SELECT * FROM routes r WHERE NOT EXISTS (SELECT 1 FROM eff e WHERE e.submission = r.submission "
                "AND e.path = r.path AND e.channel = r.channel)"),
    ("info", "SELECT n.submission, CAST(count(*) AS BIGINT) AS total_original_files, "
             "CAST(coalesce(max(o.t), 0) AS BIGINT) AS textual_outputs, CAST(coalesce(max(o.v), 0) AS BIGINT) AS visual_outputs, "
             "CAST(coalesce(max(s.n), 0) AS BIGINT) AS skipped_files, CAST(coalesce(max(x.n), 0) AS BIGINT) AS failed_files, "
             "CAST(count_if(n.category = 'mixed' AND n.ext = '.pdf' AND NOT n.has_text) AS BIGINT) AS scanned_pdfs "
             "FROM named n "
             "LEFT JOIN (SELECT submission, count_if(channel = 'textual') AS t, count_if(channel = 'visual') AS v FROM outputs GROUP BY 1) o ON o.submission = n.submission "
             f"LEFT JOIN (SELECT submission, count(*) AS n FROM cls WHERE skip_reason NOT IN ('', {G.q(rules.REASON_HIDDEN)}, {G.q(rules.REASON_EMPTY)}) GROUP BY 1) s ON s.submission = n.submission "
             "LEFT JOIN (SELECT submission, count(*) AS n FROM eff GROUP BY 1) x ON x.submission = n.submission "
             "GROUP BY n.submission"),
    ("fr", "SELECT submission, failure_reason, count(*) AS n, min(order_key) AS first_seen, "
           "arg_min(filename, order_key) AS one_file FROM eff GROUP BY submission, failure_reason"),
    ("reasons", "SELECT submission, string_agg(CASE WHEN n = 1 THEN one_file || ': ' || failure_reason "
                "ELSE CAST(n AS VARCHAR) || ' files: ' || failure_reason END, '; ' ORDER BY first_seen) AS failure_summary, "
                "CAST(sum(n) AS BIGINT) AS failed_files FROM fr GROUP BY submission"),
    ("outcome", "SELECT s.submission, d.submission IS NOT NULL AS already_processed, "
                "(d.submission IS NOT NULL OR (coalesce(i.total_original_files, 0) > 0 AND coalesce(i.failed_files, 0) = 0)) AS success, "
                f"CASE WHEN d.submission IS NOT NULL THEN NULL WHEN coalesce(i.total_original_files, 0) = 0 THEN {G.q(rules.NO_FILES_REASON)} "
                "ELSE r.failure_summary END AS failure_reason, "
                "CAST(coalesce(i.total_original_files, 0) AS BIGINT) AS total_original_files, "
                "CAST(coalesce(i.textual_outputs, 0) AS BIGINT) AS textual_outputs, "
                "CAST(coalesce(i.visual_outputs, 0) AS BIGINT) AS visual_outputs, "
                "CAST(coalesce(i.skipped_files, 0) AS BIGINT) AS skipped_files, "
                "CAST(coalesce(i.failed_files, 0) AS BIGINT) AS failed_files, "
                "CAST(coalesce(i.scanned_pdfs, 0) AS BIGINT) AS scanned_pdfs "
                "FROM subs s LEFT JOIN done d ON d.submission = s.submission "
                "LEFT JOIN info i ON i.submission = s.submission LEFT JOIN reasons r ON r.submission = s.submission"),
]
PRE_FX = ("fx_files", "fx_failures")


def failures_by_path(spark, sf_dir):
    """fx_failures name a file by document; the operator wants its path."""
    where = fx(spark, sf_dir, "fx_files").select("submission", F.col("doc_id").alias("ord"), "path")
    fl = fx(spark, sf_dir, "fx_failures").join(where, ["submission", "ord"])
    turn = F.col("ord") * 2 + F.when(F.col("conversion_type") == "PDF", 0).otherwise(1)
    return fl.select("submission", "path", "failure_reason", "conversion_type", turn.alias("order_key"))


def _pp(spark, sf_dir):
    return PP.preprocess(fx(spark, sf_dir, "fx_files"), failures_by_path(spark, sf_dir))


# ---- S1, S3, F1, F2, F5, F6, F7, F8, F9 -------------------------------------
@query("list_submissions", with_sql(("fx_submissions",), [], "SELECT DISTINCT dir_name FROM fx_submissions WHERE NOT starts_with(dir_name, '#')"))
def q_list_submissions(spark, sf_dir):
    from ..sources.files import list_submissions
    return list_submissions(fx(spark, sf_dir, "fx_submissions"), "dir_name")


@query("exclude_processed", with_sql(("fx_files",), [], "SELECT submission, path FROM fx_files WHERE NOT list_contains(string_split(path, '/'), 'processed')"))
def q_exclude_processed(spark, sf_dir):
    return FO.exclude_processed(fx(spark, sf_dir, "fx_files")).select("submission", "path")


@query("filter_hidden", with_sql(("fx_files",), [], f"SELECT path, name FROM fx_files WHERE NOT {G.hidden('name', 'path')}"))
def q_filter_hidden(spark, sf_dir):
    f = fx(spark, sf_dir, "fx_files")
    return f.filter(~P.is_hidden(F.col(NAME), F.col(PATH))).select(PATH, NAME)


@query("file_ext", with_sql(("fx_files",), [], f"SELECT path, name, {G.ext('name')} AS ext, {G.stem('name')} AS stem, "
                            "coalesce(lower(nullif(regexp_extract(name, '(?i)(\\.tar\\.(gz|bz2))$', 1), '')), "
                            f"{G.ext('name')}) AS compound_ext FROM fx_files"))
def q_file_ext(spark, sf_dir):
    f = fx(spark, sf_dir, "fx_files")
    return f.select(PATH, NAME, P.file_ext(F.col(NAME)).alias("ext"), P.file_stem(F.col(NAME)).alias("stem"),
                    P.compound_ext(F.col(NAME)).alias("compound_ext"))


@query("classify_extension", with_sql(("fx_files",), [], f"SELECT {G.ext('name')} AS ext, {G.category(G.ext('name'))} AS category, "
                                      "CAST(count(*) AS BIGINT) AS n_files FROM fx_files GROUP BY ALL"))
def q_classify_extension(spark, sf_dir):
    f = fx(spark, sf_dir, "fx_files").withColumn("ext", P.file_ext(F.col(NAME)))
    return f.groupBy("ext", P.category_of(F.col("ext")).alias("category")).agg(F.count(F.lit(1)).alias("n_files"))


@query("sniff_text", with_sql(("fx_files",), [], f"SELECT doc_id, {G.sniff('content')} AS looks_like_text, "
                              f"{G.printable_share('substring(content, 1, 1024)')} AS printable_share FROM fx_files"))
def q_sniff_text(spark, sf_dir):
    f = fx(spark, sf_dir, "fx_files")
    s = F.substring(F.col("content"), 1, rules.TEXT_SNIFF_CHARS)
    return f.select("doc_id", X.looks_like_text(F.col("content")).alias("looks_like_text"),
                    X.printable_share(s).alias("printable_share"))


@query("classify_files", with_sql(("fx_files",), [("c", f"SELECT *, {REASON_SQL} AS skip_reason, {CAT_SQL} AS cat0 FROM fx_files")],
                                  "SELECT submission, path, skip_reason = '' AS should_process, "
                                  "CASE WHEN skip_reason = '' THEN cat0 ELSE '' END AS category, skip_reason FROM c"))
def q_classify_files(spark, sf_dir):
    c = FO.classify_files(fx(spark, sf_dir, "fx_files"))
    return c.select("submission", PATH, "should_process", "category", "skip_reason")


@query("size_limit_reason", with_sql(("fx_files",), [], f"SELECT path, {G.size_reason('size_bytes', G.category(G.ext('name')))} AS size_reason "
                                     f"FROM fx_files WHERE {G.category(G.ext('name'))} IS NOT NULL"))
def q_size_limit_reason(spark, sf_dir):
    f = fx(spark, sf_dir, "fx_files")
    cat = P.category_of(P.file_ext(F.col(NAME)))
    return f.filter(cat.isNotNull()).select(PATH, P.size_limit_reason(F.col("size_bytes"), cat).alias("size_reason"))


@query("reportable_skips", with_sql(("fx_files",), [("c", f"SELECT *, {REASON_SQL} AS skip_reason FROM fx_files")],
                                    f"SELECT submission, path, skip_reason FROM c WHERE skip_reason NOT IN ('', {G.q(rules.REASON_HIDDEN)}, {G.q(rules.REASON_EMPTY)})"))
def q_reportable_skips(spark, sf_dir):
    return FO.reportable_skips(FO.classify_files(fx(spark, sf_dir, "fx_files"))).select("submission", PATH, "skip_reason")


# ---- T1, F10, L2 over documents ----------------------------------------------
@query("collapse_ws", f"SELECT doc_id, {G.collapse('text')} AS collapsed, CAST(length({G.collapse('text')}) AS BIGINT) AS n_collapsed FROM documents")
def q_collapse_ws(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    c = X.collapse_ws(F.col("text"))
    return d.select("doc_id", c.alias("collapsed"), F.length(c).cast("bigint").alias("n_collapsed"))


@query("extractable_text", f"SELECT doc_id, {G.has_text('text')} AS has_text, "
                           f"{G.share(G.collapse('text'), X.ALNUM_OR_SPACE_DROP)} AS alnum_share FROM documents")
def q_extractable_text(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", X.has_extractable_text(F.col("text")).alias("has_text"),
                    X.char_share(X.collapse_ws(F.col("text")), X.ALNUM_OR_SPACE_DROP).alias("alnum_share"))


@query("text_sample", f"SELECT doc_id, {G.text_sample('text')} AS text_sample, "
                      f"{G.scanned_sample(G.text_sample('text'))} AS scanned_sample FROM documents")
def q_text_sample(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    s = X.text_sample(F.col("text"))
    return d.select("doc_id", s.alias("text_sample"), X.scanned_sample(s).alias("scanned_sample"))


# ---- F12, F13, F14, F17, W2, W3, W4, F11 ------------------------------------
@query("output_names", with_sql(("fx_files",), [], f"SELECT path, {G.pdf_name('name')} AS pdf_name, "
                                f"{G.stem('name')} || '_page_1.jpg' AS first_page_image, 'extracted_' || {G.stem('name')} AS archive_dir FROM fx_files"))
def q_output_names(spark, sf_dir):
    f = fx(spark, sf_dir, "fx_files")
    return f.select(PATH, P.pdf_output_name(F.col(NAME)).alias("pdf_name"),
                    P.page_image_name(F.col(NAME), F.lit(1)).alias("first_page_image"),
                    P.archive_dir_name(F.col(NAME)).alias("archive_dir"))


@query("image_resize_plan", with_sql(("fx_page_images",), [],
       "SELECT doc_id, CAST(page_no AS BIGINT) AS page_no, greatest(width, height) > 2048 AS resize, "
       "CASE WHEN greatest(width, height) > 2048 THEN CAST(trunc(CAST(width AS DOUBLE) * (CAST(2048 AS DOUBLE) / CAST(greatest(width, height) AS DOUBLE))) AS INTEGER) ELSE width END AS new_width, "
       "CASE WHEN greatest(width, height) > 2048 THEN CAST(trunc(CAST(height AS DOUBLE) * (CAST(2048 AS DOUBLE) / CAST(greatest(width, height) AS DOUBLE))) AS INTEGER) ELSE height END AS new_height "
       "FROM fx_page_images"))
def q_image_resize_plan(spark, sf_dir):
    return FO.image_resize_plan(fx(spark, sf_dir, "fx_page_images")).select(
        "doc_id", F.col("page_no").cast("bigint").alias("page_no"), "resize", "new_width", "new_height")


_ROUTE_SQL = (f"CASE WHEN {G.ext('name')} = '.ipynb' THEN 'notebook' WHEN {G.ext('name')} IN {G.in_list(P.OFFICE_EXTENSIONS)} THEN 'office' "
              f"WHEN {G.ext('name')} = '.html' THEN 'html' WHEN {G.ext('name')} = '.pdf' THEN 'pdf_copy' ELSE 'none' END")


@query("conversion_route", with_sql(("fx_files",), [], f"SELECT path, {_ROUTE_SQL} AS route, {G.pdf_name('name')} AS expected_output "
                                    f"FROM fx_files WHERE {G.category(G.ext('name'))} = 'mixed'"))
def q_conversion_route(spark, sf_dir):
    f = fx(spark, sf_dir, "fx_files")
    ext = P.file_ext(F.col(NAME))
    return f.filter(P.category_of(ext) == "mixed").select(
        PATH, P.conversion_route(ext).alias("route"), P.pdf_output_name(F.col(NAME)).alias("expected_output"))


_KIND = "CASE doc_id % 6 WHEN 0 THEN 'timeout' WHEN 1 THEN 'command' WHEN 2 THEN 'unexpected' WHEN 3 THEN 'notebook' WHEN 4 THEN 'image' ELSE 'missing' END"


def _kind_col():
    m = F.col("doc_id") % 6
    return (F.when(m == 0, "timeout").when(m == 1, "command").when(m == 2, "unexpected")
            .when(m == 3, "notebook").when(m == 4, "image").otherwise("missing"))


@query("failure_reason", with_sql(("fx_files",), [("k", f"SELECT path, {G.ext('name')} AS ext, {_KIND} AS kind, content FROM fx_files "
                                                    f"WHERE {G.category(G.ext('name'))} = 'mixed'"),
                                                   ("m", "SELECT path, kind, CASE kind "
                                                         "WHEN 'timeout' THEN 'Conversion timeout (' || ext || ' → PDF)' "
                                                         "WHEN 'command' THEN 'Conversion command failed (' || ext || ' → PDF): ' || substring(coalesce(content, ''), 1, 100) "
                                                         "WHEN 'unexpected' THEN 'Unexpected conversion error (' || ext || ' → PDF): ' || substring(coalesce(content, ''), 1, 100) "
                                                         f"WHEN 'notebook' THEN {G.q(P.NOTEBOOK_FAILED)} "
                                                         "WHEN 'image' THEN 'Image conversion failed (' || ext || '): ' || substring(coalesce(content, ''), 1, 100) "
                                                         "ELSE 'PDF conversion failed - output file not created for ' || ext || ' file' END AS message FROM k")],
                                  "SELECT path, kind, CASE WHEN kind = 'image' THEN 'Image conversion failed: ' || message "
                                  "ELSE 'PDF conversion failed: ' || message END AS failure_reason FROM m"))
def q_failure_reason(spark, sf_dir):
    f = fx(spark, sf_dir, "fx_files")
    ext = P.file_ext(F.col(NAME))
    k = f.filter(P.category_of(ext) == "mixed").withColumn("kind", _kind_col())
    msg = P.conversion_error(F.col("kind"), ext, F.col("content"))
    ctype = F.when(F.col("kind") == "image", "Image").otherwise("PDF")
    return k.select(PATH, "kind", P.failure_reason(ctype, msg).alias("failure_reason"))


@query("unique_names", with_sql(PRE_FX, PRE_STEPS, "SELECT submission, path, unique_name FROM named"))
def q_unique_names(spark, sf_dir):
    return _pp(spark, sf_dir).files.select("submission", PATH, "unique_name")


@query("route_channels", with_sql(PRE_FX, PRE_STEPS, "SELECT submission, path, channel, output_path FROM routes"))
def q_route_channels(spark, sf_dir):
    return _pp(spark, sf_dir).routes.select("submission", PATH, "channel", "output_path")


@query("cap_pages", with_sql(("fx_page_images",), [], "SELECT doc_id, CAST(page_no AS BIGINT) AS page_no, width, height FROM fx_page_images WHERE page_no <= 30"))
def q_cap_pages(spark, sf_dir):
    return FO.cap_pages(fx(spark, sf_dir, "fx_page_images")).select(
        "doc_id", F.col("page_no").cast("bigint").alias("page_no"), "width", "height")


@query("first_pages", "SELECT user_id AS doc_id, 'img_' || event_id || '.jpg' AS page_file, CAST(row_number() OVER (PARTITION BY user_id "
                      "ORDER BY 'img_' || event_id || '.jpg') AS BIGINT) AS page_no FROM events "
                      "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY 'img_' || event_id || '.jpg') <= 30")
def q_first_pages(spark, sf_dir):
    """W3 over page images that carry no number, in the order of their names."""
    pages = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("doc_id"), F.concat(F.lit("img_"), F.col("event_id").cast("string"), F.lit(".jpg")).alias("page_file"))
    return FO.first_pages(pages).select("doc_id", "page_file", F.col("page_no").cast("bigint").alias("page_no"))


@query("truncated_docs",with_sql(("fx_page_images",), [], "SELECT doc_id, CAST(count(*) AS BIGINT) AS total_pages, "
                                  "CAST(count_if(page_no <= 30) AS BIGINT) AS kept_pages, count(*) > 30 AS truncated FROM fx_page_images GROUP BY doc_id"))
def q_truncated_docs(spark, sf_dir):
    return FO.truncated_docs(fx(spark, sf_dir, "fx_page_images"))


@query("assign_batches", with_sql(PRE_FX, PRE_STEPS, "SELECT submission, path, CAST(row_number() OVER (PARTITION BY submission ORDER BY path) AS BIGINT) AS upload_ord, "
                                  "CAST(floor((row_number() OVER (PARTITION BY submission ORDER BY path) - 1) / 10) AS BIGINT) AS batch "
                                  "FROM outputs WHERE channel = 'visual'"))
def q_assign_batches(spark, sf_dir):
    vis = _pp(spark, sf_dir).outputs.filter(F.col("channel") == "visual").select("submission", PATH)
    return FO.assign_batches(vis).select("submission", PATH, "upload_ord", "batch")


# ---- A1-A5, I7 ---------------------------------------------------------------
@query("preprocess_summary", with_sql(PRE_FX, PRE_STEPS, "SELECT * FROM info"))
def q_preprocess_summary(spark, sf_dir):
    return PP.preprocess_info(_pp(spark, sf_dir))


@query("submission_outcome", with_sql(PRE_FX, PRE_STEPS, "SELECT submission, already_processed, success, failure_reason FROM outcome"))
def q_submission_outcome(spark, sf_dir):
    return PP.submission_outcome(_pp(spark, sf_dir)).select("submission", "already_processed", "success", "failure_reason")


@query("failure_report", with_sql(PRE_FX, PRE_STEPS, "SELECT submission, CAST(count(*) AS BIGINT) AS total_failed_files, "
                                  "CAST(count(DISTINCT filename) AS BIGINT) AS distinct_files FROM eff GROUP BY submission"))
def q_failure_report(spark, sf_dir):
    return R.failure_report(_pp(spark, sf_dir).failures)


@query("failure_reason_summary", with_sql(PRE_FX, PRE_STEPS, "SELECT submission, failure_summary, failed_files FROM reasons"))
def q_failure_reason_summary(spark, sf_dir):
    return R.failure_reason_summary(_pp(spark, sf_dir).failures)


@query("preprocessing_summary", with_sql(PRE_FX, PRE_STEPS, "SELECT CAST(count(*) AS BIGINT) AS total_submissions, "
                                         "CAST(count_if(success) AS BIGINT) AS successful_preprocessing, "
                                         "CAST(count(*) - count_if(success) AS BIGINT) AS failed_preprocessing FROM outcome"))
def q_preprocessing_summary(spark, sf_dir):
    return R.preprocessing_summary(PP.submission_outcome(_pp(spark, sf_dir)))


@query("failed_submissions", with_sql(PRE_FX, PRE_STEPS, f"SELECT submission, coalesce(failure_reason, {G.q(rules.UNKNOWN_ERROR)}) AS failure_reason FROM outcome WHERE NOT success"))
def q_failed_submissions(spark, sf_dir):
    return R.failed_submissions(PP.submission_outcome(_pp(spark, sf_dir)))


@query("preprocess_pipeline", with_sql(PRE_FX, PRE_STEPS, "SELECT * FROM outcome"))
def q_preprocess_pipeline(spark, sf_dir):
    return PP.submission_outcome(_pp(spark, sf_dir))


# ---- S6 and S2 over files derived from the tables -----------------------------------
@query("read_preprocess_info", with_sql(PRE_FX, PRE_STEPS, "SELECT submission AS submission_name, total_original_files, "
                                        "textual_outputs, visual_outputs, skipped_files, failed_files, scanned_pdfs FROM info"))
def q_read_preprocess_info(spark, sf_dir):
    """K1 -> S6 round trip: per-submission info written as JSON documents in
    the shared folder, read back with the permissive reader."""
    import uuid
    from ..session import shared_dir
    from ..sources.files import read_preprocess_info
    info = PP.preprocess_info(_pp(spark, sf_dir))
    counts = ["total_original_files", "textual_outputs", "visual_outputs", "skipped_files", "failed_files", "scanned_pdfs"]
    doc = info.select(F.col("submission").alias("submission_name"),
                      F.date_format(F.current_timestamp(), "EEE MMM d HH:mm:ss yyyy").alias("processing_timestamp"),
                      F.struct(*[F.col(c).cast("bigint").alias(c) for c in counts]).alias("summary"))
    path = shared_dir(spark, f"preprocess_info/{uuid.uuid4().hex}")
    doc.write.mode("overwrite").json(path)
    back = read_preprocess_info(spark, path, multi_line=False)
    return back.select("submission_name", *[F.col(f"summary.{c}").alias(c) for c in counts])


def _written_tree(spark, sf_dir):
    """The fixture inventory as real files below a fresh root in the shared folder."""
    import uuid
    from ..session import shared_dir
    from ..sources.files import write_file_tree
    root = shared_dir(spark, f"file_tree/{uuid.uuid4().hex}")
    root = root[5:] if root.startswith("file:") else root
    files = fx(spark, sf_dir, "fx_files").withColumn("rel", F.regexp_replace("path", "^/in/", ""))
    write_file_tree(files, root).count()
    return root


@query("scan_files")
def q_scan_files(spark, sf_dir):
    """S2 over a real folder tree."""
    from ..sources.files import scan_files
    return scan_files(spark, _written_tree(spark, sf_dir))


@query("scan_file_tree", with_sql(("fx_files",), [], "SELECT DISTINCT split_part(path, '/', 3) AS submission, substr(path, 5) AS rel, name, "
                                  "CAST(coalesce(strlen(content), 0) AS BIGINT) AS size_bytes FROM fx_files"))
def q_scan_file_tree(spark, sf_dir):
    """S2 with paths below the root, so that the listing can be held against the inventory that was written."""
    from ..sources.files import scan_files
    root = _written_tree(spark, sf_dir)
    rel = F.substring("path", len(root.rstrip("/")) + 2, 1 << 20)
    return scan_files(spark, root).select("submission", rel.alias("rel"), "name", "size_bytes")
