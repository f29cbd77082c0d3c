"""The preprocess job as one Spark plan.

files -> (already processed? skip) -> S3 -> F7 -> S8 (archives, Python) ->
W2 -> F10/F11 -> failures -> A1 counts, A2 outcome, A4 reasons, A5 summary.

One pass builds a per-file fact table; every roll-up is a groupBy on
``submission`` over it, partially aggregated before the shuffle, so a
submission holding a large share of the files costs one map-side combine,
not one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

from .. import rules
from ..functions import paths as P
from ..functions import text as X
from ..operators import files as FO
from ..operators import reports as R
from ..session import ensure_checkpoint_dir
from ..sources.archives import expand_archives


def relative_path(path="path", submission="submission"):
    """Path below the submission root ('<...>/<submission>/<rel>')."""
    p, s = F.col(path), F.col(submission)
    pos = F.instr(p, F.concat(F.lit("/"), s, F.lit("/")))
    return F.when(pos > 0, p.substr(pos + F.length(s) + 2, F.lit(1 << 30))).otherwise(p)


def _as_text(df: DataFrame, col: str = "content") -> F.Column:
    if isinstance(df.schema[col].dataType, T.BinaryType):
        s = F.col(col).cast("string")
        return F.when(F.is_valid_utf8(s), s)
    return F.col(col)


@dataclass
class Preprocessed:
    submissions: DataFrame      # every submission folder (S1)
    done: DataFrame             # already processed (J1 for preprocess)
    classified: DataFrame       # F7 over files below pending roots
    files: DataFrame            # processable non-archive files incl. archive members, with unique_name, has_text
    routes: DataFrame           # F11 outputs before failures
    failures: DataFrame         # failures that hit a produced output
    outputs: DataFrame          # routes minus failed conversions
    archive_errors: DataFrame   # archives (or members) that could not be read: submission, path, name, error


FAILURE_COLUMNS = ("submission", "path", "failure_reason", "conversion_type", "order_key")


def preprocess(files: DataFrame, failures: DataFrame | None = None, max_depth: int = 1) -> Preprocessed:
    """Build the preprocess plan.

    ``files``: submission, path, name, size_bytes, content; other columns are carried along for top-level files.
    ``failures``: submission, path (of a file or an archive member), failure_reason, conversion_type ('PDF' or 'Image')
    and, if present, order_key, by which a submission's reasons are told in turn (else by path).

    The plan is lazy but for one write: the table of classified files and members, sorted for naming, from which all
    roll-ups read.  An unreadable archive is listed in ``archive_errors``; the counts are those of files."""
    ensure_checkpoint_dir(files.sparkSession)
    f = files.filter(~F.col("submission").startswith("#")).withColumn("rel", relative_path())
    submissions = f.select("submission").distinct()
    done = f.filter(F.col("rel").startswith("processed/")).select("submission").distinct()
    below = FO.exclude_processed(f.join(done, "submission", "left_anti"), "rel")

    def texted(df):
        is_pdf = (F.col("category") == "mixed") & (F.col("ext") == ".pdf")
        # collapsed once; the verdict and the sample both read it
        flat = df.withColumn("__flat", F.when(is_pdf, X.collapse_ws(_as_text(df))))
        told = flat.withColumn("has_text", F.when(is_pdf, X.has_extractable_text("__flat", True)).otherwise(F.lit(False)))
        sample = X.scanned_sample(X.text_sample("__flat", True, F.col("has_text")))
        return told.withColumn("text_sample", F.when(is_pdf, sample)).drop("__flat")

    top = texted(FO.classify_files(below))
    opened = expand_archives(top.filter(F.col("category") == "archive"), max_depth=max_depth)
    members = texted(FO.classify_files(opened.filter(F.col("error").isNull()).select(
        "submission", F.col("member_path").alias("path"), "name", "size_bytes", "content")))
    errors = opened.filter(F.col("error").isNotNull()).select(
        "submission", F.coalesce("member_path", "archive_path").alias("path"), F.coalesce("name", F.lit("")).alias("name"), "error")
    facts = (top.drop("content").withColumn("kind", F.lit("file"))
             .unionByName(members.drop("content").withColumn("kind", F.lit("member")), allowMissingColumns=True)
             .unionByName(errors.withColumn("kind", F.lit("archive_error")), allowMissingColumns=True))
    # only files that are taken on compete for names: the others are numbered apart
    taken = F.col("should_process") & ~((F.col("kind") == "file") & (F.col("category") == "archive"))
    facts = FO.unique_names(facts.withColumn("taken", F.coalesce(taken, F.lit(False)))
                            .withColumn("sub", F.col("submission"))
                            .withColumn("submission", F.concat(F.when(F.col("taken"), "f").otherwise("-"), F.col("submission"))))
    facts = facts.withColumn("submission", F.col("sub")).drop("sub")
    classified = facts.filter(F.col("kind") == "file").drop("unique_name", "taken", "kind", "error")
    named = facts.filter("taken").drop("taken", "error")
    archive_errors = facts.filter(F.col("kind") == "archive_error").select("submission", "path", "name", "error")
    routes = FO.route_channels(named)

    hit = routes.select("submission", "path", "channel", F.col("unique_name").alias("filename"))
    if failures is None:
        failures = hit.limit(0).select("submission", "path", *[F.lit(None).cast("string").alias(c) for c in FAILURE_COLUMNS[2:]])
    if "order_key" not in failures.columns:
        failures = failures.withColumn("order_key", F.col("path"))
    fl = failures.select(*FAILURE_COLUMNS).withColumn(
        "channel", F.when(F.col("conversion_type") == "PDF", "textual").otherwise("visual"))
    eff = fl.join(hit, ["submission", "path", "channel"]).select(
        "submission", "path", "filename", "failure_reason", "conversion_type", "order_key", "channel")
    outputs = routes.join(eff.select("submission", "path", "channel").distinct(), ["submission", "path", "channel"], "left_anti")
    return Preprocessed(submissions, done, classified, named, routes, eff, outputs, archive_errors)


def file_lists(pp: Preprocessed) -> DataFrame:
    """The lists of the preprocess result as rows (submission, kind, name, path, size_bytes, detail).

    kind: original (detail: category), textual and visual (name: output path), skipped (detail: reason), scanned
    (detail: text sample), failed (detail: reason), archive_error (detail: error)."""
    def rows(df, kind, name="name", detail=None, size="size_bytes"):
        return df.select("submission", F.lit(kind).alias("kind"), F.col(name).alias("name"), "path",
                         (F.col(size) if size else F.lit(None)).cast("bigint").alias("size_bytes"),
                         (F.col(detail) if detail else F.lit(None)).cast("string").alias("detail"))

    return (rows(pp.files, "original", "unique_name", "category")
            .unionByName(rows(pp.outputs.filter("channel = 'textual'"), "textual", "output_path"))
            .unionByName(rows(pp.outputs.filter("channel = 'visual'"), "visual", "output_path"))
            .unionByName(rows(FO.reportable_skips(pp.classified), "skipped", detail="skip_reason"))
            .unionByName(rows(FO.scanned_pdfs(pp.files), "scanned", "filename", "text_sample"))
            .unionByName(rows(pp.failures, "failed", "filename", "failure_reason", size=None))
            .unionByName(rows(pp.archive_errors, "archive_error", detail="error", size=None)))


COUNTS = ("total_original_files", "textual_outputs", "visual_outputs", "skipped_files", "failed_files", "scanned_pdfs")


def preprocess_info(pp: Preprocessed) -> DataFrame:
    """A1: the six counts per pending submission with processable files.

    One union of per-row indicators and one groupBy: a single shuffle,
    combined map-side, instead of joining four aggregates."""
    def ind(df, **flags):
        return df.select("submission", *[(flags[c] if c in flags else F.lit(0)).cast("bigint").alias(c) for c in COUNTS])

    scanned = (F.col("category") == "mixed") & (F.col("ext") == ".pdf") & ~F.col("has_text")
    rows = (ind(pp.files, total_original_files=F.lit(1), scanned_pdfs=scanned.cast("int"))
            .unionByName(ind(pp.outputs, textual_outputs=(F.col("channel") == "textual").cast("int"),
                             visual_outputs=(F.col("channel") == "visual").cast("int")))
            .unionByName(ind(FO.reportable_skips(pp.classified), skipped_files=F.lit(1)))
            .unionByName(ind(pp.failures, failed_files=F.lit(1))))
    return (rows.groupBy("submission").agg(*[F.sum(c).alias(c) for c in COUNTS])
            .filter(F.col("total_original_files") > 0))


def submission_outcome(pp: Preprocessed, info: DataFrame | None = None) -> DataFrame:
    """A2: success / failure reason per submission folder (already processed
    -> success; nothing processable -> failed; any failed file -> failed)."""
    info = info if info is not None else preprocess_info(pp)
    reasons = R.failure_reason_summary(pp.failures).select("submission", "failure_summary")
    done = pp.done.withColumn("already_processed", F.lit(True))
    j = pp.submissions.join(done, "submission", "left").join(info, "submission", "left") \
        .join(reasons, "submission", "left")
    already = F.coalesce(F.col("already_processed"), F.lit(False))
    nfiles = F.coalesce(F.col("total_original_files"), F.lit(0))
    success = already | ((nfiles > 0) & (F.coalesce(F.col("failed_files"), F.lit(0)) == 0))
    reason = (F.when(already, F.lit(None).cast("string"))
              .when(nfiles == 0, F.lit(rules.NO_FILES_REASON))
              .when(F.col("failure_summary").isNotNull(), F.col("failure_summary")))
    return j.select("submission", already.alias("already_processed"), success.alias("success"),
                    reason.alias("failure_reason"),
                    *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in
                      ("total_original_files", "textual_outputs", "visual_outputs", "skipped_files",
                       "failed_files", "scanned_pdfs")])
