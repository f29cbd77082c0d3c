"""Skip-finished-work joins and the per-submission stage machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import rules


def pending(items: DataFrame, done: DataFrame, key: str | list[str], force: bool = False) -> DataFrame:
    """Rows whose output does not exist yet (``force``: all rows)."""
    return items if force else items.join(done.select(key).distinct(), key, "left_anti")


def already_done(items: DataFrame, done: DataFrame, key: str | list[str]) -> DataFrame:
    """The complement of J1, reported as skipped."""
    return items.join(done.select(key).distinct(), key, "left_semi")


def not_preprocessed(submissions: DataFrame, processed: DataFrame, key: str) -> DataFrame:
    """Submissions without preprocessed output."""
    return submissions.join(processed.select(key).distinct(), key, "left_anti")


def attach_solution(submissions: DataFrame, solutions: DataFrame, key: str = "assignment_id") -> DataFrame:
    """Each submission with its assignment's solution.  Equi-join; AQE
    broadcasts the solutions side at run time when it is small (a run has
    one), and keeps a shuffle join when it is not."""
    return submissions.join(solutions, key)


MODES = ("incremental", "regrade", "full")


def stage_plan(subs: DataFrame, mode: str = "incremental") -> DataFrame:
    """I8: which stages run per submission.  ``subs`` has parsed_exists and
    graded_exists.  incremental: only missing outputs; regrade: grade again,
    reuse parsed text (the documented meaning, D2); full: redo both."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    pe, ge = F.col("parsed_exists"), F.col("graded_exists")
    do_parse = F.lit(True) if mode == "full" else ~pe
    do_grade = F.lit(True) if mode in ("regrade", "full") else ~ge
    return subs.withColumn("do_parse", do_parse).withColumn("do_grade", do_grade)


def stage_status(plan: DataFrame) -> DataFrame:
    """(parsing, grading, reasons) from the plan and the call outcomes
    ``parse_ok`` / ``grade_ok`` (null when the call was not made).

    parsing: skipped (output exists) / success / failed -> grading skipped
    'Parsing failed'; grading: skipped (result exists) / success / failed.
    Optional columns: ``parse_exception`` and ``grade_exception`` (text of an
    error raised outside the call), ``run_exception`` (the whole submission's
    worker failed) and ``parsed_present`` (false: no parsed text to grade)."""
    def optional(name, kind):
        return F.col(name) if name in plan.columns else F.lit(None).cast(kind)

    parse_ok, grade_ok = F.col("parse_ok"), F.col("grade_ok")
    run_x, parse_x, grade_x = (optional(c, "string") for c in ("run_exception", "parse_exception", "grade_exception"))
    missing = ~F.coalesce(optional("parsed_present", "boolean"), F.lit(True))
    failed_parse = F.col("do_parse") & ~F.coalesce(parse_ok, F.lit(False))
    thread = F.concat(F.lit(rules.THREAD_EXCEPTION), run_x)
    parse_error, grade_error = (F.concat(F.lit(rules.EXCEPTION), x) for x in (parse_x, grade_x))
    cases = [  # (condition, parsing, grading, parsing reason, grading reason), first match wins
        (run_x.isNotNull(), "failed", "failed", thread, thread),
        (parse_x.isNotNull(), "failed", "failed", parse_error, parse_error),
        (failed_parse, "failed", "skipped", F.lit(rules.PARSE_FAILED), F.lit(rules.PARSING_FAILED_FOR_GRADE)),
        (missing, None, "failed", None, F.lit(rules.NO_PARSED_FILE)),
        (grade_x.isNotNull(), None, "failed", None, grade_error),
        (~F.col("do_grade"), None, "skipped", None, F.lit(rules.GRADED_EXISTS)),
        (grade_ok, None, "success", None, F.lit("")),
    ]
    usual = (F.when(F.col("do_parse"), "success").otherwise("skipped"), F.lit("failed"),
             F.when(F.col("do_parse"), "").otherwise(rules.PARSED_EXISTS), F.lit(rules.GRADE_FAILED))
    out = {}
    for i, name in enumerate(("parsing", "grading", "parsing_reason", "grading_reason")):
        value = usual[i]
        for case in reversed(cases):
            then = usual[i] if case[i + 1] is None else F.lit(case[i + 1]) if isinstance(case[i + 1], str) else case[i + 1]
            value = F.when(F.coalesce(case[0], F.lit(False)), then).otherwise(value)
        out[name] = value
    return plan.withColumns(out)
