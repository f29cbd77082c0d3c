"""Grading and model-solution jobs composed from the operators.

Model responses are persisted right after each call stage, so scores, usage,
status and reports all read the stored responses and never call twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from ..functions import money as M
from ..functions import prompts as PR
from ..operators import enrich as E
from ..operators import ledger as L
from ..operators import rubric as RB
from ..operators import scores as SC


def grade_inputs(plan: DataFrame, parsed: DataFrame, key: str = "submission") -> DataFrame:
    """Rows to grade with their ``parsed_text``: this run's parse where one was made, else the stored one.

    ``plan``: do_parse, do_grade, stored_text; ``parsed``: parse_ok, parsed_text.  A failed parse, or none stored, is
    not graded."""
    j = plan.join(parsed.select(key, "parse_ok", "parsed_text"), key, "left")
    text = F.when(F.col("do_parse"), F.when(F.col("parse_ok"), F.col("parsed_text"))).otherwise(F.col("stored_text"))
    return j.withColumn("parsed_text", text).filter(F.col("do_grade") & F.col("parsed_text").isNotNull())


Answer = Callable[[DataFrame], DataFrame]


def called(client_factory: Callable, **call_opts) -> Answer:
    """The answering stage that calls a model: every response is written once."""
    return lambda requests: E.persist_responses(E.invoke_model(requests, client_factory, **call_opts))


def grade_pipeline(submissions: DataFrame, solutions: DataFrame, client_factory: Callable | None = None,
                   parsed_ledger: DataFrame | None = None, graded_ledger: DataFrame | None = None,
                   mode: str = "incremental", parallel: int | None = None, answer: Answer | None = None,
                   **call_opts) -> dict[str, DataFrame]:
    """Answers come from ``client_factory``'s model, or from ``answer`` (such as ``requests.stored_answers``).
    ``submissions``: submission, assignment_id, text; ``solutions``:
    assignment_id, solution, hint.  ``parsed_ledger``: submission, parsed_text
    of work already parsed (J1), which grading then reads; ``graded_ledger``:
    submissions already graded (J2).  Returns responses, scores, usage and status."""
    key = "submission"
    answer = answer or called(client_factory, parallel=parallel, key=key, **call_opts)
    subs = submissions
    spark = subs.sparkSession
    empty = spark.createDataFrame([], f"{key} string, parsed_text string").withColumn(key, F.col(key).cast(subs.schema[key].dataType))
    parsed_ledger = parsed_ledger if parsed_ledger is not None else empty
    graded_ledger = graded_ledger if graded_ledger is not None else empty
    flags = (subs.join(parsed_ledger.groupBy(key).agg(F.max("parsed_text").alias("stored_text"), F.lit(True).alias("parsed_exists")), key, "left")
             .join(graded_ledger.select(key).distinct().withColumn("graded_exists", F.lit(True)), key, "left")
             .na.fill(False, ["parsed_exists", "graded_exists"]))
    plan = L.stage_plan(flags, mode)

    context = PR.build_context(F.col(key).cast("string"), F.lit(None), F.lit(None), F.lit(None), F.lit(None), F.lit(None))
    parse_req = plan.filter("do_parse").select(key, F.lit("parsing").alias("stage"),
                                              F.concat(F.lit(PR.PARSE_INSTRUCTION), context, F.lit("\n\n"), F.col("text")).alias("request"))
    parsed = answer(parse_req)
    parse_ok = parsed.select(key, (F.col("error").isNull() & ~PR.is_empty_reply(F.col("text"))).alias("parse_ok"),
                             PR.empty_reply(F.col("text")).alias("parsed_text"))

    graded_in = (grade_inputs(plan, parse_ok, key)
                 .join(solutions, "assignment_id"))   # J4: AQE broadcasts the solutions side when small
    grade_req = graded_in.select(key, F.lit("grading").alias("stage"),
                                 PR.build_grade_request(F.col("hint"), F.col("solution"), F.col("parsed_text")).alias("request"))
    graded = answer(grade_req)

    replies = SC.parse_replies(graded.filter(F.col("error").isNull()).select(key, F.col("text").alias("report")))
    scores = SC.flatten_scores(replies)
    responses = parsed.unionByName(graded)
    blank_parse = (F.col("stage") == "parsing") & PR.is_empty_reply(F.col("text"))  # T14: such a call is not recorded
    usage = responses.filter(F.col("error").isNull() & F.col("prompt_tokens").isNotNull() & ~blank_parse).withColumn(
        "total_tokens", M.total_tokens(F.col("prompt_tokens"), F.col("completion_tokens"))).withColumn(
        "cost_usd", M.request_cost(F.col("model_type"), F.col("prompt_tokens"), F.col("completion_tokens")))
    grade_ok = graded.select(key, (F.col("error").isNull() & ~PR.is_empty_reply(F.col("text"))).alias("grade_ok"))
    present = ~(~F.col("do_parse") & F.col("stored_text").isNull())
    status = L.stage_status(plan.join(parse_ok.select(key, "parse_ok"), key, "left").join(grade_ok, key, "left")
                            .withColumn("parsed_present", present)) \
        .join(replies.select(key, "json_status"), key, "left")
    return {"responses": responses, "replies": replies, "scores": scores, "usage": usage, "status": status}


def solution_pipeline(solutions: DataFrame, client_factory: Callable | None = None, answer: Answer | None = None,
                      rubric: DataFrame | None = None, **call_opts) -> dict[str, DataFrame]:
    """``solutions``: assignment_id, solution_text, hint.  Two model calls
    (extract, then enhance with the hint), both retried and both with usage
    rows (D5); then T9 units and T10 checks against ``rubric`` (default: the W1 rubric of the hints)."""
    key = "assignment_id"
    answer = answer or called(client_factory, **call_opts)
    extract_req = solutions.select(key, F.lit("solution_extract").alias("stage"),
                                   F.concat(F.lit(PR.SOLUTION_EXTRACT_INSTRUCTION), F.col("solution_text")).alias("request"))
    extracted = answer(extract_req)
    enhance_req = extracted.join(solutions, key).select(
        key, F.lit("solution_enhance").alias("stage"),
        F.concat(PR.fill_hint(PR.SOLUTION_INSTRUCTION, F.col("hint")), F.lit("\n"),
                 F.coalesce(F.col("text"), F.lit(""))).alias("request"))
    enhanced = answer(enhance_req)
    units = RB.parse_solution_units(enhanced.filter(F.col("error").isNull()).select(key, F.col("text").alias("markdown")))
    rubric = RB.parse_structure_hint(solutions.select(key, "hint")) if rubric is None else rubric
    checks = RB.validate_solution(units, rubric)
    responses = extracted.unionByName(enhanced)
    usage = responses.filter(F.col("error").isNull()).withColumn(
        "cost_usd", M.request_cost(F.col("model_type"), F.col("prompt_tokens"), F.col("completion_tokens")))
    return {"responses": responses, "units": units, "checks": checks, "usage": usage}


__all__ = ["called", "grade_inputs", "grade_pipeline", "solution_pipeline"]
