"""Requests as ordered parts, and jobs on stored replies."""

from scorewright.functions import prompts as PR
from scorewright.operators import files as FO
from scorewright.operators import requests as RQ


def test_parse_parts_of_a_large_submission_are_numbered_without_gaps(spark):
    outputs = [("S", "visual", f"v{i:04}") for i in range(700)] + [("S", "textual", "t1"), ("N", "textual", "only")]
    rows = RQ.parse_request_rows(spark.createDataFrame([("S", "ctx"), ("E", "no outputs")], "submission string, context string"),
                                 spark.createDataFrame(outputs, "submission string, channel string, output_path string")).collect()
    s = sorted((r for r in rows if r.submission == "S"), key=lambda r: r.ord)
    assert [r.ord for r in s] == list(range(703))
    assert [(r.kind, r.text, r.ref) for r in s[:3]] == [("text", PR.PARSE_INSTRUCTION, None), ("text", "ctx", None), ("file", None, "t1")]
    assert [r.ref for r in s[3:]] == [f"v{i:04}" for i in range(700)]
    assert {r.submission for r in rows} == {"S", "N"}


def test_the_next_assistant_turn_is_the_reply(spark):
    turns = [(1, 0, "system", "s"), (1, 1, "user", "a"), (1, 2, "assistant", "A"), (1, 3, "user", "b"), (1, 4, "user", "c"),
             (1, 5, "assistant", ""), (2, 0, "user", None), (None, 0, "user", "x"), (None, 1, "assistant", "X")]
    got = RQ.turn_pairs(spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")).collect()
    assert {(r.conv_id, r.turn): r.reply for r in got} == {(1, 1): "A", (1, 3): None, (1, 4): "", (2, 0): None, (None, 0): None}


def test_a_request_without_a_reply_is_an_error(spark):
    answer = RQ.stored_answers(spark.createDataFrame([("a", "grading", "fine!")], "submission string, stage string, text string"))
    req = spark.createDataFrame([("a", "grading", "x" * 9), ("b", "grading", "y"), ("a", "parsing", "z")],
                                "submission string, stage string, request string")
    got = {(r.submission, r.stage): (r.text, r.prompt_tokens, r.completion_tokens, r.error) for r in answer(req).collect()}
    assert got == {("a", "grading"): ("fine!", 3, 2, None), ("b", "grading"): (None, None, None, "no stored reply"),
                   ("a", "parsing"): (None, None, None, "no stored reply")}


def test_only_repeated_names_are_numbered(spark):
    rows = [("S", "/1", "a.txt"), ("S", "/2", "a.txt"), ("S", "/3", "a_1.txt"), ("S", "/4", "b.txt"), ("S", "/5", "c.txt"), ("S", "/6", "c.txt"),
            (None, "/1", "d"), (None, "/2", "d"), ("T", "/1", "a.txt"), ("T", "/2", None), ("T", "/3", None)]
    got = {(r.submission, r.path): r.unique_name for r in
           FO.unique_names(spark.createDataFrame(rows, "submission string, path string, name string")).collect()}
    assert got == {("S", "/1"): "a.txt", ("S", "/2"): "a_1.txt", ("S", "/3"): "a_1_1.txt", ("S", "/4"): "b.txt", ("S", "/5"): "c.txt",
                   ("S", "/6"): "c_1.txt", (None, "/1"): "d", (None, "/2"): "d_1", ("T", "/1"): "a.txt", ("T", "/2"): None, ("T", "/3"): None}
