"""Plain-Python expectations for the scalar rules."""

import pathlib

import pytest
from pyspark.sql import functions as F

from scorewright.functions import money as M
from scorewright.functions import paths as P
from scorewright.functions import scores as S
from scorewright.functions import text as X
from scorewright.operators import files as FO

NAMES = ["a.tar.gz", "a.tar.bz2", ".bashrc", "a.", "..foo", ".a.txt", "X.PDF", "noext", "a.b c", "a..",
         "a.d.e", "..data", "Thumbs.db", "thumbs.db"]
DIRS = ["Doe_Jane_12_99", "Doe_Jane_M_12_99", "Doe_12_99", "_1_2", "a_b", "x", "__", "a__b_", "D_"]


def py_details(d):
    try:
        name_and_id, mat = d.rsplit("_", 1)
        name_part, sid = name_and_id.rsplit("_", 1)
        parts = name_part.split("_")
        return (parts[0], "_".join(parts[1:]) if len(parts) > 1 else parts[0], sid, mat)
    except ValueError:
        return (d, "", "unknown", "unknown")


def test_file_ext_and_stem_match_pathlib(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "name string")
    got = {r["name"]: (r["ext"], r["stem"]) for r in df.select(
        "name", P.file_ext(F.col("name")).alias("ext"), P.file_stem(F.col("name")).alias("stem")).collect()}
    for n in NAMES:
        p = pathlib.PurePosixPath(n)
        assert got[n] == (p.suffix.lower(), p.stem), n


def test_student_details_match_rsplit(spark):
    df = spark.createDataFrame([(d,) for d in DIRS], "d string")
    rows = df.select("d", P.student_details(F.col("d")).alias("s")).collect()
    for r in rows:
        s = r["s"]
        assert (s.last_name, s.first_name, s.student_id, s.matriculation_number) == py_details(r["d"]), r["d"]


def test_collapse_ws_matches_str_split(spark):
    texts = ["  a\tb\x0bc\x1cd\x85e f g  ", "﻿x  y", "", "   "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(X.collapse_ws(F.col("t"))).collect()]
    assert got == [" ".join(t.split()) for t in texts]


def test_extractable_text_thresholds(spark):
    # exactly 70 % alnum/space is rejected (strict >), 50 chars minimum
    t70 = "a" * 35 + " " * 0 + "!" * 15          # 35/50 = 0.7
    t72 = "a" * 36 + "!" * 14                     # 0.72
    short = "a" * 49
    df = spark.createDataFrame([(t70,), (t72,), (short,)], "t string")
    got = [r[0] for r in df.select(X.has_extractable_text(F.col("t"))).collect()]
    assert got == [False, True, False]


def test_sniff_threshold_is_strict(spark):
    t80 = "a" * 8 + "\x00" * 2   # 0.8 printable -> rejected
    t90 = "a" * 9 + "\x00"
    df = spark.createDataFrame([(t80,), (t90,), ("",)], "t string")
    got = [r[0] for r in df.select(X.looks_like_text(F.col("t"))).collect()]
    assert got == [False, True, False]


@pytest.mark.parametrize("size,category,expected", [
    (5 * 1048576, "textual", None), (5 * 1048576 + 1, "textual", "File too large (5.0MB > 5MB)"),
    (10 * 1048576, "visual", None), (75 * 1048576, "mixed", None), (100 * 1048576, "archive", None),
    (int(5.25 * 1048576), "textual", "File too large (5.2MB > 5MB)"),
    (int(5.75 * 1048576), "textual", "File too large (5.8MB > 5MB)"),
])
def test_size_limit_reason(spark, size, category, expected):
    df = spark.createDataFrame([(size, category)], "s long, c string")
    assert df.select(P.size_limit_reason(F.col("s"), F.col("c"))).first()[0] == expected
    if expected:
        assert f"{size / 1048576:.1f}" in expected


@pytest.mark.parametrize("model,p,c,thinking,expected", [
    ("pro", 1_000_000, 1_000_000, False, 11.25), ("flash", 1_000_000, 1_000_000, False, 0.75),
    ("flash", 1_000_000, 1_000_000, True, 3.65), ("pro", 1_000_000, 1_000_000, True, 11.25),
    ("pro", 0, 0, False, 0.0), ("other", 10, 10, False, None),
])
def test_request_cost(spark, model, p, c, thinking, expected):
    df = spark.createDataFrame([(model, p, c, thinking)], "m string, p long, c long, t boolean")
    r = df.select(M.request_cost(F.col("m"), F.col("p"), F.col("c"), F.col("t")).alias("cost"),
                  M.cost_error(F.col("m")).alias("err")).first()
    if expected is None:
        assert r.cost is None and r.err == "Model must be 'flash' or 'pro'."
    else:
        pin, pout = {("pro", False): (1.25, 10.0), ("pro", True): (1.25, 10.0),
                     ("flash", False): (0.15, 0.60), ("flash", True): (0.15, 3.50)}[(model, thinking)]
        assert r.cost == (p / 1_000_000) * pin + (c / 1_000_000) * pout == pytest.approx(expected)


def test_retry_waits(spark):
    df = spark.createDataFrame([(3,), (0,)], "r int")
    got = [r[0] for r in df.select(M.retry_waits(F.col("r"), 5)).collect()]
    assert got == [[5, 10, 20], []]


def test_last_json_block_and_status(spark):
    fence = "```"
    replies = [None, f"{fence}json\n[1,2]\n{fence}", f"{fence}json {{\"a\":1}}{fence} x {fence}json\n{{\"b\":2}}\n{fence} tail",
               f"{fence}JSON\n{{}}\n{fence}", f"{fence}json\n{{\"a\": \n{fence}"]
    df = spark.createDataFrame([(r,) for r in replies], "r string")
    rows = df.select(S.extract_last_json(F.col("r")).alias("j")).select("j", S.json_status(F.col("j")).alias("s")).collect()
    assert [(r.j, r.s) for r in rows] == [(None, "no_json"), ("[1,2]", "ok"), ('{"b":2}', "ok"),
                                          (None, "no_json"), ('{"a":', "parse_error")]


def test_classify_first_rule_wins(spark):
    rows = [("S1", "/in/S1/._a.txt", "._a.txt", 10, "hi"), ("S1", "/in/S1/w.npy", "w.npy", 0, ""),
            ("S1", "/in/S1/e.txt", "e.txt", 0, ""), ("S1", "/in/S1/u.foo", "u.foo", 5, "plain text"),
            ("S1", "/in/S1/b.foo", "b.foo", 5, "\x00\x01\x02"), ("S1", "/in/S1/big.png", "big.png", 11 * 1048576, ""),
            ("S1", "/in/S1/ok.PY", "ok.PY", 3, "x=1"), ("S1", "/in/S1/__MACOSX/x.txt", "x.txt", 3, "abc")]
    df = spark.createDataFrame(rows, "submission string, path string, name string, size_bytes long, content string")
    got = {r.name: (r.should_process, r.category, r.skip_reason) for r in FO.classify_files(df).collect()}
    assert got["._a.txt"] == (False, "", "System/hidden file")
    assert got["w.npy"] == (False, "", "Unsupported file type")
    assert got["e.txt"] == (False, "", "Empty file")
    assert got["u.foo"] == (True, "textual", "")
    assert got["b.foo"] == (False, "", "Unknown binary file type")
    assert got["big.png"] == (False, "", "File too large (11.0MB > 10MB)")
    assert got["ok.PY"] == (True, "textual", "")
    assert got["x.txt"][2] == "System/hidden file"
