"""Sinks and the directory listing (tests write under a fresh temp folder)."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from scorewright import sinks
from scorewright.sources.files import read_file_contents, scan_files


def _path(name):
    return os.path.join(tempfile.mkdtemp(prefix="sw-sink-"), name)


def test_ledger_insert_if_absent_and_idempotent(spark):
    path = _path("ledger")
    a = spark.createDataFrame([("s1", "parsing"), ("s2", "parsing"), ("s2", "parsing")], "submission string, stage string")
    new1 = sinks.write_ledger(a, path, ["submission", "stage"], run_date="2026-01-01")
    assert new1.count() == 2
    b = spark.createDataFrame([("s2", "parsing"), ("s3", "parsing")], "submission string, stage string")
    sinks.write_ledger(b, path, ["submission", "stage"], run_date="2026-01-02")
    again = sinks.write_ledger(b, path, ["submission", "stage"], run_date="2026-01-02")   # retried run
    assert [r.submission for r in again.collect()] == ["s3"]
    rows = sorted((r.submission, str(r.run_date)) for r in spark.read.parquet(path).collect())
    assert rows == [("s1", "2026-01-01"), ("s2", "2026-01-01"), ("s3", "2026-01-02")]


def test_ledger_upsert_replaces_and_dedupes(spark):
    path, cols = _path("ledger"), "submission string, seq int, value string"
    sinks.write_ledger(spark.createDataFrame([("s1", 1, "old"), ("s1", 2, "newer"), ("s2", 1, "x")], cols), path, ["submission"],
                       run_date="2026-01-01", run_id="a", mode="upsert", seq="seq")
    sinks.write_ledger(spark.createDataFrame([("s1", 1, "regraded")], cols), path, ["submission"],
                       run_date="2026-01-01", run_id="b", mode="upsert", seq="seq")
    got = {r.submission: r.value for r in sinks.read_ledger(spark, path, cols, ["submission"]).collect()}
    assert got == {"s1": "regraded", "s2": "x"}
    assert sinks.read_ledger(spark, path + "-none", cols, ["submission"]).count() == 0


def test_ledger_read_errors_rise(spark):
    path = _path("ledger")
    os.makedirs(f"{path}/run_date=2026-01-01/run_id=a")
    with open(f"{path}/run_date=2026-01-01/run_id=a/part-0.parquet", "wb") as f:
        f.write(b"not parquet")
    df = spark.createDataFrame([("s1", "v")], "submission string, value string")
    with pytest.raises(Exception):
        sinks.write_ledger(df, path, ["submission"], run_date="2026-01-02")
    assert os.path.exists(f"{path}/run_date=2026-01-01/run_id=a/part-0.parquet")


def test_processing_report_is_ordered(spark):
    results = spark.createDataFrame(
        [("b", "success", "skipped", None, "grading_result.json already exists"),
         ("a", "failed", "skipped", "Failed to parse submission", "Parsing failed"),
         ("c", "success", "success", None, None)],
        "submission string, parsing string, grading string, parsing_reason string, grading_reason string")
    path = _path("report")
    sinks.write_processing_report(results, path, generated="2026-01-01 00:00:00", partitions=3)
    parts = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    text = "".join(open(f"{path}/{p}").read() for p in parts)
    rule, sub, detail = "=" * 80, "-" * 40, "-" * 50
    expected = [rule, "COMPREHENSIVE PROCESSING REPORT", rule, "Generated: 2026-01-01 00:00:00", "Total Submissions Processed: 3", "",
                "PARSING SUMMARY:", sub, "✓ Successful: 2", "⏭ Skipped: 0", "✗ Failed: 1", "",
                "GRADING SUMMARY:", sub, "✓ Successful: 1", "⏭ Skipped: 2", "✗ Failed: 0", "",
                rule, "DETAILED RESULTS", rule, "", "PARSING RESULTS:", detail,
                "✓ SUCCESSFUL PARSING:", "  • b", "  • c", "", "✗ FAILED PARSING:", "  • a - Failed to parse submission", "",
                "GRADING RESULTS:", detail, "✓ SUCCESSFUL GRADING:", "  • c", "",
                "⏭ SKIPPED GRADING:", "  • a - Parsing failed", "  • b - grading_result.json already exists", "",
                rule, "END OF REPORT", rule]
    assert text == "\n".join(expected) + "\n"
    back = sinks.read_report(spark, path).orderBy("line_no").collect()
    assert [r.line for r in back] == expected and [r.line_no for r in back] == list(range(1, len(expected) + 1))


def test_invalid_report_counts_entries(spark):
    path = _path("invalid")
    rows = spark.createDataFrame([("b", "invalid"), ("a", "not_preprocessed"), ("a", "invalid")], "submission string, kind string")
    sinks.write_invalid_report(rows, path, partitions=2)
    lines = [r.line for r in sinks.read_report(spark, path).orderBy("line_no").collect()]
    assert lines[:4] == ["=== INVALID SUBMISSIONS SUMMARY ===", "", "Total invalid submissions: 3", ""]
    assert [x for x in lines if x.startswith("Report: ")] == ["Report: a_invalid.txt", "Report: a_not_preprocessed.txt", "Report: b_invalid.txt"]


def test_scan_files_keeps_hidden_and_empty(spark):
    root = tempfile.mkdtemp(prefix="sw-scan-")
    for sub, rel, data in [("S1", "a.txt", b"x"), ("S1", "deep/.hidden", b"h"), ("S1", "empty.md", b""),
                           ("S2", "__MACOSX/._a", b"m"), ("#reports", "r.txt", b"r")]:
        p = os.path.join(root, sub, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        open(p, "wb").write(data)
    listed = scan_files(spark, root)
    got = sorted((r.submission, r.name, r.size_bytes) for r in listed.collect())
    assert ("S1", ".hidden", 1) in got and ("S1", "empty.md", 0) in got and ("S2", "._a", 1) in got
    withc = read_file_contents(spark, root, listed.filter(F.col("submission") == "S1"))
    got_c = {r.name: (bytes(r.content) if r.content is not None else None) for r in withc.collect()}
    assert got_c["a.txt"] == b"x"


def test_ledger_shows_the_latest_of_many_runs(spark):
    path, cols = _path("ledger"), "submission string, value int"
    for run in range(1, 13):
        sinks.write_ledger(spark.createDataFrame([("s1", run), (f"only{run}", run)], cols), path, ["submission"],
                           run_date="2026-01-01", run_id=str(run), mode="upsert")
    got = {r.submission: r.value for r in sinks.read_ledger(spark, path, cols, ["submission"]).collect()}
    assert got == {"s1": 12, **{f"only{k}": k for k in range(1, 13)}}
    names = ["run-2", "run-10", "10", "9", "a", "", "v1.9", "v1.10", "007", "8"]
    rows = spark.createDataFrame([("2026-01-01", n) for n in names] + [("2025-12-31", "99")], "run_date string, run_id string")
    turn = [r.run_id for r in rows.orderBy(sinks.run_order()).collect()]
    assert turn == ["99", "", "007", "8", "9", "10", "a", "run-2", "run-10", "v1.9", "v1.10"]
