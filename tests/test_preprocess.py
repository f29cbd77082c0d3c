"""Rows that must not get lost: members, corrupt archives, repeated paths, ties; grading inputs."""

import io
import random
import zipfile

from pyspark.sql import Window, functions as F

from scorewright.operators import enrich as E
from scorewright.operators import files as FO
from scorewright.operators.ranking import rank_within
from scorewright.plans import grading as GR
from scorewright.plans import preprocess as PP

FILES = "submission string, path string, name string, size_bytes bigint, content binary"


def _zip(members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        for name, data in members:
            zf.writestr(name, data)
    return buf.getvalue()


def _file(sub, rel, data):
    return sub, f"/in/{sub}/{rel}", rel.rsplit("/", 1)[-1], len(data), data


def test_rank_within_is_a_numbering(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(20), i) for i in range(500)] + [("hot", 7, i) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, o int, id int").repartition(7)
    got = rank_within(df, ["k"], ["o"], partitions=5)
    assert got.count() == len(rows)
    per = got.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("rn").alias("d"), F.min("rn").alias("lo"), F.max("rn").alias("hi"))
    assert all(r.n == r.d == r.hi and r.lo == 1 for r in per.collect())
    later = Window.partitionBy("k").orderBy("rn")
    assert got.withColumn("before", F.lag("o").over(later)).filter("before > o").count() == 0


def test_repeated_paths_stay_single_rows(spark):
    rows = [("S", "/S/a.zip!/x.txt", "x.txt")] * 3 + [("S", "/S/x_1.txt", "x_1.txt")]
    got = FO.unique_names(spark.createDataFrame(rows, "submission string, path string, name string")).collect()
    assert len(got) == 4 and len({r.unique_name for r in got}) == 4


def test_member_failures_and_corrupt_archives_are_reported(spark):
    pdf = b"x" * 10
    rows = [_file("S1", "a.zip", _zip([("in/scan.pdf", pdf)])), _file("S2", "broken.zip", b"PK\x03\x04 not really"),
            _file("S2", "b.txt", b"plain text"), _file("S3", "c.txt", b"more text")]
    failures = [("S1", "/in/S1/a.zip!/in/scan.pdf", "Image conversion failed: None", "Image")]
    pp = PP.preprocess(spark.createDataFrame(rows, FILES),
                       spark.createDataFrame(failures, "submission string, path string, failure_reason string, conversion_type string"))
    out = {r.submission: r for r in PP.submission_outcome(pp).collect()}
    assert (out["S1"].success, out["S1"].failed_files, out["S1"].failure_reason) == (False, 1, "scan.pdf: Image conversion failed: None")
    assert out["S2"].success and out["S3"].success
    assert [(r.submission, r.path) for r in pp.archive_errors.collect()] == [("S2", "/in/S2/broken.zip")]
    kinds = {(r.submission, r.kind, r.name) for r in PP.file_lists(pp).collect()}
    assert {("S1", "original", "scan.pdf"), ("S1", "failed", "scan.pdf"), ("S1", "scanned", "scan.pdf"), ("S2", "archive_error", ""),
            ("S3", "textual", "processed/textual/c.txt")} <= kinds


def test_only_the_head_of_binary_content_decides(spark):
    rows = [_file("S", "notes.abc", b"plain words " * 2000 + b"\xff\xfe"), _file("S", "cut.abc", ("é" * 3000).encode()[:-1]),
            _file("S", "bad.abc", b"\xff" * 2000), _file("S", "nul.abc", b"\x00\x01" * 2000)]
    got = {r.name: r.should_process for r in FO.classify_files(spark.createDataFrame(rows, FILES)).collect()}
    assert got == {"notes.abc": True, "cut.abc": True, "bad.abc": False, "nul.abc": False}


def test_grading_reads_the_stored_parse(spark):
    plan = spark.createDataFrame([("new", True, True, None), ("stored", False, True, "STORED"), ("failed", True, True, "OLD"),
                                  ("none", False, True, None), ("done", False, False, "STORED")],
                                 "submission string, do_parse boolean, do_grade boolean, stored_text string")
    parsed = spark.createDataFrame([("new", True, "FRESH"), ("failed", False, "x")], "submission string, parse_ok boolean, parsed_text string")
    got = {r.submission: r.parsed_text for r in GR.grade_inputs(plan, parsed).collect()}
    assert got == {"new": "FRESH", "stored": "STORED"}


def test_call_concurrency_is_a_partition_count(spark):
    df = spark.range(100).selectExpr("id AS submission")
    assert E.limit_concurrency(df, 3).select(F.spark_partition_id().alias("p")).distinct().count() == 3


def test_large_keys_pass_model_calls_unchanged(spark):
    big = (1 << 53) + 1
    req = spark.createDataFrame([(big, "parsing", "t"), (None, "parsing", "u")], "id bigint, stage string, request string")
    out = E.invoke_model(req, lambda: E.OfflineClient("offline-pro"))
    assert {r.id for r in out.collect()} == {big, None}
