"""Plan checks and pipeline invariants."""

from scorewright.plans.registry import QUERIES, load_all

from sw_paths import SF_SMALL

load_all()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pending_is_anti_join_with_pushdown(spark):
    plan = _plan(QUERIES["pending_grading"](spark, SF_SMALL))
    assert "LeftAnti" in plan


def test_native_operators_have_no_python(spark):
    for name in ("classify_files", "cost_cube", "flatten_scores", "parse_rubric", "processing_report", "text_sample"):
        plan = _plan(QUERIES[name](spark, SF_SMALL))
        assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan and "MapInPandas" not in plan, name


def test_cost_cube_grand_total_equals_rows(spark):
    cube = QUERIES["cost_cube"](spark, SF_SMALL)
    total = cube.filter("level = 3").first()
    rows = QUERIES["usage_rows"](spark, SF_SMALL)
    assert total.requests == rows.count()


def test_processing_report_counts_add_up(spark):
    rep = QUERIES["processing_report"](spark, SF_SMALL).collect()
    n = QUERIES["latest_result"](spark, SF_SMALL).count()
    for stage in ("parsing", "grading"):
        assert sum(r.n for r in rep if r.stage == stage) == n


def test_pending_and_done_partition_documents(spark):
    a = QUERIES["pending_grading"](spark, SF_SMALL).count()
    b = QUERIES["already_graded"](spark, SF_SMALL).count()
    assert a + b == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()


def test_stream_equals_batch(spark):
    stream = QUERIES["stream_intake"](spark, SF_SMALL).select("path", "should_process", "category", "skip_reason")
    batch = QUERIES["classify_files"](spark, SF_SMALL).select("path", "should_process", "category", "skip_reason")
    assert stream.exceptAll(batch).count() == 0 and batch.exceptAll(stream).count() == 0
