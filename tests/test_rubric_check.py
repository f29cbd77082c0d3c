from pyspark.sql import functions as F

from scorewright.operators import scores as S

REPLIES = [
    (1, "A", '{"E1": {"i": 2, "ii": {"a": 1, "b": 9}}, "E2": 4, "total": 16}'),
    (2, "B", '{"E1": {"i": 2}, "E9": {"x": 1}, "note": "good", "E3": [1, 2]}'),
    (3, "A", "{not json"), (4, "A", "[1]"), (5, "C", '{"E1": 1}'), (6, "A", "{}"), (7, None, '{"E1": 2.5}'), (8, "A", None),
]
RUBRIC = [("A", "E1", "i", None, 2.0), ("A", "E1", "ii", "a", 1.0), ("A", "E1", "ii", "b", 2.0), ("A", "E2", None, None, 5.0),
          ("B", "E1", "i", None, 1.0), ("B", "E3", None, None, 3.0)]


def tables(spark):
    raw = spark.createDataFrame(REPLIES, "submission int, assignment_id string, json_str string")
    parsed = raw.withColumn("v", F.try_parse_json("json_str")).withColumn(
        "json_status", F.when(F.col("json_str").isNull(), "no_json").when(F.col("v").isNull(), "parse_error").otherwise("ok"))
    return parsed, spark.createDataFrame(RUBRIC, "assignment_id string, exercise string, part string, sub string, max_points double")


def test_two_assignments(spark):
    got = {tuple(r) for r in S.rubric_check(*tables(spark)).collect()}
    a = [r[1:] for r in RUBRIC if r[0] == "A"]
    want = {(1, "E1", "i", None, "matched", 2.0, 2.0, False), (1, "E1", "ii", "a", "matched", 1.0, 1.0, False),
            (1, "E1", "ii", "b", "matched", 9.0, 2.0, True), (1, "E2", None, None, "matched", 4.0, 5.0, False),
            (2, "E1", "i", None, "matched", 2.0, 1.0, True), (2, "E9", "x", None, "unexpected", 1.0, None, False),
            (2, "E3", None, None, "missing", None, 3.0, False), (5, "E1", None, None, "unexpected", 1.0, None, False),
            (7, "E1", None, None, "unexpected", 2.5, None, False)}
    want |= {(k, *u[:3], "missing", None, u[3], False) for k in (4, 6) for u in a}
    assert got == want


def test_replies_are_not_shuffled(spark):
    parsed, rubric = tables(spark)
    plan = S.rubric_check(parsed, rubric)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Python" not in plan
    shuffles = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert len(shuffles) <= 1  # the rubric's own grouping


def test_many_rubrics_join_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(S, "small_side", lambda df: df)
    parsed, rubric = tables(spark)
    assert S.rubric_check(parsed, rubric).count() == 17


def test_map_equals_flat_scores(spark):
    parsed, _ = tables(spark)
    objects = parsed.filter("submission in (1, 5, 6)")
    flat = {(r.submission, r.exercise, r.part, r.sub, r.points) for r in S.flatten_scores(objects).collect()}
    units = objects.select("submission", F.explode(S.score_map(F.col("v"))).alias("u", "p")).collect()
    assert {(r.submission, *r.u, r.p) for r in units} == flat
