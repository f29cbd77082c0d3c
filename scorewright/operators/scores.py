"""Score trees from model replies."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import rules
from ..functions import scores as S
from .sizes import small_side

NUMERIC_VARIANT = r"^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL.*)$"


def parse_replies(replies: DataFrame, report_col: str = "report") -> DataFrame:
    """T5 + T6: add json_str (last fenced block), json_status, v (VARIANT)."""
    out = replies.withColumn("json_str", S.extract_last_json(F.col(report_col))) \
        .withColumn("v", F.try_parse_json(F.col("json_str")))
    return out.withColumn("json_status", F.when(F.col("json_str").isNull(), "no_json")
                          .when(F.col("v").isNull(), "parse_error").otherwise("ok"))


def combine_results(parsed: DataFrame, students: DataFrame, key: str = "submission") -> DataFrame:
    """Parsed replies with their submission's student details; ``grading_results`` holds the reply's object where it
    parses, ``error`` says that it does not.  ``stored`` is the object as kept (T6), the fallback included."""
    ok, bad = F.col("json_status") == "ok", F.col("json_status") == "parse_error"
    details = [c for c in students.columns if c != key]
    return parsed.join(students, key).select(
        key, *details, "json_status", F.when(ok, F.col("json_str")).alias("grading_results"),
        F.when(bad, F.lit(rules.JSON_PARSE_ERROR)).alias("error"), S.grading_results_json(F.col("json_str")).alias("stored"))


def flatten_scores(parsed: DataFrame, key: str = "submission", variant_col: str = "v") -> DataFrame:
    """(key, exercise, part, sub, points) for every numeric leaf at depth
    1-3 of an object tree; top-level 'total' and non-numeric leaves dropped.

    Lateral VARIANT explodes: one pass, no shuffle, no fixed schema.  Only
    objects have keys (an array explodes with null keys, a scalar into
    nothing), so the object test is a filter on the generator output, which
    Catalyst cannot push below the parse and evaluate twice."""
    spark = parsed.sparkSession
    src = parsed.select(F.col(key).alias("k"), F.col(variant_col).alias("v"))
    sql = (
        "SELECT r.k, e.key AS exercise, p.key AS part, s.key AS sub, "
        "try_variant_get(coalesce(s.value, p.value, e.value), '$', 'double') AS points "
        "FROM {src} r, LATERAL variant_explode(r.v) e "
        "LEFT JOIN LATERAL variant_explode_outer(e.value) p "
        "LEFT JOIN LATERAL variant_explode_outer(p.value) s "
        "WHERE e.key IS NOT NULL AND e.key <> 'total' AND schema_of_variant(coalesce(s.value, p.value, e.value)) RLIKE '"
        + NUMERIC_VARIANT + "'")
    return spark.sql(sql, src=src).withColumnRenamed("k", key)


def reported_total(parsed: DataFrame, key: str = "submission", variant_col: str = "v") -> DataFrame:
    """The reply's own 'total' (null when absent or not a number)."""
    return parsed.filter(F.col("json_status") == "ok").select(
        key, F.try_variant_get(F.col(variant_col), "$.total", "double").alias("reported_total"))


def score_rollup(scores: DataFrame, key: str = "submission") -> DataFrame:
    """Points per (submission, exercise, part), per (submission,
    exercise), per submission and overall; ``level`` = grouping id."""
    return (scores.rollup(key, "exercise", "part")
            .agg(F.sum("points").alias("points"), F.count(F.lit(1)).alias("n_units"),
                 F.grouping_id().cast("bigint").alias("level")))


def total_mismatch(parsed: DataFrame, scores: DataFrame, key: str = "submission") -> DataFrame:
    """Summed leaf points vs the reported total, per parsed reply."""
    sums = scores.groupBy(key).agg(F.sum("points").alias("sum_points"))
    tot = reported_total(parsed, key)
    j = tot.join(sums, key, "left").withColumn("sum_points", F.coalesce("sum_points", F.lit(0.0)))
    return j.withColumn("mismatch", F.coalesce(F.abs(F.col("sum_points") - F.col("reported_total")) > 1e-9,
                                               F.lit(True)))


UNIT = "struct<exercise:string,part:string,sub:string>"


def _members(v) -> F.Column:
    """The members of an object as (key, VARIANT); null for anything else."""
    return F.map_entries(F.try_variant_get(v, "$", "map<string,variant>"))


def score_map(v) -> F.Column:
    """T7 in the row: (exercise, part, sub) -> points of the numeric leaves at depth 1-3 of an object tree; empty for
    anything else.  No row is exploded, so a reply stays one row."""
    def unit(exercise, part, sub, value):
        return F.struct(exercise.alias("exercise"), part.alias("part"), sub.alias("sub"), value.alias("v"))

    none = F.lit(None).cast("string")

    def parts(e):
        def subs(p):
            inner = _members(p["value"])
            return F.when(inner.isNull(), F.array(unit(e["key"], p["key"], none, p["value"]))).otherwise(
                F.transform(inner, lambda s: unit(e["key"], p["key"], s["key"], s["value"])))
        inner = _members(e["value"])
        return F.when(inner.isNull(), F.array(unit(e["key"], none, none, e["value"]))).otherwise(F.flatten(F.transform(inner, subs)))

    leaves = F.flatten(F.transform(_members(v), parts))
    scored = F.filter(leaves, lambda u: (u["exercise"] != "total") & F.schema_of_variant(u["v"]).rlike(NUMERIC_VARIANT))
    entries = F.transform(scored, lambda u: F.struct(F.struct(u["exercise"], u["part"], u["sub"]).cast(UNIT).alias("key"),
                                                     F.try_variant_get(u["v"], "$", "double").alias("value")))
    return F.coalesce(F.map_from_entries(entries), F.create_map().cast(f"map<{UNIT},double>"))


def rubric_maps(rubric: DataFrame, assignment: str = "assignment_id") -> DataFrame:
    """(assignment, rubric): one map (exercise, part, sub) -> max_points per assignment, as large as that rubric."""
    unit = F.struct("exercise", "part", "sub").cast(UNIT)
    return rubric.groupBy(assignment).agg(F.map_from_entries(F.collect_list(F.struct(
        unit.alias("key"), F.col("max_points").cast("double").alias("value")))).alias("rubric"))


def rubric_check(parsed: DataFrame, rubric: DataFrame, key: str = "submission", assignment: str = "assignment_id") -> DataFrame:
    """Per submission, rubric units matched / missing / unexpected, and whether awarded points exceed the unit's maximum.

    ``parsed``: replies with ``json_status``, ``v`` and the assignment they answer; ``rubric``: (assignment, exercise, part,
    sub, max_points).  Reply and rubric meet as two maps in one row, by ``map_zip_with``: replies are not multiplied by
    rubric rows and not shuffled while the rubrics are few (their number is looked at; beyond it the join is by shuffle).
    Only replies that parse are checked; of an assignment without rubric every unit is unexpected."""
    maps = small_side(rubric_maps(rubric, assignment))
    ok = parsed.filter(F.col("json_status") == "ok").select(key, assignment, score_map(F.col("v")).alias("given"))
    both = ok.join(maps, assignment, "left").withColumn(
        "rubric", F.coalesce("rubric", F.create_map().cast(f"map<{UNIT},double>")))
    units = F.map_zip_with("given", "rubric", lambda k, points, most: F.struct(
        F.when(points.isNull(), "missing").when(most.isNull(), "unexpected").otherwise("matched").alias("status"),
        points.alias("points"), most.alias("max_points"), F.coalesce(points > most, F.lit(False)).alias("over_max")))
    return both.select(key, F.explode(units).alias("unit", "found")).select(key, "unit.*", "found.*")


def nest_scores(scores: DataFrame, key: str = "submission") -> DataFrame:
    """Scores back into one JSON tree per submission (inverse of T7).

    Built bottom-up; each level collects only its own children, so a group
    is bounded by the rubric size, never by the number of submissions."""
    return _nest_text(scores, key)


def _json_key(c: str):
    # '"key"' with JSON escaping, via to_json of a one-element array: ["key"] -> "key"
    return F.regexp_extract(F.to_json(F.array(F.col(c))), r"^\[(.*)\]$", 1)


def _nest_text(scores: DataFrame, key: str) -> DataFrame:
    num = F.col("points").cast("string")
    lvl3 = (scores.filter(F.col("sub").isNotNull()).groupBy(key, "exercise", "part")
            .agg(F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_list(
                F.concat(_json_key("sub"), F.lit(":"), num))), ","), F.lit("}")).alias("node")))
    lvl2_leaf = scores.filter(F.col("part").isNotNull() & F.col("sub").isNull()) \
        .select(key, "exercise", "part", num.alias("node"))
    lvl2 = (lvl3.unionByName(lvl2_leaf).groupBy(key, "exercise")
            .agg(F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_list(
                F.concat(_json_key("part"), F.lit(":"), F.col("node")))), ","), F.lit("}")).alias("node")))
    lvl1_leaf = scores.filter(F.col("part").isNull()).select(key, "exercise", num.alias("node"))
    return (lvl2.unionByName(lvl1_leaf).groupBy(key)
            .agg(F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_list(
                F.concat(_json_key("exercise"), F.lit(":"), F.col("node")))), ","), F.lit("}")).alias("scores_json")))
