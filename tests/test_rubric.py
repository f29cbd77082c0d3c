"""W1 goldens from the documented hint examples, T9/T10 round trip."""

from pyspark.sql import functions as F

from scorewright.operators import enrich as E
from scorewright.operators import rubric as RB
from scorewright.plans.fixtures import FX_HINTS_FIXED


def test_fixed_hint_totals(spark):
    hints = spark.sql(FX_HINTS_FIXED)
    totals = {(r.assignment_id, r.exercise): r.total_points
              for r in RB.rubric_totals(RB.parse_structure_hint(hints)).collect()}
    assert totals == {("0", "Exercise 0.1"): 8.0, ("0", "Exercise 0.2"): 8.0,
                      ("1", "Exercise 1.1"): 8.0, ("1", "Exercise 1.2"): 10.0, ("1", "Exercise 1.3"): 0.0,
                      ("2", "Exercise 2.1"): 7.0, ("2", "Exercise 2.2"): 5.0}


def test_letters_after_h_are_subparts(spark):
    lines = ["Exercise 3.1:", "i)"] + [f"{c}) 1 point" for c in "abcdefghij"] + ["ii) 2 points"]
    hints = spark.createDataFrame([("3", "\n".join(lines))], "assignment_id string, hint string")
    units = [(r.part, r.sub, r.points) for r in RB.parse_structure_hint(hints).orderBy("ord").collect()]
    assert units == [("i", c, 1.0) for c in "abcdefghij"] + [("ii", None, 2.0)]


def test_solution_markdown_round_trip(spark):
    hints = spark.sql(FX_HINTS_FIXED)
    md = hints.select("assignment_id", "hint").collect()
    rows = [(r.assignment_id, E.render_solution_markdown(r.hint)) for r in md]
    mdf = spark.createDataFrame(rows, "assignment_id string, markdown string")
    units = RB.parse_solution_units(mdf)
    checks = RB.validate_solution(units, RB.parse_structure_hint(hints)).collect()
    assert checks and all(c.total_ok and c.points_mismatch == 0 and c.units_not_in_rubric == 0 for c in checks)
    sols = units.filter(F.col("solution_text").isNull()).count()
    assert sols == 0


def test_solutions_are_parsed_in_their_row(spark):
    text = "\n".join([
        "(a) Before any heading [1 point]", "kept", "## Exercise 1.1 (One). (Total: 3 points)", "(i) Sole [3 points]\r", "**Solution.**\r", "a\r", "", "b",
        "## Exercise 1.2 (Two). (Total: 4 points)", "(i) Container", "not a unit's", "(h) Eight [1 point]", "(i) Letter [1 point]", "**Solution.**",
        "(ii) Part [1.5 points]", "x (not a mark", "(b) Own [0.5 points]", ""])
    md = spark.createDataFrame([("A", text), ("B", None), ("C", "no units"), (None, text)], "assignment_id string, markdown string")
    units = RB.parse_solution_units(md)
    plan = units._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "Sort" not in plan
    want = [(None, None, None, 1, "a", None, "Before any heading", 1.0, "kept"),
            ("Exercise 1.1", "One", 3.0, 4, None, None, "Sole", 3.0, "a\n\nb"),
            ("Exercise 1.2", "Two", 4.0, 12, "i", "h", "Eight", 1.0, None),
            ("Exercise 1.2", "Two", 4.0, 13, "i", "i", "Letter", 1.0, None),
            ("Exercise 1.2", "Two", 4.0, 15, "ii", None, "Part", 1.5, "x (not a mark"),
            ("Exercise 1.2", "Two", 4.0, 17, "b", None, "Own", 0.5, "")]
    got = [tuple(r) for r in units.orderBy("assignment_id", "ord").collect()]
    assert units.columns == ["assignment_id", "exercise", "title", "header_total", "ord", "part", "sub", "prompt", "points", "solution_text"]
    assert [r[1:] for r in got if r[0] == "A"] == want
    assert [r[1:] for r in got if r[0] is None] == [w[:-1] + (None,) for w in want] and len(got) == 12


def test_hints_are_parsed_in_one_pass(spark):
    text = "\n".join([
        "2 points", "a) [1 point] \r", "Exercise 1.1: [3 points]", "(h) 1 point", "i) 0.5 points", "v) 7 points", "b) none", "4 points",
        "Exercise 1.2", "II) 6 points", "x) 2 points\u00e9", "a) 3 points\u00b2", "c) 1 point", "xi) 9 points, 1 point", "b) nothing", "Exercise: 5 points"])
    hints = spark.createDataFrame([("A", text), ("B", None), ("C", "no units"), ("A", "1 point"), (None, text)], "assignment_id string, hint string")
    units = RB.parse_structure_hint(hints)
    plan = units._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "Sort" not in plan
    assert "lambda" not in plan  # no fold that copies what it has at each line
    want = [(1, None, None, None, 2.0), (2, None, "a", None, 1.0), (3, "Exercise 1.1", None, None, 3.0),
            (4, "Exercise 1.1", "h", None, 1.0), (5, "Exercise 1.1", "i", None, 0.5), (6, "Exercise 1.1", "v", None, 7.0),
            (8, "Exercise 1.1", None, None, 4.0), (10, "Exercise 1.2", "ii", None, 6.0), (12, "Exercise 1.2", "x", "a", 3.0),
            (13, "Exercise 1.2", "x", "c", 1.0), (14, "Exercise 1.2", "xi", None, 9.0)]
    got = [tuple(r) for r in units.collect()]
    assert units.columns == ["assignment_id", "ord", "exercise", "part", "sub", "points"]
    assert sorted((r[1:] for r in got if r[0] is None), key=lambda r: r[0]) == want
    assert sorted((r[1:] for r in got if r[0] == "A"), key=lambda r: (r[0], r[1] or "", r[4])) == \
        sorted([*want, (1, None, None, None, 1.0)], key=lambda r: (r[0], r[1] or "", r[4])) and len(got) == 23


def test_checks_are_counted_as_a_join_gives_them(spark):
    import itertools
    import math
    import random

    pick = random.Random(4).choice
    keys, exercises, parts, subs = ("A", "B", "L9", None), ("Exercise 1.1", "Exercise 1.2", None), ("i", "", None), ("a", None)
    points, totals = (0.0, -0.0, 0.5, 1.0, 2.0, None, math.nan), (None, 2.0, 3.5)
    units = [(pick(keys), pick(exercises), pick(parts), pick(subs), pick(points), pick(totals)) for _ in range(150)] + \
        [("T", "Exercise 2", "i", None, 1.5, 2.5), ("T", "Exercise 2", "ii", None, 1.0, 2.5), ("U", "Exercise 3", "i", None, 1.0, 1.0)]
    rubric = [(pick(keys), pick(exercises), pick(parts), pick(subs), pick(points)) for _ in range(150)] + \
        [("T", "Exercise 2", "i", None, 1.5), ("T", "Exercise 2", "ii", None, 3.0), ("R", "Exercise 4", "i", "a", 1.0)]
    place = "assignment_id string, exercise string, part string, sub string, points double"
    got = RB.validate_solution(spark.createDataFrame(units, place + ", header_total double"), spark.createDataFrame(rubric, place))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan  # both sides are dealt once and nothing after them

    def joins(u, r):
        return u[0] is not None and u[1] is not None and u[:4] == r[:4]

    pairs = [(u, r) for u, r in itertools.product(units, rubric) if joins(u, r)]
    pairs += [(u, None) for u in units if not any(joins(u, r) for r in rubric)] + [(None, r) for r in rubric if not any(joins(u, r) for u in units)]
    want = {}
    for u, r in pairs:
        of = want.setdefault((u or r)[:2], [None, 0.0, 0, 0, 0])
        if u and u[5] is not None:
            of[0] = max(u[5], of[0] or u[5])
        of[1] += u[4] if u and u[4] is not None else 0.0
        here, there = bool(u) and u[0] is not None, bool(r) and r[0] is not None
        of[2] += here and not there
        of[3] += not here
        if here and there and u[4] is not None and r[4] is not None:  # to Spark NaN equals itself
            of[4] += u[4] != r[4] and not (math.isnan(u[4]) and math.isnan(r[4]))
    rows = {tuple(r[:2]): r for r in got.collect()}
    assert set(rows) == set(want) and got.columns == [
        "assignment_id", "exercise", "header_total", "unit_points", "units_not_in_rubric", "units_omitted", "points_mismatch", "total_ok"]
    for k, (total, n, *counts) in want.items():
        r = rows[k]
        assert r[2] == total and [*r[4:7]] == counts, k
        assert r[3] == n or math.isnan(r[3]) and math.isnan(n), k
        assert r[7] is (total is not None and abs(total - n) < 1e-9 and counts[1] == 0), k
    assert rows["T", "Exercise 2"][2:] == (2.5, 2.5, 0, 0, 1, True) and rows["R", "Exercise 4"][2:] == (None, 0.0, 0, 1, 0, False)


def test_line_items_are_dealt_before_they_are_text(spark, tmp_path):
    from scorewright.plans import q_solutions

    items = [(7, 2, 20, 5, 3.0, 99.9), (7, 1, 14, 6, 4.0, 10.0), (8, 1, 15, 7, 5.0, 11.5), (8, 1, 15, 7, 5.0, 11.5), (None, 1, 14, 6, 4.0, 10.0), (9, 1, None, 1, 1.0, 1.0)]
    spark.createDataFrame(items, "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double") \
        .write.parquet(f"{tmp_path}/lineitem.parquet")
    md = q_solutions._solutions(spark, str(tmp_path))
    plan = md._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    dealt = plan[plan.index("Exchange"):]
    assert "l_orderkey" in dealt and "collect_list" not in dealt and "Exercise" not in dealt
    assert "Exchange" not in spark.table("lineitem")._jdf.queryExecution().executedPlan().toString()
    one = "(i) Question one [4 points]\n**Solution.**\nOne of 1.14.6.10\n(ii) Question two [6.0 points]\n**Solution.**\nTwo"
    one = f"## Exercise 1.14.6.10 (Title of 1.14.6.10). (Total: 11 points)\n{one}"
    two = ("## Exercise 2.20.5.99 (Title of 2.20.5.99). (Total: 2 points)\n(i) The question. [2 points]\n**Solution.**\n"
           "First line\n\nlast line of 2.20.5.99")
    got = {r.assignment_id: r.markdown for r in md.collect()}
    assert got["L7"] == f"{one}\n{two}" and got[None] == one and got["L8"].count("## Exercise 1.15.7.11 ") == 2 and set(got) == {"L7", "L8", "L9", None}
