import math
import random

import pytest

from scorewright.operators import quantiles, sizes
from scorewright.operators.quantiles import exact_quantiles
from scorewright.operators.usage import stage_timing

WANTED = {"least": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99, "most": 1.0}


def plain(values, p):
    v = sorted(x for x in values if x is not None and not math.isnan(x))
    return v[max(math.ceil(p * len(v)), 1) - 1] if v else None


def groups():
    rng = random.Random(8)
    return {"wide": [rng.random() * 1000 for _ in range(6000)], "ties": [float(rng.choice([1, 1, 1, 2, 9])) for _ in range(3000)],
            "heavy": [5.0] * 2800 + [rng.random() * 10 for _ in range(200)], "one": [3.5], "same": [7.0] * 900,
            "none": [None, float("nan")], None: [1.0, 2.0, None], "sorted": [float(k) for k in range(5000)]}


@pytest.mark.parametrize("few,most", [(20_000, 20_000), (40, 20_000), (0, 2)])
def test_equals_sorted_values(spark, monkeypatch, few, most):
    monkeypatch.setattr(sizes, "MOST_ROWS", most)
    rows = [(k, v) for k, vs in groups().items() for v in vs]
    got = exact_quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", WANTED, few)
    want = {k: tuple(plain(vs, p) for p in WANTED.values()) for k, vs in groups().items()}
    assert {r.g: tuple(r)[1:] for r in got.collect()} == want


def test_a_wrong_sketch_is_noticed(spark, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(quantiles, "_pair", lambda sketch, share, pair=quantiles._pair: pair(sketch, F.greatest(share - 0.2, F.lit(0.0))))
    rows = [(float(k * 37 % 1000),) for k in range(1000)]
    got = exact_quantiles(spark.createDataFrame(rows, "v double"), [], "v", {"p50": 0.5, "p95": 0.95}, 5)
    assert [tuple(r) for r in got.collect()] == [(499.0, 949.0)]


def test_empty_and_plan(spark):
    usage = spark.createDataFrame([("grading", "pro", 1.5), ("grading", "pro", 2.5), (None, "pro", 4.0)],
                                  "stage string, model_type string, elapsed_s double")
    out = stage_timing(usage)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan.lower()
    assert {(r.stage, r.p50_s, r.p99_s, r.requests) for r in out.collect()} == {("grading", 1.5, 2.5, 2), (None, 4.0, 4.0, 1)}
    assert stage_timing(usage.limit(0)).collect() == []
