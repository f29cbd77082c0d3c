"""T8(T7(x)) = x on the fixture replies."""

from pyspark.sql import functions as F

from scorewright.operators import scores as SC
from scorewright.plans.registry import fx

from sw_paths import SF_SMALL


def test_nest_then_flatten_round_trip(spark):
    parsed = SC.parse_replies(fx(spark, SF_SMALL, "fx_responses"))
    scores = SC.flatten_scores(parsed)
    nested = SC.nest_scores(scores)
    again = SC.flatten_scores(nested.select("submission", F.try_parse_json("scores_json").alias("v")))
    cols = ["submission", "exercise", "part", "sub", "points"]
    assert scores.select(*cols).exceptAll(again.select(*cols)).count() == 0
    assert again.select(*cols).exceptAll(scores.select(*cols)).count() == 0
