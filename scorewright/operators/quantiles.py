"""Exact quantiles per group with bounded state.

``percentile_disc`` keeps every distinct value of a group in one task.  Here a KLL sketch of fixed size names two values
that the wanted one should lie between; a pass over the rows then counts what is below, at and between them.  The counts
say where the wanted rank is, for certain: at one of the two values (found), between them (a sketch of the values between
names a narrower pair) or, should the sketch have erred, outside.  What lies between shrinks to a few hundredths each
round; once it is small, its distinct values are counted and the rank is read off."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialize
from .sizes import small_side

#: Size of a sketch, steps of the ranks that are asked of it, steps on each side of the wanted rank, and how many rows
#: between the bounds are counted value by value.
SKETCH_K, STEPS, SIDE, FEW = 1000, 400, 3, 20_000


def _pair(sketch, share):
    """Two values around the ``share`` quantile of a sketch."""
    grid = F.call_function("kll_sketch_get_quantile_double", sketch, F.array(*[F.lit(k / STEPS) for k in range(STEPS + 1)]))
    at = F.floor(share * STEPS)
    return [F.get(grid, F.greatest(at - SIDE, F.lit(0)).cast("int")), F.get(grid, F.least(at + 1 + SIDE, F.lit(STEPS)).cast("int"))]


def exact_quantiles(df: DataFrame, keys: list[str], value: str, wanted: dict[str, float], few: int = FEW) -> DataFrame:
    """One row per group of ``keys`` with a column for each name in ``wanted``: the least value that at least that share of
    the group's values does not exceed (``percentile_disc``).

    Null and NaN values are left out; a group without values has nulls; null keys are a group; an empty table gives an
    empty result.  The number of passes is about log(rows) / log(``STEPS`` / ``SIDE`` / 2); state per group is a few sketches."""
    v = F.col(value).cast("double")
    rows = df.select(*keys, F.when(~F.isnan(v), v).alias("__v"))
    first = rows.groupBy(*keys).agg(F.count("__v").alias("n"), F.min("__v").alias("least"), F.max("__v").alias("most"),
                                    F.call_function("kll_sketch_agg_double", F.col("__v"), F.lit(SKETCH_K)).alias("sketch"))
    probes = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(float(p)).alias("p")) for name, p in wanted.items()])
    state = first.select(*keys, "n", "least", "most", "sketch", F.inline(probes))
    state = state.withColumn("rank", F.greatest(F.ceil(F.col("p") * F.col("n")), F.lit(1)).cast("long"))
    low, high = _pair(F.col("sketch"), F.col("p"))
    seen = F.col("n") > 0
    state = materialize(state.select(*keys, "name", "rank", "least", "most", F.when(seen, low).alias("lo"), F.when(seen, high).alias("hi"),
                                     F.lit(None).cast("double").alias("found"), F.lit(False).alias("narrow"), F.lit(0).cast("long").alias("before")),
                        "quantile-state")
    while not (ahead := state.filter("found IS NULL AND NOT narrow AND lo IS NOT NULL")).isEmpty():
        state = materialize(_round(rows, ahead, keys, few).unionByName(state.filter("found IS NOT NULL OR narrow OR lo IS NULL")),
                            "quantile-state")
    read = _read_off(rows, state.filter("narrow"), keys)
    done = state.filter("NOT narrow").select(*keys, "name", "found").unionByName(read)
    return done.groupBy(*keys).agg(*[F.max(F.when(F.col("name") == name, F.col("found"))).alias(name) for name in wanted])


def _met(rows: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """Every row with the open searches of its group."""
    side = small_side(state.select(*[F.col(k).alias(f"__{k}") for k in keys], "name", "rank", "least", "most", "lo", "hi", "before"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return rows.join(side, same).drop(*[f"__{k}" for k in keys])


def _round(rows: DataFrame, state: DataFrame, keys: list[str], few: int) -> DataFrame:
    v, lo, hi = F.col("__v"), F.col("lo"), F.col("hi")
    inside = (v > lo) & (v < hi)
    got = _met(rows, state, keys).groupBy(*keys, "name", "rank", "least", "most", "lo", "hi").agg(
        F.count_if(v < lo).alias("below"), F.count_if(v == lo).alias("at_lo"), F.count_if(inside).alias("between"),
        F.count_if((v == hi) & (hi > lo)).alias("at_hi"),
        F.call_function("kll_sketch_agg_double", F.when(inside, v), F.lit(SKETCH_K)).alias("sketch"))
    start = F.col("below") + F.col("at_lo")
    end = start + F.col("between")
    rank = F.col("rank")
    too_low, at_lo, between = rank <= F.col("below"), rank <= start, rank <= end
    too_high = rank > end + F.col("at_hi")
    some = F.col("between") > 0
    low, high = (F.when(some, x) for x in _pair(F.col("sketch"), F.try_divide(rank - start, F.col("between"))))
    open_ = between & ~at_lo
    return got.select(
        *keys, "name", "rank", "least", "most",
        F.when(too_low, F.col("least")).when(open_, low).when(too_high, hi).otherwise(lo).alias("lo_"),
        F.when(too_low, lo).when(open_, high).when(too_high, F.col("most")).otherwise(hi).alias("hi_"),
        F.when(too_low | open_ | too_high, F.lit(None)).when(at_lo, lo).otherwise(hi).cast("double").alias("found"),
        (open_ & (F.col("between") <= few)).alias("narrow"), start.alias("before"), "lo", "hi",
    ).select(*keys, "name", "rank", "least", "most",
             # a narrow search keeps its bounds: what lies between them is counted value by value
             F.when(F.col("narrow"), F.col("lo")).otherwise(F.col("lo_")).alias("lo"),
             F.when(F.col("narrow"), F.col("hi")).otherwise(F.col("hi_")).alias("hi"), "found", "narrow", "before")


def _read_off(rows: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """The wanted value among the few between the bounds of each narrow search."""
    inside = _met(rows, state, keys).filter((F.col("__v") > F.col("lo")) & (F.col("__v") < F.col("hi")))
    values = inside.groupBy(*keys, "name", "rank", "before", "__v").agg(F.count(F.lit(1)).alias("times"))
    upto = F.sum("times").over(Window.partitionBy(*keys, "name").orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (values.withColumn("upto", upto + F.col("before")).filter(F.col("upto") >= F.col("rank"))
            .groupBy(*keys, "name").agg(F.min("__v").alias("found")))
