"""Usage and cost roll-ups.

Money is summed in a fixed, order-independent way: token counts are summed
as BIGINT per price class, then priced once.  Summing per-request doubles
would make the last bits depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import rules
from ..functions import money as M
from .quantiles import exact_quantiles


def usage_rows(usage: DataFrame) -> DataFrame:
    """N1 + N2 per request: total_tokens, cost_usd, cost_error."""
    return (usage.withColumn("total_tokens", M.total_tokens(F.col("prompt_tokens"), F.col("completion_tokens")))
            .withColumn("cost_usd", M.request_cost(F.col("model_type"), F.col("prompt_tokens"),
                                                   F.col("completion_tokens"), F.col("thinking")))
            .withColumn("cost_error", M.cost_error(F.col("model_type"))))


def _price_classes():
    """(name, model_type, thinking or None, input price, output price)."""
    out = []
    for model, think, pin, pout in rules.PRICES:
        out.append((f"{model}_{'t' if think else 'n'}", model, think, pin, pout))
    return out


def token_sums() -> list:
    """BIGINT sums of prompt and completion tokens per price class."""
    aggs = []
    for cls, model, think, _pin, _pout in _price_classes():
        cond = (F.col("model_type") == model) & (F.coalesce(F.col("thinking"), F.lit(False)) == think)
        aggs.append(F.sum(F.when(cond, F.col("prompt_tokens")).otherwise(F.lit(0))).alias(f"__p_{cls}"))
        aggs.append(F.sum(F.when(cond, F.col("completion_tokens")).otherwise(F.lit(0))).alias(f"__c_{cls}"))
    return aggs


def priced(df: DataFrame) -> DataFrame:
    """cost_usd from the per-class token sums, classes added in a fixed order; null where a model has no price."""
    cost = None
    for cls, _model, _think, pin, pout in _price_classes():
        term = (F.col(f"__p_{cls}").cast("double") / F.lit(1000000.0)) * F.lit(pin) \
            + (F.col(f"__c_{cls}").cast("double") / F.lit(1000000.0)) * F.lit(pout)
        cost = term if cost is None else cost + term
    drop = [c for c in df.columns if c.startswith("__p_") or c.startswith("__c_")]
    return df.withColumn("cost_usd", F.when(F.col("unpriced_requests") == 0, cost)).drop(*drop)


def _measures() -> list:
    return [F.count(F.lit(1)).alias("requests"),
            F.sum("prompt_tokens").alias("prompt_tokens"),
            F.sum("completion_tokens").alias("completion_tokens"),
            F.sum(F.col("prompt_tokens") + F.col("completion_tokens")).alias("total_tokens"),
            F.count_if(M.cost_error(F.col("model_type")).isNotNull()).alias("unpriced_requests"),
            *token_sums()]


def cost_cube(usage: DataFrame) -> DataFrame:
    """Spend by model and stage, every subtotal and the grand total."""
    return priced(usage.cube("model_type", "stage").agg(*_measures(), F.grouping_id().cast("bigint").alias("level")))


def cost_by_submission(usage: DataFrame, key: str = "submission") -> DataFrame:
    """Spend per submission (partial aggregation: a hot submission is
    pre-reduced per task before the shuffle)."""
    return priced(usage.groupBy(key).agg(*_measures()))


def stage_timing(usage: DataFrame) -> DataFrame:
    """Request time per stage and model.  Sums are taken in whole microseconds, so that they do not depend on the
    order of the rows; ``p50_s``, ``p95_s`` and ``p99_s`` are the least times that at least that share of the requests do
    not exceed, exact, found by sketches and counts (``exact_quantiles``)."""
    keys = ["stage", "model_type"]
    sums = usage.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("requests"),
        (F.sum(F.round(F.col("elapsed_s") * 1_000_000).cast("bigint")) / F.lit(1_000_000.0)).alias("total_s"),
        F.max("elapsed_s").alias("max_s"), F.min("elapsed_s").alias("min_s")).withColumn("avg_s", F.col("total_s") / F.col("requests"))
    shares = exact_quantiles(usage, keys, "elapsed_s", {"p50_s": 0.5, "p95_s": 0.95, "p99_s": 0.99})
    other = shares.select(*[F.col(k).alias(f"__{k}") for k in keys], "p50_s", "p95_s", "p99_s")
    same = F.col("stage").eqNullSafe(F.col("__stage")) & F.col("model_type").eqNullSafe(F.col("__model_type"))
    return sums.join(other, same).drop("__stage", "__model_type")


MERGE_MODES = ("keep", "rewrite")


def merge_usage(existing: DataFrame, new: DataFrame, key: str = "submission", mode: str = "keep") -> DataFrame:
    """A new row replaces the old row of its submission and stage.  ``keep`` (the default, D18) leaves the other
    stages' rows; with ``rewrite`` a new 'parsing' row drops the old grading row too, as a rewritten file would."""
    if mode not in MERGE_MODES:
        raise ValueError(f"mode must be one of {MERGE_MODES}")
    kept = existing.join(new.select(key, "stage").distinct(), [key, "stage"], "left_anti")
    if mode == "rewrite":
        kept = kept.join(new.filter(F.col("stage") == "parsing").select(key).distinct(), key, "left_anti")
    kept = kept.withColumn("source", F.lit("existing"))
    return kept.unionByName(new.withColumn("source", F.lit("new")))
