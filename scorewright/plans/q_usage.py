"""Queries over model usage rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import rules
from ..functions import money as M
from ..operators import usage as U
from . import sqlgen as G
from .registry import fx, query, with_sql


def _cost_sql(p: str, c: str, model: str, thinking: str) -> str:
    pin = " ".join(f"WHEN {model} = '{m}' AND coalesce({thinking}, false) = {str(t).lower()} THEN CAST({a!r} AS DOUBLE)"
                   for m, t, a, _b in rules.PRICES)
    pout = " ".join(f"WHEN {model} = '{m}' AND coalesce({thinking}, false) = {str(t).lower()} THEN CAST({b!r} AS DOUBLE)"
                    for m, t, _a, b in rules.PRICES)
    return (f"(CAST({p} AS DOUBLE) / CAST(1000000 AS DOUBLE)) * (CASE {pin} END) + "
            f"(CAST({c} AS DOUBLE) / CAST(1000000 AS DOUBLE)) * (CASE {pout} END)")


def _priced_sql() -> tuple[str, str]:
    """(aggregate list, cost expression over the aggregates) in DuckDB."""
    aggs, cost = [], []
    for cls, model, think, pin, pout in U._price_classes():
        cond = f"model_type = '{model}' AND coalesce(thinking, false) = {str(think).lower()}"
        aggs.append(f"CAST(sum(CASE WHEN {cond} THEN prompt_tokens ELSE 0 END) AS BIGINT) AS p_{cls}")
        aggs.append(f"CAST(sum(CASE WHEN {cond} THEN completion_tokens ELSE 0 END) AS BIGINT) AS c_{cls}")
        cost.append(f"(CAST(p_{cls} AS DOUBLE) / CAST(1000000 AS DOUBLE)) * CAST({pin!r} AS DOUBLE) + "
                    f"(CAST(c_{cls} AS DOUBLE) / CAST(1000000 AS DOUBLE)) * CAST({pout!r} AS DOUBLE)")
    measures = ("CAST(count(*) AS BIGINT) AS requests, CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens, "
                "CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens, "
                "CAST(sum(prompt_tokens + completion_tokens) AS BIGINT) AS total_tokens, "
                "CAST(count_if(coalesce(model_type, '') NOT IN ('flash', 'pro')) AS BIGINT) AS unpriced_requests, " + ", ".join(aggs))
    return measures, "CASE WHEN unpriced_requests = 0 THEN (" + ") + (".join(cost) + ") END"


_MEASURES, _COST = _priced_sql()
_OUT = "requests, prompt_tokens, completion_tokens, total_tokens, unpriced_requests"


@query("request_cost", with_sql(("fx_usage",), [], "SELECT submission, req, stage, model_type, thinking, "
                                f"{_cost_sql('prompt_tokens', 'completion_tokens', 'model_type', 'thinking')} AS cost_usd FROM fx_usage"))
def q_request_cost(spark, sf_dir):
    u = fx(spark, sf_dir, "fx_usage")
    return u.select("submission", "req", "stage", "model_type", "thinking",
                    M.request_cost(F.col("model_type"), F.col("prompt_tokens"), F.col("completion_tokens"),
                                   F.col("thinking")).alias("cost_usd"))


@query("usage_rows", with_sql(("fx_usage",), [], "SELECT *, prompt_tokens + completion_tokens AS total_tokens, "
                              f"{_cost_sql('prompt_tokens', 'completion_tokens', 'model_type', 'thinking')} AS cost_usd, "
                              "CASE WHEN model_type IN ('flash', 'pro') THEN NULL ELSE "
                              f"{G.q(rules.INVALID_MODEL_ERROR)} END AS cost_error FROM fx_usage"))
def q_usage_rows(spark, sf_dir):
    return U.usage_rows(fx(spark, sf_dir, "fx_usage"))


@query("cost_cube", with_sql(("fx_usage",), [("g", f"SELECT model_type, stage, {_MEASURES}, "
                                                   "CAST(GROUPING(model_type, stage) AS BIGINT) AS level "
                                                   "FROM fx_usage GROUP BY CUBE (model_type, stage)")],
                             f"SELECT model_type, stage, {_OUT}, level, {_COST} AS cost_usd FROM g"))
def q_cost_cube(spark, sf_dir):
    return U.cost_cube(fx(spark, sf_dir, "fx_usage"))


@query("cost_by_submission", with_sql(("fx_usage",), [("g", f"SELECT submission, {_MEASURES} FROM fx_usage GROUP BY submission")],
                                      f"SELECT submission, {_OUT}, {_COST} AS cost_usd FROM g"))
def q_cost_by_submission(spark, sf_dir):
    return U.cost_by_submission(fx(spark, sf_dir, "fx_usage"))


# Every seventh order's requests went to a model without a price.
_ODD = [("u", "SELECT * EXCLUDE (model_type), CASE WHEN submission % 7 = 3 THEN 'nano' WHEN submission % 7 = 5 THEN NULL "
              "ELSE model_type END AS model_type FROM fx_usage")]


def _odd_models(spark, sf_dir):
    u, s = fx(spark, sf_dir, "fx_usage"), F.col("submission") % 7
    return u.withColumn("model_type", F.when(s == 3, "nano").when(s == 5, F.lit(None)).otherwise(F.col("model_type")))


@query("cost_unknown_models", with_sql(("fx_usage",), _ODD + [("g", f"SELECT submission, {_MEASURES} FROM u GROUP BY submission")],
                                       f"SELECT submission, {_OUT}, {_COST} AS cost_usd FROM g"))
def q_cost_unknown_models(spark, sf_dir):
    return U.cost_by_submission(_odd_models(spark, sf_dir))


@query("stage_timing", with_sql(("fx_usage",), [], "SELECT stage, model_type, CAST(count(*) AS BIGINT) AS requests, "
                                "max(elapsed_s) AS max_s, min(elapsed_s) AS min_s, quantile_disc(elapsed_s, 0.5) AS p50_s, quantile_disc(elapsed_s, 0.95) AS p95_s, quantile_disc(elapsed_s, 0.99) AS p99_s, "
                                "CAST(sum(CAST(round(elapsed_s * 1000000) AS BIGINT)) AS BIGINT) / CAST(1000000 AS DOUBLE) AS total_s, "
                                "CAST(sum(CAST(round(elapsed_s * 1000000) AS BIGINT)) AS BIGINT) / CAST(1000000 AS DOUBLE) / count(*) AS avg_s "
                                "FROM fx_usage GROUP BY stage, model_type"))
def q_stage_timing(spark, sf_dir):
    return U.stage_timing(fx(spark, sf_dir, "fx_usage"))


def _split_usage(u):
    """Existing ledger = requests 1-4 of each submission and stage, summed;
    the new run = the later requests."""
    agg = [F.sum("prompt_tokens").alias("prompt_tokens"), F.sum("completion_tokens").alias("completion_tokens")]
    old = u.filter(F.col("req") <= 4).groupBy("submission", "stage").agg(*agg)
    new = u.filter(F.col("req") > 4).groupBy("submission", "stage").agg(*agg)
    return old, new


_SPLIT = [("old", "SELECT submission, stage, CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens, "
                  "CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens FROM fx_usage WHERE req <= 4 GROUP BY ALL"),
          ("new", "SELECT submission, stage, CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens, "
                  "CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens FROM fx_usage WHERE req > 4 GROUP BY ALL")]


@query("merge_usage_keep", with_sql(("fx_usage",), _SPLIT,
                                    "SELECT o.*, 'existing' AS source FROM old o WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.submission = o.submission AND n.stage = o.stage) "
                                    "UNION ALL SELECT n.*, 'new' AS source FROM new n"))
def q_merge_usage_keep(spark, sf_dir):
    old, new = _split_usage(fx(spark, sf_dir, "fx_usage"))
    return U.merge_usage(old, new)


@query("merge_usage", with_sql(("fx_usage",), _SPLIT,
                               "SELECT o.*, 'existing' AS source FROM old o WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.submission = o.submission AND n.stage = o.stage) "
                               "AND o.submission NOT IN (SELECT submission FROM new WHERE stage = 'parsing') "
                               "UNION ALL SELECT n.*, 'new' AS source FROM new n"))
def q_merge_usage(spark, sf_dir):
    old, new = _split_usage(fx(spark, sf_dir, "fx_usage"))
    return U.merge_usage(old, new, mode="rewrite")


@query("model_type", with_sql(("fx_usage",), [], "SELECT submission, req, model_type || '-2.5-' || stage AS model_name, "
                              "CASE WHEN contains(model_type || '-2.5-' || stage, 'pro') THEN 'pro' ELSE 'flash' END AS derived_type FROM fx_usage"))
def q_model_type(spark, sf_dir):
    u = fx(spark, sf_dir, "fx_usage").withColumn("model_name", F.concat("model_type", F.lit("-2.5-"), "stage"))
    return u.select("submission", "req", "model_name", M.model_type_of(F.col("model_name")).alias("derived_type"))


@query("retry_schedule", with_sql(("fx_usage",), [], "SELECT submission, req, least(req - 1, 3) AS retries, "
                                  "CAST(least(req, 4) AS INTEGER) AS attempts, req - 1 > 3 AS exhausted, "
                                  "array_to_string(list_transform(range(0, least(req - 1, 3)), lambda k: CAST(5 * (1 << k) AS BIGINT)), ',') AS waits, "
                                  "CAST(5 * ((1 << least(req - 1, 3)) - 1) AS BIGINT) AS total_wait_s FROM fx_usage"))
def q_retry_schedule(spark, sf_dir):
    u = fx(spark, sf_dir, "fx_usage")
    retries = F.least(F.col("req") - 1, F.lit(rules.MAX_RETRIES))
    waits = M.retry_waits(retries, rules.RETRY_DELAY_S)
    return u.select("submission", "req", retries.alias("retries"),
                    F.least(F.col("req"), F.lit(rules.MAX_RETRIES + 1)).cast("int").alias("attempts"),
                    ((F.col("req") - 1) > rules.MAX_RETRIES).alias("exhausted"),
                    F.array_join(waits.cast("array<string>"), ",").alias("waits"),
                    F.aggregate(waits, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total_wait_s"))
