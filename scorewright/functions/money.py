"""Usage and cost columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import rules


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _price(model_type, thinking, which: int) -> Column:
    m = _c(model_type)
    t = F.coalesce(_c(thinking), F.lit(False))
    out = None
    for model, think, pin, pout in rules.PRICES:
        cond = (m == model) & (t == think)
        val = F.lit(pin if which == 0 else pout)
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out.otherwise(F.lit(None).cast("double"))


def input_price(model_type, thinking=None) -> Column:
    return _price(model_type, thinking if thinking is not None else F.lit(False), 0)


def output_price(model_type, thinking=None) -> Column:
    return _price(model_type, thinking if thinking is not None else F.lit(False), 1)


def request_cost(model_type, prompt_tokens, completion_tokens, thinking=None) -> Column:
    """p/1e6*in + c/1e6*out, same operation order as the reference.

    Null for a model other than flash/pro (see ``cost_error``)."""
    p = _c(prompt_tokens).cast("double") / F.lit(1000000.0)
    c = _c(completion_tokens).cast("double") / F.lit(1000000.0)
    return p * input_price(model_type, thinking) + c * output_price(model_type, thinking)


def cost_error(model_type) -> Column:
    """error text for an unknown model, else null."""
    return F.when(~F.coalesce(_c(model_type).isin("flash", "pro"), F.lit(False)),
                  F.lit(rules.INVALID_MODEL_ERROR))


def total_tokens(prompt_tokens, completion_tokens) -> Column:
    """N2."""
    return _c(prompt_tokens) + _c(completion_tokens)


def model_type_of(model_name) -> Column:
    """F16: 'pro' if the model name contains 'pro', else 'flash'."""
    return F.when(_c(model_name).contains("pro"), F.lit("pro")).otherwise(F.lit("flash"))


def retry_waits(retries, delay=rules.RETRY_DELAY_S) -> Column:
    """Waits before each retry: delay * 2^k for k < retries (empty for 0)."""
    r = _c(retries) if not isinstance(retries, int) else F.lit(retries)
    d = _c(delay) if not isinstance(delay, (int, float)) else F.lit(delay)
    return F.when(r <= 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), r - 1), lambda k: (d * F.pow(F.lit(2), k)).cast("bigint")))
