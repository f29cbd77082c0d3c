"""Reply parsing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import rules
from .text import WS_CLASS


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ```json <ws> (body, lazy) <ws> ``` ; dot-all; the last block wins.
FENCE_RE = r"(?s)```json" + WS_CLASS + r"*(.*?)" + WS_CLASS + r"*```"


def extract_last_json(report) -> Column:
    """T5: body of the last ```json fenced block, null when there is none."""
    return F.try_element_at(F.regexp_extract_all(_c(report), F.lit(FENCE_RE), F.lit(1)), F.lit(-1))


def json_status(json_str) -> Column:
    """T6: 'no_json' / 'parse_error' / 'ok'."""
    j = _c(json_str)
    return (F.when(j.isNull(), "no_json")
            .when(F.try_parse_json(j).isNull(), "parse_error")
            .otherwise("ok"))


def grading_results_json(json_str) -> Column:
    """The stored object: the block itself, or the fallback error object."""
    j = _c(json_str)
    fallback = F.to_json(F.struct(F.lit(rules.JSON_PARSE_ERROR).alias("error"), j.alias("raw_json_str")))
    return F.when(j.isNull(), F.lit(None).cast("string")) \
        .when(F.try_parse_json(j).isNull(), fallback) \
        .otherwise(F.to_json(F.try_parse_json(j)))
