"""Requests of a submission as rows, and replies that are already stored."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import prompts as PR
from .enrich import RESPONSE_FIELDS
from .ranking import rank_within

#: Characters that count as one token where a stored reply carries no usage.
CHARS_PER_TOKEN = 4


def parse_request_rows(contexts: DataFrame, outputs: DataFrame, key: str = "submission") -> DataFrame:
    """The parts of every parse request, a row each: (key, ord, kind, text, ref).

    Part 0 is the instruction, part 1 the ``context`` of ``contexts``, then come the ``outputs`` (channel, output_path),
    textual before visual, each in path order.  Parts stay rows and are numbered by ``rank_within``, so no submission's
    files meet in one task.  A submission without outputs has no request; one without a context keeps its files only."""
    files = rank_within(outputs.select(key, "channel", "output_path"), [key], ["channel", "output_path"], "n")
    asked = contexts.join(outputs.select(key).distinct(), key, "left_semi")
    head = F.array(PR.text_part(F.lit(PR.PARSE_INSTRUCTION)), PR.text_part("context"))
    first = asked.select(key, F.posexplode(head).alias("ord", "part")).select(key, F.col("ord").cast("bigint").alias("ord"), "part.*")
    rest = files.select(key, (F.col("n") + 1).alias("ord"), PR.file_part("output_path").alias("part")).select(key, "ord", "part.*")
    return first.unionByName(rest)


def turn_pairs(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, text, reply) of every user turn; the reply is the assistant turn that follows it, else null.

    An equi-join on (conv_id, turn): a conversation with very many turns is dealt over all tasks.  Turns that are stored
    twice pair with each copy of their reply; null ids or turns pair with nothing."""
    asked = turns.filter(F.col("role") == "user").select("conv_id", "turn", "text")
    replies = turns.filter(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reply"))
    return asked.join(replies, ["conv_id", "turn"], "left")


def _tokens(text: Column) -> Column:
    return F.ceil(F.length(text) / F.lit(CHARS_PER_TOKEN)).cast("bigint")


def stored_answers(replies: DataFrame, key: str = "submission", model_type: str = "pro") -> Callable[[DataFrame], DataFrame]:
    """An answering stage that reads ``replies`` (key, stage, text) instead of calling a model.

    It takes requests (key, stage, request) and returns what ``invoke_model`` does; a request without a reply has ``error``
    set.  ``replies`` has at most one row for each (key, stage)."""
    def answer(requests: DataFrame) -> DataFrame:
        text = F.col("text")
        values = {"text": text, "prompt_tokens": F.when(text.isNotNull(), _tokens(F.col("request"))),
                  "completion_tokens": _tokens(text), "elapsed_s": F.lit(0.0), "attempts": F.lit(1),
                  "error": F.when(text.isNull(), "no stored reply"), "model_type": F.lit(model_type)}
        keep = [c for c in requests.columns if c != "request"]
        return requests.join(replies.select(key, "stage", "text"), [key, "stage"], "left").select(
            *keep, *[values[f.name].cast(f.dataType).alias(f.name) for f in RESPONSE_FIELDS])

    return answer
