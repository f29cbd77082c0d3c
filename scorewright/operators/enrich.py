"""Model calls as a Spark stage.

``invoke_model`` runs the call per row inside ``mapInPandas``: one client per
task (built by a picklable factory), retry with exponential backoff, elapsed
time and token counts per row, and the error kept on the row instead of
failing the job.  Calls are not idempotent: callers persist the responses
(``persist_responses``) before anything reads them twice, and keep
speculation off.  The number of partitions going in is the concurrency cap.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from .. import rules

RESPONSE_FIELDS = [
    T.StructField("text", T.StringType()),
    T.StructField("prompt_tokens", T.LongType()),
    T.StructField("completion_tokens", T.LongType()),
    T.StructField("elapsed_s", T.DoubleType()),
    T.StructField("attempts", T.IntegerType()),
    T.StructField("error", T.StringType()),
    T.StructField("model_type", T.StringType()),
]


@dataclass
class Reply:
    text: str | None
    prompt_tokens: int
    completion_tokens: int


class OfflineClient:
    """Deterministic stand-in for a hosted model (tests, benchmarks, dry runs).

    parsing  -> the submission text, whitespace-normalised ("transcription");
    grading  -> a short report ending in a ```json score block;
    solution -> markdown rendered from the structure hint in the request.
    ``fail_every``/``fail_times``: requests whose hash % fail_every == 0 raise
    on their first ``fail_times`` attempts (exercises the retry path)."""

    def __init__(self, model_name: str = "offline-pro", fail_every: int = 0, fail_times: int = 0):
        self.model_name = model_name
        self.fail_every = fail_every
        self.fail_times = fail_times
        self._seen: dict[str, int] = {}

    def generate(self, stage: str, request: str) -> Reply:
        h = int(hashlib.sha1(request.encode("utf-8", "surrogatepass")).hexdigest()[:8], 16)
        if self.fail_every and h % self.fail_every == 0:
            n = self._seen.get(request, 0)
            self._seen[request] = n + 1
            if n < self.fail_times:
                raise RuntimeError("transient model error")
        if stage == "parsing":
            body = request.split("\n\n", 1)[-1]
            text = " ".join(body.split())
        elif stage == "grading":
            pts = h % 5
            text = (f"Report for request {h % 1000}.\n```json\n"
                    f"{{\"Exercise 1.1\": {{\"i\": {pts}}}, \"Exercise 1.3\": {h % 3}, \"total\": {pts + h % 3}}}\n```\n")
        else:
            text = render_solution_markdown(request)
        return Reply(text, max(1, len(request) // 4), max(1, len(text) // 4))


_ROMAN = re.compile(r"^x{0,3}(ix|iv|v?i{0,3})$")
_PRED = {"i": "h", "v": "u", "x": "w"}


def render_solution_markdown(request: str) -> str:
    """Markdown in the solution grammar for the hint embedded in ``request``
    (what the offline client answers for the solution stage).  A part with
    pointed sub-parts is rendered as a container."""
    items = []          # (exercise, kind, marker, points)
    ex, prev = None, None
    for line in request.split("\n"):
        m = re.match(r"^\s*Exercise\s+([^\s:]+)\s*:?(.*)$", line)
        if m:
            ex, prev = m.group(1), None
            p = re.search(r"(\d+(?:\.\d+)?)\s*points?", m.group(2))
            if p:
                items.append((ex, "single", "i", p.group(1)))
            continue
        m = re.match(r"^\s*\(?([A-Za-z]+)\)\s*(.*)$", line)
        b = re.match(r"^\s*\[?\s*(\d+(?:\.\d+)?)\s*points?\s*\]?\s*$", line)
        if m and ex:
            mk = m.group(1).lower()
            roman = bool(mk) and bool(_ROMAN.match(mk)) and prev != _PRED.get(mk)
            p = re.search(r"(\d+(?:\.\d+)?)\s*points?", m.group(2))
            items.append((ex, "part" if roman else "sub", mk, p.group(1) if p else None))
            prev = mk
        elif b and ex:
            items.append((ex, "single", "i", b.group(1)))
    out, totals = [], {}
    for idx, (e, kind, mk, pts) in enumerate(items):
        if idx == 0 or items[idx - 1][0] != e:
            out.append(f"## Exercise {e} (Exercise {e}). (Total: TOTAL_{e} points)")
        has_children = kind == "part" and any(
            it[1] == "sub" and it[3] is not None for it in
            itertools.takewhile(lambda it: it[0] == e and it[1] == "sub", items[idx + 1:]))
        if kind == "part" and (pts is None or has_children):
            out.append(f"({mk}) Part {mk}")
            continue
        if pts is None:
            continue
        prompt = f"The question for Exercise {e}." if kind == "single" else f"Question {mk} of {e}."
        out += [f"({mk}) {prompt} [{pts} points]", "**Solution.**", f"Answer {e} {mk}."]
        totals[e] = totals.get(e, 0.0) + float(pts)
    text = "\n".join(out)
    for e, tot in totals.items():
        text = text.replace(f"TOTAL_{e} ", f"{tot:g} ")
    return re.sub(r"TOTAL_\S+ ", "0 ", text)


CALLS_PER_BATCH = 16


def _call(it: Iterator[pd.DataFrame], factory: Callable, max_retries: int, retry_delay: float,
          sleep: Callable[[float], None], keep: list[str]) -> Iterator[pd.DataFrame]:
    client = factory()
    model_name = getattr(client, "model_name", "")
    model_type = "pro" if "pro" in model_name else "flash"
    for pdf in it:
        # answers leave in small groups: a lost task repeats few calls
        for at in range(0, len(pdf), CALLS_PER_BATCH):
            part = pdf.iloc[at:at + CALLS_PER_BATCH]
            answers = [_answer(client, stage, request, model_type, max_retries, retry_delay, sleep)
                       for stage, request in zip(part["stage"], part["request"])]
            fields = pd.DataFrame(answers, columns=[f.name for f in RESPONSE_FIELDS], index=part.index)
            yield pd.concat([part[keep], fields], axis=1)  # the key columns go through as they came


def _answer(client, stage, request, model_type, max_retries, retry_delay, sleep) -> dict:
    start = time.time()
    reply, error, attempts = None, None, 0
    for attempt in range(max_retries + 1):
        attempts = attempt + 1
        try:
            reply = client.generate(stage, request)
            error = None
            break
        except Exception as exc:  # noqa: BLE001 - the error is the row's result
            error = f"{type(exc).__name__}: {exc}"
            if attempt < max_retries:
                sleep(retry_delay * (2 ** attempt))
    return {"text": reply.text if reply else None,
            "prompt_tokens": reply.prompt_tokens if reply else None,
            "completion_tokens": reply.completion_tokens if reply else None,
            "elapsed_s": time.time() - start, "attempts": attempts, "error": error, "model_type": model_type}


def limit_concurrency(df: DataFrame, parallel: int = rules.DEFAULT_PARALLEL, key: str | None = None) -> DataFrame:
    """At most ``parallel`` concurrent calls = that many partitions
    (<= 0 -> min(4, default parallelism)).  An explicit count is kept by AQE."""
    if parallel <= 0:
        parallel = min(rules.AUTO_PARALLEL_CAP, df.sparkSession.sparkContext.defaultParallelism)
    return df.repartition(parallel, key) if key else df.repartition(parallel)


def invoke_model(requests: DataFrame, client_factory: Callable, max_retries: int = rules.MAX_RETRIES,
                 retry_delay: float = rules.RETRY_DELAY_S, sleep: Callable[[float], None] = time.sleep,
                 parallel: int | None = None, key: str | None = None) -> DataFrame:
    """``requests`` has ``stage`` and ``request`` (text) plus key columns;
    returns the key columns + stage + response fields."""
    from ..session import ship_package
    ship_package(requests.sparkSession)
    keep = [c for c in requests.columns if c != "request"]
    src = limit_concurrency(requests, parallel, key) if parallel is not None else requests
    schema = T.StructType([requests.schema[c] for c in keep] + RESPONSE_FIELDS)
    return src.mapInPandas(lambda it: _call(it, client_factory, max_retries, retry_delay, sleep, keep), schema)


def persist_responses(responses: DataFrame) -> DataFrame:
    """Write responses once as a table in the shared checkpoint folder and
    read them back, so no later action calls the model again.  (A
    ``Dataset.checkpoint`` of an unpersisted plan would evaluate it twice:
    once for the eager count, once for the checkpoint write.)"""
    from ..session import materialize
    return materialize(responses, "responses")
