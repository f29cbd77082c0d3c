"""Operator 13: fill-in-the-middle.  A text is cut at two token ranks drawn from its id, and its three parts are put in
another order between sentinels.  The ranks become character offsets through an indexable skip list (``skiplist``)."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import in_slices, prepared
from .skiplist import SkipList

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
ADDED = ("n", "form", "prefix_chars", "middle_chars", "output")


def token_sizes(text: str) -> np.ndarray:
    """Code points of each token: white space with the word behind it, or the white space at the end."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(c):
        return np.zeros(0, np.int64)
    white = (c == 0x20) | ((c >= 0x09) & (c <= 0x0D))
    ends = np.flatnonzero(~white & np.r_[white[1:], True]) + 1
    if white[-1]:
        ends = np.r_[ends, len(c)]
    return np.diff(ends, prepend=0)


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four 32-bit numbers of a document; a missing id reads as no digits."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(h[i:i + 8], 16) for i in range(0, 32, 8)]


def transform(text: str, doc_id: int | None, seed: int, rate: int, spm_rate: int) -> tuple[int, str, int | None, int | None, str]:
    """(tokens, form, prefix code points, middle code points, output) of one text."""
    sizes = token_sizes(text)
    n = len(sizes)
    h1, h2, h3, h4 = draws(seed, doc_id)
    if not text or h3 % 100 >= rate or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    ranks = sorted((h1 % (n + 1), h2 % (n + 1)))
    lanes = SkipList(sizes)
    a, b = lanes.point(ranks[0]), lanes.point(ranks[1])
    head, middle, tail = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_rate:
        return n, "spm", a, b - a, f"{SUFFIX}{tail}{PREFIX}{head}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{head}{SUFFIX}{tail}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, seed: int = 42, rate: int = 50, spm_rate: int = 80) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) with the new columns ``n`` (tokens), ``form`` (plain, psm or spm),
    ``prefix_chars``, ``middle_chars`` (null if plain) and ``output``; input columns with these names are replaced.

    ``rate`` per cent of the texts are transformed, ``spm_rate`` per cent of those with the suffix in front.  One row in,
    one row out, no shuffle: every choice follows from the id, so a repeated task or a repeated row gives the same.
    Null text counts as empty in the new columns and stays null in ``text``; empty texts and texts that hold a sentinel
    stay plain; a null id draws from the seed alone.  An empty table gives an empty result."""
    prepared(docs.sparkSession)

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        for batch in in_slices(batches, 500):
            rows = [transform(t or "", i, seed, rate, spm_rate)
                    for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())]
            n, form, a, b, out = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pc.is_null(batch.column("text")), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                 pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(out, pa.string())], ["row", "missing", *ADDED])

    old = [c for c in docs.columns if c not in ADDED]
    # the text itself does not come back from the task: it is rebuilt from its output
    packed = docs.select(F.struct(F.lit(0).alias("of"), *[c for c in old if c != "text"]).alias("row"),
                         F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    added = T.StructType.fromDDL("missing boolean, n long, form string, prefix_chars long, middle_chars long, output string")
    out = packed.mapInArrow(run, T.StructType([packed.schema["row"], *added.fields]))
    text = F.when(~F.col("missing"), restore(F.col("form"), F.col("output")))
    return out.select(*[(text if c == "text" else F.col("row").getField(c)).alias(c) for c in old], *ADDED)


def restore(form: Column, output: Column) -> Column:
    """The text that ``output`` was made from.  The parts hold no sentinel, and none can arise across a seam."""
    def between(start: str, end: str) -> Column:
        a = F.instr(output, start) + F.lit(len(start))
        return F.substring(output, a, F.instr(output, end) - a)

    def behind(start: str) -> Column:
        return F.substring(output, F.instr(output, start) + F.lit(len(start)), F.length(output))

    psm = F.concat(between(PREFIX, SUFFIX), behind(MIDDLE), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), behind(MIDDLE), between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
