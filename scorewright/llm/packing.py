"""Operator 9: packing documents into training sequences by best-two-fit.

Only lengths decide how pieces share sequences, and there are at most ``capacity`` different lengths.  So the packing is
planned on the histogram of lengths, whatever the number of documents: a bin is filled greedily, its smallest document
is exchanged for the two that fit its gap best, and the resulting mix of lengths is repeated as long as its lengths last.
The pieces then find their places by their rank among pieces of the same length, counted in small buckets, so that
neither a plan nor a window grows with a popular length."""

from __future__ import annotations

import os
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import byte_list, in_slices, prepared, stored

CAPACITY = 2048
CACHE_WORDS = 400_000
BUCKET_ROWS = 2_000
_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


# ---------------------------------------------------------------- tokens
_MARKS = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum())
#: Letters and digits of one or two bytes; lower-cased, some letters end with a mark.
_LETTER = np.array([chr(c).lower().isalpha() or c < 128 and chr(c).isdigit() for c in range(0x800)])


def _halves(words):
    """An Arrow array with two entries for each of ``words``: the word without the ASCII marks it ends with, and these, which
    are a pre-token of their own after a letter or digit.  Words are whole where that could cut a special token, and after
    letters of more than two bytes."""
    import pyarrow as pa
    import pyarrow.compute as pc
    _, ends, data = words.buffers()
    ends, points = np.frombuffer(ends, "<i8", len(words) + 1), np.frombuffer(data or b"\0", np.uint8)
    begin, end = ends[:-1], ends[1:]
    bare = begin + pc.binary_length(pc.ascii_rtrim(words, _MARKS)).to_numpy()
    last, before = points[np.maximum(bare - 1, 0)], points[np.maximum(bare - 2, 0)].astype(np.int64)
    pair = (last >= 0x80) & (before >= 0xC2) & (before < 0xE0)
    letter = _LETTER[np.where(pair, (before & 31) << 6 | last & 63, np.where(last < 0x80, last, 0))]
    whole = ~letter | (bare == begin) | pc.match_substring(words, "<|").to_numpy(zero_copy_only=False)
    places = np.r_[np.c_[begin, np.where(whole, end, bare)].ravel(), ends[-1:]]
    return pa.Array.from_buffers(pa.large_binary(), 2 * len(words), [None, pa.py_buffer(places), data])


class WordCache:
    """Token ids, as little-endian unsigned 32-bit bytes, word by word.

    No pre-token of the vocabulary spans white space, so a text's ids are its words' ids one after the other.  Only words
    not seen before, marks at their ends aside, reach the tokenizer.  The cache holds at most ``limit`` words; later ones
    are encoded each time."""

    def __init__(self, path: str, limit: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer, self.limit, self.known = Tokenizer.from_file(path), limit, {}

    def ids(self, words: list[bytes]) -> list[bytes]:
        """The ids of each of ``words``, which are all different."""
        known = self.known
        out = list(map(known.get, words))
        later = [k for k, ids in enumerate(out) if ids is None]
        if later:
            new = [words[k] for k in later]
            coded = self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in new], add_special_tokens=False)
            for k, w, e in zip(later, new, coded):
                out[k] = ids = np.array(e.ids, "<u4").tobytes()
                if len(known) < self.limit:
                    known[w] = ids
        return out


_CACHES: dict[str, WordCache] = {}  # of this worker process, so that a later task starts with the words it knows


def _cache(path: str) -> WordCache:
    if path not in _CACHES:
        _CACHES[path] = WordCache(path)
    return _CACHES[path]


def _words(texts):
    """(words, places): the words of an Arrow string column, and where those of each text begin and end.

    The tokenizer lower-cases anyway; done before, more words are alike.  Not where that could make a special token."""
    import pyarrow as pa
    import pyarrow.compute as pc
    lower = pa.array([t if b"<|" in t else t.lower() for t in byte_list(texts)], pa.large_binary())
    lists = pc.ascii_split_whitespace(pa.Array.from_buffers(pa.large_string(), len(lower), lower.buffers()))
    return lists.values, lists.offsets.to_numpy()


def _ids(texts, cache: WordCache):
    """(ids, ends): the ids of all ``texts``, an Arrow string column, one after the other, and the bytes at which those of
    each begin and end.  A word of many texts is looked up once."""
    import pyarrow as pa
    words, places = _words(texts)
    if not len(words):
        return b"", places
    coded = words.dictionary_encode()
    halves = _halves(coded.dictionary).dictionary_encode()
    each = pa.array(cache.ids(halves.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(halves.indices)
    begin = np.frombuffer(each.buffers()[1], "<i8", len(each) + 1)[::2].copy()
    every = pa.Array.from_buffers(pa.large_binary(), len(begin) - 1, [None, pa.py_buffer(begin), each.buffers()[2]]).take(coded.indices)
    return every.buffers()[2] or b"", np.frombuffer(every.buffers()[1], "<i8", len(every) + 1)[places]


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of each document's ids followed by ``end_id``, cut at ``capacity``.

    Null text counts as empty, which gives one piece that is ``end_id`` alone."""
    prepared(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        import pyarrow as pa
        cache = _cache(tokenizer_path)
        for batch in in_slices(batches):
            every, ends = _ids(batch.column(1), cache)
            every, out = memoryview(every), []
            for doc, a, b in zip(batch.column(0).to_pylist(), ends[:-1].tolist(), ends[1:].tolist()):
                ids = bytes(every[a:b]) + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    out.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*out)) if out else [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t")
                       ).mapInArrow(run, _PIECE)


# ---------------------------------------------------------------- plan
@dataclass
class Plan:
    """Runs of equal bins, listed by (length, first rank): pieces of that length from this rank on, ``per_bin`` in each
    bin at ``offsets``, in the sequences from ``sequence`` on."""
    length: np.ndarray
    rank: np.ndarray
    per_bin: np.ndarray
    sequence: np.ndarray
    at: np.ndarray
    offsets: np.ndarray
    sequences: int


def fill(counts: np.ndarray, capacity: int) -> list[int]:
    """Lengths of the next bin: the longest that fits, again and again; then its shortest gives way to the two whose sum
    fits the widened gap most tightly, if they fill it better."""
    left = counts.copy()
    there = np.flatnonzero(left)
    chosen: list[int] = []
    gap = capacity
    while gap:
        i = int(np.searchsorted(there, gap, "right")) - 1
        if i < 0:
            break
        size = int(there[i])
        n = min(int(left[size]), gap // size)
        chosen += [size] * n
        left[size] -= n
        gap -= n * size
        there = there[:i] if left[size] == 0 or n == 0 or gap < size else there[:i + 1]
    if len(chosen) > 1 and gap:
        least = chosen[-1]
        room = gap + least
        free = np.flatnonzero(left[:room + 1])
        if len(free):
            other = np.searchsorted(free, room - free, "right") - 1
            ok = other >= 0
            a, b = free[ok], free[other[ok]]
            ok = (a != b) | (left[a] > 1)
            # a length of which one piece is left cannot be taken twice: its next shorter partner
            single, j = a[~ok], other[other >= 0][~ok] - 1
            a, b = np.r_[a[ok], single[j >= 0]], np.r_[b[ok], free[j[j >= 0]]]
            if len(a):
                best = int(np.argmax(a + b))
                if a[best] + b[best] > least:
                    chosen[-1:] = [int(max(a[best], b[best])), int(min(a[best], b[best]))]
    return chosen


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Best-two-fit for ``histogram`` (length -> pieces), at most ``capacity`` entries."""
    counts = np.zeros(capacity + 1, np.int64)
    for size, n in histogram.items():
        counts[size] = n
    used = np.zeros(capacity + 1, np.int64)
    rows, offsets, sequence = [], [], 0
    while counts.any():
        bin_ = np.array(fill(counts, capacity))
        sizes, per_bin = np.unique(bin_, return_counts=True)
        times = int((counts[sizes] // per_bin).min())
        at = np.cumsum(bin_) - bin_
        for size, n in zip(sizes.tolist(), per_bin.tolist()):
            rows.append((size, used[size], n, sequence, len(offsets)))
            offsets += at[bin_ == size].tolist()
        used[sizes] += times * per_bin
        counts[sizes] -= times * per_bin
        sequence += times
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 5).T
    return Plan(*cols, np.array(offsets, np.int64), sequence)


def place(plan: Plan, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of the piece of ``length`` that has ``rank`` (from 0) among its equals."""
    key = lambda size, r: size * (1 << 48) + r
    run = np.searchsorted(key(plan.length, plan.rank), key(length, rank), "right") - 1
    turn = rank - plan.rank[run]
    return plan.sequence[run] + turn // plan.per_bin[run], plan.offsets[plan.at[run] + turn % plan.per_bin[run]]


# ---------------------------------------------------------------- operator
def pack(parts: DataFrame, capacity: int = CAPACITY, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``parts`` (doc_id, piece, start, length, ids_crc32; length from 1 to ``capacity``) with ``sequence_id`` and
    ``offset``.  Rows alike in every column may change places.  An empty table gives an empty result."""
    spark = parts.sparkSession
    prepared(spark)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    histogram = {r.length: r.n for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = spark.sparkContext.broadcast(plan_bins(histogram, capacity))
    buckets = max(1, -(-sum(histogram.values()) // bucket_rows))
    dealt = parts.select(*names, F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).alias("bucket"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
               .select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    own = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (dealt.withColumn("r", F.row_number().over(own) - 1).join(offsets, ["length", "bucket"])
              .select(*names, (F.col("r") + F.col("base")).alias("rank")))

    def assign(frames):
        for pdf in frames:
            seq, off = place(plan.value, pdf.length.values, pdf["rank"].values)
            yield pdf[names].assign(sequence_id=seq, offset=off)

    return ranked.mapInPandas(assign, f"{_PIECE}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Every document of ``docs`` in sequences of at most ``capacity`` ids (see ``pieces`` and ``pack``)."""
    return pack(stored(pieces(docs, tokenizer_path, capacity=capacity, end_id=end_id), "pieces"), capacity)
