"""Operator 8: benchmark decontamination by Wu-Manber search.

The strings searched for are the windows of the benchmark items, normalised like the texts: words joined by single
blanks, with a blank on either side.  The benchmark is the stated query set: it goes to the tasks in blocks of at most
``block_bytes`` of text (a fixed memory bound however large it is), each block one pass over all texts."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_list, in_slices, prepared
from .wumanber import WuManber

WINDOW = 10
BLOCK_BYTES = 16 << 20
#: Word bytes: lower-case letters, digits and everything outside ASCII; capitals fold, all else separates words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def windows(words: list[bytes], size: int = WINDOW) -> list[bytes]:
    """Every run of ``size`` words, or all of fewer; none for no words."""
    if not words:
        return []
    return [b" " + b" ".join(words[i:i + size]) + b" " for i in range(max(1, len(words) - size + 1))]


def _block(rows, size: int):
    items: dict[bytes, set[str]] = {}
    for r in rows:
        for w in windows(words_of((r.t or "").encode()), size):
            items.setdefault(w, set()).update(() if r.item is None else (r.item,))
    found = sorted(items)
    return found, [sorted(items[p]) for p in found]


def _benchmark_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int):
    b = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("t"))
    total = b.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-2 * total // block_bytes))
    for i in range(n):
        yield (b if n == 1 else b.filter(F.pmod(F.xxhash64("item"), F.lit(n)) == i)).collect()


def find_windows(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: all its columns and ``n_words``, ``hits`` (numbers of the hit words, ascending),
    ``items`` (ids of the items with a window in the text, ascending as strings); columns of these names are replaced.

    Null text has no words.  Items with null id mark their words but have no id to list, items without words match nothing; an empty
    benchmark gives no hits.  Repeated rows are judged each for itself; an empty table gives an empty result."""
    spark = docs.sparkSession
    prepared(spark)
    new = ("n_words", "hits", "items")
    out = docs.drop(*new).withColumn(text_col, F.col(text_col).cast("string")).withColumns({
        "n_words": F.lit(0).cast("long"), "hits": F.array().cast("array<int>"), "items": F.array().cast("array<string>")})
    for rows in _benchmark_blocks(benchmark, item_col, item_text_col, block_bytes):
        out = _pass(out, text_col, spark.sparkContext.broadcast(_block(rows, window)))
    return out


def _pass(docs: DataFrame, text_col: str, strings) -> DataFrame:
    names, at = docs.columns, docs.columns.index(text_col)

    def run(batches):
        import pyarrow as pa
        patterns, items = strings.value
        machine = WuManber(patterns)
        lengths = np.array([p.count(b" ") - 1 for p in patterns], np.int64)
        for batch in in_slices(batches):
            counts, hits, found_items = _search(machine, lengths, items, byte_list(batch.column(at)))
            before = [batch.column(names.index(c)).to_pylist() for c in ("hits", "items")]
            hits = [sorted({*a, *b}) if a else b for a, b in zip(before[0], hits)]
            found_items = [sorted({*a, *b}) for a, b in zip(before[1], found_items)]
            made = {"n_words": pa.array(counts, pa.int64()), "hits": pa.array(hits, pa.list_(pa.int32())),
                    "items": pa.array(found_items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([made.get(n, batch.column(i)) for i, n in enumerate(names)], names)

    return docs.mapInArrow(run, docs.schema)


def _search(machine: WuManber, lengths: np.ndarray, items, texts: list[bytes]):
    """Word counts, hit words and item ids of each text; the texts are searched as one, with line feeds between."""
    raw = np.frombuffer(b"".join(b" %b \n" % t.translate(_FOLD) for t in texts), np.uint8)
    blank = raw == 32
    data = raw[~(blank & np.r_[False, blank[:-1]])]
    blanks = np.flatnonzero(data == 32)
    starts = np.r_[0, np.flatnonzero(data == 10)[:-1] + 1]
    first = np.searchsorted(blanks, starts)  # a text's first blank; its word k follows its blank k
    counts = np.diff(np.r_[first, len(blanks)]) - 1
    pos, which = machine.search(data.tobytes())
    hits, found = [[] for _ in texts], [set() for _ in texts]
    if len(pos):
        word, doc = np.searchsorted(blanks, pos), np.searchsorted(starts, pos, "right") - 1
        depth = np.zeros(len(blanks) + 1, np.int64)
        np.add.at(depth, word, 1)
        np.add.at(depth, word + lengths[which], -1)
        hit = np.flatnonzero(np.cumsum(depth))
        owner = np.searchsorted(first, hit, "right") - 1
        for d in np.unique(owner):
            lo, hi = np.searchsorted(owner, [d, d + 1])
            hits[d] = (hit[lo:hi] - first[d]).tolist()
        for d, i in np.unique(np.stack([doc, which], 1), axis=0).tolist():
            found[d].update(items[i])
    return counts, hits, found


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated (see find_windows)."""
    slim = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    found = find_windows(slim, benchmark, **options)
    return found.select("doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.size("hits") > 0).alias("contaminated"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark window, unchanged."""
    rows = docs.select("text", F.struct(*[c for c in docs.columns if c != "text"]).alias("row"))
    clean = find_windows(rows, benchmark, **options).filter(F.size("hits") == 0)
    return clean.select(*[F.col(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])
