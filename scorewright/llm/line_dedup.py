"""Operator 5: line deduplication by a segment-partition edit join.

Lines are told apart by a 128-bit hash; equal lines are one class from the first shuffle on.  Lines within ``most`` edits
of each other are found through shared segments: every line puts its ``most`` + 1 segments into an index by key and looks
up the substrings that a line of similar length could have as a segment.  Only keys that two lines meet in go on; only
those lines' texts are moved, and only the pairs that sizes and sketches leave are verified by them.  Of each component of
equal and similar lines the first occurrence (smallest doc_id, then line) stays."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NO_ID, discard, in_slices, partitions_for, prepared, stored
from .components import connected_components
from .editjoin import (LineKeys, alike, linked, may_be_alike, pair_keys, pairs_alike, pairs_within, probes, sketches,
                       small_pairs)

MAX_EDITS, MIN_EXACT, MIN_SIMILAR, CHUNK = 2, 10, 20, 512
#: Bits of the filter in front of the text fetch (16 MB).
FILTER_BITS = 1 << 27
BITMAP = 32768
#: So many lines that meet are compared pair by pair, more of them line by line with all others.
FEW = 8
#: Buckets of keys to a partition, one in memory at a time, and keys packed at once.
BUCKETS, PACK = 4, 1 << 18
#: More than the lines that have a key.
_OWN = 1 << 40


def _ids(line: str) -> tuple[int, int]:
    """128-bit hash as two signed longs."""
    h = xxhash.xxh3_128_digest(line.encode("utf-8", "surrogatepass"))
    return tuple(np.frombuffer(h, "<i8").tolist())


def _texts(docs: DataFrame) -> DataFrame:
    """(id, mark, t): rows alike in id and text are one document to this operator."""
    t = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(t).alias("mark"), t.alias("t"))


def occurrences(texts: DataFrame, min_chars: int) -> DataFrame:
    """(id, mark, line, hi, lo) of every line of at least ``min_chars`` characters, white space at its ends aside."""
    def run(batches):
        import pyarrow as pa
        for batch in in_slices(batches):
            doc, line, ids = [], [], []
            for k, t in enumerate(batch.column(2).to_pylist()):
                for n, s in enumerate(t.split("\n")):
                    s = s.strip()
                    if len(s) >= min_chars:
                        doc.append(k)
                        line.append(n)
                        ids.append(_ids(s))
            which = pa.array(doc, pa.int64())
            both = np.array(ids, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(which), batch.column(1).take(which), pa.array(line, pa.int32()), pa.array(both[:, 0].copy()),
                 pa.array(both[:, 1].copy())], ["id", "mark", "line", "hi", "lo"])

    return texts.mapInArrow(run, "id long, mark long, line int, hi long, lo long")


def _first_lines(texts: DataFrame, firsts: DataFrame, min_chars: int) -> DataFrame:
    """``texts`` with only those lines that are the first of their kind, so that a line is looked at once however often it
    is repeated.  Places travel as a bitmap of fixed size: what it lets through besides is a repeat, which changes nothing."""
    first = F.col("first")
    place = first["mark"].bitwiseXOR(F.shiftleft(first["id"], 13)).bitwiseXOR(F.shiftleft(first["line"].cast("long"), 1))
    shared = texts.sparkSession.sparkContext.broadcast(_bits(firsts.select(place.alias("place")), "place"))

    def run(batches):
        import pyarrow as pa
        for batch in in_slices(batches):
            doc = batch.column(1).to_numpy() ^ (batch.column(0).to_numpy() << 13)
            left = []
            for k, t in enumerate(batch.column(2).to_pylist()):
                lines = [s.strip() for s in t.split("\n")]
                there = _marked(shared.value, doc[k] ^ (np.arange(len(lines)) << 1)).tolist()
                left.append("\n".join(s for s, x in zip(lines, there) if x and len(s) >= min_chars) or None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(left, pa.string())], ["id", "mark", "t"])

    return texts.mapInArrow(run, "id long, mark long, t string").filter("t IS NOT NULL")


def _chunks(lines: dict[int, str], chars: int = 1 << 19):
    """(ids, texts) of ``lines``, so many at a time that their arrays stay small."""
    ids, texts, size = [], [], 0
    for i, s in lines.items():
        ids.append(i)
        texts.append(s)
        size += len(s)
        if size >= chars:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _made(batches, min_chars: int, most: int):
    """(key, line, own) arrays of every segment and probe of the lines in ``batches``; ``own`` if the key is a segment of the
    line.  A key with its lowest bit set is a word shingle: long lines alike share one of their least."""
    plan = lru_cache(maxsize=4096)(lambda n: np.array(probes(n, most), np.int64).reshape(-1, 5))
    for batch in in_slices(batches):
        lines = {}
        for t in batch.column(2).to_pylist():
            for s in t.split("\n"):
                s = s.strip()
                if len(s) >= min_chars:
                    lines[_ids(s)[0] & ~1] = s
        for ids, some in _chunks(lines):
            every = LineKeys(some)
            line, key, own = every.segments(plan)
            long, run = every.least_shingles()
            yield (np.r_[key & ~np.uint64(1), run | np.uint64(1)], np.array(ids, np.int64)[np.r_[line, long]],
                   np.r_[own, np.ones(len(long), bool)])


def _keys(texts: DataFrame, min_chars: int, most: int) -> DataFrame:
    """(key, seen) of every segment and probe, a row each; ``seen`` is 1 and ``_OWN`` more if the key is a segment of the line."""
    def run(batches):
        import pyarrow as pa
        for key, _, own in _made(batches, min_chars, most):
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(1 + own * np.int64(_OWN))], ["key", "seen"])

    return texts.mapInArrow(run, "key long, seen long")


def _packed(texts: DataFrame, min_chars: int, most: int, buckets: int) -> DataFrame:
    """(bucket, pairs): the keys of ``_keys`` with their lines, dealt by key.  ``pairs`` are key and line of 8 bytes each;
    the lowest bit of a key says ``own`` here, the next one that it is a word shingle."""
    def rows(held):
        import pyarrow as pa
        pairs = np.concatenate(held)
        bucket = (pairs[:, 0] >> np.uint64(2)) % np.uint64(buckets)
        order = np.argsort(bucket.astype(np.uint16 if buckets <= 1 << 16 else np.uint32), kind="stable")
        ends = np.cumsum(np.bincount(bucket.astype(np.int64), minlength=buckets))
        there = np.flatnonzero(np.diff(ends, prepend=0))
        offsets = np.r_[0, ends[there]].astype(np.int32) * 16
        packed = pa.Array.from_buffers(pa.binary(), len(there), [None, pa.py_buffer(offsets), pa.py_buffer(pairs[order])])
        return pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), packed], ["bucket", "pairs"])

    def run(batches):
        held, size = [], 0
        for key, line, own in _made(batches, min_chars, most):
            key = key & ~np.uint64(3) | (key & np.uint64(1)) << np.uint64(1) | own
            held.append(np.c_[key, line.view(np.uint64)])
            size += len(key)
            if size >= PACK:
                yield rows(held)
                held, size = [], 0
        if size:
            yield rows(held)

    return texts.mapInArrow(run, "bucket int, pairs binary")


def _met(pairs: np.ndarray):
    """(key, line, own) of the keys in ``pairs`` of ``_packed`` that are there twice and a segment at least once, each row once."""
    import pyarrow as pa
    key = np.ascontiguousarray(pairs[:, 0])
    order = np.argsort(key)
    key = key[order]
    begin = np.flatnonzero(np.r_[True, (key[1:] ^ key[:-1]) > 1])
    many = np.diff(np.r_[begin, len(key)])
    some = np.repeat((many > 1) & (np.bitwise_or.reduceat(key, begin) & np.uint64(1) == 1), many)
    key, line = key[some], pairs[order[some], 1].view(np.int64)
    order = np.lexsort((key, line, key >> np.uint64(1)))
    key, line = key[order], line[order]
    last = np.r_[(key[1:] ^ key[:-1] > 1) | (line[1:] != line[:-1]), True][:len(key)]  # of a line's rows those that are own
    key, line = key[last], line[last]
    out = (key & ~np.uint64(3) | (key >> np.uint64(1)) & np.uint64(1)).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(out), pa.array(line), pa.array(key & np.uint64(1) == 1)], ["key", "line", "own"])


def _bits(rows: DataFrame, name: str) -> np.ndarray:
    """A bitmap of fixed size of the longs in column ``name``."""
    spot = F.pmod(F.shiftright(name, 1), F.lit(FILTER_BITS))
    maps = (rows.select(F.floor(spot / BITMAP).alias("slot"), (spot % BITMAP).alias("bit")).groupBy("slot")
            .agg(F.bitmap_construct_agg("bit").alias("bits")).collect())  # at most FILTER_BITS bits
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in maps:
        b = np.frombuffer(bytes(r.bits), np.uint8)
        bits[r.slot * BITMAP // 8:][:len(b)] = b
    return bits


def _marked(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    spot = (values >> 1) % FILTER_BITS
    return (bits[spot >> 3] >> (spot & 7).astype(np.uint8) & 1).astype(bool)


def _meetings(texts: DataFrame, min_chars: int, most: int) -> DataFrame:
    """The (key, line, own) rows of keys that are a segment of one line and looked up by another, each once.

    Keys are made once and shuffled with their lines as numbers of fixed size, many to a row; a task sorts one bucket of
    keys after another.  A key that one line has twice is among them; ``_different`` leaves it out."""
    n = partitions_for(texts.sparkSession)

    def run(batches):
        held, bucket = [], None
        for batch in batches:
            which, packed = batch.column(0).to_numpy(), batch.column(1)
            bounds = np.flatnonzero(np.r_[True, which[1:] != which[:-1]]).tolist() + [len(which)]
            for lo, hi in zip(bounds, bounds[1:]):
                if which[lo] != bucket and held:
                    yield _met(np.concatenate(held))
                    held = []
                bucket = which[lo]
                held.append(np.frombuffer(b"".join(packed.slice(lo, hi - lo).to_pylist()), np.uint64).reshape(-1, 2))
        if held:
            yield _met(np.concatenate(held))

    dealt = (_packed(texts, min_chars, most, n * BUCKETS).repartitionById(n, F.pmod("bucket", F.lit(n)))
             .sortWithinPartitions("bucket"))
    return stored(dealt.mapInArrow(run, "key long, line long, own boolean"), "meetings")


def _different(meet: DataFrame) -> DataFrame:
    """(key, n) of one key for each set of lines: near copies meet in many keys, all with the same lines, told by two hashes."""
    hashes = [F.bit_xor(F.xxhash64(F.lit(k), "line", "own")) for k in (1, 2)]
    sets = meet.groupBy("key").agg(F.count(F.lit(1)).alias("n"), hashes[0].alias("h"), hashes[1].alias("g")).filter("n > 1")
    return sets.groupBy("n", "h", "g", F.col("key").bitwiseAND(F.lit(1))).agg(F.min("key").alias("key")).select("key", "n")


def _fetched(texts: DataFrame, wanted: DataFrame, min_chars: int) -> DataFrame:
    """(line, s): the text of the ``wanted`` lines.  A bitmap of fixed size keeps most other lines from being moved."""
    shared = texts.sparkSession.sparkContext.broadcast(_bits(wanted, "line"))

    def run(batches):
        import pyarrow as pa
        there = shared.value
        for batch in in_slices(batches):
            found = {}
            for t in batch.column(0).to_pylist():
                for s in t.split("\n"):
                    s = s.strip()
                    if len(s) >= min_chars:
                        h = _ids(s)[0] & ~1
                        spot = (h >> 1) % FILTER_BITS
                        if there[spot >> 3] >> (spot & 7) & 1:
                            found[h] = s
            yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.int64()), pa.array(found.values(), pa.string())], ["line", "s"])

    some = texts.select("t").mapInArrow(run, "line long, s string")
    return some.join(wanted, "line", "left_semi").dropDuplicates(["line"])


def _sets(rows: pd.DataFrame) -> dict[int, np.ndarray]:
    """The shingles of each line, made once for all keys of ``rows`` (line, s)."""
    out = {}
    for ids, some in _chunks(dict(zip(rows["line"].tolist(), rows["s"].tolist()))):
        owner, runs = LineKeys(some).shingles()
        out.update(zip(ids, np.split(runs, np.cumsum(np.bincount(owner, minlength=len(some)))[:-1])))
    return out


def _by_task(frames, work):
    """``work`` on the rows of whole tasks (key, lo, hi), which come one after another."""
    held = None
    for pdf in frames:
        if held is not None:
            pdf = pd.concat([held, pdf], ignore_index=True)
        place = pdf[["key", "lo", "hi"]].values
        last = int(np.flatnonzero((place != place[-1]).any(1))[-1]) + 1 if (place != place[-1]).any() else 0
        held = pdf[last:]
        if last:
            yield work(pdf[:last])
    if held is not None and len(held):
        yield work(held)


def _sketched(lines: DataFrame) -> DataFrame:
    """``lines`` (line, s) with the number of a line's shingles and their sketch."""
    def run(batches):
        import pyarrow as pa
        for batch in in_slices(batches):
            texts, n, marks = dict(enumerate(batch.column(1).to_pylist())), [], []
            for _, some in _chunks(texts):
                owner, runs = LineKeys(some).shingles()
                n.append(np.bincount(owner, minlength=len(some)))
                marks.append(sketches(owner, runs, len(some)))
            if n:
                marks = np.concatenate(marks)
                offsets = (np.arange(len(marks) + 1) * marks.itemsize * marks.shape[1]).astype(np.int32)
                packed = pa.Array.from_buffers(pa.binary(), len(marks), [None, pa.py_buffer(offsets), pa.py_buffer(marks)])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(n)), packed], ["line", "s", "n", "sketch"])

    return lines.mapInArrow(run, "line long, s string, n long, sketch binary")


def _hopeful(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of whole tasks by shingles the lines with a partner that may be alike, as far as sizes and sketches tell.  If there are
    few such pairs in a task, each becomes a task of its own, the same whichever key the pair met in."""
    place, line = pdf[["key", "lo", "hi"]].values, pdf["line"].values
    group = np.r_[0, np.cumsum((place[1:] != place[:-1]).any(1))]
    side, cross, n = (pdf["c"] == pdf["lo"]).values, (pdf["lo"] != pdf["hi"]).values, pdf["n"].values
    marks = np.frombuffer(b"".join(pdf["sketch"].tolist()), np.uint64).reshape(len(pdf), -1)
    x, y = small_pairs(group, FEW)
    near = may_be_alike(n, marks, x, y) & ~(cross[x] & (side[x] == side[y]))
    pairs, rows = [np.c_[x[near], y[near]]], []
    for g in np.flatnonzero(np.bincount(group) > FEW).tolist():
        lo, hi = np.searchsorted(group, [g, g + 1])
        here = np.arange(lo, hi)
        left, right = (here[side[lo:hi]], here[~side[lo:hi]]) if cross[lo] else (here, here)
        found = [np.zeros((0, 2), np.int64)]
        step = max(1, (1 << 18) // max(1, len(right)))
        for k in range(0, len(left), step):
            a, b = (z.ravel() for z in np.meshgrid(left[k:k + step], right, indexing="ij"))
            if not cross[lo]:
                a, b = a[a < b], b[a < b]
            near = may_be_alike(n, marks, a, b)
            found.append(np.c_[a[near], b[near]])
        found = np.concatenate(found)
        if len(found) <= 2 * len(here):
            pairs.append(found)
        else:
            rows.append(np.unique(found))
    a, b = np.sort(line[np.concatenate(pairs)], 1).T
    alone = np.unique(np.c_[a, b], axis=0)
    a, b = alone.T
    key = pair_keys(a, b).view(np.int64) | 1
    out = pd.DataFrame({"line": np.r_[a, b], "own": True, "key": np.r_[key, key], "lo": 0, "hi": 0, "c": 0})
    kept = pdf.iloc[np.concatenate([np.zeros(0, np.int64), *rows])][list(out.columns)]
    return pd.concat([out, kept], ignore_index=True).astype({"lo": "int32", "hi": "int32", "c": "int32"})


def _links(pdf: pd.DataFrame, most: int) -> pd.DataFrame:
    """Links (a, b) of the lines in whole tasks ``pdf``."""
    runs, own = (pdf["key"].values & 1) == 1, pdf["own"].values
    side, cross = (pdf["c"] == pdf["lo"]).values, (pdf["lo"] != pdf["hi"]).values
    place = pdf[["key", "lo", "hi"]].values
    group = np.r_[0, np.cumsum((place[1:] != place[:-1]).any(1))]
    ids, at = np.unique(pdf["line"].values, return_inverse=True)
    texts = dict(zip(pdf["line"].tolist(), pdf["s"].tolist()))
    made = _sets(pdf[runs])
    sets, lines = [made.get(i, np.zeros(0, np.uint64)) for i in ids.tolist()], [texts[i] for i in ids.tolist()]
    out = [np.zeros((0, 2), np.int64)]
    # few lines that meet: their pairs, each once; a probe meets a segment, two probes that meet only each other need no look
    x, y = small_pairs(group, FEW)
    look = (own[x] | own[y]) & ~(cross[x] & (side[x] == side[y]))
    x, y = x[look], y[look]
    for kind, test in ((runs[x], lambda *p: pairs_alike(sets, *p)), (~runs[x], lambda *p: pairs_within(lines, *p, most))):
        pairs = np.unique(np.sort(np.c_[at[x[kind]], at[y[kind]]], 1), axis=0)
        if len(pairs):
            out.append(pairs[test(pairs[:, 0], pairs[:, 1])])
    # many: lines already connected are not compared
    for g in np.flatnonzero(np.bincount(group) > FEW).tolist():
        lo, hi = np.searchsorted(group, [g, g + 1])
        here, mine, first = at[lo:hi], own[lo:hi], side[lo:hi]
        what = [(sets if runs[lo] else lines)[k] for k in here.tolist()]
        for query, index in ((first, ~first & mine), (~first, first & mine)) if cross[lo] else ((np.ones(hi - lo, bool), mine),):
            links = alike(what, query, index) if runs[lo] else linked(what, query, index, most)
            out.append(here[np.array(links, np.int64).reshape(-1, 2)])
    links = ids[np.concatenate(out)]
    return pd.DataFrame({"a": links[:, 0], "b": links[:, 1]})


def similar_lines(texts: DataFrame, most: int = MAX_EDITS, min_chars: int = MIN_SIMILAR, chunk: int = CHUNK) -> DataFrame:
    """Links (a, b) of line ids (``hi`` without its lowest bit) whose components are those of all lines within ``most``
    edits or alike in their word shingles.  A key that many lines meet in is cut into chunks, each pair of chunks verified by itself.
    Most lines that meet in a shingle have little else in common; what their sizes and sketches rule out goes without its text."""
    meet = _meetings(texts, min_chars, most)
    sizes = stored(_different(meet).withColumn("chunks", F.ceil(F.col("n") / chunk).cast("int")), "line-sets")
    once = stored(meet.join(sizes, "key"), "line-tasks")
    discard(meet)
    tasks = (once.withColumn("c", F.pmod(F.xxhash64("line"), F.col("chunks")).cast("int"))
             .withColumn("d", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select("line", "own", "key", F.least("c", "d").alias("lo"), F.greatest("c", "d").alias("hi"), "c"))
    lines = stored(_sketched(_fetched(texts, once.select("line").distinct(), min_chars)), "lines")
    n, place = partitions_for(texts.sparkSession), ["key", "lo", "hi"]
    runs = F.col("key").bitwiseAND(F.lit(1)) == 1
    hopeful = (tasks.filter(runs).join(lines.select("line", "n", "sketch"), "line").repartition(n, *place).sortWithinPartitions(*place)
               .mapInPandas(lambda frames: _by_task(frames, _hopeful), "line long, own boolean, key long, lo int, hi int, c int"))
    left = stored(hopeful.distinct().unionByName(tasks.filter(~runs)), "line-tasks")
    links = stored(left.join(lines.select("line", "s"), "line").repartition(n, *place).sortWithinPartitions(*place)
                   .mapInPandas(lambda frames: _by_task(frames, lambda pdf: _links(pdf, most)), "a long, b long").distinct(), "line-links")
    discard(once, sizes, lines, left)
    return links


def dedup_lines(docs: DataFrame, most: int = MAX_EDITS, min_exact: int = MIN_EXACT, min_similar: int = MIN_SIMILAR) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) with repeated lines taken out of ``text``, and the new columns
    ``lines_before`` and ``lines_removed``.

    A line goes if an equal one, or one within ``most`` edits (directly or over others), stands earlier: in a document with
    a smaller doc_id or further up in the same.  Lines of 20 words or more also count as similar if they share four fifths
    of their 5-word shingles, so that the edits allowed grow with the line.  White space at a line's ends is ignored; lines below ``min_exact``
    characters always stay, and below ``min_similar`` only equal lines count.  No row is dropped: a text of which
    nothing is new becomes empty.  Null text stays null and has no lines; null ids come after all others; rows alike
    in id and text are one document and keep the same lines.  An empty table gives an empty result."""
    prepared(docs.sparkSession)
    texts = _texts(docs)
    seen = stored(occurrences(texts, min_exact), "line-occurrences")
    node = F.col("hi").bitwiseAND(F.lit(~1))
    place = F.struct("id", "line", "mark")
    firsts = stored(seen.groupBy("hi", "lo").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times"))
                    .withColumn("node", node), "line-classes")
    different = stored(_first_lines(texts, firsts, min_similar), "different-lines")
    joined = stored(connected_components(similar_lines(different, most, min_similar)), "line-components")
    discard(different)
    grouped = firsts.join(joined, "node")
    winners = grouped.groupBy("component").agg(F.min("first").alias("winner"))
    near = grouped.join(winners, "component").select("hi", "lo", "winner")
    equal = firsts.filter("times > 1").join(joined, "node", "left_anti").select("hi", "lo", F.col("first").alias("winner"))
    gone = (seen.join(equal.unionByName(near), ["hi", "lo"])
            .filter((F.col("id") != F.col("winner.id")) | (F.col("line") != F.col("winner.line")) | (F.col("mark") != F.col("winner.mark")))
            .groupBy("id", "mark").agg(F.collect_set("line").alias("gone")))
    gone = stored(gone, "line-gone")
    discard(seen, firsts, joined)
    old = [c for c in docs.columns if c not in ("lines_before", "lines_removed")]
    t = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("i"), F.xxhash64(t).alias("m"),
                       F.col("text").cast("string").alias("t"), F.struct(*[c for c in old if c != "text"]).alias("row"))
    out = rows.join(gone, (F.col("i") == F.col("id")) & (F.col("m") == F.col("mark")), "left")
    lines = F.split(F.col("t"), "\n", -1)
    left = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("gone", i)), "\n")
    text = F.when(F.col("gone").isNull(), F.col("t")).otherwise(left)
    return out.select(*[text.alias("text") if c == "text" else F.col("row").getField(c).alias(c) for c in old],
                      F.coalesce(F.size(lines), F.lit(0)).alias("lines_before"),
                      F.coalesce(F.size("gone"), F.lit(0)).alias("lines_removed"))
