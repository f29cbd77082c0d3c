"""Operator 1: quality classifier on random-indexing word vectors.

Every word and word shape has a slot and a fixed sparse index vector; its word vector is the sum of the index vectors of
its neighbours over the whole corpus.  The slots are a hash space of fixed size, so the sums, their shuffle and what
goes to the tasks are bounded however many words there are.  A document is pooled from its words' vectors (mean, spread,
step from word to word), and a two-layer network with calibrated temperature turns that into a probability."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import in_slices, prepared, stored
from .toxicity import labelled_sample

WORDS, SHAPES, DIM, ONES, WINDOW = 8192, 512, 32, 4, 2
SLOTS = WORDS + SHAPES
CACHE_WORDS, BLOCKS, FAN_IN, MAX_TRAIN = 200_000, 16, 256, 24_000
STRIDE = 1 << 18  # tokens worked on at once
_EDGE = re.compile(r"^(\W*)(.*?)(\W*)$", re.S)


def index_vectors() -> np.ndarray:
    """``ONES`` entries of +1 or -1 in each slot's row, the same in every task."""
    rng = np.random.default_rng(20_241)
    r = np.zeros((SLOTS, DIM), np.int32)
    for row in r:
        row[rng.choice(DIM, ONES, replace=False)] = rng.choice((-1, 1), ONES)
    return r


class _Slots(dict):
    """Blank-separated word -> word slot * SHAPES + shape slot; forgets all when full."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        head, core, tail = _EDGE.match(word).groups()
        case = "0" if core[:1].isdigit() else "A" if len(core) > 1 and core.isupper() else "a"
        shape = f"{head[:4]}{case if core else ''}{min(len(core), 20) // 5}{tail[:4]}"
        code = self[word] = (zlib.crc32(core.lower().encode()) % WORDS) * SHAPES + zlib.crc32(shape.encode()) % SHAPES
        return code


def _codes(text: str, slots: _Slots) -> np.ndarray:
    words = text.split()
    return np.fromiter(map(slots.__getitem__, words), np.int32, len(words))


def _contexts(codes: np.ndarray, index: np.ndarray, sums: np.ndarray) -> None:
    """Add the neighbours' index vectors of a text to its words' and shapes' rows of ``sums``."""
    for at in range(0, len(codes), STRIDE):
        lo = max(0, at - WINDOW)
        part = codes[lo:at + STRIDE + WINDOW]
        word, shape = np.where(part < 0, SLOTS, part // SHAPES), np.where(part < 0, SLOTS, WORDS + part % SHAPES)
        own = index[word] + index[shape]
        total = np.zeros_like(own)
        for k in range(1, WINDOW + 1):
            total[k:] += own[:-k]
            total[:-k] += own[k:]
        mine = slice(at - lo, at - lo + min(STRIDE, len(codes) - at))
        for target in (word[mine], shape[mine]):
            order = np.argsort(target, kind="stable")
            ids, first = np.unique(target[order], return_index=True)
            sums[ids] += np.add.reduceat(total[mine][order], first, axis=0)


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Random-indexing vectors of all slots from every row of ``docs``, centred and scaled to unit length."""
    prepared(docs.sparkSession)
    rows = SLOTS // BLOCKS

    def count(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        slots, held, size = _Slots(), [], 0
        # texts are kept apart by words of a slot of their own, with an index vector of zeros
        index, sums = np.zeros((SLOTS + 1, DIM), np.int32), np.zeros((SLOTS + 1, DIM), np.int64)
        index[:SLOTS] = index_vectors()
        gap = np.full(WINDOW, -1, np.int32)

        for batch in in_slices(batches):
            for t in batch.column(0).to_pylist():
                if t:
                    codes = _codes(t, slots)
                    held += [codes, gap]
                    size += len(codes)
                    if size > STRIDE:
                        _contexts(np.concatenate(held), index, sums)
                        held, size = [], 0
        if held:
            _contexts(np.concatenate(held), index, sums)
        sums = sums[:SLOTS]
        if sums.any():
            part = TaskContext.get().partitionId()
            blobs = [sums[b * rows:(b + 1) * rows].tobytes() for b in range(BLOCKS)]
            yield pa.RecordBatch.from_arrays([pa.array(range(BLOCKS), pa.int32()), pa.array([part % FAN_IN] * BLOCKS, pa.int32()),
                                              pa.array(blobs, pa.binary())], ["block", "part", "sums"])

    def add(keys: list[str]):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            total = sum(np.frombuffer(b, np.int64) for b in pdf.sums)
            return pd.DataFrame({"block": pdf.block.iloc[:1], "part": pdf["part"].iloc[:1], "sums": [total.tobytes()]})
        return lambda df: df.groupBy(*keys).applyInPandas(run, "block int, part int, sums binary")

    parts = docs.select(F.col(text_col).cast("string").alias("t")).mapInArrow(count, "block int, part int, sums binary")
    total = np.zeros((SLOTS, DIM))
    for r in add(["block"])(add(["block", "part"])(parts)).collect():  # SLOTS x DIM numbers, whatever the corpus
        total[r.block * rows:(r.block + 1) * rows] = np.frombuffer(r.sums, np.int64).reshape(rows, DIM)
    size = np.linalg.norm(total, axis=1, keepdims=True)
    unit = total / np.maximum(size, 1e-9)
    unit -= (unit * np.log1p(size)).sum(0) / max(1e-9, np.log1p(size).sum())
    return (unit / np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-9)).astype(np.float32)


FEATURES = 5 * DIM + 2


def pooled(text: str, slots: _Slots, vectors: np.ndarray) -> np.ndarray:
    """A document's features: mean and spread of its words' and shapes' vectors, mean step between neighbours, share of
    steps that are none, and length.  All zeros without words."""
    out = np.zeros(FEATURES, np.float32)
    codes = _codes(text, slots)
    n = len(codes)
    if not n:
        return out
    s, q, step, still = np.zeros(2 * DIM), np.zeros(2 * DIM), np.zeros(DIM), 0
    for at in range(0, n, STRIDE):
        part = codes[at:at + STRIDE + 1]
        v = np.concatenate([vectors[part // SHAPES], vectors[WORDS + part % SHAPES]], 1)
        d = np.abs(v[1:, :DIM] - v[:-1, :DIM])
        step += d.sum(0)
        still += int((part[1:] == part[:-1]).sum())
        v = v[:STRIDE]
        s += v.sum(0, dtype=np.float64)
        q += (v * v).sum(0, dtype=np.float64)
    out[:2 * DIM] = s / n
    out[2 * DIM:4 * DIM] = np.sqrt(np.maximum(0, q / n - (s / n) ** 2 - 1e-5))  # less than rounding is no spread
    out[4 * DIM:5 * DIM] = step / max(1, n - 1)
    out[5 * DIM:] = still / max(1, n - 1), np.log1p(n)
    return out


@dataclass
class Network:
    """Two layers over standardised features; ``temperature`` divides the logit."""
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum(0, ((x - self.mean) / self.scale) @ self.w1 + self.b1)
        return h @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def train_network(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, seed: int = 5) -> Network:
    """Adam on the cross-entropy; a fifth of the rows picks the best epoch and then the temperature."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    held, used = order[:len(x) // 5], order[len(x) // 5:]
    if not len(held):
        held = used
    mean, scale = x[used].mean(0), x[used].std(0) + 1e-3
    net = Network(mean, scale, rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden),
                  rng.normal(0, 0.1, hidden), float(np.log((y[used].mean() + 1e-3) / (1 - y[used].mean() + 1e-3))))
    z = (x - mean) / scale
    weights = [net.w1, net.b1, net.w2, np.array([net.b2])]
    m, v, t = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    nll = lambda logit, label: float(np.logaddexp(0, np.where(label == 1, -logit, logit)).mean())
    best, kept = np.inf, [w.copy() for w in weights]
    for _ in range(epochs):
        for at in np.array_split(rng.permutation(used), max(1, len(used) // 128)):
            a = z[at] @ weights[0] + weights[1]
            h = np.maximum(0, a)
            e = (1 / (1 + np.exp(-np.clip(h @ weights[2] + weights[3][0], -30, 30))) - y[at]) / len(at)
            back = np.outer(e, weights[2]) * (a > 0)
            grads = [z[at].T @ back + 1e-4 * weights[0], back.sum(0), h.T @ e, np.array([e.sum()])]
            t += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                weights[i] -= 0.003 * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
        now = nll(np.maximum(0, z[held] @ weights[0] + weights[1]) @ weights[2] + weights[3][0], y[held])
        if now < best:
            best, kept = now, [w.copy() for w in weights]
    net.w1, net.b1, net.w2, net.b2 = kept[0], kept[1], kept[2], float(kept[3][0])
    logit = net.logits(x[held])
    net.temperature = min(np.exp(np.linspace(-1.5, 2.5, 81)), key=lambda k: nll(logit / k, y[held]))
    return net


@dataclass
class Classifier:
    vectors: np.ndarray
    network: Network | None
    usual: float  # the score where no network could be trained


def train_quality(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Classifier:
    """Word vectors from all of ``docs``; the network from at most about ``max_train`` labelled rows outside the held-out
    fifth.  With one class only, every score is that class's share."""
    spark = docs.sparkSession
    vectors = word_vectors(docs)
    shared = spark.sparkContext.broadcast(vectors)
    train = stored(labelled_sample(docs, labels, "quality", max_train), "quality-train")

    def run(batches):
        import pyarrow as pa
        slots = _Slots()
        for batch in in_slices(batches):
            x = [pooled(t, slots, shared.value).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.binary())], ["y", "x"])

    rows = train.select("y", "t").mapInArrow(run, "y int, x binary").collect()  # bounded by max_train
    y = np.array([r.y for r in rows], np.float64)
    if len(set(y)) < 2:
        return Classifier(vectors, None, float(y.mean()) if len(y) else 0.5)
    x = np.array([np.frombuffer(r.x, np.float32) for r in rows], np.float64)
    order = np.lexsort((*x.T[:3], y))  # the same network whatever the order the rows came in
    return Classifier(vectors, train_network(x[order], y[order]), float(y.mean()))


def score_quality(docs: DataFrame, model: Classifier, text_col: str = "text", name: str = "quality") -> DataFrame:
    """``docs`` with the probability of good quality in the new column ``name`` (an old one of that name goes), rows
    otherwise as they are.  Null and empty texts are scored as a text without words."""
    spark = docs.sparkSession
    prepared(spark)
    shared = spark.sparkContext.broadcast(model)
    plain = docs.drop(name).withColumn(text_col, F.col(text_col).cast("string"))
    names, at = [*plain.columns, name], plain.columns.index(text_col)

    def run(batches):
        import pyarrow as pa
        slots, m = _Slots(), shared.value
        for batch in in_slices(batches):
            if m.network is None:
                p = np.full(batch.num_rows, m.usual)
            else:
                p = m.network.probability(np.array([pooled(t or "", slots, m.vectors) for t in batch.column(at).to_pylist()]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p, pa.float64())], names)

    return plain.mapInArrow(run, T.StructType([*plain.schema.fields, T.StructField(name, T.DoubleType())]))
