"""Operator 6: toxicity by a learned lexicon, matched with Levenshtein automata, weighed by context.

From a bounded sample of labelled rows the words that mark toxic texts are learned, then how much a hit says: by term,
by whether it is spelled exactly, and by its context window, which tells quotation from abuse.  Scoring is one pass over
all texts without a shuffle; what goes to the tasks is the lexicon and its weights, all terms of the bounded sample."""

from __future__ import annotations

import re
from bisect import bisect
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import in_slices, prepared, stored
from .levenshtein import FuzzyLexicon

MAX_TRAIN = 24_000
#: A term stands between at least so many different pairs of neighbours in toxic texts (copies of one text are one context),
#: has at least these log odds, and is so uneven (twice the log likelihood ratio) as a word is once in a million by chance.
MIN_CONTEXTS, MIN_ODDS, MIN_UNEVEN = 3, 2.5, 24.0
CACHE_WORDS = 200_000
#: Quotation marks by what closes them; those that also close another's are told by what is open.
CLOSED_BY = {'"': '"', "«": "»", "»": "«", "“": "”", "”": "”", "„": "“”", "‘": "’", "‚": "‘’"}
MARKS = re.compile("[\"«»“”„‘’‚]|\\n\\s*\\n")
# Words that report or name another's words.
REPORTING = frozenset("said says saying called calls wrote writes quote quoted quoting quotes word words term insult insults "
                      "slur slurs reported allegedly named sagte nannte zitat wort dit disait citation mot dijo cita palabra".split())
WORD, PART = re.compile(r"\S+"), re.compile(r"[^\W_]+")


@dataclass
class Model:
    terms: list[str] = field(default_factory=list)
    weights: np.ndarray = None  # by term: spelled exactly, misspelled
    coef: np.ndarray = None     # bias, hits used, hits quoted, strongest hit


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """(t, y) of labelled rows outside the held-out fifth, at most about ``limit`` of them, chosen by hash of the id.

    The bound makes the chosen ids small enough to go to every task, so no text is moved to find its label."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).filter(
        f"doc_id is not null and y in (0, 1) and crc32(cast(doc_id as string)) % 5 <> 0").groupBy("doc_id").agg(F.max("y").alias("y"))
    n = known.count()
    part = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1e6 * min(1.0, limit / max(1, n))))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    return texts.join(F.broadcast(part), "doc_id").select("t", "y")


def learn_terms(train: DataFrame) -> list[str]:
    """Words far more frequent in toxic than in clean training texts, strongest first."""
    both = train.agg(F.sum("y"), F.count(F.lit(1))).first()
    toxic, clean = both[0] or 0, both[1] - (both[0] or 0)
    if not toxic or not clean:
        return []
    words = train.select("y", F.filter(F.split(F.lower("t"), r"[^\p{L}\p{N}]+"), lambda w: w != "").alias("ws"))
    docs = words.select("y", F.explode(F.array_distinct("ws")).alias("w")).groupBy("w").agg(
        F.sum("y").alias("p"), F.count(F.lit(1)).alias("n"))
    between = F.transform("ws", lambda w, i: F.struct(w.alias("w"), F.xxhash64(F.get("ws", i - 1), F.get("ws", i + 1)).alias("c")))
    contexts = words.filter("y = 1").select(F.inline(between)).groupBy("w").agg(F.count_distinct("c").alias("contexts"))
    odds = F.log((F.col("p") + 0.5) / toxic) - F.log((F.col("n") - F.col("p") + 2.0) / clean)
    # toxic texts with the word, copies aside, and clean ones, against what their numbers lead to expect
    p, c = F.least("p", "contexts"), F.col("n") - F.col("p")
    share = toxic / (toxic + clean)
    uneven = 2 * (p * F.log(p / ((p + c) * F.lit(share))) + F.when(c > 0, c * F.log(c / ((p + c) * F.lit(1 - share)))).otherwise(0.0))
    found = (contexts.filter(F.col("contexts") >= MIN_CONTEXTS).join(docs, "w")
             .withColumn("o", odds).filter((F.col("o") >= MIN_ODDS) & (uneven >= MIN_UNEVEN)))
    return [r.w for r in found.select("w", "o").orderBy(F.desc("o"), "w").collect()]


class _Words(dict):
    """What stands between white space -> its hits (edits, term, place in it); forgets all when full.  Cut like the words that
    terms are learned from; if no part is a hit, the parts joined may be one."""

    def __init__(self, lexicon: FuzzyLexicon):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str):
        if len(self) >= CACHE_WORDS:
            self.clear()
        parts = list(PART.finditer(word))
        hits = [(*hit, m.start()) for m in parts if (hit := self.lexicon.match(m[0]))]
        if not hits and len(parts) > 1 and (hit := self.lexicon.match("".join(m[0] for m in parts))):
            hits = [(*hit, parts[0].start())]
        hits = self[word] = tuple(hits)
        return hits


def quotations(text: str) -> list[tuple[int, int]]:
    """(begin, end) of what stands between an opening mark and the mark that closes it, within a paragraph, in order and
    without what lies in another.  A mark between letters is an apostrophe."""
    found, opened = [], []
    for m in MARKS.finditer(text):
        c, at = m[0], m.start()
        before, after = text[at - 1:at], text[at + 1:at + 2]
        if c[0] == "\n":
            opened = []
        elif c in "‘’" and before.isalnum() and after.isalnum():
            continue
        else:
            k = next((k for k in range(len(opened) - 1, -1, -1) if c in CLOSED_BY[opened[k][0]]), -1)
            starts = c == '"' and (not before or before.isspace()) and after and not after.isspace()
            if k >= 0 and not starts:
                while found and found[-1][0] > opened[k][1]:
                    found.pop()
                found.append((opened[k][1], at))
                del opened[k:]
            elif c in CLOSED_BY and after and (c in "«“„‘‚" or not before.isalnum() and not after.isspace()):
                opened = [*(opened[:k] if k >= 0 else opened), (c, at)]
    return found


def hits_of(text: str, known: _Words) -> list[tuple[int, int, bool]]:
    """(edits, term, quoted) of each hit.  Quoted: between an opening quotation mark and its closing one, or a reporting
    word before it."""
    text = text.lower()
    words = text.split()
    if not any(known[w] for w in words):
        return []
    found, spans = [], quotations(text)
    for i, m in enumerate(WORD.finditer(text)):
        for edits, term, place in known[m[0]]:
            at = m.start() + place
            k = bisect(spans, (at,)) - 1
            quoted = k >= 0 and at < spans[k][1] or not REPORTING.isdisjoint(words[max(0, i - 3):i])
            found.append((edits, term, quoted))
    return found


def features(hits, weights: np.ndarray) -> tuple[float, float, float]:
    """Summed weights of distinct hits in use and in quotation (one hit a term and kind), and the strongest weight."""
    used, quoted, top = {}, {}, 0.0
    for edits, term, q in hits:
        w = float(weights[term, min(edits, 1)])
        (quoted if q else used)[term, min(edits, 1)] = w
        if not q:
            top = max(top, w)
    return sum(used.values()), sum(quoted.values()), top


def fit(terms: list[str], hits: list[list[tuple[int, int, bool]]], y: np.ndarray) -> Model:
    """Weights by term and spelling from document counts, then a logistic regression with priors over the features."""
    counts = np.zeros((len(terms), 2, 2))
    for h, label in zip(hits, y):
        for term, kind in {(t, min(e, 1)) for e, t, _ in h}:
            counts[term, kind, label] += 1
    n = np.maximum(np.bincount(y, minlength=2), 1)
    told = lambda c: np.log((c[..., 1] + 0.1) / n[1]) - np.log((c[..., 0] + 0.5) / n[0])
    usual = np.maximum(0.0, told(counts.sum(0)))
    weights = told(counts)
    # a spelling not seen is as telling as such spellings are on the whole, at most half as telling as the term
    weights = np.maximum(0.0, np.where(counts.sum(2) == 0, np.minimum(usual, weights[:, :1] * 0.5), weights))

    def without_own(h, label):  # so that a term that only this text has does not vouch for itself
        own = weights.copy() if h else weights
        for term, kind in {(t, min(e, 1)) for e, t, _ in h}:
            c = counts[term, kind].copy()
            c[label] -= 1
            own[term, kind] = max(0.0, told(c)) if c.sum() else 0.0
        return own

    x = np.array([(1.0, *features(h, without_own(h, label))) for h, label in zip(hits, y)])
    prior, strength = np.array([-2.0, 0.8, 0.2, 0.3]), np.array([1e-3, 1.0, 1.0, 1.0])

    def loss(b):
        z = x @ b
        return np.logaddexp(0, np.where(y == 1, -z, z)).sum() + 0.5 * (strength * (b - prior) ** 2).sum()

    b = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(strength),
                               x.T @ (p - y) + strength * (b - prior))
        size = 1.0
        while size > 1e-4 and loss(b - size * step) > loss(b):
            size /= 2
        b = b - size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return Model(terms, weights, b)


def _scan(df: DataFrame, text_col: str, make, new: T.StructField) -> DataFrame:
    """``df`` with the column ``new``, made of the text column by ``make() -> (texts -> Arrow array)``; texts travel once."""
    at = df.columns.index(text_col)
    names = [*df.columns, new.name]

    def run(batches):
        import pyarrow as pa
        work = make()
        for batch in in_slices(batches, 500):
            made = work([t or "" for t in batch.column(at).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names)

    return df.mapInArrow(run, T.StructType([*df.schema.fields, new]))


def train_toxicity(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """A model from at most about ``max_train`` labelled rows.  Without both classes every score is low."""
    prepared(docs.sparkSession)
    train = stored(labelled_sample(docs, labels, "toxic", max_train), "toxic-train")
    terms = learn_terms(train)
    if not terms:
        return Model([], np.zeros((0, 2)), np.array([-5.0, 0.8, 0.2, 0.3]))
    words = docs.sparkSession.sparkContext.broadcast(terms)

    def make():
        import pyarrow as pa
        known = _Words(FuzzyLexicon(words.value))
        return lambda texts: pa.array([sorted(e * 2_000_000 + t * 2 + q for e, t, q in set(hits_of(x, known))) for x in texts],
                                      pa.list_(pa.int64()))

    hits = T.StructField("hits", T.ArrayType(T.LongType()))
    rows = _scan(train.select("y", "t"), "t", make, hits).select("y", "hits").collect()  # bounded by max_train
    hits = [[(h // 2_000_000, h % 2_000_000 // 2, bool(h % 2)) for h in r.hits] for r in rows]
    return fit(terms, hits, np.array([r.y for r in rows]))


def score_toxicity(docs: DataFrame, model: Model, text_col: str = "text", name: str = "toxicity") -> DataFrame:
    """``docs`` with the model's probability in the new column ``name`` (an old one of that name goes), rows otherwise as
    they are.

    Null and empty texts have no hit and so the score of a text without one."""
    spark = docs.sparkSession
    prepared(spark)
    shared = spark.sparkContext.broadcast(model)

    def make():
        import pyarrow as pa
        m = shared.value
        known = _Words(FuzzyLexicon(m.terms))

        def work(texts):
            x = np.array([(1.0, *features(hits_of(t, known), m.weights)) for t in texts])
            return pa.array(1 / (1 + np.exp(-np.clip(x @ m.coef, -30, 30))), pa.float64())

        return work

    plain = docs.drop(name).withColumn(text_col, F.col(text_col).cast("string"))
    return _scan(plain, text_col, make, T.StructField(name, T.DoubleType()))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """The rows of ``docs`` with a toxicity below ``threshold``, unchanged."""
    model = train_toxicity(docs, labels, **options)
    rows = docs.select("text", F.struct(*[c for c in docs.columns if c != "text"]).alias("row"))
    kept = score_toxicity(rows, model).filter(F.col("toxicity") < threshold)
    return kept.select(*[F.col(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])
