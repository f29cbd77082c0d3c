"""Operator 11: phrase collocations by best-first branch-and-bound growth.

A phrase's score is its lowest over all cuts into a first part and a rest; at the cut after k words it is at most
1000 n / f(first k words), whatever follows.  So no phrase that starts with a word w scores above 1000 n / f(w).  Words are
expanded best bound first, a block at a time: all frequent phrases that start with them are grown word by word, a pass over
the texts, cut into words and numbered once, for each length.  After each block the ``top``-th score among the surviving phrases of a language is a floor:
words whose bound is below it are never expanded.  The search ends when no language has a word left at or above its
floor, so that ties are settled too."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, prepared, stored
from .hot_keys import lookup
from .phrase_counts import LEAST_BITS, MOST_BITS, counted_numbers, counted_words, marked, numbered_words

MIN_COUNT, LONGEST, TOP = 100, 5, 2000
#: Words of a first block hold so large a share of a language's text; each further block may hold twice as much.
FIRST_SHARE = 0.25
SLOT = 32768
COUNTS = "lang string, phrase string, a long, least long, most long"
#: Exact: 1000 * a * n and l * r pass 64 bits.
BIG = "decimal(38,0)"


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("t"))


def _bitmap(phrases: DataFrame) -> np.ndarray:
    """A bitmap of the phrases' hashes, sized by their number up to 16 MB (a fuller one only lets more phrases through)."""
    n = phrases.count()
    bits = min(max(LEAST_BITS, 1 << (32 * n).bit_length()), MOST_BITS)
    spots = phrases.select("lang", "phrase").mapInArrow(marked(bits), "at long")
    maps = (spots.select(F.floor(F.col("at") / SLOT).alias("slot"), (F.col("at") % SLOT).alias("bit")).groupBy("slot")
            .agg(F.bitmap_construct_agg("bit").alias("bits")).collect())  # at most MOST_BITS bits
    out = np.zeros(bits // 8, np.uint8)
    for r in maps:
        b = np.frombuffer(bytes(r.bits), np.uint8)
        out[r.slot * SLOT // 8:][:len(b)] = b[:bits // 8]
    return out


def _numbered(texts: DataFrame, common: np.ndarray) -> DataFrame:
    """(lang, names, codes): the frequent words of the texts as numbers, a buffer a row; no other word is in a candidate."""
    common = texts.sparkSession.sparkContext.broadcast(common)

    def run(batches):
        yield from numbered_words(batches, common.value)

    return texts.mapInArrow(run, "lang string, names binary, codes binary")


def _counted(texts: DataFrame, chain: np.ndarray, common, lengths: range) -> DataFrame:
    """(lang, phrase, a, least, most) over all ``_numbered`` texts; what to look for travels as two bitmaps of at most 16 MB."""
    sc = texts.sparkSession.sparkContext
    chain, common = sc.broadcast(chain), common if common is None else sc.broadcast(common)

    def run(batches):
        yield from counted_numbers(batches, chain.value, common and common.value, lengths)

    return (texts.mapInArrow(run, COUNTS).groupBy("lang", "phrase")
            .agg(F.sum("a").alias("a"), F.min("least").alias("least"), F.max("most").alias("most")))


def _part(words):
    """The first so many words of ``phrase``, or the last if negative."""
    return F.call_function("substring_index", F.col("phrase"), F.lit(" "), words)


def _score(l: str, r: str):
    big = {c: F.col(c).cast(BIG) for c in ("a", "n", l, r)}
    return F.call_function("div", F.lit(1000).cast(BIG) * big["a"] * big["n"], big[l] * big[r])


class Search:
    """The growing tables of one search, all in the shared folder."""

    def __init__(self, docs: DataFrame, min_count: int, longest: int, top: int):
        self.texts, self.min_count, self.longest, self.top = _texts(docs), min_count, longest, top
        counts = (self.texts.mapInArrow(counted_words, COUNTS).groupBy("lang", "phrase").agg(F.sum("a").alias("a"))
                  .filter((F.col("a") >= min_count) | (F.col("phrase") == "")))
        self.words = stored(counts, "phrase-words")
        frequent = self.words.filter("phrase <> ''")
        sizes = frequent.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
        #: floor: the top-th score so far (0: fewer); done: words up to this count are expanded
        self.langs = stored(self.words.filter("phrase = ''").select("lang", F.col("a").alias("n")).join(sizes, "lang")
                            .withColumn("floor", F.lit(0).cast("long")).withColumn("done", F.lit(0).cast("long")), "phrase-langs")
        self.frequent = frequent.select("lang", "phrase", "a")
        self.common = _bitmap(self.frequent)
        self.numbered = stored(_numbered(self.texts, self.common), "phrase-texts")
        self.counts = [self.frequent]  # every phrase counted so far, with its count
        self.best: DataFrame | None = None

    def block(self, share: float) -> DataFrame | None:
        """The next words to expand, those with the best bounds; None if no word can reach its language's floor."""
        bound = F.floor(F.lit(1000).cast(BIG) * F.col("n") / F.col("a"))
        ahead = lookup(self.frequent, self.langs, "lang", "rows").filter((F.col("a") > F.col("done")) & (bound >= F.col("floor")))
        # bounds fall as counts rise; a window over the powers of two of a language's counts
        steps = ahead.groupBy("lang", "n", F.floor(F.log2("a")).alias("step")).agg(F.sum("a").alias("mass"))
        earlier = F.sum("mass").over(Window.partitionBy("lang").orderBy("step").rowsBetween(Window.unboundedPreceding, -1))
        cuts = (steps.withColumn("earlier", F.coalesce(earlier, F.lit(0))).filter(F.col("earlier") < F.lit(share) * F.col("n"))
                .groupBy("lang").agg(F.max("step").alias("step")))
        cuts = stored(cuts.select("lang", F.pow(F.lit(2.0), F.col("step") + 1).cast("long").alias("cut")), "phrase-cuts")
        if cuts.isEmpty():
            return None
        marks = self.langs.join(cuts, "lang")
        words = (lookup(self.frequent, marks, "lang", "rows")
                 .filter((F.col("a") > F.col("done")) & (F.col("a") < F.col("cut")) & (bound >= F.col("floor"))))
        words = stored(words.select("lang", "phrase", "a"), "phrase-block")
        self.cuts = cuts
        return words

    def grow(self, words: DataFrame) -> list[DataFrame]:
        """Tables of the frequent phrases of 2, 3, ... words that start with ``words``."""
        chain, parents, levels = _bitmap(words), words, []
        for size in range(2, self.longest + 1):
            found = _counted(self.numbered, chain, self.common, range(size, size + 1)).filter(F.col("a") >= self.min_count)
            # bitmaps also let through phrases that start with other words
            own = parents.select("lang", F.col("phrase").alias("start"))
            level = stored(found.withColumn("start", _part(F.lit(size - 1))).join(own, ["lang", "start"], "left_semi")
                           .select("lang", "phrase", "a", "least", "most", F.lit(size).alias("size")), "phrase-level")
            if level.isEmpty():
                break
            levels.append(level)
            if size < self.longest:
                new = _bitmap(level)
                small, large = sorted((chain, new), key=len)
                chain = np.tile(small, len(large) // len(small)) | large
            parents = level
        return levels

    def known(self) -> DataFrame:
        out = self.counts[0]
        for more in self.counts[1:]:
            out = out.unionByName(more.select("lang", "phrase", "a"))
        return out.dropDuplicates(["lang", "phrase"])  # a rest may have been counted before it was grown

    def scored(self, levels: list[DataFrame]) -> DataFrame:
        """The phrases of ``levels`` that survive and may reach the floor, with their lowest-scoring cut."""
        grown = levels[0]
        for level in levels[1:]:
            grown = grown.unionByName(level)
        self.counts += levels
        # a longer phrase as frequent: the same word before every occurrence, or a grown phrase that goes on
        alone = (F.col("size") == self.longest) | (F.col("least") != F.col("most")) | (F.col("least") == 0)
        longer = grown.filter("size > 2").select("lang", _part(F.col("size") - 1).alias("phrase"), "a")
        live = lookup(grown.filter(alone).join(longer, ["lang", "phrase", "a"], "left_anti"),
                      self.langs.select("lang", "n", "floor", "rows"), "lang", "rows")
        cuts = (live.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
                .withColumn("left", _part(F.col("k")))
                .withColumn("right", _part(F.col("k") - F.col("size"))))
        known = self.known()
        lefts = known.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l"))
        rights = known.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r"))
        cuts = stored(cuts.join(lefts, ["lang", "left"]).join(rights, ["lang", "right"], "left")
                      .withColumn("score", _score("l", "r")), "phrase-cuts")
        # a cut that is known bounds the score; only rests of phrases that still may count are counted on purpose
        bounds = cuts.groupBy("lang", "phrase", "floor").agg(F.min("score").alias("bound")).filter("bound >= floor")
        rests = (cuts.filter("r is null").join(bounds.select("lang", "phrase"), ["lang", "phrase"], "left_semi")
                 .select("lang", F.col("right").alias("phrase")).distinct())
        rests = stored(rests, "phrase-rests")
        if not rests.isEmpty():
            parts = F.transform(F.sequence(F.lit(1), F.size(F.split("phrase", " "))), _part)
            chain = _bitmap(rests.select("lang", F.explode(parts).alias("phrase")).distinct())
            found = _counted(self.numbered, chain, None, range(2, self.longest))
            found = stored(found.join(rests, ["lang", "phrase"], "left_semi").select("lang", "phrase", "a"), "phrase-rests")
            self.counts.append(found)
            late = found.select("lang", F.col("phrase").alias("right"), F.col("a").alias("late"))
            cuts = (cuts.join(late, ["lang", "right"], "left").withColumn("r", F.coalesce("r", "late"))
                    .withColumn("score", _score("l", "r")))
        # phrases with a rest still not counted lie below the floor
        lowest = cuts.groupBy("lang", "phrase", "a", "n").agg(
            F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.count_if(F.col("r").isNull()).alias("open"))
        return lowest.filter("open = 0").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")

    def settle(self, scored: DataFrame) -> None:
        """Keep each language's best and raise the floors."""
        every = scored if self.best is None else self.best.unionByName(scored)
        order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
        best = stored(every.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= self.top).drop("rank"),
                      "phrase-best")
        if self.best is not None:
            discard(self.best)
        self.best = best

    def advance(self) -> None:
        floors = (self.best.groupBy("lang").agg(F.min("score").alias("lowest"), F.count(F.lit(1)).alias("found"))
                  if self.best is not None else self.langs.limit(0).select("lang", F.lit(0).alias("lowest"), F.lit(0).alias("found")))
        new = (self.langs.join(floors, "lang", "left").join(self.cuts, "lang", "left").select(
            "lang", "n", "rows", F.when(F.col("found") >= self.top, F.col("lowest")).otherwise(F.col("floor")).cast("long").alias("floor"),
            F.greatest(F.col("done"), F.coalesce(F.col("cut") - 1, F.col("done"))).alias("done")))
        new = stored(new, "phrase-langs")
        discard(self.langs)
        self.langs = new


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """Each language's best ``top`` phrases of ``docs`` (text, lang and any other columns): (lang, rank, phrase, a, l, r, n,
    score).

    Texts are lower-cased (A-Z) and cut at ``.,;:!?`` and line ends; words are what blanks and tabs separate; null lang is
    ``und``, null text is empty, repeated rows count each time.  A phrase of 2 to ``longest`` words within a piece that
    occurs ``min_count`` times or more (overlaps included) is a candidate; one that a longer candidate of equal count
    holds is dropped.  ``score`` is the lowest floor(1000 a n / (l r)) over its cuts, exact, with l and r the counts of its
    two parts at that cut (the first of several).  Order: score, then a, descending, then the phrase's bytes.  Fewer
    candidates give fewer rows; an empty table gives an empty result.

    One buffer of text is in memory at a time; all counts are Spark aggregations, combined before the shuffle."""
    prepared(docs.sparkSession)
    search, share = Search(docs, min_count, longest, top), FIRST_SHARE
    while (words := search.block(share)) is not None:
        levels = search.grow(words)
        if levels:
            search.settle(search.scored(levels))
        search.advance()
        share *= 2
    discard(search.numbered)
    if search.best is None:
        best = search.langs.limit(0).select("lang", F.lit("").alias("phrase"), *[F.lit(0).cast("long").alias(c) for c in ("a", "l", "r", "n", "score")])
    else:
        best = search.best
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return best.select("lang", F.row_number().over(order).cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
