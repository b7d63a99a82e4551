"""Reading level of each document by a Rasch-style latent difficulty model.

Every text has a level and every word a difficulty, on the scale of the
grades. The response of word w to a sentence of level t is logistic in level
and difficulty,

    logit P(w stands in the sentence) = c_w - a_w (t - d_w)^2 / 2,   a_w >= 0,

the single-peaked relative of the Rasch model (a word is met where its
difficulty d_w meets the level; where a_w is 0, the logit is linear in the
level, as Rasch's own). A sentence's level given which words it has, and how
many, maximises the conditional likelihood: the sum of its words' logits less
n log sum_v exp(logit_v(t)). A document's level is the median of its
sentences' levels, so single sentences above or below it don't count.

Parameters come by alternating optimisation until the documents' levels stand
still. Word step: Newton steps on each word's likelihood, whose sufficient
statistics are three sums over its sentences (1, t, t^2 / 2) and one histogram
of all sentences over the scale, for the sentences without the word; a sentence
counts at its document's level. Text step: each sentence's level from its words,
then each document's. Rated documents anchor the scale: they count at the rated
level, the others at their estimate, kept within the grades.

Scale: texts are cut once, into one row per document that holds its words as
numbers. Text step and sums are one map over these rows, word sums are added
per task before their shuffle, Newton steps run over the words; no text, row or
occurrence is shuffled or joined by word. A word that makes up less than
``RARE`` of all occurrences takes the difficulty of its class (script and
length), so the table of words that travels to the tasks has 1 / ``RARE``
rows (20 MB) at most on any corpus, and hot words are rows like others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.plans.runtime import durable, release

#: Grades, and least words of a document.
GRADES, MIN_WORDS = (1, 2, 3, 4), 15
#: Share of all word occurrences below which a word has its class's difficulty.
RARE = 1e-6
#: The scale: points on which sentences' levels are found, from a grade and a half below the grades to as much above.
POINTS = np.linspace(GRADES[0] - 1.5, GRADES[-1] + 1.5, 37)
CENTRE = (GRADES[0] + GRADES[-1]) / 2
#: Weight of the priors: a word's logit is flat, a sentence's level is the scale's middle.
FLAT, MIDDLE = 0.02, 0.2
#: Weight of all unrated documents together, the rated ones being 1.
UNRATED = 0.2
#: Mean change of a document's level, in grades, at which the optimisation ends; rounds after which it ends anyhow.
TOLERANCE, MAX_ROUNDS = 0.01, 12
#: Buckets of the histogram that chooses the cuts.
BUCKETS = 300
#: Word classes: script (2 bits) and length (6 bits, 63 and more together).
CLASSES = 1 << 8

_TAG = "<[^<>]{1,200}>"
_END = "[.!?…।॥|]+(?:[\"'”’)\\]]*)(?=\\s|$)|[\\n\\r]+"
_PIECE = "[,;\\n|.।॥!?\\t、，；]+"
_WORD = "[\\p{L}][\\p{L}\\p{M}'’]*"


def _plain(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("<")), F.regexp_replace(text, _TAG, "\n")).otherwise(text)


def running_text(text: Column, min_words: int = MIN_WORDS) -> Column:
    """True for prose of at least ``min_words`` words: no list, table or blank text.

    Prose has two words or more between its marks, few figures (under 0.3 of
    its words), and a sentence end, several lines or words that come again (0.07
    of them).
    """
    plain = _plain(text)
    tokens = F.filter(F.split(plain, "\\s+"), lambda w: w != "")
    words = F.size(tokens)
    parts = plain
    for dash in (" - ", " – ", " — "):
        parts = F.replace(parts, F.lit(dash), F.lit(","))
    pieces = F.size(F.filter(F.split(parts, _PIECE), lambda p: F.trim(p) != ""))
    digits = F.when(plain.rlike("\\p{N}"), F.size(F.filter(tokens, lambda w: w.rlike("\\p{N}")))).otherwise(0)
    ends = plain.rlike("[.!?…।॥|]")
    lines = plain.rlike("\\S[^\\n\\r]*[\\n\\r]+[^\\n\\r]*\\S")
    repeats = F.size(F.array_distinct(tokens)) < 0.93 * words
    return F.coalesce((words >= min_words) & (words >= 2 * pieces) & (digits < 0.3 * words) & (ends | lines | repeats), F.lit(False))


def _word_key(w: Column) -> Column:
    """A word as a number: its hash, with its class in the last 8 bits."""
    first = F.ascii(w)
    script = F.when(first.between(0x61, 0x7A), 0).when(first.between(0x900, 0x97F), 1).when(first.between(0xAA, 0x24F), 2).otherwise(3)
    return F.shiftleft(F.xxhash64(w), 8).bitwiseOR((script * 64 + F.least(F.length(w), F.lit(63))).cast("long"))


def _sentences(text: Column) -> Column:
    """The distinct words of each sentence of two words or more, as numbers."""
    words = F.transform(F.split(F.lower(_plain(text)), _END), lambda s: F.array_distinct(F.regexp_extract_all(s, F.lit(_WORD), F.lit(0))))
    return F.transform(F.filter(words, lambda ws: F.size(ws) > 1), lambda ws: F.transform(ws, _word_key))


@dataclass
class Words:
    """Per word number (own words, then classes): weights of 1, t and t^2 / 2 in its logit; t counted from CENTRE."""

    weights: np.ndarray  # [words, 3]
    normaliser: np.ndarray  # [POINTS] log of the summed odds of all words

    @staticmethod
    def of(weights: np.ndarray, known: np.ndarray) -> Words:
        t = POINTS - CENTRE
        total = np.zeros(len(t))
        w = weights[known]
        for i in range(0, len(w), 20_000):
            total += np.exp(w[i : i + 20_000] @ np.stack([np.ones_like(t), t, t * t / 2])).sum(0)
        return Words(np.where(known[:, None], weights, 0), np.log(np.maximum(total, 1e-300)))


def _peaks(n: np.ndarray, s1: np.ndarray, s2: np.ndarray, normaliser: np.ndarray) -> np.ndarray:
    """Where each sentence's likelihood is greatest on the scale, by a parabola through the three points around.

    n words, and the sums of their weights of t and t^2 / 2.
    """
    t, out = POINTS - CENTRE, np.empty(len(n))
    for at in range(0, len(n), 50_000):
        k = slice(at, at + 50_000)
        like = s1[k, None] * t + s2[k, None] * (t * t / 2) - n[k, None] * normaliser - MIDDLE * t * t / 2
        rows, j = np.arange(len(like)), np.clip(like.argmax(1), 1, len(POINTS) - 2)
        y0, y1, y2 = like[rows, j - 1], like[rows, j], like[rows, j + 1]
        bend = y0 - 2 * y1 + y2
        off = np.where(bend < 0, 0.5 * (y0 - y2) / np.where(bend < 0, bend, 1), 0)
        out[k] = POINTS[j] + np.clip(off, -1, 1) * (POINTS[1] - POINTS[0])
    return out


def _medians(of: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Median of the values of each of n owners; nan for an owner of none."""
    order = np.lexsort((values, of))
    v, many = values[order], np.bincount(of, minlength=n)
    first = np.cumsum(many) - many
    if not len(v):
        return np.full(n, np.nan)
    lo, hi = np.minimum(first + np.maximum(many - 1, 0) // 2, len(v) - 1), np.minimum(first + many // 2, len(v) - 1)
    return np.where(many > 0, (v[lo] + v[hi]) / 2, np.nan)


class Batch:
    """Documents of one Arrow batch (id, g, n, w): their sentences, and these sentences' words."""

    def __init__(self, b: pa.RecordBatch):
        self.docs = b.num_rows
        self.rated = b.column(1).to_numpy(zero_copy_only=False).astype(float)
        n, at = b.column(2), b.column(2).offsets.to_numpy()
        self.sizes = n.values.to_numpy()[at[0] : at[-1]]
        self.doc = np.repeat(np.arange(self.docs), np.diff(at))
        w, at = b.column(3), b.column(3).offsets.to_numpy()
        self.words = w.values.to_numpy()[at[0] : at[-1]]
        self.sentence = np.repeat(np.arange(len(self.sizes)), self.sizes)

    def _sum(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.sentence, values, len(self.sizes))

    def known(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per sentence: words that tell anything, sums of their weights of t and t^2 / 2."""
        w = words.weights[self.words]
        return self._sum((w[:, 0] != 0).astype(float)), self._sum(w[:, 1]), self._sum(w[:, 2])

    def levels(self, words: Words) -> np.ndarray:
        """Level of each document by its words alone; nan: no sentence."""
        n, s1, s2 = self.known(words)
        some = n > 0
        return _medians(self.doc[some], _peaks(n[some], s1[some], s2[some], words.normaliser), self.docs)


def _part(number: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(sums.any(1))
    return pa.RecordBatch.from_arrays([pa.array(number[at], pa.int64()), *[pa.array(sums[at, j], pa.float64()) for j in range(3)]], names=["i", "s0", "s1", "s2"])


#: Rows of the sums that are no word's: the histogram of sentences by level, then documents and their change of level.
_HISTOGRAM = -1 - np.arange(len(POINTS))
_CHANGE = -1 - len(POINTS)


def _sums(docs: DataFrame, size: int, words: Words | None, before: Words | None, unrated: float) -> DataFrame:
    """(i, s0, s1, s2): the sufficient statistics of each word, by one pass over the documents.

    Without ``words``, of the rated documents alone.
    """
    shared = docs.sparkSession.sparkContext.broadcast((words, before))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, then = shared.value
        sums, histogram, change = np.zeros((size, 3)), np.zeros((len(POINTS), 3)), np.zeros((1, 3))
        step = POINTS[1] - POINTS[0]
        for b in batches:
            x = Batch(b)
            rated = ~np.isnan(x.rated)
            weight = np.where(rated, 1.0, unrated)[x.doc]
            if now is None:
                level = np.where(rated, x.rated, CENTRE)[x.doc]
            else:
                own = x.levels(now)
                if then is not None:
                    both = np.abs(own - x.levels(then))
                    change[0, :2] += np.nansum(both), np.count_nonzero(~np.isnan(both))
                level = np.where(rated, x.rated, np.clip(np.nan_to_num(own, nan=CENTRE), GRADES[0], GRADES[-1]))[x.doc]
            at = np.clip(np.rint((level - POINTS[0]) / step), 0, len(POINTS) - 1).astype(int)
            t = POINTS[at] - CENTRE
            histogram[:, 0] += np.bincount(at, weight, len(POINTS))
            for j, v in enumerate((weight, weight * t, weight * t * t / 2)):
                sums[:, j] += np.bincount(x.words, v[x.sentence], size)
        yield _part(np.arange(size), sums)
        yield _part(_HISTOGRAM, histogram)
        yield _part(np.array([_CHANGE]), change)

    source = docs if words is not None else docs.where("g is not null")
    total = source.select("id", "g", "n", "w").mapInArrow(run, "i long, s0 double, s1 double, s2 double")
    return total.groupBy("i").agg(*[F.sum(f"s{j}").alias(f"s{j}") for j in range(3)])


def newton(sums: np.ndarray, histogram: np.ndarray, start: np.ndarray | None = None, steps: int = 40) -> np.ndarray:
    """Weights [words, 3] that maximise each word's penalised likelihood, given its sums and all sentences' histogram."""
    t = POINTS - CENTRE
    x = np.stack([np.ones_like(t), t, t * t / 2])
    base = np.log((sums[:, 0] + 0.5) / np.maximum(histogram.sum() - sums[:, 0] + 1, 0.5))
    prior = np.stack([base, np.zeros_like(base), np.zeros_like(base)], 1)
    ridge = np.array([0.02, FLAT, FLAT])
    w = prior.copy() if start is None else start
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(w @ x, -40, 40)))
        slope = sums - (histogram * p) @ x.T - ridge * (w - prior)
        bend = np.einsum("vg,ig,jg->vij", histogram * p * (1 - p), x, x) + np.diag(ridge)
        move = np.linalg.solve(bend, slope[:, :, None])[:, :, 0]
        move *= np.minimum(1, 1.5 / np.maximum(np.abs(move).max(1, keepdims=True), 1e-9))
        w = w + move
        w[:, 2] = np.minimum(w[:, 2], 0)
        if np.abs(move).max(initial=0) < 1e-3:
            break
    return w


def _fit(docs: DataFrame, size: int, words: Words | None = None, before: Words | None = None, unrated: float = 0.0) -> tuple[Words, float, float]:
    """The words after one more step, the documents' mean change of level that came before it, and the sentences' weight."""
    sums = durable(_sums(docs, size, words, before, unrated))
    rest = {r.i: r for r in sums.where("i < 0").collect()}
    histogram = np.array([rest[i].s0 if i in rest else 0.0 for i in _HISTOGRAM.tolist()])
    change = rest[_CHANGE].s0 / rest[_CHANGE].s1 if _CHANGE in rest and rest[_CHANGE].s1 else np.inf

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 10_000):
                part = b.slice(at, 10_000)
                w = newton(np.stack([part.column(j).to_numpy() for j in (1, 2, 3)], 1), histogram)
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(w[:, j], pa.float64()) for j in range(3)]], names=["i", "w0", "w1", "w2"])

    # at most 1 / RARE + CLASSES rows
    got = sums.where("i >= 0").mapInArrow(run, "i long, w0 double, w1 double, w2 double").toArrow()
    release(sums)
    weights, known = np.zeros((size, 3)), np.zeros(size, bool)
    at = got.column("i").to_numpy()
    known[at] = True
    for j in range(3):
        weights[at, j] = got.column(f"w{j}").to_numpy()
    return Words.of(weights, known), float(change), float(histogram.sum())


def _numbered(docs: DataFrame, keys: np.ndarray) -> DataFrame:
    """(id, g, n, w): the words of each sentence by their place in ``keys``, or their class behind it; n words in each."""
    shared = docs.sparkSession.sparkContext.broadcast(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for b in batches:
            outer = b.column(2)
            inner = outer.flatten()
            key = inner.flatten().to_numpy()
            at = np.minimum(np.searchsorted(known, key), max(len(known) - 1, 0))
            own = known[at] == key if len(known) else np.zeros(len(key), bool)
            number = np.where(own, at, len(known) + (key & (CLASSES - 1))).astype(np.int32)
            sizes = np.diff(inner.offsets.to_numpy()).astype(np.int32)
            first = outer.offsets.to_numpy() - outer.offsets.to_numpy()[0]  # per document: its first sentence
            word = np.concatenate([[0], np.cumsum(sizes)])[first].astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(sizes)), pa.ListArray.from_arrays(pa.array(word), pa.array(number))], names=["id", "g", "n", "w"])

    return docs.mapInArrow(run, f"id {dict(docs.dtypes)['id']}, g double, n array<int>, w array<int>")


def reading_levels(docs: DataFrame, id_col: str, text_col: str, labels: DataFrame, tolerance: float = TOLERANCE, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """(id, grade, level) of every document of running text; labels: (id, grade).

    Null, empty, blank and short texts, lists and tables get no row. A document
    without a word that tells anything has the scale's middle as its level. A
    document rated several times counts with the mean; null ratings don't
    count. Without any rating there is no scale and the result is empty.
    Repeated ids are documents of their own; null ids stay.
    """
    rated = labels.select(F.col(id_col).alias("id"), F.col("grade").cast("double").alias("g")).where(F.col("g").isNotNull() & F.col("id").isNotNull()).groupBy("id").agg(F.avg("g").alias("g"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(running_text(F.col("text")))
    cut = durable(texts.select("id", _sentences(F.col("text")).alias("s")).join(rated, "id", "left").select("id", "g", "s"))
    counts = durable(cut.select(F.explode(F.flatten("s")).alias("word")).groupBy("word").agg(F.count("*").alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    keys = np.sort(counts.where(F.col("n") >= total * RARE).select("word").toArrow().column("word").to_numpy())
    numbered = durable(_numbered(cut, keys))
    release(cut, counts)
    size = len(keys) + CLASSES

    words, _, weight = _fit(numbered, size)
    before, share = None, 0.0
    if weight:
        sentences = numbered.agg(F.sum(F.when(F.col("g").isNull(), F.size("n")))).first()[0] or 0
        share = UNRATED * weight / sentences if sentences else 0.0
        for _ in range(max_rounds):
            after, change, _ = _fit(numbered, size, words, before, share)
            words, before = after, words
            if change < tolerance:
                break
    levels = durable(_levels(numbered if weight else numbered.limit(0), words))
    grade = F.lit(GRADES[0]).cast("long")
    for g, cut_at in zip(GRADES[1:], _cuts(levels), strict=True):
        grade = F.when(F.col("level") >= cut_at, F.lit(g).cast("long")).otherwise(grade)
    release(numbered)
    return levels.select(F.col("id").alias(id_col), grade.alias("grade"), "level")


def _levels(docs: DataFrame, words: Words) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            level = np.nan_to_num(Batch(b).levels(shared.value), nan=CENTRE)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(level, pa.float64())], names=["id", "g", "level"])

    return docs.select("id", "g", "n", "w").mapInArrow(run, f"id {dict(docs.dtypes)['id']}, g double, level double")


def _cuts(levels: DataFrame) -> list[float]:
    """Levels that part the grades with the fewest rated documents on the wrong side; ties: nearest the middle between two grades."""
    lo, hi = float(POINTS[0]), float(POINTS[-1])
    bucket = F.least(F.greatest(F.floor((F.col("level") - lo) / (hi - lo) * BUCKETS), F.lit(0)), F.lit(BUCKETS - 1))
    rows = levels.where("g is not null").groupBy(F.round("g").cast("int").alias("grade"), bucket.alias("b")).count().collect()
    out = []
    for g in GRADES[1:]:
        below, above = [0] * (BUCKETS + 1), [0] * (BUCKETS + 1)
        for r in rows:
            if r["grade"] < g:
                below[r["b"]] += r["count"]
            else:
                above[r["b"]] += r["count"]
        wrong, best = sum(below), []
        least = None
        for b in range(BUCKETS + 1):  # cut below bucket b: all that are below the grade and at b or over are wrong
            if least is None or wrong < least:
                least, best = wrong, [b]
            elif wrong == least:
                best.append(b)
            wrong += above[b] - below[b]
        default = (g - 0.5 - lo) / (hi - lo) * BUCKETS
        at = min(best, key=lambda b: (abs(b - default), b)) if rows else default
        out.append(lo + at / BUCKETS * (hi - lo))
    return sorted(out)
