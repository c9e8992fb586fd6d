"""Toxicity by multiple-instance learning: documents are labelled, sentences are scored.

A sentence's chance of being toxic is logistic in its signs; a document's is the noisy-or of its
sentences with signs (toxic if any is) and of one noise term a document, which stands for labels that no
sign explains; sentences without signs add nothing. Weak signs would still add up with length, so a score of
0.5 takes three sentences at most that reach it (see :meth:`Scorer.judged`). All are trained together from document labels alone, so the weight of a toxic document goes to the
sentences that explain it, and these are the offending sentences that :func:`locate` returns.

Signs are words (letters, lower case) and word beginnings of 3 to 7 letters. Candidates are counted
over the training sample by Spark; those that occur in ``least`` toxic sample documents and stand out
against the clean ones are kept, the strongest ``signs`` of them at most. The sample is bounded:
``sample`` toxic and twice as many clean documents at most, those with the smallest seeded numbers.
Only labels are learned from whose crc32(key as text) mod ``folds`` is not 0.

Cases: a null or empty text, or one without letters, scores like any text without signs; null
labels and labels of unknown documents are not used; repeated rows are scored each; without labels
of both kinds every score is 0; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import fold, key_text, seeded, stored

SENTENCE = re.compile(r"[^.!?\n]+")
LETTERS = re.compile(r"[^\W\d_]+")
BEGINNINGS = range(3, 8)
SAMPLE, SIGNS, LEAST, FOLDS, SEED = 1500, 4000, 3, 5, 31
#: A sign is this many times as frequent in toxic sample documents, and so many deviations above the clean ones.
RATIO, STANDS_OUT = 5, 1.5


def signs_of(word: str) -> list[str]:
    return [word, *(word[:k] + "*" for k in BEGINNINGS if k < len(word))]


def sentences(text: str | None) -> list[tuple[int, int, set[str]]]:
    """Start, end and distinct words of each sentence that has a letter."""
    lower = (text or "").lower()
    if len(lower) != len(text or ""):  # a letter whose lower case is two: keep the text's offsets
        lower = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    out = []
    for m in SENTENCE.finditer(lower):
        words = set(LETTERS.findall(m[0]))
        if words:
            out.append((m.start(), m.end(), words))
    return out


#: A document is toxic if so many of its sentences make it so; lower scores than ``CALM`` stand as they are in any case.
FEW = 3
CALM = 0.25


@dataclass
class Model:
    """``noise``: the chance of a toxic label without any sign; None: sentences without signs have the bias's
    chance each, and documents none of their own."""
    bias: float
    weights: dict[str, float]
    noise: float | None = None


class _Weights(dict):
    """word -> sum of its signs' weights."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        value = sum(self.weights.get(s, 0.0) for s in signs_of(word))
        if len(self) >= 300_000:
            self.clear()
        if len(word) <= 64:
            self[word] = value
        return value


def _soft(z: float) -> float:
    """-ln(1 - logistic(z))."""
    return z + math.log1p(math.exp(-z)) if z > 0 else math.log1p(math.exp(z))


class Scorer:
    def __init__(self, model: Model):
        self.model, self.words = model, _Weights(model.weights)
        self.plain = _soft(model.bias) if model.noise is None else 0.0
        self.start = 0.0 if model.noise is None else -math.log1p(-model.noise)

    def text(self, text: str | None) -> float:
        lower = (text or "").lower()
        words = LETTERS.findall(lower)
        weight = self.words
        kinds = {w for w in set(words) if weight[w] != 0.0}
        parts = SENTENCE.findall(lower)
        if not kinds:
            n = max(1, sum(1 for p in parts if LETTERS.search(p)))
            return self.judged(self.start + n * self.plain, self.start + min(n, FEW) * self.plain)
        risks = [0.0] * FEW
        total = self.start
        for p in parts:
            found = set(LETTERS.findall(p))
            if found:
                z = sum(weight[w] for w in found & kinds)
                risk = _soft(self.model.bias + z) if z else self.plain
                total += risk
                risks.append(risk)
        return self.judged(total, self.start + sum(heapq.nlargest(FEW, risks)))

    def judged(self, total: float, few: float) -> float:
        """The noisy-or of all sentences. Weak signs add up with a text's length alone, so a document is called toxic only
        if its ``FEW`` strongest sentences make it so by themselves; else what is above ``CALM`` is put under 0.5, in the same order."""
        score = -math.expm1(-total)
        if few >= math.log(2) or score < CALM:
            return score
        return CALM + (0.5 - CALM) * (1 - math.exp(-(score - CALM) / (0.5 - CALM))) * 0.999


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        sample: int = SAMPLE, signs: int = SIGNS, least: int = LEAST, folds: int = FOLDS, seed: int = SEED) -> Model:
    """Trains on the bounded sample; the driver gets sample counts and the signs' sentences only."""
    chosen = None
    usable = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y"), key_text(key).alias("t")) \
        .where((fold(key, folds) != 0) & F.col("y").isin(0, 1)).distinct()
    shares = {r.y: r.n for r in usable.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    for y, n in ((1, sample), (0, 2 * sample)):
        part = usable.where(F.col("y") == y).orderBy(seeded(seed, F.col("t")), "k").limit(n)
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = stored(chosen.select(F.col("k").alias("_k"), "y"), "toxic-sample")
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("text")).join(
        F.broadcast(chosen), F.col("k") == F.col("_k"))
    # One text a key, however often the key is repeated: 3 * sample texts at most, read from the corpus once.
    rows = stored(rows.groupBy("k", "y").agg(F.min("text").alias("text")), "toxic-texts")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                seen: tuple[Counter, Counter] = (Counter(), Counter())
                for y, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    words = set(LETTERS.findall((t or "").lower()))
                    seen[y].update({s for w in words for s in signs_of(w)})
                names = list(seen[0] | seen[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), pa.array([seen[1][s] for s in names], pa.int64()),
                     pa.array([seen[0][s] for s in names], pa.int64())], ["sign", "toxic", "clean"])

    sizes = {r.y: r.n for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return Model(-50.0, {}, 0.0)
    rate1, rate0 = (F.col("toxic") + 0.5) / (n1 + 1), (F.col("clean") + 0.5) / (n0 + 1)
    z = (rate1 - rate0) / F.sqrt(rate1 * (1 - rate1) / n1 + rate0 * (1 - rate0) / n0)
    found = (rows.select("y", "text").mapInArrow(count, "sign string, toxic bigint, clean bigint")
             .groupBy("sign").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
             .where((F.col("toxic") >= min(least, max(1, n1 // 10))) & (rate1 > RATIO * rate0)).withColumn("z", z).where(F.col("z") > STANDS_OUT)
             .orderBy(F.desc("z"), "sign").limit(signs).collect())
    numbers = {r.sign: i for i, r in enumerate(found)}
    shared = docs.sparkSession.sparkContext.broadcast(numbers)

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                flat, ends = [], []
                for t in part.column(2).to_pylist():
                    ids, stops = [], []
                    for _, _, words in sentences(t):
                        own = [known[s] for w in words for s in signs_of(w) if s in known]
                        if own:
                            ids += own
                            stops.append(len(ids))
                    flat.append(ids)
                    ends.append(stops)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(flat, pa.list_(pa.int32())),
                     pa.array(ends, pa.list_(pa.int32()))], ["k", "y", "flat", "ends"])

    kind = docs.schema[key].dataType.simpleString()
    data = rows.mapInArrow(bags, f"k {kind}, y int, flat array<int>, ends array<int>")
    data = data.orderBy("k", "flat", "ends").collect()
    clean_weight = (shares[0] / n0) / (shares[1] / n1)
    return _train([r.y for r in data], [list(r.flat) for r in data], [list(r.ends) for r in data],
                  [r.sign for r in found], clean_weight)


def _train(y, flat, ends, names, clean_weight: float = 1.0, rounds: int = 400, ridge: float = 0.03) -> Model:
    """Noisy-or likelihood by Adam; clean documents weigh what their share among all labels asks for."""
    y = np.array(y, float)
    sign = np.array([i for f in flat for i in f], int)
    sentence, bag, n = [], [], 0
    for d, stops in enumerate(ends):
        before = 0
        for s in stops:
            sentence += [n] * (s - before)
            bag.append(d)
            n, before = n + 1, s
    sentence, bag = np.array(sentence, int), np.array(bag, int)
    docs = len(y)
    each = np.where(y == 1, 1.0, clean_weight)
    w, b, c = np.full(len(names), 0.5), -4.0, -4.0  # c: the noise term's logit
    m, v, step = np.zeros(len(w) + 2), np.zeros(len(w) + 2), 0.1
    for t in range(1, rounds + 1):
        z = b + np.bincount(sentence, w[sign], n) if len(sign) else np.zeros(0)
        p, noise = 1 / (1 + np.exp(-np.clip(z, -40, 40))), 1 / (1 + math.exp(-c))
        hazard = np.bincount(bag, np.logaddexp(0, z), docs) + math.log1p(math.exp(c))
        clean = np.exp(-hazard)
        pull = np.where(y == 1, -clean / np.maximum(1 - clean, 1e-9), 1.0) * each
        gz = pull[bag] * p
        grad = np.bincount(sign, gz[sentence], len(w)) if len(sign) else np.zeros(len(w))
        grad = np.append(grad + ridge * w, [gz.sum() + 0.01 * (b + 8), pull.sum() * noise + 0.01 * (c + 8)])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        move = step * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b, c = np.maximum(0.0, w - move[:-2]), b - move[-2], c - move[-1]
    return Model(float(b), {s: float(x) for s, x in zip(names, w) if x > 1e-3}, float(1 / (1 + math.exp(-c))))


def score_column(spark, model: Model, text: str = "text") -> Column:
    """The text's score from 0 to 1."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shared.value)
        for texts in batches:
            yield pd.Series([scorer.text(t) for t in texts], dtype="float64")

    return score(F.col(text))


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", folds: int = FOLDS) -> DataFrame:
    """``key, held_out, score, predicted`` per row; no shuffle of texts."""
    model = fit(docs, labels, key, text, folds=folds)
    out = docs.select(F.col(key), (fold(key, folds) == 0).alias("held_out"),
                      score_column(docs.sparkSession, model, text).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def locate(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """``key, start, end, score, sentence`` of the sentences that score ``least`` or more (offsets
    in characters, ``end`` is exclusive)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = _Weights(shared.value.weights)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = []
                for i, t in enumerate(part.column(1).to_pylist()):
                    for a, b, words in sentences(t):
                        p = -math.expm1(-_soft(shared.value.bias + sum(weight[w] for w in words)))
                        if p >= least:
                            rows.append((i, a, b, p, t[a:b]))
                at_rows = pa.array([r[0] for r in rows], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at_rows), pa.array([r[1] for r in rows], pa.int64()),
                     pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.float64()),
                     pa.array([r[4] for r in rows], pa.string())], ["k", "start", "end", "score", "sentence"])

    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(
        work, f"k {kind}, start bigint, end bigint, score double, sentence string").withColumnRenamed("k", key)


def keep(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", below: float = 0.5,
         folds: int = FOLDS) -> DataFrame:
    """The rows of ``docs`` that score less than ``below``, with their columns."""
    model = fit(docs, labels, key, text, folds=folds)
    return docs.where(score_column(docs.sparkSession, model, text) < below)
