"""Quality by hierarchical empirical Bayes: a document's own evidence on its site's prior.

A logistic classifier on how a text is written (not on its words) gives each document a log
likelihood ratio of being good. Sites form a hierarchy: all documents, hosts, paths of a host. A
host's rate of good documents is the mean of its documents' probabilities, shrunk toward the global
rate; a path's rate is shrunk toward its host's. How strongly is fitted to the spread among hosts
and among paths (method of moments for a beta prior), so sparse sites stay at the level above. A
document's posterior is the path's odds times its likelihood ratio; it is kept at 0.5 or more.

The classifier is fitted on a bounded sample of labels (``sample`` of each class at most, by seeded
number), of those whose crc32(key as text) mod ``folds`` is not 0, and on one row of each sampled key. Everything else covers all rows:
two scans (one where only scores are asked), and one aggregate per path with partial sums, so a host with a third of all rows sends
one row per task.

Cases: null or empty texts have the features of an empty text; null hosts and paths are sites of
their own; repeated rows count each; without labels of both classes the evidence is 0 and all are
judged by a rate of 1/2 (kept); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import field, fold, key_text, packed, seeded, stored

SAMPLE, FOLDS, SEED = 2000, 5, 37
FEATURES = ("symbols", "odd_ends", "bangs", "bars", "upper_words", "echoes", "variety", "dup_lines", "digits",
            "word_length", "length", "few_words", "sentence_ends")


def features(text: str | None) -> list[float]:
    """How the text is written; each value is a share or a logarithm, so long texts stay in range."""
    text = text or ""
    words = text.split()
    n, chars = max(1, len(words)), max(1, len(text))
    lines = [x for x in text.split("\n") if x.strip()]
    ends = [w[-1] for w in words]
    return [
        sum(map(text.count, "#*$%&|<>")) / chars, sum(map(ends.count, "#*$%&")) / n, ends.count("!") / n,
        words.count("|") / n, sum(map(str.isupper, words)) / n, sum(map(eq, words, words[1:])) / n,
        len(set(words)) / n, (len(lines) - len(set(lines))) / max(1, len(lines)),
        sum(map(text.count, "0123456789")) / chars, len(text) / n / 10, math.log1p(len(words)) / 10,
        float(len(words) < 20), (ends.count(".") + ends.count(",")) / n,
    ]


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def evidence(self, rows: np.ndarray) -> np.ndarray:
        """Log likelihood ratio of good to bad."""
        return np.clip((rows - self.mean) / self.scale @ self.weights + self.bias, -20, 20)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        sample: int = SAMPLE, folds: int = FOLDS, seed: int = SEED) -> Model:
    """Ridge logistic regression by Newton steps; classes weigh the same, so the score is a
    likelihood ratio. The driver gets the sample's features: 2 * sample rows of 13 numbers."""
    usable = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y"), key_text(key).alias("t")) \
        .where((fold(key, folds) != 0) & F.col("y").isin(0, 1)).distinct()
    chosen = None
    for y in (0, 1):
        part = usable.where(F.col("y") == y).orderBy(seeded(seed, F.col("t")), "k").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = stored(chosen.select(F.col("k").alias("_k"), "y"), "quality-sample")

    @F.pandas_udf("array<double>")
    def describe(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in texts])

    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("text")).join(
        F.broadcast(chosen), F.col("k") == F.col("_k")).select("k", "y", describe("text").alias("x"))
    rows = rows.groupBy("k", "y").agg(F.min("x").alias("x"))  # one row a key, however often the key is repeated
    got = sorted((str(r.k), r.y, list(r.x)) for r in rows.collect())
    y = np.array([g[1] for g in got], float)
    width = len(FEATURES)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(width), np.ones(width), np.zeros(width), 0.0)
    x = np.array([g[2] for g in got])
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    x = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    each = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    w, ridge = np.zeros(width + 1), np.append(np.full(width, 1.0), 1e-6)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (each * (p - y)) + ridge * w
        curve = (x * (each * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(ridge)
        move = np.linalg.solve(curve, grad)
        w -= move * min(1.0, 2.0 / max(1e-9, np.abs(move).max()))
        if np.abs(move).max() < 1e-6:
            break
    return Model(mean, scale, w[:-1], float(w[-1]))


def evidence_column(spark, model: Model, text: str | Column = "text") -> Column:
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def evidence(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            rows = [features(t) for t in texts]
            yield pd.Series(shared.value.evidence(np.array(rows)) if rows else [], dtype="float64")

    # As a deterministic function it would be put into filters below as well: each text would be scored twice, by two workers a task.
    return evidence.asNondeterministic()(F.col(text) if isinstance(text, str) else text)


def _strength(rate: Column, mean: Column, n: Column) -> list[Column]:
    """Sums for a beta prior's strength: squared deviations of the rates, and what chance alone gives."""
    return [F.sum((rate - mean) * (rate - mean)), F.sum(mean * (1 - mean) / n), F.sum(mean * (1 - mean))]


def _fitted(spread, chance, most) -> float:
    """s with mean(1 - mean) / (s + 1) = variance of the true rates (spread less chance); 1e6 if none is left."""
    left = (spread or 0.0) - (chance or 0.0)
    return min(1e6, max(1.0, (most or 0.0) / left - 1)) if left > 1e-9 else 1e6


def sites(rows: DataFrame) -> DataFrame:
    """``host, path, n, host_rate, path_rate`` from rows with ``host, path, evidence``."""
    good = 1 / (1 + F.exp(-F.col("evidence")))
    paths = stored(rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum(good).alias("good")), "paths")
    hosts = stored(paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("good").alias("hgood")), "hosts")
    n, good_sum = hosts.agg(F.sum("hn"), F.sum("hgood")).first()
    overall = min(1 - 1e-6, max(1e-6, good_sum / n)) if n else 0.5
    rate = F.col("hgood") / F.col("hn")
    strength = _fitted(*hosts.agg(*_strength(rate, F.lit(overall), F.col("hn"))).first())
    hosts = hosts.select(F.col("host").alias("_h"), ((F.col("hgood") + overall * strength) / (F.col("hn") + strength)).alias("host_rate"))
    paths = paths.join(hosts, F.col("host").eqNullSafe(F.col("_h"))).drop("_h")
    rate = F.col("good") / F.col("n")
    strength = _fitted(*paths.agg(*_strength(rate, F.col("host_rate"), F.col("n"))).first())
    return paths.select("host", "path", "n", "host_rate", (
        (F.col("good") + F.col("host_rate") * strength) / (F.col("n") + strength)).alias("path_rate"))


def _judged(every: DataFrame, host: str, path: str) -> DataFrame:
    """``host_rate, path_rate, posterior`` for packed rows with their ``evidence``."""
    rows = every.select(field(host).alias("host"), field(path).alias("path"), "evidence")
    found = stored(sites(rows), "sites").select("host", "path", "host_rate", "path_rate")
    out = every.join(found, field(host).eqNullSafe(F.col("host")) & field(path).eqNullSafe(F.col("path")), "left")
    odds = F.col("path_rate") / (1 - F.col("path_rate")) * F.exp("evidence")
    return out.withColumn("posterior", odds / (1 + odds)).drop("host", "path")


def with_posterior(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                   host: str = "source", path: str = "lang", folds: int = FOLDS) -> DataFrame:
    """The rows packed as ``row``, with ``evidence, host_rate, path_rate, posterior``. Texts are read
    twice and never shuffled unless the sites are too many for Spark's own broadcast limit."""
    model = fit(docs, labels, key, text, folds=folds)
    return _judged(packed(docs).withColumn("evidence", evidence_column(docs.sparkSession, model, field(text))), host, path)


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source",
          path: str = "lang", least: float = 0.5, folds: int = FOLDS) -> DataFrame:
    """``key, held_out, evidence, host_rate, path_rate, score, kept`` per row. The evidence of each text is computed
    once, into a written table without texts."""
    model = fit(docs, labels, key, text, folds=folds)
    every = packed(docs.select(key, host, path, text)).select(
        F.struct(*[field(c).alias(c) for c in (key, host, path)]).alias("row"),
        evidence_column(docs.sparkSession, model, field(text)).alias("evidence"))
    out = _judged(stored(every, "evidence"), host, path)
    return out.select(field(key).alias(key), "evidence", "host_rate", "path_rate", F.col("posterior").alias("score"),
                      (F.col("posterior") >= least).alias("kept")).withColumn("held_out", fold(key, folds) == 0)


def keep(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source",
         path: str = "lang", least: float = 0.5, folds: int = FOLDS) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns."""
    return with_posterior(docs, labels, key, text, host, path, folds).where(F.col("posterior") >= least).select("row.*")
