"""Toxicity: held-out accuracy, located sentences, edges."""

import random
import zlib

import numpy as np
import pytest

from llm_cases import docs, empty, rows
from tripmart.llm import toxicity
from tripmart.llm.catalog import op5_toxicity


def planted(seed=6, n=600):
    """One document in four has one or two bad sentences among clean ones; labels are per document."""
    rng = random.Random(seed)
    common = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    table, spots = [], {}
    for key in range(n):
        parts = [" ".join(rng.choices(common, k=rng.randint(4, 10))) for _ in range(rng.randint(1, 12))]
        toxic = int(rng.random() < 0.25)
        if toxic:
            for i in rng.sample(range(len(parts)), min(len(parts), rng.randint(1, 2))):
                own = parts[i].split()
                own.insert(rng.randint(0, len(own)), rng.choice(["vile", "nasty", "grimlord" + rng.choice("abc")]))
                parts[i] = " ".join(own)
                spots.setdefault(key, set()).add(i)
        table.append((key, ". ".join(parts) + ".", toxic))
    return table, spots


def frames(spark, table):
    return (spark.createDataFrame([(k, t) for k, t, _ in table], "doc_id long, text string"),
            spark.createDataFrame([(k, y) for k, _, y in table], "doc_id long, toxic int"))


def test_held_out_and_located_sentences(spark):
    table, spots = planted()
    texts, labels = frames(spark, table)
    truth = {k: y for k, _, y in table}
    got = toxicity.score(texts, labels).collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    model = toxicity.fit(texts, labels)
    body = dict((k, t) for k, t, _ in table)
    found = {}
    for r in toxicity.locate(texts, model).collect():
        assert body[r.doc_id][r.start:r.end] == r.sentence
        found.setdefault(r.doc_id, set()).add(body[r.doc_id][:r.start].count("."))
    hit = sum(len(found.get(k, set()) & s) for k, s in spots.items())
    assert hit > 0.9 * sum(map(len, spots.values()))
    assert sum(len(found.get(k, set()) - spots.get(k, set())) for k in found) < 0.1 * hit


def test_scorer_is_the_noisy_or_of_sentences(spark):
    model = toxicity.Model(-4.0, {"bad": 3.0, "bad*": 1.0, "wor*": 2.0, "worse": 1.5})
    scorer = toxicity.Scorer(model)
    for text in ("", None, "bad. fine words. worse bad badly", "nothing here\nat all", "..!!", "Bad BAD bad"):
        clean = 1.0
        parts = [w for _, _, w in toxicity.sentences(text)] or [set()]
        for kinds in parts:
            z = -4.0 + sum(model.weights.get(s, 0.0) for w in kinds for s in toxicity.signs_of(w))
            clean *= 1 - 1 / (1 + np.exp(-z))
        # three sentences at most, so they alone make the score
        assert scorer.text(text) == pytest.approx(scorer.judged(-np.log(clean), -np.log(clean)))
        assert 1 - clean < 0.5 or scorer.text(text) == pytest.approx(1 - clean)


def test_query(spark, sf_small):
    got = op5_toxicity(spark, sf_small).collect()
    assert len(got) == spark.read.parquet(f"{sf_small}/documents.parquet").count()
    assert all(0 <= r.score <= 1 for r in got)


def test_labels_of_the_held_out_fold_change_nothing(spark):
    table, _ = planted(n=200)
    texts, labels = frames(spark, table)
    flipped = labels.selectExpr("doc_id", "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0, 1 - toxic, toxic) AS toxic")
    assert toxicity.fit(texts, labels) == toxicity.fit(texts, flipped)


def test_edges(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (6, None), (77, 1), (5, 0)], "doc_id long, toxic int")
    got = toxicity.score(docs(spark), labels).collect()
    assert len(got) == len(rows()) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(empty(spark), labels).count() == 0
    none = toxicity.score(docs(spark), labels.limit(0)).collect()
    assert all(r.score < 1e-12 and r.predicted == 0 for r in none)
    kept = toxicity.keep(docs(spark), labels.limit(0))
    assert kept.columns == docs(spark).columns and kept.count() == len(rows())


def test_clean_text_of_any_length_is_kept(spark):
    """Some toxic labels stand on documents without a sign; a long clean text still is no toxic one."""
    table, _ = planted()
    table = [(k, t, int(y or k % 50 == 1)) for k, t, y in table]
    texts, labels = frames(spark, table)
    long = spark.createDataFrame([(-1, "worda goes by. " * 20_000), (-2, "worda goes by. " * 20_000 + "vile nasty vile")],
                                 "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.score(texts.union(long), labels).where("doc_id < 0").collect()}
    assert got[-1].predicted == 0 and got[-1].score < 0.1
    assert got[-2].predicted == 1
    assert [r.doc_id for r in toxicity.keep(texts.union(long), labels).where("doc_id < 0").collect()] == [-1]


def test_clean_documents_joined_stay_clean(spark, sf_small):
    """All clean documents of the table as one text, and its first halves, quarters and so on."""
    texts, labels = (spark.read.parquet(f"{sf_small}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(texts, labels)
    scorer = toxicity.Scorer(model)
    toxic = {r.doc_id for r in labels.where("toxic = 1").collect()}
    clean = [r.text for r in texts.orderBy("doc_id").collect() if r.doc_id not in toxic and r.text and scorer.text(r.text) < 0.2]
    n = len(clean)
    assert n > 50
    while n:
        assert scorer.text("\n".join(clean[:n])) < 0.5
        n //= 2


def test_weak_signs_keep_their_order():
    scorer = toxicity.Scorer(toxicity.Model(-4.0, {"bad": 2.5}, 0.01))
    scores = [scorer.text("bad. " * n) for n in (1, 2, 4, 8, 50, 5000)]
    assert scores == sorted(scores) and scores[-1] < 0.5 and scores[0] < scores[1]
    strong = toxicity.Scorer(toxicity.Model(-4.0, {"bad": 3.0, "vile": 5.0}, 0.01))
    assert strong.text("bad. " * 50 + "vile") >= 0.5


def test_training_minimises_the_plain_likelihood():
    rng = random.Random(4)
    y, flat, ends = [], [], []
    for d in range(60):
        bag, stops = [], []
        for _ in range(rng.randint(0, 4)):
            bag += [rng.randrange(5) for _ in range(rng.randint(1, 2))]
            stops.append(len(bag))
        flat.append(bag)
        ends.append(stops)
        y.append(int(0 in bag or rng.random() < 0.1))
    weight = 0.7
    model = toxicity._train(y, flat, ends, list("abcde"), weight, rounds=4000)

    def soft(z):
        return np.log1p(np.exp(z))

    def loss(w, b, c):
        total = 0.03 / 2 * sum(x * x for x in w) + 0.005 * ((b + 8) ** 2 + (c + 8) ** 2)
        for label, bag, stops in zip(y, flat, ends):
            hazard, before = soft(c), 0
            for s in stops:
                hazard += soft(b + sum(w[i] for i in bag[before:s]))
                before = s
            total += -np.log(1 - np.exp(-hazard)) if label else weight * hazard
        return total

    w = [model.weights.get(x, 0.0) for x in "abcde"]
    point = [*w, model.bias, np.log(model.noise / (1 - model.noise))]
    best = loss(point[:5], *point[5:])
    for i in range(7):
        for step in (-0.3, -0.05, 0.05, 0.3):
            moved = list(point)
            moved[i] = max(0.0, moved[i] + step) if i < 5 else moved[i] + step
            assert loss(moved[:5], *moved[5:]) > best - 1e-3
    assert w[0] == max(w) and w[0] > 1


def test_repeated_keys_are_one_text_of_the_sample(spark):
    table, _ = planted(n=120)
    texts, labels = frames(spark, table)
    assert toxicity.fit(texts, labels) == toxicity.fit(texts.unionAll(texts).unionAll(texts), labels)
