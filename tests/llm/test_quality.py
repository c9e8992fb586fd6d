"""Quality: held-out accuracy, shrinking of sparse sites, edges."""

import math
import random

import numpy as np
import pytest

from llm_cases import docs, empty, rows
from tripmart.llm import quality
from tripmart.llm.catalog import op7_quality


def test_query_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in op7_quality(spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    held = [(got[r.doc_id].kept, r.quality) for r in labels if got[r.doc_id].held_out]
    assert len(held) > 30 and np.mean([k == bool(q) for k, q in held]) > 0.95


def site_rows(spark, sites):
    """(host, path, evidence) rows."""
    return spark.createDataFrame([x for x in sites], "host string, path string, evidence double")


def test_sparse_sites_stay_near_the_level_above(spark):
    data = []
    for h in range(20):  # hosts differ
        rate = 0.1 if h % 2 else 0.9
        for i in range(200):
            data.append((f"h{h}", f"p{i % 2}", 6.0 if (i * 7919 % 1000) / 1000 < rate else -6.0))
    data += [("tiny", "p", -6.0), (None, None, 6.0)]
    got = {(r.host, r.path): r for r in quality.sites(site_rows(spark, data)).collect()}
    overall = np.mean([1 / (1 + math.exp(-e)) for _, _, e in data])
    assert abs(got["h0", "p0"].path_rate - 0.9) < 0.06 and abs(got["h1", "p0"].path_rate - 0.1) < 0.06
    assert got["tiny", "p"].host_rate > 0.15  # one bad document does not make a bad host
    assert got["tiny", "p"].host_rate < overall
    assert got[None, None].n == 1


def test_sites_equal_plain_arithmetic(spark):
    rng = random.Random(5)
    data = [(rng.choice(["a", "b", "c", None]), rng.choice(["x", "y", None]), rng.uniform(-4, 4)) for _ in range(400)]
    data += [("hot", "x", rng.uniform(0, 4)) for _ in range(300)]
    good = [(h, p, 1 / (1 + math.exp(-e))) for h, p, e in data]

    def strength(groups):  # (rate, mean, n)
        spread = sum((r - m) ** 2 for r, m, _ in groups) - sum(m * (1 - m) / n for _, m, n in groups)
        return min(1e6, max(1.0, sum(m * (1 - m) for _, m, _ in groups) / spread - 1)) if spread > 1e-9 else 1e6

    overall = sum(g for _, _, g in good) / len(good)
    hosts = {h: [g for hh, _, g in good if hh == h] for h, _, _ in good}
    s = strength([(sum(g) / len(g), overall, len(g)) for g in hosts.values()])
    host_rate = {h: (sum(g) + overall * s) / (len(g) + s) for h, g in hosts.items()}
    paths = {k: [g for h, p, g in good if (h, p) == k] for k in {(h, p) for h, p, _ in good}}
    s = strength([(sum(g) / len(g), host_rate[k[0]], len(g)) for k, g in paths.items()])
    got = {(r.host, r.path): r for r in quality.sites(site_rows(spark, data)).collect()}
    assert set(got) == set(paths)
    for k, g in paths.items():
        assert got[k].n == len(g) and got[k].host_rate == pytest.approx(host_rate[k[0]])
        assert got[k].path_rate == pytest.approx((sum(g) + host_rate[k[0]] * s) / (len(g) + s))


def test_repeated_keys_are_one_row_of_the_sample(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 12)], "doc_id long, quality int")
    texts = spark.createDataFrame([(i, "s", "en", f"{'good text. ' * i}" if i % 2 else "# # bad |") for i in range(1, 12)],
                                  "doc_id long, source string, lang string, text string")
    model, again = quality.fit(texts, labels), quality.fit(texts.unionAll(texts).unionAll(texts), labels)
    assert np.array_equal(model.weights, again.weights) and model.bias == again.bias


def test_scores_equal_the_posterior_of_kept_rows(spark, sf_small):
    texts, labels = (spark.read.parquet(f"{sf_small}/{t}.parquet") for t in ("documents", "labels"))
    one = {r.doc_id: r.score for r in quality.score(texts, labels).collect()}
    two = {r.doc_id: r.posterior for r in quality.with_posterior(texts, labels).select("row.doc_id", "posterior").collect()}
    assert set(one) == set(two) and all(one[k] == pytest.approx(two[k]) for k in one)


def test_sites_alike_share_the_global_rate(spark):
    rng = random.Random(1)
    data = [(f"h{i % 50}", "p", 6.0 if rng.random() < 0.8 else -6.0) for i in range(500)]
    rates = [r.host_rate for r in quality.sites(site_rows(spark, data)).collect()]
    assert max(rates) - min(rates) < 0.25 and abs(np.mean(rates) - 0.8) < 0.06


def test_posterior_is_prior_odds_times_evidence(spark):
    sf = "/root/testdata/sf0.01"
    for r in op7_quality(spark, sf).limit(50).collect():
        odds = r.path_rate / (1 - r.path_rate) * math.exp(r.evidence)
        assert r.score == pytest.approx(odds / (1 + odds)) and r.kept == (r.score >= 0.5)


def test_edges(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (5, 1), (3, 0), (None, 1), (99, 0), (7, None)], "doc_id long, quality int")
    got = quality.score(docs(spark), labels).collect()
    assert len(got) == len(rows()) and all(0 <= r.score <= 1 for r in got)
    assert quality.score(empty(spark), labels).count() == 0
    one_class = quality.score(docs(spark), labels.where("quality = 1")).collect()
    assert all(r.evidence == 0 and r.kept for r in one_class)
    kept = quality.keep(docs(spark), labels)
    assert kept.columns == docs(spark).columns and kept.count() == sum(r.kept for r in got)


def test_features_are_bounded():
    for text in (None, "", "x" * 10**6, "a " * 10**5, "!!!", "### $$$"):
        f = quality.features(text)
        assert len(f) == len(quality.FEATURES) and all(math.isfinite(x) for x in f)


def test_evidence_is_computed_once_a_text(spark, sf_small):
    """The filter on the posterior isn't turned into one more call of the classifier below it."""
    docs, labels = (spark.read.parquet(f"{sf_small}/{t}.parquet") for t in ("documents", "labels"))
    plan = quality.keep(docs, labels)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
