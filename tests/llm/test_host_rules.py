"""Rule counts and host verdicts against brute force."""

from collections import Counter

import pytest

from llm_cases import docs, empty, rows, words
from tripmart.llm import rules
from tripmart.llm.catalog import op8_host_rules


def counted(text):
    text = text or ""
    w = words(text)
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = {k + j for k, x in enumerate(zip(w, w[1:], w[2:])) if windows[x] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def fields(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words


def test_query_equals_brute_force(spark, sf_small):
    table = {r.doc_id: (r.text, r.source) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    got = op8_host_rules(spark, sf_small).collect()
    assert len(got) == len(table)
    bad, seen = Counter(), Counter()
    for r in got:
        c = counted(table[r.doc_id][0])
        assert fields(r) == c
        assert r.base_failed == (c[0] < 50 or 100 * c[4] > 50 * c[0])
        bad[table[r.doc_id][1]] += r.base_failed
        seen[table[r.doc_id][1]] += 1
    rates = [bad[s] / seen[s] for s in seen]
    mean = sum(rates) / len(rates)
    spread = sum((x - mean) ** 2 for x in rates) / len(rates)
    strength = min(1e6, max(1.0, mean * (1 - mean) / spread - 1)) if spread > 1e-9 else 1e6
    for r in got:
        s = table[r.doc_id][1]
        shrunk = (bad[s] + mean * strength) / (seen[s] + strength)
        assert r.kept == (not r.base_failed and shrunk <= rules.MAX_RATE)


@pytest.mark.parametrize("text", ["a a a a", "a b a b a b", "x y z x y z q x y z", "a b c d", "a b", "", None, "\n\n a \n a \na",
                                  " ".join(["k"] * 5000), "é ß ### <b>"])
def test_counts(spark, text):
    got = rules.counts(spark.createDataFrame([(1, text, "s")], "doc_id int, text string, source string")).first()
    assert fields(got) == counted(text)


def test_bad_host_takes_its_documents_along(spark):
    good = " ".join(f"w{i}" for i in range(60))
    data = [(i, good if host != "bad" or i % 10 == 0 else "too few", host) for host in ("a", "b", "c", "bad") for i in range(200)]
    data += [(1000, good, "one"), (1001, "short", "other")]
    got = rules.judge(spark.createDataFrame(data, "doc_id int, text string, source string")).collect()
    assert not any(r.kept for r in got if r.source == "bad")
    assert all(r.kept for r in got if r.source in ("a", "b", "c", "one"))
    assert not next(r for r in got if r.source == "other").kept


def test_edges(spark):
    got = rules.judge(docs(spark)).collect()
    assert len(got) == len(rows())
    by = {r.doc_id: r for r in got}
    for key, text, *_ in rows():
        assert fields(by[key]) == counted(text)
    assert rules.judge(empty(spark)).count() == 0


def test_no_python_in_the_plan(spark, sf_small):
    plan = op8_host_rules(spark, sf_small)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
