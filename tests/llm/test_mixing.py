"""Mixing: targets by brute force, and what dependent rounding promises."""

import pytest

from llm_cases import docs, empty, rows, words
from tripmart.llm import mixing
from tripmart.llm.catalog import op3_mixing


def shared_out(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    whole, full = sum(sizes.values()), set()
    while True:
        rest, left = whole - sum(most * sizes[s] for s in full), sum(weight[s] for s in names if s not in full)
        target = {s: float(most * sizes[s]) if s in full else rest * weight[s] / left for s in names}
        more = {s for s in names if target[s] > most * sizes[s]} - full
        if not more:
            return target
        full |= more


def test_query(spark, sf_small):
    table = {r.doc_id: r for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    got = op3_mixing(spark, sf_small).collect()
    assert len(got) == len(table)
    sizes = {}
    for r in table.values():
        sizes[r.source] = sizes.get(r.source, 0) + len(words(r.text))
    want, taken = shared_out(sizes), dict.fromkeys(sizes, 0)
    for r in got:
        d = table[r.doc_id]
        assert r.size == len(words(d.text)) and r.source_size == sizes[d.source]
        assert r.target == pytest.approx(want[d.source])
        mean = want[d.source] / sizes[d.source]
        assert r.copies in (int(mean), int(mean) + 1) and r.taken == r.copies * r.size <= 3 * r.size
        taken[d.source] += r.taken
    for s in sizes:
        largest = max(len(words(r.text)) for r in table.values() if r.source == s)
        assert abs(taken[s] - want[s]) <= largest
    again = op3_mixing(spark, sf_small).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_capped_sources_are_taken_three_times(spark):
    data = [(i, "w " * 10, "a" if i < 3 else "b") for i in range(60)]
    got = mixing.copies(spark.createDataFrame(data, "doc_id int, text string, source string"), weights=(50, 1)).collect()
    assert all(r.copies == 3 and r.target == 90.0 for r in got if r.source == "a")
    assert sum(r.taken for r in got if r.source == "b") == 600 - 90


def test_many_levels_keep_the_words(spark):
    """Groups of 4: five levels; every source ends within half of its largest document."""
    data = [(i, "w " * (1 + i * 7 % 23), f"s{i % 3}") for i in range(1500)]
    got = mixing.copies(spark.createDataFrame(data, "doc_id int, text string, source string"), group=4).collect()
    for s in ("s0", "s1", "s2"):
        own = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 12
        assert {r.copies for r in own} <= {int(own[0].target / own[0].source_size), int(own[0].target / own[0].source_size) + 1}


def test_means_are_kept(spark):
    """Over seeds a document is taken as often as its source's share asks for."""
    data = [(i, "w " * (1 + i % 5), "ab"[i % 2]) for i in range(40)]
    table = spark.createDataFrame(data, "doc_id int, text string, source string")
    total = dict.fromkeys(range(40), 0)
    for seed in range(12):
        for r in mixing.copies(table, seed=seed).collect():
            total[r.doc_id] += r.copies / 12
            mean = r.target / r.source_size
    by = {0: [], 1: []}
    for i, n in total.items():
        by[i % 2].append(n)
    assert abs(sum(by[0]) / 20 - 2 * 5 / 7) < 0.15 and abs(sum(by[1]) / 20 - 2 * 2 / 7) < 0.15


def test_edges(spark):
    got = mixing.copies(docs(spark)).collect()
    assert len(got) == len(rows())
    same = [r for r in got if r.doc_id == 6]
    assert len(same) == 2 and same[0] == same[1]
    assert {r.size for r in got if r.doc_id in (2, 3, 4)} == {0}
    assert mixing.copies(empty(spark)).count() == 0
    mixed = mixing.mix(docs(spark))
    assert mixed.columns == docs(spark).columns
    assert mixed.count() == sum(r.copies for r in got)
    assert mixing.mix(empty(spark)).count() == 0


def test_no_python_in_the_plan(spark, sf_small):
    plan = op3_mixing(spark, sf_small)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_repeated_rows_meet_their_target(spark):
    """A source of one row repeated 1,000 times, and one of a repeated and many other rows."""
    text = "one two three four five six seven eight nine ten"
    data = [(1, text, "en", "a")] * 1000 + [(2, text, "en", "b")] * 300 + [(i, f"{text} {text}", "en", "b") for i in range(10, 400)]
    data += [(i, text * 3, "en", "c") for i in range(1000, 1400)]
    frame = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    got = mixing.copies(frame).collect()
    assert len(got) == len(data)
    for source in "abc":
        own = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 30 and max(r.taken / r.size for r in own) <= 3
    mixed = {r.source: r["count"] for r in mixing.mix(frame.where("source <> 'b'")).groupBy("source").count().collect()}
    whole = mixing.copies(frame.where("source <> 'b'")).groupBy("source").sum("copies").collect()
    assert all(abs(mixed[r.source] - r["sum(copies)"]) < 100 for r in whole)


def test_hot_rows_are_dealt_out(spark):
    counted = spark.createDataFrame([(1, "a", 5, 10), (2, "a", 5, 1), (None, None, 0, 4)], "_key long, _source string, _size long, _m long")
    got = sorted(map(str, mixing.each_row(counted, run=4).select("_key", "_copy").collect()))
    assert got == sorted([f"Row(_key={k}, _copy={i})" for k, m in ((1, 10), (2, 1), (None, 4)) for i in range(m)])
