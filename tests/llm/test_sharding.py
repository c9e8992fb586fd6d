"""Stratified interleaving against its plain reading."""

import hashlib
import zlib
from collections import Counter, defaultdict

from llm_cases import docs, empty, rows
from tripmart.llm import sharding
from tripmart.llm.catalog import op6_sharding


def number(seed, key):
    return int(hashlib.md5(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:15], 16)


def expected(table, shards, seed):
    """(key, source, text) -> (shard, slot), by sorting everything."""
    by = defaultdict(list)
    for key, text, source in table:
        by[source].append((number(seed, key), key, zlib.crc32(text.encode()), len(text.encode()) + 1))
    order = []
    for source, own in by.items():
        own.sort()
        order += [((2 * r + 1) / (2 * len(own)), source is None, source or "", *x) for r, x in enumerate(own)]
    order.sort()
    n, out = len(order), {}
    for i, x in enumerate(order):
        shard = i * shards // n
        out[x[4]] = (shard, i - (shard * n + shards - 1) // shards)
    return out


def test_query_equals_plain_reading(spark, sf_small):
    table = [(r.doc_id, r.text or "", r.source) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    want = expected(table, 8, sharding.SEED)
    got = op6_sharding(spark, sf_small).collect()
    assert {r.doc_id: (r.shard, r.slot) for r in got} == want
    texts = {k: t for k, t, _ in table}
    assert all(r.size == len(texts[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in got)


def test_runs_do_not_change_the_result(spark, sf_small):
    table = spark.read.parquet(f"{sf_small}/documents.parquet")
    wide = {r.doc_id: (r.shard, r.slot) for r in sharding.assign(table).collect()}
    narrow = {r.doc_id: (r.shard, r.slot) for r in sharding.assign(table, run=7).collect()}
    assert wide == narrow


def test_hot_source_and_mixture(spark):
    data = [(i, f"t{i}", "en", "hot" if i % 3 else f"s{i % 7}", 1, "r", "s", "k", "z", "h", 1) for i in range(2000)]
    got = sharding.assign(docs(spark, data), run=50).collect()
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    sources = {r.source for r in got}
    for source in sources:  # a cut may fall anywhere among the sources' rows of equal rank
        per = Counter(r.shard for r in got if r.source == source)
        assert max(per.values()) - min(per[s] for s in range(8)) <= len(sources)


def test_edges(spark):
    got = sharding.assign(docs(spark), shards=3).collect()
    assert len(got) == len(rows())
    for s in {r.shard for r in got}:
        own = sorted(r.slot for r in got if r.shard == s)
        assert own == list(range(len(own)))
    assert {r.size for r in got if r.doc_id in (2, 3)} == {1}
    assert sharding.assign(empty(spark)).count() == 0


def test_written_shards(spark, tmp_path):
    back = sharding.write(docs(spark), str(tmp_path / "shards"), shards=2).collect()
    assert sorted((str(r.doc_id), r.text or "") for r in back) == sorted((str(r[0]), r[1] or "") for r in rows())


def test_ties_are_spread_over_tasks(spark, monkeypatch):
    """50,000 sources of one row (all of fractional rank 1/2) and a key that a third of all rows repeat: no range holds much
    more than its share, and the result is the plain reading's."""
    n = 50_000
    one = spark.range(n).selectExpr("id AS doc_id", "concat('s', id) AS source", "concat('t', id) AS text")
    same = spark.range(n // 2).selectExpr("-1L AS doc_id", "'hot' AS source", "'same' AS text")
    ranges, ranked = [], sharding.stored

    def seen(df, name):
        out = ranked(df, name)
        if "_range" in out.columns:
            ranges.append([r["count"] for r in out.groupBy("_range").count().collect()])
        return out

    monkeypatch.setattr(sharding, "stored", seen)
    got = sharding.assign(one.unionByName(same), run=5000).collect()
    assert len(ranges) == 2 and all(len(r) >= 12 and max(r) < 3 * 5000 for r in ranges)
    want = expected([(i, f"t{i}", f"s{i}") for i in range(n)] + [(-1, "same", "hot")] * (n // 2), 8, sharding.SEED)
    assert all((r.shard, r.slot) == want[r.doc_id] for r in got if r.doc_id >= 0)
    assert sorted(Counter(r.shard for r in got).values()) == [n * 3 // 16] * 8
