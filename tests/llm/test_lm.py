"""Context-tree weighting: the tree against a plain recursion, scores against brute force."""

import math
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from llm_cases import docs, empty, rows, words
from tripmart.llm import lm
from tripmart.llm.catalog import op2_context_tree



def kt(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)


class Plain:
    """The weighted tree by recursion over ``seen`` and ``longer``, nothing pruned."""

    def weighted(self, context, path):
        own = kt(*self.seen[context, path])
        if self.leaf(context):
            return own
        rest = sum(self.weighted(c, path) for c in self.longer[context, path])
        return np.logaddexp(own, rest) - math.log(2)

    def one(self, history, path):
        """Chance of a 1 after the history, by the deepest context that has seen this decision."""
        sure, free, context = 0.0, 1.0, b""
        if (b"", path) not in self.seen:
            return 0.5
        while True:
            a, b = self.seen[context, path]
            p = (b + 0.5) / (a + b + 1)
            if self.leaf(context):
                return sure + free * p
            w = math.exp(kt(a, b) - math.log(2) - self.weighted(context, path))
            nxt = history[len(history) - len(context) - 1:]
            if len(context) == len(history) or (nxt, path) not in self.seen:
                return sure + free * (w * p + (1 - w) * p)
            sure, free, context = sure + free * w * p, free * (1 - w), nxt


def base_scores(texts):
    low = {k: words((t or "").translate({c: c + 32 for c in range(65, 91)})) for k, t in texts.items()}
    train = [k for k in texts if zlib.crc32(str(k).encode()) % 7 != 2]
    c = Counter(w for k in train for w in low[k])
    n, v = sum(c.values()) + len(train), len(c) + (len(train) > 0)
    out = {}
    for k, ws in low.items():
        score = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws) + math.log10((len(train) + 1) / (n + v + 1))
        out[k] = (len(ws) + 1, sum(c[w] > 0 for w in ws) + (len(train) > 0), n, score)
    return out


def test_query(spark, sf_small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    want, got = base_scores(texts), op2_context_tree(spark, sf_small).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:3]
        assert r.base_score == pytest.approx(want[r.doc_id][3])
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
        assert r.score < 0 and 0 < r.bits_per_byte < 8


def test_hot_table_and_join_agree(spark, sf_small):
    """Scores don't depend on which words are broadcast."""
    table = spark.read.parquet(f"{sf_small}/documents.parquet")
    some = {r.doc_id: (r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in lm.score(table, hot=1e-2).collect()}
    many = {r.doc_id: (r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in lm.score(table, hot=1e-7).collect()}
    assert some == many


def test_edges(spark):
    got = lm.score(docs(spark)).collect()
    assert len(got) == len(rows())
    for r in got:
        text = next(x[1] for x in rows() if x[0] == r.doc_id)
        assert r.n_tokens == len(words(text)) + 1
    assert lm.score(empty(spark)).count() == 0
    held = [k for k in range(100) if zlib.crc32(str(k).encode()) % 7 == 2][:3]
    none = lm.score(docs(spark, [(k, "ab cd", "en", "a", 1, "r", "s", "k", "z", "h", 1) for k in held])).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.bits_per_byte == pytest.approx(8.0) for r in none)


class Whole(Plain):
    """The recursion over contexts that run across words, none pruned."""

    def __init__(self, streams, depth):
        self.depth, self.seen, self.longer = depth, defaultdict(lambda: [0, 0]), defaultdict(set)
        for data, c in streams.items():
            for i in range(depth, len(data)):
                for d in range(depth + 1):
                    path = 1
                    for k in range(7, -1, -1):
                        bit = data[i] >> k & 1
                        self.seen[data[i - d:i], path][bit] += c
                        path = path << 1 | bit
        for context, path in self.seen:
            if context:
                self.longer[context[1:], path].add(context)
        self.known = {}

    def leaf(self, context):
        return len(context) == self.depth

    def weighted(self, context, path):
        if (context, path) not in self.known:
            self.known[context, path] = super().weighted(context, path)
        return self.known[context, path]

    def score(self, data):
        total = 0.0
        for i in range(self.depth, len(data)):
            path = 1
            for k in range(7, -1, -1):
                bit = data[i] >> k & 1
                one = self.one(data[i - self.depth:i], path)
                total += math.log10(one if bit else 1 - one)
                path = path << 1 | bit
        return total


def stream(text, depth):
    return b"\n" * (depth - 1) + b" " + b" ".join([*text.encode().lower().split(), b"\n", b""])


def held(key):
    return zlib.crc32(str(key).encode()) % 7 == 2


TEXTS = ["the cat sat at the mat", "that hat, the cat", "Thé thé mât été", "", "a banana a cabana", "zzz catnap hat the", "the cat"] * 4


@pytest.mark.parametrize("depth", [3, 6])
def test_scores_equal_recursion_across_words(spark, depth):
    table = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(3)
    plain = Whole(Counter(stream(t, depth) for k, t in enumerate(TEXTS) if not held(k)), depth)
    assert 0 < sum(map(held, range(len(TEXTS)))) < len(TEXTS)
    for r in lm.score(table, depth=depth).collect():
        assert r.score == pytest.approx(plain.score(stream(TEXTS[r.doc_id], depth)), rel=1e-5)


def test_order_of_words_counts(spark):
    train = [(k, "the cat sat at the mat and that was that") for k in range(60)]
    keys = [k for k in range(100, 200) if held(k)][:2]
    table = spark.createDataFrame([*train, (keys[0], "the cat sat at the mat"), (keys[1], "mat the at sat cat the")],
                                  "doc_id long, text string")
    got = {r.doc_id: r.score for r in lm.score(table).collect()}
    assert got[keys[0]] > got[keys[1]] + 1


def test_rare_contexts_are_kept(spark):
    """A word that is less than three millionths of the bytes still is learned: its chances equal the recursion's."""
    keys = [k for k in range(100) if held(k)][:1]
    table = [(101 + i, t) for i, t in enumerate(["qzxwvkj qzxwvkj", *["aa " * 100_000] * 20])]
    table = [(k, t) for k, t in table if not held(k)] + [(keys[0], "qzxwvkj")]
    assert table[0][1].startswith("q") and sum(len(t) for _, t in table) * 3e-6 > 2
    got = {r.doc_id: r for r in lm.score(spark.createDataFrame(table, "doc_id long, text string")).collect()}
    streams = Counter()
    for _, t in table[:-1]:
        data = stream(t, 6)
        for i in range(6, len(data)) if len(data) < 1000 else ():
            streams[data[i - 6:i + 1]] += 1
        if len(data) >= 1000:  # all its grams, counted
            for i in (*range(6, 15), *range(len(data) - 15, len(data))):
                streams[data[i - 6:i + 1]] += 1
            streams[b"aa aa a"] += (n := len(data) - 30) // 3
            streams[b"a aa aa"] += n // 3
            streams[b" aa aa "] += n // 3
    assert got[keys[0]].score == pytest.approx(Whole(streams, 6).score(stream("qzxwvkj", 6)), rel=1e-4)


@pytest.mark.parametrize("depth", [3, 6])
def test_chances_of_all_bytes_sum_to_one(spark, depth):
    """In every context that training or a held-out text holds, the live path's chances of the 256 bytes sum to 1."""
    texts = [t.encode().lower() + b" \n " for t in TEXTS]
    keys, n = lm.tally([lm.grams(texts[:20], depth)], [np.ones(sum(map(len, texts[:20])), np.int64)])
    contexts = np.unique(np.concatenate([keys, lm.grams(texts[20:] + [b"never seen ", b"the zzz "], depth)]) >> 8)
    all_keys, c = lm.tally([keys, (contexts[:, None] << 8 | np.arange(256)).ravel()],
                           [n, np.zeros(256 * len(contexts), np.int64)])
    table = pa.table({"m": [len(all_keys)], "keys": [lm.squeezed(np.diff(all_keys, prepend=0))], "n": [lm.squeezed(c)]})
    asks = spark.createDataFrame(table.to_pandas().assign(bucket=0, chunk=0))
    cost = lm.gram_costs(all_keys, c, depth, lm.top_of(asks, depth))
    chances = np.add.reduceat(10 ** cost, np.flatnonzero(np.diff(all_keys >> 8, prepend=-1)))
    assert len(chances) == len(contexts) > 50
    assert chances == pytest.approx(np.ones(len(contexts)))


def test_other_depths_are_refused(spark):
    for depth in (0, 2, 7):
        with pytest.raises(ValueError, match="depth"):
            lm.score(docs(spark), depth=depth)


class Plan:
    """Stands for a frame: gives back what would run in its tasks."""

    def select(self, *_):
        return self

    def mapInArrow(self, work, _):
        return work


def test_grams_of_a_chunk_are_added_up_in_parts():
    """4 MB of text of which nearly every gram is new: a task may hold few copies of them at once."""
    rng = random.Random(5)
    texts = [b" ".join(bytes(rng.choices(b"etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(2000)) + b" \n " for _ in range(300)]
    size = [len(t) for t in texts]
    batch = pa.RecordBatch.from_pydict({"chunk": [0], "held_out": [[i % 7 == 2 for i in range(len(texts))]], "size": [size],
                                        "data": [pa.compress(b"".join(texts), "zstd", asbytes=True)]})
    tracemalloc.start()
    try:
        asked = list(lm.asked(Plan(), 6, 16)(iter([batch])))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 40 * sum(size)
    keys, n = lm.tally(*lm._of_bucket(pa.Table.from_batches(asked)))
    wanted = Counter(lm.grams(texts, 6).tolist())
    trained = Counter(lm.grams([t for i, t in enumerate(texts) if i % 7 != 2], 6).tolist())
    assert keys.tolist() == sorted(wanted) and n.tolist() == [trained[k] for k in keys.tolist()]
    assert sum(b.num_rows for b in asked) == 16  # one row for each bucket
