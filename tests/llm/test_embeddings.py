"""Near-duplicate vectors against all pairs."""

import math

import numpy as np

from tripmart.llm import embeddings
from tripmart.llm.catalog import op9_embeddings
from tripmart.llm.graph import components

SCHEMA = "vec_id long, embedding array<float>, label int, id string, unit string"


def expected(table, least=0.93):
    """key -> (links, component); rows of a key count once per distinct vector."""
    ok = {}
    for key, v, label in table:
        if key is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = np.asarray(v, np.float32).astype(float)
        if np.abs(v).max() > 0:
            ok[key] = (label, v / np.linalg.norm(v / np.abs(v).max()) / np.abs(v).max())
    keys = sorted(ok)
    links, comp = dict.fromkeys((k for k, *_ in table), 0), {k: k for k, *_ in table}
    near = {k: [j for j in keys if j != k and ok[j][0] == ok[k][0] and len(ok[j][1]) == len(ok[k][1])
                and float(ok[j][1] @ ok[k][1]) >= least] for k in keys}
    for k in keys:
        links[k] = len(near[k])
    changed = True
    while changed:
        changed = False
        for k in keys:
            m = min([comp[k], *(comp[j] for j in near[k])])
            changed |= m < comp[k]
            comp[k] = m
    return {k: (links[k], comp[k]) for k in links}


def clouds(seed=2, size=24):
    """Noise around centres at many distances of the threshold, equal vectors, and strangers."""
    rng, out = np.random.default_rng(seed), []
    for label in (0, 1):
        for noise, n in ((0.05, 60), (0.2, 40), (0.3, 30), (0.45, 30)):
            centre = rng.standard_normal(size)
            centre /= np.linalg.norm(centre)
            for _ in range(n):
                v = rng.standard_normal(size)
                out.append((centre + noise * v / np.linalg.norm(v)).tolist() + [label])
        out += [rng.standard_normal(size).tolist() + [label] for _ in range(60)]
        out += [out[5]] * 20
    return [(i, [float(np.float32(x)) for x in v[:-1]], int(v[-1])) for i, v in enumerate(out)]


def frame(spark, table):
    return spark.createDataFrame([(*r, "i", "u") for r in table], SCHEMA)


def test_query_equals_all_pairs(spark, sf_small):
    table = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf_small}/embeddings.parquet").collect()]
    got = {r.vec_id: (r.n_links, r.component_id) for r in op9_embeddings(spark, sf_small).collect()}
    assert got == expected(table)


def test_clouds_balls_and_borders(spark):
    table = clouds()
    want = expected(table)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.link(frame(spark, table)).collect()}
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert {k: v[1] for k, v in got.items()} == {k: v[1] for k, v in want.items()}
    assert all(v[2] == (v[1] == k) for k, v in got.items())


def test_calibration():
    for angle, signs in ((0.37, 8), (0.7, 5), (0.37, 0)):
        s = embeddings.calibrate(angle, signs, 3, 0.9999)
        p = (1 - angle / math.pi) ** signs * math.erf(1.5 / math.sqrt(2))
        missed = sum(math.comb(s.lists, i) * p ** i * (1 - p) ** (s.lists - i) for i in range(s.count))
        assert missed <= 1e-4


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    table = [(1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [0.0, 0.0], 0), (4, None, 0), (5, [1.0, None], 0),
             (6, [nan, 1.0], 0), (7, [inf, 1.0], 0), (8, [1.0, 0.0], None), (9, [1.0, 0.0], 1), (10, [], 0),
             (11, [1.0, 0.0, 0.0], 0), (12, [-1.0, 0.0], 0), (13, [1e-30, 0.0], 0), (14, [1e30, 1e28], 0), (1, [1.0, 0.0], 0)]
    got = embeddings.link(frame(spark, table)).collect()
    assert len(got) == len(table)
    want = expected(table)
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
    assert want[1] == (3, 1) and want[11] == (0, 11)
    assert embeddings.link(frame(spark, table).where("vec_id < 0")).count() == 0
    lost = embeddings.link(spark.createDataFrame([(None, [1.0], 1, "a", "b")], SCHEMA)).first()
    assert lost.vec_id is None and lost.n_links == 0 and lost.kept


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 101), (101, 100), (7, 7), (200, 100), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == dict.fromkeys(range(51), 0) | {100: 100, 101: 100, 200: 100}
    star = [(0, i) for i in range(1, 3000)]
    got = components(spark.createDataFrame(star, "a long, b long"))
    assert got.where("component = 0").count() == 3000
