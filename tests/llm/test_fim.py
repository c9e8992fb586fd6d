"""Fill-in-the-middle against a plain reading of its definition, and exact round trips."""

import hashlib
import random
import re

import numpy as np
from llm_cases import LONG, docs, empty, rows
from tripmart.llm import fim
from tripmart.llm.catalog import op11_fim


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(key, text, seed=7, fim_percent=100, spm_percent=50):
    t = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", t)
    x = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(x[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(lines)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= fim_percent:
        return n, "plain", None, None, t
    if h4 % 100 < spm_percent:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def test_query_equals_plain_reading(spark, sf_small):
    table = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    got = op11_fim(spark, sf_small).collect()
    assert len(got) == len(table)
    for r in got:
        n, form, a, b, out = expected(r.doc_id, table[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256) == (n, form, a, b, sha(out))
        assert r.restored_sha256 == sha(table[r.doc_id] or "")


AWKWARD = ["\n", "\n\n\n", "a", "a\n", "\na", "é\n漢\n𝄞\n", "x" * 7 + "\n" + "y" * 8 + "\n", "\x0b\x00\n\x8a\x0a", "<P>\nb", "a<\nS>\nb<", "<\n<S", "S>\n<P",
           "Ċ\nਊ\n", "<S\n>\n", LONG, ("zeile ü\n" * 40_000), "no feed " * 5000]


def test_awkward_texts(spark):
    data = [(i, t, "en", "a", 1, "r", "s", "k", "z", "h", 1) for i, t in enumerate(AWKWARD * 5)]
    got = fim.transform(docs(spark, data)).collect()
    assert len(got) == len(data)
    for r in got:
        n, form, a, b, out = expected(r.doc_id, AWKWARD[r.doc_id % len(AWKWARD)])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == (n, form, a, b, out)
    back = {r.doc_id: r.text for r in fim.restore(fim.transform(docs(spark, data))).collect()}
    assert back == {d[0]: d[1] for d in data}


def test_edges(spark):
    got = fim.transform(docs(spark)).collect()
    assert sorted((str(r.doc_id), r.form) for r in got) == sorted((str(r[0]), expected(r[0], r[1])[1]) for r in rows())
    assert {r.form for r in got if r.doc_id in (2, 3)} == {"plain"}
    assert len({tuple(r) for r in got if r.doc_id == 6}) == 1
    assert fim.transform(empty(spark)).count() == 0


def test_rates(spark):
    data = [(i, f"a{i}\nb\nc\nd", "en", "a", 1, "r", "s", "k", "z", "h", 1) for i in range(400)]
    got = fim.transform(docs(spark, data), seed=3, fim_percent=30, spm_percent=0).collect()
    assert [(r.form, r.output) for r in sorted(got, key=lambda r: r.doc_id)] == [
        expected(d[0], d[1], 3, 30, 0)[1::3] for d in data]
    assert {r.form for r in got} == {"plain", "psm"}


def test_marks_by_brute_force():
    rng = random.Random(5)
    for _ in range(200):
        data = np.array(rng.choices([10, 0, 11, 0x8A, 0x0A ^ 0x80, 65, 0xC3, 0xA9], k=rng.randrange(0, 90)), np.uint8)
        words = fim._words(data)
        for marks, places in ((fim.line_feeds(words), np.flatnonzero(data == 10)),
                              (fim.code_points(words), np.flatnonzero((data & 0xC0) != 0x80))):
            at = np.arange(len(data) + 1)
            assert marks.rank(at).tolist() == np.searchsorted(places, at).tolist()
            k = np.arange(1, len(places) + 1)
            assert marks.select(k).tolist() == places.tolist()
