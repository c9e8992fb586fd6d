"""The pipeline's stages one after the other, each against its operator or brute force."""

from collections import Counter

from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from llm_cases import docs, empty, words
from test_minhash import expected
from tripmart.llm import quality, toxicity
from tripmart.llm.catalog import tokenizer_file
from tripmart.llm.common import stored, table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    library = Tokenizer.from_file(tokenizer_file())
    names = [n for n, _ in pipeline.STAGES]
    assert len(names) == 5
    rows, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    columns = rows.columns
    stage = dict(pipeline.STAGES)

    good = stored(stage[names[0]](spark, rows, SF), "t")
    verdict = {r.doc_id: r.kept for r in quality.score(rows, labels).collect()}
    assert good.columns == columns and {r.doc_id for r in good.collect()} == {k for k, v in verdict.items() if v}

    clean = stored(stage[names[1]](spark, good, SF), "t")
    score = {r.doc_id: r.score for r in toxicity.score(good, labels).collect()}
    assert clean.columns == columns and {r.doc_id for r in clean.collect()} == {k for k, s in score.items() if s < 0.5}

    single = stored(stage[names[2]](spark, clean, SF), "t")
    classes = expected({r.doc_id: r.text for r in clean.collect()})
    assert single.columns == columns and {r.doc_id for r in single.collect()} == set(classes.values())

    mixed = stored(stage[names[3]](spark, single, SF), "t")
    assert mixed.columns == columns
    taken, before = Counter(r.doc_id for r in mixed.collect()), {r.doc_id: r for r in single.collect()}
    assert set(taken) <= set(before) and max(taken.values()) <= 3
    whole = sum(len(words(r.text)) for r in before.values())
    assert abs(sum(n * len(words(before[k].text)) for k, n in taken.items()) - whole) < 0.15 * whole

    encoded = stage[names[4]](spark, mixed, SF).collect()
    assert Counter(r.doc_id for r in encoded) == taken
    for r in encoded:
        assert list(r.ids) == library.encode(before[r.doc_id].text or "", add_special_tokens=False).ids


def test_stages_take_awkward_rows(spark):
    for rows in (docs(spark), empty(spark)):
        for name, stage in pipeline.STAGES:
            out = stored(stage(spark, rows, SF), "t")
            if name != pipeline.STAGES[-1][0]:
                assert out.columns == rows.columns, name
            rows = out


def test_run_is_the_registered_query(spark):
    import __spark_entry__

    got = __spark_entry__.queries()["pipeline"](spark, SF)
    assert got.columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"] and got.count() > 0
