"""BPE by prefixes against the tokenizers library."""

import hashlib
import random

import pytest
from tokenizers import Tokenizer

from tripmart.llm import bpe
from tripmart.llm.catalog import op1_bpe, tokenizer_file


@pytest.fixture(scope="module")
def pair():
    path = tokenizer_file()
    return bpe.Encoder(bpe.read_file(path)), Tokenizer.from_file(path)


ALPHABETS = ["abc", "aA", "the nd", "ab!'s", "éèßñ ", "ΑΣ x", "日本語 x", "!!!! ", "'re'll t", "0123 ",
             "  \u0085\x1c.", "İ ıſK", "é ", "<|endoftext|> a<|", "\U0001f600‍ "]


def test_random_texts_equal_library(pair):
    own, library = pair
    rng = random.Random(5)
    for _ in range(4000):
        letters = rng.choice(ALPHABETS)
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 30)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.ids(text) == ids, text
        assert own.digest(text)[2] == library.decode(ids, skip_special_tokens=False), text


@pytest.mark.parametrize("text", ["", " \n\t", "a" * 30_000, "!" * 5_000, "é" * 3_000,
                                  "<|endoftext|>x<|startoftext|>", "<|endoftext|", "x\x1cy"])
def test_edges_equal_library(pair, text):
    own, library = pair
    assert own.ids(text) == library.encode(text, add_special_tokens=False).ids


def test_neighbours_are_judged_like_merging(pair):
    own, library = pair
    rng = random.Random(9)
    tokens = [t for t in own.vocabulary.parts if not own.vocabulary.text[t].endswith("</w>")]
    ends = [t for t in own.vocabulary.parts if own.vocabulary.text[t].endswith("</w>")]
    for _ in range(3000):
        left, right = rng.choice(tokens), rng.choice(ends)
        word = (own.vocabulary.text[left] + own.vocabulary.text[right]).removesuffix("</w>")
        if word.isascii() and word.isalpha() and word == word.lower():
            ids = library.encode(word, add_special_tokens=False).ids
            assert own.vocabulary.encode_word(word) == ids


def test_operator_rows_and_round_trip(spark):
    rows = [(1, "The  thing's 12", "x"), (2, None, "x"), (3, "", None), (3, "again", "y"), (None, "nul key", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    library = Tokenizer.from_file(tokenizer_file())
    out = bpe.encode(docs, tokenizer_file()).collect()
    assert len(out) == len(rows)
    by = {(r.doc_id, r.decoded): r for r in out}
    for key, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        r = by[key, back]
        assert list(r.ids) == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
    encoded = bpe.encode(docs, tokenizer_file())
    again = bpe.decode(encoded.drop("decoded"), tokenizer_file())
    assert sorted(r.decoded for r in again.collect()) == sorted(r.decoded for r in out)
    assert bpe.encode(docs.limit(0), tokenizer_file()).count() == 0


def test_query_over_the_whole_table(spark, sf_small):
    library = Tokenizer.from_file(tokenizer_file())
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    out = op1_bpe(spark, sf_small).collect()
    assert len(out) == len(texts)
    for r in out:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        back = library.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
