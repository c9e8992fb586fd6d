"""Token files: round trip, index, dictionary."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm_cases import docs, empty, rows
from tripmart.llm import tokenfile
from tripmart.llm.catalog import op4_token_files, tokenizer_file


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [2]


def test_query(spark, sf_small):
    library = Tokenizer.from_file(tokenizer_file())
    table = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect())
    got = {r.doc_id: r for r in op4_token_files(spark, sf_small).collect()}
    start = 0
    for key, text in table:
        ids = ids_of(library, text)
        r = got[key]
        assert (r.start, r.n_tokens) == (start, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert len(got) == len(table)


def test_small_blocks_many_parts_and_fetch(spark, sf_small, tmp_path, monkeypatch):
    monkeypatch.setattr(tokenfile, "BLOCK_BYTES", 2000)
    library = Tokenizer.from_file(tokenizer_file())
    table = spark.read.parquet(f"{sf_small}/documents.parquet").repartition(5)
    path = str(tmp_path / "files")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # or small parts are put together
    try:
        tokenfile.write(table, path, tokenizer_file())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    blocks = spark.read.parquet(f"{path}/blocks").collect()
    assert len(blocks) > 30 and len({b.part for b in blocks}) > 1
    for b in blocks:
        assert len(b.keys) == len(b["counts"]) == len(b.offsets) - 1 and b.offsets[-1] == len(b.payload)
        assert b.first_key == b.keys[0] and b.last_key == b.keys[-1] and list(b.keys) == sorted(b.keys)
    dictionary = spark.read.parquet(f"{path}/dictionary").first()
    assert {b.dictionary for b in blocks} == {dictionary.sha256} and len(dictionary.bytes) > 0
    texts = {r.doc_id: r.text for r in table.collect()}
    back = tokenfile.fetch(spark, path, [3, 77, 199]).collect()
    assert sorted(r.key for r in back) == [3, 77, 199]
    for r in back:
        assert np.frombuffer(r.ids, "<u4").tolist() == ids_of(library, texts[r.key])


def test_wrong_dictionary_is_refused(spark, tmp_path):
    path = str(tmp_path / "files")
    tokenfile.write(docs(spark).where("doc_id < 4"), path, tokenizer_file())
    blocks = spark.read.parquet(f"{path}/blocks").withColumn("dictionary", F.lit("other"))
    with pytest.raises(Exception, match="another dictionary"):
        tokenfile._unpack(spark, path, blocks).collect()


def test_edges(spark, tmp_path):
    library = Tokenizer.from_file(tokenizer_file())
    path = str(tmp_path / "files")
    tokenfile.write(docs(spark), path, tokenizer_file())
    got = sorted(tokenfile.read(spark, path).collect(), key=lambda r: r.start)
    assert [r.key for r in got] == sorted((r[0] for r in rows()), key=lambda k: (k is not None, k or 0))
    at = 0
    for r in got:
        text = next(x[1] for x in rows() if x[0] == r.key)
        ids = ids_of(library, text)
        assert r.start == at and np.frombuffer(r.ids, "<u4").tolist() == ids
        at += len(ids)
    empty_path = str(tmp_path / "none")
    tokenfile.write(empty(spark), empty_path, tokenizer_file())
    assert tokenfile.read(spark, empty_path).count() == 0


def test_encoder_equals_library():
    raw = open(tokenizer_file(), "rb").read()
    own, library = tokenfile.LibraryEncoder(raw), Tokenizer.from_file(tokenizer_file())
    for text in ("", "Don't  stop12!!", "é é ÄÖ ß", "日本語 x", "<|endoftext|>x <|", "a\x1cb\u0085c", "'s's 'll", "x" * 3000, "ΑΣ İ"):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_every_byte_and_random_texts_equal_library():
    raw = open(tokenizer_file(), "rb").read()
    own, library = tokenfile.LibraryEncoder(raw), Tokenizer.from_file(tokenizer_file())
    rng = random.Random(11)
    texts = [f(chr(i)) for i in range(256) for f in (str, lambda c: f"a{c}b", lambda c: f" {c} x{c}", lambda c: c * 3)]
    texts += ["".join(chr(rng.randrange(rng.choice([0x80, 0x250]))) for _ in range(rng.randrange(1, 12))) for _ in range(20_000)]
    want = library.encode_batch(texts, add_special_tokens=False)
    wrong = [t for t, w in zip(texts, want) if np.frombuffer(own.encode(t), "<u4").tolist() != w.ids]
    assert wrong == []


@pytest.mark.parametrize("text", ["word%d or two ", "a much longer line of text number %d that goes on "])
def test_dictionary_at_any_length(spark, text):
    raw = open(tokenizer_file(), "rb").read()
    make = lambda n, times: spark.createDataFrame(
        [(i, "".join(text % ((i * 7 + j) % 50) for j in range(times))) for i in range(n)], "doc_id long, text string")
    assert len(tokenfile.train_dictionary(make(60, 2000), raw)) > 0  # long texts only
    assert len(tokenfile.train_dictionary(make(300, 3), raw)) > 0  # short texts only
    assert tokenfile.train_dictionary(make(3, 1), raw) == b""
