"""Token files: each document's ids, compressed on their own with one shared zstandard dictionary.

Layout of a file set (a folder; every table is written and read by Spark, on any file system it
knows, so a failed or repeated task leaves no half-written file behind):

* ``dictionary``: one row with the dictionary's bytes and their sha256. It is trained on the ids of a
  bounded sample of documents (``sample`` rows of at most ``sample_bytes`` bytes of text each, by
  seeded number).
* ``blocks``: rows of about ``block_bytes`` compressed bytes, in key order. A block has the keys and
  id counts of its documents, the offset index (``offsets[i]`` to ``offsets[i + 1]`` is document
  i's frame in ``payload``), the number of ids before it in its part, and the dictionary's sha256.
* ``parts``: for every part its documents, its ids, and the ids of all parts before it.

One document is read by its block's key range, its offsets and one small frame: :func:`fetch`.

Cases: a null text has no ids but the end id; null keys come first; rows that repeat a key are
written one after the other (by text); an empty table gives an empty file set; other columns are
not read. A text of any length is one frame in one block.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.bpe import SPLIT, UNCOMMON, byte_letters, read_file
from tripmart.llm.common import running_before, scratch_path, seeded, unit

END_ID = 2
SAMPLE, SAMPLE_CHARS, PIECE_BYTES, LEAST_PIECES = 1000, 8_192, 8_192, 8
DICTIONARY_BYTES, BLOCK_BYTES, SEED, LEVEL = 65_536, 1 << 20, 41, 3
CACHE = 150_000
#: ASCII letters that str.split() takes for white space and the tokenizer file does not.
SEPARATORS = "\x1c\x1d\x1e\x1f"


class LibraryEncoder(dict):
    """Whole texts to ids (32 bit, in the machine's order, which the format takes to be little-endian)
    by the tokenizers library. Texts are split as the file says; pieces are looked up, and only unknown
    ones go to the library's model."""

    def __init__(self, raw: bytes):
        import regex
        from tokenizers import Tokenizer

        super().__init__()
        self.library = Tokenizer.from_str(raw.decode("utf-8"))
        self.library.no_truncation()
        self.library.no_padding()
        self.tokenize = self.library.model.tokenize
        self.special = re.compile("|".join(re.escape(t.content) for t in self.library.get_added_tokens_decoder().values()) or "(?!)")
        self.split, self.letters, self.older = regex.compile(SPLIT).findall, byte_letters(), {}

    def __missing__(self, chunk: str) -> bytes:
        if not chunk.isalpha():
            if chunk[:-1].isalpha():  # letters and one other character
                return self[chunk[:-1]] + self[chunk[-1]]
            pieces = self.split(chunk)
            if len(pieces) != 1:
                return b"".join(map(self.__getitem__, pieces))
        made = self.older.get(chunk)
        if made is None:
            # Control characters and those beyond ASCII are not their own letters.
            piece = chunk if chunk.isascii() and chunk.isprintable() else "".join(map(self.letters.__getitem__, chunk.encode("utf-8")))
            made = array("I", [t.id for t in self.tokenize(piece)]).tobytes()
        if len(chunk) <= 64:
            if len(self) >= CACHE:
                self.older = dict(self)
                self.clear()
            self[chunk] = made
        return made

    def encode(self, text: str) -> bytes:
        plain = text.isascii()
        odd = any(c in text for c in SEPARATORS) if plain else UNCOMMON.search(text)
        if odd or "<|" in text and self.special.search(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if not plain and not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        return b"".join(map(self.__getitem__, text.lower().split()))


_ENCODERS: dict[int, LibraryEncoder] = {}


def _encoder(raw: bytes) -> LibraryEncoder:
    if hash(raw) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[hash(raw)] = LibraryEncoder(raw)
    return _ENCODERS[hash(raw)]


def train_dictionary(docs: DataFrame, raw: bytes, text: str = "text", key: str = "doc_id") -> bytes:
    """The dictionary, from at most ``SAMPLE`` seeded rows of any length: of a text longer than ``SAMPLE_CHARS`` a seeded
    stretch of that many code points, all serialized ids cut into pieces of ``PIECE_BYTES``. Empty bytes (plain frames) only if
    there are fewer than ``LEAST_PIECES`` pieces in all, or if they have nothing in common to train on."""
    import zstandard

    some = docs.where(F.octet_length(text) > 0).select(F.col(text).alias("t"), seeded(SEED, F.col(key)).alias("h"),
                                                     unit(seeded(SEED + 1, F.col(key))).alias("u"))
    part = 1.5 * SAMPLE / max(1, docs.count())  # so that tasks don't send a whole sample each
    start = F.floor(F.col("u") * F.greatest(F.length("t") - SAMPLE_CHARS, F.lit(0))).cast("int") + 1
    rows = some.where(unit(F.col("h")) < part).select("h", F.substring("t", start, F.lit(SAMPLE_CHARS)).alias("t"))
    encoder = LibraryEncoder(raw)
    samples = []
    for r in rows.orderBy("h", "t").limit(SAMPLE).select("t").collect():
        ids = encoder.encode(r.t)
        samples += [ids[i:i + PIECE_BYTES] for i in range(0, len(ids), PIECE_BYTES)]
    if len(samples) < LEAST_PIECES:
        return b""
    size = min(DICTIONARY_BYTES, max(1024, sum(map(len, samples)) // 10))
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _zstd(dictionary: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def write(docs: DataFrame, path: str, tokenizer: str, key: str = "doc_id", text: str = "text",
          end_id: int | None = END_ID) -> None:
    """Writes the file set of all rows in key order.

    One shuffle: rows are dealt out by key range and sorted; each task encodes, compresses and packs
    its range. Ties of a key are dealt by text hash, and repeated rows, which nothing tells apart, by
    their place in the input, so no range must hold all copies of one row.
    """
    import zstandard  # noqa: F401

    spark = docs.sparkSession
    raw_bytes = read_file(tokenizer)
    dictionary = train_dictionary(docs, raw_bytes, text, key)
    digest = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(digest, bytearray(dictionary), hashlib.sha256(raw_bytes).hexdigest(), end_id)],
                          "sha256 string, bytes binary, tokenizer_sha256 string, end_id int").coalesce(1).write.parquet(f"{path}/dictionary")
    raw, shared = spark.sparkContext.broadcast(raw_bytes), spark.sparkContext.broadcast(dictionary)
    end = np.array([] if end_id is None else [end_id], "<u4").tobytes()
    kind = docs.schema[key].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        encoder = _encoder(raw.value)
        compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=_zstd(shared.value)).compress
        part, first = TaskContext.get().partitionId(), 0
        keys, counts, frames = [], [], []

        def block():
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in frames])]).astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([first], pa.int64()), pa.array([sum(counts)], pa.int64()),
                 pa.array([keys], pa.list_(key_type)), pa.array([counts], pa.list_(pa.int64())),
                 pa.array([offsets.tolist()], pa.list_(pa.int64())), pa.array([b"".join(frames)], pa.binary()),
                 pa.array([digest], pa.string())],
                ["part", "first", "ids", "keys", "counts", "offsets", "payload", "dictionary"])

        size, key_type = 0, None
        for batch in batches:
            key_type = batch.column(0).type
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                for k, t in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    ids = encoder.encode(t or "") + end
                    frame = compress(ids)
                    if frames and size + len(frame) > BLOCK_BYTES:
                        yield block()
                        first += sum(counts)
                        keys, counts, frames, size = [], [], [], 0
                    keys.append(k)
                    counts.append(len(ids) // 4)
                    frames.append(frame)
                    size += len(frame)
        if frames:
            yield block()

    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    rows = rows.withColumn("h", F.xxhash64("t")).withColumn("i", F.monotonically_increasing_id())
    rows = rows.repartitionByRange("k", "h", "i").sortWithinPartitions("k", "h", "i").select("k", "t")
    blocks = rows.mapInArrow(pack, f"part bigint, first bigint, ids bigint, keys array<{kind}>, counts array<bigint>, "
                                   "offsets array<bigint>, payload binary, dictionary string")
    blocks = blocks.withColumn("first_key", F.get("keys", F.lit(0))).withColumn("last_key", F.element_at("keys", -1)) \
        if kind != "void" else blocks
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")
    written = spark.read.parquet(f"{path}/blocks")
    parts = written.groupBy("part").agg(F.sum(F.size("keys")).alias("documents"), F.sum("ids").alias("ids"))
    running_before(parts, "part", "ids").withColumnRenamed("before", "first_id").write.parquet(f"{path}/parts")


def read(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """``key, start, n_tokens, ids_crc32`` of every document, and its ``ids`` (binary, little-endian
    32 bit) unless only the digests are asked for."""
    return _unpack(spark, path, spark.read.parquet(f"{path}/blocks"), with_ids=with_ids)


def fetch(spark: SparkSession, path: str, keys: list) -> DataFrame:
    """The documents of some keys: only blocks whose key range holds one are read, and only the
    frames of those documents are decompressed."""
    blocks = spark.read.parquet(f"{path}/blocks")
    hit = F.lit(False)
    for k in keys:
        hit = hit | F.lit(k).between(F.col("first_key"), F.col("last_key"))
    return _unpack(spark, path, blocks.where(hit), set(keys))


def _unpack(spark: SparkSession, path: str, blocks: DataFrame, only: set | None = None, with_ids: bool = True) -> DataFrame:
    dictionary = spark.read.parquet(f"{path}/dictionary").first()
    shared = spark.sparkContext.broadcast(bytes(dictionary.bytes))
    parts = spark.read.parquet(f"{path}/parts").select(F.col("part").alias("p"), "first_id")
    blocks = blocks.join(parts, F.col("part") == F.col("p")).withColumn("first", F.col("first") + F.col("first_id"))
    kind = blocks.schema["keys"].dataType.elementType.simpleString()
    digest = dictionary.sha256

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        decompress = zstandard.ZstdDecompressor(dict_data=_zstd(shared.value)).decompress
        for batch in batches:
            for row in range(batch.num_rows):
                first, keys, counts, offsets, payload, mark = (batch.column(i)[row] for i in range(6))
                if mark.as_py() != digest:
                    raise ValueError("a block was written with another dictionary than the file set's")
                keys, counts, offsets = keys.as_py(), counts.as_py(), offsets.as_py()
                data, at = memoryview(payload.as_buffer()), first.as_py()
                out = ([], [], [], [], [])
                for k, n, a, b in zip(keys, counts, offsets, offsets[1:]):
                    if only is None or k in only:
                        ids = decompress(data[a:b])
                        if len(ids) != 4 * n:
                            raise ValueError(f"document {k} has {len(ids) // 4} ids, the index says {n}")
                        for column, value in zip(out, (k, at, n, zlib.crc32(ids), ids if with_ids else None)):
                            column.append(value)
                    at += n
                columns = [pa.array(out[0], batch.column(1).type.value_type), *(pa.array(c, pa.int64()) for c in out[1:4])]
                if with_ids:
                    columns.append(pa.array(out[4], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["key", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    return blocks.select("first", "keys", "counts", "offsets", "payload", "dictionary").mapInArrow(
        unpack, f"key {kind}, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * with_ids)


def fresh_path(spark: SparkSession) -> str:
    return scratch_path(spark, "token-files")
