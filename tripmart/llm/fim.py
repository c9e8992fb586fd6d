"""Fill-in-the-middle rearrangement of whole texts, cut at line ends.

A text is cut into units (lines with their line feed); two seeded cuts make a prefix, a middle and a
suffix, which are put out as ``<P>prefix<S>suffix<M>middle`` (psm) or ``<S>suffix<P>prefix<M>middle``
(spm), or left as they are (plain).

The cuts are found on the UTF-8 bytes of a whole Arrow batch viewed as 64-bit words (SWAR): additions
and masks mark the bytes that end a unit, eight at a time; ``bitwise_count`` gives the marks of each
word and a cumulative sum the marks before it. The k-th unit's end is a binary search of the word in
the cumulative sum, then a select inside it: k - 1 lowest marks are cleared and the next one's place
is the number of bits below it. Code points are counted by the same rank over non-continuation bytes.

Cases: a null text counts as empty; an empty text, one that holds a marker, and one beyond
``fim_percent`` stay plain with null ``prefix_chars`` and ``middle_chars``; a last line without a line
feed is a unit; the seeded numbers come from the key alone, so rows that repeat a key are cut by the
same numbers and equal rows give equal results; a null key is an empty text there; texts of any
length are cut whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEED = 7
FIM_PERCENT = 100
SPM_PERCENT = 50
P, S, M = b"<P>", b"<S>", b"<M>"
MARKER = re.compile(b"<[PSM]>")
#: Rows cut at a time: bounds what Python holds of long texts.
ROWS = 256

_HIGH = np.uint64(0x8080808080808080)
_LOW7 = np.uint64(0x7F7F7F7F7F7F7F7F)
_FEEDS = np.uint64(0x0A0A0A0A0A0A0A0A)
_ONE = np.uint64(1)


class Marks:
    """Marked bytes of a buffer (the high bit of each byte of a word), with rank and select."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.before = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.bitwise_count(words), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marked bytes before byte ``at``."""
        word = at >> 3
        below = (_ONE << ((at & 7) << 3).astype(np.uint64)) - _ONE
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The byte that holds the k-th mark, from 1; it must exist."""
        word = np.searchsorted(self.before, k, side="left") - 1
        left, bits = k - self.before[word], self.words[word]
        for _ in range(7):
            bits = np.where(left > 1, bits & (bits - _ONE), bits)
            left = left - 1
        lowest = bits & (~bits + _ONE)
        return (word << 3) + (np.bitwise_count(lowest - _ONE).astype(np.int64) >> 3)


def _words(data: np.ndarray) -> np.ndarray:
    """The bytes as little-endian words, with at least one word of padding."""
    padded = np.zeros((len(data) // 8 + 1) * 8, np.uint8)
    padded[:len(data)] = data
    return padded.view("<u8")


def line_feeds(words: np.ndarray) -> Marks:
    """Bytes equal to a line feed: a byte of the difference is zero exactly if neither it nor its
    lower seven bits plus 127 reach the high bit; no carry leaves a byte."""
    x = words ^ _FEEDS
    return Marks(~(((x & _LOW7) + _LOW7) | x | _LOW7))


def code_points(words: np.ndarray) -> Marks:
    """Bytes that start a code point: all but 10xxxxxx."""
    return Marks(_HIGH & ~(words & ~(words << _ONE)))


def numbers(seed: int, key: object) -> tuple[int, int, int, int]:
    """The first four 8-digit groups of the hex sha256 of seed:key."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return tuple(int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12))


def cuts(data: np.ndarray, offsets: np.ndarray, first: np.ndarray, second: np.ndarray):
    """(units, prefix end, middle end, prefix code points, middle code points) of every text of a
    buffer; ``first`` and ``second`` are the seeded numbers, taken modulo units + 1."""
    words = _words(data)
    feeds, points = line_feeds(words), code_points(words)
    start, end = offsets[:-1], offsets[1:]
    before = feeds.rank(start)
    whole = feeds.rank(end) - before
    tail = (end > start) & (data[np.maximum(end - 1, 0)] != 10) if len(data) else end > start
    units = whole + tail
    a, b = first % (units + 1), second % (units + 1)

    def ends(k: np.ndarray) -> np.ndarray:
        out = np.where(k > whole, end, start)
        inside = (k > 0) & (k <= whole)
        out[inside] = feeds.select((before + k)[inside]) + 1
        return out

    prefix, middle = ends(np.minimum(a, b)), ends(np.maximum(a, b))
    at = points.rank(prefix)
    return units, prefix, middle, at - points.rank(start), points.rank(middle) - at


def restored(output: bytes, form: str) -> bytes:
    """The exact text, from an output and its form alone."""
    if form == "plain":
        return output
    second = output.index(S if form == "psm" else P, 3)
    third = output.index(M, second + 3)
    one, two, middle = output[3:second], output[second + 3:third], output[third + 3:]
    return one + middle + two if form == "psm" else two + middle + one


def transform(docs: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT,
              key: str = "doc_id", text: str = "text", with_output: bool = True) -> DataFrame:
    """``key, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256`` (and ``output``) per row.

    One pass without a shuffle: each task cuts the rows it reads.
    """
    kind = docs.schema[key].dataType.simpleString()
    shape = (f"k {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
             "output_sha256 string, restored_sha256 string" + (", output string" if with_output else ""))

    def cut(part: pa.RecordBatch) -> pa.RecordBatch:
        keys, texts = part.column(0).to_pylist(), part.column(1)
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        held = texts.buffers()[2]
        data = (np.frombuffer(held, np.uint8) if held else np.zeros(0, np.uint8))[offsets[0]:offsets[-1]]
        offsets = offsets - offsets[0]
        raw = data.tobytes()
        h = np.array([numbers(seed, k) for k in keys], np.int64).reshape(-1, 4)
        units, prefix, middle, in_prefix, in_middle = cuts(data, offsets, h[:, 0], h[:, 1])
        forms, made, back, outputs = [], [], [], []
        for i in range(len(keys)):
            s, a, b, e = int(offsets[i]), int(prefix[i]), int(middle[i]), int(offsets[i + 1])
            if s == e or h[i, 2] % 100 >= fim_percent or MARKER.search(raw, s, e):
                form, output = "plain", raw[s:e]
            elif h[i, 3] % 100 < spm_percent:
                form, output = "spm", b"".join((S, raw[b:e], P, raw[s:a], M, raw[a:b]))
            else:
                form, output = "psm", b"".join((P, raw[s:a], S, raw[b:e], M, raw[a:b]))
            forms.append(form)
            made.append(hashlib.sha256(output).hexdigest())
            back.append(hashlib.sha256(restored(output, form)).hexdigest())
            if with_output:
                outputs.append(output)
        plain = np.array([f == "plain" for f in forms], bool)
        columns = [part.column(0), pa.array(units, pa.int64()), pa.array(forms, pa.string()),
                   pa.array(in_prefix, pa.int64(), mask=plain), pa.array(in_middle, pa.int64(), mask=plain),
                   pa.array(made, pa.string()), pa.array(back, pa.string())]
        names = ["k", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
        if with_output:
            columns.append(pa.array(outputs, pa.binary()).cast(pa.string()))
            names.append("output")
        return pa.RecordBatch.from_arrays(columns, names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                yield cut(batch.slice(at, ROWS))

    rows = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t"))
    return rows.mapInArrow(work, shape).withColumnRenamed("k", key)


def restore(transformed: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, text`` from ``output`` and ``form``: the markers part an output into three."""
    body = F.substring("output", 4, 2**31 - 1)
    psm, spm = F.split(body, "<S>|<M>", -1), F.split(body, "<P>|<M>", -1)
    return transformed.select(key, F.when(F.col("form") == "psm", F.concat(psm[0], psm[2], psm[1]))
                              .when(F.col("form") == "spm", F.concat(spm[1], spm[2], spm[0]))
                              .otherwise(F.col("output")).alias("text"))
