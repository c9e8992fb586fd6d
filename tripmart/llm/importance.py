"""Resampling of documents towards a target distribution by importance weights.

Every feature (a run of words) is hashed into one of ``buckets`` buckets. The counts of all documents
and of all target texts give each bucket a gain (the log ratio of its smoothed shares); a document's
weight is the mean of its features' gains, looked up in one array. Adding seeded Gumbel noise and
taking the highest scores draws without replacement in proportion to the weights.

The ranks come from a distributed radix sort from the least significant digit: the composite key
(score downwards, then doc_id upwards) is read byte by byte. A pass is a stable counting sort: rows sit
in chunks of consecutive positions, digits are counted per chunk, and a prefix sum over
(digit, chunk) says where a chunk's rows of a digit begin; a row's destination is that offset plus its
rank in the chunk. After the last pass a row's position is its rank. No chunk holds more than ``CHUNK``
positions, whatever the keys, and bytes that are equal in all rows need no pass. Only rows that can be
drawn are sorted: a radix select over the scores (two counts of at most some hundred rows each)
gives the score of the last one drawn, and all its ties are kept.

Cases: a null text has no words (n_features 0, weight 0, never drawn); repeated rows are rows of
their own, ties between fully equal keys are broken by position; a null doc_id counts as empty
text for the noise and comes after all others at a tie; very long texts are read whole; empty
documents or an empty target give smoothed gains all the same; other columns are not read.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripmart.llm.common import key_text, running_before, stored

BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
#: Positions of a chunk are those that share all but this many low bits.
CHUNK_BITS = 12
CHUNK = 1 << CHUNK_BITS
#: Scores that share all but this many low bits are counted together at first.
COARSE_BITS = 8

_KEPT = (string.digits + string.ascii_lowercase).encode() + bytes(range(0x80, 0x100))
_TABLE = bytes(b if b in _KEPT else 0x20 for b in (bytes(range(256)).lower()))


def words(text: bytes) -> list[bytes]:
    """Runs of ASCII digits, letters and anything beyond ASCII; A-Z are lower-cased."""
    return text.translate(_TABLE).split()


def feature_buckets(found: list[bytes], width: int, buckets: int) -> np.ndarray:
    """The bucket of every run of 1 to ``width`` words."""
    runs = [found] + [[b" ".join(found[i:i + k]) for i in range(len(found) - k + 1)] for k in range(2, width + 1)]
    return np.fromiter((zlib.crc32(r) for run in runs for r in run), np.int64) % buckets


def bucket_counts(texts: DataFrame, text: str, width: int, buckets: int) -> DataFrame:
    """(bucket, n) over all texts: one array of counts a task, summed."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for t in batch.column(0):
                found = words(t.as_py())
                if found:
                    total += np.bincount(feature_buckets(found, width, buckets), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["bucket", "n"])

    rows = texts.select(F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t"))
    return rows.mapInArrow(work, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, width: int = 1, buckets: int = BUCKETS, text: str = "text",
          target_text: str = "text") -> np.ndarray:
    """The gain of every bucket. The driver gets at most ``buckets`` rows of a table, whatever the input."""
    s = bucket_counts(docs, text, width, buckets).select("bucket", F.col("n").alias("s"))
    t = bucket_counts(target, target_text, width, buckets).select("bucket", F.col("n").alias("t"))
    both = docs.sparkSession.range(buckets).select(F.col("id").alias("bucket")).join(s, "bucket", "left").join(t, "bucket", "left")
    rows = both.select("bucket", F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("t", F.lit(0)).alias("t")).collect()
    held = np.zeros((2, buckets))
    for r in rows:
        held[:, r.bucket] = r.s, r.t
    s, t = held
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def noise(key: str, seed: int) -> Column:
    """Gumbel noise from the first 8 hex digits of the sha256 of seed:key, in thousandths, floored."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), key_text(key)).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def scored(docs: DataFrame, gain: np.ndarray, width: int = 1, seed: int = SEED, key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """``key, n_words, n_features, weight, score`` of every row, in one pass."""
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(gain)
    kind = docs.schema[key].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = held.value
        for batch in batches:
            n_words, n_features, weight = [], [], []
            for t in batch.column(1):
                found = words(t.as_py())
                at = feature_buckets(found, width, len(array))
                n_words.append(len(found))
                n_features.append(len(at))
                weight.append(int(array[at].sum()) // len(at) if len(at) else 0)
            columns = [batch.column(0)] + [pa.array(c, pa.int64()) for c in (n_words, n_features, weight)]
            yield pa.RecordBatch.from_arrays(columns, ["k", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t"))
    out = rows.mapInArrow(work, f"k {kind}, n_words bigint, n_features bigint, weight bigint")
    return out.select("k", "n_words", "n_features", "weight", (F.col("weight") + noise("k", seed)).alias("score"))


def last_drawn(rows: DataFrame, down: Column, take: int) -> int:
    """The value of ``down`` (whole, from 0) of the ``take``-th smallest row: counts by the leading bits,
    then by the low bits inside the group that holds it."""
    coarse = rows.groupBy(F.shiftright(down, COARSE_BITS).alias("d")).count().orderBy("d").collect()
    before = 0
    for r in coarse:
        if before + r["count"] >= take:
            break
        before += r["count"]
    fine = (rows.where(F.shiftright(down, COARSE_BITS) == r.d).groupBy(down.alias("d")).count().orderBy("d").collect())
    for r in fine:
        before += r["count"]
        if before >= take:
            return r.d
    raise ValueError("fewer rows than are to be drawn")


def byte_digits(key: Column, score: Column) -> list[Column]:
    """The digits of (``score`` from 0 upwards, ``key`` upwards, null last), least significant first."""
    unsigned = F.coalesce(key.cast("bigint"), F.lit(0)).bitwiseXOR(F.lit(-1 << 63))
    low = [F.shiftrightunsigned(unsigned, 8 * i).bitwiseAND(F.lit(255)) for i in range(8)]
    return [*low, key.isNull().cast("bigint"), *[F.shiftright(score, 8 * i).bitwiseAND(F.lit(255)) for i in range(4)]]


def counting_pass(rows: DataFrame, digit: Column) -> DataFrame:
    """One stable pass: ``_at`` becomes the position after sorting by ``digit``."""
    rows = rows.withColumns({"_d": digit, "_c": F.shiftright("_at", CHUNK_BITS)})
    counts = rows.groupBy("_d", "_c").agg(F.count(F.lit(1)).alias("_n"))
    # Chunks take 52 bits at most (a partition's number and a part of a row's number), so both fit a bigint.
    counts = counts.withColumn("_o", F.shiftleft(F.col("_d"), 52) + F.col("_c"))
    begin = running_before(counts, "_o", "_n").select("_d", "_c", "before")
    inside = F.row_number().over(W.partitionBy("_d", "_c").orderBy("_at"))
    moved = rows.withColumn("_r", inside).join(begin, ["_d", "_c"])
    return moved.withColumn("_at", F.col("before") + F.col("_r") - 1).drop("_d", "_c", "_r", "before")


def radix_ranked(rows: DataFrame, key: str, down: str) -> DataFrame:
    """Adds ``rank`` (from 1) in the order of ``down`` (whole, 0 or more, under 2^32), then ``key``."""
    rows = stored(rows.withColumn("_at", F.monotonically_increasing_id()), "radix-rows")
    digits = byte_digits(F.col(key), F.col(down))
    ends = rows.agg(*[f(d).alias(f"{n}{i}") for i, d in enumerate(digits) for n, f in (("a", F.min), ("z", F.max))]).first()
    moving = [d for i, d in enumerate(digits) if ends[f"a{i}"] != ends[f"z{i}"]]
    for digit in moving or digits[:1]:  # the first pass also makes the positions gapless
        rows = stored(counting_pass(rows, digit), "radix-pass")
    return rows.withColumn("rank", F.col("_at") + 1).drop("_at")


def draw(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, width: int = 1,
         buckets: int = BUCKETS, seed: int = SEED, key: str = "doc_id", text: str = "text",
         target_text: str = "text") -> DataFrame:
    """``key, n_features, weight, score, rank`` of every row; ``rank`` is null for rows not drawn."""
    if docs.schema[key].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise TypeError(f"{key} must be a whole number: its bytes are sorted")
    gain = gains(docs, target, width, buckets, text, target_text)
    rows = stored(scored(docs, gain, width, seed, key, text), "importance")
    able = F.col("n_words") >= least_words
    size = rows.where(able).agg(F.count(F.lit(1)).alias("n"), F.max("score").alias("most")).first()
    take = percent * size.n // 100
    if take == 0:
        ranked = rows.withColumn("rank", F.lit(None).cast("bigint"))
    else:
        down = F.lit(size.most) - F.col("score")
        near = able & (down <= last_drawn(rows.where(able), down, take))
        chosen = radix_ranked(rows.where(near).withColumn("_down", down), "k", "_down").drop("_down")
        chosen = chosen.withColumn("rank", F.when(F.col("rank") <= take, F.col("rank")))
        ranked = chosen.unionByName(rows.where(~near).withColumn("rank", F.lit(None).cast("bigint")))
    return ranked.select(F.col("k").alias(key), "n_features", "weight", "score", "rank")
