"""Document fingerprints by consistent weighted sampling.

A text is a bag of weighted terms: its lower-cased words, each weighing as often as it occurs. For
sample i a term draws r and c from Gamma(2, 1) and b from the unit interval, all from hashes of the term and i.
With t = floor(ln(weight) / r + b), the term's value is c / exp(r (t - b + 1)); the term with the
least value is the sample, together with its t. Two bags share a sample with the chance of their generalised Jaccard
similarity, sum of the smaller weights over sum of the larger, so the share of equal samples
estimates it. A fingerprint keeps 16 bits of each of 32 samples: 128 hex digits.

Everything is built-in expressions. A sample is the least of 64-bit numbers (value in the high half, the sample's
hash in the low half), so all samples of a text are plain ``min`` aggregates.

Texts are shuffled once, by a digest of key and text, with at most one copy of equal rows from each task
(a key or text that holds a third of all rows is not one task's work). Who follows whom comes from the
digests alone: rows of about 40 bytes, range-partitioned by (key, digest), each partition closed by the first
row of the next.

Cases: a null text counts as empty; a text without words has an empty fingerprint, which is like (1.0) another
empty one and unlike (0.0) any other; a null key comes before all others; rows equal in key and text are one
document and get the same result each; rows that share a key but not the text follow each other
in the order of their digests; a single document follows itself; an empty table gives no rows; words of any
length and texts of any length are read whole; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripmart.llm.common import SPACE_PATTERN, key_text, stored
from tripmart.operators.dedup import keep_first

SAMPLES = 32
SEED = 13
BITS = 16
#: Samples of a group: as many as their bits fill a bigint.
LANES = 4
#: Values are kept in steps of 2^-24 of their logarithm (some -110 to 10): 31 bits.
STEPS = 1 << 24


def _uniform(bits: Column, shift: int, width: int) -> Column:
    """``width`` bits of a hash as a number inside (0, 1)."""
    part = F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit((1 << width) - 1))
    return (part + F.lit(0.5)) / F.lit(float(1 << width))


def sample_value(term: Column, log_weight: Column, j: int, seed: int = SEED) -> Column:
    """Sample ``j`` of a group for one weighted term (its hash mixed with the group's number), as a number to be
    minimised: value, then 16 bits of (term, t)."""
    one, two = (F.xxhash64(term.bitwiseXOR(F.lit(seed << 16 | 2 * j + i))) for i in (0, 1))
    r = -F.log(_uniform(one, 43, 21) * _uniform(one, 22, 21))
    c = -F.log(_uniform(two, 32, 32) * _uniform(two, 0, 32))
    b = _uniform(one, 0, 22)
    t = F.floor(log_weight / r + b)
    value = F.floor((F.log(c) - r * (t - b + F.lit(1.0))) * F.lit(float(STEPS)))
    # The low bits of the hash hardly move b, so they name the term; t tells its samples apart.
    return F.shiftleft(value, 32).bitwiseOR(one.bitwiseXOR(t).bitwiseAND(F.lit((1 << BITS) - 1)))


def word_hashes(text: Column) -> Column:
    """The sorted hashes of the lower-cased words."""
    words = F.array_remove(F.split(F.lower(text), SPACE_PATTERN), "")
    return F.sort_array(F.transform(words, lambda w: F.xxhash64(w)))


def terms_of(texts: DataFrame, by: list[str], text: str = "text") -> DataFrame:
    """``by, term, weight`` per distinct word of each row; a row without words gives one row of nulls."""
    rows = texts.select(*by, word_hashes(F.col(text)).alias("_w"))
    places = F.sequence(F.lit(1), F.size("_w"))
    ends = F.when(F.size("_w") > 0, F.filter(places, lambda i: (i == F.size("_w")) | (
        F.get("_w", i) != F.get("_w", i - 1)))).otherwise(F.array().cast("array<int>"))
    rows = rows.select(*by, "_w", ends.alias("_e"))
    runs = F.transform("_e", lambda e, i: F.struct(F.get("_w", e - 1).alias("term"), (
        e - F.coalesce(F.get("_e", i - 1), F.lit(0))).alias("weight")))
    return rows.select(*by, F.explode_outer(runs).alias("_t")).select(*by, "_t.term", "_t.weight")


def signatures(terms: DataFrame, by: list[str], samples: int = SAMPLES, seed: int = SEED) -> DataFrame:
    """``by, fp``: the samples' 16 bits, four to a bigint; null for rows without terms.

    Each term becomes a row per group of four samples, so the generated code holds four samples, whatever their number, and
    stays small enough to be compiled; the rows of a text stay in their task.
    """
    groups = F.sequence(F.lit(0), F.lit(samples // LANES - 1))
    each = terms.select(*by, "term", F.log("weight").alias("_lw"), F.explode(groups).alias("_g"))
    each = each.select(*by, "_g", "_lw", F.col("term").bitwiseXOR(F.shiftleft(F.col("_g").cast("bigint"), 48)).alias("_x"))
    held = each.groupBy(*by, "_g").agg(*[F.min(sample_value(F.col("_x"), F.col("_lw"), j, seed)).alias(f"s{j}") for j in range(LANES)])
    pack = F.lit(0).cast("bigint")
    for j in range(LANES):
        pack = F.shiftleft(pack, BITS).bitwiseOR(F.col(f"s{j}").bitwiseAND(F.lit((1 << BITS) - 1)))
    packs = held.select(*by, "_g", pack.alias("_p"))
    packs = packs.groupBy(*by).agg(*[F.max(F.when(F.col("_g") == i, F.col("_p"))).alias(f"p{i}") for i in range(samples // LANES)])
    return packs.select(*by, F.when(F.col("p0").isNotNull(), F.array(*[f"p{i}" for i in range(samples // LANES)])).alias("fp"))


def fingerprint_text(fp: Column, samples: int = SAMPLES) -> Column:
    """Hex digits of a fingerprint; empty for a text without words."""
    return F.coalesce(F.lower(F.concat(*[F.lpad(F.hex(F.get(fp, F.lit(i))), 16, "0") for i in range(samples // LANES)])), F.lit(""))


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of equal samples: each 16-bit lane of the differences is folded into its lowest bit, and the lanes that
    differ are counted four at a time."""
    differ = F.lit(0)
    for i in range(samples // LANES):
        x = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        for shift in (8, 4, 2, 1):
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        differ = differ + F.bit_count(x.bitwiseAND(F.lit(0x0001000100010001)))
    both = a.isNotNull() & b.isNotNull()
    return F.when(both, (F.lit(samples) - differ) / F.lit(float(samples))).otherwise(F.when(a.isNull() & b.isNull(), 1.0).otherwise(0.0))


def digest(key: str, text: Column) -> Column:
    """128 bits of key and text; a null key differs from an empty one."""
    return F.unhex(F.md5(F.concat(F.when(F.col(key).isNull(), "-").otherwise("+"), key_text(key), F.lit(":"), text).cast("binary")))


def followers(rows: DataFrame) -> DataFrame:
    """``d, next``: each distinct digest and the one after it in the order of (k, d), the last one before the first."""
    part = rows.select("k", "d").distinct().repartitionByRange(F.col("k").asc_nulls_first(), F.col("d"))
    part = stored(part.withColumn("_part", F.spark_partition_id()), "cws-order")
    # One row per partition of the exchange: few, whatever the table's size.
    firsts = part.groupBy("_part").agg(F.min(F.struct(F.col("k").isNotNull(), F.col("k"), F.col("d"))).alias("_f"))
    every = W.partitionBy(F.lit(0)).orderBy("_part")
    closing = firsts.select("_part", F.coalesce(
        F.lead("_f.d").over(every), F.first("_f.d").over(every)).alias("_after"))
    inside = F.lead("d").over(W.partitionBy("_part").orderBy(F.col("k").asc_nulls_first(), "d"))
    return part.withColumn("_in", inside).join(closing, "_part").select("d", F.coalesce("_in", "_after").alias("next"))


def fingerprints(docs: DataFrame, samples: int = SAMPLES, seed: int = SEED, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, fp`` per row of ``docs``: the samples' 16 bits, four to a bigint (null without words)."""
    body = F.coalesce(F.col(text), F.lit(""))
    texts = docs.select(F.col(key).alias("k"), digest(key, body).alias("d"), body.alias("t"))
    each = keep_first(texts.select("d", "t"), ["d"], [F.col("d")])
    made = signatures(terms_of(each, ["d"], "t"), ["d"], samples, seed)
    return texts.select("k", "d").join(made, "d").select(F.col("k").alias(key), "fp")


def edited(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows: k, d, n; links: d, next; texts: d, t, e): ``e`` is ``t`` with its last floor(n / 2) code points
    replaced by the first as many, or all, of the document that follows."""
    body = F.coalesce(F.col(text), F.lit(""))
    texts = docs.select(F.col(key).alias("k"), digest(key, body).alias("d"), body.alias("t"))
    rows = stored(texts.select("k", "d", F.length("t").cast("bigint").alias("n")), "cws-rows")
    links = stored(followers(rows), "cws-links")
    half = F.floor(F.col("n") / 2).cast("int")
    need = links.join(rows.groupBy("d").agg(F.max("n").alias("n")), "d").select(
        F.col("d").alias("_to"), F.col("next").alias("d"), half.alias("_h"))
    each = keep_first(texts.select("d", "t"), ["d"], [F.col("d")])
    heads = each.join(need, "d").select(F.col("_to").alias("d"), "_h", F.substring("t", F.lit(1), F.col("_h")).alias("_head"))
    whole = each.join(heads, "d").select("d", "t", F.concat(
        F.substring("t", F.lit(1), F.length("t") - F.col("_h")), "_head").alias("e"))
    return rows, links, whole


def compare(docs: DataFrame, samples: int = SAMPLES, seed: int = SEED, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` per row of ``docs``."""
    rows, links, whole = edited(docs, key, text)
    sides = whole.select("d", F.sha2(F.col("e").cast("binary"), 256).alias("sha"), F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("t").alias("t")),
        F.struct(F.lit(1).alias("side"), F.col("e").alias("t")))).alias("_s")).select("d", "sha", "_s.side", "_s.t")
    made = stored(signatures(terms_of(sides, ["d", "sha", "side"], "t"), ["d", "sha", "side"], samples, seed), "cws-signatures")
    own = made.where("side = 0").select("d", "sha", "fp")
    other = made.where("side = 1").select("d", F.col("fp").alias("efp"))
    after = made.where("side = 0").select(F.col("d").alias("next"), F.col("fp").alias("nfp"))
    each = own.join(other, "d").join(links, "d").join(after, "next").select(
        "d", "sha", fingerprint_text(F.col("fp"), samples).alias("fingerprint"),
        fingerprint_text(F.col("efp"), samples).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("efp"), samples).alias("near_edited"),
        likeness(F.col("fp"), F.col("nfp"), samples).alias("near_next"))
    return rows.join(each, "d").select(F.col("k").alias(key), F.col("n").alias("n_chars"), F.col("sha").alias("edited_sha256"),
                                       "fingerprint", "edited_fingerprint", "near_edited", "near_next")
