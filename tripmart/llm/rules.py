"""Quality rules with host-level verdicts.

Per document: word and line counts, and the two base rules (too few words; too many words in
repeated three-word windows). Per host: the failures are summed and the failure rate is shrunk by
a beta prior that is fitted to all hosts (method of moments), so a host with few documents stays
near the global rate. A host whose shrunk rate is over ``max_rate`` is rejected with all its
documents; elsewhere a document is kept if it doesn't fail itself.

Everything is built-in expressions: one scan, one small aggregate per host, one join back.

Cases: a null or empty text has no words and fails; a null host is a host of its own; repeated rows
count each; an empty table gives no rows; columns of other names are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import SPACE_PATTERN, WORD_PATTERN, stored

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_RATE = 0.5


def _removed(text: Column, letters: str) -> Column:
    """Number of characters of ``text`` that are in ``letters``."""
    return (F.char_length(text) - F.char_length(F.translate(text, letters, ""))).cast("bigint")


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE_PATTERN), lambda w: w != "")


def window_hashes(words: Column) -> Column:
    """The 64-bit hashes of all three-word windows, in order."""
    hashes = F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    return F.slice(hashes, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0)))


def counts(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """``key, host`` and the counts of each document.

    Repeated windows: hashes are sorted with their places, equal neighbours are repeated. Their
    places, sorted again, cover three words each, less where the next one starts earlier. A text
    whose window hashes all differ is settled without sorting.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("_key"), F.col(host).alias("_host"), body.alias("_text"))
    rows = rows.withColumn("_words", words_of(F.col("_text")))
    rows = rows.withColumn("_windows", window_hashes(F.col("_words")))
    rows = rows.withColumn("_sorted", F.expr(
        "CASE WHEN size(array_distinct(_windows)) = size(_windows) THEN NULL "
        "ELSE array_sort(transform(_windows, (h, i) -> struct(h AS h, i AS i))) END"))
    rows = rows.withColumn("_places", F.expr(
        "sort_array(transform(filter(_sorted, (x, j) -> x.h = get(_sorted, j - 1).h OR x.h = get(_sorted, j + 1).h), x -> x.i))"))
    rows = rows.withColumn("_repeat", F.expr(
        "coalesce(aggregate(_places, named_struct('at', -3, 'n', 0L), "
        "(a, p) -> named_struct('at', p, 'n', a.n + least(3, p - a.at)), a -> a.n), 0L)"))
    lines = F.filter(F.split(F.col("_text"), "\n"), lambda x: x.rlike(WORD_PATTERN))
    rows = rows.withColumn("_lines", lines)
    return rows.select(
        F.col("_key").alias(key), F.col("_host").alias(host),
        F.size("_words").cast("bigint").alias("n_words"),
        F.char_length(F.translate(F.col("_text"), SPACES, "")).cast("bigint").alias("word_chars"),
        _removed(F.col("_text"), SYMBOLS).alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.col("_repeat").cast("bigint").alias("n_repeat_words"))


def failed(min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT) -> Column:
    return ((F.col("n_words") < min_words)
            | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")))


def host_verdicts(rows: DataFrame, host: str = "source", max_rate: float = MAX_RATE) -> DataFrame:
    """``host, host_docs, host_failed, host_rate, host_kept`` from rows with ``base_failed``.

    The prior's mean m is the mean of the hosts' rates and its strength s = a + b comes from their
    variance v: s = m (1 - m) / v - 1, at least 1; without variance among hosts it is the largest
    (1,000,000), which is the global rate for all. Two numbers go to the driver.
    """
    hosts = stored(rows.groupBy(host).agg(F.count(F.lit(1)).alias("host_docs"),
                                          F.count_if(F.col("base_failed")).alias("host_failed")), "hosts")
    rate = F.col("host_failed") / F.col("host_docs")
    mean, spread = hosts.agg(F.avg(rate), F.var_pop(rate)).first()
    mean = mean or 0.0
    strength = min(1e6, max(1.0, mean * (1 - mean) / spread - 1)) if spread and spread > 1e-9 else 1e6
    shrunk = (F.col("host_failed") + F.lit(mean * strength)) / (F.col("host_docs") + F.lit(strength))
    return hosts.withColumn("host_rate", shrunk).withColumn("host_kept", F.col("host_rate") <= max_rate)


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source",
          min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT,
          max_rate: float = MAX_RATE) -> DataFrame:
    """The counts with ``base_failed, host_rate, kept`` per document.

    The counts go to a written table of a few numbers per document, from which hosts are summed and
    to which their verdicts return, so texts are read once and never shuffled.
    """
    rows = stored(counts(docs, key, text, host).withColumn("base_failed", failed(min_words, max_repeat_percent)),
                  "rule-counts")
    verdicts = host_verdicts(rows, host, max_rate).select(
        F.col(host).alias("_h"), "host_docs", "host_failed", "host_rate", "host_kept")
    out = rows.join(verdicts, F.col(host).eqNullSafe(F.col("_h")), "left").drop("_h")
    return out.withColumn("kept", ~F.col("base_failed") & F.col("host_kept")).drop("host_kept")
