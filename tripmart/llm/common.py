"""Small helpers of the training-data operators."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.session import scratch_path

# A word is a run of anything but space, tab, \n, \v, \f and \r (the same class in Java and Python).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WORDS = re.compile(WORD_PATTERN)
SPACE_PATTERN = r"[\x20\x09-\x0D]+"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application: they need not find it on a path
    of their own."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).parent.parent
    folder = tempfile.mkdtemp(prefix="tripmart-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(f"{folder}/{package.name}_code.zip", "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(f"{folder}/{package.name}_code.zip")
    _SHIPPED.add(sc.applicationId)


BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """What the registered queries and the pipeline's stages ask of the session: the package on the
    workers, and Arrow batches of 1,000 rows, as texts are long and a batch is held several times over
    (10,000 texts of 100 KB would be 1 GB)."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the cluster's shared folder and read back: the lineage is cut by
    files that every executor can read, so a lost executor costs no more than the running job."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def packed(docs: DataFrame) -> DataFrame:
    """``docs`` as one column ``row``, so that no column of its own can clash with a helper column."""
    return docs.select(F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns]).alias("row"))


def field(name: str) -> Column:
    """A column of a packed row."""
    return F.col("row").getField(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def key_text(key: str) -> Column:
    """The key as text; a null key counts as empty text."""
    return F.coalesce(F.col(key).cast("string"), F.lit(""))


def fold(key: str, n: int) -> Column:
    """crc32 of the key as text, modulo ``n``."""
    return F.crc32(key_text(key).cast("binary")) % n


def seeded(seed: int, *cols: Column) -> Column:
    """A 60-bit number from the md5 of the seed and the columns: the same on every engine."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def unit(number: Column) -> Column:
    """A number of :func:`seeded` as a fraction of 1."""
    return number.cast("double") / F.lit(float(1 << 60))


def running_before(counts: DataFrame, order: str, amount: str, within: list[str] | None = None,
                   span: int = 1024) -> DataFrame:
    """Adds ``before``: the sum of ``amount`` over smaller ``order`` values (inside ``within``).

    ``order`` is a whole number from 0 without repeats. Two levels: sums over spans of ``span`` values run over
    a window of one row per span, then rows inside a span over a window of ``span`` rows at most,
    so no task sorts the whole list.
    """
    from pyspark.sql import Window as W

    within = within or []
    rows = counts.withColumn("_span", F.floor(F.col(order) / span))
    up_to = (W.unboundedPreceding, -1)
    spans = rows.groupBy(*within, "_span").agg(F.sum(amount).alias("_sum"))
    ahead = W.partitionBy(*within) if within else W.partitionBy(F.lit(0))
    spans = spans.withColumn("_ahead", F.coalesce(F.sum("_sum").over(
        ahead.orderBy("_span").rowsBetween(*up_to)), F.lit(0))).drop("_sum")
    spans = spans.select(*[F.col(c).alias(f"_s{i}") for i, c in enumerate(within)],
                         F.col("_span").alias("_sp"), "_ahead")
    on = F.col("_span") == F.col("_sp")
    for i, c in enumerate(within):
        on = on & F.col(c).eqNullSafe(F.col(f"_s{i}"))
    inside = W.partitionBy(*within, "_span").orderBy(order).rowsBetween(*up_to)
    out = rows.join(spans, on, "left")
    return (out.withColumn("before", F.col("_ahead") + F.coalesce(F.sum(amount).over(inside), F.lit(0)))
            .drop("_span", "_sp", "_ahead", *[f"_s{i}" for i in range(len(within))]))
