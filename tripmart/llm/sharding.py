"""Shards by proportional stratified interleaving.

Rows are put into a seeded order inside each source; the r-th of a source's n rows gets the
fractional rank (r - 1/2) / n. All rows sorted by fractional rank interleave the sources in
proportion, so equal cuts of that order match the mixture. Counts of shards differ by one at most
(law ``rows``).

Both rankings are range sorts over a total order (each row has a number of its own as its last key), so
neither a hot source, nor a key that repeats, nor very many sources of one row (all of the fractional
rank 1/2) meet in one task: a row's rank is its place in its range plus the rows of the ranges before,
and a row's rank in its source is counted from the source's first row.

Cases: a null source is a source of its own; a null text has size 1 (no bytes plus 1) and the crc32
of empty text; a null key counts as empty text; repeated rows are dealt like any other rows; an
empty table gives no rows; columns of other names are not read unless they are named in ``carry``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import running_before, seeded, stored

SHARDS = 8
SEED = 17


def _ranked(rows: DataFrame, order: list[Column], ranges: int | None, name: str) -> DataFrame:
    """Adds ``rank`` (from 0) in the total ``order``. Ranges are written once with each row's place, so
    their counts and their rows come from the same cut."""
    dealt = rows.repartitionByRange(ranges, *order) if ranges else rows.repartitionByRange(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # the lower bits count inside a partition
    placed = stored(dealt.sortWithinPartitions(*order).select("*", F.spark_partition_id().alias("_range"), place.alias("_place")), name)
    counts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = running_before(counts, "_range", "_n").select(F.col("_range").alias("_r"), "before")
    # a row per range: as many as there are shuffle partitions
    ranked = placed.join(F.broadcast(before), F.col("_range") == F.col("_r"))
    return ranked.withColumn("rank", F.col("before") + F.col("_place")).drop("_range", "_r", "_place", "before")


def assign(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, run: int | None = None, key: str = "doc_id",
           text: str = "text", source: str = "source", carry: tuple[str, ...] = ()) -> DataFrame:
    """``key, source, size, text_crc32, shard, slot`` (and the columns of ``carry``) per row.

    ``slot`` numbers the rows of a shard from 0 without gaps. ``run`` is the number of rows in a range; if it is
    not given there are as many ranges as the session has shuffle partitions.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("_key"), F.col(source).alias("_source"),
        (F.octet_length(body) + 1).cast("bigint").alias("_size"), F.crc32(body.cast("binary")).alias("_crc"),
        *[F.col(c).alias(f"_c_{c}") for c in carry])
    rows = stored(rows.withColumns({"_h": seeded(seed, F.col("_key")), "_no": F.monotonically_increasing_id()}), "shard-rows")
    carried = rows.select("_no", *[f"`_c_{c}`" for c in carry])
    total = rows.count()
    ranges = None if run is None else max(1, -(-total // run))
    own = [F.col(c) for c in ("_h", "_key", "_crc", "_size", "_no")]
    by_source = F.col("_source").asc_nulls_last()

    rows = _ranked(rows.select("_key", "_source", "_size", "_crc", "_h", "_no"), [by_source, *own], ranges, "shard-sources")
    sources = rows.groupBy(F.col("_source").alias("_s")).agg(F.count(F.lit(1)).alias("_n"), F.min("rank").alias("_first"))
    rows = rows.join(sources, F.col("_source").eqNullSafe(F.col("_s")))
    rows = rows.withColumn("_f", (2 * (F.col("rank") - F.col("_first")) + 1) / (2 * F.col("_n")))
    rows = rows.drop("rank", "_s", "_n", "_first")

    rows = _ranked(rows, [F.col("_f"), by_source, *own], ranges, "shard-ranks")
    if carry:
        rows = rows.join(carried, "_no")
    rows = rows.withColumn("shard", F.floor(F.col("rank") * shards / F.lit(max(1, total))).cast("bigint")
                           if total * shards >= 1 << 52 else F.expr(f"rank * {shards} div {max(1, total)}"))
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return rows.select(
        F.col("_key").alias(key), F.col("_source").alias(source), F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"), F.col("shard").cast("int").alias("shard"),
        (F.col("rank") - first).cast("bigint").alias("slot"), *[F.col(f"`_c_{c}`").alias(c) for c in carry])


def write(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED, key: str = "doc_id",
          text: str = "text", source: str = "source") -> DataFrame:
    """Writes ``path/shard=N`` folders of rows with their texts, sorted by slot inside each file,
    and returns them as read back. A shard is written by several tasks (slots cut into ranges)."""
    rows = assign(docs, shards, seed, key=key, text=text, source=source, carry=(text,))
    per_file = 200_000
    rows = rows.withColumn("_part", F.floor(F.col("slot") / per_file))
    rows.repartition("shard", "_part").sortWithinPartitions("shard", "slot").drop("_part") \
        .write.mode("overwrite").partitionBy("shard").parquet(path)
    return docs.sparkSession.read.parquet(path)
