"""Incremental bronze over a folder of raw trip files (Structured Streaming).

Every micro-batch runs the same operators as the batch job: flag, label, write the
split partitioned by ``dq_status``, and collect the metrics of the batch in the same
pass (``observe``). Each batch writes into its own ``batch_id=<n>`` folder in
overwrite mode, so a batch replayed after a failure replaces its own output instead
of appending a second copy; the stream checkpoint records which files were consumed.
Reading ``<out>/trips`` later sees every batch (``batch_id`` and ``dq_status`` are
partition columns).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tripmart import schemas as S
from tripmart.operators import bronze, metrics
from tripmart.session import ensure_utc
from tripmart.sources import sinks


def _process_batch(out_base: str):
    def run(batch: DataFrame, batch_id: int) -> None:
        flagged = bronze.flag_trips(batch)
        aggs = metrics.trip_metric_aggregates(flagged)
        obs = Observation(f"bronze_batch_{batch_id}")
        spark = batch.sparkSession
        with sinks.few_partition_values(spark):  # three statuses: no sort of the trips by status
            (flagged.withColumn(S.DQ_STATUS, bronze.dq_status())
             .observe(obs, *metrics.named(aggs))
             .write.mode("overwrite").partitionBy(S.DQ_STATUS)
             .parquet(f"{out_base}/trips/batch_id={batch_id}"))
        values = obs.get
        sinks.write_if_schema(metrics.state_of(spark, str(batch_id), aggs, values),
                              f"{out_base}/{S.METRIC_STATE_DIR}/batch_id={batch_id}")
        schema = T.StructType([T.StructField(n, T.LongType()) for n in aggs])
        totals = spark.createDataFrame([tuple(int(values.get(n) or 0) for n in aggs)], schema)
        rows = metrics.trip_metric_rows(totals, flagged.columns)
        sinks.write_if_schema(rows, f"{out_base}/_run_summary_batches/batch_id={batch_id}")
    return run


def start_bronze_stream(spark: SparkSession, input_dir: str, raw_schema: T.StructType,
                        out_base: str, checkpoint: str,
                        available_now: bool = True, max_files_per_trigger: int | None = None
                        ) -> StreamingQuery:
    """Start the incremental bronze query; ``available_now`` drains what is there and stops.

    ``checkpoint`` belongs to ``out_base``: a restart must name the same folder, or batches would be
    numbered from 0 again and files counted twice.
    """
    if not checkpoint:
        raise ValueError("a bronze stream needs the checkpoint folder that belongs to its output")
    ensure_utc(spark)
    reader = spark.readStream.schema(raw_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.parquet(input_dir)
    writer = (stream.writeStream.foreachBatch(_process_batch(out_base))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def stream_totals(spark: SparkSession, out_base: str) -> DataFrame:
    """Counts over all batches written so far: (dq_status, rows)."""
    return (spark.read.parquet(f"{out_base}/trips")
            .groupBy(S.DQ_STATUS).agg(F.count(F.lit(1)).alias("rows")))


def stream_metrics(spark: SparkSession, out_base: str) -> DataFrame:
    """The long metric table over all batches written so far."""
    return metrics.merged_metrics(spark.read.parquet(f"{out_base}/{S.METRIC_STATE_DIR}"))
