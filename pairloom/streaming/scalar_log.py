"""The scalar log as a stream.

A training run appends ``(split, epoch, tag, step, value)`` rows as batches
finish.  ``epoch_average_stream`` keeps the per-epoch means of the logged
values up to date with Structured Streaming: the file source picks up new
files, the aggregation state holds one sum and count per
``(split, epoch, tag)``, and every trigger writes the current means to a folder of its
own through ``foreachBatch``, then publishes the folder's number.  A reader always
sees a whole table, and a batch that is written again after a restart replaces
itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.sinks import LOG_SCHEMA



def read_log_stream(spark: SparkSession, log_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(LOG_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(log_dir)


def running_epoch_averages(log: DataFrame) -> DataFrame:
    """Mean of per-batch values per (split, epoch, tag), as a streaming aggregate."""
    v = F.col("value")
    return log.groupBy("split", "epoch", "tag").agg(
        (F.sum(v) / F.count(v)).alias("mean_value"),
        F.count(v).cast("bigint").alias("n_batches"),
        F.count_if(v.isNull()).cast("bigint").alias("n_missing"),
    )


def epoch_average_stream(
    spark: SparkSession, log_dir: str, out_dir: str, checkpoint_dir: str, trigger_once: bool = False
) -> StreamingQuery:
    """Start the query; ``read_epoch_averages`` gives the current averages."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/means/batch={batch_id}")
        done = batch.sparkSession.range(1).select(F.lit(batch_id).cast("bigint").alias("batch"))
        done.write.mode("append").parquet(f"{out_dir}/published")

    w = (
        running_epoch_averages(read_log_stream(spark, log_dir))
        .writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint_dir)
        .foreachBatch(write)
    )
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()


def read_epoch_averages(spark: SparkSession, out_dir: str) -> DataFrame:
    """The averages published last."""
    last = spark.read.parquet(f"{out_dir}/published").agg(F.max("batch")).first()[0]
    return spark.read.parquet(f"{out_dir}/means/batch={last}")
