"""Sinks: training examples per split and epoch, and the scalar log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, PrepConfig, SpecialIds
from ..operators.examples import apply_mlm

LOG_SCHEMA = "split string, epoch bigint, tag string, step bigint, value double"


def epoch_examples(batches: DataFrame, examples: DataFrame, vocab_size: int, cfg: PrepConfig = DEFAULT,
                   special: SpecialIds = SpecialIds()) -> DataFrame:
    """Masked training rows with their place in the run:
    ``split, epoch, batch_id, slot`` plus the five example tensors.

    Batches (many rows per example: one per epoch) are joined to the
    examples on ``example_id``; masks are drawn with each row's epoch.
    """
    x = batches.join(examples, "example_id")
    m = apply_mlm(x, vocab_size, F.col("epoch"), cfg, special)
    return m.select(
        "split", "epoch", "batch_id", "slot", "example_id", "input_ids", "attention_mask", "token_type_ids",
        "labels", F.col("is_next").alias("next_sentence_label"),
    )


def write_examples(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Parquet partitioned by ``split`` and ``epoch``, with whole batches in files.

    Rows are dealt out in ranges of batch numbers inside each (split, epoch) and sorted, so a
    batch lies in one file; an epoch is spread over as many tasks as its size asks for, and the
    files' statistics of ``batch_id`` let a reader skip what it does not want.  Ranges come from a
    count by split and epoch, which reads no tensor: a range partitioner's sample would make
    every example twice."""
    order = ["split", "epoch", "batch_id", "slot"]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = rows.groupBy("split", "epoch").agg(F.count(F.lit(1)).alias("n"), F.min("batch_id").alias("lo"), F.max("batch_id").alias("hi"))
    held = held.sort("split", "epoch").collect()
    total, first, place = sum(r["n"] for r in held), 0, F.lit(None).cast("int")
    for r in held:
        lo, hi = (0, 0) if r["lo"] is None else (int(r["lo"]), int(r["hi"]))
        parts = min(max(1, round(n * r["n"] / total)), hi - lo + 1)
        width = -(-(hi - lo + 1) // parts)
        own = F.col("split").eqNullSafe(F.lit(r["split"])) & F.col("epoch").eqNullSafe(F.lit(r["epoch"]))
        inside = F.call_function("div", F.coalesce("batch_id", F.lit(lo)) - F.lit(lo).cast("bigint"), F.lit(width).cast("bigint"))
        place = F.when(own, (F.lit(first) + inside).cast("int")).otherwise(place)
        first += parts
    (
        rows.repartitionById(max(1, first), place).sortWithinPartitions(*order)
        .write.mode(mode)
        .partitionBy("split", "epoch")
        .parquet(path)
    )


def read_epoch(spark: SparkSession, path: str, split: str, epoch: int) -> DataFrame:
    """One epoch of one split (partition pruning on the directory layout)."""
    return spark.read.parquet(path).filter((F.col("split") == split) & (F.col("epoch") == epoch))


def append_scalars(scalars: DataFrame, path: str, run: int | None = None) -> None:
    """Append ``(split, epoch, tag, step, value)`` rows to the scalar log.  An append
    becomes visible as a whole when its files are committed.  ``run`` numbers the run
    that logs: 0 for the first, more for each that resumes it (``next_run``)."""
    own = [] if run is None else [F.lit(int(run)).cast("bigint").alias("run")]
    scalars.select(
        "split", F.col("epoch").cast("bigint"), "tag", F.col("step").cast("bigint"), F.col("value").cast("double"), *own
    ).write.mode("append").parquet(path)


def read_scalars(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The scalar log with the ``run`` of each row; rows logged without one are run 0's."""
    rows = spark.read.schema(f"{LOG_SCHEMA}, run bigint").parquet(path)
    return rows.withColumn("run", F.coalesce("run", F.lit(0).cast("bigint")))


def next_run(spark: SparkSession, path: str) -> int:
    """The number for a run that goes on with the log."""
    last = read_runs(spark, path).agg(F.max("run")).first()[0]
    return 0 if last is None else int(last) + 1


def last_written(rows: DataFrame) -> DataFrame:
    """Each (split, epoch, tag, step) once, as the latest run logged it.

    A run that resumes at a checkpoint logs again what the interrupted one logged after it;
    the later row counts, also if its value is NULL.  Of rows that one run logged twice, the
    greatest value counts.  One aggregate with partial results; the columns are those of the log."""
    g = rows.groupBy("split", "epoch", "tag", "step").agg(F.max(F.struct("run", "value")).alias("last"))
    return g.select("split", "epoch", "tag", "step", F.col("last.value").alias("value"))


def compact_scalars(spark: SparkSession, path: str, target: str) -> DataFrame:
    """Write the log without overwritten rows to ``target`` and read it back."""
    append_scalars(last_written(read_runs(spark, path)), target)
    return read_scalars(spark, target)
