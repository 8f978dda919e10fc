"""Mixing sources to target weights (operator 5).

Every row gets a hash-random key; rows are range-sorted by (source, key), so each
source, however large, lies over as many partitions as it needs.  Running sums inside a
partition plus the sums of the partitions before give each row the number of words that
come before it in its source, and a source is cut exactly at its budget after as many
whole passes as fit.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import join_small, materialize
from .common import map_arrow, prepare

WORD = r"[^\x20\x09-\x0D]+"
SPACED_WORD = r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"
MIX_SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(id_col: Column, seed: str = MIX_SEED) -> Column:
    """Sixteen hexadecimal digits; null ids share a key."""
    return F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(id_col.cast("string"), F.lit("")))), 1, 16)


def source_targets(sizes: DataFrame, weights: tuple = (5, 2, 1), share: float = 1.5, passes: int = 2) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources in code point order, null last, take the weights in turn.  All share
    ``share`` times all sizes by weight; a target stops at ``passes`` times its source's
    size and the excess is shared out anew by weight until none is above.  Each round is
    one aggregate over the written source table, of which the driver sees two sums.
    """
    spark = sizes.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.col("source").asc_nulls_last()
    ranged = sizes.repartitionByRange(n, order).sortWithinPartitions(order)
    ranged = materialize(ranged.withColumn("_at", F.monotonically_increasing_id()), "mix-sources")
    part = F.shiftright("_at", 33).alias("_part")
    counts = ranged.groupBy(part).agg(F.count("*").alias("_n"))
    # one row for each partition of the range sort
    offsets = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    position = F.col("_before") + F.col("_at") - F.shiftleft(F.col("_part"), 33)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (position % len(weights) + 1).cast("int"))
    table = join_small(ranged.withColumn("_part", part), offsets, "_part", row_bound=n)
    table = materialize(table.select("source", "source_size", weight.cast("long").alias("weight")), "mix-weights")
    first = table.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    total = share * (first["size"] or 0)
    cap = F.col("source_size") * passes
    level = total / first["weight"] if first["weight"] else 0.0
    while True:
        above = F.col("weight") * F.lit(level) > cap
        got = table.agg(
            F.sum(F.when(above, cap).otherwise(0)).alias("cap"), F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("weight")
        ).first()
        if not got["weight"]:
            break
        raised = (total - got["cap"]) / got["weight"]
        if raised == level:
            break
        level = raised
    fair = F.col("weight") * F.lit(level)
    return table.select("source", "source_size", F.when(fair > cap, cap.cast("double")).otherwise(fair).alias("target"))


def _running(batches: Iterable[pa.RecordBatch], size_at: int, source_at: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Adds the words before each row in its source within the partition."""
    last, carried = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        size = batch.column(size_at).to_numpy(zero_copy_only=False).astype(np.int64)
        codes = pc.dictionary_encode(batch.column(source_at), null_encoding="encode")
        code = codes.indices.to_numpy(zero_copy_only=False)
        total = np.cumsum(size)
        before = total - size
        starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        lengths = np.diff(np.r_[starts, len(size)])
        before = before - np.repeat(before[starts], lengths)
        head = codes.dictionary[code[0]].as_py(), True
        if head == last:
            before[: lengths[0]] += carried
        last = codes.dictionary[code[-1]].as_py(), True
        carried = int(before[-1] + size[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before)], names=names)


def mix(
    docs: DataFrame,
    size: Column,
    keep: list[str],
    id_col: str = "doc_id",
    source_col: str = "source",
    weights: tuple = (5, 2, 1),
    share: float = 1.5,
    passes: int = 2,
) -> DataFrame:
    """What a mix of the sources takes of each row.

    Returns (row, size, source_size, target, taken), one row for each row of ``docs``;
    ``row`` is a struct of the columns ``keep``, so no name can clash.  ``taken`` counts
    words: whole passes over the source, and in the last pass the rows up to the budget
    in random-key order, the row at the cut in part.  A source's ``taken`` add up to its
    target rounded down.  Ties of the key go by id, then by size; null sources are one
    source, rows of size 0 take nothing, repeated rows count one by one, and an empty
    table gives an empty result.
    """
    rows = docs.select(
        F.struct(*[F.col(c) for c in keep]).alias("row"),
        F.col(source_col).alias("source"),
        size.alias("size"),
        random_key(F.col(id_col)).alias("_key"),
        F.col(id_col).alias("_id"),
    )
    spark = docs.sparkSession
    prepare(spark)
    order = [F.col("source").asc_nulls_last(), F.col("_key"), F.col("_id"), F.col("size")]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    ranged = ranged.select("row", "source", "size", F.spark_partition_id().cast("long").alias("_part"))
    names = [*ranged.columns, "_inside"]
    schema = T.StructType([*ranged.schema.fields, T.StructField("_inside", T.LongType())])
    ranged = materialize(map_arrow(ranged, lambda b: _running(b, 2, 1, names), schema), "mix-ranged")
    return _cut(ranged, weights, share, passes)


def _cut(ranged: DataFrame, weights: tuple, share: float, passes: int) -> DataFrame:
    parts = materialize(ranged.groupBy("source", "_part").agg(F.sum("size").alias("_sum")), "mix-parts")
    targets = source_targets(parts.groupBy("source").agg(F.sum("_sum").alias("source_size")), weights, share, passes)
    # a source has at most one row here for each partition of the range sort
    offsets = parts.select(
        "source", "_part",
        (F.sum("_sum").over(Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_sum")).alias("_before"),
    )
    plan = offsets.join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    plan = plan.select(F.col("source").alias("_source"), F.col("_part").alias("_p"), "_before", "source_size", "target")
    joined = join_small(
        ranged, plan, (F.col("_part") == F.col("_p")) & F.col("source").eqNullSafe(F.col("_source")), row_bound=parts.count(), max_rows=100_000
    )
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.floor("target") - whole * F.col("source_size")
    last = F.least(F.greatest(rest - F.col("_before") - F.col("_inside"), F.lit(0)), F.col("size"))
    return joined.select("row", "size", "source_size", "target", (whole * F.col("size") + last).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each whole pass that takes
    the document, and one with its first words where the budget ends inside it."""
    out = mix(docs, word_count(F.col("text")), docs.columns, **options)
    copies = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    partial = F.when(F.col("size") > 0, F.col("taken") % F.col("size")).otherwise(0).cast("int")
    cuts = F.concat(F.array_repeat(F.lit(-1), copies), F.when(partial > 0, F.array(partial)).otherwise(F.array().cast("array<int>")))
    out = out.select("row", F.explode(cuts).alias("_cut"))
    words = F.regexp_extract_all(F.col("row.text"), F.lit(SPACED_WORD), F.lit(1))
    text = F.when(F.col("_cut") < 0, F.col("row.text")).otherwise(F.array_join(F.slice(words, F.lit(1), F.greatest(F.col("_cut"), F.lit(0))), ""))
    return out.select(*[text.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
