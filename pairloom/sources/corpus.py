"""Corpus scans and the table adapters.

A corpus is a DataFrame ``(row_id: bigint, text: string)``; ``row_id`` is the
line order, which Spark does not keep by itself.  Row ids are unique and not NULL, and
every row has a text; a row that breaks this ends the job with an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, ROW_ID_STRIDE, PrepConfig
from ..functions.text import required, strip_text
from ..operators.scan import choose_buckets, exclusive_prefix
from ..session import join_small, materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_corpus(
    spark: SparkSession,
    path: str,
    text_col: str = "text",
    order_col: str | None = None,
    cfg: PrepConfig = DEFAULT,
) -> DataFrame:
    """Ordered text rows from Parquet.

    With ``order_col`` that column is the order; segmentation raises if it is not
    unique or has a NULL.  Otherwise the order is
    (file path, row index in file): each file gets the exclusive prefix of
    the row counts of the files before it, so row ids are dense ``0..N-1``.
    The file table has one row per input file and is broadcast when its counted rows
    are below the limits.
    """
    df = spark.read.parquet(path)
    if order_col:
        return df.select(F.col(order_col).cast("bigint").alias("row_id"), F.col(text_col).alias("text"))
    meta = df.select(
        F.col("_metadata.file_path").alias("_f"),
        F.col("_metadata.row_index").alias("_r"),
        F.col(text_col).alias("text"),
    )
    files = materialize(meta.groupBy("_f").agg(F.count(F.lit(1)).alias("_n")), "corpus_files")
    w = Window.orderBy("_f").rowsBetween(Window.unboundedPreceding, -1)
    offs = files.select("_f", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    j = join_small(meta, offs, "_f", row_bound=files.count(), max_rows=cfg.broadcast_max_rows, row_bytes=512)
    return j.select((F.col("_off") + F.col("_r")).cast("bigint").alias("row_id"), "text")


def document_rows() -> Column:
    """The raw rows of a document: heading, an empty one, lines with an empty one after every fifth."""
    lines = F.split(required("text", "text"), "\n", -1)
    body = F.flatten(
        F.transform(
            lines,
            lambda x, i: F.when(((i + 1) % 5) == 0, F.array(x, F.lit(""))).otherwise(F.array(x)),
        )
    )
    return F.concat(F.array(F.concat(F.lit(" = "), required("source", "source"), F.lit(" = ")), F.lit("")), body)


def documents_corpus(documents: DataFrame, cfg: PrepConfig = DEFAULT) -> DataFrame:
    """Corpus rows from the ``documents`` table (raw, not stripped).

    Per document, in the order of ``doc_id``: a heading `` = <source> = ``, an empty row,
    then its lines with an empty row after every fifth.  Row ids are dense: a document
    starts at the number of rows of all documents before it, a two-level running
    sum, so a document may have any number of lines.  A NULL or repeated ``doc_id``, and a
    NULL ``source`` or ``text``, end the job with an error.
    """
    arr = document_rows()
    buckets = choose_buckets(documents, "doc_id", cfg)
    bucket = buckets.column("doc_id").alias("bucket")
    # an n-line text has n + n div 5 rows of its own, and two before
    n_lines = F.size(F.split(required("text", "text"), "\n", -1)).cast("bigint")
    n_rows = n_lines + F.floor(n_lines / 5) + 2
    sums = documents.select(bucket, n_rows.alias("_n")).groupBy("bucket").agg(F.sum("_n").alias("_n"))
    offs = exclusive_prefix(sums, ["bucket"], ["_n"]).select("bucket", "off__n")
    x = join_small(documents.select("doc_id", arr.alias("_rows"), bucket), offs, "bucket",
                   row_bound=buckets.bound, max_rows=cfg.broadcast_max_rows)
    w = Window.partitionBy("bucket").orderBy("doc_id")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    n = F.size("_rows").cast("bigint")
    twice = F.when(F.lag("doc_id").over(w) == F.col("doc_id"), F.raise_error(F.lit("doc_id must be unique")).cast("bigint")).otherwise(0)
    start = F.col("off__n") + F.sum(n).over(upto) - n + twice
    x = x.select(start.alias("_start"), "_rows").select("_start", F.posexplode("_rows").alias("pos", "text"))
    return x.select((F.col("_start") + F.col("pos")).cast("bigint").alias("row_id"), "text")


def document_text_lines() -> Column:
    """Heading and lines of a document, without the empty rows between."""
    heading = F.array(F.concat(F.lit(" = "), required("source", "source"), F.lit(" = ")))
    return F.concat(heading, F.split(required("text", "text"), "\n", -1))


def documents_lines(documents: DataFrame) -> DataFrame:
    """The cleaned lines of ``documents_corpus`` without their order, a column ``text``: for
    consumers that only count.  No bounds, offsets or windows are made.  A NULL or repeated
    ``doc_id`` raises here (a count by id), a NULL ``source`` or ``text`` ends the job."""
    twice = documents.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR doc_id IS NULL").limit(1).collect()
    if twice:
        raise ValueError("doc_id must be unique and not NULL")
    stripped = documents.select(F.explode(document_text_lines()).alias("text")).select(strip_text("text").alias("text"))
    return stripped.filter(F.col("text") != F.lit(""))


def conversations_corpus(conversations: DataFrame) -> DataFrame:
    """Corpus rows from ``conversations``: a document per conversation.

    Each conversation gets one boundary row at ``conv_id * stride`` followed by
    its turns at ``conv_id * stride + turn + 1``; column ``is_start`` marks the
    boundary rows so turn text is never taken for a heading.  The stride is the smallest
    power of two above the largest turn, 2^20 at least; ids that do not fit 63 bits,
    NULL ids and negative turns raise.
    """
    r = conversations.agg(
        F.max("turn").alias("turn"), F.min("turn").alias("least"), F.max(F.abs("conv_id")).alias("conv"),
        F.count_if(F.col("conv_id").isNull() | F.col("turn").isNull()).alias("null"),
    ).first()
    if r["null"] or (r["least"] or 0) < 0:
        raise ValueError("conv_id and turn must not be NULL, nor turn negative")
    stride = max(ROW_ID_STRIDE, 1 << ((r["turn"] or 0) + 1).bit_length())
    if ((r["conv"] or 0) + 1) * stride >= 1 << 63:
        raise ValueError("conversation ids and turns do not fit one row id")
    starts = conversations.select("conv_id").distinct().select(
        (F.col("conv_id") * F.lit(stride)).cast("bigint").alias("row_id"),
        F.lit("").alias("text"),
        F.lit(True).alias("is_start"),
    )
    turns = conversations.select(
        (F.col("conv_id") * F.lit(stride) + F.col("turn") + 1).cast("bigint").alias("row_id"),
        F.col("text"),
        F.lit(False).alias("is_start"),
    )
    return starts.unionByName(turns)


def logits_fixture(embeddings: DataFrame, batch_size: int = 8) -> DataFrame:
    """``embeddings`` read as classifier outputs.

    ``logits`` = the embedding, ``label`` = its class, ``batch_id`` =
    ``vec_id div batch_size``; ``mlm_label`` keeps the class only on every
    13th vector and is the ignore index elsewhere; the pair head's two logits are the
    sums of the vector's halves, its label ``label % 2``.
    """
    half = F.floor(F.size("embedding") / 2).cast("int")
    total = lambda part: F.aggregate(part, F.lit(0.0), lambda a, x: a + x.cast("double"))
    return embeddings.select(
        "vec_id",
        F.expr(f"vec_id div {int(batch_size)}").alias("batch_id"),
        F.col("embedding").alias("logits"),
        F.col("label").cast("bigint").alias("label"),
        F.when(F.col("vec_id") % 13 == 0, F.col("label").cast("bigint")).otherwise(F.lit(-100).cast("bigint")).alias("mlm_label"),
        F.array(total(F.slice("embedding", F.lit(1), half)), total(F.slice("embedding", half + 1, F.size("embedding")))).alias("nsp_logits"),
        (F.col("label") % 2).cast("bigint").alias("nsp_label"),
    )


def scalar_fixture(events: DataFrame) -> DataFrame:
    """``events`` read as a logged scalar stream ``(split, epoch, tag, step, value)``."""
    return events.select(
        F.when(F.col("user_id") % 10 == 0, F.lit("val")).otherwise(F.lit("train")).alias("split"),
        F.expr("event_id div 100").alias("epoch"),
        F.col("event_type").alias("tag"),
        F.col("event_id").alias("step"),
        F.col("value").cast("double").alias("value"),
    )
