"""Corpus operators: clean lines and document segmentation.

Input rows are ``(row_id: bigint, text: string)`` where ``row_id`` carries the
corpus order: unique, not NULL, and with text in every row (an error otherwise).
Segmentation is a gaps-and-islands problem over that order: each boundary row
(empty after strip, or a heading) closes the current document.  It is computed with
two-level scans (see ``scan``), so neither the corpus order nor a single huge
document ever lands in one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, PrepConfig
from ..functions.text import is_boundary, required, strip_start, strip_text
from ..session import join_small, materialize
from .scan import Buckets, choose_buckets, exclusive_prefix

SENTENCE_COLUMNS = ["doc_key", "sent_idx", "n_sents", "row_id", "text"]
Write = Callable[[DataFrame, str], DataFrame]


def strip_rows(rows: DataFrame) -> DataFrame:
    return rows.select("row_id", strip_text(required("text", "text")).alias("text"))


def clean_lines(rows: DataFrame) -> DataFrame:
    """Stripped, non-empty rows (headings kept): what the vocabulary sees.  A NULL
    text raises."""
    s = strip_rows(rows)
    return s.filter(F.col("text") != F.lit(""))


def _boundary(boundary_col: str | None, every_text: bool = False) -> Column:
    """``every_text``: a NULL text raises in marked rows too."""
    start = strip_start(required("text", "text"))
    if boundary_col is None:
        return is_boundary(start)
    empty, marked = start == F.lit(""), F.col(boundary_col)
    return empty | marked if every_text else marked | empty


def _flagged(rows: DataFrame, boundary_col: str | None, text: bool = True) -> DataFrame:
    stripped = [strip_text(required("text", "text")).alias("text")] if text else []
    return rows.select("row_id", *stripped, _boundary(boundary_col).cast("bigint").alias("_b"))


def boundary_flags(rows: DataFrame, boundary_col: str | None = None, write: Write = materialize) -> DataFrame:
    """``(row_id, _b)``, written: what the scans over the order need of the corpus,
    once, instead of reading and stripping the text for each."""
    return write(_flagged(rows, boundary_col, text=False), "boundary_flags")


def sentence_lines(rows: DataFrame, buckets: Buckets, boundary_col: str | None = None) -> DataFrame:
    """``(bucket, row_id, text)`` of all rows that are not boundaries, stripped: the text of
    ``segment_documents`` before its scans, for consumers that join its index by row.  Rows of
    documents that are dropped are among them.  A NULL text raises, in boundary rows too."""
    x = rows.where(~_boundary(boundary_col, every_text=True))
    return x.select(buckets.column("row_id").alias("bucket"), "row_id", strip_text(required("text", "text")).alias("text"))


def segment_documents(
    rows: DataFrame,
    cfg: PrepConfig = DEFAULT,
    boundary_col: str | None = None,
    flags: DataFrame | None = None,
    buckets: Buckets | None = None,
    min_sentences: int | None = None,
    text: bool = True,
    write: Write = materialize,
) -> DataFrame:
    """Sentences of kept documents, flat.

    Output columns: ``doc_key`` (number of boundary rows up to the document,
    unique and increasing in corpus order), ``sent_idx`` (0-based position),
    ``n_sents``, ``row_id``, ``text`` (stripped; without ``text`` the narrow index of the
    sentences) and ``bucket`` (the scan bucket; the result is hash-partitioned by it).

    ``boundary_col`` names a boolean column that marks boundary rows
    explicitly (e.g. conversation starts); empty rows are boundaries either
    way.  Without it the heading rule applies.  Documents with fewer than
    ``min_sentences`` sentences are dropped.  A row_id that is NULL or occurs twice, and a
    NULL text, end the job with an error.

    Per row, with ``c`` the running count of non-boundary rows, ``L`` its value
    at the last boundary before the row and ``R`` at the next boundary after
    it: ``sent_idx = c - L - 1`` and ``n_sents = R - L``.  ``L`` and ``R`` are
    a running max and a reverse running min, carried across buckets by the
    bucket table, so no window is partitioned by document.
    """
    min_sentences = cfg.min_sentences if min_sentences is None else min_sentences
    flags = boundary_flags(rows, boundary_col, write) if flags is None else flags
    buckets = choose_buckets(flags, "row_id", cfg) if buckets is None else buckets
    bound = buckets.bound
    bucket = buckets.column("row_id")
    x = (_flagged(rows, boundary_col) if text else flags).withColumn("bucket", bucket)
    flags = flags.withColumn("bucket", bucket)

    is_b = F.col("_b") == 1
    nb = F.lit(1) - F.col("_b")
    # Pass A: per bucket counts and the first/last boundary position.
    a = flags.groupBy("bucket").agg(
        F.sum("_b").alias("n_b"),
        F.sum(nb).alias("n_n"),
        F.max(F.when(is_b, F.col("row_id"))).alias("lb"),
        F.min(F.when(is_b, F.col("row_id"))).alias("fb"),
    )
    # Pass B: non-boundary rows before the last / first boundary of the bucket.
    pb = (
        join_small(flags, a.select("bucket", "lb", "fb"), "bucket",
                   row_bound=bound, max_rows=cfg.broadcast_max_rows)
        .groupBy("bucket")
        .agg(
            F.sum(F.when(~is_b & (F.col("row_id") < F.col("lb")), 1).otherwise(0)).alias("n_before_lb"),
            F.sum(F.when(~is_b & (F.col("row_id") < F.col("fb")), 1).otherwise(0)).alias("n_before_fb"),
        )
    )
    # Bucket table (small): offsets and carries.
    t = exclusive_prefix(a.join(pb, "bucket"), ["bucket"], ["n_b", "n_n"])
    t = t.select(
        "bucket",
        "off_n_b",
        "off_n_n",
        F.when(F.col("n_b") > 0, F.col("off_n_n") + F.col("n_before_lb")).alias("last_c"),
        F.when(F.col("n_b") > 0, F.col("off_n_n") + F.col("n_before_fb")).alias("first_c"),
        F.sum("n_n").over(Window.partitionBy()).alias("total_n"),
    )
    # Running frames only (unbounded preceding): a frame that ends at
    # "unbounded following" is re-aggregated for every row by Spark, which is
    # quadratic; the reverse scan is a running frame in descending order.
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(F.col("bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    t = t.select(
        "bucket",
        "off_n_b",
        "off_n_n",
        F.coalesce(F.max("last_c").over(before), F.lit(0)).alias("carry_in"),
        F.coalesce(F.min("first_c").over(after), F.col("total_n")).alias("carry_out"),
    )

    y = join_small(x, t, "bucket", row_bound=bound, max_rows=cfg.broadcast_max_rows)
    w = Window.partitionBy("bucket").orderBy("row_id")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rest = (
        Window.partitionBy("bucket")
        .orderBy(F.col("row_id").desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # the window sees equal ids side by side: a second one ends the job here
    twice = F.lag("row_id").over(w) == F.col("row_id")
    unique = F.when(twice, F.raise_error(F.lit("row_id must be unique")).cast("bigint")).otherwise(F.col("row_id"))
    y = y.select("*", F.sum("_b").over(upto).alias("_cb"), F.sum(nb).over(upto).alias("_cn"), unique.alias("_id"))
    y = y.select(
        "*",
        F.max(F.when(is_b, F.col("_cn"))).over(upto).alias("_ll"),
        F.min(F.when(is_b, F.col("_cn"))).over(rest).alias("_ln"),
    )
    left = F.coalesce(F.col("off_n_n") + F.col("_ll"), F.col("carry_in"))
    right = F.coalesce(F.col("off_n_n") + F.col("_ln"), F.col("carry_out"))
    out = y.filter(F.col("_b") == 0).select(
        (F.col("off_n_b") + F.col("_cb") + F.col("_id") - F.col("row_id")).cast("bigint").alias("doc_key"),
        (F.col("off_n_n") + F.col("_cn") - left - 1).cast("bigint").alias("sent_idx"),
        (right - left).cast("bigint").alias("n_sents"),
        F.col("_id").alias("row_id"),
        *(["text"] if text else []),
        "bucket",
    )
    if min_sentences > 1:
        out = out.filter(F.col("n_sents") >= min_sentences)
    return out


def number_documents(index: DataFrame, bound: int, cfg: PrepConfig = DEFAULT) -> DataFrame:
    """Adds ``doc_idx``: 0-based number of the kept document in corpus order.

    The count of first sentences up to the row, as a two-level scan over the written
    index; no window or join is keyed by document.
    """
    first = (F.col("sent_idx") == 0).cast("bigint")
    counts = index.groupBy("bucket").agg(F.sum(first).alias("_f"))
    offs = exclusive_prefix(counts, ["bucket"], ["_f"]).select("bucket", "off__f")
    j = join_small(index, offs, "bucket", row_bound=bound, max_rows=cfg.broadcast_max_rows)
    w = Window.partitionBy("bucket").orderBy("row_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return j.select(*index.columns, (F.col("off__f") + F.sum(first).over(w) - 1).cast("bigint").alias("doc_idx"))


def document_lengths(sentences: DataFrame) -> DataFrame:
    """One row per kept document: key, sentence count and first row id.

    Read from the first sentence of each document, so no aggregation by
    document is needed.
    """
    return sentences.filter(F.col("sent_idx") == 0).select(
        "doc_key", "n_sents", F.col("row_id").alias("first_row_id")
    )
