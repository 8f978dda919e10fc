"""Sentence pairs for the next-sentence objective.

One example per non-final sentence ``a`` of a kept document; its id is the
``row_id`` of ``a``.  With probability ``p`` the partner is the next sentence
(``is_next = 1``); otherwise a document is drawn uniformly among the *other*
kept documents and a sentence uniformly within it (``is_next = 0``).

Pairs are made on the narrow sentence index, in which every sentence carries its
document's number; token arrays are attached to the finished pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, PrepConfig
from ..functions.hashing import uniform, uniform_index
from ..session import join_small


def document_table(index: DataFrame) -> DataFrame:
    """``(doc_idx, doc_key, n_sents)``, read from first sentences."""
    return index.filter(F.col("sent_idx") == 0).select("doc_idx", "doc_key", "n_sents")


def nsp_pairs(index: DataFrame, docs: DataFrame, n_docs: int, cfg: PrepConfig = DEFAULT) -> DataFrame:
    """``(example_id, doc_idx, sent_idx, is_next, b_doc_idx, b_sent_idx)``.

    The random document is ``j + (j >= own)`` with ``j`` uniform in
    ``0..D-2``: the law of "redraw until different" without a loop.  Every
    row joins the document table on a uniform target index (positive rows
    ignore it), so the join has no hot key and no union of two branches.
    """
    if n_docs < 2:
        raise ValueError("random pairs need at least two kept documents")
    s = cfg.seed
    a = index.filter(F.col("sent_idx") < F.col("n_sents") - 1)
    eid = F.col("row_id")
    j = uniform_index(uniform(s, "doc", eid), F.lit(n_docs - 1))
    own = a.select(
        eid.alias("example_id"),
        "doc_idx",
        "sent_idx",
        "bucket",
        (uniform(s, "nsp", eid) < F.lit(cfg.nsp_positive_probability)).cast("bigint").alias("is_next"),
        # a draw is never NULL; said here, the join does not draw once more to test it
        F.coalesce((j + F.when(j >= F.col("doc_idx"), 1).otherwise(0)).cast("bigint"), F.lit(-1).cast("bigint")).alias("t_idx"),
    )
    t = docs.select(F.col("doc_idx").alias("t_idx"), F.col("n_sents").alias("t_n"))
    pj = join_small(own, t, "t_idx", row_bound=n_docs, max_rows=cfg.broadcast_max_rows, row_bytes=32)
    pos = F.col("is_next") == 1
    return pj.select(
        "example_id",
        "doc_idx",
        "sent_idx",
        "bucket",
        "is_next",
        F.when(pos, F.col("doc_idx")).otherwise(F.col("t_idx")).alias("b_doc_idx"),
        F.when(pos, F.col("sent_idx") + 1)
        .otherwise(uniform_index(uniform(s, "sent", F.col("example_id")), F.col("t_n")))
        .alias("b_sent_idx"),
    )


def resolve_partner(pairs: DataFrame, index: DataFrame) -> DataFrame:
    """Adds ``b_id``, the partner's row, and ``b_bucket``, its bucket of the order.

    Equi-join of narrow rows on ``(doc_idx, sent_idx)``.  Partner keys are unique for
    positive pairs and uniform within the target document for negative ones;
    AQE splits a partition if one short document is drawn very often.
    """
    b = index.select(F.col("doc_idx").alias("b_doc_idx"), F.col("sent_idx").alias("b_sent_idx"), F.col("row_id").alias("b_id"), F.col("bucket").alias("b_bucket"))
    return pairs.join(b, ["b_doc_idx", "b_sent_idx"])


def attach_tokens(pairs: DataFrame, tokens: DataFrame, n: int) -> DataFrame:
    """Adds ``ids`` and ``ids_b``: the token arrays of both sentences, by row.

    ``tokens`` is stored in ``n`` hash buckets of ``bucket``, the range of the order in which a
    row lies.  Narrow pairs travel to the stored rows of their partners, and with the
    partners' arrays to those of their first sentences, so that arrays move once, and those of
    first sentences never; the plan has to be made within ``session.stored_partitioning``.
    A stored bucket holds ranges of the order of bounded rows, not documents.
    """
    b = tokens.select(F.col("bucket").alias("b_bucket"), F.col("row_id").alias("b_id"), F.col("ids").alias("ids_b"))
    a = tokens.select("bucket", F.col("row_id").alias("example_id"), "ids")
    far = pairs.repartition(n, "b_bucket").join(b, ["b_bucket", "b_id"]).drop("b_bucket", "b_id")
    return far.repartition(n, "bucket").join(a, ["bucket", "example_id"])
