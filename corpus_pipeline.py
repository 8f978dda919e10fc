"""The corpus pipeline: quality, near-duplicates, repeated passages, source mix, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is
written as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import line_quality, mixing, near_dups, prefix_bpe, suffix_dups
from pairloom.llm.common import table
from pairloom.session import materialize

#: SQL has no conditional random field, suffix sorting or BPE; the stages are tested
#: against brute force instead.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier accepts.  It is trained on labelled rows of
    ``documents``; null and empty texts score the share of good labels."""
    model = line_quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return line_quality.accepted(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: five words, similarity 0.8.  Rows of one id
    and rows without an id are compared like any other, for the next stage would remove
    all copies of what stays twice."""
    return near_dups.distinct_documents(docs, percent=80, k=5, link_null_ids=True)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 200 bytes or more that occur again."""
    return suffix_dups.without_repeats(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the number of ids and the text they decode to."""
    out = prefix_bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", "decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mix", mix),
    ("token_ids", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
    return docs
