"""Vocabulary cache: load if present and still valid, otherwise build and save.

A one-row table, written last, names the folder of the vocabulary and records the build
parameters, the word split's name and a fingerprint of the corpus lines (row count
and an order-independent sum of row hashes, one distributed aggregate).  A build that
stops half-way leaves a folder that nothing names, and the next call builds anew.
A cached vocabulary whose record does not match the current corpus or parameters is
refused instead of being silently reused.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, PrepConfig
from ..functions.text import split_words
from ..operators.vocab import SplitFn, build_vocab, token_counts
from ..session import Stages

META_DIR = "meta"


class StaleVocabularyError(ValueError):
    """The cached vocabulary was built from another corpus or other settings."""


def corpus_fingerprint(lines: DataFrame) -> tuple[int, int]:
    """``(rows, sum of xxhash64(row_id, text))`` over the lines: equal for equal
    line sets whatever the partitioning."""
    r = lines.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("row_id", "text").cast("decimal(38,0)")).alias("h"),
    ).first()
    return int(r["n"]), int(r["h"] or 0)


def _params(cfg: PrepConfig, split_name: str) -> str:
    return json.dumps(
        {
            "vocab_size": cfg.vocab_size,
            "min_frequency": cfg.min_frequency,
            "special_tokens": list(cfg.special_tokens),
            "split": split_name,
        },
        sort_keys=True,
    )


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def get_or_build_vocab(lines: DataFrame, path: str, cfg: PrepConfig = DEFAULT, split_fn: SplitFn = split_words,
                       split_name: str | None = None) -> DataFrame:
    """Vocabulary ``(token, id, n)`` cached under ``path``.

    ``split_name`` names the word split in the record (by default the function's own
    name); a cache made with another split is refused.
    """
    spark = lines.sparkSession
    base = path.rstrip("/")
    n, h = corpus_fingerprint(lines)
    params = _params(cfg, split_name or getattr(split_fn, "__qualname__", repr(split_fn)))
    mpath = f"{base}/{META_DIR}"
    if _exists(spark, f"{mpath}/_SUCCESS"):
        meta = spark.read.parquet(mpath).first()
        if meta is None or meta["rows"] != n or meta["fingerprint"] != str(h) or meta["params"] != params:
            raise StaleVocabularyError(f"vocabulary at {path} does not match this corpus or these settings")
        return spark.read.parquet(f"{base}/{meta['folder']}")
    folder = f"vocab-{uuid.uuid4().hex}"
    with Stages(spark) as stages:  # the counts are read twice by the selection
        build_vocab(stages.write(token_counts(lines, split_fn), "token_counts"), cfg).write.parquet(f"{base}/{folder}")
    record = spark.createDataFrame([(n, str(h), params, folder)], "rows bigint, fingerprint string, params string, folder string")
    record.coalesce(1).write.mode("overwrite").parquet(mpath)
    return spark.read.parquet(f"{base}/{folder}")
