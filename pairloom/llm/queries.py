"""The numbered operators applied to the test tables, and their SQL twins."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from . import (
    conversation_repair,
    embedding_dups,
    fingerprints,
    hash_search,
    license_scan,
    line_quality,
    mixing,
    near_dups,
    prefix_bpe,
    suffix_dups,
    token_files,
    warc,
    whitening,
)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op9_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text and the text that they decode to, as digests."""
    out = prefix_bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    docs = table(spark, sf_dir, "documents")
    out = mixing.mix(docs, mixing.word_count(F.col("text")), ["doc_id"])
    return out.select("row.doc_id", "size", "source_size", "target", "taken")


ORACLES["op5_mix_sources"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 16) AS k,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM d GROUP BY source),
t AS (SELECT 1.5::DOUBLE * sum(source_size)::DOUBLE AS total, sum(w)::DOUBLE AS ws FROM s),
lv AS (
  SELECT 0 AS n, total / ws AS lev FROM t
  UNION ALL
  SELECT n + 1, (SELECT ((SELECT total FROM t) - sum(CASE WHEN w * lev > 2 * source_size THEN 2 * source_size ELSE 0 END)::DOUBLE)
                 / nullif(sum(CASE WHEN w * lev > 2 * source_size THEN 0 ELSE w END), 0)::DOUBLE FROM s)
  FROM lv WHERE n < (SELECT count(*) FROM s) AND lev IS NOT NULL),
top AS (SELECT max(lev) AS lev FROM lv),
g AS (SELECT source, source_size, CASE WHEN w * lev > 2 * source_size THEN (2 * source_size)::DOUBLE ELSE w * lev END AS target FROM s, top),
p AS (SELECT doc_id, source, size,
        CAST(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS before FROM d)
SELECT p.doc_id, p.size, g.source_size, g.target,
  CAST(CASE WHEN g.source_size = 0 THEN 0 ELSE
    floor(g.target / g.source_size) * p.size
    + least(greatest(floor(g.target) - floor(g.target / g.source_size) * g.source_size - p.before, 0), p.size) END AS BIGINT) AS taken
FROM p JOIN g ON p.source IS NOT DISTINCT FROM g.source
"""


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back from them."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    warc.write_archive(warc.page_records(table(spark, sf_dir, "pages")), path)
    back = warc.read_archive(spark, path).where(F.col("record_type").isin("response", "revisit"))
    return back.select(
        warc.page_id("record_id").alias("page_id"),
        F.col("payload_length").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        warc.page_id("refers_to").alias("refers_to"),
    )


@query
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids as the token files give them back."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    files = token_files.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), folder)
    return token_files.read_tokens(files, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op7_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups on three-word shingles at 85 per cent."""
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"), percent=85, k=3)


@query
def op8_suffix_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remains of each text without the 200-byte strings that occur again."""
    out = suffix_dups.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["size"])
    return out.select(
        "row.doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op4_embedding_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of vectors of one label with a cosine of 0.98 or more."""
    return embedding_dups.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


ORACLES["op4_embedding_dups"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  AND list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.98),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS low FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, least(e.vec_id, coalesce(c.low, e.vec_id)) AS component_id,
  e.vec_id = least(e.vec_id, coalesce(c.low, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN n ON e.vec_id = n.a LEFT JOIN c ON e.vec_id = c.a
"""


@query
def op10_hash_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found for every twentieth vector."""
    return hash_search.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight whitened coordinates of every vector, fitted to all vectors."""
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))


@query
def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order MinHash of every document and of its edited text."""
    out = fingerprints.fingerprints(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("signature")).alias("fingerprint"), fingerprints.as_text(F.col("edited_signature")).alias("edited_fingerprint"),
        "near_edited", "near_next",
    )


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every damaged conversation, its cheapest repair and what that gives."""
    conversations = table(spark, sf_dir, "conversations")
    rows = conversation_repair.damaged(conversations)
    return conversation_repair.with_digest(rows, conversation_repair.repair(rows, conversations))


@query
def op2_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document from its lines; labels of the held-out fold are not used."""
    docs = table(spark, sf_dir, "documents")
    model = line_quality.train(docs, table(spark, sf_dir, "labels"))
    out = line_quality.score(docs, model)
    return out.select("doc_id", line_quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License of every document in a tree of source, language and hundreds of ids."""
    docs = table(spark, sf_dir, "documents")
    folder = F.concat_ws("/", F.coalesce("source", F.lit("-")), F.coalesce("lang", F.lit("-")), F.floor(F.col("doc_id") / 100).cast("string"))
    out = license_scan.license_scan(docs.select("doc_id", "text", folder.alias("dir")), "doc_id", "dir")
    return out.withColumnRenamed("id", "doc_id")
