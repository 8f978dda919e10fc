"""Approximate nearest neighbours by multi-index hashing (operator 10).

Vectors are lengthened by one component, so that the largest inner product is the smallest
angle, and turned into binary codes by a learned rotation.  A code is split into
substrings, each with an index of its own; by the pigeonhole principle a code within a
Hamming radius of a query agrees with it in some substring up to a small radius, so
probing those buckets retrieves every code within the radius.  What is retrieved is
ranked by the inner product of the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import map_arrow, prepare
from .vectors import bounded_sample, matrix, usable

SAMPLE = 16_384  # vectors that the rotation is learned on
PROBES = 64  # queries whose true neighbours set the radius
RECALL = 0.98  # share of their true neighbours that the radius holds
BITS, SUBSTRING = 64, 8
BLOCK = 65_536  # most vectors in an index block, about
SMALL_BLOCK, FEW_BLOCKS = 4_096, 64  # a table of fewer blocks than that has smaller ones
CHUNK = 256  # queries answered at once
POPCOUNT = np.bitwise_count(np.arange(256, dtype=np.uint8)).astype(np.int64)


@dataclass
class Codes:
    """Learned rotations and the length that vectors are filled up to."""

    rotations: np.ndarray  # width + 1 by BITS
    longest: float

    def lengthen(self, x: np.ndarray) -> np.ndarray:
        rest = np.maximum(0.0, self.longest**2 - (x * x).sum(1))
        return np.c_[x, np.sqrt(rest)]

    def of(self, x: np.ndarray) -> np.ndarray:
        return _pack(self.lengthen(x) @ self.rotations)

    def of_queries(self, q: np.ndarray) -> np.ndarray:
        return _pack(np.c_[q, np.zeros(len(q))] @ self.rotations)


def _pack(y: np.ndarray) -> np.ndarray:
    return np.packbits(y > 0, axis=1)


def learn(x: np.ndarray, longest: float, seed: int = 10, rounds: int = 20) -> Codes:
    """Rotations that bring the sample's vectors close to the corners of a cube."""
    rng = np.random.default_rng(seed)
    codes = Codes(np.zeros((0, 0)), longest)
    y = codes.lengthen(x)
    width = y.shape[1]
    axes = np.linalg.eigh(y.T @ y)[1].T[::-1]
    parts, have = [], 0
    while have < BITS:
        r = np.linalg.qr(rng.normal(size=(width, width)))[0]
        z = y @ axes.T
        for _ in range(rounds):
            u, _, vt = np.linalg.svd(np.where(z @ r > 0, 1.0, -1.0).T @ z)
            r = (u @ vt).T
        parts.append(axes.T @ r)
        have += width
    return Codes(np.concatenate(parts, axis=1)[:, :BITS], longest)


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of packed codes, all of a to all of b."""
    total = np.zeros((len(a), len(b)), np.uint8)
    for j in range(a.shape[1]):
        total += np.bitwise_count(a[:, j, None] ^ b[None, :, j])
    return total


class Index:
    """The substring indexes of one block of vectors."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, codes: np.ndarray):
        self.ids, self.x, self.codes = ids, x, codes
        self.order = [np.argsort(codes[:, j], kind="stable") for j in range(codes.shape[1])]
        self.bounds = [np.r_[0, np.cumsum(np.bincount(codes[:, j], minlength=256))] for j in range(codes.shape[1])]

    def retrieve(self, query_codes: np.ndarray, radius: int) -> np.ndarray:
        """A mask of the codes within the radius of each query.

        If each substring j differed in more than r_j places, with the r_j + 1 adding up to
        more than the radius, the codes would differ in more than the radius; so some
        substring is found by probing.
        """
        m = query_codes.shape[1]
        each, extra = divmod(radius + 1, m)
        mask = np.zeros((len(query_codes), len(self.ids)), bool)
        for j in range(m):
            reach = each + (j < extra) - 1
            if reach < 0:
                continue
            values, back = np.unique(query_codes[:, j], return_inverse=True)
            for k, v in enumerate(values.tolist()):
                near = np.flatnonzero(POPCOUNT[np.arange(256) ^ v] <= reach)
                rows = np.concatenate([self.order[j][self.bounds[j][u] : self.bounds[j][u + 1]] for u in near.tolist()])
                mask[np.ix_(np.flatnonzero(back == k), rows)] = True
        mask &= hamming(query_codes, self.codes) <= radius
        return mask

    def search(self, query_ids: np.ndarray, q: np.ndarray, query_codes: np.ndarray, radius: int, k: int) -> Iterator[tuple]:
        """(query, id, score) of the k best retrieved, ties to the smaller id."""
        mask = self.retrieve(query_codes, radius)
        mask &= self.ids[None, :] != query_ids[:, None]
        some = np.flatnonzero(mask.any(0))
        if not len(some):
            return
        score = np.where(mask[:, some], q @ self.x[some].T, -np.inf)
        top = min(k, len(some))
        floor = np.partition(score, len(some) - top, axis=1)[:, len(some) - top]
        # rounding of the product must not decide: what is as good as the k-th stays
        slack = 1e-9 * (1 + np.abs(np.where(np.isfinite(floor), floor, 0)))
        near = (score >= np.where(np.isfinite(floor), floor - slack, -np.inf)[:, None]) & mask[:, some]
        for i in range(len(q)):
            rows = some[near[i]]
            exact = (self.x[rows] * q[i]).sum(1)
            best = np.lexsort((self.ids[rows], -exact))[:k]
            for b in best.tolist():
                yield query_ids[i], self.ids[rows[b]], exact[b]


FOUND = "query_id long, vec_id long, score double"


def _answer(batches: Iterable[pa.RecordBatch], codes: Codes, width: int, radius: int, k: int) -> Iterator[pa.RecordBatch]:
    """Blocks come one after the other, each its vectors first, then the queries."""
    block, ids, xs, index = None, [], [], None
    for batch in batches:
        blocks = batch.column(0).to_numpy(zero_copy_only=False)
        queries = batch.column(1).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((blocks[1:] != blocks[:-1]) | (queries[1:] != queries[:-1])) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            if lo == hi:
                continue
            if blocks[lo] != block:
                block, ids, xs, index = blocks[lo], [], [], None
            own = batch.column(2).slice(lo, hi - lo).to_numpy(zero_copy_only=False)
            x = matrix(batch.column(3).slice(lo, hi - lo), width)
            if not queries[lo]:
                ids.append(own)
                xs.append(x)
                continue
            if not ids:
                continue
            if index is None:
                x_all = np.concatenate(xs)
                index, xs = Index(np.concatenate(ids), x_all, codes.of(x_all)), []
            for at in range(0, len(own), CHUNK):
                part = x[at : at + CHUNK]
                rows = list(index.search(own[at : at + CHUNK], part, codes.of_queries(part), radius, k))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["query_id", "vec_id", "score"])


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _blocks(rows: DataFrame, queries: DataFrame, n: int) -> DataFrame:
    """Vectors hashed to n blocks, and every query in each."""
    here = rows.select(F.pmod(F.xxhash64("id"), F.lit(n)).cast("int").alias("block"), F.lit(False).alias("query"), "id", "vec")
    asked = queries.select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("block"), F.lit(True).alias("query"), "id", "vec")
    return here.union(asked).repartition(n, "block").sortWithinPartitions("block", "query")


def _radius(rows: DataFrame, queries: DataFrame, codes: Codes, width: int, k: int) -> int:
    """The radius that holds the wanted share of the true neighbours, over all rows, of
    a bounded sample of the queries."""
    sample = bounded_sample(queries, "id", ["id", "vec"], PROBES)
    q = matrix(pa.array([r["vec"] for r in sample], pa.list_(pa.float64())), width)
    q_ids = np.array([r["id"] for r in sample])
    q_codes = codes.of_queries(q)

    def run(batches):
        best: list = [[] for _ in q_ids]
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            x = matrix(batch.column(1), width)
            score = np.where(ids[None, :] == q_ids[:, None], -np.inf, q @ x.T)
            far = hamming(q_codes, codes.of(x))
            for i in range(len(q_ids)):
                top = np.argsort(-score[i], kind="stable")[:k]
                pairs = zip(score[i, top].tolist(), far[i, top].tolist(), strict=True)
                best[i] = sorted([*best[i], *(p for p in pairs if p[0] > -np.inf)], reverse=True)[:k]
        rows = [(i, s, d) for i, b in enumerate(best) for s, d in b]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["probe", "score", "distance"])

    found = map_arrow(rows.select("id", "vec"), run, "probe long, score double, distance long")
    rank = F.row_number().over(Window.partitionBy("probe").orderBy(F.col("score").desc(), "distance"))
    far = [r[0] for r in found.withColumn("rank", rank).where(F.col("rank") <= k).select("distance").collect()]
    return int(np.quantile(far, RECALL, method="higher")) if far else BITS


def nearest(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The k rows of largest inner product found for each query row.

    ``is_query`` is a condition on ``vectors``.  Returns (query_id, rank, vec_id, score),
    nearest first, ties to the smaller id; the score is the inner product of the
    original vectors in double precision.  Vectors that are null, empty, zero or hold a null or
    non-finite component, and those without an id, take no part, nor do vectors of another
    length than the most frequent one (of two as frequent, the greater).  Rows with the
    query's own id are no candidates of it; other rows that share an id are candidates one
    by one, and of query rows that share an id the smallest vector asks.  No vectors or
    no queries give an empty result.  Other columns are not read.

    The rotation is learned on a bounded sample, and the radius is set so that it holds
    98 per cent of the true neighbours of 64 sampled queries, searched over all rows.
    Every row is indexed.  A query that finds fewer than k rows within the radius is
    asked again with the largest radius, which retrieves all.
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows = vectors.where(usable(F.col(vec_col)) & F.col(id_col).isNotNull())
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    sizes = rows.groupBy(F.size("vec").alias("size")).agg(F.count("*").alias("n"), F.max(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))).alias("longest"))
    common = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width, count = common["size"], common["n"]
    rows = materialize(rows.where(F.size("vec") == width), "search-rows")
    queries = materialize(rows.where("asks").groupBy("id").agg(F.min("vec").alias("vec")), "search-queries")
    sample = bounded_sample(rows, "id", ["vec"], SAMPLE)
    codes = learn(matrix(pa.array([r["vec"] for r in sample], pa.list_(pa.float64())), width), common["longest"])
    radius = _radius(rows, queries, codes, width, k)
    n = max(-(-count // BLOCK), min(FEW_BLOCKS, -(-count // SMALL_BLOCK)))
    ask = lambda q, r: materialize(_best(map_arrow(_blocks(rows, q, n), lambda b: _answer(b, codes, width, r, k), FOUND), k), "search-found")
    found = ask(queries, radius)
    if radius < BITS:
        enough = found.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= k)
        short = materialize(queries.join(enough, F.col("id") == F.col("query_id"), "left_anti"), "search-short")
        if not short.isEmpty():
            found = found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(ask(short, BITS))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
