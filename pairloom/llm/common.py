"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

#: Rows and bytes of an Arrow batch handed to a Python worker, and bytes of text a worker
#: turns into numpy arrays at once; they bound a worker's memory and change no result.
ARROW_ROWS = 1024
ARROW_BYTES = 4 << 20
SLICE_BYTES = 1 << 19
M_MMAP_THRESHOLD = -3  # of the C library's mallopt


def map_arrow(df: DataFrame, fn: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow`` that gives memory back to the system when a partition ends; Python
    workers live on, and would keep it beside what the next stage needs."""

    def run(batches):
        with contextlib.suppress(OSError, AttributeError):
            # arrays of 1 MB and more are blocks of their own, which freeing gives back at once; left
            # alone the limit rises with their size, and the heap is kept in pieces
            ctypes.CDLL(None).mallopt(M_MMAP_THRESHOLD, 1 << 20)
        try:
            yield from fn(batches)
        finally:
            _POWERS.clear()
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # another C library has no such call
                ctypes.CDLL(None).malloc_trim(0)

    return df.mapInArrow(run, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Keep Arrow batches of long texts small, and make this package importable in the
    Python workers wherever the driver was started."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column and its n + 1 offsets; null counts as empty."""
    col = column.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    if len(col) == 0 or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes; a longer row is a range of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit mixer; wraps silently."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def inverse64(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = -(-n // 65_536) * 65_536
        out = []
        for b in (base, inverse64(base)):
            a = np.full(size, np.uint64(b))
            a[0] = 1
            out.append(np.multiply.accumulate(a))
        have = _POWERS[base] = (out[0], out[1])
    return have[0][:n], have[1][:n]


def prefix_hash(values: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of values[i] * base**i, and base**-i, so that the hash of
    values[s:e] is (P[e] - P[s]) * inverse[s]."""
    up, down = powers(base, len(values) + 1)
    p = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=p[1:])
    return p, down


def smallest_reachable(links: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links, the smallest id that it reaches."""
    out, todo = ids.copy(), links.any(1)
    while todo.any():
        start = int(np.flatnonzero(todo)[0])
        group = np.zeros(len(ids), bool)
        edge = group.copy()
        edge[start] = True
        while edge.any():
            group |= edge
            edge = links[edge].any(0) & ~group
        out[group] = ids[group].min()
        todo &= ~group
    return out


def _are_stars(links: DataFrame) -> bool:
    """Whether every node has one link at most to a smaller node, and none of these has one."""
    one = F.lit(1)
    ends = links.select(F.col("a").alias("n"), one.alias("down"), F.lit(0).alias("up")).union(links.select("b", F.lit(0), one))
    nodes = ends.groupBy("n").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    r = nodes.agg(F.max("down"), F.max(F.when(F.col("down") > 0, F.col("up")))).first()
    return (r[0] or 0) <= 1 and not r[1]


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of the undirected links (a, b).

    Returns (node, component): the smallest node reachable, for every node with a
    link to another.  Alternating large-star and small-star rounds on written tables, until
    all links form stars about smallest nodes; the driver sees two numbers a round.
    A node with very many links is a skewed join key: minima are combined before the
    shuffle and written, so that both sides of the join are plain shuffles, which
    adaptive execution can split.  Null ends and self-links are ignored.
    """
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), (F.isnull("a") | F.isnull("b")).alias("none"))
    links = materialize(links.where("not none and a > b").select("a", "b").distinct(), f"{name}-links")
    while not _are_stars(links):
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialize(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), f"{name}-least")
        # large star: larger neighbours move to the smallest of the neighbourhood
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialize(large.where("a > b"), f"{name}-large")
        # small star: the rest of a neighbourhood moves to its smallest member
        least = materialize(large.groupBy("a").agg(F.min("b").alias("m")), f"{name}-least")
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least)
        links = materialize(small.where("a > b").distinct(), f"{name}-small")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
