"""Embedding whitening by weighted multiplicity covariance.

Vectors become integer vectors x.  Equal x are grouped once and carry their number as a
fit weight; sums, the centred covariance and the whitened values are made from the distinct
vectors alone, and every row takes its values back by a join on x.

The driver sees a row for each dimension and a covariance of dimension x dimension; both are
bounded by the vectors' width, not by the rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Stages, materialize
from .common import map_arrow, prepare

#: An entry c counts as floor(SCALE * c) + OFFSET, and beyond +-LARGEST as that.
SCALE = 1024
OFFSET = 100_000
LARGEST = float(1 << 50)
#: Directions whose variance is below this share of the largest are no components.
LEAST_SHARE = 1e-10
#: Groups with more than a row in HOT of all are joined apart; there are fewer than HOT.
HOT = 1024
EXACT = 2.0**62

OUTPUT = "component int, n long, deviation decimal(38), whitened double, explained double, identity_error double"


def finite(vec: Column) -> Column:
    """Whether a vector is there and holds finite entries alone."""
    return F.coalesce(vec.isNotNull() & ~F.exists(vec, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))), F.lit(False))


def integers(vec: Column) -> Column:
    def entry(c):
        scaled = F.least(F.greatest(c.cast("double") * SCALE, F.lit(-LARGEST)), F.lit(LARGEST))
        return F.floor(scaled).cast("long") + OFFSET

    return F.transform(vec, entry)


def _matrix(column: pa.Array, width: int, fill, dtype) -> np.ndarray:
    """Rows of a list column, short ones filled up."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.full((len(sizes), width), fill, dtype)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _largest(x: np.ndarray) -> float:
    return float(np.abs(x).max()) if x.size else 0.0


def _integer_sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact weighted sums of a partition by dimension, and the weight that has an entry
    there; dimension -1 has the weight of all vectors."""
    total: dict[int, int] = {}
    present: dict[int, int] = {}
    for batch in batches:
        w = batch.column("w").to_numpy(zero_copy_only=False).astype(np.int64)
        sizes = batch.column("x").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        present[-1] = present.get(-1, 0) + int(w.sum())
        for size in np.unique(sizes):
            at = sizes == size
            x = _matrix(batch.column("x").filter(pa.array(at)), int(size), 0, np.int64)
            few = _largest(x) * float(w[at].sum()) < EXACT
            sums = w[at] @ x if few else w[at].astype(object) @ x.astype(object)
            for d in range(int(size)):
                total[d] = total.get(d, 0) + int(sums[d])
                present[d] = present.get(d, 0) + int(w[at].sum())
    dims = sorted(present)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(dims, pa.int32()),
            pa.array([Decimal(total.get(d, 0)) for d in dims], pa.decimal128(38, 0)),
            pa.array([present[d] for d in dims], pa.int64()),
        ],
        names=["dim", "total", "present"],
    )


@dataclass(frozen=True)
class Fit:
    """Number of fitted vectors, exact sums by dimension, unit components (a column each)
    and their variances, with the sum of all variances."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    variances: np.ndarray
    trace: float

    @property
    def width(self) -> int:
        return len(self.sums)


def _deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n * x - sums, exactly."""
    if _largest(x) * n < EXACT / 2 and max(map(abs, sums), default=0) < EXACT / 2:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _scatter(df: DataFrame, width: int, centred) -> np.ndarray:
    """Sum of w * c c' over the rows, c being ``centred(batch)``, a row each.  Every task sums
    its partition; the partial matrices are added by entry in a shuffle."""

    def run(batches):
        out = np.zeros((width, width))
        for batch in batches:
            c = centred(batch)
            w = batch.column("w").to_numpy(zero_copy_only=False).astype(np.float64)
            out += (c * w[:, None]).T @ c
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width), pa.int32()), pa.array([out[i, i:] for i in range(width)], pa.list_(pa.float64()))], names=["i", "row"]
        )

    parts = map_arrow(df, run, "i int, row array<double>").select("i", F.posexplode("row").alias("j", "v"))
    out = np.zeros((width, width))
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r["i"], r["i"] + r["j"]] = out[r["i"] + r["j"], r["i"]] = r["v"]
    return out


def _counted(rows: DataFrame, weights: str) -> DataFrame:
    """Distinct x with their fit weight; copies are counted before the shuffle."""
    weight = F.sum("w") if weights == "counts" else F.lit(1)
    return rows.groupBy("x").agg(weight.cast("long").alias("w"), F.sum("w").cast("long").alias("copies"))


def _sums(distinct: DataFrame) -> tuple[int, list[int], bool]:
    """Weight of all vectors, sums by dimension (a missing entry counts as OFFSET, an
    entry of zero), and whether some vector is shorter than another."""
    found = map_arrow(distinct.select("x", "w"), _integer_sums, "dim int, total decimal(38,0), present long")
    rows = {r["dim"]: r for r in found.groupBy("dim").agg(F.sum("total").alias("total"), F.sum("present").alias("present")).collect()}
    n = rows[-1]["present"] if rows else 0
    sums = [int(rows[d]["total"]) + OFFSET * (n - rows[d]["present"]) for d in range(max(rows, default=-1) + 1)]
    return n, sums, any(rows[d]["present"] != n for d in range(len(sums)))


def fit(distinct: DataFrame, n: int, sums: list[int], components: int) -> Fit:
    """Leading unit eigenvectors of the covariance (divisor n, centred before multiplying)."""
    total = tuple(sums)
    width = len(total)

    def centred(batch):
        return _deviations(_matrix(batch.column("x"), width, OFFSET, np.int64), n, total).astype(np.float64) / n

    cov = _scatter(distinct.select("x", "w"), width, centred) / n
    values, vectors = np.linalg.eigh(cov) if width else (np.zeros(0), np.zeros((0, 0)))
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > max(LEAST_SHARE * (values.max() if width else 0.0), 0.0)]
    chosen = vectors[:, order]
    if chosen.size:  # one sign for all rows: the largest entry is positive
        chosen = chosen * np.sign(chosen[np.abs(chosen).argmax(0), np.arange(chosen.shape[1])])
    return Fit(n, total, chosen, values[order], float(np.trace(cov)))


def _whitened(model: Fit):
    scale = np.sqrt(model.variances)

    def run(batches):
        for batch in batches:
            dev = _deviations(_matrix(batch.column("x"), model.width, OFFSET, np.int64), model.n, model.sums)
            y = (dev.astype(np.float64) / model.n) @ model.components / scale
            if dev.dtype == object or _largest(dev) ** 2 * max(1, model.width) >= EXACT:
                dev = dev.astype(object)
            square = [Decimal(int(v)) for v in (dev * dev).sum(1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(list(y), pa.list_(pa.float64())), pa.array(square, pa.decimal128(38, 0))],
                names=[*batch.schema.names, "y", "deviation"],
            )

    return run


def identity_error(fitted: DataFrame, n: int, k: int) -> float:
    """Largest absolute entry of the whitened values' covariance minus the identity."""
    if not k:
        return 0.0
    first = fitted.agg(*[F.sum(F.col("w") * F.col("y")[c]).alias(f"c{c}") for c in range(k)]).first()
    mean = np.array([first[c] for c in range(k)]) / n
    cov = _scatter(fitted.select("y", "w"), k, lambda batch: _matrix(batch.column("y"), k, 0.0, np.float64) - mean) / n
    return float(np.abs(cov - np.eye(k)).max())


def whiten(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 8, weights: str = "counts") -> DataFrame:
    """Whitened coordinates of every vector.

    Returns (id_col, component, n, deviation, whitened, explained, identity_error): a row for
    each vector and component.  ``weights="counts"`` fits to all vectors, ``"one"`` to each
    distinct x once; either way every row gets its values.

    Rows whose vector is null or has a null, NaN or infinite entry give no rows.  An entry
    whose x would pass 2**50 counts as 2**50.  A vector shorter than others (an empty one
    too) counts as ending in zeros.  Repeated rows and equal vectors are each returned, with
    equal values; a null id is an id.  Components whose variance is not above 1e-10 of
    the largest are left out, so equal vectors alone, one vector, or an empty table give an
    empty result.  Other columns are ignored, whatever their names; texts play no part.
    A group of equal vectors is one row in all but the last join; groups that are more than
    one row in 1,024 are broadcast there, at most 1,023 of them.
    """
    if weights not in ("counts", "one"):
        raise ValueError("weights are 'counts' or 'one'")
    spark = rows.sparkSession
    prepare(spark)
    vec = F.col(vec_col)
    own = rows.where(finite(vec)).select(F.col(id_col).alias("id"), integers(vec).alias("x"))
    with Stages(spark) as stages:
        distinct = stages.write(_counted(own.select("x", F.lit(1).alias("w")), weights), "distinct-vectors")
        n, sums, ragged = _sums(distinct)
        if ragged:
            full = F.concat("x", F.array_repeat(F.lit(OFFSET).cast("long"), F.lit(len(sums)) - F.size("x")))
            own = own.withColumn("x", full)
            again = distinct.select(full.alias("x"), F.col("copies").alias("w"))
            distinct = stages.write(_counted(again, weights), "padded-vectors")
            n, sums, _ = _sums(distinct)
        model = fit(distinct, n, sums, components) if n else Fit(0, (), np.zeros((0, 0)), np.zeros(0), 0.0)
        k = len(model.variances)
        if not k:
            empty = [F.lit(None).cast(c.split(" ")[1]).alias(c.split(" ")[0]) for c in OUTPUT.split(", ")]
            return own.where(F.lit(False)).select(F.col("id").alias(id_col), *empty)
        done = map_arrow(distinct, _whitened(model), "x array<long>, w long, copies long, y array<double>, deviation decimal(38,0)")
        fitted = materialize(done, "whitened-vectors")
    error = identity_error(fitted, n, k)
    values = _joined_back(own, fitted)
    share = F.array(*[F.lit(float(e / model.trace)) for e in model.variances])
    out = values.select("id", "deviation", F.posexplode("y").alias("at", "whitened"))
    return out.select(
        F.col("id").alias(id_col),
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(share, F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def _joined_back(own: DataFrame, fitted: DataFrame) -> DataFrame:
    """Every row with the values of its x.  Groups of very many copies meet their rows by a
    broadcast of fewer than HOT rows, the others in a shuffle that no key can dominate."""
    total = fitted.agg(F.sum("copies")).first()[0] or 0
    hashed = fitted.select(F.xxhash64("x").alias("h"), "x", "copies", "y", "deviation")
    own = own.select("id", F.xxhash64("x").alias("h"), "x")
    hot = F.col("copies") * HOT > total
    if not hashed.where(hot).count():
        return own.join(hashed, ["h", "x"])
    often = F.broadcast(hashed.where(hot))
    rest = own.join(F.broadcast(hashed.where(hot).select("h", "x")), ["h", "x"], "left_anti")
    return own.join(often, ["h", "x"]).unionByName(rest.join(hashed.where(~hot), ["h", "x"]))
