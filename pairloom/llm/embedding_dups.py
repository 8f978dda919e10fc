"""Near-duplicate vectors by spherical k-means cells (operator 4).

Vectors are put into the cells of centres fitted on a bounded sample, and compared within
cells by blocked products.  A vector near the border of its cell also visits the cells in
which a vector similar enough to it could lie: if x lies in cell c and y in cell d, then
y.(d - c) >= 0, so x.(c - d) <= |x - y| |c - d|, and |x - y| is at most
sqrt(2 - 2 cos).  So no link is lost to the cells.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import join_small, materialize
from .common import components, map_arrow, prepare, smallest_reachable
from .vectors import bounded_sample, matrix, unit, usable

SAMPLE = 16_384  # vectors that centres are fitted on
CELL = 2_048  # vectors wanted in a cell of the largest label
MOST_CELLS = 1_024
BLOCK = 2_048  # vectors in a block


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 4) -> np.ndarray:
    """Centres of length 1 of unit rows; fewer if the rows are."""
    rng = np.random.default_rng(seed)
    k = min(k, len(x))
    centres = x[rng.permutation(len(x))[:k]]
    for _ in range(rounds):
        cell = (x @ centres.T).argmax(1)
        total = np.zeros_like(centres)
        np.add.at(total, cell, x)
        length = np.sqrt((total * total).sum(1))
        # a centre that lost all its vectors, or whose vectors cancel out, stays
        centres = np.where(length[:, None] > 1e-12, total / np.maximum(length, 1e-300)[:, None], centres)
    return centres


def _assign(batches: Iterable[pa.RecordBatch], centres: np.ndarray, cosine: float) -> Iterator[pa.RecordBatch]:
    """Each vector in its own cell, and in later cells that may hold a partner."""
    width = centres.shape[1]
    reach = np.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-9
    apart = np.sqrt(np.maximum(0, 2 - 2 * centres @ centres.T))
    for batch in batches:
        at = batch.schema.get_field_index("vec")
        x = unit(matrix(batch.column(at), width))
        near = x @ centres.T
        home = near.argmax(1)
        own = near[np.arange(len(x)), home]
        visit = own[:, None] - near <= reach * apart[home]
        visit &= np.arange(len(centres)) > home[:, None]
        visit[np.arange(len(x)), home] = True
        row, cell = np.nonzero(visit)
        take = pa.array(row)
        yield pa.RecordBatch.from_arrays(
            [*(c.take(take) for c in batch.columns), pa.array(cell.astype(np.int32)), pa.array(home[row] == cell)],
            names=[*batch.schema.names, "cell", "home"],
        )


def _linked(a: np.ndarray, b: np.ndarray, cosine: float) -> np.ndarray:
    """Which unit rows are similar; products next to the limit are formed once more, term by term."""
    s = a @ b.T
    out = s >= cosine
    i, j = np.nonzero(np.abs(s - cosine) < 1e-12)
    if len(i):
        out[i, j] = (a[i] * b[j]).sum(1) >= cosine
    return out


PAIR_SCHEMA = "k1 long, k2 long, size int, label long, n long, a long, b long"


def _block_pair(table: pa.Table, width: int, cosine: float) -> pa.Table:
    """Links of one block with another, or inside one: each vector's number of linked rows,
    and links enough to join what the block joins."""
    side = table.column("side").to_numpy()
    ids = table.column("id").to_numpy()
    copies = table.column("copies").to_numpy()
    column = table.column("vec").combine_chunks()
    x = unit(matrix(column if isinstance(column, pa.Array) else column.chunk(0), width))
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    links = np.zeros((len(x), len(x)), bool)
    if table.column("i")[0].as_py() == table.column("j")[0].as_py():
        links |= _linked(x, x, cosine)
        np.fill_diagonal(links, False)
    else:
        links[np.ix_(left, right)] = _linked(x[left], x[right], cosine)
    links |= links.T
    count = links @ copies
    low = smallest_reachable(links, ids)
    some = np.flatnonzero(count)
    pick = pa.array(some)
    return pa.table({
        **{c: table.column(c).take(pick) for c in ("k1", "k2", "size", "label")},
        "n": pa.array(count[some].astype(np.int64)), "a": pa.array(ids[some]), "b": pa.array(low[some]),
    })


def near_duplicate_vectors(vectors: DataFrame, cosine: float = 0.98, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Groups of vectors of one label with a cosine of at least ``cosine``.

    Returns (id_col, n_links, component_id, kept) for every row: the number of other rows
    linked directly, the smallest id reachable over links, and whether that is the row's
    own.  Rows with a null label or id, or a vector that is null, empty, zero or holds a
    null or non-finite component, link with nothing, and neither do vectors of different
    lengths; a null id has a null component and is kept.  Repeated rows link with each
    other; rows that share an id are one node of the graph with the links of each.  An empty
    table gives an empty result.  Other columns are not read.

    Equal vectors are one row with a count from the start.  No pairs leave a block: of each
    vector only its number of links, and a spanning tree of what a block joins.
    """
    spark = vectors.sparkSession
    prepare(spark)
    vec = F.col(vec_col)
    rows = vectors.select(F.col(id_col).alias("id"), vec.alias("vec"), F.col(label_col).cast("long").alias("label"))
    rows = rows.withColumn("ok", usable(F.col("vec")) & F.col("label").isNotNull() & F.col("id").isNotNull())
    key = F.when(F.col("ok"), F.xxhash64("vec")), F.when(F.col("ok"), F.xxhash64(F.lit(1), "vec"))
    rows = rows.select("id", "vec", "label", "ok", key[0].alias("k1"), key[1].alias("k2"), F.size("vec").alias("size"))
    same = ["k1", "k2", "size", "label"]
    reps = rows.where("ok").groupBy(*same).agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.first("vec").alias("vec"))
    reps = materialize(reps, "vector-reps")
    facts = reps.groupBy("label", "size").agg(F.count("*").alias("n")).agg(F.max("n"), F.max("size"), F.sum("n")).first()
    groups = reps.select(*same, F.col("id").alias("rep"), "copies")
    if facts[0] is None:
        counts = groups.select(*same, "rep", F.lit(0).cast("long").alias("n"), F.col("rep").alias("component"))
    else:
        found = _links(reps, facts[0], facts[1], cosine)
        linked = found.groupBy(*same).agg(F.sum("n").alias("n"))
        joined = components(found.where("a != b").select("a", "b"), "vectors")
        counts = groups.join(linked, same, "left").join(joined, F.col("rep") == F.col("node"), "left")
        counts = counts.select(*same, "rep", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "rep").alias("component"))
    # written, so that the join with a vector that very many rows share can be split
    out = rows.drop("vec").join(materialize(counts, "vector-counts"), same, "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def _links(reps: DataFrame, largest: int, width: int, cosine: float) -> DataFrame:
    k = min(MOST_CELLS, -(-largest // CELL))
    sample = bounded_sample(reps, "id", ["vec"], SAMPLE)
    x = matrix(pa.array([r["vec"] for r in sample], pa.list_(pa.float64())), width)
    centres = spherical_kmeans(unit(x), k)
    schema = T.StructType([*reps.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("home", T.BooleanType())])
    placed = materialize(map_arrow(reps, lambda b: _assign(b, centres, cosine), schema), "vector-cells")
    cells = placed.groupBy("label", "size", "cell").agg(F.count_if("home").alias("h"), F.count_if(~F.col("home")).alias("v"))
    parts = lambda c: F.greatest(F.ceil(F.col(c) / BLOCK), F.lit(1)).cast("int")
    cells = cells.select("label", "size", "cell", "v", parts("h").alias("hb"), parts("v").alias("vb"))
    rows = join_small(placed, cells, ["label", "size", "cell"], row_bound=cells.count(), max_rows=100_000)
    block = F.pmod(F.xxhash64("id", "k1"), F.when(F.col("home"), F.col("hb")).otherwise(F.col("vb"))).cast("int")
    rows = rows.withColumn("mine", block)
    each = F.sequence(F.lit(0), F.col("hb") - 1)
    # home blocks i <= j meet in task (i, j); visitors' block i meets home block j in (-1 - i, j)
    tasks = F.when(
        F.col("home"),
        F.concat(
            F.transform(each, lambda o: F.struct(F.least(o, F.col("mine")).alias("i"), F.greatest(o, F.col("mine")).alias("j"), (o < F.col("mine")).cast("int").alias("side"))),
            F.when(F.col("v") > 0, F.transform(F.sequence(F.lit(0), F.col("vb") - 1), lambda o: F.struct((-1 - o).alias("i"), F.col("mine").alias("j"), F.lit(1).alias("side"))))
            .otherwise(F.array().cast("array<struct<i:int,j:int,side:int>>")),
        ),
    ).otherwise(F.transform(each, lambda o: F.struct((-1 - F.col("mine")).alias("i"), o.alias("j"), F.lit(0).alias("side"))))
    rows = rows.withColumn("t", F.explode(tasks)).select("k1", "k2", "size", "label", "id", "copies", "vec", "cell", "t.i", "t.j", "t.side")
    out = rows.groupBy("label", "size", "cell", "i", "j").applyInArrow(lambda table: _block_pair(table, width, cosine), PAIR_SCHEMA)
    return materialize(out, "vector-links")
