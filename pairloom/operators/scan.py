"""Two-level ordered scans and ranks.

``row_number() over (order by k)`` without a partition runs in one task.  The
helpers here give the same numbers with all data-sized work partitioned:

1. every row gets a bucket that agrees with the order (a range of a bigint key,
   chosen by how many rows lie in it, or leading hex digits of a digest);
2. a per-bucket aggregate gives a small table (one row per bucket);
3. an exclusive prefix over that table gives each bucket's offset;
4. the offsets are joined back (broadcast when the bucket count is bounded)
   and a window partitioned by bucket finishes the job.

Buckets come from key values, never from task or partition ids, so retries
and re-partitioning give the same result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, PrepConfig
from ..session import default_parallelism, join_small

DIGEST_DIGITS = 32  # of an md5 digest


def _target_rows(df: DataFrame, n_rows: int, cfg: PrepConfig) -> int:
    """Rows per bucket: at most ``cfg.scan_bucket_rows``, and small enough to
    give every shuffle partition a few buckets."""
    par = max(1, default_parallelism(df.sparkSession))
    return max(1, min(cfg.scan_bucket_rows, n_rows // (4 * par) or 1))


@dataclass(frozen=True)
class Buckets:
    """Ranges of a bigint order key, each named by its lower end.

    Ranges are powers of two wide.  ``levels`` refines the heavy ones: ranges, by the
    narrower width that replaces theirs.  ``bound`` bounds the number of buckets.
    """

    shift: int
    levels: tuple[tuple[tuple[int, tuple[int, ...]], ...], ...]
    bound: int

    def column(self, order_col: str) -> Column:
        x = F.col(order_col)
        out = _lower_end(x, self.shift)
        for level in self.levels:
            refined = out
            for shift, cells in level:
                refined = F.when(out.isin(*cells), _lower_end(x, shift)).otherwise(refined)
            out = refined
        return out


def _lower_end(x: Column, shift: int) -> Column:
    return F.shiftleft(F.shiftright(x, shift), shift)


def choose_buckets(df: DataFrame, order_col: str, cfg: PrepConfig = DEFAULT) -> Buckets:
    """Buckets of at most about twice the target number of rows, however the ids lie.

    One scalar aggregate gives the first width; a count by bucket finds the heavy ones,
    whose own range and count give them a narrower width, until none is left.  Only heavy
    buckets come to the driver, at most half as many as there are targets in the table.
    Boundaries steer the plan; no result depends on them.  A NULL id raises.
    """
    row = df.agg(
        F.min(order_col).alias("lo"), F.max(order_col).alias("hi"), F.count(F.lit(1)).alias("n"), F.count(order_col).alias("k")
    ).first()
    if row["n"] != row["k"]:
        raise ValueError(f"{order_col} must not be NULL")
    if not row["n"]:
        return Buckets(0, (), 1)
    lo, hi, n = int(row["lo"]), int(row["hi"]), int(row["n"])
    target = _target_rows(df, n, cfg)
    shift = _shift(hi - lo + 1, target, n)
    found = Buckets(shift, (), ((hi - lo) >> shift) + 2)
    ids, cells = df.select(order_col), None
    while True:
        x = ids.select(order_col, found.column(order_col).alias("bucket"))
        if cells is not None:
            coarse = Buckets(found.shift, found.levels[:-1], 0).column(order_col)
            x = x.where(coarse.isin(*cells))
        heavy = (
            x.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min(order_col).alias("lo"), F.max(order_col).alias("hi"))
            .where((F.col("n") > 2 * target) & (F.col("lo") < F.col("hi"))).collect()
        )
        if not heavy:
            return found
        level: dict[int, list[int]] = {}
        more = 0
        for h in heavy:
            s = _shift(h["hi"] - h["lo"] + 1, target, h["n"])
            level.setdefault(s, []).append(h["bucket"])
            more += ((h["hi"] - h["lo"]) >> s) + 2
        cells = [h["bucket"] for h in heavy]
        found = Buckets(found.shift, (*found.levels, tuple((s, tuple(c)) for s, c in sorted(level.items()))), found.bound + more)


def _shift(span: int, target: int, n: int) -> int:
    """Largest width, as a power of two, that holds ``target`` of evenly spread ids."""
    return max(0, max(1, span * target // n).bit_length() - 1)


def hex_digits_for(n_rows: int, df: DataFrame, cfg: PrepConfig = DEFAULT) -> int:
    """Number of leading hex digits so digest buckets hold ~target rows."""
    target = _target_rows(df, max(1, n_rows), cfg)
    need = max(1.0, n_rows / target)
    return int(min(8, max(1, math.ceil(math.log(need, 16)))))


def exclusive_prefix(table: DataFrame, order_cols, sum_cols, partition_cols=()) -> DataFrame:
    """Adds ``off_<c>`` = sum of ``c`` over earlier rows, on a SMALL table."""
    w = (
        Window.partitionBy(*partition_cols)
        .orderBy(*order_cols)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return table.select(
        "*", *[F.coalesce(F.sum(c).over(w), F.lit(0)).cast("bigint").alias(f"off_{c}") for c in sum_cols]
    )


def _with_hash_keys(df: DataFrame, order_hash: Column, digits: int) -> DataFrame:
    """``_hb``: bucket = the leading hex digits as an int; ``_h``: the digest
    as 16 bytes.  Binary order is unsigned byte order, i.e. the order of the
    lowercase hex string, at half the width in shuffles and sorts."""
    x = df.withColumn("_hx", order_hash)
    return x.select(
        *df.columns,
        F.conv(F.substring("_hx", 1, digits), 16, 10).cast("bigint").alias("_hb"),
        F.unhex("_hx").alias("_h"),
    )


def hash_rank(
    df: DataFrame,
    order_hash: Column,
    tie_cols: list[str],
    out: str,
    n_rows: int,
    partition_cols: tuple[str, ...] = (),
    n_partition_values: int = 1,
    cfg: PrepConfig = DEFAULT,
) -> DataFrame:
    """0-based rank in ``(order_hash, *tie_cols)`` order within ``partition_cols``.

    ``order_hash`` must be a lowercase hex digest, so its leading digits are
    uniform and buckets are balanced whatever the data.  Equal to
    ``row_number() over (partition by p order by h, ties) - 1``.
    """
    digits = hex_digits_for(max(1, n_rows // max(1, n_partition_values)), df, cfg)
    x = _with_hash_keys(df, order_hash, digits)
    keys = [*partition_cols, "_hb"]
    counts = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
    offs = exclusive_prefix(counts, ["_hb"], ["_c"], partition_cols).select(*keys, F.col("off__c").alias("_off"))
    bound = (16**digits) * max(1, n_partition_values)
    joined = join_small(x, offs, keys, "inner", row_bound=bound, max_rows=cfg.broadcast_max_rows)
    w = Window.partitionBy(*keys).orderBy("_h", *tie_cols)
    return joined.withColumn(out, (F.col("_off") + F.row_number().over(w) - 1).cast("bigint")).drop(
        "_h", "_hb", "_off"
    )


def hash_running_sum(
    df: DataFrame,
    order_hash: Column,
    tie_cols: list[str],
    weight_col: str,
    out: str,
    n_rows: int,
    cfg: PrepConfig = DEFAULT,
) -> DataFrame:
    """Exclusive running sum of ``weight_col`` in ``(order_hash, *tie_cols)``
    order: ``sum(w) over (order by h, ties rows unbounded preceding) - w``,
    computed with the same two-level scheme as ``hash_rank``."""
    digits = hex_digits_for(max(1, n_rows), df, cfg)
    x = _with_hash_keys(df, order_hash, digits)
    sums = x.groupBy("_hb").agg(F.sum(weight_col).alias("_s"))
    offs = exclusive_prefix(sums, ["_hb"], ["_s"]).select("_hb", F.col("off__s").alias("_off"))
    joined = join_small(x, offs, ["_hb"], "inner", row_bound=16**digits, max_rows=cfg.broadcast_max_rows)
    w = Window.partitionBy("_hb").orderBy("_h", *tie_cols).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = F.col("_off") + F.sum(weight_col).over(w) - F.col(weight_col)
    return joined.withColumn(out, run.cast("bigint")).drop("_h", "_hb", "_off")


#: Hex digits of a digest that one pass of ``among_smallest`` counts, and rows that it orders.
SELECT_DIGITS, SELECT_ROWS = 3, 4096


def among_smallest(df: DataFrame, order_hash: Column, tie_col: str, k: int, n_rows: int) -> Column:
    """A condition that holds for exactly the ``k`` smallest rows in ``(order_hash, tie_col)``
    order, found without a sort of the table.

    ``order_hash`` must be a lowercase hex digest and ``tie_col`` tell rows of one digest apart.
    Rows are counted by leading digits, at most 16**3 counts a pass; the cell in which the k-th row
    lies is counted by its next digits, until it holds few rows, or all of them are
    wanted.  Only those few are ordered, and one (digest, tie) comes to the driver.
    """
    if k <= 0:
        return F.lit(False)
    if k >= n_rows:
        return F.lit(True)
    known, left, cell = "", k, n_rows
    while cell > SELECT_ROWS:
        width = len(known) + SELECT_DIGITS
        counts = df.where(order_hash.startswith(known)).groupBy(F.substring(order_hash, 1, width).alias("head"))
        for row in sorted(counts.agg(F.count(F.lit(1)).alias("n")).collect()):
            if row["n"] >= left:
                known, cell = row["head"], row["n"]
                break
            left -= row["n"]
        else:
            raise ValueError("n_rows is larger than the table")
        if cell == left:
            return F.substring(order_hash, 1, len(known)) <= known
        if len(known) >= DIGEST_DIGITS:
            break
    last = df.where(order_hash.startswith(known)).select(order_hash.alias("h"), F.col(tie_col).alias("t"))
    last = last.orderBy("h", "t").limit(left).agg(F.max(F.struct("h", "t")).alias("m")).first()["m"]
    return (order_hash < last["h"]) | ((order_hash == last["h"]) & (F.col(tie_col) <= last["t"]))
