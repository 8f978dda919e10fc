"""MinHash near-duplicates with fast similarity sketching (operator 7).

A sketch has t coordinates.  In round i every element of the set is hashed to one of the t
bins and to a value, and a bin keeps the smallest value of the first round that reaches
it; rounds t and later put all elements into one bin each, so after at most 2t rounds every
coordinate is filled.  A set of n elements takes about max(1, t log t / n) rounds, and
the share of equal coordinates is as concentrated about the similarity as with independent
hash functions.  Bands of coordinates give candidates, which are confirmed on full sets.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import components, map_arrow, mix64, prefix_hash, prepare, slices, smallest_reachable, utf8

U64 = np.uint64
_rng = np.random.default_rng(20240607)
BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
BYTE[65:91] = BYTE[97:123]  # A-Z count as a-z
PLACE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * U64(2) + U64(1)
ROUND = _rng.integers(1, 1 << 63, 4096, dtype=np.uint64)
BASE = 0x9E3779B97F4A7C15
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
EMPTY = ~U64(0)
#: Chance that the bands miss a pair at the threshold.
MISS = 1e-5


@dataclass(frozen=True)
class Bands:
    rows: int
    count: int

    @property
    def size(self) -> int:
        return self.rows * self.count


def bands_for(threshold: float, most: int = 160, miss: float = MISS) -> Bands:
    """The bands with most rows that miss a pair at the threshold with chance ``miss`` at
    most, in ``most`` coordinates."""
    best = None
    for r in range(1, 33):
        hit = threshold**r
        b = int(np.ceil(np.log(miss) / np.log1p(-hit))) if hit < 1 else 1
        if r * b <= most:
            best = Bands(r, b)
    if best is None:
        raise ValueError("the threshold is too low for so few coordinates")
    return best


def shingles(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of k-word shingles of each text, ascending, and their offsets."""
    n = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    inside = ~SEPARATOR[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.r_[False, inside[:-1]] & ~edge[:-1]
    after = np.r_[inside[1:], False] & ~edge[1:]
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    p, down = prefix_hash(BYTE[data], BASE)
    word = mix64((p[end] - p[start]) * down[start] + (end - start).astype(np.uint64))
    first = np.searchsorted(start, offsets)
    count = np.diff(first)
    many = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    at = np.repeat(first[:-1], many) + _counting(many)
    short = np.repeat((count > 0) & (count < k), many)
    length = np.repeat(np.minimum(count, k), many)
    total = np.zeros(len(at), np.uint64)
    for j in range(k):
        use = np.flatnonzero(length > j)
        total[use] += word[at[use] + j] * PLACE[j]
    out = mix64(total + np.where(short, length, 0).astype(np.uint64))
    offs = np.r_[0, np.cumsum(many)]
    for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
        out[a:b].sort()
    new = np.ones(len(out), bool)
    new[1:] = out[1:] != out[:-1]
    new[offs[:-1][many > 0]] = True
    kept = np.r_[0, np.cumsum(new)]
    return out[new], kept[offs]


def _counting(sizes: np.ndarray) -> np.ndarray:
    """0 .. size - 1 for each size, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def sketch(values: np.ndarray, offsets: np.ndarray, t: int) -> np.ndarray:
    """Sketches of the sets, a row each; an empty set's row is all ones."""
    sizes = np.diff(offsets)
    n = len(sizes)
    out = np.full(n * t, EMPTY)
    owner = np.repeat(np.arange(n), sizes)
    elements, grid = values, out.reshape(n, t)
    live = np.flatnonzero(sizes)
    for i in range(2 * t):
        x = mix64(elements ^ ROUND[i])
        bins = ((x >> U64(32)) * U64(t) >> U64(32)).astype(np.int64) if i < t else np.full(len(x), i - t)
        at = owner * t + bins
        free = out[at] == EMPTY
        np.minimum.at(out, at[free], x[free] >> U64(1))
        full = (grid[live] != EMPTY).all(1)
        if full.any():
            live = live[~full]
            left = np.zeros(n, bool)
            left[live] = True
            keep = left[owner]
            owner, elements = owner[keep], elements[keep]
        if not len(live):
            break
    return out.reshape(n, t)


def band_keys(sketches: np.ndarray, bands: Bands) -> np.ndarray:
    parts = sketches.reshape(len(sketches), bands.count, bands.rows)
    key = np.zeros(parts.shape[:2], np.uint64) + np.arange(1, bands.count + 1, dtype=np.uint64) * U64(BASE)
    for j in range(bands.rows):
        key = mix64(key ^ parts[:, :, j])
    return key


SKETCH_SCHEMA = [
    T.StructField("n_shingles", T.LongType()), T.StructField("f1", T.LongType()), T.StructField("f2", T.LongType()),
    T.StructField("bands", T.ArrayType(T.LongType())),
]


def _sketches(batches: Iterable[pa.RecordBatch], k: int, bands: Bands) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for lo, hi in slices(offsets):
            own = offsets[lo : hi + 1]
            values, offs = shingles(data[own[0] : own[-1]], own - own[0], k)
            size = np.diff(offs)
            digest = []
            for salt in PLACE[40:42]:
                run = np.r_[U64(0), np.cumsum(mix64(values ^ salt))]
                digest.append((run[offs[1:]] - run[offs[:-1]]).view(np.int64))
            keys = band_keys(sketch(values, offs, bands.size), bands).view(np.int64)
            some = size > 0
            lists = pa.ListArray.from_arrays(
                pa.array(np.r_[0, np.cumsum(np.where(some, bands.count, 0))].astype(np.int32)), pa.array(keys[some].ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array(size), pa.array(digest[0]), pa.array(digest[1]), lists],
                names=["id", "n_shingles", "f1", "f2", "bands"],
            )


def sketch_table(docs: DataFrame, id_col: str, text_col: str, k: int, bands: Bands) -> DataFrame:
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_arrow(rows, lambda b: _sketches(b, k, bands), T.StructType([rows.schema["id"], *SKETCH_SCHEMA]))


def set_table(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(id, f1, shingles): the full sets, and the digest that tells rows of one id apart."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["id"], T.StructField("f1", T.LongType()), T.StructField("shingles", T.ArrayType(T.LongType()))])

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for lo, hi in slices(offsets):
                own = offsets[lo : hi + 1]
                values, offs = shingles(data[own[0] : own[-1]], own - own[0], k)
                sums = np.r_[U64(0), np.cumsum(mix64(values ^ PLACE[40]))]
                lists = pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(values.view(np.int64)))
                f1 = (sums[offs[1:]] - sums[offs[:-1]]).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(f1), lists], names=["id", "f1", "shingles"])

    return map_arrow(rows, run, schema)


# --- confirmation on full sets -------------------------------------------------------
BLOCK = 1024  # documents of one group of candidates that are compared at once
RARE = 8  # shingles in at most so many documents are counted pair by pair


def common_counts(values: np.ndarray, offsets: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets ``left`` with the sets ``right``.

    Rare shingles add to the counts pair by pair; the others are columns of 0/1 matrices,
    multiplied a bounded number of columns at a time.
    """
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.argsort(values, kind="stable")
    v, o = values[order], owner[order]
    start = np.flatnonzero(np.r_[True, v[1:] != v[:-1]])
    df = np.diff(np.r_[start, len(v)])
    out = np.zeros((len(offsets) - 1, len(offsets) - 1), np.int32)
    for d in range(2, RARE + 1):
        rows = o[start[df == d][:, None] + np.arange(d)]
        for i in range(d):
            for j in range(d):
                if i != j:
                    np.add.at(out, (rows[:, i], rows[:, j]), 1)
    out = out[np.ix_(left, right)]
    many = np.flatnonzero(df > RARE)
    for lo in range(0, len(many), 2048):
        part = many[lo : lo + 2048]
        grid = np.zeros((len(offsets) - 1, len(part)), np.float32)
        grid[o[np.repeat(start[part], df[part]) + _counting(df[part])], np.repeat(np.arange(len(part)), df[part])] = 1
        out += (grid[left] @ grid[right].T).astype(np.int32)
    return out


def _similar_pairs(values, offsets, left, right, percent) -> np.ndarray:
    size = np.diff(offsets)
    both = common_counts(values, offsets, left, right).astype(np.int64)
    return 100 * both >= percent * (size[left][:, None] + size[right][None, :] - both)


TASK_COLUMNS = ["group", "i", "j", "side", "id", "shingles"]
LINK_SCHEMA = "a long, b long"


def _compare_groups(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Links that join what is similar, group by group; rows come sorted by group and task."""
    held: list[pa.RecordBatch] = []

    def run(table: pa.Table) -> pa.RecordBatch:
        key = [table.column(c).to_numpy() for c in ("group", "i", "j")]
        side, ids = table.column("side").to_numpy(), table.column("id").to_numpy()
        lists = table.column("shingles").combine_chunks()
        lists = lists if isinstance(lists, pa.Array) else lists.chunk(0)
        values = lists.flatten().to_numpy(zero_copy_only=False)
        offsets = np.r_[0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))]
        cuts = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1
        a, b = [], []
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ids)], strict=True):
            if hi - lo < 2:
                continue
            own = offsets[lo : hi + 1]
            v, o, who = values[own[0] : own[-1]], own - own[0], ids[lo:hi]
            if hi - lo == 2 and key[1][lo] == key[2][lo]:
                both = len(np.intersect1d(v[: o[1]], v[o[1] :], assume_unique=True))
                if 100 * both >= percent * (len(v) - both):
                    a.append(who.max(keepdims=True))
                    b.append(who.min(keepdims=True))
                continue
            links = np.zeros((hi - lo, hi - lo), bool)
            if key[1][lo] == key[2][lo]:
                every = np.arange(hi - lo)
                links = _similar_pairs(v, o, every, every, percent)
                np.fill_diagonal(links, False)
            else:
                left, right = np.flatnonzero(side[lo:hi] == 0), np.flatnonzero(side[lo:hi] == 1)
                links[np.ix_(left, right)] = _similar_pairs(v, o, left, right, percent)
                links |= links.T
            low = smallest_reachable(links, who)
            a.append(who[low != who])
            b.append(low[low != who])
        none = np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([none, *a])), pa.array(np.concatenate([none, *b]))], names=["a", "b"])

    for batch in batches:
        held.append(batch)
        table = pa.Table.from_batches(held)
        key = [table.column(c).to_numpy() for c in ("group", "i", "j")]
        change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0))
        if len(change):
            at = int(change[-1]) + 1
            yield run(table.slice(0, at))
            held = table.slice(at).to_batches()
    if held:
        yield run(pa.Table.from_batches(held))


def _confirmed(members: DataFrame, sets: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """Links (a, b) enough to join the similar ones of each group of candidates.

    ``members`` has (id, f1, group, bands): documents of one group may be similar, those of
    two are not.  A group of at most ``block`` documents is compared as a whole.  In a larger
    one all are first compared with the one that shares most buckets; those
    similar to it are joined already, and only blocks of the others meet each other and
    the blocks of the joined.
    """
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = members.join(sets, ["id", "f1"])
    sizes = members.groupBy("group").agg(F.count("*").alias("size"), F.max(F.struct("bands", "id", "f1")).alias("centre"))
    large = materialize(sizes.where(F.col("size") > block), "near-large")

    def dealt(tasks: DataFrame) -> DataFrame:
        ordered = tasks.select(TASK_COLUMNS).repartition(n, "group", "i", "j").sortWithinPartitions("group", "i", "j")
        return map_arrow(ordered, lambda b: _compare_groups(b, percent), LINK_SCHEMA)

    small = rows.join(large.select("group"), "group", "left_anti")
    zero = F.lit(0)
    found = dealt(small.select("group", zero.alias("i"), zero.alias("j"), zero.alias("side"), "id", "shingles"))
    if large.isEmpty():
        return found
    centres = large.select("group", F.col("centre.id").alias("id"), F.col("centre.f1").alias("f1"), F.col("centre.id").alias("c"))
    centres = centres.join(sets, ["id", "f1"]).select("group", "c", F.col("shingles").alias("cs"))
    wide = rows.join(centres, "group")
    both = F.size(F.array_intersect("shingles", "cs"))
    joined = 100 * both >= percent * (F.size("shingles") + F.size("cs") - both)
    wide = materialize(wide.select("group", "id", "f1", "shingles", "c", joined.alias("joined")), "near-large-rows")
    star = wide.where("joined and id != c").select(F.greatest("c", "id").alias("a"), F.least("c", "id").alias("b"))
    counts = wide.groupBy("group").agg(F.count_if("joined").alias("s"), F.count_if(~F.col("joined")).alias("o"))
    parts = lambda c: F.greatest(F.ceil(F.col(c) / block), F.lit(1)).cast("int")
    counts = materialize(counts.select("group", parts("s").alias("sb"), parts("o").alias("ob")), "near-parts")
    wide = wide.join(counts, "group")
    mine = F.pmod(F.xxhash64("id", "f1"), F.when(F.col("joined"), F.col("sb")).otherwise(F.col("ob"))).cast("int")
    wide = wide.withColumn("mine", mine)
    others = F.sequence(F.lit(0), F.col("ob") - 1)
    tasks = F.when(
        F.col("joined"), F.transform(others, lambda o: F.struct((-1 - F.col("mine")).alias("i"), o.alias("j"), F.lit(0).alias("side")))
    ).otherwise(F.concat(
        F.transform(others, lambda o: F.struct(F.least(o, F.col("mine")).alias("i"), F.greatest(o, F.col("mine")).alias("j"), (o < F.col("mine")).cast("int").alias("side"))),
        F.transform(F.sequence(F.lit(0), F.col("sb") - 1), lambda o: F.struct((-1 - o).alias("i"), F.col("mine").alias("j"), F.lit(1).alias("side"))),
    ))
    wide = wide.select("group", "id", "shingles", F.explode(tasks).alias("t")).select("group", "t.i", "t.j", "t.side", "id", "shingles")
    return found.union(star).union(dealt(wide))


def near_duplicates(docs: DataFrame, percent: int = 80, k: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of documents whose sets of k-word shingles are similar.

    Words are runs of bytes other than space and 0x09-0x0D, with A-Z in lower case.  Two
    documents are linked if 100 times the common shingles are at least ``percent`` times
    those of either.  Returns (id_col, n_shingles, component_id, kept) for every row:
    component_id is the smallest id reachable over links, kept whether it is the row's own.
    A text of fewer words than k is one shingle; null and empty texts and those without
    words have none and link with nothing.  A null id links with nothing and is kept, with a
    null component.  Rows that share an id are one node with the links of each of them.  An
    empty table gives an empty result.  Other columns are not read.

    Documents with equal sets are one from the start, found by a 128-bit digest.  Of the
    others, those that share a bucket of a band, directly or through others, are a group of
    candidates.  Inside a group full sets are compared by blocked products, and only links
    that join what is similar leave a block.  No bucket or group is cut.
    """
    bands = bands_for(percent / 100)
    sketches = materialize(sketch_table(docs, id_col, text_col, k, bands), "near-sketches")
    some = sketches.where("n_shingles > 0 and id is not null")
    # aggregates are written before a join on a key that may be hot: adaptive execution
    # splits a join of plain shuffles only
    first = materialize(some.groupBy("f1", "f2", "n_shingles").agg(F.min("id").alias("first")), "near-first")
    rows = materialize(some.join(first, ["f1", "f2", "n_shingles"]).select("id", "f1", "first",
        F.when(F.col("id") == F.col("first"), F.col("bands")).alias("bands")), "near-rows")
    keys = rows.where("bands is not null").select("id", "f1", F.explode("bands").alias("key"))
    buckets = keys.groupBy("key").agg(F.min(F.struct("id", "f1")).alias("c"), F.count("*").alias("m")).where("m > 1")
    buckets = materialize(buckets, "near-buckets")
    members = materialize(keys.join(buckets, "key").select("id", "f1", F.col("c.id").alias("centre")), "near-members")
    groups = components(members.where("id != centre").select(F.col("id").alias("a"), F.col("centre").alias("b")).distinct(), "near-candidates")
    nodes = members.groupBy("id", "f1").agg(F.count("*").alias("bands"))
    nodes = materialize(nodes.join(groups, nodes["id"] == groups["node"]).select("id", "f1", "bands", F.col("component").alias("group")), "near-nodes")
    wanted = nodes.select(F.col("id").alias("_wanted")).distinct()
    candidates = docs.join(wanted, F.col(id_col) == F.col("_wanted"), "left_semi")
    sets = materialize(set_table(candidates, id_col, text_col, k).dropDuplicates(["id", "f1"]), "near-sets")
    found = materialize(_confirmed(nodes, sets, percent), "near-links")
    # rows with equal sets are linked without a comparison
    links = rows.where("id != first").select(F.col("id").alias("a"), F.col("first").alias("b"))
    groups = materialize(components(found.union(links), "near-all"), "near-groups")
    out = sketches.select("id", "n_shingles").join(groups, F.col("id") == F.col("node"), "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", link_null_ids: bool = False, **options) -> DataFrame:
    """One row of ``docs`` of each group of near-duplicates, all columns.

    Where ids repeat or are missing, rows are compared by a number of their own, so of rows
    with one id and similar texts one stays, and rows with one id and other texts all stay.
    Rows without an id meet each other only, or with ``link_null_ids`` all rows.  The row with
    the smallest id stays (a null id is the largest), then that with the smallest hash of its
    columns.  Texts without words are alike only within one id.
    """
    if docs.groupBy(id_col).agg(F.count("*").alias("n")).where(F.col(id_col).isNull() | (F.col("n") > 1)).isEmpty():
        groups = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
        gone = materialize(groups.where("not kept").select(F.col(id_col).alias("_gone")), "near-gone")
        return docs.join(gone, F.col(id_col) == F.col("_gone"), "left_anti")
    number = "_number"
    while number in docs.columns:
        number += "_"
    numbered = materialize(docs.withColumn(number, F.monotonically_increasing_id()), "near-numbered")
    missing = F.col(id_col).isNull()
    groups = None
    for part in [numbered] if link_null_ids else [numbered.where(~missing), numbered.where(missing)]:
        found = near_duplicates(part, id_col=number, text_col=text_col, **options).select(F.col(number).alias("row"), "n_shingles", "component_id")
        groups = found if groups is None else groups.union(found)
    hashed = [F.col(f"`{c}`") for c, t in docs.dtypes if "map<" not in t]
    rows = numbered.select(F.col(number).alias("row"), missing.alias("none"), F.col(id_col).alias("id"), F.xxhash64(*hashed).alias("hash")).join(groups, "row")
    words = F.col("n_shingles") > 0
    # rows of a group agree in all three; a wordless row without an id is a group of its own
    key = [words.alias("words"), F.when(words, F.col("component_id")).when(F.col("none"), F.col("row")).alias("a"), F.when(~words, F.col("id")).alias("b")]
    best = rows.groupBy(*key).agg(F.min(F.struct("none", "id", "hash", "row")).alias("m"))
    stay = materialize(best.select(F.col("m.row").alias(number)), "near-stay")
    return numbered.join(stay, number, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
