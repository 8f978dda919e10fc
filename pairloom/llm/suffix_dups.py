"""Removal of byte strings that occur more than once (operator 8).

Equal strings of ``length`` bytes contain the same anchor: the position, within the
string, of the smallest hash of ``GRAM`` consecutive bytes.  So windows are gathered by
their anchor's hash, and only anchors that occur more than once matter.  A run of
windows with the same anchor is a segment; segments of equal hash are combined
before the shuffle.  Segments that differ are cut in two: windows that reach far to the
left of the anchor, and those that reach far to its right.  Each half is dealt by the bytes that all
its windows share, and what meets is ordered by deep-shallow sorting: a multikey
quicksort on words of eight bytes to a shallow depth, then blind tries for the groups
that share a longer prefix.  Where very many pieces share these bytes, as at the edges of a
passage with many contexts, they are cut again and dealt by more bytes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import SLICE_BYTES, map_arrow, mix64, prefix_hash, prepare, slices, utf8

U64 = np.uint64
_rng = np.random.default_rng(20240608)
BYTE = _rng.integers(1, 1 << 63, (2, 256), dtype=np.uint64) * U64(2) + U64(1)
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Bytes hashed for an anchor; longer ones make more anchors, but fewer that repeat.
GRAM = 48
SHALLOW = 4  # words of eight bytes that the multikey quicksort compares
BLOCK_SEGMENTS = 4096  # different pieces of one key that are sorted together


# --- anchors -----------------------------------------------------------------------
def _smallest(key: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` neighbours, by running minima of blocks."""
    n = len(key) - width + 1
    blocks = -(-len(key) // width)
    grid = np.full(blocks * width, ~U64(0))
    grid[: len(key)] = key
    grid = grid.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(grid, axis=1).ravel()
    return np.minimum(ahead[:n], behind[width - 1 : width - 1 + n])


def segments(data: np.ndarray, offsets: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """Runs of windows with one anchor, over texts laid end to end.

    Gives for each: row, first window (from the row's start), number of windows, place
    of the anchor after the first window, the anchor's hash, and a hash of the bytes of
    all its windows.
    """
    width = length - GRAM + 1
    none = {k: np.zeros(0, np.int64) for k in ("row", "first", "windows", "anchor", "hash", "bytes")}
    if len(data) < length:
        return none
    p, down = prefix_hash(BYTE[0][data], BASES[0])
    gram = mix64((p[GRAM:] - p[:-GRAM]) * down[: len(data) - GRAM + 1])
    # ties go to the first; the place in the low bits makes each key its own
    bits = U64(max(1, int(len(data)).bit_length()))
    key = (gram >> bits << bits) | np.arange(len(gram), dtype=np.uint64)
    least = _smallest(key, width)
    place = (least & ((U64(1) << bits) - U64(1))).astype(np.int64)
    # windows lie inside a text
    good = np.zeros(len(data) + 1, np.int32)
    long = np.flatnonzero(np.diff(offsets) >= length)
    np.add.at(good, offsets[long], 1)
    np.add.at(good, offsets[long + 1] - length + 1, -1)
    good = np.cumsum(good[: len(place)]) > 0
    change = np.ones(len(place), bool)
    change[1:] = (place[1:] != place[:-1]) | (good[1:] != good[:-1])
    starts = np.flatnonzero(change)
    ends = np.r_[starts[1:], len(place)]
    use = good[starts]
    starts, ends = starts[use], ends[use]
    # a text may end where the next begins with the same anchor: windows are then apart
    row = np.searchsorted(offsets, starts, side="right") - 1
    q, down = prefix_hash(BYTE[1][data], BASES[1])
    last = ends - 1 + length
    return {
        "row": row,
        "first": starts - offsets[row],
        "windows": ends - starts,
        "anchor": place[starts] - starts,
        "hash": gram[place[starts]].view(np.int64),
        "bytes": mix64((q[last] - q[starts]) * down[starts] + (last - starts).astype(np.uint64)).view(np.int64),
    }


def _parts(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces of bounded size: (first row, bytes, offsets, bytes skipped of each row).

    A text of more than two slices is cut into overlapping parts; a window lies in one.
    """
    for lo, hi in slices(offsets):
        a, b = int(offsets[lo]), int(offsets[hi])
        if b - a <= 2 * SLICE_BYTES:
            yield lo, data[a:b], offsets[lo : hi + 1] - a, np.zeros(hi - lo, np.int64)
            continue
        for at in range(a, b - length + 1, SLICE_BYTES):
            end = min(b, at + SLICE_BYTES + length - 1)
            yield lo, data[at:end], np.array([0, end - at]), np.array([at - a])


ANCHORS = "id long, text_no long, times long, first int, windows int, anchor int, hash long, bytes long"


def _anchor_rows(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column(3))
        for lo, part, offs, skipped in _parts(data, offsets, length):
            s = segments(part, offs, length)
            if len(s["row"]):
                at = pa.array(s["row"] + lo)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).take(at) for k in range(3)), *(pa.array((s[k] + (skipped[s["row"]] if k == "first" else 0)).astype(np.int32)) for k in ("first", "windows", "anchor")),
                     pa.array(s["hash"]), pa.array(s["bytes"])],
                    names=["id", "text_no", "times", "first", "windows", "anchor", "hash", "bytes"],
                )


# --- deep-shallow sorting ------------------------------------------------------------
def _words(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as one number that orders like them."""
    view = np.lib.stride_tricks.sliding_window_view(data, 8)
    return np.ascontiguousarray(view[at]).view(">u8").ravel().astype(np.uint64)


def _renumber(group: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order within groups by keys, first key first; and the groups of what is equal,
    numbered by their place in the order."""
    order = np.lexsort((*keys[::-1], group))
    new = np.ones(len(order), bool)
    new[1:] = group[order][1:] != group[order][:-1]
    for k in keys:
        k = k[order]
        new[1:] |= k[1:] != k[:-1]
    starts = np.flatnonzero(new)
    base = np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    return order, base


def deep_shallow(data: np.ndarray, at: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Which of the strings data[a : a + length] equal another of their group.

    ``data`` needs eight bytes more than the last string.  Strings that are alone in
    their group after a step are in their final place and leave.
    """
    twice = np.zeros(len(at), bool)
    live = np.arange(len(at))

    def shrink(live, group):
        _, back, count = np.unique(group, return_inverse=True, return_counts=True)
        many = count[back] > 1
        return live[many], back[many]

    live, group = shrink(live, group)
    # shallow: multikey quicksort, a word a step
    for d in range(SHALLOW):
        if not len(live):
            return twice
        order, base = _renumber(group, _words(data, at[live] + 8 * d))
        live, group = shrink(live[order], base)
    # deep: a blind trie for each group; its first string is a path of the trie, and every
    # other is told by the place and byte at which it leaves the path
    words = -(-length // 8)
    while len(live):
        lead = np.ones(len(live), bool)
        lead[1:] = group[1:] != group[:-1]
        leader = live[lead][np.cumsum(lead) - 1]
        common = np.full(len(live), length)
        byte = np.zeros(len(live), np.int64)
        todo = np.flatnonzero(~lead)
        for d in range(SHALLOW, words):
            if not len(todo):
                break
            # the last word ends with the string
            start = min(8 * d, length - 8)
            x = _words(data, at[live[todo]] + start)
            y = _words(data, at[leader[todo]] + start)
            k = np.flatnonzero(x != y)
            if len(k):
                diff = x[k] ^ y[k]
                first = np.zeros(len(k), np.int64)
                for i in range(7):
                    first += (diff >> U64(56 - 8 * i) == 0) & (first == i)
                out = todo[k]
                common[out] = start + first
                byte[out] = data[at[live[out]] + start + first]
                todo = np.delete(todo, k)
        same = common >= length
        pairs = np.bincount(group[same & ~lead], minlength=int(group.max()) + 1)
        twice[live[same & ~lead]] = True
        twice[live[lead & (pairs[group] > 0)]] = True
        # the children in order: those below the path leave it ever later, those above it
        # ever earlier
        rest = np.flatnonzero(~same)
        above = byte[rest] > data[at[leader[rest]] + common[rest]]
        order, base = _renumber(group[rest], above, np.where(above, -common[rest], common[rest]), byte[rest])
        live, group = shrink(live[rest[order]], base)
    return twice


FOUND = "key long, kind long, from_ int, to_ int"


def _sort_block(table: pa.Table, length: int) -> pa.Table:
    """Runs of windows, from_ <= window < to_, that equal a window of another piece of their
    key or of their own; a piece that occurs more than once is removed whole anyway."""
    raw = table.column("data").to_pylist()
    sizes = np.array([len(x) for x in raw])
    data = np.frombuffer(b"".join(raw) + bytes(8), np.uint8)
    start = np.cumsum(sizes) - sizes
    windows, anchor, copies = (table.column(c).to_numpy().astype(np.int64) for c in ("windows", "anchor", "copies"))
    seg = np.repeat(np.arange(len(raw)), windows)
    win = np.arange(len(seg)) - np.repeat(np.cumsum(windows) - windows, windows)
    _, key = np.unique(table.column("key").to_numpy(), return_inverse=True)
    twice = deep_shallow(data, start[seg] + win, key[seg] * length + anchor[seg] - win, length)
    twice &= copies[seg] == 1
    run = np.ones(len(seg) + 1, bool)
    run[1:-1] = (seg[1:] != seg[:-1]) | (twice[1:] != twice[:-1])
    bounds = np.flatnonzero(run)
    use = twice[bounds[:-1]]
    first, last = bounds[:-1][use], bounds[1:][use] - 1
    pick = pa.array(seg[first])
    return pa.table({
        **{c: table.column(c).take(pick) for c in ("key", "kind")},
        "from_": pa.array(win[first].astype(np.int32)), "to_": pa.array((win[last] + 1).astype(np.int32)),
    })


def _pieces(segs: DataFrame, length: int, width: int) -> DataFrame:
    """Segments cut into pieces whose windows hold their anchor at one of ``width`` places.

    All windows of a piece share the anchor and the bytes next to it that each of them
    reaches, ``length - width + 1`` bytes in all; ``key`` is their hash.  Equal windows hold
    the anchor at one place, so they lie in pieces of one key.  ``kind`` is a hash of
    all bytes of the piece, and ``skip`` its first window's number in the segment.
    """
    span = length - GRAM + 1
    a, w = F.col("anchor"), F.col("windows")

    def piece(q):
        lo = q * width
        hi = F.least(lo + F.lit(width), F.lit(span))
        skip = F.greatest(a - hi + 1, F.lit(0))
        n = F.least(a - lo + 1, w) - skip
        data = F.substring(F.col("data"), skip + 1, n + F.lit(length - 1))
        shared = F.substring(F.col("data"), a - lo + 1, F.lit(length + 1) - (hi - lo))
        return F.struct(skip.alias("skip"), n.alias("windows"), (a - skip).alias("anchor"),
                        F.xxhash64("hash", q, shared).alias("key"), F.xxhash64(F.lit(width), data).alias("kind"), data.alias("data"))

    places = F.sequence(F.floor((a - w + 1) / width).cast("int"), F.floor(a / width).cast("int"))
    return segs.select("hash", "bytes", "copies", F.explode(F.transform(places, piece)).alias("p")).select("hash", "bytes", "copies", "p.*")


def _window_marks(segs: DataFrame, length: int, width: int) -> DataFrame:
    """(hash, bytes, from_, to_): runs of windows that occur more than once.

    ``segs`` holds (hash, bytes, copies, windows, anchor, data), each (hash, bytes) once.
    Pieces of equal bytes are combined, pieces alone with their key leave, and the others are
    sorted, a key a group.  A key of more than ``BLOCK_SEGMENTS`` different pieces goes
    on with narrower pieces, whose keys take in more bytes, until its groups are small; at
    a width of one the key is the whole window, and a group has one kind.
    """
    pieces = materialize(_pieces(segs, length, width), "suffix-pieces")
    keys = pieces.groupBy("key").agg(F.sum("copies").alias("copies"), F.min("kind").alias("kind"), F.max("kind").alias("other"))
    keys = materialize(keys.where("copies > 1"), "suffix-keys")
    every = [F.lit(0).alias("from_"), F.lit(length).alias("to_")]
    alike = keys.where("kind = other").select("key", "kind", *every)
    # one piece of each kind goes on, with its bytes
    one = F.first(F.struct("windows", "anchor", "data")).alias("one")
    kinds = pieces.join(keys.where("kind < other").select("key"), "key").groupBy("key", "kind").agg(F.sum("copies").alias("copies"), one)
    kinds = materialize(kinds.select("key", "kind", "copies", "one.*"), "suffix-kinds")
    large = materialize(kinds.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK_SEGMENTS).select("key"), "suffix-large")
    # a task sorts many small groups together
    n = max(1, int(segs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = kinds.join(large, "key", "left_anti").repartition(n, "key").sortWithinPartitions("key")

    def sort(batches):
        yield from _sorted_partitions(batches, length)

    marks = alike.union(kinds.where("copies > 1").select("key", "kind", *every)).union(map_arrow(dealt, sort, FOUND))
    if width > 1 and not large.isEmpty():
        rest = kinds.join(large, "key", "left_semi").withColumnsRenamed({"key": "hash", "kind": "bytes"})
        narrower = _window_marks(rest, length, -(-width // 4))
        marks = marks.union(narrower.select("hash", "bytes", "from_", "to_"))
    marks = materialize(marks, "suffix-found")
    ends = (F.col("skip") + F.col("from_")).alias("from_"), (F.col("skip") + F.least("to_", "windows")).cast("int").alias("to_")
    return pieces.select("hash", "bytes", "skip", "windows", "key", "kind").join(marks, ["key", "kind"]).select("hash", "bytes", *ends)


def _repeated_spans(rows: DataFrame, length: int) -> DataFrame:
    """(id, text_no, spans): runs of bytes that are covered by strings of ``length`` bytes
    that also start elsewhere, as (first, size) for each segment, not merged.

    ``rows`` holds (id, text_no, times, text), each (id, text_no) once: ``text_no`` tells
    apart texts that share an id, and ``times`` counts the rows that are alike.  Every anchor is counted; equal
    segments of an anchor are combined, and of those that differ one each is cut from its
    text and goes on in pieces (``_window_marks``).
    """
    if length < GRAM + 8:
        raise ValueError(f"strings must be of {GRAM + 8} bytes at least")
    prepare(rows.sparkSession)
    anchors = materialize(map_arrow(rows, lambda b: _anchor_rows(b, length), ANCHORS), "suffix-anchors")
    # written, so that the join with a hot anchor is one that adaptive execution splits
    again = materialize(anchors.groupBy("hash").agg(F.sum("times").alias("n")).where("n > 1").select("hash"), "suffix-again")
    kept = materialize(anchors.join(again, "hash"), "suffix-kept")
    one = F.min(F.struct("id", "text_no", "first", "windows", "anchor")).alias("one")
    counted = materialize(kept.groupBy("hash", "bytes").agg(F.sum("times").alias("copies"), one), "suffix-counted")
    differ = materialize(counted.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "suffix-differ")
    cut = _cut_segments(rows, counted.join(differ, "hash").select("one.*", "hash", "bytes", "copies"), length)
    runs = _window_marks(cut, length, -(-(length - GRAM + 1) // 2))
    # windows to remove, once for each kind of segment; one join takes them to all segments
    some = runs.groupBy("hash", "bytes").agg(F.collect_list(F.struct("from_", "to_")).alias("runs"))
    every = F.array(F.struct(F.lit(0).alias("from_"), F.col("one.windows").alias("to_")))
    full = counted.where("copies > 1").select("hash", "bytes", every.alias("runs"))
    marks = full.union(some.join(full.select("hash", "bytes"), ["hash", "bytes"], "left_anti"))
    marked = kept.join(materialize(marks, "suffix-marks"), ["hash", "bytes"], "left")
    run = F.transform("runs", lambda r: F.struct((F.col("first") + r["from_"]).alias("first"), (r["to_"] - r["from_"] + length - 1).alias("size")))
    return marked.groupBy("id", "text_no").agg(F.flatten(F.collect_list(run)).alias("spans"))


def _rows(docs: DataFrame, id_col: str, text_col: str, keep: list[str]) -> tuple[DataFrame, bool]:
    """(row, id, text_no, text), and whether no id repeats; a null id counts as the smallest
    number, and text_no tells texts apart where ids repeat."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    unique = docs.select(ids_of(id_col)).groupBy("id").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    number = F.lit(0).cast("long") if unique else F.xxhash64(text)
    return docs.select(F.struct(*[F.col(c) for c in keep]).alias("row"), ids_of(id_col), number.alias("text_no"), text.alias("text")), unique


def _once(wide: DataFrame) -> DataFrame:
    """(id, text_no, times, text): rows with one id and text are one, and counted."""
    one = wide.groupBy("id", "text_no").agg(F.count("*").alias("times"), F.first("text").alias("text"))
    return materialize(one.select("id", "text_no", "times", "text"), "suffix-texts")


def ids_of(id_col: str):
    return F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)).cast("long")).alias("id")


def _cut_segments(rows: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of segments, cut from their texts."""
    lists = wanted.groupBy("id", "text_no").agg(F.collect_list(F.struct("first", "windows", "anchor", "hash", "bytes", "copies")).alias("cuts"))
    joined = rows.join(lists, ["id", "text_no"]).select("id", "text_no", F.encode("text", "UTF-8").alias("text"), "cuts")
    piece = lambda c: F.substring(F.col("text"), c["first"] + 1, c["windows"] + F.lit(length - 1))
    cuts = F.transform("cuts", lambda c: F.struct(c["first"].alias("first"), c["windows"].alias("windows"), c["anchor"].alias("anchor"),
        c["hash"].alias("hash"), c["bytes"].alias("bytes"), c["copies"].alias("copies"), piece(c).alias("data")))
    return joined.select("id", "text_no", F.explode(cuts).alias("c")).select("id", "text_no", "c.*")


def _sorted_partitions(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Sorts runs of whole groups of bounded size."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= BLOCK_SEGMENTS:
            table = pa.Table.from_batches(held).combine_chunks()
            key = table.column("key").to_numpy()
            change = np.flatnonzero(key[1:] != key[:-1])
            if len(change):
                at = int(change[-1]) + 1
                yield from _sort_block(table.slice(0, at), length).to_batches()
                held = table.slice(at).to_batches()
    if held:
        table = pa.Table.from_batches(held)
        if table.num_rows:
            yield from _sort_block(table, length).to_batches()


def remove_repeats(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Texts without the bytes covered by a string of ``length`` bytes that also starts
    anywhere else, in the same text or another.

    Returns (row, n_bytes, spans, kept) for every row of ``docs``: ``row`` a struct of the
    columns ``keep`` (id_col by default), ``spans`` the maximal removed runs as (first,
    size) and ``kept`` the other bytes.  Strings are judged on the input; overlaps
    count; matches never cross texts.  A null text is empty; texts shorter than
    ``length`` lose nothing; repeated rows lose all that they repeat, rows without an
    id like any other; an empty table gives an empty result.
    """
    joined = _with_spans(docs, length, id_col, text_col, keep or [id_col])
    schema = T.StructType([
        joined.schema["row"], T.StructField("n_bytes", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("size", T.LongType())]))),
        T.StructField("kept", T.BinaryType()),
    ])
    return map_arrow(joined, _removed, schema)


def _with_spans(docs: DataFrame, length: int, id_col: str, text_col: str, keep: list[str]) -> DataFrame:
    """(row, text, spans): every row with the runs to be removed from its text."""
    wide, unique = _rows(docs, id_col, text_col, keep)
    if unique:
        lists = _repeated_spans(wide.select("id", "text_no", F.lit(1).cast("long").alias("times"), "text"), length)
    else:
        # written, so that the join with a text of very many rows can be split
        lists = materialize(_repeated_spans(_once(wide), length), "suffix-spans")
    return wide.join(lists, ["id", "text_no"], "left").select("row", "text", "spans")


def _removed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, spans, kept = [], [], []
        for text, runs in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2), strict=True):
            sizes.append(len(text))
            if not runs.is_valid or not len(runs):
                spans.append([])
                kept.append(text)
                continue
            first, size = (runs.values.field(k).to_numpy().astype(np.int64) for k in (0, 1))
            order = np.argsort(first, kind="stable")
            first, end = first[order], np.maximum.accumulate((first + size)[order])
            new = np.r_[True, first[1:] > end[:-1]]
            a, b = first[new].tolist(), end[np.r_[new[1:], True]].tolist()
            spans.append([{"first": x, "size": y - x} for x, y in zip(a, b, strict=True)])
            kept.append(b"".join(text[x:y] for x, y in zip([0, *b], [*a, len(text)], strict=True)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("size", pa.int64())]))), pa.array(kept, pa.binary())],
            names=["row", "n_bytes", "spans", "kept"],
        )


def without_repeats(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with what remove_repeats leaves as text; a character of which a byte goes
    is dropped whole, and n_chars, where there is one, follows the new text."""
    joined = _with_spans(docs, length, id_col, text_col, docs.columns)
    place = docs.columns.index(text_col)
    schema = T.StructType([joined.schema["row"], T.StructField("text", T.StringType())])

    def run(batches):
        # one pass, and so one Python process a task
        for batch, left in ((b, c) for b in batches for c in _removed([b])):
            null = batch.column(0).field(place).is_null().to_pylist()
            texts = [None if n else b.decode("utf-8", "ignore") for n, b in zip(null, left.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "text"])

    out = map_arrow(joined, run, schema)
    new = {text_col: F.col("text"), "n_chars": F.when(F.col("text").isNotNull(), F.length("text")).cast(dict(docs.dtypes).get("n_chars", "long"))}
    return out.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
