"""Segmentation of files in one pass over their splits.

Lines of a file split are read in order, so a task knows each line's place in its split without a
sort.  What it does not know, how many lines and boundaries lie before the split and how
documents go on across its ends, is a carry of a few numbers for each split.  Carries
add up: a prefix over their small table places every split, and one small join
finishes the lines.  Lines are read once and never sorted or exchanged.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, PrepConfig
from ..functions.text import is_boundary, strip_text
from ..session import join_small

#: Lines and bytes that a task holds back until their document ends; a longer document goes on
#: in pieces, whose sizes travel with the carries.
HELD_ROWS, HELD_BYTES = 1 << 16, 32 << 20

PLACED = "split bigint, doc bigint, sent bigint, n bigint, row bigint, file string, start bigint, rows bigint, bounds bigint"


class _Split:
    """One split while it is read: lines and boundaries so far, and its open document."""

    def __init__(self, number: int, file: str, start: int, hold: tuple[int, int]):
        self.number, self.file, self.start, self.hold = number, file, start, hold
        self.rows = self.bounds = self.open = 0
        self.held: list[tuple] = []
        self.held_rows = self.held_bytes = 0
        self.long = True  # the first document may have begun before the split

    def _lines(self, doc, sent, n, row, text) -> pa.RecordBatch:
        size = len(doc)
        none = pa.nulls(size, pa.int64())
        cols = [pa.array(np.full(size, self.number)), pa.array(doc), pa.array(sent), n, pa.array(row),
                pa.nulls(size, pa.string()), none, none, none, *text]
        return pa.RecordBatch.from_arrays(cols, names=_names(len(text)))

    def _carry(self, doc: int, n: int, texts: int, last: bool = False) -> pa.RecordBatch:
        """A piece whose document may go on elsewhere; the split's first one tells its file, the
        last its lines and boundaries."""
        first = doc == 0
        values = [self.number, doc, None, n, None, self.file if first else None, self.start if first else None,
                  self.rows if last else None, self.bounds if last else None]
        kinds = [pa.string() if i == 5 else pa.int64() for i in range(9)]
        cols = [pa.array([v], k) for v, k in zip(values, kinds, strict=True)]
        return pa.RecordBatch.from_arrays([*cols, *(pa.nulls(1, pa.string()) for _ in range(texts))], names=_names(texts))

    def _release(self, size: int | None) -> Iterator[pa.RecordBatch]:
        """The held lines, with the size of their document or without."""
        for doc, sent, row, text in self.held:
            n = pa.nulls(len(doc), pa.int64()) if size is None else pa.array(np.full(len(doc), size))
            yield self._lines(doc, sent, n, row, text)
        self.held, self.held_rows, self.held_bytes = [], 0, 0

    def read(self, flags: np.ndarray, text: list[pa.Array]) -> Iterator[pa.RecordBatch]:
        """Places the next lines; ``flags`` marks boundaries, which are not lines of documents."""
        line = ~flags
        at = np.flatnonzero(line)
        ends = np.cumsum(flags)
        closed = int(ends[-1])
        seen = np.cumsum(line)
        last = np.maximum.accumulate(np.where(flags, seen, -1))
        doc = self.bounds + ends[at]
        sent = np.where(last[at] >= 0, seen[at] - 1 - last[at], self.open + seen[at] - 1)
        sizes = np.bincount(ends[at], minlength=closed + 1)
        sizes[0] += self.open
        row = self.rows + at
        if closed:
            # the open document ends here
            if self.long:
                yield from self._release(None)
                yield self._carry(self.bounds, int(sizes[0]), len(text))
            else:
                yield from self._release(int(sizes[0]))
            own = ends[at] < closed
            some = np.flatnonzero(own)
            if len(some):
                unknown = (ends[at][some] == 0) & self.long
                n = pa.array(sizes[ends[at][some]], pa.int64(), mask=unknown)
                pick = pa.array(at[some])
                yield self._lines(doc[some], sent[some], n, row[some], [t.take(pick) for t in text])
            self.long = False
            rest = np.flatnonzero(~own)
        else:
            rest = np.arange(len(at))
        if len(rest):
            pick = pa.array(at[rest])
            part = (doc[rest], sent[rest], row[rest], [t.take(pick) for t in text])
            self.held.append(part)
            self.held_rows += len(rest)
            self.held_bytes += sum(t.nbytes for t in part[3])
        self.open = int(sizes[closed])
        self.rows += len(flags)
        self.bounds += closed
        if self.long or self.held_rows > self.hold[0] or self.held_bytes > self.hold[1]:
            self.long = True
            yield from self._release(None)

    def end(self, texts: int) -> Iterator[pa.RecordBatch]:
        yield from self._release(None)
        yield self._carry(self.bounds, self.open, texts, last=True)


def _names(texts: int) -> list[str]:
    return [c.split()[0] for c in PLACED.split(", ")] + ["text"] * texts


def place_lines(batches: Iterable[pa.RecordBatch], first: int, texts: int, hold: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Lines (path on a table row's first line, split start, boundary flag[, text]) in the order
    read; splits come one after the other."""
    split, number = None, first
    for batch in batches:
        if not batch.num_rows:
            continue
        path = batch.column(0)
        start = batch.column(1).to_numpy()
        flags = batch.column(2).to_numpy(zero_copy_only=False)
        named = np.flatnonzero(path.is_valid().to_numpy(zero_copy_only=False))
        names = path.take(pa.array(named)).to_pylist()
        # a split begins where the path or the start changes
        cuts = []
        now = (split.file, split.start) if split else None
        for i, name in zip(named.tolist(), names, strict=True):
            if now != (name, int(start[i])):
                now = (name, int(start[i]))
                cuts.append((i, now))
        bounds = [*(c[0] for c in cuts), batch.num_rows]
        if bounds[0]:
            yield from split.read(flags[: bounds[0]], [batch.column(3).slice(0, bounds[0])] if texts else [])
        for (at, (name, begin)), to in zip(cuts, bounds[1:], strict=True):
            if split is not None:
                yield from split.end(texts)
            split, number = _Split(number, name, begin, hold), number + 1
            yield from split.read(flags[at:to], [batch.column(3).slice(at, to - at)] if texts else [])
    if split is not None:
        yield from split.end(texts)


def segment_splits(table: DataFrame, lines: Column, write: Callable[[DataFrame, str], DataFrame], cfg: PrepConfig = DEFAULT,
                   text: bool = True, hold: tuple[int, int] = (HELD_ROWS, HELD_BYTES)) -> DataFrame:
    """Kept sentences ``(row_id, doc_key, sent_idx, n_sents[, text])`` of files, as
    ``corpus.segment_documents`` gives them for rows numbered densely in file order.

    ``table`` is read from files and may be filtered or projected, not shuffled; ``lines`` is an
    array of the lines of one of its rows, empty for none (a null line counts as empty, and so as a
    boundary).  Files go by path.  ``write`` stores the placed lines, read again with the carries;
    a task places whole splits, so a retry gives the same numbers.  Carries are at most two for
    each split and one for each ``hold`` lines or bytes.
    """
    meta = F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start")
    x = table.select(*meta, F.posexplode(lines).alias("_pos", "_line"))
    clean = F.coalesce(strip_text("_line"), F.lit(""))
    x = x.select(F.when(F.col("_pos") == 0, F.col("_path")).alias("path"), F.col("_start").alias("start"), clean.alias("text"))
    x = x.select("path", "start", is_boundary("text").alias("flag"), *(["text"] if text else []))
    texts = int(text)

    def run(batches):
        from pyspark import TaskContext

        yield from place_lines(batches, TaskContext.get().partitionId() << 32, texts, hold)

    placed = write(x.mapInArrow(run, PLACED + (", text string" if text else "")), "placed_lines")
    carries = write(placed.where("row IS NULL").select("split", "doc", "n", "file", "start", "rows", "bounds"), "carries")
    splits = carries.groupBy("split").agg(*[F.max(c).alias(c) for c in ("file", "start", "rows", "bounds")])
    # splits and carries, not lines: small tables
    before = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)
    total = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"off_{c}")
    splits = write(splits.select("split", "file", "start", total("rows"), total("bounds")), "split_offsets")
    key = (F.col("off_bounds") + F.col("doc")).alias("key")
    pieces = carries.select("split", "doc", "n").join(splits, "split").select("split", "doc", "n", "file", "start", key)
    whole = Window.partitionBy("key")
    earlier = whole.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("split", "doc", F.sum("n").over(whole).alias("n_whole"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_before"))
    pieces = write(pieces, "pieces")
    n = pieces.count()
    y = join_small(placed.where("row IS NOT NULL").drop("file", "start", "rows", "bounds"), splits.drop("file", "start"), "split", row_bound=n, max_rows=cfg.broadcast_max_rows)
    y = join_small(y, pieces, ["split", "doc"], "left", row_bound=n, max_rows=cfg.broadcast_max_rows)
    y = y.select(
        (F.col("off_rows") + F.col("row")).alias("row_id"),
        (F.col("off_bounds") + F.col("doc")).alias("doc_key"),
        (F.col("sent") + F.coalesce("n_before", F.lit(0))).alias("sent_idx"),
        F.coalesce("n", "n_whole").alias("n_sents"),
        *(["text"] if text else []),
    )
    return y.where(F.col("n_sents") >= cfg.min_sentences) if cfg.min_sentences > 1 else y
