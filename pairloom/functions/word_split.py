"""The built-in word split over whole Arrow batches.

The classes of code points (word, space, other) are asked of the regular expression of
``text.split_words`` once, so both cut every text alike.  Characters of a batch get their classes
in step, a word starts where the class changes, and the bytes without spaces, with the
starts as offsets, are the words: no string is made for each.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import WORD_PATTERN

CODE_POINTS, BLOCK = 0x110000, 4096
SPACE, WORD, OTHER, LITERAL = range(4)
#: Bytes of text that are cut in one step.
BYTES_AT_ONCE = 1 << 20
#: Bytes of words, with their offsets, that are counted in one step.
BYTES_COUNTED = 16 << 20

_classes: np.ndarray | None = None


def code_point_classes(spark: SparkSession) -> np.ndarray:
    """A class for each code point, as the pattern of ``split_words`` sees it."""
    global _classes
    if _classes is None:
        parts = [r"(?U)\w+", r"(?U)[^\w\s]+"]
        if "|".join(parts).replace("|(?U)", "|") != WORD_PATTERN:
            raise AssertionError("the classes are those of another pattern")
        points = [x for x in range(CODE_POINTS) if not 0xD800 <= x < 0xE000]  # no surrogates
        rows = [("".join(map(chr, points[k : k + BLOCK])),) for k in range(0, len(points), BLOCK)]
        found = [F.array_join(F.regexp_extract_all("t", F.lit(p), 0), "") for p in parts]
        out = np.full(CODE_POINTS, SPACE, np.uint8)
        for r in spark.createDataFrame(rows, "t string").select(*found).collect():
            for kind, chars in ((WORD, r[0]), (OTHER, r[1])):
                out[np.frombuffer(chars.encode("utf-32-le"), np.uint32)] = kind
        _classes = out
    return _classes


def splitter(classes: np.ndarray, literals: Iterable[str] = ()):
    """A function from an Arrow array of strings (null: no words) to (words, counts): the words of
    all texts in order, as an Arrow array, and their number by text.  Each of ``literals`` is kept whole
    wherever it stands; of two that start at one place, the longer.  It needs nothing of this package."""
    literals = sorted({t.encode() for t in literals}, key=lambda t: (-len(t), t))
    whole = b"|".join(map(re.escape, literals))
    space, literal = SPACE, LITERAL

    def split(texts):
        import re

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        if texts.null_count:
            texts = pc.fill_null(texts, "")
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        first = int(np.frombuffer(texts.buffers()[1], np.int32)[texts.offset]) if len(sizes) else 0
        total = int(ends[-1]) if len(sizes) else 0
        if not total:
            return pa.array([], pa.string()), np.zeros(len(sizes), np.int64)
        data = np.frombuffer(texts.buffers()[2], np.uint8)[first : first + total]
        kind = classes[data]
        wide = np.flatnonzero(data >= 0x80)
        if len(wide):
            points = np.frombuffer(data[wide].tobytes().decode().encode("utf-32-le"), np.uint32)
            width = 2 + (points >= 0x800).astype(np.int8) + (points >= 0x10000)
            kind[wide] = np.repeat(classes[points], width)
        starts = np.empty(total, bool)
        starts[0] = True
        np.not_equal(kind[1:], kind[:-1], out=starts[1:])
        begins = ends - sizes
        starts[begins[sizes > 0]] = True
        plain = data.tobytes() if literals else b""
        present = [t for t in literals if t in plain]  # one that is nowhere in the bytes is in no text
        if present:
            held = np.zeros(len(sizes), bool)
            for t in present:
                held |= pc.match_substring(texts.cast(pa.binary()), t).to_numpy(zero_copy_only=False)
            find = re.compile(whole)
            for i in np.flatnonzero(held).tolist():
                low, high = int(begins[i]), int(ends[i])
                for m in find.finditer(plain[low:high]):
                    s, e = low + m.start(), low + m.end()
                    kind[s:e] = literal
                    starts[s:e] = False
                    starts[s] = True
                    if e < total:
                        starts[e] = True
        at = np.flatnonzero(starts)  # runs of one class
        lengths, words_only = np.diff(at, append=total), kind[at] != space
        at = at[words_only]
        offsets = np.append(0, np.cumsum(lengths[words_only])).astype(np.int32)
        words = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(data[kind != space]))
        upto = np.searchsorted(at, ends)
        return words, np.diff(upto, prepend=0)

    return split


def _slices(limit: int):
    """A function that cuts an Arrow batch into runs of rows of at most ``limit`` bytes of ``text``, one row at least."""
    def cut(batch):
        import numpy as np
        import pyarrow.compute as pc

        text = batch.column("text")
        ends = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        low = 0
        while low < len(ends):
            before = int(ends[low - 1]) if low else 0
            high = max(low + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(low, high - low)
            low = high

    return cut


def _texts(rows: DataFrame, keep: Iterable[str]) -> DataFrame:
    return rows.select(*keep, F.make_valid_utf8("text").alias("text"))


def counted_words(rows: DataFrame, key: str | None = None) -> DataFrame:
    """``(key, token, n)`` or ``(token, n)``: the words of ``text`` counted in runs of rows of one ``key`` and at
    most ``BYTES_COUNTED`` of words, not in all: a sum makes the counts."""
    split, cut, limit = splitter(code_point_classes(rows.sparkSession)), _slices(BYTES_AT_ONCE), BYTES_COUNTED
    keep = [] if key is None else [key]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def counted(held, own):
            found = pa.chunked_array(held, pa.string()).value_counts()
            columns = [] if key is None else [pa.array([own] * len(found), kind)]
            return pa.RecordBatch.from_arrays([*columns, found.field(0), found.field(1)], names=[*keep, "token", "n"])

        held, size, own, kind = [], 0, None, None
        for batch in batches:
            for part in cut(batch):
                edges = [0, part.num_rows]
                if key is not None:
                    kind = part.column(key).type
                    codes = part.column(key).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
                    edges = [0, *(np.flatnonzero(codes[1:] != codes[:-1]) + 1).tolist(), len(codes)]
                for low, high in zip(edges, edges[1:]):
                    now = None if key is None else part.column(key)[low].as_py()
                    if held and (now != own or size > limit):
                        yield counted(held, own)
                        held, size = [], 0
                    found, own = split(part.column("text").slice(low, high - low))[0], now
                    held.append(found)
                    size += found.nbytes
        if held:
            yield counted(held, own)

    schema = "" if key is None else f"`{key}` {rows.schema[key].dataType.simpleString()}, "
    return _texts(rows, keep).mapInArrow(run, f"{schema}token string, n bigint")


def word_ids(rows: DataFrame, keep: list[str], tokens: list[str], ids: list[int], unknown: int,
             literals: Iterable[str] = (), max_words: int | None = None) -> DataFrame:
    """``keep`` and ``ids: array<bigint>``, the ids of the first ``max_words`` words of ``text``; ``unknown`` for
    words that are not among ``tokens``.  Rows stay where they are; a NULL text has no words."""
    split, cut = splitter(code_point_classes(rows.sparkSession), literals), _slices(BYTES_AT_ONCE)
    known, places = pa.array(tokens, pa.string()), np.array([*ids, unknown], np.int64)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            for part in cut(batch):
                found, counts = split(part.column("text"))
                ends = np.cumsum(counts)
                if max_words is not None:
                    kept = np.minimum(counts, max_words)
                    at = np.arange(len(found)) - np.repeat(ends - counts, counts) < np.repeat(kept, counts)
                    found, ends = found.filter(pa.array(at)), np.cumsum(kept)
                place = pc.index_in(found, value_set=known).fill_null(len(known)).to_numpy(zero_copy_only=False)
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(places[place], pa.int64()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), lists], names=[*keep, "ids"])

    x = _texts(rows, keep)
    schema = ", ".join(f"`{c}` {x.schema[c].dataType.simpleString()}" for c in keep)
    return x.mapInArrow(run, f"{schema}, ids array<bigint>")
