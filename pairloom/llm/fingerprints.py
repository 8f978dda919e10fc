"""Document fingerprints by Order MinHash, with DataFrame functions alone.

A text is cut into pieces (runs of characters other than white space, at most PIECE of them)
and every K consecutive pieces are a k-mer; equal k-mers of a text are numbered, so the
items of a text differ from each other.  A permutation of the items is a rotation of a hash:
each of ROUNDS hash functions is rotated by BINS even steps.  For each permutation the
TUPLE smallest items are taken, put back into their text order, and hashed together: one
coordinate of the signature.  Two texts agree in a coordinate when the smallest items of both
are the same in the same order, which edits and moved passages undo.

Everything but the ordering of documents happens inside a row: arrays are sorted as
plain longs that hold a hash above a position.  No lambda refers to a computed array of its
own row, for Spark might compute it for every element again.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Stages, join_small, materialize

PIECE = r"[^\x20\x09-\x0D]{1,16}"
K = 2
TUPLE = 2
ROUNDS = 2
BINS = 32
#: Low bits of a packed long: the position of an item.
AT_BITS = 28
AT = (1 << AT_BITS) - 1
HASH_BITS = 64 - AT_BITS
HASH = (1 << HASH_BITS) - 1

#: Documents of a block of neighbours: few enough for a window, and at most this many blocks
#: are aimed at, which bounds the tables of their limits.
BLOCK_ROWS = 512
MOST_BLOCKS = 8192
KEY_LENGTH = 48


def _shifted(array: Column) -> Column:
    """The array without its first element."""
    return F.slice(array, F.lit(2), F.size(array))


def _kmers(text: Column) -> Column:
    """Hashes of the k-mers over their positions, sorted; the last K - 1 are shorter."""
    pieces = F.transform(F.regexp_extract_all(text, F.lit(PIECE), F.lit(0)), lambda w: F.xxhash64(w))
    kmers, rest = pieces, pieces
    for _ in range(K - 1):
        rest = _shifted(rest)
        kmers = F.zip_with(kmers, rest, lambda a, b: F.xxhash64(a, b))
    packed = F.transform(kmers, lambda h, i: F.shiftleft(h, AT_BITS).bitwiseOR(i.cast("long")))
    return F.sort_array(packed)


def _first_of_equals(kmers: Column) -> Column:
    """Indices of the first of each run of equal k-mers."""
    before = F.concat(F.array(F.lit(None).cast("long")), F.slice(kmers, F.lit(1), F.greatest(F.size(kmers) - 1, F.lit(0))))
    first = F.zip_with(kmers, before, lambda x, p: p.isNull() | (F.shiftright(x, AT_BITS) != F.shiftright(p, AT_BITS)))
    return F.array_compact(F.transform(first, lambda m, i: F.when(m, i)))


def _numbers(kmers: Column, starts: Column) -> Column:
    """How many equal k-mers lie before each, in the order of ``kmers``."""
    ends = F.concat(_shifted(starts), F.array(F.size(kmers)))
    return F.flatten(F.zip_with(F.slice(starts, F.lit(1), F.size(starts)), ends, lambda a, b: F.sequence(F.lit(0), b - a - 1)))


def _items(kmers: Column, numbers: Column, r: int) -> Column:
    """Numbered k-mers under hash function r, over their positions.  Never null, which Spark
    has to see, or it would sort boxed numbers."""

    def item(x, o):
        return F.shiftleft(F.xxhash64(F.shiftright(x, AT_BITS), o, F.lit(r)), AT_BITS).bitwiseOR(x.bitwiseAND(F.lit(AT)))

    return F.zip_with(kmers, numbers, lambda x, o: F.coalesce(item(x, o), F.lit(0).cast("long")))


def _with_ends(items: Column) -> Column:
    """The lower ends of all bins but the first among the items; they have a place of their own."""
    return F.concat(items, F.array(*[F.lit((b - BINS // 2 << 64 - int(math.log2(BINS))) - 1) for b in range(1, BINS)]))


def _starts(with_ends: Column) -> Column:
    """How many items lie below the lower end of each bin: where its permutation begins."""
    place = F.array_compact(F.transform(with_ends, lambda x, i: F.when(x.bitwiseAND(F.lit(AT)) == AT, i)))
    return F.concat(F.array(F.lit(0)), F.zip_with(place, F.array(*[F.lit(b) for b in range(BINS - 1)]), lambda i, b: i - b))


def _smallest(items: Column, starts: Column) -> Column:
    """The TUPLE smallest items of each permutation, around the circle; fewer if there are
    no more."""

    def of(start):
        left = F.size(items) - start
        return F.concat(
            F.slice(items, start + 1, F.lit(TUPLE)),
            F.slice(items, F.lit(1), F.greatest(F.least(F.lit(TUPLE), F.size(items)) - left, F.lit(0))),
        )

    return F.array(*[of(F.element_at(starts, b + 1)) for b in range(BINS)])


def _coordinate(smallest: Column) -> Column:
    """Hash of a permutation's smallest items in their text order."""
    by_place = F.transform(
        smallest,
        lambda x: F.shiftleft(x, HASH_BITS).bitwiseOR(F.shiftright(x, AT_BITS).bitwiseAND(F.lit(HASH))),
    )
    hashed = F.xxhash64(F.transform(F.sort_array(by_place), lambda x: x.bitwiseAND(F.lit(HASH))))
    return F.shiftright(hashed, 32).cast("int")


def with_signatures(df: DataFrame, texts: dict[str, str]) -> DataFrame:
    """Adds a signature, array<int> of ROUNDS * BINS coordinates, for each text column:
    ``texts`` gives the names of the new columns.

    Texts of one sequence of pieces have one signature.  Null counts as empty; all texts
    without a piece have one signature; a text of one piece has one item.
    """
    keep = df.columns
    names = {c: [f"_{k}{i}" for k in "snm"] for i, c in enumerate(texts)}

    def step(x, columns):
        """A projection of its own: what the next refers to more than once is computed once."""
        return x.select(*keep, *[v.alias(k) for k, v in columns.items()])

    kmers = {c: F.col(s) for c, (s, _, _) in names.items()}
    x = step(df, {s: _kmers(F.coalesce(F.col(c), F.lit(""))) for c, (s, _, _) in names.items()})
    x = step(x, {**{s: F.col(s) for s, _, _ in names.values()}, **{m: _first_of_equals(kmers[c]) for c, (_, _, m) in names.items()}})
    numbers = {
        n: F.when(F.size(s) > F.size(m), _numbers(F.col(s), F.col(m))).otherwise(F.array_repeat(F.lit(0), F.size(s)))
        for s, n, m in names.values()
    }
    x = step(x, {**{s: F.col(s) for s, _, _ in names.values()}, **numbers})
    rounds = [(s, n, f"_r{r}{s}", r) for s, n, _ in names.values() for r in range(ROUNDS)]
    x = step(x, {v: _items(F.col(s), F.col(n), r) for s, n, v, r in rounds})
    x = step(x, {k: F.sort_array(c) for _, _, v, _ in rounds for k, c in ((v, F.col(v)), (f"{v}b", _with_ends(F.col(v))))})
    x = step(x, {k: c for _, _, v, _ in rounds for k, c in ((v, F.col(v)), (f"{v}b", _starts(F.col(f"{v}b"))))})
    x = step(x, {v: F.transform(_smallest(F.col(v), F.col(f"{v}b")), _coordinate) for _, _, v, _ in rounds})
    made = [F.concat(*[f"_r{r}{names[c][0]}" for r in range(ROUNDS)]).alias(o) for c, o in texts.items()]
    return x.select(*keep, *made)


def likeness(a: Column, b: Column) -> Column:
    """Share of coordinates in which two signatures agree: an estimate of how much of the
    texts' items, and of their order, is common."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda n, x: n + x) / F.size(a)


def as_text(signature: Column) -> Column:
    """Eight hexadecimal digits for each coordinate."""
    return F.array_join(F.transform(signature, lambda c: F.lpad(F.hex(c.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), "")


# -- neighbours in the order of ids -------------------------------------------


def order_key(doc_id: Column, text: Column) -> Column:
    """A string whose order is that of falling ids, nulls last, then of text digests."""
    falling = F.lpad(F.hex(F.bitwise_not(doc_id.cast("long")).bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    return F.concat(F.coalesce(falling, F.lit("g" * 16)), F.md5(F.coalesce(text, F.lit(""))))


def _digits(low: str, high: str, rows: int, target: int) -> int:
    """Length of a prefix that cuts keys from low to high into about rows / target ranges."""
    common = next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), len(low))
    return min(len(low), common + max(1, math.ceil(math.log(max(rows / target, 1.0), 16))))


class Blocks:
    """Ranges of order keys, each a prefix, of a bounded number of rows.

    A prefix with too many rows gets longer ones of its own, until none is left.  Rows of one
    key (one id and text) are the same to everything here; very many of them are spread over
    blocks by a random draw.  At most MOST_BLOCKS / 16 prefixes are heavy at each length,
    and only they come to the driver.
    """

    def __init__(self, keys: DataFrame):
        self.spark = keys.sparkSession
        r = keys.agg(F.min("key").alias("lo"), F.max("key").alias("hi"), F.count(F.lit(1)).alias("n")).first()
        self.target = max(BLOCK_ROWS, r["n"] // MOST_BLOCKS)
        self.first = _digits(r["lo"], r["hi"], r["n"], self.target) if r["n"] else 1
        self.levels: list[DataFrame] = []
        self.spread: list[tuple[str, int]] = []
        while r["n"]:
            x = self.cut(keys)
            counts = x.groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi"))
            heavy = counts.where((F.col("n") > 16 * self.target) & (F.length("block") < KEY_LENGTH)).collect()
            if not heavy:
                break
            longer = [(h["block"], _digits(h["lo"], h["hi"], h["n"], self.target)) for h in heavy]
            self.levels.append(self.spark.createDataFrame(longer, "block string, digits int"))
        if r["n"]:
            alike = self.cut(keys).groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.max("key").alias("key"))
            alike = alike.where((F.col("n") > 16 * self.target) & (F.length("block") == KEY_LENGTH)).collect()
            # parts of 16 targets each on average: the draw leaves none of them empty
            self.spread = [(a["key"], min(4096, a["n"] // (16 * self.target))) for a in alike]

    def cut(self, df: DataFrame) -> DataFrame:
        """Adds ``block``, the prefix of ``key`` that a row belongs to."""
        x = df.withColumn("block", F.substring("key", 1, self.first))
        for level in self.levels:
            x = x.join(F.broadcast(level), "block", "left")
            x = x.withColumn("block", F.coalesce(F.expr("substring(key, 1, digits)"), "block")).drop("digits")
        return x.select(*df.columns, "block")

    def deal(self, df: DataFrame) -> DataFrame:
        """``cut``, with the rows of very common keys spread: ``part`` says over which."""
        x = self.cut(df)
        if not self.spread:
            return x.withColumn("part", F.lit(0)).withColumn("parts", F.lit(1))
        table = self.spark.createDataFrame(self.spread, "key string, parts int")
        x = x.join(F.broadcast(table), "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        return x.withColumn("part", F.floor(F.rand(7) * F.col("parts")).cast("int"))

    def followers(self, keys: DataFrame) -> tuple[DataFrame, int]:
        """(key, block, part): the first key of every block, and the part of a block before,
        around the circle, in which that document is a neighbour; and their number."""
        firsts = self.cut(keys).groupBy("block").agg(F.min("key").alias("key"))
        w = Window.partitionBy().orderBy("block")  # a row for each block
        low = F.first("key").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        out = firsts.select("block", F.coalesce(F.lead("key").over(w), low).alias("key"))
        if self.spread:
            last = self.spark.createDataFrame([(k, p - 1) for k, p in self.spread], "block string, part int")
            out = out.join(F.broadcast(last), "block", "left")
        else:
            out = out.withColumn("part", F.lit(0))
        return out.select("key", "block", F.coalesce("part", F.lit(0)).alias("part")), 16 * MOST_BLOCKS


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Signatures of every document, of an edited copy, and their likeness.

    The edited text has the last half of the characters (rounded down) replaced by the first as
    many, or all, of the next document's: the one with the next smaller id, the first after the
    last.  Returns (doc_id, n_chars, edited, signature, edited_signature, near_edited,
    near_next), one row for each row of ``docs``.

    Null ids come last in that order; rows of one id go by the MD5 of their text, and equal
    rows are interchangeable.  A null text counts as empty.  A single document is its own next
    one.  Texts are read whole, however long, as one row; what a task holds is a few times
    the longest text.  Other columns are ignored, whatever their names; an empty table
    gives an empty result.

    Whole texts are shuffled once, to blocks of neighbours; a block also gets the first
    document of the next.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("key", order_key(F.col("id"), F.col("text")))
    with Stages(spark) as stages:
        keys = stages.write(rows.select("key"), "order-keys")
        blocks = Blocks(keys)
        after, bound = blocks.followers(keys)
        after = stages.write(after, "block-ends")
        first = rows.select("key", "text").join(F.broadcast(after.select("key").distinct()), "key", "left_semi")
        first = first.groupBy("key").agg(F.first("text").alias("text"))
        ends = join_small(first, after, "key", row_bound=bound, row_bytes=128)
        ends = materialize(ends.select("block", "part", "text"), "next-documents")
    own = blocks.deal(rows).select("block", "part", F.lit(0).alias("end"), "key", "id", "text", "parts")
    ends = ends.select("block", "part", F.lit(1).alias("end"), F.lit("").alias("key"), F.lit(None).cast(docs.schema[id_col].dataType).alias("id"), "text", F.lit(1).alias("parts"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    both = own.unionByName(ends).repartition(n, "block", "part")
    w = Window.partitionBy("block", "part").orderBy("end", "key")
    # only the rows of a spread key end a part without the next document: it is the same text
    x = both.withColumn("next", F.coalesce(F.lead("text").over(w), F.col("text")))
    n_chars = F.char_length("text").cast("long")
    half = F.floor(F.char_length("text") / 2).cast("int")
    kept = F.substring(F.col("text"), F.lit(1), (F.char_length("text") - half).cast("int"))
    edited = F.concat(kept, F.substring(F.col("next"), F.lit(1), half))
    x = x.select("block", "part", "end", "key", "id", n_chars.alias("n_chars"), "text", edited.alias("edited"))
    x = with_signatures(x, {"text": "signature", "edited": "edited_signature"})
    x = x.withColumn("next", F.coalesce(F.lead("signature").over(w), F.col("signature"))).where("end = 0")
    return x.select(
        F.col("id").alias(id_col), "n_chars", "edited", "signature", "edited_signature",
        likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
        likeness(F.col("signature"), F.col("next")).alias("near_next"),
    )
