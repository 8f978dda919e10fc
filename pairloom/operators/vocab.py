"""Vocabulary: token counts, frequency-ranked selection, id lookup."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT, PrepConfig, SpecialIds
from ..functions.text import split_keeping, split_words
from ..functions.token_table import MAX_TOKENS, token_table
from ..functions.word_split import counted_words, word_ids
from ..session import join_small

ROLES = {"unk": "[UNK]", "pad": "[PAD]", "cls": "[CLS]", "sep": "[SEP]", "mask": "[MASK]"}

SplitFn = Callable[[Column], Column]
ID_MASK = 0xFFFFFFFF


def tokens(lines: DataFrame, split_fn: SplitFn = split_words) -> DataFrame:
    return lines.select(F.explode(split_fn(F.col("text"))).alias("token"))


def token_counts(lines: DataFrame, split_fn: SplitFn = split_words) -> DataFrame:
    """Occurrences per token over the given lines (partial + final aggregate)."""
    return tokens(lines, split_fn).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def summed_token_counts(lines: DataFrame, split_fn: SplitFn = split_words) -> DataFrame:
    """As ``token_counts``, but the built-in split counts words in their Arrow batches, so that the
    aggregate adds up counts instead of words."""
    if split_fn is not split_words:
        return token_counts(lines, split_fn)
    return counted_words(lines).groupBy("token").agg(F.sum("n").alias("n"))


def count_threshold(candidates: DataFrame, k: int) -> int | None:
    """Largest count ``c`` such that at least ``k`` candidates have ``n >= c``
    (None when there are fewer than ``k``): the k-th largest count.

    Computed on the histogram of count values (one row per distinct count,
    far smaller than the token table) with a running sum from the top.
    """
    hist = candidates.groupBy("n").agg(F.count(F.lit(1)).alias("m"))
    w = Window.orderBy(F.col("n").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    row = hist.select("n", F.sum("m").over(w).alias("cum")).filter(F.col("cum") >= k).agg(F.max("n")).first()
    return None if row is None or row[0] is None else int(row[0])


def build_vocab(counts: DataFrame, cfg: PrepConfig = DEFAULT) -> DataFrame:
    """``(token, id, n)``: specials at ids 0.. in list order, then tokens with
    ``n >= min_frequency`` by count descending, token ascending, up to
    ``vocab_size`` entries in total.

    Exact top-k in two steps: the k-th largest count bounds the candidates
    (``n >= threshold``: k tokens plus ties), then a top-k over those keeps
    per partition only its own best k, so the final merge is small whatever
    the number of distinct tokens.
    """
    specials = list(cfg.special_tokens)
    k = cfg.vocab_size - len(specials)
    order = [F.col("n").desc(), F.col("token").asc()]
    cand = counts.filter((F.col("n") >= cfg.min_frequency) & ~F.col("token").isin(*specials))
    thr = count_threshold(cand, k)
    if thr is not None:
        cand = cand.filter(F.col("n") >= thr)
    top = cand.orderBy(*order).limit(k)
    words = top.select(
        "token",
        (F.row_number().over(Window.orderBy(*order)) + len(specials) - 1).cast("bigint").alias("id"),
        F.col("n").cast("bigint"),
    )
    spark = counts.sparkSession
    schema = T.StructType(
        [T.StructField("token", T.StringType()), T.StructField("id", T.LongType()), T.StructField("n", T.LongType())]
    )
    sp = spark.createDataFrame([(t, i, 0) for i, t in enumerate(specials)], schema)
    return sp.unionByName(words)


def special_ids(vocab: DataFrame) -> SpecialIds:
    """Ids that the vocabulary gives the special tokens (one five-row read); a
    token that is absent or there twice raises."""
    rows = vocab.where(F.col("token").isin(*ROLES.values())).select("token", "id").limit(2 * len(ROLES)).collect()
    found = {r["token"]: int(r["id"]) for r in rows}
    if len(rows) != len(ROLES) or len(found) != len(ROLES):
        raise ValueError(f"the vocabulary must hold each of {sorted(ROLES.values())} once")
    return SpecialIds(**{role: found[token] for role, token in ROLES.items()})


def lookup_join(token_rows: DataFrame, vocab: DataFrame, cfg: PrepConfig = DEFAULT) -> DataFrame:
    """Left join of ``token`` with the vocabulary's ``id``; broadcast only if the
    table's counted rows and bytes allow it."""
    size = vocab.agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("token")).alias("b")).first()
    return join_small(token_rows, vocab.select("token", "id"), "token", "left", row_bound=size["n"],
                      max_rows=cfg.broadcast_max_rows, row_bytes=32 + (size["b"] or 0))


def lookup_ids(
    rows: DataFrame,
    vocab: DataFrame,
    key_cols: list[str],
    carry_cols: list[str] = (),
    max_tokens: int | None = None,
    split_fn: SplitFn = split_words,
    cfg: PrepConfig = DEFAULT,
    special: SpecialIds | None = None,
    literal_specials: bool = True,
) -> DataFrame:
    """Adds ``ids: array<bigint>`` (unknown tokens map to ``[UNK]``).

    With ``literal_specials`` a special token that stands in a text is a token of its own and
    gets its id, as a tokenizer gives it; without, or with a ``split_fn`` of the caller's, it is split
    like any text.  Token counts never keep them whole.

    A vocabulary whose counted size allows it becomes constant arrays and words are looked up inside
    their row: rows stay where they are.  The built-in split does so on Arrow batches
    (``functions.word_split``), a split of the caller's in the plan (``functions.token_table``).  Beyond
    that size tokens are exploded, joined and regrouped by ``key_cols``, with the same
    result; when ``rows`` is already hash-partitioned by a prefix of ``key_cols`` (the
    segmentation bucket), the regroup needs no shuffle.  ``max_tokens`` keeps
    only the first tokens of each row.
    """
    unk = (special_ids(vocab) if special is None else special).unk
    table = token_table(vocab, min(MAX_TOKENS, cfg.broadcast_max_rows))
    literals = cfg.special_tokens if literal_specials and split_fn is split_words else ()
    if table is not None and split_fn is split_words:
        return word_ids(rows, [*key_cols, *carry_cols], table.tokens, table.ids, unk, literals, max_tokens)
    toks = (split_keeping(literals) if literals else split_fn)(F.col("text"))
    if max_tokens is not None:
        toks = F.slice(toks, 1, int(max_tokens))
    if table is not None:
        split = rows.select(*key_cols, *carry_cols, toks.alias("_words"))
        # a null text (an outer explode of nothing) has no ids
        ids = table.ids_of(F.coalesce("_words", F.array().cast("array<string>")), unk)
        return split.select(*key_cols, *carry_cols, ids.alias("ids"))
    return _lookup_by_join(rows, toks, vocab, unk, key_cols, carry_cols, cfg)


def _lookup_by_join(rows: DataFrame, toks: Column, vocab: DataFrame, unk: int, key_cols, carry_cols, cfg: PrepConfig) -> DataFrame:
    ex = rows.select(*key_cols, *carry_cols, F.posexplode_outer(toks).alias("pos", "token"))
    j = lookup_join(ex, vocab, cfg)
    # (pos << 32) + id: one primitive per token, so sorting the collected
    # list restores token order without building a struct per token.
    code = F.when(
        F.col("pos").isNotNull(),
        F.shiftleft(F.col("pos").cast("bigint"), 32) + F.coalesce("id", F.lit(unk).cast("bigint")),
    )
    g = j.groupBy(*key_cols).agg(
        *[F.first(c).alias(c) for c in carry_cols],
        F.sort_array(F.collect_list(code)).alias("_codes"),
    )
    return g.select(*key_cols, *carry_cols, F.transform("_codes", lambda x: x.bitwiseAND(F.lit(ID_MASK))).alias("ids"))
