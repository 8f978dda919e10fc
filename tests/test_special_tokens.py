"""Special tokens that stand in texts, against the tokenizers library."""

import random

from pairloom import DEFAULT
from pairloom.config import SPECIAL_TOKENS
from pairloom.functions.text import split_keeping, split_words
from pairloom.operators.vocab import lookup_ids, token_counts
from pyspark.sql import functions as F


def library(vocab):
    from tokenizers import Tokenizer
    from tokenizers.models import WordLevel
    from tokenizers.pre_tokenizers import Whitespace

    t = Tokenizer(WordLevel(vocab, unk_token="[UNK]"))
    t.pre_tokenizer = Whitespace()
    t.add_special_tokens([s for s in SPECIAL_TOKENS])
    return t


def texts():
    rng = random.Random(4)
    parts = [*SPECIAL_TOKENS, "[", "]", "MASK", "mask", "[MASK", "SEP]", "a", "b", "né", "_", "(", ").", " ", "  ", "\n", "x1", "日本"]
    out = ["a [MASK] b[SEP] c", "", "[MASK][MASK]", "([CLS])", "a[UNK]b", "[[SEP]]", "[MASK [MASK]"]
    return out + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(400)]


def test_ids_equal_the_library(spark):
    words = ["a", "b", "c", "MASK", "[", "]", "(", ").", "né", "x1", "日本", "[[", "a_"]
    vocab = {t: i for i, t in enumerate([*SPECIAL_TOKENS, *words])}
    tok = library(vocab)
    rows = spark.createDataFrame(list(enumerate(texts())), "row_id long, text string")
    table = spark.createDataFrame([(t, i, 0) for t, i in vocab.items()], "token string, id long, n long")
    for cfg in (DEFAULT, DEFAULT.with_(broadcast_max_rows=1)):
        got = {r.row_id: r.ids for r in lookup_ids(rows, table, ["row_id"], cfg=cfg).collect()}
        assert all((got[i] or []) == tok.encode(t).ids for i, t in enumerate(texts()))
    off = {r.row_id: r.ids for r in lookup_ids(rows, table, ["row_id"], literal_specials=False).collect()}
    assert off[0] == [vocab[w] if w in vocab else 0 for w in ["a", "[", "MASK", "]", "b", "[", "SEP", "]", "c"]]


def test_counts_split_them(spark):
    rows = spark.createDataFrame([("a [MASK]",)], "text string")
    assert {r.token for r in token_counts(rows).collect()} == {"a", "[", "MASK", "]"}


def test_literals_between_letters(spark):
    def words(literals, text):
        return spark.createDataFrame([(text,)], "t string").select(split_keeping(literals)(F.col("t"))).first()[0]

    assert words(["<s>", "<s>>"], "a<s>>b,<s>!") == ["a", "<s>>", "b", ",", "<s>", "!"]
    assert words(["eos", " x "], "abeosc eos x !") == ["ab", "eos", "c", "eos", " x ", "!"]
    assert words(["[Q.*\\E]"], "a[Q.*\\E]b") == ["a", "[Q.*\\E]", "b"]
    plain = spark.createDataFrame([("ab, c_d é",)], "t string")
    assert plain.select(split_words("t")).first() == plain.select(split_keeping(["[MASK]"])("t")).first()
