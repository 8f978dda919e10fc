"""Encoder objects in place of a word split and a vocabulary."""

import public_tokenizers
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from pairloom import Preparation
from pairloom.operators.encoders import encode_texts, encoder_special_ids, encoder_vocab
from pairloom.sources.corpus import documents_corpus, table
from paths import SF_SMALL


@pytest.fixture(scope="module")
def subwords():
    """Pairs of letters, with the special tokens at ids of its own."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    merges = [(a, b) for a in "aeiou" for b in "nrst"]
    words = [*letters, *[a + b for a, b in merges], "[MASK]", "[UNK]", "[SEP]", "[PAD]", "[CLS]"]
    tok = Tokenizer(models.BPE({w: i for i, w in enumerate(words)}, merges, unk_token="[UNK]"))
    tok.pre_tokenizer = pre_tokenizers.Whitespace()
    return tok


def test_ids_are_those_of_direct_calls(spark, subwords):
    texts = ["an error is a test", "", "Ünder [MASK] sent", "x" * 5000, " "]
    rows = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "row_id long, text string, ids int").repartition(3)
    for encoder in (subwords, Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))):
        got = {r["row_id"]: r["ids"] for r in encode_texts(rows, encoder, ["row_id"]).collect()}
        assert got == {i: encoder.encode(t).ids for i, t in enumerate(texts)}
    cut = encode_texts(rows, subwords, ["row_id"], max_tokens=2).collect()
    assert all(r["ids"] == subwords.encode(texts[r["row_id"]]).ids[:2] for r in cut)
    with pytest.raises(PySparkException):
        encode_texts(spark.createDataFrame([(1, None)], "row_id long, text string"), subwords, ["row_id"]).collect()


def test_vocabulary_and_special_ids(spark, subwords):
    rows = spark.range(1)
    vocab = {r["token"]: r["id"] for r in encoder_vocab(rows, subwords).collect()}
    assert vocab == subwords.get_vocab() and len(vocab) == subwords.get_vocab_size()
    s = encoder_special_ids(subwords)
    assert (s.mask, s.unk, s.sep, s.pad, s.cls) == tuple(vocab[t] for t in ("[MASK]", "[UNK]", "[SEP]", "[PAD]", "[CLS]"))
    with pytest.raises(ValueError):
        encoder_special_ids(Tokenizer(models.BPE({"a": 0}, [])))


def test_a_whole_preparation_with_an_encoder(spark, subwords):
    with Preparation(documents_corpus(table(spark, SF_SMALL, "documents")), encoder=subwords) as p:
        texts = {r["row_id"]: r["text"] for r in p.sentences.select("row_id", "text").collect()}
        s = p.special
        assert p.vocab_size == subwords.get_vocab_size()
        rows = p.examples.join(p.pairs.select("example_id", "b_id"), "example_id").orderBy(F.xxhash64("example_id")).limit(40).collect()
        for r in rows:
            a, b = (subwords.encode(texts[r[c]]).ids for c in ("example_id", "b_id"))
            assert list(r["input_ids"][: r["n_a"] + r["n_b"] + 3]) == [s.cls, *a[: r["n_a"]], s.sep, *b[: r["n_b"]], s.sep]
