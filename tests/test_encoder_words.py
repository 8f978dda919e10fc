"""Encoders that cut at spaces: ids from remembered words."""

import os
import random
import subprocess
import sys

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from tokenizers import AddedToken, Regex, Tokenizer, models, normalizers, pre_tokenizers, processors

from pairloom.operators import encoders
from pairloom.operators.encoders import by_words, cuts_at_spaces, encode_texts, seam

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PARTS = ["<|endoftext|>", "<|startoftext|>", "<|endoftext|", "<|", "|>", " ", "  ", "\t", "\n", " ", "　", "\x85", "\x00",
         "é", "e", "́", "İ", "Σ", "ΑΣ", "ß", "日本", "１２", "½", "'S", "don't", "'ll", "😀", "​", "‍", "가", "a", "9", "!?"]


def ids_by_word(tok):
    """A function from texts to lists of ids."""
    ids = by_words(tok)(tok)

    def run(texts):
        found, counts = ids(pa.array(texts, pa.string()))
        return [x.tolist() for x in np.split(found, np.cumsum(counts)[:-1])]

    return run


class Counted:
    """A tokenizer that counts what it encodes."""

    def __init__(self, tok):
        self.tok, self.words = tok, 0
        self.to_str, self.token_to_id = tok.to_str, tok.token_to_id

    def encode(self, text):
        self.words += 1
        return self.tok.encode(text)

    def encode_batch_fast(self, texts):
        self.words += sum(1 + t.count("text|>") for t in texts)
        return self.tok.encode_batch_fast(texts)


def odd_texts(n):
    rng = random.Random(5)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def small(**change):
    tok = Tokenizer(models.WordLevel({"a": 0, "b": 1, "[UNK]": 2}, unk_token="[UNK]"))
    tok.pre_tokenizer = pre_tokenizers.Whitespace()
    for name, value in change.items():
        setattr(tok, name, value)
    return tok


@pytest.mark.parametrize("held", [200_000, 50])
def test_ids_of_words_are_those_of_whole_texts(held, monkeypatch):
    monkeypatch.setattr(encoders, "WORDS_HELD", held)
    monkeypatch.setattr(encoders, "TOGETHER", 7)
    tok = Tokenizer.from_file(WORD_BPE)
    texts = [*odd_texts(3000), "x" * 5000 + " y", " ".join(["word"] * 3000)]
    ids = ids_by_word(tok)
    for low in range(0, len(texts), 400):
        some = texts[low : low + 400]
        assert ids(some) == [tok.encode(t).ids for t in some]


def test_a_word_is_encoded_once():
    tok = Counted(Tokenizer.from_file(WORD_BPE))
    ids = ids_by_word(tok)
    for _ in range(5):
        ids(["one two one", "two three"] * 100)
    assert tok.words == 3


def test_words_that_no_added_token_can_part():
    assert seam(["[X]", "b[X"]) == "b[X" and seam(["[X]", "b[", "b[c"]) is None and seam(["aa"]) is None and seam([]) is None
    tok = small()
    for text in ("b a  x", "aaa a", ""):
        assert cuts_at_spaces(tok)
        assert ids_by_word(tok)([text]) == [tok.encode(text).ids]
        tok.add_special_tokens(["aa"])  # "a" + "aa" is found a character too early


def test_only_tokenizers_that_cut_at_spaces_are_taken_by_word():
    assert cuts_at_spaces(Tokenizer.from_file(WORD_BPE)) and cuts_at_spaces(small(normalizer=normalizers.Lowercase()))
    spaced, one_side, random_merges = small(), small(), small(model=models.BPE({"a": 0}, [], dropout=0.1))
    spaced.add_tokens(["a b"])
    one_side.add_tokens([AddedToken("[X]", single_word=True)])
    padded, cut = small(), small()
    padded.enable_padding(length=8)
    cut.enable_truncation(2)
    ends = processors.TemplateProcessing(single="$A [UNK]", special_tokens=[("[UNK]", 2)])
    look_ahead = pre_tokenizers.Split(Regex(r"\w+(?= )"), "removed", invert=True)
    others = [Counted(small()), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), spaced, one_side, random_merges, padded, cut,
              small(post_processor=ends), small(pre_tokenizer=pre_tokenizers.Metaspace()), small(normalizer=normalizers.Strip()),
              small(pre_tokenizer=look_ahead), Tokenizer(models.BPE({"a": 0}, []))]
    assert not any(map(cuts_at_spaces, others))


def test_rows_by_word(spark, monkeypatch):
    monkeypatch.setattr(encoders, "CUT_AT_ONCE", 100)
    tok = Tokenizer.from_file(WORD_BPE)
    texts = [t for t in odd_texts(400) if "\x00" not in t]
    rows = spark.createDataFrame(list(enumerate(texts)), "row_id long, text string").repartition(3)
    for most in (None, 3):
        got = {r["row_id"]: r["ids"] for r in encode_texts(rows, tok, ["row_id"], max_tokens=most).collect()}
        assert got == {i: tok.encode(t).ids[:most] for i, t in enumerate(texts)}
    assert encode_texts(rows.where(F.lit(False)), tok, ["row_id"]).collect() == []


def test_workers_need_nothing_of_the_package(tmp_path):
    code = cloudpickle.dumps(by_words(Tokenizer.from_file(WORD_BPE)))
    load = f"import pickle, sys; import pyarrow as pa; from tokenizers import Tokenizer; f = pickle.load(sys.stdin.buffer)(Tokenizer.from_file({WORD_BPE!r})); print(f(pa.array(['a b']))[1][0])"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", load], input=code, cwd=tmp_path, env=env, capture_output=True, timeout=60)
    assert out.stdout.strip() == b"2", out.stderr
