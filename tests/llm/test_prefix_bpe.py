import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pairloom.llm import prefix_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " \n\t", "a", "İstanbul ΣΑΣ Ǆ", "<|endoftext|>x <|startoftext|>", "x<|y", "日本語 ☃ 😀 123４５", "don't we'LL 'S",
       "a" * 3000, "\x00\x1f a\x85b\xa0c", "é Å ﬁ ½ ²", "!!!????....", "Ⱥ Ɓ", "aaaaab" * 30]


@pytest.fixture(scope="module")
def pair():
    return prefix_bpe.PrefixBpe(PATH), Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(3)
    out = list(ODD)
    for chars in ("abcdefgh THE the!?$%&*'sé ßİΣςñ\n\t12Ⅷ中𝔸", "thein grasdo"):
        out += ["".join(rng.choice(chars) for _ in range(rng.randint(1, 70))) for _ in range(600)]
    return out


def test_ids_and_decoding_equal_the_library(pair):
    own, library = pair
    for t in texts():
        want = library.encode(t, add_special_tokens=False).ids
        got = own.encode(t)
        assert np.frombuffer(got, "<u4").tolist() == want
        assert own.decode(got) == library.decode(want, skip_special_tokens=False)


def test_rows(make_docs):
    docs = make_docs([(1, "Hello hello", "a"), (1, "Hello hello", "a"), (None, "x", None), (3, None, "b"), (4, "", "b")])
    rows = sorted(prefix_bpe.encode(docs, PATH).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    assert [len(r.ids) // 4 for r in rows] == [2, 2, 0, 0, 1]
    assert rows[0].decoded == "hello</w> hello</w>" and rows[2].decoded == ""


def test_empty_table(make_docs):
    assert prefix_bpe.encode(make_docs([]), PATH).collect() == []
