import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer, pre_tokenizers

from pairloom.llm import token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("ids", [[], [5], [65535, 0, 65535], list(range(3000)), [7] * 5000, [i % 90 for i in range(700_000)]])
def test_blocks_round_trip(ids):
    ids = np.array(ids, "<u4")
    blocks = token_files.encode_blocks(ids)
    back = list(token_files.decode_blocks(blocks))
    assert (np.concatenate(back) if back else ids).tolist() == ids.tolist()


def test_random_ids_round_trip_and_blocks_are_independent():
    ids = np.random.default_rng(1).integers(0, 65536, 20_000).astype("<u4")
    blocks = token_files.encode_blocks(ids)
    parts = list(token_files.decode_blocks(blocks))
    alone = list(token_files.decode_blocks([blocks[3]]))[0]
    assert alone.tolist() == parts[3].tolist()
    assert np.concatenate(parts).tolist() == ids.tolist()


def test_repetition_is_predicted():
    rng = np.random.default_rng(2)
    phrase = rng.integers(0, 50_000, 50).astype("<u4")
    coded = sum(map(len, token_files.encode_blocks(np.tile(phrase, 4000))))
    assert coded < 0.5 * 2 * 200_000


def test_a_damaged_block_is_noticed():
    block = bytearray(token_files.encode_blocks(np.arange(1000, dtype="<u4"))[0])
    block[40] ^= 1
    with pytest.raises(ValueError):
        list(token_files.decode_blocks([bytes(block)]))


def test_large_ids_are_refused():
    with pytest.raises(ValueError):
        token_files.encode_blocks(np.array([65536], "<u4"))


def test_files(make_docs, prose, tmp_path):
    rows = [(i, prose(40 + i % 60, i), "s") for i in range(120)]
    rows += [(200, None, "s"), (201, "", "s"), (None, "no id", None), (5, rows[5][1], "s"), (202, prose(20_000, 1), "s"),
             (203, "<|endoftext|> 日本 İ", "s"), (204, "a  b\n\n c\t 'll we're ½", "s")]
    docs = make_docs(rows)
    folder = f"file://{tmp_path}/tokens"
    files = token_files.write_tokens(docs, PATH, folder)
    got = token_files.read_tokens(files, folder).collect()
    library = Tokenizer.from_file(PATH)
    got.sort(key=lambda r: r.start)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    assert len(got) == len(want)
    for g, (i, text, _) in zip(got, want, strict=True):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        assert (g.doc_id, g.start, g.n_tokens) == (i, start, len(ids))
        assert zlib.crc32(g.ids) == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_no_documents(make_docs, tmp_path):
    files = token_files.write_tokens(make_docs([]), PATH, str(tmp_path / "t"))
    assert token_files.read_tokens(files, str(tmp_path / "t")).collect() == []


def test_pieces_are_cut_as_the_library_cuts():
    rng = np.random.default_rng(3)
    parts = [" ", "  ", "\n", "\t", "'", "'s", "'ll", "'re", "'t", "'x", "a", "bc", "The", "é", "ß", "½", "7", "42", "!", "..", "<|", "<", "|",
             "<|endoftext|>", "日本", " ", "\r", "İ", "of", " of"]
    texts = ["".join(parts[k] for k in rng.integers(0, len(parts) - 8 * int(rng.integers(2)), rng.integers(0, 12))) for _ in range(6000)]
    texts += ["<", "|endoftext|>", "a ", "'s", " ", "'", "s", None, "", "x'", "ll b", "\n", " a\n"]
    library = Tokenizer.from_file(PATH)
    want = [[*library.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
    made = token_files.Pieces(PATH)
    for k in (1, 700, len(texts)):
        for low in range(0, 700 if k == 1 else len(texts), k):
            ids, sizes = made.encode(pa.array(texts, pa.string()).slice(low, k), 2)
            assert np.split(ids, np.cumsum(sizes)[:-1])[0].tolist() == want[low]
            assert ids.tolist() == [x for w in want[low : low + k] for x in w]
            assert sizes.tolist() == [len(w) for w in want[low : low + k]]


def test_pieces_that_are_forgotten_are_asked_again(monkeypatch):
    monkeypatch.setattr(token_files, "CACHE_PIECES", 6)
    library, made = Tokenizer.from_file(PATH), token_files.Pieces(PATH)
    for k in range(30):
        text = f"often zebra{'abcdefghijklmno'[k % 15]} quux{k} \n\n end"
        assert made.encode(pa.array([text]), 2)[0].tolist() == [*library.encode(text, add_special_tokens=False).ids, 2]
    assert len(made.known) < 6 + 8


def test_the_library_is_asked_once_for_a_piece():
    class Counted:
        def __init__(self, tok):
            self.tok, self.texts = tok, []

        def encode_batch_fast(self, texts, **kw):
            self.texts += texts
            return self.tok.encode_batch_fast(texts, **kw)

    made = token_files.Pieces(PATH)
    made.tok, made.model = Counted(made.tok), Counted(made.model)
    for _ in range(3):
        made.encode(pa.array(["one two\n\nthree " * 50] * 40), 2)
    assert 0 < sum(map(len, made.tok.texts + made.model.texts)) < 100


def test_a_tokenizer_that_cuts_otherwise_gets_whole_texts(tmp_path):
    other = Tokenizer.from_file(PATH)
    other.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=True)
    other.save(str(tmp_path / "other.json"))
    texts = ["one two's\n\nthree ", "", None, "x"]
    ids, sizes = token_files.Pieces(str(tmp_path / "other.json")).encode(pa.array(texts, pa.string()), 2)
    want = [[*other.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
    assert ids.tolist() == [x for w in want for x in w] and sizes.tolist() == [len(w) for w in want]


def test_many_ids_take_few_steps(monkeypatch):
    # every step is a handful of numpy calls, so its number of ids decides the cost of an id
    steps = []
    learn = token_files.Model.learn
    monkeypatch.setattr(token_files.Model, "learn", lambda self, n, *a: (steps.append(n), learn(self, n, *a))[1])
    rng = np.random.default_rng(4)
    ids = rng.zipf(1.3, 1_200_000).clip(0, 65_535).astype("<u4")
    blocks = token_files.encode_blocks(ids)
    assert sum(steps) == len(ids) and len(steps) <= 600
    assert np.concatenate(list(token_files.decode_blocks(blocks))).tolist() == ids.tolist()


def test_coded_size_is_near_the_entropy():
    rng = np.random.default_rng(5)
    ids = rng.zipf(1.5, 600_000).clip(0, 4_000).astype("<u4")
    share = np.bincount(ids)[np.bincount(ids) > 0] / len(ids)
    entropy = -(share * np.log2(share)).sum() / 8 * len(ids)
    assert sum(map(len, token_files.encode_blocks(ids))) < 1.25 * entropy
