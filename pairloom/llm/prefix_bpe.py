"""BPE encoding by dynamic programming over prefixes, and decoding (operator 9).

The encoding of a prefix ends in exactly one token.  An automaton lists the tokens
that are suffixes of each prefix; of these, the last token is the one that is
compatible with the last token of the prefix before it, where two tokens are
compatible if encoding their concatenation gives the two back.  Following the stored
last tokens backwards gives the ids that merging by rank would give, in time linear
in the word.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from .common import map_arrow, prepare

#: Distinct words whose ids a worker remembers; beyond it starts afresh.
CACHE_WORDS = 150_000
#: Pairs of tokens whose compatibility it remembers.
CACHE_PAIRS = 200_000

#: Code points on which every Unicode version agrees and that normalisation leaves
#: alone, but for lower-casing; texts with others take the tokenizer's own
#: normaliser and pre-tokenizer.
PLAIN = "\t\n\x20-\x7e\xa1-įı-ɏ"


def _classes() -> tuple[str, str]:
    plain = [chr(x) for x in (*range(0x20, 0x7F), *range(0xA1, 0x130), *range(0x131, 0x250))]
    points = {*plain, *(c for x in plain for c in x.lower())}
    kind = lambda k: "".join(re.escape(c) for c in sorted(points) if unicodedata.category(c)[0] == k)
    return kind("L"), kind("N")


class PrefixBpe:
    """The encoder of one tokenizer file with an end-of-word suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"] or ""
        self.strings = {i: t for t, i in self.vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.table = np.array([self.strings.get(i, "") for i in range(max(self.strings) + 1)], dtype=object)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        tok = Tokenizer.from_file(path)
        self.normalize = tok.normalizer.normalize_str
        self.pre_tokenize = tok.pre_tokenizer.pre_tokenize_str
        self.pair: dict[tuple[int, int], int] = {}
        self.split: dict[int, tuple[int, int]] = {}
        merged = set()
        for rank, (left, right) in enumerate(model["merges"]):
            a, b, c = self.vocab[left], self.vocab[right], self.vocab[left + right]
            self.pair[a, b] = c
            self.split.setdefault(c, (a, b))
            merged.add(c)
        base = [i for i in self.vocab.values() if i not in merged]
        # ids must rise with the rank of the merge that makes them
        ranks = [self.vocab[a + b] for a, b in model["merges"]]
        if any(x >= y for x, y in zip(ranks, ranks[1:], strict=False)) or (ranks and ranks[0] <= max(base)):
            raise ValueError("token ids do not follow the merge ranks")
        # a word is written as one character for each base token
        text: dict[int, str] = {i: chr(0x100 + i) for i in base}
        for c in ranks:
            a, b = self.split[c]
            text[c] = text[a] + text[b]
        self.automaton = ahocorasick.Automaton()
        for i, s in text.items():
            self.automaton.add_word(s, (i, len(s)))
        self.automaton.make_automaton()
        byte_chars = self._byte_chars()
        self.inner = [text[self.vocab[c]] for c in byte_chars]
        self.final = [text[self.vocab[c + end]] for c in byte_chars]
        self.byte_of = {c: b for b, c in enumerate(byte_chars)}
        self.fits: dict[tuple[int, int], bool] = {}
        self.words: dict[str, bytes] = {}
        letters, numbers = _classes()
        self.plain = re.compile(f"[{PLAIN}]*")
        self.find = re.compile(
            rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^\s{letters}{numbers}]+"
        ).findall

    @staticmethod
    def _byte_chars() -> list[str]:
        """The visible character that stands for each byte: itself if printable in
        Latin-1, else the next free code point from 256 on."""
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        spare = iter(range(256, 512))
        return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]

    def compatible(self, a: int, b: int) -> bool:
        """Whether the concatenation of two tokens is encoded as these two.

        Undoes merges from the younger of the two tokens at the seam; a merge across
        the seam that is older than what was undone would have come first.
        """
        key = (a, b)
        known = self.fits.get(key)
        if known is not None:
            return known
        limit, answer = 1 << 62, True
        while True:
            across = self.pair.get((a, b))
            if across is not None and across < limit:
                answer = False
                break
            # take apart the one made last; equal ids: the right one, which is made after the left
            if a > b and a in self.split:
                limit, a = a, self.split[a][1]
            elif b in self.split:
                limit, b = b + 1, self.split[b][0]
            elif a in self.split:
                limit, a = a, self.split[a][1]
            else:
                break
        if len(self.fits) > CACHE_PAIRS:
            self.fits.clear()
        self.fits[key] = answer
        return answer

    def encode_symbols(self, s: str) -> list[int]:
        """Ids of one word given as base characters."""
        last: list[int] = [-1] * len(s)
        size: list[int] = [0] * len(s)
        for end, (token, n) in self.automaton.iter(s):
            if size[end]:
                continue
            before = end - n
            if before < 0 or self.compatible(last[before], token):
                last[end], size[end] = token, n
        out, at = [], len(s) - 1
        while at >= 0:
            out.append(last[at])
            at -= size[at]
        return out[::-1]

    def encode_word(self, data: bytes) -> bytes:
        s = "".join([self.inner[b] for b in data[:-1]]) + self.final[data[-1]]
        return np.array(self.encode_symbols(s), "<u4").tobytes()

    def _pieces(self, text: str) -> Iterator[str]:
        """Words of an ordinary text, as text."""
        if self.plain.fullmatch(text):
            yield from self.find(text.lower())
            return
        back = self.byte_of
        for word, _ in self.pre_tokenize(self.normalize(text)):
            yield bytes([back[c] for c in word]).decode("utf-8", "surrogateescape")

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        parts = self.cut.split(text) if self.cut and "<|" in text else [text]
        known, out = self.words, []
        for k, part in enumerate(parts):
            if k % 2:
                out.append(np.array([self.special[part]], "<u4").tobytes())
                continue
            if not part:
                continue
            words = self.find(part.lower()) if self.plain.fullmatch(part) else list(self._pieces(part))
            try:
                out.append(b"".join([known[w] for w in words]))
            except KeyError:
                if len(known) > CACHE_WORDS:
                    known.clear()
                for w in words:
                    if w not in known:
                        known[w] = self.encode_word(w.encode("utf-8", "surrogateescape"))
                out.append(b"".join([known[w] for w in words]))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The tokens' strings, special ones included, joined by spaces: the file names
        no decoder, and that is what the tokenizers library then does."""
        return " ".join(self.table[np.frombuffer(ids, "<u4")].tolist())


_LOADED: dict[str, PrefixBpe] = {}


def loaded(path: str) -> PrefixBpe:
    """One encoder a worker process."""
    if path not in _LOADED:
        _LOADED[path] = PrefixBpe(path)
    return _LOADED[path]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = True) -> DataFrame:
    """Encode every whole text and, if ``decoded``, decode the ids again.

    Returns (id_col, ids, decoded): ids as little-endian unsigned 32-bit integers in a
    binary column.  A map without a shuffle; rows keep their id, null or repeated ids
    included, one row out for each row in.  A null or empty text has no ids and an
    empty decoded text.  Other columns of ``docs`` are not read.  ``path`` must name
    the tokenizer file on every machine.
    """
    spark = docs.sparkSession
    prepare(spark)
    kept = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    fields = [kept.schema.fields[0], T.StructField("ids", T.BinaryType())]
    fields += [T.StructField("decoded", T.StringType())] if decoded else []

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in batches:
            ids = [bpe.encode(t) for t in batch.column(1).to_pylist()]
            cols = [batch.column(0), pa.array(ids, pa.binary())]
            if decoded:
                cols.append(pa.array([bpe.decode(x) for x in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in fields])

    return map_arrow(kept, run, T.StructType(fields))
