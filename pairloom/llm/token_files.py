"""Token files: ids coded by an adaptive context-mixing range coder (operator 3).

A file holds blocks of up to ``BLOCK`` ids.  Every block starts from a fresh model, carries
checksums, and can be decoded alone.  A block is cut into lanes, runs of ids that are
coded in step, one numpy operation for all; its lanes share one model and have a range coder each.
The id that last followed the two ids before (order 2) and the one that last followed the id
before (order 1) are predicted; whether a prediction holds is coded with a
probability mixed from the confidences of both orders and from how often the predicted
id has been seen (order 0).  An id that neither predicts is coded by its adaptive order-0
frequency, one not met before in the block by itself.  Followers are learnt at every step;
frequencies, mixed probabilities and weights in growing strides of up to ``STRIDE`` steps.
All model arithmetic is in integers, so any machine decodes what another wrote.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer, pre_tokenizers

from ..session import join_small, materialize
from .common import map_arrow, prepare, utf8
from .prefix_bpe import PLAIN, PrefixBpe, _classes
from .warc import file_system

MAGIC = b"PLTOK2\0\0"
BLOCK = 1 << 21  # ids of a block; bounds memory
LEAST_BLOCK = 4096  # a shorter run of ids is cut into four blocks, none below this
LANES, LEAST_LANE = 8192, 128  # of a block, and ids of a lane where there are fewer
STRIDE = 32  # most steps between two refreshings of the shared tables
GROUP = 1 << 22  # ids that wait to be coded
MAX_ID = 1 << 16
CACHE_PIECES = 400_000  # pieces that a worker remembers; then it keeps the half met most
JOINED = 200  # pieces of a call's text
TEXT_BYTES = 8 << 20  # of texts that are cut in step
FOLLOWERS = 1 << 17  # slots of a block's table of followers of two ids
FREQ_BITS, HIT_BITS = 18, 12  # of the order-0 frequencies, and of the mixed probabilities
U32, U64 = np.uint32, np.uint64
LOW32 = U64(0xFFFFFFFF)

# --- integer logistic tables: stretch of 12-bit probabilities, and back ----------
_x = np.arange(-2047, 2048)
SQUASH = np.clip(np.round(4096 / (1 + np.exp(-_x / 256.0))), 1, 4095).astype(np.int32)
_p = (np.arange(4096) + 0.5) / 4096
STRETCH = np.clip(np.round(256 * np.log(_p / (1 - _p))), -2047, 2047).astype(np.int32)


class Coder:
    """The lanes' carry-less range coders: 64-bit low and range, 32-bit output."""

    def __init__(self, lanes: int):
        self.low = np.zeros(lanes, U64)
        self.range = np.full(lanes, ~U64(0))
        self.n = np.zeros(lanes, np.int64)

    def narrow(self, n: int, shift: int, interval) -> None:
        """Narrow the first n lanes to [lo, lo + size) of 2**shift, given as lo << 20 | size."""
        r, interval = self.range[:n] >> U64(shift), interval.view(U64)
        self.low[:n] += r * (interval >> U64(20))
        np.multiply(r, interval & U64(0xFFFFF), out=self.range[:n])

    def renew(self, n: int) -> None:
        """Pass on the words that are settled; leaves every range at 2**32 or more."""
        k = np.flatnonzero(self.range[:n] < U64(1 << 32))
        if len(k):
            low, rng = self.low.take(k), self.range.take(k)
            across = ((low ^ (low + rng - U64(1))) >> U64(32)) != 0
            if across.any():
                rng = np.where(across, U64(1 << 32) - (low & LOW32), rng)
            self.word(k, low)
            self.n[k] += 1
            self.low[k], self.range[k] = low << U64(32), rng << U64(32)


class Encoder(Coder):
    def __init__(self, lanes: int, room: int):
        super().__init__(lanes)
        self.out = np.zeros((lanes, room), U32)

    def word(self, k, low) -> None:
        self.out[k, self.n.take(k)] = (low >> U64(32)).astype(U32)

    def finish(self) -> None:
        """One word more: the least one that, followed by zeros, lies in the range."""
        self.word(np.arange(len(self.n)), self.low + LOW32)
        self.n += 1


class Decoder(Coder):
    """The same with the words of a coded stream, two or more zeros at their ends."""

    def __init__(self, words: np.ndarray):
        super().__init__(len(words))
        self.words = words
        self.value = (words[:, 0].astype(U64) << U64(32)) | words[:, 1].astype(U64)
        self.n += 2

    def word(self, k, low) -> None:
        at = np.minimum(self.n.take(k), self.words.shape[1] - 1)  # zeros from there on
        self.value[k] = (self.value.take(k) << U64(32)) | self.words[k, at].astype(U64)

    def which(self, n: int, shift: int, a, b):
        """Whether the value lies in [0, a) of 2**shift, and whether in [a, b)."""
        r, t = self.range[:n] >> U64(shift), self.value[:n] - self.low[:n]
        first = t < r * a.view(U64)
        return first, (t < r * b.view(U64)) > first

    def target(self, n: int, shift: int):
        r = self.range[:n] >> U64(shift)
        return np.minimum((self.value[:n] - self.low[:n]) // r, U64((1 << shift) - 1)).view(np.int64)


class Mix:
    """Probabilities that a prediction holds, for each context: mixed from three counts."""

    SHAPE = (8, 16, 16)  # confidence of order 2; agreement and confidence of order 1; order 0

    def __init__(self):
        self.hits = [np.zeros(k, np.int64) for k in self.SHAPE]
        self.met = [np.zeros(k, np.int64) for k in self.SHAPE]
        self.weight = [1 << 15] * 3
        self._mix()

    def _mix(self) -> None:
        self.stretched = []
        for k in range(3):
            p = np.clip((2 * self.hits[k] + 1) * 4096 // (2 * self.met[k] + 2), 1, 4095)
            shape = [1, 1, 1]
            shape[k] = -1
            self.stretched.append(STRETCH[p].astype(np.int64).reshape(shape))
        dot = sum(w * s for w, s in zip(self.weight, self.stretched, strict=True)) >> 16
        self.p = SQUASH[np.clip(dot, -2047, 2047) + 2047].astype(np.int64)

    def learn(self, hits: np.ndarray, met: np.ndarray) -> None:
        n = int(met.sum())
        if not n:
            return
        err = hits * 4096 - met * self.p
        for k in range(3):
            step = int((err * self.stretched[k]).sum()) // n * 6 * min(n, 16) >> 10
            self.weight[k] = min(max(self.weight[k] + step, -(1 << 18)), 1 << 18)
            rest = tuple(x for x in range(3) if x != k)
            self.hits[k] += hits.sum(rest)
            self.met[k] += met.sum(rest)
        self._mix()


class Model:
    """What the lanes of a block share: followers, mixed probabilities and frequencies.

    A follower is an id, or NONE, with its confidence (0: none) in the bits above it.
    """

    NONE = NEW = MAX_ID  # no id; the symbol of one not met before
    CERTAIN = 1 << FREQ_BITS  # the interval of what needs no frequency
    # next confidence, by confidence and whether the follower was right
    SURE = np.array([[1, 1], [1, 2], [1, 3], [1, 4], [2, 5], [2, 6], [3, 7], [3, 7]], np.int64).ravel() << 20

    def __init__(self, lanes: int, decode: bool):
        self.lanes, self.decode = lanes, decode
        self.one, self.two = np.full(MAX_ID, self.NONE, np.int32), np.full(FOLLOWERS, self.NONE, np.int32)
        self.p1, self.p2 = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        self.count = np.zeros(MAX_ID + 1, np.int64)
        self.mixes = Mix(), Mix()
        c2, other = np.arange(8)[:, None, None], np.arange(16)[None, :, None]
        self.some = np.broadcast_to((c2 > 0) | (other & 7 > 0), Mix.SHAPE)
        self.both = np.broadcast_to((c2 > 0) & (other > 0) & (other < 8), Mix.SHAPE)
        self.recent: list = []
        self.waiting = self.done = 0
        self._frequencies(1, 0)
        self._intervals()

    def predict(self, n: int):
        """First and second guess on each of the first n lanes; sets their context."""
        p1 = self.p1[:n]
        self.at = ((p1 * 0x9E3779B1 + self.p2[:n] * 0x85EBCA6B) >> 9) & (FOLLOWERS - 1)
        f1, f2 = self.one.take(p1).astype(np.int64), self.two.take(self.at).astype(np.int64)
        g1, g2 = f1 & 0xFFFFF, f2 & 0xFFFFF
        guess = np.where(f2 > 0xFFFFF, g2, g1)
        self.followers = f1, g1, f2, g2
        self.context = (f2 >> 12 & 0x700) | (f1 >> 16 & 0x70) | self.level.take(guess)
        self.context |= (g1 == g2).view(np.uint8).astype(np.int64) << 7
        return guess, g1

    def learn(self, n: int, value, outcome) -> None:
        """Take in the ids of the first n lanes; ``outcome`` is four times the context, and
        2 if the first guess held, 1 if the second did."""
        f1, g1, f2, g2 = self.followers
        for table, at, f, g in ((self.one, self.p1[:n], f1, g1), (self.two, self.at, f2, g2)):
            sure = self.SURE.take((f >> 19 & 14) + (g == value))
            table[at] = np.where(f >= 3 << 20, g, value) | sure
        self.p2[:n] = self.p1[:n]
        self.p1[:n] = value
        self.recent.append((outcome, value))
        self.waiting += n
        if self.waiting >= max(self.lanes, min(self.done // 4, STRIDE * self.lanes)):
            self._refresh()

    def _refresh(self) -> None:
        outcome, value = (np.concatenate(x) for x in zip(*self.recent, strict=True))
        n = np.bincount(outcome, minlength=4 << 11).reshape(*Mix.SHAPE, 4)
        self.mixes[0].learn(n[..., 2] * self.some, n.sum(-1) * self.some)
        self.mixes[1].learn(n[..., 1] * self.both, (n[..., 0] + n[..., 1]) * self.both)
        coded = np.bincount(value[outcome & 3 == 0], minlength=MAX_ID + 1)
        new = int(coded[self.count == 0].sum())
        self.count += coded
        self._frequencies(max(int(coded.sum()), 1), new)
        self._intervals()
        self.done += self.waiting
        self.recent, self.waiting = [], 0

    def _frequencies(self, coded: int, new: int) -> None:
        """Parts of 2**FREQ_BITS: one and its share for every id met; the rest for a new id."""
        met, total = self.count > 0, int(self.count.sum())
        room = (1 << FREQ_BITS) - 1 - int(np.count_nonzero(met))
        share = met + self.count * room // (total + total * new // coded + 1)
        ends = np.cumsum(share)
        top = int(ends[-1])
        self.new = top << 20 | ((1 << FREQ_BITS) - top)
        self.coded = np.where(met, (ends - share) << 20 | share, self.new)
        self.level = np.minimum(np.frexp(self.count.astype(np.float64))[1], 15).astype(np.uint8)
        if self.decode:
            self.owner = np.full(1 << FREQ_BITS, self.NEW, np.int32)
            self.owner[:top] = np.repeat(np.arange(MAX_ID + 1, dtype=np.int32), share)

    def _intervals(self) -> None:
        """Of 2**HIT_BITS, by context: a for the first guess, b - a for the second, the rest for neither."""
        a = np.clip(self.mixes[0].p, 1, 4090) * self.some
        b = a + np.clip((4096 - a) * self.mixes[1].p >> HIT_BITS, 1, 4095 - a) * self.both
        self.a, self.b = a.ravel(), b.ravel()
        self.hits = np.stack([b << 20 | (4096 - b), a << 20 | (b - a), a, a], -1).ravel()


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """Coded blocks of a run of ids."""
    if len(ids) and int(ids.max()) >= MAX_ID:
        raise ValueError(f"ids must be below {MAX_ID}")
    block = BLOCK if len(ids) >= BLOCK else max(LEAST_BLOCK, -(-len(ids) // 4))
    return [_encode_block(ids[k : k + block]) for k in range(0, len(ids), block)]


HEAD = struct.Struct("<IIIII")  # ids, their checksum, lanes, ids met first, checksum of what follows


def _lanes(n: int) -> tuple[int, int]:
    """Ids of a lane and number of lanes of a block of n ids; the last lane may be shorter."""
    steps = -(-n // min(LANES, max(1, n // LEAST_LANE)))
    return steps, -(-n // steps)


def _encode_block(ids: np.ndarray) -> bytes:
    steps, lanes = _lanes(len(ids))
    last = len(ids) - (lanes - 1) * steps
    grid = np.zeros(lanes * steps, np.int64)
    grid[: len(ids)] = ids
    columns = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    model, coder, news = Model(lanes, decode=False), Encoder(lanes, steps + 2), []
    for t in range(steps):
        n = lanes if t < last else lanes - 1
        value = columns[t, :n]
        guess, other = model.predict(n)
        first = value == guess
        second = (value == other) > first
        outcome = 4 * model.context + (2 * first.view(np.int8) + second.view(np.int8))
        coder.narrow(n, HIT_BITS, model.hits.take(outcome))
        coded = np.where(first | second, Model.CERTAIN, model.coded.take(value))
        coder.narrow(n, FREQ_BITS, coded)
        coder.renew(n)
        news.append(value[coded == model.new].astype("<u2"))
        model.learn(n, value, outcome)
    coder.finish()
    met = np.concatenate(news)
    words = coder.out[np.arange(coder.out.shape[1]) < coder.n[:, None]]
    body = coder.n.astype("<u2").tobytes() + met.tobytes() + words.astype("<u4").tobytes()
    return HEAD.pack(len(ids), zlib.crc32(ids.astype("<u4").tobytes()), lanes, len(met), zlib.crc32(body)) + body


def decode_blocks(blocks: Iterable[bytes]) -> Iterator[np.ndarray]:
    """Ids of coded blocks, in their order; a checksum that fails raises."""
    return map(_decode_block, blocks)


def _decode_block(block: bytes) -> np.ndarray:
    size, crc, lanes, n_met, body = HEAD.unpack_from(block)
    if zlib.crc32(memoryview(block)[HEAD.size :]) != body or not size or _lanes(size)[1] != lanes:
        raise ValueError("a block does not match its checksum")
    steps = _lanes(size)[0]
    last = size - (lanes - 1) * steps
    length = np.frombuffer(block, "<u2", lanes, HEAD.size).astype(np.int64)
    met = np.frombuffer(block, "<u2", n_met, HEAD.size + 2 * lanes).astype(np.int64)
    words = np.zeros((lanes, int(length.max()) + 2), U32)
    words[np.arange(words.shape[1]) < length[:, None]] = np.frombuffer(block, "<u4", -1, HEAD.size + 2 * lanes + 2 * n_met)
    model, coder, taken = Model(lanes, decode=True), Decoder(words), 0
    columns = np.zeros((steps, lanes), np.uint16)
    for t in range(steps):
        n = lanes if t < last else lanes - 1
        guess, other = model.predict(n)
        first, second = coder.which(n, HIT_BITS, model.a.take(model.context), model.b.take(model.context))
        hit = first | second
        outcome = 4 * model.context + (2 * first.view(np.int8) + second.view(np.int8))
        coder.narrow(n, HIT_BITS, model.hits.take(outcome))
        value = model.owner.take(coder.target(n, FREQ_BITS)).astype(np.int64)
        coder.narrow(n, FREQ_BITS, np.where(hit, Model.CERTAIN, model.coded.take(value)))
        coder.renew(n)
        value = np.where(hit, np.where(first, guess, other), value)
        new = np.flatnonzero(value == Model.NEW)
        if len(new):
            value[new] = met[taken : taken + len(new)]
            taken += len(new)
        columns[t, :n] = value
        model.learn(n, value, outcome)
    ids = columns.T.ravel()[:size].astype("<u4")
    if zlib.crc32(ids.tobytes()) != crc:
        raise ValueError("a block does not match its checksum")
    return ids


SPACE, LETTER, NUMBER, OTHER, ODD = range(5)


def _kinds() -> np.ndarray:
    """The class of every code point in the pre-tokenizer's pattern; ODD for those not in PLAIN."""
    letters, numbers = _classes()
    points = np.array([x for x in range(0x250) if re.match(f"[{PLAIN}]", chr(x))])
    kinds = np.full(0x110000, ODD, np.uint8)
    for x in points:
        c = chr(x)
        kinds[x] = SPACE if c.isspace() else LETTER if re.match(f"[{letters}]", c) else NUMBER if re.match(f"[{numbers}]", c) else OTHER
    return kinds


def _runs(values: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs of values from each of ``first`` on, one after another."""
    ends = np.cumsum(size)
    return values.take(np.repeat(first - (ends - size), size) + np.arange(int(size.sum())))


class Pieces:
    """The tokenizers library with a memory of the pieces that its pre-tokenizer cuts.

    Texts of code points on which all Unicode versions agree are cut here, a whole batch in
    step, as the pre-tokenizer's pattern cuts them, and only pieces not seen before go to
    the library; other texts, and those with a special token's string, go to it whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.kinds = _kinds()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        cut = spec["pre_tokenizer"] or {}
        #: whether the pattern below is the file's; if not, every text goes to the library whole
        self.cuts = (
            spec["normalizer"] is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut["add_prefix_space"]
            and all(t["content"].startswith("<|") for t in spec["added_tokens"])
        )
        self.model = Tokenizer(self.tok.model)
        self.model.pre_tokenizer = pre_tokenizers.Split("\n", "removed")
        self.chars = np.array([ord(c) for c in PrefixBpe._byte_chars()], "<u4")
        vocab = self.tok.get_vocab(with_added_tokens=False)
        self.lengths = np.zeros(max(vocab.values()) + 1, np.int64)
        self.lengths[list(vocab.values())] = [len(t) for t in vocab]
        self.known: dict[str, int] = {}
        self.ids, self.ends = np.zeros(0, "<u4"), np.zeros(1, np.int64)
        self.met = np.zeros(0, np.int64)  # batches that had a piece, of late

    def _cut(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the pieces of all texts start, and which texts must go to the library whole."""
        if data.max() < 0x80:
            kind = self.kinds[:0x80].take(data)
        else:
            points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
            width = 1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)
            kind = np.repeat(self.kinds.take(points), width)
        begins = offsets[:-1][np.diff(offsets) > 0]
        starts = np.empty(len(data), bool)
        starts[0] = True
        np.not_equal(kind[1:], kind[:-1], out=starts[1:])
        starts[begins] = True
        # of white space before something else the last one stands alone, or a blank is the first of what follows
        space = kind == SPACE
        ends = space[:-1] & ~space[1:]
        ends[begins[begins > 0] - 1] = False
        ends = np.flatnonzero(ends)
        starts[ends] = True
        starts[ends[data[ends] == 32] + 1] = False
        self._contractions(data, offsets, starts)
        whole = np.full(len(offsets) - 1, not self.cuts)
        odd = kind == ODD
        odd[:-1] |= (data[:-1] == ord("<")) & (data[1:] == ord("|"))
        if odd.any():
            whole[np.searchsorted(offsets, np.flatnonzero(odd), "right") - 1] = True
        return starts, whole

    @staticmethod
    def _contractions(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray) -> None:
        """Cut 's 't 're 've 'm 'll 'd off what follows, where a piece starts with them."""
        at = np.flatnonzero((data == ord("'")) & starts)
        if not len(at):
            return
        left = offsets[np.searchsorted(offsets, at, "right")] - at  # bytes to the end of the text
        one, two = (np.where(left > k, data[np.minimum(at + k, len(data) - 1)], 0) for k in (1, 2))
        size = np.where(np.isin(one, list(b"stmd")), 2, 0)
        for x, y in (b"re", b"ve", b"ll"):
            size[(one == x) & (two == y)] = 3
        at, size, left = at[size > 0], size[size > 0], left[size > 0]
        starts[at + 1] = False
        starts[(at + size)[size < left]] = True

    def _forget(self) -> None:
        keep = np.sort(np.argsort(-self.met, kind="stable")[: CACHE_PIECES // 2])
        words, sizes = list(self.known), np.diff(self.ends)[keep]
        self.known = {words[k]: i for i, k in enumerate(keep.tolist())}
        self.ids = _runs(self.ids, self.ends[keep], sizes)
        self.ends, self.met = np.append(0, np.cumsum(sizes)), self.met[keep] >> 1

    def _library(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after another, and their numbers.

        The file's model gets the pieces as the pre-tokenizer hands them on, a character for each byte, many to a
        text.  Its tokens cover them character by character, so their lengths tell which belong to a piece.
        """
        data, offsets = utf8(pieces)
        chars = np.insert(self.chars.take(data), offsets[1:], 10)
        edges = offsets + np.arange(len(offsets))
        edges = edges[np.append(np.arange(0, len(pieces), JOINED), len(pieces))].tolist()
        texts = [chars[x : y - 1].tobytes().decode("utf-32-le") for x, y in zip(edges, edges[1:], strict=False)]
        ids = np.concatenate([np.array(e.ids, "<u4") for e in self.model.encode_batch_fast(texts, add_special_tokens=False)])
        covered = np.append(0, np.cumsum(self.lengths.take(ids)))
        ends = np.searchsorted(covered, offsets)
        if ends[-1] != len(ids) or (covered[ends] != offsets).any():
            raise ValueError("the tokenizer's ids do not cover its pieces")
        return ids, np.diff(ends)

    def _places(self, pieces: pa.Array) -> np.ndarray:
        """The place of each piece among those remembered."""
        distinct = pieces.dictionary_encode()
        words = distinct.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > CACHE_PIECES:
            self._forget()
        place = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        unmet = np.flatnonzero(place < 0)
        if len(unmet):
            new = [words[k] for k in unmet.tolist()]
            place[unmet] = np.arange(len(self.known), len(self.known) + len(new))
            self.known.update(zip(new, place[unmet].tolist(), strict=True))
            ids, sizes = self._library(distinct.dictionary.take(pa.array(unmet)))
            self.ids, self.ends = np.append(self.ids, ids), np.append(self.ends, self.ends[-1] + np.cumsum(sizes))
            self.met = np.append(self.met, np.zeros(len(new), np.int64))
        self.met[place] += 1
        return place.take(distinct.indices.to_numpy())

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by end_id, and their numbers by text; null is empty."""
        data, offsets = utf8(texts)
        n = len(offsets) - 1
        if not len(data):
            return np.full(n, end_id, "<u4"), np.ones(n, np.int64)
        starts, whole = self._cut(data, offsets)
        at = np.flatnonzero(starts)
        # pieces, whole texts and end ids are runs of one store, in the order of the texts
        runs = np.searchsorted(at, offsets)
        extra, special = [np.array([end_id], "<u4")], np.flatnonzero(whole)
        if len(special):
            keep = np.repeat(~whole, np.diff(runs))
            found = self.tok.encode_batch_fast([data[offsets[i] : offsets[i + 1]].tobytes().decode() for i in special], add_special_tokens=False)
            extra += [np.array(e.ids, "<u4") for e in found]
            edges = np.append(at, len(data))
            low, high = edges[:-1][keep], edges[1:][keep]
            pieces = pa.array([data[x:y].tobytes().decode() for x, y in zip(low, high, strict=True)], pa.large_string())
            runs = np.append(0, np.cumsum(np.where(whole, 0, np.diff(runs))))
        else:
            edges = np.append(at, len(data))
            pieces = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(edges), pa.py_buffer(data))
        place = self._places(pieces)
        first, size = self.ends.take(place), self.ends.take(place + 1) - self.ends.take(place)
        base = len(self.ids)
        lengths = np.array([len(x) for x in extra])
        beyond = base + np.cumsum(lengths) - lengths
        # before a text's end id stands, for a whole text, its run of the store
        where = np.append(runs[1:][special], runs[1:])
        order = np.argsort(np.append(2 * special, 2 * np.arange(n) + 1), kind="stable")
        put = np.append(np.arange(1, len(extra)), np.zeros(n, np.int64))[order]
        first = np.insert(first, where[order], beyond[put])
        size = np.insert(size, where[order], lengths[put])
        ids, ends = _runs(np.concatenate([self.ids, *extra]), first, size), np.cumsum(size)
        # the end id is the last run of each text
        last = runs[1:] + np.arange(n) + np.cumsum(whole)
        return ids, np.diff(ends[last], prepend=0)


_LOADED: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def _write_file(batches: Iterable[pa.RecordBatch], tokenizer: str, folder: str, end_id: int) -> Iterator[tuple]:
    """Write the documents of a partition to one file; gives its row of the list."""
    system, path = file_system(folder)
    out, texts, size, waiting, docs, sizes, total = None, [], 0, [], [], [], 0

    def encode():
        nonlocal texts, size
        ids, counts = pieces(tokenizer).encode(pa.concat_arrays([x.cast(pa.large_string()) for x in texts]), end_id)
        sizes.extend(counts.tolist())
        waiting.append(ids)
        texts, size = [], 0

    def write(blocks):
        for b in blocks:
            out.write(struct.pack("<I", len(b)) + b)

    for batch in batches:
        if not batch.num_rows:
            continue
        if out is None:
            system.create_dir(path, recursive=True)
            name = f"{path}/tokens-{uuid.uuid4().hex}.bin"
            out = system.open_output_stream(name, compression=None)
            out.write(MAGIC)
        part = batch.column("part")[0].as_py()
        docs += batch.column("doc_id").to_pylist()
        texts.append(batch.column("text"))
        size += texts[-1].nbytes
        if size < TEXT_BYTES:
            continue
        encode()
        held = sum(map(len, waiting))
        if held >= GROUP:
            ids = np.concatenate(waiting)
            whole = held // GROUP * GROUP
            for first in range(0, whole, GROUP):
                write(encode_blocks(ids[first : first + GROUP]))
            waiting, total = [ids[whole:].copy()], total + whole
    if out is None:
        return
    if texts:
        encode()
    ids = np.concatenate(waiting)
    write(encode_blocks(ids))
    none = np.array([d is None for d in docs])
    index = np.array([d or 0 for d in docs], "<i8").tobytes() + none.astype("u1").tobytes() + np.array(sizes, "<u4").tobytes()
    packed = zlib.compress(index, 1)
    out.write(struct.pack("<I", 0) + packed + struct.pack("<QQI", len(docs), len(packed), zlib.crc32(packed)) + MAGIC)
    out.close()
    yield part, name.rsplit("/", 1)[1], len(docs), total + len(ids)


LIST_SCHEMA = "part long, name string, n_docs long, n_tokens long"


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text, append ``end_id`` to each document, and write the ids in
    ascending order of id_col to files in ``folder``, one for each range of documents.

    Returns the list of files (part, name, n_docs, n_tokens, first); ``first`` is the
    number of ids in the files before.  A null or empty text is a document of the end id
    alone; null ids come first; rows that share an id follow one another ordered by text;
    no documents give no files.  A task that is run again writes a file of another name,
    and only files in the list count.  Ids must be below 65,536.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # by id alone: the driver samples the keys of a range sort
    ranged = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    ranged = ranged.withColumn("part", F.spark_partition_id().cast("long"))

    def run(batches):
        for row in _write_file(batches, tokenizer, folder, end_id):
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names=["part", "name", "n_docs", "n_tokens"])

    files = materialize(map_arrow(ranged, run, LIST_SCHEMA), "token-files")
    # one row for each range partition
    before = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_tokens")
    return files.withColumn("first", before)


def read_file(system, path: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, Iterator[np.ndarray]]]:
    """Index of a file (ids, null flags, sizes) and a stream of its blocks' ids."""
    with system.open_input_file(path) as f:
        end = f.size()
        f.seek(end - 28)
        n, size, crc = struct.unpack("<QQI", f.read(20))
        if f.read(8) != MAGIC:
            raise ValueError(f"{path} is not a token file")
        f.seek(end - 28 - size)
        packed = f.read(size)
        if zlib.crc32(packed) != crc:
            raise ValueError(f"the index of {path} does not match its checksum")
        index = zlib.decompress(packed)
        ids = np.frombuffer(index, "<i8", n)
        null = np.frombuffer(index, "u1", n, 8 * n).astype(bool)
        sizes = np.frombuffer(index, "<u4", n, 9 * n).astype(np.int64)

        def stream():
            f.seek(len(MAGIC))
            while k := struct.unpack("<I", f.read(4))[0]:
                yield _decode_block(f.read(k))

        yield ids, null, sizes, stream()


def read_tokens(files: DataFrame, folder: str) -> DataFrame:
    """Documents of the listed files: (doc_id, start, n_tokens, ids), ids as little-endian
    unsigned 32-bit integers and start the number of ids before the document."""
    spark: SparkSession = files.sparkSession
    prepare(spark)
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
    ])

    def run(batches):
        system, path = file_system(folder)
        for batch in batches:
            for name, first in zip(batch.column("name").to_pylist(), batch.column("first").to_pylist(), strict=True):
                for ids, null, sizes, blocks in read_file(system, f"{path}/{name}"):
                    yield from _documents(ids, null, sizes, blocks, first)

    # files are dealt out one by one: each is a task's worth of work
    tasks = files.select("name", "first").repartition(max(1, files.count()), "name")
    return map_arrow(tasks, run, schema)


def _documents(ids, null, sizes, blocks, first) -> Iterator[pa.RecordBatch]:
    ends = np.cumsum(sizes)
    starts = ends - sizes
    at, have, done = 0, np.zeros(0, "<u4"), 0
    for part in blocks:
        have = np.concatenate([have, part])
        upto = int(np.searchsorted(ends, done + len(have), side="right"))
        for lo in range(at, upto, 512):
            hi = min(lo + 512, upto)
            raw = [have[starts[i] - done : ends[i] - done].astype("<u4").tobytes() for i in range(lo, hi)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[lo:hi].astype(np.int64), mask=null[lo:hi]), pa.array(starts[lo:hi] + first), pa.array(sizes[lo:hi]), pa.array(raw, pa.binary())],
                names=["doc_id", "start", "n_tokens", "ids"],
            )
        if upto > at:
            have, done, at = have[ends[upto - 1] - done :], int(ends[upto - 1]), upto
