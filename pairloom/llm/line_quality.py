"""Document quality from lines labelled by a conditional random field (operator 2).

A linear-chain CRF labels every line good or bad from features of the line and of its
neighbours.  It is fitted on a bounded sample of labelled documents, each line taking its
document's label.  Forward-backward gives each line's marginal, their mean weighted
by length is the document's raw score, and a logistic curve fitted on the same sample
turns that into a probability.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import map_arrow, mix64, prefix_hash, prepare, slices, utf8

#: Labelled documents that the model is fitted on, at most, and lines of one of them; of a
#: document of more lines a run of so many, placed by a hash of its text, is in the sample.
#: Both bound the driver's memory.
SAMPLE_DOCS = 6_000
SAMPLE_LINES = 400

BASE = 0x9E3779B97F4A7C15
BYTE = np.random.default_rng(20240602).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
KINDS = ("upper", "lower", "digit", "stop", "shout", "bar", "symbol", "high")


def _kinds() -> np.ndarray:
    """Kind of each byte by its position in KINDS; others count as none."""
    out = np.full(256, len(KINDS), np.uint8)
    for k, chars in enumerate((range(65, 91), range(97, 123), range(48, 58), b".,;:'\"()-", b"!?", b"|", b"#$%&*@^~_=+<>/\\{}[]`", range(128, 256))):
        out[list(chars)] = k
    return out


KIND = _kinds()
OWN = ("bias", "length", *KINDS, "word length", "space", "repeated words", "distinct words", "repeated line", "ends in stop", "starts upper", "short")
NEAR = ("upper", "stop", "shout", "bar", "symbol", "repeated words", "repeated line")
FEATURES = (*OWN, *(f"before: {k}" for k in NEAR), "first", *(f"after: {k}" for k in NEAR), "last")


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of the lines that are not empty, their text's row and their bytes."""
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    edge[np.flatnonzero(data == 10)] = True
    newline = np.append(data == 10, True)
    cut = np.unique(np.r_[offsets, np.flatnonzero(data == 10) + 1])
    start, end = cut[:-1], cut[1:].copy()
    end -= newline[end - 1] & (end > start)
    use = end > start
    start, end = start[use], end[use]
    m = len(start)
    row = np.searchsorted(offsets, start, side="right") - 1
    size = (end - start).astype(np.float64)
    kind = KIND[data]
    count = np.zeros((len(KINDS), m))
    for k in range(len(KINDS)):
        run = np.zeros(n + 1, np.int32)
        np.cumsum(kind == k, out=run[1:])
        count[k] = run[end] - run[start]
    inside = ~SPACE[data]
    before = np.r_[False, inside[:-1]]
    after = np.r_[inside[1:], False]
    at = edge[:-1] & inside
    begins = np.flatnonzero(inside & ~before | at)
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    p, down = prefix_hash(BYTE[data], BASE)
    word = mix64((p[ends] - p[begins]) * down[begins])
    first = np.searchsorted(begins, start)
    words = np.searchsorted(begins, end) - first
    same = np.zeros(len(word) + 1, np.int32)
    np.cumsum(np.r_[False, word[1:] == word[:-1]][: len(word)], out=same[1:])
    line_of = np.repeat(np.arange(m), words)
    order = np.lexsort((word, line_of))
    new = np.ones(len(word), bool)
    new[1:] = (word[order][1:] != word[order][:-1]) | (line_of[order][1:] != line_of[order][:-1])
    distinct = np.bincount(line_of[order][new], minlength=m)
    digest = mix64((p[end] - p[start]) * down[start] + size.astype(np.uint64))
    order = np.lexsort((digest, row))
    dup = np.zeros(m, bool)
    twin = (digest[order][1:] == digest[order][:-1]) & (row[order][1:] == row[order][:-1])
    dup[order[1:][twin]] = True
    dup[order[:-1][twin]] = True
    share = count / np.maximum(size, 1)
    some = np.maximum(words, 1)
    own = {
        "bias": np.ones(m), "length": np.log1p(size) / 8, **{k: share[i] for i, k in enumerate(KINDS)},
        "word length": np.log1p(size / some) / 4, "space": (words - 1) / np.maximum(size, 1),
        "repeated words": (same[np.minimum(first + words, len(word))] - same[np.minimum(first + 1, len(word))]) / some,
        "distinct words": distinct / some, "repeated line": dup.astype(float),
        "ends in stop": (kind[end - 1] == 3).astype(float), "starts upper": (kind[start] == 0).astype(float), "short": (size < 20).astype(float),
    }
    out = np.zeros((m, len(FEATURES)), np.float32)
    for i, k in enumerate(OWN):
        out[:, i] = own[k]
    begin = np.r_[True, row[1:] != row[:-1]] if m else np.zeros(0, bool)
    last = np.r_[row[1:] != row[:-1], True] if m else np.zeros(0, bool)
    base = len(OWN)
    for i, k in enumerate(NEAR):
        v = own[k]
        out[1:, base + i] = np.where(begin[1:], 0, v[:-1])
        out[:-1, base + len(NEAR) + 1 + i] = np.where(last[:-1], 0, v[1:])
    out[:, base + len(NEAR)] = begin
    out[:, -1] = last
    return out, row, size


@dataclass
class LineModel:
    """Parameters of the CRF and of the curve from raw scores to probabilities."""

    emission: np.ndarray  # weight of each feature for "good" against "bad"
    transition: np.ndarray  # 2 by 2: score of the step from label to label
    mean: np.ndarray
    scale: np.ndarray
    slope: float
    shift: float
    empty: float  # score of a text without lines

    def good(self, x: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Marginal probability of "good" for each line of texts laid end to end."""
        return marginals((x - self.mean) / self.scale @ self.emission, row, self.transition)[0]

    def score(self, x: np.ndarray, row: np.ndarray, size: np.ndarray, n: int) -> np.ndarray:
        raw, has = self.raw(x, row, size, n)
        return np.where(has, 1 / (1 + np.exp(-(self.slope * raw + self.shift))), self.empty)

    def raw(self, x, row, size, n):
        """Log-odds of the length-weighted mean of the marginals."""
        weight = np.bincount(row, size, n)
        mean = np.bincount(row, size * self.good(x, row), n) / np.maximum(weight, 1)
        mean = np.clip(mean, 1e-4, 1 - 1e-4)
        return np.log(mean / (1 - mean)), weight > 0


def _chains(row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First line and number of lines of each text with lines, longest first."""
    start = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.zeros(0, np.int64)
    length = np.diff(np.r_[start, len(row)])
    order = np.argsort(-length, kind="stable")
    return start[order], length[order]


def marginals(score: np.ndarray, row: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Forward-backward over all chains in step: probability of "good" for each line,
    expected transitions, and the log of the partition functions."""
    start, length = _chains(row)
    emit = np.exp(np.clip(np.stack([np.zeros(len(score)), score], axis=1), -30, 30))
    step = np.exp(transition)
    forward, backward = np.empty_like(emit), np.empty_like(emit)
    log_z = 0.0
    live = np.searchsorted(-length, -np.arange(int(length[0]) if len(length) else 0), side="left")
    for t, n in enumerate(live.tolist()):
        at = start[:n] + t
        a = emit[at] if t == 0 else (forward[at - 1] @ step) * emit[at]
        total = a.sum(1, keepdims=True)
        forward[at] = a / total
        log_z += float(np.log(total).sum())
    pairs = np.zeros((2, 2))
    after = np.ones((len(start), 2))
    for t in range(len(live) - 1, -1, -1):
        n = int(live[t])
        at = start[:n] + t
        more = int(live[t + 1]) if t + 1 < len(live) else 0
        b = np.ones((n, 2))
        if more:
            nxt = emit[at[:more] + 1] * after[:more]
            b[:more] = nxt @ step.T
            joint = forward[at[:more]][:, :, None] * step[None] * nxt[:, None, :]
            pairs += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
            b[:more] /= b[:more].sum(1, keepdims=True)
        backward[at] = b
        after[:n] = b
    both = forward * backward
    return both[:, 1] / both.sum(1), pairs, log_z


def fit(x: np.ndarray, row: np.ndarray, size: np.ndarray, label: np.ndarray, l2: float = 1e-3, rounds: int = 250) -> LineModel:
    """Maximum likelihood with a quadratic penalty, by gradient steps of adaptive size.

    ``label`` has 0 or 1 for each text.  Without both labels every score is the share of
    label 1, or one half without texts.
    """
    n = len(label)
    prior = (float(label.sum()) + 1) / (n + 2)
    width = x.shape[1]
    if not len(row) or label.min() == label.max():
        return LineModel(np.zeros(width), np.zeros((2, 2)), np.zeros(width), np.ones(width), 0.0, float(np.log(prior / (1 - prior))), prior)
    mean, scale = x.mean(0), x.std(0) + 1e-3
    mean[0], scale[0] = 0, 1
    z = (x - mean) / scale
    y = label[row].astype(np.float64)
    same = np.flatnonzero(row[1:] == row[:-1])
    seen = np.zeros((2, 2))
    np.add.at(seen, (label[row[same]], label[row[same + 1]]), 1)
    theta, m1, m2 = np.zeros(width + 4), np.zeros(width + 4), np.zeros(width + 4)
    for i in range(1, rounds + 1):
        p, pairs, _ = marginals(z @ theta[:width], row, theta[width:].reshape(2, 2))
        grad = np.r_[z.T @ (p - y), (pairs - seen).ravel()] / len(y) + l2 * theta
        m1 = 0.9 * m1 + 0.1 * grad
        m2 = 0.99 * m2 + 0.01 * grad * grad
        theta -= 0.1 * (m1 / (1 - 0.9**i)) / (np.sqrt(m2 / (1 - 0.99**i)) + 1e-9)
    model = LineModel(theta[:width], theta[width:].reshape(2, 2), mean, scale, 1.0, 0.0, prior)
    raw, has = model.raw(x, row, size, n)
    model.slope, model.shift = _curve(raw[has], label[has])
    return model


def _curve(raw: np.ndarray, label: np.ndarray, l2: float = 1e-3) -> tuple[float, float]:
    """Slope and shift of the logistic curve, by Newton steps."""
    x, w = np.stack([raw, np.ones(len(raw))], axis=1), np.array([1.0, 0.0])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x / len(x) + l2 * np.eye(2)
        w = w - np.linalg.solve(hess, x.T @ (p - label) / len(x) + l2 * (w - [1.0, 0.0]))
    return max(float(w[0]), 0.05), float(w[1])


LINES = "label int, lines int, sizes binary, features binary"


def _sample_lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for lo, hi in slices(offsets):
            own = offsets[lo : hi + 1]
            x, row, size = line_features(data[own[0] : own[-1]], own - own[0])
            bounds = np.searchsorted(row, np.arange(hi - lo + 1))
            first, last = bounds[:-1].copy(), bounds[1:].copy()
            for i in np.flatnonzero(last - first > SAMPLE_LINES).tolist():
                first[i] += zlib.crc32(data[own[i] : own[i + 1]]) % (last[i] - first[i] - SAMPLE_LINES + 1)
                last[i] = first[i] + SAMPLE_LINES
            runs = list(zip(first.tolist(), last.tolist(), strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array([j - i for i, j in runs], pa.int32()), pa.array([size[i:j].astype("<f8").tobytes() for i, j in runs], pa.binary()),
                 pa.array([x[i:j].astype("<f4").tobytes() for i, j in runs], pa.binary())],
                names=["label", "lines", "sizes", "features"],
            )


def held_out(id_col: Column, folds: int = 3, fold: int = 1) -> Column:
    """Whether the checksum of the id as text falls into the fold kept from training."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == fold, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE_DOCS) -> LineModel:
    """Fit on at most ``sample`` labelled documents outside the held-out fold, those with
    the smallest hash of the id.  Ids with labels that differ, null labels and null ids
    are left out."""
    spark = docs.sparkSession
    prepare(spark)
    one = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    one = one.groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).cast("int").alias("label"), F.max(label_col).cast("int").alias("_most"))
    chosen = one.where("label = _most").orderBy(F.xxhash64("_id"), "_id").limit(sample).select("_id", "label")
    chosen = materialize(chosen, "quality-sample")
    # the sample has a fixed bound, so it may be sent to all
    rows = docs.join(F.broadcast(chosen), F.col(id_col) == F.col("_id")).select("_id", "label", F.col(text_col).alias("_text"))
    # rows that repeat an id count once, by the text with the smallest hash
    rows = rows.groupBy("_id", "label").agg(F.min_by("_text", F.xxhash64("_text")).alias("_text"))
    got = map_arrow(rows.select("label", "_text"), _sample_lines, LINES).collect()
    got.sort(key=lambda r: (bytes(r["features"]), r["label"]))
    label = np.array([r["label"] for r in got], np.int64)
    lines = np.array([r["lines"] for r in got], np.int64)
    x = np.frombuffer(b"".join(r["features"] for r in got), "<f4").reshape(-1, len(FEATURES)).astype(np.float64)
    size = np.frombuffer(b"".join(r["sizes"] for r in got), "<f8")
    return fit(x, np.repeat(np.arange(len(label)), lines), size, label)


def score(docs: DataFrame, model: LineModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score) for every row: the probability of label 1.

    A map over whole texts without a shuffle.  A text that is null, empty or only line
    breaks has the share of label 1 in the sample as its score.  Ids may be null or
    repeated; nothing but the text decides; other columns are not read.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col), F.col(text_col).alias("_text"))

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            scores = np.zeros(batch.num_rows)
            for lo, hi in slices(offsets):
                own = offsets[lo : hi + 1]
                x, row, size = line_features(data[own[0] : own[-1]], own - own[0])
                scores[lo:hi] = model.score(x, row, size, hi - lo)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=[id_col, "score"])

    return map_arrow(rows, run, T.StructType([rows.schema.fields[0], T.StructField("score", T.DoubleType())]))


def accepted(docs: DataFrame, model: LineModel, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is at least ``least``, all columns, in one map."""
    prepare(docs.sparkSession)
    at, names = docs.columns.index(text_col), docs.columns

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(at))
            keep = np.zeros(batch.num_rows, bool)
            for lo, hi in slices(offsets):
                own = offsets[lo : hi + 1]
                x, row, size = line_features(data[own[0] : own[-1]], own - own[0])
                keep[lo:hi] = model.score(x, row, size, hi - lo) >= least
            yield pa.RecordBatch.from_arrays(batch.columns, names=names).filter(pa.array(keep))

    return map_arrow(docs, run, docs.schema)
