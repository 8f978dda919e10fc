"""Token ids from encoder objects.

An encoder is any object with ``encode(text).ids``, ``get_vocab()`` and ``get_vocab_size()``,
such as a sub-word tokenizer.  It is sent to every worker once and called there on Arrow
batches; rows stay in their partitions.

Of a tokenizer of the tokenizers library that provably cuts every text at its spaces, a worker
calls ``encode`` once for each word between spaces and remembers the ids; any other
encoder is called once for each text.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SpecialIds
from ..functions.text import required
from .vocab import ROLES

#: Words whose ids a worker remembers, beyond which only those are kept that come again; a longer word is not remembered.
WORDS_HELD, LONGEST_HELD = 300_000, 64
#: Words that are encoded in one call, and bytes of texts that are cut into words at once.
TOGETHER, CUT_AT_ONCE = 64, 2 << 20

#: Normalisers that neither look nor join across a space, and leave it a space.
_NORMALIZERS = ("NFC", "NFD", "Lowercase")
#: Pre-tokenizers that drop white space and cut the text there.
_CUTTERS = ("Whitespace", "WhitespaceSplit", "BertPreTokenizer")
#: A class or escape of a pattern that no space is in, or plain characters.
_SPACELESS = r"(?:\\p\{[LN]\}|\[(?:\\p\{[LN]\})+\]|\[\^\\s(?:\\p\{[LN]\})*\]|['A-Za-z0-9])\+?"


def cuts_at_spaces(encoder) -> bool:
    """Whether ``encoder`` is a tokenizer of the tokenizers library of which every step is known to
    treat the words between spaces (U+0020) alone, so that a text has the ids of its words in a row."""
    try:
        from tokenizers import Tokenizer
    except ImportError:
        return False
    if type(encoder) is not Tokenizer or encoder.truncation or encoder.padding or encoder.num_special_tokens_to_add(False):
        return False
    spec = json.loads(encoder.to_str())

    def steps(name, inner):
        step = spec[name]
        return [] if step is None else step[inner] if step["type"] == "Sequence" else [step]

    def normalises(step):
        if step["type"] == "Replace":
            return step["pattern"] == {"Regex": "\\s+"} and step["content"] == " "
        return step["type"] in _NORMALIZERS

    def cuts(step):
        if step["type"] != "Split":
            return step["type"] in _CUTTERS
        # only matches of a pattern are kept, and none of its matches can hold or look at a space
        pattern = step["pattern"].get("Regex", "")
        return step["behavior"] == "Removed" and step["invert"] and bool(re.fullmatch(f"(?:{_SPACELESS})+(?:\\|(?:{_SPACELESS})+)*", pattern))

    pre = steps("pre_tokenizer", "pretokenizers")
    rest = all(x["type"] == "ByteLevel" and not x["add_prefix_space"] and not x["use_regex"] for x in pre[1:])
    added = all(
        len(t["content"].split()) == 1 and t["content"] == t["content"].strip() and not (t["lstrip"] or t["rstrip"] or t["single_word"])
        for t in spec["added_tokens"]
    )
    model = spec["model"]
    whole = all(map(normalises, steps("normalizer", "normalizers"))) and bool(pre) and cuts(pre[0]) and rest and added
    return whole and spec["post_processor"] is None and model["type"] in ("BPE", "WordPiece", "WordLevel") and not model.get("dropout")


def seam(contents: list[str]) -> str | None:
    """One of the strings of added tokens that is found as itself wherever it stands between two texts
    that do not hold it: no other, and not itself, can begin in the text before and end in it."""
    for m in contents:
        begins = [m[:k] for k in range(1, len(m))]
        others = [t for t in contents if t != m]
        if not any(m in t or t.endswith(tuple(begins)) for t in others) and not any((b + m).startswith(m) for b in begins):
            return m
    return None


def by_words(encoder):
    """A function that starts a worker's memory of words: given the encoder, it gives a function from an
    Arrow array of texts to their ids in a row and how many each has, put together from the ids of words between spaces.

    The words of some texts that are not remembered are encoded together, with an added token between
    them, at which the library cuts a text before all else.  What it gives needs nothing of this package.
    """
    added = json.loads(encoder.to_str())["added_tokens"]
    # one that is looked for after normalising might change there
    between = None if any(t["normalized"] for t in added) else seam([t["content"] for t in added])
    edge = None if between is None else encoder.token_to_id(between)
    held, longest, together, at_once = WORDS_HELD, LONGEST_HELD, TOGETHER, CUT_AT_ONCE

    def start(own):
        import os

        import numpy as np
        import pyarrow.compute as pc

        # tasks share the cores already
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        known, before = {}, {}

        def encode(words):
            joined = [w for w in words if between is not None and between not in w]
            for low in range(0, len(joined), together):
                some = joined[low : low + together]
                # the library's plain batch call makes no offsets
                (found,) = own.encode_batch_fast([between.join(some)])
                ids = np.array(found.ids, np.int64)
                edges = np.flatnonzero(ids == edge).tolist()
                raw, starts = ids.tobytes(), [0, *[8 * e + 8 for e in edges]]
                known.update(zip(some, [raw[s : 8 * e] for s, e in zip(starts, [*edges, len(ids)], strict=True)], strict=True))
            for w in words:
                if w not in known:
                    known[w] = np.array(own.encode(w).ids, np.int64).tobytes()

        def put_together(texts):
            nonlocal known, before
            cut = pc.split_pattern(texts, " ")
            coded = cut.flatten().dictionary_encode()
            words, place = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
            new = [w for w in words if w not in known]
            known.update([(w, before[w]) for w in new if w in before])
            encode([w for w in new if w not in before])
            found = [known[w] for w in words]
            for w in new:
                if len(w) > longest:
                    del known[w]
            if len(known) > held:
                known, before = {}, known
            values = np.frombuffer(b"".join(found), np.int64)
            sizes = np.fromiter(map(len, found), np.int64, len(found)) // 8
            first, size = (np.cumsum(sizes) - sizes)[place], sizes[place]
            ends = np.append(0, np.cumsum(size))
            ids = values[np.arange(ends[-1]) + np.repeat(first - ends[:-1], size)]
            return ids, np.diff(ends[np.append(0, np.cumsum(pc.list_value_length(cut).to_numpy()))])

        def all_ids(texts):
            ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
            ids, counts, low = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
            while low < len(texts):
                first = int(ends[low - 1]) if low else 0
                high = max(low + 1, int(np.searchsorted(ends, first + at_once, "right")))
                for all_of, of_some in zip((ids, counts), put_together(texts.slice(low, high - low)), strict=True):
                    all_of.append(of_some)
                low = high
            return np.concatenate(ids), np.concatenate(counts)

        return all_ids

    return start


def encode_texts(rows: DataFrame, encoder, key_cols: list[str], max_tokens: int | None = None) -> DataFrame:
    """``key_cols`` and ``ids: array<bigint>``, what ``encoder.encode(text).ids`` gives for each
    row's ``text``, the first ``max_tokens`` of them if set.  An empty text is encoded like
    any other; a NULL text ends the job with an error."""
    shared = rows.sparkSession.sparkContext.broadcast({"encoder": encoder})
    start = by_words(encoder) if cuts_at_spaces(encoder) else None

    def run(batches):
        import numpy as np
        import pyarrow as pa

        own = shared.value  # lives as long as the worker, from task to task
        if start and "ids" not in own:
            own["ids"] = start(own["encoder"])

        def by_text(texts):
            ids = [own["encoder"].encode(t).ids for t in texts.to_pylist()]
            return np.array([i for x in ids for i in x], np.int64), np.array([*map(len, ids)], np.int64)

        for batch in batches:
            ids, counts = (own["ids"] if start else by_text)(batch.column("_text"))
            if max_tokens is not None:
                kept = np.minimum(counts, max_tokens)
                ids = ids[np.arange(len(ids)) - np.repeat(np.cumsum(counts) - counts, counts) < np.repeat(kept, counts)]
                counts = kept
            ends = pa.array(np.append(0, np.cumsum(counts)), pa.int32())
            keep = [batch.column(c) for c in key_cols]
            yield pa.RecordBatch.from_arrays([*keep, pa.ListArray.from_arrays(ends, pa.array(ids))], names=[*key_cols, "ids"])

    x = rows.select(*key_cols, required("text", "text").alias("_text"))
    schema = ", ".join(f"`{c}` {x.schema[c].dataType.simpleString()}" for c in key_cols)
    return x.mapInArrow(run, f"{schema}, ids array<bigint>")


def encoder_vocab(rows: DataFrame, encoder) -> DataFrame:
    """``(token, id, n)`` of the encoder's vocabulary; nothing is counted, so ``n`` is 0."""
    entries = sorted((int(i), t) for t, i in encoder.get_vocab().items())
    return rows.sparkSession.createDataFrame([(t, i, 0) for i, t in entries], "token string, id bigint, n bigint")


def encoder_special_ids(encoder) -> SpecialIds:
    """Ids that the encoder's vocabulary gives the five special tokens; a missing one raises."""
    vocab = encoder.get_vocab()
    missing = sorted(t for t in ROLES.values() if t not in vocab)
    if missing:
        raise ValueError(f"the encoder's vocabulary lacks {missing}")
    return SpecialIds(**{role: int(vocab[token]) for role, token in ROLES.items()})
