"""The composite job: corpus rows to masked, batched training examples.

``Preparation`` holds the stages lazily; each property builds only what is asked for,
and writes what is read more than once.  Pairs, split, batches and totals come from the
narrow sentence index; no vocabulary, token array or example is made for them.
Scalars (vocabulary size, document and example counts) are the only values brought
to the driver.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, PrepConfig, SpecialIds
from ..functions.schedule import tag_position
from ..functions.text import split_words
from ..operators.batches import batch_manifest, epoch_batches, label_examples, resume_from_tag, split_examples, split_sizes, steps_per_epoch
from ..operators.corpus import boundary_flags, clean_lines, number_documents, segment_documents, sentence_lines
from ..operators.encoders import encode_texts, encoder_special_ids, encoder_vocab
from ..operators.examples import apply_mlm, lay_out, to_training_rows, truncate_pairs
from ..operators.pairs import attach_tokens, document_table, nsp_pairs, resolve_partner
from ..operators.scan import Buckets, choose_buckets
from ..operators.vocab import SplitFn, build_vocab, lookup_ids, special_ids, summed_token_counts
from ..session import Stages, default_parallelism, stored_partitioning


class Preparation:
    """Stages of pre-training data preparation over one corpus.

    ``split_fn`` maps a text column to ``array<string>`` words (the
    pluggable tokenizer; built-in regex split by default, any column
    function or ``pandas_udf`` works).

    ``literal_specials``: a special token that stands in a sentence gets its own id
    (``lookup_ids``); counting splits it like any text.

    ``encoder`` replaces word split and vocabulary by an object with ``encode(text).ids``,
    ``get_vocab()`` and ``get_vocab_size()``, whose vocabulary has the five special tokens.

    ``rows``: ``(row_id, text)`` raw corpus rows (plus ``boundary_col`` if
    documents are delimited by explicit marker rows).  ``vocab``: optional
    prebuilt ``(token, id, n)`` with the five special tokens at any ids; by default it is
    built from the cleaned lines of this corpus (headings and short documents included).

    ``close()``, or the end of a ``with`` block, deletes the written stages of this
    run and nothing else.
    """

    def __init__(self, rows: DataFrame, cfg: PrepConfig = DEFAULT, vocab: DataFrame | None = None,
                 boundary_col: str | None = None, vocab_lines: DataFrame | None = None,
                 split_fn: SplitFn = split_words, encoder=None, literal_specials: bool = True):
        self.rows = rows
        self.cfg = cfg
        self.split_fn = split_fn
        self.encoder = encoder
        self.literal_specials = literal_specials
        self._vocab = vocab
        self.boundary_col = boundary_col
        self._vocab_lines = vocab_lines
        self.stages = Stages(rows.sparkSession)

    def close(self) -> None:
        self.stages.close()

    def __enter__(self) -> "Preparation":
        return self

    def __exit__(self, *exc) -> None:
        self.close()

    # -- vocabulary ---------------------------------------------------------
    @cached_property
    def lines(self) -> DataFrame:
        return clean_lines(self.rows)

    @cached_property
    def vocab(self) -> DataFrame:
        if self._vocab is not None:
            return self._vocab
        if self.encoder is not None:
            return encoder_vocab(self.rows, self.encoder)
        src = self._vocab_lines if self._vocab_lines is not None else self.lines
        counts = self.stages.write(summed_token_counts(src, self.split_fn), "token_counts")
        return self.stages.write(build_vocab(counts, self.cfg), "vocab")

    @cached_property
    def vocab_size(self) -> int:
        return self.vocab.count() if self.encoder is None else int(self.encoder.get_vocab_size())

    @cached_property
    def special(self) -> SpecialIds:
        return special_ids(self.vocab) if self.encoder is None else encoder_special_ids(self.encoder)

    # -- documents ----------------------------------------------------------
    @cached_property
    def flags(self) -> DataFrame:
        return boundary_flags(self.rows, self.boundary_col, self.stages.write)

    @cached_property
    def buckets(self) -> Buckets:
        return choose_buckets(self.flags, "row_id", self.cfg)

    @cached_property
    def sentences(self) -> DataFrame:
        """Kept sentences (flat) with text and ``bucket`` partitioning."""
        return segment_documents(self.rows, self.cfg, boundary_col=self.boundary_col, flags=self.flags, buckets=self.buckets)

    @cached_property
    def index(self) -> DataFrame:
        """Kept sentences without text: ``row_id, doc_key, sent_idx, n_sents, bucket, doc_idx``."""
        narrow = segment_documents(self.rows, self.cfg, boundary_col=self.boundary_col, flags=self.flags, buckets=self.buckets, text=False)
        narrow = self.stages.write(narrow, "sentence_index")
        return self.stages.write(number_documents(narrow, self.buckets.bound, self.cfg), "numbered_index")

    @cached_property
    def documents(self) -> DataFrame:
        """``(doc_idx, doc_key, n_sents)`` of kept documents."""
        return document_table(self.index)

    @cached_property
    def n_documents(self) -> int:
        return self.documents.count()

    @cached_property
    def sentence_tokens(self) -> DataFrame:
        """Token ids of sentences, cut to the pair budget before lookup (a side never keeps more than
        ``seq_len - 3`` tokens), stored by range of the order.  Which of them are kept, and where they stand,
        is in the index, so text is neither sorted nor scanned for it."""
        if self.encoder is not None:
            st = encode_texts(self.sentences, self.encoder, ["bucket", "row_id"], self.cfg.pair_budget)
            return self.stages.write_buckets(st, "sentence_tokens", "bucket", self.n_buckets)
        lines = sentence_lines(self.rows, self.buckets, self.boundary_col).repartition(self.n_buckets, "bucket")
        st = lookup_ids(
            lines,
            self.vocab,
            key_cols=["bucket", "row_id"],
            max_tokens=self.cfg.pair_budget,
            split_fn=self.split_fn,
            cfg=self.cfg,
            special=self.special,
            literal_specials=self.literal_specials,
        )
        return self.stages.write_buckets(st.select("bucket", "row_id", "ids"), "sentence_tokens", "bucket", self.n_buckets)

    @property
    def n_buckets(self) -> int:
        """Hash buckets of stored token arrays: as many as the partitions of their lines, so that
        each task writes buckets of its own."""
        return max(1, default_parallelism(self.rows.sparkSession))

    # -- pairs and examples -------------------------------------------------
    @cached_property
    def pairs(self) -> DataFrame:
        """``(example_id, doc_idx, sent_idx, bucket, is_next, b_doc_idx, b_sent_idx, b_id, b_bucket)``."""
        return resolve_partner(nsp_pairs(self.index, self.documents, self.n_documents, self.cfg), self.index)

    @cached_property
    def example_ids(self) -> DataFrame:
        """``(example_id, doc_idx)``: every sentence but the last of its document."""
        a = self.index.filter(F.col("sent_idx") < F.col("n_sents") - 1)
        return a.select(F.col("row_id").alias("example_id"), "doc_idx")

    @cached_property
    def examples(self) -> DataFrame:
        """Unmasked examples, laid out from the truncated pairs (written: every epoch reads them; a
        reader that wants some of the tensors makes no others)."""
        pairs = self.pairs.select("example_id", "doc_idx", "is_next", "bucket", "b_id", "b_bucket")
        x = attach_tokens(pairs, self.sentence_tokens, self.n_buckets)
        with stored_partitioning(self.rows.sparkSession):
            cut = self.stages.write(truncate_pairs(x, self.cfg), "examples")
        return lay_out(cut, self.cfg, special=self.special)

    @cached_property
    def n_examples(self) -> int:
        return self.example_ids.count()

    def masked(self, epoch: int = 0) -> DataFrame:
        return apply_mlm(self.examples, self.vocab_size, epoch, self.cfg, self.special)

    def training_rows(self, epoch: int = 0) -> DataFrame:
        return to_training_rows(self.masked(epoch))

    # -- split and batches ----------------------------------------------------
    @cached_property
    def split(self) -> DataFrame:
        docs, n_docs = None, 0
        if self.cfg.split_by == "document":
            docs = self.documents.select("doc_idx", "doc_key", (F.col("n_sents") - 1).alias("n")).where("n > 0")
            n_docs = self.n_documents
        s = split_examples(self.example_ids, self.n_examples, self.cfg, docs=docs, n_docs=n_docs)
        return self.stages.write(s, "split")

    @cached_property
    def split_labels(self) -> DataFrame:
        """``(example_id, split)`` of the split by example, without ranks: a filter on the
        narrow index, nothing is sorted or written."""
        if self.cfg.split_by != "example":
            raise ValueError("labels without ranks need split_by='example'")
        return label_examples(self.example_ids, self.n_examples, self.cfg)

    def batches(self, first_epoch: int = 0, last_epoch: int | None = None) -> DataFrame:
        return epoch_batches(self.split, self.n_examples, self.cfg, first_epoch, last_epoch, n_train=self.sizes[0])

    def resumed(self, tag: str) -> DataFrame:
        """What a run preloaded from the checkpoint ``tag`` still does."""
        epoch, _ = tag_position(tag, self.steps_per_epoch)
        return resume_from_tag(self.batches(first_epoch=epoch), tag, self.sizes[0], self.cfg)

    def manifest(self) -> DataFrame:
        return batch_manifest(self.split, self.examples, self.n_examples, self.sizes[0], self.cfg, self.special)

    @cached_property
    def sizes(self) -> tuple[int, int]:
        """``(n_train, n_val)``; counted for the document split."""
        if self.cfg.split_by == "example":
            return split_sizes(self.n_examples, self.cfg)
        n_val = self.split.filter(F.col("split") == "val").count()
        return self.n_examples - n_val, n_val

    @property
    def steps_per_epoch(self) -> int:
        return steps_per_epoch(self.sizes[0], self.cfg)

    def totals(self) -> DataFrame:
        """One row: vocabulary size, documents, examples, split sizes, steps."""
        n_train, n_val = self.sizes
        bs = self.cfg.batch_size
        return self.index.agg(
            F.lit(self.vocab_size).cast("bigint").alias("vocab_size"),
            F.count_if(F.col("sent_idx") == 0).cast("bigint").alias("n_documents"),
            F.count(F.lit(1)).cast("bigint").alias("n_sentences"),
            F.count_if(F.col("sent_idx") < F.col("n_sents") - 1).cast("bigint").alias("n_examples"),
            F.lit(n_train).cast("bigint").alias("n_train"),
            F.lit(n_val).cast("bigint").alias("n_val"),
            F.lit(-(-n_train // bs)).cast("bigint").alias("steps_per_epoch"),
            F.lit(-(-n_val // bs)).cast("bigint").alias("val_steps"),
        )
