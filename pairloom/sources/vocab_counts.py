"""Token counts of a corpus of files, kept up to date file by file.

Counts are stored by input file, so they can be added and taken away: an update
lists the files, counts those that are new or changed, and corrects the totals by these counts and by
what the files gone or changed had before.  Files that stayed are not opened.

A generation folder holds the counts of the files counted in it, the list of all files with
the generation that holds their counts, and the totals; a one-row table, written last, names the
generation in force.  An update that stops half-way leaves a folder that nothing names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, PrepConfig
from ..functions.text import split_words, strip_text
from ..functions.word_split import counted_words
from ..operators.vocab import SplitFn, build_vocab
from .vocab_store import StaleVocabularyError, _exists, _params


def _file_key(path: Column, encoded: bool) -> Column:
    """One spelling for a file's path, as listed and as rows tell it."""
    path = F.regexp_replace(path, "^file:/+", "file:/")
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))) if encoded else path


class VocabCounts:
    """Counts under ``path`` of the tokens of ``lines``, an array of the lines of a row.

    A file is known by its path, length and modification time.  ``split_name`` names the word
    split in the record; counts made with another one, or with other settings, are refused.
    """

    def __init__(self, spark: SparkSession, path: str, lines: Column, cfg: PrepConfig = DEFAULT, split_fn: SplitFn = split_words, split_name: str | None = None):
        self.spark, self.base, self.lines, self.cfg, self.split_fn = spark, path.rstrip("/"), lines, cfg, split_fn
        self.params = _params(cfg, split_name or getattr(split_fn, "__qualname__", repr(split_fn)))
        #: Files that the last update opened.
        self.files_read: list[str] = []

    def _generation(self) -> str | None:
        if not _exists(self.spark, f"{self.base}/meta/_SUCCESS"):
            return None
        meta = self.spark.read.parquet(f"{self.base}/meta").first()
        if meta["params"] != self.params:
            raise StaleVocabularyError(f"counts at {self.base} were made with other settings")
        return meta["folder"]

    def _table(self, generation: str, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.base}/{generation}/{name}")

    def _count(self, files: list[str]) -> DataFrame:
        x = self.spark.read.parquet(*files).select(_file_key(F.col("_metadata.file_path"), True).alias("file"), self.lines.alias("_lines"))
        # the key is made before lines are: once a row
        x = x.select("file", F.explode("_lines").alias("text")).select("file", strip_text("text").alias("text")).where("text <> ''")
        if self.split_fn is split_words:
            return counted_words(x, "file").groupBy("file", "token").agg(F.sum("n").alias("n"))
        return x.select("file", F.explode(self.split_fn(F.col("text"))).alias("token")).groupBy("file", "token").agg(F.count(F.lit(1)).alias("n"))

    def update(self, corpus: str) -> DataFrame:
        """``(token, n)`` over the Parquet files that now lie under ``corpus``."""
        spark, before, after = self.spark, self._generation(), f"gen-{uuid.uuid4().hex}"
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(corpus)
        listed = listed.select(_file_key(F.col("path"), False).alias("file"), "length", F.unix_micros("modificationTime").alias("modified"))
        old = self._table(before, "files") if before else spark.createDataFrame([], "file string, length bigint, modified bigint, folder string")
        same = ["file", "length", "modified"]
        files = listed.join(old, same, "left").select(*same, F.coalesce("folder", F.lit(after)).alias("folder"))
        files.write.parquet(f"{self.base}/{after}/files")
        files = self._table(after, "files")
        # names of files, as every scan of them holds on the driver
        self.files_read = sorted(r["file"] for r in files.where(F.col("folder") == after).select("file").collect())
        counted = "file string, token string, n bigint"
        new = self._count(self.files_read) if self.files_read else spark.createDataFrame([], counted)
        new.write.parquet(f"{self.base}/{after}/counts")
        new = self._table(after, "counts").select("token", "n")
        gone = old.join(files, same, "left_anti").select("file", "folder")
        parts = [new]
        if before:
            parts.append(self._table(before, "total"))
            # the counts of a file lie in the folder it was counted for
            for r in gone.select("folder").distinct().collect():
                own = gone.where(F.col("folder") == r["folder"]).select("file")
                parts.append(self._table(r["folder"], "counts").join(own, "file", "left_semi").select("token", (-F.col("n")).alias("n")))
        every = parts[0]
        for p in parts[1:]:
            every = every.unionByName(p)
        below = F.raise_error(F.lit("the counts of a file that is gone are not in the totals")).cast("bigint")
        total = every.groupBy("token").agg(F.sum("n").alias("n")).where("n <> 0").select("token", F.when(F.col("n") < 0, below).otherwise(F.col("n")).alias("n"))
        total.write.parquet(f"{self.base}/{after}/total")
        record = spark.createDataFrame([(after, self.params)], "folder string, params string")
        record.coalesce(1).write.mode("overwrite").parquet(f"{self.base}/meta")
        return self._table(after, "total")

    def vocab(self, corpus: str) -> DataFrame:
        """``(token, id, n)`` of the files that now lie under ``corpus``."""
        return build_vocab(self.update(corpus), self.cfg)
