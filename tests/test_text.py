"""Strip and word split agree with Python semantics."""

import re
import sys

from pyspark.sql import functions as F

from pairloom.functions.text import split_words, strip_text


def test_strip_matches_python_on_whitespace_code_points(spark):
    ws = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    samples = [w + "a b" + w for w in ws] + [w * 3 for w in ws] + [" x ", "  ", "", "x"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i int, s string")
    got = {r.i: r.t for r in df.select("i", strip_text("s").alias("t")).collect()}
    for i, s in enumerate(samples):
        assert got[i] == s.strip(), (hex(ord(s[0])) if s else "empty")


def test_strip_is_linear_in_inner_spaces(spark):
    import time

    df = spark.range(1).select(F.concat(F.lit("a"), F.repeat(F.lit(" "), 1_000_000), F.lit("b  ")).alias("s"))
    df.select(F.length(strip_text("s"))).collect()
    began = time.time()
    assert df.select(F.length(strip_text("s")).alias("n")).first().n == 1_000_002
    assert time.time() - began < 5


def test_word_split_matches_python_regex(spark):
    samples = [
        "Hello, world!! It's 3.5 o'clock...",
        "[CLS] token [SEP]",
        "naïve café — déjà vu; x_y 42",
        "  spaced   out  ",
        "über-straße 12,5 %",
        "",
    ]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i int, s string")
    got = {r.i: list(r.w) for r in df.select("i", split_words("s").alias("w")).collect()}
    pat = re.compile(r"\w+|[^\w\s]+")
    for i, s in enumerate(samples):
        assert got[i] == pat.findall(s)
