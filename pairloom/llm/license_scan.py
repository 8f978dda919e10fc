"""License scans by sparse TF-IDF, with inheritance from directories (operator 1).

Every line of every text, and every window of words as long as the statement, is compared
with license statements by the cosine of TF-IDF vectors, weighted by the number of texts
that hold each word.  A text whose licensed lines are a large share of it is a licence file of its
directory; a text without a license of its own takes that of the nearest ancestor directory
with a licence file.  DataFrame functions only.
"""

from __future__ import annotations

import math
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import join_small, materialize

#: License statements by their SPDX name; a parameter of the scan.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "MIT": "Released under the MIT License",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "Reserved": "All rights reserved",
}
#: Further statements by their SPDX name, compared as those above.
HEADERS = [
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("Apache-2.0", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    *((f"GPL-{v}.0", f"This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version {v} of the License") for v in (2, 3)),
    *((f"LGPL-{v}", f"you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version {v} of the License") for v in ("2.1", "3.0")),
]
#: Titles and SPDX tags, in which one other word names another license: all must agree.
EXACT_COSINE = 0.99
TITLES = [
    ("MIT", "MIT License"), ("MIT", "The MIT License"), ("MIT", "The MIT License (MIT)"), ("ISC", "ISC License"),
    ("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-3-Clause", "BSD 3-Clause License"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"), ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"), ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"), ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International Public License"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International Public License"),
    *((k, f"SPDX-License-Identifier: {k}") for k in (
        "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-NC-4.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0")),
]
LEAST_COSINE = 0.7
FILE_SHARE = 0.3
WORD = r"[a-z0-9]+(?:\.[0-9]+)*"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
UNIT = 1000  # weights are whole thousandths, so sums do not depend on their order


def license_texts() -> dict[str, str]:
    """Full licence texts by their SPDX name."""
    return {f.name.removesuffix(".txt"): f.read_text("utf-8") for f in sorted((Path(__file__).parent / "licenses").glob("*.txt"))}


def words_of(text: Column) -> Column:
    """Words of a text in lower case."""
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def word_counts(texts: DataFrame, text_col: str) -> DataFrame:
    """(word, n): the number of texts that each word is in, over all texts; the empty word
    is in each."""
    words = F.concat(F.array_distinct(words_of(F.coalesce(F.col(text_col), F.lit("")))), F.array(F.lit("")))
    return materialize(texts.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n")), "license-counts")


def term_weights(counts: DataFrame, vocabulary: list[str]) -> tuple[dict[str, int], int]:
    """Weight of each word of the templates, and the number of texts."""
    wanted = counts.sparkSession.createDataFrame([(w,) for w in ["", *vocabulary]], "word string")
    df = {r["word"]: r["n"] for r in counts.join(F.broadcast(wanted), "word").collect()}
    n = df.get("", 0)
    return {w: round(math.log((1 + n) / (1 + df.get(w, 0))) * UNIT) + 1 for w in vocabulary}, n


def weighted(terms: DataFrame, counts: DataFrame, n: int) -> DataFrame:
    """``terms`` with the weight of their column ``word``, from its count in all texts."""
    wanted = counts.join(terms.select("word").distinct(), "word", "left_semi")
    weight = (F.round(F.log((1.0 + n) / (1 + F.col("n"))) * UNIT) + 1).cast("long")
    # written, so that the join with a word of very many rows can be split
    return terms.join(materialize(wanted.select("word", weight.alias("weight")), "license-weights"), "word")


def telling_words(weights: dict[str, int], vectors: dict[str, dict[str, int]], least: float) -> list[str]:
    """Words without which no line reaches the least cosine.

    A line of other words only has a cosine of at most the share of the template's
    length that those words make up, so the lightest words are left out while that share
    stays below the least cosine for every template.
    """
    left_out: set[str] = set()
    for word in sorted(weights, key=lambda w: (weights[w], w)):
        trial = left_out | {word}
        share = max(math.sqrt(sum(v * v for t, v in x.items() if t in trial) / sum(v * v for v in x.values())) for x in vectors.values())
        if share >= least - 1e-9:
            break
        left_out = trial
    return sorted(set(weights) - left_out)


def _tokens(text: Column) -> Column:
    """Words of a text in order, each with its line, place in the line, the line's words and bytes."""
    lines = F.transform(F.split(text, "\n"), lambda x: F.struct(words_of(x).alias("words"), F.octet_length(x).alias("bytes")))
    return F.flatten(F.transform(lines, lambda x, i: F.transform(x["words"], lambda w, k: F.struct(
        w.alias("word"), i.alias("line"), k.alias("place"), F.size(x["words"]).alias("of"), x["bytes"].alias("bytes")))))


def _units() -> Column:
    """Windows of the template's length and whole lines that hold a telling word, as
    (start, size, whole), each once: that of its first telling word.

    A line of more than twice the template's words is judged by its windows alone.
    """
    n, length = F.size("tokens"), F.col("length")

    def unit(start, size, whole):
        return F.struct(start.cast("int").alias("start"), size.cast("int").alias("size"), F.lit(whole).alias("whole"))

    def of(z):
        low = F.greatest(z["before"] + 1, z["at"] - length + 1, F.lit(0))
        high = F.greatest(F.least(z["at"], n - length), F.lit(0))
        windows = F.when(low <= high, F.transform(F.sequence(low, high), lambda s: unit(s, F.least(length, n), False))).otherwise(F.array().cast("array<struct<start:int,size:int,whole:boolean>>"))
        token = F.get(F.col("tokens"), z["at"])
        first = z["at"] - token["place"]
        line = F.when((z["before"] < first) & (token["of"] <= 2 * length + 1), F.array(unit(first, token["of"], True)))
        return F.concat(windows, F.coalesce(line, F.array().cast("array<struct<start:int,size:int,whole:boolean>>")))

    before = F.concat(F.array(F.lit(-1)), F.col("places"))
    pairs = F.transform("places", lambda p, k: F.struct(p.alias("at"), F.get(before, k).alias("before")))
    return F.flatten(F.transform(pairs, of))


def statement_matches(
    texts: DataFrame, id_col: str, text_col: str, statements: list[tuple[str, str, float]], counts: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(id, license, score) of each statement found, and (id, covered): the bytes of what is found.

    ``statements`` holds (license, text, least cosine).  They are compared with windows of
    their own length, inside lines and across them, and with whole lines.  A line that is found as a whole counts with all its bytes, a
    window from its first to its last word of the statement, each line's bytes shared
    evenly by its words; of windows that overlap the best counts.
    """
    spark = texts.sparkSession
    split = [(k, re.findall(WORD, v.lower())) for k, v, _ in statements]
    vocabulary = sorted({w for _, ws in split for w in ws})
    weights, n = term_weights(counts, vocabulary)
    vectors = [{w: ws.count(w) * weights[w] for w in ws} for _, ws in split]
    telling = [telling_words({w: weights[w] for w in x}, {"": x}, c) for x, (_, _, c) in zip(vectors, statements, strict=True)]
    any_ = sorted({w for ws in telling for w in ws})
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = texts.select(F.col(id_col).alias("id"), text.alias("text")).where(F.col("id").isNotNull() & F.arrays_overlap(words_of(F.col("text")), _strings(any_)))
    docs = docs.select("id", F.xxhash64("text").alias("digest"), F.monotonically_increasing_id().alias("row"), _tokens(F.col("text")).alias("tokens"))
    # written, for the numbers of rows and so that the words are taken once
    docs = materialize(docs, "license-tokens")
    at = F.transform("tokens", lambda t, i: F.struct(t["word"].alias("word"), i.alias("at")))
    docs = docs.withColumn("told", F.filter(at, lambda t: t["word"].isin(any_)))
    # as long as the statements
    terms = spark.createDataFrame(
        [(i, k, len(ws), t, {w: (v * weights[w], weights[w] ** 2) for w, v in x.items()}, sum(v * v for v in x.values()), c)
         for i, ((k, ws), x, t, (_, _, c)) in enumerate(zip(split, vectors, telling, statements, strict=True))],
        "statement int, license string, length int, telling array<string>, terms map<string,struct<dot:long,own:long>>, template long, least double",
    )
    found = docs.join(F.broadcast(terms), F.arrays_overlap(F.transform("told", lambda t: t["word"]), F.col("telling")))
    places = F.transform(F.filter("told", lambda t: F.array_contains("telling", t["word"])), lambda t: t["at"])
    found = found.withColumn("places", places).withColumn("units", F.array_distinct(_units()))

    def summed(words, field):
        return F.aggregate(words, F.lit(0).cast("long"), lambda s, t: s + F.coalesce(F.try_element_at("terms", t["word"])[field], F.lit(0).cast("long")))

    taken = F.transform("units", lambda u: F.struct(u["start"].alias("start"), u["whole"].alias("whole"), F.slice("tokens", u["start"] + 1, u["size"]).alias("words")))
    sums = F.transform(taken, lambda u: F.struct(u["start"].alias("start"), u["whole"].alias("whole"), u["words"].alias("words"), summed(u["words"], "dot").alias("dot"), summed(u["words"], "own").alias("known")))
    # the statement's words alone give a bound on the cosine
    able = F.filter(sums, lambda u: u["dot"] >= (F.col("least") - 1e-6) * F.sqrt(u["known"].cast("double")) * F.sqrt(F.col("template").cast("double")))
    found = found.select("id", "digest", "row", "statement", "license", "template", "least", "terms", F.explode(able).alias("u"))
    found = found.select(*[c for c in found.columns if c != "u"], "u.start", "u.whole", "u.dot", F.col("u.words").alias("part")).where("dot > 0")
    size = F.size("part")
    known = F.transform("part", lambda t: F.try_element_at("terms", t["word"]).isNotNull())
    first = F.when(F.col("whole"), 0).otherwise(F.array_position(known, True) - 1).cast("int")
    last = F.when(F.col("whole"), size - 1).otherwise(size - F.array_position(F.reverse(known), True)).cast("int")
    cover = F.transform(F.slice("part", first + 1, last - first + 1), lambda t, i: F.struct(
        (F.col("start") + first + i).alias("at"), t["line"].alias("line"), t["of"].alias("of"), t["bytes"].alias("bytes")))
    key = ["row", "statement", "start", "whole"]
    units = materialize(found.select("id", "digest", *key, "license", "template", "least", "dot", F.transform("part", lambda t: t["word"]).alias("words"), cover.alias("cover")), "license-units")
    words = materialize(units.select(*key, F.explode("words").alias("word")).groupBy(*key, "word").agg(F.count("*").alias("tf")), "license-terms")
    v = F.col("tf") * F.col("weight")
    norms = weighted(words, counts, n).groupBy(*key).agg(F.sum(v * v).alias("own"))
    score = F.col("dot").cast("double") / (F.sqrt(F.col("own").cast("double")) * F.sqrt(F.col("template").cast("double")))
    scored = units.join(norms, key).withColumn("score", F.round(score, 6)).where(F.col("score") >= F.col("least"))
    scored = materialize(scored.select("id", "digest", *key, "license", "score", "cover"), "license-scored")
    spots = scored.select("id", "digest", *key, "score", F.size("cover").alias("long"), F.explode("cover").alias("c"))
    rank = F.struct("score", "long", -F.col("start"), -F.col("statement"))
    spots = spots.withColumn("top", F.when(F.col("whole"), True).otherwise(rank == F.max(rank).over(Window.partitionBy("row", "whole", "c.at"))))
    counted = spots.groupBy("id", "digest", *key).agg(F.min("top").alias("top"), F.collect_list("c").alias("c")).where("top")
    lines = counted.select("id", "digest", "row", F.explode("c").alias("c")).select("id", "digest", "row", "c.*").distinct()
    lines = lines.groupBy("id", "digest", "row", "line").agg(F.count("*").alias("k"), F.max("of").alias("of"), F.max("bytes").alias("bytes"))
    covered = lines.groupBy("id", "digest", "row").agg(F.sum(F.floor(F.col("bytes") * F.col("k") / F.col("of"))).alias("covered"))
    # rows with one id and text share their lines
    covered = covered.groupBy("id", "digest").agg(F.max("covered").alias("covered")).groupBy("id").agg(F.sum("covered").alias("covered"))
    return scored.select("id", "license", "score"), covered


def document_matches(texts: DataFrame, id_col: str, text_col: str, licenses: dict[str, str], counts: DataFrame, least: float) -> DataFrame:
    """(id, whole, cosine): the licence text that a whole text is most like, if the cosine is
    at least ``least``.

    A text that holds words of less than least**2 of a licence's squared length is
    provably below, so only the others are weighed as a whole.
    """
    spark = texts.sparkSession
    split = {k: re.findall(WORD, v.lower()) for k, v in licenses.items()}
    vocabulary = sorted({w for ws in split.values() for w in ws})
    weights, n = term_weights(counts, vocabulary)
    vectors = {}
    for k, ws in split.items():
        vectors[k] = dict.fromkeys(ws, 0)
        for w in ws:
            vectors[k][w] += weights[w]
    telling = sorted({w for x in vectors.values() for w in telling_words({w: weights[w] for w in x}, {"": x}, least)})
    rows = texts.select(F.col(id_col).alias("id"), words_of(F.coalesce(F.col(text_col), F.lit(""))).alias("words"))
    rows = rows.where(F.col("id").isNotNull() & F.arrays_overlap("words", _strings(telling)))
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "license-documents")
    # both tables are as long as the licence texts
    entries = spark.createDataFrame([(k, w, v) for k, x in vectors.items() for w, v in x.items()], "license string, word string, value long")
    lengths = spark.createDataFrame([(k, sum(v * v for v in x.values())) for k, x in vectors.items()], "license string, length long")
    held = rows.select("row", F.explode(F.array_distinct("words")).alias("word")).join(F.broadcast(entries), "word")
    held = held.groupBy("row", "license").agg(F.sum(F.col("value") * F.col("value")).alias("held")).join(F.broadcast(lengths), "license")
    able = materialize(held.where(F.col("held") >= (least - 1e-6) ** 2 * F.col("length")).select("row", "license", "length"), "license-able")
    words = rows.join(able.select("row").distinct(), "row", "left_semi").select("row", F.explode("words").alias("word"))
    terms = materialize(words.groupBy("row", "word").agg(F.count("*").alias("tf")), "license-document-terms")
    terms = materialize(weighted(terms, counts, n).select("row", "word", (F.col("tf") * F.col("weight")).alias("v")), "license-document-values")
    own = terms.groupBy("row").agg(F.sum(F.col("v").cast("double") * F.col("v")).alias("own"))
    dots = terms.join(F.broadcast(entries), "word").groupBy("row", "license").agg(F.sum(F.col("v").cast("double") * F.col("value")).alias("dot"))
    score = F.round(F.col("dot") / (F.sqrt("own") * F.sqrt(F.col("length").cast("double"))), 6)
    scored = dots.join(able, ["row", "license"]).join(own, "row").withColumn("score", score).where(F.col("score") >= least)
    best = scored.join(rows.select("row", "id"), "row").groupBy("id").agg(F.min(F.struct((-F.col("score")).alias("score"), "license")).alias("b"))
    return best.select("id", F.col("b.license").alias("whole"), (-F.col("b.score")).alias("cosine"))


def license_scan(
    files: DataFrame, id_col: str, dir_col: str, text_col: str = "text", templates: dict[str, str] | None = None,
    least: float = LEAST_COSINE, share: float = FILE_SHARE, licenses: dict[str, str] | None = None,
) -> DataFrame:
    """License of every file.

    ``dir_col`` holds a directory as names joined by "/".  Returns, for each row, id, dir,
    own (best license of the file's lines and windows) with its score, is_file (whether it is a licence
    file: as a whole it is like a licence text, which is then its own license, or licensed
    lines make up at least ``share`` of its bytes), license, and origin
    ("own", the directory it comes from, or null).  Of several lines of a file, and of
    several licence files in a directory, the highest score counts, then the license's
    name.  A null or empty text has no license of its own; a null directory is the root, "",
    which only files in it and files without a nearer licence file take from; a null id
    has no license of its own; rows that share an id share their lines; an empty table gives
    an empty result.  Other columns are not read.
    """
    statements = [(k, v, least) for k, v in (TEMPLATES if templates is None else templates).items()]
    if templates is None:
        statements += [*((k, v, least) for k, v in HEADERS), *((k, v, EXACT_COSINE) for k, v in TITLES)]
    licenses = license_texts() if licenses is None else licenses
    rows = files.select(F.col(id_col).alias("id"), F.coalesce(F.col(dir_col), F.lit("")).alias("dir"), F.coalesce(F.octet_length(text_col), F.lit(0)).alias("size"))
    counts = word_counts(files, text_col)
    matches, covered = statement_matches(files, id_col, text_col, statements, counts)
    whole = document_matches(files, id_col, text_col, licenses, counts, least)
    own = matches.groupBy("id").agg(F.min(F.struct((-F.col("score")).alias("score"), F.col("license"))).alias("b")).join(covered, "id")
    own = own.select("id", "covered", F.col("b.license").alias("own"), (-F.col("b.score")).alias("score"))
    is_file = F.col("whole").isNotNull() | F.coalesce(F.col("covered") >= share * F.col("size"), F.lit(False))
    rows = rows.join(own, "id", "left").join(whole, "id", "left").withColumn("is_file", is_file)
    rows = rows.withColumn("score", F.coalesce("cosine", "score")).withColumn("own", F.coalesce("whole", "own"))
    rows = materialize(rows.select("id", "dir", "own", "score", "is_file"), "license-files")
    held = rows.where("is_file").groupBy("dir").agg(F.min(F.struct(-F.col("score"), F.col("own"))).alias("b")).select(F.col("dir").alias("above"), F.col("b.own").alias("license"))
    # every directory meets its ancestors, not every file
    names = F.split("dir", "/")
    depth = F.when(F.col("dir") == "", 0).otherwise(F.size(names))
    up = F.transform(F.sequence(F.lit(0), depth), lambda d: F.struct(d.alias("depth"), F.array_join(F.slice(names, F.lit(1), d), "/").alias("above")))
    dirs = rows.select("dir").distinct().select("dir", F.explode(up).alias("u")).select("dir", "u.*")
    nearest = dirs.join(held, "above").groupBy("dir").agg(F.max_by(F.struct("license", "above"), "depth").alias("n"))
    # written, so that the join with a directory of very many files can be split
    out = rows.join(materialize(nearest, "license-nearest"), "dir", "left")
    license_ = F.coalesce("own", "n.license")
    origin = F.when(F.col("own").isNotNull(), "own").otherwise(F.col("n.above"))
    return out.select("id", "dir", "own", "score", "is_file", license_.alias("license"), origin.alias("origin"))
