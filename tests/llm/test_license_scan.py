import math
import random
import re

from pyspark.sql import functions as F

from pairloom.llm import license_scan as ls

APACHE, MIT, GPL = (ls.TEMPLATES[k] for k in ("Apache-2.0", "MIT", "GPL-3.0"))


def scan(spark, rows):
    files = spark.createDataFrame([(i, d, t, "x", "y") for i, d, t in rows], "id long, dir string, text string, license string, word string")
    return {r.id: r for r in ls.license_scan(files, "id", "dir").collect()}


def test_lines_files_and_nearest_ancestor(spark, prose):
    rows = [
        (1, "a", APACHE), (2, "a/b", prose(50, 1)), (3, "a/b/c", MIT + "."), (4, "a/b/c/d", prose(50, 2)), (5, "a/x", prose(60, 3) + "\n" + GPL.upper() + ".\n" + prose(60, 4)),
        (6, "z", prose(40, 5)), (7, "ab", prose(40, 6)), (8, "a/x", None), (9, "a/b/c", ""), (10, None, prose(9, 1)), (None, "a", "text"), (11, "a/b", prose(5000, 7)),
        (12, "q", APACHE), (13, "q", MIT), (14, "q/r", "none"), (15, "a/y", "licensed under the sun"),
    ]
    got = scan(spark, rows)
    assert [got[i].own for i in (1, 3, 5)] == ["Apache-2.0", "MIT", "GPL-3.0"]
    assert [got[i].is_file for i in (1, 3, 5)] == [True, True, False]
    assert {i: got[i].license for i in (2, 4, 6, 7, 8, 9, 10, None, 11, 15)} == {
        2: "Apache-2.0", 4: "MIT", 6: None, 7: None, 8: "Apache-2.0", 9: "MIT", 10: None, None: "Apache-2.0", 11: "Apache-2.0", 15: "Apache-2.0"}
    assert (got[4].origin, got[2].origin, got[5].origin, got[6].origin) == ("a/b/c", "a", "own", None)
    assert got[14].license == "Apache-2.0"  # equal scores: the license's name decides


def test_root_and_repeated_rows(spark):
    files = spark.createDataFrame([(1, None, MIT), (1, None, MIT), (2, "deep/er", "text")], "id long, dir string, text string")
    rows = ls.license_scan(files, "id", "dir").collect()
    assert sorted((r.id, r.license, r.origin) for r in rows) == [(1, "MIT", "own"), (1, "MIT", "own"), (2, "MIT", "")]


def test_embedded_wrapped_and_prefixed_headers(spark):
    common = "it was as the copyright 2020 by jane see file for more"
    rows = [(i, "p", f"{common} w{i} x{i % 7}") for i in range(400)]
    cases = {
        1000: ("It was released under the MIT License.", "MIT"),
        1001: ("Released under the MIT License as it was.", "MIT"),
        1002: ("It was all rights reserved.", "Reserved"),
        1003: ("Copyright (c) 2020 by Jane Doe. All rights reserved. See file.", "Reserved"),
        1004: ("# it was w1 w2\n# Licensed under the Apache\n# License, Version 2.0\n# see file", "Apache-2.0"),
        1005: (" * This work is licensed under\n *\n * the GNU General Public License,\n * version 3, see file for more", "GPL-3.0"),
        1006: ("w1 w2 w3 " * 300 + MIT + " w4 w5" * 300, "MIT"),
        1007: ("it was licensed by the file", None),
    }
    got = scan(spark, rows + [(i, f"d{i}", t) for i, (t, _) in cases.items()])
    assert {i: got[i].own for i in cases} == {i: k for i, (_, k) in cases.items()}
    assert all(got[i].score >= 0.99 for i in range(1000, 1007))
    assert got[1000].is_file and not got[1006].is_file  # one long line counts with the header's share


def test_licence_texts_titles_and_tags(spark, prose):
    texts = ls.license_texts()
    rows = [(i, "p", prose(40, i) + " the software is of this and to in as copyright") for i in range(300)]
    cases = [(f"Copyright (c) 2021 Jane Doe\n\n{texts[k]}\nsee also the web page", k) for k in texts]
    rows += [(1000 + i, f"t{i}", t) for i, (t, _) in enumerate(cases)] + [(2000 + i, f"t{i}/src", prose(30, i)) for i in range(len(cases))]
    lines = [("# SPDX-License-Identifier: MIT", "MIT"), ("/* SPDX-License-Identifier: GPL-3.0-or-later */", "GPL-3.0"), ("SPDX-License-Identifier: Zlib", None), ("MIT License", "MIT"),
             ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991", "GPL-2.0"), ("the mit and the license of the software", None),
             ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files", "MIT")]
    rows += [(3000 + i, f"u{i}", prose(60, 500 + i) + "\n" + t + "\n" + prose(60, 600 + i)) for i, (t, _) in enumerate(lines)]
    got = scan(spark, rows)
    assert [(got[1000 + i].own, got[1000 + i].is_file) for i in range(len(cases))] == [(k, True) for _, k in cases]
    assert [got[2000 + i].license for i in range(len(cases))] == [k for _, k in cases]
    assert [got[3000 + i].own for i in range(len(lines))] == [k for _, k in lines]
    assert not any(got[i].is_file for i in [*range(300), *range(3000, 3000 + len(lines))])


def test_no_files(spark):
    assert scan(spark, []) == {}


def test_left_out_words_cannot_reach_the_least_cosine():
    weights = {"the": 100, "under": 900, "license": 5000, "mit": 8000}
    vectors = {"A": {"the": 100, "license": 5000, "under": 900}, "B": {"mit": 8000, "the": 100}}
    telling = ls.telling_words(weights, vectors, 0.7)
    assert "license" in telling and "mit" in telling and "the" not in telling


def test_every_written_stage_is_native(spark, make_docs, prose, monkeypatch):
    plans, write = [], ls.materialize

    def recorded(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(ls, "materialize", recorded)
    files = make_docs([(i, prose(5, i) + "\n" + MIT, "s") for i in range(5)]).withColumn("dir", F.lit("a/b"))
    plans.append(ls.license_scan(files, "doc_id", "dir")._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 8
    assert not any(k in plan for k in ("Python", "Pandas", "Arrow") for plan in plans)


def brute(rows):
    """(own, score) of each row, with every window and line compared with every statement."""
    words = {i: [re.findall(ls.WORD, x.lower()) for x in (t or "").split("\n")] for i, _, t in rows}
    flat = {i: [w for x in lines for w in x] for i, lines in words.items()}
    df = {}
    for ws in flat.values():
        for w in set(ws):
            df[w] = df.get(w, 0) + 1

    def vector(ws):
        return {w: ws.count(w) * (round(math.log((1 + len(rows)) / (1 + df.get(w, 0))) * ls.UNIT) + 1) for w in set(ws)}

    def cosine(x, y):
        if not x:
            return 0.0
        dot = sum(v * y.get(w, 0) for w, v in x.items())
        return round(dot / math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values())), 6)

    statements = [*((k, v, ls.LEAST_COSINE) for k, v in [*ls.TEMPLATES.items(), *ls.HEADERS]), *((k, v, ls.EXACT_COSINE) for k, v in ls.TITLES)]
    statements = [(k, re.findall(ls.WORD, v.lower()), c) for k, v, c in statements]
    vectors = [vector(ws) for _, ws, _ in statements]
    texts = {k: vector(re.findall(ls.WORD, v.lower())) for k, v in ls.license_texts().items()}
    out = {}
    for i, ws in flat.items():
        best = []
        for (k, own, least), y in zip(statements, vectors, strict=True):
            size = len(own)
            units = [ws[s : s + size] for s in range(max(1, len(ws) - size + 1))] + [x for x in words[i] if len(x) <= 2 * size + 1]
            best += [(-c, k) for c in (cosine(vector(u), y) for u in units) if c >= least]
        whole = [(-c, k) for c, k in ((cosine(vector(ws), y), k) for k, y in texts.items()) if c >= ls.LEAST_COSINE]
        found = min(whole or best, default=None)
        out[i] = (found[1], -found[0]) if found else (None, None)
    return out


def test_own_licenses_equal_brute_force(spark, prose):
    rng = random.Random(6)
    statements = [*ls.TEMPLATES.values(), *(v for _, v in ls.HEADERS), *(v for _, v in ls.TITLES)]
    rows = [(0, "a", None), (1, "a", ""), (2, "a", "\n \n")]
    for i in range(3, 60):
        ws = rng.choice(statements).split()
        kind = i % 6
        if kind == 0:  # some words lost or replaced
            ws = [w if rng.random() < 0.85 else rng.choice(["", "the", "software"]) for w in ws]
        elif kind == 1:  # words between
            ws = [x for w in ws for x in ([w, rng.choice(["of", "license", "x9"])] if rng.random() < 0.15 else [w])]
        elif kind == 2:  # wrapped
            ws = [w + rng.choice(["", "", "\n"]) for w in ws]
        elif kind == 3:  # out of order
            ws = rng.sample(ws, len(ws))
        elif kind == 4:  # a second one
            ws = [*ws, *rng.choice(statements).split()[:6]]
        rows.append((i, "a", f"{prose(rng.choice([0, 3, 25]), i)} {' '.join(ws)}{rng.choice([' ', chr(10)])}{prose(rng.choice([0, 9]), 900 + i)}"))
    for j, text in enumerate(ls.license_texts().values()):
        lines = text.split("\n")
        rows += [(100 + 2 * j, "t", text[: len(text) // 2]), (101 + 2 * j, "t", "\n".join(x for x in lines if rng.random() < 0.6))]
    want = brute([(i, d, (t or None) and t[:6000]) for i, d, t in rows])
    got = scan(spark, [(i, d, (t or None) and t[:6000]) for i, d, t in rows])
    assert {i: got[i].own for i in want} == {i: k for i, (k, _) in want.items()}
    assert all(s is None or abs(got[i].score - s) < 2e-6 for i, (_, s) in want.items())
