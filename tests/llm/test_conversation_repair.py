import hashlib
import itertools
import random
import re
import zlib

import pytest

from pairloom.llm import conversation_repair as cr

GOOD = re.compile(r"(s?(ua)+)?")


def turns_of(rows):
    """The rows of one conversation in order, with their fault."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).digest()))
    seen, out = set(), []
    for turn, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((turn, role, text, fault))
    return out


def brute(turns):
    """Cheapest, then ASCII-least, edits, turn by turn."""
    best = {0: (0, "")}  # state -> (cost, edits); states of the pattern, by what was emitted

    def emit(state, initial):
        return {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}.get((state, initial))

    def inserts(table):
        for _ in range(3):
            for state, (cost, text) in list(table.items()):
                for i in "ua":
                    new = emit(state, i)
                    if new is not None:
                        table[new] = min(table.get(new, (10**9, "")), (cost + 5, text + "I"))
        return table

    for _, role, _, fault in turns:
        table = {}
        for state, (cost, text) in inserts(dict(best)).items():
            ways = [(state, 2, "D")]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault else 0
                ways.append((emit(state, role[:1]), more, "K"))
                ways += [(emit(state, i), 1 + more, "R") for i in "ua"]
            for new, price, edit in ways:
                if new is not None:
                    table[new] = min(table.get(new, (10**9, "")), (cost + price, text + edit))
        best = table
    return min(v for s, v in inserts(dict(best)).items() if s in (0, 3))


def apply(turns, audit):
    out, rows = [], iter(turns)
    for e in audit:
        wanted = "assistant" if out and out[-1][0][0] == "u" else "user"
        if e == "I":
            out.append((wanted, ""))
        else:
            _, role, text, _ = next(rows)
            if e != "D":
                out.append((role if e == "K" else wanted, text))
    assert GOOD.fullmatch("".join(r[0] for r, _ in out))
    return out


def expected(conv, rows):
    turns = turns_of(rows)
    numbers = [t[0] for t in turns if t[0] is not None]
    cost, audit = brute(turns)
    pairs = zip([t[1][:1] for t in turns], [t[1][:1] for t in turns[1:]])
    text = "\n".join(f"{r}:{x}" for r, x in apply(turns, audit))
    return (
        conv,
        max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
        *[sum(t[3] == f for t in turns) for f in ("blank", "duplicate", "truncated")],
        sum(a + b not in ("su", "ua", "au") for a, b in pairs),
        cost, audit, hashlib.sha256(text.encode()).hexdigest(),
    )


@pytest.fixture(scope="module")
def make_rows(spark):
    def make(rows):
        return spark.createDataFrame([(*r, 1, "z") for r in rows], "conv_id long, turn long, role string, text string, part int, symbols string").repartition(3)

    return make


def check(make_rows, rows, ids=()):
    df = make_rows(rows)
    ids_df = make_rows([(i, None, None, None) for i in ids]) if ids else None
    report = cr.repair(df, ids_df)
    got = {r["conv_id"]: tuple(r) for r in cr.with_digest(df, report).collect()}
    by = {i: [] for i in ids}
    for conv, *rest in rows:
        by.setdefault(conv, []).append(tuple(rest))
    assert got == {conv: expected(conv, own) for conv, own in by.items()}
    turns = {}
    for r in cr.repaired_turns(df, report).collect():
        turns.setdefault(r["conv_id"], []).append((r["position"], r["role"], r["text"]))
    for conv, own in by.items():
        t = turns_of(own)
        assert [x[1:] for x in sorted(turns.get(conv, []))] == apply(t, brute(t)[1])


def random_rows(n, seed, longest=9):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "u", "", None])
            text = rng.choice(["Hello.", "What?", "so it goes", "", " \n", None, "Well! ", f"own {conv} {turn}.", f"cut {turn}"])
            rows.append((conv, rng.choice([turn, turn, turn + 2, None]), role, text))
    return rows


def test_matches_dynamic_programming_on_random_conversations(make_rows):
    check(make_rows, random_rows(400, 1), ids=[*range(400), 900])


def test_a_long_conversation_is_cut_into_runs(spark, make_rows):
    rng = random.Random(2)
    roles = ["user", "assistant", "system"]
    rows = [(5, t, rng.choice(roles), rng.choice([f"t{t}.", f"t{t}", "again.", ""])) for t in range(700)]
    rows += [(None, t, "user", "same.") for t in range(300)] + [(None, 1, "user", "same.")] * 200
    rows += [(7, t, roles[t % 2], f"{t}.") for t in range(400)] + random_rows(5, 3)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check(make_rows, rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_products_are_the_same_under_any_grammar():
    rng = random.Random(4)
    for rules in ([], [(2, 3)], [(0, 0), (9, 9), (2, 3), (11, 11), (11, 2)], [(2, 2), (9, 2)]):
        g = cr.Grammar(rules)
        plain = cr.Grammar()
        for _ in range(60):
            symbols = rng.choices(range(9), weights=[6, 1, 6, 6, 1, 1, 2, 2, 1], k=rng.randint(0, 14))
            seq = cr.np.array(symbols, cr.np.int16)
            cut = rng.randint(0, len(seq))
            whole = cr.cheapest([cr.Solved(plain, seq)])
            assert cr.cheapest([cr.Solved(g, g.compress(seq))]) == whole
            assert cr.cheapest([cr.Solved(g, g.compress(s)) for s in (seq[:cut], seq[cut:])]) == whole


def test_ties_take_the_least_edits():
    """Every short sequence against all edit strings."""
    role = {1: "s", 2: "u", 3: "a", 4: "x"}
    g = cr.Grammar()
    for symbols in itertools.product([0, 1, 2, 3, 7], repeat=3):
        turns = [(0, role[(s - 1) % 4 + 1] if s else "u", "", "" if 0 < s < 5 else "truncated" if s else "blank") for s in symbols]
        assert cr.cheapest([cr.Solved(g, cr.np.array(symbols, cr.np.int16))]) == brute(turns)


def test_rules_are_learnt_and_compress(spark):
    runs = spark.createDataFrame([(bytes([2, 3] * k),) for k in range(1, 40)] + [(bytes([0] * 50),), (b"",)], "symbols binary")
    g = cr.learn(runs)
    assert (2, 3) in g.rules and (0, 0) in g.rules
    assert len(g.compress(cr.np.array([2, 3] * 32, cr.np.int16))) <= 8


def test_damage(make_rows):
    rows = [(c, t, r, "One. Two! Three?") for c in (None, *range(60)) for t, r in ((None, "user"), (0, None), (1, "assistant"))]
    got = sorted((tuple(r) for r in cr.damaged(make_rows(rows)).collect()), key=str)
    want = []
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if kind == 1 else "One Two Three" if kind == 2 else x
        want += [(c, t, "user" if kind == 4 else r or " ", text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    assert got == sorted(want, key=str)


def test_nothing_and_very_long_texts(make_rows):
    assert cr.repair(make_rows([])).collect() == []
    check(make_rows, [(1, 0, "user", "long " * 200_000 + "."), (1, 1, "assistant", " " * 300_000)], ids=[1, 2, None])
