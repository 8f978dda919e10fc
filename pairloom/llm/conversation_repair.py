"""Cheapest repair of conversation structure by grammar-compressed dynamic programming.

Every turn is a symbol: what its role begins with, and whether it must go (blank, or said
before) or is cut off.  Edits turn a conversation's symbols into ``(s?(ua)+)?``: keep, change the
role, delete, insert.  Between turns the automaton of that pattern has four states, so a
symbol is a 4 x 4 matrix of cheapest costs, with inserts before the turn counted in, and a
sequence is their min-plus product.

Re-Pair finds the pairs of symbols that are frequent over all conversations and gives each a
symbol of its own; a rule's matrix is made once, from those of its halves, and every
conversation that holds the rule uses it.  The edits behind an entry are a rope: a rule keeps
only the state between its halves.  No edit string of a sequence is a proper prefix of another
(all end with the edit of the last turn), so among equal costs the ASCII-least of a product
follows from the ranks of its halves' strings, and ropes are written out only for the way taken.

Turns are dealt in ranges of (conversation, turn, role, digest), so a conversation of any
length is cut into runs; runs are evaluated on their own and their matrices multiplied.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Stages, materialize
from .common import map_arrow, prepare

WHITE = " \t\n\x0b\x0c\r"
ROLES = ("s", "u", "a")  # any other initial is 3
INSERTED = {2: "user", 3: "assistant"}
#: Costs of the edits, and of leaving a turn that is cut off.
RELABEL, DELETE, INSERT, LEFT_CUT = 1, 2, 5, 5
#: Symbols of turns: 0 must go, 1 + role, 5 + role if cut off.
TERMINALS = 9
#: States: nothing yet, after s, after u, after a.  The states that may end are 0 and 3.
NEXT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
ENDS = (0, 3)
NEVER = 1 << 40

#: Rules of the grammar, rounds of finding them (a job each), and the least share of all symbols
#: that a pair must make up.  They change the work, not the results.
RULES = 128
ROUNDS = 8
LEAST_SHARE = 1 / 4096

REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _inserts(state: int) -> list[tuple[int, str]]:
    """States that up to two inserts lead to, with their string."""
    out = [(state, "")]
    for _ in range(2):
        last, text = out[-1]
        out.append((NEXT[("a" if last == 2 else "u", last)], text + "I"))
    return out


def _terminal(symbol: int) -> dict[tuple[int, int], tuple[int, str]]:
    """Cheapest (cost, edits) from state to state over one turn and inserts before it."""
    role, cut = (symbol - 1) % 4, LEFT_CUT if symbol > 4 else 0
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for p in range(4):
        for mid, text in _inserts(p):
            base = INSERT * len(text)
            ways = [(mid, DELETE, "D")]
            if symbol:
                if role < 3 and (ROLES[role], mid) in NEXT:
                    ways.append((NEXT[(ROLES[role], mid)], cut, "K"))
                ways += [(NEXT[(r, mid)], RELABEL + cut, "R") for r in "ua" if (r, mid) in NEXT]
            for q, cost, edit in ways:
                best[p, q] = min(best.get((p, q), (NEVER, "")), (base + cost, text + edit))
    return best


def _dense(order: np.ndarray) -> np.ndarray:
    """Ranks of the entries of each matrix, equal for equal entries."""
    flat = order.reshape(len(order), 16)
    at = np.argsort(flat, axis=1, kind="stable")
    up = np.take_along_axis(flat, at, 1)
    rank = np.zeros_like(flat)
    np.put_along_axis(rank, at, np.cumsum(np.diff(up, axis=1, prepend=up[:, :1]) > 0, axis=1), 1)
    return rank.reshape(order.shape)


def _product(cost_a, rank_a, cost_b, rank_b):
    """Min-plus products of stacks of matrices: costs, ranks of the strings, and the state
    between the factors that gives the cheapest, then ASCII-least, string."""
    key = (cost_a * 256 + rank_a * 16)[:, :, :, None] + (cost_b * 256 + rank_b)[:, None, :, :]
    mid = key.argmin(2)
    cost = np.minimum(np.take_along_axis(key, mid[:, :, None, :], 2)[:, :, 0, :] >> 8, NEVER)
    n, p, r = np.ogrid[: len(mid), :4, :4]
    return cost, _dense(rank_a[n, p, mid] * 16 + rank_b[n, mid, r]), mid.astype(np.uint8)


IDENTITY = np.where(np.eye(4, dtype=bool), 0, NEVER).astype(np.int64)


@dataclass
class Grammar:
    """Pairs of symbols by rule, and the matrices of all symbols."""

    rules: list[tuple[int, int]] = field(default_factory=list)

    def __post_init__(self):
        self.strings = [_terminal(s) for s in range(TERMINALS)]
        n = TERMINALS + len(self.rules)
        self.cost = np.full((n, 4, 4), NEVER, np.int64)
        self.rank = np.zeros((n, 4, 4), np.int64)
        self.mid = np.zeros((n, 4, 4), np.uint8)
        for s, best in enumerate(self.strings):
            order = {t: i for i, t in enumerate(sorted({t for _, t in best.values()}))}
            for (p, q), (cost, text) in best.items():
                self.cost[s, p, q], self.rank[s, p, q] = cost, order[text]
        for i, (a, b) in enumerate(self.rules):
            s = TERMINALS + i
            parts = _product(self.cost[a : a + 1], self.rank[a : a + 1], self.cost[b : b + 1], self.rank[b : b + 1])
            self.cost[s], self.rank[s], self.mid[s] = (x[0] for x in parts)

    def compress(self, symbols: np.ndarray) -> np.ndarray:
        """``symbols`` with every rule applied, oldest first; -1 keeps sequences apart."""
        for i, (a, b) in enumerate(self.rules):
            at = np.flatnonzero((symbols[:-1] == a) & (symbols[1:] == b))
            if a == b and len(at):  # of overlapping pairs every other one counts
                run = np.cumsum(np.diff(at, prepend=at[0] - 2) > 1)
                first = at[np.r_[True, np.diff(run) > 0]][run - run[0]]
                at = at[(at - first) % 2 == 0]
            if len(at):
                symbols = symbols.copy()
                symbols[at] = TERMINALS + i
                symbols = np.delete(symbols, at + 1)
        return symbols

    def write_out(self, symbol: int, p: int, q: int, out: list[str]) -> None:
        """The rope's string, without recursion."""
        stack = [(symbol, p, q)]
        while stack:
            s, p, q = stack.pop()
            if s < TERMINALS:
                out.append(self.strings[s][p, q][1])
            else:
                mid = int(self.mid[s, p, q])
                a, b = self.rules[s - TERMINALS]
                stack += [(b, mid, q), (a, p, mid)]


class Solved:
    """A sequence's product, with what its string needs."""

    def __init__(self, grammar: Grammar, symbols: np.ndarray):
        self.grammar, self.symbols = grammar, symbols
        self.mids: list[np.ndarray] = []
        if len(symbols):
            first = symbols[:1]
            self.cost, self.rank = grammar.cost[first], grammar.rank[first]
        else:
            self.cost, self.rank = IDENTITY[None], np.zeros((1, 4, 4), np.int64)
        for s in symbols[1:]:
            self.cost, self.rank, mid = _product(self.cost, self.rank, grammar.cost[s : s + 1], grammar.rank[s : s + 1])
            self.mids.append(mid[0])

    def string(self, p: int, q: int) -> str:
        ways = []
        for s, mid in zip(self.symbols[:0:-1], self.mids[::-1]):
            m = int(mid[p, q])
            ways.append((int(s), m, q))
            q = m
        if len(self.symbols):
            ways.append((int(self.symbols[0]), p, q))
        out: list[str] = []
        for way in reversed(ways):
            self.grammar.write_out(*way, out)
        return "".join(out)


def cheapest(runs: list[Solved]) -> tuple[int, str]:
    """Cost and edits of a conversation from its runs in order."""
    cost, rank, mids = runs[0].cost, runs[0].rank, []
    for run in runs[1:]:
        cost, rank, mid = _product(cost, rank, run.cost, run.rank)
        mids.append(mid[0])
    ends = []
    for q in range(4):
        tail = next(text for state, text in _inserts(q) if state in ENDS)
        ends.append((int(cost[0, 0, q]) + INSERT * len(tail), int(rank[0, 0, q]), tail, q))
    total, _, tail, q = min(ends)
    parts = [tail]
    for run, mid in zip(runs[:0:-1], mids[::-1]):
        m = int(mid[0, q])
        parts.append(run.string(m, q))
        q = m
    parts.append(runs[0].string(0, q))
    return total, "".join(reversed(parts))


# -- symbols of turns -----------------------------------------------------------


def _with_faults(rows: DataFrame, stages: Stages) -> DataFrame:
    """Turns in order, without their texts: (conv, turn, initial, part, mid, symbol, fault).

    ``mid`` numbers them in the order of (conversation, turn, role, digest), nulls first.
    A turn that is not the first of its role and text in a conversation is joined
    on ``mid``, which is unique, so that a conversation with very many turns is no skewed key.
    """
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    bare = F.rtrim(text, F.lit(WHITE))
    narrow = rows.select(
        "conv", "turn", role.alias("role"), F.unhex(F.md5(text)).alias("digest"),
        (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"), "empty",
        F.monotonically_increasing_id().alias("tie"),
    )
    order = ["conv", "turn", "role", "digest", "tie"]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = narrow.repartitionByRange(n, *order).sortWithinPartitions(*order).drop("tie")
    ordered = stages.write(ordered.withColumn("mid", F.monotonically_increasing_id()), "ordered-turns")
    said = ordered.where("not blank and not empty").groupBy("conv", "role", "digest").agg(F.min("mid").alias("mid"))
    x = ordered.join(said.select("mid", F.lit(True).alias("first")), "mid", "left")
    fault = F.when(F.col("empty"), "e").when(F.col("blank"), "b").when(F.col("first").isNull(), "d").when(F.col("cut"), "t").otherwise("-")
    initial = F.substring("role", 1, 1)
    x = x.select("conv", "turn", initial.alias("initial"), F.shiftright("mid", 33).alias("part"), "mid", fault.alias("fault"))
    place = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    symbol = F.when(F.col("fault").isin("b", "d"), 0).when(F.col("fault") == "t", place + 5).otherwise(place + 1)
    return x.withColumn("symbol", symbol.cast("int"))


RUN = "conv long, part long, symbols binary, head string, tail string, illegal long, blank long, duplicate long, truncated long, low long, high long, turns long, first long, last long"


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each run of one conversation within a range."""
    names = [c.split(" ")[0] for c in RUN.split(", ")]

    def finished(key, s):
        return [*key, bytes(s["symbols"]), s["head"], s["tail"], s["illegal"], s["b"], s["d"], s["t"], s["low"], s["high"], s["turns"], s["low"], s["high"]]

    def table(done):
        schema = pa.schema([(c, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[t]) for c, t in (x.split(" ") for x in RUN.split(", "))])
        return pa.RecordBatch.from_arrays([pa.array(col, f.type) for col, f in zip(zip(*done), schema)], names=names)

    key, s, done = None, None, []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv", "part", "turn", "initial", "fault", "symbol")]
        for conv, part, turn, initial, fault, symbol in zip(*columns):
            if key != (conv, part):
                if key is not None:
                    done.append(finished(key, s))
                key = conv, part
                s = {"symbols": bytearray(), "head": None, "tail": None, "illegal": 0, "b": 0, "d": 0, "t": 0, "low": None, "high": None, "turns": 0}
            if fault == "e":
                continue
            s["symbols"].append(symbol)
            if s["head"] is None:
                s["head"] = initial
            elif s["tail"] + initial not in ("su", "ua", "au"):
                s["illegal"] += 1
            s["tail"] = initial
            if fault in s:
                s[fault] += 1
            if turn is not None:  # turns come in order
                s["low"] = turn if s["low"] is None else s["low"]
                s["turns"] += s["high"] != turn
                s["high"] = turn
        if len(done) >= 1024:
            yield table(done)
            done = []
    if key is not None:
        done.append(finished(key, s))
    if done:
        yield table(done)


def _joined(column: pa.Array) -> np.ndarray:
    """Symbols of all sequences, with -1 after each."""
    return np.concatenate([x for b in column.to_pylist() for x in (np.frombuffer(b, np.uint8).astype(np.int16), [-1])] or [np.zeros(0, np.int16)]).astype(np.int16)


def learn(runs: DataFrame) -> Grammar:
    """Re-Pair over all sequences.  Each round counts the pairs of neighbours everywhere and
    makes rules of the most frequent that share no symbol; the driver sees the counts by pair
    of symbols, at most (9 + RULES) ** 2."""
    grammar = Grammar()
    for _ in range(ROUNDS):
        now = grammar

        def pairs(batches, now=now):
            count = np.zeros((TERMINALS + len(now.rules),) * 2, np.int64)
            symbols = 0
            for batch in batches:
                seq = now.compress(_joined(batch.column("symbols")))
                symbols += int((seq >= 0).sum())
                at = np.flatnonzero((seq[:-1] >= 0) & (seq[1:] >= 0))
                np.add.at(count, (seq[at], seq[at + 1]), 1)
            a, b = np.nonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1, *a], pa.int32()), pa.array([-1, *b], pa.int32()), pa.array([symbols, *count[a, b]], pa.int64())], names=["a", "b", "n"]
            )

        found = map_arrow(runs.select("symbols"), pairs, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n")).collect()
        total = sum(r["n"] for r in found if r["a"] < 0)
        used: set[int] = set()
        new = []
        for r in sorted(found, key=lambda r: (-r["n"], r["a"], r["b"])):
            if r["a"] >= 0 and r["n"] >= max(2, LEAST_SHARE * total) and not used & {r["a"], r["b"]}:
                new.append((r["a"], r["b"]))
                used |= {r["a"], r["b"]}
        new = new[: RULES - len(grammar.rules)]
        if not new:
            break
        grammar = Grammar([*grammar.rules, *new])
    return grammar


def _reports(grammar: Grammar):
    """Reports of whole conversations from their runs in order."""
    kinds = {"long": pa.int64(), "string": pa.string()}
    schema = pa.schema([("conv", pa.int64()), *[(c.split(" ")[0], kinds[c.split(" ")[1]]) for c in REPORT.split(", ")]])
    known: dict[bytes, Solved] = {}

    def solved(symbols: bytes) -> Solved:
        out = known.get(symbols)
        if out is None:
            out = Solved(grammar, grammar.compress(np.frombuffer(symbols, np.uint8).astype(np.int16)))
            if len(symbols) <= 64 and len(known) < 65_536:
                known[symbols] = out
        return out

    def report(conv, runs):
        low = high = tail = None
        turns, illegal, faults = 0, 0, [0, 0, 0]
        for r in runs:
            illegal += r["illegal"]
            if r["head"] is not None:
                illegal += tail is not None and tail + r["head"] not in ("su", "ua", "au")
                tail = r["tail"]
            if r["low"] is not None:
                turns += r["turns"] - (high == r["first"])
                low, high = r["low"] if low is None else low, r["last"]
            faults = [f + r[c] for f, c in zip(faults, ("blank", "duplicate", "truncated"))]
        cost, audit = cheapest([solved(r["symbols"]) for r in runs])
        return [conv, 0 if low is None else high - low + 1 - turns, *faults, illegal, cost, audit]

    def run(batches):
        done = []
        rows = (r for batch in batches for r in batch.to_pylist())
        for conv, runs in groupby(rows, key=lambda r: r["conv"]):
            done.append(report(conv, list(runs)))
            if len(done) >= 1024:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
                done = []
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)

    return run


def _named(rows: DataFrame, empty: bool) -> DataFrame:
    return rows.select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), "role", "text", F.lit(empty).alias("empty")
    )


def repair(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """What is wrong with each conversation and the cheapest edits that mend it.

    ``rows`` has (conv_id, turn, role, text); ``conversations``, if given, lists conv_ids that
    are reported even if no row is left of them: zeros and no edits.  Returns (conv_id, gaps,
    blank, duplicate, truncated, illegal, cost, audit).  ``audit`` has K, R or D for every turn
    and I for every insert, in order; among cheapest edits the ASCII-least.

    A null text or role counts as one space, a null conv_id is a conversation; null turns come
    first and count in no gap.  Turns of one number are ordered by role, then by the MD5 of
    the text; equal rows are all turns.  An empty table gives an empty result.  Texts, however
    long, are read in one pass and not shuffled.  Other columns are ignored, whatever
    their names.  A conversation may have any number of turns: its turns are dealt to many
    tasks, and the last step reads one byte a turn, as much as the audit it returns.
    """
    spark = rows.sparkSession
    prepare(spark)
    own = _named(rows, False)
    if conversations is not None:
        none = conversations.select(F.col("conv_id"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
        own = own.unionByName(_named(none.distinct(), True))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with Stages(spark) as stages:
        turns = _with_faults(own, stages).repartition(n, "part").sortWithinPartitions("part", "mid")
        runs = stages.write(map_arrow(turns.drop("mid"), _runs, RUN), "runs")
        grammar = learn(runs)
        whole = runs.repartition(n, "conv").sortWithinPartitions("conv", "part")
        out = materialize(map_arrow(whole, _reports(grammar), f"conv long, {REPORT}"), "conversation-reports")
    return out.withColumnRenamed("conv", "conv_id")


# -- repaired turns ---------------------------------------------------------------


def _edited(header: dict, rows: Iterator[dict]) -> Iterator[tuple[str, str]]:
    """(role, text) of the repaired conversation; ``rows`` are read one by one."""
    state = 0
    for edit in header["audit"]:
        if edit == "I":
            state = NEXT[("a" if state == 2 else "u", state)]
            yield INSERTED[state], ""
            continue
        row = next(rows)
        if edit == "K":
            state = NEXT[(row["role"][0], state)]
            yield row["role"], row["text"]
        elif edit == "R":
            state = NEXT[("a" if state == 2 else "u", state)]
            yield INSERTED[state], row["text"]
    for _ in rows:  # none is left: the audit has an edit for every turn
        raise ValueError("the report does not belong to these rows")


def _side_by_side(rows: DataFrame, report: DataFrame) -> DataFrame:
    """Every conversation's report, then its turns in order: the one shuffle of texts."""
    own = _named(rows, False).select("conv", F.lit(1).alias("kind"), "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    fields = [c.split(" ")[0] for c in REPORT.split(", ")]
    head = report.select(F.col("conv_id").cast("long").alias("conv"), F.lit(0).alias("kind"), *fields)
    both = head.unionByName(own, allowMissingColumns=True)
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return both.repartition(n, "conv").sortWithinPartitions("conv", "kind", "turn", "role", F.unhex(F.md5("text")))


def _conversations(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator[tuple[str, str]]]]:
    rows = (r for batch in batches for r in batch.to_pylist())
    for _, own in groupby(rows, key=lambda r: r["conv"]):
        header = next(own)
        yield header, _edited(header, own)


def repaired_turns(rows: DataFrame, report: DataFrame) -> DataFrame:
    """The repaired conversations: (conv_id, position, role, text), positions from 0."""
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
    names = ["conv_id", "position", "role", "text"]

    def run(batches):
        done = []
        for header, turns in _conversations(batches):
            for at, (role, text) in enumerate(turns):
                done.append((header["conv"], at, role, text))
                if len(done) >= 256:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), kinds)], names=names)
                    done = []
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), kinds)], names=names)

    prepare(rows.sparkSession)
    return map_arrow(_side_by_side(rows, report), run, "conv_id long, position long, role string, text string")


def with_digest(rows: DataFrame, report: DataFrame) -> DataFrame:
    """``report`` with ``repaired_sha256``: of the repaired ``role:text`` lines, joined by
    newlines.  A digest is sequential, so one task streams a conversation, turn by turn."""
    fields = [c.split(" ") for c in REPORT.split(", ")]
    schema = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64() if t == "long" else pa.string()) for c, t in fields], ("repaired_sha256", pa.string())])

    def run(batches):
        done = []
        for header, turns in _conversations(batches):
            digest = hashlib.sha256()
            for at, (role, text) in enumerate(turns):
                digest.update(f"{chr(10) if at else ''}{role}:{text}".encode())
            done.append([header["conv"], *[header[c] for c, _ in fields], digest.hexdigest()])
            if len(done) >= 1024:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
                done = []
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)

    prepare(rows.sparkSession)
    return map_arrow(_side_by_side(rows, report), run, f"conv_id long, {REPORT}, repaired_sha256 string")


# -- damage -------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with planted faults by the CRC of ``conv_id:turn``: of 20, 0 drops the row, 1
    empties its text, 2 removes ``.!?``, 3 repeats it, 4 makes its role user.  Nulls
    are written, and returned in texts and roles, as one space."""

    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(shown("text"), ".!?", "")).otherwise(shown("text"))
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    role = F.when(kind == 4, F.lit("user")).otherwise(shown("role"))
    x = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), times)).alias("_copy"))
    return x.drop("_copy")
