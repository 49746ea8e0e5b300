"""Conversation structure repair by integer-minimum dynamic programming.

The cheapest edits of a conversation (keep, rerole, delete, insert) are a
shortest path through a directed acyclic graph of (turn, last role).  A path's
weight is one integer: its high digits are the cost, its low digits, of fixed
width, are the letters of the edits at their positions, with zeros behind the
last one.  So the smallest integer is the cheapest path, and of equal costs the
one with the ASCII-least letters; nothing else is ever compared.  Zero padding
is right because paths of equal cost to one node take the same turns: neither's
letters can begin with all of the other's, as the rest would be paid inserts.

Rows are sorted over the whole table and cut into blocks, so one conversation
may be any number of blocks.  Only a conversation of several blocks needs more:
each block's weights from every role to every role shrink to a cost and a rank
among the blocks's own ends, which compose in groups of bounded size, level by
level, up to the conversation and down again to the roles at the cuts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, grouped, map_arrow, staged

# Costs, and the legal neighbours of roles, by initial.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
LEGAL_PAIRS = ("su", "ua", "au")
FAULTS = 20
BLANK, SPACE = r"[^\x20\x09-\x0D]", " \t\n\x0b\x0c\r"

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: The role that can be given to a turn, or inserted, behind a state.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: The state behind a kept turn, by its initial and the state before it.
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ACCEPTED = (START, ASSISTANT)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Inserts that lead from each state to an accepted one.
TAIL = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
#: Letters as digits, in ASCII order; 0 is the padding.
LETTERS = "DIKR"
BITS = 3
D, I, K, R = range(1, 5)  # noqa: E741
BLOCK, GROUP = 1024, 1024

#: A turn as the graph sees it: (initial, must be deleted, truncated).
Turn = tuple[str, bool, bool]


class Weights:
    """Weights of the best paths to every state, for a run of turns entered in one state."""

    def __init__(self, turns: int, start: int):
        self.width = 3 * turns + 2  # a turn's own letter and two inserts before it, or behind the last one
        self.cost_at = BITS * self.width
        self.best: list[int | None] = [None] * 4
        self.length = [0] * 4
        self.best[start] = 0

    def _edge(self, s: int, cost: int, letter: int) -> int:
        return self.best[s] + (cost << self.cost_at) + (letter << (BITS * (self.width - 1 - self.length[s])))

    def _offer(self, best: list, length: list, t: int, w: int, n: int) -> None:
        if best[t] is None or w < best[t]:
            best[t], length[t] = w, n

    def insert(self) -> None:
        """Up to two empty turns; a third would come back to a role that was there."""
        for _ in range(2):
            best, length = list(self.best), list(self.length)
            for s in STATES:
                if self.best[s] is not None:
                    self._offer(best, length, NEXT[s], self._edge(s, INSERT, I), self.length[s] + 1)
            self.best, self.length = best, length

    def take(self, turn: Turn) -> None:
        initial, gone, truncated = turn
        self.insert()
        more = TRUNCATED if truncated else 0
        best: list[int | None] = [None] * 4
        length = [0] * 4
        for s in STATES:
            if self.best[s] is None:
                continue
            n = self.length[s] + 1
            self._offer(best, length, s, self._edge(s, DELETE, D), n)
            if not gone:
                if (s, initial) in KEPT:
                    self._offer(best, length, KEPT[s, initial], self._edge(s, more, K), n)
                self._offer(best, length, NEXT[s], self._edge(s, REROLE + more, R), n)
        self.best, self.length = best, length

    def read(self, t: int) -> tuple[int, str]:
        """(cost, letters) of the best path to a state."""
        cost, low = self.best[t] >> self.cost_at, self.best[t] & ((1 << self.cost_at) - 1)
        digits = format(low, "o").zfill(self.width).rstrip("0") if low else ""
        return cost, digits.translate(_LETTER)


_LETTER = {ord(str(i + 1)): c for i, c in enumerate(LETTERS)}


def solve(turns: list[Turn], start: int = START, end: int | None = None) -> tuple[int, str]:
    """(cost, letters) of the cheapest edits that lead from a role to a role; without ``end``, to a legal end."""
    w = Weights(len(turns), start)
    for t in turns:
        w.take(t)
    if end is None:
        w.insert()
        end = min((t for t in ACCEPTED if w.best[t] is not None), key=lambda t: w.best[t])
    return w.read(end)


def apply(turns: list[Turn], rows: list[tuple[str, str]], letters: str, state: int) -> list[tuple[str, str]]:
    """The repaired (role, text) rows."""
    out, i = [], 0
    for c in letters:
        if c == "D":
            i += 1
            continue
        if c == "K":
            out.append(rows[i])
            state = KEPT[state, turns[i][0]]
        else:
            state = NEXT[state]
            out.append((NAMES[state], rows[i][1] if c == "R" else ""))
        i += c != "I"
    return out


# --- blocks of one conversation -------------------------------------------------
#
# A block's matrix has, from each state to each state, cost * 4 + rank, or -1.
# The rank orders the letters of the paths from one state; they differ before
# either ends, so it also orders whatever is put behind them.

def block_matrix(turns: list[Turn]) -> list[int]:
    out = []
    for s in STATES:
        w = Weights(len(turns), s)
        for t in turns:
            w.take(t)
        found = [None if w.best[t] is None else w.read(t) for t in STATES]
        order = sorted(f[1] for f in found if f is not None)
        out += [-1 if f is None else f[0] * 4 + order.index(f[1]) for f in found]
    return out


def compose(a: list[int], b: list[int]) -> list[int]:
    """The matrix of two neighbouring runs."""
    out = []
    for s in STATES:
        row: list[int | None] = []
        for t in STATES:
            ways = [
                ((a[4 * s + m] >> 2) + (b[4 * m + t] >> 2) << 4) + ((a[4 * s + m] & 3) << 2) + (b[4 * m + t] & 3)
                for m in STATES
                if a[4 * s + m] >= 0 and b[4 * m + t] >= 0
            ]
            row.append(min(ways) if ways else None)
        order = sorted(w & 15 for w in row if w is not None)
        out += [-1 if w is None else (w >> 4) * 4 + order.index(w & 15) for w in row]
    return out


def last_state(m: list[int]) -> int:
    """Where a conversation of matrix ``m`` ends best, before the inserts that finish it."""
    return min((t for t in STATES if m[t] >= 0), key=lambda t: m[t] + INSERT * TAIL[t] * 4)


def path(ms: list[list[int]], start: int, end: int) -> list[int]:
    """States at the cuts between the runs ``ms``, from ``start`` to ``end``, both included."""
    ahead: list[list[int | None]] = [[0 if t == end else None for t in STATES]]
    step = []
    for m in reversed(ms):
        costs: list[int | None] = []
        choice: list[int | None] = []
        for s in STATES:
            ways = [(m[4 * s + t] + ahead[-1][t] * 4, t) for t in STATES if m[4 * s + t] >= 0 and ahead[-1][t] is not None]
            w, t = min(ways) if ways else (None, None)
            costs.append(None if w is None else w >> 2)
            choice.append(t)
        ahead.append(costs)
        step.append(choice)
    out = [start]
    for choice in reversed(step):
        out.append(choice[out[-1]])
    return out


# --- rows -----------------------------------------------------------------------

def damaged(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The rows, nulls in role and text as one space, with faults put in by a checksum of their place."""
    none = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.pmod(F.crc32(F.concat(none(conv), F.lit(":"), none(turn)).cast("binary")), F.lit(FAULTS))
    rows = turns.select(F.col(conv).alias("_conv"), F.col(turn).alias("_turn"), none(role).alias("_role"), none(text).alias("_text"), fault.alias("_f"))
    rows = rows.filter("_f <> 0").withColumn("_text", F.when(F.col("_f") == 1, "").when(F.col("_f") == 2, F.translate("_text", ".!?", "")).otherwise(F.col("_text")))
    rows = rows.withColumn("_role", F.when(F.col("_f") == 4, "user").otherwise(F.col("_role")))
    return rows.withColumn("_copy", F.explode(F.when(F.col("_f") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("_f", "_copy")


def as_given(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The rows as they are, nulls in role and text as one space."""
    none = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return turns.select(F.col(conv).alias("_conv"), F.col(turn).alias("_turn"), none(role).alias("_role"), none(text).alias("_text"))


def _ordered(rows: DataFrame, block: int) -> DataFrame:
    """Rows in order over the whole table, with their place, their block and what the graph needs of them."""
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    key = [F.col("_conv").asc_nulls_last(), F.col("_turn").asc_nulls_first(), F.col("_role"), F.col("_text"), F.col("_row")]
    rows = rows.repartitionByRange(*key).sortWithinPartitions(*key).drop("_row")
    end = F.substring(F.rtrim("_text", F.lit(SPACE)), -1, 1)
    rows = staged(
        rows.select(
            "_conv", "_role", "_text",
            F.substring("_role", 1, 1).alias("_initial"),
            (~F.col("_text").rlike(BLANK)).alias("_blank"),
            (~end.isin(".", "!", "?")).alias("_truncated"),
            F.monotonically_increasing_id().alias("_pos"),
        ),
        "structure-rows",
    )
    return rows.withColumn("_cut", F.floor(F.col("_pos") / F.lit(block)))


_STREAM = ("_cut", "_pos", "_kind", "_conv", "_role", "_text", "_initial", "_blank", "_truncated", "_start", "_end")
_MARK_BLOCK, _ROW, _MARK_FIRST = range(3)


def _stream(rows: DataFrame, first: DataFrame, bounds: DataFrame | None, with_text: bool) -> DataFrame:
    """Rows dealt by block, in order; a row's mark of being the first of its kind follows it, a block's bounds go before it."""
    like = rows.schema
    null = lambda c: F.lit(None).cast(like[c].dataType)
    state = lambda c=None: (F.lit(None) if c is None else F.col(c)).cast("int")
    text = F.col("_text") if with_text else null("_text")
    out = rows.select("_cut", "_pos", F.lit(_ROW).alias("_kind"), "_conv", "_role", text.alias("_text"), "_initial", "_blank", "_truncated", state().alias("_start"), state().alias("_end"))
    empty = [null(c).alias(c) for c in ("_conv", "_role", "_text", "_initial", "_blank", "_truncated")]
    out = out.union(first.select("_cut", "_pos", F.lit(_MARK_FIRST), *empty, state(), state()))
    if bounds is not None:
        out = out.union(bounds.select("_cut", "_pos", F.lit(_MARK_BLOCK), *empty, state("start"), state("end")))
    return out.repartition("_cut").sortWithinPartitions("_cut", "_pos", "_kind")


class _Run:
    """The turns of one conversation in one block."""

    def __init__(self, conv, pos: int, bounds: tuple[int, int] | None):
        self.conv, self.pos, self.bounds = conv, pos, bounds
        self.rows: list[tuple[str, str]] = []
        self.seen: list[tuple[str, bool, bool]] = []
        self.first: list[bool] = []

    def add(self, role: str, text: str, initial: str, blank: bool, truncated: bool) -> None:
        self.rows.append((role, text))
        self.seen.append((initial, blank, truncated))
        self.first.append(False)

    def turns(self) -> list[Turn]:
        return [(i, b or not f, t and not b and f) for (i, b, t), f in zip(self.seen, self.first)]

    def counts(self) -> tuple[int, int, int]:
        blank = sum(b for _, b, _ in self.seen)
        twice = sum(not b and not f for (_, b, _), f in zip(self.seen, self.first))
        return blank, twice, sum(t for _, _, t in self.turns())


def _runs(table: pa.Table) -> Iterator[_Run]:
    """The runs of a block, from its rows and marks in order."""
    run, bounds = None, None
    for pos, kind, conv, *row, start, end in zip(*(table.column(c).to_pylist() for c in _STREAM[1:])):
        if kind == _MARK_BLOCK:
            bounds = (start, end)
        elif kind == _ROW:
            if run is None or run.conv != conv or bounds is not None:
                if run is not None:
                    yield run
                run, bounds = _Run(conv, pos, bounds), None
            run.add(*row)
        else:
            run.first[-1] = True
    if run is not None:
        yield run


def _cuts(rows: DataFrame, first: DataFrame, conv_type: str) -> DataFrame | None:
    """(_cut, _pos, start, end) of each block of the conversations that have several; end is null in the last one."""
    parts = rows.groupBy("_conv", "_cut").agg(F.min("_pos").alias("_pos"))
    several = parts.groupBy("_conv").agg(F.count("*").alias("_n")).filter("_n > 1").select(F.col("_conv").alias("_c"))
    at = staged(parts.join(several, F.col("_conv").eqNullSafe(F.col("_c")), "left_semi"), "structure-parts")
    if at.isEmpty():
        discard(at)
        return None
    of = at.select(F.col("_conv").alias("_c"), F.col("_cut").alias("_k"))
    some = rows.join(of, rows["_conv"].eqNullSafe(of["_c"]) & (rows["_cut"] == of["_k"]), "left_semi")
    marks = first.join(some.select(F.col("_pos").alias("_p")), F.col("_pos") == F.col("_p"), "left_semi")

    def matrices(batches):
        for t in grouped(batches, "_cut"):
            cut = t.column("_cut")[0].as_py()
            found = list(_runs(t))
            conv = pa.array([r.conv for r in found], t.schema.field("_conv").type)
            m = pa.array([block_matrix(r.turns()) for r in found], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([conv, pa.array([cut] * len(found), pa.int64()), m], names=["_conv", "_key", "m"])

    node = f"_conv {conv_type}, _key bigint, m array<bigint>"
    levels = [staged(map_arrow(_stream(some, marks, None, with_text=False), matrices, node), "structure-level")]

    def up(pdf):
        pdf = pdf.sort_values("_key")
        m = None
        for x in pdf["m"]:
            m = list(map(int, x)) if m is None else compose(m, list(map(int, x)))
        return pdf[["_conv", "_key"]].head(1).assign(_key=pdf["_key"].iloc[0] // GROUP, m=[m])

    while levels[-1].groupBy("_conv").count().agg(F.max("count")).first()[0] > 1:
        group = F.floor(F.col("_key") / F.lit(GROUP)).alias("_g")
        levels.append(staged(levels[-1].groupBy("_conv", group).applyInPandas(up, node), "structure-level"))

    def top(pdf):
        return pdf[["_conv", "_key"]].assign(start=START, end=[last_state(list(map(int, m))) for m in pdf["m"]], last=True)

    bound = f"_conv {conv_type}, _key bigint, start int, end int, last boolean"
    known = levels[-1].groupBy("_conv", "_key").applyInPandas(top, bound)

    def down(pdf):
        pdf = pdf.sort_values("_key")
        states = path([list(map(int, m)) for m in pdf["m"]], int(pdf["start"].iloc[0]), int(pdf["end"].iloc[0]))
        n = len(pdf)
        return pdf[["_conv", "_key"]].assign(start=states[:-1], end=states[1:], last=[bool(pdf["last"].iloc[0]) and i == n - 1 for i in range(n)])

    for level in reversed(levels[:-1]):
        k = known.select(F.col("_conv").alias("_c"), F.col("_key").alias("_g"), "start", "end", "last")
        own = level.withColumn("_h", F.floor(F.col("_key") / F.lit(GROUP)))
        both = own.join(k, own["_conv"].eqNullSafe(k["_c"]) & (own["_h"] == k["_g"])).drop("_c", "_h")
        known = staged(both.groupBy("_conv", "_g").applyInPandas(down, bound), "structure-bounds")
    k = known.select(F.col("_conv").alias("_c"), F.col("_key").alias("_k"), "start", F.when(~F.col("last"), F.col("end")).alias("end"))
    bounds = staged(at.join(k, at["_conv"].eqNullSafe(k["_c"]) & (at["_cut"] == k["_k"])).select("_cut", "_pos", "start", "end"), "structure-bounds")
    discard(at, *levels)
    return bounds


PART = "part bigint, whole boolean, cost bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, audit string, repaired string, first_initial string, last_initial string"


def repair(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The repaired conversations in parts: one row for each conversation and block of rows that it has turns in.

    ``rows`` are (_conv, _turn, _role, _text) as :func:`damaged` or
    :func:`as_given` gives them.  ``repaired`` is the part's ``role:text`` rows
    joined by newlines, empty if it has none; ``audit`` the letters of its
    edits; the counts are of the part, ``illegal`` without the pair that two
    parts share; ``whole`` says that the conversation has no other part.
    """
    spark_rows = _ordered(rows, block)
    conv_type = spark_rows.schema["_conv"].dataType.simpleString()
    digest = F.sha2(F.concat(F.length("_role").cast("string"), F.lit(":"), F.col("_role"), F.col("_text")), 256)
    first = spark_rows.groupBy("_conv", digest).agg(F.min("_pos").alias("_pos")).select("_pos", F.floor(F.col("_pos") / F.lit(block)).alias("_cut"))
    first = staged(first, "structure-first")
    bounds = _cuts(spark_rows, first, conv_type)

    def solved(batches):
        for t in grouped(batches, "_cut"):
            out = []
            for r in _runs(t):
                turns = r.turns()
                start, end = r.bounds or (START, None)
                cost, letters = solve(turns, start, end)
                initials = [i for i, _, _ in r.seen]
                illegal = sum(a + b not in LEGAL_PAIRS for a, b in zip(initials, initials[1:]))
                text = "\n".join(f"{role}:{x}" for role, x in apply(turns, r.rows, letters, start))
                out.append((r.conv, r.pos, r.bounds is None, cost, *r.counts(), illegal, letters, text, initials[0], initials[-1]))
            if out:
                cols = [pa.array(c, f.type) for c, f in zip(zip(*out), arrow)]
                yield pa.RecordBatch.from_arrays(cols, schema=arrow)

    schema = f"_conv {conv_type}, {PART}"
    arrow = _arrow(spark_rows.sparkSession, schema)
    return map_arrow(_stream(spark_rows, first, bounds, with_text=True), solved, schema)


def _arrow(spark, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], schema).schema)


SUMMARY = "cost bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, audit string, repaired_sha256 string"


def summarise(parts: DataFrame) -> DataFrame:
    """One row per conversation: counts, cost, audit and the hash of its repaired rows.

    The parts of a conversation that has several are read in order, one at a
    time: a hash runs from the first row to the last.
    """
    conv_type = parts.schema["_conv"].dataType.simpleString()
    counts = ["cost", "blank", "duplicate", "truncated", "illegal"]
    one = parts.filter("whole").select("_conv", *counts, "audit", F.sha2(F.col("repaired").cast("binary"), 256).alias("repaired_sha256"))
    arrow = _arrow(parts.sparkSession, f"_conv {conv_type}, {SUMMARY}")

    def fold(batches):
        at, held = object(), None
        for b in batches:
            for r in b.to_pylist():
                if held is None or r["_conv"] != at:
                    if held is not None:
                        yield _done(at, held, arrow)
                    at, held = r["_conv"], {"n": [0] * 5, "audit": [], "hash": hashlib.sha256(), "any": False, "last": None}
                held["n"] = [a + r[c] for a, c in zip(held["n"], counts)]
                held["n"][4] += held["last"] is not None and held["last"] + r["first_initial"] not in LEGAL_PAIRS
                held["last"] = r["last_initial"]
                held["audit"].append(r["audit"])
                if r["repaired"]:
                    held["hash"].update((b"\n" if held["any"] else b"") + r["repaired"].encode())
                    held["any"] = True
        if held is not None:
            yield _done(at, held, arrow)

    many = parts.filter("not whole").repartition("_conv").sortWithinPartitions("_conv", "part")
    return one.union(map_arrow(many, fold, f"_conv {conv_type}, {SUMMARY}"))


def _done(conv, held: dict, arrow: pa.Schema) -> pa.RecordBatch:
    row = (conv, *held["n"], "".join(held["audit"]), held["hash"].hexdigest())
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, arrow)], schema=arrow)


def gaps(rows: DataFrame) -> DataFrame:
    """(_conv, gaps): turn numbers missing between the first and the last; null ones don't count."""
    missing: Column = F.max("_turn") - F.min("_turn") + 1 - F.count_distinct("_turn")
    return rows.groupBy("_conv").agg(F.coalesce(missing, F.lit(0)).cast("bigint").alias("gaps"))


def repair_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", damage: bool = True, block: int = BLOCK) -> DataFrame:
    """One row per conversation of ``turns``: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows are taken by turn number (null first), ties by role and then text,
    both in code-point order; repeated rows are turns of their own, all but the
    first of which are duplicates.  A null role or text is one space, a null
    conversation id one conversation; in the checksum of ``damage`` a null is
    one space too.  An empty role has no initial.  Empty texts are blank; a
    very long text is one turn.  A conversation that the damage leaves without
    rows has zeros, an empty audit and the hash of the empty string; an empty
    table gives no rows.  Other columns, whatever their names, are not read.
    """
    given = (damaged if damage else as_given)(turns, conv, turn, role, text)
    parts = staged(repair(given, block), "structure-repaired")
    found = staged(summarise(parts), "structure-summary")
    ids = turns.select(F.col(conv).alias("_id")).distinct()
    g = gaps(given).withColumnRenamed("_conv", "_g")
    s = found.withColumnRenamed("_conv", "_s")
    out = ids.join(g, ids["_id"].eqNullSafe(g["_g"]), "left").join(s, ids["_id"].eqNullSafe(s["_s"]), "left")
    zero = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.sha2(F.lit(b""), 256)
    return out.select(F.col("_id").alias(conv), *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))
