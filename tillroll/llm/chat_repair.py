"""Chat formatting with minimum-cost role repair.

A legal conversation is a path through the turn automaton: an optional system
turn, then user and assistant turns in alternation, the assistant last.  Each
given turn is kept, relabelled, or merged into the turn before it, and empty
turns are inserted, at a cost each; dynamic programming finds the cheapest way,
and the repaired sequence is rendered.

A turn acts on the automaton's states as a matrix in (min, +) algebra, so a
conversation can be cut anywhere: rows are sorted over the whole table, cut
into blocks of at most ``block`` turns, each block's matrix is computed on its
own, and only the matrices of conversations of several blocks are multiplied
up, in order, to learn the states at the cuts.  Then every block is solved
between its states.  A conversation with a third of all rows is so many blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, grouped, map_arrow, staged

ROLES = ("system", "user", "assistant")
ALIASES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant"}
# states: nothing yet, or the role of the last turn
START, SYSTEM, USER, ASSISTANT = range(4)
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
FINAL = ASSISTANT
MERGE, RELABEL, INSERT = 2, 3, 4
UNKNOWN = 1  # relabelling a turn without a known role
BLOCK, GROUP = 4096, 1024
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
_FAR = 1 << 40


def normal_role(role: str | None) -> str | None:
    """One of ROLES, or None for a role that is none of them."""
    r = (role or "").strip().lower()
    r = ALIASES.get(r, r)
    return r if r in ROLES else None


def _paths() -> dict[tuple[int, int], tuple[int, ...]]:
    """The shortest run of inserted turns from state to state; the empty one from a state to itself."""
    out = {(s, s): () for s in range(4)}
    grown = True
    while grown:
        grown = False
        for (s, t), run in list(out.items()):
            for u in LEGAL[t]:
                if len(run) + 1 < len(out.get((s, u), (0,) * 9)):
                    out[(s, u)] = (*run, u)
                    grown = True
    return out


INSERTED = _paths()


def _moves(role: str | None) -> dict[tuple[int, int], tuple[int, str, tuple[int, ...]]]:
    """(from, to) -> (cost, action, inserted roles) of the cheapest way to take a turn; ties by the order below."""
    out: dict[tuple[int, int], tuple[int, str, tuple[int, ...]]] = {}
    for s in range(4):
        for to in (SYSTEM, USER, ASSISTANT):
            change = 0 if role == ROLES[to - 1] else UNKNOWN if role is None else RELABEL
            ways = []
            for (a, t), run in INSERTED.items():
                if a == s and to in LEGAL[t]:
                    ways.append((INSERT * len(run) + change, "relabel" if change else "keep", run))
            if s == to:
                ways.append((MERGE + change, "merge", ()))
            if ways:
                out[(s, to)] = min(ways, key=lambda w: (w[0], len(w[2]), ("keep", "merge", "relabel").index(w[1])))
    return out


MOVES = {r: _moves(r) for r in (*ROLES, None)}
STEP = {}
for _r, _m in MOVES.items():
    STEP[_r] = np.full((4, 4), _FAR, np.int64)
    for _k, _w in _m.items():
        STEP[_r][_k] = _w[0]
END = np.array([INSERT * len(INSERTED[(s, FINAL)]) for s in range(4)], np.int64)


def compose(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a, then b, in (min, +)."""
    return np.minimum((a[:, :, None] + b[None, :, :]).min(1), _FAR)


def block_matrix(roles: list[str | None]) -> np.ndarray:
    m = np.where(np.eye(4, dtype=bool), 0, _FAR)
    for r in roles:
        m = compose(m, STEP[r])
    return m


def solve(roles: list[str | None], start: int, end: int | None) -> tuple[list[tuple[int, str, tuple[int, ...]]], tuple[int, ...]]:
    """(state, action, inserted before) per turn of a block, and the roles inserted behind it.

    ``end`` None: the block is the last, and ends as is cheapest to finish.
    Of equal costs the lowest state is taken, from the end backwards.
    """
    cost = np.full(4, _FAR, np.int64)
    cost[start] = 0
    back = []
    for r in roles:
        total = cost[:, None] + STEP[r]
        back.append(total.argmin(0))
        cost = np.minimum(total.min(0), _FAR)
    state = int((cost + END).argmin()) if end is None else end
    tail = INSERTED[(state, FINAL)] if end is None else ()
    out = []
    for r, b in zip(reversed(roles), reversed(back)):
        before = int(b[state])
        _, action, run = MOVES[r][(before, state)]
        out.append((state, action, run))
        state = before
    return out[::-1], tail


def clean(text: str | None) -> str:
    """Text that can't be read as a turn marker."""
    return (text or "").replace("<|im_", "< |im_")


def render(texts: list[str | None], solved: list[tuple[int, str, tuple[int, ...]]], start: int, tail: tuple[int, ...], last: bool) -> list[str]:
    """One piece of text per given turn; joined in order they are the repaired conversation."""
    out, before = [], start
    for text, (state, action, run) in zip(texts, solved):
        piece = ""
        if action == "merge":
            piece = "\n\n" + clean(text)
        else:
            for r in (*run, state):
                piece += (f"{CLOSE}\n" if before != START else "") + f"{OPEN}{ROLES[r - 1]}\n"
                before = r
            piece += clean(text)
        before = state
        out.append(piece)
    if last and out:
        for r in tail:
            out[-1] += f"{CLOSE}\n{OPEN}{ROLES[r - 1]}\n"
        out[-1] += f"{CLOSE}\n"
    return out


def _ordered(turns: DataFrame, conv: str, turn: str, role: str, text: str, block: int) -> DataFrame:
    rows = turns.select(F.col(conv).alias("_conv"), F.col(turn).alias("_turn"), F.col(role).alias("_role"), F.col(text).alias("_text"))
    rows = rows.withColumn("_tie", F.xxhash64("_role", "_text")).withColumn("_row", F.monotonically_increasing_id())
    key = [F.col("_conv").asc_nulls_last(), F.col("_turn").asc_nulls_last(), F.col("_tie"), F.col("_row")]
    rows = rows.repartitionByRange(*key).sortWithinPartitions(*key).drop("_tie", "_row")
    rows = staged(rows.withColumn("_pos", F.monotonically_increasing_id()), "turns")
    cut = F.floor(F.col("_pos") / F.lit(block))
    return rows.withColumn("_unit", F.xxhash64(F.coalesce(F.col("_conv").cast("string"), F.lit("\x00")), cut)).withColumn("_cut", cut)


def _runs(t: pa.Table) -> list[tuple[int, int]]:
    """Rows of each block in a unit: units are hashes, so that two blocks may meet in one."""
    conv = t.column("_conv").to_pylist()
    cut = t.column("_cut").to_pylist()
    edges = [0, *(i for i in range(1, len(conv)) if conv[i] != conv[i - 1] or cut[i] != cut[i - 1]), len(conv)]
    return list(zip(edges, edges[1:]))


def _inside(pdf):
    """States at the cuts of a run of blocks, from its ``start`` to its ``end`` (-1: wherever it finishes best)."""
    pdf = pdf.sort_values("_cut")
    ms = [np.array(m, np.int64).reshape(4, 4) for m in pdf["m"]]
    end = int(pdf["end"].iloc[0])
    ahead = [END if end < 0 else np.where(np.arange(4) == end, 0, _FAR)]  # cheapest way on from each state, behind each block
    for m in reversed(ms):
        ahead.append(np.minimum((m + ahead[-1][None, :]).min(1), _FAR))
    ahead = ahead[::-1]
    state, starts, ends = int(pdf["start"].iloc[0]), [], []
    for i, m in enumerate(ms):
        starts.append(state)
        state = int((m[state] + ahead[i + 1]).argmin())
        ends.append(state if i + 1 < len(ms) else end)
    return pdf[["_conv", "_cut"]].assign(start=starts, end=ends)


def _bounds(blocks: DataFrame, conv_type: str, group: int) -> DataFrame:
    """(_conv, _cut, start, end) of every block; end is -1 in a conversation's last.

    Matrices of up to ``group`` neighbouring blocks are multiplied up to one, level by
    level, until no conversation has more than ``group``; its states are then
    found from the top down, so that no task sees more than ``group`` matrices.
    """
    node, bound = f"_conv {conv_type}, _cut bigint, m array<bigint>", f"_conv {conv_type}, _cut bigint, start int, end int"

    def up(pdf):
        pdf = pdf.sort_values("_cut")
        m = None
        for x in pdf["m"]:
            x = np.array(x, np.int64).reshape(4, 4)
            m = x if m is None else compose(m, x)
        return pdf[["_conv"]].head(1).assign(_cut=pdf["_cut"].iloc[0] // group, m=[m.ravel().tolist()])

    above = F.floor(F.col("_cut") / F.lit(group))
    levels = [blocks]
    while (levels[-1].groupBy("_conv").count().agg(F.max("count")).first()[0] or 0) > group:
        levels.append(staged(levels[-1].groupBy("_conv", above.alias("_above")).applyInPandas(up, node), "turn-matrices"))
    free = levels[-1].withColumn("start", F.lit(START)).withColumn("end", F.lit(-1))
    known = staged(free.groupBy("_conv").applyInPandas(_inside, bound), "turn-cuts")
    for level in reversed(levels[:-1]):
        k = known.toDF("_c", "_k", "start", "end")
        own = level.withColumn("_above", above)
        own = own.join(k, own["_conv"].eqNullSafe(k["_c"]) & (own["_above"] == k["_k"])).drop("_c", "_k")
        known = staged(own.groupBy("_conv", "_above").applyInPandas(_inside, bound), "turn-cuts")
    discard(*levels)
    return known


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """One row per given turn: conversation, turn, position, role, new_role, action, inserted, piece.

    position orders the turns of a conversation; new_role is the role of the
    turn it ends up in; action is keep, relabel or merge (into the turn
    before); inserted lists the empty turns put before it, and behind it where
    the conversation needs them to end; the pieces of a conversation, joined by
    position, are its rendered text.

    Turns are ordered by turn number (null last), ties by a hash of role and
    text; repeated rows are turns of their own, which merge.  A null
    conversation id is one conversation.  Roles are trimmed, lower-cased and
    known aliases resolved; any other or null role costs little to relabel.
    Null texts are empty, a very long text is one turn; an empty table gives no
    rows.  Other columns are not read.
    """
    rows = _ordered(turns, conv_col, turn_col, role_col, text_col, block)
    conv_type = rows.schema["_conv"].dataType.simpleString()
    turn_type = rows.schema["_turn"].dataType.simpleString()
    order = ["_conv", "_cut", "_pos"]
    several = rows.select("_conv", "_cut").distinct().groupBy("_conv").count().filter("count > 1").select("_conv")
    some = rows.select("_conv", "_cut", "_unit", "_pos", "_role").join(several, rows["_conv"].eqNullSafe(several["_conv"]), "left_semi")

    def matrices(batches):
        for t in grouped(batches, "_unit"):
            roles = [normal_role(r) for r in t.column("_role").to_pylist()]
            for s, e in _runs(t):
                one = t.slice(s, 1)
                yield pa.RecordBatch.from_arrays(
                    [one.column("_conv").combine_chunks(), one.column("_cut").combine_chunks(), pa.array([block_matrix(roles[s:e]).ravel().tolist()], pa.list_(pa.int64()))],
                    names=["_conv", "_cut", "m"],
                )

    dealt = some.repartition(F.col("_unit")).sortWithinPartitions("_unit", *order)
    blocks = map_arrow(dealt, matrices, f"_conv {conv_type}, _cut bigint, m array<bigint>")

    bounds = _bounds(staged(blocks, "turn-matrices"), conv_type, group)
    b = bounds.toDF("_bconv", "_bcut", "_start", "_end")
    rows = rows.join(b, rows["_conv"].eqNullSafe(b["_bconv"]) & (rows["_cut"] == b["_bcut"]), "left").drop("_bconv", "_bcut")

    def solved(batches):
        for t in grouped(batches, "_unit"):
            roles = [normal_role(r) for r in t.column("_role").to_pylist()]
            texts = t.column("_text").to_pylist()
            starts, ends = t.column("_start").to_pylist(), t.column("_end").to_pylist()
            new, acts, ins, pieces = [], [], [], []
            for s, e in _runs(t):
                last = ends[s] is None or ends[s] < 0
                found, tail = solve(roles[s:e], starts[s] or START, None if last else ends[s])
                pieces += render(texts[s:e], found, starts[s] or START, tail, last)
                new += [ROLES[x - 1] for x, _, _ in found]
                acts += [a for _, a, _ in found]
                own = [[ROLES[r - 1] for r in run] for _, _, run in found]
                own[-1] = own[-1] + [ROLES[r - 1] for r in tail]
                ins += own
            keep = [t.column(c).combine_chunks() for c in ("_conv", "_turn", "_pos", "_role")]
            more = [pa.array(new), pa.array(acts), pa.array(ins, pa.list_(pa.string())), pa.array(pieces)]
            yield pa.RecordBatch.from_arrays(keep + more, names=out_names)

    out_names = ["_conv", "_turn", "_pos", "_role", "new_role", "action", "inserted", "piece"]
    schema = f"_conv {conv_type}, _turn {turn_type}, _pos bigint, _role string, new_role string, action string, inserted array<string>, piece string"
    dealt = rows.repartition(F.col("_unit")).sortWithinPartitions("_unit", *order)
    out = map_arrow(dealt, solved, schema)
    return out.toDF(conv_col, turn_col, "position", role_col, "new_role", "action", "inserted", "piece")
