"""Benchmark decontamination with one Aho-Corasick automaton over item word windows.

Texts are normalised to words (ASCII letters lower-cased, everything but
digits, letters and non-ASCII characters separates).  The automaton's symbols
are the words of the benchmark, its patterns all windows of ``window``
consecutive item words (an item with fewer words is one pattern).  Each text
is scanned once from end to end; hits are mapped back to code-point offsets of
the original text.

The benchmark is a stated query set.  It is read in blocks of at most
``block_words`` words, which bounds the automaton a worker holds; one block is
one pass over the texts, and each pass adds to what the earlier ones found.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from itertools import repeat

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import append_arrow, discard, staged, utf8_list, worker_state

WINDOW = 10
BLOCK_WORDS = 200_000

_WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)
_FOUND = "n_words bigint, ranges array<struct<s:bigint,e:bigint>>, items array<string>"


def words(text: bytes) -> list[bytes]:
    """Normalised words of a UTF-8 text."""
    return text.translate(_TABLE).split()


def build(items: list[tuple[str, list[bytes]]], window: int = WINDOW):
    """(word -> symbol, automaton); a pattern's value is (its length, the ids of the items that hold it)."""
    import ahocorasick

    symbols: dict[bytes, int] = {}
    patterns: dict[tuple, set[str]] = {}
    for item, ws in items:
        ids = [symbols.setdefault(w, len(symbols) + 1) for w in ws]
        n = min(window, len(ids))
        for i in range(len(ids) - n + 1 if ids else 0):
            patterns.setdefault(tuple(ids[i : i + n]), set()).add(item)
    auto = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for p, found in patterns.items():
        auto.add_word(p, (len(p), sorted(found)))
    auto.make_automaton()
    return symbols, auto if patterns else None


def scan(text: bytes, symbols: dict[bytes, int], auto) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Words in the text, merged hit ranges as word indices (end exclusive), items found."""
    ws = words(text)
    if not ws or auto is None:
        return len(ws), [], set()
    ranges: list[list[int]] = []
    items: set[str] = set()
    for end, (n, found) in auto.iter(tuple(map(symbols.get, ws, repeat(0)))):
        s, e = end - n + 1, end + 1
        items.update(found)
        while ranges and ranges[-1][1] >= s:  # ends ascend, starts need not
            s = min(s, ranges.pop()[0])
        ranges.append([s, e])
    return len(ws), [tuple(r) for r in ranges], items


def merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(ranges):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def to_offsets(text: str, ranges: list[tuple[int, int]]) -> list[dict]:
    """Word ranges as code-point spans of the original text, end exclusive."""
    if not ranges:
        return []
    at = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    return [{"start": at[s][0], "end": at[e - 1][1]} for s, e in ranges]


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_words: int):
    """Benchmark items as normalised words, a block at a time."""
    block: list[tuple[str, list[bytes]]] = []
    held = 0
    rows = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    for r in rows.toLocalIterator():
        ws = words(r["t"].encode())
        # a longer item is cut with an overlap, so that no window of it is lost
        for k in range(0, max(1, len(ws)), block_words):
            part = ws[k : k + block_words + window - 1] if len(ws) > block_words else ws
            if held and held + len(part) > block_words:
                yield block
                block, held = [], 0
            block.append((r["i"], part))
            held += len(part)
            if len(ws) <= block_words or k + block_words + window - 1 >= len(ws):
                break
    yield block


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[str],
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per row of ``docs``: the ``keep`` columns and what was found in its text.

    Adds n_words, n_hit, n_items, items (ids of the items found, sorted as
    strings), items_sha256, contaminated and spans (code points, end
    exclusive).  Null texts have no words.  Item rows with a null or wordless
    text hold no window; rows that repeat an item_id count as one item; a null
    item_id is the empty id.  Repeated documents are scanned each on its own; a
    very long text is scanned whole, in one row; without documents there are no
    rows, without items nothing is found.  Other columns of either table are
    not read.
    """
    spark = docs.sparkSession
    df = docs.select(*keep, F.col(text_col).alias("_text"))
    blocks = _blocks(benchmark, item_col, item_text, window, block_words)
    block, before = next(blocks), None
    while block is not None:  # the driver holds this block and the next one
        following = next(blocks, None)
        shared = spark.sparkContext.broadcast((uuid.uuid4().hex, block))
        df = _pass(df, shared, window, first=before is None)
        if following is not None:
            df, old = staged(df, "contamination"), before
            shared.destroy()
            if old is not None:
                discard(old)
        block, before = following, df
    return _report(df, keep)


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """Rows of ``docs`` (all columns) without a benchmark window.

    Null and empty texts have no words and stay; very long ones are read whole;
    repeated rows stay or go together; a table without rows, of documents or of
    the benchmark, is no error.  Columns of any name pass through.
    """
    wrapped = docs.select(F.struct(*docs.columns).alias("_doc"), F.col(text_col).alias("_t"))
    found = contamination(wrapped, benchmark, ["_doc"], "_t", **options)
    return found.filter(~F.col("contaminated")).select("_doc.*")


def _pass(df: DataFrame, shared, window: int, first: bool) -> DataFrame:
    def make():
        key, block = shared.value
        symbols, auto = worker_state(("benchmark", key), lambda: build(block, window))

        def fn(b):
            found = [scan(t, symbols, auto) for t in utf8_list(b.column("_text"))]
            if not first:
                before = zip(b.column("ranges").to_pylist(), b.column("items").to_pylist())
                found = [(n, merge([*r, *((x["s"], x["e"]) for x in br)]), i | set(bi)) for (n, r, i), (br, bi) in zip(found, before)]
            return [
                [n for n, _, _ in found],
                [[{"s": s, "e": e} for s, e in r] for _, r, _ in found],
                [sorted(i) for _, _, i in found],
            ]

        return fn

    if first:
        return append_arrow(df, _FOUND, make)
    old = ["n_words", "ranges", "items"]
    new = append_arrow(df, "n_words2 bigint, ranges2 array<struct<s:bigint,e:bigint>>, items2 array<string>", make)
    return new.drop(*old).withColumnsRenamed({f"{c}2": c for c in old})


def _report(df: DataFrame, keep: list[str]) -> DataFrame:
    def make():
        def fn(b):
            ranges = [[(x["s"], x["e"]) for x in r] for r in b.column("ranges").to_pylist()]
            text = b.column("_text")
            items = b.column("items").to_pylist()
            return [
                [sum(e - s for s, e in r) for r in ranges],
                [len(i) for i in items],
                [hashlib.sha256(",".join(i).encode()).hexdigest() for i in items],
                [bool(r) for r in ranges],
                [to_offsets(text[k].as_py() or "", r) if r else [] for k, r in enumerate(ranges)],
            ]

        return fn

    fields = "n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, spans array<struct<start:bigint,end:bigint>>"
    out = append_arrow(df, fields, make)
    return out.select(*keep, "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items", "spans")
