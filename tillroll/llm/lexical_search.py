"""Ranked lexical search by a dual tree over items and documents.

Items (the stated query set) and documents are sparse vectors over the items'
terms: an item's coordinate is its term's weight times its repeats, a
document's is the saturated frequency of the term.  A score is their product.
Both sides are hierarchies whose nodes hold coordinate maxima, so the product
of two nodes bounds the score of every pair below them.  Where it stays below
the weakest k-th score of the node's items, the whole batch of pairs is pruned;
what is left at the leaves is scored exactly.  All of it is in integers.

Documents are read once and become a table of vectors in the shared folder; a
hierarchy is built over every few thousand of them inside a task.  The k-th
scores of a small hash sample are a lower bound of the final ones, so every
task starts with thresholds that prune, and few rows leave it.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, map_arrow, pa_type, staged, utf8_list
from .decontaminate import words

K = 10
#: Words of the items searched for in one pass; more are further passes.
PASS_WORDS = 200_000
#: Documents in one hierarchy, documents in one of its leaves, children of a node.
BATCH, LEAF, FAN = 4096, 16, 4
#: Items in one hierarchy, and their words, unless one item alone has more.
GROUP_ITEMS, GROUP_WORDS = 256, 16_384
#: Numbers in the leaf level of a hierarchy: with very many terms it holds fewer documents.
CELLS = 4_000_000
#: One document in so many sets the first thresholds.
SEED = 64


def item_blocks(items: DataFrame, item_id: str, text: str, pass_words: int) -> Iterator[list[tuple[object, Counter]]]:
    """Items as (id, term counts), in blocks of at most ``pass_words`` words or of one item."""
    block: list[tuple[object, Counter]] = []
    held = 0
    for r in items.select(F.col(item_id).alias("i"), F.coalesce(F.col(text), F.lit("")).alias("t")).toLocalIterator():
        ws = words(r["t"].encode())
        if not ws:
            continue
        if held and held + len(ws) > pass_words:
            yield block
            block, held = [], 0
        block.append((r["i"], Counter(ws)))
        held += len(ws)
    if block:
        yield block


def vectors(docs: DataFrame, doc_id: str, text: str, vocabulary) -> DataFrame:
    """(_id, n, terms, tfs): words of each document, and which of the broadcast terms it holds how often."""
    df = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    id_type = df.schema["_id"].dataType

    def run(batches):
        ids = {w: i for i, w in enumerate(vocabulary.value)}
        size = max(1, len(ids))
        for b in batches:
            if not b.num_rows:
                continue
            flat: list[int] = []
            ends, n = [], []
            for t in utf8_list(b.column("_text")):
                ws = words(t)
                flat.extend(map(ids.get, ws, repeat(-1)))
                n.append(len(ws))
                ends.append(len(flat))
            found = np.array(flat, np.int64)
            doc = np.repeat(np.arange(b.num_rows), n)
            known = found >= 0
            pair, tf = np.unique(doc[known] * size + found[known], return_counts=True)
            offsets = pa.array(np.searchsorted(pair // size, np.arange(b.num_rows + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(v, pa.int32())) for v in (pair % size, tf)]
            yield pa.RecordBatch.from_arrays([b.column("_id"), pa.array(n, pa.int64()), *lists], names=["_id", "n", "terms", "tfs"])

    return map_arrow(df, run, f"_id {id_type.simpleString()}, n bigint, terms array<int>, tfs array<int>")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2.0 * n_docs + 2) / (2.0 * df + 1)))


class ItemTree:
    """A hierarchy over some items: level 0 holds the items, each higher node the maxima of up to FAN below it.

    A node is (terms ascending, maxima).  Items with the same heaviest
    coordinate are neighbours, which keeps the maxima tight.
    """

    def __init__(self, items: list[tuple[int, np.ndarray, np.ndarray]]):
        self.items = np.array([i for i, _, _ in items])
        self.levels = [[(t, q) for _, t, q in items]]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            self.levels.append([self._join(below[i : i + FAN]) for i in range(0, len(below), FAN)])
        self.terms = self.levels[-1][0][0]

    @staticmethod
    def _join(nodes):
        terms = np.concatenate([t for t, _ in nodes])
        q = np.concatenate([q for _, q in nodes])
        order = np.argsort(terms, kind="stable")
        terms, q = terms[order], q[order]
        first = np.flatnonzero(np.r_[True, terms[1:] != terms[:-1]])
        return terms[first], np.maximum.reduceat(q, first)

    def below(self, level: int, node: int) -> slice:
        """The items under a node."""
        span = FAN**level
        return slice(node * span, min((node + 1) * span, len(self.items)))


def item_trees(vecs: list[tuple[np.ndarray, np.ndarray]]) -> list[ItemTree]:
    """Hierarchies over all items, each of a bounded number of items and words."""
    order = sorted(range(len(vecs)), key=lambda i: (int(vecs[i][0][vecs[i][1].argmax()]), i))
    trees, part, held = [], [], 0
    for i in order:
        t, q = vecs[i]
        if part and (len(part) == GROUP_ITEMS or held + len(t) > GROUP_WORDS):
            trees.append(ItemTree(part))
            part, held = [], 0
        part.append((i, t, q))
        held += len(t)
    if part:
        trees.append(ItemTree(part))
    return trees


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    n = ends - starts
    return np.repeat(ends - np.cumsum(n), n) + np.arange(n.sum())


class DocTree:
    """A hierarchy over a batch of documents given as entries (document, term, coordinate) sorted by document.

    ``levels[0]`` has a column for each leaf of LEAF documents, each higher
    level one for FAN columns below it; rows are the terms of the batch.
    """

    def __init__(self, bounds: np.ndarray, terms: np.ndarray, g: np.ndarray):
        self.bounds, self.g = bounds, g
        self.terms, self.col = np.unique(terms, return_inverse=True)
        n = len(bounds) - 1
        leaf = np.repeat(np.arange(n) // LEAF, np.diff(bounds))
        base = np.zeros((len(self.terms), -(-n // LEAF)), np.int64)
        np.maximum.at(base, (self.col, leaf), g)
        self.levels = [base]
        while self.levels[-1].shape[1] > 1:
            below = self.levels[-1]
            self.levels.append(np.maximum.reduceat(below, np.arange(0, below.shape[1], FAN), axis=1))

    def bound(self, level: int, nodes: np.ndarray, terms: np.ndarray, q: np.ndarray) -> np.ndarray:
        """What no pair of an item under (terms, q) and a document under each of ``nodes`` can exceed."""
        at = np.searchsorted(self.terms, terms)
        at[at == len(self.terms)] = 0
        held = self.terms[at] == terms
        return q[held] @ self.levels[level][np.ix_(at[held], nodes)]

    def scores(self, leaves: np.ndarray, terms: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document, score) of every document of the leaves, exactly."""
        n = len(self.bounds) - 1
        docs = _ranges(leaves * LEAF, np.minimum((leaves + 1) * LEAF, n))
        starts, ends = self.bounds[docs], self.bounds[docs + 1]
        entries = _ranges(starts, ends)
        dense = np.zeros(len(self.terms), np.int64)
        at = np.searchsorted(self.terms, terms)
        at[at == len(self.terms)] = 0
        held = self.terms[at] == terms
        dense[at[held]] = q[held]
        part = dense[self.col[entries]] * self.g[entries]
        return docs, np.add.reduceat(part, np.r_[0, np.cumsum(ends - starts)[:-1]])


def traverse(items: ItemTree, docs: DocTree, least: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(item, documents, scores) of the pairs whose bounds reach the item's ``least`` score.

    Both trees go down together, a node of items with all the nodes of
    documents that are left for it; whichever reaches its leaves first waits.
    """
    top = len(docs.levels) - 1
    stack = [(len(items.levels) - 1, 0, top, np.arange(docs.levels[top].shape[1]))]
    while stack:
        level, node, dlevel, nodes = stack.pop()
        terms, q = items.levels[level][node]
        weakest = least[items.items[items.below(level, node)]].min()
        nodes = nodes[docs.bound(dlevel, nodes, terms, q) >= weakest]
        if not len(nodes):
            continue
        if level == 0 and dlevel == 0:
            found, scores = docs.scores(nodes, terms, q)
            item = int(items.items[node])
            good = scores >= least[item]
            if good.any():
                yield item, found[good], scores[good]
            continue
        if dlevel:
            nodes = _ranges(nodes * FAN, np.minimum((nodes + 1) * FAN, docs.levels[dlevel - 1].shape[1]))
        below = [(0, node)] if not level else [(level - 1, c) for c in range(node * FAN, min((node + 1) * FAN, len(items.levels[level - 1])))]
        stack.extend((lv, c, max(dlevel - 1, 0), nodes) for lv, c in below)


def best(rows: pa.Table, k: int) -> pa.Table:
    """The k best rows of every item: highest score, then lowest id, a null id last."""
    order = pc.sort_indices(rows, sort_keys=[("item", "ascending"), ("score", "descending"), ("_id", "ascending")], null_placement="at_end")
    rows = rows.take(order)
    item = rows.column("item").to_numpy()
    if not len(item):
        return rows
    first = np.flatnonzero(np.r_[True, item[1:] != item[:-1]])
    place = np.arange(len(item)) - np.repeat(first, np.diff(np.r_[first, len(item)]))
    return rows.filter(pa.array(place < k))


class Searcher:
    """The best k documents of every item among those it was shown."""

    def __init__(self, trees: list[ItemTree], w: np.ndarray, n_docs: int, n_words: int, least: np.ndarray, k: int, id_type: pa.DataType):
        self.trees, self.w, self.n_docs, self.n_words, self.k = trees, w, n_docs, n_words, k
        self.floor = np.maximum(least, 1)  # no score of 0
        self.least = self.floor.copy()
        self.rows = pa.table({"item": pa.array([], pa.int32()), "_id": pa.array([], id_type), "score": pa.array([], pa.int64())})

    def show(self, b: pa.RecordBatch) -> None:
        lists = b.column("terms")
        ends = np.r_[0, np.cumsum(pc.list_value_length(lists).to_numpy())].astype(np.int64)
        some = np.flatnonzero(np.diff(ends))  # a document without any item's term scores 0
        if not len(some):
            return
        ids = b.column("_id").take(pa.array(some))
        terms = lists.flatten().to_numpy().astype(np.int64)
        tf = b.column("tfs").flatten().to_numpy().astype(np.int64)
        n = b.column("n").to_numpy()[some]
        bounds = np.r_[ends[some], ends[-1]]
        m = 100 - 75 + (75 * n * self.n_docs) // self.n_words
        g = (1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, np.diff(bounds)))
        # documents with the same heaviest coordinate are neighbours
        heaviest = np.maximum.reduceat(self.w[terms] * g * len(self.w) + terms, bounds[:-1]) % len(self.w)
        order = np.argsort(heaviest, kind="stable")
        entries = _ranges(bounds[order], bounds[order + 1])
        bounds = np.r_[0, np.cumsum(np.diff(bounds)[order])]
        terms, g, ids = terms[entries], g[entries], ids.take(pa.array(order))
        doc = np.repeat(np.arange(len(order)), np.diff(bounds))
        for tree in self.trees:
            mine = np.isin(terms, tree.terms)
            d, t, x = doc[mine], terms[mine], g[mine]
            if not len(d):
                continue
            held, first = np.unique(d, return_index=True)
            step = LEAF * max(1, CELLS // len(np.unique(t)))
            for s in range(0, len(held), step):
                e = min(s + step, len(held))
                edge = np.r_[first, len(d)][s : e + 1]
                self._search(tree, ids.take(pa.array(held[s:e])), edge - edge[0], t[edge[0] : edge[-1]], x[edge[0] : edge[-1]])

    def _search(self, tree: ItemTree, ids: pa.Array, bounds: np.ndarray, terms: np.ndarray, g: np.ndarray) -> None:
        found = list(traverse(tree, DocTree(bounds, terms, g), self.least))
        if not found:
            return
        docs = np.concatenate([d for _, d, _ in found])
        new = pa.table({
            "item": pa.array(np.repeat([i for i, _, _ in found], [len(d) for _, d, _ in found]), pa.int32()),
            "_id": ids.take(pa.array(docs)),
            "score": pa.array(np.concatenate([s for _, _, s in found]), pa.int64()),
        })
        self.rows = best(pa.concat_tables([self.rows, new]), self.k)
        item, score = self.rows.column("item").to_numpy(), self.rows.column("score").to_numpy()
        full = np.flatnonzero(np.bincount(item, minlength=len(self.least)) >= self.k)
        last = np.searchsorted(item, full, side="right") - 1
        self.least[full] = np.maximum(self.floor[full], score[last])


def _search(vecs: DataFrame, shared, n_docs: int, n_words: int, least: np.ndarray, k: int) -> DataFrame:
    """(item, _id, score): what each task finds best for every item, at least ``least``."""
    id_type = vecs.schema["_id"].dataType
    arrow_id = pa_type(id_type)

    def run(batches):
        vec, w = shared.value
        s = Searcher(item_trees(vec), w, n_docs, n_words, least, k, arrow_id)
        for b in batches:
            for at in range(0, b.num_rows, BATCH):
                s.show(b.slice(at, BATCH))
        yield from s.rows.combine_chunks().to_batches()

    return map_arrow(vecs, run, f"item int, _id {id_type.simpleString()}, score bigint")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    k: int = K,
    pass_words: int = PASS_WORDS,
) -> DataFrame:
    """The ``k`` best documents of every item: item id, rank (from 1), document id, score (above 0).

    Terms are runs of digits, letters and non-ASCII characters of the whole
    text, ASCII letters lower-cased.  With N documents that have a term, L terms
    in all, df documents that hold a term and n terms of a document, a term
    weighs floor(1000 ln((2N + 2) / (2df + 1))), and a document's coordinate is
    1e9 tf div (1000 tf + 8 m), m = 25 + 75 n N div L.  Equal scores are ranked
    by ascending id, a null id last.

    Null, empty and termless texts of documents score nothing and count in no
    statistic; such items have no rows.  A very long text is one vector.
    Repeated documents are ranked each on its own; item rows that share an id
    are searched each on its own.  Without documents or items there are no rows.
    Other columns, whatever their names, are not read.

    Items are searched in blocks of ``pass_words`` words (what a task holds of
    them is bounded by that), one pass over the documents for each.
    """
    spark = docs.sparkSession
    id_types = docs.schema[doc_id].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    out = None
    for block in item_blocks(items, item_id, item_text, pass_words):
        found = _pass(docs, doc_id, text, block, k)
        if found is None:
            continue
        names = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(block)], f"item int, _item {id_types[1]}")
        part = found.join(F.broadcast(names), "item").select(F.col("_item").alias(item_id), "rank", F.col("_id").alias(doc_id), "score")
        out = part if out is None else out.union(part)
    if out is None:
        return spark.createDataFrame([], f"{item_id} {id_types[1]}, rank int, {doc_id} {id_types[0]}, score bigint")
    return out


def _pass(docs: DataFrame, doc_id: str, text: str, block: list[tuple[object, Counter]], k: int) -> DataFrame | None:
    sc = docs.sparkSession.sparkContext
    terms = sorted({w for _, c in block for w in c})
    number = {w: i for i, w in enumerate(terms)}
    vocabulary = sc.broadcast(terms)
    vecs = staged(vectors(docs, doc_id, text, vocabulary), "lexical-vectors")
    vocabulary.destroy()
    total = vecs.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.sum("n").alias("words")).first()
    if not total["docs"]:
        return None
    df = np.zeros(len(terms), np.int64)
    for r in vecs.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # a row a term of the block
        df[r["t"]] = r["count"]
    w = np.array([weight(total["docs"], int(x)) for x in df], np.int64)
    vec = []
    for _, counts in block:
        own = sorted((number[t], c) for t, c in counts.items())
        t = np.array([x for x, _ in own], np.int64)
        vec.append((t, w[t] * np.array([c for _, c in own], np.int64)))
    shared = sc.broadcast((vec, w))
    seeds = vecs.filter(F.pmod(F.xxhash64("_id", "n", "terms"), F.lit(SEED)) == 0)
    least = np.zeros(len(block), np.int64)
    for r in _ranked(_search(seeds, shared, total["docs"], total["words"], least, k), k).filter(F.col("rank") == k).collect():
        least[r["item"]] = r["score"]
    found = staged(_ranked(_search(vecs, shared, total["docs"], total["words"], least, k), k), "lexical-best")
    shared.destroy()
    discard(vecs)
    return found
