"""Dual-tree search against scoring every pair."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tillroll.llm import lexical_search as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [w.translate(LOWER) for w in WORD.findall(text or "")]


def brute(docs, items, k=10):
    ds = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, n_words = sum(bool(c) for _, c in ds), sum(sum(c.values()) for _, c in ds)
    df = Counter(w for _, c in ds for w in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in ds:
            n = sum(c.values())
            if not n:
                continue
            m = 100 - 75 + (75 * n * n_docs) // n_words
            score = 0
            for w in terms(text):
                if tf := c[w]:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((1000000000 * tf) // (1000 * tf + 8 * m))
            if score:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def tables(spark, docs, items):
    return (
        spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id bigint, text string, score int, item string"),
        spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id bigint, text string, rank int, _id string"),
    )


def got(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def corpus(seed, n=700):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    common = [1 / (i + 1) for i in range(300)]
    docs = [(i, " ".join(rng.choices(vocabulary, common, k=rng.randint(0, 60)))) for i in range(n)]
    copy = docs[5][1] or "w1 w2"
    docs += [(1000 + i, copy) for i in range(200)]  # ties
    docs += [(2000, None), (2001, ""), (2002, "... --"), (None, copy), (2003, "W1, É w2-W3 " * 3000), (7, copy), (7, copy)]
    rng.shuffle(docs)
    items = [(i, " ".join(rng.choices(vocabulary, common, k=rng.randint(1, 30)))) for i in range(25)]
    items += [(90, copy), (91, None), (92, "!"), (93, "unknown only"), (94, "É w3 w3 w3"), (None, "w9 w10"), (95, "w250 " * 400), (90, "w7")]
    return docs, items


@pytest.mark.parametrize("pass_words", [200_000, 120])
def test_search_matches_brute_force(spark, monkeypatch, pass_words):
    docs, items = corpus(pass_words)
    d, i = tables(spark, docs, items)
    assert got(L.search(d, i, pass_words=pass_words)) == brute(docs, items)
    monkeypatch.setattr(L, "GROUP_ITEMS", 3)
    monkeypatch.setattr(L, "CELLS", 2000)  # many small trees
    assert got(L.search(d, i, k=3, pass_words=pass_words)) == brute(docs, items, 3)


def test_empty_tables(spark):
    docs, items = corpus(1, 20)
    d, i = tables(spark, docs, items)
    assert L.search(d.limit(0), i).count() == 0
    assert L.search(d, i.limit(0)).count() == 0
    assert L.search(d.filter("doc_id between 2000 and 2002"), i).count() == 0


def _trees(seed, n_docs=400, n_items=40, spread=200):
    """Documents of up to 30 terms out of ``spread`` neighbouring ones, items of 12 of all 200."""
    rng = np.random.default_rng(seed)
    docs = [np.sort(rng.integers(0, 201 - spread) + rng.choice(spread, rng.integers(1, 30), replace=False)) for _ in range(n_docs)]
    docs.sort(key=lambda d: int(d[0]))
    bounds = np.r_[0, np.cumsum([len(d) for d in docs])]
    terms = np.concatenate(docs)
    g = rng.integers(1, 1000, len(terms))
    items = []
    for i in range(n_items):
        t = np.sort(rng.choice(200, 12, replace=False))
        items.append((t, rng.integers(1, 1000, 12)))
    dense = np.zeros((n_docs, 200), np.int64)
    dense[np.repeat(np.arange(n_docs), np.diff(bounds)), terms] = g
    q = np.zeros((n_items, 200), np.int64)
    for i, (t, x) in enumerate(items):
        q[i, t] = x
    return L.item_trees(items), L.DocTree(bounds, terms, g), q @ dense.T


def test_bounds_hold_and_prune():
    trees, docs, exact = _trees(1)
    least = np.sort(exact, axis=1)[:, -10]
    seen = {}
    for tree in trees:
        for item, found, scores in L.traverse(tree, docs, least):
            for d, s in zip(found.tolist(), scores.tolist()):
                assert exact[item, d] == s and (item, d) not in seen
                seen[item, d] = s
        for level, nodes in enumerate(tree.levels):
            for node, (t, q) in enumerate(nodes):
                for dl, m in enumerate(docs.levels):
                    bound = docs.bound(dl, np.arange(m.shape[1]), t, q)
                    span = L.LEAF * L.FAN**dl
                    for k in range(m.shape[1]):
                        assert exact[tree.items[tree.below(level, node)], k * span : (k + 1) * span].max() <= bound[k]
    assert seen == {(i, d): exact[i, d] for i, d in zip(*np.nonzero(exact >= least[:, None]))}


def test_traversal_scores_fewer_pairs_than_there_are(monkeypatch):
    trees, docs, exact = _trees(2, 4000, spread=60)
    least = np.sort(exact, axis=1)[:, -3]
    scored = 0
    plain = L.DocTree.scores

    def counted(self, leaves, t, q):
        nonlocal scored
        out = plain(self, leaves, t, q)
        scored += len(out[0])
        return out

    monkeypatch.setattr(L.DocTree, "scores", counted)
    for tree in trees:
        list(L.traverse(tree, docs, least))
    assert scored < exact.size / 2
